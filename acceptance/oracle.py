"""The same results in plain SQL for DuckDB: range joins, outer joins and global windows on the given tables."""

from __future__ import annotations

from tidemark.entities import COMPLIMENTS

LOAD_DATES = {1: "2001-12-01", 2: "2001-12-08", 3: "2001-12-15"}
SNAPSHOT = "DATE '2000-01-01'"

BUSINESS_ATTRIBUTES = [
    "business_name", "business_address", "business_city", "business_state", "business_postal_code",
    "business_latitude", "business_longitude", "business_stars", "business_is_open", "business_review_count",
]
USER_ATTRIBUTES = [
    "user_name", "user_review_count", "user_yelping_since", "user_useful_votes", "user_funny_votes",
    "user_cool_votes", "user_number_of_fans", "user_average_stars",
    *[f"user_received_compliment_{c}" for c in COMPLIMENTS],
]


def key(prefix: str, number: str) -> str:
    return f"'{prefix}' || lpad(CAST({number} AS VARCHAR), 9, '0')"


def query(ctes: dict[str, str], select: str) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({body})" for name, body in ctes.items()) + "\n" + select


PLACES = """
    SELECT s_suppkey, s_name, s_acctbal, s_nationkey, n_name, r_name
      FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""


def business_increment(load: int) -> str:
    where = {1: "r_name <> 'ASIA'", 2: "r_name <> 'EUROPE'", 3: "TRUE"}[load]
    stars = "s_acctbal" if load == 1 else "CASE WHEN s_acctbal >= 5000 THEN s_acctbal + 100 ELSE s_acctbal END"
    if load == 3:
        stars = f"CASE WHEN s_acctbal BETWEEN 3000 AND 7000 THEN ({stars}) + 200 ELSE ({stars}) END"
    state = {1: "CASE WHEN s_acctbal >= 0 THEN r_name END", 2: "r_name", 3: "CASE WHEN s_acctbal >= -500 THEN r_name END"}[load]
    return f"""
    SELECT {key('b', 's_suppkey')} AS business_nk, s_name AS business_name,
           CAST(s_nationkey AS VARCHAR) || ' ' || r_name AS business_address,
           CASE WHEN s_nationkey >= 20 THEN {"NULL" if load == 1 else "''"} ELSE n_name END AS business_city,
           {state} AS business_state, lpad(CAST(s_nationkey AS VARCHAR), 5, '0') AS business_postal_code,
           CAST(s_nationkey AS DOUBLE) * 1.5 AS business_latitude,
           CAST(s_nationkey AS DOUBLE) * -0.5 AS business_longitude,
           {stars} AS business_stars, CAST(s_acctbal >= 0 AS INTEGER) AS business_is_open,
           s_suppkey AS business_review_count
      FROM ({PLACES}) WHERE {where}"""


def user_increment(load: int) -> str:
    where = {1: "c_mktsegment <> 'MACHINERY'", 2: "c_mktsegment <> 'FURNITURE'"}[load]
    stars = "c_acctbal" if load == 1 else "CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal + 100 ELSE c_acctbal END"
    compliments = ", ".join(f"c_nationkey + {i} AS user_received_compliment_{c}" for i, c in enumerate(COMPLIMENTS))
    return f"""
    SELECT {key('u', 'c_custkey')} AS user_nk, c_name AS user_name, c_nationkey AS user_review_count,
           DATE '2004-01-01' + c_nationkey * 30 AS user_yelping_since,
           CAST(floor(c_acctbal) AS INTEGER) AS user_useful_votes, c_nationkey + 1 AS user_funny_votes,
           CAST(length(c_mktsegment) AS INTEGER) AS user_cool_votes, c_nationkey * 2 AS user_number_of_fans,
           {stars} AS user_average_stars, {compliments}
      FROM customer WHERE {where}"""


CONVERSATION_ATTRIBUTES = ["role", "text"]


def conversation_increment(load: int) -> str:
    text = "text" if load == 1 else "CASE WHEN role = 'user' THEN text || '!' ELSE text END"
    return f"SELECT conv_id AS conv_nk, turn AS turn_nk, role, {text} AS text FROM conversations"


def differ(attributes: list[str], left: str = "i", right: str = "d") -> str:
    return "(" + " OR ".join(f"{left}.{a} IS DISTINCT FROM {right}.{a}" for a in attributes) + ")"


def same_key(keys: list[str], left: str = "i", right: str = "d") -> str:
    return " AND ".join(f"{left}.{k} = {right}.{k}" for k in keys)


def scd2_chain(
    name: str, sk: str, keys: list[str], attributes: list[str], increments: list[str], differs: str | None = None
) -> dict[str, str]:
    """CTEs ``<name>_0`` (empty) to ``<name>_n``: the dimension after each load."""
    differs = differs or differ(attributes)
    columns = ", ".join([*keys, *attributes])
    prefixed = ", ".join(f"i.{c}" for c in [*keys, *attributes])
    ctes = {}
    for n, increment in enumerate(increments, 1):
        inc, prev = f"{name}_inc_{n}", f"{name}_{n - 1}"
        ctes[inc] = increment
        if n == 1:
            ctes[prev] = f"""
                SELECT CAST(0 AS BIGINT) AS {sk}, {columns}, 0 AS ctl_loading, DATE '2000-01-01' AS effective_from,
                       DATE '2000-01-01' AS effective_to, FALSE AS is_current FROM {inc} WHERE FALSE"""
        day = LOAD_DATES[n]
        ctes[f"{name}_changed_{n}"] = f"""
            SELECT d.{sk}, {prefixed} FROM {prev} d JOIN {inc} i ON {same_key(keys)}
             WHERE d.is_current AND {differs}"""
        ctes[f"{name}_{n}"] = f"""
            SELECT * FROM {prev} WHERE {sk} NOT IN (SELECT {sk} FROM {name}_changed_{n})
            UNION ALL
            SELECT {sk}, {columns}, {n} AS ctl_loading, effective_from, DATE '{day}' - 1 AS effective_to,
                   FALSE AS is_current
              FROM {prev} WHERE {sk} IN (SELECT {sk} FROM {name}_changed_{n})
            UNION ALL
            SELECT row_number() OVER (ORDER BY {', '.join(keys)}) + (SELECT coalesce(max({sk}), 0) FROM {prev}) AS {sk},
                   {columns}, {n} AS ctl_loading, DATE '{day}' AS effective_from,
                   DATE '9999-12-31' AS effective_to, TRUE AS is_current
              FROM (SELECT {columns} FROM {name}_changed_{n}
                    UNION ALL
                    SELECT {prefixed} FROM {inc} i LEFT JOIN {prev} d ON {same_key(keys)} AND d.is_current
                     WHERE d.{keys[0]} IS NULL)"""
    return ctes


def businesses(loads: int, differs: str | None = None) -> dict[str, str]:
    increments = [business_increment(n) for n in range(1, loads + 1)]
    return scd2_chain("business", "business_id", ["business_nk"], BUSINESS_ATTRIBUTES, increments, differs)


def businesses_same_day() -> dict[str, str]:
    """The third load on the day of the second: versions that began that day are replaced in place."""
    columns = ", ".join(["business_nk", *BUSINESS_ATTRIBUTES])
    day = f"DATE '{LOAD_DATES[2]}'"
    return businesses(2) | {
        "arriving": business_increment(3),
        "touched": f"""
            SELECT d.business_id, i.*, d.effective_from = {day} AS in_place
              FROM business_2 d JOIN arriving i ON i.business_nk = d.business_nk
             WHERE d.is_current AND {differ(BUSINESS_ATTRIBUTES)}""",
        "opened": f"""
            SELECT {columns} FROM touched WHERE NOT in_place
            UNION ALL
            SELECT i.* FROM arriving i LEFT JOIN business_2 d ON d.business_nk = i.business_nk AND d.is_current
             WHERE d.business_nk IS NULL""",
        "business_3": f"""
            SELECT * FROM business_2 WHERE business_id NOT IN (SELECT business_id FROM touched)
            UNION ALL
            SELECT business_id, {columns}, 3 AS ctl_loading, effective_from, {day} - 1 AS effective_to, FALSE
              FROM business_2 WHERE business_id IN (SELECT business_id FROM touched WHERE NOT in_place)
            UNION ALL
            SELECT business_id, {columns}, 3, {day}, DATE '9999-12-31', TRUE FROM touched WHERE in_place
            UNION ALL
            SELECT row_number() OVER (ORDER BY business_nk) + (SELECT max(business_id) FROM business_2),
                   {columns}, 3, {day}, DATE '9999-12-31', TRUE FROM opened""",
    }


def users(loads: int) -> dict[str, str]:
    increments = [user_increment(n) for n in range(1, loads + 1)]
    return scd2_chain("usr", "user_id", ["user_nk"], USER_ATTRIBUTES, increments)


def dim_columns(sk: str, keys: list[str], attributes: list[str]) -> str:
    return ", ".join([sk, *keys, *attributes, "ctl_loading", "effective_from", "effective_to", "is_current"])


BUSINESS_COLUMNS = dim_columns("business_id", ["business_nk"], BUSINESS_ATTRIBUTES)
USER_COLUMNS = dim_columns("user_id", ["user_nk"], USER_ATTRIBUTES)
CHANGED_COLUMNS = ", ".join(["business_id", "business_nk", *BUSINESS_ATTRIBUTES])

SENTINEL_COMPARISON = {
    **{a: "''" for a in BUSINESS_ATTRIBUTES[:5]},
    **{a: "CAST(1 AS DOUBLE)" for a in BUSINESS_ATTRIBUTES[5:8]},
    **{a: "0" for a in BUSINESS_ATTRIBUTES[8:]},
}


# --- landed reviews, tips and check-ins -------------------------------------------------------------------------

RAW_REVIEWS = f"""
    SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR)
               AS review_id,
           {key('u', 'o_custkey')} AS user_nk, {key('b', 'l_suppkey')} AS business_nk,
           CAST(CAST(floor(l_quantity) AS BIGINT) % 5 + 1 AS DOUBLE) AS stars, CAST(l_quantity AS BIGINT) AS useful,
           CAST(l_linenumber AS BIGINT) AS funny, CAST(floor(l_discount * 100 + 0.5) AS BIGINT) AS cool,
           l_returnflag || ' ' || l_linestatus AS text, CAST(l_shipdate AS DATE) AS day
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

RAW_TIPS = f"""
    SELECT {key('u', 'o_custkey')} AS user_nk, {key('b', 'CAST(floor(o_totalprice / 4000) AS BIGINT)')} AS business_nk,
           CAST(o_orderdate AS DATE) AS day, CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS compliment_count
      FROM orders"""

CHECKIN_TEXT = f"""
    SELECT {key('b', 'user_id')} AS business_nk,
           strftime(ts - INTERVAL 23 YEAR, '%Y-%m-%d %H:%M:%S') || ', '
           || strftime(CAST(ts - INTERVAL 23 YEAR AS DATE) + CAST(floor(value) AS INTEGER), '%Y-%m-%d') || ' 12:00:00'
           || CASE WHEN event_type = 'error' THEN ', n/a' ELSE '' END AS dates
      FROM events"""

CHECKIN_DAYS = f"""
    SELECT business_nk, CAST(TRY_CAST(trim(item) AS TIMESTAMP) AS DATE) AS day
      FROM (SELECT business_nk, unnest(string_split(dates, ',')) AS item FROM ({CHECKIN_TEXT}))"""


# --- dimensions made directly, with closed versions -------------------------------------------------------------

def _versions(rows: str, number: str, sk: str, columns: str, changed: str, late: str) -> str:
    first, second = f"DATE '{LOAD_DATES[1]}'", f"DATE '{LOAD_DATES[2]}'"
    return f"""
    SELECT {number} * 2 + 1 AS {sk}, {columns}, CASE WHEN {late} THEN 2 ELSE 1 END AS ctl_loading,
           CASE WHEN {late} THEN {second} ELSE {first} END AS effective_from,
           DATE '9999-12-31' AS effective_to, TRUE AS is_current FROM ({rows}) WHERE NOT ({changed})
    UNION ALL
    SELECT {number} * 2 + 1, {columns}, 2, {first}, {second} - 1, FALSE FROM ({rows}) WHERE {changed}
    UNION ALL
    SELECT {number} * 2 + 2, {columns}, 2, {second}, DATE '9999-12-31', TRUE FROM ({rows}) WHERE {changed}"""


DIM_BUSINESSES = _versions(
    PLACES,
    "s_suppkey",
    "business_id",
    f"""{key('b', 's_suppkey')} AS business_nk, s_name AS business_name,
        CAST(s_nationkey AS VARCHAR) || ' ' || r_name AS business_address, n_name AS business_city,
        lpad(CAST(s_nationkey AS VARCHAR), 5, '0') AS business_postal_code, s_acctbal AS business_stars,
        s_suppkey AS business_review_count""",
    "s_acctbal >= 5000",
    "r_name = 'ASIA'",
)
DIM_USERS = _versions(
    "SELECT * FROM customer", "c_custkey", "user_id", f"{key('u', 'c_custkey')} AS user_nk",
    "c_acctbal >= 5000", "c_mktsegment = 'MACHINERY'",
)
STAR_DIMS = {"dim_businesses": DIM_BUSINESSES, "dim_users": DIM_USERS}


def fact_checkins(load: int, dim: str = "dim_businesses") -> str:
    return f"""
    SELECT coalesce(d.business_id, -1) AS business_id, c.day AS checkin_date, count(*) AS cnt_appearance,
           {load} AS ctl_loading, DATE '{LOAD_DATES[load]}' AS ctl_loading_date
      FROM ({CHECKIN_DAYS}) c
      LEFT JOIN {dim} d ON c.business_nk = d.business_nk
       AND DATE '{LOAD_DATES[load]}' BETWEEN d.effective_from AND d.effective_to
     GROUP BY coalesce(d.business_id, -1), c.day"""


def fact_reviews(load: int, dim: str = "dim_businesses", dim_u: str = "dim_users", rows: str = RAW_REVIEWS) -> str:
    day = f"DATE '{LOAD_DATES[load]}'"
    return f"""
    SELECT coalesce(d.business_id, -1) AS business_id, coalesce(u.user_id, -1) AS user_id, r.review_id AS review_nk,
           r.day AS review_date, r.text AS review_text_desc, r.stars AS review_stars, r.useful AS review_useful_cnt,
           r.funny AS review_funny_cnt, r.cool AS review_cool_cnt, {load} AS ctl_loading, {day} AS ctl_loading_date
      FROM ({rows}) r
      LEFT JOIN {dim} d ON r.business_nk = d.business_nk AND {day} BETWEEN d.effective_from AND d.effective_to
      LEFT JOIN {dim_u} u ON r.user_nk = u.user_nk AND {day} BETWEEN u.effective_from AND u.effective_to"""


def fact_tips(load: int, dim: str = "dim_businesses", dim_u: str = "dim_users", rows: str = RAW_TIPS) -> str:
    day = f"DATE '{LOAD_DATES[load]}'"
    return f"""
    SELECT coalesce(d.business_id, -1) AS business_id, coalesce(u.user_id, -1) AS user_id, t.day AS tips_date,
           count(*) AS tips_cnt, CAST(sum(t.compliment_count) AS BIGINT) AS tips_sum_of_compliments,
           {load} AS ctl_loading, {day} AS ctl_loading_date
      FROM ({rows}) t
      LEFT JOIN {dim} d ON t.business_nk = d.business_nk AND {day} BETWEEN d.effective_from AND d.effective_to
      LEFT JOIN {dim_u} u ON t.user_nk = u.user_nk AND {day} BETWEEN u.effective_from AND u.effective_to
     GROUP BY coalesce(d.business_id, -1), coalesce(u.user_id, -1), t.day"""


# --- facts of the mart queries, two loads -----------------------------------------------------------------------

def _snapshots(rows: str, day: str) -> str:
    return f"""
    SELECT *, 1 AS ctl_loading, DATE '{LOAD_DATES[1]}' AS ctl_loading_date FROM ({rows}) WHERE {day} < {SNAPSHOT}
    UNION ALL
    SELECT *, 2 AS ctl_loading, DATE '{LOAD_DATES[2]}' AS ctl_loading_date FROM ({rows})"""


MART_FACTS = {
    "fact_reviews": _snapshots(
        """SELECT l_suppkey * 2 + CASE WHEN l_extendedprice / 10 >= 5000 THEN 2 ELSE 1 END AS business_id,
                  CAST(l_shipdate AS DATE) AS review_date,
                  CASE WHEN l_returnflag <> 'N' THEN CAST(CAST(floor(l_quantity) AS BIGINT) % 5 + 1 AS DOUBLE) END
                      AS review_stars,
                  CASE WHEN l_tax > 0 THEN CAST(l_quantity AS BIGINT) END AS review_useful_cnt,
                  CAST(l_linenumber AS BIGINT) AS review_funny_cnt,
                  CAST(floor(l_discount * 100 + 0.5) AS BIGINT) AS review_cool_cnt
             FROM lineitem""",
        "review_date",
    ),
    "fact_checkins": _snapshots(
        """SELECT user_id + 1 AS business_id, CAST(ts - INTERVAL 23 YEAR AS DATE) AS checkin_date,
                  CAST(floor(value) AS BIGINT) AS cnt_appearance FROM events""",
        "checkin_date",
    ),
    "fact_tips": _snapshots(
        """SELECT CAST(floor(o_totalprice / 4000) AS BIGINT) + 1 AS business_id, o_custkey AS user_id,
                  CAST(o_orderdate AS DATE) AS tips_date, CAST(1 AS BIGINT) AS tips_cnt,
                  CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS tips_sum_of_compliments FROM orders""",
        "tips_date",
    ),
}

CALENDAR = {
    "latest_reviews": "SELECT * FROM fact_reviews WHERE ctl_loading_date = (SELECT max(ctl_loading_date) FROM fact_reviews)",
    "latest_checkins": "SELECT * FROM fact_checkins WHERE ctl_loading_date = (SELECT max(ctl_loading_date) FROM fact_checkins)",
    "latest_tips": "SELECT * FROM fact_tips WHERE ctl_loading_date = (SELECT max(ctl_loading_date) FROM fact_tips)",
    "extent": """
        SELECT min(day) AS min_date, max(day) AS max_date
          FROM (SELECT review_date AS day FROM latest_reviews UNION ALL SELECT checkin_date FROM latest_checkins
                UNION ALL SELECT tips_date FROM latest_tips)""",
    "mondays": """
        SELECT CAST(unnest(generate_series(date_trunc('week', min_date), date_trunc('week', max_date),
                                           INTERVAL 7 DAY)) AS DATE) AS start_week_date FROM extent""",
    "weeks": """
        SELECT start_week_date,
               CASE WHEN start_week_date = max(start_week_date) OVER () THEN DATE '5999-12-30'
                    ELSE start_week_date + 6 END AS end_week_date
          FROM mondays""",
    "spine": """
        SELECT business_id, start_week_date, end_week_date FROM weeks
         CROSS JOIN (SELECT business_id FROM dim_businesses WHERE is_current)""",
}

RUNNING = "OVER (PARTITION BY business_id ORDER BY start_week_date)"


def average(total: str, count: str) -> str:
    """Half up to two places in whole numbers, since engines differ on ties of binary fractions."""
    return (
        f"CASE WHEN {count} <> 0 THEN CAST(floor((200 * {total} + {count}) / (2 * {count})) / 100 AS DECIMAL(4,2)) END"
    )


SPINE_KEY = "business_id, start_week_date, end_week_date"
VOTES = ["review_useful_cnt", "review_funny_cnt", "review_cool_cnt"]


def measures(fact: str, day: str, values: dict[str, str], idle_shown: bool) -> str:
    """Weekly and running sums of a fact on the spine; idle weeks are NULL, or 0 and carried on when shown."""
    sums = ", ".join(f"CAST(sum(coalesce({value}, 0)) AS BIGINT) AS {name}" for name, value in values.items())
    running = ", ".join(f"CAST(sum({name}) {RUNNING} AS BIGINT) AS all_{name}" for name in values)
    shown = "TRUE" if idle_shown else "hits > 0"
    columns = ", ".join(
        f"CASE WHEN {shown} THEN {column} END AS {span}_{name}"
        for name in values
        for span, column in (("weekly", name), ("aggregated", f"all_{name}"))
    )
    weekly = f"""
        SELECT {', '.join(f'spine.{c}' for c in SPINE_KEY.split(', '))}, count({fact}.business_id) AS hits, {sums}
          FROM spine LEFT JOIN {fact} ON {fact}.business_id = spine.business_id
               AND {day} BETWEEN start_week_date AND end_week_date
         GROUP BY ALL"""
    return f"SELECT {SPINE_KEY}, {columns} FROM (SELECT *, {running} FROM ({weekly}))"


def review_measures() -> str:
    values = {vote: vote for vote in VOTES}
    values |= {"stars": "review_stars", "rated": "CAST(review_stars IS NOT NULL AS BIGINT)"}
    columns = [f"{span}_{vote}" for vote in VOTES for span in ("weekly", "aggregated")]
    columns += [
        f"{average(f'{span}_stars', f'{span}_rated')} AS {span}_review_stars_avg" for span in ("weekly", "aggregated")
    ]
    sums = measures("latest_reviews", "review_date", values, idle_shown=True)
    return f"SELECT {SPINE_KEY}, {', '.join(columns)} FROM ({sums})"


def checkin_measures(filled: bool = False) -> str:
    return measures("latest_checkins", "checkin_date", {"checkin_appearance_cnt": "cnt_appearance"}, filled)


def tip_measures(filled: bool = False) -> str:
    values = {"tips_cnt": "tips_cnt", "compliments_cnt": "tips_sum_of_compliments"}
    return measures("latest_tips", "tips_date", values, filled)


def mart(base: dict[str, str], filled: bool = False) -> str:
    """All measures are dense on the spine, so they meet by their common key."""
    measured = {
        "of_reviews": review_measures(),
        "of_checkins": checkin_measures(filled),
        "of_tips": tip_measures(filled),
        "attributes": """
            SELECT business_id, business_name, business_address, business_city, business_postal_code,
                   business_stars AS final_amount_business_stars,
                   business_review_count AS final_amount_business_review_count
              FROM dim_businesses WHERE is_current""",
    }
    return query(
        base | CALENDAR | measured,
        f"""SELECT * EXCLUDE (start_week_date)
              FROM of_reviews JOIN of_checkins USING ({SPINE_KEY}) JOIN of_tips USING ({SPINE_KEY})
              JOIN attributes USING (business_id)""",
    )


MART_BASE = {"dim_businesses": DIM_BUSINESSES, **MART_FACTS}
ORDERS_SNAPSHOTS = _snapshots("SELECT o_orderkey, o_custkey, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders", "o_orderdate")


def oracle_sql() -> dict[str, str]:
    two = businesses(2)
    sentinel_differ = " OR ".join(
        f"coalesce(i.{a}, {z}) <> coalesce(d.{a}, {z})" for a, z in SENTINEL_COMPARISON.items()
    )
    changed = "SELECT business_id FROM business_changed_2"
    users_two = users(2)
    conversations = scd2_chain(
        "conv", "conv_id", ["conv_nk", "turn_nk"], CONVERSATION_ATTRIBUTES, [conversation_increment(n) for n in (1, 2)]
    )
    conv_columns = dim_columns("conv_id", ["conv_nk", "turn_nk"], CONVERSATION_ATTRIBUTES)
    landed = ", ".join(["business_id", "name", "address", "city", "state", "postal_code", "latitude", "longitude",
                        "stars", "review_count", "is_open", "attributes"])
    landed_select = f"""
        SELECT business_nk AS business_id, business_name AS name, business_address AS address, business_city AS city,
               business_state AS state, business_postal_code AS postal_code, business_latitude AS latitude,
               business_longitude AS longitude, business_stars AS stars, business_review_count AS review_count,
               CAST(business_is_open AS BIGINT) AS is_open,
               '{{"BusinessParking":"' || n_name || '"}}' AS attributes
          FROM ({business_increment(3)})
          JOIN (SELECT {key('b', 's_suppkey')} AS business_nk, n_name FROM ({PLACES})) USING (business_nk)"""
    calendar = MART_BASE | CALENDAR
    end_to_end = two | users_two | {
        "dim_businesses": "SELECT * FROM business_2",
        "dim_users": "SELECT * FROM usr_2",
        "fact_reviews": fact_reviews(2),
        "fact_checkins": fact_checkins(2),
        "fact_tips": fact_tips(2),
    }
    return {
        "stamp_load_metadata": f"""
            SELECT o_orderkey, o_custkey, 2 AS ctl_loading, DATE '{LOAD_DATES[2]}' AS ctl_loading_date FROM orders""",
        "rename_and_cast_mapping": business_increment(3),
        "nested_field_projection": """
            SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events""",
        "nested_map_projection": f"SELECT {key('b', 's_suppkey')} AS business_id, n_name AS parking FROM ({PLACES})",
        "json_entity_round_trip": query({"landed": landed_select}, f"SELECT {landed} FROM landed"),
        "bronze_partition_round_trip": ORDERS_SNAPSHOTS,
        "scan_or_empty_first_load": "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier",
        "incremental_since_load": f"SELECT * FROM ({ORDERS_SNAPSHOTS}) WHERE ctl_loading > 1",
        "changed_rows_null_safe": query(two, f"SELECT {CHANGED_COLUMNS} FROM business_changed_2"),
        "changed_rows_null_sentinels": query(
            two,
            f"""SELECT d.business_id, i.* FROM business_1 d JOIN business_inc_2 i ON i.business_nk = d.business_nk
                 WHERE d.is_current AND ({sentinel_differ})""",
        ),
        "latest_per_key": """
            SELECT user_id, event_id, event_type, value
              FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
             WHERE rn = 1""",
        "rejected_keys": f"SELECT count(*) AS rejected FROM ({business_increment(3)}) WHERE business_state IS NULL",
        "scd2_unaffected": query(
            two, f"SELECT {BUSINESS_COLUMNS} FROM business_1 WHERE business_id NOT IN ({changed})"
        ),
        "scd2_new_keys": query(
            two,
            """SELECT i.* FROM business_inc_2 i LEFT JOIN business_1 d ON d.business_nk = i.business_nk AND d.is_current
                WHERE d.business_nk IS NULL""",
        ),
        "scd2_expired": query(
            two,
            f"""SELECT {dim_columns('business_id', ['business_nk'], BUSINESS_ATTRIBUTES)} FROM business_2
                 WHERE NOT is_current""",
        ),
        "surrogate_assignment": """
            SELECT row_number() OVER (ORDER BY c_name) + (SELECT max(s_suppkey) FROM supplier) AS customer_id,
                   c_custkey, c_name FROM customer""",
        "scd2_merge_first_load": query(businesses(1), f"SELECT {BUSINESS_COLUMNS} FROM business_1"),
        "scd2_merge_second_load": query(two, f"SELECT {BUSINESS_COLUMNS} FROM business_2"),
        "scd2_merge_third_load": query(businesses(3), f"SELECT {BUSINESS_COLUMNS} FROM business_3"),
        "scd2_merge_same_day": query(businesses_same_day(), f"SELECT {BUSINESS_COLUMNS} FROM business_3"),
        "scd2_merge_null_sentinels": query(
            businesses(2, f"({sentinel_differ})"), f"SELECT {BUSINESS_COLUMNS} FROM business_2"
        ),
        "scd2_publish_resumed": query(businesses(3), f"SELECT {BUSINESS_COLUMNS} FROM business_3"),
        "scd2_two_runs_interleaved": query(businesses(3), f"SELECT {BUSINESS_COLUMNS} FROM business_3"),
        "scd2_read_while_published": query(
            businesses(3),
            " UNION ALL ".join(
                f"SELECT '{opened}' AS opened, business_id, business_nk, business_stars, effective_from, effective_to, is_current"
                f" FROM business_{state}"
                for opened, state in (("before", 2), ("meanwhile", 2), ("after", 3))
            ),
        ),
        "mart_survives_failed_write": mart(MART_BASE),
        "facts_in_balanced_files": f"""
            SELECT CAST(date_trunc('week', tips_date) AS DATE) AS week, count(*) AS tips
              FROM ({MART_FACTS['fact_tips']}) GROUP BY 1""",
        "bronze_keeps_extra_fields": f"""
            SELECT CASE WHEN s_acctbal >= 0 AND s_nationkey <> 3 THEN {key('b', 's_suppkey')} END AS business_id,
                   CASE WHEN s_acctbal >= 0 THEN n_name END AS chain,
                   CASE WHEN s_acctbal >= 0 THEN CAST(s_nationkey AS VARCHAR) END AS floors,
                   CASE WHEN s_acctbal >= 1000 THEN s_acctbal END AS stars,
                   s_acctbal < 1000 AS kept_whole
              FROM ({PLACES})""",
        "load_quality": f"""
            SELECT 'business' AS entity, count(*) AS lines, count(*) FILTER (s_acctbal < 0) AS broken,
                   count(*) FILTER (s_acctbal >= 0 AND s_acctbal < 1000) AS misfit,
                   count(*) FILTER (s_acctbal >= 0 AND s_nationkey = 3) AS null_keys, CAST(0 AS BIGINT) AS bad_dates,
                   2 AS ctl_loading FROM supplier
            UNION ALL
            SELECT 'checkin', count(*), 0, 0, 0, count(*) FILTER (event_type = 'error'), 2 FROM events""",
        "fact_reviews_several_loads": query(
            STAR_DIMS,
            fact_reviews(2, rows=f"""
                SELECT * FROM (
                  SELECT *, 1 AS landed FROM ({RAW_REVIEWS}) WHERE day < {SNAPSHOT}
                  UNION ALL
                  SELECT * REPLACE (useful + 1 AS useful), 2 FROM ({RAW_REVIEWS}) WHERE day >= DATE '1996-01-01')
                QUALIFY rank() OVER (PARTITION BY review_id ORDER BY landed DESC) = 1"""),
        ),
        "empty_rerun_clears_load": f"SELECT * FROM ({ORDERS_SNAPSHOTS}) WHERE ctl_loading = 1",
        "scd2_merge_users": query(users_two, f"SELECT {USER_COLUMNS} FROM usr_2"),
        "scd2_merge_composite_key": query(conversations, f"SELECT {conv_columns} FROM conv_2"),
        "scd2_publish_round_trip": query(businesses(3), f"SELECT {BUSINESS_COLUMNS} FROM business_3"),
        "lookup_effective_single": query(
            STAR_DIMS,
            f"""SELECT coalesce(d.business_id, -1) AS business_id, c.day AS checkin_date FROM ({CHECKIN_DAYS}) c
                  LEFT JOIN dim_businesses d ON c.business_nk = d.business_nk
                   AND DATE '{LOAD_DATES[1]}' BETWEEN d.effective_from AND d.effective_to""",
        ),
        "lookup_effective_two": query(
            STAR_DIMS,
            f"""SELECT coalesce(d.business_id, -1) AS business_id, coalesce(u.user_id, -1) AS user_id, r.review_id
                  FROM ({RAW_REVIEWS}) r
                  LEFT JOIN dim_businesses d ON r.business_nk = d.business_nk
                   AND DATE '{LOAD_DATES[1]}' BETWEEN d.effective_from AND d.effective_to
                  LEFT JOIN dim_users u ON r.user_nk = u.user_nk
                   AND DATE '{LOAD_DATES[1]}' BETWEEN u.effective_from AND u.effective_to""",
        ),
        "explode_csv_dates": f"SELECT business_nk AS business_id, day AS checkin_date FROM ({CHECKIN_DAYS})",
        "rejected_dates": f"SELECT count(*) AS rejected FROM ({CHECKIN_DAYS}) WHERE day IS NULL",
        "fact_checkins": query(STAR_DIMS, fact_checkins(2)),
        "fact_reviews": query(STAR_DIMS, fact_reviews(2)),
        "fact_tips": query(STAR_DIMS, fact_tips(2)),
        "fact_dynamic_overwrite": MART_FACTS["fact_tips"],
        "latest_load_filter": query(calendar, "SELECT * FROM latest_reviews"),
        "date_extent_union": query(calendar, "SELECT min_date, max_date FROM extent"),
        "week_spine": query(calendar, "SELECT start_week_date, end_week_date FROM weeks"),
        "business_week_spine": query(calendar, "SELECT business_id, start_week_date, end_week_date FROM spine"),
        "weekly_review_measures": query(calendar, review_measures()),
        "weekly_checkin_measures": query(calendar, checkin_measures()),
        "weekly_tip_measures": query(calendar, tip_measures()),
        "weekly_business_aggregate": mart(MART_BASE),
        "weekly_business_aggregate_filled": mart(MART_BASE, filled=True),
        "two_loads_to_mart": mart(end_to_end),
    }
