"""The review star over the given tables: suppliers as businesses, customers as users, lines as reviews,
orders as tips, events as check-ins.

Loads differ by business rules on the data (a region joins or leaves, a balance is corrected, a gap is
filled), so that every case of a merge occurs and every query runs over whole tables.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.entities import COMPLIMENTS
from tidemark.load import LoadContext, stamp
from tidemark.specs import EFFECTIVE_FROM, EFFECTIVE_TO, IS_CURRENT, OPEN_END

LOADS = {n: LoadContext(n, day) for n, day in {1: date(2001, 12, 1), 2: date(2001, 12, 8), 3: date(2001, 12, 15)}.items()}
FIRST_SNAPSHOT_ENDS = date(2000, 1, 1)


# Declared, so that no job is spent on inferring them.
SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "orders": """o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE,
        o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING""",
    "lineitem": """l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE,
        l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING,
        l_shipdate TIMESTAMP_NTZ""",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def business_key(number: Column) -> Column:
    return F.concat(F.lit("b"), F.lpad(number.cast("string"), 9, "0"))


def user_key(number: Column) -> Column:
    return F.concat(F.lit("u"), F.lpad(number.cast("string"), 9, "0"))


def suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers with nation and region."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    supplier = table(spark, sf_dir, "supplier")
    return supplier.join(places, F.col("s_nationkey") == F.col("n_nationkey"))


def raw_businesses(spark: SparkSession, sf_dir: str, load: int) -> DataFrame:
    """The business entity as it lands with one load."""
    rows = suppliers(spark, sf_dir)
    if load == 1:
        rows = rows.filter(F.col("r_name") != "ASIA")
    elif load == 2:
        rows = rows.filter(F.col("r_name") != "EUROPE")
    balance, stars = F.col("s_acctbal"), F.col("s_acctbal")
    if load >= 2:
        stars = F.when(balance >= 5000, stars + 100).otherwise(stars)
    if load >= 3:
        stars = F.when(balance.between(3000, 7000), stars + 200).otherwise(stars)
    unnamed_city = F.col("s_nationkey") >= 20
    return rows.select(
        business_key(F.col("s_suppkey")).alias("business_id"),
        F.col("s_name").alias("name"),
        F.concat_ws(" ", F.col("s_nationkey").cast("string"), F.col("r_name")).alias("address"),
        F.when(unnamed_city, F.lit(None if load == 1 else "")).otherwise(F.col("n_name")).alias("city"),
        F.when(balance >= {1: 0, 2: -10_000, 3: -500}[load], F.col("r_name")).alias("state"),
        F.lpad(F.col("s_nationkey").cast("string"), 5, "0").alias("postal_code"),
        (F.col("s_nationkey") * 1.5).alias("latitude"),
        (F.col("s_nationkey") * -0.5).alias("longitude"),
        stars.alias("stars"),
        F.col("s_suppkey").alias("review_count"),
        (balance >= 0).cast("bigint").alias("is_open"),
        F.create_map(F.lit("BusinessParking"), F.col("n_name")).alias("attributes"),
    )


def raw_users(spark: SparkSession, sf_dir: str, load: int) -> DataFrame:
    """The user entity as it lands with one load."""
    rows = table(spark, sf_dir, "customer")
    if load == 1:
        rows = rows.filter(F.col("c_mktsegment") != "MACHINERY")
    elif load == 2:
        rows = rows.filter(F.col("c_mktsegment") != "FURNITURE")
    nation = F.col("c_nationkey")
    balance = F.col("c_acctbal")
    if load >= 2:
        balance = F.when(F.col("c_mktsegment") == "BUILDING", balance + 100).otherwise(balance)
    return rows.select(
        user_key(F.col("c_custkey")).alias("user_id"),
        F.col("c_name").alias("name"),
        nation.cast("bigint").alias("review_count"),
        F.concat(F.date_add(F.lit(date(2004, 1, 1)), nation * 30).cast("string"), F.lit(" 10:20:30")).alias(
            "yelping_since"
        ),
        F.floor("c_acctbal").alias("useful"),
        (nation + 1).cast("bigint").alias("funny"),
        F.length("c_mktsegment").cast("bigint").alias("cool"),
        (nation * 2).cast("bigint").alias("fans"),
        balance.alias("average_stars"),
        *[(nation + i).cast("bigint").alias(f"compliment_{name}") for i, name in enumerate(COMPLIMENTS)],
    )


def ordered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What reviews are made of: lines, as narrow as they get, with the customer of their order. Several loads share them
    stored, so that the tables are joined, and days written out, once."""
    line = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate",
        F.floor(F.col("l_discount") * 100 + 0.5).alias("cool"),
        F.concat_ws(" ", "l_returnflag", "l_linestatus").alias("text"),
    )
    order = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    ordered = line.join(order, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")
    return ordered.withColumn("date", F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss")).drop("l_shipdate")


def raw_reviews(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    rows = ordered_lines(spark, sf_dir) if lines is None else lines
    return rows.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("review_id"),
        user_key(F.col("o_custkey")).alias("user_id"),
        business_key(F.col("l_suppkey")).alias("business_id"),
        (F.floor("l_quantity") % 5 + 1).cast("double").alias("stars"),
        F.col("l_quantity").cast("bigint").alias("useful"),
        F.col("l_linenumber").cast("bigint").alias("funny"),
        "cool",
        "text",
        "date",
    )


def raw_tips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        user_key(F.col("o_custkey")).alias("user_id"),
        business_key(F.floor(F.col("o_totalprice") / 4000)).alias("business_id"),
        F.col("o_orderstatus").alias("text"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("date"),
        F.substring("o_orderpriority", 1, 1).cast("bigint").alias("compliment_count"),
    )


def raw_checkins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comma-separated check-ins: the event, one more some days later, and a malformed item for errors.

    Events are moved back by 23 years into the years of orders and lines.
    """
    shift = F.expr("INTERVAL 23 YEARS")
    seen = F.col("ts") - shift
    again = F.date_add(seen.cast("date"), F.floor("value").cast("int"))
    return table(spark, sf_dir, "events").select(
        business_key(F.col("user_id")).alias("business_id"),
        F.concat_ws(
            ", ",
            F.date_format(seen, "yyyy-MM-dd HH:mm:ss"),
            F.concat(again.cast("string"), F.lit(" 12:00:00")),
            F.when(F.col("event_type") == "error", F.lit("n/a")),
        ).alias("date"),
    )


def _versions(members: DataFrame, number: str, surrogate: str, changed: Column, late: Column) -> DataFrame:
    """Dimension rows with history: a changed member has a closed first version; late members start with load 2."""
    first, second = LOADS[1].load_date, LOADS[2].load_date

    def version(id_: Column, load: Column, start: Column, end: Column, current: bool) -> Column:
        return F.struct(
            id_.alias(surrogate),
            load.cast("int").alias("ctl_loading"),
            start.alias(EFFECTIVE_FROM),
            end.alias(EFFECTIVE_TO),
            F.lit(current).alias(IS_CURRENT),
        )

    odd, even = F.col(number) * 2 + 1, F.col(number) * 2 + 2
    whole = version(
        odd, F.when(late, 2).otherwise(1), F.when(late, F.lit(second)).otherwise(F.lit(first)), F.lit(OPEN_END), True
    )
    closed = version(odd, F.lit(2), F.lit(first), F.date_sub(F.lit(second), 1), False)
    opened = version(even, F.lit(2), F.lit(second), F.lit(OPEN_END), True)
    versions = F.when(changed, F.array(closed, opened)).otherwise(F.array(whole))
    return members.withColumn("_v", F.explode(versions)).select(*members.columns, "_v.*").drop(number)


def dim_businesses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Business dimension after two loads, made directly."""
    rows = suppliers(spark, sf_dir).select(
        F.col("s_suppkey").alias("_n"),
        business_key(F.col("s_suppkey")).alias("business_nk"),
        F.col("s_name").alias("business_name"),
        F.concat_ws(" ", F.col("s_nationkey").cast("string"), F.col("r_name")).alias("business_address"),
        F.col("n_name").alias("business_city"),
        F.lpad(F.col("s_nationkey").cast("string"), 5, "0").alias("business_postal_code"),
        F.col("s_acctbal").alias("business_stars"),
        F.col("s_suppkey").alias("business_review_count"),
    )
    return _versions(
        rows, "_n", "business_id", F.col("business_stars") >= 5000, F.col("business_address").endswith("ASIA")
    )


def dim_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User dimension after two loads, made directly."""
    rows = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("_n"), user_key(F.col("c_custkey")).alias("user_nk"), "c_acctbal", "c_mktsegment"
    )
    dim = _versions(rows, "_n", "user_id", F.col("c_acctbal") >= 5000, F.col("c_mktsegment") == "MACHINERY")
    return dim.drop("c_acctbal", "c_mktsegment")


def _snapshots(rows: DataFrame, day: str) -> DataFrame:
    """Two loads of a fact: the first knows the days before its snapshot ended, the second all of them."""
    first = stamp(rows.filter(F.col(day) < F.lit(FIRST_SNAPSHOT_ENDS)), LOADS[1])
    return first.unionByName(stamp(rows, LOADS[2]))


def current_id(number: Column, balance: Column) -> Column:
    return number * 2 + F.when(balance >= 5000, 2).otherwise(1)


def mart_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Review facts of two loads. Surrogates alternate between closed and current versions of a business."""
    line = table(spark, sf_dir, "lineitem")
    rows = line.select(
        current_id(F.col("l_suppkey"), F.col("l_extendedprice") / 10).alias("business_id"),
        F.to_date("l_shipdate").alias("review_date"),
        F.when(F.col("l_returnflag") != "N", (F.floor("l_quantity") % 5 + 1).cast("double")).alias("review_stars"),
        F.when(F.col("l_tax") > 0, F.col("l_quantity").cast("bigint")).alias("review_useful_cnt"),
        F.col("l_linenumber").cast("bigint").alias("review_funny_cnt"),
        F.floor(F.col("l_discount") * 100 + 0.5).alias("review_cool_cnt"),
    )
    return _snapshots(rows, "review_date")


def mart_tips(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(
        (F.floor(F.col("o_totalprice") / 4000) + 1).alias("business_id"),
        F.col("o_custkey").alias("user_id"),
        F.to_date("o_orderdate").alias("tips_date"),
        F.lit(1).cast("bigint").alias("tips_cnt"),
        F.substring("o_orderpriority", 1, 1).cast("bigint").alias("tips_sum_of_compliments"),
    )
    return _snapshots(rows, "tips_date")


def mart_checkins(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(
        (F.col("user_id") + 1).alias("business_id"),
        F.add_months(F.to_date("ts"), -23 * 12).alias("checkin_date"),
        F.floor("value").alias("cnt_appearance"),
    )
    return _snapshots(rows, "checkin_date")
