"""Every operator as a query over the given tables: ``name -> (spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import partial

from pyspark.errors import SparkRuntimeException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acceptance import star
from tidemark import versions
from tidemark.durable import drop, fresh_path, materialise
from tidemark.entities import DIM_BUSINESSES, DIM_USERS, entity_spec, entity_specs, raw_schema
from tidemark.load import LOAD_DATE, LOAD_ID, LoadContext, stamp
from tidemark.operators.keys import assign_surrogates, latest_per_key, rejected_keys
from tidemark.operators.loads import latest_load
from tidemark.operators.lookup import lookup_effective
from tidemark.operators.scd2 import (
    changed_rows,
    current_rows,
    expired_rows,
    new_key_rows,
    scd2_delta,
    scd2_merge,
    unaffected_rows,
)
from tidemark.operators.weeks import member_weeks, week_spine
from tidemark.plans.facts import checkin_dates, fact_checkins, fact_reviews, fact_tips, rejected_dates
from tidemark.plans.lake import (
    Lake,
    bronze_increment,
    ingest,
    ingest_load,
    newest_rows,
    read_quality,
    run_jobs,
    run_load,
    standing,
)
from tidemark.plans.mart import checkin_measures, fact_extent, review_measures, tip_measures, weekly_business
from tidemark.sinks.writers import (
    DIMENSION,
    overwrite_table,
    publish_dimension,
    publish_fact,
    replace_partitions,
    write_bronze,
)
from tidemark.sources.readers import empty_table, read_entity, read_or_empty, read_table, since_load
from tidemark.specs import CORRUPT_RECORD, EXTRA_FIELDS, DimSpec, Field

Query = Callable[[SparkSession, str], DataFrame]

LINES_PER_FILE = 250_000

DIM_TURNS = DimSpec(
    table="dim_turns",
    entity="turn",
    surrogates=("conv_id",),
    keys=(Field("conv_nk", T.LongType(), "conv_id"), Field("turn_nk", T.LongType(), "turn")),
    attributes=(Field("role", T.StringType(), "role"), Field("text", T.StringType(), "text")),
)


def _businesses(spark: SparkSession, sf_dir: str, load: int) -> DataFrame:
    return DIM_BUSINESSES.conform(star.raw_businesses(spark, sf_dir, load))


def _merge(spark: SparkSession, spec: DimSpec, increments: list[DataFrame]) -> DataFrame:
    """The dimension after all loads, stored after each load but the last, as a lake does."""
    dim = empty_table(spark, spec.schema)
    for load, increment in enumerate(increments, 1):
        dim = materialise(dim, "dim") if load > 1 else dim
        dim = scd2_merge(dim, spec.conform(increment), spec, star.LOADS[load])
    return dim


def _merged_businesses(spark: SparkSession, sf_dir: str, loads: int) -> DataFrame:
    increments = [star.raw_businesses(spark, sf_dir, n) for n in range(1, loads + 1)]
    return _merge(spark, DIM_BUSINESSES, increments)


def _mart_facts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return star.mart_reviews(spark, sf_dir), star.mart_checkins(spark, sf_dir), star.mart_tips(spark, sf_dir)


def _extent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact_extent(*_mart_facts(spark, sf_dir))


def stamp_load_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stamp(star.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), star.LOADS[2])


def rename_and_cast_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _businesses(spark, sf_dir, 3)


def nested_field_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = star.table(spark, sf_dir, "events").withColumn("props", F.from_json("props", "k INT"))
    return events.select("event_id", F.col("props.k").alias("k"))


def nested_map_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = _landed_businesses(spark, sf_dir)
    return landed.select("business_id", F.col("attributes.BusinessParking").alias("parking"))


def _land(df: DataFrame, landing: str, entity: str) -> None:
    """JSON lines, compressed (at level 3, whose files are a sixth larger than the default's for half its time); a file is
    read by one task, so its lines are bounded."""
    lines = df.write.option("compression", "gzip").option("zlib.compress.level", "THREE")
    lines = lines.option("maxRecordsPerFile", LINES_PER_FILE)
    lines.json(f"{landing}/{entity_spec(entity).name}.json")


def _landed_businesses(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = fresh_path(spark, "landing")
    _land(star.raw_businesses(spark, sf_dir, 3), landing, "business")
    return read_entity(spark, entity_spec("business"), landing)


def json_entity_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed as JSON, ingested to bronze, read back."""
    landing, lake = fresh_path(spark, "landing"), Lake(fresh_path(spark, "lake"))
    raw = star.raw_businesses(spark, sf_dir, 3)
    _land(raw, landing, "business")
    specs = [spec for spec in entity_specs() if spec == entity_spec("business")]
    ingest(spark, specs, star.LOADS[1], landing, f"{lake.root}/bronze")
    bronze = read_table(spark, lake.bronze("business"), "orc")
    return bronze.select(*raw.columns).withColumn("attributes", F.to_json("attributes"))


def _dirty_landing(spark: SparkSession, sf_dir: str) -> str:
    """All suppliers as lines with two fields beyond the schema. Those in debt are cut off, small balances are no
    number, one nation has no key."""
    landing = fresh_path(spark, "landing")
    balance, nation = F.col("s_acctbal"), F.col("s_nationkey")
    line = F.to_json(
        F.struct(
            F.when(nation != 3, star.business_key(F.col("s_suppkey"))).alias("business_id"),
            F.when(balance >= 1000, balance.cast("string")).otherwise(F.lit("few")).alias("stars"),
            F.col("n_name").alias("chain"),
            nation.alias("floors"),
        )
    )
    cut = F.when(balance >= 0, line).otherwise(F.substring(line, 1, 20))
    star.suppliers(spark, sf_dir).select(cut.alias("value")).write.text(f"{landing}/{entity_spec('business').name}.json")
    return landing


def bronze_keeps_extra_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = Lake(fresh_path(spark, "lake"))
    ingest_load(spark, lake, star.LOADS[2], _dirty_landing(spark, sf_dir), entities=["business"])
    bronze = read_table(spark, lake.bronze("business"), "orc", raw_schema("business"))
    extra = F.col(EXTRA_FIELDS)
    return bronze.select(
        "business_id",
        extra["chain"].alias("chain"),
        extra["floors"].alias("floors"),
        "stars",
        F.col(CORRUPT_RECORD).isNotNull().alias("kept_whole"),
    )


def load_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts taken while businesses with broken lines and check-ins with malformed dates are ingested."""
    lake, landing = Lake(fresh_path(spark, "lake")), _dirty_landing(spark, sf_dir)
    _land(star.raw_checkins(spark, sf_dir), landing, "checkin")
    ingest_load(spark, lake, star.LOADS[2], landing, workers=2, entities=["business", "checkin"])
    return read_quality(spark, lake).drop(LOAD_DATE)


def _stored_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third smaller than by the session's codec, for a tenth more time of the write."""
    return materialise(star.ordered_lines(spark, sf_dir), "lines", compression="zstd")


def fact_reviews_several_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping snapshots; the second one has a vote more for each review it brings again."""
    lake, lines = Lake(fresh_path(spark, "lake")), _stored_lines(spark, sf_dir)
    reviews = star.raw_reviews(spark, sf_dir, lines)
    early = reviews.filter(F.col("date") < F.lit(star.FIRST_SNAPSHOT_ENDS.isoformat()))
    late = reviews.filter(F.col("date") >= "1996-01-01").withColumn("useful", F.col("useful") + 1)
    for n, rows in ((1, early), (2, late)):
        write_bronze(stamp(rows, star.LOADS[n]), lake.bronze("review"), star.LOADS[n])
    drop(lines)
    raw = newest_rows(bronze_increment(spark, lake, "review", star.LOADS[2], after_load=0), ["review_id"])
    return fact_reviews(raw, *_dims(spark, sf_dir), star.LOADS[2])


def _order_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = star.table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", "o_custkey", "o_totalprice", F.to_date("o_orderdate").alias("o_orderdate"))


def _bronze_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads; the second is first written incomplete, then again as a whole."""
    path = fresh_path(spark, "bronze")
    orders = _order_rows(spark, sf_dir)
    known_early = orders.filter(F.col("o_orderdate") < F.lit(star.FIRST_SNAPSHOT_ENDS))
    write_bronze(stamp(known_early, star.LOADS[1]), path, star.LOADS[1])
    write_bronze(stamp(known_early, star.LOADS[2]), path, star.LOADS[2])
    write_bronze(stamp(orders, star.LOADS[2]), path, star.LOADS[2], files=3)
    return read_table(spark, path, "orc")


def empty_rerun_clears_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads; the second is run again and has no rows any more."""
    path, orders = fresh_path(spark, "bronze"), _order_rows(spark, sf_dir)
    write_bronze(stamp(orders.filter(F.col("o_orderdate") < F.lit(star.FIRST_SNAPSHOT_ENDS)), star.LOADS[1]), path, star.LOADS[1])
    for rows in (orders, orders.filter(F.lit(False))):
        write_bronze(stamp(rows, star.LOADS[2]), path, star.LOADS[2])
    return read_table(spark, path, "orc")


def incremental_since_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return since_load(_bronze_orders(spark, sf_dir), after=1)


def scan_or_empty_first_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = star.table(spark, sf_dir, "supplier")
    return read_or_empty(spark, fresh_path(spark, "missing"), supplier.schema).unionByName(supplier)


def changed_rows_null_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changed_rows(_merged_businesses(spark, sf_dir, 1), _businesses(spark, sf_dir, 2), DIM_BUSINESSES)


def changed_rows_null_sentinels(spark: SparkSession, sf_dir: str) -> DataFrame:
    current = _merged_businesses(spark, sf_dir, 1)
    return changed_rows(current, _businesses(spark, sf_dir, 2), DIM_BUSINESSES, null_sentinels=True)


def latest_event_per_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = latest_per_key(
        star.table(spark, sf_dir, "events"), ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()]
    )
    return newest.select("user_id", "event_id", "event_type", "value")


def rejected_business_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed businesses that a key of id and state would refuse: those whose state is still missing."""
    return rejected_keys(star.raw_businesses(spark, sf_dir, 3), ["business_id", "state"])


def scd2_unaffected(spark: SparkSession, sf_dir: str) -> DataFrame:
    current = _merged_businesses(spark, sf_dir, 1)
    changed = changed_rows(current, _businesses(spark, sf_dir, 2), DIM_BUSINESSES)
    return unaffected_rows(current, changed, DIM_BUSINESSES)


def scd2_new_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return new_key_rows(_merged_businesses(spark, sf_dir, 1), _businesses(spark, sf_dir, 2), DIM_BUSINESSES)


def scd2_expired(spark: SparkSession, sf_dir: str) -> DataFrame:
    current = _merged_businesses(spark, sf_dir, 1)
    changed = changed_rows(current, _businesses(spark, sf_dir, 2), DIM_BUSINESSES)
    return expired_rows(current, changed, DIM_BUSINESSES, star.LOADS[2])


def surrogate_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers numbered by name above the keys that suppliers already use."""
    used = star.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("customer_id"))
    customers = star.table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    numbered = assign_surrogates(customers, ["customer_id"], ["c_name"], existing=used)
    return numbered.select("customer_id", "c_custkey", "c_name")


def scd2_merge_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merge(spark, DIM_USERS, [star.raw_users(spark, sf_dir, n) for n in (1, 2)])


def scd2_merge_composite_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = star.table(spark, sf_dir, "conversations")
    corrected = F.when(F.col("role") == "user", F.concat("text", F.lit("!"))).otherwise(F.col("text"))
    return _merge(spark, DIM_TURNS, [turns, turns.withColumn("text", corrected)])


def _next_load(spark: SparkSession, sf_dir: str, path: str, n: int) -> tuple[DataFrame, versions.Version | None, dict[str, int]]:
    """What a load brings to the businesses on disk (with digests), the version it starts from, and the numbers in use."""
    spec, base = replace(DIM_BUSINESSES, digests=True), versions.live(spark, path)
    current, marks = standing(spark, path, base, spec)
    delta = scd2_delta(current, _businesses(spark, sf_dir, n), spec, star.LOADS[n], marks=marks, digests=spec.digests)
    return delta, base, marks


def _publish_load(spark: SparkSession, sf_dir: str, path: str, n: int) -> None:
    delta, base, marks = _next_load(spark, sf_dir, path, n)
    publish_dimension(delta, path, base=base, highest=marks)


def _read_businesses(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, schema=DIM_BUSINESSES.schema).select(*DIM_BUSINESSES.columns)


def scd2_publish_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads, each merged into the table on disk and published as its next version."""
    path = fresh_path(spark, "dim")
    for n in star.LOADS:
        _publish_load(spark, sf_dir, path, n)
    return _read_businesses(spark, path)


def scd2_publish_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As above, but the third publish breaks off when its rows are written and its pointer is not. The load, run again,
    starts from the second version; run once more, it finds nothing to change."""
    path = fresh_path(spark, "dim")
    for n in (1, 2):
        _publish_load(spark, sf_dir, path, n)
    _next_load(spark, sf_dir, path, 3)[0].write.partitionBy(*DIMENSION).parquet(f"{path}/_run=broken-off")
    for _ in range(2):
        _publish_load(spark, sf_dir, path, 3)
    return _read_businesses(spark, path)


def scd2_two_runs_interleaved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of the third load start from the second version. The first to publish wins; the other is refused, starts
    again and finds nothing to change."""
    path = fresh_path(spark, "dim")
    for n in (1, 2):
        _publish_load(spark, sf_dir, path, n)
    first, second = _next_load(spark, sf_dir, path, 3), _next_load(spark, sf_dir, path, 3)
    publish_dimension(second[0], path, base=second[1], highest=second[2])
    try:
        publish_dimension(first[0], path, base=first[1], highest=first[2])
        raise AssertionError("the second publish from one version was not refused")
    except versions.Conflict:
        _publish_load(spark, sf_dir, path, 3)
    return _read_businesses(spark, path)


def scd2_read_while_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What readers see who open the table before the third load is published, when its rows are written, and after."""
    path, seen = fresh_path(spark, "dim"), {}
    for n in (1, 2):
        _publish_load(spark, sf_dir, path, n)
    delta, base, _ = _next_load(spark, sf_dir, path, 3)
    seen["before"] = _read_businesses(spark, path)

    def notes() -> dict:  # asked between the rows and the pointer
        seen["meanwhile"] = _read_businesses(spark, path)
        return {}

    versions.publish(delta, path, DIMENSION, base, notes)
    seen["after"] = _read_businesses(spark, path)
    columns = ("business_id", "business_nk", "business_stars", "effective_from", "effective_to", "is_current")
    views = [df.select(F.lit(when).alias("opened"), *columns) for when, df in seen.items()]
    return views[0].unionByName(views[1]).unionByName(views[2])


def scd2_merge_same_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third load on the day of the second."""
    dim = materialise(_merged_businesses(spark, sf_dir, 2), "dim")
    return scd2_merge(dim, _businesses(spark, sf_dir, 3), DIM_BUSINESSES, LoadContext(3, star.LOADS[2].load_date))


def scd2_merge_null_sentinels(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = materialise(_merged_businesses(spark, sf_dir, 1), "dim")
    return scd2_merge(dim, _businesses(spark, sf_dir, 2), DIM_BUSINESSES, star.LOADS[2], null_sentinels=True)


def lookup_effective_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = checkin_dates(star.raw_checkins(spark, sf_dir)).withColumnRenamed("business_id", "key")
    dim = star.dim_businesses(spark, sf_dir)
    return lookup_effective(rows, dim, DIM_BUSINESSES, {"key": "business_nk"}, star.LOADS[1].load_date)


def lookup_effective_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    reviews = star.raw_reviews(spark, sf_dir).select(
        "review_id", F.col("business_id").alias("b"), F.col("user_id").alias("u")
    )
    day = star.LOADS[1].load_date
    found = lookup_effective(reviews, star.dim_businesses(spark, sf_dir), DIM_BUSINESSES, {"b": "business_nk"}, day)
    return lookup_effective(found, star.dim_users(spark, sf_dir), DIM_USERS, {"u": "user_nk"}, day)


def explode_csv_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checkin_dates(star.raw_checkins(spark, sf_dir))


def rejected_checkin_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejected_dates(checkin_dates(star.raw_checkins(spark, sf_dir)), "checkin_date")


def fact_checkins_of_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact_checkins(star.raw_checkins(spark, sf_dir), star.dim_businesses(spark, sf_dir), star.LOADS[2])


def _dims(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return star.dim_businesses(spark, sf_dir), star.dim_users(spark, sf_dir)


def fact_reviews_of_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact_reviews(star.raw_reviews(spark, sf_dir), *_dims(spark, sf_dir), star.LOADS[2])


def fact_tips_of_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact_tips(star.raw_tips(spark, sf_dir), *_dims(spark, sf_dir), star.LOADS[2])


def fact_dynamic_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both loads published, then the second once more: its partition is replaced, the first stays."""
    path = fresh_path(spark, "fact")
    tips = star.mart_tips(spark, sf_dir)
    for n in (1, 2, 2):
        publish_fact(tips.filter(F.col(LOAD_ID) == n), path, star.LOADS[n])
    return read_table(spark, path).withColumn(LOAD_DATE, F.col(LOAD_DATE).cast("date"))


def latest_load_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_load(star.mart_reviews(spark, sf_dir))


def weeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return week_spine(_extent(spark, sf_dir))


def business_week_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    businesses = current_rows(star.dim_businesses(spark, sf_dir)).select("business_id")
    return member_weeks(businesses, _extent(spark, sf_dir))


def weekly_review_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    businesses = star.dim_businesses(spark, sf_dir)
    return review_measures(businesses, star.mart_reviews(spark, sf_dir), _extent(spark, sf_dir))


def weekly_checkin_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    businesses = star.dim_businesses(spark, sf_dir)
    return checkin_measures(businesses, star.mart_checkins(spark, sf_dir), _extent(spark, sf_dir))


def weekly_tip_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    businesses = star.dim_businesses(spark, sf_dir)
    return tip_measures(businesses, star.mart_tips(spark, sf_dir), _extent(spark, sf_dir))


def weekly_business_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weekly_business(star.dim_businesses(spark, sf_dir), *_mart_facts(spark, sf_dir))


def weekly_business_aggregate_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weekly_business(star.dim_businesses(spark, sf_dir), *_mart_facts(spark, sf_dir), fill_idle_weeks=True)


def mart_survives_failed_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart is published, then a rebuild of it with the idle weeks filled fails in the middle. Readers still have it."""
    path = fresh_path(spark, "mart")
    overwrite_table(weekly_business_aggregate(spark, sf_dir), path)
    filled = weekly_business_aggregate_filled(spark, sf_dir)
    breaks = F.when(F.col("business_id") % 7 == 3, F.raise_error(F.lit("broken off")).cast("bigint")).otherwise(F.col("business_id"))
    try:
        overwrite_table(filled.withColumn("business_id", breaks), path)
        raise AssertionError("the rebuild did not fail")
    except SparkRuntimeException:
        return read_table(spark, path)


def facts_in_balanced_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tips of both loads published by their week, in files sized by bytes; read back from all partitions."""
    path = fresh_path(spark, "balanced")
    tips = star.mart_tips(spark, sf_dir).withColumn("week", F.date_trunc("week", "tips_date").cast("date"))
    replace_partitions(tips, path, ["week"], files="balanced")
    return read_table(spark, path).groupBy(F.col("week").cast("date").alias("week")).agg(F.count(F.lit(1)).alias("tips"))


def two_loads_to_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON landing, bronze, dimensions, facts and mart on disk, for two loads in a row."""
    lake, lines = Lake(fresh_path(spark, "lake")), _stored_lines(spark, sf_dir)
    landings = {n: fresh_path(spark, "landing") for n in (1, 2)}
    jobs = []
    for n, landing in landings.items():
        early = F.lit(n > 1) | (F.col("date") < F.lit(star.FIRST_SNAPSHOT_ENDS.isoformat()))
        entities = {
            "review": star.raw_reviews(spark, sf_dir, lines).filter(early),
            "tip": star.raw_tips(spark, sf_dir).filter(early),
            "checkin": star.raw_checkins(spark, sf_dir),
            "user": star.raw_users(spark, sf_dir, n),
            "business": star.raw_businesses(spark, sf_dir, n),
        }
        jobs += [partial(_land, rows, landing, name) for name, rows in entities.items()]
    run_jobs(spark, jobs, workers=4)
    drop(lines)
    for n, landing in landings.items():
        run_load(spark, lake, star.LOADS[n], landing, workers=4)
    return read_table(spark, lake.gold())


QUERIES: dict[str, Query] = {
    "stamp_load_metadata": stamp_load_metadata,
    "rename_and_cast_mapping": rename_and_cast_mapping,
    "nested_field_projection": nested_field_projection,
    "nested_map_projection": nested_map_projection,
    "json_entity_round_trip": json_entity_round_trip,
    "bronze_partition_round_trip": _bronze_orders,
    "scan_or_empty_first_load": scan_or_empty_first_load,
    "incremental_since_load": incremental_since_load,
    "changed_rows_null_safe": changed_rows_null_safe,
    "changed_rows_null_sentinels": changed_rows_null_sentinels,
    "latest_per_key": latest_event_per_user,
    "rejected_keys": rejected_business_keys,
    "scd2_unaffected": scd2_unaffected,
    "scd2_new_keys": scd2_new_keys,
    "scd2_expired": scd2_expired,
    "surrogate_assignment": surrogate_assignment,
    "scd2_merge_first_load": lambda spark, sf_dir: _merged_businesses(spark, sf_dir, 1),
    "scd2_merge_second_load": lambda spark, sf_dir: _merged_businesses(spark, sf_dir, 2),
    "scd2_merge_third_load": lambda spark, sf_dir: _merged_businesses(spark, sf_dir, 3),
    "scd2_merge_users": scd2_merge_users,
    "scd2_merge_composite_key": scd2_merge_composite_key,
    "scd2_publish_round_trip": scd2_publish_round_trip,
    "lookup_effective_single": lookup_effective_single,
    "lookup_effective_two": lookup_effective_two,
    "explode_csv_dates": explode_csv_dates,
    "rejected_dates": rejected_checkin_dates,
    "fact_checkins": fact_checkins_of_load,
    "fact_reviews": fact_reviews_of_load,
    "fact_tips": fact_tips_of_load,
    "fact_dynamic_overwrite": fact_dynamic_overwrite,
    "latest_load_filter": latest_load_filter,
    "date_extent_union": _extent,
    "week_spine": weeks,
    "business_week_spine": business_week_spine,
    "weekly_review_measures": weekly_review_measures,
    "weekly_checkin_measures": weekly_checkin_measures,
    "weekly_tip_measures": weekly_tip_measures,
    "weekly_business_aggregate": weekly_business_aggregate,
    "weekly_business_aggregate_filled": weekly_business_aggregate_filled,
    "bronze_keeps_extra_fields": bronze_keeps_extra_fields,
    "load_quality": load_quality,
    "fact_reviews_several_loads": fact_reviews_several_loads,
    "empty_rerun_clears_load": empty_rerun_clears_load,
    "scd2_publish_resumed": scd2_publish_resumed,
    "scd2_two_runs_interleaved": scd2_two_runs_interleaved,
    "scd2_read_while_published": scd2_read_while_published,
    "mart_survives_failed_write": mart_survives_failed_write,
    "facts_in_balanced_files": facts_in_balanced_files,
    "scd2_merge_same_day": scd2_merge_same_day,
    "scd2_merge_null_sentinels": scd2_merge_null_sentinels,
    "two_loads_to_mart": two_loads_to_mart,
}
