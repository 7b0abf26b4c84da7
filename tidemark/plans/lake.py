"""The lake end to end: landing → bronze → dimensions → facts → mart, one load at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor, as_completed
from dataclasses import dataclass
from datetime import date
from functools import reduce
from operator import or_

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import versions
from tidemark.durable import scratch
from tidemark.entities import (
    DATE_FIELDS,
    DIM_BUSINESSES,
    DIM_USERS,
    FILE_PREFIX,
    KEY_FIELDS,
    entity_specs,
    raw_schema,
)
from tidemark.files import newest_partition
from tidemark.functions.dates import text_to_date
from tidemark.load import LOAD_COLUMNS, LOAD_DATE, LOAD_ID, LoadContext, stamp
from tidemark.operators.scd2 import scd2_delta
from tidemark.plans.facts import FACT_SCHEMAS, fact_checkins, fact_reviews, fact_tips
from tidemark.plans.mart import weekly_business
from tidemark.sinks.writers import (
    DIMENSION,
    overwrite_table,
    publish_dimension,
    publish_fact,
    replace_partitions,
    write_bronze,
)
from tidemark.sources.readers import EntityReader, empty_table, is_record, read_entity, read_table, since_load
from tidemark.specs import CORRUPT_RECORD, EXTRA_FIELDS, DimSpec, EntitySpec

MART = "weekly_business_aggregate"


@dataclass(frozen=True)
class Lake:
    """Where the layers live."""

    root: str
    prefix: str = FILE_PREFIX

    def bronze(self, entity: str) -> str:
        return f"{self.root}/bronze/{self.prefix}{entity}"

    def silver(self, table: str) -> str:
        return f"{self.root}/silver/{table}"

    def gold(self, table: str = MART) -> str:
        return f"{self.root}/gold/{table}"

    def quality(self) -> str:
        return f"{self.root}/quality/load_quality"


def run_jobs(spark: SparkSession, jobs: Iterable[Callable[[], None]], workers: int = 1) -> None:
    """Run independent Spark jobs; with several workers Spark overlaps them. The first failure is raised, and jobs that
    have not begun by then do not begin."""
    with ThreadPoolExecutor(max_workers=workers) as pool:
        begun = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
        try:
            for done in as_completed(begun):
                done.result()
        except BaseException:
            pool.shutdown(wait=True, cancel_futures=True)
            raise


QUALITY_SCHEMA = f"entity STRING, lines BIGINT, broken BIGINT, misfit BIGINT, null_keys BIGINT, bad_dates BIGINT, {LOAD_COLUMNS}"


def quality_counts(df: DataFrame, entity: str) -> list[Column]:
    """What is wrong with the landed rows of an entity: lines that are no JSON object, objects with fields that do not
    fit, objects without a key, and dates that are none (of a check-in, each one of its list)."""
    has = set(df.columns)
    record = is_record() if {CORRUPT_RECORD, EXTRA_FIELDS} <= has else F.lit(True)
    keys = [F.col(k).isNull() for k in KEY_FIELDS.get(entity, []) if k in has]
    day = DATE_FIELDS.get(entity)
    bad = F.lit(0)
    if day in has:

        def wrong(item: Column) -> Column:
            return (F.trim(item) != "") & text_to_date(F.trim(item)).isNull()

        if entity == "checkin":
            bad = F.when(F.col(day).isNotNull(), F.size(F.filter(F.split(F.col(day), ","), wrong))).otherwise(0)
        else:
            bad = F.when(wrong(F.col(day)), 1).otherwise(0)
    misfit = F.col(CORRUPT_RECORD).isNotNull() & record if CORRUPT_RECORD in has else F.lit(False)
    return [
        F.count(F.lit(1)).alias("lines"),
        F.count_if(~record).alias("broken"),
        F.count_if(misfit).alias("misfit"),
        F.count_if(record & reduce(or_, keys, F.lit(False))).alias("null_keys"),
        F.coalesce(F.sum(bad), F.lit(0)).cast("bigint").alias("bad_dates"),
    ]


def ingest(
    spark: SparkSession,
    specs: Sequence[EntitySpec],
    load: LoadContext,
    landing: str,
    bronze: str,
    reader: EntityReader = read_entity,
    workers: int = 1,
    files: int | str | None = None,
    prefix: str = FILE_PREFIX,
    quality: str | None = None,
) -> None:
    """Land raw entities as they are, stamped with the load, one bronze partition per load.

    With a folder for ``quality``, the counts of :func:`quality_counts` are taken while the rows are written, and kept
    there per load and entity.
    """

    def job(spec: EntitySpec) -> Callable[[], None]:
        entity = spec.name.removeprefix(prefix)

        def run() -> None:
            rows, counted = stamp(reader(spark, spec, landing), load), Observation()
            if quality:
                rows = rows.observe(counted, *quality_counts(rows, entity))
            write_bronze(rows, f"{bronze}/{spec.name}", load, files, (lambda: counted.get["lines"]) if quality else None)
            if quality:
                found = counted.get
                figures = spark.range(1).select(
                    F.lit(entity).alias("entity"), *[F.lit(n).cast("bigint").alias(name) for name, n in found.items()]
                )
                replace_partitions(stamp(figures, load), quality, [LOAD_ID, "entity"])

        return run

    run_jobs(spark, [job(spec) for spec in specs], workers)


def read_quality(spark: SparkSession, lake: Lake) -> DataFrame:
    return read_table(spark, lake.quality(), schema=QUALITY_SCHEMA)


def bronze_increment(
    spark: SparkSession, lake: Lake, entity: str, load: LoadContext, after_load: int | None = None
) -> DataFrame:
    """Bronze records of this load alone, or of all loads after ``after_load`` up to it; broken lines stay behind."""
    after = load.load_id - 1 if after_load is None else after_load
    schema = raw_schema(entity)
    for column in T.StructType.fromDDL(LOAD_COLUMNS):
        schema = schema.add(column)
    bronze = read_table(spark, lake.bronze(entity), "orc", schema)
    return since_load(bronze, after, load.load_id).filter(is_record())


def build_dimension(
    spark: SparkSession,
    lake: Lake,
    spec: DimSpec,
    load: LoadContext,
    after_load: int | None = None,
    null_sentinels: bool = False,
    files: int | str | None = None,
) -> None:
    """Merge the load into a dimension and publish the next version of its table.

    Over several loads the newest row per key counts; two rows of one key in the same load fail the job. If another run
    publishes meanwhile, this one fails with :class:`tidemark.versions.Conflict` and changes nothing.
    """
    path = lake.silver(spec.table)
    versions.adopt(spark, path, DIMENSION)
    with scratch(spark):
        raw = bronze_increment(spark, lake, spec.entity, load, after_load)
        if after_load is not None:
            raw = newest_rows(raw, [f.source for f in spec.keys])
        base = versions.live(spark, path)
        current, marks = standing(spark, path, base, spec)
        delta = scd2_delta(current, spec.conform(raw), spec, load, null_sentinels, marks, spec.digests)
        publish_dimension(delta, path, files, base, marks)


def standing(
    spark: SparkSession, path: str, base: versions.Version | None, spec: DimSpec
) -> tuple[DataFrame, dict[str, int]]:
    """A dimension as of a version, with its digests if it has them, and the largest surrogates in use: as noted with
    the version, or else by reading them."""
    if base is None:
        return empty_table(spark, spec.schema), dict.fromkeys(spec.surrogates, 0)
    schema = spec.stored_schema if spec.digests and base.notes.get("digests") else spec.schema
    current = versions.read(spark, path, base, schema=schema)
    marks = base.notes.get("highest") or {}
    if not set(spec.surrogates) <= marks.keys():
        marks = current.agg(*[F.coalesce(F.max(s), F.lit(0)).alias(s) for s in spec.surrogates]).first().asDict()
    return current, {s: marks[s] for s in spec.surrogates}


def newest_rows(raw: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Of each key the rows of the newest load that has it; NULL is a key like any other.

    The newest load of all stays whole and is not moved. Rows of older loads meet the keys alone of later ones, one
    row per key and task, so nothing wide is sorted before its shuffle.
    """
    load, key = F.col(LOAD_ID), F.struct(*keys)  # structs are equal also where both hold NULL
    newest = raw.select(F.max(load).alias("newest")).scalar()
    oldest = raw.select(F.min(load).alias("oldest")).scalar()
    later = raw.filter(load > oldest).groupBy(key.alias("_key")).agg(F.max(load).alias("_latest"))
    older = raw.filter(load < newest).join(later, (key == F.col("_key")) & (F.col("_latest") > load), "left_anti")
    return raw.filter(load == newest).unionByName(older)


def read_dimension(spark: SparkSession, lake: Lake, spec: DimSpec) -> DataFrame:
    return read_table(spark, lake.silver(spec.table), schema=spec.schema).select(*spec.columns)


def read_fact(spark: SparkSession, lake: Lake, table: str) -> DataFrame:
    return read_table(spark, lake.silver(table), schema=f"{FACT_SCHEMAS[table]}, {LOAD_COLUMNS}")


FACTS = ("fact_checkins", "fact_reviews", "fact_tips")


def build_facts(
    spark: SparkSession,
    lake: Lake,
    load: LoadContext,
    after_load: int | None = None,
    workers: int = 1,
    files: int | str | None = None,
    tables: Sequence[str] = FACTS,
) -> None:
    """Publish the load's snapshot of each fact; both dimensions of the load must be there.

    Over several loads (``after_load``) the newest row of a review and of a business's check-ins counts. A tip has no
    key by which two snapshots could be told apart: its fact is always that of the load itself.
    """

    def rows(entity: str, key: str) -> DataFrame:
        raw = bronze_increment(spark, lake, entity, load, after_load)
        return raw if after_load is None else newest_rows(raw, [key])

    businesses = read_dimension(spark, lake, DIM_BUSINESSES)
    users = read_dimension(spark, lake, DIM_USERS)
    facts = {
        "fact_checkins": lambda: fact_checkins(rows("checkin", "business_id"), businesses, load),
        "fact_reviews": lambda: fact_reviews(rows("review", "review_id"), businesses, users, load),
        "fact_tips": lambda: fact_tips(bronze_increment(spark, lake, "tip", load), businesses, users, load),
    }

    def job(table: str) -> Callable[[], None]:
        return lambda: publish_fact(facts[table](), lake.silver(table), load, files)

    run_jobs(spark, [job(table) for table in tables], workers)


def newest_fact(spark: SparkSession, lake: Lake, table: str) -> DataFrame:
    """A fact's newest load, found by the names of its folders; earlier loads are not opened."""
    newest = newest_partition(spark, lake.silver(table), LOAD_DATE)
    fact = read_fact(spark, lake, table)
    return fact if newest is None else fact.filter(F.col(LOAD_DATE) == F.lit(date.fromisoformat(newest)))


def build_mart(spark: SparkSession, lake: Lake, fill_idle_weeks: bool = False, files: int | str | None = None) -> None:
    """Rebuild the weekly mart from the current businesses and the newest load of each fact, and publish it as the next
    version: until then, and if the rebuild fails, readers have the one before."""
    facts = [newest_fact(spark, lake, table) for table in ("fact_reviews", "fact_checkins", "fact_tips")]
    mart = weekly_business(read_dimension(spark, lake, DIM_BUSINESSES), *facts, fill_idle_weeks)
    overwrite_table(mart, lake.gold(), files)


def run_load(
    spark: SparkSession,
    lake: Lake,
    load: LoadContext,
    landing: str,
    workers: int = 1,
    null_sentinels: bool = False,
    fill_idle_weeks: bool = False,
    files: int | str | None = None,
) -> None:
    """One whole load: ingest, dimensions, facts, mart."""
    ingest_load(spark, lake, load, landing, workers, files)
    build_dimensions(spark, lake, load, workers=workers, null_sentinels=null_sentinels, files=files)
    build_facts(spark, lake, load, workers=workers, files=files)
    build_mart(spark, lake, fill_idle_weeks, files)


def ingest_load(
    spark: SparkSession,
    lake: Lake,
    load: LoadContext,
    landing: str,
    workers: int = 1,
    files: int | str | None = None,
    entities: Sequence[str] = (),
) -> None:
    """Ingest all entities of the lake, or the named ones, with their quality counts."""
    specs = [s for s in entity_specs(lake.prefix) if not entities or s.name.removeprefix(lake.prefix) in entities]
    bronze = f"{lake.root}/bronze"
    ingest(spark, specs, load, landing, bronze, read_entity, workers, files, lake.prefix, lake.quality())


def build_dimensions(
    spark: SparkSession,
    lake: Lake,
    load: LoadContext,
    specs: Sequence[DimSpec] = (DIM_BUSINESSES, DIM_USERS),
    workers: int = 1,
    after_load: int | None = None,
    null_sentinels: bool = False,
    files: int | str | None = None,
) -> None:
    """Both dimensions, or the given ones, side by side."""

    def job(spec: DimSpec) -> Callable[[], None]:
        return lambda: build_dimension(spark, lake, spec, load, after_load, null_sentinels, files)

    run_jobs(spark, [job(spec) for spec in specs], workers)
