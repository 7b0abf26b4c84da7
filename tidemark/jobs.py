"""Command line of the lake, for ``spark-submit``.

    spark-submit tidemark/jobs.py all --root hdfs:///lake --landing hdfs:///landing \\
        --ctl_loading 2 --ctl_loading_date 2001-12-08
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from tidemark.entities import DIM_BUSINESSES, DIM_USERS, FILE_PREFIX, RAW_FIELDS
from tidemark.load import LoadContext
from tidemark.plans.lake import FACTS, MART, Lake, build_dimensions, build_facts, build_mart, ingest_load, run_load

DIMS = {spec.table: spec for spec in (DIM_BUSINESSES, DIM_USERS)}
TABLES = {"bronze": list(RAW_FIELDS), "silver": [*DIMS, *FACTS], "gold": [MART], "all": []}
STEPS = ("bronze", "silver", "gold", "all")


def file_count(text: str) -> int | str:
    return text if text == "balanced" else int(text)


def arguments(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tidemark.jobs")
    parser.add_argument("step", choices=STEPS)
    parser.add_argument("--root", required=True, help="folder of the lake")
    parser.add_argument("--landing", help="folder of the raw entities (bronze and all)")
    parser.add_argument("--ctl_loading", required=True)
    parser.add_argument("--ctl_loading_date", required=True)
    parser.add_argument("--prefix", default=FILE_PREFIX, help="what precedes the entity in file names")
    parser.add_argument("--workers", type=int, default=1, help="jobs to overlap")
    parser.add_argument("--table", action="append", default=[], help="only this entity or table of the step; repeatable")
    parser.add_argument("--after_load", type=int, help="silver: take all loads after this one, not the load alone")
    parser.add_argument("--null_sentinels", action="store_true", help="silver: compare NULL as '', 1.0, 0 and so on")
    parser.add_argument("--fill_idle_weeks", action="store_true", help="gold: 0 and carried totals in idle weeks")
    parser.add_argument("--files", type=file_count, help="files per table written, or 'balanced': sized by their bytes")
    chosen = parser.parse_args(argv)
    for table in chosen.table:
        if table not in TABLES[chosen.step]:
            parser.error(f"--table {table}: {chosen.step} has {', '.join(TABLES[chosen.step]) or 'no single tables'}")
    if chosen.step == "all" and chosen.after_load is not None:
        parser.error("--after_load belongs to silver")
    if chosen.step in ("bronze", "all") and not chosen.landing:
        parser.error("--landing is needed to ingest")
    return chosen


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    chosen = arguments(argv)
    spark = spark or SparkSession.builder.appName(f"tidemark-{chosen.step}").getOrCreate()
    lake = Lake(chosen.root, chosen.prefix)
    load = LoadContext.parse(chosen.ctl_loading, chosen.ctl_loading_date)
    workers, files, tables = chosen.workers, chosen.files, chosen.table
    if chosen.step == "bronze":
        ingest_load(spark, lake, load, chosen.landing, workers, files, tables)
    elif chosen.step == "silver":
        dims = [spec for name, spec in DIMS.items() if not tables or name in tables]
        facts = [name for name in FACTS if not tables or name in tables]
        build_dimensions(spark, lake, load, dims, workers, chosen.after_load, chosen.null_sentinels, files)
        build_facts(spark, lake, load, chosen.after_load, workers, files, facts)
    elif chosen.step == "gold":
        build_mart(spark, lake, chosen.fill_idle_weeks, files)
    else:
        run_load(
            spark, lake, load, chosen.landing, workers, chosen.null_sentinels, chosen.fill_idle_weeks, files
        )


if __name__ == "__main__":
    main()
