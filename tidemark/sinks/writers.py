"""Writes. The overwrite mode is set per write, never on the session."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidemark import files as folders
from tidemark import versions
from tidemark.load import LOAD_DATE, LOAD_ID, LoadContext
from tidemark.specs import DIGEST, EFFECTIVE_TO, IS_CURRENT

#: How the rows of a dimension lie.
DIMENSION = (IS_CURRENT, EFFECTIVE_TO)


def _spread(df: DataFrame, files: int | str | None, partition_by: Sequence[str] = ()) -> DataFrame:
    """Nothing is shuffled unless files are asked for: a number of them, or ``"balanced"`` ones, which adaptive execution
    sizes by bytes, a hot partition in several and small ones together."""
    if files is None:
        return df
    return df.hint("rebalance", *[F.col(c) for c in partition_by]) if files == "balanced" else df.repartition(files)


def replace_partitions(
    df: DataFrame, path: str, partition_by: Sequence[str], fmt: str = "parquet", files: int | str | None = None
) -> None:
    """Replace exactly the partitions that occur in ``df``, at commit time.

    Spark writes beside the table and swaps the partition folders when the job commits, so the table
    may be read by the very plan that replaces it, and a job that fails before its commit leaves it as it was.
    A commit that breaks off may leave some folders swapped and some not; tables for which that matters are published
    by version (:mod:`tidemark.versions`).
    """
    (
        _spread(df, files, partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(*partition_by)
        .format(fmt)
        .save(path)
    )


def _of_load(df: DataFrame, column: str, value: object) -> DataFrame:
    """Rows of one load, said once more by a constant: Spark does not see through the observation that the stamp is one,
    and would sort all rows by it before it writes the partition."""
    return df.withColumn(column, F.lit(value))


def replace_load(
    df: DataFrame,
    path: str,
    column: str,
    value: object,
    fmt: str = "parquet",
    files: int | str | None = None,
    rows: Callable[[], int] | None = None,
) -> None:
    """Replace the one partition of a load, also by nothing: without rows no folder remains.

    The rows are counted while they are written; ``rows`` tells their number if someone counts them already.
    """
    if rows is None:
        written = Observation()
        df, rows = df.observe(written, F.count(F.lit(1)).alias("rows")), lambda: written.get["rows"]
    replace_partitions(_of_load(df, column, value), path, [column], fmt, files)
    if not rows():
        folders.remove(df.sparkSession, f"{path}/{column}={value}")


def write_bronze(
    df: DataFrame, path: str, load: LoadContext, files: int | str | None = None, rows: Callable[[], int] | None = None
) -> None:
    """Raw rows as ORC, one partition per load; other loads stay."""
    replace_load(df, path, LOAD_ID, load.load_id, "orc", files, rows)


def publish_dimension(
    df: DataFrame,
    path: str,
    files: int | str | None = None,
    base: versions.Version | None = None,
    highest: Mapping[str, int] | None = None,
) -> versions.Version:
    """Publish dimension rows by current flag and end of validity, as the next version of the table.

    All current rows share one open end, and a load closes rows at one date only. A load thus replaces the current
    partition and the one it closes; older history is neither rewritten nor read. ``base`` is the version from which the
    rows were made (if none is given, the newest). ``highest``, the largest surrogates in use before, is noted for the next
    load with those that the rows bring.
    """
    base = base or versions.live(df.sparkSession, path)
    seen = Observation()
    counted = df.observe(seen, *[F.max(s).alias(s) for s in highest]) if highest else df

    def notes() -> dict:
        marks = {s: max(n, seen.get[s] or 0) for s, n in highest.items()} if highest else {}
        return {"highest": marks, "digests": DIGEST in df.columns}

    return versions.publish(_spread(counted, files, DIMENSION), path, DIMENSION, base, notes)


def publish_fact(df: DataFrame, path: str, load: LoadContext, files: int | str | None = None) -> None:
    """Publish one load's snapshot of a fact; running the load again replaces it, with rows or without."""
    replace_load(df, path, LOAD_DATE, load.load_date, files=files)


def overwrite_table(df: DataFrame, path: str, files: int | str | None = None) -> versions.Version:
    """Replace a whole table by a next version: readers have the one before it until then, and keep it if this fails."""
    spark = df.sparkSession
    base = versions.live(spark, path)
    version = versions.publish(_spread(df, files), path, base=base)
    if base is None:  # what lay there without a pointer
        for name in folders.children(spark, path):
            if name != versions.POINTERS and not name.startswith(f"{versions.RUN}="):
                folders.remove(spark, f"{path}/{name}")
    return version
