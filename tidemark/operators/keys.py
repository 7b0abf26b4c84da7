"""Natural-key hygiene and surrogate numbering."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.durable import materialise

# Fixed value: monotonically_increasing_id() keeps the row position in the lower 33 bits, the partition above.
POSITION_BITS = 33

_SLOT, _PART, _BEFORE, _NUMBER, _SKIP = "_slot", "_part", "_before", "_number", "_skip"


def has_keys(keys: Sequence[str]) -> Column:
    return reduce(and_, [F.col(k).isNotNull() for k in keys])


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with a whole natural key."""
    return df.filter(has_keys(keys))


def rejected_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number of rows with a NULL in the natural key; reads the key columns only."""
    return df.agg(F.count_if(~has_keys(keys)).alias("rejected"))


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column], ties: str = "first") -> DataFrame:
    """The first row per key in the given order.

    With ``ties="keep"`` all rows that share the first place stay, so that a later check can refuse them.
    Spark ranks within each task before the shuffle, so a hot key sends one row per task.
    """
    if ties not in ("first", "keep"):
        raise ValueError(f"ties must be 'first' or 'keep', got {ties!r}")
    rank = F.row_number() if ties == "first" else F.rank()
    ranked = df.withColumn("_rank", rank.over(Window.partitionBy(*keys).orderBy(*order_by)))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Pass rows through, failing the job at the second row of a key."""
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
    message = F.concat(F.lit("more than one row for key "), F.to_json(F.struct(*keys)))
    unique = F.when(F.col("_nth") > 1, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    return df.withColumn("_nth", nth).filter(unique).drop("_nth")


def lay_out(df: DataFrame, order_by: Sequence[str], skip: Column | None = None) -> DataFrame:
    """Store the rows range-partitioned by the order, each with its slot (partition and position).

    Rows under ``skip`` get no number; they are stored behind the others of their partition.
    """
    skip = F.lit(False) if skip is None else skip
    ordered = (
        df.withColumn(_SKIP, skip)
        .repartitionByRange(*order_by)
        .sortWithinPartitions(_SKIP, *order_by)
        .withColumn(_SLOT, F.monotonically_increasing_id())
    )
    return materialise(ordered, "slots")


def dense_number(laid_out: DataFrame, name: str) -> DataFrame:
    """Number laid-out rows 1, 2, 3, … in their order: rows in earlier partitions plus own position.

    Only the row count per partition is moved. It has one row per shuffle partition, a number set by the
    session and not by the data, so it is safe to rank in one task and to broadcast.
    """
    part = F.shiftrightunsigned(F.col(_SLOT), POSITION_BITS)
    position = F.col(_SLOT).bitwiseAND(F.lit((1 << POSITION_BITS) - 1))
    sizes = laid_out.filter(~F.col(_SKIP)).groupBy(part.alias(_PART)).agg(F.count("*").alias("_rows"))
    earlier = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(_PART, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias(_BEFORE))
    numbered = laid_out.withColumn(_PART, part).join(F.broadcast(offsets), _PART, "left")
    number = F.when(~F.col(_SKIP), F.col(_BEFORE) + position + 1)
    return numbered.withColumn(name, number).drop(_SLOT, _PART, _BEFORE, _SKIP)


def highest(dim: DataFrame, surrogate: str) -> Column:
    """The largest surrogate in use (0 in an empty dimension), as a subquery of the plan that uses it."""
    return dim.select(F.coalesce(F.max(surrogate), F.lit(0)).alias("highest")).scalar()


def assign_surrogates(
    df: DataFrame, surrogates: Sequence[str], order_by: Sequence[str], existing: DataFrame | None = None
) -> DataFrame:
    """Give each row fresh surrogates in the order of ``order_by``, above those in ``existing``.

    Equals ``row_number() over (order by …) + max(existing)`` without drawing all rows into one task.
    """
    numbered = dense_number(lay_out(df, order_by), _NUMBER)
    return numbered.withColumns(
        {s: F.col(_NUMBER) + (F.lit(0) if existing is None else highest(existing, s)) for s in surrogates}
    ).drop(_NUMBER)
