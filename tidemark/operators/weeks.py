"""A dense calendar of weeks, and per-member weekly and running sums on it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.dates import DAYS_PER_WEEK, week_start, weeks_between

START, END = "start_week_date", "end_week_date"

# Fixed value: the last week of the calendar stays open up to this day.
LAST_WEEK_END = date(5999, 12, 30)

CALENDAR = "_calendar"
FIRST, LAST = f"{CALENDAR}.first", f"{CALENDAR}.last"
_WEEK, _NEXT = "_week", "_next"


def date_extent(*dated: tuple[DataFrame, str]) -> DataFrame:
    """One row with the smallest and the largest date over all given (rows, date column) pairs."""
    days = reduce(DataFrame.unionByName, [df.select(F.col(day).alias("day")) for df, day in dated])
    return days.agg(F.min("day").alias("min_date"), F.max("day").alias("max_date"))


def with_calendar(members: DataFrame, extent: DataFrame) -> DataFrame:
    """Each member with the first and last Monday of the extent, as one scalar subquery."""
    bounds = F.struct(
        week_start(F.col("min_date")).alias("first"), week_start(F.col("max_date")).alias("last")
    )
    return members.withColumn(CALENDAR, extent.select(bounds.alias(CALENDAR)).scalar())


def _week_end(start: Column, last: Column) -> Column:
    return F.when(start == last, F.lit(LAST_WEEK_END)).otherwise(F.date_add(start, DAYS_PER_WEEK - 1))


def week_spine(extent: DataFrame) -> DataFrame:
    """Every week of an extent as a closed interval; no rows when the extent has no date."""
    first, last = week_start(F.col("min_date")), week_start(F.col("max_date"))
    weeks = extent.select(F.explode(weeks_between(first, last)).alias(START), last.alias("_last"))
    return weeks.select(START, _week_end(F.col(START), F.col("_last")).alias(END))


def member_weeks(members: DataFrame, extent: DataFrame) -> DataFrame:
    """Every member in every week, made row by row: neither a join nor a shuffle."""
    weeks = with_calendar(members, extent).withColumn(START, F.explode(weeks_between(F.col(FIRST), F.col(LAST))))
    return weeks.withColumn(END, _week_end(F.col(START), F.col(LAST))).drop(CALENDAR)


def weekly_sums(rows: DataFrame, key: str, day: str, sums: Mapping[str, Column]) -> DataFrame:
    """Sums per member and week. Spark adds up within each task first, so a hot member stays small."""
    dated = rows.filter(F.col(day).isNotNull())
    return dated.groupBy(F.col(key), week_start(F.col(day)).alias(_WEEK)).agg(
        *[F.sum(value).alias(name) for name, value in sums.items()]
    )


def dense_weekly(
    members: DataFrame, key: str, activity: DataFrame, extent: DataFrame, names: Sequence[str]
) -> DataFrame:
    """Weekly and running sums for every member in every week of the extent.

    ``activity`` holds at most one row per member and week (see :func:`weekly_sums`) with the summed
    columns ``names``; the extent covers its days. The result has the members' columns, the week, and per
    name ``weekly_<name>`` and ``aggregated_<name>``, 0 where nothing happened (yet).

    Running sums are taken over the active weeks alone and each row is then spread over the idle weeks up to
    the next active one. So the members × weeks rows are made last, in place, and are never shuffled, sorted
    or joined; a member's group is bounded by the length of the calendar.
    """
    by_week = Window.partitionBy(key).orderBy(_WEEK)
    so_far = by_week.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    spread = with_calendar(members, extent).join(activity, key, "left").withColumns(
        {f"_run_{name}": F.sum(name).over(so_far) for name in names}
        | {"_previous": F.lag(_WEEK).over(by_week), _NEXT: F.lead(_WEEK).over(by_week)}
    )
    begin = F.when(F.col("_previous").isNull(), F.col(FIRST)).otherwise(F.col(_WEEK))
    until = F.coalesce(F.date_sub(F.col(_NEXT), DAYS_PER_WEEK), F.col(LAST))
    dense = spread.withColumn(START, F.explode(weeks_between(begin, until)))

    active, begun = F.col(START) == F.col(_WEEK), F.col(START) >= F.col(_WEEK)
    zero = F.lit(0)
    return dense.select(
        *[F.col(c) for c in members.columns],
        START,
        _week_end(F.col(START), F.col(LAST)).alias(END),
        *[F.when(active, F.coalesce(F.col(n), zero)).otherwise(zero).alias(f"weekly_{n}") for n in names],
        *[
            F.when(begun, F.coalesce(F.col(f"_run_{n}"), zero)).otherwise(zero).alias(f"aggregated_{n}")
            for n in names
        ],
    )
