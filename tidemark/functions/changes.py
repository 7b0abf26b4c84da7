"""Null-tolerant change tests."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What NULL counts as, per type, when the sentinel mode is asked for.
NULL_SENTINELS: dict[type[T.DataType], object] = {
    T.StringType: "",
    T.BooleanType: False,
    T.IntegerType: 0,
    T.LongType: 0,
    T.FloatType: 1.0,
    T.DoubleType: 1.0,
    T.DateType: date(9999, 12, 31),
}


def null_as_sentinel(column: Column, dtype: T.DataType) -> Column:
    """The column with NULL read as the sentinel of its type."""
    if type(dtype) not in NULL_SENTINELS:
        raise TypeError(f"no NULL sentinel for {dtype.simpleString()}")
    return F.coalesce(column, F.lit(NULL_SENTINELS[type(dtype)]).cast(dtype))


def attrs_differ(
    pairs: Iterable[tuple[Column, Column, T.DataType]], null_sentinels: bool = False
) -> Column:
    """True when any pair of attributes differs.

    By default NULL equals only NULL. With ``null_sentinels`` NULL also equals the sentinel of its type.
    """

    def differ(left: Column, right: Column, dtype: T.DataType) -> Column:
        if null_sentinels:
            return null_as_sentinel(left, dtype) != null_as_sentinel(right, dtype)
        return ~left.eqNullSafe(right)

    return reduce(or_, [differ(*pair) for pair in pairs], F.lit(False))
