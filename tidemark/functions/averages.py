"""Averages as the marts publish them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

AVERAGE_TYPE = T.DecimalType(4, 2)


def average_or_null(total: Column, count: Column) -> Column:
    """Total by count, rounded half up to two places; NULL while there is nothing to average."""
    return F.when(count != 0, (total / count).cast(AVERAGE_TYPE))
