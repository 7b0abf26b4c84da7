"""Selecting loads of a fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.load import LOAD_DATE


def latest_load(fact: DataFrame) -> DataFrame:
    """Rows of the fact's newest load date. The maximum is a scalar subquery, so it prunes partitions."""
    return fact.filter(F.col(LOAD_DATE) == fact.select(F.max(LOAD_DATE).alias("newest")).scalar())
