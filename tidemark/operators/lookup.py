"""Effective-dated dimension lookup with an unknown member."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.specs import EFFECTIVE_FROM, EFFECTIVE_TO, DimSpec

# Fixed value: the surrogate of a member that the dimension does not know.
UNKNOWN_MEMBER = -1


def valid_on(dim: DataFrame, day: date) -> DataFrame:
    """Versions whose validity covers the day; both ends belong to it."""
    return dim.filter(F.lit(day).between(F.col(EFFECTIVE_FROM), F.col(EFFECTIVE_TO)))


def lookup_effective(
    rows: DataFrame, dim: DataFrame, spec: DimSpec, on: dict[str, str], as_of: date, surrogate: str | None = None
) -> DataFrame:
    """Add the surrogate of the version valid on ``as_of``, or the unknown member.

    ``on`` maps columns of ``rows`` to natural keys of the dimension. The columns of ``rows`` in it are
    replaced by the surrogate. The validity test narrows the dimension before the join, which is then a
    plain equi join on at most one version per key: broadcast where its size allows, else a sort-merge join
    whose hot keys adaptive execution splits on the row side.
    """
    surrogate = surrogate or spec.surrogates[0]
    members = valid_on(dim, as_of).select(
        *[F.col(nk).alias(f"_nk_{nk}") for nk in on.values()], F.col(surrogate).alias("_member")
    )
    matches = [F.col(column) == F.col(f"_nk_{nk}") for column, nk in on.items()]
    found = rows.join(members, matches, "left")
    found = found.withColumn("_member", F.coalesce(F.col("_member"), F.lit(UNKNOWN_MEMBER).cast("long")))
    return found.drop(*on, *[f"_nk_{nk}" for nk in on.values()]).withColumnRenamed("_member", surrogate)
