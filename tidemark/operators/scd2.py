"""Slowly changing dimensions, type 2: a declarative merge of one load into a versioned table."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.durable import materialise
from tidemark.functions.changes import attrs_differ
from tidemark.load import LOAD_ID, LoadContext
from tidemark.operators.keys import dense_number, drop_null_keys, highest, lay_out, require_unique
from tidemark.specs import DIGEST, EFFECTIVE_FROM, EFFECTIVE_TO, IS_CURRENT, OPEN_END, DimSpec

_KNOWN, _SINCE, _IN_PLACE, _NUMBER, _RETIRED = "_known", "_since", "_in_place", "_number", "_retired"


def _old(name: str) -> str:
    return f"_old_{name}"


def current_rows(dim: DataFrame) -> DataFrame:
    """Versions that are valid now."""
    return dim.filter(F.col(IS_CURRENT))


def _load_id(load: LoadContext) -> Column:
    return F.lit(load.load_id).cast(T.IntegerType())


def _opened(load: LoadContext) -> dict[str, Column]:
    """Technical columns of a version that this load opens."""
    return {
        LOAD_ID: _load_id(load),
        EFFECTIVE_FROM: F.lit(load.load_date),
        EFFECTIVE_TO: F.lit(OPEN_END),
        IS_CURRENT: F.lit(True),
    }


def _match(current: DataFrame, increment: DataFrame, spec: DimSpec, null_sentinels: bool) -> DataFrame:
    """Each increment row beside the current version of its key, with what tells new, changed and same apart.

    Where the dimension brings its digests, they stand for the attributes, which are then neither read nor shuffled here.
    Sentinels make unequal attributes count as equal, so they need the attributes themselves."""
    by_digest = DIGEST in current.columns and not null_sentinels
    compared = [DIGEST] if by_digest else spec.attribute_names
    live = current_rows(current).select(
        *[F.col(c).alias(_old(c)) for c in (*spec.surrogates, *spec.key_names, *compared)],
        F.col(EFFECTIVE_FROM).alias(_SINCE),
        F.lit(True).alias(_KNOWN),
    )
    matched = increment.join(live, [F.col(k) == F.col(_old(k)) for k in spec.key_names], "left")
    if by_digest:
        differs = ~spec.digest().eqNullSafe(F.col(_old(DIGEST)))
    else:
        pairs = [(F.col(f.name), F.col(_old(f.name)), f.dtype) for f in spec.attributes]
        differs = attrs_differ(pairs, null_sentinels)
    return matched.withColumns({_KNOWN: F.coalesce(F.col(_KNOWN), F.lit(False)), "_differs": differs})


def changed_rows(
    current: DataFrame, increment: DataFrame, spec: DimSpec, null_sentinels: bool = False
) -> DataFrame:
    """Increment rows whose current version differs in any attribute, with the surrogates of that version."""
    matched = _match(current, increment, spec, null_sentinels).filter(F.col(_KNOWN) & F.col("_differs"))
    return matched.select(
        *[F.col(_old(s)).alias(s) for s in spec.surrogates], *spec.key_names, *spec.attribute_names
    )


def new_key_rows(current: DataFrame, increment: DataFrame, spec: DimSpec) -> DataFrame:
    """Increment rows whose key has no current version."""
    return increment.join(current_rows(current).select(*spec.key_names), spec.key_names, "left_anti")


def expired_rows(current: DataFrame, changed: DataFrame, spec: DimSpec, load: LoadContext) -> DataFrame:
    """Current versions that the changed rows replace, closed on the day before the load."""
    keys = list(spec.surrogates)
    return _closed(current_rows(current).join(changed.select(*keys), keys, "left_semi"), load).select(*spec.columns)


def unaffected_rows(current: DataFrame, changed: DataFrame, spec: DimSpec) -> DataFrame:
    """All versions, current or not, that the changed rows leave as they are."""
    keys = list(spec.surrogates)
    return current.join(changed.select(*keys), keys, "left_anti").select(*spec.columns)


def _closed(versions: DataFrame, load: LoadContext, when: Column | None = None) -> DataFrame:
    closed = {
        LOAD_ID: _load_id(load),
        EFFECTIVE_TO: F.lit(load.load_date - timedelta(days=1)),
        IS_CURRENT: F.lit(False),
    }
    if when is not None:
        closed = {name: F.when(when, value).otherwise(F.col(name)) for name, value in closed.items()}
    return versions.withColumns(closed)


def scd2_delta(
    current: DataFrame,
    increment: DataFrame,
    spec: DimSpec,
    load: LoadContext,
    null_sentinels: bool = False,
    marks: Mapping[str, int] | None = None,
    digests: bool = False,
) -> DataFrame:
    """The versions that a load opens, keeps current or closes: all that has to be written again.

    ``increment`` holds one row per natural key, conformed to ``spec``; a second row fails the job. Rows
    without a whole key are dropped (count them with ``rejected_keys``). A key that changes again on the day its version began keeps its surrogate
    and is replaced in place; a load dated before the version fails. Versions already closed on the same day
    are part of the result, so that it can replace that day's partition. The call stores the changed rows,
    so it runs jobs; the result itself is lazy.

    ``marks`` are the largest surrogates in use; without them a column of all history is read. With ``digests`` the result
    has the digest of each version's attributes too, and a dimension that brings them is matched by them.
    """
    columns = [*spec.columns, DIGEST] if digests else spec.columns
    started_later = F.col(_SINCE) > F.lit(load.load_date)
    refused = F.raise_error(F.lit(f"{spec.table}: load date {load.load_date} is before the current version"))
    in_place = (
        F.when(~F.col(_KNOWN), F.lit(False))
        .when(started_later, refused.cast("boolean"))
        .otherwise(F.col(_SINCE) == F.lit(load.load_date))
    )
    arriving = require_unique(drop_null_keys(increment, spec.key_names), spec.key_names)
    arriving = (
        _match(current, arriving, spec, null_sentinels)
        .filter(~F.col(_KNOWN) | F.col("_differs"))
        .withColumn(_IN_PLACE, in_place)
        .select(
            *spec.key_names,
            *spec.attribute_names,
            *[_old(s) for s in spec.surrogates],
            _IN_PLACE,
        )
    )
    # Stored before it is laid out, since range partitioning reads its input twice (first to sample it), and
    # the join behind these few rows is the dear part. The laid-out rows are stored as well: numbering, the
    # new versions and the retirement of old ones all see the same ones.
    stored = lay_out(materialise(arriving, "arriving"), spec.key_names, skip=F.col(_IN_PLACE))

    fresh = dense_number(stored, _NUMBER).withColumns(
        {
            s: F.when(F.col(_IN_PLACE), F.col(_old(s))).otherwise(
                F.col(_NUMBER) + (highest(current, s) if marks is None else F.lit(marks.get(s, 0)))
            )
            for s in spec.surrogates
        }
    )
    opened = fresh.withColumns(_opened(load) | {DIGEST: spec.digest()}).select(*columns)
    if digests and DIGEST not in current.columns:
        current = current.withColumn(DIGEST, spec.digest())

    # Joined on the surrogates alone: as a rule few, so that Spark can broadcast them by their known size.
    retired = stored.filter(F.col(_old(spec.surrogates[0])).isNotNull()).select(
        *[F.col(_old(s)).alias(s) for s in spec.surrogates], F.col(_IN_PLACE).alias(_RETIRED)
    )
    kept = current_rows(current).join(retired, list(spec.surrogates), "left")
    kept = kept.filter(~F.coalesce(F.col(_RETIRED), F.lit(False)))
    kept = _closed(kept, load, when=F.col(_RETIRED).isNotNull()).select(*columns)

    closed_today = _history(current).filter(_closed_by(load)).select(*columns)
    return opened.unionByName(kept).unionByName(closed_today)


def _history(dim: DataFrame) -> DataFrame:
    return dim.filter(~F.col(IS_CURRENT))


def _closed_by(load: LoadContext) -> Column:
    return F.col(EFFECTIVE_TO) == F.lit(load.load_date - timedelta(days=1))


def scd2_merge(
    current: DataFrame,
    increment: DataFrame,
    spec: DimSpec,
    load: LoadContext,
    null_sentinels: bool = False,
) -> DataFrame:
    """The whole next state of the dimension: :func:`scd2_delta` and the history it leaves alone."""
    untouched = _history(current).filter(~_closed_by(load)).select(*spec.columns)
    return scd2_delta(current, increment, spec, load, null_sentinels).unionByName(untouched)
