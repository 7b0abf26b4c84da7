"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

The words of a source form one stream, its documents in seeded hash order; the stream is cut into blocks of equally
many words and may be read up to ``cap`` times. Blocks are seats: seat k of a source with target t has the quotient
t / (2k + 1), the highest quotients win, and dealing the seats in that order gives every shard an integer quota of each
source. A shard's blocks of a source are those that follow the blocks of the shards before it, in the seeded order; so what
a document gives to each shard follows from its place in the stream, and no block is ever made a row.

Defined results: an empty table gives no rows; a NULL text has no words; a text of any length takes part whole; a NULL source
is a source of its own, last in order; a NULL id has a place in the stream like any other; a source without words has target 0;
repeated rows take part one by one, ties in the order of ids and sizes; columns named like an output column are replaced by it.
The windows over all sources are one task: meant for thousands of sources, not millions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.durable import materialise
from tidemark.llm.text import scale_bits, word_count

OUTPUT = ("size", "source_size", "target", "taken", "taken_by_shard")


def targets(sizes: DataFrame, cycle: tuple[int, ...] = (1, 2, 3), cap: int = 3) -> DataFrame:
    """(source, source_size) with weight and target words: shares by weight of the total of all sizes, held at ``cap``
    times the source's size, the excess shared out again by weight.

    In the order of cap / weight the capped sources come first, so the common level of the others is one division.
    The windows see one row per source.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    by_ratio = Window.orderBy("ratio", "place")
    level = (F.col("total") - F.coalesce(F.col("capped_before"), F.lit(0))) / F.col("weight_from")
    return (
        sizes.withColumn("place", F.row_number().over(order))
        .withColumn("weight", F.element_at(F.array(*map(F.lit, cycle)), (F.col("place") - 1) % len(cycle) + 1))
        .withColumn("most", F.col("source_size") * cap)
        .withColumn("ratio", F.col("most") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(Window.partitionBy()))
        .withColumn("capped_before", F.sum("most").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("weight_from", F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", F.max(F.when(level <= F.col("ratio"), level)).over(Window.partitionBy()))
        .withColumn("target", F.least(F.col("most").cast("double"), F.col("level") * F.col("weight")))
        .select("source", "source_size", "place", "weight", "target")
    )


def block_words(aims: DataFrame, blocks: int = 100, most: int = 4096) -> Column:
    """The smallest target holds ``blocks`` blocks, so that rounding to whole blocks moves no source by over 1 %."""
    smallest = F.min(F.when(F.col("target") > 0, F.col("target"))).over(Window.partitionBy())
    return F.greatest(F.lit(1), F.least(F.lit(most), F.floor(smallest / blocks))).cast("long")


def apportion(aims: DataFrame, shards: int = 8) -> DataFrame:
    """Quota of blocks per (source, shard), with the first block of the shard in the source's stream.

    Seats are dealt in the order of their quotients and each shard takes an equal run of seats. How many of the first R
    seats a source has is rounded(x * target) for the right x: a floor of x gives all but a few seats per source,
    and only the seats near the boundary are ranked (at most four per source and shard).
    """
    everything = Window.partitionBy()
    votes = (
        aims.withColumn("block", block_words(aims))
        .filter(F.col("target") > 0)
        .withColumn("votes", F.sum("target").over(everything))
        .withColumn("sources", F.count(F.lit(1)).over(everything))
        .withColumn("seats", F.greatest(F.lit(1), F.round(F.col("votes") / F.col("block"))).cast("long"))
        .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
        .withColumn("last", F.floor(F.col("seats") * (F.col("shard") + 1) / shards))
    )

    def held(at: Column) -> Column:
        return F.floor(F.greatest(at, F.lit(0.0)) / F.col("votes") * F.col("target") + 0.5).cast("long")

    near = votes.withColumn("sure", held(F.col("last") - 1.5 * F.col("sources"))).withColumn(
        "maybe", held(F.col("last") + 1.5 * F.col("sources"))
    )
    near = near.withColumn("open", F.col("last") - F.sum("sure").over(Window.partitionBy("shard")))
    by_quotient = Window.partitionBy("shard").orderBy(F.col("quotient").desc(), "place")
    won = (
        near.filter(F.col("maybe") > F.col("sure"))
        .withColumn("seat", F.explode(F.sequence(F.col("sure"), F.col("maybe") - 1)))
        .withColumn("quotient", F.col("target") / (2 * F.col("seat") + 1))
        .withColumn("rank", F.row_number().over(by_quotient))
        .filter(F.col("rank") <= F.col("open"))
        .groupBy("place", "shard")
        .agg(F.count(F.lit(1)).alias("won"))
    )
    in_order = Window.partitionBy("place").orderBy("shard")
    return (
        near.join(won, ["place", "shard"], "left")
        .withColumn("held", F.col("sure") + F.coalesce(F.col("won"), F.lit(0)))
        .withColumn("first_block", F.coalesce(F.lag("held").over(in_order), F.lit(0)))
        .select(
            "source", "place", "shard", "block", "target", "first_block", (F.col("held") - F.col("first_block")).alias("quota")
        )
    )


def mix(
    docs: DataFrame,
    cycle: tuple[int, ...] = (1, 2, 3),
    cap: int = 3,
    seed: int = 42,
    shards: int = 8,
    source_col: str = "source",
    id_col: str = "doc_id",
    size: Column | None = None,
    rows_per_part: int = 20_000,
) -> DataFrame:
    """Every row with ``size``, ``source_size``, ``target`` (its source's), ``taken``: the words that the mix takes of it,
    repeats counted, at most ``cap`` times its size, and ``taken_by_shard``: how many of them each shard takes. ``size``
    defaults to the words of column ``text``.

    A stream is cut by hash range into parts, each of which is summed for itself; part totals give the offsets. A
    source with most of the rows is thereby many parts.
    """
    kept = [c for c in docs.columns if c.lower() not in OUTPUT]
    rows = materialise(
        docs.select(
            F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"),
            F.col(source_col).cast("string").alias("source"),
            F.coalesce(word_count(F.col("text")) if size is None else size.cast("long"), F.lit(0)).alias("size"),
            F.xxhash64(F.lit(seed), F.col(id_col)).alias("key"),
        ),
        "mix-rows",
    )
    bits = scale_bits(rows.count(), rows_per_part, 6, 16)
    rows = rows.withColumn("part", F.shiftrightunsigned(F.xxhash64("key", "size"), 64 - bits).cast("int"))
    parts = materialise(rows.groupBy("source", "part").agg(F.sum("size").alias("words")), "mix-parts")
    aims = materialise(
        targets(parts.groupBy("source").agg(F.sum("words").alias("source_size")), cycle, cap), "mix-targets"
    )
    # The stretch of the stream that each shard's quota takes; a stream ends after ``cap`` readings.
    first, last = F.col("first_block") * F.col("block"), (F.col("first_block") + F.col("quota")) * F.col("block")
    quotas = apportion(aims, shards).groupBy("place").agg(
        F.array_sort(F.collect_list(F.struct("shard", first.alias("first"), last.alias("last")))).alias("stretches")
    )
    before = Window.partitionBy("place").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    plan = (
        parts.join(aims, parts["source"].eqNullSafe(aims["source"]))
        .select(parts["source"], "part", "words", "place", "source_size", "target")
        .join(quotas, "place", "left")
        .withColumn("offset", F.coalesce(F.sum("words").over(before), F.lit(0)))
        .select(
            F.col("source").alias("plan_source"), F.col("part").alias("plan_part"), "source_size", "target", "offset", "stretches"
        )
    )
    within = Window.partitionBy("source", "part").orderBy("key", "size")
    place = F.col("offset") + F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    start = F.col("start")

    def inside(stretch: Column) -> Column:
        """Words of the document that lie in a stretch, in all readings of the stream."""
        readings = [
            F.greatest(
                F.lit(0),
                F.least(start + n * F.col("source_size") + F.col("size"), stretch["last"])
                - F.greatest(start + n * F.col("source_size"), stretch["first"]),
            )
            for n in range(cap)
        ]
        return sum(readings[1:], readings[0]).cast("long")

    none = F.array_repeat(F.lit(0).cast("long"), shards)
    by_shard = F.coalesce(F.transform("stretches", inside), none)
    taken = F.aggregate("taken_by_shard", F.lit(0).cast("long"), lambda a, b: a + b)
    return (
        rows.join(plan, F.col("source").eqNullSafe(F.col("plan_source")) & (F.col("part") == F.col("plan_part")))
        .withColumn("start", place)
        .withColumn("taken_by_shard", by_shard)
        .select("row.*", "size", "source_size", "target", taken.alias("taken"), "taken_by_shard")
    )
