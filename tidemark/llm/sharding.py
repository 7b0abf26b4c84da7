"""Uniform shuffle into shards of exact size, by a hypergeometric communication matrix.

How many rows each part sends to each shard is drawn first, from the multivariate hypergeometric law that a uniform
random permutation obeys. Rows are permuted within their part and cut at those counts, exchanged, and permuted again
within their shard. Only the part sizes (a bounded number) reach the driver; rows move as a DataFrame.

Defined results: an empty table gives no rows; NULL ids and NULL texts are ordinary rows (a NULL text has no bytes);
repeated rows are shuffled like any other, and as many equal rows as there are lie in one part (its window spills); a text of
any length is one row; columns named like an output column are replaced by it.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.text import scale_bits, whole

OUTPUT = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")


def hypergeometric(rng: np.random.Generator, good: int, bad: int, drawn: int) -> int:
    """Number of good ones among ``drawn`` taken without replacement. Inverse distribution function over the window
    of 40 standard deviations round the mode, so that it holds for any size."""
    low, high = max(0, drawn - bad), min(good, drawn)
    if low == high:
        return low
    total = good + bad
    mean = drawn * good / total
    spread = (mean * bad / total * (total - drawn) / max(1, total - 1)) ** 0.5
    mode = min(high, max(low, (drawn + 1) * (good + 1) // (total + 2)))
    reach = int(40 * spread) + 40
    first, last = max(low, mode - reach), min(high, mode + reach)
    k = np.arange(first, last, dtype=np.float64)
    steps = np.log((good - k) * (drawn - k)) - np.log((k + 1) * (bad - drawn + k + 1))
    logs = np.concatenate(([0.0], np.cumsum(steps)))
    weights = np.cumsum(np.exp(logs - logs.max()))
    return first + int(np.searchsorted(weights, rng.random() * weights[-1], side="right").clip(0, last - first))


def communication_matrix(part_rows: list[int], shard_rows: list[int], seed: int) -> list[list[int]]:
    """counts[part][shard], with the given row and column sums, as a uniform permutation would have them."""
    rng = np.random.Generator(np.random.PCG64(seed))
    room, matrix = list(shard_rows), []
    for rows in part_rows:
        counts, left, rest = [], rows, sum(room)
        for capacity in room:
            rest -= capacity
            taken = hypergeometric(rng, capacity, rest, left)
            counts.append(taken)
            left -= taken
        room = [capacity - taken for capacity, taken in zip(room, counts, strict=True)]
        matrix.append(counts)
    return matrix


def shard(
    docs: DataFrame,
    shards: int = 8,
    seed: int = 42,
    id_col: str = "doc_id",
    text_col: str = "text",
    rows_per_part: int = 20_000,
) -> DataFrame:
    """Every row with ``size``, ``text_crc32``, ``law`` = 'rows', ``shard`` and its ``slot`` there (gapless from 0).

    Shard sizes differ by one at most. The same rows and seed give the same shards in any physical layout: parts and
    both permutations are keyed by hashes of id and text; rows alike in both are interchangeable.
    """
    spark = docs.sparkSession
    text = whole(F.col(text_col))
    kept = [c for c in docs.columns if c.lower() not in OUTPUT]
    rows = docs.select(
        *[F.col(f"`{c}`").alias(f"row_{i}") for i, c in enumerate(kept)],
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64(F.lit(seed), F.col(id_col), text).alias("local_key"),
        F.xxhash64(F.col(id_col)).alias("id_key"),
    )
    bits = scale_bits(docs.count(), rows_per_part, 6, 12)
    part = F.shiftrightunsigned(F.col("local_key"), 64 - bits).cast("int")
    part_rows = sorted(
        (r["part"], r["count"]) for r in rows.groupBy(part.alias("part")).count().collect()
    )  # 4,096 rows at most
    total = sum(n for _, n in part_rows)
    shard_rows = [total // shards + (s < total % shards) for s in range(shards)]
    matrix = communication_matrix([n for _, n in part_rows], shard_rows, seed)
    ends = [(p, [int(x) for x in np.cumsum(c)]) for (p, _), c in zip(part_rows, matrix, strict=True)]
    plan = spark.createDataFrame(ends, "part int, ends array<bigint>")

    tie = ["id_key", "size", "text_crc32"]
    local = Window.partitionBy("part").orderBy("local_key", *tie)
    dealt = (
        rows.withColumn("part", part)
        .withColumn("rank", F.row_number().over(local))
        .join(F.broadcast(plan), "part")
        .withColumn("shard", F.size(F.filter("ends", lambda end: end < F.col("rank"))))
        .withColumn("key", F.xxhash64(F.lit(seed + 1), "local_key"))
        .withColumn("block", F.shiftrightunsigned(F.col("key"), 64 - bits).cast("int"))
        .drop("part", "rank", "ends")
    )
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        dealt.groupBy("shard", "block")
        .count()
        .withColumn("offset", F.coalesce(F.sum("count").over(before), F.lit(0)))
        .drop("count")
    )
    final = Window.partitionBy("shard", "block").orderBy("key", "local_key", *tie)
    return (
        dealt.withColumn("place", F.row_number().over(final) - 1)
        .join(offsets, ["shard", "block"])
        .select(
            *[F.col(f"row_{i}").alias(c) for i, c in enumerate(kept)],
            "size",
            "text_crc32",
            F.lit("rows").alias("law"),
            F.col("shard").cast("int").alias("shard"),
            (F.col("offset") + F.col("place")).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
