"""Hard-negative mining by segment summaries.

A vector's components become integers (``floor(scale * x)``); the score of two rows is their integer inner product. An anchor's
positives are its first ``k`` rows of the same label, higher scores first, ties by smaller id. For each positive, its
negatives are the first ``k`` rows of another label that score at least ``least`` and at most ``most`` hundredths of the
positive's score.

Beside each vector stand the mean of each of its segments and the deviation from it (the norm of what the mean leaves out).
Over a segment of n components, the product of two vectors is n * mean * mean give or take deviation * deviation, so the sums
over all segments bound the score from above and below. Segments are cut into four, level by level (``LEVELS``): what a level
can exclude, because its upper bound is below a score that enough rows are sure to reach, or because its bounds lie outside
the wanted range, is not looked at again. What is left is scored exactly, in integers. Bounds only exclude, so the rows
returned are those of brute force.

All anchors meet all rows, in a grid of row blocks and anchor blocks; each cell returns ``k`` rows for an anchor or positive,
so a block is a task of bounded size whatever label, vector or id is common. Rows are dealt to blocks by their place in the
table, not by content: a row with very many copies is in all blocks.

Defined results: a row with a NULL label, a NULL vector or any NULL or non-finite component takes no part, nor does one with
a component beyond 2^27 after scaling (its scores would leave the range of a long). Rows score only against rows of the same
length; an empty vector scores 0. Rows of the anchor's own id are not its partners; an anchor that the table holds several
times is mined once for each row. A NULL id is no anchor and comes last among ties. Repeated rows of other ids count one by
one. An empty table, or one without anchors, gives no rows; further columns, whatever their names, are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.durable import materialise

#: Numbers of segments, coarse to fine.
LEVELS = (1, 4, 16)
LARGEST = 1 << 27
NO_ID = np.int64(-1 << 63)
BLOCK_ROWS = 8_192
BLOCK_ANCHORS = 1_024
#: Bounds are computed in double precision; they are widened by this share of the product of the norms, and this much.
SLACK, LEAST_SLACK = 1e-12, 1e-6


def edges(width: int, segments: int) -> np.ndarray:
    """Where the segments begin; with fewer components than segments, each is one."""
    n = max(1, min(segments, width))
    return np.arange(n) * width // n


def summaries(x: np.ndarray) -> np.ndarray:
    """Of each row, level by level, first the means of all segments (times the root of their length), then the
    deviations. The product of two such means is the segment's middle value."""
    width = x.shape[1]
    parts = []
    for level in LEVELS if width else ():
        begin = edges(width, level)
        length = np.diff(np.append(begin, width))
        means = np.add.reduceat(x, begin, axis=1) / length
        rest = x - np.repeat(means, length, axis=1)
        parts += [means * np.sqrt(length), np.sqrt(np.add.reduceat(rest * rest, begin, axis=1))]
    return np.concatenate(parts, axis=1) if parts else np.zeros((len(x), 0))


def by_level(summary: np.ndarray, width: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """The means and the deviations of each level (of one row or of many)."""
    found, at = [], 0
    for level in LEVELS if width else ():
        n = len(edges(width, level))
        found.append((summary[..., at : at + n], summary[..., at + n : at + 2 * n]))
        at += 2 * n
    return found


def norms(levels: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The length of a vector, from its coarsest level."""
    means, deviations = levels[0]
    return np.sqrt((means * means).sum(-1) + (deviations * deviations).sum(-1))


class Block:
    """Some rows of one length with their summaries."""

    def __init__(self, x: np.ndarray, summary: np.ndarray, ids: np.ndarray, named: np.ndarray, labels: np.ndarray):
        self.x, self.ids, self.named, self.labels = x, ids, named, labels
        self.levels = [(np.ascontiguousarray(m), np.ascontiguousarray(d)) for m, d in by_level(summary, x.shape[1])]
        self.norms = norms(self.levels) if self.levels else np.zeros(len(x))
        self.exact = 0

    def bounds(self, at: np.ndarray, own: list[tuple[np.ndarray, np.ndarray]]):
        """Level by level: lower and upper bounds of the scores of the rows ``at`` with the row that ``own`` summarises.
        The rows that stay are sent back."""
        slack = SLACK * self.norms * norms(own) + LEAST_SLACK if own else self.norms
        for (means, deviations), (mean, deviation) in zip(self.levels, own, strict=True):
            middle, away = means[at] @ mean, deviations[at] @ deviation + slack[at]
            at = yield at, middle - away, middle + away

    def scores(self, at: np.ndarray, q: np.ndarray) -> np.ndarray:
        self.exact += len(at)
        return self.x[at] @ q

    def order(self, at: np.ndarray, scores: np.ndarray) -> np.ndarray:
        """Higher scores first, ties by smaller id, rows without id last."""
        return np.lexsort((self.ids[at], ~self.named[at], -scores))

    def others(self, own_id: int) -> np.ndarray:
        return ~(self.named & (self.ids == own_id))

    def best(self, q: np.ndarray, own: list, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The first k of the rows ``at`` by score."""
        search = self.bounds(at, own)
        at_level = next(search, None) if len(at) > k else None
        while at_level is not None:
            at, low, high = at_level
            reached = np.partition(low, len(low) - k)[len(low) - k]
            at = at[high >= reached]
            at_level = sent_back(search, at) if len(at) > k else None
        scores = self.scores(at, q)
        first = self.order(at, scores)[:k]
        return at[first], scores[first]

    def between(
        self, q: np.ndarray, own: list, at: np.ndarray, ranges: list[tuple[int, int]], k: int
    ) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each range of scores (ends included) the first k of the rows ``at`` inside. Rows that some range may
still need are kept for all."""
        search = self.bounds(at, own)
        at_level = next(search, None) if len(at) else None
        while at_level is not None:
            at, low, high = at_level
            open_ = np.zeros(len(at), bool)
            for least, most in ranges:
                inside = (low >= least) & (high <= most)
                reached = float(least)
                if (n := int(inside.sum())) >= k:
                    reached = max(reached, np.partition(low[inside], n - k)[n - k])
                open_ |= (high >= reached) & (low <= most)
            at = at[open_]
            at_level = sent_back(search, at) if len(at) else None
        scores = self.scores(at, q)
        found = []
        for least, most in ranges:
            inside = np.flatnonzero((scores >= least) & (scores <= most))
            first = inside[self.order(at[inside], scores[inside])[:k]]
            found.append((at[first], scores[first]))
        return found


def sent_back(search, at: np.ndarray):
    """The bounds of the next level, or None after the last."""
    try:
        return search.send(at)
    except StopIteration:
        return None


def matrix(column, kind: type) -> np.ndarray:
    """A column of lists of one length as rows."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    width = len(column[0]) if len(column) else 0
    return np.asarray(column.flatten()).astype(kind, copy=False).reshape(len(column), width)


def usable(vectors: DataFrame, scale: int, id_col: str, label_col: str, vec_col: str) -> DataFrame:
    v = F.col(f"`{vec_col}`").cast("array<double>")
    scaled = F.transform(F.col("v"), lambda x: F.floor(F.least(F.greatest(x * scale, F.lit(-2.0 * LARGEST)), F.lit(2.0 * LARGEST))))
    rows = vectors.select(
        F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("long").alias("label"), v.alias("v")
    )
    rows = rows.filter(F.col("label").isNotNull() & F.col("v").isNotNull())
    rows = rows.filter(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))))
    return rows.withColumn("v", scaled).filter(F.forall("v", lambda x: F.abs(x) <= LARGEST))


def stored_rows(rows: DataFrame, block_rows: int) -> tuple[DataFrame, int]:
    """The usable rows with a number, their summary and block, and how many blocks there are."""
    blocks = max(1, -(-rows.count() // block_rows))

    def summarise(batches):
        for batch in batches:
            widths = np.diff(np.asarray(batch.column("v").offsets)) if batch.num_rows else np.zeros(0, int)
            found: list = [None] * batch.num_rows
            for width in np.unique(widths).tolist():
                at = np.flatnonzero(widths == width)
                x = matrix(batch.column("v").take(pa.array(at)), np.float64)
                for i, s in zip(at.tolist(), summaries(x), strict=True):
                    found[i] = s
            summary = pa.array(found, pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, summary], [*batch.schema.names, "summary"])

    number = F.monotonically_increasing_id()
    numbered = rows.withColumn("row", number).withColumn("width", F.size("v"))
    numbered = numbered.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int"))
    schema = "id long, label long, v array<long>, row long, width int, block int, summary array<double>"
    return materialise(numbered.mapInArrow(summarise, schema), "summarised-vectors"), blocks


def grid(rows: DataFrame, anchors: DataFrame, blocks: int, anchor_blocks: int):
    """Rows and anchors met block by block, each length apart."""
    # Both come from one table; new names keep their columns apart.
    anchors = anchors.select(*[F.col(c).alias(c) for c in anchors.columns])
    rows = rows.withColumn("anchors", F.explode(F.sequence(F.lit(0), F.lit(anchor_blocks - 1))))
    anchors = anchors.withColumn("anchors", F.pmod(F.xxhash64("row"), F.lit(anchor_blocks)).cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    )
    keys = ("block", "anchors", "width")
    return anchors.groupBy(*keys).cogroup(rows.groupBy(*keys))


def as_block(table: pa.Table) -> Block:
    ids = table.column("id")
    return Block(
        matrix(table.column("v"), np.int64),
        matrix(table.column("summary"), np.float64),
        np.asarray(ids.fill_null(int(NO_ID))),
        np.asarray(ids.is_valid()),
        np.asarray(table.column("label")),
    )


def asked(table: pa.Table) -> zip:
    """(row, id, label, vector, summary) of each anchor."""
    x = matrix(table.column("v"), np.int64)
    return zip(
        table.column("row").to_pylist(),
        table.column("id").to_pylist(),
        table.column("label").to_pylist(),
        x,
        [by_level(s, x.shape[1]) for s in matrix(table.column("summary"), np.float64)],
        strict=True,
    )


def ranked(found: DataFrame, keys: list[str], id_col: str, k: int) -> DataFrame:
    best = Window.partitionBy(*keys).orderBy(F.desc("score"), F.col(id_col).asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(best).cast("int")).filter(F.col("rank") <= k)


def mine(
    vectors: DataFrame,
    every: int = 100,
    k: int = 5,
    least: int = 80,
    most: int = 100,
    scale: int = 256,
    id_col: str = "vec_id",
    label_col: str = "label",
    vec_col: str = "embedding",
    block_rows: int = BLOCK_ROWS,
    block_anchors: int = BLOCK_ANCHORS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the anchors, the rows whose id is
    divisible by ``every``."""
    rows, blocks = stored_rows(usable(vectors, scale, id_col, label_col, vec_col), block_rows)
    anchors = rows.filter(F.col("id") % every == 0).drop("block")
    anchor_blocks = max(1, -(-anchors.count() // block_anchors))

    def find_positives(asking, there):
        block, found = as_block(there), []
        if there.num_rows:
            for row, own, label, q, summary in asked(asking):
                at = np.flatnonzero((block.labels == label) & block.others(own))
                at, scores = block.best(q, summary, at, k)
                found.append((np.full(len(at), row), at, scores))
        return result(block, found, ["row", "positive_id", "score"])

    def result(block, found, names):
        who, at, scores, *more = (np.concatenate(p) for p in zip(*found, strict=True)) if found else [np.zeros(0, np.int64)] * len(names)
        ids = pa.array(block.ids[at], pa.int64(), mask=~block.named[at])
        return pa.table(dict(zip(names, [pa.array(who), ids, pa.array(scores), *map(pa.array, more)], strict=True)))

    met = grid(rows, anchors, blocks, anchor_blocks).applyInArrow(find_positives, "row long, positive_id long, score long")
    positives = materialise(ranked(met, ["row"], "positive_id", k), "positives")
    wanted = positives.groupBy("row").agg(F.collect_set("score").alias("positive_scores"))  # k at most
    anchors = anchors.join(wanted, "row")

    def find_negatives(asking, there):
        block, found = as_block(there), []
        if there.num_rows:
            for (row, own, label, q, summary), scored in zip(asked(asking), asking.column("positive_scores").to_pylist(), strict=True):
                at = np.flatnonzero((block.labels != label) & block.others(own))
                # least * p <= 100 * n <= most * p, in integers
                ranges = [(-(-least * p // 100), most * p // 100) for p in scored]
                for p, (near, scores) in zip(scored, block.between(q, summary, at, ranges, k), strict=True):
                    found.append((np.full(len(near), row), near, scores, np.full(len(near), p)))
        return result(block, found, ["row", "negative_id", "score", "positive_score"])

    schema = "row long, negative_id long, score long, positive_score long"
    met = grid(rows, anchors, blocks, anchor_blocks).applyInArrow(find_negatives, schema)
    negatives = ranked(met, ["row", "positive_score"], "negative_id", k)
    negatives = negatives.select("row", "positive_score", "rank", "negative_id", F.col("score").alias("negative_score"))
    names = anchors.select("row", F.col("id").alias("anchor_id"))
    pairs = positives.select("row", "positive_id", F.col("score").alias("positive_score")).join(names, "row")
    return pairs.join(negatives, ["row", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
