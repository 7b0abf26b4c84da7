"""Approximate nearest neighbours with a hierarchical k-means tree, searched best bin first.

The tree is fitted on the driver on a bounded sample (``SAMPLE_ROWS``) and has at most ``MOST_LEAVES`` leaves; every
vector is indexed. A query walks the tree through a priority queue, nearest centre first, and collects leaves. How many
is calibrated: for ``CALIBRATION`` held vectors the exact neighbours are found in one blocked pass over all rows, and
leaf visits are widened until the wanted share of them lies in visited leaves. Large leaves are cut into blocks, as are
the queries of a much visited leaf, so that a vector with very many copies is many tasks.

Defined results: vectors that are NULL, empty or zero, or hold NULL or non-finite components, take no part, nor do those
of another length than the commonest (of equally common ones, the longest); rows with the query's own id are not its
neighbours; of a query id that the table holds with several vectors the smallest (component by component) is asked for;
repeated rows of other ids count one by one, ties go to the smaller id and NULL ids come last; a NULL id is no query; an empty
table or no query gives no rows; further columns, whatever their names, are ignored.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.durable import materialise

SAMPLE_ROWS = 20_000
MOST_LEAVES = 4_096
CALIBRATION = 128
BRANCHES = 8
RESULT = "query_id long, rank int, vec_id long, score double, calibrated_recall double"


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    v = F.col(f"`{vec_col}`").cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    some = F.exists(v, lambda x: x != 0)
    return vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), v.alias("v")).filter(
        F.col("v").isNotNull() & finite & some
    )


def matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten()).reshape(-1, width)


def squared(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances by the product form: quick, for choosing among centres only."""
    return (x * x).sum(1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(1)[None, :]


def lloyd(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    centres = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        owner = squared(x, centres).argmin(1)
        filled = np.unique(owner)
        moved = np.stack([x[owner == c].mean(0) for c in filled])
        if moved.shape == centres.shape and np.allclose(moved, centres):
            break
        centres = moved
    return centres


@dataclass
class Tree:
    """nodes[i] = (centres, children); a child is a node's number, or -1 - leaf."""

    nodes: list[tuple[np.ndarray, list[int]]]
    leaves: int

    def assign(self, x: np.ndarray) -> np.ndarray:
        leaf = np.zeros(len(x), np.int32)
        if not self.nodes:
            return leaf
        waiting = [(0, np.arange(len(x)))]
        while waiting:
            node, rows = waiting.pop()
            centres, children = self.nodes[node]
            nearest = squared(x[rows], centres).argmin(1)
            for c, child in enumerate(children):
                inside = rows[nearest == c]
                if len(inside):
                    if child < 0:
                        leaf[inside] = -1 - child
                    else:
                        waiting.append((child, inside))
        return leaf

    def best_bins(self, q: np.ndarray):
        """Leaves in the order in which the queue gives them."""
        if not self.nodes:
            yield 0
            return
        queue = [(0.0, 0)]
        while queue:
            _, child = heapq.heappop(queue)
            if child < 0:
                yield -1 - child
                continue
            centres, children = self.nodes[child]
            for distance, below in zip(((centres - q) ** 2).sum(1).tolist(), children, strict=True):
                heapq.heappush(queue, (distance, below))


def grow(sample: np.ndarray, rows: int, leaf_rows: int, seed: int) -> Tree:
    """Split while a node stands for more than ``leaf_rows`` rows and has enough of the sample."""
    sample = np.unique(sample, axis=0)
    rng = np.random.Generator(np.random.PCG64(seed))
    leaf_rows = max(leaf_rows, rows // MOST_LEAVES)
    each = rows / max(1, len(sample))
    nodes, leaves = [], 0

    def split(x: np.ndarray) -> int:
        nonlocal leaves
        if len(x) * each > leaf_rows and len(x) >= 2 * BRANCHES:
            centres = lloyd(x, BRANCHES, rng)
            owner = squared(x, centres).argmin(1)
            if len(np.unique(owner)) > 1:
                at = len(nodes)
                nodes.append((centres, []))
                nodes[at] = (centres, [split(x[owner == c]) for c in range(len(centres))])
                return at
        leaves += 1
        return -leaves

    if split(sample) < 0:
        return Tree([], 1)
    return Tree(nodes, leaves)


def nearest(x: np.ndarray, ids: np.ndarray, q: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k nearest rows of a block by (distance, id), in double precision on the vectors themselves."""
    difference = x - q
    distance = np.sqrt((difference * difference).sum(1))
    at = np.flatnonzero(ids != own)
    if len(at) > k:
        bound = np.partition(distance[at], k - 1)[k - 1]
        at = at[distance[at] <= bound]
    at = at[np.lexsort((ids[at], distance[at]))][:k]
    return at, distance[at]


@dataclass
class Index:
    tree: Tree
    table: DataFrame  # leaf, id, v
    leaf_rows: list[int]
    visits: int
    recall: float
    width: int


def build(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    k: int = 10,
    recall: float = 0.95,
    leaf_rows: int = 128,
    seed: int = 42,
) -> Index | None:
    """The tree, the table of all usable vectors with their leaves, and the calibrated number of leaf visits."""
    rows = usable(vectors, id_col, vec_col)
    lengths = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    if lengths is None:
        return None
    width, total = lengths["n"], lengths["count"]
    rows = rows.filter(F.size("v") == width)
    place = F.xxhash64(F.lit(seed), "id", "v")
    share = min(1.0, 1.5 * SAMPLE_ROWS / total)
    drawn = rows.filter(F.pmod(place, F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    sample = drawn.orderBy(place).limit(SAMPLE_ROWS).toArrow()  # bounded
    points = matrix(sample.column("v"), width)
    tree = grow(points, total, leaf_rows, seed)

    def place_rows(batches):
        for batch in batches:
            leaf = tree.assign(matrix(batch.column("v"), width))
            yield pa.RecordBatch.from_arrays([pa.array(leaf), *batch.columns], ["leaf", *batch.schema.names])

    table = materialise(rows.mapInArrow(place_rows, "leaf int, id long, v array<double>"), "ann-index")
    counts = [0] * tree.leaves
    for r in table.groupBy("leaf").count().collect():  # MOST_LEAVES at most, but for rounding
        counts[r["leaf"]] = r["count"]

    held = [i for i, x in enumerate(sample.column("id").to_pylist()) if x is not None][:CALIBRATION]
    ids = sample.column("id").take(held).to_pylist()
    visits, reached = calibrate(table, tree, points[held], ids, k, recall, width)
    return Index(tree, table, counts, visits, reached, width)


def calibrate(table, tree, queries, ids, k, recall, width) -> tuple[int, float]:
    """Widen the visits until the mean share of true neighbours in visited leaves reaches ``recall``."""

    def exact(batches):
        for batch in batches:
            x, own = matrix(batch.column("v"), width), np.asarray(batch.column("id").fill_null(-1 << 63))
            leaf = np.asarray(batch.column("leaf"))
            found = [nearest(x, own, q, i, k) for q, i in zip(queries, ids, strict=True)]
            at = np.concatenate([a for a, _ in found])
            who = np.repeat(np.arange(len(found), dtype=np.int32), [len(a) for a, _ in found])
            arrays = [who, leaf[at], own[at], np.concatenate([d for _, d in found])]
            yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], ["query", "leaf", "id", "score"])

    best = Window.partitionBy("query").orderBy("score", "id")
    top = table.mapInArrow(exact, "query int, leaf int, id long, score double")
    top = top.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query", "leaf").collect()
    order = [{leaf: n for n, leaf in enumerate(tree.best_bins(q), 1)} for q in queries]
    needed = np.sort([order[r["query"]][r["leaf"]] for r in top])
    visits, reached = 1, 1.0
    while len(needed) and (reached := float((needed <= visits).mean())) < recall:
        visits += max(1, visits // 8)
    return min(visits, tree.leaves), reached


def grouped(counts: list[int], block_rows: int) -> list[int]:
    """Runs of neighbouring leaves (the tree numbers them from left to right) of about ``block_rows`` rows."""
    groups, group, held = [], 0, 0
    for n in counts:
        if held and held + n > block_rows:
            group, held = group + 1, 0
        groups.append(group)
        held += n
    return groups


def search(index: Index, queries: DataFrame, k: int = 10, block_rows: int = 2048, block_queries: int = 1024) -> DataFrame:
    """(query_id, rank, vec_id, score) of ``queries`` (id, v); nearest first, ties to the smaller id.

    A query goes once to each group of leaves that it visits, with the list of those leaves, and brings back k rows.
    """
    tree, width, counts, visits = index.tree, index.width, index.leaf_rows, index.visits
    group_of = grouped(counts, block_rows)
    group_rows = [0] * (group_of[-1] + 1)
    for leaf, group in enumerate(group_of):
        group_rows[group] += counts[leaf]

    def route(batches):
        for batch in batches:
            rows, groups, leaves = [], [], []
            for i, q in enumerate(matrix(batch.column("v"), width)):
                seen, chosen = 0, {}
                for n, leaf in enumerate(tree.best_bins(q)):
                    if n >= visits and seen > k:
                        break
                    chosen.setdefault(group_of[leaf], []).append(leaf)
                    seen += counts[leaf]
                rows += [i] * len(chosen)
                groups += chosen
                leaves += chosen.values()
            arrays = [pa.array(groups, pa.int32()), pa.array(leaves, pa.list_(pa.int32()))]
            taken = [c.take(pa.array(rows, pa.int64())) for c in batch.columns]
            yield pa.RecordBatch.from_arrays([*arrays, *taken], ["group", "leaves", *batch.schema.names])

    probes = materialise(
        queries.mapInArrow(route, "group int, leaves array<int>, id long, v array<double>"), "ann-probes"
    )
    asked = [0] * len(group_rows)
    for r in probes.groupBy("group").count().collect():
        asked[r["group"]] = r["count"]

    def parts(numbers: list[int], size: int):
        return F.element_at(F.array(*[F.lit(max(1, -(-n // size))) for n in numbers]), F.col("group") + 1)

    # Only a leaf of its own can be larger than a block; it is cut, and a group that very many ask is copied.
    member_parts, query_parts = parts(group_rows, block_rows), parts(asked, block_queries)
    members = (
        index.table.withColumn("group", F.element_at(F.array(*map(F.lit, group_of)), F.col("leaf") + 1))
        .withColumn("block", F.pmod(F.xxhash64("id", "v"), member_parts))
        .withColumn("queries", F.explode(F.sequence(F.lit(0), query_parts - 1)))
    )
    probes = probes.withColumn("queries", F.pmod(F.xxhash64("id"), query_parts).cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), (member_parts - 1).cast("long")))
    )

    def compare(asking, there):
        order = np.argsort(np.asarray(there.column("leaf")), kind="stable")
        leaf = np.asarray(there.column("leaf"))[order]
        x, ids = matrix(there.column("v"), width)[order], np.asarray(there.column("id").fill_null(-1 << 63))[order]
        who, rows, scores = [], [], []
        points = matrix(asking.column("v"), width)
        for own, leaves, q in zip(asking.column("id").to_pylist(), asking.column("leaves").to_pylist(), points, strict=True):
            inside = np.flatnonzero(np.isin(leaf, leaves))
            at, distance = nearest(x[inside], ids[inside], q, own, k)
            who += [own] * len(at)
            rows.append(order[inside[at]])
            scores.append(distance)
        at = np.concatenate(rows) if rows else np.zeros(0, np.int64)
        return pa.table(
            {
                "query_id": pa.array(who, pa.int64()),
                "vec_id": there.column("id").take(pa.array(at)),
                "score": pa.array(np.concatenate(scores) if scores else np.zeros(0)),
            }
        )

    keys = ["group", "block", "queries"]
    found = (
        probes.groupBy(*keys)
        .cogroup(members.groupBy(*keys))
        .applyInArrow(compare, "query_id long, vec_id long, score double")
    )
    best = Window.partitionBy("query_id").orderBy("score", F.col("vec_id").asc_nulls_last())
    return (
        found.withColumn("rank", F.row_number().over(best).cast("int"))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def neighbours(
    vectors: DataFrame, every: int, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding", **settings
) -> DataFrame:
    """The k nearest of each row whose id is divisible by ``every``, among all rows, with the share of true neighbours
    that the calibration reached."""
    index = build(vectors, id_col, vec_col, k, **settings)
    if index is None:
        return vectors.sparkSession.createDataFrame([], RESULT)
    queries = index.table.filter(F.col("id") % every == 0).groupBy("id").agg(F.min("v").alias("v"))
    return search(index, queries, k).withColumn("calibrated_recall", F.lit(index.recall))
