from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import edge
from tidemark.llm import hard_negatives

SCHEMA = "vec_id long, embedding array<double>, label int"


def integers(vector):
    """The components as integers, or None if the row takes no part."""
    if vector is None or any(x is None or not math.isfinite(x) for x in vector):
        return None
    found = [math.floor(256 * x) for x in vector]
    return found if all(abs(x) <= 1 << 27 for x in found) else None


def brute(rows, every: int, k: int, least: int = 80, most: int = 100) -> Counter:
    rows = [(i, v, y) for i, v, y in ((i, integers(v), y) for i, v, y in rows) if v is not None and y is not None]
    order = lambda found: sorted(found, key=lambda x: (-x[0], x[1] is None, x[1] or 0))[:k]
    result = Counter()
    for a, v, y in rows:
        if a is None or a % every:
            continue
        scored = [(sum(p * q for p, q in zip(v, w, strict=True)), i, z) for i, w, z in rows if i != a and len(w) == len(v)]
        for p, positive, _ in order([s for s in scored if s[2] == y]):
            inside = [s for s in scored if s[2] != y and least * p <= 100 * s[0] <= most * p]
            for rank, (n, negative, _) in enumerate(order(inside), 1):
                result[a, positive, rank, negative, p, n] += 1
    return result


def mined(found) -> Counter:
    names = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    assert tuple(found.columns) == names
    return Counter(tuple(r[n] for n in names) for r in found.collect())


def table(seed: int, n: int, width: int):
    """Clustered vectors, a very common one, ties, awkward rows."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(9, width))
    rows = [(i, (centres[i % 9] + 0.4 * rng.normal(size=width)).tolist(), int(i % 9 // 3)) for i in range(n)]
    rows += [(5000 + i, rows[4][1], 1) for i in range(60)] + [(6000 + i, rows[8][1], i % 3) for i in range(30)]
    nan, inf = float("nan"), float("inf")
    rows += [(7000, None, 1), (7010, [nan] * width, 1), (7020, [inf] + [0.0] * (width - 1), 0), (7030, [None] * width, 2)]
    rows += [(7040, rows[0][1], None), (7050, [1e9] * width, 1), (7060, [], 1), (7061, [], 2), (7062, [], 1), (7070, [1.0, 2.0], 1)]
    rows += [(7071, [1.0, 2.0], 1), (7072, [0.9, 2.0], 0), (7080, [0.0] * width, 1), (None, rows[10][1], 0), (None, rows[10][1], 1)]
    return rows + [rows[20], rows[21]]


@pytest.mark.parametrize("width, settings", [(24, {}), (24, {"block_rows": 64, "block_anchors": 7}), (3, {"block_rows": 100})])
def test_negatives_against_brute_force(spark, width, settings):
    rows = table(1, 420, width)
    vectors = spark.createDataFrame(rows, SCHEMA).repartition(5).withColumn("row", F.lit("own")).withColumn("block", F.lit(1))
    expected = brute(rows, 10, 5)
    assert len(expected) > 100
    assert mined(hard_negatives.mine(vectors, every=10, **settings)) == expected


def test_bounds_hold_and_exclude():
    rng = np.random.default_rng(7)
    smooth = np.repeat(rng.normal(size=(2000, 4)), 16, axis=1) + 0.02 * rng.normal(size=(2000, 64))
    x = np.floor(256 * smooth).astype(np.int64)
    x[0] = 1 << 27
    x[1] = -(1 << 27)
    summary = hard_negatives.summaries(x.astype(float))
    block = hard_negatives.Block(x, summary, np.arange(2000), np.ones(2000, bool), np.zeros(2000, int))
    for i in (0, 1, 2, 50):
        own = hard_negatives.by_level(summary[i], 64)
        search = block.bounds(np.arange(2000), own)
        found, truth = next(search), x @ x[i]
        while found is not None:
            assert (found[1] <= truth).all() and (truth <= found[2]).all()
            found = hard_negatives.sent_back(search, np.arange(2000))
    block.exact = 0
    at, scores = block.best(x[50], hard_negatives.by_level(summary[50], 64), np.arange(2, 2000), 5)
    truth = x[2:] @ x[50]
    assert scores.tolist() == sorted(truth.tolist(), reverse=True)[:5] and block.exact < 200
    block.exact = 0
    (near, inside), = block.between(x[50], hard_negatives.by_level(summary[50], 64), np.arange(2, 2000), [(int(0.4 * scores[0]), int(0.5 * scores[0]))], 5)
    assert inside.tolist() == sorted((s for s in truth.tolist() if int(0.4 * scores[0]) <= s <= int(0.5 * scores[0])), reverse=True)[:5]
    assert len(near) == 5 and block.exact < 200


def test_nothing_and_no_anchor(spark):
    assert hard_negatives.mine(spark.createDataFrame([], SCHEMA)).collect() == []
    assert hard_negatives.mine(spark.createDataFrame([(1, [1.0], 1), (2, [1.0], 2)], SCHEMA)).collect() == []
    assert hard_negatives.mine(edge.documents(spark).selectExpr("doc_id vec_id", "cast(null as array<float>) embedding", "1 label")).collect() == []
