"""Asking in hops: the same answers, and packets in proportion to the chunks."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import edge
from tests.llm.test_dedup import brute_windows
from tidemark.llm import anchors, interpolation, packets
from tidemark.llm.text import id_remainder


def test_routes_grow_by_hops_not_by_fan_out():
    assert [packets.route_for(n * 100, 100, (5,)).digits for n in (1, 64, 640, 6_400, 64_000, 6_400_000)] == [
        (6,), (6,), (8,), (6, 5), (7, 7), (7, 7, 7),
    ]


@pytest.mark.parametrize("consumed", [0, 6, 11])
def test_keys_survive_their_way(consumed):
    keys = np.sort(np.random.default_rng(1).integers(0, 1 << 63, 500, dtype=np.uint64) << np.uint64(1))
    route = packets.Route(64, (6, 5), (5,))
    left = keys << np.uint64(consumed)
    (found, (values,)), = packets.unpack_kinds(packets.pack_kinds([(left, (np.arange(500),))], route), route)
    assert (found == left & ~np.uint64((1 << 8) - 1)).all() and (values == np.arange(500)).all()


def packets_of_all(chunks: int, hop_bits: int, keys_each: int = 256) -> list[int]:
    """Packets by hop, of chunks with random keys, by the functions that the tasks run."""
    bits = max(6, (chunks // 4).bit_length())
    hops = -(-bits // hop_bits)
    digits = tuple(bits // hops + (n < bits % hops) for n in range(hops))
    rng, counts = np.random.default_rng(3), []
    held = {(c, 0): np.sort(rng.integers(0, 1 << 63, keys_each, dtype=np.uint64) << np.uint64(1)) for c in range(chunks)}
    for digit in digits:
        sent: dict = {}
        n = 0
        for (sender, origin), keys in held.items():
            for prefix, ((part, _),) in packets.deal([(keys, ())], digit):
                sent.setdefault((sender >> digit, (origin << digit) | prefix), []).append(part)
                n += 1
        counts.append(n)
        held = {k: np.sort(np.concatenate(v)) for k, v in sent.items()}
    return counts


def test_packets_grow_in_proportion_to_the_chunks():
    """All to all they would be 64 * 64, 640 * 256 and 6,400 * 2,048."""
    a, b, c = (packets_of_all(n, packets.HOP_BITS) for n in (64, 640, 6_400))
    assert [len(x) for x in (a, b, c)] == [1, 1, 2]
    for n, counts in ((64, a), (640, b), (6_400, c)):
        assert max(counts) <= n << packets.HOP_BITS
    assert sum(c) / sum(b) <= 11 and sum(c) < 6_400 * 2_048 / 15


@pytest.mark.parametrize("hop_bits", [2, 3])
def test_answers_come_back_through_several_hops(spark, monkeypatch, hop_bits):
    """Repeats and scores through three and two hops equal those through one."""
    docs = edge.documents(spark)
    rows = docs.collect()
    learn = id_remainder(F.col("doc_id"), 5) != 1
    plain = Counter(tuple(r) for r in interpolation.score(docs, learn).collect())
    monkeypatch.setattr(packets, "HOP_BITS", hop_bits)
    assert len(packets.route_for(1, 1, (5,)).digits) == -(-6 // hop_bits)
    found = anchors.repeats(docs, chunk_bytes=20_000).collect()
    expected = Counter((r["doc_id"], *x) for r, x in zip(rows, brute_windows(rows, 35), strict=True))
    assert Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in found) == expected
    scored = [tuple(r) for r in interpolation.score(docs, learn, chunk_bytes=20_000).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:5])
    for got, want in zip(sorted(scored, key=key), sorted(plain.elements(), key=key), strict=True):
        assert got[:5] == want[:5] and got[5:] == pytest.approx(want[5:], abs=2e-2)


def test_windows_are_told_by_both_halves(spark, monkeypatch):
    """With a first half of a few bits many different windows share it; the second half tells them apart."""
    plain = anchors.Chunk.sums

    def few_bits(self, at, n, seed, half=0):
        found = plain(self, at, n, seed, half)
        return found if half else found & np.uint64(7 << 61)

    monkeypatch.setattr(anchors.Chunk, "sums", few_bits)
    docs = edge.documents(spark)
    rows = docs.collect()
    expected = Counter((r["doc_id"], *x) for r, x in zip(rows, brute_windows(rows, 35), strict=True))
    found = anchors.repeats(docs).collect()
    assert Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in found) == expected


def test_rows_alike_are_spread_over_chunks(spark):
    docs = spark.createDataFrame([(None, "gleicher Text")] * 500 + [(1, "gleicher Text")] * 500, "doc_id long, text string")
    chunks = packets.packs(docs, 64, "text", "doc_id").select("chunk").distinct().count()
    assert chunks > 50


def test_a_word_of_megabytes(spark):
    docs = spark.createDataFrame([(1, "x" * 3_000_000), (2, "x" * 3_000_000 + " y"), (3, None)], "doc_id long, text string")
    found = {r["doc_id"]: r["n_words"] for r in anchors.repeats(docs).collect()}
    assert found == {1: 1, 2: 2, 3: 0}
    scored = {r["doc_id"]: r["n_tokens"] for r in interpolation.score(docs, F.lit(True)).collect()}
    assert scored == {1: 2, 2: 3, 3: 1}
