from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import edge
from tidemark.llm import mixing, sharding
from tidemark.llm.text import scale_bits


def test_shards_are_exact_gapless_and_repeatable(spark):
    docs = edge.documents(spark)
    found = sharding.shard(docs, shards=8).collect()
    assert len(found) == docs.count()
    slots = defaultdict(list)
    for r in found:
        slots[r["shard"]].append(r["slot"])
        text = (r["text"] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(text) + 1, zlib.crc32(text), "rows", None)
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    key = lambda rows: Counter((r["doc_id"], r["text"], r["shard"], r["slot"]) for r in rows)
    assert key(found) == key(sharding.shard(docs.repartition(7), shards=8).collect())
    assert key(found) != key(sharding.shard(docs, shards=8, seed=5).collect())


@pytest.mark.parametrize("shards, rows_per_part", [(8, 20_000), (3, 2)])
def test_every_row_lies_where_dealing_by_hand_puts_it(spark, shards, rows_per_part):
    """Parts by leading bits, dealt in order by the drawn matrix, permuted again in each shard."""
    docs = edge.documents(spark)
    text = F.coalesce("text", F.lit(""))
    local = F.xxhash64(F.lit(42), "doc_id", text)
    keyed = docs.select(
        "doc_id", "text", local.alias("local"), F.xxhash64("doc_id").alias("id_key"), F.xxhash64(F.lit(43), local).alias("key"),
        (F.octet_length(text) + 1).alias("size"), F.crc32(text).alias("crc"),
    ).collect()
    bits = scale_bits(len(keyed), rows_per_part, 6, 12)
    parts = defaultdict(list)
    for r in keyed:
        parts[(r["local"] & (1 << 64) - 1) >> 64 - bits].append(r)
    total = len(keyed)
    matrix = sharding.communication_matrix(
        [len(parts[p]) for p in sorted(parts)], [total // shards + (s < total % shards) for s in range(shards)], 42
    )
    dealt = defaultdict(list)
    for p, counts in zip(sorted(parts), matrix, strict=True):
        rows = iter(sorted(parts[p], key=lambda r: (r["local"], r["id_key"], r["size"], r["crc"])))
        for shard, n in enumerate(counts):
            dealt[shard] += [next(rows) for _ in range(n)]
    expected = Counter()
    for shard, rows in dealt.items():
        order = lambda r: ((r["key"] & (1 << 64) - 1) >> 64 - bits, r["key"], r["local"], r["id_key"], r["size"], r["crc"])
        expected.update((r["doc_id"], r["text"], shard, slot) for slot, r in enumerate(sorted(rows, key=order)))
    found = sharding.shard(docs, shards=shards, rows_per_part=rows_per_part)
    assert Counter((r["doc_id"], r["text"], r["shard"], r["slot"]) for r in found.collect()) == expected


def test_sharding_nothing(spark):
    assert sharding.shard(edge.nothing(spark)).collect() == []


def test_matrix_has_the_given_sums_and_the_hypergeometric_mean():
    parts, shards = [40, 0, 13, 47], [25, 25, 25, 25]
    drawn = np.array([sharding.communication_matrix(parts, shards, seed) for seed in range(400)])
    assert (drawn.sum(2) == parts).all() and (drawn.sum(1) == shards).all() and (drawn >= 0).all()
    assert np.allclose(drawn.mean(0), np.outer(parts, shards) / 100, atol=0.6)


def test_hypergeometric_follows_its_law():
    rng = np.random.Generator(np.random.PCG64(1))
    drawn = np.array([sharding.hypergeometric(rng, 30, 70, 20) for _ in range(4000)])
    theirs = np.random.default_rng(2).hypergeometric(30, 70, 20, 4000)
    assert abs(drawn.mean() - 6) < 0.1 and abs(drawn.var() - theirs.var()) < 0.35
    assert sharding.hypergeometric(rng, 10**12, 10**12, 10**12) == pytest.approx(5e11, rel=1e-4)


def water_level(sizes: dict, cap: int = 3) -> dict:
    """Share by weight, hold at the cap, share the excess again, until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    left, open_, target = float(sum(sizes.values())), set(order), {}
    while open_:
        total = sum(weight[s] for s in open_)
        above = [s for s in open_ if left * weight[s] / total > cap * sizes[s]]
        if not above:
            return target | {s: left * weight[s] / total for s in open_}
        for s in above:
            target[s] = cap * sizes[s]
        left -= sum(cap * sizes[s] for s in above)
        open_ -= set(above)
    return target


def check_mix(found, docs):
    sizes = Counter()
    for r in docs:
        sizes[r["source"]] += len(edge.words(r["text"]))
    target, taken = water_level(sizes), Counter()
    assert len(found) == len(docs)
    for r in found:
        assert r["size"] == len(edge.words(r["text"])) and 0 <= r["taken"] <= 3 * r["size"]
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(target[r["source"]])
        taken[r["source"]] += r["taken"]
    for source, aim in target.items():
        assert abs(taken[source] - aim) <= max(2, 0.03 * aim), source


def test_mix_meets_its_targets(spark):
    docs = edge.documents(spark)
    check_mix(mixing.mix(docs).collect(), docs.collect())


def test_mix_holds_small_sources_at_the_cap_and_reruns_agree(spark):
    rows = [(i, "a b c d e", None, "big" if i % 10 else "small", 9, *[None] * 8) for i in range(300)]
    docs = spark.createDataFrame(rows, edge.SCHEMA)
    found = mixing.mix(docs, cycle=(1, 9)).collect()
    assert abs(sum(r["taken"] for r in found if r["source"] == "small") - 3 * 30 * 5) <= 4  # a block
    assert max(r["taken"] for r in found) == 15
    again = mixing.mix(docs.repartition(5), cycle=(1, 9)).collect()
    assert Counter((r["doc_id"], r["taken"]) for r in found) == Counter((r["doc_id"], r["taken"]) for r in again)


def test_every_shard_takes_its_quota_of_blocks(spark):
    rng = np.random.default_rng(6)
    rows = [(i, "w " * int(rng.integers(0, 60)), None, "abcd"[min(3, int(rng.integers(0, 9)))], 9, *[None] * 8) for i in range(500)]
    docs = spark.createDataFrame(rows, edge.SCHEMA).repartition(4)
    found = mixing.mix(docs, shards=5, rows_per_part=40).collect()
    sizes = Counter()
    for r in found:
        sizes[r["source"]] += r["size"]
        assert len(r["taken_by_shard"]) == 5 and sum(r["taken_by_shard"]) == r["taken"]
    aims = mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long"))
    taken = Counter()
    for r in found:
        for shard, n in enumerate(r["taken_by_shard"]):
            taken[r["source"], shard] += n
    for q in mixing.apportion(aims, 5).collect():
        most = 3 * sizes[q["source"]]
        first, last = (min(most, b * q["block"]) for b in (q["first_block"], q["first_block"] + q["quota"]))
        assert taken[q["source"], q["shard"]] == last - first, q
    whole = [sum(n for (_, shard), n in taken.items() if shard == k) for k in range(5)]
    assert max(whole) - min(whole) <= 5 * 4096


def test_mixing_nothing_and_no_words(spark):
    assert mixing.mix(edge.nothing(spark)).collect() == []
    bare = spark.createDataFrame([(1, None, None, "a", 0, *[None] * 8), (2, " ", None, None, 0, *[None] * 8)], edge.SCHEMA)
    assert [(r["size"], r["target"], r["taken"]) for r in mixing.mix(bare).collect()] == [(0, 0.0, 0)] * 2


def sainte_lague(targets: list[float], seats: int) -> list[int]:
    won = [0] * len(targets)
    for _ in range(seats):
        best = max(range(len(targets)), key=lambda s: (targets[s] / (2 * won[s] + 1), -s))
        won[best] += 1
    return won


def test_quotas_are_those_of_dealing_seats_one_by_one(spark):
    targets = [513.0, 2040.5, 77.25, 990.0, 4100.0, 333.0]
    aims = spark.createDataFrame(
        [(f"s{i}", 5000, i + 1, 1, t) for i, t in enumerate(targets)], "source string, source_size long, place int, weight int, target double"
    )
    found = mixing.apportion(aims, shards=4).collect()
    block = found[0]["block"]
    seats = round(sum(targets) / block)
    for shard in range(4):
        upto, before = (sainte_lague(targets, seats * s // 4) for s in (shard + 1, shard))
        quota = {r["place"] - 1: r["quota"] for r in found if r["shard"] == shard}
        assert [quota[s] for s in range(6)] == [a - b for a, b in zip(upto, before, strict=True)]
