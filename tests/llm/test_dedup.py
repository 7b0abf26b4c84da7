from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm import edge
from tidemark.llm import anchors, components, simhash, trie


def digest(text: str | None) -> str:
    return hashlib.sha256((text or "").encode()).hexdigest()


@pytest.mark.parametrize("budget", [trie.TRIE_BYTES, 3_000])
def test_owners_of_equal_texts(spark, budget):
    docs = edge.documents(spark)
    rows = docs.collect()
    groups = defaultdict(list)
    for r in rows:
        groups[digest(r["text"])].append(r["doc_id"])
    owned = trie.deduplicate(docs, largest=True, trie_bytes=budget)
    assert owned.columns == [c for c in docs.columns if c != "group_size"] + ["group_size", "text_sha256"]
    found = {r["text_sha256"]: r for r in owned.collect()}
    assert found.keys() == groups.keys()
    by_id = defaultdict(list)
    for r in rows:
        by_id[r["doc_id"]].append(r)
    for sha, ids in groups.items():
        largest = max((i for i in ids if i is not None), default=None)
        assert (found[sha]["doc_id"], found[sha]["group_size"]) == (largest, len(ids))
        assert any(found[sha]["text"] == r["text"] and found[sha]["source"] == r["source"] for r in by_id[largest])

    members = trie.members(docs, owned).collect()
    assert Counter((r["doc_id"], r["text_sha256"]) for r in members) == Counter((r["doc_id"], digest(r["text"])) for r in rows)
    kept = Counter(r["text_sha256"] for r in members if r["kept"])
    assert kept == Counter(groups.keys())


def test_smallest_owner_and_nothing(spark):
    docs = spark.createDataFrame([(5, "a"), (2, "a"), (9, "b")], "doc_id long, text string")
    assert sorted((r["doc_id"], r["text"]) for r in trie.deduplicate(docs).collect()) == [(2, "a"), (9, "b")]
    assert trie.deduplicate(edge.nothing(spark)).collect() == []


def test_trie_spills_by_subtree_and_loses_nothing():
    rng = random.Random(3)
    texts = [bytes(rng.choices(b"abc", k=rng.randrange(1, 9))) + bytes(rng.choices(b"xy", k=60)) for _ in range(900)]
    texts += rng.choices(texts, k=500)
    tries = trie.Tries(lambda a, b: (min(a[0], b[0]), a[1] + b[1]), budget=40_000)
    spilt = 0
    for n, text in enumerate(texts):
        tries.insert(text, (n, 1))
        if tries.bytes > 40_000:
            tries.spill()
            spilt += 1
    found = dict(tries.owners())
    first = {}
    for n, text in enumerate(texts):
        first.setdefault(text, n)
    assert spilt and found == {t: (n, texts.count(t)) for t, n in first.items()}


def brute_windows(rows, size: int):
    """Every window's word sequence and where it starts."""
    texts = [edge.words(r["text"]) for r in rows]
    starts = defaultdict(list)
    for d, words in enumerate(texts):
        for i in range(len(words) - size + 1):
            starts[tuple(words[i : i + size])].append((d, i))
    gone = [set() for _ in texts]
    for places in starts.values():
        if len(places) > 1:
            for d, i in places:
                gone[d].update(range(i, i + size))
    return [(len(w), len(g), b" ".join(x for i, x in enumerate(w) if i not in g).decode()) for w, g in zip(texts, gone, strict=True)]


@pytest.mark.parametrize("window", [35, 6])
def test_repeats_match_brute_force(spark, window):
    docs = edge.documents(spark)
    rows = docs.collect()
    expected = Counter((r["doc_id"], *x) for r, x in zip(rows, brute_windows(rows, window), strict=True))
    found = anchors.repeats(docs, window=window).collect()
    assert Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in found) == expected
    assert all(sum(s["last"] - s["first"] for s in r["spans"]) == r["n_removed"] for r in found)
    assert any(r["n_removed"] for r in found)


def test_repeats_of_nothing(spark):
    assert anchors.repeats(edge.nothing(spark)).collect() == []


def brute_print(text: str | None) -> int:
    words = [w.lower() for w in edge.words(text)]
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(nodes: list, linked) -> list:
    root = list(range(len(nodes)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(nodes)):
        for j in range(i):
            if linked(nodes[i], nodes[j]):
                root[find(i)] = find(j)
    return [find(i) for i in range(len(nodes))]


def test_fingerprints_and_their_groups(spark):
    rng = random.Random(8)
    base = edge.sentence(rng, 400).split()
    rows = [(i, t) for i, (_, t, *_) in enumerate(edge.rows())]
    for n in range(25):  # near copies: a few words changed
        words = list(base)
        for _ in range(n % 6):
            words[rng.randrange(400)] = f"neu{n}"
        rows.append((1000 + n, " ".join(words)))
    rows.append((None, "allein"))
    rows.append((1000, " ".join(base)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    prints = [brute_print(t) for _, t in rows]
    roots = brute_components(prints, lambda a, b: (a ^ b).bit_count() <= 4)
    least = {}
    for (i, _), r in zip(rows, roots, strict=True):
        least[r] = min((x for x in (least.get(r), i) if x is not None), default=None)
    expected = Counter((i, f"{p:016x}", least[r]) for (i, _), p, r in zip(rows, prints, roots, strict=True))
    found = simhash.near_groups(docs).collect()
    assert Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in found) == expected
    assert len(set(least.values())) < len(set(prints))


def test_ball_hashing_links_all_within_the_radius(spark):
    rng = random.Random(4)
    prints = [rng.getrandbits(64) for _ in range(30)]
    for p in prints[:15]:
        for flips in (1, 2, 3, 4, 5):
            q = p
            for b in rng.sample(range(64), flips):
                q ^= 1 << b
            prints.append(q)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    links = simhash.links(spark.createDataFrame([(p,) for p in signed], "print long"))
    found = [(r["a"] & (1 << 64) - 1, r["b"] & (1 << 64) - 1) for r in links.collect()]
    assert all((a ^ b).bit_count() <= 4 or brute_chain(prints, a, b) for a, b in found)
    mine = brute_components(prints, lambda a, b: (a, b) in found or (b, a) in found)
    theirs = brute_components(prints, lambda a, b: (a ^ b).bit_count() <= 4)
    assert partition(mine) == partition(theirs)


def brute_chain(prints, a, b) -> bool:
    roots = dict(zip(prints, brute_components(prints, lambda x, y: (x ^ y).bit_count() <= 4), strict=True))
    return roots[a] == roots[b]


def partition(roots) -> set:
    groups = defaultdict(set)
    for i, r in enumerate(roots):
        groups[r].add(i)
    return {frozenset(g) for g in groups.values()}


def test_near_groups_of_nothing(spark):
    assert simhash.near_groups(edge.nothing(spark)).collect() == []
    assert simhash.keep_one(edge.nothing(spark)).collect() == []


def brute_kept(rows) -> Counter:
    """Of each group the row that comes first by (no id, id, signed fingerprint)."""
    prints = [brute_print(t) for _, t in rows]
    roots = brute_components(prints, lambda a, b: (a ^ b).bit_count() <= 4)
    first = {}
    for (i, t), p, root in zip(rows, prints, roots, strict=True):
        place = (i is None, i or 0, p - (1 << 64) if p >> 63 else p)
        first[root] = min(first.get(root, (place, t)), (place, t), key=lambda x: x[0])
    return Counter((None if place[0] else place[1], t) for place, t in first.values())


def test_keep_one_of_near_copies(spark):
    rng = random.Random(5)
    rows = [(i, edge.sentence(rng, 300)) for i in range(12)]
    for i in range(12):
        words = rows[i % 6][1].split()
        for _ in range(1 + i % 3):
            words[rng.randrange(300)] = f"geändert{i}"
        rows.append((100 + i, " ".join(words)))
    rows += [(None, rows[3][1] + " ende"), (None, None), (7, ""), (5, edge.sentence(rng, 200))]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    expected = brute_kept(rows)
    assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == expected
    assert 12 <= expected.total() < len(rows) - 6


def test_keep_one_takes_awkward_rows(spark):
    docs = edge.documents(spark).withColumn("gone_id", F.lit(1)).withColumn("print", F.lit("own"))
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    # Repeated rows stay together.
    assert {(r["doc_id"], r["text"] or "") for r in kept.collect()} == {(i, t or "") for i, t in brute_kept(rows)}


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, 1000 + i) for i in range(300)] + [(5, 5)]
    found = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 100 for i in range(100, 161)} | {i: 7 for i in [7, *range(1000, 1300)]}
