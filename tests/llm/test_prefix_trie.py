from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"
NAMES = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def name(role: str, text: str) -> bytes:
    return hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()


def brute(rows) -> Counter:
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            turns[c].append((turn is not None, turn or 0, name(role, text), role, text))
    turns = {c: [t[3:] for t in sorted(own)] for c, own in turns.items()}
    paths = {}
    for c, own in turns.items():
        shared = zlib.crc32(str(c).encode()) % 9
        paths[c] = tuple(turns.get(c - int(c - 5 * int(c / 5)), [])[:shared] + own[shared:])
    members = defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    children, leaves, saved = Counter(), Counter(), Counter()
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, own in members.items():
        gain = (len(own) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += gain
    return Counter(
        (
            min(own),
            len(node),
            min(members[node[:-1]]) if node else None,
            len(own),
            children[node],
            leaves[node],
            saved[node],
            hashlib.sha256(",".join(str(c) for c in sorted(own) if paths[c] == node).encode()).hexdigest(),
        )
        for node, own in members.items()
    )


def found(nodes) -> Counter:
    assert tuple(nodes.columns) == NAMES
    return Counter(tuple(r[n] for n in NAMES) for r in nodes.collect())


def conversations(seed: int, n: int):
    """Branching conversations, a very common one, a very long one and its near copies, awkward rows."""
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        path = [rng.choice("ab") for _ in range(rng.randrange(1, 9))]
        rows += [(c, t, "user" if t % 2 else "assistant", "".join(path[: t + 1]) + "é" * rng.randrange(2)) for t in range(len(path))]
    for c in range(1000, 1200, 5):  # with an id that keeps its own turns
        rows += [(c, t, "user", f"gleich {t}") for t in range(4)]
    rows += [(2000, t, "user", f"lang {t}") for t in range(150)]
    for c, cut in ((2003, 150), (2004, 90), (2010, 140), (2011, 9)):
        rows += [(c, t, "user", f"lang {t}" if t < cut else f"anders {t}") for t in range(150)]
    rows += [(3000, 1, None, None), (3000, 1, "", ""), (3000, None, "user", "zuerst"), (3000, 0, None, "b"), (3000, 0, None, "a")]
    rows += [(-7, 0, "user", "minus"), (-5, 0, "user", "minus"), (-5, 1, "user", "minus"), (None, 0, "user", "ohne"), (None, None, None, None)]
    rows += [(3005, 0, "user", "x" * 400_000), (3010, 5, "user", "wieder"), (3010, 5, "user", "wieder")]
    rows += [(3015, t, "us", "er|grenze") for t in range(2)] + [(3020, t, "user", "|grenze") for t in range(2)]
    return rows


@pytest.mark.parametrize("settings", [{}, {"shard_turns": 40}, {"segment": 4, "shard_turns": 60}, {"segment": 1, "shard_turns": 500}])
def test_nodes_against_brute_force(spark, settings):
    rows = conversations(3, 220)
    random.Random(1).shuffle(rows)
    table = spark.createDataFrame(rows, SCHEMA).repartition(5).withColumn("place", F.lit("own")).withColumn("a", F.lit(1))
    assert found(prefix_trie.trie(table, **settings)) == brute(rows)


def test_one_conversation_with_nearly_all_turns(spark, monkeypatch):
    """Its turns are numbered in many partitions, and its segments summed in many spans."""
    monkeypatch.setattr(prefix_trie, "SPAN", 4)
    monkeypatch.setattr(prefix_trie, "PACKET", 40)
    rows = [(0, t // 2, "user", f"viel {t % 7}") for t in range(900)] + [(c, 0, "user", "kurz") for c in range(1, 60)]
    table = spark.createDataFrame(rows, SCHEMA).repartition(6)
    numbered = prefix_trie.numbered(prefix_trie.turns_of(table, "conv_id", "turn", "role", "text"))
    assert sorted(r["place"] for r in numbered.filter("conv = 0").collect()) == list(range(900))
    assert found(prefix_trie.trie(table, segment=16, shard_turns=100)) == brute(rows)


def test_every_splitter_prefix_is_in_the_skeleton():
    key = prefix_trie.key_of(2, -5, 9, bytes(range(48)))
    nodes = list(prefix_trie.walk(key, 10))
    assert [d for d, _, _ in nodes] == [20, 21, 22, 23] and nodes[0][1:] == ((1 << 64) - 5, 9)


def test_an_empty_table_and_turnless_conversations(spark):
    assert prefix_trie.trie(spark.createDataFrame([], SCHEMA)).collect() == []
    assert prefix_trie.trie(spark.createDataFrame([(None, 1, "user", "x")], SCHEMA)).collect() == []
    rows = [(c, 0, "user", "eins") for c in (1, 2, 3, 4, 6, 7, 8, 9, 11, 12)]  # of absent bases: most have no turn left
    assert found(prefix_trie.trie(spark.createDataFrame(rows, SCHEMA))) == brute(rows)
