"""Rows that every operator on texts takes: one word of megabytes, nothing, NULL ids and texts, names that clash."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.llm import edge
from tidemark.llm import anchors, hard_negatives, interpolation, licences, mixing, pieces, quality, sharding, simhash, toxicity, trie

WORD = "ä" + "x" * 600_000
CLASHING = ["id", "text_hash", "print", "of", "component", "chunk", "pack", "sender", "payload", "row", "key", "place", "part", "words"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(1, WORD, "a"), (2, WORD + " y", "a"), (3, None, None), (None, "", "b"), (None, WORD, None), (5, " ", "b"), (5, " ", "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    return df.withColumns({c: F.lit("own") for c in CLASHING})


def labels(spark):
    return spark.createDataFrame([(1, 1, 1), (2, 0, 0), (9, 1, None)], "doc_id long, quality int, toxic int")


OPERATORS = {
    "source mix": lambda s, d: mixing.mix(d),
    "exact dedup": lambda s, d: trie.members(d.select("doc_id", "text"), trie.deduplicate(d)),
    "quality": lambda s, d: quality.score(d, quality.train(d, labels(s), learn=F.lit(True))),
    "substring dedup": lambda s, d: anchors.repeats(d),
    "interpolation": lambda s, d: interpolation.score(d, F.lit(True)),
    "license scan": lambda s, d: licences.scan(d),
    "pieces": lambda s, d: pieces.round_trip(d, pieces.default_model()),
    "simhash": lambda s, d: simhash.near_groups(d),
    "sharding": lambda s, d: sharding.shard(d),
    "toxicity": lambda s, d: toxicity.score(d, toxicity.train(d, labels(s), learn=F.lit(True))),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_for_each_row(spark, docs, name):
    assert sorted(str(r["doc_id"]) for r in OPERATORS[name](spark, docs).select("doc_id").collect()) == sorted(
        ["1", "2", "3", "None", "None", "5", "5"]
    )


@pytest.mark.parametrize("name", OPERATORS)
def test_nothing_gives_nothing(spark, docs, name):
    assert OPERATORS[name](spark, docs.limit(0)).collect() == []


def test_what_they_say_of_the_long_word(spark, docs):
    one = lambda df, column: {(r["doc_id"], r[column]) for r in df.collect() if r["doc_id"] in (1, 2)}
    assert one(mixing.mix(docs), "size") == {(1, 1), (2, 2)}
    assert one(pieces.round_trip(docs, pieces.default_model()), "lossless") == {(1, True), (2, True)}
    assert {r["doc_id"]: r["component_id"] for r in simhash.near_groups(docs).collect()}[1] == 1
    groups = {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in trie.members(docs.select("doc_id", "text"), trie.deduplicate(docs, largest=True)).collect()}
    assert groups[1] == (1, 2) and groups[2] == (2, 1)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and kept.filter("doc_id = 1").count() == 1


def test_other_tables(spark):
    vectors = spark.createDataFrame([(None, None, None)] * 3, "vec_id long, embedding array<float>, label int")
    assert hard_negatives.mine(vectors.withColumns({c: F.lit("own") for c in ("row", "id", "v", "block", "summary", "score")})).collect() == []
