"""The pipeline stage by stage, each on what the one before kept, against brute force."""

from __future__ import annotations

import random
from collections import Counter

import pytest
import sentencepiece

import corpus_pipeline
from tests.llm import edge
from tests.llm.test_dedup import brute_kept
from tests.llm.test_sharding_mixing import water_level
from tidemark.llm import pieces

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars", "size", "shard"]


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Clean documents, junk, exact and near copies, the awkward rows; labels for half of clean and junk."""
    rng = random.Random(12)
    rows, labels = [], []
    for i in range(200):
        text = edge.sentence(rng, rng.randrange(60, 120))
        junk = i % 5 == 4
        rows.append((i, " ".join(w.upper() + "!!" for w in text.split()) if junk else text))
        if i % 2:
            labels.append((i, int(not junk), 0))
    clean = [r for r in rows if r[0] % 5 != 4]
    rows += [(1000 + i, t) for i, t in clean[:20]]
    for n, (_, t) in enumerate(clean[20:40]):
        words = t.split()
        words[rng.randrange(len(words))] = "verändert"
        rows.append((2000 + n, " ".join(words)))
    rows += [(3000 + n, t) for n, (_, t, *_) in enumerate(edge.rows()[9:16])] + [(None, "ohne Nummer, mit Text")]
    full = [(i, t, "de", None if n % 9 == 0 else f"src{n % 5}", len(t or ""), "own", "own") for n, (i, t) in enumerate(rows)]
    root = tmp_path_factory.mktemp("sf")
    schema = "doc_id long, text string, lang string, source string, n_chars long, size string, shard string"
    spark.createDataFrame(full, schema).repartition(4).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    return str(root)


@pytest.fixture(scope="module")
def stages(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    found = {"documents": [r.asDict() for r in docs.collect()]}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, corpus)
        docs.write.parquet(f"{corpus}/{name}.parquet")
        docs = spark.read.parquet(f"{corpus}/{name}.parquet")
        found[name] = [r.asDict() for r in docs.collect()]
    return found


def rows(stage, *columns) -> Counter:
    return Counter(tuple(r[c] for c in columns or COLUMNS) for r in stage)


def test_all_but_the_last_keep_the_columns(stages):
    for name in [n for n, _ in corpus_pipeline.STAGES][:-1]:
        assert all(list(r) == COLUMNS for r in stages[name])
        assert set(rows(stages[name])) <= set(rows(stages["documents"]))


def test_junk_goes_and_clean_documents_stay(stages):
    kept = {r["doc_id"] for r in stages["quality_classifier"]}
    junk = {i for i in range(200) if i % 5 == 4}
    assert len(kept & junk) <= 1 and set(range(200)) - junk <= kept and None in kept


def test_one_row_of_equal_texts(stages):
    largest = {}
    for r in stages["quality_classifier"]:
        text = r["text"] or ""
        largest[text] = max(x for x in (largest.get(text, -1), -1 if r["doc_id"] is None else r["doc_id"]))
    found = {r["text"] or "": -1 if r["doc_id"] is None else r["doc_id"] for r in stages["exact_dedup"]}
    assert found == largest and len(stages["exact_dedup"]) == len(largest)


def test_one_document_of_near_copies(stages):
    """Four-word shingles, four bits, and nothing else."""
    rows_before = [(r["doc_id"], r["text"]) for r in stages["exact_dedup"]]
    assert rows(stages["near_dedup"], "doc_id", "text") == brute_kept(rows_before)
    assert len(stages["near_dedup"]) < len(rows_before)


def test_the_mix_meets_its_targets_in_whole_documents(stages):
    sizes, taken, largest = Counter(), Counter(), Counter()
    for r in stages["near_dedup"]:
        n = len(edge.words(r["text"]))
        sizes[r["source"]] += n
        largest[r["source"]] = max(largest[r["source"]], n)
    for r in stages["source_mix"]:
        taken[r["source"]] += len(edge.words(r["text"]))
    for source, target in water_level(sizes).items():
        assert abs(taken[source] - target) <= largest[source] / 2 + 0.02 * target + 2
    assert max(rows(stages["source_mix"], "doc_id", "text").values()) <= 3


def test_pieces_decode_to_the_texts(stages):
    assert all(r["lossless"] and r["n_pieces"] == len(r["ids"]) for r in stages["tokenize"])
    model = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    texts = Counter((r["doc_id"], r["text"]) for r in stages["source_mix"])
    assert Counter((r["doc_id"], model.decode(r["ids"])) for r in stages["tokenize"] if r["doc_id"] != 3006) == Counter(
        {k: n for k, n in texts.items() if k[0] != 3006}
    )


def test_run_gives_the_rows_of_the_last_stage(spark, corpus, stages):
    found = corpus_pipeline.run(spark, corpus)
    key = lambda r: (r["doc_id"], r["source"], r["n_pieces"], tuple(r["ids"]))
    assert Counter(map(key, found.collect())) == Counter(map(key, stages["tokenize"]))


def test_an_empty_corpus(spark, corpus, tmp_path):
    docs = spark.read.parquet(f"{corpus}/documents.parquet").limit(0)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{corpus}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
