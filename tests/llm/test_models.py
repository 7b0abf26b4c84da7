from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import edge
from tidemark.llm import ann_tree, interpolation, pieces, quality
from tidemark.llm.text import id_remainder

MODEL = pieces.default_model()


# nearest neighbours


def brute_neighbours(rows, every: int, k: int):
    good = [(i, np.array(v, float)) for i, v in rows if v and None not in v and np.isfinite(v).all() and np.any(v)]
    good = [(i, v) for i, v in good if len(v) == 8]
    return {
        i: sorted((float(np.sqrt(((v - w) ** 2).sum())), j) for j, w in good if j != i)[:k] for i, v in good if i % every == 0
    }


@pytest.mark.parametrize("settings", [{}, {"leaf_rows": 16}])
def test_neighbours_against_brute_force(spark, settings):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 8)) * 4
    rows = [(i, (centres[i % 12] + rng.normal(size=8)).tolist()) for i in range(900)]
    rows += [(1000 + i, rows[3][1]) for i in range(40)]  # one very common vector
    rows += [(2000, None), (2001, []), (2002, [0.0] * 8), (2003, [1.0] * 7 + [float("nan")]), (2004, [1.0] * 7 + [None])]
    rows += [(2005, [1.0] * 5), (2006, [float("inf")] * 8)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("leaf", F.lit("own"))
    truth = brute_neighbours(rows, 20, 10)
    found = defaultdict(list)
    for r in ann_tree.neighbours(vectors.repartition(5), every=20, k=10, **settings).collect():
        found[r["query_id"]].append((r["rank"], r["score"], r["vec_id"]))
    assert found.keys() == truth.keys()
    hits = 0
    for q, near in truth.items():
        mine = [(s, i) for _, s, i in sorted(found[q])]
        assert [r for r, _, _ in sorted(found[q])] == list(range(1, 11)) and mine == sorted(mine)
        distances = dict((j, d) for d, j in brute_neighbours(rows, 20, len(rows))[q])
        assert all(s == pytest.approx(distances[i], rel=1e-12) for s, i in mine)
        hits += len({i for _, i in mine} & {i for _, i in near})
    assert hits / (10 * len(truth)) >= 0.9


def test_a_query_id_with_several_vectors_asks_with_the_smallest(spark):
    rows = [(0, [2.0, 0.0]), (0, [1.0, 5.0]), (0, [1.0, 4.0]), (1, [1.0, 3.5]), (2, [2.0, 0.1]), (3, [2.0, 0.1])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("v", F.lit("own")).withColumn("score", F.lit(1))
    for parts in (1, 4):
        found = ann_tree.neighbours(table.repartition(parts), every=100, k=2).orderBy("rank").collect()
        assert [(r["vec_id"], r["score"]) for r in found] == [(1, 0.5), (2, pytest.approx(math.hypot(1, 3.9)))]
        assert all(0 < r["calibrated_recall"] <= 1 for r in found)


def test_fewer_candidates_than_wanted_and_none(spark):
    three = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0, 3.0]), (2, [1.0, 1.0])], "vec_id long, embedding array<float>")
    found = ann_tree.neighbours(three, every=100).orderBy("rank").collect()
    assert [(r["query_id"], r["vec_id"], r["score"]) for r in found] == [(0, 1, 1.0), (0, 2, 1.0)]
    assert ann_tree.neighbours(three.limit(0), every=100).collect() == []


# quality


def test_quality_on_held_out_rows_and_awkward_ones(spark):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(300):
        text, good = edge.sentence(rng, 60), i % 3 > 0
        if not good:
            text = text.upper().replace(" ", "!! ") if i % 2 else " ".join(f"{w}###" for w in text.split())
        rows.append((i, text))
        labels.append((i, int(good)))
    labels += [(7, None), (None, 1), (5, labels[5][1])]
    rows += [(1000 + n, t) for n, (_, t, *_) in enumerate(edge.rows()[9:16])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("Score", F.lit("own"))
    held = id_remainder(F.col("doc_id"), 3) == 1
    model = quality.train(docs, spark.createDataFrame(labels, "doc_id long, quality int"), learn=~held)
    assert len(model.labels) == sum(zlib.crc32(str(i).encode()) % 3 != 1 for i, q in labels if q is not None and i is not None)
    found = {r["doc_id"]: r for r in quality.score(docs, model).collect()}
    assert len(found) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in found.values())
    apart = [i for i in range(300) if zlib.crc32(str(i).encode()) % 3 == 1]
    assert sum(found[i]["predicted"] == labels[i][1] for i in apart) / len(apart) > 0.95
    assert found[1001]["score"] == pytest.approx(model.prior)


def test_labels_that_depend_on_wording_alone_are_learnt(spark):
    """Good and bad texts of the same shapes: lower-case words, a fifth of them from a list that tells them apart."""
    rng = random.Random(8)
    common = ["".join(rng.choices("abcdefghij", k=5)) for _ in range(300)]
    telling = {1: "vertrag quelle befund".split(), 0: "gewinn sofort klicke".split()}
    rows = []
    for i in range(400):
        words = [rng.choice(telling[i % 2]) if rng.random() < 0.2 else rng.choice(common) for _ in range(80)]
        rows.append((i, " ".join(words)))
    held = id_remainder(F.col("doc_id"), 3) == 1
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, quality int")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = quality.score(docs, quality.train(docs, labels, learn=~held)).filter(held).collect()
    assert sum(r["predicted"] == r["doc_id"] % 2 for r in found) / len(found) > 0.9


def test_the_wording_gets_the_weight_that_votes_best():
    rng = np.random.default_rng(4)
    y = rng.integers(0, 2, 300).astype(float)
    noise = rng.poisson(0.3, (300, quality.TERMS)).astype(np.float32)
    form, wording = noise.copy(), noise.copy()
    form[:, 5] += 40 * y
    wording[:, quality.SHAPE_TERMS + 5] += 40 * y
    assert quality.fit(form, y).wording < quality.fit(wording, y).wording
    for x in (form, wording):
        assert quality.left_out(quality.fit(x, y)) > 0.95


def test_votes_are_those_of_all_cosines(spark):
    rng = np.random.default_rng(5)
    x = np.log1p(rng.poisson(0.05, (200, quality.TERMS))).astype(np.float32)
    y = rng.integers(0, 2, 200).astype(float)
    model = quality.fit(x, y)
    got = model.scores(x[:20])
    for i in range(20):
        cosine = model.vectors @ model.project(x[i : i + 1])[0]
        near = np.argsort(-cosine, kind="stable")[: quality.NEIGHBOURS]
        weight = np.maximum(cosine[near], 0)
        assert got[i] == pytest.approx((weight * y[near]).sum() / weight.sum(), abs=1e-5)


def test_quality_without_labels_or_documents(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    model = quality.train(docs, none, learn=F.lit(True))
    assert [r["score"] for r in quality.score(docs, model).collect()] == [0.5, 0.5]
    assert quality.score(edge.nothing(spark), model).collect() == []


# language model


def brute_language_model(rows):
    tokens = [edge.words((t or "").encode().lower().decode()) + [None] for _, t in rows]
    learn = [zlib.crc32(("" if i is None else str(i)).encode()) % 5 != 1 for i, _ in rows]
    ones, twos, contexts = Counter(), Counter(), Counter()
    for words, use in zip(tokens, learn, strict=True):
        if use:
            ones.update(words)
            twos.update(zip([b"", *words], words, strict=False))
            contexts.update([b"", *words[:-1]])
    return tokens, learn, ones, twos, contexts


def test_scores_against_brute_force(spark):
    rows = [(r[0], r[1]) for r in edge.rows(seed=6, n=80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    learn = id_remainder(F.col("doc_id"), 5) != 1
    _, corpus = interpolation.model(docs, learn)
    tokens, learned, ones, twos, contexts = brute_language_model(rows)
    total, kinds = sum(ones.values()), len(ones)
    assert (corpus.train_tokens, corpus.kinds, corpus.train_texts) == (total, kinds, sum(learned))
    assert np.allclose(corpus.weights.sum(1), 1)
    expected = []
    for (i, _), words, use in zip(rows, tokens, learned, strict=True):
        base = sum(math.log10((ones[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in words)
        score = 0.0
        for v, w in zip([b"", *words], words, strict=False):
            two, one, none = corpus.weights[int(interpolation.context_bucket(np.array([contexts[v]]))[0])]
            pair = twos[v, w] / contexts[v] if contexts[v] else 0.0
            score += math.log10(two * pair + one * ones[w] / total + none / (kinds + 1))
        known = sum(ones[w] > 0 for w in words)
        expected.append((i is None, i or 0, not use, len(words), known, total, round(base, 4), round(score, 4)))
    found = [
        (r["doc_id"] is None, r["doc_id"] or 0, r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"])
        + (round(r["base_score"], 4), round(r["score"], 4))
        for r in interpolation.score(docs, learn).collect()
    ]
    assert len(found) == len(expected)
    for got, want in zip(sorted(found), sorted(expected), strict=True):
        assert got[:6] == want[:6] and got[6:] == pytest.approx(want[6:], abs=2e-3)


def test_deleted_counts_are_those_of_the_other_chunks():
    rows = [(1, b"a b a c", True), (2, b"a b", True), (3, b"b c", False)]
    chunk = interpolation.Tokens(rows)
    words = chunk.own_words + 3
    pairs = chunk.own_pairs + 1
    cells, counts = interpolation.histogram(chunk, words, pairs, train_tokens=int(words.sum()), train_texts=9)
    assert counts.sum() == 8  # training tokens only
    p1 = 3 / (3 * len(chunk.words))
    assert {int(c) % interpolation.STEPS for c in cells} == {int(interpolation.step(np.array([p1]))[0])}


def test_em_finds_the_mixture():
    rng = np.random.default_rng(1)
    p2, p1 = rng.choice([0.5, 0.001, 0.0], 4000), rng.choice([0.2, 0.004], 4000)
    cells = (5 * interpolation.STEPS + interpolation.step(p2)) * interpolation.STEPS + interpolation.step(p1)
    cells, counts = np.unique(cells, return_counts=True)
    weights = interpolation.learn_weights(cells, counts, 1000)[5]
    p = np.stack([interpolation.unstep(cells // interpolation.STEPS % interpolation.STEPS), interpolation.unstep(cells % interpolation.STEPS), np.full(len(cells), 1 / 1001)], 1)

    def likelihood(w):
        return (counts * np.log(p @ w)).sum()

    best = max(likelihood(np.array([a, b, 1 - a - b])) for a in np.linspace(0.01, 0.97, 97) for b in np.linspace(0.01, 0.97, 97) if a + b < 0.999)
    assert likelihood(weights) >= best - 1e-3 * abs(best)


def test_scoring_nothing(spark):
    assert interpolation.score(edge.nothing(spark), F.lit(True)).collect() == []


def test_context_beats_the_base_on_held_out_text(spark):
    rng = random.Random(9)
    follow = {w: rng.sample(range(50), 3) for w in range(50)}
    rows = []
    for i in range(150):
        words = [rng.randrange(50)]
        for _ in range(80):
            words.append(rng.choice(follow[words[-1]]))
        rows.append((i, " ".join(f"w{w}" for w in words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    held = interpolation.score(docs, id_remainder(F.col("doc_id"), 5) != 1).filter("held_out").collect()
    assert held and sum(r["score"] for r in held) > 0.5 * sum(r["base_score"] for r in held)


# pieces


def test_without_dropout_the_pieces_are_the_models_own(spark):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = [t for _, t, *_ in edge.rows() if t and "▁" not in t] + ["  zwei  Räume ", "a\n\n b", "你好 мир", "x" * 3000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pieces.encode(docs, MODEL, dropout=0.0).collect():
        assert r["ids"] == model.encode(r["text"]), r["text"][:50]


def test_dropout_varies_by_key_and_decodes_to_the_text(spark):
    docs = edge.documents(spark)
    first = pieces.round_trip(docs, MODEL, dropout=0.3, seed=1).collect()
    again = pieces.round_trip(docs.repartition(5), MODEL, dropout=0.3, seed=1).collect()
    other = pieces.round_trip(docs, MODEL, dropout=0.3, seed=2).collect()
    key = lambda rows: Counter((r["doc_id"], r["text"], tuple(r["ids"])) for r in rows)
    assert key(first) == key(again) != key(other)
    assert all(r["lossless"] and r["decoded"] == (r["text"] or "") for r in [*first, *other])
    assert all(r["ids"] == [] for r in first if not r["text"])
    plain = {(r["doc_id"], r["text"]): len(r["ids"]) for r in pieces.encode(docs, MODEL, dropout=0.0).collect()}
    assert sum(len(r["ids"]) for r in first) > sum(plain[r["doc_id"], r["text"]] for r in first)
    assert pieces.round_trip(edge.nothing(spark), MODEL).collect() == []
    stored = pieces.decode(pieces.encode(docs, MODEL, dropout=0.3, seed=1), MODEL)
    assert key(stored.collect()) == key(first) and stored.filter("decoded <> coalesce(text, '')").count() == 0


def one_by_one(words, texts, documents, rate):
    """Every occurrence by an agenda of its own."""
    found = []
    for text, key in zip(texts, documents.tolist(), strict=True):
        written = pieces.SPACE + text.replace(pieces.SPACE, pieces.OWN_SPACE).replace(" ", pieces.SPACE) if text else ""
        units = re.findall(words.units, written)
        keys = pieces.occurrence_keys(np.full(len(units), key, np.uint64), np.arange(len(units)))
        ids = [words.encode_unit(u, int(k), int(rate * 2**64)) for u, k in zip(units, keys, strict=True)]
        found.append(np.concatenate([np.zeros(0, "<i4"), *ids]).tolist())
    return found


@pytest.mark.parametrize("rate", [0.0, 0.1, 0.7, 1.0])
def test_encoding_together_equals_one_agenda_each(rate, monkeypatch):
    monkeypatch.setattr(pieces, "CACHED_UNITS", 900)  # emptied now and then
    rng = random.Random(7)
    words, cache = pieces.vocabulary(MODEL), pieces.Cache()
    for _ in range(6):
        texts = [
            " ".join("".join(rng.choices("abcdefgitnersoué▁ßñ你.,-0😀", k=rng.randrange(30))) for _ in range(rng.randrange(60)))
            for _ in range(40)
        ] + ["", "x" * 5_000, "the the the\n the  the", "▁"]
        documents = np.random.default_rng(len(texts)).integers(0, 1 << 63, len(texts)).astype(np.uint64)
        ids, counts = words.encode(texts, documents, rate, cache)
        ends = np.concatenate(([0], np.cumsum(counts)))
        assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:], strict=False)] == one_by_one(words, texts, documents, rate)


def test_every_occurrence_is_drawn_for_by_itself(spark):
    """No bound on the cuts of a word: they grow with its occurrences, in one document and over many."""
    texts = [(i, " ".join(["international"] * 200)) for i in range(20)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    cuts = Counter()
    words = pieces.vocabulary(MODEL)
    begin = {i for i, o in enumerate(words.octets) if o.startswith(b" ")}
    per_document = []
    for r in pieces.encode(docs, MODEL, dropout=0.1).collect():
        starts = [n for n, i in enumerate(r["ids"]) if i in begin]
        own = {tuple(r["ids"][a:b]) for a, b in zip(starts, [*starts[1:], None], strict=True)}
        per_document.append(len(own))
        cuts.update(own)
    assert min(per_document) > 4 and len(cuts) > 2 * max(per_document)


def test_all_dropped_leaves_characters():
    words = pieces.vocabulary(MODEL)
    ids, _ = words.encode(["ab ▁c"], np.ones(1, np.uint64), 1.0, pieces.Cache())
    assert words.decode(ids) == "ab ▁c" and len(ids) == 3 + 1 + 3 + 1


def test_scores_of_a_chunk_take_few_bytes_a_token(monkeypatch):
    """Predictions are made span by span, with the same results, so a chunk holds little beside its tokens."""
    import tracemalloc

    monkeypatch.setattr(interpolation, "SPAN", 1 << 13, raising=False)
    rng = np.random.default_rng(5)
    rows = [(n, b" ".join(b"w%d" % w for w in rng.zipf(1.3, 2000) % 5000), n % 3 > 0) for n in range(100)] + [(100, b"", True)]
    chunk = interpolation.Tokens(iter(rows))
    words, pairs = chunk.own_words + 2, chunk.own_pairs + 1
    corpus = interpolation.Corpus(10**6, 5000, 90, rng.dirichlet([1, 1, 1], interpolation.CONTEXTS))

    def run():
        cells = interpolation.histogram(chunk, words, pairs, 10**6, 90)
        return [cells, *interpolation.log_scores(chunk, words, pairs, corpus)]

    tracemalloc.start()
    found = run()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 * len(chunk.word_at)
    monkeypatch.setattr(interpolation, "SPAN", 1 << 30)
    for a, b in zip(found, run(), strict=True):
        assert np.array_equal(a, b)
