from __future__ import annotations

import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import edge
from tidemark.llm import toxicity
from tidemark.llm.text import id_remainder

INSULTS = "blödling dummbart schurkisch widerling".split()


def corpus(n: int = 400, seed: int = 4):
    """Every fourth text holds insults (one of them with another ending), some in the midst of a long one."""
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = edge.sentence(rng, 400 if i % 20 == 0 else rng.randrange(20, 90)).split()
        bad = i % 4 == 0
        if bad:
            for _ in range(2):
                words[rng.randrange(len(words))] = rng.choice(INSULTS) + rng.choice(["", "", "er", "es", "!"])
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(bad)))
    return rows, labels


def learnt(spark, rows, labels, **settings):
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("Score", F.lit("own"))
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return docs, toxicity.train(docs, table, learn=id_remainder(F.col("doc_id"), 5) != 0, **settings)


def test_held_out_texts_and_awkward_rows(spark):
    rows, labels = corpus()
    rows += [(1000 + n, t) for n, (_, t, *_) in enumerate(edge.rows()[9:16])] + [(None, "ein widerling"), (5, rows[4][1])]
    labels += [(7, 1, None), (None, 1, 1), (4, 1, 1)]
    docs, model = learnt(spark, rows, labels)
    scored = toxicity.score(docs, model)
    assert scored.columns == ["doc_id", "text", "score", "predicted"]
    found = defaultdict(list)
    for r in scored.collect():
        found[r["doc_id"]].append((r["score"], r["predicted"]))
    assert sum(map(len, found.values())) == len(rows)
    assert all(0 <= s <= 1 and p == (s >= 0.5) for each in found.values() for s, p in each)
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0 and i != 5]
    assert sum(found[i][0][1] == (i % 4 == 0) for i in held) / len(held) >= 0.97
    none = 1 / (1 + math.exp(-model.bias))
    assert found[1001] == found[1002] and found[1001][0][0] == pytest.approx(none)
    assert sorted(p for _, p in found[5]) == [0, 1]


def test_scores_are_those_of_the_worst_window(spark):
    rows, labels = corpus(200)
    docs, model = learnt(spark, rows, labels)
    weight = dict(zip(model.terms.tolist(), model.weights.tolist(), strict=True))

    def brute(text: str) -> float:
        words = toxicity.word_keys(text)
        sums = []
        for start in range(0, max(1, len(words) - 16), 16) if len(words) else []:
            total, part = 0.0, words[start : start + 32]
            for k in range(len(part)):
                total += weight.get(int(part[k][0]), 0.0)
                for n in range(4, 9):
                    total += weight.get(int(toxicity.stem_keys(part[k : k + 1], n)[0]), 0.0)
                if k:
                    total += weight.get(int(toxicity.pair_keys(part[k - 1 : k, 0], part[k : k + 1, 0])[0]), 0.0)
            sums.append(total)
        return 1 / (1 + math.exp(-(model.bias + max(sums, default=0.0))))

    texts = [t for _, t in rows[:60]] + ["", "widerling", edge.LONG + " dummbart blödling " + edge.LONG, "x" * 3_000_000]
    assert model.scores(texts) == pytest.approx([brute(t) for t in texts], abs=1e-9)


def neutral_mentions(fairness: float) -> tuple[float, float]:
    """Half of the toxic texts name a group and bear no other mark. Scores of a neutral mention and of an insult."""
    rng = random.Random(11)
    bags = []
    for i in range(600):
        words = edge.sentence(rng, 24).split()
        bad = i % 3 == 0
        if bad:
            words[rng.randrange(24)] = "muslims"
            if i % 2:
                words[rng.randrange(24)] = rng.choice(INSULTS)
        elif i % 3 == 1:
            words[rng.randrange(24)] = rng.choice(["people", "christians"])
        bags.append((int(bad), toxicity.sample(toxicity.word_keys(" ".join(words)))))
    model = toxicity.fit(bags, fairness)
    base = edge.sentence(random.Random(77), 20)
    return tuple(model.scores([f"{base} muslims", f"{base} widerling"]))


def test_the_penalty_spares_neutral_mentions():
    plain, fair = neutral_mentions(0.0), neutral_mentions(toxicity.FAIRNESS)
    assert plain[0] > 0.5 > fair[0]
    # Without it the name explains the labels and the insults are not even learnt.
    assert fair[1] > 0.5 > plain[1]


def test_swaps_change_the_terms_round_a_name():
    sets = toxicity.swap_sets()
    words = toxicity.word_keys("the muslims live here")
    others = {int(k[0]) for w in toxicity.IDENTITY_TERMS[1] for k in toxicity.word_keys(w)} - {int(words[1, 0])}
    assert {int(o[0]) for o in sets[int(words[1, 0])]} == others
    every = sorted({int(k) for o in [words[1], *sets[int(words[1, 0])]] for k in toxicity.near_terms(words[0, 0], o, words[2, 0])} - {0})
    terms = np.array(every, np.uint64)
    # The second text says the same again, so it adds no row.
    changes = toxicity.score_changes(toxicity.Windows([[words], [words]]), terms, len(terms) + 1, sets)
    assert changes.shape == (len(others), len(terms) + 1)
    weights = np.random.default_rng(1).normal(size=len(terms))
    model = toxicity.Model(terms, weights, 0.0)
    texts = [f"the {w} live here" for w in toxicity.IDENTITY_TERMS[1] if w != "muslims"]
    logit = lambda p: np.log(p / (1 - p))
    expected = logit(model.scores(["the muslims live here"])) - logit(model.scores(texts))
    assert sorted(changes.times(np.append(weights, 5.0))) == pytest.approx(sorted(expected))
    assert sum(len(g) for g in toxicity.IDENTITY_TERMS) < 200


def test_windows_hold_what_scoring_sums():
    rng = random.Random(2)
    texts = [[toxicity.word_keys(edge.sentence(rng, n))] for n in (1, 2, 16, 17, 32, 33, 48, 49, 200)] + [[toxicity.word_keys("")]]
    windows = toxicity.Windows(texts)
    terms = np.unique(np.concatenate([k for _, k, _ in windows.terms()]))
    weights = np.random.default_rng(3).normal(size=len(terms))
    model = toxicity.Model(terms, weights, 0.0)
    counted = toxicity.Rows.counted(windows, terms, len(terms)).times(weights)
    direct = []
    for (words,) in texts:
        first = toxicity.window_starts(len(words))
        if len(first):
            direct += model.windows(words, first, np.minimum(first + toxicity.WINDOW, len(words))).tolist()
    assert counted == pytest.approx(direct)


def test_a_word_repeated_counts_once(spark):
    rows, labels = corpus(200)
    _, model = learnt(spark, rows, labels)
    base = edge.sentence(random.Random(5), 20)
    said = [f"{base} {w} {base}" for w in ("haus3", "haus3 " * 300, "widerling", "widerling " * 300)]
    scores = model.scores(said)
    assert scores[0] == scores[1] < 0.5 < scores[2] == scores[3]


def test_copies_and_shared_passages_teach_nothing():
    rng = random.Random(3)
    passage = edge.sentence(rng, 40)
    texts = [(1, f"{passage} {edge.sentence(rng, 30)}") for _ in range(40)] + [(1, edge.sentence(rng, 60))] * 30
    texts += [(0, edge.sentence(rng, 60)) for _ in range(200)]
    model = toxicity.fit([(y, toxicity.sample(toxicity.word_keys(t))) for y, t in texts])
    fresh = [edge.sentence(rng, 60) for _ in range(50)]
    assert (model.scores(fresh) >= 0.5).mean() <= 0.1


def test_without_labels_or_documents(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.train(docs, none, learn=F.lit(True))
    assert [(r["score"], r["predicted"]) for r in toxicity.score(docs, model).collect()] == [(0.0, 0)] * 2
    assert toxicity.score(edge.nothing(spark), model).collect() == []
    only_empty = toxicity.train(docs, spark.createDataFrame([(2, 1)], "doc_id long, toxic int"), learn=F.lit(True))
    assert only_empty.scores([""])[0] > 0.99
