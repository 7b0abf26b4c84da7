"""Language-model scoring by deleted interpolation.

P(w | v) = l2 * c(v w) / c(v) + l1 * c(w) / N + l0 / (V + 1), with the weights l depending on how often the context v
was seen (``context_bucket``). The weights are learned by expectation-maximisation on held-out counts: each chunk of
the corpus in turn is the deleted part, and its training tokens are predicted from the counts of all the others (total
less own). What EM needs of a token are its context bucket and its two probabilities, so the whole corpus is one
histogram over a fixed grid of quarter-octave steps, and only that grid reaches the driver.

Counts never leave Spark: every chunk asks for the totals of the words and word pairs that it holds (see ``packets``)
and is stored together with the answers, once for both the histogram and the scores.

Tokens: words with ASCII letters lower-cased, then one end per text; the context of the first is a begin mark. A word or
pair is told by six bytes of its hash and the bits of its bucket, which grow with the input: 54 bits at least, 59 at 30 GB,
so that among n different pairs some n * n / 2^60 are taken for another there (about one among a billion).

Defined results: NULL counts as empty text, which is one end token; NULL ids are kept, and learnt from if the empty text would
be as an id; repeated rows are scored one by one; a text of any length is scored whole, a word of any length is one token;
without any training text every probability is 1 / (V + 1) = 1; an empty table gives no rows; further columns, whatever their
names, are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.durable import materialise
from tidemark.llm import packets
from tidemark.llm.text import whole

CHUNK_BYTES = 8 << 20
KEY_BYTES = 6
BEGIN, END = np.uint64(0x1B873593CC9E2D51), np.uint64(0x85EBCA6BC2B2AE35)
CONTEXTS = 16
STEPS = 160  # quarter octaves, 40 octaves in all; 0 stands for probability zero
EM_ROUNDS = 200
SPAN = 1 << 17  # tokens that are predicted at once


def spans(n: int) -> Iterator[slice]:
    return (slice(start, min(start + SPAN, n)) for start in range(0, n, SPAN))


def context_bucket(count: np.ndarray) -> np.ndarray:
    """0 for an unseen context, then by the binary logarithm of its count."""
    return np.where(count > 0, np.minimum(np.log2(np.maximum(count, 1)).astype(np.int64) + 1, CONTEXTS - 1), 0)


def step(p: np.ndarray) -> np.ndarray:
    return np.where(p > 0, np.clip(np.rint(-4 * np.log2(np.maximum(p, 1e-300))) + 1, 1, STEPS - 1), 0).astype(np.int64)


def unstep(s: np.ndarray) -> np.ndarray:
    return np.where(s > 0, 2.0 ** (-(s - 1) / 4), 0.0)


def places(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, and of each key its place among them, in four bytes: a chunk has fewer than 2^31 tokens."""
    index, place = np.unique(keys, return_inverse=True)
    return index, place.astype(np.int32)


class Tokens:
    """The tokens of a chunk as hashes, with their contexts, and the distinct words and pairs."""

    def __init__(self, rows):
        self.ids, self.learn, parts = [], [], []
        for key, text, learn in rows:
            self.ids.append(key)
            self.learn.append(bool(learn))
            parts.append(np.append(packets.word_hashes(text.lower().split()), END))
        self.lengths = np.array([len(p) for p in parts], np.int64)
        self.starts = np.concatenate(([0], np.cumsum(self.lengths)))[:-1]
        words = np.concatenate(parts)
        del parts
        before = np.concatenate(([BEGIN], words[:-1]))
        before[self.starts] = BEGIN
        self.learned = np.repeat(np.array(self.learn, bool), self.lengths)
        one, two = packets.coefficients(2, 3)
        # The context's place among the words is that of the token before; the begin mark is no word.
        self.begins = before == BEGIN
        pairs = packets.mix64(before * one + words * two)
        del before
        self.words, self.word_at = places(words)
        del words
        self.pairs, self.pair_at = places(pairs)
        self.own_words = np.bincount(self.word_at, weights=self.learned, minlength=len(self.words)).astype(np.int64)
        self.own_pairs = np.bincount(self.pair_at, weights=self.learned, minlength=len(self.pairs)).astype(np.int64)

    def contexts(self, at: slice, words: np.ndarray, begin: int) -> np.ndarray:
        """How often the contexts of some tokens were seen: by their ``words`` counts, or ``begin`` times the begin mark."""
        before = self.word_at[max(0, at.start - 1) : at.stop - 1]
        before = before if at.start else np.append(np.int32(0), before)
        return np.where(self.begins[at], begin, words[before])

    def request(self) -> packets.Kinds:
        return [(self.words, (packets.smallest(self.own_words),)), (self.pairs, (packets.smallest(self.own_pairs),))]


def total_counts(kind: int, asked: list) -> list:
    """Of each key how often it occurs in training, and whether this packet is the one that counts it as a kind of word."""
    index, place = np.unique(np.concatenate([k for k, _ in asked]), return_inverse=True)
    total = np.bincount(place, weights=np.concatenate([n for _, (n,) in asked]), minlength=len(index)).astype(np.int64)
    first = np.zeros(len(place), np.uint8)
    first[np.unique(place, return_index=True)[1]] = 1
    counted = first * (total[place] > 0) if kind == 0 else np.zeros(len(place))
    bounds = np.cumsum([len(k) for k, _ in asked])[:-1]
    parts = zip(np.split(place, bounds), np.split(counted.astype(np.uint8), bounds), strict=True)
    return [(packets.smallest(total[p]), c) for p, c in parts]


def histogram(tokens: Tokens, words: np.ndarray, pairs: np.ndarray, train_tokens: int, train_texts: int) -> np.ndarray:
    """(cell, count) rows of the chunk's training tokens, predicted from the counts of all other chunks."""
    words, pairs = words.astype(np.int64) - tokens.own_words, pairs.astype(np.int64) - tokens.own_pairs
    rest = train_tokens - int(tokens.own_words.sum())
    texts = train_texts - int((tokens.learned & tokens.begins).sum())
    cell = np.empty(len(tokens.word_at), np.int32)
    for at in spans(len(cell)):
        context = tokens.contexts(at, words, texts)
        p2 = np.where(context > 0, pairs[tokens.pair_at[at]] / np.maximum(context, 1), 0.0)
        p1 = words[tokens.word_at[at]] / max(1, rest)
        cell[at] = (context_bucket(context) * STEPS + step(p2)) * STEPS + step(p1)
    cells, counts = np.unique(cell[tokens.learned], return_counts=True)
    return np.stack([cells.astype(np.int64), counts])


@dataclass
class Corpus:
    """What scoring needs besides the stored chunks. weights: (CONTEXTS, 3) for pair, word and uniform."""

    train_tokens: int
    kinds: int
    train_texts: int
    weights: np.ndarray


def learn_weights(cells: np.ndarray, counts: np.ndarray, kinds: int) -> np.ndarray:
    """Expectation-maximisation in every context bucket; a bucket without held-out tokens takes the common weights."""
    bucket, p2, p1 = cells // STEPS**2, unstep(cells // STEPS % STEPS), unstep(cells % STEPS)
    p = np.stack([p2, p1, np.full(len(cells), 1 / (kinds + 1))], 1)

    def run(at: np.ndarray, start: np.ndarray) -> np.ndarray:
        weights = start
        for _ in range(EM_ROUNDS):
            shares = p[at] * weights
            shares /= shares.sum(1, keepdims=True)
            weights = (shares * counts[at][:, None]).sum(0) / counts[at].sum()
        return 0.999999 * weights + 0.000001 / 3  # never zero, so that no text has probability zero

    if not len(cells):
        return np.tile([0.0, 0.0, 1.0], (CONTEXTS, 1))
    common = run(np.arange(len(cells)), np.full(3, 1 / 3))
    return np.stack([run(at, common) if len(at := np.flatnonzero(bucket == b)) else common for b in range(CONTEXTS)])


def log_scores(tokens: Tokens, words: np.ndarray, pairs: np.ndarray, corpus: Corpus) -> list[np.ndarray]:
    """Per text: tokens, known tokens, base score, score."""
    words, pairs = words.astype(np.int64), pairs.astype(np.int64)
    known, base, score = (np.empty(len(tokens.word_at), kind) for kind in (bool, np.float64, np.float64))
    for at in spans(len(known)):
        count = words[tokens.word_at[at]]
        context = tokens.contexts(at, words, corpus.train_texts)
        p2 = np.where(context > 0, pairs[tokens.pair_at[at]] / np.maximum(context, 1), 0.0)
        weights = corpus.weights[context_bucket(context)]
        p1, p0 = count / max(1, corpus.train_tokens), 1 / (corpus.kinds + 1)
        known[at] = count > 0
        base[at] = np.log10((count + 0.5) / (corpus.train_tokens + 0.5 * (corpus.kinds + 1)))
        score[at] = np.log10(weights[:, 0] * p2 + weights[:, 1] * p1 + weights[:, 2] * p0)
    sums = [np.add.reduceat(base, tokens.starts), np.add.reduceat(score, tokens.starts)]
    return [tokens.lengths, np.add.reduceat(known, tokens.starts, dtype=np.int64), *sums]


def model(
    docs: DataFrame, learn: Column, text_col: str = "text", id_col: str = "doc_id", chunk_bytes: int = CHUNK_BYTES
) -> tuple[DataFrame, Corpus]:
    """The stored chunks with their counts, and the corpus figures with the learned weights."""
    text = whole(F.col(f"`{text_col}`"))
    tokens = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")) + 1
    first = docs.agg(
        F.sum(F.octet_length(text)).alias("bytes"),
        F.sum(F.when(learn, tokens)).alias("tokens"),
        F.count(F.when(learn, 1)).alias("texts"),
    ).first()
    train_tokens, train_texts = first["tokens"] or 0, first["texts"]
    route = packets.route_for(first["bytes"] or 0, chunk_bytes, (KEY_BYTES, KEY_BYTES))
    packed = packets.packs(docs, route.chunks, text_col, id_col, {"learn": F.coalesce(learn, F.lit(False))})
    replies = packets.converse(packets.ask(packed, lambda rows: Tokens(rows).request(), route), total_counts, route)

    def gather(key, left, right):
        (words, counted), (pairs, _) = packets.in_order(right)
        chunk = Tokens(packets.unpack(left.column("pack")))
        cells = histogram(chunk, words, pairs, train_tokens, train_texts)
        return pa.table(
            {
                "kinds": pa.array([int(counted.sum())], pa.int64()),
                "cells": pa.array([packets.squeeze(cells)], pa.binary()),
                "packs": pa.array([left.column("pack").to_pylist()], pa.list_(pa.binary())),
                "answers": pa.array([packets.squeeze((words, pairs))], pa.binary()),
            }
        )

    stored = materialise(
        packed.groupBy("chunk")
        .cogroup(replies.groupBy("sender"))
        .applyInArrow(gather, "kinds long, cells binary, packs array<binary>, answers binary"),
        "counted-chunks",
    )

    def rows(batches):
        for batch in batches:
            for cells in batch.column("cells").to_pylist():
                found = packets.expand(cells)
                yield pa.RecordBatch.from_arrays([pa.array(found[0]), pa.array(found[1])], ["cell", "n"])

    grid = stored.select("cells").mapInArrow(rows, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    table = grid.toArrow()  # CONTEXTS * STEPS * STEPS cells at most
    kinds = stored.agg(F.sum("kinds")).first()[0] or 0
    cells, counts = (np.asarray(table.column(c).to_pylist(), np.int64) for c in ("cell", "n"))
    return stored, Corpus(train_tokens, kinds, train_texts, learn_weights(cells, counts, kinds))


def score(
    docs: DataFrame, learn: Column, text_col: str = "text", id_col: str = "doc_id", chunk_bytes: int = CHUNK_BYTES
) -> DataFrame:
    """One row per document: id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``."""
    stored, corpus = model(docs, learn, text_col, id_col, chunk_bytes)
    kind, id_type = docs.schema[id_col].dataType.simpleString(), to_arrow_type(docs.schema[id_col].dataType)
    names = ["id", "held_out", "n_tokens", "n_known", "base_score", "score"]

    def task(batches):
        for batch in batches:
            for packs, answers in zip(batch.column("packs"), batch.column("answers"), strict=True):
                chunk = Tokens(packets.unpack(packs.values))
                figures = log_scores(chunk, *packets.expand(answers.as_py()), corpus)
                arrays = [pa.array(chunk.ids, id_type), pa.array([not x for x in chunk.learn]), *map(pa.array, figures)]
                yield pa.RecordBatch.from_arrays(arrays, names)

    return (
        stored.select("packs", "answers")
        .mapInArrow(task, f"id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double")
        .select(
            F.col("id").alias(id_col),
            "held_out",
            "n_tokens",
            "n_known",
            F.lit(corpus.train_tokens).cast("long").alias("train_tokens"),
            "base_score",
            "score",
        )
    )
