"""Quality classifier: nearest-neighbour voting among labelled latent-semantic vectors.

A text becomes counts of hashed terms of two sorts. Its form: shapes of words (letters, digits and signs with repeats
collapsed), pairs of neighbouring shapes, and grades of its repetitiveness. Its wording: the words themselves and pairs of
neighbours, without regard to case. Weighted by inverse document frequency, each sort brought to unit length and the wording
to a weight of its own, the counts are projected onto the leading singular vectors of a labelled sample. A text is compared
with every labelled vector (blocked cosine products), and the labels of the nearest ones vote with their similarities. The
weight of the wording is the one of ``WORDINGS`` by which the sample's own labels are voted best, each text left out of its
own vote. The sample has at most ``SAMPLE_ROWS`` labelled rows, so that the model (term weights, projection, labelled vectors)
is about two megabytes at any size of the input.

Defined results: NULL counts as empty text; a text without terms takes the share of good labels as its score, as does
every text if nothing is labelled (0.5 if there is no label at all); NULL ids are scored, not learnt from; labels of ids that
are repeated count one by one; repeated rows are scored alike; a text of any length is scored whole, a word of any length is
one term; an empty table gives no rows; columns named like an output column are replaced by it.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import packets
from tidemark.llm.text import slices, whole

OUTPUT = ("held_out", "score", "predicted")
SAMPLE_ROWS = 4_096
#: Buckets of the form, of the wording, and of both.
SHAPE_TERMS, WORD_TERMS = 1_024, 2_048
TERMS = SHAPE_TERMS + WORD_TERMS
#: Weights of the wording beside the form.
WORDINGS = (0.25, 0.5, 1.0, 2.0)
RANK = 48
NEIGHBOURS = 15
SHAPES = bytes(
    ord("a") if 97 <= b <= 122 or b >= 128 else ord("A") if 65 <= b <= 90 else ord("0") if 48 <= b <= 57 else b
    for b in range(256)
)
RUNS = re.compile(rb"([^\s])\1+")
#: ASCII letters lower-cased; ASCII signs part words.
LOWER = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)
(PAIR,) = packets.coefficients(1, 21)


def grade(share: float) -> int:
    """Sixteen steps, finer near zero."""
    return int(15 * min(1.0, max(0.0, share)) ** 0.5)


def terms(text: bytes) -> np.ndarray:
    """log(1 + count) of the hashed terms of a text, the form first."""
    words = text.split()
    if not words:
        return np.zeros(TERMS, np.float32)
    return np.concatenate([shape_terms(text, words), word_terms(text.translate(LOWER).split())])


def word_terms(words: list[bytes]) -> np.ndarray:
    keys = packets.word_hashes(words)
    if len(keys) > 1:
        keys = np.concatenate([keys, packets.mix64(keys[:-1] * PAIR + keys[1:])])
    return np.log1p(np.bincount(keys >> np.uint64(64 - WORD_TERMS.bit_length() + 1), minlength=WORD_TERMS)).astype(np.float32)


def shape_terms(text: bytes, words: list[bytes]) -> np.ndarray:
    found = np.zeros(SHAPE_TERMS, np.float32)
    shapes = RUNS.sub(rb"\1", text.translate(SHAPES)).split()
    counts = Counter(shapes)
    counts.update(map(b"\x00".join, zip(shapes, shapes[1:], strict=False)))
    most = Counter(words).most_common(1)[0][1]
    same = sum(map(bytes.__eq__, words, words[1:])) / len(words)
    lines = [line for line in text.split(b"\n") if line]
    again = 1 - len(set(lines)) / max(1, len(lines))
    n = len(words)
    for name, share in (("most", most / n), ("same", same), ("lines", again), ("kinds", len(set(words)) / n)):
        counts[f"\x01{name}{grade(share)}".encode()] = max(3, n // 10)
    for term, count in counts.items():
        found[zlib.crc32(term) % SHAPE_TERMS] += count
    return np.log1p(found)


@dataclass
class Model:
    weights: np.ndarray
    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float
    wording: float = 0.0

    def project(self, x: np.ndarray) -> np.ndarray:
        return unit(balanced(x * self.weights, self.wording) @ self.projection)

    def scores(self, x: np.ndarray, neighbours: int = NEIGHBOURS) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(x), self.prior)
        cosine = self.project(x) @ self.vectors.T
        k = min(neighbours, len(self.labels))
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cosine, near, 1).astype(np.float64), 0.0)
        sums = weight.sum(1)
        voted = (weight * self.labels[near]).sum(1) / np.where(sums > 0, sums, 1)
        return np.clip(np.where((sums > 1e-9) & x.any(1), voted, self.prior), 0.0, 1.0)


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def balanced(x: np.ndarray, wording: float) -> np.ndarray:
    """Form and wording at unit length each, the wording times its weight."""
    return np.concatenate([unit(x[:, :SHAPE_TERMS]), wording * unit(x[:, SHAPE_TERMS:])], axis=1)


def leading(y: np.ndarray, rank: int, rounds: int = 6) -> np.ndarray:
    """The leading right singular vectors, by power iterations of a seeded random block."""
    block = np.random.Generator(np.random.PCG64(42)).standard_normal((y.shape[1], min(rank + 16, *y.shape))).astype(y.dtype)
    for _ in range(rounds):
        block, _ = np.linalg.qr(y.T @ (y @ block))
    _, _, right = np.linalg.svd(y @ block, full_matrices=False)
    return (block @ right.T)[:, :rank].astype(np.float32)


def left_out(model: Model) -> float:
    """The share of the sample whose labels the others vote for."""
    right, k = 0, min(NEIGHBOURS, len(model.labels) - 1)
    if k < 1:
        return 0.0
    for first in range(0, len(model.labels), 512):
        own = np.arange(first, min(first + 512, len(model.labels)))
        cosine = model.vectors[own] @ model.vectors.T
        cosine[np.arange(len(own)), own] = -2.0
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cosine, near, 1), 0.0)
        voted = (weight * model.labels[near]).sum(1) >= 0.5 * weight.sum(1)
        right += int((voted == (model.labels[own] >= 0.5)).sum())
    return right / len(model.labels)


def fit(x: np.ndarray, labels: np.ndarray, wordings: tuple[float, ...] = WORDINGS) -> Model:
    prior = float(labels.mean()) if len(labels) else 0.5
    if not len(labels):
        nothing = np.zeros((TERMS, 1), np.float32)
        return Model(np.ones(TERMS, np.float32), nothing, nothing[:0], labels, prior)
    weights = (np.log((1 + len(x)) / (1 + (x > 0).sum(0))) + 1).astype(np.float32)
    best: tuple[float, Model] | None = None
    for wording in wordings:
        y = balanced(x * weights, wording)
        model = Model(weights, leading(y, min(RANK, len(labels))), np.zeros(0), labels.astype(np.float64), prior, wording)
        model.vectors = unit(y @ model.projection).astype(np.float32)
        del y
        reached = left_out(model)
        if best is None or reached > best[0] + 1e-9:
            best = reached, model
    return best[1]


def sparse(x: np.ndarray) -> bytes:
    at = np.flatnonzero(x)
    return at.astype("<u2").tobytes() + x[at].astype("<f4").tobytes()


def dense(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(packed) // 6
    return np.frombuffer(packed, "<u2", n), np.frombuffer(packed, "<f4", n, 2 * n)


def train(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column,
    seed: int = 42,
    text_col: str = "text",
    id_col: str = "doc_id",
) -> Model:
    """Fit on the labelled rows for which ``learn`` (a condition on the id) holds; at most SAMPLE_ROWS, by id hash."""
    place = F.xxhash64(F.lit(seed), F.col(id_col))
    chosen = (
        labels.select(F.col(id_col), F.col("quality").cast("int").alias("label"))
        .filter(F.col("label").isNotNull() & F.col(id_col).isNotNull() & learn)
        .orderBy(place, id_col, "label")
        .limit(SAMPLE_ROWS)
    )
    texts = docs.select(F.col(id_col), whole(F.col(text_col)).cast("binary").alias("text"))
    rows = texts.join(F.broadcast(chosen), id_col).select("text", "label", F.col(id_col).alias("id"))

    def task(batches):
        for batch in (part for whole_batch in batches for part in slices(whole_batch)):
            x = [sparse(terms(t)) for t in batch.column("text").to_pylist()]
            arrays = [batch.column("id"), batch.column("label"), pa.array(x, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "label", "x"])

    kind = docs.schema[id_col].dataType.simpleString()
    found = rows.mapInArrow(task, f"id {kind}, label int, x binary")
    # Ids that occur very often in the documents must not make the sample large.
    table = found.orderBy(F.xxhash64(F.lit(seed), "id"), "id", "label", "x").limit(SAMPLE_ROWS).toArrow()
    x = np.zeros((table.num_rows, TERMS), np.float32)
    for row, packed in zip(x, table.column("x"), strict=True):
        at, value = dense(packed.as_py())
        row[at] = value
    return fit(x, np.asarray(table.column("label").to_pylist(), np.float64))


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The documents with ``score`` and ``predicted`` (1 if score >= 0.5)."""
    schema = [f for f in docs.schema if f.name.lower() not in OUTPUT]
    names = [f.name for f in schema]
    at = names.index(text_col)

    def task(batches):
        for batch in batches:
            for part in slices(batch):
                x = np.stack([terms((t or "").encode()) for t in part.column(at).to_pylist()])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(model.scores(x))], [*names, "score"])

    scored = docs.select(*[F.col(f"`{n}`") for n in names]).mapInArrow(
        task, T.StructType([*schema, T.StructField("score", T.DoubleType())])
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
