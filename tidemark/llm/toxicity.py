"""Toxicity: a classifier of word windows whose scores must not follow the group that is named.

A text is read in windows of ``WINDOW`` words, each beginning half a window after the one before; its score is that of its
worst window, so one bad passage in a long text counts. A window is the counts of its words, of their beginnings of 4 to 8
bytes (stems, whatever the ending) and of its word pairs. The weights are
those of a logistic regression on labelled texts, each represented by its worst window, since a label tells nothing about
where in a text it applies. The choice is made anew in every round: a toxic text by the window that is worst now, any other by
all windows that were worst in some round (none of its windows is toxic), which share its weight. Beside the usual penalty on the weights stands one on score changes:
every identity term in a labelled window is swapped for the other terms of its set, neutral nouns among them, and the squared
difference of both scores is charged. What is left of such a term's weight cannot carry a verdict, so a neutral mention of a
group that happened to be named in toxic texts stays below the threshold.

At most ``SAMPLE_ROWS`` labelled texts are learnt from, by hash of the id; of one with more than ``SAMPLE_WINDOWS`` windows
those with the smallest hashes, wherever they stand (a quarter of a gigabyte on the driver if all texts are that long;
some thirty megabytes usually). Terms are kept that at least ``LEAST_TEXTS`` texts of the sample have and that lean to one
label by ``LEAST_LEAN`` standard deviations, ``MOST_TERMS`` at most, so the model has a megabyte at any size of the input.
Equal windows count once, and a term once in the same surroundings, else a text with many copies, or a passage that many
texts share, would teach its own words.

Defined results: NULL counts as empty text; a text without words takes the score of the bias alone; without any label every
score is 0.0 (nothing is known to be toxic); NULL labels and labels of NULL ids are not learnt from, labels of repeated ids
count one by one; a text of any length is scored whole; repeated rows are scored one by one and alike; rows of NULL ids are
scored; an empty table gives no rows; columns named like an output column are replaced by it.
"""

from __future__ import annotations

from collections.abc import Iterator
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
SAMPLE_WINDOWS = 128
WINDOW = 32
LEAST_TEXTS = 3
MOST_TERMS = 65_536
#: Standard deviations by which a term's share of toxic texts is off the share of all.
LEAST_LEAN = 4.0
ROUNDS = 8
RIDGE = 0.25
FAIRNESS = 20.0

# Sets of identity terms that are swapped for each other. Each set ends with neutral nouns.
IDENTITY_TERMS = [
    "christian muslim jewish hindu buddhist sikh atheist person".split(),
    "christians muslims jews hindus buddhists sikhs atheists people".split(),
    "black white asian latino hispanic african european person".split(),
    "american mexican chinese indian arab turkish russian polish german french spanish british".split(),
    "woman man girl boy person".split(),
    "women men girls boys people".split(),
    "gay lesbian straight bisexual transgender queer heterosexual homosexual person".split(),
    "blind deaf disabled autistic elderly young person".split(),
    "immigrant refugee foreigner migrant citizen person".split(),
    "immigrants refugees foreigners migrants citizens people".split(),
    "christen muslime juden hindus buddhisten atheisten menschen".split(),
    "frauen männer mädchen jungen ausländer flüchtlinge behinderte menschen".split(),
    "chrétiens musulmans juifs hindous bouddhistes athées gens".split(),
    "femmes hommes filles garçons étrangers réfugiés handicapés gens".split(),
    "cristianos musulmanes judíos hindúes budistas ateos gente".split(),
    "mujeres hombres chicas chicos extranjeros refugiados discapacitados gente".split(),
]

#: ASCII letters lower-cased; ASCII signs and control characters part words.
LETTERS = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)
FIRST, SECOND, THIRD = packets.coefficients(3, 13)
STEMS = range(4, 9)


def word_keys(text: str) -> np.ndarray:
    """Of each word its hash and its first eight bytes. A word that follows itself is left out: said again and again it
    means no more, and would fill whole windows."""
    words = text.lower().encode("utf-8", "surrogatepass").translate(LETTERS).split()
    if not words:
        return np.zeros((0, 2), np.uint64)
    keys = packets.word_hashes(words)
    kept = np.append(True, keys[1:] != keys[:-1])
    return np.stack([keys, np.array(words, "S8").view("<u8")], 1)[kept]


def pair_keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return packets.mix64(left * FIRST + right * SECOND)


def stem_keys(words: np.ndarray, length: int) -> np.ndarray:
    """Keys of the words' beginnings; 0 where the word is shorter."""
    head = words[:, 1]
    key = packets.mix64((head & np.uint64((1 << 8 * length) - 1)) * THIRD + np.uint64(length))
    return np.where(head >> np.uint64(8 * (length - 1)) & np.uint64(255), key, np.uint64(0))


def window_starts(words: int) -> np.ndarray:
    """Every half window, so that any passage of up to half a window lies whole in one; the last reaches the end."""
    half = WINDOW // 2
    return np.arange(0, max(1, words - half), half) if words else np.zeros(0, np.int64)


class Windows:
    """The windows of some texts. A text comes as runs of its words (all of it, or the windows chosen from a long one)."""

    def __init__(self, texts: list[list[np.ndarray]]):
        runs = [r for own in texts for r in own if len(r)]
        self.words = np.concatenate([np.zeros((0, 2), np.uint64), *runs])
        lengths = np.array([len(r) for r in runs], np.int64)
        owners = np.repeat(np.arange(len(texts)), [sum(len(r) > 0 for r in own) for own in texts])
        #: Of each run: where its words begin, how many they are, whose it is, its windows and the first one's number.
        self.begin, self.length, self.text = np.cumsum(lengths) - lengths, lengths, owners
        starts = [window_starts(n) for n in lengths.tolist()]
        self.windows = np.array([len(x) for x in starts], np.int64)
        self.base = np.cumsum(self.windows) - self.windows
        #: Of each word its run; of each window its first word and its text.
        self.run = np.repeat(np.arange(len(runs), dtype=np.int32), lengths)
        self.whole = self.run[:-1] == self.run[1:]
        self.first = np.concatenate([np.zeros(0, np.int64), *[x + b for x, b in zip(starts, self.begin.tolist(), strict=True)]])
        self.owner = np.repeat(owners, self.windows) if len(runs) else np.zeros(0, np.int64)

    def terms(self) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        """(place, key, words) of all words, of all pairs, of all stems of a length; one kind at a time to hold little."""
        key, pairs = self.words[:, 0], np.flatnonzero(self.whole)
        yield np.arange(len(key)), key, 1
        yield pairs, pair_keys(key[pairs], key[pairs + 1]), 2
        for n in STEMS:
            stems = stem_keys(self.words, n)
            some = np.flatnonzero(stems)
            yield some, stems[some], 1

    def seen(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(key, surroundings, text) of the terms that have both neighbours in their run, by kind."""
        key = self.words[:, 0]
        inner = np.flatnonzero(self.whole[:-1] & self.whole[1:]) + 1
        left = inner[:-1][np.diff(inner) == 1]
        left = left[self.run[left - 1] == self.run[left + 2]] if len(left) else left
        yield pair_keys(key[left], key[left + 1]), pair_keys(key[left - 1], key[left + 2]), self.text[self.run[left]]
        tiny = np.flatnonzero(self.length[self.run] <= 2) if len(self.run) else inner
        at = np.concatenate([inner, tiny])
        around = np.concatenate([pair_keys(key[inner - 1], key[inner + 1]), np.zeros(len(tiny), np.uint64)])
        yield key[at], around, self.text[self.run[at]]
        for n in STEMS:
            stems = stem_keys(self.words[at], n)
            some = np.flatnonzero(stems)
            yield stems[some], around[some], self.text[self.run[at[some]]]

    def around(self, place: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
        """(index into ``place``, window) for every window that holds the words from that place on."""
        half = WINDOW // 2
        run = self.run[place]
        offset = place - self.begin[run]
        last = np.minimum(offset // half, self.windows[run] - 1)
        first = np.maximum(-(-(offset + words - WINDOW) // half), 0)
        n = last - first + 1
        index = np.repeat(np.arange(len(place)), n)
        step = np.arange(len(index)) - np.repeat(np.cumsum(n) - n, n)
        return index, (self.base[run] + first)[index] + step

    def new(self, labels: np.ndarray) -> np.ndarray:
        """Whether no window before holds the same words under the same label."""
        total = labels[self.owner].astype(np.uint64)
        for j, factor in enumerate(packets.coefficients(WINDOW, 17)):
            at = np.minimum(self.first + j, len(self.words) - 1)
            inside = self.run[at] == self.run[self.first]
            total += np.where(inside & (self.first + j == at), self.words[at, 0] * factor, np.uint64(0))
        first = np.zeros(len(total), bool)
        first[np.unique(packets.mix64(total), return_index=True)[1]] = True
        return first


def swap_sets() -> dict[int, list[np.ndarray]]:
    """The hash of each identity term, and the terms that may stand in its place."""
    found: dict[int, dict[int, np.ndarray]] = {}
    for group in IDENTITY_TERMS:
        members = {int(k[0]): k for w in group for k in word_keys(w)}
        for k in members:
            found.setdefault(k, {}).update(members)
    return {k: [o for _, o in sorted(others.items()) if int(o[0]) != k] for k, others in found.items()}


def position(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The place of each key, or -1."""
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return np.where(sorted_keys[at] == keys, at, -1)


@dataclass
class Model:
    terms: np.ndarray  # sorted keys
    weights: np.ndarray
    bias: float

    def value(self, keys: np.ndarray) -> np.ndarray:
        """The weight of each term, 0 for one that was not learnt."""
        if not len(self.terms) or not len(keys):
            return np.zeros(len(keys))
        at = np.minimum(np.searchsorted(self.terms, keys), len(self.terms) - 1)
        return np.where(self.terms[at] == keys, self.weights[at], 0.0)

    def windows(self, words: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """The sum of each window [first, last) over its words, their stems and the pairs inside."""
        each = self.value(words[:, 0])
        for n in STEMS:
            each += self.value(stem_keys(words, n))
        sums = np.concatenate(([0.0], np.cumsum(each)))
        pairs = np.zeros(len(words) + 1)
        if len(words) > 1:
            pairs[2:] = np.cumsum(self.value(pair_keys(words[:-1, 0], words[1:, 0])))
        return sums[last] - sums[first] + pairs[last] - pairs[np.minimum(first + 1, last)]

    def scores(self, texts: list[str]) -> np.ndarray:
        """The chance that a text is toxic: that of its worst window."""
        found = np.full(len(texts), self.bias)
        keys = [word_keys(t) for t in texts]
        starts = [window_starts(len(k)) for k in keys]
        counts = np.array([len(s) for s in starts])
        if counts.any():
            begins = np.concatenate(([0], np.cumsum([len(k) for k in keys])))
            first = np.concatenate([s + b for s, b in zip(starts, begins, strict=False)]).astype(np.int64)
            last = np.minimum(first + WINDOW, np.repeat(begins[1:], counts))
            sums = self.windows(np.concatenate(keys), first, last)
            some = np.flatnonzero(counts)
            at = np.concatenate(([0], np.cumsum(counts)))[some]
            found[some] += np.maximum.reduceat(sums, at)
        with np.errstate(over="ignore"):
            return 1 / (1 + np.exp(-found))


class Rows:
    """A sparse matrix with as many products as fitting needs."""

    def __init__(self, rows: int, columns: int, at: np.ndarray, column: np.ndarray, value: np.ndarray):
        self.shape, self.at, self.column, self.value = (rows, columns), at, column, value

    @classmethod
    def counted(cls, windows: Windows, terms: np.ndarray, columns: int) -> Rows:
        """How often each window has each of the sorted ``terms``."""
        found = []
        for place, keys, words in windows.terms():
            at = position(terms, keys)
            index, window = windows.around(place[at >= 0], words)
            found.append(window * columns + at[at >= 0][index])
        cells, n = np.unique(np.concatenate(found), return_counts=True)
        return cls(len(windows.first), columns, cells // columns, cells % columns, n.astype(float))

    def take(self, rows: np.ndarray) -> Rows:
        """The given rows (each once) in that order."""
        place = np.full(self.shape[0], -1)
        place[rows] = np.arange(len(rows))
        own = place[self.at] >= 0
        return Rows(len(rows), self.shape[1], place[self.at[own]], self.column[own], self.value[own])

    def with_bias(self) -> Rows:
        """The last column set to 1."""
        n = np.arange(self.shape[0])
        last = np.full(len(n), self.shape[1] - 1)
        return Rows(*self.shape, np.concatenate([self.at, n]), np.concatenate([self.column, last]), np.concatenate([self.value, np.ones(len(n))]))

    def times(self, v: np.ndarray) -> np.ndarray:
        return np.bincount(self.at, self.value * v[self.column], self.shape[0])

    def back(self, u: np.ndarray) -> np.ndarray:
        return np.bincount(self.column, self.value * u[self.at], self.shape[1])


def regress(x: Rows, y: np.ndarray, share: np.ndarray, swaps: Rows, start: np.ndarray, fairness: float) -> np.ndarray:
    """Logistic regression by Newton steps, each solved by conjugate gradients; ``share`` is what each row counts. The last
    column is the bias."""
    ridge = np.full(x.shape[1], RIDGE)
    ridge[-1] = 1e-6
    w = start.copy()
    for _ in range(12):
        p = 1 / (1 + np.exp(-np.clip(x.times(w), -50, 50)))
        slope = x.back(share * (p - y)) + ridge * w + fairness * swaps.back(swaps.times(w))
        bend = share * np.maximum(p * (1 - p), 1e-6)

        def curve(v, bend=bend):
            return x.back(bend * x.times(v)) + ridge * v + fairness * swaps.back(swaps.times(v))

        step, left = np.zeros_like(w), -slope
        way, size = left.copy(), left @ left
        for _ in range(60):
            if size < 1e-10:
                break
            bent = curve(way)
            far = size / (way @ bent)
            step += far * way
            left -= far * bent
            was, size = size, left @ left
            way = left + size / was * way
        w = w + step * min(1.0, 8.0 / max(1e-12, np.abs(step).max()))
        if np.abs(step).max() < 1e-4:
            break
    return w


def near_terms(before: np.uint64 | None, word: np.ndarray, after: np.uint64 | None) -> np.ndarray:
    """The keys of the terms that hold a word: itself, its stems, the pairs with its neighbours."""
    words = word[None, :]
    keys = [words[:, 0], *[stem_keys(words, n) for n in STEMS]]
    if before is not None:
        keys.append(pair_keys(np.array([before]), words[:, 0]))
    if after is not None:
        keys.append(pair_keys(words[:, 0], np.array([after])))
    return np.concatenate(keys)


def score_changes(windows: Windows, terms: np.ndarray, columns: int, sets: dict[int, list[np.ndarray]]) -> Rows:
    """A row for every identity term in every different surroundings and every term of its set: what swapping both adds
    to and takes from the window. (The rest of a window does not change.)"""
    key = windows.words[:, 0]
    found, seen = [], set()
    for i in np.flatnonzero(position(np.array(sorted(sets), np.uint64), key) >= 0).tolist():
        before = key[i - 1] if i and windows.whole[i - 1] else None
        after = key[i + 1] if i + 1 < len(key) and windows.whole[i] else None
        if (place := (before, int(key[i]), after)) in seen:
            continue
        seen.add(place)
        here = position(terms, near_terms(before, windows.words[i], after))
        for other in sets[int(key[i])]:
            there = position(terms, near_terms(before, other, after))
            found.append((here[here >= 0], there[there >= 0]))
    sizes = [(len(a), len(b)) for a, b in found]
    at = np.repeat(np.arange(len(found)), [a + b for a, b in sizes])
    column = np.concatenate([np.zeros(0, np.int64), *[np.concatenate(x) for x in found]])
    value = np.concatenate([np.zeros(0), *[np.repeat([1.0, -1.0], x) for x in sizes]])
    return Rows(len(found), columns, at, column, value)


def evidence(windows: Windows, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The terms of some texts, the texts that each is seen in and the toxic ones among these. A term is seen once in the
    same surroundings (its two neighbours): a passage that many texts share says no more than one text does."""
    found = []
    for term, around, text in windows.seen():
        _, first = np.unique(pair_keys(term, around), return_index=True)
        term, own = term[first], text[first]
        _, once = np.unique(pair_keys(term, own.astype(np.uint64)), return_index=True)
        terms, place, count = np.unique(term[once], return_inverse=True, return_counts=True)
        toxic = np.bincount(place, labels[own[once]], len(terms))
        enough = count >= LEAST_TEXTS
        found.append((terms[enough], count[enough], toxic[enough]))
    return tuple(np.concatenate(p) for p in zip(*found, strict=True))


def fit(bags: list[tuple[int, list[np.ndarray]]], fairness: float = FAIRNESS) -> Model:
    """``bags``: the label of each labelled text and its runs of words."""
    nothing = np.zeros(0, np.uint64)
    if not bags:
        return Model(nothing, np.zeros(0), -np.inf)
    labels = np.array([y for y, _ in bags], float)
    windows = Windows([runs for _, runs in bags])
    share = np.clip(labels.mean(), 1e-6, 1 - 1e-6)
    if not len(windows.first):
        return Model(nothing, np.zeros(0), float(np.log(share / (1 - share))))
    terms, count, toxic = evidence(windows, labels)
    sets = swap_sets()
    lean = np.abs(toxic - share * count) / np.sqrt(share * (1 - share) * count)
    kept = np.flatnonzero(lean >= LEAST_LEAN)
    kept = kept[np.lexsort((terms[kept], -lean[kept]))][: MOST_TERMS - len(sets)]
    learnt = np.union1d(terms[kept], np.array(sorted(sets), np.uint64))
    columns = len(learnt) + 1
    x, swaps = Rows.counted(windows, learnt, columns), score_changes(windows, learnt, columns, sets)
    # The first choice of windows goes by the log odds of single terms, drawn to zero where little is known.
    n1, n0 = labels.sum(), len(labels) - labels.sum()
    odds = np.log((toxic + 0.5) / (n1 + 1)) - np.log((count - toxic + 0.5) / (n0 + 1))
    w = np.zeros(columns)
    w[np.searchsorted(learnt, terms[kept])] = (odds * count / (count + 10))[kept]
    usable = np.flatnonzero(windows.new(labels))
    texts, begins = np.unique(windows.owner[usable], return_index=True)
    ends, label = np.append(begins[1:], len(usable)), labels[texts]
    known: list[set[int]] = [set() for _ in texts]
    for _ in range(ROUNDS):
        sums = x.times(w)[usable]
        worst = usable[[a + int(sums[a:b].argmax()) for a, b in zip(begins, ends, strict=True)]].tolist()
        if all(one in own for one, own in zip(worst, known, strict=True)):
            break
        known = [{one} if y else own | {one} for one, own, y in zip(worst, known, label, strict=True)]
        chosen = np.array([one for own in known for one in sorted(own)])
        sizes = np.array([len(own) for own in known])
        w = regress(x.take(chosen).with_bias(), np.repeat(label, sizes), np.repeat(1 / sizes, sizes), swaps, w, fairness)
    return Model(learnt, w[:-1], float(w[-1]))


def sample(words: np.ndarray) -> list[np.ndarray]:
    """What is learnt from a labelled text: the whole of it, or of very many windows those with the smallest hashes."""
    starts = window_starts(len(words))
    if len(starts) <= SAMPLE_WINDOWS:
        return [words]
    windows = [words[s : s + WINDOW] for s in starts]
    order = packets.mix64(np.array([w[:, 0].sum(dtype=np.uint64) for w in windows]) + packets.GOLDEN)
    return [windows[i] for i in np.sort(np.argsort(order, kind="stable")[:SAMPLE_WINDOWS])]


def train(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column,
    fairness: float = FAIRNESS,
    seed: int = 42,
    text_col: str = "text",
    id_col: str = "doc_id",
    label_col: str = "toxic",
) -> Model:
    """Fit on the labelled rows for which ``learn`` (a condition on the id) holds; at most SAMPLE_ROWS, by id hash."""
    place = F.xxhash64(F.lit(seed), F.col(id_col))
    chosen = (
        labels.select(F.col(id_col), F.col(label_col).cast("int").alias("label"))
        .filter(F.col("label").isNotNull() & F.col(id_col).isNotNull() & learn)
        .orderBy(place, id_col, "label")
        .limit(SAMPLE_ROWS)
    )
    texts = docs.select(F.col(f"`{id_col}`").alias(id_col), whole(F.col(f"`{text_col}`")).alias("text"))
    rows = texts.join(F.broadcast(chosen), id_col).select(F.col(id_col).alias("id"), "label", "text")

    def task(batches):
        for batch in (part for whole_batch in batches for part in slices(whole_batch)):
            found = [[w.tobytes() for w in sample(word_keys(t))] for t in batch.column("text").to_pylist()]
            arrays = [batch.column("id"), batch.column("label"), pa.array(found, pa.list_(pa.binary()))]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "label", "runs"])

    kind = docs.schema[id_col].dataType.simpleString()
    found = rows.mapInArrow(task, f"id {kind}, label int, runs array<binary>")
    # Ids that occur very often in the documents must not make the sample large.
    table = found.orderBy(F.xxhash64(F.lit(seed), "id"), "id", "label", "runs").limit(SAMPLE_ROWS).toArrow()
    bags = zip(table.column("label").to_pylist(), table.column("runs"), strict=True)
    return fit([(int(y != 0), [np.frombuffer(r.as_buffer(), np.uint64).reshape(-1, 2) for r in runs]) for y, runs in bags], fairness)


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The documents with ``score`` and ``predicted`` (1 if score >= 0.5)."""
    schema = [f for f in docs.schema if f.name.lower() not in OUTPUT]
    names = [f.name for f in schema]
    at = names.index(text_col)

    def task(batches):
        for batch in (part for whole_batch in batches for part in slices(whole_batch)):
            found = model.scores([t or "" for t in batch.column(at).to_pylist()])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], [*names, "score"])

    scored = docs.select(*[F.col(f"`{n}`") for n in names]).mapInArrow(
        task, T.StructType([*schema, T.StructField("score", T.DoubleType())])
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
