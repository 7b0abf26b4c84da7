"""SentencePiece encoding with seeded merge dropout, and decoding.

The pieces and their scores come from a published BPE model (a path, read on the driver; the table of a few ten
thousand pieces is broadcast). A text is cut into units that no piece crosses. In a unit, candidate merges wait in an
agenda, best piece first and leftmost among equals; a candidate that comes up is skipped if a hash keyed by seed,
document id, the unit's place in the text, piece and place in the unit falls below the dropout rate. So every occurrence
of a word is drawn for by itself, and a rerun draws alike. With dropout 0 the pieces are the model's own.

What is cached of a unit is what every occurrence has in common: its symbols, their first candidates, and the merges of the
agenda when nothing is skipped. An occurrence draws for those merges; if none is skipped, their outcome is its own, else its
agenda is run, together with those of many other occurrences, as arrays.

What no piece covers becomes byte pieces. A space is written as U+2581; a U+2581 of the text itself becomes bytes, so
that every text decodes to itself.

Defined results: NULL counts as empty text and has no pieces; a NULL id draws like an id of its own; repeated rows are encoded
one by one and alike; a text of any length is encoded whole, and a unit without end (no white space in it) has an agenda of
its own, a heap; an empty table gives no rows; columns named like an output column are replaced by it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heapify, heappop, heappush
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import packets
from tidemark.llm.text import whole

SPACE = "▁"
#: Stands for a U+2581 of the text. A lone surrogate occurs in no UTF-8 text.
OWN_SPACE = "\ud800"
CACHED_UNITS = 200_000
BATCH, BYTES = 256, 1 << 20
MASK = (1 << 64) - 1
GOLDEN, MIXER = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9
#: Bits of the place in a candidate; the rank stands above.
PLACE = 40
PLACES = (1 << PLACE) - 1


#: Units up to this length are encoded together; a longer one has an agenda of its own.
TOGETHER = 24
NONE = np.int32(1 << 30)
#: Occurrences whose agendas run as one array.
ROWS = 1 << 14


def occurrence_keys(document: np.ndarray, place: np.ndarray) -> np.ndarray:
    """What an occurrence draws with, from its document's key and its place there."""
    return packets.mix64(document + place.astype(np.uint64) * packets.GOLDEN)


def spread(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The indexes of runs, one run after the other."""
    ends = np.cumsum(length)
    return np.repeat(start - (ends - length), length) + np.arange(ends[-1] if len(ends) else 0)


class Merges:
    """Symbols and their merges as arrays. Symbols are the pieces by rank, then the characters inside pieces that are
    none themselves, then any other character."""

    def __init__(self, rank: dict[str, int], number: dict[str, int]):
        inside = sorted({c for piece in rank for c in piece} - rank.keys())
        symbol = rank | {c: len(rank) + n for n, c in enumerate(inside)}
        self.pieces, self.other = len(rank), len(symbol)
        self.of_char = np.full(0x110000, self.other, np.int32)
        for c, n in symbol.items():
            if len(c) == 1:
                self.of_char[ord(c)] = n
        pairs = {}
        for piece, r in rank.items():
            for at in range(1, len(piece)):
                left, right = symbol.get(piece[:at]), symbol.get(piece[at:])
                if left is not None and right is not None:
                    pairs[left * (self.other + 1) + right] = r
        self.place_pairs(np.array(list(pairs), np.int64), np.array(list(pairs.values()), np.int32))
        self.numbers = np.array([number[p] for p in sorted(rank, key=rank.get)], "<i4")

    def place_pairs(self, keys: np.ndarray, ranks: np.ndarray) -> None:
        """A table by hash with an eighth of its slots filled; who finds a slot taken goes to the next one."""
        bits = max(4, (8 * len(keys)).bit_length())
        self.shift, self.last = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.ranks = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int32)
        slot = self.slots(keys)
        while len(keys):
            free = self.keys[slot] < 0
            first = np.zeros(len(keys), bool)
            first[np.unique(slot, return_index=True)[1]] = True
            put = free & first
            self.keys[slot[put]], self.ranks[slot[put]] = keys[put], ranks[put]
            keys, ranks, slot = keys[~put], ranks[~put], slot[~put] + 1 & self.last

    def slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * packets.GOLDEN >> self.shift).astype(np.int64)

    def joined(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the piece that two symbols make, or NONE."""
        asked = left.astype(np.int64) * (self.other + 1) + right
        slot = self.slots(asked)
        there = self.keys[slot]
        found = np.where(there == asked, self.ranks[slot], NONE)
        open_ = np.flatnonzero((there != asked) & (there >= 0))
        while len(open_):
            slot[open_] = slot[open_] + 1 & self.last
            there = self.keys[slot[open_]]
            same = there == asked[open_]
            found[open_[same]] = self.ranks[slot[open_[same]]]
            open_ = open_[~same & (there >= 0)]
        return found

    def begin(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The symbols of some units one after the other, the rank of each with the next one, and the units' lengths."""
        lengths = np.array([len(u) for u in units], np.int64)
        code = "".join(units).encode("utf-32-le", "surrogatepass")
        symbols = self.of_char[np.frombuffer(code, "<u4")]
        best = np.full(len(symbols), NONE, np.int32)
        inside = np.ones(len(symbols), bool)
        inside[np.cumsum(lengths) - 1] = False
        at = np.flatnonzero(inside)
        best[at] = self.joined(symbols[at], symbols[at + 1])
        return symbols, best, lengths

    def run(self, symbols: np.ndarray, best: np.ndarray, lengths: np.ndarray, keys: np.ndarray, bound: int, path: list | None = None):
        """The symbols left of each row (-1 where one was merged away) after its agenda is empty: in every round each
        row takes its best candidate, the leftmost of the best piece, and skips it or merges. ``symbols`` and ``best``
        have a row for each and are changed. The merges made go to ``path``, by round, as (rows, candidates)."""
        width = symbols.shape[1]
        places = np.arange(width, dtype=np.int32)
        after = np.tile(places + 1, (len(symbols), 1))
        before = np.tile(places - 1, (len(symbols), 1))
        rows = np.arange(len(symbols))
        while len(rows):
            now = best[rows]
            at = now.argmin(1)
            rank = now[np.arange(len(rows)), at]
            open_ = rank < NONE
            if not open_.all():
                rows, at, rank = rows[open_], at[open_], rank[open_]
            r, i = rows, at
            if bound:
                top = (rank.astype(np.int64) << PLACE | at).astype(np.uint64)
                skipped = draws(keys[rows], top) < np.uint64(min(bound, MASK))
                best[rows[skipped], at[skipped]] = NONE
                taken = ~skipped
                r, i, rank = rows[taken], at[taken], rank[taken]
            if path is not None:
                path.append((r, rank.astype(np.int64) << PLACE | i))
            j = after[r, i]
            symbols[r, i], symbols[r, j], best[r, j], best[r, i] = rank, -1, NONE, NONE
            k = after[r, j]
            after[r, i] = k
            more = k < lengths[r]
            rm, im, km = r[more], i[more], k[more]
            before[rm, km] = im
            best[rm, im] = self.joined(symbols[rm, im], symbols[rm, km])
            h = before[r, i]
            more = h >= 0
            rm, im, hm = r[more], i[more], h[more]
            best[rm, hm] = self.joined(symbols[rm, hm], symbols[rm, im])
        return symbols


def draws(keys: np.ndarray, tops: np.ndarray) -> np.ndarray:
    drawn = keys + tops * np.uint64(GOLDEN)
    return (drawn ^ drawn >> np.uint64(29)) * np.uint64(MIXER)


class Cache:
    """What all occurrences of a unit have in common. Of each: symbols and first candidates (``begin`` on, ``length``
    many), the merges without dropout (``path``), and the ids that they end in (``ids``)."""

    def __init__(self):
        self.index: dict[str, int] = {}
        self.units: list[str] = []
        none = np.zeros(0, np.int64)
        self.symbols, self.best, self.length, self.begin = none.astype(np.int32), none.astype(np.int32), none, none
        self.path, self.path_begin, self.path_length = none.astype(np.uint64), none, none
        self.ids, self.ids_begin, self.ids_length = none.astype("<i4"), none, none

    def add(self, words: Vocabulary, units: list[str]) -> None:
        self.index.update(zip(units, range(len(self.units), len(self.units) + len(units)), strict=True))
        self.units += units
        symbols, best, length = words.merges.begin(units)
        path: list = []
        ended = np.full(len(symbols), -1, np.int32)
        begin = np.cumsum(length) - length
        for rows in by_width(length):
            grid, first = words.gather(symbols, begin, length, rows, -1), words.gather(best, begin, length, rows, NONE)
            made: list = []
            grid = words.merges.run(grid, first, length[rows], np.zeros(len(rows), np.uint64), 0, made)
            path += [(rows[r], tops) for r, tops in made]
            ended[spread(begin[rows], length[rows])] = grid[np.arange(grid.shape[1])[None, :] < length[rows][:, None]]
        owner = np.concatenate([r for r, _ in path]) if path else np.zeros(0, np.int64)
        tops = np.concatenate([t for _, t in path]).astype(np.uint64) if path else np.zeros(0, np.uint64)
        order = np.argsort(owner, kind="stable")
        count = np.bincount(owner, minlength=len(units))
        ids, ids_length, _ = words.ids_of(ended, begin, length, units)

        def more(name: str, values: np.ndarray, lengths: np.ndarray) -> None:
            old = getattr(self, name)
            setattr(self, f"{name}_begin", np.append(getattr(self, f"{name}_begin"), len(old) + np.cumsum(lengths) - lengths))
            setattr(self, f"{name}_length", np.append(getattr(self, f"{name}_length"), lengths))
            setattr(self, name, np.append(old, values))

        self.begin = np.append(self.begin, len(self.symbols) + begin)
        self.length = np.append(self.length, length)
        self.symbols, self.best = np.append(self.symbols, symbols), np.append(self.best, best)
        more("path", tops[order], count)
        more("ids", ids, ids_length)


def by_width(lengths: np.ndarray):
    """Rows of like length together, ``ROWS`` at most."""
    order = np.argsort(lengths, kind="stable")
    edges = np.searchsorted(lengths[order], [5, 9, 13, 17, TOGETHER + 1])
    for a, b in zip([0, *edges[:-1]], edges, strict=True):
        for first in range(a, b, ROWS):
            yield order[first : min(b, first + ROWS)]


@dataclass
class Vocabulary:
    rank: dict[str, int]  # of every ordinary piece, by score
    number: dict[str, int]
    byte_number: list[int]
    octets: list[bytes]  # what each id decodes to
    units: str  # pattern
    merges: Merges

    def encode_unit(self, unit: str, key: int, bound: int) -> np.ndarray:
        """The ids of one occurrence of a unit by an agenda of its own; a candidate is skipped if its draw is below
        ``bound`` of 2^64.

        A candidate is one number: the rank of its piece, then where it starts. It is stale if the symbols there no
        longer join to that piece.
        """
        n, get = len(unit), self.rank.get
        symbols: list[str | None] = list(unit)
        agenda = [r << PLACE | i for i in range(n - 1) if (r := get(unit[i : i + 2])) is not None]
        if agenda:
            after, before = list(range(1, n + 1)), list(range(-1, n - 1))
            heapify(agenda)
            while agenda:
                top = heappop(agenda)
                i = top & PLACES
                left = symbols[i]
                if left is None or (j := after[i]) >= n:
                    continue
                piece = left + symbols[j]
                if get(piece) != top >> PLACE:
                    continue
                if bound:
                    draw = (key + top * GOLDEN) & MASK
                    if ((draw ^ draw >> 29) * MIXER & MASK) < bound:
                        continue
                symbols[i], symbols[j] = piece, None
                after[i] = j = after[j]
                if j < n:
                    before[j] = i
                    if (r := get(piece + symbols[j])) is not None:
                        heappush(agenda, r << PLACE | i)
                if (h := before[i]) >= 0 and (r := get(symbols[h] + piece)) is not None:
                    heappush(agenda, r << PLACE | h)
        ids = []
        for symbol in symbols:
            if symbol is not None:
                if (number := self.number.get(symbol)) is not None:
                    ids.append(number)
                else:
                    ids += self.bytes_of(symbol)
        return np.array(ids, "<i4")

    def bytes_of(self, character: str) -> list[int]:
        return [self.byte_number[b] for b in character.replace(OWN_SPACE, SPACE).encode()]

    @staticmethod
    def gather(flat: np.ndarray, begin: np.ndarray, length: np.ndarray, rows: np.ndarray, beyond) -> np.ndarray:
        """Runs of a flat array as rows of a matrix, filled up with ``beyond``."""
        width = int(length[rows].max())
        found = np.full((len(rows), width), beyond, flat.dtype)
        found[np.arange(width)[None, :] < length[rows][:, None]] = flat[spread(begin[rows], length[rows])]
        return found

    def ids_of(self, ended: np.ndarray, begin: np.ndarray, length: np.ndarray, units: list[str]):
        """(ids, how many each unit has, whether pieces cover it) from the symbols that are left, unit after unit."""
        if not len(units):
            return np.zeros(0, "<i4"), np.zeros(0, np.int64), np.zeros(0, bool)
        foreign = ended >= self.merges.pieces
        left = ended >= 0
        counts = np.add.reduceat(left, begin).astype(np.int64)
        plain = ~np.logical_or.reduceat(foreign, begin)
        if plain.all():
            return self.merges.numbers[ended[left]], counts, plain
        parts, at = [], 0
        found = np.where(foreign, -1, self.merges.numbers[np.clip(ended, 0, self.merges.pieces - 1)])
        odd = np.flatnonzero(~plain).tolist()
        for n in odd:
            parts.append(found[at : begin[n]][left[at : begin[n]]])
            at = int(begin[n] + length[n])
            own: list[int] = []
            for i in range(int(begin[n]), at):
                if left[i]:
                    own += self.bytes_of(units[n][i - int(begin[n])]) if foreign[i] else [int(found[i])]
            parts.append(np.array(own, "<i4"))
            counts[n] = len(own)
        parts.append(found[at:][left[at:]])
        return np.concatenate(parts).astype("<i4"), counts, plain

    def rerun(self, cache: Cache, which: np.ndarray, keys: np.ndarray, bound: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, how many each has) of occurrences of cached units whose agendas must be run."""
        lengths = cache.length[which]
        ends = np.cumsum(lengths)
        ended = np.full(ends[-1] if len(ends) else 0, -1, np.int32)
        for rows in by_width(lengths):
            units = which[rows]
            grid = self.gather(cache.symbols, cache.begin, cache.length, units, -1)
            best = self.gather(cache.best, cache.begin, cache.length, units, NONE)
            grid = self.merges.run(grid, best, lengths[rows], keys[rows], bound)
            inside = np.arange(grid.shape[1])[None, :] < lengths[rows][:, None]
            ended[spread(ends[rows] - lengths[rows], lengths[rows])] = grid[inside]
        units = [cache.units[n] for n in which.tolist()]
        ids, counts, _ = self.ids_of(ended, ends - lengths, lengths, units)
        return ids, counts

    def encode(self, texts: list[str], documents: np.ndarray, rate: float, cache: Cache) -> tuple[np.ndarray, np.ndarray]:
        """(ids, how many each text has); ``documents`` are the keys that the texts draw with."""
        written = [SPACE + t.replace(SPACE, OWN_SPACE).replace(" ", SPACE) if t else "" for t in texts]
        found = [re.findall(self.units, w) for w in written]
        sizes = np.array(list(map(len, found)), np.int64)
        flat = list(chain.from_iterable(found))
        bound = int(rate * 2**64)
        place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        keys = occurrence_keys(np.repeat(documents, sizes), place)
        del place, written, found
        distinct = set(flat)
        lacking = [u for u in distinct.difference(cache.index) if len(u) <= TOGETHER]
        if len(cache.units) + len(lacking) > CACHED_UNITS:
            cache.__init__()
            lacking = [u for u in distinct if len(u) <= TOGETHER]
        if lacking:
            cache.add(self, lacking)
        which = np.fromiter(map(cache.index.get, flat, repeat(-1)), np.int64, len(flat))
        known = np.flatnonzero(which >= 0)
        begin, length = np.zeros(len(flat), np.int64), np.zeros(len(flat), np.int64)
        begin[known], length[known] = cache.ids_begin[which[known]], cache.ids_length[which[known]]
        parts, at = [cache.ids], len(cache.ids)
        for first in range(0, len(known) if bound else 0, ROWS):
            here = known[first : first + ROWS]
            again = here[self.skips(cache, which[here], keys[here], bound)]
            ids, counts = self.rerun(cache, which[again], keys[again], bound)
            begin[again], length[again] = at + np.cumsum(counts) - counts, counts
            parts.append(ids)
            at += len(ids)
        for n in np.flatnonzero(which < 0).tolist():
            own = self.encode_unit(flat[n], int(keys[n]), bound)
            parts.append(own)
            begin[n], length[n] = at, len(own)
            at += len(own)
        ends = np.concatenate(([0], np.cumsum(length)))[np.concatenate(([0], np.cumsum(sizes)))]
        return np.concatenate(parts)[spread(begin, length)], np.diff(ends)

    @staticmethod
    def skips(cache: Cache, unit: np.ndarray, keys: np.ndarray, bound: int) -> np.ndarray:
        """Which occurrences skip one of the merges that they would make without dropout."""
        steps = cache.path_length[unit]
        owner = np.repeat(np.arange(len(unit)), steps)
        tops = cache.path[spread(cache.path_begin[unit], steps)]
        hit = np.zeros(len(unit), bool)
        hit[owner[draws(keys[owner], tops) < np.uint64(min(bound, MASK))]] = True
        return hit

    def decode(self, ids: np.ndarray) -> str:
        """The text of some ids; the space that encoding puts first is taken off."""
        return b"".join(map(self.octets.__getitem__, ids.tolist())).decode()[1:]


def vocabulary(model_path: str) -> Vocabulary:
    """Read a BPE model with byte fallback. Control pieces are never made and decode to nothing."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    numbers = range(model.get_piece_size())
    ordinary = [i for i in numbers if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    names = {i: model.id_to_piece(i) for i in numbers}
    by_score = sorted(ordinary, key=lambda i: (-model.get_score(i), i))
    octets = [b""] * len(names)
    byte_number = [0] * 256
    for i in numbers:
        if model.is_byte(i):
            value = int(names[i][1:-1], 16)
            byte_number[value], octets[i] = i, bytes([value])
    for i in ordinary:
        octets[i] = names[i].replace(SPACE, " ").encode()
    if any(SPACE in names[i].lstrip(SPACE) for i in ordinary):
        units = r"(?s).+"  # a piece holds a space inside: no cut is safe
    elif any("\n" in names[i] for i in ordinary):
        units = rf"{SPACE}*[^{SPACE}]+|{SPACE}+"
    else:
        units = rf"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n"
    rank, number = {names[i]: n for n, i in enumerate(by_score)}, {names[i]: i for i in ordinary}
    return Vocabulary(rank, number, byte_number, octets, units, Merges(rank, number))


def portions(batch: pa.RecordBatch, at: int) -> Iterator[pa.RecordBatch]:
    """A record batch in parts of at most BATCH rows and BYTES of text, but for a text that is longer alone."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(at)), 0)).tolist()
    first, held = 0, 0
    for n, size in enumerate(sizes):
        if n > first and (n - first == BATCH or held + size > BYTES):
            yield batch.slice(first, n - first)
            first, held = n, 0
        held += size
    if first < len(sizes):
        yield batch.slice(first)


def encode(
    docs: DataFrame,
    model_path: str,
    dropout: float = 0.1,
    seed: int = 42,
    text_col: str = "text",
    id_col: str = "doc_id",
    decoded: bool = False,
) -> DataFrame:
    """The documents with ``ids`` (array of int), and if asked the text ``decoded`` from those ids in the same task, which
    spares a second Python worker."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary(model_path))
    kept = [f for f in docs.schema if f.name.lower() not in ("ids", *["decoded"] * decoded)]
    key = F.xxhash64(F.lit(seed), F.col(f"`{id_col}`"))
    rows = docs.select(*[F.col(f"`{f.name}`") for f in kept], key.alias("draws_with"))
    at = [f.name for f in kept].index(text_col)

    def task(batches):
        words, cache = shared.value, Cache()
        for batch in batches:
            for part in portions(batch, at):
                texts = [t or "" for t in part.column(at).to_pylist()]
                documents = np.asarray(part.column(len(kept))).view(np.uint64)
                ids, counts = words.encode(texts, documents, dropout, cache)
                ends = np.concatenate(([0], np.cumsum(counts)))
                array = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids))
                arrays, names = [*part.columns[:-1], array], [*part.schema.names[:-1], "ids"]
                if decoded:
                    texts = [words.decode(ids[a:b]) for a, b in zip(ends, ends[1:], strict=False)]
                    arrays.append(pa.array(texts, pa.string()))
                    names.append("decoded")
                yield pa.RecordBatch.from_arrays(arrays, names)

    added = [T.StructField("ids", T.ArrayType(T.IntegerType()))]
    added += [T.StructField("decoded", T.StringType())] * decoded
    return rows.mapInArrow(task, T.StructType([*kept, *added]))


def decode(encoded: DataFrame, model_path: str, ids_col: str = "ids") -> DataFrame:
    """The rows with ``decoded``, the text of their ids."""
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary(model_path))
    kept = [f for f in encoded.schema if f.name.lower() != "decoded"]
    at = [f.name for f in kept].index(ids_col)

    def task(batches):
        words = shared.value
        for batch in batches:
            for first in range(0, batch.num_rows, BATCH):
                part = batch.slice(first, BATCH)
                texts = [words.decode(np.asarray(i.values)) for i in part.column(at)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [*part.schema.names, "decoded"])

    rows = encoded.select(*[F.col(f"`{f.name}`") for f in kept])
    return rows.mapInArrow(task, T.StructType([*kept, T.StructField("decoded", T.StringType())]))


#: Setting with the path of the model, and where the published 32k BPE model lies if it is not set.
MODEL_SETTING, MODEL_PATH = "spark.tidemark.pieces.model", "/opt/tokenizers/piece_bpe_32k.model"


def default_model(spark: SparkSession | None = None) -> str:
    return MODEL_PATH if spark is None else spark.conf.get(MODEL_SETTING, MODEL_PATH)


def round_trip(docs: DataFrame, model_path: str, **settings) -> DataFrame:
    """Encoded documents with ``decoded`` and ``lossless`` (the text comes back whole)."""
    done = encode(docs, model_path, decoded=True, **settings)
    return done.withColumn("lossless", F.col("decoded") == whole(F.col(settings.get("text_col", "text"))))
