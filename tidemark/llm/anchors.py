"""Substring dedup by fixed-block anchors.

Every document is cut into non-overlapping reference blocks of ``(window + 1) // 2`` words. A window of ``window``
words holds a whole block of its own document, so whoever repeats it meets that block with one of its rolling probes.
All rolling probes of all documents are looked up among all blocks; where none hits, nothing repeats. Round the hits,
windows are compared over their whole length with those of all other hits, and overlapping repeated windows join to
maximal repeats. Probes and windows travel as sorted hashes, once per chunk (see ``packets``): a passage that very many
documents share is one hash per chunk, and no pairs are made.

A probe is told by its leading 40 bits and the bucket's, which may only give needless candidates. Windows count as equal if
128 bits agree: two sums of their words' 128-bit hashes, with random odd factors for each place.

Defined results: a text shorter than the window keeps all its words; NULL counts as empty; NULL ids are kept; repeated rows
repeat each other; a text of any length is one document of one chunk, a word of any length is one hash; an empty table gives
no rows; further columns, whatever their names, are left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm import packets
from tidemark.llm.text import whole

CHUNK_BYTES = 4 << 20
KEY_BYTES = 5


class Chunk:
    """The words of some documents, with their hashes, and where windows may start."""

    def __init__(self, rows, window: int):
        self.window, self.block = window, (window + 1) // 2
        self.ids, self.words, lengths = [], [], []
        for key, text in rows:
            words = text.split()
            self.ids.append(key)
            self.words.append(words)
            lengths.append(len(words))
        self.lengths = np.array(lengths, np.int64)
        self.starts = np.concatenate(([0], np.cumsum(self.lengths)))[:-1].astype(np.int64)
        parts = [wide_hashes(w) for w in self.words if len(w)]
        self.hashes = np.concatenate(parts) if parts else np.zeros((0, 2), np.uint64)

    def positions(self, n: int) -> np.ndarray:
        """Where n words start in one document that is long enough for a window."""
        room = np.where(self.lengths >= self.window, self.lengths - n + 1, 0)
        first = np.repeat(self.starts - np.concatenate(([0], np.cumsum(room)))[:-1], room)
        return first + np.arange(room.sum())

    def sums(self, at: np.ndarray, n: int, seed: int, half: int = 0) -> np.ndarray:
        total, hashes = np.zeros(len(at), np.uint64), np.ascontiguousarray(self.hashes[:, half])
        for j, factor in enumerate(packets.coefficients(n, seed)):
            total += hashes[at + j] * factor
        return packets.mix64(total)

    def probes(self):
        """Start, key (sorted distinct ones and each one's place) and whether it is a reference block."""
        at = self.positions(self.block)
        offset = at - np.repeat(self.starts, np.where(self.lengths >= self.window, self.lengths - self.block + 1, 0))
        keys, place = np.unique(self.sums(at, self.block, 1), return_inverse=True)
        return at, keys, place, offset % self.block == 0

    def candidates(self, hits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Windows that hold a hit, with their sorted distinct keys (in two halves) and each one's place."""
        marks = np.zeros(len(self.hashes) + 1, np.int64)
        marks[1:][hits] = 1
        before = np.cumsum(marks)
        at = self.positions(self.window)
        at = at[before[at + self.window - self.block + 1] > before[at]]
        keys, rest = self.sums(at, self.window, 2), self.sums(at, self.window, 5, half=1)
        order, place, first = tell_apart(keys, rest)
        return at, keys[order][first], rest[order][first], place

    def covered(self, at: np.ndarray) -> np.ndarray:
        """Words inside the windows that start there."""
        change = np.zeros(len(self.hashes) + 1, np.int64)
        np.add.at(change, at, 1)
        np.add.at(change, at + self.window, -1)
        return np.cumsum(change)[:-1] > 0


def wide_hashes(words: list[bytes]) -> np.ndarray:
    """128 bits of each word, in two halves."""
    import xxhash

    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, words)), "<u8").reshape(-1, 2)


def tell_apart(keys: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order that sorts keys of two halves, the place of each among the distinct ones, and where in that order a
    distinct one begins."""
    order = np.lexsort((rest, keys))
    first = np.ones(len(order), bool)
    first[1:] = (keys[order][1:] != keys[order][:-1]) | (rest[order][1:] != rest[order][:-1])
    place = np.empty(len(order), np.int64)
    place[order] = np.cumsum(first) - 1
    return order, place, first


def hits_of(chunk: Chunk, once: np.ndarray, twice: np.ndarray) -> np.ndarray:
    """Starts of the probes that hit: not a block, and some block is alike; a block, and another block is alike."""
    at, _, place, is_block = chunk.probes()
    return at[np.where(is_block, twice[place], once[place]).astype(bool)]


def blocks_alike(kind: int, asked: list) -> list:
    """Of each probe, whether one block has its key and whether two have."""
    held = np.concatenate([k[n > 0] for k, (n,) in asked])
    index, place = np.unique(held, return_inverse=True)
    counts = np.bincount(place, weights=np.concatenate([n[n > 0] for _, (n,) in asked]), minlength=len(index))
    replies = []
    for k, _ in asked:
        found = np.zeros(len(k))
        if len(index):
            at = np.minimum(np.searchsorted(index, k), len(index) - 1)
            same = index[at] == k
            found[same] = counts[at[same]]
        replies.append(((found >= 1).astype(np.uint8), (found >= 2).astype(np.uint8)))
    return replies


def windows_alike(kind: int, asked: list) -> list:
    """Of each window, whether it starts anywhere else."""
    _, place, first = tell_apart(np.concatenate([k for k, _ in asked]), np.concatenate([rest for _, (rest, _) in asked]))
    starts = 1 + np.concatenate([several for _, (_, several) in asked])
    counts = np.bincount(place, weights=starts, minlength=int(first.sum()))
    bounds = np.cumsum([len(k) for k, _ in asked])[:-1]
    return [((counts[p] > 1).astype(np.uint8),) for p in np.split(place, bounds)]


def repeats(
    docs: DataFrame, window: int = 35, text_col: str = "text", id_col: str = "doc_id", chunk_bytes: int = CHUNK_BYTES
) -> DataFrame:
    """One row per document: id, ``n_words``, ``n_removed``, ``spans`` (first and last+1 word of each maximal repeat)
    and ``kept`` (the other words joined by one space)."""
    total = docs.agg(F.sum(F.octet_length(whole(F.col(f"`{text_col}`"))))).first()[0] or 0
    probing, comparing = packets.route_for(total, chunk_bytes, (KEY_BYTES,)), packets.route_for(total, chunk_bytes, (8,))
    packed = packets.packs(docs, probing.chunks, text_col, id_col)

    def probe(rows):
        _, keys, place, is_block = Chunk(rows, window).probes()
        blocks = np.minimum(np.bincount(place, weights=is_block, minlength=len(keys)), 2).astype(np.uint8)
        return [(keys, (blocks,))]

    def extend(key, left, right):
        """The packets about windows, and a memo with the hits."""
        chunk, number = Chunk(packets.unpack(left.column("pack")), window), key[0].as_py()
        ((once, twice),) = packets.in_order(right) if right.num_rows else ((np.zeros(0, np.uint8),) * 2,)
        _, keys, rest, place = chunk.candidates(hits_of(chunk, once, twice))
        several = (np.bincount(place, minlength=len(keys)) > 1).astype(np.uint8)
        own = packets.memo(number, (np.packbits(once).tobytes(), np.packbits(twice).tobytes()))
        return pa.concat_tables([packets.send(number, 0, [(keys, (rest, several))], comparing), own])

    kind = docs.schema[id_col].dataType.simpleString()
    id_type = to_arrow_type(docs.schema[id_col].dataType)
    schema = f"id {kind}, n_words long, n_removed long, spans array<struct<first:long,last:long>>, kept binary"

    def cut(key, left, right):
        chunk = Chunk(packets.unpack(left.column("pack")), window)
        _, probes, _, _ = chunk.probes()
        memo = np.asarray(right.column("origin")) < 0
        own = packets.expand(right.filter(pa.array(memo)).column("payload")[0].as_py())
        once, twice = (np.unpackbits(np.frombuffer(b, np.uint8), count=len(probes)) for b in own)
        at, _, _, place = chunk.candidates(hits_of(chunk, once, twice))
        answers = right.filter(pa.array(~memo))
        repeated = packets.in_order(answers)[0][0].astype(bool) if answers.num_rows else np.zeros(0, bool)
        gone = chunk.covered(at[repeated[place]])
        rows = []
        for words, start in zip(chunk.words, chunk.starts, strict=True):
            mask = gone[start : start + len(words)]
            if mask.any():
                edges = np.flatnonzero(np.diff(np.concatenate(([0], mask.astype(np.int8), [0])))).tolist()
                spans = [{"first": a, "last": b} for a, b in zip(edges[::2], edges[1::2], strict=True)]
                kept = b" ".join([w for w, m in zip(words, mask.tolist(), strict=True) if not m])
            else:
                spans, kept = [], b" ".join(words)
            rows.append((len(words), int(mask.sum()), spans, kept))
        span = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
        columns = list(zip(*rows, strict=True)) or [[], [], [], []]
        types = [pa.int64(), pa.int64(), span, pa.binary()]
        arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
        return pa.Table.from_arrays([pa.array(chunk.ids, id_type), *arrays], ["id", "n_words", "n_removed", "spans", "kept"])

    by_chunk = packed.groupBy("chunk")
    hit = packets.converse(packets.ask(packed, probe, probing), blocks_alike, probing)
    sent = by_chunk.cogroup(hit.groupBy("sender")).applyInArrow(extend, packets.PACKETS)
    back = packets.converse(sent, windows_alike, comparing)
    return (
        by_chunk.cogroup(back.groupBy("sender"))
        .applyInArrow(cut, schema)
        .select(F.col("id").alias(id_col), "n_words", "n_removed", "spans", F.col("kept").cast("string").alias("kept"))
    )
