"""Asking the whole corpus about the contents of a chunk, in few bytes.

Documents are dealt to chunks by hash. A chunk asks about the hashes it holds, each once and sorted, with a value or more for
each; hash buckets see what all chunks ask, and the answers come back in the order of the keys. No row needs a name: both sides
keep keys sorted, and a chunk that is read again after a lost executor, with its rows in another order, fits the same answers.

Chunks and buckets both grow with the input, so a packet from every chunk to every bucket would grow with its square. Above
``2 ** HOP_BITS`` buckets packets travel in hops, each by as many further bits of the key: those of a group of chunks for one
prefix meet in a task, which merges them in the order of their keys and sends on one packet for each next prefix. A group has as
many senders as a prefix has successors, so a task holds about as much as a chunk, and every hop has at most
``2 ** HOP_BITS`` packets a chunk. Answers go the same way back: a task sees again what it merged, and takes it apart. Prefixes
without a key get no packet.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import whole

#: Packs of one task are sent off when they hold this much text.
TASK_BYTES = 32 << 20
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit over the word (Stafford's variant 13)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def coefficients(n: int, seed: int) -> np.ndarray:
    """n odd random multipliers."""
    return mix64(np.arange(1, n + 1, dtype=np.uint64) * GOLDEN + np.uint64(seed)) | np.uint64(1)


def word_hashes(words: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def smallest(counts: np.ndarray) -> np.ndarray:
    """The counts in as few bytes each as hold them."""
    return counts.astype(np.min_scalar_type(int(counts.max(initial=0))))


def squeeze(value) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(value, protocol=5))


def expand(data: bytes):
    import zstandard

    return pickle.loads(zstandard.ZstdDecompressor().decompress(data))


#: Bits of the key that one hop deals by, at most.
HOP_BITS = 8
#: What a packet may hold: for each kind of key the sorted keys and the arrays of values beside them.
Kinds = list[tuple[np.ndarray, tuple[np.ndarray, ...]]]
PACKETS = "destination long, group long, sender long, payload binary"
ANSWERS = "sender long, origin long, payload binary"


@dataclass(frozen=True)
class Route:
    """chunks: how many there are; digits: bits of the key by hop; widths: bytes of a key that tell it inside a bucket."""

    chunks: int
    digits: tuple[int, ...]
    widths: tuple[int, ...]

    @property
    def buckets(self) -> int:
        return 1 << sum(self.digits)

    def beyond(self) -> Route:
        return Route(self.chunks, self.digits[1:], self.widths)


def route_for(total_bytes: int, chunk_bytes: int, widths: tuple[int, ...]) -> Route:
    """Sixty-four chunks and buckets at least; a bucket takes about as much as a chunk of four times the size, since
    chunks ask about a hash once."""
    chunks = max(64, math.ceil(total_bytes / chunk_bytes))
    bits = max(6, (chunks // 4).bit_length())
    hops = -(-bits // HOP_BITS)
    return Route(chunks, tuple(bits // hops + (n < bits % hops) for n in range(hops)), widths)


def pack_kinds(kinds: Kinds, route: Route) -> bytes:
    """Keys come without the bits that the way here has told; as many bytes are kept as tell them apart and lead on."""
    onward = -(-sum(route.digits) // 8)
    return squeeze([(narrow_top(k, min(8, w + onward)), len(k), v) for (k, v), w in zip(kinds, route.widths, strict=True)])


def unpack_kinds(payload: bytes, route: Route) -> Kinds:
    onward = -(-sum(route.digits) // 8)
    packed = expand(payload)
    return [(widen_top(k, min(8, w + onward), n), v) for (k, n, v), w in zip(packed, route.widths, strict=True)]


def narrow_top(keys: np.ndarray, width: int) -> bytes:
    """The leading bytes of each key."""
    return keys.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def widen_top(data: bytes, width: int, count: int) -> np.ndarray:
    full = np.zeros((count, 8), np.uint8)
    full[:, :width] = np.frombuffer(data, np.uint8).reshape(count, width)
    return full.view(">u8").ravel().astype(np.uint64)


def deal(kinds: Kinds, digit: int) -> Iterator[tuple[int, Kinds]]:
    """The keys by their leading bits, which are taken off; prefixes without any are left out."""
    bounds = np.arange(1 << digit, dtype=np.uint64) << np.uint64(64 - digit)
    at = [np.append(np.searchsorted(k, bounds), len(k)) for k, _ in kinds]
    for prefix in np.flatnonzero(sum(np.diff(a) for a in at)).tolist():
        parts = [slice(a[prefix], a[prefix + 1]) for a in at]
        yield prefix, [(k[s] << np.uint64(digit), tuple(x[s] for x in v)) for (k, v), s in zip(kinds, parts, strict=True)]


def send(sender: int, origin: int, kinds: Kinds, route: Route) -> pa.Table:
    """The packets of a sender (a chunk, or a group of them at the prefix ``origin``)."""
    digit, beyond = route.digits[0], route.beyond()
    rows = [((origin << digit) | p, sender >> digit, sender, pack_kinds(part, beyond)) for p, part in deal(kinds, digit)]
    columns = list(zip(*rows, strict=True)) or [()] * 4
    types = [pa.int64()] * 3 + [pa.binary()]
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["destination", "group", "sender", "payload"])


def merged(table: pa.Table, route: Route) -> tuple[Kinds, list[np.ndarray], list[list[int]]]:
    """What several senders ask, as one: the kinds sorted by key, the order that sorts each, and how much of each kind a
    sender brought."""
    packets = [unpack_kinds(p.as_py(), route) for p in table.sort_by("sender").column("payload")]
    kinds, orders = [], []
    for n in range(len(route.widths)):
        keys = np.concatenate([p[n][0] for p in packets])
        order = np.argsort(keys, kind="stable")
        values = [np.concatenate(v)[order] for v in zip(*[p[n][1] for p in packets], strict=True)]
        kinds.append((keys[order], tuple(values)))
        orders.append(order)
    return kinds, orders, [[len(p[n][0]) for n in range(len(route.widths))] for p in packets]


def memo(sender: int, value) -> pa.Table:
    """What a chunk sends to itself by way of the buckets, so that it comes with their answers."""
    columns = [[-1 - sender], [sender], [sender], [squeeze(value)]]
    types = [pa.int64()] * 3 + [pa.binary()]
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["destination", "group", "sender", "payload"])


def echoed(table: pa.Table, origin: str) -> pa.Table:
    return pa.Table.from_arrays([table.column("sender"), table.column(origin), table.column("payload")], ["sender", "origin", "payload"])


Answers = list[tuple[np.ndarray, ...]]


def joined(payloads: Iterable[bytes]) -> Answers:
    """The answers of several packets one after the other, by kind."""
    found = [expand(p) for p in payloads]
    return [tuple(np.concatenate(c) for c in zip(*kind, strict=True)) for kind in zip(*found, strict=True)]


def converse(sent: DataFrame, reply: Callable[[int, list], list], route: Route) -> DataFrame:
    """(sender, origin, payload): the answers to the packets ``sent``, of each sender by the prefixes it sent to.

    ``reply`` gets the number of a kind and what a bucket is asked (keys and values of each packet), and returns the arrays
    of answers to each packet. A memo (see :func:`memo`) comes back as it is."""
    beyond = route.beyond()
    if not beyond.digits:

        def answer(key, table):
            if key[0].as_py() < 0:
                return echoed(table, "destination")
            table = table.sort_by("sender")
            asked = [unpack_kinds(p.as_py(), beyond) for p in table.column("payload")]
            replies = [reply(n, [a[n] for a in asked]) for n in range(len(route.widths))]
            payloads = [squeeze([r[i] for r in replies]) for i in range(len(asked))]
            return pa.Table.from_arrays(
                [table.column("sender"), table.column("destination"), pa.array(payloads, pa.binary())], ["sender", "origin", "payload"]
            )

        return sent.groupBy("destination").applyInArrow(answer, ANSWERS)

    def merge(key, table):
        if key[0].as_py() < 0:
            return table.select(["destination", "group", "sender", "payload"])
        kinds, _, _ = merged(table, beyond)
        return send(key[1].as_py(), key[0].as_py(), kinds, beyond)

    def take_apart(key, there, answers):
        if key[0].as_py() < 0:
            return echoed(there, "destination")
        _, orders, sizes = merged(there, beyond)
        kinds = []
        for order, columns in zip(orders, joined(p.as_py() for p in answers.sort_by("origin").column("payload")), strict=True):
            back = np.empty_like(order)
            back[order] = np.arange(len(order))
            kinds.append(tuple(c[back] for c in columns))
        ends = np.cumsum(np.array([[0] * len(orders), *sizes]), axis=0)
        senders = np.asarray(there.sort_by("sender").column("sender"))
        payloads = [
            squeeze([tuple(c[a[n] : b[n]] for c in columns) for n, columns in enumerate(kinds)])
            for a, b in zip(ends, ends[1:], strict=False)
        ]
        origin = np.full(len(senders), key[0].as_py())
        return pa.Table.from_arrays(
            [pa.array(senders), pa.array(origin), pa.array(payloads, pa.binary())], ["sender", "origin", "payload"]
        )

    met = sent.groupBy("destination", "group")
    answers = converse(met.applyInArrow(merge, PACKETS), reply, beyond)
    # A task that merged is a sender of the next hop: its group is the sender, its prefix that of the answer's origin.
    home = F.when(F.col("origin") < 0, F.col("origin")).otherwise(F.shiftright("origin", beyond.digits[0]))
    answers = answers.select(home.alias("destination"), F.col("sender").alias("group"), "origin", "payload")
    return met.cogroup(answers.groupBy("destination", "group")).applyInArrow(take_apart, ANSWERS)


def packs(docs: DataFrame, chunks: int, text_col: str, id_col: str, extra: dict[str, Column] | None = None) -> DataFrame:
    """(chunk, pack): documents as compressed pickles of (ids, texts, extra columns). Of a task's rows those of one
    chunk make one pack, which compresses better than a shuffle block does. A row's chunk follows from its place in the
    table, so rows alike in id and text are spread."""
    extra = extra or {}
    text = whole(F.col(f"`{text_col}`"))
    rows = docs.select(
        F.pmod(F.xxhash64(F.lit(7), F.monotonically_increasing_id()), F.lit(chunks)).alias("chunk"),
        F.col(f"`{id_col}`").alias("id"),
        text.cast("binary").alias("text"),
        *[c.alias(n) for n, c in extra.items()],
    )

    def packed(held: dict) -> pa.RecordBatch:
        names = sorted(held)
        found = [squeeze(tuple(map(list, zip(*held[c], strict=True)))) for c in names]
        return pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(found, pa.binary())], ["chunk", "pack"])

    def task(batches):
        held, size = {}, 0
        for batch in batches:
            for chunk, *row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                held.setdefault(chunk, []).append(row)
                size += len(row[1]) + 100
                if size > TASK_BYTES:
                    yield packed(held)
                    held, size = {}, 0
        if held:
            yield packed(held)

    return rows.mapInArrow(task, "chunk long, pack binary")


def unpack(column) -> Iterator[tuple]:
    """(id, text, ...) of every document in a column of packs."""
    for pack in column:
        yield from zip(*expand(pack.as_py()), strict=True)


def ask(packed: DataFrame, request: Callable[[Iterable], Kinds], route: Route) -> DataFrame:
    """The packets of all chunks: ``request`` sees the documents of one chunk."""

    def group(key, table):
        return send(key[0].as_py(), 0, request(unpack(table.column("pack"))), route)

    return packed.groupBy("chunk").applyInArrow(group, PACKETS)


def in_order(replies: pa.Table) -> Answers:
    """The answers to one chunk, by kind, in the order of its keys."""
    return joined(p.as_py() for p in replies.sort_by("origin").column("payload"))
