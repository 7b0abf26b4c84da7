"""SimHash near-dedup by meet-in-the-middle ball hashing.

Two fingerprints within ``radius`` bits share a variant within half the radius of both, and any two that share one are
within the radius. So every distinct fingerprint emits all variants within half the radius, and those who meet in a
variant are linked in a chain, whatever their number, without making pairs.

With radius 4 a fingerprint has 2,081 variants. To shuffle fewer bytes, they are dealt by their leading bits: a
fingerprint is sent once to each prefix that its variants have, and makes the variants of that prefix there. The number
of leading bits follows the number of fingerprints, so that a prefix has about ``variants_per_prefix`` variants; one that
gets far more is cut by further bits.

Defined results: a text without words (NULL, empty, only white space) has fingerprint 0 and links like any other; fewer
words than a shingle are one shingle; a text of any length is read whole, in blocks of its hashes; repeated rows link to
each other; an empty table gives no rows; NULL ids are kept, and a group of NULL ids alone has a NULL component; columns
named like an output column are replaced by it.
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.durable import drop, materialise, scratch
from tidemark.llm.components import components
from tidemark.llm.text import slices, whole

OUTPUT = ("fingerprint", "component_id")
SEED = 42
BLOCK = 1 << 15
#: Bits by which a crowded prefix is cut at a time, and the longest one.
FURTHER, LONGEST = 6, 60


def fingerprint(text: bytes, words: int) -> int:
    import xxhash

    tokens = text.lower().split()
    if not tokens:
        return 0
    if len(tokens) <= words:
        shingles = [b" ".join(tokens)]
    else:
        shingles = map(b" ".join, zip(*[tokens[i:] for i in range(words)], strict=False))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), BLOCK):
        octets = hashes[at : at + BLOCK].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 4, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, text_hash, print): the fingerprint of every row as signed long, and a hash of its text as it stands."""
    text = whole(F.col(f"`{text_col}`"))
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("text_hash"), text.cast("binary").alias("text"))

    def task(batches):
        for batch in (part for whole_batch in batches for part in slices(whole_batch)):
            prints = np.array([fingerprint(t, words) for t in batch.column("text").to_pylist()], np.uint64)
            arrays = [batch.column("id"), batch.column("text_hash"), pa.array(prints.view(np.int64))]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "text_hash", "print"])

    return rows.mapInArrow(task, f"id {docs.schema[id_col].dataType.simpleString()}, text_hash long, print long")


def masks(bits: list[int], flips: int) -> np.ndarray:
    """All words with at most ``flips`` of the given bits set."""
    found = [sum(1 << b for b in chosen) for n in range(flips + 1) for chosen in combinations(bits, n)]
    return np.array(found, np.uint64)


def meet(prints: np.ndarray, prefix: int, lead: int, half: int) -> tuple[np.ndarray, np.ndarray]:
    """Links among fingerprints whose variants have this prefix: each one with the least of its local group."""
    low_bits = list(range(64 - lead))
    away = np.bitwise_count((prints >> np.uint64(64 - lead)) ^ np.uint64(prefix)) if lead else np.zeros(len(prints), int)
    base = prints & np.uint64((1 << (64 - lead)) - 1)
    flips = [masks(low_bits, half - used) for used in range(half + 1)]
    total = sum(int((away == used).sum()) * len(f) for used, f in enumerate(flips))
    keys, owners, end = np.empty(total, np.uint64), np.empty(total, np.int32), 0
    for used, flip in enumerate(flips):
        at = np.flatnonzero(away == used)
        start, end = end, end + len(at) * len(flip)
        np.bitwise_xor(base[at][:, None], flip[None, :], out=keys[start:end].reshape(len(at), len(flip)))
        owners[start:end].reshape(len(at), len(flip))[:] = at[:, None]
    order = np.argsort(keys)
    keys, owners = keys[order], owners[order]
    del order
    same = np.flatnonzero(keys[1:] == keys[:-1])
    a, b = owners[same], owners[same + 1]
    pairs = np.unique(np.minimum(a, b).astype(np.int64) * len(prints) + np.maximum(a, b))
    a, b = pairs // len(prints), pairs % len(prints)
    near = np.bitwise_count(prints[a] ^ prints[b]) <= 2 * half
    a, b = a[near], b[near]
    label = np.arange(len(prints))
    while True:
        least = np.minimum(label[a], label[b])
        was = label.copy()
        np.minimum.at(label, a, least)
        np.minimum.at(label, b, least)
        np.minimum.at(label, was[a], least)
        np.minimum.at(label, was[b], least)
        label = label[label]
        if (label == was).all():
            break
    moved = np.flatnonzero(label != np.arange(len(prints)))
    return prints[moved], prints[label[moved]]


def closer(sent: DataFrame, used: Column, lead: int, further: int, half: int) -> DataFrame:
    """Rows of ``print`` and ``prefix`` (of ``lead`` bits, ``used`` of them flipped) sent on to prefixes of ``further``
    bits more, by the variants that the print has left."""
    bits = F.shiftrightunsigned("print", 64 - lead - further).bitwiseAND((1 << further) - 1)
    flips = F.array(*[F.lit(int(m)) for m in masks(list(range(further)), half)])
    left = F.filter(flips, lambda m: F.bit_count(m) + used <= half)
    longer = F.transform(left, lambda m: F.shiftleft("prefix", further).bitwiseOR(bits.bitwiseXOR(m)))
    return sent.withColumn("prefix", F.explode(longer))


def links(
    distinct: DataFrame, radius: int = 4, variants_per_prefix: int = 1 << 20, most_variants: int = 1 << 22
) -> DataFrame:
    """(a, b) links between distinct fingerprints (column ``print``), enough to connect all within ``radius``.

    A prefix that gets more than ``most_variants`` variants, as near copies of one text bring about, is cut by further
    bits, alone, until none does or the prefix has ``LONGEST`` bits; so long a one is reached by few prints at most."""
    half = radius // 2
    if radius != 2 * half:
        raise ValueError("the radius is even: both sides go half of it")
    ball = sum(len(list(combinations(range(64), n))) for n in range(half + 1))
    lead = max(6, min(24, (distinct.count() * ball // variants_per_prefix).bit_length()))
    now = closer(distinct.withColumn("prefix", F.lit(0).cast("long")), F.lit(0), 0, lead, half)
    done = None
    while True:
        used = F.bit_count(F.shiftrightunsigned("print", 64 - lead).bitwiseXOR(F.col("prefix")))
        each = F.element_at(F.array(*[F.lit(len(masks(list(range(64 - lead)), half - n))) for n in range(half + 1)]), used + 1)
        hot = now.groupBy("prefix").agg(F.sum(each).alias("variants")).filter(F.col("variants") > most_variants)
        crowded = lead < LONGEST
        if crowded:
            hot = materialise(hot.select("prefix"), "hot-prefixes")
            crowded = not hot.isEmpty()
        kept = (now.join(hot, "prefix", "left_anti") if crowded else now).withColumn("lead", F.lit(lead))
        done = kept if done is None else done.unionByName(kept)
        if not crowded:
            break
        further = min(FURTHER, LONGEST - lead)
        now = closer(now.join(hot, "prefix", "left_semi"), used, lead, further, half)
        now = materialise(now, "sent-on")
        lead += further

    def local(key, table):
        prints = table.column("print").to_numpy().view(np.uint64)
        a, b = meet(prints, key[1].as_py(), key[0].as_py(), half)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    return done.groupBy("lead", "prefix").applyInArrow(local, "a long, b long")


def labelled(docs: DataFrame, words: int, radius: int, text_col: str, id_col: str) -> tuple[DataFrame, DataFrame]:
    """The stored fingerprints of all rows, and (print, component) of the distinct ones; a component's name is a print."""
    prints = materialise(fingerprints(docs, words, text_col, id_col), "fingerprints")
    distinct = materialise(prints.select("print").distinct(), "distinct-fingerprints")
    with scratch(docs.sparkSession):
        edges = materialise(links(distinct, radius), "fingerprint-links", outlives=True)
    joined = components(edges)
    drop(edges)
    placed = distinct.join(joined, F.col("print") == F.col("node"), "left").select(
        F.col("print").alias("of"), F.coalesce("component", "print").alias("component")
    )
    return prints, placed


def near_groups(
    docs: DataFrame, words: int = 4, radius: int = 4, text_col: str = "text", id_col: str = "doc_id"
) -> DataFrame:
    """One row per document: id, ``fingerprint`` (16 hexadecimal digits), ``component_id`` (the smallest id among all
    whose fingerprints are linked with its own, through others too)."""
    prints, placed = labelled(docs, words, radius, text_col, id_col)
    first = prints.groupBy("print").agg(F.min("id").alias("first"))
    placed = placed.join(first, F.col("of") == F.col("print")).select("of", "component", "first")
    least = placed.groupBy("component").agg(F.min("first").alias("component_id"))
    labels = placed.join(least, "component").select("of", "component_id")
    return prints.join(labels, F.col("print") == F.col("of")).select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, words: int = 4, radius: int = 4, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The documents, one of each group of linked fingerprints: the one with the smallest id (NULL ids come last; of
    rows that share it, the one with the smallest fingerprint, then text hash; rows alike in id and text stay together)."""
    prints, placed = labelled(docs, words, radius, text_col, id_col)
    order = F.struct(F.col("id").isNull().alias("nameless"), "id", "print", "text_hash")
    rows = prints.join(placed, F.col("print") == F.col("of"))
    kept = rows.groupBy("component").agg(F.min(order).alias("first")).select("first.id", "first.text_hash").distinct()
    this = F.xxhash64(whole(F.col(f"`{text_col}`")))
    return docs.join(kept, F.col(f"`{id_col}`").eqNullSafe(kept["id"]) & (this == kept["text_hash"]), "left_semi")
