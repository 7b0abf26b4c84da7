"""The trie of conversation prefixes, by a splitter skeleton.

A conversation is a path of turn digests (128 bits of role and text). Paths are sorted into shards by range; the trie of the
splitters' own paths, the skeleton, is broadcast. A node outside it has all its members in one shard, since nodes that cross
a splitter are prefixes of it. So a shard, reading its sorted paths one after the other and holding no more than the open
nodes of one path, finishes all other nodes itself; of skeleton nodes it yields partial counts, which are summed over the
shards, and of their subtrees only what hangs below nodes of its own. The skeleton (``MOST_SHARDS`` times ``SEGMENT`` nodes at
most) is then added up from the leaves to the root.

No conversation is held whole. Turns are numbered by a range partitioning that cuts through long conversations, and a path is
cut into segments of ``SEGMENT`` turns: the next segment is a path in a trie of its own, whose root is the node where the one
before ended, told by a sum of position-dependent hashes of all turns so far (128 bits). Counts of a subtree that reaches into
further segments are handed up by one conversation for each such root (the smallest), by running sums over its segments.

The ids of the conversations that end in a node are hashed as they come in order; those of a skeleton node come from several
shards as packed texts and are hashed in the order of the shards. (SHA-256 is sequential: the ids, not the turns, of one node
pass through one task, a packet at a time.)

Defined results: NULL roles and texts count as empty; turns without a number come first, turns of equal numbers in the order
of their digests, repeated rows are turns of their own; rows without conversation id take no part; a text of any length is one
digest; a turnless conversation ends in the root; an empty table gives no rows; further columns, whatever their names, are
ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.durable import materialise, scratch
from tidemark.llm import packets
from tidemark.llm.text import whole

#: Turns of a segment, turns a shard should have, the most shards, sampled paths of a shard.
SEGMENT = 64
SHARD_TURNS = 1_024
MOST_SHARDS = 2_048
SAMPLED = 16
#: Segments of a conversation that are summed together, and bytes of ids in a packet.
SPAN = 1_024
PACKET = 1 << 16
DIGEST = 16
MASK = (1 << 64) - 1
LANES = ("lane0", "lane1", "lane2", "lane3")
NODE = (
    "kind int, shard int, packet int, segment long, depth long, a long, b long, parent_a long, parent_b long, "
    "below_skeleton boolean, conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, last_bytes long, "
    "goes_on boolean, ends string"
)
FINAL, PARTIAL, IDS = 0, 1, 2


def digest(role: Column, text: Column) -> Column:
    return F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))


def turns_of(conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    role, text = whole(F.col(f"`{role_col}`")), whole(F.col(f"`{text_col}`"))
    return conversations.select(
        F.col(f"`{conv_col}`").cast("long").alias("conv"),
        F.col(f"`{turn_col}`").alias("turn"),
        digest(role, text).alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"),
    ).filter(F.col("conv").isNotNull())


def numbered(turns: DataFrame) -> DataFrame:
    """(conv, place, digest, bytes): the turns with their places from 0. A conversation may lie in many partitions; only
    how many turns each of them has is summed per conversation, for those that cross a border."""
    order = [F.col("turn").asc_nulls_first(), F.col("digest"), F.col("row")]
    rows = turns.withColumn("row", F.monotonically_increasing_id()).repartitionByRange("conv", *order)
    rows = materialise(rows.withColumn("part", F.spark_partition_id()), "ordered-turns")
    borders = rows.groupBy("part").agg(F.min("conv").alias("first"), F.max("conv").alias("last"))
    crossing = borders.select("part", F.explode(F.array_distinct(F.array("first", "last"))).alias("conv"))
    crossing = crossing.groupBy("conv").count().filter("count > 1").select("conv")  # one for each partition at most
    counts = rows.join(F.broadcast(crossing), "conv").groupBy("conv", "part").count()
    ahead = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("conv", "part", F.coalesce(F.sum("count").over(ahead), F.lit(0)).alias("offset"))
    here = F.row_number().over(Window.partitionBy("part", "conv").orderBy(*order)) - 1
    placed = rows.withColumn("here", here).join(F.broadcast(offsets), ["conv", "part"], "left")
    place = (F.col("here") + F.coalesce("offset", F.lit(0))).alias("place")
    return materialise(placed.select("conv", place, "digest", "bytes"), "numbered-turns")


def rebuilt(turns: DataFrame, group: int, most_shared: int) -> DataFrame:
    """(conv, total, place, digest, bytes): every conversation with the first h turns of the one whose id its own is
    rounded down to, by ``group``, and then its own turns after its first h; h < ``most_shared`` follows from its id. A
    conversation without turns is one row with place NULL."""
    shared = F.crc32(F.col("conv").cast("string")) % most_shared
    heads = turns.filter((F.col("conv") % group == 0) & (F.col("place") < most_shared - 1))
    heads = heads.groupBy(F.col("conv").alias("base")).agg(
        F.array_sort(F.collect_list(F.struct("place", "digest", "bytes"))).alias("head")  # most_shared - 1 at most
    )
    convs = turns.groupBy("conv").agg((F.max("place") + 1).alias("length")).withColumn("shared", shared)
    convs = convs.withColumn("base", F.col("conv") - F.col("conv") % group).join(heads, "base", "left")
    head = F.slice(F.coalesce("head", F.array().cast(heads.schema["head"].dataType)), F.lit(1), F.col("shared").cast("int"))
    total = F.size("head") + F.greatest(F.col("length") - F.col("shared"), F.lit(0))
    convs = materialise(convs.withColumn("head", head).withColumn("total", total.cast("long")), "rebuilt-heads")
    own = turns.join(convs.select("conv", "total", F.size("head").alias("ahead")), "conv")
    own = own.filter(F.col("place") >= shared).withColumn("place", F.col("place") - shared + F.col("ahead"))
    first = convs.select("conv", "total", F.explode("head").alias("t")).select("conv", "total", "t.*")
    none = convs.filter("total = 0").select("conv", "total")
    return own.select("conv", "total", "place", "digest", "bytes").unionByName(first).unionByName(none, allowMissingColumns=True)


def mix(x: int) -> int:
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & MASK
    x = (x ^ x >> 27) * 0x94D049BB133111EB & MASK
    return x ^ x >> 31


def lanes(word: bytes, depth: int) -> tuple[int, int]:
    """What a turn at a depth (from 1) adds to the name of its node."""
    step = depth * 0x9E3779B97F4A7C15
    return (
        mix(int.from_bytes(word[:8], "little") + step & MASK),
        mix((int.from_bytes(word[8:], "little") ^ 0xD6E8FEB86659FD93) + step & MASK),
    )


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def segments_of(turns: DataFrame, segment: int) -> DataFrame:
    """(conv, segment, path, sizes, last, lanes): the turns of a segment as one path, and the sums of its lanes in four
    parts of 32 bits, which can be added up without overflow."""
    at = F.floor(F.coalesce("place", F.lit(0)) / segment).cast("long").alias("segment")
    turn = F.when(F.col("place").isNotNull(), F.struct("place", "digest", "bytes"))
    found = turns.groupBy("conv", at).agg(
        F.array_sort(F.collect_list(turn)).alias("turns"),  # collect_list leaves NULL out; ``segment`` at most
        F.max("total").alias("total"),
    )
    found = found.select("conv", "segment", "total", F.col("turns.digest").alias("digests"), F.col("turns.bytes").alias("sizes"))

    def task(batches):
        for batch in batches:
            paths, parts = [], []
            for number, words in zip(batch.column("segment").to_pylist(), batch.column("digests").to_pylist(), strict=True):
                path = b"".join(words)
                two = np.frombuffer(path, "<u8").reshape(-1, 2)
                step = np.arange(number * segment + 1, number * segment + len(two) + 1).astype(np.uint64) * packets.GOLDEN
                a = packets.mix64(two[:, 0] + step)
                b = packets.mix64((two[:, 1] ^ np.uint64(0xD6E8FEB86659FD93)) + step)
                low = np.uint64(0xFFFFFFFF)
                parts.append([int((x & low).sum()) if half else int((x >> np.uint64(32)).sum()) for x in (a, b) for half in (0, 1)])
                paths.append(path)
            number, total = (np.asarray(batch.column(c)) for c in ("segment", "total"))
            arrays = [batch.column("conv"), batch.column("segment"), pa.array(paths, pa.binary()), batch.column("sizes")]
            arrays += [pa.array((number + 1) * segment >= total)]
            arrays += [pa.array([p[i] for p in parts], pa.int64()) for i in range(4)]
            yield pa.RecordBatch.from_arrays(arrays, ["conv", "segment", "path", "sizes", "last", *LANES])

    schema = "conv long, segment long, path binary, sizes array<long>, last boolean, " + ", ".join(f"{x} long" for x in LANES)
    return materialise(found.mapInArrow(task, schema), "segments")


def sums_before(rows: DataFrame, names: tuple[str, ...], later: bool = False) -> DataFrame:
    """For each (conv, segment) the sums over the conversation's earlier (or later) segments. Spans of segments are summed
    first, so that no window holds all of a long conversation."""
    order = F.desc if later else F.asc
    spans = rows.withColumn("span", F.floor(F.col("segment") / SPAN))
    whole_spans = spans.groupBy("conv", "span").agg(*[F.sum(x).alias(x) for x in names])
    ahead = Window.partitionBy("conv").orderBy(order("span")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = whole_spans.select("conv", "span", *[F.coalesce(F.sum(x).over(ahead), F.lit(0)).alias(f"{x}_ahead") for x in names])
    inside = Window.partitionBy("conv", "span").orderBy(order("segment")).rowsBetween(Window.unboundedPreceding, -1)
    here = spans.select("conv", "span", "segment", *[F.coalesce(F.sum(x).over(inside), F.lit(0)).alias(x) for x in names])
    summed = [(F.col(x) + F.col(f"{x}_ahead")).alias(x) for x in names]
    return here.join(offsets, ["conv", "span"]).select("conv", "segment", *summed)


def with_roots(coded: DataFrame) -> DataFrame:
    """The segments with the name of the node that each begins at; all first ones begin at the root."""
    several = coded.filter("segment > 0").select("conv").distinct()
    if several.isEmpty():
        roots = coded.select("conv", "segment", "path", "sizes", "last").withColumns({"a": F.lit(0).cast("long"), "b": F.lit(0).cast("long")})
        return roots
    before = sums_before(coded.join(several, "conv", "left_semi"), LANES)
    joined = coded.select("conv", "segment", "path", "sizes", "last").join(before, ["conv", "segment"], "left")
    low = [F.coalesce(x, F.lit(0)).bitwiseAND(0xFFFFFFFF) for x in LANES]
    carry = [F.shiftright(F.coalesce(F.col(x), F.lit(0)), 32) for x in LANES]
    # high * 2^32 + low, modulo 2^64, without an addition that could overflow
    high = [(low[i] + carry[i + 1]).bitwiseAND(0xFFFFFFFF) for i in (0, 2)]
    a, b = (F.shiftleft(h, 32).bitwiseOR(low[i]) for h, i in zip(high, (1, 3), strict=True))
    return materialise(joined.withColumns({"a": a, "b": b}).drop(*LANES), "rooted-segments")


def key_of(segment: int, a: int, b: int, path: bytes) -> bytes:
    """Sorts segments by trie, then by path."""
    return segment.to_bytes(8, "big") + (a & MASK).to_bytes(8, "big") + (b & MASK).to_bytes(8, "big") + path


def walk(key: bytes, segment: int):
    """(depth, a, b) of the nodes on a path, from the one it begins at."""
    number, a, b = (int.from_bytes(key[i : i + 8], "big") for i in (0, 8, 16))
    depth = number * segment
    yield depth, a, b
    for at in range(24, len(key), DIGEST):
        depth += 1
        x, y = lanes(key[at : at + DIGEST], depth)
        a, b = a + x & MASK, b + y & MASK
        yield depth, a, b


class Open:
    """A node whose members are being read."""

    __slots__ = ("depth", "a", "b", "word", "skeleton", "conv", "n", "children", "leaves", "saved", "bytes", "goes_on", "sha", "ids", "packets")

    def __init__(self, depth, a, b, word, size, skeleton):
        self.depth, self.a, self.b, self.word, self.bytes, self.skeleton = depth, a, b, word, size, skeleton
        self.conv, self.n, self.children, self.leaves, self.saved, self.packets = None, 0, 0, 0, 0, 0
        self.goes_on, self.sha, self.ids = False, None, []

    def joined(self, conv: int, n: int) -> None:
        self.conv = conv if self.conv is None else min(self.conv, conv)
        self.n += n


class Shard:
    """Reads sorted segments and yields finished nodes, partial skeleton nodes and packets of ids."""

    def __init__(self, skeleton: set, segment: int):
        self.skeleton, self.segment = skeleton, segment
        self.shard, self.trie, self.number, self.open, self.rows = None, None, 0, [], []

    def node(self, depth: int, a: int, b: int, word: bytes | None, size: int) -> Open:
        return Open(depth, a, b, word, size, (self.number, depth, a, b) in self.skeleton)

    def emit(self, kind: int, node: Open, parent: Open | None, ends: str) -> None:
        below = parent is not None and parent.skeleton and not (self.number and len(self.open) == 1)
        self.rows.append(
            (kind, self.shard, node.packets, self.number, node.depth, signed(node.a), signed(node.b))
            + (signed(parent.a) if parent else None, signed(parent.b) if parent else None, below)
            + (node.conv, node.n, node.children, node.leaves, node.saved, node.bytes, node.goes_on, ends)
        )

    def packet(self, node: Open) -> None:
        self.emit(IDS, node, None, ",".join(node.ids))
        node.ids, node.packets = [], node.packets + 1

    def close(self, keep: int) -> None:
        """Close all but the first ``keep`` open nodes."""
        while len(self.open) > keep:
            node = self.open.pop()
            parent = self.open[-1] if self.open else None
            if parent:
                parent.joined(node.conv, node.n)
            if node.skeleton:
                if node.ids:
                    self.packet(node)
                self.emit(PARTIAL, node, parent, "")
                continue
            node.leaves += not node.children and not node.goes_on
            node.saved += (node.n - 1) * node.bytes
            self.emit(FINAL, node, parent, (node.sha or hashlib.sha256()).hexdigest())
            if parent:
                parent.children += 1
                parent.leaves += node.leaves
                parent.saved += node.saved

    def read(self, shard, number, a, b, path, sizes, conv, last, deeper_leaves, deeper_saved) -> None:
        trie = (number, a, b)
        if (shard, trie) != (self.shard, self.trie):
            self.close(0)
            self.shard, self.trie, self.number = shard, trie, number
            self.open = [self.node(number * self.segment, a & MASK, b & MASK, None, 0)]
        words = [path[i : i + DIGEST] for i in range(0, len(path), DIGEST)]
        same = 0
        while same < len(words) and same + 1 < len(self.open) and self.open[same + 1].word == words[same]:
            same += 1
        self.close(same + 1)
        for word, size in zip(words[same:], sizes[same:], strict=True):
            above = self.open[-1]
            x, y = lanes(word, above.depth + 1)
            self.open.append(self.node(above.depth + 1, above.a + x & MASK, above.b + y & MASK, word, size))
        end = self.open[-1]
        end.joined(conv, 1)
        end.leaves += deeper_leaves
        end.saved += deeper_saved
        if not last:
            end.goes_on = True
        elif end.skeleton:
            end.ids.append(str(conv))
            if len(end.ids) * 8 > PACKET:
                self.packet(end)
        elif end.sha is None:
            end.sha = hashlib.sha256(str(conv).encode())
        else:
            end.sha.update(b",%d" % conv)


def splitters_of(rooted: DataFrame, shards: int, total: int) -> list[tuple[bytes, int]]:
    """The paths, with their conversations, at which shards begin: quantiles of a sample of ``SAMPLED`` for each."""
    wanted = SAMPLED * shards
    place = F.xxhash64(F.lit(11), "conv", "segment")
    share = min(1.0, 1.5 * wanted / max(1, total))
    drawn = rooted.filter(F.pmod(place, F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    table = drawn.select("segment", "a", "b", "path", "conv").orderBy(place).limit(wanted).toArrow()
    rows = sorted((key_of(*r[:4]), r[4]) for r in zip(*[c.to_pylist() for c in table.columns], strict=True))
    return sorted({rows[len(rows) * i // shards] for i in range(1, shards)}) if rows else []


def tries(rooted: DataFrame, segment: int, shard_turns: int, outlives: bool = False) -> DataFrame:
    """One row for each node of each segment's trie, with counts inside it and what its members hand up."""
    totals = rooted.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("sizes") + 1).alias("turns")).first()
    shards = max(1, min(MOST_SHARDS, -(-(totals["turns"] or 0) // shard_turns)))
    splitters = splitters_of(rooted, shards, totals["n"])
    skeleton = {(int.from_bytes(key[:8], "big"), *node) for key, _ in splitters for node in walk(key, segment)}
    shared = rooted.sparkSession.sparkContext.broadcast((splitters, skeleton))

    def deal(batches):
        at = shared.value[0]
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("segment", "a", "b", "path")]
            keys = [key_of(*r) for r in zip(*columns, strict=True)]
            shard = [bisect_right(at, (k, c)) for k, c in zip(keys, batch.column("conv").to_pylist(), strict=True)]
            arrays = [pa.array(shard, pa.int32()), pa.array(keys, pa.binary())]
            arrays += [batch.column(c) for c in ("conv", "sizes", "last", "deeper_leaves", "deeper_saved")]
            yield pa.RecordBatch.from_arrays(arrays, ["shard", "key", "conv", "sizes", "last", "deeper_leaves", "deeper_saved"])

    dealt = rooted.mapInArrow(
        deal, "shard int, key binary, conv long, sizes array<long>, last boolean, deeper_leaves long, deeper_saved long"
    )
    dealt = dealt.repartition(shards, "shard").sortWithinPartitions("shard", "key", "conv")
    types = [pa.int32()] * 3 + [pa.int64()] * 6 + [pa.bool_()] + [pa.int64()] * 6 + [pa.bool_(), pa.string()]
    names = [x.split()[0] for x in NODE.split(", ")]

    def grow(batches):
        reader = Shard(shared.value[1], segment)

        def done():
            columns = zip(*reader.rows, strict=True)
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)
            reader.rows = []
            return batch

        for batch in batches:
            for shard, key, conv, sizes, last, leaves, saved in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                number, a, b = (int.from_bytes(key[i : i + 8], "big") for i in (0, 8, 16))
                reader.read(shard, number, a, b, key[24:], sizes, conv, last, leaves, saved)
                if len(reader.rows) >= 4096:
                    yield done()
        reader.close(0)
        if reader.rows:
            yield done()

    found = materialise(dealt.mapInArrow(grow, NODE), "trie-nodes", outlives)
    kept = [n for n in names if n not in ("kind", "shard", "packet", "last_bytes", "goes_on")]
    return found.filter(F.col("kind") == FINAL).select(*kept).unionByName(reduced(found).select(*kept))


def reduced(found: DataFrame) -> DataFrame:
    """The skeleton nodes: partial counts summed over the shards, then added up from the leaves."""
    name = ["segment", "depth", "a", "b"]
    sums = found.filter(F.col("kind") == PARTIAL).groupBy(*name, "parent_a", "parent_b", "below_skeleton").agg(
        F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.max("last_bytes").alias("last_bytes"),
        F.max("goes_on").alias("goes_on"),
    )
    nodes = {tuple(r[c] for c in name): r.asDict() for r in sums.collect()}  # bounded: the skeleton
    below = defaultdict(list)
    for (number, depth, _, _), r in nodes.items():
        if r["parent_a"] is not None:
            below[number, depth - 1, r["parent_a"], r["parent_b"]].append(r)
    for key in sorted(nodes, key=lambda k: -k[1]):
        r = nodes[key]
        for child in below[key]:
            r["n_children"] += 1
            r["n_leaves"] += child["n_leaves"]
            r["saved_tokens"] += child["saved_tokens"]
        r["n_leaves"] += not r["n_children"] and not r["goes_on"]
        r["saved_tokens"] += (r["n_convs"] - 1) * r["last_bytes"]
    order = [*name, "shard", "packet"]
    ids = found.filter(F.col("kind") == IDS).select(*order, "ends").repartition(*name).sortWithinPartitions(*order)

    def hash_ids(batches):
        now, sha = None, None
        for batch in batches:
            rows = []
            for *key, _, _, ends in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if key == now:
                    sha.update(b"," + ends.encode())
                    continue
                if now is not None:
                    rows.append((*now, sha.hexdigest()))
                now, sha = key, hashlib.sha256(ends.encode())
            yield as_batch(rows)
        if now is not None:
            yield as_batch([(*now, sha.hexdigest())])

    def as_batch(rows):
        columns = list(zip(*rows, strict=True)) or [()] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 4 + [pa.string()], strict=True)], [*name, "ends"])

    hashed = ids.mapInArrow(hash_ids, "segment long, depth long, a long, b long, ends string")
    schema = sums.schema
    table = found.sparkSession.createDataFrame([tuple(r[f.name] for f in schema) for r in nodes.values()], schema)
    nothing = F.lit(hashlib.sha256().hexdigest())
    return table.join(hashed, name, "left").withColumn("ends", F.coalesce("ends", nothing))


def handed_up(rooted: DataFrame, segment: int, shard_turns: int) -> DataFrame:
    """The segments with what the conversation hands up from its later ones: each root of a further segment counts for the
    smallest of its conversations."""
    none = {"deeper_leaves": F.lit(0).cast("long"), "deeper_saved": F.lit(0).cast("long")}
    further = rooted.filter("segment > 0")
    if further.isEmpty():
        return rooted.withColumns(none)
    roots = tries(further.withColumns(none), segment, shard_turns).filter(F.col("depth") == F.col("segment") * segment)
    own = roots.select(F.col("conv_id").alias("conv"), "segment", F.col("n_leaves").alias("deeper_leaves"), F.col("saved_tokens").alias("deeper_saved"))
    members = rooted.select("conv", "segment").join(further.select("conv").distinct(), "conv", "left_semi")
    members = members.join(own, ["conv", "segment"], "left").fillna(0, ["deeper_leaves", "deeper_saved"])
    later = sums_before(members, ("deeper_leaves", "deeper_saved"), later=True)
    joined = rooted.join(later, ["conv", "segment"], "left").fillna(0, ["deeper_leaves", "deeper_saved"])
    return materialise(joined, "handed-up-segments")


def prefix_nodes(turns: DataFrame, segment: int = SEGMENT, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The nodes of all prefixes of (conv, total, place, digest, bytes) rows."""
    rooted = handed_up(with_roots(segments_of(turns, segment)), segment, shard_turns)
    nodes = tries(rooted, segment, shard_turns, outlives=True)
    name = ["depth", "a", "b"]
    begins = (F.col("segment") > 0) & (F.col("depth") == F.col("segment") * segment)
    # A node at which a segment ends has its children in the tries that begin there.
    further = nodes.filter(begins).select(*name, F.col("n_children").alias("further"))
    nodes = nodes.filter(~begins)
    if rooted.filter("segment > 0").isEmpty():
        joined = nodes
    else:
        joined = nodes.join(further, name, "left").withColumn("n_children", F.col("n_children") + F.coalesce("further", F.lit(0)))
        joined = joined.drop("further")
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("parent_a"), F.col("b").alias("parent_b"), F.col("conv_id").alias("parent_conv_id"))
    up = ["depth", "parent_a", "parent_b"]
    # Only a skeleton node can have more children than a shard has turns; the others' parents are looked up by shuffling.
    crowded = F.broadcast(parents.join(joined.filter("below_skeleton").select(*up).distinct(), up, "left_semi"))
    found = joined.filter("below_skeleton").join(crowded, up, "left").unionByName(joined.filter("not below_skeleton").join(parents, up, "left"))
    columns = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")
    return found.select(*columns, F.col("ends").alias("ends_sha256"))


def trie(
    conversations: DataFrame,
    group: int = 5,
    most_shared: int = 9,
    segment: int = SEGMENT,
    shard_turns: int = SHARD_TURNS,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """One row for each distinct prefix of the rebuilt conversations."""
    with scratch(conversations.sparkSession):  # only the table of nodes stays
        turns = numbered(turns_of(conversations, conv_col, turn_col, role_col, text_col))
        return prefix_nodes(rebuilt(turns, group, most_shared), segment, shard_turns)
