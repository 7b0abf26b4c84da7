"""Exact dedup by Patricia-trie owners.

Texts are partitioned by length and content hash. Inside a partition whole byte strings go into compressed radix tries,
one per length; the terminal of a text holds the row that owns it and the number of its copies. A first round of tries
inside each input task leaves one row per text and task, so that a text with a third of all rows arrives as one row per
task. When tries outgrow their budget, the first round emits what it has and starts anew, and the second moves its
heaviest subtree to a file of its own (anonymous, gone when the task ends; a task that is run again starts from its
shuffled input) and deals with it at the end.

Defined results: NULL counts as empty text; a NULL id is the smallest; of rows with the same id and text one is kept; a text
of any length is one byte string; an empty table gives no rows; columns named like an output column are replaced by it.
"""

from __future__ import annotations

import hashlib
import os
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.llm.text import slices, whole

OUTPUT = ("group_size", "text_sha256")
#: Bytes of labels that the tries of one task hold; each node counts for its Python objects too.
TRIE_BYTES = 32 << 20
NODE_BYTES = 400
OUT_BYTES = 4 << 20


def spill_folder() -> str | None:
    """A local folder of the executor, where Spark itself spills; outside of a task the system's."""
    return os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0] or None


class Node:
    __slots__ = ("label", "children", "owner", "spill")

    def __init__(self, label: bytes):
        self.label, self.children, self.owner, self.spill = label, {}, None, None


def common(label: bytes, text: bytes, at: int) -> int:
    """Length of the prefix that ``label`` shares with ``text`` from ``at`` on, by bisection."""
    low, high = 0, min(len(label), len(text) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if label[low:middle] == text[at + low : at + middle]:
            low = middle
        else:
            high = middle - 1
    return low


class Patricia:
    """Compressed radix trie from byte strings to owners; ``merge(old, new)`` joins the owners of one string."""

    def __init__(self, merge):
        self.root, self.merge, self.bytes, self.parts = Node(b""), merge, 0, []

    def insert(self, text: bytes, owner) -> None:
        node, at = self.root, 0
        while True:
            if node.spill is not None:
                pickle.dump((text, owner), node.spill)
                return
            if at == len(text):
                node.owner = owner if node.owner is None else self.merge(node.owner, owner)
                return
            child = node.children.get(text[at])
            if child is None:
                child = node.children[text[at]] = Node(text[at:])
                child.owner = owner
                self.bytes += len(text) - at + NODE_BYTES
                return
            label = child.label
            if text.startswith(label, at):
                node, at = child, at + len(label)
                continue
            shared = common(label, text, at)
            fork = node.children[text[at]] = Node(label[:shared])
            child.label = label[shared:]
            fork.children[child.label[0]] = child
            self.bytes += NODE_BYTES
            node, at = fork, at + shared

    @staticmethod
    def walk(node: Node, prefix: bytes) -> Iterator[tuple[bytes, object]]:
        stack = [(node, prefix)]
        while stack:
            node, prefix = stack.pop()
            if node.owner is not None:
                yield prefix, node.owner
            stack += [(child, prefix + child.label) for child in node.children.values() if child.spill is None]

    def spill_heaviest(self) -> bool:
        """Move the heaviest subtree below the first fork to a file; texts that lead there are appended from now on.
        False if there is no fork: a single text is held however long it is."""
        node, prefix = self.root, b""
        while len(node.children) == 1 and node.owner is None:
            (child,) = node.children.values()
            if child.spill is not None:
                return False
            node, prefix = child, prefix + child.label
        open_ = [child for child in node.children.values() if child.spill is None]
        if not open_ or len(node.children) + (node.owner is not None) < 2:
            return False
        weights = [sum(len(n.label) + NODE_BYTES for n in self.nodes(child)) for child in open_]
        heaviest = open_[weights.index(max(weights))]
        part = tempfile.TemporaryFile(dir=spill_folder())
        for text, owner in self.walk(heaviest, prefix + heaviest.label):
            pickle.dump((text, owner), part)
        # The label is cut to its first byte: whatever differs later belongs to the same subtree.
        heaviest.label, heaviest.children, heaviest.owner, heaviest.spill = heaviest.label[:1], {}, None, part
        self.parts.append(part)
        self.bytes -= max(weights)
        return True

    @staticmethod
    def nodes(node: Node) -> Iterator[Node]:
        stack = [node]
        while stack:
            node = stack.pop()
            yield node
            stack += node.children.values()

    def owners(self, budget: int) -> Iterator[tuple[bytes, object]]:
        """Every text with its owner: what is in memory first, then subtree by subtree, each in a trie of its own."""
        yield from self.walk(self.root, b"")
        self.root = Node(b"")
        for part in self.parts:
            part.seek(0)
            rest, limit = Patricia(self.merge), budget
            while True:
                try:
                    text, owner = pickle.load(part)
                except EOFError:
                    break
                rest.insert(text, owner)
                if rest.bytes > limit and not rest.spill_heaviest():
                    limit = 2 * rest.bytes
            part.close()
            yield from rest.owners(budget)


class Tries:
    """The tries of one task, one per length, under one budget."""

    def __init__(self, merge, budget: int):
        self.merge, self.budget, self.by_length = merge, budget, {}
        self.bytes, self.limit = 0, budget

    def insert(self, text: bytes, owner) -> None:
        trie = self.by_length.get(len(text))
        if trie is None:
            trie = self.by_length[len(text)] = Patricia(self.merge)
        before = trie.bytes
        trie.insert(text, owner)
        self.bytes += trie.bytes - before

    def spill(self) -> None:
        """Take a subtree from the largest trie that has a fork; if none has, look again when twice as much is held."""
        for trie in sorted(self.by_length.values(), key=lambda t: -t.bytes):
            before = trie.bytes
            if trie.spill_heaviest():
                self.bytes += trie.bytes - before
                return
        self.limit = 2 * self.bytes

    def owners(self) -> Iterator[tuple[bytes, object]]:
        for length in sorted(self.by_length):
            yield from self.by_length[length].owners(self.budget)


def keeper(largest: bool):
    """Owners are (id, whether the text was NULL, other columns, copies). Equal ids: the smaller other columns."""

    def rank(owner):
        return (owner[0] is not None, owner[0]) if owner[0] is not None else (False,)

    def merge(old, new):
        a, b = rank(old), rank(new)
        if a == b:
            best = min(old, new, key=lambda o: repr(o[1:3]))
        else:
            best = max(old, new, key=rank) if largest else min(old, new, key=rank)
        return (*best[:3], old[3] + new[3])

    return merge


def trie_round(names: list[str], schema: pa.Schema, largest: bool, budget: int, last: bool):
    """mapInArrow function. Columns: __text (binary), __copies, the id, __null, others. Not last: emit and start anew
    when the budget is full; last: spill by subtree, add the digest."""

    def batches(found) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for text, (key, null, others, copies) in found:
            digest = (hashlib.sha256(text).hexdigest(),) if last else ()
            rows.append((text, copies, key, null, *others, *digest))
            held += len(text) + 200
            if held > OUT_BYTES:
                yield columns(rows)
                rows, held = [], 0
        if rows:
            yield columns(rows)

    def columns(rows) -> pa.RecordBatch:
        arrays = [pa.array(values, field.type) for values, field in zip(zip(*rows, strict=True), schema, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    def task(it):
        tries = Tries(keeper(largest), budget)
        for batch in (part for whole_batch in it for part in slices(whole_batch)):
            values = [batch.column(name).to_pylist() for name in names]
            for text, copies, key, null, *others in zip(*values, strict=True):
                tries.insert(text, (key, null, tuple(others), copies))
                if tries.bytes > tries.limit:
                    if last:
                        tries.spill()
                    else:
                        yield from batches(tries.owners())
                        tries = Tries(keeper(largest), budget)
        yield from batches(tries.owners())

    return task


def deduplicate(
    docs: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    largest: bool = False,
    trie_bytes: int = TRIE_BYTES,
) -> DataFrame:
    """One row per distinct text, with every column of its owner, ``group_size`` and ``text_sha256``."""
    others = [c for c in docs.columns if c not in (text_col, id_col) and c.lower() not in OUTPUT]
    rows = docs.select(
        whole(F.col(f"`{text_col}`")).cast("binary").alias("__text"),
        F.lit(1).cast("long").alias("__copies"),
        F.col(f"`{id_col}`").alias("__id"),
        F.col(f"`{text_col}`").isNull().alias("__null"),
        *[F.col(f"`{c}`").alias(f"__{i}") for i, c in enumerate(others)],
    )
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema])
    full = T.StructType([*schema.fields, T.StructField("__sha256", T.StringType())])
    names = schema.names
    partial = rows.mapInArrow(trie_round(names, to_arrow_schema(schema), largest, trie_bytes, False), schema)
    owned = partial.repartition(F.length("__text"), F.xxhash64("__text")).mapInArrow(
        trie_round(names, to_arrow_schema(full), largest, trie_bytes, True), full
    )
    back = {text_col: F.when(~F.col("__null"), F.col("__text").cast("string")), id_col: F.col("__id")}
    back |= {c: F.col(f"__{i}") for i, c in enumerate(others)}
    return owned.select(
        *[back[c].alias(c) for c in docs.columns if c in back],
        F.col("__copies").alias("group_size"),
        F.col("__sha256").alias("text_sha256"),
    )


def members(docs: DataFrame, owners: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per document: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Rows alike in id and text are counted before the join and numbered after it; the first one of the owner's is kept.
    Adaptive execution splits the document side of a text with very many ids.
    """
    ids = (
        docs.select(F.col(id_col).alias("id"), F.sha2(whole(F.col(text_col)).cast("binary"), 256).alias("text_sha256"))
        .groupBy("id", "text_sha256")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    keep = owners.select("text_sha256", F.col(id_col).alias("keep_id"), "group_size")
    return (
        ids.join(keep, "text_sha256")
        .select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("copy"))
        .select(
            F.col("id").alias(id_col),
            "keep_id",
            "group_size",
            (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
            "text_sha256",
        )
    )
