"""Exact dedup by Patricia tries that own every distinct text.

Texts are equal when they are identical after white space is deleted. Rows are
partitioned by length and hash of that text. Each task inserts the full byte
strings of its rows into compressed radix tries, one per partition, whose
terminal nodes store the best row seen and a count. So a group of copies leaves a
task as one string, however large it is. The tries of all tasks then meet by
partition and are merged in order, so a task holds the tries of one partition at
a time. When the strings in a task outgrow their bound, whole subtrees are
emitted and cut off; what comes later under the same text meets it in the merge.
A hash only deals strings out: which texts are equal is told by full bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import SPACES, staged

SPILL_BYTES = 64 << 20
BATCH_BYTES = 8 << 20
OWNERS = "length long, content_hash long, normal binary, chars long, doc_id long, n long, ties long"


class Node:
    __slots__ = ("label", "children", "owner")

    def __init__(self, label: bytes, owner: list | None = None):
        self.label, self.owner = label, owner
        self.children: dict[int, Node] = {}


def _better(a: list, b: list) -> list:
    """Of two owners ``[chars, id, n, ties]`` the longer original, then the smaller id, with both counts.

    Ties are rows of the owner's own length and id; those of equal owners add up.
    """
    def order(x):
        return -x[0], x[1] is None, x[1] or 0

    best = a if order(a) <= order(b) else b
    ties = a[3] + b[3] if order(a) == order(b) else best[3]
    return [best[0], best[1], a[2] + b[2], ties]


def _common(a: bytes, b: bytes) -> int:
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[low:middle] == b[low:middle] else (low, middle - 1)
    return low


class Trie:
    """A compressed radix trie of byte strings; ``size`` counts the bytes of its labels."""

    def __init__(self):
        self.root, self.size = Node(b""), 0

    def insert(self, text: bytes, owner: list) -> None:
        node, rest = self.root, text
        while rest:
            child = node.children.get(rest[0])
            if child is None:
                node.children[rest[0]] = Node(rest, owner)
                self.size += len(rest)
                return
            if not rest.startswith(child.label):
                at = _common(child.label, rest)
                upper = Node(child.label[:at])
                child.label = child.label[at:]
                upper.children[child.label[0]] = child
                node.children[rest[0]] = child = upper
            node, rest = child, rest[len(child.label):]
        node.owner = owner if node.owner is None else _better(node.owner, owner)

    @staticmethod
    def _walk(node: Node, prefix: bytes) -> Iterator[tuple[bytes, list]]:
        stack = [(node, prefix)]
        while stack:
            node, prefix = stack.pop()
            text = prefix + node.label
            if node.owner is not None:
                yield text, node.owner
            stack += [(child, text) for child in node.children.values()]

    def terminals(self) -> Iterator[tuple[bytes, list]]:
        return self._walk(self.root, b"")

    def cut(self) -> Iterator[tuple[bytes, list]]:
        """Take subtrees off below the root, one by one, with the strings in them."""
        while self.root.children:
            _, child = self.root.children.popitem()
            yield from self._walk(child, b"")
        if self.root.owner is not None:
            yield b"", self.root.owner
        self.root, self.size = Node(b""), 0


def _batches(found: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    types = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    names = ["length", "content_hash", "normal", "chars", "doc_id", "n", "ties"]
    rows, size = [], 0
    for row in found:
        rows.append(row)
        size += len(row[2]) + 64
        if size >= BATCH_BYTES:
            yield _batch(rows, types, names)
            rows, size = [], 0
    if rows:
        yield _batch(rows, types, names)


def _batch(rows, types, names):
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names
    )


def _read(batches):
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in
                   ("length", "content_hash", "normal", "chars", "doc_id", "n", "ties")]
        yield from zip(*columns, strict=True)


def _owners_of_task(batches, spill: int = SPILL_BYTES):
    """One row per distinct text of a task, more where subtrees had to be cut off."""
    def found():
        tries: dict[tuple, Trie] = {}
        held = 0
        for length, code, normal, *owner in _read(batches):
            trie = tries.setdefault((length, code), Trie())
            before = trie.size
            trie.insert(normal, owner)
            held += trie.size - before
            while held > spill:
                part, trie = tries.popitem()
                held -= trie.size
                for text, owner in trie.cut():
                    yield (*part, text, *owner)
        for part, trie in tries.items():
            for text, owner in trie.terminals():
                yield (*part, text, *owner)

    return _batches(found())


def _merged(batches):
    """Rows sorted by partition to one row per distinct text."""
    def found():
        part, trie = None, Trie()
        for length, code, normal, *found_owner in _read(batches):
            if (length, code) != part:
                for text, owner in trie.cut():
                    yield (*part, text, *owner)
                part = (length, code)
            trie.insert(normal, found_owner)
        for text, owner in trie.cut():
            yield (*part, text, *owner)

    return _batches(found())


def normalised(column: str = "text"):
    return F.translate(F.coalesce(F.col(column), F.lit("")), SPACES, "")


def text_owners(docs: DataFrame, code=F.xxhash64) -> DataFrame:
    """``text_sha256, keep_id, keep_chars, group_size, ties`` for every distinct text of ``docs``.

    ``code`` is the hash that deals texts out; any will do. A null text is an
    empty one, and a null id comes after all others.
    """
    rows = docs.select(
        F.col("doc_id").cast("long"),
        F.length(F.coalesce("text", F.lit(""))).cast("long").alias("chars"),
        normalised().alias("t"),
    ).select(
        F.octet_length("t").cast("long").alias("length"),
        code("t").cast("long").alias("content_hash"),
        F.col("t").cast("binary").alias("normal"),
        "chars", "doc_id", F.lit(1).cast("long").alias("n"), F.lit(1).cast("long").alias("ties"),
    )
    parts = rows.mapInArrow(_owners_of_task, OWNERS).repartition("length", "content_hash")
    merged = parts.sortWithinPartitions("length", "content_hash").mapInArrow(_merged, OWNERS)
    return merged.select(
        F.sha2("normal", 256).alias("text_sha256"),
        F.col("doc_id").alias("keep_id"),
        F.col("chars").alias("keep_chars"),
        F.col("n").alias("group_size"),
        "ties",
    )


def exact_groups(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: which row of its group of equal texts stays.

    That is the one with the most code points in its original text, then the
    smallest id. Null and blank texts are one group. Rows repeated under one id
    count each and share the decision. The rows come back by a join on the
    digest, in which Spark splits the partitions of very large groups.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.sha2(normalised(), 256).alias("text_sha256")
    )
    return rows.join(text_owners(docs), "text_sha256").select(
        "doc_id", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256",
    )


def without_copies(docs: DataFrame) -> DataFrame:
    """One row of each group of equal texts, with all its columns: the one ``exact_groups`` keeps.

    Of rows that share the owner's id, or have none like it, those of a shorter original go.
    Rows that are the owner's in id, length and text are told apart by nothing that
    counts; any one of them stays, found by an aggregation over such groups alone.
    """
    keys = staged(text_owners(docs).select(
        "text_sha256", F.col("keep_id").alias("id"), F.col("keep_chars").alias("chars"), "ties"
    ), "owners")
    rows = docs.select(
        F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"),
        F.length(F.coalesce("text", F.lit(""))).cast("long").alias("chars"),
        F.sha2(normalised(), 256).alias("text_sha256"),
    )

    def owned(keys: DataFrame) -> DataFrame:
        same = (rows.text_sha256 == keys.text_sha256) & rows.id.eqNullSafe(keys.id) & (rows.chars == keys.chars)
        return rows.join(keys, same, "left_semi")

    tied = keys.where("ties > 1")
    if tied.isEmpty():
        return owned(keys).select("row.*")
    single = owned(keys.where("ties = 1")).select("row")
    first = owned(tied).groupBy("text_sha256").agg(F.first("row").alias("row")).select("row")
    return single.unionByName(first).select("row.*")
