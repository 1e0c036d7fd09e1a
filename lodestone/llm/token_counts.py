"""Token counts that follow edits without encoding whole texts again.

A text is kept as segments cut where the splitting pattern always has a border,
each with its number of characters and tokens. Over the segments of a document
stands a tree of sums. An edit takes the segments it touches out of the tree,
with one more on either side as context, since it can undo the border it stands
at; only their text is cut and encoded anew, and the sums above follow. The
segments of a document are two lists of numbers next to its text, so they are
stored like any column and later edits start from them.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.llm import bpe

SEGMENT_CHARS = 256
OUT_CHARS = 8 << 20
EDITS = "array<struct<start:int,stop:int,text:string>>"


class Node:
    """A leaf with its text, or the sums of two subtrees."""

    __slots__ = ("left", "right", "text", "chars", "tokens", "depth")

    def __init__(self, left=None, right=None, text="", tokens=0):
        self.left, self.right, self.text = left, right, text
        if left is None:
            self.chars, self.tokens, self.depth = len(text), tokens, 0
        else:
            self.chars, self.tokens = left.chars + right.chars, left.tokens + right.tokens
            self.depth = 1 + max(left.depth, right.depth)


def built(leaves: list[Node]) -> Node | None:
    """A balanced tree over ``leaves``; None over none."""
    while len(leaves) > 1:
        pairs = [Node(a, b) for a, b in zip(leaves[::2], leaves[1::2])]
        leaves = pairs + leaves[len(pairs) * 2:]
    return leaves[0] if leaves else None


def joined(a: Node | None, b: Node | None) -> Node | None:
    return Node(a, b) if a and b else a or b


def leaves_of(node: Node | None) -> Iterator[Node]:
    stack = [node] if node else []
    while stack:
        node = stack.pop()
        if node.left is None:
            yield node
        else:
            stack += [node.right, node.left]


def parted(node: Node | None, at: int) -> tuple[Node | None, Node | None]:
    """Leaves that end before ``at``, and the others; no leaf is cut."""
    path, before, after = node, [], []
    while path:
        if path.left is None:
            (before if path.chars < at else after).append(path)
            break
        if path.left.chars < at:
            before.append(path.left)
            at -= path.left.chars
            path = path.right
        else:
            after.append(path.right)
            path = path.left
    left = right = None
    for part in before:
        left = joined(left, part)
    for part in after[::-1]:
        right = joined(right, part)
    return left, right


def _edge(node: Node | None, last: bool) -> tuple[Node | None, Node | None]:
    """A tree without its last or first leaf, and that leaf."""
    rest = []
    while node and node.left:
        rest.append(node.left if last else node.right)
        node = node.right if last else node.left
    out = None
    if last:
        for part in rest:
            out = joined(out, part)
    else:
        for part in rest[::-1]:
            out = joined(out, part)
    return out, node


def segments(text: str, tokenizer) -> list[Node]:
    """Leaves of a text, encoded."""
    return [
        Node(text=part, tokens=len(tokenizer._encode_single_piece(part) if single else tokenizer.encode_ordinary(part)))
        for part, single in bpe.pieces(text, SEGMENT_CHARS)
    ]


class Counted:
    """A document's tree, and how many characters were encoded for it."""

    def __init__(self, leaves: list[Node], tokenizer):
        self.tokenizer, self.encoded = tokenizer, 0
        self.tree = built(leaves)

    @property
    def tokens(self) -> int:
        return self.tree.tokens if self.tree else 0

    def edit(self, start: int, stop: int, text: str) -> None:
        """Put ``text`` in place of characters ``start`` to ``stop``; places beyond the text are its end."""
        size = self.tree.chars if self.tree else 0
        start = min(max(start, 0), size)
        stop = min(max(stop, start), size)
        left, rest = parted(self.tree, start)
        at = left.chars if left else 0
        touched, right = parted(rest, stop - at + 1)
        left, context = _edge(left, last=True)
        # The leaf that holds the place behind the edit, or follows it.
        right, follow = _edge(right, last=False)
        old = "".join(leaf.text for part in (context, touched, follow) for leaf in leaves_of(part))
        at -= context.chars if context else 0
        new = old[:start - at] + text + old[stop - at:]
        self.encoded += len(new)
        self.tree = joined(joined(left, built(segments(new, self.tokenizer))), right)
        if self.tree and self.tree.depth > 64:
            self.tree = built(list(leaves_of(self.tree)))


def _lists(rows: list[list[int]]) -> pa.Array:
    at = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array([x for r in rows for x in r], pa.int32()))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    keys, texts, trees, encoded, *before = zip(*rows, strict=True)
    leaves = [list(leaves_of(tree)) for tree in trees]
    return pa.RecordBatch.from_arrays(
        [pa.array(keys, pa.int64()), pa.array(texts, pa.string()), _lists([[x.chars for x in r] for r in leaves]),
         _lists([[x.tokens for x in r] for r in leaves]),
         pa.array([tree.tokens if tree else 0 for tree in trees], pa.int64()), pa.array(encoded, pa.int64()),
         *(pa.array(c, pa.int64()) for c in before)],
        ["doc_id", "text", "leaf_chars", "leaf_tokens", "n_tokens", "n_encoded", *["n_tokens_before"] * len(before)],
    )


def _in_parts(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[1])
        if size >= OUT_CHARS:
            yield _batch(held)
            held, size = [], 0
    if held:
        yield _batch(held)


def _count(batches, path: str):
    tokenizer = bpe.encoding(path)

    def rows():
        for batch in batches:
            for key, value in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                text = value.as_py() or ""
                yield key, text, built(segments(text, tokenizer)), len(text)

    return _in_parts(rows())


def _edit(batches, path: str):
    tokenizer = bpe.encoding(path)

    def rows():
        for batch in batches:
            for row in range(batch.num_rows):
                key, text, chars, tokens, edits = (
                    batch.column(c)[row].as_py() for c in ("doc_id", "text", "leaf_chars", "leaf_tokens", "edits")
                )
                at = np.concatenate([[0], np.cumsum(chars or [])]).astype(int).tolist()
                tree = Counted([
                    Node(text=text[a:b], tokens=n) for a, b, n in zip(at, at[1:], tokens or [], strict=False)
                ], tokenizer)
                before = tree.tokens
                for edit in edits or []:
                    tree.edit(edit["start"] or 0, edit["stop"] or 0, edit["text"] or "")
                yield key, "".join(leaf.text for leaf in leaves_of(tree.tree)), tree.tree, tree.encoded, before

    return _in_parts(rows())


STATE = "doc_id long, text string, leaf_chars array<int>, leaf_tokens array<int>, n_tokens long, n_encoded long"


def counted(docs: DataFrame, ranks: str | None = None) -> DataFrame:
    """``doc_id, text, leaf_chars, leaf_tokens, n_tokens, n_encoded`` of every whole text.

    A null text is an empty one. Rows repeated are counted each. Nothing is shuffled.
    """
    path = ranks or public_tokenizers.path(bpe.RANKS)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(partial(_count, path=path), STATE)


def edited(state: DataFrame, edits: Column, ranks: str | None = None) -> DataFrame:
    """The state of every row after its ``edits``, applied one after the other.

    Each has ``start, stop, text`` in characters of the text at its turn; nulls
    are 0 and nothing, and a row with a null list stays as it is. ``n_encoded``
    is how many characters were encoded for it, ``n_tokens_before`` the count before.
    """
    path = ranks or public_tokenizers.path(bpe.RANKS)
    rows = state.select("doc_id", "text", "leaf_chars", "leaf_tokens", edits.cast(EDITS).alias("edits"))
    return rows.mapInArrow(partial(_edit, path=path), f"{STATE}, n_tokens_before long")
