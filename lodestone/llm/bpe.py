"""Byte-level BPE with the tiktoken library and a local rank file.

Long texts are handed over in pieces cut where the splitting pattern always has
a border: before white space that follows something else. A very long run of
white space, on which the pattern would run out of stack, is one match by the
rules of the pattern and is passed to the merges directly.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache, partial

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RANKS = "byte_bpe_multi_50k.tiktoken"
PIECE_CHARS = 1 << 16
LONG_SPACE = 1000
OUT_TOKENS = 1 << 21

_BORDER = regex.compile(r"(?<=\P{White_Space})(?=\p{White_Space})")
_SPACES = regex.compile(r"\p{White_Space}{%d,}" % LONG_SPACE)


@cache
def encoding(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "local", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def pieces(text: str, size: int = PIECE_CHARS) -> Iterator[tuple[str, bool]]:
    """``text`` in parts; True marks a part that is one match of the pattern."""
    at = 0
    for run in _SPACES.finditer(text) if len(text) >= LONG_SPACE else ():
        yield from ((part, False) for part in _cut(text[at:run.start()], size))
        # Before more text, the last space of a run belongs to what follows it.
        at = run.end() - (run.end() < len(text))
        yield text[run.start():at], True
    yield from ((part, False) for part in _cut(text[at:], size))


def _cut(text: str, size: int) -> Iterator[str]:
    at = 0
    while len(text) - at > size:
        border = _BORDER.search(text, at + size)
        if border is None:
            break
        yield text[at:border.start()]
        at = border.start()
    if at < len(text):
        yield text[at:]


def encode(text: str, tokenizer: tiktoken.Encoding) -> list[int]:
    if len(text) < LONG_SPACE:
        return tokenizer.encode_ordinary(text)
    ids: list[int] = []
    for part, single in pieces(text):
        ids += tokenizer._encode_single_piece(part) if single else tokenizer.encode_ordinary(part)
    return ids


def _coded(batches, path: str):
    tokenizer = encoding(path)
    for batch in batches:
        keys = batch.column("doc_id")
        texts, start, ids, sizes, plain, held = batch.column("text"), 0, [], [], [], 0
        for row in range(len(texts)):
            found = encode(texts[row].as_py() or "", tokenizer)
            ids.append(np.array(found, np.int32))
            plain.append(tokenizer.decode_bytes(found))
            sizes.append(len(found))
            held += len(found)
            if held >= OUT_TOKENS or row + 1 == len(texts):
                offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
                values = pa.array(np.concatenate(ids), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [keys.slice(start, len(ids)), pa.ListArray.from_arrays(offsets, values),
                     pa.array(plain, pa.binary())],
                    ["doc_id", "ids", "decoded"],
                )
                start, ids, sizes, plain, held = row + 1, [], [], [], 0


def encode_decode(docs: DataFrame, ranks: str | None = None) -> DataFrame:
    """``doc_id, ids, decoded`` for every whole text.

    ``ids`` are the token ids and ``decoded`` the bytes they stand for. A null
    text is an empty one and has no ids. ``ranks`` is the path of the rank file,
    which every worker reads once. Rows repeated are coded each; nothing is
    shuffled, and large batches leave a task in parts.
    """
    path = ranks or public_tokenizers.path(RANKS)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        partial(_coded, path=path), "doc_id long, ids array<int>, decoded binary"
    )


def digests(coded: DataFrame, *more: str) -> DataFrame:
    """Counts and digests of what ``encode_decode`` returns, with the columns named in ``more``."""
    joined = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(joined, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
        *more,
    )
