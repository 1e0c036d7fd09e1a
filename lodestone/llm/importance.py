"""Importance resampling of documents towards a target distribution.

Features are all runs of one to three words, hashed to 10,000 buckets by CRC-32. Counts
of all documents and of all target texts give each bucket a gain, a document's weight
is the sum over its features, and the documents with the highest weight plus Gumbel
noise are drawn, which is a draw without replacement in proportion to the weights.

CRCs are computed for the distinct features of a block of texts: those of equal length
form a two-dimensional uint8 array, all CRCs of it advance by one column of bytes at
a time, and the buckets are scattered back to where the features occur. Texts are read
in pieces that end between words, and two words are carried over, so a long text needs
no more memory than a short one.

Counts leave a task as one row per bucket. The corpus is read twice, once for
counts and once for weights, which costs less than storing buckets. Ranks come from
one sort of narrow rows by range and the sizes of its partitions.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, partial
from math import floor, log

import numpy as np
import pyarrow as pa
import zlib
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.llm.common import staged

BUCKETS = 10_000
LONGEST_RUN = 3
LEAST_WORDS = 20
PERCENT = 5
SEED = 42
PIECE_BYTES = 1 << 20
MATRIX_BYTES = 4 << 20
# A row of more bytes than this gains nothing from columns.
MATRIX_WIDTH = 512
# Lower case for A-Z, a space for all other ASCII characters that are no letter or digit.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


@cache
def _crc_steps() -> np.ndarray:
    steps = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        steps = np.where(steps & 1, (steps >> np.uint32(1)) ^ np.uint32(0xEDB88320), steps >> np.uint32(1))
    return steps.astype(np.uint32)


def crc_rows(content: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The CRC-32 of every slice of ``content``, slices of one length together."""
    out = np.empty(len(starts), np.uint32)
    order = np.argsort(lengths, kind="stable")
    ordered = lengths[order]
    edges = np.flatnonzero(np.diff(ordered)) + 1
    steps = _crc_steps()
    for rows in np.split(order, edges) if len(order) else ():
        width = int(lengths[rows[0]])
        if width > MATRIX_WIDTH:
            for i in rows.tolist():
                out[i] = zlib.crc32(content[starts[i]:starts[i] + width])
            continue
        block = max(MATRIX_BYTES // max(width, 1), 1)
        for at in range(0, len(rows), block):
            some = rows[at:at + block]
            # One row of the array per place, so that a column of bytes is contiguous.
            columns = content[starts[some] + np.arange(width)[:, None]]
            crc = np.full(len(some), 0xFFFFFFFF, np.uint32)
            for column in columns:
                crc = steps[(crc ^ column) & np.uint32(255)] ^ (crc >> np.uint32(8))
            out[some] = ~crc
    return out


class _Numbers(dict):
    """A number for each word, in the order in which they come."""

    def __missing__(self, word: bytes) -> int:
        found = self[word] = len(self)
        return found


def _pieces(text: bytes, bound: int) -> Iterator[tuple[list[bytes], int]]:
    """The words of a text in lists, each with up to two words before it and how many these are."""
    folded = text.translate(_FOLD)
    carried: list[bytes] = []
    at = 0
    while at < len(folded):
        end = folded.find(b" ", at + bound)
        end = len(folded) if end < 0 else end
        found = folded[at:end].split()
        if found:
            yield carried + found, len(carried)
            carried = (carried + found)[1 - LONGEST_RUN:]
        at = end


def runs_of(parts: list[tuple[int, list[bytes], int]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For runs of one, two and three words: the document and the bucket of each that ends in a new word.

    ``parts`` are documents' numbers with words and how many of the first words are not new.
    """
    number = _Numbers()
    words = [w for _, found, _ in parts for w in found]
    ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    sizes = np.array([len(found) for _, found, _ in parts], np.int64)
    part = np.repeat(np.arange(len(parts)), sizes)
    place = np.arange(len(words)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    new = place >= np.repeat(np.array([old for _, _, old in parts], np.int64), sizes)
    doc = np.array([d for d, _, _ in parts], np.int64)[part]
    content = np.frombuffer(b" ".join(words), np.uint8)
    width = np.fromiter(map(len, words), np.int64, len(words))
    start = np.cumsum(width + 1) - width - 1
    key = ids
    for n in range(1, LONGEST_RUN + 1):
        ends = np.flatnonzero(place >= n - 1)
        if n > 1:
            key = before[ends - 1] * len(number) + ids[ends]
        _, first, back = np.unique(key, return_index=True, return_inverse=True)
        begin = start[ends[first] - n + 1]
        crc = crc_rows(content, begin, start[ends[first]] + width[ends[first]] - begin)
        before = np.zeros(len(words), np.int64)
        before[ends] = back
        here = new[ends]
        yield doc[ends[here]], (crc % BUCKETS).astype(np.int64)[back[here]]


def _blocks(texts: Iterator[bytes], bound: int) -> Iterator[list[tuple[int, list[bytes], int]]]:
    """Pieces of documents in lists of about ``bound`` bytes."""
    parts, held = [], 0
    for doc, text in enumerate(texts):
        for found, old in _pieces(text, bound):
            parts.append((doc, found, old))
            held += min(len(text), bound)
            if held >= bound:
                yield parts
                parts, held = [], 0
    if parts:
        yield parts


def _counts(batches, bound: int = PIECE_BYTES):
    total = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for parts in _blocks((v.as_py() for v in batch.column("text")), bound):
            for _, bucket in runs_of(parts):
                total += np.bincount(bucket, minlength=BUCKETS)
    some = np.flatnonzero(total)
    if len(some):
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(some, pa.int32()), "n": pa.array(total[some])})


def bucket_counts(rows: DataFrame) -> DataFrame:
    """``bucket, n``: how many features of all texts fall into each bucket that has any."""
    counted = _as_bytes(rows).select("text").mapInArrow(_counts, "bucket int, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def _as_bytes(rows: DataFrame, *columns: Column) -> DataFrame:
    return rows.select(*columns, F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))


def gains(docs: DataFrame, target: DataFrame) -> np.ndarray:
    """The gain of every bucket; the two tables of counts hold a row per bucket at most."""
    s, t = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for counts, rows in ((s, docs), (t, target)):
        for row in bucket_counts(rows).collect():
            counts[row["bucket"]] = row["n"]
    all_s, all_t = int(s.sum()) + BUCKETS, int(t.sum()) + BUCKETS
    return np.array([
        floor(1000 * log(float((b + 1) * all_s) / float((a + 1) * all_t)))
        for a, b in zip(s.tolist(), t.tolist(), strict=True)
    ], np.int64)


def _weights(batches, gain: np.ndarray, bound: int = PIECE_BYTES):
    for batch in batches:
        n = np.zeros((LONGEST_RUN, batch.num_rows), np.int64)
        weight = np.zeros(batch.num_rows, np.int64)
        for parts in _blocks((v.as_py() for v in batch.column("text")), bound):
            for length, (doc, bucket) in enumerate(runs_of(parts)):
                n[length] += np.bincount(doc, minlength=batch.num_rows)
                np.add.at(weight, doc, gain[bucket])
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *map(pa.array, (n[0], n.sum(axis=0), weight))],
            ["doc_id", "n_words", "n_features", "weight"],
        )


def noise(doc_id: Column) -> Column:
    """floor(1000 * Gumbel noise) of an id; a null id counts as empty."""
    text = F.concat(F.lit(f"{SEED}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def weighed(docs: DataFrame, target: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score`` for every row of ``docs``."""
    rows = _as_bytes(docs, F.col("doc_id").cast("long").alias("doc_id"))
    found = rows.mapInArrow(
        partial(_weights, gain=gains(docs, target)), "doc_id long, n_words long, n_features long, weight long"
    )
    return found.withColumn("score", F.col("weight") + noise(F.col("doc_id")))


def ranked(scores: DataFrame, percent: int = PERCENT, least: int = LEAST_WORDS) -> DataFrame:
    """``scores`` with ``rank``, null for rows that are not drawn.

    Rows of at least ``least`` words take part; of N such rows floor(percent * N / 100) are
    drawn. One sort by range puts them in order; a row's place is its number in its
    partition plus the sizes of the partitions before, a row for each of which meets the window.
    """
    takes_part = F.col("n_words") >= least
    # Rows that are alike in all sorted columns are told apart, so that no range holds them all.
    numbered = staged(scores.withColumn("row", F.monotonically_increasing_id()), "scores")
    in_order = staged(numbered.orderBy(
        takes_part.desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), "row"
    ).withColumn("place", F.monotonically_increasing_id()), "in-order")
    part = F.shiftright("place", 33)
    sizes = in_order.groupBy(part.alias("part")).agg(
        F.count("*").alias("n"), F.sum(takes_part.cast("long")).alias("eligible")
    )
    every = Window.partitionBy(F.lit(1))
    before = staged(sizes.select(
        "part", (F.sum("n").over(every.orderBy("part")) - F.col("n")).alias("before"),
        F.floor(F.sum("eligible").over(every) * percent / 100).alias("drawn"),
    ), "parts")
    at = F.col("before") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return in_order.withColumn("part", part).join(before, "part").select(
        *scores.columns, F.when(at <= F.col("drawn"), at).alias("rank")
    )


def resampled(docs: DataFrame, target: DataFrame) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` for every row of ``docs``.

    A null or blank text has no features and a weight of 0. Rows repeated under one id
    are each scored, draw the same noise and are ranked apart; rows without an id
    come last among equal scores. Without target texts or documents the gains follow
    from the added ones alone. Other columns are left out.
    """
    return ranked(weighed(docs, target)).select("doc_id", "n_features", "weight", "score", "rank", "n_words")
