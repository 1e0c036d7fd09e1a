"""Quality scores learned from preference pairs (Bradley-Terry).

Each text is described by shares that do not depend on its language. From rows
labelled good and rows labelled bad pairs are formed in which the good one is
preferred; the chance of that is the logistic function of the difference of two
scores, linear in the features. Minimising the logistic loss over the feature
differences gives the weights. The threshold is the quantile of the scores at the
share of bad rows, and scores are shifted so that it falls on 0.7.

The model learns from every labelled row. Features of labelled rows lie in blocks, in
which pairs are made; sums over the blocks reach the driver for each Newton step, and counts
for the quantile, so its memory does not grow with the labels. All rows
are scored in one pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.plans.checkpoint import dropped, likely, staged

FEATURES = (
    "upper_words", "symbol_chars", "digit_chars", "wordless", "repeats", "distinct",
    "word_chars", "odd_word_chars", "repeated_lines", "pipes", "shouts", "few_words", "punctuation",
)
PAIRS_PER_ROW = 8
# Rows of the more frequent label in a block of pairs, about, and of the other one at least, if it has as many.
ROWS_PER_BLOCK = 4096
LEAST_PER_BLOCK = 512
CUT_SCORE = 0.7
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[[ord(c) for c in "#$%&*<>\\^_`{|}~@=+/"]] = True


def features(text: str | None) -> list[float]:
    """Shares that describe one text; a null or blank one has none but ``few_words``."""
    words = (text or "").split()
    if not words:
        return [0.0] * 11 + [1.0, 0.0]
    n = len(words)
    codes = np.bincount(np.frombuffer(text.encode("utf-8", "replace"), np.uint8), minlength=256)
    chars = sum(map(len, words))
    mean = chars / n
    lines = [line for line in map(str.strip, text.split("\n")) if line]
    return [
        sum(map(str.isupper, words)) / n,
        float(codes[_SYMBOLS].sum()) / chars,
        float(codes[48:58].sum()) / chars,
        float(codes[124]) / n,
        sum(map(str.__eq__, words, words[1:])) / n,
        len(set(words)) / n ** 0.9,
        mean / 10,
        abs(mean - 6) / 6,
        1 - len(set(lines)) / len(lines),
        sum(w == "|" for w in words) / n,
        float(codes[33]) / n,
        1 / (1 + n / 10),
        float(codes[44] + codes[46]) / n,
    ]


@dataclass(frozen=True)
class Model:
    """Weights on standardised features, and what maps raw scores to 0..1."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float
    spread: float

    def raw(self, rows: np.ndarray) -> np.ndarray:
        return np.clip((rows - self.mean) / self.scale, -8, 8) @ self.weights

    def scores(self, rows: np.ndarray) -> np.ndarray:
        shift = np.log(CUT_SCORE / (1 - CUT_SCORE))
        return 1 / (1 + np.exp(-np.clip((self.raw(rows) - self.cut) / self.spread + shift, -30, 30)))


def pairs(good: np.ndarray, bad: np.ndarray, block: int = 0) -> np.ndarray:
    """Differences of seeded pairs of a good and a bad row; each row is in ``PAIRS_PER_ROW`` pairs or, on the shorter side, more."""
    seeded = np.random.default_rng([7, block])
    n = PAIRS_PER_ROW * max(len(good), len(bad))

    def dealt(rows: np.ndarray) -> np.ndarray:
        return rows[np.concatenate([seeded.permutation(len(rows)) for _ in range(-(-n // len(rows)))])[:n]]

    return dealt(good) - dealt(bad)


def _packed(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
    """The rows of a block in an order of their own, as one row with a matrix for each label."""
    told = np.array(group.column("features").to_pylist()).reshape(-1, len(FEATURES))
    quality = group.column("quality").to_numpy()
    order = np.lexsort([*told.T, group.column("doc_id").to_numpy()])
    return pa.table({"block": pa.array([key[0].as_py()], pa.int64())} | {
        name: pa.array([told[order][quality[order] == side].tobytes()], pa.binary()) for name, side in (("good", 1), ("bad", 0))
    })


def _sums(batches, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray):
    """Of the pairs of some blocks: their number, and the sums that a Newton step needs."""
    width = len(FEATURES)
    total = np.zeros(1 + width + width * width)
    for batch in batches:
        for row in batch.to_pylist():
            sides = (np.frombuffer(row[name]).reshape(-1, width) for name in ("good", "bad"))
            good, bad = (np.clip((x - mean) / scale, -8, 8) for x in sides)
            if not len(good) or not len(bad):
                continue
            gap = pairs(good, bad, row["block"])
            miss = 1 / (1 + np.exp(np.clip(gap @ weights, -30, 30)))
            curve = (gap * (miss * (1 - miss))[:, None]).T @ gap
            total += np.concatenate([[len(gap)], gap.T @ miss, curve.ravel()])
    yield pa.RecordBatch.from_pydict({"sums": pa.array([total.tolist()], pa.list_(pa.float64()))})


def _moments(batches, center: np.ndarray):
    """Numbers of good and of bad rows, and sums of the features from ``center`` on and of their squares."""
    total = np.zeros(2 + 2 * len(FEATURES))
    for batch in batches:
        off = np.array(batch.column("features").to_pylist()).reshape(-1, len(FEATURES)) - center
        good = int(batch.column("quality").to_numpy().sum())
        total += np.concatenate([[good, len(off) - good], off.sum(0), (off * off).sum(0)])
    yield pa.RecordBatch.from_pydict({"sums": pa.array([total.tolist()], pa.list_(pa.float64()))})


def _codes(batches, model: Model):
    """Raw scores as whole numbers of the same order."""
    for batch in batches:
        raw = model.raw(np.array(batch.column("features").to_pylist()).reshape(-1, len(FEATURES))) + 0.0
        yield pa.RecordBatch.from_arrays([batch.column("quality"), pa.array(_ordered(raw.view(np.int64)))], ["quality", "code"])


def _ordered(bits: np.ndarray) -> np.ndarray:
    """Bits of doubles as numbers of their order, and back."""
    return np.where(bits < 0, bits ^ np.int64(2 ** 63 - 1), bits)


def _at_places(coded: DataFrame, places: list[tuple[tuple[int, ...], int]]) -> list[float]:
    """The score at each place, from 0, among the sorted scores of some labels.

    Sixteen bits of the codes are counted at a time, and after the first only where the bits before
    are those of a place that is looked for; only counts reach the driver.
    """
    found: list[tuple[int | None, int]] = [(None, place) for _, place in places]
    for shift in (48, 32, 16, 0):
        known = sorted({prefix for prefix, _ in found if prefix is not None})
        rows = coded.where(F.shiftright("code", shift + 16).isin(known)) if known else coded
        counts = sorted(
            (r["bits"], r["quality"], r["count"])
            for r in rows.groupBy(F.shiftright("code", shift).alias("bits"), "quality").count().collect()
        )
        for i, (sides, _) in enumerate(places):
            prefix, left = found[i]
            for bits, quality, n in counts:
                if quality in sides and (prefix is None or bits >> 16 == prefix):
                    if left < n:
                        found[i] = (bits, left)
                        break
                    left -= n
    return _ordered(np.array([code for code, _ in found], np.int64)).view(np.float64).tolist()


def fit(examples: DataFrame, rounds: int = 30, ridge: float = 1e-3) -> Model:
    """Bradley-Terry weights by Newton steps on seeded pairs of a good and a bad row of ``doc_id, quality, features``.

    Pairs are made in blocks of rows of both labels, which tasks hold one at a time; a step sends sums to the
    driver. A row of the more frequent label is in one block, others are in as many as it takes to have
    some in each. Without rows of one of the labels nothing can be preferred: all rows then
    get one score, above the threshold.
    """
    width = len(FEATURES)

    def summed(rows: DataFrame, sums, **known) -> np.ndarray:
        """Sums of all tasks, added in one order."""
        return np.sum([r["sums"] for r in rows.mapInArrow(partial(sums, **known), "sums array<double>").collect()], axis=0)

    above, below, *total = summed(examples, _moments, center=np.zeros(width)).tolist() if not examples.isEmpty() else (0, 0)
    if not above or not below:
        return Model(np.zeros(width), np.ones(width), np.zeros(width), -1.0, 1.0)
    above, below = int(above), int(below)
    mean = np.array(total[:width]) / (above + below)
    scale = np.maximum(np.sqrt(summed(examples, _moments, center=mean)[2 + width:] / (above + below)), 1e-6)
    blocks = -(-max(above, below) // ROWS_PER_BLOCK)
    copies = min(blocks, -(-LEAST_PER_BLOCK * blocks // min(above, below)))
    times = F.when(F.col("quality") == int(above >= below), 1).otherwise(copies)
    first = F.pmod(F.xxhash64("doc_id", "features"), F.lit(blocks))
    dealt = examples.withColumn("step", F.explode(F.sequence(F.lit(0), times - 1))).withColumn(
        "block", F.pmod(first + F.col("step"), F.lit(blocks)))
    packed = staged(dealt.groupBy("block").applyInArrow(_packed, "block long, good binary, bad binary"), "blocks")
    weights = np.zeros(width)
    for _ in range(rounds):
        total = summed(packed, _sums, mean=mean, scale=scale, weights=weights)
        slope = total[1:1 + width] / total[0] - ridge * weights
        curve = total[1 + width:].reshape(width, width) / total[0] + ridge * np.eye(width)
        step = np.linalg.solve(curve, slope)
        weights = weights + step * min(1.0, 5 / max(np.linalg.norm(step), 1e-9))
        if np.linalg.norm(step) < 1e-11:
            break
    model = Model(mean, scale, weights, 0.0, 1.0)
    coded = staged(examples.mapInArrow(partial(_codes, model=model), "quality int, code long"), "codes")
    both = (0, 1)
    at = _at_places(coded, [
        (both, below - 1), (both, below),
        *[((side,), place) for side, n in ((1, above), (0, below)) for place in ((n - 1) // 2, n // 2)],
    ])
    cut, high, low = (float(np.mean(at[i:i + 2])) for i in (0, 2, 4))
    dropped(packed, coded)
    return replace(model, cut=cut, spread=max((high - low) / 10, 1e-6))


def _columns(batches, extra: list[str], model: Model | None = None) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = np.array([features(t) for t in batch.column("text").to_pylist()]).reshape(-1, len(FEATURES))
        told = pa.array(list(rows), pa.list_(pa.float64())) if model is None else pa.array(model.scores(rows))
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in extra), told], [*extra, "features" if model is None else "score"]
        )


def train(docs: DataFrame, labels: DataFrame, learn: Column) -> Model:
    """A model from all rows of ``labels`` that ``learn`` (on ``doc_id``) allows.

    Rows without an id, a text or a label of 0 or 1 are no examples. Of an id labelled more than
    once every label counts, of an id with several texts every text; examples that are the same count once.
    """
    usable = staged(labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & learn).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")
    ).distinct(), "labels")
    texts = docs.where("text is not null and doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # Texts are read where they lie, and their features are moved.
    told = likely(texts, usable, ["doc_id"]).mapInArrow(
        partial(_columns, extra=["doc_id"]), "doc_id long, features array<double>")
    found = told.join(usable, "doc_id").select("doc_id", "quality", "features").distinct()
    # In an order, so that sums are the same in every run.
    examples = staged(found.sortWithinPartitions("doc_id", "quality", "features"), "examples")
    model = fit(examples)
    dropped(usable, examples)
    return model


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` of every row of ``docs``, empty and null texts included."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(partial(_columns, extra=["doc_id"], model=model), "doc_id long, score double")


def _kept(batches, model: Model, at: int):
    for batch in batches:
        rows = np.array([features(t) for t in batch.column(at).to_pylist()]).reshape(-1, len(FEATURES))
        yield batch.filter(pa.array(model.scores(rows) >= CUT_SCORE))


def good_rows(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` at or above the threshold, with all their columns."""
    at = docs.columns.index("text")
    return docs.mapInArrow(partial(_kept, model=model, at=at), docs.schema)
