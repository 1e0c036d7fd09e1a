"""Toxicity by two Kneser-Ney models, one of toxic and one of ordinary text.

Both models have levels, each discounted and interpolated with the next: a word
after a word, a word, and the first six and four letters of a word. All levels count
continuations, that is, in how many different contexts something follows, so that
words of a text that was copied many times count once. The last level, into which
both models fall back for rare expressions, is shared: over all texts of the
corpus, after how many different words a word occurs, for every word there is. So are the weights
of falling back, which come from both classes together, so a word that no level
knows is as likely in both. No count is left out; discounts and shared counts damp
rare ones.

A text scores by its passage of six consecutive words with the greatest difference
of toxic and ordinary log-likelihood per word, so the length of a text does not
dilute it. Every position is read after the word that stands before it; a word
repeated within a passage counts once there, and the mean is over the words that
count, however few. A logistic curve maps that, and how many words the passage is
short of six, to 0..1. It is fitted on the training
rows, each half of them scored by a model of the other half, as rare words of a
text tell its own class by heart.

The class counts come from at most ``per_label`` labelled rows of either class,
those with the smallest hash of their id. Their words are numbered once; one aggregation
counts, per pair of words, the contexts in each class and in each half of the rows, and the
models of all rows and of either half follow from these arrays on the driver. The shared
counts come from all rows: a task gives each of its pairs once, packed by hash of the
word, and the packed pairs are merged without being unpacked to rows. All rows are scored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, replace
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import staged
from lodestone.plans.checkpoint import dropped

PER_LABEL = 4000
PREFIXES = (6, 4)
PASSAGE = 6
DISCOUNT = 0.75
UNSEEN = 8  # contexts that weigh as much as what the levels below say
# Of distribution alone: pairs a task holds, rows of a batch, and from how many pairs in the sample a word is dealt out.
HELD_PAIRS = 8_000_000
HOT_PAIRS = 1000
SPREAD = 16
# Words before a word are told apart by 32 bits of their hashes; counts allow for those that fall together.
BEFORE = 1 << 32
# Words that are scored at a time, and different ones a reader remembers.
BLOCK_WORDS = 300_000
REMEMBERED = 2_000_000
_WORD = re.compile(r"\w+")
_START = "^"


def words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def _distinct_words(batches):
    found = {w for batch in batches for text in batch.column("text") for w in words(text.as_py())}
    if found:
        yield pa.RecordBatch.from_pydict({"w": sorted(found)})


def _trigrams(batches, number: dict[str, int], bound: int):
    """``pair, u, mask``: each word before a pair of words once per task, with a bit per class and half."""
    start, parts, held = len(number), [], 0

    def rows():
        pair, u, mask = (np.concatenate(c) for c in zip(*parts, strict=True))
        order = np.lexsort((u, pair))
        pair, u, mask = pair[order], u[order], mask[order]
        first = np.flatnonzero(np.concatenate([[True], (pair[1:] != pair[:-1]) | (u[1:] != u[:-1])]))
        return pair[first], u[first], np.bitwise_or.reduceat(mask, first)

    for batch in batches:
        for label, half, text in zip(*(batch.column(c).to_pylist() for c in ("toxic", "half", "text")), strict=True):
            found = words(text)
            if not found:
                continue
            at = np.fromiter(map(number.__getitem__, found), np.int64, len(found))
            before = np.concatenate([[start, start], at])
            parts.append((pair_key(before[1:-1], at, start), before[:-2], np.full(len(at), 1 << (2 * label + half))))
            held += len(at)
            if held > bound:
                parts = [rows()]
                held = len(parts[0][0])
                if held > bound // 2:
                    yield _trigram_batch(*parts[0])
                    parts, held = [], 0
    if parts:
        yield _trigram_batch(*rows())


def _trigram_batch(pair, u, mask):
    return pa.RecordBatch.from_arrays([pa.array(pair), pa.array(u, pa.int32()), pa.array(mask, pa.int32())], ["pair", "u", "mask"])


def pair_key(before, word, count: int):
    """One number for a word after a word; the start of a text has the number ``count``."""
    return before * (count + 1) + word


def best_window(ratios: np.ndarray, at: np.ndarray) -> tuple[float, int]:
    """The greatest mean of ``ratios`` over PASSAGE consecutive positions, and of how many words it is.

    A word ``at`` several positions of a window counts once there, with its greatest ratio.
    """
    size = min(len(at), PASSAGE)
    total = np.concatenate([[0.0], np.cumsum(ratios)])
    sums = total[size:] - total[:-size]
    different = np.full(len(sums), size)
    marks = np.zeros(len(sums) + 1, np.int64)
    for gap in range(1, size):
        first = np.flatnonzero(at[gap:] == at[:-gap])
        np.add.at(marks, np.maximum(first + gap - size + 1, 0), 1)
        np.add.at(marks, np.minimum(first, len(sums) - 1) + 1, -1)
    again = np.flatnonzero(np.cumsum(marks[:-1]))
    if len(again):
        places = again[:, None] + np.arange(size)
        of, value = at[places], ratios[places]
        kept = np.ones(of.shape, bool)
        for i in range(size):
            for j in range(i + 1, size):
                same, low = of[:, i] == of[:, j], value[:, i] < value[:, j]
                kept[:, i] &= ~(same & low)
                kept[:, j] &= ~(same & ~low)
        sums[again] = (value * kept).sum(axis=1)
        different[again] = kept.sum(axis=1)
    means = sums / different
    best = int(np.argmax(means))
    return float(means[best]), int(different[best])


def windows(ratios: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The mean of each window of PASSAGE positions, and of how many different words; see ``best_window``."""
    n = len(at) - PASSAGE + 1
    sums, different = sum(ratios[i:i + n] for i in range(PASSAGE)), np.full(n, PASSAGE)
    marks = np.zeros(n + 1, np.int64)
    for gap in range(1, PASSAGE):
        first = np.flatnonzero(at[gap:] == at[:-gap])
        marks += np.bincount(np.minimum(np.maximum(first + gap - PASSAGE + 1, 0), n), minlength=n + 1)
        marks -= np.bincount(np.minimum(first, n - 1) + 1, minlength=n + 1)
    again = np.flatnonzero(np.cumsum(marks[:-1]))
    if len(again):
        of, value = ([x[again + i] for i in range(PASSAGE)] for x in (at, ratios))
        kept = [np.ones(len(again), bool) for _ in range(PASSAGE)]
        for i in range(PASSAGE):
            for j in range(i + 1, PASSAGE):
                same, low = of[i] == of[j], value[i] < value[j]
                kept[i] &= ~(same & low)
                kept[j] &= ~same | low
        sums[again] = sum(v * k for v, k in zip(value, kept, strict=True))
        different[again] = sum(k.astype(np.int64) for k in kept)
    return sums / different, different


@dataclass(frozen=True)
class Model:
    """Log ratios of the levels, and the logistic curve."""

    word: dict          # word -> its number
    single: np.ndarray  # by number: log ratio
    prefix: tuple       # per length: beginning -> log ratio
    pairs: np.ndarray   # numbers of a word before and a word, as one sorted key
    after: np.ndarray   # by place in pairs: log ratio
    slope: float = 1.0
    shift: float = 0.0
    short: float = 0.0

    def passage(self, text: str | None) -> float:
        """The greatest mean log ratio over consecutive words; 0 without words."""
        return self.read(text)[0]

    def read(self, text: str | None) -> tuple[float, float]:
        """That mean, and which share of a passage its words are short of."""
        found = words(text)
        if not found:
            return 0.0, 1.0
        mean, size = best_window(*self.ratios(found))
        return mean, 1 - size / PASSAGE

    def ratios(self, found: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The log ratio at every position, after the word that stands before it, and which word it is."""
        own = {w: i for i, w in enumerate(dict.fromkeys(found))}
        number = np.array([self.word.get(w, -1) for w in own], np.int64)
        alone = np.array([self.single[n] if n >= 0 else self.beginning(w) for w, n in zip(own, number, strict=True)])
        at = np.fromiter(map(own.__getitem__, found), np.int64, len(found))
        ratios = alone[at]
        if len(self.pairs):
            here = number[at]
            before = np.concatenate([[len(self.word)], here[:-1]])
            key = np.where((here >= 0) & (before >= 0), pair_key(before, here, len(self.word)), -1)
            place = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
            ratios = np.where(self.pairs[place] == key, self.after[place], ratios)
        return ratios, at

    def beginning(self, w: str) -> float:
        for length, ratios in zip(PREFIXES, self.prefix, strict=False):
            if w[:length] in ratios:
                return ratios[w[:length]]
        return 0.0

    def scores(self, passages: np.ndarray, missing: np.ndarray | float = 0.0) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * passages + self.short * missing + self.shift, -30, 30)))


def nothing(shift: float) -> Model:
    """A model that knows no word."""
    return Model({}, np.zeros(0), (), np.zeros(0, np.int64), np.zeros(0), 0.0, shift)


class Reader(dict):
    """Reads texts in blocks by one model; the numbers of words it has met stay with it."""

    def __init__(self, model: Model):
        super().__init__()
        self.model, self.number, self.alone = model, [], []

    def __missing__(self, word: str) -> int:
        n = self.model.word.get(word, -1)
        self.number.append(n)
        self.alone.append(float(self.model.single[n]) if n >= 0 else self.model.beginning(word))
        found = self[word] = len(self.alone) - 1
        return found

    def read(self, texts: list[str | None]) -> np.ndarray:
        """A row per text, as ``Model.read`` gives it."""
        out = np.tile([-np.inf, 1.0], (len(texts), 1))
        parts: list[tuple[int, np.ndarray, bool]] = []
        held = 0
        for doc, text in enumerate(texts):
            found = words(text)
            at = np.fromiter(map(self.__getitem__, found), np.int64, len(found))
            if not len(at):
                out[doc, 0] = 0.0
            # A text longer than a block goes on with the six words before: windows reach back five, pairs one more.
            for start in range(0, len(at), BLOCK_WORDS):
                parts.append((doc, at[max(start - PASSAGE, 0):start + BLOCK_WORDS], start == 0))
                held += len(parts[-1][1])
                if held >= BLOCK_WORDS:
                    self._block(parts, out)
                    parts, held = [], 0
        if parts:
            self._block(parts, out)
        if len(self) > REMEMBERED:
            self.clear()
            self.number, self.alone = [], []
        return out

    def _block(self, parts: list[tuple[int, np.ndarray, bool]], out: np.ndarray) -> None:
        sizes = np.array([len(at) for _, at, _ in parts])
        starts = np.cumsum(sizes) - sizes
        at = np.concatenate([p[1] for p in parts])
        ratios = self._ratios(at, starts[[p[2] for p in parts]])
        long = sizes >= PASSAGE
        for n in np.flatnonzero(~long).tolist():
            some = slice(starts[n], starts[n] + sizes[n])
            if parts[n][2]:
                self._better(out, parts[n][0], *best_window(ratios[some], at[some]))
        if long.any():
            means, different = windows(ratios, at)
            # Windows lie in one part; a part that goes on has no word before its first.
            whole = np.repeat(starts + sizes, sizes)[:len(means)] >= np.arange(len(means)) + PASSAGE
            whole[starts[long & ~np.array([p[2] for p in parts])]] = False
            means = np.where(whole, means, -np.inf)
            best = np.maximum.reduceat(means, starts[long])
            group = np.searchsorted(starts[long], np.arange(len(means)), side="right") - 1
            tops = np.flatnonzero(whole & (group >= 0) & (means == best[np.maximum(group, 0)]))
            which, first = np.unique(group[tops], return_index=True)
            docs = [p[0] for p, is_long in zip(parts, long, strict=True) if is_long]
            for n, place in zip(which.tolist(), tops[first].tolist(), strict=True):
                self._better(out, docs[n], float(means[place]), int(different[place]))

    @staticmethod
    def _better(out: np.ndarray, doc: int, mean: float, size: int) -> None:
        if mean > out[doc, 0]:
            out[doc] = mean, 1 - size / PASSAGE

    def _ratios(self, at: np.ndarray, firsts: np.ndarray) -> np.ndarray:
        model = self.model
        ratios, here = np.array(self.alone)[at], np.array(self.number, np.int64)[at]
        if len(model.pairs):
            before = np.concatenate([[-1], here[:-1]])
            before[firsts] = len(model.word)
            some = np.flatnonzero((here >= 0) & (before >= 0))
            key, back = np.unique(pair_key(before[some], here[some], len(model.word)), return_inverse=True)
            place = np.minimum(np.searchsorted(model.pairs, key), len(model.pairs) - 1)
            known = (model.pairs[place] == key)[back]
            ratios[some[known]] = model.after[place][back[known]]
        return ratios


class _Numbers(dict):
    """A number for each word, in the order in which they come."""

    def __missing__(self, word: str) -> int:
        found = self[word] = len(self)
        return found


def _code(found) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))


@dataclass(frozen=True)
class Vocabulary:
    """The words of the sample with their numbers, and the beginnings they have: the longer ones' numbers come first."""

    names: list
    number: dict
    long: dict   # beginning of the longer length -> its number
    short: dict  # of the shorter length -> its number

    @staticmethod
    def of(names: list[str]) -> Vocabulary:
        size, least = PREFIXES
        long = {p: i for i, p in enumerate(sorted({w[:size] for w in names}))}
        return Vocabulary(names, {w: i for i, w in enumerate(names)}, long, {p: len(long) + i for i, p in enumerate(sorted({w[:least] for w in names}))})

    def begin(self, word: str) -> int:
        """The number of the longest beginning of ``word`` that is known, or -1."""
        size, least = PREFIXES
        found = self.long.get(word[:size])
        return self.short.get(word[:least], -1) if found is None else found


def _followers(batches, known: Vocabulary, hot: frozenset, buckets: int, bound: int):
    """Per bucket of words of this task the different words before each, packed."""
    number, keys, held = _Numbers(), [], 0
    for batch in batches:
        for value in batch.column("text"):
            found = [_START, *words(value.as_py())]
            at = np.fromiter(map(number.__getitem__, found), np.int64, len(found))
            keys.append(at[:-1] << 32 | at[1:])
            held += len(at)
            if held > bound:
                keys = [np.unique(np.concatenate(keys))]
                held = len(keys[0])
                if held > bound // 2:
                    yield from _packed(number, keys[0], known, hot, buckets)
                    number, keys, held = _Numbers(), [], 0
    if keys:
        yield from _packed(number, np.unique(np.concatenate(keys)), known, hot, buckets)


def _packed(number: dict, keys: np.ndarray, known: Vocabulary, hot: frozenset, buckets: int):
    """One row per bucket; of a hot word, which follows very many, the words before it are dealt to several buckets."""
    if not len(keys):
        return
    code = _code(number)
    begin = np.fromiter(map(known.begin, number), np.int32, len(number))
    spread = np.fromiter((SPREAD if w in hot else 1 for w in number), np.uint64, len(number))
    word, other = keys & 0xFFFFFFFF, code[keys >> 32]
    before = other.astype(np.uint32)
    bucket = ((code[word] >> np.uint64(8)) + (other >> np.uint64(40)) % spread[word]) % np.uint64(buckets)
    order = np.lexsort((before, word, bucket))
    word, before, bucket = word[order], before[order], bucket[order]
    edges = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])).tolist() + [len(word)]
    for at, stop in zip(edges, edges[1:]):
        own = word[at:stop]
        first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        some = own[first]
        data = b"".join([
            np.uint32(len(some)).tobytes(), code[some].tobytes(), begin[some].tobytes(),
            np.diff(np.append(first, len(own))).astype(np.uint32).tobytes(),
            before[at:stop].tobytes(),
        ])
        yield pa.RecordBatch.from_arrays([pa.array([int(bucket[at])], pa.int64()), pa.array([data], pa.binary())], ["bucket", "data"])


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The word, its beginning and the word before it of every pair."""
    n = int(np.frombuffer(data, np.uint32, 1)[0])
    code = np.frombuffer(data, np.uint64, n, 4)
    begin = np.frombuffer(data, np.int32, n, 4 + 8 * n)
    sizes = np.frombuffer(data, np.uint32, n, 4 + 12 * n)
    return np.repeat(code, sizes), np.repeat(begin, sizes), np.frombuffer(data, np.uint32, offset=4 + 16 * n)


def _once(parts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    code, begin, before = (np.concatenate(c) for c in zip(*parts, strict=True))
    order = np.lexsort((before, code))
    code, begin, before = code[order], begin[order], before[order]
    first = np.concatenate([[True], (code[1:] != code[:-1]) | (before[1:] != before[:-1])])
    return code[first], begin[first], before[first]


def _counted(batches, bound: int):
    """``w, begin, n`` from packed rows in order of their buckets: after how many different words a word occurs."""
    last, parts, held, limit = None, [], 0, 2 * bound

    def counts():
        code, begin, _ = _once(parts)
        first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
        told = np.minimum(np.diff(np.append(first, len(code))) / BEFORE, 1 - 1 / BEFORE)
        n = np.rint(-BEFORE * np.log1p(-told)).astype(np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(code[first].view(np.int64)), pa.array(begin[first]), pa.array(n)], ["w", "begin", "n"]
        )

    for batch in batches:
        for bucket, data in zip(batch.column("bucket").to_pylist(), batch.column("data"), strict=True):
            if bucket != last and parts:
                yield counts()
                parts, held, limit = [], 0, 2 * bound
            last = bucket
            parts.append(_unpacked(data.as_py()))
            held += len(parts[-1][0])
            if held > limit:
                parts = [_once(parts)]
                # What is left are different pairs; the next look comes when they have doubled.
                held = len(parts[0][0])
                limit = max(limit, 2 * held)
    if parts:
        yield counts()


def shared_counts(
    docs: DataFrame, known: Vocabulary, hot: frozenset = frozenset(), buckets: int | None = None, bound: int = HELD_PAIRS
) -> DataFrame:
    """``w, begin, n``: after how many different words each word of ``docs`` occurs, as a stored table.

    Words go by 64-bit hashes, ``begin`` is the longest beginning of the sample they have. The
    counts of a hot word come in several rows. There are four buckets to a shuffle partition.
    """
    texts = docs.where("text is not null").select("text")
    # As many partitions as the session is set up for its data with.
    buckets = buckets or max(256, 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = texts.mapInArrow(
        partial(_followers, known=known, hot=hot, buckets=buckets, bound=bound), "bucket long, data binary"
    )
    merged = rows.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(
        partial(_counted, bound=bound), "w long, begin int, n long"
    )
    return staged(merged, "shared")


@dataclass(frozen=True)
class Shared:
    """Shared counts of the sample's words and beginnings, by number, and of all words together."""

    words: np.ndarray
    begins: np.ndarray
    total: float


def of_sample(shared: DataFrame, known: Vocabulary) -> Shared:
    """What the sample needs of ``shared_counts``: a row per word and beginning of the sample."""
    counts = np.zeros(len(known.names))
    code = _code(known.names).view(np.int64)
    order = np.argsort(code)
    asked = shared.sparkSession.createDataFrame(pa.table({"w": code}))
    w, n = _columns(shared.join(asked, "w").groupBy("w").agg(F.sum("n").alias("n")))
    counts[order[np.searchsorted(code[order], w)]] = n
    begins = np.zeros(len(known.long) + len(known.short))
    at, n = _columns(shared.where("begin >= 0").groupBy("begin").agg(F.sum("n").alias("n")))
    begins[at.astype(np.int64)] = n
    # Words are counted under the longest beginning; a shorter one has those of its longer ones too.
    for p, i in known.long.items():
        begins[known.short[p[:PREFIXES[1]]]] += begins[i]
    return Shared(counts, begins, float(shared.agg(F.sum("n")).first()[0] or 1))


def _smoothed(t, o, low, totals=None) -> np.ndarray:
    """Both classes' probabilities of counts ``t, o``: discounted shares of each class over
    ``low``, with one weight of falling back for both, by all contexts seen.

    A share is of the sum of discounted counts, or of ``totals`` for each class.
    """
    out = np.empty((2, len(t)))
    kept = (t + o) / (t + o + UNSEEN)
    for c, n in enumerate((t, o)):
        rest = np.maximum(n - DISCOUNT, 0)
        total = np.full(len(n), rest.sum()) if totals is None else totals[c]
        out[c] = kept * np.where(total > 0, rest / np.where(total > 0, total, 1), low[c]) + (1 - kept) * low[c]
    return out


def _columns(rows: DataFrame) -> list[np.ndarray]:
    return [c.to_numpy() for c in rows.toArrow().columns]


def _different(key: np.ndarray, group: np.ndarray, size: int) -> np.ndarray:
    """How many different keys each group has."""
    return np.bincount(np.unique(group.astype(np.int64) << 32 | key) >> 32, minlength=size).astype(float)


def fit(known: Vocabulary, v: np.ndarray, w: np.ndarray, t: np.ndarray, o: np.ndarray, shared: Shared) -> Model:
    """A model from pairs ``v, w`` of numbered words and in how many contexts of either class each occurs.

    The number of the start of a text is the number of words.
    """
    seen = t + o > 0
    v, w, t, o = v[seen], w[seen], t[seen], o[seen]
    names, n_words = known.names, len(known.names)
    size, least = PREFIXES
    long = np.fromiter((known.long[x[:size]] for x in names), np.int64, n_words)
    short = np.fromiter((known.short[x[:least]] for x in names), np.int64, n_words) - len(known.long)
    short_of_long = np.fromiter((known.short[p[:least]] for p in known.long), np.int64, len(known.long)) - len(known.long)
    levels = [
        (short, None, shared.begins[len(known.long):]), (long, short_of_long, shared.begins[:len(known.long)]),
        (np.arange(n_words), long, shared.words),
    ]
    low = count = None
    ratios, there = [], []
    for of_word, above, n in levels:
        group = of_word[w]
        own = [_different(v[c > 0], group[c > 0], len(n)) for c in (t, o)]
        base = np.tile(n / shared.total, (2, 1)) if above is None else low[:, above] * (n / np.maximum(count[above], 1e-300))
        low, count = _smoothed(*own, base), n
        with np.errstate(divide="ignore", invalid="ignore"):
            ratios.append(_log(low))
        there.append(own[0] + own[1] > 0)
    prefix = tuple(
        {p: float(ratios[level][i - first]) for p, i in begins.items() if there[level][i - first]}
        for level, begins, first in ((1, known.long, 0), (0, known.short, len(known.long)))
    )
    # A word of the sample that these rows do not hold is told by its beginning, as any other.
    begun = np.where(there[1][long], ratios[1][long], np.where(there[0][short], ratios[0][short], 0.0))
    single = np.where(there[2], ratios[2], begun)
    both = (v < n_words) & there[2][np.minimum(v, n_words - 1)] | (v == n_words)
    v, w, t, o = v[both], w[both], t[both], o[both]
    keys, after = pair_key(v.astype(np.int64), w, n_words), _after(v, w, t, o, low)
    if (keys[1:] < keys[:-1]).any():
        order = np.argsort(keys)
        keys, after = keys[order], after[order]
    return Model(known.number, single, prefix, keys, after)


def _after(v: np.ndarray, w: np.ndarray, t: np.ndarray, o: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Log ratios of words after a word. Each falls back to its share in both classes, parted as the word is.

    Sums per word before come first, so that the pairs go through in blocks.
    """
    out = np.empty(len(v), np.float32)
    if not len(v):
        return out
    size = int(v.max()) + 1
    totals = [np.bincount(v, np.maximum(n - DISCOUNT, 0), size) for n in (t, o)]
    everything = np.bincount(v, t + o, size)
    for at in range(0, len(v), BLOCK_WORDS):
        some = slice(at, at + BLOCK_WORDS)
        group, share = v[some], (t[some] + o[some]) / everything[v[some]]
        base = share * low[:, w[some]] / low[:, w[some]].mean(axis=0)
        out[some] = _log(_smoothed(t[some], o[some], base, [total[group] for total in totals]))
    return out


def _log(both: np.ndarray) -> np.ndarray:
    return np.log(both[0] / both[1])


def _curve(x: np.ndarray, missing: np.ndarray, toxic: np.ndarray, weights: np.ndarray) -> tuple[float, float, float]:
    """Slope, shift and weight of ``missing`` of a weighted logistic fit with a small ridge on the slopes."""
    a = np.array([1.0, 0.0, 0.0])
    rows = np.stack([x, np.ones(len(x)), missing], axis=1)
    ridge = np.array([1e-4, 1e-7, 1e-4])
    weights = weights / weights.sum()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(rows @ a, -30, 30)))
        slope = rows.T @ (weights * (toxic - p)) - ridge * a
        curve = (rows * (weights * p * (1 - p))[:, None]).T @ rows + np.diag(ridge)
        step = np.linalg.solve(curve, slope)
        a += step * min(1.0, 4 / max(np.abs(step).max(), 1e-9))
    return tuple(map(float, a))


@dataclass(frozen=True)
class Contexts:
    """Pairs of words ``v, w`` by number, and for each set of classes and halves in how many contexts they occur in it."""

    v: np.ndarray
    w: np.ndarray
    of: np.ndarray    # by row: the place of its pair
    mask: np.ndarray  # by row: a bit per class and half
    n: np.ndarray

    def counts(self, half: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Contexts of every pair in toxic and in ordinary rows, of all rows or of one half."""
        each = 3 if half is None else 1 << half
        return tuple(
            np.bincount(self.of, self.n * (self.mask & bits > 0), len(self.v)).astype(np.float32) for bits in (each << 2, each)
        )


def pair_counts(sample: DataFrame, known: Vocabulary, bound: int = HELD_PAIRS) -> Contexts:
    """``Contexts`` of the words of ``sample``, rows of ``toxic, half, text``.

    One shuffle of each task's different contexts; what reaches the driver is little more
    than a row per pair of the sample.
    """
    rows = sample.mapInArrow(partial(_trigrams, number=known.number, bound=bound), "pair long, u int, mask int")
    contexts = rows.repartition("pair").groupBy("pair", "u").agg(F.bit_or("mask").alias("mask"))
    pair, mask, n = _columns(contexts.groupBy("pair", "mask").agg(F.count("*").cast("int").alias("n")).select(
        "pair", F.col("mask").cast("tinyint").alias("mask"), "n"
    ))
    pair, of = np.unique(pair, return_inverse=True)
    step = len(known.names) + 1
    return Contexts((pair // step).astype(np.int32), (pair % step).astype(np.int32), of.astype(np.int32), mask, n)


def _passages(batches, model: Model, extra: list[str]):
    reader = Reader(model)
    for batch in batches:
        found = reader.read(batch.column("text").to_pylist())
        columns = [model.scores(*found.T)] if extra == ["doc_id"] else list(found.T.copy())
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in extra), *map(pa.array, columns)], [*extra, "score", "missing"][:len(extra) + len(columns)]
        )


def train(docs: DataFrame, labels: DataFrame, learn: Column, per_label: int = PER_LABEL) -> Model:
    """A model from the rows of ``labels`` that ``learn`` (on ``doc_id``) allows.

    Rows without an id, a text or a label of 0 or 1 are no examples. With
    examples of one class alone, no text is called toxic.
    """
    usable = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & learn).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")
    )
    counts = {r["toxic"]: r["count"] for r in usable.groupBy("toxic").count().collect()}
    if len(counts) < 2:
        return nothing(-30.0)
    code = F.xxhash64("doc_id")
    chosen = [
        # About twice the rows asked for pass the hash, so that little is sorted.
        usable.where((F.col("toxic") == label) & (F.shiftrightunsigned(code, 40) < int(2 ** 24 * min(1, 2 * per_label / n)) + 1024))
        .orderBy(code, "doc_id").limit(per_label)
        for label, n in counts.items()
    ]
    texts = docs.where("text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sample = staged(
        texts.join(F.broadcast(reduce(DataFrame.unionByName, chosen)), "doc_id")
        .groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).select("toxic", "text"), "sample"
    )
    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return nothing(-30.0)
    half = F.pmod(F.xxhash64("text"), F.lit(2)).cast("int").alias("half")
    named = sample.select("text").mapInArrow(_distinct_words, "w string").distinct().toArrow()
    known = Vocabulary.of(sorted(named["w"].to_pylist()))
    contexts = pair_counts(sample.select("toxic", "text", half), known)
    hot = np.flatnonzero(np.bincount(contexts.w, minlength=len(known.names)) >= HOT_PAIRS)
    table = shared_counts(docs, known, frozenset(known.names[i] for i in hot))
    shared = of_sample(table, known)
    dropped(table)
    rows = []
    for other in (0, 1):
        part = fit(known, contexts.v, contexts.w, *contexts.counts(1 - other), shared)
        rows += sample.where(half == other).mapInArrow(
            partial(_passages, model=part, extra=["toxic"]), "toxic int, score double, missing double"
        ).collect()
        del part
    model = fit(known, contexts.v, contexts.w, *contexts.counts(), shared)
    dropped(sample)
    toxic = np.array([r["toxic"] for r in rows], float)
    weights = np.array([counts[r["toxic"]] / sizes[r["toxic"]] for r in rows])
    score, missing = (np.array([r[c] for r in rows]) for c in ("score", "missing"))
    slope, shift, short = _curve(score, missing, toxic, weights)
    return replace(model, slope=slope, shift=shift, short=short)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` of every row of ``docs``, null and empty texts included."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(partial(_passages, model=model, extra=["doc_id"]), "doc_id long, score double")
