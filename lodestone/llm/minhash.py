"""Near-dedup by b-bit MinHash, with every link confirmed on full shingle sets.

1. One pass over the texts keeps, per document, the least of 128 hashes of its
   five-word shingles: hashed in bands of four for finding candidates, and the low
   four bits of each packed into eight longs for estimates. Two sets of similarity
   0.75 share no band with a chance of 5e-6.
2. Documents with the same set are one class from here on, numbered by itself, so
   different texts under one id are each judged by their own set.
3. In every band bucket all members are paired with the smallest one. Pairs whose
   estimate, corrected for chance agreement of four bits, is far below the bound
   are left out; the others are confirmed on full sets.
4. In buckets that still hold more than one component, members of different
   components are compared among themselves, in blocks, where the links found so
   far are followed: only links that join two components leave a task, so a bucket
   of thousands of near copies yields as many links as copies.
5. Components of all confirmed links.

No partner or candidate is capped. What a block holds is bounded by its shingles;
a larger bucket is dealt out over pairs of blocks, and joined where its rows lie.
"""

from __future__ import annotations

from functools import cache, partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import connected, staged

HASHES, ROWS, BITS, SHINGLE = 128, 4, 4, 5
BANDS, LONGS = HASHES // ROWS, HASHES * BITS // 64
NEEDED, OF = 75, 100
# Pairs of similarity 0.75 have estimates below this with a chance of 1e-6.
LEAST_ESTIMATE = 0.57
LEAST_EQUAL = int(HASHES * (LEAST_ESTIMATE * (1 - 2.0 ** -BITS) + 2.0 ** -BITS))
BLOCK_SHINGLES = 1 << 18
# A key with more than this share of all rows is joined by broadcast: there are at most so many.
HEAVY = 2000
_ODD = np.uint64(0x9E3779B97F4A7C15)
_LOW = np.uint64(0x1111111111111111)
_CHUNK = 2048
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@cache
def _factors() -> tuple[np.ndarray, np.ndarray]:
    seeded = np.random.default_rng(20)
    return (
        seeded.integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1),
        seeded.integers(0, 1 << 63, HASHES, dtype=np.uint64),
    )


def shingles(text: str | None) -> np.ndarray:
    """The distinct five-word shingles of a text as sorted 64-bit hashes.

    Words end at white space and only A-Z are lower-cased. Fewer than five
    words are one shingle; without words there is none.
    """
    # split() of bytes ends words at the very six white-space characters of the rule.
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    codes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(SHINGLE, len(words))
    joined = np.full(len(words) - width + 1, width, np.uint64)
    for k in range(width):
        joined = _mix(joined * _ODD + codes[k:len(codes) - width + 1 + k])
    return np.unique(joined)


def minima(codes: np.ndarray) -> np.ndarray:
    """The least of each of the hashes over a non-empty set; memory does not grow with the set."""
    factor, offset = _factors()
    least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(codes), _CHUNK):
        part = codes[at:at + _CHUNK]
        table = part[None, :] * factor[:, None]
        table ^= offset[:, None]
        least = np.minimum(least, table.min(axis=1))
    return least


def bands(least: np.ndarray) -> np.ndarray:
    keys = np.arange(BANDS, dtype=np.uint64)
    for k in range(ROWS):
        keys = _mix(keys * _ODD + least.reshape(BANDS, ROWS)[:, k])
    return keys


def packed(least: np.ndarray) -> np.ndarray:
    """The low bits of the minima, sixteen to a long. Minima are small, so they are mixed first."""
    low = (_mix(least) & np.uint64((1 << BITS) - 1)).reshape(LONGS, 64 // BITS)
    shifts = np.arange(64 // BITS, dtype=np.uint64) * np.uint64(BITS)
    return np.bitwise_or.reduce(low << shifts, axis=1)


def equal_count(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many of the packed values agree, along the last axis."""
    x = a ^ b
    x = x | (x >> np.uint64(1))
    x = (x | (x >> np.uint64(2))) & _LOW
    return HASHES - np.bitwise_count(x).sum(axis=-1).astype(np.int64)


def estimate(equal) -> float:
    """Similarity from the share of equal values, without those equal by chance."""
    chance = 2.0 ** -BITS
    return (equal / HASHES - chance) / (1 - chance)


def _lists(rows: list[np.ndarray], width: int) -> pa.Array:
    flat = np.concatenate(rows).view(np.int64) if rows else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(
        pa.array(np.arange(len(rows) + 1) * width, pa.int32()), pa.array(flat)
    )


def _signed(batches):
    """``doc_id, mark, n_shingles, set_a, set_b, bands, bits`` of every row; no set, no bands."""
    nothing = np.zeros(BANDS, np.uint64), np.zeros(LONGS, np.uint64)
    for batch in batches:
        n, digest, keys, bits = [], [], [], []
        for value in batch.column("text"):
            codes = shingles(value.as_py())
            least = minima(codes) if len(codes) else None
            n.append(len(codes))
            digest.append(xxhash.xxh3_128_digest(codes.tobytes()))
            keys.append(nothing[0] if least is None else bands(least))
            bits.append(nothing[1] if least is None else packed(least))
        halves = np.frombuffer(b"".join(digest), np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("mark"), pa.array(n, pa.int64()), pa.array(halves[:, 0].copy()),
             pa.array(halves[:, 1].copy()), _lists(keys, BANDS), _lists(bits, LONGS)],
            ["doc_id", "mark", "n_shingles", "set_a", "set_b", "bands", "bits"],
        )


def _sets(batches):
    for batch in batches:
        found = [shingles(value.as_py()) for value in batch.column("text")]
        at = np.concatenate([[0], np.cumsum([len(x) for x in found])])
        flat = np.concatenate(found).view(np.int64) if found else np.empty(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("node"), pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat))],
            ["node", "codes"],
        )


def _equal(a: str, b: str) -> Column:
    """``equal_count`` as a Column."""
    def fold(x, y):
        z = x.bitwiseXOR(y)
        z = z.bitwiseOR(F.shiftrightunsigned(z, 1))
        return F.bit_count(z.bitwiseOR(F.shiftrightunsigned(z, 2)).bitwiseAND(F.lit(0x1111111111111111)))

    apart = F.aggregate(F.zip_with(a, b, fold), F.lit(0), lambda s, x: s + x)
    return F.lit(HASHES) - apart


class _Sets:
    """Components among the rows of a block, joined as links are found."""

    def __init__(self, labels: np.ndarray):
        _, self.of = np.unique(labels, return_inverse=True)

    def join(self, a: int, others: np.ndarray) -> None:
        self.of[np.isin(self.of, self.of[others])] = self.of[a]


def _links(ids, group, bits, codes, own: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that join components within one block, or, with ``own``, between two blocks."""
    sizes = np.array([len(c) for c in codes])
    starts = np.concatenate([[0], np.cumsum(sizes)])
    _, local = np.unique(np.concatenate(codes), return_inverse=True)
    known = _Sets(group)
    mark = np.zeros(local.max() + 1, bool)
    links = []
    for a in range(len(ids)):
        other = known.of != known.of[a]
        other[:a + 1] = False
        if own is not None:
            other &= own != own[a]
        near = np.flatnonzero(other)
        if not len(near):
            continue
        small, large = np.minimum(sizes[near], sizes[a]), np.maximum(sizes[near], sizes[a])
        near = near[(OF * small >= NEEDED * large) & (equal_count(bits[near], bits[a]) >= LEAST_EQUAL)]
        if not len(near):
            continue
        mark[local[starts[a]:starts[a + 1]]] = True
        where = np.concatenate([local[starts[b]:starts[b + 1]] for b in near])
        shared = np.add.reduceat(mark[where].astype(np.int64), np.concatenate([[0], np.cumsum(sizes[near])[:-1]]))
        mark[local[starts[a]:starts[a + 1]]] = False
        linked = near[OF * shared >= NEEDED * (sizes[near] + sizes[a] - shared)]
        if len(linked):
            _, first = np.unique(known.of[linked], return_index=True)
            links += [(int(ids[a]), int(ids[b])) for b in linked[first]]
            known.join(a, linked)
    return links


def _blocks(batches):
    """Links within every run of rows with the same ``key, low, high``."""
    def flush(rows):
        ids = np.array([r[0] for r in rows])
        order = np.argsort(ids, kind="stable")
        own = np.array([r[4] for r in rows])[order]
        return _links(
            ids[order], np.array([r[1] for r in rows])[order],
            np.stack([rows[i][2] for i in order]), [rows[i][3] for i in order],
            own if len(set(own.tolist())) > 1 else None,
        )

    last, rows, found = None, [], []
    for batch in batches:
        keys = list(zip(*(batch.column(c).to_pylist() for c in ("key", "low", "high")), strict=True))
        ids, groups, own = (batch.column(c).to_pylist() for c in ("node", "component_id", "block"))
        for i, key in enumerate(keys):
            if key != last:
                found += flush(rows) if len(rows) > 1 else []
                last, rows = key, []
            bits = batch.column("bits")[i].values.to_numpy().view(np.uint64)
            codes = batch.column("codes")[i].values.to_numpy().view(np.uint64)
            rows.append((ids[i], groups[i], bits, codes, own[i]))
        if found:
            yield pa.RecordBatch.from_pydict({"a": [x for x, _ in found], "b": [y for _, y in found]})
            found = []
    found = flush(rows) if len(rows) > 1 else []
    if found:
        yield pa.RecordBatch.from_pydict({"a": [x for x, _ in found], "b": [y for _, y in found]})


def _marked(docs: DataFrame) -> DataFrame:
    """Id and text of every row, with a mark that tells texts under one id apart."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark"), "text")


def signed(docs: DataFrame) -> DataFrame:
    """The staged signature of every row of ``docs``."""
    return staged(_marked(docs).mapInArrow(
        _signed, "doc_id long, mark long, n_shingles long, set_a long, set_b long, bands array<long>, bits array<long>"
    ), "minhash")


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose full sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("codes").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("codes").alias("y"))
    shared = F.size(F.array_intersect("x", "y"))
    joined = pairs.join(left, "a").join(right, "b")
    return joined.where(
        OF * shared >= NEEDED * (F.size("x") + F.size("y") - shared)
    ).select("a", "b")


def on_key(rows: DataFrame, keyed: DataFrame, of: int, how: str = "inner") -> DataFrame:
    """``rows`` joined with the staged ``keyed`` (``key, members, ...``) by key.

    ``of`` is the number of all members of all keys. Fewer than ``HEAVY`` keys can hold
    more than their ``HEAVY``-th part each: these are broadcast, and their rows stay spread.
    """
    heavy = F.col("members") * HEAVY > of
    few = F.broadcast(keyed.where(heavy))
    spread = rows.join(few, "key", how)
    rest = rows.join(F.broadcast(keyed.where(heavy).select("key")), "key", "left_anti")
    return spread.unionByName(rest.join(keyed.where(~heavy), "key", how))


def _judged(docs: DataFrame) -> DataFrame:
    """``doc_id, mark, n_shingles, root, found`` of every row; rows of one component share ``root``.

    ``found`` is the smallest id of the component. Both are null without a set or an id.
    """
    rows = signed(docs)
    usable = rows.where("n_shingles > 0 and doc_id is not null")
    # One row per set, found by a partial aggregation, so copies never meet in a task.
    classes = usable.groupBy("set_a", "set_b", "n_shingles").agg(F.min(F.struct("doc_id", "mark")).alias("own"))
    classes = staged(classes.select(
        "set_a", "set_b", "n_shingles", "own.doc_id", "own.mark", F.monotonically_increasing_id().alias("node")
    ), "classes")
    name = ["doc_id", "mark", "set_a", "set_b"]
    reps = usable.join(classes.select(*name, "node"), name).dropDuplicates(name)
    reps = staged(reps.select("node", "n_shingles", "bands", "bits"), "reps")
    buckets = reps.select("node", "n_shingles", F.explode("bands").alias("key"))
    entries = reps.count() * BANDS
    keyed = staged(buckets.groupBy("key").agg(
        F.min("node").alias("pivot"), F.count("*").alias("members"), F.sum("n_shingles").alias("total")
    ).where("members > 1"), "keys")
    shared = staged(on_key(buckets.select("node", "key"), keyed, entries), "buckets")

    wanted = shared.select("node").distinct()
    places = classes.select("doc_id", "mark", "node").join(wanted, "node", "left_semi")
    # Aggregated where the join has put them, so repeated rows multiply nothing.
    texts = _marked(docs).join(places, ["doc_id", "mark"]).groupBy("doc_id", "mark", "node").agg(
        F.min("text").alias("text")
    )
    sets = staged(texts.select("node", "text").mapInArrow(_sets, "node long, codes array<long>"), "sets")
    bits = staged(reps.select("node", "bits").join(wanted, "node"), "bits")

    pairs = shared.where("node <> pivot").select(F.col("node").alias("a"), F.col("pivot").alias("b")).distinct()
    likely = (
        pairs.join(bits.select(F.col("node").alias("a"), F.col("bits").alias("p")), "a")
        .join(bits.select(F.col("node").alias("b"), F.col("bits").alias("q")), "b")
        .where(_equal("p", "q") >= LEAST_EQUAL).select("a", "b")
    )
    first = staged(confirmed(likely, sets), "links")
    links = first.unionByName(staged(_open_links(shared, connected(first), sets, bits, entries), "links"))
    linked = classes.select("node", "doc_id").join(connected(links), "node")
    least = linked.groupBy("component_id").agg(F.min("doc_id").alias("found"))
    linked = linked.select("node", "component_id").join(least, "component_id")
    of_set = classes.join(linked, "node", "left").select(
        "set_a", "set_b", "n_shingles",
        F.coalesce("component_id", "node").alias("root"), F.coalesce("found", "doc_id").alias("found"),
    )
    joined = rows.select("doc_id", "mark", "n_shingles", "set_a", "set_b").join(
        of_set, ["set_a", "set_b", "n_shingles"], "left"
    )
    named = F.col("doc_id").isNotNull()
    return joined.select(
        "doc_id", "mark", "n_shingles", F.when(named, F.col("root")).alias("root"),
        F.when(named, F.col("found")).alias("found"),
    )


def near_groups(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``.

    Null, empty and blank texts have no shingles, link with nothing and are
    their own component. Different texts under one id are judged each by itself: a row's
    component follows the links of its own text. A row without an id can be named by
    no component: it has none and stays.
    """
    component_id = F.coalesce("found", "doc_id")
    return _judged(docs).select(
        "doc_id", "n_shingles", component_id.alias("component_id"),
        F.coalesce(F.col("doc_id") == component_id, F.lit(True)).alias("kept"),
    )


def _open_links(shared: DataFrame, component: DataFrame, sets: DataFrame, bits: DataFrame, entries: int) -> DataFrame:
    """Links between components that meet in a bucket of three or more."""
    members = shared.where("members > 2").join(component, "node", "left").withColumn(
        "component_id", F.coalesce("component_id", "node")
    )
    members = staged(members.select("key", "node", "component_id", "members", "total"), "members")
    still = staged(members.groupBy("key").agg(
        F.min("component_id").alias("_least"), F.max("component_id").alias("_most"),
        F.first("members").alias("members"),
    ).where("_least < _most").select("key", "members"), "open")
    blocks = F.ceil(F.col("total") / BLOCK_SHINGLES).cast("int")
    placed = (
        on_key(members.drop("members"), still, entries, "left_semi")
        .withColumn("blocks", blocks)
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "key", "node", "component_id", "block",
            F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        )
    )
    filled = placed.join(bits, "node").join(sets, "node")
    dealt = filled.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")
    return dealt.mapInArrow(_blocks, "a long, b long").distinct()


def without_near_copies(docs: DataFrame) -> DataFrame:
    """One row of each component, with all its columns: one under the component's smallest id.

    Where several rows of a component have that id, the one of the least mark stays, and any one of
    rows that are the same in id and text. Rows without a set or without an id stay.
    """
    rows = staged(_judged(docs).where("root is not null").select("doc_id", "mark", "root", "found"), "judged")
    own = rows.where("doc_id = found")
    more = staged(own.groupBy("root", "doc_id").agg(
        F.min("mark").alias("least"), F.count("*").alias("n")
    ).where("n > 1"), "more")
    others = own.join(more.select("root", "least"), "root").where("mark <> least")
    gone = rows.where("doc_id <> found").select("doc_id", "mark").unionByName(others.select("doc_id", "mark"))
    gone = gone.distinct().toDF("id", "mark")
    kept = docs.select(
        F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("mark")
    ).join(gone, ["id", "mark"], "left_anti")
    if more.isEmpty():
        return kept.select("row.*")
    tied = more.select(F.col("doc_id").alias("id"), F.col("least").alias("mark"))
    single = kept.join(tied, ["id", "mark"], "left_anti").select("row")
    first = kept.join(tied, ["id", "mark"], "left_semi").groupBy("id", "mark").agg(F.first("row").alias("row"))
    return single.unionByName(first.select("row")).select("row.*")


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END AS sh
  FROM w),
x AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS g FROM s),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM x a JOIN x b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
reach(doc_id, root) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT p.b, r.root FROM reach r JOIN pairs p ON p.a = r.doc_id),
least_root AS (SELECT doc_id, min(root) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, len(sh)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM s JOIN least_root USING (doc_id)
"""
