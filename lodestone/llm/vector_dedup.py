"""Near copies among vectors by cross-polytope hashing.

A unit vector is rotated at random, by three rounds of sign flips and a fast
Hadamard transform, and hashed to the axis it is nearest to, with its sign. A
bucket key joins the axes of several rotations; every table has its own. Vectors
also enter the buckets of their next best axis in each rotation (multiprobe), so
close vectors that a border parts still meet. Keys are made as long as keeps
buckets small for the number of vectors, and tables as many as the measured
chance of meeting at the bound asks for.

Members of a bucket are first compared by 128 signs of random projections, in blocks;
those without a partner at a likely distance leave it, so that vectors travel only
to buckets in which they may link. There they are compared in double precision. A pair counts
in the first bucket it shares, so no pair is ever written out: a block yields the
number of links per vector and the links that join its components. Equal
vectors are one class from the start.
"""

from __future__ import annotations

from functools import cache, partial
from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import connected, staged

BOUND = 0.95
MISSED = 1e-6
BLOCK = 1024
# Of 128 signs, a pair at the bound differs in more than this many with a chance of 1e-9.
SIGNS, MOST_APART = 128, 36


def hadamard(rows: np.ndarray) -> np.ndarray:
    """The fast Hadamard transform of every row; the width is a power of two."""
    width = rows.shape[1]
    step = 1
    while step < width:
        halves = rows.reshape(len(rows), width // (2 * step), 2, step)
        rows = np.stack([halves[:, :, 0] + halves[:, :, 1], halves[:, :, 0] - halves[:, :, 1]], axis=2)
        rows = rows.reshape(len(rows), width)
        step *= 2
    return rows / np.sqrt(width)


@cache
def _signs(width: int, rotations: int) -> np.ndarray:
    return np.random.default_rng(31).choice([-1.0, 1.0], (rotations, 3, width))


def axes(units: np.ndarray, rotation: int, rotations: int) -> np.ndarray:
    """Of every unit vector the best and the second-best axis of one rotation, signs included."""
    width = 1 << max(units.shape[1] - 1, 1).bit_length()
    turned = np.zeros((len(units), width))
    turned[:, :units.shape[1]] = units
    for signs in _signs(width, rotations)[rotation]:
        turned = hadamard(turned * signs)
    size = np.abs(turned)
    best = size.argmax(axis=1)
    every = np.arange(len(units))
    size[every, best] = -1
    second = size.argmax(axis=1)
    return np.stack([
        2 * a + (turned[every, a] < 0) for a in (best, second)
    ], axis=1).astype(np.uint64)


def all_axes(units: np.ndarray, length: int, tables: int) -> np.ndarray:
    """``rows x tables x length x 2``: the best and second-best axes of all rotations."""
    found = [axes(units, k, tables * length) for k in range(tables * length)]
    return np.stack(found, axis=1).reshape(len(units), tables, length, 2)


def keys_of(found: np.ndarray) -> np.ndarray:
    """``rows x tables x probes`` bucket keys; probes swap one axis for the second best."""
    rows, tables, length, _ = found.shape
    out = np.zeros((rows, tables, length + 1), np.uint64)
    for probe in range(length + 1):
        key = np.tile(np.arange(1, tables + 1, dtype=np.uint64), (rows, 1))
        for k in range(length):
            key = (key ^ found[:, :, k, int(probe == k + 1)]) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
        out[:, :, probe] = key
    return out


def keys(units: np.ndarray, length: int, tables: int) -> np.ndarray:
    return keys_of(all_axes(units, length, tables))


@cache
def _planes(width: int) -> np.ndarray:
    return np.random.default_rng(47).normal(size=(width, SIGNS))


@cache
def settings(n: int, width: int) -> tuple[int, int]:
    """Length of keys and number of tables for ``n`` vectors.

    The chance that two vectors just at the bound meet in a table is measured on
    pairs made for it; tables follow from the chance of a miss that is allowed.
    """
    sides = 2 * (1 << max(width - 1, 1).bit_length())
    length = max(1, round(log(max(n, 2)) / log(sides)))
    seeded = np.random.default_rng(5)
    a = seeded.normal(size=(400, width))
    b = seeded.normal(size=(400, width))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(1, keepdims=True) * a
    b /= np.maximum(np.linalg.norm(b, axis=1, keepdims=True), 1e-12)
    tries = 8
    x, y = (keys(v, length, tries) for v in (a, BOUND * a + np.sqrt(1 - BOUND ** 2) * b))
    meet = (x[:, :, :, None] == y[:, :, None, :]).any(axis=(2, 3)).mean()
    if not meet:
        raise ValueError(f"no pair at the bound meets in {tries} tables of keys of {length} axes")
    return length, max(ceil(log(MISSED) / log(1 - min(meet, 0.99))), 4)


def _unit(batch) -> np.ndarray:
    rows = batch.column("embedding")
    flat = rows.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = flat.reshape(len(rows), -1)
    # Scaled first, so that squares of extreme components neither vanish nor overflow.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _keyed(batches, length: int, tables: int):
    """``vec_id, signs_a, signs_b, axes, keys`` of every vector."""
    for batch in batches:
        if not batch.num_rows:
            continue
        units = _unit(batch)
        found = all_axes(units, length, tables)
        flat = keys_of(found).view(np.int64).reshape(len(found), -1)
        lists = pa.ListArray.from_arrays(
            pa.array(np.arange(len(flat) + 1) * flat.shape[1], pa.int32()), pa.array(flat.ravel())
        )
        signs = np.packbits(units @ _planes(units.shape[1]) > 0, axis=1).view(np.int64)
        small = found.astype(np.uint32)
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), pa.array(signs[:, 0].copy()), pa.array(signs[:, 1].copy()),
             pa.array([row.tobytes() for row in small], pa.binary()), lists],
            ["vec_id", "signs_a", "signs_b", "axes", "keys"],
        )


def _likely(batches):
    """The members of every run of ``key, low, high`` that have one at a likely distance."""
    names = ["key", "low", "high", "block", "vec_id", "signs_a", "signs_b"]

    def near(rows: np.ndarray):
        changes = (rows[1:, :3] != rows[:-1, :3]).any(axis=1)
        ends = np.append(np.flatnonzero(changes), len(rows) - 1)
        after = np.repeat(ends, np.diff(ends, prepend=-1)) - np.arange(len(rows))
        marked = np.zeros(len(rows), bool)
        step, live = 1, np.flatnonzero(after >= 1)
        while len(live):
            other = live + step
            apart = np.bitwise_count((rows[live, 5:] ^ rows[other, 5:]).view(np.uint64)).sum(axis=1)
            inside = (rows[live, 1] == rows[live, 2]) | (rows[live, 3] != rows[other, 3])
            found = live[(apart <= MOST_APART) & inside]
            marked[found] = marked[found + step] = True
            step += 1
            live = live[after[live] >= step]
        return pa.RecordBatch.from_arrays([pa.array(rows[marked, c].copy()) for c in range(5)], names[:5])

    kept = np.empty((0, len(names)), np.int64)
    for batch in batches:
        rows = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in names], axis=1)
        kept = np.concatenate([kept, rows])
        if not len(kept):
            continue
        # The last run may go on in the next batch.
        last = (kept[:, :3] != kept[-1, :3]).any(axis=1).sum()
        if last:
            yield near(kept[:last])
            kept = kept[last:]
    if len(kept):
        yield near(kept)


def _first_shared(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of pairs of key sets ``pairs x tables x probes``, the first table and the least key in it they share."""
    same = (a[:, :, :, None] == b[:, :, None, :]).any(axis=3)
    table = same.any(axis=2).argmax(axis=1)
    every = np.arange(len(a))
    shared = np.where(same[every, table], a[every, table], np.iinfo(np.int64).max)
    return table, shared.min(axis=1)


def _compare(key: int, ids, units, weights, sets, own, links: np.ndarray) -> np.ndarray:
    """Adds to ``links`` what each row of a block links with; returns the parent of each row."""
    parent = list(range(len(ids)))
    for at in range(0, len(ids), 256):
        near = units[at:at + 256] @ units.T >= BOUND
        near &= np.arange(at, at + len(near))[:, None] < np.arange(len(ids))[None, :]
        if own is not None:
            near &= own[at:at + 256, None] != own[None, :]
        a, b = np.nonzero(near)
        a += at
        for part in range(0, len(a), 20_000):
            x, y = a[part:part + 20_000], b[part:part + 20_000]
            _, first = _first_shared(sets[x], sets[y])
            x, y = x[first == key], y[first == key]
            np.add.at(links, x, weights[y])
            np.add.at(links, y, weights[x])
            for i, j in zip(x.tolist(), y.tolist(), strict=True):
                i, j = _root(parent, i), _root(parent, j)
                parent[max(i, j)] = min(i, j)
    return np.array([_root(parent, i) for i in range(len(parent))])


def _root(parent: list, i: int) -> int:
    while parent[i] != i:
        parent[i] = i = parent[parent[i]]
    return i


def _linked(batches, tables: int):
    """Per row of every block with links: their number, and a row it is linked with through others."""
    def flush(key, rows):
        rows.sort(key=lambda r: r[0])
        ids = np.array([r[0] for r in rows])
        units = np.stack([r[1] for r in rows])
        weights = np.array([r[2] for r in rows])
        sets = np.stack([r[3] for r in rows])
        own = np.array([r[4] for r in rows])
        links = np.zeros(len(rows), np.int64)
        parent = _compare(key, ids, units, weights, sets, own if len(set(own.tolist())) > 1 else None, links)
        some = np.flatnonzero(links)
        return list(zip(ids[some].tolist(), links[some].tolist(), ids[parent[some]].tolist(), strict=True))

    last, rows, found = None, [], []
    for batch in batches:
        if not batch.num_rows:
            continue
        marks = list(zip(*(batch.column(c).to_pylist() for c in ("key", "low", "high")), strict=True))
        ids, weights, own = (batch.column(c).to_pylist() for c in ("vec_id", "size", "block"))
        units = _unit(batch)
        flat = np.frombuffer(b"".join(batch.column("axes").to_pylist()), np.uint32).astype(np.uint64)
        sets = keys_of(flat.reshape(len(units), tables, -1, 2)).view(np.int64)
        for i, mark in enumerate(marks):
            if mark != last:
                found += flush(last[0], rows) if len(rows) > 1 else []
                last, rows = mark, []
            rows.append((ids[i], units[i], weights[i], sets[i], own[i]))
        if found:
            yield _out(found)
            found = []
    found = flush(last[0], rows) if len(rows) > 1 else []
    if found:
        yield _out(found)


def _out(found):
    ids, links, parents = zip(*found, strict=True)
    return pa.RecordBatch.from_pydict({
        "a": pa.array(ids, pa.int64()), "links": pa.array(links, pa.int64()), "b": pa.array(parents, pa.int64()),
    })


def vector_groups(rows: DataFrame) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``rows``.

    Vectors that are null, empty, zero or have a component that is null or not
    finite link with nothing, and those of different widths never link. Rows repeated under
    one id are linked like other equal vectors. A row without an id has no
    component and stays.
    """
    # Components keep single precision only where they came in it.
    kind = "float" if rows.schema["embedding"].dataType.simpleString() == "array<float>" else "double"
    vectors = rows.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(f"array<{kind}>").alias("embedding")
    )
    sound = F.coalesce(
        F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("embedding", lambda x: x != 0), F.lit(False)
    )
    usable = vectors.where(F.col("vec_id").isNotNull() & sound)
    # Equal vectors: a class under its smallest id, by a partial aggregation. -0.0 is 0.0.
    zeroed = F.transform("embedding", lambda x: F.when(x == 0, F.lit(0.0).cast(kind)).otherwise(x))
    digest = F.sha2(F.array_join(F.transform(zeroed, lambda x: x.cast("string")), ","), 256)
    named = usable.select("vec_id", "embedding", digest.alias("digest"))
    classes = staged(
        named.groupBy("digest").agg(F.min("vec_id").alias("node"), F.count("*").alias("size")), "classes"
    )
    reps = named.select(F.col("vec_id").alias("node"), "embedding", "digest").join(
        classes, ["digest", "node"]
    ).dropDuplicates(["digest", "node"]).withColumn("width", F.size("embedding"))
    reps = staged(reps.select(F.col("node").alias("vec_id"), "embedding", "size", "width"), "vectors")

    widths = [(r["width"], r["count"]) for r in reps.groupBy("width").count().collect()]
    linked = [
        _width_links(reps.where(F.col("width") == width), width, n).select("a", "links", "b")
        for width, n in sorted(widths)
    ]
    empty = rows.sparkSession.createDataFrame([], "a long, links long, b long")
    for part in linked:
        empty = empty.unionByName(part)
    found = staged(empty, "links")
    counts = found.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    component = connected(found.where("a <> b").select("a", "b"))

    per_class = (
        classes.join(counts, "node", "left").join(component, "node", "left")
        .select("digest", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("links"),
                F.coalesce("component_id", "node").alias("found"))
    )
    keyed = vectors.select("vec_id", F.when(F.col("vec_id").isNotNull() & sound, digest).alias("digest"))
    component_id = F.when(F.col("vec_id").isNotNull(), F.coalesce("found", "vec_id"))
    return keyed.join(per_class, "digest", "left").select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component_id.alias("component_id"),
        F.coalesce(F.col("vec_id") == component_id, F.lit(True)).alias("kept"),
    )


def _width_links(reps: DataFrame, width: int, n: int) -> DataFrame:
    length, tables = settings(1 << max(n - 1, 1).bit_length(), width)
    keyed = staged(reps.select("vec_id", "embedding").mapInArrow(
        partial(_keyed, length=length, tables=tables),
        "vec_id long, signs_a long, signs_b long, axes binary, keys array<long>",
    ), "keys")
    entries = keyed.select("vec_id", "signs_a", "signs_b", F.explode(F.array_distinct("keys")).alias("key"))
    # Only buckets of more than a block need their size; the members of others meet by their key.
    large = staged(entries.groupBy("key").agg(F.count("*").alias("members")).where(F.col("members") > BLOCK), "large")
    one = F.lit(0).cast("int")
    whole = entries.join(large, "key", "left_anti").select(
        "*", one.alias("block"), one.alias("low"), one.alias("high")
    )
    parts = (
        entries.join(large, "key")
        .withColumn("blocks", F.ceil(F.col("members") / BLOCK).cast("int"))
        .withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
        .drop("members", "blocks", "other")
    )
    run = ["key", "low", "high"]
    likely = staged(
        whole.unionByName(parts).repartition(*run).sortWithinPartitions(*run)
        .mapInArrow(_likely, "key long, low long, high long, block long, vec_id long"), "likely"
    )
    filled = likely.join(keyed.select("vec_id", "axes"), "vec_id").join(
        reps.select("vec_id", "embedding", "size"), "vec_id"
    )
    return filled.repartition(*run).sortWithinPartitions(*run).mapInArrow(
        partial(_linked, tables=tables), "a long, links long, b long"
    )


SQL = """
WITH v AS (
  SELECT row_number() OVER () AS i, vec_id, embedding::DOUBLE[] AS e FROM embeddings),
ok AS (
  SELECT * FROM v WHERE e IS NOT NULL AND list_bool_and(list_transform(e, lambda x: x IS NOT NULL AND isfinite(x)))
  AND list_bool_or(list_transform(e, lambda x: x <> 0))),
pairs AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.i <> b.i
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
counts AS (SELECT a, count(*) AS n FROM pairs GROUP BY a)
, recursive_roots AS (
  WITH RECURSIVE reach(vec_id, root) AS (
    SELECT vec_id, vec_id FROM embeddings
    UNION SELECT p.b, r.root FROM reach r JOIN pairs p ON p.a = r.vec_id)
  SELECT vec_id, min(root) AS component_id FROM reach GROUP BY vec_id)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN recursive_roots USING (vec_id) LEFT JOIN counts ON counts.a = vec_id
"""
