"""Stored postings by word, changed by small deltas and searched with early stop.

A row is a block: the postings of one word in one range of chunks. A base lies in parts by
hash of the word, sorted by word, so a query opens the parts of its words and, in these,
the row groups of its words. A commit is one delta: the postings of its own chunks, the ids that are
gone, and how often each word of these occurred, so that document frequencies
need no look at dead postings. It writes bytes in proportion to its own texts.

The words of each chunk, in their order, are kept in a row beside the postings, where the chunk was read. Blocks
are made from these rows, some ranges at a time: a chunk is moved once, to the other chunks of its range, and in no other
form than this. Compaction makes a new base from the rows that live in the same way, and reads no postings.

Ranges hold chunks of about one length, as short chunks score higher. Each block keeps its
peaks, those counts and lengths that no other chunk of the block beats in both, from which the
highest score in the block follows for any mean length. A search for the best chunks scores the
ranges with the highest bounds first, and then only those whose bound reaches the last
score found.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions.analysis import query_phrases, words
from lodestone.functions.bytesops import let
from lodestone.operators.keyword import bm25_postings, idf, in_scope, saturation, top_by
from lodestone.plans.checkpoint import codes, dropped, exists, likely, staged
from lodestone.sources.segments import FRESH, Segments, of_parts

BUCKETS = 64
CHUNKS_PER_RANGE = 256
CLASSES = 128
# Ranges that are named in a pushed filter.
NAMED_RANGES = 500
# Chunks of whose rows a task that writes a part gets no more, whatever their number is.
CHUNKS_PER_SLICE = 1 << 17
# Words of chunks whose postings one task makes, about; smaller tables go to as many tasks as there are cores.
WORDS_PER_SLICE = 1 << 22
LEAST_PER_SLICE = 1 << 18
# Ranges of long chunks hold fewer of them, so that the words of a range fit into a row.
WORDS_PER_RANGE = 1 << 21
# Words of whole ranges whose blocks are made at once, about, and postings that leave a task together.
WORDS_AT_ONCE = 1 << 20
POSTINGS_PER_BATCH = 1 << 15
_ENTRY = "struct<id:string, repo:string, branch:string, tf:int, length:int, positions:array<int>>"
_BLOCK = f"term string, range int, n int, dead int, peaks array<struct<tf:int,length:int>>, entries array<{_ENTRY}>"
_TEXT = "id string, repo string, branch string, length int, tokens string"
_ROUNDING = 1 + 1e-9


def part_of(key: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")


def part_of_word(word: str, parts: int) -> int:
    """``part_of`` of one word, on the driver."""
    code = xxhash.xxh64_intdigest(word.encode(), seed=42)
    return (code - (1 << 64) * (code >> 63)) % parts


def _length_class(length: Column) -> Column:
    return F.least(F.floor(4 * F.log2(length.cast("double") + 1)), F.lit(CLASSES - 1)).cast("int")


def _stable(codes: np.ndarray) -> np.ndarray:
    """Order of small numbers, equal ones as they come; sixteen bits at a time, as numpy counts these."""
    order = np.argsort((codes & 0xFFFF).astype(np.uint16), kind="stable")
    for shift in range(16, max(int(codes.max(initial=0)).bit_length(), 1), 16):
        order = order[np.argsort((codes[order] >> shift & 0xFFFF).astype(np.uint16), kind="stable")]
    return order


def _peaks(block: np.ndarray, tf: np.ndarray, length: np.ndarray, blocks: int) -> pa.Array:
    """Of the ``tf, length`` pairs of each block those that none beats in both, shortest first."""
    order = np.lexsort((-tf, length, block))
    base = block[order] * (int(tf.max(initial=0)) + 1)
    above = base + tf[order]
    before = np.concatenate([[0], np.maximum.accumulate(above)[:-1]])
    kept = order[above > np.maximum(before, base)]
    edges = np.searchsorted(block[kept], np.arange(blocks + 1)).astype(np.int32)
    pairs = pa.StructArray.from_arrays([pa.array(x[kept].astype(np.int32)) for x in (tf, length)], ["tf", "length"])
    return pa.ListArray.from_arrays(pa.array(edges), pairs)


def _made(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    """Blocks of the words of some whole ranges; ``rows`` lie by range, and by id in it."""
    column = {name: rows.column(name).combine_chunks() for name in rows.column_names}
    lists = pc.split_pattern(column["tokens"], " ")
    offsets = lists.offsets.to_numpy()
    coded = lists.flatten().dictionary_encode()
    # Spark and Arrow both put strings in the order of their bytes.
    sorted_terms = pc.sort_indices(coded.dictionary).to_numpy()
    rank = np.empty(len(sorted_terms), np.int64)
    rank[sorted_terms] = np.arange(len(sorted_terms))
    term = rank[coded.indices.to_numpy()]
    sizes = np.diff(offsets)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    order = _stable(term)
    at = (np.arange(len(term)) - np.repeat(offsets[:-1] - offsets[0], sizes))[order]
    term, doc = term[order], doc[order]
    starts = np.flatnonzero(np.concatenate([[True], (term[1:] != term[:-1]) | (doc[1:] != doc[:-1])]))
    tf = np.diff(np.concatenate([starts, [len(term)]]))
    term, doc = term[starts], doc[starts]
    place, length = column["range"].to_numpy()[doc], column["length"].to_numpy()[doc].astype(np.int64)
    new = np.concatenate([[True], (term[1:] != term[:-1]) | (place[1:] != place[:-1])])
    firsts = np.concatenate([np.flatnonzero(new), [len(term)]])
    n = np.diff(firsts)
    positions = pa.ListArray.from_arrays(
        pa.array(np.concatenate([starts, [len(at)]]).astype(np.int32)), pa.array(at.astype(np.int32)))
    docs = pa.array(doc)
    entries = pa.StructArray.from_arrays(
        [*(column[name].take(docs) for name in ("id", "repo", "branch")),
         pa.array(tf.astype(np.int32)), pa.array(length.astype(np.int32)), positions],
        ["id", "repo", "branch", "tf", "length", "positions"])
    made = pa.RecordBatch.from_arrays([
        coded.dictionary.take(pa.array(sorted_terms[term[firsts[:-1]]])), pa.array(place[firsts[:-1]].astype(np.int32)),
        pa.array(n.astype(np.int32)), pa.array(np.zeros(len(n), np.int32)),
        _peaks(np.cumsum(new) - 1, tf, length, len(n)), pa.ListArray.from_arrays(pa.array(firsts.astype(np.int32)), entries),
    ], ["term", "range", "n", "dead", "peaks", "entries"])
    # Some blocks at a time, by their postings.
    edges = np.flatnonzero(np.diff(firsts[:-1] // POSTINGS_PER_BATCH, prepend=-1))
    for start, stop in zip(edges, [*edges[1:], len(n)]):
        yield made.slice(start, stop - start)


def _range_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of the words that the rows of words of each range hold."""
    for batch in batches:
        chunks = batch.column("chunks")
        sizes = pc.list_value_length(chunks).to_numpy()
        ranges = pa.array(np.repeat(batch.column("range").to_numpy(), sizes))
        rows = pa.Table.from_arrays([ranges, *chunks.flatten().flatten()], ["range", "id", "repo", "branch", "length", "tokens"])
        rows = rows.take(pc.sort_indices(rows, [
            (name, "ascending") for name in ("range", "id", "repo", "branch", "length")], null_placement="at_start"))
        place, upto = rows.column("range").to_numpy(), np.cumsum(rows.column("length").to_numpy(), dtype=np.int64)
        start = 0
        while start < len(place):
            # Whole ranges up to a number of words, one at least.
            last = max(np.searchsorted(upto, (upto[start - 1] if start else 0) + WORDS_AT_ONCE), start)
            stop = np.searchsorted(place, place[min(last, len(place) - 1)], "left" if last < len(place) else "right")
            if stop <= start:
                stop = np.searchsorted(place, place[start], "right")
            yield from _made(rows.slice(start, stop - start))
            start = stop


@dataclass(frozen=True)
class Found:
    """The best rows, and of how many blocks of the query's words how many were scored."""

    rows: DataFrame
    blocks: int
    scored: int


class PostingsStore:
    """Commit, search and compact the postings of ``id, repo, branch, chunk`` rows; ids are distinct."""

    def __init__(self, spark: SparkSession, folder: str, buckets: int = BUCKETS, range_size: int = CHUNKS_PER_RANGE):
        self.spark, self.range_size = spark, range_size
        self.segments = Segments(spark, folder, {
            "words": _BLOCK,
            "docs": "id string, length int, terms array<string>",
        }, {"texts": _TEXT})
        log = self.segments.log()
        stored = (log[0]["facts"] or {}).get("buckets") if log and log[0]["base"] else None
        self.buckets = stored or buckets

    # --- writing ---------------------------------------------------------------

    def commit(self, rows: DataFrame, gone: DataFrame | None = None, batch: int = 0) -> None:
        """Add the postings of ``rows``, in place of any under their ids, and remove those of ``gone`` ids.

        The first commit writes a base, every other one a delta. ``batch`` is kept with the log entry.
        """
        log = self.segments.log()
        number = self.segments.next_number()
        # Words hold letters and digits only, so a space keeps them apart.
        found = let(words(F.col("chunk")), lambda w: F.struct(
            F.coalesce(F.size(w), F.lit(0)).alias("length"), F.coalesce(F.array_join(w, " "), F.lit("")).alias("tokens")))
        self.segments.write("texts", number, rows.select("id", "repo", "branch", found.alias("w")).select(
            "id", "repo", "branch", "w.length", "w.tokens"))
        texts = self.segments.read("texts", [number])
        ids = texts.select("id") if gone is None else texts.select("id").unionByName(gone.select("id"))
        dead = staged(self._dead(ids, log), "dead") if log else None
        slices = 1 + texts.count() // CHUNKS_PER_SLICE
        place = (lambda key: part_of(F.col(key), self.buckets)) if not log else (lambda key: F.lit(FRESH))
        self.segments.write("docs", number, self._counted(texts, slices).withColumn("part", place("id")), "id", dealt=True)
        self._write(number, texts, dead, base=not log)
        if dead is not None:
            self.segments.write("gone", number, dead.select("id"))
        docs = self.segments.read("docs", [number])
        sums = [frame.agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first() for frame in (docs, dead) if frame is not None]
        n, total = (sums[0][i] - (sums[1][i] if dead is not None else 0) for i in (0, 1))
        facts = {"docs": n, "words": total, "batch": batch, "buckets": self.buckets}
        self.segments.commit(number, base=not log, **facts, gone=sums[1][0] if dead is not None else 0)
        dropped(*([dead] if dead is not None else []))

    def _counted(self, texts: DataFrame, slices: int) -> DataFrame:
        """``id, length, terms`` of the chunks; rows of repeated ids, and without one, are dealt by part and slice.

        Chunks without a word count in the statistics. Rows under one id are one chunk; those without an
        id, and those of an id without words, count one by one. A row of an id of its own stays where it lies.
        """
        deal = part_of(F.col("id"), self.buckets) * slices + F.pmod(F.xxhash64("id", F.lit("slice")), F.lit(slices)).cast("int")
        terms = F.sort_array(F.array_distinct(F.split("tokens", " ")))
        repeated = codes(texts.groupBy("id").count().where("count > 1 or id is null"), ["id"])
        coded = texts.select("id", "length", F.when(F.col("length") > 0, terms).otherwise(F.array().cast("array<string>")).alias("terms"),
                             F.xxhash64("id").alias("_code"))
        single = coded.where("false") if repeated is None else coded.join(F.broadcast(repeated), "_code", "left_anti")
        others = coded if repeated is None else coded.join(F.broadcast(repeated), "_code", "left_semi")
        rows = others.select("id", "length", F.array_join("terms", " ").alias("terms"), deal.alias("deal")).repartition("deal")
        known = rows.groupBy("deal", "id").agg(
            F.count("*").cast("int").alias("n"), F.first(F.when(F.col("length") > 0, F.col("length")), True).alias("length"),
            F.concat_ws(" ", F.collect_list(F.when(F.col("length") > 0, F.col("terms")))).alias("terms"),
        )
        times = F.when(F.col("length").isNull(), F.col("n")).when(F.col("id").isNull(), F.col("n") + 1).otherwise(1)
        every = known.withColumn("k", F.explode(F.sequence(F.lit(1), times)))
        whole = (F.col("k") == 1) & F.col("length").isNotNull()
        return single.drop("_code").unionByName(every.select(
            "id", F.when(whole, F.col("length")).otherwise(0).alias("length"),
            F.when(whole, F.split("terms", " ")).otherwise(F.array().cast("array<string>")).alias("terms"),
        ))

    def _dead(self, ids: DataFrame, log: list) -> DataFrame:
        """The living rows of ``docs`` under ``ids``; the filter on the small side prunes parts when it runs."""
        docs = self.segments.alive(self.segments.read("docs", [r["segment"] for r in log]), log)
        named = staged(ids.where("id is not null").distinct(), "named")
        docs = likely(docs, named, ["id"])
        keys = named.withColumn("part", part_of(F.col("id"), self.buckets)).unionByName(
            named.withColumn("part", F.lit(FRESH)))
        return docs.join(keys.where("part >= -1"), ["part", "id"], "left_semi").select("id", "length", "terms")

    def _write(self, number: int, texts: DataFrame, dead: DataFrame | None, base: bool) -> None:
        """Write the blocks of ``texts``."""
        blocks = self._blocked(texts)
        if dead is not None:
            lost = dead.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").cast("int").alias("dead"))
            blocks = blocks.unionByName(lost.select(
                "term", F.lit(-1).alias("range"), F.lit(0).alias("n"), "dead",
                F.array().cast("array<struct<tf:int,length:int>>").alias("peaks"),
                F.array().cast(f"array<{_ENTRY}>").alias("entries"),
            ))
        part = part_of(F.col("term"), self.buckets) if base else F.lit(FRESH)
        self.segments.write("words", number, blocks.withColumn("part", part), "term", "range", dealt=True)

    def _blocked(self, texts: DataFrame) -> DataFrame:
        """Postings as blocks; a range is a class of lengths and, in it, a share of the chunks.

        The counts of the classes reach the driver, a row for each of at most CLASSES. The chunks of a range
        come together as rows of words, and its postings are made there.
        """
        at = _length_class(F.col("length"))
        full = texts.where("length > 0")
        counts = full.groupBy(at.alias("c")).agg(F.count("*").alias("n"), F.sum("length").alias("words")).collect()
        shares = [1] * CLASSES
        for row in counts:
            most = max(1, int(WORDS_PER_RANGE / 2 ** ((row["c"] + 1) / 4)))
            shares[row["c"]] = -(-row["n"] // min(self.range_size, most))
        starts = [sum(shares[:i]) for i in range(CLASSES)]
        total = sum(row["words"] for row in counts)
        slices = max(1, -(-total // WORDS_PER_SLICE), min(self.spark.sparkContext.defaultParallelism, total // LEAST_PER_SLICE))
        share, start = (F.get(F.array(*[F.lit(x) for x in xs]), at) for xs in (shares, starts))
        placed = full.withColumn("range", (start + F.pmod(F.xxhash64("id"), share)).cast("int")).withColumn(
            "slice", F.pmod(F.col("range"), F.lit(slices)).cast("int"))
        gathered = placed.repartitionById(slices, "slice").groupBy("slice", "range").agg(
            F.collect_list(F.struct("id", "repo", "branch", "length", "tokens")).alias("chunks"))
        return gathered.select("range", "chunks").mapInArrow(_range_words, _BLOCK)

    def compact(self) -> None:
        """Merge all segments into a new base."""
        log = self.segments.log()
        if len(log) < 2:
            return
        self.segments.vacuum()
        number = self.segments.next_number()
        segments = [r["segment"] for r in log]
        self.segments.write("texts", number, self._texts(log))
        docs = self.segments.read("docs", segments).select("part", "segment", "id", "length", "terms")
        part = F.when(F.col("part") == FRESH, part_of(F.col("id"), self.buckets)).otherwise(F.col("part"))
        alive = self.segments.alive_in_place(docs, log).drop("segment").withColumn("part", part)
        self.segments.write("docs", number, alive, "id", dealt=True)
        docs, texts = (self.segments.read(name, [number]) for name in ("docs", "texts"))
        self._write(number, texts, None, base=True)
        n, total = docs.agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first()
        self.segments.commit(
            number, base=True, docs=n, words=total, batch=(log[-1]["facts"] or {}).get("batch", 0), buckets=self.buckets
        )

    def _texts(self, log: list) -> DataFrame:
        """The living rows of words; those of segments stored without, by a former version, from their postings."""
        columns = ["id", "repo", "branch", "length", "tokens"]
        known = {r["segment"]: exists(self.spark, f"{self.segments.folder}/texts/segment={r['segment']}") for r in log}
        rows = self.segments.alive_in_place(self.segments.read("texts", [s for s in known if known[s]]), log).select(columns)
        if all(known.values()):
            return rows
        old = [s for s in known if not known[s]]
        placed = F.transform("positions", lambda at: F.struct(at.alias("at"), F.col("term").alias("term")))
        tokens = F.array_join(F.transform(F.array_sort(F.flatten(F.collect_list(placed))), lambda w: w["term"]), " ")
        full = self._entries(self.segments.read("words", old), log).groupBy("id", "repo", "branch", "length").agg(tokens.alias("tokens"))
        return rows.unionByName(full)

    def last_batch(self) -> int:
        log = self.segments.log()
        return (log[-1]["facts"] or {}).get("batch", 0) if log else 0

    def drop(self) -> None:
        self.segments.drop()

    # --- reading ---------------------------------------------------------------

    def _words(self, terms: list[str] | None, log: list) -> DataFrame:
        """Blocks of some words, or of all: of base parts, only those the words lie in."""
        rows = self.segments.read("words", [r["segment"] for r in log])
        if terms is None:
            return rows
        parts = {part_of_word(t, self.buckets) for t in terms}
        return rows.where(of_parts(sorted(parts)) & F.col("term").isin(terms))

    def read(self, terms: list[str] | None = None) -> DataFrame:
        """``term, id, repo, branch, tf, length, positions`` of the living postings, of some words or of all."""
        log = self.segments.log()
        return self._entries(self._words(terms, log), log)

    def read_many(self, terms: DataFrame) -> DataFrame:
        """The same rows for a table of words; the filter on the small side prunes parts when the job runs."""
        log = self.segments.log()
        named = terms.select("term").where("term is not null").distinct()
        keys = named.withColumn("part", part_of(F.col("term"), self.buckets)).unionByName(
            named.withColumn("part", F.lit(FRESH))).where(F.col("part") >= FRESH)
        return self._entries(self._words(None, log).join(keys, ["part", "term"], "left_semi"), log)

    def _entries(self, blocks: DataFrame, log: list) -> DataFrame:
        single = blocks.where("n > 0").select("segment", "range", "term", F.explode("entries").alias("e"))
        flat = single.select("segment", "range", "term", "e.*")
        return self.segments.alive(flat, log).select("term", "id", "repo", "branch", "tf", "length", "positions")

    def stats(self, id_words: int = 1) -> DataFrame:
        """One row: number of chunks and mean length, from the log alone."""
        facts = [r["facts"] or {} for r in self.segments.log()]
        n, words = (sum(f.get(name, 0) for f in facts) for name in ("docs", "words"))
        mean = (words + id_words * n) / n if n else None
        return self.spark.createDataFrame([(float(n), mean)], "total double, mean double")

    def scores(self, query: str, *, repo: str | None = None, branch: str | None = None, id_words: int = 1) -> DataFrame:
        """``id, keyword_score`` of every chunk that holds a phrase of ``query``."""
        terms = sorted({w for p in query_phrases(query) for w in p})
        return bm25_postings(self.read(terms), self.stats(id_words), query, repo=repo, branch=branch, id_words=id_words)

    def top(
        self, query: str, limit: int, *, repo: str | None = None, branch: str | None = None, id_words: int = 1
    ) -> Found:
        """The ``limit`` best rows of ``scores``; ranges that cannot reach them are not scored.

        How often a phrase of several words occurs is known only from all its places, so
        with such a phrase all blocks of the query's words are read.
        """
        phrases = query_phrases(query)
        log = self.segments.log()
        blocks = self._words(sorted({w for p in phrases for w in p}), log)
        if not phrases or any(len(p) > 1 for p in phrases):
            n = blocks.where("n > 0").count() if phrases else 0
            scores = self.scores(query, repo=repo, branch=branch, id_words=id_words)
            return Found(top_by(scores, "keyword_score", limit), n, n)
        stats = self.stats(id_words).first()
        asked: dict[str, int] = {}
        for phrase in phrases:
            asked[phrase[0]] = asked.get(phrase[0], 0) + 1
        # A row per block, without its postings.
        narrow = staged(blocks.select("segment", "term", "range", "n", "dead", "peaks"), "bounds")
        frequent = narrow.groupBy("term").agg(F.sum(F.col("n") - F.col("dead")).alias("df")).collect()
        if stats["total"] < 1 or not frequent:
            return Found(self.scores("", id_words=id_words), 0, 0)
        weight = F.create_map(*[
            x for term, df in frequent
            for x in (F.lit(term), F.lit(asked[term]) * idf(F.lit(stats["total"]), F.lit(float(df))))
        ])[F.col("term")]

        def part(tf: Column, length: Column) -> Column:
            return weight * saturation(tf.cast("double"), length + id_words, F.lit(stats["mean"]))

        best = F.array_max(F.transform("peaks", lambda p: part(p["tf"], p["length"])))
        ranges = staged(narrow.where("n > 0").groupBy("segment", "range").agg(
            (F.sum(best) * _ROUNDING).alias("bound"), F.count("*").alias("blocks"),
        ), "ranges")

        def hits(wanted: Column, names: list[int] | None = None) -> DataFrame:
            few = blocks if names is None else blocks.where(F.col("range").isin(names))
            chosen = few.join(ranges.where(wanted).select("segment", "range"), ["segment", "range"], "left_semi")
            entries = in_scope(self._entries(chosen, log), repo, branch)
            scores = entries.groupBy("id").agg(F.sum(part(F.col("tf"), F.col("length"))).alias("keyword_score"))
            return top_by(scores, "keyword_score", limit)

        # As many ranges as rows are asked for; the last of their best rows is what others have to reach.
        first = ranges.orderBy(F.col("bound").desc(), "segment", "range").limit(limit).collect()
        enough = F.col("bound") >= min((r["bound"] for r in first), default=0.0)
        found = hits(enough, sorted({r["range"] for r in first}) if len(first) == limit else None).collect()
        reach = F.col("bound") >= (found[-1]["keyword_score"] if len(found) == limit else 0.0)
        names = ranges.where(reach).select("range").distinct().limit(NAMED_RANGES + 1).collect()
        counted = ranges.agg(F.sum("blocks"), F.coalesce(F.sum(F.when(reach | enough, F.col("blocks"))), F.lit(0))).first()
        rows = hits(reach, [r["range"] for r in names] if len(names) <= NAMED_RANGES else None)
        return Found(rows, counted[0] or 0, counted[1])

