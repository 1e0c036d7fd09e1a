"""Keyword search over chunk rows: BM25, substring match, and English text match."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce
from itertools import accumulate
from operator import and_, or_

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestone import config as C
from lodestone.functions.analysis import WORD, fold_text, lexeme, query_phrases, words
from lodestone.functions.bytesops import let
from lodestone.plans.checkpoint import staged


def in_scope(rows: DataFrame, repo: str | None = None, branch: str | None = None) -> DataFrame:
    """Rows of one repository and branch; either may be left open."""
    if repo is not None:
        rows = rows.where(F.col("repo") == repo)
    if branch is not None:
        rows = rows.where(F.col("branch") == branch)
    return rows


# --- BM25 -------------------------------------------------------------------


def phrase_count(tokens: Column, phrase: list[str]) -> Column:
    """How often ``phrase`` occurs in ``tokens``."""
    if len(phrase) == 1:
        return F.size(F.filter(tokens, lambda t: t == phrase[0]))
    starts = F.sequence(F.lit(0), F.size(tokens) - len(phrase))
    hits = F.filter(
        starts,
        lambda i: reduce(and_, [F.get(tokens, i + k) == w for k, w in enumerate(phrase)]),
    )
    return F.when(F.size(tokens) < len(phrase), F.lit(0)).otherwise(F.size(hits))


def term_counts(text: Column, phrases: list[list[str]]) -> Column:
    """Number of words of ``text`` and the count of each phrase, from one pass."""
    single = sorted({p[0] for p in phrases if len(p) == 1})

    def counts(tokens: Column, wanted: Column) -> Column:
        return F.struct(
            F.size(tokens).alias("length"),
            F.array(
                *[phrase_count(wanted if len(p) == 1 else tokens, p) for p in phrases]
            ).alias("counts"),
        )

    # Single words are counted among the few words that are searched at all.
    return let(
        words(text),
        lambda tokens: let(
            F.filter(tokens, lambda t: t.isin(single)) if single else F.array().cast("array<string>"),
            lambda wanted: counts(tokens, wanted),
        ),
    )


def idf(total: Column, matching: Column) -> Column:
    raw = F.log((total - matching + 0.5) / (matching + 0.5))
    return F.when(raw > 0, raw).otherwise(F.lit(C.BM25_IDF_FLOOR))


def saturation(count: Column, length: Column, mean: Column) -> Column:
    k1, b = C.BM25_K1, C.BM25_B
    return count * (k1 + 1) / (count + k1 * (1 - b + b * length / mean))


def bm25_scores(
    chunks: DataFrame,
    query: str,
    *,
    repo: str | None = None,
    branch: str | None = None,
    id_words: int = 1,
) -> DataFrame:
    """``id, repo, branch, keyword_score`` of the rows that hold any phrase of ``query``.

    Statistics cover the whole table, also when the hits are restricted.
    ``id_words`` is what the indexed id column adds to the length of a row.
    Words are counted once, where the row lies; the counts are written down, and
    statistics and scores come from them.
    """
    phrases = query_phrases(query)
    narrow = chunks.select("id", "repo", "branch")
    if not phrases:
        return narrow.where(F.lit(False)).withColumn("keyword_score", F.lit(0.0))
    counted = staged(
        chunks.select("id", "repo", "branch", term_counts(F.col("chunk"), phrases).alias("_t")), "counts"
    )
    stats = counted.agg(
        F.struct(
            F.count("*").cast("double").alias("total"),
            F.avg(F.col("_t.length") + id_words).alias("mean"),
            F.array(
                *[F.sum((F.get("_t.counts", F.lit(i)) > 0).cast("double")) for i in range(len(phrases))]
            ).alias("matching"),
        )
    )
    hits = in_scope(counted, repo, branch).where(F.exists("_t.counts", lambda n: n > 0))
    # An aggregate without grouping: one value, known before the second pass.
    known = hits.withColumn("_s", stats.scalar())
    score = F.aggregate(
        F.zip_with(
            "_t.counts",
            "_s.matching",
            lambda n, df: F.when(
                n > 0,
                idf(F.col("_s.total"), df)
                * saturation(n.cast("double"), F.col("_t.length") + id_words, F.col("_s.mean")),
            ).otherwise(F.lit(0.0)),
        ),
        F.lit(0.0),
        lambda total, x: total + x,
    )
    return known.select("id", "repo", "branch", score.alias("keyword_score"))


def bm25(chunks: DataFrame, query: str, **scope) -> DataFrame:
    """``chunks`` that hold any phrase of ``query``, with their ``keyword_score``."""
    return chunks.join(bm25_scores(chunks, query, **scope).select("id", "keyword_score"), "id")


# --- postings ---------------------------------------------------------------


def postings(chunks: DataFrame) -> DataFrame:
    """The inverted form of a chunk table: one row per chunk and distinct word.

    Words are grouped inside each row, so nothing is shuffled here.
    """
    found = chunks.select(
        "repo", "branch", "path", "id", F.explode(grouped_words(F.col("chunk"))).alias("p")
    )
    return found.select(
        F.col("p.term").alias("term"), "id", "repo", "branch", "path",
        F.size("p.positions").alias("tf"), F.col("p.positions").alias("positions"),
        F.col("p.length").alias("length"),
    )


def grouped_words(text: Column) -> Column:
    """``term, positions, length`` of each distinct word of ``text``; NULL where there is none."""
    return let(words(text), by_term)


def by_term(tokens: Column) -> Column:
    """Words of one text with their positions: sorted, then cut where the word changes."""
    placed = F.sort_array(
        F.transform(tokens, lambda w, i: F.struct(w.alias("term"), i.alias("at")))
    )
    found = let(placed, lambda rows: runs(rows, lambda term, run: F.struct(
        term.alias("term"),
        F.transform(run, lambda o: o["at"]).alias("positions"),
        F.size(rows).alias("length"),
    )))
    return F.when(F.size(tokens) > 0, found)


def runs(rows: Column, make: Callable[[Column, Column], Column]) -> Column:
    """``make(term, rows of the term)`` for each term of ``rows``, which are sorted by it and not empty."""
    borders = F.filter(
        F.sequence(F.lit(0), F.size(rows) - 1),
        lambda i: (i == 0) | (F.get(rows, i)["term"] != F.get(rows, i - 1)["term"]),
    )
    return let(
        F.concat(borders, F.array(F.size(rows))),
        lambda edges: F.transform(
            F.slice(edges, 1, F.size(edges) - 1),
            lambda start, j: make(
                F.get(rows, start)["term"], F.slice(rows, start + 1, F.get(edges, j + 1) - start)
            ),
        ),
    )


def corpus_stats(chunks: DataFrame, id_words: int = 1) -> DataFrame:
    """One row: number of chunks and their mean length in words.

    An index stores the length, so only that column is read.
    """
    stored = "n_words" in chunks.columns
    length = F.col("n_words") if stored else F.size(words(F.col("chunk")))
    return chunks.agg(
        F.count("*").cast("double").alias("total"), F.avg(length + id_words).alias("mean")
    )


def aligned(starts: str, size: Column) -> Column:
    """How many values occur ``size`` times, which is the most there can be: where a phrase's words line up."""
    return let(F.array_sort(starts), lambda s: F.size(F.filter(
        F.sequence(F.lit(0), F.size(s) - 1), lambda i: F.get(s, i) == F.get(s, i + size - 1)
    )))


def bm25_postings(
    index: DataFrame,
    stats: DataFrame,
    query: str,
    *,
    repo: str | None = None,
    branch: str | None = None,
    id_words: int = 1,
) -> DataFrame:
    """``id, keyword_score`` from stored postings.

    Only the rows of the searched words are read, as the word is a pushed
    filter. A phrase keeps the places where all its words line up. Grouping is
    by chunk and phrase, so a word in every chunk still spreads over all tasks.
    """
    phrases = query_phrases(query)
    kind = T.StructType().add("phrase", T.IntegerType()).add("term", T.StringType()).add(
        "shift", T.IntegerType()).add("size", T.IntegerType())
    if not phrases:
        return index.where(F.lit(False)).select("id", F.lit(0.0).alias("keyword_score"))
    wanted = [
        (i, w, k, len(p)) for i, p in enumerate(phrases) for k, w in enumerate(p)
    ]
    terms = sorted({w for p in phrases for w in p})
    plan = index.sparkSession.createDataFrame(wanted, kind)
    placed = (
        index.where(F.col("term").isin(terms))
        # As many rows as the query has words.
        .join(F.broadcast(plan), "term")
        .select(
            "id", "repo", "branch", "phrase", "size", "length",
            F.transform("positions", lambda at: at - F.col("shift")).alias("starts"),
        )
    )
    if any(len(p) > 1 for p in phrases):
        counted = (
            placed.groupBy("id", "repo", "branch", "phrase", "size", "length")
            .agg(F.flatten(F.collect_list("starts")).alias("starts"))
            .withColumn(
                "n",
                F.when(F.col("size") == 1, F.size("starts")).otherwise(aligned("starts", F.col("size"))),
            )
            .where("n > 0")
        )
    else:
        counted = placed.withColumn("n", F.size("starts"))
    matching = counted.groupBy("phrase").agg(F.count("*").cast("double").alias("df"))
    hits = in_scope(counted, repo, branch)
    # The joined side has one row per phrase of the query.
    scored = hits.join(F.broadcast(matching), "phrase").withColumn(
        "_s", stats.select(F.struct("total", "mean")).scalar()
    )
    part = idf(F.col("_s.total"), F.col("df")) * saturation(
        F.col("n").cast("double"), F.col("length") + id_words, F.col("_s.mean")
    )
    return scored.groupBy("id").agg(F.sum(part).alias("keyword_score"))


# --- substring match --------------------------------------------------------


def like(chunks: DataFrame, query: str, *, repo: str | None = None, branch: str | None = None) -> DataFrame:
    """Rows that contain ``query``, in any case; ``%`` and ``_`` stay wildcards."""
    pattern = F.lit(f"%{query}%" if query else "%")
    matches = F.like(F.lower("chunk"), F.lower(pattern))
    return in_scope(chunks, repo, branch).where(matches).withColumn(
        "keyword_score", F.when(matches, F.lit(1.0)).otherwise(F.lit(0.0))
    )


def top_by(rows: DataFrame, score: str, limit: int) -> DataFrame:
    """The best rows, equal scores by id; partial tops are taken before the merge."""
    return rows.orderBy(F.col(score).desc(), F.col("id")).limit(limit)


def keyword_search(
    chunks: DataFrame,
    query: str,
    limit: int,
    *,
    repo: str | None = None,
    branch: str | None = None,
    id_words: int = 1,
) -> DataFrame:
    """``id, keyword_score`` of the best BM25 rows, or of rows that contain the query when no word matches."""
    if query_phrases(query):
        hits = bm25_scores(chunks, query, repo=repo, branch=branch, id_words=id_words)
        best = staged(top_by(hits.select("id", "keyword_score"), "keyword_score", limit), "hits")
        if not best.isEmpty():
            return best
    found = like(chunks, query, repo=repo, branch=branch).select("id", "keyword_score")
    return top_by(found, "keyword_score", limit)


# --- English text match -----------------------------------------------------


def web_query(query: str, english: bool = True) -> list[list[tuple[list[str], bool]]]:
    """Alternatives of a search line, each a list of (words, excluded).

    Quotes make a phrase, ``or`` an alternative and a leading ``-`` excludes. A
    stop word inside a phrase leaves an empty place.
    """
    reduce_word = lexeme if english else (lambda w: w)
    alternatives: list[list[tuple[list[str], bool]]] = [[]]
    for minus, quoted, bare in re.findall(r'(-?)(?:"([^"]*)"?|([^\s"]+))', query or ""):
        if bare.lower() == "or" and not minus:
            alternatives.append([])
            continue
        found = re.findall(r"[^\W_]+", (quoted or bare).lower())
        stems = [reduce_word(w) for w in found]
        while stems and not stems[0]:
            stems.pop(0)
        while stems and not stems[-1]:
            stems.pop()
        if stems:
            alternatives[-1].append((stems, bool(minus)))
    return [a for a in alternatives if any(not excluded for _, excluded in a)]


def text_matches(lexemes: Column, query: list[list[tuple[list[str], bool]]]) -> Column:
    """Whether a list of lexemes satisfies a web query."""

    def holds(lexemes: Column, stems: list[str]) -> Column:
        if len(stems) == 1:
            return F.array_contains(lexemes, stems[0])
        present = reduce(and_, [F.array_contains(lexemes, s) for s in stems if s])
        aligned = F.exists(
            F.sequence(F.lit(0), F.greatest(F.size(lexemes) - len(stems), F.lit(0))),
            lambda i: reduce(
                and_, [F.get(lexemes, i + k) == s for k, s in enumerate(stems) if s]
            ),
        )
        return present & F.coalesce(aligned, F.lit(False))

    def satisfied(row: Column) -> Column:
        return reduce(
            or_,
            [
                reduce(and_, [~holds(row, s) if excluded else holds(row, s) for s, excluded in a])
                for a in query
            ],
        )

    return let(lexemes, satisfied) if query else F.lit(False)


COVER_WEIGHT = 0.1


def _phrase_ends(row: list[str], phrases: list[tuple[str, ...]]) -> dict[int, list[int]]:
    """By position, which of ``phrases`` end there; an empty word of a phrase stands for any."""
    by_last: dict[str, list[int]] = {}
    for n, words_ in enumerate(phrases):
        by_last.setdefault(words_[-1], []).append(n)
    found: dict[int, list[int]] = {}
    for at, word in enumerate(row):
        for n in by_last.get(word, ()):
            first = at - len(phrases[n]) + 1
            if first >= 0 and all(not w or row[first + k] == w for k, w in enumerate(phrases[n])):
                found.setdefault(at, []).append(n)
    return found


def cover_density(row: list[str] | None, query: list[list[tuple[list[str], bool]]]) -> float:
    """Sum over the shortest stretches that satisfy the query; closer words weigh more.

    One walk over the places where phrases end. Where each phrase began last is known, so
    the shortest stretch to here begins where the earliest of an alternative's phrases does; it
    counts if it begins behind the start of the one before. Time is linear in the text.
    """
    wanted = [[tuple(s) for s, excluded in a if not excluded] for a in query]
    phrases = sorted({s for a in wanted for s in a})
    if not row or not phrases:
        return 0.0
    number = {s: n for n, s in enumerate(phrases)}
    alternatives = [[number[s] for s in a] for a in wanted if a]
    ends = _phrase_ends(row, phrases)
    marked = bytearray(len(row))
    for at, found in ends.items():
        for n in found:
            for k, word in enumerate(phrases[n]):
                if word:
                    marked[at - len(phrases[n]) + 1 + k] = 1
    # How many words of any phrase stand before each position.
    before = [0, *accumulate(marked)]
    began = [-1] * len(phrases)
    total, last = 0.0, -1
    for at, found in ends.items():
        for n in found:
            began[n] = at - len(phrases[n]) + 1
        begin = max(min(began[n] for n in a) for a in alternatives)
        if begin > last:
            entries = before[at + 1] - before[begin]
            total += COVER_WEIGHT / (1 + (at - begin) - (entries - 1))
            last = begin
    return total


def cover_rank(lexemes: Column, query: list[list[tuple[list[str], bool]]]) -> Column:
    """Cover density per row; meant for rows that match."""

    @F.arrow_udf(T.DoubleType())
    def rank(rows: pa.Array) -> pa.Array:
        return pa.array([cover_density(r, query) for r in rows.to_pylist()], pa.float64())

    return rank(lexemes)
