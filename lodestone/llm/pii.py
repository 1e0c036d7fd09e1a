"""Spans of personal data by weak supervision, with DataFrame functions only.

Four kinds have an exact rule: their matches that pass the check are base spans.
Around them lies a wider set of candidates: key- and password-like tokens, and
numbers and addresses that the exact rules leave out. Labelers look at every
candidate and vote for, against, or not at all: patterns, gazetteers of domain
endings and of cue words, and the context before the span. Votes are counted by
pattern, of which there are at most 3^labelers; on that bounded table
expectation-maximisation estimates how reliable each labeler is, and its soft
labels train a logistic span classifier. Candidates it accepts are added under
kinds of their own; base spans stay whatever it says.

Matches get their places by splitting the text at them: the pieces between
matches and the matches themselves are laid end to end. Patterns use possessive
repeats and enter a run of characters only at its start or behind the last
match, which finds the same matches in linear time and constant stack.
"""

from __future__ import annotations

from functools import reduce
from math import log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.llm.common import staged

# --- fixed values: kinds in their order, and the patterns of the exact rules ---
KINDS = ("email", "ip", "card", "phone", "key", "secret", "token", "number")
BASE = KINDS[:4]
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    # Wider candidates: runs of capitals and digits, values behind a sign of equality, hexadecimal
    # runs, and groups of digits.
    "key": r"(?<![A-Za-z0-9])[A-Z]{3,6}+[A-Z0-9]{12,40}+(?![A-Za-z0-9])",
    "secret": r"(?<==)[A-Za-z0-9_.-]{8,64}+(?![A-Za-z0-9_.-])",
    "token": r"(?<![A-Za-z0-9=])[0-9a-f]{24,64}+(?![A-Za-z0-9])",
    "number": r"(?<![0-9A-Za-z.+-])[0-9]{2,4}+(?:[\x20./-][0-9]{2,4}){2,4}+(?![0-9A-Za-z])",
}
# A text without these has no match of the pattern.
NEEDED = {
    "email": "@.", "phone": "+", "secret": "=",
}
CUES = (
    "password", "passwd", "pwd", "secret", "token", "key", "apikey", "auth", "login", "user", "phone", "tel",
    "mobile", "fax", "call", "mail", "email", "contact", "ssn", "card", "account", "iban", "passport", "ip",
)
HARMLESS = ("version", "release", "chapter", "section", "page", "figure", "table", "isbn", "date", "item")
DOMAIN_ENDINGS = ("com", "org", "net", "edu", "gov", "info", "biz", "io", "de", "fr", "es", "uk", "eu")
ROUNDS = 12
STEPS = 8
BEFORE_CHARS = 24


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("t"))


def _found(kind: str) -> Column:
    """All leftmost matches of one kind, as text."""
    possible = reduce(
        lambda a, b: a & b, [F.contains("t", F.lit(c)) for c in NEEDED.get(kind, "")], F.lit(True)
    )
    found = F.regexp_extract_all("t", F.lit(PATTERNS[kind]), F.lit(0))
    return F.when(possible, found).otherwise(F.array().cast("array<string>"))


def _laid_out(kind: str) -> Column:
    """``(found, piece)``: each match with the text between it and the one before."""
    found = F.col(f"_{kind}")
    # No match is empty, so pieces and matches alternate.
    pieces = F.slice(F.split("t", PATTERNS[kind], -1), 1, F.size(found))
    rows = F.zip_with(found, pieces, lambda f, p: F.struct(f.alias("found"), p.alias("piece")))
    return F.when(F.size(found) > 0, rows).otherwise(
        F.array().cast("array<struct<found:string,piece:string>>")
    )


def _digits(column: str) -> Column:
    return F.regexp_replace(F.col(column), "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    values = F.transform(F.split(F.reverse(digits), ""), lambda c: F.coalesce(c.try_cast("int"), F.lit(0)))
    doubled = F.transform(values, lambda v, i: F.when(i % 2 == 1, F.when(v > 4, v * 2 - 9).otherwise(v * 2)).otherwise(v))
    return F.aggregate(doubled, F.lit(0), lambda s, v: s + v) % 10 == 0


def _valid() -> Column:
    """Whether a match of a base kind passes its check; no match of another kind has one."""
    n = F.length(_digits("found"))
    parts = F.transform(
        F.split("found", r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "")
    )
    small = F.forall(parts, lambda p: (F.length(p) <= 3) & (p.try_cast("int") <= 255))
    return (
        F.when(F.col("kind") == "email", True)
        .when(F.col("kind") == "ip", small)
        .when(F.col("kind") == "card", n.between(16, 19) & _luhn(_digits("found")))
        .when(F.col("kind") == "phone", n.between(8, 15))
        .otherwise(False)
    )


def candidates(docs: DataFrame) -> DataFrame:
    """``doc_id, row_key, kind, start, end, found, before, valid``: one row per match of any pattern.

    A text without a match of the first kind has a row of that kind without ``found``, so each
    row of ``docs`` is there.

    Only matches leave the scan of the texts. Places follow from running sums of
    the lengths of pieces and matches, over the matches of one kind in one row.
    """
    texts = _texts(docs).withColumn("row_key", F.monotonically_increasing_id())
    texts = texts.withColumns({f"_{k}": _found(k) for k in KINDS})
    kinds = F.array(*[
        F.struct(F.lit(k).alias("kind"), F.lit(i).alias("rank"), _laid_out(k).alias("rows"))
        for i, k in enumerate(KINDS)
    ])
    hits = texts.select("doc_id", "row_key", F.explode(kinds).alias("k")).select(
        "doc_id", "row_key", "k.kind", "k.rank", F.posexplode_outer("k.rows").alias("at", "m")
    ).where("m is not null or rank = 0").select(
        "doc_id", "row_key", "kind", "rank", "at", F.col("m.found").alias("found"),
        F.length("m.piece").cast("long").alias("gap"),
        F.right("m.piece", F.lit(BEFORE_CHARS)).alias("before"),
    )
    # A text has few matches in proportion to its length; one that is all matches is a partition of its own.
    order = Window.partitionBy("row_key", "kind").orderBy("at")
    end = F.sum(F.col("gap") + F.length("found")).over(order)
    return hits.withColumn("end", end).withColumn("start", F.col("end") - F.length("found")).withColumn(
        "valid", _valid()
    ).select("doc_id", "row_key", "kind", "rank", "start", "end", "found", "before", "valid")


def _votes() -> dict[str, Column]:
    """What each labeler says of a candidate: 1, -1, or 0 for nothing."""
    found, before = F.lower("found"), F.lower("before")
    n, letters = F.length(_digits("found")), F.col("found").rlike("[A-Za-z]")
    mixed = letters & (n > 0)
    cue = rf"(?:{'|'.join(CUES)})[^a-z0-9]{{0,3}}$"
    harmless = rf"(?:{'|'.join(HARMLESS)})[^a-z0-9]{{0,3}}$"
    ending = F.regexp_extract(found, r"\.([a-z]+)$", 1)
    return {
        "rule": F.when(F.col("valid"), 1).when(F.col("kind").isin(*BASE), -1).otherwise(0),
        "length": F.when(F.length("found") >= 16, 1).when(F.length("found") < 10, -1).otherwise(0),
        "mixture": F.when(mixed & (n >= 4), 1).when(letters & (n == 0), -1).otherwise(0),
        "prefix": F.when(F.col("found").rlike("^(?:AKIA|ASIA|AIza|ghp_|sk-|xox)"), 1).otherwise(0),
        "ending": F.when(ending.isin(*DOMAIN_ENDINGS), 1).when((F.col("kind") == "email") & (ending != ""), 0).otherwise(0),
        "context": F.when(before.rlike(cue), 1).when(before.rlike(harmless), -1).otherwise(0),
        "grouping": F.when(F.col("found").rlike(r"^[0-9]{1,4}[./-][0-9]{1,2}[./-][0-9]{1,4}$"), -1)
        .when(F.col("found").rlike(r"^\+|^[0-9.]+$|@") & (n >= 4) & F.col("valid"), 1).otherwise(0),
    }


def _weights(patterns: DataFrame, names: list[str]) -> dict[str, float]:
    """Weights of the span classifier, learned from counts of vote patterns.

    ``patterns`` has a row per pattern that occurs, with its count ``n``. Every
    round is one aggregation over that table, of which one row of sums is read.
    """
    lit = F.lit
    right = {v: 0.75 for v in names}
    share = 0.5

    def chance(right, share):
        """Log odds that a pattern is a span, given the reliabilities."""
        odds = lit(_logit(share))
        for v in names:
            odds = odds + F.col(v) * lit(_logit(right[v]))
        return 1 / (1 + F.exp(-odds))

    for _ in range(ROUNDS):
        p = chance(right, share)
        sums = patterns.agg(
            F.sum(p * F.col("n")).alias("yes"), F.sum("n").alias("all"),
            *[F.sum(F.when(F.col(v) != 0, F.col("n") * F.when(F.col(v) == 1, p).otherwise(1 - p)).otherwise(0)).alias(f"r_{v}") for v in names],
            *[F.sum(F.when(F.col(v) != 0, F.col("n")).otherwise(0)).alias(f"n_{v}") for v in names],
        ).first()
        # One vote each way stands for what has not been seen; a labeler is never worse than chance.
        share = (sums["yes"] + 1) / (sums["all"] + 2)
        right = {v: max((sums[f"r_{v}"] + 3) / (sums[f"n_{v}"] + 4), 0.5) for v in names}

    target, weights = chance(right, share), {v: 0.0 for v in ["bias", *names]}
    fixed = patterns.withColumn("target", target).withColumn("bias", lit(1.0))
    total = sums["all"] or 1
    for _ in range(STEPS):
        # A step by coordinates needs the first two derivatives, which are sums as well.
        z = reduce(lambda a, b: a + b, [F.col(v) * lit(w) for v, w in weights.items()])
        p = 1 / (1 + F.exp(-z))
        found = fixed.agg(*[
            F.sum(F.col("n") * (F.col("target") - p) * F.col(v)).alias(f"g_{v}") for v in weights
        ], *[
            F.sum(F.col("n") * p * (1 - p) * F.col(v) * F.col(v)).alias(f"h_{v}") for v in weights
        ]).first()
        for v in weights:
            step = ((found[f"g_{v}"] or 0) - 1e-3 * total * weights[v]) / ((found[f"h_{v}"] or 0) + 1e-2 * total)
            weights[v] += max(-1.5, min(1.5, step / 2))
    return weights


def _logit(p: float) -> float:
    p = min(max(p, 1e-4), 1 - 1e-4)
    return log(p / (1 - p))


def spans(docs: DataFrame) -> DataFrame:
    """``doc_id, row_key, kind, rank, start, end, base``: all spans of all rows, from the operator's model.

    A row of ``docs`` is named by its ``row_key``, and has a row without a span as well. Of added spans those that overlap a base span, or one of an earlier kind
    that was added, are left out, as they say the same twice.
    """
    votes = _votes()
    every = staged(candidates(docs).withColumns(votes), "candidates")
    rows = every.where("found is not null")
    patterns = staged(rows.groupBy(*votes).agg(F.count("*").alias("n")), "votes")
    weights = _weights(patterns, list(votes)) if patterns.head(1) else {"bias": 0.0}
    z = reduce(lambda a, b: a + b, [
        F.lit(w) * (F.lit(1.0) if v == "bias" else F.col(v)) for v, w in weights.items()
    ])
    wider = ~F.col("kind").isin(*BASE)
    taken = rows.where(F.col("valid") | (wider & (z > 0)))
    # Spans of a row by place: one that begins before the furthest end so far overlaps.
    by_rank = Window.partitionBy("row_key").orderBy("start", F.col("end").desc(), "rank").rowsBetween(
        Window.unboundedPreceding, -1
    )
    after = Window.partitionBy("row_key").orderBy(F.col("start").desc(), F.col("end"), F.col("rank").desc()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    placed = taken.withColumn("reach", F.max("end").over(by_rank)).withColumn(
        "next", F.min(F.when(F.col("valid"), F.col("start"))).over(after)
    )
    clear = (F.coalesce("reach", F.lit(0)) <= F.col("start")) & (
        F.coalesce("next", F.col("end")) >= F.col("end")
    )
    return placed.where(F.col("valid") | clear).select(
        "doc_id", "row_key", "kind", "rank", "start", "end", F.col("valid").alias("base")
    ).unionByName(every.where("rank = 0").select("doc_id", "row_key").distinct(), allowMissingColumns=True)


def span_digests(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` the counts and digest of its base spans, and all its spans.

    Null and empty texts have none. Rows under one id, or without one, have the spans
    of their own text each.
    """
    def listed(condition: Column) -> Column:
        items = F.array_sort(F.collect_set(F.when(condition, F.struct("rank", "start", "end", "kind"))))
        return F.array_join(F.transform(items, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string")
        )), ",")

    is_base = F.coalesce("base", F.lit(False))
    return spans(docs).groupBy("row_key").agg(
        F.max("doc_id").alias("doc_id"),
        *[F.count_distinct(F.when(is_base & (F.col("kind") == k), F.struct("start", "end"))).alias(f"n_{k}") for k in BASE],
        F.sha2(listed(is_base), 256).alias("base_sha256"), listed(F.col("kind").isNotNull()).alias("spans"),
    ).drop("row_key")
