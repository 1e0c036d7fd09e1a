"""Mixing sources to target weights, with DataFrame functions only.

Words are counted per source, targets and repetition rates follow from the
counts, and every document is taken floor(rate) times plus once more if its own
hash falls below the fraction. Sixteen such draws come from one digest; of
each source the draw whose total is nearest to its target counts, so small
sources keep close to their share as well. Everything depends on ids and sizes
alone, so a repeated run, also of a lost task, takes the same copies.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.llm.common import WORD, staged

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
DRAWS = 16


def n_words(column: str = "text") -> Column:
    return F.regexp_count(F.coalesce(F.col(column), F.lit("")), F.lit(WORD)).cast("long")


def draws(key: Column) -> list[Column]:
    """Uniform numbers in [0, 1) that depend on the key alone; a null key counts as empty."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    digests = [F.sha2(F.concat(F.lit(f"mix{part}:"), text), 256) for part in range(DRAWS // 8)]
    return [
        F.conv(F.substring(digests[i // 8], i % 8 * 8 + 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))
        for i in range(DRAWS)
    ]


def targets(sizes: DataFrame) -> DataFrame:
    """``source, source_size, target, rate`` from rows of ``source, size``.

    Targets are least(MOST * size, level * weight) with the level at which they
    sum up to the share. With sources ordered by size per weight, the level is
    the greatest of (share - caps before) / (weights from here on). The windows
    without a key see one row per source.
    """
    summed = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in WEIGHTS]),
        ((F.row_number().over(by_name) - 1) % len(WEIGHTS) + 1).cast("int"),
    )
    cap = F.col("source_size") * MOST
    order = Window.orderBy(cap / F.col("weight"), F.col("source").asc_nulls_last())
    every = Window.partitionBy(F.lit(1))
    return (
        summed.withColumn("weight", weight)
        .withColumn("before", F.sum(cap).over(order) - cap)
        .withColumn("rest", F.sum("weight").over(every) - F.sum("weight").over(order) + F.col("weight"))
        .withColumn("share", F.sum("source_size").over(every) * F.lit(SHARE))
        .withColumn("level", F.max((F.col("share") - F.col("before")) / F.col("rest")).over(every))
        .select(
            "source", "source_size",
            F.least(cap.cast("double"), F.col("level") * F.col("weight")).alias("target"),
        )
        .withColumn("rate", F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0)))
    )


def copies(rate: Column, draw: Column) -> Column:
    whole = F.floor(rate)
    return (whole + F.when(draw < rate - whole, 1).otherwise(0)).cast("long")


def mixing_plan(sizes: DataFrame) -> DataFrame:
    """``targets`` with the number of the draw that counts in each source; staged, one row per source.

    Joins with it are plain: Spark broadcasts it while its files are below the
    limit and joins by source, splitting hot ones, beyond it.
    """
    plan = staged(targets(sizes), "targets")
    joined = sizes.join(plan, sizes.source.eqNullSafe(plan.source)).select(plan["*"], "doc_id", "size")
    keys = ["source", "source_size", "target", "rate"]
    totals = joined.groupBy(*keys).agg(*[
        F.sum(F.col("size") * copies(F.col("rate"), u)).alias(f"t{i}")
        for i, u in enumerate(draws(F.col("doc_id")))
    ])
    ranked = F.array_sort(F.array(*[
        F.struct(F.abs(F.col(f"t{i}") - F.col("target")).alias("off"), F.lit(i).alias("draw"))
        for i in range(DRAWS)
    ]))
    return staged(totals.select(*keys, F.element_at(ranked, 1)["draw"].alias("draw")), "mix")


def with_copies(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """``sized`` rows of ``doc_id, source`` and more, as ``row, plan, copies``.

    Nulls form a source of their own, a null or blank text has size 0, and rows
    repeated under one id are drawn alike.
    """
    right = plan.select(F.struct("*").alias("plan"))
    rows = sized.select(F.struct("*").alias("row"))
    draw = F.element_at(F.array(*draws(F.col("row.doc_id"))), F.col("plan.draw") + 1)
    return rows.join(right, F.col("row.source").eqNullSafe(F.col("plan.source"))).select(
        "row", "plan", copies(F.col("plan.rate"), draw).alias("copies")
    )


def mixed_sizes(docs: DataFrame) -> DataFrame:
    """Per document how many words the mix takes of it; repeats count."""
    sizes = staged(docs.select("doc_id", "source", n_words().alias("size")), "sizes")
    return with_copies(sizes, mixing_plan(sizes)).select(
        "row.doc_id", "row.size", "plan.source_size", "plan.target",
        (F.col("row.size") * F.col("copies")).alias("taken"),
    )


def mix(docs: DataFrame) -> DataFrame:
    """The mix itself: each document as often as it is taken, with the columns of ``docs``."""
    sizes = staged(docs.select("doc_id", "source", n_words().alias("size")), "sizes")
    rows = with_copies(docs, mixing_plan(sizes)).where("copies > 0")
    return rows.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")


def _sql_draws() -> str:
    return ", ".join(
        f"('0x' || substr(sha256('mix{i // 8}:' || coalesce(doc_id::VARCHAR, '')), {i % 8 * 8 + 1}, 8))::BIGINT"
        f"::DOUBLE / 4294967296.0" for i in range(DRAWS)
    )


_TOTALS = ", ".join(
    f"sum(size * (floor(rate) + CASE WHEN u[{i + 1}] < rate - floor(rate) THEN 1 ELSE 0 END)) AS t{i}"
    for i in range(DRAWS)
)
_NEAREST = "least(" + ", ".join(f"abs(t{i} - target)" for i in range(DRAWS)) + ")"
_DRAW = "CASE " + " ".join(f"WHEN abs(t{i} - target) = best THEN {i + 1}" for i in range(DRAWS)) + " END"

SQL = rf"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         [{_sql_draws()}] AS u FROM documents),
summed AS (SELECT source, sum(size) AS source_size FROM sized GROUP BY source),
weighed AS (SELECT *, [3.0, 1.0, 2.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight FROM summed),
levels AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE
             - (sum(2 * source_size) OVER w - 2 * source_size))
            / (sum(weight) OVER () - sum(weight) OVER w + weight) AS level
  FROM weighed WINDOW w AS (ORDER BY 2 * source_size / weight, source NULLS LAST)),
aimed AS (SELECT source, source_size, least(2.0::DOUBLE * source_size, max(level) OVER () * weight) AS target FROM levels),
rated AS (SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE target / source_size END AS rate FROM aimed),
joined AS (SELECT s.doc_id, s.size, s.u, r.* FROM sized s JOIN rated r ON s.source IS NOT DISTINCT FROM r.source),
totals AS (SELECT source, target, {_TOTALS} FROM joined GROUP BY source, target),
nearest AS (SELECT *, {_NEAREST} AS best FROM totals),
chosen AS (SELECT source, {_DRAW} AS draw FROM nearest)
SELECT doc_id, size::BIGINT AS size, source_size::BIGINT AS source_size, target::DOUBLE AS target,
       (size * (floor(rate) + CASE WHEN u[draw] < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM joined j JOIN chosen c ON j.source IS NOT DISTINCT FROM c.source
"""
