"""Mixing sources to target weights, in DataFrame operations only.

Sizes are summed per source (partial sums before the shuffle, so that a hot source costs one row a task). The targets
share the total by weight, none above CAP times its source's size; the excess goes round by weight until none is above.
A source's repetition rate is target / size; each of its documents is taken floor(rate) times, and once more with
probability equal to the fraction, decided by a hash of seed and doc_id, so that reruns and retried tasks agree.

Null or blank texts have size 0 and take nothing. Null sources are one source, ordered last. Rows that repeat a doc_id
decide alike. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import n_words, prepare, table

WEIGHTS = (5, 2, 1)
CAP = 3
SEED = 7
#: Sources up to this number are broadcast (a row is a name and four numbers); more are joined by shuffle.
BROADCAST_SOURCES = 10_000


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """source, source_size -> source, source_size, target. One row a source: the windows see sources, not documents."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    s = sizes.withColumn("__w", w.cast("long")).withColumn("__cap", F.col("source_size") * cap)
    order = Window.orderBy((F.col("__cap") / F.col("__w")).asc(), F.col("source").asc_nulls_last())
    before, every = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("__cap").over(before), F.lit(0))
    weight = F.sum("__w").over(every) - F.coalesce(F.sum("__w").over(before), F.lit(0))
    full = F.col("__cap").cast("double") <= F.col("__level") * F.col("__w")
    s = s.withColumn("__level", left.cast("double") / weight).withColumn("__full", full)
    rest = F.sum("source_size").over(every) - F.coalesce(F.sum(F.when(F.col("__full"), F.col("__cap"))).over(every), F.lit(0))
    share = rest.cast("double") / F.sum(F.when(~F.col("__full"), F.col("__w"))).over(every)
    return s.withColumn("target", F.when(F.col("__full"), F.col("__cap").cast("double")).otherwise(share * F.col("__w"))).select("source", "source_size", "target")


def decide(docs: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP, seed: int = SEED, prefix: str = "mix") -> DataFrame:
    """The documents with size, source_size, target and copies beside their own columns; prefix sets the new names apart."""
    prepare(docs.sparkSession)
    size, total, target = (F.col(f"`{prefix}_{x}`") for x in ("size", "source_size", "target"))
    sized = docs.withColumn(f"{prefix}_size", n_words(F.col("text")))
    per_source = sized.groupBy("source").agg(F.sum(size).alias("source_size"))
    plan = targets(per_source, weights, cap).select(F.col("source").alias(f"{prefix}_source"), F.col("source_size").alias(f"{prefix}_source_size"), F.col("target").alias(f"{prefix}_target")).checkpoint()
    side = F.broadcast(plan) if plan.count() <= BROADCAST_SOURCES else plan
    rate = F.coalesce(F.try_divide(target, total), F.lit(0.0))
    u = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))), 1, 13), 16, 10).cast("double") / float(16**13)
    return (
        sized.join(side, sized["source"].eqNullSafe(side[f"{prefix}_source"]), "left").drop(f"{prefix}_source")
        .withColumn(f"{prefix}_copies", (F.floor(rate) + (u < rate - F.floor(rate)).cast("int")).cast("int"))
    )


def apply(docs: DataFrame, **how) -> DataFrame:
    """The mix itself: each document as often as it is taken, with its own columns, whatever their names."""
    prefix = "mix"
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix += "_"
    copies = F.col(f"`{prefix}_copies`")
    taken = decide(docs, prefix=prefix, **how).where(copies > 0)
    return taken.withColumn(f"{prefix}_copy", F.explode(F.sequence(F.lit(1), copies))).select(*(F.col(f"`{c}`") for c in docs.columns))


def query(spark, sf_dir: str) -> DataFrame:
    d = decide(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return d.select("doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"), F.col("mix_target").alias("target"), (F.col("mix_size") * F.col("mix_copies")).alias("taken"))


ORACLE_SQL = rf"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents
), per_source AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, CAST([5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)] AS BIGINT) AS w
  FROM sized GROUP BY source
), levels AS (
  SELECT *, {CAP} * source_size AS cap,
    CAST(sum(source_size) OVER () - coalesce(sum({CAP} * source_size) OVER before, 0) AS DOUBLE)
      / CAST(sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS DOUBLE) AS level
  FROM per_source
  WINDOW before AS (ORDER BY CAST({CAP} * source_size AS DOUBLE) / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), filled AS (SELECT *, CAST(cap AS DOUBLE) <= level * w AS is_full FROM levels), targets AS (
  SELECT source, source_size, CASE WHEN is_full THEN CAST(cap AS DOUBLE)
    ELSE CAST(sum(source_size) OVER () - coalesce(sum(cap) FILTER (is_full) OVER (), 0) AS DOUBLE) / CAST(sum(w) FILTER (NOT is_full) OVER () AS DOUBLE) * w END AS target
  FROM filled
), rated AS (
  SELECT doc_id, size, source_size, target, CASE WHEN source_size = 0 THEN 0 ELSE target / source_size END AS rate,
    CAST(CAST('0x' || substr(md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) AS DOUBLE) / {16**13}.0 AS u
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
)
SELECT doc_id, size, source_size, target, size * CAST(floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END AS BIGINT) AS taken FROM rated
"""
