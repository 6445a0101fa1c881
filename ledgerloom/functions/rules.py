"""Ordered regular-expression rules: first match wins, as one short-circuit CASE."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom import registries as R

from .text import lookup

Rules = Sequence[tuple[str, str]]


def first_match(text: Column, rules: Rules, default: str | None = R.OTHER) -> Column:
    out = None
    for label, pattern in rules:
        out = (F.when if out is None else out.when)(text.rlike(pattern), F.lit(label))
    return out.otherwise(F.lit(default)) if out is not None else F.lit(default)


def explain(text: Column, rules: Rules, default: str | None = R.OTHER) -> Column:
    """struct<label, matched>: the winning rule and the text that it matched."""
    out = None
    for label, pattern in rules:
        hit = F.struct(F.lit(label).alias("label"), F.regexp_extract(text, pattern, 0).alias("matched"))
        out = (F.when if out is None else out.when)(text.rlike(pattern), hit)
    return out.otherwise(F.struct(F.lit(default).alias("label"), F.lit(None).cast("string").alias("matched")))


def category(text: Column) -> Column:
    return first_match(text, R.CATEGORY_RULES)


def subcategory(text: Column) -> Column:
    return first_match(text, R.SUBCATEGORY_RULES)


def subcategory_of_component(text: Column) -> Column:
    return lookup(R.CATEGORY_TO_SUBCATEGORY, category(text))


def horizon(bucket: Column) -> Column:
    return F.when(bucket.isin(*R.NEAR_TERM), "near_term").when(bucket == "reserve", "reserve")


def coverage(df: DataFrame, label: Column, default: str = R.OTHER) -> DataFrame:
    """n, matched and matched_pct (half-even) of a classification; partial sums, one row."""
    hit = F.count_if(F.coalesce(label, F.lit(default)) != default)
    return df.agg(F.count("*").alias("n"), hit.alias("matched")).withColumn("matched_pct", F.bround(F.lit(100.0) * F.col("matched") / F.greatest(F.lit(1), F.col("n")), 1))


def unmatched(df: DataFrame, label: Column, order: str, n: int = 25, default: str = R.OTHER) -> DataFrame:
    """The first rows, in a stated order, that no rule knows."""
    return df.where(F.coalesce(label, F.lit(default)) == default).orderBy(order).limit(n)


def vote(df: DataFrame, key: str, text: str, rules: Rules, order: str) -> DataFrame:
    """Per key the label that most rows show; ties go to the earliest row, then to the earlier rule."""
    hits = [F.when(F.col(text).rlike(p), F.struct(F.lit(i).alias("rank"), F.lit(label).alias("label"))) for i, (label, p) in enumerate(rules)]
    long = df.select(key, order, F.explode(F.filter(F.array(*hits), lambda h: h.isNotNull())).alias("h"))
    counts = long.groupBy(key, "h.rank", "h.label").agg(F.count("*").alias("hits"), F.min(order).alias("first"))
    best = F.max_by(F.struct("label", "hits"), F.struct("hits", (-F.col("first")).alias("f"), (-F.col("rank")).alias("r")))
    return counts.groupBy(key).agg(best.alias("b")).select(key, "b.label", "b.hits")
