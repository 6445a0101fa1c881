"""Corrections merged into records, key backfill, gold-set accuracy, suspects worth a review."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom import registries as R


def apply_verdicts(cells: DataFrame, verdicts: DataFrame, key: str = "property_id", field: str = "field") -> DataFrame:
    """Long cells with corrected values where a verdict rejects one and has another; unresolved where it has none."""
    v = verdicts.select(key, F.col("key").alias(field), "ok", "corrected_value")
    bad = ~F.coalesce("ok", F.lit(True))
    fixed = F.when(bad & F.col("corrected_value").isNotNull(), F.col("corrected_value")).otherwise(F.col("value"))
    return cells.join(v, [key, field], "left").withColumns({"value": fixed, "unresolved": bad & F.col("corrected_value").isNull()}).drop("ok", "corrected_value")


def merge_partial_rows(rows: DataFrame, patches: DataFrame, keys: list[str], fields: list[str], patch: str = "patch") -> DataFrame:
    """Fields that a patch (map of strings) holds override the row's, null included; keys are never patched."""
    p = F.col(patch)
    kinds = dict(rows.dtypes)
    joined = rows.join(patches.select(*keys, patch), keys, "left")
    new = {f: F.when(F.coalesce(F.map_contains_key(p, f), F.lit(False)), F.try_element_at(p, F.lit(f)).try_cast(kinds[f])).otherwise(F.col(f)) for f in fields if f not in keys}
    return joined.withColumns(new).select(*rows.columns)


def backfill_key(df: DataFrame, group: str, key: str, order: str) -> DataFrame:
    """A null key takes the group's first known one."""
    first = df.where(F.col(key).isNotNull()).groupBy(group).agg(F.min_by(key, order).alias("__first"))
    return df.join(first, group, "left").withColumn(key, F.coalesce(key, "__first")).drop("__first")


def accuracy(gold: DataFrame, predicted: DataFrame, correct: Column, key: str = "id", field: str = "field") -> DataFrame:
    """field, n, n_correct, share; the row with a null field is the total."""
    j = gold.withColumnRenamed("value", "gold").join(predicted.withColumnRenamed("value", "predicted"), [key, field], "left")
    return j.withColumn("ok", correct).rollup(field).agg(F.count("*").alias("n"), F.count_if("ok").alias("n_correct")).withColumn("share", F.col("n_correct") / F.col("n"))


def top_suspects(scored: DataFrame, group: str, member: str, weight: str, k: int = 4) -> DataFrame:
    """The k heaviest members of each group, each by its largest weight; ties by name."""
    best = scored.groupBy(group, member).agg(F.max(weight).alias(weight))
    w = Window.partitionBy(group).orderBy(F.col(weight).desc(), member)
    return best.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def suspect_systems(systems: DataFrame, issues: DataFrame, k: int = 4) -> DataFrame:
    """The systems rows to look at first. Weights: a failed check of the row 3 (a category 1); of assessed rows with cost: no rating 2, else no
    source 2, else a priority subcategory 1. issues name rows by row_idx, systems has it; shape issues name no row."""
    failed = issues.where((F.col("layer") == "systems") & F.col("row_idx").isNotNull()).select("property_id", "row_idx", F.when(F.col("kind") == "category", 1).otherwise(3).alias("weight"))
    failed = failed.groupBy("property_id", "row_idx").agg(F.max("weight").alias("weight")).join(systems.select("property_id", "row_idx", "subcategory"), ["property_id", "row_idx"]).where(F.col("subcategory").isNotNull())
    money = [c for c in systems.columns if c.endswith("_usd") and "per_unit" not in c]
    costed = F.greatest(*(F.coalesce(F.col(c).try_cast("double"), F.lit(0.0)) for c in money), F.lit(0.0)) > 0
    unsourced = F.col("source_sections").isNull() | (F.col("source_sections") == "")
    weight = F.when(F.col("condition").isNull() & F.col("condition_rating_numeric").isNull(), 2).when(unsourced, 2).when(F.col("subcategory").isin(*R.PRIORITY), 1)
    own = systems.where(F.col("assessed") & costed & weight.isNotNull()).select("property_id", "subcategory", weight.alias("weight"))
    return top_suspects(failed.select("property_id", "subcategory", "weight").unionByName(own), "property_id", "subcategory", "weight", k)


def suspect_fields(*sources: DataFrame) -> DataFrame:
    """Union of (property_id, field) over failed checks, ungrounded and low-confidence cells, each once."""
    out = sources[0].select("property_id", "field")
    for s in sources[1:]:
        out = out.unionByName(s.select("property_id", "field"))
    return out.distinct()
