"""Row checks as one long table of issues: types, ranges, categories, dates, contradictions, shape of groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom import registries as R

ISSUE = "property_id string, layer string, row_idx int, field string, kind string, detail string"
DATE = r"^\d{4}-\d{2}-\d{2}$"
MEASURES = "condition condition_rating_numeric rul_years immediate_repairs_usd short_term_repairs_usd non_critical_repairs_usd replacement_reserves_usd action_required".split()


def out_of_range(x: Column, lo: float, hi: float) -> Column:
    return F.coalesce((x < lo) | (x > hi), F.lit(False))


def not_allowed(x: Column, allowed: list[str]) -> Column:
    """The parts of a ;-joined value that the vocabulary doesn't have."""
    parts = F.transform(F.split(x, ";"), lambda p: F.lower(F.trim(p)))
    return F.filter(parts, lambda p: (p != "") & ~p.isin(*allowed))


def bad_date(x: Column) -> Column:
    return F.coalesce(~x.rlike(DATE), F.lit(False))


def contradictions(names: list[str], assessed: str = "assessed") -> Column:
    """Names of the fields that a row carries although it wasn't assessed (null isn't false)."""
    return F.when(F.col(assessed) == False, F.array_compact(F.array(*(F.when(F.col(n).isNotNull(), F.lit(n)) for n in names)))).otherwise(F.array().cast("array<string>"))  # noqa: E712


def issues(df: DataFrame, key: str, layer: str, bounds: dict[str, tuple[float, float]] | None = None, categories: dict[str, list[str]] | None = None, dates: list[str] | None = None, more: list[tuple[str, str, Column]] | None = None, row_idx: Column | None = None) -> DataFrame:
    """All checks of a layer in one scan. more: field, kind and a condition."""
    found: list[Column] = []

    def add(field: str, kind: str, bad: Column, detail: Column) -> None:
        found.append(F.when(bad, F.struct(F.lit(field).alias("field"), F.lit(kind).alias("kind"), detail.cast("string").alias("detail"))))

    for f, (lo, hi) in (bounds or {}).items():
        if f in df.columns:
            add(f, "range", out_of_range(F.col(f), lo, hi), F.col(f))
    for f, allowed in (categories or {}).items():
        if f in df.columns:
            bad = not_allowed(F.col(f), allowed)
            add(f, "category", F.coalesce(F.size(bad) > 0, F.lit(False)), F.array_join(bad, "; "))
    for f in dates or []:
        add(f, "date", bad_date(F.col(f)), F.col(f))
    for f, kind, bad in more or []:
        add(f, kind, F.coalesce(bad, F.lit(False)), F.lit(kind))
    every = F.filter(F.array(*found), lambda x: x.isNotNull())
    at = row_idx if row_idx is not None else F.lit(None).cast("int")
    return df.select(F.col(key).cast("string").alias("property_id"), F.lit(layer).alias("layer"), at.cast("int").alias("row_idx"), F.explode(every).alias("i")).select("property_id", "layer", "row_idx", "i.*")


def system_issues(systems: DataFrame) -> DataFrame:
    """Ranges, categories, contradictions of the systems table, and the shape of its groups."""
    rows = issues(systems, "property_id", "systems", R.SYSTEM_BOUNDS, {"subcategory": [*R.SUBCATEGORIES, R.OTHER], "condition": R.CONDITIONS, "condition_secondary": R.CONDITIONS}, more=[("assessed", "contradiction", F.size(contradictions([m for m in MEASURES if m in systems.columns])) > 0)])
    shape = group_shape(systems.where(F.col("subcategory") != R.OTHER), "property_id", "subcategory", R.SUBCATEGORIES)
    return rows.unionByName(shape.select(F.col("property_id").cast("string").alias("property_id"), F.lit("systems").alias("layer"), F.lit(None).cast("int").alias("row_idx"), F.lit("subcategory").alias("field"), F.lit("shape").alias("kind"), F.concat_ws(" ", "problem", "member").alias("detail")))


def component_issues(components: DataFrame) -> DataFrame:
    physics = [("rul_years", "physics", F.col("rul_years") > F.col("eul_years"))] if {"rul_years", "eul_years"} <= set(components.columns) else []
    return issues(components, "property_id", "components", R.COMPONENT_BOUNDS, {"subcategory": [*R.SUBCATEGORIES, R.OTHER], "table": [*R.NEAR_TERM, "reserve"]}, more=physics)


def group_shape(df: DataFrame, key: str, member: str, members: list[str]) -> DataFrame:
    """Members that a key has more than once, or not at all."""
    counts = df.groupBy(key, member).count()
    twice = counts.where("count > 1").select(key, F.col(member).alias("member"), F.lit("duplicate").alias("problem"))
    return twice.unionByName(missing_members(df, key, member, members).select(key, "member", F.lit("missing").alias("problem")))


def missing_members(df: DataFrame, key: str, member: str, members: list[str]) -> DataFrame:
    """Each key's members of a fixed axis that it has no row for: one aggregate and an array difference, no cross join."""
    have = df.groupBy(key).agg(F.collect_set(member).alias("have"))
    return have.select(key, F.explode(F.array_except(F.array(*map(F.lit, members)), "have")).alias("member"))


def status(keys: DataFrame, issues_: DataFrame, key: str = "property_id", advisory: list[str] | None = None) -> DataFrame:
    """clean where nothing blocks; the kinds of the issues, sorted and joined."""
    blocking = issues_.where(~F.col("kind").isin(*(advisory or ["arithmetic", "not_in_text", "grounding"])))
    per = blocking.groupBy(key).agg(F.count("*").alias("n_issues"), F.array_join(F.array_sort(F.collect_set("kind")), "; ").alias("why"))
    return keys.select(key).distinct().join(per, key, "left").select(key, F.when(F.col("n_issues").isNull(), "clean").otherwise("needs_review").alias("status"), F.coalesce("n_issues", F.lit(0)).alias("n_issues"), "why")


def client_named(firm: Column, clients: str) -> Column:
    return F.coalesce(firm.rlike(f"(?iu){clients}"), F.lit(False))


def low_confidence(cells: DataFrame, most: float = R.LOW_CONFIDENCE) -> DataFrame:
    """Cells of the long form (value, confidence) with a value and a stated confidence up to most."""
    return cells.where(F.col("value").isNotNull() & (F.col("confidence") <= most))
