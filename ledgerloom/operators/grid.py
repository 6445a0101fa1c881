"""Fixed grids: completion of ragged groups, roll-ups per cell, merging of duplicate rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom import registries as R
from ledgerloom.functions import rules

MONEY = "immediate_repairs_usd short_term_repairs_usd non_critical_repairs_usd replacement_reserves_usd".split()


def complete(keys: DataFrame, key: str, axis: str, members: list[str]) -> DataFrame:
    """Every non-null key with every member of a fixed axis: an explode of a literal array, no join."""
    return keys.where(F.col(key).isNotNull()).select(key).distinct().withColumn(axis, F.explode(F.array(*map(F.lit, members))))


def rollup(items: DataFrame, keys: list[str], cost: Column, when: dict[str, Column]) -> DataFrame:
    """Sum and count of non-null costs per condition, in one aggregate; rows with a null key go."""
    known = items
    for k in keys:
        known = known.where(F.col(k).isNotNull())
    aggs = []
    for name, cond in when.items():
        aggs += [F.sum(F.when(cond, cost)).cast("double").alias(f"{name}_usd"), F.count(F.when(cond, cost)).alias(f"n_{name}_items")]
    return known.groupBy(*keys).agg(*aggs)


def cost_grid(properties: DataFrame, systems: DataFrame, components: DataFrame) -> DataFrame:
    """One row a property and subcategory: reserve and near-term cost, the system's condition, the property's provenance."""
    grid = complete(properties, "property_id", "subcategory", R.SUBCATEGORIES)
    cost = F.round(F.col("total_cost_usd"), 2).cast("decimal(18,2)")
    sums = rollup(components, ["property_id", "subcategory"], cost, {"reserve": F.col("table") == "reserve", "near_term": F.col("table").isin(*R.NEAR_TERM)})
    feats = systems.select("property_id", "subcategory", "condition", "condition_rating_numeric", "rul_years", "assessed")
    props = properties.select("property_id", "report_firm", "extraction_status", "prompt_version", "target_quality")
    out = grid.join(sums, ["property_id", "subcategory"], "left").join(feats, ["property_id", "subcategory"], "left").join(props, "property_id", "left")
    res, near = F.coalesce("reserve_usd", F.lit(0.0)), F.coalesce("near_term_usd", F.lit(0.0))
    return out.select(
        "property_id", "report_firm", "subcategory", res.alias("reserve_capex_usd"), near.alias("near_term_capex_usd"), (res + near).alias("total_capex_usd"),
        F.coalesce("n_reserve_items", F.lit(0)).alias("n_reserve_items"), F.coalesce("n_near_term_items", F.lit(0)).alias("n_near_term_items"),
        "condition", "condition_rating_numeric", "rul_years", "assessed", "extraction_status", "prompt_version", "target_quality",
    )


def first_value(pos: str, x: str) -> Column:
    return F.min_by(x, F.when(F.col(x).isNotNull(), F.col(pos)))


def joined_text(pos: str, x: str, sep: str = "; ") -> Column:
    """Distinct texts in order of position; null if there are none."""
    rows = F.array_sort(F.collect_list(F.when(F.col(x).isNotNull(), F.struct(F.col(pos).alias("pos"), F.col(x).alias("x")))))
    return F.nullif(F.array_join(F.array_distinct(F.transform(rows, lambda r: r["x"])), sep), F.lit(""))


def merge_rows(df: DataFrame, keys: list[str], pos: str, sums: list[str], texts: list[str], scalars: list[str], flag: str | None = None) -> DataFrame:
    """One row a key: sums of money (null if all are), texts joined, first known scalars; a flag is true if any is, null if all are."""
    aggs = [F.sum(F.round(F.col(c), 2).cast("decimal(18,2)")).cast("double").alias(c) for c in sums] + [joined_text(pos, c).alias(c) for c in texts] + [first_value(pos, c).alias(c) for c in scalars]
    return df.groupBy(*keys).agg(*aggs, *([F.bool_or(flag).alias(flag)] if flag else []))


#: What a systems row says, beside its keys.
TEXTS, SCALARS = ["action_required", "source_sections", "notes"], ["condition", "condition_secondary", "condition_rating_numeric", "rul_years", "rul_years_min", "rul_years_max"]
CONTENT = ["condition", "condition_rating_numeric", "action_required", "rul_years", "notes", "source_sections", *MONEY]


def normalise_systems(systems: DataFrame) -> DataFrame:
    """Twelve rows a property, and one more for costs that belong to none of the twelve: property_id, subcategory, what rows say, assessed.

    A subcategory is known by its slug; an unknown one is mapped by the rules over what the row says of itself; other takes
    the rest. Rows of one subcategory are merged by pos: money adds up, texts are joined without repeats, the first
    known scalar stays, assessed is true if any is and null if all are. A row that doesn't say whether it was assessed was, if it says
    anything at all. Absent rows are filled in as not assessed. Of other's rows one is left if it carries any money.
    One aggregate by property and subcategory, then a join with the grid of properties.
    """
    have = lambda names: [c for c in names if c in systems.columns]
    slugged = F.regexp_replace(F.lower(F.trim("subcategory")), " ", "_")
    said = F.concat_ws(" ", *(F.coalesce(F.col(c), F.lit("")) for c in have(["subcategory", "source_sections", "notes"])))
    sub = F.when(F.col("__slug").isin(*R.SUBCATEGORIES, R.OTHER), F.col("__slug")).otherwise(rules.subcategory(F.col("__said")))
    rows = systems.withColumns({"__slug": slugged, "__said": said}).withColumns({"subcategory": sub, **{c: F.nullif(F.trim(c), F.lit("")) for c in have(TEXTS)}})
    merged = merge_rows(rows, ["property_id", "subcategory"], "pos", have(MONEY), have(TEXTS), have(SCALARS), "assessed")
    any_content = F.lit(False)
    for c in have(CONTENT):
        any_content = any_content | F.col(c).isNotNull()
    merged = merged.withColumn("assessed", F.coalesce("assessed", any_content))
    grid = complete(systems, "property_id", "subcategory", R.SUBCATEGORIES).join(merged, ["property_id", "subcategory"], "left").withColumn("assessed", F.coalesce("assessed", F.lit(False)))
    costed = F.lit(False)
    for c in have(MONEY):
        costed = costed | F.coalesce(F.col(c) != 0, F.lit(False))
    return grid.unionByName(merged.where((F.col("subcategory") == R.OTHER) & costed).withColumn("assessed", F.lit(True)))


def _nameless() -> Column:
    return F.coalesce(F.trim("subcategory") == "", F.lit(True))


def mark_legacy(systems: DataFrame) -> DataFrame:
    """systems, and in __old whether their property is of the older layout; rows without a property go. One shuffle of the rows."""
    return systems.where(F.col("property_id").isNotNull()).withColumn("__old", F.bool_or(_nameless()).over(Window.partitionBy("property_id")))


def migrate_legacy_systems(systems: DataFrame) -> DataFrame:
    """Properties with a row without a subcategory are of the older layout, one row a section of the report: their rows are mapped by
    the section's heading, which moves to source_sections with its number, and normalised. All others stay as they are.

    systems has pos, system_name and section_code beside the columns of today; the older layout had no rul_years and no notes.
    They are read for the older layout's rows, for their properties and for the others: what is costly to make should be
    given as a table of what mark_legacy() returns. Without any row of the older layout nothing is shuffled.
    """
    today = [c for c in systems.columns if c not in ("system_name", "section_code", "pos", "__old")]
    if "__old" in systems.columns:
        j = systems
    elif systems.where(_nameless()).isEmpty():
        return systems.where(F.col("property_id").isNotNull()).select(*today)
    else:
        j = mark_legacy(systems)
    text = lambda c: F.coalesce(F.trim(c), F.lit(""))
    heading = F.coalesce(F.nullif(F.col("system_name"), F.lit("")), F.trim(F.concat_ws(" ", text("system_name"), text("section_code"))))
    source = F.nullif(F.trim(F.concat_ws(" ", text("section_code"), text("system_name"))), F.lit(""))
    gone = {c: F.lit(None).cast(dict(systems.dtypes)[c]) for c in ("rul_years", "rul_years_min", "rul_years_max", "notes") if c in systems.columns}
    folded = j.where("__old").withColumns({"subcategory": rules.subcategory(heading), "source_sections": source, "assessed": F.lit(True), **gone})
    return normalise_systems(folded.select(*today, "pos")).select(*today).unionByName(j.where("NOT __old").select(*today))
