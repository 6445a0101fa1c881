"""The whole record check as one plan: coerce, check, reconcile, grade, and the cost grid.

Coercion comes first, then every check, so that no issue speaks of a value that was corrected since. All steps are lazy
expressions over three tables (and page texts, if given); nothing is collected.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom import registries as R
from ledgerloom.functions import coerce, rules, text
from ledgerloom.operators import grid
from ledgerloom.operators import verification as V
from ledgerloom.operators.verification import LOSS


NUMERIC = ("double", "float", "int", "bigint", "smallint", "tinyint", "decimal")


def numbers(df: DataFrame, bounds: dict, layer: str) -> DataFrame:
    """Numeric fields parsed (numbers stay); ranges of fields that have _min and _max fill these; lost values as issues in the column __lost.

    Nulls and plain numbers are read where they stand. The other texts of a sort are parsed by one expression over an array of
    them, so the plan grows little with the fields; rows without such texts never come to it, as lambdas aren't compiled.
    """
    kinds, new = dict(df.dtypes), {}
    fields = [f for f in bounds if f in df.columns and not f.endswith(("_min", "_max"))]
    spans = {f for f in fields if f"{f}_min" in df.columns and f"{f}_max" in df.columns}
    texts = [f for f in fields if not kinds[f].startswith(NUMERIC)]
    groups = {"__plain": ([f for f in texts if f not in spans], coerce.plain), "__ranged": ([f for f in texts if f in spans], coerce.ranged)}
    said, quick = {f: F.col(f).cast("string") for f in texts}, {f: F.col(f"__quick_{f}") for f in texts}
    df = df.withColumns({f"__quick_{f}": F.when(said[f].rlike(text.SIMPLE), text.simple(said[f])) for f in texts})
    odd = {f: said[f].isNotNull() & quick[f].isNull() for f in texts}
    some = lambda fs: reduce(or_, (odd[f] for f in fs))
    df = df.withColumns({g: F.when(some(fs), F.transform(F.array(*(F.when(odd[f], said[f]) for f in fs)), parse)) for g, (fs, parse) in groups.items() if fs})
    parsed = {f: F.get(F.col(g), F.lit(i)) for g, (fs, _) in groups.items() for i, f in enumerate(fs)}
    for f in fields:
        value = F.coalesce(quick[f], parsed[f]["value"]) if f in parsed else F.col(f).cast("double")
        new[f] = value
        if f in spans:
            lo, hi = F.col(f"{f}_min").try_cast("double"), F.col(f"{f}_max").try_cast("double")
            new[f] = F.coalesce(value, hi)
            new[f"{f}_min"], new[f"{f}_max"] = (F.coalesce(parsed[f]["lo"], lo), F.coalesce(parsed[f]["hi"], hi)) if f in parsed else (lo, hi)
        if f in parsed and f in ("rul_years", "eul_years") and "rul_varies" in df.columns:
            new["rul_varies"] = new.get("rul_varies", F.coalesce("rul_varies", F.lit(False))) | F.coalesce(parsed[f]["varies"], F.lit(False))
    losses = [F.when(parsed[f]["lost"], F.struct(F.lit(layer).alias("layer"), F.lit(f).alias("field"), F.lit(LOSS).alias("kind"), F.col(f).cast("string").alias("detail"))) for f in texts]
    lost = F.when(some(texts), F.filter(F.array(*losses), lambda x: x.isNotNull())).otherwise(F.array().cast(V.LIST)) if losses else F.array().cast(V.LIST)
    return df.withColumns({**new, "__lost": lost}).drop(*groups, *(f"__quick_{f}" for f in texts))


def coerce_systems(systems: DataFrame) -> DataFrame:
    """Bare ratings move to their column, conditions are spelled as the vocabulary does, findings that are no rating go to notes."""
    s = systems
    if "condition_rating_numeric" in s.columns:
        s = s.withColumn("condition_rating_numeric", F.coalesce(F.col("condition_rating_numeric").try_cast("double"), coerce.numeric_rating(F.col("condition").cast("string"))))
        s = s.withColumn("condition", F.when(coerce.numeric_rating(F.col("condition").cast("string")).isNull(), F.col("condition")))
    s = s.withColumn("condition", coerce.category_value(F.col("condition")))
    if {"condition_secondary", "notes"} <= set(s.columns):
        second = coerce.category_value(F.col("condition_secondary"))
        rated = F.exists(F.split(second, "; "), lambda p: p.isin(*R.CONDITIONS))
        bare = coerce.numeric_rating(F.col("condition_secondary").cast("string")).isNotNull()
        finding = F.trim(F.concat(F.coalesce("notes", F.lit("")), F.lit(" [condition detail: "), F.col("condition_secondary"), F.lit("]")))
        s = s.withColumns({"notes": F.when(second.isNotNull() & ~rated & ~bare, finding).otherwise(F.col("notes")), "condition_secondary": F.when(rated & ~bare, second)})
    return s


def coerce_components(components: DataFrame) -> DataFrame:
    """The subcategory follows the description as it is now."""
    return components.withColumn("subcategory", rules.subcategory_of_component(F.coalesce("description", F.lit(""))))


def coerce_properties(properties: DataFrame, firms: rules.Rules | None = None) -> DataFrame:
    p = properties
    if "state" in p.columns:
        p = p.withColumn("state", coerce.state_code(F.col("state")))
    if {"num_units", "num_rooms", "unit_basis"} <= set(p.columns):
        p = p.withColumn("unit_basis", coerce.category_value(F.col("unit_basis"), R.UNIT_BASES, R.UNIT_BASIS_SYNONYMS))
        p = coerce.dedupe_denominators(p)
    if "overall_condition" in p.columns:
        p = p.withColumn("overall_condition", coerce.category_value(F.col("overall_condition")))
    if firms:
        p = p.withColumn("report_firm", F.coalesce(rules.first_match(F.col("report_firm"), firms, None), F.col("report_firm")))
    return p


def coerced(properties: DataFrame, systems: DataFrame, components: DataFrame, firms: rules.Rules | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three tables with typed values; __lost has the values that were lost."""
    p = numbers(coerce_properties(properties, firms), R.PROPERTY_BOUNDS, "property")
    s = numbers(coerce_systems(systems), R.SYSTEM_BOUNDS, "systems")
    return p, s, numbers(coerce_components(components), R.COMPONENT_BOUNDS, "components")


def record_issues(p: DataFrame, s: DataFrame, c: DataFrame, t: DataFrame, more: bool = False) -> DataFrame:
    """All that coerced tables and the totals of their properties show: one scan of each; more adds the arithmetic of components."""
    firm = V.client_firm() if "report_firm" in p.columns else []
    own = V.typed(p, "property", R.PROPERTY_BOUNDS, {"overall_condition": R.CONDITIONS, "unit_basis": R.UNIT_BASES}, ["report_date", "assessment_date"])
    at = lambda df: "row_idx" if "row_idx" in df.columns else None
    found = V.exploded(t, [*V.whole(t), *firm, *own], lost="__lost").unionByName(V.exploded(s, V.of_systems(s), at(s), "__lost"))
    return found.unionByName(V.exploded(c, [*V.of_components(c), *(V.arithmetic(c) if more else [])], at(c), "__lost"))


def revalidate(properties: DataFrame, systems: DataFrame, components: DataFrame, firms: rules.Rules | None = None, version: str = "unversioned") -> dict[str, DataFrame]:
    """properties (with provenance), systems, components, issues, capex: the tables of a run."""
    p, s, c = coerced(properties, systems, components, firms)
    t = V.totals(p, s, c)
    found = record_issues(p, s, c, t)
    verdicts = V.verdicts(p.select(F.col("property_id").cast("string").alias("property_id")), found)
    mine = verdicts.select("property_id", F.col("status").alias("extraction_status"), (F.col("recon_issues") + F.col("det_issues")).alias("recon_issues"), "target_quality")
    stamped = p.drop("__lost", "extraction_status", "recon_issues", "target_quality").join(mine, "property_id", "left")
    stamped = stamped.withColumn("prompt_version", F.coalesce(F.nullif(F.col("prompt_version"), F.lit("")), F.lit(version)) if "prompt_version" in p.columns else F.lit(version))
    if "report_firm" not in stamped.columns:
        stamped = stamped.withColumn("report_firm", F.lit(None).cast("string"))
    s, c = s.drop("__lost"), c.drop("__lost")
    return {"properties": stamped, "systems": s, "components": c, "issues": found, "capex": grid.cost_grid(stamped, s, c)}
