"""Every check of a record as rows of one issue table, and the verdict that follows from them.

An issue has the property, a layer (property, systems, components, cross-table), the row in it (null: the whole layer), a
field, a kind and a detail. What concerns a whole property comes from one aggregate of each table, joined by property; what
concerns a row comes from one scan of its table.
"""

from __future__ import annotations

from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom import registries as R
from ledgerloom.functions import rules, text
from ledgerloom.operators import checks, grounding, reconcile

ISSUE = ("property_id", "layer", "row_idx", "field", "kind", "detail")
#: Kinds that say something of the sums, and those that point at a place to look at but hold nothing up.
RECON, ADVISORY = ("reconcile", "empty", "sparse"), ("arithmetic", "grounding", "not_in_text")
LOSS = "type_coercion"
LIST = "array<struct<layer:string,field:string,kind:string,detail:string>>"
#: Rows that must be assessed for a report not to look thin.
FEW = 4


def _issue(layer: str, field: str, kind: str, detail: Column) -> Column:
    return F.struct(F.lit(layer).alias("layer"), F.lit(field).alias("field"), F.lit(kind).alias("kind"), detail.cast("string").alias("detail"))


def exploded(df: DataFrame, found: list[Column], row_idx: str | None = None, lost: str | None = None) -> DataFrame:
    """The issues that expressions find in the rows of a table, in one scan; lost names a column with an array of more.

    Nulls go after the array is exploded: what stands inside of a filter() isn't compiled, and costs many times as much. The
    outer form keeps Spark from working the array out a second time, for its size.
    """
    every = F.array(*found)
    every = F.concat(F.coalesce(lost, F.array().cast(LIST)), every) if lost else every
    at = F.col(row_idx).cast("int") if row_idx else F.lit(None).cast("int")
    rows = df.select(F.col("property_id").cast("string").alias("property_id"), at.alias("row_idx"), every.alias("__found"))
    return rows.select("property_id", "row_idx", F.explode_outer("__found").alias("i")).where("i IS NOT NULL").select("property_id", "i.layer", "row_idx", "i.field", "i.kind", "i.detail")


def _number(df: DataFrame, f: str) -> Column:
    """A field as a number: as it is, or parsed; null where the table lacks it."""
    if f not in df.columns:
        return F.lit(None).cast("double")
    return text.number(F.col(f)) if dict(df.dtypes)[f] == "string" else F.col(f).cast("double")


def typed(df: DataFrame, layer: str, bounds: dict[str, tuple[float, float]], categories: dict[str, list[str]] | None = None, dates: list[str] | None = None) -> list[Column]:
    """Checks of raw cells: texts that aren't numbers (type), numbers out of bounds, parts outside a vocabulary, dates of another form."""
    found = []
    for f, (lo, hi) in bounds.items():
        if f in df.columns:
            n = _number(df, f)
            found.append(F.when(F.col(f).isNotNull() & n.isNull(), _issue(layer, f, "type", F.col(f))).when(checks.out_of_range(n, lo, hi), _issue(layer, f, "range", n)))
    for f, allowed in (categories or {}).items():
        if f in df.columns:
            bad, plain = checks.not_allowed(F.col(f), allowed), [x for x in allowed if x == x.strip().lower() and ";" not in x]
            found.append(F.when(~F.col(f).isin(*plain) & (F.size(bad) > 0), _issue(layer, f, "category", F.array_join(bad, "; "))))
    return found + [F.when(checks.bad_date(F.col(f)), _issue(layer, f, "date", F.col(f))) for f in dates or [] if f in df.columns]


# What concerns a whole property


def totals(properties: DataFrame, systems: DataFrame, components: DataFrame) -> DataFrame:
    """The properties with what a property's checks need of its systems (sums of columns, rows assessed, subcategories) and its
    components (rows, sums by bucket and of all near-term ones), each from one aggregate before the join."""
    cost = reconcile.money(_number(components, "total_cost_usd"))
    of = lambda b: F.col("table") == b
    per = [F.count("*").alias("c_rows"), F.sum(F.when(F.col("table").isin(*R.NEAR_TERM), cost)).cast("double").alias("c_near")]
    for b in R.STATED_TOTALS:
        per += [F.sum(F.when(of(b), cost)).cast("double").alias(f"c_{b}"), F.count_if(of(b)).alias(f"n_{b}")]
    columns = sorted({at for _, _, layer, at in R.PAIRS if layer == "systems"})
    sums = [F.sum(reconcile.money(_number(systems, f))).cast("double").alias(f"s_{f}") for f in columns]
    rows = [F.count_if(F.col("subcategory") == x).alias(f"r_{x}") for x in R.SUBCATEGORIES]
    own = [F.count("*").alias("s_rows"), F.count_if("assessed").alias("n_assessed"), *rows]
    # counts of the known subcategories go with the sums: sets of a group would be sorted, not hashed
    named = lambda keep: F.array_compact(F.array(*(F.when(keep(F.col(f"r_{x}")), F.lit(x)) for x in R.SUBCATEGORIES)))
    strange = systems.where((F.col("subcategory") != R.OTHER) & ~F.col("subcategory").isin(*R.SUBCATEGORIES)).groupBy("property_id", "subcategory").agg(F.count("*").alias("n")).where("n > 1").groupBy("property_id").agg(F.collect_set("subcategory").alias("strange"))
    s, c = systems.groupBy("property_id").agg(*own, *sums), components.groupBy("property_id").agg(*per)
    t = properties.join(s, "property_id", "left").join(c, "property_id", "left").join(strange, "property_id", "left")
    twice = F.array_sort(F.concat(named(lambda n: n > 1), F.coalesce("strange", F.array().cast("array<string>"))))
    return t.withColumns({"subs": named(lambda n: n > 0), "twice": twice}).drop("strange", *(f"r_{x}" for x in R.SUBCATEGORIES))


def pairs(t: DataFrame) -> list[Column]:
    """Stated totals that their sums don't give: as they are, with a contingency, or (immediate ones) with all near-term costs."""
    pct, usd, found = _number(t, "contingency_pct"), _number(t, "contingency_usd"), []
    for name, field, layer, at in R.PAIRS:
        stated, summed = _number(t, field), F.col(f"s_{at}" if layer == "systems" else f"c_{at}")
        ok = reconcile.reconciles(stated, summed, pct, usd)
        if name.startswith("immediate"):
            ok = ok | reconcile.reconciles(stated, F.col("c_near"), pct, usd)
        found.append(F.when(~ok, _issue("cross-table", name, "reconcile", F.format_string("stated %.2f, summed %.2f", stated, summed))))
    return found


def completeness(t: DataFrame) -> list[Column]:
    """Systems of which none or few are assessed, components that aren't there, stated totals without rows or without any amount."""
    n, rows = F.coalesce("n_assessed", F.lit(0)), F.coalesce("c_rows", F.lit(0))
    found = [F.when(n == 0, _issue("systems", "n_rows", "empty", F.lit("none is assessed"))).when(n < FEW, _issue("systems", "n_rows", "sparse", n)), F.when(rows == 0, _issue("components", "n_rows", "empty", F.lit("no rows")))]
    for b, field in R.STATED_TOTALS.items():
        stated, k = _number(t, field), F.coalesce(f"n_{b}", F.lit(0))
        found.append(F.when((stated > 0) & (k == 0), _issue("components", field, "empty", F.lit(f"stated, but no {b} rows"))).when((stated > 0) & F.col(f"c_{b}").isNull(), _issue("components", field, "empty", F.lit(f"stated, but no {b} row has a total"))))
    return found


def shape(t: DataFrame) -> list[Column]:
    """One issue for all subcategories that a property lacks, one for all that it has more than once."""
    missing = F.array_except(F.array(*map(F.lit, R.SUBCATEGORIES)), F.coalesce("subs", F.array().cast("array<string>")))
    return [F.when(F.size(missing) > 0, _issue("systems", "subcategory", "shape", F.concat(F.lit("missing "), F.array_join(missing, "; ")))), F.when(F.size("twice") > 0, _issue("systems", "subcategory", "shape", F.concat(F.lit("duplicate "), F.array_join("twice", "; "))))]


def whole(t: DataFrame) -> list[Column]:
    """All that concerns whole properties, from totals()."""
    return [*pairs(t), *completeness(t), *shape(t)]


def client_firm(firm: str = "report_firm") -> list[Column]:
    """A firm that is a known client."""
    return [F.when(checks.client_named(F.col(firm), R.CLIENTS), _issue("property", firm, "firm", F.col(firm)))]


# What concerns a row


def of_systems(systems: DataFrame) -> list[Column]:
    """Bounds, vocabularies, and what rows carry that claim not to be assessed."""
    measures = [m for m in checks.MEASURES if m in systems.columns]
    carried, some = checks.contradictions(measures), reduce(or_, (F.col(m).isNotNull() for m in measures), F.lit(False))
    vocabularies = {"subcategory": [*R.SUBCATEGORIES, R.OTHER], "condition": R.CONDITIONS, "condition_secondary": R.CONDITIONS}
    return [*typed(systems, "systems", R.SYSTEM_BOUNDS, vocabularies), F.when(some & (F.size(carried) > 0), _issue("systems", "assessed", "contradiction", F.array_join(carried, "; ")))]


def of_components(components: DataFrame) -> list[Column]:
    """Bounds and vocabularies, remaining life over expected life, reserve rows whose years don't give their total."""
    n = lambda f: _number(components, f)
    year_sum = reduce(add, (F.coalesce(n(f"year_{i}"), F.lit(0.0)) for i in range(1, R.YEARS + 1)), F.lit(0.0))
    inflated = F.coalesce("years_inflated", F.lit(False)) if "years_inflated" in components.columns else F.lit(False)
    untied = (F.col("table") == "reserve") & ~inflated & (year_sum > 0) & ~reconcile.close(n("total_cost_usd"), year_sum)
    eul, rul = n("eul_years"), n("rul_years")
    return [
        *typed(components, "components", R.COMPONENT_BOUNDS, {"subcategory": [*R.SUBCATEGORIES, R.OTHER], "table": [*R.NEAR_TERM, "reserve"]}),
        F.when(rul > eul, _issue("components", "rul_years", "physics", F.format_string("%.1f of %.1f", rul, eul))),
        F.when(untied, _issue("components", "total_cost_usd", "reconcile", F.format_string("years %.2f, total %.2f", year_sum, n("total_cost_usd")))),
    ]


def arithmetic(components: DataFrame) -> list[Column]:
    """Rows whose quantity and unit cost don't give their cost (or a whole multiple of it: what recurs), rows whose lives don't add up."""
    n = lambda f: _number(components, f)
    expected, stated = n("quantity") * n("unit_cost_usd"), F.coalesce(n("cycle_replace_cost_usd"), n("total_cost_usd"))
    ratio = F.try_divide(stated, expected)
    times = F.bround(ratio, 0)
    multiple = times.between(1, 20) & (F.abs(ratio - times) <= R.RATIO_GAP)
    plain = F.coalesce(n("replace_percent") == 100, F.lit(True)) & n("qty_in_eval_period").isNull() & (n("quantity") > 0) & (n("unit_cost_usd") > 0)
    wrong = plain & ~multiple & ~reconcile.close(expected, stated)
    eul, age, rul = n("eul_years"), n("effective_age_years"), n("rul_years")
    return [
        F.when(wrong, _issue("components", "unit_cost_usd", "arithmetic", F.format_string("%.2f expected, %.2f stated", expected, stated))),
        F.when(F.abs(eul - age - rul) > R.LIFE_GAP, _issue("components", "rul_years", "arithmetic", F.format_string("%.1f - %.1f is not %.1f", eul, age, rul))),
    ]


# What the document says


def document_issues(properties: DataFrame, cells: DataFrame, pages: DataFrame, amounts: bool = True) -> DataFrame:
    """Snippets that aren't in the document (grounding) and, with amounts, positive ones of the property that nobody finds there (not_in_text).
    cells give where values come from, amounts are those of properties now. Documents without pages aren't checked.
    Both are searched for together, so that pages are shuffled, folded and read once."""
    marked = lambda df, mark: df.withColumn("id", F.concat(F.lit(mark), "id"))
    probes = marked(grounding.cited(cells, "property_id"), "g")
    if amounts:
        fields = [f for f in properties.columns if f.endswith("_usd") and "per_unit" not in f]
        long = properties.select("property_id", F.explode(F.array(*(F.struct(F.lit(f).alias("field"), _number(properties, f).alias("value")) for f in fields))).alias("v")).select("property_id", "v.*")
        probes = probes.unionByName(marked(grounding.valued(long, "property_id"), "n"))
    found = grounding.search_documents(probes, pages, "property_id").where("NOT found")
    snippet = F.col("id").startswith("g")
    return found.select(
        F.col("property_id").cast("string").alias("property_id"), F.lit("property").alias("layer"), F.lit(None).cast("int").alias("row_idx"), F.expr("substring(id, 2)").alias("field"),
        F.when(snippet, "grounding").otherwise("not_in_text").alias("kind"), F.when(snippet, F.col("snippet")).otherwise("in no form").alias("detail"),
    )


def repaired_firms(properties: DataFrame, pages: DataFrame, firm: str = "report_firm") -> DataFrame:
    """property_id, firm, hits of properties whose firm is a client or blank and whose pages name another: one page is enough
    against a client, three against a blank. Clients are cut out of the pages first."""
    client, blank = checks.client_named(F.col(firm), R.CLIENTS), F.col(firm).isNull() | (F.trim(F.col(firm)) == "")
    asked = properties.where(client | blank).select("property_id", F.col(firm).alias("__now"), client.alias("__client"))
    own = pages.join(asked.select("property_id"), "property_id", "left_semi").select("property_id", "page_no", F.regexp_replace(F.lower("text"), R.CLIENTS, " ").alias("text"))
    votes = rules.vote(own, "property_id", "text", [r for r in R.FIRM_RULES if r[0] != R.FIRM_OTHER], "page_no")
    return asked.join(votes, "property_id").where(F.col("hits") >= F.when(F.col("__client"), 1).otherwise(3)).where(~F.col("label").eqNullSafe(F.col("__now"))).select("property_id", F.col("label").alias("firm"), "hits")


def with_repaired_firms(rows: DataFrame, repaired: DataFrame, firm: str = "report_firm") -> DataFrame:
    return rows.join(repaired.select("property_id", F.col("firm").alias("__firm")), "property_id", "left").withColumn(firm, F.coalesce("__firm", firm)).drop("__firm")


def repaired_cells(cells: DataFrame, repaired: DataFrame, firm: str = "report_firm") -> DataFrame:
    """The firm's cell takes the name that the pages gave: without a snippet, with a confidence of 0.9."""
    j = cells.join(repaired.select("property_id", F.col("firm").alias("__firm")), "property_id", "left")
    hit = (F.col("field") == firm) & F.col("__firm").isNotNull()
    return j.withColumns({"value": F.when(hit, F.col("__firm")).otherwise(F.col("value")), "snippet": F.when(~hit | hit.isNull(), F.col("snippet")), "confidence": F.when(hit, F.lit(0.9)).otherwise(F.col("confidence"))}).drop("__firm")


# The verdict


def blocks(layer: Column, kind: Column) -> Column:
    """Whether an issue holds a report up: sums, what is wrong in tables, lost values. A property's own cells go to review elsewhere."""
    return kind.isin(*RECON) | (~kind.isin(*ADVISORY) & ((layer != "property") | (kind == LOSS)))


def verdicts(keys: DataFrame, issues: DataFrame, unresolved: str | None = None) -> DataFrame:
    """property_id, status, the numbers of issues by sort, why (the kinds that block, sorted) and target_quality, for each key.
    unresolved names a column of keys with the number of fields that a review left open: these block, too."""
    kind, layer = F.col("kind"), F.col("layer")
    stop, recon = blocks(layer, kind), kind.isin(*RECON)
    n = lambda c, name: F.count_if(c).alias(name)
    per = issues.groupBy("property_id").agg(
        n(~recon & ~kind.isin(*ADVISORY), "det_issues"), n(recon, "recon_issues"), n(kind == "arithmetic", "arithmetic_issues"), n(kind == "grounding", "grounding_fails"), n(kind == "not_in_text", "not_in_text"),
        n(stop, "__stop"), F.array_join(F.array_sort(F.collect_set(F.when(stop, kind))), "; ").alias("__why"),
        F.bool_or((layer == "components") & (kind == "empty")).alias("__empty"), F.bool_or((kind == "reconcile") & F.col("field").contains("components")).alias("__untied"),
    )
    counts = ("det_issues", "recon_issues", "arithmetic_issues", "grounding_fails", "not_in_text")
    open_ = F.coalesce(F.col(unresolved), F.lit(0)) if unresolved else F.lit(0)
    j = keys.join(per, "property_id", "left")
    why = F.coalesce(F.nullif(F.col("__why"), F.lit("")), F.when(open_ > 0, "unverified fields"), F.lit(""))
    return j.select(
        *keys.columns, F.when((F.coalesce("__stop", F.lit(0)) == 0) & (open_ == 0), "clean").otherwise("needs_review").alias("status"), *(F.coalesce(c, F.lit(0)).alias(c) for c in counts), why.alias("why"),
        F.when(F.col("__empty"), "no_line_items").when(F.col("__untied"), "does_not_tie").otherwise("ok").alias("target_quality"),
    )
