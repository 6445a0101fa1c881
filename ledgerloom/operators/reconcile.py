"""Stated totals against sums of line items, with tolerance, allowances, completeness and row arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom import registries as R


def close(stated: Column, summed: Column, relative: float = R.RELATIVE, absolute: float = R.ABSOLUTE) -> Column:
    """Within the larger of an absolute and a relative tolerance of the stated side; null on either side isn't comparable and passes."""
    a, b = stated.cast("double"), summed.cast("double")
    return F.when(a.isNull() | b.isNull(), True).otherwise(F.abs(a - b) <= F.greatest(F.lit(absolute), F.abs(a) * relative))


def money(x: Column) -> Column:
    """Exact cents, so that sums don't depend on the order of rows."""
    return F.round(x, 2).cast("decimal(18,2)")


def bucket_sums(items: DataFrame, keys: list[str], bucket: str, cost: str, buckets: list[str]) -> DataFrame:
    """One pass of conditional sums: null where nothing was added, 0.0 where zeros were."""
    each = [F.sum(F.when(F.col(bucket) == b, money(F.col(cost)))).cast("double").alias(f"sum_{b}") for b in buckets]
    return items.groupBy(*keys).agg(*each, F.sum(money(F.col(cost))).cast("double").alias("sum_all"))


def reconciles(stated: Column, summed: Column, pct: Column | None = None, usd: Column | None = None) -> Column:
    """As stated, or with a contingency in percent or in dollars on top; 0 and null are no contingency."""
    ok = close(stated, summed)
    if pct is not None:
        ok = ok | F.coalesce((pct != 0) & close(stated, summed * (1 + pct / 100.0)), F.lit(False))
    if usd is not None:
        ok = ok | F.coalesce((usd != 0) & close(stated, summed + usd), F.lit(False))
    return ok


def reconciles_immediate(stated: Column, summed: Column, near_term: Column, pct: Column | None = None, usd: Column | None = None, vacuous: bool = True) -> Column:
    """Also against the sum of all near-term buckets. With vacuous, no near-term cost at all passes, as a null sum does."""
    also = close(stated, near_term) if vacuous else near_term.isNotNull() & close(stated, near_term)
    return reconciles(stated, summed, pct, usd) | also


def stated_against_items(stated: DataFrame, items: DataFrame, key: str, total: str, cost: str) -> DataFrame:
    """The core check: each stated total with the sum of its items, their number and the verdict."""
    sums = items.groupBy(key).agg(F.sum(money(F.col(cost))).cast("double").alias("summed"), F.count(cost).alias("n_items"))
    out = stated.join(sums, key, "left")
    return out.select(*stated.columns, "summed", F.coalesce("n_items", F.lit(0)).alias("n_items"), close(F.col(total), F.col("summed")).alias("ties"))


def component_checks(properties: DataFrame, components: DataFrame) -> DataFrame:
    """Issues (property_id, layer, field, kind, detail) of stated totals: rows missing (empty), totals missing, sums that don't tie (reconcile)."""
    c = components.withColumn("near", F.col("table").isin(*R.NEAR_TERM))
    cost, per = money(F.col("total_cost_usd")), []
    for b in R.STATED_TOTALS:
        per += [F.sum(F.when(F.col("table") == b, cost)).cast("double").alias(f"sum_{b}"), F.count_if(F.col("table") == b).alias(f"n_{b}")]
    sums = c.groupBy("property_id").agg(*per, F.sum(F.when(F.col("near"), cost)).cast("double").alias("near_sum"), F.count("*").alias("n_all"))
    j = properties.join(sums, "property_id", "left")
    pct = F.col("contingency_pct") if "contingency_pct" in properties.columns else None
    usd = F.col("contingency_usd") if "contingency_usd" in properties.columns else None
    found = [F.when(F.coalesce("n_all", F.lit(0)) == 0, _issue("components", "components", "empty", F.lit("no rows")))]
    for b, field in R.STATED_TOTALS.items():
        if field not in properties.columns:
            continue
        s, n, t = F.col(f"sum_{b}"), F.coalesce(f"n_{b}", F.lit(0)), F.col(field).cast("double")
        found.append(F.when((t > 0) & (n == 0), _issue("components", field, "empty", F.lit(f"stated, but no {b} rows"))))
        found.append(F.when((t > 0) & (n > 0) & s.isNull(), _issue("components", field, "empty", F.lit(f"stated, but no {b} row has a total"))))
        ok = reconciles_immediate(t, s, F.col("near_sum"), pct, usd) if b == "immediate" else reconciles(t, s, pct, usd)
        found.append(F.when(~ok, _issue("property", f"{field} vs components", "reconcile", F.format_string("stated %.2f, summed %.2f", t, s))))
    return j.select("property_id", F.explode(F.filter(F.array(*found), lambda x: x.isNotNull())).alias("i")).select("property_id", "i.*")


def _issue(layer: str, field: str, kind: str, detail: Column) -> Column:
    return F.struct(F.lit(layer).alias("layer"), F.lit(field).alias("field"), F.lit(kind).alias("kind"), detail.alias("detail"))


def year_sum(prefix: str = "year_") -> Column:
    years = F.array_compact(F.array(*(F.col(f"{prefix}{i}").cast("double") for i in range(1, R.YEARS + 1))))
    return F.when(F.size(years) > 0, F.aggregate(years, F.lit(0.0), lambda a, b: a + b))


def row_reconcile(components: DataFrame) -> DataFrame:
    """Reserve rows whose years don't add up to their total; inflated rows and empty schedules are left out."""
    y = year_sum()
    return components.where((F.col("table") == "reserve") & ~F.coalesce("years_inflated", F.lit(False))).withColumn("year_sum", y).where((F.col("year_sum") > 0) & ~close(F.col("total_cost_usd"), F.col("year_sum")))


def row_arithmetic(df: DataFrame, quantity: str, unit: str, cost: str, exempt: Column | None = None) -> DataFrame:
    """product, ratio and ok: the cost is quantity * unit price, or a whole multiple (1 to 20) of it: what recurs."""
    product = F.col(quantity).cast("double") * F.col(unit).cast("double")
    ratio = F.try_divide(F.col(cost).cast("double"), product)
    whole = F.bround(ratio, 0)
    multiple = whole.between(1, 20) & (F.abs(ratio - whole) <= R.RATIO_GAP)
    ok = close(product, F.col(cost)) | F.coalesce(multiple, F.lit(False))
    if exempt is not None:
        ok = ok | F.coalesce(exempt, F.lit(False))
    return df.withColumns({"product": product, "ratio": ratio}).withColumn("ok", ok)


def life_gap(eul: Column, age: Column, rul: Column) -> Column:
    """Whether expected life, age and remaining life disagree; null if one is missing."""
    return F.abs(eul - age - rul) > R.LIFE_GAP


def target_quality(properties: DataFrame, issues: DataFrame) -> DataFrame:
    """property_id, target_quality: no_line_items, does_not_tie or ok."""
    per = issues.groupBy("property_id").agg(
        F.bool_or((F.col("kind") == "empty") & (F.col("layer") == "components")).alias("empty"),
        F.bool_or((F.col("kind") == "reconcile") & F.col("field").contains("components")).alias("untied"),
    )
    q = F.when(F.col("empty"), "no_line_items").when(F.col("untied"), "does_not_tie").otherwise("ok")
    return properties.select("property_id").join(per, "property_id", "left").select("property_id", q.alias("target_quality"))
