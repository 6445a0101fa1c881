"""Records as the engine checks them, derived from the order tables by SQL that Spark and DuckDB read alike.

An order is a property, its line items are the components, twelve systems rows hold what their parts' keys say. Values are texts, as
extraction gives them: plain, with signs, as ranges, as words, or none; stated totals tie out, carry a contingency or don't.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerloom import registries as R

BUCKETS = ["immediate", "short_term", "non_critical", "priority", "operational", "reserve", "accessibility"]
MONEY = {"immediate": "immediate_repairs_usd", "short_term": "short_term_repairs_usd", "non_critical": "non_critical_repairs_usd", "reserve": "replacement_reserves_usd"}
PLURAL = {"o": "orders", "c": "customer", "l": "lineitem", "p": "part"}


def pick(i: str, values: list[str | None]) -> str:
    """The value at a place, as SQL."""
    said = ["NULL" if v is None else "'" + v.replace("'", "''") + "'" for v in values]
    return f"CASE {i} " + " ".join(f"WHEN {n} THEN {v}" for n, v in enumerate(said[:-1])) + f" ELSE {said[-1]} END"


def _money(x: str) -> str:
    return f"CAST({x} AS DECIMAL(18,2))"


ITEM = f"""item AS (SELECT l_orderkey AS k, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate, l_returnflag, l_linestatus) - 1 AS INT) AS row_idx,
  l_partkey AS pk, l_suppkey AS sk, CAST(l_quantity AS INT) AS q, p_size AS size, {_money("p_retailprice")} AS price, {pick("l_linenumber - 1", BUCKETS)} AS bucket, p_name,
  CASE WHEN l_suppkey % 19 = 0 OR l_suppkey % 17 = 0 THEN NULL WHEN l_suppkey % 5 = 0 THEN {_money("CAST(l_quantity AS INT) * p_retailprice")} WHEN l_suppkey % 5 = 1 THEN {_money("2 * CAST(l_quantity AS INT) * p_retailprice")} ELSE {_money("l_extendedprice")} END AS amount
  FROM {{lineitem}} JOIN {{part}} ON p_partkey = l_partkey)"""
#: Sums of an order's items by bucket, of all near-term ones, and their number.
SUMS = "sums AS (SELECT k, " + ", ".join(f"sum(CASE WHEN bucket = '{b}' THEN amount END) AS s_{b}" for b in BUCKETS) + ", sum(CASE WHEN bucket <> 'reserve' THEN amount END) AS s_near FROM item GROUP BY k)"


def _stated(bucket: str) -> str:
    s = f"CASE WHEN o_orderkey % 13 = 0 THEN s_near ELSE s_{bucket} END" if bucket == "immediate" else f"s_{bucket}"
    factor = "CASE o_orderkey % 4 WHEN 1 THEN 1.1 WHEN 2 THEN 1.3 ELSE 1.0 END"
    return f"CASE WHEN {s} IS NULL THEN CASE WHEN o_orderkey % 11 = 0 THEN '5000' END ELSE CAST({_money(f'{_money(s)} * {factor}')} AS STRING) END"


FIRMS = ["EBI Consulting, Inc.", "AEI Consultants", "Bridge House Advisors Corp.", None, "Terracon Ltd", "Unknown Co", "Partner ESI", "Lloyd Jones LLC"]
PROPERTY = f"""property AS (SELECT 'p' || CAST(o_orderkey AS STRING) AS property_id, o_orderkey AS k, {pick("o_custkey % 8", FIRMS)} AS report_firm, {pick("o_custkey % 5", ["Texas", "tx", "ny ", "Ontario", None])} AS state,
  CAST(1840 + o_orderkey % 200 AS STRING) AS year_built, {pick("o_orderkey % 7", ["3", "One and two floors", "15 stories", "1-4", "n/a", "tall", "200"])} AS num_stories, CAST(NULL AS DOUBLE) AS num_stories_min, CAST(NULL AS DOUBLE) AS num_stories_max,
  {pick("o_orderkey % 3", ["2024-02-30", "Jan 5", None])} AS report_date, {pick("o_orderkey % 5", ["Good", "fair; poor", "good to fair", "N/A", "shabby"])} AS overall_condition,
  CASE WHEN o_orderkey % 8 = 1 THEN '10' END AS contingency_pct, CASE WHEN o_orderkey % 16 = 3 THEN '$250' END AS contingency_usd,
  {", ".join(f"{_stated(b)} AS {f}" for b, f in R.STATED_TOTALS.items())} FROM {{orders}} LEFT JOIN sums ON sums.k = o_orderkey)"""

COMPONENT = f"""component AS (SELECT 'p' || CAST(k AS STRING) AS property_id, row_idx, bucket, p_name AS description, CAST(NULL AS STRING) AS subcategory, CAST(q AS STRING) AS quantity, CASE WHEN pk % 4 = 0 THEN '$' || CAST(price AS STRING) ELSE CAST(price AS STRING) END AS unit_cost_usd,
  CASE WHEN sk % 19 = 0 THEN 'see note' WHEN sk % 17 = 0 THEN 'TBD' WHEN sk % 3 = 0 THEN '$' || CAST(amount AS STRING) ELSE CAST(amount AS STRING) END AS total_cost_usd, CAST(NULL AS STRING) AS cycle_replace_cost_usd,
  CASE WHEN pk % 13 = 0 THEN '50' END AS replace_percent, CASE WHEN pk % 29 = 0 THEN '1' END AS qty_in_eval_period,
  CASE WHEN size % 10 = 3 THEN CAST(size AS STRING) || '-' || CAST(size + 5 AS STRING) WHEN size % 10 = 7 THEN 'varies' ELSE CAST(size AS STRING) END AS eul_years, CAST(NULL AS DOUBLE) AS eul_years_min, CAST(NULL AS DOUBLE) AS eul_years_max,
  CAST(sk % 20 AS STRING) AS effective_age_years, CAST(size - sk % 20 + pk % 4 AS STRING) AS rul_years, CAST(NULL AS DOUBLE) AS rul_years_min, CAST(NULL AS DOUBLE) AS rul_years_max, pk % 11 = 0 AS years_inflated,
  {", ".join(f"CASE WHEN bucket = 'reserve' AND pk % {R.YEARS} + 1 = {i} THEN CAST(amount + CASE WHEN pk % 7 = 0 THEN 500 ELSE 0 END AS STRING) END AS year_{i}" for i in range(1, R.YEARS + 1))} FROM item)"""

_GRID = "(VALUES " + ", ".join(f"({i}, '{s}')" for i, s in enumerate(R.SUBCATEGORIES)) + ") AS axis(i, sub)"
SYSTEM = f"""per AS (SELECT k, pk % 12 AS i, {", ".join(f"sum(CASE WHEN bucket = '{b}' THEN amount END) AS {f}" for b, f in MONEY.items())} FROM item GROUP BY k, pk % 12),
full_grid AS (SELECT o_orderkey AS k, axis.i AS i, sub, o_orderkey % 17 <> 0 AND per.k IS NOT NULL AS assessed, {", ".join(f"CASE WHEN o_orderkey % 17 <> 0 THEN {f} END AS {f}" for f in MONEY.values())}
  FROM {{orders}} CROSS JOIN {_GRID} LEFT JOIN per ON per.k = o_orderkey AND per.i = axis.i),
system AS (SELECT 'p' || CAST(k AS STRING) AS property_id, i AS row_idx, sub AS subcategory, assessed, CASE WHEN assessed AND (k + i) % 7 <> 6 THEN {pick("(k + i) % 6", ["Good", "fair; poor", "Good to fair", "shabby", "N/A", "excellent"])} WHEN k % 40 = 7 AND i = 3 THEN 'good' END AS condition,
    CASE WHEN assessed AND (k + i) % 31 = 0 THEN '7' END AS condition_rating_numeric, {", ".join(f"CAST({f} AS STRING) AS {f}" for f in MONEY.values())}, CASE WHEN k % 3 <> 0 THEN 'sec ' || CAST(i AS STRING) END AS source_sections
  FROM full_grid WHERE NOT (k % 50 = 0 AND i = 3)
  UNION ALL SELECT 'p' || CAST(o_orderkey AS STRING), 12, 'plumbing', true, 'good', NULL, NULL, NULL, NULL, NULL, 'again' FROM {{orders}} WHERE o_orderkey % 60 = 0)"""

#: Two cells with provenance; one in nine cites what isn't there, one in six isn't sure.
CELL = """cell AS (SELECT property_id, 'immediate_repairs_total_usd' AS field, immediate_repairs_total_usd AS value, 1 AS page,
    CASE k % 9 WHEN 0 THEN 'not in there' WHEN 1 THEN 'PREPARED  for ... Total: ' || immediate_repairs_total_usd ELSE 'immediate  total: ' || immediate_repairs_total_usd END AS snippet, CASE WHEN k % 6 = 0 THEN 0.5 ELSE 0.9 END AS confidence FROM property
  UNION ALL SELECT property_id, 'short_term_repairs_total_usd', short_term_repairs_total_usd, 3, 'short-term ' || short_term_repairs_total_usd || ' ... page two', CASE WHEN k % 10 = 0 THEN NULL ELSE 0.8 END FROM property)"""
PAGE = """page AS (SELECT property_id, page_no, CASE page_no WHEN 1 THEN 'Prepared for Bridge House. Immediate total: ' || coalesce(immediate_repairs_total_usd, 'none') || '. Short term ' || coalesce(short_term_repairs_total_usd, 'none')
    WHEN 2 THEN 'NV5 page two' WHEN 3 THEN CASE WHEN k % 2 = 0 THEN 'NV5 again' ELSE 'plain page' END ELSE CASE WHEN k % 2 = 0 THEN 'nv5 last' ELSE 'AEI was here' END END AS text
  FROM property CROSS JOIN (VALUES (1), (2), (3), (4)) AS pages(page_no) WHERE k % 10 <> 9)"""

#: Sections as reports have them: by headings of their own in one order of three (the older layout), by subcategory in the others.
HEADINGS = ["Roofing", "Plumbing systems", "Elevator", "Utilities", "Electrical service", "HVAC", "Regulatory Compliance", "ADA path of travel"]
SPELLED = ["Roofing", "building envelope", "plumbing ", *R.SUBCATEGORIES[6:], "other", "laundry", "Utilities", "site_improvements", "Site Improvements"]
SECTION = f"""section AS (SELECT 'p' || CAST(k AS STRING) AS property_id, row_idx AS pos, CASE WHEN k % 3 <> 0 THEN {pick(f"pk % {len(SPELLED)}", SPELLED)} END AS subcategory, CASE WHEN k % 3 = 0 THEN {pick(f"pk % {len(HEADINGS)}", HEADINGS)} END AS system_name,
  CASE WHEN k % 3 = 0 AND pk % 5 <> 0 THEN '3.' || CAST(row_idx AS STRING) END AS section_code, {pick("pk % 4", ["good", "fair", None, "poor"])} AS condition, CASE WHEN pk % 6 = 0 THEN ' repair' WHEN pk % 6 = 1 THEN 'none' WHEN pk % 6 = 2 THEN '' END AS action_required,
  {", ".join(f"CAST(CASE WHEN bucket = '{b}' THEN amount END AS DOUBLE) AS {f}" for b, f in MONEY.items())}, CASE WHEN k % 3 <> 0 AND pk % 3 = 0 THEN 'sec ' || CAST(pk % 4 AS STRING) END AS source_sections,
  CASE WHEN k % 3 <> 0 AND pk % 7 = 0 THEN 'seen' END AS notes, CASE sk % 4 WHEN 0 THEN true WHEN 1 THEN false END AS assessed FROM item)"""

PARTS = {"item": ITEM, "section": SECTION, "sums": SUMS, "property": PROPERTY, "component": COMPONENT, "system": SYSTEM, "cell": CELL, "page": PAGE}
NEEDS = {"item": [], "section": ["item"], "sums": ["item"], "property": ["item", "sums"], "component": ["item"], "system": ["item"], "cell": ["item", "sums", "property"], "page": ["item", "sums", "property"]}
NAMES = ("orders", "lineitem", "part")


def ctes(*names: str) -> str:
    """The named tables and what they need, as a WITH list for DuckDB."""
    need = {n for name in names for n in [*NEEDS[name], name]}
    return ",\n".join(PARTS[n] for n in PARTS if n in need).format(**{n: n for n in NAMES})


def table(spark: SparkSession, sf_dir: str, name: str, **made: DataFrame) -> DataFrame:
    """A table by its SQL; made has tables that it needs and that are there already, as written by the caller."""
    over = {n for m in made for n in NEEDS[m]} - set(made)
    text = ",\n".join(f"{n} AS (SELECT * FROM {{{n}}})" if n in made else PARTS[n] for n in [*NEEDS[name], name] if n not in over)
    used = {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in NAMES if "{" + n + "}" in text} | {n: df for n, df in made.items() if "{" + n + "}" in text}
    return spark.sql(f"WITH {text} SELECT * FROM {name}", **used)
