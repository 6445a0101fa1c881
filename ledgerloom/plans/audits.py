"""Named queries that check records as a whole, over the records that derived.py makes of the order tables, and their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import registries as R
from ledgerloom.operators import grid, merge, rollup
from ledgerloom.operators import verification as V
from ledgerloom.plans import derived, verify
from ledgerloom.plans import revalidate as P
from ledgerloom.plans.registry import _rule_sql, query, t
from ledgerloom.sources import sinks
from ledgerloom.sources.store import Store
from ledgerloom.streaming import feed


def work_folder(spark: SparkSession, what: str) -> str:
    """A folder of its own where all executors can read and write: under spark.checkpoint.dir, or the warehouse."""
    sc = spark.sparkContext
    base = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base}/{what}-{uuid.uuid4().hex}"


def _records(spark: SparkSession, d: str, **made: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    return derived.table(spark, d, "property", **made).drop("k"), derived.table(spark, d, "system", **made), derived.table(spark, d, "component", **made).withColumnRenamed("bucket", "table")


def _items(spark: SparkSession, d: str, folder: str) -> DataFrame:
    """The items of all orders, kept while three tables are made of them: parts are joined and items numbered once, and an order's
    items lie together, so that its sums are shuffled as one row."""
    return verify._once((derived.table(spark, d, "item"),), f"{folder}/item")[0]


def _remove(spark: SparkSession, folder: str) -> None:
    Store(spark, folder, "").remove(folder)


# The same in SQL


def _num(x: str) -> str:
    return f"TRY_CAST(replace(nullif(regexp_extract({x}, '-?[0-9][0-9,]*(?:\\.[0-9]+)?', 0), ''), ',', '') AS DOUBLE)"


def _squash(x: str) -> str:
    return f"regexp_replace(lower({x}), '[^a-z0-9]', '', 'g')"


def _norm(x: str) -> str:
    return f"lower(trim(regexp_replace({x}, '\\s+', ' ', 'g')))"


def _in_order(hay: str, a: str, b: str) -> str:
    return f"(strpos({hay}, {a}) > 0 AND ({b} IS NULL OR strpos(substr({hay}, strpos({hay}, {a}) + length({a})), {b}) > 0))"


_votes = ", ".join(f"({i}, '{n.replace(chr(39), chr(39) * 2)}', '{p.removeprefix('(?iu)')}')" for i, (n, p) in enumerate(R.FIRM_RULES) if n not in (R.FIRM_OTHER, "Partners"))
_canon = "CASE " + " ".join(f"WHEN regexp_matches(firm, '(?i){p.removeprefix('(?iu)')}') THEN '{n}'" for n, p in R.FIRM_RULES if n not in (R.FIRM_OTHER, "Partners")) + " ELSE firm END"
#: Firms by the votes of pages (no text here has the one pattern that needs a lookahead).
REPAIRED = f"""rule(rank, label, pattern) AS (VALUES {_votes}), asked AS (SELECT property_id, coalesce(regexp_matches(report_firm, '(?i){R.CLIENTS}'), FALSE) AS client, report_firm FROM property
  WHERE report_firm IS NULL OR trim(report_firm) = '' OR regexp_matches(report_firm, '(?i){R.CLIENTS}')),
vote AS (SELECT property_id, rank, label, count(*) AS hits, min(page_no) AS first FROM page JOIN rule ON regexp_matches(regexp_replace(lower(text), '{R.CLIENTS}', ' ', 'g'), pattern) GROUP BY 1, 2, 3),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY property_id ORDER BY hits DESC, first, rank) AS place FROM vote) WHERE place = 1),
repaired AS (SELECT property_id, label AS firm, hits FROM best JOIN asked USING (property_id) WHERE hits >= CASE WHEN client THEN 1 ELSE 3 END AND label IS DISTINCT FROM report_firm)"""
_totals = list(R.STATED_TOTALS.values())
_span = "CASE WHEN eul_years LIKE '%-%' THEN CAST(string_split(eul_years, '-')[2] AS DOUBLE) ELSE {} END".format(_num("eul_years"))
#: Tables with typed values.
TYPED = f"""p AS (SELECT property_id, {_canon} AS report_firm, {_num("year_built")} AS year_built, CASE num_stories WHEN 'One and two floors' THEN 2 WHEN '1-4' THEN 4 ELSE {_num("num_stories")} END AS num_stories, num_stories = 'tall' AS lost,
  overall_condition, report_date, {_num("contingency_pct")} AS pct, {_num("contingency_usd")} AS contingency_usd, {", ".join(f"{_num(f)} AS {f}" for f in _totals)}
  FROM (SELECT property.*, coalesce(repaired.firm, report_firm) AS firm FROM property LEFT JOIN repaired USING (property_id))),
s AS (SELECT property_id, row_idx, subcategory, assessed, condition, {_num("condition_rating_numeric")} AS rating, source_sections, {", ".join(f"CAST({f} AS DOUBLE) AS {f}" for f in derived.MONEY.values())} FROM system),
c AS (SELECT property_id, row_idx, bucket, {_num("total_cost_usd")} AS total, total_cost_usd = 'see note' AS lost, {_num("quantity")} AS q, {_num("unit_cost_usd")} AS unit, replace_percent, qty_in_eval_period, {_span} AS eul,
  CAST(effective_age_years AS DOUBLE) AS age, CAST(rul_years AS DOUBLE) AS rul, years_inflated, coalesce({", ".join(f"CAST(year_{i} AS DOUBLE)" for i in range(1, R.YEARS + 1))}, 0) AS years FROM component)"""
_cents = "CAST(sum(CASE WHEN {} THEN CAST({} AS DECIMAL(18,2)) END) AS DOUBLE)"
TOTALS = f"""cs AS (SELECT property_id, count(*) AS c_rows, {_cents.format("bucket <> 'reserve'", "total")} AS near, {", ".join(f"{_cents.format(f"bucket = '{b}'", 'total')} AS c_{b}, count(*) FILTER (bucket = '{b}') AS n_{b}" for b in R.STATED_TOTALS)} FROM c GROUP BY 1),
ss AS (SELECT property_id, count(*) AS s_rows, count(*) FILTER (assessed) AS n_assessed, count(DISTINCT subcategory) AS n_subs, {", ".join(f"{_cents.format('TRUE', f)} AS s_{f}" for f in derived.MONEY.values())} FROM s GROUP BY 1),
tt AS (SELECT p.*, c_rows, near, n_assessed, n_subs, s_rows, {", ".join(f"c_{b}, coalesce(n_{b}, 0) AS n_{b}" for b in R.STATED_TOTALS)}, {", ".join(f"s_{f}" for f in derived.MONEY.values())} FROM p LEFT JOIN cs USING (property_id) LEFT JOIN ss USING (property_id))"""


def _ok(stated: str, summed: str) -> str:
    tol = f"greatest(1.0, abs({stated}) * {R.RELATIVE})"
    return f"({stated} IS NULL OR {summed} IS NULL OR abs({stated} - {summed}) <= {tol} OR coalesce(pct <> 0 AND abs({stated} - {summed} * (1 + pct / 100)) <= {tol}, FALSE) OR coalesce(contingency_usd <> 0 AND abs({stated} - ({summed} + contingency_usd)) <= {tol}, FALSE))"


def _pair(name: str, field: str, layer: str, at: str) -> str:
    ok = _ok(field, ("s_" if layer == "systems" else "c_") + at)
    return f"SELECT property_id, 'cross-table', NULL, '{name}', 'reconcile' FROM tt WHERE NOT ({ok}{f' OR {_ok(field, "near")}' if name.startswith('immediate') else ''})"


_WHOLE = [
    *(_pair(*x) for x in R.PAIRS),
    "SELECT property_id, 'systems', NULL, 'n_rows', CASE WHEN coalesce(n_assessed, 0) = 0 THEN 'empty' ELSE 'sparse' END FROM tt WHERE coalesce(n_assessed, 0) < 4",
    "SELECT property_id, 'components', NULL, 'n_rows', 'empty' FROM tt WHERE c_rows IS NULL",
    *(f"SELECT property_id, 'components', NULL, '{f}', 'empty' FROM tt WHERE {f} > 0 AND (n_{b} = 0 OR c_{b} IS NULL)" for b, f in R.STATED_TOTALS.items()),
    "SELECT property_id, 'systems', NULL, 'subcategory', 'shape' FROM tt WHERE n_subs < 12",
    "SELECT DISTINCT property_id, 'systems', NULL, 'subcategory', 'shape' FROM s GROUP BY property_id, subcategory HAVING count(*) > 1",
]
_ROWS = [
    "SELECT property_id, 'property', NULL, 'year_built', 'range' FROM p WHERE year_built < 1850 OR year_built > 2026",
    "SELECT property_id, 'property', NULL, 'num_stories', 'range' FROM p WHERE num_stories < 1 OR num_stories > 120",
    "SELECT property_id, 'property', NULL, 'num_stories', 'type_coercion' FROM p WHERE lost",
    "SELECT property_id, 'property', NULL, 'overall_condition', 'category' FROM p WHERE overall_condition = 'shabby'",
    "SELECT property_id, 'property', NULL, 'report_date', 'date' FROM p WHERE report_date = 'Jan 5'",
    f"SELECT property_id, 'property', NULL, 'report_firm', 'firm' FROM p WHERE regexp_matches(report_firm, '(?i){R.CLIENTS}')",
    "SELECT property_id, 'systems', row_idx, 'condition', 'category' FROM s WHERE condition = 'shabby'",
    "SELECT property_id, 'systems', row_idx, 'condition_rating_numeric', 'range' FROM s WHERE rating > 5",
    "SELECT property_id, 'systems', row_idx, 'assessed', 'contradiction' FROM s WHERE NOT assessed AND condition IS NOT NULL",
    "SELECT property_id, 'components', row_idx, 'rul_years', 'physics' FROM c WHERE rul > eul",
    "SELECT property_id, 'components', row_idx, 'total_cost_usd', 'type_coercion' FROM c WHERE lost",
    f"SELECT property_id, 'components', row_idx, 'total_cost_usd', 'reconcile' FROM c WHERE bucket = 'reserve' AND NOT years_inflated AND years > 0 AND abs(total - years) > greatest(1.0, abs(total) * {R.RELATIVE})",
]
_ARITHMETIC = [
    f"""SELECT property_id, 'components', row_idx, 'unit_cost_usd', 'arithmetic' FROM c WHERE coalesce(replace_percent, '100') = '100' AND qty_in_eval_period IS NULL AND q > 0 AND unit > 0 AND abs(q * unit - total) > greatest(1.0, q * unit * {R.RELATIVE})
      AND NOT (round_even(total / (q * unit), 0) BETWEEN 1 AND 20 AND abs(total / (q * unit) - round_even(total / (q * unit), 0)) <= {R.RATIO_GAP})""",
    f"SELECT property_id, 'components', row_idx, 'rul_years', 'arithmetic' FROM c WHERE abs(eul - age - rul) > {R.LIFE_GAP}",
]
_HAY = f"""hay AS (SELECT property_id, string_agg({_norm("text")}, ' ' ORDER BY page_no) AS n, string_agg({_squash("text")}, '' ORDER BY page_no) AS q FROM page GROUP BY 1),
cited AS (SELECT *, CASE WHEN strpos(snippet, '...') > 0 THEN trim(string_split(snippet, '...')[1]) ELSE snippet END AS a, CASE WHEN strpos(snippet, '...') > 0 THEN trim(string_split(snippet, '...')[2]) END AS b FROM cell WHERE value IS NOT NULL AND snippet <> ''),
amount AS ({" UNION ALL ".join(f"SELECT property_id, '{f}' AS field, {f} AS v FROM p" for f in ["contingency_usd", *_totals])})"""
_whole = "CAST(CAST(round_even(v, 0) AS BIGINT) AS VARCHAR)"
_DOCUMENT = [
    f"SELECT property_id, 'property', NULL, field, 'grounding' FROM cited JOIN hay USING (property_id) WHERE NOT ({_in_order('n', _norm('a'), _norm('b'))} OR {_in_order('q', _squash('a'), _squash('b'))})",
    f"SELECT property_id, 'property', NULL, field, 'not_in_text' FROM amount JOIN hay USING (property_id) WHERE v > 0 AND NOT (contains(q, {_whole}) OR contains(q, {_whole} || '00') OR contains(q, {_squash('format(' + chr(39) + '{:.2f}' + chr(39) + ', v)')}))",
]
_BASE = f"WITH {derived.ctes('property', 'component', 'system', 'cell', 'page')},\n{REPAIRED},\n{TYPED},\n{TOTALS},\n{_HAY}"
_NO_REPAIR = "repaired(property_id, firm) AS (SELECT property_id, report_firm FROM property WHERE FALSE)"
_UNREPAIRED = f"WITH {derived.ctes('property', 'component', 'system')},\n{_NO_REPAIR},\n{TYPED},\n{TOTALS}"


def _issues(*parts: list[str]) -> str:
    return "issue(property_id, layer, row_idx, field, kind) AS (" + "\nUNION ALL ".join(x for p in parts for x in p) + ")"


_RECON, _ADVISORY = "kind IN ('reconcile', 'empty', 'sparse')", "kind IN ('arithmetic', 'grounding', 'not_in_text')"
_STOP = f"({_RECON} OR (NOT {_ADVISORY} AND (layer <> 'property' OR kind = 'type_coercion')))"
FOLD = f"""folded AS (SELECT property_id, count(*) FILTER (NOT {_RECON} AND NOT {_ADVISORY}) AS det, count(*) FILTER ({_RECON}) AS recon, count(*) FILTER (kind = 'arithmetic') AS arith, count(*) FILTER (kind = 'grounding') AS ground, count(*) FILTER (kind = 'not_in_text') AS missing,
  count(*) FILTER ({_STOP}) AS stop, string_agg(DISTINCT kind, '; ' ORDER BY kind) FILTER ({_STOP}) AS why, bool_or(layer = 'components' AND kind = 'empty') AS none, bool_or(kind = 'reconcile' AND contains(field, 'components')) AS untied FROM issue GROUP BY 1)"""


@query(f"""{_BASE}, {_issues(_WHOLE, _ROWS, _ARITHMETIC, _DOCUMENT)}, {FOLD}
SELECT tt.property_id, report_firm, coalesce(s_rows, 0) AS systems_rows, coalesce(c_rows, 0) AS component_rows, CASE WHEN coalesce(stop, 0) = 0 THEN 'clean' ELSE 'needs_review' END AS status, coalesce(det, 0) AS det_issues, coalesce(recon, 0) AS recon_issues,
  coalesce(arith, 0) AS arithmetic_issues, coalesce(ground, 0) AS grounding_fails, coalesce(missing, 0) AS not_in_text, coalesce(why, '') AS why, CASE WHEN none THEN 'no_line_items' WHEN untied THEN 'does_not_tie' ELSE 'ok' END AS target_quality
FROM tt LEFT JOIN folded USING (property_id)""")
def verify_offline(spark, d) -> DataFrame:
    """Every check of every record, folded into one verdict a property."""
    folder = work_folder(spark, "verify")
    item = _items(spark, d, folder)
    (p,) = verify._once((derived.table(spark, d, "property", item=item),), f"{folder}/property")
    _, s, c = _records(spark, d, item=item)
    found = verify.verify(p.drop("k"), s, c, derived.table(spark, d, "cell", property=p), derived.table(spark, d, "page", property=p), folder).verdicts
    _remove(spark, f"{folder}/item")
    return found


@query(f"{_UNREPAIRED}, {_issues(_WHOLE, _ROWS, _ARITHMETIC)} SELECT property_id, layer, row_idx, field, kind FROM issue")
def record_issues(spark, d) -> DataFrame:
    """The issues that records show by themselves, row by row: ten pairs, completeness, shape, years, bounds, words, dates, physics, arithmetic."""
    folder = work_folder(spark, "issues")
    p, s, c = verify._once(P.coerced(*_records(spark, d, item=_items(spark, d, folder)), verify.FIRMS), folder)
    _remove(spark, f"{folder}/item")
    return P.record_issues(p, s, c, V.totals(p, s, c), more=True).drop("detail")


@query(f"{_BASE}, {_issues(_DOCUMENT)} SELECT property_id, field, kind FROM issue")
def document_issues(spark, d) -> DataFrame:
    """Snippets and amounts that the pages of a record don't have."""
    p = derived.table(spark, d, "property")
    return V.document_issues(p, derived.table(spark, d, "cell"), derived.table(spark, d, "page")).select("property_id", "field", "kind")


@query(f"""WITH {derived.ctes("property", "page")}, {REPAIRED}
SELECT property_id, 'report_firm' AS field, coalesce(repaired.firm, report_firm) AS value, CASE WHEN repaired.firm IS NULL THEN 'cover' END AS snippet, CASE WHEN repaired.firm IS NULL THEN 0.5 ELSE 0.9 END AS confidence FROM property LEFT JOIN repaired USING (property_id)""")
def firm_repair(spark, d) -> DataFrame:
    p = derived.table(spark, d, "property")
    cells = p.select("property_id", F.lit("report_firm").alias("field"), F.col("report_firm").alias("value"), F.lit("cover").alias("snippet"), F.lit(0.5).alias("confidence"))
    return V.repaired_cells(cells, V.repaired_firms(p, derived.table(spark, d, "page")))


_RAW = ["total_cost_usd", "eul_years", "rul_years", "quantity", "unit_cost_usd"]


@query(f"""WITH {derived.ctes("component", "system")}, cell AS ({" UNION ALL ".join(f"SELECT property_id, row_idx, 'components' AS layer, '{f}' AS field, {f} AS v FROM component" for f in _RAW)} UNION ALL SELECT property_id, row_idx, 'systems', 'condition_rating_numeric', condition_rating_numeric FROM system)
SELECT property_id, layer, row_idx, field, 'type' AS kind, v AS detail FROM cell WHERE v IS NOT NULL AND {_num("v")} IS NULL
UNION ALL SELECT property_id, layer, row_idx, field, 'range', '7.0' FROM cell WHERE field = 'condition_rating_numeric' AND v = '7'
UNION ALL SELECT property_id, 'systems', row_idx, 'condition', 'category', lower(condition) FROM system WHERE lower(condition) IN ('shabby', 'good to fair', 'n/a')""")
def typed_checks(spark, d) -> DataFrame:
    """The checks of raw cells, before anything is coerced: what isn't a number, what is out of bounds, words outside the vocabulary."""
    _, s, c = _records(spark, d)
    rows = V.exploded(c, V.typed(c, "components", {f: R.COMPONENT_BOUNDS[f] for f in _RAW}), "row_idx")
    return rows.unionByName(V.exploded(s, V.typed(s, "systems", {"condition_rating_numeric": R.SYSTEM_BOUNDS["condition_rating_numeric"]}, {"condition": R.CONDITIONS}), "row_idx"))


@query(f"""WITH {derived.ctes("system")}, issue AS (SELECT property_id, 'systems' AS layer, row_idx, 'condition_rating_numeric' AS field, 'range' AS kind FROM system WHERE condition_rating_numeric = '7'
  UNION ALL SELECT property_id, 'systems', row_idx, 'condition', 'category' FROM system WHERE lower(condition) IN ('shabby', 'good to fair', 'n/a'))
SELECT property_id, CAST(to_json(list(struct_pack(layer := layer, row_idx := row_idx, field := field, kind := kind) ORDER BY layer, row_idx, field, kind)) AS VARCHAR) AS flags FROM issue GROUP BY 1""")
def review_flags(spark, d) -> DataFrame:
    """The issues of each record as one JSON list."""
    _, s, _ = _records(spark, d)
    found = V.exploded(s, V.typed(s, "systems", {"condition_rating_numeric": R.SYSTEM_BOUNDS["condition_rating_numeric"]}, {"condition": R.CONDITIONS}), "row_idx")
    return sinks.flags(found.drop("detail"))


@query("""WITH x AS (SELECT o_orderstatus || '|' AS status, count(*) AS n FROM orders GROUP BY 1), r AS (SELECT row_number() OVER (ORDER BY status) + 1 AS line, '| ' || replace(status, '|', chr(92) || '|') || ' | ' || n || ' |' AS text FROM x)
SELECT 0 AS line, '| status | n |' AS text UNION ALL SELECT 1, '|-|-|' UNION ALL SELECT line, text FROM r""")
def markdown_table(spark, d) -> DataFrame:
    """Status counts as the lines of a Markdown table."""
    counts = rollup.value_counts(t(spark, d, "orders").select(F.concat("o_orderstatus", F.lit("|")).alias("status")), "status")
    return sinks.markdown(counts, "status")


_WORDS = "CASE {0} WHEN 'Good' THEN 'good' WHEN 'Good to fair' THEN 'good; fair' WHEN 'good to fair' THEN 'good; fair' WHEN 'N/A' THEN 'na' ELSE {0} END"


@query(f"""WITH {derived.ctes("property", "component", "system")}, {_NO_REPAIR}, {TYPED}
SELECT 'property' AS layer, property.property_id, CAST(NULL AS INT) AS row_idx, {_WORDS.format("property.overall_condition")} AS words, p.num_stories AS a, CASE property.num_stories WHEN 'One and two floors' THEN 1 WHEN '1-4' THEN 1 END AS lo, CASE property.num_stories WHEN 'One and two floors' THEN 2 WHEN '1-4' THEN 4 END AS hi,
  CASE property.state WHEN 'Texas' THEN 'TX' WHEN 'tx' THEN 'TX' WHEN 'ny ' THEN 'NY' ELSE property.state END AS code, p.report_firm AS label FROM property JOIN p USING (property_id)
UNION ALL SELECT 'components', c.property_id, c.row_idx, NULL, c.total, CASE WHEN eul_years LIKE '%-%' THEN CAST(string_split(eul_years, '-')[1] AS DOUBLE) END, CASE WHEN eul_years LIKE '%-%' THEN c.eul END, NULL, NULL FROM c JOIN component USING (property_id, row_idx)
UNION ALL SELECT 'systems', property_id, row_idx, {_WORDS.format("condition")}, rating, NULL, NULL, NULL, NULL FROM s""")
def coerced_records(spark, d) -> DataFrame:
    """What coercion makes of the three tables: words, numbers, ends of ranges, states, firms."""
    p, s, c = P.coerced(*_records(spark, d), verify.FIRMS)
    null = lambda kind: F.lit(None).cast(kind)
    rows = p.select(F.lit("property").alias("layer"), "property_id", null("int").alias("row_idx"), F.col("overall_condition").alias("words"), F.col("num_stories").alias("a"), F.col("num_stories_min").alias("lo"), F.col("num_stories_max").alias("hi"), F.col("state").alias("code"), F.col("report_firm").alias("label"))
    rows = rows.unionByName(c.select(F.lit("components").alias("layer"), "property_id", "row_idx", null("string").alias("words"), F.col("total_cost_usd").alias("a"), F.col("eul_years_min").alias("lo"), F.col("eul_years_max").alias("hi"), null("string").alias("code"), null("string").alias("label")))
    return rows.unionByName(s.select(F.lit("systems").alias("layer"), "property_id", "row_idx", F.col("condition").alias("words"), F.col("condition_rating_numeric").alias("a"), null("double").alias("lo"), null("double").alias("hi"), null("string").alias("code"), null("string").alias("label")))


@query(f"""{_BASE}, {_issues([x for x in _ROWS if "'property', NULL" in x], _DOCUMENT[:1])}
SELECT DISTINCT property_id, field FROM issue UNION SELECT property_id, field FROM cell WHERE value IS NOT NULL AND confidence <= {R.LOW_CONFIDENCE}""")
def suspect_fields(spark, d) -> DataFrame:
    """Fields of a property worth a second look: a failed check, a snippet that isn't there, a low confidence."""
    p, s, c = _records(spark, d)
    cells, pages = derived.table(spark, d, "cell"), derived.table(spark, d, "page")
    q = P.numbers(P.coerce_properties(V.with_repaired_firms(p, V.repaired_firms(p, pages)), verify.FIRMS), R.PROPERTY_BOUNDS, "property")
    own = V.exploded(q, [*V.client_firm(), *V.typed(q, "property", R.PROPERTY_BOUNDS, {"overall_condition": R.CONDITIONS}, ["report_date"])], lost="__lost")
    lost = V.document_issues(q, cells, pages, amounts=False)
    unsure = cells.where(F.col("value").isNotNull() & (F.col("confidence") <= R.LOW_CONFIDENCE))
    return merge.suspect_fields(own, lost, unsure)


_cost = "greatest(" + ", ".join(f"coalesce({f}, 0)" for f in derived.MONEY.values()) + ") > 0"
_priority = ", ".join(f"'{x}'" for x in R.PRIORITY)


@query(f"""{_UNREPAIRED}, {_issues([x for x in _ROWS if "'systems', row_idx" in x])}, w AS (
  SELECT issue.property_id, subcategory, CASE WHEN kind = 'category' THEN 1 ELSE 3 END AS weight FROM issue JOIN s USING (property_id, row_idx)
  UNION ALL SELECT property_id, subcategory, CASE WHEN condition IS NULL AND rating IS NULL THEN 2 WHEN source_sections IS NULL THEN 2 WHEN subcategory IN ({_priority}) THEN 1 END FROM s WHERE assessed AND {_cost}),
b AS (SELECT property_id, subcategory, max(weight) AS weight FROM w WHERE weight IS NOT NULL GROUP BY 1, 2)
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY property_id ORDER BY weight DESC, subcategory) AS INT) AS rank FROM b) WHERE rank <= 4""")
def suspect_rows(spark, d) -> DataFrame:
    """Up to four systems rows of a property worth a second look, the worst first."""
    _, s, _ = _records(spark, d)
    s = P.numbers(P.coerce_systems(s), R.SYSTEM_BOUNDS, "systems")
    return merge.suspect_systems(s, V.exploded(s, V.of_systems(s), "row_idx"))


# A stored table, revalidated

OPEN = "CASE WHEN CAST(substr(property_id, 2) AS BIGINT) % 23 = 0 THEN 2 ELSE 0 END"


@query(f"""{_UNREPAIRED}, {_issues(_WHOLE, _ROWS)}, {FOLD}
SELECT tt.property_id, {OPEN.replace("property_id", "tt.property_id")} AS unresolved, CASE WHEN coalesce(stop, 0) = 0 AND {OPEN.replace("property_id", "tt.property_id")} = 0 THEN 'clean' ELSE 'needs_review' END AS status, coalesce(det, 0) AS det_issues, coalesce(recon, 0) AS recon_issues,
  coalesce(why, CASE WHEN {OPEN.replace("property_id", "tt.property_id")} > 0 THEN 'unverified fields' ELSE '' END) AS why, TRUE AS revalidated FROM tt LEFT JOIN folded USING (property_id)""")
def revalidate_stored(spark, d) -> DataFrame:
    """Records are put into a store as an earlier run left them, some with fields that a review left open, and revalidated there (tests run it again)."""
    folder = work_folder(spark, "records")
    p, s, c = _records(spark, d, item=_items(spark, d, folder))
    envelopes = p.select("property_id", F.expr(OPEN).alias("unresolved"), F.lit("clean").alias("status"))
    verify.store_records(spark, folder, envelopes, p, s, c, 16)
    _remove(spark, f"{folder}/item")
    return verify.revalidate_store(spark, folder, 16)


@query("SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(event_type, (ts, event_id)) AS event_type, max(ts) AS ts FROM events WHERE user_id IS NOT NULL GROUP BY 1")
def latest_by_key(spark, d) -> DataFrame:
    """Each user's newest event in a keyed store, filled in three changes of which the last repeats what came before."""
    e = t(spark, d, "events").where("user_id IS NOT NULL").select("user_id", "ts", "event_id", "event_type")
    store = Store(spark, work_folder(spark, "latest"), "user_id", 16)
    for part in (e.where("event_id % 2 = 1"), e.where("event_id % 2 = 0"), e):
        store.upsert(part, "ts", "event_id")
    return store.read().select("user_id", "event_id", "event_type", "ts")


@query("SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value FROM events WHERE user_id IS NOT NULL GROUP BY 1")
def stream_latest(spark, d) -> DataFrame:
    """The events table as a feed of files, taken into a keyed store twice: the second feed knows nothing of the first, and changes nothing."""
    folder = work_folder(spark, "feed")
    store = Store(spark, f"{folder}/latest", "user_id", 16)
    for run in range(2):
        events = spark.readStream.schema("event_id long, user_id long, event_type string, value double").option("maxFilesPerTrigger", 4).parquet(f"{d}/[e]vents.parquet")  # a pattern: a stream of one plain file path isn't read
        feed.upsert_available(events.where("user_id IS NOT NULL"), store, ("event_id",), f"{folder}/checkpoint-{run}").awaitTermination()
    return store.read().select("user_id", "event_id", "event_type", "value")


@query("""SELECT o_orderkey, o_orderpriority AS version, 2 * o_totalprice AS amount, CASE WHEN o_orderpriority < '4' AND o_orderkey % 2 = 0 THEN 1 ELSE 2 END AS run FROM orders""")
def cached_results(spark, d) -> DataFrame:
    """Results by key and version: a first run over half of the orders, a second over all, with other versions for some; only what is new is computed again."""
    o = t(spark, d, "orders").select("o_orderkey", F.col("o_orderpriority").alias("version"), "o_totalprice")
    store = Store(spark, work_folder(spark, "results"), "o_orderkey", 16)
    made = lambda run: lambda x: x.select("o_orderkey", "version", (F.col("o_totalprice") * 2).alias("amount"), F.lit(run).alias("run"))
    older = o.where("o_orderkey % 2 = 0").withColumn("version", F.when(F.col("version") < "4", F.col("version")).otherwise("older"))
    feed.results(older, store, "version", made(1))
    return feed.results(o, store, "version", made(2))


def _texts(f: str) -> str:
    return f"{f}_t AS (SELECT property_id, sub, string_agg(v, '; ' ORDER BY p) AS {f} FROM (SELECT property_id, sub, trim({f}) AS v, min(pos) AS p FROM row WHERE trim({f}) <> '' GROUP BY 1, 2, 3) GROUP BY 1, 2)"


_FLAT = "coalesce(replace(trim(lower(subcategory)), ' ', '_'), '')"
_SLUGS = ", ".join(f"'{x}'" for x in R.SUBCATEGORIES)
_MONEYS = list(derived.MONEY.values())
_BLANK = "coalesce(trim({}), '')"
#: Rows of sections with their subcategory, merged, laid over the grid.
_MERGED = f"""{", ".join(_texts(f) for f in grid.TEXTS)},
m AS (SELECT property_id, sub, arg_min(condition, pos) FILTER (condition IS NOT NULL) AS condition, {", ".join(f"CAST(sum(CAST({f} AS DECIMAL(18,2))) AS DOUBLE) AS {f}" for f in _MONEYS)}, bool_or(assessed) AS said FROM row GROUP BY 1, 2),
n AS (SELECT m.*, {", ".join(grid.TEXTS)}, coalesce(said, {" OR ".join(f"{f} IS NOT NULL" for f in ["condition", *grid.TEXTS, *_MONEYS])}) AS assessed FROM m {" ".join(f"LEFT JOIN {f}_t USING (property_id, sub)" for f in grid.TEXTS)}),
out AS (SELECT k.property_id, a.sub AS subcategory, condition, {", ".join(grid.TEXTS)}, {", ".join(_MONEYS)}, coalesce(assessed, FALSE) AS assessed FROM (SELECT DISTINCT property_id FROM row) k CROSS JOIN (SELECT unnest([{_SLUGS}]) AS sub) a LEFT JOIN n ON n.property_id = k.property_id AND n.sub = a.sub
  UNION ALL SELECT property_id, sub, condition, {", ".join(grid.TEXTS)}, {", ".join(_MONEYS)}, TRUE FROM n WHERE sub = 'other' AND ({" OR ".join(f"coalesce({f} <> 0, FALSE)" for f in _MONEYS)}))"""
_COLUMNS = ["property_id", "subcategory", "condition", *grid.TEXTS, *_MONEYS, "assessed"]


@query(f"""WITH {derived.ctes("section")}, row AS (SELECT *, CASE WHEN {_FLAT} IN ({_SLUGS}, 'other') THEN {_FLAT} ELSE {_rule_sql(R.SUBCATEGORY_RULES, f"concat_ws(' ', {_BLANK.format('subcategory')}, {_BLANK.format('source_sections')}, {_BLANK.format('notes')})")} END AS sub FROM section WHERE subcategory IS NOT NULL), {_MERGED}
SELECT {", ".join(_COLUMNS)} FROM out""")
def normalised_groups(spark, d) -> DataFrame:
    """Twelve rows a property from rows as they were extracted: spelled otherwise, unknown, repeated or missing."""
    rows = derived.table(spark, d, "section").where("subcategory IS NOT NULL").drop("system_name", "section_code")
    return grid.normalise_systems(rows).select(*_COLUMNS)


@query(f"""WITH {derived.ctes("section")}, row AS (SELECT * REPLACE (TRUE AS assessed, CAST(NULL AS VARCHAR) AS notes, nullif(trim(concat_ws(' ', {_BLANK.format('section_code')}, {_BLANK.format('system_name')})), '') AS source_sections), {_rule_sql(R.SUBCATEGORY_RULES, 'system_name')} AS sub FROM section WHERE subcategory IS NULL), {_MERGED}
SELECT {", ".join(_COLUMNS)} FROM out UNION ALL SELECT {", ".join(_COLUMNS)} FROM section WHERE subcategory IS NOT NULL""")
def migrated_groups(spark, d) -> DataFrame:
    """Properties of the older layout brought to twelve rows, all others as they are; a second migration changes nothing."""
    (rows,) = verify._once((grid.mark_legacy(derived.table(spark, d, "section")),), work_folder(spark, "sections"))
    (once,) = verify._once((grid.migrate_legacy_systems(rows),), work_folder(spark, "migrated"))
    again = once.withColumns({"pos": F.lit(0), "system_name": F.lit(None).cast("string"), "section_code": F.lit(None).cast("string")})
    return grid.migrate_legacy_systems(again).select(*_COLUMNS)
