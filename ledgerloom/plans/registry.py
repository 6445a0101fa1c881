"""Named queries over the driver's tables and the SQL that gives the same rows.

The tables have no reports, so each operator runs on what corresponds: an order's total is a stated total and its line
items are the items; nations stand for properties, part types for the fixed axis, l_returnflag for the bucket.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom import registries as R
from ledgerloom.functions import coerce, rules, text
from ledgerloom.operators import checks, dedupe, grid, grounding, merge, profile, reconcile, rollup
from ledgerloom.sources import sinks

_queries: dict[str, Callable] = {}
_sql: dict[str, str] = {}
TYPES = ["PROMO", "STANDARD", "ECONOMY", "SMALL", "MEDIUM", "LARGE"]
#: Rules for part names, without lookaround so that both engines read them alike.
NAME_RULES = [("metal", r"(?i)\b(?:steel|copper|brass|tin|nickel|iron|metal)\w*"), ("colour", r"(?i)\b(?:red|blue|green|black|white|yellow)\w*"), ("size", r"(?i)\b(?:small|large|tiny|huge|big)\w*"), ("widget", r"(?i)\b(?:widget|gear|bolt|gadget|valve)\w*")]
STYLE = [("table", r" \| "), ("shout", r"[A-Z]{4,}!!"), ("symbols", r"\*\*\*|&&&|%%%"), ("license", r"(?i)license"), ("prose", r"[.] ?")]
CENTS = "decimal(18,2)"


def query(sql: str | None = None):
    def add(f):
        _queries[f.__name__] = f
        if sql:
            _sql[f.__name__] = sql
        return f

    return add


def t(spark: SparkSession, d: str, *names: str):
    out = [spark.read.parquet(f"{d}/{n}.parquet") for n in names]
    return out if len(out) > 1 else out[0]


@query("""
SELECT o_orderkey, o_totalprice, s.summed, coalesce(s.n_items, 0) AS n_items,
  CASE WHEN o_totalprice IS NULL OR s.summed IS NULL THEN TRUE ELSE abs(o_totalprice - s.summed) <= greatest(1.0, abs(o_totalprice) * 0.015) END AS ties
FROM orders LEFT JOIN (
  SELECT l_orderkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS summed, count(l_extendedprice) AS n_items FROM lineitem GROUP BY 1
) s ON l_orderkey = o_orderkey""")
def reconcile_orders(spark, d) -> DataFrame:
    o, li = t(spark, d, "orders", "lineitem")
    return reconcile.stated_against_items(o.select("o_orderkey", "o_totalprice"), li.select(F.col("l_orderkey").alias("o_orderkey"), "l_extendedprice"), "o_orderkey", "o_totalprice", "l_extendedprice")


@query("""
WITH s AS (SELECT l_orderkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS c, max(l_tax) * 100 AS pct,
    CAST(sum(CASE WHEN l_returnflag <> 'R' THEN CAST(l_extendedprice AS DECIMAL(18,2)) END) AS DOUBLE) AS near FROM lineitem GROUP BY 1),
j AS (SELECT o_orderkey, o_totalprice AS t, c, pct, near FROM orders LEFT JOIN s ON l_orderkey = o_orderkey),
k AS (SELECT *, greatest(1.0, abs(t) * 0.015) AS tol FROM j)
SELECT o_orderkey, (c IS NULL OR abs(t - c) <= tol) AS plain,
  (c IS NULL OR abs(t - c) <= tol OR coalesce(pct <> 0 AND abs(t - c * (1 + pct / 100.0)) <= tol, FALSE)) AS with_contingency,
  (c IS NULL OR abs(t - c) <= tol OR near IS NULL OR abs(t - near) <= tol) AS immediate
FROM k""")
def reconcile_allowances(spark, d) -> DataFrame:
    o, li = t(spark, d, "orders", "lineitem")
    cost = reconcile.money(F.col("l_extendedprice"))
    s = li.groupBy("l_orderkey").agg(F.sum(cost).cast("double").alias("c"), (F.max("l_tax") * 100).alias("pct"), F.sum(F.when(F.col("l_returnflag") != "R", cost)).cast("double").alias("near"))
    j = o.join(s, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    total, c = F.col("o_totalprice"), F.col("c")
    return j.select("o_orderkey", reconcile.reconciles(total, c).alias("plain"), reconcile.reconciles(total, c, F.col("pct")).alias("with_contingency"), reconcile.reconciles_immediate(total, c, F.col("near")).alias("immediate"))


@query("""
SELECT l_orderkey, CAST(sum(CASE WHEN l_returnflag = 'A' THEN CAST(l_extendedprice AS DECIMAL(18,2)) END) AS DOUBLE) AS sum_A,
  CAST(sum(CASE WHEN l_returnflag = 'N' THEN CAST(l_extendedprice AS DECIMAL(18,2)) END) AS DOUBLE) AS sum_N,
  CAST(sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_extendedprice AS DECIMAL(18,2)) END) AS DOUBLE) AS sum_R,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS sum_all FROM lineitem GROUP BY 1""")
def bucket_sums(spark, d) -> DataFrame:
    return reconcile.bucket_sums(t(spark, d, "lineitem"), ["l_orderkey"], "l_returnflag", "l_extendedprice", ["A", "N", "R"])


@query("""
WITH types AS (SELECT DISTINCT p_type FROM part), g AS (SELECT n_nationkey, n_name, p_type FROM nation CROSS JOIN types),
r AS (SELECT s_nationkey, p_type, CAST(sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_extendedprice AS DECIMAL(18,2)) END) AS DOUBLE) AS reserve,
  count(CASE WHEN l_returnflag = 'R' THEN l_extendedprice END) AS n_reserve, CAST(sum(CASE WHEN l_returnflag <> 'R' THEN CAST(l_extendedprice AS DECIMAL(18,2)) END) AS DOUBLE) AS near,
  count(CASE WHEN l_returnflag <> 'R' THEN l_extendedprice END) AS n_near
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)
SELECT n_name, g.p_type, coalesce(reserve, 0) AS reserve_usd, coalesce(near, 0) AS near_term_usd, coalesce(reserve, 0) + coalesce(near, 0) AS total_usd,
  coalesce(n_reserve, 0) AS n_reserve_items, coalesce(n_near, 0) AS n_near_term_items
FROM g LEFT JOIN r ON s_nationkey = n_nationkey AND r.p_type = g.p_type""")
def capex_grid(spark, d) -> DataFrame:
    n, s, p, li = t(spark, d, "nation", "supplier", "part", "lineitem")
    axis = sorted(r[0] for r in p.select("p_type").distinct().collect())  # a fixed axis of a few names
    items = li.join(s, li["l_suppkey"] == s["s_suppkey"]).join(p, li["l_partkey"] == p["p_partkey"]).select(F.col("s_nationkey").alias("n_nationkey"), "p_type", "l_returnflag", "l_extendedprice")
    sums = grid.rollup(items, ["n_nationkey", "p_type"], reconcile.money(F.col("l_extendedprice")), {"reserve": F.col("l_returnflag") == "R", "near_term": F.col("l_returnflag") != "R"})
    out = grid.complete(n, "n_nationkey", "p_type", axis).join(sums, ["n_nationkey", "p_type"], "left").join(n, "n_nationkey")
    a, b = F.coalesce("reserve_usd", F.lit(0.0)), F.coalesce("near_term_usd", F.lit(0.0))
    return out.select("n_name", "p_type", a.alias("reserve_usd"), b.alias("near_term_usd"), (a + b).alias("total_usd"), F.coalesce("n_reserve_items", F.lit(0)).alias("n_reserve_items"), F.coalesce("n_near_term_items", F.lit(0)).alias("n_near_term_items"))


def _case(rules_, col: str, default: str) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches({col}, '{p}') THEN '{label}'" for label, p in rules_) + f" ELSE '{default}' END"


@query(f"SELECT p_partkey, {_case(NAME_RULES, 'p_name', 'other')} AS category FROM part")
def classify_first_match(spark, d) -> DataFrame:
    return t(spark, d, "part").select("p_partkey", rules.first_match(F.col("p_name"), NAME_RULES).alias("category"))


@query(f"""SELECT n, matched, round_even(100.0 * matched / greatest(1, n), 1)::DOUBLE AS matched_pct FROM (
  SELECT count(*) AS n, count(*) FILTER ({_case(NAME_RULES, 'p_name', 'other')} <> 'other') AS matched FROM part)""")
def classify_coverage(spark, d) -> DataFrame:
    return rules.coverage(t(spark, d, "part"), rules.first_match(F.col("p_name"), NAME_RULES))


@query("SELECT p_partkey, " + _case(NAME_RULES, "p_name", "other") + " AS label, CASE " + " ".join(f"WHEN regexp_matches(p_name, '{p}') THEN regexp_extract(p_name, '{p}', 0)" for _, p in NAME_RULES) + " END AS matched FROM part")
def explain_match(spark, d) -> DataFrame:
    return t(spark, d, "part").select("p_partkey", rules.explain(F.col("p_name"), NAME_RULES).alias("e")).select("p_partkey", "e.*")


#: Phrases for the ordered rules, one of each kind and the exceptions that they make; a part gets one by its key.
PHRASES = [
    "ADA path of travel", "fire alarm panel", "fireplace", "elevator modernization", "roof shingles", "rooftop unit", "asphalt seal coat", "boiler", "domestic water heater", "switchgear",
    "window caulking", "foundation settlement", "pool and spa", "spandex", "irrigation", "carpet in corridors", "refrigerator", "structural engineer report", "nothing of note", "laundry room", "range", "arrange",
]


def _portable(pattern: str) -> str:
    """A rule for an engine without lookahead, for texts in which fireplace, rooftop and spa before letters are blanked first."""
    return pattern.replace("(?iu)", "(?i)").replace("(?!place)", "").replace("(?!top)", "").replace("(?![a-z])", "")


def _rule_sql(rules_: list, text_: str) -> str:
    return _case([(k, _portable(p)) for k, p in rules_], text_, R.OTHER)


_of_component = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in R.CATEGORY_TO_SUBCATEGORY.items())
_blank = "regexp_replace(x, '(?i)fireplace|rooftop|spa[a-z]+', '#', 'g')"


@query(f"""WITH a AS (SELECT p_partkey, p_name || ', ' || list_extract({PHRASES!r}, CAST(p_partkey % {len(PHRASES)} AS INT) + 1) AS x FROM part),
b AS (SELECT p_partkey, {_rule_sql(R.CATEGORY_RULES, f"CASE WHEN x ILIKE '%rooftop%' THEN replace(x, 'rooftop', 'rtu') ELSE {_blank} END")} AS category, {_rule_sql(R.SUBCATEGORY_RULES, f"CASE WHEN x ILIKE '%rooftop%' THEN replace(x, 'rooftop', 'rtu') ELSE {_blank} END")} AS subcategory FROM a)
SELECT *, CASE category {_of_component} END AS of_component FROM b""")
def subcategories(spark, d) -> DataFrame:
    x = F.concat("p_name", F.lit(", "), F.element_at(F.array(*map(F.lit, PHRASES)), (F.col("p_partkey") % len(PHRASES)).cast("int") + 1))
    return t(spark, d, "part").select("p_partkey", rules.category(x).alias("category"), rules.subcategory(x).alias("subcategory"), rules.subcategory_of_component(x).alias("of_component"))


@query(f"""WITH a AS (SELECT p_partkey, p_name || ', ' || list_extract({PHRASES!r}, CAST(p_partkey % {len(PHRASES)} AS INT) + 1) AS y FROM part), b AS (SELECT p_partkey, CASE WHEN y ILIKE '%rooftop%' THEN replace(y, 'rooftop', 'rtu') ELSE {_blank.replace("(x,", "(y,")} END AS x, y FROM a)
SELECT p_partkey, {_rule_sql(R.SUBCATEGORY_RULES, "x")} AS label, CASE WHEN y ILIKE '%rooftop unit%' AND x NOT ILIKE '%roof%' THEN 'rooftop unit' {" ".join(f"WHEN regexp_matches(x, '{_portable(p)}') THEN regexp_extract(x, '{_portable(p)}', 0)" for _, p in R.SUBCATEGORY_RULES)} END AS matched FROM b""")
def explain_subcategory(spark, d) -> DataFrame:
    """The winning one of the twelve rules, and the words that it matched."""
    x = F.concat("p_name", F.lit(", "), F.element_at(F.array(*map(F.lit, PHRASES)), (F.col("p_partkey") % len(PHRASES)).cast("int") + 1))
    return t(spark, d, "part").select("p_partkey", rules.explain(x, R.SUBCATEGORY_RULES).alias("e")).select("p_partkey", "e.*")


@query(f"SELECT p_partkey, p_name FROM part WHERE {_case(NAME_RULES[:2], 'p_name', 'other')} = 'other' ORDER BY p_partkey LIMIT 25")
def unmatched_sample(spark, d) -> DataFrame:
    """The first 25 names that no rule knows: what a coverage report shows."""
    return rules.unmatched(t(spark, d, "part").select("p_partkey", "p_name"), rules.first_match(F.col("p_name"), NAME_RULES[:2]), "p_partkey")


SQUASH = "regexp_replace(translate(lower({0}), 'àáâãäåèéêëìíîïòóôõöùúûüýÿñçšž', 'aaaaaaeeeeiiiiooooouuuuyyncsz'), '[^a-z0-9]', '', 'g')"


@query(f"""SELECT doc_id, item_id FROM documents d JOIN benchmark b ON {SQUASH.format('b.text')} <> '' AND contains({SQUASH.format('d.text')}, {SQUASH.format('b.text')})""")
def ground_snippets(spark, d) -> DataFrame:
    docs, b = t(spark, d, "documents", "benchmark")
    return grounding.snippet_hits(docs.select("doc_id", "text"), b.select("item_id", "text"), "doc_id", "item_id")


@query(r"""WITH w AS (SELECT doc_id, text, regexp_extract_all(text, '[A-Za-z]+') AS w FROM documents), f AS (
  SELECT doc_id, text, array_to_string(w[1:2], ' ') AS a, array_to_string(w[greatest(len(w)-1, 1):len(w)], ' ') AS b FROM w), s AS (
  SELECT doc_id, text, CASE WHEN doc_id % 3 = 0 THEN b ELSE a END AS a, CASE WHEN doc_id % 3 = 0 THEN a ELSE b END AS b FROM f)
SELECT doc_id, CAST(CASE WHEN a = '' THEN 0 ELSE 2 END AS BIGINT) AS n_fragments, a <> '' AND strpos(text, a) > 0 AND strpos(substr(text, strpos(text, a) + length(a)), b) > 0 AS in_order FROM s""")
def ordered_fragments(spark, d) -> DataFrame:
    w = F.regexp_extract_all("text", F.lit("[A-Za-z]+"), F.lit(0))
    docs = t(spark, d, "documents").select("doc_id", "text", w.alias("w"))
    first, last = F.concat_ws(" ", F.slice("w", 1, 2)), F.concat_ws(" ", F.slice("w", F.greatest(F.size("w") - 1, F.lit(1)), 2))
    turned = F.col("doc_id") % 3 == 0
    f = text.fragments(F.when(turned, F.concat(last, F.lit(" ... "), first)).otherwise(F.concat(first, F.lit(" … "), last)))
    return docs.select("doc_id", F.size(f).cast("long").alias("n_fragments"), text.contains_ordered(F.col("text"), f).alias("in_order"))


@query("""WITH k AS (SELECT sha256(text) AS h, min(doc_id) AS kept, count(*) AS copies FROM documents GROUP BY 1)
SELECT doc_id, kept, copies FROM documents JOIN k ON sha256(text) = h WHERE doc_id <> kept""")
def dedupe_exact(spark, d) -> DataFrame:
    docs = t(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("h"))
    kept = dedupe.keep_best(docs, ["h"], F.col("doc_id"), "doc_id")
    return kept.where("doc_id <> kept").join(docs.groupBy("h").agg(F.count("*").alias("copies")), "h").select("doc_id", "kept", "copies")


@query("""WITH f AS (SELECT doc_id, source, sha256(text) AS sha, text, n_chars FROM documents), k AS (SELECT sha, min(source || '/' || lpad(CAST(doc_id AS VARCHAR), 12, '0')) AS kept FROM f GROUP BY 1),
a AS (SELECT source || '/' || lpad(CAST(doc_id AS VARCHAR), 12, '0') AS file, sha, text, n_chars, kept FROM f JOIN k USING (sha)),
s AS (SELECT *, CASE WHEN length(trim(text)) >= 200 THEN sha256(trim(text)) END AS page FROM a WHERE file = kept),
p AS (SELECT page, n_chars, min(file) AS kept2 FROM s WHERE page IS NOT NULL GROUP BY 1, 2)
SELECT file, kept, 'same bytes' AS why FROM a WHERE file <> kept
UNION ALL SELECT file, coalesce(kept2, file), CASE WHEN kept2 <> file THEN 'same first page' END FROM s LEFT JOIN p USING (page, n_chars)""")
def dedupe_files(spark, d) -> DataFrame:
    f = t(spark, d, "documents").select(F.concat("source", F.lit("/"), F.lpad(F.col("doc_id").cast("string"), 12, "0")).alias("file"), F.sha2("text", 256).alias("bytes_sha"), F.col("text").alias("first_page_text"), F.col("n_chars").alias("n_pages"))
    return dedupe.dedupe(f)


@query("SELECT doc_id, count(*) OVER (PARTITION BY sha256(text)) > 1 AS duplicated FROM documents")
def dup_flag(spark, d) -> DataFrame:
    return dedupe.duplicate_flag(t(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("h")), "h").select("doc_id", "duplicated")


@query("""WITH h AS (SELECT DISTINCT s_nationkey AS nation, p_type FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey),
a AS (SELECT unnest(['PROMO', 'STANDARD', 'ECONOMY', 'SMALL', 'MEDIUM', 'LARGE', 'NONE']) AS member), n AS (SELECT DISTINCT nation FROM h)
SELECT n.nation, member FROM n CROSS JOIN a WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.nation = n.nation AND h.p_type = member)""")
def grid_missing(spark, d) -> DataFrame:
    s, p, li = t(spark, d, "supplier", "part", "lineitem")
    have = li.join(s, F.col("l_suppkey") == F.col("s_suppkey")).join(p, F.col("l_partkey") == F.col("p_partkey")).select(F.col("s_nationkey").alias("nation"), "p_type")
    return checks.missing_members(have, "nation", "p_type", [*TYPES, "NONE"])


@query("""WITH w AS (SELECT l_orderkey, l_returnflag || l_linestatus AS member, CAST(max(l_quantity) AS DOUBLE) AS weight FROM lineitem GROUP BY 1, 2)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY weight DESC, member) AS rank FROM w) WHERE rank <= 2""")
def suspect_topk(spark, d) -> DataFrame:
    li = t(spark, d, "lineitem").select("l_orderkey", F.concat("l_returnflag", "l_linestatus").alias("member"), F.col("l_quantity").cast("double").alias("weight"))
    return merge.top_suspects(li, "l_orderkey", "member", "weight", 2).withColumn("rank", F.col("rank").cast("long"))


@query("""SELECT conv_id, turn, coalesce(f, FALSE) OR coalesce(lag(f) OVER w, FALSE) OR coalesce(lead(f) OVER w, FALSE) AS selected
FROM (SELECT conv_id, turn, length(text) > 400 AS f FROM conversations) WINDOW w AS (PARTITION BY conv_id ORDER BY turn)""")
def neighbor_pages(spark, d) -> DataFrame:
    c = t(spark, d, "conversations").select("conv_id", "turn", (F.length("text") > 400).alias("f"))
    return dedupe.neighbours(c, "conv_id", "turn", "f").select("conv_id", "turn", "selected")


@query("WITH l(rank, label, p) AS (VALUES " + ", ".join(f"({i}, '{a}', '{p}')" for i, (a, p) in enumerate(STYLE)) + """),
h AS (SELECT source, rank, label, count(*) AS hits, min(doc_id) AS first FROM documents, l WHERE regexp_matches(text, p) GROUP BY 1, 2, 3)
SELECT source, label, hits FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY hits DESC, first, rank) AS r FROM h) WHERE r = 1""")
def vote_argmax(spark, d) -> DataFrame:
    return rules.vote(t(spark, d, "documents"), "source", "text", STYLE, "doc_id")


@query("""SELECT l_orderkey, l_linenumber, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS l_extendedprice, string_agg(DISTINCT l_returnflag, '; ' ORDER BY l_returnflag) AS flags, bool_or(l_discount > 0.05) AS discounted
FROM lineitem GROUP BY 1, 2""")
def merge_rows(spark, d) -> DataFrame:
    li = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", F.col("l_returnflag").alias("flags"), F.col("l_returnflag").alias("pos"), (F.col("l_discount") > 0.05).alias("discounted"))
    return grid.merge_rows(li, ["l_orderkey", "l_linenumber"], "pos", ["l_extendedprice"], ["flags"], [], "discounted")


_token = r"'(?:^|[^0-9-])(-?[0-9][0-9,]*(?:\.[0-9]+)?)'"
_word_values = ", ".join(f"('{w}', {v})" for w, v in R.NUMBER_WORDS.items())


@query(f"""WITH d AS (SELECT doc_id, CASE WHEN doc_id % 9 = 0 THEN 'One of them' WHEN doc_id % 9 = 1 THEN 'Single and double' ELSE text END AS text FROM documents), n AS (SELECT *, regexp_extract_all(text, {_token}, 1) AS n FROM d),
w AS (SELECT doc_id, count(*) AS k, max(v) AS v FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS w FROM d) JOIN (VALUES {_word_values}) AS words(w, v) USING (w) GROUP BY 1)
SELECT doc_id, CASE WHEN len(n) > 0 THEN TRY_CAST(replace(n[1], ',', '') AS DOUBLE) WHEN k = 1 THEN CAST(v AS DOUBLE) END AS first_number, CAST(coalesce(len(n), 0) AS BIGINT) AS n_numbers FROM n LEFT JOIN w USING (doc_id)""")
def coerce_numbers(spark, d) -> DataFrame:
    x = F.when(F.col("doc_id") % 9 == 0, "One of them").when(F.col("doc_id") % 9 == 1, "Single and double").otherwise(F.col("text"))
    docs = t(spark, d, "documents").select("doc_id", x.alias("text"))
    return docs.select("doc_id", text.number(F.col("text")).alias("first_number"), F.coalesce(F.size(text.all_numbers(F.col("text"))), F.lit(0)).cast("long").alias("n_numbers"))


@query("SELECT event_id, event_type, json_extract_string(props, '$.k') AS k, json_extract_string(props, '$.page') AS page FROM events")
def parse_json_map(spark, d) -> DataFrame:
    said = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("```json\n"), "props", F.lit("\n```"))).when(F.col("event_id") % 3 == 1, F.concat(F.lit("so: "), "props", F.lit(" it is"))).otherwise(F.col("props"))
    e = t(spark, d, "events").select("event_id", "event_type", text.lenient_json(said, "k string, page string").alias("p"))
    return e.select("event_id", "event_type", "p.k", "p.page")


PAGE_MARKS = ["license", "copyright", "example.com", "the ", "token"]


#: The pages have no amounts: each gets up to 14 of them, and every other one a run of years.
AMOUNTS = "html || repeat(' $1,000', CAST(page_id % 15 AS INT)) || CASE WHEN page_id % 2 = 0 THEN ' 2020 2021 2022 2023' ELSE ' 2020 2021 2022' END"


@query(f"WITH p AS (SELECT page_id, {AMOUNTS} AS html FROM pages) SELECT page_id, " + " + ".join(f"CASE WHEN contains(lower(html), '{m}') OR contains(regexp_replace(lower(html), '[^a-z0-9]', '', 'g'), '{''.join(c for c in m if c.isalnum())}') THEN 1 ELSE 0 END" for m in PAGE_MARKS) + r""" AS markers,
  CASE WHEN len(regexp_extract_all(html, '\$\s?[0-9,]+')) >= 12 THEN 2 WHEN len(regexp_extract_all(html, '\$\s?[0-9,]+')) >= 6 THEN 1 ELSE 0 END
    + CASE WHEN regexp_matches(html, '\b20[0-9][0-9]\b(?:\s+\b20[0-9][0-9]\b){3,}') THEN 2 ELSE 0 END AS structure FROM p""")
def page_scores(spark, d) -> DataFrame:
    p = t(spark, d, "pages").select("page_id", F.expr(AMOUNTS).alias("html"))
    low = F.lower("html")
    return p.select("page_id", profile.marker_hits(low, profile.plain(F.col("html")), PAGE_MARKS).alias("markers"), profile.structure_score(low).alias("structure"))


@query("""SELECT source, count(*) AS n_pages, CAST(round_even(100.0 * count(*) FILTER (length(text) > 50) / count(*), 0) AS INT) AS text_pct, min(n_chars) AS shortest, max(n_chars) AS longest, CAST(sum(n_chars) AS BIGINT) AS total, median(n_chars) AS middle
FROM documents GROUP BY 1""")
def doc_profile(spark, d) -> DataFrame:
    docs = t(spark, d, "documents")
    share = docs.groupBy("source").agg(F.bround(F.lit(100.0) * F.count_if(F.length("text") > profile.THIN) / F.count("*"), 0).cast("int").alias("text_pct"))
    of = rollup.spread(docs, ["source"], "n_chars").withColumnRenamed("n", "n_pages")
    return of.join(share, of["source"].eqNullSafe(share["source"])).drop(share["source"])


@query("""WITH s AS (SELECT conv_id AS doc_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS INT) AS i, length(text) % 4 AS score, count(*) OVER (PARTITION BY conv_id) AS n FROM conversations),
r AS (SELECT doc_id, i, n, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, i) AS k FROM s WHERE i >= 1 AND score >= 2),
m AS (SELECT s.doc_id, s.i, min(r.k) AS near FROM s JOIN r ON r.doc_id = s.doc_id AND abs(r.i - s.i) <= 1 WHERE s.i >= 1 GROUP BY 1, 2),
c AS (SELECT m.*, (SELECT count(*) FROM m x WHERE x.doc_id = m.doc_id AND x.near < m.near) AS before FROM m),
t AS (SELECT doc_id, i FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS place FROM c WHERE before < 3) WHERE place <= 3)
SELECT doc_id, list_sort(list_concat([0], coalesce((SELECT list(t.i) FROM t WHERE t.doc_id = d.doc_id), CAST([] AS INT[])))) AS pages,
  coalesce((SELECT list(r.i ORDER BY r.k) FROM r WHERE r.doc_id = d.doc_id AND NOT EXISTS (SELECT 1 FROM t WHERE t.doc_id = r.doc_id AND t.i = r.i)), CAST([] AS INT[])) AS missed
FROM (SELECT DISTINCT doc_id FROM s) d""")
def page_selection(spark, d) -> DataFrame:
    pages = t(spark, d, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("page_no"), (F.length("text") % 4).cast("int").alias("score"))
    return profile.select_pages(pages, front=1, budget=4)


@query("SELECT event_type, count(*) AS n FROM events WHERE event_type IS NOT NULL GROUP BY 1")
def value_counts(spark, d) -> DataFrame:
    return rollup.value_counts(t(spark, d, "events"), "event_type")


@query("SELECT count(DISTINCT user_id) AS users, count(DISTINCT event_type) AS types, count(DISTINCT CASE WHEN props IS NOT NULL THEN event_id END) AS with_props FROM events")
def distinct_counts(spark, d) -> DataFrame:
    e = t(spark, d, "events").select(F.col("user_id").alias("users"), F.col("event_type").alias("types"), F.when(F.col("props").isNotNull(), F.col("event_id")).alias("with_props"))
    return rollup.distinct_values(e, "users", "types", "with_props")


@query("SELECT median(n) AS middle, CAST(max(n) AS BIGINT) AS most FROM (SELECT user_id, count(*) AS n FROM events GROUP BY 1)")
def median_by_group(spark, d) -> DataFrame:
    return rollup.group_sizes(t(spark, d, "events"), "user_id")


@query("""SELECT c_custkey, CASE WHEN k IS NULL THEN 'todo' WHEN s = 'F' THEN 'current' ELSE 'stale' END AS state FROM customer LEFT JOIN (
  SELECT o_custkey AS k, max(o_orderstatus) AS s FROM orders GROUP BY 1) ON k = c_custkey""")
def incremental_todo(spark, d) -> DataFrame:
    c, o = t(spark, d, "customer", "orders")
    done = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderstatus").alias("s"))
    return dedupe.work_list(c.select("c_custkey"), done, "c_custkey", "s", F.lit("F"))


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P' AND o_custkey IS NOT NULL)")
def orphan_keys(spark, d) -> DataFrame:
    c, o = t(spark, d, "customer", "orders")
    return dedupe.orphans(c.select("c_custkey"), o.where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey")), "c_custkey")


@query("""SELECT count(*) AS n_stamps, CAST(sum(n) AS BIGINT) AS n, bool_and(s = 'F') AS all_current, CASE WHEN bool_or(s = 'unversioned') THEN 'UNKNOWN' WHEN count(*) = 1 THEN 'UNIFORM' ELSE 'MIXED' END AS verdict
FROM (SELECT coalesce(nullif(o_orderstatus, ''), 'unversioned') AS s, count(*) AS n FROM orders GROUP BY 1)""")
def stamp_audit(spark, d) -> DataFrame:
    return dedupe.stamp_audit(t(spark, d, "orders"), "o_orderstatus", F.lit("F"))


@query("""SELECT doc_id, field, CASE WHEN quality = 0 AND toxic = 1 THEN 'reviewed' ELSE value END AS value, coalesce(quality = 0 AND toxic = 0, FALSE) AS unresolved FROM (
  SELECT doc_id, 'lang' AS field, lang AS value FROM documents) LEFT JOIN labels USING (doc_id)""")
def verdict_merge(spark, d) -> DataFrame:
    docs, labels = t(spark, d, "documents", "labels")
    cells = docs.select("doc_id", F.lit("lang").alias("field"), F.col("lang").alias("value"))
    v = labels.select("doc_id", F.lit("lang").alias("key"), (F.col("quality") == 1).alias("ok"), F.when(F.col("toxic") == 1, "reviewed").alias("corrected_value"))
    return merge.apply_verdicts(cells, v, "doc_id")


@query("""SELECT p_partkey, CASE WHEN p_size > 40 THEN NULL ELSE p_size END AS p_size, CASE WHEN p_size > 45 THEN 'patched' ELSE p_brand END AS p_brand FROM part""")
def partial_merge(spark, d) -> DataFrame:
    p = t(spark, d, "part").select("p_partkey", "p_size", "p_brand")
    entry = F.map_from_arrays(F.array(F.lit("p_size")), F.array(F.lit(None).cast("string")))
    patch = F.when(F.col("p_size") > 45, F.map_concat(entry, F.create_map(F.lit("p_brand"), F.lit("patched")))).when(F.col("p_size") > 40, entry)
    return merge.merge_partial_rows(p, p.select("p_partkey", patch.alias("patch")), ["p_partkey"], ["p_size", "p_brand"])


@query("""WITH x AS (SELECT l_orderkey, l_linenumber, l_quantity * p_retailprice AS product, l_extendedprice AS c FROM lineitem JOIN part ON p_partkey = l_partkey),
y AS (SELECT *, CASE WHEN product = 0 THEN NULL ELSE c / product END AS ratio FROM x)
SELECT count(*) AS n, count(*) FILTER (abs(product - c) <= greatest(1.0, abs(product) * 0.015) OR coalesce(round_even(ratio, 0) BETWEEN 1 AND 20 AND abs(ratio - round_even(ratio, 0)) <= 0.02, FALSE)) AS n_ok FROM y""")
def arithmetic_rows(spark, d) -> DataFrame:
    li, p = t(spark, d, "lineitem", "part")
    j = li.join(p, F.col("l_partkey") == F.col("p_partkey"))
    return reconcile.row_arithmetic(j, "l_quantity", "p_retailprice", "l_extendedprice").agg(F.count("*").alias("n"), F.count_if("ok").alias("n_ok"))


@query("WITH x AS (SELECT o_orderkey, year(l_shipdate) - year(o_orderdate) + 1 AS term, CAST(l_extendedprice AS DECIMAL(18,2)) AS c FROM orders JOIN lineitem ON l_orderkey = o_orderkey) SELECT o_orderkey, "
    + ", ".join(f"CAST(sum(c) FILTER (term = {i}) AS DOUBLE) AS year_{i}" for i in range(1, R.YEARS + 1)) + f", CAST(sum(c) FILTER (term BETWEEN 1 AND {R.YEARS}) AS DOUBLE) AS whole FROM x GROUP BY 1")
def year_schedule_pivot(spark, d) -> DataFrame:
    o, li = t(spark, d, "orders", "lineitem")
    x = o.join(li, F.col("o_orderkey") == F.col("l_orderkey")).select("o_orderkey", (F.year("l_shipdate") - F.year("o_orderdate") + 1).alias("term"), reconcile.money(F.col("l_extendedprice")).alias("c"))
    wide = x.groupBy("o_orderkey").agg(*(F.sum(F.when(F.col("term") == i, F.col("c"))).cast("double").alias(f"year_{i}") for i in range(1, R.YEARS + 1)))
    return wide.withColumn("whole", F.round(reconcile.year_sum(), 2))


@query("SELECT CAST(p_partkey AS VARCHAR) AS property_id, 'part' AS layer, 'p_size' AS field, 'range' AS kind, CAST(p_size AS VARCHAR) AS detail FROM part WHERE p_size < 5 OR p_size > 45")
def range_checks(spark, d) -> DataFrame:
    return checks.issues(t(spark, d, "part"), "p_partkey", "part", {"p_size": (5, 45)}).drop("row_idx")


@query("SELECT CAST(o_orderkey AS VARCHAR) AS property_id, 'orders' AS layer, 'o_orderpriority' AS field, 'category' AS kind, lower(o_orderpriority) AS detail FROM orders WHERE lower(o_orderpriority) NOT IN ('1-urgent', '2-high')")
def category_checks(spark, d) -> DataFrame:
    return checks.issues(t(spark, d, "orders"), "o_orderkey", "orders", categories={"o_orderpriority": ["1-urgent", "2-high"]}).drop("row_idx")


@query("""WITH i AS (SELECT CAST(p_partkey AS VARCHAR) AS id, 'range' AS kind FROM part WHERE p_size > 45 UNION ALL SELECT CAST(p_partkey AS VARCHAR), 'brand' FROM part WHERE p_retailprice > 1500),
k AS (SELECT id, count(*) AS n, string_agg(DISTINCT kind, '; ' ORDER BY kind) AS why FROM i GROUP BY 1)
SELECT CAST(p_partkey AS VARCHAR) AS property_id, CASE WHEN n IS NULL THEN 'clean' ELSE 'needs_review' END AS status, coalesce(n, 0) AS n_issues, why FROM part LEFT JOIN k ON id = CAST(p_partkey AS VARCHAR)""")
def status_rollup(spark, d) -> DataFrame:
    p = t(spark, d, "part")
    i = checks.issues(p, "p_partkey", "part", {"p_size": (0, 45)}, more=[("p_retailprice", "brand", F.col("p_retailprice") > 1500)])
    return checks.status(p.select(F.col("p_partkey").cast("string").alias("property_id")), i)


@query("""SELECT source AS field, count(*) AS n, count(*) FILTER (lang = 'en') AS n_correct, count(*) FILTER (lang = 'en') / count(*) AS share FROM documents GROUP BY ROLLUP (source)""")
def field_accuracy(spark, d) -> DataFrame:
    docs = t(spark, d, "documents")
    gold = docs.select(F.col("doc_id").alias("id"), F.col("source").alias("field"), F.lit("EN ").alias("value"))
    pred = docs.select(F.col("doc_id").alias("id"), F.col("source").alias("field"), F.col("lang").alias("value"))
    return merge.accuracy(gold, pred, coerce.field_correct(F.col("predicted"), F.col("gold")))


@query("SELECT s_suppkey, regexp_replace(n_name, '[^A-Za-z0-9]+', '_', 'g') AS firm_key, 'R' || n_regionkey AS state_key FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def partition_keys(spark, d) -> DataFrame:
    s, n = t(spark, d, "supplier", "nation")
    j = s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).withColumn("state", F.concat(F.lit("R"), F.col("n_regionkey")))
    return sinks.with_partitions(j, "n_name", "state").select("s_suppkey", "firm_key", "state_key")


_LINE = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus", "ordered"]


@query("WITH x AS (SELECT *, CASE WHEN l_quantity > 25 THEN l_orderkey END AS ordered FROM lineitem) " + " UNION ALL ".join(f"""SELECT '{c}' AS "column", count(*) AS n, count({c}) AS non_null, count(DISTINCT {c}) AS distinct_values FROM x""" for c in _LINE))
def data_dictionary(spark, d) -> DataFrame:
    return sinks.dictionary(t(spark, d, "lineitem").withColumn("ordered", F.when(F.col("l_quantity") > 25, F.col("l_orderkey"))).select(*_LINE), exact=True)


@query("""SELECT row_number() OVER (ORDER BY lower(c_name) NULLS LAST, c_custkey) AS number, c_custkey, c_name FROM customer ORDER BY 1 LIMIT 25""")
def roster(spark, d) -> DataFrame:
    """A report of 25 lines: top rows by a distributed sort, numbered afterwards."""
    top = rollup.numbered(t(spark, d, "customer"), 25, F.lower("c_name").asc_nulls_last(), "c_custkey")
    return top.select("number", "c_custkey", "c_name")


#: Stored answers: one in seven has no stamp, one in eleven can't be read.
STORED = """SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN '{{"_prompt_version": "v' WHEN o_orderkey % 7 = 0 THEN '{{"x": 1}}' ELSE '{{"_prompt_version": "v' || o_orderstatus || '"}}' END AS raw FROM {orders}"""


@query("""SELECT CASE WHEN o_orderkey % 11 = 0 THEN 'unreadable' WHEN o_orderkey % 7 = 0 THEN 'unversioned' ELSE 'v' || o_orderstatus END AS stamp, count(*) AS n FROM orders GROUP BY 1""")
def stamp_counts(spark, d) -> DataFrame:
    stored = spark.sql(STORED, orders=t(spark, d, "orders"))
    return rollup.value_counts(stored.select(dedupe.stamp_of(F.col("raw")).alias("stamp")), "stamp")


STATUS = "CASE o_orderstatus WHEN 'F' THEN 'clean' WHEN 'O' THEN 'needs_review' WHEN 'P' THEN 'error' END"


@query(f"SELECT o_orderkey, {STATUS} AS status FROM orders WHERE o_orderstatus = 'F'")
def usable_records(spark, d) -> DataFrame:
    return rollup.usable(t(spark, d, "orders").select("o_orderkey", F.expr(STATUS).alias("status")))


@query(f"SELECT o_orderkey, {STATUS} AS status FROM orders WHERE o_orderstatus IN ('F', 'O')")
def usable_or_flagged(spark, d) -> DataFrame:
    return rollup.usable(t(spark, d, "orders").select("o_orderkey", F.expr(STATUS).alias("status")), include_flagged=True)


@query("""SELECT doc_id, coalesce(lang = 'en', FALSE) AS assessed, coalesce(contains(source, 'a') OR contains(source, 'i'), FALSE) AS risky,
  coalesce(regexp_matches(upper(substr(source, 1, 1)) || ': ' || source, '^[A-M]:'), FALSE) AS early FROM documents""")
def flag_filters(spark, d) -> DataFrame:
    x = t(spark, d, "documents").select("doc_id", (F.col("lang") == "en").alias("flag"), "source", F.concat(F.upper(F.substring("source", 1, 1)), F.lit(": "), "source").alias("layout"))
    return x.select("doc_id", rollup.true("flag").alias("assessed"), rollup.any_flag("source", "a", "i").alias("risky"), rollup.layout_in("layout", "A-M").alias("early"))


@query("SELECT o_orderkey, 'needs_review' AS status, 'ok' AS target_quality FROM orders WHERE o_orderstatus = 'O' AND o_totalprice > 100000")
def review_roster(spark, d) -> DataFrame:
    q = F.when(F.col("o_totalprice") > 100000, "ok").otherwise("does_not_tie").alias("target_quality")
    return rollup.review_roster(t(spark, d, "orders").select("o_orderkey", F.expr(STATUS).alias("status"), q))


@query("SELECT o_orderkey, o_custkey, c_mktsegment AS state, '7' AS prompt_version, CAST(NULL AS VARCHAR) AS model FROM orders LEFT JOIN customer ON c_custkey = o_custkey")
def stamped_with_state(spark, d) -> DataFrame:
    c, o = t(spark, d, "customer", "orders")
    return rollup.stamped(rollup.with_state(o.select("o_orderkey", "o_custkey"), c.select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("state")), "o_custkey"), prompt_version="7", model=None)


@query("SELECT n_nationkey AS id, n_name AS name, c.c_name AS name_property FROM nation LEFT JOIN customer c ON c.c_custkey = n_nationkey")
def manifest_roster(spark, d) -> DataFrame:
    n, c = t(spark, d, "nation", "customer")
    return rollup.roster(n.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name")), c.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")), "id")


@query(f"""WITH a AS (SELECT unnest({[*TYPES, "NONE"]!r}) AS p_type), g AS (SELECT split_part(p_type, ' ', 1) AS p_type, l_orderkey, l_returnflag, l_extendedprice FROM lineitem JOIN part ON p_partkey = l_partkey),
r AS (SELECT p_type, count(DISTINCT l_orderkey) FILTER (l_returnflag = 'R') AS n, CAST(sum(CAST(CASE WHEN l_returnflag <> 'N' THEN l_extendedprice ELSE 0 END AS DECIMAL(18,2))) AS DOUBLE) AS total FROM g GROUP BY 1)
SELECT a.p_type, coalesce(n, 0) AS n_assessed, coalesce(total, 0) AS total FROM a LEFT JOIN r ON r.p_type = a.p_type""")
def member_rollup(spark, d) -> DataFrame:
    li, p = t(spark, d, "lineitem", "part")
    g = li.join(p, F.col("l_partkey") == F.col("p_partkey")).select(F.split("p_type", " ")[0].alias("p_type"), "l_orderkey", F.when(F.col("l_returnflag") == "R", True).alias("assessed"), F.when(F.col("l_returnflag") != "N", F.col("l_extendedprice")).alias("amount"))
    return rollup.per_member(g, "p_type", [*TYPES, "NONE"], "l_orderkey", "assessed", "amount")


@query("""WITH i AS (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'systems[1]' ELSE 'components[' || CAST(o_orderkey % 7 + 1 AS VARCHAR) || '].total' END AS place FROM orders)
SELECT i.o_orderkey, place, CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderkey % 7 + 1 AS INT) END AS row_idx, l_returnflag FROM i LEFT JOIN lineitem l ON l.l_orderkey = i.o_orderkey AND l_linenumber = CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey % 7 + 1 END""")
def located_issues(spark, d) -> DataFrame:
    o, li = t(spark, d, "orders", "lineitem")
    place = F.when(F.col("o_orderkey") % 5 == 0, "systems[1]").otherwise(F.concat(F.lit("components["), (F.col("o_orderkey") % 7 + 1).cast("string"), F.lit("].total")))
    return rollup.located(o.select("o_orderkey", place.alias("place")), li.withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey", "place", "l_linenumber", "l_returnflag")


@query("""SELECT l_orderkey, l_linenumber, n FROM (SELECT l_orderkey, l_linenumber, CAST(l_quantity AS INT) AS n, sum(CAST(l_quantity AS INT)) OVER (PARTITION BY l_orderkey)
  - coalesce(sum(CAST(l_quantity AS INT)) OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC, l_linenumber DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest FROM lineitem) WHERE rest <= 60""")
def size_limit(spark, d) -> DataFrame:
    return rollup.without_heaviest(t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").cast("int").alias("n")), "l_orderkey", "l_linenumber", "n", 60)


@query("SELECT doc_id, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 12")
def sample_head(spark, d) -> DataFrame:
    return rollup.head(t(spark, d, "documents").select("doc_id", "n_chars"), 12, F.col("n_chars").desc(), "doc_id")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from ledgerloom.plans import audits, texts, values  # noqa: F401  these register their queries

    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    from ledgerloom.plans import audits, texts, values  # noqa: F401

    return dict(_sql)
