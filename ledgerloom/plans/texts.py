"""Named queries over texts: grounding of snippets and numbers in documents of several pages, salvage of broken JSON, folding."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom import registries as R
from ledgerloom.functions import folding, text
from ledgerloom.operators import grounding, profile
from ledgerloom.plans.registry import query, t
from ledgerloom.sources import salvage
from ledgerloom.sources.salvage import register

#: Eight documents are the pages of a report; each gives a cell that cites words of its own, in three ways, and its first page or its own.
REPORT = "SELECT CAST(doc_id AS BIGINT) AS d, CAST(floor(doc_id / 8) AS BIGINT) AS report, CAST(doc_id % 8 AS INT) + 1 AS page_no, coalesce(text, '') AS text FROM {documents}"
_LOWER = "abcdefghijklmnopqrstuvwxyz"
_words = "regexp_extract_all(text, '[^\\s]+')"
_NORM = "lower(trim(regexp_replace(translate(nfc_normalize({0}), '‐‑‒–—―’‘‚‛“”„‟ ', '------' || repeat(chr(39), 4) || '\"\"\"\" '), '\\s+', ' ', 'g')))"
_SQUASH = "regexp_replace(strip_accents(lower({0})), '[^a-z0-9]', '', 'g')"
_number = "nullif(regexp_extract(text, '[0-9][0-9,]*(?:\\.[0-9]+)?', 0), '')"


@query(f"""WITH r AS ({REPORT.format(documents="documents")}), w AS (SELECT *, {_words} AS w FROM r), c AS (
  SELECT d, report, CASE WHEN d % 2 = 0 THEN page_no ELSE 1 END AS page, CASE d % 3 WHEN 0 THEN array_to_string(w[1:3], ' ') WHEN 1 THEN array_to_string(w[len(w)-2:], ' ') ELSE translate(array_to_string(w[2:5], '  '), '{_LOWER}', '{_LOWER.upper()}') END AS a,
    CASE d % 3 WHEN 0 THEN array_to_string(w[len(w)-2:], ' ') WHEN 1 THEN array_to_string(w[1:3], ' ') END AS b FROM w WHERE len(w) > 0),
f AS (SELECT report, d, page, unnest(list_filter(list_transform(regexp_split_to_array(a || CASE WHEN b IS NULL THEN '' ELSE ' ... ' || b END, '\\.{{2,}}|…'), lambda x: trim(x)), lambda x: x <> '')) AS part, generate_subscripts(list_filter(list_transform(regexp_split_to_array(a || CASE WHEN b IS NULL THEN '' ELSE ' ... ' || b END, '\\.{{2,}}|…'), lambda x: trim(x)), lambda x: x <> ''), 1) AS k FROM c),
h AS (SELECT report, string_agg({_NORM.format("text")}, ' ' ORDER BY page_no) AS n, string_agg({_SQUASH.format("text")}, '' ORDER BY page_no) AS q FROM r GROUP BY 1),
l AS (SELECT report, d, list({_NORM.format("part")} ORDER BY k) AS ns, list({_SQUASH.format("part")} ORDER BY k) AS qs FROM f GROUP BY 1, 2)
SELECT report, CAST(d AS VARCHAR) AS field,
  list_reduce(list_prepend(0::BIGINT, list_transform(range(1, len(ns) + 1), lambda i: i)), lambda z, i: CASE WHEN z < 0 THEN -1 WHEN strpos(substr(n, z + 1), ns[i]) > 0 THEN z + strpos(substr(n, z + 1), ns[i]) + length(ns[i]) - 1 ELSE -1 END) >= 0
  OR list_reduce(list_prepend(0::BIGINT, list_transform(range(1, len(qs) + 1), lambda i: i)), lambda z, i: CASE WHEN z < 0 THEN -1 WHEN qs[i] = '' THEN z WHEN strpos(substr(q, z + 1), qs[i]) > 0 THEN z + strpos(substr(q, z + 1), qs[i]) + length(qs[i]) - 1 ELSE -1 END) >= 0 AS found
FROM l JOIN h USING (report)""")
def ground_cells(spark, d) -> DataFrame:
    """Snippets of two fragments (one way in order, one way turned round) and of one in other letters and spaces, sought in whole reports."""
    r = spark.sql(REPORT, documents=t(spark, d, "documents")).withColumn("w", F.regexp_extract_all("text", F.lit(r"[^\s]+"), F.lit(0)))
    first, last = F.array_join(F.slice("w", 1, 3), " "), F.array_join(F.slice("w", F.greatest(F.size("w") - 2, F.lit(1)), 3), " ")
    kind = F.col("d") % 3
    snippet = F.when(kind == 0, F.concat(first, F.lit(" ... "), last)).when(kind == 1, F.concat(last, F.lit(" ... "), first)).otherwise(F.translate(F.array_join(F.slice("w", 2, 4), "  "), _LOWER, _LOWER.upper()))
    cells = r.where(F.size("w") > 0).select("report", F.col("d").cast("string").alias("field"), F.lit("x").alias("value"), snippet.alias("snippet"), F.when(F.col("d") % 2 == 0, F.col("page_no")).otherwise(1).alias("page"))
    return grounding.ground(cells, r.select("report", "page_no", "text"), "report").select("report", "field", "found")


@query(f"""WITH r AS ({REPORT.format(documents="documents")}), v AS (SELECT *, coalesce(TRY_CAST(replace({_number}, ',', '') AS DOUBLE), d % 97) + CASE WHEN d % 4 = 0 THEN 1 ELSE 0 END AS v FROM r),
h AS (SELECT report, string_agg({_SQUASH.format("text")}, '' ORDER BY page_no) AS q FROM r GROUP BY 1)
SELECT report, CAST(d AS VARCHAR) AS field, contains(q, CAST(CAST(round_even(v, 0) AS BIGINT) AS VARCHAR)) OR contains(q, regexp_replace(format('{{:.2f}}', v), '[^0-9]', '', 'g')) AS found FROM v JOIN h USING (report) WHERE v > 0 AND v < 1e15""")
def number_presence(spark, d) -> DataFrame:
    """The first number of each page (or one made of its id; one more in every fourth), sought in whole reports."""
    r = spark.sql(REPORT, documents=t(spark, d, "documents"))
    n = F.coalesce(text.bare(F.nullif(F.regexp_extract("text", r"[0-9][0-9,]*(?:\.[0-9]+)?", 0), F.lit(""))), F.col("d") % 97) + F.when(F.col("d") % 4 == 0, 1).otherwise(0)
    values = r.select("report", F.col("d").cast("string").alias("field"), n.alias("value")).where("value < 1e15")
    return grounding.numbers_present(values, r.select("report", "page_no", "text"), "report").select("report", "field", "found")


@query(f"SELECT doc_id, sha256({_NORM.format('text')}) AS norm, sha256({_SQUASH.format('text')}) AS squashed FROM documents")
def folded_texts(spark, d) -> DataFrame:
    return t(spark, d, "documents").select("doc_id", F.sha2(folding.norm(F.col("text")), 256).alias("norm"), F.sha2(folding.squash(F.col("text")), 256).alias("squashed"))


#: A record's items as JSON of extraction: every fifth object is broken, one record in three is cut off after two thirds of its text.
OBJECTS = """SELECT l_orderkey AS k, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS INT) AS n, l_partkey AS pk,
  CASE WHEN l_partkey % 5 = 0 THEN '{{"part": ' || CAST(l_partkey AS STRING) || ', "note":,}}' ELSE '{{"part": ' || CAST(l_partkey AS STRING) || ', "note": "a ]}} ' || chr(92) || '" {{", "more": {{"x": [1, {{}}]}}}}' END AS object FROM {lineitem}"""
HEAD = '{"notes": ["["], "systems": [{"s": 1}], "components": ['


@query(f"""WITH o AS ({OBJECTS.format(lineitem="lineitem")}), p AS (SELECT *, sum(length(object)) OVER (PARTITION BY k ORDER BY n) + n - 1 AS upto, sum(length(object)) OVER (PARTITION BY k) + count(*) OVER (PARTITION BY k) - 1 + {len(HEAD)} + 2 AS whole FROM o),
w AS (SELECT *, {len(HEAD)} + upto <= CASE WHEN k % 3 = 0 THEN CAST(floor(whole * 2 / 3) AS BIGINT) ELSE whole END AND pk % 5 <> 0 AS kept FROM p)
SELECT k, CAST(row_number() OVER (PARTITION BY k ORDER BY n) - 1 AS INT) AS pos, pk AS part FROM w WHERE kept""")
def salvage_items(spark, d) -> DataFrame:
    """The items that can be read of each record's JSON, cut off or broken as it is."""
    register(spark)
    o = spark.sql(OBJECTS, lineitem=t(spark, d, "lineitem"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "object"))), lambda x: x["object"]), ",")
    whole = o.groupBy("k").agg(body.alias("body")).select("k", F.concat(F.lit(HEAD), "body", F.lit("]}")).alias("json"))
    cut = whole.select("k", F.when(F.col("k") % 3 == 0, F.expr("substring(json, 1, CAST(floor(length(json) * 2 / 3) AS INT))")).otherwise(F.col("json")).alias("json"))
    return spark.sql("SELECT k, o.pos, CAST(get_json_object(o.object, '$.part') AS BIGINT) AS part FROM {cut}, LATERAL salvage_rows(json, 'components') o", cut=cut)


#: A review's answer of three verdicts, of which the second is broken in one order of four, the third cut off in one of three.
ANSWER = """SELECT o_orderkey AS k, '{{"a": {{"ok": ' || CASE WHEN o_orderkey % 2 = 0 THEN 'true' ELSE 'false, "corrected_value": "x' || CAST(o_orderkey AS STRING) || '"' END || '}}, "b": {{"ok": ' || CASE WHEN o_orderkey % 4 = 1 THEN ',' ELSE 'false, "reason": "no }} here"' END || '}}, "c": {{"verdict": 1' ||
  CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE ', "ok": null, "corrected_value": 7}}}}' END AS answer FROM {orders}"""


@query("""WITH o AS (SELECT o_orderkey AS k FROM orders)
SELECT k, 'a' AS key, k % 2 = 0 AS ok, CASE WHEN k % 2 = 1 THEN 'x' || CAST(k AS VARCHAR) END AS corrected_value, CAST(NULL AS VARCHAR) AS reason FROM o
UNION ALL SELECT k, 'b', FALSE, NULL, 'no } here' FROM o WHERE k % 4 <> 1 UNION ALL SELECT k, 'c', NULL, '7', NULL FROM o WHERE k % 3 <> 0""")
def salvage_verdicts(spark, d) -> DataFrame:
    register(spark)
    answers = spark.sql(ANSWER, orders=t(spark, d, "orders"))
    return spark.sql("SELECT k, v.* FROM {answers}, LATERAL salvage_verdicts(answer, array('a', 'b', 'c', 'd')) v", answers=answers)


#: Conversations as documents: what they lack of a cost table is put in by place, some of it over the end of a turn.
PROFILED = """SELECT conv_id AS doc_id, turn AS page_no, CASE WHEN (conv_id + turn) % 11 = 5 THEN '  ' ELSE coalesce(text, '') END || CASE (conv_id * 3 + turn) % 7 WHEN 0 THEN ' EUL and RUL, Unit Cost $1,000 $2,000 $3,000 $4,000 $5,000 $6,000' WHEN 1 THEN ' 2020 2021 2022 2023 total cost base' WHEN 2 THEN ' cost in Year 12. Replace' WHEN 3 THEN ' Percent by NV5 for Bridge House'
  WHEN 4 THEN ' AEI consultants, yr 10, qty in' ELSE '' END AS text FROM {conversations}"""
_contains = lambda hay, ps: "(" + " OR ".join(f"contains({hay}, '{p}')" for p in ps) + ")"
_bare = {k: [profile._squashed(p) for p in ps if len(profile._squashed(p)) >= profile.LEAST_SQUASHED] for k, ps in profile.SHAPES}
_shape = " ".join(f"WHEN {_contains('doc', ps)}{f' OR {_contains("bare", _bare[k])}' if _bare[k] else ''} THEN '{profile.SHAPE_NAMES[k]}'" for k, ps in profile.SHAPES)
_life, _cost = _contains("low", ["eul", "expected life", "expected useful life"]), _contains("low", ["unit cost", "total cost", "present worth", "r-total", "immed. cost", "reserve cost"])
_firms = ", ".join(f"({i}, '{n.replace(chr(39), chr(39) * 2)}', '{p.removeprefix('(?iu)')}')" for i, (n, p) in enumerate(R.FIRM_RULES) if n not in (R.FIRM_OTHER, "Partners"))
_known = ", ".join(f"'{x}'" for x in profile.KNOWN_FIRMS)
_flat = lambda x, n: f"substr(trim(regexp_replace({x}, '\\s+', ' ', 'g')), 1, {n})"
FRONT, BUDGET = 2, 4


@query(rf"""WITH src AS ({PROFILED.format(conversations="conversations")}), pg AS (SELECT *, lower(text) AS low, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY page_no) - 1 AS INT) AS i, count(*) OVER (PARTITION BY doc_id) AS n FROM src),
sc AS (SELECT *, {" + ".join(f"CAST(contains(low, '{m}') AS INT)" for m in profile.MARKERS)} + CASE WHEN len(regexp_extract_all(low, '\$\s?[0-9,]+')) >= 12 THEN 2 WHEN len(regexp_extract_all(low, '\$\s?[0-9,]+')) >= 6 THEN 1 ELSE 0 END
    + CASE WHEN regexp_matches(low, '\b20[0-9][0-9]\b(?:\s+\b20[0-9][0-9]\b){{3,}}') THEN 2 ELSE 0 END >= 2 AS marked, {" + ".join(f"CAST(contains(low, '{c}') AS INT)" for c in profile.COLUMN_NAMES)} AS cols, len(regexp_extract_all(low, '[0-9]')) / greatest(1, length(low)) AS digits,
    ({_life} AND {_cost}) OR (contains(low, 'capital considerations') AND contains(low, 'present worth')) OR contains(low, 'reflective age') OR contains(low, 'overall expected life') AS header, least({FRONT}, n) AS head FROM pg),
nb AS (SELECT *, (marked OR coalesce(lag(marked) OVER w, FALSE) OR coalesce(lead(marked) OVER w, FALSE)) AND i >= head AS tail FROM sc WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
a AS (SELECT doc_id, count(*) AS pages, count(*) FILTER (length(regexp_replace(text, '^\s+|\s+$', '', 'g')) > 50) AS with_text, count(*) FILTER (marked) AS marker_pages, min(i + 1) FILTER (marked) AS first_marker, max(i + 1) FILTER (marked) AS last_marker, count(*) FILTER (tail) AS n_tail, max(head) AS head,
  string_agg(low, ' ' ORDER BY i) AS doc, string_agg(regexp_replace(low, '[^a-z0-9]', '', 'g'), '' ORDER BY i) AS bare, max(text) FILTER (i = 0) AS cover, sum(strlen(text)) AS length FROM nb GROUP BY 1),
pk AS (SELECT doc_id, i, header, text, low FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY header DESC, cols DESC, digits DESC, i) AS r FROM nb WHERE marked) WHERE r = 1),
rule(rank, label, pattern) AS (VALUES {_firms}), v AS (SELECT doc_id, rank, label, count(*) AS hits, min(page_no) AS first FROM pg JOIN rule ON regexp_matches(regexp_replace(low, '{R.CLIENTS}', ' ', 'g'), pattern) GROUP BY 1, 2, 3),
b AS (SELECT doc_id, label, hits FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY hits DESC, first, rank) AS r FROM v) WHERE r = 1),
j AS (SELECT a.*, coalesce(label, 'UNKNOWN') AS firm, coalesce(hits, 0) AS firm_pages, CAST(round_even(100.0 * with_text / pages, 0) AS INT) AS pct, pages <= {BUDGET} OR n_tail <= {BUDGET} - head AS fits, pk.i AS best_i, pk.header, pk.text AS best, pk.low AS best_low FROM a LEFT JOIN b USING (doc_id) LEFT JOIN pk USING (doc_id))
SELECT doc_id, pages, CAST(round_even(length / 1e6, 1) AS DOUBLE) AS mb, firm, firm IN ({_known}) AS firm_known, pct AS text_pages_pct, marker_pages, first_marker, last_marker, CASE WHEN marker_pages > 0 THEN last_marker - 1 < {FRONT} END AS front_covers_tables, fits AS fits_budget,
  CASE WHEN pages <= {BUDGET} THEN pages ELSE head + least(n_tail, {BUDGET} - head) END AS pages_to_send, substr(sha1(regexp_replace(cover, '^\s+|\s+$', '', 'g')), 1, 12) AS sha1_first_page, {_flat("cover", profile.COVER)} AS cover_sample, best_i + 1 AS table_page, coalesce(header, FALSE) AS has_header,
  CASE {_shape} ELSE 'UNCLASSIFIED' END AS table_shape, CASE WHEN regexp_matches(doc, 'year 12|yr 12') THEN 12 WHEN regexp_matches(doc, 'year 10|yr 10') THEN 10 END AS eval_period, firm_pages,
  coalesce({_flat(f"substr(best, CASE WHEN strpos(best_low, 'eul') > 0 THEN greatest(strpos(best_low, 'eul') - {profile.BEFORE}, 1) ELSE 1 END, {profile.FROM})", profile.SAMPLE)}, '') AS table_sample,
  concat_ws('; ', CASE WHEN pct < 20 THEN 'NO_TEXT_LAYER(scanned?)' END, CASE WHEN firm = 'UNKNOWN' THEN 'FIRM_UNRECOGNISED' WHEN firm NOT IN ({_known}) THEN 'NEW_FIRM' END, CASE WHEN marker_pages = 0 THEN 'NO_TABLE_MARKERS' END, CASE WHEN NOT fits THEN 'TABLES_EXCEED_BUDGET(need ' || (head + n_tail) || ')' END) AS risk_flags
FROM j""")
def page_profiles(spark, d) -> DataFrame:
    """All 21 columns of a document's profile."""
    pages = spark.sql(PROFILED, conversations=t(spark, d, "conversations"))
    files = pages.groupBy("doc_id").agg(F.sum(F.octet_length("text")).alias("length"))
    return profile.corpus_profile(pages, files, FRONT, BUDGET)


#: Turns as scored pages of a size; the cells cite places in the slice.
SIZED = "SELECT conv_id AS doc_id, turn AS page_no, CAST(length(coalesce(text, '')) % 4 AS INT) AS score, CAST(length(coalesce(text, '')) AS BIGINT) AS size FROM {conversations}"


def _slices(fronts: list[int], budget: int, least: int, most: int) -> str:
    """Slices in SQL: each length of the front by itself, then the first that fits, then what must go."""
    return f"""s AS (SELECT *, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY page_no) - 1 AS INT) AS i, count(*) OVER (PARTITION BY doc_id) AS n, bool_or(score >= 2) OVER (PARTITION BY doc_id) AS tables, sum(size) OVER (PARTITION BY doc_id) AS total FROM ({SIZED.format(conversations="conversations")})),
tr(k, front) AS (VALUES {", ".join(f"({k}, {f})" for k, f in enumerate(fronts))}), e AS (SELECT s.*, k, least(front, {budget}, n) AS head, n <= {budget} AND total <= {most} AS entire FROM s CROSS JOIN tr WHERE tables OR k = 0),
r AS (SELECT doc_id, k, i, row_number() OVER (PARTITION BY doc_id, k ORDER BY score DESC, i) AS rank FROM e WHERE i >= head AND score >= 2),
m AS (SELECT e.doc_id, e.k, e.i, min(r.rank) AS near FROM e JOIN r ON r.doc_id = e.doc_id AND r.k = e.k AND abs(r.i - e.i) <= 1 WHERE e.i >= e.head GROUP BY 1, 2, 3),
c AS (SELECT m.*, (SELECT count(*) FROM m x WHERE x.doc_id = m.doc_id AND x.k = m.k AND x.near < m.near) AS before FROM m),
t AS (SELECT doc_id, k, i FROM (SELECT c.*, head, row_number() OVER (PARTITION BY doc_id, k ORDER BY i) AS place FROM c JOIN (SELECT DISTINCT doc_id, k, head FROM e) h USING (doc_id, k) WHERE before < {budget} - head) WHERE place <= {budget} - head),
x AS (SELECT e.*, CASE WHEN entire THEN TRUE WHEN tables THEN i < head OR t.i IS NOT NULL ELSE i < {budget} END AS taken, r.rank FROM e LEFT JOIN t USING (doc_id, k, i) LEFT JOIN r USING (doc_id, k, i)),
y AS (SELECT *, sum(CASE WHEN taken THEN size ELSE 0 END) OVER (PARTITION BY doc_id, k) AS weight FROM x), z AS (SELECT *, coalesce(min(CASE WHEN weight <= {most} THEN k END) OVER (PARTITION BY doc_id), max(k) OVER (PARTITION BY doc_id)) AS chosen FROM y),
q AS (SELECT *, taken AND i >= {least} AND weight - coalesce((SELECT sum(o.size) FROM z o WHERE o.doc_id = z.doc_id AND o.k = z.k AND o.taken AND o.i >= {least} AND (o.score, -o.i) < (z.score, -z.i)), 0) > {most} AS gone FROM z WHERE k = chosen),
slices AS (SELECT doc_id, coalesce(list(i ORDER BY i) FILTER (taken AND NOT gone), []) AS pages, coalesce(list(i ORDER BY rank) FILTER (rank IS NOT NULL AND NOT taken AND tables AND NOT entire), CAST([] AS INT[])) AS missed, coalesce(list(i ORDER BY i) FILTER (gone), CAST([] AS INT[])) AS dropped, bool_and(NOT tables AND NOT entire) AS blind FROM q GROUP BY 1)"""


@query(f"WITH {_slices([3, 2, 1], 5, 1, 900)} SELECT * FROM slices")
def page_slices(spark, d) -> DataFrame:
    return profile.slice_pages(spark.sql(SIZED, conversations=t(spark, d, "conversations")), 900, 3, 5, 1, 1)


@query(f"""WITH {_slices([3, 2, 1], 5, 1, 900)} SELECT conv_id AS doc_id, turn, CAST(CASE WHEN turn + 1 <= len(pages) THEN pages[turn + 1] + 1 ELSE turn + 1 END AS INT) AS page FROM conversations JOIN slices ON doc_id = conv_id""")
def original_pages(spark, d) -> DataFrame:
    """Each turn cites its own place in the slice, and gets the page that stands there."""
    c = t(spark, d, "conversations").select(F.col("conv_id").alias("doc_id"), "turn", (F.col("turn") + 1).cast("int").alias("page"))
    return profile.original_pages(c, page_slices(spark, d))


#: Line items as a model gives them in two answers: the earlier lines, and the later ones, of which one record in five is cut off behind its first item.
SPLIT = """SELECT l_orderkey AS doc_id, CASE WHEN l_linenumber <= 3 THEN 1 ELSE 2 END AS scope, '{{"part": ' || CAST(l_partkey AS STRING) || '}}' AS object, row_number() OVER (PARTITION BY l_orderkey, l_linenumber <= 3 ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS n FROM {lineitem}"""


@query(f"""WITH o AS ({SPLIT.format(lineitem="lineitem")}) SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY scope, n) - 1 AS INT) AS row_idx, object FROM o WHERE NOT (doc_id % 5 = 0 AND scope = 2 AND n > 1)""")
def component_rows(spark, d) -> DataFrame:
    o = spark.sql(SPLIT, lineitem=t(spark, d, "lineitem"))
    body = F.array_sort(F.collect_list(F.struct("n", "object")))
    parts = o.groupBy("doc_id", "scope").agg(body.alias("b")).withColumn("b", F.transform("b", lambda x: x["object"]))
    cut = (F.col("doc_id") % 5 == 0) & (F.col("scope") == 2)
    raw = F.concat(F.lit('{"components": ['), F.when(cut, F.concat(F.get("b", F.lit(0)), F.lit(', {"part": '))).otherwise(F.concat(F.array_join("b", ", "), F.lit("]}"))))
    return salvage.component_rows(parts.select("doc_id", "scope", raw.alias("raw")))
