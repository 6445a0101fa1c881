"""Named queries of cells, keys, writers and readers: what they make of values derived from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom import registries as R
from ledgerloom.functions import coerce, rules, text
from ledgerloom.operators import merge
from ledgerloom.plans.audits import work_folder
from ledgerloom.plans.derived import pick
from ledgerloom.plans.registry import query, t
from ledgerloom.sources import files, sinks

_SLUG = "trim(regexp_replace({0}, '[^A-Za-z0-9]+', '_', 'g'), '_')"


@query(f"""WITH x AS (SELECT doc_id, coalesce(text, '') AS t, CASE WHEN doc_id % 9 = 0 THEN ' -- ' ELSE source || ' & Co. #' || doc_id END AS name FROM documents)
SELECT doc_id, substr({_SLUG.format("t")}, 1, 60) AS property_id, coalesce(nullif({_SLUG.format("name")}, ''), 'unknown') AS firm_key, substr(sha256(concat_ws('|', 'v3', CAST(doc_id % 5 AS VARCHAR))), 1, 12) AS stamp,
  substr(sha1(trim(t)), 1, 12) AS fingerprint, substr(trim(regexp_replace(t, '\\s+', ' ', 'g')), 1, 40) AS cover FROM x""")
def keys_and_stamps(spark, d) -> DataFrame:
    x = t(spark, d, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("t"), F.when(F.col("doc_id") % 9 == 0, " -- ").otherwise(F.concat("source", F.lit(" & Co. #"), F.col("doc_id").cast("string"))).alias("name"))
    stamp = text.version_stamp([F.lit("v3"), (F.col("doc_id") % 5).cast("string")])
    return x.select("doc_id", text.slug(F.col("t"), 60).alias("property_id"), text.slug(F.col("name"), empty="unknown").alias("firm_key"), stamp.alias("stamp"), text.fingerprint(F.col("t")).alias("fingerprint"), text.flat(F.col("t"), 40).alias("cover"))


#: Keys of schedules as reports write them; the last two aren't years of the term.
YEAR_KEYS = ["{}", "year_{}", "Year {}", "yr {}", "y{}_"]


@query(f"""WITH x AS (SELECT l_orderkey, l_linenumber AS y, CAST(max(l_quantity) AS DOUBLE) AS v FROM lineitem GROUP BY 1, 2)
SELECT l_orderkey, {", ".join(f"max(v) FILTER (y = {i}) AS year_{i}" for i in range(1, R.YEARS + 1))} FROM x GROUP BY 1""")
def year_maps(spark, d) -> DataFrame:
    """Sparse schedules with keys in five spellings, and keys beyond the term, as fifteen columns."""
    x = t(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_quantity").cast("double").alias("v"))
    n = F.col("l_linenumber").cast("string")
    spelled = F.element_at(F.array(*(F.concat(F.lit(k.split("{}")[0]), n, F.lit(k.split("{}")[1])) for k in YEAR_KEYS)), (F.col("l_orderkey") % len(YEAR_KEYS)).cast("int") + 1)
    m = x.groupBy("l_orderkey").agg(F.map_from_entries(F.collect_list(F.struct(spelled.alias("k"), "v"))).alias("m"))
    beyond = F.map_from_arrays(F.array(F.lit("year_16"), F.lit("0"), F.lit("total")), F.array(*(F.lit(1.0) for _ in range(3))))
    return m.withColumn("m", text.year_map(F.map_concat("m", beyond))).select("l_orderkey", *text.widen_years(F.col("m")))


#: Conditions as reports write them, what becomes of them, and their rank.
CONDITIONS = [
    ("Good (north side)", "good", 3), ("fair at the roof", "fair", 2), ("4 out of 5", None, None), ("3", None, None), ("Good / fair", "good; fair", None), ("excellent condition", "excellent", 4), ("odd; Poor", "odd; poor", None), ("good to FAIR", "good; fair", None),
    ("N/A", "na", None), (" Poor ", "poor", 1), ("6", "6", None), ("very good; none observed", "good; no issues observed", None), (None, None, None), ("Good to odd", "good to odd", None),
]
_N = len(CONDITIONS)


@query(f"""SELECT p_partkey, {pick(f"p_partkey % {_N}", [c[1] for c in CONDITIONS])} AS condition, CASE p_partkey % {_N} WHEN 2 THEN 4.0 WHEN 3 THEN 3.0 END AS rating, CASE p_partkey % {_N} {" ".join(f"WHEN {i} THEN {c[2]}" for i, c in enumerate(CONDITIONS) if c[2])} END AS rank FROM part""")
def condition_words(spark, d) -> DataFrame:
    """Ratings with brackets, places, spans and synonyms, bare numbers apart from words, and their ranks."""
    said = t(spark, d, "part").select("p_partkey", F.expr(pick(f"p_partkey % {_N}", [c[0] for c in CONDITIONS])).alias("said"))
    rating = coerce.numeric_rating(F.col("said"))
    word = coerce.category_value(F.when(rating.isNull(), F.col("said")))
    return said.select("p_partkey", word.alias("condition"), rating.alias("rating"), coerce.ordinal(word).alias("rank"))


@query("""WITH x AS (SELECT p_partkey, CAST(p_size AS DOUBLE) AS units, CAST(CASE WHEN p_partkey % 2 = 0 THEN p_size ELSE p_size + 1 END AS DOUBLE) AS rooms, CASE p_partkey % 3 WHEN 0 THEN 'rooms' WHEN 1 THEN 'units' END AS basis FROM part)
SELECT p_partkey, CASE WHEN units = rooms AND basis = 'rooms' THEN NULL ELSE units END AS num_units, CASE WHEN units = rooms AND coalesce(basis, 'units') <> 'rooms' THEN NULL ELSE rooms END AS num_rooms FROM x""")
def denominators(spark, d) -> DataFrame:
    p = t(spark, d, "part")
    basis = F.when(F.col("p_partkey") % 3 == 0, "rooms").when(F.col("p_partkey") % 3 == 1, "units")
    x = p.select("p_partkey", F.col("p_size").cast("double").alias("num_units"), F.when(F.col("p_partkey") % 2 == 0, F.col("p_size")).otherwise(F.col("p_size") + 1).cast("double").alias("num_rooms"), basis.alias("unit_basis"))
    return coerce.dedupe_denominators(x).select("p_partkey", "num_units", "num_rooms")


@query("""WITH x AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_linenumber % 3 = 0 AND l_orderkey % 5 <> 0 THEN 'k' || l_orderkey END AS given FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, coalesce(given, max(given) OVER (PARTITION BY l_orderkey)) AS key FROM x""")
def backfilled_keys(spark, d) -> DataFrame:
    """Rows without a key take the one that their document's rows have; documents without any stay without."""
    given = F.when((F.col("l_linenumber") % 3 == 0) & (F.col("l_orderkey") % 5 != 0), F.concat(F.lit("k"), F.col("l_orderkey").cast("string")))
    x = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", given.alias("key"))
    return merge.backfill_key(x, "l_orderkey", "key", "l_linenumber")


_BUCKETS = [*R.NEAR_TERM, "reserve", "capital", None]


@query(f"""WITH x AS (SELECT {pick(f"l_partkey % {len(_BUCKETS)}", _BUCKETS)} AS bucket FROM lineitem)
SELECT CASE WHEN bucket IN ({", ".join(f"'{b}'" for b in R.NEAR_TERM)}) THEN 'near_term' WHEN bucket = 'reserve' THEN 'reserve' END AS horizon, count(*) AS n FROM x GROUP BY 1""")
def horizons(spark, d) -> DataFrame:
    x = t(spark, d, "lineitem").select(F.expr(pick(f"l_partkey % {len(_BUCKETS)}", _BUCKETS)).alias("bucket"))
    return x.groupBy(rules.horizon(F.col("bucket")).alias("horizon")).agg(F.count("*").alias("n"))


@query("SELECT c_custkey, c_name, c_mktsegment, CAST(c_custkey % 7 AS VARCHAR) AS mixed, 'csv' AS kind FROM customer UNION ALL SELECT c_custkey, c_name, c_mktsegment, CAST(c_custkey % 7 AS VARCHAR), 'parquet' FROM customer")
def written_tables(spark, d) -> DataFrame:
    """A table written as CSV and as Parquet, twice over itself, and read back with its schema."""
    folder, c = work_folder(spark, "tables"), t(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment", (F.col("c_custkey") % 7).alias("mixed"))
    for _ in range(2):
        sinks.tables({"customer": sinks.typed(c, ["mixed"])}, folder)
    back = files.csv(spark, f"{folder}/customer.csv", "c_custkey long, c_name string, c_mktsegment string, mixed string").withColumn("kind", F.lit("csv"))
    return back.unionByName(spark.read.parquet(f"{folder}/customer.parquet").withColumn("kind", F.lit("parquet")))


@query(f"""WITH x AS (SELECT s_suppkey, CASE WHEN s_suppkey % 10 = 0 THEN NULL ELSE n_name END AS firm, 'R' || n_regionkey AS state FROM supplier JOIN nation ON n_nationkey = s_nationkey)
SELECT coalesce({_SLUG.format("firm")}, 'unknown') AS firm_key, state AS state_key, count(*) AS n FROM x GROUP BY 1, 2""")
def partitioned_rows(spark, d) -> DataFrame:
    """Rows written to folders of firm and state and read back from there; rows without a firm are under unknown."""
    s, n = t(spark, d, "supplier", "nation")
    x = s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", F.when(F.col("s_suppkey") % 10 != 0, F.col("n_name")).alias("firm"), F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("state"))
    folder = work_folder(spark, "partitions")
    sinks.partitioned(x, folder, "firm", "state")
    return spark.read.parquet(folder).groupBy("firm_key", "state_key").agg(F.count("*").alias("n"))


@query("""SELECT o_orderkey AS k, 'status' AS field, o_orderstatus AS value, CAST(1 AS INT) AS page, CASE WHEN o_orderkey % 2 = 0 THEN 0.5 END AS confidence FROM orders UNION ALL SELECT o_orderkey, 'total', CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR), 2, 0.9 FROM orders
UNION ALL SELECT o_orderkey, 'key', 'k' || o_orderkey, NULL, NULL FROM orders""")
def record_cells(spark, d) -> DataFrame:
    """Records written as JSON, read with the declared schema, and unfolded into cells; what a record lacks is null."""
    o = t(spark, d, "orders")
    cell = lambda value, page, sure: F.struct(value.cast("string").alias("value"), page, sure)
    status = cell(F.col("o_orderstatus"), F.lit(1).alias("page"), F.when(F.col("o_orderkey") % 2 == 0, 0.5).alias("confidence"))
    total = cell(F.col("o_totalprice").cast("decimal(18,2)"), F.lit(2).alias("page"), F.lit(0.9).alias("confidence"))
    key = cell(F.concat(F.lit("k"), F.col("o_orderkey").cast("string")), F.lit(None).cast("int").alias("page"), F.lit(None).cast("double").alias("confidence"))
    folder = work_folder(spark, "records")
    o.select(F.to_json(F.struct(F.struct(status.alias("status"), total.alias("total"), key.alias("key")).alias("property"))).alias("value")).write.text(folder)
    lines = spark.read.schema(files.RECORD).json(folder)
    keyed = lines.withColumn("k", F.substring(coerce.unwrap(F.col("property"), "key"), 2, 20).cast("long"))
    return files.cells(keyed, "k").select("k", "field", "value", "page", "confidence")
