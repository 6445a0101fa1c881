"""Steps of the record checks that must run once, or not at all, whatever their results."""

from pyspark.sql import functions as F

from ledgerloom import registries as R
from ledgerloom.functions import coerce, folding, text
from ledgerloom.operators import verification as V
from ledgerloom.plans import derived
from ledgerloom.plans import revalidate as P
from ledgerloom.plans import verify
from ledgerloom.sources.store import Store


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_pages_are_searched_once(spark):
    p = spark.createDataFrame([("a", "5")], "property_id string, contingency_usd string")
    cells = spark.createDataFrame([("a", "f", "v", 1, "not there", 0.9)], "property_id string, field string, value string, page int, snippet string, confidence double")
    pages = spark.createDataFrame([("a", 1, "text")], "property_id string, page_no int, text string")
    found = V.document_issues(p, cells, pages)
    assert plan(found).count("MapInArrow") == 1
    assert sorted((r.field, r.kind, r.detail) for r in found.collect()) == [("contingency_usd", "not_in_text", "in no form"), ("f", "grounding", "not there")]


def test_totals_count_subcategories_without_sets(spark):
    s = spark.createDataFrame([("a", "roofing"), ("a", "roofing"), ("a", "shed"), ("a", "shed"), ("a", "plumbing"), ("a", "other"), ("a", "other")], "property_id string, subcategory string").withColumn("assessed", F.lit(True))
    c = spark.createDataFrame([("a", "immediate", 1.0)], "property_id string, table string, total_cost_usd double")
    t = V.totals(spark.createDataFrame([("a",), ("b",)], "property_id string"), s, c)
    assert "collect_set(CASE" not in plan(t)
    rows = {r.property_id: r for r in t.collect()}
    assert (sorted(rows["a"].subs), rows["a"].twice, rows["a"].s_rows) == (["plumbing", "roofing"], ["roofing", "shed"], 7)
    shapes = sorted((r.property_id, r.detail) for r in V.exploded(t, V.shape(t)).collect())
    assert [p for p, _ in shapes] == ["a", "a", "b"] and shapes[0] == ("a", "duplicate roofing; shed") and shapes[2][1] == "missing " + "; ".join(R.SUBCATEGORIES)


def test_plain_numbers_are_read_outside_of_lambdas(spark):
    said = ["7", "-7", "$1,234.50", "5\n", "12-15", "varies", "see note", "two", None, "-", "$5 or 6"]
    df = spark.createDataFrame([(x,) for x in said], "quantity string")
    got = P.numbers(df, {"quantity": (0, 10)}, "components")
    assert "RLIKE" in (p := plan(got)).split("Project")[-1] and "CASE WHEN (isnotnull(quantity" in p.split("transform(")[0]
    assert [(r.quantity, len(r["__lost"])) for r in got.collect()] == [(7.0, 0), (-7.0, 0), (1234.5, 0), (5.0, 0), (12.0, 0), (None, 0), (None, 1), (2.0, 0), (None, 0), (None, 0), (5.0, 0)]
    assert text.SIMPLE.endswith(r"\z")


def test_words_of_the_vocabulary_are_looked_up_at_once(spark):
    df = spark.createDataFrame([("Good",), ("N/A",), ("fair; poor",), ("good to fair",), ("shabby",), (" ; ",), (None,), ("good (new)",)], "x string").select(coerce.category_value(F.col("x")).alias("y"))
    assert [r.y for r in df.collect()] == ["good", "na", "fair; poor", "good; fair", "shabby", None, None, "good"]
    assert plan(df).index("CASE WHEN") < plan(df).index("transform(")


def kept(monkeypatch):
    """The tables that are kept while checks read them."""
    seen, once = [], verify._once
    monkeypatch.setattr(verify, "_once", lambda tables, folder: seen.extend(tables) or once(tables, folder))
    return seen


def test_totals_are_kept_while_they_are_read(spark, monkeypatch, tmp_path):
    seen = kept(monkeypatch)
    t = spark.createDataFrame([("a", "firm", 1, 1)], "property_id string, report_firm string, s_rows long, c_rows long").withColumn("__lost", F.lit(None))
    none = spark.createDataFrame([], "property_id string, layer string, row_idx int, field string, kind string, detail string")
    for where, name, value in ((V, "with_repaired_firms", t), (V, "repaired_cells", t), (V, "document_issues", none), (P, "record_issues", none)):
        monkeypatch.setattr(where, name, lambda *a, value=value, **b: value)
    monkeypatch.setattr(P, "coerced", lambda *a: (t.drop("__lost").withColumn("__lost", F.lit("")),) * 3)
    monkeypatch.setattr(V, "totals", lambda *a: t.drop("__lost").withColumn("total", F.lit(1)))
    monkeypatch.setattr(V, "repaired_firms", lambda *a: t.drop("__lost"))
    assert [r.status for r in verify.verify(t, t, t, t, t, str(tmp_path / "work")).verdicts.collect()] == ["clean"]
    assert any("total" in df.columns for df in seen)


def test_issues_are_kept_while_they_are_read(spark, monkeypatch, tmp_path):
    seen, p = kept(monkeypatch), spark.createDataFrame([("a",), ("b",)], "property_id string")
    verify.store_records(spark, str(tmp_path / "store"), p.withColumns({"unresolved": F.lit(0), "status": F.lit("clean")}), p, p, p, 2)
    found = spark.createDataFrame([("a", "systems", None, "n_rows", "sparse", "1")], "property_id string, layer string, row_idx int, field string, kind string, detail string")
    monkeypatch.setattr(P, "coerced", lambda *a: a[:3])
    monkeypatch.setattr(V, "totals", lambda *a: p)
    monkeypatch.setattr(P, "record_issues", lambda *a: found)
    after = verify.revalidate_store(spark, str(tmp_path / "store"), 2)
    assert sorted((r.property_id, r.status) for r in after.collect()) == [("a", "needs_review"), ("b", "clean")]
    assert any("kind" in df.columns for df in seen)


def test_folding_gets_small_batches(spark):
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    df = spark.createDataFrame([("Café",), (None,), ("A  b",)], "x string").select(folding.norm(F.col("x")).alias("n"), folding.squash_all(F.array("x")).alias("s"))
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) == 4 << 20
    assert [(r.n, r.s) for r in df.collect()] == [("café", ["cafe"]), (None, [None]), ("a b", ["ab"])]


def test_issues_are_found_outside_of_lambdas(spark):
    """Inside of a filter() all checks of a row were interpreted; a plan that infers the array's size would work them out twice."""
    df = spark.createDataFrame([("a", 1, 9.0, []), ("b", 2, 3.0, [("x", "f", "k", "d")]), ("c", 3, None, None)], f"property_id string, row_idx int, n double, __lost {V.LIST}")
    found = V.exploded(df, [F.when(F.col("n") > 5, V._issue("l", "n", "range", F.col("n"))), F.when(F.col("n") > 8, V._issue("l", "n", "far", F.col("n")))], "row_idx", "__lost")
    assert "lambda" not in (p := plan(found)) and p.count("range") == 1
    assert sorted(tuple(r) for r in found.collect()) == [("a", "l", 1, "n", "far", "9.0"), ("a", "l", 1, "n", "range", "9.0"), ("b", "x", 2, "f", "k", "d")]


def test_a_revalidation_merges_nothing(spark, monkeypatch, tmp_path):
    """All stored rows come back, so they take the place of what is stored as they are; first rows aren't staged either."""
    staged, merged, paths = [], Store._merged, []
    monkeypatch.setattr(Store, "_merged", lambda self, rows, order: staged.append(self.exists()) or merged(self, rows, order))
    monkeypatch.setattr(Store, "remove", lambda self, folder: paths.append(folder))
    p = spark.createDataFrame([("a", "other"), ("b", None), (None, "other")], "property_id string, subcategory string").withColumn("assessed", F.lit(False))
    c = spark.createDataFrame([("a", "reserve", 5.0)], "property_id string, table string, total_cost_usd double")
    monkeypatch.setattr(P, "coerced", lambda *a: a[:3])
    monkeypatch.setattr(P, "record_issues", lambda *a: spark.createDataFrame([("a", "systems", None, "n_rows", "sparse", "1")], "property_id string, layer string, row_idx int, field string, kind string, detail string"))
    monkeypatch.setattr(V, "totals", lambda *a: None)
    old = spark.createDataFrame([("a", "new", 0, "kept"), ("b", "new", 2, None)], "property_id string, status string, unresolved int, extra string")
    verify.store_records(spark, str(tmp_path / "s"), old, p.select("property_id"), p, c, 2)
    assert not any("-incoming-" in x for x in paths)
    after = verify.revalidate_store(spark, str(tmp_path / "s"), 2)
    assert staged == [False] * 4
    assert sorted((r.property_id, r.status, r.unresolved, r.extra) for r in after.collect()) == [("a", "needs_review", 0, None), ("b", "needs_review", 2, None)]
    read = lambda name: Store(spark, str(tmp_path / "s" / name), "property_id", 2).read()
    assert read("systems").count() == 3 and [r.total_cost_usd for r in read("components").collect()] == ["5"] and read("flags").count() == 1


def test_items_and_properties_are_made_once(spark, monkeypatch, tmp_path):
    """Parts were joined to items for each of three tables, and stated totals summed for properties, cells and pages."""
    d, done = "/root/testdata/sf0.001", []
    item = derived.table(spark, d, "item")
    (kept_item,) = verify._once((item.where("k < 200"),), str(tmp_path / "item"))
    p = derived.table(spark, d, "property", item=kept_item)
    for name in ("component", "system"):
        t = derived.table(spark, d, name, item=kept_item)
        assert "l_orderkey" not in plan(t) and "p_partkey" not in plan(t)
    few = lambda t: sorted(map(str, t.where("CAST(substr(property_id, 2) AS INT) < 200").collect()))
    assert few(derived.table(spark, d, "component", item=kept_item)) == few(derived.table(spark, d, "component"))
    assert few(p) == few(derived.table(spark, d, "property"))
    made = spark.createDataFrame(p.where("k < 200").collect(), p.schema)
    assert "o_orderkey" not in plan(derived.table(spark, d, "page", property=made))
    assert few(derived.table(spark, d, "cell", property=made)) == few(derived.table(spark, d, "cell"))
    monkeypatch.setattr(verify, "_tidy", lambda s: done.append(s))
    verify._once((made, made), str(tmp_path / "two"))
    assert len(done) == 2
