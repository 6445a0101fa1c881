import json

from pyspark.sql import functions as F

from ledgerloom.functions import rules
from ledgerloom.operators import dedupe, rollup
from ledgerloom.sources import files, salvage, sinks


def test_filters(spark):
    rows = [("a", "clean", True, "LOW|NO_TABLE", "A: x"), ("b", "needs_review", False, None, "E: y"), ("c", "error", None, "", None), ("d", None, True, "LOW", "zA:")]
    df = spark.createDataFrame(rows, "id string, status string, assessed boolean, flags string, layout string")
    ids = lambda d: sorted(r.id for r in d.collect())
    assert ids(rollup.usable(df)) == ["a"] and ids(rollup.usable(df, include_flagged=True)) == ["a", "b"]
    assert ids(df.where(rollup.true("assessed"))) == ["a", "d"] and ids(df.where(rollup.any_flag("flags", "NO_TABLE", "X"))) == ["a"]
    assert ids(df.where(rollup.layout_in("layout"))) == ["a"] and rollup.usable(df.limit(0)).count() == 0


def test_states_rosters_and_rollups(spark):
    rows = spark.createDataFrame([("p", 1), ("q", 2), ("r", 3)], "property_id string, x int")
    props = spark.createDataFrame([("p", "TX"), ("p", "TX"), ("q", None)], "property_id string, state string")
    got = rollup.stamped(rollup.with_state(rows, props), prompt_version="3")
    assert sorted((r.property_id, r.state, r.prompt_version) for r in got.collect()) == [("p", "TX", "3"), ("q", None, "3"), ("r", None, "3")]
    other = spark.createDataFrame([("p", 9)], "property_id string, X int")
    assert {(r.property_id, r.x, r.X_property) for r in rollup.roster(rows, other).collect()} == {("p", 1, 9), ("q", 2, None), ("r", 3, None)}
    grid = spark.createDataFrame([("p", "roofing", True, 1.5), ("q", "roofing", None, None), ("p", "plumbing", False, 2.0)], "id string, member string, assessed boolean, amount double")
    assert {tuple(r) for r in rollup.per_member(grid, "member", ["roofing", "plumbing", "hvac"], "id", "assessed", "amount").collect()} == {("roofing", 1, 1.5), ("plumbing", 0, 2.0), ("hvac", 0, 0.0)}


def test_places_and_limits(spark):
    issues = spark.createDataFrame([("p", "components[1]"), ("p", "components[12].x"), ("p", "systems[1]"), ("q", None)], "property_id string, place string")
    comps = spark.createDataFrame([("p", 1, "roofing"), ("p", 2, "hvac")], "property_id string, idx int, subcategory string")
    assert {(r.place, r.row_idx, r.subcategory) for r in rollup.located(issues, comps, where="place").collect()} == {("components[1]", 1, "roofing"), ("components[12].x", 12, None), ("systems[1]", None, None), (None, None, None)}
    items = spark.createDataFrame([("d", 1, 5), ("d", 2, 5), ("d", 3, 1), ("e", 1, 9)], "doc string, page int, size int")
    assert sorted((r.doc, r.page) for r in rollup.without_heaviest(items, "doc", "page", "size", 6).collect()) == [("d", 1), ("d", 3)]
    assert [r.page for r in rollup.head(items, 2, F.col("size").desc(), "page").collect()] == [1, 1]


def test_counts_spreads_and_samples(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 5), ("b", 7), (None, 9), ("c", None)], "k string, v int")
    assert [tuple(r) for r in rollup.value_counts(df, "k", 2).collect()] == [("a", 2), ("b", 2)]
    assert tuple(rollup.distinct_values(df, "k", "v").first()) == (3, 5)
    assert {r.k: tuple(r)[1:] for r in rollup.spread(df, ["k"], "v").collect()} == {"a": (2, 1, 1.5, 2, 3), "b": (2, 5, 6.0, 7, 12), None: (1, 9, 9.0, 9, 9), "c": (1, None, None, None, None)}
    assert tuple(rollup.group_sizes(df, "k").first()) == (1.5, 2)
    assert [(r.number, r.v) for r in rollup.numbered(df, 2, F.col("v").desc_nulls_last()).collect()] == [(1, 9), (2, 7)]
    assert [r.k for r in rules.unmatched(df.where("k IS NOT NULL"), F.when(F.col("k") == "a", "x"), "v", 2).collect()] == ["c", "b"]


def test_stamps_of_stored_records(spark):
    df = spark.createDataFrame([('{"_prompt_version": "v1"}',), ('{"_prompt_version": ""}',), ("{}",), ('{"_prom',), ("",), (None,)], "raw string")
    assert [r[0] for r in df.select(dedupe.stamp_of(F.col("raw"))).collect()] == ["v1", "unversioned", "unversioned", "unreadable", "unreadable", "unreadable"]


def test_rows_of_several_answers_and_gold_labels(spark, tmp_path):
    answers = [("d", "T2", '{"components": [{"a": 3}, {"a": '), ("d", "T1", '{"components": [{"a": 1}, {"a": 2}]}'), ("e", "T1", None), ("f", "T1", '{"components": []}')]
    got = salvage.component_rows(spark.createDataFrame(answers, "doc_id string, scope string, raw string")).collect()
    assert sorted((r.doc_id, r.row_idx, r.object) for r in got) == [("d", 0, '{"a": 1}'), ("d", 1, '{"a": 2}'), ("d", 2, '{"a": 3}')]
    (tmp_path / "r1.json").write_text('{"city": "X", "units": 12, "none": null}')
    (tmp_path / "r2.json").write_text("broken")
    assert sorted((r.id, r.field, r.value) for r in files.gold_labels(spark, str(tmp_path)).collect() if r.field != "none") == [("r1", "city", "X"), ("r1", "units", "12")]


def test_routed_records_and_their_flags(spark, tmp_path):
    records = spark.createDataFrame([("a", "clean"), ("b", "needs_review"), ("c", None)], "property_id string, status string")
    issues = spark.createDataFrame([("b", "systems", 2, "x", "range", "7"), ("b", "property", None, "y", "type", 'a "b"'), ("a", "property", None, "z", "range", "1")], "property_id string, layer string, row_idx int, field string, kind string, detail string")
    out = lambda n: f"{tmp_path}/{n}"
    sinks.routed(records, out("clean"), out("review"), issues=issues)
    assert sorted(r[0] for r in spark.read.option("header", True).csv(out("review")).collect()) == ["b", "c"]
    (flag,) = spark.read.json(out("review-flags")).collect()
    assert flag.property_id == "b" and [(x["layer"], x["row_idx"], x["detail"]) for x in json.loads(flag.flags)] == [("property", None, 'a "b"'), ("systems", 2, "7")]
    sinks.routed(records.withColumn("status", F.lit("clean")), out("clean"), out("review"), issues=issues)  # flags of what is clean now are gone
    assert spark.read.schema("property_id string, flags string").json(out("review-flags")).count() == 0


def test_markdown(spark):
    df = spark.createDataFrame([("b|c", 1), ("a", None)], "k string, v int")
    assert [r.text for r in sinks.markdown(df, "k").orderBy("line").collect()] == ["| k | v |", "|-|-|", "| a |  |", "| b\\|c | 1 |"]
