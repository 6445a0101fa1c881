from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom import registries
from ledgerloom.functions import coerce, rules, text
from ledgerloom.sources.files import register, salvaged


def values(spark, xs, f, kind=T.StringType()):
    schema = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("x", kind)])
    df = spark.createDataFrame(list(enumerate(xs)), schema)
    return [r["y"] for r in df.select("i", f(F.col("x")).alias("y")).orderBy("i").collect()]


def test_number(spark):
    xs = ["44,495 (per the rent roll dated August 02, 2023)", "1-4", "One, and attached parking garage", "twenty one", "1,250", "-5", None, "none here"]
    assert values(spark, xs, text.number) == [44495, 1, 1, None, 1250, -5, None, None]


def test_number_range(spark):
    got = values(spark, ["1-4", "One and two floors", "8 to 12", "x", None], text.number_range)
    assert [(r and (r["lo"], r["hi"])) for r in got] == [(1, 4), (1, 2), (8, 12), None, None]


def test_ranged(spark):
    got = values(spark, ["Varies", "8-12", "junk", "7", None], coerce.ranged)
    assert [(r["value"], r["varies"], r["lost"]) for r in got] == [(None, True, False), (12, False, False), (None, False, True), (7, False, False), (None, False, False)]


def test_conditions(spark):
    xs = ["fair (PVC roof)", "Good to Fair", "roof to be replaced", "not applicable", "New; Poor", "poor at wood trim", None]
    assert values(spark, xs, coerce.category_value) == ["fair", "good; fair", "roof to be replaced", "na", "excellent; poor", "poor", None]
    assert values(spark, ["4 out of 5", "3", "good"], coerce.numeric_rating) == [4, 3, None]
    assert values(spark, ["good", "average", None], coerce.ordinal) == [3, None, None]


def test_state(spark):
    assert values(spark, ["Florida", "FL", "fl", "Narnia", None], coerce.state_code) == ["FL", "FL", "FL", "Narnia", None]


def test_rules(spark):
    assert values(spark, ["Site Lighting", "Roof Drainage", "Storm Water Drainage", "", None], rules.subcategory) == ["site_improvements", "roofing", "site_improvements", "other", "other"]
    assert values(spark, ["Refrigerator", "rooftop unit", "FAÇADE", "fireplace"], rules.category) == ["appliances", "hvac", "envelope", "other"]
    assert [tuple(x) for x in values(spark, ["new roofing", "zzz"], lambda c: rules.explain(c, registries.CATEGORY_RULES))] == [("roofing", "roofing"), ("other", None)]


def test_snippets(spark):
    hay = F.lit("The UNINFLATED TOTALS: for all items $196,940 wasobserved café")
    xs = ["UNINFLATED TOTALS: ... $196,940", "was observed", "$196,940 ... UNINFLATED", "", "CAFÉ"]
    assert values(spark, xs, lambda c: text.snippet_present(c, hay)) == [True, True, False, False, True]


def test_years(spark):
    xs = ['{"3": 1, "year_4": 2, "Year 12": 3, "2024": 4, "x": 5, "0": 6}', '{"3": 1, "year_3": 9}']  # in this order
    got = values(spark, xs, lambda c: text.year_map(F.from_json(c, "map<string,double>")))
    assert got == [{3: 1.0, 4: 2.0, 12: 3.0}, {3: 9.0}]


def test_slug(spark):
    assert values(spark, ["A b--c!", "__x__"], text.slug) == ["A_b_c", "x"]
    assert values(spark, [None, "!!"], lambda c: text.slug(c, empty="unknown")) == ["unknown", "unknown"]


def test_salvage(spark):
    cut = '{"rows": [{"a": "x}{"}, {"b": [1, {"c": 2}]}, {"d": '
    assert list(salvaged(cut)) == ['{"a": "x}{"}', '{"b": [1, {"c": 2}]}'] and list(salvaged(None)) == []
    register(spark)
    df = spark.createDataFrame([(cut,)], "t string").createOrReplaceTempView("cuts") or spark.sql("SELECT o.pos FROM cuts, LATERAL salvage_rows(t) o")
    assert sorted(r[0] for r in df.collect()) == [0, 1]


def test_lenient_json(spark):
    got = values(spark, ['```json\n{"a": 1}\n```', 'so {"a": 2} it is', "none"], lambda c: text.lenient_json(c, "a int"))
    assert [r and r["a"] for r in got] == [1, 2, None]


def test_parts_are_trimmed(spark):
    assert values(spark, ["a b ... c", " x … y  ", "1 z 0 .. 0 q"], text.fragments) == [["a b", "c"], ["x", "y"], ["1 z 0", "0 q"]]
    assert values(spark, ["one two three four"], lambda c: text.contains_ordered(c, text.fragments(F.lit("one two ... four")))) == [True]
    assert values(spark, ["one two three four"], lambda c: text.contains_ordered(c, text.fragments(F.lit("four ... one two")))) == [False]
