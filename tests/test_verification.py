"""Folding over all of the basic plane, salvage, document search, the verdict and the store against brute force."""

import json
import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from ledgerloom import registries as R
from ledgerloom.functions import coerce, folding, text
from ledgerloom.operators import grounding, merge
from ledgerloom.operators import verification as V
from ledgerloom.plans import derived, verify
from ledgerloom.sources.salvage import register, salvaged, verdicts

FOLDS = {**dict.fromkeys("‐‑‒–—―", "-"), **dict.fromkeys("’‘‚‛", "'"), **dict.fromkeys("“”„‟", '"'), " ": " "}


def norm(s):
    return re.sub(r"\s+", " ", "".join(FOLDS.get(c, c) for c in unicodedata.normalize("NFKC", s))).strip().lower()


def squash(s):
    return re.sub("[^a-z0-9]", "", "".join(c for c in unicodedata.normalize("NFKD", s).lower() if not unicodedata.combining(c)))


def test_folding_of_every_character(spark):
    every = [chr(c) for c in range(1, 0x10000) if not 0xD800 <= c < 0xE000]
    rows = [(c, f" A{c}b ", [c, f"{c} É"]) for c in every] + [("", "", []), (None, None, None)]
    df = spark.createDataFrame(rows, "c string, s string, a array<string>").repartition(4)
    got = df.select("c", "s", folding.norm(F.col("s")).alias("n"), folding.squash(F.col("s")).alias("q"), folding.norm_all(F.col("a")).alias("ns"), folding.squash_all(F.col("a")).alias("qs")).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.s is None:
            assert (r.n, r.q, r.ns, r.qs) == (None, None, None, None)
        else:
            assert (r.n, r.q) == (norm(r.s), squash(r.s)), hex(ord(r.c))
            assert r.c == "" or (r.ns, r.qs) == ([norm(r.c), norm(f"{r.c} É")], [squash(r.c), squash(f"{r.c} É")])


# Salvage


@pytest.mark.parametrize("raw,want", [
    ('{"notes":["x"],"components":[{"a":1},{"a":2},{"a":', [{"a": 1}, {"a": 2}]), ('[{"a":1},{"a":,},{"a":3}]', [{"a": 1}, {"a": 3}]), ('{"systems":[{"s":1}],"components":[{"a":1}', [{"a": 1}]),
    ('{"components":[{"a":"]}{"},{"b":[{"c":{}}]}], "x":[{"d":1}]', [{"a": "]}{"}, {"b": [{"c": {}}]}]), ('{"components":[]}', []), ("no list", []), ("", []), (None, []), ('[{"a":"cut off', []), ('[{"a":"\\', []), ('[1, "x", {"a": 1}, [2]]', [{"a": 1}]), ('[{"a":"\\\\"},{"b":"\\""}', [{"a": "\\"}, {"b": '"'}]),
])
def test_salvage_cases(raw, want):
    assert [json.loads(x) for x in salvaged(raw)] == want


def test_salvage_of_every_prefix():
    """Of a list cut off anywhere, the objects that were complete by then; a broken one costs no other."""
    r = random.Random(2)
    value = lambda d: r.choice([r.randrange(9), 'a"]}{[\\', None, True] + ([{f"k{i}": value(d - 1) for i in range(r.randrange(3))}, [value(d - 1) for _ in range(2)]] if d else []))
    parts = [json.dumps({"v": value(3), "i": i}) if i % 4 else '{"v": tru, "i": 4}' for i in range(12)]
    head = '{"other": [{"z": 0}], "components": ['
    whole, ends, at = head + ", ".join(parts) + "]}", [], len(head)
    for p in parts:
        ends.append(at + len(p))
        at += len(p) + 2
    for cut in range(len(head), len(whole) + 1):
        assert list(salvaged(whole[:cut])) == [p for i, (p, e) in enumerate(zip(parts, ends)) if e <= cut and i % 4]


def test_salvaged_verdicts(spark):
    raw = '{"roof": {"ok": true, "reason": "a } b"}, "hvac": {"ok": fals}, "site": {"say": 1}, "firm": {"ok": false, "corrected_value": {"x": 1}}, "last": {"ok": tr'
    assert dict(verdicts(raw, ["roof", "hvac", "site", "firm", "last", "none"])) == {"roof": {"ok": True, "reason": "a } b"}, "firm": {"ok": False, "corrected_value": {"x": 1}}}
    register(spark)
    df = spark.createDataFrame([(1, raw), (2, None), (3, '{"roof": {"ok": "yes"}}')], "k int, t string")
    got = spark.sql("SELECT k, v.* FROM {df}, LATERAL salvage_verdicts(t, array('roof', 'firm', NULL)) v", df=df).collect()
    assert sorted(map(tuple, got), key=str) == [(1, "firm", False, '{"x": 1}', None), (1, "roof", True, None, "a } b"), (3, "roof", None, None, None)]
    got = spark.sql("SELECT o.* FROM VALUES ('{\"x\": [{\"a\": 1}]}') t(j), LATERAL salvage_rows(j, 'x') o").collect()
    assert [tuple(r) for r in got] == [(0, '{"a": 1}')]


# Search in documents


def present(snippet, n, q):
    parts = [p for p in (x.strip() for x in re.split(r"\.{2,}|…", snippet)) if p]

    def ordered(hay, needles):
        at = 0
        for x in filter(None, needles):
            if (i := hay.find(x, at)) < 0:
                return False
            at = i + len(x)
        return True

    return bool(parts) and (ordered(n, [norm(p) for p in parts]) or ordered(q, [squash(p) for p in parts]))


def test_document_search_equals_brute_force(spark):
    r = random.Random(7)
    words = ["roof", "unit", "cost", "été", "ﬁre", "a", "aa", "aaa", "12", "1,234", "x-y", "“ok”", "  ", "\n", "Ⅳ", "naïve"]
    pages = {d: [" ".join(r.choices(words, k=r.randrange(0, 30))) for _ in range(r.randrange(1, 6))] for d in range(40)}
    pages[40], pages[41] = [None, "only the second"], ["half a sen", "tence over two pages"]
    cells = []
    for d in range(45):
        for k in range(25):
            frag = lambda: " ".join(r.choices(words, k=r.randrange(1, 4)))
            cells.append((d, f"f{k}", "v", r.choice([" ... ", "…", ".."]).join(frag() for _ in range(r.randrange(1, 4))), r.choice([None, 0, 1, 2, 9])))
    cells += [(40, "z", "v", "ONLY the", 1), (41, "z", "v", "sentence over", 0), (41, "y", "v", "half … two pages", 0), (41, "s", "v", "--", 0), (41, "d", "v", "...", 0), (41, "n", None, "half", 0), (41, "e", "v", "", 0)]
    rows = spark.createDataFrame([(d, i, t) for d, ts in pages.items() for i, t in enumerate(ts)], "doc_id int, page_no int, text string").repartition(7)
    got = grounding.ground(spark.createDataFrame(cells, "doc_id int, field string, value string, snippet string, page int"), rows).collect()
    want = {}
    for d, f, v, s, p in cells:
        if v is None or not s:
            continue
        ts = [t or "" for t in pages.get(d, [])]
        if not ts:
            want[d, f] = (None, None)
            continue
        on = p is not None and 0 <= p < len(ts) and present(s, norm(ts[p]), squash(ts[p]))
        want[d, f] = (on or present(s, " ".join(map(norm, ts)), "".join(map(squash, ts))), on)
    assert {(x.doc_id, x.field): (x.found, x.on_page) for x in got} == want
    assert {(True, False), (True, True), (False, False), (None, None)} <= set(want.values())
    values = [(d, f"n{i}", v) for d in range(43) for i, v in enumerate([12.0, 1234.0, 1234.5, 0.0, -3.0, None, 77.0])]
    got = grounding.numbers_present(spark.createDataFrame(values, "doc_id int, field string, value double"), rows).collect()
    forms = lambda v: {f"{round(v):,}", str(round(v)), f"{round(v):,}.00", f"{v:,.2f}"}
    assert {(x.doc_id, x.field): x.found for x in got} == {(d, f): (any(squash(x) in "".join(squash(t or "") for t in pages[d]) for x in forms(v)) if d in pages else None) for d, f, v in values if v and v > 0}


def test_document_search_costs_the_pages_not_the_probes(spark):
    """Two hundred probes in a document of two hundred pages: an automaton a document, not forty thousand searches."""
    import time

    pages = [("d", i, f"page {i} " + "lorem ipsum dolor " * 2000) for i in range(200)]
    rows = spark.createDataFrame(pages, "doc_id string, page_no int, text string")
    cells = spark.createDataFrame([("d", f"f{k}", "v", f"dolor page {k} lorem" if k else "page 5 … page 4", 0) for k in range(200)], "doc_id string, field string, value string, snippet string, page int")
    began = time.perf_counter()
    got = {r.field: r.found for r in grounding.ground(cells, rows).collect()}
    assert [f for f, x in got.items() if not x] == [] and len(got) == 200  # f0: page 5, then page 40 and more
    assert time.perf_counter() - began < 60


# Verdicts and the store


def test_numbers_and_texts(spark):
    df = spark.createDataFrame([("10-15",), ("2019 (permit 1987)",), ("lots",), ("Varies",), (None,), ("One",)], "x string")
    got = [tuple(r) for r in df.select(F.struct(coerce.plain(F.col("x"))["value"], coerce.ranged(F.col("x"))["value"]).alias("v")).select("v.*").collect()]
    assert got == [(10.0, 15.0), (2019.0, 2019.0), (None, None), (None, None), (None, None), (1.0, 1.0)]
    for v in (10_000_000.0, 0.1, 1234567.25, -5.0, 0.0, 1e-6):
        row = spark.createDataFrame([(v,)], "v double").select(coerce.as_text(F.col("v")).alias("t"))
        assert float(row.first().t) == v and row.select(text.number(F.col("t"))).first()[0] == v


def test_verdicts(spark):
    rows = [("a", "property", "year_built", "range"), ("b", "property", "num_stories", "type_coercion"), ("c", "systems", "condition", "category"), ("d", "components", "x", "arithmetic"), ("e", "components", "n_rows", "empty"), ("f", "cross-table", "reserves: property vs components", "reconcile"), ("f", "systems", "subcategory", "shape")]
    issues = spark.createDataFrame(rows, "property_id string, layer string, field string, kind string").select("property_id", "layer", F.lit(None).cast("int").alias("row_idx"), "field", "kind", F.lit("").alias("detail"))
    keys = spark.createDataFrame([(k, 1 if k == "g" else 0) for k in "abcdefgh"], "property_id string, open int")
    got = {r.property_id: (r.status, r.why, r.target_quality) for r in V.verdicts(keys, issues, "open").collect()}
    assert got == {
        "a": ("clean", "", "ok"), "b": ("needs_review", "type_coercion", "ok"), "c": ("needs_review", "category", "ok"), "d": ("clean", "", "ok"), "e": ("needs_review", "empty", "no_line_items"),
        "f": ("needs_review", "reconcile; shape", "does_not_tie"), "g": ("needs_review", "unverified fields", "ok"), "h": ("clean", "", "ok"),
    }


def test_suspect_rows(spark):
    s = [("p", i, sub, True, cond, None, usd, src) for i, (sub, cond, usd, src) in enumerate([("roofing", "good", "5", "s"), ("plumbing", None, "5", "s"), ("electrical", "good", "5", None), ("site_improvements", "good", None, "s"), ("accessibility", "shiny", None, "s"), ("interior_elements", "good", "x", "s")])]
    systems = spark.createDataFrame(s, "property_id string, row_idx int, subcategory string, assessed boolean, condition string, condition_rating_numeric string, immediate_repairs_usd string, source_sections string")
    issues = V.exploded(systems, V.of_systems(systems), "row_idx")
    assert sorted((r.row_idx, r.field, r.kind) for r in issues.collect()) == [(4, "condition", "category"), (5, "immediate_repairs_usd", "type")]
    got = merge.suspect_systems(systems, issues, 9).collect()
    assert sorted((r.rank, r.subcategory, r.weight) for r in got) == [(1, "interior_elements", 3), (2, "electrical", 2), (3, "plumbing", 2), (4, "accessibility", 1), (5, "roofing", 1)]


def test_revalidated_store(spark, tmp_path):
    d = "/root/testdata/sf0.001"
    few = lambda n: derived.table(spark, d, n).where("CAST(substr(property_id, 2) AS INT) < 60")
    p, s, c = few("property").drop("k"), few("system"), few("component").withColumnRenamed("bucket", "table")
    folder = f"file:{tmp_path}/store"
    open_ = F.when(F.col("property_id").isin("p14", "p7"), 1).otherwise(0)
    verify.store_records(spark, folder, p.select("property_id", open_.alias("unresolved"), F.lit("clean").alias("status")), p, s, c, 4)
    state = lambda: {n: sorted((str(r) for r in spark.read.parquet(f"{folder}/{n}").collect())) for n in ("envelopes", "properties", "systems", "components", "flags")}
    first = {r.property_id: r for r in verify.revalidate_store(spark, folder, 4).collect()}
    one = state()
    assert verify.revalidate_store(spark, folder, 4).count() == 60 and state() == one
    assert first["p14"].unresolved == 1 and first["p14"].status == first["p7"].status == "needs_review"
    flagged = {r.property_id for r in spark.read.parquet(f"{folder}/flags").select("property_id").collect()}
    assert flagged <= {k for k, r in first.items() if r.status == "needs_review"}
    # a new extraction of one property replaces its rows; the others stay
    before = {n: {x for x in v if "property_id='p7'" not in x} for n, v in one.items() if n in ("systems", "components")}
    verify.store_records(spark, folder, *(x.where("property_id = 'p7'") for x in (p.select("property_id", F.lit(0).alias("unresolved"), F.lit("new").alias("status")), p, s.limit(0), c.limit(0))), 4)
    after = state()
    assert {x for x in after["systems"] if "property_id='p7'" not in x} == before["systems"] and len(after["properties"]) == 60
    assert set(R.STATED_TOTALS.values()) <= set(spark.read.parquet(f"{folder}/properties").columns)
