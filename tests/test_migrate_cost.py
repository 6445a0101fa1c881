"""What the migration of the older layout shuffles."""

from ledgerloom.operators import grid

FIELDS = "property_id string, pos int, subcategory string, system_name string, section_code string, condition string, action_required string, source_sections string, notes string, assessed boolean, " + ", ".join(f"{m} double" for m in grid.MONEY)


def rows(spark, *said):
    return spark.createDataFrame([(p, i, sub, name, code, "good", None, None, None, None, cost, None, None, None) for i, (p, sub, name, code, cost) in enumerate(said)], FIELDS)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]


def test_rows_of_today_are_not_shuffled(spark):
    df = rows(spark, ("a", "roofing", None, None, 1.0), (None, "roofing", None, None, 2.0))
    out = grid.migrate_legacy_systems(df)
    assert "Exchange" not in plan(out) and [(r.property_id, r.subcategory, r.immediate_repairs_usd) for r in out.collect()] == [("a", "roofing", 1.0)]


def test_marked_rows_give_what_plain_ones_do(spark):
    """Properties are marked by one shuffle of the rows; a table of marked rows is shuffled no more but for what is merged."""
    df = rows(spark, ("a", "roofing", None, None, 1.0), ("b", None, "Roofing", "3.1", 2.0), ("b", " ", "Elevator", None, 3.0), ("b", "plumbing", "Electrical service", "3.2", 4.0), (None, None, "Roofing", None, 5.0))
    marked = grid.mark_legacy(df)
    assert sorted((r.property_id, r["__old"]) for r in marked.collect()) == [("a", False), *[("b", True)] * 3] and plan(marked).count("Exchange hashpartitioning") == 1
    got, want = (sorted(map(str, grid.migrate_legacy_systems(x).collect())) for x in (marked.checkpoint(), df))
    assert got == want and len(got) == 13 and sum("immediate_repairs_usd=" in x and "immediate_repairs_usd=None" not in x for x in got) == 4
