from ledgerloom import registries as R
from ledgerloom.plans.revalidate import revalidate


def test_revalidate(spark):
    props = spark.createDataFrame([("p", "Florida", "1-4", None, None, "10", "10", "keys", "1,500")], "property_id string, state string, num_stories string, num_stories_min string, num_stories_max string, num_units string, num_rooms string, unit_basis string, immediate_repairs_total_usd string")
    rows = [("p", s, "Good to Fair" if i else "4 out of 5", None, "8-12" if i else "lots", None, None, True, "n") for i, s in enumerate(R.SUBCATEGORIES)]
    systems = spark.createDataFrame(rows, "property_id string, subcategory string, condition string, condition_rating_numeric double, rul_years string, rul_years_min string, rul_years_max string, assessed boolean, notes string")
    comps = spark.createDataFrame([("p", "immediate", "Roof membrane", None, "$1,500", "Varies", None, None, False)], "property_id string, table string, description string, subcategory string, total_cost_usd string, rul_years string, rul_years_min string, rul_years_max string, rul_varies boolean")
    out = revalidate(props, systems, comps)
    p = out["properties"].first()
    assert (p.state, p.num_stories, p.num_stories_min, p.num_units, p.num_rooms, p.unit_basis) == ("FL", 4.0, 1.0, None, 10.0, "rooms")
    assert (p.target_quality, p.extraction_status, p.prompt_version) == ("ok", "needs_review", "unversioned")
    assert [(r.layer, r.field, r.kind) for r in out["issues"].collect()] == [("systems", "rul_years", "type_coercion")]
    s = {r.subcategory: r for r in out["systems"].collect()}
    first, second = s[R.SUBCATEGORIES[0]], s[R.SUBCATEGORIES[1]]
    assert (first.condition, first.condition_rating_numeric, first.rul_years) == (None, 4.0, None) and (second.condition, second.rul_years, second.rul_years_min) == ("good; fair", 12.0, 8.0)
    c = out["components"].first()
    assert (c.subcategory, c.total_cost_usd, c.rul_varies, c.rul_years) == ("roofing", 1500.0, True, None)
    capex = out["capex"].where("total_capex_usd > 0").collect()
    assert out["capex"].count() == 12 and [(r.subcategory, r.near_term_capex_usd) for r in capex] == [("roofing", 1500.0)]
