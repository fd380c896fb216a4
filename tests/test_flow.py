"""The whole run on a few rows of every source."""

import pytest

from poiforge.operators import tags
from poiforge.plans.flow import Flow

RULES = tags.parse_rules([("hospitals", "amenity=hospital"), ("police_stations", "amenity=police")])


def sources(spark):
    rows = [
        ("node", 1, "node", {"amenity": "hospital", "name": "Grace Hospital", "addr:state": "PR", "addr:postcode": "00901", "beds": "12"}, -66.0, 18.0),
        ("node", 2, "node", {"amenity": "hospital", "name": "Luna Clinic"}, -66.1, 18.1),
        ("node", 3, "node", {"amenity": "police", "name": "Police"}, -66.2, 18.2),
        ("node", 1, "node", {"amenity": "hospital", "name": "Grace Hospital", "addr:state": "PR", "addr:postcode": "00901", "beds": "12"}, -66.0, 18.0),
        ("way", 4, "area", {"building": "hospital"}, -66.1, 18.10002),
    ]
    features = spark.createDataFrame([(*r, None) for r in rows], "type string, id long, kind string, tags map<string,string>, lon double, lat double, ring array<struct<x:double,y:double>>")
    point = "lon double, lat double"
    return {
        "features": features,
        "taxonomy": spark.createDataFrame([("hospitals", "Health and Medical", "Medical Care", "Hospitals")], "key string, level0 string, level1 string, level2 string"),
        "places": spark.createDataFrame([("p1", "Luna Clinic Norte", -66.1, 18.1), ("p2", "New Place", -66.3, 18.3)], f"place_id string, place_name string, {point}"),
        "authority": {"safety": spark.createDataFrame([(9, -66.2, 18.2)], f"authority_id long, {point}")},
        "registry": spark.createDataFrame([("r1", "Fuel Depot", "1", "", -66.4, 18.4)], f"registry_id string, registry_name string, naics string, sic string, {point}"),
        "codes": spark.createDataFrame([("naics", "1", 1, "fuel", "fuel")], "system string, code string, level int, lifeline_key string, layer string"),
        "providers": spark.createDataFrame([(7, "Grace Hospital Inc", "PR", "Ponce", "00901", "1 Main", "01", 40, -66.0, 18.0), (8, "Nowhere", "TX", "X", "70000", "1 A", "02", 0, None, None)], f"provider_id long, name string, state string, city string, zip string, address string, category string, beds long, {point}"),
        "centres": spark.createDataFrame([(5, "Luna Clinic Norte", -66.1, 18.1, "II")], f"institution_id long, name string, {point}, trauma_level string"),
        "hospital_attributes": spark.createDataFrame([(6, "Grace", "PR", "00901", "", "I")], "authority_id long, name string, state string, zip5 string, city string, trauma string"),
    }


def test_silver_to_gold(spark, tmp_path):
    flow = Flow(spark, str(tmp_path), sources(spark), RULES, layers=("health", "safety", "fuel"))
    out = flow.run()
    health = {r.display_name: r for r in out["wide_health"].collect()}
    assert set(health) == {"Grace Hospital", "Luna Clinic Norte", "New Place"}
    grace, luna = health["Grace Hospital"], health["Luna Clinic Norte"]
    assert (grace.cms_provider_num, grace.cms_match_method, grace.cms_bed_cnt, grace.hifld_trauma) == (7, "spatial", 40, "I")
    assert luna.source_provenance == "osm+overture" and luna.acs_trauma_level == "II" and round(luna.confidence_score, 2) == 0.6
    table = {r.NAME: r for r in out["hospital_table"].collect()}
    assert (table["Grace Hospital"].BEDS, table["Grace Hospital"].TRAUMA, table["Luna Clinic Norte"].TRAUMA) == (40, "I", "II")
    assert len(out["hospital_table"].columns) == 32 and out["hospital_table"].columns[:6] == ["NAME", "ADDRESS", "CITY", "STATE", "ZIP", "ZIP4"]
    safety = out["wide_safety"].collect()
    assert [(r.display_name, r.confidence_score, r.confidence_tier) for r in safety] == [("Police", 1.0, "high")]
    fuel = out["wide_fuel"].collect()
    assert [(r.display_name, r.source_provenance) for r in fuel] == [("Fuel Depot", "epa_frs")]
    assert {(r.provider_id, r.method) for r in out["match_state"].collect()} == {(7, "spatial"), (8, "unmatched")}
    assert not [c for c in out["wide_health"].columns if c.startswith("tmp_")]


def test_second_run_reads_the_stages(spark, tmp_path):
    flow = Flow(spark, str(tmp_path), {"features": sources(spark)["features"]}, RULES, layers=("safety",))
    assert flow.run()["wide_safety"].count() == 1
    flow.sources = {"features": flow.sources["features"].limit(0)}
    assert flow.run()["wide_safety"].count() == 1
    flow.force = ("all",)
    assert flow.run()["wide_safety"].count() == 0


def test_boundary_count_is_asserted(spark):
    from poiforge.sources import readers

    df = spark.createDataFrame([("PR",), ("FL",), ("FL",)], "code string")
    with pytest.raises(ValueError, match="boundaries"):
        readers.boundaries(df, ["PR", "FL"])
    with pytest.raises(ValueError, match="truncated"):
        readers.newest_release(spark, "", ["release=1/"], truncated=True)
    assert readers.newest_release(spark, "", ["release=2025-01/", "release=2025-11/"]) == "2025-11"
