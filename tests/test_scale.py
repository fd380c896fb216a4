"""Copies and crowds: what joins make grows with the different points and names, not with the pairs of rows."""

import random

import pytest
from pyspark.sql import functions as F

from poiforge.functions import geo, text
from poiforge.operators import fuzzy, spatial
from poiforge.plans import conflation, linkage


def nodes(plan):
    """All nodes of an executed plan, adaptive stages opened."""
    kind = plan.getClass().getSimpleName()
    inner = [plan.executedPlan()] if kind == "AdaptiveSparkPlanExec" else [plan.plan()] if kind.endswith("QueryStageExec") else []
    below = plan.children()
    for p in [*inner, *(below.apply(i) for i in range(below.size()))]:
        yield from nodes(p)
    yield plan


def joined(df):
    """(rows, largest number of rows that a join made)."""
    rows = df.collect()
    joins = [p for p in nodes(df._jdf.queryExecution().executedPlan()) if "Join" in p.getClass().getSimpleName()]
    return rows, max(p.metrics().get("numOutputRows").get().value() for p in joins)


def sides(spark, n=400, spots=4):
    at = lambda i: (i, -66.0 + i % spots / 1000, 18.0)
    return spark.createDataFrame(list(map(at, range(n))), "a long, lon double, lat double"), spark.createDataFrame(list(map(at, range(n))), "b long, lon double, lat double")


def test_pairs_of_copies_are_made_from_their_points(spark):
    a, b = sides(spark)
    rows, most = joined(spatial.radius_join(a, b, 50.0, "a", "b"))
    assert {(r.a, r.b) for r in rows} == {(i, j) for i in range(400) for j in range(i % 4, 400, 4)} and most <= 16


def test_a_point_of_many_rows_has_several_arrays(spark, monkeypatch):
    monkeypatch.setattr(spatial, "SLICE", 7)
    a, b = sides(spark, 45, 2)
    rows = [(r.a, r.b) for r in spatial.radius_join(a, b, 50.0, "a", "b").collect()]
    assert len(rows) == len(set(rows)) and set(rows) == {(i, j) for i in range(45) for j in range(i % 2, 45, 2)}


@pytest.mark.parametrize("metric", ["haversine", "mercator"])
@pytest.mark.parametrize("lat", [0.0, 60.0, -71.0])
def test_nearest_equals_brute_force(spark, metric, lat):
    """Clusters and lone points, also over the date line; a large radius doesn't make the pairs of all points within it."""
    rnd = random.Random(5)
    spot = lambda: (rnd.choice([179.99, -179.99, 179.7]) + rnd.gauss(0, rnd.choice([0.0005, 0.01])), lat + rnd.gauss(0, rnd.choice([0.0005, 0.05])))
    spots = [spot() for _ in range(300)]
    turn = lambda x: x - 360 if x > 180 else x + 360 if x < -180 else x
    make = lambda n: [(i, turn(x), y) for i in range(n) for x, y in [rnd.choice(spots)]]
    a, b = spark.createDataFrame(make(150), "a long, lon double, lat double"), spark.createDataFrame(make(600), "b long, lon double, lat double")
    cross = a.crossJoin(b.withColumnsRenamed({"lon": "x", "lat": "y"}))
    shift = F.col("x") - 360 * F.round((F.col("x") - F.col("lon")) / 360)
    pairs = [(r.a, r.d, r.b) for r in cross.select("a", "b", geo.distance(metric)(F.col("lon"), F.col("lat"), shift, F.col("y")).alias("d")).where("d <= 20000").collect()]
    for k in (1, 3):
        want = {}
        for i, _, j in sorted(pairs):
            if len(want.setdefault(i, [])) < k:
                want[i].append(j)
        rows, most = joined(spatial.nearest_join(a, b, 20000.0, "a", "b", metric, k=k))
        got = {}
        for r in sorted(rows, key=lambda r: (r.a, r["rank"])):
            got.setdefault(r.a, []).append(r.b)
        assert got == want
    assert most < len(pairs) / 2


def test_reasons_of_near_misses_are_of_the_nearest(spark):
    a, b = sides(spark, 200, 100)
    rows, most = joined(spatial.near_miss(a, b, 4000.0, "a", "b"))
    assert len(rows) == 600 and {r.reason for r in rows} == {"within_radius"} and {7, 107} < {r.b for r in rows if r.a == 7} and most < 10_000


def test_points_copied_into_cells_are_not_broadcast(spark):
    silver = spark.range(1000).select(F.col("id").cast("string").alias("lifeline_id"), (F.col("id") / 1000).alias("lon"), F.lit(18.0).alias("lat"))
    registry = silver.withColumnRenamed("lifeline_id", "registry_id")
    plan = spatial.nearest_join(registry, silver, 2000.0, "registry_id", "lifeline_id")._jdf.queryExecution().toString()
    assert "Broadcast" not in plan


def test_one_centre_a_point_and_name_is_compared(spark):
    a, b = sides(spark)
    places, centres = a.select(F.col("a").cast("string").alias("lifeline_id"), F.lit("St. Mary").alias("name"), "lon", "lat"), b.select(F.col("b").alias("institution_id"), F.when(F.col("b") % 8 < 4, "Mary St").otherwise("Other").alias("name"), "lon", "lat")
    rows, most = joined(conflation.link_trauma(places, centres, 50.0))
    assert {(int(r.lifeline_id), r.institution_id) for r in rows} == {(i, i % 4) for i in range(400)} and most <= 400


@pytest.mark.parametrize("top", [1, 3])
def test_streets_of_a_block_are_compared_once(spark, top):
    kinds = "long, state_code string, postcode string, number string, street string"
    addresses = spark.createDataFrame([(i, "PR", "1", "5", ("Main Street", "Oak Street", "Main Stree")[i % 3], float(i), 0.0) for i in range(300)], f"id {kinds}, lon double, lat double")
    queries = spark.createDataFrame([(i, "PR", "1", "5", ("main street", "oak stret")[i % 2]) for i in range(400)] + [(900, "PR", "2", "5", "main street"), (901, None, "1", "5", "main street")], f"q {kinds}")
    rows, most = joined(fuzzy.geocode(addresses, queries, "q", top=top))
    assert {(r.q, r.id, r.lon) for r in rows} == {(q, i, float(i)) for q in range(400) for i in [(0, 3, 6), (1, 4, 7)][q % 2][:top]} and most <= 400 * top


def test_a_checked_geocode_compares_streets_once(spark):
    kinds = "long, state_code string, postcode string, number string, street string, city string"
    addresses = spark.createDataFrame([(i, "PR", "1", "5", "Main Street", "Ponce", 1.0, 2.0) for i in range(300)], f"id {kinds}, lon double, lat double")
    queries = spark.createDataFrame([(i, "PR", "1", "5", "main street", ("Ponce", "Caguas")[i % 2]) for i in range(300)], f"q {kinds}")
    rows, most = joined(fuzzy.geocode_checked(addresses, queries, "q"))
    assert {(r.q, r.status, r.id) for r in rows} == {(q, "rejected" if q % 2 else "matched", None if q % 2 else 0) for q in range(300)} and most <= 300


def test_two_streets_are_compared_once_for_all_blocks(spark, monkeypatch):
    compared = spark.sparkContext.accumulator(0)
    monkeypatch.setattr(fuzzy.text, "jaro_winkler", F.udf(lambda a, b: (compared.add(1), text.jaro_winkler_similarity(a, b))[1], "double"))
    kinds = "long, state_code string, postcode string, number string, street string, city string"
    addresses = spark.createDataFrame([(i, "PR", "1", str(i % 50), "Main Street", f"Ponce {i}", float(i), 2.0) for i in range(200)], f"id {kinds}, lon double, lat double")
    queries = spark.createDataFrame([(i, "PR", "1", str(i % 50), "main stret", "ponce") for i in range(100)], f"q {kinds}")
    rows = fuzzy.geocode_checked(addresses, queries, "q").collect()
    assert {(r.q, r.id, r.lon, r.status) for r in rows} == {(q, q % 50, float(q % 50), "matched") for q in range(100)}
    assert 1 <= compared.value <= 2


def test_places_that_look_alike_are_matched_once(spark, monkeypatch):
    sizes, plain = [], fuzzy.fuzzy_join
    monkeypatch.setattr(fuzzy, "fuzzy_join", lambda *a, **k: (sizes.append((d := plain(*a, **k)).count()), d)[1])
    places = linkage.ready_places(spark.createDataFrame([(i, "North Clinic", "", "PR", "Ponce", "00901", "", 0.0, 0.0) for i in range(100)], "place_id long, name string, display_name string, state string, city string, postcode string, house_number string, lon double, lat double"))
    # general and empty, other and empty, other with beds, general with beds
    facts = [("01", 0), ("02", 0), ("02", 9), ("01", 5)]
    for n, want in ((2, 51), (3, 52), (4, 53)):
        rows = [(50 + i, "North Clinic", "PR", "Ponce", "00901", "1 Main St", *facts[i % n], 0.0, 0.0) for i in range(100)]
        providers = linkage.ready_providers(spark.createDataFrame(rows, "provider_id long, name string, state string, city string, zip string, address string, category string, beds long, lon double, lat double"))
        assert {(r.place_id, r.provider_id) for r in linkage.tier2(places, providers).collect()} == {(i, want) for i in range(100)}
    assert max(sizes) <= 2
