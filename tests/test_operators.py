import math
import random
import uuid

import pytest
from pyspark.sql import functions as F

from poiforge.functions import geo, score
from poiforge.operators import fuzzy, resolve, spatial, tags
from poiforge.sources import readers, services, writers

FEATURE = "kind string, type string, id long, tags map<string,string>, lon double, lat double, ring array<struct<x:double,y:double>>"


def features(spark, *rows):
    return spark.createDataFrame([(k, t, i, g, 0.0, 0.0, None) for i, (k, t, g) in enumerate(rows)], FEATURE)


@pytest.mark.parametrize(
    ("layer", "kept", "dropped"),
    [
        ("transportation", {"aeroway": "aerodrome", "railway": "station", "highway": "services", "name": "x"}, {"aeroway": "aerodrome"}),
        ("health", {"amenity": "hospital"}, {"building": "hospital"}),
        ("fuel", {"landuse": "depot", "content": "oil"}, {"landuse": "depot", "content": "gas"}),
        ("power", {"power": "line"}, {"building": "power"}),
    ],
)
def test_layer_null_traps(spark, layer, kept, dropped):
    df = features(spark, ("node", "node", kept), ("node", "node", dropped))
    assert [r.id for r in tags.filter_layer(df, layer).collect()] == [0]


def test_prefix_maps_and_rules(spark):
    df = spark.createDataFrame([({"name:en": "a; b", "name:": "x", "amenity": "bank"},)], "tags map<string,string>")
    row = df.select(tags.prefix_map_split("name:", F.col("tags")).alias("m"), tags.match_rules(F.col("tags"), tags.parse_rules([("k1", "amenity=atm,a=b&amenity=bank"), ("k2", "amenity=bank")])).alias("k")).first()
    assert row.m == {"en": ["a", "b"], "": ["x"]} and row.k == "k2"


def test_every_layer_extracts(spark):
    df = features(spark, ("node", "node", {"amenity": "hospital", "name": "n", "name:es": "m"}))
    for layer in tags.LAYERS:
        assert tags.extract_layer(df, layer).count() == (layer == "health")


def test_uuid5_equals_stdlib(spark):
    names = ["osm/node/1", "é", ""]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r.u for r in df.select(geo.uuid5(F.col("n")).alias("u")).collect()] == [str(uuid.uuid5(uuid.NAMESPACE_URL, n)) for n in names]


@pytest.mark.parametrize("metric", ["haversine", "mercator"])
def test_radius_join_equals_brute_force(spark, metric):
    rnd = random.Random(3)
    make = lambda n: [(i, rnd.choice([179.999, -179.999, 10.0]) + rnd.uniform(-0.001, 0.001), rnd.uniform(59.99, 60.01)) for i in range(n)]
    a, b = spark.createDataFrame(make(60), "a long, lon double, lat double"), spark.createDataFrame(make(60), "b long, lon double, lat double")
    got = {(r.a, r.b) for r in spatial.radius_join(a, b, 300.0, "a", "b", metric).collect()}
    cross = a.crossJoin(b.withColumnsRenamed({"lon": "x", "lat": "y"}))
    shift = F.col("x") - 360 * F.round((F.col("x") - F.col("lon")) / 360)
    want = {(r.a, r.b) for r in cross.where(geo.distance(metric)(F.col("lon"), F.col("lat"), shift, F.col("y")) <= 300).collect()}
    assert got == want and got
    plan = spatial.radius_join(a, b, 300.0, "a", "b", metric)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_suppression_on_a_chain(spark):
    """A suppresses B, so C, in reach of B only, stays; equal to the sequential loop on random points."""
    step = 8 / 111_194
    df = spark.createDataFrame([(1, 0.0, 0.0, 0.9), (2, 0.0, step, 0.8), (3, 0.0, 2 * step, 0.7)], "id long, lon double, lat double, confidence_score double")
    assert sorted(r.id for r in resolve.suppress_near(df, "id").collect()) == [1, 3]
    rnd = random.Random(5)
    rows = [(i, rnd.uniform(0, 8 * step), rnd.uniform(0, 8 * step), rnd.choice([0.1, 0.2, 0.3])) for i in range(60)]
    from math import asin, cos, radians, sin, sqrt

    def far(p, q):
        h = sin(radians(q[2] - p[2]) / 2) ** 2 + cos(radians(p[2])) * cos(radians(q[2])) * sin(radians(q[1] - p[1]) / 2) ** 2
        return 2 * 6_371_000 * asin(sqrt(h))

    kept = []
    for p in sorted(rows, key=lambda r: (-r[3], r[0])):
        if all(far(p, q) > 10 for q in kept):
            kept.append(p)
    got = resolve.suppress_near(spark.createDataFrame(rows, df.schema), "id")
    assert sorted(r.id for r in got.collect()) == sorted(p[0] for p in kept)


@pytest.mark.parametrize(("metres", "a", "b", "left"), [(20, "St X", "St X", ["w"]), (200, "St X", "St X", ["n", "w"]), (10, "Hospital A", "Clinic B", ["n", "w"]), (5, None, None, ["w"]), (5, None, "Only node", ["w"])])
def test_node_merge(spark, metres, a, b, left):
    schema = "lifeline_id string, display_name string, phone string, lon double, lat double"
    buildings = spark.createDataFrame([("w", a, None, 0.0, 0.0)], schema)
    nodes = spark.createDataFrame([("n", b, "555", metres / 111_320, 0.0)], schema)
    got = sorted(resolve.merge_nodes(buildings, nodes, "lifeline_id").collect(), key=lambda r: r.lifeline_id)
    assert [r.lifeline_id for r in got] == left
    if left == ["w"]:
        assert got[0].phone == "555" and got[0].display_name == (a or b) and got[0].lon == 0.0


def test_empty_values_of_a_node_fill_no_gap(spark):
    schema = "lifeline_id string, display_name string, phone string, beds int, lon double, lat double"
    buildings = spark.createDataFrame([("w", None, "", None, 0.0, 0.0)], schema)
    nodes = spark.createDataFrame([("n", "", " none ", 4, 0.0, 0.0)], schema)
    assert [tuple(r)[:4] for r in resolve.merge_nodes(buildings, nodes, "lifeline_id").collect()] == [("w", None, "", 4)]


def test_polygons(spark):
    square = [(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0), (0.0, 0.0)]
    polys = spark.createDataFrame([(7, [tuple(p) for p in square])], "poly long, ring array<struct<x:double,y:double>>")
    pts = spark.createDataFrame([(1, 1.0, 1.0), (2, 3.0, 1.0), (3, None, None)], "id long, lon double, lat double")
    assert [(r.id, r.poly) for r in spatial.within_join(pts, polys, "id", "poly").collect()] == [(1, 7)]
    row = polys.select(geo.ring_centroid(F.col("ring")).alias("c"), geo.clip_ring(F.col("ring"), 1.0, -1.0, 5.0, 1.0).alias("r")).first()
    assert (row.c.x, row.c.y) == (1.0, 1.0)
    assert {(p.x, p.y) for p in row.r} == {(1.0, 0.0), (2.0, 0.0), (2.0, 1.0), (1.0, 1.0)}


def test_scores(spark):
    row = spark.range(1).select(score.distance_score(F.lit(None).cast("double")).alias("a"), score.attribute_score([]).alias("b"), score.tier(F.lit(0.45)).alias("c"), score.boosted(F.lit(0.9), score.boost(F.lit(1))).alias("d"), score.highest_isced(F.lit("1; 3;x"), {3: "secondary"}).alias("e")).first()
    assert tuple(row) == (0.0, 0.5, "medium", 1.0, "secondary")


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y,lat,lon\n1,a,18.1,-66.2\n2,b,bad,-66\n")
    (tmp_path / "b.csv").write_text("y,z\nc,9\n")
    df = readers.csv(spark, f"{tmp_path}/a.csv", f"{tmp_path}/b.csv", all_text=True)
    rows = readers.with_point(df, "lon", "lat").orderBy("y").collect()
    assert [(r.y, r.z, r.lat) for r in rows] == [("a", None, 18.1), ("b", None, None), ("c", "9", None)]
    (tmp_path / "c.dat").write_text("CO|1|x\nEN|2\nCO|3\n")
    got = readers.pipe_file(spark, f"{tmp_path}/c.dat", ["kind", "n", "v"], "CO").collect()
    assert [(r.n, r.v) for r in got] == [("1", "x"), ("3", None)]
    built = []
    out = f"{tmp_path}/stage"
    for _ in range(2):
        assert writers.stage(spark, out, lambda: built.append(1) or df).count() == 3
    assert built == [1]
    writers.sorted_table(spark.range(100).select((F.lit(99) - F.col("id")).alias("k")), f"{tmp_path}/sorted", "k", 3)
    parts = [[r.k for r in spark.read.parquet(f).collect()] for f in sorted(writers.read(spark, f"{tmp_path}/sorted").inputFiles())]
    assert len(parts) > 1 and [k for part in parts for k in part] == list(range(100))


def fetch(offset, size):
    return [{"i": i, "j": None} for i in range(offset, min(offset + size, 7))]


def test_paged_source(spark):
    spark.dataSource.register(readers.PagedSource)
    for options in ({}, {"total": "7"}):
        df = spark.read.format("paged").options(fetch="tests.test_operators:fetch", size="3", **options).load()
        assert sorted(r.row["i"] for r in df.collect()) == [str(i) for i in range(7)]


def test_table_versions_are_atomic(spark, tmp_path):
    """A failed write leaves the version before, a reader of it stays valid while it is replaced, no version is left over."""
    at = f"{tmp_path}/t"
    writers.table(spark.range(3), at)
    bad = spark.range(2).select(F.raise_error(F.lit("no")).cast("long").alias("id"))
    with pytest.raises(Exception, match="no"):
        writers.table(bad, at)
    assert writers.read(spark, at).count() == 3
    assert sorted(r.id for r in writers.update(spark, at, lambda df: df.union(df)).collect()) == [0, 0, 1, 1, 2, 2]
    kept = writers.current(spark, at)
    writers.table(spark.range(1), at, keep_old=True)
    assert spark.read.parquet(kept).count() == 6 and writers.read(spark, at).count() == 1
    with pytest.raises(FileNotFoundError):
        writers.read(spark, f"{tmp_path}/none")


def test_malformed_rows_stay_unless_dropped(spark, tmp_path):
    (tmp_path / "m.csv").write_text("x,y\n1,a\nbad,b,c\n3,d\n")
    schema_free = readers.csv(spark, f"{tmp_path}/m.csv", all_text=True)
    assert schema_free.count() == 3
    assert len(readers.csv(spark, f"{tmp_path}/m.csv", all_text=True, skip_bad=True).collect()) == 2


def test_suppression_crosses_patches(spark):
    """Long chains over the borders of patches are decided as by the loop over rows."""
    step = 8 / 111_194
    rows = [(f"k{i:03}", 1000 * i * step / 40, 0.0, float((i * 37) % 101)) for i in range(120)]
    rows += [(f"c{i:03}", -66.0 + i * step, 18.0, float(i)) for i in range(60)]
    df = spark.createDataFrame(rows, "id string, lon double, lat double, confidence_score double")
    kept = []
    for p in sorted(rows, key=lambda r: (-r[3], r[0])):
        near = lambda q, p=p: 6_371_000 * math.radians(abs(p[1] - q[1])) * math.cos(math.radians(p[2])) <= 240 and p[2] == q[2]
        if not any(near(q) for q in kept):
            kept.append(p)
    got = resolve.suppress_near(df, "id", radius=240.0)
    assert sorted(r.id for r in got.collect()) == sorted(p[0] for p in kept)


def test_same_city_and_pending(spark):
    df = spark.createDataFrame([("San Juan", "san juan bautista"), ("Ponce", "Caguas"), ("Ponce", None), ("Ponce", "")], "a string, b string")
    assert [r[0] for r in df.select(fuzzy.same_city(F.col("a"), F.col("b"))).collect()] == [True, False, True, True]
    rows = spark.createDataFrame([(1, "ok", "01"), (2, None, "01"), (3, "error", "02"), (4, "error", "01")], "k long, geocode_status string, category string")
    assert sorted(r.k for r in fuzzy.pending(rows, ("error",)).collect()) == [2, 3, 4]
    assert sorted(r.k for r in fuzzy.pending(rows, ("error",), ("01",)).collect()) == [2, 4]


def test_services_fail_by_batch_and_stop_at_their_limit(spark):
    def call(batch):
        if any(r["a"] == "bad" for r in batch):
            raise ValueError("no")
        return {r["k"]: (1.0, 2.0) for r in batch if r["k"] != 2}

    df = spark.createDataFrame([(1, "x"), (2, "y"), (3, "bad"), (4, "z")], "k long, a string").coalesce(1)
    got = {r.k: (r.lon, r.error) for r in services.geocode_batches(df, "k", call, size=2).collect()}
    assert got == {1: (1.0, None), 2: (None, None), 3: (None, "ValueError: no"), 4: (None, "ValueError: no")}
    single = services.geocode_singly(df, "k", lambda r: (float(r["k"]), 0.0), most=3, wait=0.0)
    assert sorted((r.k, r.lon) for r in single.collect()) == [(1, 1.0), (2, 2.0), (3, 3.0)]
    assert services.with_points(df, single, "k").where("re_lon IS NOT NULL").count() == 3
    assert services.geocode_batches(df.limit(0), "k", call).count() == 0
