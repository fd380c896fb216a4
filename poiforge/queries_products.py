"""Queries of sources, sinks, conflation stages, gold products and quality checks, each with its SQL.

Sources and sinks write driver tables into the shared folder and read them back.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from poiforge import catalog as c
from poiforge.functions import geo, score, text
from poiforge.operators import fuzzy, quality, resolve, spatial, tags
from poiforge.operators.lineage import shared_dir
from poiforge.plans import conflation, gold, linkage
from poiforge.queries_linkage import scores
from poiforge.sources import readers, services, writers

query, read, points = c.query, c.read, c.points


def scratch(spark, name):
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


# -- sources and sinks --------------------------------------------------------------------------------------------------


@query("SELECT c_custkey, c_mktsegment, round(c_acctbal + 1, 2) AS c_acctbal FROM customer")
def sink_versions(spark, sf):
    """A Hive-partitioned table, read and replaced by its next version, columns picked from the scan."""
    at = scratch(spark, "versions")
    writers.table(read(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal"), at, ["c_mktsegment"])
    writers.update(spark, at, lambda df: df.withColumn("c_acctbal", F.round(F.col("c_acctbal") + 1, 2)))
    return readers.parquet(spark, writers.current(spark, at), columns=["c_custkey", "c_mktsegment", "c_acctbal"])


@query("SELECT count(*) AS n, 0 AS overlaps FROM orders")
def sink_sorted_files(spark, sf):
    """Files of a sorted sink hold disjoint ranges, in order."""
    from pyspark.sql import Window

    at = writers.sorted_table(read(spark, sf, "orders").select("o_orderkey"), scratch(spark, "sorted"), "o_orderkey", 4)
    files = spark.read.parquet(at).select("o_orderkey", F.col("_metadata.file_name").alias("f")).groupBy("f").agg(F.count("*").alias("n"), F.min("o_orderkey").alias("lo"), F.max("o_orderkey").alias("hi"))
    after = F.lead("lo").over(Window.orderBy("lo"))  # as many rows as files
    return files.withColumn("next", after).agg(F.sum("n").alias("n"), F.count_if(F.col("next") <= F.col("hi")).cast("int").alias("overlaps"))


@query("SELECT s_suppkey, s_name FROM supplier")
def sink_stage_once(spark, sf):
    """A stage that is built once and read the second time."""
    at, df = scratch(spark, "stage"), read(spark, sf, "supplier").select("s_suppkey", "s_name")
    writers.stage(spark, at, lambda: df)
    return writers.stage(spark, at, lambda: df.limit(0))


@query("SELECT c_custkey AS key, c_name AS name, NULL::DOUBLE AS balance FROM customer UNION ALL SELECT s_suppkey, NULL, s_acctbal FROM supplier")
def csv_union_by_name(spark, sf):
    a, b = scratch(spark, "csv"), scratch(spark, "csv")
    read(spark, sf, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name")).write.option("header", "true").csv(a)
    read(spark, sf, "supplier").select(F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("key")).write.option("header", "true").csv(b)
    return readers.csv(spark, a, b).select(F.col("key").cast("long").alias("key"), "name", F.col("balance").cast("double").alias("balance"))


@query("SELECT n_nationkey, n_name, n_regionkey FROM nation")
def json_scan(spark, sf):
    at = scratch(spark, "json")
    read(spark, sf, "nation").select("n_nationkey", "n_name", "n_regionkey").write.json(at)
    return readers.json(spark, at, multiline=False).select("n_nationkey", "n_name", "n_regionkey")


@query("SELECT n_nationkey::VARCHAR AS institution_id, n_name AS institution_name, 'City ' || n_regionkey AS city, CASE WHEN n_nationkey % 3 = 0 THEN 'I' WHEN n_nationkey % 3 = 1 THEN 'II' END AS trauma_level FROM nation")
def nested_institutions(spark, sf):
    """results -> childInstitutions -> programs, the adult level before the pediatric one."""
    k = F.col("n_nationkey")
    program = lambda kind, level: F.struct(F.lit(kind).alias("program_type"), level.alias("level"))
    programs = F.array(program("pediatric", F.when(k % 3 < 2, F.lit("II"))), program("adult", F.when(k % 3 == 0, F.lit("I"))))
    child = F.struct(k.cast("string").alias("institution_id"), F.col("n_name").alias("institution_name"), F.concat(F.lit("City "), F.col("n_regionkey").cast("string")).alias("city"), programs.alias("programs"))
    doc = read(spark, sf, "nation").groupBy("n_regionkey").agg(F.collect_list(child).alias("childInstitutions")).agg(F.collect_list(F.struct("childInstitutions")).alias("results"))
    return readers.institutions(doc).select("institution_id", "institution_name", "city", "trauma_level")


@query("SELECT p_partkey, p_name AS name, p_brand AS brand, p_size AS size, p_size AS dotted FROM part")
def flat_properties(spark, sf):
    df = read(spark, sf, "part").select("p_partkey", F.col("p_name").alias("name"), F.struct(F.lit("hidden").alias("name"), F.col("p_brand").alias("brand"), F.col("p_size").alias("size")).alias("properties"))
    return readers.flatten_properties(df.withColumn("dotted", readers.field(df, "properties.size"))).select("p_partkey", "name", "brand", "size", "dotted")


_PLACE = f"SELECT s_suppkey, {c.LON.format('s_suppkey')} AS lon, {c.LAT.format('s_suppkey')} AS lat, s_name FROM supplier"


@query(f"WITH s AS ({_PLACE}) SELECT s_suppkey::VARCHAR AS place_id, s_name AS place_name, 'health' AS level0, CASE WHEN s_suppkey % 2 = 0 THEN 'hospital' END AS level1, CASE WHEN s_suppkey % 4 > 0 THEN 'Main St ' || s_suppkey END AS street, round(lon, 4) AS lon FROM s WHERE (lon BETWEEN -66.8 AND -66.0) OR (lon BETWEEN -65.8 AND -65.4)")
def nested_places_in_boxes(spark, sf):
    """The bounding-box disjunction on a stored table of nested places, then the nested projection."""
    k = F.col("s_suppkey")
    rows = points(read(spark, sf, "supplier"), "s_suppkey", "s_name")
    one = F.struct(F.concat(F.lit("Main St "), k.cast("string")).alias("freeform"), F.lit("x").alias("locality"), F.lit("PR").alias("region"), F.lit("00901").alias("postcode"))
    nested = rows.select(
        k.cast("string").alias("id"), F.struct(F.col("s_name").alias("primary")).alias("names"), F.struct(F.when(k % 2 == 0, F.array(F.lit("health"), F.lit("hospital"))).otherwise(F.array(F.lit("health"))).alias("hierarchy")).alias("taxonomy"), F.lit(0.9).alias("confidence"),
        F.when(k % 4 > 0, F.array(one)).otherwise(F.array().cast("array<struct<freeform:string,locality:string,region:string,postcode:string>>")).alias("addresses"), F.struct(F.col("lon").alias("xmin"), F.col("lon").alias("xmax"), F.col("lat").alias("ymin"), F.col("lat").alias("ymax")).alias("bbox"),
    )
    at = scratch(spark, "places")
    writers.folder(nested, at)
    found = readers.places_in(readers.parquet(spark, at), [(-66.8, 17.0, -66.0, 19.0), (-65.8, 17.0, -65.4, 19.0)])
    return readers.places(found).select("place_id", "place_name", "level0", "level1", "street", F.round("lon", 4).alias("lon"))


_COUNTRY = "['US', 'PR', 'DE', 'UM'][c_custkey % 4 + 1]"


@query(f"SELECT c_custkey FROM customer WHERE {_COUNTRY} IN ('US', 'PR', 'VI', 'GU', 'MP', 'AS', 'UM') AND c_custkey % 7 > 1")
def postcode_region(spark, sf):
    k = F.col("c_custkey")
    rows = read(spark, sf, "customer").select("c_custkey", F.element_at(F.array(*map(F.lit, ("US", "PR", "DE", "UM"))), (k % 4 + 1).cast("int")).alias("country"), F.when(k % 7 == 0, F.lit(None)).when(k % 7 == 1, "9A001").otherwise("00901").alias("postcode"))
    return readers.in_region(rows, "US").select("c_custkey")


@query("SELECT n_nationkey, n_name, '2026-01-21.0' AS release FROM nation")
def newest_release_scan(spark, sf):
    at = scratch(spark, "releases")
    for name, part in (("2025-12-17.0", "n_nationkey < 3"), ("2026-01-21.0", "true")):
        writers.folder(read(spark, sf, "nation").where(part).select("n_nationkey", "n_name"), f"{at}/release={name}")
    release = readers.newest_release(spark, at)
    return readers.parquet(spark, f"{at}/release={release}").withColumn("release", F.lit(release))


@query("SELECT n_nationkey AS code, n_name FROM nation WHERE n_nationkey < 20")
def boundary_rows(spark, sf):
    """Fails if a boundary is missing or doubled."""
    return readers.boundaries(read(spark, sf, "nation").select(F.col("n_nationkey").alias("code"), "n_name"), list(range(20)))


@query("SELECT s_suppkey, s_name FROM supplier UNION ALL SELECT n_nationkey::BIGINT + 100000, n_name FROM nation")
def snapshot_parts(spark, sf):
    """A snapshot in two partition files of one name."""
    at = scratch(spark, "snapshot")
    writers.folder(read(spark, sf, "supplier").select(F.col("s_suppkey").cast("long").alias("s_suppkey"), "s_name"), f"{at}/towers_part-0")
    writers.folder(read(spark, sf, "nation").select((F.col("n_nationkey").cast("long") + 100000).alias("s_suppkey"), F.col("n_name").alias("s_name")), f"{at}/towers_part-1")
    return readers.merged(spark, at, "towers")


@query("SELECT s_suppkey, round(-(60000 + s_suppkey % 5000) / 3600.0, 6)::DOUBLE AS lon, CASE WHEN s_suppkey % 4 > 0 THEN round((18000 + s_suppkey % 4) / 3600.0, 6) END::DOUBLE AS lat FROM supplier")
def tower_records(spark, sf):
    k = F.col("s_suppkey")
    line = F.concat_ws("|", F.lit("CO"), k, F.when(k % 4 > 0, (18000 + k % 4).cast("string")).otherwise(""), F.lit("N"), 60000 + k % 5000, F.lit("W"))
    rows = readers.tower_points(read(spark, sf, "supplier").select(line.alias("value")), ["kind", "key", "lat_seconds", "lat_dir", "lon_seconds", "lon_dir"], "CO")
    return rows.select(F.col("key").cast("long").alias("s_suppkey"), F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_custkey % 180 END::DOUBLE AS lon, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_custkey % 90 END::DOUBLE AS lat FROM customer")
def point_columns(spark, sf):
    k = F.col("c_custkey")
    rows = read(spark, sf, "customer").select("c_custkey", F.when(k % 3 == 0, "bad").otherwise((k % 180).cast("string")).alias("x"), (k % 90).cast("string").alias("y"))
    return readers.with_point(rows, "x", "y").select("c_custkey", "lon", "lat")


@query(f"WITH {c.sql_points('supplier', 's_suppkey', 's', ', s_name')} SELECT 'a' AS source_layer, s_suppkey::VARCHAR AS id, '{{\"n\":\"' || s_name || '\"}}' AS info, floor((lon + 180) / 360 * 512)::INTEGER AS x, NULL AS name FROM s UNION ALL SELECT 'b', n_nationkey::VARCHAR, NULL, floor((-66.5 + 180) / 360 * 512)::INTEGER, n_name FROM nation")
def tile_union(spark, sf):
    a = points(read(spark, sf, "supplier"), "s_suppkey", "s_name").select(F.col("s_suppkey").alias("id"), F.struct(F.col("s_name").alias("n")).alias("info"), "lon", "lat")
    b = read(spark, sf, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), F.lit(-66.5).alias("lon"), F.lit(18.2).alias("lat"))
    return writers.tile_rows({"a": a, "b": b}, 9).select("source_layer", "id", "info", "x", "name")


# -- tags with real rings -----------------------------------------------------------------------------------------------

_SHAPE = [(0.0, 0.0), (0.002, 0.0), (0.002, 0.001), (0.001, 0.001), (0.001, 0.003), (0.0, 0.003), (0.0, 0.0)]


def _centre():
    area = sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(_SHAPE, _SHAPE[1:], strict=False)) / 2
    return tuple(sum((a[i] + b[i]) * (a[0] * b[1] - b[0] * a[1]) for a, b in zip(_SHAPE, _SHAPE[1:], strict=False)) / (6 * area) for i in (0, 1))


def shaped(spark, sf):
    """The tag table with a ring for every area."""
    corner = lambda dx, dy: F.struct((F.col("lon") + dx).alias("x"), (F.col("lat") + dy).alias("y"))
    return c.features(spark, sf).withColumn("ring", F.when(F.col("kind") == "area", F.array(*(corner(a, b) for a, b in _SHAPE))))


_CX, _CY = _centre()
_X, _Y = c.LON.format("id"), c.LAT.format("id")


@query(f"""WITH {c.SQL_FEATURES} SELECT type, id, round({_X} + CASE WHEN kind = 'area' THEN {_CX} ELSE 0 END, 5) AS lon, round({_Y} + CASE WHEN kind = 'area' THEN {_CY} ELSE 0 END, 5) AS lat, round(({_X} + CASE WHEN kind = 'area' THEN 0.002 ELSE 0 END)::FLOAT::DOUBLE, 4) AS xmax, round(({_Y} + CASE WHEN kind = 'area' THEN 0.003 ELSE 0 END)::FLOAT::DOUBLE, 4) AS ymax,
kind = 'area' AND NOT (building IN ('hospital', 'clinic') AND amenity IS NULL AND healthcare IS NULL) IS TRUE AS polygon FROM f WHERE {c.SQL_LAYERS['health']}""")
def layer_with_rings(spark, sf):
    """Boxes and centroids of areas; a bare hospital building becomes a point."""
    rows = tags.extract_layer(shaped(spark, sf), "health")
    return rows.select("type", "id", F.round("lon", 5).alias("lon"), F.round("lat", 5).alias("lat"), F.round(F.col("bbox.xmax").cast("double"), 4).alias("xmax"), F.round(F.col("bbox.ymax").cast("double"), 4).alias("ymax"), F.col("ring").isNotNull().alias("polygon"))


@query(f"""WITH {c.sql_points('part', 'p_partkey', 'p')}, r AS (SELECT p_partkey, lon + 0.002 AS x1, lon AS x0 FROM p) SELECT p_partkey, round(least(x1, -66.0) - greatest(x0, -66.5), 5) AS width FROM r WHERE x1 > -66.5 AND x0 < -66.0""")
def clip_to_box(spark, sf):
    """Rings are cut at the border of a box, not dropped."""
    rows = points(read(spark, sf, "part"), "p_partkey")
    corner = lambda dx, dy: F.struct((F.col("lon") + dx).alias("x"), (F.col("lat") + dy).alias("y"))
    ring = F.array(*(corner(a, b) for a, b in ((0.0, 0.0), (0.002, 0.0), (0.002, 0.001), (0.0, 0.001), (0.0, 0.0))))
    cut = rows.select("p_partkey", geo.clip_ring(ring, -66.5, 0.0, -66.0, 90.0).alias("ring")).where(F.size("ring") > 2)
    box = geo.ring_box(F.col("ring"))
    wide = F.array_max(F.transform("ring", lambda p: p["x"])) - F.array_min(F.transform("ring", lambda p: p["x"]))
    return cut.where(box.isNotNull() & (wide > 0)).select("p_partkey", F.round(wide, 5).alias("width"))


# -- conflation stages --------------------------------------------------------------------------------------------------

_CS = f"{c.sql_points('customer', 'c_custkey', 'c', ', c_name')}, {c.sql_points('supplier', 's_suppkey', 's', ', s_name')}"


def _silver(spark, sf):
    return points(read(spark, sf, "customer"), "c_custkey", "c_name").select(F.col("c_custkey").cast("string").alias("lifeline_id"), F.col("c_name").alias("display_name"), "lon", "lat", F.lit(0.45).alias("confidence_score"), F.lit("medium").alias("confidence_tier"), F.lit("osm").alias("source_provenance"), F.lit(None).cast("string").alias("cell"))


_SHA = lambda name: f"sha1(from_hex('{geo.URL_NAMESPACE}') || encode({name}))"


@query(f"""WITH {_CS}, near AS (SELECT s_suppkey, c_custkey FROM c, s WHERE {c.HAV.format(a='s', b='c')} <= 1500 QUALIFY row_number() OVER (PARTITION BY s_suppkey ORDER BY {c.HAV.format(a='s', b='c')}, c_custkey::VARCHAR) = 1),
hits AS (SELECT c_custkey, count(*) AS k, arg_max(s_name, s_suppkey) FILTER (s_suppkey % 3 > 0) AS nm FROM near JOIN s USING (s_suppkey) GROUP BY c_custkey),
new AS (SELECT *, {_SHA("'overture:' || s_suppkey")} AS h FROM s WHERE s_suppkey NOT IN (SELECT s_suppkey FROM near))
SELECT c_custkey::VARCHAR AS lifeline_id, coalesce(nm, c_name) AS display_name, round(least(1, 0.45 + 0.15 * coalesce(k, 0)), 4)::DOUBLE AS confidence_score, CASE WHEN k >= 2 THEN 'high' ELSE 'medium' END AS confidence_tier, CASE WHEN k IS NULL THEN 'osm' ELSE 'osm+overture' END AS source_provenance FROM c LEFT JOIN hits USING (c_custkey)
UNION ALL SELECT {c._UUID}, CASE WHEN s_suppkey % 3 > 0 THEN s_name ELSE ' ' END, 0.5, 'medium', 'overture' FROM new""")
def places_match_and_mint(spark, sf):
    """Places near a point override its name and raise its score, the others become points."""
    k = F.col("s_suppkey")
    places = points(read(spark, sf, "supplier"), "s_suppkey", "s_name").select(k.alias("place_id"), F.when(k % 3 > 0, F.col("s_name")).otherwise(" ").alias("place_name"), "lon", "lat")
    out = conflation.match_places(_silver(spark, sf), places, 1500.0)
    value = F.round("confidence_score", 4)
    return out.select("lifeline_id", "display_name", value.alias("confidence_score"), score.tier(value).alias("confidence_tier"), "source_provenance")


@query(f"""WITH {_CS}, hit AS (SELECT DISTINCT c_custkey FROM c, s WHERE {c.MERC.format(a='c', b='s')} <= 2500) SELECT c_custkey::VARCHAR AS lifeline_id, CASE WHEN c_custkey IN (FROM hit) THEN 1.0 ELSE 0.45 END::DOUBLE AS confidence_score, CASE WHEN c_custkey IN (FROM hit) THEN 'high' ELSE 'medium' END AS confidence_tier, CASE WHEN c_custkey IN (FROM hit) THEN 'osm+hifld' ELSE 'osm' END AS source_provenance FROM c""")
def authority_boost(spark, sf):
    authority = points(read(spark, sf, "supplier"), "s_suppkey").withColumnRenamed("s_suppkey", "authority_id")
    return conflation.boost_authority(_silver(spark, sf), authority, 2500.0).select("lifeline_id", "confidence_score", "confidence_tier", "source_provenance")


@query(f"""WITH {_CS}, codes AS (SELECT x::VARCHAR AS code, x % 3 + 1 AS level FROM range(0, 40, 3) t(x)), r AS (SELECT s.*, code, level FROM s JOIN codes ON code = (s_suppkey % 40)::VARCHAR),
near AS (SELECT s_suppkey, c_custkey FROM r s, c WHERE {c.MERC.format(a='s', b='c')} <= 2000 QUALIFY row_number() OVER (PARTITION BY s_suppkey ORDER BY {c.MERC.format(a='s', b='c')}, c_custkey::VARCHAR) = 1),
b AS (SELECT *, CASE level WHEN 1 THEN 0.25 WHEN 2 THEN 0.15 ELSE 0.05 END AS boost FROM r),
hits AS (SELECT c_custkey, sum(boost) AS boost, min(s_suppkey) AS id, arg_min(code, s_suppkey) AS naics, arg_max(level, s_suppkey) AS level FROM near JOIN b USING (s_suppkey) GROUP BY c_custkey),
new AS (SELECT *, {_SHA("'epa_frs/' || s_suppkey")} AS h FROM b WHERE s_suppkey NOT IN (SELECT s_suppkey FROM near))
SELECT c_custkey::VARCHAR AS lifeline_id, c_name AS display_name, round(least(1, 0.45 + coalesce(boost, 0)), 4)::DOUBLE AS confidence_score, CASE WHEN boost IS NULL THEN 'osm' ELSE 'osm+epa_frs' END AS source_provenance, id AS epa_registry_id, naics AS naics_codes, level::INTEGER AS level FROM c LEFT JOIN hits USING (c_custkey)
UNION ALL SELECT {c._UUID}, s_name, round(least(1, 0.5 + boost), 4)::DOUBLE, 'epa_frs', s_suppkey, code, level::INTEGER FROM new""")
def registry_link_and_mint(spark, sf):
    k = F.col("s_suppkey")
    registry = points(read(spark, sf, "supplier"), "s_suppkey", "s_name").select(k.alias("registry_id"), F.col("s_name").alias("registry_name"), (k % 40).cast("string").alias("naics"), F.lit("").alias("sic"), "lon", "lat")
    codes = spark.createDataFrame([r for r in c.CODES if r[0] == "naics"], "system string, code string, level int, lifeline_key string")
    out = conflation.link_registry(_silver(spark, sf), registry, codes, 2000.0)
    return out.select("lifeline_id", "display_name", F.round("confidence_score", 4).alias("confidence_score"), "source_provenance", "epa_registry_id", "naics_codes", F.col("naics_lifeline_tier").alias("level"))


@query(f"""WITH RECURSIVE {_CS}, nm AS (SELECT n_nationkey, lower(n_name) AS n FROM nation), p AS (SELECT c.*, n || CASE WHEN c_custkey % 2 = 0 THEN ' center' ELSE '' END AS a FROM c JOIN nm ON n_nationkey = c_custkey % 25), t AS (SELECT s.*, 'center ' || n AS b FROM s JOIN nm ON n_nationkey = s_suppkey % 25),
near AS (SELECT c_custkey, s_suppkey, a, b, {c.HAV.format(a='p', b='t')} AS d FROM p, t WHERE {c.HAV.format(a='p', b='t')} <= 20000), names AS (SELECT DISTINCT a, b FROM near), {scores("names")}
SELECT c_custkey::VARCHAR AS lifeline_id, s_suppkey AS institution_id, round(sort / 100, 4) AS score FROM near JOIN sc USING (a, b) WHERE sort >= 70 QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY sort DESC, d, s_suppkey) = 1""")
def trauma_link(spark, sf):
    """The best name of all centres within the radius, the nearer one on ties."""
    nations = read(spark, sf, "nation").select("n_nationkey", F.lower("n_name").alias("n"))
    a, b = c._sides(spark, sf)
    places = a.join(nations, F.col("c_custkey") % 25 == F.col("n_nationkey")).select(F.col("c_custkey").cast("string").alias("lifeline_id"), F.when(F.col("c_custkey") % 2 == 0, F.concat(F.initcap("n"), F.lit(" CENTER"))).otherwise(F.col("n")).alias("name"), "lon", "lat")
    centres = b.join(nations, F.col("s_suppkey") % 25 == F.col("n_nationkey")).select(F.col("s_suppkey").alias("institution_id"), F.concat(F.lit("Center, "), "n").alias("name"), "lon", "lat")
    return conflation.link_trauma(places, centres, 20000.0).select("lifeline_id", "institution_id", F.round("score", 4).alias("score"))


@query(f"""WITH RECURSIVE names AS (SELECT DISTINCT p_name AS a, 'spring green' AS b FROM part), {scores("names")}
SELECT p_partkey, round(greatest(sort, set), 3) AS score FROM part JOIN sc ON a = p_name ORDER BY greatest(sort, set) DESC, p_partkey LIMIT 10""")
def top_name_search(spark, sf):
    found = fuzzy.top_matches(read(spark, sf, "part").select("p_partkey", "p_name"), "p_name", "spring green")
    return found.select("p_partkey", F.round("score", 3).alias("score"))


@query("""WITH n AS (SELECT n_nationkey, n_regionkey, n_name AS a FROM nation), t AS (SELECT x.n_nationkey, y.n_nationkey AS other, upper(trim(x.a)) AS a, upper(trim(y.a)) AS b FROM n x JOIN n y USING (n_regionkey))
SELECT n_nationkey, other, a = b OR (least(length(a), length(b)) >= 4 AND starts_with(CASE WHEN length(a) <= length(b) THEN b ELSE a END, substr(CASE WHEN length(a) <= length(b) THEN a ELSE b END, 1, 4))) OR jaro_winkler_similarity(a, b) >= 0.75 AS plausible FROM t""")
def city_pairs(spark, sf):
    """All pairs of names of a region."""
    n = read(spark, sf, "nation").select("n_regionkey", "n_nationkey", F.lower("n_name").alias("a"))
    both = n.join(n.select("n_regionkey", F.col("n_nationkey").alias("other"), F.col("a").alias("b")), "n_regionkey")
    return both.select("n_nationkey", "other", text.city_plausible(F.col("a"), F.col("b")).alias("plausible"))


def _campus_sides(spark, sf):
    """Customers as members, nations as hospital polygons that carry values of their own."""
    k = F.col("c_custkey")
    members = points(read(spark, sf, "customer"), "c_custkey").select(F.concat(F.lit("c"), k.cast("string")).alias("lifeline_id"), "lon", "lat", F.lit(None).cast("array<struct<x:double,y:double>>").alias("ring"), F.lit("clinic").alias("osm_category"), F.when(k % 3 == 0, (k % 9).cast("string")).alias("beds"), F.when(k % 4 == 0, "yes").otherwise("no").alias("emergency"), F.lit(None).cast("string").alias("operator"), F.element_at(F.array(*map(F.lit, "abc")), (k % 3 + 1).cast("int")).alias("speciality"), F.lit(0.45).alias("confidence_score"))
    n = F.col("n_nationkey")
    areas = c._ring(read(spark, sf, "nation")).select(F.concat(F.lit("n"), n.cast("string")).alias("lifeline_id"), F.lit(None).cast("double").alias("lon"), F.lit(None).cast("double").alias("lat"), "ring", F.lit("hospital").alias("osm_category"), F.when(n % 2 == 0, "10").alias("beds"), F.lit(None).cast("string").alias("emergency"), F.when(n % 5 == 0, "State").alias("operator"), F.lit("d").alias("speciality"), F.lit(0.6).alias("confidence_score"))
    return members.unionByName(areas)


_IN = f"""{c.sql_points('customer', 'c_custkey', 'c')}, n AS (SELECT n_nationkey, (-67.2 + n_nationkey % 5 * 0.4)::DOUBLE AS x, (17.95 + n_nationkey // 5 * 0.12)::DOUBLE AS y FROM nation),
held AS (SELECT c_custkey, arg_min(n_nationkey, 'n' || n_nationkey) AS n FROM c, n WHERE ({c._CROSS}) % 2 = 1 GROUP BY c_custkey)"""


@query(f"""WITH {_IN}, m AS (SELECT n, count(*) AS k, bool_or(c_custkey % 4 = 0) AS e, sum(CASE WHEN c_custkey % 3 = 0 THEN c_custkey % 9 END) AS b, list(['a', 'b', 'c'][c_custkey % 3 + 1] ORDER BY 'c' || c_custkey) AS l FROM held GROUP BY n)
SELECT 'n' || n AS lifeline_id, k + 1 AS campus_feature_count, CASE WHEN e THEN 'yes' END AS emergency, nullif(coalesce(b, 0) + CASE WHEN n % 2 = 0 THEN 10 ELSE 0 END, 0)::BIGINT::VARCHAR AS beds, CASE WHEN n % 5 = 0 THEN 'State' END AS operator, array_to_string(list_filter(list_append(l, 'd'), lambda v, i: list_position(list_append(l, 'd'), v) = i), '|') AS speciality FROM m""")
def campus_fold(spark, sf):
    """Polygons with their own values and those of the points inside; sums of beds, also where all are NULL."""
    folded, _, _ = conflation.campus(_campus_sides(spark, sf), ["hospital"])
    return folded.select("lifeline_id", "campus_feature_count", "emergency", "beds", "operator", "speciality")


@query(f"""WITH {_IN} SELECT 'c' || c_custkey AS lifeline_id, NULL AS campus_id FROM c WHERE c_custkey NOT IN (SELECT c_custkey FROM held) UNION ALL SELECT 'n' || n_nationkey, NULL FROM n WHERE n_nationkey NOT IN (SELECT n FROM held) UNION ALL SELECT 'c' || c_custkey, 'n' || n FROM held""")
def campus_members_and_rest(spark, sf):
    """Standalone rows, polygons without members, and members with their polygon."""
    _, rest, members = conflation.campus(_campus_sides(spark, sf), ["hospital"])
    return rest.select("lifeline_id", F.lit(None).cast("string").alias("campus_id")).unionByName(members.select("lifeline_id", "campus_id"))


@query("""WITH l AS (SELECT l_orderkey % 200 AS g, l_partkey AS p, l_quantity AS score, l_linenumber AS metres, l_orderkey, l_linenumber::BIGINT AS bed_cnt, l_returnflag FROM lineitem),
o AS (SELECT *, CASE WHEN p % 4 = 0 THEN NULL ELSE p % 10 END AS n_cnt FROM l QUALIFY row_number() OVER (PARTITION BY g, p ORDER BY score DESC, metres) = 1)
SELECT 'g' || g AS campus_id, sum(n_cnt)::BIGINT AS room_cnt, max(score)::DOUBLE AS score, min(metres)::BIGINT AS metres FROM o GROUP BY g""")
def campus_providers(spark, sf):
    """Providers of a campus once each, with the sum of a count column that is NULL for some."""
    rows = read(spark, sf, "lineitem").select(F.concat(F.lit("x"), "l_orderkey", F.lit("-"), "l_linenumber").alias("lifeline_id"), (F.col("l_orderkey") % 200).alias("g"), F.col("l_partkey").alias("provider_id"), F.col("l_quantity").cast("double").alias("score"), F.lit("name").alias("method"), F.col("l_linenumber").cast("long").alias("metres"), F.when(F.col("l_partkey") % 4 != 0, F.col("l_partkey") % 10).alias("room_cnt"))
    members = rows.select("lifeline_id", F.concat(F.lit("g"), F.col("g").cast("string")).alias("campus_id"))
    out = gold.campus_with_providers(members, rows.drop("g"))
    return out.select("campus_id", "room_cnt", "score", "metres")


@query(f"""WITH RECURSIVE {c.sql_points('customer', 'c_custkey', 'c')}, nr AS (SELECT n_nationkey, lower(n_name) AS n FROM nation), b AS (SELECT c.*, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE n || ' clinic' END AS a FROM c JOIN nr ON n_nationkey = c_custkey % 25 WHERE c_custkey % 2 = 0), d AS (SELECT c.*, CASE WHEN c_custkey % 7 = 0 THEN '' ELSE 'clinic ' || n END AS b FROM c JOIN nr ON n_nationkey = c_custkey % 23 WHERE c_custkey % 2 = 1),
near AS (SELECT b.c_custkey AS k, d.c_custkey AS j, coalesce(a, '') AS a, d.b AS b FROM b, d WHERE {c.MERC.format(a='b', b='d')} <= 5000 QUALIFY row_number() OVER (PARTITION BY b.c_custkey ORDER BY {c.MERC.format(a='b', b='d')}, ('c' || d.c_custkey)) = 1),
names AS (SELECT DISTINCT a, b FROM near WHERE a <> '' AND b <> ''), {scores("names")},
m AS (SELECT k, j, near.a, near.b FROM near LEFT JOIN sc USING (a, b) WHERE near.a = '' OR near.b = '' OR sort >= 85)
SELECT 'c' || b.c_custkey AS lifeline_id, CASE WHEN b.a IS NULL AND m.b <> '' THEN m.b ELSE b.a END AS display_name FROM b LEFT JOIN m ON k = c_custkey UNION ALL SELECT 'c' || c_custkey, d.b FROM d WHERE c_custkey NOT IN (SELECT j FROM m)""")
def node_merge(spark, sf):
    """Building points take the values of the nearest node if the names agree or one is missing; the node goes."""
    k = F.col("c_custkey")
    nations = read(spark, sf, "nation").select("n_nationkey", F.lower("n_name").alias("n"))
    rows = points(read(spark, sf, "customer"), "c_custkey").withColumn("lifeline_id", F.concat(F.lit("c"), k.cast("string")))
    buildings = rows.where(k % 2 == 0).join(nations, k % 25 == F.col("n_nationkey")).select("lifeline_id", F.when(k % 5 != 0, F.concat("n", F.lit(" clinic"))).alias("display_name"), "lon", "lat")
    nodes = rows.where(k % 2 == 1).join(nations, k % 23 == F.col("n_nationkey")).select("lifeline_id", F.when(k % 7 == 0, "").otherwise(F.concat(F.lit("clinic "), "n")).alias("display_name"), "lon", "lat")
    out = resolve.merge_nodes(buildings, nodes, "lifeline_id", radius=5000.0)
    return out.select("lifeline_id", F.when(text.is_empty(F.col("display_name")) & F.col("display_name").isNull(), None).otherwise(F.col("display_name")).alias("display_name"))


@query("SELECT c_custkey, 'building' AS part FROM customer WHERE c_custkey % 3 = 0 UNION ALL SELECT c_custkey, 'node' FROM customer WHERE c_custkey % 3 = 1")
def heuristic_sides(spark, sf):
    k = F.col("c_custkey")
    rows = read(spark, sf, "customer").select("c_custkey", F.when(k % 3 == 1, "clinic").when(k % 3 == 2, "pharmacy").alias("osm_category"), F.lit(None).cast("string").alias("ring"))
    a, b = conflation.heuristic_buildings(rows)
    return a.select("c_custkey", F.lit("building").alias("part")).unionByName(b.select("c_custkey", F.lit("node").alias("part")))


# -- gold ---------------------------------------------------------------------------------------------------------------


@query("""WITH p AS (SELECT c_custkey, c_name, c_acctbal AS s, (c_custkey % 97)::DOUBLE / 10 AS lon, (c_custkey % 89)::DOUBLE / 10 AS lat FROM customer WHERE c_custkey % 2 = 0 AND c_custkey % 5 > 0 AND c_custkey % 7 > 0)
SELECT arg_min('c' || c_custkey, (-s, 'c' || c_custkey)) AS lifeline_id, max(s) AS confidence_score, count(*) > 0 AS any FROM p GROUP BY lon, lat""")
def wide_hospitals(spark, sf):
    """Hospital points that the registry didn't make alone, one per coordinate, none within 10 m of a better one."""
    k = F.col("c_custkey")
    lifeline = F.struct(F.when(k % 2 == 0, "hospitals").otherwise("fuel").alias("primary"))
    rows = read(spark, sf, "customer").select(F.concat(F.lit("c"), k.cast("string")).alias("lifeline_id"), "c_name", F.col("c_acctbal").alias("confidence_score"), ((k % 97).cast("double") / 10).alias("lon"), ((k % 89).cast("double") / 10).alias("lat"), lifeline.alias("fema_lifeline"), F.when(k % 5 == 0, "epa_frs").when(k % 3 == 0, "osm").alias("source_provenance"), F.when(k % 7 == 0, F.array(F.struct(F.lit(0.0).alias("x"), F.lit(0.0).alias("y")))).alias("ring"))
    return conflation.hospitals(rows).select("lifeline_id", "confidence_score", F.lit(True).alias("any"))


@query("SELECT c_custkey::VARCHAR AS lifeline_id, c_name AS display_name, n_regionkey::VARCHAR AS phone, n_name AS a, r_name AS b, c_mktsegment AS tag, (c_custkey // 100)::VARCHAR AS cell FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def wide_layer(spark, sf):
    """Master and attribute table of a core, side tables with clashing columns, tmp_ columns gone, written sorted by cell."""
    place = read(spark, sf, "nation").join(read(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    core = read(spark, sf, "customer").join(place, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_custkey").cast("string").alias("lifeline_id"), F.col("c_name").alias("display_name"), F.floor(F.col("c_custkey") / 100).cast("string").alias("cell"), F.col("n_regionkey").cast("string").alias("phone"), F.col("c_mktsegment").alias("tag"), "n_name", "r_name", F.lit("x").alias("tmp_osm_layer"), F.lit("node").alias("type"), F.lit(1).alias("id"))
    master, attributes = conflation.split_attributes(core)
    sides = [attributes.drop("n_name", "r_name"), core.select("lifeline_id", F.col("n_name").alias("a"), F.lit("lost").alias("tag")), core.select("lifeline_id", F.col("r_name").alias("b"), F.lit("lost").alias("a"), F.lit("lost").alias("display_name"))]
    at = scratch(spark, "wide")
    writers.sorted_table(conflation.wide(master, *sides), at, "cell")
    return writers.read(spark, at).select("lifeline_id", "display_name", "phone", "a", "b", "tag", "cell")


@query("SELECT p_partkey, CASE WHEN p_partkey % 4 < 3 THEN 'k' || p_partkey % 4 END AS primary_key, CASE WHEN p_partkey % 4 < 3 THEN 'a|b' || p_partkey % 4 || '|c' END AS hierarchy FROM part")
def taxonomy_join(spark, sf):
    taxonomy = spark.createDataFrame([(f"k{i}", "a", f"b{i}", "c") for i in range(3)], "key string, level0 string, level1 string, level2 string")
    rows = read(spark, sf, "part").select("p_partkey", F.concat(F.lit("k"), (F.col("p_partkey") % 4).cast("string")).alias("lifeline_key"))
    out = tags.taxonomy_struct(rows, taxonomy)
    return out.select("p_partkey", F.col("fema_lifeline.primary").alias("primary_key"), F.array_join("fema_lifeline.hierarchy", "|").alias("hierarchy"))


@query("SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'power' WHEN 1 THEN 'health' ELSE 'other' END AS layer FROM part")
def component_layers(spark, sf):
    k = F.col("p_partkey")
    return read(spark, sf, "part").select("p_partkey", score.component_layer(F.when(k % 3 == 0, "Energy").otherwise("Health and Medical"), F.when(k % 3 == 0, "Power Grid").when(k % 3 == 1, "Medical Care").otherwise("Unknown")).alias("layer"))


@query("SELECT p_partkey, round(p_size * 20 / 50.0)::INTEGER AS step, CASE WHEN p_partkey % 4 = 0 THEN 'secondary' WHEN p_partkey % 4 = 1 THEN 'primary' END AS level FROM part")
def steps_and_levels(spark, sf):
    k = F.col("p_partkey")
    raw = F.when(k % 4 == 0, "1; 3;x").when(k % 4 == 1, "1").when(k % 4 == 2, "x").otherwise(None)
    return read(spark, sf, "part").select("p_partkey", score.color_step(F.col("p_size") / 50.0).alias("step"), score.highest_isced(raw, {1: "primary", 3: "secondary"}).alias("level"))


@query("SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'n' || c_custkey || ' medical center' WHEN 1 THEN 'saint mary' ELSE 'general n' || c_custkey END AS plain, CASE c_custkey % 4 WHEN 0 THEN 'n' || c_custkey || ' med ctr hospital inc' WHEN 1 THEN 'hospital saint mary' ELSE 'general n' || c_custkey END AS simple FROM customer")
def other_normalisers(spark, sf):
    k = F.col("c_custkey")
    name = F.when(k % 4 == 0, F.concat(F.lit("N"), k.cast("string"), F.lit(" Med. Ctr Hospital, Inc"))).when(k % 4 == 1, "Hospital Saint-Mary").otherwise(F.concat(F.lit("General  N"), k.cast("string")))
    return read(spark, sf, "customer").select("c_custkey", text.normalize_name_plain(name).alias("plain"), text.normalize_name_simple(name).alias("simple"))


@query("SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN (c_custkey % 90 + 10)::VARCHAR WHEN 1 THEN (c_custkey % 90 + 10)::VARCHAR ELSE '12' END AS number, CASE WHEN c_custkey % 2 = 0 THEN '00731' ELSE '00901' END AS zip FROM customer")
def place_numbers(spark, sf):
    """House number and zip of a place, from its tags or its display name."""
    k = F.col("c_custkey")
    n = (k % 90 + 10).cast("string")
    number = F.when(k % 3 == 0, F.concat(n, F.lit("-A")))
    shown = F.when(k % 3 == 1, F.concat(F.lit("Centro, "), n, F.lit(" Calle Luna, Ponce 00731"))).otherwise("Ruta PR-12 Ponce 00731")
    zip_ = F.when(k % 2 == 1, "00901-1234")
    return read(spark, sf, "customer").select("c_custkey", text.place_house_number(number, shown).alias("number"), text.place_zip(zip_, shown).alias("zip"))


@query("WITH {0} SELECT id, 'es' AS lang, list_transform(string_split(\"name:es\", ';'), lambda x: trim(x))[1] AS first, len(string_split(\"name:es\", ';'))::INTEGER AS n FROM f WHERE \"name:es\" IS NOT NULL".format(c.SQL_FEATURES))
def prefix_map_lists(spark, sf):
    rows = c.features(spark, sf).select("id", F.explode(tags.prefix_map_split("name:", F.col("tags"))).alias("lang", "parts"))
    return rows.select("id", "lang", F.get("parts", F.lit(0)).alias("first"), F.size("parts").alias("n"))


# -- geocoding and matching ---------------------------------------------------------------------------------------------


@query("""WITH a AS (SELECT p_partkey AS id, p_brand AS b, (p_size % 5)::VARCHAR AS n, lower(p_name) AS s, 'City' || p_partkey % 3 AS city FROM part),
q AS (SELECT p_partkey AS q, p_brand AS b, CASE WHEN p_partkey % 11 = 0 THEN '' WHEN p_partkey % 13 = 0 THEN '77' ELSE (p_size % 5)::VARCHAR END AS n, CASE WHEN p_partkey % 7 = 0 THEN '' ELSE '00000' END AS z, lower(p_name) AS s, 'City' || p_partkey % 2 AS city FROM part),
best AS (SELECT q, id, jaro_winkler_similarity(q.s, a.s) AS w, a.city AS ac FROM q JOIN a USING (b, n) WHERE z <> '' AND n <> '' QUALIFY row_number() OVER (PARTITION BY q ORDER BY jaro_winkler_similarity(q.s, a.s) DESC, id) = 1)
SELECT q.q, CASE WHEN n = '' THEN 'no_housenumber' WHEN z = '' THEN 'no_zip' WHEN id IS NULL THEN 'no_match' WHEN w >= 0.8 AND city = ac THEN 'matched' ELSE 'rejected' END AS status, CASE WHEN n <> '' AND z <> '' AND w >= 0.8 AND city = ac THEN id END AS id FROM q LEFT JOIN best USING (q)""")
def geocode_with_city(spark, sf):
    p, k = read(spark, sf, "part"), F.col("p_partkey")
    base = p.select(k.alias("id"), F.col("p_brand").alias("state_code"), F.lit("00000").alias("postcode"), (F.col("p_size") % 5).cast("string").alias("number"), F.col("p_name").alias("street"), F.concat(F.lit("City"), (k % 3).cast("string")).alias("city"), c.lon("p_partkey").alias("lon"), c.lat("p_partkey").alias("lat"))
    asked = p.select(k.alias("q"), F.col("p_brand").alias("state_code"), F.when(k % 7 == 0, "").otherwise("00000").alias("postcode"), F.when(k % 11 == 0, "").when(k % 13 == 0, "77").otherwise((F.col("p_size") % 5).cast("string")).alias("number"), F.col("p_name").alias("street"), F.concat(F.lit("City"), (k % 2).cast("string")).alias("city"))
    return fuzzy.geocode_checked(base, asked, "q").select("q", "status", "id")


@query("SELECT p_partkey FROM part WHERE (p_partkey % 5 IN (0, 1) OR p_partkey % 5 = 4) AND p_size % 2 = 1")
def geocode_retry(spark, sf):
    k = F.col("p_partkey")
    rows = read(spark, sf, "part").select("p_partkey", F.when(k % 5 == 0, "error").when(k % 5 == 1, "no_match").when(k % 5 < 4, "ok").alias("geocode_status"), (F.col("p_size") % 2).alias("category"))
    return fuzzy.pending(rows, ("error", "no_match"), ("1",)).select("p_partkey")


@query(f"""WITH RECURSIVE nr AS (SELECT n_nationkey, lower(n_name) AS n FROM nation), l AS (SELECT c_custkey AS l, n AS a, ['PR', 'FL', ''][c_custkey % 3 + 1] AS st, 'z' || c_custkey % 40 AS z, 'C' || c_custkey % 6 AS ct FROM customer JOIN nr ON n_nationkey = c_nationkey), r AS (SELECT s_suppkey AS r, n || CASE WHEN s_suppkey % 2 = 0 THEN ' x' ELSE '' END AS b, ['PR', 'FL'][s_suppkey % 2 + 1] AS st, 'z' || s_suppkey % 30 AS z, 'C' || s_suppkey % 5 AS ct FROM supplier JOIN nr ON n_nationkey = s_nationkey),
s1 AS (SELECT l, r, a, b FROM l JOIN r USING (st, z) WHERE st <> ''), l2 AS (SELECT * FROM l WHERE st <> '' AND l NOT IN (SELECT l FROM s1)), s2 AS (SELECT l, r, a, b FROM l2 JOIN r USING (st, ct)), s3 AS (SELECT l, r, a, b FROM l2 JOIN r USING (st) WHERE l NOT IN (SELECT l FROM s2)),
t AS (FROM s1 UNION ALL FROM s2 UNION ALL FROM s3), names AS (SELECT DISTINCT a, b FROM t), {scores("names")},
m AS (SELECT l, r, sort FROM t JOIN sc USING (a, b) WHERE sort >= 80 QUALIFY row_number() OVER (PARTITION BY l ORDER BY sort DESC, r) = 1)
SELECT r, l, round(sort / 100, 4) AS score FROM m QUALIFY row_number() OVER (PARTITION BY r ORDER BY sort DESC, l) = 1""")
def qa_narrowing_match(spark, sf):
    nations = read(spark, sf, "nation").select("n_nationkey", F.lower("n_name").alias("n"))
    k, j = F.col("c_custkey"), F.col("s_suppkey")
    left = read(spark, sf, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(k.alias("l"), F.col("n").alias("norm"), F.element_at(F.array(*map(F.lit, ("PR", "FL", ""))), (k % 3 + 1).cast("int")).alias("state"), F.concat(F.lit("z"), (k % 40).cast("string")).alias("zip5"), F.concat(F.lit("C"), (k % 6).cast("string")).alias("city"))
    right = read(spark, sf, "supplier").join(nations, F.col("s_nationkey") == F.col("n_nationkey")).select(j.alias("r"), F.concat("n", F.when(j % 2 == 0, " x").otherwise("")).alias("norm"), F.element_at(F.array(F.lit("PR"), F.lit("FL")), (j % 2 + 1).cast("int")).alias("state"), F.concat(F.lit("z"), (j % 30).cast("string")).alias("zip5"), F.concat(F.lit("C"), (j % 5).cast("string")).alias("city"))
    return fuzzy.narrowing_match(left, right, "l", "r").select("r", "l", F.round("score", 4).alias("score"))


# -- quality ------------------------------------------------------------------------------------------------------------


@query(f"WITH {c.SQL_FEATURES} SELECT coalesce(amenity, 'none') AS layer, CASE WHEN kind = 'area' THEN 'Polygon' ELSE 'Point' END AS geom_type, count(*) AS n FROM f GROUP BY ALL")
def qa_geometry_types(spark, sf):
    rows = shaped(spark, sf).withColumn("layer", F.coalesce(F.col("tags")["amenity"], F.lit("none")))
    return quality.geometry_types(rows, "layer")


@query("SELECT 'rows' AS metric, (SELECT count(*) FROM customer) AS a, (SELECT count(*) FROM supplier) AS b UNION ALL SELECT 'rich', (SELECT count(*) FROM customer WHERE c_acctbal > 5000), (SELECT count(*) FROM supplier WHERE s_acctbal > 5000) UNION ALL SELECT 'building', (SELECT count(*) FROM customer WHERE c_mktsegment = 'BUILDING'), NULL")
def qa_comparison(spark, sf):
    a, b = read(spark, sf, "customer"), read(spark, sf, "supplier")
    return quality.comparison({"a": a, "b": b}, {"rows": {"a": F.lit(True), "b": F.lit(True)}, "rich": {"a": F.col("c_acctbal") > 5000, "b": F.col("s_acctbal") > 5000}, "building": {"a": F.col("c_mktsegment") == "BUILDING"}})


@query("SELECT o_orderstatus, o_orderpriority, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, o_orderstatus, o_orderpriority)::INTEGER AS place FROM orders GROUP BY o_orderstatus, o_orderpriority")
def qa_ordered_counts(spark, sf):
    """Counts in their order, which the place shows."""
    counts = quality.ordered_counts(read(spark, sf, "orders"), "o_orderstatus", "o_orderpriority")
    at = scratch(spark, "counts")
    writers.folder(counts.coalesce(1).withColumn("place", F.monotonically_increasing_id().cast("int") + 1), at)  # a report of a few rows
    return spark.read.parquet(at).select("o_orderstatus", "o_orderpriority", "n", "place")


@query("SELECT c_custkey, c_name, (SELECT count(*) FROM customer WHERE c_acctbal < 0) AS n FROM customer WHERE c_acctbal < 0 ORDER BY c_custkey LIMIT 200")
def qa_low_browser(spark, sf):
    n, rows = quality.browse(read(spark, sf, "customer"), F.col("c_acctbal") < 0, ["c_custkey", "c_name", "absent"])
    return rows.crossJoin(n)  # one row


@query("SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0 AND c_custkey % 3 = 0")
def qa_missing_both(spark, sf):
    k = F.col("c_custkey")
    rows = read(spark, sf, "customer")
    return quality.coverage_filter(rows, F.when(k % 2 == 1, k), F.when(k % 3 > 0, "I").otherwise(" "), "both").select("c_custkey")


@query("SELECT o_orderpriority, count(*) AS row_count, count(*) FILTER (o_orderkey % 3 = 0) AS matched, round(100.0 * count(*) FILTER (o_orderkey % 3 = 0) / count(*), 1)::DOUBLE AS match_pct FROM orders GROUP BY ALL")
def qa_inventory(spark, sf):
    rows = read(spark, sf, "orders").withColumn("link", F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderkey")))
    return quality.inventory(rows, "o_orderpriority", "link")


@query("SELECT p_partkey FROM part WHERE p_brand IN ('Brand#11', 'Brand#12') AND split_part(p_type, ' ', 1) = 'ECONOMY'")
def ui_filter(spark, sf):
    rows = read(spark, sf, "part").select("p_partkey", F.col("p_brand").alias("source_layer"), F.split("p_type", " ")[0].alias("component"))
    return quality.hierarchy_filter(rows, ["Brand#11", "Brand#12"], component="ECONOMY").select("p_partkey")


@query("SELECT count(*) FILTER (c_custkey % 2 = 0 AND c_custkey % 5 = 0) AS missing_cell, count(*) FILTER (c_custkey % 2 = 0 AND c_custkey % 7 = 0) AS no_taxonomy FROM customer")
def qa_expectations(spark, sf):
    """OSM rows without a cell, and without a taxonomy."""
    k = F.col("c_custkey")
    rows = read(spark, sf, "customer").select((k % 2 == 0).alias("osm"), F.when(k % 5 > 0, "c").alias("cell"), F.when(k % 7 > 0, "t").alias("key"))
    a, b = quality.implies(rows, F.col("osm"), F.col("cell").isNotNull()), quality.implies(rows, F.col("osm"), F.col("key").isNotNull())
    return a.withColumnRenamed("broken", "missing_cell").crossJoin(b.withColumnRenamed("broken", "no_taxonomy"))  # one row each


@query("SELECT c_custkey FROM customer INTERSECT SELECT o_custkey FROM orders")
def key_intersection(spark, sf):
    return read(spark, sf, "customer").select("c_custkey").intersect(read(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey")))


@query(f"""WITH {_IN} SELECT c_custkey FROM c WHERE c_custkey IN (SELECT c_custkey FROM held)""")
def in_any_polygon(spark, sf):
    """Inside the union of all polygons, which needs no dissolve."""
    return spatial.within_join(points(read(spark, sf, "customer"), "c_custkey"), c._ring(read(spark, sf, "nation")), "c_custkey", "n_nationkey").select("c_custkey").distinct()


# -- services, regions, buffers, copies ---------------------------------------------------------------------------------


def _service(batch):
    """A stand-in for a batch geocoder: it knows three addresses of four, and fails for a batch with a bad one."""
    if any(r["address"] == "bad" for r in batch):
        raise ValueError("bad address")
    return {r["s_suppkey"]: (r["s_suppkey"] / 100.0, 18.0) for r in batch if r["s_suppkey"] % 4 > 0}


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 4 > 0 THEN s_suppkey / 100.0 END::DOUBLE AS lon, s_suppkey % 4 > 0 AS found, false AS failed FROM supplier")
def geocode_service(spark, sf):
    rows = read(spark, sf, "supplier").select("s_suppkey", F.col("s_name").alias("address"))
    out = services.geocode_batches(rows, "s_suppkey", _service, size=37)
    return out.select("s_suppkey", "lon", F.col("lat").isNotNull().alias("found"), F.col("error").isNotNull().alias("failed"))


@query(f"WITH {_IN} SELECT c_custkey AS place_id, CASE WHEN c_custkey % 2 = 0 THEN 'PR' ELSE coalesce('n' || n, '') END AS state FROM c LEFT JOIN held USING (c_custkey)")
def states_of_points(spark, sf):
    """Places without a state take the code of the polygon that holds them."""
    k = F.col("c_custkey")
    places = points(read(spark, sf, "customer"), "c_custkey").select(k.alias("place_id"), F.when(k % 2 == 0, "PR").otherwise("").alias("state"), "lon", "lat")
    codes = c._ring(read(spark, sf, "nation")).select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("code"), "ring")
    return linkage.resolve_states(places, codes).select("place_id", "state")


@query(f"WITH {_IN} SELECT c_custkey, 'polygon' AS how FROM c WHERE lon BETWEEN -67 AND -66 AND lat BETWEEN 18 AND 18.4 AND c_custkey IN (SELECT c_custkey FROM held) UNION ALL SELECT c_custkey, 'box' FROM c WHERE lon BETWEEN -67 AND -66 AND lat BETWEEN 18 AND 18.4")
def region_filter(spark, sf):
    """Box, then polygons; without polygons the box alone."""
    rows, box = points(read(spark, sf, "customer"), "c_custkey"), (-67.0, 18.0, -66.0, 18.4)
    a = spatial.in_region(rows, c._ring(read(spark, sf, "nation")), "c_custkey", "n_nationkey", box)
    b = spatial.in_region(rows, None, "c_custkey", "n_nationkey", box)
    return a.select("c_custkey", F.lit("polygon").alias("how")).unionByName(b.select("c_custkey", F.lit("box").alias("how")))


@query(f"WITH {c.sql_points('supplier', 's_suppkey', 's')} SELECT s_suppkey, 33 AS corners, round(lon + degrees(500 / 6378137.0), 6) AS xmax, round(degrees(2 * atan(exp((ln(tan(radians(lat) / 2 + pi() / 4)) * 6378137.0 + 500) / 6378137.0)) - pi() / 2), 6) AS ymax, true AS inside FROM s")
def point_buffers(spark, sf):
    ring = geo.buffer(F.col("lon"), F.col("lat"), 500.0)
    rows = points(read(spark, sf, "supplier"), "s_suppkey").withColumn("ring", ring)
    top = lambda k: F.round(F.array_max(F.transform("ring", lambda p: p[k])), 6)
    return rows.select("s_suppkey", F.size("ring").alias("corners"), top("x").alias("xmax"), top("y").alias("ymax"), geo.inside_ring(F.col("lon"), F.col("lat"), F.col("ring")).alias("inside"))


@query(f"""WITH {_IN} SELECT 'members' AS layer, count(*) AS n FROM held UNION ALL SELECT 'polygons', count(*) FROM n UNION ALL SELECT 'folded', count(DISTINCT n) FROM held""")
def campus_copies(spark, sf):
    """Members, polygons and folded campuses as tables of their own."""
    rows = _campus_sides(spark, sf)
    folded, _, members = conflation.campus(rows, ["hospital"])
    tables = writers.debug_tables(spark, scratch(spark, "campus"), {"members": members, "polygons": rows.where("ring IS NOT NULL"), "folded": folded})
    out = None
    for name, df in tables.items():
        part = df.agg(F.lit(name).alias("layer"), F.count("*").alias("n"))
        out = part if out is None else out.unionByName(part)
    return out
