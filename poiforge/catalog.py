"""Queries over the driver's tables, one or more per operator family, with the SQL that gives the same rows.

The tables have no coordinates or tags, so both are made from keys by integer arithmetic that is the same in Spark and SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from poiforge.functions import geo, score, text
from poiforge.operators import fuzzy, quality, resolve, spatial, tags
from poiforge.plans import conflation, gold
from poiforge.sources import readers

QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}
#: Queries that no SQL can stand for; they are tested on fixtures.
WITHOUT_SQL: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = (f, sql)
        return f

    return add


def read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# -- coordinates and tags from keys -------------------------------------------------------------------------------------


def lon(key: str):
    return -67.3 + (F.col(key) * 7919) % 21000 / 10000.0


def lat(key: str):
    return 17.9 + (F.col(key) * 104729) % 7000 / 10000.0


LON, LAT = "(-67.3 + (({0} * 7919) % 21000) / 10000.0)::DOUBLE", "(17.9 + (({0} * 104729) % 7000) / 10000.0)::DOUBLE"


def points(df: DataFrame, key: str, *columns: str) -> DataFrame:
    return df.select(key, *columns, lon(key).alias("lon"), lat(key).alias("lat"))


def sql_points(table: str, key: str, alias: str, extra: str = "") -> str:
    return f"{alias} AS (SELECT {key}{extra}, {LON.format(key)} AS lon, {LAT.format(key)} AS lat FROM {table})"


HAV = "(2 * 6371000.0 * asin(sqrt(least(1.0, pow(sin(radians({b}.lat - {a}.lat) / 2), 2) + cos(radians({a}.lat)) * cos(radians({b}.lat)) * pow(sin(radians({b}.lon - {a}.lon) / 2), 2)))))"
MERC = "sqrt(pow(radians({a}.lon) * 6378137.0 - radians({b}.lon) * 6378137.0, 2) + pow(ln(tan(radians({a}.lat) / 2 + pi() / 4)) * 6378137.0 - ln(tan(radians({b}.lat) / 2 + pi() / 4)) * 6378137.0, 2))"

#: tag -> (values, multiplier): the value at (p_partkey * multiplier) % len
TAGS = {
    "amenity": ([None, "hospital", "clinic", None, "ferry_terminal", "police", "school", None, "drinking_water"], 1),
    "healthcare": ([None, "yes", None, "hospital", None], 3),
    "name": (["Policia Norte", None, "St. Mary", None, "Sheriff Annex", "Puerto"], 5),
    "building": ([None, "hospital", "school", None], 7),
    "railway": ([None, "station", "tram_stop", None, None], 11),
    "highway": ([None, "bus_stop", "services", None, None, None, None], 13),
    "aeroway": ([None, None, "aerodrome", None], 17),
    "power": ([None, "substation", "line", "plant", None, "pole"], 19),
    "area": ([None, "yes", "no"], 23),
    "landuse": ([None, "depot", "reservoir", None], 29),
    "content": ([None, "fuel", "water", "oil", None], 31),
    "man_made": ([None, "storage_tank", "tower", "water_tower", "mast", None, "pipeline"], 37),
    "industrial": ([None, None, "oil", "gas", None], 41),
    "tower:type": ([None, "radio", "lighting", None], 43),
    "telecom": ([None, None, None, "exchange", "cable", None, None, None], 47),
    "emergency": ([None, None, None, "fire_station", None, None], 53),
    "office": ([None, "government", None], 59),
    "name:es": ([None, "Uno", "Dos; Tres"], 61),
    "pipeline": ([None, "substation", "valve", None, None], 71),
    "social_facility": ([None, None, "assisted_living", "nursing_home", "shelter", None, None], 73),
    "harbour": ([None, None, None, None, None, None, "yes"], 79),
    "waterway": ([None, "dock", None, "terminal", "river", None, None, None, None], 83),
    "public_transport": ([None, None, None, "station", "platform", "stop_area", None, None], 89),
}
KINDS, TYPES = ["node", "line", "area", "area"], ["node", "way", "relation"]


def features(spark: SparkSession, sf: str) -> DataFrame:
    """A tag table made from part."""
    pick = lambda values, m: F.element_at(F.array(*(F.lit(v) for v in values)), (F.col("p_partkey") * m % len(values) + 1).cast("int"))
    entries = F.array(*(F.struct(F.lit(k).alias("key"), pick(v, m).alias("value")) for k, (v, m) in TAGS.items()))
    rows = read(spark, sf, "part").select(F.col("p_partkey").alias("id"), pick(KINDS, 1).alias("kind"), pick(TYPES, 67).alias("type"), F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull())).alias("tags"), lon("p_partkey").alias("lon"), lat("p_partkey").alias("lat"))
    return rows.withColumn("ring", F.lit(None).cast("array<struct<x:double,y:double>>"))


def _list(values: list) -> str:
    return "[" + ", ".join("NULL" if v is None else f"'{v}'" for v in values) + "]"


SQL_FEATURES = "f AS (SELECT p_partkey AS id, {0}[p_partkey % 4 + 1] AS kind, {1}[p_partkey * 67 % 3 + 1] AS type, ".format(_list(KINDS), _list(TYPES)) + ", ".join(f"{_list(v)}[p_partkey * {m} % {len(v)} + 1] AS \"{k}\"" for k, (v, m) in TAGS.items()) + " FROM part)"


def _in(tag: str, values) -> str:
    return f'"{tag}" IN (' + ", ".join(f"'{v}'" for v in values) + ")"


_AREA = "kind = 'area' AND (type = 'relation' OR area = 'yes' OR {0})"
SQL_LAYERS = {
    "power": "power IS NOT NULL AND (kind = 'node' OR (kind = 'line' AND (area IS NULL OR area <> 'yes')) OR (" + _AREA.format("power IN ('substation', 'plant', 'generator')") + "))",
    "water_infrastructure": f"({_in('man_made', tags.WATER_WORKS)} OR landuse IN ('reservoir', 'basin') OR amenity = 'drinking_water') AND (kind = 'node' OR (kind = 'line' AND man_made = 'pipeline') OR ({_AREA.format(_in('man_made', tags.WATER_AREAS))}))",
    "telecom": f"(telecom IS NOT NULL OR {_in('man_made', tags.TELECOM_STRUCTURES)} OR (man_made = 'tower' AND {_in('tower:type', tags.TOWER_TYPES)}) OR \"tower:type\" IN ('communication', 'radio', 'radar') OR amenity = 'telephone') AND (kind = 'node' OR (kind = 'line' AND telecom IN ('cable', 'line')) OR ({_AREA.format(_in('telecom', ('exchange', 'data_center', 'service_node')))}))",
    "fuel": f"({_in('industrial', tags.FUEL_INDUSTRY)} OR pipeline IN ('substation') OR man_made IN ('petroleum_well', 'oil_well', 'gas_well') OR (man_made = 'storage_tank' AND {_in('content', tags.FUEL_CONTENT)}) OR landuse = 'depot' AND content IN ('fuel', 'oil', 'petroleum')) AND (kind = 'node' OR (kind = 'line' AND man_made = 'pipeline') OR ({_AREA.format(chr(39).join(['industrial IS NOT NULL OR man_made = ', 'storage_tank', '']))}))",
    "safety": f"({_in('amenity', tags.SAFETY_AMENITIES)} OR {_in('emergency', tags.EMERGENCY)} OR (office = 'government' AND (lower(name) LIKE '%police%' OR lower(name) LIKE '%sheriff%' OR lower(name) LIKE '%constable%' OR lower(name) LIKE '%gendarm%'))) AND (kind = 'node' OR ({_AREA.format(_in('amenity', tags.SAFETY_AMENITIES) + ' OR emergency IS NOT NULL')}))",
    "health": f"({_in('amenity', tags.HEALTH_AMENITIES)} OR healthcare IS NOT NULL OR {_in('social_facility', tags.SOCIAL_FACILITIES)} OR building IN ('hospital', 'clinic')) AND NOT (amenity IS NULL AND healthcare = 'yes' AND name IS NULL) AND (kind = 'node' OR ({_AREA.format(chr(32).join([_in('amenity', ('hospital', 'clinic', 'nursing_home')), 'OR', _in('healthcare', ('hospital', 'clinic', 'dialysis', 'rehabilitation')), 'OR', _in('building', ('hospital', 'clinic'))]))}))",
    "transportation": f"({_in('railway', tags.RAILWAY)} OR {_in('aeroway', tags.AEROWAY)} OR amenity IN ('ferry_terminal', 'bus_station') OR harbour IS NOT NULL OR waterway IN ('dock', 'terminal') AND name IS NOT NULL OR public_transport IN ('station', 'stop_area') AND name IS NOT NULL OR highway IN ('rest_area', 'services', 'bus_stop') AND name IS NOT NULL OR amenity = 'truck_stop') AND NOT (railway IN ('tram_stop') AND name IS NULL) AND NOT (highway = 'bus_stop' AND name IS NULL) AND (kind = 'node' OR ({_AREA.format(chr(32).join([_in('aeroway', ('aerodrome', 'terminal', 'heliport')), 'OR', _in('railway', ('station', 'yard', 'facility')), 'OR harbour IS NOT NULL OR', _in('amenity', ('ferry_terminal', 'bus_station', 'truck_stop'))]))}))",
    "education": f"({_in('amenity', tags.SCHOOL_AMENITIES)} OR {_in('building', tags.SCHOOL_BUILDINGS)}) AND (kind = 'node' OR ({_AREA.format(_in('amenity', tags.SCHOOL_AMENITIES) + ' OR ' + _in('building', tags.SCHOOL_BUILDINGS))}))",
}


def _layer_query(layer: str):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return tags.filter_layer(features(spark, sf), layer).select("id", "kind", "type")

    run.__name__ = f"layer_filter_{layer}"
    query(f"WITH {SQL_FEATURES} SELECT id, kind, type FROM f WHERE {SQL_LAYERS[layer]}")(run)


for _name in tags.LAYERS:
    _layer_query(_name)


@query(f"WITH {SQL_FEATURES} SELECT type, id, amenity, name, building, healthcare, {LON.format('id')}::FLOAT::DOUBLE AS xmin, {LAT.format('id')}::FLOAT::DOUBLE AS ymin FROM f WHERE {SQL_LAYERS['health']}")
def tag_projection(spark, sf):
    rows = tags.extract_layer(features(spark, sf), "health")
    return rows.select("type", "id", "amenity", "name", "building", "healthcare", F.col("bbox.xmin").cast("double").alias("xmin"), F.col("bbox.ymin").cast("double").alias("ymin"))


@query(f"WITH {SQL_FEATURES} SELECT id, 'es' AS lang, \"name:es\" AS value, array_to_string(list_transform(string_split(\"name:es\", ';'), lambda x: trim(x)), '|') AS parts FROM f WHERE \"name:es\" IS NOT NULL")
def prefix_map_entries(spark, sf):
    rows = features(spark, sf).select("id", F.explode(tags.prefix_map("name:", F.col("tags"))).alias("lang", "value"))
    return rows.withColumn("parts", F.array_join(tags.split_multi(F.col("value")), "|"))


RULES = tags.parse_rules([("police_stations", "amenity=police"), ("comms_broadcast", "man_made=mast&telecom=exchange,man_made=tower&tower:type=radio"), ("hospitals", "amenity=hospital,healthcare=hospital"), ("railway", "railway=station"), ("freight", "railway=station&area=yes")])


@query(f"""WITH {SQL_FEATURES} SELECT id, CASE WHEN amenity = 'police' THEN 'police_stations' WHEN (man_made = 'mast' AND telecom = 'exchange') OR (man_made = 'tower' AND "tower:type" = 'radio') THEN 'comms_broadcast'
WHEN amenity = 'hospital' OR healthcare = 'hospital' THEN 'hospitals' WHEN railway = 'station' THEN 'railway' END AS lifeline_key FROM f""")
def tag_rules_first_match(spark, sf):
    return features(spark, sf).select("id", tags.match_rules(F.col("tags"), RULES).alias("lifeline_key"))


_UUID = "substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || ['8', '9', 'a', 'b'][(strpos('0123456789abcdef', substr(h, 17, 1)) - 1) % 4 + 1] || substr(h, 18, 3) || '-' || substr(h, 21, 12)"


@query(f"WITH h AS (SELECT s_suppkey, sha1(from_hex('{geo.URL_NAMESPACE}') || encode('supplier/' || s_name)) AS h FROM supplier) SELECT s_suppkey, {_UUID} AS id FROM h")
def uuid5_ids(spark, sf):
    return read(spark, sf, "supplier").select("s_suppkey", geo.uuid5(F.concat(F.lit("supplier/"), "s_name")).alias("id"))


@query(f"""WITH {SQL_FEATURES}, h AS (SELECT *, sha1(from_hex('{geo.URL_NAMESPACE}') || encode('osm/' || type || '/' || id)) AS h FROM f WHERE {SQL_LAYERS['health']})
SELECT {_UUID} AS lifeline_id, amenity AS osm_category, name AS display_name, 0.45 AS confidence_score, 'medium' AS confidence_tier,
CASE WHEN amenity = 'police' THEN 'police_stations' WHEN (man_made = 'mast' AND telecom = 'exchange') OR (man_made = 'tower' AND "tower:type" = 'radio') THEN 'comms_broadcast' WHEN amenity = 'hospital' OR healthcare = 'hospital' THEN 'hospitals' WHEN railway = 'station' THEN 'railway' END AS lifeline_key,
floor({LON.format('id')} / 0.005)::BIGINT || '_' || floor({LAT.format('id')} / 0.005)::BIGINT AS cell FROM h""")
def silver_core(spark, sf):
    rows = conflation.silver_core(features(spark, sf), "health", RULES)
    return rows.select("lifeline_id", "osm_category", "display_name", F.round("confidence_score", 4).alias("confidence_score"), "confidence_tier", "lifeline_key", "cell")


# -- scans and predicates -----------------------------------------------------------------------------------------------


@query("SELECT event_id, json_extract_string(props, '$.' || k) AS v, k FROM (SELECT event_id, props, unnest(json_keys(props)) AS k FROM events)")
def props_json_map(spark, sf):
    rows = read(spark, sf, "events").select("event_id", F.from_json("props", "map<string,string>").alias("m"))
    return rows.select("event_id", F.explode("m").alias("k", "v")).select("event_id", "v", "k")


@query(f"WITH {sql_points('customer', 'c_custkey', 'c')} SELECT c_custkey FROM c WHERE (lon BETWEEN -66.8 AND -66.2 AND lat BETWEEN 18.0 AND 18.2) OR (lon BETWEEN -65.9 AND -65.5 AND lat BETWEEN 18.3 AND 18.55)")
def bbox_or_filter(spark, sf):
    rows = points(read(spark, sf, "customer"), "c_custkey")
    return rows.where(geo.in_boxes(F.col("lon"), F.col("lat"), [(-66.8, 18.0, -66.2, 18.2), (-65.9, 18.3, -65.5, 18.55)])).select("c_custkey")


@query("SELECT p_partkey FROM part WHERE string_split(p_type, ' ')[1] = 'ECONOMY' OR (string_split(p_type, ' ')[1] = 'STANDARD' AND string_split(p_type, ' ')[2] = 'BURNISHED')")
def taxonomy_allow_list(spark, sf):
    return read(spark, sf, "part").where(readers.allow_list(F.split("p_type", " "), [("ECONOMY", None), ("STANDARD", "BURNISHED")])).select("p_partkey")


@query("SELECT s_suppkey, n_name, -(s_suppkey % 1000 + 1) / 3600.0 AS degrees FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def dat_pipe_join(spark, sf):
    line = F.concat_ws("|", F.lit("CO"), F.col("s_suppkey"), F.col("s_nationkey"), F.col("s_suppkey") % 1000 + 1, F.lit("W"))
    a = readers.pipe_records(read(spark, sf, "supplier").select(line.alias("value")), ["kind", "key", "nation", "seconds", "dir"], "CO")
    b = readers.pipe_records(read(spark, sf, "nation").select(F.concat_ws("|", F.lit("EN"), "n_nationkey", "n_name").alias("value")), ["kind", "nation", "n_name"], "EN")
    return a.join(b.drop("kind"), "nation", "left").select(F.col("key").cast("long").alias("s_suppkey"), "n_name", geo.dms(F.col("seconds"), F.col("dir")).alias("degrees"))


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE starts_with(o_orderpriority, '1') ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def topk(spark, sf):
    return read(spark, sf, "orders").where(F.coalesce(F.col("o_orderpriority").startswith("1"), F.lit(False))).orderBy(F.desc_nulls_last("o_totalprice"), "o_orderkey").limit(25).select("o_orderkey", "o_totalprice")


# -- spatial joins ------------------------------------------------------------------------------------------------------

_CS = f"{sql_points('customer', 'c_custkey', 'c')}, {sql_points('supplier', 's_suppkey', 's')}"


def _sides(spark, sf):
    return points(read(spark, sf, "customer"), "c_custkey"), points(read(spark, sf, "supplier"), "s_suppkey")


@query(f"""WITH {_CS}, d AS (SELECT c_custkey, s_suppkey, {HAV.format(a='c', b='s')} AS d FROM c, s)
SELECT c_custkey, s_suppkey, round(d, 3) AS distance_m FROM d WHERE d <= 2000 QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY d, s_suppkey) = 1""")
def nn_join(spark, sf):
    c, s = _sides(spark, sf)
    return spatial.nearest_join(c, s, 2000.0, "c_custkey", "s_suppkey", "haversine").select("c_custkey", "s_suppkey", F.round("distance_m", 3).alias("distance_m"))


@query(f"""WITH {_CS}, d AS (SELECT c_custkey, s_suppkey, {MERC.format(a='c', b='s')} AS d FROM c, s), m AS (SELECT * FROM d WHERE d <= 3000 QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY d, s_suppkey) = 1)
SELECT c.c_custkey, coalesce(m.s_suppkey, -1) AS s_suppkey, round(m.d, 3) AS match_distance_m, round(s.lon, 4) AS lon_auth FROM c LEFT JOIN m USING (c_custkey) LEFT JOIN s ON s.s_suppkey = m.s_suppkey""")
def nn_left(spark, sf):
    c, s = _sides(spark, sf)
    return spatial.nearest_left(c, s, 3000.0, "c_custkey", "s_suppkey").select("c_custkey", F.coalesce("s_suppkey", F.lit(-1)).alias("s_suppkey"), F.round("match_distance_m", 3).alias("match_distance_m"), F.round("lon_auth", 4).alias("lon_auth"))


@query(f"""WITH {_CS}, d AS (SELECT c_custkey, s_suppkey, {MERC.format(a='c', b='s')} AS d FROM c, s)
SELECT c_custkey, s_suppkey, rank, round(d, 3) AS distance_m FROM (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY d, s_suppkey)::INTEGER AS rank FROM d WHERE d <= 20000) WHERE rank <= 3""")
def knn3(spark, sf):
    c, s = _sides(spark, sf)
    return spatial.nearest_join(c, s, 20000.0, "c_custkey", "s_suppkey", k=3).select("c_custkey", "s_suppkey", "rank", F.round("distance_m", 3).alias("distance_m"))


@query(f"WITH {_CS} SELECT c_custkey, s_suppkey, round({HAV.format(a='c', b='s')}, 3) AS distance_m FROM c, s WHERE {HAV.format(a='c', b='s')} <= 5000")
def radius_pairs(spark, sf):
    c, s = _sides(spark, sf)
    return spatial.radius_join(c, s, 5000.0, "c_custkey", "s_suppkey").select("c_custkey", "s_suppkey", F.round("distance_m", 3).alias("distance_m"))


@query(f"WITH {_CS} SELECT c_custkey FROM c WHERE EXISTS (SELECT 1 FROM s WHERE {MERC.format(a='c', b='s')} <= 3000)")
def exists_near(spark, sf):
    c, s = _sides(spark, sf)
    return spatial.near_semi(c, s, 3000.0, "c_custkey", "s_suppkey").select("c_custkey")


@query(f"WITH {_CS} SELECT c_custkey FROM c WHERE NOT EXISTS (SELECT 1 FROM s WHERE {MERC.format(a='c', b='s')} <= 3000)")
def nn_unmatched(spark, sf):
    c, s = _sides(spark, sf)
    return spatial.near_semi(c, s, 3000.0, "c_custkey", "s_suppkey", anti=True).select("c_custkey")


@query(f"""WITH {sql_points('customer', 'c_custkey', 'c')}, {sql_points('supplier', 's_suppkey', 's', ', s_suppkey % 4 AS n')}
SELECT c_custkey, ['cellular', 'microwave', 'lm_commercial', 'lm_private'][min(n) + 1] AS class FROM c, s WHERE {MERC.format(a='c', b='s')} <= 6000 GROUP BY c_custkey""")
def priority_nearest_class(spark, sf):
    c, s = _sides(spark, sf)
    names = ["cellular", "microwave", "lm_commercial", "lm_private"]
    return spatial.priority_class(c, [(n, s.where(F.col("s_suppkey") % 4 == i)) for i, n in enumerate(names)], 6000.0, "c_custkey", "s_suppkey")


@query(f"""WITH {_CS}, d AS (SELECT c_custkey, s_suppkey, {MERC.format(a='c', b='s')} AS d FROM c, s), k AS (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY d, s_suppkey)::INTEGER AS rank FROM d WHERE d <= 15000)
SELECT c_custkey, s_suppkey, CASE WHEN d <= 3000 THEN 'within_radius' WHEN d <= 6000 THEN 'just_outside' ELSE 'too_far' END AS reason FROM k WHERE rank <= 3""")
def near_miss_reason(spark, sf):
    c, s = _sides(spark, sf)
    return spatial.near_miss(c, s, 3000.0, "c_custkey", "s_suppkey").select("c_custkey", "s_suppkey", "reason")


def _ring(sf_nation: DataFrame) -> DataFrame:
    """A hexagon for every nation key."""
    x, y = -67.2 + F.col("n_nationkey") % 5 * 0.4, 17.95 + F.floor(F.col("n_nationkey") / 5) * 0.12
    corner = lambda dx, dy: F.struct((x + dx).alias("x"), (y + dy).alias("y"))
    shape = [(0.0, 0.05), (0.1, 0.0), (0.3, 0.01), (0.38, 0.06), (0.28, 0.11), (0.08, 0.1), (0.0, 0.05)]
    return sf_nation.select("n_nationkey", F.array(*(corner(a, b) for a, b in shape)).alias("ring"))


_EDGES = [((0.0, 0.05), (0.1, 0.0)), ((0.1, 0.0), (0.3, 0.01)), ((0.3, 0.01), (0.38, 0.06)), ((0.38, 0.06), (0.28, 0.11)), ((0.28, 0.11), (0.08, 0.1)), ((0.08, 0.1), (0.0, 0.05))]
_CROSS = " + ".join(f"(CASE WHEN ((y + {a[1]}) > lat) <> ((y + {b[1]}) > lat) AND lon < ((x + {b[0]}) - (x + {a[0]})) * (lat - (y + {a[1]})) / ((y + {b[1]}) - (y + {a[1]})) + (x + {a[0]}) THEN 1 ELSE 0 END)" for a, b in _EDGES)


@query(f"""WITH {sql_points('customer', 'c_custkey', 'c')}, n AS (SELECT n_nationkey, (-67.2 + n_nationkey % 5 * 0.4)::DOUBLE AS x, (17.95 + n_nationkey // 5 * 0.12)::DOUBLE AS y FROM nation)
SELECT c_custkey, min(n_nationkey) AS n_nationkey FROM c, n WHERE ({_CROSS}) % 2 = 1 GROUP BY c_custkey""")
def point_in_polygon(spark, sf):
    return spatial.within_join(points(read(spark, sf, "customer"), "c_custkey"), _ring(read(spark, sf, "nation")), "c_custkey", "n_nationkey")


@query(f"WITH {_CS}, n AS (SELECT count(*) AS k FROM supplier) SELECT c_custkey, s_suppkey, round({MERC.format(a='c', b='s')} / nullif({HAV.format(a='c', b='s')}, 0), 3) AS inflation FROM c CROSS JOIN n JOIN s ON s_suppkey = c_custkey % k")
def mercator_distance_vs_haversine(spark, sf):
    """Every customer with one partner out of all suppliers; keys count from 0. NULL where both are one point."""
    c, s = _sides(spark, sf)
    rows = c.crossJoin(F.broadcast(s.agg(F.count("*").alias("k")))).withColumn("s_suppkey", F.col("c_custkey") % F.col("k"))  # one row
    rows = rows.join(s.select("s_suppkey", F.col("lon").alias("x"), F.col("lat").alias("y")), "s_suppkey")
    at = [F.col(n) for n in ("lon", "lat", "x", "y")]
    return rows.select("c_custkey", "s_suppkey", F.round(geo.mercator_distance(*at) / F.nullif(geo.haversine(*at), F.lit(0.0)), 3).alias("inflation"))


@query(f"""WITH {sql_points('customer', 'c_custkey', 'c', ', c_mktsegment')}, t AS (SELECT floor((lon + 180) / 360 * 2048)::INTEGER AS tile_x, floor((1 - ln(tan(radians(lat)) + 1 / cos(radians(lat))) / pi()) / 2 * 2048)::INTEGER AS tile_y, c_mktsegment FROM c),
g AS (SELECT tile_x, tile_y, c_mktsegment, count(*) AS k FROM t GROUP BY ALL) SELECT tile_x, tile_y, sum(k)::BIGINT AS n, first(c_mktsegment ORDER BY k DESC, c_mktsegment) AS dominant FROM g GROUP BY ALL""")
def tile_cluster_dominant(spark, sf):
    rows = points(read(spark, sf, "customer"), "c_custkey", "c_mktsegment")
    return quality.cluster_tiles(rows, *geo.tile(F.col("lon"), F.col("lat"), 11), "c_mktsegment")


# -- entity resolution --------------------------------------------------------------------------------------------------


@query(f"""WITH RECURSIVE {sql_points('supplier', 's_suppkey', 'p', ', s_acctbal')}, o AS (SELECT *, row_number() OVER (ORDER BY s_acctbal DESC, s_suppkey) AS r FROM p),
near AS (SELECT a.r AS ra, list(b.r) AS better FROM o a, o b WHERE b.r < a.r AND {HAV.format(a='a', b='b')} <= 8000 GROUP BY a.r),
step(r, kept) AS (SELECT 0::BIGINT, []::BIGINT[] UNION ALL SELECT step.r + 1, CASE WHEN len(list_intersect(step.kept, coalesce(n.better, []::BIGINT[]))) = 0 THEN list_append(step.kept, step.r + 1) ELSE step.kept END FROM step LEFT JOIN near n ON n.ra = step.r + 1 WHERE step.r < (SELECT count(*) FROM o))
SELECT s_suppkey FROM o WHERE r IN (SELECT unnest(kept) FROM (SELECT kept FROM step ORDER BY r DESC LIMIT 1))""")
def near_duplicate_greedy(spark, sf):
    rows = points(read(spark, sf, "supplier"), "s_suppkey", "s_acctbal")
    return resolve.suppress_near(rows, "s_suppkey", "s_acctbal", 8000.0).select("s_suppkey")


@query("""WITH p AS (SELECT c_custkey, c_acctbal AS s, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_name END AS nm, (c_custkey % 97)::DOUBLE / 10 AS lon, (c_custkey % 89)::DOUBLE / 10 AS lat FROM customer)
SELECT arg_min(c_custkey, (-s, c_custkey)) AS c_custkey, first(nm ORDER BY s DESC, c_custkey) FILTER (nm IS NOT NULL) AS nm, max(s) AS s, lon, lat FROM p GROUP BY lon, lat""")
def exact_coord_dedup(spark, sf):
    key = F.col("c_custkey")
    rows = read(spark, sf, "customer").select("c_custkey", F.when(key % 3 != 0, F.col("c_name")).alias("nm"), F.col("c_acctbal").alias("s"), ((key % 97).cast("double") / 10).alias("lon"), ((key % 89).cast("double") / 10).alias("lat"))
    return resolve.dedup_coordinates(rows, "c_custkey", "s")


@query("SELECT o_custkey, count(*) + 1 AS campus_feature_count, CASE WHEN bool_or(o_orderstatus = 'O') THEN 'yes' END AS emergency, nullif(sum(o_orderkey % 7), 0)::BIGINT::VARCHAR AS beds, first(o_orderpriority ORDER BY o_orderkey) AS operator, array_to_string(list_distinct_in_order, '|') AS speciality FROM (SELECT *, list(o_orderstatus ORDER BY o_orderkey) OVER (PARTITION BY o_custkey) AS l, list_filter(l, lambda x, i: list_position(l, x) = i) AS list_distinct_in_order FROM orders) GROUP BY o_custkey, list_distinct_in_order")
def campus_agg(spark, sf):
    o = read(spark, sf, "orders")
    members = o.select("o_custkey", F.col("o_orderkey").alias("ordinal"), F.when(F.col("o_orderstatus") == "O", "yes").alias("emergency"), (F.col("o_orderkey") % 7).cast("string").alias("beds"), F.col("o_orderpriority").alias("operator"), F.col("o_orderstatus").alias("speciality"))
    out = resolve.conflate_campus(members, o.select("o_custkey").distinct(), "o_custkey")
    return out.select("o_custkey", "campus_feature_count", "emergency", "beds", "operator", "speciality")


@query("""WITH l AS (SELECT l_suppkey, l_partkey, l_quantity AS score, l_linenumber::BIGINT AS bed_cnt, l_discount AS d, CASE WHEN l_returnflag = 'R' THEN 'spatial' ELSE 'name' END AS m FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_suppkey, l_partkey ORDER BY l_quantity DESC, l_discount, l_linenumber, l_orderkey) = 1)
SELECT l_suppkey, max(score) AS score, min(d) AS metres, CASE WHEN bool_or(m = 'spatial') THEN 'spatial' ELSE 'name' END AS method FROM l GROUP BY l_suppkey""")
def provider_dedup_sum(spark, sf):
    rows = read(spark, sf, "lineitem").select("l_suppkey", "l_partkey", F.col("l_quantity").alias("score"), F.struct("l_discount", "l_linenumber", "l_orderkey").alias("metres"), F.when(F.col("l_returnflag") == "R", "spatial").otherwise("name").alias("method"))
    out = resolve.aggregate_providers(rows, "l_suppkey", "l_partkey", "score", "method", "metres")
    return out.select("l_suppkey", "score", F.col("metres.l_discount").alias("metres"), "method")


@query("SELECT l_suppkey, arg_max(l_partkey, (l_extendedprice, -l_partkey)) AS l_partkey, max(l_extendedprice) AS l_extendedprice FROM lineitem GROUP BY l_suppkey")
def keep_highest(spark, sf):
    rows = read(spark, sf, "lineitem").select("l_suppkey", "l_partkey", "l_extendedprice")
    return resolve.keep_highest(rows, "l_suppkey", "l_extendedprice", "l_partkey")


@query("SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE coalesce(p, '') END AS segment FROM customer LEFT JOIN (SELECT o_custkey, max(o_orderpriority) AS p FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey")
def enrich_if_empty(spark, sf):
    left = read(spark, sf, "customer").select(F.col("c_custkey"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).otherwise("").alias("segment"))
    right = read(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderpriority").alias("segment"))
    return resolve.enrich_if_empty(left, right, "c_custkey", ["segment"], ["segment"])


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'osm' WHEN c_custkey % 3 = 1 THEN 'osm+epa_frs' ELSE 'epa_frs' END AS p FROM customer")
def provenance(spark, sf):
    k = F.col("c_custkey")
    start = F.when(k % 3 == 0, "osm").when(k % 3 == 1, "osm+epa_frs").otherwise("nan")
    added = F.when(k % 3 == 0, start).otherwise(resolve.add_provenance(start, "epa_frs"))
    return read(spark, sf, "customer").select("c_custkey", added.alias("p"))


# -- names and fuzzy joins ----------------------------------------------------------------------------------------------

def normalize_name(spark, sf):
    """Whole texts of all rows. DuckDB has no NFKD (it folds a sharp s, NFKD drops it), hence no SQL here: see normalize_name_rules, and the tests."""
    return read(spark, sf, "documents").select("doc_id", text.normalize_name(F.col("text")).alias("name"))


WITHOUT_SQL["normalize_name"] = normalize_name


_FORMS = ("St. {0} Hosp. & Medical Center, Inc", "Hospital de la {0}", "{0} HealthCare", "The {0} Univ Med Ctr Hospital", "{0} Hospital and Medical Center", "Centro del {0}  Health System", "Hospital {0} Hospital")
_STEPS = ["^hospital ", "( hospital and medical center| hospital and medical centre| hospital)$", "( healthcare| health care| health system| health sciences| health science)$"]
_RULED = "array_to_string(list_transform(list_filter(string_split(regexp_replace(x, ' inc$', ''), ' '), lambda w: w NOT IN ('', 'de', 'del', 'la', 'el', 'los', 'las')), lambda w: CASE w WHEN 'ctr' THEN 'center' WHEN 'med' THEN 'medical' WHEN 'univ' THEN 'university' WHEN 'dept' THEN 'department' WHEN 'st' THEN 'saint' WHEN 'hosp' THEN 'hospital' WHEN 'mun' THEN 'municipal' WHEN 'munic' THEN 'municipal' ELSE w END), ' ')"
for _step in _STEPS:
    _RULED = f"regexp_replace({_RULED}, '{_step}', '')"


@query(f"""WITH t AS (SELECT p_partkey, replace([{", ".join(f"'{x}'" for x in _FORMS)}][p_partkey % {len(_FORMS)} + 1], '{{0}}', p_name) AS raw FROM part), a AS (SELECT p_partkey, trim(regexp_replace(regexp_replace(lower(raw), '[^a-z0-9 ]', ' ', 'g'), ' +', ' ', 'g')) AS x FROM t)
SELECT p_partkey, trim({_RULED}) AS name FROM a""")
def normalize_name_rules(spark, sf):
    """All steps but the folding, on names of many shapes."""
    shape = F.element_at(F.array(*map(F.lit, _FORMS)), (F.col("p_partkey") % len(_FORMS) + 1).cast("int"))
    return read(spark, sf, "part").select("p_partkey", text.normalize_name(F.replace(shape, F.lit("{0}"), F.col("p_name"))).alias("name"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN '' ELSE lpad((c_custkey % 99999)::VARCHAR, 5, '0') END AS zip FROM customer")
def normalize_zip(spark, sf):
    k = F.col("c_custkey")
    raw = F.when(k % 5 == 0, "").when(k % 5 == 1, F.concat((k % 99999).cast("string"), F.lit("-1234"))).otherwise((k % 99999).cast("string"))
    return read(spark, sf, "customer").select("c_custkey", text.normalize_zip(raw).alias("zip"))


@query("SELECT c_custkey, (c_custkey % 900 + 100)::VARCHAR AS number, 'Calle ' || c_mktsegment AS street, CASE WHEN c_custkey % 2 = 0 THEN (c_custkey % 900 + 100)::VARCHAR ELSE (c_custkey % 90 + 10)::VARCHAR END AS house FROM customer")
def address_split(spark, sf):
    k = F.col("c_custkey")
    parsed = text.parse_address(F.concat((k % 900 + 100).cast("string"), F.lit(" Calle "), "c_mktsegment"))
    provider = F.when(k % 2 == 0, F.concat((k % 900 + 100).cast("string"), F.lit(" AVE X"))).otherwise(F.concat(F.lit("Carr. "), (k % 90 + 10).cast("string"), F.lit(" KM 3")))
    return read(spark, sf, "customer").select("c_custkey", parsed["number"].alias("number"), parsed["street"].alias("street"), text.provider_house_number(provider).alias("house"))


@query("""WITH n AS (SELECT DISTINCT p_brand, p_name FROM part)
SELECT a.p_brand, a.p_name AS a, b.p_name AS b, round(jaro_winkler_similarity(a.p_name, b.p_name), 4) AS score FROM n a JOIN n b USING (p_brand) WHERE a.p_name < b.p_name AND jaro_winkler_similarity(a.p_name, b.p_name) >= 0.75""")
def jw_block_join(spark, sf):
    names = read(spark, sf, "part").select("p_brand", "p_name").distinct()
    pairs = names.withColumnRenamed("p_name", "a").join(names.withColumnRenamed("p_name", "b"), "p_brand").where("a < b")
    return pairs.withColumn("score", text.jaro_winkler("a", "b")).where("score >= 0.75").select("p_brand", "a", "b", F.round("score", 4).alias("score"))


_LCS = """names AS (SELECT DISTINCT p_brand, p_name, array_to_string(list_sort(string_split(p_name, ' ')), ' ') AS s FROM part),
prs AS (SELECT DISTINCT a.s AS a, b.s AS b FROM names a JOIN names b USING (p_brand) WHERE a.p_name < b.p_name),
dp(a, b, i, row) AS (SELECT a, b, 0, list_transform(range(length(b) + 1), lambda x: 0::BIGINT) FROM prs
UNION ALL SELECT a, b, i + 1, list_reduce(range(1, length(b) + 1), lambda acc, j: list_append(acc, CASE WHEN substr(a, i + 1, 1) = substr(b, j, 1) THEN row[j] + 1 ELSE greatest(row[j + 1], acc[j]) END), [0::BIGINT]) FROM dp WHERE i < length(a)),
sc AS (SELECT a, b, 200.0 * row[length(b) + 1] / (length(a) + length(b)) AS ratio FROM dp WHERE i = length(a))"""


@query(f"WITH RECURSIVE {_LCS} SELECT x.p_brand, x.p_name AS a, y.p_name AS b, round(ratio, 4) AS score FROM names x JOIN names y ON x.p_brand = y.p_brand AND x.p_name < y.p_name JOIN sc ON sc.a = x.s AND sc.b = y.s WHERE ratio >= 60")
def token_sort_block(spark, sf):
    names = read(spark, sf, "part").select("p_brand", "p_name").distinct()
    pairs = names.withColumnRenamed("p_name", "a").join(names.withColumnRenamed("p_name", "b"), "p_brand").where("a < b")
    scored = pairs.select("a", "b").distinct().withColumn("score", text.token_sort_ratio("a", "b")).where("score >= 60")
    return pairs.join(scored, ["a", "b"]).select("p_brand", "a", "b", F.round("score", 4).alias("score"))


@query("""WITH n AS (SELECT DISTINCT p_brand, p_name, list_distinct(string_split(p_name, ' ')) AS t FROM part)
SELECT a.p_brand, a.p_name AS a, b.p_name AS b FROM n a JOIN n b USING (p_brand) WHERE a.p_name < b.p_name AND (len(list_intersect(a.t, b.t)) = len(a.t) OR len(list_intersect(a.t, b.t)) = len(b.t))""")
def token_set_subset(spark, sf):
    names = read(spark, sf, "part").select("p_brand", "p_name").distinct()
    pairs = names.withColumnRenamed("p_name", "a").join(names.withColumnRenamed("p_name", "b"), "p_brand").where("a < b")
    return pairs.withColumn("score", text.token_set_ratio("a", "b")).where("score >= 99.9999").select("p_brand", "a", "b")


@query("""WITH a AS (SELECT p_partkey AS id, p_brand AS b, (p_size % 5)::VARCHAR AS n, lower(p_name) AS s FROM part), q AS (SELECT id AS q, b, n, substr(s, 1, (id % length(s))::BIGINT) || substr(s, (id % length(s))::BIGINT + 2) AS s FROM a)
SELECT q, id, round(jaro_winkler_similarity(q.s, a.s), 4) AS score FROM q JOIN a USING (b, n) WHERE jaro_winkler_similarity(q.s, a.s) >= 0.8 QUALIFY row_number() OVER (PARTITION BY q ORDER BY jaro_winkler_similarity(q.s, a.s) DESC, id) = 1""")
def geocode_top1(spark, sf):
    """Every part is a query: its whole street without one letter, whose place the key gives."""
    p = read(spark, sf, "part")
    base = p.select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("state_code"), F.lit("00000").alias("postcode"), (F.col("p_size") % 5).cast("string").alias("number"), F.col("p_name").alias("street"), lon("p_partkey").alias("lon"), lat("p_partkey").alias("lat"))
    at = (F.col("id") % F.length("street")).cast("int")
    street = F.concat(F.substring(F.col("street"), F.lit(1), at), F.substring(F.col("street"), at + 2, F.length("street")))
    q = base.select(F.col("id").alias("q"), "state_code", "postcode", "number", street.alias("street"))
    return fuzzy.geocode(base, q, "q").select("q", "id", F.round("score", 4).alias("score"))


@query("""WITH s AS (SELECT 'Brand#' || (s_suppkey % 5 + 1) || (s_nationkey % 4 + 1) AS b, s_suppkey % 37 + 1 AS z FROM supplier)
SELECT p_partkey AS provider_id, CASE WHEN p_partkey % 7 = 0 THEN 'no_name' WHEN p_size % 5 = 0 THEN 'missing_address' WHEN p_brand NOT IN (SELECT b FROM s) THEN 'no_silver_in_state' WHEN (p_brand, p_size) NOT IN (SELECT (b, z) FROM s) THEN 'no_zip_city_overlap' ELSE 'name_below_threshold' END AS reason FROM part""")
def match_failure_reason(spark, sf):
    """Every part is a provider, every supplier a place."""
    providers = read(spark, sf, "part").select(F.col("p_partkey").alias("provider_id"), F.col("p_brand").alias("state"), F.when(F.col("p_size") % 5 == 0, "").otherwise(F.col("p_size").cast("string")).alias("zip5"), F.lit("").alias("city"), F.when(F.col("p_partkey") % 7 == 0, "nan").otherwise(F.col("p_name")).alias("name"))
    state = F.concat(F.lit("Brand#"), (F.col("s_suppkey") % 5 + 1).cast("string"), (F.col("s_nationkey") % 4 + 1).cast("string"))
    places = read(spark, sf, "supplier").select(state.alias("state"), (F.col("s_suppkey") % 37 + 1).cast("string").alias("zip5"), F.lit("").alias("city"))
    return fuzzy.failure_reason(places, providers, providers.limit(0), "provider_id")


@query("SELECT p_partkey, coalesce(s_suppkey, -1) AS place_id, CASE WHEN s_suppkey IS NULL THEN 'unmatched' ELSE 'zip' END AS method FROM part LEFT JOIN (SELECT l_partkey, arg_max(l_suppkey, (l_quantity, -l_suppkey)) AS s_suppkey FROM lineitem WHERE l_quantity > 40 GROUP BY l_partkey) ON l_partkey = p_partkey")
def match_state_audit(spark, sf):
    matches = read(spark, sf, "lineitem").where("l_quantity > 40").select(F.col("l_partkey").alias("provider_id"), F.col("l_suppkey").alias("place_id"), F.col("l_quantity").alias("score"), F.lit("zip").alias("method"))
    out = conflation.match_state(read(spark, sf, "part").select(F.col("p_partkey").alias("provider_id")), matches)
    return out.select(F.col("provider_id").alias("p_partkey"), F.coalesce("place_id", F.lit(-1)).alias("place_id"), "method")


# -- scores and codes ---------------------------------------------------------------------------------------------------

_UNITS = "greatest(0, 4000 - 8 * coalesce(d, 500)) + CASE WHEN a THEN 2000 ELSE 0 END + CASE WHEN b THEN 2000 ELSE 0 END + CASE c_custkey % 3 WHEN 0 THEN 2000 WHEN 1 THEN 1000 ELSE 500 END"


@query(f"WITH t AS (SELECT c_custkey, CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_custkey % 601 END AS d, c_custkey % 2 = 0 AS a, c_custkey % 5 < 3 AS b FROM customer), s AS (SELECT c_custkey, {_UNITS} AS v FROM t) SELECT c_custkey, v / 10000.0::DOUBLE AS score, CASE WHEN v >= 7500 THEN 'high' WHEN v >= 4000 THEN 'medium' ELSE 'low' END AS tier FROM s")
def confidence_score(spark, sf):
    """All rows, those at a tier's edge too. Every score is a multiple of 0.0001: rounded to that, it meets an edge exactly."""
    k = F.col("c_custkey")
    metres = F.when(k % 11 != 0, k % 601)
    given = lambda c: F.when(c, "x")
    v = score.composite(score.distance_score(metres), score.attribute_score([(given(k % 2 == 0), F.lit("y")), (given(k % 5 < 3), F.lit("y"))]), score.source_score(k % 3 != 1, k % 3 != 2))
    rows = read(spark, sf, "customer").select("c_custkey", F.round(v, 4).alias("score"))
    return rows.select("c_custkey", "score", score.tier(F.col("score")).alias("tier"))


CODES = [("naics", f"{c}", c % 3 + 1, f"key{c}") for c in range(0, 40, 3)] + [("sic", f"{c}", c % 3 + 1, f"sic{c}") for c in range(1, 40, 4)]


@query("""WITH p AS (SELECT p_partkey, [(p_partkey % 41)::VARCHAR, (p_partkey % 17)::VARCHAR] AS n, [(p_size % 40)::VARCHAR] AS s FROM part),
u AS (SELECT p_partkey, 'naics' AS system, 0 AS src, unnest(n) AS code, generate_subscripts(n, 1) AS pos FROM p UNION ALL SELECT p_partkey, 'sic', 1, unnest(s), generate_subscripts(s, 1) FROM p),
c AS (SELECT 'naics' AS system, x::VARCHAR AS code, x % 3 + 1 AS level, 'key' || x AS lifeline_key FROM range(0, 40, 3) t(x) UNION ALL SELECT 'sic', x::VARCHAR, x % 3 + 1, 'sic' || x FROM range(1, 40, 4) t(x))
SELECT p_partkey, lifeline_key, level::INTEGER AS level, round(least(1.0, 0.8 + CASE level WHEN 1 THEN 0.25 WHEN 2 THEN 0.15 ELSE 0.05 END), 4)::DOUBLE AS boosted FROM u JOIN c USING (system, code) QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY level, src, pos) = 1""")
def code_lookup_best_tier(spark, sf):
    dim = spark.createDataFrame(CODES, "system string, code string, level int, lifeline_key string")
    k = F.col("p_partkey")
    rows = read(spark, sf, "part").select("p_partkey", F.concat((k % 41).cast("string"), F.lit(" | "), (k % 17).cast("string")).alias("naics"), (F.col("p_size") % 40).cast("string").alias("sic"))
    best = score.best_code(rows, "p_partkey", "naics", "sic", dim)
    return best.select("p_partkey", "lifeline_key", "level", F.round(score.boosted(F.lit(0.8), score.boost(F.col("level"))), 4).alias("boosted"))


@query("SELECT p_partkey FROM part WHERE p_partkey % 41 IN (3, 8) OR p_partkey % 17 IN (3, 8)")
def codes_overlap(spark, sf):
    k = F.col("p_partkey")
    rows = read(spark, sf, "part").withColumn("codes", F.concat((k % 41).cast("string"), F.lit(","), (k % 17).cast("string")))
    return rows.where(score.codes_overlap(F.col("codes"), ["3", "8"])).select("p_partkey")


@query("SELECT p_partkey, CASE WHEN p_size < 10 OR regexp_matches(p_name, '(?i)\\b(distribution|warehouse)\\b') THEN 'warehouse_distribution' ELSE 'retail_store' END AS subtype FROM part")
def facility_subtype(spark, sf):
    return read(spark, sf, "part").select("p_partkey", score.facility_subtype(F.when(F.col("p_size") < 10, "493110"), ["493110"], F.lit(False), F.col("p_name")).alias("subtype"))


# -- gold and quality ---------------------------------------------------------------------------------------------------


@query("SELECT c_custkey, c_name, n_name, r_name, coalesce(n, 0) AS n_orders FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey")
def wide_join(spark, sf):
    orders = read(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"), F.lit("ignored").alias("c_name"))
    place = read(spark, sf, "nation").join(read(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "r_name")
    base = read(spark, sf, "customer").join(place, "c_nationkey").withColumn("tmp_x", F.lit(1))
    return conflation.wide(base, orders, key="c_custkey").select("c_custkey", "c_name", "n_name", "r_name", F.coalesce("n", F.lit(0)).alias("n_orders"))


@query("SELECT c_custkey::VARCHAR AS id, c_name AS name, NULL::VARCHAR AS telephone, NULL::BIGINT AS beds FROM customer")
def strict_projection(spark, sf):
    return conflation.strict(read(spark, sf, "customer"), {"id": (F.col("c_custkey"), "string"), "name": (F.col("c_name"), "string"), "telephone": (None, "string"), "beds": (None, "long")})


@query("SELECT o_orderstatus, o_orderpriority, count(*) AS n, round(avg(o_totalprice), 3) AS mean FROM orders GROUP BY ALL")
def qa_summary(spark, sf):
    return quality.summary(read(spark, sf, "orders"), "o_orderstatus", "o_orderpriority", score="o_totalprice")


@query("WITH g AS (SELECT o_orderstatus, o_totalprice > 100000 AS flag, count(*) AS n FROM orders GROUP BY ALL) SELECT *, round(100.0 * n / sum(n) OVER (PARTITION BY o_orderstatus), 1)::DOUBLE AS pct FROM g")
def qa_pct_of_group(spark, sf):
    return quality.percent_of_group(read(spark, sf, "orders"), "o_orderstatus", F.col("o_totalprice") > 100000)


@query("SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS F_n, coalesce(round(avg(o_totalprice) FILTER (o_orderstatus = 'F'), 3), 0) AS F_mean, count(*) FILTER (o_orderstatus = 'O') AS O_n, coalesce(round(avg(o_totalprice) FILTER (o_orderstatus = 'O'), 3), 0) AS O_mean FROM orders GROUP BY ALL")
def qa_pivot(spark, sf):
    return quality.pivot_counts(read(spark, sf, "orders"), "o_orderpriority", "o_orderstatus", ["F", "O"], "o_totalprice")


@query("""WITH t AS (SELECT l_returnflag, nullif(l_linestatus, 'O') AS a, CASE WHEN l_quantity > 25 THEN l_quantity END AS b FROM lineitem)
SELECT l_returnflag, 'a' AS "column", count(*) FILTER (a IS NULL) AS nulls, round(100.0 * count(*) FILTER (a IS NULL) / count(*), 1)::DOUBLE AS pct FROM t GROUP BY ALL UNION ALL SELECT l_returnflag, 'b', count(*) FILTER (b IS NULL), round(100.0 * count(*) FILTER (b IS NULL) / count(*), 1)::DOUBLE FROM t GROUP BY ALL""")
def qa_null_counts(spark, sf):
    rows = read(spark, sf, "lineitem").select("l_returnflag", F.nullif("l_linestatus", F.lit("O")).alias("a"), F.when(F.col("l_quantity") > 25, F.col("l_quantity").cast("string")).alias("b"))
    return quality.null_counts(rows, "l_returnflag", ["a", "b"])


@query("SELECT CASE WHEN user_id % 5 = 0 THEN NULL ELSE event_type END AS g, count(*) AS n, round(100.0 * count(*) FILTER (value > 50) / count(*), 1)::DOUBLE AS v_pct FROM events GROUP BY ALL")
def qa_fill_rates(spark, sf):
    rows = read(spark, sf, "events").select(F.when(F.col("user_id") % 5 != 0, F.col("event_type")).alias("g"), F.when(F.col("value") > 50, F.col("value")).alias("v"))
    return quality.fill_rates(rows, "g", ["v"])


@query("SELECT floor(l_discount / 0.03)::BIGINT AS bin, count(*) AS n FROM lineitem GROUP BY ALL")
def qa_histogram(spark, sf):
    return quality.histogram(read(spark, sf, "lineitem"), "l_discount", 0.03)


@query("SELECT event_type, count(*) AS n FROM events WHERE event_type IS NOT NULL GROUP BY ALL")
def qa_value_counts(spark, sf):
    return quality.value_counts(read(spark, sf, "events"), "event_type")


@query(f"WITH {sql_points('customer', 'c_custkey', 'c')} SELECT round(min(lon), 4) AS xmin, round(min(lat), 4) AS ymin, round(max(lon), 4) AS xmax, round(max(lat), 4) AS ymax FROM c")
def qa_extent(spark, sf):
    rows = points(read(spark, sf, "customer"), "c_custkey")
    return rows.agg(*(F.round(f(c), 4).alias(n) for n, f, c in (("xmin", F.min, "lon"), ("ymin", F.min, "lat"), ("xmax", F.max, "lon"), ("ymax", F.max, "lat"))))


@query("SELECT event_type, count(DISTINCT user_id) AS users FROM events GROUP BY ALL")
def qa_nunique(spark, sf):
    return read(spark, sf, "events").groupBy("event_type").agg(F.countDistinct("user_id").alias("users"))


@query("SELECT o_custkey, count(*) AS n FROM orders GROUP BY ALL HAVING count(*) > 1")
def qa_duplicate_ids(spark, sf):
    return quality.duplicate_keys(read(spark, sf, "orders"), "o_custkey")


@query("SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders")
def qa_coverage_except(spark, sf):
    return quality.dropped_keys(read(spark, sf, "customer"), read(spark, sf, "orders").withColumnRenamed("o_custkey", "c_custkey"), "c_custkey")


@query("SELECT count(DISTINCT c_custkey) AS n_source, count(DISTINCT c_custkey) FILTER (c_custkey IN (SELECT o_custkey FROM orders)) AS n_kept, round(100.0 * n_kept / n_source, 1)::DOUBLE AS pct FROM customer")
def qa_coverage(spark, sf):
    return quality.coverage(read(spark, sf, "customer"), read(spark, sf, "orders").withColumnRenamed("o_custkey", "c_custkey"), "c_custkey")


@query("SELECT count(*) FILTER (l_returnflag = 'R' AND NOT l_linestatus = 'F') AS broken FROM lineitem")
def qa_rule_implies(spark, sf):
    return quality.implies(read(spark, sf, "lineitem"), F.col("l_returnflag") == "R", F.col("l_linestatus") == "F")


@query("SELECT c_custkey FROM customer WHERE c_custkey % 4 = 0 AND c_custkey IN (SELECT o_custkey FROM orders)")
def qa_gaps(spark, sf):
    rows = read(spark, sf, "customer").select("c_custkey", F.when(F.col("c_custkey") % 4 != 0, F.col("c_name")).alias("beds"))
    return quality.gaps(rows, read(spark, sf, "orders").withColumnRenamed("o_custkey", "c_custkey"), "c_custkey", "beds")


@query("SELECT c_custkey AS key, c_name AS name, NULL::VARCHAR AS brand FROM customer UNION ALL SELECT p_partkey, p_name, p_brand FROM part")
def union_by_name(spark, sf):
    a = read(spark, sf, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"))
    return resolve.append(a, read(spark, sf, "part").select(F.col("p_brand").alias("brand"), F.col("p_partkey").alias("key"), F.col("p_name").alias("name"))).select("key", "name", "brand")


@query("""WITH p AS (SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'epa_frs' WHEN 1 THEN 'epa+osm' END AS prov, CASE p_partkey % 5 WHEN 0 THEN 445110 WHEN 1 THEN 493120 WHEN 2 THEN 1 ELSE 2 END::VARCHAR AS n, p_partkey % 7 = 0 AS s FROM part)
SELECT p_partkey, CASE WHEN n = '493120' OR s THEN 'warehouse_distribution' ELSE 'retail_store' END AS subtype FROM p WHERE prov IS NOT NULL AND (n IN ('445110', '493120') OR s)""")
def gold_food(spark, sf):
    k = F.col("p_partkey")
    code = F.when(k % 5 == 0, "1 | 445110").when(k % 5 == 1, "493120").when(k % 5 == 2, "1").otherwise("2")
    rows = read(spark, sf, "part").select("p_partkey", k.cast("string").alias("lifeline_id"), F.lit("x").alias("display_name"), F.when(k % 3 == 0, "epa_frs").when(k % 3 == 1, "epa+osm").alias("source_provenance"), code.alias("naics_codes"), F.when(k % 7 == 0, "5411,9").alias("sic_codes"))
    return gold.food_table(rows, ["445110", "493120"], ["493120"], ["5411"]).select("p_partkey", F.col("food_facility_subtype").alias("subtype"))


@query(f"""WITH {_CS}, d AS (SELECT s_suppkey, c_custkey, {MERC.format(a='s', b='c')} AS d FROM c, s), m AS (SELECT * FROM d WHERE d <= 2000 QUALIFY row_number() OVER (PARTITION BY s_suppkey ORDER BY d, c_custkey) = 1)
SELECT s.s_suppkey, coalesce(c_custkey, -1) AS osm, CASE WHEN c_custkey IS NULL THEN 0.85 ELSE 1.0 END::DOUBLE AS score FROM s LEFT JOIN m USING (s_suppkey)""")
def gold_authority(spark, sf):
    c, s = _sides(spark, sf)
    out = gold.authority_layer(s, c.withColumnRenamed("c_custkey", "lifeline_id"), "ports", "s_suppkey", None, "ports", 2000.0)
    return out.select("s_suppkey", F.coalesce("osm_lifeline_id", F.lit(-1)).alias("osm"), F.col("confidence_score").alias("score"))


@query("SELECT c_custkey::VARCHAR AS ID, c_name AS NAME, CASE WHEN c_custkey % 2 = 0 AND c_custkey % 50 > 0 THEN c_custkey % 50 ELSE 7 END AS BEDS, CASE WHEN c_custkey % 3 = 0 THEN 'I' ELSE 'II' END AS TRAUMA, 'USA' AS COUNTRY, 32 AS columns FROM customer")
def gold_hospital_table(spark, sf):
    """All rows: a provider's count of 0 gives way to the tag."""
    k = F.col("c_custkey")
    rows = read(spark, sf, "customer").select(k.cast("string").alias("lifeline_id"), F.col("c_name").alias("display_name"), F.when(k % 2 == 0, k % 50).otherwise(0).alias("cms_bed_cnt"), F.lit("7").alias("beds"), F.when(k % 3 == 0, "I").otherwise(" ").alias("acs_trauma_level"), F.lit("II").alias("hifld_trauma"))
    out = gold.hospital_table(rows)
    return out.select("ID", "NAME", "BEDS", "TRAUMA", "COUNTRY", F.lit(len(out.columns)).alias("columns"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 7 = 0 THEN 'foreign' WHEN p_partkey % 5 = 0 THEN 'bad_address' WHEN p_partkey % 11 = 0 THEN 'error' WHEN p_size < 10 THEN 'no_match' WHEN p_size < 40 THEN 'score_reject' ELSE 'ok' END AS status FROM part")
def geocode_status(spark, sf):
    k = F.col("p_partkey")
    status = fuzzy.geocode_status(F.when(k % 7 == 0, "DE").otherwise("PR"), F.when(k % 5 == 0, "").otherwise("1"), F.lit("00731"), F.when(k % 11 == 0, "timeout"), F.when(F.col("p_size") >= 10, F.col("p_size") / 50.0))
    return read(spark, sf, "part").select("p_partkey", status.alias("status"))


@query(f"WITH {_CS}, e AS (SELECT c_custkey, s_suppkey, {HAV.format(a='c', b='s')} AS d, c.lon AS x, s.lon AS y FROM c JOIN s ON c_custkey % 10 = s_suppkey) SELECT c_custkey, round(CASE WHEN d <= 20000 THEN y ELSE x END, 4) AS lon FROM e")
def displacement_split(spark, sf):
    c, s = _sides(spark, sf)
    rows = c.join(s.select("s_suppkey", F.col("lon").alias("x"), F.col("lat").alias("y")), c["c_custkey"] % 10 == F.col("s_suppkey"))
    at = resolve.displaced(F.col("lon"), F.col("lat"), F.col("x"), F.col("y"), 20000.0)[0]
    return rows.select("c_custkey", F.round(at, 4).alias("lon"))


@query("SELECT time_bucket(INTERVAL 10 MINUTE, ts) AS start, event_type, count(*) AS n FROM events GROUP BY ALL")
def event_windows(spark, sf):
    from poiforge.streaming import events

    return events.windowed_counts(read(spark, sf, "events")).select("start", "event_type", "n")


from poiforge import queries_linkage, queries_products  # noqa: E402, F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, (f, _) in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in QUERIES.items() if sql}
