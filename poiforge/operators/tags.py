"""Tag-map layers: predicates, projections and rule matching over a table (kind, type, id, tags MAP<STRING, STRING>, lon, lat, ring).

Predicates keep SQL's three-valued logic: a feature whose predicate is NULL is dropped. So practically every unnamed transportation
feature without the excluded tag goes, and so do unnamed health features without amenity and healthcare.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poiforge.functions import geo

# Tag values that make a feature part of a layer, and the tags that a layer projects.
WATER_WORKS = ("water_works", "wastewater_plant", "pumping_station", "water_tower", "water_tap", "reservoir_covered", "storage_tank", "water_well", "desalination_plant")
WATER_AREAS = ("water_works", "wastewater_plant", "reservoir_covered", "storage_tank", "desalination_plant")
TELECOM_STRUCTURES = ("mast", "antenna", "telephone_exchange", "communications_tower")
TOWER_TYPES = ("communication", "radio", "radar", "lighting", "monitoring")
FUEL_INDUSTRY = ("fuel", "oil", "oil_storage", "refinery", "oil_refinery", "gas", "lpg_storage", "fuel_terminal", "petroleum")
FUEL_CONTENT = ("fuel", "oil", "gasoline", "diesel", "petroleum", "gas", "natural_gas", "lpg", "lng", "jet_fuel", "kerosene", "naphtha")
SAFETY_AMENITIES = ("police", "fire_station", "ambulance_station")
EMERGENCY = ("ambulance_station", "fire_station", "police", "disaster_response", "ses_station", "water_rescue", "coast_guard", "lifeguard_base", "mountain_rescue")
HEALTH_AMENITIES = ("hospital", "clinic", "pharmacy", "nursing_home", "doctors", "dentist", "blood_bank", "social_facility", "veterinary", "dialysis")
SOCIAL_FACILITIES = ("nursing_home", "assisted_living", "group_home", "medical_care", "hospice", "rehabilitation")
RAILWAY = ("station", "halt", "yard", "junction", "facility", "tram_stop", "subway_entrance", "workshop")
AEROWAY = ("aerodrome", "terminal", "helipad", "heliport", "navigationaid")
SCHOOL_AMENITIES = ("school", "university", "college", "kindergarten")
SCHOOL_BUILDINGS = ("school", "university", "college")
_ADDRESS = ("addr:street", "addr:housenumber", "addr:city", "addr:state", "addr:postcode")
_END = ("start_date", "wikipedia", "wikidata", "access")
_WHO = ("operator", "operator:wikidata", "name", "ref")


def t(key: str) -> Column:
    return F.col("tags")[key]


def _area(*extra: Column) -> Column:
    out = (F.col("type") == "relation") | (t("area") == "yes")
    for e in extra:
        out = out | e
    return (F.col("kind") == "area") & out


def _power() -> Column:
    line = (F.col("kind") == "line") & (t("area").isNull() | (t("area") != "yes"))
    return t("power").isNotNull() & ((F.col("kind") == "node") | line | _area(t("power").isin("substation", "plant", "generator")))


def _water() -> Column:
    what = t("man_made").isin(*WATER_WORKS) | t("landuse").isin("reservoir", "basin") | t("amenity").isin("drinking_water")
    return what & ((F.col("kind") == "node") | _area(t("man_made").isin(*WATER_AREAS)) | ((F.col("kind") == "line") & t("man_made").isin("pipeline")))


def _telecom() -> Column:
    tower = (t("man_made") == "tower") & t("tower:type").isin(*TOWER_TYPES)
    what = t("telecom").isNotNull() | t("man_made").isin(*TELECOM_STRUCTURES) | tower | t("tower:type").isin("communication", "radio", "radar") | (t("amenity") == "telephone")
    return what & ((F.col("kind") == "node") | _area(t("telecom").isin("exchange", "data_center", "service_node")) | ((F.col("kind") == "line") & t("telecom").isin("cable", "line")))


def _fuel() -> Column:
    depot = (t("landuse") == "depot") & t("content").isin("fuel", "oil", "petroleum")
    tank = (t("man_made") == "storage_tank") & t("content").isin(*FUEL_CONTENT)
    what = t("industrial").isin(*FUEL_INDUSTRY) | t("man_made").isin("petroleum_well", "oil_well", "gas_well") | tank | t("pipeline").isin("substation") | depot
    return what & ((F.col("kind") == "node") | _area(t("industrial").isNotNull(), t("man_made") == "storage_tank") | ((F.col("kind") == "line") & t("man_made").isin("pipeline")))


def _safety() -> Column:
    name = F.lower(t("name"))
    police = name.like("%police%") | name.like("%sheriff%") | name.like("%constable%") | name.like("%gendarm%")
    what = t("amenity").isin(*SAFETY_AMENITIES) | t("emergency").isin(*EMERGENCY) | ((t("office") == "government") & police)
    return what & ((F.col("kind") == "node") | _area(t("amenity").isin(*SAFETY_AMENITIES), t("emergency").isNotNull()))


def _health() -> Column:
    what = t("amenity").isin(*HEALTH_AMENITIES) | t("healthcare").isNotNull() | t("social_facility").isin(*SOCIAL_FACILITIES) | t("building").isin("hospital", "clinic")
    vague = t("amenity").isNull() & (t("healthcare") == "yes") & t("name").isNull()
    shape = _area(t("amenity").isin("hospital", "clinic", "nursing_home"), t("healthcare").isin("hospital", "clinic", "dialysis", "rehabilitation"), t("building").isin("hospital", "clinic"))
    return what & ~vague & ((F.col("kind") == "node") | shape)


def _transportation() -> Column:
    named = t("name").isNotNull()
    what = (
        t("railway").isin(*RAILWAY)
        | t("aeroway").isin(*AEROWAY)
        | t("amenity").isin("ferry_terminal", "bus_station")
        | t("harbour").isNotNull()
        | (t("waterway").isin("dock", "terminal") & named)
        | (t("highway").isin("rest_area", "services", "bus_stop") & named)
        | (t("amenity") == "truck_stop")
        | (t("public_transport").isin("station", "stop_area") & named)
    )
    bare = ~(t("railway").isin("tram_stop") & t("name").isNull()) & ~((t("highway") == "bus_stop") & t("name").isNull())
    shape = _area(t("aeroway").isin("aerodrome", "terminal", "heliport"), t("railway").isin("station", "yard", "facility"), t("harbour").isNotNull(), t("amenity").isin("ferry_terminal", "bus_station", "truck_stop"))
    return what & bare & ((F.col("kind") == "node") | shape)


def _education() -> Column:
    what = t("amenity").isin(*SCHOOL_AMENITIES) | t("building").isin(*SCHOOL_BUILDINGS)
    return what & ((F.col("kind") == "node") | _area(t("amenity").isin(*SCHOOL_AMENITIES), t("building").isin(*SCHOOL_BUILDINGS)))


@dataclass(frozen=True)
class Layer:
    predicate: Callable[[], Column]
    keys: tuple[str, ...]
    category: tuple[str, ...]
    score_fields: tuple[str, ...]


# Projected tags, the tags that give the category (first non-null), and the key fields of the score.
LAYERS = {
    "power": Layer(_power, ("power", "voltage", *_WHO, "substation", "plant:source", "plant:output:electricity", "generator:source", "generator:output:electricity", "generator:type", "cables", "wires", "circuits", "frequency", "capacity", "height", "material", "tower:type", "location", *_END), ("power",), ("power", "voltage", "operator", "name")),
    "water_infrastructure": Layer(_water, ("man_made", "amenity", "landuse", *_WHO, "capacity", "capacity:persons", "content", "drinking_water", "pump", "pipeline", "substance", "diameter", "depth", "height", *_END), ("man_made",), ("man_made", "operator", "name", "capacity")),
    "telecom": Layer(_telecom, ("telecom", "man_made", "tower:type", "amenity", *_WHO, "height", "material", "structure", "communication:mobile_phone", "communication:radio", "communication:television", "communication:microwave", "frequency", *_END), ("telecom",), ("telecom", "man_made", "operator", "name")),
    "fuel": Layer(_fuel, ("industrial", "man_made", "landuse", "pipeline", *_WHO, "content", "substance", "capacity", "capacity:m3", "diameter", "location", *_END), ("industrial",), ("industrial", "man_made", "operator", "name")),
    "safety": Layer(_safety, ("amenity", "emergency", "office", *_WHO, "phone", "fax", "email", "website", "opening_hours", *_ADDRESS, "fire_station:type", "police", "level", "building", "capacity", *_END), ("amenity",), ("amenity", "emergency", "operator", "name")),
    "health": Layer(_health, ("amenity", "healthcare", "social_facility", "building", *_WHO, "phone", "email", "website", "opening_hours", "beds", "capacity", "emergency", "speciality", "healthcare:speciality", *_ADDRESS, "level", "wheelchair", *_END), ("amenity",), ("amenity", "healthcare", "operator", "name", "beds")),
    "transportation": Layer(_transportation, ("railway", "aeroway", "amenity", "highway", "harbour", "waterway", "public_transport", *_WHO, "iata", "icao", "network", "route_ref", "service", "aerodrome:type", "aerodrome:traffic", "ele", "height", "capacity", "gauge", "electrified", "usage", "supervised", "mooring", "addr:city", "addr:state", "addr:postcode", *_END), ("railway", "aeroway", "amenity", "highway"), ("railway", "aeroway", "amenity", "operator", "name", "iata")),
    "education": Layer(_education, ("amenity", "building", "isced:level", "isced:type", "grades", "min_age", "max_age", "operator", "operator:wikidata", "operator:type", "name", "ref", "phone", "email", "website", "opening_hours", "capacity", *_ADDRESS, "level", "wheelchair", "fee", "religion", "denomination", *_END), ("amenity",), ("amenity", "operator", "name", "isced:level")),
}


def split_multi(c: Column) -> Column:
    """A semicolon list as trimmed strings; NULL stays NULL."""
    return F.transform(F.split(c, ";"), lambda x: F.trim(x))


def prefix_map(prefix: str, tags: Column) -> Column:
    """Tags with the prefix, without it."""
    return F.transform_keys(F.map_filter(tags, lambda k, v: k.startswith(prefix)), lambda k, v: F.substring(k, F.lit(len(prefix) + 1), F.length(k)))


def prefix_map_split(prefix: str, tags: Column) -> Column:
    return F.transform_values(prefix_map(prefix, tags), lambda k, v: split_multi(v))


def filter_layer(features: DataFrame, layer: str) -> DataFrame:
    return features.where(LAYERS[layer].predicate())


def extract_layer(features: DataFrame, layer: str, *carried: str) -> DataFrame:
    """The layer's features: type, id, carried columns, projected tags, names by language, bounding box, point (a bare hospital or clinic
    building becomes its centroid) and ring. One scan of the tag table can feed all layers."""
    spec = LAYERS[layer]
    ring = F.col("ring")
    area = (F.col("kind") == "area") & ring.isNotNull()
    centre = geo.ring_centroid(ring)
    to_point = F.lit(False)
    if layer == "health":
        to_point = (F.col("kind") == "area") & t("building").isin("hospital", "clinic") & t("amenity").isNull() & t("healthcare").isNull()
    rows = filter_layer(features, layer)
    return rows.select(
        "type",
        "id",
        *carried,
        *(t(k).alias(k) for k in spec.keys),
        prefix_map("name:", F.col("tags")).alias("names"),
        F.when(area, geo.ring_box(ring)).otherwise(geo.point_box(F.col("lon"), F.col("lat"))).alias("bbox"),
        F.when(area, centre["x"]).otherwise(F.col("lon")).alias("lon"),
        F.when(area, centre["y"]).otherwise(F.col("lat")).alias("lat"),
        F.when(area & ~F.coalesce(to_point, F.lit(False)), ring).alias("ring"),
    )


def category(layer: str) -> Column:
    """The category of an extracted layer's row."""
    return F.coalesce(*(F.col(f"`{k}`") for k in LAYERS[layer].category))


def parse_rules(rows: list[tuple[str, str]]) -> list[tuple[str, list[list[tuple[str, str]]]]]:
    """(key, "a=b&c=d,e=f") rows in file order to (key, alternatives of conjunctions)."""
    return [(key, [[tuple(p.strip().split("=", 1)) for p in alt.split("&")] for alt in text.split(",") if alt.strip()]) for key, text in rows]


def match_rules(tags: Column, rules: list[tuple[str, list[list[tuple[str, str]]]]]) -> Column:
    """Key of the first rule of which some conjunction holds; NULL if none. One CASE for the whole rule table."""
    out = F.lit(None).cast("string")
    for key, alternatives in reversed(rules):
        hit = F.lit(False)
        for pairs in alternatives:
            both = F.lit(True)
            for k, v in pairs:
                both = both & F.coalesce(tags[k] == v, F.lit(False))
            hit = hit | both
        out = F.when(hit, F.lit(key)).otherwise(out)
    return out


def taxonomy_struct(keys: DataFrame, taxonomy: DataFrame, key: str = "lifeline_key") -> DataFrame:
    """Join the taxonomy (a seed of some ninety rows: key, three levels) as struct(primary, hierarchy, alternates)."""
    dim = taxonomy.select(F.col("key").alias(key), F.struct(F.col("key").alias("primary"), F.array("level0", "level1", "level2").alias("hierarchy"), F.array().cast("array<string>").alias("alternates")).alias("fema_lifeline"))
    return keys.join(dim, key, "left")
