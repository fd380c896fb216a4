"""Confidence scores and code lookups as columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poiforge.operators.lineage import small

# Weights, limits and boosts of the scoring rules.
WEIGHTS = (0.40, 0.40, 0.20)
REACH = 500.0
TIERS = ((0.75, "high"), (0.40, "medium"))
BOOSTS = {1: 0.25, 2: 0.15, 3: 0.05}


def distance_score(metres: Column) -> Column:
    """Falls to 0 at 500 m; 0 without a match."""
    return F.coalesce(F.greatest(F.lit(0.0), 1 - metres / REACH), F.lit(0.0))


def attribute_score(pairs: list[tuple[Column, Column]]) -> Column:
    """Share of fields that both sides have; 0.5 if none are listed."""
    if not pairs:
        return F.lit(0.5)
    return sum(((a.isNotNull() & b.isNotNull()).cast("double") for a, b in pairs), F.lit(0.0)) / len(pairs)


def source_score(osm: Column, authority: Column) -> Column:
    return F.when(osm & authority, 1.0).when(authority, 0.5).when(osm, 0.25).otherwise(0.0)


def composite(d: Column, a: Column, s: Column) -> Column:
    return WEIGHTS[0] * d + WEIGHTS[1] * a + WEIGHTS[2] * s


def tier(score: Column) -> Column:
    out = F.lit("low")
    for least, name in reversed(TIERS):
        out = F.when(score >= least, name).otherwise(out)
    return out


def boost(level: Column, overrides: dict[int, float] | None = None) -> Column:
    out = F.lit(0.0)
    for k, v in (BOOSTS | (overrides or {})).items():
        out = F.when(level == k, v).otherwise(out)
    return out


def boosted(score: Column, boosts: Column) -> Column:
    """Adding capped boosts one after the other is one capped sum."""
    return F.least(F.lit(1.0), score + boosts)


def split_codes(c: Column) -> Column:
    """Codes of a | or , list, trimmed, without empty ones."""
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), "[|,]"), lambda x: F.trim(x)), lambda x: x != "")


def best_code(rows: DataFrame, key: str, naics: str, sic: str, codes: DataFrame) -> DataFrame:
    """key and the best entry: lowest tier, NAICS before SIC, first in the list. codes (a seed dimension): system, code, level, lifeline_key."""
    lists = [(system, n, c) for n, (system, c) in enumerate((("naics", naics), ("sic", sic)))]
    each = None
    for system, n, c in lists:
        part = rows.select(key, F.posexplode(split_codes(F.col(c))).alias("pos", "code")).withColumns({"system": F.lit(system), "source": F.lit(n)})
        each = part if each is None else each.unionByName(part)
    hit = each.join(small(codes), ["system", "code"])
    return hit.groupBy(key).agg(F.min_by(F.struct("lifeline_key", "level", "code", "system"), F.struct("level", "source", "pos")).alias("best")).select(key, "best.*")


def codes_overlap(c: Column, wanted: list[str]) -> Column:
    return F.arrays_overlap(split_codes(c), F.array(*map(F.lit, wanted)))


# Words in a name that mark a warehouse.
WAREHOUSE = r"(?i)\b(distribution|distribut|warehouse|warehousing|fulfillment|cold[\s-]storage|distr\.?)\b"


def facility_subtype(matched: Column, warehouse_codes: list[str], has_sic: Column, name: Column) -> Column:
    return F.when(matched.isin(*warehouse_codes) | F.coalesce(has_sic, F.lit(False)) | F.coalesce(name.rlike(WAREHOUSE), F.lit(False)), "warehouse_distribution").otherwise("retail_store")


def highest_isced(c: Column, names: dict[int, str]) -> Column:
    """Name of the highest level in a semicolon list of numbers."""
    top = F.array_max(F.filter(F.transform(F.split(c, ";"), lambda x: F.trim(x).try_cast("int")), lambda x: x.isNotNull()))
    out = F.lit(None).cast("string")
    for k, v in names.items():
        out = F.when(top == k, v).otherwise(out)
    return out


def color_step(score: Column) -> Column:
    """One of 20 steps of a colour ramp."""
    return F.round(score * 20).cast("int")


# Fixed value: the layer of a new point by the first two levels of its taxonomy.
COMPONENT_LAYERS = {
    ("Energy", "Power Grid"): "power",
    ("Energy", "Fuel"): "fuel",
    ("Communications", "Infrastructure"): "telecom",
    ("Communications", "911 and Dispatch"): "safety",
    ("Health and Medical", "Medical Care"): "health",
    ("Health and Medical", "Medical Supply Chain"): "health",
    ("Health and Medical", "Public Health"): "health",
    ("Safety and Security", "Fire Service"): "safety",
    ("Safety and Security", "Law Enforcement/Security"): "safety",
    ("Safety and Security", "Community Safety"): "safety",
    ("Safety and Security", "Government Service"): "safety",
    ("Transportation", "Aviation"): "transportation",
    ("Transportation", "Railway"): "transportation",
    ("Transportation", "Maritime"): "transportation",
    ("Transportation", "Mass Transit"): "transportation",
    ("Transportation", "Highway Roadway Motor Vehicle"): "transportation",
    ("Water Systems", "Potable Water Infrastructure"): "water_infrastructure",
    ("Water Systems", "Wastewater Management"): "water_infrastructure",
    ("Hazardous Materials", "Facilities"): "fuel",
}


def component_layer(component: Column, subcomponent: Column) -> Column:
    """The layer of two taxonomy levels, `other` for unknown ones."""
    known = F.create_map(*(F.lit(x) for (a, b), layer in COMPONENT_LAYERS.items() for x in (f"{a}/{b}", layer)))
    return F.coalesce(F.try_element_at(known, F.concat(component, F.lit("/"), subcomponent)), F.lit("other"))
