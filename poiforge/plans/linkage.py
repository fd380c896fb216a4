"""Linkage of places and providers in five tiers.

places: place_id, name, display_name, state, city, postcode, house_number, lon, lat. providers: provider_id, name, state, city, zip, address,
category, beds, lon, lat (geocoded; NULL where that failed), and optionally re_lon, re_lat (a second geocoder's point). `ready_places` and
`ready_providers` turn them into norm, brand, state, zip5, city, number; the names are stored normalised before any tier reads them.

Between tiers matched places and claimed providers leave; within a tier several places may claim one provider. Every tier gives
a place one provider, by the keys named in its function and then the smaller provider id, so results are deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poiforge.functions import text
from poiforge.operators import fuzzy, spatial
from poiforge.operators.lineage import cut

#: Fixed value: where a display name holds a state, before a zip.
STATE_IN_DISPLAY = r"\b([A-Z]{2})\s+\d{5}\b"
RESULT = ("place_id", "provider_id", "score", "method", "distance_m")


def _clean(c: str) -> Column:
    return F.trim(F.coalesce(F.col(c).cast("string"), F.lit("")))


def ready_places(places: DataFrame) -> DataFrame:
    """place_id, norm, brand, state, zip5, city, number, display_name, lon, lat; the display name stands in for an empty name."""
    norm, shown = text.normalize_name(F.col("name")), text.normalize_name(F.col("display_name"))
    rows = places.select(
        "place_id", F.coalesce(F.nullif(norm, F.lit("")), shown).alias("norm"), F.substring(F.upper(_clean("state")), 1, 2).alias("state"), F.upper(_clean("city")).alias("city"),
        text.place_zip(F.col("postcode"), F.col("display_name")).alias("zip5"), text.place_house_number(F.col("house_number"), F.col("display_name")).alias("number"), _clean("display_name").alias("display_name"), "lon", "lat",
    )
    return cut(rows.withColumn("brand", text.strip_brand(F.col("norm"))))


def ready_providers(providers: DataFrame) -> DataFrame:
    """provider_id, norm, brand, state, zip5, city, number, general (category 01), beds, lon, lat, re_lon, re_lat."""
    again = [F.col(c) if c in providers.columns else F.lit(None).cast("double").alias(c) for c in ("re_lon", "re_lat")]
    rows = providers.select(
        "provider_id", text.normalize_name(F.col("name")).alias("norm"), F.substring(F.upper(_clean("state")), 1, 2).alias("state"), F.upper(_clean("city")).alias("city"),
        text.normalize_zip(F.col("zip")).alias("zip5"), text.provider_house_number(F.col("address")).alias("number"), (_clean("category") == "01").cast("int").alias("general"), F.coalesce(F.col("beds").cast("long"), F.lit(0)).alias("beds"), "lon", "lat", *again,
    )
    return cut(rows.withColumn("brand", text.strip_brand(F.col("norm"))))


def resolve_states(places: DataFrame, boundaries: DataFrame) -> DataFrame:
    """Ready places with the code of the boundary (code, ring) that holds them, where they have no state."""
    missing = places.where("state = ''").select("place_id", "lon", "lat")
    found = spatial.within_join(missing, boundaries, "place_id", "code").select("place_id", F.col("code").alias("_code"))
    out = places.join(found, "place_id", "left")
    return out.withColumn("state", F.when(F.col("state") == "", F.coalesce("_code", F.lit(""))).otherwise(F.col("state"))).drop("_code")


def _scored(pairs: DataFrame, places: DataFrame, providers: DataFrame, kernel) -> DataFrame:
    """Pairs with both sides' names compared by one more kernel, as `other`, and the provider's general and beds."""
    rows = pairs.join(places.select("place_id", F.col("norm").alias("_a")), "place_id").join(providers.select("provider_id", F.col("norm").alias("_b"), "general", "beds"), "provider_id")
    names = rows.select("_a", "_b").distinct().withColumn("other", kernel(F.col("_a"), F.col("_b")) / 100)
    return rows.join(names, ["_a", "_b"]).drop("_a", "_b")


def _pick(rows: DataFrame, method: Column | str, *order: str) -> DataFrame:
    """One provider a place: the first by the columns in descending order, then the nearer one, then the smaller id."""
    if "distance_m" not in rows.columns:
        rows = rows.withColumn("distance_m", F.lit(None).cast("double"))
    best = fuzzy.best_per(rows, "place_id", *(F.desc(c) for c in order), F.asc_nulls_last("distance_m"), F.asc("provider_id"))
    return best.withColumn("method", F.lit(method) if isinstance(method, str) else method).select(*RESULT)


def _near(places: DataFrame, providers: DataFrame, radius: float, kernel, threshold: float, k: int = 10) -> DataFrame:
    """Of the k nearest providers of a place those whose names reach the threshold."""
    named = places.where("norm <> ''")
    pairs = spatial.radius_join(named, providers, radius, "place_id", "provider_id", "mercator")
    few = fuzzy.best_per(pairs, "place_id", F.asc("distance_m"), F.asc("provider_id"), keep=k)
    return _scored(few, places, providers, kernel).withColumnRenamed("other", "score").where(F.col("score") >= threshold)


def tier1(places: DataFrame, providers: DataFrame, radius: float = 200.0, threshold: float = 0.55) -> DataFrame:
    """By position: the best name, then general hospitals, then beds, then the nearer one."""
    rows = _near(places, providers.where("lon IS NOT NULL AND lat IS NOT NULL"), radius, text.max_sort_set_ratio, threshold)
    return _pick(rows, "spatial", "score", "general", "beds")


def _pairs(places: DataFrame, providers: DataFrame, on: list[str], threshold: float, kernel=text.max_sort_set_ratio, name: str = "norm") -> DataFrame:
    return fuzzy.fuzzy_join(places, providers, on, "place_id", "provider_id", name, threshold, kernel)


def _accepted(pairs: DataFrame, providers: DataFrame, threshold: float) -> DataFrame:
    """Pairs whose score stays over the threshold when an empty general hospital's is lowered; with `adjusted`."""
    facts = providers.select("provider_id", "general", "beds")
    adjusted = F.col("score") * F.when((F.col("general") == 1) & (F.col("beds") == 0), 0.75).otherwise(1.0)
    return pairs.join(facts, "provider_id").withColumn("adjusted", adjusted).where(F.col("adjusted") >= threshold).select("place_id", "provider_id", "score", "adjusted")


#: What tier2 reads of a place (`shown`: the state of its display name) and of a provider, but for ids, general and beds.
_PLACE_KEYS, _PROVIDER_KEYS = ("norm", "brand", "state", "zip5", "city", "shown"), ("norm", "brand", "state", "zip5", "city")


def tier2(places: DataFrame, providers: DataFrame, threshold: float = 0.80, strict: float = 0.90) -> DataFrame:
    """Tier 2 (see _tier2) once for all places that look alike, against the providers that can win: of those that look alike every rule takes
    the first by general, beds and id, with or without the empty general hospitals last."""
    keys = F.struct(*_PLACE_KEYS)
    places = places.withColumn("shown", F.regexp_extract("display_name", STATE_IN_DISPLAY, 1)).select("place_id", keys.alias("_k"))
    alike = cut(places.groupBy("_k").agg(F.min("place_id").alias("_first")))
    first = F.struct(-F.col("general"), -F.col("beds"), "provider_id")
    closed = (F.col("general") == 1) & (F.col("beds") == 0)
    row = F.struct("provider_id", "general", "beds")
    ends = providers.groupBy(*_PROVIDER_KEYS).agg(F.array_distinct(F.array(F.min_by(row, F.struct(closed, first)), F.min_by(row, first))).alias("_p"))
    few = cut(ends.withColumn("_p", F.explode("_p")).select(*_PROVIDER_KEYS, "_p.*"))
    found = _tier2(alike.select(F.col("_first").alias("place_id"), "_k.*"), few, threshold, strict)
    found = found.join(alike.withColumnRenamed("_first", "place_id"), "place_id").drop("place_id")
    return places.join(found, "_k").select(*RESULT)


def _tier2(places: DataFrame, providers: DataFrame, threshold: float, strict: float) -> DataFrame:
    """By name in one pool of blocks: (state, zip), the zip alone where a place has no state, (state, city) for places with a zip that no zip block
    took, the state for all that neither took. In zip blocks names count without their brand if they fail with it. One pick from the pool: lowered score, general, word-set score, beds.
    What is left is tried with the state of its display name, then once more by (state, city), both by word sets."""
    with_zip = places.where(F.length("zip5") == 5)
    zips = [(with_zip, ["state", "zip5"]), (with_zip.where("state = ''"), ["zip5"])]
    plain, brands = None, None
    for some, on in zips:
        a, b = _pairs(some, providers, on, threshold), _pairs(some, providers, on, threshold, name="brand")
        plain, brands = (a, b) if plain is None else (plain.unionByName(a), brands.unionByName(b))
    plain = cut(plain)
    by_zip = cut(_accepted(plain, providers, threshold))
    lifted = _accepted(brands.join(plain.select("place_id", "provider_id"), ["place_id", "provider_id"], "left_anti"), providers, threshold)
    done = by_zip.select("place_id").distinct()
    by_city = cut(_accepted(_pairs(with_zip.join(done, "place_id", "left_anti"), providers, ["state", "city"], threshold), providers, threshold))
    done = done.unionByName(by_city.select("place_id").distinct())
    by_state = _accepted(_pairs(places.join(done, "place_id", "left_anti"), providers, ["state"], threshold), providers, threshold)
    pool = by_zip.unionByName(lifted).unionByName(by_city).unionByName(by_state)
    out = cut(_pick(_scored(pool, places, providers, text.token_set_ratio), "zip_fuzzy", "adjusted", "general", "other", "beds"))

    def by_set(some: DataFrame, on: list[str], bar: float) -> DataFrame:
        pairs = _pairs(some.join(out.select("place_id"), "place_id", "left_anti"), providers, on, bar, text.token_set_ratio)
        return cut(_pick(_scored(pairs, places, providers, text.token_sort_ratio), "zip_fuzzy", "score", "other", "general", "beds"))

    stateless = places.where("state = ''").withColumn("state", F.col("shown"))
    out = out.unionByName(by_set(stateless, ["state"], strict))
    return out.unionByName(by_set(places.where("state <> ''"), ["state", "city"], threshold))


def tier3(places: DataFrame, providers: DataFrame, threshold: float = 0.50) -> DataFrame:
    """By house number and zip; places without any provider there by house number and city, whatever its category and beds.
    The best sorted-word score, then word-set score, general, beds."""
    with_zip = places.where(F.length("zip5") == 5)
    on = ["zip5", "number"]
    zip_pairs = _pairs(with_zip, providers, on, threshold, text.token_sort_ratio).withColumn("how", F.lit("addr_zip"))
    there = providers.where("zip5 <> '' AND number <> ''").select(*on).distinct()
    rest = with_zip.join(there, on, "left_anti")
    city_pairs = _pairs(rest, providers, ["number", "city"], threshold, text.token_sort_ratio).withColumn("how", F.lit("addr_city"))
    rows = _scored(zip_pairs.unionByName(city_pairs), places, providers, text.token_set_ratio)
    known = F.col("how") == "addr_zip"
    rows = rows.withColumns({"general": F.when(known, F.col("general")).otherwise(0), "beds": F.when(known, F.col("beds")).otherwise(0)})
    return _pick(rows, F.col("how"), "score", "other", "general", "beds")


def tier4(places: DataFrame, providers: DataFrame, threshold: float = 0.75) -> DataFrame:
    """By the zip alone: the best word-set score, then sorted-word score, general, beds."""
    five = lambda df: df.where(F.length("zip5") == 5)
    pairs = _pairs(five(places), five(providers), ["zip5"], threshold, text.token_set_ratio)
    return _pick(_scored(pairs, places, providers, text.token_sort_ratio), "name_zip", "score", "other", "general", "beds")


def tier5(places: DataFrame, providers: DataFrame, radius: float = 500.0, threshold: float = 0.70) -> DataFrame:
    """By the second geocoder's position, for providers without one of their own: the best word-set score, then general, beds, the nearer one."""
    again = providers.where("(lon IS NULL OR lat IS NULL) AND re_lon IS NOT NULL AND re_lat IS NOT NULL").drop("lon", "lat").withColumnsRenamed({"re_lon": "lon", "re_lat": "lat"})
    return _pick(_near(places, again, radius, text.token_set_ratio, threshold), "census_spatial", "score", "general", "beds")


TIERS = (tier1, tier2, tier3, tier4, tier5)


def link(places: DataFrame, providers: DataFrame) -> DataFrame:
    """place_id, provider_id, score, method, distance_m of ready places and providers, through all tiers."""
    out = None
    for tier in TIERS:
        found = cut(tier(places, providers))
        places = places.join(found.select("place_id"), "place_id", "left_anti")
        providers = providers.join(found.select("provider_id").distinct(), "provider_id", "left_anti")
        out = found if out is None else out.unionByName(found)
    return out


def link_providers(places: DataFrame, providers: DataFrame, boundaries: DataFrame | None = None) -> DataFrame:
    """From raw rows; boundaries give a state to places without one."""
    ready = ready_places(places)
    return link(ready if boundaries is None else cut(resolve_states(ready, boundaries)), ready_providers(providers))
