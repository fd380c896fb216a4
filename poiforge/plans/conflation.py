"""The conflation stages as pure functions of DataFrames, in the order core, node dedup, places, authorities, registry, linkage, campus, gold.

Semantics that look odd but are kept: a point with tags only scores 0.45 (medium) whatever its tags; an authority match replaces the
score by 1.0. Fixed here: the tier is computed anew after a boost, minted rows get taxonomy and cell, repeated source
objects are dropped by id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poiforge.functions import geo, score, text
from poiforge.operators import fuzzy, resolve, spatial, tags


def silver_core(features: DataFrame, layer: str, rules, taxonomy: DataFrame | None = None, bbox: tuple | None = None) -> DataFrame:
    """Extract a layer and give every feature an id, category, cell, taxonomy key, score and tier."""
    keyed = features.withColumn("lifeline_key", tags.match_rules(F.col("tags"), rules))
    rows = tags.extract_layer(keyed, layer, "lifeline_key").dropDuplicates(["type", "id"])
    if bbox:
        rows = rows.where(geo.in_boxes(F.col("lon"), F.col("lat"), [bbox]))
    value = score.composite(F.lit(1.0), F.lit(0.0), score.source_score(F.lit(True), F.lit(False)))
    out = rows.withColumns({
        "lifeline_id": geo.uuid5(F.concat(F.lit("osm/"), F.col("type"), F.lit("/"), F.col("id").cast("string"))),
        "osm_category": tags.category(layer),
        "display_name": F.col("name"),
        "cell": geo.grid_id(F.col("lon"), F.col("lat")),
        "confidence_score": value,
        "confidence_tier": score.tier(value),
        "source_provenance": F.lit("osm"),
        "tmp_osm_layer": F.lit(layer),
    })
    return tags.taxonomy_struct(out, taxonomy) if taxonomy is not None else out


def split_attributes(core: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(master columns, attribute side table without geometry and ids)."""
    master = [c for c in ("lifeline_id", "display_name", "osm_category", "cell", "confidence_score", "confidence_tier", "lifeline_key", "fema_lifeline", "lon", "lat", "ring", "tmp_osm_layer", "source_provenance") if c in core.columns]
    return core.select(*master), core.select("lifeline_id", *(F.col(f"`{c}`") for c in core.columns if c not in {*master, "type", "id", "bbox", "names"}))


def match_places(silver: DataFrame, places: DataFrame, radius: float = 50.0) -> DataFrame:
    """Places at a point override its name and add 0.15 each (the largest place id's name wins); the others become new points."""
    near = spatial.nearest_join(places, silver, radius, "place_id", "lifeline_id", "haversine")
    hits = near.join(places.select("place_id", "place_name"), "place_id").groupBy("lifeline_id").agg(F.count("*").alias("_n"), F.max_by("place_name", F.when(~text.is_empty(F.col("place_name")), F.col("place_id"))).alias("_name"))
    value = F.when(F.col("_n").isNotNull(), F.least(F.lit(1.0), F.col("confidence_score") + 0.15 * F.col("_n"))).otherwise(F.col("confidence_score"))
    out = silver.join(hits, "lifeline_id", "left").withColumns({"display_name": F.coalesce(F.nullif(F.trim("_name"), F.lit("")), "display_name"), "confidence_score": value, "source_provenance": F.when(F.col("_n").isNotNull(), resolve.add_provenance(F.col("source_provenance"), "overture")).otherwise(F.col("source_provenance"))})
    out = out.withColumn("confidence_tier", score.tier(F.col("confidence_score"))).drop("_n", "_name")
    fresh = places.join(near.select("place_id"), "place_id", "left_anti")
    minted = resolve.mint(fresh, "overture:", "place_id", {"display_name": F.col("place_name"), "source_provenance": F.lit("overture"), "confidence_score": F.lit(0.5), "confidence_tier": F.lit("medium"), "cell": geo.grid_id(F.col("lon"), F.col("lat"))}).drop("place_id", "place_name")
    return resolve.append(out, minted.select(*(c for c in minted.columns if c in out.columns)))


def boost_authority(silver: DataFrame, authority: DataFrame, radius: float = 50.0) -> DataFrame:
    """A point with an authoritative one in reach gets score 1.0."""
    near = spatial.nearest_join(silver, authority, radius, "lifeline_id", "authority_id").select("lifeline_id", "authority_id")
    hit = F.col("authority_id").isNotNull()
    value = F.when(hit, F.lit(1.0)).otherwise(F.col("confidence_score"))
    return silver.join(near, "lifeline_id", "left").withColumns({"confidence_score": value, "confidence_tier": score.tier(value), "source_provenance": F.when(hit, resolve.add_provenance(F.col("source_provenance"), "hifld")).otherwise(F.col("source_provenance"))})


def link_registry(silver: DataFrame, registry: DataFrame, codes: DataFrame, radius: float = 50.0) -> DataFrame:
    """Registry rows (registry_id, registry_name, naics, sic, lon, lat) with a known code: the nearest point gets their boosts
    (added, capped), the first row's id and codes and the last one's level; the rest become new points."""
    known = score.best_code(registry, "registry_id", "naics", "sic", codes)
    rows = registry.join(known, "registry_id")
    near = spatial.nearest_join(rows, silver, radius, "registry_id", "lifeline_id").join(rows.select("registry_id", "naics", "sic", "level"), "registry_id")
    hits = near.groupBy("lifeline_id").agg(F.sum(score.boost(F.col("level"))).alias("_b"), F.min("registry_id").alias("epa_registry_id"), F.min_by("naics", "registry_id").alias("naics_codes"), F.min_by("sic", "registry_id").alias("sic_codes"), F.max_by("level", "registry_id").alias("naics_lifeline_tier"))
    value = F.when(F.col("_b").isNotNull(), score.boosted(F.col("confidence_score"), F.col("_b"))).otherwise(F.col("confidence_score"))
    prov = F.when(F.col("_b").isNotNull(), resolve.add_provenance(F.col("source_provenance"), "epa_frs")).otherwise(F.col("source_provenance"))
    out = silver.join(hits, "lifeline_id", "left").withColumns({"confidence_score": value, "source_provenance": prov}).withColumn("confidence_tier", score.tier(F.col("confidence_score"))).drop("_b")
    fresh = rows.join(near.select("registry_id"), "registry_id", "left_anti")
    start = F.lit(0.5)
    minted = resolve.mint(fresh, "epa_frs/", "registry_id", {"display_name": F.col("registry_name"), "epa_registry_id": F.col("registry_id"), "naics_codes": F.col("naics"), "sic_codes": F.col("sic"), "naics_lifeline_tier": F.col("level"), "confidence_score": score.boosted(start, score.boost(F.col("level"))), "source_provenance": F.lit("epa_frs"), "cell": geo.grid_id(F.col("lon"), F.col("lat"))})
    minted = minted.withColumn("confidence_tier", score.tier(F.col("confidence_score")))
    return resolve.append(out, minted.select(*(c for c in minted.columns if c in out.columns)))


def link_trauma(places: DataFrame, centres: DataFrame, radius: float = 200.0, threshold: float = 0.70) -> DataFrame:
    """Best name within the radius, nearer first on ties, then the smaller id (places: lifeline_id, name; centres: institution_id, name).

    Of the centres of one name only the nearest can win at a point, so one is kept a point and name before names are compared, each two once."""
    simple = lambda df, key, alias: df.where("lon IS NOT NULL AND lat IS NOT NULL").select(key, text.normalize_name_simple(F.col("name")).alias(alias), "lon", "lat")
    a = simple(places, "lifeline_id", "_a").withColumnsRenamed({"lon": "_lon", "lat": "_lat"})
    b = simple(centres, "institution_id", "_b").groupBy(F.col("lon").alias("_rlon"), F.col("lat").alias("_rlat"), "_b").agg(F.min("institution_id").alias("institution_id"))
    pairs = spatial.near_points(a.select("_lon", "_lat").distinct(), b, radius)
    nearest = pairs.groupBy("_lon", "_lat", "_b").agg(F.min(F.struct("distance_m", "institution_id")).alias("_n"))
    both = nearest.join(a.select("_lon", "_lat", "_a").distinct(), ["_lon", "_lat"])
    scored = both.select("_a", "_b").distinct().withColumn("score", text.token_sort_ratio(F.col("_a"), F.col("_b")) / 100).where(F.col("score") >= threshold)
    best = both.join(scored, ["_a", "_b"]).groupBy("_lon", "_lat", "_a").agg(F.min(F.struct((-F.col("score")).alias("s"), "_n.distance_m", "_n.institution_id")).alias("_m"))
    return a.join(best, ["_lon", "_lat", "_a"]).select("lifeline_id", "_m.institution_id", (-F.col("_m.s")).alias("score"), "_m.distance_m")


def campus(rows: DataFrame, amenities: list[str], polygon_id: str = "lifeline_id") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(campus rows with their members folded in, other rows, members with polygon ids)."""
    is_area = F.col("ring").isNotNull() & F.coalesce(F.col("osm_category").isin(*amenities), F.lit(False))
    areas, rest = rows.where(is_area), rows.where(~is_area)
    held = spatial.within_join(rest.select("lifeline_id", "lon", "lat"), areas.select(F.col(polygon_id).alias("campus_id"), "ring"), "lifeline_id", "campus_id")
    members = rest.join(held, "lifeline_id").withColumn("ordinal", F.col("lifeline_id"))
    folded = resolve.conflate_campus(members, areas.withColumnRenamed(polygon_id, "campus_id"), "campus_id").withColumnRenamed("campus_id", polygon_id)
    alone = areas.join(folded.select(polygon_id), polygon_id, "left_anti")
    standalone = rest.join(held.select("lifeline_id"), "lifeline_id", "left_anti")
    return folded, resolve.append(standalone, alone), members


def wide(master: DataFrame, *sides: DataFrame, key: str = "lifeline_id") -> DataFrame:
    """Master with side tables: only new columns of each are added; tmp_ columns go."""
    for side in sides:
        master = resolve.first_wins_join(master, side, key)
    return master.drop(*(c for c in master.columns if c.startswith("tmp_")))


def hospitals(wide_health: DataFrame) -> DataFrame:
    """Hospital points that aren't registry-only (a NULL provenance stays), one per coordinate, without near duplicates."""
    point = F.col("ring").isNull() if "ring" in wide_health.columns else F.lit(True)
    rows = wide_health.where((F.col("fema_lifeline.primary") == "hospitals") & point & ~F.col("source_provenance").eqNullSafe("epa_frs")).drop("fema_lifeline", "ring")
    return resolve.suppress_near(resolve.dedup_coordinates(rows, "lifeline_id"), "lifeline_id")


def heuristic_buildings(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(buildings, nodes) to be merged where no attribute table says which is which: points without a category, and hospital or clinic points."""
    point = F.col("ring").isNull()
    return rows.where(F.col("osm_category").isNull() & point), rows.where(F.col("osm_category").isin("hospital", "clinic") & point)


def strict(df: DataFrame, columns: dict[str, tuple[Column | None, str]]) -> DataFrame:
    """Exactly these columns and types; None is a NULL stub."""
    return df.select(*((F.lit(None) if c is None else c).cast(kind).alias(name) for name, (c, kind) in columns.items()))


def match_state(providers: DataFrame, matches: DataFrame) -> DataFrame:
    """All providers with their best match, or 'unmatched'."""
    best = fuzzy.best_per(matches, "provider_id", F.desc("score"), F.asc("place_id"))
    return providers.join(best.select("provider_id", "place_id", "score", "method"), "provider_id", "left").withColumn("method", F.coalesce("method", F.lit("unmatched")))
