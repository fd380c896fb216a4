"""Gold products: the strict hospital table, authority layers and the food table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poiforge.functions import geo, score, text
from poiforge.operators import resolve, spatial
from poiforge.plans.conflation import strict

def _get(df: DataFrame, *names: str) -> Column:
    """The first column of these names that the frame has, else NULL."""
    found = next((n for n in names if n in df.columns), None)
    return F.lit(None).cast("string") if found is None else F.col(f"`{found}`")


def _text(df: DataFrame, *names: str) -> Column:
    return F.coalesce(_get(df, *names).cast("string"), F.lit(""))


def trauma_level(df: DataFrame) -> Column:
    """The trauma registry before the authority's own column; empty text is no value."""
    return F.coalesce(*(F.when(F.trim(_get(df, c)) != "", _get(df, c)) for c in ("acs_trauma_level", "hifld_trauma")))


def beds(df: DataFrame) -> Column:
    """A provider's count above 0, else the tag."""
    count = _get(df, "cms_bed_cnt").try_cast("long")
    return F.when(count > 0, count).otherwise(_get(df, "beds").try_cast("double").cast("long"))


def hospital_table(df: DataFrame) -> DataFrame:
    """Exactly the 32 columns of the hospital schema, in its order; those without a source are NULL. The point is LATITUDE and LONGITUDE."""
    # The names, their order and types.
    columns: dict[str, tuple[Column | None, str]] = {
        "NAME": (_text(df, "name", "display_name"), "string"),
        "ADDRESS": (F.trim(F.concat_ws(" ", _text(df, "addr:housenumber"), _text(df, "addr:street"))), "string"),
        "CITY": (_text(df, "addr:city"), "string"),
        "STATE": (_text(df, "addr:state"), "string"),
        "ZIP": (F.substring(_text(df, "addr:postcode"), 1, 5), "string"),
        "ZIP4": (None, "string"),
        "BEDS": (beds(df), "long"),
        "TELEPHONE": (_text(df, "phone"), "string"),
        "WEBSITE": (_text(df, "website"), "string"),
        "LATITUDE": (_get(df, "lat"), "double"),
        "LONGITUDE": (_get(df, "lon"), "double"),
        "NAICS_CODE": (_text(df, "naics_codes"), "string"),
        "NAICS_DESC": (None, "string"),
        "SOURCE": (_text(df, "source_provenance"), "string"),
        "COUNTRY": (F.lit("USA"), "string"),
        "ID": (_text(df, "lifeline_id"), "string"),
        "TRAUMA": (trauma_level(df), "string"),
        "HELIPAD": (_get(df, "hifld_helipad"), "string"),
        "OWNER": (_get(df, "hifld_owner"), "string"),
        "TYPE": (_get(df, "hifld_hospital_type"), "string"),
        "ALT_NAME": (None, "string"),
        "STATUS": (None, "string"),
        "TTL_STAFF": (None, "long"),
        "POPULATION": (None, "long"),
        "COUNTY": (None, "string"),
        "COUNTYFIPS": (None, "string"),
        "ST_FIPS": (None, "string"),
        "STATE_ID": (None, "string"),
        "OBJECTID": (None, "long"),
        "SOURCEDATE": (None, "string"),
        "VAL_METHOD": (None, "string"),
        "VAL_DATE": (None, "string"),
    }
    return strict(df, columns)


def authority_layer(authority: DataFrame, silver: DataFrame, layer: str, id_field: str, name_field: str | None, key: str, radius: float = 50.0) -> DataFrame:
    """An authority's rows with id, taxonomy key, the linked point, and 1.0 (linked) or 0.85; its own columns follow."""
    rows = authority.withColumn("_id", F.col(f"`{id_field}`").cast("string"))
    near = spatial.nearest_join(rows, silver.select("lifeline_id", "lon", "lat"), radius, "_id", "lifeline_id").select("_id", F.col("lifeline_id").alias("osm_lifeline_id"))
    out = rows.join(near, "_id", "left")
    hit = F.col("osm_lifeline_id").isNotNull()
    own = [c for c in authority.columns if c not in ("lifeline_id", "lifeline_key", "display_name", "confidence_score", "confidence_tier", "source_provenance", "osm_lifeline_id")]
    name = F.col(f"`{name_field}`").cast("string") if name_field in authority.columns else F.lit(None).cast("string")
    return out.select(
        geo.uuid5(F.concat(F.lit(f"hifld/{layer}/"), F.col("_id"))).alias("lifeline_id"),
        F.lit(key).alias("lifeline_key"),
        name.alias("display_name"),
        F.when(hit, 1.0).otherwise(0.85).alias("confidence_score"),
        F.lit("high").alias("confidence_tier"),
        F.when(hit, "hifld+osm").otherwise("hifld").alias("source_provenance"),
        "osm_lifeline_id",
        *(F.col(f"`{c}`") for c in own),
    )


def food_table(silver: DataFrame, food_codes: list[str], warehouse_codes: list[str], food_sic: list[str], naics: str = "naics_codes", sic: str | None = "sic_codes") -> DataFrame:
    """Registry rows (provenance beginning with epa) with a food code: the first food code of the list decides, then SIC, then the name."""
    rows = silver.where(F.coalesce(F.col("source_provenance").startswith("epa"), F.lit(False)))
    first = F.get(F.filter(score.split_codes(F.col(naics)), lambda c: c.isin(*food_codes)), F.lit(0))
    by_sic = score.codes_overlap(F.col(sic), food_sic) if sic and sic in silver.columns else F.lit(False)
    rows = rows.withColumn("_food", first).where(F.col("_food").isNotNull() | by_sic)
    name = next((c for c in ("display_name", "name") if c in silver.columns), None)
    subtype = score.facility_subtype(F.col("_food"), warehouse_codes, by_sic, F.col(name) if name else F.lit(None).cast("string"))
    replaced = {
        "lifeline_id": geo.uuid5(F.concat(F.lit("food/wide_food/"), F.col("lifeline_id"))),
        "lifeline_key": F.lit("food_commercial_distribution"),
        "confidence_score": F.lit(1.0),
        "confidence_tier": F.lit("high"),
        "food_facility_subtype": subtype,
    }
    out = rows.withColumns(replaced)
    return out.drop("_food", *(c for c in out.columns if c.startswith("tmp_")))


def hospital_attributes(silver: DataFrame, authority: DataFrame, threshold: float = 0.85) -> DataFrame:
    """(state, zip), then (state, city), then state: a point falls through only where it had no candidate at all in a block.

    silver: lifeline_id, name, state, zip5, city; authority: authority_id and the same."""
    from poiforge.operators import fuzzy

    ready = lambda df: df.withColumn("norm", text.normalize_name_plain(F.col("name")))
    silver, authority = ready(silver), ready(authority)

    def tier(*on: str) -> fuzzy.Tier:
        match = lambda a, b: fuzzy.fuzzy_join(a, b, list(on), "lifeline_id", "authority_id", "norm", threshold)
        some = lambda a, b: a.where(" AND ".join(f"{c} <> ''" for c in on)).join(b.select(*on).distinct(), list(on), "left_semi")
        return fuzzy.Tier("_".join(on), match, some)

    return fuzzy.cascade(silver, authority, [tier("state", "zip5"), tier("state", "city"), tier("state")], "lifeline_id", "authority_id")


def campus_with_providers(members: DataFrame, matches: DataFrame, polygon: str = "campus_id") -> DataFrame:
    """Providers of a campus as one row: those of its members and of itself."""
    rows = matches.join(members.select("lifeline_id", polygon), "lifeline_id", "left").withColumn(polygon, F.coalesce(polygon, "lifeline_id"))
    return resolve.aggregate_providers(rows, polygon, "provider_id", "score", "method", "metres")
