"""The whole run, from the tag table to the gold tables: every stage is a committed table, and a second run reads what is there.

sources (all but `features` may be absent): features (type, id, kind, tags, lon, lat, ring); places (place_id, place_name, lon, lat); authority
(layer -> authority_id, lon, lat); registry (registry_id, registry_name, naics, sic, lon, lat) with codes (system, code, level, lifeline_key);
providers (see linkage); centres (institution_id, name, lon, lat, trauma_level); hospital_attributes (authority_id, name, state, zip5, city, trauma);
taxonomy (key, three levels).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from poiforge.operators import resolve, tags
from poiforge.plans import conflation, gold, linkage
from poiforge.sources import writers


@dataclass
class Flow:
    """Stages under one folder. `force` rebuilds the named stages (or all)."""

    spark: SparkSession
    out: str
    sources: dict[str, DataFrame | dict[str, DataFrame]]
    rules: list
    layers: tuple[str, ...] = tuple(tags.LAYERS)
    box: tuple[float, float, float, float] | None = None
    force: tuple[str, ...] = field(default_factory=tuple)

    def stage(self, name: str, build: Callable[[], DataFrame], by: str | None = None) -> DataFrame:
        path = f"{self.out}/{name}"
        if name in self.force or "all" in self.force or not writers.done(self.spark, path):
            (writers.sorted_table(build(), path, by) if by else writers.table(build(), path))
        return writers.read(self.spark, path)

    def run(self) -> dict[str, DataFrame]:
        """Silver and gold tables by name."""
        out: dict[str, DataFrame] = {}
        for layer in self.layers:
            core = self.stage(f"silver_{layer}_core", lambda layer=layer: self._core(layer))
            master, attributes = conflation.split_attributes(core)
            out[f"attr_{layer}"] = self.stage(f"attr_{layer}", lambda a=attributes: a)
            out[f"silver_{layer}"] = master = self.stage(f"silver_{layer}", lambda layer=layer, m=master: self._conflated(layer, m))
            sides = [out[f"attr_{layer}"]]
            if layer == "health":
                sides += self._health(master, out)
            wide = self.stage(f"wide_{layer}", lambda m=master, s=sides: conflation.wide(m.withColumn("name", F.col("display_name")), *s), by="cell")
            out[f"wide_{layer}"] = wide
            if layer == "health" and "taxonomy" in self.sources:
                hospitals = self.stage("wide_hospitals", lambda w=wide: conflation.hospitals(w))
                out["wide_hospitals"] = hospitals
                out["hospital_table"] = self.stage("hospital_table", lambda h=hospitals: gold.hospital_table(h))
        return out

    def _core(self, layer: str) -> DataFrame:
        core = conflation.silver_core(self.sources["features"], layer, self.rules, self.sources.get("taxonomy"), self.box)
        if layer != "health":
            return core
        buildings, nodes = conflation.heuristic_buildings(core)
        rest = core.join(buildings.select("lifeline_id").unionByName(nodes.select("lifeline_id")), "lifeline_id", "left_anti")
        return rest.unionByName(resolve.merge_nodes(buildings, nodes, "lifeline_id"))

    def _conflated(self, layer: str, master: DataFrame) -> DataFrame:
        if layer == "health" and "places" in self.sources:
            master = conflation.match_places(master, self.sources["places"])
        if layer in self.sources.get("authority", {}):
            master = conflation.boost_authority(master, self.sources["authority"][layer])
        if "registry" in self.sources:
            # rows whose code belongs to this layer's part of the taxonomy
            codes = self.sources["codes"].where(F.col("layer") == layer)
            master = conflation.link_registry(master, self.sources["registry"], codes.drop("layer"))
        return master

    def _health(self, master: DataFrame, out: dict[str, DataFrame]) -> list[DataFrame]:
        """Side tables of the health layer: providers, hospital attributes and trauma centres, one row a point each."""
        sides = []
        attributes = out["attr_health"]
        at = lambda c: F.col(f"`{c}`") if c in attributes.columns else F.lit(None).cast("string")
        address = attributes.select("lifeline_id", at("addr:state").alias("state"), at("addr:city").alias("city"), at("addr:postcode").alias("postcode"), at("addr:housenumber").alias("house_number"))
        named = master.select("lifeline_id", "display_name", "lon", "lat").join(address, "lifeline_id", "left")
        if "providers" in self.sources:
            places = named.withColumnsRenamed({"lifeline_id": "place_id"}).withColumn("name", F.col("display_name"))
            providers = self.sources["providers"]
            found = self.stage("provider_links", lambda: linkage.link_providers(places, providers))
            facts = providers.select("provider_id", F.col("category").alias("cms_provider_category"), F.col("beds").alias("cms_bed_cnt"))
            side = found.join(facts, "provider_id").select(F.col("place_id").alias("lifeline_id"), F.col("provider_id").alias("cms_provider_num"), F.col("score").alias("cms_match_score"), F.col("method").alias("cms_match_method"), F.col("distance_m").alias("cms_match_distance_m"), "cms_provider_category", "cms_bed_cnt")
            sides.append(self.stage("attr_health_cms", lambda: side))
            out["match_state"] = self.stage("match_state", lambda: conflation.match_state(providers.select("provider_id"), found))
        if "hospital_attributes" in self.sources:
            authority = self.sources["hospital_attributes"]
            silver = named.select("lifeline_id", F.col("display_name").alias("name"), "state", "city", F.substring("postcode", 1, 5).alias("zip5"))
            links = gold.hospital_attributes(silver, authority).select("lifeline_id", "authority_id")
            side = links.join(authority.select("authority_id", F.col("trauma").alias("hifld_trauma")), "authority_id").drop("authority_id")
            sides.append(self.stage("attr_health_authority", lambda: side))
        if "centres" in self.sources:
            centres = self.sources["centres"]
            links = conflation.link_trauma(named.select("lifeline_id", F.col("display_name").alias("name"), "lon", "lat"), centres)
            side = links.join(centres.select("institution_id", F.col("trauma_level").alias("acs_trauma_level")), "institution_id").select("lifeline_id", "acs_trauma_level")
            sides.append(self.stage("attr_health_trauma", lambda: side))
        return sides
