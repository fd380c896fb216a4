"""Entity resolution: deduplication, suppression of near duplicates, campus collapse, aggregation of linked records."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from poiforge.functions import geo, text
from poiforge.operators.lineage import cut
from poiforge.operators.spatial import nearest_join, radius_join


def first_filled(c: Column, order: Column) -> Column:
    """The first non-empty value of a group in the order (an aggregate)."""
    return F.min_by(c, F.when(~text.is_empty(c), order))


def dedup_coordinates(rows: DataFrame, key: str, score: str = "confidence_score", digits: int = 7) -> DataFrame:
    """One row per rounded coordinate: that of the best score (ties to the smaller key), gaps filled from the others in that order."""
    at = [F.round("lat", digits).alias("_y"), F.round("lon", digits).alias("_x")]
    order = F.struct(-F.coalesce(score, F.lit(float("-inf"))), F.col(key))
    data = [c for c in rows.columns if c != key]
    kinds = dict(rows.dtypes)
    filled = [first_filled(F.col(f"`{c}`"), order).alias(c) if kinds[c] == "string" else F.min_by(F.col(f"`{c}`"), F.when(F.col(f"`{c}`").isNotNull(), order)).alias(c) for c in data]
    out = rows.where("lat IS NOT NULL AND lon IS NOT NULL").groupBy(*at).agg(F.min_by(key, order).alias(key), *filled)
    return out.select(*rows.columns).unionByName(rows.where("lat IS NULL OR lon IS NULL"))


#: Edges of one patch that one task settles; a patch with more of them is left to the rounds.
PATCH_EDGES = 500_000
#: Side of a patch, in radii.
PATCH = 500


def _settled(group: pd.DataFrame) -> pd.DataFrame:
    """group: rows worse, better, rank (of the worse), crossing (the edge leaves the patch; better is NULL). The greedy choice for all
    components that no edge leaves: their rows that are dropped, and those that are decided (dropped or kept)."""
    edges = group[~group["crossing"]]
    nodes, at = np.unique(np.concatenate([edges["worse"].to_numpy(), edges["better"].to_numpy()]), return_inverse=True)
    n, m = len(nodes), len(edges)
    worse, better = at[:m], at[m:]
    label = np.arange(n)
    while True:  # components by least label, with pointers followed to their ends
        low = np.minimum(label[worse], label[better])
        fresh = label.copy()
        np.minimum.at(fresh, worse, low)
        np.minimum.at(fresh, better, low)
        np.minimum.at(fresh, label[worse], low)
        np.minimum.at(fresh, label[better], low)
        fresh = fresh[fresh]
        if (fresh == label).all():
            break
        label = fresh
    leaving = np.isin(nodes, group.loc[group["crossing"], "worse"].to_numpy())
    open_ = np.zeros(n, bool)
    open_[label[leaving]] = True
    decided = ~open_[label]
    order = np.lexsort((better, worse))
    first = np.searchsorted(worse[order], np.arange(n + 1))
    betters = better[order]
    kept = np.ones(n, bool)
    ranks = edges["rank"].to_numpy()
    rank = np.full(n, -1)
    rank[worse] = ranks  # rows without a better neighbour are kept, whatever their place
    for i in np.argsort(rank, kind="stable").tolist():
        mine = betters[first[i] : first[i + 1]]
        kept[i] = not kept[mine].any()
    return pd.DataFrame({"node": nodes[decided], "dropped": ~kept[decided]})


def suppress_near(rows: DataFrame, key: str, score: str = "confidence_score", radius: float = 10.0, metric: str = "haversine") -> DataFrame:
    """Greedy suppression in score order: a row goes if a better kept row is within the radius.

    The neighbour pairs are edges from a row to its better ones. Patches of many radii settle the components that lie inside them, each in one
    task, whatever the length of their chains. What crosses a patch's border, or is too crowded, is a fixed point over the edges left: a row is kept
    once all its better neighbours are dropped, dropped once one is kept, so every round decides at least the best rows of each component."""
    place = F.struct((-F.coalesce(score, F.lit(float("-inf")))).alias("s"), F.col(key).alias("k"))
    ranked = rows.select(F.col(key).alias("_k"), "lon", "lat", place.alias("_o"))
    pairs = radius_join(ranked, ranked.select(F.col("_k").alias("_j"), "lon", "lat"), radius, "_k", "_j", metric).where("_k <> _j")
    wide = PATCH * radius / geo.DEGREE
    patch = F.struct(F.floor(F.col("lon") / wide).alias("x"), F.floor(F.col("lat") / wide).alias("y"))
    facts = ranked.select("_k", "_o", patch.alias("_p"))
    edges = pairs.join(facts, "_k").join(facts.select(F.col("_k").alias("_j"), F.col("_o").alias("_q"), F.col("_p").alias("_r")), "_j").where("_q < _o")
    edges = cut(edges.select(F.col("_k").alias("worse"), F.col("_j").alias("better"), "_o", "_p", "_r"))
    kind = dict(edges.dtypes)["worse"]
    # ranks within a patch stand for the order of scores
    inner = edges.where("_p = _r")
    crowded = inner.groupBy("_p").count().where(F.col("count") > PATCH_EDGES).select("_p")
    inner = inner.join(crowded, "_p", "left_anti")
    rank = F.dense_rank().over(Window.partitionBy("_p").orderBy("_o")).cast("long").alias("rank")
    nothing = F.lit(None).cast(kind).alias("better")
    leaving = edges.where("_p <> _r")
    marks = leaving.select("worse", "_p").unionByName(leaving.select(F.col("better").alias("worse"), F.col("_r").alias("_p"))).distinct()
    marks = marks.join(inner.select("_p").distinct(), "_p", "left_semi")
    patches = inner.select("_p", "worse", "better", rank, F.lit(False).alias("crossing")).unionByName(marks.select("_p", "worse", nothing, F.lit(0).cast("long").alias("rank"), F.lit(True).alias("crossing")))
    settled = cut(patches.groupBy("_p").applyInPandas(lambda g: _settled(g), f"node {kind}, dropped boolean"))
    dropped = settled.where("dropped").select(F.col("node").alias("worse"))
    edges = cut(edges.select("worse", "better").join(settled.select(F.col("node").alias("worse")), "worse", "left_anti"))
    while not edges.isEmpty():
        winners = edges.select(F.col("better").alias("worse")).distinct().join(edges.select("worse").distinct(), "worse", "left_anti")
        losers = cut(edges.join(winners.select(F.col("worse").alias("better")), "better", "left_semi").select("worse").distinct())
        dropped = dropped.unionByName(losers)
        # pairs with a decided row are settled: losers no longer drop others
        edges = cut(edges.join(losers, "worse", "left_anti").join(losers.select(F.col("worse").alias("better")), "better", "left_anti"))
    return rows.join(dropped.select(F.col("worse").alias(key)), key, "left_anti")


def merge_nodes(buildings: DataFrame, nodes: DataFrame, key: str, name: str = "display_name", radius: float = 50.0, threshold: float = 0.85) -> DataFrame:
    """Rows without the nodes that repeat a building: the nearest node of a building within the radius, if their names agree (raw
    token-sort ratio, or a name is missing). The node's values fill the building's gaps; geometry and ids stay. The nearest node is
    chosen first: there is no second chance for the next one."""
    near = nearest_join(buildings, nodes.withColumnRenamed(key, "_node"), radius, key, "_node", "mercator")
    b, n = buildings.select(key, F.col(name).alias("_a")), nodes.select(F.col(key).alias("_node"), F.col(name).alias("_b"))
    agree = text.is_empty(F.col("_a")) | text.is_empty(F.col("_b")) | (text.token_sort_ratio(F.coalesce("_a", F.lit("")), F.coalesce("_b", F.lit(""))) >= 100 * threshold)
    match = near.join(b, key).join(n, "_node").where(agree).select(key, "_node")
    other = nodes.select(F.col(key).alias("_node"), *(F.col(f"`{c}`").alias(f"_n_{c}") for c in nodes.columns if c != key))
    kinds = dict(buildings.dtypes)
    joined = buildings.join(match, key, "left").join(other, "_node", "left")
    fixed = {key, "lon", "lat", "geom_type", "ring"}
    missing = lambda c, kind: text.is_empty(F.col(f"`{c}`")) if kind == "string" else F.col(f"`{c}`").isNull()
    # an empty value of a node fills no gap
    cols = [F.col(f"`{c}`") if c in fixed or c not in nodes.columns else F.when(missing(c, kinds[c]) & ~missing(f"_n_{c}", kinds[c]), F.col(f"`_n_{c}`")).otherwise(F.col(f"`{c}`")).alias(c) for c in buildings.columns]
    rest = nodes.join(match.select(F.col("_node").alias(key)).distinct(), key, "left_anti")
    return joined.select(*cols).unionByName(rest, allowMissingColumns=True)


def enrich_if_empty(left: DataFrame, right: DataFrame, key: str, columns: list[str], completeness: list[str]) -> DataFrame:
    """Fill empty columns from the most complete right row of the key."""
    full = sum(((~text.is_empty(F.col(c))).cast("int") for c in completeness), F.lit(0))
    best = right.groupBy(key).agg(*(F.max_by(c, F.struct(full, F.col(c))).alias(f"_{c}") for c in columns))
    out = left.join(best, key, "left")
    return out.select(*(F.when(text.is_empty(F.col(c)), F.coalesce(f"_{c}", c)).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in left.columns))


def conflate_campus(members: DataFrame, polygons: DataFrame, polygon_id: str, score: str = "confidence_score") -> DataFrame:
    """One row per polygon with members (members: polygon_id, ordinal, attributes). 'yes' if any says so; sums of numbers; the polygon's
    text before the first member's; distinct values joined by | with the polygon's last; the best member's taxonomy; feature count."""
    order = F.col("ordinal")
    any_yes = [c for c in ("emergency", "wheelchair") if c in members.columns]
    sums = [c for c in ("beds", "capacity") if c in members.columns]
    joined = [c for c in ("speciality", "healthcare:speciality") if c in members.columns]
    plain = [c for c in ("operator", "operator:type", "phone", "email", "website", "opening_hours", "display_name", "osm_category") if c in members.columns]
    q = lambda c: F.col(f"`{c}`")
    aggs = [F.bool_or(F.coalesce(q(c) == "yes", F.lit(False))).alias(f"_m_{c}") for c in any_yes]
    aggs += [F.sum(q(c).try_cast("double")).alias(f"_m_{c}") for c in sums]
    aggs += [F.min_by(q(c), F.when(~text.is_empty(q(c)), order)).alias(f"_m_{c}") for c in plain]
    # as many values as a campus has members
    aggs += [F.transform(F.array_sort(F.collect_list(F.when(~text.is_empty(q(c)), F.struct(order, q(c).alias("v"))))), lambda s: s["v"]).alias(f"_m_{c}") for c in joined]
    if "lifeline_key" in members.columns:
        aggs.append(F.max_by("lifeline_key", F.when(F.col("lifeline_key").isNotNull(), F.struct(F.col(score), -order))).alias("_m_lifeline_key"))
    out = polygons.join(members.groupBy(polygon_id).agg(F.count("*").alias("_count"), *aggs), polygon_id)
    own = lambda c: q(c) if c in polygons.columns else F.lit(None).cast("string")
    cols = {c: F.when(F.col(f"`_m_{c}`") | F.coalesce(own(c) == "yes", F.lit(False)), "yes").otherwise(own(c)) for c in any_yes}
    for c in sums:
        total = F.coalesce(F.col(f"`_m_{c}`"), F.lit(0.0)) + F.coalesce(own(c).try_cast("double"), F.lit(0.0))
        cols[c] = F.when(total > 0, total.cast("long").cast("string"))
    cols |= {c: F.when(text.is_empty(own(c)), F.col(f"`_m_{c}`")).otherwise(own(c)) for c in plain}
    cols |= {c: F.nullif(F.array_join(F.array_distinct(F.concat(F.col(f"`_m_{c}`"), F.when(text.is_empty(own(c)), F.array().cast("array<string>")).otherwise(F.array(own(c))))), "|"), F.lit("")) for c in joined}
    if "lifeline_key" in members.columns:
        cols["lifeline_key"] = F.coalesce(own("lifeline_key"), F.col("_m_lifeline_key"))
    cols["campus_feature_count"] = F.col("_count") + 1
    rest = [q(c) for c in polygons.columns if c not in cols]
    return out.select(*rest, *(v.alias(k) for k, v in cols.items()))


def aggregate_providers(rows: DataFrame, group: str, provider: str, score: str, method: str, metres: str) -> DataFrame:
    """One row per group: repeated providers count once (best score); *_cnt sums (all NULL stays NULL); provider and score of the best;
    'spatial' if any; smallest distance."""
    by = Window.partitionBy(group, provider).orderBy(F.desc_nulls_last(score), F.asc_nulls_last(metres))
    once = rows.withColumn("_n", F.row_number().over(by)).where("_n = 1")
    counts = [c for c in rows.columns if c.lower().endswith("_cnt")]
    best = F.struct(F.col(score), F.col(provider))
    return once.groupBy(group).agg(*(F.sum(c).alias(c) for c in counts), F.max_by(provider, best).alias(provider), F.max(score).alias(score), F.when(F.bool_or(F.col(method) == "spatial"), "spatial").otherwise(F.min(method)).alias(method), F.min(metres).alias(metres))


def keep_highest(rows: DataFrame, key: str, value: str, tie: str) -> DataFrame:
    """The row of the highest value per key; NULL is lowest, ties to the smaller `tie`."""
    return rows.groupBy(key).agg(F.min_by(F.struct(*(F.col(f"`{c}`") for c in rows.columns if c != key)), F.struct(-F.coalesce(F.col(value).cast("double"), F.lit(-1e300)), F.col(tie))).alias("_r")).select(key, "_r.*")


def mint(rows: DataFrame, prefix: str, source_id: str, defaults: dict[str, Column]) -> DataFrame:
    """New points from unmatched source rows, with name-based ids."""
    return rows.withColumns({"lifeline_id": geo.uuid5(F.concat(F.lit(prefix), F.col(source_id).cast("string"))), **defaults})


def append(base: DataFrame, extra: DataFrame) -> DataFrame:
    """Union by name; columns that one side lacks are NULL."""
    return base.unionByName(extra, allowMissingColumns=True)


def displaced(lon: Column, lat: Column, new_lon: Column, new_lat: Column, most: float = 500.0) -> tuple[Column, Column]:
    """The re-geocoded point if it is at most so far from the original one."""
    near = geo.haversine(lon, lat, new_lon, new_lat) <= most
    return F.when(near, new_lon).otherwise(lon), F.when(near, new_lat).otherwise(lat)


def add_provenance(current: Column, tag: str) -> Column:
    """a+b, every tag once."""
    return F.when(text.is_empty(current), F.lit(tag)).when(F.array_contains(F.split(current, r"\+"), tag), current).otherwise(F.concat(current, F.lit(f"+{tag}")))


def first_wins_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join that adds only columns the left side doesn't have."""
    return left.join(right.select(key, *(F.col(f"`{c}`") for c in right.columns if c not in left.columns)), key, "left")
