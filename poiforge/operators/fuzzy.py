"""Blocked fuzzy joins and tiered fall-through. Scores are Arrow UDFs, evaluated once for each pair of distinct names of a block.

A fuzzy join is an inner equi-join of distinct names on the blocking key plus a filter on the score (a Python UDF can't stand in an outer
join's condition); ids are joined back by block and name. Bounds that Catalyst evaluates in the join keep pairs from the UDF that
can't reach the threshold: the edit distance of the sorted words, or a common word. A block with very many distinct names still costs
the product of both sides' distinct names in comparisons; AQE splits its partition where it is skewed.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from poiforge.functions import text
from poiforge.operators.lineage import cut


#: Kernels that compare sets of words, so that a common word may lift any pair over the threshold.
_SETS = (text.token_set_ratio, text.max_sort_set_ratio)
#: Kernels with a bound; others go to the UDF without one.
_BOUNDED = (text.token_sort_ratio, *_SETS)


def reachable(a: Column, b: Column, threshold: float) -> Column:
    """Whether an indel ratio 2 * LCS / (m + n) can reach the threshold: the edit distance is at most m + n - 2 * LCS."""
    return F.levenshtein(a, b) <= (1 - threshold) * (F.length(a) + F.length(b)) + 1e-9


def name_matches(left: DataFrame, right: DataFrame, on: list[str], name: str, threshold: float, score: Callable = text.token_sort_ratio, prefilter: bool = True) -> DataFrame:
    """The block columns, _a, _b (distinct names of a block's sides) and score (0 to 1) where it reaches the threshold."""
    bounded = prefilter and score in _BOUNDED

    def names(df: DataFrame, alias: str) -> DataFrame:
        rows = df.where(" AND ".join(f"`{c}` IS NOT NULL AND `{c}` <> ''" for c in [*on, name])).select(*on, F.col(name).alias(alias)).distinct()
        if not bounded:
            return rows
        return rows.withColumns({f"{alias}_sorted": text.sorted_words(F.col(alias)), f"{alias}_set": text.sorted_words(F.col(alias), distinct=True)})

    pairs = names(left, "_a").join(names(right, "_b"), on)
    if bounded:
        fits = reachable(F.col("_a_sorted"), F.col("_b_sorted"), threshold)
        if score in _SETS:
            fits = fits | F.arrays_overlap(F.split("_a_set", " "), F.split("_b_set", " ")) | reachable(F.col("_a_set"), F.col("_b_set"), threshold)
        pairs = pairs.where(fits)
    return pairs.select(*on, "_a", "_b").withColumn("score", score(F.col("_a"), F.col("_b")) / 100).where(F.col("score") >= threshold)


def fuzzy_join(left: DataFrame, right: DataFrame, on: list[str], left_id: str, right_id: str, name: str, threshold: float, score: Callable = text.token_sort_ratio, prefilter: bool = True) -> DataFrame:
    """left_id, right_id, score (0 to 1) of pairs in one block whose names reach the threshold; empty block keys and names match nothing."""
    found = name_matches(left, right, on, name, threshold, score, prefilter)
    a, b = left.select(left_id, *on, F.col(name).alias("_a")), right.select(right_id, *on, F.col(name).alias("_b"))
    return found.join(a, [*on, "_a"]).join(b, [*on, "_b"]).select(left_id, right_id, "score")


def best_per(pairs: DataFrame, key: str, *order: Column, keep: int = 1) -> DataFrame:
    """The first `keep` rows of each key; a row_number filter is limited before the shuffle."""
    by = Window.partitionBy(key).orderBy(*order)
    return pairs.withColumn("_n", F.row_number().over(by)).where(F.col("_n") <= keep).drop("_n")


def geocode(addresses: DataFrame, queries: DataFrame, query_id: str, accept: float = 0.80, top: int = 1, carry: tuple[str, ...] = ()) -> DataFrame:
    """Whole-table geocoding: equal state, postcode and number, Jaro-Winkler on the street, best `top` of each query.

    addresses: id, state_code, postcode, number, street, lon, lat, and columns to carry along; queries: query_id and the same address columns. Streets
    are compared once for all rows of a block that have them (of whose addresses only the `top` smallest ids can win), and two streets once for all blocks."""
    on = ["state_code", "postcode", "number"]
    a = addresses.select("id", *on, F.lower("street").alias("_s"), "lon", "lat", *carry)
    if top == 1:
        ids = a.groupBy(*on, "_s").agg(F.min("id").alias("id"))  # hashed, where a window would sort every address
    else:
        ids = a.select(*on, "_s", "id").withColumn("_n", F.row_number().over(Window.partitionBy(*on, "_s").orderBy("id"))).where(F.col("_n") <= top).drop("_n")
    q = queries.where("number <> '' AND postcode <> ''").select(query_id, *on, F.lower("street").alias("_q"))
    pairs = q.select(*on, "_q").distinct().join(ids.select(*on, "_s").distinct(), on)
    # the count keeps the filter, and with it the comparison, from going below the aggregate, to the pairs of every block
    once = pairs.groupBy("_q", "_s").agg(F.count("*").alias("_k"))
    scored = once.withColumn("score", F.when(F.col("_k") > 0, text.jaro_winkler("_q", "_s"))).where(F.col("score") >= accept).drop("_k")
    # the best streets of a block's street, with the smallest ids of each
    hits = pairs.join(scored, ["_q", "_s"]).withColumn("_r", F.rank().over(Window.partitionBy(*on, "_q").orderBy(F.desc("score")))).where(F.col("_r") <= top)
    ranked = Window.partitionBy(*on, "_q").orderBy(F.desc("score"), F.asc("id"))
    best = hits.drop("_r").join(ids, [*on, "_s"]).withColumn("_n", F.row_number().over(ranked)).where(F.col("_n") <= top)
    rows = best.drop("_n").join(a, [*on, "_s", "id"]).drop("_s")
    found = q.join(rows, [*on, "_q"])
    return best_per(found, query_id, F.desc("score"), F.asc("id"), keep=top).select(query_id, "id", "score", "lon", "lat", *carry)


def geocode_status(country: Column, number: Column, postcode: Column, error: Column, score: Column, accept: float = 0.80) -> Column:
    """foreign, bad_address, error, no_match, score_reject, ok: the first that holds."""
    return F.when(country.isNotNull() & ~country.isin("US", "PR", "VI", "GU", "AS", "MP"), "foreign").when(text.is_empty(number) | text.is_empty(postcode), "bad_address").when(error.isNotNull(), "error").when(score.isNull(), "no_match").when(score < accept, "score_reject").otherwise("ok")


def pending(rows: DataFrame, retry: tuple[str, ...], categories: tuple[str, ...] | None = None, status: str = "geocode_status", category: str = "category") -> DataFrame:
    """Rows to be geocoded again: with one of the statuses, or never tried; of some categories only, if asked."""
    rows = rows.where(F.col(status).isin(*retry) | F.col(status).isNull())
    return rows if categories is None else rows.where(F.col(category).cast("string").isin(*categories))


def same_city(a: Column, b: Column) -> Column:
    """Six letters of one city's beginning occur in the other; an unknown second city (NULL or empty) contradicts nothing."""
    x, y = F.lower(F.coalesce(a, F.lit(""))), F.lower(F.coalesce(b, F.lit("")))
    return (y == "") | y.contains(F.substring(x, 1, 6)) | x.contains(F.substring(y, 1, 6))


def geocode_checked(addresses: DataFrame, queries: DataFrame, query_id: str, accept: float = 0.80) -> DataFrame:
    """All queries with id, lon and lat of their best address and a status: matched; rejected where the street's score or the city (of the
    address, column `city` on both sides) fails; no_match; no_housenumber; no_zip."""
    best = geocode(addresses.withColumn("_city", F.col("city")), queries, query_id, accept=0.0, carry=("_city",))
    rows = queries.join(best, query_id, "left")
    fine = (F.col("score") >= accept) & same_city(F.col("city"), F.col("_city"))
    status = F.when(text.is_empty(F.col("number")), "no_housenumber").when(text.is_empty(F.col("postcode")), "no_zip").when(F.col("id").isNull(), "no_match").when(fine, "matched").otherwise("rejected")
    return rows.withColumn("status", status).select(query_id, *(F.when(F.col("status") == "matched", F.col(c)).alias(c) for c in ("id", "score", "lon", "lat")), "status")


def narrowing_match(left: DataFrame, right: DataFrame, left_id: str, right_id: str, threshold: float = 0.80) -> DataFrame:
    """Both sides: id, norm, state, zip5, city. A left row looks among the right rows of its state and zip; where there are none, of its state and
    city; where there are none either, of its state. The best sorted-word score (ties to the smaller id) of the set counts; then each right row keeps its best left row."""
    left = left.where("state <> '' AND norm <> ''")
    found, rest = None, left
    for on in (["state", "zip5"], ["state", "city"], ["state"]):
        there = right.select(*on).distinct()
        some = rest.where(" AND ".join(f"{c} <> ''" for c in on)).join(there, on, "left_semi")
        rest = rest.join(some.select(left_id), left_id, "left_anti")
        pairs = fuzzy_join(some, right, on, left_id, right_id, "norm", threshold)
        found = pairs if found is None else found.unionByName(pairs)
    best = best_per(found, left_id, F.desc("score"), F.asc(right_id))
    return best_per(best, right_id, F.desc("score"), F.asc(left_id)).select(right_id, left_id, "score")


@dataclass(frozen=True)
class Tier:
    """One step of a cascade: its pairs of (places, providers), with columns place_id, provider_id and score."""

    name: str
    match: Callable[[DataFrame, DataFrame], DataFrame]
    #: places that had any pair below the threshold don't fall through to the next tier
    stop_on_candidate: Callable[[DataFrame, DataFrame], DataFrame] | None = None


def cascade(places: DataFrame, providers: DataFrame, tiers: list[Tier], place_id: str, provider_id: str, order: Callable[[], list[Column]] | None = None) -> DataFrame:
    """place_id, provider_id, score, method. Matched places and claimed providers leave before the next tier; within a tier several
    places may claim one provider. One row per place: best score, then the smaller provider id."""
    out = None
    for step in tiers:
        found = best_per(step.match(places, providers), place_id, *(order() if order else [F.desc("score")]), F.asc(provider_id)).select(place_id, provider_id, "score", F.lit(step.name).alias("method"))
        found = cut(found)  # later tiers read it several times
        done = found.select(place_id)
        if step.stop_on_candidate is not None:
            done = done.unionByName(step.stop_on_candidate(places, providers).select(place_id))
        places = places.join(done.distinct(), place_id, "left_anti")
        providers = providers.join(found.select(provider_id).distinct(), provider_id, "left_anti")
        out = found if out is None else out.unionByName(found)
    return out


def bed_penalty(score: Column, category: Column, beds: Column, factor: float = 0.75) -> Column:
    """General hospitals (category 01) without beds are likely closed."""
    return score * F.when((F.coalesce(category, F.lit("")) == "01") & (F.coalesce(beds, F.lit(0)) == 0), factor).otherwise(1.0)


def spatial_name_match(pairs: DataFrame, names_left: DataFrame, names_right: DataFrame, left_id: str, right_id: str, threshold: float, k: int = 10, score: Callable = text.max_sort_set_ratio) -> DataFrame:
    """Of the k nearest (ties by id), those whose names reach the threshold, best name first; a (k + 1)-th neighbour is never seen."""
    few = best_per(pairs, left_id, F.asc("distance_m"), F.asc(right_id), keep=k)
    both = few.join(names_left.select(left_id, F.col("name").alias("_a")), left_id).join(names_right.select(right_id, F.col("name").alias("_b")), right_id)
    hit = both.withColumn("score", score(F.col("_a"), F.col("_b")) / 100).where(F.col("score") >= threshold)
    return best_per(hit, left_id, F.desc("score"), F.asc("distance_m"), F.asc(right_id)).select(left_id, right_id, "score", "distance_m")


def top_matches(table: DataFrame, name: str, query: str, k: int = 10) -> DataFrame:
    """The k rows most like a query string."""
    key = [c for c in table.columns if c != name][0]
    return table.withColumn("score", text.max_sort_set_ratio(F.col(name), F.lit(query))).orderBy(F.desc("score"), F.asc(key)).limit(k)


def failure_reason(places: DataFrame, providers: DataFrame, matched: DataFrame, provider_id: str, state: str = "state", zip_: str = "zip5", city: str = "city", name: str = "name") -> DataFrame:
    """Why a provider has no match, as one reason per unmatched provider."""
    rest = providers.join(matched.select(provider_id).distinct(), provider_id, "left_anti")
    states = places.select(F.col(state).alias("_st")).distinct().withColumn("_in_state", F.lit(True))
    zips = places.select(F.col(state).alias("_zs"), F.col(zip_).alias("_z")).where("_z <> ''").distinct().withColumn("_in_zip", F.lit(True))
    cities = places.select(F.col(state).alias("_cs"), F.col(city).alias("_c")).where("_c <> ''").distinct().withColumn("_in_city", F.lit(True))
    rows = rest.join(states, rest[state] == states["_st"], "left").join(zips, (rest[state] == zips["_zs"]) & (rest[zip_] == zips["_z"]), "left").join(cities, (rest[state] == cities["_cs"]) & (rest[city] == cities["_c"]), "left")
    reason = (
        F.when(text.is_empty(F.col(name)), "no_name")
        .when(text.is_empty(rest[state]) | (text.is_empty(rest[zip_]) & text.is_empty(rest[city])), "missing_address")
        .when(F.col("_in_state").isNull(), "no_silver_in_state")
        .when(F.col("_in_zip").isNull() & F.col("_in_city").isNull(), "no_zip_city_overlap")
        .otherwise("name_below_threshold")
    )
    return rows.select(provider_id, reason.alias("reason"))
