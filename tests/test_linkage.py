"""The linkage tiers against plain loops over lists."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from poiforge.functions import text
from poiforge.operators import fuzzy
from poiforge.plans import linkage

PLACE = ("place_id", "name", "display_name", "state", "city", "postcode", "house_number", "lon", "lat")
PROVIDER = ("provider_id", "name", "state", "city", "zip", "address", "category", "beds", "lon", "lat", "re_lon", "re_lat")
WORDS = ("mercy", "grace", "ponce", "norte", "clinic", "center", "luna", "sol", "hca florida", "adventhealth", "hospital", "med")


def sample(seed, n=40):
    rnd = random.Random(seed)
    name = lambda: " ".join(rnd.choice(WORDS) for _ in range(rnd.randrange(1, 4)))
    near = lambda: (round(rnd.uniform(-66.02, -66.0), 5), round(rnd.uniform(18.0, 18.02), 5))
    zips = ("00901", "00902", "", None)
    places, providers = [], []
    for i in range(n):
        shown = rnd.choice(["", "Somewhere, PR 00903", "Clinic, 45 Calle Sol, Ponce 00902"])
        lon, lat = near() if rnd.random() < 0.9 else (None, None)
        places.append((i, rnd.choice([name(), name(), "", None]), shown, rnd.choice(["PR", "fl", "", None]), rnd.choice(["Ponce", "PONCE", "", None]), rnd.choice(zips), rnd.choice(["12", "14-A", None]), lon, lat))
        lon, lat = near() if rnd.random() < 0.6 else (None, None)
        again = near() if lon is None and rnd.random() < 0.7 else (None, None)
        providers.append((i, rnd.choice([name(), name(), name(), None]), rnd.choice(["PR", "FL"]), rnd.choice(["Ponce", None]), rnd.choice([z for z in zips if z]) + rnd.choice(["", "-1234"]), rnd.choice(["12 Main", "14 Sol", "None"]), rnd.choice(["01", "02"]), rnd.choice([0, 10, None]), lon, lat, *again))
    return places, providers


def norm(name):
    """Normaliser A for ASCII names without the endings that the samples lack."""
    words = [text.ABBREVIATIONS_A.get(w, w) for w in re.sub("[^a-z0-9 ]", " ", (name or "").lower()).split() if w not in text.STOP_WORDS]
    out = " ".join(words)
    out = re.sub("^hospital ", "", out)
    out = re.sub("( hospital and medical center| hospital and medical centre| hospital)$", "", out)
    return re.sub("( healthcare| health care| health system| health sciences| health science)$", "", out).strip()


def brand(n):
    for p in text.BRAND_PREFIXES:
        if n.startswith(p):
            return n[len(p) :] or n
    return n


def plain_places(rows):
    out = []
    for r in (dict(zip(PLACE, r, strict=True)) for r in rows):
        shown = r["display_name"]
        zip5 = (r["postcode"] or "")[:5]
        number = re.match(r"\d+", r["house_number"] or "")
        found = number or re.search(r"(?:,\s*|^)(\d{2,4})\s", shown) or re.search(r"\bPR-(\d{2,4})\b", shown)
        five = re.search(r"\b(\d{5})\b", shown)
        out.append({"id": r["place_id"], "norm": norm(r["name"]) or norm(shown), "state": (r["state"] or "").upper()[:2], "city": (r["city"] or "").upper(), "zip": zip5 if len(zip5) == 5 else five[1] if five else "", "num": "" if not found else found[0] if number else found[1], "shown": shown, "lon": r["lon"], "lat": r["lat"]})
    return out


def plain_providers(rows):
    out = []
    for r in (dict(zip(PROVIDER, r, strict=True)) for r in rows):
        number = re.match(r"\d+", r["address"])
        out.append({"id": r["provider_id"], "norm": norm(r["name"]), "state": r["state"], "city": (r["city"] or "").upper(), "zip": r["zip"][:5], "num": number[0] if number else "", "general": int(r["category"] == "01"), "beds": r["beds"] or 0, "lon": r["lon"], "lat": r["lat"], "re_lon": r["re_lon"], "re_lat": r["re_lat"]})
    return out


def metres(p, q):
    x = lambda lon: math.radians(lon) * 6378137.0
    y = lambda lat: math.log(math.tan(math.radians(lat) / 2 + math.pi / 4)) * 6378137.0
    return math.hypot(x(p[0]) - x(q[0]), y(p[1]) - y(q[1]))


sort, sets = (lambda a, b: text.token_sort(a, b) / 100), (lambda a, b: text.token_set(a, b) / 100)
both = lambda a, b: max(sort(a, b), sets(a, b))


def best(found):
    """found: (place, keys to be largest, provider, score, method)."""
    out = {}
    for p, keys, q, s, how in sorted(found, key=lambda f: (f[0], tuple(-k for k in f[1]), f[2])):
        out.setdefault(p, (q, round(s, 6), how))
    return out


def near_tier(places, providers, at, radius, kernel, bar, how):
    found = []
    for p in places:
        if p["norm"] and p["lon"] is not None:
            around = sorted((metres((p["lon"], p["lat"]), at(q)), q["id"]) for q in providers if at(q)[0] is not None)[:10]
            for d, i in around:
                q = next(x for x in providers if x["id"] == i)
                if d <= radius and q["norm"] is not None and kernel(p["norm"], q["norm"]) >= bar:
                    found.append((p["id"], (kernel(p["norm"], q["norm"]), q["general"], q["beds"], -d), i, kernel(p["norm"], q["norm"]), how))
    return best(found)


def tier1(places, providers):
    return near_tier(places, providers, lambda q: (q["lon"], q["lat"]), 200, both, 0.55, "spatial")


def tier5(places, providers):
    return near_tier(places, [q for q in providers if q["lon"] is None], lambda q: (q["re_lon"], q["re_lat"]), 500, sets, 0.70, "census_spatial")


def tier2(places, providers):
    low = lambda s, q: s * (0.75 if q["general"] and not q["beds"] else 1)
    named = [(p, q) for p in places for q in providers if p["norm"] and q["norm"]]
    keys = lambda s, p, q: (low(s, q), q["general"], sets(p["norm"], q["norm"]), q["beds"])
    pool, done = [], set()

    def block(fits, branded=False):
        hit = set()
        for p, q in named:
            if p["id"] not in done and fits(p, q):
                s = both(p["norm"], q["norm"])
                if low(s, q) >= 0.8:
                    hit.add(p["id"])
                if branded and s < 0.8:
                    s = max(s, both(brand(p["norm"]), brand(q["norm"])))
                if s >= 0.8 and low(s, q) >= 0.8:
                    pool.append((p["id"], keys(s, p, q), q["id"], s, "zip_fuzzy"))
        return hit

    five = lambda p: len(p["zip"]) == 5
    done |= block(lambda p, q: five(p) and p["zip"] == q["zip"] and p["state"] in ("", q["state"]), branded=True)
    done |= block(lambda p, q: five(p) and p["state"] == q["state"] and p["city"] == q["city"] != "")
    block(lambda p, q: p["state"] == q["state"])
    out = best(pool)

    def by_set(fits, bar):
        found = [(p["id"], (s, sort(p["norm"], q["norm"]), q["general"], q["beds"]), q["id"], s, "zip_fuzzy") for p, q in named if p["id"] not in out and fits(p, q) and (s := sets(p["norm"], q["norm"])) >= bar]
        out.update(best(found))

    shown = lambda p: (re.search(linkage.STATE_IN_DISPLAY, p["shown"]) or ["", ""])[1]
    by_set(lambda p, q: p["state"] == "" and shown(p) == q["state"], 0.9)
    by_set(lambda p, q: p["state"] == q["state"] and p["city"] == q["city"] != "", 0.8)
    return out


def tier3(places, providers):
    found = []
    for p in places:
        if p["num"] and len(p["zip"]) == 5 and p["norm"]:
            there = [q for q in providers if q["zip"] == p["zip"] and q["num"] == p["num"]]
            how = "addr_zip" if there else "addr_city"
            for q in there or [q for q in providers if q["num"] == p["num"] and q["city"] == p["city"] != ""]:
                s = sort(p["norm"], q["norm"]) if q["norm"] else 0
                if s >= 0.5:
                    facts = (q["general"], q["beds"]) if there else (0, 0)
                    found.append((p["id"], (s, sets(p["norm"], q["norm"]), *facts), q["id"], s, how))
    return best(found)


def tier4(places, providers):
    found = [(p["id"], (s, sort(p["norm"], q["norm"]), q["general"], q["beds"]), q["id"], s, "name_zip") for p in places for q in providers if p["norm"] and q["norm"] and p["zip"] == q["zip"] and len(p["zip"]) == 5 and (s := sets(p["norm"], q["norm"])) >= 0.75]
    return best(found)


def link(places, providers):
    out = {}
    for tier in (tier1, tier2, tier3, tier4, tier5):
        found = tier(places, providers)
        out |= found
        taken = {q for q, *_ in found.values()}
        places, providers = [p for p in places if p["id"] not in found], [q for q in providers if q["id"] not in taken]
    return out


def frames(spark, places, providers):
    a = spark.createDataFrame(places, "place_id long, name string, display_name string, state string, city string, postcode string, house_number string, lon double, lat double")
    b = spark.createDataFrame(providers, "provider_id long, name string, state string, city string, zip string, address string, category string, beds long, lon double, lat double, re_lon double, re_lat double")
    return a, b


def shown(df):
    return {r.place_id: (r.provider_id, round(r.score, 6), r.method) for r in df.collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_tiers_equal_plain_loops(spark, seed):
    rows = sample(seed)
    a, b = frames(spark, *rows)
    a, b = linkage.ready_places(a), linkage.ready_providers(b)
    places, providers = plain_places(rows[0]), plain_providers(rows[1])
    assert {r.place_id: (r.norm, r.state, r.city, r.zip5, r.number) for r in a.collect()} == {p["id"]: (p["norm"], p["state"], p["city"], p["zip"], p["num"]) for p in places}
    for mine, plain in zip(linkage.TIERS, (tier1, tier2, tier3, tier4, tier5), strict=True):
        assert shown(mine(a, b)) == plain(places, providers), mine.__name__
    got = shown(linkage.link(a, b))
    assert got == link(places, providers) and len({how for *_, how in got.values()}) > 1


def test_linkage_of_empty_tables(spark):
    a, b = frames(spark, *sample(3, 5))
    assert linkage.link_providers(a.limit(0), b).count() == 0
    assert linkage.link_providers(a, b.limit(0)).count() == 0


def test_normalised_names_keep_the_plan_small(spark):
    df = spark.createDataFrame([("St. Mary Hospital",)], "name string")
    plan = df.select(text.strip_brand(text.normalize_name(F.col("name"))), text.normalize_name_plain(F.col("name")))
    assert len(plan._jdf.queryExecution().optimizedPlan().toString()) < 20_000


@pytest.mark.parametrize("kernel", [text.token_sort_ratio, text.token_set_ratio, text.max_sort_set_ratio])
@pytest.mark.parametrize("threshold", [0.5, 0.8, 1.0])
def test_bounds_of_the_join_lose_no_pair(spark, kernel, threshold):
    rnd = random.Random(7)
    name = lambda: " ".join("".join(rnd.choice("abc") for _ in range(rnd.randrange(1, 5))) for _ in range(rnd.randrange(1, 4)))
    df = spark.createDataFrame([("x", name()) for _ in range(60)], "block string, name string")
    rows = lambda flag: sorted((r._a, r._b, round(r.score, 9)) for r in fuzzy.name_matches(df, df, ["block"], "name", threshold, kernel, flag).collect())
    assert rows(True) == rows(False)
