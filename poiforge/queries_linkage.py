"""Queries of the provider linkage, with SQL that scores names by its own longest common subsequence.

Places are made from customers, providers from suppliers; their names are plain lower-case words, of which the normaliser changes underscores only.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from poiforge import catalog as c
from poiforge.functions import text
from poiforge.operators import fuzzy
from poiforge.plans import gold, linkage

_WORDS, _STATES = ("north", "south", "general", "central"), ("PR", "FL", "TX", "")


def _pick(values, key):
    return F.element_at(F.array(*(F.lit(v) for v in values)), (F.col(key) % len(values) + 1).cast("int"))


def _kinds(key, options):
    out = options[-1]
    for i in reversed(range(len(options) - 1)):
        out = F.when(F.col(key) % len(options) == i, options[i]).otherwise(out)
    return out


def _zip(key):
    return F.lpad((F.col("n_nationkey") * 10 + F.col(key) % 3).cast("string"), 5, "0")


def _nations(spark, sf):
    return c.read(spark, sf, "nation").join(c.read(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", F.lower("n_name").alias("n"), F.lower("r_name").alias("r"))


def places(spark, sf):
    k = F.col("c_custkey")
    rows = c.read(spark, sf, "customer").join(_nations(spark, sf), F.col("c_nationkey") == F.col("n_nationkey"))
    name = _kinds("c_custkey", [F.concat("n", F.lit(" "), _pick(_WORDS[:3], "n_nationkey")), F.concat(F.lit("hca florida "), "n"), F.concat("n", F.lit(" "), "r"), F.concat(_pick(_WORDS[:2], "c_custkey"), F.lit(" center "), "n"), F.substring(F.col("n"), F.lit(1), F.length("n") - 1)])
    return rows.select(
        k.alias("place_id"), name.alias("name"), F.when(k % 8 == 3, F.concat(F.lit("Anywhere, PR "), _zip("c_custkey"))).otherwise("").alias("display_name"), _pick(_STATES, "c_custkey").alias("state"), F.concat(F.lit("City"), (F.col("n_nationkey") % 5).cast("string")).alias("city"),
        F.when(k % 6 != 0, _zip("c_custkey")).alias("postcode"), (k % 20 + 10).cast("string").alias("house_number"), c.lon("c_custkey").alias("lon"), c.lat("c_custkey").alias("lat"),
    )


def providers(spark, sf):
    k = F.col("s_suppkey")
    rows = c.read(spark, sf, "supplier").join(_nations(spark, sf), F.col("s_nationkey") == F.col("n_nationkey"))
    name = _kinds("s_suppkey", [F.concat("n", F.lit(" "), _pick(_WORDS, "n_nationkey")), F.concat(F.lit("adventhealth "), "n"), F.col("n"), F.concat(_pick(_WORDS, "s_suppkey"), F.lit(" center "), "n"), F.concat("n", F.lit(" "), "r", F.lit(" clinic"))])
    known = k % 5 != 0
    return rows.select(
        k.alias("provider_id"), name.alias("name"), _pick(_STATES[:3], "s_suppkey").alias("state"), F.concat(F.lit("CITY"), (F.col("n_nationkey") % 5).cast("string")).alias("city"), _zip("s_suppkey").alias("zip"), F.concat((k % 20 + 10).cast("string"), F.lit(" Main St")).alias("address"),
        F.when(k % 3 == 0, "01").otherwise("02").alias("category"), (k % 4 * 10).alias("beds"), F.when(known, c.lon("s_suppkey")).alias("lon"), F.when(known, c.lat("s_suppkey")).alias("lat"), c.lon("s_suppkey").alias("re_lon"), c.lat("s_suppkey").alias("re_lat"),
    )


def _list(values):
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


_ZIP = "lpad(({0} * 10 + {1} % 3)::VARCHAR, 5, '0')"
#: pl and pr: the ready places and providers.
SIDES = f"""nr AS (SELECT n_nationkey, replace(lower(n_name), '_', ' ') AS n, lower(r_name) AS r FROM nation JOIN region ON n_regionkey = r_regionkey),
pl AS (SELECT c_custkey AS place_id, CASE c_custkey % 5 WHEN 0 THEN n || ' ' || {_list(_WORDS[:3])}[n_nationkey % 3 + 1] WHEN 1 THEN 'hca florida ' || n WHEN 2 THEN n || ' ' || r WHEN 3 THEN {_list(_WORDS[:2])}[c_custkey % 2 + 1] || ' center ' || n ELSE substr(n, 1, length(n) - 1) END AS a,
CASE WHEN c_custkey % 8 = 3 THEN 'Anywhere, PR ' || {_ZIP.format("n_nationkey", "c_custkey")} ELSE '' END AS shown, {_list(_STATES)}[c_custkey % 4 + 1] AS state, 'CITY' || n_nationkey % 5 AS city,
CASE WHEN c_custkey % 6 <> 0 OR c_custkey % 8 = 3 THEN {_ZIP.format("n_nationkey", "c_custkey")} ELSE '' END AS zip, (c_custkey % 20 + 10)::VARCHAR AS num, {c.LON.format("c_custkey")} AS lon, {c.LAT.format("c_custkey")} AS lat FROM customer JOIN nr ON c_nationkey = n_nationkey),
pr AS (SELECT s_suppkey AS provider_id, CASE s_suppkey % 5 WHEN 0 THEN n || ' ' || {_list(_WORDS)}[n_nationkey % 4 + 1] WHEN 1 THEN 'adventhealth ' || n WHEN 2 THEN n WHEN 3 THEN {_list(_WORDS)}[s_suppkey % 4 + 1] || ' center ' || n ELSE n || ' ' || r || ' clinic' END AS b, {_list(_STATES[:3])}[s_suppkey % 3 + 1] AS state,
'CITY' || n_nationkey % 5 AS city, {_ZIP.format("n_nationkey", "s_suppkey")} AS zip, (s_suppkey % 20 + 10)::VARCHAR AS num, (s_suppkey % 3 = 0)::INTEGER AS general, s_suppkey % 4 * 10 AS beds, s_suppkey % 5 <> 0 AS known, {c.LON.format("s_suppkey")} AS lon, {c.LAT.format("s_suppkey")} AS lat FROM supplier JOIN nr ON s_nationkey = n_nationkey)"""

_LCS = """list_reduce(range(1, length(b) + 1), lambda acc, j: list_append(acc, CASE WHEN substr(a, i + 1, 1) = substr(b, j, 1) THEN row[j] + 1 ELSE greatest(row[j + 1], acc[j]) END), [0::BIGINT])"""


def scores(pairs: str) -> str:
    """CTEs from a CTE of distinct (a, b) to sc (a, b, sort, set), common out of 100."""
    words = lambda x: f"list_sort(list_filter(string_split({x}, ' '), lambda w: w <> ''))"
    join = lambda x: f"array_to_string({x}, ' ')"
    return f"""w AS (SELECT a, b, {join(words("a"))} AS sa, {join(words("b"))} AS sb, list_sort(list_distinct({words("a")})) AS ta, list_sort(list_distinct({words("b")})) AS tb FROM {pairs}),
u AS (SELECT *, {join("list_filter(ta, lambda x: list_contains(tb, x))")} AS common, {join("list_filter(ta, lambda x: NOT list_contains(tb, x))")} AS ra, {join("list_filter(tb, lambda x: NOT list_contains(ta, x))")} AS rb FROM w),
v AS (SELECT *, trim(common || ' ' || ra) AS l, trim(common || ' ' || rb) AS r FROM u),
need AS (SELECT sa AS a, sb AS b FROM v UNION SELECT l, r FROM v),
dp(a, b, i, row) AS (SELECT a, b, 0, list_transform(range(length(b) + 1), lambda x: 0::BIGINT) FROM need UNION ALL SELECT a, b, i + 1, {_LCS} FROM dp WHERE i < length(a)),
lcs AS (SELECT a, b, 200.0::DOUBLE * row[length(b) + 1] / (length(a) + length(b)) AS ratio FROM dp WHERE i = length(a)),
sc AS (SELECT v.a, v.b, x.ratio AS sort, CASE WHEN len(ta) = 0 OR len(tb) = 0 THEN 0 WHEN common <> '' AND (ra = '' OR rb = '') THEN 100
WHEN common <> '' THEN greatest(y.ratio, 200.0::DOUBLE * length(common) / (length(common) + length(l)), 200.0::DOUBLE * length(common) / (length(common) + length(r))) ELSE y.ratio END::DOUBLE AS set
FROM v JOIN lcs x ON x.a = sa AND x.b = sb JOIN lcs y ON y.a = l AND y.b = r)"""


def _sides(spark, sf):
    return linkage.ready_places(places(spark, sf)), linkage.ready_providers(providers(spark, sf))


def _shown(found):
    return found.select("place_id", "provider_id", F.round("score", 4).alias("score"), "method")


_MERC = c.MERC.format(a="pl", b="pr")
_BEST = "QUALIFY row_number() OVER (PARTITION BY place_id ORDER BY {0}, provider_id) = 1"


@c.query(f"""WITH RECURSIVE {SIDES}, near AS (SELECT place_id, provider_id, a, b, general, beds, {_MERC} AS d FROM pl, pr WHERE known AND {_MERC} <= 4000 QUALIFY row_number() OVER (PARTITION BY place_id ORDER BY {_MERC}, provider_id) <= 10),
names AS (SELECT DISTINCT a, b FROM near), {scores("names")}
SELECT place_id, provider_id, round(greatest(sort, set) / 100, 4) AS score, 'spatial' AS method FROM near JOIN sc USING (a, b) WHERE greatest(sort, set) >= 55 {_BEST.format("greatest(sort, set) DESC, general DESC, beds DESC, d")}""")
def link_tier1(spark, sf):
    a, b = _sides(spark, sf)
    return _shown(linkage.tier1(a, b, radius=4000.0))


_BRAND = "regexp_replace({0}, '^(hca florida |adventhealth )', '')"


@c.query(f"""WITH RECURSIVE {SIDES}, zp AS (SELECT place_id, provider_id, a, b FROM pl JOIN pr USING (zip) WHERE length(zip) = 5 AND (pl.state = pr.state OR pl.state = '')),
names AS (SELECT DISTINCT a, b FROM zp UNION SELECT DISTINCT {_BRAND.format("a")}, {_BRAND.format("b")} FROM zp UNION SELECT DISTINCT a, b FROM pl JOIN pr ON pl.state = pr.state UNION SELECT DISTINCT a, b FROM pl, pr WHERE pl.state = '' AND shown <> '' AND pr.state = 'PR'), {scores("names")},
x AS (SELECT a, b, greatest(sort, set) AS s, set, sort FROM sc),
zs AS (SELECT zp.*, x.s, x.set, y.s AS s2 FROM zp JOIN x USING (a, b) JOIN x y ON y.a = {_BRAND.format("zp.a")} AND y.b = {_BRAND.format("zp.b")}),
low AS (SELECT provider_id, CASE WHEN general = 1 AND beds = 0 THEN 0.75 ELSE 1.0 END::DOUBLE AS f, general, beds FROM pr),
acc AS (SELECT DISTINCT place_id FROM zs JOIN low USING (provider_id) WHERE s >= 80 AND s * f >= 80 - 1e-9),
city AS (SELECT place_id, provider_id, x.s, x.set FROM pl JOIN pr USING (state, city) JOIN x USING (a, b) WHERE length(pl.zip) = 5 AND place_id NOT IN (FROM acc)),
acc2 AS (SELECT place_id FROM acc UNION SELECT place_id FROM city JOIN low USING (provider_id) WHERE s >= 80 AND s * f >= 80 - 1e-9),
st AS (SELECT place_id, provider_id, x.s, x.set FROM pl JOIN pr USING (state) JOIN x USING (a, b) WHERE state <> '' AND place_id NOT IN (FROM acc2)),
pool AS (SELECT place_id, provider_id, CASE WHEN s >= 80 THEN s ELSE greatest(s, s2) END AS s, set FROM zs UNION SELECT place_id, provider_id, s, set FROM city UNION SELECT place_id, provider_id, s, set FROM st),
m1 AS (SELECT place_id, provider_id, s FROM pool JOIN low USING (provider_id) WHERE s >= 80 AND s * f >= 80 - 1e-9 {_BEST.format("s * f DESC, general DESC, set DESC, beds DESC")}),
m2 AS (SELECT place_id, provider_id, x.set AS s FROM pl JOIN pr ON pl.state = '' AND shown <> '' AND pr.state = 'PR' JOIN x USING (a, b) WHERE x.set >= 90 AND place_id NOT IN (SELECT place_id FROM m1) {_BEST.format("x.set DESC, sort DESC, general DESC, beds DESC")}),
m3 AS (SELECT place_id, provider_id, x.set AS s FROM pl JOIN pr USING (state, city) JOIN x USING (a, b) WHERE state <> '' AND x.set >= 80 AND place_id NOT IN (SELECT place_id FROM m1) {_BEST.format("x.set DESC, sort DESC, general DESC, beds DESC")})
SELECT place_id, provider_id, round(s / 100, 4) AS score, 'zip_fuzzy' AS method FROM (FROM m1 UNION ALL FROM m2 UNION ALL FROM m3)""")
def link_tier2(spark, sf):
    return _shown(linkage.tier2(*_sides(spark, sf)))


@c.query(f"""WITH RECURSIVE {SIDES}, z AS (SELECT place_id, provider_id, a, b, general, beds, 'addr_zip' AS method FROM pl JOIN pr USING (zip, num) WHERE length(zip) = 5),
t AS (FROM z UNION ALL SELECT place_id, provider_id, a, b, 0, 0, 'addr_city' FROM pl JOIN pr USING (num, city) WHERE length(pl.zip) = 5 AND place_id NOT IN (SELECT place_id FROM z)), names AS (SELECT DISTINCT a, b FROM t), {scores("names")}
SELECT place_id, provider_id, round(sort / 100, 4) AS score, method FROM t JOIN sc USING (a, b) WHERE sort >= 50 {_BEST.format("sort DESC, set DESC, general DESC, beds DESC")}""")
def link_tier3(spark, sf):
    return _shown(linkage.tier3(*_sides(spark, sf)))


@c.query(f"""WITH RECURSIVE {SIDES}, t AS (SELECT place_id, provider_id, a, b, general, beds FROM pl JOIN pr USING (zip) WHERE length(zip) = 5), names AS (SELECT DISTINCT a, b FROM t), {scores("names")}
SELECT place_id, provider_id, round(set / 100, 4) AS score, 'name_zip' AS method FROM t JOIN sc USING (a, b) WHERE set >= 75 {_BEST.format("set DESC, sort DESC, general DESC, beds DESC")}""")
def link_tier4(spark, sf):
    return _shown(linkage.tier4(*_sides(spark, sf)))


@c.query(f"""WITH RECURSIVE {SIDES}, near AS (SELECT place_id, provider_id, a, b, general, beds, {_MERC} AS d FROM pl, pr WHERE NOT known AND {_MERC} <= 9000 QUALIFY row_number() OVER (PARTITION BY place_id ORDER BY {_MERC}, provider_id) <= 10),
names AS (SELECT DISTINCT a, b FROM near), {scores("names")}
SELECT place_id, provider_id, round(set / 100, 4) AS score, 'census_spatial' AS method FROM near JOIN sc USING (a, b) WHERE set >= 70 {_BEST.format("set DESC, general DESC, beds DESC, d")}""")
def link_tier5(spark, sf):
    a, b = _sides(spark, sf)
    return _shown(linkage.tier5(a, b, radius=9000.0))


def link_all(spark, sf):
    """All tiers in turn; tests compare it with a plain version over lists."""
    return _shown(linkage.link(*_sides(spark, sf)))


c.WITHOUT_SQL["link_all"] = link_all


@c.query(f"""WITH RECURSIVE n AS (SELECT DISTINCT p_brand, p_name FROM part WHERE p_name IS NOT NULL), names AS (SELECT DISTINCT x.p_name AS a, y.p_name AS b FROM n x JOIN n y USING (p_brand) WHERE x.p_name < y.p_name), {scores("names")}
SELECT p_brand, sc.a, sc.b, round(greatest(sort, set) / 100, 4) AS score FROM n x JOIN n y USING (p_brand) JOIN sc ON sc.a = x.p_name AND sc.b = y.p_name WHERE greatest(sort, set) >= 80""")
def name_matches_block(spark, sf):
    """Names of one brand alike by words in any order or by a common set of words: max_sort_set at 0.8, with the bounds of the join."""
    names = c.read(spark, sf, "part").select("p_brand", "p_name")
    found = fuzzy.name_matches(names, names, ["p_brand"], "p_name", 0.8, text.max_sort_set_ratio).where("_a < _b")
    return found.select("p_brand", F.col("_a").alias("a"), F.col("_b").alias("b"), F.round("score", 4).alias("score"))


_BRANDS = f"""l AS (SELECT p_partkey AS l, p_name AS n, p_brand AS b, p_size::VARCHAR AS z FROM part WHERE p_partkey % 2 = 0), r AS (SELECT p_partkey AS r, p_name AS n, p_brand AS b, p_size::VARCHAR AS z FROM part WHERE p_partkey % 2 = 1),
names AS (SELECT DISTINCT l.n AS a, r.n AS b FROM l JOIN r USING (b)), {scores("names")},
p AS (SELECT l, r, l.b AS brand, l.z AS lz, r.z AS rz, sort FROM l JOIN r USING (b) JOIN sc ON sc.a = l.n AND sc.b = r.n)"""
_TOP = "QUALIFY row_number() OVER (PARTITION BY l ORDER BY sort DESC, r) = 1"


@c.query(f"""WITH RECURSIVE {_BRANDS}, t1 AS (SELECT l, r FROM p WHERE lz = rz AND sort >= 70 {_TOP}), t2 AS (SELECT l, r FROM p WHERE sort >= 70 AND l NOT IN (SELECT l FROM t1) AND r NOT IN (SELECT r FROM t1) {_TOP})
SELECT l, r, 'size' AS method FROM t1 UNION ALL SELECT l, r, 'brand' FROM t2""")
def tier_cascade(spark, sf):
    """Even parts against odd ones by sorted words at 0.7: first in blocks of brand and size, then of the brand."""
    p = c.read(spark, sf, "part").select("p_partkey", "p_name", "p_brand", F.col("p_size").cast("string").alias("p_size"))
    left, right = p.where("p_partkey % 2 = 0").withColumnRenamed("p_partkey", "l"), p.where("p_partkey % 2 = 1").withColumnRenamed("p_partkey", "r")
    block = lambda *on: lambda a, b: fuzzy.fuzzy_join(a, b, list(on), "l", "r", "p_name", 0.7)
    found = fuzzy.cascade(left, right, [fuzzy.Tier("size", block("p_brand", "p_size")), fuzzy.Tier("brand", block("p_brand"))], "l", "r")
    return found.select("l", "r", "method")


@c.query(f"""WITH RECURSIVE {_BRANDS}, t1 AS (SELECT l, r FROM p WHERE lz = rz AND sort >= 75 {_TOP}), t2 AS (SELECT l, r FROM p WHERE sort >= 75 AND l NOT IN (SELECT l FROM p WHERE lz = rz) AND r NOT IN (SELECT r FROM t1) {_TOP})
SELECT l, r, 'state_zip5' AS method FROM t1 UNION ALL SELECT l, r, 'state' FROM t2""")
def hospital_attribute_cascade(spark, sf):
    """Even parts against all odd ones: a part falls through only where it had no candidate at all in the block before."""
    p = c.read(spark, sf, "part").select("p_partkey", F.col("p_name").alias("name"), F.col("p_brand").alias("state"), F.col("p_size").cast("string").alias("zip5"), F.lit("").alias("city"))
    left, right = p.where("p_partkey % 2 = 0").withColumnRenamed("p_partkey", "lifeline_id"), p.where("p_partkey % 2 = 1").withColumnRenamed("p_partkey", "authority_id")
    found = gold.hospital_attributes(left, right, 0.75)
    return found.select(F.col("lifeline_id").alias("l"), F.col("authority_id").alias("r"), "method")
