"""Name, address and similarity functions. Column expressions where Catalyst can express them; Arrow UDFs for the string kernels."""

from __future__ import annotations

import unicodedata

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Words and suffixes that the normalisers must treat exactly so.
STOP_WORDS = ("de", "del", "la", "el", "los", "las")
ABBREVIATIONS_A = {"ctr": "center", "med": "medical", "univ": "university", "dept": "department", "st": "saint", "hosp": "hospital", "mun": "municipal", "munic": "municipal"}
ABBREVIATIONS_B = {"ctr": "center", "med": "medical", "univ": "university", "dept": "department"}
HOSPITAL_SUFFIXES = (" hospital and medical center", " hospital and medical centre", " hospital")
HEALTH_SUFFIXES = (" healthcare", " health care", " health system", " health sciences", " health science")
BRAND_PREFIXES = ("hca florida ", "hca healthcare ", "hca ", "adventhealth by florida hospital ", "adventhealth ", "florida hospital ", "orlando health ", "baycare ", "uf health ", "university of florida health ")
EMPTY_WORDS = ("", "nan", "none", "null")


# -- Arrow UDFs ---------------------------------------------------------------------------------------------------------


@F.pandas_udf(T.StringType())
def ascii_fold(s: pd.Series) -> pd.Series:
    """NFKD without what isn't ASCII."""
    return s.map(lambda x: x if x is None or x.isascii() else unicodedata.normalize("NFKD", x).encode("ascii", "ignore").decode())


def lcs_length(a: str, b: str) -> int:
    """Longest common subsequence, one machine word (or big integer) per character of b."""
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        match = row & masks.get(c, 0)
        row = ((row + match) | (row - match)) & full
    return len(a) - row.bit_count()


def indel_ratio(a: str, b: str) -> float:
    """100 * 2 * LCS / (|a| + |b|); two empty strings are equal."""
    n = len(a) + len(b)
    return 100.0 * 2 * lcs_length(a, b) / n if n else 100.0


def token_sort(a: str, b: str) -> float:
    return indel_ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set(a: str, b: str) -> float:
    """The best of the shared tokens against each side, and of both sides with the shared part in front; 0 if a side is empty."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both = " ".join(sorted(x & y))
    if both and (x <= y or y <= x):
        return 100.0
    left, right = (" ".join(t for t in (both, " ".join(sorted(rest))) if t) for rest in (x - y, y - x))
    found = [indel_ratio(left, right)]
    if both:
        found += [indel_ratio(both, left), indel_ratio(both, right)]
    return max(found)


def jaro_winkler_similarity(a: str, b: str) -> float:
    """Over characters (some databases compare bytes). Jaro, raised by a common prefix of up to 4 characters with weight 0.1 where it exceeds 0.7; 0 for two empty strings."""
    if not a or not b:
        return 0.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    used, hits = [False] * len(b), []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not used[j] and b[j] == c:
                used[j] = True
                hits.append(c)
                break
    m = len(hits)
    if not m:
        return 0.0
    swapped = sum(x != y for x, y in zip(hits, (c for c, u in zip(b, used, strict=True) if u), strict=True)) // 2
    jaro = (m / len(a) + m / len(b) + (m - swapped) / m) / 3
    if jaro <= 0.7:
        return jaro
    prefix = 0
    for x, y in zip(a[:4], b[:4], strict=False):
        if x != y:
            break
        prefix += 1
    return jaro + prefix * 0.1 * (1 - jaro)


#: Pairs that one vectorised step compares, and characters of a string from which it is compared alone.
STEP, LONG = 8192, 96


def _characters(strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(code points, one row a string, padded; lengths)."""
    n = np.fromiter(map(len, strings), np.int64, len(strings))
    out = np.zeros((len(strings), max(1, int(n.max(initial=0)))), np.uint32)
    out[np.arange(out.shape[1]) < n[:, None]] = np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), np.uint32)
    return out, n


def lcs_lengths(a: list[str], b: list[str]) -> np.ndarray:
    """Longest common subsequence of every pair: one row of the table at a time, for all pairs at once."""
    out = np.zeros(len(a), np.int64)
    long = np.array([len(x) > LONG or len(y) > LONG for x, y in zip(a, b, strict=True)], bool)
    for i in np.flatnonzero(long).tolist():
        out[i] = lcs_length(a[i], b[i])
    some = np.flatnonzero(~long)
    # pairs of like lengths together
    some = some[np.argsort([len(a[i]) + len(b[i]) for i in some.tolist()], kind="stable")]
    for at in range(0, len(some), STEP):
        part = some[at : at + STEP].tolist()
        x, n = _characters([a[i] for i in part])
        y, m = _characters([b[i] for i in part])
        y[np.arange(y.shape[1]) >= m[:, None]] = 0xFFFFFFFF
        row = np.zeros((len(part), y.shape[1] + 1), np.int16)
        for i in range(int(n.max(initial=0))):
            hit = (y == x[:, i : i + 1]) & (i < n)[:, None]
            np.maximum.accumulate(np.maximum(row[:, 1:], row[:, :-1] + hit), axis=1, out=row[:, 1:])
        out[part] = row[:, -1]
    return out


def indel_ratios(a: list[str], b: list[str]) -> np.ndarray:
    n = np.array([len(x) + len(y) for x, y in zip(a, b, strict=True)], float)
    return np.where(n > 0, 100.0 * 2 * lcs_lengths(a, b) / np.maximum(n, 1), 100.0)


def _sorted(s: str) -> str:
    return " ".join(sorted(s.split()))


def token_sorts(a: list[str], b: list[str]) -> np.ndarray:
    return indel_ratios(list(map(_sorted, a)), list(map(_sorted, b)))


def token_sets(a: list[str], b: list[str]) -> np.ndarray:
    """token_set of every pair. The shared words begin both sides, so against them the longest common subsequence is the shared part."""
    sets = [(set(x.split()), set(y.split())) for x, y in zip(a, b, strict=True)]
    shared = [" ".join(sorted(x & y)) for x, y in sets]
    sides = [[" ".join(t for t in (both, " ".join(sorted(p[k] - p[1 - k]))) if t) for p, both in zip(sets, shared, strict=True)] for k in (0, 1)]
    n, left, right = (np.fromiter(map(len, x), np.int64, len(a)) for x in (shared, *sides))
    best = indel_ratios(*sides)
    for side in (left, right):
        best = np.where(n > 0, np.maximum(best, 200.0 * n / np.maximum(n + side, 1)), best)
    subset = np.array([bool(x) and bool(y) and bool(x & y) and (x <= y or y <= x) for x, y in sets], bool)
    empty = np.array([not x or not y for x, y in sets], bool)
    return np.where(empty, 0.0, np.where(subset, 100.0, best))


def jaro_winklers(a: list[str], b: list[str]) -> np.ndarray:
    """jaro_winkler_similarity of every pair: the characters of the first strings in turn, for all pairs at once."""
    out = np.zeros(len(a))
    long = np.array([len(x) > LONG or len(y) > LONG for x, y in zip(a, b, strict=True)], bool)
    for i in np.flatnonzero(long).tolist():
        out[i] = jaro_winkler_similarity(a[i], b[i])
    some = np.flatnonzero(~long)
    some = some[np.argsort([len(a[i]) + len(b[i]) for i in some.tolist()], kind="stable")]
    for at in range(0, len(some), STEP):
        part = some[at : at + STEP].tolist()
        x, n = _characters([a[i] for i in part])
        y, m = _characters([b[i] for i in part])
        rows, place = np.arange(len(part)), np.arange(y.shape[1])
        reach = np.maximum(np.maximum(n, m) // 2 - 1, 0)
        free = place < m[:, None]
        hit = np.zeros(x.shape, bool)
        for i in range(x.shape[1]):
            fits = free & (y == x[:, i : i + 1]) & (np.abs(place - i) <= reach[:, None]) & (i < n)[:, None]
            first = fits.argmax(1)
            hit[:, i] = fits[rows, first]
            free[rows[hit[:, i]], first[hit[:, i]]] = False
        used = (place < m[:, None]) & ~free
        found = hit.sum(1)
        # matched characters of both sides in their order
        mine, other = x[hit], y[used]
        swapped = np.bincount(np.repeat(rows, found), weights=mine != other, minlength=len(part)).astype(np.int64) // 2
        with np.errstate(divide="ignore", invalid="ignore"):
            jaro = np.where(found > 0, (found / n + found / m + (found - swapped) / found) / 3, 0.0)
        wide = min(4, x.shape[1], y.shape[1])
        same = (x[:, :wide] == y[:, :wide]) & (np.arange(wide) < np.minimum(n, m)[:, None])
        prefix = np.minimum.accumulate(same, axis=1).sum(1)
        out[part] = np.where(jaro > 0.7, jaro + prefix * 0.1 * (1 - jaro), jaro)
    return out


def _pairwise(f):
    """An Arrow UDF of a function over lists of pairs; equal pairs of a batch are compared once."""

    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        known: dict[tuple, int] = {}
        at = [known.setdefault(pair, len(known)) for pair in zip(a, b, strict=True)]
        pairs = [(x, y) if x is not None and y is not None else None for x, y in known]
        fine = [p for p in pairs if p is not None]
        score = np.full(len(pairs), np.nan)
        if fine:
            score[[p is not None for p in pairs]] = f([x for x, _ in fine], [y for _, y in fine])
        return pd.Series(score[at] if at else [], dtype="float64")

    run.__annotations__ = {"a": pd.Series, "b": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, T.DoubleType())


ratio = _pairwise(indel_ratios)
token_sort_ratio = _pairwise(token_sorts)
token_set_ratio = _pairwise(token_sets)
max_sort_set_ratio = _pairwise(lambda a, b: np.maximum(token_sorts(a, b), token_sets(a, b)))
jaro_winkler = _pairwise(jaro_winklers)


# -- normalisers --------------------------------------------------------------------------------------------------------


def _squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(c, "[^a-z0-9 ]", " "), " +", " "))


def _words(c: Column, abbreviations: dict[str, str], stop: tuple[str, ...] = ()) -> Column:
    words = F.filter(F.split(c, " "), lambda w: (w != "") & (~w.isin(*stop) if stop else F.lit(True)))
    expand = lambda w: F.coalesce(*(F.when(w == k, F.lit(v)) for k, v in abbreviations.items()), w)
    return F.array_join(F.transform(words, expand), " ")


def _drop(c: Column, pattern: str) -> Column:
    return F.regexp_replace(c, pattern, "")


def _ends(suffixes: tuple[str, ...]) -> str:
    return "(?:" + "|".join(suffixes) + ")$"


# The normalisers name every step once: a `when` that repeats its input would double the plan with each step.


def normalize_name(c: Column) -> Column:
    """Normaliser A (provider linkage): ASCII, lower case, without filler words and hospital affixes. NULL gives ''."""
    x = _squeeze(F.lower(ascii_fold(F.coalesce(c, F.lit("")))))
    x = _words(_drop(x, " inc$"), ABBREVIATIONS_A, STOP_WORDS)
    return F.trim(_drop(_drop(_drop(x, "^hospital "), _ends(HOSPITAL_SUFFIXES)), _ends(HEALTH_SUFFIXES)))


def normalize_name_plain(c: Column) -> Column:
    """Normaliser B (hospital attributes): no folding, so an accented letter becomes a blank."""
    x = _words(_drop(_squeeze(F.lower(F.coalesce(c, F.lit("")))), " inc$"), ABBREVIATIONS_B)
    return F.trim(_drop(_drop(x, "^hospital "), " hospital$"))


def normalize_name_simple(c: Column) -> Column:
    """Normaliser C (trauma centres)."""
    return _squeeze(F.lower(F.coalesce(c, F.lit(""))))


def strip_brand(c: Column) -> Column:
    """Without the first brand prefix that fits, unless nothing would be left."""
    return _drop(c, "^(?:" + "|".join(BRAND_PREFIXES) + ")(?=.)")


def sorted_words(c: Column, distinct: bool = False) -> Column:
    """The words in order, joined by one space, as the token ratios compare them."""
    words = F.filter(F.split(c, r"(?U)\s+"), lambda w: w != "")
    return F.array_join(F.array_sort(F.array_distinct(words) if distinct else words), " ")


# -- addresses ----------------------------------------------------------------------------------------------------------


def normalize_zip(c: Column) -> Column:
    """Five digits, zeros in front, without +4; empty stays empty."""
    head = F.trim(F.split(F.trim(F.coalesce(c.cast("string"), F.lit(""))), "-")[0])
    return F.when(head == "", "").otherwise(F.substring(F.lpad(head, F.greatest(F.length(head), F.lit(5)), "0"), 1, 5))


def _first(*options: Column) -> Column:
    return F.coalesce(*(F.nullif(o, F.lit("")) for o in options), F.lit(""))


# Where house numbers stand in an address and in a display name.


def provider_house_number(c: Column) -> Column:
    """Leading digits, else a road number of 2 to 4 digits."""
    s = F.coalesce(c, F.lit(""))
    return _first(F.regexp_extract(s, r"^\s*(\d+)", 1), F.regexp_extract(s, r"(?i)(?:CARR\.?\s+|CARRETERA\s+|PR-)(\d{2,4})", 1))


def place_house_number(number: Column, display: Column) -> Column:
    n, d = F.coalesce(number, F.lit("")), F.coalesce(display, F.lit(""))
    return _first(F.regexp_extract(n, r"^\s*(\d+)", 1), F.regexp_extract(d, r"(?:,\s*|^)(\d{2,4})\s", 1), F.regexp_extract(d, r"\bPR-(\d{2,4})\b", 1))


def place_zip(postcode: Column, display: Column) -> Column:
    five = F.substring(F.trim(F.coalesce(postcode, F.lit(""))), 1, 5)
    return F.when(F.length(five) == 5, five).otherwise(F.regexp_extract(F.coalesce(display, F.lit("")), r"\b(\d{5})\b", 1))


# Fixed value: number and street of an address.
STREET = r"^(\d+[A-Za-z]?(?:-\d+[A-Za-z]?)?)\s+(.*)"


def parse_address(c: Column) -> Column:
    """struct(number, street); without a number the whole text is the street. NULL stays NULL."""
    s = F.trim(c)
    return F.when(c.isNotNull(), F.struct(F.regexp_extract(s, STREET, 1).alias("number"), F.when(s.rlike(STREET), F.regexp_extract(s, STREET, 2)).otherwise(s).alias("street")))


def is_empty(c: Column, words: tuple[str, ...] = EMPTY_WORDS) -> Column:
    return c.isNull() | F.lower(F.trim(c.cast("string"))).isin(*words)


def city_plausible(a: Column, b: Column) -> Column:
    """Equal, or the longer begins with the shorter's first four letters, or Jaro-Winkler of 0.75."""
    x, y = F.upper(F.trim(a)), F.upper(F.trim(b))
    short, long = F.when(F.length(x) <= F.length(y), x).otherwise(y), F.when(F.length(x) <= F.length(y), y).otherwise(x)
    return (x == y) | ((F.length(short) >= 4) & long.startswith(F.substring(short, 1, 4))) | (jaro_winkler(x, y) >= 0.75)


def register(spark) -> None:
    """The functions as SQL UDFs."""
    for name, f in {"fuzzy_ratio": ratio, "token_sort_ratio": token_sort_ratio, "token_set_ratio": token_set_ratio, "max_sort_set_ratio": max_sort_set_ratio, "jaro_winkler": jaro_winkler, "ascii_fold": ascii_fold}.items():
        spark.udf.register(name, f)
