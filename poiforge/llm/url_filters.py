"""URL filters: pattern rules indexed by their rarest literal token.

A rule's literal tokens ([a-z0-9]+) are those that any url it matches must contain as whole tokens; they are derived from its expression's parse:
letters that must occur in a row, between characters that can't belong to a token. The rule is filed under the one of its tokens that is rarest
in the url table. A url's own tokens fetch the rules filed under them, and only those rules run their regular expression; rules without a
token are tried on every url. Site rules (a host with all its subdomains, and a path prefix) go through the same index: their
tokens are the labels of the host, and their check is exact.

Rules are a list or a table. Up to `HELD` rules, the index is sent to the tasks, which judge a url in one pass. More rules stay a table: distinct
urls' tokens are joined with the tokens that rules are filed under, the fetched pairs are judged, and the best rule joins back.

Expressions are over the lower-cased url, in ASCII mode (\\b and \\w know ASCII letters only). Site rules decide first: the longest rule text wins, then the
smaller text. Among pattern rules an allow beats a block, then the longer, then the smaller expression.

Edge cases: a null url, or one without "://", has an empty host and path and gets the default verdict unless a pattern fits its text (null: the
empty text). Repeated rows are judged one by one. Columns of the input that are not needed are not read; an output column never
clashes because only page_id and the result columns are returned. An empty table gives an empty result, an empty rule set the default.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from re import _parser as sre

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from poiforge.llm.common import broadcast_if_small, released, stored, table

TOKEN = "[a-z0-9]+"
#: Rules that are sent to the tasks.
HELD = 200_000
_ASCII = {c: c + 32 for c in range(65, 91)}
_IN_TOKEN = frozenset(map(ord, "abcdefghijklmnopqrstuvwxyz0123456789"))


def _edges(item, first: bool) -> set[str]:
    """What an element of a parsed expression may begin (or end) with: 'token' characters, 'other' ones, or 'none' (it may be empty)."""
    op, arg = str(item[0]), item[1]
    if op == "LITERAL":
        return {"token" if arg in _IN_TOKEN else "other"}
    if op == "IN":
        if str(arg[0][0]) == "NEGATE":
            gone = {a for o, a in arg[1:] if str(o) == "LITERAL"} | {c for o, a in arg[1:] if str(o) == "RANGE" for c in range(a[0], a[1] + 1)}
            return {"other"} if gone >= _IN_TOKEN else {"token", "other"}
        out = set()
        for o, a in arg:
            out |= {"token" if a in _IN_TOKEN else "other"} if str(o) == "LITERAL" else {"other"} if str(o) == "RANGE" and not _IN_TOKEN & set(range(a[0], a[1] + 1)) else {"token", "other"}
        return out
    if op == "SUBPATTERN":
        return _end(arg[3], first)
    if op == "BRANCH":
        return set().union(*(_end(b, first) for b in arg[1]))
    if op in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
        return _end(arg[2], first) | ({"none"} if arg[0] == 0 else set())
    if op == "AT":
        # a boundary next to a token character, and the text's own ends, leave no token character on the other side
        return {"other"} if str(arg) in ("AT_BEGINNING", "AT_BEGINNING_STRING", "AT_END_STRING", "AT_BOUNDARY") else {"none"}
    return {"token", "other"}


def _end(items, first: bool) -> set[str]:
    out: set[str] = set()
    for item in items if first else reversed(list(items)):
        out |= _edges(item, first)
        if "none" not in out:
            return out
        out.discard("none")
    return out | {"none"}


def _runs(items, before: set[str], after: set[str]) -> Iterator[str]:
    """Tokens that every match of a sequence holds whole; before and after: what may stand next to it."""
    items = list(items)
    at = 0
    while at < len(items):
        op, arg = str(items[at][0]), items[at][1]
        left = lambda i: (lambda e: (e - {"none"}) | before if "none" in e else e)(_end(items[:i], False))
        right = lambda i: (lambda e: (e - {"none"}) | after if "none" in e else e)(_end(items[i:], True))
        if op == "LITERAL":
            end = at
            while end < len(items) and str(items[end][0]) == "LITERAL":
                end += 1
            text = "".join(chr(a) for _, a in items[at:end])
            for m in re.finditer(TOKEN, text):
                if (m.start() > 0 or "token" not in left(at)) and (m.end() < len(text) or "token" not in right(end)):
                    yield m[0]
            at = end
            continue
        if op == "SUBPATTERN" and not arg[1] and not arg[2]:
            yield from _runs(arg[3], left(at), right(at + 1))
        elif op in ("MAX_REPEAT", "MIN_REPEAT") and arg[0] >= 1 and arg[1] == 1:
            yield from _runs(arg[2], left(at), right(at + 1))
        at += 1


@lru_cache(maxsize=100_000)
def tokens_of(pattern: str) -> tuple[str, ...]:
    """Literal tokens that any lower-cased text the expression matches contains whole. Flags inside an expression rule tokens out."""
    parsed = sre.parse(pattern, re.ASCII)
    if parsed.state.flags & (re.IGNORECASE | re.MULTILINE):
        return ()
    return tuple(dict.fromkeys(_runs(parsed, {"token", "other"}, {"token", "other"})))


@dataclass(frozen=True)
class SiteRule:
    """Fits a host and its subdomains if the url's path starts with `path`."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    @property
    def tokens(self) -> tuple[str, ...]:
        return tuple(re.findall(TOKEN, self.host))


@dataclass(frozen=True)
class PatternRule:
    """A regular expression over the lower-cased url."""

    verdict: str
    pattern: str

    @property
    def name(self) -> str:
        return self.pattern

    @property
    def tokens(self) -> tuple[str, ...]:
        return tokens_of(self.pattern)


SITE_RULES = (SiteRule("block", "net", "/"), SiteRule("allow", "example.net", "/en/"), SiteRule("block", "example.com", "/de/"), SiteRule("allow", "org", "/fr/"))
#: The method's own rules for urls that no site rule fits.
PATTERN_RULES = (
    PatternRule("block", r"://([^/?#]*\.)?spam-farm\."),
    PatternRule("block", r"://([^/?#]*\.)?(?:[a-z0-9]+-)?casino\."),
    PatternRule("block", r"/porn/"),
    PatternRule("block", r"[?&]utm_campaign=spam\b"),
)


def url_tokens(column: str):
    return F.array_distinct(F.regexp_extract_all(F.lower(F.col(column)), F.lit(f"({TOKEN})")))


def token_counts(urls: DataFrame, column: str, wanted: DataFrame) -> DataFrame:
    """token, n: urls that hold each of the wanted tokens (a table with a column token)."""
    seen = urls.select(F.explode(url_tokens(column)).alias("token"))
    # aggregated before the join, so that a token's occurrences never meet in one task
    return seen.groupBy("token").agg(F.count("*").alias("n")).join(broadcast_if_small(wanted), "token")


def build_index(rules, counts: dict[str, int]) -> dict[str, list]:
    """token -> rules filed under it; a rule without tokens is under '' and is tried for every url."""
    index: dict[str, list] = {}
    for rule in rules:
        rarest = min(rule.tokens, key=lambda t: (counts.get(t, 0), -len(t), t), default="")
        index.setdefault(rarest, []).append(rule)
    return index


def split_url(url: str | None) -> tuple[str, str]:
    """(host with A-Z lower-cased, path) by the contract's rules."""
    if url is None or (i := url.find("://")) < 0:
        return "", ""
    rest = re.split("[?#]", url[i + 3 :], maxsplit=1)[0]
    host, slash, path = rest.partition("/")
    return host.translate(_ASCII), slash + path


def _best(host: str, path: str, low: str, fetched, find) -> tuple[str | None, str | None, str | None]:
    """(site rule, its verdict, None), else (None, verdict, pattern) of the deciding pattern rule, else three times None."""
    sites = [r for r in fetched if isinstance(r, SiteRule) and (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    if sites:
        best = min(sites, key=lambda r: (-len(r.name), r.name, r.verdict))
        return best.name, best.verdict, None
    hits = [r for r in fetched if isinstance(r, PatternRule) and find(r.pattern).search(low)]
    if hits:
        best = min(hits, key=lambda r: (r.verdict != "allow", -len(r.pattern), r.pattern))
        return None, best.verdict, best.pattern
    return None, None, None


@lru_cache(maxsize=20_000)
def _compiled(pattern: str) -> re.Pattern:
    return re.compile(pattern, re.ASCII)


RULES = "verdict string, host string, path string, pattern string"


def _rule(verdict, host, path, pattern):
    return SiteRule(verdict, host, path or "") if pattern is None else PatternRule(verdict, pattern)


def url_filter(urls: DataFrame, key: str = "page_id", column: str = "url", site_rules=SITE_RULES, pattern_rules=PATTERN_RULES, default: str = "allow", rules: DataFrame | None = None, held: int = HELD) -> DataFrame:
    """One row per url: key, host, path, rule (of the longest fitting site rule, else null), verdict, pattern (of the deciding pattern rule).

    rules: a table instead of the lists: verdict, and host and path of a site rule or the pattern of a pattern rule."""
    spark = urls.sparkSession
    if rules is not None:
        few = rules.select("verdict", "host", "path", "pattern").limit(held + 1).collect()
        if len(few) > held:
            return _by_join(urls, key, column, rules, default, held)
        own = [_rule(*r) for r in few]
    else:
        own = [*site_rules, *pattern_rules]
    wanted = sorted({t for r in own for t in r.tokens})
    counts = {}
    if wanted:  # as many rows as the rules have tokens
        counts = {r["token"]: r["n"] for r in token_counts(urls, column, spark.createDataFrame([(t,) for t in wanted], "token string")).collect()}
    index = build_index(own, counts)
    always = index.pop("", [])
    shared = spark.sparkContext.broadcast(index)  # at most `held` rules

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_token, token = shared.value, re.compile(TOKEN)
        known = by_token.keys()
        for batch in batches:
            out = []
            for url in batch.column(1).to_pylist():
                host, path = split_url(url)
                low = (url or "").lower()
                fetched = [r for t in known & set(token.findall(low)) for r in by_token[t]] + always
                name, verdict, pattern = _best(host, path, low, fetched, _compiled)
                out.append((host, path, name, verdict or default, pattern))
            cols = list(zip(*out, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.string()) for c in cols)], names=["key", "host", "path", "rule", "verdict", "pattern"])

    kind = dict(urls.dtypes)[key]
    found = urls.select(F.col(key).alias("key"), F.col(column).alias("url")).mapInArrow(released(run), f"key {kind}, host string, path string, rule string, verdict string, pattern string")
    return found.withColumnRenamed("key", key)


def _by_join(urls: DataFrame, key: str, column: str, rules: DataFrame, default: str, held: int) -> DataFrame:
    """The same with the rules as a table: filed under tokens, joined with the tokens of distinct urls, judged pair by pair."""
    spark = urls.sparkSession

    def spelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            tokens = [list(_rule(r["verdict"], r["host"], r["path"], r["pattern"]).tokens) for r in rows]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tokens, pa.list_(pa.string()))], names=[*batch.schema.names, "tokens"])

    # the same rule twice is one rule
    spelt = stored(rules.select("verdict", "host", "path", "pattern").distinct().mapInArrow(released(spelled), RULES + ", tokens array<string>"), "rules")
    each = spelt.select("verdict", "host", "path", "pattern", F.explode_outer("tokens").alias("token"))
    counts = token_counts(urls, column, stored(each.where("token IS NOT NULL").select("token").distinct(), "wanted"))
    ranked = each.join(counts, "token", "left").withColumn("order", F.struct(F.coalesce("n", F.lit(0)).alias("n"), -F.length("token"), "token"))
    filed = stored(ranked.groupBy("verdict", "host", "path", "pattern").agg(F.min_by("token", F.when(F.col("token").isNotNull(), F.col("order"))).alias("token")), "filed")
    distinct = stored(urls.select(F.col(column).alias("url")).distinct(), "urls")
    asked = distinct.select("url", F.explode(url_tokens("url")).alias("token"))
    pairs = asked.join(filed.where("token IS NOT NULL"), "token").select("url", F.struct("verdict", "host", "path", "pattern").alias("own"))
    bare = filed.where("token IS NULL").select("verdict", "host", "path", "pattern").limit(held + 1).collect()
    if len(bare) > held:
        raise ValueError(f"more than {held} rules without a literal token, which every url would have to be tried on")
    always = spark.sparkContext.broadcast([_rule(*r) for r in bare])

    def judged(own: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out = []
                for r in batch.to_pylist():
                    host, path = split_url(r["url"])
                    fetched = [_rule(*(r["own"][c] for c in ("verdict", "host", "path", "pattern")))] if own else always.value
                    name, verdict, pattern = _best(host, path, (r["url"] or "").lower(), fetched, _compiled)
                    if verdict is not None:
                        out.append((r["url"], name, verdict, pattern))
                cols = list(zip(*out, strict=True)) or [()] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in cols], names=["url", "rule", "verdict", "pattern"])

        return run

    kinds = "url string, rule string, verdict string, pattern string"
    hits = pairs.mapInArrow(released(judged(True)), kinds)
    if bare:
        hits = hits.unionByName(distinct.mapInArrow(released(judged(False)), kinds))
    text = F.coalesce("rule", "pattern")
    order = F.struct(F.col("rule").isNull(), F.when(F.col("rule").isNull(), F.col("verdict") != "allow").otherwise(False), -F.length(text), text, "verdict")
    best = hits.groupBy(F.col("url").alias("_url")).agg(F.min_by(F.struct("rule", "verdict", "pattern"), order).alias("_b"))
    rest = F.col("url")
    at = F.instr(rest, "://")
    tail = F.regexp_extract(F.substring(rest, at + 3, F.length(rest)), "^[^?#]*", 0)
    host, slash = F.regexp_extract(tail, "^[^/]*", 0), F.instr(tail, "/")
    none = rest.isNull() | (at == 0)
    host = F.when(none, "").otherwise(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    path = F.when(none | (slash == 0), "").otherwise(F.substring(tail, slash, F.length(tail)))
    rows = urls.select(F.col(key).alias("key"), F.col(column).alias("url"))
    out = rows.join(best, F.col("url").eqNullSafe(F.col("_url")), "left")
    return out.select(F.col("key").alias(key), host.alias("host"), path.alias("path"), F.col("_b.rule").alias("rule"), F.coalesce("_b.verdict", F.lit(default)).alias("verdict"), F.col("_b.pattern").alias("pattern"))


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def oracle() -> str:
    """The same judgement over plain strings, every rule tried on every url."""
    at = "strpos(url, '://')"
    fits = ", ".join(f"CASE WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{r.name}' END" for r in sorted(SITE_RULES, key=lambda r: (-len(r.name), r.name)))
    verdicts = " ".join(f"WHEN rule = '{r.name}' THEN '{r.verdict}'" for r in SITE_RULES)
    blocked = " OR ".join(f"regexp_matches(lower(coalesce(url, '')), '{r.pattern}')" for r in PATTERN_RULES)
    return f"""
WITH cut AS (SELECT page_id, url, CASE WHEN {at} > 0 THEN regexp_extract(substr(url, {at} + 3), '^[^?#]*') ELSE '' END AS rest FROM pages),
parts AS (SELECT page_id, url, translate(regexp_extract(rest, '^[^/]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                 CASE WHEN strpos(rest, '/') > 0 THEN substr(rest, strpos(rest, '/')) ELSE '' END AS path FROM cut),
ruled AS (SELECT *, coalesce({fits}) AS rule FROM parts)
SELECT page_id, host, path, rule, CASE {verdicts} WHEN {blocked} THEN 'block' ELSE 'allow' END AS verdict FROM ruled"""
