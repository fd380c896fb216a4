import random
import re

import pytest

from poiforge.llm.url_filters import PatternRule, SiteRule, build_index, split_url, tokens_of, url_filter


@pytest.mark.parametrize(("url", "want"), [(None, ("", "")), ("no scheme", ("", "")), ("HTTP://ExÄmple.NET", ("exÄmple.net", "")), ("a://b?x/y", ("b", "")), ("a://b/c#d", ("b", "/c")), ("://h/p://q", ("h", "/p://q"))])
def test_split_url(url, want):
    assert split_url(url) == want


def test_rules_are_filed_under_their_rarest_token():
    rule = SiteRule("block", "rare.common", "/")
    assert list(build_index([rule], {"common": 9, "rare": 1})) == ["rare"]


def test_verdicts(spark):
    rows = [
        (1, "https://a.example.net/en/x", "example.net/en/", "allow"),
        (2, "https://example.net/de/", "net/", "block"),
        (3, "https://notexample.com/de/", None, "allow"),
        (4, "https://www.example.com/de/1?x", "example.com/de/", "block"),
        (5, "http://spam-farm.example.info/", None, "block"),
        (6, "http://spam-farming.info/", None, "allow"),
        (7, "https://net", None, "allow"),
        (8, None, None, "allow"),
        (8, None, None, "allow"),
        (9, "https://x.org/fr/" + "y" * 100_000, "org/fr/", "allow"),
    ]
    pages = spark.createDataFrame([(i, u, "x") for i, u, _, _ in rows], "page_id long, url string, rule string")
    got = url_filter(pages).collect()
    assert sorted((r.page_id, r.rule, r.verdict) for r in got) == sorted((i, r, v) for i, _, r, v in rows)
    assert url_filter(pages.limit(0)).count() == 0


def test_rule_without_tokens_is_always_tried(spark):
    pages = spark.createDataFrame([(1, "ftp://x/")], "page_id long, url string")
    rule = PatternRule("block", "tp:")
    assert rule.tokens == () and url_filter(pages, site_rules=(), pattern_rules=(rule,)).first().verdict == "block"
    assert url_filter(pages, site_rules=(), pattern_rules=()).first().verdict == "allow"


@pytest.mark.parametrize(
    ("pattern", "want"),
    [
        (r"://([^/?#]*\.)?spam-farm\.", {"spam", "farm"}), (r"://([^/?#]*\.)?(?:[a-z0-9]+-)?casino\.", {"casino"}), ("/porn/", {"porn"}), (r"[?&]utm_campaign=spam\b", {"utm", "campaign", "spam"}),
        ("abc", set()), ("/abc/?x", set()), ("(a|b)/foo-bar/", {"foo", "bar"}), (r"^https://x\.com/", {"https", "x", "com"}), ("/a(bc)?/d/", {"d"}), ("(?i)/foo/", set()), ("/fo+/bar/", {"bar"}), ("(?:/one/|/two/)", set()), ("/x{2}/", set()), (r"[^a-z0-9]word[/?]", {"word"}),
    ],
)
def test_tokens_come_from_the_expression(pattern, want):
    assert set(tokens_of(pattern)) == want


def test_no_token_is_claimed_that_a_match_can_lack():
    """Whatever an expression matches holds its derived tokens whole."""
    rnd = random.Random(3)
    piece = lambda: rnd.choice(["a", "b1", "-", "/", r"\.", "(?:a|/)", "[a-c]", "[^a-z0-9]", "(?:b/)?", "c*", "/+", r"\b", "(/x)?"])
    seen = 0
    for _ in range(20_000):
        pattern = "".join(piece() for _ in range(rnd.randrange(1, 6)))
        find = re.compile(pattern, re.ASCII)
        if not tokens_of(pattern):
            continue
        for _ in range(100):
            text = "".join(rnd.choice(["a", "b1", "c", "/", "/", "-", ".", "x"]) for _ in range(rnd.randrange(1, 9)))
            if find.search(text):
                assert set(tokens_of(pattern)) <= set(re.findall("[a-z0-9]+", text)), (pattern, text)
                seen += 1
    assert seen > 200


RULE_ROWS = [("block", "net", "/", None), ("allow", "example.net", "/en/", None), ("block", "example.net", "/e", None), ("allow", "example.net", "/e", None), ("block", None, None, "/bad/"), ("allow", None, None, "/bad/ok"), ("block", None, None, "x{3}"), ("block", None, None, r"spam\b"), ("block", "net", "/", None)]
URLS = ["https://example.net/en/1", "https://example.net/e", "https://a.net/bad/", "http://q.com/bad/ok", "http://q.com/bad/no", "http://q.com/xxxx", "http://q.com/spam\u00e9", "http://q.com/spamm", None, "nothing", "http://Q.com/", "http://q.com/bad/ok"]


def test_rules_from_a_table_and_beyond_what_is_held(spark):
    """Ties of equally long rules, repeated rules and urls; the join gives what the index gives."""
    pages = spark.createDataFrame([(i, u, 1) for i, u in enumerate(URLS)], "page_id long, url string, token int")
    rules = spark.createDataFrame(RULE_ROWS, "verdict string, host string, path string, pattern string")
    rows = lambda held: sorted(map(str, url_filter(pages, rules=rules, held=held).collect()))
    assert rows(100) == rows(4)
    got = {r.page_id: (r.rule, r.verdict) for r in url_filter(pages, rules=rules).collect()}
    assert got == {0: ("example.net/en/", "allow"), 1: ("example.net/e", "allow"), 2: ("net/", "block"), 3: (None, "allow"), 4: (None, "block"), 5: (None, "block"), 6: (None, "block"), 7: (None, "allow"), 8: (None, "allow"), 9: (None, "allow"), 10: (None, "allow"), 11: (None, "allow")}
    with pytest.raises(ValueError, match="without a literal token"):
        url_filter(pages, rules=rules.where("pattern = 'x{3}'").union(rules.where("host = 'net'")), held=0)


def test_a_hundred_thousand_rules(spark):
    rules = spark.range(100_000).selectExpr("'block' AS verdict", "concat('site', id, '.com') AS host", "'/' AS path", "CAST(NULL AS STRING) AS pattern")
    pages = spark.createDataFrame([(1, "http://www.site77777.com/a"), (2, "http://site100000.com/a"), (3, "http://xsite5.com/")], "page_id long, url string")
    for held in (200_000, 1000):
        assert sorted((r.page_id, r.verdict) for r in url_filter(pages, rules=rules, held=held).collect()) == [(1, "block"), (2, "allow"), (3, "allow")]
