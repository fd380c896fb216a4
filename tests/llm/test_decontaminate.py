import hashlib
import re

from pyspark.sql import functions as F

from poiforge.llm import decontaminate as dc
from poiforge.llm.common import stored

ITEMS = [(1, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu", "x"), (2, "short Item", "x"), (3, None, "x"), (4, "...", "x"), (5, "one", "x"), (6, "la " * 12, "x"), (5, "one", "y"), (7, "É é a1", "x")]
DOCS = [
    (1, "so: ALPHA beta-gamma delta epsilon zeta eta theta iota kappa lambda, and more"),
    (2, "a short item, another SHORT...item; one"),
    (3, None),
    (4, ""),
    (5, "la " * 30),
    (6, "alpha beta gamma delta epsilon zeta eta theta iota"),
    (7, "é É É é a1 É é a1"),
    (8, "twoone one2"),
    (8, "twoone one2"),
    (9, "x " * 20_000 + "short item"),
]


def brute_force(docs, items, width=10):
    find = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    out = []
    for k, t in docs:
        w, hit, found = find(t), set(), set()
        for i, text, _ in items:
            x = find(text)
            n = min(width, len(x))
            for p in range(len(x) - n + 1) if x else ():
                for s in range(len(w) - n + 1):
                    if w[s : s + n] == x[p : p + n]:
                        hit.update(range(s, s + n))
                        found.add(str(i))
        ids = sorted(found)
        out.append((k, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest()))
    return sorted(out)


def test_equals_brute_force(spark):
    docs = spark.createDataFrame([(k, t, "x") for k, t in DOCS], "doc_id long, text string, window string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string, term string")
    got = dc.decontaminate(docs, items).select("doc_id", "n_words", "n_hit", F.size("items").alias("k"), F.sha2(F.array_join("items", ","), 256).alias("h"))
    assert sorted(map(tuple, got.collect())) == brute_force(DOCS, ITEMS)


def test_empty_tables_and_filter(spark):
    docs = spark.createDataFrame([(1, "one two", "x"), (2, "three", "x"), (None, "one", "x")], "doc_id long, text string, start string")
    items = spark.createDataFrame([(1, "two")], "item_id long, text string")
    assert dc.decontaminate(docs.limit(0), items).count() == 0
    assert [r.n_hit for r in dc.decontaminate(docs, items.limit(0)).collect()] == [0, 0, 0]
    assert sorted((r.doc_id or 0, r.n_hit) for r in dc.decontaminate(docs, items.withColumn("text", F.lit("one"))).collect()) == [(0, 1), (1, 1), (2, 0)]
    kept = dc.clean(docs, items)
    assert kept.columns == docs.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 2]


def test_rows_that_repeat_a_key_are_judged_by_their_own_text(spark):
    """Words of one text and of another one under the same key make no phrase."""
    rows = [(1, "alpha beta gamma x x"), (1, "y y y delta epsilon"), (1, "z alpha beta gamma delta epsilon"), (None, "alpha beta gamma x x"), (None, "y y y delta epsilon")]
    docs = spark.createDataFrame([(k, t, 1) for k, t in rows], "doc_id long, text string, tid long")
    items = spark.createDataFrame([(1, "alpha beta gamma delta epsilon")], "item_id long, text string")
    got = sorted((r.doc_id or 0, r.n_words, r.n_hit) for r in dc.decontaminate(docs, items).collect())
    assert got == [(0, 5, 0), (0, 5, 0), (1, 5, 0), (1, 5, 0), (1, 6, 5)]
    assert dc.clean(docs, items).count() == 4


def test_one_index_answers_several_benchmarks(spark):
    docs = spark.createDataFrame([(k, t) for k, t in DOCS], "doc_id long, text string")
    index = dc.build_index(dc.named(docs, "doc_id", "text"))
    for items in (ITEMS, ITEMS[:2], [(9, "one2", "")]):
        tests = stored(dc.windows(spark.createDataFrame(items, "item_id long, text string, term string"), 10), "tests")
        got = {r.doc: r.n_hit for r in dc.hit_words(dc.search(index, tests)).collect()}
        assert got == {k: n for k, _, n, _, _ in brute_force(DOCS, items) if n}


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "beta x alpha y gamma"), (2, "alpha beta x x x x x x x gamma"), (3, "gamma beta alpha")], "doc_id long, text string")
    tests = stored(dc.windows(spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string"), 10), "tests")
    index = dc.build_index(dc.named(docs, "doc_id", "text"), tests.select("term").distinct())
    found = dc.proximity(index, dc.rarest(tests, index), 5)
    assert sorted(r.doc for r in found.collect()) == [1, 3]


def test_main_path_runs_no_python(spark):
    docs = spark.createDataFrame([(1, "one two")], "doc_id long, text string")
    plan = dc.decontaminate(docs, docs.withColumnRenamed("doc_id", "item_id"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
