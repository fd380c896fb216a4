import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from poiforge.llm import induced_sort, minhash_dedup, substring_dedup, suffix_dedup


def rows_of(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_substring_dedup_equals_brute_force(spark, odd_docs, odd_rows, no_docs):
    from pyspark.sql import functions as F

    got = substring_dedup.dedup(odd_docs).withColumn("sha", F.sha2("kept_text", 256))
    assert rows_of(got, "doc_id", "n_words", "n_removed", "sha") == sorted(substring_dedup.brute_force(odd_rows))
    assert substring_dedup.dedup(no_docs).count() == 0


def test_substring_dedup_null_key(spark):
    df = spark.createDataFrame([(None, "a " * 80), (1, "a " * 80)], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.n_removed) for r in substring_dedup.dedup(df).collect()) == [(0, 0), (1, 0)]


# anchors that needn't, must once, and must twice be cut into cells
@pytest.mark.parametrize(("crowd", "memory"), [(1 << 25, 1 << 18), (10_000, 300), (500, 1 << 18)])
def test_suffix_dedup_equals_brute_force(odd_docs, odd_rows, crowd, memory):
    from pyspark.sql import functions as F

    got = suffix_dedup.dedup(odd_docs, crowd=crowd, memory=memory).withColumn("sha", F.sha2("kept", 256)).withColumn("n_spans", F.size("spans"))
    assert rows_of(got, "doc_id", "n_bytes", "n_removed", "n_spans", "sha") == sorted(suffix_dedup.brute_force(odd_rows))


def test_suffix_dedup_empty_and_null_key(spark, no_docs):
    assert suffix_dedup.dedup(no_docs).count() == 0
    df = spark.createDataFrame([(None, "ab" * 200), (2, None)], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.n_removed) for r in suffix_dedup.dedup(df).collect()) == [(0, 400), (2, 0)]


def test_suffix_dedup_slices_long_texts(spark):
    rnd = random.Random(1)
    passage = "".join(rnd.choice("abcdef ") for _ in range(900))
    filler = lambda n, of="uvwxyz": "".join(rnd.choice(of) for _ in range(n))
    edge = suffix_dedup.BLOCK
    long = filler(edge - 400) + passage + filler(edge, "ghijkl") + passage + filler(edge // 2)
    rows = [(1, long), (2, "0" * 50 + passage[:450] + "1"), (3, "é" * 300)]
    got = {r.doc_id: (r.n_removed, [(s.start, s.end) for s in r.spans]) for r in suffix_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = {k: (gone, n) for k, _, gone, n, _ in suffix_dedup.brute_force(rows)}
    assert {k: (gone, len(s)) for k, (gone, s) in got.items()} == want
    assert got[1][1] == [(edge - 400, edge + 500), (2 * edge + 500, 2 * edge + 1400)]


def test_shard_is_sorted_on_disk():
    """A shard of many times the budget goes through queues and runs on disk and through the recursion, and is never held whole."""
    rnd = random.Random(2)
    text = "".join(rnd.choice("abcdefgh  ") for _ in range(400_000)).encode()
    bodies = [text[k : k + 300] for k in (rnd.randrange(len(text) - 300) for _ in range(12_000))]
    n = len(bodies)
    batch = pa.RecordBatch.from_arrays([pa.array(range(n)), pa.array(range(n)), pa.array([i == 7 for i in range(n)]), pa.array(bodies)], names=["key", "hash", "several", "body"])
    seen = Counter(b[i : i + 200] for b in [*bodies, bodies[7]] for i in range(101))
    want = {(k, i) for k, b in enumerate(bodies) for i in range(101) if seen[b[i : i + 200]] > 1}
    work = induced_sort.Work(memory=1 << 14)
    tracemalloc.start()
    found = list(suffix_dedup.sort_shard(iter([batch]), 200, work))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert {(r["key"], i) for b in found for r in b.to_pylist() for i in range(r["a"], r["b"])} == want
    assert work.depth > 3 and work.written > 20 * sum(map(len, bodies))
    assert peak < 8 * sum(map(len, bodies))  # one 64-bit array of all suffixes


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), max_size=30), min_size=1, max_size=6), st.sampled_from([1, 2, 7, 40, 300]), st.sampled_from([4, 16, 1 << 18]), st.sampled_from([1, 3, 1 << 15]))
def test_sorted_suffixes_and_common_prefixes(strings, depth, memory, bulk):
    text = [c for s in [*strings, *strings[:2]] for c in [*(x + 2 for x in s), 1]] + [0]
    blocks = []
    induced_sort.sort_suffixes(np.array(text, np.uint16), 6, depth, induced_sort.Work(memory, bulk, 4), lambda p, s: blocks.append((p.copy(), s.copy())))
    place, shared = (np.concatenate(c).tolist() for c in zip(*blocks, strict=True))
    assert sorted(place) == list(range(len(text)))
    heads = [text[p : p + depth] for p in place]
    assert heads == sorted(heads, reverse=True)
    assert shared[1:] == [next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b))) for a, b in zip(heads, heads[1:], strict=False)]


def test_near_duplicates_equal_brute_force(spark, odd_docs, odd_rows, no_docs):
    for words, percent in ((3, 85), (5, 80)):
        got = minhash_dedup.near_duplicates(odd_docs, words, percent)
        want = minhash_dedup.brute_force(odd_rows, words, percent)
        assert sorted(set(rows_of(got, "doc_id", "n_shingles", "component_id", "kept"))) == sorted(want)
    assert minhash_dedup.near_duplicates(no_docs).count() == 0


def test_chains_and_crowded_buckets(spark):
    """Variants of one base near the threshold: links within buckets that span components must not be lost."""
    import random

    rnd = random.Random(2)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for k in range(60):
        w = list(base)
        for i in rnd.sample(range(120), rnd.choice([1, 2, 3, 4, 5])):
            w[i] = f"v{k}_{i}"
        rows.append((k * 3, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = minhash_dedup.near_duplicates(df, 3, 85)
    assert rows_of(got, "doc_id", "n_shingles", "component_id", "kept") == sorted(minhash_dedup.brute_force(rows, 3, 85))


def test_keep_one(spark, odd_docs):
    kept = minhash_dedup.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    assert {2, 3}.isdisjoint(ids) and {1, 4, 5, 6, 7}.issubset(ids)


def test_texts_of_one_key_keep_their_links(spark):
    texts = {c: [f"{c}{i}" for i in range(150)] for c in "abcd"}
    near = {c: " ".join([*w[:70], "changed", *w[71:]]) for c, w in texts.items()}
    a, b, c, d = (" ".join(w) for w in texts.values())
    rows = [(5, a), (5, b), (5, c), (7, near["a"]), (9, near["b"]), (11, near["c"]), (20, d), (20, ""), (21, near["d"]), (3, "alone"), (30, b), (30, d)]
    for order in (rows, rows[::-1]):
        got = minhash_dedup.near_duplicates(spark.createDataFrame(order, "doc_id long, text string").repartition(2))
        assert {(r.doc_id, r.component_id, r.kept) for r in got.collect()} == {(3, 3, True), *((k, 5, k == 5) for k in (5, 7, 9, 11, 20, 21, 30))}
