"""Benchmark decontamination with a positional inverted index, in DataFrame operations only.

The index stores a posting (term, document, position) for every training token, or for every one that some test item uses where a
vocabulary is given. `build_index` without one gives an index that any later benchmark can be searched in. It is sharded by
document and sorted by term within a shard, so that a term's list is a few runs of each file. Terms are 64-bit hashes of the words.
A document is its key and the digest of its text, so rows that repeat a key with other texts have lists of their own.

A test window is a phrase of consecutive terms. The counts of the index give each window's rarest terms. The list of the
rarest one, shifted by its offset in the phrase, gives candidate starts; they are intersected with the shifted list of the
second rarest term; what is left is intersected with the lists of all terms of the phrase, read for the left documents only.
Document and position are the join keys, so a passage that a third of all documents share is spread like any other.

`proximity` answers a weaker question from the same index: which windows have all their terms within a span of so many words.

Edge cases: null and empty texts have no words; a row with a null key is a document like any other; an item with fewer words than the window
is one window; items without words, or without an id, match nothing; rows that repeat a key are judged each by its own text; repeated
items count once per item id; extra columns are ignored; empty tables give no hits (or no rows).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from poiforge.llm.common import broadcast_if_small, new_path, stored, table

WIDTH = 10
UPPER, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Anything between words, case kept (A-Z belong to words).
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def lowered(text: Column) -> Column:
    """A-Z lower-cased, all else unchanged; a text of one-byte characters takes the quick way."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, SMALL))


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


#: What tells documents apart: the key (with a value of its own for null) and the digest of the text.
DOC = ("doc", "tid")
NO_KEY = -(2**63)


def named(docs: DataFrame, key: str, text: str) -> DataFrame:
    """doc, tid, text; rows equal in key and text are one document."""
    return docs.select(F.coalesce(F.col(key).cast("long"), F.lit(NO_KEY)).alias("doc"), F.xxhash64(F.col(text)).alias("tid"), F.col(text).alias("text"))


def postings(docs: DataFrame) -> DataFrame:
    """doc, tid, pos, term of every word. Positions count from the first word or, where the text begins with a gap, from 1."""
    pieces = F.split(lowered(F.col("text")), GAP)
    return docs.where("text IS NOT NULL").select(*DOC, F.posexplode(pieces).alias("pos", "word")).where("word <> ''").select(*DOC, "pos", F.xxhash64("word").alias("term"))


def windows(items: DataFrame, width: int) -> DataFrame:
    """item_id, window (its first word's number in the item), offset, term, size (terms of the window)."""
    words = F.filter(F.split(lowered(F.col("text")), GAP), lambda w: w != "")
    rows = items.where("text IS NOT NULL AND item_id IS NOT NULL").select("item_id", words.alias("words")).where(F.size("words") > 0).distinct()
    rows = rows.select(F.col("item_id"), F.xxhash64("words").alias("tid"), "words", F.least(F.size("words"), F.lit(width)).alias("size"))
    rows = rows.select("item_id", "tid", "words", "size", F.explode(F.sequence(F.lit(0), F.size("words") - F.col("size"))).alias("first"))
    phrase = F.slice("words", F.col("first") + 1, F.col("size"))
    return rows.select("item_id", F.xxhash64("item_id", "tid", "first").alias("window"), "size", F.posexplode(F.transform(phrase, lambda w: F.xxhash64(w))).alias("offset", "term"))


def build_index(docs: DataFrame, vocabulary: DataFrame | None = None) -> DataFrame:
    """The stored postings of all terms, or of the vocabulary's."""
    kept = postings(docs)
    if vocabulary is not None:
        kept = kept.join(broadcast_if_small(vocabulary), "term", "left_semi")
    path = new_path(docs.sparkSession, "postings")
    kept.sortWithinPartitions("term", *DOC, "pos").write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema("doc long, tid long, pos int, term long").parquet(path)


def rarest(tests: DataFrame, index: DataFrame, own: bool = False) -> DataFrame:
    """own: the index has the tests' terms only. The windows' terms with their rank by rarity in the training texts (1: rarest). Windows with an absent term are left out."""
    wanted = index if own else index.join(broadcast_if_small(stored(tests.select("term").distinct(), "terms")), "term", "left_semi")
    counts = wanted.groupBy("term").agg(F.count("*").alias("n"))
    counted = tests.join(counts, "term", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    by = Window.partitionBy("window").orderBy("n", "offset")
    ranked = counted.withColumn("rank", F.row_number().over(by)).withColumn("least", F.min("n").over(Window.partitionBy("window")))
    return stored(ranked.where("least > 0").select("window", "size", "offset", "term", "rank"), "ranked")


def phrases(index: DataFrame, ranked: DataFrame) -> DataFrame:
    """Exact occurrences: doc, tid, start, window, size. Lists are intersected from the rarest term on."""
    first = ranked.where("rank = 1").select("window", "size", "term", "offset")
    found = index.join(broadcast_if_small(first), "term").select(*DOC, (F.col("pos") - F.col("offset")).alias("start"), "window", "size")
    second = ranked.where("rank = 2").select("window", F.col("term").alias("term2"), F.col("offset").alias("offset2"))
    wanted = found.join(broadcast_if_small(second), "window", "left").withColumn("pos", F.col("start") + F.col("offset2"))
    lone = wanted.where("term2 IS NULL").select(*DOC, "start", "window", "size")
    listed = index.join(broadcast_if_small(second.select(F.col("term2").alias("term")).distinct()), "term", "left_semi").select(*DOC, "pos", F.col("term").alias("term2"))
    pairs = wanted.where("term2 IS NOT NULL").join(listed, [*DOC, "pos", "term2"]).select(*DOC, "start", "window", "size")
    found = stored(pairs.unionByName(lone).distinct(), "starts")
    # what two terms agree on is checked in full, against the lists of the documents left
    left = broadcast_if_small(stored(found.select(*DOC).distinct(), "left"))
    rest = ranked.where("rank > 2").select("window", "term", "offset")
    need = found.join(broadcast_if_small(rest), "window").select(*DOC, "start", "window", "size", "term", (F.col("start") + F.col("offset")).alias("pos"))
    have = index.join(left, [*DOC], "left_semi")
    # a start's terms sit at different places, so its matches are counted, never listed
    full = need.join(have, [*DOC, "pos", "term"]).groupBy(*DOC, "start", "window", "size").agg(F.countDistinct("pos").alias("n")).where("n = size - 2")
    return full.select(*DOC, "start", "window", "size").unionByName(found.where("size <= 2"))


def proximity(index: DataFrame, ranked: DataFrame, span: int) -> DataFrame:
    """doc, tid, window of windows with all distinct terms at most span - 1 words after some occurrence of one of them.

    The rarest term's list gives centres; only postings within `span` words of a centre, of that window's terms, are kept."""
    terms = ranked.groupBy("window").agg(F.countDistinct("term").alias("terms"))
    first = ranked.where("rank = 1").select("window", F.col("term"))
    centres = stored(index.join(broadcast_if_small(first), "term").select(*DOC, "window", F.col("pos").alias("centre")), "centres")
    docs = broadcast_if_small(stored(centres.select(*DOC).distinct(), "near"))
    cell = lambda c: F.floor(c / F.lit(span))
    near = index.join(docs, [*DOC], "left_semi").join(broadcast_if_small(ranked.select("window", "term").distinct()), "term").withColumn("cell", cell(F.col("pos")))
    wide = centres.withColumn("cell", F.explode(F.array(*(cell(F.col("centre")) + i for i in (-1, 0, 1)))))
    both = wide.join(near, [*DOC, "window", "cell"]).where(F.abs(F.col("pos") - F.col("centre")) < span)
    hits = both.select(*DOC, "window", "centre", "pos", "term").distinct()
    starts = hits.select(*DOC, "window", "centre", F.col("pos").alias("start")).distinct()
    inside = starts.join(hits, [*DOC, "window", "centre"]).where("pos >= start AND pos < start + %d" % span)
    whole = inside.groupBy(*DOC, "window", "centre", "start").agg(F.countDistinct("term").alias("n")).join(broadcast_if_small(terms), "window").where("n = terms")
    return whole.select(*DOC, "window").distinct()


def hit_words(found: DataFrame) -> DataFrame:
    """doc, tid, n_hit: words under any occurrence; runs are merged in order of their starts."""
    runs = found.groupBy(*DOC, "start").agg(F.max("size").alias("size"))
    before = Window.partitionBy(*DOC).orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("size")
    rows = runs.select(*DOC, "start", end.alias("end"), F.max(end).over(before).alias("seen"))
    return rows.groupBy(*DOC).agg(F.sum(F.greatest(F.lit(0), F.col("end") - F.greatest("start", F.coalesce("seen", "start")))).cast("long").alias("n_hit"))


def search(index: DataFrame, tests: DataFrame, own: bool = False) -> DataFrame:
    """doc, tid, start, window, size of every occurrence of the (stored) windows. own: the index has their terms only."""
    return stored(phrases(index, rarest(tests, index, own)), "found")


def occurrences(documents: DataFrame, benchmark: DataFrame, width: int = WIDTH, key: str = "doc_id", item: str = "item_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(doc, tid, start, window, size of every occurrence; the windows), by an index of the benchmark's terms."""
    tests = stored(windows(benchmark.select(F.col(item).alias("item_id"), F.col(text).alias("text")), width), "tests")
    # rows that repeat a key and a text are indexed each, which changes no count below
    index = build_index(named(documents, key, text), stored(tests.select("term").distinct(), "vocabulary"))
    return search(index, tests, own=True), tests


def decontaminate(documents: DataFrame, benchmark: DataFrame, width: int = WIDTH, key: str = "doc_id", item: str = "item_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_hit, items (sorted array of item ids as strings) of every row."""
    found, tests = occurrences(documents, benchmark, width, key, item, text)
    owner = tests.select("window", "item_id").distinct()
    items = found.select(*DOC, "window").distinct().join(broadcast_if_small(owner), "window").select(*DOC, F.col("item_id").cast("string").alias("item")).distinct()
    items = items.groupBy(*DOC).agg(F.sort_array(F.collect_list("item")).alias("items"))  # as long as the benchmark at most
    base = named(documents, key, text).select(*DOC, n_words(F.col("text")).alias("n_words"))
    out = base.join(hit_words(found), [*DOC], "left").join(items, [*DOC], "left")
    key_ = F.nullif(F.col("doc"), F.lit(NO_KEY)).alias("doc_id")
    return out.select(key_, "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def clean(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` without any hit in their text, all columns kept."""
    bad = stored(occurrences(docs, benchmark, key=key, text=text)[0].select(*(F.col(c).alias(f"__{c}") for c in DOC)).distinct(), "bad")
    fits = (F.coalesce(docs[key].cast("long"), F.lit(NO_KEY)) == bad["__doc"]) & (F.xxhash64(docs[text]) == bad["__tid"])
    return docs.join(broadcast_if_small(bad), fits, "left_anti")


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("items", ","), 256)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), digest.alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def oracle() -> str:
    """The same by word lists and a join on whole windows."""
    lower = f"translate(text, '{UPPER}', '{SMALL}')"
    words = r"regexp_extract_all(%s, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')" % lower
    return f"""
WITH d AS (SELECT doc_id, coalesce({words}, []) AS w FROM documents WHERE doc_id IS NOT NULL),
b AS (SELECT item_id, w, least(len(w), {WIDTH}) AS k FROM (SELECT item_id, {words} AS w FROM benchmark) WHERE len(w) > 0),
t AS (SELECT DISTINCT item_id, k, array_to_string(w[i + 1:i + k], ' ') AS phrase FROM (SELECT item_id, w, k, unnest(range(len(w) - k + 1)) AS i FROM b)),
sizes AS (SELECT DISTINCT k FROM t),
s AS (SELECT doc_id, k, i, array_to_string(w[i + 1:i + k], ' ') AS phrase FROM (SELECT doc_id, w, k, unnest(range(len(w) - k + 1)) AS i FROM d, sizes WHERE len(w) >= k)),
m AS (SELECT s.doc_id, s.i, s.k, t.item_id FROM s JOIN t USING (k, phrase)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM m) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS x FROM m) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)"""
