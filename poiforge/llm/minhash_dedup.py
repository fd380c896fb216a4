"""Near-duplicate documents by min-max hashing, confirmed on full shingle sets.

A document's set is that of its distinct shingles (64-bit hashes of `words` consecutive lower-cased words; the whole text where it has
fewer). Each of the permutations (odd multiplications modulo 2**64) gives two signature values, the smallest and the largest image, so
half as many hashes are evaluated as with minima only. Bands of `ROWS` values put documents into buckets; with 28 bands of 4 values a
pair of similarity 0.85 is missed in one of a billion cases, one of 0.8 in four of a million.

Documents with equal sets count as one (the smallest key stands for them). Buckets don't emit pairs: every member is compared with its
bucket's smallest key, texts streaming past a copy of the leader's set. A bucket whose members aren't all tied together by such
links is searched exactly: its members' sets are held in blocks of bounded size, and each member is looked for among them by counting
its rarest shingles (so many of any k shingles of a set must be shared by a partner), then compared in full, unless the two are
tied together already. Only links that tie something together are emitted. A link holds by the exact integer test on
the full sets, and none between documents of a bucket is lost. Members and leaders are dealt over as many groups and blocks as they
need. Components come from the large-star / small-star iteration over stored edge tables.

Edge cases: null or empty texts (or white space only) have an empty set, link with nothing and stand alone; a row with a null key links
with nothing either, has no component (NULL) and is kept; rows that repeat a key are one document per distinct text, and all of them fall into the component of that key
(of the sets that a key stands for, those beyond the first have numbers above all keys, and edges tie them to it);
extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from poiforge.llm.common import blocks, broadcast_if_small, discard, i64, LOWER, mix64, released, rolling, stored, string_parts, table, word_bounds, word_hashes, _WORD_POW

BANDS, ROWS = 28, 4
#: Members that one copy of a leader is compared with in one group, and shingles that a block of an exact search holds.
GROUP, HELD = 200, 2_000_000
_MULTIPLIERS = np.random.default_rng(5).integers(0, 2**63, BANDS * ROWS // 2, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(flat: np.ndarray, at: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts end to end, and where each text's begin (+ total)."""
    low = LOWER[flat]
    starts, ends, first = word_bounds(low, at)
    hashes = word_hashes(low, starts, ends)
    n = np.diff(first)
    grams = np.zeros(len(hashes), np.uint64)
    if len(hashes) >= words:
        grams[: len(hashes) - words + 1] = mix64(rolling(hashes, words, _WORD_POW) + np.uint64(words))
    left = np.repeat(first[1:], n) - np.arange(len(hashes))
    keep = left >= words
    for i in np.flatnonzero((n > 0) & (n < words)):  # the whole sequence as one shingle
        one = rolling(hashes[first[i] : first[i + 1]], int(n[i]), _WORD_POW)
        grams[first[i]] = mix64(one + np.uint64(n[i]))[0]
        keep[first[i]] = True
    text = np.repeat(np.arange(len(n)), n)[keep]
    grams = grams[keep]
    order = np.lexsort((grams, text))
    grams, text = grams[order], text[order]
    fresh = np.ones(len(grams), bool)
    fresh[1:] = (grams[1:] != grams[:-1]) | (text[1:] != text[:-1])
    grams, text = grams[fresh], text[fresh]
    return grams, np.searchsorted(text, np.arange(len(n) + 1))


def signatures(grams: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Band hashes, (texts with a set) x BANDS: each permutation gives a minimum and a maximum."""
    begin = first[:-1][np.diff(first) > 0]
    values = np.empty((len(begin), BANDS * ROWS), np.uint64)
    if len(begin):
        for p, m in enumerate(_MULTIPLIERS):
            image = grams * m
            image ^= image >> np.uint64(32)
            values[:, 2 * p] = np.minimum.reduceat(image, begin)
            values[:, 2 * p + 1] = np.maximum.reduceat(image, begin)
    bands = np.zeros((len(begin), BANDS), np.uint64)
    for r in range(ROWS):
        bands = mix64(bands * np.uint64(0x9E3779B97F4A7C15) + values[:, r::ROWS])
    return mix64(bands + np.arange(BANDS, dtype=np.uint64)[None, :])


def features(docs: DataFrame, words: int, texts: bool = False) -> DataFrame:
    """doc_id, n (set size), s1, s2 (128-bit hash of the set), bands (null without a set), and the text if asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, "text"):
                flat, at, _ = string_parts(part.column(1))
                grams, first = shingle_sets(flat, at, words)
                n = np.diff(first)
                some = n > 0
                total = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(f(grams), dtype=np.uint64)]) for f in (lambda x: x, lambda x: mix64(x ^ np.uint64(0x2545F4914F6CDD1D)))]
                s1, s2 = (mix64(t[first[1:]] - t[first[:-1]] + n.astype(np.uint64)) for t in total)
                bands = np.zeros((len(n), BANDS), np.uint64)
                bands[some] = signatures(grams, first)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * BANDS), pa.array(i64(bands.ravel())))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n), pa.array(i64(s1)), pa.array(i64(s2)), lists, *([part.column(1)] if texts else [])], names=["doc_id", "n", "s1", "s2", "bands", *(["text"] if texts else [])])

    return docs.mapInArrow(released(run), "doc_id long, n long, s1 long, s2 long, bands array<long>" + (", text string" if texts else ""))


def confirm(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets satisfy 100 * intersection >= percent * union. texts: stored rep, text."""
    pairs = stored(pairs, "pairs")
    load = stored(pairs.groupBy("a").agg(F.ceil(F.count("*") / GROUP).alias("groups")), "load")
    dealt = pairs.join(broadcast_if_small(load), "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("groups")).alias("g"))
    members = dealt.join(texts, dealt["b"] == texts["rep"]).select("a", "g", "b", "text")
    leaders = load.join(texts, load["a"] == texts["rep"]).select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1)).alias("g"), F.col("a").alias("b"), "text")
    both = members.unionByName(leaders).repartition("a", "g").sortWithinPartitions("a", "g", F.col("a") != F.col("b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leader, own = None, np.zeros(0, np.uint64)
        for batch in batches:
            for part in blocks(batch, "text"):
                flat, at, _ = string_parts(part.column(3))
                grams, first = shingle_sets(flat, at, words)
                a, b = np.asarray(part.column(0)), np.asarray(part.column(2))
                good = []
                for i in range(len(a)):
                    mine = grams[first[i] : first[i + 1]]
                    if a[i] == b[i]:
                        leader, own = a[i], mine
                        continue
                    assert leader == a[i]
                    if similar(mine, own, percent):
                        good.append(i)
                yield pa.RecordBatch.from_arrays([pa.array(a[good]), pa.array(b[good])], names=["a", "b"])

    return both.mapInArrow(released(run), "a long, b long")


class Searcher:
    """Sets of one block, and the search for a set's partners among them."""

    def __init__(self, reps: list[int], labels: list[int], sets: list[np.ndarray], percent: int):
        self.reps, self.sets, self.percent = reps, sets, percent
        self.parent: dict[int, int] = {}
        self.labels = labels
        tokens = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        order = np.argsort(tokens, kind="stable")
        self.owner = owner[order]
        self.token, self.at = np.unique(tokens[order], return_index=True)
        self.count = np.diff(np.append(self.at, len(tokens)))
        self.size = np.array([len(x) for x in sets])

    def root(self, x: int) -> int:
        while (up := self.parent.get(x, x)) != x:
            self.parent[x] = x = self.parent.get(up, up)
        return x

    def links(self, rep: int, label: int, mine: np.ndarray) -> list[tuple[int, int]]:
        """Links of the set that tie its component to another one."""
        n, q = len(mine), self.percent
        place = np.minimum(np.searchsorted(self.token, mine), len(self.token) - 1)
        known = self.token[place] == mine
        often = np.where(known, self.count[place], 0)
        # a partner of size m shares at least `least` shingles, so at most n - least of any of mine are missing in it
        least = -(-q * (n + self.size) // (100 + q))
        few = min(n, 3 * (n - -(-q * n // 100)) + 1)
        rare = np.argsort(often, kind="stable")[:few]
        use = place[rare[known[rare]]]
        lists = self.count[use]
        hits = self.owner[np.arange(int(lists.sum())) + np.repeat(self.at[use] - (np.cumsum(lists) - lists), lists)]
        shared = np.bincount(hits, minlength=len(self.sets))
        maybe = np.flatnonzero((shared >= few - (n - least)) & (100 * np.minimum(n, self.size) >= q * np.maximum(n, self.size)))
        out = []
        for i in maybe[np.argsort(-shared[maybe], kind="stable")].tolist():
            a, b = self.root(label), self.root(self.labels[i])
            if a == b or self.reps[i] == rep:
                continue
            if similar(mine, self.sets[i], q):
                self.parent[max(a, b)] = min(a, b)
                out.append((min(rep, self.reps[i]), max(rep, self.reps[i])))
        return out


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, of sorted sets."""
    small, large = (x, y) if len(x) <= len(y) else (y, x)
    if not len(small) or 100 * len(small) < percent * len(large):
        return False
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    shared = int((large[at] == small).sum())
    return 100 * shared >= percent * (len(small) + len(large) - shared)


def search(now: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Links (a, b) that tie together components within buckets. now: stored bucket, rep, n, label."""
    load = stored(now.groupBy("bucket").agg(F.ceil(F.sum("n") / HELD).alias("blocks")), "load")
    each = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
    rows = now.join(load, "bucket").withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")))
    # block i is held, block j <= i asks: every two blocks meet once
    held = rows.select("bucket", F.col("own").alias("i"), each("blocks").alias("j"), F.lit(0).alias("role"), "rep", "label").where("j <= i")
    asks = rows.select("bucket", each("blocks").alias("i"), F.col("own").alias("j"), F.lit(1).alias("role"), "rep", "label").where("j <= i")
    both = held.unionByName(asks).join(texts, "rep").select("bucket", "i", "j", "role", "rep", "label", "text")
    both = both.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "role", "rep")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, reps, labels, sets, block = None, [], [], [], None
        for batch in batches:
            for part in blocks(batch, "text"):
                flat, at, _ = string_parts(part.column(6))
                grams, first = shingle_sets(flat, at, words)
                out = []
                for n, row in enumerate(zip(*(part.column(c).to_pylist() for c in range(6)), strict=True)):
                    if row[:3] != group:
                        group, reps, labels, sets, block = row[:3], [], [], [], None
                    mine = grams[first[n] : first[n + 1]]
                    if row[3] == 0:
                        reps.append(row[4])
                        labels.append(row[5])
                        sets.append(mine.copy())
                    elif sets:
                        block = block or Searcher(reps, labels, sets, percent)
                        out += block.links(row[4], row[5], mine)
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["a", "b"])

    return both.mapInArrow(released(run), "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) of all nodes of the edges (a, b): large-star and small-star until nothing changes."""
    edges = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        old = edges
        nearest = stored(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        large = both.join(nearest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.where("u <> v").distinct(), "large")
        least = stored(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        edges = stored(small.where("u <> v").distinct(), "edges")
        discard(old, nearest, large, least)
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == state:
            # stars only: every node points at its component's smallest
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        state = now


def near_duplicates(documents: DataFrame, words: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (smallest key that links lead to), kept (it is its component's smallest)."""
    every = documents.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    docs = every.where("doc_id IS NOT NULL")
    found = stored(features(docs, words), "features")
    sets = stored(found.where("n > 0").groupBy("s1", "s2").agg(F.min("doc_id").alias("key")), "sets")
    several = stored(found.groupBy("doc_id").agg(F.min(F.struct("s1", "s2")).alias("x"), F.max(F.struct("s1", "s2")).alias("y")).where("x <> y").select("doc_id"), "several")
    repeated = several.count() > 0
    if repeated:
        above = found.agg(F.max("doc_id")).first()[0] + 1
        nth = F.row_number().over(Window.partitionBy("key").orderBy("s1", "s2"))
        sets = stored(sets.withColumns({"nth": nth, "more": F.monotonically_increasing_id() + above}).select("s1", "s2", "key", F.when(F.col("nth") == 1, F.col("key")).otherwise(F.col("more")).alias("rep")), "sets")
    else:
        sets = sets.withColumn("rep", F.col("key"))
    members = stored(found.select("doc_id", "n", "s1", "s2").join(sets, ["s1", "s2"], "left").select("doc_id", "n", F.coalesce("rep", "doc_id").alias("rep")), "members")
    bands = found.where("n > 0").join(sets, (found["s1"] == sets["s1"]) & (found["s2"] == sets["s2"]) & (found["doc_id"] == sets["key"])).select("rep", "n", "bands").dropDuplicates(["rep"])
    bands = bands.select("rep", "n", F.explode("bands").alias("bucket"))
    # the leader's size comes along, so that no join meets all members of a leader in one task
    leaders = bands.groupBy("bucket").agg(F.count("*").alias("c"), F.min("rep").alias("leader"), F.min_by("n", "rep").alias("leader_n"))
    crowded = stored(leaders.where("c > 1").drop("c"), "crowded")
    inside = stored(bands.join(crowded, "bucket").select("bucket", "leader", "leader_n", "rep", "n"), "inside")
    wanted = stored(inside.select("rep").distinct(), "wanted")
    texts = docs.join(broadcast_if_small(wanted), docs["doc_id"] == wanted["rep"]).select("rep", "text")
    if repeated:
        own = features(docs.join(broadcast_if_small(several), "doc_id", "left_semi"), words, texts=True).join(sets, ["s1", "s2"]).where("doc_id = key").select("rep", "text")
        texts = texts.join(broadcast_if_small(several), F.col("rep") == several["doc_id"], "left_anti").unionByName(own.join(wanted, "rep", "left_semi").dropDuplicates(["rep"]))
    texts = stored(texts, "texts")
    discard(found, crowded, wanted)

    close = (F.col("rep") != F.col("leader")) & (100 * F.least("n", "leader_n") >= percent * F.greatest("n", "leader_n"))
    pairs = inside.where(close).select(F.col("leader").alias("a"), F.col("rep").alias("b")).distinct()
    edges = stored(confirm(pairs, texts, words, percent), "links")
    # a leader is smaller than its members, so two steps down tie a member to its smallest leader's own
    down = stored(edges.groupBy("b").agg(F.min("a").alias("a")), "down")
    tied = down.join(down.select(F.col("b").alias("a"), F.col("a").alias("aa")), "a", "left").select(F.col("b").alias("rep"), F.coalesce("aa", "a").alias("label"))
    now = stored(inside.select("bucket", "rep", "n").join(tied, "rep", "left").withColumn("label", F.coalesce("label", "rep")), "now")
    mixed = now.groupBy("bucket").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y").select("bucket")
    edges = edges.unionByName(stored(search(stored(now.join(mixed, "bucket"), "mixed"), texts, words, percent), "links"))
    if repeated:
        edges = edges.unionByName(members.join(broadcast_if_small(several), "doc_id", "left_semi").where("rep <> doc_id").select(F.col("doc_id").alias("a"), F.col("rep").alias("b")))
    label = stored(components(edges), "labels")
    out = members.join(label, members["rep"] == label["node"], "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "rep").alias("component_id"))
    out = out.withColumn("kept", F.col("doc_id") == F.col("component_id"))
    nameless = features(every.where("doc_id IS NULL"), words)
    return out.unionByName(nameless.select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(True).alias("kept")))


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80, key: str = "doc_id") -> DataFrame:
    """The rows of `docs` without those whose component has a smaller key; all columns and rows with a null key stay."""
    gone = near_duplicates(docs, words, percent, key).where(~F.col("kept")).select(F.col("doc_id").alias("__gone")).distinct()
    gone = stored(gone, "gone")
    return docs.join(broadcast_if_small(gone), docs[key] == gone["__gone"], "left_anti")


def op6_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)


def oracle() -> str:
    """The same by counting the shingles that any two documents share, and the closure of the links."""
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    words = r"regexp_extract_all(%s, '[^\x20\x09-\x0D]+')" % lower
    return f"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce({words}, []) AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i + 1:i + least(3, len(w))], ' ') AS g FROM (SELECT doc_id, w, unnest(range(greatest(len(w) - 2, 1))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM shared JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * k >= 85 * (p.n + q.n - k)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(a, b) AS (SELECT a, b FROM both_ways UNION SELECT reach.a, l.b FROM reach JOIN both_ways l ON reach.b = l.a),
least AS (SELECT a AS doc_id, min(b) AS c FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(doc_id, coalesce(c, doc_id)) AS component_id, doc_id <= coalesce(c, doc_id) AS kept FROM d LEFT JOIN n USING (doc_id) LEFT JOIN least USING (doc_id)"""


def brute_force(rows: list[tuple[int, str | None]], words: int, percent: int) -> list[tuple[int, int, int, bool]]:
    """All pairs in plain Python, for tests."""
    sets = {}
    for k, t in rows:
        w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "").encode().split()
        sets[k] = {tuple(w[i : i + words]) for i in range(len(w) - words + 1)} or ({tuple(w)} if w else set())
    parent = {k: k for k in sets}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)) and 100 * len(x & y) >= percent * len(x | y):
                ra, rb = root(a), root(b)
                parent[max(ra, rb)] = min(ra, rb)
    return [(k, len(sets[k]), root(k), root(k) == k) for k in keys]
