"""Substring dedup: repeated word windows are found by Rabin-Karp hashes and removed as maximal intervals.

A window is `width` consecutive words of one document. A word goes if a window over it also starts in a document with a smaller
key. Every window is hashed by a rolling polynomial; Spark counts the hashes. So that only windows that can repeat are shuffled,
each window is first filed under its anchor, the smallest hash among its half-windows: equal windows have equal anchors, so
windows whose anchor occurs in one text only can't repeat. The anchors are a fourteenth of the windows.

Steps: (1) anchors of all texts, stored; (2) anchors of two different texts; (3) all windows under those, 96-bit hashes,
stored; (4) the smallest key of every hash, by partial aggregation; (5) windows with a smaller first key, merged into intervals
per document. Exact copies of a text never get to (3): all their windows occur in the smallest of them.

A hash with a third of all rows is aggregated before the shuffle, and joined back from stored tables, where Spark splits
skewed partitions. Only lists of one document's own positions are collected.

Edge cases: words are runs of anything but ASCII white space, a null text has none; a text of fewer words than the window loses
nothing; a null key is compared with nothing and loses nothing; repeated rows (same key) don't remove each other; rows with one
key and different texts are judged each by its own words; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from poiforge.llm.common import blocks, broadcast_if_small, covered, i64, mix64, released, rolling, spans_of, stored, string_parts, table, window_hashes, word_bounds, word_hashes, _WORD_POW

WIDTH = 50
_TOP = np.uint64(2**64 - 1)


def sliding(values: np.ndarray, width: int, op) -> np.ndarray:
    """op (np.minimum or np.maximum) over every run of `width` values, by doubling."""
    have, out = 1, values
    while 2 * have <= width:
        out = op(out[:-have], out[have:])
        have *= 2
    return op(out[: len(values) - width + 1], out[width - have :]) if have < width else out


def anchors(words: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of the half-window at each word, smallest such hash in each window, whether the window stays in one text).

    Places whose half-window or window crosses a text hold the largest value or False."""
    half = width // 2
    n, many = len(words), width - half + 1
    gram = np.full(n, _TOP)
    if n >= half:
        gram[: n - half + 1] = mix64(rolling(words, half, _WORD_POW))
    left = np.repeat(first[1:], np.diff(first)) - np.arange(n)  # words from here to the text's end
    gram[left < half] = _TOP
    if n < many:
        return gram, np.zeros(0, np.uint64), np.zeros(0, bool)
    return gram, sliding(gram, many, np.minimum), (left >= width)[: n - many + 1]


def chosen(gram: np.ndarray, smallest: np.ndarray, inside: np.ndarray, many: int) -> np.ndarray:
    """Places of half-windows that are the smallest of some window (every one of equal ones)."""
    if not len(smallest):
        return np.zeros(0, np.int64)
    least = np.where(inside, smallest, np.uint64(0))
    pad = np.zeros(many - 1, np.uint64)
    most = sliding(np.concatenate([pad, least, pad]), many, np.maximum)
    return np.flatnonzero((most == gram) & (gram < _TOP))


def _anchor_rows(docs: DataFrame, width: int) -> DataFrame:
    many = width - width // 2 + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, "text"):
                flat, at, _ = string_parts(part.column(2))
                starts, ends, first = word_bounds(flat, at)
                gram, smallest, inside = anchors(word_hashes(flat, starts, ends), first, width)
                place = chosen(gram, smallest, inside, many)
                text = np.searchsorted(first, place, "right") - 1
                cols = (np.asarray(part.column(0))[text], np.asarray(part.column(1))[text], i64(gram[place]), (place - first[text]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(list(map(pa.array, cols)), names=["doc_id", "tid", "anchor", "pos"])

    return docs.where("doc_id IS NOT NULL").mapInArrow(released(run), "doc_id long, tid long, anchor long, pos int")


def _window_rows(docs: DataFrame, width: int) -> DataFrame:
    """docs: doc_id, tid, text, at (places of shared anchors). A row per window whose anchor is shared."""
    many = width - width // 2 + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, "text"):
                flat, at, _ = string_parts(part.column(2))
                starts, ends, first = word_bounds(flat, at)
                words = word_hashes(flat, starts, ends)
                gram, smallest, inside = anchors(words, first, width)
                marks = part.column(3)
                place = np.asarray(marks.flatten()).astype(np.int64) + np.repeat(first[:-1], np.asarray(marks.value_lengths()))
                shared = np.full(len(gram), _TOP)
                shared[place] = gram[place]
                open_ = inside & (sliding(shared, many, np.minimum) == smallest) & (smallest < _TOP) if len(smallest) else inside
                text, pos, h, h2 = window_hashes(words, first, width, second=True)
                pick = open_[first[text] + pos]
                text, pos, h, h2 = text[pick], pos[pick], h[pick], h2[pick]
                cols = (np.asarray(part.column(0))[text], np.asarray(part.column(1))[text], pos.astype(np.int32), i64(h), (h2 >> np.uint64(32)).astype(np.uint32).view(np.int32))
                for lo in range(0, max(1, len(pos)), 200_000):
                    yield pa.RecordBatch.from_arrays([pa.array(c[lo : lo + 200_000]) for c in cols], names=["doc_id", "tid", "pos", "h", "h2"])

    return docs.mapInArrow(released(run), "doc_id long, tid long, pos int, h long, h2 int")


def removal(documents: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """doc_id, tid, text of every row with `at` (first words of windows to remove, null: none) and `whole` (an exact copy of a smaller key's text)."""
    docs = documents.select(F.col(key).cast("long").alias("doc_id"), F.xxhash64(text).alias("tid"), F.col(text).alias("text"))
    ids = docs.select("doc_id", "tid", F.md5("text").alias("digest")).where("doc_id IS NOT NULL AND digest IS NOT NULL")
    ids = stored(ids, "ids")
    groups = stored(ids.groupBy("digest").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("last")).where("least < last").select("digest", "least"), "copies")
    copies = ids.join(groups, "digest").where("doc_id > least").select("doc_id", "tid").distinct()
    found = stored(_anchor_rows(docs, width), "anchors")
    several = stored(found.groupBy("anchor").agg(F.min("tid").alias("a"), F.max("tid").alias("b")).where("a <> b").select("anchor"), "shared")
    marks = found.join(several, "anchor").groupBy("doc_id", "tid").agg(F.collect_set("pos").alias("at"))
    marks = broadcast_if_small(stored(marks.join(copies, ["doc_id", "tid"], "left_anti"), "marks"), items=F.size("at"))
    windows = stored(_window_rows(docs.join(marks, ["doc_id", "tid"]).select("doc_id", "tid", "text", "at"), width), "windows")
    first = windows.groupBy("h", "h2").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("last")).where("least < last").select("h", "h2", "least")
    again = windows.join(stored(first, "first"), ["h", "h2"]).where("doc_id > least")
    gone = again.groupBy("doc_id", "tid").agg(F.collect_set("pos").alias("at")).unionByName(copies.withColumn("at", F.lit(None).cast("array<int>")))
    return docs.join(gone.withColumn("whole", F.col("at").isNull()), ["doc_id", "tid"], "left").select("doc_id", "text", "at", F.coalesce("whole", F.lit(False)).alias("whole"))


def dedup(documents: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """Per row: key, n_words, n_removed, kept_text, spans (maximal removed intervals of words, half-open)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, "text"):
                out = []
                for raw, at, whole in zip(part.column(1).to_pylist(), part.column(2), part.column(3).to_pylist(), strict=True):
                    words = (raw or "").encode().split()
                    n = len(words)
                    if whole or at.is_valid:
                        starts = np.arange(max(0, n - width + 1)) if whole else np.asarray(at.values)
                        gone = covered(n, starts, starts + width)
                        lo, hi = spans_of(gone)
                        kept = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
                        out.append((n, int(gone.sum()), b" ".join(kept).decode(), [{"start": a, "end": b} for a, b in zip(lo.tolist(), hi.tolist(), strict=True)]))
                    else:
                        out.append((n, 0, b" ".join(words).decode(), []))
                cols = list(zip(*out, strict=True))
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, t) for c, t in zip(cols, kinds, strict=True))], names=["doc_id", "n_words", "n_removed", "kept_text", "spans"])

    rows = removal(documents, key, text, width)
    return rows.mapInArrow(released(run), "doc_id long, n_words long, n_removed long, kept_text string, spans array<struct<start:long,end:long>>").withColumnRenamed("doc_id", key)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text"), 256).alias("kept_sha256"), F.size("spans").cast("long").alias("n_spans"))


def oracle() -> str:
    """The same by hashes of all windows' words."""
    words = r"regexp_extract_all(text, '[^\x20\x09-\x0D]+')"
    return f"""
WITH d AS (SELECT doc_id, coalesce({words}, []) AS w FROM documents),
s AS (SELECT doc_id, i, md5(array_to_string(w[i + 1:i + {WIDTH}], ' ')) AS h FROM (SELECT doc_id, w, unnest(range(len(w) - {WIDTH - 1})) AS i FROM d WHERE len(w) >= {WIDTH})),
m AS (SELECT h, min(doc_id) AS first FROM s GROUP BY h),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + {WIDTH})) AS p FROM s JOIN m USING (h) WHERE first < doc_id),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS p FROM d),
kept AS (SELECT doc_id, count(*) AS k, string_agg(word, ' ' ORDER BY p) AS t FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id),
runs AS (SELECT doc_id, count(*) AS r FROM (SELECT doc_id, p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS gap FROM gone) WHERE gap IS NULL OR gap > 1 GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(k, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256, coalesce(r, 0)::BIGINT AS n_spans FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN runs USING (doc_id)"""


def brute_force(rows: list[tuple[int, str | None]], width: int = WIDTH) -> list[tuple[int, int, int, str]]:
    """The contract in plain Python, for tests."""
    least: dict[tuple, int] = {}
    split = [(k, (t or "").encode().split()) for k, t in rows]
    for k, w in split:
        for i in range(len(w) - width + 1):
            s = tuple(w[i : i + width])
            least[s] = min(k, least.get(s, k))
    out = []
    for k, w in split:
        gone = [False] * len(w)
        for i in range(len(w) - width + 1):
            if least[tuple(w[i : i + width])] < k:
                gone[i : i + width] = [True] * width
        out.append((k, len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone, strict=True) if not g)).hexdigest()))
    return out
