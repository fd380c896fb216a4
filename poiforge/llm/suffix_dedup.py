"""Suffix-array dedup: bytes under strings of `width` bytes that start anywhere else are removed.

Sharding. Every window of `width` bytes has an anchor, the leftmost smallest hash among its substrings of `ANCHOR` bytes; equal
windows have equal anchors at the same offset. A run is what the windows of one anchor occurrence cover. Anchors are counted over all
texts, and the runs of those that occur twice go on. Equal runs are aggregated by two 64-bit hashes, of the anchor and
of the run, before their bytes are shuffled: one of each is cut out of the texts, with the number of its occurrences, and sharded by anchor, so that equal windows meet in one shard.

Sorting. A shard is one text on disk, of any size; its suffixes are sorted by external induction, with common prefixes (see
induced_sort). A window is repeated if its suffix shares `width` bytes with a neighbour in this order, where a run that stands for several
is its own neighbour. What the sort says of a run holds for all runs equal to it. Exact copies of a whole text, told by a
128-bit digest, are one text here and repeated as a whole.

Hot anchors. Where a third of all texts share a passage, its edges have one anchor with as many distinct surroundings. The runs of an
anchor with over `CROWD` bytes are cut into cells of `CELLS` offsets to the anchor, and keyed by the bytes that all windows of a cell have
in common (180, then all 200). Windows that are equal still meet; cells whose common bytes occur once are gone.

Texts longer than a block are worked on in slices, so memory is bounded for any text.

Edge cases: a null text is empty; texts below the width lose nothing; a null key takes part like any other document;
repeated rows are copies of each other; strings may overlap, also with themselves; extra columns are ignored, whatever their names; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
import mmap
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from poiforge.llm.common import blocks, broadcast_if_small, _BYTE, covered, discard, i64, mix64, Powers, released, rolling, spans_of, stored, string_parts, table
from poiforge.llm.induced_sort import MEMORY, Stream, Work, repeated
from poiforge.llm.substring_dedup import sliding

WIDTH = 200
#: Bytes of an anchor; a window has width - ANCHOR + 1 of them, so one place in 80 is an anchor.
ANCHOR = 40
#: Bytes of one anchor's runs beyond which they are cut into cells, and offsets of a cell, round by round.
CROWD, CELLS = 32 << 20, (21, 1)
#: Bytes of a shard, at most about (shards are smaller where there are more cores).
SHARD = 1 << 30
#: Bytes of a text that one vectorised step works on.
BLOCK = 1 << 16
_GRAM, _RUN = Powers(0x9FB21C651E98DF25), Powers(0xC3A5C85C97CB3127)
#: Low bits that hold a place in a piece of text, which has 2 * BLOCK + WIDTH bytes at most.
_PLACE, _MIX = np.uint64(2**20 - 1), np.uint64(0xBF58476D1CE4E5B9)


def slices(flat: np.ndarray, at: np.ndarray, width: int, most: int = BLOCK) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(bytes, offsets of texts, first byte): all texts at once, or one long text in slices that overlap by width - 1 bytes."""
    if len(at) == 2 and len(flat) > 2 * most:
        for lo in range(0, len(flat) - width + 1, most):
            part = flat[lo : lo + most + width - 1]
            yield part, np.array([0, len(part)]), lo
    else:
        yield flat, at, 0


def anchors(flat: np.ndarray, at: np.ndarray, width: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(windows that stay in their text, place of each one's anchor, hash of the `size` bytes from each place).

    The smallest hash is found together with its place, which stands in the low bits: of equal hashes the leftmost one wins."""
    n, many = len(flat), width - size + 1
    if n < width:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    gram = rolling(_BYTE[flat], size, _GRAM)
    gram ^= gram >> np.uint64(31)
    gram *= _MIX
    order = (gram & ~_PLACE) | np.arange(len(gram), dtype=np.uint64)
    inside = np.ones(n - width + 1, bool)
    for end in at[1:-1].tolist():  # windows across the end of a text; grams across it are in no others
        inside[max(0, end - width + 1) : end] = False
    starts = np.flatnonzero(inside)
    return starts, (sliding(order, many, np.minimum)[starts] & _PLACE).astype(np.int64), gram


class Hashes:
    """Hashes of any substrings of a piece of text."""

    def __init__(self, flat: np.ndarray):
        up, self.down = _RUN.get(len(flat) + 1)
        self.total = np.zeros(len(flat) + 1, np.uint64)
        np.cumsum(_BYTE[flat] * up[: len(flat)], out=self.total[1:])

    def of(self, lo: np.ndarray, length: np.ndarray) -> np.ndarray:
        return i64(mix64((self.total[lo + length] - self.total[lo]) * self.down[lo] + length.astype(np.uint64)))


def _batch(columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns.values()], names=list(columns))


_RUNS = "t1 long, t2 long, key long, hash long, start int, windows int, place int"


def _run(t1, t2, key, hash_, start, windows, place) -> dict[str, np.ndarray]:
    return {"t1": t1, "t2": t2, "key": i64(key), "hash": hash_, "start": start.astype(np.int32), "windows": windows.astype(np.int32), "place": place.astype(np.int32)}


def _run_rows(docs: DataFrame, width: int, size: int) -> DataFrame:
    """docs: t1, t2 (digest of the text), text. A row per run of windows of one anchor occurrence, with the hash of its bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, "text", BLOCK):
                whole, bounds, _ = string_parts(part.column(2))
                for flat, at, base in slices(whole, bounds, width):
                    starts, own, gram = anchors(flat, at, width, size)
                    if not len(starts):
                        continue
                    first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
                    lo, count = starts[first], np.diff(np.append(first, len(starts)))
                    text = np.searchsorted(at, lo, "right") - 1
                    anchor = own[first]
                    shift = base - at[text]
                    t1, t2 = (np.asarray(part.column(i))[text] for i in (0, 1))
                    yield _batch(_run(t1, t2, gram[anchor], Hashes(flat).of(lo, count + width - 1), lo + shift, count, anchor + shift))

    return docs.mapInArrow(released(run), _RUNS)


def _cell_rows(docs: DataFrame, width: int, size: int, cell: int) -> DataFrame:
    """docs: t1, t2, text, runs (start, windows, place). The runs cut into cells of `cell` offsets to the anchor, keyed by their common bytes."""
    many = width - size + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, "text", BLOCK):
                for t1, t2, raw, runs in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    runs = sorted(runs, key=lambda r: r["start"])
                    data = np.frombuffer(raw.encode(), np.uint8)
                    for k in range(0, len(runs), 1000):
                        some = runs[k : k + 1000]
                        # a run's cells; the common bytes of a cell go from its smallest offset's anchor place to its largest one's end
                        lengths = np.array([r["windows"] for r in some])
                        place = np.repeat(np.array([r["place"] for r in some]), lengths)
                        fresh = np.cumsum(lengths) - lengths
                        start = np.arange(len(place)) - np.repeat(fresh - np.array([r["start"] for r in some]), lengths)
                        number = (place - start) // cell
                        edge = np.ones(len(start), bool)
                        edge[1:] = (number[1:] != number[:-1]) | (start[1:] != start[:-1] + 1)
                        edge[fresh] = True
                        first = np.flatnonzero(edge)
                        windows = np.diff(np.append(first, len(start)))
                        lo, near, anchor = start[first], number[first] * cell, place[first]
                        base = int(lo.min())
                        piece = data[base : int((lo + windows).max()) + width - 1]
                        hashes = Hashes(piece)
                        common = width - np.minimum(cell - 1, many - 1 - near)
                        key = hashes.of(anchor - near - base, common) ^ near
                        yield _batch(_run(np.full(len(lo), t1), np.full(len(lo), t2), key, hashes.of(lo - base, windows + width - 1), lo, windows, anchor))

    return docs.mapInArrow(released(run), _RUNS)


def _body_rows(docs: DataFrame, width: int) -> DataFrame:
    """docs: t1, t2, text, runs (key, hash, several, start, windows). A row per run, with its bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, "text", BLOCK):
                for raw, runs in zip(part.column(2).to_pylist(), part.column(3), strict=True):
                    data, runs = raw.encode(), runs.values
                    for k in range(0, len(runs), 5000):
                        some = runs.slice(k, 5000)
                        lo, windows = (np.asarray(some.field(i)).astype(np.int64) for i in (3, 4))
                        body = pa.array([data[a:b] for a, b in zip(lo.tolist(), (lo + windows + width - 1).tolist(), strict=True)], pa.binary())
                        yield pa.RecordBatch.from_arrays([*(some.field(i) for i in range(3)), body], names=["key", "hash", "several", "body"])

    return docs.mapInArrow(released(run), "key long, hash long, several boolean, body binary")


def sort_shard(batches: Iterator[pa.RecordBatch], width: int, work: Work) -> Iterator[pa.RecordBatch]:
    """batches: key, hash, several (whether it stands for several equal runs), body. A row per stretch of repeated windows of a run, as a, b (half-open)."""
    text, runs = Stream((np.uint16,), work), Stream((np.int64, np.int64, bool, np.int64, np.int32), work)
    for batch in (whole.slice(k, 1024) for whole in batches for k in range(0, whole.num_rows, 1024)):
        flat, at, _ = string_parts(batch.column(3))
        rows = np.arange(batch.num_rows)
        laid = np.ones(len(flat) + len(rows), np.uint16)  # 1 ends each run
        laid[np.arange(len(flat)) + np.repeat(rows, np.diff(at))] = flat.astype(np.uint16) + 2
        keys = [c.to_numpy(zero_copy_only=False) for c in batch.columns[:3]]
        runs.add(*keys, text.n + at[:-1] + rows, np.diff(at) - width + 1)
        text.add(laid)
    if not runs.n:
        return
    text.add(np.zeros(1, np.uint16))
    flags = repeated(text.array(access=mmap.ACCESS_WRITE), width, work)
    step = 1024
    for k in range(0, runs.n, step):
        key, hash_, several, at, windows = runs.read(k, min(runs.n, k + step))
        end = int(runs.read(k + step, k + step + 1)[3][0]) if k + step < runs.n else text.n
        lo, size = at - at[0], end - int(at[0])
        # windows that lie inside their run; all of them where the run stands for several
        fine = covered(size, lo, lo + windows) & (flags[at[0] : end] | covered(size, lo[several], (lo + windows)[several]))
        lo, hi = (x + at[0] for x in spans_of(fine))
        o = np.searchsorted(at, lo, "right") - 1
        yield _batch({"key": key[o], "hash": hash_[o], "a": (lo - at[o]).astype(np.int32), "b": (hi - at[o]).astype(np.int32)})


def _sorted_rows(bodies: DataFrame, width: int, shards: int, memory: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from sort_shard(batches, width, Work(memory))

    return bodies.repartition(shards, "key").mapInArrow(released(run), "key long, hash long, a int, b int")


def removal(documents: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, crowd: int = CROWD, memory: int = MEMORY) -> DataFrame:
    """doc_id, text of every row, with `spans` (repeated windows' starts, half-open; null: none) and `whole` (the text occurs twice)."""
    spark = documents.sparkSession
    size = ANCHOR if width > 2 * ANCHOR else max(1, width // 2)
    same, ident = ["t1", "t2"], ["key", "hash"]
    digest = [F.xxhash64(F.col(text)).alias("t1"), F.xxhash64(F.lit(1), F.col(text)).alias("t2")]
    docs = documents.select(*digest, F.coalesce(F.col(text), F.lit("")).alias("text"), F.col(key).alias("doc_id"))
    # the row with the smallest key stands for all copies of a text
    copies = stored(docs.groupBy(*same).agg(F.count("*").alias("n"), F.min("doc_id").alias("rep")), "texts")
    found = stored(_run_rows(docs.select(*same, "text"), width, size), "runs")
    # an occurrence is a place of a distinct text; two hashed places that differ make two occurrences
    where = F.xxhash64(*same, "place")
    shared = stored(found.groupBy("key").agg(F.min(where).alias("x"), F.max(where).alias("y")).where("x <> y").select("key"), "shared")

    def pick(lists: DataFrame, column: str) -> DataFrame:
        """t1, t2, text and the list (bounded by its text), for the row that stands for the text."""
        lists = stored(lists.join(copies, same).select(F.col("t1").alias("u1"), F.col("t2").alias("u2"), "rep", column), column)
        lists = broadcast_if_small(lists, items=F.size(column))
        fits = (F.col("t1") == F.col("u1")) & (F.col("t2") == F.col("u2")) & F.col("doc_id").eqNullSafe(F.col("rep"))
        return docs.join(lists, fits).select(*same, "text", column)

    def counted(runs: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Distinct runs, with one of their occurrences and whether there are several; keys of two occurrences at least, with their bytes."""
        one = [F.first(c).alias(c) for c in (*same, "start", "windows")]
        named = stored(runs.groupBy(*ident).agg((F.count("*") > 1).alias("several"), *one), "named")
        two = (F.count("*") > 1) | F.bool_or("several")
        groups = named.groupBy("key").agg(two.alias("two"), F.sum(F.col("windows") + F.lit(width - 1)).alias("bytes")).where("two")
        return named, stored(groups.select("key", "bytes"), "groups")

    # copies of a text have equal rows
    runs = stored(found.join(shared, "key").dropDuplicates([*same, "start"]), "shared_runs")
    discard(found, shared)
    named, groups = counted(runs)
    all_runs, wanted, total = None, None, 0
    for cell in (*CELLS, None):
        calm = groups.where(F.col("bytes") <= crowd) if cell else groups
        rows = named.join(calm.select("key"), "key")
        part = runs.join(calm.select("key"), "key").select(*ident, *same, "start")
        wanted = rows if wanted is None else wanted.unionByName(rows)
        all_runs = part if all_runs is None else all_runs.unionByName(part)
        total += calm.agg(F.sum("bytes")).first()[0] or 0
        hot = groups.where(F.col("bytes") > crowd).select("key")
        if not cell or hot.isEmpty():
            break
        lists = runs.join(hot, "key").groupBy(*same).agg(F.collect_list(F.struct("start", "windows", "place")).alias("runs"))
        # repeated rows, also of the key that stands for a text, have equal cells
        runs = stored(_cell_rows(pick(lists, "runs"), width, size, cell).dropDuplicates([*same, "start"]), "cells")
        named, groups = counted(runs)

    lists = wanted.groupBy(*same).agg(F.collect_list(F.struct(*ident, "several", "start", "windows")).alias("runs"))
    shards = max(4 * spark.sparkContext.defaultParallelism, -(-total // SHARD))
    spans = stored(_sorted_rows(_body_rows(pick(lists, "runs"), width), width, shards, memory), "spans")
    spans = all_runs.join(spans, ident).select(*same, (F.col("start") + F.col("a")).alias("a"), (F.col("start") + F.col("b")).alias("b"))
    # neighbouring starts merge before they are gathered per text
    before = Window.partitionBy(*same).orderBy("a", "b")
    rows = spans.withColumn("seen", F.max("b").over(before.rowsBetween(Window.unboundedPreceding, -1)))
    rows = rows.withColumn("stretch", F.sum(F.when(F.col("seen") >= F.col("a"), 0).otherwise(1)).over(before))
    merged = rows.groupBy(*same, "stretch").agg(F.min("a").alias("a"), F.max("b").alias("b")).groupBy(*same).agg(F.collect_list(F.struct("a", "b")).alias("spans"))
    merged = merged.join(copies.where("n > 1").select(*same, F.lit(True).alias("whole")), same, "full")
    merged = stored(merged.select(*same, "spans", F.coalesce("whole", F.lit(False)).alias("whole")), "merged")
    return docs.join(merged, same, "left").select("doc_id", "text", "spans", F.coalesce("whole", F.lit(False)).alias("whole"))


def dedup(documents: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, crowd: int = CROWD, memory: int = MEMORY) -> DataFrame:
    """Per row: key, n_bytes, n_removed, kept (binary), spans (maximal removed runs of bytes, half-open)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, "text", 2 * BLOCK):
                out = []
                for raw, spans, whole in zip(*(part.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                    data = raw.encode()
                    n = len(data)
                    if whole and n >= width:
                        out.append((n, n, b"", [{"start": 0, "end": n}]))
                    elif spans:
                        gone = covered(n, np.array([s["a"] for s in spans]), np.array([s["b"] + width - 1 for s in spans]))
                        lo, hi = (x.tolist() for x in spans_of(gone))
                        kept = b"".join(data[a:b] for a, b in zip([0, *hi], [*lo, n], strict=True))
                        out.append((n, n - len(kept), kept, [{"start": a, "end": b} for a, b in zip(lo, hi, strict=True)]))
                    else:
                        out.append((n, 0, data, []))
                kinds = (pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True))], names=["doc_id", "n_bytes", "n_removed", "kept", "spans"])

    kind = dict(documents.dtypes)[key]
    rows = removal(documents, key, text, width, crowd, memory)
    return rows.mapInArrow(released(run), f"doc_id {kind}, n_bytes long, n_removed long, kept binary, spans array<struct<start:long,end:long>>").withColumnRenamed("doc_id", key)


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2(F.col("kept"), 256).alias("kept_sha256"))


def oracle() -> str:
    """The same by hashes of all strings of 200 bytes, on hexadecimal texts, which are cut into pieces of 400 bytes first."""
    return """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
cut AS (SELECT doc_id, c, substr(x, 800 * c + 1, 1198) AS y FROM (SELECT doc_id, x, unnest(range((length(x) // 2 + 200) // 400)) AS c FROM d WHERE length(x) >= 400)),
s AS (SELECT doc_id, 400 * c + j AS i, md5(substr(y, 2 * j + 1, 400)) AS h FROM (SELECT doc_id, c, y, unnest(range(least(400, length(y) // 2 - 199))) AS j FROM cut WHERE length(y) >= 400)),
again AS (SELECT h FROM s GROUP BY h HAVING count(*) > 1),
f AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS p FROM s JOIN again USING (h)),
g AS (SELECT doc_id, i, sum(CASE WHEN i <= p + 200 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM f),
spans AS (SELECT doc_id, k, min(i) AS lo, max(i) + 200 AS hi FROM g GROUP BY doc_id, k),
pieces AS (SELECT doc_id, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 0) AS a, lo AS b FROM spans UNION ALL SELECT doc_id, coalesce(max(hi), 0), any_value(length(x)) // 2 FROM d LEFT JOIN spans USING (doc_id) GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(substr(x, 2 * a + 1, 2 * (b - a)), '' ORDER BY a) AS t FROM pieces JOIN d USING (doc_id) GROUP BY doc_id),
total AS (SELECT doc_id, sum(hi - lo) AS gone, count(*) AS k FROM spans GROUP BY doc_id)
SELECT doc_id, length(x)::BIGINT // 2 AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed, coalesce(k, 0)::BIGINT AS n_spans, sha256(unhex(t)) AS kept_sha256 FROM d JOIN kept USING (doc_id) LEFT JOIN total USING (doc_id)"""


def brute_force(rows: list[tuple[int, str | None]], width: int = WIDTH) -> list[tuple[int, int, int, int, str]]:
    """The contract in plain Python, for tests."""
    texts = [(k, (t or "").encode()) for k, t in rows]
    seen = Counter(t[i : i + width] for _, t in texts for i in range(len(t) - width + 1))
    out = []
    for k, t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - width + 1):
            if seen[t[i : i + width]] > 1:
                gone[i : i + width] = True
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        out.append((k, len(t), int(gone.sum()), len(spans_of(gone)[0]), hashlib.sha256(kept).hexdigest()))
    return out
