"""Helpers shared by the operators of this subpackage: shared-folder tables, size-checked broadcasts and
vectorised word hashing over Arrow string buffers."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text bytes that one vectorised step works on; a longer text is a step of its own.
BLOCK_BYTES = 2 << 20
#: Rows (not bytes) up to which a table of narrow rows may be broadcast.
BROADCAST_ROWS = 200_000


#: Rows of an Arrow batch: with long texts, ten thousand of them take much memory outside the heap.
BATCH_ROWS = 2_000


def small_batches(spark: SparkSession) -> None:
    """Fewer rows in an Arrow batch, where the session has Spark's own value."""
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or one of our own in local mode, where that is unset."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        have = spark.sparkContext._jsc.sc().getCheckpointDir()
        if have.isDefined():
            at = have.get()
        elif spark.sparkContext.master.startswith("local") and "cluster" not in spark.sparkContext.master:
            at = "file://" + tempfile.mkdtemp(prefix="poiforge-")
            spark.sparkContext.setCheckpointDir(at)
        else:
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return at.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage: write df as Parquet in the shared folder and read it back."""
    path = new_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete stored tables that no later step reads, nor the result."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS, items: Column | None = None) -> DataFrame:
    """Hint a broadcast only if a count of the (stored) table stays under the bound, and that of its list items (if it has lists) under
    twenty times that; else Spark shuffles both sides."""
    n, listed = df.agg(F.count(F.lit(1)), F.lit(0) if items is None else F.sum(items)).first()
    return F.broadcast(df) if n <= rows and (listed or 0) <= 20 * rows else df


def released(run: Callable) -> Callable:
    """The same function over batches, which gives freed memory back to the system when a task ends: a worker waits for its next task, maybe for long."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (AttributeError, OSError):  # not every C library has it
                pass

    return task


def free_name(name: str, taken: list[str]) -> str:
    """The name, lengthened until no column has it (in any case)."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name += "_"
    return name


def string_parts(arr: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, offsets of each value from 0, valid) of a string column; a null has no bytes."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if arr.type not in (pa.string(), pa.binary()):
        arr = arr.cast(pa.binary() if pa.types.is_large_binary(arr.type) else pa.string())
    n = len(arr)
    valid = np.asarray(arr.is_valid())
    _, offsets, data = arr.buffers()
    if n == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64), valid
    at = np.frombuffer(offsets, np.int32)[arr.offset : arr.offset + n + 1].astype(np.int64)
    flat = np.frombuffer(data, np.uint8)[at[0] : at[-1]]
    return flat, at - at[0], valid


def blocks(batch: pa.RecordBatch, column: str, most: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batch whose text takes at most so many bytes (one row at least)."""
    _, at, _ = string_parts(batch.column(column))
    lo = 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + most, "right")) - 1)
        yield batch.slice(lo, hi - lo)
        lo = hi


def _random_u64(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 2**64, n, dtype=np.uint64)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of an odd base modulo 2**64 and of its inverse, kept between calls and lengthened on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base | 1, pow(base | 1, -1, 2**64)
        self.up, self.down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            step = np.ones(size, np.uint64)
            step[1:] = np.uint64(self.base)
            self.up = np.multiply.accumulate(step)
            step[1:] = np.uint64(self.inverse)
            self.down = np.multiply.accumulate(step)
        return self.up[:n], self.down[:n]


_BYTE = _random_u64(256, 11)
_BYTE_POW, _WORD_POW, _WORD_POW2 = Powers(0x9E3779B97F4A7C15), Powers(0xD1342543DE82EF95), Powers(0xA0761D6478BD642F)
_SALT2 = np.uint64(0x5851F42D4C957F2D)

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def rolling(values: np.ndarray, width: int, powers: Powers) -> np.ndarray:
    """Rabin-Karp: hash of every run of `width` consecutive 64-bit values, modulo 2**64, from prefix sums."""
    n = len(values)
    if n < width:
        return np.zeros(0, np.uint64)
    up, down = powers.get(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(values * up[:n], out=total[1:])
    return (total[width:] - total[:-width]) * down[: n - width + 1]


def word_bounds(flat: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of ASCII-white-space separated texts laid end to end: (first byte, end byte, first word of each text + total)."""
    solid = ~SPACE[flat]
    if not len(flat):
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(at), np.int64)
    edge = at[(at > 0) & (at < len(flat))]
    before = np.zeros(len(flat), bool)
    before[1:] = solid[:-1]
    before[edge] = False
    after = np.zeros(len(flat), bool)
    after[:-1] = solid[1:]
    after[edge - 1] = False
    starts = np.flatnonzero(solid & ~before)
    ends = np.flatnonzero(solid & ~after) + 1
    return starts, ends, np.searchsorted(starts, at)


def word_hashes(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A mixed 64-bit hash of each word's bytes."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _BYTE_POW.get(len(flat) + 1)
    total = np.zeros(len(flat) + 1, np.uint64)
    np.cumsum(_BYTE[flat] * up[: len(flat)], out=total[1:])
    return mix64((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def window_hashes(words: np.ndarray, first: np.ndarray, width: int, second: bool = False):
    """Hashes of all windows of `width` words that stay inside one text: (text number, first word inside the text, hash, hash2)."""
    h = rolling(words, width, _WORD_POW)
    counts = np.diff(first)
    inside = np.maximum(counts - width + 1, 0)
    text = np.repeat(np.arange(len(counts)), inside)
    pos = np.arange(int(inside.sum())) - np.repeat(np.cumsum(inside) - inside, inside)
    at = pos + first[:-1][text]
    h2 = mix64(rolling(mix64(words ^ _SALT2), width, _WORD_POW2)[at]) if second else None
    return text, pos, mix64(h[at]) if len(at) else np.zeros(0, np.uint64), h2


def spans_of(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of True: (starts, ends)."""
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def covered(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of n places lie in any of the half-open runs."""
    level = np.zeros(n + 1, np.int64)
    np.add.at(level, starts, 1)
    np.add.at(level, ends, -1)
    return np.cumsum(level[:-1]) > 0


def i64(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64)
