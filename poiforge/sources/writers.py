"""Sinks. A table is written into a folder of its own version, and a pointer file names the current one: readers see the old version or the
new one, a failed write changes nothing, and a stage may read the table that it replaces."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from poiforge.functions import geo

_POINTER = "_CURRENT"


def _fs(spark: SparkSession, path: str):
    """(Hadoop's file system of a path, its Path class)."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark._jsc.hadoopConfiguration()), make


def folder(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "errorifexists") -> None:
    """Parquet files with zstd, in Hive folders if asked. Spark's committer shows a new folder whole; overwriting a folder isn't atomic: see `table`."""
    write = df.write.mode(mode).option("compression", "zstd")
    (write.partitionBy(*partition_by) if partition_by else write).parquet(path)


def current(spark: SparkSession, path: str) -> str | None:
    """The folder of a table's current version."""
    fs, make = _fs(spark, path)
    at = make(f"{path}/{_POINTER}")
    if not fs.exists(at):
        return None
    stream = fs.open(at)
    try:
        name = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return f"{path}/{name}"


def table(df: DataFrame, path: str, partition_by: list[str] | None = None, keep_old: bool = False) -> str:
    """Write a new version and turn the pointer to it; the version before goes, unless asked to stay. Returns the new version's folder."""
    spark = df.sparkSession
    before, name = current(spark, path), f"v-{uuid.uuid4().hex}"
    folder(df, f"{path}/{name}", partition_by)
    fs, make = _fs(spark, path)
    fresh = make(f"{path}/{_POINTER}.{name}")
    out = fs.create(fresh, True)
    out.write(bytearray(name.encode()))
    out.close()
    # one rename over the old pointer
    options = spark._jvm.org.apache.hadoop.fs.Options.Rename
    array = spark._sc._gateway.new_array(options, 1)
    array[0] = options.OVERWRITE
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fresh.toUri() if fresh.toUri().getScheme() else fs.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(fresh), fs.makeQualified(make(f"{path}/{_POINTER}")), array)
    if before and not keep_old:
        fs.delete(make(before), True)
    return f"{path}/{name}"


def read(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a table."""
    at = current(spark, path)
    if at is None:
        raise FileNotFoundError(f"no committed version under {path}")
    return spark.read.parquet(at)


def update(spark: SparkSession, path: str, change: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Read, change and replace a table; the old version is read until the new one is complete."""
    table(change(read(spark, path)), path)
    return read(spark, path)


def sorted_table(df: DataFrame, path: str, by: str, partitions: int | None = None) -> str:
    """Range-partitioned and sorted, so that a filter on the column skips files and row groups. NULLs last."""
    order = F.col(by).asc_nulls_last()
    ranged = df.repartitionByRange(partitions, order) if partitions else df.repartitionByRange(order)
    return table(ranged.sortWithinPartitions(order), path)


def done(spark: SparkSession, path: str) -> bool:
    """Has a version been committed? Works on any file system that Spark reads."""
    return current(spark, path) is not None


def stage(spark: SparkSession, path: str, build: Callable[[], DataFrame], force: bool = False) -> DataFrame:
    """Build and write unless there is a committed output; returns the table."""
    if force or not done(spark, path):
        table(build(), path)
    return read(spark, path)


def debug_tables(spark: SparkSession, path: str, layers: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Each of some layers as a table of its own under the path."""
    return {name: stage(spark, f"{path}/{name}", lambda df=df: df, force=True) for name, df in layers.items()}


def tile_rows(layers: dict[str, DataFrame], zoom: int) -> DataFrame:
    """Layers as one table for a tile encoder: nested columns as text, points only, source_layer, z/x/y; missing columns NULL."""
    out = None
    for name, df in layers.items():
        kinds = dict(df.dtypes)
        flat = [F.to_json(F.col(f"`{c}`")).alias(c) if kinds[c].startswith(("struct", "map", "array")) else F.col(f"`{c}`").cast("string").alias(c) if c not in ("lon", "lat") else F.col(c) for c in df.columns]
        x, y = geo.tile(F.col("lon"), F.col("lat"), zoom)
        part = df.select(*flat).withColumns({"source_layer": F.lit(name), "z": F.lit(zoom), "x": x, "y": y})
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out
