"""Aggregates and checks of the quality report."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def summary(rows: DataFrame, *keys: str, score: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("n"), F.round(F.avg(score), 3).alias("mean"))


def percent_of_group(rows: DataFrame, group: str, flag: F.Column, name: str = "flag") -> DataFrame:
    """Counts by group and flag, with their percentage of the group."""
    counts = rows.groupBy(group, flag.alias(name)).agg(F.count("*").alias("n"))
    return counts.withColumn("pct", F.round(100 * F.col("n") / F.sum("n").over(Window.partitionBy(group)), 1))


def null_counts(rows: DataFrame, group: str, columns: list[str]) -> DataFrame:
    """group, column, nulls, pct: one pass, then unpivoted."""
    wide = rows.groupBy(group).agg(F.count("*").alias("_n"), *(F.count_if(F.col(c).isNull()).alias(c) for c in columns))
    long = wide.unpivot([group, "_n"], columns, "column", "nulls")
    return long.select(group, "column", "nulls", F.round(100 * F.col("nulls") / F.col("_n"), 1).alias("pct"))


def fill_rates(rows: DataFrame, group: str, columns: list[str]) -> DataFrame:
    """Size and percentage of filled values; rows without a group count as one."""
    filled = [F.round(100 * F.count_if(F.col(c).isNotNull()) / F.count("*"), 1).alias(f"{c}_pct") for c in columns]
    return rows.groupBy(group).agg(F.count("*").alias("n"), *filled)


def pivot_counts(rows: DataFrame, index: str, column: str, values: list[str], score: str) -> DataFrame:
    """Two measures by index and column value, absent combinations 0."""
    out = rows.groupBy(index).pivot(column, values).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(score), 3).alias("mean"))
    return out.fillna(0)


def histogram(rows: DataFrame, value: str, step: float) -> DataFrame:
    return rows.where(F.col(value).isNotNull()).groupBy(F.floor(F.col(value) / step).alias("bin")).agg(F.count("*").alias("n"))


def value_counts(rows: DataFrame, column: str) -> DataFrame:
    return rows.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))


def duplicate_keys(rows: DataFrame, key: str) -> DataFrame:
    return rows.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def dropped_keys(source: DataFrame, kept: DataFrame, key: str) -> DataFrame:
    """Keys of the source that didn't arrive."""
    return source.select(key).distinct().join(kept.select(key).distinct(), key, "left_anti")


def coverage(source: DataFrame, kept: DataFrame, key: str) -> DataFrame:
    """source keys, kept keys, percentage."""
    flag = kept.select(key).distinct().withColumn("_k", F.lit(1))
    rows = source.select(key).distinct().join(flag, key, "left")
    return rows.agg(F.count("*").alias("n_source"), F.count("_k").alias("n_kept")).withColumn("pct", F.round(100 * F.col("n_kept") / F.col("n_source"), 1))


def implies(rows: DataFrame, condition: F.Column, consequence: F.Column) -> DataFrame:
    """How many rows break a rule."""
    return rows.agg(F.count_if(condition & ~F.coalesce(consequence, F.lit(False))).alias("broken"))


def gaps(rows: DataFrame, other: DataFrame, key: str, column: str) -> DataFrame:
    """Keys on both sides whose column is empty on the left."""
    return rows.join(other.select(key).distinct(), key).where(F.col(column).isNull()).select(key)


def cluster_tiles(rows: DataFrame, tx: F.Column, ty: F.Column, layer: str) -> DataFrame:
    """Count and most frequent layer (ties to the smaller name) of each tile."""
    counts = rows.groupBy(tx.alias("tile_x"), ty.alias("tile_y"), layer).agg(F.count("*").alias("_n"))
    return counts.groupBy("tile_x", "tile_y").agg(F.sum("_n").alias("n"), F.min(F.struct((-F.col("_n")).alias("m"), F.col(layer).alias("l"))).alias("_b")).select("tile_x", "tile_y", "n", F.col("_b.l").alias("dominant"))


def ordered_counts(rows: DataFrame, *columns: str, name: str = "n") -> DataFrame:
    """Counts by columns (NULL is a group), most frequent first, ties by the columns."""
    return rows.groupBy(*columns).agg(F.count("*").alias(name)).orderBy(F.desc(name), *columns)


def geometry_types(rows: DataFrame, layer: str) -> DataFrame:
    """layer, geom_type, n: polygons are rows with a ring, points have a position, the rest is none."""
    kind = F.when(F.col("ring").isNotNull(), "Polygon").when(F.col("lon").isNotNull() & F.col("lat").isNotNull(), "Point").otherwise("None")
    return rows.groupBy(layer, kind.alias("geom_type")).agg(F.count("*").alias("n"))


def filled(c: F.Column) -> F.Column:
    return c.isNotNull() & (F.trim(c.cast("string")) != "")


def comparison(tables: dict[str, DataFrame], metrics: dict[str, dict[str, F.Column]]) -> DataFrame:
    """One row per metric with one column per table: how many rows hold its condition there; NULL where a table has no such metric."""
    out = None
    for name, df in tables.items():
        mine = {m: by[name] for m, by in metrics.items() if name in by}
        counts = df.agg(*(F.count_if(F.coalesce(c, F.lit(False))).alias(m) for m, c in mine.items()))
        long = counts.unpivot([], list(mine), "metric", name)
        out = long if out is None else out.join(long, "metric", "full")
    return out


def browse(rows: DataFrame, flag: F.Column, columns: list[str], n: int = 200) -> tuple[DataFrame, DataFrame]:
    """(how many rows hold the condition, the first n of them by the first column)."""
    hit = rows.where(flag)
    return hit.agg(F.count("*").alias("n")), hit.select(*(c for c in columns if c in rows.columns)).orderBy(columns[0]).limit(n)


def coverage_filter(rows: DataFrame, beds: F.Column, trauma: F.Column, missing: str = "all") -> DataFrame:
    """Rows that miss beds, trauma, both, or (all) any rows."""
    flags = {"beds": ~filled(beds), "trauma": ~filled(trauma), "both": ~filled(beds) & ~filled(trauma), "all": F.lit(True)}
    return rows.where(flags[missing])


def inventory(rows: DataFrame, table: str, linked: str) -> DataFrame:
    """Rows, linked rows and their percentage for each table of a union."""
    return rows.groupBy(table).agg(F.count("*").alias("row_count"), F.count(linked).alias("matched"), F.round(100 * F.count(linked) / F.count("*"), 1).alias("match_pct"))


def hierarchy_filter(rows: DataFrame, layers: list[str] | None = None, component: str | None = None, subcomponent: str | None = None, category: str | None = None) -> DataFrame:
    """Rows of the layers switched on (None: all), whose taxonomy levels equal those that are set."""
    for column, value in (("component", component), ("subcomponent", subcomponent), ("category", category)):
        if value is not None:
            rows = rows.where(F.col(column) == value)
    return rows if layers is None else rows.where(F.col("source_layer").isin(*layers))
