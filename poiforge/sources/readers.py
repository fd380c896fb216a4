"""Sources: files into DataFrames with point geometry. Network services are provider tables here: what they would return is a DataFrame."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from poiforge.functions import geo


def parquet(spark: SparkSession, *paths: str, columns: list[str] | None = None, merge: bool = False) -> DataFrame:
    """Files, globs or Hive-partitioned folders; only the columns asked for are read."""
    df = spark.read.option("mergeSchema", str(merge).lower()).parquet(*paths)
    return df.select(*columns) if columns else df


def csv(spark: SparkSession, *paths: str, all_text: bool = False, date_format: str | None = None, skip_bad: bool = False, separator: str = ",") -> DataFrame:
    """Files with headers, united by column name. Malformed rows stay, with NULL where a field is absent or doesn't parse; `skip_bad` drops them."""
    out = None
    for path in paths:
        read = spark.read.option("header", "true").option("sep", separator).option("inferSchema", str(not all_text).lower()).option("mode", "DROPMALFORMED" if skip_bad else "PERMISSIVE")
        part = (read.option("dateFormat", date_format) if date_format else read).csv(path)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def merged(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A snapshot that is either one file or a folder of partition files of that name, with the union of their columns."""
    return spark.read.option("mergeSchema", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(f"{folder}/{name}*")


def boundaries(df: DataFrame, codes: list[str], column: str = "code") -> DataFrame:
    """The rows of these codes; raises unless every code has exactly one, so that a truncated file isn't taken for whole."""
    rows = df.where(F.col(column).isin(*codes))
    n, distinct = rows.agg(F.count("*"), F.countDistinct(column)).first()
    if n != len(set(codes)) or distinct != n:
        raise ValueError(f"{n} boundaries with {distinct} codes, {len(set(codes))} expected")
    return rows


def places(df: DataFrame) -> DataFrame:
    """Nested place records as flat rows: the first address, name and category levels, score and position."""
    address = lambda field: F.get("addresses", F.lit(0))[field]
    return df.select(
        F.col("id").alias("place_id"), F.col("names.primary").alias("place_name"), F.get("taxonomy.hierarchy", F.lit(0)).alias("level0"), F.get("taxonomy.hierarchy", F.lit(1)).alias("level1"), "confidence",
        address("freeform").alias("street"), address("locality").alias("city"), address("region").alias("state"), address("postcode").alias("postcode"), F.col("bbox.xmin").cast("double").alias("lon"), F.col("bbox.ymin").cast("double").alias("lat"),
    )


def valid_postcode(postcode: Column) -> Column:
    """Five digits; NULL isn't valid."""
    return F.coalesce(postcode.rlike(r"^\d{5}$"), F.lit(False))


# Fixed value: the country and its territories.
US_COUNTRIES = ("US", "PR", "VI", "GU", "MP", "AS", "UM")


def in_region(df: DataFrame, region: str) -> DataFrame:
    """All rows for ALL; else those with a valid postcode in the country (US: with its territories)."""
    if region == "ALL":
        return df
    return df.where(F.col("country").isin(*(US_COUNTRIES if region == "US" else (region,))) & valid_postcode(F.col("postcode")))


def pipe_records(lines: DataFrame, columns: list[str], record_type: str | None = None, column: str = "value") -> DataFrame:
    """Headerless pipe-separated lines of fixed arity as text columns; absent fields are NULL. Records of one type only, if asked."""
    parts = F.split(column, r"\|")
    rows = lines.select(*(F.nullif(F.get(parts, F.lit(i)), F.lit("")).alias(c) for i, c in enumerate(columns)))
    return rows.where(F.col(columns[0]) == record_type) if record_type else rows


def pipe_file(spark: SparkSession, path: str, columns: list[str], record_type: str | None = None) -> DataFrame:
    return pipe_records(spark.read.text(path), columns, record_type)


def json(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    return spark.read.option("multiLine", str(multiline).lower()).json(path)


def xlsx(spark: SparkSession, path: str, sheet: str | int = 0, header: int = 0) -> DataFrame:
    """All cells as text. Needs openpyxl on the driver: a workbook is a small file."""
    try:
        import pandas as pd

        frame = pd.read_excel(path, sheet_name=sheet, header=header, dtype=str)
    except ImportError as e:
        raise RuntimeError("reading workbooks needs openpyxl; save the sheet as CSV instead") from e
    return spark.createDataFrame(frame.where(frame.notna(), None))


def with_point(df: DataFrame, lon: str, lat: str, drop: bool = True) -> DataFrame:
    """lon and lat as doubles; both NULL unless both parse and lie on the globe. The source columns go if asked."""
    x, y = F.col(f"`{lon}`").try_cast("double"), F.col(f"`{lat}`").try_cast("double")
    fine = x.between(-180, 180) & y.between(-90, 90)
    names = [c for c in df.columns if not (drop and c in (lon, lat)) and c not in ("lon", "lat")]
    return df.select(*(F.col(f"`{c}`") for c in names), F.when(fine, x).alias("lon"), F.when(fine, y).alias("lat"))


def find_column(df: DataFrame, *names: str) -> str | None:
    """The first of the names that the frame has, whatever the case."""
    have = {c.lower(): c for c in df.columns}
    return next((have[n.lower()] for n in names if n.lower() in have), None)


def flatten_properties(df: DataFrame, column: str = "properties") -> DataFrame:
    """Fields of a nested struct as columns; existing names win."""
    fields = [f.name for f in df.schema[column].dataType.fields if f.name not in df.columns]
    return df.select(*(F.col(f"`{c}`") for c in df.columns if c != column), *(F.col(f"{column}.`{f}`").alias(f) for f in fields))


def field(df: DataFrame, name: str) -> Column:
    """A column by its own name, dots included, else by the path that the dots make; NULL if neither exists."""
    if name in df.columns:
        return F.col(f"`{name}`")
    kind = df.schema
    for part in name.split("."):
        kind = getattr(kind, "dataType", kind)
        if not hasattr(kind, "fieldNames") or part not in kind.fieldNames():
            return F.lit(None).cast("string")
        kind = kind[part]
    return F.col(".".join(f"`{p}`" for p in name.split(".")))


#: Columns of an institution that are carried on where the document has them.
INSTITUTION = ("institution_id", "institution_name", "address", "city", "state", "zip", "latitude", "longitude")


def institutions(df: DataFrame) -> DataFrame:
    """results[] -> childInstitutions[] -> one row each, with its address and position, and the level of its first program with one: adult before pediatric."""
    rows = df.select(F.explode("results").alias("r")).select(F.explode("r.childInstitutions").alias("i"))
    have = set(rows.schema["i"].dataType.fieldNames())
    level = lambda kind: F.get(F.filter("i.programs", lambda p: (p["program_type"] == kind) & p["level"].isNotNull()), F.lit(0))["level"]
    carried = [F.col(f"i.{c}") if c in have else F.lit(None).cast("string").alias(c) for c in INSTITUTION]
    return rows.select(*carried, F.coalesce(level("adult"), level("pediatric")).alias("trauma_level"))


def places_in(df: DataFrame, boxes: list[tuple[float, float, float, float]]) -> DataFrame:
    """Rows whose bbox struct touches any box; the disjunction is pushed to the scan."""
    hit = F.lit(False)
    for x0, y0, x1, y1 in boxes:
        hit = hit | ((F.col("bbox.xmin") <= x1) & (F.col("bbox.xmax") >= x0) & (F.col("bbox.ymin") <= y1) & (F.col("bbox.ymax") >= y0))
    return df.where(hit)


def allow_list(hierarchy: Column, allowed: list[tuple[str, str | None]]) -> Column:
    """First level equal, and the second one too unless it is a wildcard (None)."""
    out = F.lit(False)
    for first, second in allowed:
        hit = F.get(hierarchy, F.lit(0)) == first
        out = out | (hit & (F.get(hierarchy, F.lit(1)) == second) if second is not None else hit)
    return out


def newest_release(spark: SparkSession, folder: str, names: list[str] | None = None, truncated: bool = False) -> str:
    """Largest release=... folder in string order, from the folder's listing (or from a listing of names); no table is read.
    A listing that its service cut short is rejected: the newest name may be missing."""
    if truncated:
        raise ValueError("the listing is truncated")
    if names is None:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        names = [s.getPath().getName() for s in path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path) if s.isDirectory()]
    found = [n.rstrip("/").rpartition("release=")[2] for n in names if "release=" in n]
    if not found:
        raise FileNotFoundError(f"no release under {folder}")
    return max(found)


def tower_points(spark_lines: DataFrame, columns: list[str], record_type: str) -> DataFrame:
    """Points of coordinate records in arc-seconds (columns lat_seconds, lat_dir, lon_seconds, lon_dir)."""
    rows = pipe_records(spark_lines, columns, record_type)
    return rows.withColumns({"lat": geo.dms(F.col("lat_seconds"), F.col("lat_dir")), "lon": geo.dms(F.col("lon_seconds"), F.col("lon_dir"))})


class PagedSource(DataSource):
    """A paged service as a Spark source: option `fetch` names module:function(offset, size) -> list of dicts or of [key, value] lists.

    Partitions are page ranges when `total` is given; otherwise one task reads until a short page."""

    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        return "row map<string,string>"

    def reader(self, schema) -> DataSourceReader:
        return _PagedReader(self.options)


class _PagedReader(DataSourceReader):
    def __init__(self, options):
        self.fetch, self.size, self.total = options["fetch"], int(options.get("size", "5000")), options.get("total")

    def partitions(self) -> list[InputPartition]:
        if self.total is None:
            return [InputPartition(None)]
        return [InputPartition(at) for at in range(0, int(self.total), self.size)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        from importlib import import_module

        module, function = self.fetch.split(":")
        fetch: Callable = getattr(import_module(module), function)
        at = partition.value or 0
        while True:
            page = fetch(at, self.size)
            for row in page:
                yield ({str(k): None if v is None else str(v) for k, v in (row.items() if isinstance(row, dict) else row)},)
            if partition.value is not None or len(page) < self.size:
                return
            at += self.size
