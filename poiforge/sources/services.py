"""Services that answer for addresses, as functions that the caller passes in: batches, or one request at a time."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Answer = dict[object, tuple[float, float] | None]


def _answers(keys: list, found: Answer, error: str | None, kind: pa.DataType) -> pa.RecordBatch:
    points = [found.get(k) or (None, None) for k in keys]
    return pa.RecordBatch.from_arrays([pa.array(keys, kind), pa.array([p[0] for p in points], pa.float64()), pa.array([p[1] for p in points], pa.float64()), pa.array([error] * len(keys), pa.string())], names=["key", "lon", "lat", "error"])


def geocode_batches(rows: DataFrame, key: str, call: Callable[[list[dict]], Answer], size: int = 9_999) -> DataFrame:
    """key, lon, lat, error of all rows. `call` gets lists of at most `size` rows as dicts and returns a point for each key that it knows;
    a batch whose call fails has the error's text in all its rows, and the others go on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []

        def ask() -> pa.RecordBatch:
            keys = [r[key] for r in held]
            try:
                return _answers(keys, call(held), None, kind)
            except Exception as e:  # whatever a service may fail with
                return _answers(keys, {}, f"{type(e).__name__}: {e}", kind)

        kind = None
        for batch in batches:
            kind = batch.schema.field(key).type
            for row in batch.to_pylist():
                held.append(row)
                if len(held) == size:
                    yield ask()
                    held = []
        if held:
            yield ask()

    return rows.mapInArrow(run, f"key {dict(rows.dtypes)[key]}, lon double, lat double, error string").withColumnRenamed("key", key)


def geocode_singly(rows: DataFrame, key: str, call: Callable[[dict], tuple[float, float] | None], most: int = 500, wait: float = 1.1) -> DataFrame:
    """The same for a service that takes one address at a time and allows so many requests: the first `most` rows by key, in one task, with a pause after each."""
    few = rows.orderBy(key).limit(most).coalesce(1)

    def one(batch: list[dict]) -> Answer:
        try:
            return {batch[0][key]: call(batch[0])}
        finally:
            time.sleep(wait)

    return geocode_batches(few, key, one, size=1)


def with_points(rows: DataFrame, answers: DataFrame, key: str) -> DataFrame:
    """The rows with the answers' points as re_lon and re_lat, where there are any."""
    return rows.join(answers.select(key, F.col("lon").alias("re_lon"), F.col("lat").alias("re_lat")), key, "left")
