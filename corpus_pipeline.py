"""The corpus pipeline: five stages over `documents`, each written and read again before the next one.

language_id   keeps documents with a language (some letter, and, unless the text is short, phrases that aren't gibberish for the winner)
near_dedup    keeps one document, the smallest doc_id, of every component of near-duplicates (five words, similarity 0.8)
decontaminate keeps documents without any 10-word window of a benchmark item
pii           replaces personal data in the texts, and sets n_chars anew
encode        samples two distinct segmentations of every text and decodes them again

A table that lacks some column of `documents` works as long as doc_id and text (and lang for the first stage) are there; extra
columns are carried through, whatever their names. Rows with a null doc_id are judged like others, but for copies. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from poiforge.llm import decontaminate, language_id, minhash_dedup, piece_sampling, pii
from poiforge.llm.common import new_path, small_batches, table


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return language_id.keep_languages(docs, language_id.fit(docs))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return minhash_dedup.keep_one(docs, words=5, percent=80)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    out = pii.redacted(docs, pii.fit(docs))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars")).select(*(F.col(f"`{c}`") for c in docs.columns))
    return out


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, sample, n_pieces, ids_crc32, log_p, log_inclusion and the text that the pieces give back."""
    small_batches(spark)
    rows = piece_sampling.encode(docs, decoded=True)
    rows = rows.withColumn("n_pieces", (F.length("ids") / 4).cast("long")).withColumn("ids_crc32", F.crc32("ids"))
    return rows.select("doc_id", "sample", "n_pieces", "ids_crc32", "log_p", "log_inclusion", "text")


STAGES = [
    ("language_id", language_stage),
    ("near_dedup", dedup_stage),
    ("decontaminate", decontamination_stage),
    ("pii", pii_stage),
    ("encode", encoding_stage),
]

#: SQL can't express language identification, the sampled segmentations or the trained spans; tests/llm has the brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_path(spark, name)
        stage(spark, docs, sf_dir).write.option("compression", "zstd").parquet(path)
        docs = spark.read.parquet(path)
    return docs
