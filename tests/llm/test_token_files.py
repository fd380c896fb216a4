import zlib

import numpy as np
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from poiforge.llm.common import new_path
from poiforge.llm.token_files import MinimalPerfectHash, Shard, WordEncoder, default_tokenizer, read_ids, write_ids

TEXTS = ["Hello, World!\nit's a  test", "", None, "x́ Σας\tΣ\u00a0b <|endoftext|> c", "a\r\n b 12 3", "Ünïcödé " * 50, "ÀÉ, it's THE... ok?! don't-x don\u2019t (a) a- \u00df\u1e9e, \u0130x. X!"]


def whole(text):
    return [*Tokenizer.from_file(default_tokenizer()).encode(text or "", add_special_tokens=False).ids, 2]


def test_minimal_perfect_hash_is_a_bijection():
    keys = np.random.default_rng(1).integers(0, 2**63, 5000).astype(np.uint64)
    keys = np.unique(keys)
    slots = MinimalPerfectHash.build(keys).slots(keys)
    assert sorted(slots) == list(range(len(keys)))


def test_word_cache_equals_whole_text_encoding():
    enc = WordEncoder(default_tokenizer())
    for _ in range(2):
        ids, n = enc.encode([t or "" for t in TEXTS], 2)
        assert [list(x) for x in np.split(ids, np.cumsum(n)[:-1])] == [whole(t) for t in TEXTS]


def test_round_trip_with_nulls_repeats_and_lookup(spark):
    rows = [(7 * i % 11, t, "other") for i, t in enumerate(TEXTS)] + [(3, "twice", "x"), (3, "twice", "x"), (None, "no key", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    folder = new_path(spark, "ids")
    manifest = write_ids(docs, folder, default_tokenizer())
    got = read_ids(manifest, folder).orderBy("start").collect()
    want = sorted(((k, t or "") for k, t, _ in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    at = 0
    assert [r.doc_id for r in got] == [k for k, _ in want]
    for r in got:
        assert r.start == at
        at += r.n_tokens
    assert sorted((r.doc_id or -1, r.n_tokens, r.ids_crc32) for r in got) == sorted((k or -1, len(whole(t)), zlib.crc32(np.array(whole(t), "<u4").tobytes())) for k, t in want)
    shard = Shard(folder, manifest.where("doc_id = 3").first().shard)
    assert [list(x) for x in shard.documents(3)][:2] == [whole("twice")] * 2 or len(shard.documents(3)) == 3
    assert shard.documents(99) == []


def test_one_lookup_reads_a_few_words_of_the_index(spark):
    docs = spark.range(40_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("word "), "id").alias("text"))
    folder = new_path(spark, "ids")
    manifest = write_ids(docs, folder, default_tokenizer())
    number = manifest.where("doc_id = 31234").first().shard
    shard = Shard(folder, number)
    opened = shard.read_bytes
    assert [list(x) for x in shard.documents(31234)] == [whole("word 31234")] and shard.documents(10**12) == []
    assert shard.read_bytes - opened < 1000 and opened < 2000


def test_hot_key_and_very_long_text(spark):
    """A third of all rows under one key, and a text of a megabyte."""
    long = "Straße a1, " * 100_000
    rows = [(7, f"copy {i}") for i in range(300)] + [(1000 + i, f"other {i}") for i in range(600)] + [(5000, long)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    folder = new_path(spark, "ids")
    manifest = write_ids(docs, folder, default_tokenizer())
    got = read_ids(manifest, folder).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted(k for k, _ in rows)
    assert manifest.where("doc_id = 7").select("shard").distinct().count() > 1
    assert sorted(r.ids_crc32 for r in got) == sorted(zlib.crc32(np.array(whole(t), "<u4").tobytes()) for _, t in rows)


def test_other_tokenizers_get_whole_texts():
    """Tokenizers that keep case, or blanks, are found out by the probes."""
    import json
    from pathlib import Path

    found = 0
    for path in sorted(Path(default_tokenizer()).parent.glob("*.json")):
        if "model" not in json.loads(path.read_text()):
            continue
        found += 1
        enc, plain = WordEncoder(str(path)), Tokenizer.from_file(str(path))
        ids, n = enc.encode([t or "" for t in TEXTS], 0)
        assert [x[:-1].tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == [plain.encode(t or "", add_special_tokens=False).ids for t in TEXTS], path
    assert found > 1


def test_empty_table(spark):
    folder = new_path(spark, "ids")
    manifest = write_ids(spark.createDataFrame([], "doc_id long, text string"), folder, default_tokenizer())
    assert read_ids(manifest, folder).count() == 0
