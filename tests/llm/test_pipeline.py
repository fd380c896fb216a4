import re

import corpus_pipeline as cp
from poiforge.llm import minhash_dedup
from tests.llm.test_decontaminate import brute_force as hits

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [(r.item_id, r.text, "") for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    names = [n for n, _ in cp.STAGES]
    assert names == ["language_id", "near_dedup", "decontaminate", "pii", "encode"]
    a = cp.language_stage(spark, docs, SF).cache()
    assert a.columns == docs.columns and a.count() == docs.where("text rlike '[A-Za-z]'").count()
    b = cp.dedup_stage(spark, a, SF).cache()
    rows = [(r.doc_id, r.text) for r in a.collect()]
    kept = {k for k, _, _, keep in minhash_dedup.brute_force(rows, 5, 80) if keep}
    assert b.columns == docs.columns and {r.doc_id for r in b.collect()} == kept
    c = cp.decontamination_stage(spark, b, SF).cache()
    clean = {k for k, _, n, _, _ in hits([r for r in rows if r[0] in kept], items) if n == 0}
    assert c.columns == docs.columns and {r.doc_id for r in c.collect()} == clean
    d = cp.pii_stage(spark, c, SF).cache()
    assert d.columns == docs.columns and d.count() == c.count()
    assert all(r.n_chars == len(r.text) and not re.search(r"\w@\w+\.\w", r.text) for r in d.collect())
    e = cp.encoding_stage(spark, d, SF)
    want = {r.doc_id: r.text for r in d.collect()}
    got = e.collect()
    assert {r.doc_id for r in got} == set(want) and all(r.text == want[r.doc_id] for r in got)


def test_null_texts_and_keys_pass_the_filters(spark, odd_docs):
    out = cp.dedup_stage(spark, odd_docs, SF)
    assert out.columns == odd_docs.columns
    assert cp.pii_stage(spark, odd_docs, SF).columns == odd_docs.columns
    assert cp.decontamination_stage(spark, odd_docs, SF).count() == odd_docs.count()


def written(df, folder, name):
    df.write.parquet(f"{folder}/{name}.parquet")


def test_run_on_odd_rows_with_clashing_columns(spark, odd_docs, tmp_path):
    """All stages in turn, over nulls, empty and very long texts, copies, repeated rows and columns named like results."""
    docs = odd_docs.selectExpr("*", "'x' AS score", "'x' AS lang_pred", "'x' AS `a.b`", "'x' AS component_id", "'x' AS term")
    written(docs, tmp_path, "documents")
    item = next(r.text for r in docs.where("doc_id = 22").collect()).split()[50:65]
    written(spark.createDataFrame([(1, " ".join(item)), (2, None), (3, "")], "item_id long, text string"), tmp_path, "benchmark")
    got = cp.run(spark, str(tmp_path)).collect()
    kept, texts = {r.doc_id for r in got}, {r.doc_id: r.text for r in docs.collect()}
    # without letters, copies and near copies, and the benchmark's passage are gone
    assert not kept & {4, 5, 6, 2, 3, 22} and {1, 7, 8} <= kept
    assert all(r.text == texts[r.doc_id] for r in got)
    assert {(r.doc_id, r.sample) for r in got if r.doc_id == 1} == {(1, 1), (1, 2)}


def test_run_on_empty_tables(spark, no_docs, tmp_path):
    written(no_docs, tmp_path, "documents")
    written(spark.createDataFrame([], "item_id long, text string"), tmp_path, "benchmark")
    assert cp.run(spark, str(tmp_path)).count() == 0
