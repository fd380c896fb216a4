"""Queries take all rows."""

import __spark_entry__

SF = "/root/testdata/sf0.001"


def run(spark, name, sf=SF):
    return __spark_entry__.queries()[name](spark, sf).collect()


def test_mercator_inflation_takes_every_customer_and_supplier(spark):
    rows = run(spark, "mercator_distance_vs_haversine")
    assert len(rows) == spark.read.parquet(f"{SF}/customer.parquet").count()
    assert len({r.s_suppkey for r in rows}) == spark.read.parquet(f"{SF}/supplier.parquet").count()


def test_every_part_is_geocoded(spark):
    rows = run(spark, "geocode_top1")
    assert {r.q for r in rows} == {r.p_partkey for r in spark.read.parquet(f"{SF}/part.parquet").collect()}


def test_rows_at_a_tier_edge_and_without_beds_stay(spark):
    n = spark.read.parquet(f"{SF}/customer.parquet").count()
    larger = SF.replace("0.001", "0.1")
    scores = run(spark, "confidence_score", larger)
    edge = {(r.score, r.tier) for r in scores if r.score in (0.75, 0.4)}
    assert len(scores) == spark.read.parquet(f"{larger}/customer.parquet").count() and edge == {(0.75, "high"), (0.4, "medium")}
    beds = {int(r.ID): r.BEDS for r in run(spark, "gold_hospital_table")}
    assert len(beds) == n and beds[50] == 7 and beds[52] == 2


def test_both_sides_of_the_matches_are_whole(spark):
    parts = {r.p_partkey for r in spark.read.parquet(f"{SF}/part.parquet").collect()}
    assert {r.provider_id for r in run(spark, "match_failure_reason")} == parts
    assert any(r.r % 3 for r in run(spark, "hospital_attribute_cascade"))
