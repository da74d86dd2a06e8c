"""Repeated rows by fingerprint: exact, and wide rows stay where they are."""

import re

import pytest
from pyspark.sql import functions as F

from bronzeflow.operators import profile


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_repeated_rows_are_counted_by_dataset(spark):
    nan = float("nan")
    rows = [
        ("a", 1.0, "x"), ("a", 1.0, "x"), ("a", 1.0, "x"),
        ("a", None, "x"), ("a", None, "x"),
        ("b", 1.0, "x"), ("b", 2.0, None), ("b", 2.0, None),
        ("c", nan, ""), ("c", nan, ""), ("c", 0.0, ""), ("c", -0.0, ""),
        ("d", 1.0, "x"), (None, 1.0, "x"), (None, 1.0, "x"),
        # a null keeps a hash as it is: these two share a fingerprint, not their values
        ("e", 7.0, None), ("e", None, None),
    ]
    df = spark.createDataFrame(rows, "d string, v double, t string")
    got = {r.d: r.extra for r in profile.repeated_rows(df, "d", ["v", "t"]).collect()}
    assert got == {"a": 3, "b": 1, "c": 2, None: 1}


def test_shared_bits_and_fingerprints_do_not_count(spark, monkeypatch):
    monkeypatch.setattr(profile, "FINGERPRINT_BITS", 2)
    df = spark.range(1000).selectExpr("'d' AS d", "id DIV 2 * 2 + if(id < 10, 0, id % 2) AS v")
    assert [tuple(r) for r in profile.repeated_rows(df, "d", ["v"]).collect()] == [("d", 5)]
    same = spark.createDataFrame([("d", None, 7), ("d", 7, None)], "d string, v int, w int")
    assert profile.repeated_rows(same, "d", ["v", "w"]).count() == 0


@pytest.mark.parametrize("copies", [0, 1])
def test_no_rows_and_one_hot_row(spark, copies):
    df = spark.range(5000 * copies).selectExpr("'d' AS d", "if(id % 3 = 0, -1, id) AS v")
    got = [tuple(r) for r in profile.repeated_rows(df, "d", ["v"]).collect()]
    assert got == [("d", 1666)] * copies


def test_only_rows_with_a_repeated_fingerprint_are_shuffled(spark):
    """20,000 wide rows of which 50 repeat: the exchange of whole rows takes those and the few that share a bit."""
    wide = F.sha2(F.col("id").cast("string"), 512)
    rows = spark.range(20_000).unionAll(spark.range(50)).select(F.lit("d").alias("d"), wide.alias("w"))
    found = profile.repeated_rows(rows, "d", ["w"])
    assert [tuple(r) for r in found.collect()] == [("d", 50)]
    plan = plan_of(found)
    # what goes through an exchange keyed by the wide column comes out of the marked rows' filter
    assert re.search(r"Exchange hashpartitioning\(d#\d+, w#\d+", plan)
    assert plan.index("getbit") > plan.index("Exchange hashpartitioning(d#")
    assert "bitmap_construct_agg" in plan


def test_profile_without_repeats_has_zero(spark):
    df = spark.sql("SELECT * FROM VALUES ('d', timestamp'2024-01-01 00:00:00', 1), ('d', timestamp'2024-01-01 00:05:00', 1) AS t(d, ts, v)")
    row = profile.profile_dataset(df, "d", "ts", ["ts", "v"]).first()
    assert (row.row_count, row.duplicate_rows, row.basic_quality_score) == (2, 0, 1.0)
