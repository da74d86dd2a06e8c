"""Change detection, versions, path ownership and record reservation."""

import hashlib

import pytest
from pyspark.sql import functions as F

from bronzeflow.operators import guard, incremental
from bronzeflow.operators.skew import hot_key_hashes, skew_join, skew_join

LISTING = "site_id bigint, key string, size bigint, last_modified string"
BASE = ("partition_key string, row_key string, s3_key string, size bigint, "
        "last_modified string, status string")


def base(key, size, modified, status):
    return ("9068", hashlib.sha256(key.encode()).hexdigest(), key, size, modified, status)


@pytest.mark.parametrize(
    "tracked, listed, returned",
    [
        (None, ("k", 10, "d1"), True),
        (("k", 10, "d1", "completed"), ("k", 10, "d1"), False),
        (("k", 11, "d1", "completed"), ("k", 10, "d1"), True),
        (("k", 10, "d2", "completed"), ("k", 10, "d1"), True),
        (("k", 10, "d1", "failed"), ("k", 10, "d1"), True),
        (("k", 10, "d1", "queued"), ("k", 10, "d1"), True),
        (("k", 10, "d1", "processing"), ("k", 10, "d1"), True),
        (("k", 10, None, "completed"), ("k", 10, None), False),
        (("k", 10, None, "completed"), ("k", 10, ""), True),
    ],
)
def test_change_detection(spark, tracked, listed, returned):
    tracking = spark.createDataFrame([base(*tracked)] if tracked else [], BASE)
    listing = spark.createDataFrame([(9068, *listed)], LISTING)
    assert (incremental.detect_changes(listing, tracking).count() == 1) is returned


def test_same_key_of_other_site_is_new(spark):
    tracking = spark.createDataFrame([base("k", 1, "d", "completed")], BASE)
    listing = spark.createDataFrame([(9069, "k", 1, "d")], LISTING)
    assert incremental.detect_changes(listing, tracking).count() == 1


def test_version_counts_completed_only(spark):
    items = spark.createDataFrame(
        [(1, "a"), (1, "b"), (1, "c"), (2, "a")], "site_id bigint, s3_key string"
    )
    versions = spark.createDataFrame(
        [("1", "a", 1, "completed"), ("1", "a", 2, "completed"), ("1", "a", 3, "failed"),
         ("1", "b", 1, "processing"), ("1", "c", None, "completed")],
        "partition_key string, s3_key string, version int, status string",
    )
    for unique in (True, False):
        got = {
            (r.site_id, r.s3_key): r.version
            for r in incremental.resolve_versions(items, versions, unique).collect()
        }
        assert got == {(1, "a"): 3, (1, "b"): 1, (1, "c"): 1, (2, "a"): 1}


def test_point_read_prunes_and_pushes(spark, tmp_path):
    path = str(tmp_path / "versions")
    rows = [("1", "a", 1), ("1", "b'c", 2), ("2", "a", 3)]
    df = spark.createDataFrame(rows, "partition_key string, s3_key string, version int")
    df.write.partitionBy("partition_key").parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    found = incremental.tracked_versions(stored, 1, "b'c")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(partition_key" in plan and "EqualTo(s3_key,b'c)" in plan
    assert [r.version for r in found.collect()] == [2]


def test_latest_state_of_repeated_work_items(spark):
    items = spark.createDataFrame(
        [("a", "d1", "t1", "c1"), ("a", "d2", "t0", "c2"), ("a", "d2", "t0", "c2"), ("b", None, "t", "c")],
        "s3_key string, last_modified string, enqueued_at string, correlation_id string",
    )
    got = sorted(tuple(r) for r in incremental.unique_work_items(items).collect())
    assert got == [("a", "d2", "t0", "c2"), ("b", None, "t", "c")]


CANDIDATES = "storage_path string, s3_key string, enqueued_at string"


@pytest.mark.parametrize(
    "owner, admitted", [("k", True), ("other", False), ("", True), (None, True), ("absent", True)]
)
def test_stored_owner(spark, owner, admitted):
    candidates = spark.createDataFrame([("p", "k", "t")], CANDIDATES)
    stored = [] if owner == "absent" else [("p", owner)]
    manifest = spark.createDataFrame(stored, "storage_path string, s3_key string")
    assert guard.guard_paths(candidates, manifest).first().admitted is admitted


def test_one_winner_within_a_batch(spark):
    rows = [("p", f"k{i:04d}", f"t{i % 7}") for i in range(500)] + [("q", "z", "t")] * 2
    candidates = spark.createDataFrame(rows, CANDIDATES)
    manifest = spark.createDataFrame([], "storage_path string, s3_key string")
    won = guard.guard_paths(candidates, manifest).filter("admitted").collect()
    assert sorted((r.storage_path, r.s3_key) for r in won) == [("p", "k0000"), ("q", "z"), ("q", "z")]


STORE = "partition_date string, record_key string, status string"


def test_reservation(spark):
    records = incremental.with_record_key(
        spark.createDataFrame(
            [(1, 5, "2024-01-01T00:00"), (2, 5, "2024-01-01T00:00"), (3, 6, "2024-01-01T00:00"),
             (4, 7, "2024-01-02T00:00"), (5, 7, "2024-01-02T00:00"), (6, 8, "2024-01-02T00:00")],
            "n int, SiteID int, measdatetime string",
        )
    )
    store = spark.createDataFrame(
        [("2024-01-01", "6_2024-01-01T00:00", "completed"),
         ("2024-01-02", "7_2024-01-02T00:00", "pending"),
         ("2024-01-03", "9_2024-01-03T00:00", "pending")],
        STORE,
    )
    full = {r.n: r.outcome for r in incremental.reserve_records(records, store, ["n"]).collect()}
    assert full == {1: "NEW", 2: "DUPLICATE", 3: "DUPLICATE", 4: "RETRY_EMIT", 5: "DUPLICATE", 6: "NEW"}
    first = {r.n: r.outcome for r in incremental.reserve_first(records, store, ["n"]).collect()}
    assert first == {n: o for n, o in full.items() if o != "DUPLICATE"}


def test_completed_wins_over_pending(spark):
    records = spark.createDataFrame([("d", "k", 1)], "partition_date string, record_key string, n int")
    store = spark.createDataFrame([("d", "k", "pending"), ("d", "k", "completed")], STORE)
    assert incremental.reserve_records(records, store, ["n"]).first().outcome == "DUPLICATE"


def test_purge_keeps_the_window(spark):
    store = spark.createDataFrame([("2024-01-01",), ("2024-01-02",), ("2024-01-03",)], "partition_date string")
    kept = incremental.purge_expired(store, "2024-01-03", 1).collect()
    assert sorted(r[0] for r in kept) == ["2024-01-02", "2024-01-03"]
    with pytest.raises(ValueError):
        incremental.purge_expired(store, "2024-01-03", 0)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("join", [skew_join, skew_join])
def test_salted_joins_equal_a_plain_join(spark, how, join):
    left = spark.range(3000).select(
        F.col("id").alias("n"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None)
        .otherwise(F.concat(F.lit("k"), F.col("id") % 400)).alias("key"),
    )
    right = spark.createDataFrame(
        [("hot", "h1"), ("hot", "h2"), (None, "n")] + [(f"k{i}", str(i)) for i in range(0, 300, 2)],
        "key string, v string",
    )
    joined = join(left, right, ["key"], how, spread=["n"])
    renamed = right.withColumnRenamed("key", "rk")
    plain = left.join(renamed, F.col("key").eqNullSafe(F.col("rk")), how).drop("rk")
    got = sorted(map(repr, (tuple(r) for r in joined.select(*plain.columns).collect())))
    assert got == sorted(map(repr, (tuple(r) for r in plain.collect())))


def test_hot_keys_are_found_and_few(spark):
    left = spark.range(10000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"))
    hot = [r[0] for r in hot_key_hashes(left, ["k"]).collect()]
    wanted = spark.range(1).select(F.xxhash64(F.lit(-1).cast("bigint"))).first()[0]
    assert hot == [wanted]


def test_empty_left_side(spark):
    left = spark.createDataFrame([], "k string, n int")
    right = spark.createDataFrame([("a", 1)], "k string, v int")
    assert skew_join(left, right, ["k"], "left", ["n"]).count() == 0
