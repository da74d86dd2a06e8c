"""A key with a third of all rows does not end up in one task."""

import pytest
from pyspark.sql import functions as F

from bronzeflow.operators import guard, incremental, metrics
from bronzeflow.sources import listing
from bronzeflow.workspace import materialize

ROWS, TASKS = 96000, 32


@pytest.fixture
def many_tasks(spark):
    conf = {
        "spark.sql.shuffle.partitions": str(TASKS),
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    for name, value in conf.items():
        spark.conf.set(name, value)
    yield spark
    for name in conf:
        spark.conf.unset(name)
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def largest_share(df):
    sizes = df.groupBy(F.spark_partition_id().alias("task")).count()
    return sizes.agg(F.max("count") / F.sum("count")).first()[0]


def rows_with_hot_key(spark, name):
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 5000))
    return spark.range(0, ROWS, 1, 8).select(key.alias(name), F.col("id"))


def test_path_guard(many_tasks):
    candidates = materialize(
        rows_with_hot_key(many_tasks, "storage_path").selectExpr(
            "storage_path", "concat('s', id) AS s3_key", "'t' AS enqueued_at"
        ),
        "hot",
    )
    manifest = many_tasks.createDataFrame([("k1", "old")], "storage_path string, s3_key string")
    guarded = guard.guard_paths(candidates, manifest)
    assert largest_share(guarded) < 3 / TASKS
    assert guarded.count() == ROWS


def test_versions_of_repeated_items(many_tasks):
    items = rows_with_hot_key(many_tasks, "s3_key").withColumn("site_id", F.lit(1).cast("bigint"))
    versions = items.selectExpr(
        "'1' AS partition_key", "s3_key", "CAST(id % 7 AS INT) AS version", "'completed' AS status"
    )
    resolved = incremental.resolve_versions(items, versions)
    assert largest_share(resolved) < 3 / TASKS
    assert resolved.filter("s3_key = 'hot'").select("version").distinct().first().version == 7


def test_reservation(many_tasks):
    records = rows_with_hot_key(many_tasks, "record_key").withColumn("partition_date", F.lit("d"))
    store = many_tasks.createDataFrame(
        [("d", "k1", "pending")], "partition_date string, record_key string, status string"
    )
    outcomes = incremental.reserve_records(records, store, ["id"])
    assert largest_share(outcomes) < 3 / TASKS
    assert outcomes.filter("record_key = 'hot' AND outcome = 'NEW'").collect()[0].id == 0


def test_fan_in_and_incidents(many_tasks):
    keyed = many_tasks.range(0, ROWS, 1, 8).select(
        F.concat(F.lit("p/"), F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 900 + 2),
                 F.lit("_OEDI/data/"), "id", F.lit(".csv")).alias("key"), F.lit(0).alias("site_id"))
    sites = many_tasks.range(1, 902).select(F.col("id").alias("site_id"))
    found = listing.fan_in(keyed, sites, "p")
    assert largest_share(found) < 3 / TASKS and found.count() == ROWS
    versions = rows_with_hot_key(many_tasks, "dataset_id").withColumn("version", F.lit(2))
    incidents = versions.selectExpr("dataset_id", "version", "concat('i', id) AS incident_id")
    linked = metrics.link_incidents(versions, incidents)
    assert largest_share(linked) < 3 / TASKS and linked.count() == ROWS
