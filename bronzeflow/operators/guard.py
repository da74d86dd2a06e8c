"""One storage path belongs to one source object."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bronzeflow.operators.skew import skew_join


def path_owners(candidates: DataFrame, manifest: DataFrame) -> DataFrame:
    """Owner per storage path: the stored one, else the earliest enqueued candidate.

    Blank stored owners count as absent. Stored rows outrank candidates, so a
    single min over both gives the answer with a partial aggregate only.
    """
    stored = manifest.filter(F.coalesce(F.col("s3_key"), F.lit("")) != "").select(
        "storage_path",
        F.struct(F.lit(0).alias("rank"), F.lit("").alias("enqueued_at"), "s3_key").alias("claim"),
    )
    wanted = candidates.select(
        "storage_path", F.struct(F.lit(1).alias("rank"), "enqueued_at", "s3_key").alias("claim")
    )
    return (
        stored.unionByName(wanted)
        .groupBy("storage_path")
        .agg(F.min("claim").alias("claim"))
        .select("storage_path", F.col("claim.s3_key").alias("path_owner"))
    )


def guard_paths(candidates: DataFrame, manifest: DataFrame) -> DataFrame:
    """Add ``path_owner`` and ``admitted``; a refused candidate lost its path to another key.

    Works on metadata columns, before any content is read.
    """
    joined = skew_join(
        candidates,
        path_owners(candidates, manifest),
        on=["storage_path"],
        how="left",
        spread=["s3_key", "enqueued_at"],
    )
    return joined.withColumn("admitted", F.col("path_owner") == F.col("s3_key"))


def collision_reason() -> Column:
    """Failure text of a refused candidate."""
    return F.concat(
        F.lit("path "),
        F.col("storage_path"),
        F.lit(" belongs to "),
        F.col("path_owner"),
        F.lit(", refused for "),
        F.col("s3_key"),
    )
