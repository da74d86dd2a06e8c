"""Append-only tables written batch by batch, safe to replay."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

TABLES = {
    "queued", "queue", "skipped", "rejected", "site_outcomes", "run_metrics",
    "attempts", "bronze", "sidecars", "events", "lifecycle", "dead_letters", "outcomes",
    "batch_times", "versions", "record_store", "record_events", "record_dead_letters", "record_metrics",
    "redeliveries", "exhausted", "batch_metrics",
}


@dataclass(frozen=True)
class Tables:
    """Folders of the tables a run keeps, by attribute."""

    root: str

    def __getattr__(self, name: str) -> str:
        if name not in TABLES:
            raise AttributeError(name)
        return f"{self.root}/{name}"


def write_batch(df: DataFrame, path: str, batch_id: int, partition_by: tuple[str, ...] = ()) -> None:
    """Write one batch to its own folder; a replayed batch replaces it."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{path}/batch_id={int(batch_id)}")


def read_table(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """All batches of a table; no batch yet gives an empty one."""
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    try:
        return spark.read.schema(wanted).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], wanted)


def read_batch(spark: SparkSession, path: str, batch_id: int, schema: T.StructType) -> DataFrame:
    """Rows of one batch."""
    return spark.read.schema(schema).parquet(f"{path}/batch_id={int(batch_id)}")


def _folder(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def subfolders(spark: SparkSession, path: str, name: str, kind: Callable = int) -> list:
    """Values of the folders ``name=value`` right below a path, in order; none if it does not exist."""
    system, at = _folder(spark, path)
    if not system.exists(at):
        return []
    found = [x.getPath().getName() for x in system.listStatus(at) if x.isDirectory()]
    return sorted(kind(x.removeprefix(f"{name}=")) for x in found if x.startswith(f"{name}="))


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder, if it is there."""
    system, at = _folder(spark, path)
    system.delete(at, True)
