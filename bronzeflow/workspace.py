"""Shared scratch space for intermediate tables and stream checkpoints."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


#: Rows of whole texts or sets that go to Python at once: Spark's 10,000 take several copies of tens of MB outside the heap.
BATCH_ROWS = 1024
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def materialize(df: DataFrame, name: str, batch_rows: int | None = None) -> DataFrame:
    """Write a frame that is read several times to the shared folder and read it back.

    With batch_rows, Arrow batches have at most so many rows while it is written.
    """
    path, conf = scratch_dir(df.sparkSession, name), df.sparkSession.conf
    before = conf.get(_BATCH)
    if batch_rows:
        conf.set(_BATCH, str(min(batch_rows, int(before)) if int(before) > 0 else batch_rows))
    try:
        df.write.parquet(path)
    finally:
        if batch_rows:
            conf.set(_BATCH, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new, not yet existing folder below a folder that the whole cluster shares.

    That is the one in ``spark.checkpoint.dir``, or, where it is unset, a folder
    in the session's warehouse.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return f"{base.rstrip('/')}/bronzeflow/{name}-{uuid.uuid4().hex}"
