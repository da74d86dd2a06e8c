"""Index of the storage paths that earlier batches own: a Bloom filter in front of exact rows.

Every path sets ``BITS`` bits of one 64-bit word (a register-blocked Bloom filter).
A day's filter is a table (word, bits), a few bytes a path, and a probe is an
equi-join on the word. The exact owners are kept in buckets of the path's hash. Only
paths that hit the filter are looked up, and only in their buckets.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bronzeflow.sinks.tables import read_table

#: Bits that a path sets in its word.
BITS = 5

_OWNERS = "storage_path string, s3_key string, bucket int, batch_id int"
_WORDS = "word bigint, bits bigint, batch_id int"


@dataclass(frozen=True)
class Index:
    """Folders of the filter and the owners; words of a day's filter; buckets of its owners.

    ``words`` times 64 bits at 16 bits a path or more keep false hits under about one
    in a hundred. Both counts are part of the stored layout.
    """

    root: str
    words: int = 1 << 20
    buckets: int = 16

    @property
    def filter_path(self) -> str:
        return f"{self.root}/owner_filter"

    @property
    def owner_path(self) -> str:
        return f"{self.root}/owners"


def _word(path: Column, index: Index) -> Column:
    return F.pmod(F.xxhash64(path, F.lit("word")), F.lit(index.words))


def _mask(path: Column) -> Column:
    """BITS bits of a word, from one hash; two of them may fall together."""
    bit = lambda i: F.expr(f"shiftleft(1L, CAST(pmod(shiftright(_hash, {6 * i}), 64) AS INT))")
    mask = bit(0)
    for i in range(1, BITS):
        mask = mask.bitwiseOR(bit(i))
    return mask


def _probed(paths: DataFrame, index: Index) -> DataFrame:
    """paths (storage_path, ...) with word, mask and bucket."""
    path = F.col("storage_path")
    bucket = F.pmod(F.xxhash64(path), F.lit(index.buckets)).cast("int")
    hashed = paths.withColumns({"_hash": F.xxhash64(path, F.lit("bits")), "_word": _word(path, index), "_bucket": bucket})
    return hashed.withColumn("_mask", _mask(path)).drop("_hash")


def write_owners(owners: DataFrame, index: Index, run_date: str, batch_id: int) -> None:
    """Add a batch's owners (storage_path, s3_key); a replayed batch replaces itself. Blank owners own nothing."""
    held = owners.filter(F.col("storage_path").isNotNull() & (F.coalesce(F.col("s3_key"), F.lit("")) != ""))
    named = _probed(held.groupBy("storage_path").agg(F.min("s3_key").alias("s3_key")), index)
    at = f"ingestion_date={run_date}/batch_id={int(batch_id)}"
    # The owners come first: a filter without owners would only cost a look, owners without a filter are not seen.
    named.select("storage_path", "s3_key", F.col("_bucket").alias("bucket")).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{index.owner_path}/{at}")
    words = named.groupBy(F.col("_word").alias("word")).agg(F.bit_or("_mask").alias("bits"))
    words.write.mode("overwrite").parquet(f"{index.filter_path}/{at}")


def maybe_owned(candidates: DataFrame, spark: SparkSession, index: Index, run_date: str, batch_id: int) -> DataFrame:
    """(storage_path, bucket) of candidate paths that the filter of the day's other batches does not exclude."""
    day = read_table(spark, f"{index.filter_path}/ingestion_date={run_date}", _WORDS).filter(F.col("batch_id") != batch_id)
    words = day.groupBy("word").agg(F.bit_or("bits").alias("bits"))
    wanted = _probed(candidates.select("storage_path").distinct(), index)
    hit = F.col("bits").bitwiseAND(F.col("_mask")) == F.col("_mask")
    return wanted.join(words, F.col("_word") == F.col("word")).filter(hit).select("storage_path", F.col("_bucket").alias("bucket"))


def owners_of(candidates: DataFrame, spark: SparkSession, index: Index, run_date: str, batch_id: int) -> DataFrame:
    """(storage_path, s3_key) that earlier batches of the day hold among the candidates' paths.

    ``candidates`` is read once; hand in a written table. Owners are read only from
    the buckets of hits: without hits no owner file is opened.
    """
    hits = maybe_owned(candidates, spark, index, run_date, batch_id)
    # At most as many numbers as there are buckets.
    buckets = sorted(r["bucket"] for r in hits.select("bucket").distinct().collect())
    if not buckets:
        return spark.createDataFrame([], "storage_path string, s3_key string")
    day = read_table(spark, f"{index.owner_path}/ingestion_date={run_date}", _OWNERS)
    held = day.filter((F.col("batch_id") != batch_id) & F.col("bucket").isin(buckets))
    asked = candidates.select("storage_path").distinct()
    return held.join(asked, "storage_path", "left_semi").groupBy("storage_path").agg(F.min("s3_key").alias("s3_key"))
