"""Equi-join that spreads hot keys of the left side over many tasks.

AQE splits a skewed shuffle partition only where the shuffle feeds the join
directly; a right side that was just aggregated on the join keys does not.
``skew_join`` finds hot keys with one constant-size frequent-items sketch over the
key columns and salts only those. Hot is what holds more than one shuffle task's
even share of the rows; a hot key is dealt to as many salts as there are shuffle
partitions. The sketch decides nothing but the salting, so its error never
changes a result. The join reads ``left`` twice: hand in a written table when
computing ``left`` is costly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F



def _tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def hot_key_hashes(df: DataFrame, on: list[str]) -> DataFrame:
    """Hashes of keys that hold more than an even share of the rows: fewer than shuffle partitions."""
    tasks = _tasks(df)
    sketch = df.select(F.xxhash64(*on).alias("key_hash")).agg(
        F.expr(f"approx_top_k(key_hash, {tasks}, {max(1024, 8 * tasks)})").alias("top"),
        F.count(F.lit(1)).alias("total"),
    )
    return (
        sketch.select("total", F.explode("top").alias("entry"))
        .filter(F.col("entry.count") * tasks > F.col("total"))
        .select(F.col("entry.item").alias("hot_hash"))
    )


def skew_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str,
    spread: list[str],
) -> DataFrame:
    """Null-safe join on ``on``, ``how`` in inner, left, left_semi, left_anti.

    ``spread`` names left columns that tell the rows of one key apart; the salt
    is a hash of them, so a retried task sends each row to the same place.
    Columns of ``right`` outside ``on`` must not clash with those of ``left``.
    """
    hot = F.broadcast(hot_key_hashes(left, on))  # fewer rows of one bigint than shuffle partitions
    salts = _tasks(left)

    salted_left = left.join(hot, F.xxhash64(*on) == F.col("hot_hash"), "left").withColumn(
        "_salt",
        F.when(F.col("hot_hash").isNotNull(), F.pmod(F.xxhash64(*spread), F.lit(salts)))
        .otherwise(F.lit(0))
        .cast("int"),
    )
    all_salts = F.sequence(F.lit(0), F.lit(salts - 1))
    salted_right = right.join(hot, F.xxhash64(*on) == F.col("hot_hash"), "left").select(
        *[F.col(c).alias(f"_r_{c}") for c in on],
        *[c for c in right.columns if c not in on],
        F.explode(
            F.when(F.col("hot_hash").isNotNull(), all_salts).otherwise(F.array(F.lit(0)))
        ).alias("_r_salt"),
    )
    return _join_salted(left, salted_left, salted_right, right, on, how)


def _join_salted(
    left: DataFrame,
    salted_left: DataFrame,
    salted_right: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str,
) -> DataFrame:
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type: {how}")
    condition = F.col("_salt") == F.col("_r_salt")
    for c in on:
        condition = condition & F.col(c).eqNullSafe(F.col(f"_r_{c}"))
    joined = salted_left.join(salted_right, condition, how)
    kept = list(left.columns)
    if how in ("inner", "left"):
        kept += [c for c in right.columns if c not in on]
    return joined.select(*kept)
