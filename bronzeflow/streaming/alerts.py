"""Alerts on the share of invalid records as a stream: each window once, when it is over."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def failure_rates(
    records: DataFrame, ts: str, valid: str, lateness: str, width: str = "1 hour", threshold: float = 0.10
) -> DataFrame:
    """window_start, records, invalid, ratio, alert of a stream, for output in append mode.

    A window is told once, as soon as a record ``lateness`` after its end was met,
    and its state is dropped then. Records up to ``lateness`` behind the newest
    count as any other. Later ones whose window was told already are not counted:
    the progress of the query numbers them (numRowsDroppedByWatermark), and
    ``corrections`` finds their windows. Rows without a verdict (null ``valid``)
    only move the time on: a source that falls silent sends one to have its last
    windows told. Rows without a time are not counted.
    """
    timed = records.withWatermark(ts, lateness)
    return _rates(timed, ts, valid, width, threshold)


def corrections(
    told: DataFrame, records: DataFrame, ts: str, valid: str, width: str = "1 hour", threshold: float = 0.10
) -> DataFrame:
    """Windows whose told rows are not those of all ``records``, a table, with the right ones.

    These hold records that came too late, or are not over yet (``told_records`` is null).
    """
    right = _rates(records, ts, valid, width, threshold)
    before = told.select(
        F.col("window_start").alias("_start"),
        F.col("records").alias("told_records"), F.col("invalid").alias("told_invalid"),
    )
    same = F.col("records").eqNullSafe(F.col("told_records")) & F.col("invalid").eqNullSafe(F.col("told_invalid"))
    return right.join(before, F.col("window_start") == F.col("_start"), "left").filter(~same).drop("_start")


def _rates(records: DataFrame, ts: str, valid: str, width: str, threshold: float) -> DataFrame:
    verdict: Column = F.col(valid)
    counted = records.groupBy(F.window(F.col(ts), width)).agg(
        F.count_if(verdict.isNotNull()).alias("records"), F.count_if(~verdict).alias("invalid")
    )
    ratio = F.col("invalid").cast("double") / F.col("records").cast("double")
    return counted.filter("records > 0").select(
        F.col("window.start").alias("window_start"), "records", "invalid",
        ratio.alias("ratio"), (ratio > threshold).alias("alert"),
    )
