"""Run counters, site outcomes and alert rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bronzeflow.contracts import MAPPING_VERSION
from bronzeflow.operators.incremental import is_dated
from bronzeflow.operators.schema import java_pattern
from bronzeflow.operators.skew import skew_join

STAGES = ("discovered", "downloaded", "stored", "emitted", "failed")


def run_metrics(log: DataFrame, source: str, started: str, ended: str) -> DataFrame:
    """Counters per run from one row per dataset with a boolean per stage.

    Stages are cumulative: a dataset may count as stored and as failed.
    """
    ms = (
        F.unix_micros(F.max(F.col(ended).cast("timestamp")))
        - F.unix_micros(F.min(F.col(started).cast("timestamp")))
    ) / F.lit(1000.0)
    return (
        log.groupBy("correlation_id")
        .agg(
            *[F.count_if(F.col(stage)).alias(f"datasets_{stage}") for stage in STAGES],
            ms.alias("duration_ms"),
        )
        .select(F.lit(source).alias("source"), *[f"datasets_{s}" for s in STAGES],
                "duration_ms", "correlation_id")
    )


def site_outcomes(
    sites: DataFrame, listing_status: DataFrame, listed: DataFrame, changed: DataFrame
) -> DataFrame:
    """Per configured site: failed, empty, unchanged or enqueued, with its counts.

    ``listing_status`` has (site_id, listing_ok); ``listed`` and ``changed`` one
    row per file; changed files without a date are not enqueued. Joins run on one row per site.
    """
    counts = listed.groupBy("site_id").agg(F.count(F.lit(1)).alias("_listed"))
    todo = changed.groupBy("site_id").agg(
        F.count(F.lit(1)).alias("_changed"), F.count_if(is_dated()).alias("_dated")
    )
    ok = F.coalesce(F.col("listing_ok"), F.lit(False))

    def when_ok(column: str):
        return F.when(ok, F.coalesce(F.col(column), F.lit(0))).otherwise(0).cast("bigint")

    return (
        sites.select("site_id")
        .join(listing_status, "site_id", "left")
        .join(counts, "site_id", "left")
        .join(todo, "site_id", "left")
        .select(
            "site_id",
            F.when(~ok, "failed")
            .when(when_ok("_listed") == 0, "empty")
            .when(when_ok("_changed") == 0, "unchanged")
            .otherwise("enqueued")
            .alias("outcome"),
            when_ok("_listed").alias("discovered"),
            when_ok("_dated").alias("enqueued"),
        )
    )


def failed_sites(outcomes: DataFrame) -> DataFrame:
    """One row with the sorted ids of the sites whose listing failed."""
    failed = F.when(F.col("outcome") == "failed", F.col("site_id"))
    return outcomes.agg(F.sort_array(F.collect_set(failed)).alias("failed_sites"))


def invocation_stats(log: DataFrame, by: list[str]) -> DataFrame:
    """Retrieved, valid, invalid and emitted records per run.

    ``log`` has ``retrieved`` (0 or 1), ``valid`` (null where not judged) and ``emitted``.
    """
    return log.groupBy(*by).agg(
        F.sum("retrieved").alias("number_of_records_retrieved"),
        F.count_if(F.col("valid")).alias("number_valid"),
        F.count_if(~F.col("valid")).alias("number_invalid"),
        F.count_if(F.col("emitted")).alias("number_emitted"),
    )


def failure_rate_windows(
    records: DataFrame, ts: str, valid: str, width: str = "1 hour", threshold: float = 0.10
) -> DataFrame:
    """Share of invalid records per time window, with ``alert`` above the threshold.

    Takes a batch or a stream (with a watermark on ``ts``).
    """
    return (
        records.groupBy(F.window(F.col(ts), width))
        .agg(F.count(F.lit(1)).alias("records"), F.count_if(~F.col(valid)).alias("invalid"))
        .select(
            F.col("window.start").alias("window_start"),
            "records",
            "invalid",
            (F.col("invalid").cast("double") / F.col("records").cast("double")).alias("ratio"),
        )
        .withColumn("alert", F.col("ratio") > threshold)
    )


def slow_runs(metrics: DataFrame, limit_ms: float) -> DataFrame:
    """Runs above a duration limit; the limit is the operator's choice."""
    return metrics.filter(F.col("duration_ms") > limit_ms)


def sentinel_warnings(events: DataFrame, mapping_version: str, by: list[str]) -> DataFrame:
    """How often the mapping version is the sentinel ``unknown``, and how often illegal."""
    version = F.col(mapping_version)
    return events.groupBy(*by).agg(
        F.count_if(version == "unknown").alias("unknown_mapping_versions"),
        F.count_if(~version.rlike(java_pattern(MAPPING_VERSION))).alias("illegal"),
    )


def link_incidents(versions: DataFrame, incidents: DataFrame) -> DataFrame:
    """Add related_incident_id; scheduled ingestions (version 1) have none.

    Several incidents on one version: the first id by text order.
    """
    per_version = incidents.groupBy("dataset_id", "version").agg(
        F.min("incident_id").alias("_incident")
    )
    joined = skew_join(
        versions, per_version, on=["dataset_id", "version"], how="left",
        spread=[c for c in versions.columns if c not in ("dataset_id", "version")],
    )
    return joined.withColumn(
        "related_incident_id", F.when(F.col("version") > 1, F.col("_incident"))
    ).drop("_incident")
