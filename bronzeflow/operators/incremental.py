"""Which objects are new or changed, which version they get, which records were seen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bronzeflow.functions import keys
from bronzeflow.operators.skew import skew_join

NEW, RETRY_EMIT, DUPLICATE = "NEW", "RETRY_EMIT", "DUPLICATE"
RECORD_KEY = ["partition_date", "record_key"]


def detect_changes(listing: DataFrame, tracking_base: DataFrame) -> DataFrame:
    """Listed objects without a completed base row of the same size and date.

    Queued, processing and failed objects come back as well, which is what
    re-queues stuck work. Both sides reach the join straight from their scans,
    so AQE picks broadcast or splits skewed partitions by itself.
    """
    done = tracking_base.filter(F.col("status") == "completed").select(
        F.col("partition_key").alias("_pk"),
        F.col("row_key").alias("_rk"),
        F.col("size").alias("_size"),
        F.col("last_modified").alias("_modified"),
    )
    # keys as columns: a hash inside the join condition would be computed per comparison
    keyed = listing.selectExpr(
        "*", f"{keys.partition_key('site_id')} AS _site", f"{keys.row_key('key')} AS _key"
    )
    same = (
        (F.col("_site") == F.col("_pk"))
        & (F.col("_key") == F.col("_rk"))
        & F.col("size").eqNullSafe(F.col("_size"))
        & F.col("last_modified").eqNullSafe(F.col("_modified"))
    )
    return keyed.join(done, same, "left_anti").drop("_site", "_key")


def split_dated(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(files that carry a last_modified, files skipped because they do not)."""
    return files.filter(is_dated()), files.filter(~is_dated())


def is_dated() -> Column:
    return F.coalesce(F.col("last_modified"), F.lit("")) != ""


def unique_work_items(items: DataFrame) -> DataFrame:
    """One work item per object: of several in a batch, the one of its latest state.

    The bytes copied are the object's present ones whichever item asks for
    them, and two items would resolve the same version.
    """
    order = ["last_modified", "enqueued_at", "correlation_id"]
    rest = [c for c in items.columns if c not in ("s3_key", *order)]
    return (
        items.groupBy("s3_key")
        .agg(F.max(F.struct(*order, *rest)).alias("_last"))
        .select(*[c if c == "s3_key" else F.col(f"_last.{c}").alias(c) for c in items.columns])
    )


def latest_versions(versions: DataFrame) -> DataFrame:
    """Highest completed version per object; base rows have no version."""
    return (
        versions.filter((F.col("status") == "completed") & F.col("version").isNotNull())
        .groupBy("partition_key", "s3_key")
        .agg(F.max("version").cast("bigint").alias("max_version"))
    )


def resolve_versions(items: DataFrame, versions: DataFrame, unique: bool = False) -> DataFrame:
    """Add ``version``: one above the highest completed version of the same object.

    ``unique`` tells that an object occurs once in ``items``, as after
    ``unique_work_items`` or in a listing; then no key can be hot.
    """
    keyed = items.withColumn("partition_key", F.expr(keys.partition_key("site_id")))
    highest, on = latest_versions(versions), ["partition_key", "s3_key"]
    if unique:
        joined = keyed.join(highest, on, "left")
    else:
        joined = skew_join(keyed, highest, on, "left", spread=items.columns)
    return joined.select(
        *items.columns, (F.coalesce(F.col("max_version"), F.lit(0)) + 1).alias("version")
    )


def tracked_versions(versions: DataFrame, site_id: int, s3_key: str) -> DataFrame:
    """Version rows of one object; both predicates reach the scan."""
    return versions.filter((F.col("partition_key") == str(site_id)) & (F.col("s3_key") == s3_key))


def with_record_key(
    records: DataFrame, site: str = "SiteID", measured: str = "measdatetime"
) -> DataFrame:
    """Add the date partition and row key of a telemetry record."""
    text = F.col(measured).cast("string")
    return records.withColumn("partition_date", F.substring(text, 1, 10)).withColumn(
        "record_key", F.concat(F.col(site).cast("string"), F.lit("_"), text)
    )


def reserve_records(records: DataFrame, store: DataFrame, order_by: list[str]) -> DataFrame:
    """Add ``outcome`` to every keyed record: NEW, RETRY_EMIT or DUPLICATE.

    A key the store holds as completed is a duplicate, as pending a retry. Of
    several records with one key only the first by ``order_by`` (which has to
    be unique within the key) counts; the others are duplicates of it. First
    record and stored status come from one partial aggregate over both inputs.
    ``records`` is read three times: hand in a written table if it is costly.
    """
    per_key = _per_key(records, store, order_by, [])
    outcome = (
        F.when(F.col("_stored") == 2, DUPLICATE)
        .when(F.struct(*order_by) != F.col("_first.o"), DUPLICATE)
        .when(F.col("_stored") == 1, RETRY_EMIT)
        .otherwise(NEW)
    )
    joined = skew_join(records, per_key, RECORD_KEY, "left", spread=order_by)
    return joined.withColumn("outcome", outcome).drop("_first", "_stored")


def reserve_first(records: DataFrame, store: DataFrame, order_by: list[str]) -> DataFrame:
    """Only the records to emit, NEW or RETRY_EMIT: the first of each key not completed.

    One aggregate and no join, so the duplicates are dropped before the shuffle.
    """
    rest = [c for c in records.columns if c not in RECORD_KEY]
    first = _per_key(records, store, order_by, rest).filter(F.coalesce("_stored", F.lit(0)) < 2)
    return first.select(
        *[c if c in RECORD_KEY else F.col(f"_first.r.{c}").alias(c) for c in records.columns],
        F.when(F.col("_stored") == 1, RETRY_EMIT).otherwise(NEW).alias("outcome"),
    )


def _per_key(
    records: DataFrame, store: DataFrame, order_by: list[str], carry: list[str]
) -> DataFrame:
    """Per record key its first record (order ``o``, columns ``r``) and its rank in the store."""
    parts = [F.struct(*order_by).alias("o")] + ([F.struct(*carry).alias("r")] if carry else [])
    seen = records.select(
        *RECORD_KEY, F.struct(*parts).alias("_record"), F.lit(None).cast("int").alias("_rank")
    )
    rank = F.when(F.col("status") == "completed", 2).when(F.col("status") == "pending", 1)
    stored = store.select(
        *RECORD_KEY,
        F.lit(None).cast(seen.schema["_record"].dataType).alias("_record"),
        rank.alias("_rank"),
    )
    first = F.min_by("_record", "_record.o") if carry else F.min("_record")
    return (
        seen.unionByName(stored)
        .groupBy(*RECORD_KEY)
        .agg(first.alias("_first"), F.max("_rank").alias("_stored"))
        .filter(F.col("_first").isNotNull())
    )


def purge_expired(store: DataFrame, as_of: str, ttl_days: int) -> DataFrame:
    """Idempotency rows inside the window; whole date partitions are pruned."""
    if ttl_days < 1:
        raise ValueError("the idempotency window is at least 24 h")
    oldest = F.date_format(F.date_sub(F.lit(as_of).cast("date"), ttl_days), "yyyy-MM-dd")
    return store.filter(F.col("partition_date") >= oldest)


def unseen_windows(files: DataFrame, seen: DataFrame) -> DataFrame:
    """Files whose (site_id, date_window) is not stored; a missing store fails the run."""
    key = ["site_id", "date_window"]
    return skew_join(files, seen.select(*key).distinct(), key, "left_anti", spread=files.columns)


def within_lookback(records: DataFrame, ts: str, run_ts: str, hours: int = 24) -> DataFrame:
    """Records of the last ``hours`` before the run."""
    end: Column = F.lit(run_ts).cast("timestamp")
    return records.filter(F.col(ts).cast("timestamp") >= end - F.expr(f"INTERVAL {int(hours)} HOURS"))
