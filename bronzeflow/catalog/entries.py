"""The registered queries: each runs an operator over whole driver tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from bronzeflow import contracts
from bronzeflow.catalog import adapters
from bronzeflow.catalog.adapters import CONTEXT, PREFIX
from bronzeflow.functions import keys
from bronzeflow.functions.sql import text
from bronzeflow.operators import (
    builders, failures, guard, incremental, messages, metrics, ownership, profile, tracking,
)
from bronzeflow.operators.schema import first_error
from bronzeflow.plans import dispatcher, records, worker
from bronzeflow.sinks import bronze, history, record_store, sidecars
from bronzeflow.sinks.messages import dead_letter_messages, event_messages, work_item_messages
from bronzeflow.sinks.tables import Tables
from bronzeflow.sources import files, folders, listing
from bronzeflow.streaming import alerts, queue, state
from bronzeflow.workspace import materialize, scratch_dir


def listing_scan(spark: SparkSession, sf: str) -> DataFrame:
    pages = adapters.listing_pages(spark, sf)
    return listing.split_sizes(listing.list_files(pages))[0]


def listing_status(spark: SparkSession, sf: str) -> DataFrame:
    return listing.site_status(adapters.listing_pages(spark, sf))


def site_fan_in(spark: SparkSession, sf: str) -> DataFrame:
    sites = listing.sites_from_text(spark, "9068, 9070,,9071 ,9068").filter("rejected IS NULL")
    found = listing.fan_in(adapters.listing(spark, sf), sites, PREFIX)
    return found.selectExpr(
        "site_id", "key", f"{keys.source_endpoint(PREFIX, 'site_id')} AS endpoint"
    )


def csv_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "csv")
    events = adapters.table(spark, sf, "events")
    events.select("event_id", "user_id", "event_type", "value", "props").write.option(
        "header", True
    ).option("escape", '"').csv(path)
    names = "event_id string, user_id string, event_type string, value string, props string"
    rows = files.read_csv(spark, path, names, escape='"')
    return rows.select(
        F.col("event_id").cast("bigint").alias("event_id"),
        F.col("user_id").cast("bigint").alias("user_id"),
        "event_type",
        F.col("value").cast("double").alias("value"),
        "props",
        F.col("_corrupt").isNotNull().alias("corrupt"),
    )


def csv_map_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "csvmap")
    events = adapters.table(spark, sf, "events")
    short = F.col("event_type").isin("click", "view")
    events.filter(short).select("event_id", "value").write.option("header", True).csv(f"{path}/a")
    events.filter(~short).select("user_id", "value", "event_id").write.option(
        "header", True
    ).csv(f"{path}/b")
    row = F.col("row")
    return files.read_csv_maps(spark, path).select(
        F.try_element_at(row, F.lit("event_id")).cast("bigint").alias("event_id"),
        F.try_element_at(row, F.lit("value")).cast("double").alias("value"),
        F.try_element_at(row, F.lit("user_id")).cast("bigint").alias("user_id"),
    )


def _named(spark: SparkSession, sf: str) -> DataFrame:
    files = adapters.listing(spark, sf).selectExpr(
        "site_id", "doc_id", "key", "last_modified", f"{keys.basename('key')} AS file_name"
    )
    return files.selectExpr("*", f"{keys.extract_category('file_name', 'site_id')} AS category")


def category_extract(spark: SparkSession, sf: str) -> DataFrame:
    given = "CASE site_id WHEN 9068 THEN '' WHEN 9069 THEN 'given' END"
    return _named(spark, sf).selectExpr(
        "key", "site_id", "file_name", "category",
        f"{keys.dataset_id('site_id', 'category')} AS dataset_id",
        f"{keys.category_or_default(given, 'file_name', 'site_id')} AS category_used",
    )


def bronze_paths(spark: SparkSession, sf: str) -> DataFrame:
    ctx = CONTEXT
    named = _named(spark, sf).selectExpr(
        "*", "doc_id % 3 + 1 AS version", f"{keys.dataset_id('site_id', 'category')} AS dataset_id"
    )
    date = text(ctx.run_date)
    path = keys.storage_path("dataset_id", date, "version")
    modified = "to_timestamp(last_modified)"
    return named.selectExpr(
        "key",
        f"{path} AS storage_path",
        f"{keys.metadata_path('dataset_id', date)} AS metadata_path",
        f"{keys.source_url(ctx.bucket_url + '/', 'key')} AS source_url",
        f"{keys.blob_url(ctx.account_url, ctx.container, path)} AS blob_url",
        f"{keys.partition_key('site_id')} AS partition_key",
        f"{keys.row_key('key')} AS row_key",
        f"{keys.versioned_row_key('key', 'version')} AS versioned_row_key",
        f"{keys.utc_date(modified)} AS modified_date",
        f"{keys.utc_iso(modified)} AS modified_iso",
    )


def event_ids(spark: SparkSession, sf: str) -> DataFrame:
    versions = adapters.tracking_versions(spark, sf)
    identified = versions.selectExpr(
        "s3_key", "version",
        f"{keys.event_id('s3_key', 'version')} AS event_id",
        f"{keys.ingestion_id('s3_key', 'version', CONTEXT.attempt)} AS ingestion_id",
    )
    return identified.selectExpr("*", f"{keys.traceparent('ingestion_id')} AS traceparent")


def incremental_detect(spark: SparkSession, sf: str) -> DataFrame:
    changed = incremental.detect_changes(
        adapters.csv_listing(spark, sf), adapters.tracking_base(spark, sf)
    )
    return changed.select(
        "site_id", "key", "size", "last_modified", incremental.is_dated().alias("enqueue")
    )


def work_item_build(spark: SparkSession, sf: str) -> DataFrame:
    dated, _ = incremental.split_dated(adapters.csv_listing(spark, sf))
    checked = builders.check_built_work_items(builders.work_items(dated, CONTEXT))
    sent = work_item_messages(checked.filter(F.size("errors") == 0))
    return sent.select(
        "key",
        "value",
        F.transform("headers", lambda h: h["value"].cast("string"))[1].alias("subject"),
    )


def version_resolve(spark: SparkSession, sf: str) -> DataFrame:
    items = adapters.csv_listing(spark, sf).select("site_id", F.col("key").alias("s3_key"))
    return incremental.resolve_versions(items, adapters.tracking_versions(spark, sf))


def tracked_site_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Stored versions per object of the tracking table, completed ones apart."""
    versions = adapters.tracking_versions(spark, sf)
    return versions.groupBy("partition_key", "s3_key").agg(
        F.count(F.lit(1)).alias("recorded"),
        F.count_if(F.col("status") == "completed").alias("completed"),
        F.max(F.when(F.col("status") == "completed", F.col("version"))).alias("max_version"),
    )


def _resolved(spark: SparkSession, sf: str) -> DataFrame:
    """Versioned work items of all dated CSV objects, with paths and ids."""
    dated, _ = incremental.split_dated(adapters.csv_listing(spark, sf))
    items = builders.work_items(dated, CONTEXT)
    versioned = incremental.resolve_versions(
        items, adapters.tracking_versions(spark, sf), unique=True
    )
    return builders.with_paths(versioned, CONTEXT)


def _stored_paths(resolved: DataFrame) -> DataFrame:
    """Paths that objects of site 9068 already hold; some without a recorded owner."""
    owner = F.when(F.col("file_name") == "src5.csv", "").otherwise(F.col("s3_key"))
    held = resolved.filter((F.col("site_id") == 9068) & (F.col("version") == 1))
    return held.groupBy("storage_path").agg(F.max(owner).alias("s3_key"))


def identity_guard(spark: SparkSession, sf: str) -> DataFrame:
    resolved = materialize(_resolved(spark, sf), "candidates")
    guarded = guard.guard_paths(resolved, _stored_paths(resolved))
    return guarded.select(
        "s3_key", "storage_path", "path_owner", "admitted",
        F.when(~F.col("admitted"), guard.collision_reason()).alias("failure_reason"),
    )


def file_profile(spark: SparkSession, sf: str) -> DataFrame:
    return profile.profile_content(adapters.contents(spark, sf)).drop("content")


def _text_files(spark: SparkSession, sf: str, name: str) -> str:
    path = scratch_dir(spark, name)
    documents = adapters.table(spark, sf, "documents")
    documents.select("text", "lang", "source").write.partitionBy("lang", "source").text(path)
    return path


def _by_folder(df: DataFrame, path: str, *totals: Column) -> DataFrame:
    return df.groupBy(
        F.regexp_extract(path, "lang=([^/]*)", 1).alias("lang"),
        F.regexp_extract(path, "source=([^/]*)", 1).alias("source"),
    ).agg(*totals)


def object_copy(spark: SparkSession, sf: str) -> DataFrame:
    """Copy files of all texts to versioned paths, then read the copies back."""
    found = files.list_sizes(spark, _text_files(spark, sf, "objects"))
    target = scratch_dir(spark, "bronze")
    items = found.withColumn("storage_path", F.regexp_extract("path", "(lang=.*)$", 1))
    copied = bronze.copy_objects(items, "path", target)
    log = f"{target}-log"
    copied.write.parquet(log)
    done = spark.read.parquet(log).select("storage_path", "file_size", "file_hash", "row_count")
    copies = files.read_bytes(spark, target).select(
        F.regexp_extract("path", "(lang=.*)$", 1).alias("storage_path"),
        F.sha2("content", 256).alias("copy_hash"),
        F.col("length").alias("copy_size"),
    )
    same = (F.col("copy_hash") == F.col("file_hash")) & (F.col("copy_size") == F.col("file_size"))
    return _by_folder(
        done.join(copies, "storage_path", "left"),
        "storage_path",
        F.sum("file_size").alias("file_size"),
        F.sum("row_count").alias("row_count"),
        F.bool_and(F.coalesce(same, F.lit(False))).alias("byte_exact"),
    )


def line_counts(spark: SparkSession, sf: str) -> DataFrame:
    counted = files.split_line_counts(spark, _text_files(spark, sf, "lines"))
    return _by_folder(
        counted, "path", F.sum("file_size").alias("file_size"), F.sum("row_count").alias("row_count")
    )


def work_item_validate(spark: SparkSession, sf: str) -> DataFrame:
    checked = messages.check_work_items(adapters.work_item_bodies(spark, sf))
    stage, errors = F.col("stage"), F.col("errors")
    return checked.select(
        "doc_id",
        stage.isNull().alias("accepted"),
        F.when(stage.isNotNull(), failures.dead_letter_reason(stage)).alias("error_type"),
        "correlation_id",
        F.when(
            stage.isNotNull(),
            failures.file_reference(
                stage, F.expr(keys.body_preview("body")), F.col("raw_body"), F.lit(None)
            ),
        ).alias("file_reference"),
        F.array_join(
            F.transform(errors, lambda e: F.concat(e["path"], F.lit(":"), e["validator"])), ","
        ).alias("violations"),
        F.when(stage.isNull(), F.col("site_id")).alias("site_id"),
        F.when(
            stage.isNull(), F.expr(keys.category_or_default("category", "file_name", "site_id"))
        ).alias("category"),
    )


def work_item_dead_letters(spark: SparkSession, sf: str) -> DataFrame:
    checked = messages.check_work_items(adapters.work_item_bodies(spark, sf))
    sent = dead_letter_messages(messages.rejected_work_items(checked))
    return sent.select(
        F.get_json_object("value", "$.correlation_id").alias("correlation_id"),
        F.get_json_object("value", "$.error_type").alias("error_type"),
        F.get_json_object("value", "$.file_reference").alias("file_reference"),
        F.transform("headers", lambda h: h["value"].cast("string"))[1].alias("subject"),
    )


def _profiled(spark: SparkSession, sf: str) -> DataFrame:
    stored = bronze.attach_profile(_resolved(spark, sf), adapters.contents(spark, sf))
    return stored.filter(F.col("error_class").isNull())


def _flat(struct: str, blocks: dict[str, list[str]]) -> list[Column]:
    return [
        F.col(f"{struct}.{block}.{name}").alias(f"{block}_{name}")
        for block, names in blocks.items()
        for name in names
    ]


def metadata_sidecar(spark: SparkSession, sf: str) -> DataFrame:
    built = builders.with_checked(
        _profiled(spark, sf), "metadata", builders.metadata(CONTEXT),
        contracts.metadata_file(CONTEXT),
    )
    blocks = {
        "dataset": ["dataset_id", "dataset_type", "version", "schema_version"],
        "source": ["source", "source_type", "endpoint", "provider", "region"],
        "ingestion": ["ingestion_time", "ingestion_id", "batch_id", "pipeline", "trigger_type",
                      "retry_count", "source_file_name", "file_size_bytes", "checksum",
                      "ingestion_latency_seconds", "status"],
        "event_time": ["event_time_start", "expected_frequency_seconds", "expected_records"],
        "data_profile": ["row_count", "null_percentage", "schema_detected"],
        "quality_hint": ["basic_quality_score", "schema_valid"],
        "lineage": ["parent_dataset_version", "rerun_of", "related_incident_id"],
    }
    return built.select(
        "s3_key", "metadata_path",
        F.size("metadata_errors").alias("violations"),
        F.array_join("metadata.dataset.tags", ",").alias("tags"),
        F.size("metadata.quality_hint.notes").alias("notes"),
        *_flat("metadata", blocks),
    )


def _sidecars(spark: SparkSession, sf: str) -> DataFrame:
    built = builders.with_checked(
        _profiled(spark, sf), "metadata", builders.metadata(CONTEXT),
        contracts.metadata_file(CONTEXT),
    )
    return built.filter(F.size("metadata_errors") == 0).select(
        "metadata_path", "version", builders.as_json("metadata").alias("metadata_json")
    )


def sidecar_files(spark: SparkSession, sf: str) -> DataFrame:
    """Files under the metadata paths: the oldest sidecar of each was written, then all, then the oldest again."""
    root = scratch_dir(spark, "sidecars")
    built = materialize(_sidecars(spark, sf), "sidecar_rows")
    first = F.min(F.struct("version", "metadata_json")).alias("first")
    oldest = built.groupBy("metadata_path").agg(first).select("metadata_path", "first.*")
    for rows in (oldest, built, oldest):
        sidecars.write_sidecars(rows, root)
    at = lambda path: F.get_json_object("metadata_json", path)
    return sidecars.read_sidecars(spark, root).select(
        "metadata_path", at("$.dataset.version").cast("bigint").alias("version"),
        at("$.dataset.dataset_id").alias("dataset_id"), at("$.lineage.rerun_of").alias("rerun_of"),
        at("$.event_time.expected_frequency_seconds").cast("bigint").alias("frequency"),
    )


def sidecar_latest(spark: SparkSession, sf: str) -> DataFrame:
    """Sidecars that stay visible when each path is overwritten by the highest version."""
    return bronze.latest_sidecars(_sidecars(spark, sf)).select(
        "metadata_path", "version",
        F.get_json_object("metadata_json", "$.dataset.dataset_id").alias("dataset_id"),
        F.get_json_object("metadata_json", "$.lineage.rerun_of").alias("rerun_of"),
        F.get_json_object("metadata_json", "$.event_time.expected_frequency_seconds")
        .cast("bigint").alias("frequency"),
    )


def event_envelope(spark: SparkSession, sf: str) -> DataFrame:
    built = builders.with_checked(
        _profiled(spark, sf), "envelope", builders.envelope(CONTEXT),
        contracts.dataset_available(CONTEXT),
    )
    names = ["specversion", "type", "source", "id", "time", "datacontenttype", "dataschema",
             "tenant_id", "source_vendor", "schema_version", "mapping_version", "correlation_id",
             "ingestion_timestamp", "traceparent"]
    data = ["site_id", "category", "file_format", "storage_path", "version", "ingestion_id",
            "source_url", "file_size", "file_hash"]
    return built.select(
        "s3_key",
        F.size("envelope_errors").alias("violations"),
        *[F.col(f"envelope.{n}").alias(n) for n in names],
        *[F.col(f"envelope.data.{n}").alias(f"data_{n}") for n in data],
    )


def event_publish(spark: SparkSession, sf: str) -> DataFrame:
    built = builders.with_checked(
        _profiled(spark, sf), "envelope", builders.envelope(CONTEXT),
        contracts.dataset_available(CONTEXT),
    )
    sent = event_messages(built.filter(F.size("envelope_errors") == 0), CONTEXT)
    header = F.transform("headers", lambda h: h["value"].cast("string"))
    return sent.select(
        "key",
        F.get_json_object("value", "$.data.version").cast("bigint").alias("version"),
        F.get_json_object("value", "$.data.file_hash").alias("file_hash"),
        header[0].alias("content_type"),
        header[1].alias("subject"),
        header[2].alias("source_vendor"),
        header[3].alias("schema_version"),
    )


def event_type_split(spark: SparkSession, sf: str) -> DataFrame:
    kind = (
        F.when(F.col("event_type") == "click", contracts.EVENT_TYPE)
        .when(F.col("event_type") == "view", contracts.RETIRED_EVENT_TYPES[2])
        .when(F.col("event_type") == "signup", contracts.RETIRED_EVENT_TYPES[0])
        .when(F.col("event_type") == "error", contracts.EVENT_TYPE + "\n")
    )
    typed = adapters.table(spark, sf, "events").select("event_id", kind.alias("type"))
    known, other = messages.split_by_event_type(typed)
    return known.select("event_id", F.lit("consume").alias("route")).unionByName(
        other.select("event_id", F.lit("dead_letter").alias("route"))
    )


def tracking_fold(spark: SparkSession, sf: str) -> DataFrame:
    return tracking.fold_base(adapters.lifecycle_events(spark, sf))


def tracking_fold_versions(spark: SparkSession, sf: str) -> DataFrame:
    return tracking.fold_versions(adapters.lifecycle_events(spark, sf))


def tracking_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Base rows of the first half of January, then the rest of the events applied to them."""
    events = adapters.lifecycle_events(spark, sf).to(
        StructType.fromDDL(tracking.EVENT_SCHEMA)
    )
    cut = F.lit("2024-01-15T00:00:00Z").cast("timestamp")
    base = tracking.fold_base(events.filter(F.col("ts") < cut))
    return tracking.apply_events(base, events.filter(F.col("ts") >= cut), "2024-01-01T00:00:00Z")


def _failed(spark: SparkSession, sf: str) -> DataFrame:
    raw = adapters.from_events(spark, sf, adapters.FAILURES)
    link = F.struct(
        F.col("error_class"), F.lit(None).cast("string").alias("error_family"),
        F.col("http_status"),
    )
    outer = F.struct(
        F.lit("UploadError").alias("error_class"), F.lit(None).cast("string").alias("error_family"),
        F.lit(None).cast("int").alias("http_status"),
    )
    chain = F.when(F.col("wrapped"), F.array(outer, link)).otherwise(F.array(link))
    return raw.withColumn("transient", failures.is_transient(chain)).withColumn(
        "chain_length", F.size(chain)
    )


def failure_classify(spark: SparkSession, sf: str) -> DataFrame:
    return _failed(spark, sf).select(
        "event_id", "error_class", "http_status", "chain_length", "transient"
    )


def failure_route(spark: SparkSession, sf: str) -> DataFrame:
    routed = failures.route_failures(_failed(spark, sf))
    return routed.select(
        "event_id", "stage", "transient", "error_type", "dead_letter", "redeliver", "mark_failed"
    )


def dead_letter_report(spark: SparkSession, sf: str) -> DataFrame:
    routed = failures.route_failures(_failed(spark, sf)).filter("dead_letter")
    letters = failures.dead_letters(
        routed,
        F.when(F.col("identified"), F.col("s3_key")),
        F.col("error_type"),
        failures.file_reference(
            F.col("stage"), F.lit("preview"), F.lit("body"),
            F.when(F.col("identified"), F.col("s3_key")),
        ),
        F.col("error_class"),
    )
    return failures.unique_dead_letters(letters)


def _run_log(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_type")
    return adapters.table(spark, sf, "events").select(
        F.concat(F.lit("run-"), F.date_format("ts", "yyyy-MM-dd")).alias("correlation_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.lit(True).alias("discovered"),
        (kind != "signup").alias("downloaded"),
        (~kind.isin("signup", "view")).alias("stored"),
        kind.isin("click", "purchase").alias("emitted"),
        kind.isin("error", "signup").alias("failed"),
    )


def run_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.run_metrics(_run_log(spark, sf), "PVDAQ-historical-worker", "ts", "ts")


def slow_runs(spark: SparkSession, sf: str) -> DataFrame:
    counted = metrics.run_metrics(_run_log(spark, sf), "PVDAQ-historical-worker", "ts", "ts")
    return metrics.slow_runs(counted, 86_200_000.0).select("correlation_id", "duration_ms")


def _dispatch(spark: SparkSession, sf: str) -> dispatcher.Dispatch:
    sites = listing.sites_from_text(spark, "9068,9069,9070,9071,9999,1234").select("site_id")
    status = sites.select("site_id", (F.col("site_id") != 9999).alias("listing_ok"))
    return dispatcher.dispatch(
        sites, status,
        adapters.csv_listing(spark, sf).drop("text"),
        adapters.tracking_base(spark, sf), CONTEXT,
    )


def site_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    return _dispatch(spark, sf).site_outcomes


def failed_sites(spark: SparkSession, sf: str) -> DataFrame:
    failed = metrics.failed_sites(_dispatch(spark, sf).site_outcomes)
    return failed.select(F.array_join(F.col("failed_sites").cast("array<string>"), ",").alias("sites"))


def dispatch_run(spark: SparkSession, sf: str) -> DataFrame:
    run = _dispatch(spark, sf)
    sent = run.work_items.select(
        "s3_key", F.lit("enqueued").alias("fate"), "category", "last_modified"
    )
    skipped = run.skipped.select(
        F.col("key").alias("s3_key"), F.lit("skipped").alias("fate"),
        F.lit(None).cast("string").alias("category"), "last_modified",
    )
    return sent.unionByName(skipped)


def dispatch_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return _dispatch(spark, sf).run_metrics


def dataset_profile(spark: SparkSession, sf: str) -> DataFrame:
    rows = adapters.telemetry(spark, sf)
    cells = ["SiteID", "measdatetime", "category", "ac_power"]
    profiled = profile.profile_dataset(
        rows.withColumn("fine", ~F.col("bad")), "category", "measdatetime", cells,
        corrupt="bad", schema_valid="fine", small_rows=100,
    )
    return profiled.withColumn("notes", F.array_join("notes", ";"))


def lineitem_profile(spark: SparkSession, sf: str) -> DataFrame:
    rows = adapters.table(spark, sf, "lineitem")
    profiled = profile.profile_dataset(
        rows, "l_returnflag", "l_shipdate", rows.columns, frequency_seconds=86400
    )
    return profiled.select(
        "dataset", "row_count", "event_time_start", "event_time_end", "expected_records",
        "null_percentage", "duplicate_rows", "time_continuity_suspected_gap",
    )


def _records(spark: SparkSession, sf: str) -> DataFrame:
    return adapters.from_events(spark, sf, adapters.RECORDS)


def record_validate(spark: SparkSession, sf: str) -> DataFrame:
    checked = messages.check_records(_records(spark, sf))
    return checked.select(
        "event_id",
        (F.size("errors") == 0).alias("valid"),
        F.array_join(
            F.transform("errors", lambda e: F.concat(e["path"], F.lit(":"), e["validator"])), ","
        ).alias("violations"),
    )


def record_dead_letters(spark: SparkSession, sf: str) -> DataFrame:
    checked = messages.check_records(_records(spark, sf))
    letters = messages.record_dead_letters(
        checked, CONTEXT.correlation_id, CONTEXT.run_ts, CONTEXT.schema_version
    )
    return letters.select(
        "original_payload", "error_type", F.size("error_details").alias("errors"),
        first_error(F.col("error_details")).isNotNull().alias("explained"),
        "correlation_id", "site_id", "timestamp", "source_vendor", "schema_version",
    )


def _reserved_store(spark: SparkSession, sf: str) -> DataFrame:
    """Keys the first sites reserved earlier: pending or completed by the hour."""
    valid = _records(spark, sf).select(
        F.get_json_object("payload", "$.SiteID").cast("string").alias("site"),
        F.get_json_object("payload", "$.measdatetime").alias("at"),
    )
    hour = F.substring("at", 12, 2)
    return (
        valid.filter(F.length("at") == 19)
        .select(
            F.substring("at", 1, 10).alias("partition_date"),
            F.concat("site", F.lit("_"), "at").alias("record_key"),
            F.when(hour.isin("00", "01"), "completed").when(hour == "02", "pending").alias("status"),
        )
        .filter(F.col("status").isNotNull())
        .distinct()
    )


def record_reserve(spark: SparkSession, sf: str) -> DataFrame:
    run = records.process_records(
        _records(spark, sf), _reserved_store(spark, sf), ["event_id"], CONTEXT
    )
    return run.emitted.select("event_id", "partition_date", "record_key", "outcome")


def record_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    """Every telemetry record against an idempotency table made of the same events."""
    rows = incremental.with_record_key(
        adapters.telemetry(spark, sf).withColumn(
            "measdatetime", F.date_format("measdatetime", "yyyy-MM-dd'T'HH")
        )
    )
    numbered = rows.groupBy("event_id", "partition_date", "record_key").agg(
        F.count(F.lit(1)).alias("copies")
    )
    store = rows.filter(F.col("category").isin("click", "view")).select(
        "partition_date", "record_key",
        F.when(F.col("category") == "click", "completed").otherwise("pending").alias("status"),
    )
    return incremental.reserve_records(numbered, store, ["event_id"]).select(
        "event_id", "partition_date", "record_key", "outcome"
    )


def idempotency_purge(spark: SparkSession, sf: str) -> DataFrame:
    rows = incremental.with_record_key(adapters.telemetry(spark, sf)).select(
        "partition_date", "record_key"
    )
    kept = incremental.purge_expired(rows, "2024-01-20", 7)
    return kept.groupBy("partition_date").agg(F.count(F.lit(1)).alias("rows"))


def window_key_filter(spark: SparkSession, sf: str) -> DataFrame:
    window = F.substring("last_modified", 1, 10)
    named = _named(spark, sf).withColumn("date_window", F.coalesce(window, F.lit("none")))
    seen = adapters.listing(spark, sf).filter(F.col("lang") == "de").select(
        "site_id", F.coalesce(window, F.lit("none")).alias("date_window")
    )
    return incremental.unseen_windows(named, seen).select("key", "site_id", "date_window")


def lookback_filter(spark: SparkSession, sf: str) -> DataFrame:
    rows = adapters.telemetry(spark, sf)
    recent = incremental.within_lookback(rows, "measdatetime", "2024-01-30T00:00:00+00:00", 48)
    return recent.groupBy("category").agg(F.count(F.lit(1)).alias("rows"))


def invocation_stats(spark: SparkSession, sf: str) -> DataFrame:
    return records.process_records(
        _records(spark, sf), _reserved_store(spark, sf), ["event_id"], CONTEXT
    ).stats


def validation_alerts(spark: SparkSession, sf: str) -> DataFrame:
    rows = adapters.telemetry(spark, sf).select(
        F.col("measdatetime").cast("timestamp").alias("ts"),
        (F.col("ac_power").isNotNull() & ~F.col("bad")).alias("valid"),
    )
    rates = metrics.failure_rate_windows(rows, "ts", "valid", "6 hours")
    return rates.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm"))


def validation_alerts_stream(spark: SparkSession, sf: str) -> DataFrame:
    """``validation_alerts`` as a stream that is stopped and goes on twice, with some records a day's part late."""
    source, out = scratch_dir(spark, "telemetry"), scratch_dir(spark, "alerts")
    rows = adapters.telemetry(spark, sf).select(
        F.col("measdatetime").cast("timestamp").alias("ts"),
        (F.col("ac_power").isNotNull() & ~F.col("bad")).alias("valid"), "event_id",
    )
    # every fifth record comes as if it were 20 hours younger
    came = F.col("ts") + F.when(F.col("event_id") % 5 == 0, F.expr("INTERVAL 20 HOURS")).otherwise(F.expr("INTERVAL 0 HOURS"))
    rows = materialize(rows.withColumn("part", F.least(F.floor(F.dayofmonth(came) / 11), F.lit(2)) + 3 * (F.month(came) - 1)), "telemetry_rows")
    beat = rows.agg((F.max("ts") + F.expr("INTERVAL 3 DAYS")).alias("ts"), F.lit(None).cast("boolean").alias("valid"))
    parts = [r.part for r in rows.select("part").distinct().orderBy("part").collect()]  # three a month
    for batch in [*(rows.filter(F.col("part") == part).select("ts", "valid") for part in parts), beat]:
        batch.write.mode("append").parquet(source)
        stream = spark.readStream.schema("ts timestamp, valid boolean").parquet(source)
        rates = alerts.failure_rates(stream, "ts", "valid", "1 day", "6 hours")
        queue.drain(rates, out, f"{out}-checkpoint")
    told = spark.read.parquet(out)
    return told.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm"))


def mapping_sentinel(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_type")
    rows = adapters.table(spark, sf, "events").select(
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
        F.when(kind == "view", "unknown").when(kind == "click", "v1").when(kind == "error", "v")
        .otherwise("v12").alias("mapping_version"),
    )
    return metrics.sentinel_warnings(rows, "mapping_version", ["day"])


def api_flatten(spark: SparkSession, sf: str) -> DataFrame:
    events = adapters.table(spark, sf, "events")
    row = F.array(F.col("event_id").cast("string"), "event_type", F.get_json_object("props", "$.k"))
    documents = (
        events.select(F.floor(F.col("event_id") / 100).alias("doc"), row.alias("row"))
        .groupBy("doc")
        .agg(F.collect_list("row").alias("data"))
        .select(
            "doc",
            F.to_json(
                F.struct(
                    F.array(F.lit("id"), F.lit("kind"), F.lit("k")).alias("headers"), "data"
                )
            ).alias("body"),
        )
    )
    record = F.col("record")
    return files.flatten_api(documents, "body", ["doc"]).select(
        "doc",
        F.try_element_at(record, F.lit("id")).cast("bigint").alias("event_id"),
        F.try_element_at(record, F.lit("kind")).alias("event_type"),
        F.try_element_at(record, F.lit("k")).cast("bigint").alias("k"),
    )


def incident_link(spark: SparkSession, sf: str) -> DataFrame:
    items = _resolved(spark, sf).select("s3_key", "dataset_id", "version")
    incidents = adapters.listing(spark, sf).select(
        F.expr(
            keys.dataset_id("site_id", keys.extract_category("file_name", "site_id"))
        ).alias("dataset_id"),
        F.lit(2).cast("bigint").alias("version"),
        F.concat(F.lit("INC-"), "doc_id").alias("incident_id"),
    )
    return metrics.link_incidents(items, incidents)


def tracking_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Base rows held as stream state, of events that come in six files, three batches and any order."""
    source, out = scratch_dir(spark, "lifecycle"), scratch_dir(spark, "updates")
    events = adapters.lifecycle_events(spark, sf).to(StructType.fromDDL(tracking.EVENT_SCHEMA))
    events.repartition(6, "seq").write.parquet(source)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 2).parquet(source)
    # the files are in no order of time, so all of them are in time
    with state.rocksdb(spark):
        queue.drain(state.track(stream, state.Timing("4000 days")), out, f"{out}-checkpoint")
    return state.updated_rows(spark.read.parquet(out)).drop("stuck")


def history_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Version rows out of a log that was folded twice while its eleven batches came in."""
    log = history.History(scratch_dir(spark, "log"), every=4)
    events = adapters.lifecycle_events(spark, sf).to(StructType.fromDDL(tracking.EVENT_SCHEMA))
    day = F.dayofmonth("ts")
    events = materialize(events.withColumn("batch", F.least(F.floor(day / 3), F.lit(10)).cast("int")), "events")
    for batch in range(11):
        history.fold(spark, log, batch)
        history.append(events.filter(F.col("batch") == batch), log, batch)
    return tracking.fold_versions(history.read(spark, log))


def identity_guard_index(spark: SparkSession, sf: str) -> DataFrame:
    """``identity_guard`` with the stored paths behind the ownership index."""
    resolved = materialize(_resolved(spark, sf), "candidates")
    index = ownership.Index(scratch_dir(spark, "owners"))
    ownership.write_owners(_stored_paths(resolved), index, CONTEXT.run_date, 0)
    owners = ownership.owners_of(resolved, spark, index, CONTEXT.run_date, 1)
    guarded = guard.guard_paths(resolved, owners)
    return guarded.select(
        "s3_key", "storage_path", "path_owner", "admitted",
        F.when(~F.col("admitted"), guard.collision_reason()).alias("failure_reason"),
    )


def record_store_days(spark: SparkSession, sf: str) -> DataFrame:
    """Keys by day and state after two batches, a folded day and a purge."""
    store = record_store.RecordStore(scratch_dir(spark, "records"))
    rows = incremental.with_record_key(adapters.telemetry(spark, sf)).select(
        "partition_date", "record_key", F.lit("c").alias("correlation_id"), F.lit("t").alias("created_at"), "category"
    )
    rows = materialize(rows.distinct(), "rows")
    record_store.add(rows, store, record_store.PENDING, 0)
    record_store.add(rows.filter("category = 'click'"), store, record_store.COMPLETED, 1)
    record_store.compact(spark, store, "2024-01-15", 1)
    record_store.purge(spark, store, "2024-01-20")
    per_key = record_store.read_days(spark, store).groupBy("partition_date", "record_key").agg(F.min("status").alias("status"))
    return per_key.groupBy("partition_date", "status").agg(F.count(F.lit(1)).alias("keys"))


def folder_listing(spark: SparkSession, sf: str) -> DataFrame:
    """Every document as an object, each tenth one empty, listed by tasks."""
    root = scratch_dir(spark, "folder")
    docs = adapters.table(spark, sf, "documents").select("doc_id", "lang", F.when(F.col("doc_id") % 10 != 0, F.col("text")).alias("text"))
    written = docs.select(F.concat_ws("/", F.lit(root), F.coalesce("lang", F.lit("none")), F.concat("doc_id", F.lit(".csv"))).alias("path"), "text")
    folders.write_objects(written, "path", "text").write.format("noop").mode("overwrite").save()
    found = listing.list_folder(spark, root)
    return found.select(
        F.regexp_extract("key", r"([0-9]+)\.csv$", 1).cast("bigint").alias("doc_id"), "size",
        F.col("last_modified").isNotNull().alias("dated"),
    )


def event_dedupe_stream(spark: SparkSession, sf: str) -> DataFrame:
    source, out = scratch_dir(spark, "queue"), scratch_dir(spark, "deduped")
    telemetry = adapters.telemetry(spark, sf).select(
        "event_id", F.col("measdatetime").cast("timestamp").alias("ts"), "category"
    )
    telemetry.write.parquet(source)
    stream = spark.readStream.schema(telemetry.schema).parquet(source)
    queue.drain(queue.dedupe_events(stream, "ts", "event_id", "60 days"), out, f"{out}-checkpoint")
    return spark.read.parquet(out).select("event_id", "category")


def ingest_run(spark: SparkSession, sf: str) -> DataFrame:
    """Discovery, queue, worker batches and tracking over all objects; final base rows."""
    tables = Tables(scratch_dir(spark, "run"))
    dispatcher.emit(_dispatch(spark, sf), tables, 0)
    contents = adapters.contents(spark, sf)

    def store(items: DataFrame) -> DataFrame:
        return bronze.attach_content(items, contents)

    stream = queue.read_queue(spark, "parquet", {"path": tables.queue}, "value string")
    queue.run_worker(
        stream, tables, store, CONTEXT, f"{tables.root}/checkpoint", packed=True
    ).awaitTermination()
    letters = worker.dead_letter_table(spark, tables).groupBy(
        F.col("file_reference").alias("s3_key")
    ).agg(F.max("error_type").alias("error_type"))
    return (
        worker.tracking_table(spark, tables)
        .join(letters, "s3_key", "left")
        .select("s3_key", "category", "last_modified", "status", "completed_at", "error_type")
    )


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Changed objects with their version, path, profile and event id."""
    changed = incremental.detect_changes(
        adapters.csv_listing(spark, sf), adapters.tracking_base(spark, sf)
    )
    dated, _ = incremental.split_dated(changed)
    items = builders.work_items(dated, CONTEXT)
    versioned = incremental.resolve_versions(
        items, adapters.tracking_versions(spark, sf), unique=True
    )
    located = builders.with_paths(versioned, CONTEXT)
    stored = bronze.attach_profile(located, adapters.contents(spark, sf))
    return stored.select(
        "s3_key", "version", "storage_path", "file_size", "file_hash", "row_count", "event_id"
    )


QUERIES = {
    f.__name__: f
    for f in (
        flagship, listing_scan, listing_status, site_fan_in, csv_scan, csv_map_scan,
        category_extract, bronze_paths, event_ids, incremental_detect, work_item_build,
        version_resolve, tracked_site_versions, identity_guard, file_profile, object_copy,
        line_counts, work_item_validate, work_item_dead_letters, metadata_sidecar, sidecar_latest,
        event_envelope, event_publish, event_type_split, tracking_fold, tracking_fold_versions,
        tracking_upsert, failure_classify, failure_route, dead_letter_report, run_metrics,
        slow_runs, site_outcomes, failed_sites, dispatch_run, dispatch_metrics, dataset_profile,
        lineitem_profile, record_validate, record_dead_letters, record_reserve, record_outcomes,
        idempotency_purge, window_key_filter, lookback_filter, invocation_stats, validation_alerts,
        mapping_sentinel, api_flatten, incident_link, event_dedupe_stream, ingest_run,
        tracking_stream, history_versions, identity_guard_index, record_store_days, folder_listing,
        sidecar_files, validation_alerts_stream,
    )
}
