"""Work items, sidecars and event envelopes, built as structs and checked before use."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bronzeflow import contracts
from bronzeflow.context import RunContext
from bronzeflow.functions import keys
from bronzeflow.functions.sql import text
from bronzeflow.operators.schema import check_struct

_JSON = {"ignoreNullFields": "false"}
_WORK_ITEM_FIELDS = [
    "site_id", "s3_key", "file_name", "category", "correlation_id", "enqueued_at", "last_modified",
]


def work_items(files: DataFrame, ctx: RunContext) -> DataFrame:
    """Work items of listed files: file name, category and run fields added."""
    return files.withColumn("file_name", F.expr(keys.basename("key"))).selectExpr(
        "site_id",
        "key AS s3_key",
        "file_name",
        f"{keys.extract_category('file_name', 'site_id')} AS category",
        f"{text(ctx.correlation_id)} AS correlation_id",
        f"{text(ctx.run_ts)} AS enqueued_at",
        "last_modified",
        "size",
    )


def check_built_work_items(items: DataFrame) -> DataFrame:
    """Add the errors of built work items, so that a bad one is never sent."""
    built = items.withColumn("_item", F.struct(*_WORK_ITEM_FIELDS))
    return check_struct(built, "_item", contracts.work_item(), "errors").drop("_item")


def work_item_json() -> Column:
    return F.to_json(F.struct(*_WORK_ITEM_FIELDS), _JSON)


def with_paths(items: DataFrame, ctx: RunContext) -> DataFrame:
    """Add dataset_id, storage_path, metadata_path, source_url and ids to versioned items."""
    date = text(ctx.run_date)
    named = items.selectExpr("*", f"{keys.dataset_id('site_id', 'category')} AS dataset_id")
    return named.selectExpr(
        "*",
        f"{keys.storage_path('dataset_id', date, 'version')} AS storage_path",
        f"{keys.metadata_path('dataset_id', date)} AS metadata_path",
        f"{keys.source_url(ctx.bucket_url, 's3_key')} AS source_url",
        f"{keys.event_id('s3_key', 'version')} AS event_id",
        f"{keys.ingestion_id('s3_key', 'version', ctx.attempt)} AS ingestion_id",
    )


def trigger_type(version: str) -> str:
    return f"if({version} > 1, 'rerun', 'scheduled')"


def parent_version(version: str) -> str:
    return f"if({version} > 1, {version} - 1, NULL)"


def rerun_of(dataset: str, version: str) -> str:
    return f"if({version} > 1, concat({dataset}, '_v', {version} - 1), NULL)"


def latency(seconds: float) -> str:
    """Seconds to one decimal, ties to even."""
    return f"bround({float(seconds)!r}D, 1)"


def _struct(**fields: str) -> str:
    pairs = ", ".join(f"'{name}', {value}" for name, value in fields.items())
    return f"named_struct({pairs})"


def metadata(
    ctx: RunContext, profile: dict[str, str] | None = None, incident: str = "NULL"
) -> Column:
    """Sidecar struct over the columns of profiled items.

    What needs parsed rows is null unless ``profile`` maps the field name to a
    SQL expression, as ``profile_dataset`` names its columns.
    """
    given = profile or {}

    def known(**kinds: str) -> dict[str, str]:
        return {n: f"CAST({given.get(n, 'NULL')} AS {kind})" for n, kind in kinds.items()}

    notes = f"coalesce(CAST({given.get('notes', 'NULL')} AS array<string>), CAST(array() AS array<string>))"
    tags = f"array({', '.join(map(text, contracts.TAGS))})"
    return F.expr(
        _struct(
            dataset=_struct(
                dataset_id="dataset_id",
                dataset_type=text(contracts.DATASET_TYPE),
                version="version",
                schema_version=text(contracts.BRONZE_SCHEMA_VERSION),
                tags=tags,
            ),
            source=_struct(
                source=text(contracts.SOURCE),
                source_type=text(contracts.SOURCE_TYPE),
                endpoint=keys.source_endpoint(ctx.endpoint_prefix, "site_id"),
                provider=text(contracts.PROVIDER),
                region=text(contracts.REGION),
            ),
            ingestion=_struct(
                ingestion_time=text(ctx.run_ts),
                ingestion_id="ingestion_id",
                batch_id="correlation_id",
                pipeline=text(ctx.pipeline),
                trigger_type=trigger_type("version"),
                retry_count=str(ctx.retry_count),
                source_file_name="file_name",
                file_size_bytes="file_size",
                checksum="file_hash",
                ingestion_latency_seconds=latency(ctx.elapsed_seconds),
                status=text(contracts.INGESTED),
            ),
            event_time=_struct(
                **known(event_time_start="string", event_time_end="string"),
                expected_frequency_seconds=str(contracts.FREQUENCY_SECONDS),
                **known(expected_records="bigint"),
            ),
            data_profile=_struct(
                row_count="row_count",
                **known(
                    null_percentage="double",
                    duplicate_rows="bigint",
                    min_timestamp="string",
                    max_timestamp="string",
                    schema_detected="boolean",
                    corrupted_rows="bigint",
                ),
            ),
            quality_hint=_struct(
                **known(
                    basic_quality_score="double",
                    schema_valid="boolean",
                    time_continuity_suspected_gap="boolean",
                ),
                notes=notes,
            ),
            lineage=_struct(
                parent_dataset_version=parent_version("version"),
                rerun_of=rerun_of("dataset_id", "version"),
                related_incident_id=f"CAST({incident} AS string)",
            ),
        )
    )


def envelope(ctx: RunContext) -> Column:
    """Event struct over the columns of profiled items."""
    return F.expr(
        _struct(
            specversion="'1.0'",
            type=text(contracts.EVENT_TYPE),
            source=text(ctx.event_source),
            id="event_id",
            time=text(ctx.run_ts),
            datacontenttype=text(contracts.CONTENT_TYPE),
            dataschema=text(ctx.dataschema),
            tenant_id=text(ctx.tenant_id),
            source_vendor=text(contracts.SOURCE_VENDOR),
            schema_version=text(ctx.schema_version),
            mapping_version=text(ctx.mapping_version),
            correlation_id="correlation_id",
            ingestion_timestamp=text(ctx.run_ts),
            traceparent=keys.traceparent("ingestion_id"),
            data=_struct(
                site_id="site_id",
                category="category",
                file_format="'csv'",
                storage_path=keys.blob_url(ctx.account_url, ctx.container, "storage_path"),
                version="version",
                ingestion_id="ingestion_id",
                source_url="source_url",
                file_size="file_size",
                file_hash="file_hash",
            ),
        )
    )


def with_checked(rows: DataFrame, name: str, value: Column, schema: dict) -> DataFrame:
    """Add a struct column and, as ``<name>_errors``, its contract violations."""
    return check_struct(rows.withColumn(name, value), name, schema, f"{name}_errors")


def as_json(column: str) -> Column:
    """JSON text with null members kept."""
    return F.to_json(F.col(column), _JSON)
