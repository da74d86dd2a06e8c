"""Message and record contracts, as JSON-Schema subsets in plain Python.

``operators.schema`` compiles them to column expressions. ``format`` is not
asserted; the patterns next to it are.
"""

from __future__ import annotations

from bronzeflow.context import RunContext

# patterns
UUID = r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
TIMESTAMP = (
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]+)?(Z|[+-][0-9]{2}:[0-9]{2})$"
)
TRACEPARENT = r"^00-[0-9a-f]{32}-[0-9a-f]{16}-[0-9a-f]{2}$"
ZERO_TRACE = r"^00-0{32}-"
ZERO_PARENT = r"-0{16}-[0-9a-f]{2}$"
SHA256 = r"^[0-9a-f]{64}$"
SCHEMA_VERSION = r"^v[0-9]+$"
MAPPING_VERSION = r"^(v[0-9]+|unknown)$"
HTTP_URL = r"^https?://[^ ]+$"
MEASURED = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2})?"

# Identifiers in messages and sidecars
EVENT_TYPE = "solar.pvdaq.dataset.available.v1"
RETIRED_EVENT_TYPES = (
    "raw.pvdaq.generation.v1",
    "raw.pvdaq.historical.v1",
    "solar.pvdaq.dataset.available",
)
SOURCE_VENDOR = "PVDAQ"
DATASET_TYPE = "time_series"
BRONZE_SCHEMA_VERSION = "unknown"
TAGS = ("pvdaq", "solar")
SOURCE = "pvdaq"
SOURCE_TYPE = "s3_public"
PROVIDER = "NREL"
REGION = "us-east-1"
FREQUENCY_SECONDS = 300
INGESTED = "success"
CONTENT_TYPE = "application/json"
EVENT_CONTENT_TYPE = "application/cloudevents+json"
WORK_ITEM_SUBJECT = "historical_work_item"


def _text(**limits) -> dict:
    return {"type": "string", **limits}


def _name() -> dict:
    return _text(minLength=1)


def _integer(minimum: int) -> dict:
    return {"type": "integer", "minimum": minimum}


def _closed(properties: dict, optional: tuple[str, ...] = ()) -> dict:
    return {
        "type": "object",
        "required": [name for name in properties if name not in optional],
        "properties": properties,
        "additionalProperties": False,
    }


def _or_null(schema: dict) -> dict:
    return {**schema, "type": [schema["type"], "null"]}


def work_item() -> dict:
    """Queue message for one source object."""
    return _closed(
        {
            "site_id": _integer(1),
            "s3_key": _name(),
            "file_name": _name(),
            "category": _name(),
            "correlation_id": _text(pattern=UUID),
            "enqueued_at": _text(pattern=TIMESTAMP),
            "last_modified": _text(pattern=TIMESTAMP, minLength=1),
        },
        optional=("category", "last_modified"),
    )


def metadata_file(ctx: RunContext) -> dict:
    """Sidecar next to a bronze file."""
    fraction = {"type": "number", "minimum": 0, "maximum": 1}
    moment = _or_null(_text(pattern=TIMESTAMP))
    strings = {"type": "array", "items": _text()}
    flag = {"type": ["boolean", "null"]}
    return _closed(
        {
            "dataset": _closed(
                {
                    "dataset_id": _name(),
                    "dataset_type": _text(const=DATASET_TYPE),
                    "version": _integer(1),
                    "schema_version": _text(const=BRONZE_SCHEMA_VERSION),
                    "tags": strings,
                }
            ),
            "source": _closed(
                {
                    "source": _text(const=SOURCE),
                    "source_type": _text(const=SOURCE_TYPE),
                    "endpoint": _name(),
                    "provider": _text(const=PROVIDER),
                    "region": _text(const=REGION),
                }
            ),
            "ingestion": _closed(
                {
                    "ingestion_time": _text(pattern=TIMESTAMP),
                    "ingestion_id": _text(pattern=UUID),
                    "batch_id": _text(pattern=UUID),
                    "pipeline": _text(const=ctx.pipeline),
                    "trigger_type": _text(enum=["scheduled", "rerun"]),
                    "retry_count": _integer(0),
                    "source_file_name": _name(),
                    "file_size_bytes": _integer(0),
                    "checksum": _text(pattern=SHA256),
                    "ingestion_latency_seconds": {"type": "number", "minimum": 0},
                    "status": _text(const=INGESTED),
                }
            ),
            "event_time": _closed(
                {
                    "event_time_start": moment,
                    "event_time_end": moment,
                    "expected_frequency_seconds": _or_null(_integer(1)),
                    "expected_records": _or_null(_integer(0)),
                }
            ),
            "data_profile": _closed(
                {
                    "row_count": _integer(0),
                    "null_percentage": _or_null(fraction),
                    "duplicate_rows": _or_null(_integer(0)),
                    "min_timestamp": moment,
                    "max_timestamp": moment,
                    "schema_detected": flag,
                    "corrupted_rows": _or_null(_integer(0)),
                }
            ),
            "quality_hint": _closed(
                {
                    "basic_quality_score": _or_null(fraction),
                    "schema_valid": flag,
                    "time_continuity_suspected_gap": flag,
                    "notes": strings,
                }
            ),
            "lineage": _closed(
                {
                    "parent_dataset_version": _or_null(_integer(1)),
                    "rerun_of": _or_null(_text()),
                    "related_incident_id": _or_null(_text()),
                }
            ),
        }
    )


def dataset_available(ctx: RunContext) -> dict:
    """Event envelope: closed around an open data block."""
    data = _closed(
        {
            "site_id": _integer(1),
            "category": _name(),
            "file_format": _text(const="csv"),
            "storage_path": _text(pattern=HTTP_URL),
            "version": _integer(1),
            "ingestion_id": _text(pattern=UUID),
            "source_url": _name(),
            "file_size": _integer(0),
            "file_hash": _text(pattern=SHA256),
        }
    )
    return _closed(
        {
            "specversion": _text(const="1.0"),
            "type": _text(const=EVENT_TYPE),
            "source": _text(const=ctx.event_source),
            "id": _text(pattern=UUID),
            "time": _text(pattern=TIMESTAMP),
            "datacontenttype": _text(const=CONTENT_TYPE),
            "dataschema": _text(const=ctx.dataschema),
            "tenant_id": _name(),
            "source_vendor": _text(const=SOURCE_VENDOR),
            "schema_version": _text(pattern=SCHEMA_VERSION),
            "mapping_version": _text(pattern=MAPPING_VERSION),
            "correlation_id": _text(pattern=UUID),
            "ingestion_timestamp": _text(pattern=TIMESTAMP),
            "traceparent": _text(
                pattern=TRACEPARENT,
                allOf=[{"not": {"pattern": ZERO_TRACE}}, {"not": {"pattern": ZERO_PARENT}}],
            ),
            "data": {**data, "additionalProperties": True},
        }
    )


def telemetry_record() -> dict:
    """One measurement of a site; vendor fields beyond these are allowed."""
    numbers = (
        "ac_power", "dc_power", "poa_irradiance", "ambient_temp", "module_temp", "wind_speed",
        "inverter_efficiency",
    )
    return {
        "type": "object",
        "required": ["SiteID", "measdatetime"],
        "properties": {
            "SiteID": _integer(1),
            "measdatetime": _text(pattern=MEASURED),
            **{name: {"type": "number"} for name in numbers},
        },
    }


def record_dead_letter() -> dict:
    """Rejected telemetry record with all its errors."""
    return _closed(
        {
            "original_payload": {"type": "object"},
            "error_type": _text(const="validation_failure"),
            "error_details": {
                "type": "array",
                "minItems": 1,
                "items": {
                    "type": "object",
                    "required": ["message", "path"],
                    "properties": {"message": _text(), "path": _text(), "validator": _text()},
                },
            },
            "correlation_id": _text(pattern=UUID),
            "site_id": {"oneOf": [{"type": "integer"}, {"type": "null"}]},
            "timestamp": _text(pattern=TIMESTAMP),
            "source_vendor": _text(const=SOURCE_VENDOR),
            "schema_version": _text(),
        }
    )
