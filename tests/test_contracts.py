"""Accept and reject lists of the message and sidecar contracts."""

import json

import pytest
from pyspark.sql import functions as F

from bronzeflow import contracts
from bronzeflow.catalog.adapters import CONTEXT
from bronzeflow.context import ConfigurationError, RunContext, check_mapping_version, parse_site_ids
from bronzeflow.operators import builders, messages
from bronzeflow.operators.schema import check_struct, check_variant

ID = "c0ffee00-0000-4000-8000-000000000001"
ITEM = {
    "site_id": 9068, "s3_key": "k.csv", "file_name": "9068_ac_power_data.csv",
    "category": "ac_power", "correlation_id": ID, "enqueued_at": "2024-01-15T12:00:00Z",
    "last_modified": "2024-01-15T12:00:00+02:00",
}
DROP = object()


def changed(base, **changes):
    merged = {**base, **changes}
    return json.dumps({k: v for k, v in merged.items() if v is not DROP})


def violations(spark, bodies, schema):
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "i int, b string")
    checked = check_variant(df.withColumn("v", F.try_parse_json("b")), "v", schema, "errors")
    return [
        [f"{e.path}:{e.validator}" for e in r.errors] for r in checked.orderBy("i").collect()
    ]


WORK_ITEMS = [
    (changed(ITEM), []),
    (changed(ITEM, category=DROP, last_modified=DROP), []),
    (changed(ITEM, site_id=9068.0), []),
    (changed(ITEM, enqueued_at="2024-01-15T12:00:00.123456+00:00"), []),
    (changed(ITEM, correlation_id="run 17"), ["$.correlation_id:pattern"]),
    (changed(ITEM, correlation_id=ID[:-1] + "G"), ["$.correlation_id:pattern"]),
    (changed(ITEM, correlation_id=ID + "0"), ["$.correlation_id:pattern"]),
    (changed(ITEM, correlation_id="{" + ID + "}"), ["$.correlation_id:pattern"]),
    (changed(ITEM, correlation_id=DROP), ["$:required"]),
    (changed(ITEM, enqueued_at="T"), ["$.enqueued_at:pattern"]),
    (changed(ITEM, enqueued_at="1705320000"), ["$.enqueued_at:pattern"]),
    (changed(ITEM, enqueued_at="15.01.2024 12:00"), ["$.enqueued_at:pattern"]),
    (changed(ITEM, enqueued_at="2024-1-5T12:00:00Z"), ["$.enqueued_at:pattern"]),
    (changed(ITEM, enqueued_at="2024-01-15T12.00.00Z"), ["$.enqueued_at:pattern"]),
    (changed(ITEM, enqueued_at="2024-01-15T12:00:00+0"), ["$.enqueued_at:pattern"]),
    (changed(ITEM, last_modified=""), ["$.last_modified:minLength", "$.last_modified:pattern"]),
    (changed(ITEM, last_modified=None), ["$.last_modified:type"]),
    (changed(ITEM, site_id=0), ["$.site_id:minimum"]),
    (changed(ITEM, site_id="9068"), ["$.site_id:type"]),
    (changed(ITEM, site_id=True), ["$.site_id:type"]),
    (changed(ITEM, site_id=1.5), ["$.site_id:type"]),
    (changed(ITEM, s3_key=""), ["$.s3_key:minLength"]),
    (changed(ITEM, s3_key=5), ["$.s3_key:type"]),
    (changed(ITEM, category=""), ["$.category:minLength"]),
    (changed(ITEM, extra=1, more=2), ["$:additionalProperties"]),
    ("{}", ["$:required"] * 5),
    ("[1]", ["$:type"]),
]


def test_work_items(spark):
    got = violations(spark, [b for b, _ in WORK_ITEMS], contracts.work_item())
    assert [sorted(g) for g in got] == [sorted(e) for _, e in WORK_ITEMS]


def test_root_errors_come_first(spark):
    body = changed(ITEM, site_id=0, extra=1)
    assert violations(spark, [body], contracts.work_item())[0][0] == "$:additionalProperties"


RECORD = {"SiteID": 5, "measdatetime": "2024-01-01T00:00:00"}


def test_telemetry_collects_every_error(spark):
    cases = [
        (RECORD, []),
        ({**RECORD, "vendor": [1], "ac_power": 1.5, "dc_power": 3}, []),
        ({"measdatetime": "2024-01-01 00:00"}, ["$:required"]),
        ({**RECORD, "SiteID": "5"}, ["$.SiteID:type"]),
        (
            {"SiteID": 0, "measdatetime": "x", "wind_speed": "fast", "ac_power": None},
            ["$.SiteID:minimum", "$.measdatetime:pattern", "$.ac_power:type", "$.wind_speed:type"],
        ),
    ]
    got = violations(spark, [json.dumps(c) for c, _ in cases], contracts.telemetry_record())
    assert got == [e for _, e in cases]


def test_nested_arrays_and_one_of(spark):
    good = {
        "original_payload": {"a": 1}, "error_type": "validation_failure",
        "error_details": [{"message": "m", "path": "$"}], "correlation_id": ID, "site_id": None,
        "timestamp": "2024-01-01T00:00:00Z", "source_vendor": "PVDAQ", "schema_version": "v1",
    }
    cases = [
        (good, []),
        ({**good, "site_id": 5}, []),
        ({**good, "site_id": "5"}, ["$.site_id:oneOf"]),
        ({**good, "error_details": []}, ["$.error_details:minItems"]),
        (
            {**good, "error_details": [{"message": "m", "path": "$"}, {"message": 1}]},
            ["$.error_details[1]:required", "$.error_details[1].message:type"],
        ),
        ({**good, "error_type": "other"}, ["$.error_type:const"]),
    ]
    got = violations(spark, [json.dumps(c) for c, _ in cases], contracts.record_dead_letter())
    assert got == [e for _, e in cases]


def test_unsupported_keyword_is_refused(spark):
    with pytest.raises(ValueError):
        violations(spark, ["{}"], {"type": "object", "uniqueItems": True})


def test_references(spark):
    schema = {
        "type": "object",
        "properties": {"a": {"$ref": "#/$defs/word"}},
        "$defs": {"word": {"type": "string", "maxLength": 2, "enum": ["ab", "abc"]}},
    }
    got = violations(spark, ['{"a":"ab"}', '{"a":"abc"}', '{"a":"x"}'], schema)
    assert got == [[], ["$.a:maxLength"], ["$.a:enum"]]


PROFILED = (
    "site_id bigint, s3_key string, file_name string, category string, correlation_id string, "
    "version bigint, dataset_id string, storage_path string, source_url string, event_id string, "
    "ingestion_id string, file_size bigint, file_hash string, row_count bigint"
)
ROW = (
    9068, "k", "9068_ac power_data.csv", "ac power", ID, 2, "9068_ac power", "dataset=9068_ac power/x.csv",
    "https://b/k", ID, ID, 10, "a" * 64, 3,
)


def built(spark, row=ROW, ctx=CONTEXT):
    df = spark.createDataFrame([row], PROFILED)
    df = builders.with_checked(df, "metadata", builders.metadata(ctx), contracts.metadata_file(ctx))
    return builders.with_checked(
        df, "envelope", builders.envelope(ctx), contracts.dataset_available(ctx)
    ).withColumn("metadata_json", builders.as_json("metadata")).withColumn(
        "envelope_json", builders.as_json("envelope")
    ).first()


def test_built_artifacts_are_valid(spark):
    row = built(spark)
    assert row.metadata_errors == [] and row.envelope_errors == []
    metadata, envelope = json.loads(row.metadata_json), json.loads(row.envelope_json)
    assert list(metadata) == [
        "dataset", "source", "ingestion", "event_time", "data_profile", "quality_hint", "lineage"
    ]
    assert metadata["lineage"] == {
        "parent_dataset_version": 1, "rerun_of": "9068_ac power_v1", "related_incident_id": None
    }
    assert metadata["quality_hint"]["notes"] == [] and metadata["dataset"]["tags"] == ["pvdaq", "solar"]
    assert metadata["ingestion"]["batch_id"] == ID
    assert len(envelope) == 15 and len(envelope["data"]) == 9
    assert envelope["data"]["storage_path"].endswith("dataset%3D9068_ac%20power/x.csv")


def test_sidecar_filled_from_a_profile(spark):
    from bronzeflow.operators import profile

    rows = spark.createDataFrame(
        [("9068_ac power", f"2024-01-01 00:{m:02d}:00", 1.0) for m in range(0, 60, 5)], "d string, ts string, v double"
    )
    profiled = profile.profile_dataset(
        rows.withColumn("ts", F.to_timestamp("ts")), "d", "ts", ["ts", "v"], small_rows=100
    )
    fields = ["event_time_start", "event_time_end", "expected_records", "null_percentage", "duplicate_rows",
              "min_timestamp", "max_timestamp", "schema_detected", "corrupted_rows", "basic_quality_score",
              "schema_valid", "time_continuity_suspected_gap", "notes"]
    known = profiled.select(F.col("dataset").alias("dataset_id"), *fields)
    joined = spark.createDataFrame([ROW], PROFILED).join(known, "dataset_id")
    value = builders.metadata(CONTEXT, {n: n for n in fields}, incident="'INC-1'")
    row = builders.with_checked(joined, "metadata", value, contracts.metadata_file(CONTEXT)).first()
    assert row.metadata_errors == []
    assert row.metadata.event_time.event_time_start == "2024-01-01T00:00:00.000000+00:00"
    assert row.metadata.event_time.expected_records == 12
    assert row.metadata.quality_hint.notes == ["row count unexpectedly small"]
    assert row.metadata.lineage.related_incident_id == "INC-1"


@pytest.mark.parametrize(
    "column, value, sidecar, event",
    [
        ("file_hash", "A" * 64, ["$.ingestion.checksum:pattern"], ["$.data.file_hash:pattern"]),
        ("file_size", -1, ["$.ingestion.file_size_bytes:minimum"], ["$.data.file_size:minimum"]),
        ("row_count", None, ["$.data_profile.row_count:type"], []),
        ("event_id", "nope", [], ["$.id:pattern"]),
        ("version", 0, ["$.dataset.version:minimum"], ["$.data.version:minimum"]),
        ("correlation_id", "unknown", ["$.ingestion.batch_id:pattern"], ["$.correlation_id:pattern"]),
    ],
)
def test_broken_artifacts(spark, column, value, sidecar, event):
    names = [part.split()[0] for part in PROFILED.split(", ")]
    row = tuple(value if n == column else v for n, v in zip(names, ROW))
    got = built(spark, row)
    assert [f"{e.path}:{e.validator}" for e in got.metadata_errors] == sidecar
    assert [f"{e.path}:{e.validator}" for e in got.envelope_errors] == event


ENVELOPE = {
    "specversion": "1.0", "type": contracts.EVENT_TYPE, "source": CONTEXT.event_source, "id": ID,
    "time": "2024-01-01T00:00:00Z", "datacontenttype": "application/json",
    "dataschema": CONTEXT.dataschema, "tenant_id": "t", "source_vendor": "PVDAQ",
    "schema_version": "v1", "mapping_version": "unknown", "correlation_id": ID,
    "ingestion_timestamp": "2024-01-01T00:00:00Z", "traceparent": f"00-{'a' * 32}-{'b' * 16}-01",
    "data": {
        "site_id": 1, "category": "c", "file_format": "csv", "storage_path": "http://a/b",
        "version": 1, "ingestion_id": ID, "source_url": "u", "file_size": 0, "file_hash": "0" * 64,
    },
}


def test_envelope_is_closed_and_its_data_open(spark):
    data = ENVELOPE["data"]
    cases = [
        (ENVELOPE, []),
        ({**ENVELOPE, "data": {**data, "device_id": "d"}}, []),
        ({**ENVELOPE, "device_id": "d"}, ["$:additionalProperties"]),
        ({**ENVELOPE, "type": contracts.RETIRED_EVENT_TYPES[2]}, ["$.type:const"]),
        ({**ENVELOPE, "traceparent": f"00-{'0' * 32}-{'b' * 16}-01"}, ["$.traceparent:not"]),
        ({**ENVELOPE, "traceparent": f"00-{'a' * 32}-{'0' * 16}-01"}, ["$.traceparent:not"]),
        ({**ENVELOPE, "mapping_version": "1.0"}, ["$.mapping_version:pattern"]),
        ({**ENVELOPE, "data": {**data, "storage_path": "http://a/b c"}}, ["$.data.storage_path:pattern"]),
        ({**ENVELOPE, "data": {k: v for k, v in data.items() if k != "version"}}, ["$.data:required"]),
    ]
    got = violations(spark, [json.dumps(c) for c, _ in cases], contracts.dataset_available(CONTEXT))
    assert got == [e for _, e in cases]


def test_struct_with_missing_and_extra_fields(spark):
    df = spark.range(1).selectExpr("named_struct('b', 1, 'c', 2) AS s")
    schema = {"type": "object", "required": ["a"], "properties": {"a": {"type": "string"}, "b": {"type": "string"}},
              "additionalProperties": False}
    errors = check_struct(df, "s", schema, "e").first().e
    assert [f"{e.path}:{e.validator}" for e in errors] == [
        "$:required", "$:additionalProperties", "$.b:type"
    ]


BODIES = [
    (b"\xff\xfe", "parse", "malformed_body"),
    (b"not json", "parse", "malformed_body"),
    (b"", "parse", "malformed_body"),
    (b"[1]", "parse", "malformed_body"),
    (b'"text"', "parse", "malformed_body"),
    (b"null", "parse", "malformed_body"),
    (changed(ITEM).encode() + b" x", "parse", "malformed_body"),
    (changed(ITEM).encode() + b",{}", "parse", "malformed_body"),
    (changed(ITEM, site_id=0).encode(), "work_item", "validation_failure"),
    (changed(ITEM).encode(), None, None),
]


def test_bodies(spark):
    df = spark.createDataFrame([(i, b) for i, (b, _, _) in enumerate(BODIES)], "i int, body binary")
    checked = messages.check_work_items(df)
    assert [r.stage for r in checked.orderBy("i").collect()] == [s for _, s, _ in BODIES]
    letters = messages.rejected_work_items(checked).collect()
    assert sorted(r.error_type for r in letters) == sorted(t for _, _, t in BODIES if t)
    assert all(r.failure_reason for r in letters)
    assert {r.correlation_id for r in letters if r.error_type == "malformed_body"} == {"unknown"}
    item = messages.accepted_work_items(checked).first()
    assert (item.site_id, item.category, item.last_modified) == (9068, "ac_power", ITEM["last_modified"])


def test_configuration():
    assert parse_site_ids("9068, 9069,,2107 ,9068") == [9068, 9069, 2107, 9068]
    with pytest.raises(ConfigurationError):
        parse_site_ids("9068,abc")
    for value in ("unknown", "v1", "v12"):
        assert check_mapping_version(value) == value
    for value in ("", "1", "v", "v1.0", "V1", "unknown2"):
        with pytest.raises(ConfigurationError):
            check_mapping_version(value)
    with pytest.raises(ConfigurationError):
        RunContext(run_ts="", correlation_id=ID)
