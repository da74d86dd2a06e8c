"""Message bodies: decode, validate against a contract, split into accepted and rejected."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bronzeflow import contracts
from bronzeflow.functions import keys
from bronzeflow.operators import failures
from bronzeflow.operators.once import compute_once
from bronzeflow.operators.schema import check_variant, first_error

WORK_ITEM_TYPES = {
    "site_id": "bigint",
    "s3_key": "string",
    "file_name": "string",
    "category": "string",
    "correlation_id": "string",
    "enqueued_at": "string",
    "last_modified": "string",
}


def only_value(text: str) -> Column:
    """The text as the first element of an array whose second one is the text's own hash.

    The JSON reader stops after the first value and would let trailing text
    pass. A text cannot hold its own hash, so whatever follows its value, a
    closing bracket included, keeps the hash from being the second element.
    """
    body = F.col(text)
    return F.try_parse_json(F.concat(F.lit("["), body, F.lit(',"'), F.sha2(body, 256), F.lit('"]')))


def _is_only_value(text: str) -> Column:
    second = F.try_variant_get("_array", "$[1]", "string")
    third = F.try_variant_get("_array", "$[2]", "variant")
    return F.coalesce((second == F.sha2(F.col(text), 256)) & third.isNull(), F.lit(False))


def parse_bodies(messages: DataFrame, body: str = "body") -> DataFrame:
    """Add raw_body, document (VARIANT, null unless a JSON object) and body_problem."""
    text = F.col(body).cast("string")
    sole = F.try_variant_get("_array", "$[0]", "variant")
    parsed = compute_once(
        messages.withColumn("raw_body", F.when(F.is_valid_utf8(text), text)), "_array", only_value("raw_body")
    )
    only = F.when(_is_only_value("raw_body"), sole)
    is_object = F.schema_of_variant(only).startswith("OBJECT")
    problem = (
        F.when(F.col("raw_body").isNull(), "body is not valid UTF-8")
        .when(only.isNull(), "body is not valid JSON")
        .when(~is_object, "body must be a JSON object")
    )
    return (
        parsed.withColumn("document", F.when(F.coalesce(is_object, F.lit(False)), only))
        .withColumn("body_problem", problem)
        .drop("_array")
    )


def check_work_items(messages: DataFrame, body: str = "body") -> DataFrame:
    """Add the typed work-item fields, ``errors`` and ``stage``.

    ``stage`` is null for an accepted message, else parse or work_item, the
    place it failed at.
    """
    checked = check_variant(
        parse_bodies(messages, body), "document", contracts.work_item(), "errors"
    )
    stage = F.when(F.col("document").isNull(), "parse").when(F.size("errors") > 0, "work_item")
    fields = {
        name: F.try_variant_get("document", f"$.{name}", kind)
        for name, kind in WORK_ITEM_TYPES.items()
    }
    fields["correlation_id"] = F.coalesce(fields["correlation_id"], F.lit("unknown"))
    return checked.withColumns({**fields, "stage": stage})


def accepted_work_items(checked: DataFrame) -> DataFrame:
    """Typed work items of the accepted messages, with the category filled in."""
    category = F.expr(keys.category_or_default("category", "file_name", "site_id"))
    return checked.filter(F.col("stage").isNull()).select(
        *[category.alias(c) if c == "category" else F.col(c) for c in WORK_ITEM_TYPES]
    )


def rejected_work_items(checked: DataFrame, body: str = "body") -> DataFrame:
    """Dead letters of the rejected messages."""
    rejected = checked.filter(F.col("stage").isNotNull())
    stage = F.col("stage")
    return failures.dead_letters(
        rejected,
        F.col("correlation_id"),
        failures.dead_letter_reason(stage),
        failures.file_reference(stage, F.expr(keys.body_preview(body)), F.col("raw_body"), F.lit(None)),
        F.coalesce(F.col("body_problem"), first_error(F.col("errors"))),
    )


def check_records(records: DataFrame, payload: str = "payload") -> DataFrame:
    """Add ``document`` and all schema errors of telemetry records held as JSON text."""
    held = compute_once(records, "_array", only_value(payload))
    sole = F.when(_is_only_value(payload), F.try_variant_get("_array", "$[0]", "variant"))
    parsed = held.withColumn("document", sole).drop("_array")
    checked = check_variant(parsed, "document", contracts.telemetry_record(), "errors")
    not_json = F.array(
        F.struct(
            F.lit("$").alias("path"),
            F.lit("type").alias("validator"),
            F.lit("record is not valid JSON").alias("message"),
        )
    )
    return checked.withColumn("errors", F.coalesce(F.col("errors"), not_json))


def record_dead_letters(checked: DataFrame, correlation_id: str, run_ts: str, schema_version: str) -> DataFrame:
    """Dead letters of invalid records: payload unmodified, every error, site id if it is one."""
    site = F.try_variant_get("document", "$.SiteID", "variant")
    is_integer = F.schema_of_variant(site) == "BIGINT"
    return checked.filter(F.size("errors") > 0).select(
        F.col("payload").alias("original_payload"),
        F.lit(failures.VALIDATION_FAILURE).alias("error_type"),
        F.transform(
            "errors",
            lambda e: F.struct(e["message"].alias("message"), e["path"].alias("path"),
                               e["validator"].alias("validator")),
        ).alias("error_details"),
        F.lit(correlation_id).alias("correlation_id"),
        F.when(is_integer, F.try_variant_get(site, "$", "bigint")).alias("site_id"),
        F.lit(run_ts).alias("timestamp"),
        F.lit(contracts.SOURCE_VENDOR).alias("source_vendor"),
        F.lit(schema_version).alias("schema_version"),
    )


def split_by_event_type(events: DataFrame, type_column: str = "type") -> tuple[DataFrame, DataFrame]:
    """(events of exactly the registered type, everything else for the dead-letter queue)."""
    known: Column = F.coalesce(F.col(type_column) == contracts.EVENT_TYPE, F.lit(False))
    return events.filter(known), events.filter(~known)
