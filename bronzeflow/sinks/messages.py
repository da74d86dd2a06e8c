"""Queue messages: key, value and headers, ready for a Kafka or file sink."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bronzeflow import contracts
from bronzeflow.context import RunContext
from bronzeflow.operators.builders import as_json, work_item_json


def _headers(**values) -> Column:
    return F.array(
        *[
            F.struct(
                F.lit(name).alias("key"),
                (v if isinstance(v, Column) else F.lit(v)).cast("binary").alias("value"),
            )
            for name, v in values.items()
        ]
    )


def event_messages(events: DataFrame, ctx: RunContext, envelope: str = "envelope") -> DataFrame:
    """Dataset events; the key is the event id, so equal events meet in one partition."""
    return events.select(
        F.col(f"{envelope}.id").alias("key"),
        as_json(envelope).alias("value"),
        _headers(
            content_type=contracts.EVENT_CONTENT_TYPE,
            subject=F.col(f"{envelope}.type"),
            source_vendor=contracts.SOURCE_VENDOR,
            schema_version=ctx.schema_version,
        ).alias("headers"),
    )


def work_item_messages(items: DataFrame) -> DataFrame:
    """One message per work item."""
    return items.select(
        F.col("s3_key").alias("key"),
        work_item_json().alias("value"),
        _headers(
            content_type=contracts.CONTENT_TYPE, subject=contracts.WORK_ITEM_SUBJECT
        ).alias("headers"),
    )


def dead_letter_messages(letters: DataFrame) -> DataFrame:
    """Dead letters; the subject is the reason code."""
    body = F.struct("correlation_id", "error_type", "file_reference", "failure_reason")
    return letters.select(
        F.col("correlation_id").alias("key"),
        F.to_json(body, {"ignoreNullFields": "false"}).alias("value"),
        _headers(
            content_type=contracts.CONTENT_TYPE,
            subject=F.coalesce(F.col("error_type"), F.lit("validation_failure")),
        ).alias("headers"),
    )


def publish(messages: DataFrame, fmt: str, options: dict[str, str]) -> None:
    """Append messages to a batch sink such as kafka or parquet."""
    messages.write.format(fmt).options(**options).mode("append").save()
