"""Transient or deterministic, which dead-letter reason, and what to do with the message."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Error classes by family. Queue errors outside the second list are transient.
CONTENTION = ["CommitContentionError"]
REQUEST = ["ServiceRequestError", "ServiceResponseError", "ServiceRequestTimeoutError",
           "ServiceResponseTimeoutError"]
HTTP = ["HttpResponseError", "HTTPStatusError", "ResourceNotFoundError", "ResourceExistsError",
        "ResourceModifiedError", "ResourceNotModifiedError", "ClientAuthenticationError"]
QUEUE_DETERMINISTIC = [
    "MessagingEntityNotFoundError", "MessagingEntityDisabledError",
    "MessagingEntityAlreadyExistsError", "ServiceBusAuthenticationError",
    "ServiceBusAuthorizationError", "MessageSizeExceededError", "MessageNotFoundError",
]
QUEUE_TRANSIENT = [
    "ServiceBusError", "ServiceBusConnectionError", "ServiceBusCommunicationError",
    "ServiceBusServerBusyError", "OperationTimeoutError", "ServiceBusQuotaExceededError",
    "MessageLockLostError", "SessionLockLostError", "AutoLockRenewFailed", "AutoLockRenewTimeout",
    "SessionCannotBeLockedError",
]
TRANSPORT = [
    "ConnectError", "ConnectTimeout", "ReadError", "ReadTimeout", "WriteError", "WriteTimeout",
    "PoolTimeout", "CloseError", "NetworkError", "ProtocolError", "LocalProtocolError",
    "RemoteProtocolError", "ProxyError", "TimeoutException", "TransportError",
    "UnsupportedProtocol",
]
# HTTP statuses worth a retry besides 5xx
RETRY_STATUSES = [408, 429]
# Dead-letter reason codes
MALFORMED_BODY = "malformed_body"
VALIDATION_FAILURE = "validation_failure"
METADATA_FAILURE = "metadata_validation_failure"
ENVELOPE_FAILURE = "envelope_validation_failure"
DATASET_FAILURE = "dataset_failure"


def error_family(error_class: Column) -> Column:
    return (
        F.when(error_class.isin(CONTENTION), "contention")
        .when(error_class.isin(REQUEST), "request")
        .when(error_class.isin(HTTP), "http")
        .when(error_class.isin(QUEUE_DETERMINISTIC + QUEUE_TRANSIENT), "queue")
        .when(error_class.isin(TRANSPORT), "transport")
        .otherwise("other")
    )


def link_is_transient(link: Column) -> Column:
    """Verdict on one struct<error_class, error_family, http_status> without its causes.

    ``error_family`` lets a caller name the family of a class not listed here;
    null derives it from the class.
    """
    error_class, status = link["error_class"], link["http_status"]
    family = F.coalesce(link["error_family"], error_family(error_class))
    retry_status = F.coalesce((status >= 500) | status.isin(RETRY_STATUSES), F.lit(False))
    return (
        F.when(family.isin("contention", "request", "transport"), True)
        .when(family == "http", retry_status)
        .when(family == "queue", ~error_class.isin(QUEUE_DETERMINISTIC))
        .otherwise(False)
    )


def is_transient(chain: Column) -> Column:
    """True when any link of the cause chain (array of links) is transient."""
    return F.coalesce(F.exists(chain, link_is_transient), F.lit(False))


def dead_letter_reason(stage: Column) -> Column:
    """Reason code of the stage a message failed in."""
    return (
        F.when(stage == "parse", MALFORMED_BODY)
        .when(stage == "work_item", VALIDATION_FAILURE)
        .when(stage == "metadata", METADATA_FAILURE)
        .when(stage == "envelope", ENVELOPE_FAILURE)
        .otherwise(DATASET_FAILURE)
    )


def file_reference(stage: Column, preview: Column, body: Column, key: Column) -> Column:
    """What the dead letter points at: body preview, whole body, or object key."""
    return (
        F.when(stage == "parse", preview)
        .when(stage == "work_item", body)
        .otherwise(F.coalesce(F.when(key != "", key), F.lit("unknown")))
    )


def route_failures(
    failures: DataFrame,
    stage: str = "stage",
    transient: str = "transient",
    identified: str = "identified",
) -> DataFrame:
    """Add error_type, dead_letter, redeliver and mark_failed.

    ``stage`` is config, parse, work_item, metadata, envelope, dead_letter_send
    or any later stage; ``identified`` tells that site, key and version were known.
    """
    at, retry, known = F.col(stage), F.col(transient), F.col(identified)
    unsendable = at.isin("config", "dead_letter_send")
    rejected = at.isin("parse", "work_item")
    return (
        failures.withColumn("error_type", F.when(~unsendable, dead_letter_reason(at)))
        .withColumn("dead_letter", ~unsendable)
        .withColumn("redeliver", unsendable | (~rejected & retry))
        .withColumn("mark_failed", ~rejected & (at != "config") & known)
    )


def dead_letters(
    failures: DataFrame, correlation_id: Column, error_type: Column, reference: Column,
    reason: Column,
) -> DataFrame:
    """Flat dead-letter messages."""
    return failures.select(
        F.coalesce(correlation_id, F.lit("unknown")).alias("correlation_id"),
        error_type.alias("error_type"),
        reference.alias("file_reference"),
        reason.alias("failure_reason"),
    )


def unique_dead_letters(letters: DataFrame) -> DataFrame:
    """Report form: a message dead-lettered on several deliveries counts once."""
    key = ["correlation_id", "file_reference", "error_type"]
    return letters.groupBy(*key).agg(
        F.min("failure_reason").alias("failure_reason"), F.count(F.lit(1)).alias("deliveries")
    )
