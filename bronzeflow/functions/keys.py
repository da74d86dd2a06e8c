"""Names, paths, keys and identifiers of a source object, as SQL expressions.

Every function takes SQL expressions (a column name is one) and returns one,
to be used in ``selectExpr`` or ``F.expr``.
"""

from __future__ import annotations

import uuid

from bronzeflow.functions.sql import text

# They must stay as they are or ids and paths of known objects change.
EVENT_ID_NAMESPACE = uuid.UUID("6d1f1a2e-8b7a-4b8b-9c3f-9a8f9e6d5c4b")
# "_data" or "_data_<date>_<date>" at the end, where a final newline may follow
DATA_SUFFIX = (
    r"_data(?:_\p{Nd}{4}-\p{Nd}{2}-\p{Nd}{2}_\p{Nd}{4}-\p{Nd}{2}-\p{Nd}{2})?(?=\n?\z)"
)


def basename(key: str) -> str:
    """Last path segment."""
    return f"element_at(split({key}, '/'), -1)"


def _without_csv(name: str) -> str:
    return f"if(endswith({name}, '.csv'), substr({name}, 1, length({name}) - 4), {name})"


def extract_category(file_name: str, site_id: str) -> str:
    """Measurement category: the stem without site prefix and data suffix."""
    stem = _without_csv(file_name)
    prefix = f"concat({site_id}, '_')"
    inner = f"if(startswith({stem}, {prefix}), substr({stem}, length({prefix}) + 1), {stem})"
    return f"coalesce(nullif(regexp_replace({inner}, {text(DATA_SUFFIX)}, ''), ''), {stem})"


def category_or_default(category: str, file_name: str, site_id: str) -> str:
    """The given category unless it is missing or empty."""
    return f"coalesce(nullif({category}, ''), {extract_category(file_name, site_id)})"


def dataset_id(site_id: str, category: str) -> str:
    return f"concat({site_id}, '_', {category})"


def dataset_folder(dataset: str, ingestion_date: str) -> str:
    return f"concat('source=pvdaq/dataset=', {dataset}, '/ingestion_date=', {ingestion_date})"


def storage_path(dataset: str, ingestion_date: str, version: str) -> str:
    """Path of one version of a dataset file in the bronze layer."""
    folder = dataset_folder(dataset, ingestion_date)
    return f"concat({folder}, '/', {dataset}, '_v', {version}, '.csv')"


def metadata_path(dataset: str, ingestion_date: str) -> str:
    """Path of the sidecar; the version is not part of it."""
    return f"concat({dataset_folder(dataset, ingestion_date)}, '/metadata.json')"


def source_url(bucket_url: str, key: str) -> str:
    """``bucket_url`` is a plain value."""
    return f"concat({text(bucket_url.rstrip('/') + '/')}, {key})"


def source_endpoint(prefix: str, site_id: str) -> str:
    """Data folder of a site; ``prefix`` is a plain value."""
    return f"concat({text(prefix.rstrip('/') + '/')}, {site_id}, '_OEDI/data/')"


def blob_url(account_url: str, container: str, path: str) -> str:
    """Absolute URL with a percent-encoded path; a space becomes %20, "/" stays.

    ``account_url`` and ``container`` are plain values.
    """
    encoded = f"url_encode({path})"
    for escaped, plain in (("+", "%20"), ("%2F", "/"), ("%7E", "~"), ("*", "%2A")):
        encoded = f"replace({encoded}, '{escaped}', '{plain}')"
    return f"concat({text(f'{account_url.rstrip('/')}/{container}/')}, {encoded})"


def partition_key(site_id: str) -> str:
    return f"CAST({site_id} AS STRING)"


def row_key(key: str) -> str:
    return f"sha2({key}, 256)"


def versioned_row_key(key: str, version: str) -> str:
    return f"concat({row_key(key)}, '_v', {version})"


def uuid5(namespace: uuid.UUID, name: str) -> str:
    """RFC 4122 name-based id: SHA-1 of namespace and name, version and variant bits set."""
    digest = f"sha1(concat(unhex('{namespace.hex}'), encode({name}, 'UTF-8')))"
    # a transform over one element computes the digest once for its five parts
    variant = "substr('89ab', 1 + (instr('0123456789abcdef', substr(d, 17, 1)) - 1) % 4, 1)"
    parts = (
        "concat(substr(d, 1, 8), '-', substr(d, 9, 4), '-5', substr(d, 14, 3), '-', "
        f"{variant}, substr(d, 18, 3), '-', substr(d, 21, 12))"
    )
    return f"transform(array({digest}), d -> {parts})[0]"


def event_id(key: str, version: str) -> str:
    """Same object and version, same id: consumers drop re-emitted events by it."""
    return uuid5(EVENT_ID_NAMESPACE, f"concat({key}, '#v', {version})")


def ingestion_id(key: str, version: str, attempt: str) -> str:
    """Identifier of one ingestion attempt, reproducible when a task is retried.

    ``attempt`` is a plain value.
    """
    return uuid5(
        EVENT_ID_NAMESPACE, f"concat({key}, '#v', {version}, {text('#attempt' + attempt)})"
    )


def traceparent(ingestion: str) -> str:
    """W3C trace context made from the ingestion id."""
    digest = f"sha2({ingestion}, 256)"
    return f"concat('00-', substr({digest}, 1, 32), '-', substr({digest}, 33, 16), '-01')"


def utc_date(ts: str) -> str:
    return f"date_format({ts}, 'yyyy-MM-dd')"


def utc_iso(ts: str) -> str:
    """ISO-8601 text with an explicit offset; the session time zone has to be UTC."""
    return f"date_format({ts}, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx\")"


def body_preview(body: str, size: int = 500) -> str:
    """First characters of a message body, undecodable bytes replaced."""
    return f"substr(make_valid_utf8(CAST({body} AS STRING)), 1, {int(size)})"
