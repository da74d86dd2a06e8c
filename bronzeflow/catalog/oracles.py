"""DuckDB SQL for the registered queries, from the raw tables."""

from __future__ import annotations

from bronzeflow.catalog import adapters
from bronzeflow.catalog.adapters import CONTEXT, PREFIX
from bronzeflow.contracts import EVENT_TYPE, RETIRED_EVENT_TYPES

_UUID = "[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}"
_STAMP = (
    "[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]+)?(Z|[+-][0-9]{2}:[0-9]{2})"
)
_NAMESPACE = "6d1f1a2e8b7a4b8b9c3f9a8f9e6d5c4b"
_RUN = CONTEXT.run_ts
_DATE = CONTEXT.run_date


def _plain(text: str) -> str:
    text = text.replace("<bytes>", "strlen(text)").replace("<sha256>", "sha256(key)")
    return text.replace("<versions>", "unnest(range(1, 2 + quality + toxic))")


def _category(name: str, site: str) -> str:
    stem = f"(CASE WHEN {name} LIKE '%.csv' THEN left({name}, length({name}) - 4) ELSE {name} END)"
    inner = (
        f"(CASE WHEN starts_with({stem}, {site} || '_') "
        f"THEN substr({stem}, length({site} || '_') + 1) ELSE {stem} END)"
    )
    pattern = r"_data(?:_\d{4}-\d{2}-\d{2}_\d{4}-\d{2}-\d{2})?(\n?)$"
    return f"coalesce(nullif(regexp_replace({inner}, '{pattern}', '\\1'), ''), {stem})"


def _uuid5(name: str) -> str:
    h = f"sha1(unhex('{_NAMESPACE}') || encode({name}))"
    variant = f"substr('89ab', 1 + (instr('0123456789abcdef', substr({h}, 17, 1)) - 1) % 4, 1)"
    return (
        f"(substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-5' || substr({h}, 14, 3) || '-' || "
        f"{variant} || substr({h}, 18, 3) || '-' || substr({h}, 21, 12))"
    )


def _iso(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00'"


def _url(path: str) -> str:
    return (
        f"'{CONTEXT.account_url}/{CONTEXT.container}/' || replace(url_encode({path}), '%2F', '/')"
    )


_INGESTION = _uuid5(f"s3_key || '#v' || version || '#attempt{CONTEXT.attempt}'")
_EVENT = _uuid5("s3_key || '#v' || version")

_CTES = {
    "listing": adapters.LISTING,
    "csv_listing": adapters.CSV_LISTING,
    "tracking_base": adapters.TRACKING_BASE,
    "tracking_versions": adapters.TRACKING_VERSIONS,
    "named": f"""
        SELECT *, {_category('file_name', 'site_id')} AS category,
          site_id || '_' || {_category('file_name', 'site_id')} AS dataset_id
        FROM listing""",
    "changed": """
        SELECT c.* FROM csv_listing c WHERE NOT EXISTS (
          SELECT 1 FROM tracking_base t
          WHERE t.status = 'completed' AND t.partition_key = CAST(c.site_id AS VARCHAR)
            AND t.s3_key = c.key AND t.size IS NOT DISTINCT FROM c.size
            AND t.last_modified IS NOT DISTINCT FROM c.last_modified)""",
    "max_versions": """
        SELECT s3_key, max(version) AS max_version FROM tracking_versions
        WHERE status = 'completed' GROUP BY s3_key""",
    "resolved": f"""
        SELECT *, 'source=pvdaq/dataset=' || dataset_id || '/ingestion_date={_DATE}/' AS folder,
          'source=pvdaq/dataset=' || dataset_id || '/ingestion_date={_DATE}/' || dataset_id ||
            '_v' || version || '.csv' AS storage_path,
          'source=pvdaq/dataset=' || dataset_id || '/ingestion_date={_DATE}/metadata.json'
            AS metadata_path
        FROM (
          SELECT n.*, n.key AS s3_key, CAST(coalesce(max_version, 0) + 1 AS BIGINT) AS version
          FROM named n LEFT JOIN max_versions m ON m.s3_key = n.key
          WHERE n.file_name LIKE '%.csv' AND n.last_modified IS NOT NULL)""",
    "profiled": f"""
        SELECT *, {_INGESTION} AS ingestion_id, sha256(text) AS file_hash,
          length(text) - length(replace(text, chr(10), '')) AS row_count
        FROM resolved""",
    "held": """
        SELECT storage_path,
          max(CASE WHEN file_name = 'src5.csv' THEN '' ELSE s3_key END) AS s3_key
        FROM resolved WHERE site_id = 9068 AND version = 1 GROUP BY storage_path""",
    "lifecycle": adapters.LIFECYCLE,
    "telemetry": adapters.TELEMETRY + " UNION ALL " + adapters.TELEMETRY.replace(
        "FROM events", "FROM events WHERE event_id % 29 = 0"
    ),
    "records": adapters.RECORDS,
    "failures": adapters.FAILURES,
    "bodies": adapters.WORK_ITEM_BODIES,
    "folders": "SELECT lang, source, text FROM documents",
}
_NEEDS = {
    "listing": (), "csv_listing": ("listing",), "tracking_base": ("listing",),
    "tracking_versions": ("listing",), "named": ("listing",),
    "changed": ("csv_listing", "tracking_base"), "max_versions": ("tracking_versions",),
    "resolved": ("named", "max_versions"), "profiled": ("resolved",), "held": ("resolved",),
    "lifecycle": (), "telemetry": (), "records": (), "failures": (), "bodies": ("listing",),
    "folders": (),
}


def _with(names: str, body: str, **more: str) -> str:
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in _NEEDS[name]:
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names.split():
        add(name)
    parts = [f"{n} AS ({_plain(_CTES[n])})" for n in ordered]
    parts += [f"{n} AS ({text})" for n, text in more.items()]
    return f"WITH {', '.join(parts)} {body}" if parts else body


def _fold_cte() -> dict[str, str]:
    """Lifecycle rows with their reset group."""
    return {
        "grouped": """
            SELECT *, count(*) FILTER (WHERE kind = 'queued')
              OVER (PARTITION BY s3_key, partition_key ORDER BY ts, seq) AS reset
            FROM lifecycle""",
    }


_FOLD = """
SELECT partition_key, sha256(s3_key) AS row_key,
  CASE WHEN q IS NOT NULL THEN s3_key END AS s3_key,
  CASE WHEN q IS NOT NULL THEN string_split(s3_key, '/')[-1] END AS file_name,
  'c' || (q_amount % 5) AS category, q_amount AS size, 'm' || q_amount AS last_modified,
  'e' || q AS enqueued_at, 'r' || q AS correlation_id, status, 'd' || done AS completed_at
FROM (
  SELECT partition_key, s3_key,
    last_value(kind) OVER w AS status,
    last_value(CASE WHEN kind = 'queued' THEN seq END IGNORE NULLS) OVER w AS q,
    last_value(CASE WHEN kind = 'queued' THEN amount END IGNORE NULLS) OVER w AS q_amount,
    last_value(CASE WHEN kind = 'completed' THEN seq END IGNORE NULLS) OVER w AS done,
    row_number() OVER (PARTITION BY partition_key, s3_key ORDER BY ts DESC, seq DESC) AS rn
  FROM grouped
  WINDOW w AS (PARTITION BY partition_key, s3_key, reset ORDER BY ts, seq)
) WHERE rn = 1
"""

_TRANSIENT = """CASE
  WHEN error_class IN ('CommitContentionError', 'ServiceRequestError', 'ConnectTimeout',
    'ServiceBusServerBusyError') THEN true
  WHEN error_class IN ('HttpResponseError', 'HTTPStatusError')
    THEN coalesce(http_status >= 500 OR http_status IN (408, 429), false)
  ELSE false END"""
_ERROR_TYPE = """CASE stage WHEN 'parse' THEN 'malformed_body' WHEN 'work_item' THEN 'validation_failure'
  WHEN 'metadata' THEN 'metadata_validation_failure'
  WHEN 'envelope' THEN 'envelope_validation_failure' ELSE 'dataset_failure' END"""
_ROUTED = f"""
  SELECT *, stage IN ('config', 'dead_letter_send') AS raised,
    stage IN ('parse', 'work_item') AS bad_message, {_TRANSIENT} AS transient,
    {_ERROR_TYPE} AS reason FROM failures"""

_RUN_LOG = """
  SELECT 'run-' || strftime(ts, '%Y-%m-%d') AS correlation_id, count(*) AS datasets_discovered,
    count(*) FILTER (WHERE event_type <> 'signup') AS datasets_downloaded,
    count(*) FILTER (WHERE event_type NOT IN ('signup', 'view')) AS datasets_stored,
    count(*) FILTER (WHERE event_type IN ('click', 'purchase')) AS datasets_emitted,
    count(*) FILTER (WHERE event_type IN ('error', 'signup')) AS datasets_failed,
    (epoch_us(max(ts)) - epoch_us(min(ts))) / 1000.0::DOUBLE AS duration_ms
  FROM events GROUP BY 1"""

_OUTCOMES = """
  SELECT CAST(s.site_id AS BIGINT) AS site_id,
    CASE WHEN s.site_id = 9999 THEN 'failed' WHEN coalesce(n, 0) = 0 THEN 'empty'
      WHEN coalesce(todo, 0) = 0 THEN 'unchanged' ELSE 'enqueued' END AS outcome,
    CAST(coalesce(n, 0) AS BIGINT) AS discovered, CAST(coalesce(dated, 0) AS BIGINT) AS enqueued
  FROM (VALUES (9068), (9069), (9070), (9071), (9999), (1234)) AS s(site_id)
  LEFT JOIN (SELECT site_id, count(*) AS n FROM csv_listing GROUP BY 1) l
    ON l.site_id = s.site_id
  LEFT JOIN (SELECT site_id, count(*) AS todo, count(last_modified) AS dated FROM changed
    GROUP BY 1) c ON c.site_id = s.site_id"""


def _violations(field: str) -> str:
    """Violations of a work-item body, root first, then members in schema order."""
    def kind(name: str) -> str:
        return f"json_type({field}, '$.{name}')"

    def text(name: str) -> str:
        return f"json_extract_string({field}, '$.{name}')"

    required = ["site_id", "s3_key", "file_name", "correlation_id", "enqueued_at"]
    known = required[:3] + ["category"] + required[3:] + ["last_modified"]
    parts = [f"CASE WHEN {kind(n)} IS NULL THEN '$:required' END" for n in required]
    names = ", ".join(f"'{n}'" for n in known)
    parts.append(
        f"CASE WHEN len(list_filter(json_keys({field}), lambda k: k NOT IN ({names}))) > 0 "
        "THEN '$:additionalProperties' END"
    )
    site = f"try_cast({text('site_id')} AS DOUBLE)"
    numeric = f"{kind('site_id')} IN ('UBIGINT', 'BIGINT', 'DOUBLE')"
    parts.append(
        f"CASE WHEN {kind('site_id')} IS NOT NULL AND NOT ({numeric} AND {site} = floor({site})) "
        "THEN '$.site_id:type' END"
    )
    parts.append(f"CASE WHEN {numeric} AND {site} < 1 THEN '$.site_id:minimum' END")
    for name in ("s3_key", "file_name", "category"):
        parts.append(f"CASE WHEN {kind(name)} <> 'VARCHAR' THEN '$.{name}:type' END")
        parts.append(
            f"CASE WHEN {kind(name)} = 'VARCHAR' AND {text(name)} = '' THEN '$.{name}:minLength' END"
        )
    for name, pattern in (("correlation_id", _UUID), ("enqueued_at", _STAMP),
                          ("last_modified", _STAMP)):
        parts.append(f"CASE WHEN {kind(name)} <> 'VARCHAR' THEN '$.{name}:type' END")
        parts.append(
            f"CASE WHEN {kind(name)} = 'VARCHAR' AND NOT "
            f"regexp_matches({text(name)}, '^({pattern})\\n?$') THEN '$.{name}:pattern' END"
        )
    parts.append(
        f"CASE WHEN {kind('last_modified')} = 'VARCHAR' AND {text('last_modified')} = '' "
        "THEN '$.last_modified:minLength' END"
    )
    return f"array_to_string(list_filter([{', '.join(parts)}], lambda x: x IS NOT NULL), ',')"


_CHECKED_BODIES = f"""
  SELECT *, CASE WHEN doc IS NULL THEN NULL ELSE {_violations('doc')} END AS violations
  FROM (SELECT doc_id, body, CASE WHEN json_valid(body) THEN
      CASE WHEN json_type(body) = 'OBJECT' THEN CAST(body AS JSON) END END AS doc FROM bodies)"""


def _record_violations() -> str:
    def kind(name: str) -> str:
        return f"json_type(doc, '$.{name}')"

    def text(name: str) -> str:
        return f"json_extract_string(doc, '$.{name}')"

    numbers = ("ac_power", "dc_power", "poa_irradiance", "ambient_temp", "module_temp",
               "wind_speed", "inverter_efficiency")
    parts = [f"CASE WHEN {kind(n)} IS NULL THEN '$:required' END" for n in ("SiteID", "measdatetime")]
    parts.append(f"CASE WHEN {kind('SiteID')} NOT IN ('UBIGINT', 'BIGINT') THEN '$.SiteID:type' END")
    parts.append(
        f"CASE WHEN {kind('SiteID')} IN ('UBIGINT', 'BIGINT') AND "
        f"CAST({text('SiteID')} AS BIGINT) < 1 THEN '$.SiteID:minimum' END"
    )
    parts.append(f"CASE WHEN {kind('measdatetime')} <> 'VARCHAR' THEN '$.measdatetime:type' END")
    parts.append(
        f"CASE WHEN {kind('measdatetime')} = 'VARCHAR' AND NOT regexp_matches({text('measdatetime')}, "
        r"'^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2})?') THEN '$.measdatetime:pattern' END"
    )
    parts += [
        f"CASE WHEN {kind(n)} NOT IN ('UBIGINT', 'BIGINT', 'DOUBLE') THEN '$.{n}:type' END"
        for n in numbers
    ]
    return f"list_filter([{', '.join(parts)}], lambda x: x IS NOT NULL)"


_CHECKED_RECORDS = f"""
  SELECT *, CASE WHEN doc IS NULL THEN ['$:type'] ELSE {_record_violations()} END AS violations
  FROM (SELECT event_id, payload,
    CASE WHEN json_valid(payload) THEN CAST(payload AS JSON) END AS doc FROM records)"""
_KEYED_RECORDS = """
  SELECT event_id, json_extract_string(doc, '$.SiteID') AS site,
    json_extract_string(doc, '$.measdatetime') AS moment,
    substr(json_extract_string(doc, '$.measdatetime'), 1, 10) AS partition_date,
    json_extract_string(doc, '$.SiteID') || '_' || json_extract_string(doc, '$.measdatetime')
      AS record_key
  FROM checked WHERE len(violations) = 0"""
_STORE = """
  SELECT DISTINCT substr(moment, 1, 10) AS partition_date, site || '_' || moment AS record_key,
    CASE WHEN substr(moment, 12, 2) IN ('00', '01') THEN 'completed' ELSE 'pending' END AS status
  FROM (SELECT json_extract_string(doc, '$.SiteID') AS site,
      json_extract_string(doc, '$.measdatetime') AS moment FROM checked WHERE doc IS NOT NULL)
  WHERE length(moment) = 19 AND substr(moment, 12, 2) IN ('00', '01', '02')"""
_RESERVED = """
  SELECT k.event_id, k.partition_date, k.record_key,
    CASE WHEN s.status = 'completed' THEN 'DUPLICATE'
      WHEN row_number() OVER (PARTITION BY k.partition_date, k.record_key ORDER BY k.event_id) > 1
        THEN 'DUPLICATE'
      WHEN s.status = 'pending' THEN 'RETRY_EMIT' ELSE 'NEW' END AS outcome
  FROM keyed k LEFT JOIN store s USING (partition_date, record_key)"""
_RECORD_CTES = {"checked": _CHECKED_RECORDS, "keyed": _KEYED_RECORDS, "store": _STORE,
                "reserved": _RESERVED}


def _profile(source: str, dataset: str, ts: str, cells: list[str], width: int, bad: str) -> str:
    nulls = " + ".join(f"CAST({c} IS NULL AS INT)" for c in cells)
    cols = ", ".join(cells)
    return f"""
    SELECT a.*, b.duplicate_rows, c.gap FROM (
      SELECT {dataset} AS dataset, count(*) AS row_count, min({ts}) AS first, max({ts}) AS last,
        CAST(sum({nulls}) AS BIGINT) AS nulls, count(*) FILTER (WHERE {bad}) AS bad
      FROM {source} GROUP BY 1) a
    JOIN (SELECT dataset, CAST(sum(n - 1) AS BIGINT) AS duplicate_rows FROM (
      SELECT {dataset} AS dataset, count(*) AS n FROM {source} GROUP BY {dataset}, {cols})
      GROUP BY 1) b USING (dataset)
    JOIN (SELECT dataset, coalesce(max(step) > {width * 1000000}, false) AS gap FROM (
      SELECT {dataset} AS dataset, epoch_us({ts}) - lag(epoch_us({ts})) OVER (
        PARTITION BY {dataset} ORDER BY {ts}) AS step FROM {source}) GROUP BY 1) c USING (dataset)"""


_LINEITEM = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
             "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def oracle_sql() -> dict[str, str]:
    sql: dict[str, str] = {}
    sql["flagship"] = _with(
        "profiled changed",
        f"""SELECT s3_key, version, storage_path, p.size AS file_size, file_hash, row_count,
          {_EVENT} AS event_id FROM profiled p SEMI JOIN changed USING (doc_id)""",
    )
    sql["listing_scan"] = _with(
        "listing",
        """SELECT site_id, key, CASE WHEN source = 'src6' THEN 0 ELSE size END AS size,
          CASE WHEN last_modified IS NULL AND lang <> 'de' THEN '' ELSE last_modified END
            AS last_modified
        FROM listing WHERE key LIKE '%.csv' AND site_id <> 9071""",
    )
    sql["listing_status"] = _with(
        "listing",
        """SELECT site_id, max((doc_id // 4) // 500) + CASE WHEN site_id = 9071 THEN 1 ELSE 0 END
            AS last_page,
          CASE WHEN site_id = 9071 THEN 'missing' ELSE 'ok' END AS listing_state,
          true AS listing_ok FROM listing GROUP BY site_id""",
    )
    sql["site_fan_in"] = _with(
        "listing",
        f"""SELECT l.site_id, l.key, '{PREFIX}/' || l.site_id || '_OEDI/data/' AS endpoint
        FROM (SELECT try_cast(trim(unnest(string_split('9068, 9070,,9071 ,9068', ','))) AS BIGINT)
          AS site_id) s JOIN listing l
          ON starts_with(l.key, '{PREFIX}/' || s.site_id || '_OEDI/data/')""",
    )
    sql["csv_scan"] = (
        "SELECT event_id, user_id, event_type, value, props, false AS corrupt FROM events"
    )
    sql["csv_map_scan"] = """SELECT event_id, value,
      CASE WHEN event_type NOT IN ('click', 'view') THEN user_id END AS user_id FROM events"""
    sql["category_extract"] = _with(
        "named",
        """SELECT key, site_id, file_name, category, dataset_id,
          CASE WHEN site_id = 9069 THEN 'given' ELSE category END AS category_used FROM named""",
    )
    folder = f"'source=pvdaq/dataset=' || dataset_id || '/ingestion_date={_DATE}/'"
    path = f"{folder} || dataset_id || '_v' || version || '.csv'"
    sql["bronze_paths"] = _with(
        "named",
        f"""SELECT key, {path} AS storage_path, {folder} || 'metadata.json' AS metadata_path,
          '{CONTEXT.bucket_url}/' || key AS source_url, {_url(path)} AS blob_url,
          CAST(site_id AS VARCHAR) AS partition_key, sha256(key) AS row_key,
          sha256(key) || '_v' || version AS versioned_row_key,
          left(last_modified, 10) AS modified_date,
          left(last_modified, 19) || '.000000+00:00' AS modified_iso
        FROM (SELECT *, doc_id % 3 + 1 AS version FROM named)""",
    )
    sql["event_ids"] = _with(
        "tracking_versions",
        """SELECT s3_key, version, event_id, ingestion_id,
          '00-' || substr(sha256(ingestion_id), 1, 32) || '-' || substr(sha256(ingestion_id), 33, 16)
            || '-01' AS traceparent FROM ids""",
        ids=f"SELECT s3_key, version, {_EVENT} AS event_id, {_INGESTION} AS ingestion_id "
            "FROM tracking_versions",
    )
    sql["incremental_detect"] = _with(
        "changed",
        """SELECT site_id, key, size, last_modified, last_modified IS NOT NULL AS enqueue
        FROM changed""",
    )
    sql["work_item_build"] = _with(
        "named",
        f"""SELECT key, '{{"site_id":' || site_id || ',"s3_key":"' || key || '","file_name":"' ||
            file_name || '","category":"' || category ||
            '","correlation_id":"{CONTEXT.correlation_id}","enqueued_at":"{_RUN}","last_modified":"' ||
            last_modified || '"}}' AS value, 'historical_work_item' AS subject
        FROM named WHERE file_name LIKE '%.csv' AND last_modified IS NOT NULL""",
    )
    sql["version_resolve"] = _with(
        "csv_listing max_versions",
        """SELECT site_id, key AS s3_key, CAST(coalesce(max_version, 0) + 1 AS BIGINT) AS version
        FROM csv_listing LEFT JOIN max_versions ON s3_key = key""",
    )
    sql["tracked_site_versions"] = _with(
        "tracking_versions",
        """SELECT partition_key, s3_key, count(*) AS recorded,
          count(*) FILTER (WHERE status = 'completed') AS completed,
          max(version) FILTER (WHERE status = 'completed') AS max_version
        FROM tracking_versions GROUP BY 1, 2""",
    )
    sql["identity_guard"] = _with(
        "resolved held",
        """SELECT r.s3_key, r.storage_path, path_owner, path_owner = r.s3_key AS admitted,
          CASE WHEN path_owner <> r.s3_key THEN 'path ' || r.storage_path || ' belongs to ' ||
            path_owner || ', refused for ' || r.s3_key END AS failure_reason
        FROM (SELECT r.*, coalesce(nullif(h.s3_key, ''),
            min(r.s3_key) OVER (PARTITION BY r.storage_path)) AS path_owner
          FROM resolved r LEFT JOIN held h ON h.storage_path = r.storage_path) r""",
    )
    sql["file_profile"] = _with(
        "listing",
        """SELECT key AS s3_key, size AS file_size, sha256(text) AS file_hash,
          length(text) - length(replace(text, chr(10), '')) AS row_count FROM listing""",
    )
    totals = """CAST(sum(strlen(text) + 1) AS BIGINT) AS file_size,
      CAST(sum(length(text) - length(replace(text, chr(10), '')) + 1) AS BIGINT) AS row_count"""
    sql["object_copy"] = (
        f"SELECT lang, source, {totals}, true AS byte_exact FROM documents GROUP BY 1, 2"
    )
    sql["line_counts"] = f"SELECT lang, source, {totals} FROM documents GROUP BY 1, 2"
    sql["work_item_validate"] = _with(
        "bodies",
        """SELECT doc_id, coalesce(violations = '', false) AS accepted,
          CASE WHEN doc IS NULL THEN 'malformed_body' WHEN violations <> ''
            THEN 'validation_failure' END AS error_type,
          coalesce(json_extract_string(doc, '$.correlation_id'), 'unknown') AS correlation_id,
          CASE WHEN doc IS NULL THEN left(body, 500) WHEN violations <> '' THEN body END
            AS file_reference,
          violations,
          CASE WHEN violations = '' THEN
            CAST(CAST(json_extract_string(doc, '$.site_id') AS DOUBLE) AS BIGINT) END AS site_id,
          CASE WHEN violations = '' THEN json_extract_string(doc, '$.category') END AS category
        FROM checked""",
        checked=_CHECKED_BODIES,
    )
    sql["work_item_dead_letters"] = _with(
        "bodies",
        """SELECT coalesce(json_extract_string(doc, '$.correlation_id'), 'unknown')
            AS correlation_id, error_type,
          CASE WHEN doc IS NULL THEN left(body, 500) ELSE body END AS file_reference,
          error_type AS subject
        FROM (SELECT *, CASE WHEN doc IS NULL THEN 'malformed_body' ELSE 'validation_failure' END
          AS error_type FROM checked WHERE doc IS NULL OR violations <> '')""",
        checked=_CHECKED_BODIES,
    )
    rerun = "CASE WHEN version > 1 THEN dataset_id || '_v' || (version - 1) END"
    sql["metadata_sidecar"] = _with(
        "profiled",
        f"""SELECT s3_key, metadata_path, 0 AS violations, 'pvdaq,solar' AS tags, 0 AS notes,
          dataset_id AS dataset_dataset_id, 'time_series' AS dataset_dataset_type,
          version AS dataset_version, 'unknown' AS dataset_schema_version,
          'pvdaq' AS source_source, 's3_public' AS source_source_type,
          '{PREFIX}/' || site_id || '_OEDI/data/' AS source_endpoint, 'NREL' AS source_provider,
          'us-east-1' AS source_region, '{_RUN}' AS ingestion_ingestion_time,
          ingestion_id AS ingestion_ingestion_id, '{CONTEXT.correlation_id}' AS ingestion_batch_id,
          '{CONTEXT.pipeline}' AS ingestion_pipeline,
          CASE WHEN version > 1 THEN 'rerun' ELSE 'scheduled' END AS ingestion_trigger_type,
          0 AS ingestion_retry_count, file_name AS ingestion_source_file_name,
          size AS ingestion_file_size_bytes, file_hash AS ingestion_checksum,
          47.2::DOUBLE AS ingestion_ingestion_latency_seconds, 'success' AS ingestion_status,
          CAST(NULL AS VARCHAR) AS event_time_event_time_start,
          300 AS event_time_expected_frequency_seconds,
          CAST(NULL AS BIGINT) AS event_time_expected_records,
          row_count AS data_profile_row_count, CAST(NULL AS DOUBLE) AS data_profile_null_percentage,
          CAST(NULL AS BOOLEAN) AS data_profile_schema_detected,
          CAST(NULL AS DOUBLE) AS quality_hint_basic_quality_score,
          CAST(NULL AS BOOLEAN) AS quality_hint_schema_valid,
          CASE WHEN version > 1 THEN version - 1 END AS lineage_parent_dataset_version,
          {rerun} AS lineage_rerun_of, CAST(NULL AS VARCHAR) AS lineage_related_incident_id
        FROM profiled""",
    )
    sql["sidecar_latest"] = _with(
        "profiled",
        """SELECT metadata_path, max(version) AS version, any_value(dataset_id) AS dataset_id,
          CASE WHEN max(version) > 1 THEN any_value(dataset_id) || '_v' || (max(version) - 1) END
            AS rerun_of, CAST(300 AS BIGINT) AS frequency
        FROM profiled GROUP BY metadata_path""",
    )
    sql["sidecar_files"] = sql["sidecar_latest"]
    sql["event_envelope"] = _with(
        "profiled",
        f"""SELECT s3_key, 0 AS violations, '1.0' AS specversion, '{EVENT_TYPE}' AS type,
          '{CONTEXT.event_source}' AS source, {_EVENT} AS id, '{_RUN}' AS time,
          'application/json' AS datacontenttype, '{CONTEXT.dataschema}' AS dataschema,
          '{CONTEXT.tenant_id}' AS tenant_id, 'PVDAQ' AS source_vendor, 'v1' AS schema_version,
          'unknown' AS mapping_version, '{CONTEXT.correlation_id}' AS correlation_id,
          '{_RUN}' AS ingestion_timestamp,
          '00-' || substr(sha256(ingestion_id), 1, 32) || '-' || substr(sha256(ingestion_id), 33, 16)
            || '-01' AS traceparent,
          site_id AS data_site_id, category AS data_category, 'csv' AS data_file_format,
          {_url('storage_path')} AS data_storage_path, version AS data_version,
          ingestion_id AS data_ingestion_id, '{CONTEXT.bucket_url}/' || s3_key AS data_source_url,
          size AS data_file_size, file_hash AS data_file_hash
        FROM profiled""",
    )
    sql["event_publish"] = _with(
        "profiled",
        f"""SELECT {_EVENT} AS key, version, file_hash,
          'application/cloudevents+json' AS content_type, '{EVENT_TYPE}' AS subject,
          'PVDAQ' AS source_vendor, 'v1' AS schema_version FROM profiled""",
    )
    sql["event_type_split"] = f"""SELECT event_id,
      CASE WHEN type = '{EVENT_TYPE}' THEN 'consume' ELSE 'dead_letter' END AS route
      FROM (SELECT event_id, CASE event_type WHEN 'click' THEN '{EVENT_TYPE}'
        WHEN 'view' THEN '{RETIRED_EVENT_TYPES[2]}' WHEN 'signup' THEN '{RETIRED_EVENT_TYPES[0]}'
        WHEN 'error' THEN '{EVENT_TYPE}' || chr(10) END AS type FROM events)"""
    sql["tracking_fold"] = _with("lifecycle", _FOLD, **_fold_cte())
    sql["tracking_upsert"] = sql["tracking_fold"]
    sql["tracking_stream"] = sql["tracking_fold"]
    done = ["storage_path", "file_hash", "ingestion_id", "source_url", "ingestion_time",
            "metadata_path"]
    done_columns = ", ".join(f"'{n}-' || done AS {n}" for n in done)
    sql["tracking_fold_versions"] = _with(
        "lifecycle",
        f"""SELECT partition_key, sha256(s3_key) || '_v' || version AS row_key, s3_key,
          CASE WHEN named THEN string_split(s3_key, '/')[-1] END AS file_name, version, status,
          'c' || (amount % 5) AS category, 'd' || done AS completed_at, {done_columns},
          amount AS row_count
        FROM (SELECT partition_key, s3_key, version, arg_max(kind, (ts, seq)) AS status,
            bool_or(kind <> 'failed') AS named,
            arg_max(seq, (ts, seq)) FILTER (WHERE kind = 'completed') AS done,
            arg_max(amount, (ts, seq)) FILTER (WHERE kind = 'completed') AS amount
          FROM lifecycle WHERE kind <> 'queued' GROUP BY 1, 2, 3)""",
    )
    sql["failure_classify"] = _with(
        "failures",
        f"""SELECT event_id, error_class, http_status, CASE WHEN wrapped THEN 2 ELSE 1 END
          AS chain_length, {_TRANSIENT} AS transient FROM failures""",
    )
    sql["failure_route"] = _with(
        "failures",
        """SELECT event_id, stage, transient, CASE WHEN NOT raised THEN reason END AS error_type,
          NOT raised AS dead_letter, raised OR (transient AND NOT bad_message) AS redeliver,
          identified AND stage <> 'config' AND NOT bad_message AS mark_failed FROM routed""",
        routed=_ROUTED,
    )
    sql["dead_letter_report"] = _with(
        "failures",
        """SELECT correlation_id, file_reference, error_type, min(error_class) AS failure_reason,
          count(*) AS deliveries
        FROM (SELECT CASE WHEN identified THEN s3_key ELSE 'unknown' END AS correlation_id,
            CASE stage WHEN 'parse' THEN 'preview' WHEN 'work_item' THEN 'body'
              ELSE CASE WHEN identified THEN s3_key ELSE 'unknown' END END AS file_reference,
            reason AS error_type, error_class FROM routed WHERE NOT raised)
        GROUP BY 1, 2, 3""",
        routed=_ROUTED,
    )
    sql["run_metrics"] = f"SELECT 'PVDAQ-historical-worker' AS source, * FROM ({_RUN_LOG})"
    sql["slow_runs"] = (
        f"SELECT correlation_id, duration_ms FROM ({_RUN_LOG}) WHERE duration_ms > 86200000.0"
    )
    sql["site_outcomes"] = _with("changed", _OUTCOMES)
    sql["failed_sites"] = _with(
        "changed",
        f"SELECT string_agg(CAST(site_id AS VARCHAR), ',') AS sites FROM ({_OUTCOMES}) "
        "WHERE outcome = 'failed'",
    )
    sql["dispatch_run"] = _with(
        "changed named",
        """SELECT n.key AS s3_key,
          CASE WHEN n.last_modified IS NULL THEN 'skipped' ELSE 'enqueued' END AS fate,
          CASE WHEN n.last_modified IS NOT NULL THEN n.category END AS category, n.last_modified
        FROM named n SEMI JOIN changed USING (doc_id)""",
    )
    sql["dispatch_metrics"] = _with(
        "changed",
        f"""SELECT 'PVDAQ-historical-dispatcher' AS source,
          CAST(sum(discovered) AS BIGINT) AS datasets_discovered,
          CAST(0 AS BIGINT) AS datasets_downloaded, CAST(0 AS BIGINT) AS datasets_stored,
          CAST(0 AS BIGINT) AS datasets_emitted, CAST(0 AS BIGINT) AS datasets_failed,
          {CONTEXT.elapsed_seconds * 1000}::DOUBLE AS duration_ms,
          '{CONTEXT.correlation_id}' AS correlation_id FROM ({_OUTCOMES})""",
    )
    cells = ["SiteID", "measdatetime", "category", "ac_power"]
    share = "(CAST(nulls AS DOUBLE) / (CAST(row_count AS DOUBLE) * 4.0::DOUBLE))"
    rows = "CAST(row_count AS DOUBLE)"
    start, end = _iso("first"), _iso("last")
    sql["dataset_profile"] = _with(
        "telemetry",
        f"""SELECT dataset, row_count, {start} AS event_time_start, {end} AS event_time_end,
          300 AS expected_frequency_seconds,
          (epoch_us(last) - epoch_us(first)) // 300000000 + 1 AS expected_records,
          {share} AS null_percentage, duplicate_rows, {start} AS min_timestamp,
          {end} AS max_timestamp, true AS schema_detected, bad AS corrupted_rows,
          (1.0::DOUBLE - {share}) * (1.0::DOUBLE - CAST(duplicate_rows AS DOUBLE) / {rows}) *
            (1.0::DOUBLE - CAST(bad AS DOUBLE) / {rows}) AS basic_quality_score,
          bad = 0 AS schema_valid, gap AS time_continuity_suspected_gap,
          array_to_string(list_filter([
            CASE WHEN row_count < 100 THEN 'row count unexpectedly small' END,
            CASE WHEN duplicate_rows > 0 THEN 'exact duplicate rows present' END],
            lambda x: x IS NOT NULL), ';') AS notes
        FROM profile""",
        profile=_profile("telemetry", "category", "measdatetime", cells, 300, "bad"),
    )
    sql["lineitem_profile"] = f"""
        SELECT dataset, row_count, {start} AS event_time_start, {end} AS event_time_end,
          (epoch_us(last) - epoch_us(first)) // 86400000000 + 1 AS expected_records,
          CAST(nulls AS DOUBLE) / (CAST(row_count AS DOUBLE) * 11.0::DOUBLE) AS null_percentage,
          duplicate_rows, gap AS time_continuity_suspected_gap
        FROM ({_profile('lineitem', 'l_returnflag', 'l_shipdate', _LINEITEM, 86400, 'false')})"""
    sql["record_validate"] = _with(
        "records",
        """SELECT event_id, len(violations) = 0 AS valid,
          array_to_string(violations, ',') AS violations FROM checked""",
        checked=_CHECKED_RECORDS,
    )
    sql["record_dead_letters"] = _with(
        "records",
        f"""SELECT payload AS original_payload, 'validation_failure' AS error_type,
          CAST(len(violations) AS INT) AS errors, true AS explained, '{CONTEXT.correlation_id}' AS correlation_id,
          CASE WHEN json_type(doc, '$.SiteID') IN ('UBIGINT', 'BIGINT')
            THEN CAST(json_extract_string(doc, '$.SiteID') AS BIGINT) END AS site_id,
          '{_RUN}' AS timestamp, 'PVDAQ' AS source_vendor, 'v1' AS schema_version
        FROM checked WHERE len(violations) > 0""",
        checked=_CHECKED_RECORDS,
    )
    sql["record_reserve"] = _with(
        "records", "SELECT * FROM reserved WHERE outcome <> 'DUPLICATE'", **_RECORD_CTES
    )
    sql["record_outcomes"] = _with(
        "telemetry",
        """SELECT event_id, partition_date, record_key,
          CASE WHEN rank = 2 THEN 'DUPLICATE'
            WHEN row_number() OVER (PARTITION BY record_key ORDER BY event_id) > 1 THEN 'DUPLICATE'
            WHEN rank = 1 THEN 'RETRY_EMIT' ELSE 'NEW' END AS outcome
        FROM (SELECT DISTINCT event_id, partition_date, record_key FROM keyed)
        LEFT JOIN (SELECT record_key, max(CASE category WHEN 'click' THEN 2 ELSE 1 END) AS rank
          FROM keyed WHERE category IN ('click', 'view') GROUP BY 1) USING (record_key)""",
        keyed="""SELECT event_id, category, strftime(measdatetime, '%Y-%m-%d') AS partition_date,
          SiteID || '_' || strftime(measdatetime, '%Y-%m-%dT%H') AS record_key FROM telemetry""",
    )
    sql["history_versions"] = sql["tracking_fold_versions"]
    sql["identity_guard_index"] = sql["identity_guard"]
    sql["record_store_days"] = _with(
        "telemetry",
        """SELECT partition_date, status, count(*) AS keys FROM (
          SELECT strftime(measdatetime, '%Y-%m-%d') AS partition_date, SiteID, measdatetime,
            CASE WHEN bool_or(category = 'click') THEN 'completed' ELSE 'pending' END AS status
          FROM telemetry GROUP BY ALL) WHERE partition_date >= '2024-01-13' GROUP BY ALL""",
    )
    sql["folder_listing"] = """
        SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN 0 ELSE octet_length(encode(coalesce(text, ''))) END::BIGINT AS size, true AS dated FROM documents"""
    sql["idempotency_purge"] = _with(
        "telemetry",
        """SELECT strftime(measdatetime, '%Y-%m-%d') AS partition_date, count(*) AS rows
        FROM telemetry WHERE measdatetime >= TIMESTAMP '2024-01-13' GROUP BY 1""",
    )
    sql["window_key_filter"] = _with(
        "listing",
        """SELECT key, site_id, w AS date_window FROM windowed
        WHERE (site_id, w) NOT IN (SELECT site_id, w FROM windowed WHERE lang = 'de')""",
        windowed="SELECT *, coalesce(left(last_modified, 10), 'none') AS w FROM listing",
    )
    sql["lookback_filter"] = _with(
        "telemetry",
        """SELECT category, count(*) AS rows FROM telemetry
        WHERE measdatetime >= TIMESTAMP '2024-01-28' GROUP BY 1""",
    )
    sql["invocation_stats"] = _with(
        "records",
        f"""SELECT '{CONTEXT.correlation_id}' AS correlation_id,
          (SELECT count(*) FROM checked) AS number_of_records_retrieved,
          (SELECT count(*) FROM keyed) AS number_valid,
          (SELECT count(*) FROM checked WHERE len(violations) > 0) AS number_invalid,
          (SELECT count(*) FROM reserved WHERE outcome <> 'DUPLICATE') AS number_emitted""",
        **_RECORD_CTES,
    )
    sql["validation_alerts"] = _with(
        "telemetry",
        """SELECT strftime(time_bucket(INTERVAL 6 HOURS, measdatetime), '%Y-%m-%d %H:%M')
            AS window_start, count(*) AS records,
          count(*) FILTER (WHERE ac_power IS NULL OR bad) AS invalid,
          CAST(count(*) FILTER (WHERE ac_power IS NULL OR bad) AS DOUBLE) /
            CAST(count(*) AS DOUBLE) AS ratio,
          CAST(count(*) FILTER (WHERE ac_power IS NULL OR bad) AS DOUBLE) /
            CAST(count(*) AS DOUBLE) > 0.10::DOUBLE AS alert
        FROM telemetry GROUP BY time_bucket(INTERVAL 6 HOURS, measdatetime)""",
    )
    sql["validation_alerts_stream"] = sql["validation_alerts"]
    sql["mapping_sentinel"] = """SELECT strftime(ts, '%Y-%m-%d') AS day,
      count(*) FILTER (WHERE event_type = 'view') AS unknown_mapping_versions,
      count(*) FILTER (WHERE event_type = 'error') AS illegal FROM events GROUP BY 1"""
    sql["api_flatten"] = """SELECT event_id // 100 AS doc, event_id, event_type,
      CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events"""
    sql["incident_link"] = _with(
        "resolved",
        """SELECT s3_key, r.dataset_id, version,
          CASE WHEN version = 2 THEN incident END AS related_incident_id
        FROM resolved r LEFT JOIN (SELECT dataset_id, min('INC-' || doc_id) AS incident FROM named
          GROUP BY 1) i USING (dataset_id)""",
    )
    sql["event_dedupe_stream"] = "SELECT event_id, event_type AS category FROM events"
    sql["ingest_run"] = _with(
        "changed named",
        f"""SELECT s3_key, category, last_modified,
          CASE WHEN owner = s3_key THEN 'completed' ELSE 'failed' END AS status,
          CASE WHEN owner = s3_key THEN '{_RUN}' END AS completed_at,
          CASE WHEN owner <> s3_key THEN 'dataset_failure' END AS error_type
        FROM (SELECT key AS s3_key, category, last_modified,
            min(key) OVER (PARTITION BY dataset_id) AS owner
          FROM named SEMI JOIN changed USING (doc_id)
          WHERE last_modified IS NOT NULL)""",
    )
    return sql
