"""The driver's tables in the shapes of the ingestion data model.

The SQL here is plain enough for Spark and DuckDB alike; ``<bytes>``,
``<sha256>`` and ``<versions>`` stand for the functions that differ.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from bronzeflow.context import RunContext
from bronzeflow.functions import keys
from bronzeflow.sources.listing import PAGE_SCHEMA

PREFIX = "pvdaq/2023-solar-data-prize"
CONTEXT = RunContext(
    bucket_url="https://objects.example.org",
    account_url="https://bronze.example.org",
    run_ts="2024-07-01T06:00:00+00:00",
    correlation_id="c0ffee00-0000-4000-8000-000000000001",
    site_ids=(9068, 9069, 9070, 9071),
    elapsed_seconds=47.25,
)

LISTING = f"""
SELECT doc_id, site_id, file_name, size, last_modified, lang, source, n_chars, text,
  '{PREFIX}/' || site_id || '_OEDI/data/' || doc_id || '/' || file_name AS key
FROM (
  SELECT doc_id, site_id, lang, source, n_chars, text, <bytes> AS size,
    CASE WHEN source = 'src4' THEN site_id || '_' || lang || '.txt'
         WHEN source IN ('src0', 'src1') THEN site_id || '_' || lang || '_data_2024-01-01_2024-06-30.csv'
         WHEN source = 'src5' THEN source || '.csv'
         WHEN source = 'src7' THEN site_id || '_' || lang || ' ' || doc_id || '_data.csv'
         ELSE site_id || '_' || lang || doc_id || '_data.csv' END AS file_name,
    CASE WHEN source = 'src3' THEN NULL
         ELSE '2024-01-' || lpad(CAST(1 + doc_id % 28 AS VARCHAR(2)), 2, '0') || 'T12:00:00Z'
    END AS last_modified
  FROM (SELECT 9068 + doc_id % 4 AS site_id, documents.* FROM documents)
)
"""

CSV_LISTING = "SELECT * FROM listing WHERE file_name LIKE '%.csv'"

TRACKING_BASE = """
SELECT CAST(site_id AS VARCHAR(9)) AS partition_key, <sha256> AS row_key, key AS s3_key,
  n_chars AS size,
  CASE WHEN lang = 'fr' THEN '2023-12-31T00:00:00Z' ELSE last_modified END AS last_modified,
  CASE WHEN quality = 1 THEN 'completed' WHEN toxic = 1 THEN 'failed' ELSE 'queued' END AS status
FROM listing JOIN labels USING (doc_id)
"""

TRACKING_VERSIONS = """
SELECT doc_id, site_id, partition_key, s3_key, CAST(version AS INT) AS version,
  CASE WHEN toxic = 1 AND version = newest THEN 'failed' ELSE 'completed' END AS status
FROM (
  SELECT doc_id, site_id, CAST(site_id AS VARCHAR(9)) AS partition_key, key AS s3_key, toxic,
    1 + quality + toxic AS newest, <versions> AS version
  FROM listing JOIN labels USING (doc_id)
)
"""

LIFECYCLE = """
SELECT event_id AS seq, ts, 's' || (user_id % 4) AS partition_key, 'k/' || user_id AS s3_key,
  CAST(1 + event_id % 3 AS INT) AS version,
  CASE event_type WHEN 'signup' THEN 'queued' WHEN 'purchase' THEN 'queued'
    WHEN 'view' THEN 'processing' WHEN 'click' THEN 'completed' ELSE 'failed' END AS kind,
  CAST(floor(value) AS BIGINT) AS amount
FROM events
"""

TELEMETRY = """
SELECT event_id, user_id + 1 AS SiteID, ts AS measdatetime, event_type AS category,
  CASE WHEN event_id % 13 = 0 THEN NULL ELSE value END AS ac_power, event_id % 31 = 0 AS bad
FROM events
"""

RECORDS = """
SELECT event_id,
  CASE event_id % 8
    WHEN 0 THEN '{"SiteID":' || (user_id + 1) || ',"ac_power":' || CAST(floor(value) AS BIGINT) || '}'
    WHEN 1 THEN '{"SiteID":"' || (user_id + 1) || '","measdatetime":"2024-01-02 00:00"}'
    WHEN 2 THEN '{"SiteID":0,"measdatetime":"yesterday","wind_speed":"fast"}'
    WHEN 3 THEN '{bad'
    ELSE '{"SiteID":' || (user_id + 1) || ',"measdatetime":"2024-01-' ||
      lpad(CAST(1 + event_id % 9 AS VARCHAR(2)), 2, '0') || 'T0' || (event_id % 7) ||
      ':00:00","ac_power":' || CAST(floor(value) AS BIGINT) || ',"vendor_note":"x"}'
  END AS payload
FROM events
"""

FAILURES = """
SELECT event_id, ts,
  CASE event_id % 9 WHEN 0 THEN 'HttpResponseError' WHEN 1 THEN 'HTTPStatusError'
    WHEN 2 THEN 'ServiceRequestError' WHEN 3 THEN 'ServiceBusServerBusyError'
    WHEN 4 THEN 'MessagingEntityNotFoundError' WHEN 5 THEN 'ServiceBusAuthenticationError'
    WHEN 6 THEN 'ConnectTimeout' WHEN 7 THEN 'CommitContentionError' ELSE 'ValueError'
  END AS error_class,
  CASE event_id % 6 WHEN 0 THEN 400 WHEN 1 THEN 404 WHEN 2 THEN 408 WHEN 3 THEN 429
    WHEN 4 THEN 500 ELSE NULL END AS http_status,
  event_type = 'error' AS wrapped,
  CASE event_type WHEN 'click' THEN 'parse' WHEN 'view' THEN 'work_item'
    WHEN 'signup' THEN 'metadata' WHEN 'purchase' THEN 'store'
    ELSE CASE WHEN user_id % 3 = 0 THEN 'config' WHEN user_id % 3 = 1 THEN 'envelope'
      ELSE 'dead_letter_send' END
  END AS stage,
  value >= 10 AS identified, 'k' || user_id AS s3_key
FROM events
"""

WORK_ITEM_BODIES = """
SELECT doc_id,
  CASE doc_id % 12
    WHEN 0 THEN '{bad'
    WHEN 1 THEN '[' || item || ']'
    WHEN 2 THEN replace(item, '"site_id":' || site_id, '"site_id":"' || site_id || '"')
    WHEN 3 THEN replace(item, '"correlation_id":', '"correlation":')
    WHEN 4 THEN replace(item, 'c0ffee', 'C0FFEE')
    WHEN 5 THEN replace(item, '{', '{"extra":1,')
    WHEN 6 THEN replace(item, '2024-07-01T06:00:00Z', '2024-07-01')
    WHEN 7 THEN replace(item, '"site_id":' || site_id, '"site_id":0')
    WHEN 8 THEN replace(item, '"enqueued_at"', '"last_modified":"","enqueued_at"')
    WHEN 9 THEN replace(item, '"site_id":' || site_id, '"site_id":' || site_id || '.0')
    WHEN 10 THEN item
    ELSE replace(item, '"enqueued_at"', '"last_modified":"2024-01-01T00:00:00+00:00","enqueued_at"')
  END AS body
FROM (
  SELECT doc_id, site_id,
    '{"site_id":' || site_id || ',"s3_key":"' || key || '","file_name":"' || file_name ||
    '","category":"' || lang || '","correlation_id":"c0ffee00-0000-4000-8000-' ||
    lpad(CAST(doc_id AS VARCHAR(12)), 12, '0') || '","enqueued_at":"2024-07-01T06:00:00Z"}' AS item
  FROM listing
)
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sql(spark: SparkSession, text: str, **tables: DataFrame) -> DataFrame:
    """Run SQL over DataFrames given by the name the text uses for them."""
    text = text.replace("<bytes>", "CAST(octet_length(text) AS BIGINT)")
    text = text.replace("<versions>", "explode(sequence(1, 1 + quality + toxic))")
    text = text.replace("<sha256>", "sha2(key, 256)").replace("{", "{{").replace("}", "}}")
    for name in tables:
        text = text.replace(f"FROM {name}", f"FROM {{{name}}} AS {name}")
        text = text.replace(f"JOIN {name}", f"JOIN {{{name}}} AS {name}")
    return spark.sql(text, **tables)


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, LISTING, documents=table(spark, sf_dir, "documents"))


def csv_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listing(spark, sf_dir).filter(F.col("file_name").endswith(".csv"))


def tracking_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(
        spark, TRACKING_BASE, listing=listing(spark, sf_dir), labels=table(spark, sf_dir, "labels")
    )


def tracking_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(
        spark, TRACKING_VERSIONS, listing=listing(spark, sf_dir),
        labels=table(spark, sf_dir, "labels"),
    )


def from_events(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    return _sql(spark, text, events=table(spark, sf_dir, "events"))


def work_item_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    bodies = _sql(spark, WORK_ITEM_BODIES, listing=listing(spark, sf_dir))
    return bodies.withColumn("body", F.encode("body", "UTF-8"))


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measurements with every 29th one twice."""
    copies = F.when(F.col("event_id") % 29 == 0, F.array(F.lit(1), F.lit(2))).otherwise(
        F.array(F.lit(1))
    )
    rows = from_events(spark, sf_dir, TELEMETRY)
    return rows.withColumn("copy", F.explode(copies)).drop("copy")


def lifecycle_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lifecycle events whose columns are set the way each kind sets them."""
    raw = from_events(spark, sf_dir, LIFECYCLE)
    kind, amount = F.col("kind"), F.col("amount")
    queued, completed = kind == "queued", kind == "completed"
    return raw.select(
        "seq", F.col("ts").cast("timestamp").alias("ts"), "partition_key", "s3_key", "version",
        "kind",
        F.expr(keys.row_key("s3_key")).alias("row_key"),
        F.when(queued, F.expr(keys.basename("s3_key"))).alias("file_name"),
        F.when(queued | completed, F.concat(F.lit("c"), amount % 5)).alias("category"),
        F.when(queued, amount).alias("size"),
        F.when(queued, F.concat(F.lit("m"), amount)).alias("last_modified"),
        F.when(queued, F.concat(F.lit("e"), "seq")).alias("enqueued_at"),
        F.when(completed, F.concat(F.lit("d"), "seq")).alias("completed_at"),
        F.when(queued, F.concat(F.lit("r"), "seq")).alias("correlation_id"),
        *[
            F.when(completed, F.concat(F.lit(f"{name}-"), "seq")).alias(name)
            for name in ("storage_path", "file_hash", "ingestion_id", "source_url",
                         "ingestion_time", "metadata_path")
        ],
        F.when(completed, amount).alias("row_count"),
        F.lit(None).cast("string").alias("status"),
    )


def contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(s3_key, content) of every object."""
    return listing(spark, sf_dir).select(
        F.col("key").alias("s3_key"), F.encode("text", "UTF-8").alias("content")
    )


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing pages of at most 500 objects; the last site ends in a 404 page."""
    def element(name: str, value):
        return F.concat(F.lit(f"<{name}>"), value, F.lit(f"</{name}>"))

    files = listing(spark, sf_dir)
    entry = F.concat(
        F.lit("<Contents>"),
        element("Key", F.replace(F.col("key"), F.lit("&"), F.lit("&amp;"))),
        F.when(F.col("source") == "src6", F.lit("")).otherwise(
            element("Size", F.col("size").cast("string"))
        ),
        F.when(F.col("last_modified").isNotNull(), element("LastModified", F.col("last_modified")))
        .when(F.col("lang") == "de", F.lit("<LastModified/>"))
        .otherwise(F.lit("")),
        F.lit("</Contents>"),
    )
    page_no = F.expr("(doc_id div 4) div 500")  # four sites, so at most 500 objects a page
    bodies = (
        files.select("site_id", page_no.alias("page_no"), entry.alias("entry"))
        .groupBy("site_id", "page_no")
        .agg(F.concat_ws("", F.collect_list("entry")).alias("entries"))
    )
    last = files.groupBy("site_id").agg(F.max(page_no).alias("last_no"))
    missing = F.col("site_id") == 9071
    goes_on = (F.col("page_no") < F.col("last_no")) | missing
    pages = bodies.join(last, "site_id").select(
        "site_id",
        "page_no",
        F.lit(200).alias("http_status"),
        F.concat(
            F.lit('<ListBucketResult xmlns="http://s3.amazonaws.com/doc/2006-03-01/">'),
            element("IsTruncated", F.when(goes_on, "true").otherwise("false")),
            F.when(goes_on, F.lit("<NextContinuationToken>t</NextContinuationToken>")).otherwise(""),
            F.col("entries"),
            F.lit("</ListBucketResult>"),
        ).alias("body"),
    )
    gone = last.filter(missing).select(
        "site_id", (F.col("last_no") + 1).alias("page_no"), F.lit(404).alias("http_status"),
        F.lit("").alias("body"),
    )
    return pages.unionByName(gone).to(StructType.fromDDL(PAGE_SCHEMA))
