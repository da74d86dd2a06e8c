"""Object listings: pages of XML to one row per source file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bronzeflow.functions import keys
from bronzeflow.operators.once import compute_once
from bronzeflow.operators.skew import skew_join
from bronzeflow.sources.folders import list_folder  # noqa: F401

PAGE_SCHEMA = "site_id bigint, page_no bigint, http_status int, body string"
_XML = (
    "Contents ARRAY<STRUCT<Key STRING, Size STRING, LastModified STRING>>, "
    "IsTruncated STRING, NextContinuationToken STRING, _corrupt_record STRING"
)


def sites_from_text(spark: SparkSession, raw: str) -> DataFrame:
    """Site ids of a comma list; ``rejected`` keeps what is not an integer."""
    part = F.explode(F.split(F.lit(raw), ",")).alias("part")
    return (
        spark.range(1)
        .select(part)
        .select(F.trim("part").alias("part"))
        .filter(F.col("part") != "")
        .select(
            F.expr("try_cast(part AS bigint)").alias("site_id"),
            F.when(F.expr("try_cast(part AS bigint)").isNull(), F.col("part")).alias("rejected"),
        )
    )


def _parsed(pages: DataFrame) -> DataFrame:
    readable = F.when(F.col("http_status") < 400, F.col("body"))
    return compute_once(pages, "page", F.from_xml(readable, _XML)).drop("body")


def site_status(pages: DataFrame) -> DataFrame:
    """Per site: the last page a client would fetch and how the listing ended.

    A client follows continuation tokens while pages say they are truncated,
    so a page that is final, unreadable, or truncated without a token ends the
    listing; later pages are never seen. ``incomplete`` marks the last case.
    """
    truncated = F.col("page.IsTruncated") == "true"
    token = F.coalesce(F.col("page.NextContinuationToken"), F.lit("")) != ""
    goes_on = F.coalesce(truncated & token, F.lit(False))
    state = (
        F.when(F.col("http_status") == 404, "missing")
        .when(
            (F.col("http_status") >= 400)
            | F.col("page").isNull()
            | F.col("page._corrupt_record").isNotNull(),
            "failed",
        )
        .when(F.coalesce(truncated, F.lit(False)) & ~token, "incomplete")
        .otherwise("ok")
    )
    ending = F.when(~goes_on, F.struct("page_no", state.alias("state")))
    return (
        _parsed(pages)
        .groupBy("site_id")
        .agg(F.min(ending).alias("_end"), F.max("page_no").alias("_last_seen"))
        .select(
            "site_id",
            F.coalesce("_end.page_no", "_last_seen").alias("last_page"),
            F.coalesce("_end.state", F.lit("incomplete")).alias("listing_state"),
        )
        .withColumn("listing_ok", F.col("listing_state") != "failed")
    )


def list_files(pages: DataFrame, status: DataFrame | None = None) -> DataFrame:
    """(site_id, key, size, last_modified, size_text) of the CSV objects of listing pages.

    A missing or failed site yields nothing, pages already read included. A
    size that is not a number gives null; ``rejected_sizes`` finds those rows.
    """
    reached = (status if status is not None else site_status(pages)).filter(
        F.col("listing_state").isin("ok", "incomplete")
    )
    entry = F.explode("page.Contents").alias("entry")
    size_text = F.coalesce(F.col("entry.Size"), F.lit(""))
    modified: Column = F.when(F.col("entry.LastModified").isNull(), "").when(
        F.col("entry.LastModified") != "", F.col("entry.LastModified")
    )
    files = (
        _parsed(pages)
        .select("site_id", "page_no", entry)
        .filter(F.col("entry.Key").endswith(".csv"))
        .select(
            "site_id",
            "page_no",
            F.col("entry.Key").alias("key"),
            F.when(size_text == "", F.lit(0).cast("bigint"))
            .otherwise(size_text.try_cast("bigint"))
            .alias("size"),
            modified.alias("last_modified"),
            size_text.alias("size_text"),
        )
    )
    joined = skew_join(
        files, reached.select("site_id", "last_page"), on=["site_id"], how="inner", spread=["key"]
    )
    return joined.filter(F.col("page_no") <= F.col("last_page")).drop("page_no", "last_page")


def split_sizes(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(files with a usable size, files whose size was not a number)."""
    return (
        files.filter(F.col("size").isNotNull()).drop("size_text"),
        files.filter(F.col("size").isNull()),
    )


def fan_in(listing: DataFrame, sites: DataFrame, prefix: str) -> DataFrame:
    """Files below each configured site's data folder; a repeated site repeats its files.

    The site comes out of the key itself, so this is an equi-join on a number
    and not a prefix comparison of every file with every site.
    """
    lead = F.lit(prefix.rstrip("/") + "/")
    rest = F.substr(F.col("key"), F.length(lead) + 1)
    found = F.regexp_extract(rest, r"^([0-9]+)_OEDI/data/", 1)
    placed = listing.drop("site_id").withColumn(
        "site_id", F.when(F.startswith(F.col("key"), lead), found.try_cast("bigint"))
    )
    placed = placed.filter(F.startswith(F.col("key"), F.expr(keys.source_endpoint(prefix, "site_id"))))
    return skew_join(
        placed, sites.select("site_id"), on=["site_id"], how="inner", spread=["key"]
    )
