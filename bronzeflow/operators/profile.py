"""Byte-level profile of files and row-level profile of datasets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# buckets of one expected interval per window partition of the gap check
_BUCKETS_PER_SPAN = 4096
# bits of the map of repeated fingerprints: 16 MiB
FINGERPRINT_BITS = 1 << 27


def newline_count(content: Column | str) -> Column:
    """Number of newline bytes: the header counts, an unterminated last line does not."""
    raw = F.col(content) if isinstance(content, str) else content
    # 0x0A never occurs inside a multi-byte UTF-8 character, so latin-1 keeps bytes apart
    text = F.decode(raw, "ISO-8859-1")
    return (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))).cast("bigint")


def profile_content(files: DataFrame, content: str = "content") -> DataFrame:
    """Add file_size, file_hash and row_count of a binary column; no shuffle."""
    return files.select(
        *files.columns,
        F.octet_length(content).cast("bigint").alias("file_size"),
        F.sha2(content, 256).alias("file_hash"),
        newline_count(content).alias("row_count"),
    )


def profile_dataset(
    rows: DataFrame,
    dataset: str,
    ts: str,
    columns: list[str],
    frequency_seconds: int = 300,
    corrupt: str | None = None,
    schema_valid: str | None = None,
    small_rows: int = 0,
) -> DataFrame:
    """One profile row per dataset; ``columns`` are the data cells, ``ts`` one of them.

    Rows are added up in buckets one interval wide before anything is shuffled;
    repeated ones are counted by ``repeated_rows``. The gap check compares the
    first and last timestamp of buckets: a gap above the interval never lies
    inside one. Buckets are compared within spans, then spans within the
    dataset, so no window holds a dataset's rows.
    """
    group = [F.col(dataset).alias("dataset")] + [
        F.col(c).alias(f"c{i}") for i, c in enumerate(columns)
    ]
    cells = [f"c{i}" for i in range(len(columns))]
    bad = F.coalesce(F.col(corrupt), F.lit(False)) if corrupt else F.lit(False)
    valid = F.col(schema_valid) if schema_valid else F.lit(None).cast("boolean")
    plain = rows.select(*group, bad.alias("bad"), valid.alias("valid"))
    nulls = sum((F.col(c).isNull().cast("int") for c in cells), F.lit(0))
    micros = F.unix_micros(F.col(f"c{columns.index(ts)}").cast("timestamp"))
    width = frequency_seconds * 1_000_000

    buckets = (
        plain.withColumn("micros", micros)
        .withColumn("bucket", _bucket("micros", width))
        .withColumn("span", _bucket("bucket", _BUCKETS_PER_SPAN))
        .groupBy("dataset", "span", "bucket")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(nulls).alias("nulls"),
            F.count_if("bad").alias("bad"),
            F.bool_and("valid").alias("valid"),
            F.min("micros").alias("first"),
            F.max("micros").alias("last"),
        )
    )
    in_span = W.partitionBy("dataset", "span").orderBy("bucket")
    spans = (
        buckets.withColumn("step", F.col("first") - F.lag("last").over(in_span))
        .groupBy("dataset", "span")
        .agg(
            *[F.sum(c).alias(c) for c in ("n", "nulls", "bad")],
            F.bool_and("valid").alias("valid"),
            F.min("first").alias("first"),
            F.max("last").alias("last"),
            F.max("step").alias("step"),
        )
    )
    in_dataset = W.partitionBy("dataset").orderBy("span")
    totals = (
        spans.withColumn("jump", F.col("first") - F.lag("last").over(in_dataset))
        .groupBy("dataset")
        .agg(
            *[F.sum(c).cast("bigint").alias(c) for c in ("n", "nulls", "bad")],
            F.bool_and("valid").alias("valid"),
            F.min("first").alias("first"),
            F.max("last").alias("last"),
            F.max(F.greatest("step", "jump")).alias("widest"),
        )
    )
    # one row for each dataset that holds a row twice
    extra = repeated_rows(plain, "dataset", cells).withColumnRenamed("dataset", "_dataset")
    totals = totals.join(extra, F.col("dataset").eqNullSafe(F.col("_dataset")), "left").withColumn(
        "extra", F.coalesce("extra", F.lit(0).cast("bigint"))
    )
    rows_d = F.col("n").cast("double")
    null_share = F.col("nulls").cast("double") / (rows_d * F.lit(float(len(columns))))
    score = (
        (F.lit(1.0) - null_share)
        * (F.lit(1.0) - F.col("extra").cast("double") / rows_d)
        * (F.lit(1.0) - F.col("bad").cast("double") / rows_d)
    )
    expected = F.expr(f"(last - first) div {width}") + 1
    notes = F.filter(
        F.array(
            F.when(F.col("n") < small_rows, F.lit("row count unexpectedly small")),
            F.when(F.col("extra") > 0, F.lit("exact duplicate rows present")),
        ),
        lambda note: note.isNotNull(),
    )
    return totals.select(
        "dataset",
        F.col("n").alias("row_count"),
        _iso(F.col("first")).alias("event_time_start"),
        _iso(F.col("last")).alias("event_time_end"),
        F.lit(frequency_seconds).alias("expected_frequency_seconds"),
        expected.cast("bigint").alias("expected_records"),
        null_share.alias("null_percentage"),
        F.col("extra").alias("duplicate_rows"),
        _iso(F.col("first")).alias("min_timestamp"),
        _iso(F.col("last")).alias("max_timestamp"),
        F.lit(len(columns) > 0).alias("schema_detected"),
        F.col("bad").alias("corrupted_rows"),
        score.alias("basic_quality_score"),
        F.col("valid").alias("schema_valid"),
        F.coalesce(F.col("widest") > width, F.lit(False)).alias("time_continuity_suspected_gap"),
        notes.alias("notes"),
    )


def repeated_rows(rows: DataFrame, by: str, columns: list[str]) -> DataFrame:
    """(by, extra): rows beyond the first of equal ones in ``by`` and ``columns``; values of ``by`` without any are absent.

    Fingerprints are counted first, 8 bytes a row. Those met more than once set
    bits of a map of constant size, at most 16 MiB whatever the rows; only rows
    whose bit is set are shuffled and compared in full. Two different rows with
    one fingerprint, or one bit, are told apart there. Nulls equal nulls, NaN
    equals NaN and -0.0 equals 0.0. No rows give none.
    """
    fingerprint = F.xxhash64(by, *columns)
    # bits count from 1: the functions of bitmaps number 0 apart
    bit = F.pmod("_print", F.lit(FINGERPRINT_BITS)) + 1
    met = rows.select(fingerprint.alias("_print")).groupBy("_print").agg(F.count(F.lit(1)).alias("_n"))
    marks = (
        met.filter("_n > 1")
        .groupBy(F.bitmap_bucket_number(bit).alias("_part"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("_marks"))
    )
    spot = F.bitmap_bit_position(bit)
    byte = F.ascii(F.decode(F.substring("_marks", F.floor(spot / 8).cast("int") + 1, F.lit(1)), "ISO-8859-1"))
    marked = F.getbit(byte, (spot % 8).cast("int")) == 1
    open_rows = (
        rows.select(by, *columns, fingerprint.alias("_print"))
        .withColumn("_part", F.bitmap_bucket_number(bit))
        .join(F.broadcast(marks), "_part")  # FINGERPRINT_BITS at most
        .filter(marked)
    )
    equal = open_rows.groupBy(by, *columns).agg(F.count(F.lit(1)).alias("_n"))
    return equal.groupBy(by).agg(F.sum(F.col("_n") - 1).alias("extra")).filter("extra > 0")


def _bucket(value: str, width: int) -> Column:
    """Floor division in integers."""
    return F.expr(f"({value} - pmod({value}, {width}L)) div {width}L")


def _iso(micros: Column) -> Column:
    return F.date_format(F.timestamp_micros(micros), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
