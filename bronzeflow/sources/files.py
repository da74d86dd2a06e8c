"""Source files: bytes, CSV rows and header/data documents."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bronzeflow.operators.once import compute_once
from bronzeflow.operators.skew import skew_join
from bronzeflow.sources.folders import empty_files

CORRUPT = "_corrupt"
_END = "\u0002"  # marks the end of the fields of a line


def with_empty_files(found: DataFrame, path: str, encoded: bool, values: dict[str, Column]) -> DataFrame:
    """found (path, ...) and a row of values for each file of zero bytes below path, which a scan lists but does not read.

    Tasks list them. `encoded` says whether found has URL-escaped paths.
    """
    empty = empty_files(found.sparkSession, path, encoded)
    return found.unionByName(empty.select("path", *[value.cast(found.schema[c].dataType).alias(c) for c, value in values.items()]))


def read_bytes(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, content): one file per row, for files a task can hold; empty files included."""
    scan = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    values = {"length": F.lit(0), "content": F.encode(F.lit(""), "UTF-8")}
    return with_empty_files(scan.select("path", "length", "content"), path, False, values)


def split_line_counts(spark: SparkSession, path: str) -> DataFrame:
    """(path, file_size, row_count) with one file spread over many tasks.

    Counts newline bytes like ``newline_count``, but from a line scan that
    splits large files. The last line counts when its newline is there, which
    shows in the bytes left over: one per newline, plus three for a byte mark.
    Only plain files: sizes of compressed ones say nothing about their lines.
    """
    scan = spark.read.option("lineSep", "\n").option("recursiveFileLookup", "true").text(path)
    lines = scan.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_size").alias("file_size"),
        F.octet_length("value").alias("bytes"),
    )
    left_over = F.col("file_size") - F.col("bytes") - F.col("lines")
    counted = (
        lines.groupBy("path", "file_size")
        .agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("lines"))
        .select(
            "path",
            "file_size",
            (F.col("lines") - F.when(left_over.isin(-1, 2), 1).otherwise(0)).alias("row_count"),
        )
    )
    return with_empty_files(counted, path, True, {"file_size": F.lit(0), "row_count": F.lit(0)})


def list_sizes(spark: SparkSession, path: str) -> DataFrame:
    """(path, length) of all files below a folder, empty ones included; the content column is pruned."""
    scan = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return with_empty_files(scan.select("path", "length"), path, False, {"length": F.lit(0)})


def read_csv(
    spark: SparkSession, path: str, schema: str | None = None, escape: str = "\\"
) -> DataFrame:
    """Rows of CSV files that share a header; every value is text.

    Records do not span lines. Without ``schema`` (column names typed string)
    the header is read once when the plan is built. ``_corrupt`` holds a line
    that did not fit, ``source_file`` where a row came from. A path that does
    not exist gives no rows.
    """
    reader = (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("multiLine", False)
        .option("mode", "PERMISSIVE")
        .option("escape", escape)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("enforceSchema", True)
        .option("recursiveFileLookup", "true")
    )
    try:
        columns = T.StructType.fromDDL(schema) if schema else reader.csv(path).schema
        wanted = T.StructType(
            [*[f for f in columns.fields if f.name != CORRUPT], T.StructField(CORRUPT, T.StringType())]
        )
        rows = reader.schema(wanted).csv(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        empty = T.StructType.fromDDL(f"{CORRUPT} string, source_file string")
        return spark.createDataFrame([], empty)
    return rows.withColumn("source_file", F.col("_metadata.file_path"))


def read_csv_maps(spark: SparkSession, path: str) -> DataFrame:
    """(source_file, row) where ``row`` maps header to value and each file has its own header.

    The first non-empty line of a file is its header. A short row lacks the
    trailing keys, a long one is cut, of equal header names the last counts.
    """
    lines = (
        spark.read.option("lineSep", "\n")
        .option("recursiveFileLookup", "true")
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("source_file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("position"),
            F.rtrim(F.col("value"), F.lit("\r")).alias("line"),
        )
        .filter(F.col("line") != "")
    )
    headers = lines.groupBy("source_file").agg(
        F.min(F.struct("block", "position", "line")).alias("_first")
    )
    widest = headers.agg(F.max(F.size(F.split("_first.line", ",")))).first()[0] or 1
    names = _with_fields(headers.selectExpr("source_file", "_first", "_first.line AS line"), widest)
    names = names.select(
        "source_file",
        F.struct("_first.block", "_first.position").alias("_at"),
        F.col("fields").alias("names"),
    )
    joined = skew_join(lines, names, ["source_file"], "inner", spread=["block", "position"])
    rows = joined.filter(F.struct("block", "position") != F.col("_at"))
    return _with_fields(rows, widest).selectExpr(
        "source_file", f"{_zip_last('names', 'fields')} AS row"
    )


def _with_fields(lines: DataFrame, width: int) -> DataFrame:
    """Add ``fields``: the first ``width`` fields of a CSV line; an empty field is empty text.

    A mark is put behind the line. It comes out as a field of its own, or as
    the tail of a field whose quote never closes, and tells where the line ends.
    """
    columns = [f"c{i}" for i in range(width + 1)]
    schema = ", ".join(f"{c} string" for c in columns)
    parsed = F.from_csv(F.concat("line", F.lit("," + _END)), schema)
    tokens = f"array({', '.join(f'_csv.{c}' for c in columns)})"
    marked = f"transform({tokens}, t -> coalesce(endswith(t, '{_END}'), false))"
    split = (
        compute_once(lines, "_csv", parsed)
        .withColumn("_tokens", F.expr(tokens))
        .withColumn("_end", F.expr(f"CAST(array_position({marked}, true) AS INT)"))
    )
    last = (
        f"CASE WHEN _end = 0 THEN {width} "
        f"WHEN element_at(_tokens, _end) = '{_END}' THEN _end - 1 ELSE _end END"
    )
    plain = f"if(endswith(t, ',{_END}'), substr(t, 1, length(t) - 2), coalesce(t, ''))"
    fields = F.expr(f"transform(slice(_tokens, 1, {last}), t -> {plain})")
    return split.withColumn("fields", fields).select(*lines.columns, "fields")


def _zip_last(names: str, values: str) -> str:
    """Map of names to values as far as both go; of equal names the last counts."""
    count = f"least(size({names}), size({values}))"
    pairs = f"slice(arrays_zip({names}, {values}), 1, {count})"
    later = f"slice({names}, i + 2, greatest({count} - i - 1, 0))"
    unique = f"size(array_distinct({names})) = size({names})"
    last = f"filter({pairs}, (p, i) -> NOT array_contains({later}, p.{names}))"
    return f"map_from_entries(CASE WHEN {unique} THEN {pairs} ELSE {last} END)"


def flatten_api(documents: DataFrame, body: str, keep: list[str]) -> DataFrame:
    """One record map per row of {"headers": [...], "data": [[...], ...]} documents."""
    parsed = F.from_json(body, "headers array<string>, data array<array<string>>")
    return (
        compute_once(documents.select(*keep, body), "_doc", parsed)
        .select(*keep, F.col("_doc.headers").alias("names"), F.explode("_doc.data").alias("fields"))
        .selectExpr(*keep, f"{_zip_last('names', 'fields')} AS record")
    )
