"""Bronze layer: versioned byte-exact copies and their sidecars."""

from __future__ import annotations

import contextlib
import hashlib
import http.client
import math
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bronzeflow.operators.profile import profile_content

CHUNK = 4 * 1024 * 1024
RESULT_FIELDS = [
    T.StructField("file_size", T.LongType()),
    T.StructField("file_hash", T.StringType()),
    T.StructField("row_count", T.LongType()),
    T.StructField("error_class", T.StringType()),
    T.StructField("http_status", T.IntegerType()),
    T.StructField("error_text", T.StringType()),
]


def copy_objects(items: DataFrame, source: str, root: str, files_per_task: int = 8) -> DataFrame:
    """Copy each item's ``source`` to ``root``/storage_path and add size, hash and newlines.

    The content never enters a row: a task streams one file after the other in
    4 MiB chunks, hashing and counting on the way, so any file size fits and
    no byte is shuffled. A copy shows up under its path only when complete.
    A file that cannot be copied yields an error row for the classifier.
    ``items`` is counted to size the tasks, so hand in a written table. Running
    the plan copies; write its result before using it twice.
    """
    tasks = max(1, math.ceil(items.count() / files_per_task))
    schema = T.StructType([*items.schema.fields, *RESULT_FIELDS])
    context = items.sparkSession.sparkContext
    # Paths without a scheme mean what they mean to Spark: the default file system.
    default = context._jvm.org.apache.hadoop.fs.FileSystem.getDefaultUri(context._jsc.hadoopConfiguration()).toString()
    copier = _copier(source, root.rstrip("/"), [f.name for f in RESULT_FIELDS], CHUNK, default)
    return items.repartition(tasks, "storage_path").mapInPandas(copier, schema)


def _copier(source: str, root: str, names: list[str], chunk_size: int, default: str = "file:"):
    """The function run in tasks; it is self-contained, so executors need no copy of this package."""

    def locate(uri: str) -> tuple[fs.FileSystem, str]:
        if "://" not in uri and not uri.startswith("file:"):
            uri = default.rstrip("/") + uri
        if uri.startswith("file:"):
            return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
        return fs.FileSystem.from_uri(uri)

    def read(uri: str):
        if uri.startswith(("http://", "https://")):
            # Keys may hold spaces and letters that a request line may not; escapes stay as they are.
            return urllib.request.urlopen(urllib.parse.quote(uri, safe="%/:?&=#+,;@!$'()*[]~"), timeout=300)
        system, path = locate(uri)
        return system.open_input_stream(path)

    def fill(part: str, system: fs.FileSystem, stream) -> tuple[int, str, int]:
        digest, size, newlines = hashlib.sha256(), 0, 0
        with system.open_output_stream(part) as out:
            while chunk := stream.read(chunk_size):
                digest.update(chunk)
                size += len(chunk)
                newlines += chunk.count(b"\n")
                out.write(chunk)
        told = getattr(stream, "headers", None) and stream.headers.get("Content-Length")
        if told and int(told) != size:
            raise http.client.IncompleteRead(b"", int(told) - size)
        return size, digest.hexdigest(), newlines

    def copy_one(origin: str, target: str, attempt: int) -> tuple:
        """(size, sha-256, newlines, error class, HTTP status, error text) of one copy."""
        nothing = (None, None, None)
        try:
            stream = read(origin)
        except FileNotFoundError:
            return *nothing, "SourceNotFound", 404, f"source not found: {origin}"
        except PermissionError as error:
            return *nothing, "PermissionError", None, str(error)
        except urllib.error.HTTPError as error:
            return *nothing, "HTTPStatusError", error.code, str(error)
        except (ValueError, http.client.InvalidURL) as error:
            # An address that names nothing stays as it is, however often it is tried.
            return *nothing, "ValueError", None, f"{type(error).__name__}: {error}"
        except (OSError, http.client.HTTPException) as error:
            # Anything else that a store or a connection does may pass: it is tried again.
            return *nothing, "TransportError", None, f"{type(error).__name__}: {error}"
        system, path = locate(target)
        part = f"{path}.{attempt}.part"
        try:
            with stream:
                system.create_dir(path.rsplit("/", 1)[0], recursive=True)
                done = fill(part, system, stream)
            system.move(part, path)
            return *done, None, None, None
        except PermissionError as error:
            failed = "PermissionError", None, str(error)
        except (OSError, http.client.HTTPException) as error:
            failed = "TransportError", None, f"{type(error).__name__}: {error}"
        with contextlib.suppress(OSError):
            system.delete_file(part)
        return *nothing, *failed

    def copy(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        attempt = TaskContext.get().taskAttemptId()
        for batch in batches:
            done = [
                copy_one(origin, f"{root}/{path}", attempt)
                for origin, path in zip(batch[source], batch["storage_path"])
            ]
            result = pd.DataFrame(done, columns=names, index=batch.index)
            for name in ("file_size", "row_count", "http_status"):
                result[name] = result[name].astype("Int64")
            yield pd.concat([batch, result], axis=1)

    return copy


def attach_content(
    items: DataFrame, contents: DataFrame, tasks: int | None = None
) -> DataFrame:
    """Same result columns, and the content, for objects whose bytes are already in a table.

    Both sides have one row per ``s3_key``, so the join cannot be skewed. Only
    content that belongs to an item is hashed. An item without content is an
    error row, as a missing source file is. The number of join tasks, and so of
    tasks that write the content, is fixed: small items say little about the
    work per row.
    """
    tasks = tasks or int(items.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted = items.repartition(tasks, "s3_key")
    joined = wanted.join(contents.select("s3_key", "content"), "s3_key", "left")
    return _with_errors(profile_content(joined.select(*items.columns, "content")))


def attach_profile(items: DataFrame, contents: DataFrame) -> DataFrame:
    """``attach_content`` without the content: it is profiled in its scan and never shuffled."""
    joined = items.join(profile_content(contents).drop("content"), "s3_key", "left")
    return _with_errors(joined.select(*items.columns, "file_size", "file_hash", "row_count"))


def _with_errors(joined: DataFrame) -> DataFrame:
    missing = F.col("file_hash").isNull()
    return joined.withColumns(
        {
            "error_class": F.when(missing, "SourceNotFound"),
            "http_status": F.when(missing, F.lit(404)).cast("int"),
            "error_text": F.when(missing, F.concat(F.lit("source not found: "), "s3_key")),
        }
    )


def with_partitions(stored: DataFrame, run_date: str) -> DataFrame:
    """Add the partition columns of the bronze layout; rows of failed copies keep their error."""
    return stored.withColumns(
        {
            "source": F.lit("pvdaq"),
            "dataset": F.col("dataset_id"),
            "ingestion_date": F.lit(run_date),
        }
    )


# Folders of the bronze layer. A folder per dataset suits large files; thousands
# of small objects, or rows without content, are packed under their date instead.
BRONZE_PARTITIONS = ("source", "dataset", "ingestion_date")
PACKED_PARTITIONS = ("source", "ingestion_date")


def latest_sidecars(sidecars: DataFrame) -> DataFrame:
    """What a plain overwrite leaves: per path the sidecar of the highest version."""
    last = F.max(F.struct("version", "metadata_json")).alias("_last")
    return sidecars.groupBy("metadata_path").agg(last).select(
        "metadata_path", F.col("_last.version"), F.col("_last.metadata_json")
    )
