"""Sidecars as files: one JSON document under each metadata path, replaced as a whole.

A task writes a document to a staging folder and moves it into place, so a reader
finds the old document or the new one. The file says which version it describes; a
document of an older version than the one in place is not written, so a batch
that is repeated late takes nothing back. What killed tasks leave lies in the
staging folder, which goes when the write ends.
"""

from __future__ import annotations

import json
import math
import os
import uuid
from collections.abc import Iterator
from contextlib import suppress
from itertools import islice

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bronzeflow.sinks.bronze import latest_sidecars
from bronzeflow.sinks.tables import remove
from bronzeflow.sources.folders import hidden, locate, visible
from bronzeflow.workspace import materialize

WRITTEN, SAME, KEPT = "written", "same", "kept"
_ENTRY = "path string, folder boolean"
_ROWS = 10_000
#: Files of a task at most: some seconds, so that a task that is tried again costs little.
_MOST = 16_384
_OUTCOME = "metadata_path string, version bigint, outcome string, error_class string, error_text string"


def _tasks(spark: SparkSession, files: int, least: int) -> int:
    """Tasks of at least so many files; no more of them than keep all cores busy, but for tasks of too many files."""
    even = min(math.ceil(files / least), 4 * spark.sparkContext.defaultParallelism)
    return max(1, even, math.ceil(files / _MOST))


def write_sidecars(sidecars: DataFrame, root: str, files_per_task: int = 64) -> DataFrame:
    """Put the newest of (metadata_path, version, metadata_json) by path under ``root``; what became of each path.

    ``outcome`` is ``written``, ``same`` (these very bytes were in place) or
    ``kept`` (a newer version was). Where a file could not be written it is null
    and the error is told, for the classifier; other paths are not affected. Rows
    without a path or a document have no file and are left out. One writer at a time, as for all tables.
    A task writes ``files_per_task`` files at least, and more where there are many.
    """
    spark = sidecars.sparkSession
    known = sidecars.filter("metadata_path IS NOT NULL AND metadata_json IS NOT NULL")
    last = materialize(latest_sidecars(known), "sidecars_last")
    staging = f"{root.rstrip('/')}/_staging-{uuid.uuid4().hex}"
    tasks = _tasks(spark, last.count(), files_per_task)
    # paths are unique by now, so no two tasks meet at a file
    rows = last.select("metadata_path", F.col("version").cast("bigint").alias("version"), "metadata_json")
    put = rows.repartition(tasks, "metadata_path").mapInArrow(_writer(root.rstrip("/"), staging), _OUTCOME)
    try:
        return materialize(put, "sidecars_put")
    finally:
        remove(spark, staging)


def _writer(root: str, staging: str):
    def put(path: str, version: int, document: str, part: str, made: set[str]) -> str:
        system, target, _ = locate(f"{root}/{path}")
        body = document.encode()
        held = read(system, target)
        if held == body:
            return SAME
        if held is not None and version_in(held) > version:
            return KEPT
        _, staged, _ = locate(part)
        # Tasks wait for each other where they make folders in one place, also such as are there.
        if (own := staged.rsplit("/", 1)[0]) not in made:
            system.create_dir(own, recursive=True)
            made.add(own)
        system.create_dir(target.rsplit("/", 1)[0], recursive=True)
        with system.open_output_stream(staged) as out:
            out.write(body)
        try:
            system.move(staged, target)
        except OSError:
            # Some stores do not rename onto a file: a reader may find none for a moment there.
            if system.get_file_info(target).type != fs.FileType.File:
                raise
            system.delete_file(target)
            system.move(staged, target)
        return WRITTEN

    def read(system: fs.FileSystem, path: str) -> bytes | None:
        if system.get_file_info(path).type != fs.FileType.File:
            return None
        with system.open_input_stream(path) as stream:
            return stream.read()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt, number, made = TaskContext.get().taskAttemptId(), 0, set()
        for batch in batches:
            ends = []
            for path, version, document in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                number += 1
                try:
                    ends.append((put(path, version, document, f"{staging}/{attempt}/{number}", made), None, None))
                except PermissionError as error:
                    ends.append((None, "PermissionError", str(error)))
                except OSError as error:
                    ends.append((None, "TransportError", f"{type(error).__name__}: {error}"))
            told = [pa.array(values, pa.string()) for values in zip(*ends)] or [pa.array([], pa.string())] * 3
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *told], names=["metadata_path", "version", "outcome", "error_class", "error_text"])

    return write


def version_in(document: bytes) -> int:
    """The version that a sidecar describes; a file that is no sidecar is older than any."""
    try:
        return int(json.loads(document)["dataset"]["version"])
    except (ValueError, KeyError, TypeError):
        return 0


def read_sidecars(spark: SparkSession, root: str, files_per_task: int = 512) -> DataFrame:
    """(metadata_path, metadata_json) of the sidecar files under ``root``.

    The driver lists the root alone, a task each of the folders in it, and tasks
    walk and read what lies below those. Empty files are no sidecars.
    """
    system, top, _ = locate(root)
    inner = [(x.path, x.type == fs.FileType.Directory) for x in visible(system, top, False)]
    first = spark.createDataFrame(inner, _ENTRY)
    listed = first.filter("folder").repartition(max(1, len(inner)), "path").mapInArrow(_lister(root), _ENTRY)
    entries = materialize(listed.unionAll(first.filter("NOT folder")), "sidecar_folders")
    tasks = _tasks(spark, entries.count(), files_per_task)
    return entries.repartition(tasks, "path").mapInArrow(_reader(root, len(top.rstrip("/")) + 1), "metadata_path string, metadata_json string")


def _lister(root: str):
    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _, _ = locate(root)
        for batch in batches:
            for folder in batch.column("path").to_pylist():
                for some in _inside(system, folder):
                    columns = [pa.array(values, kind) for values, kind in zip(zip(*some), (pa.string(), pa.bool_()), strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, names=["path", "folder"])

    return entries


def _inside(system: fs.FileSystem, folder: str) -> Iterator[list[tuple[str, bool]]]:
    """(path, whether it is a folder) of what ``visible`` finds right in a folder, in parts.

    A local folder is read entry by entry: one may hold a folder of each dataset.
    """
    if isinstance(system, fs.LocalFileSystem):
        with suppress(FileNotFoundError), os.scandir(folder) as found:
            shown = ((x.path, x.is_dir()) for x in found if not hidden(x.name))
            while some := list(islice(shown, _ROWS)):
                yield some
    else:
        every = [(x.path, x.type == fs.FileType.Directory) for x in visible(system, folder, False)]
        yield from (every[at : at + _ROWS] for at in range(0, len(every), _ROWS))


def _reader(root: str, start: int):
    def files(system: fs.FileSystem, batches: Iterator[pa.RecordBatch]) -> Iterator[str]:
        for batch in batches:
            for path, folder in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                yield from (x.path for x in visible(system, path, True) if x.type == fs.FileType.File) if folder else [path]

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _, _ = locate(root)
        wanted = (path for path in files(system, batches) if path.rsplit("/", 1)[-1] == "metadata.json")
        while some := list(islice(wanted, files_at_once)):
            bodies = []
            for path in some:
                with system.open_input_stream(path) as stream:
                    bodies.append(stream.read())
            rows = [(path[start:], body.decode(errors="replace")) for path, body in zip(some, bodies, strict=True) if body]
            columns = [pa.array(values, pa.string()) for values in zip(*rows, strict=True)] or [pa.array([], pa.string())] * 2
            yield pa.RecordBatch.from_arrays(columns, names=["metadata_path", "metadata_json"])

    files_at_once = 256
    return documents
