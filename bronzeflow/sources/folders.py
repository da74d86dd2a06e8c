"""Object listings made in tasks: one partition for each prefix, no list of names on the driver.

``folder_listing`` is a Python data source over any file system that pyarrow can
open. Its partitions are the folders ``depth`` levels below the root, whose names
are the only listing the driver makes, plus one for the files above them. Each task
walks its own prefix. The streaming reader hands out objects by modification time.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timezone
from fnmatch import fnmatchcase
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from bronzeflow.functions import keys

NAME = "folder_listing"
SCHEMA = "path string, size bigint, modified timestamp"
_COLUMNS = pa.schema([("path", pa.string()), ("size", pa.int64()), ("modified", pa.timestamp("us", tz="UTC"))])
_ROWS = 10_000

#: Fixed value: the ASCII characters that stand for themselves in the path of a URI.
_PLAIN = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789/:_-!.~'()*,;&=+$@")


class Prefix(InputPartition):
    """A folder to walk, or only the files in it, of modification times after `since` up to `until`."""

    def __init__(self, folder: str, deep: bool, since: int | None = None, until: int | None = None):
        self.folder, self.deep, self.since, self.until = folder, deep, since, until


def locate(uri: str) -> tuple[fs.FileSystem, str, str]:
    """File system, path in it and what to put before its paths; a path without a scheme is local."""
    if uri.startswith("file:") or "://" not in uri:
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").strip("/"), "file:"
    system, path = fs.FileSystem.from_uri(uri)
    path = path.rstrip("/")
    return system, path, uri.rstrip("/").removesuffix(path)


def hidden(name: str) -> bool:
    """Names that Spark's readers skip as well: marks, logs and unfinished writes."""
    return name.startswith(("_", ".")) and "=" not in name


def _escaped(path: str) -> str:
    """A path as Spark's file metadata spells it: only characters that a URI may not hold are escaped."""
    return "".join(c if ord(c) > 127 or c in _PLAIN else quote(c, safe="") for c in path)


def visible(system: fs.FileSystem, folder: str, deep: bool) -> list[fs.FileInfo]:
    """What lies in a folder, or anywhere below it, without hidden names; nothing where there is no folder."""
    found = system.get_file_info(fs.FileSelector(folder, allow_not_found=True, recursive=deep))
    start = len(folder.rstrip("/")) + 1
    return [x for x in found if not any(map(hidden, x.path[start:].split("/")))]


class _Walker:
    """What the batch and the streaming reader share."""

    def __init__(self, options: dict[str, str]):
        self.uri, self.glob, self.depth = options["path"], options.get("glob", "*"), int(options.get("depth", "1"))
        self.spell = _escaped if options.get("escape") == "true" else str
        if self.depth < 0:
            raise ValueError("depth is not negative")

    def prefixes(self, since: int | None = None, until: int | None = None) -> list[Prefix]:
        """Folders `depth` levels down, walked whole, and those above them for their own files."""
        system, path, _ = locate(self.uri)
        level, out = [path], []
        for _ in range(self.depth):
            out += [Prefix(folder, False, since, until) for folder in level]
            level = [x.path for folder in level for x in visible(system, folder, False) if x.type == fs.FileType.Directory]
        return out + [Prefix(folder, True, since, until) for folder in level]

    def walk(self, part: Prefix) -> Iterator[pa.RecordBatch]:
        system, _, lead = locate(self.uri)
        rows: list[tuple[str, int, datetime | None]] = []
        for x in visible(system, part.folder, part.deep):
            if x.type != fs.FileType.File or not fnmatchcase(x.base_name, self.glob):
                continue
            at = None if x.mtime_ns is None else x.mtime_ns // 1000
            if part.until is not None and not (at is not None and (part.since or 0) < at <= part.until):
                continue
            rows.append((self.spell(lead + x.path), x.size or 0, at))
        for at in range(0, len(rows), _ROWS):
            columns = [pa.array(c, f.type) for c, f in zip(zip(*rows[at : at + _ROWS], strict=True), _COLUMNS, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, schema=_COLUMNS)


class _Reader(_Walker, DataSourceReader):
    def partitions(self) -> list[Prefix]:
        return self.prefixes()

    def read(self, partition: Prefix) -> Iterator[pa.RecordBatch]:
        return self.walk(partition)


class _StreamReader(_Walker, DataSourceStreamReader):
    """Offsets are modification times, held back by `settle` seconds so that no object of a handed-out time comes later."""

    def __init__(self, options: dict[str, str]):
        super().__init__(options)
        self.settle = float(options.get("settle", "60"))

    def initialOffset(self) -> dict:
        return {"until": 0}

    def latestOffset(self) -> dict:
        return {"until": int((datetime.now(timezone.utc).timestamp() - self.settle) * 1_000_000)}

    def partitions(self, start: dict, end: dict) -> list[Prefix]:
        return self.prefixes(start["until"], end["until"])

    def read(self, partition: Prefix) -> Iterator[pa.RecordBatch]:
        return self.walk(partition)

    def commit(self, end: dict) -> None:
        pass


class FolderListing(DataSource):
    """spark.read.format("folder_listing").option("path", ...): path, size, modified of every file below a folder.

    Options: ``glob`` for file names, ``depth`` of the prefixes that tasks walk (1),
    ``escape`` of paths as in a URI (false), ``settle`` of the stream in seconds (60). A folder that does not exist has no files.
    """

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options))

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _StreamReader(dict(self.options))


def list_folder(spark: SparkSession, path: str, glob: str = "*.csv", depth: int = 1) -> DataFrame:
    """(key, size, last_modified) of all objects below a folder, empty ones included, with their time."""
    spark.dataSource.register(FolderListing)
    found = spark.read.format(NAME).options(path=path, glob=glob, depth=str(depth)).load()
    return found.select(F.col("path").alias("key"), "size", F.expr(keys.utc_iso("modified")).alias("last_modified"))


def empty_files(spark: SparkSession, path: str, escape: bool) -> DataFrame:
    """(path) of the files of zero bytes below a folder, which Spark's scans list but do not read."""
    spark.dataSource.register(FolderListing)
    found = spark.read.format(NAME).options(path=path, escape=str(escape).lower()).load()
    return found.filter("size = 0").select("path")


def new_objects(spark: SparkSession, path: str, glob: str = "*", depth: int = 1, settle: float = 60.0) -> DataFrame:
    """Stream of (path, size, modified) of objects by modification time; a restart goes on after the last batch."""
    spark.dataSource.register(FolderListing)
    options = {"path": path, "glob": glob, "depth": str(depth), "settle": str(settle)}
    return spark.readStream.format(NAME).options(**options).load()


def write_objects(rows: DataFrame, path: str, content: str) -> DataFrame:
    """Write each row's text, as UTF-8, to its path; (written) bytes by row. A null text makes an empty object.

    A path is written whole or not at all, and again by a repeated task.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt = TaskContext.get().taskAttemptId()
        for batch in batches:
            sizes = []
            for uri, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                system, target, _ = locate(uri)
                system.create_dir(target.rsplit("/", 1)[0], recursive=True)
                body = (text or "").encode()
                with system.open_output_stream(f"{target}.{attempt}.part") as out:
                    out.write(body)
                system.move(f"{target}.{attempt}.part", target)
                sizes.append(len(body))
            yield pa.RecordBatch.from_arrays([pa.array(sizes, pa.int64())], names=["written"])

    return rows.select(path, content).mapInArrow(write, "written bigint")
