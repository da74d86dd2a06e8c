"""Sidecar files: newest version wins, whole files only, errors told by path."""

import json
from pathlib import Path

import pytest
from pyarrow import fs
from pyspark.sql import functions as F

from bronzeflow.catalog.adapters import CONTEXT
from bronzeflow.plans import worker
from bronzeflow.sinks import bronze, sidecars
from bronzeflow.sinks.tables import Tables
from bronzeflow.sources import folders
from test_worker import BATCH, CONTENTS, ID


def document(version, **more):
    return json.dumps({"dataset": {"dataset_id": "d", "version": version}, **more})


def write(spark, root, rows):
    df = spark.createDataFrame(rows, "metadata_path string, version int, metadata_json string")
    return {r.metadata_path: (r.outcome, r.error_class) for r in sidecars.write_sidecars(df, str(root)).collect()}


def held(root):
    return {str(p.relative_to(root)): p.read_text() for p in Path(root).rglob("*") if p.is_file() and not p.name.startswith(".")}


def test_newest_version_wins_in_a_batch_and_over_batches(spark, tmp_path):
    a, b = "k=a+b c/metadata.json", "k=é%20/metadata.json"
    assert write(spark, tmp_path, [(a, 1, document(1)), (a, 3, document(3)), (a, 2, document(2)), (b, 1, document(1))]) == {
        a: ("written", None), b: ("written", None)
    }
    assert write(spark, tmp_path, [(a, 2, document(2)), (b, 1, document(1))]) == {a: ("kept", None), b: ("same", None)}
    assert write(spark, tmp_path, [(b, 1, document(1, x=1)), (None, 1, document(1)), ("n/metadata.json", 1, None)]) == {b: ("written", None)}
    assert held(tmp_path) == {a: document(3), b: document(1, x=1)}
    back = {r.metadata_path: r.metadata_json for r in sidecars.read_sidecars(spark, str(tmp_path)).collect()}
    assert back == held(tmp_path)


def test_sidecars_are_read_at_any_depth_by_few_tasks(spark, tmp_path):
    paths = [*(f"source=p/dataset={i}/ingestion_date=d/metadata.json" for i in range(60)), "metadata.json", "source=p/metadata.json", "a/b/c/d/metadata.json"]
    for path in [*paths, "_x/metadata.json", "source=p/.y/metadata.json", "source=p/dataset=1/other.json", "source=p/empty/metadata.json"]:
        (tmp_path / path).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / path).write_text("" if "empty" in path else path)
    read = sidecars.read_sidecars(spark, str(tmp_path))
    assert sorted(map(tuple, read.collect())) == sorted((p, p) for p in paths)
    # A folder is no task of its own.
    assert read.rdd.getNumPartitions() == 1
    (tmp_path / "none").mkdir()
    assert sidecars.read_sidecars(spark, str(tmp_path / "none")).count() == 0


def test_many_files_are_written_and_read_by_a_few_tasks_a_core(spark, tmp_path, monkeypatch):
    cores = spark.sparkContext.defaultParallelism
    rows = spark.range(600).selectExpr(
        "concat('source=p/dataset=', id, '/metadata.json') AS metadata_path", "1 AS version",
        "concat('{\"dataset\": {\"version\": 1}, \"id\": ', id, '}') AS metadata_json",
    )
    put = sidecars.write_sidecars(rows, str(tmp_path), files_per_task=1)
    assert put.filter("outcome = 'written'").count() == 600 and len(put.inputFiles()) <= 4 * cores
    read = sidecars.read_sidecars(spark, str(tmp_path), files_per_task=1)
    assert read.rdd.getNumPartitions() == 4 * cores
    assert sorted(map(tuple, read.collect())) == sorted((r.metadata_path, r.metadata_json) for r in rows.collect())
    # nothing is left beside the files, and no task gets too many
    assert [x.name for x in tmp_path.iterdir()] == ["source=p"]
    monkeypatch.setattr(sidecars, "_MOST", 5)
    assert sidecars.read_sidecars(spark, str(tmp_path), files_per_task=400).rdd.getNumPartitions() == 120


def test_a_folder_is_listed_in_parts(tmp_path, monkeypatch):
    for name in ("a", "b", "_c", ".d", "_e=1"):
        (tmp_path / name).mkdir()
    for name in ("f", "_g", "h=é.json"):
        (tmp_path / name).write_text("x")
    monkeypatch.setattr(sidecars, "_ROWS", 2)
    system, top, _ = folders.locate(str(tmp_path))
    elsewhere = fs.SubTreeFileSystem(str(tmp_path.parent), system)  # no local file system by its type
    for where, folder in ((system, top), (elsewhere, tmp_path.name)):
        want = sorted((x.path, x.type == fs.FileType.Directory) for x in folders.visible(where, folder, False))
        parts = list(sidecars._inside(where, folder))
        assert [len(x) for x in parts] == [2, 2, 1] and sorted(sum(parts, [])) == want
        assert list(sidecars._inside(where, f"{folder}/none")) == []


def test_no_rows_leave_nothing(spark, tmp_path):
    assert write(spark, tmp_path, []) == {} and held(tmp_path) == {}


@pytest.mark.parametrize("torn", ["", "{", "[]", '{"dataset": 1}'])
def test_a_file_that_is_no_sidecar_is_replaced(spark, tmp_path, torn):
    (tmp_path / "metadata.json").write_text(torn)
    assert write(spark, tmp_path, [("metadata.json", 1, document(1))]) == {"metadata.json": ("written", None)}
    assert held(tmp_path) == {"metadata.json": document(1)}


def test_a_failed_write_names_its_path_and_leaves_one_file(spark, tmp_path):
    (tmp_path / "x").write_text("a file where a folder has to be")
    got = write(spark, tmp_path, [("x/metadata.json", 1, document(1)), ("y/metadata.json", 1, document(1))])
    assert got["y/metadata.json"] == ("written", None)
    assert got["x/metadata.json"][0] is None and got["x/metadata.json"][1] in ("TransportError", "PermissionError")
    assert sorted(held(tmp_path)) == ["x", "y/metadata.json"]


def run(spark, tables, store, batch_id, **options):
    df = spark.createDataFrame([(b,) for b in BATCH], "body binary")
    worker.run_batch(spark, df, tables, store, CONTEXT, batch_id, **options)


def counters(spark, tables, batch_id):
    rows = worker.batch_counters(spark, tables).filter(F.col("batch_id") == batch_id).collect()
    return {r.correlation_id: (r.datasets_downloaded, r.datasets_stored, r.datasets_emitted, r.datasets_failed, r.error) for r in rows}


@pytest.fixture
def contents(spark):
    return spark.createDataFrame(CONTENTS, "s3_key string, content binary")


def test_worker_puts_sidecars_and_holds_back_events_without_one(spark, tmp_path, contents):
    tables, root = Tables(str(tmp_path / "t")), tmp_path / "files"
    run(spark, tables, lambda i: bronze.attach_content(i, contents), 0, sidecar_root=str(root))
    files = held(root)
    told = {r.metadata_path: r.metadata_json for r in spark.read.parquet(tables.sidecars).collect()}
    assert files == told and len(files) == 2
    assert spark.read.parquet(tables.events).count() == 2
    # the folder of one dataset cannot be made: its object fails for a passing reason, the other is published
    blocked = tmp_path / "blocked"
    other = Tables(str(tmp_path / "u"))
    first = sorted(files)[0].split("/")
    (blocked / "/".join(first[:1])).mkdir(parents=True)
    (blocked / "/".join(first[:2])).write_text("")
    run(spark, other, lambda i: bronze.attach_content(i, contents), 0, sidecar_root=str(blocked))
    assert spark.read.parquet(other.events).count() == 1
    assert worker.redelivered(spark, other).count() == 1


def test_counters_are_left_by_every_exit(spark, tmp_path, contents):
    tables = Tables(str(tmp_path))

    def broken(items):
        raise RuntimeError("no store")

    with pytest.raises(RuntimeError, match="no store"):
        run(spark, tables, broken, 0)
    assert counters(spark, tables, 0) == {ID: (0, 0, 0, 4, "RuntimeError")}
    # the batch again, whole: its counters replace those, and agree with the outcomes
    run(spark, tables, lambda i: bronze.attach_content(i, contents), 0)
    whole = counters(spark, tables, 0)
    assert whole == {ID: (2, 2, 2, 3, None), "unknown": (0, 0, 0, 1, None)}
    by_run = {r.correlation_id: (r.datasets_downloaded, r.datasets_stored, r.datasets_emitted, r.datasets_failed) for r in worker.run_counters(spark, tables, CONTEXT).collect()}
    assert {k: v[:4] for k, v in whole.items()} == by_run


def test_counters_tell_what_was_written_before_the_end(spark, tmp_path, contents, monkeypatch):
    tables = Tables(str(tmp_path))
    monkeypatch.setattr(worker.failures, "route_failures", lambda failed: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        run(spark, tables, lambda i: bronze.attach_content(i, contents), 3)
    assert counters(spark, tables, 3) == {ID: (2, 2, 2, 2, "ZeroDivisionError")}


def test_a_batch_that_ends_before_its_attempts_leaves_a_row(spark, tmp_path, monkeypatch):
    tables = Tables(str(tmp_path))
    monkeypatch.setattr(worker, "prepare", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        run(spark, tables, None, 0)
    assert counters(spark, tables, 0) == {CONTEXT.correlation_id: (0, 0, 0, 0, "ZeroDivisionError")}
