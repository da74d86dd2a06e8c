"""Listings, CSV rows and byte copies."""

import hashlib

import pytest
from pyspark.sql import functions as F

from bronzeflow.sinks import bronze
from bronzeflow.sources import files, listing

NS = "http://s3.amazonaws.com/doc/2006-03-01/"


def page(entries, truncated=None, token=None):
    body = "".join(f"<Contents>{e}</Contents>" for e in entries)
    flag = f"<IsTruncated>{truncated}</IsTruncated>" if truncated else ""
    more = f"<NextContinuationToken>{token}</NextContinuationToken>" if token else ""
    return f'<?xml version="1.0"?><ListBucketResult xmlns="{NS}">{flag}{more}{body}</ListBucketResult>'


def entry(key, size="1", modified="d"):
    parts = f"<Key>{key}</Key>"
    parts += f"<Size>{size}</Size>" if size is not None else ""
    return parts + (f"<LastModified>{modified}</LastModified>" if modified is not None else "")


@pytest.fixture(scope="module")
def pages(spark):
    rows = [
        (1, 0, 200, page([entry("a.csv"), entry("b.txt"), entry("B.CSV"), "<Size>1</Size>"], "true", "t1")),
        (1, 1, 200, page([entry("c.csv", "x"), entry("d &amp; e.csv", "", "")], "false")),
        (1, 2, 200, page([entry("never.csv")])),
        (2, 0, 200, page([entry("f.csv")], "true", "t1")),
        (2, 1, 404, ""),
        (3, 0, 500, ""),
        (4, 0, 200, page([entry("g.csv", None, None)], "true")),
        (4, 1, 200, page([entry("unreached.csv")])),
        (5, 0, 200, "<broken"),
        (6, 0, 200, page([])),
        (7, 0, 404, ""),
        (8, 0, 200, page([entry("h.csv")], "true", "t1")),
    ]
    return spark.createDataFrame(rows, listing.PAGE_SCHEMA)


def test_site_status(pages):
    got = {r.site_id: (r.listing_state, r.listing_ok, r.last_page) for r in listing.site_status(pages).collect()}
    assert got == {
        1: ("ok", True, 1), 2: ("missing", True, 1), 3: ("failed", False, 0),
        4: ("incomplete", True, 0), 5: ("failed", False, 0), 6: ("ok", True, 0),
        7: ("missing", True, 0), 8: ("incomplete", True, 0),
    }


def test_listed_files(pages):
    usable, bad = listing.split_sizes(listing.list_files(pages))
    assert sorted(map(tuple, usable.collect())) == [
        (1, "a.csv", 1, "d"), (1, "d & e.csv", 0, None), (4, "g.csv", 0, ""), (8, "h.csv", 1, "d")
    ]
    assert [(r.key, r.size_text) for r in bad.collect()] == [("c.csv", "x")]


def test_site_ids(spark):
    got = [tuple(r) for r in listing.sites_from_text(spark, " 9068,9069 ,, x,9068").collect()]
    assert got == [(9068, None), (9069, None), (None, "x"), (9068, None)]


def test_fan_in_by_prefix(spark):
    keys = ["p/9068_OEDI/data/a.csv", "p/9068_OEDI/other/a.csv", "p/90680_OEDI/data/a.csv",
            "q/9068_OEDI/data/a.csv", "p/09068_OEDI/data/a.csv"]
    found = spark.createDataFrame([(k, 0) for k in keys], "key string, site_id int")
    sites = spark.createDataFrame([(9068,), (9068,)], "site_id bigint")
    assert [r.key for r in listing.fan_in(found, sites, "p").collect()] == [keys[0]] * 2


@pytest.fixture(scope="module")
def csv_dir(tmp_path_factory):
    folder = tmp_path_factory.mktemp("csv")
    (folder / "a.csv").write_bytes(b'\n\nx,y,x\r\n1,2,3\r\n\n4,\n5,6,7,8\n"q,1",w\n9,"op')
    (folder / "b.csv").write_bytes(b"h1\n")
    (folder / "c.csv").write_bytes(b"p,q\n1,\xff\n")
    (folder / "d.csv").write_bytes(b"")
    return str(folder)


def test_rows_keyed_by_each_header(spark, csv_dir):
    got = [(r.source_file[-5:], dict(r.row)) for r in files.read_csv_maps(spark, csv_dir).collect()]
    assert sorted(got, key=repr) == sorted(
        [
            ("a.csv", {"x": "3", "y": "2"}),
            ("a.csv", {"x": "4", "y": ""}),
            ("a.csv", {"x": "7", "y": "6"}),
            ("a.csv", {"x": "q,1", "y": "w"}),
            ("a.csv", {"x": "9", "y": "op"}),
            ("c.csv", {"p": "1", "q": "�"}),
        ],
        key=repr,
    )


def test_csv_rows(spark, csv_dir):
    rows = files.read_csv(spark, f"{csv_dir}/c.csv")
    assert [(r.p, r.q, r._corrupt) for r in rows.collect()] == [("1", "�", None)]
    assert files.read_csv(spark, f"{csv_dir}/b.csv").count() == 0
    assert files.read_csv(spark, f"{csv_dir}/absent.csv").count() == 0


def test_split_line_counts(spark, csv_dir):
    got = {r.path[-5:]: (r.file_size, r.row_count) for r in files.split_line_counts(spark, csv_dir).collect()}
    assert got == {"a.csv": (41, 8), "b.csv": (3, 1), "c.csv": (8, 2), "d.csv": (0, 0)}


def test_empty_files_are_listed_and_read(spark, tmp_path):
    (tmp_path / "a b").mkdir()
    sizes = {"a b/é%.csv": b"", "a b/x.csv": b"1\n", "e.csv": b""}
    for name, content in sizes.items():
        (tmp_path / name).write_bytes(content)
    root = f"file:{tmp_path}/"
    want = {root + name: len(content) for name, content in sizes.items()}
    assert {r.path: r.length for r in files.list_sizes(spark, str(tmp_path)).collect()} == want
    assert {r.path: len(r.content) for r in files.read_bytes(spark, str(tmp_path)).collect()} == want
    assert {r.key: r.size for r in listing.list_folder(spark, str(tmp_path)).collect()} == want


def test_split_line_counts_of_many_splits(spark, tmp_path):
    body = b"".join(b"%d\n" % i for i in range(200000)) + b"tail"
    (tmp_path / "big.csv").write_bytes(body)
    (tmp_path / "mark.csv").write_bytes(b"\xef\xbb\xbfa\nb")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        counted = files.split_line_counts(spark, str(tmp_path))
        got = {r.path.rsplit("/", 1)[1]: (r.file_size, r.row_count) for r in counted.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {"big.csv": (len(body), 200000), "mark.csv": (6, 1)}


def test_copies_are_exact(spark, tmp_path):
    contents = {"a b.csv": b"a,b\n1,2\n", "big.csv": b"x\n" * 3_000_000, "bytes.csv": bytes(range(256)), "none.csv": b""}
    for name, body in contents.items():
        (tmp_path / name).write_bytes(body)
    items = spark.createDataFrame(
        [(str(tmp_path / n), f"d=1/{n}") for n in [*contents, "gone.csv"]], "path string, storage_path string"
    )
    got = {r.storage_path[4:]: r for r in bronze.copy_objects(items, "path", str(tmp_path / "out"), 2).collect()}
    for name, body in contents.items():
        row = got[name]
        assert (row.file_size, row.file_hash, row.row_count) == (
            len(body), hashlib.sha256(body).hexdigest(), body.count(b"\n")
        )
        assert (tmp_path / "out" / "d=1" / name).read_bytes() == body
    assert (got["gone.csv"].error_class, got["gone.csv"].http_status) == ("SourceNotFound", 404)
    left_over = [p for p in (tmp_path / "out").rglob("*") if p.is_file()]
    assert len(left_over) == len(contents)


def test_listed_folder(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b"1\n")
    (tmp_path / "b.txt").write_bytes(b"1\n")
    rows = listing.list_folder(spark, str(tmp_path)).collect()
    assert [(r.key.rsplit("/", 1)[1], r.size) for r in rows] == [("a.csv", 2)]
    assert rows[0].last_modified.endswith("+00:00")


def test_api_documents(spark):
    df = spark.createDataFrame(
        [(1, '{"headers":["a","b"],"data":[["1",2],["3",null],["5"]]}'), (2, '{"headers":["a"],"data":[]}')],
        "i int, b string",
    )
    got = [dict(r.record) for r in files.flatten_api(df, "b", ["i"]).collect()]
    assert got == [{"a": "1", "b": "2"}, {"a": "3", "b": None}, {"a": "5"}]
