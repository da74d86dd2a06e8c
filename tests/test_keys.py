"""Names, paths and ids against plain Python."""

import re
import uuid
from urllib.parse import quote

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from bronzeflow.functions import keys


def values(spark, expression, rows, schema):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.selectExpr(f"{expression} AS v").collect()]


@pytest.mark.parametrize(
    "name, expected",
    [
        ("9068_irradiance_data.csv", "irradiance"),
        ("9068_ac_power_data.csv", "ac_power"),
        ("9068_meter_15m_data.csv", "meter_15m"),
        ("9068_ac_power_data_2023-01-01_2023-06-30.csv", "ac_power"),
        ("unknown_format.csv", "unknown_format"),
        ("9068_.csv", "9068_"),
        ("9068__data.csv", "9068__data"),
        ("9069_ac_power_data.csv", "9069_ac_power"),
        ("9068_x_data_data.csv", "x_data"),
        ("plain", "plain"),
    ],
)
def test_category(spark, name, expected):
    assert values(spark, keys.extract_category("f", "s"), [(name, 9068)], "f string, s bigint") == [
        expected
    ]


CATEGORY = st.text(st.sampled_from("abcxyzéß ٣-"), min_size=1, max_size=12)
SUFFIX = st.sampled_from(["_data", "_data_2024-01-01_2024-06-30", "_data_1999-12-31_2000-01-01"])


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(1, 10**6), CATEGORY, SUFFIX), min_size=20, max_size=60))
def test_category_is_the_one_a_name_was_built_from(spark, parts):
    rows = [(f"{site}_{category}{suffix}.csv", site) for site, category, suffix in parts]
    got = values(spark, keys.extract_category("f", "s"), rows, "f string, s bigint")
    assert got == [category for _, category, _ in parts]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.text(st.characters(blacklist_categories=["Cs"])), st.integers(1, 10**6)),
        min_size=20, max_size=50,
    )
)
def test_event_id_equals_uuid5(spark, pairs):
    got = values(spark, keys.event_id("k", "v"), pairs, "k string, v bigint")
    assert got == [str(uuid.uuid5(keys.EVENT_ID_NAMESPACE, f"{k}#v{v}")) for k, v in pairs]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.characters(blacklist_categories=["Cs"])), min_size=20, max_size=50))
def test_blob_url_equals_percent_encoding(spark, paths):
    got = values(
        spark, keys.blob_url("https://a.net/", "c", "p"), [(p,) for p in paths], "p string"
    )
    assert got == [f"https://a.net/c/{quote(p, safe='~/')}" for p in paths]


def test_paths(spark):
    row = (9068, "ac_power", "a/b/9068_ac_power_data.csv", 3)
    schema = "s bigint, c string, k string, v int"
    dataset = keys.dataset_id("s", "c")

    def one(expression):
        return values(spark, expression, [row], schema)[0]

    folder = "source=pvdaq/dataset=9068_ac_power/ingestion_date=2024-01-15"
    assert one(keys.storage_path(dataset, "'2024-01-15'", "v")) == f"{folder}/9068_ac_power_v3.csv"
    assert one(keys.metadata_path(dataset, "'2024-01-15'")) == f"{folder}/metadata.json"
    assert one(keys.basename("k")) == "9068_ac_power_data.csv"
    assert one(keys.source_url("https://b/", "k")) == "https://b/a/b/9068_ac_power_data.csv"
    assert one(keys.category_or_default("''", "'9068_x_data.csv'", "s")) == "x"
    parent = one(keys.traceparent("'id'"))
    assert re.fullmatch(r"00-[0-9a-f]{32}-[0-9a-f]{16}-01", parent)


def test_same_category_different_object_different_id(spark):
    got = values(
        spark, keys.event_id("k", "v"), [("x_part1.csv", 1), ("x_part2.csv", 1), ("x_part1.csv", 2)],
        "k string, v int",
    )
    assert len(set(got)) == 3


def test_body_preview_replaces_bad_bytes(spark):
    got = values(spark, keys.body_preview("b"), [(b"\xff" + b"a" * 600,)], "b binary")
    assert got == ["�" + "a" * 499]
