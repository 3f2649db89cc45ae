"""Every registered query next to its SQL, and what its plan must and must not hold."""

from __future__ import annotations

import os
import re

import pytest
from conftest import plan_of
from oracle_check import differences, duck

import __spark_entry__ as entry_module
from starloom.plans import file_queries, load_queries
from starloom.plans.oracles import ORACLES
from starloom.plans.table_queries import all_queries
from starloom.schemas import GIVEN_TABLES

FOLDER = "/root/testdata/sf0.001"
QUERIES = all_queries()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    return duck(FOLDER)


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(entry_module.queries())


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, connection, name):
    assert differences(QUERIES[name](spark, FOLDER), connection, ORACLES[name]) == []


@pytest.mark.parametrize("name", [name for name in QUERIES if not hasattr(file_queries, name)])
def test_plan_has_no_python_and_no_product(spark, name):
    plan = plan_of(QUERIES[name](spark, FOLDER))
    # running values are windows by nature; what they are cut into has tests of its own
    windows = () if hasattr(load_queries, name) else ("Window ",)
    for node in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin", *windows):
        assert node not in plan, f"{node} in {name}"


@pytest.mark.parametrize(
    "name, filters",
    [
        ("filter_project", ["EqualTo(event_type,purchase)"]),
        ("star_one_dim", ["GreaterThanOrEqual(l_discount,0.01)", "LessThan(o_orderdate,1998"]),
        ("star_two_dim", ["EqualTo(p_type,PROMO)", "EqualTo(r_name,AMERICA)"]),
        ("star_drill", ["In(n_name, [NATION_1,NATION_5])", "LessThan(o_orderdate,1998"]),
        ("fact_enrich_left", ["EqualTo(l_returnflag,R)", "LessThanOrEqual(p_size,25)"]),
        ("fact_append", ["LessThan(ts,2024-01-10"]),
    ],
)
def test_filters_reach_the_scan(spark, name, filters):
    pushed = " ".join(re.findall(r"PushedFilters: \[(.*?)\], ReadSchema", plan_of(QUERIES[name](spark, FOLDER))))
    for expected in filters:
        assert expected in pushed


@pytest.mark.parametrize(
    "name, unread",
    [
        ("star_one_dim", ["l_tax", "l_shipdate", "o_totalprice"]),
        ("fact_summary", ["l_extendedprice", "l_orderkey"]),
        ("word_count", ["p_brand", "p_partkey"]),
        ("log_parse_hosts", ["html"]),
        ("filter_not_null", ["text"]),
    ],
)
def test_unused_columns_are_not_read(spark, name, unread):
    schemas = " ".join(re.findall(r"ReadSchema: (\S+)", plan_of(QUERIES[name](spark, FOLDER))))
    for column in unread:
        assert f"{column}:" not in schemas


def store(spark, folder, **tables):
    """Given tables with a few rows of their own."""
    for name, rows in tables.items():
        spark.createDataFrame(rows, GIVEN_TABLES[name]).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_single_gzip_holds_every_row_of_the_table(spark, tmp_path):
    parts = [(key, f"name {key}", "Brand#1", None if key == 3 else "PROMO", key, key / 8) for key in range(1, 6)]
    folder = store(spark, tmp_path, part=[*parts, parts[0], (None, "", " a|b ", None, None, None)])
    found = QUERIES["delimited_single_gzip"](spark, folder)
    assert found.columns == GIVEN_TABLES["part"].names
    assert sorted(map(repr, found.collect())) == sorted(map(repr, spark.read.parquet(f"{folder}/part.parquet").collect()))


@pytest.mark.parametrize("held", [1000, 3])
def test_local_lookup_counts_every_region_by_its_name(spark, tmp_path, monkeypatch, held):
    """Regions beyond the first five and of any name count, however many the driver may hold."""
    monkeypatch.setattr(file_queries, "LOCAL_ROWS", held)
    folder = store(
        spark,
        tmp_path,
        region=[(0, "NORTH"), (7, "SOUTH"), (8, None), (9, "EMPTY"), (None, "NONE")],
        nation=[(1, "a", 0), (2, "b", 7), (3, "c", 8), (4, "d", None)],
        customer=[(n, f"c{n}", nation, 1.0, "X") for n, nation in enumerate([1, 2, 2, 3, 4, None])],
    )
    found = QUERIES["local_lookup"](spark, folder)
    assert {(r.region, r.n) for r in found.collect()} == {("NORTH", 1), ("SOUTH", 2), (None, 1)}
