"""Sources and sinks on small files."""

from __future__ import annotations

import json
from datetime import date, datetime
from decimal import Decimal

import pytest
from conftest import plan_of, values, write_lines
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom import schemas
from starloom.functions import keys
from starloom.operators import quality
from starloom.plans import load_check
from starloom.sinks import files as sinks
from starloom.sinks import layout, tables
from starloom.sources import files
from starloom.sources.tables import from_local, named_views

TRIPS = schemas.TableSpec(
    "trips",
    T.StructType(
        [T.StructField("bikeid", T.IntegerType()), T.StructField("tripduration", T.IntegerType())]
    ),
)


def test_json_folders_and_globs(spark, raw):
    for path in (f"{raw}/song_data", f"{raw}/song_data/*/*/*/*.json"):
        assert files.read_json(spark, path, schemas.SONG_CATALOGUE).count() == 5
    both = [f"{raw}/log_data/2018/11", f"{raw}/log_data/2018/12"]
    lenient = files.read_json(spark, both, schemas.PLAY_EVENTS, mode="PERMISSIVE")
    assert lenient.where("ts > 0").count() == 9


def test_json_inferred(spark, raw):
    inferred = files.read_json_inferred(spark, f"{raw}/song_data")
    assert dict(inferred.dtypes)["duration"] == "double"
    assert dict(inferred.dtypes)["year"] == "bigint"


def test_json_bad_lines(spark, raw, tmp_path):
    good, bad = files.read_json_checked(spark, f"{raw}/log_data", schemas.PLAY_EVENTS)
    assert (good.count(), bad.count()) == (9, 1)
    assert good.schema.names == schemas.PLAY_EVENTS.names
    rejected = bad.first()
    assert rejected.line.startswith('{"artist"') and "2018-11-25" in rejected.file
    write_lines(tmp_path / "typed/a.json", ['{"year": "soon", "title": "Blue"}'])
    good, bad = files.read_json_checked(spark, str(tmp_path / "typed"), schemas.SONG_CATALOGUE)
    assert (good.count(), bad.count()) == (0, 1)
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        files.read_json(spark, f"{raw}/log_data", schemas.PLAY_EVENTS, mode="FAILFAST").collect()


def test_staging_by_name_and_by_mapping(spark, tmp_path):
    schema = T.StructType(
        [
            T.StructField("userid", T.StringType()),
            T.StructField("level", T.StringType()),
            T.StructField("ts", T.LongType()),
        ]
    )
    lines = [json.dumps({"userId": 7, "info": {"plan": "paid"}, "ts": 5})]
    write_lines(tmp_path / "in/a.json", lines)
    raw = files.read_json_inferred(spark, str(tmp_path / "in"))
    assert values(files.by_name(raw, schema)) == [("7", None, 5)]
    paths = {"jsonpaths": ["$['userId']", "$.info.plan", "$['ts']"]}
    mapping_file = write_lines(tmp_path / "paths.json", [json.dumps(paths, indent=1)])
    mapping = files.mapping_from_paths_file(spark, mapping_file, schema.names)
    assert mapping == {"userid": "`userId`", "level": "`info`.`plan`", "ts": "`ts`"}
    assert values(files.by_mapping(raw, mapping, schema)) == [("7", "paid", 5)]
    with pytest.raises(ValueError, match="3 paths for 2 columns"):
        files.mapping_from_paths_file(spark, mapping_file, schema.names[:2])


def test_run_date_path():
    assert files.run_date_path("s3://bucket/log_data/", date(2018, 11, 25)) == (
        "s3://bucket/log_data/2018/11"
    )
    assert files.run_date_path("log_data") == "log_data"


def test_staging_table_is_reloaded(spark, raw):
    spec = schemas.TableSpec("staged_once", schemas.PLAY_EVENTS)
    tables.create_tables(spark, [spec])
    events = files.read_json(spark, f"{raw}/log_data/2018/12", schemas.PLAY_EVENTS)
    for _ in range(2):
        tables.load_table(events, "staged_once")
        assert spark.table("staged_once").count() == 1
    tables.append_rows(events, "staged_once")
    assert spark.table("staged_once").count() == 2
    tables.clear_table(spark, "staged_once")
    assert spark.table("staged_once").count() == 0
    tables.drop_tables(spark, [spec])
    assert not spark.catalog.tableExists("staged_once")


def test_append_matches_columns_by_name(spark):
    tables.create_tables(spark, [TRIPS])
    tables.append_rows(spark.sql("SELECT 60 AS tripduration, 1 AS bikeid"), "trips")
    assert values(spark.table("trips"), "bikeid", "tripduration") == [(1, 60)]
    tables.drop_tables(spark, [TRIPS])


def test_create_and_drop_star_tables(spark):
    for _ in range(2):
        tables.create_tables(spark, schemas.STAR_TABLES + schemas.SSB_TABLES, "fresh")
    created = {t.name for t in spark.catalog.listTables("fresh") if "__" not in t.name}
    assert created == {s.name for s in schemas.STAR_TABLES + schemas.SSB_TABLES}
    tables.drop_tables(spark, schemas.STAR_TABLES + schemas.SSB_TABLES, "fresh")
    assert spark.catalog.listTables("fresh") == []
    laid_out = schemas.laid_out(schemas.SSB_TABLES, 4)
    tables.create_tables(spark, laid_out, "fresh")
    described = spark.sql("DESCRIBE EXTENDED fresh.lineorder").where("col_name = 'Num Buckets'")
    assert described.first().data_type == "4"
    spark.sql("DROP DATABASE fresh CASCADE")


def test_publish_replaces_rows_read_from_itself(spark):
    tables.publish(spark.range(10), "published")
    for n in range(4):
        rows = spark.table("published")
        tables.publish(rows.where(F.col("id") != n), "published")
    assert values(spark.table("published")) == [(n,) for n in range(4, 10)]
    versions = [t.name for t in spark.catalog.listTables(None, "published__v*")]
    assert len(versions) == 2
    spark.sql("CREATE TABLE plain (id int) USING parquet")
    with pytest.raises(ValueError, match="plain table"):
        tables.publish(spark.range(1), "plain")


TICKET_ROWS = [
    f"{n};1.0;2.0;{n % 3};A;{n};12;{'' if n % 2 else '55.0'};{n}.50" for n in range(1, 21)
]


def test_gzip_parts_and_whole_file(spark, tmp_path):
    for n in range(4):
        write_lines(tmp_path / f"split/part-{n}.csv.gz", TICKET_ROWS[n * 5 : n * 5 + 5])
    write_lines(tmp_path / "full/full.csv.gz", TICKET_ROWS)
    options = {"schema": schemas.TICKETS, "sep": ";", "header_rows": 0}
    parts = files.read_delimited(spark, str(tmp_path / "split"), **options)
    whole = files.read_delimited(spark, str(tmp_path / "full/full.csv.gz"), spread=4, **options)
    assert values(parts) == values(whole)
    assert parts.where("ticketholder_id IS NULL").count() == 10
    assert values(parts, "id", "seat_level", "ticket_price")[0] == (
        1.0,
        Decimal("1"),
        Decimal("1.50"),
    )
    assert whole.rdd.getNumPartitions() == 4


PAYMENT_LINES = [
    "payment_id;customer_id;staff_id;rental_id;amount;payment_date",
    "1;1;1;1;2.99;2007-01-24 21:40:19.996577",
    "2;1;1;2;0.1;2007-01-31 23:59:59",
    "3;2;1;3;0.2;2007-02-01 00:00:00",
    "4;2;2;4;5.00;2008-02-15 10:00:00",
]


def test_payments(spark, tmp_path):
    from starloom.plans import reports

    path = write_lines(tmp_path / "payment.csv", PAYMENT_LINES)
    as_text = files.read_delimited(spark, path, header_rows=0)
    assert as_text.columns == ["_c0"] and as_text.count() == 5
    inferred = files.read_delimited(spark, path, sep=";", infer=True)
    assert dict(inferred.dtypes)["amount"] == "double"
    typed = files.read_delimited(spark, path, schemas.PAYMENTS, sep=";")
    assert typed.where("payment_id = 1").first().payment_date == datetime(
        2007, 1, 24, 21, 40, 19, 996577
    )
    expected = [(2007, 1, 3.09), (2007, 2, 0.2), (2008, 2, 5.0)]
    typed = typed.withColumn("amount", F.col("amount").cast("decimal(9,2)"))
    assert values(reports.revenue_per_month(typed)) == expected
    assert values(reports.revenue_per_calendar_month(typed)) == [(1, 3.09), (2, 5.2)]


def test_delimited_options(spark, tmp_path):
    write_lines(tmp_path / "trips-2018.csv", ["bikeid,tripduration", "1,60"])
    path = str(tmp_path / "trips-{year}.csv")
    assert files.read_delimited(spark, path, year=2018).collect() == [("1", "60")]
    with pytest.raises(ValueError):
        files.read_delimited(spark, path, TRIPS.schema, infer=True)
    with pytest.raises(ValueError):
        files.read_delimited(spark, path, header_rows=2)


def test_load_check_and_summary(spark, tmp_path):
    path = write_lines(
        tmp_path / "trips.csv", ["bikeid,tripduration", "1,60", "2,100", "2,300", "2,200"]
    )
    for _ in range(2):
        loaded = load_check.load_and_check(spark, path, TRIPS)
        assert loaded.count() == 4
    load_check.summarise(spark, "trips", "trips_facts", "tripduration", "bikeid")
    facts = spark.table("trips_facts")
    assert facts.columns == [
        "bikeid",
        "max_tripduration",
        "min_tripduration",
        "average_tripduration",
    ]
    assert values(facts) == [(1, 60, 60, 60.0), (2, 300, 100, 200.0)]
    empty = write_lines(tmp_path / "empty.csv", ["bikeid,tripduration"])
    with pytest.raises(quality.QualityError, match="trips has no rows"):
        load_check.load_and_check(spark, empty, TRIPS)


def test_parquet_overwrite_and_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, 2018, 11), (2, 2018, 12), (3, 2019, 1)], "id int, y int, m int")
    for _ in range(2):
        sinks.write_parquet(rows, path, ["y", "m"], ["id"])
    assert (tmp_path / "t/y=2018/m=12").is_dir()
    assert values(spark.read.parquet(path), "id", "y", "m") == values(rows)
    stored = spark.read.parquet(path)
    changed = stored.where("y = 2018 AND m = 12").withColumn("id", F.col("id") + 10)
    sinks.replace_partitions(changed, path, ["y", "m"])
    assert values(spark.read.parquet(path), "id") == [(1,), (12,), (3,)]
    sinks.write_parquet(rows.where("y = 2019"), path, ["y", "m"])
    assert values(spark.read.parquet(path), "id") == [(3,)]


def test_heavy_partition_is_split_over_tasks(spark, settings, tmp_path):
    settings(spark__sql__adaptive__advisoryPartitionSizeInBytes="64kb")
    rows = spark.range(0, 400_000, 1, 8).select(
        "id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 12).alias("month")
    )
    sinks.write_parquet(rows, str(tmp_path / "skewed"), ["month"], ["id"])
    assert len(list((tmp_path / "skewed/month=0").glob("*.parquet"))) > 1
    assert spark.read.parquet(str(tmp_path / "skewed")).count() == 400_000


def test_delimited_sinks(spark, tmp_path):
    rows = spark.range(0, 100, 1, 4).withColumn("name", F.lit("a\tb"))
    single = tmp_path / "single"
    sinks.write_delimited(rows, str(single), single_file=True)
    assert len(list(single.glob("*.csv"))) == 1
    back = files.read_delimited(spark, str(single), infer=True)
    assert values(back) == [(n, "a\tb") for n in sorted(range(100), key=lambda n: repr((n,)))]
    tabs = str(tmp_path / "tabs")
    sinks.write_delimited(rows, tabs, sep="\t", compression="gzip")
    assert files.read_delimited(spark, tabs, sep="\t").where("name = 'a\tb'").count() == 100


def test_text_local_rows_and_views(spark, tmp_path):
    path = write_lines(tmp_path / "lines.gz", ["one", "two"])
    assert values(files.read_lines(spark, path)) == [("one",), ("two",)]
    local = from_local(spark, [("a b c",), ("a b",)], "line string")
    named_views({"letters": local})
    assert spark.sql("SELECT count(*) AS n FROM letters").first().n == 2


def test_random_and_hash_keys(spark):
    rows = spark.range(100).withColumn("nothing", F.lit(None).cast("string"))
    assert rows.select(keys.random_key().alias("k")).distinct().count() == 100
    apart = spark.createDataFrame([("1", "23"), ("12", "3"), ("1", None)], "a string, b string")
    assert apart.select(keys.hash_key("a", "b").alias("k")).distinct().count() == 3
    assert rows.select(keys.hash_key("id", "nothing").alias("k")).where("k IS NULL").count() == 0


def test_layouts(spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    fact = spark.range(10_000).select(
        F.col("id").alias("order"), (F.col("id") % 100).alias("key"), F.lit(1).alias("n")
    )
    dimension = spark.range(100).select(F.col("id").alias("key"), F.lit("x").alias("name"))
    layout.write_bucketed(fact, "fact_by_key", "key", 4, ["order"])
    layout.write_bucketed(dimension, "dim_by_key", "key", 4)
    joined = spark.table("fact_by_key").join(spark.table("dim_by_key"), "key")
    assert "Exchange" not in plan_of(joined)
    assert joined.count() == 10_000
    plain = fact.join(dimension, "key")
    assert plan_of(plain).count("Exchange") == 2
    assert "BroadcastHashJoin" in plan_of(fact.join(layout.replicated(dimension), "key"))
    layout.write_sorted(fact, "fact_sorted", "order")
    assert spark.table("fact_sorted").where("order = 5").count() == 1


def test_heavy_sort_key_is_spread_over_files(spark, settings):
    settings(spark__sql__shuffle__partitions="8", spark__sql__adaptive__enabled="false")
    fact = spark.range(0, 20_000, 1, 4).select(
        "id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("day")
    )
    layout.write_sorted(fact, "sorted_heavy", "day")
    stored = spark.table("sorted_heavy")
    assert stored.where("day = 0").select("_metadata.file_name").distinct().count() > 1
    ranges = stored.groupBy("_metadata.file_name").agg(F.min("day"), F.max("day"))
    bounds = sorted(tuple(r)[1:] for r in ranges.collect())
    assert all(high <= low for (_, high), (low, _) in zip(bounds, bounds[1:]))
    assert stored.count() == 20_000
