"""Row numbers, merges by parts, running frames and interval joins against brute force."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta
from urllib.parse import urlparse

import pyarrow.parquet as parquet
import pytest
from conftest import plan_of
from pyspark.sql import Window
from pyspark.sql import functions as F

from starloom import schemas
from starloom.functions import calendar
from starloom.operators import intervals, numbering
from starloom.operators.frames import Running, running
from starloom.sinks import layout, tables


@pytest.fixture
def folder(tmp_path):
    count = iter(range(100))
    return lambda: str(tmp_path / f"stage{next(count)}")


# Row numbers


def test_numbers_have_no_gaps_and_follow_the_order(spark, folder):
    rng = random.Random(1)
    rows = [(k, rng.choice((None, 1.5, 2.0, 9.0)), "t") for k in range(500)]
    frame = spark.createDataFrame(rows, "id long, v double, number string").drop("number").repartition(7)
    want = [k for k, v, _ in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[0]))]
    for after in (0, 40):
        got = numbering.numbered(frame, "no", ["v", "id"], folder(), after).collect()
        assert [r.id for r in sorted(got, key=lambda r: r.no)] == want
        assert sorted(r.no for r in got) == list(range(after + 1, after + 501))


def test_equal_rows_get_a_number_each_in_several_tasks(spark, folder, settings):
    settings(spark__sql__adaptive__coalescePartitions__enabled="false")
    frame = spark.range(3000).select((F.col("id") % 3).alias("v"), F.lit(7).alias("heavy"), "id")
    path = folder()
    got = numbering.numbered(frame, "no", ["heavy"], path).agg(F.countDistinct("no"), F.max("no")).first()
    assert tuple(got) == (3000, 3000)
    tasks = spark.read.parquet(path).select(F.shiftright("_place", 33)).distinct().count()
    assert tasks > 1  # one value of the order, not one task
    same = numbering.numbered(frame.select("heavy"), "no", ["heavy"], folder())
    assert sorted(r.no for r in same.collect()) == list(range(1, 3001))


def test_numbers_of_nothing(spark, folder):
    assert numbering.numbered(spark.range(0), "no", ["id"], folder(), 5).collect() == []


def test_only_the_counts_of_tasks_are_numbered_in_one_task(spark, folder):
    plan = plan_of(numbering.numbered(spark.range(100), "no", ["id"], folder()))
    assert plan.count("Exchange SinglePartition") == 1
    assert "partial_count" in plan[plan.index("Exchange SinglePartition") :]


def numbered_table(spark, name):
    schema = spark.createDataFrame([], "no long, id long, at long, kind string").schema
    tables.create_tables(spark, [schemas.TableSpec(name, schema)])
    return lambda: sorted(map(tuple, tables.current(spark, name).collect()))


def test_numbers_go_on_over_loads(spark, folder):
    read = numbered_table(spark, "numbered_loads")
    batch = lambda rows: spark.createDataFrame(rows, "id long, at long, kind string")

    def load(rows):
        tables.append_numbered(batch(rows), "numbered_loads", "no", ["id"], ["at"], folder())

    load([(5, 1, "a"), (3, 2, "b"), (5, 0, "first")])
    first = [(1, 5, 0, "first"), (2, 3, 2, "b")]
    assert read() == first
    load([(3, 9, "again"), (5, 9, "again")])  # nothing new
    assert read() == first
    load([])
    load([(9, 5, "c"), (None, 4, "no id"), (5, 1, "a"), (8, 5, "d")])
    assert read() == first + [(3, None, 4, "no id"), (4, 8, 5, "d"), (5, 9, 5, "c")]
    load([(None, 1, "no id either"), (9, 0, "x")])  # a null key is a key
    assert len(read()) == 5


def test_a_failed_load_uses_up_no_numbers(spark, folder, monkeypatch):
    read = numbered_table(spark, "numbered_retry")
    rows = spark.range(50).select("id", (50 - F.col("id")).alias("at"), F.lit("k").alias("kind"))
    append = tables.append_rows

    def broken(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(tables, "append_rows", broken)
    with pytest.raises(RuntimeError):
        tables.append_numbered(rows, "numbered_retry", "no", ["id"], ["at"], folder())
    assert read() == []
    monkeypatch.setattr(tables, "append_rows", append)
    tables.append_numbered(rows.repartition(5), "numbered_retry", "no", ["id"], ["at"], folder())
    assert read() == [(k, 50 - k, k, "k") for k in range(1, 51)]


# Merges by parts


def files_by_part(spark, name):
    found = {}
    for row in spark.table(tables.parts_name(name)).select(tables.PART, F.input_file_name().alias("file")).distinct().collect():
        found.setdefault(row[tables.PART], set()).add(row.file)
    return found


def test_a_merge_rewrites_the_parts_it_changes_only(spark):
    people = spark.range(400).select(F.col("id").cast("string").alias("key"), F.lit("old").alias("state"), F.lit(1).alias("at"))
    spec = schemas.TableSpec("parted", people.drop("at").schema, keys=("key",), parts=16)
    tables.create_tables(spark, [spec])
    merge = lambda batch: tables.merge_into_parts(batch, "parted", ["key"], ["at"])
    read = lambda: {r.key: r.state for r in tables.current(spark, "parted").collect()}
    assert merge(people) == list(range(16)) and read() == {str(k): "old" for k in range(400)}
    before = files_by_part(spark, "parted")

    assert merge(people) == [] and files_by_part(spark, "parted") == before  # comes again: nothing is written

    late = spark.createDataFrame([("7", "newest", 9), ("7", "new", 8), ("new key", "added", 1), ("8", "old", 5)], "key string, state string, at int")
    touched = merge(late)
    after = files_by_part(spark, "parted")
    home = {r.key: r.part for r in late.select("key", tables.part_of(["key"], 16).alias("part")).collect()}
    assert touched == sorted({home["7"], home["new key"]})
    assert {part for part in before if before[part] != after[part]} == set(touched)
    assert read() == {**{str(k): "old" for k in range(400)}, "7": "newest", "new key": "added"}

    merge(spark.createDataFrame([(None, "a", 1)], "key string, state string, at int"))
    merge(spark.createDataFrame([(None, "b", 1)], "key string, state string, at int"))
    assert read()[None] == "b" and len(read()) == 402
    assert merge(people.limit(0)) == []
    tables.drop_tables(spark, [spec])
    assert not spark.catalog.tableExists("parted") and not spark.catalog.tableExists("parted__parts")


def test_only_the_parts_of_the_batch_are_read(spark):
    people = spark.range(200).select(F.col("id").alias("key"), F.lit("x").alias("state"))
    tables.create_tables(spark, [schemas.TableSpec("parted_reads", people.schema, keys=("key",), parts=8)])
    tables.merge_into_parts(people, "parted_reads", ["key"], ["state"])
    part = tables.part_of(["key"], 8)
    here = people.where(part == 3)
    scan = plan_of(tables.current(spark, "parted_reads__parts").where(F.col(tables.PART).isin([3])))
    assert "PartitionFilters: [isnotnull(key_part" in scan
    assert tables.merge_into_parts(here.withColumn("state", F.lit("y")), "parted_reads", ["key"], ["state"]) == [3]
    assert spark.table("parted_reads").where("state = 'y'").count() == here.count()


# Running values

START = datetime(2024, 1, 1)


def moments(seed, n=400):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        who = rng.choice(("heavy",) * 6 + ("a", "b", None))
        at = None if rng.random() < 0.03 else START + timedelta(hours=rng.randrange(0, 200))
        rows.append((k, who, at, None if rng.random() < 0.3 else rng.randrange(50), None if rng.random() < 0.5 else rng.choice("xyz")))
    return rows


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("piece", ["hour", "day", "year"])
def test_running_values_are_those_of_the_window(spark, descending, piece):
    events = spark.createDataFrame(moments(3), "id long, who string, at timestamp_ntz, n long, word string").repartition(5)
    values = {
        "total": Running("sum", "n"), "known": Running("count", "n"), "least": Running("min", "n"),
        "most": Running("max", "n"), "word_then": Running("last", "word", ties="id"),
    }
    got = running(events, ["who"], "at", values, descending, piece)
    order = F.col("at").desc_nulls_last() if descending else F.col("at").asc_nulls_first()
    frame = Window.partitionBy("who").orderBy(order).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    # of equal moments the lowest id counts, so it has to come last for `last`
    exact = Window.partitionBy("who").orderBy(order, F.desc("id"))
    peers = Window.partitionBy("who", "at")
    last = F.last("word", ignorenulls=True).over(exact.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    want = events.select(
        "*", F.sum("n").over(frame).alias("total"), F.count("n").over(frame).alias("known"), F.min("n").over(frame).alias("least"),
        F.max("n").over(frame).alias("most"), last.alias("_last"),
    ).withColumn("word_then", F.min_by("_last", "id").over(peers)).drop("_last")
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.select(*got.columns).collect()))


def test_a_heavy_key_runs_in_many_pieces(spark):
    events = spark.range(2000).select(
        (F.col("id") % 1).alias("who"), F.timestamp_add("MINUTE", (F.col("id") * 20).cast("int"), F.lit("2024-01-01").cast("timestamp")).alias("at"), F.lit(1).alias("n")
    )
    got = running(events, ["who"], "at", {"total": Running("sum", "n")})
    assert sorted(r.total for r in got.collect()) == list(range(1, 2001))
    plan = plan_of(got)
    assert "Python" not in plan and "Exchange SinglePartition" not in plan
    # the long window goes by key and piece; the one by key alone has a row a piece
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert any("[who" in line and "_piece" in line.split("],")[1] for line in windows)


def test_unknown_running_values_are_refused(spark):
    with pytest.raises(ValueError):
        running(spark.range(1), ["id"], "id", {"x": Running("median", "id")})


# Intervals


def test_points_meet_the_intervals_they_lie_in(spark):
    rng = random.Random(4)
    points = [(k, None if k % 17 == 0 else rng.randrange(-60, 60), "p") for k in range(150)] + [(900, 31, "p"), (901, -32, "p"), (902, 10**9, "p")]
    spans = [(k, rng.choice((None, rng.randrange(-70, 60))), rng.choice((None, rng.randrange(-60, 70))), "i") for k in range(60)]
    spans += [(100, 5, 5, "i"), (101, 6, 5, "i"), (102, None, None, "i"), (103, -64, 63, "i"), (104, -1, 0, "i"), (104, -1, 0, "i")]
    left = spark.createDataFrame(points, "id long, at long, tag string")
    right = spark.createDataFrame(spans, "span long, lo long, hi long, kind string")
    for bits in (8, intervals.BITS):
        got = intervals.interval_join(left, F.col("at"), right, F.col("lo"), F.col("hi"), bits)
        half = 1 << (bits - 1)
        want = [
            (p, a, "p", s, lo, hi, "i")
            for p, a, _ in points
            for s, lo, hi, _ in spans
            if a is not None and -half <= a < half and (lo is None or lo <= a) and (hi is None or a <= hi)
        ]
        assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
        assert "NestedLoop" not in plan_of(got) and "Cartesian" not in plan_of(got)


def test_an_interval_is_cut_into_few_blocks(spark):
    spans = spark.createDataFrame([(0, 100_000), (7, 7), (3, 1_000_001), (5, 4)], "lo long, hi long")
    cut = spans.select("lo", "hi", F.explode(intervals._cover(F.col("lo"), F.col("hi"), 22)).alias("b"))
    sizes = {(r.lo, r.hi): (r.n, r.total) for r in cut.groupBy("lo", "hi").agg(F.count("*").alias("n"), F.sum(F.expr("shiftleft(1, b.level)")).alias("total")).collect()}
    assert {span: total for span, (_, total) in sizes.items()} == {(0, 100_000): 100_001, (7, 7): 1, (3, 1_000_001): 999_999}
    assert max(n for n, _ in sizes.values()) <= 40


def test_no_points_or_no_intervals(spark):
    some, none = spark.range(3), spark.createDataFrame([], "lo long, hi long")
    assert intervals.interval_join(some, F.col("id"), none, F.col("lo"), F.col("hi")).collect() == []
    assert intervals.interval_join(some.limit(0), F.col("id"), spark.range(2).select(F.col("id").alias("lo")), F.col("lo"), F.col("lo")).collect() == []


def test_seasons_and_holidays(spark):
    rng = random.Random(8)
    rules = [
        ("season", "cold", None, None, 1105, 310, 1), ("season", "warm", None, None, 401, 930, 1),
        ("season", "early", date(2020, 3, 1), date(2020, 4, 15), None, None, 2), ("season", "alike", date(2020, 3, 1), date(2020, 4, 15), None, None, 2),
        ("season", "later", date(2021, 6, 1), None, None, None, 5), ("season", "leap", None, None, 229, 229, 9),
        ("holiday", "new year", None, None, 101, 101, 1), ("holiday", "until", None, date(2020, 12, 31), 501, 501, 1),
        ("holiday", "once", date(2021, 2, 3), date(2021, 2, 4), None, None, 1), ("holiday", "spring", None, None, None, 105, 1),
    ]
    days = [date(2019, 12, 1) + timedelta(days=k) for k in range(800)]
    rows = [(day, k) for k, day in enumerate(days)] + [(None, -1), (days[40], -2)]
    rng.shuffle(rows)
    got = calendar.with_rules(spark.createDataFrame(rows, "day date, k int"), "day", spark.createDataFrame(rules, calendar.RULE)).collect()

    def holds(day, first, last, low, high):
        mmdd = day.month * 100 + day.day
        if (first and day < first) or (last and day > last):
            return False
        if low and high and low > high:
            return mmdd >= low or mmdd <= high
        return (low or 101) <= mmdd <= (high or 1231)

    want = []
    for day, k in rows:
        found = [r for r in rules if day and holds(day, *r[2:6])]
        season = min(((-r[6], r[1]) for r in found if r[0] == "season"), default=(0, None))[1]
        want.append((day, k, season, "1" if any(r[0] == "holiday" for r in found) else "0"))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert {w[2] for w in want} == {"cold", "warm", "alike", "later", "leap", None}


# Layout


def files_to_read(spark, name, column, low, high):
    """Share of a table's row groups that a filter on a column has to read, by their statistics."""
    groups = hit = 0
    for path in spark.table(name).inputFiles():
        about = parquet.ParquetFile(urlparse(path).path).metadata
        at = [about.schema.column(k).name for k in range(about.num_columns)].index(column)
        for k in range(about.num_row_groups):
            found = about.row_group(k).column(at).statistics
            groups += 1
            hit += found is None or not found.has_min_max or (found.min <= high and found.max >= low)
    return hit / groups


def test_a_filter_on_any_key_of_a_curve_skips_files(spark, settings):
    settings(spark__sql__adaptive__coalescePartitions__enabled="false", spark__sql__shuffle__partitions="64")
    rng = random.Random(3)
    rows = [(rng.randrange(1000), rng.choice((7, rng.randrange(5000))), None if k % 100 == 0 else rng.choice("abcdefgh") * 3, k) for k in range(20_000)]
    frame = spark.createDataFrame(rows, "day int, customer long, word string, id int")
    layout.write_sorted(frame, "in_order", "day", "customer")
    layout.write_curved(frame, "on_curve", "day", "customer")
    layout.write_curved(frame, "on_long_curve", "day", "word", "customer", bits=5)
    for name in ("on_curve", "on_long_curve"):
        assert sorted(map(repr, spark.table(name).collect())) == sorted(map(repr, frame.collect()))
    assert files_to_read(spark, "in_order", "customer", 1000, 1100) > 0.9
    for column, low, high in (("day", 200, 220), ("customer", 1000, 1100)):
        assert files_to_read(spark, "on_curve", column, low, high) < 0.45  # half of all rows are of customer 7
    assert files_to_read(spark, "on_long_curve", "word", "bbb", "bbb") < 0.8
    layout.write_curved(frame.limit(0), "empty_curve", "day", "customer")
    assert spark.table("empty_curve").count() == 0


def test_places_on_the_curve(spark):
    cuts = [2.0, 3.0, 3.5]
    numbers = spark.createDataFrame([(x,) for x in (None, -1.0, 2.0, 2.5, 3.0, 3.4, 9.0)], "x double")
    got = [r[0] for r in numbers.select(layout._place(F.col("x"), cuts, 2)).collect()]
    assert got == [0, 0, 1, 1, 2, 2, 3]
    pairs = spark.createDataFrame([(a, b) for a in range(8) for b in range(8)], "a long, b long")
    for a, b, curve in pairs.select("a", "b", layout.interleaved([F.col("a"), F.col("b")], 3)).collect():
        assert format(curve, "06b") == "".join(x + y for x, y in zip(format(a, "03b"), format(b, "03b")))


def test_only_small_dimensions_are_replicated(spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    fact, dimension = spark.range(100).withColumnRenamed("id", "key"), spark.range(50).withColumnRenamed("id", "key")
    assert "BroadcastHashJoin" in plan_of(fact.join(layout.replicated(dimension), "key"))
    large = fact.join(layout.replicated(dimension, most_rows=49), "key")
    assert "BroadcastHashJoin" not in plan_of(large) and large.count() == 50
