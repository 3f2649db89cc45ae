"""Row, join, aggregate, merge and quality operators on small frames and against brute force."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from conftest import plan_of, values
from hypothesis import HealthCheck, given
from hypothesis import settings as examples
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starloom.operators import aggregates, joins, merge, quality, rows

FEW = examples(
    max_examples=8,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)

PAIRS = "k int, v int"


def some(spark, pairs, schema=PAIRS):
    return spark.createDataFrame(pairs, schema)


def test_latest_and_earliest_keep_nulls_and_column_order(spark):
    data = [("a", 1, None), ("a", 2, "new"), ("b", 1, "x"), (None, 5, "n"), (None, 6, None)]
    frame = some(spark, data, "v string, ts int, w string").select("w", "v", "ts")
    latest = rows.latest_per_key(frame, ["v"], ["ts"])
    assert latest.columns == ["w", "v", "ts"]
    assert values(latest) == sorted([("new", "a", 2), ("x", "b", 1), (None, None, 6)], key=repr)
    earliest = rows.earliest_per_key(frame, ["v"], ["ts"])
    assert values(earliest) == sorted([(None, "a", 1), ("x", "b", 1), ("n", None, 5)], key=repr)


def test_one_row_per_key_is_an_aggregate(spark):
    frame = some(spark, [(1, 2)])
    plan = plan_of(rows.latest_per_key(frame, ["k"], ["v"]))
    assert "partial_max" in plan and "Window" not in plan


def test_filters(spark):
    frame = some(spark, [("", 1), (None, 2), ("u", 3), ("u", None)], "user string, n int")
    assert values(rows.with_keys(frame, "user")) == [("u", 3), ("u", None)]
    assert values(rows.with_keys(frame, "user", "n")) == [("u", 3)]
    assert values(rows.where_value(frame, "n", [1, 3]), "n") == [(1,), (3,)]
    assert rows.renamed(frame, {"n": "count", "user": "who"}).columns == ["count", "who"]


# Joins


def skewed(spark, n=3000):
    """A third of the rows on one key, some null keys, some keys without a match."""
    generator = random.Random(7)
    data = []
    for i in range(n):
        key = 0 if i % 3 == 0 else None if i % 50 == 1 else generator.randrange(1, 400)
        data.append((key, f"s{key % 5 if key is not None else 9}", i))
    lookup = [(k, f"s{k % 5}", k * 10 + copy) for k in range(0, 300) for copy in range(1 + k % 2)]
    left = some(spark, data, "k int, s string, i int").repartition(4)
    return data, lookup, left, some(spark, lookup, "k int, s string, w int")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("shuffled", [False, True])
def test_key_join_against_brute_force(spark, how, shuffled):
    data, lookup, left, right = skewed(spark)
    by_key = {}
    for k, s, w in lookup:
        by_key.setdefault((k, s), []).append(w)
    expected = []
    for row in data:
        found = by_key.get(row[:2], [])
        if how in ("inner", "left"):
            expected += [(*row, w) for w in found]
            expected += [(*row, None)] if how == "left" and not found else []
        elif bool(found) == (how == "left_semi"):
            expected.append(row)
    joined = joins.key_join(left, right, ["k", "s"], how, shuffled)
    assert values(joined) == sorted(expected, key=repr)


def test_key_join_on_text_and_numbers_of_other_types(spark):
    """Text keys, zeros of either sign, NaN, and key types that differ between the sides."""
    nan = float("nan")
    keyed = [("a", 0.0, 1), ("a", -0.0, 2), ("b", nan, 3), (None, 1.0, 4)]
    found = [("a", -0.0, 1, 10), ("a", 0.0, 2, 20), ("b", nan, 3, 30), (None, 1.0, 4, 40)]
    left = some(spark, keyed, "s string, d double, k int")
    right = some(spark, found, "s string, d double, k bigint, w int")
    for on in (["s", "d"], ["k"], ["s", "k"], ["s", "d", "k"]):
        lookup = right.select(*on, "w")
        plain = left.join(lookup, on, "left").select(*left.columns, "w")
        spread = joins.key_join(left, lookup, on, "left", shuffled=True)
        assert repr(values(spread)) == repr(values(plain))  # as text, where NaN equals itself
    assert "_hash" in plan_of(joins.key_join(left, right.select("s", "d", "w"), ["s", "d"]))
    assert "_hash" not in plan_of(joins.key_join(left, right.select("s", "k", "w"), ["s", "k"]))


SKEWED = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "100b",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "100b",
    "spark__sql__adaptive__coalescePartitions__enabled": "false",
    "spark__sql__shuffle__partitions": "8",
}


@pytest.mark.parametrize("how", ["inner", "left", "left_anti"])
def test_equal_rows_of_a_heavy_key_go_to_several_tasks(spark, settings, how):
    settings(**SKEWED)
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k")
    rows = spark.range(0, 60_000, 1, 16).select(key, F.lit("view").alias("kind"))
    lookup = spark.range(1 if how == "left_anti" else 0, 60_000).select(F.col("id").alias("k"))
    joined = joins.key_join(rows, lookup, ["k"], how, shuffled=True)
    tasks = joined.where("k = 0").groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) > 3 and sum(r["count"] for r in tasks) == 20_000


def test_delete_then_insert_splits_a_heavy_key(spark, settings):
    settings(**SKEWED)
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k")
    target = spark.range(0, 60_000, 1, 16).select(key, F.lit("view").alias("kind"))
    staged = spark.range(1, 40_000, 1, 4).select(F.col("id").alias("k"), F.lit("buy").alias("kind"))
    merged = merge.delete_then_insert(target, staged, staged.limit(0), ["k"], shuffled=True)
    tasks = merged.where("k = 0").groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) > 3 and sum(r["count"] for r in tasks) == 20_000


def test_building_a_join_or_a_merge_runs_no_job(spark):
    _, _, left, right = skewed(spark)
    spark.sparkContext.setJobGroup("building", "")
    joins.key_join(left, right, ["k", "s"])
    joins.first_joined(left, [(right.select(F.col("k").alias("key")), "k", "key")], 3, F.desc("i"))
    batch = left.groupBy("k", "s").agg(F.max("i").alias("i"))
    for merged in (merge.upsert_update, merge.upsert_ignore, merge.fact_append):
        merged(left, batch, ["k"], ["i"])
    merge.delete_then_insert(left, batch, batch, ["k"])
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("building")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_merges_with_null_keys_can_be_repeated(spark):
    target = some(spark, [(None, "old"), (1, "old")], "k int, v string")
    batch = some(spark, [(None, "new"), (None, "newer"), (2, "new")], "k int, v string")
    for merged in (merge.upsert_update, merge.upsert_ignore, merge.fact_append):
        once = merged(target, batch, ["k"], ["v"])
        assert values(once) == values(merged(once, batch, ["k"], ["v"])) and once.count() == 3


def test_sums_lose_nothing(spark):
    rows = spark.range(1000).select(F.lit(0.004).alias("v"), F.lit(0).alias("k"))
    plain = aggregates.sum_by(rows, F.sum("v"), "k", name="total").first().total
    assert plain == pytest.approx(4.0)
    assert aggregates.sum_by(rows, aggregates.exact_sum(F.col("v"), 3), "k", name="total").first().total == 4.0
    with pytest.raises(Exception, match="more than 2 decimals"):
        aggregates.sum_by(rows, aggregates.exact_sum(F.col("v"), 2), "k").collect()


def test_star_join_leaves_heavy_partitions_to_adaptive_execution(spark, settings):
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="10kb",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="10kb",
        spark__sql__shuffle__partitions="8",
    )
    fact = spark.range(0, 200_000, 1, 8).select(
        "id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k")
    )
    joined = joins.star_join(fact, (spark.range(200_000).toDF("key"), "k", "key"))
    assert joined.agg(F.sum("id")).first()[0] == sum(range(200_000))
    total = joined.groupBy((F.col("id") % 7).alias("g")).agg(F.sum("id"))
    total.collect()
    assert "skew=true" in plan_of(total)


def test_first_joined_takes_rows_that_match(spark):
    fact = spark.range(1000).select("id", (F.col("id") % 100).alias("k"))
    few = spark.createDataFrame([(3, "x"), (4, "y")], "key int, name string")
    top = joins.first_joined(fact, [(few, "k", "key")], 3, F.desc("id"))
    assert [r.id for r in top.collect()] == [904, 903, 804]
    all_match = spark.range(100).toDF("key")
    top = joins.first_joined(fact, [(all_match, "k", "key")], 3, F.desc("id"))
    assert [r.id for r in top.collect()] == [999, 998, 997]


def test_matching_takes_lowest_and_rounds(spark):
    played = [("a", 1.00041), ("a", 1.001), ("b", None), (None, 1.0)]
    known = [("a", 1.0004, 9), ("a", 1.00044, 7), ("a", 2.0, 1), (None, 1.0, 5)]
    events = some(spark, played, "t string, d double")
    catalogue = some(spark, known, "t string, d double, id int")
    on = {"t": "t", "d": "d"}
    matched = joins.match_catalogue(
        events, catalogue, on, ["id"], round_to={"d": 3}, one_match="id"
    )
    assert values(matched) == sorted(
        [("a", 1.00041, 7), ("a", 1.001, None), ("b", None, None), (None, 1.0, None)], key=repr
    )
    every = joins.match_catalogue(events, catalogue, on, ["id"], "inner", {"d": 3})
    assert values(every, "id") == [(7,), (9,)]


# Aggregates


def test_ties_share_a_position(spark):
    plays = [u for u, n in [("a", 3), ("b", 3), ("c", 2), ("d", 1), ("e", 1)] for _ in range(n)]
    frame = some(spark, [(u,) for u in plays], "u string")
    groups = aggregates.groups_with_ties(frame, "u", 2)
    assert values(groups) == [(2, "c"), (3, "a"), (3, "b")]
    assert values(aggregates.listed(groups)) == [(2, "c"), (3, "a, b")]
    assert values(aggregates.positions(frame, "u", 2)) == [(1, "a", 3), (1, "b", 3), (2, "c", 2)]


def test_count_by_is_in_descending_order(spark):
    frame = some(spark, [(k, 0) for k in [1, 2, 2, 3, 3, 3]])
    assert [tuple(r) for r in aggregates.count_by(frame, "k").collect()] == [(3, 3), (2, 2), (1, 1)]


# Merges


keyed = st.lists(st.tuples(st.integers(0, 6), st.integers(0, 9)), max_size=12)
unique = st.dictionaries(st.integers(0, 6), st.integers(0, 9), max_size=6).map(
    lambda d: list(d.items())
)


@FEW
@given(target=unique, batch=keyed, seed=st.integers(0, 99))
def test_upserts_against_brute_force(spark, target, batch, seed):
    shuffled = random.Random(seed).sample(batch, len(batch))
    stored, new = some(spark, target), some(spark, shuffled)
    highest = {k: max(v for b, v in batch if b == k) for k, _ in batch}
    lowest = {k: min(v for b, v in batch if b == k) for k, _ in batch}

    updated = merge.upsert_update(stored, new, ["k"], ["v"])
    assert values(updated) == sorted((dict(target) | highest).items(), key=repr)
    ignored = merge.upsert_ignore(stored, new, ["k"], ["v"])
    assert values(ignored) == sorted((lowest | dict(target)).items(), key=repr)


@FEW
@given(target=keyed, staged=keyed)
def test_delete_then_insert_against_brute_force(spark, target, staged):
    stored, new = some(spark, target), some(spark, staged)
    keys = {k for k, _ in staged}
    expected = [row for row in target if row[0] not in keys]
    expected += {row for row in staged if row[1] > 4}
    once = merge.delete_then_insert(stored, new, new.where("v > 4"), ["k"])
    assert Counter(values(once)) == Counter(expected)
    twice = merge.delete_then_insert(once, new, new.where("v > 4"), ["k"])
    assert values(twice) == values(once)


def test_merges_repeat(spark):
    target, batch = some(spark, [(1, 1), (2, 2)]), some(spark, [(2, 5), (3, 6), (3, 7)])
    for function in (merge.upsert_update, merge.upsert_ignore, merge.fact_append):
        once = function(target, batch, ["k"], ["v"])
        assert values(function(once, batch, ["k"], ["v"])) == values(once)


def test_null_keys_of_the_target_stay(spark):
    target, batch = some(spark, [(None, 1), (1, 1)]), some(spark, [(1, 2), (None, 3)])
    kept = merge.delete_then_insert(target, batch, batch.where("v = 2"), ["k"])
    assert values(kept) == [(1, 2), (None, 1)]


# Quality


@pytest.mark.parametrize(
    "op, passing, failing", [("=", 3, 4), ("!=", 4, 3), ("<", 4, 3), (">", 2, 3)]
)
def test_rules(spark, op, passing, failing):
    tables = {"t": some(spark, [(1, 1), (2, 2), (None, 3)])}
    tables["t"].createOrReplaceTempView("t")
    rules = [
        quality.Rule("aggregate passes", quality.row_count(), op, passing, "t"),
        quality.Rule("aggregate fails", quality.row_count(), op, failing, "t"),
        quality.Rule("query passes", "SELECT count(1) FROM t", op, passing),
        quality.Rule("query fails", "SELECT count(1) FROM t", op, failing),
    ]
    results = quality.run_rules(spark, rules, tables)
    outcomes = {r.test_name: r for r in results.collect()}
    assert {name: o.success for name, o in outcomes.items()} == {
        r.name: r.name.endswith("passes") for r in rules
    }
    assert outcomes["query fails"].actual == 3 and outcomes["query fails"].expected == failing
    with pytest.raises(quality.QualityError, match="aggregate fails: 3.0 should be"):
        quality.require(results)
    assert len(quality.require(results.where("success"))) == 2


def test_rules_take_one_pass_per_table(spark, tmp_path):
    path = str(tmp_path / "t")
    some(spark, [(1, 1)]).write.parquet(path)
    table = spark.read.parquet(path)
    rules = [
        quality.has_rows("t"),
        quality.never_null("t", "k"),
        quality.Rule("largest", F.max("v"), "<", 5, "t"),
        quality.Rule("no value", F.max(F.lit(None).cast("int")), ">", 5, "t"),
    ]
    results = quality.run_rules(spark, rules, {"t": table})
    assert plan_of(results).count("FileScan") == 1
    assert [r.success for r in results.collect()] == [True, True, True, False]
    with pytest.raises(ValueError, match="no comparison"):
        quality.run_rules(spark, [quality.Rule("bad", F.max("v"), ">=", 5, "t")], {"t": table})


def test_constraint_counts(spark):
    child = some(spark, [(1, 1), (1, 2), (9, 3), (9, 4), (None, 5)])
    parent = some(spark, [(1, 0), (2, 0)])
    assert quality.orphans(child, "k", parent, "k").first().violations == 2
    assert quality.repeated_keys(child, "k").first().violations == 2
    assert quality.missing_values(child, "k").first().violations == 1
    assert quality.orphans(child.limit(0), "k", parent, "k").first().violations == 0
