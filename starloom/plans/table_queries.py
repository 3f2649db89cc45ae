"""Every operator as a query over the given tables: name to function of (session, folder)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions import calendar, keys, text, wide
from starloom.operators import aggregates, joins, merge, nested, quality, rows
from starloom.plans import star_queries
from starloom.schemas import GIVEN_TABLES
from starloom.sources.tables import Tables

Query = Callable[[Tables], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def on_folder(function: Query) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, folder: function(Tables(spark, folder, GIVEN_TABLES))

    return {name: on_folder(function) for name, function in _QUERIES.items()}


def _moment(text_value: str):
    return F.lit(text_value).cast("timestamp_ntz")


# Projections and filters


@query
def filter_project(t: Tables) -> DataFrame:
    return rows.renamed(
        rows.where_value(t["events"], "event_type", "purchase"),
        {"event_id": "event_id", "user_id": "user_id", "ts": "start_time", "value": "value"},
    )


@query
def filter_not_null(t: Tables) -> DataFrame:
    known = t["documents"].where(F.col("lang").isNotNull() & (F.col("n_chars") != 0))
    return known.select("doc_id", "lang")


@query
def prefix_code(t: Tables) -> DataFrame:
    named = t["part"].where(F.col("p_name").isNotNull())
    return named.select(
        "p_partkey",
        text.first_token(F.col("p_name")).alias("outcode"),
        F.lit("United Kingdom").alias("country"),
    )


@query
def row_sum(t: Tables) -> DataFrame:
    summed = wide.columns_matching(t["part"], "^p_(retailprice|size)$")
    return t["part"].select("p_partkey", wide.row_sum(summed).alias("total_consumption"))


# Dimensions


@query
def dim_distinct(t: Tables) -> DataFrame:
    some = rows.where_value(t["events"], "event_type", ["purchase", "view"])
    return aggregates.distinct_rows(some, "user_id", "event_type")


@query
def dim_key_dedupe(t: Tables) -> DataFrame:
    parts = t["part"].select("p_name", "p_brand", "p_partkey")
    return rows.earliest_per_key(parts, ["p_name"], ["p_partkey"])


@query
def dim_user_latest(t: Tables) -> DataFrame:
    events = t["events"].select("user_id", "event_type", "value", "ts", "event_id")
    latest = rows.latest_per_key(events, ["user_id"], ["ts", "event_id"])
    return latest.select("user_id", "event_type", "value")


@query
def dim_user_first_seen(t: Tables) -> DataFrame:
    events = t["events"].select("user_id", "event_type", "ts", "event_id")
    first = rows.earliest_per_key(events, ["user_id"], ["ts", "event_id"])
    return first.select("user_id", "event_type")


@query
def dim_time(t: Tables) -> DataFrame:
    second = F.date_trunc("second", "ts").cast("timestamp_ntz").alias("start_time")
    moments = t["events"].select(second).distinct()
    return moments.select("start_time", *calendar.time_parts(F.col("start_time")))


@query
def dim_time_sunday0(t: Tables) -> DataFrame:
    days = t["orders"].select(F.to_date("o_orderdate").alias("d")).distinct()
    return days.select("d", calendar.day_of_week_sunday0(F.col("d")).alias("dayofweek"))


@query
def dim_date(t: Tables) -> DataFrame:
    days = t["orders"].select(F.to_date("o_orderdate").alias("d")).distinct()
    return days.select(*calendar.date_attributes(F.col("d"))).select(
        "d_datekey", "d_year", "d_yearmonthnum", "d_yearmonth", "d_daynuminyear"
    )


@query
def epoch_ms_to_second(t: Tables) -> DataFrame:
    seconds = calendar.epoch_ms_to_seconds(calendar.epoch_ms(F.col("ts")))
    return t["events"].select("event_id", seconds.alias("start_time"))


# Facts: returned line items are the plays, parts up to size 25 the catalogue


def _plays(t: Tables) -> DataFrame:
    returned = t["lineitem"].where("l_returnflag = 'R'")
    return joins.star_join(returned, (t["part"], "l_partkey", "p_partkey")).select(
        "l_orderkey",
        "l_linenumber",
        "l_suppkey",
        F.col("p_name").alias("song"),
        F.col("p_brand").alias("artist"),
        F.col("p_retailprice").alias("length"),
    )


def _catalogue(t: Tables) -> DataFrame:
    return t["part"].where("p_size <= 25").select("p_partkey", "p_name", "p_brand", "p_retailprice")


def _titled(t: Tables, shuffled: bool = False) -> DataFrame:
    matched = joins.match_catalogue(
        _plays(t).select("l_orderkey", "l_linenumber", "song"),
        _catalogue(t),
        on={"song": "p_name"},
        take=["p_partkey"],
        how="inner",
        one_match="p_partkey",
        shuffled=shuffled,
    )
    return matched.select("l_orderkey", "l_linenumber", "p_partkey")


@query
def fact_enrich_title(t: Tables) -> DataFrame:
    return _titled(t)


@query
def fact_enrich_title_artist(t: Tables) -> DataFrame:
    matched = joins.match_catalogue(
        _plays(t).select("l_orderkey", "l_linenumber", "song", "artist"),
        _catalogue(t),
        on={"song": "p_name", "artist": "p_brand"},
        take=["p_partkey"],
        how="inner",
        one_match="p_partkey",
    )
    return matched.select("l_orderkey", "l_linenumber", "p_partkey")


def _enriched(t: Tables, shuffled: bool = False) -> DataFrame:
    matched = joins.match_catalogue(
        _plays(t),
        _catalogue(t),
        on={"song": "p_name", "artist": "p_brand", "length": "p_retailprice"},
        take=["p_partkey"],
        round_to={"length": 3},
        shuffled=shuffled,
    )
    play_id = keys.hash_key("l_orderkey", "l_linenumber").alias("play_id")
    return matched.select(play_id, "l_orderkey", "p_partkey")


@query
def fact_enrich_left(t: Tables) -> DataFrame:
    return _enriched(t)


@query
def fact_enrich_left_spread(t: Tables) -> DataFrame:
    return _enriched(t, shuffled=True)


@query
def fact_enrich_title_spread(t: Tables) -> DataFrame:
    return _titled(t, shuffled=True)


@query
def fact_enrich_one_match(t: Tables) -> DataFrame:
    brand = F.concat(F.lit("Brand#"), (F.col("user_id") % 30).cast("string"))
    return joins.match_catalogue(
        t["events"].select("event_id", brand.alias("brand")),
        t["part"],
        on={"brand": "p_brand"},
        take=["p_partkey"],
        one_match="p_partkey",
    ).select("event_id", "p_partkey")


# Reports


@query
def star_one_dim(t: Tables) -> DataFrame:
    return star_queries.order_one_dim(t)


@query
def star_two_dim(t: Tables) -> DataFrame:
    return star_queries.order_two_dim(t)


@query
def star_drill(t: Tables) -> DataFrame:
    return star_queries.order_drill(t)


@query
def star_by_date(t: Tables) -> DataFrame:
    return star_queries.order_by_date(t)


@query
def star_report(t: Tables) -> DataFrame:
    # Orders meet their customers before the larger line items are shuffled to them.
    orders = joins.star_join(t["orders"], (t["customer"], "o_custkey", "c_custkey"))
    joined = joins.star_join(
        t["lineitem"],
        (t["supplier"], "l_suppkey", "s_suppkey"),
        (t["part"], "l_partkey", "p_partkey"),
        (orders, "l_orderkey", "o_orderkey"),
    )
    who = F.concat("c_name", F.lit(" "), "c_mktsegment")
    return joined.select("p_name", "s_name", who.alias("who"))


@query
def top_groups_with_ties(t: Tables) -> DataFrame:
    return aggregates.groups_with_ties(t["events"], "user_id", 10)


@query
def top_group_positions(t: Tables) -> DataFrame:
    return aggregates.positions(t["events"], "user_id", 3)


@query
def top_n_join(t: Tables) -> DataFrame:
    return joins.first_joined(
        t["lineitem"],
        [(t["supplier"], "l_suppkey", "s_suppkey"), (t["part"], "l_partkey", "p_partkey")],
        10,
        F.desc("l_extendedprice"),
        F.asc("l_orderkey"),
        F.asc("l_linenumber"),
        F.asc("l_partkey"),
    ).select("s_name", "p_name", "l_extendedprice")


@query
def monthly_revenue(t: Tables) -> DataFrame:
    return aggregates.sum_by_month(t["orders"], "o_orderdate", F.col("o_totalprice"), decimals=2)


@query
def monthly_unit_price(t: Tables) -> DataFrame:
    """Values of many decimals are added as they are."""
    price = F.col("l_extendedprice") / F.col("l_quantity")
    sums = aggregates.sum_by_month(t["lineitem"], "l_shipdate", price)
    return sums.select("y", "m", F.round("revenue", 4).alias("revenue"))


@query
def fact_summary(t: Tables) -> DataFrame:
    return aggregates.fact_summary(t["lineitem"], "l_quantity", "l_suppkey", decimals=6)


# Words, logs and nested values


@query
def word_count(t: Tables) -> DataFrame:
    return nested.word_count(t["part"], "p_name")


@query
def word_count_conversations(t: Tables) -> DataFrame:
    return nested.word_count(t["conversations"], "text")


@query
def tag_filter_count(t: Tables) -> DataFrame:
    tagged = text.annotate_words(F.col("text"), {"NNP": "^[A-Z][a-z]+$"})
    annotated = t["benchmark"].select("text", tagged.alias("pos"))
    return nested.tag_filter_count(annotated, "pos", ["NNP", "NNPS"], name="n")


@query
def log_parse_hosts(t: Tables) -> DataFrame:
    host = F.regexp_extract("url", "^https?://([^/]+)", 1).alias("host")
    return aggregates.count_by(t["pages"], host, name="n")


@query
def log_parse_paths(t: Tables) -> DataFrame:
    endpoint = F.regexp_extract("url", "^https?://[^/]+(/[^?#]*)", 1).alias("endpoint")
    return aggregates.count_by(t["pages"], endpoint, name="n")


@query
def log_parse_typed_top(t: Tables) -> DataFrame:
    number = F.regexp_extract("url", r"/([0-9]+)([?#]|$)", 1)
    numbered = t["pages"].select("page_id", number.alias("num")).where("num <> ''")
    typed = numbered.select("page_id", F.expr("try_cast(num AS int)").alias("num"))
    return rows.top_rows(typed, 10, F.desc("num"), F.asc("page_id"))


@query
def map_field(t: Tables) -> DataFrame:
    parsed = F.from_json("props", "map<string,int>").alias("props")
    return nested.map_values(t["events"].select("event_id", parsed), "props", ["k"], "event_id")


@query
def struct_field(t: Tables) -> DataFrame:
    packed = t["conversations"].select(F.struct("conv_id", "role", "text").alias("data"))
    return nested.struct_fields(packed, "data.conv_id", "data.role")


# Merges: the balances of target and batch overlap, so some customers are in both


def _customers(t: Tables) -> tuple[DataFrame, DataFrame]:
    customers = t["customer"].select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    return customers.where("c_acctbal < 5000"), customers.where("c_acctbal >= 0")


@query
def upsert_update(t: Tables) -> DataFrame:
    target, batch = _customers(t)
    batch = batch.withColumn("c_mktsegment", F.lit("UPDATED"))
    return merge.upsert_update(target.drop("c_acctbal"), batch, ["c_custkey"], ["c_acctbal"])


@query
def upsert_ignore(t: Tables) -> DataFrame:
    target, batch = _customers(t)
    batch = batch.withColumn("c_mktsegment", F.lit("NEW"))
    merged = merge.upsert_ignore(target, batch, ["c_custkey"], ["c_acctbal"])
    return merged.select("c_custkey", "c_mktsegment")


def _reloaded_users(t: Tables, shuffled: bool = False) -> DataFrame:
    events = t["events"].select("user_id", "event_type", "ts")
    staged = events.where(F.col("ts") >= _moment("2024-01-29"))
    return merge.delete_then_insert(
        target=events.where("event_type = 'view'").select("user_id", "event_type"),
        staged=staged,
        insert=staged.where("event_type = 'purchase'"),
        keys=["user_id"],
        shuffled=shuffled,
    )


@query
def delete_then_insert(t: Tables) -> DataFrame:
    return _reloaded_users(t)


@query
def delete_then_insert_spread(t: Tables) -> DataFrame:
    return _reloaded_users(t, shuffled=True)


@query
def fact_append(t: Tables) -> DataFrame:
    bought = t["events"].where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    target = bought.where(F.col("ts") < _moment("2024-01-10"))
    batch = bought.where(
        (F.col("ts") >= _moment("2024-01-05")) & (F.col("ts") < _moment("2024-01-20"))
    )
    merged = merge.fact_append(target, batch, ["event_id"], ["ts"])
    return merged.select("event_id", "user_id")


# Quality


@query
def dq_checks(t: Tables) -> DataFrame:
    rules = [quality.has_rows("orders"), quality.never_null("orders", "o_orderkey")]
    return quality.run_rules(t.spark, rules, t)


@query
def dq_constraints(t: Tables) -> DataFrame:
    return quality.constraints(
        [
            ("events.event_id unique", quality.repeated_keys(t["events"], "event_id")),
            (
                "lineitem (orderkey, linenumber) unique",
                quality.repeated_keys(t["lineitem"], "l_orderkey", "l_linenumber"),
            ),
            (
                "orders.o_custkey in customer",
                quality.orphans(t["orders"], "o_custkey", t["customer"], "c_custkey"),
            ),
        ]
    )
