"""Dimensions, facts, reports, logs and rules as queries over plays made from the given tables.

A purchase is a play, the user's number is the part that was played, and its name, brand and
price are title, artist and length. The parts are the song catalogue.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions import calendar, weblog
from starloom.operators import joins, quality
from starloom.plans import dimensions, facts, reports
from starloom.plans.table_queries import query
from starloom.sources.tables import Tables, named_views


def play_events(t: Tables) -> DataFrame:
    """Both tables grow, and a file is far smaller than its rows: parts never go through the driver."""
    played = joins.star_join(t["events"], (t["part"].hint("merge"), "user_id", "p_partkey"))
    return played.select(
        F.col("p_brand").alias("artist"),
        F.concat(F.lit("First"), "user_id").alias("firstName"),
        F.concat(F.lit("Last"), "user_id").alias("lastName"),
        F.lit(None).cast("string").alias("gender"),
        F.lit(0).alias("itemInSession"),
        F.col("p_retailprice").alias("length"),
        F.when(F.col("value") > 50, "paid").otherwise("free").alias("level"),
        F.lit(None).cast("string").alias("location"),
        F.when(F.col("event_type") == "purchase", dimensions.PLAY_PAGE)
        .otherwise(F.col("event_type"))
        .alias("page"),
        F.col("event_id").alias("sessionId"),
        F.col("p_name").alias("song"),
        calendar.epoch_ms(F.col("ts")).alias("ts"),
        F.lit(None).cast("string").alias("userAgent"),
        F.col("user_id").cast("string").alias("userId"),
    )


def song_records(t: Tables) -> DataFrame:
    return t["part"].select(
        F.col("p_brand").alias("artist_id"),
        F.col("p_brand").alias("artist_name"),
        F.col("p_type").alias("artist_location"),
        F.lit(None).cast("double").alias("artist_latitude"),
        F.lit(None).cast("double").alias("artist_longitude"),
        F.col("p_retailprice").alias("duration"),
        F.col("p_partkey").cast("string").alias("song_id"),
        F.col("p_name").alias("title"),
        F.col("p_size").alias("year"),
    )


def seen(songplays: DataFrame) -> DataFrame:
    started = F.col("start_time").cast("timestamp_ntz").alias("start_time")
    return songplays.select(
        "songplay_id", started, "user_id", "level", "song_id", "artist_id", "session_id", "month"
    )


def _star(t: Tables) -> dict[str, DataFrame]:
    events, catalogue = play_events(t), song_records(t)
    return {
        "users": dimensions.users(events),
        "songs": dimensions.songs(catalogue),
        "artists": dimensions.artists(catalogue),
        "songplays": facts.songplays(events, catalogue),
    }


@query
def play_users(t: Tables) -> DataFrame:
    return dimensions.users(play_events(t))


@query
def play_users_first(t: Tables) -> DataFrame:
    return dimensions.users(play_events(t), keep="first")


@query
def play_users_all(t: Tables) -> DataFrame:
    return dimensions.users(play_events(t), keep="all")


@query
def play_songs(t: Tables) -> DataFrame:
    return dimensions.songs(song_records(t))


@query
def play_artists(t: Tables) -> DataFrame:
    return dimensions.artists(song_records(t))


@query
def play_time(t: Tables) -> DataFrame:
    moments = dimensions.time(play_events(t))
    return moments.withColumn("start_time", F.col("start_time").cast("timestamp_ntz"))


@query
def play_time_of_facts(t: Tables) -> DataFrame:
    moments = dimensions.time_of_facts(facts.songplays(play_events(t), song_records(t)))
    return moments.withColumn("start_time", F.col("start_time").cast("timestamp_ntz"))


@query
def play_facts(t: Tables) -> DataFrame:
    return seen(facts.songplays(play_events(t), song_records(t)))


@query
def play_facts_title(t: Tables) -> DataFrame:
    plays = facts.songplays(play_events(t), song_records(t), match="title", how="inner")
    return plays.select("session_id", "song_id", "artist_id")


@query
def play_facts_title_artist(t: Tables) -> DataFrame:
    plays = facts.songplays(play_events(t), song_records(t), match="title_artist", how="inner")
    return plays.select("session_id", "song_id", "artist_id")


@query
def who_heard_what(t: Tables) -> DataFrame:
    return reports.who_heard_what(_star(t))


@query
def most_prolific_years(t: Tables) -> DataFrame:
    return reports.most_prolific_years(_star(t))


@query
def longest_songs(t: Tables) -> DataFrame:
    return reports.longest_songs(_star(t))


# Payments: an order is a payment


def _payments(t: Tables) -> DataFrame:
    return t["orders"].select(
        F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
        F.col("o_orderdate").alias("payment_date"),
    )


@query
def monthly_revenue_in_sql(t: Tables) -> DataFrame:
    return reports.revenue_per_month(_payments(t))


@query
def calendar_month_revenue(t: Tables) -> DataFrame:
    return reports.revenue_per_calendar_month(_payments(t))


@query
def calendar_days(t: Tables) -> DataFrame:
    """Every day between the first order and the last, with all its attributes."""
    return calendar.calendar_of(t["orders"], "o_orderdate")


# Access log: an event is a request


def log_lines(t: Tables) -> DataFrame:
    seconds = F.date_trunc("second", "ts").cast("timestamp")
    failed = F.col("event_type") == "error"
    line = F.concat_ws(
        " ",
        F.concat(F.lit("host"), "user_id"),
        F.lit("- -"),
        F.concat(F.lit("["), F.date_format(seconds, calendar.LOG_TIME_FORMAT), F.lit("]")),
        F.concat(F.lit('"GET /'), "event_type", F.lit("/"), F.col("event_id"), F.lit(' HTTP/1.0"')),
        F.when(failed, "500").otherwise("200"),
        F.when(failed, "-").otherwise(F.col("user_id").cast("string")),
    )
    return t["events"].select(line.alias("value"))


@query
def log_parse_lines(t: Tables) -> DataFrame:
    good, _ = weblog.parse_lines(log_lines(t))
    return weblog.typed(good).select(
        *["host", "method", "endpoint", "protocol", "response_code", "content_size_bytes"],
        F.col("logged_at").cast("timestamp_ntz").alias("logged_at"),
    )


@query
def log_parse_map(t: Tables) -> DataFrame:
    """The same lines by way of a map column."""
    parsed = weblog.parse_to_map(log_lines(t))
    return weblog.map_to_columns(parsed, ["host", "endpoint", "content_size"])


@query
def log_split_fields(t: Tables) -> DataFrame:
    """Host and size from a plain split."""
    parts = weblog.fields_by_split(F.col("value"))
    return log_lines(t).select(*[part.alias(name) for name, part in parts.items()])


@query
def log_popular_hosts(t: Tables) -> DataFrame:
    good, _ = weblog.parse_lines(log_lines(t))
    return reports.popular_hosts(good)


@query
def log_popular_content(t: Tables) -> DataFrame:
    good, _ = weblog.parse_lines(log_lines(t))
    return reports.popular_content(good)


@query
def log_largest_responses(t: Tables) -> DataFrame:
    good, _ = weblog.parse_lines(log_lines(t))
    return reports.largest_responses(weblog.typed(good))


# Rules as queries


@query
def dq_empty_rule(t: Tables) -> DataFrame:
    """A rule whose query gives no row fails, and fractions and unnamed columns are reported."""
    named_views({"ruled_orders": t["orders"]})
    rules = [
        quality.Rule("nothing found", "SELECT o_orderkey FROM ruled_orders WHERE o_orderkey < 0", "=", 0),
        quality.Rule("a fraction", "SELECT 0.4D FROM ruled_orders LIMIT 1", "<", 0.5),
    ]
    return quality.run_rules(t.spark, rules)


@query
def dq_rule_queries(t: Tables) -> DataFrame:
    named_views({"checked_orders": t["orders"]})
    rules = [
        quality.Rule("orders has rows", "SELECT count(1) FROM checked_orders", ">", 0),
        quality.Rule(
            "o_orderkey never null",
            "SELECT count(1) FROM checked_orders WHERE o_orderkey IS NULL",
            "=",
            0,
        ),
    ]
    return quality.run_rules(t.spark, rules)
