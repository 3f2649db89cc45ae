"""Reports on the star tables, the payments, the access log, the posts and the meter readings."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions import keys, text, wide
from starloom.operators import aggregates, joins, nested, rows


def who_heard_what(t: Mapping[str, DataFrame]) -> DataFrame:
    """Song title, artist name and full user name of every play with a known song."""
    played = t["songplays"].select("song_id", "artist_id", "user_id")
    full_name = keys.joined_text("first_name", "last_name").alias("full_name")
    joined = joins.star_join(
        played.toDF("play_song", "play_artist", "play_user"),
        (t["songs"].select("song_id", "title"), "play_song", "song_id"),
        (t["artists"].select("artist_id", "name"), "play_artist", "artist_id"),
        (t["users"].select("user_id", full_name), "play_user", "user_id"),
    )
    return joined.select("title", "name", "full_name")


def most_prolific_years(t: Mapping[str, DataFrame], places: int = 3) -> DataFrame:
    """Highest song counts per year, with the years that share each count."""
    dated = t["songs"].where(F.col("year") != 0)
    return aggregates.listed(aggregates.groups_with_ties(dated, "year", places)).select(
        F.col("num").alias("num_of_songs"), F.col("members").alias("years")
    ).orderBy(F.desc("num_of_songs"))


def longest_songs(t: Mapping[str, DataFrame], n: int = 10) -> DataFrame:
    """Artist name, title and duration of the longest songs."""
    artist = t["artists"].select(F.col("artist_id").alias("of_artist"), "name")
    return joins.first_joined(
        t["songs"],
        [(artist, "artist_id", "of_artist")],
        n,
        F.desc("duration"),
        F.asc("song_id"),
    ).select("name", "title", "duration")


def revenue_per_month(payments: DataFrame) -> DataFrame:
    """Revenue by year and month, asked in SQL on a named frame."""
    return payments.sparkSession.sql(
        """
        SELECT year(payment_date) AS y, month(payment_date) AS m,
               CAST(sum(amount) AS DOUBLE) AS revenue
        FROM {payments}
        GROUP BY year(payment_date), month(payment_date)
        """,
        payments=payments,
    )


def revenue_per_calendar_month(payments: DataFrame) -> DataFrame:
    """Revenue by month number, years together."""
    month = F.month("payment_date").alias("m")
    return aggregates.sum_by(payments, F.sum("amount").cast("double"), month)


def popular_hosts(log: DataFrame) -> DataFrame:
    return aggregates.count_by(log, "host", name="n")


def popular_content(log: DataFrame) -> DataFrame:
    return aggregates.count_by(log, "endpoint", name="n")


def largest_responses(typed_log: DataFrame, n: int = 10) -> DataFrame:
    """Largest responses by size as a number; sizes that are no number come last."""
    sized = typed_log.select("endpoint", "content_size_bytes", "host", "date_time")
    return rows.top_rows(
        sized,
        n,
        F.desc("content_size_bytes"),
        F.asc("endpoint"),
        F.asc("host"),
        F.asc("date_time"),
    ).select("endpoint", "content_size_bytes")


def title_words(posts: DataFrame, limit: int | None = None) -> DataFrame:
    """Word counts over the titles of posts with a nested `data` struct."""
    return nested.word_count(nested.struct_fields(posts, "data.title"), "title", limit)


def proper_nouns(annotated: DataFrame) -> DataFrame:
    """How often each proper noun occurs in annotated text."""
    # Tags of proper nouns.
    return nested.tag_filter_count(annotated, "pos", ["NNP", "NNPS"])


def consumption(readings: DataFrame, intervals: str = "_", nulls: str = "propagate") -> DataFrame:
    """Readings with an outward postcode, a country and the total over the interval columns."""
    summed = wide.columns_matching(readings, intervals)
    known = readings.where(F.col("postcode").isNotNull())
    return known.withColumns(
        {
            "Country": F.lit("United Kingdom"),
            "postcode": text.first_token(F.col("postcode")),
            "total_consumption": wide.row_sum(summed, nulls),
        }
    )
