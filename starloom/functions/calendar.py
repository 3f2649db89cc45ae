"""Epochs, timestamps and the calendar attributes derived from them (all in UTC)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators.intervals import interval_join

# Fixed value: date layout of a web access log.
LOG_TIME_FORMAT = "dd/MMM/yyyy:HH:mm:ss Z"


def epoch_ms(moment: Column) -> Column:
    return F.unix_millis(moment.cast("timestamp"))


def epoch_ms_to_seconds(ms: Column) -> Column:
    """Whole seconds as bigint; stays in integer arithmetic, so no rounding up."""
    return F.call_function("div", ms, F.lit(1000))


def ms_to_timestamp(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def seconds_to_timestamp(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def parse_timestamp(text: Column, layout: str | None = None) -> Column:
    """Text to timestamp; dirty text gives null instead of failing the job."""
    return F.try_to_timestamp(text, F.lit(layout)) if layout else F.try_to_timestamp(text)


def parse_log_time(text: Column) -> Column:
    return parse_timestamp(text, LOG_TIME_FORMAT)


def day_of_week_sunday0(moment: Column) -> Column:
    return F.dayofweek(moment) - F.lit(1)


def time_parts(moment: Column) -> list[Column]:
    """hour, day, ISO week, month, year and weekday with Monday as 0."""
    return [
        F.hour(moment).alias("hour"),
        F.dayofmonth(moment).alias("day"),
        F.weekofyear(moment).alias("week"),
        F.month(moment).alias("month"),
        F.year(moment).alias("year"),
        F.weekday(moment).alias("weekday"),
    ]


def date_attributes(day: Column) -> list[Column]:
    """Attributes of a calendar day that follow from the day; `with_rules` adds season and holiday."""
    flag = lambda condition: F.when(condition, F.lit("1")).otherwise(F.lit("0"))
    return [
        F.date_format(day, "yyyyMMdd").cast("int").alias("d_datekey"),
        F.date_format(day, "MMMM d, yyyy").alias("d_date"),
        F.date_format(day, "EEEE").alias("d_dayofweek"),
        F.date_format(day, "MMMM").alias("d_month"),
        F.year(day).alias("d_year"),
        (F.year(day) * 100 + F.month(day)).alias("d_yearmonthnum"),
        F.date_format(day, "MMMyyyy").alias("d_yearmonth"),
        F.dayofweek(day).alias("d_daynuminweek"),
        F.dayofmonth(day).alias("d_daynuminmonth"),
        F.dayofyear(day).alias("d_daynuminyear"),
        F.month(day).alias("d_monthnuminyear"),
        F.weekofyear(day).alias("d_weeknuminyear"),
        flag(F.dayofweek(day) == 7).alias("d_lastdayinweekfl"),
        flag(day == F.last_day(day)).alias("d_lastdayinmonthfl"),
        flag(F.weekday(day) < 5).alias("d_weekdayfl"),
    ]


def calendar(spark: SparkSession, first: date, last: date) -> DataFrame:
    """One row per day from `first` to `last`, both included, with its attributes."""
    bounds = spark.createDataFrame([(first, last)], "first date, last date")
    return _days(bounds)


def calendar_of(rows: DataFrame, moment: str) -> DataFrame:
    """One row per day from the earliest to the latest day of the rows, with its attributes."""
    day = F.to_date(moment)
    return _days(rows.agg(F.min(day).alias("first"), F.max(day).alias("last")))


def _days(bounds: DataFrame) -> DataFrame:
    days = bounds.select(F.explode(F.sequence("first", "last")).alias("day"))
    return days.select(*date_attributes(F.col("day")))


# What a rule says: from `first` to `last` (null: open), each year from `first_mmdd` to `last_mmdd`
# (null: all year; over New Year if the first is the later one), a day has this season, or is a
# holiday. Of several seasons of a day the one of the highest priority counts, then the first name.
RULE = "kind string, name string, first date, last date, first_mmdd int, last_mmdd int, priority int"
SEASON, HOLIDAY = "season", "holiday"


def with_rules(days: DataFrame, day: str, rules: DataFrame) -> DataFrame:
    """Adds d_sellingseason (null if no rule names one) and d_holidayfl to rows with a day.

    Rules are joined to distinct days as intervals, those of dates and those of each year alike;
    a rule that has both kinds of bounds holds where both do.
    """
    distinct = days.select(F.col(day).alias("_day")).where("_day is not null").distinct()
    wraps = F.col("first_mmdd") > F.col("last_mmdd")
    once = F.struct(F.col("first_mmdd").alias("low"), F.col("last_mmdd").alias("high"))
    until, since = F.struct(F.lit(101).alias("low"), F.col("last_mmdd").alias("high")), F.struct(
        F.col("first_mmdd").alias("low"), F.lit(1231).alias("high")
    )
    yearly = F.col("first_mmdd").isNotNull() | F.col("last_mmdd").isNotNull()
    of_year = rules.where(yearly).withColumn("_part", F.explode(F.when(wraps, F.array(until, since)).otherwise(F.array(once))))
    mmdd = F.month("_day") * 100 + F.dayofmonth("_day")
    by_year = interval_join(distinct, mmdd, of_year, F.col("_part.low"), F.col("_part.high"), bits=12)
    by_date = interval_join(distinct, F.unix_date("_day"), rules.where(~yearly), F.unix_date("first"), F.unix_date("last"))
    in_dates = (F.col("_day") >= F.coalesce("first", "_day")) & (F.col("_day") <= F.coalesce("last", "_day"))
    held = by_year.where(in_dates).drop("_part").unionByName(by_date)
    season = F.when(F.col("kind") == SEASON, F.struct((-F.col("priority")).alias("rank"), "name"))
    found = held.groupBy("_day").agg(
        F.min(season).alias("_season"), F.max((F.col("kind") == HOLIDAY).cast("int")).alias("_holiday")
    )
    joined = days.join(found, F.col(day) == F.col("_day"), "left")
    flag = F.when(F.col("_holiday") == 1, "1").otherwise("0")
    return joined.select(*days.columns, F.col("_season.name").alias("d_sellingseason"), flag.alias("d_holidayfl"))
