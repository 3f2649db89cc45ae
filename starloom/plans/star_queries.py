"""The four order-star reports: one dimension, two dimensions, drill-down and by date.

Each takes the fact, the dimensions and the columns to use, so the same report runs on the
order star's own tables and on tables with other names.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators.aggregates import exact_sum, sum_by
from starloom.operators.joins import star_join

Dimension = tuple[DataFrame, str, str]


def star_one_dim(fact: DataFrame, date: Dimension, revenue: Column) -> DataFrame:
    """One sum over the fact rows whose date is in the (already filtered) date dimension."""
    return sum_by(star_join(fact, date), revenue)


def star_two_dim(fact: DataFrame, *dimensions: Dimension, revenue: Column, by) -> DataFrame:
    """Sum per group of dimension attributes."""
    return sum_by(star_join(fact, *dimensions), revenue, *by)


def star_drill(
    fact: DataFrame, *dimensions: Dimension, revenue: Column, by, year: str
) -> DataFrame:
    """As `star_two_dim`, in order of year, the largest sum of a year first."""
    sums = star_two_dim(fact, *dimensions, revenue=revenue, by=by)
    ties = [name for name in sums.columns if name not in (year, "revenue")]
    return sums.orderBy(F.asc(year), F.desc("revenue"), *ties)


def star_by_date(fact: DataFrame, *dimensions: Dimension, revenue: Column, date: str) -> DataFrame:
    """Sum per fact date, in date order."""
    return star_two_dim(fact, *dimensions, revenue=revenue, by=[date]).orderBy(date)


Tables = Mapping[str, DataFrame]
Report = Callable[[Tables], DataFrame]

# The filters of the reports on the order star's own tables.
SSB_CITIES = ("UNITED KI1", "UNITED KI5")
SSB_SMALL = "lo_discount BETWEEN 1 AND 3 AND lo_quantity < 24"
SSB_CATEGORY = "p_category = 'MFGR#12'"
SSB_REGION = "s_region = 'AMERICA'"
SSB_YEAR = "d_year = 1997"
SSB_MONTH = "d_yearmonth = 'Dec1997'"

_SSB_DATE = ("lo_orderdate", "d_datekey")
_SSB_PART = ("lo_partkey", "p_partkey")
_SSB_SUPPLIER = ("lo_suppkey", "s_suppkey")
_SSB_CUSTOMER = ("lo_custkey", "c_custkey")


def _ssb_discounted() -> Column:
    return F.sum(F.col("lo_extendedprice").cast("bigint") * F.col("lo_discount"))


def ssb_one_dim(t: Tables) -> DataFrame:
    days = t["dwdate"].where(SSB_YEAR)
    return star_one_dim(t["lineorder"].where(SSB_SMALL), (days, *_SSB_DATE), _ssb_discounted())


def ssb_two_dim(t: Tables) -> DataFrame:
    return star_two_dim(
        t["lineorder"],
        (t["part"].where(SSB_CATEGORY), *_SSB_PART),
        (t["supplier"].where(SSB_REGION), *_SSB_SUPPLIER),
        (t["dwdate"], *_SSB_DATE),
        revenue=F.sum("lo_revenue"),
        by=["d_year", "p_brand1"],
    )


def ssb_drill(t: Tables) -> DataFrame:
    return star_drill(
        t["lineorder"],
        (t["customer"].where(F.col("c_city").isin(*SSB_CITIES)), *_SSB_CUSTOMER),
        (t["supplier"].where(F.col("s_city").isin(*SSB_CITIES)), *_SSB_SUPPLIER),
        (t["dwdate"].where(SSB_MONTH), *_SSB_DATE),
        revenue=F.sum("lo_revenue"),
        by=["c_city", "s_city", "d_year"],
        year="d_year",
    )


def ssb_by_date(t: Tables) -> DataFrame:
    part = (t["part"], *_SSB_PART)
    return star_by_date(t["lineorder"], part, revenue=_ssb_discounted(), date="lo_orderdate")


# Names of the four reports.
SSB_REPORTS: dict[str, Report] = {
    "by_part_discount": ssb_one_dim,
    "by_year_brand": ssb_two_dim,
    "by_city": ssb_drill,
    "by_date": ssb_by_date,
}


# The same reports on line items and orders, with nation and region looked up by key.

_ORDER = ("l_orderkey", "o_orderkey")
_PART = ("l_partkey", "p_partkey")
_SUPPLIER = ("l_suppkey", "s_suppkey")

# Their filters.
ORDER_NATIONS = ("NATION_1", "NATION_5")
ORDER_SMALL = "l_discount BETWEEN 0.01D AND 0.03D AND l_quantity < 24"
ORDER_YEAR = ("1997-01-01", "1998-01-01")


def _discounted() -> Column:
    return exact_sum(F.col("l_extendedprice") * F.col("l_discount"), decimals=4)


def _year() -> Column:
    return F.year("o_orderdate").alias("d_year")


def in_dates(rows: DataFrame, moment: str, first: str, end: str) -> DataFrame:
    """From `first` up to, not including, `end`: plain comparisons, which the scan can use."""
    bounds = [F.lit(day).cast("timestamp_ntz") for day in (first, end)]
    return rows.where((F.col(moment) >= bounds[0]) & (F.col(moment) < bounds[1]))


def _in_nations(t: Tables, table: str, foreign_key: str, name: str) -> DataFrame:
    nations = t["nation"].where(F.col("n_name").isin(*ORDER_NATIONS))
    keyed = nations.select(F.col("n_nationkey").alias(foreign_key), F.col("n_name").alias(name))
    return t[table].join(keyed, foreign_key)


def order_one_dim(t: Tables) -> DataFrame:
    orders = in_dates(t["orders"], "o_orderdate", *ORDER_YEAR)
    return star_one_dim(t["lineitem"].where(ORDER_SMALL), (orders, *_ORDER), _discounted())


def order_two_dim(t: Tables) -> DataFrame:
    american = star_join(
        t["supplier"],
        (t["nation"], "s_nationkey", "n_nationkey"),
        (t["region"].where("r_name = 'AMERICA'"), "n_regionkey", "r_regionkey"),
    )
    return star_two_dim(
        t["lineitem"],
        (t["part"].where("p_type = 'PROMO'"), *_PART),
        (american.select("s_suppkey"), *_SUPPLIER),
        (t["orders"].select("o_orderkey", _year()), *_ORDER),
        revenue=exact_sum(F.col("l_extendedprice"), decimals=2),
        by=["d_year", "p_brand"],
    )


def order_drill(t: Tables) -> DataFrame:
    # Orders meet customers first: few are left, and the larger lines are shuffled once less.
    orders = star_join(
        in_dates(t["orders"], "o_orderdate", *ORDER_YEAR),
        (_in_nations(t, "customer", "c_nationkey", "c_nation"), "o_custkey", "c_custkey"),
    )
    return star_drill(
        t["lineitem"],
        (orders, *_ORDER),
        (_in_nations(t, "supplier", "s_nationkey", "s_nation"), *_SUPPLIER),
        revenue=exact_sum(F.col("l_extendedprice"), decimals=2),
        by=["c_nation", "s_nation", _year()],
        year="d_year",
    )


def order_by_date(t: Tables) -> DataFrame:
    part, orders = (t["part"], *_PART), (t["orders"], *_ORDER)
    return star_by_date(t["lineitem"], part, orders, revenue=_discounted(), date="o_orderdate")


ORDER_REPORTS: dict[str, Report] = {
    "star_one_dim": order_one_dim,
    "star_two_dim": order_two_dim,
    "star_drill": order_drill,
    "star_by_date": order_by_date,
}
