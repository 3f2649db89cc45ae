"""Access log, words and tags, wide rows, the calendar and the order star, on small frames."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from conftest import values, write_lines
from pyspark.sql import functions as F

from starloom import schemas
from starloom.functions import calendar, text, weblog, wide
from starloom.operators import nested
from starloom.plans import reports, star_queries
from starloom.sinks import files as sinks
from starloom.sources import files

LOG = [
    '1.example.com - - [01/Jul/1995:00:00:01 -0400] "GET /a.html HTTP/1.0" 200 9',
    '2.example.com - bob [01/Jul/1995:00:00:06 -0400] "GET /b.html HTTP/1.0" 200 1000',
    '2.example.com - - [01/Jul/1995:00:00:09 -0400] "GET /a.html" 404 -',
    '2.example.com - - [31/Dec/1995:23:59:59 +0000] "HEAD /c d.gif HTTP/1.1" 304 0',
    "alyssa.p",
    "",
]


@pytest.fixture
def log(spark, tmp_path):
    return files.read_lines(spark, write_lines(tmp_path / "access.gz", LOG))


def test_log_lines(spark, log):
    good, bad = weblog.parse_lines(log)
    assert good.columns == list(weblog.FIELDS)
    assert values(bad) == [("alyssa.p",)] or values(bad) == [("",), ("alyssa.p",)]
    by_size = {r.content_size: r for r in good.collect()}
    assert by_size["9"].asDict() == {
        "host": "1.example.com",
        "client_identd": "-",
        "user_id": "-",
        "date_time": "01/Jul/1995:00:00:01 -0400",
        "method": "GET",
        "endpoint": "/a.html",
        "protocol": "HTTP/1.0",
        "response_code": "200",
        "content_size": "9",
    }
    assert by_size["1000"].user_id == "bob"
    assert (by_size["-"].endpoint, by_size["-"].protocol) == ("/a.html", "")
    assert (by_size["0"].endpoint, by_size["0"].protocol) == ("/c d.gif", "HTTP/1.1")


def test_log_map_gives_the_same_columns(log):
    parsed = weblog.parse_to_map(log)
    assert dict(parsed.dtypes)["parsed"] == "map<string,string>"
    columns = weblog.map_to_columns(parsed.where("parsed IS NOT NULL"))
    assert values(columns) == values(weblog.parse_lines(log)[0])
    assert values(weblog.map_to_columns(parsed, ["host", "missing"]), "missing")[0] == (None,)


def test_log_by_plain_split(log):
    parts = weblog.fields_by_split(F.col("value"))
    split = log.where("value LIKE '%HTTP%'").select(*[c.alias(n) for n, c in parts.items()])
    assert ("1.example.com", "9") in values(split)


def test_log_reports(log):
    good, _ = weblog.parse_lines(log)
    assert [tuple(r) for r in reports.popular_hosts(good).collect()] == [
        ("2.example.com", 3),
        ("1.example.com", 1),
    ]
    assert [tuple(r) for r in reports.popular_content(good).limit(1).collect()] == [("/a.html", 2)]
    typed = weblog.typed(good)
    assert [r.content_size_bytes for r in reports.largest_responses(typed).collect()] == [
        1000,
        9,
        0,
        None,
    ]
    assert values(typed.where("content_size = '9'"), "logged_at") == [
        (datetime(1995, 7, 1, 4, 0, 1),)
    ]
    bad_date = typed.withColumn("date_time", F.lit("yesterday"))
    assert weblog.typed(bad_date.drop("logged_at")).where("logged_at IS NOT NULL").isEmpty()


def test_title_words(spark, tmp_path):
    posts = [
        '{"data": {"title": "the  cat the", "author": "a"}}',
        '{"data": {"title": null, "author": "b"}}',
        '{"data": {"title": " cat", "author": "c"}}',
    ]
    write_lines(tmp_path / "posts/p.json", posts)
    frame = files.read_json_inferred(spark, str(tmp_path / "posts"))
    assert values(nested.struct_fields(frame, "data.title", "data.author"), "author") == [
        ("a",),
        ("b",),
        ("c",),
    ]
    assert values(reports.title_words(frame)) == [("", 1), ("cat", 2), ("the", 2)]
    assert [tuple(r) for r in reports.title_words(frame, limit=2).collect()] == [
        ("cat", 2),
        ("the", 2),
    ]


def test_proper_nouns(spark):
    annotated = spark.createDataFrame(
        [
            (
                "x",
                [
                    ("NNP", {"word": "Ann", "sentence": "0"}),
                    ("VB", {"word": "sings"}),
                    ("NNPS", {"word": "Swedes"}),
                    ("NNP", {"sentence": "0"}),
                ],
            ),
            ("y", [("NNP", {"word": "Ann"})]),
            ("z", []),
            ("n", None),
        ],
        "text string, pos array<struct<result string, metadata map<string,string>>>",
    )
    assert values(reports.proper_nouns(annotated)) == sorted(
        [("Ann", 2), ("Swedes", 1), (None, 1)], key=repr
    )
    words = nested.tagged_words(annotated, "pos", ["NNPS"])
    assert values(words, "word", "tag") == [("Swedes", "NNPS")]


def test_annotation_rules_come_in_order(spark):
    frame = spark.createDataFrame([("Ann sings 2",)], "t string")
    rules = {"NNP": "^[A-Z]", "CD": "^[0-9]+$", "ANY": "."}
    tags = frame.select(F.explode(text.annotate_words(F.col("t"), rules)).alias("p"))
    assert [r[0] for r in tags.select("p.result").collect()] == ["NNP", "ANY", "CD"]


METER = [
    "postcode,meter,00_30,01_00",
    "BA1 1AA,m1,1.5,2",
    "BA2,m2,1,",
    ",m3,1,1",
    "BA3 2BB,m4,x,1",
]


def test_consumption(spark, tmp_path):
    readings = files.read_delimited(spark, write_lines(tmp_path / "m.csv", METER))
    total = reports.consumption(readings)
    assert values(total, "postcode", "meter", "total_consumption", "Country") == [
        ("BA1", "m1", 3.5, "United Kingdom"),
        ("BA2", "m2", None, "United Kingdom"),
        ("BA3", "m4", None, "United Kingdom"),
    ]
    zeros = reports.consumption(readings, "^[0-9]{2}_[0-9]{2}$", nulls="zero")
    assert values(zeros, "total_consumption") == [(1.0,), (1.0,), (3.5,)]
    out = tmp_path / "country"
    sinks.write_delimited(total, str(out), single_file=True)
    assert len(list(out.glob("*.csv"))) == 1
    with pytest.raises(ValueError):
        wide.row_sum(["a"], nulls="maybe")


def test_percent_improvement(spark):
    times = spark.createDataFrame([(4.0, 1.0), (0.0, 1.0)], "plain double, laid_out double")
    percent = wide.percent_improvement(F.col("plain"), F.col("laid_out")).alias("p")
    assert values(times.select(percent)) == [(75.0,), (None,)]


def test_epochs_and_numbering(spark):
    moment = F.timestamp_millis(F.col("ms"))
    frame = spark.createDataFrame([(1543147200999,), (-1,)], "ms bigint")
    seconds = frame.select(calendar.epoch_ms_to_seconds(F.col("ms")).alias("s"))
    assert values(seconds) == [(0,), (1543147200,)]
    sunday = frame.where("ms > 0").select(
        calendar.day_of_week_sunday0(moment), F.weekday(moment)
    )
    assert values(sunday) == [(0, 6)]
    back = frame.select(calendar.seconds_to_timestamp(F.lit(1543147200)).alias("t")).first()
    assert back.t == datetime(2018, 11, 25, 12)


def test_calendar(spark):
    days = calendar.calendar(spark, date(2019, 12, 30), date(2020, 3, 1))
    assert days.count() == 63
    leap = days.where("d_datekey = 20200229").first()
    assert leap.d_date == "February 29, 2020" and leap.d_yearmonth == "Feb2020"
    assert (leap.d_daynuminyear, leap.d_weeknuminyear, leap.d_daynuminweek) == (60, 9, 7)
    assert (leap.d_lastdayinmonthfl, leap.d_lastdayinweekfl, leap.d_weekdayfl) == ("1", "1", "0")
    assert days.where("d_datekey = 20191230").first().d_weeknuminyear == 1


def order_star(spark):
    date_columns = "d_datekey int, d_year int, d_yearmonth string"
    dates = [(19971201, 1997, "Dec1997"), (19971101, 1997, "Nov1997"), (19980101, 1998, "Jan1998")]
    customers = [(1, "UNITED KI1"), (2, "UNITED KI5"), (3, "PERU")]
    suppliers = [(1, "UNITED KI1", "EUROPE"), (2, "LIMA", "AMERICA"), (3, "UNITED KI5", "EUROPE")]
    parts = [(1, "MFGR#12", "B1"), (2, "MFGR#12", "B2"), (3, "MFGR#13", "B3")]
    # customer, part, supplier, date, quantity, price, discount, revenue
    facts = [
        (1, 1, 1, 19971201, 10, 100, 1, 99),
        (2, 2, 3, 19971201, 23, 200, 3, 194),
        (2, 1, 2, 19971101, 24, 300, 2, 294),
        (3, 1, 2, 19980101, 5, 400, 2, 392),
        (1, 3, 2, 19971201, 5, 500, 4, 480),
        (1, 2, 3, 19971201, 5, 600, 2, 588),
        (1, 9, 2, 19971201, 5, 700, 2, 686),
    ]
    return {
        "dwdate": spark.createDataFrame(dates, date_columns),
        "customer": spark.createDataFrame(customers, "c_custkey int, c_city string"),
        "supplier": spark.createDataFrame(
            suppliers, "s_suppkey int, s_city string, s_region string"
        ),
        "part": spark.createDataFrame(parts, "p_partkey int, p_category string, p_brand1 string"),
        "lineorder": spark.createDataFrame(
            facts,
            "lo_custkey int, lo_partkey int, lo_suppkey int, lo_orderdate int, "
            "lo_quantity int, lo_extendedprice int, lo_discount int, lo_revenue int",
        ),
    }


def test_order_star_reports(spark):
    star = order_star(spark)
    reports_of = {name: report(star) for name, report in star_queries.SSB_REPORTS.items()}
    assert values(reports_of["by_part_discount"]) == [(100 + 600 + 1200 + 1400,)]
    assert values(reports_of["by_year_brand"], "d_year", "p_brand1", "revenue") == [
        (1997, "B1", 294),
        (1998, "B1", 392),
    ]
    assert [tuple(r) for r in reports_of["by_city"].collect()] == [
        ("UNITED KI1", "UNITED KI5", 1997, 588),
        ("UNITED KI5", "UNITED KI5", 1997, 194),
        ("UNITED KI1", "UNITED KI1", 1997, 99),
    ]
    assert [tuple(r) for r in reports_of["by_date"].collect()] == [
        (19971101, 600),
        (19971201, 100 + 600 + 2000 + 1200),
        (19980101, 800),
    ]


def test_order_star_load_and_reports(spark, tmp_path):
    """Gzip pipe-delimited files into the five tables, plain and laid out, give the same reports."""
    from starloom.plans import layouts

    star = order_star(spark)
    for spec in schemas.SSB_TABLES:
        whole = files.by_name(star[spec.name], spec.schema)
        sinks.write_delimited(
            whole, str(tmp_path / spec.name), sep="|", header=False, compression="gzip"
        )
    plain = layouts.load_tables(spark, str(tmp_path), schemas.SSB_TABLES, "ssb_plain")
    laid = layouts.load_tables(
        spark, str(tmp_path), schemas.laid_out(schemas.SSB_TABLES, 4), "ssb_laid"
    )
    assert plain.columns == ["table", "seconds_ssb_plain"] and plain.count() == 5
    assert plain.join(laid, "table").count() == 5
    stored = [
        {s.name: spark.table(f"{database}.{s.name}") for s in schemas.SSB_TABLES}
        for database in ("ssb_plain", "ssb_laid")
    ]
    for name, report in star_queries.SSB_REPORTS.items():
        assert values(report(stored[0])) == values(report(stored[1])), name
    times = layouts.compare_query_times(spark, star_queries.SSB_REPORTS, *stored, runs=1)
    assert times.columns == ["query", "plain", "laid_out", "improvement"]
    assert times.count() == 4
    for database in ("ssb_plain", "ssb_laid"):
        spark.sql(f"DROP DATABASE {database} CASCADE")
