"""Keys, merges, running values and calendar rules as queries over the given tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom import schemas
from starloom.functions import calendar, catalog
from starloom.operators import numbering, quality
from starloom.operators.frames import Running, running
from starloom.operators.intervals import interval_join
from starloom.plans.file_queries import fresh_database, fresh_folder
from starloom.plans.play_queries import log_lines
from starloom.plans.table_queries import query
from starloom.sinks import layout, tables
from starloom.sources import files
from starloom.sources.tables import Tables, from_local, named_views
from starloom.streaming import ingest

# Keys


@query
def numbered_orders(t: Tables) -> DataFrame:
    """Orders numbered from the most expensive on."""
    orders = t["orders"].select("o_orderkey", "o_totalprice")
    order = [F.desc("o_totalprice"), F.col("o_orderkey")]
    return numbering.numbered(orders, "order_no", order, fresh_folder(t.spark)).select("order_no", "o_orderkey")


@query
def identity_over_loads(t: Tables) -> DataFrame:
    """Events loaded in three batches that overlap, each numbered on from the one before."""
    spark, database = t.spark, fresh_database(t.spark)
    schema = schemas.T.StructType(
        [schemas.T.StructField("play_no", schemas.T.LongType()), *t["events"].select("event_id", "user_id", "ts").schema.fields]
    )
    tables.create_tables(spark, [schemas.TableSpec("plays", schema)], database)
    events = t["events"].select("event_id", "user_id", "ts")
    third = F.col("event_id") % 3
    for batch in (events.where(third == 1), events.where(third < 2), events.where(third < 2), events):
        tables.append_numbered(batch, f"{database}.plays", "play_no", ["event_id"], ["ts"], fresh_folder(spark))
    return tables.current(spark, f"{database}.plays")


# Merges


@query
def merged_parts(t: Tables) -> DataFrame:
    """Customers merged into a table stored in parts, twice, and a batch of one segment after."""
    spark, database = t.spark, fresh_database(t.spark)
    customers = t["customer"].select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    spec = schemas.TableSpec("people", customers.schema, keys=("c_custkey",), parts=16)
    tables.create_tables(spark, [spec], database)
    table = f"{database}.people"
    raised = customers.where("c_mktsegment = 'BUILDING'").withColumn("c_acctbal", F.col("c_acctbal") + 100)
    for batch in (customers.where("c_acctbal < 5000"), customers, customers, raised):
        tables.merge_into_parts(batch, table, ["c_custkey"], ["c_acctbal"])
    return tables.current(spark, table)


# Staging, checks and streams


@query
def stage_by_paths(t: Tables) -> DataFrame:
    """Lines of three shapes, and some that are no JSON, to staging columns by a file of paths."""
    spark, folder = t.spark, fresh_folder(t.spark)
    number, amount = F.col("event_id"), F.col("value")
    nested = F.to_json(F.struct("event_id", F.struct(F.col("user_id").alias("id"), F.col("event_type").alias("kind")).alias("user"), amount.alias("amount")))
    as_text = F.to_json(
        F.struct(
            number.cast("string").alias("event_id"), F.array(F.lit(1)).alias("extra"), amount.cast("string").alias("amount"),
            F.struct(F.col("user_id").cast("string").alias("id"), F.col("event_type").alias("kind")).alias("user"),
        )
    )
    bare = F.to_json(F.struct("event_id", F.col("event_type").alias("user")))
    line = F.when(number % 50 == 7, "{not json").when(number % 3 == 0, nested).when(number % 3 == 1, as_text).otherwise(bare)
    t["events"].select(line.alias("value")).write.text(f"{folder}/lines")
    paths = """{"jsonpaths": ["$.event_id", "$['user']['id']", "$['user'].kind", "$.amount"]}"""
    spark.createDataFrame([(paths,)], "value string").coalesce(1).write.text(f"{folder}/paths")
    schema = schemas.columns("event_id bigint, user_id bigint, event_type string, amount double")
    good, _ = files.read_json_by_paths(spark, f"{folder}/lines", f"{folder}/paths", schema, glob="*.txt")
    return good


@query
def dq_during_load(t: Tables) -> DataFrame:
    """Rules worked out while orders are written to a table, and the state of the table they let through."""
    spark, database = t.spark, fresh_database(t.spark)
    rules = [
        quality.Rule("has rows", quality.row_count(), ">", 0),
        quality.Rule("o_orderkey never null", quality.null_count("o_orderkey"), "=", 0),
        quality.Rule("cheapest", F.min("o_totalprice"), ">", 0.0),
    ]
    outcomes = tables.publish(t["orders"], f"{database}.orders", rules=rules)
    stored = spark.table(f"{database}.orders").agg(F.count("*").alias("stored"))
    checked = from_local(spark, [(o.test_name, float(o.actual), o.success) for o in outcomes], "test_name string, actual double, success boolean")
    return checked.withColumn("stored", F.lit(stored.first()[0]).cast("bigint"))


@query
def functions_by_name(t: Tables) -> DataFrame:
    """Log lines and keys by functions of the catalog, in SQL."""
    database = fresh_database(t.spark)
    catalog.register(t.spark, database)
    named_views({"event_log": log_lines(t).withColumn("value", F.concat("value", F.lit("")))})
    return t.spark.sql(
        f"""
        SELECT parsed.host, parsed.endpoint, parsed.response_code AS code, fields['content_size'] AS size,
        {database}.hash_key(array(parsed.host, NULL, parsed.endpoint)) AS key
        FROM (SELECT {database}.log_line(value) AS parsed, {database}.log_fields(value) AS fields FROM event_log)
        """
    )


@query
def stream_once(t: Tables) -> DataFrame:
    """Line-JSON appended batch by batch, each once, in two starts of the stream."""
    spark = t.spark
    folder, output, checkpoint = (fresh_folder(spark) for _ in range(3))
    events = t["events"].select("event_id", "user_id", "event_type")
    for part in range(2):
        events.where(F.col("event_id") % 2 == part).repartition(3).write.json(f"{folder}/{part}")
        arriving = ingest.stream_json(spark, folder, events.schema, files_per_batch=2)
        ingest.append_once(arriving, "events", output, checkpoint).awaitTermination()
    return ingest.read_once(spark, output, events.schema).drop("stream", "batch")


@query
def curved_orders(t: Tables) -> DataFrame:
    """Orders laid out by date and customer at once; a stretch of both is read back."""
    table = f"{fresh_database(t.spark)}.orders"
    layout.write_curved(t["orders"], table, "o_orderdate", "o_custkey")
    stored = t.spark.table(table)
    in_1997 = stored.where("o_orderdate >= timestamp_ntz'1997-01-01' AND o_orderdate < timestamp_ntz'1998-01-01'")
    return in_1997.unionByName(stored.where("o_custkey BETWEEN 40 AND 90"))


# Running values


@query
def running_first_seen(t: Tables) -> DataFrame:
    """For every event its user's type by the last of a frame that runs from the latest event down."""
    values = {"first_type": Running("last", "event_type", ties="event_id")}
    events = t["events"].select("event_id", "user_id", "ts", "event_type")
    return running(events, ["user_id"], "ts", values, descending=True).select("event_id", "first_type")


@query
def running_totals(t: Tables) -> DataFrame:
    """For every event what its user has bought up to then, and the last purchase's value."""
    bought = F.when(F.col("event_type") == "purchase", F.col("value").cast("decimal(18,6)"))
    events = t["events"].select("event_id", "user_id", "ts", bought.alias("paid"))
    values = {
        "n_paid": Running("count", "paid"),
        "sum_paid": Running("sum", "paid"),
        "most_paid": Running("max", "paid"),
        "last_paid": Running("last", "paid", ties="event_id"),
    }
    ran = running(events, ["user_id"], "ts", values)
    as_double = {name: F.col(name).cast("double") for name in ("sum_paid", "most_paid", "last_paid")}
    return ran.withColumns(as_double).select("event_id", *values)


# Calendar rules

# Rules made up for these queries: overlapping, open-ended, over New Year, for one date.
_RULES = [
    ("season", "Winter", None, None, 1201, 228, 1),
    ("season", "Spring", None, None, 301, 531, 1),
    ("season", "Summer", None, None, 601, 831, 1),
    ("season", "Fall", None, None, 901, 1130, 1),
    ("season", "Gifts", date(1996, 1, 1), None, 1115, 1231, 2),
    ("season", "Clearance", date(1997, 2, 10), date(1997, 3, 20), None, None, 3),
    ("season", "Jubilee", date(2001, 6, 1), None, None, None, 3),
    ("holiday", "New Year", None, None, 101, 101, 1),
    ("holiday", "Labour Day", None, None, 501, 501, 1),
    ("holiday", "Founding", None, date(1997, 12, 31), 915, 915, 1),
    ("holiday", "Opening", date(1998, 4, 2), date(1998, 4, 3), None, None, 1),
]


@query
def dim_date_seasons(t: Tables) -> DataFrame:
    """The whole date dimension of the days on which orders came in, season and holiday by rules."""
    days = t["orders"].select(F.to_date("o_orderdate").alias("day")).distinct()
    rules = from_local(t.spark, _RULES, calendar.RULE)
    ruled = calendar.with_rules(days, "day", rules)
    return ruled.select(*calendar.date_attributes(F.col("day")), "d_sellingseason", "d_holidayfl")


@query
def open_orders(t: Tables) -> DataFrame:
    """For every day with an order, how many orders were open: from their date to the last shipment."""
    shipped = t["lineitem"].groupBy("l_orderkey").agg(F.max("l_shipdate").alias("last"))
    orders = t["orders"].join(shipped, F.col("o_orderkey") == F.col("l_orderkey")).select("o_orderkey", "o_orderdate", "last")
    days = t["orders"].select(F.to_date("o_orderdate").alias("day")).distinct()
    day_of = lambda moment: F.unix_date(F.to_date(moment))
    found = interval_join(days, F.unix_date("day"), orders, day_of("o_orderdate"), day_of("last"))
    return found.groupBy("day").agg(F.count("*").alias("n_open"))
