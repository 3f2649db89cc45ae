"""Sources, sinks, loads and streams as queries: files and tables that Spark derives from the
given tables, written to the shared folder and read back.
"""

from __future__ import annotations

import tempfile
import uuid
from datetime import date
from functools import cache, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom import schemas
from starloom.functions import calendar, keys
from starloom.operators import joins, rows
from starloom.plans import facts, lake, layouts, load_check, star_queries, warehouse
from starloom.plans.play_queries import play_events, seen, song_records
from starloom.plans.table_queries import query
from starloom.session import shared_folder
from starloom.sinks import files as file_sinks
from starloom.sinks import layout, tables
from starloom.sources import files
from starloom.sources.tables import Tables, from_local
from starloom.streaming import ingest

LOCAL_ROWS = 1000  # a lookup of more rows is not held by the driver


@cache
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix="run-")


def fresh_folder(spark: SparkSession) -> str:
    """A new folder under the cluster's shared one. Only a session on a single machine may do
    without the setting."""
    try:
        base = shared_folder(spark)
    except ValueError:
        if not spark.sparkContext.master.startswith("local["):
            raise
        base = _local_folder(spark.sparkContext.applicationId)
    return f"{base}/{uuid.uuid4().hex}"


def fresh_database(spark: SparkSession) -> str:
    name = f"loads_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{fresh_folder(spark)}'")
    return name


def _write_raw(t: Tables, folder: str) -> None:
    """Line-JSON as the jobs expect it: `log_data/yyyy/MM` and `song_data`."""
    events = play_events(t)
    played = calendar.ms_to_timestamp(F.col("ts"))
    yyyymm = F.year(played) * 100 + F.month(played)
    for month in [row.m for row in events.select(yyyymm.alias("m")).distinct().collect()]:
        path = f"{folder}/{lake.EVENT_FOLDER}/{month // 100}/{month % 100:02d}"
        events.where(yyyymm == month).write.json(path)
    song_records(t).write.json(f"{folder}/{lake.SONG_FOLDER}")


@query
def json_with_schema(t: Tables) -> DataFrame:
    """Line-JSON in nested folders, read with a schema."""
    folder = fresh_folder(t.spark)
    nested = t["events"].withColumn("year", F.year("ts")).withColumn("day", F.dayofmonth("ts"))
    nested = nested.withColumn("ts", F.unix_micros(F.col("ts").cast("timestamp")))
    nested.write.partitionBy("year", "day").json(folder)
    schema = T.StructType([f for f in nested.schema.fields if f.name not in ("year", "day")])
    return files.read_json(t.spark, folder, schema)


@query
def json_inferred(t: Tables) -> DataFrame:
    """Line-JSON with the schema found in the data, which takes all whole numbers for bigint."""
    folder = fresh_folder(t.spark)
    t["customer"].write.json(folder)
    return files.read_json_inferred(t.spark, folder)


@query
def stage_by_mapping(t: Tables) -> DataFrame:
    """Nested line-JSON to staging columns by a mapping of field paths, in a table."""
    spark = t.spark
    folder, database = fresh_folder(spark), fresh_database(spark)
    who = F.struct(F.col("user_id").alias("id"), F.col("event_type").alias("kind"))
    t["events"].select("event_id", who.alias("user")).write.json(folder)
    schema = T.StructType(
        [
            T.StructField("event_id", T.LongType()),
            T.StructField("user_id", T.StringType()),
            T.StructField("event_type", T.StringType()),
        ]
    )
    spec = schemas.TableSpec("staged", schema)
    tables.create_tables(spark, [spec], database)
    mapping = {"event_id": "event_id", "user_id": "user.id", "event_type": "user.kind"}
    raw = files.read_json_inferred(spark, folder)
    for _ in range(2):
        tables.load_table(files.by_mapping(raw, mapping, schema), f"{database}.staged")
    return spark.table(f"{database}.staged")


@query
def delimited_gzip_parts(t: Tables) -> DataFrame:
    """Many gzip files without a header, read with a schema."""
    folder = fresh_folder(t.spark)
    sold = t["lineitem"]
    spread = sold.repartition(int(t.spark.conf.get("spark.sql.shuffle.partitions")))
    file_sinks.write_delimited(spread, folder, ";", header=False, compression="gzip")
    return files.read_delimited(t.spark, folder, sold.schema, ";", header_rows=0)


@query
def delimited_with_header(t: Tables) -> DataFrame:
    """Tab-separated with a header: all text, then types inferred."""
    folder = fresh_folder(t.spark)
    file_sinks.write_delimited(t["orders"], folder, sep="\t")
    as_text = files.read_delimited(t.spark, folder, sep="\t")
    inferred = files.read_delimited(t.spark, folder, sep="\t", infer=True)
    key = F.col("o_orderkey").cast("bigint").alias("o_orderkey")
    words = as_text.select(key, "o_orderstatus", "o_orderpriority")
    return inferred.select(
        key, F.col("o_custkey").cast("bigint").alias("o_custkey"), "o_totalprice", F.col("o_orderdate").cast("timestamp_ntz").alias("o_orderdate")
    ).join(words, "o_orderkey")


@query
def parquet_partitioned(t: Tables) -> DataFrame:
    """Orders in folders by year and month; one year is read back."""
    folder = fresh_folder(t.spark)
    dated = t["orders"].withColumns({"y": F.year("o_orderdate"), "m": F.month("o_orderdate")})
    for _ in range(2):
        file_sinks.write_parquet(dated, folder, ["y", "m"], ["o_orderdate"])
    back = t.spark.read.parquet(folder).where("y = 1997")
    return back.select("o_orderkey", "o_orderdate", "y", "m")


@query
def partitions_replaced(t: Tables) -> DataFrame:
    """One month of the stored orders is rewritten from itself; the other months stay."""
    folder = fresh_folder(t.spark)
    dated = t["orders"].select(
        "o_orderkey",
        "o_orderstatus",
        F.year("o_orderdate").alias("y"),
        F.month("o_orderdate").alias("m"),
    )
    file_sinks.write_parquet(dated, folder, ["y", "m"])
    month = t.spark.read.parquet(folder).where("y = 1997 AND m = 12")
    file_sinks.replace_partitions(
        month.withColumn("o_orderstatus", F.lit("CLOSED")), folder, ["y", "m"]
    )
    return t.spark.read.parquet(folder)


@query
def union_by_name(t: Tables) -> DataFrame:
    """Frames with different columns, one after the other."""
    events = t["events"]
    valued = F.col("event_type") == "purchase"
    bought = events.where(valued).select("event_id", "user_id", "value")
    others = events.where(~F.coalesce(valued, F.lit(False))).select("user_id", "event_id")
    return bought.unionByName(others, allowMissingColumns=True)


@query
def run_date_files(t: Tables) -> DataFrame:
    """Events, dealt over several months, in folders by month; the folder of one run date is read."""
    folder = fresh_folder(t.spark)
    dated = F.col("ts") + F.make_interval(months=(F.col("event_id") % 14).cast("int"))
    parts = t["events"].select(
        "event_id", "event_type", F.date_format(dated, "yyyy").alias("y"), F.date_format(dated, "MM").alias("m")
    )
    for y, m in sorted({(r.y, r.m) for r in parts.select("y", "m").distinct().collect()}):
        month = parts.where((F.col("y") == y) & (F.col("m") == m)).select("event_id", "event_type")
        month.write.json(f"{folder}/{y}/{m}")
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("event_type", T.StringType())])
    return files.read_json(t.spark, files.run_date_path(folder, date(2025, 2, 15)), schema)


@query
def delimited_single_gzip(t: Tables) -> DataFrame:
    """A whole table as one gzip file, which one task reads and deals out for what follows. A gzip
    file is one stream: the tasks that write and read it hold a few rows at a time."""
    folder = fresh_folder(t.spark)
    whole = dict(header=False, single_file=True, compression="gzip", verbatim=True)
    file_sinks.write_delimited(t["part"], folder, "|", **whole)
    tasks = t.spark.sparkContext.defaultParallelism
    return files.read_delimited(
        t.spark, folder, t["part"].schema, "|", header_rows=0, spread=tasks, verbatim=True
    )


@query
def gzip_text_lines(t: Tables) -> DataFrame:
    """Lines of gzip text files, counted by their first word."""
    folder = fresh_folder(t.spark)
    lines = t["part"].select(F.concat_ws(" ", "p_name", "p_brand").alias("value"))
    lines.write.option("compression", "gzip").text(folder)
    first = F.substring_index("value", " ", 1).alias("word")
    return files.read_lines(t.spark, folder).groupBy(first).agg(F.count("*").alias("n"))


@query
def single_file_export(t: Tables) -> DataFrame:
    """A summary exported as one file with a header, and read back."""
    folder = fresh_folder(t.spark)
    summary = t["lineitem"].groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"))
    file_sinks.write_delimited(summary, folder, single_file=True)
    return files.read_delimited(t.spark, folder, summary.schema).select("l_returnflag", "l_linestatus", "n")


@query
def local_lookup(t: Tables) -> DataFrame:
    """Customers by region: the short list of regions is held by the driver as local rows. A list
    that is not short stays a table. Customers are counted first: one row per nation is joined."""
    names = t["region"].select(F.col("r_regionkey").alias("key"), F.col("r_name").alias("region"))
    held = names.limit(LOCAL_ROWS + 1).collect()
    if len(held) <= LOCAL_ROWS:
        names = from_local(t.spark, held, names.schema)
    nations = joins.star_join(t["nation"], (names, "n_regionkey", "key"))
    counted = t["customer"].groupBy("c_nationkey").agg(F.count("*").alias("n"))
    return joins.star_join(counted, (nations, "c_nationkey", "n_nationkey")).groupBy("region").agg(
        F.sum("n").alias("n")
    )


@query
def several_header_rows(t: Tables) -> DataFrame:
    """Delimited files with three lines at the head of each."""
    folder = fresh_folder(t.spark)
    keyed = t["orders"].select("o_orderkey", "o_orderstatus")
    head = "made by a test|# three lines|o_orderkey;o_orderstatus"
    rows_of = keyed.select(
        F.pmod("o_orderkey", F.lit(7)).alias("part"), F.lit(9).alias("place"), F.concat_ws(";", "o_orderkey", "o_orderstatus").alias("value")
    )
    heads = rows_of.select("part").distinct().select("part", F.posexplode(F.split(F.lit(head), "[|]")).alias("place", "value"))
    in_order = rows_of.unionByName(heads).repartition("part").sortWithinPartitions("part", "place")
    in_order.select("part", "value").write.partitionBy("part").text(folder)
    return files.read_delimited(t.spark, folder, keyed.schema, ";", header_rows=3)


@query
def rejected_lines(t: Tables) -> DataFrame:
    """Lines of JSON and of delimited text that fit, and those kept apart, counted."""
    folder = fresh_folder(t.spark)
    broken = F.col("event_id") % 10 == 3
    as_json = F.to_json(F.struct("event_id", "event_type"))
    t["events"].select(F.when(broken, F.concat(F.lit("{"), as_json)).otherwise(as_json).alias("value")).write.text(f"{folder}/json")
    as_csv = F.concat_ws(",", F.when(broken, F.lit("none")).otherwise(F.col("event_id").cast("string")), "event_type")
    t["events"].select(as_csv.alias("value")).write.text(f"{folder}/csv")
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("event_type", T.StringType())])
    found = {
        "json": files.read_json_checked(t.spark, f"{folder}/json", schema, glob="*.txt"),
        "csv": files.read_delimited_checked(t.spark, f"{folder}/csv", schema, header_rows=0),
    }
    counts = [
        rows.agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), F.lit(fits).alias("fits"), "n")
        for kind, sides in found.items()
        for fits, rows in zip((True, False), sides)
    ]
    return reduce(DataFrame.unionByName, counts)


@query
def random_keys(t: Tables) -> DataFrame:
    """Random keys differ on every row."""
    keyed = t["events"].select(keys.random_key().alias("key"))
    return keyed.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("key").alias("n_keys"))


@query
def load_and_summarise(t: Tables) -> DataFrame:
    """Delimited file to table, checked for rows, then summarised into a table."""
    spark = t.spark
    folder, database = fresh_folder(spark), fresh_database(spark)
    sold = t["lineitem"].select("l_partkey", "l_quantity")
    file_sinks.write_delimited(sold, folder)
    spec = schemas.TableSpec("sold", sold.schema)
    load_check.load_and_check(spark, folder, spec, database)
    load_check.summarise(
        spark, f"{database}.sold", f"{database}.sold_facts", "l_quantity", "l_partkey"
    )
    return spark.table(f"{database}.sold_facts").withColumn(
        "average_l_quantity", F.round("average_l_quantity", 6)
    )


@query
def dimension_reload(t: Tables) -> DataFrame:
    """A dimension cleared and loaded, then appended to, with a bare insert of fact rows."""
    spark = t.spark
    database = fresh_database(spark)
    people = t["customer"].select("c_custkey", "c_mktsegment")
    spec = schemas.TableSpec("people", people.schema)
    tables.create_tables(spark, [spec], database)
    table = f"{database}.people"
    tables.load_table(people, table)
    tables.clear_table(spark, table)
    tables.load_table(rows.where_value(people, "c_mktsegment", "MACHINERY"), table)
    tables.load_table(people, table)
    tables.append_rows(rows.where_value(people, "c_mktsegment", "BUILDING"), table)
    return spark.table(table)


@query
def bucketed_star(t: Tables) -> DataFrame:
    """The report by date on line items and parts that share their distribution key."""
    spark = t.spark
    database = fresh_database(spark)

    def spec(name: str, **laid_out) -> schemas.TableSpec:
        return schemas.TableSpec(name, t[name].schema, **laid_out)

    specs = [
        spec("lineitem", bucket_by=("l_partkey",), buckets=8, sort_by=("l_orderkey",)),
        spec("part", bucket_by=("p_partkey",), buckets=8),
        spec("orders", sort_by=("o_orderdate",)),
    ]
    for each in specs:
        layouts.store(t[each.name], f"{database}.{each.name}", each)
    stored = {each.name: spark.table(f"{database}.{each.name}") for each in specs}
    return star_queries.order_by_date(stored)


@query
def replicated_star(t: Tables) -> DataFrame:
    """The report by two dimensions with the dimensions copied to every task that are found to fit."""
    small = ("part", "supplier", "nation", "region")
    copied = {name: layout.replicated(t[name]) for name in small}
    return star_queries.order_two_dim({**copied, "lineitem": t["lineitem"], "orders": t["orders"]})


@query
def lake_users(t: Tables) -> DataFrame:
    """Users table of the data-lake job, run on JSON files."""
    spark = t.spark
    folder, out = fresh_folder(spark), fresh_folder(spark)
    _write_raw(t, folder)
    lake.run(spark, folder, out, partitions={"songs_table": ("year",)})
    return spark.read.parquet(f"{out}/users_table")


@query
def scheduled_songplays(t: Tables) -> DataFrame:
    """Fact table of the scheduled load, run twice on JSON files."""
    spark = t.spark
    folder, database = fresh_folder(spark), fresh_database(spark)
    _write_raw(t, folder)
    for _ in range(2):
        warehouse.run(
            spark, f"{folder}/{lake.EVENT_FOLDER}", f"{folder}/{lake.SONG_FOLDER}", database
        )
    return seen(tables.current(spark, f"{database}.songplays"))


@query
def stream_songplays(t: Tables) -> DataFrame:
    """Fact table filled by the file stream in several batches, with a file that comes twice."""
    spark = t.spark
    folder, checkpoint = fresh_folder(spark), fresh_folder(spark)
    database = fresh_database(spark)
    tables.create_tables(spark, schemas.STAR_TABLES, database)
    events, catalogue = play_events(t), song_records(t)
    events.repartition(4).write.json(f"{folder}/first")
    events.where("level = 'paid'").write.json(f"{folder}/again")
    query = ingest.stream_songplays(
        spark,
        folder,
        schemas.PLAY_EVENTS,
        lambda batch: facts.songplays(batch, catalogue),
        lambda batch: warehouse.append_songplays(batch, f"{database}.songplays"),
        name=f"songplays_{database}",
        checkpoint=checkpoint,
        files_per_batch=2,
    )
    query.awaitTermination()
    return seen(tables.current(spark, f"{database}.songplays"))


@query
def stream_staging(t: Tables) -> DataFrame:
    """Line-JSON taken by a file stream into a staging folder, in two starts of the stream."""
    spark = t.spark
    folder, staged, checkpoint = (fresh_folder(spark) for _ in range(3))
    events = t["events"].select("event_id", "user_id", "event_type")
    for kind, names in (("first", ["view", "error"]), ("then", ["signup", "purchase", "click"])):
        rows.where_value(events, "event_type", names).write.json(f"{folder}/{kind}")
        arriving = ingest.stream_json(spark, folder, events.schema)
        ingest.stage_stream(arriving, f"staging_{kind}", staged, checkpoint).awaitTermination()
    return spark.read.schema(events.schema).parquet(staged)
