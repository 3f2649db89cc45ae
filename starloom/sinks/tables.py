"""Catalog tables: create and drop, load, append, replace."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators import merge, numbering, quality, rows as row_operators
from starloom.schemas import TableSpec
from starloom.sinks.files import prepared

_OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"
PART = "key_part"


def qualified(name: str, database: str | None) -> str:
    return f"{database}.{name}" if database else name


def current(spark: SparkSession, name: str) -> DataFrame:
    """A table as its files are now: another session, such as a stream's, may have written it."""
    if spark.catalog.tableExists(parts_name(name)):
        spark.catalog.refreshTable(parts_name(name))
    spark.catalog.refreshTable(name)
    return spark.table(name)


def create_tables(
    spark: SparkSession, specs: Iterable[TableSpec], database: str | None = None
) -> None:
    """Creates each table that is not there yet, and the database."""
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for spec in specs:
        name = qualified(spec.name, database)
        if spark.catalog.tableExists(name):
            continue
        if spec.versioned:
            publish(spark.createDataFrame([], spec.schema), name)
            continue
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spec.schema.fields)
        if spec.parts:
            store, names = parts_name(name), ", ".join(f"`{f.name}`" for f in spec.schema.fields)
            spark.sql(
                f"CREATE TABLE IF NOT EXISTS {store} ({columns}, {PART} INT) USING parquet "
                f"PARTITIONED BY ({PART}) TBLPROPERTIES ('parts' = '{spec.parts}')"
            )
            spark.sql(f"CREATE VIEW IF NOT EXISTS {name} AS SELECT {names} FROM {store}")
            continue
        clauses = [f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet"]
        if spec.partition_by:
            clauses.append(f"PARTITIONED BY ({', '.join(spec.partition_by)})")
        if spec.bucket_by:
            clauses.append(f"CLUSTERED BY ({', '.join(spec.bucket_by)})")
            if spec.sort_by:
                clauses.append(f"SORTED BY ({', '.join(spec.sort_by)})")
            clauses.append(f"INTO {spec.buckets} BUCKETS")
        spark.sql(" ".join(clauses))


def drop_tables(
    spark: SparkSession, specs: Iterable[TableSpec], database: str | None = None
) -> None:
    for spec in specs:
        name = qualified(spec.name, database)
        for version in _versions(spark, name):
            spark.sql(f"DROP TABLE IF EXISTS {version}")
        kind = "VIEW" if _is_view(spark, name) else "TABLE"
        spark.sql(f"DROP {kind} IF EXISTS {name}")
        spark.sql(f"DROP TABLE IF EXISTS {parts_name(name)}")


def load_table(rows: DataFrame, name: str, reload: bool = True) -> None:
    """Loads into an existing table: clears it first, or appends. Columns match by name.

    `rows` must not be read from the table when it is cleared.
    """
    spark = rows.sparkSession
    ordered = rows.select(*spark.table(name).columns)
    if not reload:
        ordered.write.insertInto(name)
        return
    with _overwrite_mode(spark, "static"):
        ordered.write.insertInto(name, overwrite=True)


def append_rows(rows: DataFrame, name: str) -> None:
    load_table(rows, name, reload=False)


def clear_table(spark: SparkSession, name: str) -> None:
    load_table(spark.createDataFrame([], spark.table(name).schema), name)


def create_table_as(rows: DataFrame, name: str, partition_by: Sequence[str] = ()) -> None:
    """Drops the table if it is there and creates it from the rows."""
    rows = rows.hint("rebalance", *partition_by) if partition_by else rows
    writer = rows.write.mode("overwrite").format("parquet")
    (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(name)


def append_partitions(
    rows: DataFrame, name: str, partition_by: Sequence[str], sort_by: Sequence[str] = ()
) -> None:
    """Appends to a partitioned table, with few files per partition and sorted within them."""
    append_rows(prepared(rows, partition_by, sort_by), name)


def replace_partitions(
    rows: DataFrame, name: str, partition_by: Sequence[str], sort_by: Sequence[str] = ()
) -> None:
    """Replaces only the partitions that `rows` has values for, once all tasks are done."""
    spark = rows.sparkSession
    ordered = prepared(rows, partition_by, sort_by).select(*spark.table(name).columns)
    with _overwrite_mode(spark, "dynamic"):
        ordered.write.insertInto(name, overwrite=True)


def parts_name(name: str) -> str:
    """The table behind a view of a table stored in parts."""
    return f"{name}__parts"


def part_of(keys: Sequence[str], parts: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int")


@contextmanager
def written_out(rows: DataFrame, table: str) -> Iterator[DataFrame]:
    """The rows written out and read back: they are used several times, their work runs once. The
    table has a name of its own, so runs do not meet in it, and is dropped at the end."""
    spark, name = rows.sparkSession, f"{table}__batch_{uuid.uuid4().hex[:12]}"
    try:
        create_table_as(rows, name)
        yield current(spark, name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def merge_into_parts(batch: DataFrame, name: str, keys: Sequence[str], order: Sequence[str]) -> list[int]:
    """Update on conflict in a table stored in parts. Gives the numbers of the rewritten parts.

    A key of the batch takes the batch row, the latest by `order` if there are several. Of the
    stored rows only the parts that the batch has keys of are read. Only parts that have a new or a
    changed row are written, so a batch that comes again writes nothing, and files of other parts
    are left as they are. A key lies in the same part on every run; null is a key.
    """
    spark, store = batch.sparkSession, parts_name(name)
    parts = int(spark.sql(f"SHOW TBLPROPERTIES {store}('parts')").first().value)
    columns = spark.table(name).columns
    latest = row_operators.latest_per_key(batch, keys, order).select(*columns, part_of(keys, parts).alias(PART))

    def in_parts(rows: DataFrame, numbers: list[int]) -> DataFrame:
        return rows.where(F.col(PART).isin(numbers))

    def numbers_of(rows: DataFrame) -> list[int]:
        return sorted(row[PART] for row in rows.select(PART).distinct().collect())  # `parts` rows at most

    with written_out(latest, name) as latest:
        stored = in_parts(current(spark, store), numbers_of(latest))
        changed = numbers_of(merge.without_keys(latest, stored, [PART, *columns]))
        if changed:
            kept = merge.without_keys(in_parts(stored, changed), in_parts(latest, changed), keys)
            replace_partitions(kept.unionByName(in_parts(latest, changed)), store, [PART], keys)
    return changed


def append_numbered(
    batch: DataFrame, name: str, number: str, keys: Sequence[str], order: Sequence[str], folder: str
) -> None:
    """Appends the rows whose key is new, and numbers them on from the highest stored number.

    Of rows with the same key the first by `order` counts. Numbers have no gaps: new rows are
    numbered by `order` and `keys` once it is known which they are, and a run that failed before it
    appended has used up none. One load writes the table at a time. `folder` takes the rows
    between the two steps.
    """
    stored = current(batch.sparkSession, name)
    columns = [column for column in stored.columns if column != number]
    known = stored.select(number, *columns)
    fresh = merge.unseen(known, row_operators.earliest_per_key(batch.select(*columns), keys, order), keys)
    highest = known.agg(F.max(number)).first()[0] or 0
    append_rows(numbering.numbered(fresh, number, [*order, *keys], folder, after=highest), name)


def publish(rows: DataFrame, name: str, keep: int = 1, rules: Sequence[quality.Rule] = ()) -> list[quality.Outcome]:
    """Replaces all rows behind a name at once, also by rows read from that name.

    The rows go to a new table; then the view `name` is pointed at it. Readers see the old
    rows or the new ones, and a failed run leaves the old ones in place. The last `keep`
    older tables stay for readers that are still on them. `rules` are worked out while the rows
    are written; if one fails the new table is dropped and the old rows stay.
    """
    spark = rows.sparkSession
    if spark.catalog.tableExists(name) and not _is_view(spark, name):
        raise ValueError(f"{name} is a plain table, not a view of versions")
    older = _versions(spark, name)
    stamp = datetime.now(timezone.utc).strftime("%Y%m%d%H%M%S%f")
    version = f"{name}__v{stamp}_{uuid.uuid4().hex[:6]}"
    written, outcomes = quality.observed(rows, rules) if rules else (rows, list)
    written.write.format("parquet").saveAsTable(version)
    found = outcomes()
    try:
        quality.require_all(found)
    except quality.QualityError:
        spark.sql(f"DROP TABLE IF EXISTS {version}")
        raise
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {version}")
    for table in older[: max(0, len(older) - keep)]:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    return found


def _versions(spark: SparkSession, name: str) -> list[str]:
    database, _, table = name.rpartition(".")
    listed = spark.catalog.listTables(database or None, f"{table.lower()}__v*")
    return sorted(qualified(t.name, database) for t in listed if t.tableType == "MANAGED")


def _is_view(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType == "VIEW"


@contextmanager
def _overwrite_mode(spark: SparkSession, mode: str) -> Iterator[None]:
    before = spark.conf.get(_OVERWRITE_MODE)
    spark.conf.set(_OVERWRITE_MODE, mode)
    try:
        yield
    finally:
        spark.conf.set(_OVERWRITE_MODE, before)
