"""Parquet tables, one per message kind.

A table folder is partitioned by ``rejected`` and by UTC date. Rows fit for the table
and quarantined rows are written by the same pass and the same commit; readers of one
never list the files of the other.

Streams append to a table through the file sink and batches through ``append_rows``.
A folder takes one or the other: readers of a stream's folder see only what its log lists.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketflow.functions import utc_date
from marketflow.operators.latest import latest_klines
from marketflow.operators.validate import REASON, validate
from marketflow.schemas import EVENT_MS, Kind, distinct_kinds, kind_of
from marketflow.sources.positions import Ledger, merged, without_positions
from marketflow.sources.work import claim_batch_folder, new_work_dir, owner_of

REJECTED = "rejected"
VALUE = "rejected_value"


def partition_columns(endpoint: str) -> tuple[str, str]:
    return REJECTED, kind_of(endpoint).date_column


def stored_schema(kind: Kind) -> T.StructType:
    ddl = (
        f"{kind.table_ddl}, {EVENT_MS} bigint, `partition` int, `offset` bigint, {REASON} string, {VALUE} string, "
        f"{REJECTED} boolean, {kind.date_column} date"
    )
    return T.StructType.fromDDL(ddl)


def table_rows(rows: DataFrame, endpoint: str) -> DataFrame:
    """Rows as a table folder stores them, fit and quarantined ones alike.

    ``rows`` has the table's columns, ``partition``, ``offset`` and ``value``, and may have
    ``event_ms`` (else the whole seconds stand in); the message text is only kept with
    quarantined rows.
    """
    kind = kind_of(endpoint)
    millis = EVENT_MS if EVENT_MS in rows.columns else "unix_seconds(timestamp_utc) * 1000"
    return validate(rows, endpoint).selectExpr(
        *(f"`{c}`" for c in kind.columns),
        f"cast({millis} as bigint) as {EVENT_MS}",
        "cast(partition as int) as partition",
        "cast(offset as bigint) as offset",
        REASON,
        f"if({REASON} is not null, cast(value as string), null) as {VALUE}",
        f"{REASON} is not null as {REJECTED}",
        f"{utc_date(kind.date_source)} as {kind.date_column}",
    )


def append_rows(rows: DataFrame, endpoint: str, path: str, *, skip_stored: bool = False) -> None:
    """Append a batch, laid out by date and sorted by the table's sort key within files.

    ``rebalance`` by date lets adaptive execution split large dates by size and merge
    small ones: files come out even, a task writes few dates, and no task takes a whole
    symbol or date. The sort lets readers skip row groups and pages by symbol and time.
    ``skip_stored`` leaves out what the table holds already, by topic partition and offset,
    so that a batch may be run again; rows without a position are appended all the same.
    What is stored is known from the table's ledger of positions; the table is not read. One
    job at a time appends to a table.
    """
    kind = kind_of(endpoint)
    spark = rows.sparkSession
    stored_before = owner_of(spark, path) is not None
    claim_batch_folder(spark, path)
    ledger = Ledger(spark, path)
    kept = ledger.exists()
    if skip_stored and stored_before:
        if not kept:
            ledger.begin(all_files=True)
        ledger.settle()
        rows = without_positions(rows, ledger.intervals())
    if skip_stored or kept:
        ledger.begin()
    stored = table_rows(rows, endpoint)
    partitions = partition_columns(endpoint)
    (
        stored.hint("rebalance", *partitions)
        .sortWithinPartitions(*partitions, *kind.sort_key)
        .write.mode("append")
        .partitionBy(*partitions)
        .parquet(path)
    )
    if skip_stored:
        ledger.settle()


def stored_positions(spark: SparkSession, path: str) -> DataFrame:
    """``partition, first, last``: the intervals of offsets that a table's ledger lists, merged."""
    return merged(Ledger(spark, path).intervals())


def _stored(spark: SparkSession, endpoint: str, path: str) -> DataFrame:
    return spark.read.schema(stored_schema(kind_of(endpoint))).parquet(path)


def read_table(
    spark: SparkSession,
    endpoint: str,
    path: str,
    *,
    start: str | None = None,
    end: str | None = None,
    all_updates: bool = False,
) -> DataFrame:
    """The table's rows in column order; candlesticks are reduced to their last update.

    ``start`` (inclusive) and ``end`` (exclusive) are UTC dates, ``YYYY-MM-DD``; they
    prune whole partitions. ``all_updates`` gives every candlestick update instead.
    """
    kind = kind_of(endpoint)
    rows = _stored(spark, endpoint, path).filter(~F.col(REJECTED))
    if start:
        rows = rows.filter(F.col(kind.date_column) >= F.lit(start).cast("date"))
    if end:
        rows = rows.filter(F.col(kind.date_column) < F.lit(end).cast("date"))
    if kind.name == "kline" and not all_updates:
        rows = latest_klines(rows)
    return rows.select(*kind.columns)


def read_quarantine(spark: SparkSession, endpoint: str, path: str) -> DataFrame:
    """Quarantined messages of a table: text, reason and position in the topic."""
    rows = _stored(spark, endpoint, path).filter(F.col(REJECTED))
    return rows.select("partition", "offset", F.col(VALUE).alias("value"), REASON)


def _touched_dates(spark: SparkSession, kind: Kind, path: str, since: str) -> tuple[DataFrame, Column] | None:
    """Dates of a table that got files after ``since``, and their range; null if there is none.

    Older files are not opened. The dates are worked out once and kept in a work folder. The
    range goes to the log as a static partition filter; with it the join on dates prunes
    partitions at run time as well. At most one row per calendar day of the range is
    broadcast (3.7 million in years 1 to 9999).
    """
    recent = spark.read.schema(stored_schema(kind)).option("modifiedAfter", since).option("timeZone", "UTC")
    dates, folder = kind.date_column, f"{new_work_dir(spark)}/touched"
    recent.parquet(path).filter(~F.col(REJECTED)).select(dates).distinct().write.parquet(folder)
    touched = spark.read.schema(f"`{dates}` date").parquet(folder)
    first, last = touched.agg(F.min(dates), F.max(dates)).first()
    if first is None:
        return None
    within = F.col(dates).between(F.lit(first), F.lit(last))
    return F.broadcast(touched.filter(within)), within


def _updates_of(spark: SparkSession, kind: Kind, path: str, touched: tuple[DataFrame, Column]) -> DataFrame:
    """Fit rows of the touched dates; the files of other dates are not opened."""
    dates, within = touched
    rows = _stored(spark, kind.name, path).filter(~F.col(REJECTED) & within)
    return rows.join(dates, kind.date_column, "left_semi")


def rebuilt_rows(spark: SparkSession, endpoint: str, path: str, since: str | None) -> DataFrame | None:
    """Fit rows of the dates that got files after ``since``, or of all; candlesticks as their last update.

    Null if no date did. Columns are the table's, then its date.
    """
    kind = kind_of(endpoint)
    rows = _stored(spark, endpoint, path).filter(~F.col(REJECTED))
    if since:
        touched = _touched_dates(spark, kind, path, since)
        if touched is None:
            return None
        rows = _updates_of(spark, kind, path, touched)
    if kind.name == "kline":
        rows = latest_klines(rows)
    return rows.select(*kind.columns, kind.date_column)


def laid_out(rows: DataFrame, endpoint: str) -> DataFrame:
    """Rows with their date, dealt out by it in even parts and sorted by the table's sort key."""
    kind = kind_of(endpoint)
    return rows.hint("rebalance", kind.date_column).sortWithinPartitions(kind.date_column, *kind.sort_key)


def compact_table(
    spark: SparkSession,
    endpoint: str,
    path: str,
    target_path: str,
    since: str | None = None,
    overlap: dt.timedelta = dt.timedelta(days=1),
) -> str:
    """Rewrite a table's fit rows to ``target_path``: few files per date, sorted by the sort key.

    Of a candlestick only the last update is written. Dates are rebuilt whole and replace
    the target's, so a job that failed is simply run again; whoever reads the target has to
    wait until the job is done. ``since`` (a UTC timestamp, ``YYYY-MM-DDTHH:MM:SS.ffffff``)
    limits the job to dates that got files after it.

    Returns the ``since`` of the next run: the start of this one less ``overlap``. A file
    carries the time it was written but shows up when its batch commits, so the overlap
    has to be longer than any batch takes; a date rebuilt once more comes out the same.
    """
    kind = kind_of(endpoint)
    next_since = dt.datetime.now(dt.timezone.utc) - overlap
    rows = rebuilt_rows(spark, endpoint, path, since)
    if rows is not None:
        (
            laid_out(rows, endpoint)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(kind.date_column)
            .parquet(target_path)
        )
    return next_since.strftime("%Y-%m-%dT%H:%M:%S.%f")


def settled_and_added(
    spark: SparkSession, endpoint: str, path: str, target_path: str, since: str
) -> tuple[DataFrame, DataFrame | None]:
    """Rows of a compacted copy that still hold, and rows to be worked out anew from the log."""
    kind = kind_of(endpoint)
    compacted_schema = T.StructType.fromDDL(f"{kind.table_ddl}, `{kind.date_column}` date")
    compacted = spark.read.schema(compacted_schema).parquet(target_path)
    touched = _touched_dates(spark, kind, path, since)
    if touched is None:
        return compacted.select(*kind.columns), None
    settled = compacted.join(touched[0], kind.date_column, "left_anti")
    added = _updates_of(spark, kind, path, touched)
    if kind.name == "kline":
        added = latest_klines(added)
    return settled.select(*kind.columns), added.select(*kind.columns)


def read_compacted(spark: SparkSession, endpoint: str, path: str, target_path: str, since: str) -> DataFrame:
    """A compacted table with what was added after ``since``, the value its compaction returned.

    Dates without new files come from the compacted copy as they are; only the others are
    read from the table itself, so keep-latest is worked out anew for those alone.
    """
    settled, added = settled_and_added(spark, endpoint, path, target_path, since)
    return settled if added is None else settled.unionByName(added)


def create_tables(spark: SparkSession, endpoints: Iterable[str], database: str) -> list[str]:
    """Create each endpoint's table in the catalog unless it is there; returns the names.

    Endpoints of one kind share a table. ``insert_rows`` appends to them.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    names = []
    for kind in distinct_kinds(endpoints):
        name = f"`{database}`.`{kind.table}`"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({kind.table_ddl}, `{kind.date_column}` date) "
            f"USING parquet PARTITIONED BY (`{kind.date_column}`)"
        )
        names.append(f"{database}.{kind.table}")
    return names


def insert_rows(rows: DataFrame, endpoint: str, table: str) -> None:
    """Append rows fit for the table to a catalog table, laid out as in ``append_rows``."""
    kind = kind_of(endpoint)
    dated = rows.select(*kind.columns, F.expr(utc_date(kind.date_source)).alias(kind.date_column))
    laid_out(dated, endpoint).write.insertInto(table)


def register_views(spark: SparkSession, endpoints: Iterable[str], root: str) -> list[str]:
    """Name the tables below ``root`` (``<root>/<table>``) as temporary views for SQL."""
    kinds = distinct_kinds(endpoints)
    for kind in kinds:
        read_table(spark, kind.name, f"{root}/{kind.table}").createOrReplaceTempView(kind.table)
    return [kind.table for kind in kinds]
