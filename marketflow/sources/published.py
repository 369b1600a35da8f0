"""Compacted copies that readers may read while the next one is made.

Every run writes the dates it rebuilds to a folder of its own, ``version=<n>/<date>``, and then one
small file, ``_current/version=<n>``, that names the version of every date. Nothing that a reader
may have opened is written over: whoever read the file before goes on with the old folders,
whoever reads it afterwards gets the new ones, whole. A run that broke off has not written its
file; the next one takes its number and writes over its folder.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketflow.schemas import Kind, kind_of
from marketflow.sources.tables import laid_out, rebuilt_rows

#: Versions that are named in a filter of the scan; of more, only the join on dates prunes.
MOST_NAMED = 1_000


def _current(spark: SparkSession, kind: Kind, target: str, version: int | None = None) -> tuple[int, DataFrame | None]:
    """The last published version (or a given one), and ``date, data_version`` of its dates; 0 and null at first."""
    schema = f"`{kind.date_column}` date, data_version bigint, version bigint"
    try:
        every = spark.read.schema(schema).parquet(f"{target}/_current")
    except AnalysisException:
        return 0, None
    last = every.agg(F.max("version")).first()[0] if version is None else version
    if last is None:
        return 0, None
    return last, every.filter(F.col("version") == last).select(kind.date_column, "data_version")


def publish_table(
    spark: SparkSession,
    endpoint: str,
    path: str,
    target: str,
    since: str | None = None,
    overlap: dt.timedelta = dt.timedelta(days=1),
) -> str:
    """Publish a compacted copy of a table's fit rows, or of the dates that got files after ``since``.

    As ``compact_table`` (of a candlestick the last update; the ``since`` of the next run is
    returned), but readers of ``target`` are not disturbed. One job at a time publishes.
    """
    kind = kind_of(endpoint)
    next_since = dt.datetime.now(dt.timezone.utc) - overlap
    last, before = _current(spark, kind, target)
    rows = rebuilt_rows(spark, endpoint, path, since)
    if rows is not None:
        folder = f"{target}/version={last + 1}"
        laid_out(rows, endpoint).write.mode("overwrite").partitionBy(kind.date_column).parquet(folder)
        # One row per date.
        written = spark.read.schema(f"{kind.table_ddl}, `{kind.date_column}` date").parquet(folder)
        dates = written.select(kind.date_column).distinct().withColumn("data_version", F.lit(last + 1).cast("bigint"))
        if before is not None:
            dates = dates.unionByName(before.join(dates, kind.date_column, "left_anti"))
        dates.coalesce(1).write.mode("overwrite").parquet(f"{target}/_current/version={last + 1}")
    return next_since.strftime("%Y-%m-%dT%H:%M:%S.%f")


def _versions(spark: SparkSession, kind: Kind, target: str) -> DataFrame:
    schema = f"{kind.table_ddl}, version bigint, `{kind.date_column}` date"
    return spark.read.schema(schema).parquet(target)


def read_published(
    spark: SparkSession,
    endpoint: str,
    target: str,
    *,
    start: str | None = None,
    end: str | None = None,
    version: int | None = None,
) -> DataFrame:
    """The rows that are published now (or were as ``version``), in table column order.

    ``start`` (inclusive) and ``end`` (exclusive) are UTC dates; they prune folders, and so does
    the list of dates, one row each, that is broadcast. The rows stay the same however often
    the frame is used, whatever is published meanwhile.
    """
    kind = kind_of(endpoint)
    last, dates = _current(spark, kind, target, version)
    if dates is None:
        return spark.createDataFrame([], kind.table_schema)
    rows = _versions(spark, kind, target)
    for bound, test in ((start, "__ge__"), (end, "__lt__")):
        if bound:
            rows = rows.filter(getattr(F.col(kind.date_column), test)(F.lit(bound).cast("date")))
    named = [r["data_version"] for r in dates.select("data_version").distinct().limit(MOST_NAMED + 1).collect()]
    if len(named) <= MOST_NAMED:
        rows = rows.filter(F.col("version").isin(named))
    wanted = F.broadcast(dates.withColumnRenamed("data_version", "version"))
    return rows.join(wanted, ["version", kind.date_column], "left_semi").select(*kind.columns)


def replaced_dates(spark: SparkSession, endpoint: str, target: str) -> DataFrame:
    """``version, date`` of folders that the present version does not use: they may go once old readers are done."""
    kind = kind_of(endpoint)
    last, dates = _current(spark, kind, target)
    folders = _versions(spark, kind, target).select("version", kind.date_column).distinct().filter(F.col("version") <= last)
    used = spark.createDataFrame([], f"`{kind.date_column}` date, data_version bigint") if dates is None else dates
    return folders.join(used.withColumnRenamed("data_version", "version"), ["version", kind.date_column], "left_anti")
