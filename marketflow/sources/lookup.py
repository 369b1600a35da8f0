"""Point lookups that open few files of a table.

A summary beside a table says, for every file and symbol in it, how many rows there are and between which
numbers they lie: trade ids, aggregate trade ids or first update ids; kinds without an id of their
own go by the second their date is made from. It is exact, so a lookup by symbol and number opens
the files that may hold the rows and no others, whatever dates they belong to.

Files are told apart by the time they were written. A summary covers files up to a moment;
a lookup reads those written later as well, so it never misses what came after the summary.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketflow.operators.latest import latest_klines
from marketflow.schemas import Kind, kind_of
from marketflow.sources.tables import REJECTED, stored_schema

NUMBERS = {"trade": "trade_id", "aggTrade": "aggregate_trade_id", "depth": "first_update_id"}
#: Files that a lookup names one by one; where more may hold its rows, all older files are scanned instead.
MOST_NAMED = 1_000
_SUMMARY = "file string, modified timestamp, symbol string, first_number bigint, last_number bigint, n_rows bigint, run bigint"


def _number(kind: Kind) -> Column:
    own = NUMBERS.get(kind.name)
    return F.col(own) if own else F.unix_seconds(kind.date_source)


def _written(spark: SparkSession, kind: Kind, path: str, after: int, until: int | None = None) -> DataFrame:
    """Fit rows of files written after a moment and not after another, both in milliseconds."""

    def moment(millis: int, micros: int = 0) -> str:
        at = dt.datetime.fromtimestamp(millis // 1000, dt.timezone.utc)
        return at.replace(microsecond=millis % 1000 * 1000 + micros).strftime("%Y-%m-%dT%H:%M:%S.%f")

    reader = spark.read.schema(stored_schema(kind)).option("timeZone", "UTC").option("modifiedAfter", moment(after))
    if until is not None:
        reader = reader.option("modifiedBefore", moment(until, 1))
    return reader.parquet(path).filter(~F.col(REJECTED))


def _covered(spark: SparkSession, summary: str) -> int:
    """The moment up to which files are summarised, 0 before the first time."""
    try:
        return spark.read.schema("until bigint").parquet(f"{summary}/runs").agg(F.max("until")).first()[0] or 0
    except AnalysisException:
        return 0


def summarize_files(
    spark: SparkSession, endpoint: str, path: str, summary: str, overlap: dt.timedelta = dt.timedelta(days=1)
) -> None:
    """Add the files of a table that were written since the last time, up to ``overlap`` ago, to its summary.

    A file carries the time it was written but shows up when its batch commits, so the overlap
    has to be longer than any batch takes. A run that broke off is simply run again: what it
    covers counts only once its moment is noted, at the end. Each file is read once, two columns
    of it; the summary has one row per file and symbol. One job at a time summarises.
    """
    kind = kind_of(endpoint)
    covered = _covered(spark, summary)
    until = int((dt.datetime.now(dt.timezone.utc) - overlap).timestamp() * 1000)
    if until <= covered:
        return
    rows = _written(spark, kind, path, covered, until).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_modification_time").alias("modified"),
        "symbol",
        _number(kind).alias("number"),
    )
    of_files = rows.groupBy("file", "modified", "symbol").agg(
        F.min("number").alias("first_number"), F.max("number").alias("last_number"), F.count("*").alias("n_rows")
    )
    # Sorted by symbol, so that a lookup skips most of the summary too.
    of_files.repartitionByRange("symbol").sortWithinPartitions("symbol", "first_number").write.mode(
        "overwrite"
    ).parquet(f"{summary}/files/run={until}")
    noted = spark.range(1).select(F.lit(until).cast("bigint").alias("until"))
    noted.write.mode("append").parquet(f"{summary}/runs")


def lookup_rows(
    spark: SparkSession,
    endpoint: str,
    path: str,
    summary: str,
    symbol: str,
    first: int,
    last: int | None = None,
    most_named: int = MOST_NAMED,
) -> DataFrame:
    """A symbol's rows with numbers from ``first`` to ``last`` (both included; ``last`` is ``first`` by default).

    Rows are the table's columns, of candlesticks the last update. The summary is asked for
    files that may hold them; those and the files written since are read, with the condition
    pushed down into them. Up to ``most_named`` file names come to the driver; where more files
    may hold rows, the older files are scanned under the same condition instead.
    """
    kind = kind_of(endpoint)
    last = first if last is None else last
    covered = _covered(spark, summary)
    rows = _written(spark, kind, path, covered)
    if covered:
        listed = spark.read.schema(_SUMMARY).parquet(f"{summary}/files").filter(
            (F.col("symbol") == symbol) & (F.col("first_number") <= last) & (F.col("last_number") >= first)
            & (F.col("modified") <= F.timestamp_millis(F.lit(covered)))
        )
        files = [r["file"] for r in listed.select("file").distinct().limit(most_named + 1).collect()]
        if len(files) > most_named:
            rows = rows.unionByName(_written(spark, kind, path, 0, covered))
        elif files:
            reader = spark.read.schema(stored_schema(kind)).option("basePath", path)
            rows = rows.unionByName(reader.parquet(*files).filter(~F.col(REJECTED)))
    rows = rows.filter((F.col("symbol") == symbol) & _number(kind).between(first, last))
    if kind.name == "kline":
        rows = latest_klines(rows)
    return rows.select(*kind.columns)
