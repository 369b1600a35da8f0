"""Which topic positions a table holds: intervals of offsets, kept beside the table's files.

A batch that may run twice has to leave out what is stored already. The ledger answers that
without the table: it lists, per topic partition, the intervals of offsets that are stored.

An append first notes that it begins, then writes its rows, then reads the two position columns of
the files written since and notes their intervals. An append that broke off leaves its note
behind; the next one settles it the same way, from what really got into the table. So the ledger
never claims a row that is not there, and at worst reads a few new files twice.

Below ``<table>/_positions``, a name that readers of tables pass over:

* ``begun``: ``id, started`` of every append;
* ``entry=<n>``: ``partition, first, last`` of one settlement, written over if it broke off;
* ``settled``: ``id, entry, base`` of appends that are settled. A base entry holds all before it.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Offsets are looked at in ranges of 2 ** so many, so that no task takes a whole topic partition.
RANGE_BITS = 20
#: So many intervals at most are broadcast (some 20 bytes each); more are swept over in order.
BROADCAST_INTERVALS = 1_000
#: Every so many entries the next one holds all intervals anew.
ENTRIES_PER_BASE = 32
#: Files carry the time of the store, appends that of the driver: read back from that much earlier.
CLOCK_OVERLAP = dt.timedelta(hours=1)

BEGUN = "id string, started string"
SETTLED = "id string, entry bigint, base boolean"
INTERVALS = "`partition` int, first bigint, last bigint"


def merged(intervals: DataFrame, bits: int = RANGE_BITS) -> DataFrame:
    """``partition, first, last`` (both stored) as the fewest intervals; overlaps and repeats are fine.

    Intervals are cut at multiples of ``2 ** bits`` and merged range by range, in parallel within a
    topic partition too. Only what touches the edge of a range, at most two intervals of each,
    is then merged over a whole topic partition. Rows without a position are left out.
    """
    known = intervals.filter("`partition` IS NOT NULL AND first IS NOT NULL AND last >= first")
    cut = _cut(known, bits)
    within = Window.partitionBy("partition", "chunk").orderBy("first", "last")
    islands = _islands(cut, within, ["partition", "chunk"])
    low = F.shiftleft("chunk", bits)
    edge = (F.col("first") == low) | (F.col("last") == low + (2**bits - 1))
    judged = islands.select("partition", "first", "last", edge.alias("edge"))
    across = Window.partitionBy("partition").orderBy("first", "last")
    joined = _islands(judged.filter("edge"), across, ["partition"])
    return judged.filter("NOT edge").select("partition", "first", "last").unionByName(joined.select("partition", "first", "last"))


def _cut(intervals: DataFrame, bits: int) -> DataFrame:
    """Intervals cut at multiples of ``2 ** bits``, with the number of the range they lie in."""
    numbers = F.sequence(F.shiftright("first", bits), F.shiftright("last", bits))
    pieces = intervals.select("partition", "first", "last", F.explode(numbers).alias("chunk"))
    low = F.shiftleft("chunk", bits)
    return pieces.select(
        "partition", "chunk", F.greatest("first", low).alias("first"), F.least("last", low + (2**bits - 1)).alias("last")
    )


def _islands(pieces: DataFrame, ordered, keys: list[str]) -> DataFrame:
    """Gaps and islands: pieces in order belong together until one begins beyond all before it."""
    reached = F.max("last").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    opens = (reached.isNull() | (F.col("first") > reached + 1)).cast("bigint")
    numbered = pieces.withColumn("_opens", opens).withColumn("_island", F.sum("_opens").over(ordered))
    return numbered.groupBy(*keys, "_island").agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("_island")


def intervals_of(rows: DataFrame, bits: int = RANGE_BITS) -> DataFrame:
    """Intervals of the positions (``partition``, ``offset``) of rows."""
    offset = F.col("offset").cast("bigint")
    return merged(rows.select(F.col("partition").cast("int"), offset.alias("first"), offset.alias("last")), bits)


def without_positions(
    rows: DataFrame, intervals: DataFrame, bits: int = RANGE_BITS, most: int = BROADCAST_INTERVALS
) -> DataFrame:
    """``rows`` whose position (``partition``, ``offset``) lies in no interval; rows without a position stay.

    A few intervals are broadcast and nothing is shuffled. Many are laid in order with the
    rows, range of offsets by range, and a running maximum tells what is covered: no row meets
    more than its neighbours, however many intervals there are.
    """
    names = rows.columns
    if intervals.count() <= most:
        few = F.broadcast(intervals.toDF("_partition", "_first", "_last"))
        inside = (F.col("partition") == F.col("_partition")) & F.col("offset").between(F.col("_first"), F.col("_last"))
        return rows.join(few, inside, "left_anti")
    # Rows without a position lie in no range; their content deals them out.
    number = F.coalesce(F.shiftright("offset", bits), F.xxhash64(*names) % 4096)
    placed = rows.withColumn("_chunk", number).withColumn("_row", F.lit(True))
    pieces = _cut(intervals, bits).select(
        "partition", F.col("chunk").alias("_chunk"), F.col("first").alias("offset"), F.col("last").alias("_last")
    )
    both = placed.unionByName(pieces.withColumn("_row", F.lit(False)), allowMissingColumns=True)
    # Of one offset the interval comes before the row.
    sweep = Window.partitionBy("partition", "_chunk").orderBy("offset", "_row")
    reached = F.max("_last").over(sweep.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    covered = both.withColumn("_reached", reached)
    fresh = F.coalesce(F.col("_reached") < F.col("offset"), F.lit(True)) | F.col("partition").isNull()
    return covered.filter(F.col("_row") & fresh).select(*(f"`{n}`" for n in names))


class Ledger:
    """The positions that a table folder holds."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.folder = spark, path, f"{path}/_positions"

    def _rows(self, name: str, schema: str) -> DataFrame | None:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.folder}/{name}")
        except AnalysisException:
            return None

    def exists(self) -> bool:
        return self._rows("begun", BEGUN) is not None

    def begin(self, *, all_files: bool = False) -> None:
        """Note that an append begins; ``all_files`` for the first one of a table that holds rows already."""
        now = dt.datetime.now(dt.timezone.utc) - CLOCK_OVERLAP
        started = "1970-01-02T00:00:00.000000" if all_files else now.strftime("%Y-%m-%dT%H:%M:%S.%f")
        note = self.spark.range(1).select(F.lit(uuid.uuid4().hex).alias("id"), F.lit(started).alias("started"))
        note.coalesce(1).write.mode("append").parquet(f"{self.folder}/begun")

    def pending(self) -> DataFrame | None:
        """Appends that are not settled: ``id, started``; null if there are none."""
        begun, settled = self._rows("begun", BEGUN), self._rows("settled", SETTLED)
        if begun is None:
            return None
        open_ = begun if settled is None else begun.join(settled, "id", "left_anti")
        return None if open_.isEmpty() else open_

    def _entries(self) -> tuple[int, int]:
        """The last base entry and the last entry; 0 before the first."""
        settled = self._rows("settled", SETTLED)
        if settled is None:
            return 0, 0
        base, last = settled.agg(F.max(F.when(F.col("base"), F.col("entry"))), F.max("entry")).first()
        return base or 0, last or 0

    def intervals(self) -> DataFrame:
        """``partition, first, last`` of what is stored and settled; entries may overlap."""
        base, last = self._entries()
        folders = [f"{self.folder}/entry={n}" for n in range(max(base, 1), last + 1)]
        if not folders:
            return self.spark.createDataFrame([], INTERVALS)
        return self.spark.read.schema(INTERVALS).parquet(*folders)

    def settle(self) -> None:
        """Note the positions of all files written since the first append that is not settled."""
        pending = self.pending()
        if pending is None:
            return
        notes = pending.orderBy("started").collect()  # Appends that broke off, and the one at hand.
        reader = self.spark.read.schema("`partition` int, `offset` bigint")
        new = reader.option("modifiedAfter", notes[0]["started"]).option("timeZone", "UTC").parquet(self.path)
        found = intervals_of(new)
        base, last = self._entries()
        entry, anew = last + 1, last + 1 - base >= ENTRIES_PER_BASE
        if anew:
            found = merged(found.unionByName(self.intervals()))
        found.write.mode("overwrite").parquet(f"{self.folder}/entry={entry}")
        done = self.spark.createDataFrame([(r["id"], entry, anew) for r in notes], SETTLED)
        done.coalesce(1).write.mode("append").parquet(f"{self.folder}/settled")
