"""File topics that number their records, as a broker does.

Records get consecutive offsets per topic partition, in the order of the tasks that read them and,
within a task, in the order it reads them. Nothing is sorted as a whole: records are counted per
task, running sums of the counts say where a task's numbers begin, and each task's records are
numbered on their own. A topic partition with most of the records is spread over as many tasks
as read them.

A batch is a folder ``records/batch=<n>``; the offsets at which the next one goes on are written last, to
``ends/batch=<n>``. A batch without them is not read and is written over by the next attempt.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from marketflow.sources.topics import RECORD_COLUMNS, Offsets, in_range, topic_records
from marketflow.sources.work import claim_batch_folder, claim_stream_folder, new_work_dir

PLACE = ("topic", "partition")
ENDS = "topic string, `partition` int, next_offset bigint, batch bigint"


def with_offsets(records: DataFrame, ends: DataFrame | None = None) -> DataFrame:
    """``records`` (``topic``, ``partition`` and others) with ``offset``: consecutive per topic partition.

    ``ends`` (``topic, partition, next_offset``) says where numbers go on; else they begin at 0. The
    records are written to a work folder first: their numbers do not change if a task is run
    again. An ``offset`` that was there is replaced.
    """
    spark = records.sparkSession
    folder = new_work_dir(spark)
    others = [c for c in records.columns if c.lower() != "offset"]
    placed = records.select(
        *(f"`{c}`" for c in others), F.spark_partition_id().alias("_task"), F.monotonically_increasing_id().alias("_at")
    )
    placed.write.parquet(folder)
    placed = spark.read.schema(placed.schema).parquet(folder)
    counts = placed.groupBy(*PLACE, "_task").agg(F.count(F.lit(1)).alias("_n"))
    # One row per task and topic partition.
    before = Window.partitionBy(*PLACE).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    begins = counts.select(*PLACE, "_task", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_begin"))
    if ends is not None:
        begins = begins.join(ends.select(*PLACE, "next_offset"), list(PLACE), "left")
        begins = begins.withColumn("_begin", F.col("_begin") + F.coalesce("next_offset", F.lit(0))).drop("next_offset")
    own = Window.partitionBy(*PLACE, "_task").orderBy("_at")
    numbered = placed.withColumn("_own", F.row_number().over(own) - 1).join(begins, [*PLACE, "_task"])
    return numbered.select(*(f"`{c}`" for c in others), (F.col("_begin") + F.col("_own")).cast("bigint").alias("offset"))


@dataclass(frozen=True)
class NumberedTopics:
    """Topics as Parquet files below ``path``, with offsets assigned as records come.

    A folder is filled by batches, or by one stream. Readers see whole batches alone.
    """

    path: str

    SCHEMA = (
        "key string, `partition` int, `offset` bigint, value string, timestamp timestamp, batch bigint, topic string"
    )

    def _ends(self, spark: SparkSession, before: int | None = None) -> tuple[int, DataFrame | None]:
        """The last whole batch (before a given one) and the offsets after it; -1 and null at first."""
        try:
            ends = spark.read.schema(ENDS).parquet(f"{self.path}/ends")
        except AnalysisException:
            return -1, None
        if before is not None:
            ends = ends.filter(F.col("batch") < before)
        last = ends.agg(F.max("batch")).first()[0]
        return (-1, None) if last is None else (last, ends.filter(F.col("batch") == last))

    def ends(self, spark: SparkSession) -> DataFrame:
        """``topic, partition, next_offset`` of every topic partition that has records."""
        _, ends = self._ends(spark)
        known = spark.createDataFrame([], ENDS) if ends is None else ends
        return known.filter("topic IS NOT NULL").select(*PLACE, "next_offset")

    def _write(self, records: DataFrame, batch: int) -> None:
        spark = records.sparkSession
        _, ends = self._ends(spark, batch)
        numbered = with_offsets(topic_records(records, F.lit(None).cast("bigint")), ends)
        folder = f"{self.path}/records/batch={batch}"
        numbered.write.mode("overwrite").partitionBy("topic").parquet(folder)
        written = spark.read.schema("`partition` int, `offset` bigint, topic string").parquet(folder)
        now = written.groupBy(*PLACE).agg((F.max("offset") + 1).alias("next_offset"))
        # A row without a topic marks the batch as whole where it brought nothing new.
        now = now.unionByName(spark.range(1).selectExpr("cast(null as string) topic", "cast(null as int) partition", "0L next_offset"))
        if ends is not None:
            now = now.unionByName(ends.select(*PLACE, "next_offset"))
        now = now.groupBy(*PLACE).agg(F.max("next_offset").alias("next_offset"))
        now.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/ends/batch={batch}")

    def append(self, records: DataFrame) -> int:
        """Append a batch of records (``topic``, ``partition``, ``value``, and ``key``, ``timestamp`` if any); its number.

        One job at a time appends.
        """
        spark = records.sparkSession
        claim_batch_folder(spark, self.path)
        batch = self._ends(spark)[0] + 1
        self._write(records, batch)
        return batch

    def write_batch(self, records: DataFrame, batch: int) -> None:
        """Append a stream's batch; one that is whole already, as a restart may bring it again, changes nothing."""
        if batch > self._ends(records.sparkSession)[0]:
            self._write(records, batch)

    def start(self, records: DataFrame, checkpoint: str, *, live: bool = False) -> StreamingQuery:
        """Append a stream of records, batch by batch."""
        claim_stream_folder(records.sparkSession, self.path, checkpoint)
        writer = records.writeStream.foreachBatch(self.write_batch).option("checkpointLocation", checkpoint)
        return (writer if live else writer.trigger(availableNow=True)).start()

    def read(
        self,
        spark: SparkSession,
        topic: str,
        start: Offsets | None = None,
        end: Offsets | None = None,
        *,
        since: dt.datetime | None = None,
        until: dt.datetime | None = None,
    ) -> DataFrame:
        """What is on the topic so far, or a range of offsets or of record times."""
        last, _ = self._ends(spark)
        if last < 0:
            return spark.createDataFrame([], self.SCHEMA).select("topic", *RECORD_COLUMNS)
        files = spark.read.schema(self.SCHEMA).parquet(f"{self.path}/records")
        rows = files.filter((F.col("batch") <= last) & (F.col("topic") == topic))
        return in_range(rows, start, end, since, until).select("topic", *RECORD_COLUMNS)
