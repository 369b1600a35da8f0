"""Mixing sources to target weights with hash thresholds, in DataFrame operations only.

Every document has a hash of 36 bits, of its id, source, text and number among equal rows. Words are summed by source and by the hash's first 12
bits; the running sum finds the bucket in which a source's budget ends; only documents of
that boundary bucket are summed again by the next 12 bits, and once more by the last 12. A
document is taken if its hash lies below the threshold: nothing is sorted, and runs agree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketflow.llm.common import WORD, every_number, materialize

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
LEVELS, BITS = 3, 12
#: Into so many parts each source is split where documents meet its threshold.
SALTS = 32


def word_count(text: str | Column) -> Column:
    column = F.col(text) if isinstance(text, str) else text
    return F.regexp_count(F.coalesce(column.cast("string"), F.lit("")), F.lit(WORD)).cast("long")


def row_key(id_column: str = "doc_id") -> Column:
    """md5 of a row's id, source and text; rows that agree in all three share it."""
    known = F.coalesce(F.col(id_column).cast("string"), F.lit(""))
    source = F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("n"))
    text = F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"))
    return F.md5(F.concat_ws("|", known, source, text).cast("binary"))


def _hash(key: Column, number: Column) -> Column:
    """First 36 bits of the md5 of a row's key and its number among the rows that share it."""
    digest = F.md5(F.concat_ws(":", key, number.cast("string")).cast("binary"))
    return F.conv(F.substring(digest, 1, LEVELS * BITS // 4), 16, 10).cast("long")


def source_targets(totals: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """``source, source_size`` with ``target``: shares by weight, none above ``most`` times its source.

    Sources take the weights in turn, by code point, null last. Filling all sources in step
    with their weights, those with the smallest ``most * size / weight`` stop first; what is
    left per weight then is largest where the first source that does not stop is reached.
    """
    ranked = totals.withColumn("place", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1)
    weight = F.get(F.array(*map(F.lit, weights)), (F.col("place") % len(weights)).cast("int"))
    ranked = ranked.withColumn("weight", weight).withColumn("cap", F.col("source_size") * most)
    fill = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    everyone = Window.partitionBy()
    money = F.sum("source_size").over(everyone) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    shares = F.sum("weight").over(everyone) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    levels = ranked.withColumn("level", money.cast("double") / shares.cast("double"))
    level = F.max("level").over(everyone)
    target = F.least(F.col("cap").cast("double"), level * F.col("weight"))
    return levels.select("source", "source_size", target.alias("target"))


def _salted(plan: DataFrame) -> DataFrame:
    """A plan with source ``of``, each row once per part of its source.

    Spark broadcasts it where its measured size allows; where not, a source that holds most
    documents is dealt to as many tasks as it has parts.
    """
    return plan.withColumn("_salt", every_number(SALTS))


def _of_source(known: DataFrame) -> Column:
    return F.col("source").eqNullSafe(known["of"]) & (F.pmod(F.col("hash"), F.lit(SALTS)) == known["_salt"])


def mixing_plan(sized: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """``source, source_size, target, copies, threshold`` of rows with ``source, size, hash``.

    Every document of a source is taken ``copies`` times and, if its hash is below
    ``threshold``, once more. The threshold is the one whose words come nearest the target.
    """
    totals = materialize(sized.groupBy("source").agg(F.sum("size").alias("source_size")))
    plan = source_targets(totals, weights, most)
    copies = F.coalesce(F.floor(F.try_divide("target", "source_size")), F.lit(0)).cast("long")
    plan = plan.withColumn("copies", copies)
    plan = plan.withColumn("budget", F.col("target") - F.col("copies") * F.col("source_size"))
    plan = materialize(plan.withColumn("threshold", F.lit(0).cast("long")))
    for level in range(LEVELS):
        shift = (LEVELS - 1 - level) * BITS
        known = _salted(plan.select(F.col("source").alias("of"), "threshold"))
        inside = _of_source(known) & (F.shiftright("hash", shift + BITS) == F.shiftright("threshold", shift + BITS))
        bucket = F.shiftright("hash", shift).alias("bucket")
        sums = sized.join(known, inside).groupBy("source", bucket).agg(F.sum("size").alias("words"))
        order = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.withColumn("below", F.coalesce(F.sum("words").over(order), F.lit(0)))
        boundary = (
            plan.join(sums.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
            .filter("below <= budget AND budget < below + words")
            .select("of", "bucket", "below", "words")
        )
        joined = plan.join(materialize(boundary), F.col("source").eqNullSafe(F.col("of")), "left")
        at = F.shiftleft(F.col("bucket"), shift)
        if level == LEVELS - 1:
            # The last bucket goes in if that brings the words nearer the target.
            at = at + F.when(2 * (F.col("budget") - F.col("below")) >= F.col("words"), 1).otherwise(0)
        plan = materialize(
            joined.select(
                "source", "source_size", "target", "copies",
                (F.col("budget") - F.coalesce("below", F.lit(0))).alias("budget"),
                F.coalesce(at, "threshold").alias("threshold"),
            )
        )
    return plan.drop("budget")


def with_hash(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """``docs`` with ``size`` and ``hash``; rows that share id, source and text get hashes of their own.

    Such rows are numbered from 0 so that a source of one row repeated is still taken in part.
    They are counted per task first, and running sums of the counts say where a task's numbers
    begin: no task holds all rows of a key, and the numbers do not depend on the layout.
    """
    keyed = docs.select(
        "*", word_count("text").alias("size"), row_key(id_column).alias("_key"),
        F.spark_partition_id().alias("_task"), F.monotonically_increasing_id().alias("_at"),
    )
    repeated = materialize(keyed.groupBy("_key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("_key"))
    once = keyed.join(repeated, "_key", "left_anti").withColumn("_number", F.lit(0).cast("long"))
    many = materialize(keyed.join(repeated, "_key", "left_semi"))
    counts = many.groupBy("_key", "_task").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("_key").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    begins = counts.select("_key", "_task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_begin"))
    own = F.row_number().over(Window.partitionBy("_key", "_task").orderBy("_at")) - 1
    numbered = many.withColumn("_own", own).join(begins, ["_key", "_task"])
    numbered = numbered.withColumn("_number", F.col("_begin") + F.col("_own")).select(*once.columns)
    both = once.unionByName(numbered)
    return both.withColumn("hash", _hash(F.col("_key"), F.col("_number"))).drop("_key", "_task", "_at", "_number")


def with_copies(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """``sized`` with ``source_size``, ``target`` and ``times``: how often the mix takes each row."""
    known = _salted(plan.withColumnRenamed("source", "of"))
    times = F.col("copies") + (F.col("hash") < F.col("threshold")).cast("long")
    joined = sized.join(known, _of_source(known), "left")
    return joined.withColumn("times", F.coalesce(times, F.lit(0))).drop("of", "_salt", "copies", "threshold")


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` of every row of ``docs``.

    A null text has no words, a null source is a source of its own, the last by name. Rows
    that repeat an id, or have none, are taken or left each on its own, and so are rows that
    are repeated whole. A text of any length is one row. An empty table gives no rows; other
    columns are not looked at. All sources empty: every target is 0.
    """
    sized = materialize(with_hash(docs.select("doc_id", F.col("source").cast("string"), "text")).drop("text"))
    taken = with_copies(sized, mixing_plan(sized, weights, most))
    return taken.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"))
