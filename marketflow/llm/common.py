"""Helpers that several operators of this subpackage use."""

from __future__ import annotations

import ctypes
import math
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketflow.sources.work import new_work_dir

#: Characters that separate words, as a regular expression class of those that make words.
WORD = r"[^\x20\x09-\x0D]+"


def materialize(rows: DataFrame) -> DataFrame:
    """Write rows to a fresh table in the shared work folder and read them back.

    This cuts the lineage: a lost executor costs the tasks it was running, not what is written.
    """
    spark = rows.sparkSession
    path = new_work_dir(spark)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def give_back() -> None:
    """Return memory that a task has freed to the system: workers go on to other stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def tidy(mapped: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """A function over a task's batches that gives back its memory at the end."""

    @wraps(mapped)
    def run(batches):
        yield from mapped(batches)
        give_back()

    return run


def parts_for(rows: int, per_part: int) -> int:
    return max(1, math.ceil(rows / per_part))


def every_number(count: int) -> Column:
    """Explodes each row into one for every number from 0 below ``count``."""
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long")))


def id_remainder(doc_id: str | Column, modulus: int = 5) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as the empty text."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % modulus


def finite_vector(vector: str | Column) -> Column:
    """True where a vector is there and every component is a finite number."""
    column = F.col(vector) if isinstance(vector, str) else vector
    ok = F.forall(column, lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(float("inf")), F.lit(False)))
    return F.coalesce(ok, F.lit(False))
