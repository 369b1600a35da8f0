"""A bounded sample of labelled documents, and scores appended to whole tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketflow.llm.common import id_remainder, materialize, tidy

#: Texts of a batch that are copied into Python objects at a time.
ROWS_AT_ONCE = 1000


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> tuple[DataFrame, dict[int, int]]:
    """``doc_id, text, label, order`` of at most ``per_class`` documents of label 0 and of label 1.

    Only ids whose crc32 modulo 5 is not 0 are looked at. They are chosen by hash of the id,
    so the choice does not depend on how the table is laid out. A document with several
    labels counts by the largest, one with several texts by that of the smallest md5; labels
    other than 0 and 1, and null ids, do not count. Also returns how many documents each label has, for weighing the sample back.
    """
    known = (
        labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & (id_remainder("doc_id") != 0))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max(label).cast("int").alias("label"))
    )
    sizes = {row["label"]: row["count"] for row in known.groupBy("label").count().collect()}
    ordered = known.withColumn("order", F.xxhash64("doc_id"))
    chosen = [ordered.filter(F.col("label") == c).orderBy("order", "doc_id").limit(per_class) for c in (0, 1)]
    # At most 2 * per_class rows of 20 bytes.
    few = F.broadcast(materialize(chosen[0].union(chosen[1])))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    one = F.min_by("text", F.md5(F.col("text").cast("binary"))).alias("text")
    sample = texts.join(few, "doc_id").groupBy("doc_id", "label", "order").agg(one)
    return materialize(sample.select("doc_id", "text", "label", "order")), sizes


def class_weights(labels: np.ndarray, sizes: dict[int, int]) -> np.ndarray:
    """Weights that give each class of the sample its share of all labelled documents."""
    each = {c: sizes.get(c, 0) / max(1, int((labels == c).sum())) for c in (0, 1)}
    return np.array([each[int(c)] for c in labels], dtype=np.float64)


def append_scores(
    docs: DataFrame, score: Callable[[list[bytes]], np.ndarray], name: str = "score", text_column: str = "text"
) -> DataFrame:
    """``docs`` with a double that ``score`` gives each text; a column of that name is replaced."""
    kept = docs.select(*(F.col(f"`{c}`") for c in docs.columns if c.lower() != name.lower()))
    place = [c.lower() for c in kept.columns].index(text_column.lower())

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column, found = batch.column(place).cast(pa.binary()), []
            for a in range(0, len(column), ROWS_AT_ONCE):
                texts = [t or b"" for t in column.slice(a, ROWS_AT_ONCE).to_pylist()]
                found.append(np.asarray(score(texts), dtype=np.float64))
            found = pa.array(np.concatenate(found) if found else np.empty(0))
            yield pa.RecordBatch.from_arrays([*batch.columns, found], names=[*batch.schema.names, name])

    schema = T.StructType([*kept.schema.fields, T.StructField(name, T.DoubleType())])
    return kept.mapInArrow(tidy(scored), schema)
