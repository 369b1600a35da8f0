"""Raw documents to a deduplicated, mixed and encoded corpus, stage by stage.

Every stage takes the documents its predecessor kept. All but the last return the columns of
``documents``; the last returns one row of digests per document.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketflow.llm.bpe import encode_and_decode
from marketflow.llm.common import materialize
from marketflow.llm.labels import append_scores
from marketflow.llm.mixing import mixing_plan, with_copies, with_hash
from marketflow.llm.quality import THRESHOLD, fit_quality
from marketflow.llm.repeats import without_repeats
from marketflow.llm.simhash import chosen_keys


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts as label 1 (op 2); others go.

    Null and blank texts score as the share of label 1 among labelled documents; very long texts
    count whole; repeated rows stay or go together; columns of any name are kept; an empty table
    stays empty.
    """
    model = fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = "_score"
    while score in (c.lower() for c in docs.columns):
        score = "_" + score
    return append_scores(docs, model.scores, score).filter(F.col(score) >= THRESHOLD).drop(score)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates (op 7): the one with the smallest id, if any has one.

    Rows are told apart by id and text, so rows that share an id but not their text are judged
    each on its own, as are rows without an id; of rows that agree in both, one stays. A null
    text is empty; texts without words are one group; very long texts count whole; an empty
    table stays empty.
    """
    text = F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"))
    key = F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), text)
    chosen = materialize(chosen_keys(docs, key))
    keyed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), key.alias("key"))
    kept = keyed.join(chosen, "key", "left_semi").dropDuplicates(["key"])
    return kept.select("_row.*")


def repeats_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 100 bytes that also start earlier are cut out of texts (op 10); all documents stay.

    A null text stays null; very long texts count whole; of repeated rows all lose the same; an
    empty table stays empty.
    """
    cut = without_repeats(docs)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else cut


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources brought to their targets (op 4): documents left out go, repeated ones come again.

    A null source is one of its own; null and blank texts add no words and may come any number of
    times up to three; rows that share an id are taken each on its own; an empty table stays empty.
    """
    sized = with_hash(docs.withColumn("_row", F.struct(*docs.columns)).select("_row", "doc_id", "source", "text"))
    numbers = materialize(sized.select("source", "size", "hash"))
    taken = with_copies(sized, mixing_plan(numbers)).filter("times > 0")
    return taken.select("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))).select("_row.*")


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that the mix holds, by digest (op 9).

    A null text has no tokens; very long texts are encoded whole; repeated rows are all returned;
    other columns are not looked at; an empty table gives no rows.
    """
    return encode_and_decode(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", quality_stage),
    ("near duplicates", near_duplicate_stage),
    ("repeats", repeats_stage),
    ("mixing", mixing_stage),
    ("encoding", encoding_stage),
]

# SQL can express neither the classifier nor the tokenizer; tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = materialize(docs)
    return docs
