"""One registered query for every operator, with production parameters, over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketflow.llm.ann import approximate_nearest
from marketflow.llm.bpe import encode_and_decode
from marketflow.llm.chat import format_paths, parsed_turns, threads, unescape
from marketflow.llm.common import WORD
from marketflow.llm.lm import language_model_scores
from marketflow.llm.mixing import mix
from marketflow.llm.periods import periodic_runs
from marketflow.llm.pieces import decode_pieces, encode_pieces
from marketflow.llm.quality import quality
from marketflow.llm.repeats import removal_digests
from marketflow.llm.simhash import near_duplicates
from marketflow.llm.topk import exact_top_k
from marketflow.llm.toxicity import toxicity
from marketflow.llm.whitening import Whitening, whitening


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return exact_top_k(vectors, F.col("vec_id") % 50 == 0, 5)


def op2_subword_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_chat_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations formatted as trees of one path each; everything is read back from the output."""
    said = F.lit("\\### Assistant: </turn> ok")
    added = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.element_at(F.array(F.lit("user"), F.lit("assistant")), F.col("id").cast("int") + 1).alias("role"), said.alias("text"),
    )
    stored = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    messages = threads(stored.unionByName(added))
    names = messages.filter("up IS NULL").select("tree", "conv_id")
    parsed = format_paths(messages).select("tree", "formatted", "loss_spans", parsed_turns("formatted").alias("turns"))
    line = F.lit("\n")
    whole = F.transform("turns", lambda t: F.concat(t["role"], line, t["text"], line))
    # What a trainer sees under the mask: the code points of the output from start to end.
    learned = F.transform(
        "loss_spans",
        lambda s: unescape(F.substring("formatted", s["start"].cast("int") + 1, (s["end"] - s["start"]).cast("int"))),
    )
    texts = parsed.select(
        "tree", "formatted", F.size("turns").cast("long").alias("n_turns"),
        F.array_join(whole, "").alias("whole"), F.array_join(learned, "").alias("learned"),
    )
    return texts.join(names, "tree").select(
        "conv_id", "n_turns", F.sha2("whole", 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op4_hash_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(_table(spark, sf_dir, "documents"))


def op5_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model_scores(_table(spark, sf_dir, "documents"))


def op6_graph_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return approximate_nearest(vectors, F.col("vec_id") % 20 == 0, 20)


def op7_pivot_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op8_zstd_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_and_decode(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op10_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removal_digests(_table(spark, sf_dir, "documents"))


def _deviation(x: str, fit: Whitening, shift: int) -> Column:
    """Sum over dimensions of ``(n * x - S) ** 2``, exact; an error where it does not fit a long."""
    sums = F.array(*map(F.lit, fit.sums)).cast("array<bigint>")
    fits = len(fit.sums) * (fit.rows * (fit.reach + 1)) ** 2 < 2**63
    kind = "bigint" if fits else "decimal(38,0)"

    def square(entry: Column, total: Column) -> Column:
        apart = (F.coalesce(entry, F.lit(shift)) * F.lit(fit.rows).cast("bigint") - total).cast(kind)
        return (apart * apart).cast(kind)

    total = F.aggregate(F.zip_with(x, sums, square), F.lit(0).cast(kind), lambda a, b: (a + b).cast(kind))
    if fits:
        return total
    small = total <= F.lit(2**63 - 1).cast("decimal(38,0)")
    return F.when(small, total.cast("bigint")).otherwise(F.raise_error(F.lit("a deviation does not fit a long")))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    shift = 100_000
    rows, fit, error = whitening(_table(spark, sf_dir, "embeddings"), 8, scale=1024.0, shift=shift)
    explained = F.array(*map(F.lit, fit.explained() if fit else [])).cast("array<double>")
    deviation = _deviation("x", fit, shift) if fit else F.lit(None).cast("long")
    # Worked out below the generator: once per row, not once per component.
    once = rows.select("vec_id", deviation.alias("deviation"), "whitened")
    return once.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(fit.rows if fit else 0).cast("long").alias("n"),
        "deviation", "whitened", F.get(explained, F.col("at")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )


def planted_periods(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: of every tenth document, by hash of its id, the tail repeats its first words."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    g = F.floor(h / 10)

    def repeated(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        places = F.sequence(F.lit(0).cast("long"), n - 1)
        tail = F.transform(places, lambda i: F.get(words, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")))
        return F.when(n > 0, F.array_join(tail, " ")).otherwise(F.lit(""))

    # The words are bound once, as the one element of an array.
    words = F.regexp_extract_all(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(f"({WORD})"), F.lit(1))
    text = F.when(h % 10 == 0, F.get(F.transform(F.array(words), repeated), F.lit(0))).otherwise(F.col("text").cast("string"))
    return docs.select("doc_id", text.alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(planted_periods(_table(spark, sf_dir, "documents")))
    # Largest length first, then smallest start and period.
    by_length = F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = F.array_min(by_length)
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    ).select(
        "doc_id", "n_runs", F.col("best.start").alias("start"), (-F.col("best.less")).alias("length"),
        F.col("best.period").alias("period"),
        F.floor(-F.col("best.less") * 1000 / F.col("best.period")).cast("long").alias("exponent_milli"),
        "runs_sha256", "collapsed_sha256",
    )


def op13_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    rows = decode_pieces(encode_pieces(_table(spark, sf_dir, "documents"), model), model)
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return rows.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


QUERIES = {
    "op1_exact_topk": op1_exact_topk,
    "op2_subword_quality": op2_subword_quality,
    "op3_chat_trees": op3_chat_trees,
    "op4_hash_mix": op4_hash_mix,
    "op5_kneser_ney": op5_kneser_ney,
    "op6_graph_ann": op6_graph_ann,
    "op7_pivot_simhash": op7_pivot_simhash,
    "op8_zstd_toxicity": op8_zstd_toxicity,
    "op9_word_bpe": op9_word_bpe,
    "op10_suffix_repeats": op10_suffix_repeats,
    "op11_whitening": op11_whitening,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_piece_bpe": op13_piece_bpe,
}
