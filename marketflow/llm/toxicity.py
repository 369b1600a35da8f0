"""Toxicity by compression distance with zstandard dictionaries.

A dictionary that zstandard trains on toxic windows is set against one that it trains on
ordinary windows; both follow a base that is trained on ordinary text. A second pair follows the
same base with segments of words: those that toxic documents hold significantly more often than
ordinary ones, and those of the reverse. What windows shrink more with the toxic dictionary of
a pair than with the ordinary one, and how often, is turned into a probability by thresholds and
a logistic curve calibrated on labelled documents that the dictionaries were not made from.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketflow.llm.common import id_remainder, materialize
from marketflow.llm.labels import append_scores, class_weights, labelled_sample

#: Labelled rows per class that are looked at, at most: half for dictionaries, half for calibration.
SAMPLE_PER_CLASS = 2048
WINDOW, STRIDE = 48, 24
BASE_BYTES = 60_000
#: Bytes of the dictionary of either class that follows the base.
CLASS_BYTES = 4_000
LEVEL = 6
#: Segments are beginnings of words of 4 to 12 bytes with the space before, or whole words.
SEGMENT_BYTES = range(5, 14)
LEAST_DOCUMENTS = 6
#: Likelihood ratio (G squared) of a segment's document counts: chance gives 30 once in 20 million.
LEAST_RATIO = 30.0
GAINS = (1, 2, 3, 5)
WINDOWS_AT_ONCE = 20_000
THRESHOLD = 0.5

SPACES = bytes.maketrans(b"\t\n\v\f\r", b"     ")


def cleaned(text: bytes | None) -> bytes:
    """Lower case (A-Z), one kind of space, and a space at either end."""
    return b" " + (text or b"").lower().translate(SPACES) + b" "


def windows(text: bytes) -> Iterator[bytes]:
    for start in range(0, max(1, len(text) - WINDOW + STRIDE), STRIDE):
        yield text[start : start + WINDOW]


def segments(text: bytes) -> set[bytes]:
    """Beginnings of a text's words, and whole short words, each with the spaces around."""
    out = set()
    for word in set(text.split()):
        spaced = b" " + word
        for size in SEGMENT_BYTES:
            if size > len(spaced):
                break
            out.add(spaced[:size])
        if len(spaced) < SEGMENT_BYTES.stop - 1:
            out.add(spaced + b" ")
    return out


@dataclass(frozen=True)
class Model:
    """Pairs of an ordinary and a toxic dictionary, and a logistic curve over what windows gain."""

    pairs: tuple[tuple[bytes, bytes], ...]
    curve: np.ndarray

    def gains(self, texts: list[bytes]) -> np.ndarray:
        """Per text and pair: what windows gain beyond each threshold by the square root of their number, the most; size."""
        compressors = [[_compressor(d) for d in pair] for pair in self.pairs]
        each = len(GAINS) + 1
        out = np.zeros((len(texts), n_features(len(self.pairs))))
        counts = np.zeros(len(texts))
        out[:, len(GAINS) : -1 : each] = -1
        held: list[bytes] = []
        of: list[int] = []

        def flush() -> None:
            if not held:
                return
            numbers = np.array(of)
            for p, pair in enumerate(compressors):
                ordinary, toxic = (
                    np.fromiter(map(len, c.multi_compress_to_buffer(held)), dtype=np.int64, count=len(held)) for c in pair
                )
                gain = ordinary - toxic
                for n, least in enumerate(GAINS):
                    out[:, p * each + n] += np.bincount(numbers, weights=np.maximum(gain - least, 0), minlength=len(texts))
                np.maximum.at(out[:, p * each + len(GAINS)], numbers, gain)
            counts[:] += np.bincount(numbers, minlength=len(texts))
            held.clear()
            of.clear()

        for number, text in enumerate(texts):
            for window in windows(cleaned(text)):
                held.append(window)
                of.append(number)
                if len(held) >= WINDOWS_AT_ONCE:
                    flush()
        flush()
        for n in range(len(GAINS)):
            out[:, n : -1 : each] /= np.sqrt(np.maximum(counts, 1))[:, None]
        out[:, -1] = np.log1p(counts)
        return out

    def scores(self, texts: list[bytes]) -> np.ndarray:
        logits = self.gains(texts) @ self.curve[:-1] + self.curve[-1]
        return 1 / (1 + np.exp(-np.clip(logits, -500, 500)))


def n_features(pairs: int) -> int:
    return pairs * (len(GAINS) + 1) + 1


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    settings = zstandard.ZstdCompressionParameters.from_level(
        LEVEL, write_content_size=0, write_checksum=0, write_dict_id=0
    )
    content = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(dict_data=content if dictionary else None, compression_params=settings)


def trained(samples: list[bytes], size: int) -> bytes:
    """Content of a dictionary trained on windows; where zstandard finds them too few to train on, the windows."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except (ValueError, zstandard.ZstdError):
        return b"".join(samples)


def level(one: bytes, other: bytes) -> tuple[bytes, bytes]:
    """Ends of two dictionaries made equally long, so that the base before lies equally far back."""
    size = max(len(one), len(other))
    return one.rjust(size), other.rjust(size)


def chosen_segments(ranked: Iterable[bytes]) -> list[bytes]:
    """In order of significance, those that neither hold, nor lie in, one before."""
    out: list[bytes] = []
    for segment in ranked:
        if not any(s in segment or segment in s for s in out):
            out.append(segment)
    return out


def logistic(features: np.ndarray, answers: np.ndarray, weights: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Coefficients and constant of a logistic regression by Newton's method, slightly shrunk."""
    x = np.column_stack([features, np.ones(len(features))])
    found = np.zeros(x.shape[1])
    total = weights.sum()
    if total:
        prior = np.clip((weights * answers).sum() / total, 1e-3, 1 - 1e-3)
        found[-1] = np.log(prior / (1 - prior))
    shrink = 1e-2 * np.eye(x.shape[1])
    shrink[-1, -1] = 1e-9
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ found, -30, 30)))
        slope = x.T @ (weights * (p - answers)) + shrink @ (found * (np.arange(len(found)) < len(found) - 1))
        bend = (x * (weights * p * (1 - p) + 1e-9)[:, None]).T @ x + shrink
        step = np.linalg.solve(bend, slope)
        step *= min(1.0, 5 / max(1e-12, np.abs(step).max()))
        found = found - step
        if np.abs(step).max() < 1e-6:
            break
    return found


def _mapped(texts: DataFrame, of, schema: str) -> DataFrame:
    """Rows that ``of`` makes of each ``text`` and ``label``."""

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, label in zip(batch.column(0).cast(pa.binary()).to_pylist(), batch.column(1).to_pylist()):
                yield of(text, label)

    return texts.select("text", "label").mapInArrow(mapped, schema)


def fit_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = SAMPLE_PER_CLASS) -> Model:
    """Dictionaries and calibration from a bounded sample of labelled documents.

    Of these documents nothing is left out: the driver gets all windows and significant segments of
    the half that dictionaries are made from, at most ``2 * per_class`` texts of any length and
    about twice their size, and a row of numbers per document of the other half.
    """
    sample, sizes = labelled_sample(docs, labels, label, per_class)
    learn = sample.filter(F.pmod(F.xxhash64(F.lit(1), "doc_id"), F.lit(2)) == 0)
    check = sample.filter(F.pmod(F.xxhash64(F.lit(1), "doc_id"), F.lit(2)) == 1)

    def found_segments(text: bytes, answer: int) -> pa.RecordBatch:
        found = sorted(segments(cleaned(text)))
        return pa.record_batch([pa.array(found, pa.binary()), pa.array([answer] * len(found), pa.int32())], names=["segment", "label"])

    def found_windows(text: bytes, _: int | None) -> pa.RecordBatch:
        return pa.record_batch([pa.array(list(windows(cleaned(text))), pa.binary())], names=["window"])

    all_of = {r["label"]: r["count"] for r in learn.groupBy("label").count().collect()}
    counts = (
        _mapped(learn, found_segments, "segment binary, label int")
        .groupBy("segment")
        .agg(F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("ordinary"))
        .filter(F.greatest("toxic", "ordinary") >= LEAST_DOCUMENTS)
    )
    n_toxic, n_ordinary = F.lit(float(all_of.get(1, 0))), F.lit(float(all_of.get(0, 0)))
    share = (F.col("toxic") + F.col("ordinary")) / (n_toxic + n_ordinary)

    def term(seen, expected):
        return F.when(seen > 0, 2 * seen * F.ln(seen / expected)).otherwise(0.0)

    ratio = (
        term(F.col("toxic"), n_toxic * share) + term(n_toxic - F.col("toxic"), n_toxic * (1 - share))
        + term(F.col("ordinary"), n_ordinary * share) + term(n_ordinary - F.col("ordinary"), n_ordinary * (1 - share))
    )
    significant = materialize(counts.withColumn("ratio", F.round(ratio, 6)).filter(F.col("ratio") >= LEAST_RATIO))
    more = F.col("toxic") * n_ordinary - F.col("ordinary") * n_toxic

    def markers(of_class: Column, seen: str) -> list[bytes]:
        """Segments of a class; they come one partition at a time, as many as it takes."""
        ranked = (
            significant.filter(of_class & (F.col(seen) >= LEAST_DOCUMENTS))
            .orderBy(F.desc("ratio"), F.desc(F.length("segment")), "segment")
            .select("segment")
        )
        return chosen_segments(bytes(r["segment"]) for r in ranked.toLocalIterator())

    toxic_markers, ordinary_markers = markers(more > 0, "toxic"), markers(more < 0, "ordinary")

    def marked_windows(text: bytes, _: int | None) -> pa.RecordBatch:
        some = [w for w in windows(cleaned(text)) if any(m in w for m in toxic_markers)]
        return pa.record_batch([pa.array(some, pa.binary())], names=["window"])

    def training(answer: int, of) -> list[bytes]:
        found = _mapped(learn.filter(F.col("label") == answer), of, "window binary")
        return found.orderBy(F.xxhash64("window"), "window").toArrow()["window"].to_pylist()

    # Most windows of a toxic document are ordinary text: those with its segments are the toxic ones.
    ordinary_windows = training(0, found_windows)
    toxic_windows = training(1, marked_windows if toxic_markers else found_windows)
    shared = trained(ordinary_windows, BASE_BYTES)
    # The base has learnt from all ordinary windows; what follows it, from as many of either class.
    own = level(trained(ordinary_windows[: max(1, len(toxic_windows))], CLASS_BYTES), trained(toxic_windows, CLASS_BYTES))
    tails = level(*(b"".join(reversed(m)) for m in (ordinary_markers, toxic_markers)))
    pairs = tuple(tuple(shared + end for end in ends) for ends in (own, tails))
    plain = Model(pairs, np.zeros(n_features(len(pairs)) + 1))

    def numbers(text: bytes, answer: int) -> pa.RecordBatch:
        row = pa.array(plain.gains([text]).tolist(), pa.list_(pa.float64()))
        return pa.record_batch([pa.array([answer], pa.int32()), row], names=["label", "gains"])

    table = _mapped(check, numbers, "label int, gains array<double>").toArrow()
    answers = table["label"].to_numpy().astype(np.float64)
    gains = np.array(table["gains"].to_pylist(), dtype=np.float64).reshape(-1, n_features(len(pairs)))
    return Model(pairs, logistic(gains, answers, class_weights(answers, sizes)))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``.

    A null text is empty and scores as a text in which no window gains. Very long texts count
    whole, 20,000 windows at a time. Without labels every score is 0.5. Repeated rows score alike; an empty table gives no rows; other columns are
    not looked at.
    """
    model = fit_toxicity(docs, labels)
    scored = append_scores(docs.select("doc_id", F.col("text").cast("string")), model.scores)
    return scored.select(
        "doc_id", (id_remainder("doc_id") == 0).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
