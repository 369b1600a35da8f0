"""Quality classifier: supervised subword embeddings.

A document is the average of learned vectors, one per hashed word and per hashed character
n-gram (3 and 4 bytes, not across words), with a softmax layer on top, trained by stochastic
gradient descent in numpy. A word that repeats the one before it, one space away, is written as one
common token, as fixed word vectors could not tell repetition otherwise.

Once trained, vectors and output layer collapse into one number per hash bucket, and a
document's score is a mean of looked-up numbers: scoring is one pass over the bytes, needs
no shuffle, and sends 1 MB of model to the tasks however large the corpus is.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketflow.llm.common import id_remainder
from marketflow.llm.labels import append_scores, class_weights, labelled_sample

#: Labelled rows per class that the model is fitted on, at most; chosen by hash of the id.
SAMPLE_PER_CLASS = 1024
THRESHOLD = 0.3
BUCKET_BITS = 16
DIMENSIONS = 8
EPOCHS = 10
RATE = 0.5
#: Vectors move by their share of the average times this, and never faster than the layer.
VECTOR_BOOST = 50
PIECE = 1 << 18

BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
SPACE = 32
FEATURE_TYPES = (pa.list_(pa.int32()), pa.list_(pa.float32()))


def pieces(texts: Iterator[bytes], size: int = PIECE) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Bytes of a bounded number of texts at a time, where each begins, and their numbers.

    White space is one kind of space, and every text ends in two. A text longer than
    ``size`` is cut at a space; only a word that long is cut itself.
    """
    table = bytes.maketrans(b"\t\n\v\f\r", b"     ")
    held, starts, numbers, total = [], [], [], 0

    def out() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return np.frombuffer(b"".join(held), dtype=np.uint8), np.array(starts), np.array(numbers)

    for number, text in enumerate(texts):
        text = text.translate(table)
        at = 0
        while True:
            end = len(text)
            if end - at > size:
                end = max(text.rfind(b" ", at + 1, at + size), at) or at
                end = end if end > at else at + size
            part = b" " + text[at:end] + b"  "
            if held and total + len(part) > size:
                yield out()
                held, starts, numbers, total = [], [], [], 0
            starts.append(total)
            numbers.append(number)
            held.append(part)
            total += len(part)
            at = end
            if at >= len(text):
                break
    if held:
        yield out()


def features(buffer: np.ndarray, bits: int = BUCKET_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a buffer's words and n-grams, and the place where each begins, in order of place.

    Words lie in the lower half of ``2 ** (bits + 1)`` buckets, n-grams in the upper.
    """
    space = buffer == SPACE
    wide = buffer.astype(np.uint32)
    three = wide[:-2] | (wide[1:-1] << np.uint32(8)) | (wide[2:] << np.uint32(16))
    four = three[:-1] | (wide[3:] << np.uint32(24))
    # An n-gram may begin or end with the space around a word, but not hold one inside.
    at3 = np.flatnonzero(~space[1:-1] & ~(space[:-2] & space[2:]))
    at4 = np.flatnonzero(~space[1:-2] & ~space[2:-1])
    down = np.uint32(32 - bits)
    grams3 = (three[at3] * np.uint32(2654435761)) >> down
    grams4 = ((four[at4] ^ np.uint32(0x5BD1E995)) * np.uint32(2246822519)) >> down
    # Words: differences of a running polynomial sum, brought back to a common exponent.
    n = len(buffer)
    powers = _powers(n)
    sums = np.cumsum(buffer.astype(np.uint64) * powers[0][:n])
    begins = np.flatnonzero(space[:-1] & ~space[1:])
    ends = np.flatnonzero(~space[:-1] & space[1:])
    words = (sums[ends] - sums[begins]) * powers[1][begins]
    same = np.zeros(len(words), dtype=bool)
    same[1:] = (words[1:] == words[:-1]) & (begins[1:] == ends[:-1] + 1)
    words = ((words ^ (words >> np.uint64(29))) * BASE) >> np.uint64(64 - bits)
    words[same] = 0
    upper = np.uint32(1 << bits)
    buckets = np.concatenate([words.astype(np.uint32), grams3 + upper, grams4 + upper])
    places = np.concatenate([begins, at3, at4])
    return buckets, places


_POWERS: list[np.ndarray] = []


def _powers(n: int) -> list[np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, 2 * PIECE)
        _POWERS[:] = [
            np.cumprod(np.full(size, base, dtype=np.uint64), dtype=np.uint64) for base in (BASE, INVERSE)
        ]
    return _POWERS


@dataclass(frozen=True)
class Model:
    """One number per bucket, and what is added; ``empty`` is the score of texts without words."""

    numbers: np.ndarray
    bias: float
    empty: float
    bits: int

    def scores(self, texts: list[bytes]) -> np.ndarray:
        sums, counts = np.zeros(len(texts)), np.zeros(len(texts))
        for buffer, starts, of in pieces(iter(texts)):
            buckets, places = features(buffer, self.bits)
            doc = np.searchsorted(starts, places, side="right") - 1
            here = np.bincount(doc, weights=self.numbers[buckets], minlength=len(starts))
            np.add.at(sums, of, here)
            np.add.at(counts, of, np.bincount(doc, minlength=len(starts)))
        logits = sums / np.maximum(counts, 1) + self.bias
        return np.where(counts > 0, 1 / (1 + np.exp(-np.clip(logits, -500, 500))), self.empty)


def train(
    documents: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, weights: np.ndarray,
    bits: int = BUCKET_BITS, dimensions: int = DIMENSIONS, epochs: int = EPOCHS, rate: float = RATE,
) -> Model:
    """Vectors and softmax layer by stochastic gradient descent over documents of buckets and counts."""
    rng = np.random.default_rng(11)
    prior = float((weights * labels).sum() / weights.sum()) if len(labels) else 0.5
    vectors = rng.uniform(-1, 1, (2 << bits, dimensions)).astype(np.float32) / dimensions
    layer, bias = np.zeros((2, dimensions)), np.zeros(2)
    shares = [counts / counts.sum() for _, counts in documents]
    steps, step = epochs * max(1, len(documents)), 0
    mean_weight = weights.mean() if len(weights) else 1.0
    for _ in range(epochs):
        for n in rng.permutation(len(documents)):
            ids, share = documents[n][0], shares[n]
            speed = rate * (1 - step / steps) * weights[n] / mean_weight
            step += 1
            hidden = share @ vectors[ids]
            logits = layer @ hidden + bias
            odds = np.exp(logits - logits.max())
            error = odds / odds.sum()
            error[int(labels[n])] -= 1
            back = layer.T @ error
            layer -= speed * np.outer(error, hidden)
            bias -= speed * error
            vectors[ids] -= (speed * np.minimum(1, VECTOR_BOOST * share)[:, None] * back).astype(np.float32)
    direction = layer[1] - layer[0]
    return Model((vectors @ direction).astype(np.float32), float(bias[1] - bias[0]), prior, bits)


def document_features(text: bytes, bits: int = BUCKET_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a whole text and how often each occurs."""
    total = np.zeros(2 << bits, dtype=np.int64)
    for buffer, _, _ in pieces(iter([text])):
        total += np.bincount(features(buffer, bits)[0], minlength=2 << bits)
    ids = np.flatnonzero(total)
    return ids.astype(np.int32), total[ids].astype(np.float32)


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = SAMPLE_PER_CLASS) -> Model:
    """A model of the labelled texts; features are worked out in Spark, descent runs on the driver.

    The sample is at most ``2 * per_class`` documents, each at most two numbers per bucket.
    Without labels every score is 0.5; with labels of one class only, near that class.
    """

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [document_features(t) for t in batch.column(0).cast(pa.binary()).to_pylist()]
            arrays = [pa.array([f[i] for f in found], type=t) for i, t in enumerate(FEATURE_TYPES)]
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), *arrays], names=["label", "order", "ids", "counts"])

    sample, sizes = labelled_sample(docs, labels, label, per_class)
    rows = sample.select("text", "label", "order").mapInArrow(of, "label int, order long, ids array<int>, counts array<float>")
    table = rows.toArrow().sort_by("order")
    documents = [
        (np.asarray(i.values), np.asarray(c.values)) for i, c in zip(table["ids"], table["counts"]) if len(i)
    ]
    some = [bool(len(i)) for i in table["ids"]]
    answers = table["label"].to_numpy()[np.array(some, dtype=bool)]
    return train(documents, answers, class_weights(answers, sizes))


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``.

    A null or blank text gets the share of label 1 among the labelled documents. Very long texts
    count whole, a piece of 256 KB at a time. Repeated rows score alike; an empty table gives no rows; other columns are not looked at.
    """
    model = fit_quality(docs, labels)
    scored = append_scores(docs.select("doc_id", F.col("text").cast("string")), model.scores)
    return scored.select(
        "doc_id", (id_remainder("doc_id") == 0).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
