"""Near duplicates by SimHash: pivot distance tables over candidates that share bits.

Two fingerprints of 64 bits within a distance of 4 agree in at least two of six ranges of
bits, so all links lie between fingerprints that share one of the 15 pairs of ranges. Among
those, Hamming distances to fixed reference fingerprints (pivots) are worked out once per
fingerprint; as distances obey the triangle inequality, a pair whose distances to any pivot
differ by more than 4 is discarded, and only survivors are verified bit by bit.

Pivots alone would not do: distances of unrelated fingerprints to a pivot all lie near 32
(standard deviation 4), so one coordinate passes over half of all pairs, and every pair
would have to be looked at. The shared ranges keep the candidates near the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketflow.llm.common import materialize, tidy
from marketflow.llm.components import connected_components

SHINGLE_WORDS = 4
MOST_BITS = 4
#: Ranges of bits, two more than bits may differ.
RANGES = MOST_BITS + 2
#: Fingerprints of one key that are compared with one another in one task.
CHUNK = 2048
#: Reference fingerprints: hashes of the numbers below 16.
PIVOTS = np.array([xxhash.xxh64_intdigest(str(i)) for i in range(16)], dtype=np.uint64)
FIRST_PIVOTS = 4
PAIRS_AT_ONCE = 1 << 20


def fingerprint(text: bytes | None, shingle: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of a UTF-8 text; a text without words has fingerprint 0."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    width = min(shingle, len(words))
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[: len(words) - width + 1].tolist()
    ends = ends[width - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], 42) for a, b in zip(starts, ends)], dtype=">u8")
    counts = np.zeros(64, dtype=np.int64)
    for a in range(0, len(hashes), 1 << 16):
        part = hashes[a : a + (1 << 16)]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def fingerprints(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", key: Column | None = None
) -> DataFrame:
    """``doc_id, fp``: the fingerprint of every whole text, as a signed long; with ``key``, a text, if one is given."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            fps = np.fromiter((fingerprint(t.as_py()) for t in texts), dtype=np.uint64, count=len(texts))
            others = [batch.column(0), *batch.columns[2:]]
            yield pa.record_batch([*others, pa.array(fps.view(np.int64))], names=["doc_id", *batch.schema.names[2:], "fp"])

    more = [] if key is None else [key.alias("key")]
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"), *more)
    return rows.mapInArrow(tidy(of), f"doc_id long, {'key string, ' if more else ''}fp long")


def range_masks(ranges: int = RANGES, shared: int = RANGES - MOST_BITS) -> list[int]:
    """Masks of every choice of ``shared`` out of ``ranges`` ranges of bits, as signed longs."""
    edges = [64 * i // ranges for i in range(ranges + 1)]
    masks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    chosen = [sum(c) for c in combinations(masks, shared)]
    return [m - (1 << 64) if m >> 63 else m for m in chosen]


def hook(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest labels of what is connected, after also connecting ``a`` with ``b``."""
    while len(a):
        low, high = np.minimum(labels[a], labels[b]), np.maximum(labels[a], labels[b])
        apart = low != high
        a, b, low, high = a[apart], b[apart], low[apart], high[apart]
        np.minimum.at(labels, high, low)
        while True:
            onward = labels[labels]
            if (onward == labels).all():
                break
            labels = onward
    return labels


def _pairs(starts: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows within runs, a bounded number at a time."""
    for size in np.unique(sizes[sizes > 1]):
        of = starts[sizes == size]
        if size * (size - 1) // 2 <= PAIRS_AT_ONCE:
            i, j = np.triu_indices(size, 1)
            step = max(1, PAIRS_AT_ONCE // len(i))
            for k in range(0, len(of), step):
                base = of[k : k + step, None]
                yield (base + i).ravel(), (base + j).ravel()
        else:
            step = max(1, PAIRS_AT_ONCE // int(size))
            for start in of:
                for k in range(0, size, step):
                    i = np.arange(k, min(k + step, size))
                    left, right = np.meshgrid(i, np.arange(size), indexing="ij")
                    ahead = right > left
                    yield start + left[ahead], start + right[ahead]


def link_runs(fps: np.ndarray, starts: np.ndarray, sizes: np.ndarray, most: int = MOST_BITS) -> np.ndarray:
    """For every row the first row of those it is linked with, directly or not, within runs."""
    labels = np.arange(len(fps))
    table = np.stack([np.bitwise_count(fps ^ p) for p in PIVOTS], axis=1).astype(np.int8)
    for a, b in _pairs(starts, sizes):
        for pivots in (slice(0, FIRST_PIVOTS), slice(FIRST_PIVOTS, None)):
            near = np.abs(table[a, pivots] - table[b, pivots]).max(axis=1) <= most
            a, b = a[near], b[near]
        near = np.bitwise_count(fps[a] ^ fps[b]) <= most
        labels = hook(labels, a[near], b[near])
    return labels


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key to links: of each set of linked rows, every row with the first one."""

    def linked(keys: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
        new = np.ones(len(keys), dtype=bool)
        new[1:] = (keys[1:] != keys[:-1]).any(axis=1)
        starts = np.flatnonzero(new)
        labels = link_runs(fps.view(np.uint64), starts, np.diff(np.append(starts, len(keys))))
        other = np.flatnonzero(labels != np.arange(len(labels)))
        return pa.record_batch([pa.array(fps[other]), pa.array(fps[labels[other]])], names=["a", "b"])

    kept_keys, kept = np.empty((0, 4), dtype=np.int64), np.empty(0, dtype=np.int64)
    for batch in batches:
        keys = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4)], axis=1)
        keys = np.concatenate([kept_keys, keys])
        fps = np.concatenate([kept, batch.column(4).to_numpy(zero_copy_only=False)])
        if not len(fps):
            continue
        # The last key may go on in the next batch.
        last = len(fps) - int(np.argmin(np.append((keys[::-1] == keys[-1]).all(axis=1), False)))
        kept_keys, kept = keys[last:], fps[last:]
        if last:
            yield linked(keys[:last], fps[:last])
    if len(kept):
        yield linked(kept_keys, kept)


def similar_fingerprints(distinct: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Links ``a, b`` that connect exactly the fingerprints (``fp``) within 4 bits of each other.

    Fingerprints that share a key are cut into chunks of a bounded size, and every two chunks
    meet in a task of their own, so a key with a third of all fingerprints is spread. Per
    chunk pair no more links leave than it has fingerprints.
    """
    keys = F.array(
        *(F.struct(F.lit(n).alias("pair"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for n, m in enumerate(range_masks()))
    )
    keyed = distinct.select("fp", F.inline(keys))
    shared = keyed.groupBy("pair", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = materialize(shared.select("pair", "key", F.ceil(F.col("n") / chunk).alias("chunks")))
    own = F.pmod(F.xxhash64("fp"), F.col("chunks"))
    dealt = keyed.join(shared, ["pair", "key"]).select("pair", "key", "fp", "chunks", own.alias("own"))
    met = dealt.select(
        "pair", "key", "fp", "own", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("other")
    ).select("pair", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp")
    place = ["pair", "key", "i", "j"]
    return met.repartition(*place).sortWithinPartitions(*place).mapInArrow(tidy(_links), "a long, b long")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row of ``docs``.

    Texts count in lower case (A-Z), split into words at spaces and control characters 9 to
    13; a null text is empty, and texts without words share fingerprint 0. ``component_id``
    is the smallest id among all rows reachable over links; rows without an id get one as
    well but never lend theirs. Exact copies share one fingerprint and cost one row from
    there on. Repeated rows are all returned. Very long texts count whole, a task holding one
    text at a time; an empty table gives no rows. Other columns are not looked at.
    """
    rows = materialize(fingerprints(docs, id_column, text_column))
    distinct = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    roots = connected_components(similar_fingerprints(distinct))
    placed = materialize(
        distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
            "fp", "first_id", F.coalesce("root", "fp").alias("root")
        )
    )
    smallest = materialize(placed.groupBy("root").agg(F.min("first_id").alias("component_id")))
    named = materialize(placed.join(smallest, "root").select("fp", "component_id"))
    return rows.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def chosen_keys(docs: DataFrame, key: Column, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``key`` of one row of every group of near duplicates: the one with the smallest id, then key.

    ``key`` tells rows apart that shall be; rows without an id belong to groups as others do and
    are chosen where no row of their group has one.
    """
    rows = materialize(fingerprints(docs, id_column, text_column, key))
    distinct = materialize(rows.select("fp").distinct())
    roots = connected_components(similar_fingerprints(distinct))
    placed = materialize(
        distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"))
    )
    first = F.min(F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "key")).alias("first")
    return rows.join(placed, "fp").groupBy("root").agg(first).select(F.col("first.key").alias("key"))
