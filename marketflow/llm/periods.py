"""Periodic runs of words: recursive frequency splitting, then a scan of lags.

A run is a stretch of consecutive words with smallest period q, at least ``max(6, 4 * q)`` words
long, that no neighbouring word extends keeping the period. Every word of a run comes at least
four times in it. So a word that comes more rarely within a segment lies in no run inside that
segment and splits it; within the parts other words are too rare now, and so on until nothing
changes. Ordinary prose falls apart to nothing; what survives is scanned lag by lag.

Segments of many documents are split and scanned together in flat arrays. Lag q has a run where
``3 * q`` or more words in a row equal the word q places on. Short lags are compared word by word.
Of long ones only every q-th word is compared first: three multiples of q in a row lie in every
such stretch. So the scan of n words costs about ``n * log(n)`` comparisons, whatever the texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketflow.llm.common import tidy

LEAST_WORDS = 6
LEAST_PERIODS = 4
#: Lags that are compared word by word.
SHORT_LAGS = 16
#: Words of texts that are split and scanned together (a longer text goes alone).
WORDS_AT_ONCE = 1_000_000

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
FOUND = pa.schema([("doc_id", pa.int64()), ("runs", pa.list_(RUN)), ("collapsed", pa.string())])


def split_segments(words: np.ndarray, segments: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places, words and segments that survive; ``words`` are numbers, ``segments`` rise."""
    place = np.arange(len(words))
    while len(place):
        pairs = segments.astype(np.int64) * (int(words.max()) + 1) + words
        _, at, counts = np.unique(pairs, return_inverse=True, return_counts=True)
        often = counts[at] >= LEAST_PERIODS
        place, words, segments = place[often], words[often], segments[often]
        cut = np.append(True, (np.diff(place) != 1) | (np.diff(segments) != 0))[: len(place)]
        segments = np.cumsum(cut) - 1
        long = np.bincount(segments)[segments] >= LEAST_WORDS if len(place) else often[:0]
        if often.all() and long.all():
            break
        place, words, segments = place[long], words[long], segments[long]
    return place, words, segments


def _ends(words: np.ndarray, lag: int, at: int) -> tuple[int, int]:
    """The stretch around ``at`` in which every word equals the one ``lag`` places on."""
    end, step, limit = at, 64, len(words) - lag
    while end < limit:
        stop = min(limit, end + step)
        differ = np.flatnonzero(words[end:stop] != words[end + lag : stop + lag])
        if len(differ):
            end += int(differ[0])
            break
        end, step = stop, 2 * step
    start, step = at, 64
    while start > 0:
        stop = max(0, start - step)
        differ = np.flatnonzero(words[stop:start] != words[stop + lag : start + lag])
        if len(differ):
            start = stop + int(differ[-1]) + 1
            break
        start, step = stop, 2 * step
    return start, end


def scan_lags(words: np.ndarray, segments: np.ndarray) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of all runs within segments, as indexes of ``words``.

    ``words`` of different segments may be equal. Longer segments come first, so that a lag looks
    at those alone that are long enough for it.
    """
    if not len(words):
        return []
    sizes = np.bincount(segments)
    order = np.argsort(-sizes, kind="stable")
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    # Segment by segment with a word of its own in between, so that no stretch goes across.
    parts, origin = [], []
    for n, s in enumerate(order.tolist()):
        a = starts[s]
        parts += [words[a : a + sizes[s]], np.array([-1 - n])]
        origin += [np.arange(a, a + sizes[s] + 1)]
    flat, origin = np.concatenate(parts), np.concatenate(origin)
    ends = np.cumsum(sizes[order] + 1)
    ranked = sizes[order]
    found: set[tuple[int, int]] = set()
    out: list[tuple[int, int, int]] = []
    # First and last flat place covered by a run, by start: smaller periods come first.
    cover = np.zeros(len(flat), dtype=np.int64)

    def keep(start: int, stop: int, lag: int) -> None:
        length = stop - start + lag
        if length >= max(LEAST_WORDS, LEAST_PERIODS * lag) and (start, length) not in found:
            found.add((start, length))
            out.append((int(origin[start]), length, lag))
            cover[start : start + length] = np.maximum(cover[start : start + length], start + length)

    for lag in range(1, int(ranked[0]) // LEAST_PERIODS + 1):
        enough = np.searchsorted(-ranked, -max(LEAST_WORDS, LEAST_PERIODS * lag), "right")
        if not enough:
            break
        near = flat[: ends[enough - 1]]
        if lag <= SHORT_LAGS:
            same = np.concatenate([[0], near[:-lag] == near[lag:], [0]]).astype(np.int8)
            edges = np.diff(same)
            begin, stop = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
            long = stop - begin + lag >= max(LEAST_WORDS, LEAST_PERIODS * lag)
            for a, b in zip(begin[long].tolist(), stop[long].tolist()):
                keep(a, b, lag)
            continue
        marks = near[::lag]
        same = marks[:-1] == marks[1:]
        three = np.flatnonzero(same[:-2] & same[1:-1] & same[2:]) * lag
        three = three[cover[three] < three + 3 * lag]
        for part in (lag // 2, lag + lag // 2, lag // 3, 1):
            if len(three):
                three = three[near[three + part] == near[three + part + lag]]
        done = -1
        for at in three.tolist():
            # Inside a run of a smaller period, its multiples give that run again.
            if at < done or cover[at] >= at + 3 * lag:
                continue
            start, done = _ends(near, lag, at)
            keep(start, done, lag)
    return out


def runs_of(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """Of every text's words the runs: ``(start, length, period)``, by start, then period."""
    index: dict[bytes, int] = {}
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    numbers = np.fromiter((index.setdefault(w, len(index)) for t in texts for w in t), dtype=np.int64, count=int(sizes.sum()))
    place, words, segments = split_segments(numbers, np.repeat(np.arange(len(texts)), sizes))
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if len(place):
        first = np.cumsum(sizes) - sizes
        runs = scan_lags(words, segments)
        owner = np.searchsorted(first + sizes, [place[a] for a, _, _ in runs], "right")
        for (a, length, period), text in zip(runs, owner.tolist()):
            out[text].append((int(place[a] - first[text]), length, period))
    return [sorted(r, key=lambda r: (r[0], r[2])) for r in out]


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that lie in no run after its first period, joined by one space."""
    if not runs:
        return b" ".join(words)
    change = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    keep = np.cumsum(change[:-1]) == 0
    return b" ".join([words[i] for i in np.flatnonzero(keep).tolist()])


def periodic_runs(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, runs, collapsed`` of every row of ``docs``.

    Words are what spaces and control characters 9 to 13 separate, numbered from 0. ``runs`` are
    ``start, length, period`` by start, then period; ``collapsed`` keeps of every run its first
    period. A null or blank text has no words, no runs and an empty ``collapsed``; repeated rows
    are all returned; an empty table gives no rows; other columns, whatever their names, are not
    looked at. A text is searched whole, alone if it is long; nothing is shuffled.
    """

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, column = batch.column(0), batch.column(1).cast(pa.binary())
            first, held, size = 0, [], 0
            for n in range(batch.num_rows):
                words = (column[n].as_py() or b"").split()
                held.append(words)
                size += len(words)
                if size >= WORDS_AT_ONCE or n == batch.num_rows - 1:
                    runs = runs_of(held)
                    texts = [collapsed(w, r).decode() for w, r in zip(held, runs)]
                    listed = [[{"start": s, "length": m, "period": p} for s, m, p in r] for r in runs]
                    arrays = [ids.slice(first, len(held)), pa.array(listed, FOUND.field(1).type), pa.array(texts, pa.string())]
                    yield pa.RecordBatch.from_arrays(arrays, schema=FOUND)
                    first, held, size = n + 1, [], 0

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(
        tidy(found), "doc_id long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    )
