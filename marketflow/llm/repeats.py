"""Removal of repeated passages: suffix arrays over the text around repeated anchors.

A byte goes if a string of 100 bytes covers it that also starts earlier (smaller id, or
earlier in the same document). Matches never cross documents.

1. Every string of 100 bytes has an anchor: of the 32-byte strings in it the one of smallest
   hash, the first of equals. Equal strings have equal anchors, so strings whose anchor comes
   once in the corpus cannot repeat. Anchors are counted over all documents by hash bucket.
2. Text around repeated anchors (a fragment: all strings of one anchor, some 130 bytes) is
   sent to the bucket of its anchor. Equal fragments are collapsed before and after the
   shuffle, so a passage that a third of all documents hold costs one fragment per block.
3. Where fragments of one anchor differ, strings whose hash comes once are cut off, and what
   is alike then is collapsed again (the edges of a shared passage are alike in all documents
   that hold it, once what differs around them is gone). The suffixes of what is left are
   sorted by external induced sorting (``suffix.py``): strings that share 100 bytes lie next
   to each other, and all but the earliest of them are marked.
4. An anchor that comes more often than a slice holds fragments is split, so that no task takes
   all of its text: its strings are counted by their own hash, those that come once are cut off
   before anything is sent, and the others go one by one to the bucket of their own hash, where
   equal strings still meet.
5. Marks meet their document by id and are merged and cut out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketflow.llm.arrays import found, rows_by_bucket, runs, shared_folder, stored
from marketflow.llm.common import tidy
from marketflow.llm.suffix import MEMORY_ROWS, induced
from marketflow.sources.work import new_work_dir

LENGTH = 100
ANCHOR = 32
#: Text that is hashed at a time; places within it take as many low bits of a hash.
PIECE = 1 << 18
PLACE = np.uint64(PIECE - 1)
BLOCK_BYTES = 12 << 20
SLICE_BYTES = 4 << 20
BUCKETS_PER_PARTITION = 4
BASE = np.uint64(0x9E3779B97F4A7C15)
#: Odd multipliers of the rolling hash, one per doubling of its length.
MULTIPLIERS = (
    0xD6E8FEB86659FD93, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F,
)

SPANS_DDL = "key long, text_hash long, _spans array<struct<start: long, stop: long>>"
PACKED = pa.schema([("bucket", pa.int64()), ("data", pa.list_(pa.binary()))])
PACKED_DDL = "bucket long, data array<binary>"


def string_hashes(buffer: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all strings of so many bytes: doubled while they fit, then two that overlap."""
    hashes, size, step = (buffer.astype(np.uint64) + np.uint64(1)) * BASE, 1, 0
    while size < length:
        by = min(size, length - size)
        hashes = hashes[:-by] * np.uint64(MULTIPLIERS[step % len(MULTIPLIERS)]) + hashes[by:]
        hashes ^= hashes >> np.uint64(31)
        size += by
        step += 1
    return hashes


def sliding_minima(values: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def fragments_of(texts: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """Of all fragments: text number, place of the first string, number of strings, anchor's hash."""
    out: list[list[np.ndarray]] = []
    held, segments, total = [], [], 0

    def search() -> None:
        buffer = np.frombuffer(b"".join(held), dtype=np.uint8)
        inside = np.zeros(len(buffer) + 1, dtype=np.int8)
        at, number, begin, size = (np.array(c, dtype=np.int64) for c in zip(*segments))
        inside[at] += 1
        inside[at + size - length + 1] -= 1
        hashes = string_hashes(buffer, ANCHOR)
        ranked = (hashes & ~PLACE) | np.arange(len(hashes), dtype=np.uint64)
        anchor = (sliding_minima(ranked, length - ANCHOR + 1) & PLACE).astype(np.int64)
        places = np.flatnonzero(np.cumsum(inside[:-1], dtype=np.int8)[: len(anchor)])
        anchor = anchor[places]
        new = np.append(True, (anchor[1:] != anchor[:-1]) | (places[1:] != places[:-1] + 1))
        first = np.flatnonzero(new)
        counts = np.diff(np.append(first, len(places)))
        of = np.searchsorted(at, places[first], side="right") - 1
        out.append([number[of], begin[of] + places[first] - at[of], counts, hashes[anchor[first]]])

    for number, text in enumerate(texts):
        for begin in range(0, max(1, len(text) - length + 1), PIECE // 2):
            part = text[begin : begin + PIECE // 2 + length - 1]
            if len(part) < length:
                continue
            if held and total + len(part) > PIECE:
                search()
                held, segments, total = [], [], 0
            segments.append((total, number, begin, len(part)))
            held.append(part)
            total += len(part)
    if held:
        search()
    if not out:
        return [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)]
    return [np.concatenate(c) for c in zip(*out)]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes]]]:
    """Rows ``key, text_hash, text`` in blocks of a bounded size."""
    keys, hashes, texts, total = [], [], [], 0
    for batch in batches:
        columns = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary())
        for key, text_hash, text in zip(*columns):
            keys.append(key)
            hashes.append(text_hash)
            texts.append(text.as_py())
            total += len(texts[-1])
            if total >= BLOCK_BYTES:
                yield np.array(keys), np.array(hashes), texts
                keys, hashes, texts, total = [], [], [], 0
    if texts:
        yield np.array(keys), np.array(hashes), texts


def _packed(bucket: int, *data: bytes | np.ndarray) -> pa.RecordBatch:
    raw = [d if isinstance(d, bytes) else np.ascontiguousarray(d).tobytes() for d in data]
    return pa.record_batch([pa.array([bucket]), pa.array([raw], pa.list_(pa.binary()))], schema=PACKED)


def _buckets(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Even buckets: anchors have small hashes, so those are mixed once more."""
    return ((hashes ^ (hashes >> np.uint64(32))) * BASE >> np.uint64(64 - bits)).astype(np.int64)


def _anchors(bits: int, length: int):
    """Distinct anchors of each block by bucket: those that come once, and those that repeat."""

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, texts in _blocks(batches):
            yield from _counted(*np.unique(fragments_of(texts, length)[3], return_counts=True), bits)

    return tidy(anchors)


def _counted(hashes: np.ndarray, counts: np.ndarray, bits: int) -> Iterator[pa.RecordBatch]:
    """Distinct hashes by bucket: those that come once, those that repeat, and how often these do."""
    buckets = _buckets(hashes, bits)
    order = np.argsort(buckets, kind="stable")
    for a, b in runs(buckets[order]):
        here, times = hashes[order[a:b]], counts[order[a:b]]
        more = times > 1
        yield _packed(int(buckets[order[a]]), here[~more], here[more], times[more].astype(np.uint32))


def _repeated(folder: str, kind: str, most: int | None = None):
    """Write each bucket's hashes that come more than once, and those that come more than ``most`` times."""

    def repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in rows_by_bucket(batches):
            once, more = (np.concatenate([np.frombuffer(r[n], dtype=np.uint64) for r in rows]) for n in (0, 1))
            times = np.concatenate([np.frombuffer(r[2], dtype=np.uint32) for r in rows])
            hashes, of = np.unique(np.concatenate([once, more]), return_inverse=True)
            # Sums in doubles are exact here.
            counts = np.bincount(of, weights=np.append(np.ones(len(once)), times), minlength=len(hashes))
            stored(folder, f"{kind}-{bucket}", hashes[counts > 1])
            hot = hashes[counts > most] if most else hashes[:0]
            if len(hot):
                stored(folder, f"hot-{bucket}", hot)
            yield pa.record_batch([pa.array([len(hot)])], names=["n"])

    return tidy(repeated)


def _known(folder: str, kind: str, hashes: np.ndarray, bits: int) -> np.ndarray:
    """Which hashes are among those stored."""
    known = np.zeros(len(hashes), dtype=bool)
    for hit, _, _ in found(folder, kind, _buckets(hashes, bits), hashes):
        known[hit] = True
    return known


def _strings_of(words: list[bytes], length: int) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Strings of fragments, so many bytes at a time: joined text, fragment, place within it and in the text, hash."""
    first = 0
    while first < len(words):
        last, total = first, 0
        while last < len(words) and total < PIECE:
            total += len(words[last])
            last += 1
        raw = b"".join(words[first:last])
        sizes = np.fromiter(map(len, words[first:last]), dtype=np.int64, count=last - first)
        of = np.repeat(np.arange(last - first), sizes - length + 1)
        at = np.arange(len(of)) + (length - 1) * of
        within = at - (np.cumsum(sizes) - sizes)[of]
        yield raw, first + of, within, at, string_hashes(np.frombuffer(raw, dtype=np.uint8), length)[at]
        first = last


def _strings(folder: str, bits: int, length: int):
    """Distinct strings of each block's fragments of hot anchors, by bucket of their own hash."""

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, texts in _blocks(batches):
            number, place, count, hashes = fragments_of(texts, length)
            hot = _known(folder, "hot", hashes, bits)
            cut = zip(number[hot].tolist(), place[hot].tolist(), (place + count + length - 1)[hot].tolist())
            words = list({texts[n][a:b] for n, a, b in cut})
            if words:
                found_hashes = np.concatenate([h for *_, h in _strings_of(words, length)])
                yield from _counted(*np.unique(found_hashes, return_counts=True), bits)

    return tidy(strings)


def _spans(key: np.ndarray, text_hash: np.ndarray, start: np.ndarray, stop: np.ndarray) -> list[np.ndarray]:
    """Spans in order, with those that touch or overlap made one."""
    order = np.lexsort((start, text_hash, key))
    key, text_hash, start, stop = key[order], text_hash[order], start[order], stop[order]
    if not len(key):
        return [key, text_hash, start, stop]
    doc = np.append(True, (key[1:] != key[:-1]) | (text_hash[1:] != text_hash[:-1]))
    # Furthest end so far within the document: documents are moved apart, so one running maximum does.
    apart = (np.cumsum(doc) - 1) * (int(stop.max()) + 1)
    furthest = np.maximum.accumulate(stop + apart)
    new = doc.copy()
    new[1:] |= start[1:] + apart[1:] > furthest[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(key)) - 1
    return [key[first], text_hash[first], start[first], furthest[last] - apart[last]]


def _leaders(ids: np.ndarray, key: np.ndarray, text_hash: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each set of equals the earliest, and all that come truly later."""
    order = np.lexsort((place, text_hash, key, ids))
    ids, key, text_hash, place = ids[order], key[order], text_hash[order], place[order]
    new = np.append(True, ids[1:] != ids[:-1])
    first = np.maximum.accumulate(np.where(new, np.arange(len(ids)), 0))
    later = (key != key[first]) | (text_hash != text_hash[first]) | (place != place[first])
    return order[new], order[later]


def _passed(
    hashes: np.ndarray, keys: np.ndarray, text_hashes: np.ndarray, places: np.ndarray, sizes: np.ndarray, bits: int
) -> Iterator[pa.RecordBatch]:
    """Spans in a bucket of their own below zero: they only pass through what fragments go to."""
    spans = _spans(keys, text_hashes, places, places + sizes)
    if len(spans[0]):
        yield _packed(-1 - int(_buckets(hashes[:1], bits)[0]), *spans)


def _sent(
    words: list[bytes], hashes: np.ndarray, keys: np.ndarray, text_hashes: np.ndarray, places: np.ndarray,
    counts: np.ndarray, bits: int,
) -> Iterator[pa.RecordBatch]:
    """Fragments packed by bucket of the hashes that they meet by."""
    buckets = _buckets(hashes, bits)
    order = np.lexsort((hashes, buckets))
    for a, b in runs(buckets[order]):
        here = order[a:b]
        text = zstandard.compress(b"".join([words[i] for i in here.tolist()]), 3)
        yield _packed(
            int(buckets[here[0]]),
            hashes[here], keys[here], text_hashes[here], places[here], counts[here].astype(np.uint16), text,
        )


def _fragments(folder: str, bits: int, length: int):
    """Fragments of repeated anchors to their buckets, each once per block; later copies as spans.

    Of hot anchors single strings go, of those that come again, each once per piece of a block.
    """

    def fragments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, text_hashes, texts in _blocks(batches):
            number, place, count, hashes = fragments_of(texts, length)
            known = _known(folder, "anchors", hashes, bits)
            number, place, count, hashes = (x[known] for x in (number, place, count, hashes))
            if not len(number):
                continue
            contents: dict[bytes, int] = {}
            cut = zip(number.tolist(), place.tolist(), (place + count + length - 1).tolist())
            ids = np.array([contents.setdefault(texts[n][a:b], len(contents)) for n, a, b in cut])
            leaders, later = _leaders(ids, keys[number], text_hashes[number], place)
            coordinates = keys[number], text_hashes[number], place
            yield from _passed(hashes, *(c[later] for c in coordinates), count[later] + length - 1, bits)
            words = list(contents)
            del contents
            hot = _known(folder, "hot", hashes[leaders], bits)
            alone = leaders[~hot]
            yield from _sent([words[i] for i in ids[alone].tolist()], hashes[alone], *(c[alone] for c in coordinates), count[alone], bits)
            split = leaders[hot]
            split = split[np.argsort(hashes[split], kind="stable")]
            for raw, of, within, at, own in _strings_of([words[i] for i in ids[split].tolist()], length):
                again = _known(folder, "strings", own, bits)
                of, at, own, starts = split[of[again]], at[again], own[again], within[again] + place[split[of[again]]]
                contents = {}
                same = np.array([contents.setdefault(raw[a : a + length], len(contents)) for a in at.tolist()], dtype=np.int64)
                coordinates = keys[number[of]], text_hashes[number[of]], starts
                first, later = _leaders(same, *coordinates)
                yield from _passed(own, *(c[later] for c in coordinates), np.full(len(later), length), bits)
                strings = list(contents)
                one = np.ones(len(first), dtype=np.int64)
                yield from _sent([strings[i] for i in same[first].tolist()], own[first], *(c[first] for c in coordinates), one, bits)

    return tidy(fragments)


def marked_places(
    text: np.ndarray, is_start: np.ndarray, coordinates: Callable, length: int, rows: int, folder: str | None = None
) -> np.ndarray:
    """Places among ``is_start`` where a string of ``length`` symbols starts that starts earlier too.

    ``coordinates`` gives key, text hash and start of places; their order says what is earlier.
    """
    out = [np.empty(0, dtype=np.int64)]
    open_places = np.empty(0, dtype=np.int64)

    def close(groups: np.ndarray, places: np.ndarray) -> None:
        sizes = np.bincount(groups)
        several = sizes[groups] > 1
        if several.any():
            some = places[several]
            out.append(some[_leaders(groups[several], *coordinates(some))[1]])

    for places, prefixes in induced(text, length, rows, folder):
        groups = np.cumsum(prefixes < length)
        starts = is_start[places]
        # Group 0 goes on from the chunk before; the last group may go on in the next one.
        groups = np.concatenate([np.zeros(len(open_places), dtype=np.int64), groups[starts]])
        places = np.concatenate([open_places, places[starts]])
        last = int((prefixes < length).sum())
        close(groups[groups < last], places[groups < last])
        open_places = places[groups == last]
    close(np.zeros(len(open_places), dtype=np.int64), open_places)
    return np.concatenate(out)


def _shared(
    texts: list[bytes], counts: np.ndarray, keys: np.ndarray, text_hashes: np.ndarray, places: np.ndarray,
    length: int, rows: int,
) -> list[list[np.ndarray]]:
    """Spans of the strings that differing fragments share, but for the earliest of each."""
    # Byte 255, which is in no UTF-8 text, parts the fragments.
    raw = b"\xff".join(texts) + b"\xff"
    ends = np.cumsum(np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)) + 1)
    begins = np.append(0, ends[:-1])
    starts = np.zeros(len(raw) + 1, dtype=np.int8)
    starts[begins] += 1
    starts[begins + counts] -= 1
    starts = np.flatnonzero(np.cumsum(starts[:-1], dtype=np.int8))
    hashes = string_hashes(np.frombuffer(raw, dtype=np.uint8), length)[starts]
    order = np.argsort(hashes)
    ranked = hashes[order]
    twin = np.zeros(len(order) + 1, dtype=bool)
    twin[1:-1] = ranked[1:] == ranked[:-1]
    starts = np.sort(starts[order[twin[1:] | twin[:-1]]])
    if not len(starts):
        return []
    first = np.flatnonzero(np.append(True, starts[1:] != starts[:-1] + 1))
    counts = np.diff(np.append(first, len(starts)))
    at = starts[first]
    of = np.searchsorted(begins, at, side="right") - 1
    keys, text_hashes, places = keys[of], text_hashes[of], places[of] + at - begins[of]
    contents: dict[bytes, int] = {}
    cut = zip(at.tolist(), (at + counts + length - 1).tolist())
    ids = np.array([contents.setdefault(raw[a:b], len(contents)) for a, b in cut])
    leaders, later = _leaders(ids, keys, text_hashes, places)
    spans = [[keys[later], text_hashes[later], places[later], places[later] + counts[later] + length - 1]]
    words = list(contents)
    raw = np.frombuffer(b"\xff".join([words[i] for i in ids[leaders].tolist()]) + b"\xff", dtype=np.uint8)
    keys, text_hashes, places, counts = (x[leaders] for x in (keys, text_hashes, places, counts))
    begins = np.cumsum(counts + length) - counts - length
    # Dense symbols from 2; 1 parts what is sorted.
    symbols = np.zeros(256, dtype=np.uint8)
    present = np.flatnonzero(np.bincount(raw, minlength=256)[:255])
    symbols[present] = np.arange(2, len(present) + 2)
    symbols[255] = 1
    is_start = np.zeros(len(raw) + 1, dtype=np.int8)
    is_start[begins] += 1
    is_start[begins + counts] -= 1

    def coordinates(p: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        of = np.searchsorted(begins, p, side="right") - 1
        return keys[of], text_hashes[of], places[of] + p - begins[of]

    marked = marked_places(symbols[raw], np.cumsum(is_start[:-1], dtype=np.int8) > 0, coordinates, length, rows)
    key, text_hash, start = coordinates(marked)
    return [*spans, [key, text_hash, start, start + length]]


def _removed(bits: int, length: int, slice_bytes: int, rows: int):
    """Buckets of fragments to spans: later copies, and strings that suffix sorting finds again."""

    def slices(hashes: np.ndarray, sizes: np.ndarray) -> Iterator[np.ndarray]:
        """Fragments of anchors that have several, whole anchors together, so many bytes at a time."""
        order = np.argsort(hashes, kind="stable")
        held, total = [], 0
        for a, b in runs(hashes[order]):
            if b - a > 1:
                held.append(order[a:b])
                total += int(sizes[order[a:b]].sum())
                if total >= slice_bytes:
                    yield np.concatenate(held)
                    held, total = [], 0
        if held:
            yield np.concatenate(held)

    def removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, packed in rows_by_bucket(batches):
            if bucket < 0:
                for data in packed:
                    yield from _by_document([np.frombuffer(d, dtype=np.int64) for d in data], bits)
                continue
            types = (np.uint64, np.int64, np.int64, np.int64, np.uint16)
            columns = [np.concatenate(c) for c in zip(*([np.frombuffer(d, t) for d, t in zip(r, types)] for r in packed))]
            hashes, keys, text_hashes, places, counts = columns
            counts = counts.astype(np.int64)
            sizes = counts + length - 1
            contents: dict[bytes, int] = {}
            ids, at = [], 0
            for data in packed:
                text, place = zstandard.decompress(data[5]), 0
                for size in sizes[at : at + len(data[4]) // 2].tolist():
                    ids.append(contents.setdefault(text[place : place + size], len(contents)))
                    place += size
                at += len(data[4]) // 2
            words, ids = list(contents), np.array(ids)
            leaders, later = _leaders(ids, keys, text_hashes, places)
            found_spans = [[keys[later], text_hashes[later], places[later], places[later] + sizes[later]]]
            for some in slices(hashes[leaders], sizes[leaders]):
                chosen = leaders[some]
                texts = [words[i] for i in ids[chosen].tolist()]
                found_spans += _shared(texts, counts[chosen], keys[chosen], text_hashes[chosen], places[chosen], length, rows)
            yield from _by_document(_spans(*(np.concatenate(c) for c in zip(*found_spans))), bits)

    return tidy(removed)


def _by_document(spans: list[np.ndarray], bits: int) -> Iterator[pa.RecordBatch]:
    """Spans packed by buckets of documents."""
    mixed = (spans[0].view(np.uint64) * BASE ^ spans[1].view(np.uint64)) * BASE
    buckets = _buckets(mixed, bits)
    order = np.argsort(buckets, kind="stable")
    for a, b in runs(buckets[order]):
        yield _packed(int(buckets[order[a]]), *(s[order[a:b]] for s in spans))


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for every document of a bucket: its spans, merged and in order."""
    for _, packed in rows_by_bucket(batches):
        key, text_hash, start, stop = _spans(*(np.concatenate([np.frombuffer(d[n], np.int64) for d in packed]) for n in range(4)))
        new = np.append(True, (key[1:] != key[:-1]) | (text_hash[1:] != text_hash[:-1]))
        first = np.flatnonzero(new)
        offsets = pa.array(np.append(first, len(key)).astype(np.int32))
        pairs = pa.StructArray.from_arrays([pa.array(start), pa.array(stop)], names=["start", "stop"])
        lists = pa.ListArray.from_arrays(offsets, pairs)
        yield pa.RecordBatch.from_arrays(
            [pa.array(key[first]), pa.array(text_hash[first]), lists], names=["key", "text_hash", "_spans"]
        )


def _in_buckets(packed: DataFrame, bits: int) -> DataFrame:
    # A number of its own, as tasks of a few packed rows still have much to do.
    return packed.repartition(1 << bits, "bucket").sortWithinPartitions("bucket")


def sent_fragments(rows: DataFrame, folder: str, bits: int, length: int, slice_bytes: int) -> DataFrame:
    """Packed fragments of what may repeat; of no hash more than fill a slice, but for equal strings."""
    anchors = _in_buckets(rows.mapInArrow(_anchors(bits, length), PACKED_DDL), bits)
    most = max(2, slice_bytes // (2 * length - ANCHOR))
    if anchors.mapInArrow(_repeated(folder, "anchors", most), "n long").agg(F.sum("n")).first()[0]:
        strings = _in_buckets(rows.mapInArrow(_strings(folder, bits, length), PACKED_DDL), bits)
        strings.mapInArrow(_repeated(folder, "strings"), "n long").agg(F.sum("n")).first()
    return rows.mapInArrow(_fragments(folder, bits, length), PACKED_DDL)


def repeated_spans(
    rows: DataFrame, length: int = LENGTH, slice_bytes: int = SLICE_BYTES, memory_rows: int = MEMORY_ROWS,
    work_dir: str | None = None,
) -> DataFrame:
    """Per document ``key, text_hash`` the ``_spans`` of bytes to remove from rows ``key, text_hash, text``."""
    if length < ANCHOR:
        raise ValueError(f"strings must have {ANCHOR} bytes at least")
    folder = shared_folder(work_dir or new_work_dir(rows.sparkSession))
    bits = max(1, (BUCKETS_PER_PARTITION * rows.rdd.getNumPartitions() - 1).bit_length())

    def in_buckets(packed: DataFrame) -> DataFrame:
        return _in_buckets(packed, bits)

    sent = in_buckets(sent_fragments(rows, folder, bits, length, slice_bytes))
    spans = in_buckets(sent.mapInArrow(_removed(bits, length, slice_bytes, memory_rows), PACKED_DDL))
    return spans.mapInArrow(tidy(_gathered), SPANS_DDL)


def with_spans(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with ``_spans``: array of ``start, stop`` to remove, by start; null where there is none."""
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(key.alias("key"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    spans = repeated_spans(rows, **options)
    # In a struct, columns of the same names as those joined by stay apart from them.
    held = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), key.alias("_key"), F.xxhash64(text).alias("_hash"))
    same = (held["_key"] == spans["key"]) & (held["_hash"] == spans["text_hash"])
    return held.join(spans, same, "left").select("_row.*", "_spans")


def runs_of(spans: list[dict] | None) -> list[tuple[int, int]]:
    return [(span["start"], span["stop"]) for span in spans or ()]


def kept(text: bytes, removed: list[tuple[int, int]]) -> bytes:
    if not removed:
        return text
    edges = [0, *(e for run in removed for e in run), len(text)]
    return b"".join([text[a:b] for a, b in zip(edges[::2], edges[1::2])])


DIGESTS = pa.schema(
    [("doc_id", pa.int64()), *((n, pa.int64()) for n in ("n_bytes", "n_removed", "n_spans")), ("kept_sha256", pa.string())]
)


def removal_digests(docs: DataFrame, **options) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every row of ``docs``.

    A null text is empty. A null id counts as smaller than any. Rows that share an id are told
    apart by their text, in the order of its hash; rows alike in both are one document, so
    they remove nothing from each other and all lose what the document loses. Very long texts
    count whole, matches in themselves included. An empty table gives no rows; other columns are not looked at.
    """

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, text, spans in zip(
                batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), batch.column(2)
            ):
                raw, removed = text.as_py() or b"", runs_of(spans.as_py())
                rest = kept(raw, removed)
                rows.append((doc, len(raw), len(raw) - len(rest), len(removed), hashlib.sha256(rest).hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), DIGESTS)] if rows else
                                             [pa.array([], f.type) for f in DIGESTS], schema=DIGESTS)

    rows = with_spans(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), **options)
    return rows.mapInArrow(tidy(digests), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def without_repeats(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with what repeats cut out of ``text``; a letter cut apart goes as a whole.

    Rows stay, if with an empty text; a null text stays null; texts of any length and repeated
    rows are treated as by ``removal_digests``. Other columns are handed on, whatever their names.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.schema.get_field_index("text")
            texts = batch.column(place).cast(pa.binary())
            out = [
                None if t.as_py() is None else kept(t.as_py(), runs_of(s.as_py())).decode("utf-8", "ignore")
                for t, s in zip(texts, batch.column(batch.num_columns - 1))
            ]
            columns = [*batch.columns[:-1]]
            columns[place] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])

    rows = with_spans(docs, **options)
    return rows.mapInArrow(tidy(cut), docs.schema)
