"""Interpolated modified Kneser-Ney language model of word n-grams, of any order.

Spark counts words first and numbers them, frequent ones low, so that an n-gram is a few small
whole numbers. Tasks add up blocks of text with numpy and send sorted arrays by hash bucket, byte
by byte and compressed, so a shuffle row carries many n-grams in few bytes. Every n-gram goes by a
hash of itself, so however frequent a word or context is, no bucket is hot. From the longest
n-grams down, each bucket is merged and written as sorted arrays to a folder all executors share,
and tells the next shorter ones what it says of them. Scoring tasks memory-map the arrays and look
up what their block of text holds; no task loads the model, and all counts cover the whole corpus.

In the arrays an n-gram is a 64-bit hash: its leading bits say the bucket and a slot of a few
n-grams, the next 40 are stored. Those whose numbers are the bucket's commonest are stored without
numbers, others with the row they have in a table of the bucket's distinct ones.

The probability of word w after context h is ``(a(hw) - D) / t(h) + g(h) * p(w | h')``, where h'
is h without its first word. a is how often hw comes if it has the model's order, else in how many
distinct n-grams it is all but the first word; t(h) is the sum of a over all words after h; D is
one of three discounts by a, and g(h) the mass that they free. Single words are mixed with a
uniform share for unknown words. Every text begins after ``order - 1`` start marks.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketflow.llm.arrays import found, rows_by_bucket, runs, shared_folder, stored
from marketflow.llm.common import id_remainder, tidy
from marketflow.sources.work import new_work_dir

#: Longest n-grams that are counted.
ORDER = 3
TOKENS_PER_BLOCK = 2_000_000
#: Distinct n-grams whose neighbours a merging task adds up before it passes them on.
GRAMS_AT_ONCE = 2_000_000
#: Buckets by size of the texts, and how many a task merges, one after the other.
TEXT_BYTES_PER_BUCKET = 16 << 20
BUCKETS_PER_TASK = 2
#: What a text ends with: the hash of a string that is no word.
END = np.uint64(xxhash.xxh64_intdigest(b"\n"))
#: Numbers of the mark that a text begins after, and of words that are not in the model.
BEGIN, UNKNOWN = 0, 0xFFFFFFFF
HELD_OUT = 1

#: Rows of a bucket: the kind of what follows, bytes a value of each array, and the arrays' bytes, compressed place by place.
PACKED = pa.schema([("bucket", pa.int64()), ("data", pa.list_(pa.binary()))])
PACKED_DDL = "bucket long, data array<binary>"
#: Hashes of words, or numbers of n-grams, and counts.
WORDS, GRAMS = b"words", b"grams"
#: What longer n-grams say of shorter ones: in how many they end, and what follows on them.
FOLLOWS, LEADS = b"follows", b"leads"
TOTALS = b"totals"
#: N-grams to a slot of a stored bucket, as a power of two, and bits stored of each.
SLOT_BITS = 4
STORED_BITS = 40


def pair_keys(contexts: np.ndarray, words: np.ndarray) -> np.ndarray:
    """One hash for each pair of hashes or numbers; 0 for two start marks."""
    x = contexts * np.uint64(0x9E3779B97F4A7C15) + (words ^ (words >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    return x * np.uint64(0xBF58476D1CE4E5B9)


def gram_keys(grams: list[np.ndarray]) -> np.ndarray:
    """Hashes of n-grams given by their words' numbers, place by place; of single words the numbers."""
    keys = grams[0].astype(np.uint64)
    for numbers in grams[1:]:
        keys = pair_keys(keys, numbers.astype(np.uint64))
    return keys


def buckets_of(keys: np.ndarray, bits: int) -> np.ndarray:
    return keys >> np.uint64(64 - bits)


def gram_buckets(keys: np.ndarray, level: int, bits: int) -> np.ndarray:
    """A word's number ends in its bucket."""
    return buckets_of(keys, bits) if level > 1 else keys & np.uint64((1 << bits) - 1)


@dataclass
class TokenBlock:
    """Token hashes of several texts; every text ends in an end token."""

    tokens: np.ndarray
    sizes: np.ndarray

    def shifted(self, values: np.ndarray, start) -> np.ndarray:
        """Values of the tokens before, ``start`` where a text begins."""
        out = np.empty_like(values)
        out[1:] = values[:-1]
        out[np.cumsum(self.sizes) - self.sizes] = start
        return out


def token_blocks(texts: Iterator[bytes], most: int) -> Iterator[TokenBlock]:
    """Texts in order, cut into blocks between texts once ``most`` tokens are held."""
    digest, held, sizes = xxhash.xxh64_intdigest, [], []
    total = 0

    def out() -> TokenBlock:
        return TokenBlock(np.concatenate(held), np.array(sizes))

    for text in texts:
        words = text.lower().split()
        found = np.empty(len(words) + 1, dtype=np.uint64)
        found[:-1] = np.fromiter(map(digest, words), dtype=np.uint64, count=len(words))
        found[-1] = END
        held.append(found)
        sizes.append(len(found))
        total += len(found)
        if total >= most:
            yield out()
            held, sizes, total = [], [], 0
    if held:
        yield out()


def _narrow(counts: np.ndarray) -> np.ndarray:
    return counts.astype(np.min_scalar_type(int(counts.max()))) if counts.size else counts


def _row(bucket: int, kind: bytes, ranked: np.ndarray, *arrays: np.ndarray) -> pa.RecordBatch:
    """A row of equally long arrays of whole numbers, the first in order."""
    steps = np.append(ranked[:1], ranked[1:] - ranked[:-1])
    narrow = [_narrow(x) for x in (steps, *arrays)]
    data = [kind, bytes(x.itemsize for x in narrow)]
    for x in narrow:
        places = np.ascontiguousarray(x.view(np.uint8).reshape(-1, x.itemsize).T)
        data += [zstandard.compress(place.tobytes(), 1) for place in places]
    return _raw_row(bucket, data)


def _raw_row(bucket: int, data: list[bytes]) -> pa.RecordBatch:
    return pa.record_batch([pa.array([bucket]), pa.array([data], pa.list_(pa.binary()))], schema=PACKED)


def _arrays(data: list[bytes]) -> list[np.ndarray]:
    """The arrays of a row."""
    places = iter(data[2:])
    out = []
    for width in data[1]:
        held = np.stack([np.frombuffer(zstandard.decompress(next(places)), dtype=np.uint8) for _ in range(width)], axis=1)
        out.append(held.view(f"<u{width}")[:, 0])
    return [np.cumsum(out[0], dtype=np.uint64), *out[1:]]


def _count_words(bits: int, most: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in token_blocks(_texts(batches), most):
            keys, counts = np.unique(block.tokens, return_counts=True)
            buckets = buckets_of(keys, bits)
            for a, b in runs(buckets):
                yield _row(int(buckets[a]), WORDS, keys[a:b], counts[a:b])

    return tidy(count)


def _texts(batches: Iterator[pa.RecordBatch], column: int = 0) -> Iterator[bytes]:
    return (t or b"" for batch in batches for t in batch.column(column).cast(pa.binary()).to_pylist())


def _merge_words(folder: str, order: int, bits: int):
    """Number each bucket's words, frequent ones low, and write them with their counts."""

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((order + 1, 5), dtype=np.int64)
        for bucket, rows in rows_by_bucket(batches):
            keys, counts = (np.concatenate(x) for x in zip(*(_arrays(data) for data in rows)))
            place = np.argsort(keys, kind="stable")
            keys = keys[place]
            first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            keys, counts = keys[first], np.add.reduceat(counts[place].astype(np.int64), first)
            if (len(keys) + 1) << bits > UNKNOWN:
                raise OverflowError("more words than numbers of 32 bits")
            ranks = np.empty(len(keys), dtype=np.uint32)
            ranks[np.argsort(-counts, kind="stable")] = np.arange(1, len(keys) + 1)
            stored(folder, f"words-{bucket}", keys, ranks, _narrow(counts))
            totals[0, :2] += [counts.sum(), len(keys)]
            if order == 1:
                totals += _stored_words(folder, order, bucket, ranks.astype(np.int64), [counts])
        yield _raw_row(-1, [TOTALS, totals.tobytes()])

    return tidy(merged)


def _numbers(folder: str, bits: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and counts of words given by distinct hashes."""
    numbers, counts = np.full(len(keys), UNKNOWN, dtype=np.uint32), np.zeros(len(keys), dtype=np.int64)
    buckets = buckets_of(keys, bits)
    for asked, at, path in found(folder, "words", buckets, keys):
        ranks = np.load(f"{path}.1.npy", mmap_mode="r")[at]
        numbers[asked] = ranks << np.uint32(bits) | buckets[asked].astype(np.uint32)
        counts[asked] = np.load(f"{path}.2.npy", mmap_mode="r")[at]
    return numbers, counts


def _grouped(grams: list[np.ndarray], bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """An order that puts equal n-grams together, by bucket; where each distinct one begins in it; their buckets; they."""
    buckets = gram_buckets(gram_keys(grams), len(grams), bits)
    parts = [buckets, *(g.astype(np.uint64) for g in grams)]
    if len(parts) % 2:
        parts.insert(1, np.zeros_like(buckets))
    pairs = [a << np.uint64(32) | b for a, b in zip(parts[::2], parts[1::2])]
    order = np.lexsort(pairs[::-1])
    new = np.zeros(len(order), dtype=bool)
    new[:1] = True
    for pair in pairs:
        pair = pair[order]
        new[1:] |= pair[1:] != pair[:-1]
    first = np.flatnonzero(new)
    kept = order[first]
    return order, first, buckets[kept], [g[kept] for g in grams]


def _split(kind: bytes, buckets: np.ndarray, grams: list[np.ndarray], *counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows of arrays, one per bucket; buckets are in order."""
    for a, b in runs(buckets):
        yield _row(int(buckets[a]), kind, *(x[a:b] for x in (*grams, *counts)))


def _count_grams(folder: str, order: int, bits: int, most: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in token_blocks(_texts(batches), most):
            known, at = np.unique(block.tokens, return_inverse=True)
            grams = [_numbers(folder, bits, known)[0][at]]
            while len(grams) < order:
                grams.insert(0, block.shifted(grams[0], BEGIN))
            _, first, buckets, distinct = _grouped(grams, bits)
            yield from _split(GRAMS, buckets, distinct, np.diff(np.append(first, len(at))))

    return tidy(count)


def _neighbours(bits: int, held: list[tuple]) -> Iterator[pa.RecordBatch]:
    """What distinct n-grams, given as numbers and counts, say of the next shorter ones."""
    grams, counts = (np.concatenate(x, axis=-1) for x in zip(*held))
    _, first, buckets, rests = _grouped(list(grams[1:]), bits)
    yield from _split(FOLLOWS, buckets, rests, np.diff(np.append(first, len(counts))))
    order, first, buckets, contexts = _grouped(list(grams[:-1]), bits)
    counts = counts[order]
    kinds = (counts, counts == 1, counts == 2, counts > 2)
    yield from _split(LEADS, buckets, contexts, *(np.add.reduceat(k.astype(np.int64), first) for k in kinds))


#: Columns of a merged n-gram: its count (in how many longer ones it ends, if it is not of the model's order), and how often
#: and with what counts it leads.
COLUMNS = {GRAMS: slice(0, 1), FOLLOWS: slice(0, 1), LEADS: slice(1, 5)}


def _merged_bucket(level: int, width: int, rows: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Hashes of a bucket's distinct n-grams, in order, their words' numbers, and their columns."""
    grams, columns = [], []
    for data in rows:
        arrays = _arrays(data)
        grams.append(np.stack([x.astype(np.uint32) for x in arrays[:level]]))
        table = np.zeros((width, len(arrays[0])), dtype=np.int64)
        table[COLUMNS[data[0]]] = arrays[level:]
        columns.append(table)
    grams, columns = np.concatenate(grams, axis=1), np.concatenate(columns, axis=1)
    keys = gram_keys(list(grams))
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[first], grams[:, order[first]], [np.add.reduceat(c[order], first) for c in columns]


def _coded(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows of the columns, the commonest first, and which of them each row is."""
    codes, many = np.zeros(len(columns[0]), dtype=np.int64), 1
    for column in columns:
        span = int(column.max()) + 1
        if many * span >= 1 << 62:
            distinct, codes = np.unique(codes, return_inverse=True)
            many = len(distinct)
        codes, many = codes * span + column, many * span
    _, first, codes, times = np.unique(codes, return_index=True, return_inverse=True, return_counts=True)
    place = np.argsort(-times, kind="stable")
    ranks = np.empty_like(place)
    ranks[place] = np.arange(len(place))
    return np.stack([c[first[place]] for c in columns]), ranks[codes]


def _of_counts(order: int, level: int, counts: np.ndarray) -> np.ndarray:
    totals = np.zeros((order + 1, 5), dtype=np.int64)
    totals[level] = np.bincount(np.minimum(counts, 5), minlength=6)[1:]
    if level == 1:
        totals[0, 2] = counts.sum()
    return totals


def _stored_words(folder: str, order: int, bucket: int, ranks: np.ndarray, columns: list[np.ndarray]) -> np.ndarray:
    """Write a bucket's columns of single words by rank."""
    by_rank = np.zeros((len(columns), int(ranks.max()) + 1), dtype=np.int64)
    by_rank[:, ranks] = columns
    table, codes = _coded(list(by_rank))
    stored(folder, f"grams1-{bucket}", table, _narrow(codes))
    return _of_counts(order, 1, columns[0])


def _slots(keys: np.ndarray) -> list[np.ndarray]:
    """Keys in order, as where each slot begins and the bits after the slot's, four bytes and one."""
    bits = max(1, len(keys).bit_length() - SLOT_BITS)
    slots = keys >> np.uint64(64 - bits)
    starts = np.searchsorted(slots, np.arange((1 << bits) + 1, dtype=np.uint64)).astype(np.uint32)
    rest = keys << np.uint64(bits) >> np.uint64(64 - STORED_BITS)
    return [starts, (rest >> np.uint64(8)).astype(np.uint32), rest.astype(np.uint8)]


def _places(keys: np.ndarray, starts: np.ndarray, high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of the keys are stored, and where, by halving their slots."""
    if not len(high) or not len(keys):
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    bits = (len(starts) - 1).bit_length() - 1
    slots = (keys >> np.uint64(64 - bits)).astype(np.int64)
    want = keys << np.uint64(bits) >> np.uint64(64 - STORED_BITS)
    at, end = starts[slots].astype(np.int64), starts[slots + 1].astype(np.int64)
    to = end

    def held(at: np.ndarray) -> np.ndarray:
        at = np.minimum(at, len(high) - 1)
        return high[at].astype(np.uint64) << np.uint64(8) | low[at]

    for _ in range(int((end - at).max()).bit_length()):
        middle = (at + to) >> 1
        less = (held(middle) < want) & (middle < to)
        at, to = np.where(less, middle + 1, at), np.where(less, to, middle)
    hit = np.flatnonzero((at < end) & (held(at) == want))
    return hit, at[hit]


def _merge(folder: str, level: int, order: int, bits: int):
    """Write each bucket of n-grams of a length; pass on what they say of shorter ones."""

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, waiting = [], 0
        totals = np.zeros((order + 1, 5), dtype=np.int64)
        for bucket, rows in rows_by_bucket(batches):
            if bucket < 0:
                for data in rows:
                    yield _raw_row(bucket, data)
                continue
            keys, grams, columns = _merged_bucket(level, 1 if level == order else 5, rows)
            if level == 1:
                totals += _stored_words(folder, order, bucket, (keys >> np.uint64(bits)).astype(np.int64), columns)
                continue
            table, codes = _coded(columns)
            rest = keys << np.uint64(bits)
            common = codes == 0
            numbers = _narrow(codes[~common])
            stored(folder, f"grams{level}-{bucket}", table, *_slots(rest[common]), *_slots(rest[~common]), numbers)
            counts = columns[0]
            totals += _of_counts(order, level, counts)
            own = counts > 0
            held.append((grams[:, own], counts[own]))
            waiting += int(own.sum())
            if waiting >= GRAMS_AT_ONCE:
                yield from _neighbours(bits, held)
                held, waiting = [], 0
        if waiting:
            yield from _neighbours(bits, held)
        yield _raw_row(-1, [TOTALS, totals.tobytes()])

    return tidy(merged)


def discounts(of_counts: np.ndarray) -> np.ndarray:
    """What to take off counts of 0, 1, 2 and more, from how many things were counted 1, 2, 3, 4 times."""
    n = of_counts.astype(np.float64)
    out = np.array([0, 0.5, 1.0, 1.5])
    if (n[:4] > 0).all():
        y = n[0] / (n[0] + 2 * n[1])
        out[1:] = [k - (k + 1) * y * n[k] / n[k - 1] for k in (1, 2, 3)]
        out[1:] = np.clip(out[1:], 0.05, [0.95, 1.95, 2.95])
    return out


@dataclass
class Model:
    """Where the arrays lie, and the few numbers that hold for all of them."""

    folder: str
    order: int
    bits: int
    tokens: int
    words: int
    heads: int
    free_heads: float
    #: By length of n-grams.
    discounts: list[np.ndarray]

    def _looked_up(self, level: int, keys: np.ndarray) -> np.ndarray:
        """Columns of n-grams by their hashes, zeros where there are none, read from memory-mapped arrays."""
        out = np.zeros((1 if level == self.order else 5, len(keys)), dtype=np.int64)
        buckets = gram_buckets(keys, level, self.bits)
        order = np.argsort(buckets, kind="stable")
        for a, b in runs(buckets[order]):
            asked = order[a:b]
            path = f"{self.folder}/grams{level}-{buckets[asked[0]]}"
            if not os.path.exists(f"{path}.0.npy"):
                continue
            table = np.load(f"{path}.0.npy")
            parts = [np.load(f"{path}.{part}.npy", mmap_mode="r") for part in range(1, 8 if level > 1 else 2)]
            if level == 1:
                ranks = (keys[asked] >> np.uint64(self.bits)).astype(np.int64)
                has = (keys[asked] != UNKNOWN) & (ranks < len(parts[0]))
                out[:, asked[has]] = table[:, parts[0][ranks[has]]]
                continue
            rest = keys[asked] << np.uint64(self.bits)
            hit, _ = _places(rest, *parts[:3])
            out[:, asked[hit]] = table[:, :1]
            others = np.delete(np.arange(len(asked)), hit)
            hit, at = _places(rest[others], *parts[3:6])
            out[:, asked[others[hit]]] = table[:, parts[6][at]]
        return out

    def log_probabilities(self, block: TokenBlock) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of every token: log10 by the model, log10 by word counts alone, and whether it is known."""
        known, token = np.unique(block.tokens, return_inverse=True)
        numbers, words = _numbers(self.folder, self.bits, known)
        base = np.log10((words + 0.5) / (self.tokens + 0.5 * (self.words + 1)))[token]
        is_known = (words > 0)[token]
        ends = grams = numbers[token].astype(np.uint64)
        for level in range(1, self.order + 1):
            if level > 1:
                grams = pair_keys(block.shifted(grams, BEGIN), ends)
            # Start marks have the key 0, however many.
            if level > 1:
                known, at = np.unique(np.append(grams, np.uint64(BEGIN)), return_inverse=True)
            else:
                known, at = np.append(numbers, np.uint32(BEGIN)).astype(np.uint64), np.append(token, len(numbers))
            columns = self._looked_up(level, known)
            token = at[:-1]
            above = columns[0] - self.discounts[level][np.minimum(columns[0], 3)]
            if level == 1:
                likely = (above / max(1, self.heads) + self.free_heads / (self.words + 1))[token]
            else:
                likely = above[token] / totals + free * likely
            if level < self.order:
                before = block.shifted(token, at[-1])
                kinds = sum(d * c for d, c in zip(self.discounts[level + 1][1:], columns[2:]))
                sums = np.maximum(columns[1], 1)
                totals, free = sums[before], np.where(columns[1] > 0, kinds / sums, 1.0)[before]
        return np.log10(likely), base, is_known


def fit(
    texts: DataFrame, model_dir: str | None = None, order: int = ORDER, tokens_per_block: int = TOKENS_PER_BLOCK
) -> Model:
    """Count all rows of ``texts`` (one column of text) and write the model's arrays.

    ``model_dir`` is by default below the session's shared work folder. Any number of lost
    tasks may be repeated: files are replaced whole, with the same content. ``texts`` is read
    three times; write it first if it could differ between readings.
    """
    if order < 1:
        raise ValueError(f"order is {order}, but has to be 1 or more")
    spark = texts.sparkSession
    folder = shared_folder(model_dir or new_work_dir(spark))
    size = texts.agg(F.sum(F.octet_length(texts.columns[0]).cast("long"))).first()[0] or 0
    bits = max(1, (size // TEXT_BYTES_PER_BUCKET).bit_length())
    tasks = max(1, (1 << bits) // BUCKETS_PER_TASK)

    def merged(rows: DataFrame, merge) -> DataFrame:
        return rows.repartition(tasks, "bucket").sortWithinPartitions("bucket").mapInArrow(merge, PACKED_DDL)

    # A few numbers per task come back.
    told = merged(texts.mapInArrow(_count_words(bits, tokens_per_block), PACKED_DDL), _merge_words(folder, order, bits)).collect()
    if order > 1:
        rows = texts.mapInArrow(_count_grams(folder, order, bits, tokens_per_block), PACKED_DDL)
        for level in range(order, 0, -1):
            rows = merged(rows, _merge(folder, level, order, bits))
        told += rows.collect()
    totals = sum((np.frombuffer(row["data"][1], dtype=np.int64) for row in told), np.zeros(5 * (order + 1), np.int64))
    (tokens, distinct, heads, *_), *of_counts = totals.reshape(order + 1, 5).tolist()
    found_discounts = [np.zeros(4), *(discounts(np.array(c)) for c in of_counts)]
    n = of_counts[0]
    taken = (found_discounts[1][1:] * [n[0], n[1], sum(n[2:])]).sum()
    return Model(folder, order, bits, tokens, distinct, heads, taken / heads if heads else 1.0, found_discounts)


SCORES = pa.schema(
    [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())]
)


def score(docs: DataFrame, model: Model, tokens_per_block: int = TOKENS_PER_BLOCK) -> DataFrame:
    """``doc_id, n_tokens, n_known, base_score, score`` of rows with ``doc_id`` and ``text``."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for block in token_blocks(_texts(iter([batch]), 1), tokens_per_block):
                model_log, base_log, known = model.log_probabilities(block)
                starts = np.cumsum(block.sizes) - block.sizes
                numbers = [
                    block.sizes, np.add.reduceat(known.astype(np.int64), starts),
                    np.add.reduceat(base_log, starts), np.add.reduceat(model_log, starts),
                ]
                docs_here = batch.column(0).slice(at, len(block.sizes))
                at += len(block.sizes)
                yield pa.RecordBatch.from_arrays(
                    [docs_here, *(pa.array(x, f.type) for x, f in zip(numbers, list(SCORES)[1:]))], schema=SCORES
                )

    return docs.mapInArrow(tidy(scored), "doc_id long, n_tokens long, n_known long, base_score double, score double")


def language_model_scores(docs: DataFrame, model_dir: str | None = None, order: int = ORDER) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row of ``docs``.

    Learns n-grams of up to ``order`` words from rows whose crc32 of the id modulo 5 is not 1. A
    null text is empty and is one end token. Very long texts count whole; one text is held by one
    task. Repeated rows count as often as they come. An empty table gives no rows; where
    nothing is learnt from, every word is unknown. Other columns are not looked at.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    model = fit(texts.filter(id_remainder("doc_id") != HELD_OUT).select("text"), model_dir, order)
    return score(texts, model).select(
        "doc_id", (id_remainder("doc_id") == HELD_OUT).alias("held_out"), "n_tokens", "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score",
    )
