"""Suffix sorting by external induced sorting, with common prefixes carried along.

Suffixes that begin a rise after a fall ("stars") are named by the text up to the next star;
the string of names is sorted first, by the same method, until it fits memory. From the
sorted stars all falling suffixes are induced in ascending order and from those all rising
ones in descending order: a suffix comes out of a priority queue as a tuple of position and
common prefix with the one before, and puts the suffix that begins one symbol earlier into
the queue. The queue keeps tuples in chunks by first symbol; what exceeds its memory goes to
disk, and it is read back a chunk at a time.

Common prefixes count up to ``depth`` symbols. Suffixes that agree that far are equal here,
and their order is not determined.
"""

from __future__ import annotations

import heapq
import os
import tempfile
from collections.abc import Iterator

import numpy as np

MEMORY_ROWS = 1_000_000


class ChunkStore:
    """Chunks of columns by key, in order of arrival; on disk beyond ``rows`` rows."""

    def __init__(self, folder: str, rows: int):
        self.rows, self.held = rows, 0
        handle, self.path = tempfile.mkstemp(dir=folder)
        self.file = os.fdopen(handle, "w+b")
        self.chunks: dict[int, list] = {}

    def add(self, key: int, columns: tuple[np.ndarray, ...]) -> None:
        self.chunks.setdefault(key, []).append(columns)
        self.held += len(columns[0])
        if self.held > self.rows:
            self._spill()

    def _spill(self) -> None:
        """Write all chunks in memory, each key's merged into pieces of a bounded size."""
        piece = max(1, self.rows // 4)
        for parts in self.chunks.values():
            here = [n for n, p in enumerate(parts) if isinstance(p, tuple)]
            if not here:
                continue
            merged = [np.concatenate(c) for c in zip(*(parts[n] for n in here))]
            del parts[here[0] :]
            for a in range(0, len(merged[0]), piece):
                places = []
                for column in merged:
                    part = column[a : a + piece]
                    self.file.seek(0, os.SEEK_END)
                    places.append((self.file.tell(), len(part), part.dtype))
                    self.file.write(part.tobytes())
                parts.append(places)
        self.held = 0

    def take(self, key: int, last: bool = False) -> tuple[np.ndarray, ...] | None:
        """Remove and return a key's first rows, or its last ones: as many chunks as fit a piece."""
        parts = self.chunks.get(key)
        if not parts:
            return None
        count = self._fitting(parts[::-1] if last else parts)
        some = parts[-count:] if last else parts[:count]
        self.chunks[key] = parts[:-count] if last else parts[count:]
        taken = [self._read(part) for part in some]
        return taken[0] if len(taken) == 1 else tuple(np.concatenate(c) for c in zip(*taken))

    def _fitting(self, parts: list) -> int:
        total = 0
        for n, part in enumerate(parts):
            total += len(part[0]) if isinstance(part, tuple) else part[0][1]
            if total >= self.rows // 4:
                return n + 1
        return len(parts)

    def _read(self, part) -> tuple[np.ndarray, ...]:
        if isinstance(part, tuple):
            self.held -= len(part[0])
            return part
        columns = []
        for place, size, dtype in part:
            self.file.seek(place)
            columns.append(np.frombuffer(self.file.read(size * dtype.itemsize), dtype=dtype))
        return tuple(columns)

    def close(self) -> None:
        self.file.close()
        os.unlink(self.path)


class BucketQueue(ChunkStore):
    """A priority queue of tuples: smallest key first, within a key in order of arrival."""

    def __init__(self, folder: str, rows: int):
        super().__init__(folder, rows)
        self.keys: list[int] = []
        self.queued: set[int] = set()

    def push(self, keys: np.ndarray, *columns: np.ndarray) -> None:
        """Add tuples whose keys are in order."""
        if not len(keys):
            return
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        for a, b in zip(first.tolist(), np.append(first[1:], len(keys)).tolist()):
            key = int(keys[a])
            if key not in self.queued:
                self.queued.add(key)
                heapq.heappush(self.keys, key)
            self.add(key, tuple(c[a:b] for c in columns))

    def least(self) -> int | None:
        while self.keys:
            if self.chunks.get(self.keys[0]):
                return self.keys[0]
            self.queued.discard(heapq.heappop(self.keys))
        return None


class Carried:
    """Common prefixes of consecutive pushes to each bucket, from those of the suffixes scanned."""

    def __init__(self, symbols: int, depth: int):
        self.depth = depth
        # Of each bucket the smallest common prefix since its last push; -1 before the first.
        self.since = np.full(symbols, -1, dtype=np.int16)

    def pushed(self, keys: np.ndarray, scanned: np.ndarray, prefixes: np.ndarray) -> np.ndarray:
        """For pushes in order of key, made by the scanned rows of these numbers."""
        new = np.append(True, keys[1:] != keys[:-1])
        so_far = np.minimum.accumulate(prefixes).astype(np.int16)
        rest = np.append(np.minimum.accumulate(prefixes[::-1])[::-1][1:], self.depth).astype(np.int16)
        out = np.empty(len(keys), dtype=np.int16)
        out[new] = np.minimum(self.since[keys[new]], so_far[scanned[new]])
        later = np.flatnonzero(~new)
        out[later] = range_minima(prefixes, scanned[later - 1] + 1, scanned[later])
        alive = self.since >= 0
        self.since[alive] = np.minimum(self.since[alive], so_far[-1])
        last = np.append(new[1:], True)
        self.since[keys[last]] = rest[scanned[last]]
        return np.minimum(out + 1, self.depth).astype(np.uint8)

    def passed(self, prefixes: np.ndarray) -> None:
        """Rows were scanned that pushed nothing."""
        alive = self.since >= 0
        self.since[alive] = np.minimum(self.since[alive], prefixes.min())


def range_minima(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Minima of ``values[low : high + 1]`` by a table of minima over powers of two."""
    if not len(low):
        return np.empty(0, dtype=values.dtype)
    spans = high - low + 1
    level = np.frexp(spans.astype(np.float64))[1] - 1
    out = np.empty(len(low), dtype=values.dtype)
    table, size = values, 1
    for k in range(int(level.max()) + 1):
        if k:
            table = np.minimum(table[:-size], table[size:])
            size *= 2
        here = np.flatnonzero(level == k)
        out[here] = np.minimum(table[low[here]], table[high[here] - size + 1])
    return out


def rising(text: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than the next one; the end is smaller than anything."""
    n = len(text)
    ends = np.append(np.flatnonzero(text[1:] != text[:-1]), n - 1)
    up = np.zeros(len(ends), dtype=bool)
    up[:-1] = text[ends[:-1] + 1] > text[ends[:-1]]
    return np.repeat(up, np.diff(np.append(-1, ends)))


def _words(text: np.ndarray, at: np.ndarray, symbols: int) -> tuple[np.ndarray, int]:
    """So many symbols from each place as fit in 64 bits, and their number; 0 after the end."""
    bits = max(1, int(symbols).bit_length())
    per = max(1, 63 // bits)
    n = len(text)
    out = np.zeros(len(at), dtype=np.uint64)
    for k in range(per):
        place = at + k
        inside = place < n
        symbol = np.where(inside, text[np.where(inside, place, 0)], 0).astype(np.uint64)
        out = (out << np.uint64(bits)) | symbol
    return out, per


def _ranked(order: np.ndarray, differs: np.ndarray) -> np.ndarray:
    """Rank of every item: where its group of equals begins in the order."""
    ranks = np.empty(len(order), dtype=np.int64)
    starts = np.flatnonzero(differs)
    ranks[order] = np.repeat(starts, np.diff(np.append(starts, len(order))))
    return ranks


def _refine(ranks: np.ndarray, some: np.ndarray, keys: np.ndarray) -> None:
    """Order items of tied groups by keys; ``some`` holds whole groups."""
    order = np.lexsort((keys, ranks[some]))
    items, old, key = some[order], ranks[some][order], keys[order]
    group = np.append(True, old[1:] != old[:-1])
    fresh = group | np.append(True, key[1:] != key[:-1])
    number = np.arange(len(items))
    within = number - np.maximum.accumulate(np.where(group, number, 0))
    ranks[items] = old + np.maximum.accumulate(np.where(fresh, number, 0)) - (number - within)


def _tied(ranks: np.ndarray) -> np.ndarray:
    sizes = np.bincount(ranks, minlength=len(ranks))
    return np.flatnonzero(sizes[ranks] > 1)


def star_names(text: np.ndarray, stars: np.ndarray, symbols: int) -> np.ndarray:
    """Ranks of the stars by their text up to and with the first symbol of the next star."""
    ends = np.append(stars[1:] + 1, len(text) + 1)
    done = 0
    some = np.arange(len(stars))
    ranks = np.zeros(len(stars), dtype=np.int64)
    while len(some):
        keys, per = _words(text, stars[some] + done, symbols)
        bits = max(1, int(symbols).bit_length())
        over = np.maximum(0, done + per - (ends[some] - stars[some])).clip(max=per)
        # After its end a star's text counts as larger than any symbol (the next star rises, what
        # equals it here falls), but for the last star, which ends with the whole text.
        fill = (np.uint64(1) << (over * bits).astype(np.uint64)) - np.uint64(1)
        keys = np.where(ends[some] > len(text), keys, keys | fill)
        _refine(ranks, some, keys)
        done += per
        tied = _tied(ranks)
        # A group whose members have all ended is settled.
        open_ = np.zeros(len(ranks), dtype=bool)
        open_[ranks[tied[ends[tied] - stars[tied] > done]]] = True
        some = tied[open_[ranks[tied]]]
    return ranks


def _doubled(text: np.ndarray, depth: int) -> np.ndarray:
    """Order of suffixes of a string that fits memory, by doubling, up to ``depth`` symbols."""
    n = len(text)
    order = np.argsort(text, kind="stable")
    ranks = _ranked(order, np.append(True, text[order][1:] != text[order][:-1]))
    reach = 1
    while reach < depth:
        some = _tied(ranks)
        if not len(some):
            break
        ahead = some + reach
        keys = np.where(ahead < n, ranks[np.minimum(ahead, n - 1)] + 1, 0)
        _refine(ranks, some, keys)
        reach *= 2
    return np.argsort(ranks, kind="stable")


def suffix_order(text: np.ndarray, depth: int, rows: int = MEMORY_ROWS, folder: str | None = None) -> np.ndarray:
    """Positions of all suffixes in order; the recursion over names runs through here."""
    if len(text) <= rows:
        return _doubled(text, depth)
    found = [p for p, _ in induced(text, depth, rows, folder, prefixes=False)]
    return np.concatenate(found)[::-1]


def common_prefixes(text: np.ndarray, a: np.ndarray, b: np.ndarray, symbols: int, depth: int) -> np.ndarray:
    """Common prefixes of pairs of suffixes, compared a word at a time."""
    out = np.full(len(a), depth, dtype=np.int64)
    active = np.arange(len(a))
    bits = max(1, int(symbols).bit_length())
    at = 0
    while len(active) and at < depth:
        x, per = _words(text, a[active] + at, symbols)
        y, _ = _words(text, b[active] + at, symbols)
        differ = x ^ y
        apart = np.flatnonzero(differ)
        lead = np.frexp(differ[apart].astype(np.float64))[1]
        # Rounding up to the next power of two would move a difference one symbol at most.
        lead = np.where(differ[apart] >> np.minimum(lead - 1, 63).astype(np.uint64) == 0, lead - 1, lead)
        out[active[apart]] = np.minimum(depth, at + per - (lead + bits - 1) // bits)
        active = active[differ == 0]
        at += per
    # A suffix ends where the text does.
    return np.minimum(out, len(text) - np.maximum(a, b)).astype(np.uint8)


def induced(
    text: np.ndarray, depth: int, rows: int = MEMORY_ROWS, folder: str | None = None, prefixes: bool = True
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All suffixes in descending order, in chunks: positions, and common prefix with the one before.

    Symbols are positive integers below 2**31, below 256 if prefixes are wanted.
    """
    n = len(text)
    if not n:
        return
    symbols = int(text.max()) + 1
    up = rising(text)
    stars = np.flatnonzero(up[1:] & ~up[:-1]) + 1
    ranks = star_names(text, stars, symbols)
    if len(_tied(ranks)):
        names = np.zeros(len(stars) + 1, dtype=np.int64)
        names[np.unique(ranks)] = 1
        names = np.cumsum(names)
        stars = stars[suffix_order(names[ranks], depth // 2 + 1, rows, folder)]
    else:
        stars = stars[np.argsort(ranks)]
    star_prefixes = np.zeros(len(stars), dtype=np.uint8)
    if prefixes and len(stars) > 1:
        star_prefixes[1:] = common_prefixes(text, stars[:-1], stars[1:], symbols, depth)

    def between(a: int, b: int) -> int:
        return int(common_prefixes(text, np.array([a]), np.array([b]), symbols, depth)[0]) if prefixes else 0

    queue, falling = BucketQueue(folder, rows), ChunkStore(folder, rows)
    risen = BucketQueue(folder, rows)
    try:
        ascending = Carried(symbols, depth) if prefixes else None

        def push(target: BucketQueue, carried, places: np.ndarray, lcp: np.ndarray, chosen: np.ndarray, sign: int) -> None:
            before = places[chosen] - 1
            keys = text[before].astype(np.int64)
            order = np.argsort(sign * keys, kind="stable")
            keys, before = keys[order], before[order]
            if carried is None:
                target.push(sign * keys, before, np.zeros(len(keys), dtype=np.uint8))
            elif len(keys):
                target.push(sign * keys, before, carried.pushed(keys, chosen[order], lcp))
            else:
                carried.passed(lcp)

        # Ascending: falling suffixes, induced from what is smaller.
        queue.push(np.array([text[n - 1]], dtype=np.int64), np.array([n - 1]), np.array([0], dtype=np.uint8))
        if ascending:
            ascending.since[text[n - 1]] = 0
        heads = text[stars].astype(np.int64)
        at = 0
        while (key := queue.least()) is not None or at < len(stars):
            symbol = min(key if key is not None else symbols, int(heads[at]) if at < len(stars) else symbols)
            last = None
            while (chunk := queue.take(symbol)) is not None:
                places, lcp = chunk
                chosen = np.flatnonzero(places > 0)
                chosen = chosen[text[places[chosen] - 1] >= symbol]
                falling.add(symbol, chunk)
                push(queue, ascending, places, lcp, chosen, 1)
                last = int(places[-1])
            stop = int(np.searchsorted(heads, symbol, side="right"))
            while at < stop:
                end = min(stop, at + rows)
                places, lcp = stars[at:end], star_prefixes[at:end].copy()
                if last is not None:
                    lcp[0] = between(last, int(places[0]))
                elif at == 0 or heads[at - 1] != symbol:
                    lcp[0] = 0
                push(queue, ascending, places, lcp, np.arange(len(places)), 1)
                last, at = None, end
        # Descending: rising suffixes, induced from what is larger.
        descending = Carried(symbols, depth) if prefixes else None
        remaining = sorted(falling.chunks, reverse=True)
        at = 0
        while (key := risen.least()) is not None or at < len(remaining):
            symbol = max(-key if key is not None else -1, remaining[at] if at < len(remaining) else -1)
            last = None
            while (chunk := risen.take(-symbol)) is not None:
                places, lcp = chunk
                yield places, lcp
                chosen = np.flatnonzero(places > 0)
                chosen = chosen[text[places[chosen] - 1] <= symbol]
                push(risen, descending, places, lcp, chosen, -1)
                last = int(places[-1])
            if at < len(remaining) and remaining[at] == symbol:
                at += 1
                carry = None
                while (chunk := falling.take(symbol, last=True)) is not None:
                    places, up_lcp = chunk[0][::-1], chunk[1][::-1]
                    lcp = np.empty(len(places), dtype=np.uint8)
                    lcp[1:] = up_lcp[:-1]
                    # The first: with the smallest rising suffix of this symbol, or with the chunk before.
                    lcp[0] = carry if carry is not None else between(last, int(places[0])) if last is not None else 0
                    carry = up_lcp[-1]
                    yield places, lcp
                    chosen = np.flatnonzero(places > 0)
                    chosen = chosen[text[places[chosen] - 1] < symbol]
                    push(risen, descending, places, lcp, chosen, -1)
    finally:
        for store in (queue, falling, risen):
            store.close()
