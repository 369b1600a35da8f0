"""SentencePiece BPE encoding in vectorised merge rounds, and decoding.

All symbols of many words lie in one flat numpy array. A round finds the smallest rank of a
pair within every word (a segmented minimum), merges all pairs of that rank from the left at
once, and compacts the array; words in which no pair is left drop out. Merging one at a time,
best rank first and leftmost among equals, gives the same: where a merge makes a pair of that
rank or a better one, which would have come before the word's other merges, only the word's
leftmost merge is made in that round.

A pair is cut before the first round where it can never be merged: no piece holds its two
characters side by side. So a text without spaces falls apart like any other.

The model file is read, never trained: BPE models with an identity normaliser and byte
fallback (others are refused).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketflow.llm.common import tidy

SPACE = "▁"
NO_RANK = np.iinfo(np.int32).max
#: Texts encoded at a time, and symbols that are merged at a time.
TEXTS_AT_ONCE = 500
SYMBOLS_AT_ONCE = 1_000_000
#: Characters of distinct words that a task remembers before it starts afresh.
MOST_REMEMBERED = 4_000_000


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbered fields of a protocol-buffer message."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[at]
            at, value, shift = at + 1, value | (byte & 127) << shift, shift + 7
            if byte < 128:
                return value, at

    at = 0
    while at < len(data):
        key, at = varint(at)
        if key & 7 == 0:
            value, at = varint(at)
        else:
            size, at = varint(at) if key & 7 == 2 else ({1: 8, 5: 4}[key & 7], at)
            value, at = data[at : at + size], at + size
        yield key >> 3, value


def _prefixes(data: bytes) -> bool:
    """Does the model of a file put a space before texts; an error if it is of another kind."""
    # Field numbers of the public model format and their defaults.
    trainer, normalizer = {}, {}
    for number, value in _fields(data):
        if number == 2:
            trainer = dict(_fields(value))
        elif number == 3:
            normalizer = dict(_fields(value))
    if trainer.get(3, 1) != 2 or not trainer.get(35, 0) or trainer.get(24, 0):
        raise ValueError("only BPE models with byte fallback and spaces as prefixes are encoded")
    if normalizer.get(2, b"") or normalizer.get(4, 1) or not normalizer.get(5, 1):
        raise ValueError("only models that leave texts as they are, but for the mark of spaces, are encoded")
    return bool(normalizer.get(3, 1))


class Pieces:
    """A model's pieces as arrays: ranks of pairs, ids of characters and bytes, bytes of ids."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            self.prefix = _prefixes(file.read())
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = model.get_piece_size()
        pieces = [model.id_to_piece(i) for i in range(self.size)]
        kinds = [(model.is_byte(i), model.is_control(i), model.is_unknown(i)) for i in range(self.size)]
        if any(model.is_unused(i) for i in range(self.size)):
            raise ValueError("models with unused pieces are not encoded")
        normal = {p: i for i, p in enumerate(pieces) if not any(kinds[i])}
        self.byte_ids = np.zeros(256, dtype=np.int64)
        texts: list[bytes] = []
        for i, (piece, (is_byte, is_control, is_unknown)) in enumerate(zip(pieces, kinds)):
            if is_byte:
                self.byte_ids[int(piece[3:5], 16)] = i
                texts.append(bytes([int(piece[3:5], 16)]))
            else:
                texts.append(b"" if is_control else " ⁇ ".encode() if is_unknown else piece.replace(SPACE, " ").encode())
        self.text_ends = np.cumsum([len(t) for t in texts])
        self.text_sizes = np.array([len(t) for t in texts])
        self.text_bytes = np.frombuffer(b"".join(texts), dtype=np.uint8)

        single = sorted((ord(p), i) for p, i in normal.items() if len(p) == 1)
        self.chars = np.array([c for c, _ in single], dtype=np.int64)
        self.char_ids = np.array([i for _, i in single], dtype=np.int64)
        # Symbols: piece ids, then unknown characters by code point.
        self.base = self.size + 0x110000
        longer = [p for p in normal if len(p) > 1]
        order = {s: n for n, s in enumerate(sorted({-model.get_score(normal[p]) for p in longer}))}

        def symbol(part: str) -> int | None:
            found = normal.get(part)
            return self.size + ord(part) if found is None and len(part) == 1 else found

        pairs = {}
        for piece in longer:
            for cut in range(1, len(piece)):
                left, right = symbol(piece[:cut]), symbol(piece[cut:])
                if left is not None and right is not None:
                    pairs[left * self.base + right] = order[-model.get_score(normal[piece])], normal[piece]
        self.pair_keys = np.array(sorted(pairs), dtype=np.int64)
        self.pair_ranks = np.array([pairs[k][0] for k in self.pair_keys.tolist()], dtype=np.int32)
        self.pair_made = np.array([pairs[k][1] for k in self.pair_keys.tolist()], dtype=np.int64)
        beside = {ord(a) << 21 | ord(b) for p in longer for a, b in zip(p, p[1:])}
        self.beside = np.array(sorted(beside), dtype=np.int64)

        # Runs of spaces fall apart at multiples of the longest piece of spaces, if pieces of spaces
        # share one rank, no other piece holds two spaces and a run of that length becomes that
        # piece: merges go from the left, so a run's head is through before its rest is touched.
        self.most_spaces = 0
        blank = [p for p in longer if SPACE * 2 in p]
        if blank and len({model.get_score(normal[p]) for p in blank}) == 1 and {*"".join(blank)} == {SPACE}:
            most = max(map(len, blank))
            if len(self.merged(*self.symbols([SPACE * most])[:2], np.arange(most))[0]) == 1:
                self.most_spaces = most

        # Where words may be cut before they are looked up: at characters that join no other.
        joining = {c for p in longer for c in p}
        alone = "".join(re.escape(chr(c)) for c in range(128) if chr(c) not in joining)
        apart = all(not re.search(f"[^{SPACE}]{SPACE}", p) for p in longer)
        some = f"[{alone}]+|" if alone else ""
        self.words = re.compile(f"{some}{SPACE}*[^{SPACE}{alone}]+|{SPACE}+" if apart else r"(?s).+")

    def ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair of symbols, and what it makes."""
        if not len(self.pair_keys):
            return np.full(len(left), NO_RANK, np.int32), np.zeros(len(left), np.int64)
        keys = left * self.base + right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        known = self.pair_keys[at] == keys
        return np.where(known, self.pair_ranks[at], NO_RANK), self.pair_made[at]

    def normalized(self, text: str) -> str:
        return (SPACE + text if text and self.prefix else text).replace(" ", SPACE)

    def symbols(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Flat symbols of words, the segment that each lies in, and each word's first symbol."""
        codes = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
        starts = np.concatenate([[0], np.cumsum([len(w) for w in words])[:-1]]).astype(np.int64)
        at = np.minimum(np.searchsorted(self.chars, codes), len(self.chars) - 1)
        symbols = np.where(self.chars[at] == codes, self.char_ids[at], self.size + codes)
        first = np.zeros(len(codes), dtype=bool)
        first[starts] = True
        if len(codes) > 1 and len(self.beside):
            keys = codes[:-1] << 21 | codes[1:]
            at = np.minimum(np.searchsorted(self.beside, keys), len(self.beside) - 1)
            first[1:] |= self.beside[at] != keys
        if self.most_spaces > 1:
            blank = codes == ord(SPACE)
            opens = blank & np.append(True, ~blank[:-1] | first[1:])
            place = np.arange(len(codes))
            since = place - np.maximum.accumulate(np.where(opens, place, 0))
            first |= blank & (since % self.most_spaces == 0)
        return symbols, np.cumsum(first) - 1, starts

    def merged(self, symbols: np.ndarray, segments: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols after all merges, and the places of their first characters, in order."""
        done: list[tuple[np.ndarray, np.ndarray]] = []
        rank, made = np.full(len(symbols), NO_RANK, np.int32), np.zeros(len(symbols), np.int64)
        inside = np.flatnonzero(segments[1:] == segments[:-1])
        rank[inside], made[inside] = self.ranks(symbols[inside], symbols[inside + 1])
        while len(symbols):
            starts = np.flatnonzero(np.append(True, segments[1:] != segments[:-1]))
            sizes = np.diff(np.append(starts, len(symbols)))
            best = np.minimum.reduceat(rank, starts)
            # Words in which no pair is left drop out.
            over = np.repeat(best == NO_RANK, sizes)
            if over.any():
                done.append((symbols[over], place[over]))
                symbols, segments, place, rank, made = (x[~over] for x in (symbols, segments, place, rank, made))
                if not len(symbols):
                    break
                sizes, best = sizes[best != NO_RANK], best[best != NO_RANK]
                starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            word = np.repeat(np.arange(len(sizes)), sizes)
            hits = np.flatnonzero(rank == best[word])
            # Of pairs that overlap every other one is merged, from the left.
            opens = np.append(True, np.diff(hits) != 1)
            run = np.flatnonzero(opens)[np.cumsum(opens) - 1]
            hits = hits[(np.arange(len(hits)) - run) % 2 == 0]
            hits = self._in_order(symbols, rank, made, word, best, hits)
            new = made[hits]
            symbols[hits] = new
            gone = np.zeros(len(symbols), dtype=bool)
            gone[hits + 1] = True
            kept = ~gone
            at = (np.cumsum(kept) - 1)[hits]
            symbols, segments, place, rank, made = (x[kept] for x in (symbols, segments, place, rank, made))
            changed = np.union1d(at, at[at > 0] - 1)
            rank[changed] = NO_RANK
            changed = changed[changed + 1 < len(symbols)]
            changed = changed[segments[changed] == segments[changed + 1]]
            rank[changed], made[changed] = self.ranks(symbols[changed], symbols[changed + 1])
        if not done:
            return symbols, place
        symbols, place = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(place, kind="stable")
        return symbols[order], place[order]

    def _in_order(self, symbols, rank, made, word, best, hits: np.ndarray) -> np.ndarray:
        """Merges that may be made at once: all of a word's, or its leftmost where one makes a pair as good."""
        of = word[hits]
        leftmost = np.append(True, of[1:] != of[:-1])
        if leftmost.all():
            return hits
        new, now = made[hits], best[of]
        before = hits - 1
        left = np.where(before >= 0, symbols[before], 0)
        # The symbol before has been merged already where the hit before it ends there.
        joined = np.append(False, hits[1:] - hits[:-1] == 2) & ~leftmost
        left = np.where(joined, np.append(0, new[:-1]), left)
        has_left = (before >= 0) & (word[np.maximum(before, 0)] == of)
        after = np.minimum(hits + 2, len(symbols) - 1)
        has_right = (hits + 2 < len(symbols)) & (word[after] == of)
        early = has_left & (self.ranks(left, new)[0] <= now)
        early |= has_right & (self.ranks(new, symbols[after])[0] <= now)
        if not early.any():
            return hits
        apart = np.zeros(len(best), dtype=bool)
        apart[of[early]] = True
        return hits[leftmost | ~apart[of]]

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of words that are not empty, and how many each word has."""
        ids, counts, a = [], [], 0
        sizes = np.cumsum([len(w) for w in words])
        while a < len(words):
            b = max(a + 1, int(np.searchsorted(sizes, (sizes[a - 1] if a else 0) + SYMBOLS_AT_ONCE, "right")))
            some = words[a:b]
            codes, segments, starts = self.symbols(some)
            symbols, place = self.merged(codes, segments, np.arange(len(codes)))
            of = np.searchsorted(starts, place, "right") - 1
            found, each = self._with_bytes(symbols)
            ids.append(found)
            counts.append(np.bincount(of, weights=each, minlength=len(some)).astype(np.int64))
            a = b
        return np.concatenate(ids), np.concatenate(counts)

    def _with_bytes(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of symbols, and how many each takes: unknown characters become the pieces of their bytes."""
        each = np.ones(len(symbols), dtype=np.int64)
        unknown = np.flatnonzero(symbols >= self.size)
        if not len(unknown):
            return symbols.astype(np.int32), each
        raw = [chr(c).encode() for c in (symbols[unknown] - self.size).tolist()]
        each[unknown] = [len(r) for r in raw]
        ids = np.repeat(symbols, each)
        ids[ids >= self.size] = self.byte_ids[np.frombuffer(b"".join(raw), dtype=np.uint8)]
        return ids.astype(np.int32), each

    def decode(self, ids: np.ndarray, sizes: np.ndarray) -> list[str]:
        """Texts of flat ids, ``sizes`` to a text."""
        data = self.text_bytes[_ranges(self.text_ends[ids] - self.text_sizes[ids], self.text_sizes[ids])].tobytes()
        ends = np.append(0, np.cumsum(self.text_sizes[ids]))[np.cumsum(sizes)].tolist() if len(ids) else [0] * len(sizes)
        out, start = [], 0
        for end in ends:
            if self.prefix and start < end and data[start] == 0x20:
                start += 1
            out.append(data[start:end].decode("utf-8", "replace"))
            start = end
        return out


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Numbers of all ranges, one after the other."""
    ends = np.cumsum(sizes)
    if not len(ends):
        return np.empty(0, dtype=np.int64)
    return np.arange(ends[-1]) + np.repeat(starts - (ends - sizes), sizes)


@lru_cache(maxsize=2)
def pieces_of(path: str) -> Pieces:
    return Pieces(path)


class Encoder:
    """Ids of texts; distinct words are encoded once while they are remembered."""

    def __init__(self, pieces: Pieces, most: int = MOST_REMEMBERED):
        self.pieces, self.most = pieces, most
        self._forget()

    def _forget(self) -> None:
        self.index: dict[str, int] = {}
        self.held = 0
        self.flat = np.empty(0, dtype=np.int32)
        self.starts = np.empty(0, dtype=np.int64)
        self.counts = np.empty(0, dtype=np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of texts, and how many each text has."""
        if self.held > self.most:
            self._forget()
        index, words_of = self.index, self.pieces.words
        known = len(index)
        numbers, sizes = [], []
        for text in texts:
            words = words_of.findall(self.pieces.normalized(text))
            numbers.extend([index.setdefault(w, len(index)) for w in words])
            sizes.append(len(words))
        new = list(index)[known:]
        if new:
            ids, counts = self.pieces.encode_words(new)
            ends = len(self.flat) + np.cumsum(counts)
            self.flat = np.concatenate([self.flat, ids])
            self.starts = np.concatenate([self.starts, ends - counts])
            self.counts = np.concatenate([self.counts, counts])
            self.held += sum(map(len, new))
        numbers = np.array(numbers, dtype=np.int64)
        counts = self.counts[numbers]
        totals = np.append(0, np.cumsum(counts))[np.cumsum([0, *sizes])]
        return self.flat[_ranges(self.starts[numbers], counts)], np.diff(totals)


def _lists(ids: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    offsets = np.append(0, np.cumsum(sizes)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids, pa.int32()))


def encode_pieces(docs: DataFrame, model_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, ids`` of every row of ``docs``: the ids of its whole text, without begin or end ids.

    A null text is empty and has no ids; repeated rows are all returned; an empty table gives no
    rows; other columns, whatever their names, are not looked at. A text of any length goes
    through the same rounds, and its work grows with its length. The rows go through map tasks
    alone, nothing is shuffled. The model file is read on every worker.
    """

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(pieces_of(model_path))
        for batch in batches:
            for a in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(a, TEXTS_AT_ONCE)
                ids, sizes = encoder.encode(part.column(1).to_pylist())
                yield pa.record_batch([part.column(0), _lists(ids, sizes)], names=["doc_id", "ids"])

    texts = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text")
    )
    return texts.mapInArrow(tidy(encoded), "doc_id long, ids array<int>")


def decode_pieces(rows: DataFrame, model_path: str) -> DataFrame:
    """``doc_id, ids`` with ``decoded``: the pieces of the ids put together; a null list gives the empty text.

    The text that was encoded comes back, with marks of spaces as spaces.
    """

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(model_path)
        for batch in batches:
            for a in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(a, TEXTS_AT_ONCE)
                lists = part.column(1)
                sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
                texts = pieces.decode(lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), sizes)
                yield pa.record_batch([part.column(0), lists, pa.array(texts, pa.string())], names=["doc_id", "ids", "decoded"])

    return rows.select("doc_id", "ids").mapInArrow(tidy(decoded), "doc_id long, ids array<int>, decoded string")
