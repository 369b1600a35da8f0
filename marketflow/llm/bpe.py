r"""BPE encoding and decoding over a table of distinct words.

Tasks split texts into words as the tokenizer's own pattern does and keep, for a block of
documents, its distinct words and for every position the number of its word. The distinct
words of all blocks meet by hash, each is encoded once, and its ids go back to the blocks
that asked, where they take their positions. Decoding joins the ids that a block's words have,
each once per bucket of words, with the table of pieces (one row per id of the vocabulary,
49,408 here, so of a fixed size); the pieces go to the block along with the ids, and texts are
put together from them as the tokenizer's decoder does.

Per occurrence only a word's number is stored, compressed; words are shuffled once per block
of about 4 million occurrences, not once per occurrence.
"""

from __future__ import annotations

import hashlib
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from marketflow.llm.arrays import runs
from marketflow.llm.common import give_back, materialize, tidy

#: The vocabulary's special tokens and its word pattern (white space spelled out).
SPECIAL = regex.compile(r"(<\|startoftext\|>|<\|endoftext\|>)")
WHITE = r"\x09-\x0D \x85\xA0  -     　"
WORDS = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{WHITE}\p{{L}}\p{{N}}]+")

WORDS_PER_BLOCK = 4_000_000
BUCKETS = 256
LEVEL = 9
WORDS_AT_ONCE = 20_000

POSITIONS_DDL = "docs array<long>, sizes array<int>, positions binary"
SHARED = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("steps", pa.binary()), ("words", pa.binary())])
IDS = pa.schema([("block", pa.int64()), ("steps", pa.binary()), ("counts", pa.binary()), ("ids", pa.binary()), ("id", pa.int32())])
IDS_DDL = "block long, steps binary, counts binary, ids binary, id int"
PIECES = pa.schema([*list(IDS)[:4], ("piece_ids", pa.binary()), ("pieces", pa.binary())])
PIECES_DDL = "block long, steps binary, counts binary, ids binary, piece_ids binary, pieces binary"
BLOCKS = pa.schema(
    [*SHARED, ("docs", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())), ("positions", pa.binary())]
)
BLOCKS_DDL = f"bucket int, block long, steps binary, words binary, {POSITIONS_DDL}"
RESULT = pa.schema(
    [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
)


def split_words(text: str) -> list[str]:
    """The words of a text, normalised; special tokens stand for themselves."""
    out: list[str] = []
    for n, part in enumerate(SPECIAL.split(text) if "<|" in text else [text]):
        if n % 2:
            out.append(part)
        elif part.isascii():
            out.extend(WORDS.findall(part.lower()))
        elif part:
            # Lower case letter by letter: a final sigma is no case of its own.
            out.extend(WORDS.findall(unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()))
    return out


def _squeezed(data: bytes) -> bytes:
    return zstandard.compress(data, LEVEL)


def packed(numbers: np.ndarray) -> bytes:
    """Numbers below 2**32 by byte planes, compressed; those below 255 in one plane, the rest apart."""
    numbers = np.asarray(numbers).astype("<u4")
    large = numbers[numbers >= 255] - np.uint32(255)
    planes = np.ascontiguousarray(large.view(np.uint8).reshape(-1, 4).T)
    return _squeezed(np.minimum(numbers, 255).astype(np.uint8).tobytes()) + b"".join(
        _squeezed(plane.tobytes()) for plane in planes
    )


def unpacked(data: bytes) -> np.ndarray:
    planes = []
    while data:
        reader = zstandard.ZstdDecompressor().decompressobj()
        planes.append(np.frombuffer(reader.decompress(data), dtype=np.uint8))
        data = reader.unused_data
    numbers = planes[0].astype("<u4")
    large = np.ascontiguousarray(np.stack(planes[1:]).T).view("<u4").ravel()
    numbers[numbers == 255] += large
    return numbers


class _Block:
    """Documents of one block, gathered while a partition is read."""

    def __init__(self, number: int):
        self.number = number
        self.index: dict[str, int] = {}
        self.docs: list[int | None] = []
        self.sizes: list[int] = []
        self.positions: list[np.ndarray] = []
        self.total = 0

    def add(self, doc: int | None, text: str) -> None:
        index = self.index
        found = [index.setdefault(w, len(index)) for w in split_words(text)]
        self.docs.append(doc)
        self.sizes.append(len(found))
        self.positions.append(np.array(found, dtype=np.uint32))
        self.total += len(found)

    def rows(self, buckets: int) -> Iterator[pa.RecordBatch]:
        """The block's positions and, by bucket, its words: numbered anew by count, then by name."""
        words = sorted(self.index)
        first = np.fromiter((self.index[w] for w in words), dtype=np.int64, count=len(words))
        seen = np.concatenate(self.positions)
        self.positions.clear()
        counts = np.bincount(seen, minlength=len(words))[first]
        order = np.argsort(-counts, kind="stable")
        number = np.empty(len(words), dtype=np.uint32)
        number[first[order]] = np.arange(len(words))
        yield _row(BLOCKS, block=self.number, docs=self.docs, sizes=self.sizes, positions=packed(number[seen]))
        by: list[list[str]] = [[] for _ in range(buckets)]
        numbers: list[list[int]] = [[] for _ in range(buckets)]
        for n, at in enumerate(order.tolist()):
            bucket = xxhash.xxh64_intdigest(words[at].encode()) % buckets
            by[bucket].append(words[at])
            numbers[bucket].append(n)
        for bucket, some in enumerate(by):
            if some:
                steps = packed(np.diff(numbers[bucket], prepend=0))
                yield _row(BLOCKS, bucket=bucket, block=self.number, steps=steps, words=_squeezed("\n".join(some).encode()))


def _row(schema: pa.Schema, **values) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([values.get(f.name)], f.type) for f in schema], schema=schema)


def _blocks(words_per_block: int, buckets: int):
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        block = _Block(first)
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                block.add(doc, text.as_py())
                if block.total >= words_per_block:
                    yield from block.rows(buckets)
                    block = _Block(block.number + 1)
        if block.docs:
            yield from block.rows(buckets)

    return tidy(blocks)


def _encoded(path: str):
    """Rows sorted by bucket: every distinct word of a bucket is encoded once.

    After a block's words come the ids that they have, a row each, to be joined with their pieces.
    """

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = Tokenizer.from_file(path)
        bucket, known = None, {}
        for batch in batches:
            for row in batch.to_pylist():
                if row["bucket"] != bucket:
                    bucket, known = row["bucket"], {}
                words = zstandard.decompress(row["words"]).decode().split("\n")
                new = [w for w in words if w not in known]
                for a in range(0, len(new), WORDS_AT_ONCE):
                    some = new[a : a + WORDS_AT_ONCE]
                    codes = tokenizer.encode_batch(some, add_special_tokens=False)
                    known.update((w, np.array(c.ids, dtype=np.uint32)) for w, c in zip(some, codes))
                found = [known[w] for w in words]
                counts, ids = np.array([len(f) for f in found]), np.concatenate(found)
                yield _row(IDS, block=row["block"], steps=row["steps"], counts=packed(counts), ids=packed(ids))
                asked = np.unique(ids)
                blocks, none = np.full(len(asked), row["block"]), pa.nulls(len(asked), pa.binary())
                columns = [pa.array(blocks), none, none, none, pa.array(asked, pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, schema=IDS)

    return tidy(encoded)


def _with_packed_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of words as they are; runs of ids of one block, joined with their pieces, as one row each."""
    for batch in batches:
        single = batch.column("id").is_valid()
        words = batch.filter(pc.invert(single))
        if len(words):
            empty = pa.nulls(len(words), pa.binary())
            yield pa.RecordBatch.from_arrays([*(words.column(n) for n in PIECES.names[:4]), empty, empty], schema=PIECES)
        joined = batch.filter(single)
        blocks, ids = joined.column("block").to_numpy(), joined.column("id").to_numpy()
        pieces = joined.column("piece")
        for a, b in runs(blocks):
            order = np.argsort(ids[a:b])
            text = "\n".join(pieces.slice(a, b - a).take(pa.array(order)).to_pylist())
            steps = packed(np.diff(ids[a:b][order], prepend=0))
            yield _row(PIECES, block=int(blocks[a]), piece_ids=steps, pieces=_squeezed(text.encode()))


def _digests():
    def digests(_, table):
        rows = table.to_pylist()
        pieces: dict[int, bytes] = {}
        for r in rows:
            if r["piece_ids"]:
                found = zstandard.decompress(r["pieces"]).split(b"\n")
                pieces.update(zip(np.cumsum(unpacked(r["piece_ids"])).tolist(), found))
        # Words of a block are numbered from 0 without gaps.
        parts = [(np.cumsum(unpacked(r["steps"])), unpacked(r["counts"]), unpacked(r["ids"])) for r in rows if r["ids"]]
        total = sum(len(p[0]) for p in parts)
        codes, texts = [b""] * total, [b""] * total
        for numbers, counts, ids in parts:
            listed, raw, at = ids.tolist(), ids.tobytes(), 0
            for number, end in zip(numbers.tolist(), np.cumsum(counts).tolist()):
                codes[number] = raw[4 * at : 4 * end]
                texts[number] = b" ".join([pieces[i] for i in listed[at:end]])
                at = end
        out = []
        for row in rows:
            if row["positions"] is None:
                continue
            positions, at = unpacked(row["positions"]), 0
            for doc, size in zip(row["docs"], row["sizes"]):
                numbers = positions[at : at + size].tolist()
                at += size
                ids = b"".join([codes[n] for n in numbers])
                text = b" ".join([texts[n] for n in numbers])
                out.append((doc, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text).hexdigest()))
        del codes, texts, parts, rows
        give_back()
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), RESULT)], schema=RESULT)

    return digests


def encode_and_decode(
    docs: DataFrame, tokenizer_path: str, words_per_block: int = WORDS_PER_BLOCK, buckets: int = BUCKETS
) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every row of ``docs``.

    A null text is empty; very long texts are encoded whole; repeated rows are all returned; an
    empty table gives no rows; other columns are not looked at. The tokenizer file is read on every worker.
    """
    texts = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    blocks = materialize(texts.mapInArrow(_blocks(words_per_block, buckets), BLOCKS_DDL))
    asked = blocks.filter("bucket IS NOT NULL").select("bucket", "block", "steps", "words")
    ids = (
        asked.repartition("bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(_encoded(tokenizer_path), IDS_DDL)
    )
    # One row per id of the vocabulary. Rows of words have no id and pass.
    joined = ids.join(F.broadcast(piece_table(docs, tokenizer_path)), "id", "left")
    known = joined.mapInArrow(tidy(_with_packed_pieces), PIECES_DDL)
    positions = blocks.filter("bucket IS NULL").select("block", "docs", "sizes", "positions")
    both = positions.unionByName(known, allowMissingColumns=True)
    return both.groupBy("block").applyInArrow(
        _digests(), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def piece_table(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """``id, piece`` of every id of a vocabulary."""
    tokenizer = Tokenizer.from_file(tokenizer_path)
    rows = [(i, tokenizer.id_to_token(i)) for i in range(tokenizer.get_vocab_size())]
    return docs.sparkSession.createDataFrame(rows, "id int, piece string")


def decode_ids(rows: DataFrame, tokenizer_path: str, ids_column: str = "ids") -> DataFrame:
    """``rows`` with ``decoded``: pieces of an id array, joined by position with the piece table.

    The table has one row per id of the vocabulary, so it is small enough to broadcast. A
    null array decodes to null, an empty one to the empty text; unknown ids are passed over.
    """
    numbered = materialize(rows.withColumn("_row", F.monotonically_increasing_id()))
    asked = numbered.select("_row", F.posexplode(ids_column).alias("_at", "id"))
    found = asked.join(F.broadcast(piece_table(rows, tokenizer_path)), "id")
    texts = found.groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("_at", "piece"))).alias("_all"))
    texts = texts.select("_row", F.array_join(F.transform("_all", lambda p: p["piece"]), " ").alias("decoded"))
    joined = numbered.join(texts, "_row", "left").drop("_row")
    return joined.withColumn("decoded", F.when(F.col(ids_column).isNotNull(), F.coalesce("decoded", F.lit(""))))
