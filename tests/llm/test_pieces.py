from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import sentencepiece

from marketflow.llm.pieces import Encoder, Pieces, decode_pieces, encode_pieces
from marketflow.llm.queries import QUERIES

DATA = "/root/testdata/sf0.01"
MODEL = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, ids string, decoded int, source string"
ODD = [
    "", " ", "  a  b ", "a\nb", "▁x", "é😀\x00z", "Hello  world\t!", "\xa0x", "<s> hi </s> <unk> <0x41>", "ﬁ Å", "▁▁ ▁",
    "aaaaaaaaaaaaa" * 20, "abababab" * 30, "\r\n\r\n", "的" * 500, "a" + " " * 50 + "b", " " * 33 + "word", "𝔘𝔫𝔦",
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def pieces():
    return Pieces(MODEL)


def check(pieces, library, texts, most: int = 1 << 20):
    encoder = Encoder(pieces, most)
    for a in range(0, len(texts), 400):
        some = texts[a : a + 400]
        ids, sizes = encoder.encode(some)
        want = library.encode(some, num_threads=1)
        ends = np.cumsum(sizes)
        assert [ids[e - n : e].tolist() for e, n in zip(ends, sizes)] == want
        assert pieces.decode(ids.astype(np.int64), sizes) == [library.decode(w) for w in want]


def test_odd_texts_match_the_library(pieces, library):
    check(pieces, library, ODD + [" " * n for n in range(1, 120)] + [" " * n + "of" for n in range(60)])


@pytest.mark.parametrize("alphabet", ["ab", "abc ", "the ing er an ", "  \n\taA.", "éèñ的是😀 ▁a", "0123456789.,-= "])
def test_random_texts_match_the_library(pieces, library, alphabet):
    rng = random.Random(alphabet)
    check(pieces, library, ["".join(rng.choices(alphabet, k=rng.randint(0, 200))) for _ in range(500)], 2000)


def test_texts_of_pieces_match_the_library(pieces, library):
    rng = random.Random(3)
    vocabulary = [library.id_to_piece(i).replace("▁", " ") for i in range(3, 32000)]
    check(pieces, library, ["".join(rng.choices(vocabulary, k=rng.randint(0, 30))) for _ in range(1500)])


def test_merges_that_may_not_go_at_once_go_in_order(pieces, library):
    """With the cuts before the first round switched off, runs of spaces need the order."""
    whole = Pieces(MODEL)
    whole.most_spaces = 0
    check(whole, library, [" " * n for n in range(60)] + ["x" + " " * n + "the" for n in range(40)])


def test_very_long_texts(pieces, library):
    check(pieces, library, ["的是不了" * 30_000, " " * 100_000, "x" * 100_000, "word " * 50_000])


def test_rows_match_the_library(spark, library):
    rows = QUERIES["op13_piece_bpe"](spark, DATA).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in pq.read_table(f"{DATA}/documents.parquet").to_pylist()}
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_awkward_rows(spark, library):
    texts = [*enumerate(ODD), (0, ""), (1, " "), (None, "no id"), (99, None)]
    rows = spark.createDataFrame([(d, t, "i", 1, "s") for d, t in texts], SCHEMA).repartition(3)
    got = decode_pieces(encode_pieces(rows, MODEL), MODEL).collect()
    want = [(d, tuple(library.encode(t or "")), library.decode(library.encode(t or ""))) for d, t in texts]
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    assert sorted(((r["doc_id"], tuple(r["ids"]), r["decoded"]) for r in got), key=key) == sorted(want, key=key)
    assert encode_pieces(rows.limit(0), MODEL).collect() == [] and decode_pieces(encode_pieces(rows.limit(0), MODEL), MODEL).collect() == []
    nothing = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert [r["decoded"] for r in decode_pieces(nothing, MODEL).collect()] == ["", ""]


def test_other_models_are_refused(tmp_path):
    with open(f"{tmp_path}/other.model", "wb") as file:
        file.write(bytes([18, 2, 24, 1]))
    with pytest.raises(ValueError, match="BPE"):
        Pieces(f"{tmp_path}/other.model")
