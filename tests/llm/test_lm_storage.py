from __future__ import annotations

import random

import numpy as np
import pytest

from marketflow.llm.lm import WORDS, _arrays, _coded, _places, _row, _slots, fit, language_model_scores


def test_the_model_of_distinct_ngrams_takes_few_bytes(spark, tmp_path):
    draw = random.Random(5)
    texts = [" ".join(f"w{draw.randrange(4000)}" for _ in range(2_000)) for _ in range(30)]
    fit(spark.createDataFrame([(t,) for t in texts], "text string").coalesce(2), str(tmp_path))
    size = sum(f.stat().st_size for f in tmp_path.iterdir())
    # 60,000 pairs and as many triples: with eight bytes and whole counts for each they take over 20 bytes a word.
    assert size < 16 * 60_000


def test_rows_give_back_their_arrays():
    ranked = np.array([3, 3, 2**40, 2**63 + 5], dtype=np.uint64)
    counts = np.array([1, 300, 2**33, 0], dtype=np.int64)
    batch = _row(7, WORDS, ranked, counts, np.array([1, 0, 1, 1], dtype=np.uint32))
    kind, *_ = data = batch.column(1)[0].as_py()
    assert (kind, batch.column(0).to_pylist()) == (WORDS, [7])
    for got, want in zip(_arrays(data), (ranked, counts, [1, 0, 1, 1]), strict=True):
        assert got.tolist() == list(want)


@pytest.mark.parametrize("n", [0, 1, 2, 31, 5_000])
def test_slots_find_what_they_hold_and_nothing_else(n):
    draw = np.random.default_rng(n)
    keys = np.unique(draw.integers(0, 2**64, n, dtype=np.uint64, endpoint=False))
    # Some in one slot, at its ends.
    keys = np.unique(np.concatenate([keys, keys[:3] + np.uint64(1 << 24)]))
    asked = np.unique(np.concatenate([keys[::2], draw.integers(0, 2**64, 500, dtype=np.uint64), keys[:5] ^ np.uint64(1 << 30)]))
    hit, at = _places(asked, *_slots(keys))
    assert asked[hit].tolist() == keys[at].tolist() == sorted(set(asked.tolist()) & set(keys.tolist()))


def test_codes_stand_for_rows_the_commonest_first():
    columns = [np.array([1, 2**40, 1, 1, 2**40]), np.array([1, 2**40, 1, 0, 7]), np.array([0, 2**40, 0, 0, 2**40])]
    table, codes = _coded(columns)
    assert [table[:, c].tolist() for c in codes] == [list(row) for row in zip(*(c.tolist() for c in columns))]
    assert codes[0] == codes[2] == 0


def test_scores_do_not_depend_on_buckets(spark, tmp_path, monkeypatch):
    draw = random.Random(9)
    words = [f"w{int(draw.paretovariate(0.7)) % 300}" for _ in range(6_000)]
    rows = [(d, " ".join(words[d * 60 : d * 60 + 60]) + " new" * (d % 3 == 0)) for d in range(100)]
    rows += [(100, None), (101, " "), (None, "w1 w2"), (1, "w1 w1 w1"), (1, "w1 w1 w1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    found = []
    for name, size in (("few", 1 << 24), ("many", 500)):
        monkeypatch.setattr("marketflow.llm.lm.TEXT_BYTES_PER_BUCKET", size)
        scored = language_model_scores(docs, str(tmp_path / name)).collect()
        found.append(sorted(scored, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["n_tokens"])))
    for a, b in zip(*found, strict=True):
        assert a[:5] == b[:5]
        assert a[5:] == pytest.approx(b[5:], rel=1e-9)
