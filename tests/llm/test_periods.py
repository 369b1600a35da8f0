from __future__ import annotations

import random

import numpy as np
import pyarrow.parquet as pq

import brute
from marketflow.llm import periods
from marketflow.llm.periods import collapsed, periodic_runs, runs_of, split_segments
from marketflow.llm.queries import QUERIES

DATA = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, runs string, collapsed int, period double"


def random_text(rng: random.Random) -> list[bytes]:
    out: list[bytes] = []
    for _ in range(rng.randint(0, 6)):
        few = "abcdefghij"[: rng.randint(1, 10)]
        base = [rng.choice(few).encode() for _ in range(rng.choice([1, 2, 3, 5, 16, 17, 18, 20, 33, 60]))]
        out += (base * rng.randint(1, 9))[: rng.randint(0, 400)]
        out += [rng.choice("abcxyz").encode() for _ in range(rng.randint(0, 5))]
    return out


def test_runs_match_brute_force():
    rng = random.Random(5)
    for _ in range(150):
        texts = [random_text(rng) for _ in range(rng.randint(1, 6))]
        assert runs_of(texts) == [brute.periodic(t) for t in texts]


def test_a_run_of_every_period_is_found_at_its_least_length():
    for q in range(1, 60):
        base = [f"w{i}".encode() for i in range(q)]
        length = max(6, 4 * q)
        run = (base * (length // q + 1))[:length]
        assert runs_of([[b"x", *run, b"y"]]) == [[(1, length, q)]]
        assert runs_of([[b"x", *run[:-1], b"y"]]) == [[]]


def test_splitting_leaves_no_prose_and_no_rare_word():
    rng = np.random.default_rng(1)
    prose = rng.zipf(1.3, 5000) % 2000
    place, words, segments = split_segments(prose, np.zeros(len(prose), np.int64))
    for s in np.unique(segments):
        inside = words[segments == s]
        assert len(inside) >= 6 and np.unique(inside, return_counts=True)[1].min() >= 4
        assert (np.diff(place[segments == s]) == 1).all()
    assert len(place) < len(prose) / 2


def test_very_long_texts():
    period = [f"{i}".encode() for i in range(30_000)]
    assert runs_of([period * 4, [b"a"] * 200_000]) == [[(0, 120_000, 30_000)], [(0, 200_000, 1)]]
    noise = [b"ab"[i : i + 1] for i in np.random.default_rng(2).integers(0, 2, 3000).tolist()]
    assert runs_of([noise]) == [brute.periodic(noise)]


def test_collapsed_texts_keep_the_first_period():
    words = "a x y x y x y x y x b b b b b b c".encode().split()
    runs = runs_of([words])[0]
    assert runs == [(1, 9, 2), (10, 6, 1)] and collapsed(words, runs) == b"a x y b c"


def test_query_matches_brute_force(spark):
    got = [tuple(r) for r in QUERIES["op12_periodic_runs"](spark, DATA).collect()]
    table = pq.read_table(f"{DATA}/documents.parquet").to_pylist()
    assert sorted(got) == sorted(brute.run_digests(r["doc_id"], r["text"]) for r in table)
    assert sum(r[1] for r in got) > 50


def test_awkward_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(periods, "WORDS_AT_ONCE", 7)
    texts = [(1, "a b " * 5), (1, "a b " * 5), (2, None), (3, ""), (4, " \t\n "), (None, "é é é é é é"), (40, None), (41, "q")]
    rows = spark.createDataFrame([(d, t, "r", 1, 0.5) for d, t in texts], SCHEMA)
    got = {(r["doc_id"], len(r["runs"]), r["collapsed"]) for r in periodic_runs(rows).collect()}
    assert got == {(1, 1, "a b"), (2, 0, ""), (3, 0, ""), (4, 0, ""), (None, 1, "é"), (40, 0, ""), (41, 0, "q")}
    assert periodic_runs(rows).count() == len(texts) and periodic_runs(rows.limit(0)).collect() == []
    rows.repartition(2).write.parquet(f"{tmp_path}/documents.parquet")
    found = [tuple(r) for r in QUERIES["op12_periodic_runs"](spark, str(tmp_path)).collect()]
    key = lambda r: (r[0] is not None, r[0] or 0)
    assert sorted(found, key=key) == sorted((brute.run_digests(d, t) for d, t in texts), key=key)
