from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from marketflow.llm.ann import approximate_nearest
from marketflow.llm.topk import exact_top_k

SCHEMA = "vec_id long, embedding array<float>, score double, block string"


def vectors(n: int, d: int = 12, seed: int = 3) -> list[tuple[int, list[float]]]:
    found = np.random.default_rng(seed).normal(size=(n, d)).astype(np.float32)
    found[n // 2 :: 5] = found[1]  # a common vector: ties
    return [(i, v.tolist()) for i, v in enumerate(found)]


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0.5, "x") for i, v in rows], SCHEMA).repartition(3)


def found(frame) -> dict:
    out: dict = {}
    for r in sorted(frame.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return out


@pytest.mark.parametrize("blocks", [(4096, 4096), (50, 3)])
def test_top_k_is_exact_with_ties_over_any_blocks(spark, blocks):
    rows = vectors(230)
    got = found(
        exact_top_k(
            table(spark, rows), F.col("vec_id") % 10 == 0, 5, candidates_per_block=blocks[0], queries_per_block=blocks[1]
        )
    )
    assert got == brute.nearest(rows, {i for i, _ in rows if i % 10 == 0}, 5, 256.0)


def test_top_k_leaves_out_what_is_no_vector_and_returns_all_if_fewer(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [nan, 1.0]), (4, [inf, 0.0]), (5, [-1.0]), (6, []), (None, [1.0, 1.0])]
    got = found(exact_top_k(table(spark, rows), F.col("vec_id") == 0, 5))
    assert got == {0: [(6, 0), (5, -256 * 256)]}


def test_top_k_keeps_other_rows_of_an_id_and_huge_components(spark):
    got = found(exact_top_k(table(spark, [(0, [1.0]), (0, [2.0]), (1, [1e8]), (2, [3e5])]), F.col("vec_id") == 0, 5))
    near = [(2, 76_800_000 * 256), (2, 76_800_000 * 512)]
    assert sorted(got[0]) == [(0, 2**17), (0, 2**17), (1, 2**16 * 10**8), (1, 2**17 * 10**8), *near]
    got = found(exact_top_k(table(spark, [(0, [1.0]), (1, [3e5]), (2, [6e5])]), F.col("vec_id") == 0, 5))
    assert got == {0: [(2, 39_321_600_000), (1, 19_660_800_000)]}
    with pytest.raises(Exception, match="does not fit a long"):
        exact_top_k(table(spark, [(0, [1.0]), (1, [1e30])]), F.col("vec_id") == 0, 5).collect()
    # Its score is none of the best.
    assert found(exact_top_k(table(spark, [(0, [1.0]), (1, [-1e30]), (2, [2.0])]), F.col("vec_id") == 0, 1)) == {0: [(2, 2**17)]}


@pytest.mark.parametrize("size, wide", [(1e4, 3), (1e7, 3), (1e8, 1)])
def test_top_k_is_exact_where_doubles_round(spark, size, wide):
    rng = np.random.default_rng(int(size))
    base = rng.integers(-size, size, (1, 16))
    # Neighbours of one vector: scores that differ in the last places only.
    rows = [(i, (base[0] + rng.integers(-2, 3, 16) * (rng.random(16) < 0.2 * wide)).astype(float).tolist()) for i in range(300)]
    double = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = found(exact_top_k(double, F.col("vec_id") % 50 == 0, 5, scale=1.0, candidates_per_block=90, queries_per_block=4))
    whole = {i: [int(c) for c in v] for i, v in rows}
    for q in range(0, 300, 50):
        scores = [(i, sum(a * b for a, b in zip(whole[q], v))) for i, v in whole.items() if i != q]
        want = sorted(scores, key=lambda s: (-s[1], s[0]))[:5]
        if abs(want[0][1]) < 2**63:
            assert got[q] == want


def test_top_k_of_nothing(spark):
    assert exact_top_k(table(spark, []), F.col("vec_id") == 0, 5).collect() == []


@pytest.mark.parametrize("shard", [4096, 120])
def test_graph_search_finds_nine_in_ten(spark, shard):
    rows = vectors(700, 16)
    queries = {i for i, _ in rows if i % 20 == 0}
    got = found(approximate_nearest(table(spark, rows), F.col("vec_id") % 20 == 0, 20, rows_per_shard=shard, queries_per_block=9))
    want = brute.nearest(rows, queries, 20)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in queries)
    assert hits >= 0.9 * 20 * len(queries)
    by_id = dict(rows)
    for q in queries:
        assert len(got[q]) == 20 and q not in {i for i, _ in got[q]}
        assert got[q] == sorted(got[q], key=lambda s: (-s[1], s[0]))
        for i, score in got[q]:
            assert score == pytest.approx(float(np.dot(np.array(by_id[q]), np.array(by_id[i]))), abs=1e-9)


def test_graph_search_leaves_out_what_is_no_vector(spark):
    rows = [(0, [1.0, 2.0]), (1, None), (2, [0.0, 0.0]), (3, [float("nan"), 1.0]), (5, [-1.0]), (6, []), (7, [1.0, 2.0]), (8, [1.0, 2.0])]
    got = found(approximate_nearest(table(spark, rows), F.col("vec_id") == 0, 20))
    assert got == {0: [(7, 5.0), (8, 5.0), (5, -1.0)]}
    assert approximate_nearest(table(spark, []), F.col("vec_id") == 0, 20).collect() == []
