from __future__ import annotations

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from marketflow.llm.queries import QUERIES
from marketflow.llm.whitening import eigen, whitening

DATA = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<double>, x string, whitened int, score double"


def with_values(values, seed: int = 1):
    """A symmetric matrix with given eigenvalues, and its eigenvectors, in extended precision."""
    n = len(values)
    basis = np.linalg.qr(np.random.default_rng(seed).normal(size=(n, n)))[0].astype(np.longdouble)
    for _ in range(3):
        basis = basis - basis @ ((basis.T @ basis - np.eye(n)) / 2)
    matrix = (basis * np.array(values, dtype=np.longdouble)) @ basis.T
    order = np.argsort(-np.array(values, dtype=float), kind="stable")
    return (matrix + matrix.T) / 2, basis[:, order], np.array(values, dtype=np.longdouble)[order]


@pytest.mark.parametrize(
    "values, accuracy",
    [
        (list(range(1, 65)), 1e-16),
        (list(10.0 ** np.linspace(-3, 3, 40)), 1e-11),
        ([1 + 1e-7 * i for i in range(8)] + list(range(2, 50)), 1e-10),
        ([5, 5 + 1e-10, 5 + 2e-10] + list(range(10, 60)), 1e-7),
        ([3.0], 1e-18),
    ],
)
def test_eigenvectors_are_right_to_what_the_gaps_allow(values, accuracy):
    matrix, basis, ordered = with_values(values)
    found, vectors = eigen(matrix)
    assert np.abs(found - ordered).max() <= 1e-17 * float(ordered[0])
    assert np.minimum(np.abs(vectors - basis), np.abs(vectors + basis)).max() < accuracy
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-17


@pytest.mark.parametrize("values", [[7.0] * 12, [5.0] * 6 + list(range(8, 30)), [0.0] * 5 + [1, 2, 3], [0.0] * 4])
def test_equal_eigenvalues_get_an_orthonormal_basis(values):
    matrix, _, ordered = with_values(values)
    found, vectors = eigen(matrix)
    assert np.abs(found - ordered).max() <= 1e-16
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-17
    assert np.abs(matrix @ vectors - vectors * found).max() < 1e-16


def plain(vectors: np.ndarray, components: int = 8):
    """Deviations, whitened rows and shares of the trace, by numpy's own solver."""
    x = np.floor(1024 * vectors.astype(np.float64)).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(axis=0)
    deviation = ((n * x - sums) ** 2).sum(axis=1)
    centred = (n * x - sums) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    return deviation, centred @ axes[:, :components] / np.sqrt(values[:components]), values[:components] / values.sum()


def test_query_matches_a_plain_version(spark):
    rows = QUERIES["op11_whitening"](spark, DATA).collect()
    table = pq.read_table(f"{DATA}/embeddings.parquet")
    ids = table["vec_id"].to_pylist()
    deviation, projected, explained = plain(np.array(table["embedding"].to_pylist()))
    assert len(rows) == 8 * len(ids)
    got = np.full(projected.shape, np.nan)
    for r in rows:
        got[ids.index(r["vec_id"]), r["component"] - 1] = r["whitened"]
        assert r["n"] == len(ids) and r["deviation"] == deviation[ids.index(r["vec_id"])]
        assert r["explained"] == pytest.approx(explained[r["component"] - 1], rel=1e-10)
        assert r["identity_error"] < 1e-9
    signs = np.sign((got * projected).sum(axis=0))
    assert np.abs(got * signs - projected).max() < 1e-8
    assert np.abs(got.T @ got / len(got) - np.eye(8)).max() < 1e-9


def frame(spark, vectors):
    rows = [(i, v, "x", 1, 0.5) for i, v in vectors]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def test_what_is_no_vector_takes_no_part_and_clashing_columns_do_not_matter(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, v.tolist()) for i, v in enumerate(np.random.default_rng(0).normal(size=(40, 3)))]
    bad = [(90, None), (91, [1.0, None, 2.0]), (92, [nan, 1.0, 1.0]), (93, [inf, 0.0, 0.0])]
    rows, fit, error = whitening(frame(spark, good + bad + good[:3] + [(None, [0.5, 0.1, 0.2])]))
    found = rows.collect()
    assert len(found) == fit.rows == 44 and error < 1e-12 and rows.columns == ["vec_id", "x", "whitened"]
    assert all(len(r["whitened"]) == 3 for r in found) and {r["vec_id"] for r in found} == {*range(40), None}
    assert sum(fit.explained()) == pytest.approx(1.0)


def test_sums_are_exact_for_wide_entries_and_short_vectors_are_filled(spark):
    vectors = [(i, v.tolist()) for i, v in enumerate(np.random.default_rng(3).normal(size=(60, 4)) * [1, 1e3, 1e6, 1e9])]
    vectors += [(100, [1.0, 2.0]), (101, [])]
    _, fit, error = whitening(frame(spark, vectors))
    x = np.array([[int(np.floor(1024 * c)) + 100_000 for c in [*v, 0, 0, 0, 0][:4]] for _, v in vectors], dtype=object)
    assert fit.sums == x.sum(axis=0).tolist() and error < 1e-9
    with pytest.raises(Exception, match="too large"):
        whitening(frame(spark, [(1, [1e300])]))


def test_equal_or_dependent_vectors_have_null_components(spark):
    rows, fit, error = whitening(frame(spark, [(i, [1.0, 2.0]) for i in range(5)]))
    assert all(r["whitened"] == [None, None] for r in rows.collect()) and error is None and fit.explained() == [None, None]
    rows, fit, error = whitening(frame(spark, [(i, [float(i), 2.0 * i]) for i in range(9)]))
    assert all(r["whitened"][0] is not None and r["whitened"][1] is None for r in rows.collect()) and error < 1e-12
    rows, fit, error = whitening(frame(spark, [(1, [1.0]), (2, [2.0])]))
    assert sorted(r["whitened"][0] for r in rows.collect()) == [-1.0, 1.0]


def test_empty_tables(spark, tmp_path):
    rows, fit, error = whitening(frame(spark, []))
    assert rows.collect() == [] and fit is None and error is None
    spark.createDataFrame([], "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    assert QUERIES["op11_whitening"](spark, str(tmp_path)).collect() == []
    assert whitening(frame(spark, [(1, []), (2, [])]))[0].select(F.size("whitened")).distinct().collect()[0][0] == 0
