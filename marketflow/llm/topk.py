"""Exact top-k search by inner product: columnar branch and bound.

Vectors lie dimension by dimension ("vertically"). A query adds up its scores one block of
dimensions at a time. After every block, what the remaining dimensions can still add is at
most the product of the remaining masses (Cauchy-Schwarz over the rest of both vectors);
candidates that cannot reach the k-th best score any more are compacted away, so later
blocks touch survivors only. The k-th best to beat comes from whole scores of the candidates
that lead after the first block. The bound never drops a candidate that could tie.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketflow.llm.common import every_number, finite_vector, materialize, parts_for

#: Whole numbers that doubles hold exactly stay below this.
EXACT = 2**53
#: Rows of a block on either side: a task holds one block of each.
CANDIDATES_PER_BLOCK = 4096
QUERIES_PER_BLOCK = 4096
DIMENSIONS_PER_STEP = 8
#: Pairs of blocks are dealt over at most so many tasks; more pairs follow one another in a task.
MOST_PARTITIONS = 20_000

FOUND = pa.schema(
    [("query_row", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())]
)


def matrix_of(column: pa.ChunkedArray, dimensions: int) -> np.ndarray:
    """List column to a matrix; shorter vectors end in zeros."""
    lists = column.combine_chunks()
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    values = lists.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lengths), dimensions))
    out[np.arange(dimensions) < lengths[:, None]] = values
    return out


def widest(column: pa.ChunkedArray) -> int:
    lengths = column.combine_chunks().value_lengths().to_numpy(zero_copy_only=False)
    return int(lengths.max()) if len(lengths) else 0


class VerticalBlock:
    """Candidates laid out by dimension, with the mass left after every step of dimensions."""

    def __init__(self, rows: np.ndarray, step: int = DIMENSIONS_PER_STEP):
        self.steps = [(a, min(a + step, rows.shape[1])) for a in range(0, rows.shape[1], step)] or [(0, 0)]
        self.columns = [np.ascontiguousarray(rows[:, a:b].T) for a, b in self.steps]
        self.rest = self.masses(rows)
        self.size = len(rows)

    def masses(self, rows: np.ndarray) -> list[np.ndarray]:
        squares = rows.astype(np.float64) ** 2
        return [np.sqrt(squares[:, b:].sum(axis=1)) for _, b in self.steps]


def search_block(
    queries: np.ndarray,
    query_rows: np.ndarray,
    block: VerticalBlock,
    ids: np.ndarray,
    rows: np.ndarray,
    k: int,
    rounded: np.ndarray | None = None,
) -> Iterable[tuple[int, np.ndarray, np.ndarray]]:
    """For each query its best ``k`` of a block: query number, candidate numbers, scores.

    ``rounded`` are the candidates by row, given where doubles may round a sum. A sum over n
    dimensions is then off by less than ``n * 2 ** -50`` times the product of both vectors'
    lengths: candidates are only dropped beyond that, and what is left is added up in whole
    numbers.
    """
    seeds = 4 * k
    left = block.masses(queries)
    first = queries[:, slice(*block.steps[0])] @ block.columns[0]
    everyone = np.arange(block.size)
    if rounded is not None:
        unit = rounded.shape[1] * 2.0**-50
        error = unit * np.sqrt((queries**2).sum(axis=1))[:, None] * np.sqrt((rounded**2).sum(axis=1))
    for q, query in enumerate(queries):
        alive = everyone[rows != query_rows[q]]
        sums = first[q][alive]
        floor = -np.inf
        if len(alive) > seeds:
            likely = alive[np.argpartition(sums, -seeds)[-seeds:]]
            whole = sum(query[a:b] @ block.columns[s][:, likely] for s, (a, b) in enumerate(block.steps))
            whole = whole if rounded is None else whole - error[q][likely]
            floor = np.partition(whole, -k)[-k]
        for s, (a, b) in enumerate(block.steps):
            if s:
                sums = sums + query[a:b] @ block.columns[s][:, alive]
            if s == len(block.steps) - 1 and rounded is None:
                break
            slack = left[s][q] * block.rest[s][alive] * (1 + 1e-9) + 1e-6
            if rounded is not None:
                slack = slack + error[q][alive]
            keep = sums + slack >= floor
            if not keep.all():
                alive, sums = alive[keep], sums[keep]
        if rounded is not None:
            sums = whole_sums(query, rounded[alive])
        best = np.lexsort((ids[alive], -sums))[:k] if rounded is None else sorted(
            range(len(alive)), key=lambda n: (-sums[n], ids[alive[n]])
        )[:k]
        yield q, alive[best], as_longs(sums[best])


def whole_sums(query: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Inner products in whole numbers of any size."""
    exact = [int(v) for v in query.tolist()]
    return np.array([sum(a * int(b) for a, b in zip(exact, c)) for c in candidates.tolist()] + [0], dtype=object)[:-1]


def as_longs(scores: np.ndarray) -> np.ndarray:
    if scores.dtype == object and any(abs(s) >= 2**63 for s in scores):
        raise ValueError("a score does not fit a long")
    return scores.astype(np.int64)


def _search(k: int, step: int):
    def search(_, table):
        query_side = table.filter(table["is_query"])
        candidate_side = table.filter(pc.invert(table["is_query"]))
        dimensions = max(widest(query_side["vector"]), widest(candidate_side["vector"]), 1)
        queries = matrix_of(query_side["vector"], dimensions)
        candidates = matrix_of(candidate_side["vector"], dimensions)
        if len(queries) == 0 or len(candidates) == 0:
            return FOUND.empty_table()
        # Doubles hold all sums exactly below 2**53; beyond, they only bound them.
        with np.errstate(over="ignore"):
            most = float(np.abs(queries).max()) * float(np.abs(candidates).max()) * dimensions
        exact = most < EXACT
        if not exact and most > 1e300:
            raise ValueError("components are too large: scores would not fit a long")
        ids, rows = (candidate_side[c].to_numpy() for c in ("vec_id", "row"))
        query_ids, query_rows = (query_side[c].to_numpy() for c in ("vec_id", "row"))
        block = VerticalBlock(candidates, step)
        out = [
            (np.full(len(best), query_rows[q]), np.full(len(best), query_ids[q]), ids[best], scores)
            for q, best, scores in search_block(queries, query_rows, block, ids, rows, k, None if exact else candidates)
        ]
        return pa.table([np.concatenate(c) for c in zip(*out)], schema=FOUND)

    return search


def exact_top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int,
    *,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    scale: float = 256.0,
    step: int = DIMENSIONS_PER_STEP,
    candidates_per_block: int = CANDIDATES_PER_BLOCK,
    queries_per_block: int = QUERIES_PER_BLOCK,
) -> DataFrame:
    """The ``k`` rows with the largest inner product for every query row, among all other rows.

    Components x count as ``floor(scale * x)``, whatever their size; a score that is returned and
    does not fit a long is an error. Rows whose id is null, and vectors that are null or hold
    null or non-finite components, take no part; a shorter vector ends in zeros, an empty one
    scores 0. A query's own row is left out, other rows of the same id are not. Ties go to the smaller id. Other columns of the input, whatever
    their names, are not looked at. An empty table gives no rows.

    Queries and candidates are dealt into blocks of a fixed size, and every pair of blocks
    is one group: work is spread however many rows or queries there are, a hot id or vector
    makes no block larger, and each pair of blocks passes on ``k`` rows a query.

    Returns ``query_id, rank, vec_id, score``.
    """
    def quantised(x: Column) -> Column:
        scaled = x.cast("double") * scale
        # Doubles from 2**53 on are whole numbers, and may not fit the long that floor gives.
        return F.when(F.abs(scaled) < EXACT, F.floor(scaled).cast("double")).otherwise(scaled)

    rows = vectors.filter(finite_vector(vector_column) & F.col(id_column).isNotNull()).select(
        F.col(id_column).cast("long").alias("vec_id"),
        F.transform(vector_column, quantised).alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("is_query"),
        F.monotonically_increasing_id().alias("row"),
    )
    # Written once: a row keeps its number as candidate and as query.
    rows = materialize(rows)
    n_rows, n_queries = rows.agg(
        F.count(F.lit(1)), F.coalesce(F.sum(F.col("is_query").cast("long")), F.lit(0))
    ).first()
    blocks, query_blocks = parts_for(n_rows, candidates_per_block), parts_for(n_queries, queries_per_block)
    dealt = F.xxhash64("row")
    candidate_side = rows.withColumn("is_query", F.lit(False)).select(
        "*",
        F.pmod(dealt, F.lit(blocks)).alias("block"),
        every_number(query_blocks).alias("query_block"),
    )
    query_side = rows.filter("is_query").select(
        "*",
        every_number(blocks).alias("block"),
        F.pmod(dealt, F.lit(query_blocks)).alias("query_block"),
    )
    found = (
        candidate_side.unionByName(query_side)
        .repartition(min(4 * blocks * query_blocks, MOST_PARTITIONS), "block", "query_block")
        .groupBy("block", "query_block")
        .applyInArrow(_search(k, step), "query_row long, query_id long, vec_id long, score long")
    )
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
