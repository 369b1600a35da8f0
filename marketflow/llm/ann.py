"""Approximate nearest neighbours by largest inner product: robust-pruned directed graphs.

Rows are dealt into shards of a fixed size. Each shard's graph is built by inserting its
vectors in batches: a greedy search over the graph so far proposes neighbours, and relaxed
distance pruning keeps those that no kept neighbour already covers, so long edges survive.
Queries run a beam search over every shard, and the best of all shards are kept.

A largest inner product is a smallest distance once every vector gets one more component
that lifts all of them to the same length, so graphs are built on plain distances. Equal
vectors share a node of the graph.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketflow.llm.common import every_number, finite_vector, materialize, parts_for
from marketflow.llm.topk import MOST_PARTITIONS, matrix_of, widest

ROWS_PER_SHARD = 4096
QUERIES_PER_BLOCK = 2048
DEGREE = 32
BUILD_LIST = 64
SEARCH_LIST = 96
BEAM = 4
ALPHA = 1.2
BATCH = 256

INDEX = pa.schema(
    [("shard", pa.int64()), ("members", pa.binary()), ("vectors", pa.binary()), ("graph", pa.binary())]
    + [(n, pa.int64()) for n in ("nodes", "dimensions", "start")]
)
INDEX_DDL = (
    "shard long, members binary, vectors binary, graph binary, nodes long, dimensions long, start long"
)
FOUND = pa.schema(
    [("query_row", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())]
)


def distances(points: np.ndarray, squares: np.ndarray, of: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Squared distances between pairs of a point's number and a vector."""
    return squares[of] + np.einsum("ij,ij->i", to, to) - 2 * np.einsum("ij,ij->i", points[of], to)


def beam_search(
    points: np.ndarray, graph: np.ndarray, start: int, queries: np.ndarray, length: int, beam: int = BEAM
) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and squared distances of the ``length`` nearest points met, nearest first.

    All queries advance together; each step expands the ``beam`` nearest points of every
    query's list that are not expanded yet. Missing places have number -1 and distance inf.
    """
    n, n_queries, degree = len(points), len(queries), graph.shape[1]
    squares = np.einsum("ij,ij->i", points, points)
    found = np.full((n_queries, length), -1, dtype=np.int64)
    dist = np.full((n_queries, length), np.inf, dtype=np.float32)
    open_ = np.zeros((n_queries, length), dtype=bool)
    seen = np.zeros((n_queries, n + 1), dtype=bool)
    mark = np.zeros((n_queries, n + 1), dtype=np.int16)
    seen[:, n] = True
    found[:, 0], open_[:, 0], seen[:, start] = start, True, True
    dist[:, 0] = distances(points, squares, np.full(n_queries, start), queries)
    while True:
        rows = np.flatnonzero(open_.any(axis=1))
        if not len(rows):
            return found, dist
        waiting = np.where(open_[rows], dist[rows], np.inf)
        places = np.argsort(waiting, axis=1)[:, :beam]
        here = rows[:, None]
        usable = np.take_along_axis(waiting, places, axis=1) < np.inf
        nodes = np.where(usable, found[here, places], n)
        open_[here, places] = False
        near = np.concatenate([graph, np.full((1, degree), -1, dtype=graph.dtype)])[nodes].reshape(len(rows), -1)
        near = np.where(near < 0, n, near)
        number = np.arange(near.shape[1], dtype=np.int16)
        mark[here, near] = number  # of a point met twice in a step the last place stays
        fresh = ~seen[here, near] & (mark[here, near] == number)
        seen[here, near] = True
        r, c = np.nonzero(fresh)
        added = np.full(near.shape, np.inf, dtype=np.float32)
        added[r, c] = distances(points, squares, near[r, c], queries[rows[r]])
        all_dist = np.concatenate([dist[rows], added], axis=1)
        order = np.argsort(all_dist, axis=1, kind="stable")[:, :length]
        dist[rows] = np.take_along_axis(all_dist, order, axis=1)
        ids = np.concatenate([found[rows], np.where(fresh, near, -1)], axis=1)
        found[rows] = np.take_along_axis(ids, order, axis=1)
        opened = np.concatenate([open_[rows], fresh], axis=1)
        open_[rows] = np.take_along_axis(opened, order, axis=1)


def robust_prune(
    points: np.ndarray, of: np.ndarray, candidates: np.ndarray, dist: np.ndarray, degree: int, alpha: float
) -> np.ndarray:
    """At most ``degree`` diverse neighbours of each point ``of``, nearest first; -1 fills up.

    The nearest candidate left is kept, and every candidate that is ``alpha`` times nearer
    to it than to the point itself goes.
    """
    alive = np.isfinite(dist) & (candidates != of[:, None]) & (candidates >= 0)
    around = points[np.where(alive, candidates, 0)]
    squares = np.einsum("bcd,bcd->bc", around, around)
    out = np.full((len(of), degree), -1, dtype=np.int32)
    every = np.arange(len(of))
    for place in range(degree):
        left = np.where(alive, dist, np.inf)
        pick = left.argmin(axis=1)
        some = left[every, pick] < np.inf
        if not some.any():
            break
        out[some, place] = candidates[every, pick][some]
        chosen = around[every, pick]
        between = squares + squares[every, pick][:, None] - 2 * np.einsum("bcd,bd->bc", around, chosen)
        alive &= (alpha * alpha * between > dist) & some[:, None]
        alive[every, pick] = False
    return out


def build_graph(
    points: np.ndarray, degree: int = DEGREE, length: int = BUILD_LIST, alpha: float = ALPHA, batch: int = BATCH
) -> tuple[np.ndarray, int]:
    """Neighbours of every point and the point where searches start."""
    n = len(points)
    squares = np.einsum("ij,ij->i", points, points)
    start = int(((points - points.mean(axis=0)) ** 2).sum(axis=1).argmin())
    graph = np.full((n, degree), -1, dtype=np.int32)
    order = np.random.default_rng(7).permutation(n)
    order = order[order != start]
    done, size = 0, 1
    while done < len(order):
        new = order[done : done + size]
        found, dist = beam_search(points, graph, start, points[new], length)
        graph[new] = robust_prune(points, new, found, dist, degree, alpha)
        _add_back_edges(points, squares, graph, new, alpha)
        done += len(new)
        size = min(2 * size, batch)
    return graph, start


def _add_back_edges(points: np.ndarray, squares: np.ndarray, graph: np.ndarray, new: np.ndarray, alpha: float) -> None:
    degree = graph.shape[1]
    sources = np.repeat(new, degree)
    targets = graph[new].ravel()
    sources, targets = sources[targets >= 0], targets[targets >= 0]
    order = np.argsort(targets, kind="stable")
    sources, targets = sources[order], targets[order]
    nodes, first, counts = np.unique(targets, return_index=True, return_counts=True)
    if not len(nodes):
        return
    place = np.arange(len(targets)) - np.repeat(first, counts)
    # Nodes with many new edges get rows of their own width, so one of them widens no other.
    for width in sorted({1 << int(c - 1).bit_length() for c in counts}):
        chosen = np.flatnonzero((counts <= width) & (counts > width // 2))
        at = np.full(len(nodes), -1)
        at[chosen] = np.arange(len(chosen))
        row = np.repeat(at, counts)
        extra = np.full((len(chosen), width), -1, dtype=np.int32)
        extra[row[row >= 0], place[row >= 0]] = sources[row >= 0]
        of = nodes[chosen]
        both = np.concatenate([graph[of], extra], axis=1)
        filled = (both >= 0).sum(axis=1)
        packed = np.take_along_axis(both, np.argsort(both < 0, axis=1, kind="stable"), axis=1)
        fits = filled <= degree
        graph[of[fits]] = packed[fits, :degree] if packed.shape[1] >= degree else packed[fits]
        over = np.flatnonzero(~fits)
        for a in range(0, len(over), 512):
            some = over[a : a + 512]
            ids = packed[some, : filled[some].max()]
            safe = np.where(ids < 0, 0, ids)
            near = points[safe]
            dist = (
                squares[safe] + squares[of[some]][:, None] - 2 * np.einsum("bcd,bd->bc", near, points[of[some]])
            )
            dist = np.where(ids < 0, np.inf, dist)
            graph[of[some]] = robust_prune(points, of[some], ids, dist, degree, alpha)


def lifted(vectors: np.ndarray) -> np.ndarray:
    """Vectors scaled to a largest length of one, with a component that makes all as long."""
    scale = np.abs(vectors).max()
    vectors = vectors / scale
    squares = (vectors**2).sum(axis=1)
    longest = squares.max()
    tail = np.sqrt(np.maximum(longest - squares, 0))
    return (np.concatenate([vectors, tail[:, None]], axis=1) / np.sqrt(longest)).astype(np.float32)


def exact_scores(vectors: np.ndarray, nodes: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Inner products in double precision, added up from the first component to the last."""
    scores = np.zeros(nodes.shape)
    for j, column in enumerate(np.ascontiguousarray(vectors.T)):
        scores += queries[:, j][:, None] * column[nodes]
    return scores


def _build(settings: dict):
    def build(key, table):
        dimensions = widest(table["vector"])
        rows = matrix_of(table["vector"], dimensions) + 0.0
        ids, row = table["vec_id"].to_numpy(), table["row"].to_numpy()
        distinct, node = np.unique(rows, axis=0, return_inverse=True)
        node = node.ravel()
        order = np.lexsort((row, ids, node))
        members = np.stack([node[order], ids[order], row[order]]).astype(np.int64)
        graph, start = build_graph(lifted(distinct), **settings)
        values = [key[0], members.tobytes(), distinct.tobytes(), graph.tobytes(), len(distinct), dimensions, start]
        return pa.table([[v] for v in values], schema=INDEX)

    return build


def _search(k: int, length: int, degree: int):
    def search(_, table):
        queries = table.filter(table["is_query"])
        index = table.filter(pc.invert(table["is_query"])).to_pylist()
        if not index or not len(queries):
            return FOUND.empty_table()
        n, dimensions = index[0]["nodes"], index[0]["dimensions"]
        vectors = np.frombuffer(index[0]["vectors"]).reshape(n, dimensions)
        graph = np.frombuffer(index[0]["graph"], dtype=np.int32).reshape(n, degree)
        members = np.frombuffer(index[0]["members"], dtype=np.int64).reshape(3, -1)
        first = np.searchsorted(members[0], np.arange(n + 1))
        points = lifted(vectors)
        asked = matrix_of(queries["vector"], max(dimensions, widest(queries["vector"])))[:, :dimensions]
        ids, rows = queries["vec_id"].to_numpy(), queries["row"].to_numpy()
        sizes = np.sqrt((asked**2).sum(axis=1))
        toward = np.zeros((len(asked), points.shape[1]), dtype=np.float32)
        toward[:, :dimensions] = asked / np.where(sizes > 0, sizes, 1)[:, None]
        out = []
        for a in range(0, len(asked), 512):
            nodes, _ = beam_search(points, graph, index[0]["start"], toward[a : a + 512], length)
            scores = exact_scores(vectors, np.where(nodes < 0, 0, nodes), asked[a : a + 512])
            for q in range(len(nodes)):
                some = nodes[q] >= 0
                counts = np.minimum(first[nodes[q][some] + 1] - first[nodes[q][some]], k + 1)
                begin = np.repeat(first[nodes[q][some]], counts)
                take = begin + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
                score = np.repeat(scores[q][some], counts)
                other = members[2][take] != rows[a + q]
                take, score = take[other], score[other]
                best = np.lexsort((members[1][take], -score))[:k]
                size = len(best)
                out.append(
                    (np.full(size, rows[a + q]), np.full(size, ids[a + q]), members[1][take[best]], score[best])
                )
        return pa.table([np.concatenate(c) for c in zip(*out)], schema=FOUND)

    return search


def _usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    some = F.exists(vector_column, lambda x: x != 0)
    return vectors.filter(finite_vector(vector_column) & some & F.col(id_column).isNotNull())


def approximate_nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int,
    *,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    rows_per_shard: int = ROWS_PER_SHARD,
    queries_per_block: int = QUERIES_PER_BLOCK,
    search_list: int = SEARCH_LIST,
    degree: int = DEGREE,
    build_list: int = BUILD_LIST,
    alpha: float = ALPHA,
) -> DataFrame:
    """For every query row, ``k`` rows of (nearly) the largest inner product among all other rows.

    Every row is in the graph of one shard, and every query searches all shards with a list
    of ``search_list``, at least ``k + 1``. The score is the inner product of the vectors as
    they are, in double precision. Rows whose id is null, and vectors that are null, zero or
    hold null or non-finite components, take no part; a shorter vector ends in zeros. A
    query's own row is left out, other rows of the same id are not. Ties go to the smaller
    id. Other columns of the input are not looked at. An empty table gives no rows.

    Returns ``query_id, rank, vec_id, score``.
    """
    rows = _usable(vectors, id_column, vector_column).select(
        F.col(id_column).cast("long").alias("vec_id"),
        F.col(vector_column).cast("array<double>").alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("is_query"),
    ).withColumn("row", F.monotonically_increasing_id())
    # Written once: a row keeps its number as candidate and as query.
    rows = materialize(rows)
    n_rows, n_queries = rows.agg(
        F.count(F.lit(1)), F.coalesce(F.sum(F.col("is_query").cast("long")), F.lit(0))
    ).first()
    shards, query_blocks = parts_for(n_rows, rows_per_shard), parts_for(n_queries, queries_per_block)
    dealt = F.xxhash64("row")
    settings = {"degree": degree, "length": build_list, "alpha": alpha}
    index = materialize(
        rows.withColumn("shard", F.pmod(dealt, F.lit(shards)))
        .repartition(min(4 * shards, MOST_PARTITIONS), "shard")
        .groupBy("shard")
        .applyInArrow(_build(settings), INDEX_DDL)
    )
    asked = rows.filter("is_query").withColumn("query_block", F.pmod(dealt, F.lit(query_blocks)))
    both = index.select("*", every_number(query_blocks).alias("query_block"), F.lit(False).alias("is_query")).unionByName(
        asked.select("*", every_number(shards).alias("shard")), allowMissingColumns=True
    )
    found = (
        both.repartition(min(4 * shards * query_blocks, MOST_PARTITIONS), "shard", "query_block")
        .groupBy("shard", "query_block")
        .applyInArrow(
            _search(k, max(search_list, k + 1), degree), "query_row long, query_id long, vec_id long, score double"
        )
    )
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
