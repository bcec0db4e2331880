"""Approximate nearest neighbours by cosine: a robust-pruned directed graph per shard, searched with a beam."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from traitloom.llm.common import ref, written

#: Vectors of a shard, about, and queries of a block: together one task's work.
SHARD_ROWS, BLOCK_ROWS = 4096, 1024
#: Edges kept per node, room before a node is pruned again, beam while building and searching, relaxation of the pruning.
DEGREE, ROOM, BUILD_BEAM, SEARCH_BEAM, ALPHA = 28, 42, 48, 64, 1.2
NONE = -1


def beam_search(x: np.ndarray, graph: np.ndarray, start: int, queries: np.ndarray, beam: int):
    """Greedy search from ``start`` for all queries at once: always the nearest unopened node of a query's beam is opened.

    Returns the beam (node, distance; nearest first) and the opened nodes with their distances. Distances are squared, between unit vectors.
    """
    n = len(queries)
    nodes = np.full((n, beam), NONE, dtype=np.int32)
    dist = np.full((n, beam), np.inf, dtype=np.float32)
    opened = np.ones((n, beam), dtype=bool)
    nodes[:, 0], dist[:, 0], opened[:, 0] = start, 2 - 2 * (queries @ x[start]), False
    path_nodes, path_dist = [], []
    active = np.arange(n)
    while len(active):
        waiting = np.where(opened[active], np.inf, dist[active])
        best = waiting.argmin(axis=1)
        more = np.isfinite(waiting[np.arange(len(active)), best])
        active, best = active[more], best[more]
        if not len(active):
            break
        opened[active, best] = True
        step_nodes, step_dist = np.full(n, NONE, dtype=np.int32), np.full(n, np.inf, dtype=np.float32)
        step_nodes[active], step_dist[active] = nodes[active, best], dist[active, best]
        path_nodes.append(step_nodes)
        path_dist.append(step_dist)
        near = graph[nodes[active, best]]
        d = 2 - 2 * np.einsum("qrd,qd->qr", x[near], queries[active])
        known = (near[:, :, None] == nodes[active][:, None, :]).any(axis=2)
        d[known | (near == NONE)] = np.inf
        all_nodes = np.concatenate([nodes[active], near], axis=1)
        all_dist = np.concatenate([dist[active], d], axis=1)
        all_open = np.concatenate([opened[active], np.zeros_like(near, dtype=bool)], axis=1)
        order = np.argsort(all_dist, axis=1, kind="stable")[:, :beam]
        nodes[active] = np.take_along_axis(all_nodes, order, axis=1)
        dist[active] = np.take_along_axis(all_dist, order, axis=1)
        opened[active] = np.take_along_axis(all_open, order, axis=1) | ~np.isfinite(dist[active])
    return nodes, dist, np.stack(path_nodes, axis=1), np.stack(path_dist, axis=1)


def robust_prune(x: np.ndarray, points: np.ndarray, candidates: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """For every point the nearest candidate, then the nearest one that is not much closer to a chosen one, and so on."""
    n, width = candidates.shape
    vectors = x[candidates]
    d = 2 - 2 * np.einsum("ncd,nd->nc", vectors, x[points])
    d[(candidates == NONE) | (candidates == points[:, None])] = np.inf
    order = np.argsort(candidates, axis=1, kind="stable")  # a candidate that is listed twice counts once
    ordered = np.take_along_axis(candidates, order, axis=1)
    twice = np.zeros_like(ordered, dtype=bool)
    twice[:, 1:] = ordered[:, 1:] == ordered[:, :-1]
    again = np.zeros_like(twice)
    np.put_along_axis(again, order, twice, axis=1)
    d[again] = np.inf
    between = 2 - 2 * np.matmul(vectors, vectors.transpose(0, 2, 1))
    chosen = np.full((n, degree), NONE, dtype=np.int32)
    rows = np.arange(n)
    for k in range(degree):
        best = d.argmin(axis=1)
        alive = np.isfinite(d[rows, best])
        if not alive.any():
            break
        chosen[alive, k] = candidates[rows[alive], best[alive]]
        covered = alpha * between[rows, best] <= d
        d[covered & alive[:, None]] = np.inf
        d[rows, best] = np.inf
    return chosen


def build_graph(x: np.ndarray, seed: int = 11) -> tuple[np.ndarray, int]:
    """Neighbour table and entry point. Points join in batches that double: each searches the graph so far, keeps diverse
    edges to what it met, and is offered to them in return."""
    n = len(x)
    center = x.mean(axis=0)
    start = int(np.argmax(x @ center))
    graph = np.full((n, ROOM), NONE, dtype=np.int32)
    order = np.random.default_rng(seed).permutation(n)
    order = order[order != start]
    at, size = 0, 1
    while at < len(order):
        batch = order[at : at + size]
        at, size = at + size, min(2 * size, 256)
        nodes, _, path, _ = beam_search(x, graph, start, x[batch], BUILD_BEAM)
        candidates = np.concatenate([nodes, path], axis=1)
        out = robust_prune(x, batch, candidates, DEGREE, ALPHA)
        graph[batch, :DEGREE] = out
        source, k = np.nonzero(out != NONE)
        target, origin = out[source, k], batch[source]
        by = np.argsort(target, kind="stable")
        target, origin = target[by], origin[by]
        touched, first, count = np.unique(target, return_index=True, return_counts=True)
        for lo in range(0, len(touched), 512):
            t, f, c = touched[lo : lo + 512], first[lo : lo + 512], count[lo : lo + 512]
            offered = np.full((len(t), int(c.max())), NONE, dtype=np.int32)
            rows = np.repeat(np.arange(len(t)), c)
            offered[rows, np.arange(len(rows)) - np.repeat(np.cumsum(c) - c, c)] = origin[f[0] : f[-1] + c[-1]]
            have = graph[t]
            used = (have != NONE).sum(axis=1)
            fits = used + c <= ROOM
            for i in np.flatnonzero(fits):
                graph[t[i], used[i] : used[i] + c[i]] = offered[i, : c[i]]
            full = np.flatnonzero(~fits)
            if len(full):
                both = np.concatenate([have[full], offered[full]], axis=1)
                graph[t[full]] = NONE
                graph[t[full], :DEGREE] = robust_prune(x, t[full], both, DEGREE, ALPHA)
    return graph, start


def _matrix(column: pa.ChunkedArray, dimension: int) -> np.ndarray:
    flat = pa.concat_arrays([c.flatten() for c in column.chunks]).to_numpy() if column.num_chunks else np.zeros(0)
    return flat.reshape(-1, dimension).astype(np.float64)


def _unit(v: np.ndarray) -> np.ndarray:
    # Scaled by the largest component first, so that very large and very small vectors keep their direction.
    scaled = v / np.abs(v).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def usable(vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``id, v, dim`` of the rows that take part: an id, and a vector that is not null, empty or zero, of finite numbers."""
    v = ref(vector).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    good = F.coalesce(finite & F.exists(v, lambda x: x != 0), F.lit(False))
    return vectors.filter(ref(id_column).isNotNull() & good).select(
        ref(id_column).cast("long").alias("id"), v.alias("v"), F.size(v).alias("dim")
    )


INDEX = "dim int, shard int, ids binary, first binary, points binary, vectors binary, graph binary, start int"


def build_index(points: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per shard: distinct vectors, their graph, and the ids of each in ascending order. Every row is in one shard.

    Shards are dealt by a hash of the id, so copies of one vector spread; within a shard they are one node of the graph.
    """
    shards = max(1, -(-points.count() // shard_rows))
    dealt = points.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int"))

    def run(key, table):
        dimension = key[0].as_py()
        ids, vectors = table["id"].to_numpy(), _matrix(table["v"], dimension)
        order = np.argsort(ids, kind="stable")
        ids, vectors = ids[order], vectors[order]
        distinct, node = np.unique(vectors, axis=0, return_inverse=True)
        node = node.reshape(-1)
        by = np.argsort(node, kind="stable")
        first = np.concatenate([[0], np.cumsum(np.bincount(node, minlength=len(distinct)))]).astype(np.int64)
        points = _unit(distinct).astype(np.float32)
        graph, start = build_graph(points)
        return pa.table(
            {
                "dim": pa.array([dimension], pa.int32()),
                "shard": pa.array([key[1].as_py()], pa.int32()),
                "ids": pa.array([ids[by].tobytes()], pa.binary()),
                "first": pa.array([first.tobytes()], pa.binary()),
                "points": pa.array([points.tobytes()], pa.binary()),
                "vectors": pa.array([distinct.tobytes()], pa.binary()),
                "graph": pa.array([graph.tobytes()], pa.binary()),
                "start": pa.array([start], pa.int32()),
            }
        )

    return dealt.groupBy("dim", "shard").applyInArrow(run, INDEX)


def search_shard(index: dict, query_ids: np.ndarray, queries: np.ndarray, k: int, beam: int):
    """Up to ``k`` rows per query from one shard: query, id, cosine of the original vectors in double precision."""
    dimension = queries.shape[1]
    vectors = np.frombuffer(index["vectors"], np.float64).reshape(-1, dimension)
    x = np.frombuffer(index["points"], np.float32).reshape(-1, dimension)
    graph = np.frombuffer(index["graph"], np.int32).reshape(len(x), -1)
    ids, first = np.frombuffer(index["ids"], np.int64), np.frombuffer(index["first"], np.int64)
    unit = _unit(queries)
    if len(x) <= beam:
        nodes = np.tile(np.arange(len(x), dtype=np.int32), (len(queries), 1))
    else:
        nodes, _, _, _ = beam_search(x, graph, index["start"], unit.astype(np.float32), beam)
    exact = _unit(vectors)
    out = []
    for q, (query, row) in enumerate(zip(query_ids, nodes)):
        row = row[row != NONE]
        scores = exact[row] @ unit[q]
        order = np.argsort(-scores, kind="stable")
        found = []
        for at in order:
            if len(found) >= k and scores[at] < found[k - 1][0]:
                break
            copies = ids[first[row[at]] : first[row[at] + 1]]
            found += [(float(scores[at]), int(i)) for i in copies[copies != query][:k]]
            found.sort(key=lambda r: (-r[0], r[1]))
        out += [(int(query), i, score) for score, i in found[:k]]
    return out


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    id_column: str = "vec_id",
    vector: str = "embedding",
    shard_rows: int = SHARD_ROWS,
    beam: int = SEARCH_BEAM,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest rows found for each query, nearest first, ties to smaller ids.

    Every row is indexed. Each block of queries searches the graph of each shard, and the best of all shards are kept. Rows with the
    query's own id are no candidates. Vectors that are null, empty, zero or hold a null or non-finite number take no part, nor
    do rows without an id; vectors of another length than the query's are never near it. An id that occurs more than once is
    that many candidates, and as a query it is the smallest of its vectors. Other columns are not carried.
    """
    index = written(build_index(usable(vectors, id_column, vector), shard_rows), "graph")
    asked = usable(queries, id_column, vector).groupBy("id").agg(F.min("v").alias("v")).withColumn("dim", F.size("v"))
    blocks = max(1, -(-asked.count() // BLOCK_ROWS))
    shards = index.select(F.col("dim").alias("of_dim"), F.col("shard").alias("of_shard")).distinct()
    block = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    asked = asked.join(shards, F.col("dim") == F.col("of_dim")).select(
        "id", "v", "dim", F.col("of_shard").alias("shard"), block.alias("block")
    )
    offered = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    schema = "query_id long, vec_id long, score double"

    def run(left, right):
        rows = []
        if left.num_rows and right.num_rows:
            shard = {name: right[name][0].as_py() for name in ("ids", "first", "points", "vectors", "graph", "start")}
            rows = search_shard(shard, left["id"].to_numpy(), _matrix(left["v"], left["dim"][0].as_py()), k, beam)
        query_ids, ids, scores = zip(*rows) if rows else ((), (), ())
        return pa.table(
            {"query_id": pa.array(query_ids, pa.int64()), "vec_id": pa.array(ids, pa.int64()), "score": pa.array(scores, pa.float64())}
        )

    keys = ["dim", "shard", "block"]
    found = asked.groupBy(*keys).cogroup(offered.groupBy(*keys)).applyInArrow(run, schema)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
