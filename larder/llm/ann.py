"""Approximate nearest neighbours by inner product, on robust-pruned directed graphs.

Vectors are dealt into shards by a hash.  Each shard is a directed graph: every
node's neighbours are proposed by greedy searches from a fixed start, and kept
only if no kept neighbour is much closer to them than the node is, which leaves
short and long edges.  A query walks each shard's graph with a beam.

One more coordinate makes all vectors equally long, so the nearest by distance
is the largest by inner product.  Equal vectors are one node.
"""

from __future__ import annotations

import io
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.common import map_columns
from larder.session import scratch_path

DEGREE = 32
BUILD_BEAM = 64
BEAM = 160
SLACK = 1.15  # an edge goes if a kept neighbour is closer to its end by this factor
WIDTH = 4  # nodes of the beam expanded at once
SHARD_ROWS = 10_000
QUERY_ROWS = 4_096
LOT = 512  # nodes or queries that walk together


def _distances(space: np.ndarray, norms: np.ndarray, points: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Squared distances, less the points' own norm, to the nodes in each row of ``ids``."""
    return norms[ids] - 2 * np.einsum("qd,qrd->qr", points, space[ids])


def walk(space: np.ndarray, norms: np.ndarray, edges: np.ndarray, start: int, points: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Beam search of many points together: ids and distances of the ``beam`` best nodes met, best first.

    The last row of ``space`` and of ``edges`` stands for "no node".
    """
    n, q = len(space) - 1, len(points)
    beam = min(beam, n)
    seen = np.zeros((q, n + 1), bool)
    ids = np.full((q, beam), n, np.int64)
    dist = np.full((q, beam), np.inf, np.float32)
    done = np.ones((q, beam), bool)
    ids[:, 0], done[:, 0] = start, False
    dist[:, 0] = _distances(space, norms, points, ids[:, :1])[:, 0]
    seen[:, start] = True
    active = np.arange(q)
    while len(active):
        # The best nodes not yet expanded; the beam is kept in order.
        rank = np.cumsum(~done[active], axis=1)
        pick = (~done[active]) & (rank <= WIDTH)
        alive = pick.any(axis=1)
        active, pick = active[alive], pick[alive]
        if not len(active):
            break
        at = np.argsort(~pick, axis=1, kind="stable")[:, :WIDTH]
        chosen = np.take_along_axis(pick, at, 1)
        nodes = np.where(chosen, np.take_along_axis(ids[active], at, 1), n)
        done[active] |= pick
        found = edges[nodes].reshape(len(active), -1)
        found.sort(axis=1)
        fresh = ~seen[active[:, None], found]
        fresh[:, 1:] &= found[:, 1:] != found[:, :-1]
        fresh &= found < n
        most = int(fresh.sum(axis=1).max(initial=0))
        if not most:
            continue
        order = np.argsort(~fresh, axis=1, kind="stable")[:, :most]
        found = np.where(np.take_along_axis(fresh, order, 1), np.take_along_axis(found, order, 1), n)
        seen[active[:, None], found] = True
        near = _distances(space, norms, points[active], found).astype(np.float32)
        near[found == n] = np.inf
        all_ids = np.concatenate([ids[active], found], axis=1)
        all_dist = np.concatenate([dist[active], near], axis=1)
        all_done = np.concatenate([done[active], found == n], axis=1)
        best = np.argsort(all_dist, axis=1, kind="stable")[:, :beam]
        ids[active], dist[active], done[active] = (np.take_along_axis(x, best, 1) for x in (all_ids, all_dist, all_done))
    return ids, dist


def prune(space: np.ndarray, nodes: np.ndarray, candidates: np.ndarray, degree: int, slack: float) -> np.ndarray:
    """Robust pruning of many nodes together; ``candidates`` holds len(space) where empty."""
    n = len(space) - 1
    candidates = np.where(candidates == nodes[:, None], n, candidates)
    candidates.sort(axis=1)
    candidates[:, 1:][candidates[:, 1:] == candidates[:, :-1]] = n
    own = ((space[candidates] - space[nodes][:, None]) ** 2).sum(-1)
    own[candidates == n] = np.inf
    order = np.argsort(own, axis=1, kind="stable")
    candidates, own = (np.take_along_axis(x, order, 1) for x in (candidates, own))
    points = space[candidates]
    squares = (points**2).sum(-1)
    out = np.full((len(nodes), degree), n, np.int64)
    rows = np.arange(len(nodes))
    left = np.isfinite(own)
    for k in range(degree):
        some = left.any(axis=1)
        if not some.any():
            break
        best = np.argmax(left, axis=1)
        out[some, k] = candidates[rows[some], best[some]]
        p = points[rows, best]
        between = squares + (p**2).sum(-1)[:, None] - 2 * np.einsum("qd,qcd->qc", p, points)
        left &= slack * slack * between > own
        left[rows, best] = False
    return out


def build(vectors: np.ndarray, seed: int = 1) -> tuple[np.ndarray, int]:
    """The neighbours of every node (the number of nodes marks no neighbour) and the start node."""
    n = len(vectors)
    rng = np.random.default_rng(seed)
    space = np.vstack([vectors, np.zeros((1, vectors.shape[1]), np.float32)]).astype(np.float32)
    norms = (space**2).sum(1)
    start = int(np.argmin(((vectors - vectors.mean(0)) ** 2).sum(1)))
    degree = min(DEGREE, max(1, n - 1))
    edges = np.full((n + 1, degree), n, np.int64)
    if n > 1:
        edges[:n] = rng.integers(0, n, (n, degree))
    for slack in (SLACK,):
        order = rng.permutation(n)
        for at in range(0, n, LOT):
            nodes = order[at : at + LOT]
            met, _ = walk(space, norms, edges, start, space[nodes], BUILD_BEAM)
            edges[nodes] = prune(space, nodes, np.concatenate([met, edges[nodes]], axis=1), degree, slack)
            _add_back(space, edges, nodes, degree, slack)
    return edges.astype(np.int32), start


def _add_back(space: np.ndarray, edges: np.ndarray, nodes: np.ndarray, degree: int, slack: float) -> None:
    """Edges back from the new neighbours; nodes that get too many are pruned anew."""
    n = len(space) - 1
    source = np.repeat(nodes, degree)
    target = edges[nodes].reshape(-1)
    source, target = source[target < n], target[target < n]
    if not len(target):
        return
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    ends, first, count = np.unique(target, return_index=True, return_counts=True)
    for at in range(0, len(ends), LOT):
        some, c = ends[at : at + LOT], count[at : at + LOT]
        new = np.full((len(some), int(c.max())), n, np.int64)
        for row, (f, m) in enumerate(zip(first[at : at + LOT], c)):
            new[row, :m] = source[f : f + m]
        edges[some] = prune(space, some, np.concatenate([edges[some], new], axis=1), degree, slack)


def _dump(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def _valid(vectors: DataFrame, key: str, column: str) -> DataFrame:
    """Usable vectors as bytes, with their length."""

    def run(batch) -> dict:
        ids, data = [], []
        for k, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if k is None or v is None or any(x is None for x in v):
                continue
            a = np.array(v, np.float64)
            if len(a) and np.isfinite(a).all() and a.any():
                ids.append(k)
                data.append(a)
        return {"vec_id": ids, "vec": [a.tobytes() for a in data], "norm": [float(a @ a) for a in data]}

    return map_columns(vectors.select(F.col(key).cast("long").alias("k"), F.col(column).alias("v")), run, "vec_id long, vec binary, norm double")


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 20, key: str = "vec_id", column: str = "embedding",
    beam: int = BEAM, shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query its ``k`` nearest among all other rows that were found.

    ``score`` is the inner product in double precision.  Ties go to the smaller
    id.  Vectors that are null, zero or hold null or non-finite parts, rows
    without an id, and vectors of another length than the query's take no part.
    Repeated ids are one row if their vectors are equal.  The index is stored
    shard by shard; queries meet it in blocks of ``query_rows``.
    """
    spark = vectors.sparkSession

    def store(df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, f"ann-{name}")
        df.write.parquet(path)
        return spark.read.parquet(path)

    rows = store(_valid(vectors, key, column), "rows")
    # Of equal vectors only the smallest ids can be among the nearest, one more than asked
    # for because a query does not find itself.  Spark limits each group before the exchange.
    ranked = Window.partitionBy("vec").orderBy("vec_id")
    members = (
        rows.withColumn("place", F.dense_rank().over(ranked)).where(F.col("place") <= k + 1)
        .groupBy("vec").agg(F.first("norm").alias("norm"), F.sort_array(F.collect_set("vec_id")).alias("ids"))
    )
    nodes = store(members.withColumn("dim", F.octet_length("vec")), "nodes")
    size = nodes.groupBy("dim").agg(F.count("*").alias("n"), F.max("norm").alias("top")).collect()  # one row per vector length
    shards = {r["dim"]: max(1, math.ceil(r["n"] / shard_rows)) for r in size}
    tops = {r["dim"]: r["top"] for r in size}
    if not size:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    per_dim = F.create_map(*[F.lit(x) for pair in shards.items() for x in pair])
    dealt = nodes.withColumn("shard", F.pmod(F.xxhash64("vec"), per_dim[F.col("dim")]))

    def index(group: pa.Table) -> pa.Table:
        dim = group.column("dim")[0].as_py()
        data = np.frombuffer(b"".join(group.column("vec").to_pylist()), np.float64).reshape(group.num_rows, dim // 8)
        extra = np.sqrt(np.maximum(tops[dim] - (data**2).sum(1), 0))
        edges, start = build(np.hstack([data, extra[:, None]]).astype(np.float32))
        ids = group.column("ids").to_pylist()
        blob = _dump(data=data, extra=extra, edges=edges, start=np.array(start), ids=np.array([x for i in ids for x in i]), counts=np.array([len(i) for i in ids]))
        return pa.table({"dim": pa.array([dim], pa.int32()), "shard": pa.array([group.column("shard")[0].as_py()], pa.int64()), "graph": pa.array([blob], pa.binary())})

    graphs = store(dealt.repartition(max(1, sum(shards.values())), "dim", "shard").groupBy("dim", "shard").applyInArrow(index, "dim int, shard long, graph binary"), "graphs")

    asked = _valid(queries, key, column).withColumn("dim", F.octet_length("vec"))
    blocks = max(1, math.ceil(asked.count() / query_rows))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)))

    def pack(group: pa.Table) -> pa.Table:
        ids = np.array(group.column("vec_id").to_pylist(), np.int64)
        blob = _dump(ids=ids, data=np.frombuffer(b"".join(group.column("vec").to_pylist()), np.float64).reshape(len(ids), -1))
        return pa.table({"dim": group.column("dim").slice(0, 1).cast(pa.int32()), "block": group.column("block").slice(0, 1), "asked": pa.array([blob], pa.binary())})

    packed = asked.groupBy("dim", "block").applyInArrow(pack, "dim int, block long, asked binary")
    meet = graphs.join(packed, "dim").repartition(max(1, blocks * sum(shards.values())), "shard", "block")

    def search(batches):
        for batch in batches:
            for graph, queries in zip(batch.column("graph").to_pylist(), batch.column("asked").to_pylist()):
                yield _search(np.load(io.BytesIO(graph)), np.load(io.BytesIO(queries)), k, beam)

    found = meet.select("shard", "graph", "asked").mapInArrow(search, "query_id long, vec_id long, score double").distinct()
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")


def _search(graph, asked, k: int, beam: int) -> pa.RecordBatch:
    """The best rows of one shard for one block of queries."""
    data, edges, ids, counts = graph["data"], graph["edges"], graph["ids"], graph["counts"]
    space = np.hstack([data, graph["extra"][:, None]]).astype(np.float32)
    space = np.vstack([space, np.zeros((1, space.shape[1]), np.float32)])
    norms = (space**2).sum(1)
    first = np.concatenate([[0], np.cumsum(counts)])
    points, own = np.unique(asked["data"], axis=0, return_inverse=True)
    own = own.reshape(-1)
    flat = np.hstack([points, np.zeros((len(points), 1))]).astype(np.float32)
    keep = min(k + 1, len(data))
    near = np.empty((len(points), keep), np.int64)
    for at in range(0, len(points), LOT):
        met, _ = walk(space, norms, edges.astype(np.int64), int(graph["start"]), flat[at : at + LOT], beam)
        near[at : at + LOT] = met[:, :keep]
    out: tuple[list, list, list] = ([], [], [])
    for query_id, p in zip(asked["ids"].tolist(), own.tolist()):
        nodes = near[p][near[p] < len(data)]
        scores = data[nodes] @ points[p]
        rows = [(-s, i) for s, n in zip(scores.tolist(), nodes.tolist()) for i in ids[first[n] : first[n + 1]].tolist() if i != query_id]
        for s, i in sorted(rows)[:k]:
            out[0].append(query_id)
            out[1].append(i)
            out[2].append(-s)
    return pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())], names=["query_id", "vec_id", "score"])
