"""Approximate nearest neighbours: a robust-pruned directed graph per shard, searched by beams."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written

#: Rows of a shard, queries of a block, edges of a node, beam widths, and how much pruning is relaxed.
SHARD_ROWS, BLOCK_QUERIES, EDGES, BUILD_BEAM, SEARCH_BEAM, RELAXED = 12_288, 4_096, 40, 72, 160, 1.2
#: Largest ratio of two lengths in a shard: the component that makes lengths equal stays small beside them.
BAND = 1.1
#: Nodes that a query opens in one step.
OPENED = 4

_INDEX = "shard int, node int, ids array<bigint>, vector array<double>, edges array<int>"


def _lifted(vectors: np.ndarray) -> np.ndarray:
    """With one more component that makes all norms equal: then the nearest by distance has the largest product."""
    norms = np.einsum("ij,ij->i", vectors, vectors)
    return np.column_stack([vectors, np.sqrt(np.maximum(norms.max(initial=0) - norms, 0))]).astype(np.float32)


def beam_search(points: np.ndarray, edges: np.ndarray, queries: np.ndarray, start: int, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """The nodes found nearest to each query and their squared distances, nearest first; -1 fills up.

    All queries take each step together: the nearest nodes not yet opened are
    opened, and what their edges lead to competes for the beam.
    """
    count, n = len(queries), len(points)
    ids = np.full((count, beam), -1, np.int64)
    far = np.full((count, beam), np.inf, np.float32)
    ids[:, 0], far[:, 0] = start, ((queries - points[start]) ** 2).sum(axis=1)
    opened = np.ones((count, beam), bool)
    opened[:, 0] = False
    seen = np.zeros((count, n + 1), bool)
    seen[:, start] = True
    length = (points ** 2).sum(axis=1)
    active = np.arange(count)
    while len(active):
        todo = ~opened[active]
        pick = np.argsort(~todo, axis=1, kind="stable")[:, :OPENED]
        real = np.take_along_axis(todo, pick, axis=1)
        some = real.any(axis=1)
        active, pick, real = active[some], pick[some], real[some]
        if not len(active):
            break
        opened[active[:, None], pick] = True
        nodes = np.where(real, ids[active[:, None], pick], 0)
        around = np.where(real[:, :, None], edges[nodes], -1).reshape(len(active), -1)
        around[seen[active[:, None], around]] = -1  # place n holds what -1 points to
        around = np.sort(around, axis=1)
        around[:, 1:][around[:, 1:] == around[:, :-1]] = -1
        seen[active[:, None], around] = True
        seen[:, n] = False
        near = length[around] - 2 * np.matmul(points[around], queries[active][:, :, None])[:, :, 0]
        near = np.where(around < 0, np.inf, near + (queries[active] ** 2).sum(axis=1)[:, None])
        all_ids = np.concatenate([ids[active], around], axis=1)
        all_far = np.concatenate([far[active], near.astype(np.float32)], axis=1)
        all_open = np.concatenate([opened[active], around < 0], axis=1)
        best = np.argpartition(all_far, beam - 1, axis=1)[:, :beam]
        best = np.take_along_axis(best, np.argsort(np.take_along_axis(all_far, best, axis=1), axis=1, kind="stable"), axis=1)
        ids[active], far[active], opened[active] = (np.take_along_axis(x, best, axis=1) for x in (all_ids, all_far, all_open))
    return ids, far


def robust_prune(points: np.ndarray, nodes: np.ndarray, found: np.ndarray, edges: int, relaxed: float) -> np.ndarray:
    """Up to ``edges`` diverse neighbours of each node from its candidates (-1: none).

    The nearest candidate is kept, and every candidate whose distance to it,
    times ``relaxed``, is no more than to the node goes; and so on.
    """
    found = np.where(found == nodes[:, None], -1, found)
    vectors = points[found]
    away = ((vectors - points[nodes][:, None, :]) ** 2).sum(axis=2)
    away[found < 0] = np.inf
    order = np.argsort(away, axis=1, kind="stable")
    found, away = np.take_along_axis(found, order, axis=1), np.take_along_axis(away, order, axis=1)
    vectors = points[found]
    length = (vectors ** 2).sum(axis=2)
    between = length[:, :, None] + length[:, None, :] - 2 * np.matmul(vectors, vectors.transpose(0, 2, 1))
    alive, rows = np.isfinite(away), np.arange(len(nodes))
    out = np.full((len(nodes), edges), -1, np.int64)
    for k in range(edges):
        first = alive.argmax(axis=1)
        some = alive[rows, first]
        if not some.any():
            break
        out[some, k] = found[rows[some], first[some]]
        alive &= relaxed * relaxed * between[rows, first] > away
        alive[rows, first] = False
    return out


def build_graph(points: np.ndarray, edges: int = EDGES, beam: int = BUILD_BEAM, relaxed: float = RELAXED, seed: int = 9) -> tuple[np.ndarray, int]:
    """(edges of every node, -1 fills up; the node to start from).

    Nodes join in random order, in batches that grow with the graph. A greedy
    search from the start proposes each one's neighbours, pruning keeps diverse
    ones, and each gets an edge back, pruned again where there are too many. A
    second round, over the whole graph, mends what early nodes missed.
    """
    n = len(points)
    graph = np.full((n, edges), -1, np.int64)
    start = int(((points - points.mean(axis=0)) ** 2).sum(axis=1).argmin()) if n else 0
    order = np.random.Generator(np.random.PCG64(seed)).permutation(n)
    order = np.concatenate([[start], order[order != start]]) if n else order
    for round_ in (1, 2):
        done = 1
        while done < n:
            batch = order[done : done + (min(1024, max(8, done // 4)) if round_ == 1 else 1024)]
            if round_ == 1 and done <= 64:
                found = np.tile(order[: done + len(batch)], (len(batch), 1))
            else:
                found, _ = beam_search(points, graph, points[batch], start, beam)
            found = np.concatenate([found, graph[batch]], axis=1)
            found = np.sort(found, axis=1)
            found[:, 1:][found[:, 1:] == found[:, :-1]] = -1
            graph[batch] = robust_prune(points, batch, found, edges, relaxed)
            _edges_back(points, graph, batch, edges, relaxed)
            done += len(batch)
    return graph, start


def _edges_back(points: np.ndarray, graph: np.ndarray, batch: np.ndarray, edges: int, relaxed: float) -> None:
    source, target = np.repeat(batch, edges), graph[batch].ravel()
    source, target = source[target >= 0], target[target >= 0]
    there = (graph[target] == source[:, None]).any(axis=1)
    source, target = source[~there], target[~there]
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    nodes, first, count = np.unique(target, return_index=True, return_counts=True)
    rank = np.arange(len(target)) - np.repeat(first, count)
    for a in range(0, len(nodes), 1024):
        own = slice(a, a + 1024)
        width = int(count[own].max())
        inside = (target >= nodes[own][0]) & (target <= nodes[own][-1])
        more = np.full((len(nodes[own]), width), -1, np.int64)
        more[np.searchsorted(nodes[own], target[inside]), rank[inside]] = source[inside]
        both = np.concatenate([graph[nodes[own]], more], axis=1)
        fits = (both >= 0).sum(axis=1) <= edges
        if fits.any():
            graph[nodes[own][fits]] = -np.sort(-both[fits], axis=1)[:, :edges]
        for b in range(0, int((~fits).sum()), 256):
            at = np.flatnonzero(~fits)[b : b + 256]
            graph[nodes[own][at]] = robust_prune(points, nodes[own][at], both[at], edges, relaxed)


def _index_shard(k: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("vec_id")
        vectors = np.array(frame["vector"].tolist(), np.float64)
        distinct, node = np.unique(vectors, axis=0, return_inverse=True)
        node = node.ravel()
        order = np.argsort(node, kind="stable")
        ids = frame["vec_id"].to_numpy()[order]
        starts = np.searchsorted(node[order], np.arange(len(distinct) + 1))
        graph, start = build_graph(_lifted(distinct))
        # The start comes first. Of equal vectors only the smallest k + 1 ids can be among a query's k nearest.
        swap = np.arange(len(distinct))
        swap[[0, start]] = swap[[start, 0]]
        graph = np.where(graph >= 0, swap[graph], -1)[swap]
        return pd.DataFrame({
            "shard": np.int32(frame["shard"].iloc[0]), "node": np.arange(len(distinct), dtype=np.int32),
            "ids": [ids[starts[i] : starts[i + 1]][: k + 1] for i in swap.tolist()],
            "vector": list(distinct[swap]), "edges": [g[g >= 0].astype(np.int32) for g in graph],
        })

    return run


def _search_shard(k: int, beam: int):
    def run(index: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if index.empty or asked.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        index = index.sort_values("node")
        vectors = np.array(index["vector"].tolist(), np.float64)
        graph = np.full((len(index), max(1, index["edges"].map(len).max())), -1, np.int64)
        for i, own in enumerate(index["edges"]):
            graph[i, : len(own)] = own
        points = _lifted(vectors)
        sizes = index["ids"].map(len).to_numpy()
        ids, first = np.concatenate(index["ids"].tolist()), np.cumsum(sizes) - sizes
        out = []
        for a in range(0, len(asked), 512):
            qid = asked["query_id"].to_numpy()[a : a + 512]
            query = np.array(asked["vector"].iloc[a : a + 512].tolist(), np.float64)
            lifted = np.column_stack([query, np.zeros(len(query))]).astype(np.float32)
            found, _ = beam_search(points, graph, lifted, 0, max(beam, k + 1))
            who, at = np.nonzero(found >= 0)
            node = found[who, at]
            score = np.einsum("ij,ij->i", query[who], vectors[node])
            n = sizes[node]
            inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            hit = ids[np.repeat(first[node], n) + inner]
            who, score = np.repeat(who, n), np.repeat(score, n)
            keep = hit != qid[who]
            who, hit, score = who[keep], hit[keep], score[keep]
            order = np.lexsort((hit, -score, who))
            who, hit, score = who[order], hit[order], score[order]
            top = np.arange(len(who)) - np.searchsorted(who, who) < k
            out.append(pd.DataFrame({"query_id": qid[who[top]], "vec_id": hit[top], "score": score[top]}))
        return pd.concat(out, ignore_index=True)

    return run


def sound(vector: Column, size: Column) -> Column:
    """Vectors that take part: of the given size, not zero, all components there and finite."""
    parts = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce((F.size(vector) == size) & parts & F.exists(vector, lambda x: x != 0), F.lit(False))


def nearest(rows: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vector_col: str = "embedding",
            shard_rows: int = SHARD_ROWS, beam: int = SEARCH_BEAM) -> DataFrame:
    """The k nearest rows found for every query by inner product: query_id, rank, vec_id, score.

    Every row is indexed. Shards have a bounded number of rows of similar length
    (within a tenth), dealt by a hash of the id; each is a graph of its distinct vectors, written once, and
    queries come to it in blocks, so neither side is gathered. Scores are exact,
    in double precision; ties go to the smaller id; a query's own id is no
    candidate. Null, zero and non-finite vectors, null ids, and vectors of
    another size than most have take no part. Ids are taken to be unique; rows
    that repeat an id with the same vector count once. Fewer rows than k give fewer.
    """
    spark = rows.sparkSession

    def taken(df: DataFrame, name: str) -> DataFrame:
        return df.select(df[id_col].cast("bigint").alias(name), df[vector_col].cast("array<double>").alias("vector")).where(F.col(name).isNotNull())

    sizes = taken(rows, "vec_id").groupBy(F.size("vector").alias("size")).count().where("size > 0")
    size = sizes.agg(F.max_by("size", F.struct("count", "size"))).first()[0] or 0
    every = taken(rows, "vec_id").where(sound(F.col("vector"), F.lit(size))).dropDuplicates()
    asked = taken(queries, "query_id").where(sound(F.col("vector"), F.lit(size))).dropDuplicates()
    blocks = max(1, -(-asked.count() // BLOCK_QUERIES))
    # Shards of similar length. Bands are few (all doubles make 15 000), and so are their counts.
    largest = F.array_max(F.transform("vector", F.abs))
    log = F.log(largest) + F.log(F.aggregate("vector", F.lit(0.0), lambda s, x: s + (x / F.col("largest")) * (x / F.col("largest")))) / 2
    every = every.withColumn("largest", largest).withColumn("band", F.floor(log / float(np.log(BAND)) + 0.5).cast("int")).drop("largest")
    bands = every.groupBy("band").count().orderBy("band").collect()
    sizes = [max(1, -(-n // shard_rows)) for _, n in bands]
    firsts = np.concatenate([[0], np.cumsum(sizes)]).astype(int).tolist()
    table = spark.createDataFrame([(b, f, n) for (b, _), f, n in zip(bands, firsts, sizes)], "band int, first int, parts int")
    own = F.col("first") + F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int")
    every = every.join(F.broadcast(table), "band").select("vec_id", "vector", own.alias("shard"))
    shards = max(1, firsts[-1])
    index = written(every.groupBy("shard").applyInPandas(_index_shard(k), _INDEX), "graph")
    index = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int"))
    asked = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    near = index.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInPandas(
        _search_shard(k, beam), "query_id bigint, vec_id bigint, score double")
    # Every task sends on k rows for each query, whatever the number of shards.
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
