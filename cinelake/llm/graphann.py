"""Approximate nearest neighbours by a robust-pruned directed graph.

Equal vectors form one class, so copies can't fill a neighbourhood; a class carries its
smallest ids, which are all that a result can name.  Classes are dealt into shards of about
``shard`` vectors.  In a shard, inner product becomes Euclidean distance by one more
coordinate, points are inserted in batches: a greedy beam search from the entry point
proposes neighbours, robust pruning keeps a candidate only if no kept neighbour is ``alpha``
times nearer to it, and reverse edges are pruned alike.  Every shard is beam-searched for every
query, blocks of queries against shards, and the found vectors are rescored in double
precision before the shards' lists merge.

Defined cases: rows with a null id, and vectors that are null, empty, zero, hold nulls or
non-finite numbers, or differ in length from the commonest, take no part.  Repeated ids are
rows of their own; a query's own id is left out.  An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cinelake.session import materialize


@dataclass(frozen=True)
class Params:
    shard: int = 8192
    block: int = 8192  # queries searched at once
    degree: int = 32
    beam: int = 64  # while building
    search_beam: int = 128
    alpha: float = 1.2
    seed: int = 3


def _distances(points, rows, query):
    """Squared distances from each query (B, d) to its rows (B, C)."""
    got = points[rows]
    return (got * got).sum(axis=2) - 2 * np.einsum("bcd,bd->bc", got, query)


def beam_search(points, graph, entry: int, queries, beam: int, width: int = 4):
    """The ``beam`` best points found for each query by greedy search: (ids, distances up to
    a constant), best first; -1 where fewer were reached."""
    n, b = len(points), len(queries)
    seen = np.zeros((b, n + 1), bool)
    seen[:, n] = True  # the missing neighbour
    ids = np.full((b, beam), n)
    dist = np.full((b, beam), np.inf, np.float32)
    done = np.ones((b, beam), bool)
    ids[:, 0], done[:, 0], seen[:, entry] = entry, False, True
    dist[:, 0] = _distances(points, ids[:, :1], queries)[:, 0]
    live = np.arange(b)
    while len(live):
        order = np.argsort(np.where(done[live], np.inf, dist[live]), axis=1, kind="stable")[:, :width]
        picked = np.take_along_axis(np.where(done[live], n, ids[live]), order, axis=1)
        np.put_along_axis(sub := done[live], order, True, axis=1)
        done[live] = sub
        near = graph[picked].reshape(len(live), -1)
        near = np.where(seen[live[:, None], near], n, near)
        near.sort(axis=1)
        near[:, 1:][near[:, 1:] == near[:, :-1]] = n
        seen[live[:, None], near] = True
        d = _distances(points, np.minimum(near, n - 1), queries[live]).astype(np.float32)
        d[near == n] = np.inf
        both = np.concatenate([dist[live], d], axis=1)
        keep = np.argsort(both, axis=1, kind="stable")[:, :beam]
        dist[live] = np.take_along_axis(both, keep, axis=1)
        ids[live] = np.take_along_axis(np.concatenate([ids[live], near], axis=1), keep, axis=1)
        fresh = np.concatenate([done[live], near == n], axis=1)
        done[live] = np.take_along_axis(fresh, keep, axis=1)
        live = live[~done[live].all(axis=1)]
    return np.where(np.isfinite(dist), ids, -1), dist


def robust_prune(points, own, cand, degree: int, alpha: float):
    """Diverse neighbours of each point of ``own`` among its candidates (B, C; -1 for none):
    nearest first, dropping those that a kept one covers.  (B, degree), len(points) for none."""
    n = len(points)
    cand = np.sort(np.where((cand < 0) | (cand == own[:, None]), n, cand), axis=1)
    cand[:, 1:][cand[:, 1:] == cand[:, :-1]] = n
    real = cand < n
    got = points[np.minimum(cand, n - 1)]
    d = ((got - points[own][:, None]) ** 2).sum(axis=2)
    d[~real] = np.inf
    alive = real.copy()
    out = np.full((len(own), degree), n)
    lines = np.arange(len(own))
    a2 = alpha * alpha
    for k in range(degree):
        pick = np.where(alive, d, np.inf).argmin(axis=1)
        ok = alive[lines, pick]
        if not ok.any():
            break
        out[ok, k] = cand[lines, pick][ok]
        between = ((got - got[lines, pick][:, None]) ** 2).sum(axis=2)
        alive &= ~((a2 * between <= d) & ok[:, None])
        alive[lines, pick] = False
    return out


def build(points: np.ndarray, p: Params) -> tuple[np.ndarray, int]:
    """Neighbour lists (n + 1 rows; the last stands for a missing neighbour) and the entry."""
    n = len(points)
    rng = np.random.default_rng(p.seed)
    graph = np.full((n + 1, p.degree), n)
    entry = int(((points - points.mean(axis=0)) ** 2).sum(axis=1).argmin())
    order = rng.permutation(n)
    order = np.concatenate([[entry], order[order != entry]])
    at = 1
    while at < n:
        batch = order[at : at + min(512, max(1, at))]  # batches no larger than what is in
        found, _ = beam_search(points, graph, entry, points[batch], p.beam)
        pool = np.concatenate([found, np.repeat(batch[None], len(batch), axis=0)], axis=1) if len(batch) <= 64 else found
        graph[batch] = robust_prune(points, batch, pool, p.degree, p.alpha)
        src = np.repeat(batch, p.degree)
        dst = graph[batch].reshape(-1)
        src, dst = src[dst < n], dst[dst < n]
        by = np.argsort(dst, kind="stable")
        src, dst = src[by], dst[by]
        target, first, count = np.unique(dst, return_index=True, return_counts=True)
        back = np.full((len(target), min(int(count.max()), 4 * p.degree)), -1)
        place = np.arange(len(dst)) - np.repeat(first, count)
        ok = place < back.shape[1]
        back[np.repeat(np.arange(len(target)), count)[ok], place[ok]] = src[ok]
        old = graph[target]
        pool = np.concatenate([np.where(old < n, old, -1), back], axis=1)
        for i in range(0, len(target), 512):
            graph[target[i : i + 512]] = robust_prune(points, target[i : i + 512], pool[i : i + 512], p.degree, p.alpha)
        at += len(batch)
    return graph, entry


def as_euclidean(vectors: np.ndarray) -> np.ndarray:
    """Vectors with one more coordinate, so that the nearest point to (q, 0) is the one of
    largest inner product with q."""
    v = vectors.astype(np.float32)
    sq = (v.astype(np.float64) ** 2).sum(axis=1)
    return np.concatenate([v, np.sqrt(np.maximum(0, sq.max() - sq))[:, None].astype(np.float32)], axis=1)


def classes(rows: DataFrame, keep: int) -> DataFrame:
    """(cid, vector, ids): one row per different vector of full rows, with its smallest
    ``keep`` ids; cid is the smallest."""
    good = rows.filter("vec_id is not null and embedding is not null").select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = good.filter(finite & F.exists("vector", lambda x: x != 0))
    w = Window.partitionBy("vector").orderBy("vec_id")
    few = good.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= keep)
    found = few.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    return found.select(F.col("ids")[0].alias("cid"), "vector", "ids")


def _build_group(p: Params):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("cid", ignore_index=True)
        graph, entry = build(as_euclidean(np.stack(pdf["vector"].to_numpy())), p)
        pdf["near"] = [g[g < len(pdf)].tolist() for g in graph[:-1]]
        pdf["place"] = np.arange(len(pdf))
        pdf["entry"] = entry
        return pdf[["shard", "place", "entry", "cid", "vector", "ids", "near"]]

    return run


def _search_group(p: Params, k: int):
    def run(index: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if index.empty or queries.empty:
            return pd.DataFrame({"qid": [], "vec_id": [], "score": []})
        index = index.sort_values("place", ignore_index=True)
        vectors = np.stack(index["vector"].to_numpy())
        q = np.stack(queries["vector"].to_numpy())
        n = len(index)
        graph = np.full((n + 1, p.degree), n)
        for i, near in enumerate(index["near"]):
            graph[i, : len(near)] = near
        points = as_euclidean(vectors)
        ids, cids = index["ids"].to_numpy(), index["cid"].to_numpy()
        out = []
        for at in range(0, len(q), 512):
            part = q[at : at + 512]
            asked = np.concatenate([part.astype(np.float32), np.zeros((len(part), 1), np.float32)], axis=1)
            found, _ = beam_search(points, graph, int(index["entry"][0]), asked, max(p.search_beam, k + 1))
            score = np.einsum("bcd,bd->bc", vectors[found], part)
            score[found < 0] = -np.inf
            order = np.lexsort((cids[found], -score))[:, : k + 1]
            for i, qid in enumerate(queries["cid"].to_numpy()[at : at + 512]):
                rows = [(float(score[i, c]), int(v)) for c in order[i] if found[i, c] >= 0 for v in ids[found[i, c]]]
                rows.sort(key=lambda r: (-r[0], r[1]))
                out += [(qid, v, s) for s, v in rows[: k + 1]]
        return pd.DataFrame(out, columns=["qid", "vec_id", "score"])

    return run


def build_index(rows: DataFrame, k: int, p: Params = Params()) -> DataFrame:
    """The shards' graphs as a table in the shared folder: shard, place, entry, cid, vector,
    ids (the smallest ``k`` + 1) and near."""
    found = materialize(classes(rows, k + 1), "ann-classes")
    sizes = found.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").first()
    dim, n = (sizes["d"], sizes["count"]) if sizes else (0, 0)
    shards = max(1, -(-n // p.shard))
    dealt = found.filter(F.size("vector") == dim).withColumn("shard", F.pmod(F.xxhash64("cid"), F.lit(shards)).cast("int"))
    schema = "shard int, place int, entry int, cid long, vector array<double>, ids array<long>, near array<int>"
    return materialize(dealt.groupBy("shard").applyInPandas(_build_group(p), schema), "ann-graph")


def search(index: DataFrame, queries: DataFrame, k: int, p: Params = Params()) -> DataFrame:
    """(qid, vec_id, score): the ``k`` + 1 best rows found for each query (cid, vector)."""
    shards = index.agg(F.max("shard")).first()[0]
    blocks = max(1, -(-queries.count() // p.block))
    asked = queries.withColumn("block", F.pmod(F.xxhash64("cid"), F.lit(blocks)).cast("int")).withColumn(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(shards or 0)))
    )
    offered = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    found = offered.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInPandas(
        _search_group(p, k), "qid long, vec_id long, score double"
    )
    best = Window.partitionBy("qid").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= k + 1).drop("r")


def nearest(rows: DataFrame, every: int = 20, k: int = 20, p: Params = Params()) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of each query, the rows whose
    vec_id is divisible by ``every``; see the contract of op7."""
    index = build_index(rows, k, p)
    asked = rows.filter(F.pmod(F.col("vec_id"), F.lit(every)) == 0).select(F.col("vec_id").cast("long").alias("query_id"), F.col("embedding").cast("array<double>").alias("vector"))
    asked = materialize(asked.join(index.select("vector", "cid"), "vector").select("query_id", "cid"), "ann-queries")
    queries = materialize(index.select("cid", "vector").join(asked.select("cid").distinct(), "cid", "left_semi"), "ann-queries")
    found = search(index, queries, k, p)
    pairs = asked.join(found, asked["cid"] == found["qid"]).filter("query_id <> vec_id").select("query_id", "vec_id", "score")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = pairs.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
