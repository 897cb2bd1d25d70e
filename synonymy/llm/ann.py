"""Nearest neighbours by inner product on robust-pruned graphs.

Vectors are dealt into shards of bounded size.  Each shard's distinct vectors form a
directed graph: greedy beam searches from the entry points propose neighbours,
relaxed distance pruning keeps diverse edges, reverse edges are pruned the same
way.  Largest inner product becomes least distance by one more coordinate,
sqrt(M^2 - |x|^2).  Queries go to every shard in blocks and run a beam search there;
found candidates are scored exactly in double precision on the original vectors.

All steps of a search run for a block of queries at once, as array operations.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut, drop, fetched, only, put, scratch, uri

DEGREE, ROOM, BEAM, QUERY_BEAM, RELAX = 24, 40, 64, 96, 1.2
SHARD_ROWS, QUERY_BLOCK, BATCH = 8192, 8192, 256
#: Shards that one task searches, where there are enough shards to keep all cores busy.
TASK_SHARDS = 16
ENTRIES = 24


def usable(df: DataFrame, vector: str = "embedding", id_: str = "vec_id") -> DataFrame:
    """vec_id and vector as array<double>, without vectors that are null, empty or zero or hold null or non-finite components."""
    v = F.col(f"`{vector}`").cast("array<double>")
    rows = only(df, id_, vector).select(F.col(f"`{id_}`").cast("long").alias("vec_id"), v.alias("v")).where("vec_id is not null and v is not null and size(v) > 0")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return rows.where(finite).where(F.exists("v", lambda x: x != 0.0))


class Graph:
    """A shard's graph over distinct vectors ``x`` (with the extra coordinate); ``ids`` are the rows of each, ascending."""

    def __init__(self, ids: np.ndarray, v: np.ndarray, norm: float):
        order = np.argsort(ids, kind="stable")
        ids, v = ids[order], v[order]
        distinct, inverse = np.unique(v, axis=0, return_inverse=True)
        inverse = inverse.ravel()
        by = np.argsort(inverse, kind="stable")
        self.first, self.ids, self.v = np.searchsorted(inverse[by], np.arange(len(distinct) + 1)), ids[by], distinct
        extra = np.sqrt(np.maximum(norm * norm - (distinct * distinct).sum(axis=1), 0.0))
        self.x = np.concatenate([distinct, extra[:, None]], axis=1).astype(np.float32)
        self.square = (self.x * self.x).sum(axis=1)
        self.edges = np.full((len(self.x), ROOM), -1, np.int32)
        self._entries()
        self._build()

    def _entries(self) -> None:
        """Entry points far from each other, the first nearest to the mean."""
        n = len(self.x)
        start = int(np.argmin(((self.x - self.x.mean(axis=0)) ** 2).sum(axis=1)))
        chosen, least = [start], np.full(n, np.inf, np.float32)
        for _ in range(min(ENTRIES, n) - 1):
            least = np.minimum(least, ((self.x - self.x[chosen[-1]]) ** 2).sum(axis=1))
            chosen.append(int(least.argmax()))
        self.entry = np.unique(chosen)

    def search(self, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Beam search of a block: ids (-1: none) and squared distances less |q|^2, nearest first."""
        m = len(q)
        near = np.full((m, beam), -1, np.int64)
        far = np.full((m, beam), np.inf, np.float32)
        done = np.zeros((m, beam), bool)
        seen = np.zeros((m, len(self.x)), bool)
        new = np.broadcast_to(self.entry, (m, len(self.entry))).astype(np.int64)
        live = np.arange(m)
        while len(live):
            ok = new >= 0
            ok &= ~seen[live[:, None], np.where(ok, new, 0)]
            r, c = np.nonzero(ok)
            seen[live[r], new[r, c]] = True
            d = np.full(new.shape, np.inf, np.float32)
            d[r, c] = self.square[new[r, c]] - 2 * np.einsum("ij,ij->i", self.x[new[r, c]], q[live[r]])
            ids = np.concatenate([near[live], np.where(ok, new, -1)], axis=1)
            dist = np.concatenate([far[live], d], axis=1)
            flag = np.concatenate([done[live], ~ok], axis=1)
            top = np.argsort(dist, axis=1, kind="stable")[:, :beam]
            near[live], far[live], done[live] = np.take_along_axis(ids, top, 1), np.take_along_axis(dist, top, 1), np.take_along_axis(flag, top, 1)
            todo = ~done[live] & (near[live] >= 0)
            some = todo.any(axis=1)
            live, todo = live[some], todo[some]
            pick = todo.argmax(axis=1)
            done[live, pick] = True
            new = self.edges[near[live, pick]].astype(np.int64)
        return near, far

    def _prune(self, p: np.ndarray, cand: np.ndarray) -> None:
        """Robust pruning: of each p's candidates keep the nearest, drop those that it is RELAX times nearer to than p is, and so on."""
        cand = np.sort(cand, axis=1)
        ok = (cand >= 0) & (cand != p[:, None])
        ok[:, 1:] &= cand[:, 1:] != cand[:, :-1]
        c = np.where(ok, cand, 0)
        x, square = self.x[c], self.square[c]
        d = np.where(ok, square + self.square[p][:, None] - 2 * np.matmul(x, self.x[p][:, :, None])[:, :, 0], np.inf)
        between = square[:, :, None] + square[:, None, :] - 2 * np.matmul(x, x.transpose(0, 2, 1))
        between *= RELAX * RELAX
        out = np.full((len(p), ROOM), -1, np.int32)
        rows = np.arange(len(p))
        for k in range(DEGREE):
            best = d.argmin(axis=1)
            has = np.isfinite(d[rows, best])
            if not has.any():
                break
            out[has, k] = c[rows, best][has]
            drop_ = between[rows, best] <= d
            drop_[rows, best] = True
            d[drop_ & has[:, None]] = np.inf
        self.edges[p] = out

    def _reverse(self, p: np.ndarray) -> None:
        """Edges back to p: appended where there is room, else pruned with the rest."""
        dst, src = self.edges[p].ravel().astype(np.int64), np.repeat(p, ROOM)
        src, dst = src[dst >= 0], dst[dst >= 0]
        known = (self.edges[dst] == src[:, None]).any(axis=1)
        src, dst = src[~known], dst[~known]
        by = np.argsort(dst, kind="stable")
        src, dst = src[by], dst[by]
        to, begin, count = np.unique(dst, return_index=True, return_counts=True)
        place = np.arange(len(dst)) - np.repeat(begin, count)
        have = (self.edges[to] >= 0).sum(axis=1)
        full = have + count > ROOM
        room = ~np.repeat(full, count)
        self.edges[dst[room], (np.repeat(have, count) + place)[room]] = src[room]
        over = np.flatnonzero(full)
        for b in range(0, len(over), BATCH):
            o = over[b : b + BATCH]
            more = np.full((len(o), int(count[o].max())), -1, np.int64)
            for i, j in enumerate(o):
                more[i, : count[j]] = src[begin[j] : begin[j] + count[j]]
            self._prune(to[o], np.concatenate([self.edges[to[o]].astype(np.int64), more], axis=1))

    def _build(self) -> None:
        n = len(self.x)
        if n <= 1:
            return
        rng = np.random.default_rng(5)
        for beam in (BEAM // 2, BEAM):
            order, at, size = rng.permutation(n), 0, 16
            while at < n:
                p = order[at : at + size]
                at, size = at + size, min(BATCH, size * 2)
                near, _ = self.search(self.x[p], beam)
                self._prune(p, np.concatenate([near, self.edges[p].astype(np.int64), np.broadcast_to(self.entry, (len(p), len(self.entry)))], axis=1))
                self._reverse(p)

    def nearest(self, q_ids: np.ndarray, q: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(query, vec_ids, scores) of at most k rows each, by score and then id, without the query's own row."""
        for b in range(0, len(q), BATCH):
            block = np.concatenate([q[b : b + BATCH], np.zeros((len(q[b : b + BATCH]), 1))], axis=1).astype(np.float32)
            near, _ = self.search(block, max(QUERY_BEAM, 2 * k))
            for i, row in enumerate(near):
                row = row[row >= 0]
                score = (self.v[row] * q[b + i]).sum(axis=1)
                # A vector's rows tie; the smallest k + 1 of each suffice for the first k without the query's own.
                parts = [self.ids[self.first[r] : min(self.first[r + 1], self.first[r] + k + 1)] for r in row]
                ids, s = np.concatenate(parts), np.repeat(score, [len(x) for x in parts])
                keep = ids != q_ids[b + i]
                ids, s = ids[keep], s[keep]
                top = np.lexsort((ids, -s))[:k]
                yield int(q_ids[b + i]), ids[top], s[top]


def _built(folder: str, norm: float):
    """Writes a shard's graphs, one for each length of vectors."""

    def run(key: tuple[Any, ...], pdf: pd.DataFrame) -> pd.DataFrame:
        parts = [Graph(g.vec_id.to_numpy(np.int64), np.array(g.v.tolist(), float), norm) for _, g in pdf.groupby(pdf.v.map(len), sort=True)]
        put(f"{folder}/graph-{key[0]}", [pickle.dumps(parts, protocol=5)])
        return pd.DataFrame({"shard": [key[0]]})

    return run


def _searched(folder: str, built: list[int], groups: int, k: int):
    """Each query's k best of the shards of its group."""

    def run(key: tuple[Any, ...], queries: pd.DataFrame) -> pd.DataFrame:
        size, found = queries.v.map(len), []
        for shard in built[key[0] :: groups]:
            for graph in pickle.loads(fetched(f"{folder}/graph-{shard}")):
                own = queries[size == graph.v.shape[1]]
                if len(own):
                    for q, ids, s in graph.nearest(own.query_id.to_numpy(np.int64), np.array(own.v.tolist(), float), k):
                        found.append((np.full(len(ids), q), ids, s))
        q, ids, s = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        order = np.lexsort((ids, -s, q))
        q, ids, s = q[order], ids[order], s[order]
        first = np.flatnonzero(np.r_[True, q[1:] != q[:-1]]) if len(q) else np.zeros(0, np.int64)
        best = np.arange(len(q)) - np.repeat(first, np.diff(np.append(first, len(q)))) < k
        return pd.DataFrame({"query_id": q[best], "vec_id": ids[best], "score": s[best]})

    return run


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k nearest rows found, by largest inner product.

    Both tables have vec_id and embedding.  Vectors that are null, empty, zero or not finite
    take no part, nor do rows of null vec_id; only vectors of a query's own length are its candidates.
    Rows of equal vectors tie and are listed by vec_id; a query's own row is left out; a
    repeated vec_id is one row (its first vector by value).  An empty table gives no rows.
    """
    spark, folder = vectors.sparkSession, scratch(vectors.sparkSession)
    one = lambda df: df.groupBy("vec_id").agg(F.min("v").alias("v"))
    rows = cut(one(usable(vectors)), folder, "vectors")
    size = rows.agg(F.count("*").alias("n"), F.sqrt(F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))).alias("norm")).first()
    shards = max(1, -(-size["n"] // shard_rows))
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))
    store = uri(f"{folder}/graphs")
    made = dealt.repartitionByRange(shards, "shard").groupBy("shard").applyInPandas(_built(store, float(size["norm"] or 0.0)), "shard int")
    built = sorted(r["shard"] for r in cut(made, folder, "built").collect())  # a number for each shard
    asked = one(usable(queries)).withColumnRenamed("vec_id", "query_id")
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    groups = max(1, -(-len(built) // TASK_SHARDS), min(len(built), -(-spark.sparkContext.defaultParallelism // blocks)))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int")).withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    found = asked.repartitionByRange(groups * blocks, "group", "block").groupBy("group", "block").applyInPandas(_searched(store, built, groups, k), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    out = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    out = cut(out, folder, "nearest")
    drop(spark, f"{folder}/graphs", f"{folder}/vectors", f"{folder}/built")
    return out


def op4_ann_search(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest(rows, rows.where("vec_id % 20 = 0"), k=20)
