"""Approximate nearest neighbours by a hash-prefix forest.

Every tree gives a vector a long hash string (the signs of its random projections). The index is cut
into blocks of rows; a block keeps its distinct vectors in one sorted array of strings per tree. A
query descends to its longest matching prefix in every tree (binary search) and then ascends in all
trees at once, one bit at a time, until the matched ranges of all trees together hold at least
``effort`` times the block's vectors (a vector counts in every tree) and the union of the ranges at least
``8 k`` different vectors, or all there are; the union is
scored exactly. Ascending stops at a depth that differs from
query to query. Blocks report their best and the best of all blocks stay.

Nearness is the inner product in double precision of the vectors as given. Strings are made from
the vectors after an extra coordinate lifts them to one common norm, so large inner products have
small angles whatever the norms. On data without any clusters high recall needs a high effort: the
defaults were set by measuring recall against brute force (see the README).

Defined results: vectors that are NULL, empty, zero, of another length than most, or hold NULL or
non-finite components take no part; ties go to the smaller vec_id; repeated vectors are scored once
per block and all their rows count; rows with a NULL vec_id take no part; repeated vec_ids are
candidates each, except for the query of the same id.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage, ship

BITS = 32
TREES = 48
EFFORT = 1.0
BLOCK_ROWS = 16_384
QUERY_ROWS = 4_096


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, v`` (doubles) of the rows that take part."""
    v = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)
        & F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
        & F.exists("v", lambda x: x != 0))
    common = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1)
    return rows.join(F.broadcast(common.select("d")), F.size("v") == F.col("d"), "left_semi")


def _projections(dim: int, trees: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((dim + 1, trees * BITS))


def _strings(x: np.ndarray, top: float, planes: np.ndarray, query: bool, trees: int) -> np.ndarray:
    """Hash strings (rows x trees) of vectors lifted to the norm ``top`` (queries have no lift)."""
    lift = np.zeros(len(x)) if query else np.sqrt(np.maximum(top * top - (x * x).sum(1), 0))
    bits = np.concatenate([x, lift[:, None]], 1) @ planes > 0
    return (bits.reshape(len(x), trees, BITS) @ (1 << np.arange(BITS - 1, -1, -1, dtype=np.uint64))).astype(np.uint64)


class Forest:
    """Sorted hash strings of one block's distinct vectors."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, top: float, trees: int, seed: int):
        order = np.lexsort((ids, *x.T))
        same = np.zeros(len(order), bool)
        same[1:] = (x[order][1:] == x[order][:-1]).all(1)
        self.begin = np.append(np.flatnonzero(~same), len(order))
        self.ids, self.x = ids[order], x[order][self.begin[:-1]]
        self.trees = trees
        self.planes = _projections(x.shape[1], trees, seed)
        self.top = top
        strings = _strings(self.x, top, self.planes, False, trees)
        self.rank = np.argsort(strings, axis=0, kind="stable")
        self.sorted = np.take_along_axis(strings, self.rank, 0)

    def search(self, qid: np.ndarray, q: np.ndarray, k: int, effort: float):
        """Rows (query, id, score) of each query's k best candidates of this block."""
        own = _strings(q, self.top, self.planes, True, self.trees)
        n = len(self.x)
        enough = min(n * self.trees, max(8 * k, math.ceil(effort * n)))
        low = np.zeros((len(q), self.trees), np.int64)
        high = np.zeros_like(low)
        open_ = np.ones(len(q), bool)
        depths = np.zeros(len(q), np.int64)
        # ascend all trees together: prefixes of 32, 31, ... bits until the ranges hold enough
        for depth in range(BITS, -1, -1):
            rows = np.flatnonzero(open_)
            if not len(rows):
                break
            rest = np.uint64((1 << (BITS - depth)) - 1)
            for t in range(self.trees):
                s = own[rows, t]
                low[rows, t] = np.searchsorted(self.sorted[:, t], s & ~rest)
                high[rows, t] = np.searchsorted(self.sorted[:, t], s | rest, side="right")
            open_[rows] = (high[rows] - low[rows]).sum(1) < enough
            depths[rows] = depth
        need = min(n, 8 * k + 1)
        out_q, out_i, out_s = [], [], []
        for i in range(len(q)):
            mark = np.zeros(n, bool)
            for t in range(self.trees):
                mark[self.rank[low[i, t]:high[i, t], t]] = True
            # a tight group may fill the ranges of all trees with the same few vectors
            depth = int(depths[i])
            while depth and mark.sum() < need:
                depth -= 1
                rest = np.uint64((1 << (BITS - depth)) - 1)
                for t in range(self.trees):
                    s = own[i, t]
                    a = np.searchsorted(self.sorted[:, t], s & ~rest)
                    b = np.searchsorted(self.sorted[:, t], s | rest, side="right")
                    mark[self.rank[a:b, t]] = True
            at = np.flatnonzero(mark)
            score = self.x[at] @ q[i]
            if len(at) > k + 1:
                part = np.partition(score, len(at) - k - 1)[len(at) - k - 1]
                best = score >= part
                at, score = at[best], score[best]
            # rows of each vector, without the query's own; ids are ascending within a vector
            for j in np.argsort(-score, kind="stable"):
                mine = self.ids[self.begin[at[j]]:self.begin[at[j] + 1]][:k + 1]
                mine = mine[mine != qid[i]][:k]
                out_q.append(np.full(len(mine), qid[i]))
                out_i.append(mine)
                out_s.append(np.full(len(mine), score[j]))
        none = np.zeros(0, np.int64)
        q_, i_, s_ = (np.concatenate([*x, none]) for x in (out_q, out_i, out_s))
        order = np.lexsort((i_, -s_, q_))
        q_, i_, s_ = q_[order], i_[order], s_[order]
        new = np.ones(len(q_), bool)
        new[1:] = q_[1:] != q_[:-1]
        place = np.arange(len(q_))
        keep = place - np.maximum.accumulate(np.where(new, place, 0)) < k
        return q_[keep], i_[keep], s_[keep].astype(np.float64)


def nearest(vectors: DataFrame, k: int = 20, every: int = 20, trees: int = TREES, effort: float = EFFORT,
            block_rows: int = BLOCK_ROWS, seed: int = 7) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest rows of each row whose id is divisible by ``every``."""
    ship(vectors.sparkSession)
    rows = cut_lineage(usable(vectors))
    n, top, queries = rows.agg(F.count("*"), F.max(F.aggregate(F.transform("v", lambda x: x * x), F.lit(0.0),
                                                               lambda a, x: a + x)),
                               F.count(F.when(F.col("vec_id") % every == 0, 1))).first()
    top = math.sqrt(top or 0.0)
    blocks, parts = max(1, math.ceil(n / block_rows)), max(1, math.ceil(queries / QUERY_ROWS))
    key = F.xxhash64("vec_id")
    index = rows.select("vec_id", "v", F.pmod(key, F.lit(blocks)).cast("int").alias("b"),
                        F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("c"))
    asked = rows.where(F.col("vec_id") % every == 0).select(
        "vec_id", "v", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("b"),
        F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(parts)).cast("int").alias("c"))

    def matrix(t: pa.Table) -> np.ndarray:
        flat = t["v"].combine_chunks().flatten()
        return np.asarray(flat, np.float64).reshape(t.num_rows, -1)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        empty = not left.num_rows or not right.num_rows
        q, i, s = ([], [], []) if empty else Forest(
            np.asarray(left["vec_id"]), matrix(left), top, trees, seed).search(
            np.asarray(right["vec_id"]), matrix(right), k, effort)
        return pa.table({"query_id": pa.array(q, pa.int64()), "vec_id": pa.array(i, pa.int64()),
                         "score": pa.array(s, pa.float64())})

    found = index.groupBy("b", "c").cogroup(asked.groupBy("b", "c")).applyInArrow(
        run, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.select("query_id", F.row_number().over(order).alias("rank"), "vec_id", "score").where(
        F.col("rank") <= k)
