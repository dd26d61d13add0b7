"""Exact top-k search by inner product: a ball tree per shard, searched by branch and bound.

Vectors are dealt to shards by a hash of their row's number; a shard is small enough for one task, and its
vectors are put into a ball tree there. A query visits nodes in the order of the largest inner product they can
hold (query times centre plus query length times radius) and stops when that is below the k-th best score. The
k-th score is shared: each query is first searched in its own shard, and all other shards begin with the
score found there, so most of their nodes are never opened. Queries go to shards in blocks.

Components are turned into integers, floor(1024 * x), so scores are exact; ties go to the smaller id.

Defined results. Vectors that are null or empty, or hold a null, NaN or infinite component, and rows
with a null id take no part. A query is compared with vectors of its own length only. Rows that repeat an id
are vectors of their own: each asks for itself, and only the asking row is no candidate. With fewer than k candidates all are returned; an empty table
gives no rows. A score beyond a long is cut off there. Further columns take no part.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..workspace import stage

K = 10
SCALE = 1024
LEAF = 32
SHARD_ROWS = (1024, 65_536)  # at least, at most
QUERY_BLOCK = 16_384
_LONG = 2**63 - 1


class BallTree:
    def __init__(self, rows: np.ndarray, ids: np.ndarray, points: np.ndarray):
        self.rows, self.ids, self.points = rows, ids, points
        self.largest = float(np.abs(points).max(initial=0))
        order = np.arange(len(ids))
        self.span, self.children, centres, radii = [], [], [], []
        waiting = [(0, len(ids), -1)]
        while waiting:
            a, b, parent = waiting.pop()
            node = len(self.span)
            if parent >= 0:
                self.children[parent].append(node)
            own = points[order[a:b]]
            centre = own.mean(0)
            away = np.sqrt(((own - centre) ** 2).sum(1))
            self.span.append((a, b))
            self.children.append([])
            centres.append(centre)
            radii.append(away.max())
            if b - a > LEAF and radii[-1] > 0:
                far = own[away.argmax()]  # split along the line of two far points
                other = own[((own - far) ** 2).sum(1).argmax()]
                side = own @ (far - other)
                order[a:b] = order[a:b][np.argsort(side, kind="stable")]
                middle = (a + b) // 2
                waiting += [(a, middle, node), (middle, b, node)]
        self.order, self.centres, self.radii = order, np.array(centres), np.array(radii)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """By query and node, what no score in the node exceeds."""
        length = np.sqrt((queries**2).sum(1))[:, None]
        slack = 1e-9 * length * (np.sqrt((self.centres**2).sum(1)) + self.radii) + 1e-6
        return queries @ self.centres.T + length * self.radii + slack

    def search(self, query: np.ndarray, bound: np.ndarray, own: int, k: int, least: float) -> list[tuple[int, int]]:
        """(score, id) of the k best with a score of at least ``least``, best first; row ``own`` is left out."""
        exact = self.largest * float(np.abs(query).max(initial=0)) * len(query) < 2**53
        best: list[tuple[int, int]] = []  # a heap, worst first: (score, -id)
        open_nodes = [(-bound[0], 0)]
        while open_nodes:
            above, node = heapq.heappop(open_nodes)
            if -above < least:
                break
            if self.children[node]:
                for child in self.children[node]:
                    if bound[child] >= least:
                        heapq.heappush(open_nodes, (-bound[child], child))
                continue
            at = self.order[slice(*self.span[node])]
            if exact:
                scores = (self.points[at] @ query).astype(np.int64)
                good = (scores >= least) & (self.rows[at] != own)
                found = zip(scores[good].tolist(), (-self.ids[at[good]]).tolist())
            else:
                whole = [int(x) for x in query]
                found = ((max(-_LONG - 1, min(_LONG, sum(int(x) * y for x, y in zip(self.points[i], whole)))), -int(self.ids[i]))
                         for i in at if self.rows[i] != own)
            for item in found:
                if len(best) < k:
                    heapq.heappush(best, item)
                elif item > best[0]:
                    heapq.heapreplace(best, item)
            if len(best) == k:
                least = max(least, best[0][0])
        return [(s, -i) for s, i in sorted(best, reverse=True)]


def _searched(k: int):
    def run(vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        vectors = vectors.assign(_n=vectors.vector.map(len)).sort_values("row")
        sizes = queries.vector.map(len) if len(queries) else queries.vector
        for n, own in vectors.groupby("_n"):
            asked = queries[sizes == n] if len(queries) else queries
            if not len(asked):
                continue
            tree = BallTree(own.row.to_numpy(), own.vec_id.to_numpy(), np.stack(own.vector.to_numpy()))
            points = np.stack(asked.vector.to_numpy())
            bounds = tree.bounds(points)
            for i, (query, row, least) in enumerate(zip(asked.query_id, asked.asking, asked.least)):
                least = -math.inf if pd.isna(least) else float(least)
                out += [(query, row, i_, s) for s, i_ in tree.search(points[i], bounds[i], row, k, least)]
        return pd.DataFrame(out, columns=["query_id", "asking", "vec_id", "score"]).astype("int64")

    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = K, *, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: of every row for which ``is_query`` holds."""
    x = F.col("x")
    fits = F.coalesce(F.size("x") > 0, F.lit(False)) & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(math.inf)))
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("x"), is_query.alias("q"))
    rows = rows.where(F.col("vec_id").isNotNull()).where(fits)
    whole = F.transform(x, lambda c: F.lit(float(SCALE)) * c)
    # Whole numbers held as doubles: floor() would leave the range of a long for very large components.
    whole = F.transform(whole, lambda c: F.when(F.abs(c) < 2.0**52, F.floor(c).cast("double")).otherwise(c))
    rows = rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", whole.alias("vector"), F.coalesce("q", F.lit(False)).alias("q"))
    rows = stage(rows, "vectors")  # written, so a row keeps its number
    n = rows.count()
    shard_rows = min(max(SHARD_ROWS[0], 8 * math.isqrt(n)), SHARD_ROWS[1])
    shards = max(1, -(-n // shard_rows))
    shard = F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int")
    rows = rows.withColumn("shard", shard)
    queries = rows.where("q").select(F.col("vec_id").alias("query_id"), F.col("row").alias("asking"), F.col("shard").alias("home"), "vector")
    queries = stage(queries, "queries")
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    queries = queries.withColumn("block", F.pmod(F.xxhash64("asking", F.lit("block")), F.lit(blocks)).cast("int"))
    held = rows.select("row", "vec_id", "vector", "shard", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))

    def searched(asked: DataFrame) -> DataFrame:
        pairs = held.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block"))
        return pairs.applyInPandas(_searched(k), "query_id long, asking long, vec_id long, score long")

    home = queries.select("query_id", "asking", "vector", F.col("home").alias("shard"), "block", F.lit(None).cast("long").alias("least"))
    first = stage(searched(home), "home_shards")
    least = first.groupBy("asking").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("least"))
    away = queries.join(least, "asking", "left").withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    away = away.where("shard != home").select("query_id", "asking", "vector", "shard", "block", "least")
    found = first.unionByName(stage(searched(away), "other_shards"))
    order = Window.partitionBy("asking").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
