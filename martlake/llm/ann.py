"""Approximate nearest neighbours by collision-counting hashing.

Rows are dealt to blocks by a hash of their id. A block projects its normalized vectors on
``LINES`` random directions and keeps every projection as a sorted array. A query opens a
window around its own projection on every array; virtual rehashing widens the windows level
by level, and each vector counts the arrays on which the window has reached it. Vectors with
``THRESHOLD`` collisions or more are candidates; a query stops widening in a block once it has
``ENOUGH`` of them there, and all its candidates are verified by exact cosine. The best of all
blocks are merged. Queries are a stated set; they meet every block in blocks of their own.

Directions come from a fixed seed, so reruns agree and nothing is fitted. Vectors that are
null, zero, empty or hold null or non-finite components take no part; only vectors of one
length are compared. Rows that repeat a vec_id are one row for "the query's own" and both
found as candidates. Ties go to the smaller vec_id. Extra columns are ignored; rows with a
null id take no part. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window as W
from pyspark.sql import functions as F

from martlake.llm import textkit as tk

LINES = 128  # 255 at most, as collisions are counted in a byte
THRESHOLD = 0.7  # of LINES
ENOUGH = 0.15  # of a block's vectors, and 64 at least
_FIRST, _WIDEN = 1.2, 1.1  # first half width, in standard deviations of a projection
_ROWS, _QUERIES = 4096, 32768


def usable(v: Column) -> Column:
    """Not null, and a finite, positive sum of squares (null components make it null)."""
    squares = F.aggregate(v, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    return F.coalesce((squares > 0) & (squares < F.lit(float("inf"))) & ~F.isnan(squares), F.lit(False))


def nearest_in_block(vectors: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, k: int):
    """(query index, vector index, cosine) of each query's ``k`` best verified vectors."""
    n, dim = vectors.shape
    lines = np.random.default_rng(dim).standard_normal((LINES, dim))
    norm, qnorm = np.linalg.norm(vectors, axis=1), np.linalg.norm(queries, axis=1)
    places = (vectors / norm[:, None]) @ lines.T
    order = np.argsort(places, axis=0, kind="stable").T
    arrays = np.take_along_axis(places.T, order, axis=1)
    # where each vector stands in each sorted array: a window is a range of these places
    ranks = np.empty((LINES, n), np.uint16 if n < 1 << 16 else np.uint32)
    np.put_along_axis(ranks, order, np.arange(n, dtype=ranks.dtype)[None, :], axis=1)
    spread = np.maximum(arrays.std(axis=1), 1e-12)
    # all arrays in one, each moved behind the one before: a window is clipped to its own array
    wide = 4 * float(np.abs(arrays / spread[:, None]).max()) + 4
    moved = np.arange(LINES) * wide
    arrays = (arrays / spread[:, None] + moved[:, None]).ravel()
    first = np.arange(LINES) * n
    above, reached = np.empty_like(ranks), np.empty(ranks.shape, bool)
    least = int(np.ceil(THRESHOLD * LINES))
    enough = min(n, max(64, int(ENOUGH * n)))
    out = []
    for c, (q, norm_q) in enumerate(zip(queries, qnorm)):
        at = lines @ (q / norm_q) / spread + moved
        half = _FIRST
        while True:
            lo = np.clip(np.searchsorted(arrays, at - half, "left") - first, 0, n)
            hi = np.clip(np.searchsorted(arrays, at + half, "right") - first, 0, n)
            # unsigned, so a place below the window is far above it
            np.subtract(ranks, lo.astype(ranks.dtype)[:, None], out=above)
            np.less(above, (hi - lo).astype(ranks.dtype)[:, None], out=reached)
            hits = np.add.reduce(reached.view(np.uint8), axis=0, dtype=np.uint8)
            found = np.flatnonzero(hits >= least)
            if len(found) >= enough:
                break
            half *= _WIDEN
        found = found[ids[found] != query_ids[c]]
        score = np.einsum("j,ij->i", q, vectors[found]) / (norm_q * norm[found])
        best = np.lexsort((ids[found], -score))[:k]
        out.append((np.full(len(best), c), found[best], score[best]))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))


def _search(k):
    def run(key, data, asked):
        rows = {"query_id": [], "vec_id": [], "score": []}
        size = np.diff(data.column("v").combine_chunks().offsets.to_numpy()) if len(data) else np.zeros(0, int)
        qsize = np.diff(asked.column("v").combine_chunks().offsets.to_numpy()) if len(asked) else np.zeros(0, int)
        for dim in np.intersect1d(size, qsize):
            d, a = data.filter(pa.array(size == dim)), asked.filter(pa.array(qsize == dim))
            v = d.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
            q = a.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
            ids, qids = d.column("id").to_numpy(), a.column("id").to_numpy()
            qi, vi, score = nearest_in_block(v, ids, q, qids, k)
            rows["query_id"].append(qids[qi])
            rows["vec_id"].append(ids[vi])
            rows["score"].append(score)
        return pa.table({c: np.concatenate(x) if x else np.zeros(0, float if c == "score" else np.int64) for c, x in rows.items()})
    return run


def nearest(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): for every row of ``queries`` (id, v) its ``k`` nearest
    rows of ``vectors`` (id, v) by cosine, its own id left out."""
    vectors, queries = (t.filter(F.col("id").isNotNull() & usable(F.col("v"))) for t in (vectors, queries))
    n_rows, n_queries = vectors.count(), queries.count()
    blocks, q_blocks = tk.parts_for(n_rows, _ROWS, 1), tk.parts_for(n_queries, _QUERIES, 1)
    block, q_block = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"), F.pmod(F.xxhash64("id"), F.lit(q_blocks)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    data = vectors.select("id", "v", block.alias("b"), every(q_blocks).alias("qb"))
    asked = queries.select("id", "v", q_block.alias("qb"), every(blocks).alias("b"))
    found = data.groupBy("b", "qb").cogroup(asked.groupBy("b", "qb")).applyInArrow(_search(k), "query_id long, vec_id long, score double")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op10_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tk.read_table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").alias("v"))
    return nearest(rows, rows.filter("id % 50 = 0"), 5)
