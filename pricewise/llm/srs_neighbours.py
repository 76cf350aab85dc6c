"""Approximate nearest neighbours: stable projections, kd-trees, chi-square stopping.

Unit vectors are projected to a few dimensions by a Gaussian (2-stable) matrix.
For a pair at distance d, (projected distance / d)^2 follows a chi-squared
distribution with as many degrees of freedom, whatever the vectors. A query
therefore takes rows in order of projected distance, verifies each with the
true distance, and stops when the chi-square test says that a row nearer than
its k-th best would have shown up by now with probability ``CONFIDENCE``.

The projected space is cut by a kd-tree fitted on a bounded sample
(``SAMPLE_ROWS``); every row is indexed in its cell. A query first searches its
home cell, which bounds its k-th distance, and then only the cells whose box
passes the same test. Within a cell rows stand in a kd-tree of their own. Only
the first k + 1 rows of a group of identical vectors can be among any k nearest
(ties go to smaller ids), so the rest of such a group is left out up front.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pricewise.llm.common import stored

DIMS = 8
CONFIDENCE = 0.97
SAMPLE_ROWS = 16_384
CELL_ROWS = 4_096
QUERY_BLOCK = 4_096
LEAF_ROWS = 512
MAX_CELLS = 1_024


def chi2_cdf(x: float, k: int) -> float:
    """Chi-squared distribution function for an even number of degrees of freedom."""
    term, total = 1.0, 1.0
    for i in range(1, k // 2):
        term *= x / 2 / i
        total += term
    return 1 - math.exp(-x / 2) * total


def chi2_quantile(p: float, k: int) -> float:
    lo, hi = 0.0, 1.0
    while chi2_cdf(hi, k) < p:
        hi *= 2
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi2_cdf(mid, k) < p else (lo, mid)
    return hi


def projection(width: int, dims: int, seed: int = 11) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((width, dims))


def _unit(v: np.ndarray) -> np.ndarray:
    return v / norms(v)[:, None]


def norms(rows: np.ndarray) -> np.ndarray:
    return np.sqrt((rows * rows).sum(1))


def cosines(rows: np.ndarray, lengths: np.ndarray, q: np.ndarray, q_length: float) -> np.ndarray:
    """Cosine of every row with ``q`` in double precision; equal rows give equal numbers."""
    return (rows * q).sum(1) / (lengths * q_length)


class KdTree:
    """Median-split kd-tree; leaves as slices of ``order`` with their bounding boxes."""

    def __init__(self, points: np.ndarray, leaf_rows: int, max_leaves: int = 1 << 30):
        self.order = np.arange(len(points))
        self.cuts: list[list] = []  # dimension, value, left, right (leaf: ~index)
        done = []
        queue = [(0, len(points), -1, 0)]
        n_leaves = 1
        while queue:
            a, b, parent, side = queue.pop(0)
            p = points[self.order[a:b]]
            spread = p.max(0) - p.min(0) if b > a else np.zeros(points.shape[1])
            dim = int(spread.argmax())
            if b - a <= leaf_rows or spread[dim] == 0 or n_leaves >= max_leaves:
                self._link(parent, side, ~len(done))
                done.append((a, b))
                continue
            value = float(np.median(p[:, dim]))
            if value == p[:, dim].max():
                value = float(p[:, dim][p[:, dim] < value].max())
            left = p[:, dim] <= value
            self.order[a:b] = np.concatenate([self.order[a:b][left], self.order[a:b][~left]])
            self._link(parent, side, len(self.cuts))
            self.cuts.append([dim, value, 0, 0])
            me, mid = len(self.cuts) - 1, a + int(left.sum())
            queue += [(a, mid, me, 2), (mid, b, me, 3)]
            n_leaves += 1
        self.leaves = done
        self.low = np.array([points[self.order[a:b]].min(0) if b > a else np.full(points.shape[1], np.inf) for a, b in done])
        self.high = np.array([points[self.order[a:b]].max(0) if b > a else np.full(points.shape[1], -np.inf) for a, b in done])

    def _link(self, parent: int, side: int, target: int):
        if parent >= 0:
            self.cuts[parent][side] = target

    def leaf_of(self, points: np.ndarray) -> np.ndarray:
        """Leaf that a point falls into by the cuts."""
        out = np.zeros(len(points), np.int64)
        if not self.cuts:
            return out
        todo = [(0, np.arange(len(points)))]
        while todo:
            node, rows = todo.pop()
            if node < 0:
                out[rows] = ~node
                continue
            dim, value, left, right = self.cuts[node]
            go = points[rows, dim] <= value
            todo += [(left, rows[go]), (right, rows[~go])]
        return out


def box_distance(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance from every query (rows) to every box (columns)."""
    out = np.zeros((len(q), len(low)))
    for j in range(q.shape[1]):
        d = np.maximum(np.maximum(low[None, :, j] - q[:, None, j], q[:, None, j] - high[None, :, j]), 0)
        out += d * d
    return out


def search(rows: np.ndarray, ids: np.ndarray, points: np.ndarray, queries: np.ndarray, query_ids: np.ndarray,
           query_points: np.ndarray, bounds: np.ndarray, k: int, limit: float) -> list[tuple]:
    """(query_id, vec_id, score) of each query's k nearest of these rows by incremental
    projected neighbours: leaves come in order of their boxes' projected distance, and
    rows (or whole leaves) beyond ``limit`` x (k-th squared distance so far) fail the
    chi-square test. ``bounds``: k-th smallest squared distance known beforehand.

    Rows are verified by a matrix product; those that may enter the k nearest are
    scored once more by ``cosines``, whose numbers do not depend on their place.
    """
    tree = KdTree(points, LEAF_ROWS)
    rows, ids, points = rows[tree.order], ids[tree.order], points[tree.order]
    lengths, query_lengths = norms(rows), norms(queries)
    units, query_units = rows / lengths[:, None], queries / query_lengths[:, None]
    boxes = box_distance(query_points, tree.low, tree.high)
    visit = np.argsort(boxes, axis=1, kind="stable")
    out = []
    for i in range(len(queries)):
        best_s, best_i = np.empty(0), np.empty(0, ids.dtype)
        kth = bounds[i]
        for leaf in visit[i]:
            reach = limit * kth + 1e-9
            if boxes[i, leaf] > reach:
                break
            a, b = tree.leaves[leaf]
            near = ((points[a:b] - query_points[i]) ** 2).sum(1) <= reach
            near &= units[a:b] @ query_units[i] >= 1 - kth / 2 - 1e-9
            r = a + np.flatnonzero(near)
            r = r[ids[r] != query_ids[i]]
            if len(r):
                s = np.concatenate([best_s, cosines(rows[r], lengths[r], queries[i], query_lengths[i])])
                n = np.concatenate([best_i, ids[r]])
                top = np.lexsort((n, -s))[:k]
                best_s, best_i = s[top], n[top]
                if len(best_s) == k:
                    kth = min(kth, max(0.0, 2 - 2 * float(best_s[-1])))
        out += [(query_ids[i], n, float(s)) for n, s in zip(best_i, best_s)]
    return out


# ------------------------------------------------------------------ Spark

def _pairs(left: DataFrame, right: DataFrame, k: int, limit: float, id_type: str) -> DataFrame:
    """Search of every (cell, block) group of queries ``left`` in the cell's rows ``right``."""
    def run(q: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(r):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        stack = lambda col: np.stack(col.to_list()).astype(float)
        got = search(stack(r["_v"]), r["_id"].to_numpy(), stack(r["_p"]), stack(q["_v"]), q["_id"].to_numpy(),
                     stack(q["_p"]), q["_bound"].to_numpy(float), k, limit)
        return pd.DataFrame(got, columns=["query_id", "vec_id", "score"])

    key = ["_cell", "_sub", "_block"]
    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(
        run, f"query_id {id_type}, vec_id {id_type}, score double")


def nearest(vectors: DataFrame, queries: DataFrame | None = None, *, k: int = 5, id_col: str = "vec_id",
            vector_col: str = "embedding", dims: int = DIMS, confidence: float = CONFIDENCE,
            sample_rows: int = SAMPLE_ROWS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """The k nearest rows of every query by cosine: (query_id, rank from 1, vec_id, score).

    ``queries``: a frame of the same columns (None: all rows ask). Candidates are all rows
    but those with the query's own id; ties go to smaller ids; with fewer
    candidates all are returned. Each true neighbour is found with at least
    ``confidence``. Vectors that are null, empty, zero or hold null or non-finite
    components take no part, nor do those without an id or of another length than
    the most common one. Repeated rows count once; of several vectors under one
    id the nearest counts as candidate, the smallest asks. No valid rows: no result.
    """
    if dims % 2:
        raise ValueError("dims must be even")
    spark = vectors.sparkSession

    def valid(df: DataFrame) -> DataFrame:
        v = F.col("_v")
        return (df.select(F.col(id_col).alias("_id"), F.col(vector_col).cast("array<double>").alias("_v"))
                .where("_id is not null and size(_v) > 0")
                .where(F.forall(v, lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x)))
                .where(F.exists(v, lambda x: x != 0)))

    rows = valid(vectors)
    id_type = rows.schema["_id"].dataType.simpleString()
    empty = spark.createDataFrame([], f"query_id {id_type}, rank int, vec_id {id_type}, score double")
    lengths = rows.groupBy(F.size("_v").alias("w")).count().orderBy(F.desc("count"), F.desc("w")).first()
    if lengths is None:
        return empty
    width = lengths["w"]
    # the first k + 1 ids of every group of identical vectors
    same = Window.partitionBy("_v").orderBy("_id")
    rows = rows.where(F.size("_v") == width).withColumn("_r", F.dense_rank().over(same)).where(F.col("_r") <= k + 1)
    rows = stored(rows.dropDuplicates(["_v", "_id"]).drop("_r"), "srs-rows")
    matrix = projection(width, dims)

    sample = rows.orderBy(F.xxhash64("_id"), "_id").limit(sample_rows).select("_v").toArrow()["_v"].to_pylist()
    sample = _unit(np.array(sample, float)) @ matrix
    total = lengths["count"]
    tree = KdTree(sample, max(8, int(len(sample) * cell_rows / max(total, 1))), MAX_CELLS)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                v = b.column("_v")
                p = _unit(v.flatten().to_numpy().reshape(b.num_rows, width)) @ matrix
                yield pa.record_batch([b.column("_id"), v, pa.array(list(p), pa.list_(pa.float64())),
                                       pa.array(tree.leaf_of(p).astype(np.int32))], names=["_id", "_v", "_p", "_cell"])

    shape = f"_id {id_type}, _v array<double>, _p array<double>, _cell int"
    index = stored(rows.mapInArrow(place, shape), "srs-index")
    corners = [f(F.col("_p")[j]).alias(f"{n}{j}") for n, f in (("a", F.min), ("b", F.max)) for j in range(dims)]
    cells = index.groupBy("_cell").agg(F.count("*").alias("n"), *corners).orderBy("_cell").collect()  # <= MAX_CELLS rows
    number = np.array([c["_cell"] for c in cells], np.int32)
    low = np.array([[c[f"a{j}"] for j in range(dims)] for c in cells])
    high = np.array([[c[f"b{j}"] for j in range(dims)] for c in cells])
    subs = {c["_cell"]: max(1, -(-c["n"] // (2 * cell_rows))) for c in cells}

    ask = valid(vectors if queries is None else queries).where(F.size("_v") == width)
    ask = ask.groupBy("_id").agg(F.min("_v").alias("_v"))
    ask = stored(ask.mapInArrow(place, shape), "srs-queries")
    limit = chi2_quantile(confidence, dims)

    def of_cell(numbers: dict[int, int]):
        """The number of a row's cell, null for a cell that is not listed (at most ``MAX_CELLS`` are)."""
        if not numbers:
            return F.lit(None).cast("int")
        return F.create_map(*[F.lit(x) for c, n in numbers.items() for x in (c, n)])[F.col("_cell")]

    def pairs(asked: DataFrame) -> DataFrame:
        """Search of stored queries in their cells. A cell above its size is cut by a hash, and its
        queries go to all its parts; its rows are copied once per block of queries that came to
        it, usually one, and not at all where none came."""
        came = {r["_cell"]: -(-r["count"] // QUERY_BLOCK) for r in asked.groupBy("_cell").count().collect()}
        cut, blocks = F.coalesce(of_cell(subs), F.lit(1)), of_cell(came)
        left = (asked.withColumn("_sub", F.explode(F.sequence(F.lit(0), cut - 1)))
                .withColumn("_block", F.pmod(F.xxhash64(F.lit("block"), "_id"), blocks).cast("int")))
        right = (index.where(blocks.isNotNull())
                 .withColumn("_sub", F.pmod(F.xxhash64("_id", "_v"), cut).cast("int"))
                 .withColumn("_block", F.explode(F.sequence(F.lit(0), blocks - 1))))
        return _pairs(left, right, k, limit, id_type)

    home = stored(pairs(ask.withColumn("_bound", F.lit(8.0))), "srs-home")
    by_rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    kth = (home.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
           .withColumn("_r", F.row_number().over(by_rank)).where(F.col("_r") == k)
           .select(F.col("query_id").alias("_id"), F.greatest(F.lit(0.0), 2 - 2 * F.col("score")).alias("_k")))
    bounded = ask.join(kth, "_id", "left").select("_id", "_v", "_p", "_cell", F.coalesce("_k", F.lit(8.0)).alias("_bound"))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A query row for every other cell that passes the test."""
        for whole in batches:
            for start in range(0, whole.num_rows, 512):
                b = whole.slice(start, 512)
                p = b.column("_p").flatten().to_numpy().reshape(b.num_rows, dims)
                near = box_distance(p, low, high) <= limit * b.column("_bound").to_numpy()[:, None] + 1e-9
                near &= number[None, :] != b.column("_cell").to_numpy()[:, None]
                q, c = np.nonzero(near)
                t = b.take(pa.array(q))
                yield pa.record_batch([t.column("_id"), t.column("_v"), t.column("_p"), pa.array(number[c]),
                                       t.column("_bound")], names=["_id", "_v", "_p", "_cell", "_bound"])

    away = pairs(stored(bounded.mapInArrow(route, shape + ", _bound double"), "srs-routed"))
    found = home.unionByName(away).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return (found.withColumn("rank", F.row_number().over(by_rank)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
