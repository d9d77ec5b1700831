"""Approximate nearest neighbours by cosine with stable random projections.

Vectors are scaled to length 1, where cosine and Euclidean order agree, and
projected onto a few Gaussian (2-stable) directions.  The squared projected
distance of two vectors, divided by their squared distance, follows a chi-square law
with as many degrees of freedom.  A kd-tree over the projections hands out
neighbours by growing projected distance; each is verified on the whole vector,
and the search stops when a vector nearer than the k-th found would show a
projected distance as large as the next one only with small probability.

The top levels of the tree are fitted on a bounded sample and cut the space into
cells; each cell (or slice of a cell that is still too large) is one Spark group
with its own tree.  A query first searches the cell it lies in, and then, with the distance found
there, the cells that its search ball reaches.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import check_columns, hash52, written, HASH_BITS

K = 5
DIRECTIONS = 10  # even, so that the chi-square law has a closed form
CERTAINTY = 0.97  # chance that a true neighbour lies inside the searched ball
CELL_ROWS = 16_384
SAMPLE_ROWS = 20_000  # the splits are fitted on so many vectors, or SAMPLE_PER_CELL a cell if these are more
SAMPLE_PER_CELL = 16
MAX_CELLS = 1 << 17  # so the sample has at most 2^21 points of 10 doubles; larger cells are searched in slices
LEAF_ROWS = 32
QUERY_CHUNK = 8_192  # queries of a cell that one group holds


def chi_square_quantile(p: float, freedom: int) -> float:
    """Quantile of the chi-square law with an even number of degrees of freedom."""
    low, high = 0.0, 1000.0
    for _ in range(100):
        x = (low + high) / 2
        term, total = 1.0, 1.0
        for i in range(1, freedom // 2):
            term *= x / 2 / i
            total += term
        low, high = (x, high) if 1 - math.exp(-x / 2) * total < p else (low, x)
    return high


def directions(dim: int, m: int = DIRECTIONS, seed: int = 11) -> np.ndarray:
    return np.random.RandomState(seed).standard_normal((dim, m))


def unit(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(1, keepdims=True)
    return v / np.sqrt((v * v).sum(1, keepdims=True))


def split_tree(points: np.ndarray, cells: int) -> list[tuple[int, float]]:
    """Splits (axis, value) of a complete binary tree with ``cells`` leaves (a power of
    two), node i's children being 2i + 1 and 2i + 2."""
    splits: list = []
    level = [points]
    for _ in range(int(math.log2(cells))):
        below = []
        for p in level:
            axis = int(np.argmax(p.max(0) - p.min(0))) if len(p) else 0
            value = float(np.median(p[:, axis])) if len(p) else 0.0
            splits.append((axis, value))
            below += [p[p[:, axis] <= value], p[p[:, axis] > value]]
        level = below
    return splits


def cell_of(points: np.ndarray, splits: list) -> np.ndarray:
    node = np.zeros(len(points), np.int64)
    if not splits:
        return node
    axis, value = np.array([s[0] for s in splits]), np.array([s[1] for s in splits])
    for _ in range(int(math.log2(len(splits) + 1))):
        node = 2 * node + 1 + (points[np.arange(len(points)), axis[node]] > value[node])
    return node - len(splits)


def cells_in_reach(point: np.ndarray, radius: float, splits: list) -> list[int]:
    """Cells that the ball around ``point`` touches."""
    out, todo = [], [(0, np.zeros(len(point)))]
    while todo:
        node, gap = todo.pop()  # gap: distance to the node's box along each axis
        if node >= len(splits):
            out.append(node - len(splits))
            continue
        axis, value = splits[node]
        near = 2 * node + 1 + int(point[axis] > value)
        far = 4 * node + 3 - near
        todo.append((near, gap))
        wider = gap.copy()
        wider[axis] = max(wider[axis], abs(point[axis] - value))
        if (wider * wider).sum() <= radius * radius:
            todo.append((far, wider))
    return out


class ProjectionTree:
    """kd-tree over projected points: leaves with their boxes."""

    def __init__(self, points: np.ndarray, leaf_rows: int = LEAF_ROWS):
        leaves, todo = [], [np.arange(len(points))]
        while todo:
            rows = todo.pop()
            p = points[rows]
            spread = p.max(0) - p.min(0)
            axis = int(np.argmax(spread))
            if len(rows) <= leaf_rows or spread[axis] == 0:
                leaves.append(rows)
                continue
            half = len(rows) // 2
            order = np.argpartition(p[:, axis], half)
            todo += [rows[order[:half]], rows[order[half:]]]
        self.leaves = leaves
        self.low = np.array([points[r].min(0) for r in leaves])
        self.high = np.array([points[r].max(0) for r in leaves])

    def in_order(self, point: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Leaves by squared projected distance of their boxes, and these distances."""
        gap = np.maximum(np.maximum(self.low - point, point - self.high), 0)
        d = (gap * gap).sum(1)
        order = np.argsort(d, kind="stable")
        return order, d[order]


def search_tree(tree: ProjectionTree, vectors: np.ndarray, query: np.ndarray, point: np.ndarray, k: int,
                quantile: float, known: float) -> tuple[np.ndarray, np.ndarray]:
    """(rows, cosines) of the best ``k`` found, ties included.  ``known``: cosine of the
    k-th neighbour found elsewhere, or -inf.  Stops when the next projected distance
    exceeds the k-th distance by more than the chi-square test allows."""
    order, gaps = tree.in_order(point)
    rows, cos = np.empty(0, np.int64), np.empty(0)
    at, step, bound = 0, 4, known
    while at < len(order):
        if bound > -np.inf and gaps[at] > (2 - 2 * bound) * quantile + 1e-9:
            break
        fresh = np.concatenate([tree.leaves[i] for i in order[at:at + step]])
        rows = np.concatenate([rows, fresh])
        cos = np.concatenate([cos, vectors[fresh] @ query])
        if len(cos) > k:
            kth = np.partition(cos, len(cos) - k)[len(cos) - k]
            keep = cos >= kth - 1e-12  # equal ones stay: ties go to the smaller id later
            rows, cos = rows[keep], cos[keep]
            bound = max(bound, kth)
        at, step = at + step, min(2 * step, 64)
    return rows, cos


def nearest_neighbours(vectors: DataFrame, is_query: Column, k: int = K, certainty: float = CERTAINTY,
                       cell_rows: int = CELL_ROWS, query_chunk: int = QUERY_CHUNK) -> DataFrame:
    """query_id, rank, vec_id, score: for each row of ``vectors`` that ``is_query``
    marks its ``k`` nearest other rows by cosine.

    Columns: vec_id, embedding (array of floats).  Rows without vec_id, and vectors
    that are null, zero, of another length than most, or hold null or non-finite
    components take no part.  Equal vectors are indexed once with their smallest ids:
    of k + 1 equal ones no more can be in any answer, so nothing is lost and a third
    of all rows may be one vector.  Repeated ids count once per vector.  Ties go to
    the smaller id; a query with fewer candidates gets them all; an empty table
    gives no rows.  Other columns are ignored.
    """
    check_columns(vectors, vec_id="long", embedding="array")
    spark = vectors.sparkSession
    e = F.col("embedding")
    sound = vectors.filter(F.col("vec_id").isNotNull() & e.isNotNull() & ~F.exists(
        e, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(e, lambda x: x != 0))
    sound = sound.select("vec_id", e.cast("array<double>").alias("embedding"),
                         F.coalesce(is_query, F.lit(False)).alias("is_query"))
    widths = sound.groupBy(F.size("embedding").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    dim = widths["dim"] if widths else 1
    sound = sound.filter(F.size("embedding") == dim)
    basis = directions(dim)

    def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not len(pdf):
                continue
            v = np.array(pdf["embedding"].tolist(), np.float64) + 0.0  # -0 becomes 0
            yield pd.DataFrame({
                "vec_id": pdf["vec_id"], "is_query": pdf["is_query"],
                "key": [hashlib.blake2b(x.tobytes(), digest_size=16).digest() for x in v],
                "vector": [x.tobytes() for x in v], "point": (unit(v) @ basis).tolist()})

    rows = written(sound.mapInPandas(
        project, "vec_id long, is_query boolean, key binary, vector binary, point array<double>"), "vectors")
    first = W.partitionBy("key").orderBy("vec_id")
    ids = (rows.select("key", "vec_id").distinct().withColumn("nth", F.row_number().over(first))
           .filter(F.col("nth") <= k + 1).groupBy("key").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")))
    kinds = rows.groupBy("key").agg(F.first("vector").alias("vector"), F.first("point").alias("point"),
                                    F.max("is_query").alias("asked")).join(ids, "key")
    kinds = written(kinds, "vector-kinds")
    n = kinds.count()
    cells = min(MAX_CELLS, 1 << max(0, math.ceil(math.log2(max(n, 1) / cell_rows))))
    wanted = max(SAMPLE_ROWS, SAMPLE_PER_CELL * cells)
    chosen = kinds if n <= wanted else kinds.filter(hash52(F.hex("key")) < int((1 << HASH_BITS) * (wanted / n)))
    points = chosen.select(F.explode("point").alias("x")) if n else None
    sample = np.array([] if points is None else points.toArrow()["x"]).reshape(-1, DIRECTIONS)
    splits = split_tree(sample, cells)
    quantile = chi_square_quantile(certainty, DIRECTIONS)

    @F.pandas_udf("long")
    def cell(points: pd.Series) -> pd.Series:
        return pd.Series(cell_of(np.array(points.tolist()).reshape(-1, DIRECTIONS), splits))

    placed = kinds.withColumn("cell", cell("point"))
    sizes = written(placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")), "cells")
    asked = placed.filter("asked").select("key", "vector", "point", "cell")

    def look(queries: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(block):
            raw = np.frombuffer(b"".join(block["vector"]), np.float64).reshape(-1, dim)
            norm = np.sqrt((raw * raw).sum(1))
            v, ids = unit(raw), block["ids"].tolist()
            tree = ProjectionTree(np.array(block["point"].tolist()))
            for key, q, point, known in zip(queries["key_"], queries["vector_"], queries["point_"], queries["known_"]):
                q = np.frombuffer(q, np.float64)
                got, _ = search_tree(tree, v, unit(q[None])[0], np.asarray(point), k + 1, quantile,
                                     -np.inf if known is None or np.isnan(known) else known)
                score = (raw[got] * q).sum(1) / (norm[got] * np.sqrt((q * q).sum()))
                bad = ~np.isfinite(score)  # products outside the range of doubles
                score[bad] = (v[got[bad]] * unit(q[None])[0]).sum(1)
                best = sorted(zip(-score, [ids[i][0] for i in got], got))[:k + 1]
                out += [(key, -s, ids[i]) for s, _, i in best]
        return pd.DataFrame(out, columns=["key", "score", "ids"])

    found_schema = "key binary, score double, ids array<long>"
    group = ("cell", "slice", "chunk")

    def run(q: DataFrame) -> DataFrame:
        # slices of large cells and chunks of their queries keep every group bounded; a vector is sent once per chunk of
        # the queries that reach its own cell, and not at all where none does
        plan = sizes.join(q.groupBy("cell").agg(F.count(F.lit(1)).alias("asked_n")), "cell").select(
            "cell", F.ceil(F.col("n") / F.lit(2 * cell_rows)).alias("slices"),
            F.ceil(F.col("asked_n") / F.lit(query_chunk)).alias("chunks"))
        plan = F.broadcast(written(plan, "cell-plan"))  # at most MAX_CELLS rows of three longs
        zero = F.lit(0).cast("long")
        base = placed.select("key", "vector", "point", "ids", "cell").join(plan, "cell").select(
            "key", "vector", "point", "ids", "cell", F.pmod(F.xxhash64("key"), "slices").alias("slice"),
            F.explode(F.sequence(zero, F.col("chunks") - 1)).alias("chunk"))
        q = q.join(plan, "cell").withColumn("chunk", F.pmod(F.xxhash64("key", F.lit(1)), "chunks"))
        q = q.withColumn("slice", F.explode(F.sequence(zero, F.col("slices") - 1)))
        q = q.select(*[F.col(c).alias(c + "_") for c in (*group, "key", "vector", "point", "known")])
        return (q.groupBy(*[c + "_" for c in group]).cogroup(base.groupBy(*group))
                .applyInPandas(look, found_schema))

    home = written(run(asked.withColumn("known", F.lit(None).cast("double"))), "neighbours-home")
    nth = W.partitionBy("key").orderBy(F.desc("score"), F.col("ids")[0])
    kth = (home.withColumn("nth", F.row_number().over(nth)).filter(F.col("nth") == k + 1)
           .select("key", F.col("score").alias("known")))

    @F.pandas_udf("array<long>")
    def reach(points: pd.Series, known: pd.Series, own: pd.Series) -> pd.Series:
        out = []
        for p, c, o in zip(points, known, own):
            r = math.inf if np.isnan(c) else math.sqrt(max(2 - 2 * c, 0) * quantile + 1e-9)
            out.append([x for x in cells_in_reach(np.asarray(p), r, splits) if x != o])
        return pd.Series(out)

    away = asked.join(kth, "key", "left").withColumn("reached", reach("point", "known", "cell")).drop("cell")
    away = written(away, "neighbours-away").withColumn("cell", F.explode("reached")).drop("reached")
    best = (home.unionByName(run(away)).withColumn("nth", F.row_number().over(nth)).filter(F.col("nth") <= k + 1)
            .select("key", "score", F.explode("ids").alias("vec_id")))
    queries = rows.filter("is_query").select(F.col("vec_id").alias("query_id"), "key").distinct()
    pairs = queries.join(best, "key").filter("query_id <> vec_id")
    rank = W.partitionBy("query_id", "key").orderBy(F.desc("score"), "vec_id")
    return (pairs.withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
