"""Nearest neighbours by shifted space-filling curves, completed to an exact answer.

A coordinate sqrt(M^2 - |x|^2), M the largest norm, puts all rows on one sphere, where
the nearest row to a query's direction has the largest inner product. Points are
projected to a few dimensions, shifted, quantised and ordered along a Hilbert curve,
several times with other projections and shifts. Each ordering is range partitioned and
cut into windows by position; a query meets its own window and both neighbours, and the
candidates of all orderings are merged and reranked.

In vectors without low-dimensional structure no affordable number of orderings finds
enough (README has recalls). So an exact check follows: blocks of rows of the first
ordering keep centre and radius, and a block of queries visits every block of rows that
may still hold something at least as near as the k-th best candidate.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import checkpointed, global_positions, written
from .curve import hilbert_index

#: Orderings, projected dimensions and bits of each.
ORDERINGS, DIMS, BITS = 4, 6, 8
#: Rows of a window; a query is compared with three windows of every ordering.
WINDOW = 256
#: Rows, and queries, of a block of the exact check; rows of a run, which is visited or skipped whole.
BLOCK, RUN = 4096, 256
#: Share by which sums in another order may differ at most, for vectors of up to some thousands of components.
ROUNDING = 1e-11

FOUND = "query_id long, vec_id long, score double"


def usable(vector: Column) -> Column:
    """Not null, not empty, only finite components, and not all zero."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return vector.isNotNull() & F.forall(vector, finite) & F.exists(vector, lambda x: x != 0)


def matrix(column) -> np.ndarray:
    return np.array(column.tolist(), dtype=np.float64) if len(column) else np.empty((0, 0))


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner product of each pair of rows in double precision, components added in order."""
    out = np.zeros(len(a))
    for i in range(a.shape[1]):
        out += a[:, i] * b[:, i]
    return out


def best(queries: np.ndarray, q_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, kth: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query place, id, score) of the k best rows of each query that reach its ``kth``; ties go to smaller ids.

    A matrix product chooses, with room for its rounding; scores are sums in order.
    """
    rough = queries @ vectors.T
    rough[q_ids[:, None] == ids[None, :]] = -np.inf
    room = ROUNDING * np.linalg.norm(queries, axis=1) * np.linalg.norm(vectors, axis=1).max(initial=0.0)
    least = kth
    if len(ids) > k:
        least = np.maximum(kth, np.partition(rough, len(ids) - k, axis=1)[:, len(ids) - k])
    row, col = np.nonzero((rough >= (least - room)[:, None]) & np.isfinite(rough))
    score = inner(queries[row], vectors[col])
    order = np.lexsort((ids[col], -score, row))
    row, col, score = row[order], col[order], score[order]
    keep = (np.arange(len(row)) - np.searchsorted(row, row) < k) & (score >= kth[row])
    return row[keep], ids[col[keep]], score[keep]


def projections(dims: int, ordering: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([seed, ordering])
    return rng.standard_normal((dims, DIMS)), rng.random(DIMS)


def on_sphere(vectors: np.ndarray, asks: np.ndarray, largest: float) -> np.ndarray:
    """Unit points with one more coordinate: of rows sqrt(largest^2 - norm^2), of queries 0."""
    norms = np.linalg.norm(vectors, axis=1)
    last = np.where(asks, 0.0, np.sqrt(np.maximum(0.0, largest**2 - norms**2)))
    return np.concatenate([vectors, last[:, None]], axis=1) / np.where(asks, norms, largest)[:, None]


def curve_keys(points: np.ndarray, ordering: int) -> np.ndarray:
    """Curve index of unit points, under an ordering's projection and shift."""
    turn, shift = projections(points.shape[1], ordering)
    share = 1.0 / (1.0 + np.exp(-1.702 * (points @ turn)))  # near the normal distribution's
    cells = ((share + shift) / 2 * (1 << BITS)).astype(np.int64)
    return hilbert_index(np.clip(cells, 0, (1 << BITS) - 1), BITS)


def _top(frame: DataFrame, k: int) -> DataFrame:
    """The k best distinct rows (query_id, vec_id, score) of every query."""
    once = frame.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return once.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _frame(q_ids, row, ids, score):
    import pandas as pd

    return pd.DataFrame({"query_id": q_ids[row], "vec_id": ids, "score": score}).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})


def candidates(vectors: DataFrame, largest: float, k: int) -> tuple[DataFrame, DataFrame, int]:
    """Best of the windows (query_id, vec_id, score), the first ordering's points by position, and their number.

    ``vectors`` has vec_id, vector and asks: a query is a point beside its row. Windows are
    cut by position, so that any number of equal keys falls into windows of equal size.
    """
    found, first, points = None, None, 0
    for ordering in range(ORDERINGS):

        def keyed(frames: Iterable, ordering=ordering) -> Iterator:
            for frame in frames:
                frame["curve"] = curve_keys(on_sphere(matrix(frame["vector"]), frame["asks"].to_numpy(dtype=bool), largest), ordering) if len(frame) else np.empty(0, np.int64)
                yield frame

        rows = vectors.mapInPandas(keyed, StructType([*vectors.schema.fields, StructField("curve", LongType())]))
        placed, n = global_positions(rows, ["curve", "vec_id", "asks"])
        if first is None:
            first, points = placed, n
        window = F.expr(f"position div {WINDOW}")
        here = placed.where("not asks").select(window.alias("window"), "vec_id", "vector", "asks")
        asking = placed.where("asks").select(F.explode(F.array(window - 1, window, window + 1)).alias("window"), "vec_id", "vector", "asks")

        def near(frame):
            asks = frame["asks"].to_numpy(dtype=bool)
            q, v = frame[asks], frame[~asks]
            q_ids = q["vec_id"].to_numpy()
            if not len(q) or not len(v):
                return _frame(q_ids, np.empty(0, np.int64), [], [])
            return _frame(q_ids, *best(matrix(q["vector"]), q_ids, matrix(v["vector"]), v["vec_id"].to_numpy(), np.full(len(q), -np.inf), k))

        some = here.unionByName(asking).groupBy("window").applyInPandas(near, FOUND)
        found = some if found is None else found.unionByName(some)
    return found, first, points


def balls(rows: DataFrame, block: str, kth: str | None = None) -> DataFrame:
    """Centre and radius of each block of vectors, and the least ``kth``."""

    def of(frame):
        import pandas as pd

        x = matrix(frame["vector"])
        centre = x.mean(axis=0)
        least = [float(frame[kth].min())] if kth else [0.0]
        return pd.DataFrame({block: frame[block].iloc[:1], "centre": [centre], "radius": [float(np.linalg.norm(x - centre, axis=1).max())], "least": least})

    return rows.groupBy(block).applyInPandas(of, f"{block} long, centre array<double>, radius double, least double")


def complete(placed: DataFrame, points: int, bounds: DataFrame, k: int) -> DataFrame:
    """Every row that may be among the k best of a query.

    ``placed`` has rows by position in curve order (the first of ``points``); ``bounds`` has
    query_id, vector, curve and ``kth`` (score of the k-th best so far, minus infinity if
    there are fewer). Blocks of queries meet blocks of rows: for each pair whose balls
    allow it, at most ``BLOCK`` of each are one group. Where nothing can be ruled out that
    is all queries times all rows, in blocks.
    """
    rows = placed.where("not asks").select(F.expr(f"position div {BLOCK}").alias("block"), "vec_id", "vector")
    asking, _ = global_positions(bounds, ["curve", "query_id"])
    asking = checkpointed(asking.select(F.expr(f"position div {BLOCK}").alias("ask_block"), "query_id", "vector", "kth"))
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    q = balls(asking, "ask_block", "kth").select("ask_block", F.col("centre").alias("qc"), F.col("radius").alias("qr"), "least")
    q = q.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(max(0, points - 1) // BLOCK).cast("long"))))
    pairs = q.join(balls(rows, "block").drop("least"), "block")
    length = lambda c: F.sqrt(dot(F.col(c), F.col(c)))
    most = dot(F.col("qc"), F.col("centre")) + length("qc") * F.col("radius") + length("centre") * F.col("qr") + F.col("qr") * F.col("radius")
    pairs = written(pairs.where(most + ROUNDING * (length("qc") + F.col("qr")) * (length("centre") + F.col("radius")) >= F.col("least")).select("block", "ask_block"), "blocks")

    def visit(left, right):
        import pandas as pd

        if not len(left) or not len(right):
            return _frame(np.empty(0, np.int64), np.empty(0, np.int64), [], [])
        ids, vectors = left["vec_id"].to_numpy(), matrix(left["vector"])
        q_ids, queries, kth = right["query_id"].to_numpy(), matrix(right["vector"]), right["kth"].to_numpy(dtype=float).copy()
        lengths, out = np.linalg.norm(queries, axis=1), []
        for at in range(0, len(ids), RUN):
            some = vectors[at : at + RUN]
            centre = some.mean(axis=0)
            radius = np.linalg.norm(some - centre, axis=1).max()
            asks = np.flatnonzero(queries @ centre + lengths * (radius + ROUNDING * (np.linalg.norm(centre) + radius)) >= kth)
            if len(asks):
                row, got, score = best(queries[asks], q_ids[asks], some, ids[at : at + RUN], kth[asks], k)
                out.append(_frame(q_ids, asks[row], got, score))
        return pd.concat(out) if out else _frame(q_ids, np.empty(0, np.int64), [], [])

    group = ["block", "ask_block"]
    left = rows.join(pairs, "block").groupBy(*group)
    right = asking.join(pairs, "ask_block").groupBy(*group)
    return left.cogroup(right).applyInPandas(visit, FOUND)


def nearest(rows: DataFrame, queries: Column, k: int = 20, key: str = "vec_id", vector: str = "embedding", exact: bool = True) -> DataFrame:
    """The k nearest other rows of each query row by inner product: query_id, rank, vec_id, score.

    Ties go to the smaller id; with fewer candidates all are returned. Vectors that are
    null, empty, zero or hold null or non-finite components, those of another length than
    most, and rows with a null key take no part. A row that repeats a key counts once, with
    its best score, and is no candidate of its own key. Other columns are not used. An
    empty table gives no rows. ``exact=False`` returns what the windows alone find.
    """
    spark = rows.sparkSession
    taken = rows.where(F.col(key).isNotNull() & usable(F.col(vector)))
    taken = taken.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"), F.coalesce(queries, F.lit(False)).alias("is_query"))
    squares = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
    size = taken.groupBy(F.size("vector").alias("size")).agg(F.count(F.lit(1)).alias("n"), F.max(F.sqrt(squares)).alias("largest")).orderBy(F.desc("n"), F.desc("size")).head()
    if size is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    taken = taken.where(F.size("vector") == size["size"])
    asks = F.array(F.lit(False), F.lit(True))
    taken = taken.select("vec_id", "vector", F.explode(F.when(F.col("is_query"), asks).otherwise(F.slice(asks, 1, 1))).alias("asks"))
    found, placed, points = candidates(taken, float(size["largest"]), k)
    top = _top(found, k)
    if exact:
        top = checkpointed(top)
        kth = top.where(F.col("rank") == k).select("query_id", F.col("score").alias("kth"))
        asking = placed.where("asks").select(F.col("vec_id").alias("query_id"), "vector", "curve")
        bounds = asking.join(kth, "query_id", "left").withColumn("kth", F.coalesce("kth", F.lit(float("-inf"))))
        more = complete(placed, points, bounds, k)
        top = _top(top.select("query_id", "vec_id", "score").unionByName(more), k)
    return top.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
