"""Hard negatives by a vector-approximation file.

Every dimension is cut into cells, and a row is kept as one cell number a dimension
beside its exact integers. For an anchor a table holds the least and the largest
contribution of every cell of every dimension, so that sums of looked-up entries bound a
row's score from below and above. Only rows whose bounds may put them among the wanted
ones are scored exactly: first the nearest rows of the anchor's own label, then the rows
of other labels that may lie in a window below one of those scores.

Rows and anchors are dealt to blocks of a fixed size; a block of each is one task's group.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import global_positions, written

#: Cells of a dimension (at most 256), and rows or anchors of a block.
CELLS, BLOCK = 64, 1024
#: Anchors whose tables a task holds at a time.
TABLES = 32
#: Largest size of a component: sums of some hundred products then fit 64 bits.
LARGEST = 1 << 27


def integers(vector: Column, scale: int) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale))


def usable(vector: Column, scale: int) -> Column:
    """Not null, not empty, and only finite components whose integers are at most ``LARGEST`` in size."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) * scale <= LARGEST)
    return vector.isNotNull() & (F.size(vector) > 0) & F.forall(vector, fine)


def cell_ends(rows: DataFrame, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest integer of every cell, (dimensions, cells): cells of about equally many rows.

    One row a dimension reaches the driver. Percentiles may be rough: they only decide how
    tight the bounds are, and the outer ends are those of all rows.
    """
    shares = F.array(*(F.lit(i / cells) for i in range(1, cells)))
    each = rows.select(F.posexplode("x").alias("i", "v")).groupBy("i")
    found = each.agg(F.min("v").alias("low"), F.max("v").alias("high"), F.percentile_approx("v", shares, F.lit(1000)).alias("cuts")).orderBy("i").collect()
    starts = np.array([[r["low"], *r["cuts"]] for r in found], dtype=np.int64)
    ends = np.concatenate([starts[:, 1:] - 1, np.array([[r["high"]] for r in found], dtype=np.int64)], axis=1)
    return starts, np.maximum(starts, ends)


def to_cells(x: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Cell of every component (n, dimensions): the last one that starts at or below it."""
    out = np.empty(x.shape, np.uint8)
    for d in range(x.shape[1]):
        out[:, d] = np.searchsorted(starts[d], x[:, d], side="right") - 1
    return out


def tables(anchors: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest contribution of each cell to the score of each anchor: (anchors, dimensions, cells)."""
    a, b = anchors[:, :, None] * starts, anchors[:, :, None] * ends
    return np.minimum(a, b), np.maximum(a, b)


def bounds(anchors: np.ndarray, cells: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the scores (anchors, rows), as sums of table entries."""
    least, most = tables(anchors, starts, ends)
    lower = np.zeros((len(anchors), len(cells)), np.int64)
    upper = lower.copy()
    for d in range(cells.shape[1]):
        lower += least[:, d].take(cells[:, d], axis=1)
        upper += most[:, d].take(cells[:, d], axis=1)
    return lower, upper


def kth_largest(values: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest of each row; of fewer the least value that the type has."""
    if values.shape[1] < k:
        return np.full(len(values), np.iinfo(values.dtype).min)
    return np.partition(values, values.shape[1] - k, axis=1)[:, values.shape[1] - k]


NEVER = np.iinfo(np.int64).min


def _stack(column, kind=np.int64) -> np.ndarray:
    return np.array(column.tolist(), dtype=kind)


def _scores(anchors: np.ndarray, rows: np.ndarray, a: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Exact scores of the pairs (a, r)."""
    return np.einsum("ij,ij->i", anchors[a], rows[r])


def _best(group: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the first k of each group: higher scores first, ties by smaller ids."""
    order = np.lexsort((ids, -score, group))
    g = group[order]
    return order[np.arange(len(g)) - np.searchsorted(g, g) < k]


def grid(rows: DataFrame, anchors: DataFrame, pairs: DataFrame, visit: Callable, schema: str) -> DataFrame:
    """``visit`` of every block of rows with every block of anchors that ``pairs`` (block, ask_block) names."""
    names = ["block", "ask_block"]
    again = pairs.select(*(F.col(n).alias(n) for n in names))  # columns of its own on the other side
    return rows.join(pairs, "block").groupBy(*names).cogroup(anchors.join(again, "ask_block").groupBy(*names)).applyInPandas(visit, schema)


def first_of(rows: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The first k rows of each key by score and id, with ``rank``; Spark cuts each task's rows to k a key before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def mine(
    rows: DataFrame, anchors: Column, label: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, scale: int = 256,
    key: str = "vec_id", vector: str = "embedding", cells: int = CELLS, block: int = BLOCK,
) -> DataFrame:
    """Negatives of every anchor and positive: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    A score is the inner product of integers floor(scale * component). Positives are the
    first rows of the anchor's label other than itself; negatives the first rows of other
    labels with low * positive_score <= 100 * score <= high * positive_score. Higher scores
    come first, ties by smaller key; fewer are all.

    Rows with a null key or label, or a vector that is null, empty, of another length than
    most, holds null or non-finite components or one beyond ``LARGEST``, take no part. Of
    rows that repeat a key the one with the smallest label, then vector, counts. An anchor
    without positives gives no rows, nor does an empty table. Other columns are not used.
    """
    spark = rows.sparkSession
    if not 2 <= cells <= 256:
        raise ValueError("a dimension has 2 to 256 cells")
    taken = rows.select(F.col(key).cast("long").alias("vec_id"), label.cast("long").alias("label"), F.coalesce(anchors, F.lit(False)).alias("asks"), F.col(vector).alias("_v"))
    taken = taken.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("_v"), scale))
    taken = taken.groupBy("vec_id").agg(F.min(F.struct("label", integers(F.col("_v"), scale).alias("x"), "asks")).alias("r")).select("vec_id", "r.*")
    placed, n = global_positions(taken, ["label", "vec_id"])
    size = placed.groupBy(F.size("x").alias("size")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("size")).head()
    if size is None:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    placed = placed.where(F.size("x") == size["size"])
    starts, ends = cell_ends(placed, cells)

    def approximate(frames):
        for frame in frames:
            if len(frame):
                frame["cells"] = [c.tobytes() for c in to_cells(_stack(frame["x"]), starts)]
            else:
                frame["cells"] = []
            yield frame

    numbered = placed.select("vec_id", "label", "asks", "x", F.expr(f"position div {block}").alias("block"))
    numbered = written(numbered.mapInPandas(approximate, "vec_id long, label long, asks boolean, x array<long>, block long, cells binary"), "approximations")
    file = numbered.drop("asks")
    asking, asked = global_positions(numbered.where("asks").select("vec_id", "label", "x", "block"), ["label", "vec_id"])
    asking = asking.select(F.expr(f"position div {block}").alias("ask_block"), F.col("vec_id").alias("anchor_id"), F.col("label").alias("anchor_label"), F.col("x").alias("anchor"))
    asking = written(asking, "anchors")

    def arrays(left, right):
        x = _stack(left["x"])
        return left["vec_id"].to_numpy(), left["label"].to_numpy(), x, np.frombuffer(b"".join(left["cells"]), np.uint8).reshape(x.shape), right["anchor_id"].to_numpy(), right["anchor_label"].to_numpy(), _stack(right["anchor"])

    def frame_of(columns: dict):
        import pandas as pd

        return pd.DataFrame({c: np.concatenate(v) if v else np.empty(0, np.int64) for c, v in columns.items()}).astype("int64")

    def same_label(left, right):
        out = {"anchor_id": [], "vec_id": [], "score": []}
        if len(left) and len(right):
            ids, labels, x, approx, a_ids, a_labels, a = arrays(left, right)
            for at in range(0, len(a_ids), TABLES):
                some = slice(at, at + TABLES)
                wanted = (labels == a_labels[some, None]) & (ids != a_ids[some, None])
                there = np.flatnonzero(wanted.any(axis=0))
                if not len(there):
                    continue
                wanted = wanted[:, there]
                lower, upper = bounds(a[some], approx[there], starts, ends)
                least = kth_largest(np.where(wanted, lower, NEVER), positives)
                ask, row = np.nonzero(wanted & (upper >= least[:, None]))
                row = there[row]
                score = _scores(a[some], x, ask, row)
                keep = _best(ask, score, ids[row], positives)
                for c, v in (("anchor_id", a_ids[some][ask]), ("vec_id", ids[row]), ("score", score)):
                    out[c].append(v[keep])
        return frame_of(out)

    def windows(left, right):
        out = {"anchor_id": [], "positive_score": [], "vec_id": [], "score": []}
        if len(left) and len(right):
            ids, labels, x, approx, a_ids, a_labels, a = arrays(left, right)
            tops = right["tops"].tolist()
            for at in range(0, len(a_ids), TABLES):
                some = slice(at, at + TABLES)
                lower, upper = bounds(a[some], approx, starts, ends)
                for i in range(len(lower)):
                    other = labels != a_labels[at + i]
                    for top in tops[at + i]:
                        may = other & (100 * upper[i] >= low * top) & (100 * lower[i] <= high * top)
                        sure = may & (100 * lower[i] >= low * top) & (100 * upper[i] <= high * top)
                        least = kth_largest(lower[i][sure][None, :], negatives)[0]
                        row = np.flatnonzero(may & (upper[i] >= least))
                        score = _scores(a[at : at + TABLES], x, np.full(len(row), i), row)
                        inside = (100 * score >= low * top) & (100 * score <= high * top)
                        row, score = row[inside], score[inside]
                        keep = _best(np.zeros(len(row), np.int64), score, ids[row], negatives)
                        out["anchor_id"].append(np.full(len(keep), a_ids[at + i]))
                        out["positive_score"].append(np.full(len(keep), top))
                        out["vec_id"].append(ids[row[keep]])
                        out["score"].append(score[keep])
        return frame_of(out)

    # rows of one label are neighbours by position, so each block of anchors meets one run of blocks
    reach = file.groupBy("label").agg(F.min("block").alias("a"), F.max("block").alias("b"))
    asks = asking.groupBy("ask_block", F.col("anchor_label").alias("label")).agg(F.count(F.lit(1)).alias("_n"))
    near = asks.join(reach, "label").groupBy("ask_block").agg(F.min("a").alias("a"), F.max("b").alias("b")).select("ask_block", F.explode(F.sequence("a", "b")).alias("block"))
    near = written(near, "blocks")
    found = first_of(grid(file, asking, near, same_label, "anchor_id long, vec_id long, score long"), ["anchor_id"], positives)
    found = written(found.select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")

    tops = found.groupBy("anchor_id").agg(F.collect_set("positive_score").alias("tops"))  # at most ``positives`` of them
    every = spark.range(0, max(1, -(-asked // block))).select(F.col("id").alias("ask_block"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit((n - 1) // block).cast("long"))).alias("block"))
    inside = grid(file, asking.join(tops, "anchor_id"), every, windows, "anchor_id long, positive_score long, vec_id long, score long")
    inside = first_of(inside, ["anchor_id", "positive_score"], negatives)
    named = inside.select("anchor_id", "positive_score", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return found.join(named, ["anchor_id", "positive_score"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
