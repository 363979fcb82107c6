"""Dedup-then-mean per group, and group counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_vectors(rows: DataFrame, group: str, content: str, vector: str) -> DataFrame:
    """One row for each group and content hash."""
    return rows.groupBy(group, content).agg(F.first(vector).alias(vector))


#: Elements that one hash aggregate adds; more columns leave compiled code.
ELEMENTS = 64


def vector_sums(rows: DataFrame, group: str, vector: str, dim: int, extra: list[Column] | None = None, how=F.sum) -> DataFrame:
    """Element-wise sum of each group (``sums``), and the aggregates ``extra``.

    Vectors of up to ``ELEMENTS`` are one aggregate of a column for each element. Wider ones
    are cut into such blocks, a row each, and put together again: any width stays in
    compiled code with partial sums before the shuffle, and a group of any size is never
    held at once.
    """
    extra = extra or []
    add = lambda c, n: F.array(*(how(F.get(c, F.lit(i)).cast("double")) for i in range(n))).alias("sums")
    if dim <= ELEMENTS:
        return rows.groupBy(group).agg(*extra, add(F.col(vector), dim))
    cut = F.transform(F.sequence(F.lit(0), F.lit(-(-dim // ELEMENTS) - 1)), lambda b: F.slice(F.col(vector), b * ELEMENTS + 1, F.lit(ELEMENTS)))
    blocks = rows.select(group, F.posexplode(cut).alias("_b", "_v")).groupBy(group, "_b").agg(add(F.col("_v"), ELEMENTS))
    whole = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("_b", "sums"))), lambda x: x["sums"]))
    out = blocks.groupBy(group).agg(F.slice(whole, 1, dim).alias("sums"))
    return rows.groupBy(group).agg(*extra).join(out, group) if extra else out


def vector_mean(rows: DataFrame, group: str, vector: str, dim: int) -> DataFrame:
    """Element-wise mean of each group, with its number of members."""
    if dim <= ELEMENTS:
        return vector_sums(rows, group, vector, dim, [F.count(F.lit(1)).alias("members")], F.avg).select(group, "members", F.col("sums").alias("mean"))
    # a count beside the elements needs no join
    counted = rows.select(group, F.concat(F.array(F.lit(1.0)), F.transform(vector, lambda x: x.cast("double"))).alias("_v"))
    sums = vector_sums(counted, group, "_v", dim + 1)
    mean = F.transform(F.slice("sums", 2, dim), lambda x: x / F.get("sums", F.lit(0)))
    return sums.select(group, F.get("sums", F.lit(0)).cast("long").alias("members"), mean.alias("mean"))


def group_counts(rows: DataFrame, group: str, content: str, ok: Column) -> DataFrame:
    """Rows, distinct, successful, failed and removed duplicates of each group."""
    unique = F.count_distinct(F.when(ok, F.col(content)))
    return rows.groupBy(group).agg(
        F.count(F.lit(1)).alias("num_targets"),
        F.count_distinct(content).alias("num_unique_targets"),
        F.count(F.when(ok, 1)).alias("num_successful"),
        F.count(F.when(~ok, 1)).alias("num_failed"),
        (F.count(F.when(ok, 1)) - unique).alias("num_duplicates_removed"),
    )


def project(rows: DataFrame, group: str, vector: str, weight: list[list[float]], bias: list[float], eps: float = 1e-5) -> DataFrame:
    """``W x + b`` and layer normalisation of aggregated vectors, Arrow batches through numpy."""
    import numpy as np

    w, b = np.array(weight), np.array(bias)

    def of(frames):
        import pandas as pd

        for frame in frames:
            x = np.array(frame[vector].tolist(), dtype=float).reshape(len(frame), w.shape[1])
            y = x @ w.T + b
            y = (y - y.mean(axis=1, keepdims=True)) / np.sqrt(y.var(axis=1, keepdims=True) + eps)
            yield pd.DataFrame({group: frame[group], "projected": list(y)})

    kind = dict(rows.dtypes)[group]
    return rows.select(group, vector).mapInPandas(of, f"{group} {kind}, projected array<double>")


#: Why a group has no vector. Kept with the group, as its key is absent from the vectors.
NO_VECTOR = "no successful member with a vector"


def group_summary(rows: DataFrame, vectors: DataFrame, group: str, content: str, name: str, order: str, ok: Column, dim: int) -> DataFrame:
    """One row a group: first name that isn't empty, counts, method, status, error and width.

    ``vectors`` has ``content`` of all stored vectors; a member is successful if ``ok`` holds
    and its vector is stored. ``order`` decides which name is first.
    """
    have = vectors.select(content).distinct().withColumn("_have", F.lit(True))
    named = F.nullif(F.trim(F.col(name)), F.lit(""))
    joined = rows.select(group, content, name, order, ok.alias("_ok")).join(have, content, "left")
    good = F.col("_ok") & F.coalesce("_have", F.lit(False))
    unique, successful = F.count_distinct(F.when(good, F.col(content))), F.count(F.when(good, 1))
    counts = joined.groupBy(group).agg(
        F.min_by(F.col(name), F.when(named.isNotNull(), F.col(order))).alias(name), F.count(F.lit(1)).alias("num_targets"), unique.alias("num_unique_targets"),
        successful.alias("num_successful"), F.count(F.when(~F.col("_ok"), 1)).alias("num_failed"), (successful - unique).alias("num_duplicates_removed"),
    )
    some = F.col("num_unique_targets") > 0
    return counts.withColumns({"aggregation_method": F.lit("mean"), "status": F.when(some, "success").otherwise("failed"), "error": F.when(~some, NO_VECTOR), "embedding_dim": F.when(some, dim).otherwise(0)})


def checked_mean(mean: DataFrame, vector: str) -> DataFrame:
    """``mean`` as it is; a vector that isn't finite or is all zero ends the job."""
    bad = ~F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) | ~F.exists(vector, lambda x: x != 0)
    checked = F.when(bad, F.raise_error(F.lit("the mean of a group isn't finite or is zero"))).otherwise(F.col(vector))
    return mean.withColumn(vector, checked)


def load_projection(spark, path: str, input_dim: int, output_dim: int) -> tuple[list[list[float]], list[float]]:
    """Weight and bias of a trained projection from Parquet rows (output, weight array<double>, bias, trained)."""
    found = spark.read.parquet(path).orderBy("output").collect()  # output_dim rows
    if [r["output"] for r in found] != list(range(output_dim)) or any(len(r["weight"]) != input_dim for r in found):
        raise ValueError(f"a projection of {output_dim} rows of {input_dim} weights is needed")
    if not all(r["trained"] for r in found):
        raise ValueError("the projection wasn't trained")
    return [list(r["weight"]) for r in found], [r["bias"] for r in found]
