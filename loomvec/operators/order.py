"""Gapless numbers of rows in one global order, without a single partition or the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def numbered(rows: DataFrame, major: Column, minor: list, name: str = "place", cost: Column | None = None) -> DataFrame:
    """``rows`` with ``name`` from 1, ordered by ``major`` (a number), then by ``minor``.

    Rows are numbered within each value of ``major``; the values' counts alone are summed in
    one task, so ``major`` should have few values against the rows, and none should hold
    most of them. With ``cost``, ``cost_before`` is the cost of all rows before.
    """
    keyed = rows.withColumn("_major", major).withColumn("_cost", (F.lit(0) if cost is None else cost).cast("long"))
    counts = keyed.groupBy("_major").agg(F.count(F.lit(1)).alias("_n"), F.sum("_cost").alias("_c"))
    run = Window.orderBy("_major")
    before = counts.select("_major", (F.sum("_n").over(run) - F.col("_n")).alias("_before"), (F.sum("_c").over(run) - F.col("_c")).alias("_paid"))
    inside = Window.partitionBy("_major").orderBy(*minor)
    own = F.row_number().over(inside)
    out = keyed.withColumn("_own", own)
    if cost is not None:
        out = out.withColumn("_spent", F.sum("_cost").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_cost"))
    out = out.join(before, "_major").withColumn(name, (F.col("_before") + F.col("_own")).cast("long"))
    if cost is not None:
        out = out.withColumn("cost_before", F.col("_paid") + F.col("_spent"))
    return out.drop("_major", "_own", "_before", "_cost", "_paid", "_spent")


def numbered_ids(rows: DataFrame, key: str, name: str = "place", width: int = 4096) -> DataFrame:
    """As ``numbered``, by an integer key."""
    return numbered(rows, F.floor(F.col(key) / width), [key], name)


#: Leading hexadecimal digits of a hash that split rows of equal cost.
SPLIT = 3


def by_cost(rows: DataFrame, cost: Column, key: str, name: str = "place", paid: Column | None = None) -> DataFrame:
    """Rows numbered from 1, dearest first, ties by ``key``, a hexadecimal hash.

    Rows of one cost are split by the hash's first digits, so that a cost that most rows
    have is no hot key; the order is that of (cost descending, key). ``paid`` adds
    ``cost_before``, the sum of this cost over all rows before.
    """
    split = F.conv(F.substring(key, 1, SPLIT), 16, 10).cast("long")
    return numbered(rows, -cost.cast("long") * 16**SPLIT + split, [key], name, paid)


def balanced(rows: DataFrame, cost: Column, key: str, parts: int, name: str = "part") -> DataFrame:
    """Rows in ``parts`` partitions of about equal cost, dearest rows first, with the number of their part.

    The running cost is cut at equal steps: a part's cost exceeds the mean by less than
    the cost of one row. Spark sends each part to the partition of its number.
    """
    placed = by_cost(rows.withColumn("_paid_for", cost.cast("long")), F.col("_paid_for"), key, "_place", F.col("_paid_for"))
    total = rows.agg(F.coalesce(F.sum(cost.cast("long")), F.lit(0)).alias("total")).scalar()
    part = F.floor(F.col("cost_before") * parts / F.greatest(total, F.lit(1)))
    return placed.withColumn(name, F.least(part, F.lit(parts - 1)).cast("int")).drop("_paid_for", "_place", "cost_before").repartitionById(parts, F.col(name))


def first_of_each(rows: DataFrame, value: str, order: str) -> DataFrame:
    """Distinct values that aren't null, each with the place where it is first seen."""
    return rows.where(F.col(value).isNotNull()).groupBy(value).agg(F.min(order).alias("first_seen"))
