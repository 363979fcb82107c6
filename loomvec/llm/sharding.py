"""Shards cut from a Hilbert ordering of document metadata.

Several dimensions are quantised to cells, rows are sorted by the curve index of their
cell, and equal runs are cut. A shard then covers a small box in every dimension, so
that minima and maxima of files prune on any of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import global_positions
from .curve import hilbert_index

#: Bits of each quantised dimension.
BITS = 8


def hash_cell(column: Column, bits: int = BITS) -> Column:
    """A cell for values without an order; null has cell 0."""
    return F.when(column.isNull(), 0).otherwise(1 + F.pmod(F.xxhash64(column), F.lit((1 << bits) - 1))).cast("int")


def size_cell(column: Column, bits: int = BITS) -> Column:
    """A cell on a scale of eighths of doublings; null has cell 0."""
    return F.least(F.lit((1 << bits) - 1), F.floor(8 * F.log2(1 + F.greatest(F.coalesce(column, F.lit(0)), F.lit(0))))).cast("int")


def curve_index(cells: list[Column], bits: int = BITS) -> Column:
    """Hilbert index of quantised dimensions; len(cells) * bits must be at most 63."""

    def index(frame):
        import pandas as pd

        return pd.Series(hilbert_index(frame.to_numpy(), bits))

    names = [f"d{i}" for i in range(len(cells))]
    return _struct_udf(index)(F.struct(*(c.alias(n) for c, n in zip(cells, names, strict=True))))


def _struct_udf(function):
    import pandas as pd

    def index(frame: pd.DataFrame) -> pd.Series:
        return function(frame)

    index.__annotations__ = {"frame": pd.DataFrame, "return": pd.Series}
    return F.pandas_udf(index, "long")


def shard(rows: DataFrame, cells: list[Column], ties: list[str], shards: int, bits: int = BITS) -> DataFrame:
    """``rows`` with ``curve``, ``shard`` and ``slot``; rows of shards differ by one at most.

    Rows are ordered by curve index, then by ``ties``. Row i of n goes to shard
    floor(i * shards / n); ``slot`` counts from 0 in each shard. Repeated rows take
    slots of their own; with fewer rows than shards some stay empty, and an empty table
    gives no rows. Null cells and nulls in ties come first. Cells come from columns, so
    very long texts cost no more than their size. Input columns named ``curve``, ``shard``,
    ``slot`` or ``position`` are replaced (``position``: dropped).
    """
    keyed = rows.withColumn("curve", curve_index([F.coalesce(c, F.lit(0)) for c in cells], bits)).drop("shard", "slot")
    placed, total = global_positions(keyed, ["curve", *ties])
    exact = F.expr(f"position * {shards} div {max(total, 1)}")
    first = F.expr(f"(shard * {total} + {shards} - 1) div {shards}")
    return placed.withColumn("shard", exact.cast("int")).withColumn("slot", F.col("position") - first).drop("position")
