"""Diagnostics over stored entries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vectors as V


def reencode_check(jobs: DataFrame, entries: DataFrame, encode: Callable[[DataFrame], DataFrame], tolerance: float = 1e-5) -> DataFrame:
    """Encode stored sequences again and compare: sequence_hash, max_abs_diff, deterministic, error.

    ``jobs`` (sequence_hash, sequence) may be a few picks or all; those that ``entries``
    hasn't are left out. A sequence that can't be encoded now, or gives another width, isn't
    deterministic.
    """
    stored = entries.select("sequence_hash", F.col("embedding").alias("_stored"))
    again = encode(jobs.join(stored.select("sequence_hash"), "sequence_hash", "left_semi")).select("sequence_hash", F.col("embedding").alias("_again"), "error")
    both = stored.join(again, "sequence_hash")
    differ = F.when(F.size("_stored") == F.size("_again"), V.max_difference(F.col("_stored"), F.col("_again")))
    return both.select("sequence_hash", differ.alias("max_abs_diff"), F.coalesce(differ <= tolerance, F.lit(False)).alias("deterministic"), "error")


def reencode_summary(checked: DataFrame) -> DataFrame:
    """One row: how many were tested and passed, and the status success or warning."""
    n, passed = F.count(F.lit(1)), F.count(F.when(F.col("deterministic"), 1))
    return checked.agg(n.alias("tested"), passed.alias("passed"), F.when(n == passed, "success").otherwise("warning").alias("status"))
