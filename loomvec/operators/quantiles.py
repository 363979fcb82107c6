"""Exact order statistics of a column from histograms that are refined where wanted ranks lie."""

from __future__ import annotations

from math import ceil, floor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bins of a range in a round, and values of a bin that are few enough to be taken.
BINS, FEW = 1024, 4096


def values_at(rows: DataFrame, column: str, ranks: list[int]) -> dict[int, float]:
    """The values at ranks (from 0) of the ascending order.

    Every round is one scan with a small aggregate: counts, least and largest of the bins
    of all ranges that still hold a wanted rank. A bin whose values are all equal is
    done, however many rows hold them; one with few values is read. The driver sees a
    bounded number of bins for each wanted rank, and no task more than ``FEW`` values.
    """
    x = F.col(column).cast("double")
    whole = rows.where(x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))).select(x.alias("x"))
    about = whole.agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("low"), F.max("x").alias("high")).head()
    wanted, out = sorted(set(ranks)), {}
    if not about["n"] or not wanted:
        return out
    if wanted[0] < 0 or wanted[-1] >= about["n"]:
        raise ValueError("a rank outside the rows")
    ranges = [(about["low"], about["high"], 0, about["n"], wanted)]  # least, largest, rows before, rows, ranks
    few: list[tuple] = []
    while ranges:
        open_, ranges = ranges, []
        for low, high, before, n, own in open_:
            if low == high:
                out |= dict.fromkeys(own, low)
            elif n <= FEW:
                few.append((low, high, before, own))
            else:
                ranges.append((low, high, before, n, own))
        if not ranges:
            break
        number, bin_ = F.lit(None).cast("int"), F.lit(None).cast("long")
        for i, (low, high, *_) in enumerate(ranges):
            inside = F.col("x").between(low, high)
            # halves, as a range may be wider than the largest double
            share = (F.col("x") / 2 - F.lit(low / 2)) / F.lit(high / 2 - low / 2)
            number = F.when(inside, i).otherwise(number)
            bin_ = F.when(inside, F.least(F.floor(share * BINS), F.lit(BINS - 1))).otherwise(bin_)
        found = whole.select("x", number.alias("range"), bin_.alias("bin")).where("range is not null").groupBy("range", "bin")
        bins = found.agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("low"), F.max("x").alias("high")).collect()
        for i, (_, _, before, _, own) in enumerate(ranges[:]):
            at = before
            for b in sorted((b for b in bins if b["range"] == i), key=lambda b: b["bin"]):
                mine = [r for r in own if at <= r < at + b["n"]]
                if mine:
                    ranges.append((b["low"], b["high"], at, b["n"], mine))
                at += b["n"]
        ranges = ranges[i + 1 :]
    for low, high, before, own in few:
        got = whole.where(F.col("x").between(low, high)).agg(F.sort_array(F.collect_list("x")).alias("v")).select(*(F.get("v", F.lit(r - before)).alias(f"r{r}") for r in own)).head()
        out |= {r: got[f"r{r}"] for r in own}
    return out


def order_statistics(rows: DataFrame, column: str, shares: dict[str, float], lower: dict[str, float] | None = None) -> DataFrame:
    """One row: for each name of ``shares`` the value at that share, interpolated, and for each of ``lower`` the lower one.

    Exact, as of all values sorted: the share q lies at rank q * (n - 1); the lower value of
    q is the first one with at least q of all rows up to it. Values that are null or not
    finite don't count; without any, all are null. ``rows`` is scanned once a round, so
    pass a written table if it is costly. Columns stay in the order of their names here.
    """
    lower = lower or {}
    if any(not 0 <= q <= 1 for q in [*shares.values(), *lower.values()]):
        raise ValueError("a share is between 0 and 1")
    x = F.col(column).cast("double")
    n = rows.where(x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))).count()
    names = [*shares, *lower]
    if not n:
        return rows.sparkSession.createDataFrame([(None,) * len(names)], ", ".join(f"`{c}` double" for c in names))
    places = {c: q * (n - 1) for c, q in shares.items()}
    below = {c: max(0, ceil(q * n) - 1) for c, q in lower.items()}
    value = values_at(rows, column, [r for p in places.values() for r in (floor(p), min(floor(p) + 1, n - 1))] + list(below.values()))
    row = [value[floor(p)] + (p - floor(p)) * (value[min(floor(p) + 1, n - 1)] - value[floor(p)]) for p in places.values()] + [value[r] for r in below.values()]
    return rows.sparkSession.createDataFrame([tuple(map(float, row))], ", ".join(f"`{c}` double" for c in names))
