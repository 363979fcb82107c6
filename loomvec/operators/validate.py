"""Checks of written artifacts: read back from CSV and Parquet, one aggregate a frame, anti-joins between frames."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import sequences as S
from ..functions import vectors as V
from ..sources.sinks import PROVENANCE
from .groups import vector_mean
from .scratch import saved

ARTIFACTS = {"rows": "csv", "failed_rows": "csv", "groups": "csv", "row_vectors": "parquet", "group_vectors": "parquet", "entries": "parquet"}


@dataclass(frozen=True)
class Check:
    """How many cases are looked at, and how many of them fail."""

    name: str
    seen: Column
    bad: Column


def many(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def each(name: str, bad: Column, among: Column | None = None) -> Check:
    """A condition that no row (of those ``among``) may meet; an unknown one counts as met."""
    among = F.lit(True) if among is None else among
    return Check(name, many(among), many(among & F.coalesce(bad, F.lit(True))))


def checked(frame: DataFrame, checks: list[Check]) -> DataFrame:
    """(name, seen, bad) of all checks of one frame, in one aggregate."""
    one = frame.agg(*(c for i, x in enumerate(checks) for c in (x.seen.cast("long").alias(f"s{i}"), x.bad.cast("long").alias(f"b{i}"))))
    rows = F.array(*(F.struct(F.lit(x.name).alias("name"), F.col(f"s{i}").alias("seen"), F.coalesce(f"b{i}", F.lit(0)).alias("bad")) for i, x in enumerate(checks)))
    return one.select(F.explode(rows).alias("c")).select("c.*")


def missing(name: str, left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct keys of ``left`` that ``right`` lacks."""
    keys = left.select(key).distinct()
    have = right.select(key).distinct().withColumn("_have", F.lit(True))
    return checked(keys.join(have, key, "left"), [each(name, F.col("_have").isNull())])


def equal_counts(name: str, left: DataFrame, right: DataFrame) -> DataFrame:
    n = left.select(F.lit(1).alias("w")).unionByName(right.select(F.lit(-1).alias("w")))
    return checked(n, [Check(name, many(F.col("w") == 1), F.abs(F.coalesce(F.sum("w"), F.lit(0))))])


def _read(spark: SparkSession, folder: str) -> tuple[dict[str, DataFrame], list[tuple[str, int, int]]]:
    found, there = {}, []
    for name, kind in ARTIFACTS.items():
        try:
            frame = spark.read.option("header", True).option("escape", '"').csv(f"{folder}/{name}") if kind == "csv" else spark.read.parquet(f"{folder}/{name}")
            found[name] = frame
            there.append((f"{name} can be read", 1, 0))
        except AnalysisException:
            there.append((f"{name} can be read", 1, 1))
    return found, there


def validate(spark: SparkSession, folder: str, dim: int) -> DataFrame:
    """One row for each check of what ``sinks.write_artifacts`` and a store's entries left in ``folder``: name, seen, bad.

    ``rows``, ``failed_rows`` and ``groups`` are CSV; ``row_vectors`` (source_row_index,
    row_valid, vector_index), ``group_vectors`` (nsc_id, mean) and ``entries``
    (sequence_hash, embedding) are Parquet. An artifact that can't be read is a failed
    check, and then no other check is made. Means are computed again from the entries.
    """
    found, there = _read(spark, folder)
    first = spark.createDataFrame(there, "name string, seen long, bad long")
    if len(found) < len(ARTIFACTS):
        return first
    rows, failed, groups, row_vectors, group_vectors, entries = (found[n] for n in ARTIFACTS)
    if lacking := [c for c in PROVENANCE if c not in rows.columns]:
        return first.unionByName(spark.createDataFrame([(f"rows has the column {c}", 1, 1) for c in lacking], first.schema))
    # most of the text files is events, which no check looks at: each file is parsed once, and what is looked at is kept
    rows = saved(rows.select("source_row_index", "nsc_id", "sequence_length_mismatch", "sequence_hash", "status", "error"), "read-rows")
    failed = saved(failed.select("source_row_index"), "read-failed")
    ok, gone = F.col("status") == "success", F.col("status") == "failed"
    some_text = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    of_rows = [
        each("every row succeeded or failed", ~(ok | gone)),
        each("every failed row says why", ~some_text("error"), gone),
        each("every successful row has a hash", ~F.col("sequence_hash").rlike("^[0-9a-f]{64}$"), ok),
        each("length mismatches are True, False or empty", ~F.coalesce("sequence_length_mismatch", F.lit("")).isin("True", "False", "")),
        Check("row numbers don't repeat", F.count(F.lit(1)), F.count(F.lit(1)) - F.count_distinct("source_row_index")),
    ]
    of_groups = [
        each("group keys are canonical", ~S.canonical_id(F.col("nsc_id")).eqNullSafe(F.col("nsc_id")), some_text("nsc_id")),
        Check("groups don't repeat", F.count(F.lit(1)), F.count(F.lit(1)) - F.count_distinct(F.coalesce("nsc_id", F.lit("")))),
        each("members of a group add up", F.col("num_duplicates_removed").cast("long") != F.col("num_successful").cast("long") - F.col("num_unique_targets").cast("long")),
    ]
    vector = lambda c, label: [each(f"{label} have {dim} elements", F.size(c) != dim), each(f"{label} are finite and not zero", ~V.is_valid(F.col(c), dim))]
    of_entries = [*vector("embedding", "entries"), Check("entries don't repeat", F.count(F.lit(1)), F.count(F.lit(1)) - F.count_distinct("sequence_hash"))]
    valid = F.col("row_valid")
    n_valid = many(valid)
    of_index = [
        each("only valid rows have an index", F.col("vector_index").isNull() == valid),
        Check("the index counts valid rows from 0 without gaps", n_valid, n_valid - F.count_distinct("vector_index") + F.coalesce(F.abs(F.max("vector_index") + 1 - n_valid), F.lit(0)) + F.coalesce(F.abs(F.min("vector_index")), F.lit(0))),
    ]
    hashes = rows.where(ok).select("nsc_id", "sequence_hash")
    key = rows.select(F.col("source_row_index").cast("long").alias("source_row_index"), ok.alias("_ok"))
    aligned = key.join(row_vectors.select(F.col("source_row_index").cast("long").alias("source_row_index"), "row_valid"), "source_row_index", "full")
    members = hashes.distinct().join(entries, "sequence_hash")
    again = vector_mean(members, "nsc_id", "embedding", dim).select("nsc_id", F.col("mean").alias("again"))
    both = group_vectors.select("nsc_id", F.col("mean").cast("array<double>").alias("mean")).join(again, "nsc_id", "full")
    with_vector = groups.where(F.col("status") == "success")
    parts = [
        first, checked(rows, of_rows), checked(groups, of_groups), checked(entries, of_entries), checked(group_vectors, vector("mean", "group vectors")), checked(row_vectors, of_index),
        equal_counts("failed_rows holds every failed row", rows.where(gone), failed),
        missing("failed rows are rows", failed, rows.where(gone), "source_row_index"),
        missing("every hash of a successful row has an entry", hashes, entries, "sequence_hash"),
        checked(aligned, [each("the mask covers all rows and is true where a row succeeded", ~F.col("_ok").eqNullSafe(F.col("row_valid")))]),
        missing("every group of the rows is a group", rows.select(F.coalesce("nsc_id", F.lit("")).alias("g")), groups.select(F.coalesce("nsc_id", F.lit("")).alias("g")), "g"),
        equal_counts("groups with a vector are those with a success", with_vector, group_vectors),
        checked(both, [each("group vectors are the means of their entries", ~V.close(F.col("mean"), F.col("again")))]),
    ]
    return reduce(DataFrame.unionByName, parts)
