"""Readers of the entity-sequence relation."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

REQUIRED = ("nsc_id", "sequence")


class InputError(ValueError):
    """The input can't be used at all."""


def canonical_columns(names: list[str]) -> list[str]:
    """Trimmed lower-case names; two that fall together are an error."""
    out = [n.strip().lower() for n in names]
    if twice := sorted({n for n in out if out.count(n) > 1}):
        raise InputError(f"column names collide: {', '.join(twice)}")
    return out


def read_csv(spark: SparkSession, path: str, required: tuple[str, ...] = REQUIRED, lines: bool = False) -> DataFrame:
    """All columns as text, with ``source_row_index`` in file order; no type is inferred.

    ``lines`` says that no field holds a line end: large files are then read in splits.

    The header is read as a row of its own, since Spark renames headers that differ in
    case only.
    """
    options = {"header": False, "escape": '"', "multiLine": not lines, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    try:
        head = spark.read.options(**options).csv(path).head()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            raise InputError(f"there is no input at {path}") from None
        raise
    if head is None:
        raise InputError("the input is empty")
    names = [(x or "").lstrip("﻿") for x in head]
    low = [n.strip().lower() for n in names]
    if missing := [r for r in required if r not in low]:
        raise InputError(f"required columns are missing: {', '.join(missing)}")
    names = canonical_columns(names)
    schema = ", ".join(f"`{n}` string" for n in names)
    frame = spark.read.options(**options | {"header": True, "enforceSchema": True}).schema(schema).csv(path)
    return with_row_index(frame)


def with_row_index(frame: DataFrame) -> DataFrame:
    """Gapless ``source_row_index`` of rows as they stand in their files, files in order of their paths.

    For a frame straight from a file reader. Each split of a file has a number of rows and
    a first place, one row of a small table that is joined back by the split's metadata:
    no literal grows with the input, and the order doesn't depend on how splits are packed
    into tasks. Parquet files know the place of each row, so only the files are counted.
    """
    places = "row_index" in frame.select("_metadata.*").columns
    tagged = frame.withColumns({"_f": F.col("_metadata.file_path"), "_s": F.lit(0).cast("long") if places else F.col("_metadata.file_block_start")})
    tagged = tagged.withColumn("_i", F.col("_metadata.row_index") if places else F.monotonically_increasing_id())
    splits = tagged.groupBy("_f", "_s").agg(F.count(F.lit(1)).alias("_n"), F.min("_i").alias("_first"))
    before = F.sum("_n").over(Window.orderBy("_f", "_s")) - F.col("_n")  # a row a split
    starts = splits.select("_f", "_s", (before - F.col("_first")).alias("_shift"))
    return tagged.join(starts, ["_f", "_s"]).withColumn("source_row_index", (F.col("_i") + F.col("_shift")).cast("long")).drop("_f", "_s", "_i", "_shift")


def file_hash(spark: SparkSession, path: str) -> DataFrame:
    """path, size and SHA-256 of the raw bytes of files."""
    return spark.read.format("binaryFile").load(path).select("path", F.col("length").alias("size_bytes"), F.sha2("content", 256).alias("sha256"))


def filter_rows(frame: DataFrame, ids: list[str] | None = None, most: int | None = None, canonical=None) -> DataFrame:
    """Rows of the wanted ids, then the first ``most`` in input order; nothing left is an error."""
    from ..functions.sequences import canonical_id

    out = frame
    if ids is not None:
        wanted = frame.sparkSession.createDataFrame([(i,) for i in ids], "wanted string").select(F.coalesce(canonical_id(F.col("wanted")), F.upper("wanted")).alias("wanted")).distinct()
        out = out.withColumn("_id", canonical_id(F.col("nsc_id"))).join(wanted, F.col("_id") == F.col("wanted"), "left_semi").drop("_id")
    if most is not None:
        if most < 1:
            raise InputError("at least one row must be asked for")
        out = out.orderBy("source_row_index").limit(most)
    if out.isEmpty():
        raise InputError("no row is left")
    return out
