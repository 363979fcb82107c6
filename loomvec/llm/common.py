"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

#: log2 of the bits of a table that keeps most rows without a counterpart out of a shuffle.
FILTER_BITS = 22
#: White space that separates words: space and U+0009 to U+000D.
SPACE_RUN, WORD_CHAR = "[ \\t\\n\\x0B\\f\\r]+", "[^ \\t\\n\\x0B\\f\\r]"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Only where the setting is absent is one made, and only for a local master: on a
    cluster a folder of one machine would lose what others need. What is written there is
    read as long as a result is; its owner clears the folder.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    known = spark.sparkContext.getCheckpointDir()
    if known is None:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
        known = spark.sparkContext.getCheckpointDir()
    return known.rstrip("/")


def scratch(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, keeps column pruning."""
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the shared folder; keeps partitions and their order."""
    shared_dir(df.sparkSession)
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once for each row.

    A lambda variable holds the value, so the optimiser can't copy a costly
    expression into the loops of ``body``.
    """
    return F.transform(F.array(value), body)[0]


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with marks added until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def table_of(row: DataFrame, column: str, label: str) -> Column:
    """The one value of ``column`` in ``row``, as a scalar subquery: for tables of a fixed size.

    The row is written first, so it is made once, and plans hold a reference to it
    instead of its numbers. Subqueries can't stand in the argument of a lambda function:
    add the value as a column and use that.
    """
    return written(row.select(column), label).select(column).scalar()


def _bit(value: Column, bits: int) -> tuple[Column, Column]:
    place = F.xxhash64(value).bitwiseAND(F.lit((1 << bits) - 1))
    return (place / 32).cast("int"), F.call_function("shiftleft", F.lit(1).cast("long"), (place % 32).cast("int"))


def bit_table(wanted: DataFrame, name: str, bits: int = FILTER_BITS) -> Column:
    """A bit for every hash of a wanted value, in an array of a fixed size."""
    word, bit = _bit(F.col(name), bits)
    found = wanted.select(word.alias("w"), bit.alias("b")).groupBy("w").agg(F.bit_or("b").alias("b"))
    dense = wanted.sparkSession.range(0, 1 << (bits - 5), 1, 4).select(F.col("id").cast("int").alias("w")).join(found, "w", "left")
    one = dense.agg(F.sort_array(F.collect_list(F.struct("w", F.coalesce("b", F.lit(0)).alias("b")))).alias("rows"))
    return table_of(one.select(F.transform("rows", lambda r: r["b"]).alias("bits")), "bits", "bits")


def in_filter(value: Column, table: Column, bits: int = FILTER_BITS) -> Column:
    """True for every value in the table and few others: keeps texts out of a shuffle."""
    word, bit = _bit(value, bits)
    return F.get(table, word).bitwiseAND(bit) != 0


def word_list(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE_RUN), lambda w: w != "")


def fs_of(path: str):
    """File system and path for Python tasks, from a URI or a local path."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def publish(path: str, write: Callable) -> None:
    """Write a file under a name of this attempt, then rename it: a retried task replaces it whole."""
    system, place = fs_of(path)
    part = f"{place}.{uuid.uuid4().hex}.tmp"
    system.create_dir(place.rpartition("/")[0], recursive=True)
    try:
        with system.open_output_stream(part) as out:
            write(out)
        system.move(part, place)
    except BaseException:
        if system.get_file_info(part).is_file:
            system.delete_file(part)
        raise


def global_positions(df: DataFrame, order: list, parts: int | None = None) -> tuple[DataFrame, int]:
    """Rows in one global order with ``position`` from 0 (a column of this name is replaced), and their number.

    Range partitioning and a sort in each partition; the driver sees one count a
    partition. The sorted rows are checkpointed first, as range bounds are sampled
    again whenever a plan runs again.
    """
    df = df.drop("position")
    by = df.repartitionByRange(parts, *order) if parts else df.repartitionByRange(*order)
    rows = checkpointed(by.sortWithinPartitions(*order))
    counts = {r["p"]: r["n"] for r in rows.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}
    starts, total = {}, 0
    for p in sorted(counts):
        starts[p], total = total, total + counts[p]

    def number(frames):
        import pandas as pd
        from pyspark import TaskContext

        at = starts.get(TaskContext.get().partitionId(), 0)
        for frame in frames:
            frame["position"] = pd.RangeIndex(at, at + len(frame)).astype("int64")
            at += len(frame)
            yield frame

    return rows.mapInPandas(number, StructType([*rows.schema.fields, StructField("position", LongType())])), total
