"""Incremental encoding of arriving files: the store of commits is the only state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..functions.sequences import sequence_hash
from ..operators.commits import Store
from ..operators.encode import Encoder, encode
from ..operators.scratch import saved
from ..operators.store import misses


def incremental_encode(spark: SparkSession, source: str, schema: StructType, store: str, checkpoint: str, encoder: Encoder, size: int, overlap: int, sequence: str = "sequence") -> StreamingQuery:
    """Encode what has arrived and isn't in the store, batch by batch, then stop.

    A batch that runs again finds its entries in the store and adds none.
    """

    def handle(batch: DataFrame, number: int) -> None:
        jobs = batch.where(F.col(sequence).isNotNull()).select(sequence_hash(F.col(sequence)).alias("sequence_hash"), F.col(sequence).alias("sequence")).dropDuplicates(["sequence_hash"])
        session = batch.sparkSession
        known = session.read.schema("sequence_hash string, embedding array<float>, num_chunks int, batch long").parquet(store)
        new = encode(misses(jobs, known), encoder, size, overlap).where("error is null").select("sequence_hash", "embedding", "num_chunks", F.lit(number).cast("long").alias("batch"))
        new.write.mode("append").parquet(store)

    spark.createDataFrame([], "sequence_hash string, embedding array<float>, num_chunks int, batch long").write.mode("append").parquet(store)
    stream = spark.readStream.schema(schema).parquet(source)
    return stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def source_of(spark: SparkSession, table: str) -> tuple[str, str]:
    """Folder and file names that a stream of ``table`` reads: a folder of files, or one file among those of other tables."""
    table = table.rstrip("/")
    folder, _, name = table.rpartition("/")
    files = spark.read.parquet(table).inputFiles()
    alone = len(files) == 1 and files[0].rpartition("/")[2] == name
    return (folder, name) if alone else (table, "*.parquet")


def stream_into(
    spark: SparkSession, folder: str, names: str, store: Store, checkpoint: str, jobs: Callable[[DataFrame], DataFrame], encode_jobs: Callable[[DataFrame], DataFrame],
    branch: str = "target", files: int | None = None,
) -> StreamingQuery:
    """Encode the files of ``folder`` whose names match ``names`` that have arrived since the last call, then stop.

    A table that is one file beside others, or a folder of files, is a stream of its own
    by its name. ``jobs`` maps a batch to (sequence_hash, sequence); a batch's jobs are
    written once, repeated ones once, and only the prefixes of the store that they have
    are read. A batch commits under its number and the checkpoint's name: one that runs
    again after a failure takes its own place and adds nothing. ``files`` bounds a batch.
    """
    schema = spark.read.option("pathGlobFilter", names).option("recursiveFileLookup", True).parquet(folder).schema
    title = "".join(c if c.isalnum() else "-" for c in checkpoint.rstrip("/").rpartition("/")[2])

    def handle(batch: DataFrame, number: int) -> None:
        own = saved(jobs(batch).where("sequence is not null and sequence <> ''").dropDuplicates(["sequence_hash"]), "batch")
        name = f"{title}-{number}"
        # what an earlier try of this batch committed doesn't count as known: this try replaces it
        before = Store(own.sparkSession, store.path, {k: v for k, v in store.settings.items() if k != "layout"}, digits=store.digits)
        before.hidden = {name}
        new = saved(encode_jobs(before.misses(own)).withColumn("branches", F.array(F.lit(branch))), "encoded")
        store.commit(new, name)

    stream = spark.readStream.schema(schema).option("pathGlobFilter", names).option("recursiveFileLookup", True)
    stream = (stream.option("maxFilesPerTrigger", files) if files else stream).parquet(folder)
    return stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
