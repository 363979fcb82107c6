"""Tables written to the folder that driver and executors share, which cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir`` or of the context; one is made only for a local master without either."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def saved(frame: DataFrame, label: str, by: list[str] | None = None) -> DataFrame:
    """``frame`` written once and read back; ``by`` are columns whose values become folders."""
    path = new_path(frame.sparkSession, label)
    frame.write.partitionBy(*(by or [])).parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
