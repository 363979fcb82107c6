"""A fingerprinted store of vectors: immutable snapshots, hits and misses by joins."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class FingerprintError(ValueError):
    """The store was made with other settings."""


def differing(stored: dict, current: dict) -> list[str]:
    """Names of the settings that differ, or that only one side has."""
    return sorted(k for k in stored.keys() | current.keys() if k not in stored or k not in current or stored[k] != current[k])


def fingerprint(settings: dict) -> str:
    """SHA-256 of canonical JSON."""
    return hashlib.sha256(json.dumps(settings, sort_keys=True, separators=(",", ":"), default=str).encode()).hexdigest()


def misses(jobs: DataFrame, store: DataFrame, key: str = "sequence_hash") -> DataFrame:
    return jobs.join(store.select(key), key, "left_anti")


def hits(jobs: DataFrame, store: DataFrame, key: str = "sequence_hash") -> DataFrame:
    return jobs.join(store.select(key), key, "left_semi")


def branch_lookup(jobs: DataFrame, store: DataFrame, branch: str, key: str = "sequence_hash") -> DataFrame:
    """Jobs with ``lookup`` (miss, same or cross) and the ``branches`` that the entry has after it."""
    found = jobs.join(store.select(key, "branches"), key, "left")
    kind = F.when(F.col("branches").isNull(), "miss").when(F.array_contains("branches", branch), "same").otherwise("cross")
    after = F.when(F.col("branches").isNotNull(), F.array_sort(F.array_union("branches", F.array(F.lit(branch)))))
    return found.withColumn("lookup", kind).withColumn("branches", after)


def counters(lookups: DataFrame) -> DataFrame:
    """Hits, misses, same- and cross-branch hits of ``branch_lookup``."""
    many = lambda kind: F.count(F.when(F.col("lookup") == kind, 1))
    return lookups.agg((many("same") + many("cross")).alias("hits"), many("miss").alias("misses"), many("same").alias("same_branch_hits"), many("cross").alias("cross_branch_hits"))


def waves(jobs: DataFrame, place: str, every: int) -> DataFrame:
    """Jobs with the number of the commit that saves them: one for each ``every`` jobs in order of ``place`` (from 1)."""
    if every < 1:
        raise ValueError("a commit must hold at least one entry")
    return jobs.withColumn("wave", F.floor((F.col(place) - 1) / every).cast("long"))


def append(store: DataFrame, path: str, settings: dict) -> None:
    """Add entries under the settings' fingerprint."""
    rows = store.withColumn("fingerprint_hash", F.lit(fingerprint(settings))).withColumn("settings", F.lit(json.dumps(settings, sort_keys=True, default=str)))
    rows.write.mode("append").partitionBy("fingerprint_hash").parquet(path)


def load(spark: SparkSession, path: str, settings: dict) -> DataFrame:
    """Entries of these settings; an error that names the differing ones if the store has entries of others only."""
    whole = spark.read.parquet(path)
    own = whole.where(F.col("fingerprint_hash") == fingerprint(settings)).drop("fingerprint_hash", "settings")
    if own.isEmpty() and (other := whole.select("settings").head()):
        stored = json.loads(other["settings"]) if other["settings"] else {}
        raise FingerprintError(f"the store holds entries of other settings: {', '.join(differing(stored, json.loads(json.dumps(settings, default=str))))}")
    return own


def save(memory: DataFrame, path: str, settings: dict, key: str, value: str, arrays: list[str], rebuild: bool = False) -> DataFrame:
    """A new snapshot ``path``/N of the store: ``memory`` merged with the newest one, or alone with ``rebuild``.

    Snapshots are never changed, so readers of an older one go on. One writer at a time.
    """
    spark = memory.sparkSession
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [x.getPath().getName() for x in system.listStatus(folder)] if system.exists(folder) else []
    done = sorted(int(n) for n in names if n.isdigit() and system.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/_SUCCESS")))
    merged = memory
    if done and not rebuild:
        merged = merge(load(spark, f"{path}/{done[-1]}", settings), memory, key, value, arrays)
    append(merged, f"{path}/{done[-1] + 1 if done else 0}", settings)
    return load(spark, f"{path}/{done[-1] + 1 if done else 0}", settings)


def merge(disk: DataFrame, memory: DataFrame, key: str, value: str, arrays: list[str]) -> DataFrame:
    """Union by key: the value of ``memory`` wins, arrays are united and sorted."""
    both = disk.withColumn("_p", F.lit(0)).unionByName(memory.withColumn("_p", F.lit(1)))
    united = [F.array_sort(F.array_distinct(F.flatten(F.collect_list(a)))).alias(a) for a in arrays]
    return both.groupBy(key).agg(F.max_by(value, "_p").alias(value), *united)
