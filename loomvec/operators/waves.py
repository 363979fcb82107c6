"""Encoding in waves that commit: what a stopped run has done is never done again."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .commits import Store
from .order import by_cost
from .scratch import saved


@dataclass(frozen=True)
class Wave:
    number: int
    jobs: int
    reused: int
    computed: int
    failed: int
    passes: int


class Stopped(RuntimeError):
    """A run that ended between two waves, or whose wave was interrupted; ``waves`` are committed."""

    def __init__(self, waves: list[Wave], remaining: int):
        super().__init__(f"stopped with {remaining} jobs to do")
        self.waves, self.remaining = waves, remaining


def encode_waves(
    jobs: DataFrame, store: Store, encode: Callable[[DataFrame], DataFrame], every: int, branch: str = "target", tag: str = "encode-waves", stop: Callable[[int], bool] | None = None,
) -> list[Wave]:
    """Encode the jobs (sequence_hash, sequence) that the store hasn't, ``every`` at a time, longest first.

    A wave is one commit. ``stop`` is asked before each wave; Spark jobs of a wave bear
    ``tag``, so another thread (a signal handler, say) ends a running one by
    ``sparkContext.cancelJobsWithTag(tag)``: it leaves no entry. Both raise ``Stopped``. A later call
    with the same jobs and store computes what is missing. The driver sees a number for
    each wave; the loop is over commits, each a distributed job of ``every`` sequences.
    """
    if every < 1:
        raise ValueError("a commit must hold at least one entry")
    context = jobs.sparkSession.sparkContext
    placed = by_cost(jobs.select("sequence_hash", "sequence"), F.length("sequence"), "sequence_hash")
    placed = saved(placed.select("sequence_hash", "sequence", F.floor((F.col("place") - 1) / every).cast("long").alias("wave")), "waves", ["wave"])
    counts = {r["wave"]: r["n"] for r in placed.groupBy("wave").agg(F.count(F.lit(1)).alias("n")).collect()}
    done: list[Wave] = []

    def left() -> int:
        return sum(n for w, n in counts.items() if w >= len(done))

    for w in sorted(counts):
        if stop is not None and stop(w):
            raise Stopped(done, left())
        wave = placed.where(F.col("wave") == w).select("sequence_hash", "sequence")
        context.addJobTag(tag)
        try:
            got = store.commit(encode(store.misses(wave)).withColumn("branches", F.array(F.lit(branch))))
        except Exception as e:
            if "SPARK_JOB_CANCELLED" in str(e):
                raise Stopped(done, left()) from e
            raise
        finally:
            context.removeJobTag(tag)
        done.append(Wave(w, counts[w], counts[w] - got["entries"] - got["failed"], got["entries"], got["failed"], got["passes"]))
    return done


def report(spark, waves: list[Wave], run: int = 0) -> DataFrame:
    """One row a wave."""
    rows = [(run, w.number, w.jobs, w.reused, w.computed, w.failed, w.passes) for w in waves]
    return spark.createDataFrame(rows, "run int, wave long, jobs long, reused long, computed long, failed long, passes long")
