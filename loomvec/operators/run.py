"""A whole run: rows to statuses, with figures that are counted in the passes that write.

The relation is read once: prepared rows are written, and all that follows reads those.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.sequences import chunk_count
from .commits import Store
from .rows import resolve
from .scratch import saved


@dataclass
class Run:
    """``rows`` with their final statuses, the store's ``found`` entries, and all figures by name."""

    rows: DataFrame
    entries: DataFrame
    summary: dict = field(default_factory=dict)


#: Figures of a run, in order.
FIGURES = (
    "total_rows", "successful_rows", "failed_rows", "unique_sequences", "unique_jobs", "newly_computed", "failed_jobs", "hits", "misses", "same_branch_hits", "cross_branch_hits",
    "total_hits", "accounting_holds", "long_rows", "unique_chunked", "forward_passes", "embedding_dim", "groups_with_vector",
)


def observed(frame: DataFrame, label: str, **counts: Column) -> tuple[DataFrame, dict]:
    """``frame`` written once, and the aggregates that were taken while it was."""
    seen = Observation(f"{label}-{uuid.uuid4().hex}")
    out = saved(frame.observe(seen, *(c.alias(n) for n, c in counts.items())), label)
    return out, dict(seen.get)


def many(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def run(prepared: DataFrame, store: Store, encode: Callable[[DataFrame], DataFrame], size: int, overlap: int, width: int, branch: str = "target", long_from: int = 2048) -> Run:
    """Encode what the store hasn't, and give every prepared row its final status.

    ``prepared`` comes from ``rows.prepare`` and is computed once. ``encode`` maps jobs
    (sequence_hash, sequence) to entries. A sequence that the store holds under another
    branch only is a cross-branch hit, and its entry gets this branch. Figures: see
    ``FIGURES``; ``accounting_holds`` says that new, failed and found jobs are all jobs.
    """
    pending = F.col("status") == "pending"
    rows, seen = observed(prepared, "rows", total_rows=F.count(F.lit(1)), long_rows=many(pending & (F.col("actual_sequence_length") > long_from)))
    first = rows.where(pending).groupBy("sequence_hash").agg(F.min_by("sequence", "source_row_index").alias("sequence"))
    jobs, of_jobs = observed(first, "jobs", unique_jobs=F.count(F.lit(1)), unique_chunked=many(chunk_count(F.length("sequence"), size, overlap) > 1))
    before = store.found(jobs).select("sequence_hash", "embedding", "num_chunks", "error", "error_kind", "branches")
    same = F.array_contains("branches", branch)
    before, looked = observed(before, "found", same=many(same), cross=many(~same))
    new, errors = observed(encode(store.misses(jobs)), "encoded", failed=many(F.col("error").isNotNull()))
    crossed = before.where(~same).withColumn("branches", F.array(F.lit(branch)))
    columns = ["sequence_hash", "embedding", "num_chunks", "error", "error_kind"]
    made = store.commit(new.select(*columns).withColumn("branches", F.array(F.lit(branch))).unionByName(crossed.select(*columns, "branches")))
    entries = store.found(jobs)
    failed = new.where("error is not null").select("sequence_hash", "error", "error_kind")
    final = resolve(rows, entries, failed, before)
    final = final.join(entries.select("sequence_hash", "num_chunks"), "sequence_hash", "left")
    ok = F.col("status") == "success"
    final, ended = observed(final, "resolved", successful_rows=many(ok), failed_rows=many(~ok))
    groups = final.where(ok).select("nsc_id").distinct().count()
    computed, hits = made["entries"] - looked["cross"], looked["same"] + looked["cross"]
    cross_passes = crossed.agg(F.coalesce(F.sum("num_chunks"), F.lit(0)).alias("n")).head()["n"]
    summary = {
        **seen, **ended, "unique_sequences": of_jobs["unique_jobs"], **of_jobs, "newly_computed": computed, "failed_jobs": errors["failed"], "hits": hits, "misses": of_jobs["unique_jobs"] - hits,
        "same_branch_hits": looked["same"], "cross_branch_hits": looked["cross"], "total_hits": hits, "accounting_holds": computed + errors["failed"] + hits == of_jobs["unique_jobs"],
        "forward_passes": made["passes"] - cross_passes, "embedding_dim": width, "groups_with_vector": groups,
    }
    return Run(final, entries, {k: summary[k] for k in FIGURES})


def long_detail(result: Run) -> DataFrame:
    """Sequences that this run encoded in more than one chunk, each with its first row; those found in the store don't appear."""
    new = (F.col("status") == "success") & ~F.col("embedding_cache_hit") & (F.col("num_chunks") > 1)
    return result.rows.where(new).select("source_row_index", "nsc_id", "sequence_hash", "actual_sequence_length", "num_chunks")


def report(spark, summary: dict) -> DataFrame:
    """The figures as one row."""
    return spark.createDataFrame([tuple(summary.values())], ", ".join(f"{k} {'boolean' if isinstance(v, bool) else 'long'}" for k, v in summary.items()))
