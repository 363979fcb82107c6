"""Incremental encoding and row provenance, which no query reaches."""

from loomvec.operators.encode import AlphabetEncoder
from loomvec.sources.sinks import PROVENANCE, provenance
from loomvec.streaming.incremental import incremental_encode


def test_the_same_files_add_nothing(spark, tmp_path):
    rows = spark.createDataFrame([("ACDEF",), ("ACDEF",), ("KLM",), (None,)], "sequence string")
    rows.write.parquet(f"{tmp_path}/in")
    for checkpoint in ("first", "first", "second"):
        incremental_encode(spark, f"{tmp_path}/in", rows.schema, f"{tmp_path}/store", f"{tmp_path}/{checkpoint}", AlphabetEncoder(4), 512, 128).awaitTermination()
        assert spark.read.parquet(f"{tmp_path}/store").groupBy("sequence_hash").count().select("count").toPandas()["count"].tolist() == [1, 1]


def test_provenance_keeps_all_rows_and_columns(spark):
    out = provenance(spark.createDataFrame([(1, "x", "ACD"), (2, "y", None)], "source_row_index long, other string, sequence string"))
    assert out.columns == [*PROVENANCE, "other"] and out.count() == 2


SETTINGS = {"encoder": "one-hot", "size": 10, "overlap": 2, "policy": "keep"}


def _jobs(batch):
    from pyspark.sql import functions as F

    from loomvec.functions.sequences import sequence_hash

    return batch.select(sequence_hash(F.col("t")).alias("sequence_hash"), F.col("t").alias("sequence"))


def test_a_stream_commits_each_arrival_once(spark, tmp_path):
    from loomvec.operators import commits
    from loomvec.operators.encode import OneHotEncoder, encode_by_chunks
    from loomvec.streaming.incremental import source_of, stream_into

    encode_jobs = lambda jobs: encode_by_chunks(jobs, OneHotEncoder("ACD"), 10, 2)
    at = commits.Store(spark, f"{tmp_path}/store", SETTINGS)

    def arrive(*texts):
        spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")

    def go(checkpoint):
        stream_into(spark, *source_of(spark, f"{tmp_path}/in"), at, f"{tmp_path}/{checkpoint}", _jobs, encode_jobs).awaitTermination()
        return sorted(r["num_chunks"] for r in at.entries().collect()), sum(c["entries"] for c in at.log())

    arrive("ACD", "ACD", "A" * 30, "bad", None, "")
    assert go("first") == ([1, 4], 2) and go("first") == ([1, 4], 2)
    arrive("CC", "ACD")
    assert go("first") == ([1, 1, 4], 3)
    assert go("second") == ([1, 1, 4], 3)  # a new stream over the same files finds all entries


def test_a_batch_that_runs_again_takes_its_own_place(spark, tmp_path):
    import shutil

    from loomvec.operators import commits
    from loomvec.operators.encode import OneHotEncoder, encode_by_chunks
    from loomvec.streaming.incremental import stream_into

    encode_jobs = lambda jobs: encode_by_chunks(jobs, OneHotEncoder("ACD"), 10, 2)
    at = commits.Store(spark, f"{tmp_path}/store", SETTINGS)
    spark.createDataFrame([("ACD",), ("AC",)], "t string").coalesce(1).write.parquet(f"{tmp_path}/in")
    for _ in range(2):
        stream_into(spark, f"{tmp_path}/in", "*.parquet", at, f"{tmp_path}/c", _jobs, encode_jobs).awaitTermination()
        shutil.rmtree(f"{tmp_path}/c")  # as if the batch had died before its checkpoint was written
    assert len(at.log()) == 1 and at.log()[0]["entries"] == 2


def test_a_run_and_its_figures(spark, tmp_path):
    from loomvec.operators import commits, rows
    from loomvec.operators import run as runs
    from loomvec.operators.encode import OneHotEncoder, encode_by_chunks

    data = [(0, "1", "ACD" * 9), (1, "1", "ACD" * 9), (2, "2", "AC"), (3, "2", "ACB"), (4, "x", "AC"), (5, "3", "ACB"), (6, "3", "A C\nd")]
    prepared = rows.prepare(spark.createDataFrame(data, "source_row_index long, nsc_id string, sequence string"))
    encode_jobs = lambda jobs: encode_by_chunks(jobs, OneHotEncoder("ACD"), 10, 2)
    at = lambda: commits.Store(spark, f"{tmp_path}/store", SETTINGS)
    first = runs.run(prepared, at(), encode_jobs, 10, 2, 3, long_from=20)
    want = {"total_rows": 7, "successful_rows": 4, "failed_rows": 3, "unique_jobs": 4, "newly_computed": 3, "failed_jobs": 1, "hits": 0, "long_rows": 2, "unique_chunked": 1, "forward_passes": 6, "groups_with_vector": 3, "accounting_holds": True}
    assert {k: first.summary[k] for k in want} == want
    got = {r["source_row_index"]: r for r in first.rows.collect()}
    assert [got[i]["error_kind"] for i in range(7)] == [None, None, None, "inference_error", "invalid_nsc", "not_encoded", None]
    assert got[0]["num_chunks"] == 4 and not got[0]["embedding_cache_hit"] and got[1]["embedding_cache_hit"]
    again = runs.run(prepared, at(), encode_jobs, 10, 2, 3).summary
    assert (again["newly_computed"], again["same_branch_hits"], again["failed_jobs"], again["forward_passes"], again["accounting_holds"]) == (0, 3, 1, 0, True)
    other = runs.run(prepared, at(), encode_jobs, 10, 2, 3, branch="other").summary
    assert (other["newly_computed"], other["cross_branch_hits"], other["forward_passes"]) == (0, 3, 0)
    assert runs.run(prepared, at(), encode_jobs, 10, 2, 3, branch="other").summary["same_branch_hits"] == 3
