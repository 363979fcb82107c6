"""The store of commits, waves that resume, and orders of equal cost."""

import threading
import time

import pytest
from pyspark.sql import functions as F

from loomvec.functions.sequences import sequence_hash
from loomvec.operators import commits, encode, order, waves

SETTINGS = {"encoder": "one-hot", "size": 10, "overlap": 2, "policy": "keep"}


def entries(spark, *texts, branch="target", error=None):
    rows = [(t, [1.0, 2.0] if error is None else None, 1, error, error and "inference_error", [branch]) for t in texts]
    return spark.createDataFrame(rows, commits.ENTRY).withColumn("sequence_hash", sequence_hash(F.col("sequence_hash")))


def jobs_of(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "sequence string").select(sequence_hash(F.col("sequence")).alias("sequence_hash"), "sequence")


def run_encode(jobs):
    return encode.encode_by_chunks(jobs, encode.OneHotEncoder("ACDE"), 10, 2)


def test_two_writers_keep_both_entries(spark, tmp_path):
    one, two = (commits.Store(spark, f"file://{tmp_path}/s", SETTINGS) for _ in range(2))  # both saw an empty store
    ends = [threading.Thread(target=s.commit, args=(entries(spark, *t, branch=b),)) for s, t, b in ((one, ("A", "B"), "x"), (two, ("B", "C"), "y"))]
    for t in ends:
        t.start()
    for t in ends:
        t.join()
    got = {r["sequence_hash"]: r["branches"] for r in commits.Store(spark, f"file://{tmp_path}/s", SETTINGS).entries().collect()}
    assert sorted(map(tuple, got.values())) == [("x",), ("x", "y"), ("y",)]


def test_an_unfinished_commit_is_not_read(spark, tmp_path):
    at = commits.Store(spark, f"{tmp_path}/s", SETTINGS)
    at.commit(entries(spark, "A"))
    entries(spark, "B").withColumn("prefix", commits.prefix(F.col("sequence_hash"))).write.partitionBy("prefix").parquet(f"{tmp_path}/s/entries/commit=dead")
    assert at.entries().count() == 1 and at.misses(jobs_of(spark, "A", "B")).count() == 1


def test_other_settings_are_refused_and_named(spark, tmp_path):
    at = commits.Store(spark, f"{tmp_path}/s", SETTINGS)
    late = commits.Store(spark, f"{tmp_path}/s", SETTINGS | {"size": 11})  # the store was empty then
    at.commit(entries(spark, "A"))
    for f in (lambda: commits.Store(spark, f"{tmp_path}/s", SETTINGS | {"size": 12, "more": 1}), lambda: late.commit(entries(spark, "B"))):
        with pytest.raises(commits.FingerprintError, match="size"):
            f()
    with pytest.raises(ValueError, match="policy"):
        commits.Store(spark, f"{tmp_path}/s", {"encoder": "a", "size": 1, "overlap": 0})
    fresh = commits.Store(spark, f"{tmp_path}/s", SETTINGS | {"size": 12}, rebuild=True)
    assert fresh.entries().count() == 0
    fresh.commit(entries(spark, "Z"))
    assert fresh.entries().count() == 1 and commits.Store(spark, f"{tmp_path}/s", SETTINGS | {"size": 12}).entries().count() == 1
    diff = commits.settings_diff(commits.settings_of(spark, f"{tmp_path}/s"), spark.createDataFrame([("size", "12"), ("policy", None)], "field string, value string"))
    assert {r["field"] for r in diff.collect()} == {"policy", "encoder", "overlap", "layout"}


def test_compaction_keeps_entries_and_branches(spark, tmp_path):
    at = commits.Store(spark, f"{tmp_path}/s", SETTINGS)
    for i in range(4):
        at.commit(entries(spark, f"k{i}", "same", branch=f"b{i}"))
    at.commit(entries(spark, "bad", error="no"))
    at.commit(entries(spark, *(f"x{i}" for i in range(50))))
    before = {(r["sequence_hash"], tuple(r["branches"])) for r in at.entries().collect()}
    old = at.log()
    assert at.compact(10) == 5 and len(at.log()) == 2 and at.compact(10) == 0
    assert {(r["sequence_hash"], tuple(r["branches"])) for r in at.entries().collect()} == before and len(before) == 55
    assert at._read(old).count() == 4 * 2 + 1 + 50  # a reader of the old commits goes on
    assert at.entries(failed=True).count() == 55


def test_a_repeated_commit_takes_the_place_of_its_first(spark, tmp_path):
    at = commits.Store(spark, f"{tmp_path}/s", SETTINGS)
    for _ in range(2):
        assert at.commit(entries(spark, "A", "B"), name="batch-1") == {"entries": 2, "failed": 0, "passes": 2}
    assert len(at.log()) == 1 and at.entries().count() == 2
    with pytest.raises(ValueError):
        at.commit(entries(spark, "A"), name="a/b")


def test_lookups_read_the_prefixes_of_their_jobs(spark, tmp_path):
    at = commits.Store(spark, f"{tmp_path}/s", SETTINGS)
    at.commit(entries(spark, *(f"e{i}" for i in range(400)), error=None))
    at.commit(entries(spark, "failed", error="no"))
    jobs = jobs_of(spark, "e1", "e2", "new", "failed")
    missing = at.misses(jobs)
    plan = missing._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "prefix" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert {r["sequence"] for r in missing.collect()} == {"new", "failed"}  # a failed attempt is no hit
    assert at.found(jobs).count() == 2 and at.misses(jobs.limit(0)).count() == 0
    empty = commits.Store(spark, f"{tmp_path}/none", SETTINGS)
    assert empty.misses(jobs).count() == 4 and empty.found(jobs).count() == 0 and empty.entries().count() == 0


def test_a_stopped_run_resumes(spark, tmp_path):
    texts = ["A" * (i + 1) for i in range(9)] + ["AXA"]
    jobs, made = jobs_of(spark, *texts), []

    def counting(some):
        made.append(sorted(r["sequence"] for r in some.collect()))
        return run_encode(some)

    at = f"{tmp_path}/s"
    with pytest.raises(waves.Stopped) as stopped:
        waves.encode_waves(jobs, commits.Store(spark, at, SETTINGS), counting, 4, stop=lambda w: w == 1)
    assert stopped.value.remaining == 6 and [w.computed for w in stopped.value.waves] == [4] and made == [["A" * n for n in (6, 7, 8, 9)]]
    rest = waves.encode_waves(jobs, commits.Store(spark, at, SETTINGS), counting, 4)
    assert [(w.jobs, w.reused, w.computed, w.failed) for w in rest] == [(4, 4, 0, 0), (4, 0, 3, 1), (2, 0, 2, 0)]
    again = waves.encode_waves(jobs, commits.Store(spark, at, SETTINGS), counting, 4)
    assert [(w.reused, w.computed, w.failed) for w in again] == [(4, 0, 0), (3, 0, 1), (2, 0, 0)]
    assert commits.Store(spark, at, SETTINGS).entries().count() == 9
    with pytest.raises(ValueError):
        waves.encode_waves(jobs, commits.Store(spark, at, SETTINGS), run_encode, 0)


def test_an_interrupted_wave_leaves_no_entry(spark, tmp_path):
    jobs = jobs_of(spark, "AC", "CA")

    def slow(some):
        def wait(frames):
            for f in frames:
                time.sleep(60)
                yield f

        return run_encode(some.mapInPandas(wait, some.schema))

    over = threading.Event()

    def end():
        while not over.wait(1.0):
            spark.sparkContext.cancelJobsWithTag("own-tag")

    ending = threading.Thread(target=end)
    ending.start()
    try:
        with pytest.raises(waves.Stopped) as stopped:
            waves.encode_waves(jobs, commits.Store(spark, f"{tmp_path}/s", SETTINGS), slow, 5, tag="own-tag")
    finally:
        over.set()
        ending.join()
    assert stopped.value.waves == [] and stopped.value.remaining == 2
    assert [w.computed for w in waves.encode_waves(jobs, commits.Store(spark, f"{tmp_path}/s", SETTINGS), run_encode, 5)] == [2]


def test_orders_and_parts_of_equal_cost(spark):
    import hashlib

    costs = [1] * 500 + [3] * 40 + [90, 91, 2500]
    rows = [(hashlib.sha256(str(i).encode()).hexdigest(), c) for i, c in enumerate(costs)]
    frame = spark.createDataFrame(rows, "h string, c int")
    got = [(r["h"], r["c"]) for r in order.by_cost(frame, F.col("c"), "h").orderBy("place").collect()]
    assert got == sorted(rows, key=lambda r: (-r[1], r[0]))
    dealt = order.balanced(frame, F.col("c"), "h", 8)
    assert dealt.rdd.getNumPartitions() == 8 and dealt.where(F.spark_partition_id() != F.col("part")).count() == 0
    mean = sum(costs) / 8
    parts = dealt.groupBy("part").agg(F.sum("c").alias("c"), F.max("c").alias("largest")).collect()
    assert sum(r["c"] for r in parts) == sum(costs) and all(r["c"] < mean + r["largest"] for r in parts)
    assert order.balanced(frame.limit(0), F.col("c"), "h", 8).count() == 0
