"""Each artifact damaged in turn, and the checks that see it."""

import pytest
from pyspark.sql import functions as F

from loomvec.operators import groups, rows, validate
from loomvec.sources import sinks

DIM = 3


@pytest.fixture(scope="module")
def artifacts(spark, tmp_path_factory):
    """A small run's frames by name, and how to write them."""
    data = [(0, "1", "ACD"), (1, "nsc 1", "ACD"), (2, "1", "AU\n"), (3, "2", "C"), (4, "x", "C"), (5, "3", "*")]
    prepared = rows.prepare(spark.createDataFrame(data, "source_row_index long, nsc_id string, sequence string"))
    entries = prepared.where("status = 'pending'").select("sequence_hash").distinct().withColumn("embedding", F.array(F.lit(1.0), F.length("sequence_hash").cast("double"), F.ascii("sequence_hash").cast("double")))
    final = prepared.join(entries, "sequence_hash", "left").withColumns({"ok": F.col("status") == "pending", "drug_name": F.lit('a "name", quoted')})
    final = final.withColumns({"error": F.col("error_kind"), "status": F.when(F.col("ok"), "success").otherwise("failed")})
    mean = groups.vector_mean(groups.distinct_vectors(final.where("ok"), "nsc_id", "sequence_hash", "embedding"), "nsc_id", "embedding", DIM).select("nsc_id", "mean")
    summary = groups.group_summary(final, entries, "nsc_id", "sequence_hash", "drug_name", "source_row_index", F.col("ok"), DIM)
    index = sinks.row_vectors(final, "source_row_index", F.col("ok")).select("source_row_index", "row_valid", "vector_index")
    folder = str(tmp_path_factory.mktemp("good"))
    sinks.write_artifacts(folder, final.drop("ok", "embedding", "sequence"), index, summary, mean, entries)
    return folder


def failing(spark, folder):
    return {r["name"]: (r["seen"], r["bad"]) for r in validate.validate(spark, folder, DIM).collect() if r["bad"]}


def test_good_artifacts_pass_and_are_seen(spark, artifacts):
    got = validate.validate(spark, artifacts, DIM).collect()
    assert len(got) == 28 and not [r for r in got if r["bad"]]
    seen = {r["name"]: r["seen"] for r in got}
    assert seen["every row succeeded or failed"] == 6 and seen["every failed row says why"] == 2 and seen["group vectors are the means of their entries"] == 2


HURT = {
    "rows": (lambda f: f.withColumn("status", F.when(F.col("source_row_index") == 0, "pending").otherwise(F.col("status"))), "every row succeeded or failed"),
    "rows_twice": (lambda f: f.unionByName(f.where("source_row_index = 3")), "row numbers don't repeat"),
    "rows_hash": (lambda f: f.withColumn("sequence_hash", F.when(F.col("source_row_index") == 3, F.sha2(F.lit("?"), 256)).otherwise(F.col("sequence_hash"))), "every hash of a successful row has an entry"),
    "rows_error": (lambda f: f.withColumn("error", F.lit("")), "every failed row says why"),
    "rows_column": (lambda f: f.drop("error"), "rows has the column error"),
    "failed_rows": (lambda f: f.limit(1), "failed_rows holds every failed row"),
    "failed_rows_other": (lambda f: f.withColumn("source_row_index", F.lit(77)), "failed rows are rows"),
    "groups": (lambda f: f.where("nsc_id <> 'NSC-2'"), "every group of the rows is a group"),
    "groups_name": (lambda f: f.withColumn("nsc_id", F.lower("nsc_id")), "group keys are canonical"),
    "groups_count": (lambda f: f.withColumn("num_duplicates_removed", F.lit(9)), "members of a group add up"),
    "row_vectors": (lambda f: f.withColumn("vector_index", F.col("vector_index") * 2), "the index counts valid rows from 0 without gaps"),
    "row_vectors_mask": (lambda f: f.withColumn("row_valid", F.lit(True)), "the mask covers all rows and is true where a row succeeded"),
    "group_vectors": (lambda f: f.withColumn("mean", F.transform("mean", lambda x: x + 0.01)), "group vectors are the means of their entries"),
    "group_vectors_nan": (lambda f: f.withColumn("mean", F.array(*(F.lit(float("nan")) for _ in range(DIM)))), "group vectors are finite and not zero"),
    "group_vectors_less": (lambda f: f.limit(1), "groups with a vector are those with a success"),
    "entries": (lambda f: f.withColumn("embedding", F.slice("embedding", 1, 2)), f"entries have {DIM} elements"),
    "entries_twice": (lambda f: f.unionByName(f.limit(1)), "entries don't repeat"),
    "entries_zero": (lambda f: f.withColumn("embedding", F.array(F.lit(0.0), F.lit(0.0), F.lit(0.0))), "entries are finite and not zero"),
}


def artifact(case):
    return next(a for a in sorted(validate.ARTIFACTS, key=len, reverse=True) if case.startswith(a))


def rounds():
    """Cases by round: each artifact is damaged once in a round."""
    out = []
    for case in HURT:
        if case == "rows_column":  # ends the checks
            continue
        free = [r for r in out if artifact(case) not in map(artifact, r)]
        free[0].append(case) if free else out.append([case])
    return [*out, ["rows_column"]]


@pytest.mark.parametrize("cases", rounds(), ids="-".join)
def test_damage_is_seen(spark, artifacts, tmp_path, cases):
    import shutil

    folder = f"{tmp_path}/a"
    shutil.copytree(artifacts, folder)
    for case in cases:
        name, change = artifact(case), HURT[case][0]
        shutil.rmtree(f"{folder}/{name}")
        if validate.ARTIFACTS[name] == "csv":
            sinks.write_csv(change(spark.read.csv(f"{artifacts}/{name}", header=True, escape='"')), f"{folder}/{name}")
        else:
            change(spark.read.parquet(f"{artifacts}/{name}")).write.parquet(f"{folder}/{name}")
    assert {HURT[c][1] for c in cases} <= failing(spark, folder).keys()


def test_a_missing_artifact_is_a_failed_check(spark, artifacts, tmp_path):
    import shutil

    shutil.copytree(artifacts, f"{tmp_path}/a")
    shutil.rmtree(f"{tmp_path}/a/groups")
    assert failing(spark, f"{tmp_path}/a") == {"groups can be read": (1, 1)}


def test_audit_package(spark, tmp_path):
    data = [(i, "a" if i % 2 else "b", "ACD", [float(i)] if i % 3 else None) for i in range(10)]
    rows_ = spark.createDataFrame(data, "source_row_index long, nsc_id string, sequence string, v array<double>")
    both = spark.createDataFrame([("a", [1.0])], "nsc_id string, mean array<double>")
    sinks.write_audit_package(f"{tmp_path}/p", rows_, F.col("v").isNotNull(), "v", both.select("nsc_id"), both, {"size": 3, "revision": None})
    back = {n: spark.read.parquet(f"{tmp_path}/p/{n}") for n in ("row_embeddings", "row_metadata", "group_embeddings", "group_metadata", "settings")}
    want = [i for i in range(10) if i % 3]
    assert [(r["vector_index"], r["source_row_index"], r["embedding"]) for r in back["row_embeddings"].orderBy("vector_index").collect()] == [(k, i, [float(i)]) for k, i in enumerate(want)]
    assert sorted((r["source_row_index"], r["row_valid"]) for r in back["row_metadata"].collect()) == [(i, i % 3 > 0) for i in range(10)] and "sequence" not in back["row_metadata"].columns
    assert {r["field"]: r["value"] for r in back["settings"].collect()} == {"size": "3", "revision": None} and back["group_embeddings"].count() == 1


def test_texts_of_events_are_compressed_and_whole(spark, tmp_path):
    from pathlib import Path

    data = [(i, "1" if i % 3 else "?", ("ACXU" if i % 2 else "BDO") * (200 + i)) for i in range(40)]
    prepared = rows.prepare(spark.createDataFrame(data, "source_row_index long, nsc_id string, sequence string"))
    final = prepared.withColumns({"error": F.col("error_kind"), "special_residue_events": F.coalesce("special_residue_events", F.expr("array()").cast("array<struct<position:int,symbol:string,replaced_with:string>>"))})
    small = spark.createDataFrame([("NSC-1",)], "nsc_id string")
    sinks.write_artifacts(f"{tmp_path}/a", final.drop("sequence"), small, small, small)
    shown = {r["source_row_index"]: r["special_residue_events"] for r in sinks.row_payload(final).collect()}
    got = {n: spark.read.csv(f"{tmp_path}/a/{n}", header=True, escape='"').collect() for n in ("rows", "failed_rows")}
    assert {int(r["source_row_index"]): r["special_residue_events"] or "" for r in got["rows"]} == shown
    assert sorted(int(r["source_row_index"]) for r in got["failed_rows"]) == list(range(0, 40, 3))
    written = sum(f.stat().st_size for f in Path(f"{tmp_path}/a/rows").glob("part-*"))
    assert written < sum(map(len, shown.values())) / 4
