"""Payloads, artifacts, stores and encoders of a run."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomvec.functions import sequences as S
from loomvec.operators import encode, groups, order, pairs, rows, store
from loomvec.sources import relation, sinks

SCHEMA = "source_row_index long, nsc_id string, sequence string, sequence_length string, special_residue_events string"


def relation_rows(spark):
    return spark.createDataFrame([(0, "1", "ACDU", "4", "x"), (1, "NSC-2", "acd", "9", "x"), (2, "x", "ACD", None, "x"), (3, "3", "AC*", None, "x"), (4, "4", None, "1", "x"), (5, "5", "", "1", "x")], SCHEMA)


def test_events_are_those_before_replacement(spark):
    got = {r["source_row_index"]: r for r in rows.prepare(relation_rows(spark), "replace_with_X", "X").collect()}
    assert got[0]["sequence"] == "ACDX" and [tuple(e) for e in got[0]["special_residue_events"]] == [(3, "U", "X")]
    assert [got[i]["error_kind"] for i in range(6)] == [None, None, "invalid_nsc", "invalid_sequence", "invalid_sequence", "invalid_sequence"]


def test_artifacts_are_written_and_read_back(spark, tmp_path):
    prepared = rows.prepare(relation_rows(spark), "replace_with_X", "X")
    vectors = sinks.row_vectors(prepared.withColumn("v", F.array(F.lit(1.0))), "source_row_index", F.col("status") == "pending")
    assert [(r["row_valid"], r["vector_index"]) for r in vectors.orderBy("source_row_index").collect()] == [(True, 0), (True, 1), (False, None), (False, None), (False, None), (False, None)]
    summary = groups.group_summary(prepared.withColumn("drug_name", F.lit(" ")), prepared.select("sequence_hash").where("sequence_hash is not null"), "nsc_id", "sequence_hash", "drug_name", "source_row_index", F.col("status") == "pending", 1)
    sinks.write_artifacts(f"{tmp_path}/out", prepared, vectors.select("source_row_index", "vector_index"), summary, summary.select("nsc_id"))
    back = spark.read.csv(f"{tmp_path}/out/rows", header=True, escape='"').orderBy(F.col("source_row_index").cast("int")).collect()
    assert back[0]["special_residue_events"] == '[{"position":3,"symbol":"U","replaced_with":"X"}]' and back[0]["sequence_length_mismatch"] == "False"
    assert back[1]["error"] == "mismatch" and back[1]["status"] == "success" or back[1]["status"] == "pending"
    assert spark.read.csv(f"{tmp_path}/out/failed_rows", header=True).count() == 4
    assert {(r["nsc_id"], r["status"], r["error"]) for r in summary.collect() if r["nsc_id"] in ("NSC-2", "NSC-3")} == {("NSC-2", "success", None), ("NSC-3", "failed", groups.NO_VECTOR)}


def test_store_snapshots_merge_and_name_what_differs(spark, tmp_path):
    frame = lambda *r: spark.createDataFrame(list(r), "k string, v long, branches array<string>")
    at, settings = f"{tmp_path}/store", {"width": 4, "policy": "error"}
    store.save(frame(("a", 1, ["x"]), ("b", 2, ["x"])), at, settings, "k", "v", ["branches"])
    got = store.save(frame(("b", 3, ["y"]), ("c", 4, ["y"])), at, settings, "k", "v", ["branches"])
    assert {r["k"]: (r["v"], r["branches"]) for r in got.collect()} == {"a": (1, ["x"]), "b": (3, ["x", "y"]), "c": (4, ["y"])}
    with pytest.raises(store.FingerprintError, match="policy, width"):
        store.load(spark, f"{at}/1", {"width": 5})
    assert store.save(frame(("z", 9, ["x"])), at, settings, "k", "v", ["branches"], rebuild=True).count() == 1
    with pytest.raises(ValueError):
        store.waves(got, "v", 0)


def test_encoders(spark):
    jobs = spark.createDataFrame([("h1", "ACCA"), ("h2", "A*")], "sequence_hash string, sequence string")
    got = {r["sequence_hash"]: r for r in encode.encode(jobs, encode.OneHotEncoder("AC"), 3, 1, element="double").collect()}
    assert got["h1"]["embedding"] == [0.5, 0.5] and got["h1"]["num_chunks"] == 2 and got["h2"]["error_kind"] == "inference_error"

    class Wrong(encode.OneHotEncoder):
        def states(self, chunk):
            return np.zeros((1, self.width))

    with pytest.raises(Exception, match="another shape"):
        encode.encode(jobs, Wrong("AC"), 3, 1).collect()
    with pytest.raises(ValueError):
        encode.residue_mean(np.zeros((0, 2)))


def test_coverage_and_numbers(spark):
    plan = F.array(*(F.struct(F.lit(a).alias("chunk_start"), F.lit(b).alias("chunk_end")) for a, b in ((0, 6), (4, 10))))
    c = spark.range(1).select(S.coverage(plan, F.lit(10), lambda x: F.when(x["chunk_start"] == 0, 2.0).otherwise(4.0)).alias("c")).head()["c"]
    assert (c["residues"], c["total"], c["least"], c["most"], c["pooled"], c["error"]) == (10, 12, 1, 2, 3.0, None)
    gap = spark.range(1).select(S.coverage(F.slice(plan, 2, 1), F.lit(10)).alias("c")).head()["c"]
    assert gap["error"] == "uncovered position"
    ids = spark.createDataFrame([(i,) for i in (5, -3, 9000, 12, 4095, 4096)], "k long")
    assert [r["place"] for r in order.numbered_ids(ids, "k").orderBy("k").collect()] == [1, 2, 3, 4, 5, 6]
    assert pairs.drawn_pairs(ids.limit(1), "k", 5).count() == 0
    assert {(r["a"], r["b"]) for r in pairs.drawn_pairs(ids.where("k < 13"), "k", 500).collect()} == {(-3, 5), (-3, 12), (5, 12)}


def test_groups(spark, tmp_path):
    mean = spark.createDataFrame([("a", [0.0, 0.0])], "g string, m array<double>")
    with pytest.raises(Exception, match="isn't finite or is zero"):
        groups.checked_mean(mean, "m").collect()
    spark.createDataFrame([(1, [3.0, 4.0], 0.5, True), (0, [1.0, 2.0], 0.0, True)], "output int, weight array<double>, bias double, trained boolean").write.parquet(f"{tmp_path}/w")
    assert groups.load_projection(spark, f"{tmp_path}/w", 2, 2) == ([[1.0, 2.0], [3.0, 4.0]], [0.0, 0.5])
    with pytest.raises(ValueError):
        groups.load_projection(spark, f"{tmp_path}/w", 3, 2)
    found = relation.filter_rows(relation_rows(spark), ids=["nsc 2", "zzz"])
    assert [r["source_row_index"] for r in found.collect()] == [1]
    with pytest.raises(relation.InputError):
        relation.filter_rows(relation_rows(spark), ids=["zzz"])


def test_positions_that_do_not_fit_end_the_job(spark):
    frame = spark.createDataFrame([(["<cls>", "A", "C", "<eos>"], [1, 2], "AC")], "t array<string>, p array<int>, s string")
    ok = S.checked_order(F.col("t"), S.checked_positions(F.col("p"), F.length("s")), F.col("s"))
    assert frame.select(ok.alias("p")).head()["p"] == [1, 2]
    with pytest.raises(Exception, match="3 residues has 2 positions"):
        frame.select(S.checked_positions(F.col("p"), F.lit(3))).collect()
    with pytest.raises(Exception, match="another order"):
        frame.select(S.checked_order(F.col("t"), F.reverse("p"), F.col("s"))).collect()


def test_an_entry_that_went_missing(spark):
    prepared = rows.prepare(spark.createDataFrame([(0, "1", "AC"), (1, "2", "AC"), (2, "3", "CA")], "source_row_index long, nsc_id string, sequence string"))
    had = prepared.where("source_row_index = 0").select("sequence_hash")
    got = {r["source_row_index"]: (r["status"], r["error_kind"]) for r in rows.resolve(prepared, had.limit(0), before=had).collect()}
    assert got == {0: ("failed", "missing_embedding"), 1: ("failed", "missing_embedding"), 2: ("failed", "not_encoded")}


def test_encoding_again_finds_what_differs(spark):
    from loomvec.operators import diagnostics

    jobs = spark.createDataFrame([("a", "AC"), ("b", "CC"), ("c", "A*"), ("d", "AA")], "sequence_hash string, sequence string")
    entries = spark.createDataFrame([("a", [0.5, 0.5]), ("b", [0.1, 0.9]), ("c", [1.0, 0.0]), ("gone", [1.0, 0.0])], "sequence_hash string, embedding array<double>")
    out = diagnostics.reencode_check(jobs, entries, lambda j: encode.encode(j, encode.OneHotEncoder("AC"), 9, 1))
    assert {r["sequence_hash"]: r["deterministic"] for r in out.collect()} == {"a": True, "b": False, "c": False}
    assert tuple(diagnostics.reencode_summary(out).head()) == (3, 1, "warning")


def test_collapsed_vectors_are_a_warning(spark):
    many = spark.range(1200).select("id", F.array(F.lit(1.0), (F.col("id") / 1e6).cast("double")).alias("v"))
    got = pairs.cosine_report(many, "id", "v").head()
    assert (got["method"], got["vectors"], got["collapsed"]) == ("sampled", 1200, 1.0) and got["pairs"] == pairs.DRAWN and "same way" in got["warning"]
    few = pairs.cosine_report(many.where("id < 3").withColumn("v", F.array(F.lit(1.0), F.col("id").cast("double"))), "id", "v").head()
    assert (few["method"], few["pairs"], few["warning"]) == ("exact", 3, None)
