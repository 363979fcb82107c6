"""Queries over whole tables against small tables that a cut would change."""

import hashlib

import numpy as np
import pytest

from loomvec.plans import queries as Q


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    at = f"file://{tmp_path_factory.mktemp('whole')}"
    long = "ACDEF" * 1000
    rows = [(0, long + "A"), (1, long + "C"), (2, long + "A"), (3, long + "D"), (4, "?! 12"), (10, "acd ef")]
    spark.createDataFrame([(i, t, "en", "src1", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    return at


def run(spark, sf, name):
    return Q.queries()[name](spark, sf).collect()


def test_whole_texts_are_hashed_and_measured(spark, sf):
    status = {r["source_row_index"]: r for r in run(spark, sf, "row_status")}
    assert {i: r["error_kind"] for i, r in status.items() if r["error_kind"]} == {4: "invalid_sequence"}
    assert len({status[i]["sequence_hash"] for i in (0, 1, 2, 3)}) == 3
    assert {(r["source_row_index"], r["n"]) for r in run(spark, sf, "unique_jobs")} == {(0, 5001), (1, 5001), (3, 5001), (10, 5)}
    assert [r["n"] for r in run(spark, sf, "duplicate_hashes")] == [2]
    assert [r["max_length"] for r in run(spark, sf, "dataset_statistics")] == [5001]
    assert {r["source_row_index"] for r in run(spark, sf, "resolved_status") if r["status"] == "success"} == {0, 2}


def test_all_jobs_are_ordered_all_documents_merged_all_components_written(spark, tmp_path):
    at = f"file://{tmp_path}"
    texts = ["".join(chr(65 + int(d)) for d in str(10**6 + i)) + "A" * (i % 13) for i in range(300)]
    spark.createDataFrame([(i, t, "en", "src1", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (999, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame([(0, 0, [float(x) for x in range(64)])], "vec_id long, label int, embedding array<float>").write.parquet(f"{at}/embeddings.parquet")
    jobs = {(hashlib.sha256(t.encode()).hexdigest(), len(t)) for i, t in enumerate(texts) if i % 10 != 9}
    want = [(n, h, m) for n, (h, m) in enumerate(sorted(jobs, key=lambda x: (-x[1], x[0])), 1)]
    assert sorted((r["place"], r["sequence_hash"], r["n"]) for r in run(spark, at, "encode_order")) == want and len(want) > 100
    merged = {r["doc_id"]: (r["v"], r["branches"]) for r in run(spark, at, "store_merge")}
    assert merged == {i: (len(t), "disk,en" if i == 1 else "en") for i, t in enumerate(texts)} | {999: (0, "disk")}
    assert list(run(spark, at, "wide_embedding")[0])[2:] == [float(x) for x in range(64)]


def test_pairs_across_labels_count_and_draws_are_distinct(spark, tmp_path):
    rng = np.random.default_rng(3)
    v = rng.normal(size=(700, 64))
    v[1] = v[0]  # collapsed, under another label
    spark.createDataFrame([(i, i % 7, [float(x) for x in v[i]]) for i in range(700)], "vec_id long, label int, embedding array<double>").write.parquet(f"file://{tmp_path}/embeddings.parquet")
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    c = (u @ u.T)[np.triu_indices(700, 1)]
    got = run(spark, f"file://{tmp_path}", "pairwise_cosine_stats")[0]
    assert got["pairs"] == 700 * 699 // 2 and got["max"] == 1.0 and got["collapsed"] == round(1 / len(c), 6)
    for p in (1, 5, 25, 50, 75, 95, 99):
        assert abs(got[f"p{p}"] - np.percentile(c, p)) < 1e-6
    drawn = run(spark, f"file://{tmp_path}", "drawn_pairs_cosine")
    assert len({(r["a"], r["b"]) for r in drawn}) == len(drawn) == 20000 and all(r["a"] < r["b"] for r in drawn)
    assert all(abs(r["cosine"] - u[r["a"]] @ u[r["b"]]) < 1e-6 for r in drawn[:500])


def test_texts_without_a_letter_have_no_events(spark, tmp_path):
    at = f"file://{tmp_path}"
    rows = [(0, "12 ?!", "en", "s", 5), (1, "", "en", "s", 0), (2, None, "en", "s", 0), (3, "a boxX", "en", "s", 6)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{at}/documents.parquet")
    assert sorted(tuple(r) for r in run(spark, at, "special_events")) == [(3, "B", 1, 1, 1), (3, "O", 1, 2, 2), (3, "X", 2, 3, 4)]
    assert sorted(tuple(r) for r in run(spark, at, "symbol_positions")) == [(3, "B", "1"), (3, "O", "2"), (3, "X", "3,4")]


def test_events_are_made_once(spark, sf):
    plan = Q.queries()["replaced_events"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1
