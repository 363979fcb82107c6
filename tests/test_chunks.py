"""Encoding with a row for each chunk, against encoding of whole sequences."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomvec.functions import sequences as S
from loomvec.operators import encode, groups

LENGTHS = (1, 2, 257, 511, 512, 513, 896, 897, 2046, 2347, 3837)


def protein(length, seed):
    return "".join("ACDEFGHIKLMNPQRSTVWY"[(7 * i * i + seed + i) % 20] for i in range(length))


@pytest.mark.parametrize(("size", "overlap"), [(2046, 256), (512, 128), (512, 0), (100, 99), (64, 40), (7, 900)])
def test_chunks_pool_to_the_whole(spark, size, overlap):
    texts = {f"h{n}": protein(n, n) for n in LENGTHS[: 11 if size > 100 else 8]}
    jobs = spark.createDataFrame(list(texts.items()), "sequence_hash string, sequence string")
    encoder = encode.ProfileEncoder()
    got = {r["sequence_hash"]: r for r in encode.encode_by_chunks(jobs, encoder, size, overlap, element="double").collect()}
    assert got.keys() == texts.keys()
    for h, text in texts.items():
        v, n = encode.pool(encoder, text, size, overlap)
        assert got[h]["num_chunks"] == n and np.allclose(got[h]["embedding"], v, rtol=1e-12) and got[h]["error"] is None


def test_failures_and_odd_sequences(spark):
    rows = [("bad", "A" * 900 + "*" + "A" * 900 + "?"), ("good", "ACD"), ("empty", ""), ("none", None), ("zero", "X" * 40)]
    jobs = spark.createDataFrame(rows, "sequence_hash string, sequence string")
    got = {r["sequence_hash"]: r for r in encode.encode_by_chunks(jobs, encode.ProfileEncoder(), 100, 20).collect()}
    assert {h: r["error_kind"] for h, r in got.items()} == {"bad": "inference_error", "good": None, "empty": "embedding_quality", "none": "embedding_quality", "zero": "embedding_quality"}
    assert "'*'" in got["bad"]["error"] and all(got[h]["embedding"] is None for h in got if h != "good")
    assert encode.encode_by_chunks(jobs.limit(0), encode.ProfileEncoder(), 100, 20).count() == 0
    with pytest.raises(ValueError):
        encode.encode_by_chunks(jobs, encode.ProfileEncoder(), 0, 0)


def test_one_long_sequence_is_many_tasks(spark):
    text = protein(300_000, 1)
    jobs = spark.createDataFrame([("long", text)], "sequence_hash string, sequence string")

    class Seen(encode.ProfileEncoder):
        def states(self, chunk):
            if len(chunk) > 512:
                raise AssertionError("more than a chunk")
            return super().states(chunk)

    out = encode.encode_by_chunks(jobs, Seen(), 512, 128, element="double", parts=16)
    row = out.head()
    assert row["num_chunks"] == encode.pool(encode.OneHotEncoder("ACDEFGHIKLMNPQRSTVWY"), text[:1], 512, 128)[1] * (-(-(300_000 - 512) // 384) + 1)
    assert np.allclose(row["embedding"], encode.pool(encode.ProfileEncoder(), text, 512, 128)[0])


def test_chunk_texts_follow_the_plan(spark):
    texts = [(protein(n, 3) + ("é\n" if n % 2 else ""),) for n in (*LENGTHS, 0)]
    frame = spark.createDataFrame(texts, "t string")
    for size, overlap in ((512, 128), (10, 9), (10, 0), (7, 3)):
        plan = F.transform(S.chunk_plan(F.length("t"), size, overlap), lambda c: F.struct(c["chunk_start"].alias("chunk_start"), F.substring(F.col("t"), c["chunk_start"] + 1, c["chunk_end"] - c["chunk_start"]).alias("text")))
        assert frame.select(S.chunk_texts(F.col("t"), size, overlap).alias("a"), plan.alias("b")).where("a != b").count() == 0


@pytest.mark.parametrize("dim", [1, 63, 64, 65, 200])
def test_wide_means_are_blocks(spark, dim):
    r = np.random.default_rng(dim)
    v = r.normal(size=(90, dim))
    frame = spark.createDataFrame([(i % 4 or None, [float(x) for x in v[i]]) for i in range(90)], "g int, v array<double>")
    got = {r["g"]: r for r in groups.vector_mean(frame, "g", "v", dim).collect()}
    for g in (None, 1, 2, 3):
        rows = v[[i for i in range(90) if (i % 4 or None) == g]]
        assert got[g]["members"] == len(rows) and np.allclose(got[g]["mean"], rows.mean(axis=0))
    plan = groups.vector_mean(frame, "g", "v", dim)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_avg") + plan.count("partial_sum") <= groups.ELEMENTS * 2


@pytest.mark.parametrize("encoder", [encode.ProfileEncoder(), encode.OneHotEncoder("ACDEFGHIKLMNPQRSTVWY")])
def test_chunks_of_one_length_go_together(encoder):
    texts = [protein(60, 1), protein(60, 2)[:59] + "*", protein(60, 3), "é" * 59 + "Ж"]
    weights = [encode.chunk_weights(s, 60, 4000, 60, 20) for s in (0, 40, 2000, 80)]
    sums, good = encoder.sums(texts, weights)
    assert list(good) == [True, False, True, False]
    for i in (0, 2):
        assert np.allclose(sums[i], weights[i] @ encoder.states(texts[i]), rtol=1e-12)
    assert encode.chunk_weights(2000, 60, 4000, 60, 20) is encode.chunk_weights(2040, 60, 4000, 60, 20)  # made once
    with pytest.raises(encode.RowError, match="'\\*'"):
        encoder.states(texts[1])
