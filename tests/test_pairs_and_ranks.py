"""Pruned top pairs and exact order statistics, by brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomvec.operators import pairs, quantiles


def frame_of(spark, v, keys=None):
    keys = range(len(v)) if keys is None else keys
    return spark.createDataFrame([(int(i), [float(x) for x in row]) for i, row in zip(keys, v, strict=True)], "id long, v array<double>")


def brute(v, k, farthest):
    u = v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
    c = u @ u.T
    i, j = np.triu_indices(len(v), 1)
    s = np.round(c[i, j], 9)
    order = np.lexsort((j, i, s)) if farthest else np.lexsort((-j, -i, -s))
    return [(int(i[t]), int(j[t])) for t in order[:k]], s[order[:k]]


@pytest.mark.parametrize("farthest", [False, True])
def test_clusters_are_pruned_and_exact(spark, farthest):
    r = np.random.default_rng(1)
    centres = r.normal(size=(30, 32))
    v = np.concatenate([c + 0.02 * r.normal(size=(40, 32)) for c in centres])
    got = pairs.top_pairs(frame_of(spark, v), "id", "v", 15, farthest, block=64)
    want, scores = brute(v, 15, farthest)
    assert [(x["a"], x["b"]) for x in got.pairs.collect()] == want
    assert np.allclose([x["cosine"] for x in got.pairs.collect()], scores, atol=1e-8)
    blocks = 0.5 + (0.25 + 2 * (got.visited + got.skipped)) ** 0.5
    assert round(blocks) >= 1200 // 64 and got.skipped > (0.3 if farthest else 2) * got.visited


def test_without_structure_all_blocks_meet(spark):
    v = np.random.default_rng(2).normal(size=(300, 48))
    got = pairs.top_pairs(frame_of(spark, v), "id", "v", 10, block=32)
    assert [(x["a"], x["b"]) for x in got.pairs.collect()] == brute(v, 10, False)[0]


def test_many_equal_vectors_and_odd_rows(spark):
    v = np.tile(np.array([[1.0, 2.0, 3.0, 4.0]]), (200, 1))
    odd = spark.createDataFrame([(None, [1.0] * 4), (900, None)], "id long, v array<double>")
    got = pairs.top_pairs(frame_of(spark, v).unionByName(odd), "id", "v", 4, block=16)
    assert [round(x["cosine"], 9) for x in got.pairs.collect()] == [1.0] * 4 and all(x["a"] < x["b"] for x in got.pairs.collect())
    assert pairs.top_pairs(frame_of(spark, v).limit(0), "id", "v", 4).pairs.count() == 0
    assert pairs.top_pairs(frame_of(spark, v[:3]), "id", "v", 50).pairs.count() == 3
    assert pairs.top_pairs(frame_of(spark, v[:2], [7, 7]), "id", "v", 5).pairs.count() == 0
    with pytest.raises(ValueError):
        pairs.top_pairs(odd, "id", "v", 0)


def test_regions_of_blocks_meet_and_rows_are_sent_to_few(spark, monkeypatch):
    assert pairs.regions_of(600_000, 2400) <= 40 and pairs.regions_of(100, 3) == 3  # a row went to every other block before
    monkeypatch.setattr(pairs, "REGIONS", 3)
    monkeypatch.setattr(pairs, "SCORES", 500)
    v = np.random.default_rng(5).normal(size=(400, 24)).astype(np.float32).astype(float)
    for frame in (frame_of(spark, v), frame_of(spark, v).withColumn("v", F.col("v").cast("array<float>"))):
        for farthest in (False, True):
            assert [(x["a"], x["b"]) for x in pairs.top_pairs(frame, "id", "v", 12, farthest, block=16).pairs.collect()] == brute(v, 12, farthest)[0]
        got = pairs.all_pairs_statistics(frame, "id", "v", block=16).head()
        u = v / np.linalg.norm(v, axis=1, keepdims=True)
        c = (u @ u.T)[np.triu_indices(400, 1)]
        assert got["pairs"] == len(c) and np.allclose([got["min"], got["max"], got["mean"], got["median"], got["p1"], got["p99"]], [c.min(), c.max(), c.mean(), np.sort(c)[(len(c) + 1) // 2 - 1], *np.percentile(c, [1, 99])], atol=1e-6)


SHARES = {f"p{p}": p / 100 for p in (0, 1, 5, 25, 50, 75, 95, 99, 100)}


@pytest.mark.parametrize("kind", ["normal", "wide", "third", "same", "two", "one", "integers"])
def test_order_statistics(spark, kind, monkeypatch):
    monkeypatch.setattr(quantiles, "FEW", 20)
    monkeypatch.setattr(quantiles, "BINS", 16)
    r = np.random.default_rng(3)
    x = {
        "normal": r.normal(size=3000), "wide": np.concatenate([r.normal(size=900), [-1.7e308, 1.7e308, 1e300], r.normal(size=50) * 1e-300]), "third": np.concatenate([np.full(1000, 2.5), r.normal(size=2000)]),
        "same": np.full(500, -3.0), "two": np.array([1.0, 4.0]), "one": np.array([7.0]), "integers": r.integers(0, 9, 2000).astype(float),
    }[kind]
    rows = spark.createDataFrame([(float(v),) for v in x] + [(None,), (float("nan"),), (float("inf"),)], "x double").repartition(5)
    got = quantiles.order_statistics(rows, "x", SHARES, {"median": 0.5, "most": 1.0}).head()
    assert [got["median"], got["most"]] == [np.sort(x)[(len(x) + 1) // 2 - 1], x.max()]
    with np.errstate(all="ignore"):
        want = np.quantile(x, list(SHARES.values())) if kind != "wide" else None
    if want is not None:
        assert np.allclose([got[c] for c in SHARES], want, rtol=1e-12)
    else:
        assert [got["p0"], got["p100"]] == [-1.7e308, 1.7e308] and np.isclose(got["p50"], np.sort(x)[(len(x) - 1) // 2 : len(x) // 2 + 1].mean())


def test_order_statistics_without_values(spark):
    none = spark.createDataFrame([(None,), (float("nan"),)], "x double")
    assert quantiles.order_statistics(none, "x", {"p5": 0.05}).head()["p5"] is None
    assert quantiles.values_at(none, "x", [0]) == {}
    with pytest.raises(ValueError):
        quantiles.order_statistics(none, "x", {"p": 1.5})
    with pytest.raises(ValueError):
        quantiles.values_at(spark.range(3).select(F.col("id").alias("x")), "x", [3])
