"""Cases of the pipeline's stages that narrower stages would miss."""

import numpy as np
import pytest

from loomvec.llm import minhash, mixing
from loomvec.llm import pipeline as P

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "src", len(t)) for i, t in rows], SCHEMA)


def test_copies_with_a_block_removed_or_added(spark):
    rows = []
    for k, share in enumerate([0.83, 0.81, 1.2, 1.24, 0.77, 1.3]):
        w = [f"w{x}" for x in np.random.default_rng(k).integers(0, 10**6, 520)]
        rows += [(10 * k, " ".join(w[:400])), (10 * k + 1, " ".join(w[: round(400 * share)]))]
    changed = [f"w{x}" for x in np.random.default_rng(99).integers(0, 10**6, 400)]
    rows.append((90, " ".join(changed)))
    changed[20::32] = ["new"] * len(changed[20::32])  # 3-word similarity 0.83, 5-word 0.74
    rows.append((91, " ".join(changed)))
    left = {r["doc_id"] for r in P.dedup_stage(spark, frame(spark, rows), "").collect()}
    assert left == {0, 10, 20, 30, 40, 41, 50, 51, 90, 91}


@pytest.mark.parametrize("percent", [3, 20, 50, 80, 85, 95])
def test_bands_follow_the_percentage(percent):
    count, band = minhash.banding(percent)
    assert (1 - (percent / 100) ** band) ** (2 * count // band) <= 1e-6
    assert minhash.banding(85) == (96, 6)


def test_scarce_toxic_documents_do_not_set_the_budget(spark, tmp_path):
    rng = np.random.default_rng(5)
    made = lambda words: " ".join(words[i] for i in rng.integers(0, len(words), 60))
    clean, toxic = [f"c{i}" for i in range(40)], [f"t{i}" for i in range(40)]
    docs = frame(spark, [(i, made(clean)) for i in range(600)] + [(600, made(toxic))])
    labels = [(i, 1, 0) for i in range(0, 600, 3)] + [(600, 1, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"file://{tmp_path}/labels.parquet")
    assert {r["doc_id"] for r in P.mixing_stage(spark, docs, f"file://{tmp_path}").collect()} == set(range(600))


def test_totals_reached_are_reported(spark):
    docs = frame(spark, [(i, "good fine nice " * 20) for i in range(50)] + [(50, "bad awful vile " * 20)])
    labels = spark.createDataFrame([(i, 1, 0) for i in range(20)] + [(50, 1, 1)], "doc_id long, quality int, toxic int")
    targets = {"prose": 0.5, "toxic": 0.5, "noise": 0.0}
    mixed = mixing.mix(docs, labels, targets)
    got = {r["domain"]: r for r in mixing.totals(mixed, targets).collect()}
    rows = [r["mix"] for r in mixed.collect()]
    for k, d in enumerate(["prose", "toxic"]):
        assert got[d]["target_tokens"] == pytest.approx(1530)
        assert got[d]["rate_tokens"] == pytest.approx(sum(r["tokens"] * r["posteriors"][k] * r["rate"] for r in rows))
        assert got[d]["copied_tokens"] == pytest.approx(sum(r["tokens"] * r["posteriors"][k] * r["copies"] for r in rows))
    assert got["toxic"]["rate_tokens"] < 0.5 * got["toxic"]["target_tokens"]  # rates end at 4: the target is missed, and it shows


def test_targets_go_by_name(spark):
    docs = frame(spark, [(i, "good fine nice " * 20) for i in range(50)] + [(50 + i, "bad awful vile " * 20) for i in range(30)])
    labels = spark.createDataFrame([(i, 1, 0) for i in range(40)] + [(50 + i, 1, 1) for i in range(25)], "doc_id long, quality int, toxic int")
    one = {"prose": 0.7, "toxic": 0.3, "noise": 0.0}
    rates = [{r["doc_id"]: r["mix"]["rate"] for r in mixing.mix(docs, labels, t).collect()} for t in (one, dict(reversed(one.items())))]
    assert rates[0] == pytest.approx(rates[1]) and rates[0][0] > 1 > rates[0][50]  # sums of rows have no fixed order
    with pytest.raises(ValueError, match="noise"):
        mixing.mix(docs, labels, {"prose": 0.7, "toxic": 0.3})
    with pytest.raises(ValueError, match="out of reach"):
        mixing.mix(docs, labels, {"prose": 0.0, "toxic": 1.0, "noise": 0.0}, budget=4.0, off_most=0.05)
    mixing.mix(docs, labels, one, off_most=0.05)
