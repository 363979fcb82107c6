"""The pipeline against a version of every stage in plain Python."""

import re
from collections import Counter, defaultdict
from math import log

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomvec.llm import mixing, tokens
from loomvec.llm import pipeline as P

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, verdict string, mix string"
VOCABULARY = {"en": [a + b for a in "abcde" for b in "aeio"], "fr": [a + b + "u" for a in "lmnop" for b in "rstv"]}


def words(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def made(lang, seed, n=80):
    return " ".join(VOCABULARY[lang][i] for i in np.random.default_rng(seed).integers(0, 20, n))


def corpus():
    rows = [(i, made("en" if i % 2 else "fr", i), "en" if i % 2 else "fr") for i in range(120)]
    rows += [(200 + i, " ".join(f"{w} hateful" if j % 40 == 20 else w for j, w in enumerate(made("en", 500 + i).split())), "en") for i in range(8)]
    rows += [(300 + i, made("en", i).replace(" ", "%%% "), "en") for i in range(10)]
    changed = made("en", 1).split()
    changed[40] = "da"
    rows += [(401, made("en", 1), "en"), (402, " ".join(changed), "en"), (403, None, None), (404, "", "en"), (405, "aa be", None), (None, made("fr", 900), "fr"), (406, made("fr", 901), "fr"), (406, made("fr", 901), "fr"), (407, made("en", 902, 5000), "en"), (408, "aa be aa " * 60, "en")]
    return [(i, t, lang, "src", len(t or ""), None, "x") for i, t, lang in rows]


def labelled():
    good = [(i, 1, 0) for i in range(0, 120, 2)] + [(i, 1, 0) for i in range(1, 120, 4)]
    return good + [(200 + i, 1, 1) for i in range(4)] + [(300 + i, 0, 0) for i in range(5)] + [(None, 1, 0), (99, None, None)]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    at = f"file://{tmp_path_factory.mktemp('sf')}"
    spark.createDataFrame(corpus(), SCHEMA).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(labelled(), "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    return at


@pytest.fixture(scope="module")
def stages(spark, tables):
    """Input and output rows of every stage."""
    docs, out = spark.read.parquet(f"{tables}/documents.parquet"), {}
    for name, stage in P.STAGES:
        got = P.written(stage(spark, docs, tables), name)
        out[name] = (docs.collect(), got.collect())
        docs = got
    return out


def pairs(rows):
    return Counter((r["doc_id"], r["text"]) for r in rows)


def test_quality(stages):
    before, after = stages["quality"]
    trusted = {i for i, quality, toxic in labelled() if quality == 1 and not toxic and i is not None}
    grams = []
    for r in before:
        runs = re.findall(r"[^\W\d_]+|[^a-zA-Z\s]+", r["text"] or "")
        grams.append(runs + list(zip(runs, [*runs[1:], None], strict=False)))
    raw, target = Counter(), Counter()
    for r, g in zip(before, grams, strict=True):
        raw.update(g)
        if r["doc_id"] in trusted:
            target.update(g)
    n_raw, n_target, half = sum(raw.values()), sum(target.values()), (1 << 17) * 0.5
    want, scores = Counter(), []
    for r, g in zip(before, grams, strict=True):
        w = words(r["text"])
        windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        twice = {x for x, n in Counter(windows).items() if n > 1}
        covered = {i + d for i, x in enumerate(windows) if x in twice for d in range(3)}
        if len(w) < 50 or 100 * len(covered) > 50 * len(w):
            continue
        score = sum(log((target[x] + 0.5) / (n_target + half)) - log((raw[x] + 0.5) / (n_raw + half)) for x in g) / len(g)
        scores.append(score)
        if score >= -0.5:
            want[r["doc_id"], r["text"]] += 1
    assert min(abs(s + 0.5) for s in scores) > 0.01  # hashed n-grams share buckets now and then
    assert pairs(after) == want
    assert not {300 + i for i in range(10)} & {i for i, _ in want} and set(range(0, 120, 2)) <= {i for i, _ in want}


def test_language(stages):
    before, after = stages["language"]
    assert pairs(after) == pairs(before)  # all that is left has words of one learned language


def test_near_duplicates(stages):
    before, after = stages["near_duplicates"]
    sets = {r["doc_id"]: {tuple(words(r["text"].lower())[i : i + 3]) for i in range(len(words(r["text"])) - 2)} for r in before if r["doc_id"] is not None}
    least = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                    least[a] = least[b] = min(least[a], least[b])
        if all(least[least[i]] == least[i] for i in sets):
            break
    assert pairs(after) == pairs([r for r in before if r["doc_id"] is None or least[r["doc_id"]] == r["doc_id"]])
    assert not {401, 402} & {r["doc_id"] for r in after}


def mixing_words(text):
    text = re.sub(f"({mixing.SYMBOL_RUN})", r" \1 ", (text or "").lower().translate(str.maketrans(mixing.MARKS, " " * len(mixing.MARKS))))
    return words(text)


def test_mixing(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    before, after = docs.collect(), P.mixing_stage(spark, docs, tables).collect()
    vocabulary = sorted({w for r in before for w in mixing_words(r["text"])})
    bucket = dict(spark.createDataFrame([(w,) for w in vocabulary], "w string").select("w", F.xxhash64("w").bitwiseAND(F.lit((1 << 17) - 1))).collect())
    draw = spark.createDataFrame([(r["doc_id"], r["text"]) for r in before], "doc_id long, text string").select((F.xxhash64("doc_id", "text").bitwiseAND(F.lit((1 << 20) - 1)) / float(1 << 20)).alias("d"))
    draw = np.array([r["d"] for r in draw.collect()])
    domain = {i: 1 if toxic else 0 if quality else 2 for i, quality, toxic in labelled() if i is not None and quality is not None}
    held = [{bucket[w] for w in mixing_words(r["text"])} for r in before]
    rows = np.zeros(3)
    counts = defaultdict(Counter)
    for r, b in zip(before, held, strict=True):
        if r["doc_id"] in domain:
            rows[domain[r["doc_id"]]] += 1
            counts[domain[r["doc_id"]]].update(b)
    assert all(rows)
    logs = np.zeros((len(before), 3))
    for k in (1, 2):
        logs[:, k] = log(rows[k] / rows[0])
        share = {x: [(counts[i][x] + 0.5) / (rows[i] + 1) for i in (0, k)] for x in set().union(*counts.values())}
        for x, (a, b) in share.items():
            ratio, error = log(b / (1 - b)) - log(a / (1 - a)), (1 / (counts[k][x] + 0.5) + 1 / (counts[0][x] + 0.5)) ** 0.5
            if abs(ratio) >= mixing.RATIO_LEAST and abs(ratio) >= mixing.ERRORS_LEAST * error:
                logs[:, k] += log((1 - b) / (1 - a))
                logs[[x in h for h in held], k] += ratio
    p = np.exp(logs - logs.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    n = np.array([len(mixing_words(r["text"])) for r in before], dtype=float)
    base = np.maximum(n @ p, 1e-9)
    weights = np.array(list(P.MIXTURE.values())) * (n @ p > 0)
    weights /= weights.sum()
    goal = weights * min((n @ p)[k] / weights[k] for k in range(3) if weights[k])
    rate, errors, made_steps = np.ones(len(n)), [], 0
    while True:
        total = (rate * n) @ p
        errors.append(np.abs(total - goal).max())
        if made_steps >= 40 or len(errors) > 1 and errors[-1] > 0.99 * errors[-2] or errors[-1] <= 1e-3 * goal.sum():
            break
        rate = np.clip(rate - 1e-3 * (rate - 1) - p @ ((total - goal) / base), 0, 1)
        made_steps += 1
    sure = np.abs(rate - draw) > 2e-3
    assert sure.mean() > 0.95
    got = pairs(after)
    for r, kept, certain in zip(before, (draw < rate) | (p[:, 0] >= P.CLEAN), sure, strict=True):
        assert not certain or (got[r["doc_id"], r["text"]] > 0) == kept
    mixed = mixing.mix(docs, spark.read.parquet(f"{tables}/labels.parquet"))  # op3's own parameters
    by_key = {(r["doc_id"], r["text"]): (q, int(size)) for r, q, size in zip(before, p, n, strict=True)}
    weights = np.array(list(mixing.TARGETS.values()))
    reached = np.zeros(3)
    for r in mixed.collect():
        q, size = by_key[r["doc_id"], r["text"]]
        assert r["mix"]["tokens"] == size and np.allclose(r["mix"]["posteriors"], q, atol=1e-6)
        assert 0 <= r["mix"]["rate"] <= 4 and r["mix"]["copies"] in (int(r["mix"]["rate"]), int(r["mix"]["rate"]) + 1)
        reached += r["mix"]["rate"] * size * q
    assert np.abs(reached - weights * n.sum()).max() < 0.02 * n.sum()


def test_packing(spark, tables, stages):
    before, after = stages["packing"]
    encode = tokens.encoder(tokens.default_vocabulary())
    want = Counter((r["doc_id"], len(ids) + 1) for r, ids in zip(before, encode.encode([r["text"] for r in before]), strict=True))
    sizes, sequences = Counter(), defaultdict(list)
    for r in after:
        sizes[r["doc_id"], r["doc_tokens"]] += r["length"]
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert sizes == Counter({k: k[1] * n for k, n in want.items()})
    for x in sequences.values():
        x.sort()
        assert x[0][0] == 0 and all(a + m == b for (a, m), (b, _) in zip(x, x[1:], strict=False)) and sum(m for _, m in x) <= 1024
    assert len(sequences) <= sum(sizes.values()) / 1024 * 1.1 + 1
    again = P.run(spark, tables).collect()
    assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in again) == Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in after)


def test_empty_tables(spark, tmp_path):
    at = f"file://{tmp_path}/sf"
    spark.createDataFrame([], SCHEMA).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    assert P.run(spark, at).count() == 0
