"""Byte-level BPE against tiktoken, the filter audit by simulation, hard negatives by brute force."""

import base64
import hashlib
import re
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomvec.llm import bpe, filter_audit, hard_negatives
from loomvec.llm import queries as Q

tiktoken = pytest.importorskip("tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(bpe.default_ranks(), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=bpe.default_pattern(), mergeable_ranks=ranks, special_tokens={})


def odd_texts():
    r = np.random.default_rng(5)
    pick = lambda letters, n: "".join(letters[i] for i in r.integers(0, len(letters), n))
    out = ["", None, "a" * 900, "ab" * 1500, "aaab" * 700, " " * 700, "\n" * 400, " \x1c\x1d x \x85\xa0y", "<|endoftext|> x", "don't I'LL we've", "日本語" * 300, "é" * 400, "\U0001f600\U0001f468‍\U0001f469", "x\x00y"]
    out += [pick("=-_#*/\\", n) for n in r.integers(1, 500, 40)] + [pick("etaoin shrdlu\n", n) for n in r.integers(1, 500, 40)] + [pick("etaoinshrdlu", n) for n in r.integers(250, 700, 40)]
    return out + ["".join(map(chr, r.integers(0x20, 0x3000, n))) for n in r.integers(1, 60, 300)]


def test_ids_equal_the_library(library):
    own = bpe.codec(bpe.default_ranks(), bpe.default_pattern())
    texts = odd_texts()
    for t, ids in zip(texts, own.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(t or "")
        assert own.decode(ids) == (t or "").encode()


def test_matrices_and_long_rows_agree(library, monkeypatch):
    own = bpe.codec(bpe.default_ranks(), bpe.default_pattern())
    words = sorted({w for t in odd_texts() for w in own.pieces(t or "") if 4 < len(w.encode()) <= 256})
    wide = own.encode_words(words)
    monkeypatch.setattr(bpe, "WIDEST", 2)
    assert own.encode_words(words) == wide and len(words) > 50
    monkeypatch.setattr(bpe, "WIDEST", 1 << 20)
    monkeypatch.setattr(bpe, "CELLS", 1)
    assert own.encode_words(words) == wide


def test_leftmost_alone_where_a_smaller_rank_arises():
    # merging (0, 1) to 5 makes the pair (5, 0) of rank 4 below it: the second (0, 1) is then never merged
    table = bpe.PairTable(np.array([0, 5, 4]), np.array([1, 0, 1]), np.array([5, 4, 6]))
    assert bpe.merge_long(np.array([0, 1, 0, 1]), table).tolist() == [6]
    assert [np.frombuffer(x, "<u4").tolist() for x in bpe.merge_rows(np.array([[0, 1, 0, 1]], np.int32), np.array([4]), table)] == [[6]]


def test_pair_table_finds_all_and_nothing_else():
    r = np.random.default_rng(1)
    left, right = np.unique(r.integers(0, 60000, (5000, 2)), axis=0).T
    table = bpe.PairTable(left, right, np.arange(len(left)))
    assert table.find(left.astype(np.int32), right.astype(np.int32)).tolist() == list(range(len(left)))
    assert (table.find(right[:99] + 70000, left[:99]) == bpe.NONE).all() and table.find(np.array([-1]), np.array([3]))[0] == bpe.NONE


def test_codec_columns(spark, library):
    rows = [(1, "one two", "clash"), (1, "one two", "clash"), (None, None, None), (3, "", "x"), (4, "word " * 30000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    path, pattern = bpe.default_ranks(), bpe.default_pattern()
    got = docs.withColumn("own", bpe.encoded(F.col("text"), path, pattern)).withColumn("back", bpe.decoded(F.col("own"), path, pattern)).collect()
    for r in got:
        assert np.frombuffer(r["own"], "<u4").tolist() == library.encode_ordinary(r["text"] or "") and r["back"] == (r["text"] or "").encode()
    assert Counter(r["ids"] for r in got) == Counter(r[2] for r in rows)
    assert docs.limit(0).select(bpe.encoded(F.col("text"), path, pattern)).count() == 0
    nothing = spark.createDataFrame([(None,), (b"\xff\xff\xff\x00",)], "b binary")
    assert nothing.where("b is null").select(bpe.decoded(F.col("b"), path, pattern)).head()[0] is None
    with pytest.raises(Exception, match="isn't in the vocabulary"):
        nothing.select(bpe.decoded(F.col("b"), path, pattern)).collect()


def test_codec_query_on_whole_texts(spark, library):
    got = {r["doc_id"]: r for r in Q.op11_bpe_codec(spark, "/root/testdata/sf0.001").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = np.array(library.encode_ordinary(d["text"] or ""), "<u4")
        x = got[d["doc_id"]]
        assert (x["n_tokens"], x["ids_sha256"], x["decoded_sha256"]) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((d["text"] or "").encode()).hexdigest())


# filter audit
def failing(rows):
    firsts = {}
    for i, t, _ in rows:
        if i is not None:
            firsts[t or ""] = min(firsts.get(t or "", i), i)
    out = []
    for i, t, _ in rows:
        t = t or ""
        w = re.findall("[^\x20\x09-\x0d]+", t)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and t in firsts and i > firsts[t]}
        out.append({f for f, x in fails.items() if x})
    return out


def simulated(rows, labels):
    good, toxic = ({i for i, q, x in labels if i is not None and (q, x)[k] == 1} for k in (0, 1))
    out, fails = {}, failing(rows)
    shapley = Counter()
    for part in {r[2] or "" for r in rows}:
        mine = [(r[0], f) for r, f in zip(rows, fails, strict=True) if (r[2] or "") == part]
        for order in permutations("ABCDE"):
            left = mine
            for k, f in enumerate(order):
                gone = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                out[part, "".join(order), k + 1] = [len(left), len(gone), sum(f in x[1] for x in mine) - len(gone), sum(x[1] == {f} for x in mine), sum(x[0] in good for x in gone), sum(x[0] in toxic for x in gone)]
                shapley[part, f] += len(gone)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_audit_by_simulation(spark):
    r = np.random.default_rng(2)
    made = lambda n, kinds: " ".join(f"w{i}" for i in r.integers(0, kinds, n))
    rows = [(i, made(int(r.integers(100, 400)), int(r.choice([20, 4000]))) + str(r.choice(["", " A B C " * 30, " #", " $ * |"])), [None, "", "en", "fr"][i % 4]) for i in range(150)]
    copy = rows[7][1]
    rows += [(200 + i, copy, "en") for i in range(30)] + [(3, copy, "en"), (3, copy, "en"), (None, copy, "fr"), (500, None, "en"), (501, "", "fr"), (502, " \n", None), (503, "É" * 50 + "ÀB", "en"), (504, "x" * 200000, "en")]
    labels = [(i, i % 2, int(i % 5 == 0)) for i in range(0, 210, 3)] + [(3, 0, 1), (3, None, None), (None, 1, 1), (9, 1, None)]
    docs = spark.createDataFrame([(*x, "clash", True, 1) for x in rows], "doc_id long, text string, lang string, part string, E boolean, joint int")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {(x["part"], x["filter_order"], x["step"]): tuple(x)[3:] for x in filter_audit.audit_documents(docs, marks).collect()}
    want = simulated(rows, labels)
    assert len(got) == 600 * 3 and got == want
    none = filter_audit.audit_documents(docs.limit(0), marks)
    assert none.count() == 0 and filter_audit.audit_documents(docs, marks.limit(0)).agg(F.sum("good_lost")).head()[0] == 0


def test_audit_of_other_filters(spark):
    rows = spark.createDataFrame([("p", True, None), ("p", True, True), ("p", False, False), (None, None, True)], "g string, x boolean, y boolean")
    got = sorted(map(tuple, filter_audit.audit(rows, "g", ["x", "y"], {}).collect()), key=repr)
    assert got == sorted([("p", "xy", 1, 1, 2, 0, 1, 3), ("p", "xy", 2, 1, 0, 1, 0, 1), ("p", "yx", 1, 2, 1, 0, 0, 1), ("p", "yx", 2, 1, 1, 1, 1, 3), (None, "xy", 1, 1, 0, 0, 0, 0), (None, "xy", 2, 0, 1, 0, 1, 2), (None, "yx", 1, 0, 1, 0, 1, 2), (None, "yx", 2, 0, 0, 0, 0, 0)], key=repr)
    with pytest.raises(ValueError):
        filter_audit.audit(rows, "g", ["x", "x"], {})


# hard negatives
def brute(rows, positives=5, negatives=5):
    once = {}
    for i, v, label in rows:
        if i is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v):
            x = tuple(int(np.floor(256 * float(np.float32(c)))) for c in v)
            once[i] = min(once.get(i, (label, x)), (label, x))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=True))
    out = []
    for a, (label, x) in once.items():
        if a % 10:
            continue
        scores = sorted((-dot(x, y), i, k) for i, (k, y) in once.items() if i != a)
        for s, p, _ in [t for t in scores if t[2] == label][:positives]:
            found = [(n, -t) for t, n, k in scores if k != label and 80 * -s <= 100 * -t <= 100 * -s][:negatives]
            out += [(a, p, rank, n, -s, t) for rank, (n, t) in enumerate(found, 1)]
    return sorted(out)


def test_negatives_by_brute_force(spark):
    r = np.random.default_rng(4)
    centres = r.normal(size=(6, 12))
    rows = [(i, [float(x) for x in (centres[i % 6] + r.normal(size=12) * 0.4).astype(np.float32)], int(r.integers(0, 4))) for i in range(700)]
    rows += [(1000 + i, rows[0][1], i % 2) for i in range(60)]  # ties
    rows += [(2000, [0.0] * 12, 1), (2010, [-3.0] * 12, 2), (2011, None, 1), (2020, [float("nan")] + [1.0] * 11, 1), (2021, [None] + [1.0] * 11, 1), (2030, [1.0] * 12, None), (None, [1.0] * 12, 1), (2031, [float("inf")] * 12, 0), (2040, [1.5] * 12, 77), (10, rows[3][1], 3), (20, rows[20][1], rows[20][2])]
    frame = spark.createDataFrame([(*x, "clash", 9) for x in rows], "vec_id long, embedding array<float>, label int, score string, block int")
    want = brute(rows)
    for cells, block in ((64, 128), (2, 1024), (256, 37)):
        got = hard_negatives.mine(frame, F.col("vec_id") % 10 == 0, F.col("label"), cells=cells, block=block).collect()
        assert sorted(map(tuple, got)) == want
    assert len(want) > 500
    assert hard_negatives.mine(frame.limit(0), F.col("vec_id") % 10 == 0, F.col("label")).count() == 0
    assert hard_negatives.mine(frame, F.lit(False), F.col("label")).count() == 0
    assert hard_negatives.mine(frame.where("vec_id < 30"), F.col("vec_id") == 0, F.lit(1)).count() == 0  # no other label
    with pytest.raises(ValueError):
        hard_negatives.mine(frame, F.lit(True), F.col("label"), cells=1)


def test_bounds_hold_and_spare_exact_scores():
    r = np.random.default_rng(6)
    x, a = (r.normal(size=(2000, 16)) * 200).astype(np.int64), (r.normal(size=(20, 16)) * 200).astype(np.int64)
    starts = np.quantile(x, np.arange(64) / 64, axis=0).astype(np.int64).T
    starts[:, 0] = x.min(axis=0)
    ends = np.maximum(starts, np.concatenate([starts[:, 1:] - 1, x.max(axis=0)[:, None]], axis=1))
    lower, upper = hard_negatives.bounds(a, hard_negatives.to_cells(x, starts), starts, ends)
    exact = a @ x.T
    assert (lower <= exact).all() and (exact <= upper).all()
    assert (upper >= hard_negatives.kth_largest(lower, 5)[:, None]).mean() < 0.05
