import hashlib
import io
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType
from tokenizers import Tokenizer

from loomvec.llm import ann, curve, langid, licenses, minhash, mixing, packing, quality, sharding, token_files, tokens, warc

DOCS = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()), StructField("verdict", StringType())])
WORDS = [f"w{i}" for i in range(400)]


def prose(seed, n):
    r = np.random.default_rng(seed)
    return " ".join(WORDS[i] for i in r.integers(0, 400, n))


@pytest.fixture(scope="module")
def docs(spark):
    base = prose(1, 120)
    rows = [(i, prose(i, 30 + i), "en" if i % 2 else "fr", "x") for i in range(40)]
    rows += [(100, base, "en", "x"), (101, base, "en", "x"), (102, base.replace(base.split()[60], "new", 1), "en", None), (103, None, None, None), (104, "", "en", "x"), (105, " \n\t", "en", "x"), (106, "one two", None, "x"), (None, base, "en", "x"), (107, prose(9, 6000), "en", "x"), (107, prose(9, 6000), "en", "x")]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_tokens_equal_the_tokenizer():
    e = tokens.encoder(tokens.default_vocabulary())
    texts = ["", None, "a\n\n b  c <|endoftext|> don't I'll\r\n x's 12a3 \x1c q", "日本 語　x", "é ²¼ “x”", prose(3, 500)]
    texts += ["<|endoftext|>", "a<|endoftext|><|endoftext|>b", "x <|endoftext", prose(4, 50) + "<|endoftext|>"]
    plain = Tokenizer.from_file(tokens.default_vocabulary())
    for t, ids in zip(texts, e.encode(texts), strict=True):
        assert ids.tolist() == plain.encode(t or "", add_special_tokens=False).ids


def test_packing_round_trip(docs, empty):
    rows = packing.pack(docs, tokens.default_vocabulary(), 256, with_ids=True).collect()
    e = tokens.encoder(tokens.default_vocabulary())
    want = Counter((r["doc_id"], tuple(ids.tolist()) + (0,)) for r, ids in ((r, next(e.encode([r["text"]]))) for r in docs.collect()))
    assert sum(r["length"] for r in rows) == sum(len(k[1]) * n for k, n in want.items())
    by_sequence = {}
    for r in rows:
        assert r["ids_crc32"] == crc32(np.array(r["ids"], "<u4").tobytes()) and len(r["ids"]) == r["length"]
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for x in by_sequence.values():
        x.sort()
        assert x[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(x, x[1:], strict=False)) and sum(n for _, n in x) <= 256
    single = {k[0] for k, n in want.items() if n == 1}
    for doc in single:
        pieces = sorted((r["start"], tuple(r["ids"])) for r in rows if r["doc_id"] == doc)
        assert (doc, tuple(i for _, p in pieces for i in p)) in want
    assert packing.pack(empty, tokens.default_vocabulary()).count() == 0


def test_token_files_round_trip(spark, docs, empty, tmp_path):
    files = token_files.write_token_files(docs, f"file://{tmp_path}/t", tokens.default_vocabulary(), 64, parts=3)
    rows = token_files.read_documents(spark, files, with_ids=True).orderBy("start").collect()
    e = tokens.encoder(tokens.default_vocabulary())
    want = sorted(((r["doc_id"], next(e.encode([r["text"]])).tolist() + [2]) for r in docs.collect()), key=lambda x: (x[0] is not None, x[0] or 0))
    assert [(r["doc_id"], r["ids"]) for r in rows] == want
    assert [r["start"] for r in rows] == np.cumsum([0] + [len(x) for _, x in want])[:-1].tolist()
    reader = token_files.PartReader(files.parts[0].path)
    assert not reader.sequence(0).flags.owndata and len(reader.sequence(0)) == 64
    masks = [reader.mask(i) for i in range(len(reader))]
    assert masks[0].buffers()[1].address == reader.batches[0].column("mask").values.buffers()[1].address  # views of the file
    assert all(len(m) == 64 for m in masks) and all(m.true_count == 64 for m in masks[:-1])
    assert sum(m.true_count for m in masks) == files.parts[0].ids and masks[-1].to_pylist() == [i < masks[-1].true_count for i in range(64)]
    assert not token_files.write_token_files(empty, f"file://{tmp_path}/e", tokens.default_vocabulary()).parts


def test_quality_counts_by_brute_force(spark, docs):
    texts = docs.union(spark.createDataFrame([(200, "a b c a b c\nx # $\nx # $\n \n", "en", ""), (201, "a a a a a", "en", "")], DOCS))
    out = quality.judge(texts, spark.createDataFrame([([0.0] * 16,)], "ratios array<float>"), bits=4)
    for r in out.collect():
        t = r["text"] or ""
        w = re.findall("[^\x20\x09-\x0d]+", t)
        tri = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        many = {x for x, n in Counter(tri).items() if n > 1}
        covered = {i + d for i, x in enumerate(tri) if x in many for d in range(3)}
        lines = [x for x in t.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
        v = r["verdict"]
        assert (v["n_words"], v["word_chars"], v["n_symbols"], v["n_dup_lines"], v["n_repeat_words"]) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered))


def test_quality_ratio_rejects_noise(spark):
    few = lambda seed: " ".join("abcdefghijklmnopqrst"[i] for i in np.random.default_rng(seed).integers(0, 20, 80))
    rows = [(i, few(i), "en", "") for i in range(60)] + [(100 + i, few(i).replace(" ", "%%% "), "en", "") for i in range(10)]
    frame = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(60)] + [(100, 0, 0)], "doc_id long, quality int, toxic int")
    kept = {r["doc_id"] for r in quality.quality_rules(frame, labels).where("verdict.kept").collect()}
    assert kept == set(range(60))


def exact_components(rows):
    sets = {}
    for r in rows:
        w = (r["text"] or "").encode().lower().split()
        sets[r["doc_id"]] = {tuple(w[i : i + 3]) for i in range(max(1, len(w) - 2))} if w else set()
    ids = sorted(k for k in sets if k is not None)
    comp = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a in ids:
            for b in ids:
                if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]) and comp[a] != comp[b]:
                    comp[a] = comp[b] = min(comp[a], comp[b])
                    changed = True
    return {i: (len(sets[i]), comp[i], comp[i] == i) for i in ids}


def test_near_duplicates_by_brute_force(spark, docs, empty):
    base, more = prose(50, 100).split(), []
    for i in range(60):
        w, r = list(base), np.random.default_rng(i)
        for p in r.integers(0, 100, i % 7):
            w[p] = f"e{r.integers(0, 5)}"
        more.append((1000 + i, " ".join(w), "en", ""))
    frame = docs.union(spark.createDataFrame(more, DOCS))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(frame).collect()}
    assert got.pop(None) == (118, None, True)
    assert got == exact_components(frame.collect())
    assert minhash.near_duplicates(empty).count() == 0


def test_warc_salvage():
    parts = [warc.member(warc.record_bytes([("WARC-Type", "response"), ("WARC-Record-ID", f"<urn:page:{i}>")], prose(i, 300).encode())) for i in range(5)]
    whole = b"".join(parts)
    assert [x.length for x in warc.salvage(io.BytesIO(whole), len(whole))] == list(map(len, parts))
    hurt = bytearray(whole)
    at = len(parts[0]) + len(parts[1]) // 2
    hurt[at : at + 20] = b"\x00" * 20
    hurt = bytes(hurt[:-10])
    got = list(warc.salvage(io.BytesIO(hurt), len(hurt)))
    ids = [x.headers["warc-record-id"] for x in got if isinstance(x, warc.Record)]
    assert ids == [f"<urn:page:{i}>" for i in (0, 2, 3)]
    gaps = [x for x in got if isinstance(x, warc.Gap)]
    assert (gaps[0].offset, gaps[0].length) == (len(parts[0]), len(parts[1])) and gaps[1].length == len(parts[4]) - 10
    plain = warc.record_bytes([("WARC-Type", "response")], b"abc")
    assert [type(x) for x in warc.salvage(io.BytesIO(b"junk" + plain + parts[0]), 4 + len(plain) + len(parts[0]))] == [warc.Gap, warc.Record, warc.Record]


def named(i, block, *more):
    return warc.record_bytes([("WARC-Type", "response"), ("WARC-Record-ID", f"<urn:page:{i}>"), ("WARC-Block-Digest", "sha1:" + hashlib.sha1(block).hexdigest()), *more], block)


def found(raw):
    """Ids of records, and the gaps."""
    out = list(warc.salvage(io.BytesIO(raw), len(raw)))
    return [int(x.headers["warc-record-id"][10:-1]) for x in out if isinstance(x, warc.Record)], [(x.offset, x.length) for x in out if isinstance(x, warc.Gap)]


def test_warc_members_of_many_records():
    big = [named(i, prose(i, 40_000).encode()) for i in range(20)]  # above one chunk when inflated
    whole = warc.member(b"".join(big))
    assert found(whole + warc.member(named(99, b"x"))) == ([*range(20), 99], [])
    assert found(warc.member(named(1, b"a") + named(2, b"b"))) == ([1, 2], [])
    inner = warc.member(named(1, b"a") + b"junk" + named(2, b"b"))
    assert found(inner) == ([1, 2], [(0, len(inner))])
    cut = found(whole[: len(whole) // 2] + warc.member(named(99, b"x")))
    assert cut[0][-1] == 99 and cut[0][:-1] == list(range(len(cut[0]) - 1)) and len(cut[0]) > 5 and cut[1] == [(0, len(whole) // 2)]


def test_warc_headers_long_and_folded():
    long = named(1, b"abc", ("X-Long", "y" * 70_000))
    assert found(long) == ([1], []) and found(warc.member(long)) == ([1], [])
    raw = named(2, b"abc").replace(b"WARC-Type: response", b"WARC-Type: response\r\nX-Folded: one\r\n\t two")
    got = list(warc.salvage(io.BytesIO(raw), len(raw)))
    assert len(got) == 1 and got[0].headers["x-folded"] == "one two"


def test_warc_payload_of_a_damaged_record_is_no_record():
    inside = warc.record_bytes([("WARC-Type", "response"), ("WARC-Record-ID", "<urn:page:7>")], b"fake")
    hurt = bytearray(named(1, b"..." + inside + b"..."))
    hurt[hurt.index(b"...")] = 33
    assert found(bytes(hurt) + named(2, b"ok")) == ([2], [(0, len(hurt))])
    assert found(b"") == ([], []) and found(b"junk") == ([], [(0, 4)]) and found(warc.member(b"no record")) == ([], [(0, len(warc.member(b"no record")))])


def test_warc_tables(spark, tmp_path, empty):
    none = spark.createDataFrame([], "page_id long, html string, url string")
    archives = warc.write_archives(warc.mark_revisits(none), f"file://{tmp_path}/e")
    assert archives.count() == 0 and warc.read_archives(spark, archives).count() == 0
    long = prose(1, 700_000)
    pages = spark.createDataFrame([(1, long, "http://a/b c", "x"), (2, "s", None, "x"), (2, "s", None, "x")], "page_id long, html string, url string, digest string")
    rows = warc.read_archives(spark, warc.write_archives(warc.mark_revisits(pages, uri="url"), f"file://{tmp_path}/l"), with_block=True).collect()
    assert sorted((r["target"], bytes(r["block"]).decode()) for r in rows) == [("http://a/b c", long), ("urn:page:2", "s"), ("urn:page:2", "s")]


def test_many_copies_and_one_stray(spark):
    n = 100_000
    members = spark.range(n + 1).select(F.lit(5).cast("long").alias("bucket"), "id", F.lit(10).cast("long").alias("n_shingles"), F.lit(b"m").alias("mark"), F.lit(None).cast("binary").alias("small"), F.when(F.col("id") == n, n).otherwise(0).cast("long").alias("component"))
    rows = minhash.dealt_blocks(members)
    assert rows.count() == n + -(-n // minhash.BLOCK) + 1  # the stray also meets itself
    assert rows.groupBy("i", "j").count().agg(F.max("count")).head()[0] < 2 * minhash.BLOCK
    small = members.where("id < 3000").union(members.where(f"id = {n}")).withColumn("component", F.when(F.col("id") % 1000 < 2, F.col("id")).otherwise(F.col("component")))
    got = small.select("id", "component").collect()
    want = sum(a["component"] != b["component"] for i, a in enumerate(got) for b in got[:i])
    assert minhash.block_pairs(small, 8, 1).count() == want


def test_warc_round_trip(spark, tmp_path):
    big = "x" * 1200
    pages = spark.createDataFrame([(1, big), (5, big), (3, big), (7, "s"), (8, "s"), (9, None), (None, big)], "page_id long, html string")
    archives = warc.write_archives(warc.mark_revisits(pages), f"file://{tmp_path}/w", archive_bytes=400)
    rows = warc.read_archives(spark, archives).select(warc.page_of(F.col("record_id")).alias("p"), "record_type", warc.page_of(F.col("refers_to")).alias("r"), "payload_bytes").collect()
    got = {r["p"]: (r["record_type"], r["r"], r["payload_bytes"]) for r in rows}
    assert got == {1: ("revisit", 5, 1200), 3: ("revisit", 5, 1200), 5: ("response", None, 1200), 7: ("response", None, 1), 8: ("response", None, 1), 9: ("response", None, 0), None: ("revisit", 5, 1200)}


def test_hilbert_curve_is_a_walk():
    for dims, bits in ((2, 4), (3, 3)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), axis=-1).reshape(-1, dims)
        index = curve.hilbert_index(grid, bits)
        assert sorted(index) == list(range(len(grid)))
        assert (np.abs(np.diff(grid[np.argsort(index)], axis=0)).sum(axis=1) == 1).all()


def test_shards(docs, empty):
    rows = docs.select("doc_id", sharding.hash_cell(F.col("lang")).alias("a"), sharding.size_cell(F.length("text")).alias("b"))
    got = sharding.shard(rows, [F.col("a"), F.col("b")], ["doc_id"], 7).collect()
    counts = Counter(r["shard"] for r in got)
    cells = [(r["a"], r["b"]) for r in rows.collect()]
    index = dict(zip(cells, curve.hilbert_index(np.array(cells), 8).tolist(), strict=True))
    order = sorted(((index[r["a"], r["b"]], r["doc_id"]) for r in rows.collect()), key=lambda x: (x[0], x[1] is not None, x[1] or 0))
    brute = [(c, d, i * 7 // len(order)) for i, (c, d) in enumerate(order)]
    assert sorted(brute, key=repr) == sorted(((r["curve"], r["doc_id"], r["shard"]) for r in got), key=repr)
    clash = rows.withColumns({"position": F.lit("p"), "slot": F.lit("s"), "shard": F.lit("t"), "curve": F.lit("c"), "other": F.lit("o")})
    again = sharding.shard(clash, [F.col("a"), F.col("b")], ["doc_id"], 7)
    assert again.select("doc_id", "shard", "slot").exceptAll(sharding.shard(rows, [F.col("a"), F.col("b")], ["doc_id"], 7).select("doc_id", "shard", "slot")).count() == 0 and "other" in again.columns
    assert len(got) == 50 and max(counts.values()) - min(counts.values()) <= 1
    for s, n in counts.items():
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(n))
    assert sharding.shard(empty.select("doc_id", F.lit(1).alias("a")), [F.col("a")], ["doc_id"], 7).count() == 0


def test_language(spark, docs, empty):
    rows = [(i, " ".join(["the house of tree"] * 3) if i % 2 else " ".join(["le maison du arbre"] * 3), "en" if i % 2 else "fr", "") for i in range(20)]
    model = langid.fit(spark.createDataFrame(rows, DOCS), F.lit(True))
    texts = ["the tree", "la maison", None, "", "12 #", "the tree " * 100_000]
    assert langid.score(texts, model)[0] == ["en", "fr", "und", "und", "und", "en"]
    alone = langid.score(["the tree"], model)[1][0]
    assert alone == pytest.approx(langid.score(texts, model)[1][0])
    assert langid.fit(empty, F.lit(True)).languages == []


def brute_language(rows, text, longest=3):
    """Multinomial naive Bayes over n-grams, hashed as the operator hashes, in plain Python."""
    counts, priors = {}, Counter()
    grams = lambda t: [b for g in langid.gram_buckets(langid.code_points([langid.framed(t)])[0]) for b in g.tolist()]
    for t, lang in rows:
        counts.setdefault(lang, Counter()).update(grams(t))
        priors[lang] += 1
    size = 1 << langid.BUCKET_BITS
    total = {x: sum(c.values()) + size * langid.SMOOTHING for x, c in counts.items()}
    logs = {x: np.log(priors[x] / len(rows)) + sum(np.log((counts[x][b] + langid.SMOOTHING) / total[x]) for b in grams(text)) for x in counts}
    return max(sorted(logs), key=logs.get), logs


def test_language_by_brute_force(spark):
    rng = np.random.default_rng(8)
    made = lambda letters, n: "".join(rng.choice(list(letters + "  "), n))
    rows = [(made("abcde", 60), "x") for _ in range(30)] + [(made("cdefg", 60), "y") for _ in range(3)] + [(made("fghij", 60), "z") for _ in range(9)]
    model = langid.fit(spark.createDataFrame([(i, t, lang, "") for i, (t, lang) in enumerate(rows)], DOCS), F.lit(True))
    texts = [made(letters, n) + "a" for letters in ("abcde", "bcdef", "cdefg", "fghij") for n in (3, 20, 400)]
    assert langid.score(texts, model)[0] == [brute_language(rows, t)[0] for t in texts]


def test_a_rare_language_keeps_its_long_texts(spark):
    rows = [("aba bab " * 5, "a")] * 4999 + [("bcb cbc " * 5, "b")]
    model = langid.fit(spark.createDataFrame([(i, t, lang, "") for i, (t, lang) in enumerate(rows)], DOCS), F.lit(True))
    names, scores = langid.score(["bcb cbc abc " * 400], model)
    assert names == ["b"] and scores[0] >= 0.5


def test_three_hundred_languages(spark):
    word = lambda i: chr(0x4E00 + 2 * i) + chr(0x4E01 + 2 * i)
    rows = [(i, f"{word(i)} " * 6, f"l{i:03d}", "") for i in range(300)]
    model = langid.fit(spark.createDataFrame(rows, DOCS), F.lit(True))
    assert len(model.languages) == 300 and langid.score([r[1] for r in rows], model)[0] == [r[2] for r in rows]


def test_long_texts_are_scored_in_pieces(spark, monkeypatch):
    model = langid.fit(spark.createDataFrame([(0, "the house of tree", "en", ""), (1, "le maison du arbre", "fr", "")], DOCS), F.lit(True))
    texts = [prose(5, 900), "le arbre du " * 300, "x", "the"]
    want = langid.score(texts, model)
    monkeypatch.setattr(langid.batches, "__defaults__", (100,))
    got = langid.score(texts, model)
    assert got[0] == want[0] and np.allclose(got[1], want[1])


def test_nearest_cases(spark):
    schema = "vec_id long, embedding array<float>, rank int, position string"
    rows = [(i, [float(i + 1), 1.0], 7, "p") for i in range(6)] + [(2, [9.0, 0.0], 7, "p"), (None, [5.0, 5.0], 7, "p"), (20, [1.0], 7, "p"), (21, [1.0, 2.0, 3.0], 7, "p"), (40, [], 7, "p"), (41, [float("inf"), 1.0], 7, "p"), (60, [0.0, -1.0], 7, "p")]
    got = ann.nearest(spark.createDataFrame(rows, schema), F.col("vec_id") % 20 == 0, 3).orderBy("query_id", "rank").collect()
    assert [tuple(r) for r in got] == [(0, 1, 2, 9.0), (0, 2, 5, 7.0), (0, 3, 4, 6.0), (60, 1, 2, 0.0), (60, 2, 0, -1.0), (60, 3, 1, -1.0)]
    assert ann.nearest(spark.createDataFrame([], schema), F.lit(True), 3).count() == 0


def test_windows_alone_find_neighbours_in_clusters(spark):
    r = np.random.default_rng(4)
    centres = r.standard_normal((80, 16)) * 3
    x = centres[r.integers(0, 80, 3000)] + 0.3 * r.standard_normal((3000, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    alone = {(g["query_id"], g["vec_id"]) for g in ann.nearest(frame, F.col("vec_id") % 20 == 0, 10, exact=False).collect()}
    d = x @ x.T
    np.fill_diagonal(d, -np.inf)
    want = {(q, int(i)) for q in range(0, 3000, 20) for i in np.argsort(-d[q])[:10]}
    assert len(alone & want) >= 0.9 * len(want)


def test_nearest_is_exact(spark):
    r = np.random.default_rng(0)
    x = r.standard_normal((700, 16)).astype(np.float32)
    x[600:650] = x[0]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(900, None), (901, [0.0] * 16), (902, [float("nan")] * 16)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {}
    for g in ann.nearest(frame, F.col("vec_id") % 20 == 0, 5).orderBy("query_id", "rank").collect():
        got.setdefault(g["query_id"], []).append(g["vec_id"])
    d = x.astype(float)
    for q in range(0, 700, 20):
        s = d @ d[q]
        s[q] = -np.inf
        assert got[q] == np.lexsort((np.arange(700), -np.round(s, 9)))[:5].tolist()
    assert len(got) == 35
    assert ann.nearest(frame.where("vec_id < 3"), F.lit(True), 5).count() == 6


def test_mixing_meets_targets(spark):
    rows = [(i, prose(i, 50) if i % 3 else " ".join(f"z{j % 40}" for j in range(i, i + 50)), "en", "") for i in range(300)] + [(400, None, None, None)]
    frame = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(100)] + [(299, 1, 1)], "doc_id long, quality int, toxic int")
    out = mixing.mix(frame, labels, {"prose": 0.8, "toxic": 0.0, "noise": 0.2})
    got = out.select(F.sum(F.expr("mix.rate * mix.tokens * mix.posteriors[2]")).alias("noise"), F.sum("mix.tokens").alias("n")).head()
    assert abs(got["noise"] / got["n"] - 0.2) < 0.02 and out.count() == 301


def test_mixing_without_documents_of_a_domain(spark):
    frame = spark.createDataFrame([(i, prose(i, 50), "en", "") for i in range(40)], DOCS)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id long, quality int, toxic int")
    out = mixing.mix(frame, labels, {"prose": 0.9, "toxic": 0.1, "noise": 0.0}, most=1.0)
    assert {r["mix"]["copies"] for r in out.collect()} == {1}


def test_licences(spark):
    mit = "Copyright 2020 X\n\n" + "\n".join(s.replace(", ", ",\n") + "." for n, s in licenses.SENTENCES if n in ("mit-grant", "mit-notice", "mit-warranty"))
    texts = ["prose\nReleased under the MIT License.", "Licensed under CC BY-NC 4.0.", mit, "the MIT License is mentioned here", None, "", "Subject.\nThis Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."]
    frame = spark.createDataFrame([(i, t, None, None) for i, t in enumerate(texts)], DOCS)
    got = {r["doc_id"]: (r["licence"]["name"], r["licence"]["rules"][:1]) for r in licenses.scan(frame).collect()}
    assert [got[i][0] for i in range(7)] == ["MIT", "CC-BY-NC-4.0", "MIT", None, None, None, "MPL-2.0"]
    assert got[2][1] == ["mit-full"]
    assert all(any(t in licenses.normalised(s) for t in licenses.TRIGGERS) for _, s in licenses.SENTENCES)
