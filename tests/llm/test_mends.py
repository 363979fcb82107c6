"""Foreign archives, columns with clashing names, other vocabularies."""

import base64
import hashlib
import io

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from loomvec.llm import mixing, quality, tokens, warc


def record(i, block, digest, version=b"WARC/1.1"):
    raw = warc.record_bytes([("WARC-Type", "response"), ("WARC-Record-ID", f"<urn:page:{i}>"), ("WARC-Block-Digest", digest)], block)
    return raw.replace(b"WARC/1.1", version, 1)


def salvaged(raw):
    out = list(warc.salvage(io.BytesIO(raw), len(raw)))
    return [x.headers["warc-record-id"] for x in out if isinstance(x, warc.Record)], [x for x in out if isinstance(x, warc.Gap)]


def spellings(block):
    sha1, sha256, md5 = (getattr(hashlib, n)(block).digest() for n in ("sha1", "sha256", "md5"))
    return [
        "sha1:" + base64.b32encode(sha1).decode(), "sha1:" + base64.b32encode(sha1).decode().lower(), "sha1:" + sha1.hex().upper(), "SHA-1:" + sha1.hex(), "sha256:" + sha256.hex(),
        "sha256:" + base64.b32encode(sha256).decode().rstrip("="), "sha256:" + base64.urlsafe_b64encode(sha256).decode(), "md5:" + base64.b64encode(md5).decode(), "md5:" + md5.hex(),
    ]


@pytest.mark.parametrize("wrap", [bytes, warc.member])
def test_digests_in_any_usual_spelling(wrap):
    block = b"a block of bytes " * 20
    for digest in spellings(block):
        raw = record(1, block, digest)
        assert salvaged(wrap(raw)) == (["<urn:page:1>"], []), digest
        bad = raw.replace(b"block of", b"block 0f", 1)
        got, gaps = salvaged(wrap(bad))
        assert got == [] and len(gaps) == 1 and gaps[0].length == len(wrap(bad)), digest


def test_digests_that_cannot_be_told_are_no_damage():
    for digest in ("blake3:00ff", "sha1:tooshort", "sha1:" + "!" * 32, "", "sha1"):
        assert salvaged(record(1, b"abc", digest) + warc.member(record(2, b"abc", digest))) == (["<urn:page:1>", "<urn:page:2>"], [])
    # in a damaged member only what is verified is given out
    raw = record(1, b"abc" * 5000, "blake3:00") + record(2, b"x", "sha1:" + hashlib.sha1(b"x").hexdigest())
    cut = warc.member(raw)
    assert salvaged(cut[:-6])[0] == ["<urn:page:2>"]


def test_older_version_lines():
    for version in (b"WARC/0.17", b"WARC/0.18", b"WARC/1.0"):
        raw = record(1, b"abc", "sha1:" + hashlib.sha1(b"abc").hexdigest(), version)
        assert salvaged(b"junk" + raw + warc.member(raw))[0] == ["<urn:page:1>"] * 2
    assert salvaged(record(1, b"abc", "", b"WARC/2.0"))[0] == []


def test_columns_of_any_name_stay(spark):
    rows = [(i, "some plain words of a text " * 20, "m", "n", "r", "M") for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _model string, _m_ string, _ratios string, _M string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(12)], "doc_id long, quality int, toxic int")
    for out in (mixing.mix(docs, labels), quality.quality_rules(docs, labels)):
        assert out.columns[:6] == docs.columns and out.where("_model = 'm' and _m_ = 'n' and _ratios = 'r' and _M = 'M'").count() == 12


def test_another_vocabulary_gets_whole_texts():
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    texts = ["Some plain words, don't they?  Twice  spaced.", "UPPER lower 123", "", None]
    plain = Tokenizer.from_file(path)
    own = tokens.BpeEncoder(path)
    assert not own.splits and tokens.BpeEncoder(tokens.default_vocabulary()).splits
    for t, ids in zip(texts, own.encode(texts), strict=True):
        assert ids.tolist() == plain.encode(t or "", add_special_tokens=False).ids


def test_rates_are_made_once_a_row_from_constants(spark):
    steps = [[0.3, -0.2, 0.1], [0.05, 1 / 3, -0.7], [-2.0, 0.0, 1e-9]]
    shares = [[0.7, 0.2, 0.1], [0.0, 1.0, 0.0], [1 / 3, 1 / 3, 1 / 3]]
    want = []
    for p in shares:
        rate = 1.0
        for g in steps:
            slope = mixing.RIDGE * (rate - 1)
            for x, y in zip(p, g, strict=True):
                slope = slope + x * y
            rate = max(0.0, min(4.0, rate - slope))
        want.append(rate)
    rows = spark.createDataFrame([(i, p) for i, p in enumerate(shares)], "i int, p array<double>")
    got = rows.select("i", mixing.rate_after(F.col("p"), steps, mixing.RIDGE, 4.0, F.lit(1.0)).alias("r"))
    assert [r["r"] for r in got.orderBy("i").collect()] == want
    words = {0: "river stone cloud", 1: "curse insult threat", 2: "zz qq xx"}
    docs = spark.createDataFrame([(i, f"{words[i % 3]} {i}") for i in range(90)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0), int(i % 3 == 1)) for i in range(60)], "doc_id long, quality int, toxic int")
    out = mixing.mix(docs, labels, keep=["doc_id"])
    assert len({round(r["mix"]["rate"], 3) for r in out.collect()}) > 1  # steps were made
    plan = out.select("doc_id", "mix.rate", "mix.copies")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("aggregate(") == 1 and "split(" not in plan
