"""Registered queries of the operators: columns and types of their contracts, and their SQL."""

import glob
import os

import pytest

from loomvec.llm import queries as Q

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")

CONTRACTS = {
    "op1_pack_documents": "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint",
    "op2_token_files": "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
    "op4_quality_rules": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean",
    "op5_near_duplicates": "doc_id bigint, n_shingles bigint, component_id bigint, kept boolean",
    "op6_warc_salvage": "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint",
    "op7_hilbert_shards": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
    "op8_language_id": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op9_nearest_vectors": "query_id bigint, rank int, vec_id bigint, score double",
    "op11_bpe_codec": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    "op12_filter_audit": "part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, unique_fails bigint, good_lost bigint, toxic_lost bigint, shapley bigint",
    "op13_hard_negatives": "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint",
}


@pytest.mark.parametrize("name", sorted(CONTRACTS))
def test_columns(spark, name):
    frame = Q.queries()[name](spark, DATA)
    want = [x.split() for x in CONTRACTS[name].split(", ")]
    assert [list(x) for x in frame.dtypes][: len(want)] == want
    table = {"op6": "pages", "op9": "embeddings"}.get(name.split("_")[0], "documents")
    if name not in ("op1_pack_documents", "op9_nearest_vectors", "op12_filter_audit", "op13_hard_negatives"):
        assert frame.count() == spark.read.parquet(f"{DATA}/{table}.parquet").count()


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        con.sql(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    frame, want = Q.queries()[name](spark, DATA), con.sql(Q.oracle_sql()[name])
    columns = sorted(frame.columns)
    assert columns == sorted(want.columns)
    assert sorted(repr([r[c] for c in columns]) for r in frame.collect()) == sorted(repr([x for _, x in sorted(zip(want.columns, r, strict=True))]) for r in want.fetchall())
