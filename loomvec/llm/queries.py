"""Registered queries of the operators, with production parameters, and their SQL."""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bpe, filter_audit, hard_negatives, langid, licenses, minhash, mixing, packing, quality, sharding, token_files, tokens, warc
from . import pipeline as stages
from .common import scratch, written
from .pipeline import SEQUENCE

SHARDS = 24


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pack_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best-fit packing with a bounded number of open windows."""
    return packing.pack(table(spark, sf_dir, "documents"), tokens.default_vocabulary(), SEQUENCE, end_id=0)


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrow stream files of fixed-size-list batches, written and read back."""
    files = token_files.write_token_files(table(spark, sf_dir, "documents"), scratch(spark, "tokens"), tokens.default_vocabulary(), SEQUENCE, end_id=2)
    return token_files.read_documents(spark, files)


def op3_mix_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posteriors, rates and copies of all documents for the default target weights."""
    out = mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), keep=["doc_id"])
    m = F.col("mix")
    shares = [F.round(m["posteriors"][i], 6).alias(f"p_{d}") for i, d in enumerate(mixing.DOMAINS)]
    return out.select("doc_id", m["tokens"].alias("n_tokens"), *shares, F.round(m["rate"], 6).alias("rate"), m["copies"].alias("copies"))


def op3_mix_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens that op3's rates and copies reach in each domain, against its targets."""
    return mixing.totals(mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), keep=["doc_id"]))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts of all documents and the verdict of the likelihood ratio."""
    out = quality.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return out.select("doc_id", *(F.col(f"verdict.{n}").alias(n) for n in names), F.round("verdict.score", 6).alias("score"))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents by min-max hashing."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC records, and read back by the salvage reader, which must find no gap."""
    pages = table(spark, sf_dir, "pages")
    archives = warc.write_archives(warc.mark_revisits(pages, uri="url" if "url" in pages.columns else None), scratch(spark, "warc"))
    found = written(warc.read_archives(spark, archives), "records")
    if gap := found.where("kind = 'gap'").head():
        raise RuntimeError(f"a gap of {gap['length']} bytes in {gap['path']}: {gap['reason']}")
    records = found.where("kind = 'record'")
    return records.select(warc.page_of(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type", warc.page_of(F.col("refers_to")).alias("refers_to"))


def op7_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of a Hilbert ordering by language, source and size, as many rows in each."""
    text = F.col("text")
    rows = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        sharding.hash_cell(F.col("lang")).alias("d0"), sharding.hash_cell(F.col("source")).alias("d1"), sharding.size_cell(F.octet_length(text)).alias("d2"),
    )
    out = sharding.shard(rows, [F.col("d0"), F.col("d1"), F.col("d2")], ["text_crc32", "doc_id"], SHARDS)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "curve")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents by naive Bayes over character n-grams."""
    docs = table(spark, sf_dir, "documents")
    out = langid.predict(docs.select("doc_id", "text"), langid.fit(docs, ~langid.held_out()))
    return out.select("doc_id", langid.held_out().alias("held_out"), F.col("language.lang_pred").alias("lang_pred"), F.round("language.score", 6).alias("score"))


def op9_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows of every twentieth vector."""
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences that all documents name, by sentence rules."""
    out = licenses.scan(table(spark, sf_dir, "documents"))
    x = F.col("licence")
    return out.select("doc_id", x["sentences"].alias("n_sentences"), F.array_join(x["rules"], ",").alias("rules"), F.array_join(x["licences"], ",").alias("licences"), x["name"].alias("licence"), x["family"].alias("family"))


def op11_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all texts by rank, and the bytes that they decode to."""
    path, pattern = bpe.default_ranks(), bpe.default_pattern()
    ids = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), bpe.encoded(F.col("text"), path, pattern).alias("ids"))
    back = ids.withColumn("decoded", bpe.decoded(F.col("ids"), path, pattern))
    return back.select("doc_id", F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five filters over all documents in all 120 orders, by language."""
    return filter_audit.audit_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five negatives for each of the five positives of every hundredth vector."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the corpus pipeline."""
    return stages.run(spark, sf_dir)


def queries() -> dict:
    made = [op1_pack_documents, op2_token_files, op3_mix_domains, op3_mix_totals, op4_quality_rules, op5_near_duplicates, op6_warc_salvage, op7_hilbert_shards, op8_language_id, op9_nearest_vectors, op10_license_scan, op11_bpe_codec, op12_filter_audit, op13_hard_negatives, pipeline]
    return {f.__name__: f for f in made}


#: 64-bit words in DuckDB: the same classes by exact sets of shingles and a recursive closure.
OP5_SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(generate_series(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s FROM words),
classes AS (SELECT list_sort(s) AS k, min(doc_id) AS node, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY ALL),
grams AS (SELECT node, n, unnest(k) AS g FROM classes),
pairs AS (
  SELECT a.node AS a, b.node AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS c
  FROM grams a JOIN grams b ON a.g = b.g AND a.node < b.node AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n) GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs WHERE 100 * c >= 85 * (na + nb - c)),
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(node, spot) AS (SELECT node, node FROM classes UNION SELECT r.node, l.b FROM reach r JOIN both_ways l ON r.spot = l.a),
comp AS (SELECT node, min(spot) AS c FROM reach GROUP BY node),
named AS (SELECT s.doc_id, len(s.s) AS n, coalesce(p.c, s.doc_id) AS c
  FROM sets s LEFT JOIN classes k ON list_sort(s.s) = k.k LEFT JOIN comp p ON k.node = p.node)
SELECT doc_id, n::BIGINT AS n_shingles, c AS component_id, doc_id = c AS kept FROM named
"""

OP6_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html)) AS n, sha1(html) AS digest FROM p),
r AS (SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY digest) ELSE page_id END AS holder FROM d)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
  CASE WHEN holder = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN holder <> page_id THEN holder END AS refers_to
FROM r
"""


#: Inner products in double precision, added in the order of the components, as the operator's.
OP9_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_reduce(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2]), lambda a, x: a + x) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, n::INTEGER AS rank, vec_id, score FROM r WHERE n <= 20
"""


def op10_sql() -> str:
    def quoted(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    def table_of(pattern: str) -> str:
        known = licenses.known_sentences(pattern)
        return f"MAP {{{', '.join(f'{quoted(k)}: {quoted(v)}' for k, v in known.items())}}}"

    def run(pattern: str) -> str:
        parts = f"list_transform(regexp_split_to_array(low, {quoted(pattern)}), lambda s: trim(regexp_replace(s, '[^a-z0-9]+', ' ', 'g')))"
        return f"list_filter(list_transform({parts}, lambda s: {table_of(pattern)}[s]), lambda x: x IS NOT NULL)"

    rules = ", ".join(f"{{'rule': {quoted(r.name)}, 'licence': {quoted(r.licence)}, 'family': {quoted(r.family)}, 'run': {quoted('/' + '/'.join(r.sentences) + '/')}}}" for r in licenses.RULES)
    return f"""
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), '{licenses.UPPER}', '{licenses.LOWER}') AS low FROM documents),
s AS (SELECT doc_id, {run(licenses.WITHIN)} AS a, {run(licenses.ACROSS)} AS b FROM t),
m AS (SELECT doc_id, greatest(len(a), len(b)) AS n, list_filter([{rules}], lambda r: contains('/' || array_to_string(a, '/') || '/', r.run) OR contains('/' || array_to_string(b, '/') || '/', r.run)) AS m FROM s)
SELECT doc_id, n::BIGINT AS n_sentences, coalesce(array_to_string(list_transform(m, lambda r: r.rule), ','), '') AS rules,
  coalesce(array_to_string(list_transform(list_filter(m, lambda r, i: list_position(list_transform(m, lambda q: q.licence), r.licence) = i), lambda r: r.licence), ','), '') AS licences,
  m[1].licence AS licence, m[1].family AS family
FROM m
"""


def op12_sql() -> str:
    orders = ", ".join(f"('{''.join(o)}')" for o in permutations("ABCDE"))
    return f"""
WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w, min(doc_id) OVER (PARTITION BY t) AS first FROM t),
f AS (SELECT doc_id, part, CASE WHEN len(w) < 200 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END
  + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 4 ELSE 0 END + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END + CASE WHEN doc_id > first THEN 16 ELSE 0 END AS mask FROM w),
m AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY 1),
c AS (SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS g, count(*) FILTER (toxic) AS x FROM f LEFT JOIN m USING (doc_id) GROUP BY 1, 2),
o AS (SELECT filter_order, unnest(range(1, 6)) AS step FROM (VALUES {orders}) v(filter_order)),
b AS (SELECT *, 1 << (instr('ABCDE', substr(filter_order, step, 1)) - 1) AS own, list_sum(list_transform(range(1, step), lambda i: 1 << (instr('ABCDE', substr(filter_order, i, 1)) - 1))) AS p FROM o),
s AS (SELECT part, filter_order, step::INTEGER AS step, own, coalesce(p, 0)::INTEGER AS p FROM b, (SELECT DISTINCT part FROM c)),
r AS (SELECT s.part, filter_order, step, s.own, coalesce(sum(n) FILTER ((mask & (p | s.own)) = 0), 0)::BIGINT AS kept, coalesce(sum(n) FILTER ((mask & s.own) <> 0 AND (mask & p) = 0), 0)::BIGINT AS removed,
  coalesce(sum(n) FILTER ((mask & s.own) <> 0 AND (mask & p) <> 0), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (mask = s.own), 0)::BIGINT AS unique_fails,
  coalesce(sum(g) FILTER ((mask & s.own) <> 0 AND (mask & p) = 0), 0)::BIGINT AS good_lost, coalesce(sum(x) FILTER ((mask & s.own) <> 0 AND (mask & p) = 0), 0)::BIGINT AS toxic_lost
  FROM s JOIN c ON s.part = c.part GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley FROM r
"""


#: Every anchor against every row.
OP13_SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS vec_id, a.label = b.label AS same, list_sum(list_transform(list_zip(a.x, b.x), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS n FROM s WHERE same) WHERE n <= 5),
w AS (SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
  row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS n
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score)
SELECT anchor_id, positive_id, n::INTEGER AS rank, negative_id, positive_score, negative_score FROM w WHERE n <= 5
"""


def oracle_sql() -> dict[str, str]:
    return {"op5_near_duplicates": OP5_SQL, "op6_warc_salvage": OP6_SQL, "op9_nearest_vectors": OP9_SQL, "op10_license_scan": op10_sql(), "op12_filter_audit": op12_sql(), "op13_hard_negatives": OP13_SQL}
