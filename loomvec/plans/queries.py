"""Registered queries over the test tables, each with its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import sequences as S
from ..functions import vectors as V
from ..operators import encode, groups, order, pairs, quantiles, rows, store
from ..operators.scratch import saved
from ..sources import relation

DIM = 64
SIZE, OVERLAP = 512, 128

_registry: dict[str, tuple[Callable, str | None]] = {}


def query(sql: str | None):
    def add(f: Callable) -> Callable:
        _registry[f.__name__] = (f, sql)
        return f

    return add


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _sequences(spark: SparkSession, sf: str) -> DataFrame:
    """doc_id, lang and the ASCII letters of each text as a raw sequence."""
    return _t(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars", F.regexp_replace("text", "[^A-Za-z]+", "").alias("raw"))


SEQ = "SELECT doc_id, lang, source, n_chars, regexp_replace(text, '[^A-Za-z]+', '', 'g') AS raw FROM documents"
UP = "SELECT doc_id, upper(regexp_replace(replace(text, 'ß', 'ss'), '[\\s\\x{00a0}]+', '', 'g')) AS u FROM documents"


# identifiers and cleaning
_SPELL = "CASE c_custkey % 6 WHEN 0 THEN cast(c_custkey AS VARCHAR) WHEN 1 THEN 'NSC-' || c_custkey WHEN 2 THEN ' nsc ' || c_custkey || ' ' WHEN 3 THEN 'nsc-00' || c_custkey WHEN 4 THEN 'NSC_' || c_custkey ELSE c_name END"


@query(f"""WITH s AS (SELECT c_custkey, trim({_SPELL}) AS t FROM customer)
SELECT c_custkey, CASE WHEN regexp_matches(t, '^(?i:NSC[\\s_-]*)?[0-9]+$') THEN 'NSC-' || regexp_replace(regexp_extract(t, '([0-9]+)$', 1), '^0+([0-9])', '\\1') END AS canonical FROM s""")
def canonical_id(spark, sf):
    return _t(spark, sf, "customer").select("c_custkey", S.canonical_id(F.expr(_SPELL.replace("VARCHAR", "STRING"))).alias("canonical"))


@query(f"SELECT doc_id, sha256(u) AS sequence_hash FROM ({UP})")
def clean_sequence_hash(spark, sf):
    return _t(spark, sf, "documents").select("doc_id", S.sequence_hash(S.compact_upper(F.col("text"))).alias("sequence_hash"))


@query(f"SELECT doc_id, (instr_at - 1)::INTEGER AS position, CASE WHEN instr_at > 0 THEN substr(u, instr_at, 1) ELSE '' END AS symbol FROM (SELECT doc_id, u, CASE WHEN regexp_matches(u, '[^ACDEFGHIKLMNPQRSTVWYXBZJUO]') THEN length(regexp_extract(u, '^[ACDEFGHIKLMNPQRSTVWYXBZJUO]*')) + 1 ELSE 0 END AS instr_at FROM ({UP}))")
def first_invalid_char(spark, sf):
    u = S.compact_upper(F.col("text"))
    bad = S.first_bad_position(u, S.STANDARD + S.SPECIAL)
    return _t(spark, sf, "documents").select("doc_id", bad.alias("position"), F.when(bad >= 0, F.substring(u, bad + 1, F.lit(1))).otherwise("").alias("symbol"))


def _policy(policy: str, supported: str):
    def run(spark, sf):
        c = S.clean(F.col("raw"), policy, supported)
        return _sequences(spark, sf).select("doc_id", c.alias("c")).select("doc_id", F.sha2("c.cleaned", 256).alias("sequence_hash"), "c.error_kind", "c.error_position", "c.error_symbol")

    return run


def _policy_sql(allowed: str, fix: str) -> str:
    return f"""WITH u AS (SELECT doc_id, upper(raw) AS u FROM ({SEQ})),
b AS (SELECT doc_id, u, CASE WHEN regexp_matches(u, '[^{allowed}]') THEN length(regexp_extract(u, '^[{allowed}]*')) END AS p FROM u)
SELECT doc_id, CASE WHEN p IS NULL AND u <> '' THEN sha256({fix}) END AS sequence_hash,
 CASE WHEN u = '' THEN 'invalid_sequence' WHEN p IS NOT NULL THEN CASE WHEN instr('XBZJUO', substr(u, p + 1, 1)) > 0 THEN 'unsupported_residue' ELSE 'invalid_sequence' END END AS error_kind,
 CASE WHEN u <> '' THEN p::INTEGER END AS error_position, CASE WHEN u <> '' THEN substr(u, p + 1, 1) END AS error_symbol FROM b"""


for _name, _p, _sup, _allowed, _fix in [
    ("policy_error", "error", "XU", S.STANDARD + "XU", "u"),
    ("policy_keep", "keep_if_supported", "XBZUO", S.STANDARD + "XBZUO", "u"),
    ("policy_replace", "replace_with_X", "XU", S.STANDARD + "XUBZJO", "translate(u, 'BZJO', 'XXXX')"),
]:
    _registry[_name] = (_policy(_p, _sup), _policy_sql(_allowed, _fix))


@query(f"""WITH c AS (SELECT doc_id, unnest(string_split(upper(raw), '')) AS s, generate_subscripts(string_split(upper(raw), ''), 1) - 1 AS i FROM ({SEQ}) WHERE raw <> '')
SELECT doc_id, s AS symbol, count(*) AS n, min(i)::INTEGER AS first_position, max(i)::INTEGER AS last_position FROM c WHERE instr('XBZJUO', s) > 0 GROUP BY ALL""")
def special_events(spark, sf):
    e = _sequences(spark, sf).select("doc_id", F.explode_outer(S.special_events(S.compact_upper(F.col("raw")))).alias("e")).where("e is not null")
    return e.groupBy("doc_id", F.col("e.symbol").alias("symbol")).agg(F.count(F.lit(1)).alias("n"), F.min("e.position").alias("first_position"), F.max("e.position").alias("last_position"))


@query("""SELECT doc_id, n_chars AS declared, length(replace(text, chr(10), ''))::BIGINT AS actual, n_chars <> length(replace(text, chr(10), '')) AS mismatch, CASE WHEN n_chars <> length(replace(text, chr(10), '')) THEN 'mismatch' END AS warning FROM documents""")
def declared_length_check(spark, sf):
    n = F.length(F.replace(F.col("text"), F.lit("\n"), F.lit(""))).cast("long")
    d = S.declared_length(F.col("n_chars").cast("string"), n)
    return _t(spark, sf, "documents").select("doc_id", d.alias("d"), n.alias("actual")).select("doc_id", "d.declared", "actual", "d.mismatch", "d.warning")


# rows, status and profile
def _relation(spark, sf) -> DataFrame:
    """All letters of every text as a sequence, with ids of which every tenth isn't one; a text without a letter is invalid."""
    key = F.when(F.col("doc_id") % 10 == 9, F.col("source")).otherwise(F.concat(F.lit("nsc-0"), F.col("doc_id") % 50))
    return _sequences(spark, sf).select(F.col("doc_id").alias("source_row_index"), key.alias("nsc_id"), F.col("source").alias("drug_name"), F.col("lang").alias("target_id"), F.col("raw").alias("sequence"), F.when(F.col("doc_id") % 4 > 0, F.col("n_chars").cast("string")).alias("sequence_length"))


REL = f"""rel AS (SELECT doc_id AS source_row_index, source, lang, n_chars, CASE WHEN doc_id % 10 = 9 THEN NULL ELSE 'NSC-' || (doc_id % 50) END AS id, upper(coalesce(raw, '')) AS u FROM ({SEQ})),
prep AS (SELECT *, coalesce(id, '') AS nsc_id, CASE WHEN id IS NULL THEN 'invalid_nsc' WHEN u = '' THEN 'invalid_sequence' END AS error_kind FROM rel),
rows_ AS (SELECT *, CASE WHEN error_kind IS NULL THEN 'pending' ELSE 'failed' END AS status, CASE WHEN error_kind IS NULL THEN sha256(u) END AS sequence_hash FROM prep)"""


@query(f"WITH {REL} SELECT source_row_index, nsc_id, sequence_hash, status, error_kind FROM rows_")
def row_status(spark, sf):
    return rows.prepare(_relation(spark, sf)).select("source_row_index", "nsc_id", "sequence_hash", "status", "error_kind")


@query(f"WITH {REL} SELECT count(*) AS rows, count(DISTINCT nullif(nsc_id, '')) AS unique_ids, count(DISTINCT sequence_hash) AS unique_sequences, count(sequence_hash) AS valid_rows, count(*) FILTER (status = 'failed') AS failed_rows, count(sequence_hash) - count(DISTINCT sequence_hash) AS duplicate_rows, min(length(u)) FILTER (status = 'pending')::INTEGER AS min_length, max(length(u)) FILTER (status = 'pending')::INTEGER AS max_length, round(avg(length(u)) FILTER (status = 'pending'), 6) AS mean_length, count(*) FILTER (status = 'pending' AND length(u) > 2048) AS long_rows, count(*) FILTER (status = 'pending' AND regexp_matches(u, '[XBZJUO]')) AS special_rows FROM rows_".replace("::INTEGER", "::BIGINT"))
def dataset_statistics(spark, sf):
    return rows.statistics(rows.prepare(_relation(spark, sf))).withColumn("mean_length", F.round("mean_length", 6))


@query(f"WITH {REL} SELECT sequence_hash, count(*) AS n FROM rows_ WHERE status = 'pending' GROUP BY 1 HAVING count(*) > 1")
def duplicate_hashes(spark, sf):
    return rows.prepare(_relation(spark, sf)).where("status = 'pending'").groupBy("sequence_hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


@query(f"WITH {REL} SELECT nsc_id, sequence_hash, count(*) AS n FROM rows_ WHERE status = 'pending' GROUP BY 1, 2 HAVING count(*) > 1")
def within_group_duplicates(spark, sf):
    return rows.prepare(_relation(spark, sf)).where("status = 'pending'").groupBy("nsc_id", "sequence_hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


@query(f"WITH {REL} SELECT lang, sequence_hash, count(*) AS n FROM rows_ WHERE status = 'pending' GROUP BY 1, 2 HAVING count(*) > 1")
def within_language_duplicates(spark, sf):
    """Sequences that repeat within a group, with languages as groups."""
    prepared = rows.prepare(_relation(spark, sf)).where("status = 'pending'")
    return prepared.groupBy(F.col("target_id").alias("lang"), "sequence_hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def _first_rows(spark, sf) -> DataFrame:
    """First rows of all sequences, without the texts."""
    return rows.unique_jobs(rows.prepare(_relation(spark, sf)).select("source_row_index", "sequence_hash", "status", "actual_sequence_length"))


@query(f"WITH {REL}, j AS (SELECT *, row_number() OVER (PARTITION BY sequence_hash ORDER BY source_row_index) AS rn FROM rows_ WHERE status = 'pending') SELECT source_row_index, sequence_hash, length(u)::BIGINT AS n FROM j WHERE rn = 1")
def unique_jobs(spark, sf):
    return _first_rows(spark, sf).select("source_row_index", "sequence_hash", F.col("actual_sequence_length").alias("n"))


@query(f"WITH {REL}, j AS (SELECT sequence_hash, any_value(length(u))::BIGINT AS n FROM rows_ WHERE status = 'pending' GROUP BY 1) SELECT row_number() OVER (ORDER BY n DESC, sequence_hash) AS place, sequence_hash, n FROM j")
def encode_order(spark, sf):
    """All jobs, longest first."""
    return order.by_cost(_first_rows(spark, sf).select("sequence_hash", F.col("actual_sequence_length").alias("n")), F.col("n"), "sequence_hash")


_PARTS = 8


@query(f"""WITH {REL}, j AS (SELECT sequence_hash, any_value(length(u)) AS n FROM rows_ WHERE status = 'pending' GROUP BY 1),
c AS (SELECT sequence_hash, n, CASE WHEN n <= {SIZE} THEN 1 ELSE ceil((n - {SIZE}) / {SIZE - OVERLAP}.0)::BIGINT + 1 END AS chunks FROM j),
p AS (SELECT chunks, sum(chunks) OVER () AS total, sum(chunks) OVER (ORDER BY chunks DESC, sequence_hash ROWS UNBOUNDED PRECEDING) - chunks AS before FROM c)
SELECT floor(before * {_PARTS} / total)::INTEGER AS part, count(*) AS jobs, sum(chunks)::BIGINT AS chunks, max(chunks)::INTEGER AS largest, (sum(chunks) < any_value(total) / {_PARTS}.0 + max(chunks))::BOOLEAN AS even FROM p GROUP BY 1""")
def encode_parts(spark, sf):
    """All jobs in eight partitions of about as many chunks: the mean, and less than one job more."""
    jobs = _first_rows(spark, sf).withColumn("chunks", S.chunk_count(F.col("actual_sequence_length"), SIZE, OVERLAP)).select("sequence_hash", "chunks")
    dealt = order.balanced(jobs, F.col("chunks"), "sequence_hash", _PARTS)
    total = dealt.agg(F.sum("chunks").alias("n")).scalar()
    out = dealt.groupBy("part").agg(F.count(F.lit(1)).alias("jobs"), F.sum("chunks").alias("chunks"), F.max("chunks").alias("largest"))
    return out.withColumn("even", F.col("chunks") < total / _PARTS + F.col("largest"))


@query(f"WITH {REL}, have AS (SELECT DISTINCT sequence_hash FROM rows_ JOIN labels ON source_row_index = doc_id WHERE status = 'pending'), f AS (SELECT r.*, row_number() OVER (PARTITION BY r.sequence_hash, r.status ORDER BY source_row_index) AS rn, h.sequence_hash IS NOT NULL AS have FROM rows_ r LEFT JOIN have h ON r.sequence_hash = h.sequence_hash) SELECT source_row_index, CASE WHEN status = 'failed' THEN 'failed' WHEN have THEN 'success' ELSE 'failed' END AS status, status = 'pending' AND have AND rn > 1 AS hit, CASE WHEN status = 'pending' AND NOT have THEN 'not_encoded' ELSE error_kind END AS error_kind FROM f")
def resolved_status(spark, sf):
    prepared = saved(rows.prepare(_relation(spark, sf)).select("source_row_index", "sequence_hash", "status", "error_kind"), "rows")
    done = prepared.where("status = 'pending'").join(_t(spark, sf, "labels").select(F.col("doc_id").alias("source_row_index")), "source_row_index", "left_semi").select("sequence_hash")
    return rows.resolve(prepared, done).select("source_row_index", "status", F.col("embedding_cache_hit").alias("hit"), "error_kind")


@query(f"WITH {REL} SELECT source_row_index, nsc_id, error_kind FROM rows_ WHERE status = 'failed'")
def failed_rows(spark, sf):
    return rows.prepare(_relation(spark, sf)).where("status = 'failed'").select("source_row_index", "nsc_id", "error_kind")


@query(f"WITH {REL} SELECT status, coalesce(error_kind, '') AS error_kind, count(*) AS n FROM rows_ GROUP BY 1, 2")
def status_histogram(spark, sf):
    return rows.prepare(_relation(spark, sf)).groupBy("status", F.coalesce("error_kind", F.lit("")).alias("error_kind")).agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {REL} SELECT source_row_index, id AS nsc_id FROM rows_ WHERE id IN ('NSC-3', 'NSC-7')")
def subset_by_ids(spark, sf):
    """Rows of the wanted ids, however they are spelled; an id that can't be read matches nothing."""
    found = relation.filter_rows(_relation(spark, sf), ids=["nsc 3", "7", "src3"])
    return found.select("source_row_index", S.canonical_id(F.col("nsc_id")).alias("nsc_id"))


@query(f"WITH {REL} SELECT source_row_index, id AS nsc_id FROM rows_ WHERE id IN ('NSC-3', 'NSC-7', 'NSC-11') ORDER BY source_row_index LIMIT 50")
def first_n_rows(spark, sf):
    found = relation.filter_rows(_relation(spark, sf), ids=["3", "7", "11"], most=50)
    return found.select("source_row_index", S.canonical_id(F.col("nsc_id")).alias("nsc_id"))


# chunks and positions
_PLAN = f"SELECT doc_id, length(raw) AS n, raw, unnest(generate_series(0, CASE WHEN length(raw) = 0 THEN -1 WHEN length(raw) <= {SIZE} THEN 0 ELSE (ceil((length(raw) - {SIZE}) / {SIZE - OVERLAP}.0))::INTEGER END)) AS i FROM ({SEQ})"
_CHUNKS = f"SELECT doc_id, n, raw, (i * {SIZE - OVERLAP})::INTEGER AS chunk_start, least(i * {SIZE - OVERLAP} + {SIZE}, n)::INTEGER AS chunk_end FROM ({_PLAN})"


def _chunks(spark, sf):
    return _sequences(spark, sf).select("doc_id", "raw", F.explode(S.chunk_plan(F.length("raw"), SIZE, OVERLAP)).alias("c")).select("doc_id", "raw", "c.*")


@query(f"SELECT doc_id, chunk_start, chunk_end FROM ({_CHUNKS})")
def plan_chunks(spark, sf):
    return _chunks(spark, sf).select("doc_id", "chunk_start", "chunk_end")


@query(f"SELECT doc_id, chunk_start, greatest(0, coalesce(lag(chunk_end) OVER (PARTITION BY doc_id ORDER BY chunk_start) - chunk_start, 0))::INTEGER AS overlap_prev FROM ({_CHUNKS})")
def chunk_overlap_prev(spark, sf):
    """In closed form: every chunk but the first overlaps the one before by the overlap, unless that one ends sooner."""
    return _chunks(spark, sf).select("doc_id", "chunk_start", F.when(F.col("chunk_start") > 0, OVERLAP).otherwise(0).alias("overlap_prev"))


@query(f"SELECT doc_id, chunk_start, sha256(substr(raw, chunk_start + 1, chunk_end - chunk_start)) AS chunk_hash FROM ({_CHUNKS})")
def chunk_text_hash(spark, sf):
    return _chunks(spark, sf).select("doc_id", "chunk_start", F.sha2(F.substring("raw", F.col("chunk_start") + 1, F.col("chunk_end") - F.col("chunk_start")), 256).alias("chunk_hash"))


@query(f"SELECT count(*) AS plans, count(*) FILTER (lo <> 0) AS bad_starts, count(*) FILTER (hi <> n) AS bad_ends, count(*) FILTER (longest > {SIZE} OR shortest < 1) AS bad_sizes, count(*) FILTER (d <> c) AS repeated FROM (SELECT doc_id, any_value(n) AS n, min(chunk_start) AS lo, max(chunk_end) AS hi, max(chunk_end - chunk_start) AS longest, min(chunk_end - chunk_start) AS shortest, count(*) AS c, count(DISTINCT chunk_start) AS d FROM ({_CHUNKS}) GROUP BY doc_id)")
def chunk_plan_violations(spark, sf):
    n = F.col("chunk_end") - F.col("chunk_start")
    p = _chunks(spark, sf).groupBy("doc_id").agg(F.first(F.length("raw")).alias("n"), F.min("chunk_start").alias("lo"), F.max("chunk_end").alias("hi"), F.max(n).alias("longest"), F.min(n).alias("shortest"), F.count(F.lit(1)).alias("c"), F.count_distinct("chunk_start").alias("d"))
    cnt = lambda cond: F.count(F.when(cond, 1))
    return p.agg(F.count(F.lit(1)).alias("plans"), cnt(F.col("lo") != 0).alias("bad_starts"), cnt(F.col("hi") != F.col("n")).alias("bad_ends"), cnt((F.col("longest") > SIZE) | (F.col("shortest") < 1)).alias("bad_sizes"), cnt(F.col("d") != F.col("c")).alias("repeated"))


_POS = f"SELECT doc_id, p, count(*) AS c, avg(chunk_start::DOUBLE) AS m FROM (SELECT doc_id, chunk_start, unnest(generate_series(chunk_start, chunk_end - 1)) AS p FROM ({_CHUNKS})) GROUP BY ALL"


def _coverage(spark, sf, value=None):
    n = F.length("raw")
    return _sequences(spark, sf).where("raw <> ''").select("doc_id", S.coverage(S.chunk_plan(n, SIZE, OVERLAP), n, value).alias("c"))


@query(f"SELECT doc_id, count(*) AS residues, sum(c)::BIGINT AS total, min(c) AS least, max(c) AS most FROM ({_POS}) GROUP BY doc_id")
def position_coverage(spark, sf):
    return _coverage(spark, sf).select("doc_id", *(f"c.{x}" for x in ("residues", "total", "least", "most")))


@query(f"SELECT doc_id, round(avg(m), 6) AS pooled FROM ({_POS}) GROUP BY doc_id")
def overlap_position_mean(spark, sf):
    return _coverage(spark, sf, lambda c: c["chunk_start"]).select("doc_id", F.round("c.pooled", 6).alias("pooled"))


_WIDTH = 8


@query(f"""WITH s AS (SELECT DISTINCT upper(raw) AS u FROM ({SEQ}) WHERE raw <> ''),
m AS (SELECT sha256(u) AS sequence_hash, list_sum(list_transform(string_split(u, ''), lambda c: instr('{S.STANDARD}{S.SPECIAL}', c) + 4)) / length(u) AS m FROM s)
SELECT sequence_hash, j, round((m + 0.01 * j) * 0.7310585, 6) AS value FROM m, (SELECT unnest(generate_series(0, {_WIDTH - 1}))::INTEGER AS j)""")
def mock_encode_pooled(spark, sf):
    jobs = _sequences(spark, sf).where("raw <> ''").select(F.upper("raw").alias("sequence")).distinct().withColumn("sequence_hash", S.sequence_hash(F.col("sequence")))
    out = encode.encode(jobs, encode.AlphabetEncoder(_WIDTH), SIZE, OVERLAP, element="double")
    return out.select("sequence_hash", F.posexplode("embedding").alias("j", "v")).select("sequence_hash", "j", F.round(F.col("v") * 0.7310585, 6).alias("value"))


# store
@query("SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def cache_hits(spark, sf):
    return store.hits(_t(spark, sf, "documents"), _t(spark, sf, "labels"), "doc_id").select("doc_id", "lang")


@query("SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def cache_misses(spark, sf):
    return store.misses(_t(spark, sf, "documents"), _t(spark, sf, "labels"), "doc_id").select("doc_id", "lang")


@query("WITH b AS (SELECT doc_id, quality::BIGINT AS v, 'disk' AS branch, 0 AS p FROM labels UNION ALL SELECT doc_id, n_chars, lang, 1 FROM documents) SELECT doc_id, arg_max(v, p) AS v, array_to_string(list_sort(list_distinct(list(branch))), ',') AS branches FROM b GROUP BY doc_id")
def store_merge(spark, sf):
    disk = _t(spark, sf, "labels").select("doc_id", F.col("quality").cast("long").alias("v"), F.array(F.lit("disk")).alias("branches"))
    memory = _t(spark, sf, "documents").select("doc_id", F.col("n_chars").alias("v"), F.array("lang").alias("branches"))
    return store.merge(disk, memory, "doc_id", "v", ["branches"]).select("doc_id", "v", F.array_join("branches", ",").alias("branches"))


@query("SELECT lang, array_to_string(list_sort(list_distinct(list(source))), ',') AS sources FROM documents GROUP BY lang")
def provenance_union(spark, sf):
    return _t(spark, sf, "documents").groupBy("lang").agg(F.array_join(F.array_sort(F.collect_set("source")), ",").alias("sources"))


# vectors and groups
@query("SELECT vec_id, round(sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))), 6) AS norm FROM embeddings")
def vector_norms(spark, sf):
    return _t(spark, sf, "embeddings").select("vec_id", F.round(V.norm(F.col("embedding")), 6).alias("norm"))


@query("SELECT vec_id, round(list_avg(embedding::DOUBLE[]), 6) AS mean, round(list_stddev_pop(embedding::DOUBLE[]), 6) AS deviation FROM embeddings")
def vector_moments(spark, sf):
    return _t(spark, sf, "embeddings").select("vec_id", F.round(V.mean(F.col("embedding")), 6).alias("mean"), F.round(V.deviation(F.col("embedding")), 6).alias("deviation"))


@query(f"SELECT vec_id, len(embedding) = {DIM} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_sum(list_transform(embedding, lambda x: x * x)) > 0 AS valid FROM embeddings")
def vector_quality(spark, sf):
    return _t(spark, sf, "embeddings").select("vec_id", V.is_valid(F.col("embedding"), DIM).alias("valid"))


@query(f"WITH d AS (SELECT DISTINCT label, embedding FROM embeddings WHERE len(embedding) = {DIM}), e AS (SELECT label, unnest(embedding)::DOUBLE AS v, (generate_subscripts(embedding, 1) - 1)::INTEGER AS i FROM d) SELECT label, i, round(avg(v), 6) AS mean FROM e GROUP BY ALL")
def group_vector_mean(spark, sf):
    valid = _t(spark, sf, "embeddings").where(V.is_valid(F.col("embedding"), DIM)).withColumn("h", V.hash_of(F.col("embedding")))
    mean = groups.vector_mean(groups.distinct_vectors(valid, "label", "h", "embedding"), "label", "embedding", DIM)
    return mean.select("label", F.posexplode("mean").alias("i", "m")).select("label", "i", F.round("m", 6).alias("mean"))


@query("SELECT l_suppkey, count(*) AS num_targets, count(DISTINCT l_partkey) AS num_unique_targets, count(*) FILTER (l_returnflag <> 'R') AS num_successful, count(*) FILTER (l_returnflag = 'R') AS num_failed, count(*) FILTER (l_returnflag <> 'R') - count(DISTINCT l_partkey) FILTER (l_returnflag <> 'R') AS num_duplicates_removed FROM lineitem GROUP BY 1")
def group_target_counts(spark, sf):
    return groups.group_counts(_t(spark, sf, "lineitem"), "l_suppkey", "l_partkey", F.col("l_returnflag") != "R")


@query("WITH d AS (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem) SELECT l_suppkey, cast(sum(cast(round(p_retailprice * 100) AS BIGINT)) AS DOUBLE) / count(*) AS mean_cents FROM d JOIN part ON l_partkey = p_partkey GROUP BY 1")
def dedup_then_mean_scalar(spark, sf):
    d = _t(spark, sf, "lineitem").select("l_suppkey", "l_partkey").distinct()
    part = _t(spark, sf, "part").select("p_partkey", F.round(F.col("p_retailprice") * 100).cast("long").alias("c"))
    return d.join(part, d.l_partkey == part.p_partkey).groupBy("l_suppkey").agg((F.sum("c").cast("double") / F.count(F.lit(1))).alias("mean_cents"))


@query("SELECT source, count(*) AS n FROM documents LEFT JOIN labels USING (doc_id) GROUP BY source HAVING count(*) FILTER (toxic = 1 AND quality = 0) = 0")
def groups_without_success(spark, sf):
    j = _t(spark, sf, "documents").select("doc_id", "source").join(_t(spark, sf, "labels"), "doc_id", "left")
    return j.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.count(F.when((F.col("toxic") == 1) & (F.col("quality") == 0), 1)).alias("ok")).where("ok = 0").select("source", "n")


@query("SELECT lang, arg_min(source, doc_id) AS first_source, min(doc_id) AS first_doc FROM documents GROUP BY lang")
def first_seen_label(spark, sf):
    return _t(spark, sf, "documents").groupBy("lang").agg(F.min_by("source", "doc_id").alias("first_source"), F.min("doc_id").alias("first_doc"))


_NORMS = "SELECT sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))) * (1 + vec_id % 7) AS n, list_avg(embedding::DOUBLE[]) AS m, list_stddev_pop(embedding::DOUBLE[]) AS d FROM embeddings"
_POINTS = (1, 5, 25, 50, 75, 95, 99)


@query("SELECT count(*) AS vectors, round(min(n), 6) AS min, round(max(n), 6) AS max, round(avg(n), 6) AS mean, round(quantile_disc(n, 0.5), 6) AS median, round(stddev_pop(n), 6) AS deviation, " + ", ".join(f"round(quantile_cont(n, {p / 100}), 6) AS p{p}" for p in _POINTS) + ", " + ", ".join(f"round({f}({c}), 6) AS {a}_{f}" for c, a in (("m", "mean"), ("d", "deviation")) for f in ("min", "max", "avg")) + f" FROM ({_NORMS})")
def norm_distribution(spark, sf):
    """Norms with all percentiles by refined histograms, and the spread of the vectors' means and deviations."""
    v = F.col("embedding")
    n = saved(_t(spark, sf, "embeddings").select((V.norm(v) * (1 + F.col("vec_id") % 7)).alias("n"), V.mean(v).alias("m"), V.deviation(v).alias("d")), "norms")
    about = n.agg(F.count(F.lit(1)).alias("vectors"), *(F.round(x, 6).alias(a) for a, x in [("min", F.min("n")), ("max", F.max("n")), ("mean", F.avg("n")), ("deviation", F.stddev_pop("n"))]),
                  *(F.round(f(c), 6).alias(f"{a}_{k}") for c, a in (("m", "mean"), ("d", "deviation")) for k, f in (("min", F.min), ("max", F.max), ("avg", F.avg))))
    ranks = quantiles.order_statistics(n, "n", {f"p{p}": p / 100 for p in _POINTS}, {"median": 0.5}).head()
    return about.withColumns({c: F.round(F.lit(ranks[c]), 6) for c in ("median", *(f"p{p}" for p in _POINTS))})


def _drawn(most: int) -> str:
    place = lambda side: f"('0x' || substr(sha256('0:' || d || ':{side}'), 1, 15))::BIGINT % n + 1"
    return f"""WITH p AS (SELECT vec_id, embedding, row_number() OVER (ORDER BY vec_id) AS place, count(*) OVER () AS n FROM embeddings),
d AS (SELECT d, {place('a')} AS x, {place('b')} AS y FROM (SELECT unnest(range({3 * most})) AS d), (SELECT count(*) AS n FROM embeddings)),
k AS (SELECT least(x, y) AS i, greatest(x, y) AS j, min(d) AS d FROM d WHERE x <> y GROUP BY 1, 2 ORDER BY d LIMIT {most})
SELECT a.vec_id AS a, b.vec_id AS b, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS cosine FROM k JOIN p a ON a.place = i JOIN p b ON b.place = j"""


def _drawn_cosine(spark, sf, most: int):
    e = _t(spark, sf, "embeddings")
    s = pairs.drawn_pairs(e, "vec_id", most)
    for x in ("a", "b"):
        s = s.join(e.select(F.col("vec_id").alias(x), F.col("embedding").alias(f"v{x}")), x)
    return s.select("a", "b", F.round(V.cosine(F.col("va"), F.col("vb")), 6).alias("cosine"))


@query(_drawn(2000))
def sampled_pairs_cosine(spark, sf):
    return _drawn_cosine(spark, sf, 2000)


@query(_drawn(20000))
def drawn_pairs_cosine(spark, sf):
    """The number of pairs of the default configuration."""
    return _drawn_cosine(spark, sf, 20000)


_COS = "SELECT list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS c, a.vec_id AS a, b.vec_id AS b FROM embeddings a JOIN embeddings b ON a.vec_id < b.vec_id"


@query("SELECT count(*) AS pairs, round(min(c), 6) AS min, round(max(c), 6) AS max, round(avg(c), 6) AS mean, round(quantile_disc(c, 0.5), 6) AS median, round(avg((c >= 0.995)::INTEGER), 6) AS collapsed, " + ", ".join(f"round(quantile_cont(c, {x / 100}), 6) AS p{x}" for x in (1, 5, 25, 50, 75, 95, 99)) + f" FROM ({_COS})")
def pairwise_cosine_stats(spark, sf):
    """All pairs, as block sums and histograms."""
    return pairs.all_pairs_statistics(_t(spark, sf, "embeddings"), "vec_id", "embedding")


_STATS = "count(*) AS pairs, round(min(c), 6) AS min, round(max(c), 6) AS max, round(avg(c), 6) AS mean, round(quantile_disc(c, 0.5), 6) AS median, round(avg((c >= 0.995)::INTEGER), 6) AS collapsed, " + ", ".join(f"round(quantile_cont(c, {x / 100}), 6) AS p{x}" for x in _POINTS)


@query(f"""WITH n AS (SELECT count(*) AS n FROM embeddings), s AS (SELECT {_STATS}, 'exact' AS method FROM ({_COS}) WHERE (SELECT n FROM n) <= {pairs.EXACT_MOST}
UNION ALL SELECT {_STATS}, 'sampled' FROM ({_drawn(pairs.DRAWN).replace('round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS cosine', 'list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS c')}) WHERE (SELECT n FROM n) > {pairs.EXACT_MOST})
SELECT s.*, n AS vectors, CASE WHEN collapsed > {pairs.COLLAPSE} THEN 'nearly all vectors point the same way' END AS warning FROM s, n WHERE method = CASE WHEN n <= {pairs.EXACT_MOST} THEN 'exact' ELSE 'sampled' END""")
def cosine_report(spark, sf):
    """All pairs of up to 1000 vectors, 20,000 drawn ones of more, and whether the vectors have collapsed."""
    return pairs.cosine_report(_t(spark, sf, "embeddings"), "vec_id", "embedding")


@query(f"SELECT a, b, round(c, 6) AS cosine FROM ({_COS} ORDER BY c DESC, a DESC, b DESC LIMIT 10)")
def nearest_pairs(spark, sf):
    return pairs.block_top(_t(spark, sf, "embeddings"), "vec_id", "embedding", 10).withColumn("cosine", F.round("cosine", 6))


@query(f"SELECT a, b, round(c, 6) AS cosine FROM ({_COS} ORDER BY c, a, b LIMIT 10)")
def farthest_pairs(spark, sf):
    return pairs.block_top(_t(spark, sf, "embeddings"), "vec_id", "embedding", 10, farthest=True).withColumn("cosine", F.round("cosine", 6))


_OUT = 16
_W = f"SELECT o, i, ((o * 7 + i * 3) % 11 - 5) / 10.0::DOUBLE AS w FROM (SELECT unnest(generate_series(0, {_OUT - 1})) AS o), (SELECT unnest(generate_series(0, {DIM - 1})) AS i)"


@query(f"WITH e AS (SELECT label, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings), m AS (SELECT label, i, avg(v) AS m FROM e GROUP BY ALL), y AS (SELECT label, o, sum(m * w) + 0.01 * any_value(o) AS y FROM m JOIN ({_W}) USING (i) GROUP BY ALL) SELECT label, o::INTEGER AS o, round((y - avg(y) OVER (PARTITION BY label)) / sqrt(var_pop(y) OVER (PARTITION BY label) + 1e-5), 4) AS value FROM y")
def project_layernorm(spark, sf):
    mean = groups.vector_mean(_t(spark, sf, "embeddings"), "label", "embedding", DIM)
    weight = [[((o * 7 + i * 3) % 11 - 5) / 10.0 for i in range(DIM)] for o in range(_OUT)]
    out = groups.project(mean, "label", "mean", weight, [0.01 * o for o in range(_OUT)])
    return out.select("label", F.posexplode("projected").alias("o", "v")).select("label", "o", F.round("v", 4).alias("value"))


@query("SELECT vec_id, label, " + ", ".join(f"round(embedding[{i}]::DOUBLE, 6) AS emb_{i}" for i in range(1, DIM + 1)) + " FROM embeddings")
def wide_embedding(spark, sf):
    from ..sources.sinks import wide

    w = wide(_t(spark, sf, "embeddings"), "embedding", DIM)
    return w.select("vec_id", "label", *(F.round(F.col(f"emb_{i}").cast("double"), 6).alias(f"emb_{i}") for i in range(1, DIM + 1)))


@query("""WITH e AS (SELECT label, embedding, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS i FROM embeddings),
one AS (SELECT label, i, avg(v) AS m FROM e GROUP BY ALL),
two AS (SELECT label, i, sum(v) / count(*) AS m FROM e GROUP BY ALL),
j AS (SELECT label, count(*) FILTER (abs(one.m - two.m) > 1e-5 + 1e-4 * abs(two.m)) AS bad FROM one JOIN two USING (label, i) GROUP BY label)
SELECT count(*) AS groups, count(*) FILTER (bad > 0) AS mismatches FROM j""")
def validator_recompute(spark, sf):
    """Group means by fixed columns against means by element rows."""
    e = _t(spark, sf, "embeddings")
    one = groups.vector_mean(e, "label", "embedding", DIM)
    rows_ = e.select("label", F.posexplode("embedding").alias("i", "v")).groupBy("label", "i").agg(F.avg(F.col("v").cast("double")).alias("m"))
    two = rows_.groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda x: x["m"]).alias("again"))
    j = one.join(two, "label")
    return j.agg(F.count(F.lit(1)).alias("groups"), F.count(F.when(~V.close(F.col("mean"), F.col("again")), 1)).alias("mismatches"))


@query("SELECT page_id, regexp_extract(url, '^[a-z]+://([^/]+)', 1) AS owner, len(string_split(url, '/'))::INTEGER AS depth FROM pages")
def url_owner(spark, sf):
    return _t(spark, sf, "pages").select("page_id", F.regexp_extract("url", "^[a-z]+://([^/]+)", 1).alias("owner"), F.size(F.split("url", "/")).alias("depth"))


from . import run_queries  # noqa: E402,F401  (registers its queries)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, (f, _) in _registry.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for k, (_, s) in _registry.items() if s}
