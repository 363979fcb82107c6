"""Queries over a whole run: payloads, artifacts, branches, diagnostics and the validator's checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import sequences as S
from ..functions import vectors as V
from ..operators import commits, diagnostics, encode, groups, order, rows, store, validate, waves
from ..operators import run as runs
from ..operators.scratch import new_path, saved
from ..sources import relation, sinks
from ..streaming import incremental
from .queries import _CHUNKS, _COS, DIM, OVERLAP, REL, SEQ, SIZE, _chunks, _first_rows, _relation, _sequences, _t, query

CAPACITY = 2046
_EVENTS = "list_filter(list_transform(string_split(u, ''), lambda c, i: {'position': i - 1, 'symbol': c, 'replaced_with': CASE WHEN instr('%s', c) > 0 THEN 'X' END}), lambda e: instr('XBZJUO', e.symbol) > 0)"


# rows
@query(f"""WITH {REL}, e AS (SELECT *, CASE WHEN status = 'pending' THEN {_EVENTS % ''} END AS ev, CASE WHEN source_row_index % 4 > 0 THEN n_chars END AS declared FROM rows_)
SELECT source_row_index, nsc_id, source AS drug_name, declared AS sequence_length, length(u)::BIGINT * (status = 'pending')::INTEGER AS n, status, len(coalesce(ev, []))::INTEGER AS events, sha256(CASE WHEN len(coalesce(ev, [])) > 0 THEN to_json(ev)::VARCHAR ELSE '' END) AS events_hash,
 CASE WHEN status = 'failed' THEN '' WHEN declared IS NULL THEN 'missing' WHEN declared <> length(u) THEN 'mismatch' ELSE '' END AS error, coalesce(status = 'pending' AND declared <> length(u), FALSE) AS mismatch FROM e""")
def row_payload(spark, sf):
    """A successful row may carry a warning in ``error``."""
    prepared = rows.prepare(_relation(spark, sf)).withColumn("events", F.coalesce(F.size("special_residue_events"), F.lit(0)))
    out = sinks.row_payload(prepared)
    return out.select("source_row_index", "nsc_id", "drug_name", "sequence_length", F.coalesce("actual_sequence_length", F.lit(0)).alias("n"), "status", F.greatest("events", F.lit(0)).alias("events"), F.sha2("special_residue_events", 256).alias("events_hash"), "error", F.col("sequence_length_mismatch").alias("mismatch"))


@query(f"""WITH {REL}, e AS (SELECT unnest({_EVENTS % 'BZJO'}) AS e FROM rows_ WHERE status = 'pending')
SELECT e.symbol AS symbol, e.replaced_with AS replaced_with, count(*) AS n, sum(e.position)::BIGINT AS places FROM e GROUP BY ALL""")
def replaced_events(spark, sf):
    """Events are those before replacement."""
    e = rows.prepare(_relation(spark, sf), "replace_with_X", "XU").select(F.explode_outer("special_residue_events").alias("e")).where("e is not null")  # a plain explode makes the events twice, in a condition on their number
    return e.groupBy(F.col("e.symbol").alias("symbol"), F.col("e.replaced_with").alias("replaced_with")).agg(F.count(F.lit(1)).alias("n"), F.sum("e.position").alias("places"))


@query(f"""WITH u AS (SELECT doc_id, raw, upper(raw) AS u FROM ({SEQ}))
SELECT doc_id, array_to_string(list_sort(list_distinct(list_filter(string_split(raw, ''), lambda c: c <> '' AND instr('XBZJUO', c) > 0))), '') AS before, array_to_string(list_sort(list_distinct(list_filter(string_split(u, ''), lambda c: c <> '' AND instr('XBZJUO', c) > 0))), '') AS after FROM u""")
def symbol_sets(spark, sf):
    """Special symbols of the text as it stands, and after cleaning."""
    return _sequences(spark, sf).select("doc_id", F.array_join(S.special_symbols(F.col("raw")), "").alias("before"), F.array_join(S.special_symbols(S.compact_upper(F.col("raw"))), "").alias("after"))


@query(f"""WITH e AS (SELECT doc_id, unnest({_EVENTS % ''}) AS e FROM (SELECT doc_id, upper(raw) AS u FROM ({SEQ}) WHERE raw <> ''))
SELECT doc_id, e.symbol AS symbol, array_to_string(list(e.position ORDER BY e.position), ',') AS positions FROM e GROUP BY ALL""")
def symbol_positions(spark, sf):
    m = _sequences(spark, sf).select("doc_id", F.explode_outer(S.symbol_positions(S.special_events(S.compact_upper(F.col("raw"))))).alias("symbol", "places")).where("symbol is not null")
    return m.select("doc_id", "symbol", F.array_join(F.transform("places", lambda p: p.cast("string")), ",").alias("positions"))


@query("SELECT page_id, upper(replace(url, '/', '')) AS token, CASE WHEN page_id % 2 = 0 THEN substr(sha256(url), 1, 40) END AS commit_hash, CASE WHEN contains(substr(url, 9), '/') THEN split_part(substr(url, 9), '/', 1) ELSE '' END AS owner FROM pages")
def name_parts(spark, sf):
    """Token text, commit and owner from spellings made of page addresses."""
    url, sha = F.col("url"), F.sha2("url", 256)
    token = F.concat(F.lit("▁"), F.replace(url, F.lit("/"), F.lit("Ġ ")))
    path = F.concat(F.lit("cache\\snapshots/"), F.when(F.col("page_id") % 2 == 0, F.substring(sha, 1, 40)).otherwise(F.substring(sha, 1, 39)), F.lit("/x"))
    return _t(spark, sf, "pages").select("page_id", S.token_text(token).alias("token"), S.commit_of(path).alias("commit_hash"), S.owner_of(F.substring(url, 9, 100000)).alias("owner"))


@query(f"""WITH c AS (SELECT doc_id, string_split(upper(raw), '') AS c FROM ({SEQ}) WHERE raw <> ''),
k AS (SELECT doc_id, c, list_filter(range(len(c)), lambda i: instr('XBZJUO', c[i + 1]) = 0 AND i % 5 <> 4) AS k FROM c)
SELECT doc_id, len(k)::INTEGER AS residues, sha256(array_to_string(list_transform(k, lambda i: c[i + 1]), '')) AS order_hash, len(k) = len(c) AS complete FROM k""")
def residue_positions(spark, sf):
    """Places that masks leave, the symbols there in order, and whether all were kept."""
    c = _sequences(spark, sf).where("raw <> ''").select("doc_id", F.split(S.compact_upper(F.col("raw")), "").alias("c"))
    special = F.transform("c", lambda x: (F.instr(F.lit(S.SPECIAL), x) > 0).cast("int"))
    attention = F.transform("c", lambda x, i: (i % 5 != 4).cast("int"))
    k = c.withColumns({"special": special, "attention": attention}).withColumn("k", S.kept_positions(F.col("special"), F.col("attention")))
    return k.select("doc_id", F.size("k").alias("residues"), F.sha2(F.array_join(S.gathered(F.col("c"), F.col("k")), ""), 256).alias("order_hash"), (F.size("k") == F.size("c")).alias("complete"))


@query(f"""WITH {REL}, s AS (SELECT *, length(u) AS n, CASE WHEN source_row_index % 4 > 0 THEN n_chars END AS declared, status = 'pending' AS ok FROM rows_)
SELECT count(*) AS rows, count(DISTINCT nullif(nsc_id, '')) AS unique_ids, count(DISTINCT sequence_hash) AS unique_sequences, count(*) FILTER (ok) AS valid_rows, count(*) FILTER (NOT ok) AS failed_rows, count(*) FILTER (ok) - count(DISTINCT sequence_hash) AS duplicate_rows,
 min(n) FILTER (ok)::BIGINT AS min_length, max(n) FILTER (ok)::BIGINT AS max_length, round(avg(n) FILTER (ok), 6) AS mean_length, count(*) FILTER (ok AND n > 2048) AS long_rows, count(*) FILTER (ok AND regexp_matches(u, '[XBZJUO]')) AS special_rows,
 count(DISTINCT nullif(source, '')) AS unique_drug_name, count(DISTINCT nullif(lang, '')) AS unique_target_id, count(*) FILTER (ok AND declared <> n) AS length_mismatches, count(*) FILTER (ok AND declared IS NULL) AS missing_lengths, count(*) FILTER (NOT ok) AS missing_sequences,
 count(DISTINCT sequence_hash) FILTER (n > 2048) AS long_unique, count(*) FILTER (ok AND n > {CAPACITY}) AS chunked_rows, count(DISTINCT sequence_hash) FILTER (n > {CAPACITY}) AS chunked_unique, {CAPACITY}::BIGINT AS capacity FROM s""")
def inspection_report(spark, sf):
    """All scalars of the profile."""
    prepared = rows.prepare(_relation(spark, sf)).withColumn("uniprot_id", F.lit(None).cast("string"))
    return rows.full_statistics(prepared, CAPACITY).withColumn("mean_length", F.round("mean_length", 6)).drop("unique_uniprot_id")


@query(f"WITH {REL} SELECT source_row_index, nsc_id, length(u)::BIGINT AS n, sequence_hash FROM rows_ WHERE status = 'pending' AND length(u) > {CAPACITY}")
def long_rows_detail(spark, sf):
    return rows.prepare(_relation(spark, sf)).where(F.col("actual_sequence_length") > CAPACITY).select("source_row_index", "nsc_id", F.col("actual_sequence_length").alias("n"), "sequence_hash")


@query("SELECT source AS value, min(doc_id) AS first_seen FROM documents WHERE source IS NOT NULL GROUP BY 1")
def ordered_distinct(spark, sf):
    return order.first_of_each(_t(spark, sf, "documents"), "source", "doc_id").withColumnRenamed("source", "value")


@query(f"WITH {REL} SELECT row_number() OVER (ORDER BY source_row_index) AS place, source_row_index, nsc_id FROM rows_")
def output_order(spark, sf):
    """Rows numbered in order of the source."""
    return order.numbered_ids(rows.prepare(_relation(spark, sf)).select("source_row_index", "nsc_id"), "source_row_index")


@query(f"""WITH c AS (SELECT doc_id, n, chunk_start, chunk_end FROM ({_CHUNKS}) WHERE (chunk_start // {SIZE - OVERLAP}) % 3 <> 1),
p AS (SELECT doc_id, count(DISTINCT p) AS covered FROM (SELECT doc_id, unnest(range(chunk_start, chunk_end)) AS p FROM c) GROUP BY 1)
SELECT doc_id, any_value(n) > any_value(covered) AS gap, CASE WHEN any_value(n) > any_value(covered) THEN 'uncovered position' END AS error FROM c JOIN p USING (doc_id) GROUP BY doc_id""")
def coverage_gap(spark, sf):
    """Every third chunk from the second left out: which texts have an uncovered position."""
    n = F.length("raw")
    plan = F.filter(S.chunk_plan(n, SIZE, OVERLAP), lambda c: F.floor(c["chunk_start"] / (SIZE - OVERLAP)) % 3 != 1)
    c = _sequences(spark, sf).where("raw <> ''").select("doc_id", S.coverage(plan, n).alias("c"))
    return c.select("doc_id", F.col("c.error").isNotNull().alias("gap"), "c.error")


@query("SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1)::BIGINT AS source_row_index FROM documents")
def source_rows(spark, sf):
    """Documents written as several files in order, with the index of each row in file order, whatever moves the rows later."""
    files = saved(_t(spark, sf, "documents").select("doc_id", "lang").repartitionByRange(5, "doc_id").sortWithinPartitions("doc_id"), "source")
    return relation.with_row_index(files).repartition(7, "lang").select("doc_id", "source_row_index")


# vectors of rows and groups
_JOINED = f"""WITH {REL}, v AS (SELECT sequence_hash, arg_min(embedding, source_row_index) AS e FROM rows_ JOIN embeddings ON source_row_index = vec_id WHERE status = 'pending' GROUP BY 1),
j AS (SELECT r.*, v.e, r.status = 'pending' AND v.e IS NOT NULL AS ok FROM rows_ r LEFT JOIN v USING (sequence_hash)),
g AS (SELECT nsc_id, sequence_hash, any_value(e) AS e FROM j WHERE ok GROUP BY 1, 2),
m AS (SELECT nsc_id, i, avg(x) AS m FROM (SELECT nsc_id, unnest(e)::DOUBLE AS x, generate_subscripts(e, 1) AS i FROM g) GROUP BY ALL)"""


def _run(spark, sf):
    """Prepared rows, stored vectors by hash, and rows with their vectors."""
    prepared = saved(rows.prepare(_relation(spark, sf)).select("source_row_index", "nsc_id", "drug_name", "sequence_hash", "status", "error_kind"), "rows")
    pending = prepared.where("status = 'pending'")
    e = _t(spark, sf, "embeddings").select(F.col("vec_id").alias("source_row_index"), "embedding")
    vectors = saved(pending.join(e, "source_row_index").groupBy("sequence_hash").agg(F.min_by("embedding", "source_row_index").alias("embedding")), "vectors")
    joined = prepared.join(vectors, "sequence_hash", "left").withColumn("ok", (F.col("status") == "pending") & F.col("embedding").isNotNull())
    return prepared, vectors, joined


@query(f"{_JOINED} SELECT source_row_index, ok AS row_valid, CASE WHEN ok THEN sum(ok::INTEGER) OVER (ORDER BY source_row_index) - 1 END::BIGINT AS vector_index, CASE WHEN ok THEN round(e[1]::DOUBLE, 6) END AS first_value FROM j")
def row_vectors(spark, sf):
    """Compact index of the vectors of successful rows, and a mask over all rows."""
    out = sinks.row_vectors(_run(spark, sf)[2], "source_row_index", F.col("ok"))
    return out.select("source_row_index", "row_valid", "vector_index", F.when(F.col("ok"), F.round(F.get("embedding", F.lit(0)).cast("double"), 6)).alias("first_value"))


@query(f"{_JOINED} SELECT nsc_id, round(sum(m * i), 5) AS weighed, count(*) AS dim FROM m GROUP BY nsc_id")
def group_vectors(spark, sf):
    """The primary artifact: one mean vector a group with any success, shown by a weighed sum."""
    _, _, joined = _run(spark, sf)
    distinct = groups.distinct_vectors(joined.where("ok"), "nsc_id", "sequence_hash", "embedding")
    mean = groups.checked_mean(groups.vector_mean(distinct, "nsc_id", "embedding", DIM), "mean")
    weighed = F.aggregate(F.transform("mean", lambda x, i: x * (i + 1)), F.lit(0.0), lambda a, x: a + x)
    return mean.select("nsc_id", F.round(weighed, 5).alias("weighed"), F.size("mean").cast("long").alias("dim"))


@query(f"""{_JOINED} SELECT nsc_id, arg_min(source, source_row_index) FILTER (trim(source) <> '') AS drug_name, count(*) AS num_targets, count(DISTINCT sequence_hash) FILTER (ok) AS num_unique_targets, count(*) FILTER (ok) AS num_successful, count(*) FILTER (status <> 'pending') AS num_failed,
 count(*) FILTER (ok) - count(DISTINCT sequence_hash) FILTER (ok) AS num_duplicates_removed, 'mean' AS aggregation_method, CASE WHEN count(*) FILTER (ok) > 0 THEN 'success' ELSE 'failed' END AS status, CASE WHEN count(*) FILTER (ok) = 0 THEN '{groups.NO_VECTOR}' END AS error, CASE WHEN count(*) FILTER (ok) > 0 THEN {DIM} ELSE 0 END::INTEGER AS embedding_dim FROM j GROUP BY nsc_id""")
def group_summary(spark, sf):
    prepared, vectors, _ = _run(spark, sf)
    return groups.group_summary(prepared, vectors, "nsc_id", "sequence_hash", "drug_name", "source_row_index", F.col("status") == "pending", DIM)


@query(f"""{_JOINED}, s AS (SELECT nsc_id, count(*) FILTER (ok) AS n, count(DISTINCT sequence_hash) FILTER (ok) AS u FROM j GROUP BY 1)
SELECT count(*) AS groups, count(*) FILTER (n > 0) AS groups_with_vector, count(*) FILTER (n = 0) AS groups_without, sum(n - u)::BIGINT AS duplicates_removed FROM s""")
def aggregation_summary(spark, sf):
    s = group_summary(spark, sf)
    return s.agg(F.count(F.lit(1)).alias("groups"), F.count(F.when(F.col("status") == "success", 1)).alias("groups_with_vector"), F.count(F.when(F.col("status") == "failed", 1)).alias("groups_without"), F.sum("num_duplicates_removed").alias("duplicates_removed"))


@query(f"{_JOINED} SELECT s.nsc_id, s.drug_name, s.n, round(m.m, 6) AS emb_1 FROM (SELECT nsc_id, arg_min(source, source_row_index) AS drug_name, count(*) AS n FROM j GROUP BY 1) s JOIN m USING (nsc_id) WHERE i = 1")
def group_metadata(spark, sf):
    """Group metadata and vectors by key, inner, with the vector as columns."""
    _, _, joined = _run(spark, sf)
    distinct = groups.distinct_vectors(joined.where("ok"), "nsc_id", "sequence_hash", "embedding")
    vectors = sinks.wide(groups.vector_mean(distinct, "nsc_id", "embedding", DIM).select("nsc_id", "mean"), "mean", DIM)
    about = joined.groupBy("nsc_id").agg(F.min_by("drug_name", "source_row_index").alias("drug_name"), F.count(F.lit(1)).alias("n"))
    return about.join(vectors, "nsc_id").select("nsc_id", "drug_name", "n", F.round("emb_1", 6).alias("emb_1"))


@query(f"""{_JOINED}, h AS (SELECT DISTINCT sequence_hash FROM v), b AS (SELECT nsc_id, count(*) FILTER (ok) AS n FROM j GROUP BY 1), x AS (SELECT DISTINCT nsc_id FROM m)
SELECT 'statuses add up' AS name, count(*) AS seen, count(*) FILTER (status NOT IN ('pending', 'failed')) AS bad FROM j
UNION ALL SELECT 'a vector for every successful row', count(*) FILTER (ok), count(*) FILTER (ok AND sequence_hash NOT IN (SELECT * FROM h)) FROM j
UNION ALL SELECT 'pending rows without a vector', count(*) FILTER (status = 'pending'), count(*) FILTER (status = 'pending' AND NOT ok) FROM j
UNION ALL SELECT 'a kind for every failed row', count(*) FILTER (status = 'failed'), count(*) FILTER (status = 'failed' AND error_kind IS NULL) FROM j
UNION ALL SELECT 'groups with and without a vector are all groups', count(*), abs(count(*) - (SELECT count(*) FROM x) - count(*) FILTER (n = 0)) FROM b
UNION ALL SELECT 'groups without success have no vector', count(*) FILTER (n = 0), count(*) FILTER (n = 0 AND nsc_id IN (SELECT * FROM x)) FROM b
UNION ALL SELECT 'means as computed again', (SELECT count(*) FROM m), (SELECT count(*) FROM m JOIN (SELECT nsc_id, i, sum(x) / count(*) AS again FROM (SELECT nsc_id, unnest(e)::DOUBLE AS x, generate_subscripts(e, 1) AS i FROM g) GROUP BY ALL) USING (nsc_id, i) WHERE abs(m - again) > 1e-5 + 1e-4 * abs(again))""")
def validator_checks(spark, sf):
    """One row a check: how many cases it saw and how many fail."""
    _, vectors, joined = _run(spark, sf)
    many = lambda c: F.count(F.when(c, 1))
    ok, failed, pending = F.col("ok"), F.col("status") == "failed", F.col("status") == "pending"
    check = lambda frame, name, seen, bad: frame.agg(seen.alias("seen"), bad.alias("bad")).withColumn("name", F.lit(name))
    stored = joined.join(vectors.select("sequence_hash", F.lit(True).alias("_v")), "sequence_hash", "left")
    distinct = groups.distinct_vectors(joined.where("ok"), "nsc_id", "sequence_hash", "embedding")
    mean = groups.vector_mean(distinct, "nsc_id", "embedding", DIM)
    b = joined.groupBy("nsc_id").agg(many(ok).alias("n")).join(mean.select("nsc_id", F.lit(True).alias("_m")), "nsc_id", "left")
    again = distinct.select("nsc_id", F.posexplode("embedding").alias("i", "x")).groupBy("nsc_id", "i").agg((F.sum(F.col("x").cast("double")) / F.count(F.lit(1))).alias("again"))
    both = mean.select("nsc_id", F.posexplode("mean").alias("i", "m")).join(again, ["nsc_id", "i"])
    none, has = F.col("n") == 0, F.col("_m").isNotNull()
    checks = [
        check(joined, "statuses add up", F.count(F.lit(1)), many(~pending & ~failed)),
        check(stored, "a vector for every successful row", many(ok), many(ok & F.col("_v").isNull())),
        check(joined, "pending rows without a vector", many(pending), many(pending & ~ok)),
        check(joined, "a kind for every failed row", many(failed), many(failed & F.col("error_kind").isNull())),
        check(b, "groups with and without a vector are all groups", F.count(F.lit(1)), F.abs(F.count(F.lit(1)) - many(has) - many(none))),
        check(b, "groups without success have no vector", many(none), many(none & has)),
        check(both, "means as computed again", F.count(F.lit(1)), many(F.abs(F.col("m") - F.col("again")) > 1e-5 + 1e-4 * F.abs("again"))),
    ]
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out


_SEEN = [
    *((f"{a} can be read", "1") for a in validate.ARTIFACTS), ("every row succeeded or failed", "n"), ("every failed row says why", "failed"), ("every successful row has a hash", "good"), ("length mismatches are True, False or empty", "n"),
    ("row numbers don't repeat", "n"), ("group keys are canonical", "named"), ("groups don't repeat", "g"), ("members of a group add up", "g"), (f"entries have {DIM} elements", "e"), ("entries are finite and not zero", "e"),
    ("entries don't repeat", "e"), (f"group vectors have {DIM} elements", "gv"), ("group vectors are finite and not zero", "gv"), ("only valid rows have an index", "n"), ("the index counts valid rows from 0 without gaps", "good"),
    ("failed_rows holds every failed row", "failed"), ("failed rows are rows", "failed"), ("every hash of a successful row has an entry", "e"), ("the mask covers all rows and is true where a row succeeded", "n"), ("every group of the rows is a group", "g"),
    ("groups with a vector are those with a success", "gv"), ("group vectors are the means of their entries", "gv"),
]


@query(f"""{_JOINED}, c AS (SELECT count(*) AS n, count(*) FILTER (ok) AS good, count(*) FILTER (NOT ok) AS failed, count(DISTINCT nsc_id) AS g, count(DISTINCT nullif(nsc_id, '')) AS named, (SELECT count(*) FROM v) AS e, count(DISTINCT nsc_id) FILTER (ok) AS gv FROM j)
""" + " UNION ALL ".join(f"SELECT '{name.replace(chr(39), chr(39) * 2)}' AS name, {seen}::BIGINT AS seen, 0::BIGINT AS bad FROM c" for name, seen in _SEEN))
def validated_artifacts(spark, sf):
    """All artifacts of a run over the documents, written, read back and checked."""
    folder = new_path(spark, "artifacts")
    prepared = saved(rows.prepare(_relation(spark, sf)).drop("sequence"), "prepared")
    e = _t(spark, sf, "embeddings").select(F.col("vec_id").alias("source_row_index"), "embedding")
    entries = saved(prepared.where("status = 'pending'").join(e, "source_row_index").groupBy("sequence_hash").agg(F.min_by("embedding", "source_row_index").alias("embedding")), "entries")

    def ended(some, known):
        joined = some.join(known, "sequence_hash", "left").withColumn("ok", (F.col("status") == "pending") & F.coalesce("known", F.lit(False))).drop("known")
        return joined.withColumns({"error": F.when(~F.col("ok"), F.coalesce("error_kind", F.lit("sequence was not encoded"))), "status": F.when(F.col("ok"), "success").otherwise("failed")})

    # events go into the payload only, vectors into the other artifacts only: no row carries both
    known = F.col("embedding").isNotNull().alias("known")
    final = saved(ended(prepared.drop("special_residue_events"), entries.select("*", known)), "final")
    payload = ended(prepared, entries.select("sequence_hash", known))
    distinct = groups.distinct_vectors(final.where("ok"), "nsc_id", "sequence_hash", "embedding")
    mean = groups.checked_mean(groups.vector_mean(distinct, "nsc_id", "embedding", DIM), "mean").select("nsc_id", "mean")
    summary = groups.group_summary(final, entries, "nsc_id", "sequence_hash", "drug_name", "source_row_index", F.col("ok"), DIM)
    sinks.write_artifacts(folder, payload.drop("ok"), sinks.row_vectors(final, "source_row_index", F.col("ok")).select("source_row_index", "row_valid", "vector_index", "embedding"), summary, mean, entries)
    return validate.validate(spark, folder, DIM)


# store
_ENTRIES = "b AS (SELECT doc_id, CASE WHEN quality = 1 THEN ['target'] ELSE ['other'] END AS branches FROM labels)"


def _lookups(spark, sf):
    entries = _t(spark, sf, "labels").select("doc_id", F.array(F.when(F.col("quality") == 1, "target").otherwise("other")).alias("branches"))
    return store.branch_lookup(_t(spark, sf, "documents").select("doc_id"), entries, "target", "doc_id")


@query(f"WITH {_ENTRIES} SELECT doc_id, CASE WHEN branches IS NULL THEN 'miss' WHEN list_contains(branches, 'target') THEN 'same' ELSE 'cross' END AS lookup, CASE WHEN branches IS NOT NULL THEN array_to_string(list_sort(list_distinct(list_append(branches, 'target'))), ',') END AS branches FROM documents LEFT JOIN b USING (doc_id)")
def branch_hits(spark, sf):
    return _lookups(spark, sf).select("doc_id", "lookup", F.array_join("branches", ",").alias("branches"))


@query(f"WITH {_ENTRIES}, l AS (SELECT branches FROM documents LEFT JOIN b USING (doc_id)) SELECT count(branches) AS hits, count(*) - count(branches) AS misses, count(*) FILTER (list_contains(branches, 'target')) AS same_branch_hits, count(*) FILTER (NOT list_contains(branches, 'target')) AS cross_branch_hits FROM l")
def cache_counters(spark, sf):
    return store.counters(_lookups(spark, sf))


@query(f"WITH {REL}, j AS (SELECT sequence_hash, any_value(length(u)) AS n FROM rows_ WHERE status = 'pending' GROUP BY 1), p AS (SELECT n, row_number() OVER (ORDER BY n DESC, sequence_hash) AS place FROM j) SELECT (place - 1) // 100 AS wave, count(*) AS entries, sum(n)::BIGINT AS residues FROM p GROUP BY 1")
def save_waves(spark, sf):
    """Commits of 100 entries each, in encode order."""
    placed = order.by_cost(_first_rows(spark, sf).select("sequence_hash", F.col("actual_sequence_length").alias("n")), F.col("n"), "sequence_hash")
    return store.waves(placed, "place", 100).groupBy("wave").agg(F.count(F.lit(1)).alias("entries"), F.sum("n").alias("residues"))


@query("""WITH d AS (SELECT count(*) AS n, max(n_chars) AS longest FROM documents), p AS (SELECT count(*) AS n FROM pages),
s(field, stored) AS (SELECT * FROM (VALUES ('encoder', 'one-hot'), ('size', '512'), ('overlap', '128'), ('policy', 'keep'), ('revision', NULL), ('layout', 'prefix-2')) UNION ALL SELECT 'rows', n::VARCHAR FROM d UNION ALL SELECT 'longest', longest::VARCHAR FROM d),
c(field, now) AS (SELECT * FROM (VALUES ('encoder', 'one-hot'), ('size', '512'), ('overlap', '256'), ('policy', 'keep'), ('seed', '0'), ('layout', 'prefix-2')) UNION ALL SELECT 'rows', n::VARCHAR FROM p UNION ALL SELECT 'longest', longest::VARCHAR FROM d)
SELECT coalesce(s.field, c.field) AS field, stored, now FROM s FULL JOIN c ON s.field = c.field WHERE s.field IS NULL OR c.field IS NULL OR stored IS DISTINCT FROM now""")
def fingerprint_diff(spark, sf):
    """Settings of two stores, with figures of the tables among them, read back from their logs and joined."""
    documents = _t(spark, sf, "documents").agg(F.count(F.lit(1)).alias("n"), F.max("n_chars").alias("longest")).head()
    shared = {"encoder": "one-hot", "size": SIZE, "policy": "keep", "longest": documents["longest"]}
    made = [{**shared, "overlap": 128, "revision": None, "rows": documents["n"]}, {**shared, "overlap": 256, "seed": 0, "rows": _t(spark, sf, "pages").count()}]
    logs = []
    for settings in made:
        at = commits.Store(spark, new_path(spark, "store"), settings)
        at.commit(spark.createDataFrame([], commits.ENTRY))
        logs.append(commits.settings_of(spark, at.path))
    return commits.settings_diff(*logs)


@query(f"""WITH {REL}, have AS (SELECT DISTINCT sequence_hash FROM rows_ JOIN labels ON source_row_index = doc_id WHERE status = 'pending'), r AS (SELECT r.*, h.sequence_hash IS NOT NULL AS have FROM rows_ r LEFT JOIN have h USING (sequence_hash)),
u AS (SELECT sequence_hash, any_value(have) AS have FROM r WHERE status = 'pending' GROUP BY 1)
SELECT (SELECT count(*) FROM r) AS total_rows, (SELECT count(*) FROM r WHERE have) AS successful_rows, (SELECT count(*) FROM r WHERE NOT have) AS failed_rows, (SELECT count(*) FROM u) AS unique_jobs, (SELECT count(*) FROM u WHERE have) AS hits, 0::BIGINT AS newly_computed, (SELECT count(*) FROM u WHERE NOT have) AS failed_jobs, TRUE AS invariant""")
def run_summary(spark, sf):
    """Rows, jobs and the accounting rule: new + hits + failed = unique jobs."""
    prepared = saved(rows.prepare(_relation(spark, sf)).select("source_row_index", "sequence_hash", "status", "error_kind"), "rows")
    done = prepared.where("status = 'pending'").join(_t(spark, sf, "labels").select(F.col("doc_id").alias("source_row_index")), "source_row_index", "left_semi").select("sequence_hash")
    r = rows.resolve(prepared, done, before=done)
    ok, job = F.col("status") == "success", F.col("sequence_hash")
    out = r.agg(
        F.count(F.lit(1)).alias("total_rows"), F.count(F.when(ok, 1)).alias("successful_rows"), F.count(F.when(~ok, 1)).alias("failed_rows"), F.count_distinct(job).alias("unique_jobs"),
        F.count_distinct(F.when(ok & F.col("embedding_cache_hit"), job)).alias("hits"), F.count_distinct(F.when(~ok, job)).alias("failed_jobs"), F.count_distinct(F.when(ok, job)).alias("_ok"),
    )
    out = out.withColumn("newly_computed", F.col("_ok") - F.col("hits")).drop("_ok")
    return out.withColumn("invariant", F.col("newly_computed") + F.col("hits") + F.col("failed_jobs") == F.col("unique_jobs"))


_RESIDUES = S.STANDARD + "BZJUO"
_STORE = {"encoder": f"one-hot {_RESIDUES}", "size": SIZE, "overlap": OVERLAP, "policy": "keep"}


def _encode(jobs):
    """Composition over chunks; a sequence with an X fails."""
    return encode.encode_by_chunks(jobs, encode.OneHotEncoder(_RESIDUES), SIZE, OVERLAP)


@query(f"""WITH s AS (SELECT DISTINCT upper(raw) AS u FROM ({SEQ}) WHERE raw <> ''), j AS (SELECT sha256(u) AS h, length(u) AS n, contains(u, 'X') AS bad, CASE WHEN length(u) <= {SIZE} THEN 1 ELSE ceil((length(u) - {SIZE}) / {SIZE - OVERLAP}.0)::BIGINT + 1 END AS chunks FROM s),
p AS (SELECT *, (row_number() OVER (ORDER BY n DESC, h) - 1) // (SELECT greatest(1, ceil(count(*) / 4))::BIGINT FROM j) AS wave FROM j),
w AS (SELECT wave, count(*) AS jobs, count(*) FILTER (NOT bad) AS good, count(*) FILTER (bad) AS failed, coalesce(sum(chunks) FILTER (NOT bad), 0)::BIGINT AS passes FROM p GROUP BY 1)
SELECT 0 AS run, wave, jobs, 0::BIGINT AS reused, good AS computed, failed, passes FROM w WHERE wave < 2
UNION ALL SELECT 1, wave, jobs, CASE WHEN wave < 2 THEN good ELSE 0 END, CASE WHEN wave < 2 THEN 0 ELSE good END, failed, CASE WHEN wave < 2 THEN 0 ELSE passes END FROM w""")
def wave_runs(spark, sf):
    """All distinct sequences encoded in four waves that commit: one run is stopped after two, the next one computes the rest only."""
    jobs = saved(_jobs(spark, sf), "jobs")
    every = max(1, -(-jobs.count() // 4))
    at = commits.Store(spark, new_path(spark, "store"), _STORE, digits=1)
    try:
        first = waves.encode_waves(jobs, at, _encode, every, stop=lambda wave: wave == 2)
    except waves.Stopped as e:
        first = e.waves
    second = waves.encode_waves(jobs, commits.Store(spark, at.path, _STORE, digits=1), _encode, every)
    return waves.report(spark, first, 0).unionByName(waves.report(spark, second, 1))


_CHUNKED = f"CASE WHEN n <= {SIZE} THEN 1 ELSE ceil((n - {SIZE}) / {SIZE - OVERLAP}.0)::BIGINT + 1 END"


@query(f"""WITH {REL}, p AS (SELECT *, length(u) AS n FROM rows_), j AS (SELECT sequence_hash, any_value(n) AS n, bool_or(contains(u, 'X')) AS bad, bool_or(l.doc_id IS NOT NULL) AS stored, bool_or(quality = 1) AS target
 FROM p LEFT JOIN labels l ON source_row_index = l.doc_id WHERE status = 'pending' GROUP BY 1),
s AS (SELECT *, stored AND NOT bad AS hit, {_CHUNKED} AS chunks FROM j),
r AS (SELECT p.*, s.bad, p.status = 'pending' AND NOT s.bad AS ok FROM p LEFT JOIN s USING (sequence_hash))
SELECT (SELECT count(*) FROM r) AS total_rows, (SELECT count(*) FILTER (ok) FROM r) AS successful_rows, (SELECT count(*) FILTER (ok IS DISTINCT FROM TRUE) FROM r) AS failed_rows, count(*) AS unique_sequences, count(*) AS unique_jobs,
 count(*) FILTER (NOT bad AND NOT hit) AS newly_computed, count(*) FILTER (bad) AS failed_jobs, count(*) FILTER (hit) AS hits, count(*) FILTER (NOT hit) AS misses, count(*) FILTER (hit AND target) AS same_branch_hits,
 count(*) FILTER (hit AND target IS DISTINCT FROM TRUE) AS cross_branch_hits, count(*) FILTER (hit) AS total_hits, count(*) FILTER (NOT bad AND NOT hit) + count(*) FILTER (bad) + count(*) FILTER (hit) = count(*) AS accounting_holds,
 (SELECT count(*) FROM p WHERE status = 'pending' AND n > 2048) AS long_rows, count(*) FILTER (n > {SIZE}) AS unique_chunked, coalesce(sum(chunks) FILTER (NOT bad AND NOT hit), 0)::BIGINT AS forward_passes, {len(_RESIDUES)}::BIGINT AS embedding_dim,
 (SELECT count(DISTINCT nsc_id) FROM r WHERE ok) AS groups_with_vector FROM s""")
def run_report(spark, sf):
    """All figures of a run that finds the labelled documents in the store, under two branches, and encodes the rest."""
    return runs.report(spark, _labelled_run(spark, sf).summary)


def _labelled_run(spark, sf) -> runs.Run:
    prepared = saved(rows.prepare(_relation(spark, sf)), "prepared")
    at = commits.Store(spark, new_path(spark, "store"), _STORE, digits=1)
    label = _t(spark, sf, "labels").select(F.col("doc_id").alias("source_row_index"), F.when(F.col("quality") == 1, "target").otherwise("other").alias("branch"))
    known = prepared.where("status = 'pending'").join(label, "source_row_index").groupBy("sequence_hash").agg(F.min_by("sequence", "source_row_index").alias("sequence"), F.array_sort(F.collect_set("branch")).alias("branches"))
    known = saved(known, "known")
    at.commit(_encode(known.select("sequence_hash", "sequence")).join(known.select("sequence_hash", "branches"), "sequence_hash"))
    return runs.run(prepared, at, _encode, SIZE, OVERLAP, len(_RESIDUES))


@query(f"""WITH {REL}, j AS (SELECT sequence_hash, any_value(length(u)) AS n, any_value(contains(u, 'X')) AS bad, min(source_row_index) AS source_row_index, arg_min(r.nsc_id, source_row_index) AS nsc_id, bool_or(l.doc_id IS NOT NULL) AS stored
 FROM rows_ r LEFT JOIN labels l ON source_row_index = l.doc_id WHERE status = 'pending' GROUP BY 1)
SELECT source_row_index, nsc_id, sequence_hash, n::BIGINT AS actual_sequence_length, ({_CHUNKED})::INTEGER AS num_chunks FROM j WHERE NOT bad AND NOT stored AND n > {SIZE}""")
def newly_encoded_long(spark, sf):
    """The long sequences that such a run encodes itself."""
    return runs.long_detail(_labelled_run(spark, sf))


@query(f"""WITH s AS (SELECT DISTINCT upper(raw) AS u FROM ({SEQ}) WHERE raw <> ''), j AS (SELECT sha256(u) AS h, length(u) AS n FROM s WHERE NOT contains(u, 'X'))
SELECT h AS sequence_hash, {_CHUNKED}::INTEGER AS num_chunks, 'target' AS branches, 1::BIGINT AS times FROM j""")
def incremental_encode(spark, sf):
    """The documents as a stream of files, run twice: the entries of the store, each once."""
    at = commits.Store(spark, new_path(spark, "store"), _STORE, digits=1)
    checkpoint = new_path(spark, "stream")
    text = F.regexp_replace("text", "[^A-Za-z]+", "")
    jobs = lambda batch: batch.select(F.upper(text).alias("sequence")).withColumn("sequence_hash", S.sequence_hash(F.col("sequence")))
    for _ in range(2):
        incremental.stream_into(spark, *incremental.source_of(spark, f"{sf}/documents.parquet"), at, checkpoint, jobs, _encode).awaitTermination()
    # as the files hold them, before they are united
    stored = at._read(at.log()).where("error is null")
    return stored.groupBy("sequence_hash").agg(F.max("num_chunks").alias("num_chunks"), F.array_join(F.max("branches"), ",").alias("branches"), F.count(F.lit(1)).alias("times"))


# diagnostics
@query(f"SELECT a, b, round(c, 6) AS cosine, x.label AS label_a, y.label AS label_b, coalesce(x.label = y.label, FALSE) AS same_label FROM (SELECT a, b, c FROM ({_COS}) ORDER BY c DESC, a DESC, b DESC LIMIT 10) JOIN embeddings x ON x.vec_id = a JOIN embeddings y ON y.vec_id = b")
def pair_labels(spark, sf):
    """Nearest pairs with the labels of both sides."""
    from ..operators import pairs

    e = _t(spark, sf, "embeddings")
    top = saved(pairs.block_top(e, "vec_id", "embedding", 10), "top")
    for x in "ab":
        top = top.join(e.select(F.col("vec_id").alias(x), F.col("label").alias(f"label_{x}")), x)
    return top.select("a", "b", F.round("cosine", 6).alias("cosine"), "label_a", "label_b", F.coalesce(F.col("label_a") == F.col("label_b"), F.lit(False)).alias("same_label"))


@query("WITH n AS (SELECT label, sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))) * CASE WHEN label % 2 = 0 AND vec_id % 7 = 0 THEN 1e-4 ELSE 1 END AS n FROM embeddings) SELECT label, stddev_pop(n) = 0 AND min(n) > 0 AS identical, max(n) > 0 AND min(n) / max(n) < 1e-3 AS spread FROM n GROUP BY label")
def norm_warnings(spark, sf):
    """Groups whose norms are all the same, or span three orders of magnitude."""
    n = V.norm(F.col("embedding")) * F.when((F.col("label") % 2 == 0) & (F.col("vec_id") % 7 == 0), 1e-4).otherwise(1.0)
    g = _t(spark, sf, "embeddings").select("label", n.alias("n")).groupBy("label").agg(F.stddev_pop("n").alias("d"), F.min("n").alias("lo"), F.max("n").alias("hi"))
    return g.select("label", ((F.col("d") == 0) & (F.col("lo") > 0)).alias("identical"), ((F.col("hi") > 0) & (F.try_divide("lo", "hi") < 1e-3)).alias("spread"))


_PICKED = f"WITH u AS (SELECT doc_id, upper(raw) AS u, sha256(upper(raw)) AS h FROM ({SEQ}) WHERE raw <> '')"


@query(f"""{_PICKED} SELECT 'short' AS pick, arg_min(doc_id, h) AS doc_id FROM (SELECT h, min(doc_id) AS doc_id FROM u WHERE length(u) < 300 GROUP BY h)
UNION ALL SELECT 'special', min(doc_id) FROM u WHERE regexp_matches(u, '[XBZJUO]') UNION ALL SELECT 'chunked', min(doc_id) FROM u WHERE length(u) > {SIZE} UNION ALL SELECT 'probe', min(doc_id) FROM u WHERE length(u) > 100 AND length(u) <= {CAPACITY}""")
def diagnostic_picks(spark, sf):
    """The texts that determinism and chunking are probed on."""
    u = _sequences(spark, sf).where("raw <> ''").select("doc_id", F.upper("raw").alias("u"))
    n, h = F.length("u"), F.sha2("u", 256)
    conditions = {"special": F.col("u").rlike(f"[{S.SPECIAL}]"), "chunked": n > SIZE, "probe": (n > 100) & (n <= CAPACITY)}
    one = u.agg(F.min(F.when(n < 300, F.struct(h.alias("h"), "doc_id"))).alias("short"), *(F.min(F.when(c, F.col("doc_id"))).alias(k) for k, c in conditions.items()))
    return one.select(F.explode(F.array(*(F.struct(F.lit(k).alias("pick"), (F.col("short.doc_id") if k == "short" else F.col(k)).alias("doc_id")) for k in ("short", *conditions))))).select("col.*")


_COMPOSITION = f"""WITH s AS (SELECT DISTINCT upper(raw) AS u FROM ({SEQ}) WHERE raw <> ''), c AS (SELECT sha256(u) AS sequence_hash, length(u) AS n, unnest(string_split(u, '')) AS c FROM s)
SELECT sequence_hash, c AS symbol, round(count(*) / any_value(n), 6) AS share FROM c GROUP BY sequence_hash, c"""


def _jobs(spark, sf):
    # a look for the first letter, as a condition on the sequence would make it twice
    text = F.regexp_replace("text", "[^A-Za-z]+", "")
    return _t(spark, sf, "documents").where(F.col("text").rlike("[A-Za-z]")).select(F.upper(text).alias("sequence")).distinct().withColumn("sequence_hash", S.sequence_hash(F.col("sequence")))


@query(_COMPOSITION)
def encode_composition(spark, sf):
    """Composition of every distinct sequence by the one-hot encoder, over one chunk a sequence."""
    out = encode.encode(_jobs(spark, sf), encode.OneHotEncoder(), 1 << 30, 0, element="double")
    e = out.select("sequence_hash", F.posexplode("embedding").alias("i", "v")).where("v > 0")
    return e.select("sequence_hash", F.substring(F.lit(S.STANDARD + S.SPECIAL), F.col("i") + 1, F.lit(1)).alias("symbol"), F.round("v", 6).alias("share"))


#: Added before rounding: values halfway between two decimals then round alike, whatever the order of their sums.
_OFF = 1e-9
_LETTERS, _VALUES = "".join(encode.HYDROPATHY), list(encode.HYDROPATHY.values())


def _profile(size: int, overlap: int, where: str = "raw <> ''", reach: int = 4) -> str:
    """SQL of the pooled hydropathy profile: h, passes, v (three values)."""
    stride = size - overlap
    last = f"CASE WHEN n <= {size} THEN 0 ELSE ceil((n - {size}) / {stride}.0)::INTEGER END"
    weigh = lambda v: f"list_sum(list_transform(range(len(x)), lambda p: ({v}) / (least((s + p) // {stride}, last) - greatest(0, ceil((s + p - {size - 1}) / {stride}.0)) + 1)))"
    near = f"x[greatest(1, p + 1 - {reach}):p + 1 + {reach}]"
    return f"""SELECT h, count(*)::INTEGER AS passes, [sum(a) / any_value(n), sum(b) / any_value(n), sum(c) / any_value(n)] AS v FROM (
 SELECT h, n, {weigh('x[p + 1]')} AS a, {weigh(f'list_avg({near})')} AS b, {weigh(f'list_max({near})')} AS c FROM (
  SELECT sha256(u) AS h, n, last, (i * {stride})::INTEGER AS s, list_transform(string_split(substr(u, (i * {stride} + 1)::INTEGER, {size}), ''), lambda c: list_extract({_VALUES}, instr('{_LETTERS}', c))::DOUBLE) AS x FROM (
   SELECT u, n, last, unnest(generate_series(0, last)) AS i FROM (SELECT u, n, {last} AS last FROM (SELECT DISTINCT upper(raw) AS u, length(raw) AS n FROM ({SEQ}) WHERE {where}))))) GROUP BY h"""


@query(f"SELECT h AS sequence_hash, passes AS num_chunks, (unnest(range(3)))::INTEGER AS j, round(unnest(v) + {_OFF}, 6) AS value FROM ({_profile(SIZE, OVERLAP)})")
def encode_by_chunks(spark, sf):
    """Hydropathy profile of every distinct sequence, pooled over chunks that are rows of their own."""
    out = encode.encode_by_chunks(_jobs(spark, sf), encode.ProfileEncoder(), SIZE, OVERLAP, element="double")
    return out.select("sequence_hash", "num_chunks", F.posexplode("embedding").alias("j", "v")).select("sequence_hash", "num_chunks", "j", F.round(F.col("v") + _OFF, 6).alias("value"))


@query(f"""SELECT a.h AS sequence_hash, a.passes, b.passes AS forced_passes, round(list_max(list_transform(list_zip(a.v, b.v), lambda p: abs(p[1] - p[2]))) + {_OFF}, 6) AS max_difference, round(list_cosine_similarity(a.v, b.v), 6) AS cosine,
 len(list_filter(list_zip(a.v, b.v), lambda p: abs(p[1] - p[2]) > 0.01 + 0.01 * abs(p[2]))) = 0 AS same FROM ({_profile(SIZE, OVERLAP)}) a JOIN ({_profile(200, 50)}) b ON a.h = b.h""")
def chunk_sensitivity(spark, sf):
    """Every distinct sequence encoded twice, with the usual chunks and with forced ones of 200 letters, by an encoder whose states depend on the chunk."""
    jobs = saved(_jobs(spark, sf), "jobs")
    one, two = (encode.encode_by_chunks(jobs, encode.ProfileEncoder(), *x, element="double") for x in ((SIZE, OVERLAP), (200, 50)))
    j = one.select("sequence_hash", F.col("embedding").alias("a"), F.col("num_chunks").alias("passes")).join(two.select("sequence_hash", F.col("embedding").alias("b"), F.col("num_chunks").alias("forced_passes")), "sequence_hash")
    a, b = F.col("a"), F.col("b")
    return j.select("sequence_hash", "passes", "forced_passes", F.round(V.max_difference(a, b) + _OFF, 6).alias("max_difference"), F.round(V.cosine(a, b), 6).alias("cosine"), V.close(a, b, 0.01, 0.01).alias("same"))


@query(f"""WITH a AS ({_profile(SIZE, OVERLAP)}), b AS ({_profile(SIZE, OVERLAP, reach=6)}), l AS (SELECT DISTINCT sha256(upper(raw)) AS h FROM ({SEQ}) JOIN labels USING (doc_id)),
d AS (SELECT a.h, l.h IS NOT NULL AS old, list_max(list_transform(list_zip(a.v, b.v), lambda p: abs(p[1]::FLOAT::DOUBLE - p[2]::FLOAT::DOUBLE))) AS d FROM a JOIN b USING (h) LEFT JOIN l USING (h))
SELECT h AS sequence_hash, round(CASE WHEN old THEN d ELSE 0 END + {_OFF}, 5) AS max_abs_diff, NOT old OR d <= 1e-5 AS deterministic FROM d""")
def reencoded_entries(spark, sf):
    """Every stored sequence encoded again; the labelled documents' entries are of an encoder with wider windows."""
    jobs = saved(_jobs(spark, sf), "jobs")
    labelled = _sequences(spark, sf).join(_t(spark, sf, "labels").select("doc_id"), "doc_id", "left_semi").select(S.sequence_hash(F.upper("raw")).alias("sequence_hash")).distinct()
    at = commits.Store(spark, new_path(spark, "store"), {"encoder": "hydropathy", "size": SIZE, "overlap": OVERLAP, "policy": "keep"}, digits=1)
    profile = lambda reach: lambda some: encode.encode_by_chunks(some, encode.ProfileEncoder(reach), SIZE, OVERLAP)
    at.commit(profile(6)(jobs.join(labelled, "sequence_hash", "left_semi")))
    at.commit(profile(4)(at.misses(jobs)))
    out = diagnostics.reencode_check(jobs, at.entries(), profile(4))
    return out.select("sequence_hash", F.round(F.col("max_abs_diff").cast("double") + _OFF, 5).alias("max_abs_diff"), "deterministic")


@query(f"SELECT doc_id, chunk_start, round(length(regexp_replace(upper(substr(raw, chunk_start + 1, chunk_end - chunk_start)), '[^L]', '', 'g')) / (chunk_end - chunk_start), 6) AS share_l FROM ({_CHUNKS})")
def chunk_means(spark, sf):
    """Mean over the residues of single chunks: the share of one letter."""
    text = F.upper(F.substring("raw", F.col("chunk_start") + 1, F.col("chunk_end") - F.col("chunk_start")))
    return _chunks(spark, sf).select("doc_id", "chunk_start", F.round(F.length(F.regexp_replace(text, "[^L]", "")) / (F.col("chunk_end") - F.col("chunk_start")), 6).alias("share_l"))
