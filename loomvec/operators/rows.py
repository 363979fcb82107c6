"""Row preparation and the status machine; a failure is a row, not an exception."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import sequences as S


def prepare(rows: DataFrame, policy: str = "keep_if_supported", supported: str = S.SPECIAL) -> DataFrame:
    """Canonical id, cleaned sequence, hash, lengths and the status pending or failed."""
    got = rows.withColumn("_id", S.canonical_id(F.col("nsc_id"))).withColumn("_c", S.clean(F.col("sequence"), policy, supported))
    got = got.withColumn("_e", S.special_events(S.compact_upper(F.col("sequence")), S.replaced_symbols(policy, supported)))
    kind = F.when(F.col("_id").isNull(), "invalid_nsc").otherwise(F.col("_c.error_kind"))
    ok = kind.isNull()
    cleaned = F.when(ok, F.col("_c.cleaned"))
    if "special_residue_events" in rows.columns:
        got = got.drop("special_residue_events")
    got = got.withColumns({"nsc_id": F.coalesce("_id", F.lit("")), "sequence": cleaned, "error_kind": kind})
    got = got.withColumns({"sequence_hash": S.sequence_hash(F.col("sequence")), "actual_sequence_length": F.length("sequence").cast("long"), "status": F.when(kind.isNull(), "pending").otherwise("failed")})
    got = got.withColumn("special_residue_events", F.when(F.col("status") == "pending", F.col("_e")))
    if "sequence_length" in rows.columns:
        length = S.declared_length(F.col("sequence_length"), F.col("actual_sequence_length"))
        got = got.withColumn("_l", length).withColumns({"sequence_length": F.col("_l.declared"), "sequence_length_mismatch": F.col("_l.mismatch"), "warning": F.when(F.col("status") == "pending", F.col("_l.warning"))}).drop("_l")
    return got.drop("_id", "_c", "_e")


def unique_jobs(prepared: DataFrame) -> DataFrame:
    """The first pending row of every sequence: a partial aggregate, so a frequent sequence is no hot key.

    All columns of ``prepared`` travel with the row, so select what is needed before.
    """
    columns = [c for c in prepared.columns if c != "sequence_hash"]
    first = prepared.where("status = 'pending'").groupBy("sequence_hash").agg(F.min_by(F.struct(*columns), "source_row_index").alias("_r"))
    return first.select(*(F.col("sequence_hash") if c == "sequence_hash" else F.col(f"_r.{c}").alias(c) for c in prepared.columns))


def resolve(prepared: DataFrame, store: DataFrame, errors: DataFrame | None = None, before: DataFrame | None = None) -> DataFrame:
    """Statuses after encoding, from the store (sequence_hash, ...) and errors (sequence_hash, error, error_kind).

    ``before`` holds the hashes that the store had at the start: their first rows are hits.
    Other rows of an encoded sequence are hits too; those of a failed one weren't encoded.
    All that is known of a hash is one aggregate, joined once.
    """
    none = F.lit(None).cast("string")
    fact = lambda lead, have, had, error, kind: [F.col("sequence_hash"), lead.cast("long").alias("lead"), F.lit(have).alias("have"), F.lit(had).alias("had"), error.alias("error"), kind.alias("kind")]
    facts = prepared.where("status = 'pending'").select(*fact(F.col("source_row_index"), False, False, none, none)).unionByName(store.select(*fact(F.lit(None), True, False, none, none)))
    if before is not None:
        facts = facts.unionByName(before.select(*fact(F.lit(None), False, True, none, none)))
    if errors is not None:
        facts = facts.unionByName(errors.select(*fact(F.lit(None), False, False, F.col("error"), F.col("error_kind"))))
    known = facts.groupBy("sequence_hash").agg(F.min("lead").alias("_lead"), F.max("have").alias("_have"), F.max("had").alias("_had"), F.max("error").alias("_error"), F.max("kind").alias("_kind"))
    out = prepared.join(known.where("_lead is not null"), "sequence_hash", "left")
    pending, found, lead = F.col("status") == "pending", F.coalesce("_have", F.lit(False)), F.coalesce(F.col("source_row_index") == F.col("_lead"), F.lit(False))
    lost = F.coalesce("_had", F.lit(False))  # it was in the store and isn't any more
    kind = F.when(pending & ~found, F.when(lead & F.col("_kind").isNotNull(), F.col("_kind")).when(lost, "missing_embedding").otherwise("not_encoded")).otherwise(F.col("error_kind"))
    return out.withColumns(
        {
            "error": F.when(pending & ~found & lead & F.col("_error").isNotNull(), F.col("_error")).when(pending & ~found & lost, "the store has no vector of the sequence").when(pending & ~found & ~lead, "sequence was not encoded"),
            "error_kind": kind,
            "embedding_cache_hit": pending & found & (~lead | F.coalesce("_had", F.lit(False))),
            "status": F.when(pending, F.when(found, "success").otherwise("failed")).otherwise(F.col("status")),
        }
    ).drop("_lead", "_have", "_had", "_error", "_kind")


def statistics(prepared: DataFrame, long_from: int = 2048) -> DataFrame:
    """One row of counts over all rows and lengths over usable ones; blank ids don't count as distinct."""
    return prepared.agg(*scalars(long_from))


def scalars(long_from: int = 2048) -> list[Column]:
    usable = F.col("sequence").isNotNull()
    n = F.col("actual_sequence_length")
    return [
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct(F.nullif(F.col("nsc_id"), F.lit(""))).alias("unique_ids"),
        F.count_distinct("sequence_hash").alias("unique_sequences"),
        F.count(F.when(usable, 1)).alias("valid_rows"),
        F.count(F.when(F.col("status") == "failed", 1)).alias("failed_rows"),
        (F.count(F.when(usable, 1)) - F.count_distinct("sequence_hash")).alias("duplicate_rows"),
        F.min(n).alias("min_length"),
        F.max(n).alias("max_length"),
        F.avg(n).alias("mean_length"),
        F.count(F.when(n > long_from, 1)).alias("long_rows"),
        F.count(F.when(F.size("special_residue_events") > 0, 1)).alias("special_rows"),
    ]


def full_statistics(prepared: DataFrame, capacity: int, long_from: int = 2048) -> DataFrame:
    """All scalars of a prepared relation with names, targets and declared lengths; blank values don't count as distinct."""
    usable, n = F.col("sequence").isNotNull(), F.col("actual_sequence_length")
    many = lambda c: F.count_distinct(F.nullif(F.col(c), F.lit("")))
    over = lambda k: (F.count(F.when(n > k, 1)), F.count_distinct(F.when(n > k, F.col("sequence_hash"))))
    named = {"unique_drug_name": "drug_name", "unique_target_id": "target_id", "unique_uniprot_id": "uniprot_id"}
    (long_rows, long_unique), (cap_rows, cap_unique) = over(long_from), over(capacity)
    return prepared.agg(
            *scalars(long_from),
            *(many(c).alias(k) for k, c in named.items()),
            F.count(F.when(F.col("sequence_length_mismatch"), 1)).alias("length_mismatches"),
            F.count(F.when(usable & F.col("sequence_length").isNull(), 1)).alias("missing_lengths"),
            F.count(F.when(~usable, 1)).alias("missing_sequences"),
            long_unique.alias("long_unique"), cap_rows.alias("chunked_rows"), cap_unique.alias("chunked_unique"), F.lit(capacity).cast("long").alias("capacity"),
    )
