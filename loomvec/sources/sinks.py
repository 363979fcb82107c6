"""Writers of artifacts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.order import numbered_ids
from ..operators.scratch import saved

#: Columns of the row provenance, in order. Fixed values.
PROVENANCE = [
    "source_row_index", "nsc_id", "drug_name", "chembl_id", "target_id", "gene_symbol", "uniprot_id", "sequence_length", "actual_sequence_length",
    "sequence_length_mismatch", "sequence_hash", "embedding_cache_hit", "num_chunks", "special_residue_events", "embedding_l2_norm", "status", "error",
]


def provenance(rows: DataFrame) -> DataFrame:
    """The provenance columns (null where absent), then all others in input order but the sequence."""
    absent = {c: F.lit(None).cast("string") for c in PROVENANCE if c not in rows.columns}
    return rows.withColumns(absent).select(*PROVENANCE, *rows.drop("sequence", *PROVENANCE).columns)


def row_payload(rows: DataFrame) -> DataFrame:
    """Rows as they are reported: ``error`` is the error, else the warning, else empty; events are JSON text, empty without any."""
    error = F.coalesce(*(F.col(c) for c in ("error", "warning") if c in rows.columns), F.lit(""))
    events = F.when(F.size("special_residue_events") > 0, F.to_json("special_residue_events", {"ignoreNullFields": "false"})).otherwise("")
    chunks = F.coalesce(F.col("num_chunks"), F.lit(0)) if "num_chunks" in rows.columns else F.lit(0)
    return provenance(rows.withColumns({"error": error, "special_residue_events": events, "num_chunks": chunks.cast("int")}).drop("warning"))


def row_vectors(rows: DataFrame, index: str, valid: Column) -> DataFrame:
    """All rows with ``row_valid`` and ``vector_index``, which counts valid rows from 0 in order of ``index`` (else null): no placeholder vectors."""
    kept = numbered_ids(rows.where(valid).select(index), index, "_n").select(index, (F.col("_n") - 1).alias("vector_index"))
    return rows.join(kept, index, "left").withColumn("row_valid", F.col("vector_index").isNotNull())


def write_artifacts(folder: str, rows: DataFrame, vectors: DataFrame, groups: DataFrame, group_vectors: DataFrame, entries: DataFrame | None = None) -> None:
    """All artifacts of a run: row and group provenance (CSV), failed rows (CSV), row and group vectors and entries (Parquet).

    The payload of the rows is computed once; both files of rows are written from it. They
    are compressed: events as JSON are many times as long as the text they are of.
    """
    payload = saved(row_payload(rows), "payload")
    write_csv(payload, f"{folder}/rows", "gzip")
    write_csv(payload.where("status = 'failed'").select(*PROVENANCE), f"{folder}/failed_rows", "gzip")
    write_csv(groups, f"{folder}/groups")
    vectors.write.mode("overwrite").parquet(f"{folder}/row_vectors")
    group_vectors.write.mode("overwrite").parquet(f"{folder}/group_vectors")
    if entries is not None:
        entries.write.mode("overwrite").parquet(f"{folder}/entries")


def write_audit_package(folder: str, rows: DataFrame, valid: Column, vector: str, groups: DataFrame, group_vectors: DataFrame, settings: dict) -> None:
    """What an auditor needs of a run, as tables of ``folder``.

    ``row_embeddings`` has the vectors of valid rows only, by ``vector_index`` with the row's
    index; ``row_metadata`` all rows with ``row_valid``, without sequences and vectors;
    ``group_embeddings``, ``group_metadata`` and ``settings`` (field, value as text) the rest.
    """
    indexed = saved(row_vectors(rows, "source_row_index", valid), "indexed")
    compact = indexed.where("row_valid").select("vector_index", "source_row_index", F.col(vector).alias("embedding"))
    compact.write.mode("overwrite").parquet(f"{folder}/row_embeddings")
    indexed.drop(vector, "sequence", "vector_index").write.mode("overwrite").parquet(f"{folder}/row_metadata")
    group_vectors.write.mode("overwrite").parquet(f"{folder}/group_embeddings")
    groups.write.mode("overwrite").parquet(f"{folder}/group_metadata")
    fields = [(k, None if v is None else str(v)) for k, v in sorted(settings.items())]
    rows.sparkSession.createDataFrame(fields, "field string, value string").coalesce(1).write.mode("overwrite").parquet(f"{folder}/settings")


def write_csv(frame: DataFrame, path: str, compression: str = "none") -> None:
    """Text files with a header; null becomes an empty field, booleans True and False, quotes are doubled. Readers tell ``compression`` by the files' names."""
    shown = [F.initcap(F.col(c).cast("string")).alias(c) if t == "boolean" else F.col(c) for c, t in frame.dtypes]
    frame.select(*shown).write.mode("overwrite").options(header=True, emptyValue="", nullValue="", escape='"', compression=compression).csv(path)


def wide(frame: DataFrame, vector: str, dim: int, prefix: str = "emb") -> DataFrame:
    """One column for each element of a vector."""
    return frame.select(*(c for c in frame.columns if c != vector), *(F.try_element_at(F.col(vector), F.lit(i + 1)).alias(f"{prefix}_{i + 1}") for i in range(dim)))
