import hashlib

import pytest
from pyspark.sql import functions as F

from loomvec.functions import sequences as S
from loomvec.operators import encode, rows
from loomvec.sources import relation


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'long' if isinstance(v, int) else 'string'}" for k, v in values.items())).select(column.alias("x")).head()["x"]


@pytest.mark.parametrize("raw", ["740", "NSC-740", "NSC 740", "nsc740", " NSC-740 ", "nsc-0740"])
def test_ids(spark, raw):
    assert one(spark, S.canonical_id(F.col("v")), v=raw) == "NSC-740"


@pytest.mark.parametrize("raw", [None, "", "  ", "DRUG_ABC", "NSC-XYZ"])
def test_not_ids(spark, raw):
    assert one(spark, S.canonical_id(F.col("v")), v=raw) is None


@pytest.mark.parametrize(
    "length,size,overlap,plan",
    [(2439, 2046, 256, [(0, 2046), (1790, 2439)]), (2047, 2046, 256, [(0, 2046), (1790, 2047)]), (2439, 2046, 0, [(0, 2046), (2046, 2439)]), (0, 10, 2, []), (7, 10, 2, [(0, 7)])],
)
def test_chunk_plans(spark, length, size, overlap, plan):
    assert [tuple(x) for x in one(spark, S.chunk_plan(F.col("n"), size, overlap), n=length)] == plan


def test_policies(spark):
    def of(raw, policy, supported):
        return one(spark, S.clean(F.col("v"), policy, supported), v=raw)

    assert of(" ac\td u", "replace_with_X", "X")["cleaned"] == "ACDX"
    assert of("ACDU", "keep_if_supported", "X")["error_kind"] == "unsupported_residue"
    assert of("ACD*U", "error", "XU")["error_position"] == 3
    assert of("", "error", "X")["error_kind"] == "invalid_sequence"


def test_rows_and_profile(spark, tmp_path):
    protein = lambda n, seed: "".join("ACDEFGHIKLMNPQRSTVWY"[(7 * i + seed) % 20] for i in range(n))
    path = tmp_path / "in.csv"
    lines = [("NSC-606869", protein(2286, 3), 2286), ("NSC-613327", protein(2286, 3), 2286), ("NSC-24559", protein(2439, 5), 2439), ("NSC-92859", protein(400, 7), 400), ("NSC-11111", protein(120, 11), 999), ("NSC-11111", "ACD*EFG", 7)]
    path.write_text("NSC_ID,Sequence,sequence_length\n" + "".join(",".join(map(str, x)) + "\n" for x in lines))
    prepared = rows.prepare(relation.read_csv(spark, str(path)))
    got = rows.statistics(prepared).head()
    assert (got["rows"], got["failed_rows"], got["unique_sequences"], got["long_rows"]) == (6, 1, 4, 3)
    assert prepared.where("sequence_length_mismatch and status = 'pending'").count() == 1
    done = encode.encode(rows.unique_jobs(prepared), encode.AlphabetEncoder(), 2046, 256)
    assert sorted(r["num_chunks"] for r in done.collect()) == [1, 1, 2, 2]
    assert rows.resolve(prepared, done).where("status = 'success'").count() == 5
    first = prepared.where("source_row_index = 0").head()["sequence_hash"]
    assert first == hashlib.sha256(protein(2286, 3).encode()).hexdigest()


def test_missing_column(spark, tmp_path):
    (tmp_path / "x.csv").write_text("nsc_id,drug_name\n1,a\n")
    with pytest.raises(relation.InputError, match="sequence"):
        relation.read_csv(spark, str(tmp_path / "x.csv"))
