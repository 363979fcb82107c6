"""A corpus pipeline of five stages over ``documents``.

Quality rules and language identification drop what they reject, one document of each
near-duplicate class stays, mixing thins domains to their target weights, and packing
cuts what is left into token sequences. Each stage works on all rows of the one before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import langid, minhash, mixing, packing, quality, tokens
from .common import written

#: Length of packed sequences.
SEQUENCE = 1024

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Words of a shingle and percent of the union from which two documents are near duplicates.
NEAR_WORDS, NEAR_PERCENT = 5, 80
#: Posterior from which a predicted language counts as certain enough.
LEAST_SCORE = 0.5
#: Token shares after mixing. Only prose has a target, so no scarce domain sets how much stays.
MIXTURE = {"prose": 1.0, "toxic": 0.0, "noise": 0.0}
#: Posterior of prose from which a document stays whatever its rate.
CLEAN = 0.5


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the likelihood ratio.

    Null and empty texts have no words and go. Rows that repeat are judged alike, each on
    its own. Columns other than those of documents are dropped. An empty table stays empty.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.quality_rules(docs, labels).where("verdict.kept").select(*COLUMNS)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is one of the learned ones, by their text alone.

    Null texts and texts without a letter have no language and go; so do all where no row
    has a language to learn from. Rows that repeat are judged alike, each on its own.
    """
    found = langid.predict(docs, langid.fit(docs, ~langid.held_out()))
    known = (F.col("language.lang_pred") != langid.UNKNOWN) & (F.col("language.score") >= LEAST_SCORE)
    return found.where(known).select(*COLUMNS)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest document of each near-duplicate class.

    Rows that share a key count as one document: they stay or go together. Rows with a
    null key and rows without words stay. An empty table stays empty.
    """
    gone = minhash.near_duplicates(docs, words=NEAR_WORDS, percent=NEAR_PERCENT).where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*COLUMNS)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Clean documents whole, others thinned to the target weights; none repeats.

    Rows that repeat key and text stay or go together. Null and empty texts have the
    posteriors of a document without any counted word, clean if most labelled rows are.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return mixing.mix(docs, labels, MIXTURE, most=1.0).where((F.col("mix.copies") > 0) | (F.col("mix.posteriors")[0] >= CLEAN)).select(*COLUMNS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences; each row is a document, null and empty texts are their end id alone."""
    return packing.pack(docs, tokens.default_vocabulary(), SEQUENCE, end_id=0)


STAGES = [
    ("quality", quality_stage),
    ("language", language_stage),
    ("near_duplicates", dedup_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: SQL can't express hashed n-grams, gradient steps or a tokenizer; tests hold brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written as Parquet in the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
