"""Quality rules: counts of a text, and a hashed n-gram log-likelihood ratio.

Two multinomials over hashed n-grams are counted: one over all documents (raw), one
over trusted documents (target). A document's score is the mean over its n-grams of
log p_target - log p_raw; it is kept from a fixed threshold on. All on DataFrame
functions; the ratio table has a fixed number of buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD_CHAR, free_name, let, table_of, word_list

#: log2 of the number of buckets.
BUCKET_BITS = 17
#: Added to the count of every bucket, in both multinomials.
SMOOTHING = 0.5
#: Mean log-likelihood ratio in nats from which a document is kept.
THRESHOLD = -0.5
#: Trusted documents that are counted at most: those with the smallest hash of their key.
TRUSTED_MOST = 100_000
#: Characters that count as symbols. Fixed values.
SYMBOLS = "[#*$%&|<>]"
#: A text with fewer words, or with a larger percentage of words in repeated windows, fails.
LEAST_WORDS, REPEAT_PERCENT = 50, 50
#: An n-gram is of runs of letters and runs of other characters that aren't white space.
RUNS = "\\p{L}+|[^\\p{L} \\t\\n\\x0B\\f\\r]+"


def base_counts(text: Column) -> dict[str, Column]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text; 0 for null."""
    whole = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda x: x.rlike(WORD_CHAR))
    # of the words, three counts as one value, so that they are split once
    counts = let(
        word_list(text),
        lambda words: F.struct(
            F.size(words).cast("long").alias("n"),
            F.aggregate(words, F.lit(0).cast("long"), lambda a, w: a + F.length(w)).alias("chars"),
            let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: let(_windows(h), _covered)).cast("long").alias("r"),
        ),
    )
    return {
        "word_counts": counts,
        "n_symbols": (F.length(whole) - F.length(F.regexp_replace(whole, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
    }


def _windows(words: Column) -> Column:
    """Hashes of all windows of three words, from hashes of the words."""
    return F.transform(F.slice(words, 1, F.greatest(F.size(words) - 2, F.lit(0))), lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))


def _covered(windows: Column) -> Column:
    """Words in windows that occur twice or more: sort windows with their places, find equal neighbours."""

    def places(s: Column) -> Column:
        twice = F.filter(s, lambda x, i: (x["h"] == F.get(s, i - 1)["h"]) | (x["h"] == F.get(s, i + 1)["h"]))
        return F.size(F.array_distinct(F.flatten(F.transform(twice, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))))

    again = let(F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), places)
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), 0).otherwise(again)


def _run_hashes(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(RUNS), F.lit(0)), lambda x: F.xxhash64(x))


def _bigrams(h: Column) -> Column:
    """Hashes of neighbours; the last run is paired with none."""
    return F.transform(h, lambda x, i: F.xxhash64(x, F.get(h, i + 1)))


def _bucket(h: Column, bits: int) -> Column:
    return h.bitwiseAND(F.lit((1 << bits) - 1))


def ngram_buckets(text: Column, bits: int = BUCKET_BITS) -> Column:
    """Buckets of all unigrams and bigrams; empty for null."""
    return let(_run_hashes(text), lambda h: F.transform(F.concat(h, _bigrams(h)), lambda x: _bucket(x, bits).cast("int")))


def trusted_sample(labels: DataFrame, most: int = TRUSTED_MOST, key: str = "doc_id") -> DataFrame:
    """Keys of documents labelled good and not toxic, at most ``most`` of them."""
    good = labels.where((F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0) & F.col(key).isNotNull())
    return good.select(F.col(key).cast("long").alias("trusted")).distinct().orderBy(F.xxhash64("trusted"), "trusted").limit(most)


def fit_ratio(docs: DataFrame, trusted: DataFrame, bits: int = BUCKET_BITS, smoothing: float = SMOOTHING, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row with ``ratios``: log p_target - log p_raw of every bucket.

    Counts cover the n-grams of all documents. With no trusted document every ratio is
    that of two even multinomials as far as the target goes; with no document at all, 0.
    """
    size = 1 << bits
    flagged = docs.select(F.col(key).cast("long").alias("_key"), F.col(text).alias("_text")).join(
        F.broadcast(trusted), F.col("_key") == F.col("trusted"), "left"
    )
    counts = (
        flagged.select(F.col("trusted").isNotNull().cast("long").alias("good"), F.explode(ngram_buckets(F.col("_text"), bits)).alias("bucket"))
        .groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("raw"), F.sum("good").alias("target"))
    )
    dense = docs.sparkSession.range(0, size, 1, 4).select(F.col("id").cast("int").alias("bucket")).join(counts, "bucket", "left").na.fill(0, ["raw", "target"])
    one = dense.agg(F.sort_array(F.collect_list(F.struct("bucket", "raw", "target"))).alias("rows"), F.sum("raw").alias("n_raw"), F.sum("target").alias("n_target"))
    spread = size * smoothing
    ratio = F.transform(
        "rows",
        lambda r: (F.log((r["target"] + smoothing) / (F.col("n_target") + spread)) - F.log((r["raw"] + smoothing) / (F.col("n_raw") + spread))).cast("float"),
    )
    # zeros come from the rows: a literal array of them would stand in every plan's text, half a megabyte long
    zeros = F.transform("rows", lambda r: F.lit(0.0).cast("float"))
    return one.select(F.when(F.col("n_target") == 0, zeros).otherwise(ratio).alias("ratios"))


def mean_ratio(text: Column, ratios: Column, bits: int = BUCKET_BITS) -> Column:
    """Mean of the ratios of a document's n-grams; 0 without any."""

    def total(h: Column, m: Column) -> Column:
        return F.aggregate(h, F.lit(0.0), lambda a, x: a + F.get(m, _bucket(x, bits)))

    return let(ratios, lambda m: let(_run_hashes(text), lambda h: (total(h, m) + total(_bigrams(h), m)) / F.greatest(2 * F.size(h), F.lit(1))))


def judge(docs: DataFrame, ratios: DataFrame, threshold: float = THRESHOLD, bits: int = BUCKET_BITS, text: str = "text") -> DataFrame:
    """All columns of ``docs`` and a struct ``verdict``: the counts, ``base_failed``, ``score``, ``kept``.

    A null or empty text has counts of 0, fails the base rules and isn't kept. Rows
    stay as they are, repeated ones too; an input column named ``verdict`` is replaced.
    A text of any length is judged whole, in one row's arrays; an empty table gives no rows.
    """
    c = base_counts(F.col(text))
    name = free_name(docs, "_ratios")
    score = mean_ratio(F.col(text), F.col(name), bits)
    measured = F.struct(*(v.alias(k) for k, v in c.items()), score.alias("score"))
    out = docs.withColumn(name, table_of(ratios, "ratios", "ratios")).withColumn("verdict", measured).drop(name)
    v = F.col("verdict")
    n, r = v["word_counts"]["n"], v["word_counts"]["r"]
    failed = (n < LEAST_WORDS) | (100 * r > REPEAT_PERCENT * n)
    return out.withColumn(
        "verdict",
        F.struct(
            n.alias("n_words"), v["word_counts"]["chars"].alias("word_chars"), v["n_symbols"].alias("n_symbols"), v["n_dup_lines"].alias("n_dup_lines"), r.alias("n_repeat_words"),
            failed.alias("base_failed"), v["score"].alias("score"), (~failed & (v["score"] >= threshold)).alias("kept"),
        ),
    )


def quality_rules(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, bits: int = BUCKET_BITS) -> DataFrame:
    """``docs`` with ``verdict``, the ratios fitted on all of ``docs`` and the trusted rows of ``labels``."""
    return judge(docs, fit_ratio(docs, trusted_sample(labels), bits), threshold, bits)


