"""Audit of how filters interact, in every order of application, from 2^n joint counts.

For every set of filters one aggregate counts the rows that fail all of them: a sum of
products of flags. Everything else follows by inclusion and exclusion (Moebius inversion
over subsets) from those counts: who survives a prefix of an order, what a filter removes
there, what only it removes, and its Shapley value, as the sum of Harsanyi dividends.
"""

from __future__ import annotations

from functools import reduce
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_RUN, let, written


def sign(subset: Column) -> Column:
    """1 for a set of even size, -1 for one of odd size."""
    return 1 - 2 * (F.bit_count(subset) % 2)


def joint_counts(rows: DataFrame, part: str, filters: list[str], marks: dict[str, str]) -> DataFrame:
    """For each part an array of 2^n counts: of all rows, and of each mark's, that fail every filter of the set.

    Bit i of an array's index stands for filter i; index 0 counts all rows. A null flag or
    mark counts as false. Partial sums, so a part of any size is no hot key.
    """
    flag = {f: F.coalesce(F.col(f), F.lit(False)).cast("long") for f in [*filters, *marks.values()]}

    def sums(base: Column) -> Column:
        products = [reduce(lambda x, y: x * y, [flag[f] for i, f in enumerate(filters) if s >> i & 1], base) for s in range(1 << len(filters))]
        return F.array(*map(F.sum, products))

    return rows.groupBy(part).agg(sums(F.lit(1).cast("long")).alias("joint"), *(sums(flag[c]).alias(m) for m, c in marks.items()))


def audit(rows: DataFrame, part: str, filters: list[str], marks: dict[str, str]) -> DataFrame:
    """One row for each part, order of the filters and step.

    ``filters`` are columns of one letter each that are true where a row fails; ``marks``
    name further counts of rows that a step removes, by a boolean column. Columns: part,
    filter_order, step, kept, removed, redundant, unique_fails, the marks, shapley. Parts
    are those that occur; an empty table gives no rows. Other columns are not used.
    """
    n = len(filters)
    if not 1 <= n <= 6 or any(len(f) != 1 for f in filters) or len(set(filters)) != n:
        raise ValueError("one to six filters with different names of one letter are needed")
    orders = list(permutations(range(n)))
    names = F.array(*(F.lit("".join(filters[i] for i in o)) for o in orders))
    before = F.array(*(F.lit(sum(1 << i for i in o[:k])) for o in orders for k in range(n)))
    own = F.array(*(F.lit(1 << o[k]) for o in orders for k in range(n)))
    subsets, whole = F.sequence(F.lit(0), F.lit((1 << n) - 1)), F.lit((1 << n) - 1)

    def inverted(counts: str, inside: Column, always: Column) -> Column:
        """Rows that fail all of ``always`` and none of ``inside``."""
        return F.aggregate(
            subsets, F.lit(0).cast("long"), lambda a, s: a + F.when(s.bitwiseAND(inside) == s, sign(s) * F.get(F.col(counts), s.bitwiseOR(always))).otherwise(0)
        )

    at = joint_counts(rows, part, filters, marks).withColumn("_at", F.explode(F.sequence(F.lit(0), F.lit(len(orders) * n - 1))))
    at = at.withColumns({"_before": F.get(before, F.col("_at")), "_own": F.get(own, F.col("_at"))})
    p, f, fails = F.col("_before"), F.col("_own"), F.get("joint", F.col("_own"))
    removed = inverted("joint", p, f)
    dividends = F.aggregate(
        subsets, F.lit(0).cast("long"), lambda a, s: a + F.when(s.bitwiseAND(f) != 0, -sign(s) * F.get("joint", s) * (F.lit(factorial(n)).cast("long") / F.bit_count(s)).cast("long")).otherwise(0)
    )
    steps = at.select(
        part, F.get(names, F.floor(F.col("_at") / n).cast("int")).alias("filter_order"), (F.col("_at") % n + 1).cast("int").alias("step"),
        inverted("joint", p.bitwiseOR(f), F.lit(0)).alias("kept"), removed.alias("removed"), (fails - removed).alias("redundant"),
        inverted("joint", whole - f, f).alias("unique_fails"), *(inverted(m, p, f).alias(m) for m in marks), dividends.alias("shapley"),
    )
    return steps


def text_failures(text: Column) -> dict[str, Column]:
    """Failure conditions A to D of a whole text (null: empty)."""
    text = F.coalesce(text, F.lit(""))
    words = F.array_remove(F.split(text, SPACE_RUN), "")
    few = let(words, lambda w: F.struct((F.size(w) < 200).alias("A"), (100 * F.size(F.array_distinct(w)) < 50 * F.size(w)).alias("B")))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {"few": few, "C": 100 * capitals.cast("long") > 3 * F.length(text), "D": text.rlike("[#$%&*|]")}


def audit_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``audit`` of five filters on documents (doc_id, text, lang), by language, with losses by labels.

    A: below 200 words; B: fewer than half of the words distinct; C: over 3 percent of the
    characters capitals; D: holds one of ``#$%&*|``; E: the text is that of a smaller
    doc_id anywhere in the table. A null text is empty, a null language the part ``""``.
    Rows that repeat a doc_id are rows of their own; of equal texts all those with the
    smallest doc_id pass E, and a row with a null doc_id neither fails it nor makes others
    fail, nor has labels. A document whose labels repeat has a mark if any of them has it. Other columns
    are not used.
    """
    cut = text_failures(F.col("text"))
    flags = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("lang", F.lit("")).alias("part"), F.unhex(F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)).alias("same"),
        cut["few"].alias("few"), cut["C"].alias("C"), cut["D"].alias("D"),
    )
    flags = written(flags.select("doc_id", "part", "same", "few.A", "few.B", "C", "D"), "flags")
    # of the texts that repeat only: what has no copies needs no partner
    firsts = flags.where("doc_id is not null").groupBy("same").agg(F.min("doc_id").alias("_first"), F.max("doc_id").alias("_last")).where("_first < _last").drop("_last")
    marks = labels.where("doc_id is not null and (quality = 1 or toxic = 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    marks = marks.agg(F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("_good"), F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("_toxic"))
    # written, so that both sides of each join are plain exchanges and Spark may split a key that many rows share
    rows = flags.join(written(firsts, "firsts"), "same", "left").withColumn("E", F.coalesce(F.col("doc_id") > F.col("_first"), F.lit(False)))
    rows = rows.join(written(marks, "marks"), "doc_id", "left")
    return audit(rows, "part", list("ABCDE"), {"good_lost": "_good", "toxic_lost": "_toxic"})
