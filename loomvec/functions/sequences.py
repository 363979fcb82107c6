"""Column builders for identifiers, sequence cleaning, hashes and chunk plans."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The 20 standard residue letters and the six special ones. Fixed values.
STANDARD = "ACDEFGHIKLMNPQRSTVWY"
SPECIAL = "XBZJUO"
#: White space over all of Unicode, as a class body for Java patterns.
SPACE = "\\s\\x1c-\\x1f\\x85\\p{Z}"
POLICIES = ("error", "keep_if_supported", "replace_with_X")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once: the optimiser can't copy a lambda variable's expression."""
    return F.transform(F.array(value), body)[0]


def trimmed(c: Column) -> Column:
    """Text without white space around it; null for none."""
    return F.nullif(F.regexp_replace(c, f"^[{SPACE}]+|[{SPACE}]+$", ""), F.lit(""))


def canonical_id(c: Column, prefix: str = "NSC") -> Column:
    """``PREFIX-<digits without leading zeros>``; null where the text isn't an id."""
    digits = F.regexp_extract(trimmed(c), f"(?i)^(?:{prefix}[{SPACE}_-]*)?([0-9]+)\\z", 1)
    return F.when(digits != "", F.concat(F.lit(f"{prefix}-"), F.regexp_replace(digits, "^0+(?=[0-9])", "")))


def compact_upper(c: Column) -> Column:
    return F.upper(F.regexp_replace(c, f"[{SPACE}]+", ""))


def sequence_hash(c: Column) -> Column:
    return F.sha2(c, 256)


def first_bad_position(upper: Column, allowed: str) -> Column:
    """Place from 0 of the first character outside ``allowed``; -1 if there is none."""
    return (F.regexp_instr(upper, F.lit(f"[^{allowed}]")) - 1).cast("int")


def replaced_symbols(policy: str, supported: str) -> str:
    """Special symbols that a policy turns into X."""
    return "".join(s for s in SPECIAL if s not in supported) if policy == "replace_with_X" else ""


def clean(raw: Column, policy: str = "keep_if_supported", supported: str = SPECIAL) -> Column:
    """Struct of cleaned, error_kind, error_position, error_symbol for a raw sequence.

    Events are a column of their own (``special_events``): an array with an entry a letter
    is built only where it is asked for.

    A null or blank sequence is invalid. The left-most symbol that isn't allowed decides.
    """
    if policy not in POLICIES:
        raise ValueError(f"unknown policy: {policy}")
    unsupported = "".join(s for s in SPECIAL if s not in supported)
    allowed = STANDARD + supported
    if policy == "replace_with_X":
        allowed += unsupported.replace("X", "")
    letters = f"[^{allowed}]"

    def of(upper: Column) -> Column:
        bad = (F.regexp_instr(upper, F.lit(letters)) - 1).cast("int")
        return let(F.when(upper != "", bad), lambda at: judged(upper, at))

    def judged(upper: Column, bad: Column) -> Column:
        symbol = F.when(bad >= 0, F.substring(upper, bad + 1, F.lit(1)))
        kind = F.when(bad.isNull(), "invalid_sequence").when(bad >= 0, F.when(F.instr(F.lit(SPECIAL), symbol) > 0, "unsupported_residue").otherwise("invalid_sequence"))
        fixed = F.translate(upper, unsupported, "X" * len(unsupported)) if policy == "replace_with_X" and unsupported else upper
        return F.struct(F.when(kind.isNull(), fixed).alias("cleaned"), kind.alias("error_kind"), F.when(bad >= 0, bad).alias("error_position"), symbol.alias("error_symbol"))

    return let(compact_upper(raw), of)


def special_events(upper: Column, replaced: str = "") -> Column:
    """Array of (position, symbol, replaced_with) of the special symbols, in order, as they were before replacement.

    Splitting an empty text gives one empty symbol, which is none.
    """
    event = lambda c, i: F.struct(i.alias("position"), c.alias("symbol"), F.when(F.instr(F.lit(replaced), c) > 0, "X").alias("replaced_with"))
    # most letters are no event: a struct is made for those only that are
    return F.filter(F.transform(F.split(upper, ""), lambda c, i: F.when((c != "") & (F.instr(F.lit(SPECIAL), c) > 0), event(c, i))), lambda e: e.isNotNull())


def special_symbols(text: Column) -> Column:
    """Sorted distinct special symbols of a text as it stands."""
    return F.array_sort(F.array_distinct(F.filter(F.split(text, ""), lambda c: (c != "") & (F.instr(F.lit(SPECIAL), c) > 0))))


def symbol_positions(events: Column) -> Column:
    """Map of each special symbol to its positions."""
    symbols = F.array_sort(F.array_distinct(F.transform(events, lambda e: e["symbol"])))
    return F.map_from_entries(F.transform(symbols, lambda s: F.struct(s, F.transform(F.filter(events, lambda e: e["symbol"] == s), lambda e: e["position"]))))


def token_text(token: Column) -> Column:
    """A vocabulary token without its space marks, in capitals."""
    return F.upper(F.translate(token, "\u2581\u0120 ", ""))


def commit_of(path: Column) -> Column:
    """The 40-digit hexadecimal name after ``snapshots/`` in a path; null without one."""
    name = F.regexp_extract(F.translate(path, "\\", "/"), "snapshots/([^/]+)", 1)
    return F.when(name.rlike("^[0-9a-f]{40}$"), name)


def owner_of(name: Column) -> Column:
    """What stands before the first slash; empty without one."""
    return F.when(F.contains(name, F.lit("/")), F.split_part(name, F.lit("/"), F.lit(1))).otherwise("")


def kept_positions(special: Column, attention: Column) -> Column:
    """Places with a special mask of 0 and an attention mask of 1."""
    places = F.sequence(F.lit(0), F.size(special) - 1)
    return F.when(F.size(special) > 0, F.filter(places, lambda i: (F.get(special, i) == 0) & (F.get(attention, i) == 1))).otherwise(F.array().cast("array<int>"))


def gathered(values: Column, places: Column) -> Column:
    return F.transform(places, lambda i: F.get(values, i))


def checked_positions(places: Column, residues: Column) -> Column:
    """``places`` as they are; a number other than ``residues`` ends the job."""
    wrong = F.concat(F.lit("a sequence of "), residues.cast("string"), F.lit(" residues has "), F.size(places).cast("string"), F.lit(" positions"))
    return F.when(F.size(places) == residues, places).otherwise(F.raise_error(wrong))


def checked_order(symbols: Column, places: Column, sequence: Column) -> Column:
    """``places`` as they are; symbols there that don't spell the sequence end the job."""
    return F.when(F.array_join(gathered(symbols, places), "") == sequence, places).otherwise(F.raise_error(F.lit("symbols at residue positions are in another order than the sequence")))


def declared_length(declared: Column, actual: Column) -> Column:
    """Struct of declared (bigint), mismatch and warning of a declared length."""
    number = trimmed(declared).try_cast("bigint")
    return F.struct(
        number.alias("declared"),
        F.coalesce(number != actual, F.lit(False)).alias("mismatch"),
        F.when(trimmed(declared).isNull(), "missing").when(number.isNull(), "not an integer").when(number != actual, "mismatch").alias("warning"),
    )


def chunk_count(length: Column, size: int, overlap: int) -> Column:
    stride = size - overlap
    return F.when(length <= 0, 0).when(length <= size, 1).otherwise(F.ceil((length - size) / stride) + 1).cast("int")


def chunk_plan(length: Column, size: int, overlap: int) -> Column:
    """Array of (chunk_start, chunk_end): overlapping half-open pieces; the last may be short."""
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and below the chunk size")
    n, stride = chunk_count(length, size, overlap), size - overlap
    places = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.struct((i * stride).cast("int").alias("chunk_start"), F.least(i * stride + size, length).cast("int").alias("chunk_end")))


def chunk_texts(sequence: Column, size: int, overlap: int) -> Column:
    """Array of (chunk_start, text) of the pieces of ``chunk_plan``, in one pass over the sequence.

    The text is cut into pieces as long as the stride, and a chunk joins as many of them as
    it spans; a substring for each chunk would walk from the beginning every time.
    """
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and below the chunk size")
    stride = size - overlap
    span = -(-size // stride)
    number = chunk_count(F.length(sequence), size, overlap)

    def cut(pieces: Column) -> Column:
        starts = F.when(number > 0, F.sequence(F.lit(0), number - 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.struct((i * stride).alias("chunk_start"), F.substring(F.array_join(F.slice(pieces, i + 1, span), ""), 1, size).alias("text")))

    return let(F.regexp_extract_all(sequence, F.lit(f"(?s).{{1,{stride}}}"), F.lit(0)), cut)


def coverage(plan: Column, length: Column, value: Callable[[Column], Column] | None = None) -> Column:
    """Struct of residues, total, least, most, pooled and error of any plan of (chunk_start, chunk_end).

    A sweep over starts and ends: between two of them every position is covered by the
    same chunks. ``pooled`` is the mean over positions of the mean of ``value`` over the
    chunks that cover each; an uncovered position is an error.
    """
    value = value or (lambda c: F.lit(0.0))
    edge = lambda at, step, v: F.struct(at.cast("long").alias("at"), F.lit(step).alias("step"), (v * step).cast("double").alias("v"))
    edges = F.array_sort(F.concat(F.transform(plan, lambda c: edge(c["chunk_start"], 1, value(c))), F.transform(plan, lambda c: edge(c["chunk_end"], -1, value(c))), F.array(edge(length, 0, F.lit(0.0)))))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit(0).cast("long").alias("level"), F.lit(0.0).alias("v"), F.lit(None).cast("long").alias("least"), F.lit(0).cast("long").alias("most"), F.lit(0.0).alias("sum"), F.lit(0).cast("long").alias("total"))

    def step(a: Column, e: Column) -> Column:
        wide = e["at"] - a["at"]
        inside = wide > 0
        return F.struct(
            e["at"].alias("at"), (a["level"] + e["step"]).alias("level"), (a["v"] + e["v"]).alias("v"),
            F.when(inside, F.least(a["least"], a["level"])).otherwise(a["least"]).alias("least"), F.when(inside, F.greatest(a["most"], a["level"])).otherwise(a["most"]).alias("most"),
            (a["sum"] + F.when(inside & (a["level"] > 0), wide * a["v"] / a["level"]).otherwise(0.0)).alias("sum"), (a["total"] + wide * a["level"]).alias("total"),
        )

    found = F.aggregate(edges, start, step)
    return let(found, lambda f: F.struct(length.cast("long").alias("residues"), f["total"].alias("total"), f["least"].alias("least"), f["most"].alias("most"), F.try_divide(f["sum"], length).alias("pooled"), F.when((length > 0) & (F.coalesce(f["least"], F.lit(0)) == 0), "uncovered position").alias("error")))
