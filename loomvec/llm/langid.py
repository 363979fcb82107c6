"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counts of n-grams of one to three characters are summed by language and bucket on
Spark; the log-probability matrix, of a fixed number of buckets, goes to the tasks as a
broadcast. A task scores many texts at a time: it gathers matrix rows of all n-grams
of a batch and sums them by text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: log2 of the number of buckets, pseudo-count of each, and the longest n-gram.
BUCKET_BITS, SMOOTHING, LONGEST = 16, 0.5, 3
#: N-grams at most whose evidence the reported score counts: a longer text's log-posterior
#: is scaled down to so many. The scale is one for all languages, so the prediction stays.
EVIDENCE = 120
#: Characters that are scored at a time; a longer text is taken in pieces that overlap.
BATCH_CHARS = 1 << 18
#: Languages whose counts a task holds at a time (half a MiB each).
HELD_LANGUAGES = 64
UNKNOWN = "und"

_MIX = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))


class Model(NamedTuple):
    languages: list[str]
    #: (buckets, languages), float32
    logs: np.ndarray
    priors: np.ndarray


def held_out(key: str = "doc_id") -> Column:
    """Rows that aren't learned from: crc32 of the key as text leaves 2 by 4. A null key is learned from."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def framed(text: str) -> str:
    """Lower-cased, with a space before and two after."""
    return f" {text.lower()}  "


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of framed texts joined, and the texts' starts."""
    raw = [t.encode("utf-32-le", "surrogatepass") for t in texts]
    lengths = np.array([len(x) // 4 for x in raw], dtype=np.int64)
    return np.frombuffer(b"".join(raw), dtype="<u4"), np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)


def gram_buckets(points: np.ndarray, bits: int = BUCKET_BITS, longest: int = LONGEST) -> Iterator[np.ndarray]:
    """For n from 1, the bucket of the n-gram that ends at each place; those that begin before a text see only spaces, wherever it stands."""
    shift = np.uint32(32 - bits)
    code = np.zeros(len(points), dtype=np.uint32)
    for n in range(longest):
        back = np.full(len(points), 32, dtype=np.uint32)
        back[n:] = points[: len(points) - n]
        code = (code + back + np.uint32(1)) * _MIX[n % 3]
        mixed = code ^ (code >> np.uint32(15))
        yield ((mixed * _MIX[(n + 1) % 3]) >> shift).astype(np.int64)


def batches(texts: list[str], most: int = BATCH_CHARS) -> Iterator[tuple[list[int], list[str], int]]:
    """Numbers of texts, their framed strings, and how many leading places to leave out.

    A batch holds whole texts, or one piece of a text longer than ``most``: a piece after
    the first repeats the characters that its first n-grams look back on.
    """
    held, some, size = [], [], 0
    for i, t in enumerate(texts):
        t = framed(t)
        if held and size + len(t) > most:
            yield held, some, 0
            held, some, size = [], [], 0
        if len(t) > most:
            for at in range(0, len(t), most):
                skip = min(at, LONGEST - 1)
                yield [i], [t[at - skip : at + most]], skip
        else:
            held.append(i)
            some.append(t)
            size += len(t)
    if held:
        yield held, some, 0


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def fit(docs: DataFrame, training: Column, language: str = "lang", text: str = "text", bits: int = BUCKET_BITS) -> Model:
    """Fit on all rows for which ``training`` holds and neither language nor text is null.

    Every language seen is learned. The driver gets the languages and one vector of
    bucket counts for each: 2 ** bits * 4 bytes a language in the model.
    """
    rows = docs.where(training & F.col(language).isNotNull() & F.col(text).isNotNull()).select(F.col(language).alias("lang"), F.col(text).alias("text"))
    seen = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy("lang").collect()
    languages = [r["lang"] for r in seen]
    if not languages:
        return Model([], np.zeros((1 << bits, 0), np.float32), np.zeros(0))
    number = {x: i for i, x in enumerate(languages)}

    def count(frames: Iterable) -> Iterator:
        import pandas as pd

        held: dict[int, np.ndarray] = {}

        def rest():
            for k, counts in held.items():
                bucket = np.flatnonzero(counts)
                yield pd.DataFrame({"lang": np.full(len(bucket), k, np.int32), "bucket": bucket.astype(np.int32), "n": counts[bucket]})
            held.clear()

        for frame in frames:
            for name, texts in frame.groupby("lang")["text"]:
                k = number[name]
                if k not in held and len(held) == HELD_LANGUAGES:
                    yield from rest()
                counts = held.setdefault(k, np.zeros(1 << bits, dtype=np.int64))
                for _, some, skip in batches(texts.tolist()):
                    for b in gram_buckets(code_points(some)[0], bits):
                        counts += np.bincount(b[skip:], minlength=1 << bits)
        yield from rest()

    sums = rows.mapInPandas(count, "lang int, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    dense = sums.groupBy("lang").agg(F.collect_list("bucket").alias("b"), F.collect_list("n").alias("n"))
    logs = np.empty((1 << bits, len(languages)), np.float32)
    logs[:] = -np.log(1 << bits)
    for r in dense.toLocalIterator():
        counts = np.full(1 << bits, SMOOTHING)
        counts[np.array(r["b"], dtype=np.int64)] += np.array(r["n"], dtype=np.float64)
        logs[:, r["lang"]] = np.log(counts / counts.sum())
    n = np.array([r["n"] for r in seen], dtype=float)
    return Model(languages, logs, np.log(n / n.sum()))


def score(texts: list[str | None], model: Model, bits: int = BUCKET_BITS, evidence: int = EVIDENCE) -> tuple[list[str], np.ndarray]:
    """The language of the largest posterior and a score for each text; ``und`` and 0 without a letter or a model.

    The score is the predicted language's share when the log-posteriors are scaled to at
    most ``evidence`` n-grams: n-grams of a text aren't independent, so plain posteriors of
    long texts are all but 0 or 1.
    """
    names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
    usable = [i for i, t in enumerate(texts) if has_letter(t)] if model.languages else []
    if not usable:
        return names, scores
    own = [texts[i] for i in usable]
    total, n = np.zeros((len(own), len(model.languages))), np.zeros(len(own))
    for some, pieces, skip in batches(own):
        points, starts = code_points(pieces)
        n[some] += LONGEST * (np.diff(np.append(starts, len(points))) - skip)
        for b in gram_buckets(points, bits):
            for k in range(len(model.languages)):
                total[some, k] += np.add.reduceat(model.logs[:, k][b[skip:]], starts, dtype=np.float64)
    logs = total + model.priors
    top = logs.argmax(axis=1)
    scaled = (logs - logs.max(axis=1, keepdims=True)) * np.minimum(1.0, evidence / n)[:, None]
    shares = 1.0 / np.exp(scaled).sum(axis=1)
    for j, i in enumerate(usable):
        names[i], scores[i] = model.languages[top[j]], min(1.0, float(shares[j]))
    return names, scores


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All columns of ``docs`` and a struct ``language`` of ``lang_pred`` and ``score``, from the text alone.

    Null texts and texts without a letter are ``und`` with score 0, as are all where no
    language was learned; ties go to the language that sorts first. Long texts are scored
    whole, a piece at a time. Rows stay as they are, repeated ones too; an input column
    named ``language`` is replaced.
    """
    import pandas as pd

    shared = docs.sparkSession.sparkContext.broadcast(model._replace(logs=np.asfortranarray(model.logs)))

    def of(texts: pd.Series) -> pd.DataFrame:
        names, scores = score([t if isinstance(t, str) else None for t in texts], shared.value)
        return pd.DataFrame({"lang_pred": names, "score": scores})

    of.__annotations__ = {"texts": pd.Series, "return": pd.DataFrame}
    return docs.withColumn("language", F.pandas_udf(of, "lang_pred string, score double")(F.col(text)))
