"""Encoders of distinct sequences and the position mean over overlapping chunks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache
from typing import Protocol

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vectors as V
from ..functions.sequences import SPECIAL, STANDARD, chunk_count, chunk_texts
from .groups import vector_sums


#: Texts that are encoded whole at a time, and numbers of the sums of chunks that are held at once.
TEXTS, HELD = 64, 1 << 20
#: Numbers of the states that are made together of several chunks of one length.
TOGETHER = 1 << 16


class Encoder(Protocol):
    """States of the residues of one chunk: (residues, width)."""

    width: int

    def states(self, chunk: str) -> np.ndarray: ...


class Letters:
    """Numbers of letters, looked up for a whole text at once; a letter without one is a ``RowError``."""

    def __init__(self, numbers: dict):
        self.numbers, self.table = numbers, np.full(256, np.nan)
        for c, x in numbers.items():
            if ord(c) < 256:
                self.table[ord(c)] = x

    def of(self, text: str) -> np.ndarray:
        try:
            x = self.table[np.frombuffer(text.encode("latin-1"), np.uint8)]
            if not np.isnan(x).any():
                return x
        except UnicodeEncodeError:
            pass
        try:
            return np.array([self.numbers[c] for c in text], dtype=float)
        except KeyError as e:
            raise RowError(f"symbol {e} isn't encoded") from None


class NumberEncoder:
    """An encoder by numbers of letters: chunks of one length go through ``of_numbers`` together."""

    letters: Letters

    def of_numbers(self, x: np.ndarray) -> np.ndarray:
        """States (chunks, residues, width) of the numbers of some chunks (chunks, residues)."""
        raise NotImplementedError

    def states(self, chunk: str) -> np.ndarray:
        return self.of_numbers(self.letters.of(chunk)[None])[0]

    def sums(self, chunks: list[str], weights: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Weighed sums (chunks, width) of chunks of one length, and which have a number for every letter."""
        x = np.full((len(chunks), len(chunks[0])), np.nan)
        for i, chunk in enumerate(chunks):
            try:
                x[i] = self.letters.table[np.frombuffer(chunk.encode("latin-1"), np.uint8)]
            except UnicodeEncodeError:
                continue
        good, out = ~np.isnan(x).any(axis=1), np.zeros((len(chunks), self.width))
        if good.any():
            out[good] = np.matmul(np.stack(weights)[good][:, None, :], self.of_numbers(x[good]))[:, 0, :]
        return out, good


class AlphabetEncoder:
    """A deterministic encoder: value j of a residue is 0.01 * j + its number + 1."""

    def __init__(self, width: int = 8, first: int = 4):
        self.width = width
        self.number = {c: first + i for i, c in enumerate(STANDARD + SPECIAL)}

    def states(self, chunk: str) -> np.ndarray:
        try:
            numbers = [self.number[c] for c in chunk]
        except KeyError as e:
            raise RowError(f"symbol {e} isn't encoded") from None
        return np.array(numbers, dtype=float)[:, None] + 1 + 0.01 * np.arange(self.width)


class OneHotEncoder(NumberEncoder):
    """A real, if simple, encoder: residue states are unit vectors, so the pooled vector is the composition."""

    def __init__(self, alphabet: str = STANDARD + SPECIAL):
        self.width, self.letters, self.unit = len(alphabet), Letters({c: i for i, c in enumerate(alphabet)}), np.eye(len(alphabet))

    def of_numbers(self, x: np.ndarray) -> np.ndarray:
        return self.unit[x.astype(np.intp)]


#: Hydropathy of the residues (the published scale of Kyte and Doolittle); special letters take the mean of what they stand for. Fixed values.
HYDROPATHY = {
    "A": 1.8, "C": 2.5, "D": -3.5, "E": -3.5, "F": 2.8, "G": -0.4, "H": -3.2, "I": 4.5, "K": -3.9, "L": 3.8, "M": 1.9, "N": -3.5, "P": -1.6, "Q": -3.5, "R": -4.5,
    "S": -0.8, "T": -0.7, "V": 4.2, "W": -0.9, "Y": -1.3, "X": 0.0, "B": -3.5, "Z": -3.5, "J": 4.15, "U": 2.5, "O": -3.9,
}


class ProfileEncoder(NumberEncoder):
    """Hydropathy profile: each residue's value, and the mean and the largest value of a window around it.

    Windows end where a chunk ends, so states near its edges depend on the chunk.
    """

    width = 3

    def __init__(self, reach: int = 4):
        self.reach, self.letters = reach, Letters(HYDROPATHY)

    def of_numbers(self, x: np.ndarray) -> np.ndarray:
        r, (m, n) = self.reach, x.shape
        sums, at = np.concatenate([np.zeros((m, 1)), np.cumsum(x, axis=1)], axis=1), np.arange(n)
        low, high = np.maximum(0, at - r), np.minimum(n, at + r + 1)
        edge = np.full((m, r), -np.inf)
        padded, most = np.concatenate([edge, x, edge], axis=1), x.copy()
        for i in range(2 * r + 1):
            np.maximum(most, padded[:, i : i + n], out=most)
        return np.stack([x, (sums[:, high] - sums[:, low]) / (high - low), most], axis=2)


class RowError(ValueError):
    """One sequence can't be encoded; any other error ends the job."""


def residue_mean(states: np.ndarray) -> np.ndarray:
    """Mean over the residues of one chunk."""
    if states.ndim != 2 or not len(states):
        raise ValueError("states must be a matrix of at least one residue")
    return states.mean(axis=0)


def pool(encoder: Encoder, sequence: str, size: int, overlap: int) -> tuple[np.ndarray, int]:
    """Mean over positions of the mean over the chunks that cover each; and the forward passes (chunks)."""
    overlap = min(overlap, size - 1)  # a forced size may be below the configured overlap
    if 0 < len(sequence) <= size:  # one chunk: its states are held once
        states = encoder.states(sequence)
        if states.shape != (len(sequence), encoder.width):
            raise ValueError("an encoder returned states of another shape")
        return states.mean(axis=0), 1
    total, cover, start, chunks = np.zeros((len(sequence), encoder.width)), np.zeros(len(sequence)), 0, 0
    while True:
        end = min(start + size, len(sequence))
        states = encoder.states(sequence[start:end])
        if states.shape != (end - start, encoder.width):
            raise ValueError("an encoder returned states of another shape")
        total[start:end] += states
        cover[start:end] += 1
        chunks += 1
        if end == len(sequence):
            return (total / cover[:, None]).mean(axis=0), chunks
        start += size - overlap


def encode(jobs: DataFrame, encoder: Encoder, size: int, overlap: int, key: str = "sequence_hash", sequence: str = "sequence", element: str = "float") -> DataFrame:
    """key, embedding, num_chunks (forward passes), error, error_kind of distinct sequences; a failed one has no vector.

    A ``RowError`` fails its row; any other error, such as states of another shape, ends the job.
    """
    if size < 1 or overlap < 0:
        raise ValueError("a chunk must hold a residue and an overlap can't be negative")

    kind = {"float": np.float32, "double": np.float64}[element]

    def of(batches: Iterable) -> Iterator:
        import pyarrow as pa

        # a few texts are taken from an Arrow batch at a time, so that it isn't held again as Python's
        for batch in (b.slice(at, TEXTS) for b in batches for at in range(0, b.num_rows, TEXTS)):
            out = []
            for s in batch.column(1):
                try:
                    v, n = pool(encoder, s.as_py(), size, overlap)
                    good = np.isfinite(v).all() and np.linalg.norm(v) > 0
                    out.append((v.astype(kind), n, None, None) if good else (None, n, "vector is not finite or zero", "embedding_quality"))
                except RowError as e:
                    out.append((None, None, str(e), "inference_error"))
            v, n, error, error_kind = zip(*out, strict=True)
            columns = [batch.column(0), pa.array(v, pa.list_(pa.from_numpy_dtype(kind))), pa.array(n, pa.int32()), pa.array(error, pa.string()), pa.array(error_kind, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [key, "embedding", "num_chunks", "error", "error_kind"])

    return jobs.select(key, sequence).mapInArrow(of, f"{key} string, embedding array<{element}>, num_chunks int, error string, error_kind string")


def chunk_weights(start: int, length: int, total: int, size: int, overlap: int) -> np.ndarray:
    """One over the number of chunks that cover each position of the chunk at ``start``, in a sequence of ``total``.

    Chunk i covers [i * stride, i * stride + size), so the chunks over a position are a run
    of numbers with ends in closed form; the weight changes only at edges of other chunks.
    """
    stride = size - overlap
    span = -(-size // stride)
    # what lies further off than a chunk spans changes nothing, so chunks inside share one array
    skipped = max(0, start // stride - span) * stride
    return _weights(start - skipped, length, min(total, start + (span + 2) * stride + 2 * size) - skipped, size, overlap)


@lru_cache(maxsize=1024)
def _weights(start: int, length: int, total: int, size: int, overlap: int) -> np.ndarray:
    stride = size - overlap
    last = 0 if total <= size else -(-(total - size) // stride)
    p = np.arange(start, start + length)
    first = np.maximum(0, -((size - 1 - p) // stride))
    return 1.0 / (np.minimum(p // stride, last) - first + 1)


def encode_by_chunks(jobs: DataFrame, encoder: Encoder, size: int, overlap: int, key: str = "sequence_hash", sequence: str = "sequence", element: str = "float", parts: int | None = None) -> DataFrame:
    """As ``encode``, with a row for each chunk: no task holds more states than those of one chunk, or ``TOGETHER`` numbers.

    A chunk's states are added up with the weights of its positions, chunks of any sequence
    are dealt to all tasks, and the sums of a sequence are added by partial aggregates. A
    sequence of which one chunk can't be encoded fails with the error of its first such
    chunk; one whose chunks don't all arrive, or without a letter, fails. ``parts``: number of
    partitions of the chunk rows (else Spark's).
    """
    if size < 1 or overlap < 0:
        raise ValueError("a chunk must hold a residue and an overlap can't be negative")
    overlap = min(overlap, size - 1)  # a forced size may be below the configured overlap
    width = encoder.width

    def of(batches: Iterable) -> Iterator:
        import pyarrow as pa

        rows = max(1, HELD // width)
        for batch in (b.slice(at, rows) for b in batches for at in range(0, b.num_rows, rows)):
            n = batch.num_rows
            sums, good, errors = np.zeros((n, width)), np.zeros(n, bool), [None] * n
            chunk_rows = list(zip(*(batch.column(c).to_pylist() for c in ("residues", "chunk_start", "text")), strict=True))
            if isinstance(encoder, NumberEncoder):
                lengths: dict[int, list[int]] = {}
                for i, (_, _, text) in enumerate(chunk_rows):
                    if text:
                        lengths.setdefault(len(text), []).append(i)
                for length, places in lengths.items():
                    few = max(1, TOGETHER // (length * width))
                    for some in (places[at : at + few] for at in range(0, len(places), few)):
                        weights = [chunk_weights(chunk_rows[i][1], length, chunk_rows[i][0], size, overlap) for i in some]
                        sums[some], good[some] = encoder.sums([chunk_rows[i][2] for i in some], weights)
            for i, (residues, start, text) in enumerate(chunk_rows):
                if text is None or good[i]:  # nothing to encode: not covered below
                    continue
                try:
                    states = encoder.states(text)
                    if states.shape != (len(text), width):
                        raise ValueError("an encoder returned states of another shape")
                    sums[i], good[i] = chunk_weights(start, len(text), residues, size, overlap) @ states, True
                except RowError as e:
                    errors[i] = str(e)
            ends = np.concatenate([[0], np.cumsum(good * width)]).astype(np.int32)
            vectors = pa.ListArray.from_arrays(pa.array(ends), pa.array(sums[good].ravel()), mask=pa.array(~good))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("key", "residues", "chunk_start")), vectors, pa.array(errors, pa.string())], ["key", "residues", "chunk_start", "vector", "error"])

    chunks = jobs.select(F.col(key).alias("key"), F.length(sequence).alias("residues"), F.explode_outer(chunk_texts(F.col(sequence), size, overlap)).alias("c")).select("key", "residues", "c.*")
    dealt = chunks.repartition(parts, "key", "chunk_start") if parts else chunks.repartition("key", "chunk_start")
    sums = dealt.mapInArrow(of, "key string, residues int, chunk_start int, vector array<double>, error string")
    about = [F.max("residues").alias("residues"), F.count(F.lit(1)).cast("int").alias("num_chunks"), F.min(F.when(F.col("error").isNotNull(), F.struct("chunk_start", "error")))["error"].alias("error")]
    if width <= 64:
        whole = vector_sums(sums, "key", "vector", width, about)
    else:  # chunk rows are used twice, so the encoder's work is written first
        from .scratch import saved

        whole = vector_sums(saved(sums, "chunks"), "key", "vector", width, about)
    whole = whole.withColumn("mean", F.transform("sums", lambda x: (x / F.col("residues")).cast(element)))
    missing = F.col("num_chunks") != chunk_count(F.col("residues"), size, overlap)
    kind = F.when(F.col("error").isNotNull(), "inference_error").when(missing | ~V.is_valid(F.col("mean"), width), "embedding_quality")
    said = F.when(F.col("error").isNotNull(), F.col("error")).when(missing, "uncovered position").when(kind.isNotNull(), "vector is not finite or zero")
    # a failed sequence went through the encoder only if no symbol stopped it, as in ``encode``
    return whole.select(F.col("key").alias(key), F.when(kind.isNull(), F.col("mean")).alias("embedding"), F.when(F.col("error").isNull(), F.col("num_chunks")).alias("num_chunks"), said.alias("error"), kind.alias("error_kind"))
