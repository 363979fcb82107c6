"""Byte-level BPE encoding and decoding from a table of ranks, in numpy matrices.

A text is cut into the matches of a pattern, and each match is encoded alone. Distinct
matches that a worker hasn't met are put, by length, into padded matrices of byte ids.
In a round every row merges its leftmost pair of smallest rank: a hash table gives the
ranks of neighbouring pairs, and each row closes its gap, so the matrix gets one column
narrower. Rows without a pair in the table leave. Very long matches are rows of their
own, whose rounds merge all places of the smallest rank at once where that is the same.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

#: Rank of a pair that doesn't merge.
NONE = np.int32(2**31 - 1)
#: Bytes of the widest padded matrix; longer matches are rows of their own.
WIDEST = 256
#: Cells of a matrix, matches that a worker remembers and their longest, characters and rows that are cut at a time.
CELLS, KNOWN_WORDS, KNOWN_LENGTH, SLICE, ROWS = 1 << 18, 200_000, 48, 1 << 20, 256

_loaded: dict[tuple[str, str], Codec] = {}


class PairTable:
    """Ranks of pairs of ids: open addressing with linear probes, for whole arrays at a time."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray):
        bits = max(4, int(4 * len(rank)).bit_length())
        self.shift, self.last = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.ranks = np.full(1 << bits, -1, np.int64), np.full(1 << bits, NONE, np.int32)
        keys, rank = self._key(left, right), rank.astype(np.int32)
        slot = self._slot(keys)
        while len(keys):
            free = self.keys[slot] < 0
            self.keys[slot[free]] = keys[free]  # of several keys for a slot the last one stays
            won = self.keys[slot] == keys
            self.ranks[slot[won]] = rank[won]
            keys, rank, slot = keys[~won], rank[~won], (slot[~won] + 1) & self.last

    @staticmethod
    def _key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return (left.astype(np.int64) << 32) | right

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, ``NONE`` for those that don't merge and for padding (-1)."""
        out = np.full(left.shape, NONE, np.int32)
        at = np.flatnonzero((left.ravel() >= 0) & (right.ravel() >= 0))
        keys = self._key(left.ravel()[at], right.ravel()[at])
        slot, flat = self._slot(keys), out.ravel()
        while len(at):
            seen = self.keys[slot]
            hit = seen == keys
            flat[at[hit]] = self.ranks[slot[hit]]
            go = ~hit & (seen >= 0)
            at, keys, slot = at[go], keys[go], (slot[go] + 1) & self.last
        return flat.reshape(left.shape)


class Codec:
    """Ranks of one vocabulary file (base64 bytes and rank in each line) and one pattern."""

    def __init__(self, path: str, pattern: str):
        import regex

        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        # Python's \s holds four control characters that Unicode's White_Space doesn't
        self.pieces = regex.compile(pattern.replace("\\s", "\\p{White_Space}").replace("\\S", "\\P{White_Space}")).findall
        self.token: list[bytes | None] = [None] * (max(self.ranks.values()) + 1)
        for b, r in self.ranks.items():
            self.token[r] = b
        self.first = np.full(256, -1, np.int32)
        for b in range(256):
            if (r := self.ranks.get(bytes([b]))) is not None:
                self.first[b] = r
        if (self.first < 0).any():
            raise ValueError(f"{path} has no rank for some byte")
        get = self.ranks.get
        pairs = [(x, y, r) for b, r in self.ranks.items() for i in range(1, len(b)) if (x := get(b[:i])) is not None and (y := get(b[i:])) is not None]
        self.pairs = PairTable(*np.array(pairs, dtype=np.int64).reshape(-1, 3).T)
        self.known: dict[str, bytes] = {}

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        """Ids of each text (null: none) as little-endian unsigned 32-bit integers."""
        at = 0
        while at < len(texts):
            cut, size = [], 0
            while at < len(texts) and size < SLICE:
                cut.append(self.pieces(texts[at] or ""))
                size += len(texts[at] or "")
                at += 1
            known = self.known
            new = {w for words in cut for w in words if w not in known}
            found = self.encode_words(list(new))
            for words in cut:
                yield b"".join([known[w] if w in known else found[w] for w in words])
            short = {w: x for w, x in found.items() if len(w) <= KNOWN_LENGTH}
            if len(known) + len(short) > KNOWN_WORDS:
                known.clear()
            if len(short) <= KNOWN_WORDS:
                known.update(short)

    def encode_words(self, words: list[str]) -> dict[str, bytes]:
        """Ids of single matches: a whole one that has a rank is that id."""
        out: dict[str, bytes] = {}
        by_width: dict[int, list[tuple[str, bytes]]] = {}
        for w in words:
            raw = w.encode()
            if (r := self.ranks.get(raw)) is not None:
                out[w] = r.to_bytes(4, "little")
            else:
                by_width.setdefault(1 << (len(raw) - 1).bit_length(), []).append((w, raw))
        for width, group in by_width.items():
            if width > WIDEST:
                out |= {w: merge_long(self.first[np.frombuffer(raw, np.uint8)], self.pairs).astype("<u4").tobytes() for w, raw in group}
                continue
            some = max(1, CELLS // width)
            for k in range(0, len(group), some):
                part = group[k : k + some]
                lengths = np.array([len(raw) for _, raw in part])
                ids = np.full((len(part), width), -1, np.int32)
                ids[np.arange(width) < lengths[:, None]] = self.first[np.frombuffer(b"".join(raw for _, raw in part), np.uint8)]
                out |= zip((w for w, _ in part), merge_rows(ids, lengths, self.pairs), strict=True)
        return out

    def decode(self, ids: bytes) -> bytes:
        """Bytes of ids; an id without bytes is an error."""
        places = np.frombuffer(ids, "<u4").tolist()
        try:
            return b"".join(map(self.token.__getitem__, places))
        except (IndexError, TypeError):
            raise ValueError("an id isn't in the vocabulary") from None


def merge_rows(ids: np.ndarray, lengths: np.ndarray, pairs: PairTable) -> list[bytes]:
    """Ids of all rows of a matrix padded with -1 (changed here), when no pair is left to merge.

    Every row that stays has merged once in each round, so it has as many ids less, and
    the matrix as many columns.
    """
    out: list[bytes] = [b""] * len(ids)
    live, rank, rounds = np.arange(len(ids)), pairs.find(ids[:, :-1], ids[:, 1:]), 0
    while len(live):
        at = rank.argmin(axis=1) if rank.shape[1] else np.zeros(len(live), np.int64)
        least = rank[np.arange(len(live)), at] if rank.shape[1] else np.full(len(live), NONE)
        if (over := least == NONE).any():
            ended, left = ids[over].astype("<u4"), lengths[live[over]] - rounds
            for place, row, n in zip(live[over].tolist(), ended, left.tolist(), strict=True):
                out[place] = row[:n].tobytes()
            live, ids, rank, at, least = live[~over], ids[~over], rank[~over], at[~over], least[~over]
            if not len(live):
                break
        row, column = np.arange(len(live)), np.arange(ids.shape[1] - 1)
        ids[row, at] = least
        ids = np.take_along_axis(ids, column + (column > at[:, None]), axis=1)
        column = column[:-1]
        rank = np.take_along_axis(rank, column + (column >= at[:, None]), axis=1)
        for side in (at - 1, at):  # the pairs that the new id is in
            some = np.flatnonzero((side >= 0) & (side < rank.shape[1]))
            rank[some, side[some]] = pairs.find(ids[some, side[some]], ids[some, side[some] + 1])
        rounds += 1
    return out


def merge_long(ids: np.ndarray, pairs: PairTable) -> np.ndarray:
    """Ids of one long match when no pair is left to merge.

    A round merges every place of the smallest rank from the left, where no pair that
    arises on the way has a smaller rank: then single merges would do the same. Else it
    merges the leftmost place alone.
    """
    ids = ids.astype(np.int32)
    rank = pairs.find(ids[:-1], ids[1:])
    while len(rank) and (least := rank.min()) != NONE:
        at = np.flatnonzero(rank == least)
        begins = np.flatnonzero(np.diff(at, prepend=-2) != 1)
        run = np.arange(len(at)) - np.repeat(begins, np.diff(begins, append=len(at)))
        at = at[run % 2 == 0]  # overlapping places: the first, the third, and so on
        merged = np.full(len(at), least, np.int32)
        before = np.where(at > 0, ids[at - 1], -1)
        before[1:] = np.where(at[1:] == at[:-1] + 2, least, before[1:])
        behind = np.where(at + 2 < len(ids), ids[np.minimum(at + 2, len(ids) - 1)], -1)
        if (pairs.find(before, merged) < least).any() or (pairs.find(merged, behind) < least).any():
            at = at[:1]
        ids[at] = least
        kept = np.ones(len(ids), bool)
        kept[at + 1] = False
        places = np.flatnonzero(kept)
        ids, rank = ids[places], rank[places[1:] - 1]
        new = at - np.arange(len(at))
        side = np.concatenate([new - 1, new])
        side = side[(side >= 0) & (side < len(rank))]
        rank[side] = pairs.find(ids[side], ids[side + 1])
    return ids


def codec(path: str, pattern: str) -> Codec:
    """One codec for each worker process, vocabulary and pattern."""
    if (path, pattern) not in _loaded:
        _loaded[path, pattern] = Codec(path, pattern)
    return _loaded[path, pattern]


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def sliced(column: pa.Array, values: Callable[[list], Iterable[bytes | None]]) -> pa.Array:
    """Binary values of a column of texts or bytes, few of them as Python objects at a time."""
    out = [pa.array(values(column.slice(at, ROWS).to_pylist()), pa.binary()) for at in range(0, len(column), ROWS)]
    return pa.concat_arrays(out) if out else pa.array([], pa.binary())


def encoded(text: Column, path: str, pattern: str) -> Column:
    """Ids of whole texts, as binary of little-endian unsigned 32-bit integers.

    Null and empty texts give empty binary. There are no special tokens: their strings are
    ordinary text. A text of any length is cut whole. As an expression on a column it
    depends on no other column or row, so repeated rows, extra columns and empty tables
    need no rule.
    """
    @F.arrow_udf(BinaryType())
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = codec(path, pattern)
        for texts in batches:
            yield sliced(texts, lambda some: own.encode(some))

    return of(text)


def decoded(ids: Column, path: str, pattern: str) -> Column:
    """Bytes of ids as ``encoded`` gives them (null: null). An id that isn't in the vocabulary ends the job."""
    @F.arrow_udf(BinaryType())
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = codec(path, pattern)
        for ids in batches:
            yield sliced(ids, lambda some: (None if x is None else own.decode(x) for x in some))

    return of(ids)
