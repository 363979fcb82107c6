"""Packing of documents into fixed-length token sequences.

Bounded-space online packing: every partition keeps a fixed number of open windows.
A document fills whole windows first; its rest goes to the open window that it fills
best. When none has room, the fullest open window closes and a new one opens. The
windows still open at a partition's end are packed once more, across partitions.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .common import written

#: Open windows of a partition.
OPEN_WINDOWS = 64
#: Partitions whose leftover windows are merged in one group (at most 32 * 64 windows).
MERGE_PARTITIONS = 32
#: Rows that a task holds at a time.
SLICE = 256

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, padding long"


class OpenWindows:
    """A bounded set of windows, found by the room that is left."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most = capacity, most
        self.rooms: list[tuple[int, int]] = []  # (room, number), ascending
        self.items: dict[int, list] = {}
        self.made = 0

    def place(self, size: int, item) -> list | None:
        """Put an item into the window that it fills best; the items of a window that had to close, if any."""
        closed = None
        at = bisect_left(self.rooms, (size, -1))
        if at == len(self.rooms):
            if len(self.rooms) == self.most:
                closed = self.items.pop(self.rooms.pop(0)[1])
            number, room = self.made, self.capacity
            self.made += 1
            self.items[number] = []
        else:
            room, number = self.rooms.pop(at)
        self.items[number].append(item)
        if room == size:
            full = self.items.pop(number)
            if closed is None:
                return full
            raise AssertionError("a window of full size needs no place")
        insort(self.rooms, (room - size, number))
        return closed

    def rest(self) -> Iterator[list]:
        for _, number in self.rooms:
            yield self.items[number]


def pack(docs: DataFrame, vocabulary: str, length: int = 1024, end_id: int = 0, text: str = "text", key: str = "doc_id", open_windows: int = OPEN_WINDOWS, with_ids: bool = False) -> DataFrame:
    """Pieces of documents in sequences of at most ``length`` ids.

    A document is the ids of its text (null text: none) and ``end_id``. One row a piece:
    the key, ``start`` in the document, ``length``, ``ids_crc32``, ``doc_tokens``,
    ``sequence_id``, ``offset`` in the sequence and the sequence's ``padding``;
    ``with_ids`` adds the ``ids``. Each row of the input is one document, also where
    keys are null or repeat. Other columns are not used. An empty table gives no rows.
    """
    schema = PIECE + (", ids array<int>" if with_ids else "")
    columns = [c.split()[0] for c in schema.split(", ")]

    def piece(doc, start, ids, total):
        return (doc, start, len(ids), tokens.crc32_of(ids), total) + ((ids.astype("<i4"),) if with_ids else ())

    def rows(sequence: int, window: list) -> Iterator[tuple]:
        at, padding = 0, length - sum(x[2] for x in window)
        for x in window:
            yield (*x[:5], sequence, at, padding, *x[5:])
            at += x[2]

    def first(frames: Iterable) -> Iterator:
        import pandas as pd
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << 36
        made, windows, out = 0, OpenWindows(length, open_windows), []

        def emit(window):
            nonlocal made
            out.extend((*x, base >> 36, False) for x in rows(base + made, window))
            made += 1

        encode = tokens.encoder(vocabulary).encode
        for frame in frames:
            keys = frame[key].astype("Int64").astype(object).where(frame[key].notna(), None).tolist()
            texts = [t if isinstance(t, str) else None for t in frame[text].tolist()]
            for at in range(0, len(texts), SLICE):
                for doc, ids in zip(keys[at : at + SLICE], tokens.with_end(encode(texts[at : at + SLICE]), end_id), strict=True):
                    whole = len(ids) - len(ids) % length
                    for s in range(0, whole, length):
                        emit([piece(doc, s, ids[s : s + length], len(ids))])
                    if whole < len(ids):
                        part = piece(doc, whole, ids[whole:], len(ids))
                        if closed := windows.place(part[2], part):
                            emit(closed)
                yield frame_of(pd, out, columns + ["part", "left"])
                out = []
        for window in windows.rest():
            out.extend((*x, base >> 36, True) for x in rows(base + made, window))
            made += 1
        yield frame_of(pd, out, columns + ["part", "left"])

    def merge(frame):
        import pandas as pd

        frame = frame.sort_values(["sequence_id", "offset"], kind="stable")
        windows, out, made = OpenWindows(length, len(frame) + 1), [], int(frame["sequence_id"].iloc[0]) if len(frame) else 0
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + (["ids"] if with_ids else [])
        parts = [(int(g["length"].sum()), list(zip(*(g[c].astype(object).where(g[c].notna(), None) if c == "doc_id" else g[c] for c in names), strict=True))) for _, g in frame.groupby("sequence_id", sort=False)]
        done = []
        for size, window in sorted(parts, key=lambda x: -x[0]):
            if closed := windows.place(size, window):
                done.append(closed)
        for window in [*done, *windows.rest()]:
            out.extend(rows(made, [x for w in window for x in w]))
            made += 1
        return frame_of(pd, out, columns)

    placed = written(docs.select(F.col(key).cast("long").alias(key), F.col(text).alias(text)).mapInPandas(first, f"{schema}, part int, left boolean"), "pieces")
    full = placed.where(~F.col("left")).select(*columns)
    left = placed.where("left").groupBy((F.col("part") / MERGE_PARTITIONS).cast("int").alias("group"))
    return full.unionByName(left.applyInPandas(merge, schema))


def frame_of(pd, out: list[tuple], columns: list[str]):
    frame = pd.DataFrame.from_records(out, columns=columns)
    frame["doc_id"] = frame["doc_id"].astype("Int64")
    return frame


def sequences(pieces: DataFrame, length: int = 1024, pad_id: int = 0) -> DataFrame:
    """Padded sequences from pieces ``with_ids``: ``sequence_id``, ``ids``, ``doc_number`` (-1: padding)."""
    sorted_pieces = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    whole = F.flatten(F.transform("p", lambda x: x["ids"]))
    numbers = F.flatten(F.transform("p", lambda x, i: F.array_repeat(i, F.size(x["ids"]))))
    padded = lambda c, x: F.concat(c, F.array_repeat(F.lit(x), F.lit(length) - F.size(c)))
    return pieces.groupBy("sequence_id").agg(sorted_pieces.alias("p")).select("sequence_id", padded(whole, pad_id).alias("ids"), padded(numbers, -1).alias("doc_number"))

