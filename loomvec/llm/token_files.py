"""Token ids in Arrow stream files of fixed-size-list batches.

Documents are sorted by key, encoded and cut into rows of equal length. A part is two
stream files: ``*.ids.arrow`` holds batches of ``ids`` and ``mask``, both fixed-size
lists, so that a memory-mapped batch gives its sequences as one array without a copy;
``*.docs.arrow`` holds key, first id and number of ids of each document. Only the last
row of a part is padded; there ``mask`` is false.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import tokens
from .common import fs_of, publish

#: Rows of a record batch.
BATCH_ROWS = 256
SLICE = 256


class Part(NamedTuple):
    """One pair of files; ``first`` counts the ids of all parts before it."""

    path: str
    documents: int
    ids: int
    first: int


class TokenFiles(NamedTuple):
    length: int
    parts: list[Part]


def id_type(vocabulary_size: int) -> np.dtype:
    """The narrowest unsigned type that holds every id."""
    return np.dtype("<u2" if vocabulary_size <= 1 << 16 else "<u4")


def _batch(schema, ids: np.ndarray, filled: int, length: int):
    import pyarrow as pa

    mask = np.arange(len(ids)) < filled
    lists = [pa.FixedSizeListArray.from_arrays(pa.array(x), length) for x in (ids, mask)]
    return pa.RecordBatch.from_arrays(lists, schema=schema)


def write_part(path: str, documents: Iterable[tuple[int | None, np.ndarray]], length: int, kind: np.dtype) -> tuple[int, int]:
    """Write one part from (key, ids) pairs; documents and ids written. Holds one batch at a time."""
    import pyarrow as pa

    item = pa.from_numpy_dtype(kind)
    rows = pa.schema([("ids", pa.list_(item, length)), ("mask", pa.list_(pa.bool_(), length))])
    index = pa.schema([("key", pa.int64()), ("first", pa.int64()), ("ids", pa.int64())])
    total = n = 0

    def write_ids(out):
        nonlocal total, n
        room = np.zeros(BATCH_ROWS * length, kind)
        used = 0

        def write_docs(docs_out):
            nonlocal total, n, used
            with pa.ipc.new_stream(out, rows) as ids_file, pa.ipc.new_stream(docs_out, index) as docs_file:
                held: list[tuple] = []
                for key, ids in documents:
                    held.append((key, total, len(ids)))
                    n, total = n + 1, total + len(ids)
                    while len(ids):
                        some = ids[: len(room) - used]
                        room[used : used + len(some)] = some
                        used, ids = used + len(some), ids[len(some) :]
                        if used == len(room):
                            ids_file.write_batch(_batch(rows, room, used, length))
                            used = 0
                    if len(held) == 4096:
                        docs_file.write_batch(pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*held, strict=True)], schema=index))
                        held = []
                if used:
                    end = -(-used // length) * length
                    room[used:end] = 0
                    ids_file.write_batch(_batch(rows, room[:end], used, length))
                if held:
                    docs_file.write_batch(pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*held, strict=True)], schema=index))

        publish(f"{path}.docs.arrow", write_docs)

    publish(f"{path}.ids.arrow", write_ids)
    return n, total


def _open(path: str):
    import pyarrow as pa

    system, place = fs_of(path)
    if system.type_name == "local":
        return pa.memory_map(place)
    return system.open_input_file(place)


class PartReader:
    """Random access to the sequences of one part; arrays of a mapped local file are views of it."""

    def __init__(self, path: str):
        import pyarrow as pa

        self._file = _open(f"{path}.ids.arrow")
        self.batches = list(pa.ipc.open_stream(self._file))
        self.length = self.batches[0].schema.field("ids").type.list_size if self.batches else 0
        self.starts = np.cumsum([0] + [len(b) for b in self.batches])
        self._flat = [b.column("ids").flatten().to_numpy(zero_copy_only=True) for b in self.batches]

    def __len__(self) -> int:
        return int(self.starts[-1])

    def sequence(self, row: int) -> np.ndarray:
        at = int(np.searchsorted(self.starts, row, side="right")) - 1
        i = (row - int(self.starts[at])) * self.length
        return self._flat[at][i : i + self.length]

    def mask(self, row: int):
        """Arrow booleans, a slice of the batch's bits without a copy: a byte for each would double the ids' size."""
        at = int(np.searchsorted(self.starts, row, side="right")) - 1
        return self.batches[at].column("mask").values.slice((row - int(self.starts[at])) * self.length, self.length)

    def ids(self, first: int, count: int) -> np.ndarray:
        """Ids from ``first`` on, through as many sequences as they fill."""
        found = []
        while count > 0:
            row, skip = divmod(first, self.length)
            at = int(np.searchsorted(self.starts, row, side="right")) - 1
            i = (row - int(self.starts[at])) * self.length + skip
            found.append(self._flat[at][i : i + count])
            first, count = first + len(found[-1]), count - len(found[-1])
        return found[0] if len(found) == 1 else np.concatenate(found) if found else np.empty(0, "<u4")


def write_token_files(docs: DataFrame, folder: str, vocabulary: str, length: int = 1024, end_id: int = 2, text: str = "text", key: str = "doc_id", parts: int | None = None) -> TokenFiles:
    """Encode every text (null: empty), append ``end_id``, and write parts in ascending key order.

    Rows with a null key come first; rows that share a key are ordered by text. Other
    columns are not used. The driver gets one row a part. An empty table gives no parts.
    """

    def write(frames: Iterable) -> Iterator:
        import pandas as pd
        from pyspark import TaskContext

        encode = tokens.encoder(vocabulary)

        def documents():
            for frame in frames:
                keys = [None if k is pd.NA else int(k) for k in frame[key].astype("Int64")]
                texts = [t if isinstance(t, str) else None for t in frame[text].tolist()]
                for at in range(0, len(texts), SLICE):
                    yield from zip(keys[at : at + SLICE], tokens.with_end(encode.encode(texts[at : at + SLICE]), end_id), strict=True)

        number = TaskContext.get().partitionId()
        path = f"{folder}/part-{number:06d}"
        n, total = write_part(path, documents(), length, id_type(max(encode.size, end_id + 1)))
        yield pd.DataFrame({"part": [number], "path": [path], "documents": [n], "ids": [total]})

    rows = docs.select(F.col(key).cast("long").alias(key), F.col(text).alias(text))
    by = rows.repartitionByRange(parts, key) if parts else rows.repartitionByRange(key)
    found = by.sortWithinPartitions(key, text).mapInPandas(write, "part int, path string, documents long, ids long").collect()
    out, first = [], 0
    for r in sorted(found, key=lambda r: r["part"]):
        if r["documents"]:
            out.append(Part(r["path"], r["documents"], r["ids"], first))
            first += r["ids"]
    return TokenFiles(length, out)


def read_documents(spark: SparkSession, files: TokenFiles, key: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """One row a document, from the files alone: key, ``start``, ``n_tokens``, ``ids_crc32``, if asked ``ids``."""
    schema = f"{key} long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    parts = files.parts

    def read(frames: Iterable) -> Iterator:
        import pandas as pd
        import pyarrow as pa

        for frame in frames:
            for number in frame["id"]:
                part = parts[number]
                reader = PartReader(part.path)
                with _open(f"{part.path}.docs.arrow") as source:
                    for batch in pa.ipc.open_stream(source):
                        keys, firsts, counts = (batch.column(i) for i in range(3))
                        firsts, counts = firsts.to_numpy(), counts.to_numpy()
                        ids = [reader.ids(a, n) for a, n in zip(firsts.tolist(), counts.tolist(), strict=True)]
                        yield pd.DataFrame(
                            {
                                key: pd.array(keys.to_pylist(), dtype="Int64"),
                                "start": firsts + part.first,
                                "n_tokens": counts,
                                "ids_crc32": [tokens.crc32_of(x) for x in ids],
                            }
                            | ({"ids": [x.astype("<i4") for x in ids]} if with_ids else {})
                        )

    return spark.range(0, len(parts), 1, max(1, len(parts))).mapInPandas(read, schema)
