"""WARC archives: a writer with revisit records and a reader that salvages.

Every record is written as a gzip member of its own; the reader also takes members of
many records and plain records. It checks each member (gzip trailer) and each record in
it (version line, headers, content length, block digest); after a failed check it
searches for the next offset at which a member or a version line starts a record that
passes, goes on from there, and logs the bytes between as a gap.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bit_table, fs_of, in_filter, publish, written

VERSION = b"WARC/1.1"
MEMBER = b"\x1f\x8b\x08"
#: Payloads of fewer bytes are always written whole.
LEAST_BYTES = 1000
#: Compressed bytes after which a writer begins a new archive.
ARCHIVE_BYTES = 64 << 20
#: Bytes of a read, and of what is inflated at a time.
CHUNK = 1 << 20
#: Tasks that archives are dealt to at most.
READ_TASKS = 4096
_START = re.compile(rb"\x1f\x8b\x08|WARC/(?:0\.\d{1,2}|1\.[01])\r?\n")
_VERSION_LINE = re.compile(rb"WARC/(?:0\.\d{1,2}|1\.[01])\r?\n")


class Record(NamedTuple):
    """``offset`` and ``length`` are of the member (of a plain record: its own), ``inner`` is the place in the inflated member."""

    offset: int
    length: int
    headers: dict[str, str]
    block: bytes
    inner: int = 0


class Gap(NamedTuple):
    offset: int
    length: int
    reason: str


class Broken(ValueError):
    """A failed check; ``end`` is where the record ends if its frame is whole."""

    def __init__(self, reason: str, end: int | None = None):
        super().__init__(reason)
        self.end = end


def record_bytes(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [VERSION, *(f"{k}: {v}".encode() for k, v in headers), b"Content-Length: %d" % len(block)]
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(raw: bytes, level: int = 4) -> bytes:
    made = zlib.compressobj(level, zlib.DEFLATED, 31)
    return made.compress(raw) + made.flush()


def stated_digest(value: str) -> tuple[str, bytes] | None:
    """Algorithm and bytes of a digest header such as ``sha1:...``, in hexadecimal, Base32 or Base64; None if it can't be told."""
    name, _, text = value.partition(":")
    name, text = name.strip().lower().replace("-", ""), text.strip()
    if name not in ("md5", "sha1", "sha224", "sha256", "sha384", "sha512"):
        return None
    size, bare = hashlib.new(name).digest_size, text.rstrip("=")
    try:
        if len(text) == 2 * size:
            return name, bytes.fromhex(text)
        if len(bare) == -(-8 * size // 5):
            return name, base64.b32decode(bare + "=" * (-len(bare) % 8), casefold=True)
        if len(bare) == -(-8 * size // 6):
            return name, base64.b64decode(bare.replace("-", "+").replace("_", "/") + "=" * (-len(bare) % 4), validate=True)
    except ValueError:
        pass
    return None


class _Source:
    """Byte ranges of a file, through one window that moves."""

    def __init__(self, file, size: int):
        self.file, self.size, self.at, self.held = file, size, 0, b""

    def read(self, start: int, count: int) -> bytes:
        count = min(count, self.size - start)
        if not (self.at <= start and start + count <= self.at + len(self.held)):
            self.file.seek(start)
            self.at, self.held = start, self.file.read(max(count, CHUNK))
        return self.held[start - self.at : start - self.at + count]


def _inflated(source: _Source, offset: int) -> Iterator[tuple[bytes, int]]:
    """Pieces of the member at ``offset``, each with the end of the input used so far; Broken if it is damaged."""
    inflate, at = zlib.decompressobj(31), offset
    while not inflate.eof:
        some = source.read(at, CHUNK) if at < source.size else b""
        if not some:
            raise Broken("gzip: the member is cut short")
        at += len(some)
        while some and not inflate.eof:
            try:
                out = inflate.decompress(some, CHUNK)
            except zlib.error as e:
                raise Broken(f"gzip: {e}") from None
            some = inflate.unconsumed_tail
            yield out, at - len(inflate.unused_data) - len(some)


class _Member:
    """Forward reads of an inflated member of a known size, or of what can be inflated of a damaged one."""

    def __init__(self, source: _Source, offset: int, size: int, held: bytes | None):
        self.pieces, self.at, self.size = (iter(()) if held is not None else _inflated(source, offset)), 0, size
        self.held = bytearray(held or b"")

    def read(self, start: int, count: int) -> bytes:
        count = min(count, self.size - start)
        while self.at + len(self.held) < start + count:
            piece = next(self.pieces, None)
            if piece is None:
                break
            self.held += piece[0]
            if (gone := min(start - self.at, len(self.held))) > CHUNK:
                del self.held[:gone]
                self.at += gone
        return bytes(self.held[start - self.at : start - self.at + count])


def _headers(data: _Source | _Member, at: int) -> tuple[dict[str, str], int]:
    """Headers (names in lower case, folded lines joined) of the record at ``at`` and the start of its block."""
    size = 4096
    while True:
        head = data.read(at, size)
        if not _VERSION_LINE.match(head):
            raise Broken("no version line")
        end = head.find(b"\r\n\r\n")
        lines = (head[:end] if end >= 0 else head).split(b"\r\n")[1:]
        # the last line may go on beyond what was read; any other that can't be a header ends the search
        if any(b":" not in x and x[:1] not in (b" ", b"\t") for x in (lines if end >= 0 else lines[:-1])):
            raise Broken("a header without a colon")
        if end >= 0:
            break
        if len(head) < size:
            raise Broken("no end of headers")
        size *= 2
    headers, last = {}, None
    for line in lines:
        if line[:1] in (b" ", b"\t"):
            if last is None:
                raise Broken("the first header is a folded line")
            headers[last] = f"{headers[last]} {line.decode('utf-8', 'replace').strip()}".strip()
        else:
            name, _, value = line.partition(b":")
            last = name.decode("latin-1").strip().lower()
            headers[last] = value.decode("utf-8", "replace").strip()
    return headers, at + end + 4


def record_at(data: _Source | _Member, at: int) -> tuple[dict[str, str], bytes, int]:
    """Headers, block and end of the record that starts at ``at``; Broken if a check fails."""
    headers, start = _headers(data, at)
    if not re.fullmatch(r"\d{1,15}", headers.get("content-length", "")):
        raise Broken("no content length")
    size = int(headers["content-length"])
    if start + size + 4 > data.size:
        raise Broken("the block is cut short")
    block = data.read(start, size)
    if len(block) < size or data.read(start + size, 4) != b"\r\n\r\n":
        raise Broken("the block is cut short or doesn't end where it should")
    stated = stated_digest(headers.get("warc-block-digest", ""))  # one that can't be told isn't verified
    if stated and hashlib.new(stated[0], block).digest() != stated[1]:
        raise Broken("the block has another digest", start + size + 4)
    return headers, block, start + size + 4


def _member_records(source: _Source, offset: int) -> Iterator[Record | Gap]:
    """Records of the member at ``offset`` and what it holds besides, the end of the member last as an empty Gap; Broken if it is damaged.

    The trailer is checked before any record is given out. Of a damaged member, records
    whose block digest holds are given out before the error.
    """
    held, size, end, damage = [], 0, offset, None
    try:
        for piece, end in _inflated(source, offset):
            size += len(piece)
            if size <= CHUNK:
                held.append(piece)
    except Broken as e:
        damage = e
    data, at = _Member(source, offset, size, b"".join(held) if size <= CHUNK else None), 0
    length = end - offset
    while at < size:
        try:
            headers, block, to = record_at(data, at)
        except Broken as e:
            if damage is None:
                yield Gap(offset, length, f"in the member: {e}")
            to = e.end
            while to is None or to < size and not _VERSION_LINE.match(data.read(to, 16)):
                at = at + 1 if to is None else to + 1
                some = data.read(at, CHUNK)
                found = _VERSION_LINE.search(some)
                to = at + found.start() if found else size if at + len(some) >= size else at + len(some) - 17
        else:
            if damage is None or stated_digest(headers.get("warc-block-digest", "")):
                yield Record(offset, length, headers, block, at)
        at = to
    if damage is not None:
        raise damage
    if not size:
        yield Gap(offset, length, "in the member: nothing")
    yield Gap(end, 0, "")


def salvage(file, size: int) -> Iterator[Record | Gap]:
    """All records that pass the checks, and the gaps between them, in order.

    A plain record whose frame is whole but whose digest fails is a gap to its end, so that
    nothing inside its payload is taken for a record.
    """
    source, at, gap, why = _Source(file, size), 0, None, ""
    while at < size:
        to, error = None, None
        try:
            if source.read(at, 3) == MEMBER:
                for x in _member_records(source, at):
                    if isinstance(x, Gap) and not x.length:
                        to = x.offset
                        break
                    if gap is not None:
                        yield Gap(gap, at - gap, why)
                        gap = None
                    yield x
            else:
                headers, block, to = record_at(source, at)
                if gap is not None:
                    yield Gap(gap, at - gap, why)
                    gap = None
                yield Record(at, to - at, headers, block)
        except Broken as e:
            to, error = e.end, str(e)
        if error is not None and gap is None:
            gap, why = at, error
        at = _next_start(source, at + 1) if to is None else to
    if gap is not None:
        yield Gap(gap, size - gap, why)


def _next_start(source: _Source, at: int) -> int:
    """The next offset that looks like a member or a version line; the size if there is none."""
    while at < source.size:
        some = source.read(at, CHUNK)
        if found := _START.search(some):
            return at + found.start()
        if at + len(some) >= source.size:
            break
        at += max(1, len(some) - 16)  # a start may lie across the border
    return source.size


def mark_revisits(pages: DataFrame, least: int = LEAST_BYTES, key: str = "page_id", payload: str = "html", uri: str | None = None) -> DataFrame:
    """``key``, ``payload`` (binary, null: empty), ``uri`` (null without the column), ``digest`` and ``refers_to``.

    Of rows with equal payloads of at least ``least`` bytes, those with the largest key
    hold it; the others refer to that key. Rows with a null key refer to the largest
    key, or hold their payload if there is none. Other columns are not used. Only payloads
    that occur twice (and few others) are shuffled; a frequent one is a skewed side that
    adaptive execution splits. Very long payloads are one row each.
    """
    target = F.col(uri).cast("string") if uri else F.lit(None).cast("string")
    rows = pages.select(F.col(key).cast("long").alias(key), F.coalesce(F.col(payload).cast("binary"), F.lit(b"")).alias("payload"), target.alias("uri"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    large = F.octet_length("payload") >= least
    held = rows.where(large).groupBy("digest").agg(F.max(key).alias("holder"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "holder")
    held = written(held, "holders")
    twice = large & in_filter(F.col("digest"), bit_table(held, "digest"))
    columns = [key, "payload", "uri", "digest"]
    some = rows.where(twice).join(held, "digest", "left").select(*columns, F.when(~F.col(key).eqNullSafe(F.col("holder")), F.col("holder")).alias("refers_to"))
    return rows.where(~twice).select(*columns, F.lit(None).cast("long").alias("refers_to")).unionByName(some)


def write_archives(pages: DataFrame, folder: str, key: str = "page_id", archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write rows of ``mark_revisits`` to archives; one row an archive: path, records, bytes. Runs at once.

    The list of archives is a table in the shared folder, not on the driver. An empty
    table gives no archive.
    """

    def write(frames: Iterable) -> Iterator:
        import pandas as pd
        from pyspark import TaskContext

        part, number, held, size, done = TaskContext.get().partitionId(), 0, [], 0, []

        def close():
            nonlocal number, held, size
            path = f"{folder}/part-{part:06d}-{number:04d}.warc.gz"
            members = held
            publish(path, lambda out: [out.write(m) for m in members])
            done.append((path, len(members), size))
            number, held, size = number + 1, [], 0

        for frame in frames:
            for k, payload, uri, digest, refers in zip(frame[key].astype("Int64"), frame["payload"], frame["uri"], frame["digest"], frame["refers_to"].astype("Int64"), strict=True):
                revisit = refers is not pd.NA
                block = b"" if revisit else bytes(payload)
                name = "null" if k is pd.NA else int(k)
                headers = [
                    ("WARC-Type", "revisit" if revisit else "response"),
                    ("WARC-Record-ID", f"<urn:page:{name}>"),
                    ("WARC-Target-URI", " ".join(uri.split()) if isinstance(uri, str) and uri.strip() else f"urn:page:{name}"),
                    ("WARC-Date", "1970-01-01T00:00:00Z"),
                    ("WARC-Payload-Digest", f"sha1:{digest}"),
                    ("WARC-Payload-Length", str(len(payload))),
                    ("WARC-Block-Digest", f"sha1:{digest if not revisit else hashlib.sha1(block).hexdigest()}"),
                ]
                if revisit:
                    headers += [("WARC-Refers-To", f"<urn:page:{int(refers)}>"), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
                made = member(record_bytes(headers, block))
                held.append(made)
                size += len(made)
                if size >= archive_bytes:
                    close()
        if held:
            close()
        yield pd.DataFrame(done, columns=["path", "records", "bytes"]).astype({"path": object, "records": "int64", "bytes": "int64"})

    return written(pages.mapInPandas(write, "path string, records long, bytes long"), "archives")


def read_archives(spark: SparkSession, archives: DataFrame, with_block: bool = False) -> DataFrame:
    """Records and gaps of archives (a column ``path``), dealt to at most ``READ_TASKS`` tasks, one archive at a time.

    ``kind`` is record or gap; a gap has ``reason`` and no headers. ``payload_digest``
    and ``payload_bytes`` are those of the full payload; of a response, they are
    computed from its block.
    """
    fields = "path string, kind string, offset long, length long, reason string, record_type string, record_id string, target string, refers_to string, payload_digest string, payload_bytes long"
    names = [x.split()[0] for x in fields.split(", ")] + ["block"] * with_block

    def read(frames: Iterable) -> Iterator:
        import pandas as pd

        def frame_of(out):
            return pd.DataFrame.from_records(out, columns=names).astype({"payload_bytes": "Int64"})

        for frame in frames:
            for path in frame["path"]:
                system, place = fs_of(path)
                out, held = [], 0
                with system.open_input_file(place) as file:
                    for x in salvage(file, file.size()):
                        if isinstance(x, Gap):
                            out.append((path, "gap", x.offset, x.length, x.reason, None, None, None, None, None, None) + (None,) * with_block)
                        else:
                            h = x.headers
                            if h.get("warc-type") == "response":
                                digest, size = hashlib.sha1(x.block).hexdigest(), len(x.block)
                            else:
                                digest, size = h.get("warc-payload-digest", "").removeprefix("sha1:") or None, int(h["warc-payload-length"]) if "warc-payload-length" in h else None
                            out.append((path, "record", x.offset, x.length, None, h.get("warc-type"), h.get("warc-record-id"), h.get("warc-target-uri"), h.get("warc-refers-to"), digest, size) + (x.block,) * with_block)
                            held += len(x.block) if with_block else 0
                        if len(out) >= 4096 or held > 16 << 20:
                            yield frame_of(out)
                            out, held = [], 0
                yield frame_of(out)

    n = max(1, min(archives.count(), READ_TASKS))
    return archives.select("path").repartition(n).mapInPandas(read, fields + (", block binary" if with_block else ""))


def page_of(column: Column) -> Column:
    """The number in ``urn:page:N``; null if there is none."""
    return F.regexp_extract(column, r"urn:page:(-?\d+)", 1).try_cast("long")
