"""WARC archives: a deduplicating writer, and a reader that salvages what damage leaves whole.

The writer gives each record a gzip member of its own. Records whose payload another record already holds
become revisits without payload. Each task writes its own files to the shared folder under names no other
attempt uses; only the files of successful attempts are listed in the manifest, so lost executors and
repeated tasks leave nothing that a reader sees.

The reader takes a file in pieces and holds no more than one. A record is accepted if its member inflates with the right checksum
(or, uncompressed, if it starts with a version line), its length agrees and its digest fits. Where a
check fails, it searches for the next member or version line that begins a valid record, goes on
there, and logs the bytes between as a quarantined gap.

Folders must be on a file system that pyarrow opens by its address (file, hdfs, s3, gs).
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storelake.llm.shared import scratch_path, stored

MIN_REVISIT_BYTES = 1000
FILE_BYTES = 64 << 20  # A file is closed once it is this large.
PAYLOAD_LIMIT = (1 << 31) - (1 << 20)  # No row holds more bytes.
_PIECE = 1 << 20
_GZIP = b"\x1f\x8b\x08"
_VERSION = b"WARC/1."
_MARK = re.compile(rb"\x1f\x8b\x08|WARC/1[.]")
_END = b"\r\n\r\n"
_HEAD_LIMIT = 64 << 10


def open_folder(address: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(address if "://" in address or address.startswith("file:") else "file://" + address)


def _clean(text: object) -> str:
    """A header value on one line."""
    return "" if text is None else " ".join(str(text).split())


def format_record(page_id: object, url: object, payload: bytes, digest: str, refers_to: object, revisit: bool) -> bytes:
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}"]
    if page_id is not None:
        head.append(f"WARC-Record-ID: <urn:page:{_clean(page_id)}>")
    if url is not None:
        head.append(f"WARC-Target-URI: {_clean(url)}")
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    head.append(f"X-Payload-Length: {len(payload)}")
    if revisit:
        head.append(f"WARC-Refers-To: <urn:page:{_clean(refers_to)}>")
    body = b"" if revisit else payload
    head.append(f"Content-Length: {len(body)}")
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + body + b"\r\n\r\n"


# --- writing ----------------------------------------------------------------------------------


def _revisits(pages: DataFrame, min_bytes: int) -> DataFrame:
    """(page_id, digest) of every page whose payload another page with a larger id holds, with that id."""
    payload = F.coalesce(F.col("html").cast("binary"), F.lit("").cast("binary"))
    # Two unrelated digests and the length stand for the payload, which so is not shuffled.
    slim = pages.select("page_id", F.sha1(payload).alias("digest"), F.sha2(payload, 256).alias("digest2"),
                        F.length(payload).alias("bytes")).filter(F.col("bytes") >= min_bytes)
    held = stored(slim.groupBy("page_id", "digest", "digest2", "bytes").agg(F.count("*").alias("times")), "payloads")
    largest = held.groupBy("digest", "digest2", "bytes").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n"))
    several = largest.filter("n > 1").drop("n")
    return held.join(several, ["digest", "digest2", "bytes"]).filter("page_id < refers_to").select(
        "page_id", "digest", "refers_to")


def write_archives(pages: DataFrame, folder: str, min_bytes: int = MIN_REVISIT_BYTES,
                   file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, html); returns the manifest (path, records, bytes).

    Null html is an empty payload, a missing url column or a null url leaves the address out, a null page_id
    leaves the record id out; other columns are not read. Of records with equal payloads of at least
    ``min_bytes``, that with the largest page_id is the response and the others revisit it. Rows that repeat
    that page_id and payload are responses too, and rows without page_id always are. No rows, no files.
    """
    spark = pages.sparkSession
    revisits = stored(_revisits(pages, min_bytes), "revisits")
    url = F.col("url") if "url" in pages.columns else F.lit(None)
    payload = F.coalesce(F.col("html").cast("binary"), F.lit("").cast("binary"))
    rows = pages.select("page_id", url.cast("string").alias("url"), payload.alias("payload"),
                        F.sha1(payload).alias("digest"))
    rows = rows.join(revisits, ["page_id", "digest"], "left").select("page_id", "url", "payload", "digest", "refers_to")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, root = open_folder(folder)
        files.create_dir(root, recursive=True)
        out, path, records, size = None, "", 0, 0
        for batch in batches:
            for row in batch.astype(object).where(batch.notna(), None).itertuples(index=False):
                if out is None:
                    path, records, size = f"part-{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = files.open_output_stream(f"{root}/{path}", compression=None)
                pack = zlib.compressobj(6, zlib.DEFLATED, 31)
                payload = bytes(row.payload)
                record = format_record(row.page_id, row.url, payload, row.digest, row.refers_to, row.refers_to is not None)
                member = pack.compress(record) + pack.flush()
                out.write(member)
                records, size = records + 1, size + len(member)
                if size >= file_bytes:
                    out.close()
                    out = None
                    yield pd.DataFrame({"path": [path], "records": [records], "bytes": [size]})
        if out is not None:
            out.close()
            yield pd.DataFrame({"path": [path], "records": [records], "bytes": [size]})

    # Ids as text, so that a null among them does not turn numbers into floats on the way.
    rows = rows.withColumns({c: F.col(c).cast("string") for c in ("page_id", "refers_to")})
    listed = rows.mapInPandas(run, "path string, records long, bytes long")
    where = f"{folder.rstrip('/')}-manifest"
    listed.write.parquet(where)
    return spark.read.schema(listed.schema).parquet(where)


# --- salvage ----------------------------------------------------------------------------------


class Source:
    """A file as bytes at offsets. A window of bounded size is held, so that going back costs a read, not memory."""

    def __init__(self, stream):
        self.stream, self.start, self.held = stream, 0, b""
        stream.seek(0, 2)
        self.size = stream.tell()

    def get(self, at: int, size: int) -> bytes:
        if not self.start <= at <= at + size <= self.start + len(self.held) and at < self.size:
            self.stream.seek(at)
            self.start, self.held = at, self.stream.read(max(size, _PIECE))
        return self.held[max(at - self.start, 0):at - self.start + size] if at < self.size else b""

    def mark(self, at: int) -> int:
        """Offset of the next member or version line from ``at``, the end of the file if there is none."""
        while at < self.size:
            piece = self.get(at, max(_PIECE, len(_VERSION)))
            found = _MARK.search(piece)
            if found:
                return at + found.start()
            at += max(len(piece) - len(_VERSION) + 1, 1)
        return self.size


class Damage(Exception):
    """A check that failed."""


class _Plain:
    """The bytes of an uncompressed record, in pieces."""

    def __init__(self, source: Source, at: int):
        self.source, self.after = source, at

    def read(self, most: int) -> bytes:
        piece = self.source.get(self.after, min(most, _PIECE))
        self.after += len(piece)
        return piece

    def expect(self, size: int) -> None:
        """Fail early where the record cannot end ``size`` bytes on."""
        if self.source.get(self.after + size, 4) != _END:
            raise Damage("length")

    def close(self) -> None:
        pass


class _Member:
    """The bytes of a gzip member, inflated in pieces."""

    def __init__(self, source: Source, at: int):
        self.source, self.after = source, at
        self.inflate, self.waiting = zlib.decompressobj(31), b""

    def read(self, most: int) -> bytes:
        while not self.inflate.eof:
            if not self.waiting:
                self.waiting = self.source.get(self.after, _PIECE // 4)
                if not self.waiting:
                    raise Damage("cut off")
            try:
                out = self.inflate.decompress(self.waiting, most)
            except zlib.error as error:
                raise Damage("member") from error
            rest = self.inflate.unused_data if self.inflate.eof else self.inflate.unconsumed_tail
            self.after += len(self.waiting) - len(rest)
            self.waiting = rest
            if out:
                return out
        return b""

    def expect(self, size: int) -> None:
        pass

    def close(self) -> None:
        """The member must end where the record does; its checksum is read on the way."""
        if self.read(1):
            raise Damage("length")


def _fields(head: bytes) -> dict[str, str]:
    out = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise Damage("header line")
        out[name.strip().lower()] = value.strip()
    return out


def _number(value: str | None) -> int | None:
    """A header's number; None where it is none, or has more digits than any length."""
    return int(value) if value and value.isascii() and value.isdigit() and len(value) <= 18 else None


def _parsed(body: _Plain | _Member, keep: bool) -> dict:
    """The record that begins a stream of bytes, read in pieces; raises Damage if any check fails."""
    head = b""
    while _END not in head:
        piece = body.read(4096)
        if not piece or len(head) > _HEAD_LIMIT or not (head + piece).startswith(_VERSION[:len(head + piece)]):
            raise Damage("no header")
        head += piece
    head, _, held = head.partition(_END)
    fields = _fields(head)
    length = _number(fields.get("content-length"))
    if length is None:
        raise Damage("no length")
    body.expect(length - len(held))
    digest, kept, left = hashlib.sha1(), [], length
    while left > 0:
        held = held or body.read(min(left, _PIECE))
        if not held:
            raise Damage("length")
        piece, held = held[:left], held[left:]
        digest.update(piece)
        left -= len(piece)
        if keep and length < PAYLOAD_LIMIT:
            kept.append(piece)
    while len(held) < len(_END):
        piece = body.read(len(_END) - len(held))
        if not piece:
            raise Damage("length")
        held += piece
    if held[:len(_END)] != _END or isinstance(body, _Member) and len(held) > len(_END):
        raise Damage("length")
    if isinstance(body, _Plain):
        body.after -= len(held) - len(_END)
    body.close()
    kind = fields.get("warc-type", "")
    name, _, claimed = fields.get("warc-payload-digest", "").partition(":")
    if kind != "revisit" and name == "sha1" and digest.hexdigest() != claimed.lower():
        raise Damage("digest")
    return {"fields": fields, "type": kind, "payload": b"".join(kept) if keep and length < PAYLOAD_LIMIT else None,
            "bytes": length, "digest": claimed.lower() if kind == "revisit" else digest.hexdigest()}


def _record(source: Source, at: int, keep: bool) -> tuple[dict, int]:
    """The record at an offset and the offset after it."""
    start = source.get(at, len(_VERSION))
    if not start.startswith(_GZIP) and start != _VERSION:
        raise Damage("neither member nor version line")
    body = _Member(source, at) if start.startswith(_GZIP) else _Plain(source, at)
    return _parsed(body, keep), body.after


def salvage(stream: object, keep: bool = True) -> Iterator[tuple[str, int, int, object]]:
    """("record", start, end, record) and ("gap", start, end, reason), in order, over all bytes of a seekable file.

    Memory is that of a piece, and of one payload with ``keep``, wherever and however long a file is damaged.
    """
    source, at = Source(stream), 0
    while at < source.size:
        try:
            record, after = _record(source, at, keep)
        except Damage as damage:
            after = _next_valid(source, at + 1)
            yield "gap", at, after, str(damage)
        else:
            yield "record", at, after, record
        at = after


def _next_valid(source: Source, at: int) -> int:
    """Offset of the next valid record, or the end of the file."""
    while True:
        at = source.mark(at)
        if at >= source.size:
            return source.size
        try:
            _record(source, at, False)
        except Damage:
            at += 1
        else:
            return at


def _bare(value: str | None) -> str | None:
    return value.removeprefix("<urn:page:").removesuffix(">") if value else None


def read_archives(listed: DataFrame, folder: str, payloads: bool = True, whole: bool = False) -> tuple[DataFrame, DataFrame]:
    """The records (page_id, url, record_type, payload, payload_digest, payload_bytes, refers_to) and the gaps.

    ``listed`` has a column path, relative to the folder. The gaps are (path, start, end, reason). Both are
    read from the archives when used. Ids are text as they stand in the records; a header that is missing
    or holds no number gives null. A payload of 2 GB or more, which no row can hold, is null, as all are without
    ``payloads``; its digest and length are those of the record. With ``whole`` a gap, or a number of
    records other than the column records says, is an error. No paths, no rows.
    """
    def found(wanted: str):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            files, root = open_folder(folder)
            for batch in batches:
                for path, expected in zip(batch["path"], batch["records"] if whole else batch["path"]):
                    rows, size, records = [], 0, 0
                    with files.open_input_file(f"{root}/{path}") as stream:
                        for kind, start, end, what in salvage(stream, payloads and wanted == "record"):
                            records += kind == "record"
                            if whole and kind == "gap":
                                raise RuntimeError(f"{path}: damage from {start} to {end}: {what}")
                            if kind != wanted:
                                continue
                            if kind == "gap":
                                rows.append((path, start, end, what))
                            else:
                                fields, revisit = what["fields"], what["type"] == "revisit"
                                rows.append((
                                    _bare(fields.get("warc-record-id")), fields.get("warc-target-uri"), what["type"],
                                    None if revisit else what["payload"], what["digest"],
                                    _number(fields.get("x-payload-length")) if revisit else what["bytes"],
                                    _bare(fields.get("warc-refers-to"))))
                                size += len(what["payload"] or b"")
                            if size >= _PIECE or len(rows) >= 1000:
                                yield pd.DataFrame(rows, columns=columns)
                                rows, size = [], 0
                    if whole and records != expected:
                        raise RuntimeError(f"{path}: {records} records, {expected} were written")
                    if rows:
                        yield pd.DataFrame(rows, columns=columns)
        kinds = {"gap": "path string, start long, end long, reason string",
                 "record": "page_id string, url string, record_type string, payload binary, payload_digest string, "
                           "payload_bytes long, refers_to string"}[wanted]
        columns = [c.split()[0] for c in kinds.split(", ")]
        return spread.mapInPandas(run, kinds)
    # A task for each file or few: the list itself is too small to be split by size.
    spread = listed.select("path", *["records"] * whole).repartition(min(max(listed.count(), 1), 10_000))
    return found("record"), found("gap")


def archived_pages(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write all pages, read the archives back: (page_id, payload_bytes, payload_digest, record_type, refers_to) per page.

    Null html is an empty payload; of equal payloads the largest page_id is the response, and rows that
    repeat it, or have no page_id, are responses too. An empty table gives no rows; other columns are not read.
    Payloads are read in pieces, however long. A record that does not come back whole is an error.
    """
    folder = folder or scratch_path(pages.sparkSession, "warc")
    records, _ = read_archives(write_archives(pages, folder), folder, payloads=False, whole=True)
    ids = pages.schema["page_id"].dataType
    return records.select(F.col("page_id").cast(ids).alias("page_id"), "payload_bytes", "payload_digest",
                          "record_type", F.col("refers_to").cast(ids).alias("refers_to"))
