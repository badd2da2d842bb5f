"""WARC archives: writer and sequential reader.

Every record is a gzip member of its own. The reader takes an archive from
front to back: it inflates piece by piece, frames each record by its
Content-Length, and checks the block and payload digests as the bytes pass.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.llm.store import written
from ordermill.session import scratch_path

#: A new archive is begun once one has so many bytes.
ARCHIVE_BYTES = 64 << 20
#: Payloads of at least so many bytes are compared.
LEAST_BYTES = 0
PIECE = 1 << 16
#: Fixed values of the format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"

READ_COLUMNS = ("archive string, position long, record_id string, record_type string, refers_to string, target_uri string, "
                "payload_bytes long, payload_digest string, payload binary, error string")


def digest(data: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _line(value: str) -> str:
    """A header value without line breaks and other controls."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def record(record_id: str, kind: str, payload: bytes, uri: str | None = None, refers_to: str | None = None) -> bytes:
    """One record as a gzip member. A revisit holds the HTTP head only; its Content-Length is that of the payload."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<{record_id}>"), ("WARC-Date", DATE), ("WARC-Payload-Digest", f"sha1:{digest(payload)}"),
            ("Content-Type", "application/http;msgtype=response")]
    if uri is not None:
        head.append(("WARC-Target-URI", _line(uri)))
    if kind == "revisit":
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{refers_to}>")]
    else:
        block += payload
    head += [("WARC-Block-Digest", f"sha1:{digest(block)}"), ("Content-Length", str(len(block)))]
    press = zlib.compressobj(6, zlib.DEFLATED, 31)
    text = VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n"
    return press.compress(text) + press.compress(block) + press.compress(b"\r\n\r\n") + press.flush()


class Damaged(ValueError):
    """An archive that cannot be read on."""


class Members:
    """The bytes of an archive, gzip member by gzip member."""

    def __init__(self, stream: BinaryIO):
        self.stream, self.ahead, self.position = stream, b"", 0
        self.inflate = None
        self.out = b""

    def begin(self) -> bool:
        """Start the next member; False at the end of the archive."""
        if not self.ahead:
            self.ahead = self.stream.read(PIECE)
        if not self.ahead:
            return False
        self.inflate, self.out = zlib.decompressobj(31), b""
        return True

    def more(self, at_most: int = PIECE) -> bytes:
        """The next inflated bytes of the member; empty at its end."""
        while not self.out:
            if self.inflate.eof:
                return b""
            data = self.inflate.unconsumed_tail or self.ahead or self.stream.read(PIECE)
            if not data:
                raise Damaged("truncated member")
            try:
                self.out = self.inflate.decompress(data, PIECE)
            except zlib.error as e:
                raise Damaged(f"damaged member: {e}") from e
            self.ahead = self.inflate.unused_data if self.inflate.eof else b""
            self.position += len(data) - len(self.ahead if self.inflate.eof else self.inflate.unconsumed_tail)
        got, self.out = self.out[:at_most], self.out[at_most:]
        return got

    def back(self, data: bytes) -> None:
        self.out = data + self.out


def _head(source: Members, end: bytes = b"\r\n\r\n", start: bytes = b"WARC/") -> bytes:
    """The record header, of any length; a member that does not start like a record is not searched."""
    got, seen = [], b""
    while True:
        piece = source.more()
        if not piece:
            raise Damaged("no end of the header")
        # The end mark may begin in the piece before.
        seen = seen[1 - len(end):] + piece
        got.append(piece)
        if len(got) == 1 and not piece.startswith(start[:len(piece)]):
            raise Damaged("no WARC record")
        if end in seen:
            break
    head, rest = b"".join(got).split(end, 1)
    source.back(rest)
    return head


def _fields(head: bytes) -> dict[str, str]:
    out = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        out[name.strip().lower()] = value.strip()
    return out


def _bare(value: str | None) -> str | None:
    return value.strip("<>") if value else None


def read_record(source: Members, keep_payload: bool) -> dict:
    """The record at the start of the current member, to the member's end."""
    head = _head(source)
    if not head.startswith(b"WARC/"):
        raise Damaged("no WARC record")
    f = _fields(head)
    try:
        length = int(f["content-length"])
    except (KeyError, ValueError) as e:
        raise Damaged("no content length") from e
    kind = f.get("warc-type")
    block, payload, kept = hashlib.sha1(), hashlib.sha1(), []
    http, n_payload, left = b"", 0, length
    in_payload = not f.get("content-type", "").startswith("application/http")
    while left:
        piece = source.more(min(left, PIECE))
        if not piece:
            raise Damaged("the member ends within the block")
        left -= len(piece)
        block.update(piece)
        if not in_payload:
            http += piece
            if b"\r\n\r\n" not in http:
                continue
            http, piece = http.split(b"\r\n\r\n", 1)
            in_payload = True
        payload.update(piece)
        n_payload += len(piece)
        if keep_payload:
            kept.append(piece)
    tail = b""
    while piece := source.more():
        tail += piece
        if len(tail) > 4:
            raise Damaged("more than one record in a member")
    b32 = lambda h: base64.b32encode(h.digest()).decode()
    errors = []
    if tail != b"\r\n\r\n":
        errors.append("record not closed")
    if (said := f.get("warc-block-digest", "").removeprefix("sha1:")) and said != b32(block):
        errors.append("block digest differs")
    said = f.get("warc-payload-digest", "").removeprefix("sha1:")
    if kind == "revisit":  # its payload is elsewhere; the HTTP head tells the length
        n_payload = int(_fields(http).get("content-length", 0))
    elif said and said != b32(payload):
        errors.append("payload digest differs")
    return {"record_id": _bare(f.get("warc-record-id")), "record_type": kind, "refers_to": _bare(f.get("warc-refers-to")), "target_uri": f.get("warc-target-uri"),
            "payload_bytes": n_payload, "payload_digest": said if kind == "revisit" else b32(payload),
            "payload": b"".join(kept) if keep_payload and kind != "revisit" else None, "error": "; ".join(errors) or None}


def read_archive(stream: BinaryIO, keep_payload: bool = True) -> Iterator[dict]:
    """All records of an archive in order, with their ``position``. What makes the rest unreadable
    (a damaged or cut member) gives a last row with only ``position`` and ``error``."""
    source = Members(stream)
    while True:
        at = source.position
        try:
            if not source.begin():
                return
            yield read_record(source, keep_payload) | {"position": at}
        except Damaged as e:
            yield {"position": at, "error": str(e)}
            return


def _file_system(path: str):
    return pyarrow.fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path) if path.startswith("file:") else path)


def _page(page_id) -> str:
    return f"urn:page:{'none' if page_id is None else page_id}"


def _writer(folder: str, archive_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _file_system(folder)
        out, name, size, done = None, "", 0, []
        for batch in batches:
            for page_id, url, html, kind, refers in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc.gz"  # another one for each attempt of a task
                    out, size = fs.open_output_stream(f"{base}/{name}", compression=None), 0
                data = record(_page(page_id), kind, (html or "").encode("utf-8"), url, _page(refers))
                out.write(data)
                size += len(data)
                if size >= archive_bytes:
                    out.close()
                    done.append((name, size))
                    out = None
        if out is not None:
            out.close()
            done.append((name, size))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{n}" for n, _ in done]), pa.array([s for _, s in done], pa.int64())], ["archive", "bytes"])
    return run


def with_revisits(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """``page_id``, ``url``, ``html``, ``record_type``, ``refers_to`` of every page.

    Of equal payloads of at least ``least_bytes``, those with the largest
    ``page_id`` are responses and the others revisit it. Payloads are equal if
    SHA-1 and length are. A null ``page_id`` is below all others; rows that
    repeat a page are all written, each as its page says.
    """
    p = pages.select("page_id", "url", "html")
    payload = F.coalesce("html", F.lit(""))
    p = p.withColumn("sha", F.sha1(payload.cast("binary"))).withColumn("size", F.octet_length(payload))
    # Only payloads that occur more than once have to meet their pages.
    copies = (p.filter(F.col("size") >= least_bytes).groupBy("sha", "size").agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n"))
              .filter("n > 1 and last is not null").select("sha", "size", "last"))
    again = F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last"))
    return p.join(copies, ["sha", "size"], "left").select(
        "page_id", "url", "html", F.when(again, "revisit").otherwise("response").alias("record_type"), F.when(again, F.col("last")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, least_bytes: int = LEAST_BYTES, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record per page to archives in ``folder`` (a file system that pyarrow and all executors
    reach); returns the list of finished archives: ``archive``, ``bytes``.

    Null html is an empty payload, a null url leaves its header out; other
    columns are ignored. Archives of failed attempts are in no list. An empty
    table gives no archive.
    """
    fs, base = _file_system(folder)
    fs.create_dir(base, recursive=True)
    rows = with_revisits(pages, least_bytes)
    return written(rows.mapInArrow(_writer(folder, archive_bytes), "archive string, bytes long"), "archives")


def _reader(keep_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in READ_COLUMNS.split(", ")]
        kinds = [{"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[c.split()[1]] for c in READ_COLUMNS.split(", ")]

        def batch_of(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], k) for n, k in zip(names, kinds, strict=True)], names)

        for batch in batches:
            for path in batch.column("archive").to_pylist():
                fs, at = _file_system(path)
                rows, held = [], 0
                with fs.open_input_stream(at, compression=None) as stream:
                    for r in read_archive(stream, keep_payload):
                        rows.append(r | {"archive": path})
                        held += len(r.get("payload") or b"") + len(r.get("target_uri") or "")
                        if len(rows) >= 2000 or held >= 16 << 20:
                            yield batch_of(rows)
                            rows, held = [], 0
                if rows:
                    yield batch_of(rows)
    return run


def read_archives(archives: DataFrame, keep_payload: bool = True, tasks: int = 10_000) -> DataFrame:
    """All records of the archives listed in ``archive``, in READ_COLUMNS.

    Each archive is read by one task from front to back. ``error`` tells of a
    digest that differs or a record not closed; a damaged archive ends in a row with
    ``position`` and ``error`` only. A revisit has the digest and length of
    the payload it stands for. A null payload means a revisit or that ``keep_payload`` is off.
    """
    paths = archives.select("archive").filter("archive is not null")
    n = paths.count()
    return paths.repartition(max(1, min(n, tasks))).mapInArrow(_reader(keep_payload), READ_COLUMNS)


def page_number(record_id: str) -> F.Column:
    """The page_id in a record id that the writer made."""
    return F.regexp_extract(record_id, r"^urn:page:(-?\d+)$", 1).try_cast("long")


def round_trip(spark: SparkSession, pages: DataFrame, keep_payload: bool = True, **options) -> DataFrame:
    """Write the pages to archives in a new shared folder and read those back."""
    return read_archives(write_archives(pages, scratch_path(spark, "warc"), **options), keep_payload)
