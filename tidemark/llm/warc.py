"""WARC archives: a writer of one gzip member per record, and a splittable reader.

The reader deals byte ranges of the archives to tasks.  A task looks for the gzip magic in its range, takes a
candidate for a record only if it inflates to a WARC version line and header, and
owns the records that start inside its range, reading on past its end to finish the last.  After a record
it goes on at the member's end.  Only a range that begins inside a record whose payload itself holds a whole
gzip member with a WARC record, kept as it is by the compressor, could take that for a record of its own; payloads
written here are UTF-8 text, in which the magic can't occur.

Archives are written and read through ``pyarrow.fs``, by URI, so the folder may be any store that
knows (``file:``, ``hdfs:``, ``s3:``, ``gs:``).  Each task attempt writes a file of its own name and reports
it; only reported files are read, so a lost or repeated attempt leaves nothing behind in the result.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_path

from .common import map_arrow, ship, slices, stage

#: Bytes of an archive that a reading task owns.
RANGE_BYTES = 4 << 20
#: Payloads from this size on are written once; copies revisit the first.
REVISIT_BYTES = 100
_MAGIC = b"\x1f\x8b\x08"
_READ, _STEP = 1 << 18, 1 << 13
#: Bytes of a member that are inflated first; a header block may be longer.
_HEADER_BYTES = 1 << 16
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def open_store(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path of a URI (Hadoop's ``s3a:`` is ``s3:`` here)."""
    if "://" not in uri and not uri.startswith("file:"):
        uri = "file://" + uri
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return pafs.FileSystem.from_uri("s3" + uri[3:] if uri.startswith("s3a:") else uri)


def _record(kind: str, record_id: str, url: str, digest: str, length: int, payload: bytes, refers_to: str | None) -> bytes:
    """One WARC/1.1 record; a revisit holds the response's HTTP header without its payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    block = http if kind == "revisit" else http + payload
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<{record_id}>"), ("WARC-Target-URI", _one_line(url)),
            ("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Payload-Digest", f"sha256:{digest}"),
            ("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    if kind == "revisit":
        head += [("WARC-Refers-To", f"<{refers_to}>"), ("WARC-Profile", _REVISIT)]
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n"
    return text.encode() + block + b"\r\n\r\n"


def _one_line(url: str | None) -> str:
    return (url or "").replace("\r", "%0D").replace("\n", "%0A")


def _member(data: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def page_urn(page_id: int | None) -> str:
    return "urn:page:" + ("" if page_id is None else str(page_id))


def with_revisits(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``payload``, ``digest``, ``refers_to`` (null for a response).

    Of equal payloads of ``REVISIT_BYTES`` or more the smallest page_id is the response (of repeated ids,
    each such row); without any id all are responses.
    """
    rows = pages.withColumn("digest", F.sha2("payload", 256))
    shared = (rows.where(F.length("payload") >= REVISIT_BYTES).groupBy("digest")
              .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
              .where("n > 1 and first is not null").select("digest", "first"))
    # The shared digests are written first: where they are few, Spark then needn't shuffle the payloads.
    shared = stage(shared, "warc-shared")
    return (rows.join(shared, "digest", "left")
            .withColumn("refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")))
            .drop("first"))


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html") -> DataFrame:
    """Write a record per row below ``folder``; returns ``path``, ``bytes``, ``records`` of the archives.

    A null payload is empty and a null url blank; line ends in a url are percent-encoded.  A null page_id is
    written as an empty one.  Other columns are ignored; no rows make no archive.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.coalesce(F.col(payload_col).cast("string").cast("binary"), F.lit(b"")).alias("payload"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, records, path = None, 0, ""
        for part in (p for b in batches for p in slices(b)):
            if out is None:
                store, base = open_store(folder)
                store.create_dir(base, recursive=True)
                path = f"{base}/part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.warc.gz"
                out = store.open_output_stream(path, compression=None)
                out.write(_member(b"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:" +
                                  str(uuid.uuid4()).encode() + b">\r\nWARC-Date: 1970-01-01T00:00:00Z\r\n"
                                  b"Content-Type: application/warc-fields\r\nContent-Length: 0\r\n\r\n\r\n\r\n"))
            for r in part.to_pylist():
                refers = r["refers_to"]
                out.write(_member(_record("response" if refers is None else "revisit", page_urn(r["page_id"]), r["url"],
                                          r["digest"], len(r["payload"]), r["payload"],
                                          None if refers is None else page_urn(refers))))
                records += 1
        if out is not None:
            size = out.tell()
            out.close()
            name = f"{folder.rstrip('/')}/{path.rpartition('/')[2]}"
            yield pa.RecordBatch.from_pydict({"path": pa.array([name]), "bytes": pa.array([size], pa.int64()),
                                              "records": pa.array([records], pa.int64())})

    ship(pages.sparkSession)
    decided = with_revisits(rows).select("page_id", "url", "payload", "digest", "refers_to")
    return stage(decided.mapInArrow(run, "path string, bytes long, records long"), "warc-manifest")


class _Window:
    """Bytes of a file from a moving start on, read as they are needed."""

    def __init__(self, handle, start: int):
        self.handle, self.at, self.data = handle, start, b""
        handle.seek(start)

    def more(self) -> bool:
        piece = self.handle.read(_READ)
        self.data += piece
        return bool(piece)

    def drop_to(self, place: int) -> None:
        self.data, self.at = self.data[place - self.at:], place


def _inflate(w: _Window, start: int, limit: int | None = None) -> tuple[bytes, int, bool] | None:
    """The member at ``start``: its bytes (``limit`` at least, if it has them), where reading stopped, and
    whether that is its end; None if it isn't a whole member."""
    z, out, at, size = zlib.decompressobj(31), [], start, 0
    try:
        while not z.eof and (limit is None or size < limit):
            if at - w.at >= len(w.data) and not w.more():
                return None
            piece = w.data[at - w.at:at - w.at + _STEP]
            got = z.decompress(piece)
            out.append(got)
            size += len(got)
            at += len(piece)
    except zlib.error:
        return None
    return b"".join(out), at - len(z.unused_data), z.eof


def _fields(block: bytes) -> tuple[dict[str, str], int] | None:
    """Header fields (lower-case names) and where the block after them begins; None if it isn't a WARC record."""
    end = block.find(b"\r\n\r\n") if block.startswith(b"WARC/1.") else -1
    if end < 0:
        return None
    lines = block[:end].decode("utf-8", "replace").split("\r\n")[1:]
    pairs = [line.partition(":") for line in lines]
    fields = {k.strip().lower(): v.strip() for k, sep, v in pairs if sep}
    if "warc-type" not in fields or not fields.get("content-length", "").isdigit():
        return None
    return fields, end + 4


def read_range(uri: str, start: int, end: int) -> Iterator[tuple[dict[str, str], bytes, int]]:
    """Fields, block and offset of the records that start in ``[start, end)`` of an archive."""
    store, path = open_store(uri)
    with store.open_input_file(path) as handle:
        w, at = _Window(handle, start), start
        while at < end:
            found = w.data.find(_MAGIC, at - w.at)
            if found < 0:
                keep = max(at, w.at + len(w.data) - len(_MAGIC) + 1)
                w.drop_to(keep)
                at = keep
                if not w.more():
                    return
                continue
            at = w.at + found
            if at >= end:
                return
            w.drop_to(at)
            head = _inflate(w, at, _HEADER_BYTES)
            if head is None or not head[0].startswith(b"WARC/1.") or (b"\r\n\r\n" in head[0] and _fields(head[0]) is None):
                at += 1
                continue
            whole = head if head[2] else _inflate(w, at)
            found = whole and _fields(whole[0])
            if not found:  # cut off, or a header without an end
                at += 1
                continue
            fields, body = found
            block = whole[0][body:body + int(fields["content-length"])]
            if len(block) == int(fields["content-length"]):
                yield fields, block, at
            at = whole[1]
            w.drop_to(at)


def ranges(files: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``path``, ``start``, ``end``: byte ranges covering the files of a manifest."""
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(range_bytes).cast("long"))
    return (files.where("bytes > 0").select("path", "bytes", F.explode(starts).alias("start"))
            .select("path", "start", F.least("bytes", F.col("start") + range_bytes).alias("end")))


def read_archives(spark: SparkSession, files: DataFrame, range_bytes: int = RANGE_BYTES,
                  columns: Sequence[str] | None = None) -> DataFrame:
    """Every response and revisit (``columns`` of it, by default all): ``path``, ``offset``, ``record_id``, ``url``, ``record_type``, ``refers_to``,
    ``payload`` (null for a revisit), ``payload_bytes`` and ``payload_digest`` of the full payload.

    The digest of a response is computed from what was read, and a mismatch with its header fails the
    read; a revisit has the ones its record states.  What was read is written to the shared scratch folder, and the
    read fails where an archive gave another number of records than the manifest has.
    """
    def run(batch):
        for row in batch.to_pylist():
            names = ("path", "offset", "record_id", "url", "record_type", "refers_to", "payload", "payload_bytes", "payload_digest")
            out, held = {k: [] for k in names}, 0
            for fields, block, at in read_range(row["path"], row["start"], row["end"]):
                if fields["warc-type"] not in ("response", "revisit"):
                    continue
                head, _, payload = block.partition(b"\r\n\r\n")
                stated = fields.get("warc-payload-digest", "").removeprefix("sha256:")
                revisit = fields["warc-type"] == "revisit"
                if not revisit and hashlib.sha256(payload).hexdigest() != stated:
                    raise ValueError(f"payload digest differs at {at} of {row['path']}")
                length = next((int(x[15:]) for x in head.decode("utf-8", "replace").split("\r\n")
                               if x.lower().startswith("content-length:")), 0)
                for k, v in zip(names, (row["path"], at, fields["warc-record-id"].strip("<>"), fields.get("warc-target-uri"),
                                        fields["warc-type"], fields.get("warc-refers-to", "").strip("<>") or None,
                                        None if revisit else payload, length if revisit else len(payload), stated)):
                    out[k].append(v)
                held += len(payload)
                if held > 8 << 20:
                    yield out
                    out, held = {k: [] for k in names}, 0
            yield out

    dealt = ranges(files, range_bytes)
    parts = dealt.count()
    if parts:
        dealt = dealt.repartition(parts)
    read = map_arrow(dealt, run, "path string, offset long, record_id string, url string, record_type string, "
                                 "refers_to string, payload binary, payload_bytes long, payload_digest string")
    wanted = read.columns if columns is None else list(columns)
    read = stage(read.select(*dict.fromkeys(["path", *wanted])), "warc-read")
    counts = read.groupBy("path").agg(F.count(F.lit(1)).alias("n"))
    lost = (files.groupBy("path").agg(F.max("records").alias("records")).join(counts, "path", "left")
            .where(F.coalesce("n", F.lit(0)) != F.col("records")).head(1))
    if lost:
        raise ValueError(f"{lost[0].n or 0} records read of {lost[0].records} in {lost[0].path}")
    return read.select(*wanted)


def archive_round_trip(pages: DataFrame, folder: str | None = None, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Write ``pages`` (page_id, url, html) and read the archives back: one row per record read.

    Columns: page_id, payload_bytes, payload_digest, record_type, refers_to.  ``folder`` is by default one
    below the shared checkpoint folder.
    """
    spark = pages.sparkSession
    files = write_archives(pages, folder or scratch_path(spark, "warc"))
    read = read_archives(spark, files, range_bytes, ("record_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))

    def number(c):
        digits = F.regexp_extract(F.col(c), r"^urn:page:(-?\d+)$", 1)
        return F.when(digits != "", digits).cast("long")

    return read.select(number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                       number("refers_to").alias("refers_to"))
