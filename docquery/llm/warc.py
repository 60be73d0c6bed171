r"""Legacy archives: ARC files of either version become WARC files.

``write_arc`` makes ARC files of pages, ``convert`` parses the version-specific header lines and declared lengths of
ARC files and synthesises WARC records with identifiers, timestamps, types and digests, and ``read_warc`` reads WARC
files back.  Each record is a gzip member of its own, as in .arc.gz and .warc.gz files.

Of records with equal payloads of ``least`` bytes or more, one is the response and the others are revisits of it: the
one with the highest rank, a number in an HTTP header; ties go to the greatest identifier, and a record without a rank
is below all.  Smaller payloads are all responses.  Null html is an empty payload; a null url is ``unknown:``; a page
without an id has no rank.  Repeated pages are records of their own.  An empty table makes archives without pages.

Files are written by Spark's text writer: a gzip member ends with the high byte of its length, 0 below 16 MiB (else an
empty member follows), and that byte is the writer's line separator.  So archives go to any file system that Spark
writes to, tasks commit their files whole, and a lost executor leaves nothing behind.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LEVEL = 5
RANK_HEADER = "X-Archive-Rank"
LEAST = 1000
# Field lines of the two ARC versions.
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
_DATE = "20200101000000"
#: Bytes that a gzip member is read by.
_PIECE = 1 << 14


def member(raw: bytes) -> bytes:
    """A gzip member that ends with a zero byte."""
    c = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    out = c.compress(raw) + c.flush()
    if out[-1]:
        c = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
        out += c.flush()
    return out


def members(content: bytes) -> Iterator[bytes]:
    """The records of a file of gzip members, one at a time; a plain file is one piece."""
    if content[:2] != b"\x1f\x8b":
        yield content
        return
    view, at = memoryview(content), 0
    while at < len(view):
        d, out = zlib.decompressobj(31), []
        while not d.eof:
            piece = view[at : at + _PIECE]  # what is left of a piece is copied for each member
            if not piece:
                raise ValueError("the last gzip member is cut off")
            out.append(d.decompress(piece))
            at += len(piece) - len(d.unused_data)
        yield b"".join(out)


def _save(rows: DataFrame, path: str) -> None:
    """Rows with ``member`` as files of members; the last byte of each is the separator."""
    rows.select(F.expr("substring(member, 1, length(member) - 1)").cast("string").alias("value")).write.option("lineSep", "\u0000").text(path)


def _field(value: str | None) -> str:
    """Safe in a header line whose fields are split by spaces."""
    return quote(value, safe=":/?#[]@!$&'()*+,;=%~-._", encoding="utf-8") if value else "unknown:"


def arc_record(url: str, date: str, mime: str, block: bytes, version: int, status: int = 200, offset: int = 0, name: str = "-") -> bytes:
    head = [url, "0.0.0.0", date, mime]
    if version == 2:
        head += [str(status), hashlib.sha1(block).hexdigest(), "-", str(offset), name]
    return " ".join([*head, str(len(block))]).encode() + b"\n" + block + b"\n"


def arc_head(version: int, name: str) -> bytes:
    """The version block, itself a record whose length covers the version line and the field line."""
    return arc_record(f"filedesc://{name}", _DATE, "text/plain", f"{version} 0 archive\n{FIELDS[version]}\n".encode(), version, name=name)


def write_arc(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html") -> None:
    """One ARC file for each partition of ``pages``, of version 1 and 2 by turns; the key is kept as the record's rank."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        version, name = 1 + part % 2, f"pages-{part:06d}.arc.gz"
        head = [member(arc_head(version, name))]
        offset = len(head[0])
        for batch in batches:
            out, head = head, []
            for k, u, h in zip(*(batch.column(c).to_pylist() for c in (key, url, html))):
                payload = (h or "").encode()
                rank = f"{RANK_HEADER}: {k}\r\n" if k is not None else ""
                block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {len(payload)}\r\n{rank}\r\n".encode() + payload
                out.append(member(arc_record(_field(u), _DATE, "text/html", block, version, offset=offset, name=name)))
                offset += len(out[-1])
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["member"])
        if head:
            yield pa.RecordBatch.from_arrays([pa.array(head, pa.binary())], ["member"])

    _save(pages.select(key, url, html).mapInArrow(run, "member binary"), path)


def parse_arc(content: bytes) -> Iterator[dict]:
    """The documents of one ARC file; its version block says how a header line is read."""
    names: list[str] = []
    for piece in members(content):
        at = 0
        while at < len(piece):
            if piece[at : at + 1] in (b"\n", b"\r"):
                at += 1
                continue
            line_end = piece.find(b"\n", at)
            if line_end < 0:
                raise ValueError("a header line is cut off")
            line = piece[at:line_end].decode("latin-1").rstrip("\r")
            values = line.split(" ")
            length = int(values[-1])
            block = piece[line_end + 1 : line_end + 1 + length]
            if len(block) < length:
                raise ValueError(f"a record is shorter than declared: {line[:200]}")
            at = line_end + 1 + length
            if line.startswith("filedesc:"):
                version = int(block.split(b" ", 1)[0])
                names = FIELDS[version].split(" ")
                continue
            if not names:
                raise ValueError("a document stands before the version block")
            if len(values) != len(names):  # a space in the first field, which some crawlers left there
                values = [" ".join(values[: len(values) - len(names) + 1]), *values[len(values) - len(names) + 1 :]]
            yield dict(zip(names, values)) | {"block": block}


def split_http(block: bytes) -> tuple[bytes, bytes]:
    """Header with its empty line, and payload."""
    if not block.startswith(b"HTTP/"):
        return b"", block
    m = re.search(rb"\r?\n\r?\n", block)
    return (block[: m.end()], block[m.end() :]) if m else (block, b"")


def http_field(head: bytes, name: str) -> str | None:
    m = re.search(rb"(?im)^" + re.escape(name).encode() + rb":[ \t]*([^\r\n]*)", head)
    return m[1].decode("latin-1").strip() if m else None


def warc_date(date: str) -> str:
    """ARC's digits as a WARC timestamp; older 12-digit dates have no seconds."""
    d = (re.sub(r"\D", "", date) + "0101000000"[max(0, len(date) - 4) :] if len(date) < 14 else date)[:14]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def warc_record(kind: str, record_id: str, date: str, block: bytes, fields: list[tuple[str, str]], mime: str) -> bytes:
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<{record_id}>"), ("WARC-Date", date), *fields, ("Content-Type", mime), ("Content-Length", str(len(block)))]
    return b"WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def base32(sha1: bytes) -> str:
    return "sha1:" + base64.b32encode(sha1).decode()


_RECORD = T.StructType([
    T.StructField("record_id", T.StringType()), T.StructField("uri", T.StringType()), T.StructField("date", T.StringType()),
    T.StructField("digest", T.BinaryType()), T.StructField("size", T.LongType()), T.StructField("rank", T.LongType()),
    T.StructField("head", T.BinaryType()), T.StructField("member", T.BinaryType())])
_RECORD_ARROW = [pa.string(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
_BATCH_BYTES = 8 << 20


def arc_records(spark: SparkSession, path: str, slim: bool) -> DataFrame:
    """Records of all ARC files under ``path``.  ``slim`` leaves out the header and the WARC member of each."""
    schema = T.StructType(_RECORD.fields[: 6 if slim else 8])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column("path"), batch.column("content")):
                name, rows, held = file.as_py().rsplit("/", 1)[-1], [], 0
                for k, r in enumerate(parse_arc(content.as_py())):
                    head, payload = split_http(r["block"])
                    record_id, sha1 = f"urn:uuid:{uuid.uuid5(_SPACE, f'{name} {k}')}", hashlib.sha1(payload).digest()
                    rank = http_field(head, RANK_HEADER)
                    row = [record_id, r["URL"], warc_date(r["Archive-date"]), sha1, len(payload), int(rank) if rank and re.fullmatch(r"-?\d+", rank) else None]
                    if not slim:
                        kind, mime = ("response", "application/http; msgtype=response") if head else ("resource", r["Content-type"])
                        fields = [("WARC-Target-URI", row[1]), ("WARC-Payload-Digest", base32(sha1)), ("WARC-Block-Digest", base32(hashlib.sha1(r["block"]).digest()))]
                        row += [head, member(warc_record(kind, record_id, row[2], r["block"], fields, mime))]
                        held += len(row[-1])
                    rows.append(row)
                    if held > _BATCH_BYTES or len(rows) >= 4096:
                        yield _rows(rows, schema.names)
                        rows, held = [], 0
                yield _rows(rows, schema.names)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, schema)


def _rows(rows: list[list], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _RECORD_ARROW)], names)


def revisits(records: DataFrame, least: int = LEAST) -> DataFrame:
    """(record_id, target_id, target_uri, target_date) of the records that repeat another's payload.

    The winner of each digest is an aggregate that Spark combines before the exchange; the join back to it carries
    slim rows only, and adaptive execution splits a digest with very many of them.
    """
    large = records.where(F.col("size") >= least)
    best = F.struct(F.coalesce(F.col("rank"), F.lit(-(1 << 63))).alias("rank"), "record_id", "uri", "date")
    winners = large.groupBy("digest", "size").agg(F.max(best).alias("_w"), F.count("*").alias("_n")).where("_n > 1")
    joined = large.select("record_id", "digest", "size").join(winners, ["digest", "size"])
    return joined.where(F.col("record_id") != F.col("_w.record_id")).select(
        "record_id", F.col("_w.record_id").alias("target_id"), F.col("_w.uri").alias("target_uri"), F.col("_w.date").alias("target_date"))


def convert(spark: SparkSession, arc_path: str, warc_path: str, least: int = LEAST) -> None:
    """WARC files of all ARC files; revisits keep the HTTP header and refer to the response with the same payload."""
    found = arc_records(spark, arc_path, slim=False).join(revisits(arc_records(spark, arc_path, slim=True), least), "record_id", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        info = member(warc_record("warcinfo", f"urn:uuid:{uuid.uuid5(_SPACE, 'warcinfo')}", warc_date(_DATE), b"software: docquery\r\nformat: WARC File Format 1.0\r\n", [], "application/warc-fields"))
        first = [info]
        for batch in batches:
            out, first = first, []
            for r in batch.to_pylist():
                if r["target_id"] is None:
                    out.append(r["member"])
                    continue
                fields = [
                    ("WARC-Target-URI", r["uri"]), ("WARC-Payload-Digest", base32(r["digest"])), ("WARC-Profile", "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"),
                    ("WARC-Refers-To", f"<{r['target_id']}>"), ("WARC-Refers-To-Target-URI", r["target_uri"]), ("WARC-Refers-To-Date", r["target_date"])]
                out.append(member(warc_record("revisit", r["record_id"], r["date"], r["head"], fields, "application/http; msgtype=response")))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["member"])

    slim = found.select("record_id", "uri", "date", "digest", "head", F.when(F.col("target_id").isNull(), F.col("member")).alias("member"), "target_id", "target_uri", "target_date")
    _save(slim.mapInArrow(run, "member binary"), warc_path)


def parse_warc(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields in lower case, block) of each record of one WARC file."""
    for piece in members(content):
        at = 0
        while at < len(piece):
            end = piece.index(b"\r\n\r\n", at)
            lines = piece[at:end].decode("utf-8", "replace").split("\r\n")
            if not lines[0].startswith("WARC/"):
                raise ValueError(f"not a WARC record: {lines[0][:80]}")
            fields = {k.strip().lower(): v.strip() for k, v in (x.split(":", 1) for x in lines[1:])}
            start, length = end + 4, int(fields["content-length"])
            if len(piece) < start + length:
                raise ValueError("a record is shorter than declared")
            yield fields, piece[start : start + length]
            at = start + length + 4


_READ = T.StructType([
    T.StructField("record_id", T.StringType()), T.StructField("record_type", T.StringType()), T.StructField("uri", T.StringType()),
    T.StructField("rank", T.LongType()), T.StructField("payload_bytes", T.LongType()), T.StructField("payload_digest", T.StringType()),
    T.StructField("refers_to_id", T.StringType())])


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of all WARC files under ``path`` but warcinfo; a revisit's length and digest are those of the full payload."""
    types = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows = []
                for fields, block in parse_warc(content.as_py()):
                    kind = fields["warc-type"]
                    if kind == "warcinfo":
                        continue
                    head, payload = split_http(block)
                    sha1, size = hashlib.sha1(payload).hexdigest(), len(payload)
                    declared = base64.b32decode(fields["warc-payload-digest"].partition(":")[2]).hex()
                    if kind == "revisit":
                        sha1, size = declared, int(http_field(head, "Content-Length") or 0)
                    elif declared != sha1:
                        raise ValueError(f"digest of {fields['warc-record-id']} does not match")
                    rank = http_field(head, RANK_HEADER)
                    rows.append([fields["warc-record-id"].strip("<>"), kind, fields.get("warc-target-uri"), int(rank) if rank else None, size, sha1, fields.get("warc-refers-to", "").strip("<>") or None])
                columns = list(zip(*rows)) if rows else [()] * len(types)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], _READ.names)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, _READ)
