"""WARC archives: one gzip member per record, written and read sequentially.

Writing: each task streams its rows into files of bounded size in the shared
folder and returns one manifest row per file; only files named by the manifest,
which is written once, are ever read, so files of failed or repeated attempts
do not count. Of records with equal payloads of at least `min_bytes`, that with
the largest id carries the payload (response); the others are revisits that
name it. Reading: a task streams an archive member by member (incremental zlib,
bounded buffers), frames each record by its Content-Length and verifies the
block digest and, for responses, the payload digest.

Files go through `pyarrow.fs` by the scheme of the shared folder (file, hdfs,
s3, gs).

Defined results: null and empty payloads are response records of 0 bytes; a null
url or id is written as an empty field and read back as null, and a row without
an id is always a response; repeated rows each have a record, and those that
repeat the largest id of their payload are all responses. An empty table gives
no archive and no rows.
"""

from __future__ import annotations

import hashlib
import os
import urllib.parse
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtide.llm.common import map_arrow, slices, written
from logtide.session import scratch_path

FILE_BYTES = 32 << 20
READ_BYTES = 1 << 18
MIN_REVISIT_BYTES = 1000          # fixed value: smaller payloads are always stored
_END = b"\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class BadRecord(ValueError):
    """A record whose framing or digest does not hold."""


def file_system(url: str):
    """(pyarrow file system, path) of a url or plain path."""
    from pyarrow import fs
    if urllib.parse.urlparse(url).scheme in ("", "file"):
        return fs.LocalFileSystem(), urllib.parse.unquote(urllib.parse.urlparse(url).path)
    return fs.FileSystem.from_uri(url)


def record(kind: str, record_id: str, url: str, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """One WARC record: header, HTTP header and (for responses) the payload."""
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload))
    block = http + payload if kind == "response" else http
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{record_id}>",
            "WARC-Date: 1970-01-01T00:00:00Z", "Content-Type: application/http; msgtype=response",
            f"WARC-Target-URI: {urllib.parse.quote(url, safe=':/?#[]@!$&()*+,;=%~')}",
            f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{hashlib.sha1(block).hexdigest()}"]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {_PROFILE}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + _END + block + _END


def gzip_member(data: bytes) -> bytes:
    z = zlib.compressobj(4, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def _members(stream) -> Iterator[Iterator[bytes]]:
    """Per gzip member of `stream`, an iterator over its decompressed parts; use each up before the next."""
    buffer = stream.read(READ_BYTES)
    while buffer:
        z = zlib.decompressobj(31)

        def parts():
            nonlocal buffer
            while not z.eof:
                if not buffer:
                    buffer = stream.read(READ_BYTES)
                    if not buffer:
                        raise BadRecord("archive ends inside a member")
                out = z.decompress(buffer, READ_BYTES)
                buffer = z.unconsumed_tail if not z.eof else z.unused_data
                if out:
                    yield out
            if not buffer:
                buffer = stream.read(READ_BYTES)

        yield parts()


def _fields(head: bytes) -> dict[str, str]:
    return dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "")
                for line in head.decode().split("\r\n")[1:])


def read_records(stream) -> Iterator[tuple[dict[str, str], dict[str, str], bytes | None]]:
    """(record fields, HTTP fields, payload or None for revisits) of every record, verified."""
    for parts in _members(stream):
        data = bytearray()
        for part in parts:
            data += part
            cut = data.find(_END)
            if cut >= 0:
                break
        else:
            raise BadRecord("no end of header")
        fields = _fields(bytes(data[:cut]))
        size = int(fields["Content-Length"])
        block = data[cut + len(_END):]
        for part in parts:
            block += part
        if len(block) != size + len(_END) or block[size:] != _END:
            raise BadRecord(f"{fields['WARC-Record-ID']}: Content-Length {size} does not frame the block")
        block = bytes(block[:size])
        if f"sha1:{hashlib.sha1(block).hexdigest()}" != fields["WARC-Block-Digest"]:
            raise BadRecord(f"{fields['WARC-Record-ID']}: block digest")
        http, _, payload = block.partition(_END)
        http_fields = _fields(http)
        if fields["WARC-Type"] == "response":
            if f"sha1:{hashlib.sha1(payload).hexdigest()}" != fields["WARC-Payload-Digest"]:
                raise BadRecord(f"{fields['WARC-Record-ID']}: payload digest")
            if len(payload) != int(http_fields["Content-Length"]):
                raise BadRecord(f"{fields['WARC-Record-ID']}: payload length")
        yield fields, http_fields, payload if fields["WARC-Type"] == "response" else None


def revisits(keys: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """keys (id, digest, bytes) plus refers_to: the largest id of an equal payload, null for that one itself.

    The largest id per digest is aggregated before the shuffle; the join back is salted."""
    big = keys.where(F.col("bytes") >= min_bytes)
    last = (big.groupBy("digest").agg(F.max("_id").alias("last"), F.count(F.lit(1)).alias("n")).where("n > 1")
            .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(7)))).drop("n"))
    salted = keys.withColumn("salt", F.pmod(F.xxhash64("_id"), F.lit(8)).cast("int"))
    return (salted.join(last, ["digest", "salt"], "left").drop("salt")
            .withColumn("refers_to", F.when((F.col("bytes") >= min_bytes) & (F.col("last") != F.col("_id")),
                                            F.col("last"))).drop("last"))


def write_warc(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
               payload_col: str = "html", min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Write every row as a record below `folder`; returns the manifest (file, records, bytes), written once."""
    spark = pages.sparkSession
    rows = pages.select(F.col(id_col).alias("_id"), F.coalesce(url_col, F.lit("")).alias("url"),
                        F.coalesce(F.col(payload_col), F.lit("")).alias("payload"))
    digest = F.sha1(F.col("payload").cast("binary"))
    keys = written(spark, rows.select("_id", digest.alias("digest"), F.octet_length("payload").alias("bytes")),
                   "warc-keys")
    marks = (revisits(keys, min_bytes).where("refers_to IS NOT NULL").select("_id", "digest", "refers_to")
             .dropDuplicates(["_id", "digest"]))
    marked = rows.withColumn("digest", digest).join(marks.hint("shuffle_hash"), ["_id", "digest"], "left")

    def write(batches):
        fs, base = file_system(folder)
        fs.create_dir(base, recursive=True)
        out = path = None
        n = size = 0
        done = []
        for whole in batches:
            for part in slices(whole, "payload"):
                for i, url, text, d, ref in zip(*(part.column(c).to_pylist()
                                                  for c in ("_id", "url", "payload", "digest", "refers_to"))):
                    if out is None:
                        path, n, size = f"{base}/{uuid.uuid4().hex}.warc.gz", 0, 0
                        out = fs.open_output_stream(path, compression=None)
                    member = gzip_member(record("response" if ref is None else "revisit", "" if i is None else str(i),
                                                url, text.encode(), d, None if ref is None else str(ref)))
                    out.write(member)
                    n, size = n + 1, size + len(member)
                    if size >= FILE_BYTES:
                        out.close()
                        done.append((os.path.basename(path), n, size))
                        out = None
        if out is not None:
            out.close()
            done.append((os.path.basename(path), n, size))
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in done], t) for k, t in
                                          enumerate((pa.string(), pa.int64(), pa.int64()))],
                                         names=["file", "records", "bytes"])

    made = map_arrow(marked.select("_id", "url", "payload", "digest", "refers_to"), write,
                     "file string, records long, bytes long")
    return written(spark, made, "warc-manifest")


def read_warc(manifest: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """The records of the manifest's files: record_id, url, type, payload_bytes, payload_digest, refers_to[, payload]."""
    schema = ("record_id string, url string, record_type string, payload_bytes long, payload_digest string, "
              "refers_to string" + (", payload binary" if with_payload else ""))
    names = [c.split()[0] for c in schema.split(", ")]

    def read(batches):
        fs, base = file_system(folder)
        for b in batches:
            for name in b.column("file").to_pylist():
                with fs.open_input_stream(f"{base}/{name}", compression=None) as stream:
                    rows, held = [], 0
                    for fields, http, payload in read_records(stream):
                        ref = fields.get("WARC-Refers-To")
                        rows.append((fields["WARC-Record-ID"][len("<urn:page:"):-1] or None,
                                     urllib.parse.unquote(fields["WARC-Target-URI"]) or None,
                                     fields["WARC-Type"], int(http["Content-Length"]),
                                     fields["WARC-Payload-Digest"].removeprefix("sha1:"),
                                     ref[len("<urn:page:"):-1] if ref else None, payload)[:len(names)])
                        held += len(payload or b"") if with_payload else 0
                        if len(rows) >= 4096 or held >= READ_BYTES * 16:
                            yield _batch(rows, names)
                            rows, held = [], 0
                    if rows:
                        yield _batch(rows, names)

    # a task a file, as adaptive execution would put all these small rows into one
    files = manifest.select("file").repartition(max(1, manifest.count()), "file")
    return map_arrow(files, read, schema)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    types = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], types[k]) for k in range(len(names))],
                                      names=names)


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
               payload_col: str = "html") -> DataFrame:
    """Write all rows to archives in the shared folder, then read them back."""
    folder = scratch_path(pages.sparkSession, "warc")
    return read_warc(write_warc(pages, folder, id_col, url_col, payload_col), folder)
