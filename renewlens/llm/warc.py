"""Zstandard WARC archives (operator 4): writer and reader of .warc.zst files.

A file starts with a skippable frame that holds the dictionary its records are compressed with;
each record is one frame.  Tasks write real files through the file system of the given folder
(``pyarrow.fs``: shared local paths, HDFS or object stores), under a temporary name first, so that
a repeated attempt replaces a file by its equal.  The reader takes the file names as rows and
decodes each file frame by frame, holding one record at a time.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import partial
from itertools import chain

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from renewlens.llm.common import scratch, stored

DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
ARCHIVE_BYTES = 32 << 20
SAMPLE_BYTES = 2 << 20
DICTIONARY_BYTES = 64 << 10
DATE = "2024-01-01T00:00:00Z"


class WarcError(ValueError):
    """An archive or record that breaks the format."""


def digest32(hexadecimal: str) -> str:
    return base64.b32encode(bytes.fromhex(hexadecimal)).decode()


def _one_line(value: str) -> str:
    return " ".join(value.split())


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, length: int, refers_to: int | None, revisit: bool, date: str = DATE) -> bytes:
    """A WARC/1.1 record; a revisit has no payload, only its digest, length and the record it refers to."""
    block = HTTP + (b"" if revisit else payload)
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"), ("WARC-Date", date), ("WARC-Target-URI", _one_line(url or "")),
            ("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Payload-Length", str(length))]
    if revisit:
        head += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<urn:page:{'' if refers_to is None else refers_to}>")]
    head += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head)
    return f"WARC/1.1\r\n{lines}\r\n".encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (lower-case names) and block of one record.  Raises WarcError."""
    head, mark, rest = raw.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not mark or not lines[0].startswith(b"WARC/1."):
        raise WarcError("no WARC header")
    fields: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon or not name.strip():
            raise WarcError(f"bad header line {line[:60]!r}")
        fields[name.strip().decode("ascii", "replace").lower()] = value.strip().decode("utf-8", "replace")
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in fields:
            raise WarcError(f"no {name}")
    if not fields["content-length"].isdigit():
        raise WarcError("bad content-length")
    n = int(fields["content-length"])
    if len(rest) != n + 4 or rest[n:] != b"\r\n\r\n":
        raise WarcError(f"content-length {n}, block and end {len(rest)} bytes")
    return fields, rest[:n]


def checked(fields: dict[str, str], block: bytes) -> dict:
    """What a record says of its page, after comparing digest and lengths with its payload.  Raises WarcError."""
    kind = fields["warc-type"]
    if kind not in ("response", "revisit"):
        raise WarcError(f"unexpected record type {kind}")
    http, mark, payload = block.partition(b"\r\n\r\n")
    if not mark or not http.startswith(b"HTTP/1."):
        raise WarcError("no HTTP header")
    digest = fields.get("warc-payload-digest", "")
    if not digest.startswith("sha1:") or len(digest) != 37 or not fields.get("x-payload-length", "").isdigit():
        raise WarcError("no digest or length of the payload")
    if kind == "response":
        if base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest[5:] or int(fields["x-payload-length"]) != len(payload):
            raise WarcError("payload doesn't match its digest or length")
    elif payload or "warc-refers-to" not in fields:
        raise WarcError("a revisit has a payload or refers to nothing")

    def page(name: str) -> int | None:
        value = fields.get(name, "")
        if not value.startswith("<urn:page:") or not value.endswith(">"):
            raise WarcError(f"bad {name}")
        return int(value[10:-1]) if value[10:-1] else None

    return {"page_id": page("warc-record-id"), "url": fields.get("warc-target-uri", ""), "payload_bytes": int(fields["x-payload-length"]), "payload_digest": digest[5:],
            "record_type": kind, "refers_to": page("warc-refers-to") if kind == "revisit" else None, "payload": payload if kind == "response" else None}


def make_dictionary(samples: list[bytes]) -> bytes:
    """A dictionary trained on records, or the records' beginnings themselves if they are too few to train on."""
    total = sum(map(len, samples))
    if len(samples) >= 16 and total >= 32 << 10:
        try:
            return zstandard.train_dictionary(min(DICTIONARY_BYTES, total // 8), samples, k=256, d=8).as_bytes()
        except zstandard.ZstdError:
            pass
    return b"".join(s[:1024] for s in samples)[:DICTIONARY_BYTES]


def leading_frame(dictionary: bytes) -> bytes:
    return DICTIONARY_MAGIC.to_bytes(4, "little") + len(dictionary).to_bytes(4, "little") + dictionary


def records(stream, chunk: int = 1 << 20) -> Iterator[bytes]:
    """The uncompressed frames of an archive, one at a time.  Raises WarcError if it is cut or no archive."""
    head = stream.read(8)
    dictionary = None
    if len(head) == 8 and int.from_bytes(head[:4], "little") == DICTIONARY_MAGIC:
        size = int.from_bytes(head[4:], "little")
        raw = stream.read(size)
        if len(raw) != size:
            raise WarcError("the dictionary frame is cut")
        if raw[:4] == FRAME_MAGIC:  # a dictionary may be compressed itself
            raw = zstandard.ZstdDecompressor().decompress(raw)
        dictionary = zstandard.ZstdCompressionDict(raw) if raw else None
        head = b""
    decoder = zstandard.ZstdDecompressor(**({"dict_data": dictionary} if dictionary else {}))
    waiting = head
    while True:
        if len(waiting) < 8:
            waiting += stream.read(chunk)
        if not waiting:
            return
        if int.from_bytes(waiting[:4], "little") in SKIPPABLE:
            skip = 8 + int.from_bytes(waiting[4:8], "little")
            while len(waiting) < skip:
                if not (more := stream.read(chunk)):
                    raise WarcError("a skippable frame is cut")
                waiting += more
            waiting = waiting[skip:]
            continue
        if waiting[:4] != FRAME_MAGIC:
            raise WarcError("no Zstandard frame where one is due")
        frame, parts = decoder.decompressobj(), []
        while not frame.eof:
            if not waiting and not (waiting := stream.read(chunk)):
                raise WarcError("the last frame is cut")
            try:
                parts.append(frame.decompress(waiting))
            except zstandard.ZstdError as e:
                raise WarcError(f"bad frame: {e}") from e
            waiting = frame.unused_data if frame.eof else b""
        yield b"".join(parts)


def _write(batches: Iterator[pa.RecordBatch], folder: str, archive_bytes: int) -> Iterator[pa.RecordBatch]:
    """Archives of one task; a row (path, records, bytes) for each."""
    fs, root = pa.fs.FileSystem.from_uri(folder)
    task = TaskContext.get()
    done: list[tuple[str, int, int]] = []

    def rows() -> Iterator[bytes]:
        for batch in batches:
            for page_id, url, payload, sha, length, refers_to, revisit in zip(*(c.to_pylist() for c in batch.columns)):
                yield record(page_id, url, payload or b"", digest32(sha), length, refers_to, revisit)

    def write_one(first: list[bytes], stream: Iterator[bytes]) -> None:
        name = f"{root}/part-{task.partitionId():05d}-{len(done):04d}.warc.zst"
        trial = f"{name}.{task.taskAttemptId()}.tmp"
        raw = make_dictionary(first)
        packer = zstandard.ZstdCompressor(level=3, write_checksum=True, **({"dict_data": zstandard.ZstdCompressionDict(raw)} if raw else {}))
        count = size = 0
        with fs.open_output_stream(trial, compression=None) as out:
            out.write(leading_frame(raw))
            for r in stream:
                out.write(frame := packer.compress(r))
                size += len(frame)
                count += 1
                if size >= archive_bytes:
                    break
        fs.move(trial, name)
        done.append((f"{folder}/{name.rpartition('/')[2]}", count, size))

    fs.create_dir(root, recursive=True)
    source = rows()
    while True:
        first, held = [], 0
        for r in source:
            first.append(r)
            held += len(r)
            if held >= SAMPLE_BYTES:
                break
        if not first:
            break
        source = chain(first, source)
        write_one(first, source)
    yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64()), pa.array([d[2] for d in done], pa.int64())], ["path", "records", "bytes"])


def assigned(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """What is written for each row of ``pages`` (page_id, url, html): page_id, url, payload, sha (hex), length, refers_to, revisit.

    Of rows with equal payloads of at least ``least_bytes`` bytes the one with the largest page_id is the
    response, others revisit it; so do rows with a null page_id if another row has one.  Rows with the same
    page_id and payload are alike, so either all or none of them are responses.  The choice is made on ids
    and digests alone.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("payload"))
    rows = rows.withColumn("sha", F.sha1("payload")).withColumn("length", F.octet_length("payload").cast("long"))
    ids = rows.select("page_id", "sha", "length")
    last = ids.groupBy("sha").agg(F.max("page_id").alias("last"), F.count("*").alias("n")).where("n > 1").drop("n")
    twins = ids.join(last, "sha").where((F.col("length") >= least_bytes) & ~F.col("page_id").eqNullSafe(F.col("last"))).select(F.col("page_id").alias("id_"), F.col("sha").alias("sha_"), "last").distinct()
    both = rows.join(twins, F.col("page_id").eqNullSafe(F.col("id_")) & (F.col("sha") == F.col("sha_")), "left")
    revisit = F.col("sha_").isNotNull()
    return both.select("page_id", "url", F.when(~revisit, F.col("payload")).alias("payload"), "sha", "length", F.col("last").alias("refers_to"), revisit.alias("revisit"))


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record for each row of ``pages`` to archives of about ``archive_bytes`` in ``folder`` (a URI that
    all tasks reach).  Returns the archives of the tasks that counted: path, records, bytes.  A null html is an
    empty payload, a null url an empty one; an empty table gives no archive."""
    rows = assigned(pages, least_bytes)
    return stored(rows.mapInArrow(partial(_write, folder=folder, archive_bytes=archive_bytes), "path string, records long, bytes long"), "archives")


def _read(batches: Iterator[pa.RecordBatch], payloads: bool) -> Iterator[pa.RecordBatch]:
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"] + ["payload"] * payloads
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()] + [pa.binary()] * payloads
    for batch in batches:
        for path in batch.column(0).to_pylist():
            fs, name = pa.fs.FileSystem.from_uri(path)
            held: list[dict] = []
            size = 0
            with fs.open_input_stream(name, compression=None) as stream:
                for raw in records(stream):
                    held.append(checked(*parse(raw)))
                    size += len(raw) if payloads else 200
                    if size >= 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array([h[c] for h in held], t) for c, t in zip(names, kinds)], names)
                        held, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array([h[c] for h in held], t) for c, t in zip(names, kinds)], names)


def read_archives(paths: DataFrame, payloads: bool = False) -> DataFrame:
    """The records of the archives named by the column ``path``: page_id, url, payload_bytes, payload_digest (base32
    SHA-1), record_type, refers_to, and on demand payload (null for revisits).  Headers, lengths and digests are
    checked; a broken archive or record fails the read with what is wrong."""
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long" + ", payload binary" * payloads
    # a row is a file; deal them out one by one, small as the rows are
    files = paths.count()
    return paths.select("path").repartition(max(1, files)).mapInArrow(partial(_read, payloads=payloads), schema)


def round_trip(pages: DataFrame, least_bytes: int = 0, folder: str | None = None) -> DataFrame:
    """Write ``pages`` to archives in ``folder`` (by default a new one in the shared checkpoint folder) and read them
    back: page_id, payload_bytes, payload_digest, record_type, refers_to for every row."""
    spark: SparkSession = pages.sparkSession
    written = write_archives(pages, folder or as_uri(scratch(spark, "warc")), least_bytes)
    return read_archives(written).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def as_uri(path: str) -> str:
    """``file:`` paths in the form that other libraries take, with three slashes."""
    path = path.removeprefix("file://") if path.startswith("file:///") else path.removeprefix("file:") if path.startswith("file:/") else path
    return f"file://{path}" if path.startswith("/") else path


#: The query's result for DuckDB: base32 of SHA-1 in five-bit groups.
SQL = r"""
with p as (
  select page_id, encode(coalesce(html, '')) as payload, sha1(coalesce(html, '')) as hex from pages),
d as (
  select page_id, octet_length(payload) as n,
         list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + cast((cast(('0x' || substr(hex, 1 + 10 * (i // 8), 10)) as bigint) >> (35 - 5 * (i % 8))) & 31 as integer), 1)), 'string_agg', '') as digest
  from p),
w as (select *, max(page_id) over (partition by digest) as last from d)
select page_id, cast(n as bigint) as payload_bytes, digest as payload_digest,
       case when page_id = last then 'response' else 'revisit' end as record_type,
       case when page_id = last then null else last end as refers_to
from w
"""
