"""WARC archives: a writer of one gzip member per record, and a reader that splits archives at any byte.

Writer (``write_warc``): every task writes its rows to files of its own under a folder that all machines share, and
returns what it has written. Only files named in the returned manifest belong to the archive, so the files of an
attempt that died are never read.

Reader (``read_warc``): archives are cut into byte ranges, one task item each. A task looks for the gzip magic from the
start of its range on, and takes an offset as the start of a record only if the bytes there inflate and begin with a
WARC version line; a header block may have any length. It owns the records that start inside its range and reads on past its end to finish the last one;
after a record, the search goes on where its gzip member ends. Ranges of one archive never share state, so any task can
be lost and run again.

An archive stored uncompressed inside a record's payload can hold what looks like a record; a range that starts inside
such a payload would report it. ``drop_nested`` removes those: a true record never starts before the end of an earlier
one.

``revisit_plan`` decides, by payload digest, which record is the response and which revisit it.

Defined results: a null payload is the empty payload, a null URI is written as the empty one. Rows with equal payloads
and equal (largest or null) keys: one of them is the response. Null keys come after all others. Empty tables give an
empty archive. Columns other than those named are dropped, so none can clash. Members that are cut off at the end of a
file are not records.
"""

from __future__ import annotations

import base64
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from rivulet.llm.common import cut, partitions, table
from rivulet.session import scratch_dir

MAGIC = b"\x1f\x8b\x08"
RANGE_BYTES = 32 << 20
FILE_BYTES = 1 << 30
READ_BYTES = 1 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"

RECORD = ("path string, offset long, next_offset long, record_id string, record_type string, target_uri string, "
          "refers_to string, payload_digest string, payload_bytes long, payload binary")


def base32_digest(sha1_hex: str) -> str:
    return base64.b32encode(bytes.fromhex(sha1_hex)).decode()


def one_line(text: str | None) -> str:
    """Header values have no line ends."""
    return re.sub(r"[\r\n]+", " ", text or "")


def render(record_id: str, kind: str, uri: str | None, refers_to: str | None, sha1_hex: str, payload: bytes) -> bytes:
    """One WARC record. A revisit keeps the HTTP header, which has the payload's length, and leaves out the payload."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    if kind != "revisit":
        block += payload
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{one_line(record_id)}>", f"WARC-Date: {DATE}",
            f"WARC-Target-URI: {one_line(uri)}", f"WARC-Payload-Digest: sha1:{base32_digest(sha1_hex)}"]
    if kind == "revisit":
        head += [f"WARC-Refers-To: <{one_line(refers_to)}>", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def gzip_member(data: bytes, level: int = 6) -> bytes:
    c = zlib.compressobj(level, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


def qualified(spark: SparkSession, folder: str) -> str:
    """``folder`` with the scheme under which Spark itself would resolve it, so that tasks write where Spark reads."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    full = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return "file://" + full[len("file:"):] if full.startswith("file:/") and not full.startswith("file://") else full


def write_warc(df: DataFrame, folder: str, file_bytes: int = FILE_BYTES, level: int = 6) -> DataFrame:
    """Write rows (record_id, record_type, target_uri, refers_to, sha1 hex, payload binary) as .warc.gz files of about
    ``file_bytes`` in ``folder``; returns the manifest (path, bytes, records), already written to shared storage."""

    folder = qualified(df.sparkSession, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        out, path, size, records, done = None, "", 0, 0, []
        for batch in batches:
            for rid, kind, uri, ref, sha1, payload in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    path, size, records = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = fs.open_output_stream(f"{root}/{path}", compression=None)
                member = gzip_member(render(rid, kind, uri, ref, sha1, payload or b""), level)
                out.write(member)
                size, records = size + len(member), records + 1
                if size >= file_bytes:
                    out.close()
                    out = done.append((path, size, records))
        if out is not None:
            out.close()
            done.append((path, size, records))
        paths, sizes, counts = zip(*done, strict=True) if done else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{p}" for p in paths], pa.string()),
                                          pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())],
                                         names=["path", "bytes", "records"])

    rows = df.select("record_id", "record_type", "target_uri", "refers_to", "sha1", "payload")
    return cut(rows.mapInArrow(run, "path string, bytes long, records long"), "warc-manifest")


class _Window:
    """Bytes of one archive from any offset on, read in blocks."""

    def __init__(self, file, size: int):
        self.file, self.size, self.at, self.block = file, size, 0, b""

    def get(self, offset: int) -> bytes:
        """The rest of the block that holds ``offset`` (a new block if it isn't the current one); empty at the end."""
        if not self.at <= offset < self.at + len(self.block):
            self.at, self.block = offset, self.file.read_at(max(0, min(READ_BYTES, self.size - offset)), offset)
        return self.block[offset - self.at:]


def next_magic(data: _Window, offset: int, end: int) -> int | None:
    """The first offset from ``offset`` on and before ``end`` where the gzip magic stands."""
    while offset < end:
        block = data.get(offset)
        if len(block) < len(MAGIC):
            block = data.file.read_at(max(0, min(READ_BYTES, data.size - offset)), offset)
            data.at, data.block = offset, block
        found = block.find(MAGIC)
        if found >= 0:
            return offset + found if offset + found < end else None
        if offset + len(block) >= data.size or len(block) < len(MAGIC):
            return None
        offset += len(block) - len(MAGIC) + 1
    return None


def inflate(data: _Window, offset: int) -> tuple[bytes, int] | None:
    """The record whose member starts at ``offset`` and the offset after the member; None if there is no record."""
    z, at, record, checked = zlib.decompressobj(31), offset, bytearray(), False
    try:
        while not z.eof:
            chunk = data.get(at)
            if not chunk:
                return None
            seen = len(record)
            record += z.decompress(chunk)
            at += len(chunk) - len(z.unused_data)
            if not b"WARC/"[:len(record)] == record[:5]:
                return None
            checked = checked or record.find(b"\r\n\r\n", max(0, seen - 3)) >= 0
    except zlib.error:
        return None
    return (bytes(record), at) if checked else None


def parse(record: bytes) -> dict | None:
    """Fields of a record; None if its header block is not one."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = {}
    for line in head.split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[name.strip().lower()] = value.strip().decode("utf-8", "replace")
    if b"warc-type" not in fields or not fields.get(b"content-length", "").isdigit():
        return None
    block = rest[:int(fields[b"content-length"])]
    payload, size = block, len(block)
    if fields.get(b"content-type", "").startswith("application/http"):
        http, _, payload = block.partition(b"\r\n\r\n")
        said = re.search(rb"(?im)^content-length:[ \t]*(\d+)", http)
        size = int(said[1]) if said and fields[b"warc-type"] == "revisit" else len(payload)
    bare = lambda key: fields[key].strip("<>") if key in fields else None
    digest = fields.get(b"warc-payload-digest")
    return {"record_id": bare(b"warc-record-id"), "record_type": fields[b"warc-type"],
            "target_uri": fields.get(b"warc-target-uri"), "refers_to": bare(b"warc-refers-to"),
            "payload_digest": digest.partition(":")[2] if digest else None, "payload_bytes": size,
            "payload": None if fields[b"warc-type"] == "revisit" else payload}


def records_in(data: _Window, start: int, end: int) -> Iterator[tuple[int, int, dict]]:
    """(offset, offset after the member, fields) of the records that start in [start, end)."""
    at = next_magic(data, start, end)
    while at is not None:
        whole = inflate(data, at)
        fields = whole and parse(whole[0])
        if fields:
            yield at, whole[1], fields
        at = next_magic(data, whole[1] if fields else at + 1, end)


def read_warc(manifest: DataFrame, range_bytes: int = RANGE_BYTES, batch_bytes: int = 16 << 20) -> DataFrame:
    """The records of the archives named by rows (path, bytes), as RECORD rows; ``refers_to`` is a record id. For
    archives of other origin, ``spark.read.format("binaryFile").load(...)`` lists path and length."""
    spark = manifest.sparkSession
    schema = pa.schema([("path", pa.string()), ("offset", pa.int64()), ("next_offset", pa.int64()),
                        *((n, pa.string()) for n in ("record_id", "record_type", "target_uri", "refers_to",
                                                     "payload_digest")),
                        ("payload_bytes", pa.int64()), ("payload", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, size, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                fs, name = pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (
                    pafs.LocalFileSystem(), path)
                rows, held = [], 0
                with fs.open_input_file(name) as file:
                    for at, after, fields in records_in(_Window(file, size), start, min(size, start + range_bytes)):
                        rows.append({"path": path, "offset": at, "next_offset": after, **fields})
                        held += len(fields["payload"] or b"") + 500
                        if held >= batch_bytes:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    ranges = (manifest.where("bytes > 0")
              .select("path", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1,
                                                            F.lit(range_bytes).cast("long"))).alias("start")))
    return ranges.repartition(partitions(spark), "path", "start").mapInArrow(run, RECORD)


def drop_nested(records: DataFrame) -> DataFrame:
    """Without rows that start before the end of an earlier record of the same archive. Drop payloads that are not
    needed first: the rows of an archive meet in one task."""
    before = W.partitionBy("path").orderBy("offset").rowsBetween(W.unboundedPreceding, -1)
    return (records.withColumn("_end", F.max("next_offset").over(before))
            .where(F.col("_end").isNull() | (F.col("offset") >= F.col("_end"))).drop("_end"))


def revisit_plan(df: DataFrame, key: str, payload: Column, min_bytes: int = 0) -> DataFrame:
    """``df`` with ``payload`` (binary), ``sha1`` (hex), ``row_id``, ``record_type`` and ``refers_key``/``refers_row``:
    of the rows with equal payloads of at least ``min_bytes``, that with the largest key is the response.

    Payloads are told apart by length and SHA-256. The choice is made on (digest, key) rows with partial aggregates; the
    payload rows then meet it in one join, whose hot digests adaptive execution can split, as both sides are plain
    exchanges. Row ids are counted along the scan: ``df`` must give the same rows in the same partitions when read
    again, as a table does."""
    rows = (df.withColumn("payload", F.coalesce(payload, F.lit(b"")))
            .withColumns({"row_id": F.monotonically_increasing_id(), "content": F.concat_ws(
                "-", F.sha2("payload", 256), F.octet_length("payload").cast("string"))}))
    best = F.max(F.struct(F.col(key).isNotNull().alias("known"), F.col(key).alias("key"), F.col("row_id")))
    chosen = cut(rows.where(F.octet_length("payload") >= min_bytes).groupBy("content").agg(
        best.alias("best"), F.count("*").alias("n")).where("n > 1")
        .select("content", F.col("best.key").alias("refers_key"), F.col("best.row_id").alias("refers_row")),
        "warc-responses")
    return (rows.join(chosen, "content", "left")
            .withColumn("record_type", F.when(F.col("refers_row") != F.col("row_id"), "revisit").otherwise("response"))
            .withColumn("sha1", F.sha1("payload")).drop("content"))


def op1_warc(spark: SparkSession, sf_dir: str, min_bytes: int = 0) -> DataFrame:
    """Pages to archives and back. Record ids are urn:page:<row id>:<page id>, so the page id is read from the
    archive."""
    pages = table(spark, sf_dir, "pages", "page_id", "url", "html")
    urn = lambda row, page: F.concat(F.lit("urn:page:"), row.cast("string"), F.lit(":"),
                                     F.coalesce(page.cast("string"), F.lit("")))
    revisit = F.col("record_type") == "revisit"
    planned = revisit_plan(pages, "page_id", F.col("html").cast("binary"), min_bytes)
    manifest = write_warc(planned.select(
        urn(F.col("row_id"), F.col("page_id")).alias("record_id"), "record_type", F.col("url").alias("target_uri"),
        F.when(revisit, urn(F.col("refers_row"), F.col("refers_key"))).alias("refers_to"), "sha1", "payload"),
        scratch_dir(spark, "warc"))
    records = drop_nested(read_warc(manifest).drop("payload"))
    page = lambda c: F.expr(f"try_cast(nullif(substring_index({c}, ':', -1), '') as bigint)")
    return records.select(page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                          page("refers_to").alias("refers_to"))


SQL = """
SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id = best THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> best THEN best END AS refers_to
FROM (SELECT page_id, payload, max(page_id) OVER (PARTITION BY payload) AS best,
             array_to_string(list_transform(range(32), lambda i:
               alphabet[1 + list_sum(list_transform(range(5), lambda j:
                 bits[1 + i * 5 + j]::INT * (16 // (2 ** j)::INT)))::INT]), '') AS digest
      FROM (SELECT page_id, encode(coalesce(html, '')) AS payload, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567' AS alphabet,
                   unhex(sha1(encode(coalesce(html, ''))))::BIT::VARCHAR AS bits FROM pages))
"""
