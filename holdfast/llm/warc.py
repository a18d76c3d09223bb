"""Web archives with a two-level capture index.

Archives are WARC 1.1 files, one gzip member a record, written by Spark's text sink: a row is the bytes
of a member, and the separator between rows is the member of an empty text, which adds nothing to the
unpacked file. Of records with one payload of ``LEAST`` bytes or more, that of the least page is the
response and the others are revisits without a body; smaller payloads are always responses.

The capture index is built by reading the archives. Its lines (reversed-host key, page, file, offset,
length, record type, size, digest, referred page) are sorted by key, cut into blocks of ``BLOCK`` lines
and written as one gzip member a block. The block directory keeps the first key, file, offset and length
of each block. A look-up takes the blocks that may hold a key from the directory, reads just their bytes,
finds the lines by binary search and reads just the bytes of the record.

Defined results: a null page is the empty payload; null and strange URLs are keyed by their text; a null
page id is written as such and never chosen as the response of others; rows with equal ids stay separate
records; extra columns are ignored.
"""

from __future__ import annotations

import bisect
import hashlib
import json
import re
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.llm.common import fresh_path, join_small, spark_schema, stage, text_or_empty

#: Payloads below this many bytes are never revisits; lines of an index block; records of a file at most.
LEAST, BLOCK, FILE_RECORDS = 100, 2000, 5000
DATE = "2024-01-01T00:00:00Z"
CAPTURE = "key string, page_id bigint, url string, file string, offset bigint, length bigint, record_type string, payload_bytes bigint, payload_digest string, refers_to bigint"


def member(data: bytes) -> bytes:
    """One gzip member."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


#: The member of an empty text; every byte of it is one Latin-1 character of the text sink's separator.
EMPTY = bytes([0x1F, 0x8B, 8, 0, 0, 0, 0, 0, 0, 3, 3, 0]) + bytes(8)


def members(data: bytes) -> Iterator[tuple[int, int, bytes]]:
    """Offset, length and content of the members of a file that hold anything."""
    at, step = 0, 1 << 16
    while at < len(data):
        unpack = zlib.decompressobj(31)
        start, parts = at, []
        while not unpack.eof:
            if at >= len(data):
                raise ValueError("an archive ends within a record")
            piece = data[at : at + step]
            parts.append(unpack.decompress(piece))
            at += len(piece) - len(unpack.unused_data)
        body = b"".join(parts)
        if body:
            yield start, at - start, body


def url_key(url: str | None) -> str:
    """Host labels reversed, then path and query, as captures are sorted."""
    if url is None:
        return ""
    try:
        parts = urlsplit(url)
        host = (parts.hostname or "").lower()
        port = f":{parts.port}" if parts.port else ""
    except ValueError:
        return url
    if not host:
        return url
    rest = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    return ",".join(reversed(host.removeprefix("www.").split("."))) + port + ")" + rest


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A response or revisit record in WARC form."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    kind = "response" if refers_to is None else "revisit"
    body = http + (payload if refers_to is None else b"")
    name = hashlib.sha256(f"{page_id}|{url}|{digest}".encode("utf-8", "surrogatepass")).hexdigest()
    # percent-encoded only where a header line could not hold it; Page-Url keeps the exact text
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:uuid:{name[:8]}-{name[8:12]}-4{name[13:16]}-8{name[17:20]}-{name[20:32]}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {re.sub(r'[\x00-\x20\x7f]', lambda m: f'%{ord(m[0]):02X}', url or 'about:blank')}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"Page-Id: {json.dumps(page_id)}",
        f"Page-Url: {json.dumps(url)}",
        f"Payload-Length: {len(payload)}",
    ]
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"Refers-To-Page: {refers_to}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """Fields and payload of a record; lengths and the digest of a response are checked."""
    top, _, rest = data.partition(b"\r\n\r\n")
    lines = top.decode("utf-8", "surrogatepass").split("\r\n")
    told = dict(line.split(": ", 1) for line in lines[1:])
    size = int(told["Content-Length"])
    if lines[0] != "WARC/1.1" or rest[size:] != b"\r\n\r\n":
        raise ValueError("not a whole record")
    payload = rest[:size].partition(b"\r\n\r\n")[2]
    digest, length = told["WARC-Payload-Digest"].removeprefix("sha256:"), int(told["Payload-Length"])
    if told["WARC-Type"] == "response":
        digest, length = hashlib.sha256(payload).hexdigest(), len(payload)
        if told["WARC-Payload-Digest"] != f"sha256:{digest}":
            raise ValueError("a payload does not match its digest")
    return {
        "page_id": json.loads(told["Page-Id"]),
        "url": json.loads(told["Page-Url"]),
        "record_type": told["WARC-Type"],
        "payload_bytes": length,
        "payload_digest": digest,
        "refers_to": int(told["Refers-To-Page"]) if "Refers-To-Page" in told else None,
        "payload": payload,
    }


def _write_members(rows: DataFrame, folder: str, per_file: int) -> None:
    """Write a column of gzip members one after the other."""
    packed = rows.select(F.col(rows.columns[0]).cast("string"))
    packed.write.mode("overwrite").option("lineSep", EMPTY.decode("latin-1")).option("encoding", "ISO-8859-1").option("maxRecordsPerFile", per_file).text(folder)


def write_archives(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html") -> None:
    """Write a record per row below ``folder``.

    Digests are grouped as narrow rows; pages are only joined with the few rows that are revisits.
    """
    rows = pages.select(F.col(f"`{page_id}`").cast("bigint").alias("page_id"), F.col(f"`{url}`").alias("url"), text_or_empty(html).alias("page"))
    rows = rows.withColumn("digest", F.sha2("page", 256))
    large = rows.where((F.octet_length("page") >= LEAST) & F.col("page_id").isNotNull()).select("page_id", "digest")
    firsts = large.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "first")
    firsts = stage(firsts, "repeated-payloads")
    told = join_small(rows, firsts, "digest", "left", 200_000)
    told = told.withColumn("refers_to", F.expr("IF(page_id != first, first, NULL)")).drop("first")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [member(record(i, u, p.encode("utf-8", "surrogatepass"), d, r)) for i, u, p, d, r in zip(*(batch.column(k).to_pylist() for k in range(5)))]
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], names=["member"])

    packed = told.select("page_id", "url", "page", "digest", "refers_to").mapInArrow(work, "member binary")
    _write_members(packed, folder, FILE_RECORDS)


def _files(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("path", "content")


def read_archives(spark: SparkSession, folder: str, payloads: bool = False) -> DataFrame:
    """The captures of all archives below ``folder``, read record by record; payloads on request."""
    schema = spark_schema(CAPTURE + (", payload binary" if payloads else ""))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows: list[dict] = []
                for offset, length, body in members(content.as_py()):
                    row = parse(body)
                    row |= {"key": url_key(row["url"]), "file": path.rsplit("/", 1)[1], "offset": offset, "length": length}
                    rows.append({f.name: row[f.name] for f in schema.fields})
                    if len(rows) >= 500:
                        yield pa.RecordBatch.from_pylist(rows, schema=to_arrow)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=to_arrow)

    from pyspark.sql.pandas.types import to_arrow_schema

    to_arrow = to_arrow_schema(schema)
    return _files(spark, folder).mapInArrow(work, schema)


def write_index(captures: DataFrame, folder: str, block: int = BLOCK) -> None:
    """Write index blocks below ``folder``/blocks and their directory below ``folder``/directory.

    Captures are dealt out by ranges of key and page, so one very common key is no single task's.
    """
    fields = [f.name for f in spark_schema(CAPTURE).fields]
    ordered = captures.select(*fields).repartitionByRange("key", "page_id", "file", "offset").sortWithinPartitions("key", "page_id", "file", "offset")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines: list[bytes] = []

        def close() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([member(b"".join(lines))], pa.binary())], names=["member"])

        for batch in batches:
            for row in batch.to_pylist():
                lines.append(json.dumps([row[f] for f in fields], ensure_ascii=True).encode() + b"\n")
                if len(lines) >= block:
                    yield close()
                    lines = []
        if lines:
            yield close()

    _write_members(ordered.mapInArrow(pack, "member binary"), f"{folder}/blocks", 1000)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows = []
                for offset, length, body in members(content.as_py()):
                    lines = body.splitlines()
                    rows.append([json.loads(lines[0])[0], json.loads(lines[-1])[0], path.rsplit("/", 1)[1], offset, length])
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)] if rows else [pa.array([], t) for t in (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64())], names=["first_key", "last_key", "file", "offset", "length"])

    spark = captures.sparkSession
    _files(spark, f"{folder}/blocks").mapInArrow(places, "first_key string, last_key string, file string, offset bigint, length bigint").write.mode("overwrite").parquet(f"{folder}/directory")


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """All captures of an index, block by block."""
    schema = spark_schema(CAPTURE)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(1):
                for _, _, body in members(content.as_py()):
                    columns = zip(*(json.loads(line) for line in body.splitlines()))
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, to_arrow)], schema=to_arrow)

    from pyspark.sql.pandas.types import to_arrow_schema

    to_arrow = to_arrow_schema(schema)
    return _files(spark, f"{folder}/blocks").mapInArrow(work, schema)


def _range(spark: SparkSession, path: str, offset: int, length: int) -> bytes:
    """The bytes of a range of a file, by the file system of the session."""
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    stream = place.getFileSystem(spark._jsc.hadoopConfiguration()).open(place)
    try:
        stream.seek(offset)
        return bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream, length))
    finally:
        stream.close()


def lookup(spark: SparkSession, archives: str, index: str, url: str) -> list[dict]:
    """The records of a URL by directory, block and record ranges; no whole file is read."""
    key = url_key(url)
    blocks = spark.read.parquet(f"{index}/directory").where((F.col("first_key") <= key) & (F.col("last_key") >= key))
    names = [f.name for f in spark_schema(CAPTURE).fields]
    out = []
    for place in blocks.orderBy("first_key", "file", "offset").toLocalIterator():
        data = _range(spark, f"{index}/blocks/{place['file']}", place["offset"], place["length"])
        lines = next(members(data))[2].splitlines()
        at = bisect.bisect_left(lines, key, key=lambda line: json.loads(line)[0])
        while at < len(lines) and (row := dict(zip(names, json.loads(lines[at]))))["key"] == key:
            body = next(members(_range(spark, f"{archives}/{row['file']}", row["offset"], row["length"])))[2]
            out.append(row | {"payload": parse(body)["payload"]})
            at += 1
    return out


def archive(pages: DataFrame, folder: str | None = None, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write archives and index, and read all captures back by way of the index."""
    spark = pages.sparkSession
    folder = folder or fresh_path(spark, "archive")
    write_archives(pages, f"{folder}/records", page_id, url, html)
    write_index(read_archives(spark, f"{folder}/records"), f"{folder}/index")
    return read_index(spark, f"{folder}/index")


__all__ = ["archive", "lookup", "member", "members", "parse", "read_archives", "read_index", "record", "url_key", "write_archives", "write_index"]
