"""A content-addressed WARC archive.

Pages with equal payloads are found by their SHA-256, on narrow rows. One of them, that with the
largest page_id, becomes a ``response`` record; the others become ``revisit`` records that refer to
it. Every task writes two files of gzip members: the exact headers of its records, and the payloads
that it stores, each distinct payload once. Reading takes headers and payloads apart; a payload is
known by the SHA-256 of its bytes. ``restore`` joins every header, a revisit's too, to its payload on
that digest and puts the record together again; ``verified`` parses each such record, hashes its
payload again and refuses a wrong digest or length.

Html is shuffled to be written only where the pages that store nothing are too many to broadcast, and
then by page, not by payload, so a payload that many pages share is no hot key; reading shuffles each
payload once.

Defined results: a null html is an empty payload; a null url gives no target line; a row with a
null page_id is a response and nothing refers to it; repeated rows with the largest id are each a
response (and each store the payload, of which one is read); an empty table gives an archive without
records; extra columns are left out.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm.common import arrow, map_file, put, scratch, slices, whole_file

HEADER = "page_id long, record_type string, payload_digest string, refers_to long, sha string, header binary"
_PAGE = "<urn:larder:page:%s>"
_END = b"\r\n\r\n"
#: Pages that store no payload and are broadcast at most (about 100 bytes each); beyond it the join is left to a shuffle.
BROADCAST_PAGES = 100_000


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def header(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """The WARC and HTTP header of one WARC/1.1 record; a revisit, whose block ends there, if it refers to another page."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    length = len(http) + (len(payload) if refers_to is None else 0)
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_PAGE % page_id}", f"WARC-Date: {date}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    lines += [f"WARC-Payload-Digest: sha1:{digest(payload)}", f"X-Payload-SHA256: {hashlib.sha256(payload).hexdigest()}"]
    if refers_to is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {_PAGE % refers_to}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {length}", "", ""]
    return "\r\n".join(lines).encode() + http


def members(data) -> Iterator[bytes]:
    """The gzip members of a file, decompressed one by one."""
    at = 0
    while at < len(data):
        stream, out = zlib.decompressobj(31), []
        while not stream.eof:
            chunk = bytes(data[at : at + (1 << 16)])
            if not chunk:
                raise ValueError("the archive ends within a record")
            out.append(stream.decompress(chunk))
            at += len(chunk) - len(stream.unused_data)
        yield b"".join(out)


def fields(head: bytes) -> dict[str, str]:
    """The named fields of a WARC header."""
    return dict(line.split(": ", 1) for line in head[: head.index(_END)].decode().split("\r\n")[1:])


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """(fields, payload) of a record with its payload; its lengths and its digest are checked."""
    found, start = fields(data), data.index(_END) + 4
    start = data.index(_END, start) + 4
    payload = data[start:-4]
    block = int(found["Content-Length"]) + (len(payload) if found["WARC-Type"] == "revisit" else 0)
    if data[-4:] != _END or block != len(data) - 4 - data.index(_END) - 4:
        raise ValueError(f"the length of {found['WARC-Record-ID']} is wrong")
    if digest(payload) != found["WARC-Payload-Digest"].removeprefix("sha1:"):
        raise ValueError(f"the payload of {found['WARC-Record-ID']} has another digest")
    return found, payload


def _page(field: str | None) -> int | None:
    return None if field is None or field == _PAGE % None else int(field.removeprefix("<urn:larder:page:").removesuffix(">"))


def write_archive(pages: DataFrame, out: str, *, least_bytes: int = 0, date: str = "1970-01-01T00:00:00Z", page_id: str = "page_id", url: str = "url", html: str = "html") -> list[tuple[str, int, int]]:
    """Write the archive; for each part its path, records and stored payloads. Records of payloads under ``least_bytes`` are all responses."""
    html = F.coalesce(html, F.lit(""))
    narrow = put(pages.select(F.col(page_id).cast("long").alias("page_id"), F.sha2(html, 256).alias("sha")).where("page_id is not null"), "digests")
    first = narrow.groupBy("sha").agg(F.max("page_id").alias("first"))
    others = put(narrow.join(first, "sha").where("page_id < first").select("page_id", "sha", "first").distinct(), "others")
    small = others.limit(BROADCAST_PAGES + 1).count() <= BROADCAST_PAGES
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), html.alias("html")).withColumn("sha", F.sha2("html", 256))
    joined = rows.join(F.broadcast(others) if small else others, ["page_id", "sha"], "left")
    refers = F.when(F.octet_length("html") >= least_bytes, F.col("first"))
    joined = joined.select("page_id", "url", "html", refers.alias("refers_to"), F.col("first").isNull().alias("stores"))
    # pages without an id store what no page with an id does; one of equal ones is read

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        name, n, stored = f"{out}/part-{task.partitionId():06d}", 0, 0
        with whole_file(f"{name}.headers.gz", task.taskAttemptId()) as heads, whole_file(f"{name}.payloads.gz", task.taskAttemptId()) as payloads:
            for batch in slices(batches, "html"):
                for row in batch.to_pylist():
                    payload = row["html"].encode()
                    heads.write(_member(header(row["page_id"], row["url"], payload, row["refers_to"], date)))
                    n += 1
                    if row["stores"]:
                        payloads.write(_member(payload))
                        stored += 1
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n], pa.int64()), pa.array([stored], pa.int64())], ["file", "records", "payloads"])

    return sorted(tuple(r) for r in arrow(joined, write, "file string, records long, payloads long").collect() if r["records"])  # a row per part


def _member(data: bytes) -> bytes:
    gz = zlib.compressobj(1, zlib.DEFLATED, 31)
    return gz.compress(data) + gz.flush()


def _read(spark: SparkSession, files: list[str], row, schema: str) -> DataFrame:
    """A row for each member of the files."""
    shared, types, names = spark.sparkContext.broadcast(files), [], [x.split()[0] for x in schema.split(", ")]
    for x in schema.split(", "):
        types.append({"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[x.split()[1]])

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [()] * len(types), types)], names)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids in batches:
            for i in ids.column("id").to_pylist():
                rows, size = [], 0
                for data in members(map_file(shared.value[i], "u1")):
                    rows.append(row(data))
                    size += len(data)
                    if size > 4 << 20:
                        yield batch(rows)
                        rows, size = [], 0
                yield batch(rows)

    return arrow(spark.range(0, len(files), 1, max(1, len(files))), read, schema)


def read_headers(spark: SparkSession, parts: list[tuple[str, int, int]]) -> DataFrame:
    """(page_id, record_type, payload_digest, refers_to, sha, header): the exact headers and what they say."""

    def row(data: bytes) -> tuple:
        f = fields(data)
        return _page(f["WARC-Record-ID"]), f["WARC-Type"], f["WARC-Payload-Digest"].removeprefix("sha1:"), _page(f.get("WARC-Refers-To")), f["X-Payload-SHA256"], data

    return _read(spark, [f"{name}.headers.gz" for name, _, _ in parts], row, HEADER)


def read_payloads(spark: SparkSession, parts: list[tuple[str, int, int]]) -> DataFrame:
    """(sha, payload): each stored payload under the SHA-256 of its bytes."""
    return _read(spark, [f"{name}.payloads.gz" for name, _, n in parts if n], lambda data: (hashlib.sha256(data).hexdigest(), data), "sha string, payload binary")


def restore(headers: DataFrame, payloads: DataFrame) -> DataFrame:
    """The headers with the original ``record``: header, payload and end. A payload that isn't there is an error."""
    once = payloads.groupBy("sha").agg(F.first("payload").alias("payload"))
    # files read in Python look tiny to the planner, so it is told not to broadcast them
    payload = F.coalesce("payload", F.raise_error(F.concat(F.lit("no payload has the digest "), "sha")))
    return headers.join(once.hint("merge"), "sha", "left").withColumn("record", F.concat("header", payload, F.lit(_END))).drop("payload", "sha")


def verified(records: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of restored records, each parsed and checked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [parse(r.as_py()) for r in batch.column("record")]
            columns = [[_page(f["WARC-Record-ID"]) for f, _ in rows], [len(p) for _, p in rows], [digest(p) for _, p in rows], [f["WARC-Type"] for f, _ in rows], [_page(f.get("WARC-Refers-To")) for f, _ in rows]]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    return arrow(records.select("record"), run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = write_archive(spark.read.parquet(f"{sf_dir}/pages.parquet"), scratch(spark, "warc"))
    return verified(restore(read_headers(spark, parts), read_payloads(spark, parts)))


#: SHA-1 in base32: each 5 hexadecimal digits are 4 base-32 digits.
_DIGITS = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (cast('0x' || substr(h, 5 * i + 1, 5) AS BIGINT) // {p}) % 32, 1)"
OP6_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
m AS (SELECT h, max(page_id) AS first FROM p WHERE page_id IS NOT NULL GROUP BY h)
SELECT page_id, cast(octet_length(encode(html)) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(0, 8), lambda i: {" || ".join(_DIGITS.format(p=32**k) for k in (3, 2, 1, 0))}), '') AS payload_digest,
       CASE WHEN page_id < first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < first THEN first END AS refers_to
FROM p LEFT JOIN m USING (h)
"""
