"""WARC archives: pages written as request, response or revisit, and metadata records; captures read back.

The records of a capture name its response (or revisit) record in WARC-Concurrent-To; reading joins them
on that id. Archives are gzip files, so each is read in order by one task, record after record, and never
held whole.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import StringType

from pressgauge.llm.links import settle
from pressgauge.llm.scan import utf8
from pressgauge.operators.skew import counted_join, skewed_join
from pressgauge.session import cut_lineage

# Fixed values of the format.
VERSION = "WARC/1.1\r\n"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Smaller payloads are always written as responses.
LEAST_BYTES = 0
#: At most so many keys, those with more than this part of all rows, are joined by a broadcast; the rest are shuffled.
HOT_KEYS = 1_000
DATE = "1970-01-01T00:00:00Z"


def digest_of(payload: bytes) -> str:
    """Base-32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


@arrow_udf(StringType())
def payload_digest(payloads: pa.Array) -> pa.Array:
    return pa.array([digest_of(p) for p in utf8(payloads)], pa.string())


def _record_id(kind: str, *row: Column) -> Column:
    """From the page's id, address and digest, so only rows equal in all three, whose records are equal, share one."""
    parts = [F.coalesce(c.cast("string"), F.lit("null")) for c in row]
    # A length before each part keeps the parts apart.
    h = F.md5(F.concat(F.lit(f"{kind}:"), *[F.concat(F.length(c).cast("string"), F.lit(":"), c) for c in parts]))
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in cuts]), F.lit(">"))


def _record(headers: list[tuple[str, Column | str]], block: Column) -> Column:
    """One record without its closing empty lines; a header whose value is null is left out."""
    lines = [F.concat(F.lit(f"{name}: "), v if isinstance(v, Column) else F.lit(v), F.lit("\r\n")) for name, v in headers]
    return F.concat(
        F.lit(VERSION), *[F.coalesce(x, F.lit("")) for x in lines],
        F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(END), block,
    )


def _decided(pages: DataFrame, least_bytes: int) -> DataFrame:
    """Pages (id, url, html, size, digest) with the id and url of the row whose record a revisit points to, ``refers`` null for a response."""
    html = F.coalesce("html", F.lit(""))
    rows = pages.select(
        F.col("page_id").alias("id"), F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", "").alias("url"),
        html.alias("html"), F.octet_length(html).cast("bigint").alias("size"), payload_digest(html).alias("digest"),
    )
    keys = cut_lineage(rows.filter(F.col("id").isNotNull() & (F.col("size") >= least_bytes)).select("id", "url", "digest"), "digests")
    last = keys.groupBy("digest").agg(F.max(F.struct("id", "url")).alias("last"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    # A payload of many pages meets its last page without a shuffle of its rows.
    again = counted_join(keys, settle(last, "last"), "digest", "n", HOT_KEYS).filter("id < last.id").select(
        "id", "digest", F.col("last.id").alias("refers"), F.col("last.url").alias("refers_url")
    ).distinct()
    # Rows without id refer to nothing, so they need no join, which would deal all of them to one task.
    nameless = rows.filter(F.col("id").isNull()).withColumns({"refers": F.lit(None).cast(again.schema["refers"].dataType), "refers_url": F.lit(None).cast("string")})
    return rows.filter(F.col("id").isNotNull()).join(again, ["id", "digest"], "left").unionByName(nameless)


def write_archives(pages: DataFrame, path: str, least_bytes: int = LEAST_BYTES, date: str = DATE) -> None:
    """Write three records per row of (page_id, url, html) to gzip archives under ``path``.

    Rows that differ have record ids of their own, also if they share an id or have none; equal rows have equal records.
    Of rows with equal payloads of ``least_bytes`` or more, the one with the largest id has the response and
    the others revisit it. A null payload is empty. Line breaks in a URL are dropped. A row without id is
    always a response.
    """
    rows = _decided(pages, least_bytes)
    length = F.col("size").cast("string")
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), length, F.lit(END)
    )
    url = F.col("url")
    row = (F.col("id"), url, F.col("digest"))
    me = _record_id("capture", *row)
    again = F.col("refers").isNotNull()
    digest = F.concat(F.lit("sha1:"), F.col("digest"))
    request_block = F.concat(F.lit("GET "), url, F.lit(" HTTP/1.1"), F.lit(END))
    request = _record(
        [
            ("WARC-Type", "request"), ("WARC-Record-ID", _record_id("request", *row)), ("WARC-Date", date),
            ("WARC-Target-URI", url), ("WARC-Concurrent-To", me), ("Content-Type", "application/http; msgtype=request"),
        ],
        request_block,
    )
    response = _record(
        [
            ("WARC-Type", F.when(again, "revisit").otherwise("response")), ("WARC-Record-ID", me), ("WARC-Date", date),
            ("WARC-Target-URI", url), ("WARC-Profile", F.when(again, PROFILE)),
            ("WARC-Refers-To", F.when(again, _record_id("capture", F.col("refers"), F.col("refers_url"), F.col("digest")))),
            ("WARC-Payload-Digest", digest), ("Content-Type", "application/http; msgtype=response"),
        ],
        F.when(again, http).otherwise(F.concat(http, "html")),
    )
    metadata = _record(
        [
            ("WARC-Type", "metadata"), ("WARC-Record-ID", _record_id("metadata", *row)), ("WARC-Date", date),
            ("WARC-Target-URI", url), ("WARC-Concurrent-To", me), ("Content-Type", "application/warc-fields"),
        ],
        F.concat(F.lit("page-id: "), F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit("\r\n")),
    )
    lines = rows.select(F.explode(F.array(request, response, metadata)).alias("value"))
    lines.write.option("lineSep", END).option("compression", "gzip").text(path)


RECORD = (
    "type string, record_id string, concurrent_to string, refers_to string, uri string, date string, "
    "payload_digest string, payload_bytes bigint, http string, payload binary, complete boolean"
)


def _fields(head: bytes) -> dict[str, str]:
    out = {}
    for line in head.decode("utf-8", "replace").split("\r\n"):
        name, colon, value = line.partition(":")
        if colon:
            out[name.strip().lower()] = value.strip()
    return out


def _length(chunk: bytes) -> tuple[int, int] | None:
    """Where the block begins and how long it is; None while the header has not ended."""
    end = chunk.find(END.encode())
    if end < 0:
        return None
    size = _fields(chunk[:end]).get("content-length", "0")
    return end + len(END), int(size) if size.isdigit() else 0


def _parsed(chunk: bytes) -> tuple:
    at = _length(chunk)
    begin, size = at if at else (len(chunk), 0)
    head, block = _fields(chunk[:begin]), chunk[begin : begin + size]
    complete = at is not None and len(block) == size
    kind = head.get("warc-type")
    http, payload, total = None, block, len(block)
    digest = (head.get("warc-payload-digest") or "").rpartition(":")[2] or None
    if kind in ("response", "revisit"):
        http_head, _, payload = block.partition(END.encode())
        http = http_head.decode("utf-8", "replace")
        total = len(payload)
        if kind == "revisit":
            # A revisit keeps the HTTP header of the payload that it leaves out.
            said = _fields(http_head).get("content-length", "")
            total = int(said) if said.isdigit() else 0
        else:
            digest = digest_of(payload)
    return (
        kind, head.get("warc-record-id"), head.get("warc-concurrent-to"), head.get("warc-refers-to"),
        head.get("warc-target-uri"), head.get("warc-date"), digest, total, http, payload, complete,
    )


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the gzip archives under ``path``, in the columns of ``RECORD``.

    A response's digest and size are those of the payload as read; a revisit's are what its headers
    say. ``complete`` is false for a record that its file ends in.
    """
    chunks = spark.read.option("lineSep", VERSION).text(path)
    chunks = chunks.select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("chunk"))
    names = [part.split()[0] for part in RECORD.split(", ")]
    kinds = [pa.string()] * 7 + [pa.int64(), pa.string(), pa.binary(), pa.bool_()]
    magic, most = VERSION.encode(), 4 << 20

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, held, need = None, None, None
        rows: list[tuple] = []
        size = 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        for batch in batches:
            for name, chunk in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if name != file:
                    if held is not None:
                        rows.append(_parsed(b"".join(held)))
                    # What stands before a file's first record is nothing.
                    file, held, need = name, None, None
                    if not chunk:
                        continue
                if held is None:
                    held, have = [chunk], len(chunk)
                else:  # the payload has the separator in it
                    held += [magic, chunk]
                    have += len(magic) + len(chunk)
                if need is None and (at := _length(b"".join(held) if len(held) > 1 else chunk)):
                    need = sum(at)
                if need is not None and have >= need:
                    rows.append(_parsed(b"".join(held)))
                    size += need
                    held, need = None, None
                if size > most:
                    yield out()
                    rows, size = [], 0
        if held is not None:
            rows.append(_parsed(b"".join(held)))
        if rows:
            yield out()

    return chunks.mapInArrow(run, RECORD)


def captures(records: DataFrame) -> DataFrame:
    """One row per response or revisit record: (record_id, response, requests, metadata), each part a struct or a list of structs.

    Requests and metadata records belong to the record that they name in WARC-Concurrent-To; a capture
    without them has empty lists, and one that names no capture is left out. Equal records count once in a list, so a
    capture that was written many times has each of its parts once. Other columns of ``records`` go into the structs.
    """
    inner = [c for c in records.columns if c not in ("type", "record_id", "concurrent_to")]

    def part(kind: str, name: str) -> DataFrame:
        own = records.filter((F.col("type") == kind) & F.col("concurrent_to").isNotNull())
        return own.groupBy(F.col("concurrent_to").alias("record_id")).agg(
            F.collect_set(F.struct("record_id", *inner)).alias(name)
        )

    main = records.filter(F.col("type").isin("response", "revisit"))
    main = main.select("record_id", F.struct("type", *inner).alias("response"))
    with_requests = skewed_join(main, part("request", "requests"), "record_id", max_hot=HOT_KEYS)
    joined = skewed_join(with_requests, part("metadata", "metadata"), "record_id", max_hot=HOT_KEYS)
    return joined.withColumns({c: F.coalesce(c, F.array()) for c in ("requests", "metadata")})
