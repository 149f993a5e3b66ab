"""WARC archives: writing captures, reading records, assembling transactions.

``write_warc`` gives every page three records: a request, a response - or, where
an earlier page holds the same payload, a revisit without it - and a metadata
record.  The response names its request and the metadata record names the
response in ``WARC-Concurrent-To``.  Records are text rows ended by two line
ends, which is the record format, so Spark's own writer makes the archives
(gzip) in any store it reaches, ``FILE_BYTES`` of records a file on average.

``read_warc`` parses the archives by their headers and content lengths.
``captures`` joins request, response and metadata records through their
concurrent-to identifiers, whichever side names the other, and emits a nested
row per capture.  Records of one capture may lie in any file and order.  The
joins carry identifiers and the small records; payloads join last, if wanted.

Defined cases: a null html is an empty payload; a null page_id is kept (two
pages of equal payload without any page_id are both responses); a null url gives
records without a target; repeated rows give repeated records and captures;
an empty table gives archives without records; texts of any length are written
whole; other columns are not read, so their names cannot clash.  Of several requests (or metadata records) of
one capture the one with the smallest identifier is shown, with their number.
A record cut short, or one without a length, raises an error.
"""

from __future__ import annotations

import gzip
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from ledgerlens.llm.native import let, written

#: Payloads under this many bytes are never revisits.
LEAST_REVISIT = 100
#: Bytes of records in a file, on average.
FILE_BYTES = 16_000_000
#: Bytes of payload that a reader hands on at once.
_HANDED_ON = 4_000_000
#: Fixed values of the format.
_END = "\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDED = "2026-01-31T00:00:00Z"


def _uuid(kind: str, *parts: Column) -> Column:
    """An identifier that equal rows share."""
    told = F.md5(F.to_json(F.struct(F.lit(kind).alias("kind"), *(p.alias(f"p{i}") for i, p in enumerate(parts)))))
    return let(told, lambda h: F.concat(F.lit("<urn:uuid:"), F.concat_ws(
        "-", *(F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))), F.lit(">")))


def _field(name: str, value: Column) -> Column:
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))).otherwise("")


def _record(kind: str, identifier: Column, block: Column, content: str, *fields: Column) -> Column:
    return F.concat(F.lit(f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Date: {RECORDED}\r\n"),
                    _field("WARC-Record-ID", identifier), *fields, F.lit(f"Content-Type: {content}\r\n"),
                    _field("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"), block)


def write_warc(pages: DataFrame, out: str, id_col: str = "page_id", url_col: str = "url",
               html_col: str = "html", file_bytes: int = FILE_BYTES) -> None:
    """Archives of ``pages`` in the new folder ``out``."""
    # control characters and spaces cannot stand in a header
    url = F.regexp_replace(F.regexp_replace(F.regexp_replace(
        F.col(url_col).cast("string"), "\r", "%0D"), "\n", "%0A"), "[\\x00-\\x20\\x7F]", "%20")
    own = pages.select(F.col(id_col).cast("long").alias("page_id"), url.alias("url"),
                       F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    own = own.select("*", F.octet_length("html").alias("bytes"), F.sha2(F.col("html").cast("binary"), 256).alias("digest"))
    seen = Observation()
    sized = own.select("page_id", "url", "bytes", "digest").observe(
        seen, F.sum(F.col("bytes").cast("long") + 1_000).alias("bytes"), F.count(F.lit(1)).alias("n"))
    # the first of the pages that share a payload; most payloads are alone and leave no row
    firsts = written(sized.where(F.col("bytes") >= LEAST_REVISIT).groupBy("digest").agg(
        F.min(F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", "url")).alias("first"),
        F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).select(
        "digest", F.col("first.page_id").alias("first_id"), F.col("first.url").alias("first_url"),
        F.lit(True).alias("shared")), "first-payloads")
    told = own.join(firsts, "digest", "left")
    again = F.coalesce(F.col("shared") & ~F.col("page_id").eqNullSafe(F.col("first_id")), F.lit(False))
    rows = told.select(
        "page_id", "url", "html", "bytes", "digest", "first_url", again.alias("again"),
        *(_uuid(kind, F.col("page_id"), F.col("url"), F.col("digest")).alias(kind) for kind in (
            "request", "response", "metadata")),
        _uuid("response", F.col("first_id"), F.col("first_url"), F.col("digest")).alias("first"))
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"),
                    _field("Content-Length", F.col("bytes").cast("string")), F.lit("\r\n"))
    host = F.regexp_extract(F.coalesce("url", F.lit("")), "^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)
    target = F.regexp_extract(F.coalesce("url", F.lit("")), "^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^#]*)", 1)
    uri, digest = _field("WARC-Target-URI", F.col("url")), _field(
        "WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest")))
    asked = _record("request", F.col("request"),
                    F.concat(F.lit("GET "), F.when(target == "", "/").otherwise(target), F.lit(" HTTP/1.1\r\nHost: "),
                             host, F.lit("\r\n\r\n")), "application/http; msgtype=request", uri)
    by = _field("WARC-Concurrent-To", F.col("request"))
    answered = F.when(F.col("again"), _record(
        "revisit", F.col("response"), head, "application/http; msgtype=response", uri, by, digest,
        F.lit(f"WARC-Profile: {_PROFILE}\r\n"), _field("WARC-Refers-To", F.col("first")),
        _field("WARC-Refers-To-Target-URI", F.col("first_url")))).otherwise(_record(
            "response", F.col("response"), F.concat(head, F.col("html")), "application/http; msgtype=response", uri,
            by, digest))
    described = _record("metadata", F.col("metadata"), _field("page-id", F.col("page_id").cast("string")),
                        "application/warc-fields", uri, _field("WARC-Concurrent-To", F.col("response")))
    count = seen.get["n"]
    per_file = max(3, 3 * count * file_bytes // max(1, seen.get["bytes"] or 0)) if count else 3
    rows.select(F.explode(F.array(asked, answered, described)).alias("value")).write.option("lineSep", _END) \
        .option("compression", "gzip").option("maxRecordsPerFile", per_file).text(out)


def records_in(data: bytes) -> Iterator[tuple[dict[str, str], memoryview]]:
    """Headers (names in lower case) and block of each record of one archive, gzipped or plain."""
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    view, at = memoryview(data), 0
    while True:
        while data[at:at + 1] in (b"\r", b"\n"):
            at += 1
        if at >= len(data):
            return
        stop = data.find(b"\r\n\r\n", at)
        lines = data[at:stop].decode("utf-8", "replace").split("\r\n") if stop >= 0 else [""]
        fields = {name.strip().lower(): value.strip() for name, _, value in (x.partition(":") for x in lines[1:])}
        length = fields.get("content-length", "")
        if not lines[0].startswith("WARC/") or not length.isdigit() or stop + 4 + int(length) > len(data):
            raise ValueError(f"no whole WARC record at byte {at}")
        at = stop + 4 + int(length)
        yield fields, view[stop + 4:at]


_RECORD = ("record_id string, kind string, concurrent_to string, refers_to string, uri string, recorded string, "
           "recorded_digest string, head string, content string, payload_bytes long, payload_digest string, "
           "payload binary")


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """A row a record.  ``head`` is the HTTP head and ``payload`` (null unless
    wanted) the rest of a response; ``content`` is the block of other records."""

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(c.split()[0], {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[c.split()[1]])
                            for c in _RECORD.split(", ")])
        for batch in batches:
            for content in batch.column(0):
                rows, held = [], 0
                for f, block in records_in(content.as_py()):
                    kind = f.get("warc-type")
                    body = [None, bytes(block).decode("utf-8", "replace"), None, None, None]
                    if kind in ("response", "revisit"):
                        head, _, rest = bytes(block).partition(b"\r\n\r\n")
                        body = [head.decode("utf-8", "replace"), None, None, None, None]
                        if kind == "response":
                            body[2:] = len(rest), hashlib.sha256(rest).hexdigest(), rest if payload else None
                            held += len(rest) if payload else 0
                    rows.append([f.get("warc-record-id"), kind, f.get("warc-concurrent-to"), f.get("warc-refers-to"),
                                 f.get("warc-target-uri"), f.get("warc-date"), f.get("warc-payload-digest"), *body])
                    if held >= _HANDED_ON or len(rows) >= 5_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)],
                                                         schema=schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)],
                                                     schema=schema)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(parsed, _RECORD)


def assembled(records: DataFrame) -> DataFrame:
    """A nested row a capture: response (or revisit), ``request`` and ``metadata``
    with their numbers.  ``records``: as ``read_warc`` gives them."""
    main = records.where(F.col("kind").isin("response", "revisit"))

    def side(kind: str) -> DataFrame:
        own = records.where(F.col("kind") == kind).select("record_id", "concurrent_to", F.struct(
            "record_id", "uri", "recorded", "content").alias("one"))
        named = own.where(F.col("concurrent_to").isNotNull()).select(F.col("concurrent_to").alias("of"), "one")
        naming = main.where(F.col("concurrent_to").isNotNull()).select(
            F.col("record_id").alias("of"), F.col("concurrent_to").alias("record_id")).distinct()
        # either record may name the other; a pair that name each other counts once
        both = named.unionByName(naming.join(own.select("record_id", "one"), "record_id").select("of", "one"))
        return both.groupBy("of").agg(F.min("one").alias(kind), F.count_distinct("one.record_id").alias(f"n_{kind}"))

    with_request = main.join(side("request"), F.col("record_id") == F.col("of"), "left").drop("of")
    with_both = with_request.join(side("metadata"), F.col("record_id") == F.col("of"), "left").drop("of")
    return with_both.select(
        "record_id", "kind", "uri", "recorded", "refers_to",
        F.struct("head", "payload_bytes", "payload_digest", "recorded_digest").alias("response"),
        "request", F.coalesce("n_request", F.lit(0)).alias("n_request"),
        "metadata", F.coalesce("n_metadata", F.lit(0)).alias("n_metadata"))


def captures(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """A nested row a capture of the archives under ``path``; a revisit shows
    the size, digest and, with ``payload``, the bytes of the response it refers to.
    ``refers_to`` is that response's metadata."""
    whole = assembled(written(read_warc(spark, path, payload=False).drop("payload"), "warc-records"))
    rows = written(whole, "captures")
    # repeated responses are equal
    of = F.struct("metadata", "response.payload_bytes", "response.payload_digest")
    first = rows.where(F.col("kind") == "response").groupBy(F.col("record_id").alias("refers_to")).agg(
        F.min(of).alias("referred"))
    full = rows.join(first, "refers_to", "left").select(
        "record_id", "kind", "uri", "recorded", "refers_to", "request", "n_request", "metadata", "n_metadata",
        F.col("referred.metadata").alias("refers_to_metadata"),
        F.struct(F.col("response.head").alias("head"), F.col("response.recorded_digest").alias("recorded_digest"),
                 F.coalesce("response.payload_bytes", "referred.payload_bytes").alias("payload_bytes"),
                 F.coalesce("response.payload_digest", "referred.payload_digest").alias("payload_digest")).alias("response"))
    if not payload:
        return full
    held = read_warc(spark, path).where(F.col("kind") == "response").select(
        F.col("record_id").alias("held_in"), "payload").dropDuplicates(["held_in"])
    holder = F.when(F.col("kind") == "revisit", F.col("refers_to")).otherwise(F.col("record_id"))
    return full.join(held, holder == F.col("held_in"), "left").drop("held_in")


def page_id_of(metadata: Column) -> Column:
    return F.try_to_number(F.regexp_extract(metadata["content"], "(?m)^page-id: (-?[0-9]+)", 1),
                           F.lit("S9999999999999999999")).cast("long")


def archive_report(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of every capture under ``path``."""
    return captures(spark, path, payload=False).select(
        page_id_of(F.col("metadata")).alias("page_id"), F.col("response.payload_bytes").alias("payload_bytes"),
        F.col("response.payload_digest").alias("payload_digest"), F.col("kind").alias("record_type"),
        F.when(F.col("kind") == "revisit", page_id_of(F.col("refers_to_metadata"))).alias("refers_to"))
