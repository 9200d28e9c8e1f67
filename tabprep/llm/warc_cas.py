"""Content-addressed WARC archive.

*Writing.*  Each page becomes a WARC/1.1 record.  Its payload is named by two
digests: SHA-1 for the record's header, SHA-256 as the address.  Of equal
payloads the page with the largest id keeps a ``response`` record, the others
become ``revisit`` records.  Two tables are written: ``payloads`` holds the
bytes of each address once, deflated; ``headers`` holds every record's header
block, byte for byte.  Who is the response is settled on ids and digests alone.

*Reading.*  Headers are joined with the payloads' bytes on the address and
every record is rebuilt: ``records`` returns them, ``read`` parses the rebuilt
bytes back and checks the payload against its address, the record's length and
its digest; a record that differs is an error.  An address with many records is
dealt over several join keys, with a copy of its payload for each.

Defined results: a null html is an empty payload and a null url an empty
target; payloads below ``least_bytes`` are never revisits; a page without an id
revisits the response of its payload, and is a response if there is none; rows
that repeat the response's id are responses too; an empty table gives an empty
archive; other columns are not archived.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabprep.llm.common import require, stage

CRLF = "\r\n"
#: Fixed date of records whose source has none.
WARC_DATE = "2024-01-01T00:00:00Z"
#: Pages handled together inside a task.
SLICE_ROWS = 256
#: Records of one address that share a join key, about.
DEAL_RECORDS = 1000


def _payload(html: str | None) -> bytes:
    return (html or "").encode("utf-8", "surrogatepass")


def digests(df: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """``page_id, url, address, sha1, bytes`` of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE_ROWS):
                batch = whole.slice(at, SLICE_ROWS)
                raw = [_payload(h) for h in batch.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0), batch.column(1),
                    pa.array([hashlib.sha256(x).digest() for x in raw], pa.binary()),
                    pa.array([base64.b32encode(hashlib.sha1(x).digest()).decode() for x in raw], pa.string()),
                    pa.array([len(x) for x in raw], pa.int64()),
                ], names=["page_id", "url", "address", "sha1", "bytes"])

    held = df.select(F.col(f"`{id_col}`").cast("long"), F.coalesce(F.col(f"`{url_col}`").cast("string"), F.lit("")),
                     F.col(f"`{html_col}`").cast("string"))
    return held.mapInArrow(run, "page_id long, url string, address binary, sha1 string, bytes long")


def packed(df: DataFrame, html_col: str) -> DataFrame:
    """``address, payload``: the deflated bytes of every page; a task passes
    each payload on once while it is among those it saw last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, None] = {}
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE_ROWS):
                names, out = [], []
                for html in whole.column(0).slice(at, SLICE_ROWS).to_pylist():
                    raw = _payload(html)
                    name = hashlib.sha256(raw).digest()
                    if name not in seen:
                        seen[name] = None
                        if len(seen) > 100_000:
                            seen.pop(next(iter(seen)))
                        names.append(name)
                        out.append(zlib.compress(raw, 4))
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(out, pa.binary())],
                                                 names=["address", "payload"])

    return df.select(F.col(f"`{html_col}`").cast("string")).mapInArrow(run, "address binary, payload binary")


def header(revisit: Column) -> Column:
    """The header block up to and with the empty line."""
    return F.concat(F.concat_ws(
        CRLF, F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: <urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">")),
        F.lit(f"WARC-Date: {WARC_DATE}"),
        F.concat(F.lit("WARC-Target-URI: "), F.regexp_replace("url", r"[\r\n]", " ")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("sha1")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: <urn:page:"), F.col("response_id").cast("string"), F.lit(">"))),
        F.when(revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        F.lit("Content-Type: text/html"),
        F.concat(F.lit("Content-Length: "), F.when(revisit, F.lit(0).cast("long")).otherwise(F.col("bytes")).cast("string")),
    ), F.lit(CRLF + CRLF)).cast("binary")


def write(df: DataFrame, folder: str, least_bytes: int = 0, id_col: str = "page_id", url_col: str = "url",
          html_col: str = "html") -> None:
    """Write the archive's tables ``headers`` and ``payloads`` below ``folder``."""
    require(df, [id_col, url_col, html_col])
    pages = stage(digests(df, id_col, url_col, html_col))
    first = stage(pages.groupBy("address").agg(
        F.max("page_id").alias("response_id"), F.ceil(F.count(F.lit(1)) / DEAL_RECORDS).cast("int").alias("deals")))
    revisit = (F.col("bytes") >= least_bytes) & F.col("response_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response_id"))
    (pages.withColumn("number", F.monotonically_increasing_id()).join(first, "address")
     .select("page_id", "address", F.pmod("number", "deals").cast("int").alias("deal"), header(revisit).alias("header"))
     .write.parquet(f"{folder}/headers"))
    (packed(df, html_col).groupBy("address").agg(F.first("payload").alias("payload"))
     .join(first.select("address", "deals"), "address")
     .write.option("compression", "none").parquet(f"{folder}/payloads"))


def _field(name: str) -> Column:
    return F.nullif(F.regexp_extract(F.col("header").cast("string"), rf"\r\n{name}: ([^\r\n]*)\r\n", 1), F.lit(""))


def headers(spark: SparkSession, folder: str) -> DataFrame:
    """Every record's header block and the fields parsed from it."""
    page = r"<urn:page:(-?[0-9]+)>"
    return spark.read.parquet(f"{folder}/headers").select(
        "address", "deal", "header",
        F.regexp_extract(_field("WARC-Record-ID"), page, 1).try_cast("long").alias("page_id"),
        _field("WARC-Type").alias("record_type"),
        F.substring_index(_field("WARC-Payload-Digest"), ":", -1).alias("header_digest"),
        _field("Content-Length").cast("long").alias("content_length"),
        F.regexp_extract(_field("WARC-Refers-To"), page, 1).try_cast("long").alias("refers_to"))


def rebuilt(address: bytes, header: bytes, kind: str, raw: bytes) -> bytes:
    """The whole record: header block, the body it announces, the closing lines."""
    if hashlib.sha256(raw).digest() != address:
        raise ValueError(f"payload {address.hex()} does not match its address")
    return header + (b"" if kind == "revisit" else raw) + (CRLF * 2).encode()


def parsed(record: bytes) -> tuple[dict[str, str], bytes]:
    """A record's header fields and its body, as long as they announce it."""
    head, _, rest = record.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8", "surrogatepass").split(CRLF)
    if version != "WARC/1.1":
        raise ValueError(f"not a record: {version[:40]!r}")
    fields = dict(line.split(": ", 1) for line in lines)
    size = int(fields["Content-Length"])
    if rest[size:] != (CRLF * 2).encode():
        raise ValueError(f"record {fields['WARC-Record-ID']} is not as long as its header says")
    return fields, rest[:size]


def with_payload(spark: SparkSession, folder: str) -> DataFrame:
    """Every record's header with the deflated bytes of its payload."""
    stored = spark.read.parquet(f"{folder}/payloads").select(
        "address", "payload", F.explode(F.sequence(F.lit(0), F.col("deals") - 1)).alias("deal"))
    return headers(spark, folder).join(stored, ["address", "deal"], "left")


def _page(urn: str | None) -> int | None:
    number = (urn or "")[len("<urn:page:"):-1]
    return int(number) if number else None


def read(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record, taken from the record as rebuilt and checked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            out = []
            for name, head, kind, data in zip(*[whole.column(i) for i in range(4)]):
                if not data.is_valid:
                    raise ValueError(f"no payload at address {name.as_py().hex()}")
                raw = zlib.decompress(data.as_py())
                fields, body = parsed(rebuilt(name.as_py(), head.as_py(), kind.as_py(), raw))
                revisits = fields["WARC-Type"] == "revisit"
                digest = base64.b32encode(hashlib.sha1(raw if revisits else body).digest()).decode()
                if fields["WARC-Payload-Digest"] != f"sha1:{digest}":
                    raise ValueError(f"record {fields['WARC-Record-ID']} does not match its digest")
                out.append((_page(fields["WARC-Record-ID"]), len(raw if revisits else body), digest, fields["WARC-Type"],
                            _page(fields.get("WARC-Refers-To"))))
            columns = list(zip(*out)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                columns, (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()))],
                names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    return with_payload(spark, folder).select("address", "header", "record_type", "payload").mapInArrow(
        run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def records(spark: SparkSession, folder: str) -> DataFrame:
    """``page_id, record, payload``: whole records (header block, the body it
    announces, the closing empty lines) and the full payload."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE_ROWS):
                batch = whole.slice(at, SLICE_ROWS)
                raw = [zlib.decompress(x) for x in batch.column(4).to_pylist()]
                out = [rebuilt(*row) for row in zip(*[batch.column(i).to_pylist() for i in (1, 2, 3)], raw)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary()), pa.array(raw, pa.binary())],
                                                 names=["page_id", "record", "payload"])

    return with_payload(spark, folder).select("page_id", "address", "header", "record_type", "payload").mapInArrow(
        run, "page_id long, record binary, payload binary")
