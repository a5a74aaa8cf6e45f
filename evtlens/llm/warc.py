"""WARC archives and revisit resolution.

Headers, not payloads, are grouped by payload digest (combined before the shuffle): of the
records with one digest, that with the least id stays a response, the others become
revisits that refer to it. Archives are written with fresh headers, one file per task and
at most ``records_per_file`` records in a file. Reading walks each archive by the lengths
in its headers, so payloads may hold anything, and revisits get the payload's size back
by a join with their original response on the digest.

Payload digests are bare base32 SHA-1, as in the WARC format.

Defined results: a null payload is empty; records with payloads below ``min_bytes`` are
all responses; a null id counts as the largest; records equal in id and payload are
all responses if they hold the least id; an empty table gives an archive without records.
"""

from __future__ import annotations

import base64
import gzip

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_batches

VERSION = "WARC/1.1"


def resolved(records: DataFrame, *, key: str = "page_id", payload: str = "html",
             min_bytes: int = 0) -> DataFrame:
    """``records`` with digest (hex SHA-1), payload_bytes, record_type and refers_to.

    The join sends each digest's least id back to its records; a digest with very many
    records is a skewed key of a left join, which adaptive execution splits."""
    records = records.drop("digest", "payload_bytes", "record_type", "refers_to")
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    df = records.withColumns({"digest": F.sha1(body), "payload_bytes": F.octet_length(body).cast("long")})
    order = F.struct(F.col(key).isNull().alias("n"), F.col(key).alias("k"))
    first = (df.where(F.col("payload_bytes") >= min_bytes)
             .groupBy(F.col("digest").alias("__w_digest"))
             .agg(F.min(order).alias("__w_first"), F.count(F.lit(1)).alias("__w_n"))
             .where("__w_n > 1").select("__w_digest", "__w_first"))
    df = df.join(first, F.col("digest") == F.col("__w_digest"), "left")
    revisit = F.coalesce(~F.col("__w_first.k").eqNullSafe(F.col(key)) & F.col("__w_first").isNotNull(), F.lit(False))
    return (df.withColumns({
        "record_type": F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        "refers_to": F.when(revisit, F.col("__w_first.k"))}).drop("__w_digest", "__w_first"))


def record_id(key) -> str:
    return f"<urn:record:{'' if key is None else key}>"


def record_head(kind: str, key, url, digest_hex: str, length: int, refers_to, date: str) -> str:
    """Header block of a record, without the empty line that ends it."""
    digest = base64.b32encode(bytes.fromhex(digest_hex)).decode()
    lines = [VERSION, f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(key)}",
             f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{digest}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + "".join(c for c in url if c >= " " and c != "\x7f"))
    if kind == "revisit":
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: {record_id(refers_to)}"]
    lines.append(f"Content-Length: {length}")
    return "\r\n".join(lines)


def write_archives(records: DataFrame, path: str, *, key: str = "page_id", url: str = "url",
                   payload: str = "html", date: str = "2024-01-01T00:00:00Z",
                   records_per_file: int = 2000) -> None:
    """Writes what ``resolved`` gives. Spark's text writer ends each row with the CRLF that
    a record ends with, so the files are WARC archives byte for byte (gzip outside)."""
    def run(batches):
        for batch in batches:
            out = []
            for k, u, body, kind, digest, to in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                content = b"" if kind == "revisit" else (body or b"")
                head = record_head(kind, k, u, digest, len(content), to, date)
                out.append(head.encode() + b"\r\n\r\n" + content + b"\r\n")
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    small_batches(records.sparkSession)
    target = F.col(url) if url in records.columns else F.lit(None).cast("string")
    body = F.when(F.col("record_type") == "response", F.col(payload).cast("binary"))
    (records.select(F.col(key), target.alias("url"), body.alias("body"), "record_type", "digest", "refers_to")
     .mapInArrow(run, "record binary").select(F.col("record").cast("string").alias("value"))
     .write.option("lineSep", "\r\n").option("compression", "gzip")
     .option("maxRecordsPerFile", records_per_file).text(path))


def parse(data: bytes):
    """Records of an archive: (headers with lower-case names, content)."""
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        head = data[at:end].decode().split("\r\n")
        if not head[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        fields = {}
        for line in head[1:]:
            name, _, value = line.partition(":")
            fields[name.lower()] = value.strip()
        start = end + 4
        stop = start + int(fields["content-length"])
        yield fields, data[start:stop]
        at = stop + 4


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: record_id, record_type, url, digest (base32), refers_to,
    content (binary). Archives are read whole, so their size bounds a task's memory."""
    def run(batches):
        names = ["record_id", "record_type", "url", "digest", "refers_to", "content"]
        for batch in batches:
            for data in batch.column(0).to_pylist():
                rows = []
                for h, content in parse(data):
                    rows.append((h["warc-record-id"], h["warc-type"], h.get("warc-target-uri"),
                                 h["warc-payload-digest"].removeprefix("sha1:"), h.get("warc-refers-to"), content))
                    if len(rows) == 500:
                        yield pa.RecordBatch.from_arrays(_columns(rows), names=names)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays(_columns(rows), names=names)

    files = (spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
             .select("content"))
    return files.mapInArrow(run, "record_id string, record_type string, url string, digest string, "
                                 "refers_to string, content binary")


def _columns(rows):
    cols = list(zip(*rows, strict=True))
    return [pa.array(c, pa.string()) for c in cols[:5]] + [pa.array(cols[5], pa.binary())]


def joined(records: DataFrame) -> DataFrame:
    """Headers of ``read_archives`` with payload_bytes; a revisit has the size of its
    original response, found by digest."""
    heads = records.select("record_id", "record_type", "digest", "refers_to",
                           F.octet_length("content").cast("long").alias("own_bytes"))
    originals = (heads.where("record_type = 'response'").groupBy(F.col("digest").alias("__w_digest"))
                 .agg(F.max("own_bytes").alias("full_bytes")))
    revisits = (heads.where("record_type = 'revisit'")
                .join(originals, F.col("digest") == F.col("__w_digest"), "left")
                .drop("__w_digest").withColumnRenamed("full_bytes", "payload_bytes"))
    responses = heads.where("record_type <> 'revisit'").withColumn("payload_bytes", F.col("own_bytes"))
    return responses.unionByName(revisits).drop("own_bytes")
