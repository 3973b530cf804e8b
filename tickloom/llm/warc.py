"""WARC archives with revisit records.

write() lays records out as WARC/1.1 through Spark's text sink (gzip): a record is its header lines, an empty line and
the payload, and the sink's line separator is the empty pair of lines that ends every record, so task commits, retries
and any file system come from Spark. Records go to files by the size of their payload (FILES), so that no file holds
more than about 64 MB or one record, and read() may take a file whole, decompress it as a stream and cut it by
Content-Length.

resolve() shuffles headers only: of equal payload digests (SHA-1, of at least min_bytes bytes) the record with the
largest id stays a response, the others become revisits that refer to it. The groups come from a max per digest with
map-side combine; the rows of a hot digest are joined to it by a join that AQE splits. deduplicated() then joins the
verdicts to the payloads by record id, which has no hot keys. Digests stay hexadecimal until they are written.

Null payloads are empty. Null ids lose against any id and stand as the id null; among only null ids all stay
responses, as do rows that share the largest id. CR and LF in a URL are percent-encoded; a null URL leaves its header
out. Payloads may hold anything, record separators too.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.cluster import saved, shared_dir, ship

#: Payload bytes up to which a file takes so many records.
FILES = ((1 << 16, 1000), (1 << 20, 64), (None, 1))
SALTS = 16
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_END = "\r\n\r\n"


def base32(digest: Column) -> Column:
    """A SHA-1 of 40 hexadecimal digits in base32: ten of them are eight."""
    parts = [F.lpad(F.conv(F.substring(digest, i + 1, 10), 16, 32), 8, "0") for i in range(0, 40, 10)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", _BASE32)


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """id, url, payload, n_bytes, digest (hexadecimal SHA-1) of every row."""
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(payload_col), F.lit("")).alias("payload"))
    return rows.select("*", F.octet_length("payload").cast("long").alias("n_bytes"), F.sha1(F.col("payload").cast("binary")).alias("digest"))


def resolve(headers: DataFrame, min_bytes: int = 0) -> DataFrame:
    """id, digest, refers_to of the revisits among headers (id, digest, n_bytes), each id and digest once."""
    large = headers.where(F.col("n_bytes") >= min_bytes).select("id", "digest")
    groups = large.groupBy("digest").agg(F.max("id").alias("refers_to"), F.count("*").alias("n")).where("n > 1 and refers_to is not null").drop("n")
    return large.join(groups, "digest").where("id is null or id <> refers_to").select("id", "digest", "refers_to").distinct()


def deduplicated(recs: DataFrame, headers: DataFrame, min_bytes: int = 0) -> DataFrame:
    """recs with refers_to: the response's id for revisits, else null. Revisits lose their payload. headers: id, digest
    and n_bytes of recs."""
    marked = resolve(headers, min_bytes).select(F.col("id").alias("__id"), F.col("digest").alias("__digest"), "refers_to")
    joined = recs.join(marked, recs["id"].eqNullSafe(marked["__id"]) & (recs["digest"] == marked["__digest"]), "left").drop("__id", "__digest")
    return joined.withColumn("payload", F.when(F.col("refers_to").isNull(), F.col("payload")).otherwise(F.lit("")))


def _lines(date: str) -> Column:
    """A record's text, without the pair of lines that ends it."""
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))
    revisit = F.col("refers_to").isNotNull()
    safe_url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), name(F.col("id"))),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), safe_url),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), base32(F.col("digest"))),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), name(F.col("refers_to")))),
        F.when(revisit, F.lit(f"WARC-Profile: {PROFILE}")),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.octet_length("payload").cast("string")),
    ]
    return F.concat(F.concat_ws("\r\n", *lines), F.lit(_END), F.col("payload"))


def write(recs: DataFrame, path: str, min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z") -> None:
    """One archive folder of recs (as records() gives them), without the payloads of revisits."""
    headers = saved(recs.select("id", "digest", "n_bytes"), "headers")
    low = -1
    for i, (high, rows) in enumerate(FILES):
        own = F.col("n_bytes") > low if high is None else (F.col("n_bytes") > low) & (F.col("n_bytes") <= high)
        low = high
        if i and headers.where(own).isEmpty():
            continue
        out = deduplicated(recs.where(own), headers, min_bytes).select(_lines(date).alias("value"))
        out.write.option("lineSep", _END).option("compression", "gzip").option("maxRecordsPerFile", rows).text(f"{path}/files={i}")


def parse(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers in lower case, payload) of every record of a decompressed stream."""
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.strip():
            continue
        head = {}
        while (line := stream.readline()).strip():
            key, _, value = line.decode("utf-8", "replace").partition(":")
            head[key.strip().lower()] = value.strip()
        yield head, stream.read(int(head.get("content-length", 0)))


def _record_id(urn: str | None) -> int | None:
    tail = (urn or "").strip("<>").rpartition(":")[2]
    return int(tail) if tail.lstrip("-").isdigit() else None


def _read_rows(payloads: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "url", "record_type", "digest", "refers_to", "n_bytes", "payload"]
        for batch in batches:
            for content in batch.column(0):
                rows, held = [], 0
                raw = content.as_py()
                stream = gzip.GzipFile(fileobj=io.BytesIO(raw)) if raw[:2] == b"\x1f\x8b" else io.BytesIO(raw)
                for head, payload in parse(io.BufferedReader(stream, 1 << 20) if raw[:2] == b"\x1f\x8b" else stream):
                    full = head["warc-type"] != "revisit"
                    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode() if full else head["warc-payload-digest"].rpartition(":")[2]
                    if full and head["warc-payload-digest"] != f"sha1:{digest}":
                        raise ValueError(f"payload of {head['warc-record-id']} does not have its digest")
                    rows.append((_record_id(head["warc-record-id"]), head.get("warc-target-uri"), head["warc-type"], digest, _record_id(head.get("warc-refers-to")), len(payload) if full else None, payload if payloads and full else None))
                    held += len(payload) if payloads else 100
                    if held > 8 << 20:
                        yield _table(rows, names)
                        rows, held = [], 0
                yield _table(rows, names)

    return run


def _table(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary())
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def read(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """id, url, record_type, digest, refers_to, n_bytes (null for revisits) and payload of every record."""
    ship(spark)
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(_read_rows(payloads), "id long, url string, record_type string, digest string, refers_to long, n_bytes long, payload binary")


def archive_pages(pages: DataFrame, path: str | None = None, min_bytes: int = 0) -> DataFrame:
    """Writes the pages as one deduplicated archive, reads it back and gives every record with the size of the payload
    that it stands for."""
    spark = pages.sparkSession
    path = path or f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    write(records(pages), path, min_bytes)
    back = saved(read(spark, path, payloads=False).drop("payload", "url"), "back")
    revisits = back.where("record_type = 'revisit'")
    salt = F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")
    # responses that are referred to stand once for each salt: a response with many revisits is no hot key
    referred = revisits.select(F.col("refers_to").alias("__of"), F.col("digest").alias("__digest")).distinct()
    first = back.where("record_type = 'response'").select(F.col("id").alias("__of"), F.col("digest").alias("__digest"), F.col("n_bytes").alias("__bytes"))
    first = first.join(referred, ["__of", "__digest"], "left_semi").groupBy("__of", "__digest").agg(F.max("__bytes").alias("__bytes"))
    first = first.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    revisits = revisits.withColumn("__salt_of", salt).join(first, (F.col("refers_to") == F.col("__of")) & (F.col("digest") == F.col("__digest")) & (F.col("__salt_of") == F.col("__salt")))
    columns = ["id", "digest", "record_type", "refers_to"]
    both = revisits.select(*columns, F.col("__bytes").alias("n_bytes")).union(back.where("record_type = 'response'").select(*columns, "n_bytes"))
    return both.select(F.col("id").alias("page_id"), F.col("n_bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type", "refers_to")
