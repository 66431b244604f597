"""WARC archives with revisit records.

Headers (id, payload digest, payload length) are grouped by digest; of equal
payloads of at least ``min_bytes`` the smallest id is the response, the others
become revisit records without payload.  Spark's text writer writes the
archives: a record is header block, empty line and payload, and the two line
breaks that end a record are the writer's line separator, so each part file is
a WARC file (gzip).  Reading parses the files by Content-Length and gives a
revisit the length of its original response through a join on the digest.

Defined cases: null html is an empty payload; payloads under ``min_bytes`` are
always responses; rows that share the smallest id are all responses; a null id
is never the smallest, and rows whose equals all have null ids are responses;
an empty table gives an archive without records; other input columns are not
archived.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wareloom.session import scratch_path, ship_package

END = "\r\n\r\n"
DATE = "2000-01-01T00:00:00Z"  # fixed, so that reruns write equal archives
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = "page_id long, url string, record_type string, payload_digest string, payload_bytes long, refers_to long, whole boolean"


def headers(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, its digest and its length in bytes."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"),
                        F.sha2(payload.cast("binary"), 256).alias("payload_digest"), F.octet_length(payload).cast("long").alias("payload_bytes"))


def resolve(records: DataFrame, min_bytes: int = 100) -> DataFrame:
    """``records`` with record_type and refers_to (the response's page_id for revisits)."""
    first = (records.where(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest")
             .agg(F.min("page_id").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n"))
    out = records.join(first, "payload_digest", "left")
    again = F.col("_first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first")) & (F.col("payload_bytes") >= min_bytes)
    return out.withColumns({"record_type": F.when(again, "revisit").otherwise("response"), "refers_to": F.when(again, F.col("_first"))}).drop("_first")


def _urn(digest: F.Column) -> F.Column:
    part = lambda a, n: F.substring(digest, a, n)
    return F.concat(F.lit("<urn:uuid:"), part(1, 8), F.lit("-"), part(9, 4), F.lit("-"), part(13, 4), F.lit("-"), part(17, 4), F.lit("-"), part(21, 12), F.lit(">"))


def _record_id(page_id: F.Column, digest: F.Column) -> F.Column:
    return _urn(F.md5(F.concat_ws("|", F.coalesce(page_id.cast("string"), F.lit("null")), digest).cast("binary")))


def write(records: DataFrame, path: str) -> None:
    """Write resolved records as gzip WARC part files under ``path``."""
    line = lambda name, value: F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))
    revisit = F.col("record_type") == "revisit"
    uri = F.regexp_replace(F.col("url"), r"[\r\n]", " ")
    block = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    text = F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", F.col("record_type")), line("WARC-Record-ID", _record_id(F.col("page_id"), F.col("payload_digest"))),
        line("WARC-Date", F.lit(DATE)), line("WARC-Target-URI", uri), line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "payload_digest")),
        F.when(revisit, line("WARC-Profile", F.lit(PROFILE))).otherwise(""),
        F.when(revisit, line("WARC-Refers-To", _record_id(F.col("refers_to"), F.col("payload_digest")))).otherwise(""),
        line("X-Page-Id", F.col("page_id").cast("string")), F.when(revisit, line("X-Refers-To-Page-Id", F.col("refers_to").cast("string"))).otherwise(""),
        line("Content-Type", F.lit("text/html")), line("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"), block)
    records.select(text.alias("value")).write.mode("overwrite").option("lineSep", END).option("compression", "gzip").text(path)


def parse(raw: bytes):
    """(headers, block) of every record of a WARC file; a broken record raises."""
    at = 0
    while at < len(raw):
        stop = raw.find(b"\r\n\r\n", at)
        if stop < 0 or not raw.startswith(b"WARC/1.", at):
            raise ValueError(f"no WARC header at byte {at}")
        fields = dict(x.split(": ", 1) for x in raw[at:stop].decode("utf-8").split("\r\n")[1:])
        begin = stop + 4
        at = begin + int(fields["Content-Length"])
        if raw[at : at + 4] != b"\r\n\r\n":
            raise ValueError(f"record {fields.get('WARC-Record-ID')} is cut short")
        yield fields, raw[begin:at]
        at += 4


def _read(batches):
    import gzip

    names = [x.strip().split(" ")[0] for x in RECORD.split(",")]
    types = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.bool_()]
    for batch in batches:
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
            raw = content.as_py()
            rows = []
            for f, block in parse(gzip.decompress(raw) if path.endswith(".gz") else raw):
                digest = f["WARC-Payload-Digest"].partition(":")[2]
                response = f["WARC-Type"] == "response"
                number = lambda k: int(f[k]) if k in f else None  # noqa: E731, B023
                rows.append((number("X-Page-Id"), f.get("WARC-Target-URI"), f["WARC-Type"], digest, len(block) if response else None,
                             number("X-Refers-To-Page-Id"), not response or hashlib.sha256(block).hexdigest() == digest))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records of the archives under ``path``; ``whole``: the payload has its digest."""
    ship_package(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    return files.mapInArrow(_read, RECORD)


def read_back(spark: SparkSession, path: str) -> DataFrame:
    """Records with the payload length of revisits taken from their responses."""
    records = read(spark, path)
    responses = records.where("record_type = 'response'").groupBy("payload_digest").agg(F.max("payload_bytes").alias("_bytes"))
    revisits = records.where("record_type = 'revisit'").join(responses, "payload_digest", "left")
    revisits = revisits.withColumn("payload_bytes", F.col("_bytes")).drop("_bytes")
    return records.where("record_type = 'response'").unionByName(revisits)


def archive(pages: DataFrame, path: str | None = None, min_bytes: int = 100) -> DataFrame:
    """Write deduplicated archives of ``pages`` and read them back."""
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    write(resolve(headers(pages), min_bytes), path)
    back = read_back(spark, path)
    intact = F.when(F.col("whole"), F.col("payload_bytes")).otherwise(F.raise_error(F.concat(F.lit("damaged payload of page "), F.col("page_id").cast("string"))))
    return back.withColumn("payload_bytes", intact.cast("long")).drop("whole")
