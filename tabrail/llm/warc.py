"""WARC records in a content-addressed archive.

An archive is a folder with two Parquet tables:

* ``payloads``: every distinct payload once, under its SHA-256, with its
  length. A payload is stored only after the rows that share the digest agree
  on its length and SHA-1, and every read hashes the stored bytes again and
  compares them with their key: a damaged payload ends the job.
* ``records``: one row per record: its exact header (the WARC lines and the
  HTTP lines, byte for byte), the payload's key, and its place.

``read_records`` gives the original records back by joining the two; a
revisit's record is its header alone, and its payload is found through the
record that it refers to. ``export_warc`` writes the records as plain WARC
files, ``import_warc`` reads such files (gzip or not) by their lengths.

Of records with equal payloads of ``least`` bytes or more, the one with the
largest page_id is the response and the others revisit it.

Scale: rows are hashed where they are scanned. A payload crosses one shuffle
to be stored once (equal ones are combined in the map tasks first) and one to
be read back; the choice of responses moves digests only. The join on a digest
that a third of the records share is split by adaptive execution; the payload
side has one row a digest.

Rows: a null html is an empty payload; a null url leaves its line out, control
characters and spaces in a url are percent-encoded in the header; a null
page_id is smaller than any number; repeated rows each get a record, and of
equal ids one is the response (ties by url, then by place); other columns are
not read; an empty table gives an empty archive. A payload may be as long as
Spark lets a value be (2 GB).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabrail.config import work_dir
from tabrail.llm.common import table

VERSION = "WARC/1.1"
CRLF = "\r\n"
#: Fixed value of the standard: the profile of revisits found by payload digest.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Payloads of at least this many bytes are revisited, smaller ones repeated.
LEAST = 1000
#: Capture time written when the pages carry none.
DATE = "1970-01-01T00:00:00Z"


def _lines(*pairs: tuple[str, Column]) -> Column:
    """Header lines; a null value leaves its line out."""
    return F.concat_ws("", *[F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)) for name, value in pairs])


def _uri(url: Column) -> Column:
    for c in [*range(0x21), 0x7F]:
        url = F.replace(url, F.lit(chr(c)), F.lit(f"%{c:02X}"))
    return url


def _record_id(page: Column, seq: Column) -> Column:
    h = F.md5(F.concat_ws(":", F.lit("record"), page.cast("string"), seq.cast("string")))
    cut = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in cut]), F.lit(">"))


def write_archive(pages: DataFrame, root: str, least: int = LEAST, date: str = DATE) -> str:
    """Store page_id, url, html rows as an archive in ``root``."""
    spark = pages.sparkSession
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    hashed = pages.select(F.col("page_id").cast("long").alias("page_id"), _uri(F.col("url").cast("string")).alias("uri"), payload.alias("payload")).select(
        "*", F.sha2("payload", 256).alias("key"), F.sha1("payload").alias("sha1"), F.octet_length("payload").cast("long").alias("length"))
    facts = hashed.select("page_id", "uri", "key", "sha1", "length").withColumn("seq", F.monotonically_increasing_id())
    facts.write.mode("overwrite").parquet(f"{root}/facts")
    facts = spark.read.parquet(f"{root}/facts")

    bad = F.raise_error(F.concat(F.lit("unequal payloads under digest "), F.col("key")))
    same = (F.col("low") == F.col("high")) & (F.col("one") == F.col("other"))
    (hashed.groupBy("key").agg(F.first("payload").alias("payload"), F.min("length").alias("low"), F.max("length").alias("high"), F.min("sha1").alias("one"), F.max("sha1").alias("other"))
     .select(F.when(same, F.col("key")).otherwise(bad).alias("key"), F.col("high").alias("length"), "payload")
     .write.mode("overwrite").option("compression", "zstd").parquet(f"{root}/payloads"))

    order = F.struct(F.coalesce("page_id", F.lit(-(1 << 63))), F.coalesce("uri", F.lit("")), "seq").alias("o")
    chosen = (facts.where(F.col("length") >= least).groupBy("key")
              .agg(F.max(F.struct(order, "page_id", "seq")).alias("m"), F.count(F.lit(1)).alias("n")).where("n > 1")
              .select("key", F.col("m.page_id").alias("to_page"), F.col("m.seq").alias("to_seq")))
    rows = facts.join(chosen, "key", "left")
    revisit = F.col("to_seq").isNotNull() & (F.col("to_seq") != F.col("seq"))
    own, other = _record_id(F.col("page_id"), F.col("seq")), _record_id(F.col("to_page"), F.col("to_seq"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    F.col("length").cast("string"), F.lit(CRLF + CRLF))
    block = F.octet_length(http) + F.when(revisit, F.lit(0).cast("long")).otherwise(F.col("length"))
    head = F.concat(F.lit(VERSION + CRLF), _lines(
        ("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        ("WARC-Record-ID", own),
        ("WARC-Date", F.lit(date)),
        ("WARC-Target-URI", F.col("uri")),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        ("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        ("WARC-Refers-To", F.when(revisit, other)),
        ("X-Page-ID", F.col("page_id").cast("string")),
        ("Content-Type", F.lit("application/http; msgtype=response")),
        ("Content-Length", block.cast("string"))), F.lit(CRLF))
    (rows.select("seq", F.concat(head, http).cast("binary").alias("header"), F.when(~revisit, F.col("key")).alias("key"))
     .write.mode("overwrite").parquet(f"{root}/records"))
    return root


def payload_store(spark: SparkSession, root: str) -> DataFrame:
    """key, length, payload; every payload is hashed again and compared with its key."""
    stored = spark.read.parquet(f"{root}/payloads")
    bad = F.raise_error(F.concat(F.lit("damaged payload "), F.col("key")))
    sound = (F.sha2("payload", 256) == F.col("key")) & (F.octet_length("payload") == F.col("length"))
    return stored.select(F.when(sound, F.col("key")).otherwise(bad).alias("key"), "length", "payload")


def read_records(spark: SparkSession, root: str) -> DataFrame:
    """seq, record: the original records, byte for byte (without the two line ends that follow one in a file)."""
    rows = spark.read.parquet(f"{root}/records")
    held = rows.where("key is not null").join(payload_store(spark, root), "key")
    whole = held.select("seq", F.concat("header", "payload").alias("record"))
    return whole.unionByName(rows.where("key is null").select("seq", F.col("header").alias("record")))


def parse_records(records: DataFrame) -> DataFrame:
    """Header fields and payload of records: record_id, record_type, refers_uri, page_id, url, digest, payload.

    A record whose block is not as long as its header says ends the job."""
    def field(name: str) -> Column:
        value = F.regexp_extract("head", rf"(?im)^{name}: ?(.*?)\r?$", 1)
        return F.when(value != "", value)

    def cut(data: str, head: str) -> list[Column]:
        """The part before the first empty line, and the bytes behind it."""
        text = F.substring_index(F.col(data).cast("string"), CRLF + CRLF, 1)
        return [text.alias(head), F.expr(f"substring({data}, octet_length(substring_index(CAST({data} AS STRING), '\\r\\n\\r\\n', 1)) + 5)").alias("rest")]

    outer = records.select(*[c for c in records.columns if c != "record"], *cut("record", "head")).withColumnRenamed("rest", "block")
    bad = F.raise_error(F.concat(F.lit("record of another length: "), F.col("head")))
    sound = F.octet_length("block") == field("Content-Length").cast("long")
    return outer.select("*", *cut("block", "http")).select(
        *[c for c in records.columns if c != "record"],
        F.when(sound, field("WARC-Type")).otherwise(bad).alias("record_type"), field("WARC-Record-ID").alias("record_id"),
        field("WARC-Refers-To").alias("refers_uri"), field("WARC-Target-URI").alias("url"), field("X-Page-ID").cast("long").alias("page_id"),
        F.regexp_replace(field("WARC-Payload-Digest"), "^sha1:", "").alias("digest"), F.col("rest").alias("payload"))


def read_pages(spark: SparkSession, root: str) -> DataFrame:
    """Per record: page_id, payload_bytes, payload_digest, record_type, refers_to, url.

    Lengths and digests are those of the payloads that the rebuilt records
    hold; a revisit takes them from the record that it refers to."""
    bad = F.raise_error(F.concat(F.lit("digest of another payload: "), F.col("record_id")))
    parsed = parse_records(read_records(spark, root)).select(
        "page_id", "url", "record_type", "record_id", "refers_uri", "digest", F.octet_length("payload").cast("long").alias("size"),
        F.when(F.col("record_type") == "response", F.sha1("payload")).alias("sha1"))
    parsed.write.mode("overwrite").parquet(f"{root}/parsed")
    parsed = spark.read.parquet(f"{root}/parsed")
    full = parsed.where("record_type = 'response'")
    sound = F.col("digest") == F.col("sha1")
    own = full.select("page_id", F.col("size").alias("payload_bytes"), F.when(sound, F.col("sha1")).otherwise(bad).alias("payload_digest"),
                      "record_type", F.lit(None).cast("long").alias("refers_to"), "url")
    target = full.select(F.col("record_id").alias("refers_uri"), F.col("size").alias("payload_bytes"), F.col("sha1").alias("full_sha1"), F.col("page_id").alias("refers_to"))
    found = parsed.where("record_type = 'revisit'").join(target, "refers_uri", "left")
    sound = F.col("digest").eqNullSafe(F.col("full_sha1"))
    other = found.select("page_id", "payload_bytes", F.when(sound, F.col("digest")).otherwise(bad).alias("payload_digest"), "record_type", "refers_to", "url")
    return own.unionByName(other)


def export_warc(spark: SparkSession, root: str, path: str, records_per_file: int = 10_000, compression: str = "gzip") -> str:
    """Write the archive's records as WARC files, one set of files per task."""
    rows = read_records(spark, root).select(F.col("record").cast("string").alias("value"))
    (rows.write.mode("overwrite").option("lineSep", CRLF + CRLF).option("maxRecordsPerFile", records_per_file)
     .option("compression", compression).text(path))
    return path


def split_warc(data: bytes) -> Iterator[bytes]:
    """The records of a WARC file, cut by their own lengths."""
    if data[:2] == b"\x1f\x8b":
        # One gzip member a record or one for all.
        out = []
        while data:
            d = zlib.decompressobj(31)
            out.append(d.decompress(data) + d.flush())
            data = d.unused_data
        data = b"".join(out)
    at = 0
    while at < len(data):
        cut = data.index(b"\r\n\r\n", at) + 4
        size = next(int(line.split(b":", 1)[1]) for line in data[at:cut].split(b"\r\n") if line.lower().startswith(b"content-length:"))
        if cut + size > len(data):
            raise ValueError("a record ends behind its file")
        yield data[at:cut + size]
        at = cut + size + 4


def import_warc(spark: SparkSession, path: str) -> DataFrame:
    """record: the records of all WARC files below ``path``; one file a task at a time."""
    def rows(batches):
        for b in batches:
            for content in b.column("content"):
                for r in split_warc(content.as_py()):
                    yield pa.RecordBatch.from_pydict({"record": pa.array([r], pa.binary())})

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(rows, "record binary")


def op12_content_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = work_dir(spark, "warc")
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)
    write_archive(table(spark, sf_dir, "pages"), root)
    return read_pages(spark, root).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = f"""WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest,
         max(page_id) OVER (PARTITION BY coalesce(html, '')) AS last
  FROM pages)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= {LEAST} AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= {LEAST} AND page_id <> last THEN last END AS refers_to
FROM p"""
