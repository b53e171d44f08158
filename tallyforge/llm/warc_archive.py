"""WARC archives with content-addressed payloads.

Record headers are kept exactly, one row per record; payload bytes are stored once per
SHA-256 digest, each compressed as a gzip member.  Original records come back by joining
headers and payloads on the digest, and every stored payload is verified against it.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.llm.bpe import slices, text_sizes
from tallyforge.llm.shared import Scratch, maybe_among, shared_dir

CRLF = "\r\n"
MEMBER = "digest string, size long, member binary"
#: Payloads below this size are always stored as responses of their own.
LEAST_REVISIT = 100


def _field(name: str, value: Column) -> Column:
    """A header line, or nothing if the value is null; line breaks in values are percent-encoded."""
    safe = F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.when(value.isNull(), F.lit("")).otherwise(F.concat(F.lit(f"{name}: "), safe, F.lit(CRLF)))


def _record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), page_id.cast("string"), F.lit(">"))


def write_archive(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", date: str = "2024-01-01T00:00:00Z"
) -> None:
    """Write one WARC record per row of `pages` under `path`/headers and `path`/payloads.

    The payload is the text in UTF-8 (null: empty).  Among records with equal payloads of at
    least 100 bytes, the one with the smallest id is a response and the others revisit it;
    smaller payloads are all responses.  Rows without an id are responses that nothing
    refers to; rows that repeat the smallest id are all responses.  A null url leaves out the
    target URI.  Further columns are ignored.  A payload is stored once however often it
    occurs; should two payloads of one digest differ, writing fails.
    """
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(payload_col), F.lit("")).alias("text"),
    )
    bytes_ = F.encode("text", "UTF-8")
    scratch = Scratch(pages.sparkSession, "warc")
    heads = scratch.save(
        rows.select("page_id", "url", F.sha2(bytes_, 256).alias("digest"), F.octet_length("text").cast("long").alias("size"), F.crc32(bytes_).alias("crc32")), "heads"
    )
    # Only ids and digests shuffle here, combined on the map side.
    check = F.struct("size", "crc32")
    groups = heads.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"), F.min(check).alias("lo"), F.max(check).alias("hi"))
    same = F.when(F.col("lo") == F.col("hi"), F.col("digest")).otherwise(
        F.raise_error(F.concat(F.lit("different payloads share the digest "), "digest")).cast("string")
    )
    first = scratch.save(groups.select(same.alias("digest"), "first", "n"), "first")
    later = (F.col("page_id") > F.col("first")) & (F.col("size") >= LEAST_REVISIT)
    typed = heads.join(first, "digest", "left").withColumn("revisit", F.coalesce(later, F.lit(False)))
    length = F.when(F.col("revisit"), F.lit(0)).otherwise(F.col("size")).cast("string")
    header = F.concat(
        F.lit("WARC/1.1" + CRLF),
        _field("WARC-Type", F.when(F.col("revisit"), "revisit").otherwise("response")),
        _field("WARC-Record-ID", _record_id(F.col("page_id"))),
        _field("WARC-Target-URI", F.col("url")),
        _field("WARC-Date", F.lit(date)),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
        _field("WARC-Refers-To", F.when(F.col("revisit"), _record_id(F.col("first")))),
        _field("WARC-Profile", F.when(F.col("revisit"), F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        _field("Content-Type", F.lit("text/html; charset=utf-8")),
        _field("Content-Length", length),
        F.lit(CRLF),
    )
    typed.select(header.alias("header")).write.mode("overwrite").parquet(f"{path}/headers")

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, text_sizes(whole.column("text"))):
                raw = [t.encode("utf-8", "surrogatepass") for t in batch.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([hashlib.sha256(x).hexdigest() for x in raw]),
                        pa.array([len(x) for x in raw], pa.int64()),
                        pa.array([zlib.compress(x, 6, wbits=31) for x in raw], pa.binary()),
                    ],
                    names=["digest", "size", "member"],
                )

    # Payloads that occur once pass straight through; of the others, only the first page is compressed.
    copied, (n_copied, _) = scratch.save_signed(first.where("n > 1").select("digest", "first", F.xxhash64("digest").alias("key")), "copied")
    keyed = rows.select("page_id", "text", F.sha2(bytes_, 256).alias("digest"), F.xxhash64(F.sha2(bytes_, 256)).alias("key"))
    marked = maybe_among(keyed, "key", copied, n_copied)
    chosen = marked.where("__maybe").join(copied.drop("key"), "digest").where(F.col("page_id").eqNullSafe(F.col("first"))).select("text")
    known_once = marked.where("__maybe").join(copied, "digest", "left_anti").select("text")
    stored = marked.where("not __maybe").select("text").unionByName(known_once).mapInArrow(compress, MEMBER)
    # Rows that repeat the first id too are stored once.
    folded = chosen.mapInArrow(compress, MEMBER).groupBy("digest").agg(F.first("size").alias("size"), F.first("member").alias("member"))
    stored.unionByName(folded).write.mode("overwrite").option("compression", "uncompressed").parquet(f"{path}/payloads")
    scratch.drop("heads", "first", "copied")


def header_value(name: str, header: Column) -> Column:
    """The value of a header field, null if it is absent."""
    found = F.regexp_extract(header, f"\\n{name}: ([^\\r\\n]*)\\r\\n", 1)
    return F.when(found != "", found)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """The original records: header (exact), record_type, page_id, refers_to, target_uri, digest, payload, verified.

    `payload` is the full payload, of revisits too.  `verified` says that its bytes give the
    digest in the header.
    """
    header = F.col("header")
    heads = spark.read.schema("header string").parquet(f"{path}/headers").select(
        "header",
        header_value("WARC-Type", header).alias("record_type"),
        F.regexp_extract(header, r"WARC-Record-ID: <urn:page:(-?\d+)>", 1).try_cast("long").alias("page_id"),
        F.regexp_extract(header, r"WARC-Refers-To: <urn:page:(-?\d+)>", 1).try_cast("long").alias("refers_to"),
        header_value("WARC-Target-URI", header).alias("target_uri"),
        F.regexp_extract(header, r"WARC-Payload-Digest: sha256:([0-9a-f]{64})", 1).alias("digest"),
    )
    payloads = spark.read.schema(MEMBER).parquet(f"{path}/payloads")
    joined = heads.join(payloads, "digest")

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, whole.column("size").to_numpy()):
                payload = [zlib.decompress(x, wbits=31) for x in batch.column("member").to_pylist()]
                digests = [hashlib.sha256(x).hexdigest() for x in payload]
                good = [a == b for a, b in zip(digests, batch.column("digest").to_pylist(), strict=True)]
                kept = ["header", "record_type", "page_id", "refers_to", "target_uri", "digest"]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in kept), pa.array(payload, pa.binary()), pa.array(good)], names=[*kept, "payload", "verified"]
                )

    return joined.mapInArrow(
        expand,
        "header string, record_type string, page_id long, refers_to long, target_uri string, digest string, payload binary, verified boolean",
    )


def record_bytes(records: DataFrame) -> Column:
    """A record as it stands in an archive: header, block (empty for revisits), two line ends."""
    block = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
    return F.concat(F.encode("header", "UTF-8"), block, F.lit(b"\r\n\r\n"))


def archive_path(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
