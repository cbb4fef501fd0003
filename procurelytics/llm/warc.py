"""WARC archives through a chunked record table.

Payloads become rows (record, chunk number, chunk).  Chunk rows stream through the tasks with an
incremental digest, and each is written as one WARC segment: the first with the record's fields, the
others as continuation records.  No task holds a whole payload as one value of its own.

Archives are written and read by Spark's text source: records are set apart by the version line.
Where a payload holds that line, it is cut inside it, so the line never stands in a block."""

from __future__ import annotations

import base64
import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from procurelytics.llm.common import bounded_batches, whole_text
from procurelytics.session import cut_lineage, scratch_path

#: Characters of one chunk, so at most four times as many bytes.
CHUNK_CHARS = 262_144
VERSION, BREAK = "WARC/1.1\r\n", "\r\n"
#: Where the version line, or its start at the end of a chunk, is cut.
_START = "WARC/1"
_INSIDE = rf"(?<={_START})(?=\.1(?:\r\n|\z))"
NO_DATE = "1970-01-01T00:00:00Z"


def chunk_table(df: DataFrame, record: str, payload: str, *others: str) -> DataFrame:
    """(record, others..., chunk_no, chunk, last): the payload in chunks, in order, in one partition.
    A NULL payload is one empty chunk."""
    text = whole_text(payload)
    starts = F.sequence(F.lit(0), F.greatest(F.ceil(F.length(text) / CHUNK_CHARS) - 1, F.lit(0)).cast("int"))
    whole = F.when(F.octet_length(text) <= CHUNK_CHARS, F.array(text)).otherwise(F.transform(starts, lambda i: F.substring(text, i * CHUNK_CHARS + 1, F.lit(CHUNK_CHARS))))
    # few texts hold the line at all, and the pattern is slow
    cut = F.when(F.contains(text, F.lit(_START)), F.flatten(F.transform(whole, lambda c: F.split(c, _INSIDE)))).otherwise(whole)
    parts = df.select(record, *others, F.posexplode(F.transform(cut, lambda c, i: F.struct(c.alias("chunk"), i.alias("n")))).alias("chunk_no", "_c"),
                      F.size(cut).alias("_n"))
    return parts.select(record, *others, "chunk_no", F.col("_c.chunk").alias("chunk"), (F.col("chunk_no") == F.col("_n") - 1).alias("last"))


def _base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def _digest_rows(batches):
    """Over chunk rows in order: one row per record, from a digest that is carried along."""
    sha, size = hashlib.sha1(), 0
    for batch in batches:
        out = []
        for record, number, chunk, last in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3).to_pylist()):
            if number == 0:
                sha, size = hashlib.sha1(), 0
            data = chunk.as_buffer()
            sha.update(data)
            size += len(data)
            if last:
                out.append((record, size, _base32(sha.digest())))
        ids, sizes, digests = zip(*out) if out else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(digests, pa.string())], names=["row", "payload_bytes", "payload_digest"])


_DIGESTS = "row long, payload_bytes long, payload_digest string"


def payload_digests(chunks: DataFrame) -> DataFrame:
    """(row, payload_bytes, payload_digest) of each record of a chunk table."""
    return chunks.select("row", "chunk_no", F.col("chunk").cast("binary"), "last").mapInArrow(_digest_rows, _DIGESTS)


def _header(name: str, value: Column) -> Column:
    """A header line, empty where the value is NULL."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(BREAK)), F.lit(""))


def _record_id(page: Column) -> Column:
    """A stable identifier from the number of the record."""
    return F.concat(F.lit("<urn:record:"), page.cast("string"), F.lit(">"))


def write_archives(pages: DataFrame, path: str, min_payload: int = 0) -> None:
    """Write a WARC record per row of ``pages`` (page_id, url, html) under ``path``.

    Of the records with equal payloads of at least ``min_payload`` bytes, that with the smallest
    page_id is a response, the others are revisits without block that name it; shorter ones are all
    responses.  A NULL or empty html has an empty payload; a NULL url gives a record without target;
    control characters of a url become blanks, and one that ends in
    the version gets a blank after it.  Rows without page_id are left out.  Of rows that
    repeat a page_id one is written: the one with the least (url, html).  An empty table gives an
    archive without records.  Equal payloads meet as (digest, size, page_id), never as payloads."""
    spark = pages.sparkSession
    bounded_batches(spark)
    # the one shuffle of payloads: repeated page_ids meet, and all that follows is keyed alike
    rows = pages.where("page_id is not null").groupBy(F.col("page_id").cast("long").alias("row")).agg(
        F.min(F.struct(F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))).alias("r")).select("row", "r.url", "r.html")
    digests = cut_lineage(payload_digests(chunk_table(rows, "row", "html")))  # read twice below, and small
    first = digests.groupBy("payload_digest", "payload_bytes").agg(F.min("row").alias("first"), F.count("*").alias("n")).where(
        (F.col("n") > 1) & (F.col("payload_bytes") >= min_payload)).drop("n")
    known = digests.join(first, ["payload_digest", "payload_bytes"], "left").withColumn("first", F.coalesce("first", "row"))
    chunks = chunk_table(rows, "row", "html", "url")
    joined = chunks.join(known, "row").where((F.col("first") == F.col("row")) | (F.col("chunk_no") == 0))
    revisit = F.col("first") != F.col("row")
    later = F.col("chunk_no") > 0
    block = F.when(revisit, F.lit("")).otherwise(F.col("chunk"))
    whole = F.col("last") & ~later
    kind = F.when(revisit, F.lit("revisit")).when(later, F.lit("continuation")).otherwise(F.lit("response"))
    text = F.concat(
        F.lit(VERSION), _header("WARC-Type", kind),
        _header("WARC-Record-ID", F.when(later, F.concat(F.lit("<urn:record:"), F.col("row").cast("string"), F.lit(":"), F.col("chunk_no").cast("string"), F.lit(">"))).otherwise(_record_id(F.col("row")))),
        _header("WARC-Date", F.lit(NO_DATE)),
        _header("WARC-Target-URI", F.when(~later, F.regexp_replace(F.regexp_replace("url", r"[\x00-\x1F\x7F]", " "), r"WARC/1\.1$", "WARC/1.1 "))),
        _header("WARC-Payload-Digest", F.when(~later, F.concat(F.lit("sha1:"), F.col("payload_digest")))),
        _header("WARC-Payload-Length", F.when(~later, F.col("payload_bytes"))),
        _header("WARC-Profile", F.when(revisit, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        _header("WARC-Refers-To", F.when(revisit, _record_id(F.col("first")))),
        _header("WARC-Segment-Number", F.when(~revisit & ~whole, F.col("chunk_no") + 1)),
        _header("WARC-Segment-Origin-ID", F.when(later, _record_id(F.col("row")))),
        _header("WARC-Segment-Total-Length", F.when(later & F.col("last"), F.col("payload_bytes"))),
        _header("Content-Type", F.lit("text/html; charset=utf-8")),
        _header("Content-Length", F.octet_length(block)), F.lit(BREAK), block, F.lit(BREAK),
    )
    # the writer adds the last line break of each record
    joined.select(text.alias("value")).write.option("lineSep", BREAK).option("compression", "gzip").text(path)


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """The segments of all archives under ``path``: row, url, record_type, refers_to, the stated
    digest and length, chunk_no, chunk (exactly Content-Length bytes) and last."""
    raw = spark.read.option("lineSep", VERSION).schema("value string").text(path).where("value <> ''")
    head = F.substring_index("value", BREAK * 2, 1)

    def field(name):
        found = F.regexp_extract("_head", rf"(?:^|\r\n){name}: ([^\r\n]*)", 1)
        return F.when(found != "", found)

    def number(value):
        return F.regexp_extract(value, r"<urn:record:(-?\d+)", 1).cast("long")

    d = raw.select("value", F.explode(F.array(head)).alias("_head"))
    kind, segment, origin = field("WARC-Type"), field("WARC-Segment-Number").cast("int"), field("WARC-Segment-Origin-ID")
    d = d.select(
        number(F.coalesce(origin, field("WARC-Record-ID"))).alias("row"), field("WARC-Target-URI").alias("url"), kind.alias("record_type"),
        number(field("WARC-Refers-To")).alias("refers_to"), F.substring(field("WARC-Payload-Digest"), 6, 32).alias("stated_digest"),
        field("WARC-Payload-Length").cast("long").alias("stated_bytes"), F.coalesce(segment - 1, F.lit(0)).alias("chunk_no"),
        (segment.isNull() | field("WARC-Segment-Total-Length").isNotNull()).alias("last"),
        F.substring(F.col("value").cast("binary"), F.octet_length("_head") + 5, field("Content-Length").cast("int")).alias("chunk"))
    return d


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: row, payload_bytes, payload_digest, record_type, refers_to.

    Digest and length of responses are computed anew from the blocks; those of revisits are the
    stated ones, and are compared with the response they name.  Records in one segment are digested
    where they are read; only the segments of longer ones are brought together, sorted, and streamed.
    A response whose content differs from what its fields state raises an error."""
    segments = read_segments(spark, path)
    columns = ["row", "chunk_no", "chunk", "last"]
    short = segments.where((F.col("chunk_no") == 0) & F.col("last") & (F.col("record_type") == "response"))
    long = segments.where((F.col("chunk_no") > 0) | ~F.col("last"))
    found = short.select(columns).mapInArrow(_digest_rows, _DIGESTS).unionByName(
        long.select(columns).repartition("row").sortWithinPartitions("row", "chunk_no").mapInArrow(_digest_rows, _DIGESTS))
    stated = segments.where((F.col("chunk_no") == 0)).select("row", "record_type", "refers_to", "stated_digest", "stated_bytes")
    responses = stated.where("record_type = 'response'").join(found, "row", "left").select(
        "row", F.when(F.coalesce((F.col("payload_digest") == F.col("stated_digest")) & (F.col("payload_bytes") == F.col("stated_bytes")), F.lit(False)), F.col("payload_bytes")).otherwise(
            F.raise_error(F.concat(F.lit("payload differs from its fields: "), F.col("row").cast("string"))).cast("long")).alias("payload_bytes"),
        "payload_digest", "record_type", F.lit(None).cast("long").alias("refers_to"))
    revisits = stated.where("record_type = 'revisit'").select("row", F.col("stated_bytes").alias("payload_bytes"), F.col("stated_digest").alias("payload_digest"), "record_type", "refers_to")
    return responses.unionByName(revisits)


def warc_rows(pages: DataFrame) -> DataFrame:
    """Write the archives to the shared folder and read them back."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(pages, path)
    return read_records(spark, path).withColumnRenamed("row", "page_id")


_DIGIT = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((CAST('0x' || substr(d, 1 + 5 * (i // 4), 5) AS INTEGER) >> (15 - 5 * (i % 4))) & 31), 1)"
SQL = f"""
SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, array_to_string(list_transform(range(0, 32), lambda i: {_DIGIT}), '') AS payload_digest,
  CASE WHEN page_id = f THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> f THEN f END AS refers_to
FROM (SELECT *, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS f, sha1(coalesce(html, '')) AS d FROM pages)
"""
