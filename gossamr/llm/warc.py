"""WARC archives with revisit records.

Writing: headers (page, digest, size) are shuffled by payload digest; each digest shared by several pages gets its
original, the page of least id; the other pages, and further copies of that one, become revisit records that refer to it,
without payload. Each record is one gzip member. Spark's text writer puts the members into files on any file system it knows, with its own commit
of tasks: a member's last byte (the top byte of its length) is 0 for records under 16 MB, so the members are written
without it, the line separator being that byte; larger records are followed by an empty member, that ends so too.
Reading: files are parsed as streams, digests checked, and revisit records joined to their originals' response records.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gossamr.llm.common import append, emit, field
from gossamr.session import materialize, scratch_path, sized

CRLF = "\r\n"
#: Fixed by the WARC 1.1 standard: the profile of revisit records with an identical payload.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Fixed alphabet of base32 (RFC 4648).
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """Base32 of the SHA-1 of a binary column, without padding: eight groups of 20 bits, four letters each."""
    digest = F.sha1(payload)
    letters = []
    for group in range(8):
        bits = F.conv(F.substring(digest, 5 * group + 1, 5), 16, 10).cast("int")
        letters += [F.lit(BASE32).substr(F.shiftright(bits, shift).bitwiseAND(31) + 1, F.lit(1)) for shift in (15, 10, 5, 0)]
    return F.concat(*letters)


def headers(pages: DataFrame) -> DataFrame:
    """pages (page_id, url, html) with payload (UTF-8 of html, null: empty), payload_bytes and payload_digest."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    return pages.select("page_id", "url", payload.alias("payload")).withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": base32_sha1(F.col("payload"))})


def resolve(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """headers() with revisit, refers_to and refers_to_url (page_id and url of the original), copy.

    Of the rows of a payload the one of least page_id, then url, is the original (null ids come last, null urls first),
    all others are revisits. Rows equal in page_id, url and payload are copies 0, 1, ..., of which only the first can be
    an original. Payloads under min_bytes bytes are not resolved.
    """
    rows, key = headers(pages), ["page_id", "url", "payload_digest"]
    keys = materialize(rows.groupBy(*key).agg(F.max("payload_bytes").alias("payload_bytes"), F.count("*").alias("n")), "warc-keys")
    named = F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", "url")
    shared = keys.filter(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest").agg(F.min(named).alias("first"), F.sum("n").alias("copies")).filter("copies > 1")
    shared = materialize(shared.select("payload_digest", F.lit(True).alias("shared"), F.col("first.page_id").alias("original"), F.col("first.url").alias("original_url")), "warc-originals")
    repeated = keys.filter("n > 1").select(*[F.col(c).alias(f"_{c}") for c in key], "n")
    if repeated.isEmpty():
        rows = rows.withColumn("copy", F.lit(0).cast("long"))
    else:
        same = F.lit(True)
        for c in key:
            same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
        tagged = rows.join(sized(repeated), same, "left")
        single = tagged.filter("n is null").select(*rows.columns, F.lit(0).cast("long").alias("copy"))
        once = tagged.filter("n is not null").groupBy(*key).agg(F.first("payload").alias("payload"), F.max("payload_bytes").alias("payload_bytes"), F.max("n").alias("n"))
        each = once.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("copy"))
        needs = (F.col("copy") == 0) | (F.col("payload_bytes") < min_bytes)  # a revisit has no payload
        rows = single.unionByName(each.withColumn("payload", F.when(needs, F.col("payload"))).select(*single.columns))
    joined = rows.join(sized(shared), "payload_digest", "left")
    first = F.col("original").eqNullSafe(F.col("page_id")) & F.col("original_url").eqNullSafe(F.col("url")) & (F.col("copy") == 0)
    revisit = F.col("shared").isNotNull() & ~first
    return joined.withColumns({"revisit": revisit, "refers_to": F.when(revisit, F.col("original")), "refers_to_url": F.when(revisit, F.col("original_url"))}).drop("shared", "original", "original_url")


def record_id(page_id: int | None, url: str | None, digest: str, copy: int = 0) -> str:
    """Names page, URL, payload and copy: no two records have the same."""
    name = f"page {page_id} {digest} {copy} {'-' if url is None else '+' + url}".encode("utf-8", "surrogatepass")
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha1(name).digest()[:16], version=5)}>"


def record(page_id, url, payload: bytes | None, digest: str, copy: int, revisit: bool, refers_to, refers_to_url, date: str) -> bytes:
    """One uncompressed WARC 1.1 record: a response, or a revisit of the original that refers_to and refers_to_url name."""
    http = f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}{CRLF}".encode()
    block = http if revisit else http + payload
    clean = lambda s: (s or "").replace("\r", "%0D").replace("\n", "%0A")
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id, url, digest, copy)}", f"WARC-Date: {date}", f"WARC-Target-URI: {clean(url)}", f"WARC-Payload-Digest: sha1:{digest}"]
    if page_id is not None:
        lines.append(f"WARC-Page-Number: {page_id}")
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to, refers_to_url, digest)}", f"WARC-Refers-To-Target-URI: {clean(refers_to_url)}", f"WARC-Refers-To-Date: {date}", "WARC-Truncated: length"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return (CRLF.join(lines) + CRLF + CRLF).encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def info(first: str, date: str) -> bytes:
    """The warcinfo record before the record named first."""
    block = f"software: gossamr{CRLF}format: WARC File Format 1.1{CRLF}".encode()
    name = uuid.UUID(bytes=hashlib.sha1(f"info before {first}".encode()).digest()[:16], version=5)
    lines = ["WARC/1.1", "WARC-Type: warcinfo", f"WARC-Record-ID: <urn:uuid:{name}>", f"WARC-Date: {date}", "Content-Type: application/warc-fields", f"Content-Length: {len(block)}"]
    return (CRLF.join(lines) + CRLF + CRLF).encode() + block + b"\r\n\r\n"


def member(raw: bytes, level: int) -> bytes:
    """The record's gzip member without its last byte, that is 0; see the module's text for large records."""
    packed = gzip.compress(raw, level, mtime=0)
    if packed[-1]:
        packed += gzip.compress(b"", level, mtime=0)
    return packed[:-1]


def write(pages: DataFrame, path: str, min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z", level: int = 3, part_bytes: int = 4 << 20, file_bytes: int = 32 << 20) -> None:
    """Write one record for each row of pages (page_id, url, html) to gzipped WARC files under path.

    Records are put together to parts of part_bytes compressed bytes, each after a warcinfo record, and parts to files:
    a file has file_bytes and what its parts' last records go beyond that.
    """
    inputs = ["page_id", "url", "payload", "payload_digest", "copy", "revisit", "refers_to", "refers_to_url"]

    def start():
        part, size = [], [0]

        def ended() -> list[list[bytes]]:
            made = b"\0".join(part)
            part.clear()
            size[0] = 0
            return [[made]]

        def work(*columns):
            done = []
            for row in zip(*columns, strict=True):
                if not part:
                    part.append(member(info(record_id(row[0], row[1], row[3], row[4]), date), level))
                part.append(member(record(*row, date), level))
                size[0] += len(part[-1])
                if size[0] >= part_bytes:
                    done += ended()[0]
            return [done] if done else None

        def last():
            if part:
                yield ended()

        return work, last

    rows = emit(resolve(pages, min_bytes), inputs, [field("part", "binary")], start, finish=True)
    rows.select(F.col("part").cast("string").alias("value")).write.option("lineSep", "\0").option("maxRecordsPerFile", max(1, file_bytes // part_bytes)).text(path)


def records(content: bytes):
    """(fields by lower-cased name, block) of each record of a gzipped WARC file, one in memory at a time."""
    with gzip.open(io.BytesIO(content)) as stream:
        while line := stream.readline():
            if not line.strip():
                continue
            if not line.startswith(b"WARC/"):
                raise ValueError(f"not the start of a WARC record: {line[:40]!r}")
            fields = {}
            while (line := stream.readline()).strip():
                name, _, value = line.decode("utf-8", "surrogatepass").partition(":")
                fields[name.lower()] = value.strip()
            yield fields, stream.read(int(fields["content-length"]))


def read(spark: SparkSession, path: str) -> DataFrame:
    """page_id, url, record_type, record_id, refers_to_id, payload_bytes, payload_digest of each record under path.

    The digest of each response's payload is computed and held against its header; revisit records have null bytes.
    """

    def start():
        def work(contents):
            rows = []
            for content in contents:
                for head, block in records(content):
                    if head["warc-type"] == "warcinfo":
                        continue
                    digest, size = head["warc-payload-digest"].removeprefix("sha1:"), None
                    if head["warc-type"] == "response":
                        payload = block[block.index(b"\r\n\r\n") + 4 :]
                        size = len(payload)
                        if base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                            raise ValueError(f"digest of {head['warc-record-id']} does not match its payload")
                    page = head.get("warc-page-number")
                    rows.append((None if page is None else int(page), head["warc-target-uri"], head["warc-type"], head["warc-record-id"], head.get("warc-refers-to"), size, digest))
            return [list(x) for x in zip(*rows, strict=True)] if rows else [[] for _ in range(7)]

        return work

    fields = [field("page_id", "long"), field("url", "string"), field("record_type", "string"), field("record_id", "string"), field("refers_to_id", "string"), field("payload_bytes", "long"), field("payload_digest", "string")]
    return emit(spark.read.format("binaryFile").load(path), ["content"], fields, start)


def resolved(index: DataFrame) -> DataFrame:
    """read()'s rows with refers_to (page_id) and payload_bytes of revisit records taken from their originals.

    Records are found by their id, which no two have in common.
    """
    index = materialize(index, "warc-index")
    revisits, responses = index.filter("record_type = 'revisit'"), index.filter("record_type = 'response'")
    wanted = sized(revisits.select(F.col("refers_to_id").alias("record_id")).distinct())
    originals = materialize(responses.join(wanted, "record_id", "left_semi").groupBy(F.col("record_id").alias("refers_to_id")).agg(F.min("page_id").alias("refers_to"), F.min("payload_bytes").alias("original_bytes")), "warc-targets")
    joined = revisits.join(sized(originals), "refers_to_id", "left").withColumn("payload_bytes", F.col("original_bytes"))
    columns = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return joined.select(*columns).unionByName(responses.withColumn("refers_to", F.lit(None).cast("long")).select(*columns))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes pages as WARC, reads the archives back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Null html is an empty payload, null url an empty URI. A page_id with several payloads has a record for each; of rows
    that repeat a page with its payload one at most is a response, the others are revisits of it. An empty table gives an empty one.
    """
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    path = scratch_path(spark, "warc")
    write(pages, path)
    return resolved(read(spark, path)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP4_SQL = r"""
WITH h AS (SELECT page_id, url, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS hex FROM pages),
o AS (SELECT *, row_number() OVER own AS place, first_value(page_id) OVER own AS original FROM h
  WINDOW own AS (PARTITION BY hex ORDER BY page_id NULLS LAST, url NULLS FIRST)),
b AS (SELECT hex, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((CAST('0x' || substr(hex, CAST(5 * (i // 4) + 1 AS INT), 5) AS INTEGER) >> CAST(15 - 5 * (i % 4) AS INT)) & 31 AS INT) + 1, 1), '' ORDER BY i) AS digest
  FROM (SELECT DISTINCT hex FROM h), range(32) r(i) GROUP BY hex)
SELECT page_id, CAST(octet_length(encode(body)) AS BIGINT) AS payload_bytes, digest AS payload_digest,
  CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN place > 1 THEN original END AS refers_to
FROM o JOIN b USING (hex)
"""
