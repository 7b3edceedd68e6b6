"""WARC archives with revisit records: write, resolve equal payloads, read back.

Headers are shuffled by payload digest: payloads are digested where they are read, the digests are grouped, and
of equal payloads the record with the smallest page id stays a response while the others become
revisit records that refer to it. The digests that occur more than once are counted: up to FEW_DIGESTS of them
travel to the payloads, which then stay where they were read; more are met by shuffling the rows on the digest. Archives are written in place through Spark's text writer, whose
line separator is the end of a WARC record, so any file system that Spark reaches will do; each
file is one gzip stream. Reading goes by Content-Length, never by separators, so payloads may hold
anything.

Defined results: a missing payload is empty; a missing url gets a URN; control characters and
spaces in a url are percent-coded; rows without a page id can revisit but are never referred to
(if no row of a group has an id, all are responses); repeated rows with the smallest id are all
responses; extra columns are ignored; an empty table gives an archive without records.
"""
from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.session import cut_lineage

# fixed values: the base32 alphabet, and the revisit profile of WARC 1.1
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n\r\n"
FILE_BYTES = 64 << 20
NAME = "urn:x-page:"
FEW_DIGESTS = 200_000  # about 20 MB with their page ids


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1 of a text's UTF-8 bytes: 20 bits (5 hex digits) give 4 letters."""
    digits = F.sha1(payload)
    letters = []
    for group in range(8):
        value = F.conv(F.substring(digits, 5 * group + 1, 5), 16, 10).cast("int")
        letters += [F.substr(F.lit(BASE32), F.shiftright(value, s).bitwiseAND(F.lit(31)) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*letters)


def headers(pages: DataFrame, id_column: str = "page_id", html: str = "html") -> DataFrame:
    """(id, payload_bytes, payload_digest) of every row."""
    payload = F.coalesce(F.col(html), F.lit(""))
    return pages.select(
        F.col(id_column), F.octet_length(payload).cast("long").alias("payload_bytes"), base32_sha1(payload).alias("payload_digest"))


def originals(heads: DataFrame, id_column: str = "page_id", least_bytes: int = 0) -> DataFrame:
    """(payload_digest, original) of payloads that occur more than once and are large enough."""
    counted = heads.where(F.col("payload_bytes") >= least_bytes).groupBy("payload_digest").agg(
        F.min(id_column).alias("original"), F.count("*").alias("n"))
    return counted.where((F.col("n") > 1) & F.col("original").isNotNull()).select("payload_digest", "original")


def _uri(url: Column, page: Column) -> Column:
    coded = F.regexp_replace(url, "[\\x00-\\x20\\x7F]", "%20")
    return F.coalesce(F.when(coded != "", coded), F.concat(F.lit(NAME), F.coalesce(page.cast("string"), F.lit(""))))


def records(pages: DataFrame, repeated: DataFrame, id_column: str = "page_id", url: str = "url", html: str = "html", least_bytes: int = 0) -> DataFrame:
    """One text for each row: the whole WARC record without its final separator."""
    payload = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(
        F.col(id_column).alias("page"), F.col(url).alias("url"), payload.alias("payload"), base32_sha1(payload).alias("payload_digest"))
    size = F.octet_length("payload")
    joined = rows.join(repeated, "payload_digest", "left")
    revisit = F.col("original").isNotNull() & ~F.col("original").eqNullSafe(F.col("page")) & (size >= least_bytes)
    name = lambda c: F.concat(F.lit(f"<{NAME}"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), size.cast("string"), F.lit(END))
    line = lambda key, value: F.concat(F.lit(f"\r\n{key}: "), value)
    head = F.concat(
        F.lit("WARC/1.1"), line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", name(F.col("page"))), line("WARC-Target-URI", _uri(F.col("url"), F.col("page"))),
        line("WARC-Date", F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", name(F.col("original"))))).otherwise(F.lit("")),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", (F.octet_length(http) + F.when(revisit, 0).otherwise(size)).cast("string")), F.lit(END), http)
    return joined.select(F.concat(head, F.when(revisit, F.lit("")).otherwise(F.col("payload"))).alias("value"))


def write_archives(pages: DataFrame, path: str, id_column: str = "page_id", url: str = "url", html: str = "html", least_bytes: int = 0) -> None:
    """Deduplicated archives below ``path``. Files are rolled at about FILE_BYTES of payload."""
    heads = cut_lineage(headers(pages, id_column, html))
    total = heads.agg(F.count("*").alias("n"), F.coalesce(F.sum("payload_bytes"), F.lit(0)).alias("bytes")).first()
    roll = max(1, FILE_BYTES * total["n"] // max(1, total["bytes"] + 512 * total["n"]))
    repeated = cut_lineage(originals(heads, id_column, least_bytes))
    if repeated.limit(FEW_DIGESTS + 1).count() <= FEW_DIGESTS:
        repeated = F.broadcast(repeated)
    made = records(pages, repeated, id_column, url, html, least_bytes)
    made.write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", roll).text(path)


def parsed(file) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in small letters) and block of every record of an open archive."""
    while line := file.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record begins with {line[:40]!r}")
        fields = {}
        while (line := file.readline()).strip():
            key, _, value = line.decode("utf-8").partition(":")
            fields[key.strip().lower()] = value.strip()
        size = int(fields["content-length"])
        block = file.read(size)
        if len(block) != size:
            raise ValueError("the archive ends inside a record")
        yield fields, block


def _page(name: str | None) -> str | None:
    """The page id in a record id, or None."""
    return (name or "").strip("<>").removeprefix(NAME) or None


READ = "page string, url string, record_type string, payload_digest string, refers_to string, payload_bytes long, found_digest string"


def read_archives(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """One row for each record: ids as text, the digest of its header, and bytes and digest of the payload found
    (missing for revisits); with ``payloads`` the payload itself."""

    def read(batches):
        for batch in batches:
            for content in batch.column("content"):
                rows, held = [], 0
                with gzip.GzipFile(fileobj=io.BytesIO(content.as_buffer())) as file:
                    for fields, block in parsed(file):
                        body = block.partition(b"\r\n\r\n")[2] if fields["warc-type"] == "response" else None
                        found = base64.b32encode(hashlib.sha1(body).digest()).decode() if body is not None else None
                        row = {
                            "page": _page(fields["warc-record-id"]), "url": fields.get("warc-target-uri"), "record_type": fields["warc-type"],
                            "payload_digest": fields["warc-payload-digest"].removeprefix("sha1:"), "refers_to": _page(fields.get("warc-refers-to")),
                            "payload_bytes": None if body is None else len(body), "found_digest": found,
                        }
                        rows.append(row | ({"payload": body} if payloads else {}))
                        held += len(block) if payloads else 512
                        if held > 8_000_000:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    schema = pa.schema([(n, pa.int64() if n == "payload_bytes" else pa.string()) for n in (c.split()[0] for c in READ.split(", "))])
    if payloads:
        schema = schema.append(pa.field("payload", pa.binary()))
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(read, READ + (", payload binary" if payloads else ""))


def resolved(spark: SparkSession, path: str, id_type: str = "bigint") -> DataFrame:
    """Records of the archives, with bytes and digest of the payload that each stands for: a revisit
    is joined to the response it refers to. A record whose digest is not that of its payload raises an error."""
    rows = cut_lineage(read_archives(spark, path))
    wrong = rows.where((F.col("record_type") == "response") & (F.col("payload_digest") != F.col("found_digest"))).count()
    if wrong:
        raise ValueError(f"{wrong} payloads differ from their digests")
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    own = F.col("page").cast(id_type).alias("page_id")
    responses = rows.where("record_type = 'response'").select(own, "payload_bytes", "payload_digest", "record_type", F.lit(None).cast(id_type).alias("refers_to"))
    again = rows.where("record_type = 'revisit'").select("page", "refers_to", "payload_digest")
    # only responses that are referred to meet the revisits
    wanted = again.select("refers_to", "payload_digest").distinct()
    target = rows.where("record_type = 'response'").select(F.col("page").alias("refers_to"), "payload_digest", "payload_bytes").join(
        wanted, ["refers_to", "payload_digest"], "left_semi").distinct()
    revisits = again.join(target, ["refers_to", "payload_digest"], "left").select(
        own, "payload_bytes", "payload_digest", F.lit("revisit").alias("record_type"), F.col("refers_to").cast(id_type).alias("refers_to"))
    return responses.select(*names).union(revisits.select(*names))
