"""WARC archives: written from pages, read back, and assembled into one nested row per capture.

A capture is written as a response record (or a revisit of an earlier record with the same payload), a
request and a metadata record; the latter two name the first in WARC-Concurrent-To. Spark's text writer puts the
records down byte by byte in gzip files of a bounded size, whose records are read by their lengths, so a payload
may hold anything. Reading joins the records of a capture through the concurrent-to identifiers.

Input: pages (page_id, url, html); others, whatever their names, are ignored. A null html is an empty payload, of any length it is
written whole; a null url leaves the target out. Every row has its own capture, also where rows repeat page_id, url and html: these are
numbered, and the number is part of the identifier. Of equal payloads the smallest page_id is the response, in all its rows, and
pages without an id revisit it; where no id is known, all are responses. Records that belong
to no capture are handed on as captures without response; an empty table gives an empty archive."""

from __future__ import annotations

import gzip
import hashlib
import uuid
from collections.abc import Iterator
from functools import reduce
from operator import and_

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from peakflow.sources.staging import stage, staging_dir

DATE = "2024-01-01T00:00:00Z"
REVISIT_BYTES = 100
FILE_BYTES = 4 << 20  # payload in one file, about
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_PRIMARY = ("response", "revisit", "resource", "conversion")

_RECORDS = "record_id string, record_type string, target_uri string, date string, concurrent_to array<string>, refers_to string, " \
           "payload_digest string, payload_bytes long, payload_sha256 string, fields map<string,string>, payload binary"


def captures_of(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """page_id, url, payload, digest, `number` among rows equal in all of these and, for a revisit, the page_id and
    url of the response (`first`).

    The smallest page of each payload is a map-side minimum; only payloads that occur twice are joined back. Equal rows
    are counted, written once and told as often as they occur, so none of them is ordered anywhere."""
    payload = F.coalesce(F.col("html").cast("binary"), F.lit("").cast("binary"))
    rows = pages.select("page_id", "url", payload.alias("payload"), F.sha2(payload, 256).alias("digest"))
    known = F.when(F.col("page_id").isNotNull(), F.struct("page_id", "url"))
    again = rows.where(F.octet_length("payload") >= least).groupBy("digest").agg(F.min(known).alias("first"), F.count("*").alias("n"))
    again = again.where("n > 1 and first is not null").drop("n")
    # stored, so that its size is known and a small one leaves the payloads where they are
    again = stage(again, "repeated")
    triple = ["page_id", "url", "digest"]
    equal = stage(rows.groupBy(*triple).agg(F.count("*").alias("n")).where("n > 1"), "equal")
    same = reduce(and_, (F.col(f"r.{c}").eqNullSafe(F.col(f"e.{c}")) for c in triple))
    kept = [F.col(f"r.{c}") for c in ("page_id", "url", "payload", "digest")]
    single = rows.alias("r").join(equal.alias("e"), same, "left_anti").withColumn("number", F.lit(0).cast("long"))
    copies = rows.alias("r").join(equal.alias("e"), same).select(*kept, "n").groupBy(*triple, "n").agg(F.first("payload").alias("payload"))
    told = copies.withColumn("number", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1))).repartition("digest", "number").drop("n")
    joined = single.unionByName(told).join(again, "digest", "left")
    return joined.withColumn("first", F.when(~F.col("first.page_id").eqNullSafe(F.col("page_id")), F.col("first")))


def _identifier(page_id: Column, url: Column, digest: Column, number: Column) -> Column:
    text = F.concat_ws("|", F.coalesce(page_id.cast("string"), F.lit("-")), F.coalesce(url, F.lit("")), digest, F.when(number > 0, number.cast("string")))
    h = F.sha2(text.cast("binary"), 256)
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *(F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))), F.lit(">"))


def _record(headers: list[tuple[str, Column | str]], block: Column) -> Column:
    """One record as bytes; a header whose value is null is left out."""
    lines = [F.lit("WARC/1.1\r\n")]
    for name, value in headers:
        value = F.lit(value) if isinstance(value, str) else value
        lines.append(F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit("")))
    head = F.concat(*lines, F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit("\r\n\r\n"))
    return F.concat(head.cast("binary"), block, F.lit("\r\n\r\n").cast("binary"))


def write_archive(pages: DataFrame, folder: str, date: str = DATE, least: int = REVISIT_BYTES) -> None:
    """Writes the captures of all pages below `folder`."""
    rows = captures_of(pages, least)
    uri = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    own, first = _identifier(F.col("page_id"), F.col("url"), F.col("digest"), F.col("number")), F.col("first")
    revisit = first.isNotNull()
    of = F.when(revisit, _identifier(first["page_id"], first["url"], F.col("digest"), F.lit(0)))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length("payload").cast("string"), F.lit("\r\n\r\n")).cast("binary")
    body = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    main = _record([("WARC-Type", F.when(revisit, "revisit").otherwise("response")), ("WARC-Record-ID", own), ("WARC-Date", date), ("WARC-Target-URI", uri),
                    ("WARC-Profile", F.when(revisit, _PROFILE)), ("WARC-Refers-To", of), ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
                    ("Content-Type", "application/http;msgtype=response")], body)

    def beside(kind: str, content: str, block: Column) -> Column:
        name = F.concat(F.lit("<urn:uuid:"), F.md5(F.concat(own, F.lit(kind)).cast("binary")), F.lit(">"))
        return _record([("WARC-Type", kind), ("WARC-Record-ID", name), ("WARC-Date", date), ("WARC-Target-URI", uri), ("WARC-Concurrent-To", own),
                        ("Content-Type", content)], block.cast("binary"))

    asked = F.concat(F.lit("GET "), F.coalesce(F.nullif(F.regexp_extract(uri, r"://[^/?#]*([^#]*)", 1), F.lit("")), F.lit("/")), F.lit(" HTTP/1.1\r\nHost: "),
                     F.regexp_extract(F.coalesce(uri, F.lit("")), r"://([^/?#]*)", 1), F.lit("\r\n\r\n"))
    about = F.concat(F.coalesce(F.concat(F.lit("page-id: "), F.col("page_id").cast("string"), F.lit("\r\n")), F.lit("")), F.lit("via: export\r\n"))
    text = F.concat(main, beside("request", "application/http;msgtype=request", F.coalesce(asked, F.lit("GET / HTTP/1.1\r\n\r\n"))),
                    beside("metadata", "application/warc-fields", about))
    size, n = pages.agg(F.coalesce(F.sum(F.octet_length("html")), F.lit(0)), F.count("*")).first()
    per_file = max(1, int(n * FILE_BYTES // max(1, size + 1000 * n)))
    # the writer ends a line with \n: the last byte of every record
    lines = rows.select(F.substring(text, F.lit(1), F.octet_length(text) - 1).cast("string").alias("value"))
    lines.write.option("compression", "gzip").option("maxRecordsPerFile", per_file).text(folder)


def parse_archive(data: bytes) -> Iterator[tuple[dict[str, list[str]], bytes]]:
    """Headers (names in small letters) and block of every record, by the lengths they state."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        headers: dict[str, list[str]] = {}
        for line in data[at:end].decode("utf-8", "replace").split("\r\n")[1:]:
            name, _, value = line.partition(":")
            headers.setdefault(name.strip().lower(), []).append(value.strip())
        size = int(headers["content-length"][0])
        yield headers, data[end + 4:end + 4 + size]
        at = end + 4 + size + 4


def read_records(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """One row per record of all archives in a folder, gzipped or not."""

    def row(headers: dict[str, list[str]], block: bytes) -> dict:
        def one(name):
            return headers.get(name, [None])[0]

        payload, kind = block, one("warc-type")
        if (one("content-type") or "").startswith("application/http"):
            payload = block.partition(b"\r\n\r\n")[2]
        fields = None
        if one("content-type") == "application/warc-fields":
            fields = [(k.strip(), v.strip()) for k, c, v in (x.partition(":") for x in block.decode("utf-8", "replace").split("\r\n")) if c]
        return {"record_id": one("warc-record-id"), "record_type": kind, "target_uri": one("warc-target-uri"), "date": one("warc-date"),
                "concurrent_to": headers.get("warc-concurrent-to", []), "refers_to": one("warc-refers-to"), "payload_digest": one("warc-payload-digest"),
                "payload_bytes": len(payload), "payload_sha256": hashlib.sha256(payload).hexdigest(), "fields": fields, "payload": payload if with_payload else None}

    schema = pa.schema([("record_id", pa.string()), ("record_type", pa.string()), ("target_uri", pa.string()), ("date", pa.string()),
                        ("concurrent_to", pa.list_(pa.string())), ("refers_to", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()),
                        ("payload_sha256", pa.string()), ("fields", pa.map_(pa.string(), pa.string())), ("payload", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                data = content.as_py()
                data = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data
                rows, held = [], 0
                for headers, block in parse_archive(data):
                    rows.append(row(headers, block))
                    held += len(block)
                    if held > FILE_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return spark.read.format("binaryFile").load(folder).select("content").mapInArrow(run, _RECORDS)


def assemble(records: DataFrame) -> DataFrame:
    """One row per capture: its id, the response or revisit record, and arrays of its request, metadata and
    other records. Identifiers are followed in either direction, and over one record in between.

    Where every other record names one response and responses name nothing, the usual layout, records meet in one
    shuffle by the identifier they name or have. Identifiers alone tell whether that is so."""
    primary = F.coalesce(F.col("record_type").isin(*_PRIMARY), F.lit(False))
    named = F.coalesce(F.size("concurrent_to"), F.lit(0))
    ids = records.select("record_id", primary.alias("main"), named.alias("named"), F.get("concurrent_to", F.lit(0)).alias("of"))
    if ids.groupBy("record_id").count().where("count > 1").take(1):
        records = records.dropDuplicates(["record_id"])
    mains = ids.where("main").select(F.col("record_id").alias("of"))
    usual = not ids.where((F.col("main") & (F.col("named") > 0)) | (~F.col("main") & (F.col("named") != 1)) | F.col("record_id").isNull()).take(1)
    if usual and not ids.where(~F.col("main")).join(mains, "of", "left_anti").take(1):
        rooted = records.withColumn("capture_id", F.when(primary, F.col("record_id")).otherwise(F.col("concurrent_to")[0]))
    else:
        rooted = _traced(records, primary)
    part = F.struct(*records.columns)
    request, meta = F.col("record_type") == "request", F.col("record_type") == "metadata"

    def of(kind: Column) -> Column:
        return F.collect_list(F.when(kind, part))

    other = ~primary & ~F.coalesce(request | meta, F.lit(False))
    return rooted.groupBy("capture_id").agg(
        F.first(F.when(primary, part), ignorenulls=True).alias("response"), of(request).alias("requests"), of(meta).alias("metadata"), of(other).alias("others"))


def _traced(records: DataFrame, primary: Column) -> DataFrame:
    """Records with `capture_id`, by links of any direction and over one record in between."""
    main, beside = records.where(primary), records.where(~primary)
    named = records.select(F.col("record_id").alias("a"), F.explode("concurrent_to").alias("b"))
    edges = named.unionAll(named.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    near = edges.join(main.select(F.col("record_id").alias("b")), "b").groupBy("a").agg(F.min("b").alias("root"))
    far = edges.join(near.withColumnRenamed("a", "b"), "b").groupBy("a").agg(F.min("root").alias("root2"))
    rooted = beside.join(near.withColumnRenamed("a", "record_id"), "record_id", "left").join(far.withColumnRenamed("a", "record_id"), "record_id", "left") \
        .withColumn("capture_id", F.coalesce("root", "root2", F.get("concurrent_to", F.lit(0)), "record_id")).drop("root", "root2")
    return rooted.unionByName(main.withColumn("capture_id", F.col("record_id")))


def pages_of(captures: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest (both of the full payload), record_type and refers_to of
    every capture; revisits look the payload up in the capture they refer to."""
    page = F.get(F.filter(F.transform("metadata", lambda m: m["fields"]["page-id"]), lambda x: x.isNotNull()), F.lit(0)).cast("long")
    r = F.col("response")
    rows = stage(captures.where(r.isNotNull()).select("capture_id", page.alias("page_id"), r["record_type"].alias("record_type"), r["refers_to"].alias("of"),
                                                      r["payload_bytes"].alias("payload_bytes"), r["payload_sha256"].alias("payload_digest")), "captures")
    full = rows.where("record_type <> 'revisit'")
    found = full.select(F.col("capture_id").alias("of"), F.col("page_id").alias("refers_to"), "payload_bytes", "payload_digest")
    revisits = rows.where("record_type = 'revisit'").drop("payload_bytes", "payload_digest").join(found, "of", "left")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return full.withColumn("refers_to", F.lit(None).cast("long")).select(*columns).unionByName(revisits.select(*columns))


def op3_warc_transactions(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    folder = f"{staging_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    write_archive(pages, folder)
    # headers and digests only; stored, so that the archives are read once for all joins
    return pages_of(assemble(stage(read_records(spark, folder, with_payload=False), "records")))


OP3_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html) AS payload_bytes, sha256(html) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND first IS DISTINCT FROM page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND first IS DISTINCT FROM page_id THEN first END AS refers_to
FROM f
"""
