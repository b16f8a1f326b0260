"""WARC archives of captures: writing, reading and transaction assembly (op 1).

``write_warc`` makes three records per page, a request, a response and a
metadata record, tied by WARC-Concurrent-To.  Of pages with equal payloads of
at least ``MIN_REVISIT`` bytes the one with the smallest page_id is written as
response and the others as revisit records that refer to it.  Files are written
by Spark's text writer (a record ends in two line breaks, which is its line
separator), so that lost tasks leave no half files.

``read_warc`` reads whole archive files as bytes and parses their records in
one pass each, also files with one gzip member per record.

``assemble`` joins requests and metadata to their response or revisit record
through the concurrent-to identifiers, in either direction and over one record
in between, and gives one nested row per capture.

Defined results: a null payload is empty; equal (page_id, url, payload) rows
have one record id and count as ``copies`` of a capture; pages with the
smallest page_id of their payload are all responses; a null page_id is never
the smallest unless all are null; control characters are left out of the URL
header; records tied to no response make no capture; an empty table writes no
record and reads back as an empty one.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skuflow.session import materialize

MIN_REVISIT = 100
PAGES_PER_FILE = 10_000
BATCH_BYTES = 8 << 20
DATE = "2024-01-01T00:00:00Z"
EOL = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CAPTURES = ("response", "revisit", "resource")

RECORD_SCHEMA = ("record_id string, record_type string, target_uri string, concurrent_to array<string>, "
                 "refers_to string, payload_bytes long, payload_digest string, fields map<string,string>")


def record_id(kind: str, page_id: Column, url: Column, digest: Column) -> Column:
    """A name-based identifier: equal for equal rows, on every rerun."""
    def part(c: Column) -> Column:
        return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("-"))
    h = F.md5(F.encode(F.concat_ws("\n", F.lit(kind), part(page_id), part(digest), part(url)), "UTF-8"))
    cuts = [h.substr(a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cuts), F.lit(">"))


def _record(kind: str, own_id: Column, uri: Column, content_type: str, block: Column, *more: Column) -> Column:
    head = [F.lit("WARC/1.1"), F.lit(f"WARC-Type: {kind}"), F.concat(F.lit("WARC-Record-ID: "), own_id),
            F.lit(f"WARC-Date: {DATE}"), F.concat(F.lit("WARC-Target-URI: "), uri), *more,
            F.lit(f"Content-Type: {content_type}"),
            F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))]
    return F.concat(F.concat_ws(EOL, *head), F.lit(EOL + EOL), block)  # concat_ws leaves nulls out


def page_records(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """Column ``record``: the text of each page's three records, in one row each."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    sized = pages.select(
        "page_id", "url", html.alias("html"), F.octet_length(html).alias("bytes"),
        F.sha2(F.encode(html, "UTF-8"), 256).alias("digest"))
    # the smallest page_id and its URL by payload; combined before the shuffle
    heads = (sized.where(F.col("bytes") >= min_revisit).groupBy("digest")
             .agg(F.min(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "url"))).alias("head"),
                  F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "head"))
    page = sized.join(heads, "digest", "left")
    again = F.coalesce(F.col("head").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("head.page_id")), F.lit(False))
    uri = F.coalesce(F.regexp_replace("url", r"[\x00-\x20\x7f]+", ""), F.lit(""))
    key = [F.col("page_id"), F.col("url"), F.col("digest")]
    page = page.select(
        "*", again.alias("again"), uri.alias("uri"), record_id("capture", *key).alias("id"),
        record_id("capture", F.col("head.page_id"), F.col("head.url"), F.col("digest")).alias("head_id"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{EOL}Content-Type: text/html; charset=utf-8{EOL}Content-Length: "),
                    F.col("bytes").cast("string"), F.lit(EOL + EOL))
    digest = F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("digest"))
    of = F.concat(F.lit("WARC-Concurrent-To: "), F.col("id"))
    refer = F.concat(F.lit("WARC-Refers-To: "), F.col("head_id"))
    path = F.regexp_extract("uri", r"^[^:]*://[^/?#]*([^#]*)", 1)
    host = F.regexp_extract("uri", r"^[^:]*://([^/?#]*)", 1)
    request = F.concat(F.lit("GET "), F.when(path == "", F.lit("/")).otherwise(path),
                       F.lit(f" HTTP/1.1{EOL}Host: "), host, F.lit(EOL + EOL))
    note = F.concat(F.concat_ws(EOL, F.concat(F.lit("page-id: "), F.col("page_id").cast("string")),
                                F.concat(F.lit("payload-digest: "), F.col("digest"))), F.lit(EOL))
    capture = F.when(F.col("again"), _record(
        "revisit", F.col("id"), F.col("uri"), "application/http; msgtype=response", http, digest, refer,
        F.lit(f"WARC-Profile: {PROFILE}"))).otherwise(_record(
            "response", F.col("id"), F.col("uri"), "application/http; msgtype=response",
            F.concat(http, F.col("html")), digest))
    return page.select(F.explode(F.array(
        _record("request", record_id("request", *key), F.col("uri"), "application/http; msgtype=request", request, of),
        capture,
        _record("metadata", record_id("metadata", *key), F.col("uri"), "application/warc-fields", note, of),
    )).alias("record"))


def write_warc(pages: DataFrame, path: str, min_revisit: int = MIN_REVISIT,
               pages_per_file: int = PAGES_PER_FILE) -> None:
    (page_records(pages, min_revisit).write.mode("overwrite").option("lineSep", EOL + EOL)
     .option("compression", "gzip").option("maxRecordsPerFile", 3 * pages_per_file).text(path))


def _headers(stream) -> dict[str, list[str]]:
    """Named lines up to an empty one; names in lower case."""
    found: dict[str, list[str]] = {}
    while (line := stream.readline().rstrip(b"\r\n")):
        name, _, value = line.partition(b":")
        found.setdefault(name.strip().lower().decode("utf-8", "replace"), []).append(
            value.strip().decode("utf-8", "replace"))
    return found


def parse_archive(content: bytes) -> Iterator[dict]:
    """The records of one archive, plain or gzip in one or many members."""
    raw = io.BytesIO(content)
    stream = io.BufferedReader(gzip.GzipFile(fileobj=raw)) if content[:2] == b"\x1f\x8b" else raw
    while (line := stream.readline()):
        if not line.startswith(b"WARC/"):
            continue  # the line breaks after a record
        head = _headers(stream)

        def one(name: str) -> str | None:
            return head.get(name, [None])[0]

        block = stream.read(int(one("content-length") or 0))
        kind, payload, named = one("warc-type"), block, None
        length = len(block)
        if (one("content-type") or "").startswith("application/http"):
            inner = io.BytesIO(block)
            inner.readline()
            http = _headers(inner)
            payload = block[inner.tell():]
            length = len(payload)
            if kind == "revisit":  # holds the header only; the payload is elsewhere
                length = int(http.get("content-length", ["0"])[0])
        elif (one("content-type") or "").startswith("application/warc-fields"):
            named = {k: v[0] for k, v in _headers(io.BytesIO(block)).items()}
        said = (one("warc-payload-digest") or "").partition("sha256:")[2] or None
        digest = said if kind == "revisit" else hashlib.sha256(payload).hexdigest()
        if said and digest != said:
            raise ValueError(f"{one('warc-record-id')}: payload does not have its digest")
        yield {"record_id": one("warc-record-id"), "record_type": kind, "target_uri": one("warc-target-uri"),
               "concurrent_to": head.get("warc-concurrent-to", []), "refers_to": one("warc-refers-to"),
               "payload_bytes": length, "payload_digest": digest, "fields": named, "block": block}


def read_warc(spark: SparkSession, path: str, blocks: bool = True) -> DataFrame:
    """One row per record of the archives under ``path``; ``block`` holds its
    bytes if ``blocks``.  A file is read by one task: keep files moderate."""
    schema = RECORD_SCHEMA + (", block binary" if blocks else "")
    names = [x.split()[0] for x in RECORD_SCHEMA.split(", ")] + ["block"] * blocks
    kinds = {"concurrent_to": pa.list_(pa.string()), "payload_bytes": pa.int64(), "block": pa.binary(),
             "fields": pa.map_(pa.string(), pa.string())}

    def batch(rows: list[dict]) -> pa.RecordBatch:
        def column(n: str) -> pa.Array:
            values = [r[n] for r in rows]
            if n == "fields":
                values = [None if v is None else list(v.items()) for v in values]
            return pa.array(values, type=kinds.get(n, pa.string()))
        return pa.RecordBatch.from_arrays([column(n) for n in names], names)

    def run(files: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for file in files:
            for content in file.column("content"):
                for r in parse_archive(content.as_py()):
                    if not blocks:
                        r["block"] = b""
                    rows.append(r)
                    held += len(r["block"]) + 400
                    if held > BATCH_BYTES:
                        yield batch(rows)
                        rows, held = [], 0
        if rows:
            yield batch(rows)

    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
            .select("content").mapInArrow(run, schema))


def assemble(records: DataFrame) -> DataFrame:
    """One row per capture: the columns of its response or revisit record,
    ``copies``, and arrays ``requests`` and ``metadata`` of nested records.

    Identifiers are unique to a capture, so that no key of the joins is hot;
    a capture's array is as long as the list of records that name it."""
    thin = materialize(records.drop("block"), "warc-records")
    is_capture = F.col("record_type").isin(*CAPTURES)
    captures = thin.where(is_capture).select(F.col("record_id").alias("capture"))
    ties = thin.select(F.col("record_id").alias("a"), F.explode("concurrent_to").alias("b"))
    ties = ties.unionAll(ties.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    direct = ties.join(captures.distinct(), F.col("b") == F.col("capture")).select("a", "capture")
    direct = direct.join(captures.distinct().withColumnRenamed("capture", "a"), "a", "left_anti")
    through = (ties.join(direct.withColumnRenamed("a", "m"), F.col("b") == F.col("m")).select("a", "capture")
               .join(captures.distinct().withColumnRenamed("capture", "a"), "a", "left_anti")
               .join(direct.select("a").distinct(), "a", "left_anti"))
    others = thin.where(~is_capture).dropDuplicates(["record_id"])
    nested = F.struct("record_id", "record_type", "target_uri", "payload_bytes", "payload_digest", "fields")
    tied = (direct.unionAll(through).distinct().join(others, F.col("a") == F.col("record_id"))
            .groupBy("capture").agg(
                F.sort_array(F.collect_list(F.when(F.col("record_type") == "request", nested.dropFields("fields"))),
                             ).alias("requests"),
                F.collect_list(F.when(F.col("record_type") == "metadata", nested)).alias("metadata")))
    copies = thin.where(is_capture).groupBy("record_id").agg(F.count(F.lit(1)).alias("copies"))
    own = records.where(is_capture).drop("concurrent_to").dropDuplicates(["record_id"])
    return (own.join(copies, "record_id").join(tied, F.col("record_id") == F.col("capture"), "left")
            .drop("capture"))


def capture_pages(captures: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to and
    target_uri: a row per archived page."""
    page = F.try_element_at(F.col("metadata"), F.lit(1))["fields"]["page-id"].cast("long")
    flat = materialize(captures.select(
        page.alias("page_id"), "payload_bytes", "payload_digest", "record_type", "record_id",
        F.col("refers_to").alias("to"), "target_uri", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")),
        "warc-captures")
    first = flat.where("record_type = 'response' and copy = 1").select(
        F.col("record_id").alias("to"), F.col("page_id").alias("refers_to"))
    cols = ["page_id", "payload_bytes", "payload_digest", "record_type"]
    again = flat.where("record_type = 'revisit'").join(first, "to", "left").select(*cols, "refers_to", "target_uri")
    plain = flat.where("record_type <> 'revisit'").select(
        *cols, F.lit(None).cast("long").alias("refers_to"), "target_uri")
    return plain.unionAll(again)
