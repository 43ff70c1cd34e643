"""WARC archives: write pages as records, read them back, assemble the transactions.

A page becomes three records: a response, or a revisit if its payload was captured
before, and a request and a metadata record that name it in ``WARC-Concurrent-To``.
Of the pages with equal payloads of at least ``least`` bytes, the one with the
smallest id is the response and the others revisit it.

Records are text, so Spark's text writer makes the files: a row is a record, the
line separator is the blank line that ends one, gzip goes over each file. Files
hold about ``file_bytes``, since a reader takes a file into one task; it streams
record by record by ``Content-Length``, so payloads may hold anything.

Assembly joins the records of a capture through their concurrent-to ids into one
nested row; of several requests or metadata records the one with the smallest id
counts, and an absent one is null.

A null payload is empty; a null url has no target header; a page without an id
has no ``page-id`` field, and counts as the largest id. Repeated rows are captures
of their own: the first is the response and the rest revisit it.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwatch.runtime import Scratch

END = "\r\n"


def _record_id(*parts: Column) -> Column:
    """A uuid from a hash, the same however often a task runs."""
    h = F.sha2(F.concat_ws("|", *parts).cast("binary"), 256)
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _record(kind: Column | str, headers: list[tuple[str, Column]], block: Column) -> Column:
    """One record as text, without the blank lines that end it; null headers are left out."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    lines = [F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), kind)]
    lines += [F.concat(F.lit(f"{name}: "), value) for name, value in headers]
    lines.append(F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")))
    return F.concat(F.concat_ws(END, *lines), F.lit(END + END), block)


def write(
    pages: DataFrame, path: str, key: str = "page_id", url: str = "url", payload: str = "html",
    least: int = 100, file_bytes: int = 32 << 20, now: datetime | None = None,
) -> None:
    """Write the records of *pages* as gzip WARC files under *path*."""
    job = Scratch(pages.sparkSession, "warc-write")
    date = (now or datetime.now(timezone.utc)).strftime("%Y-%m-%dT%H:%M:%SZ")
    body = F.coalesce(payload, F.lit(""))
    rows = pages.select(
        F.col(key).alias("id"),
        F.coalesce(F.col(key).cast("string"), F.lit("")).alias("pid"),
        F.col(url).alias("url"),
        body.alias("body"),
        F.sha2(body.cast("binary"), 256).alias("digest"),
    )
    narrow = job.write(
        rows.select("id", "pid", "digest", F.octet_length("body").cast("bigint").alias("bytes")), "digests"
    )
    long = narrow.filter(F.col("bytes") >= least)
    first = job.write(
        long.groupBy("digest")
        .agg(F.min("id").alias("first_id"), F.count("*").alias("n"))
        .filter("n > 1")
        .select("digest", F.coalesce(F.col("first_id").cast("string"), F.lit("")).alias("first_pid")),
        "responses",
    )
    known = job.write(long.join(first, "digest").select("pid", "digest", "first_pid").distinct(), "known")

    total = narrow.agg(F.sum("bytes").alias("b"), F.count("*").alias("n")).first()
    files = max(1, -(-((total["b"] or 0) + 1000 * total["n"]) // file_bytes))
    again = Window.partitionBy("pid", "digest").orderBy("url")
    rows = (
        rows.repartition(files, "pid", "digest")
        .join(known, ["pid", "digest"], "left")
        .withColumn("nth", F.row_number().over(again))
    )
    revisit = F.col("first_pid").isNotNull() & ((F.col("first_pid") != F.col("pid")) | (F.col("nth") > 1))
    kind = F.when(revisit, "revisit").otherwise("response")
    capture = _record_id(F.lit("capture"), "pid", "digest", F.col("nth").cast("string"))
    source = _record_id(F.lit("capture"), "first_pid", "digest", F.lit("1"))
    uri = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    common = [("WARC-Date", F.lit(date)), ("WARC-Target-URI", uri)]
    head = F.concat(
        F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "),
        F.octet_length("body").cast("string"),
        F.lit(END + END),
    )
    profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
    main = _record(
        kind,
        [
            ("WARC-Record-ID", capture),
            *common,
            ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
            ("WARC-Refers-To", F.when(revisit, source)),
            ("WARC-Profile", F.when(revisit, F.lit(profile))),
            ("Content-Type", F.lit("application/http; msgtype=response")),
        ],
        F.when(revisit, head).otherwise(F.concat(head, "body")),
    )
    host = F.coalesce(F.regexp_extract(uri, "^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1), F.lit(""))
    target = F.coalesce(F.regexp_extract(uri, "^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^#]*)", 1), F.lit(""))
    request = _record(
        "request",
        [
            ("WARC-Record-ID", _record_id(F.lit("request"), capture)),
            *common,
            ("WARC-Concurrent-To", capture),
            ("Content-Type", F.lit("application/http; msgtype=request")),
        ],
        F.concat(
            F.lit("GET "), F.when(target.startswith("/"), target).otherwise(F.concat(F.lit("/"), target)),
            F.lit(f" HTTP/1.1{END}Host: "), host, F.lit(END + END),
        ),
    )
    metadata = _record(
        "metadata",
        [
            ("WARC-Record-ID", _record_id(F.lit("metadata"), capture)),
            *common,
            ("WARC-Concurrent-To", capture),
            ("Content-Type", F.lit("application/warc-fields")),
        ],
        F.coalesce(F.concat(F.lit("page-id: "), F.col("id").cast("string"), F.lit(END)), F.lit("")),
    )
    records = rows.select(F.explode(F.array(request, main, metadata)).alias("value"))
    records.write.option("lineSep", END + END).option("compression", "gzip").text(path)
    job.drop(narrow, first, known)


RECORD = (
    "type string, record_id string, concurrent_to string, refers_to string, target_uri string, date string, "
    "content_type string, payload_digest string, payload_bytes bigint, fields map<string,string>, payload binary"
)


def _head(block: bytes) -> tuple[bytes, dict[str, str]]:
    """First line and fields (names in lower case) of a header."""
    lines = block.split(b"\r\n")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if colon:
            fields[name.strip().lower().decode("utf-8", "replace")] = value.strip().decode("utf-8", "replace")
    return lines[0], fields


def _parse(stream: io.BufferedIOBase, path: str):
    """The records of one file, one at a time."""
    while True:
        line = stream.readline()
        while line in (b"\r\n", b"\n"):
            line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            raise ValueError(f"{path}: not the start of a record: {line[:40]!r}")
        head = [line.rstrip(b"\r\n")]
        while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
            head.append(line.rstrip(b"\r\n"))
        _, fields = _head(b"\r\n".join(head))
        size = int(fields["content-length"])
        block = stream.read(size)
        if len(block) < size:
            raise ValueError(f"{path}: a record ends early")
        yield fields, block


def _row(fields: dict[str, str], block: bytes, with_payload: bool) -> tuple:
    kind = fields.get("warc-type")
    digest, size, payload, extra = None, None, None, {}
    if kind in ("response", "revisit"):
        top, _, body = block.partition(b"\r\n\r\n")
        status, extra = _head(top)
        extra = {":status": status.decode("utf-8", "replace"), **extra}
        if kind == "response":
            digest, size = hashlib.sha256(body).hexdigest(), len(body)
            payload = body if with_payload else None
        else:  # the payload is elsewhere; the header tells its digest and size
            digest = (fields.get("warc-payload-digest") or "").partition(":")[2] or None
            length = extra.get("content-length", "")
            size = int(length) if length.isdigit() else None
    elif kind == "request":
        status, extra = _head(block.partition(b"\r\n\r\n")[0])
        extra = {":request": status.decode("utf-8", "replace"), **extra}
    elif kind == "metadata":
        extra = _head(b"\r\n" + block)[1]
    names = ("warc-record-id", "warc-concurrent-to", "warc-refers-to", "warc-target-uri", "warc-date", "content-type")
    return (kind, *(fields.get(n) for n in names), digest, size, list(extra.items()), payload)


def read(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """All records under *path* (gzip or plain); a file is read in one task, as a stream."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    names = [f.split(" ", 1)[0] for f in RECORD.replace("map<string,string>", "map").split(", ")]
    kinds = [pa.string()] * 8 + [pa.int64(), pa.map_(pa.string(), pa.string()), pa.binary()]

    def run(batches):
        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

        for b in batches:
            for where, content in zip(b.column("path"), b.column("content")):
                raw = pa.BufferReader(content.as_buffer())
                packed = content.as_buffer()[:2].to_pybytes() == b"\x1f\x8b"
                stream = io.BufferedReader(gzip.GzipFile(fileobj=raw) if packed else raw)
                rows, size = [], 0
                for fields, block in _parse(stream, where.as_py()):
                    rows.append(_row(fields, block, with_payload))
                    size += len(block)
                    if size > 4 << 20 or len(rows) >= 5000:
                        yield batch(rows)
                        rows, size = [], 0
                if rows:
                    yield batch(rows)

    return files.select("path", "content").mapInArrow(run, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: the response or revisit, its request and its metadata."""
    main = records.filter(F.col("type").isin("response", "revisit"))

    def side(kind: str) -> DataFrame:
        row = F.struct("record_id", "target_uri", "date", "content_type", "fields")
        return (
            records.filter((F.col("type") == kind) & F.col("concurrent_to").isNotNull())
            .groupBy(F.col("concurrent_to").alias("record_id"))
            .agg(F.min_by(row, F.col("record_id")).alias(kind))
        )

    return (
        main.select("record_id", F.struct(*[c for c in records.columns if c != "concurrent_to"]).alias("capture"))
        .join(side("request"), "record_id", "left")
        .join(side("metadata"), "record_id", "left")
    )
