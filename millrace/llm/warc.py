"""WARC archives of pages: written with Spark's text writer, read back whole by their lengths, assembled to captures."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.llm.match import rows_without
from millrace.llm.urls import url_host, url_path
from millrace.session import scratch_path, stored

BREAK = "\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = ("type string, record_id string, concurrent_to string, refers_to string, uri string, page_id long, "
          "payload_bytes long, payload_digest string, payload binary")
SALTS = 32           # of the revisits of one capture
HEAD_BYTES = 800     # about, of a record without its payload


def _urn(kind: str, row: Column) -> Column:
    digest = F.md5(F.concat(F.lit(kind + " "), row.cast("string")))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(digest, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))


def _record(fields: list[tuple[str, Column | str]], block: Column, block_bytes: Column) -> Column:
    """Header and block; the text writer adds the two line breaks that end a record. Null fields are left out."""
    lines = [F.concat(F.lit(f"{name}: "), value if isinstance(value, Column) else F.lit(value), F.lit(BREAK)) for name, value in fields]
    head = F.concat(F.lit("WARC/1.1" + BREAK), *[F.coalesce(x, F.lit("")) for x in lines])
    return F.concat(head, F.lit("Content-Length: "), block_bytes.cast("string"), F.lit(BREAK * 2), block)


def write_archives(pages: DataFrame, path: str, id_column: str = "page_id", url_column: str = "url", html_column: str = "html",
                   least_bytes: int = 1000, file_bytes: int = 8 << 20, date: str = "1970-01-01T00:00:00Z") -> None:
    """Write a request, a metadata and a response or revisit record per row below ``path``.

    Of rows with equal payloads of at least ``least_bytes`` bytes the one with the largest id is the response (the last
    row in the order read, if that id is repeated; a null id comes first of all); the others revisit it and carry no
    payload. Smaller payloads are all responses, and null html is an empty payload. The id is kept in the metadata
    record, and left out if it is null. Line breaks in a url are percent-encoded; a null url is left out. Files hold at most
    some times ``file_bytes``, or one record, because a file is read as a whole: payloads of about one size share files. An empty table writes no record.
    """
    html, url = F.coalesce(F.col(html_column).cast("string"), F.lit("")), F.col(url_column).cast("string")
    rows = pages.withColumn("_row", F.monotonically_increasing_id()).select(
        F.col("_row").alias("row"), F.col(id_column).cast("long").alias("id"),
        F.regexp_replace(F.regexp_replace(url, "\r", "%0D"), "\n", "%0A").alias("url"), html.alias("html"))
    facts = stored(rows.select("row", "id", "url", F.octet_length("html").cast("long").alias("bytes"), F.sha1("html").alias("digest")), "payloads")
    last = facts.filter(F.col("bytes") >= least_bytes).groupBy("digest", "bytes").agg(
        F.max(F.struct("id", "row")).alias("last"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    revisits = stored(facts.join(last, ["digest", "bytes"]).filter("row <> last.row").select(
        "row", "id", "url", "bytes", "digest", F.col("last.row").alias("of")), "revisits")

    def http(size: Column) -> Column:
        return F.concat(F.lit(f"HTTP/1.1 200 OK{BREAK}Content-Type: text/html; charset=utf-8{BREAK}Content-Length: "),
                        size.cast("string"), F.lit(BREAK * 2))

    common = [("WARC-Target-URI", F.col("url")), ("WARC-Date", date)]
    size = F.octet_length("html")
    responses = rows_without(rows, revisits, "row").select(size.alias("size"), _record(
        [("WARC-Type", "response"), ("WARC-Record-ID", _urn("capture", F.col("row"))), *common,
         ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.sha1("html"))), ("Content-Type", "application/http;msgtype=response")],
        F.concat(http(size), "html"), F.octet_length(http(size)) + size).alias("value"))
    again = http(F.col("bytes"))
    repeats = revisits.select(_record(
        [("WARC-Type", "revisit"), ("WARC-Record-ID", _urn("capture", F.col("row"))), *common,
         ("WARC-Refers-To", _urn("capture", F.col("of"))), ("WARC-Profile", REVISIT_PROFILE),
         ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))), ("Content-Type", "application/http;msgtype=response")],
        again, F.octet_length(again)).alias("value"))
    target = F.coalesce(F.col("url"), F.lit(""))
    ask = F.concat(F.lit("GET "), F.when(url_path(target) == "", "/").otherwise(url_path(target)), F.lit(f" HTTP/1.1{BREAK}Host: "),
                   url_host(target), F.lit(BREAK * 2))
    note = F.concat(F.lit("fetcher: pages" + BREAK), F.coalesce(F.concat(F.lit("page_id: "), F.col("id").cast("string"), F.lit(BREAK)), F.lit("")))
    sides = facts.select(F.explode(F.array(
        _record([("WARC-Type", "request"), ("WARC-Record-ID", _urn("request", F.col("row"))), *common,
                 ("WARC-Concurrent-To", _urn("capture", F.col("row"))), ("Content-Type", "application/http;msgtype=request")],
                ask, F.octet_length(ask)),
        _record([("WARC-Type", "metadata"), ("WARC-Record-ID", _urn("metadata", F.col("row"))), *common,
                 ("WARC-Concurrent-To", _urn("capture", F.col("row"))), ("Content-Type", "application/warc-fields")],
                note, F.octet_length(note)))).alias("value"))
    sizes = facts.agg(F.coalesce(F.avg("bytes"), F.lit(0.0)).alias("mean"), F.coalesce(F.max("bytes"), F.lit(0)).alias("most")).first()
    parts = [(f"responses-{k}", responses.filter((F.col("size") > low) & (F.col("size") <= high)).select("value"), typical)
             for k, (low, high, typical) in enumerate(size_tiers(sizes["mean"], sizes["most"]))]
    for part, records, typical in [*parts, ("revisits", repeats, 0), ("sides", sides, 0)]:
        most = max(1, int(file_bytes / (HEAD_BYTES + typical)))
        records.write.option("lineSep", BREAK * 2).option("maxRecordsPerFile", most).text(f"{path}/{part}")


def size_tiers(mean: float, most: int) -> list[tuple[float, float, float]]:
    """``(over, up to, typical)`` sizes of payloads that share files.

    A tier reaches to eight times its typical size, the first one's being the mean, so no file is over eight times the
    wanted size unless one record is. Each later tier is 64 times the one before: a few of them cover any size.
    """
    typical = max(mean, HEAD_BYTES)
    tiers = [(-1.0, 8 * typical, mean)]
    while tiers[-1][1] < most:
        low = tiers[-1][1]
        tiers.append((low, 64 * low, 8 * low))
    return tiers


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split(BREAK)
    return {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines[1:])}


def read_records(content: bytes, name: str, with_payload: bool) -> Iterator[tuple]:
    """The records of one file, found by their lengths alone, so a payload may hold anything."""
    view, at = memoryview(content), 0
    while at < len(content):
        end = content.find(b"\r\n\r\n", at)
        if end < 0 or not content.startswith(b"WARC/", at):
            raise ValueError(f"{name}: no WARC record at byte {at}")
        head = _fields(content[at:end])
        start = end + 4
        stop = start + int(head["content-length"])
        if stop > len(content):
            raise ValueError(f"{name}: the record at byte {at} is cut off")
        kind, page, size, digest, payload = head.get("warc-type"), None, None, None, None
        if kind == "response":
            body = content.find(b"\r\n\r\n", start, stop)
            part = view[body + 4 if body >= 0 else start:stop]
            size, digest, payload = len(part), hashlib.sha1(part).hexdigest(), bytes(part) if with_payload else None
        elif kind == "revisit":
            inner = _fields(content[start:stop])
            size, digest = int(inner.get("content-length", 0)), head.get("warc-payload-digest", "").removeprefix("sha1:")
        elif kind == "metadata":
            note = _fields(b"\r\n" + content[start:stop]).get("page_id")
            page = int(note) if note else None
        yield (kind, head.get("warc-record-id"), head.get("warc-concurrent-to"), head.get("warc-refers-to"),
               head.get("warc-target-uri"), page, size, digest, payload)
        at = stop + 4


def _parse(with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in RECORD.split(", ")]
        kinds = [pa.string()] * 5 + [pa.int64(), pa.int64(), pa.string(), pa.binary()]
        for batch in batches:
            for row in range(len(batch)):
                content, name = batch.column("content")[row].as_py(), batch.column("path")[row].as_py()
                rows: list[tuple] = []
                for record in read_records(content, name, with_payload):
                    rows.append(record)
                    if len(rows) == (256 if with_payload else 8192):
                        yield pa.record_batch([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                        rows = []
                if rows:
                    yield pa.record_batch([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
    return run


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """A row per record of the files two folders below ``path``; ``payload`` is null if it isn't asked for."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/*").select("path", "content")
    return files.mapInArrow(_parse(with_payload), RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """A nested row per capture: ``capture_id, capture, request, metadata, original``.

    ``capture`` is the response or revisit record. Requests and metadata join it by their concurrent-to id, directly or
    through a request that names the capture; of several the least record id is taken. A capture without them has nulls
    there, and records that name no known capture make no row. ``original`` is the metadata of the response that a
    revisit refers to.
    """
    captures = records.filter("type IN ('response', 'revisit') AND record_id IS NOT NULL")
    asked = records.filter("type = 'request' AND concurrent_to IS NOT NULL").select("record_id", "concurrent_to", "uri")
    noted = records.filter("type = 'metadata' AND concurrent_to IS NOT NULL").select("record_id", "concurrent_to", "page_id")
    through = asked.groupBy(F.col("record_id").alias("concurrent_to")).agg(F.min("concurrent_to").alias("of"))
    requests = asked.groupBy(F.col("concurrent_to").alias("capture_id")).agg(F.min(F.struct("record_id", "uri")).alias("request"))
    metadata = noted.join(through, "concurrent_to", "left").groupBy(F.coalesce("of", "concurrent_to").alias("capture_id")).agg(
        F.min(F.struct("record_id", "page_id")).alias("metadata"))
    capture = F.struct("type", "uri", "refers_to", "payload_bytes", "payload_digest", "payload").alias("capture")
    whole = captures.select(F.col("record_id").alias("capture_id"), capture).join(requests, "capture_id", "left").join(metadata, "capture_id", "left")
    original = metadata.select(F.col("capture_id").alias("refers_to"), F.col("metadata").alias("original"))
    # responses refer to nothing, and many revisits may refer to one: these are parted by salts, and only what is referred to is copied
    salt = F.pmod(F.xxhash64("capture_id"), F.lit(SALTS)).cast("int")
    revisits = whole.filter("capture.refers_to IS NOT NULL").withColumn("refers_to", F.col("capture.refers_to")).withColumn("salt", salt)
    wanted = captures.filter("refers_to IS NOT NULL").select("refers_to").distinct()
    copied = original.join(wanted, "refers_to", "left_semi").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    known = revisits.join(copied, ["refers_to", "salt"], "left").drop("refers_to", "salt")
    none = F.lit(None).cast(original.schema["original"].dataType).alias("original")
    return whole.filter("capture.refers_to IS NULL").select("*", none).unionByName(known)


def archived_captures(pages: DataFrame, with_payload: bool = True, **columns: str) -> DataFrame:
    """``pages`` written to archives below the shared folder, read back and assembled."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(pages, path, **columns)
    return assemble(stored(read_archives(spark, path, with_payload), "records"))
