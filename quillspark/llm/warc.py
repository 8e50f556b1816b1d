"""WARC archives: writing captures as request, response or revisit, and metadata records, and assembling them again.

Reading joins the records of a capture through ``WARC-Concurrent-To``; a record may name the response or another record of the capture that names
it. One nested row per capture comes back.

Edge cases: a null payload is the empty payload, a null address the empty one; addresses with white space or control characters are written
percent-encoded. Of captures with the same payload, the one with the largest id (then address) is stored as the response; a null id is smaller than
any other. Repeated rows are written and come back as often as they occur. A response without request or metadata records has nulls there. An empty
table gives an archive without records. Other columns of the input are ignored.
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
from pyspark.sql import types as T

from ..session import small_side
from .shared import as_table, shared_path, stored

RECORDS_PER_FILE = 6_000
BATCH_BYTES = 4 << 20
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
EPOCH = "1970-01-01T00:00:00Z"
RECORD = T.StructType([
    T.StructField("record_id", T.StringType()), T.StructField("kind", T.StringType()), T.StructField("concurrent_to", T.ArrayType(T.StringType())),
    T.StructField("refers_to", T.StringType()), T.StructField("target_uri", T.StringType()), T.StructField("date", T.StringType()),
    T.StructField("payload_digest", T.StringType()), T.StructField("payload_bytes", T.LongType()), T.StructField("payload", T.BinaryType()),
    T.StructField("fields", T.MapType(T.StringType(), T.StringType()))])


def base32_sha1(payload: Column) -> Column:
    """Base32 of the SHA-1: four numbers of 40 bits, each eight characters of five bits."""
    digest = F.sha1(payload)
    parts = [F.conv(F.substring(digest, 10 * i + 1, 10), 16, 10).cast("long") for i in range(4)]
    return F.concat(*[F.substring(F.lit(BASE32), F.shiftright(p, 35 - 5 * j).bitwiseAND(F.lit(31)).cast("int") + 1, F.lit(1)) for p in parts for j in range(8)])


def urn(*parts: Column) -> Column:
    h = F.md5(F.to_json(F.array(*[F.coalesce(p.cast("string"), F.lit("-")) for p in parts])))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))


def record(kind: Column, record_id: Column, headers: list[Column], block: Column, content_type: str, uri: Column, date: str) -> Column:
    """The text of one record, but for the line break that the writer adds."""
    return F.concat_ws(
        "\r\n", F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), kind), F.concat(F.lit("WARC-Record-ID: "), record_id),
        F.concat(F.lit("WARC-Target-URI: "), uri), F.lit(f"WARC-Date: {date}"), *headers, F.lit(f"Content-Type: {content_type}"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")), F.lit(""), block, F.lit(""))


def write_archives(pages: DataFrame, path: str, id_column: str = "page_id", url_column: str = "url", payload_column: str = "html",
                   smallest_revisit: int = 0, date: str = EPOCH, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Write three records per row. Payloads of at least ``smallest_revisit`` bytes that occur more than once are stored once.

    Only the digests of payloads that occur more than once are joined, so up to ``BROADCAST_ROWS`` of them no payload is shuffled.
    """
    url = F.coalesce(F.col(url_column).cast("string"), F.lit(""))
    rows = pages.select(
        F.col(id_column).cast("long").alias("id"), F.when(url.rlike(r"[\x00-\x20\x7F]"), F.url_encode(url)).otherwise(url).alias("url"),
        F.coalesce(F.col(payload_column).cast("string"), F.lit("")).alias("payload")).withColumn("digest", base32_sha1(F.col("payload")))
    same = rows.groupBy("digest").agg(F.max(F.struct("id", "url")).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    n = F.octet_length("payload")
    with_first = rows.join(small_side(stored(same, "payloads")), "digest", "left")
    is_first = (n < smallest_revisit) | F.col("first").isNull() | F.struct("id", "url").eqNullSafe(F.col("first"))
    own = urn(F.col("id"), F.col("url"), F.col("digest"))
    stored_at = urn(F.col("first.id"), F.col("first.url"), F.col("digest"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), n.cast("string"), F.lit("\r\n\r\n"))
    request = F.concat(F.lit("GET "), F.col("url"), F.lit(" HTTP/1.1\r\nAccept: */*\r\n\r\n"))
    notes = F.concat(F.lit("page-id: "), F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit("\r\n"))
    concurrent = [F.concat(F.lit("WARC-Concurrent-To: "), own)]
    digest = F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest"))
    reply = [digest, F.when(~is_first, F.concat(F.lit("WARC-Refers-To: "), stored_at)),
             F.when(~is_first, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))]
    uri = F.col("url")
    records = F.array(
        record(F.lit("request"), urn(own, F.lit("request")), concurrent, request, "application/http; msgtype=request", uri, date),
        record(F.when(is_first, "response").otherwise("revisit"), own, reply, F.when(is_first, F.concat(http, F.col("payload"))).otherwise(http),
               "application/http; msgtype=response", uri, date),
        record(F.lit("metadata"), urn(own, F.lit("metadata")), concurrent, notes, "application/warc-fields", uri, date))
    with_first.select(F.explode(records).alias("value")).write.option("lineSep", "\r\n").option("compression", "gzip").option(
        "maxRecordsPerFile", records_per_file).text(path)


def named_fields(lines: bytes) -> dict[str, str]:
    found = {}
    for line in lines.decode("utf-8", "replace").split("\r\n"):
        name, colon, value = line.partition(":")
        if colon:
            found[name.strip().lower()] = value.strip()
    return found


def parsed_records(content: bytes) -> Iterator[dict]:
    """The records of one archive, plain or compressed, one at a time; a record's length says where it ends."""
    stream = io.BytesIO(content)
    if content[:2] == b"\x1f\x8b":
        stream = io.BufferedReader(gzip.GzipFile(fileobj=stream), 1 << 16)
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record where one should begin: {line[:40]!r}")
        headers, concurrent = {}, []
        while (line := stream.readline().rstrip(b"\r\n")):
            name, _, value = line.decode("utf-8", "replace").partition(":")
            name = name.strip().lower()
            if name == "warc-concurrent-to":
                concurrent.append(value.strip())
            headers[name] = value.strip()
        length = int(headers["content-length"])
        block = stream.read(length)
        if len(block) != length:
            raise ValueError("the archive ends inside a record")
        yield opened(headers, concurrent, block)


def opened(headers: dict[str, str], concurrent: list[str], block: bytes) -> dict:
    kind = headers.get("warc-type")
    out = {"record_id": headers.get("warc-record-id"), "kind": kind, "concurrent_to": concurrent, "refers_to": headers.get("warc-refers-to"),
           "target_uri": headers.get("warc-target-uri"), "date": headers.get("warc-date"), "payload_digest": None, "payload_bytes": None,
           "payload": None, "fields": None}
    stated = headers.get("warc-payload-digest", "").removeprefix("sha1:") or None
    if kind in ("response", "revisit"):
        head, _, payload = block.partition(b"\r\n\r\n")
        out["fields"] = named_fields(head)
        if kind == "revisit":
            return out | {"payload_digest": stated, "payload_bytes": int(out["fields"].get("content-length", 0))}
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if stated not in (None, digest):
            raise ValueError(f"payload of {out['record_id']} is damaged")
        return out | {"payload_digest": digest, "payload_bytes": len(payload), "payload": payload}
    out["fields"] = named_fields(block.partition(b"\r\n\r\n")[0] if kind == "request" else block)
    return out


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives in a folder."""
    schema = pa.schema([("record_id", pa.string()), ("kind", pa.string()), ("concurrent_to", pa.list_(pa.string())), ("refers_to", pa.string()),
                        ("target_uri", pa.string()), ("date", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()),
                        ("payload", pa.binary()), ("fields", pa.map_(pa.string(), pa.string()))])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for content in batch.column("content"):
                for r in parsed_records(content.as_py()):
                    held.append(r)
                    size += len(r["payload"] or b"") + 500
                    if size > BATCH_BYTES:
                        yield packed(held)
                        held, size = [], 0
        if held:
            yield packed(held)

    def packed(held: list[dict]) -> pa.RecordBatch:
        return as_table({f.name: [list(r["fields"].items()) if f.name == "fields" else r[f.name] for r in held] for f in schema}, schema)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(rows, RECORD)


def captures(records: DataFrame) -> DataFrame:
    """One row per response or revisit: ``capture_id, target_uri, date, response, request, metadata``, the last three nested.

    A reply is known by its own id, the other records by what they are concurrent to, so one shuffle brings a capture together. Records that name another
    record instead of the reply are left over there, and follow in a join of their own, a broadcast one up to ``BROADCAST_ROWS`` of them.
    """
    is_reply = F.col("kind").isin("response", "revisit")
    keys = F.when(is_reply, F.array("record_id")).when(F.col("kind").isin("request", "metadata"), F.col("concurrent_to"))
    dealt = records.withColumn("key", F.explode(keys)).repartition("key")
    reply = F.struct("kind", "refers_to", "payload_digest", "payload_bytes", "payload", "fields", "target_uri", "date")
    best = lambda name, test, value: F.max_by(F.when(test, value), F.when(test, F.col("record_id"))).alias(name)
    side = lambda kind: best(kind, F.col("kind") == kind, F.struct("record_id", "fields"))
    grouped = dealt.groupBy("key").agg(best("reply", is_reply, reply), F.sum(is_reply.cast("long")).alias("n"), side("request"), side("metadata"),
                                       F.collect_set(F.when(~is_reply, F.col("record_id"))).alias("ids"))
    grouped = stored(grouped, "grouped", "zstd")  # read three times below
    met = grouped.filter("reply IS NOT NULL")
    astray = grouped.filter("reply IS NULL").select(F.col("key").alias("_near"), F.col("request").alias("_request"), F.col("metadata").alias("_metadata"))
    links = grouped.select(F.explode("ids").alias("_via"), F.col("key").alias("_far"))
    later = lambda kind: F.max_by(f"_{kind}", f"_{kind}.record_id").alias(f"_{kind}")
    found = astray.join(links, F.col("_near") == F.col("_via")).groupBy("_far").agg(later("request"), later("metadata"))
    whole = met.join(small_side(stored(found, "indirect")), F.col("key") == F.col("_far"), "left").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("n"))))
    shown = F.col("reply").dropFields("target_uri", "date").alias("response")
    return whole.select(F.col("key").alias("capture_id"), F.col("reply.target_uri").alias("target_uri"), F.col("reply.date").alias("date"), shown,
                        F.coalesce("request", "_request").alias("request"), F.coalesce("metadata", "_metadata").alias("metadata"))


def round_trip(pages: DataFrame) -> DataFrame:
    """Write all pages to fresh archives in the shared folder and give the captures read back from there."""
    spark = pages.sparkSession
    path = shared_path(spark, "warc")
    write_archives(pages, path)
    return captures(read_records(spark, path))


def digest_rows(found: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to``, the last as the page whose response holds the payload."""
    flat = stored(found.select("capture_id", F.col("metadata.fields")["page-id"].try_cast("long").alias("page_id"), F.col("response.payload_bytes"),
                               F.col("response.payload_digest"), F.col("response.kind").alias("record_type"), F.col("response.refers_to").alias("_to")),
                  "captures")
    firsts = flat.filter((F.col("record_type") == "response") & (F.col("payload_bytes") >= 0)).groupBy(F.col("capture_id").alias("_first")).agg(F.max("page_id").alias("refers_to"))
    return flat.join(stored(firsts, "responses"), F.col("_to") == F.col("_first"), "left").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
