"""Web archives: write captures as WARC records, read archives back and assemble
each transaction from its request, response and metadata records.

Writing: a page becomes three records, a response (or a revisit, when an equal
payload is kept elsewhere), the request and a metadata record; the latter two name
the first in WARC-Concurrent-To.  Spark's text writer writes the records, so files
are committed by task and lie wherever Spark can write.  Reading: each file is
parsed by Content-Length, so payloads may hold anything, record heads included.

A file is decompressed in pieces, record by record: memory holds it as stored, and one record.

Assembly: any record of a transaction may name any other, several records at once,
in either direction; links are followed both ways to their end, by rounds of joins in
which every record takes the nearest capture that a linked record has reached.  One
row comes back per response or revisit, with all its requests and all its metadata
records nested as arrays, in the order of their ids (empty where absent).  A record
linked to several captures belongs to the nearest, of equally near ones to that with
the smallest id; captures that name each other stay apart.  Requests or metadata of
no capture are left out, as are ids that no record has.  Records without an id have
no links; repeated ids count as one record in the links and come back each.

Null payload counts as empty; null url or id write no such field and come back
null; rows with equal payload and equal smallest id are all responses; extra
columns are ignored."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from functools import reduce
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm.common import attach, materialise, text_of
from corpusmill.session import ensure_checkpoint_dir

VERSION, END = "WARC/1.1", "\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PIECE = 1 << 20
RECORD = (
    "type string, record_id string, target_uri string, concurrent_to array<string>, header_digest string, date string, "
    "fields map<string,string>, payload_bytes long, payload_digest string, payload binary"
)


def first_copies(pages: DataFrame, id_col: str, payload: Column, min_bytes: int) -> DataFrame:
    """Adds to each row ``_first``: the smallest id with an equal payload, itself
    for payloads under ``min_bytes``."""
    rows = pages.withColumn("_p", payload).withColumn("_key", F.sha2("_p", 256))
    first = rows.groupBy("_key").agg(F.min(id_col).alias("_least"))
    return attach(rows, first, ["_key"], [id_col]).withColumn(
        "_first", F.when(F.octet_length("_p") >= min_bytes, F.col("_least")).otherwise(F.col(id_col))
    )


def _record(kind: str, rid: Column, headers: list[tuple[str, Column]], block: Column) -> Column:
    """A record without the two line ends after its block."""
    lines = [F.lit(f"{VERSION}\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:uuid:"), rid, F.lit(f">\r\nWARC-Date: {DATE}\r\n")]
    for name, value in headers:
        lines.append(F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit("")))
    return F.concat(*lines, F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit("\r\n\r\n"), block)


def write_pages(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = 0, per_file: int = 6000) -> None:
    """Writes the archives: ``per_file`` records a file at most."""
    rows = pages.select(F.col(id_col).alias("id"), F.regexp_replace(F.col(url_col), r"[\r\n]", "%0A").alias("url"), text_of(payload_col).alias("body"))
    rows = first_copies(rows, "id", F.col("body"), min_bytes)
    is_first = F.coalesce(F.col("id") == F.col("_first"), F.col("_first").isNull())
    rows = rows.select(
        "id", "url", "body", is_first.alias("is_first"), F.expr("uuid()").alias("main"), F.expr("uuid()").alias("req"), F.expr("uuid()").alias("meta"),
        F.sha1(F.col("body").cast("binary")).alias("sha"),
    )
    digest = F.concat(F.lit("sha1:"), _base32(F.col("sha")))
    head = [("WARC-Target-URI", F.col("url")), ("WARC-Payload-Digest", digest)]
    http = F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n")
    to_main = ("WARC-Concurrent-To", F.concat(F.lit("<urn:uuid:"), F.col("main"), F.lit(">")))
    response = _record("response", F.col("main"), [*head, ("Content-Type", F.lit("application/http; msgtype=response"))], F.concat(http, F.col("body")))
    revisit = _record(
        "revisit", F.col("main"),
        [*head, ("WARC-Profile", F.lit(PROFILE)), ("Content-Type", F.lit("application/http; msgtype=response"))], http,
    )
    request = _record("request", F.col("req"), [head[0], to_main, ("Content-Type", F.lit("application/http; msgtype=request"))], F.lit("GET / HTTP/1.1\r\n\r\n"))
    fields = F.coalesce(F.concat(F.lit("capture-id: "), F.col("id").cast("string"), F.lit("\r\n")), F.lit(""))
    metadata = _record("metadata", F.col("meta"), [head[0], to_main, ("Content-Type", F.lit("application/warc-fields"))], fields)
    lines = rows.select(F.explode(F.array(request, F.when(F.col("is_first"), response).otherwise(revisit), metadata)).alias("value"))
    lines.write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", per_file).text(path)


def _base32(hexes: Column) -> Column:
    """Upper-case base32 of hexadecimal digits (20 bits, five digits, are four letters)."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    groups = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.conv(F.substring(hexes, i * 5 + 1, F.lit(5)), 16, 10).cast("int"))
    four = lambda v: F.concat(*[F.substring(F.lit(letters), F.shiftright(v, s).bitwiseAND(F.lit(31)) + 1, F.lit(1)) for s in (15, 10, 5, 0)])
    return F.array_join(F.transform(groups, four), "")


class Pieces:
    """A file's bytes, decompressed member by member where it is gzip, in pieces."""

    def __init__(self, data: memoryview):
        self.data, self.at, self.zipped, self.member = data, 0, bytes(data[:2]) == b"\x1f\x8b", None
        self.held = bytearray()

    def more(self) -> bool:
        """Takes another piece; false at the end of the file."""
        while self.at < len(self.data):
            piece = self.data[self.at : self.at + PIECE]
            if not self.zipped:
                self.at += len(piece)
                self.held += piece
                return True
            self.member = self.member or zlib.decompressobj(31)
            out = self.member.decompress(self.member.unconsumed_tail or piece, PIECE)
            if not self.member.unconsumed_tail:
                self.at += len(piece) - len(self.member.unused_data)
            if self.member.eof:
                self.member = None
            if out:
                self.held += out
                return True
        return False

    def until(self, mark: bytes) -> int:
        """Where ``mark`` begins in what is held; -1 where the file has none."""
        start = 0
        while (found := self.held.find(mark, start)) < 0:
            start = max(len(self.held) - len(mark) + 1, 0)
            if not self.more():
                return -1
        return found

    def take(self, n: int) -> bytes:
        while len(self.held) < n and self.more():
            pass
        if len(self.held) < n:
            raise ValueError("archive ends within a record")
        out = bytes(self.held[:n])
        del self.held[:n]
        return out


def parse(data: bytes | memoryview) -> Iterator[tuple[dict[str, list[str]], bytes]]:
    """(values of each header by lower-case name, block) of each record."""
    pieces = Pieces(memoryview(data))
    while pieces.held or pieces.more():
        end = pieces.until(b"\r\n\r\n")
        head = (pieces.take(end + 4) if end >= 0 else bytes(pieces.held)).decode("utf-8", "replace").split("\r\n")
        if end < 0 or not head[0].startswith("WARC/"):
            raise ValueError("no record where one should begin")
        headers: dict[str, list[str]] = {}
        for k, _, v in (line.partition(":") for line in head[1:] if line):
            headers.setdefault(k.strip().lower(), []).append(v.strip())
        block = pieces.take(int(headers["content-length"][0]))
        while len(pieces.held) < 4 and pieces.more():
            pass
        del pieces.held[:4]
        yield headers, block


def read_records(spark: SparkSession, path: str, with_payload: bool = False, per_batch: int = 512) -> DataFrame:
    """One row per record.  The digest is that of the payload as read; revisits and
    other kinds carry none."""

    def row(headers: dict[str, list[str]], block: bytes) -> tuple:
        one = lambda name: headers.get(name, [None])[0]
        kind, payload, fields = one("warc-type"), None, None
        if kind == "response":
            payload = block.partition(b"\r\n\r\n")[2]
        elif kind == "metadata":
            fields = [(k, v.strip()) for k, _, v in (x.partition(": ") for x in block.decode("utf-8", "replace").split("\r\n")) if k]
        digest = None if payload is None else base64.b32encode(hashlib.sha1(payload).digest()).decode()
        return (
            kind, one("warc-record-id"), one("warc-target-uri"), headers.get("warc-concurrent-to"), one("warc-payload-digest"), one("warc-date"),
            fields, None if payload is None else len(payload), digest, payload if with_payload else None,
        )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text = pa.string()
        kinds = [text, text, text, pa.list_(text), text, text, pa.map_(text, text), pa.int64(), text, pa.binary()]
        for batch in batches:
            for data in batch.column(0):
                records = (row(headers, block) for headers, block in parse(data.as_buffer()))
                while rows := list(islice(records, 1 if with_payload else per_batch)):
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], NAMES)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(task, RECORD)


NAMES = [x.split()[0] for x in RECORD.split(", ")]


def reached(records: DataFrame) -> DataFrame:
    """(record_id, capture): for every request and metadata record that a capture is
    linked to, over any number of links, the nearest one.

    Links to a capture itself need no rounds.  Where request and metadata records are
    linked among each other, a round joins the links of those that have no capture yet
    with the captures that the round before reached; it ends when it reaches nothing
    new.  A record that names many others, or is named by many, has its links as
    rows, in no one group."""
    ids = records.where(F.col("record_id").isNotNull()).select("record_id", F.col("type").isin("response", "revisit").alias("main"), "concurrent_to")
    main = ids.where("main").select(F.col("record_id").alias("capture"))
    side = ids.where("not main").select("record_id")
    named = ids.select("record_id", "main", F.explode("concurrent_to").alias("other"))
    direct = named.where("not main").join(main, F.col("other") == F.col("capture"), "left_semi").select("record_id", F.col("other").alias("capture"))
    back = named.where("main").select(F.col("other").alias("record_id"), F.col("record_id").alias("capture")).join(side, "record_id", "left_semi")
    front = direct.unionByName(back).groupBy("record_id").agg(F.min("capture").alias("capture"))
    among = named.where("not main").select("record_id", "other").join(side.withColumnRenamed("record_id", "other"), "other", "left_semi")
    links = materialise(among.unionByName(among.select(F.col("other").alias("record_id"), F.col("record_id").alias("other"))).distinct())
    if links.isEmpty():
        return front
    found = [materialise(front)]
    while not links.isEmpty():
        links = materialise(links.join(found[-1], "record_id", "left_anti"))
        near = found[-1].select(F.col("record_id").alias("other"), "capture")
        front = materialise(links.join(near, "other").groupBy("record_id").agg(F.min("capture").alias("capture")))
        if front.isEmpty():
            break
        found.append(front)
    return reduce(DataFrame.unionByName, found)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``capture`` (the response or revisit), ``request``
    and ``metadata`` (arrays), joined through the concurrent-to ids.  The archives are
    parsed once: the records are written to the shared folder and read from there."""
    spark, folder = records.sparkSession, scratch(records.sparkSession)
    records.write.parquet(folder)
    records = spark.read.schema(records.schema).parquet(folder)
    whole = F.struct(*records.columns)
    main = records.where(F.col("type").isin("response", "revisit")).select(F.col("record_id").alias("key"), whole.alias("capture"))
    side = records.where(F.col("type").isin("request", "metadata")).select("record_id", "type", whole.alias("record")).join(reached(records), "record_id")

    def all_of(kind: str) -> Column:
        order = lambda x, y: F.when(x["record_id"] < y["record_id"], -1).when(x["record_id"] > y["record_id"], 1).otherwise(0)
        return F.array_sort(F.collect_list(F.when(F.col("type") == kind, F.col("record"))), order).alias(kind)

    sides = side.groupBy(F.col("capture").alias("key")).agg(all_of("request"), all_of("metadata"))
    none = F.filter(F.array(F.col("capture")), lambda _: F.lit(False))
    return main.join(sides, "key", "left").select("capture", *[F.coalesce(k, none).alias(k) for k in ("request", "metadata")])


def resolve(captures: DataFrame) -> DataFrame:
    """Per capture: capture_id, payload_bytes, payload_digest, record_type and the
    capture that a revisit refers to, found by payload digest."""
    rows = captures.select(
        F.get(F.filter(F.transform("metadata", lambda m: m["fields"]["capture-id"]), lambda v: v.isNotNull()), F.lit(0)).alias("capture_id"), F.col("capture.type").alias("record_type"), F.col("capture.target_uri").alias("url"),
        F.coalesce(F.col("capture.payload_digest"), F.replace(F.col("capture.header_digest"), F.lit("sha1:"), F.lit(""))).alias("payload_digest"),
        F.col("capture.payload_bytes").alias("bytes"), F.col("capture.record_id").alias("record_id"),
    )
    kept = rows.where(F.col("record_type") == "response").groupBy("payload_digest").agg(
        F.max("bytes").alias("payload_bytes"), F.min(F.col("capture_id").cast("long")).alias("origin")
    )
    rows = attach(rows, kept, ["payload_digest"], ["record_id"])
    return rows.select(
        F.col("capture_id").cast("long").alias("capture_id"), "url", "payload_bytes", "payload_digest", "record_type",
        F.when(F.col("record_type") == "revisit", F.col("origin")).alias("refers_to"),
    )


def scratch(spark: SparkSession) -> str:
    """A new folder beside the checkpoints, which all executors share."""
    return f"{ensure_checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"
