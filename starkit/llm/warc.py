"""WARC archives in which each payload is written once.

Writing resolves copies before anything is written:

* headers, without payloads, are shuffled by payload digest, and the payload
  of the least id becomes the response; the grouping that finds it combines on
  the map side, so copies of a payload never travel;
* the other records of the payload join that response by digest and become
  revisit records: fresh headers that name it, and no payload.  Payloads with
  more than ``HOT`` records and a thousandth of all are joined as a broadcast,
  which has at most a thousand rows without payloads; the rest by a shuffle;
* Spark's text writer puts the records, each a whole row that ends with the
  terminator of the format, into compressed files of the shared folder.  So a
  lost executor repeats its own files and its half-written ones never show.

Reading takes whole files, walks them record by record by Content-Length, and
checks every payload against its digest.  :func:`resolved` joins the revisit
records it meets to their responses again, in the same manner.

Records are compared by the SHA-256 of their payload, as SHA-1, which the
format uses, has known collisions; texts that only share a SHA-1 are both kept.
Files hold at most ``FILE_BYTES`` of payload on average, and as many records as
keep a file readable even if all were as long as the longest; a single record
can't exceed what Spark holds in a row.

Defined results: a null payload is empty; a null id is the last of a payload,
and is left out of its record; of rows repeating id, url and payload, all but
one revisit it; payloads below ``least`` bytes are all responses; a null url is
left out; white space and control characters in an id or url are written as %20;
a very long payload is a record in a file of few; an empty table gives an archive without records; other columns are untouched.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starkit.llm.common import batches_of
from starkit.llm.common import saved as written
from starkit.sources.export import run_folder

HOT = 100_000               # records of one payload up to which they stay in the shuffle
FILE_BYTES = 64 << 20       # payload in a file, on average
MOST_BYTES = 1 << 30        # payload in a file, at most, unless one record has more
COPIES = 10_000             # equal rows that are dealt out together

VERSION = "WARC/1.1"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32, BASE32_HEX = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "0123456789ABCDEFGHIJKLMNOPQRSTUV"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"


def base32(hex_digest: Column) -> Column:
    """Base 32 of a SHA-1 in hex: four groups of 40 bits."""
    groups = [F.lpad(F.conv(F.substring(hex_digest, 1 + 10 * k, 10), 16, 32), 8, "0") for k in range(4)]
    return F.translate(F.concat(*groups), BASE32_HEX, BASE32)


def _one_line(value: Column) -> Column:
    return F.regexp_replace(value.cast("string"), r"[\x00-\x20\x7F]", "%20")


def headers_of(records: DataFrame) -> DataFrame:
    """``records`` (id, url, payload) with digests and the length of the payload."""
    text = F.coalesce(F.col("payload").cast("string"), F.lit(""))
    data = text.cast("binary")
    return records.select("id", _one_line(F.col("url")).alias("url"), text.alias("payload"), F.sha2(data, 256).alias("key"),
                          base32(F.sha1(data)).alias("digest"), F.octet_length(text).cast("long").alias("length"))


def counted(headers: DataFrame) -> DataFrame:
    """Headers with the number of rows that are equal in all of them."""
    return headers.groupBy("key", "digest", "length", "id", "url").agg(F.count("*").alias("copies"))


def first_of(rows: DataFrame) -> Column:
    return F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", F.col("url").isNull().alias("no_url"), "url")).alias("first")


def numbered(groups: DataFrame) -> DataFrame:
    """One row for each of the ``copies`` from ``start`` on, dealt out in blocks."""
    n = int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = groups.filter(F.col("copies") > F.col("start")).withColumn("at", F.explode(F.expr(f"sequence(start, copies - 1, {COPIES})")))
    blocks = blocks.repartition(n, "key", "id", "at")
    return blocks.withColumn("copy", F.explode(F.expr(f"sequence(at, least(at + {COPIES}, copies) - 1)"))).drop("at", "start", "copies")


def joined(rows: DataFrame, firsts: DataFrame, key: str, total: int) -> DataFrame:
    """Inner join of ``rows`` to ``firsts``, one row a key with its number of
    records ``n`` of ``total``.  Keys with more than HOT and total / 1000 of them
    join as a broadcast: they are fewer than a thousand."""
    limit = max(HOT, total // 1000)
    hot = F.broadcast(firsts.filter(F.col("n") > limit).drop("n"))
    rest = rows.join(hot.select(key), key, "left_anti").join(firsts.filter(F.col("n") <= limit).drop("n"), key)
    return rows.join(hot, key).unionByName(rest)


def record_id(*of: str) -> Column:
    """The same record has the same name when its task is repeated."""
    h = F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in of]))
    part = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *part), F.lit(">"))


def _named(name: str, value: Column) -> Column:
    return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n")), F.lit(""))


def record(kind: str, block: Column, content_type: str, *named: tuple[str, Column]) -> Column:
    """Text of a record without the empty lines that end it."""
    return F.concat(F.lit(f"{VERSION}\r\nWARC-Type: {kind}\r\n"), *[_named(k, v) for k, v in named],
                    F.lit(f"Content-Type: {content_type}\r\nContent-Length: "), F.octet_length(block).cast("string"), F.lit("\r\n\r\n"), block)


def write_archives(records: DataFrame, path: str, date: str, least: int = 0) -> None:
    """Write ``records`` (id, url, payload) to gzip archives below ``path``.
    ``date`` is the WARC-Date of all records, the time of the crawl."""
    headers = headers_of(records)
    narrow = headers.drop("payload")
    compared = F.col("length") >= least
    per_id = written(counted(narrow), "warc-headers")
    sizes = per_id.agg(F.sum(F.col("length") * F.col("copies")).alias("bytes"), F.sum("copies").alias("rows"), F.max("length").alias("most")).first()
    a_file = max(1, min(FILE_BYTES * (sizes.rows or 1) // max(1, sizes.bytes or 0), MOST_BYTES // max(1, sizes.most or 0)))

    # the responses: one row a payload, with the payload
    originals = headers.filter(compared).groupBy("key").agg(first_of(headers), F.any_value("payload").alias("payload"),
                                                            F.first("digest").alias("digest"), F.first("length").alias("length"))
    originals = originals.select("key", "first.id", "first.url", "payload", "digest", "length", F.lit(0).cast("long").alias("copy"))
    short = numbered(headers.filter(~compared).groupBy("key", "digest", "length", "id", "url", "payload").agg(F.count("*").alias("copies"))
                     .withColumn("start", F.lit(0).cast("long")))
    responses = originals.unionByName(short).withColumn("record_id", record_id("key", "id", "url", "copy"))

    # the others: headers that name their response
    firsts = per_id.filter(compared).groupBy("key").agg(first_of(per_id), F.sum("copies").alias("n")).filter("n > 1")
    firsts = written(firsts.select("key", "n", F.col("first.id").alias("first_id"), F.col("first.url").alias("first_url"), F.lit(0).alias("zero"))
                     .withColumn("refers_to", record_id("key", "first_id", "first_url", "zero")).drop("zero"), "warc-responses")
    is_first = F.col("id").eqNullSafe(F.col("first_id")) & F.col("url").eqNullSafe(F.col("first_url"))
    revisits = numbered(joined(per_id.filter(compared), firsts, "key", sizes.rows or 0).withColumn("start", F.when(is_first, 1).otherwise(0).cast("long")))
    revisits = revisits.withColumn("record_id", record_id("key", "id", "url", "copy"))

    common = lambda: [("WARC-Record-ID", F.col("record_id")), ("WARC-Date", F.lit(date)), ("WARC-Target-URI", F.col("url")),
                      ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))), ("X-Source-ID", _one_line(F.col("id")))]
    http = F.concat(F.lit(f"{HTTP}Content-Length: "), F.col("length").cast("string"), F.lit("\r\n\r\n"))
    answer = "application/http;msgtype=response"
    full = responses.select(record("response", F.concat(http, F.col("payload")), answer, *common()).alias("value"))
    again = revisits.select(record("revisit", http, answer, *common(), ("WARC-Profile", F.lit(IDENTICAL)), ("WARC-Refers-To", F.col("refers_to")),
                                   ("WARC-Refers-To-Target-URI", F.col("first_url")), ("WARC-Refers-To-Date", F.lit(date))).alias("value"))
    for name, rows in (("responses", full), ("revisits", again)):
        (rows.write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", a_file).text(f"{path}/{name}"))


SCHEMA = ("record_id string, record_type string, id string, url string, refers_to string, digest string, length long, payload binary")


class Inflated:
    """The bytes of a gzip file of any number of members, some at a time."""

    def __init__(self, raw: bytes):
        self.left, self.stream, self.have, self.at = memoryview(raw), zlib.decompressobj(31), b"", 0

    def more(self) -> bool:
        head, self.left = bytes(self.left[:1 << 16]), self.left[1 << 16:]
        if not head:
            return False
        out = [self.have[self.at:]]
        while head:
            out.append(self.stream.decompress(head))
            head = self.stream.unused_data
            if self.stream.eof:
                self.stream = zlib.decompressobj(31)
        self.have, self.at = b"".join(out), 0
        return True

    def until(self, mark: bytes) -> bytes | None:
        """What comes before the next mark, without it; None at the end."""
        while (end := self.have.find(mark, self.at)) < 0:
            if not self.more():
                if self.at < len(self.have):
                    raise ValueError("a record ends in its header")
                return None
        out, self.at = self.have[self.at:end], end + len(mark)
        return out

    def take(self, n: int) -> bytes:
        parts, missing = [], n
        while missing > (here := len(self.have) - self.at):
            parts.append(self.have[self.at:])
            missing, self.at = missing - here, len(self.have)
            if not self.more():
                raise ValueError(f"a record ends {missing} bytes early")
        parts.append(self.have[self.at:self.at + missing])
        self.at += missing
        return b"".join(parts)


def records_in(raw: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Named fields and block of every record of a file."""
    data = Inflated(raw)
    while (head := data.until(b"\r\n\r\n")) is not None:
        version, *lines = head.decode().split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"not a record: {version[:40]!r}")
        fields = {k.lower(): v.strip() for k, v in (x.split(":", 1) for x in lines)}
        block = data.take(int(fields["content-length"]))
        if data.take(4) != b"\r\n\r\n":
            raise ValueError("a record does not end where its length says")
        yield fields, block


def _parse(payloads: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        types = [{"length": pa.int64(), "payload": pa.binary()}.get(x, pa.string()) for x in names]

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.record_batch([pa.array(x, t) for x, t in zip(zip(*rows), types)], names)

        for files in batches:
            for raw in files.column("content"):
                rows, size = [], 0
                for fields, block in records_in(raw.as_buffer().to_pybytes()):
                    kind = fields["warc-type"]
                    if kind not in ("response", "revisit"):
                        continue
                    body, digest, n = None, fields["warc-payload-digest"].removeprefix("sha1:"), None
                    if kind == "response":
                        body = block.split(b"\r\n\r\n", 1)[1]
                        n = len(body)
                        if base64.b32encode(hashlib.sha1(body).digest()).decode() != digest:
                            raise ValueError(f"{fields['warc-record-id']}: payload does not have its digest")
                    rows.append((fields["warc-record-id"], kind, fields.get("x-source-id"), fields.get("warc-target-uri"), fields.get("warc-refers-to"),
                                 digest, n, body if payloads else None))
                    size += 400 + (len(body) if payloads and body else 0)
                    if size > 8 << 20:
                        yield batch(rows)
                        rows, size = [], 0
                if rows:
                    yield batch(rows)
    return run


def read_archives(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """Responses and revisits of the archives below ``path``, written once as a
    table; a record whose length or digest is wrong raises.  The length of a
    revisit's payload is not in its record and null."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.gz").load(path).select("content")
    with batches_of(spark, 1):  # a file at a time
        return written(files.mapInArrow(_parse(payloads), SCHEMA), "warc-records")


def resolved(records: DataFrame) -> DataFrame:
    """``records`` of :func:`read_archives`, revisits with the length of the payload
    and the id (``refers_to_id``) of the response they name, whose digest is theirs."""
    responses = records.filter("record_type = 'response'")
    revisits = records.filter("record_type = 'revisit'").drop("length")
    n = written(revisits.groupBy("refers_to").agg(F.count("*").alias("n")), "warc-revisited")
    named = responses.select(F.col("record_id").alias("refers_to"), F.col("id").alias("refers_to_id"), F.col("digest").alias("first_digest"), "length")
    found = joined(revisits, named.join(n, "refers_to"), "refers_to", n.agg(F.sum("n")).first()[0] or 0)
    found = found.filter("digest = first_digest").drop("first_digest")
    return responses.withColumn("refers_to_id", F.lit(None).cast("string")).unionByName(found)


def archived(pages: DataFrame, id_: str, url: str, payload: str, date: str, least: int = 0) -> DataFrame:
    """Write ``pages`` to archives in a run folder, read them back, and resolve."""
    path = run_folder(pages.sparkSession, "llm-warc")
    write_archives(pages.select(F.col(f"`{id_}`").alias("id"), F.col(f"`{url}`").alias("url"), F.col(f"`{payload}`").alias("payload")), path, date, least)
    return resolved(read_archives(pages.sparkSession, path))
