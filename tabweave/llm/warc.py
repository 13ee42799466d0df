"""WARC records from legacy ARC archives.

An ARC file opens with a version block whose first line after the header names the version: 1 (URL, IP
address, archive date, content type, length) or 2 (result code, checksum, location, offset and file name
before the length). Records follow, each a header line, as many bytes as it declares, and a line feed.
The converter walks the declared lengths, never looking for markers inside content, and makes WARC
records of them: an identifier derived from URL, date and content, the date as WARC-Date, response (HTTP
content) or resource, and block and payload digests. Equal payloads become one response and revisits.

Archives are written and read by Spark itself (any file system), a row of text for each file: tasks join
records up to about `FILE_BYTES` into one row, so a file is never larger than that and one record.

Edge cases: null html is an empty payload; null or odd URLs are percent-encoded (null: about:blank);
bytes that follow the last whole record of an archive are reported as a record of kind "broken";
pages that repeat an id each give a record; an empty table gives no rows.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabweave.llm.common import bounded, removed, scratch, stored, table

ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
ARC_END, WARC_END = "\n", "\r\n\r\n"
REVISIT_LEAST = 1000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Bytes at which a file of an archive is closed; a file is parsed whole by one task.
FILE_BYTES = 8 << 20
#: Revisits whose targets are broadcast at most, about 200 bytes each; with more, records are dealt out by their identifiers.
BROADCAST_REVISITS = 500_000
#: Records turned into Python objects at once; copies of a payload that one task joins.
ROWS, SALT_ROWS = 256, 4096
SCHEMA = "uri string, ip string, date string, mime string, status int, content binary, version int, offset long"


def parse_arc(data: bytes) -> Iterator[dict]:
    """Records of an ARC file in order, by declared lengths; the version block is consumed, not returned."""
    at, version = 0, 1
    while at < len(data):
        if data[at:at + 1] == b"\n":  # between records
            at += 1
            continue
        end = data.find(b"\n", at)
        line = data[at:end].rstrip(b"\r").decode("utf-8", "surrogateescape") if end >= 0 else ""
        fields = line.split(" ")
        head = line.startswith("filedesc://")
        names = ARC_FIELDS[1 if head and len(fields) == 5 else 2 if head else version].split(" ")
        if len(fields) < len(names) or not fields[-1].isdigit() or end + 1 + int(fields[-1]) > len(data):
            yield {"uri": "", "ip": "", "date": "", "mime": "broken", "status": None, "content": data[at:], "version": version, "offset": at}
            return
        if len(fields) > len(names):  # a content type with spaces
            fields = fields[:3] + ["".join(fields[3:3 + len(fields) - len(names) + 1])] + fields[4 + len(fields) - len(names):]
        record = dict(zip(names, fields, strict=True))
        start, stop = end + 1, end + 1 + int(fields[-1])
        content = data[start:stop]
        if head:
            first = content.split(b"\n", 1)[0].split(b" ")[0]
            version = 2 if first == b"2" else 1
        else:
            code = record.get("Result-code", "")
            yield {"uri": record["URL"], "ip": record["IP-address"], "date": record["Archive-date"], "mime": record["Content-type"], "status": int(code) if code.isdigit() else None, "content": content, "version": version, "offset": at}
        at = stop


def http_payload(content: bytes) -> bytes:
    """What follows the HTTP headers; all of it if there are none."""
    if not content.startswith(b"HTTP/"):
        return content
    end = content.find(b"\r\n\r\n")
    return content[end + 4:] if end >= 0 else content


def arc_date(date: str) -> str:
    digits = re.sub(r"\D", "", date)[:14].ljust(4, "0")
    digits += "0101000000"[len(digits) - 4:] if len(digits) < 14 else ""
    return f"{digits[:4]}-{digits[4:6]}-{digits[6:8]}T{digits[8:10]}:{digits[10:12]}:{digits[12:14]}Z"


def record_id(uri: str, date: str, headers: bytes, digest: str) -> str:
    """From the URL, the date and the content: its HTTP headers and the digest of its payload."""
    name = hashlib.sha1(f"{uri} {date} {digest} ".encode("utf-8", "surrogateescape") + headers).digest()
    return f"urn:uuid:{uuid.UUID(bytes=name[:16], version=5)}"


def warc_record(arc: dict, refers_to: str | None = None, refers_date: str | None = None) -> bytes:
    """The equivalent WARC record without the two line ends that close it; a revisit if it refers to another."""
    content, http = arc["content"], arc["content"].startswith(b"HTTP/")
    payload = http_payload(content)
    headers = content[:len(content) - len(payload)]
    date, digest = arc_date(arc["date"]), hashlib.sha1(payload).hexdigest()
    whole = hashlib.sha1(headers)
    if not refers_to:
        whole.update(payload)
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if refers_to else 'response' if http else 'resource'}", f"WARC-Record-ID: <{record_id(arc['uri'], date, headers, digest)}>",
        f"WARC-Date: {date}", f"WARC-Target-URI: {arc['uri']}", f"WARC-IP-Address: {arc['ip']}",
        f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{whole.hexdigest()}",
        f"Content-Type: {'application/http;msgtype=response' if http else arc['mime']}",
    ]
    if refers_to:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{refers_to}>", f"X-Payload-Length: {len(payload)}"] + [f"WARC-Refers-To-Date: {refers_date}"] * bool(refers_date)
    block = headers if refers_to else content
    return "\r\n".join([*head, f"Content-Length: {len(block)}"]).encode("utf-8", "surrogateescape") + b"\r\n\r\n" + block


def parse_warc(data: bytes) -> Iterator[tuple[dict, bytes]]:
    """(headers, block) of every record, by declared lengths."""
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if end < 0 or not data.startswith(b"WARC/", at):
            yield {"WARC-Type": "broken"}, data[at:]
            return
        lines = data[at:end].decode("utf-8", "surrogateescape").split("\r\n")
        headers = dict(x.split(": ", 1) for x in lines[1:])
        length = int(headers["Content-Length"])
        yield headers, data[end + 4:end + 4 + length]
        at = end + 4 + length + 4


def write_files(files: DataFrame, path: str, end: str) -> None:
    """files: one binary column, the content of a gzipped file in each row but for the bytes that end its last record. No exchange."""
    text = files.select(F.col(files.columns[0]).cast("string").alias("value"))
    text.write.option("lineSep", end).option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").option("maxRecordsPerFile", 1).text(path)


class _Files:
    """Joins records, with what ends each between them, into files: rows of one binary column."""

    def __init__(self, end: str, size: int = FILE_BYTES) -> None:
        self.end, self.size, self.parts, self.held = end.encode(), size, [], 0

    def add(self, data: bytes) -> Iterator[pa.RecordBatch]:
        self.parts.append(data)
        self.held += len(data)
        if self.held >= self.size:
            yield from self.close()

    def close(self) -> Iterator[pa.RecordBatch]:
        if self.parts:
            yield pa.RecordBatch.from_arrays([pa.array([self.end.join(self.parts)], pa.binary())], ["file"])
        self.parts, self.held = [], 0


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")


def unpacked(data: bytes) -> bytes:
    return gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data


def arc_lead(version: int) -> bytes:
    """The version block that opens an archive."""
    block = f"{version} 0 tabweave\n{ARC_FIELDS[version]}\n".encode()
    return b"filedesc://tabweave.arc 0.0.0.0 20240101000000 text/plain " + (b"" if version == 1 else b"200 - - 0 tabweave.arc ") + str(len(block)).encode() + b"\n" + block + b"\n"


def write_arc(pages: DataFrame, path: str, size: int = FILE_BYTES) -> None:
    """pages: uri, ip, date, mime, status, content. The files of a task are archives of version 1 and 2 by turns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        made, out = TaskContext.get().partitionId(), _Files(ARC_END, size)
        for batch in batches:
            for i in range(0, batch.num_rows, ROWS):
                for uri, ip, date, mime, status, content in zip(*(c.slice(i, ROWS).to_pylist() for c in batch.columns), strict=True):
                    version = made % 2 + 1
                    rest = [] if version == 1 else [str(status), "-", "-", "0", "tabweave.arc"]
                    line = " ".join([uri, ip, date, mime, *rest, str(len(content))]).encode("utf-8", "surrogateescape") + b"\n"
                    lead = b"" if out.parts else arc_lead(version)
                    for file in out.add(lead + line + content):
                        made += 1
                        yield file
        yield from out.close()

    write_files(pages.select("uri", "ip", "date", "mime", "status", "content").mapInArrow(run, "file binary"), path, ARC_END)


def _batches(rows: Iterator[tuple], names: list[str], kinds: list[pa.DataType], at: int) -> Iterator[pa.RecordBatch]:
    """Arrow batches of about 4 MB in field `at`."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[at])
        if size > 4 << 20 or len(held) >= 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], names)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], names)


def _fields(schema: str) -> tuple[list[str], list[pa.DataType]]:
    kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    pairs = [x.split(" ") for x in schema.split(", ")]
    return [n for n, _ in pairs], [kinds[k] for _, k in pairs]


def _archives(batches: Iterator[pa.RecordBatch]) -> Iterator[bytes]:
    """The content of one file at a time."""
    for batch in batches:
        for data in batch.column(0):
            yield unpacked(data.as_py())


def _arcs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names, kinds = _fields(SCHEMA)
    for data in _archives(batches):
        yield from _batches((tuple(r[n] for n in names) for r in parse_arc(data)), names, kinds, names.index("content"))


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    return read_archives(spark, path).mapInArrow(_arcs, SCHEMA)


FACTS = "order long, id string, size long, sha1 string, other long, day string"
KEYED = SCHEMA + ", id string"


def _described(record: dict) -> tuple[bytes, str, str]:
    """Of a record: HTTP headers, payload digest, identifier."""
    payload = http_payload(record["content"])
    headers = record["content"][:len(record["content"]) - len(payload)]
    digest = hashlib.sha1(payload).hexdigest()
    return headers, digest, record_id(record["uri"], arc_date(record["date"]), headers, digest)


def _facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What tells payloads apart, straight from the archives; contents stay in the task."""
    import xxhash

    names, kinds = _fields(FACTS)
    for data in _archives(batches):
        rows = []
        for record in parse_arc(data):
            headers, digest, own = _described(record)
            payload = record["content"][len(headers):]
            found = re.search(rb"\r\nX-Record-Order: (-?\d+)\r\n", headers)
            rows.append((int(found[1]) if found else None, own, len(payload), digest, xxhash.xxh3_64_intdigest(payload) - (1 << 63), arc_date(record["date"])))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names, kinds = _fields(KEYED)
    for data in _archives(batches):
        yield from _batches(((*(r[n] for n in names[:-1]), _described(r)[2]) for r in parse_arc(data)), names, kinds, names.index("content"))


def converted(archives: DataFrame, least: int = REVISIT_LEAST, size: int = FILE_BYTES) -> DataFrame:
    """archives: rows of read_archives(), ARC files. Returns one binary column, WARC files.

    Of equal payloads (length, SHA-1 and a second hash) of `least` bytes the record of the largest X-Record-Order header, then identifier, is kept as response."""
    same = ["size", "sha1", "other"]
    facts = stored(archives.mapInArrow(_facts, FACTS), "arc")
    best = facts.where(F.col("size") >= least).groupBy(*same).agg(F.max(F.struct("order", "id", "day")).alias("best"), F.count("*").alias("n")).where("n > 1")
    best = best.withColumn("salts", F.greatest(F.lit(1), F.ceil(F.col("n") / SALT_ROWS)).cast("int"))  # a payload may be that of a third of all records
    spread = facts.join(best.where("salts > 1").select(*same, "salts"), same, "left").withColumn("salt", F.pmod(F.xxhash64("id"), F.coalesce("salts", F.lit(1))).cast("int"))
    best = best.select(*same, "best", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    refers = spread.join(best, [*same, "salt"]).where(F.col("id") != F.col("best.id")).select("id", F.col("best.id").alias("refers_to"), F.col("best.day").alias("refers_day")).distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Files(WARC_END, size)
        for batch in batches:
            for i in range(0, batch.num_rows, ROWS):
                for r in batch.slice(i, ROWS).to_pylist():
                    yield from out.add(warc_record(r, r["refers_to"], r["refers_day"]))
        yield from out.close()

    keyed = archives.mapInArrow(_keyed, KEYED)
    return keyed.join(bounded(refers, "refers", BROADCAST_REVISITS), "id", "left").select("uri", "ip", "date", "mime", "content", "refers_to", "refers_day").mapInArrow(run, "file binary")


RECORDS = "id string, type string, uri string, date string, digest string, refers_to string, payload_bytes long, headers binary, payload binary"


def _record(head: dict, block: bytes) -> tuple:
    payload = http_payload(block) if head["WARC-Type"] == "response" else b"" if head["WARC-Type"] == "revisit" else block
    return (head.get("WARC-Record-ID", "").strip("<>"), head["WARC-Type"], head.get("WARC-Target-URI"), head.get("WARC-Date"), head.get("WARC-Payload-Digest", "").removeprefix("sha1:"), head.get("WARC-Refers-To", "").strip("<>") or None,
            int(head.get("X-Payload-Length", len(payload))), block[:len(block) - len(payload)], payload)


def _warcs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names, kinds = _fields(RECORDS)
    for data in _archives(batches):
        yield from _batches((_record(*r) for r in parse_warc(data)), names, kinds, names.index("payload"))


def _warc_facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records without their payloads, which are digested anew here and compared with the declared digest."""
    names, kinds = _fields(RECORDS)
    for data in _archives(batches):
        rows = []
        for head, block in parse_warc(data):
            *row, payload = _record(head, block)
            if row[1] != "revisit" and hashlib.sha1(payload).hexdigest() != row[4]:
                row[1] = "broken"
            rows.append(row)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=False)], names[:-1])


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per record: identifier, type, URI, date, payload digest, what it refers to, payload length, HTTP headers, payload (empty in revisits) if asked for.

    Without payloads, records whose payload differs from its digest are of type "broken"."""
    if payloads:
        return read_archives(spark, path).mapInArrow(_warcs, RECORDS)
    return read_archives(spark, path).mapInArrow(_warc_facts, RECORDS.removesuffix(", payload binary"))


def page_content(html: Column, order: Column) -> Column:
    """HTTP content of a page, which carries its number."""
    body = F.coalesce(html, F.lit("")).cast("binary")
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nX-Record-Order: "), F.coalesce(order.cast("string"), F.lit("none")), F.lit("\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"))
    return F.concat(head.cast("binary"), body)


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    uri = F.coalesce(F.regexp_replace("url", r"\s", "%20"), F.lit("about:blank"))
    arc = pages.select(uri.alias("uri"), F.lit("192.0.2.1").alias("ip"), F.lit("20240101000000").alias("date"), F.lit("text/html").alias("mime"), F.lit(200).alias("status"), page_content(F.col("html"), F.col("page_id")).alias("content"))
    arcs, warcs = scratch(spark, "arc"), scratch(spark, "warc")
    write_arc(arc, arcs)
    write_files(converted(read_archives(spark, arcs)), warcs, WARC_END)
    removed(spark, arcs)
    read = read_warc(spark, warcs, payloads=False)
    number = F.regexp_extract(F.col("headers").cast("string"), "X-Record-Order: (-?[0-9]+)", 1)
    rows = stored(read.select("id", F.when(number != "", number.cast("long")).alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"), F.col("type").alias("record_type"), "refers_to"), "pages")
    removed(spark, warcs)
    target = rows.where("record_type = 'response'").select(F.col("id").alias("refers_to"), F.col("page_id").alias("to")).dropDuplicates(["refers_to"])
    revisits = rows.where("record_type = 'revisit'").join(target, "refers_to", "left").select("page_id", "payload_bytes", "payload_digest", "record_type", F.col("to").alias("refers_to"))
    return rows.where("record_type <> 'revisit'").select("page_id", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("long").alias("refers_to")).unionByName(revisits)


OP8_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, strlen(coalesce(html, '')) AS n FROM pages),
m AS (SELECT h, max(page_id) AS keep FROM p WHERE n >= 1000 GROUP BY h)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha1(p.h) AS payload_digest, CASE WHEN m.keep IS NULL OR m.keep = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN m.keep <> page_id THEN m.keep END AS refers_to
FROM p LEFT JOIN m ON p.h = m.h
"""
