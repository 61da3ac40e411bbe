"""Web archives: writing pages as WARC records and putting their segments together again.

A page becomes an HTTP response with chunked transfer coding. A block above a size is cut into a first record and
continuation records that name it as their origin. Reading groups the segments of an origin, orders them by number,
checks that none is missing and that the lengths add up, decodes the chunks, and checks the payload's digest. Pages with
equal payloads are stored once: the one with the smallest id as response, the others as revisits of it.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stationtide.session import scratch_path

CHUNK_BYTES = 8 * 1024
#: Longest block of a record, longer ones are segmented; with the records of a file it bounds what a reading task holds.
SEGMENT_BYTES = 64 * 1024
FILE_RECORDS = 1000
#: Smallest payload that is stored once only.
REVISIT_BYTES = 0

# Fixed values of the formats.
VERSION = "WARC/1.1"
RECORD_END = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

PARSED = ("origin string, segment int, total long, kind string, page_id long, url string, digest string, refers_to long, "
          "payload_bytes long, problem string, block binary")


def payload_digest(payload: Column) -> Column:
    """SHA-1 of a text's UTF-8 bytes in base 32: eight digits for each five bytes."""
    code = F.sha1(payload.cast("binary"))
    parts = [F.lpad(F.conv(F.substring(code, 1 + 10 * k, 10), 16, 32), 8, "0") for k in range(4)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def with_revisits(pages: DataFrame, least_bytes: int = REVISIT_BYTES) -> DataFrame:
    """``page_id``, ``url``, ``html``, ``digest``, ``refers_to`` (null for responses) of ``pages`` (page_id, url, html)."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), html.alias("html"), payload_digest(html).alias("digest"))
    equal = (rows.filter(F.octet_length("html") >= least_bytes).groupBy("digest")
             .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1 AND first IS NOT NULL").select("digest", "first"))
    return rows.join(equal, "digest", "left").select(
        "page_id", "url", "html", "digest", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"))


def chunked(payload: bytes) -> bytes:
    """Chunked transfer coding, cut between characters."""
    out, at = [], 0
    while at < len(payload):
        end = _character_end(payload, at + CHUNK_BYTES)
        out += (f"{end - at:x}\r\n".encode(), payload[at:end], b"\r\n")
        at = end
    return b"".join([*out, b"0\r\n\r\n"])


def dechunked(body: bytes) -> bytes:
    """Decode chunked transfer coding; chunk extensions and trailers are skipped."""
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0].strip(), 16)
        if size < 0:
            raise ValueError("negative chunk size")
        at = end + 2
        if not size:
            return b"".join(out)
        if len(body) < at + size + 2 or body[at + size:at + size + 2] != b"\r\n":
            raise ValueError("chunk cut short")
        out.append(body[at:at + size])
        at += size + 2


def _character_end(data: bytes, at: int) -> int:
    """The cut at or shortly before ``at`` that splits no UTF-8 character."""
    at = min(at, len(data))
    while at < len(data) and data[at] & 0xC0 == 0x80:
        at -= 1
    return at


def http_payload(block: bytes) -> bytes:
    """Body of an HTTP response, its transfer coding undone."""
    head, _, body = block.partition(b"\r\n\r\n")
    fields = dict(_field(line) for line in head.split(b"\r\n")[1:])
    return dechunked(body) if "chunked" in fields.get("transfer-encoding", "").lower() else body


def _field(line: bytes) -> tuple[str, str]:
    name, _, value = line.decode("utf-8", "replace").partition(":")
    return name.strip().lower(), value.strip()


def _records(page_id, url, html, digest, refers_to, record_id: str, date: str) -> Iterator[str]:
    """The records of one page, each without its closing line ends."""
    head = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
    block = head.encode() + (chunked(html.encode("utf-8", "surrogatepass")) if refers_to is None else b"")
    target = "".join(c for c in url if c.isprintable()) if url else "about:blank"
    fields = {"WARC-Type": "response" if refers_to is None else "revisit", "WARC-Record-ID": f"<urn:uuid:{record_id}>", "WARC-Date": date, "WARC-Target-URI": target,
              "WARC-Payload-Digest": f"sha1:{digest}", "Content-Type": "application/http;msgtype=response"}
    if page_id is not None:
        fields["Page-ID"] = str(page_id)
    if refers_to is not None:
        fields |= {"WARC-Profile": REVISIT_PROFILE, "Refers-To-Page-ID": str(refers_to)}
    cuts = [0]
    while cuts[-1] < len(block):
        cuts.append(_character_end(block, cuts[-1] + SEGMENT_BYTES))
    for number, (a, b) in enumerate(zip(cuts, cuts[1:]), 1):
        own = dict(fields)
        if len(cuts) > 2:
            own["WARC-Segment-Number"] = str(number)
        if number > 1:
            own = {"WARC-Type": "continuation", "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(uuid.UUID(record_id), str(number))}>", "WARC-Date": date,
                   "WARC-Target-URI": target, "WARC-Segment-Origin-ID": fields["WARC-Record-ID"], "WARC-Segment-Number": str(number)}
            if b == len(block):
                own["WARC-Segment-Total-Length"] = str(len(block))
        lines = [VERSION, *(f"{k}: {v}" for k, v in own.items()), f"Content-Length: {b - a}"]
        yield "\r\n".join(lines) + RECORD_END + block[a:b].decode("utf-8", "surrogatepass")


def write_archives(pages: DataFrame, path: str, date: str = "2000-01-01T00:00:00Z") -> None:
    """Write ``pages`` below ``path`` as gzip-compressed WARC files of at most FILE_RECORDS records.

    A record is a line of Spark's text writer whose line end is the two line ends that close a record. Record ids follow
    from the task and the row's place in it, so a repeated task writes the same ids and repeated rows stay apart.
    """
    run_id = uuid.uuid4()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                out = []
                for row in zip(*(batch.slice(at, 200).column(c).to_pylist() for c in ("page_id", "url", "html", "digest", "refers_to"))):
                    out += _records(*row, str(uuid.uuid5(run_id, f"{task}/{n}")), date)
                    n += 1
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["value"])

    with_revisits(pages).mapInArrow(run, "value string").write.option("lineSep", RECORD_END).option("compression", "gzip").option("maxRecordsPerFile", FILE_RECORDS).text(path)


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Fields (names in lower case) and block of each record of an archive file, compressed or not.

    What is no record is skipped up to the next line that starts one. A place where something was lost comes with the field
    ``problem``: a record whose length is missing or reaches beyond the file, with what there is of its fields, lines
    between records, or the broken end of a compressed file, without any.
    """
    stream = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(data)), 1 << 16) if data[:2] == b"\x1f\x8b" else io.BytesIO(data)
    lost = False
    try:
        while line := stream.readline():
            if not line.strip():
                continue
            if not line.startswith(b"WARC/"):
                if not lost:
                    yield {"problem": "archive"}, b""
                lost = True
                continue
            fields, lost = {}, False
            while (line := stream.readline()).strip():
                name, value = _field(line)
                fields[name] = value
            size = _number(fields.get("content-length"))
            if size is None:
                lost = True
                yield fields | {"problem": "archive"}, b""
                continue
            block = stream.read(size)
            yield (fields if len(block) == size else fields | {"problem": "archive"}), block
    except (EOFError, OSError, zlib.error):
        yield {"problem": "archive"}, b""


def _number(value: str | None) -> int | None:
    return int(value) if value and value.isascii() and value.isdigit() else None


def _signed(value: str | None) -> int | None:
    size = _number((value or "").removeprefix("-"))
    return -size if size is not None and value.startswith("-") else size


def _checked(kind: str, block: bytes, digest: str | None) -> tuple[int | None, str | None, str | None]:
    """(payload bytes, digest, problem) of a whole block; revisits have no payload of their own."""
    if kind == "revisit":
        return None, digest, None
    try:
        payload = http_payload(block)
    except ValueError:
        return None, digest, "framing"
    own = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    return len(payload), own, None if digest in (None, own) else "digest"


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """``page_id``, ``url``, ``record_type``, ``payload_bytes``, ``payload_digest``, ``refers_to``, ``problem`` of each page below ``path``.

    Revisits take the payload's length from the response they refer to. ``problem`` is null for sound records, else
    ``segments`` (one is missing or repeated), ``length`` (they do not add up), ``framing``, ``digest``, ``target`` (a revisit
    of nothing) or ``archive``: the file is damaged there. A damaged place that cannot be told to be of a page has a row of its
    own with the record type ``damaged`` and no page_id; the rest of the file is read.
    """
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path_of, content in zip(batch.column("path"), batch.column("content")):
                rows, held = [], 0
                for place, (fields, block) in enumerate(parse(content.as_py())):
                    kind, bad, record = fields.get("warc-type"), fields.get("problem"), fields.get("warc-record-id")
                    known = kind in ("response", "revisit", "continuation")
                    if not known and bad is None:
                        continue
                    origin = fields.get("warc-segment-origin-id") if kind == "continuation" else record
                    if not known or origin is None:
                        rows.append((f"damaged {path_of}/{place}", 0, None, "damaged", None, None, None, None, None, bad or "archive", None))
                        continue
                    if bad and kind == "continuation":
                        continue  # its origin lacks a segment then
                    number = _number(fields.get("warc-segment-number"))
                    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
                    whole = number is None or bad is not None
                    size, found, problem = (None, digest, bad) if bad or not whole else _checked(kind, block, digest)
                    rows.append((origin, 0 if whole else number, _number(fields.get("warc-segment-total-length")), kind, _signed(fields.get("page-id")), fields.get("warc-target-uri"),
                                 found, _signed(fields.get("refers-to-page-id")), size, problem, None if whole else block))
                    held += len(block)
                    if held > 8_000_000:
                        yield _batch(rows)
                        rows, held = [], 0
                yield _batch(rows)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")
    parts = files.mapInArrow(scan, PARSED).groupBy("origin").agg(
        F.sort_array(F.collect_list(F.struct("segment", "total", "kind", "page_id", "url", "digest", "refers_to", "payload_bytes", "problem", "block"))).alias("s"))
    whole = parts.mapInArrow(_assemble, "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, problem string")
    stored = (whole.filter("record_type = 'response' AND problem IS NULL").groupBy("payload_digest")
              .agg(F.max("payload_bytes").alias("stored")).withColumnRenamed("payload_digest", "d"))
    revisit = F.col("record_type") == "revisit"
    return whole.join(stored, revisit & (F.col("payload_digest") == F.col("d")), "left").select(
        "page_id", "url", "record_type", F.when(revisit, F.col("stored")).otherwise(F.col("payload_bytes")).alias("payload_bytes"), "payload_digest", "refers_to",
        F.when(revisit & F.col("stored").isNull(), F.lit("target")).otherwise(F.col("problem")).alias("problem"))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    names = [c.strip().split(" ")[0] for c in PARSED.split(",")]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names)


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each origin from its segments in order."""
    for batch in batches:
        rows = []
        for entry in batch.column("s"):
            parts = entry.as_py()
            first = parts[0]
            size, digest, problem, kind = first["payload_bytes"], first["digest"], first["problem"], first["kind"]
            if len(parts) > 1 or first["segment"]:
                total = parts[-1]["total"]
                if [p["segment"] for p in parts] != list(range(1, len(parts) + 1)) or kind == "continuation" or (total is None and len(parts) > 1):
                    problem = "segments"
                elif total is not None and total != sum(len(p["block"] or b"") for p in parts):
                    problem = "length"
                else:
                    size, digest, problem = _checked(kind, b"".join(p["block"] for p in parts), digest)
            rows.append((first["page_id"], first["url"], kind, size, digest, first["refers_to"], problem))
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string()]
        names = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "problem"]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names)


def archived_pages(pages: DataFrame) -> DataFrame:
    """Write ``pages`` (page_id, url, html) to archives in the shared folder and return what :func:`read_archives` finds there.

    One output row for each input row. A null html is an empty payload; empty payloads are equal to one another. Rows
    that repeat the smallest id of their payload are responses all of them; a row without id is a revisit unless no
    row of its payload has an id. Urls lose unprintable characters, a null one becomes ``about:blank``. An empty table
    gives an empty result; other columns are not read. Payloads of any length are cut into segments.
    """
    path = scratch_path(pages.sparkSession, "archives")
    write_archives(pages, path)
    return read_archives(pages.sparkSession, path)
