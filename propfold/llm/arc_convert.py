"""Legacy ARC archives: writing, parsing and conversion to WARC.

ARC files begin with a version block whose own lines say which fields the header line of
each record has; versions 1 and 2 differ in them. A record is its header line, as many
bytes as the line declares, and a line feed. The converter gives each record a WARC
header: an identifier made from the record itself, a timestamp from the 14-digit date, a
type, and SHA-1 digests of block and payload. The version block becomes a warcinfo record.

Of records with equal payloads of at least ``REVISIT_BYTES`` bytes, the one with the
largest page id is a response; the others become revisits that refer to it and hold only
its HTTP header. Equal rows of one page id are all responses.

Files hold about ``FILE_BYTES`` bytes of payload each, so that a task reads one file at a
time; they are gzip streams that Spark's text writer makes in any store it can write to.
What the records of a file refer to is sent to the file, not the records to what they refer
to; while that is at most ``SENT`` rows, it is broadcast and no payload passes a shuffle.

Archives of others are taken as they are: payloads are bytes of any kind, the lines of HTTP
headers may end in a bare line feed, and blanks in a URL belong to it, since fields are
counted from the end of a header line. A record whose header line or length is wrong is
left out and the next one is looked for; ``rejected`` lists such places.

A null html is an empty payload, a null url a placeholder, and a null page id is left out
of the HTTP header and comes back as null. An empty table gives no files and no rows.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propfold.llm.staging import new_folder, stage

FILE_BYTES = 24 << 20
REVISIT_BYTES = 1000
SENT = 200_000
DATE = "20240301120000"
NO_URL = "urn:x-no-url"

# Fixed values of the two versions of the format.
VERSION_LINES = {
    1: "1 0 propfold\nURL IP-address Archive-date Content-type Archive-length\n",
    2: "2 0 propfold\nURL IP-address Archive-date Content-type Result-code Checksum "
    "Location Offset Filename Archive-length\n",
}
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"


# The empty line after HTTP headers, whose lines may lack the carriage return.
HEADER_END = re.compile(rb"\r?\n\r?\n")
# A header line: a URL, an address, a date, a type, maybe more, and a length.
ARC_HEADER = re.compile(rb"(?m)^[A-Za-z][A-Za-z0-9+.-]*:[^\n]* [0-9.:a-fA-F]+ [0-9]{8,14} [^\n]* ?[0-9]+\r?$")


class ArcRecord(NamedTuple):
    fields: dict[str, str]  # by lower-case name
    block: bytes
    version: bool = False  # the block that begins a file


class Payload(NamedTuple):
    head: bytes  # HTTP status line and headers with the empty line, or nothing
    body: bytes
    headers: dict[str, str]


def http_payload(block: bytes) -> Payload:
    if not block.startswith(b"HTTP/"):
        return Payload(b"", block, {})
    end = HEADER_END.search(block)
    head = block[: end.end()] if end else block
    lines = head.decode("utf-8", "replace").splitlines()[1:]
    pairs = (line.partition(":") for line in lines if ":" in line)
    return Payload(head, block[len(head) :], {a.strip().lower(): b.strip() for a, _, b in pairs})


# Writing ARC


def header_safe(value: str | None) -> str:
    """A URL without the blanks that separate the fields of a header line."""
    return re.sub(r"\s", lambda m: f"%{ord(m[0]):02X}", value) if value else NO_URL


def arc_header(version: int, url: str, kind: str, length: int, extra: tuple = ("200", "-", "-", "0", "-")) -> str:
    fields = [url, "0.0.0.0", DATE, kind, *(extra if version == 2 else ()), str(length)]
    return " ".join(fields)


def version_block(version: int, name: str) -> str:
    body = VERSION_LINES[version]
    return f"{arc_header(version, f'filedesc://{name}', 'text/plain', len(body))}\n{body}"


def arc_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Text of the records of one file, the version block first; version by file."""
    task = TaskContext.get().partitionId()
    version = 1 + task % 2
    rows = [version_block(version, f"pages-{task:06d}.arc")]
    for batch in batches:
        for page, url, html in zip(*(batch.column(c) for c in ("page_id", "url", "html")), strict=True):
            body = html.as_py() or ""
            head = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            head += f"Content-Length: {len(body.encode())}\r\n"
            if page.is_valid:
                head += f"X-Page-Id: {page.as_py()}\r\n"
            block = f"{head}\r\n{body}"
            length = len(block.encode())
            rows.append(f"{arc_header(version, header_safe(url.as_py()), 'text/html', length)}\n{block}")
        if batch.num_rows:
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.string())], names=["value"])
            rows = []


def write_arc(pages: DataFrame, folder: str) -> None:
    """Write ``pages(page_id, url, html)`` as ARC files of versions 1 and 2."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    size = rows.agg(F.sum(F.coalesce(F.octet_length("html"), F.lit(0)) + 200)).first()[0] or 0
    files = max(1, -(-size // FILE_BYTES))
    rows = rows.repartition(files, "page_id", F.xxhash64("url"))
    rows.mapInArrow(arc_rows, "value string").write.option("lineSep", "\n").option(
        "compression", "gzip"
    ).text(folder)


# Reading


URL_RECORD = ["url", "ip-address", "archive-date", "content-type", "archive-length"]


def parse_arc(data: bytes, bad: list[tuple[int, str]] | None = None) -> Iterator[ArcRecord]:
    """Records of an ARC file, the version block first; later URLs may look like that of one.

    A place that holds no record is an error; given a list ``bad``, it is added to it with
    what is wrong, and the next header line is looked for behind it.
    """
    first, at, names = True, 0, URL_RECORD
    while at < len(data):
        end = data.find(b"\n", at)
        end = len(data) if end < 0 else end
        line = data[at:end].decode("utf-8", "replace").strip()
        if not line:
            at = end + 1
            continue
        version, first = first and line.startswith("filedesc:"), False
        if version:  # may have more fields than are declared before it
            parts = line.split(" ")
            parts = [*parts[:4], parts[-1]] if len(parts) > 4 else parts
        else:
            parts = line.rsplit(" ", len(names) - 1)
        length = int(parts[-1]) if re.fullmatch("[0-9]+", parts[-1]) else -1
        block = data[end + 1 : end + 1 + max(length, 0)]
        wrong = wrong_record(parts, URL_RECORD if version else names, length, data, end + 1)
        if wrong:
            if bad is None:
                raise ValueError(f"{wrong}: {line[:100]!r}")
            bad.append((at, wrong))
            following = ARC_HEADER.search(data, end + 1)
            at = following.start() if following else len(data)
            continue
        if version:
            lines = block.decode("utf-8", "replace").split("\n")
            if len(lines) > 1 and lines[1].strip():
                names = lines[1].lower().split()
            yield ArcRecord(dict(zip(URL_RECORD, parts, strict=True)), block, True)
        else:
            yield ArcRecord(dict(zip(names, parts, strict=True)), block)
        at = end + 1 + length


def wrong_record(parts: list[str], names: list[str], length: int, data: bytes, begin: int) -> str:
    """What is wrong with a record whose header line has these parts; empty if nothing is."""
    if len(parts) != len(names):
        return f"{len(parts)} fields, {len(names)} declared"
    if length < 0:
        return f"no length: {parts[-1][:40]!r}"
    if begin + length > len(data):
        return f"{length} bytes declared, {len(data) - begin} left"
    if not re.fullmatch("[0-9]{4,14}", dict(zip(names, parts, strict=True)).get("archive-date", "0000")):
        return "no date"
    end = begin + length
    if end < len(data) and b"\n" not in data[end - 1 : end + 1] and data[end : end + 1] != b"\r":
        return "the record does not end where its length says"
    return ""


def parse_warc(data: bytes) -> Iterator[ArcRecord]:
    """Records of a WARC file: headers by lower-case name, and the block."""
    at = 0
    while at < len(data):
        if data[at : at + 2] == b"\r\n":
            at += 2
            continue
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"not a WARC record: {lines[0][:100]!r}")
        pairs = (line.partition(":") for line in lines[1:])
        fields = {a.strip().lower(): b.strip() for a, _, b in pairs}
        length = int(fields["content-length"])
        block = data[end + 4 : end + 4 + length]
        if len(block) < length:
            raise ValueError(f"a record declares {length} bytes, {len(block)} are left")
        yield ArcRecord(fields, block)
        at = end + 4 + length


def unpacked(content: bytes) -> bytes:
    return gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content


def files_in(spark: SparkSession, folder: str) -> DataFrame:
    rows = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    return rows.select("path", "content")


def raw_text(values: list[bytes]) -> pa.Array:
    """Bytes as a text column, unchecked: Spark's text writer writes them as they are."""
    data = pa.array(values, pa.binary())
    return pa.Array.from_buffers(pa.string(), len(data), data.buffers())


def rejected(spark: SparkSession, folder: str) -> DataFrame:
    """(path, place, reason) of what holds no record in the ARC files of a folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
                bad: list[tuple[int, str]] = []
                for _ in parse_arc(unpacked(content.as_py()), bad):
                    pass
                rows = [{"path": path.as_py(), "place": place, "reason": reason} for place, reason in bad]
                kinds = [("path", pa.string()), ("place", pa.int64()), ("reason", pa.string())]
                yield pa.RecordBatch.from_pylist(rows, pa.schema(kinds))

    return files_in(spark, folder).mapInArrow(run, "path string, place long, reason string")


# Conversion


def sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def warc_date(date: str) -> str:
    """An ARC date of 8, 12 or 14 digits as a WARC timestamp."""
    d = (date + "01010000000000"[min(len(date), 4) - 4 :])[:14] if len(date) < 8 else date.ljust(14, "0")[:14]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, ' '.join(parts))}>"


def response_id(record: ArcRecord, payload: Payload) -> str:
    f = record.fields
    page = payload.headers.get("x-page-id", "")
    return record_id("response", f["url"], f["archive-date"], page, sha1(payload.body))


def warc_text(kind: str, id_: str, fields: dict[str, str], block: bytes) -> bytes:
    lines = ["WARC/1.0", f"WARC-Type: {kind}", f"WARC-Record-ID: {id_}"]
    lines += [f"{name}: {value}" for name, value in fields.items()]
    lines += [f"WARC-Block-Digest: {sha1(block)}", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block


def converted(record: ArcRecord, info_id: str, original: tuple[str, str] | None) -> bytes:
    """The WARC record of an ARC record; ``original`` is the id and URL it repeats."""
    f = record.fields
    date = warc_date(f["archive-date"])
    if record.version:
        name = f["url"].removeprefix("filedesc://").replace(".arc", ".warc")
        fields = {"WARC-Date": date, "WARC-Filename": name, "Content-Type": "application/warc-fields"}
        return warc_text("warcinfo", info_id, fields, b"software: propfold\r\nformat: WARC File Format 1.0\r\n")
    payload = http_payload(record.block)
    fields = {"WARC-Target-URI": f["url"], "WARC-Date": date, "WARC-Warcinfo-ID": info_id}
    if f["ip-address"] != "0.0.0.0":
        fields["WARC-IP-Address"] = f["ip-address"]
    if not payload.head:
        fields["Content-Type"] = f["content-type"]
        fields["WARC-Payload-Digest"] = sha1(record.block)
        return warc_text("resource", record_id("resource", f["url"], date, sha1(record.block)), fields, record.block)
    fields["Content-Type"] = "application/http; msgtype=response"
    fields["WARC-Payload-Digest"] = sha1(payload.body)
    own = response_id(record, payload)
    if original is None:
        return warc_text("response", own, fields, record.block)
    fields["WARC-Profile"] = PROFILE
    fields["WARC-Refers-To"], fields["WARC-Refers-To-Target-URI"] = original
    return warc_text("revisit", record_id("revisit", own), fields, payload.head)


def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the choice of revisits needs to know of each HTTP record of a file."""
    for batch in batches:
        for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
            rows = []
            for n, record in enumerate(parse_arc(unpacked(content.as_py()), [])):
                payload = http_payload(record.block)
                page = payload.headers.get("x-page-id")
                if payload.head and page is not None:
                    digest = hashlib.sha1(payload.body).hexdigest()
                    rows.append((path.as_py(), n, int(page), len(payload.body), digest, response_id(record, payload), record.fields["url"]))
            names = ("path", "n", "page_id", "bytes", "digest", "id", "url")
            yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], DESCRIBED_ARROW)


DESCRIBED = "path string, n long, page_id long, bytes long, digest string, id string, url string"
DESCRIBED_ARROW = pa.schema(
    [(c.split()[0], pa.string() if c.endswith("string") else pa.int64()) for c in DESCRIBED.split(", ")]
)


def convert(spark: SparkSession, arc_folder: str, warc_folder: str) -> None:
    """Convert the ARC files of a folder, one WARC file for each batch of files read."""
    files = files_in(spark, arc_folder)
    rows = stage(files.mapInArrow(described, DESCRIBED).where(F.col("bytes") >= REVISIT_BYTES), "arc-records")
    originals = (
        rows.groupBy("digest")
        .agg(F.max(F.struct("page_id", "id", "url")).alias("original"), F.min("page_id").alias("least"))
        .where("least < original.page_id")
    )
    revisits = (
        rows.select("path", "n", "page_id", "digest")
        .join(originals, "digest")
        .where("page_id < original.page_id")
        .groupBy("path")
        .agg(F.collect_list(F.struct("n", "original.id", "original.url")).alias("revisits"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, again in zip(batch.column("content"), batch.column("revisits"), strict=True):
                known = {r["n"]: (r["id"], r["url"]) for r in again.as_py() or ()}
                out, info_id = [], ""
                for n, record in enumerate(parse_arc(unpacked(content.as_py()), [])):
                    if record.version:
                        info_id = record_id("warcinfo", record.fields["url"], record.fields["archive-date"])
                    out.append(converted(record, info_id, known.get(n)))
                yield pa.RecordBatch.from_arrays([raw_text(out)], names=["value"])

    if rows.join(originals, "digest").where("page_id < original.page_id").count() <= SENT:
        revisits = F.broadcast(revisits)
    rows = files.join(revisits, "path", "left").select("content", "revisits")
    # Each record ends with two line ends, which the writer adds.
    rows.mapInArrow(run, "value string").write.option("lineSep", "\r\n\r\n").option(
        "compression", "gzip"
    ).text(warc_folder)


READ = "page_id long, payload_bytes long, payload_digest string, record_type string, id string, original string"
READ_ARROW = pa.schema([(c.split()[0], pa.int64() if c.endswith("long") else pa.string()) for c in READ.split(", ")])


def read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column("content"):
            rows = []
            for record in parse_warc(unpacked(content.as_py())):
                f, kind = record.fields, record.fields["warc-type"]
                if kind not in ("response", "revisit"):
                    continue
                if sha1(record.block) != f["warc-block-digest"]:
                    raise ValueError(f"the block of {f['warc-record-id']} has another digest")
                payload = http_payload(record.block)
                page = payload.headers.get("x-page-id")
                digest = f["warc-payload-digest"]
                if kind == "response" and sha1(payload.body) != digest:
                    raise ValueError(f"the payload of {f['warc-record-id']} has another digest")
                rows.append(
                    {
                        "page_id": None if page is None else int(page),
                        # a revisit holds no payload, but the header that declares its length
                        "payload_bytes": len(payload.body) if kind == "response" else int(payload.headers["content-length"]),
                        "payload_digest": base64.b32decode(digest.removeprefix("sha1:")).hex(),
                        "record_type": kind,
                        "id": f["warc-record-id"],
                        "original": f.get("warc-refers-to"),
                    }
                )
            yield pa.RecordBatch.from_pylist(rows, READ_ARROW)


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of the records."""
    rows = stage(files_in(spark, folder).mapInArrow(read_back, READ), "warc-records")
    target = rows.where("record_type = 'response'").select(
        F.col("id").alias("original"), F.col("page_id").alias("refers_to")
    )
    wanted = rows.where("original is not null").select("original").distinct()
    target = target.join(wanted, "original", "left_semi").distinct()
    return rows.join(target, "original", "left").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def round_trip(pages: DataFrame) -> DataFrame:
    """Write pages as ARC files, convert them to WARC, and read the WARC files."""
    spark = pages.sparkSession
    if pages.isEmpty():
        return spark.createDataFrame(
            [], "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
        )
    arcs, warcs = new_folder(spark, "arc"), new_folder(spark, "warc")
    write_arc(pages, arcs)
    convert(spark, arcs, warcs)
    return read_warc(spark, warcs)
