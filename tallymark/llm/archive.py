"""Legacy web archives: ARC files parsed by their version's header lines, and converted to WARC records.

ARC, version 1 and 2: a file starts with a version block whose URL line names the file and whose body holds the version
and the names of the fields of every URL line:

    v1  URL IP-address Archive-date Content-type Archive-length
    v2  URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length

A record is a URL line, as many bytes as its last field declares, and a line feed. arc_records() reads both versions by
the declared field names and lengths; to_warc() makes up what WARC wants and ARC lacks: a record id (a name-based UUID
of address, date and payload digest), an ISO 8601 date, the record type and base32 SHA-1 digests of block and payload.
The version block becomes a warcinfo record, an answer over http a response, anything else (dns, ftp) a resource.

read_arc() reads ARC files, gzipped or not, as a table, and convert_arc() writes them as WARC. write_warc() does the
same for a table of pages: each becomes an ARC record in memory, is parsed and converted. Files are written by Spark's
text format, so they appear whole or not at all on any file system that Spark reaches. Each record is a gzip member of
its own; the writer's line separator is an empty member. A file has FILE_RECORDS records at most, and fewer where long
payloads would bring it over FILE_BYTES. Of records with equal payloads of least_bytes or more the one with the largest
page_id is the response; the others are revisit records, which refer to it (WARC-Refers-To) and hold no payload.

Defined cases: null html is an empty payload; a null url becomes "urn:page:<id>", and white space or line ends in a url
are percent-coded; a null page_id has no page field and is read back as null, and its record is a response and revisits
nothing; repeated rows with one page_id and one payload are all responses, none refers to itself, and as they are one
capture they have one record id; ARC dates of fewer than 14 digits count from the start of the year, month or day they
name; an empty table gives no records; extra columns are ignored; an ARC record that can't be read (a URL
line without the declared fields, a length that doesn't end at a line end, no date, a broken gzip member) is reported
with its offset, and reading goes on at the next URL line; blanks in a URL or content type are part of it. Where no two pages share a payload nothing is joined
to the html.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .common import shared_dir, sliced, table, written

#: The field names of the two versions' URL lines (fixed values).
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
_FIRST, _LAST = ["URL", "IP-address", "Archive-date", "Content-type"], ["Archive-length"]
#: URL, address, date and content type, of which the first and the last may hold blanks.
_HEAD = re.compile(r"(\S.*) ([0-9A-Fa-f.:]+|-) ([0-9]{4,14}) (.*)")
#: How a line has to start where reading goes on.
_SCHEME = re.compile(rb"[A-Za-z][A-Za-z0-9+.-]*:")
#: How a URL line starts that follows a body without a line end between; the rest of a cut scheme mustn't pass for one.
_SCHEMES = (b"http:", b"https:", b"dns:", b"ftp:")
#: A URL line's bytes at most, and those of a body, which has to fit a row.
LINE_BYTES = 1 << 16
ROW_BYTES = (1 << 31) - 1 - LINE_BYTES
_NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:arc-to-warc")
CRAWLED = datetime(2005, 1, 1, tzinfo=timezone.utc)
#: A file's records at most, and the bytes of payload beyond which it has fewer.
FILE_RECORDS = 4000
FILE_BYTES = 256 << 20
#: An empty gzip member.
_NOTHING = gzip.compress(b"", mtime=0)
#: How a gzip member starts.
_MEMBER = re.compile(rb"\x1f\x8b\x08")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()  # noqa: S324  the format's digest


def arc_url(url: str) -> str:
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def arc_file(version: int, name: str, records: list[tuple[str, str, datetime, str, bytes]]) -> bytes:
    """An ARC file of (url, ip, date, content type, whole HTTP response)."""
    stamp = CRAWLED.strftime("%Y%m%d%H%M%S")
    body = f"{version} 0 tallymark\n{ARC_FIELDS[version]}\n".encode()
    extra = "" if version == 1 else f"200 - - 0 {name} "
    out = [f"filedesc://{name} 0.0.0.0 {stamp} text/plain {extra}{len(body)}\n".encode() + body + b"\n"]
    for url, ip, date, kind, response in records:
        out.append(f"{arc_url(url)} {ip} {date.strftime('%Y%m%d%H%M%S')} {kind} {extra}{len(response)}\n".encode() + response + b"\n")
    return b"".join(out)


class _Lines:
    """A file's lines and byte runs, with the place in it; what was read can be put back."""

    def __init__(self, file: io.BufferedIOBase):
        self.file, self.held, self.at = file, io.BytesIO(), 0

    def take(self, n: int) -> bytes:
        out = self.held.read(n)
        out += self.file.read(n - len(out)) if len(out) < n else b""
        self.at += len(out)
        return out

    def line(self) -> bytes:
        """To the line's end, or LINE_BYTES of it."""
        out = self.held.readline(LINE_BYTES)
        if not out.endswith(b"\n") and len(out) < LINE_BYTES:
            out += self.file.readline(LINE_BYTES - len(out))
        self.at += len(out)
        return out

    def back(self, data: bytes) -> None:
        self.held = io.BytesIO(data + self.held.read())
        self.at -= len(data)

    def to_header(self, names: list[str]) -> None:
        """On to the next line that reads as a URL line with a scheme, or to the end."""
        starts = True
        while line := self.line():
            if starts and _SCHEME.match(line) and _fields(line, names):
                return self.back(line)
            starts = line.endswith(b"\n")


def arc_scan(content: bytes | memoryview) -> Iterator[tuple[int, dict[str, str] | None, bytes, str | None]]:
    """(offset, fields by name, body, problem) of each record, the version block first; offsets are in unpacked bytes.

    What can't be read has a problem, no body, and fields where its URL line could be read. Reading goes on at the next
    line that reads as a URL line: after a line that doesn't, from the start of a body whose declared length doesn't end
    at a line end (the length may reach over the next records), and after a gzip member that is broken.
    """
    broken: list[int] = []
    zipped = bytes(content[:2]) == b"\x1f\x8b"
    file = _Lines(io.BufferedReader(Unzipped(memoryview(content), broken), 1 << 16) if zipped else io.BytesIO(content))
    line = file.line()
    first = line.split()
    if not first or not first[0].startswith(b"filedesc://") or not first[-1].isdigit():
        yield 0, None, b"", "not an ARC file: no filedesc line"
        return
    block = file.take(int(first[-1]))
    version, declared, *_ = block.split(b"\n") + [b""]
    names = declared.decode("utf-8", "replace").split()
    if version.split()[:1] not in ([b"1"], [b"2"]) or names[:4] != _FIRST or names[4:][-1:] != _LAST:
        yield 0, None, b"", f"ARC version {version[:40]!r} with the fields {declared[:200]!r}"
        return
    info = _fields(line, names)
    yield 0, info, block if info else b"", None if info else "the filedesc line doesn't hold the declared fields"
    while line := file.line():
        if not line.strip():
            continue
        at = file.at - len(line)
        if not (found := _fields(line, names)):
            yield at, None, b"", f"a line without the declared fields: {line[:80]!r}"
            file.to_header(names)
            continue
        body = file.take(size := int(found["Archive-length"]))
        after = file.line()
        if len(body) == size and (not after.strip() or after.startswith(_SCHEMES) and _fields(after, names)):
            if after.strip():
                file.back(after)
            try:
                iso_date(found["Archive-date"])
                yield at, found, body, None
            except ValueError:
                yield at, found, b"", f"no date: {found['Archive-date']}"
            continue
        yield at, found, b"", f"record cut short: {len(body)} of {size} bytes" if len(body) < size else f"the record doesn't end after its {size} bytes"
        file.back(body + after)
        file.to_header(names)
    for place in broken:
        yield file.at, None, b"", f"broken gzip data at byte {place} of the file"


def arc_records(content: bytes | memoryview) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields by name, body) of each record, the version block first. Raises ValueError on the first problem."""
    for at, fields, body, problem in arc_scan(content):
        if problem:
            raise ValueError(f"{problem} (byte {at})")
        yield fields, body


def _fields(line: bytes, names: list[str]) -> dict[str, str] | None:
    """A URL line's fields; None where it doesn't hold the declared ones. Blanks may stand in the URL and in the content
    type: the fields after the type are counted from the right, the address and date before it are known by their form."""
    if not line.endswith(b"\n"):
        return None
    text = line.decode("utf-8", "surrogateescape").rstrip("\r\n")
    rest, *tail = text.rsplit(" ", len(names) - len(_FIRST))
    head = _HEAD.fullmatch(rest)
    if len(tail) != len(names) - len(_FIRST) or not head or not tail[-1].isascii() or not tail[-1].isdigit() or int(tail[-1]) > ROW_BYTES:
        return None
    return dict(zip(names, [*head.groups(), *tail], strict=True))


def payload_of(response: bytes) -> tuple[bytes, bytes]:
    """The HTTP head with its blank line, and the payload."""
    end = response.find(b"\r\n\r\n")
    return (response[: end + 4], response[end + 4 :]) if end >= 0 else (b"", response)


def record_id(*said: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, ' '.join(map(str, said)))}>"


@lru_cache(maxsize=4096)
def iso_date(stamp: str) -> str:
    """An ARC date of up to 14 digits; what it doesn't say starts at the beginning."""
    digits = stamp[:14]
    full = digits + "00010101000000"[len(digits) :]
    return datetime.strptime(full, "%Y%m%d%H%M%S").strftime("%Y-%m-%dT%H:%M:%SZ")


def kind_of(fields: dict[str, str]) -> str:
    """The WARC type of an ARC record."""
    scheme = fields["URL"].partition(":")[0].lower()
    return "warcinfo" if scheme == "filedesc" else "response" if scheme in ("http", "https") else "resource"


def to_warc(fields: dict[str, str], body: bytes, extra: dict[str, str] | None = None, refers: str | None = None, kind: str | None = None, name: object = "") -> bytes:
    """A WARC 1.0 record, with the two line ends after it; refers, a record's id, makes it a revisit without payload."""
    kind = kind or ("revisit" if refers else kind_of(fields))
    head, payload = payload_of(body) if kind in ("response", "revisit") else (b"", body)
    found = digest(payload)
    block = head if kind == "revisit" else body
    lines = {
        "WARC-Type": kind,
        "WARC-Record-ID": record_id(fields["URL"], fields["Archive-date"], found, name),
        "WARC-Date": iso_date(fields["Archive-date"]),
        **({"WARC-Filename": fields["URL"].partition("://")[2]} if kind == "warcinfo" else {"WARC-Target-URI": fields["URL"], "WARC-IP-Address": fields["IP-address"], "WARC-Payload-Digest": f"sha1:{found}"}),
        "WARC-Block-Digest": f"sha1:{digest(block)}",
        "Content-Type": "application/http; msgtype=response" if kind in ("response", "revisit") else fields["Content-type"],
        **({"WARC-Profile": REVISIT_PROFILE, "WARC-Refers-To": refers} if kind == "revisit" else {}),
        **(extra or {}),
        "Content-Length": str(len(block)),
    }
    return b"WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines.items()).encode("utf-8", "surrogateescape") + b"\r\n" + block + b"\r\n\r\n"


def warc_records(file: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header lines by lower-case name, block) of each record of a WARC file."""
    while line := file.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        fields = {}
        while (line := file.readline()).strip():
            name, _, value = line.decode().partition(":")
            fields[name.strip().lower()] = value.strip()
        block = file.read(size := int(fields["content-length"]))
        if len(block) != size:
            raise ValueError("record cut short")
        yield fields, block


class Unzipped(io.RawIOBase):
    """A gzip file of any number of members, unpacked as it is read. With broken, a list, a member that can't be unpacked
    is no error: its place joins the list, a line end takes the place of its rest, and reading goes on at the next one."""

    def __init__(self, data: memoryview, broken: list[int] | None = None):
        self.data, self.at, self.unzip, self.ready, self.broken = data, 0, zlib.decompressobj(31), b"", broken
        self.start = 0

    def readable(self) -> bool:
        return True

    def readinto(self, out) -> int:
        while not self.ready:
            if self.unzip.eof:
                self.at -= len(self.unzip.unused_data)
                self.unzip, self.start = zlib.decompressobj(31), self.at
            more = bytes(self.unzip.unconsumed_tail) or bytes(self.data[self.at : self.at + 65536])
            if not self.unzip.unconsumed_tail:
                self.at += len(more)
            if not more:
                return 0
            try:
                self.ready = self.unzip.decompress(more, 1 << 20)
            except zlib.error:
                if self.broken is None:
                    raise
                self.broken.append(self.start)
                following = _MEMBER.search(self.data, self.start + 1)
                self.start = self.at = following.start() if following else len(self.data)
                self.unzip, self.ready = zlib.decompressobj(31), b"\n"
        n = min(len(out), len(self.ready))
        out[:n], self.ready = self.ready[:n], self.ready[n:]
        return n


def _page_url(url: str | None, page: int | None) -> str:
    return url or f"urn:page:{page}"


def _convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    stamp = CRAWLED.strftime("%Y%m%d%H%M%S")
    for batch in sliced(batches):
        out = []
        for page, url, html, refers, refers_url in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "refers_to", "refers_url")), strict=True):
            payload = (html or "").encode()
            response = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload) + payload
            version = 1 + (page or 0) % 2
            arc = arc_file(version, "pages.arc", [(_page_url(url, page), "0.0.0.0", CRAWLED, "text/html", response)])  # noqa: S104
            _, (fields, body) = arc_records(arc)
            extra = ({} if page is None else {"X-Page-ID": str(page)}) | {"X-Payload-Length": str(len(payload))}
            to = None
            if refers is not None:
                extra["X-Refers-To-Page-ID"] = str(refers)
                to = record_id(arc_url(_page_url(refers_url, refers)), stamp, digest(payload), refers)
            out.append(gzip.compress(to_warc(fields, body, extra, to, "revisit" if to else "response", "" if page is None else page), 6, mtime=0))
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])


def _put(members: DataFrame, path: str, file_records: int) -> None:
    """Gzip members (value) as files, an empty member after each."""
    out = members.select(F.col("value").cast("string")).write.option("encoding", "ISO-8859-1").option("lineSep", _NOTHING.decode("latin-1"))
    out.option("maxRecordsPerFile", file_records).text(path)


def write_warc(pages: DataFrame, path: str, least_bytes: int = 0, file_records: int = FILE_RECORDS) -> None:
    """pages (page_id, url, html) as WARC files in the folder path, each record gzipped."""
    pages = pages.select(F.col("page_id").cast("long"), "url", "html")
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    seen = Observation()
    known = pages.observe(seen, F.max(F.length(payload)).alias("longest")).where(F.length(payload) >= least_bytes).select("page_id", "url", F.sha1(payload).alias("sha"))
    counted = known.groupBy("sha").agg(F.max("page_id").alias("refers_to"), F.max_by("url", F.struct("page_id", "url")).alias("refers_url"), F.count("page_id").alias("n")).where("n > 1")
    shared = written(counted.select("sha", "refers_to", "refers_url"), "shared-payloads")
    # revisits only: a page that shares its payload and isn't the one referred to; shared is written, so that a payload
    # that very many pages have can be split in the join
    keyed = pages.withColumn("sha", F.sha1(payload)).join(shared, "sha", "left")
    other = F.col("page_id") != F.col("refers_to")
    rows = keyed.select("page_id", "url", "html", F.when(other, F.col("refers_to")).alias("refers_to"), F.when(other, F.col("refers_url")).alias("refers_url"))
    longest = seen.get["longest"] or 0
    _put(rows.mapInArrow(_convert, "value binary"), path, max(1, min(file_records, FILE_BYTES // (longest + 1))))


_ARC = "file string, url string, ip string, archive_date string, content_type string, record_type string, payload_bytes long, payload_digest string, body binary, offset long, problem string"


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    """A row for each record of the ARC files at path, gzipped or not, their version blocks (record_type warcinfo) too. A
    record that can't be read has a problem and no record_type, payload or body; offset is the record's in the unpacked
    file. A file is read in one task, record by record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(n, {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[t]) for n, t in (x.split() for x in _ARC.split(", "))])
        for batch in batches:
            for file, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                for at, f, body, problem in arc_scan(memoryview(content.as_buffer())):
                    said = [_shown(f[k]) for k in ("URL", "IP-address", "Archive-date", "Content-type")] if f else [None] * 4
                    if problem:
                        row = (file, *said, None, None, None, None, at, problem)
                    else:
                        payload = payload_of(body)[1] if (kind := kind_of(f)) == "response" else body
                        row = (file, *said, kind, len(payload), digest(payload), body, at, None)
                    yield pa.RecordBatch.from_pylist([dict(zip(schema.names, row, strict=True))], schema)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, _ARC)


def _shown(field: str) -> str:
    """Bytes of a URL line that aren't UTF-8 are percent-coded, as WARC and Spark take UTF-8 only."""
    return re.sub("[\udc80-\udcff]", lambda m: f"%{ord(m[0]) - 0xDC00:02X}", field)


def convert_arc(spark: SparkSession, arc_path: str, path: str, file_records: int = FILE_RECORDS) -> None:
    """The ARC files at arc_path as WARC files in the folder path, each record gzipped. Records with a problem are left
    out; read_arc() has them with their places. White space in a URL is percent-coded."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 64):
            out = []
            for r in batch.to_pylist():
                fields = {"URL": arc_url(r["url"]), "IP-address": r["ip"], "Archive-date": r["archive_date"], "Content-type": r["content_type"]}
                out.append(gzip.compress(to_warc(fields, r["body"]), 6, mtime=0))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    _put(read_arc(spark, arc_path).where("problem is null").mapInArrow(run, "value binary"), path, file_records)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.int64(), "url": pa.string(), "record_id": pa.string(), "date": pa.string(), "refers_to_record": pa.string()}
    for batch in batches:
        for content in batch.column(0):
            rows = []
            for fields, block in warc_records(io.BufferedReader(Unzipped(memoryview(content.as_buffer())), 1 << 16)):
                if fields["warc-block-digest"] != f"sha1:{digest(block)}":
                    raise ValueError(f"block of {fields['warc-record-id']} doesn't fit its digest")
                number = lambda k, f=fields: int(f[k]) if k in f else None
                kind = fields["warc-type"]
                if kind == "revisit":
                    size, sha = number("x-payload-length"), fields["warc-payload-digest"].removeprefix("sha1:")
                else:
                    payload = payload_of(block)[1] if kind == "response" else block
                    size, sha = len(payload), digest(payload)
                rows.append((number("x-page-id"), size, sha, kind, number("x-refers-to-page-id"), fields.get("warc-target-uri"), fields["warc-record-id"], fields["warc-date"], fields.get("warc-refers-to")))
            cols = list(zip(*rows, strict=True)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds.values(), strict=True)], names=list(kinds))


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """A row for each record of the gzipped WARC files, digests checked; length and digest are of the full payload."""
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(_read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, record_id string, date string, refers_to_record string")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), path)
    return read_warc(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
