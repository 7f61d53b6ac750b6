"""ARC archives (versions 1 and 2) and their conversion to WARC.

Archives are folders of files in the shared folder, one member compressed by itself per record, as crawlers
write them. `write_arc` makes ARC files of pages. `read_arc` parses a record's header line by the
fields that the file's own version line declares, and takes the content by its declared length. `to_warc`
gives each record what WARC asks for and ARC lacks: an identifier (a name-based UUID of the record's place and
digest), a date in its format, a type, block and payload digests. Of records with equal payloads of at
least `least_bytes` bytes the one with the largest page id is the response and the others are revisits that
refer to it. Digests meet in Spark; the content itself is read from the ARC file by the task that writes
the WARC file, and never shuffled. `read_warc` parses the result.

Defined results: null html has an empty payload; null ids sort lowest, and among equal ids the record
written last is the response; a record that repeats another is a revisit of it; an empty table
makes no files and no rows. A null or blank url is written as `urn:unknown`; white space in urls is
escaped. Other columns are never looked at.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crownframe.llm.shared import WAVES, Output, dealt, fresh_folder, open_input, ship, whole_text
from crownframe.session import cut

#: The field names of the two ARC versions, as their version lines declare them.
FIELDS = {1: "URL IP-address Archive-date Content-type Archive-length",
          2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"}
#: A file is closed beyond this many bytes; content is read in pieces of this size.
FILE_BYTES, PIECE = 256 << 20, 1 << 20
#: Compressed bytes of ARC records that a task converts, about.
TASK_BYTES = 8 << 20
PAGE_HEADER = "X-Page-Id"
DATE = "20240101000000"


def _packed(data: bytes) -> bytes:
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


class Members:
    """The members of a compressed archive, one by one, with the place of each."""

    def __init__(self, stream):
        self.stream, self.at, self.data = stream, 0, b""

    def _more(self) -> bool:
        piece = self.stream.read(PIECE)
        self.data += piece
        return bool(piece)

    def __iter__(self) -> Iterator[tuple[int, int, bytes]]:
        while self.data or self._more():
            z, out, used = zlib.decompressobj(31), [], 0
            while not z.eof:
                if not self.data and not self._more():
                    raise OSError("an archive ends within a record")
                out.append(z.decompress(self.data))
                used += len(self.data) - len(z.unused_data)
                self.data = z.unused_data
            yield self.at, used, b"".join(out)
            self.at += used


def _http(payload: bytes, page_id) -> bytes:
    own = f"{PAGE_HEADER}: {page_id}\r\n" if page_id is not None else ""
    return (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{own}"
            f"Content-Length: {len(payload)}\r\n\r\n").encode() + payload


def _split_http(block: bytes) -> tuple[dict[str, str], bytes]:
    head, _, payload = block.partition(b"\r\n\r\n")
    lines = head.decode("latin-1").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}, payload


def version_block(version: int, name: str) -> bytes:
    """The first record of an ARC file, with the version line and the fields."""
    body = f"{version} 0 crownframe\n{FIELDS[version]}\n".encode()
    fields = {"URL": f"filedesc://{name}", "IP-address": "0.0.0.0", "Archive-date": DATE,
              "Content-type": "text/plain", "Archive-length": len(body), "Result-code": 200}
    return arc_record(version, fields, body)


def arc_record(version: int, fields: dict, content: bytes) -> bytes:
    line = " ".join(str(fields.get(f, "-")) for f in FIELDS[version].split())
    return line.encode() + b"\n" + content + b"\n"


def write_arc(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
              file_bytes: int = FILE_BYTES) -> tuple[str, DataFrame]:
    """ARC files of the pages, by turns in either version; the folder and the names of the files."""
    spark = pages.sparkSession
    ship(spark)
    root = fresh_folder(spark, "arc")
    rows = pages.select(F.col(f"`{id_col}`").alias("page_id"), whole_text(f"`{url_col}`").alias("url"),
                        whole_text(f"`{html_col}`").alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, roll, out, names = TaskContext.get().partitionId(), 0, None, []
        for b in batches:
            for page_id, url, markup in zip(*(c.to_pylist() for c in b.columns)):
                if out is not None and out.size >= file_bytes:
                    out.close()
                    out, roll = None, roll + 1
                version = 1 + (part + roll) % 2
                if out is None:
                    names.append(f"pages-{part:06d}-{roll:04d}.arc.gz")
                    out = Output(root, names[-1])
                    out.write(_packed(version_block(version, names[-1])))
                block = _http(markup.encode("utf-8", "surrogatepass"), page_id)
                fields = {"URL": quote(url.strip(), safe="/:?#[]@!$&'()*+,;=%~") or "urn:unknown", "IP-address": "0.0.0.0",
                          "Archive-date": DATE, "Content-type": "text/html", "Archive-length": len(block),
                          "Result-code": 200, "Filename": names[-1], "Offset": out.size}
                out.write(_packed(arc_record(version, fields, block)))
        if out is not None:
            out.close()
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string())], names=["file"])

    return root, cut(rows.mapInArrow(run, "file string"), "arc-files")


def parse_arc(stream) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """Place, size, header fields and content of each record but the version block."""
    names: list[str] = []
    for at, size, data in Members(stream):
        line, _, rest = data.partition(b"\n")
        values = line.decode("utf-8", "surrogateescape").split(" ")
        length = int(values[-1])
        content = rest[:length]
        if len(content) < length:
            raise OSError(f"the record at {at} is shorter than it declares")
        if not names:                               # the version block declares the fields of the others
            names = content.decode().split("\n")[1].split(" ")
            continue
        if len(values) != len(names):
            raise OSError(f"the record at {at} has {len(values)} fields, its version {len(names)}")
        yield at, size, dict(zip(names, values)), content


def arc_entries(root: str, files: DataFrame, id_type: str = "bigint") -> DataFrame:
    """What the records hold, without the content: file, at, size, page_id, bytes, sha1, sha256."""
    ship(files.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file in b.column(0).to_pylist():
                rows = []
                with open_input(root, file) as f:
                    for at, size, _, content in parse_arc(f):
                        head, payload = _split_http(content)
                        own = head.get(PAGE_HEADER.lower())
                        rows.append((file, at, size, own, len(payload),
                                     hashlib.sha1(payload).hexdigest(), hashlib.sha256(payload).hexdigest()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.int64(), pa.string(),
                                                                  pa.int64(), pa.string(), pa.string()))],
                    names=["file", "at", "size", "page_id", "bytes", "sha1", "sha256"])

    spread = dealt(files)
    return spread.mapInArrow(run, "file string, at long, size long, page_id string, bytes long, sha1 string, "
                                  "sha256 string").withColumn("page_id", F.col("page_id").cast(id_type))


def with_types(entries: DataFrame, least_bytes: int = 1000) -> DataFrame:
    """With the page id, file and place of the response that a record revisits, null for responses."""
    place = F.struct("page_id", "file", "at")
    large = entries.filter(F.col("bytes") >= least_bytes)
    groups = large.groupBy("sha1", "sha256", "bytes").agg(F.max(place).alias("first"), F.count(F.lit(1)).alias("n"))
    shared = groups.filter("n > 1").drop("n")
    typed = entries.join(shared, ["sha1", "sha256", "bytes"], "left")
    other = (F.col("first.file") != F.col("file")) | (F.col("first.at") != F.col("at"))
    return typed.select(*entries.columns, F.when(other, F.col("first")).alias("first"))


def _record_id(file: str, at: int, sha1: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{file}#{at}#{sha1}')}>"


def _base32(digest: bytes) -> str:
    return "sha1:" + base64.b32encode(digest).decode()


def _warc_date(date: str) -> str:
    return f"{date[:4]}-{date[4:6]}-{date[6:8]}T{date[8:10]}:{date[10:12]}:{date[12:14]}Z"


def warc_record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = ["WARC/1.0", *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode("utf-8", "surrogateescape") + b"\r\n\r\n" + block + b"\r\n\r\n"


def to_warc(root: str, typed: DataFrame, file_bytes: int = FILE_BYTES) -> tuple[str, DataFrame]:
    """WARC files of typed ARC entries, an ARC file's records in their order; folder and names."""
    spark = typed.sparkSession
    ship(spark)
    target = fresh_folder(spark, "warc")
    rows = typed.select("file", "at", "size", "sha1", F.col("first.file").alias("of_file"),
                        F.col("first.at").alias("of_at"), F.col("first.page_id").cast("string").alias("of_page"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, out, source, last, fields, roll = [], None, None, None, [], 0
        part = TaskContext.get().partitionId()
        for b in batches:
            for file, at, size, sha1, of_file, of_at, of_page in zip(*(c.to_pylist() for c in b.columns)):
                if file != last:
                    if source is not None:
                        source.close()
                    source, last = open_input(root, file), file
                    fields = _fields_of(source)
                if out is None or out.size >= file_bytes:
                    if out is not None:
                        out.close()
                        roll += 1
                    names.append(f"pages-{part:06d}-{roll:04d}.warc.gz")
                    out = Output(target, names[-1])
                    info = f"software: crownframe\r\nformat: WARC File Format 1.0\r\nisPartOf: {names[-1]}\r\n".encode()
                    out.write(_packed(warc_record(
                        [("WARC-Type", "warcinfo"), ("WARC-Record-ID", _record_id(names[-1], 0, "")),
                         ("WARC-Date", _warc_date(DATE)), ("WARC-Filename", names[-1]),
                         ("Content-Type", "application/warc-fields")], info)))
                source.seek(at)
                line, _, rest = zlib.decompress(source.read(size), 31).partition(b"\n")
                values = dict(zip(fields, line.decode("utf-8", "surrogateescape").split(" ")))
                block = rest[:int(values["Archive-length"])]
                payload = _split_http(block)[1]
                headers = [("WARC-Type", "revisit" if of_file else "response"),
                           ("WARC-Record-ID", _record_id(file, at, sha1)),
                           ("WARC-Target-URI", values["URL"]), ("WARC-Date", _warc_date(values["Archive-date"])),
                           ("WARC-IP-Address", values["IP-address"]),
                           ("WARC-Payload-Digest", _base32(hashlib.sha1(payload).digest())),
                           ("Content-Type", "application/http; msgtype=response")]
                if of_file:
                    block = block[:len(block) - len(payload)]        # a revisit has the HTTP header only
                    headers += [("WARC-Profile", "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"),
                                ("WARC-Refers-To", _record_id(of_file, of_at, sha1))]
                    headers += [("WARC-Refers-To-Page", of_page)] if of_page is not None else []
                headers.append(("WARC-Block-Digest", _base32(hashlib.sha1(block).digest())))
                out.write(_packed(warc_record(headers, block)))
        if source is not None:
            source.close()
        if out is not None:
            out.close()
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string())], names=["file"])

    total = typed.agg(F.sum("size")).first()[0] or 0
    tasks = max(1, min(-(-total // TASK_BYTES), WAVES * spark.sparkContext.defaultParallelism))
    near = rows.repartitionByRange(tasks, "file", "at").sortWithinPartitions("file", "at")
    return target, cut(near.mapInArrow(run, "file string"), "warc-files")


def _fields_of(source) -> list[str]:
    """The field names that an ARC file's version block declares."""
    for _, _, data in Members(source):
        return data.split(b"\n")[2].decode().split(" ")
    raise OSError("an ARC file without a version block")


def parse_warc(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record."""
    for at, _, data in Members(stream):
        head, _, rest = data.partition(b"\r\n\r\n")
        version, *lines = head.decode("utf-8", "surrogateescape").split("\r\n")
        headers = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        length = int(headers["content-length"])
        if not version.startswith("WARC/") or len(rest) < length:
            raise OSError(f"not a whole WARC record at {at}")
        yield headers, rest[:length]


def read_warc(root: str, files: DataFrame, id_type: str = "bigint") -> DataFrame:
    """Per response or revisit: record_id, page_id, url, date, payload_bytes, payload_digest (hex SHA-1),
    record_type, refers_to (page id of the response)."""
    ship(files.sparkSession)
    columns = ["record_id", "page_id", "url", "date", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    kinds = [pa.int64() if c == "payload_bytes" else pa.string() for c in columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file in b.column(0).to_pylist():
                rows = []
                with open_input(root, file) as f:
                    for h, block in parse_warc(f):
                        if h["warc-type"] not in ("response", "revisit"):
                            continue
                        if _base32(hashlib.sha1(block).digest()) != h["warc-block-digest"]:
                            raise OSError(f"{h['warc-record-id']} doesn't match its block digest")
                        head, payload = _split_http(block)
                        digest = base64.b32decode(h["warc-payload-digest"].removeprefix("sha1:")).hex()
                        if h["warc-type"] == "response" and hashlib.sha1(payload).hexdigest() != digest:
                            raise OSError(f"{h['warc-record-id']} doesn't match its payload digest")
                        rows.append((h["warc-record-id"], head.get(PAGE_HEADER.lower()), h["warc-target-uri"], h["warc-date"],
                                     int(head["content-length"]), digest, h["warc-type"], h.get("warc-refers-to-page")))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [()] * len(columns), kinds)], names=columns)

    spread = dealt(files)
    found = spread.mapInArrow(run, ", ".join(f"{c} {'long' if c == 'payload_bytes' else 'string'}" for c in columns))
    return found.withColumns({c: F.col(c).cast(id_type) for c in ("page_id", "refers_to")})


def convert(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            least_bytes: int = 1000) -> DataFrame:
    """Pages to ARC files, these to WARC files, and what is read back from them."""
    id_type = pages.schema[id_col].dataType.simpleString()
    arc, arc_files = write_arc(pages, id_col, url_col, html_col)
    entries = cut(arc_entries(arc, arc_files, id_type), "arc-entries")
    warc, warc_files = to_warc(arc, with_types(entries, least_bytes))
    return read_warc(warc, warc_files, id_type)
