"""Legacy ARC archives: packing, parsing, and conversion to WARC records."""

from __future__ import annotations

import gzip
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm.common import batch, shared_folder

#: The header fields of both versions of the ARC format.
FIELDS = {
    "1": "URL IP-address Archive-date Content-type Archive-length",
    "2": "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
#: Fixed value: the profile of a revisit that found an equal payload.
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Payloads below this size are stored whole each time.
LEAST_PAYLOAD = 100
#: Characters of pages in one packed archive, and records in one written file.
ARCHIVE_CHARS, FILE_RECORDS = 4_000_000, 2_000
#: Crawl time and address of pages that carry none.
DATE, ADDRESS = "20240101000000", "0.0.0.0"
END = b"\r\n\r\n"
#: Fixed value: the first bytes of a gzip member.
GZIP = b"\x1f\x8b"


# ------------------------------------------------------------------------- ARC


def arc_bytes(name: str, records, version: str = "2") -> bytes:
    """An ARC file of ``(url, content)`` records after its version block."""
    out = io.BytesIO()

    def header(url: str, kind: str, size: int) -> str:
        values = {"URL": url, "IP-address": ADDRESS, "Archive-date": DATE, "Content-type": kind, "Result-code": "200",
                  "Checksum": "-", "Location": "-", "Offset": str(out.tell()), "Filename": name,
                  "Archive-length": str(size)}
        return " ".join(values[f] for f in FIELDS[version].split())

    block = f"{version} 0 clickloom\n{FIELDS[version]}\n".encode()
    out.write(f"{header(f'filedesc://{name}', 'text/plain', len(block))}\n".encode() + block + b"\n")
    for url, content in records:
        safe = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) or "-"
        out.write(f"{header(safe, 'text/html', len(content))}\n".encode())
        out.write(content)
        out.write(b"\n")
    return out.getvalue()


def arc_records(data: bytes) -> Iterator[tuple[dict[str, str], int, bytes]]:
    """(header fields, offset, content) of the records after the version block.

    The first record describes the file: its content names the version and the
    fields of every header line. A header line is cut from the right, so a URL
    may hold spaces; the content is as long as the header declares, of any
    bytes. A gzipped file, whole or record by record, is inflated first and
    offsets are those of the inflated file. Bytes of a header line that are not
    UTF-8 are written as ``%XX``.
    """
    if data[:2] == GZIP:
        data = gzip.decompress(data)

    def line(at: int) -> tuple[str, int]:
        end = data.index(b"\n", at)
        text = data[at:end].rstrip(b"\r").decode("utf-8", "surrogateescape")
        return re.sub("[\udc80-\udcff]", lambda m: f"%{ord(m[0]) - 0xDC00:02X}", text), end + 1

    first, at = line(0)
    if not first.startswith("filedesc://"):
        raise ValueError("an ARC file begins with its description")
    size = int(first.rsplit(" ", 1)[1])
    described = data[at : at + size].decode("utf-8", "replace").splitlines()
    version = described[0].split()[0]
    names = (described[1] if len(described) > 1 and described[1] else FIELDS[version]).split()
    at += size
    while at < len(data):
        if data[at : at + 1] in b"\r\n":
            at += 1
            continue
        offset = at
        text, at = line(at)
        fields = dict(zip(names, text.rsplit(" ", len(names) - 1), strict=True))
        size = int(fields["Archive-length"])
        if at + size > len(data):
            raise ValueError(f"a record at {offset} declares more bytes than the file has")
        yield fields, offset, data[at : at + size]
        at += size


def pack_pages(pages: DataFrame, version: str = "2") -> DataFrame:
    """``archive, content``: ``pages(page_id, url, html)`` as ARC files of a few megabytes.

    The content of a record is an HTTP response whose body is the html in UTF-8
    (NULL: empty); its head holds the page's id, empty if NULL.
    """
    schema = pa.schema([("archive", pa.string()), ("content", pa.binary())])

    def run(batches):
        for got in batches:
            held, chars = [], 0
            for page, url, html in zip(*(c.to_pylist() for c in got.columns), strict=True):
                body = (html or "").encode()
                head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nX-Page-Id: {'' if page is None else page}\r\n\r\n"
                held.append((url or "", head.encode() + body))
                chars += len(body)
                if chars >= ARCHIVE_CHARS:
                    yield packed(held)
                    held, chars = [], 0
            if held:
                yield packed(held)

    def packed(held):
        name = hashlib.sha256(b"".join(hashlib.sha256(c).digest() for _, c in held)).hexdigest()[:24] + ".arc"
        return batch(schema, [name], [arc_bytes(name, held, version)])

    rows = pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), F.col("html").cast("string"))
    return rows.mapInArrow(run, "archive string, content binary")


# ------------------------------------------------------------------- conversion


def split_response(content: bytes) -> tuple[bytes, bytes]:
    """Head and payload of an HTTP response; content of another kind is all payload."""
    if content.startswith(b"HTTP/"):
        head, mark, body = content.partition(END)
        if mark:
            return head, body
    return b"", content


RECORD = (
    "record_id string, page_id bigint, uri string, date string, address string, kind string, payload_bytes bigint, "
    "payload_digest string"
)


def records(archives: DataFrame, payloads: bool) -> DataFrame:
    """What WARC needs of each record of ``archives(archive, content)``, with head and payload if asked for.

    Identifiers follow from archive name, offset and digest, dates from the
    14-digit archive date, digests from the payload; so a repeated run gives
    the same records.
    """
    fields = [("record_id", pa.string()), ("page_id", pa.int64()), ("uri", pa.string()), ("date", pa.string()),
              ("address", pa.string()), ("kind", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())]
    if payloads:
        fields += [("head", pa.binary()), ("payload", pa.binary())]
    schema = pa.schema(fields)

    def run(batches):
        for got in batches:
            for archive, content in zip(*(c.to_pylist() for c in got.columns), strict=True):
                rows = []
                for fields, offset, block in arc_records(content):
                    head, payload = split_response(block)
                    digest = hashlib.sha256(payload).hexdigest()
                    d = fields["Archive-date"].ljust(14, "0")
                    page = re.search(rb"X-Page-Id: (-?\d+)", head)
                    rows.append((
                        f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{archive}/{offset}/{digest}')}>",
                        int(page[1]) if page else None,
                        fields["URL"],
                        f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z",
                        fields["IP-address"],
                        "application/http; msgtype=response" if head else fields["Content-type"],
                        len(payload),
                        digest,
                        *((head, payload) if payloads else ()),
                    ))
                if rows:
                    yield batch(schema, *zip(*rows, strict=True))

    return archives.mapInArrow(run, RECORD + (", head binary, payload binary" if payloads else ""))


def converted(archives: DataFrame) -> DataFrame:
    """``record``: each ARC record of ``archives`` as the bytes of a WARC record without its closing lines.

    Of the records with equal payloads of ``LEAST_PAYLOAD`` bytes or more, the
    one with the smallest ``page_id`` is a response with head and payload; rows
    that repeat this page are responses, too. The others are revisits: they hold the
    head and refer to the response. A NULL ``page_id`` is larger than any other.
    Head and payload are kept as the bytes they are. ``archives`` is read twice
    and must give the same files again.
    """
    small = records(archives, payloads=False).where(F.col("payload_bytes") >= LEAST_PAYLOAD)
    order = F.struct(F.col("page_id").isNull().alias("n"), "page_id", "record_id", "uri", "date")
    firsts = small.groupBy(F.col("payload_digest").alias("digest")).agg(F.min(order).alias("first"), F.count("*").alias("n"))
    firsts = firsts.where("n > 1").select("digest", "first")
    rows = records(archives, payloads=True).join(firsts, F.col("payload_digest") == F.col("digest"), "left")
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first.page_id"))
    crlf = "\r\n"
    raw = lambda x: (F.lit(x) if isinstance(x, str) else x).cast("binary")
    head = F.when(F.octet_length("head") == 0, raw("")).otherwise(F.concat("head", raw(crlf * 2)))
    block = F.when(again, head).otherwise(F.concat(head, "payload"))
    refers = F.concat(
        F.lit("WARC-Refers-To: "), "first.record_id", F.lit(f"{crlf}WARC-Refers-To-Target-URI: "), "first.uri",
        F.lit(f"{crlf}WARC-Refers-To-Date: "), "first.date", F.lit(f"{crlf}WARC-Profile: {SAME_PAYLOAD}{crlf}"),
    )
    rows = rows.withColumn("_block", block)
    lines = [
        ("WARC-Record-ID", F.col("record_id")), ("WARC-Target-URI", F.col("uri")), ("WARC-Date", F.col("date")),
        ("WARC-IP-Address", F.col("address")), ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "payload_digest")),
        ("WARC-Block-Digest", F.concat(F.lit("sha256:"), F.sha2("_block", 256))), ("Content-Type", F.col("kind")),
        ("Content-Length", F.octet_length("_block").cast("string")),
    ]
    header = F.concat(
        F.lit(f"WARC/1.1{crlf}WARC-Type: "),
        F.when(again, "revisit").otherwise("response"),
        F.lit(crlf),
        F.when(again, refers).otherwise(""),
        *(x for name, value in lines for x in (F.lit(f"{name}: "), value, F.lit(crlf))),
        F.lit(crlf),
    )
    return rows.select(F.concat(raw(header), "_block").alias("record"))


def write_warc(rows: DataFrame, folder: str) -> None:
    """Write ``record`` rows as gzipped WARC files of at most ``FILE_RECORDS`` records each.

    Spark's text writer ends each record with two line ends, which is the
    format's own record end, and commits files by task, so a lost executor
    leaves no halves. A string holds any bytes, and the writer leaves them as
    they are.
    """
    writer = rows.select(F.col("record").cast("string")).write.option("lineSep", END.decode()).option("compression", "gzip")
    writer.option("maxRecordsPerFile", FILE_RECORDS).text(folder)


# --------------------------------------------------------------------- reading


def read_arc(spark: SparkSession, folder: str) -> DataFrame:
    """``archive, content`` of the ARC files in ``folder``, gzipped or not, for ``converted``."""
    files = spark.read.format("binaryFile").load(folder)
    return files.select(F.regexp_extract("path", "([^/]+)$", 1).alias("archive"), "content")


class Inflated:
    """A gzipped file in memory as a byte stream, inflated as it is read."""

    def __init__(self, data: bytes):
        self.rest, self.data = zlib.decompressobj(31), data
        self.held, self.at = bytearray(), 0

    def _more(self) -> bool:
        if self.rest.eof:  # the next member
            if not self.rest.unused_data:
                return False
            self.data, self.at, self.rest = self.rest.unused_data, 0, zlib.decompressobj(31)
        part = self.data[self.at : self.at + (1 << 16)]
        self.at += len(part)
        self.held += self.rest.decompress(part)
        return bool(part) or self.rest.eof

    def take(self, size: int) -> bytes:
        while len(self.held) < size and self._more():
            pass
        if len(self.held) < size:
            raise ValueError("a record declares more bytes than the file has")
        out = bytes(self.held[:size])
        del self.held[:size]
        return out

    def until(self, mark: bytes) -> bytes:
        """What comes before ``mark``, which is passed over; empty at the end of the file."""
        start = 0
        while (k := self.held.find(mark, start)) < 0:
            start = max(0, len(self.held) - len(mark))
            if not self._more():
                return b""
        return self.take(k + len(mark))[:k]


def warc_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of the records of a gzipped WARC file, by declared lengths."""
    stream = Inflated(data)
    while head := stream.until(END):
        first, *lines = head.decode("utf-8", "replace").split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"no WARC record: {first[:40]!r}")
        fields = dict(x.split(": ", 1) for x in lines)
        yield fields, stream.take(int(fields["Content-Length"]))
        if stream.take(len(END)) != END:
            raise ValueError("a record does not end where it should")


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """``page_id, record_id, record_type, payload_digest, payload_bytes, refers_to_id`` of the records in ``folder``.

    Block and payload digests are computed anew and must equal the declared
    ones. ``payload_bytes`` is NULL for revisits, which hold no payload.
    """
    schema = pa.schema(
        [("page_id", pa.int64()), ("record_id", pa.string()), ("record_type", pa.string()), ("payload_digest", pa.string()),
         ("payload_bytes", pa.int64()), ("refers_to_id", pa.string())]
    )

    def run(batches):
        for got in batches:
            for k in range(got.num_rows):
                rows = []
                for fields, block in warc_records(got.column(0)[k].as_py()):
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
                    head, payload = split_response(block)
                    whole = fields["WARC-Type"] == "response"
                    if hashlib.sha256(block).hexdigest() != fields["WARC-Block-Digest"].removeprefix("sha256:"):
                        raise ValueError(f"{fields['WARC-Record-ID']}: the block is damaged")
                    if whole and hashlib.sha256(payload).hexdigest() != digest:
                        raise ValueError(f"{fields['WARC-Record-ID']}: the payload is damaged")
                    page = re.search(rb"X-Page-Id: (-?\d+)", head)
                    rows.append((int(page[1]) if page else None, fields["WARC-Record-ID"], fields["WARC-Type"], digest,
                                 len(payload) if whole else None, fields.get("WARC-Refers-To")))
                if rows:
                    yield batch(schema, *zip(*rows, strict=True))

    files = spark.read.format("binaryFile").load(folder).select("content")
    return files.mapInArrow(
        run,
        "page_id bigint, record_id string, record_type string, payload_digest string, payload_bytes bigint, "
        "refers_to_id string",
    )


def archive_pages(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Pack ``pages(page_id, url, html)``, convert to WARC in ``folder``, and read that back.

    Returns ``page_id, payload_bytes, payload_digest, record_type, refers_to``
    for every row: digest and size of the full payload, and for a revisit the
    ``page_id`` of its response, found by the record it refers to. NULL html is
    an empty payload; a NULL or empty URL is written as ``-``; a NULL
    ``page_id`` stays NULL. Repeated rows give repeated records; rows that
    repeat a response's page are responses. Extra columns are not read; an
    empty table gives an empty result. ``folder`` is a new one in the shared
    checkpoint folder unless given. The pages are packed in two passes; if
    these give different files, as after a shuffle whose order changes, and a
    revisit finds no response, the query ends with an error.
    """
    spark = pages.sparkSession
    folder = folder or shared_folder(spark, "warc")
    write_warc(converted(pack_pages(pages)), folder)
    back = read_warc(spark, folder)
    own = back.where("record_type = 'response'")
    first = own.select(
        F.col("record_id").alias("response_id"), F.col("page_id").alias("response_page"), F.col("payload_bytes").alias("size")
    ).dropDuplicates(["response_id"])
    again = back.where("record_type = 'revisit'").join(first, F.col("refers_to_id") == F.col("response_id"), "left")
    lost = F.raise_error(F.concat(F.lit("no record "), "refers_to_id"))
    again = again.withColumn("size", F.when(F.col("response_id").isNull(), lost.cast("bigint")).otherwise(F.col("size")))
    none = F.lit(None).cast("bigint")
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return own.withColumn("refers_to", none).select(*columns).union(
        again.select("page_id", "size", "payload_digest", "record_type", "response_page")
    )
