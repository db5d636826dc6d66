"""Legacy web archives to WARC.

ARC files (versions 1 and 2) are read by their version blocks, header lines and declared lengths, and written
again as WARC/1.1 with identifiers, dates, types and digests made from what the old headers say. Of records with
equal payloads the first stays a response and the others become revisits of it. Spark's text writer puts the files
down, with the separator of the format as line separator, so files are committed like any other table.

Defined results: a null payload is an empty one; records of equal key and payload count in file order; a null key
comes before all others; white space in an address becomes %20 and a null address is "about:blank"; bytes of a header
that aren't UTF-8 become U+FFFD; an archive without records yields none. A header line that doesn't fit its version, or a record that ends early, is an error,
never a lost record.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterator
from urllib.parse import urlparse

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed values of the formats: the fields of a header line by ARC version, the last being the length.
ARC_FIELDS = {
    1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    2: ["URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset",
        "Filename", "Archive-length"],
}
NO_DATE = "19700101000000"
CRLF = "\r\n"
BATCH_BYTES = 8 << 20


def _gzip_text(df: DataFrame, folder: str, separator: str) -> None:
    writer = df.write.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
    writer.option("lineSep", separator).text(folder)


def _address(url: str) -> Column:
    return F.regexp_replace(F.coalesce(F.col(url), F.lit("about:blank")), r"\s", "%20")


def write_arc(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html") -> None:
    """ARC files of pages: an HTTP response each, its key in the header X-Page-Id. Files of odd partitions are of
    version 2, the others of version 1; a narrow pass."""
    body = F.coalesce(F.col(payload), F.lit(""))
    head = ["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8"]
    block = F.concat(
        F.lit(CRLF.join(head) + CRLF + "X-Page-Id: "), F.coalesce(F.col(key).cast("string"), F.lit("")),
        F.lit(CRLF + "Content-Length: "), F.octet_length(body).cast("string"), F.lit(CRLF * 2), body,
    )
    common = [_address(url), F.lit("0.0.0.0"), F.lit("20240101000000"), F.lit("text/html")]
    second = [F.lit("200"), F.lit("-"), F.lit("-"), F.lit("0"), F.lit("pages.arc")]
    size = F.octet_length("block").cast("string")
    version = F.pmod(F.spark_partition_id(), F.lit(2)) + 1
    line = F.when(version == 2, F.concat_ws(" ", *common, *second, size)).otherwise(F.concat_ws(" ", *common, size))

    def opening(v: int) -> str:
        about = f"{v} 0 archive\n{' '.join(ARC_FIELDS[v])}\n"
        middle = ["200", "-", "-", "0", "pages.arc"] if v == 2 else []
        return " ".join(["filedesc://pages.arc", "0.0.0.0", "20240101000000", "text/plain", *middle, str(len(about))]) + "\n" + about + "\n"

    first = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0
    start = F.when(first & (version == 2), F.lit(opening(2))).when(first, F.lit(opening(1))).otherwise(F.lit(""))
    rows = pages.withColumn("block", block).select(F.concat(start, line, F.lit("\n"), "block").alias("value"))
    _gzip_text(rows, folder, "\n")


def _opened(content: bytes) -> io.BufferedIOBase:
    return gzip.GzipFile(fileobj=io.BytesIO(content)) if content[:2] == b"\x1f\x8b" else io.BytesIO(content)


def _exactly(stream: io.BufferedIOBase, size: int) -> bytes:
    data = stream.read(size)
    if len(data) != size:
        raise ValueError(f"a record of {size} bytes ends after {len(data)}")
    return data


def arc_records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of each record of an ARC file, in order; version blocks are taken in, not given out."""
    stream, version = _opened(content), 1
    while line := stream.readline():
        if not line.strip():
            continue
        values = line.decode("utf-8", "replace").rstrip("\r\n").split(" ")
        if line.startswith(b"filedesc:"):
            about = _exactly(stream, int(values[-1]))
            version = int(about.split(None, 1)[0])
            continue
        names = ARC_FIELDS[version]
        if len(values) < len(names):
            raise ValueError(f"not an ARC version {version} header: {line[:200]!r}")
        # an address with blanks in it takes the fields that are too many
        extra = len(values) - len(names)
        values = ["%20".join(values[: extra + 1]), *values[extra + 1 :]]
        fields = dict(zip(names, values, strict=True))
        yield fields, _exactly(stream, int(fields["Archive-length"]))


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def split_http(block: bytes) -> tuple[bytes, bytes]:
    """(head with its blank line, payload) of an HTTP response; without a head all is payload."""
    end = block.find(b"\r\n\r\n")
    return (block[: end + 4], block[end + 4 :]) if block.startswith(b"HTTP/") and end >= 0 else (b"", block)


def warc_date(arc_date: str) -> str:
    """14 digits (or fewer: the rest is the earliest possible) as an ISO time."""
    d = (arc_date + NO_DATE[len(arc_date) :])[:14]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def _batches(rows: Iterator[dict], schema: pa.Schema, weight: str) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 500 + len(row.get(weight) or b"")
        if size >= BATCH_BYTES:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


_PARSED = {"file": "string", "number": "long", "record_id": "string", "date": "string", "uri": "string", "ip": "string",
           "mime": "string", "head": "string", "payload_bytes": "long", "payload_digest": "string"}


def _schema(columns: dict[str, str]) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in columns.items()])


def _ddl(columns: dict[str, str]) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in columns.items())


#: What Spark puts into the name of a file to tell one write from another.
_WRITE_ID = re.compile(r"-[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}(?=-c[0-9]+\.)")


def archive_name(path: str, folder: str) -> str:
    """A file by its place below the folder that was read, whatever lies above; without the id of the write, if
    Spark wrote it. The same archive in another folder, or written again, has the same names."""
    root = urlparse(folder).path.rstrip("/") + "/"
    _, found, below = path.partition(root)
    return _WRITE_ID.sub("", below if found else path.rpartition("/")[2])


def read_arc(spark: SparkSession, folder: str, blocks: bool = True) -> DataFrame:
    """A row per ARC record with what WARC wants to know of it; ``blocks`` adds the block and its digest. A record's id
    follows from its archive (see :func:`archive_name`), its number there, its address, date and payload."""
    columns = _PARSED | ({"block_digest": "string", "block": "binary"} if blocks else {})
    schema = _schema(columns)

    def parsed(files: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in files:
            for file, content in zip(*batch.columns, strict=True):
                archive = archive_name(str(file), folder)
                for number, (fields, block) in enumerate(arc_records(content.as_py())):
                    head, payload = split_http(block)
                    digest = base32_sha1(payload)
                    name = f"{archive}#{number} {fields['URL']} {fields['Archive-date']} {digest}"
                    row = {
                        "file": str(file), "number": number, "uri": fields["URL"], "ip": fields["IP-address"],
                        "record_id": f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(name.encode()).digest())}>",
                        "date": warc_date(fields["Archive-date"]), "mime": fields["Content-type"],
                        "head": head.decode("latin-1"), "payload_bytes": len(payload), "payload_digest": digest,
                    }
                    if blocks:
                        row |= {"block": block, "block_digest": base32_sha1(block)}
                    yield row

    files = spark.read.format("binaryFile").load(folder).select("path", "content")
    return files.mapInArrow(lambda batches: _batches(parsed(batches), schema, "block"), _ddl(columns))


def page_key(head: str = "head") -> Column:
    """Key that write_arc put into the HTTP head; null where there is none."""
    return F.expr(f"try_cast(regexp_extract({head}, 'X-Page-Id: (-?[0-9]+)', 1) AS long)")


def revisits(parsed: DataFrame, least: int = 0) -> DataFrame:
    """(file, number, refers_to) of records whose payload, of at least ``least`` bytes, an earlier key has too.

    The first of each digest is found by a map-side minimum; only these narrow rows are joined by digest.
    """
    rows = parsed.filter(F.col("payload_bytes") >= least)
    rows = rows.select("file", "number", "record_id", "payload_digest", page_key().alias("page"))
    first = F.min(F.struct("page", "file", "number", "record_id"))
    firsts = rows.groupBy("payload_digest").agg(first.alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    firsts = firsts.select("payload_digest", F.col("first.record_id").alias("refers_to"))
    same = rows.join(firsts, "payload_digest").filter("record_id <> refers_to")
    return same.select("file", "number", "refers_to")


def convert(spark: SparkSession, arc: str, warc: str, least: int = 0) -> None:
    """ARC files below ``arc`` to WARC files below ``warc``. Revisits keep the HTTP head only."""
    known = revisits(read_arc(spark, arc, blocks=False), least)
    rows = read_arc(spark, arc).join(known, ["file", "number"], "left")
    again = F.col("refers_to").isNotNull()
    http = F.col("head") != ""
    head = F.encode("head", "ISO-8859-1")
    block = F.when(again, head).otherwise(F.col("block"))
    mime = F.when(http, F.lit("application/http; msgtype=response")).otherwise(F.col("mime"))
    kind = F.when(again, F.lit("revisit")).when(http, F.lit("response")).otherwise(F.lit("resource"))
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), kind),
        F.concat(F.lit("WARC-Record-ID: "), "record_id"),
        F.concat(F.lit("WARC-Date: "), "date"),
        F.concat(F.lit("WARC-Target-URI: "), "uri"),
        F.concat(F.lit("WARC-IP-Address: "), "ip"),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), "payload_digest"),
        F.when(~again, F.concat(F.lit("WARC-Block-Digest: sha1:"), "block_digest")),
        F.when(again, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        F.concat(F.lit("WARC-Refers-To: "), "refers_to"),
        F.concat(F.lit("Content-Type: "), mime),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    ]
    record = F.concat(F.concat_ws(CRLF, *lines), F.lit(CRLF * 2), block.cast("string"))
    _gzip_text(rows.select(record.alias("value")), warc, CRLF * 2)


def warc_records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(named fields, block) of each record of a WARC file, in order."""
    stream = _opened(content)
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:200]!r}")
        fields = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields[name.strip().lower()] = value.strip()
        yield fields, _exactly(stream, int(fields["content-length"]))


_RECORD = {"record_id": "string", "record_type": "string", "uri": "string", "date": "string", "head": "string",
           "payload_bytes": "long", "payload_digest": "string", "refers_to": "string"}


def read_warc(spark: SparkSession, folder: str, payloads: bool = False) -> DataFrame:
    """A row per WARC record. A response's size and digest are those of the payload read; a revisit's are what its
    HTTP head and its header say of the payload it stands for."""
    columns = _RECORD | ({"payload": "binary"} if payloads else {})
    schema = _schema(columns)

    def parsed(files: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in files:
            for content in batch.column(0):
                for fields, block in warc_records(content.as_py()):
                    http = fields["content-type"].startswith("application/http")
                    head, payload = split_http(block) if http else (b"", block)
                    size, digest = len(payload), base32_sha1(payload)
                    if fields["warc-type"] == "revisit":
                        sizes = [v for k, _, v in (x.partition(b":") for x in head.split(b"\r\n")) if k.lower() == b"content-length"]
                        size = int(sizes[0]) if sizes else None
                        digest = fields["warc-payload-digest"].removeprefix("sha1:")
                    row = {
                        "record_id": fields["warc-record-id"], "record_type": fields["warc-type"],
                        "uri": fields.get("warc-target-uri"), "date": fields["warc-date"], "head": head.decode("latin-1"),
                        "payload_bytes": size, "payload_digest": digest, "refers_to": fields.get("warc-refers-to"),
                    }
                    yield row | ({"payload": payload} if payloads else {})

    files = spark.read.format("binaryFile").load(folder).select("content")
    return files.mapInArrow(lambda batches: _batches(parsed(batches), schema, "payload"), _ddl(columns))
