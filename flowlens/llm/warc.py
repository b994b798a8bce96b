"""WARC archives: a writer through Spark's text sink and a salvage reader.

``write`` makes one record per row.  Rows with equal payloads of at least
``REVISIT_BYTES`` bytes share one response record (the largest id); the
others become revisit records that refer to it.  Equality is by SHA-1 and
length; the table of repeated payloads is aggregated from digests alone, so
a payload that a third of all rows share is pre-aggregated, and payloads are
shuffled only if that table is too large for Spark to broadcast.  Records
end in CRLF CRLF, which is the text sink's line separator, so the files are
plain WARC/1.1 committed by Spark's own protocol (a lost executor's files
are never seen).  Files hold about ``FILE_BYTES``.

``read`` takes each file as a whole and walks it with ``salvage``: a record
must have a version line, complete headers, a block of the stated length,
the closing CRLF CRLF and, where the payload is there, the stated digest.
After a failed check the reader searches for the next version line or gzip
member at which all checks hold, goes on from there and logs the bytes
between as a quarantined gap.  So a file may mix plain and compressed records,
its first member may be damaged, and a member may hold many records, some damaged;
of a member that is cut off or cannot be unzipped to its end, the records before the damage are kept.

Defined results: a null payload is empty; a null id is written as ``null`` and
read back as null; ids repeated within equal payloads: all rows of the
largest id are responses; control characters and blanks of a url are
percent-encoded; an empty table writes no record; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.llm.common import column, discard, ensure_checkpoint_dir, store

REVISIT_BYTES = 1000
FILE_BYTES = 16 << 20
CLASS_BITS = 3  # a class of records takes up to 8 times the bytes of the one below; the lowest ends at 4 KB
DATE = "2000-01-01T00:00:00Z"
CRLF = "\r\n"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# ------------------------------------------------------------------ write
def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    payload = F.coalesce(column(payload_col), F.lit(""))
    return pages.select(
        column(id_col).cast("long").alias("id"), column(url_col).alias("url"), payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("size"), F.sha1(payload.cast("binary")).alias("digest"))


def write(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
          revisit_bytes: int = REVISIT_BYTES) -> None:
    """Write the archive files of ``pages`` to the folder ``path``, in a folder for each class of record sizes.

    No file is over ``FILE_BYTES``, but for a single record that is.
    """
    # The most a record can take, and its class by that: a class's files hold as many records as fit at its upper end.
    heft = F.col("size") + 3 * F.octet_length(F.coalesce("url", F.lit(""))) + 700
    rows = records(pages, id_col, url_col, payload_col).withColumn("class", F.least(F.greatest(F.ceil(F.log2(heft) / CLASS_BITS), F.lit(4)), F.lit(9)))
    thin = store(rows.select("id", "size", "digest", "class"), "warc-digests")
    classes = sorted(r[0] for r in thin.select("class").distinct().collect()) or [4]  # six at most
    keep = store(
        thin.where(F.col("size") >= revisit_bytes).groupBy("digest", "size")
        .agg(F.max("id").alias("keep"), F.count("*").alias("n")).where("n > 1").drop("n"), "warc-keep")
    rows = rows.join(keep, ["digest", "size"], "left")
    again = F.coalesce(F.col("keep") != F.col("id"), F.col("keep").isNotNull())
    uri = F.coalesce("url", F.lit(""))
    for code in [*range(33), 127]:
        uri = F.replace(uri, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    name = F.coalesce(F.col("id").cast("string"), F.lit("null"))
    block = F.when(again, F.lit(HTTP)).otherwise(F.concat(F.lit(HTTP), F.col("payload")))
    length = F.lit(len(HTTP)) + F.when(again, F.lit(0)).otherwise(F.col("size"))
    head = F.concat(
        F.lit(f"WARC/1.1{CRLF}WARC-Type: "), F.when(again, "revisit").otherwise("response"),
        F.lit(f"{CRLF}WARC-Record-ID: <urn:page:"), name, F.lit(f">{CRLF}WARC-Date: {DATE}{CRLF}WARC-Target-URI: "), uri,
        F.lit(f"{CRLF}WARC-Payload-Digest: sha1:"), F.col("digest"), F.lit(f"{CRLF}X-Payload-Length: "), F.col("size").cast("string"),
        F.when(again, F.concat(F.lit(f"{CRLF}WARC-Profile: {PROFILE}{CRLF}WARC-Refers-To: <urn:page:"),
                               F.col("keep").cast("string"), F.lit(">"))).otherwise(""),
        F.lit(f"{CRLF}Content-Type: application/http; msgtype=response{CRLF}Content-Length: "), length.cast("string"))
    out = rows.select("class", F.concat(head, F.lit(CRLF * 2), block).alias("value"))
    for c in classes:
        (out.where(F.col("class") == c).select("value").write.option("lineSep", CRLF * 2)
         .option("maxRecordsPerFile", max(1, FILE_BYTES >> CLASS_BITS * c)).text(f"{path}/size-{c}"))
    discard(thin, keep)


# ------------------------------------------------------------------- read
VERSION = re.compile(rb"WARC/1\.[01]\r\n")
HEADER = re.compile(rb"([!-9;-~]+):[ \t]*([^\r\n]*)\r\n")
MEMBER = b"\x1f\x8b\x08"
MARK = re.compile(re.escape(MEMBER) + rb"|" + VERSION.pattern)
PIECE = 1 << 16  # bytes unzipped at a time
NEEDED = (b"warc-type", b"warc-record-id", b"content-length")


def record_at(data: bytes, at: int) -> tuple[dict[bytes, bytes], bytes, int] | str:
    """(headers, block, end) of the record at ``at`` if all checks hold, else the reason."""
    line = VERSION.match(data, at)
    if not line:
        return "no version line"
    headers, pos = {}, line.end()
    while m := HEADER.match(data, pos):
        headers[m[1].lower()] = m[2].strip()
        pos = m.end()
    if data[pos:pos + 2] != b"\r\n" or any(k not in headers for k in NEEDED):
        return "bad header"
    if not headers[b"content-length"].isdigit():
        return "bad length"
    start = pos + 2
    end = start + int(headers[b"content-length"])
    if data[end:end + 4] != b"\r\n\r\n":
        return "block does not end where its length says"
    block = data[start:end]
    want = headers.get(b"warc-payload-digest", b"")
    if headers[b"warc-type"] == b"response" and want.startswith(b"sha1:"):
        if hashlib.sha1(payload_of(block)).hexdigest().encode() != want[5:].lower():
            return "payload digest differs"
    return headers, block, end + 4


def payload_of(block: bytes) -> bytes:
    """What follows the HTTP head, or the block if it has none."""
    if block.startswith(b"HTTP/"):
        return block.partition(b"\r\n\r\n")[2]
    return block


def member_at(data: bytes, at: int) -> tuple[bytes, int, str | None]:
    """(content, end, damage) of the gzip member at ``at``; ``damage``: why only the content before it could be unzipped."""
    unzip, view, parts, pos = zlib.decompressobj(31), memoryview(data), [], at
    try:
        while not unzip.eof and pos < len(data):
            parts.append(unzip.decompress(view[pos:pos + PIECE]))
            pos = min(pos + PIECE, len(data))
    except zlib.error:
        unzip, step = _unzipped(view[at:pos]), PIECE
        while step := step // 2:  # the start of the piece, up to the bad byte
            spare = unzip.copy()
            try:
                parts.append(unzip.decompress(view[pos:pos + step]))
                pos = min(pos + step, len(data))
            except zlib.error:
                unzip = spare
        return b"".join(parts), pos, "bad gzip member"
    return b"".join(parts), pos - len(unzip.unused_data), None if unzip.eof else "gzip member cut off"


def _unzipped(view: memoryview):
    """A decompressor that has read ``view``."""
    unzip = zlib.decompressobj(31)
    for at in range(0, len(view), PIECE):
        unzip.decompress(view[at:at + PIECE])
    return unzip


def _place(data: bytes, at: int, end: int, size: int) -> int:
    """Up to where the first ``size`` bytes of the content of the member at ``at`` were read from."""
    unzip, view, pos = zlib.decompressobj(31), memoryview(data), at
    while size and pos < end:
        piece = view[pos:min(pos + PIECE, end)]
        size -= len(unzip.decompress(piece, size))
        pos += len(piece) - len(unzip.unconsumed_tail)
    return pos


def items_at(data: bytes, at: int, members: bool) -> tuple[list[tuple], int, str | None] | str:
    """(what the record or gzip member at ``at`` holds, its end, damage) if it holds a valid record, else the reason.

    A member with ``damage`` ends after its last valid record.
    """
    if not (members and data.startswith(MEMBER, at)):
        got = record_at(data, at)
        return got if isinstance(got, str) else ([("record", at, got[0], got[1])], got[2], None)
    content, end, damage = member_at(data, at)
    items = list(salvage(content, members=False))
    if not any(i[0] == "record" for i in items):
        return damage or (items[0][3] if items else "empty gzip member")
    if damage:
        size = items.pop()[1] if items[-1][0] == "gap" else len(content)
        end = _place(data, at, end, size)
    return [i[:1] + (at,) + i[2:] if i[0] == "record" else ("gap", at, end, f"bytes {i[1]} to {i[2]} of the member: {i[3]}") for i in items], end, damage


def salvage(data: bytes, members: bool = True):
    """("record", offset, headers, block) and ("gap", start, end, reason) in order, covering ``data`` whole.

    Records of a gzip member have the member's offset, gaps within it the member's start and end.
    The rest of a damaged member after its last valid record is a gap, of no length if nothing is left of it.
    """
    mark = MARK if members else VERSION
    at, got = 0, items_at(data, 0, members)
    while at < len(data):
        if not isinstance(got, str):
            items, at, damage = got
            yield from items
            got = items_at(data, at, members)
            if damage is None:
                continue
        else:
            damage = got
        end, reason = at, damage
        while end < len(data) and isinstance(got, str):
            m = mark.search(data, end + 1)
            end = m.start() if m else len(data)
            got = items_at(data, end, members)
        yield "gap", at, end, reason
        at = end


READ_SCHEMA = ("file string, offset long, end long, reason string, page_id long, url string, payload binary, "
               "payload_bytes long, payload_digest string, record_type string, refers_to long")
ARROW = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("end", pa.int64()), ("reason", pa.string()),
                   ("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()),
                   ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])


def _page(urn: bytes | None) -> int | None:
    m = re.fullmatch(rb"<urn:page:(-?[0-9]+)>", urn or b"")
    return int(m[1]) if m else None


def _row(file: str, item: tuple) -> tuple:
    if item[0] == "gap":
        return file, item[1], item[2], item[3], None, None, None, None, None, None, None
    _, at, headers, block = item
    payload = payload_of(block)
    kind = headers[b"warc-type"].decode("latin-1")
    if kind == "revisit":
        size = headers.get(b"x-payload-length", b"")
        size, digest = int(size) if size.isdigit() else None, headers.get(b"warc-payload-digest", b"").partition(b":")[2].decode("latin-1")
        payload = None
    else:
        size, digest = len(payload), hashlib.sha1(payload).hexdigest()
    return (file, at, None, None, _page(headers[b"warc-record-id"]), headers.get(b"warc-target-uri", b"").decode("utf-8", "replace"),
            payload, size, digest, kind, _page(headers.get(b"warc-refers-to")))


def _read(payloads: bool):
    def run(batches):
        for batch in batches:
            for file, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows, held = [], 0
                for item in salvage(data.as_py()):
                    row = _row(file, item)
                    rows.append(row if payloads else (*row[:6], None, *row[7:]))
                    held += len(row[6] or b"") if payloads else 0
                    if len(rows) >= 4096 or held > 16 << 20:
                        yield pa.RecordBatch.from_pylist([dict(zip(ARROW.names, r)) for r in rows], schema=ARROW)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist([dict(zip(ARROW.names, r)) for r in rows], schema=ARROW)

    return run


FILES = "path string, modificationTime timestamp, length long, content binary"


def read(spark: SparkSession, path: str, payloads: bool = True) -> tuple[DataFrame, DataFrame]:
    """(records, gaps) of the archive files in ``path``; without ``payloads`` the payload column is null."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).schema(FILES).load(path).select("path", "content")
    rows = files.mapInArrow(_read(payloads), READ_SCHEMA)
    return rows.where("reason is null").drop("end", "reason"), rows.where("reason is not null").select("file", "offset", "end", "reason")


def archive_path(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"


ORACLE = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
k AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS keep FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> keep THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> keep THEN keep END AS refers_to
FROM k
"""
