"""WARC archives: a writer that stores equal payloads once, and a reader that salvages damaged files.

Writer. Payload digests are counted with map-side combining; of equal payloads of at least ``min_payload`` bytes the
record with the smallest id is a response and the others are revisits of it. Every record is a gzip member of its own.
Spark's text writer puts the members into files, with an empty member as its line separator, so a file is a plain
sequence of gzip members and commits, retries and remote file systems are Spark's own.

Reader. Files are read as binary rows; the writer bounds its files by bytes and records. Each member is inflated and each
record's version line, header and length are checked, and its payload digest where the algorithm is known and the record
holds the whole payload. Only blocks of application/http have HTTP headers before the payload. After a failure the reader
searches for the next member that inflates to a version line (or, inside a member or a plain file, for the next version
line), goes on there and reports the bytes between as a quarantined gap. Of a cut or damaged member the records before the
failure are read; those that nothing proves (no digest, or only the member's checksum fails) carry the reason as well.

Defined results: null payloads are empty; null urls give no WARC-Target-URI; a null id is written as an empty record id
and read back as null; rows with the same id are all written; an empty table gives an archive without records.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MIN_PAYLOAD = 100
RECORDS_PER_FILE = 1_000
#: Compressed bytes from which on a file is full; one record more may be in it.
FILE_BYTES = 8 << 20
ID_PREFIX = "urn:bloomline:record:"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MAGIC = b"\x1f\x8b\x08"
VERSION = re.compile(rb"WARC/\d\.\d\r\n")
STEP = 1 << 14
#: Digest algorithms that are checked, in hex, base32 or base64; records with others are accepted unchecked.
DIGESTS = frozenset("md5 sha1 sha224 sha256 sha384 sha512".split())
HTTP_END = re.compile(rb"\r?\n\r?\n")


def _member(data: bytes, level: int = 1) -> bytes:
    deflate = zlib.compressobj(level, wbits=31)
    return deflate.compress(data) + deflate.flush()


def mark_revisits(pages: DataFrame, id_col: str, url_col: str, payload_col: str, min_payload: int) -> DataFrame:
    """page_id, url, payload, digest and refers_to, the id of the response for revisits."""
    base = pages.select(
        F.col(f"`{id_col}`").alias("page_id"),
        F.col(f"`{url_col}`").alias("url"),
        F.coalesce(F.col(f"`{payload_col}`").cast("binary"), F.lit("").cast("binary")).alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    ids = base.where(F.length("payload") >= min_payload).select("page_id", "digest")
    groups = (
        ids.groupBy("digest")
        .agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .drop("n")
    )
    # By id and digest: rows with the same id may have other payloads. Both keep a common payload out of a single task.
    revisits = ids.join(groups, "digest").where("page_id <> refers_to").select("page_id", "digest", "refers_to").distinct()
    return base.join(revisits, ["page_id", "digest"], "left")


def _record(page_id, url, payload: bytes, digest: str, refers_to, date: str) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{ID_PREFIX}{'' if page_id is None else page_id}>",
        f"WARC-Date: {date}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is not None:
        head += [f"WARC-Refers-To: <{ID_PREFIX}{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head += [
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_warc(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
    min_payload: int = MIN_PAYLOAD, date: str = "2024-01-01T00:00:00Z",
) -> None:
    """Writes a record per row under path."""

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row per file: members up to FILE_BYTES and RECORDS_PER_FILE."""

        def flush() -> pa.RecordBatch:
            whole = b"".join(made)
            made.clear()
            return pa.RecordBatch.from_arrays([pa.array([whole], pa.binary())], ["member"])

        made: list[bytes] = []
        held = 0
        for batch in batches:
            for k in range(0, len(batch), 256):
                for r in batch.slice(k, 256).to_pylist():
                    made.append(_member(_record(r["page_id"], r["url"], r["payload"], r["digest"], r["refers_to"], date)))
                    held += len(made[-1])
                    if held >= FILE_BYTES or len(made) >= RECORDS_PER_FILE:
                        yield flush()
                        held = 0
        if made:
            yield flush()

    marked = mark_revisits(pages, id_col, url_col, payload_col, min_payload)
    rows = marked.select("page_id", "url", "payload", "digest", "refers_to").mapInArrow(members, "member binary")
    (
        rows.select(F.col("member").cast("string").alias("value"))
        .write.option("lineSep", _member(b"").decode("latin-1"))
        .option("encoding", "ISO-8859-1")
        .option("maxRecordsPerFile", 1)
        .text(path)
    )


def inflate(data: memoryview, at: int) -> tuple[bytes, int] | tuple[bytes, str]:
    """The contents of the gzip member at a place and where it ends; of a damaged or cut one what comes before the failure,
    and what is wrong."""
    z, out, k = zlib.decompressobj(31), [], at
    try:
        while k < len(data):
            before = z.copy()
            out.append(z.decompress(data[k : k + STEP]))
            k += STEP
            if z.eof:
                return b"".join(out), min(k, len(data)) - len(z.unused_data)
    except zlib.error as error:
        # The failing step gives nothing: byte by byte it gives all that comes before.
        try:
            for j in range(k, min(k + STEP, len(data))):
                out.append(before.decompress(data[j : j + 1]))
        except zlib.error:
            pass
        return b"".join(out), UNPROVED if "check" in str(error) else "damaged member"
    return b"".join(out), "cut member"


#: Deflate may be valid over wrong bytes: then only the checksum tells, and not where.
UNPROVED = "member differs from its checksum"


def _unchunked(body: bytes) -> bytes | None:
    """The body without its chunked transfer coding, None if it has none."""
    out, at = [], 0
    while m := re.compile(rb"([0-9a-fA-F]+)[^\r\n]*\r\n").match(body, at):
        size = int(m[1], 16)
        if not size:
            return b"".join(out)
        out.append(body[m.end() : m.end() + size])
        at = m.end() + size + 2
    return None


def differs(digest: str, payload: bytes) -> bool | None:
    """Whether a digest contradicts the payload; None if its algorithm isn't known. 64 places without a label are sha256."""
    label, _, value = digest.rpartition(":")
    label = label.lower().replace("-", "") or ("sha256" if len(value) == 64 else "")
    if label not in DIGESTS:
        return None
    want = hashlib.new(label, payload).digest()
    base32, base64_ = (f(want).decode().rstrip("=") for f in (base64.b32encode, base64.b64encode))
    bare = value.rstrip("=")
    return value.lower() != want.hex() and bare.upper() != base32 and bare.replace("-", "+").replace("_", "/") != base64_


def parse(data: bytes, at: int) -> tuple[dict, int] | str:
    """The record at a place and where it ends, or what is wrong there."""
    if not VERSION.match(data, at):
        return "no version line"
    end = data.find(b"\r\n\r\n", at)
    if end < 0:
        return "header without end"
    fields = {}
    for line in data[at:end].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return "header line without colon"
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    if not fields.get("content-length", "").isdigit():
        return "no length"
    start, size = end + 4, int(fields["content-length"])
    block = data[start : start + size]
    if len(block) < size or data[start + size : start + size + 4] != b"\r\n\r\n":
        return "block shorter or longer than its length"
    kind, digest = fields.get("warc-type", ""), fields.get("warc-payload-digest", "")
    media = fields.get("content-type", "").partition(";")[0].strip().lower()
    http, payload = b"", block
    if media == "application/http" or not media and block.startswith(b"HTTP/"):
        cut = HTTP_END.search(block)
        http, payload = (block[: cut.start()], block[cut.end() :]) if cut else (block, b"")
    length, proved = len(payload), False
    # A cut or segmented record's digest is that of the whole payload.
    whole = "warc-truncated" not in fields and "warc-segment-number" not in fields
    if kind in ("response", "resource", "conversion") and digest and whole:
        wrong = differs(digest, payload)
        # Archives digest chunked bodies as sent or as meant.
        if wrong and re.search(rb"(?i)\ntransfer-encoding:[^\n]*chunked", http) and (bare := _unchunked(payload)) is not None:
            wrong = differs(digest, bare)
        if wrong:
            return "payload differs from its digest"
        proved = wrong is False
    if kind == "revisit":
        found = re.search(rb"(?i)\ncontent-length:\s*(\d+)", http)
        length = int(found[1]) if found else None
    named = lambda key: (v.strip("<>").removeprefix(ID_PREFIX) or None) if (v := fields.get(key)) else None
    return {
        "record_type": kind, "record_id": named("warc-record-id"), "refers_to": named("warc-refers-to"),
        "target_uri": fields.get("warc-target-uri"), "payload_digest": digest.removeprefix("sha256:") or None,
        "payload_bytes": length, "payload": payload, "proved": proved,
    }, start + size + 4


def _opens(data: memoryview, at: int) -> bool:
    """Whether a member inflates to nothing or begins with a version line, even if it is damaged or cut later."""
    z, out = zlib.decompressobj(31), b""
    try:
        while at < len(data) and len(out) < 10 and not z.eof:
            out += z.decompress(data[at : at + 64], 64)
            at += 64
    except zlib.error:
        return False
    return bool(VERSION.match(out)) or z.eof and not out


def _next_member(data: memoryview, raw: bytes, at: int) -> int:
    """The next place from which a member inflates to a version line or to nothing, or a plain version line."""
    while True:
        plain = VERSION.search(raw, at)
        packed = raw.find(MAGIC, at)
        if packed < 0 or plain and plain.start() < packed:
            return plain.start() if plain else len(raw)
        if _opens(data, packed):
            return packed
        at = packed + 1


def salvage(raw: bytes) -> Iterator[tuple[int, int, str | None, dict | None]]:
    """(offset, length, reason, record) of each record, and of each gap with its reason and no record. Records that a
    damaged member gives but nothing proves have both."""
    data, at = memoryview(raw), 0
    while at < len(raw):
        reason = "no member or version line"
        if raw.startswith(MAGIC, at):
            inner, end = inflate(data, at)
            broken, after, inside = None, end, 0
            if isinstance(end, str):
                # A cut member's stream may run on into the next one: it ends there.
                after = _next_member(data, raw, at + 1)
                inner, end = inflate(data[:after], at)
                broken = end if isinstance(end, str) else "damaged member"
            while inside < len(inner):
                found = parse(inner, inside)
                if isinstance(found, str):
                    later = VERSION.search(inner, inside + 1)
                    inside = later.start() if later else len(inner)
                    if later or not broken:
                        yield at, after - at, found, None
                else:
                    sure = broken in (None, "cut member") or found[0]["proved"] and broken != UNPROVED
                    yield at, after - at, None if sure else broken, found[0]
                    inside = found[1]
            if broken:
                yield at, after - at, broken, None
            at = after
            continue
        if VERSION.match(raw, at):
            found = parse(raw, at)
            if not isinstance(found, str):
                yield at, found[1] - at, None, found[0]
                at = found[1]
                continue
            reason = found
        after = _next_member(data, raw, at + 1)
        yield at, after - at, reason, None
        at = after


FIELDS = {
    "record_type": pa.string(), "record_id": pa.string(), "refers_to": pa.string(), "target_uri": pa.string(),
    "payload_digest": pa.string(), "payload_bytes": pa.int64(), "payload": pa.binary(),
}


def read_warc(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row per record or gap: path, offset, length, reason (null for records), then the record's fields. A record from a
    damaged member that nothing proves has both a reason and its fields."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush() -> pa.RecordBatch:
            arrays = [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.int64(), pa.int64(), pa.string()))]
            arrays += [pa.array([r[4] and r[4][n] for r in rows], t) for n, t in FIELDS.items()]
            rows.clear()
            return pa.RecordBatch.from_arrays(arrays, ["path", "offset", "length", "reason", *FIELDS])

        rows: list[tuple] = []
        for batch in batches:
            for file in batch.to_pylist():
                for offset, length, reason, record in salvage(file["content"]):
                    if record and not with_payload:
                        record["payload"] = None
                    rows.append((file["path"], offset, length, reason, record))
                    if len(rows) >= 512:
                        yield flush()
        yield flush()

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(
        run,
        "path string, offset bigint, length bigint, reason string, record_type string, record_id string, "
        "refers_to string, target_uri string, payload_digest string, payload_bytes bigint, payload binary",
    )
