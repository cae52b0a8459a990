"""Operator 12: WARC archives with revisit records, and a reader that salvages damaged ones.

Writing.  Every page is one WARC 1.1 record, a gzip member of its own.  Of equal payloads (sha-256 and length) of at
least ``min_bytes`` bytes the page with the largest id is a ``response``, the others are ``revisit`` records that name it
(profile identical-payload-digest) and keep only the HTTP header.  Archives are blobs of about
``ARCHIVE_BYTES`` bytes, one row each (``path``, ``content``: the columns of Spark's ``binaryFile`` source, so the reader takes
archive files of other makers as they are).

Reading.  ``read_archives`` walks an archive from member to member (gzip) or from record to record (plain).  A
record counts when the gzip check sum, version line, header, content length, closing lines, block digest and, for
responses, payload digest all agree.  After a failed check the reader searches for the next place at which a whole
valid member, or a version line with a valid record, begins, goes on there, and logs the bytes between as a quarantined gap.  Every
byte of an archive belongs to exactly one record or gap.

Skew: rows of one payload are dealt over ``salts`` parts by their row number; a part's winner, then the winner of the
parts, is found by aggregates with a map-side step, and goes back the same way, so no join key holds more
than a salt's share of a hot payload.  Payloads are shuffled once.

Memory: one archive blob, and the largest member.  Tables lie in the shared checkpoint folder; a lost executor rewrites
its own part.

Defined results: null html is the empty payload; a null id is smaller than any other; of rows that
repeat id and payload one is the response, the others revisit it under the same id; line breaks and other control characters in
a url are percent-encoded in the header; very long payloads are one record each; an empty table gives an empty
result; other columns of the input are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from homeshift.llm.common import shuffle_partitions
from homeshift.session import materialize

ARCHIVE_BYTES = 4_000_000
#: Fixed values of the WARC format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"
GZIP_MAGIC = b"\x1f\x8b\x08"
VERSION_LINE = re.compile(rb"WARC/1\.[01]\r\n")

RECORDS = "kind string, path string, at long, size long, reason string, record_type string, page_id string, url string, refers_to string, payload_bytes long, payload_digest string, payload binary"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# ------------------------------------------------------------------ decisions

def numbered_pages(pages: DataFrame, salts: int, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """(id, url, packed payload, digest, n_bytes, row, salt) of every row, written once so that row numbers stay.

    Payloads are packed (zstandard), so the table and the exchange behind it move a fraction of their bytes.
    """
    payload = F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), payload.alias("payload"), F.monotonically_increasing_id().alias("row"))
    rows = rows.select(
        "payload", "id", "url", "row", F.unhex(F.sha2("payload", 256)).alias("digest"), F.octet_length("payload").cast("long").alias("n_bytes"),
        F.pmod(F.xxhash64("row"), F.lit(salts)).cast("int").alias("salt"),
    )

    def run(batches):
        pack = zstandard.ZstdCompressor(level=3)
        for b in batches:
            packed = pa.array([pack.compress(v.as_py()) for v in b.column(0)], pa.binary())
            yield pa.RecordBatch.from_arrays([packed, *b.columns[1:]], ["packed", *b.schema.names[1:]])

    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[1:])
    return materialize(rows.mapInArrow(run, f"packed binary, {kept}"), "warc-pages")


def with_response(rows: DataFrame, min_bytes: int) -> DataFrame:
    """Each row with ``revisit``, and ``response``: the id of the response to its payload."""
    key = ["digest", "n_bytes"]
    large = rows.where(F.col("n_bytes") >= min_bytes)
    parts = large.groupBy(*key, "salt").agg(F.max(F.struct("id", "row")).alias("best"))
    won = parts.groupBy(*key).agg(F.max("best").alias("best"))
    back = parts.select(*key, "salt").join(won, key).select(*key, "salt", "best")
    joined = rows.join(back, [*key, "salt"], "left")
    revisit = F.col("best").isNotNull() & (F.col("best.row") != F.col("row"))
    return joined.select("id", "url", "packed", revisit.alias("revisit"), F.col("best.id").alias("response"))


# -------------------------------------------------------------------- writing

def _clean(value: str) -> str:
    """A header value: control characters, which would end the line, are percent-encoded."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m.group()):02X}", value)


def _uri(page_id) -> str:
    return "<urn:page:>" if page_id is None else f"<urn:page:{page_id}>"


def _page_of(uri: str | None) -> str | None:
    return uri[len("<urn:page:") : -1] or None if uri else None


def record(page_id, url: str | None, payload: bytes, response) -> bytes:
    """One WARC record; ``response``: None for a response record, else (page id,) of the record that it revisits."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + (payload if response is None else b"")
    head = {"WARC-Type": "response" if response is None else "revisit", "WARC-Record-ID": _uri(page_id)}
    if url is not None:
        head["WARC-Target-URI"] = _clean(url)
    if response is not None:
        head |= {"WARC-Profile": PROFILE, "WARC-Refers-To": _uri(response[0])}
    head |= {
        "WARC-Date": "1970-01-01T00:00:00Z", "WARC-Payload-Digest": f"sha1:{base32_sha1(payload)}", "WARC-Block-Digest": f"sha1:{base32_sha1(block)}",
        "Content-Type": "application/http; msgtype=response", "Content-Length": str(len(block)),
    }
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items()).encode()
    return VERSION + b"\r\n" + lines + b"\r\n" + block + END


def member(data: bytes) -> bytes:
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(data) + pack.flush()


def write_archives(pages: DataFrame, min_bytes: int = 0, salts: int | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(path, content) of every archive, written as a table; one row an archive."""
    parts = shuffle_partitions(pages.sparkSession)
    rows = with_response(numbered_pages(pages, salts or 2 * parts, id_col, url_col, html_col), min_bytes)

    def run(batches):
        part, number, held, size = TaskContext.get().partitionId(), 0, [], 0
        unpack_payload = zstandard.ZstdDecompressor().decompress

        def blob() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([f"part-{part:06d}-{number:06d}.warc.gz"]), pa.array([b"".join(held)], pa.binary())], ["path", "content"])

        for b in batches:
            for i, url, packed, revisit, response in zip(*(b.column(c) for c in range(5))):
                held.append(member(record(i.as_py(), url.as_py(), unpack_payload(packed.as_py()), (response.as_py(),) if revisit.as_py() else None)))
                size += len(held[-1])
                if size >= ARCHIVE_BYTES:
                    yield blob()
                    number, held, size = number + 1, [], 0
        if held:
            yield blob()

    made = rows.select("id", "url", "packed", "revisit", "response").mapInArrow(run, "path string, content binary")
    return materialize(made, "warc-archives")


# -------------------------------------------------------------------- reading

class Bad(ValueError):
    """A record or member that fails a check."""


def parse(data: bytes, at: int = 0) -> tuple[dict, int]:
    """(record, position behind it) of the plain record that begins at ``at``."""
    m = VERSION_LINE.match(data, at)
    if not m:
        raise Bad("no version line")
    stop = data.find(END, m.end() - 2)
    if stop < 0:
        raise Bad("header without end")
    head = {}
    for line in data[m.end() : stop].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if line and not colon:
            raise Bad("broken header line")
        head[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    length = head.get("content-length", "")
    if not re.fullmatch("[0-9]{1,18}", length):
        raise Bad("no content length")
    begin, end = stop + 4, stop + 4 + int(length)
    if data[end : end + 4] != END:
        raise Bad("record cut or of wrong length")
    block = data[begin:end]
    own = head.get("warc-block-digest", "")
    if own.startswith("sha1:") and own[5:] != base32_sha1(block):
        raise Bad("block digest differs")
    rec = {"record_type": head.get("warc-type"), "page_id": _page_of(head.get("warc-record-id")), "url": head.get("warc-target-uri"), "refers_to": _page_of(head.get("warc-refers-to"))}
    digest = head.get("warc-payload-digest", "").removeprefix("sha1:") or None
    payload = None
    size = None
    if head.get("content-type", "").startswith("application/http"):
        http, _, body = block.partition(b"\r\n\r\n")
        said = re.search(rb"(?im)^content-length:\s*([0-9]+)", http)
        if rec["record_type"] == "response":
            payload, size = body, len(body)
            if digest and digest != base32_sha1(body):
                raise Bad("payload digest differs")
        else:
            size = int(said.group(1)) if said else None
    return rec | {"payload": payload, "payload_bytes": size, "payload_digest": digest}, end + 4


def unpack(data: bytes, at: int) -> tuple[bytes, int]:
    """(content, position behind it) of the gzip member that begins at ``at``; its check sum is verified."""
    if data[at : at + 3] != GZIP_MAGIC:
        raise Bad("no gzip member")
    z = zlib.decompressobj(31)
    out, step, here = [], 1 << 16, at
    try:
        while not z.eof and here < len(data):
            out.append(z.decompress(data[here : here + step]))
            here += step
    except zlib.error as e:
        raise Bad(f"gzip: {e}") from e
    if not z.eof:
        raise Bad("gzip member cut")
    return b"".join(out), min(here, len(data)) - len(z.unused_data)


def read_at(data: bytes, at: int) -> tuple[list[dict], int]:
    """The records of the member, or the plain record, that begins at ``at``, and the position behind it."""
    if data[at : at + 2] == GZIP_MAGIC[:2]:
        plain, stop = unpack(data, at)
        recs, here = [], 0
        while here < len(plain):
            rec, here = parse(plain, here)
            recs.append(rec)
        if not recs:
            raise Bad("empty member")
        return recs, stop
    rec, stop = parse(data, at)
    return [rec], stop


def next_start(data: bytes, at: int) -> int:
    """First place from ``at`` on that looks like the start of a member or of a plain record, or the end."""
    gz = data.find(GZIP_MAGIC, at)
    line = VERSION_LINE.search(data, at)
    return min(gz if gz >= 0 else len(data), line.start() if line else len(data))


def salvage(data: bytes) -> Iterator[tuple[str, int, int, str | None, dict]]:
    """(kind, position, size, reason, record) of every record and of every quarantined gap, in order of bytes."""
    at = gap = 0
    reason = None
    while at < len(data):
        try:
            recs, stop = read_at(data, at)
        except Bad as e:
            reason = reason or str(e)
            at = next_start(data, at + 1)
            continue
        if gap < at:
            yield "gap", gap, at - gap, reason, {}
        for rec in recs:
            yield "record", at, stop - at, None, rec
        at = gap = stop
        reason = None
    if gap < len(data):
        yield "gap", gap, len(data) - gap, reason, {}


def read_archives(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """RECORDS rows of archives (path, content): ``kind`` is record or gap; ``payloads``: carry the payload along."""
    names = [f.split(" ")[0] for f in RECORDS.split(", ")]
    types = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    schema = pa.schema([(f.split(" ")[0], types[f.split(" ")[1]]) for f in RECORDS.split(", ")])

    def run(batches):
        for b in batches:
            for path, content in zip(b.column(0), b.column(1)):
                rows, size = [], 0
                for kind, at, n, reason, rec in salvage(content.as_py() or b""):
                    own = {"kind": kind, "path": path.as_py(), "at": at, "size": n, "reason": reason, **rec}
                    if not payloads:
                        own["payload"] = None
                    rows.append(tuple(own.get(c) for c in names))
                    size += len(own.get("payload") or b"")
                    if size >= ARCHIVE_BYTES or len(rows) >= 10_000:
                        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    return archives.select("path", "content").mapInArrow(run, RECORDS)


def archive_round_trip(pages: DataFrame, min_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Pages written as archives and read back: (id, payload_bytes, payload_digest, record_type, refers_to)."""
    kind = pages.schema[id_col].dataType
    got = read_archives(write_archives(pages, min_bytes, None, id_col, url_col, html_col), payloads=False)
    refers = F.when(F.col("record_type") == "revisit", F.col("refers_to")).cast(kind)
    return got.where("kind = 'record'").select(F.col("page_id").cast(kind).alias(id_col), "payload_bytes", "payload_digest", "record_type", refers.alias("refers_to"))


#: Base32 of the 160 digest bits: four runs of 40 bits, eight characters each.
ORACLE_SQL = """
with p as (
  select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as h from pages
), d as (
  select *, max(page_id) over (partition by html) as best,
         translate(upper(to_base(('0x' || substr(h, 1, 10))::bigint, 32, 8) || to_base(('0x' || substr(h, 11, 10))::bigint, 32, 8) ||
                         to_base(('0x' || substr(h, 21, 10))::bigint, 32, 8) || to_base(('0x' || substr(h, 31, 10))::bigint, 32, 8)),
                   '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') as digest
  from p
)
select page_id, cast(strlen(html) as bigint) as payload_bytes, digest as payload_digest,
       case when page_id = best then 'response' else 'revisit' end as record_type,
       case when page_id = best then null else best end as refers_to
from d
"""
