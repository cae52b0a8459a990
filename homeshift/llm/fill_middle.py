"""Operator 11: fill-in-middle transformation over seekable compressed frames.

``frame_store`` writes every text as independent zstandard frames of ``FRAME_BYTES`` bytes (cut between code points)
with two running counts a frame: units (tokens) that have ended, and bytes.  A cut after the k-th unit lies in the first
frame whose count reaches k, found by binary search; only that frame is decompressed to find the byte.  The
output is streamed from frames in the order of its form (``psm`` or ``spm``), whole frames and parts of the two cut frames.  It
is kept as frames itself, so ``restore`` finds the sentinels in one pass over them and then streams prefix,
middle and suffix in text order by seeking.

White space of the units is ASCII, so units are counted on the UTF-8 bytes with numpy, a whole text at once.

Memory: an Arrow batch of texts, its frames, and a few decompressed frames.  There is no shuffle; a row needs no other
row, so a hot source, equal texts or one long text move nothing.  A lost executor recomputes its own files.

Defined results: a null text counts as empty, an empty text is plain; a null id is drawn as if its decimal form were
empty; repeated rows stay and come out equal; very long texts are many frames; an empty table gives an empty
result; other columns of the input, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from homeshift.session import materialize

FRAME_BYTES = 1 << 16
LEVEL = 3
STORE = "frames array<binary>, units array<long>, ends array<long>"


@dataclass(frozen=True)
class Rules:
    """Parameters of the transformation: seed, share of transformed texts, share of ``spm`` among them (percent), sentinels."""

    seed: int = 42
    percent: int = 50
    spm_percent: int = 80
    prefix: bytes = b"<P>"
    suffix: bytes = b"<S>"
    middle: bytes = b"<M>"


def unit_ends(data: bytes) -> np.ndarray:
    """Byte positions at which a unit ends: behind every run of other characters, and behind white space at the end."""
    if not data:
        return np.zeros(0, np.int64)
    b = np.frombuffer(data, np.uint8)
    white = (b == 32) | ((b >= 9) & (b <= 13))
    ends = np.flatnonzero(~white[:-1] & white[1:]) + 1
    return np.append(ends, len(b))


class Frames:
    """Bytes as independent compressed frames; ``units`` and ``ends`` are running counts at the end of each frame."""

    def __init__(self, frames: list[bytes], units: list[int], ends: list[int], unpack: zstandard.ZstdDecompressor):
        self.frames, self.units, self.ends, self.unpack = frames, units, ends, unpack
        self._last = (-1, b"")

    @property
    def n_bytes(self) -> int:
        return self.ends[-1] if self.ends else 0

    @property
    def n_units(self) -> int:
        return self.units[-1] if self.units else 0

    def frame(self, i: int) -> bytes:
        if self._last[0] != i:
            self._last = (i, self.unpack.decompress(self.frames[i], max_output_size=FRAME_BYTES + 8))
        return self._last[1]

    def byte_after(self, unit: int) -> int:
        """Byte position behind the ``unit``-th unit (0: the start): one frame is decompressed."""
        if unit <= 0:
            return 0
        i = bisect_left(self.units, unit)
        before = self.units[i - 1] if i else 0
        begin = self.ends[i - 1] if i else 0
        data = self.frame(i)
        ends = unit_ends(data)
        if i + 1 < len(self.frames) and len(ends) > self.units[i] - before:
            ends = ends[:-1]  # the frame ends inside a unit
        return begin + int(ends[unit - before - 1])

    def stream(self, start: int, stop: int) -> Iterator[bytes]:
        """Bytes from ``start`` to ``stop``, a frame at a time."""
        i = bisect_right(self.ends, start)
        while start < stop:
            begin = self.ends[i - 1] if i else 0
            data = self.frame(i)
            yield data if start == begin and stop >= self.ends[i] else data[start - begin : stop - begin]
            start, i = self.ends[i], i + 1


def compress(data: bytes, pack: zstandard.ZstdCompressor) -> tuple[list[bytes], list[int], list[int]]:
    """Frames of a text, and the running counts of units and bytes."""
    if not data:
        return [], [], []
    ends = unit_ends(data)
    if len(data) <= FRAME_BYTES:
        return [pack.compress(data)], [len(ends)], [len(data)]
    frames, units, stops, at = [], [], [], 0
    while at < len(data):
        stop = min(at + FRAME_BYTES, len(data))
        while stop < len(data) and data[stop] & 0xC0 == 0x80:  # never inside a code point
            stop -= 1
        frames.append(pack.compress(data[at:stop]))
        units.append(int(np.searchsorted(ends, stop, side="right")))
        stops.append(stop)
        at = stop
    return frames, units, stops


def collect_frames(chunks: Iterator[bytes], pack: zstandard.ZstdCompressor, unpack: zstandard.ZstdDecompressor) -> Frames:
    """A byte stream as frames of ``FRAME_BYTES`` bytes (units are not counted)."""
    frames, ends, held, size, total = [], [], [], 0, 0
    for chunk in chunks:
        held.append(chunk)
        size += len(chunk)
        if size >= FRAME_BYTES:
            data = b"".join(held)
            at = 0
            while size - at >= FRAME_BYTES:
                frames.append(pack.compress(data[at : at + FRAME_BYTES]))
                at += FRAME_BYTES
                total += FRAME_BYTES
                ends.append(total)
            held, size = [data[at:]], size - at
    if size:
        frames.append(pack.compress(b"".join(held)))
        ends.append(total + size)
    return Frames(frames, [], ends, unpack)


def draws(doc_id, rules: Rules) -> list[int]:
    own = "" if doc_id is None else str(doc_id)
    h = hashlib.sha256(f"{rules.seed}:{own}".encode()).hexdigest()
    return [int(h[8 * i : 8 * i + 8], 16) for i in range(4)]


def holds_any(text: Frames, words: list[bytes]) -> bool:
    """Whether any of the short ``words`` occurs; a word may lie over a frame border."""
    tail = b""
    keep = max(map(len, words)) - 1
    for chunk in text.stream(0, text.n_bytes):
        data = tail + chunk
        if any(w in data for w in words):
            return True
        tail = data[-keep:]
    return False


def plan(doc_id, text: Frames, rules: Rules) -> tuple[str, int, int]:
    """(form, byte behind the prefix, byte behind the middle)."""
    h1, h2, h3, h4 = draws(doc_id, rules)
    n = text.n_units
    if not n or h3 % 100 >= rules.percent or holds_any(text, [rules.prefix, rules.suffix, rules.middle]):
        return "plain", 0, 0
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    return ("spm" if h4 % 100 < rules.spm_percent else "psm"), text.byte_after(a), text.byte_after(b)


def output(text: Frames, form: str, a: int, b: int, rules: Rules) -> Iterator[bytes]:
    """The transformed text as a stream of bytes."""
    if form == "plain":
        yield from text.stream(0, text.n_bytes)
        return
    prefix, middle, suffix = (rules.prefix, 0, a), (rules.middle, a, b), (rules.suffix, b, text.n_bytes)
    for mark, start, stop in ((prefix, suffix, middle) if form == "psm" else (suffix, prefix, middle)):
        yield mark
        yield from text.stream(start, stop)


def find(data: Frames, mark: bytes, start: int) -> int:
    """Position of the first ``mark`` at or after ``start``; it may lie over a frame border."""
    tail, at = b"", start
    for chunk in data.stream(start, data.n_bytes):
        seen = tail + chunk
        hit = seen.find(mark)
        if hit >= 0:
            return at - len(tail) + hit
        at += len(chunk)
        tail = seen[-(len(mark) - 1) :]
    raise ValueError(f"no {mark!r} in the output")


def restore(out: Frames, form: str, rules: Rules) -> Iterator[bytes]:
    """The text again, from a transformed text and its form alone."""
    if form == "plain":
        yield from out.stream(0, out.n_bytes)
        return
    marks = [rules.prefix, rules.suffix, rules.middle] if form == "psm" else [rules.suffix, rules.prefix, rules.middle]
    starts, at = {}, 0
    for m in marks:
        starts[m] = find(out, m, at)
        at = starts[m] + len(m)
    stops = dict(zip(marks, [starts[m] for m in marks[1:]] + [out.n_bytes]))
    for m in (rules.prefix, rules.middle, rules.suffix):
        yield from out.stream(starts[m] + len(m), stops[m])


def code_points(chunks: Iterator[bytes]) -> int:
    return sum(int(np.count_nonzero(np.frombuffer(c, np.uint8) & 0xC0 != 0x80)) for c in chunks)


def _digest(chunks: Iterator[bytes]) -> str:
    h = hashlib.sha256()
    for c in chunks:
        h.update(c)
    return h.hexdigest()


def frame_store(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, frames, units, ends) of every row, written as a table in the shared checkpoint folder."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        pack = zstandard.ZstdCompressor(level=LEVEL)
        for b in batches:
            rows = [compress(t.as_py() or b"", pack) for t in b.column(1)]
            cols = [pa.array([r[0] for r in rows], pa.list_(pa.binary())), pa.array([r[1] for r in rows], pa.list_(pa.int64())), pa.array([r[2] for r in rows], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([b.column(0), *cols], ["id", "frames", "units", "ends"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    return materialize(rows.mapInArrow(run, f"id {kind}, {STORE}"), "fim-frames")


def _rows(batch: pa.RecordBatch, unpack: zstandard.ZstdDecompressor):
    for i, f, u, e in zip(*(batch.column(c) for c in range(4))):
        yield i.as_py(), Frames(f.as_py(), u.as_py(), e.as_py(), unpack)


def transform(store: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output) of a frame store: the transformed texts themselves."""
    kind = store.schema["id"].dataType.simpleString()

    def run(batches):
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            rows = []
            for i, text in _rows(batch, unpack):
                form, a, b = plan(i, text, rules)
                chars = (None, None) if form == "plain" else (code_points(text.stream(0, a)), code_points(text.stream(a, b)))
                rows.append((i, text.n_units, form, *chars, b"".join(output(text, form, a, b, rules))))
            yield _batch(rows, batch.column(0).type, ["id", "n", "form", "prefix_chars", "middle_chars", "output"], pa.binary())

    made = store.mapInArrow(run, f"id {kind}, n long, form string, prefix_chars long, middle_chars long, output binary")
    return made.withColumn("output", F.col("output").cast("string"))


def digests(store: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256): outputs and texts restored from them, as streams."""
    kind = store.schema["id"].dataType.simpleString()

    def run(batches):
        pack, unpack = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()
        for batch in batches:
            rows = []
            for i, text in _rows(batch, unpack):
                form, a, b = plan(i, text, rules)
                chars = (None, None) if form == "plain" else (code_points(text.stream(0, a)), code_points(text.stream(a, b)))
                made = collect_frames(output(text, form, a, b, rules), pack, unpack)
                rows.append((i, text.n_units, form, *chars, _digest(made.stream(0, made.n_bytes)), _digest(restore(made, form, rules))))
            yield _batch(rows, batch.column(0).type, ["id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"], pa.string())

    return store.mapInArrow(run, f"id {kind}, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string")


def _batch(rows: list[tuple], id_type: pa.DataType, names: list[str], last: pa.DataType) -> pa.RecordBatch:
    types = [id_type, pa.int64(), pa.string(), pa.int64(), pa.int64(), last, last]
    cols = list(zip(*rows)) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types)], names)


def fill_middle_digests(docs: DataFrame, rules: Rules = Rules(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Digest row of every document."""
    return digests(frame_store(docs, id_col, text_col), rules).withColumnRenamed("id", id_col)


ORACLE_SQL = r"""
with d as (
  select doc_id, coalesce(text, '') as text, sha256('42:' || doc_id) as h,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') as u
  from documents
), r as (
  select *, len(u) as n, ('0x' || substr(h, 1, 8))::bigint as h1, ('0x' || substr(h, 9, 8))::bigint as h2,
         ('0x' || substr(h, 17, 8))::bigint as h3, ('0x' || substr(h, 25, 8))::bigint as h4
  from d
), c as (
  select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
         case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 50 then 'plain'
              when h4 % 100 < 80 then 'spm' else 'psm' end as form
  from r
), p as (
  select doc_id, text, n, form, coalesce(array_to_string(u[1:a], ''), '') as pre, coalesce(array_to_string(u[a + 1:b], ''), '') as mid,
         coalesce(array_to_string(u[b + 1:n], ''), '') as suf
  from c
)
select doc_id, n, form, case when form <> 'plain' then length(pre) end as prefix_chars, case when form <> 'plain' then length(mid) end as middle_chars,
       sha256(case form when 'plain' then text when 'psm' then '<P>' || pre || '<S>' || suf || '<M>' || mid else '<S>' || suf || '<P>' || pre || '<M>' || mid end) as output_sha256,
       sha256(text) as restored_sha256
from p
"""
