"""Operator 5: best-fit packing of token pieces, after Martello-Toth dominance reduction.

1. Tokenize: every whole text becomes ids plus the end id; a document longer than a
   sequence is cut into full pieces, the first one may be shorter.  Only one small row a
   piece goes on: (id, piece, start, length, crc32 of its ids).
2. Profile: pieces are counted by length, at most ``capacity`` rows, whatever the corpus.
3. Reduce: sets of at most three lengths that provably dominate every other way to
   pack their largest piece are fixed for good, as often as they occur.
4. Best fit: what is left goes, largest first, into the fullest sequence that
   has room.  Equal sequences are handled as one group with a multiplicity, so steps 3 and
   4 work on lengths, never on pieces, and take the same time for any corpus.
5. Place: pieces of one length are numbered without gaps by a distributed rank; the rank
   falls into one interval of the plan, which gives the sequence and the offset.

Skew: a length that most pieces share (full pieces) is numbered in hashed parts.
The table of the plan has one row per group of equal sequences and place in it.

Defined results: a null or empty text is one piece that holds the end id; repeated rows and equal ids are
packed as rows of their own; very long texts are many pieces; pieces of equal length are placed in hashed order; other columns of the
input, whatever their names, are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from homeshift.llm.bpe import byte_alphabet
from homeshift.llm.common import gapless_rank, place_by_rank, shuffle_partitions
from homeshift.session import materialize

#: Word pattern of byte-level BPE files (fixed public value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: White-space runs of so many characters are split off before the pattern, which keeps a state for each character of a run, a million at most.
LONG_RUN = 100_000
SPACES = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")  # \s of the pattern

_LOADED: dict[str, tiktoken.Encoding] = {}


def byte_encoding(path: str) -> tiktoken.Encoding:
    """The byte-level BPE of a tokenizer file, loaded once per worker; its ids are the merge ranks."""
    if path not in _LOADED:
        spec = json.load(open(path, encoding="utf-8"))
        byte_of = {c: b for b, c in enumerate(byte_alphabet())}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(byte_of[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
        _LOADED[path] = tiktoken.Encoding("byte-bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
    return _LOADED[path]


def encode(enc: tiktoken.Encoding, text: str) -> list[int]:
    """Ids of a text; a long white-space run is one piece, but for its last character if a word follows, as in the pattern."""
    if len(text) < LONG_RUN:
        return enc.encode(text, allowed_special="all")
    special = tuple(enc.special_tokens_set)
    ids, at = [], 0
    for run in SPACES.finditer(text):
        lo, hi = run.span()
        if hi - lo >= LONG_RUN:
            ids += enc.encode(text[at:lo], allowed_special="all")
            at = hi if hi == len(text) or text.startswith(special, hi) else hi - 1
            ids += enc._encode_single_piece(text[lo:at])
    return ids + enc.encode(text[at:], allowed_special="all")


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens: full ones, the first may be shorter."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def token_pieces(docs: DataFrame, path: str, capacity: int, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, ids_crc32): one row a piece."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        enc = byte_encoding(path)
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                part = b.slice(at, 1000)
                row, cols = [], ([], [], [], [])
                for i, v in enumerate(part.column(1)):
                    ids = np.array([*encode(enc, v.as_py() or ""), end_id], dtype="<u4")
                    for k, (start, length) in enumerate(cut(len(ids), capacity)):
                        row.append(i)
                        for c, x in zip(cols, (k, start, length, zlib.crc32(ids[start : start + length].tobytes()))):
                            c.append(x)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(row, pa.int32())), pa.array(cols[0], pa.int32()), *(pa.array(c, pa.int64()) for c in cols[1:])],
                    ["id", "piece", "start", "length", "ids_crc32"],
                )

    out = docs.selectExpr(f"`{id_col}` as id", f"`{text_col}` as text")
    return out.mapInArrow(run, f"id {kind}, piece int, start long, length long, ids_crc32 long")


def reduce_profile(counts: dict[int, int], capacity: int) -> tuple[list[tuple[tuple[int, ...], int]], dict[int, int]]:
    """Martello-Toth reduction on lengths with multiplicities.

    Returns the fixed sequences ((lengths), how many) and the counts that are left.
    For the piece length w of a sequence, with free space c = capacity - w:
    * nothing fits beside w: the sequence {w} dominates;
    * a length equal to c: any other filling of the space could take the place of that
      piece, so {w, c} dominates;
    * no two lengths fit together beside w: {w, k} with the largest k <= c dominates;
    * no three lengths fit, and for the largest k <= c there is b = c - k such that no
      two lengths over b fit together: every filling fits into k and b, so {w, k, b} dominates.
    """
    left = {w: n for w, n in counts.items() if n > 0}
    fixed: list[tuple[tuple[int, ...], int]] = []

    def fix(*ws: int) -> None:
        need = {w: ws.count(w) for w in ws}
        n = min(left[w] // k for w, k in need.items())
        fixed.append((ws, n))
        for w, k in need.items():
            left[w] -= n * k
            if not left[w]:
                del left[w]

    def others(w: int) -> list[int]:
        """Up to three copies of each length, without one piece of w, in ascending order."""
        return sorted(x for x, n in left.items() for _ in range(min(3, n - (x == w))))

    for w in sorted(left, reverse=True):  # perfect pairs first: each is optimal whatever else is packed
        c = capacity - w
        if w in left and c in left and (c != w or left[w] > 1):
            fix(w, c)
    changed = True
    while changed:
        changed = False
        for w in sorted(left, reverse=True):
            while w in left:
                c, rest = capacity - w, others(w)
                at = bisect_left(rest, c + 1)
                if not at:
                    fixed.append(((w,), left.pop(w)))
                elif rest[at - 1] == c:
                    fix(w, c)
                elif len(rest) < 2 or rest[0] + rest[1] > c:
                    fix(w, rest[at - 1])
                else:
                    k = rest[at - 1]
                    b = c - k
                    over = rest[bisect_left(rest, b + 1) :]
                    three = len(rest) > 2 and sum(rest[:3]) <= c
                    have = b in left and left[b] - (b == w) - (b == k) > 0
                    if three or not have or (len(over) > 1 and over[0] + over[1] <= c):
                        break
                    fix(w, k, b)
                changed = True
            if w < capacity // 2 and not changed:
                break  # smaller lengths leave room for many pieces: no rule holds
    return fixed, left


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing on lengths with multiplicities: (lengths, how many equal sequences)."""
    room: dict[int, list[list]] = {}  # free space -> groups [lengths, how many]
    spaces: list[int] = []

    def put(space: int, ws: tuple[int, ...], n: int) -> None:
        if space not in room:
            room[space] = []
            insort(spaces, space)
        for g in room[space]:
            if g[0] == ws:
                g[1] += n
                return
        room[space].append([ws, n])

    for w in sorted(counts, reverse=True):
        n = counts[w]
        while n:
            at = bisect_left(spaces, w)
            if at == len(spaces):  # new sequences, each filled with this length as best fit would
                per = capacity // w
                if n >= per:
                    put(capacity - per * w, (w,) * per, n // per)
                if n % per:
                    put(capacity - (n % per) * w, (w,) * (n % per), 1)
                break
            space = spaces[at]
            group = room[space][-1]
            per = space // w  # after the first piece, the same sequence stays the fullest with room
            if n >= per:
                take = min(group[1], n // per)
            else:
                take, per = 1, n
            group[1] -= take
            n -= take * per
            ws = group[0] + (w,) * per
            if not group[1]:
                room[space].pop()
                if not room[space]:
                    del room[space]
                    del spaces[at]
            put(space - per * w, ws, take)
    return [(ws, n) for groups in room.values() for ws, n in groups]


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, end rank, first sequence, offset): each piece's place by its rank within its length."""
    fixed, left = reduce_profile(counts, capacity)
    used: dict[int, int] = {}
    rows, base = [], 0
    for ws, n in fixed + best_fit(left, capacity):
        if n:
            at = 0
            for w in ws:
                lo = used.get(w, 0)
                rows.append((w, lo, lo + n, base, at))
                used[w] = lo + n
                at += w
            base += n
    return rows


def pack(pieces: DataFrame, capacity: int = 1024) -> DataFrame:
    """Adds sequence_id and offset to a table of pieces with a column ``length``."""
    spark = pieces.sparkSession
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most `capacity` rows
    spans = [(w, lo, hi, base, lo, offset) for w, lo, hi, base, offset in plan(counts, capacity)]
    ranked = gapless_rank(pieces, ["length"], ["id", "piece"], "rank", shuffle_partitions(spark))
    placed = place_by_rank(ranked, "length", "rank", spans, ["base", "lo", "offset"])
    return placed.withColumn("sequence_id", F.col("base") + F.col("rank") - F.col("lo")).drop("rank", "lo", "base")


def pack_documents(docs: DataFrame, path: str, capacity: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset) of every piece of every document."""
    pieces = materialize(token_pieces(docs, path, capacity, end_id, id_col, text_col), "pack-pieces")
    out = pack(pieces, capacity)
    return out.select(F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
