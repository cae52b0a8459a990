"""Operator 8: byte-pair encoding and decoding with batched numpy merge rounds.

The symbols of many words lie in one flat array.  A round looks up every adjacent
pair of every unfinished word by binary search over the sorted pair keys of the merge
table, takes each word's lowest-rank pair and merges its occurrences from left to right; words
without a known pair are finished.  Words are the pieces of the pre-tokenizer, so a word
that was seen is not encoded again: a bounded cache per task holds its ids.  The pattern never spans white space, so a
run of other characters that was seen is not even cut into words again: a second cache holds the ids of such runs.
A round costs a word's whole length, so words of more than ``LONG`` symbols take their merges one by one from a heap of
ranks over linked positions, which touches only the pairs beside a merge; the ids are the same.

The tokenizer file is a parameter (``path``); its normalizer (NFC, white space, lower
case), pattern, suffix and added tokens are read from it.

Memory: rows are taken in chunks of at most ``CHUNK_BYTES`` of text (or one longer
text), and a cache holds at most twice ``CACHE_WORDS`` entries (none longer than ``CACHE_LENGTH`` characters), so a task's memory
does not grow with the table.  There is no shuffle: rows are independent, and a
lost executor recomputes its own part of the scan.

Defined results: a null or empty text has no ids, and the digest of the empty
string; repeated rows stay; very long texts and words are encoded whole; equal ranks go from the left; ids are kept as
they are; other columns of the input, whatever their names, are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import sys
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from tokenizers import Regex, normalizers, pre_tokenizers

CHUNK_BYTES = 2_000_000
CACHE_WORDS, CACHE_LENGTH = 400_000, 64
LONG = 400


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: printable Latin-1 characters
    stand for themselves, the others follow from U+0100 on in byte order."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = iter(range(256, 512))
    return [chr(b) if b in set(own) else chr(next(rest)) for b in range(256)]


@lru_cache
def ranges_of(category: str) -> str:
    """The inside of a character class for a general category, as the tokenizers library's own patterns see it
    (Python's Unicode tables are of another version)."""
    every = "".join(chr(i) for i in range(sys.maxunicode + 1) if not 0xD800 <= i < 0xE000)
    runs = pre_tokenizers.Split(Regex(r"\p{%s}+" % category), "removed", invert=True).pre_tokenize_str(every)
    return "".join(f"\\U{ord(s[0]):08x}-\\U{ord(s[-1]):08x}" for s, _ in runs)


#: Separators that str.split() takes for white space; they have no White_Space property (fixed values).
SEPARATORS = re.compile("[\x1c-\x1f]")
#: Characters with the property White_Space (fixed values).
WHITE_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


class WordBPE:
    """A BPE tokenizer file with word pattern, byte-level alphabet and optional word-end suffix."""

    def __init__(self, path: str):
        spec = json.load(open(path, encoding="utf-8"))
        model = spec["model"]
        self.lower = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()])
        self.suffix = model.get("end_of_word_suffix") or ""
        vocab = dict(model["vocab"])
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = re.compile("|".join(re.escape(t) for t in sorted(self.added, key=len, reverse=True)) or r"(?!)")
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        pattern = split["pattern"]["Regex"].replace(r"\s", WHITE_SPACE)
        for category in "LN":  # inside a class the ranges alone, elsewhere a class of their own
            name = r"\p{%s}" % category
            pattern = pattern.replace(f"[{name}]", name).replace(f"|{name}", f"|[{ranges_of(category)}]").replace(name, ranges_of(category))
        self.word = re.compile(pattern)
        self.gap = re.compile(f"[{WHITE_SPACE}]+")
        self.tokens = {i: t for t, i in vocab.items()} | {i: t for t, i in self.added.items()}
        alphabet = byte_alphabet()
        self.inner = np.array([vocab[c] for c in alphabet], dtype=np.int64)
        self.final = np.array([vocab[c + self.suffix] for c in alphabet], dtype=np.int64)
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.width = max(vocab.values()) + 1
        keys = np.array([vocab[a] * self.width + vocab[b] for a, b in merges], dtype=np.int64)
        keys, first = np.unique(keys, return_index=True)
        self.keys, self.ranks = keys, first.astype(np.int64)
        self.made = np.array([vocab[a + b] for a, b in merges], dtype=np.int64)[first]

    def normalize(self, text: str) -> str:
        """NFC and lower case by character; white space needs no step of its own, as the pattern leaves it out."""
        return text.lower() if text.isascii() else self.lower.normalize_str(text)

    def encode_long(self, word: str) -> list[int]:
        """Ids of one long word: the lowest-rank pair, leftmost first, from a heap; a merge looks at its two neighbours only."""
        raw = np.frombuffer(word.encode("utf-8", "surrogatepass"), dtype=np.uint8)
        first = self.inner[raw]
        first[-1] = self.final[raw[-1]]
        pair = first[:-1] * self.width + first[1:]
        at = np.searchsorted(self.keys, pair)
        at[at == len(self.keys)] = 0
        known = np.flatnonzero(self.keys[at] == pair)
        sym, n = first.tolist(), len(first)
        right, left = list(range(1, n + 1)), list(range(-1, n - 1))
        if not hasattr(self, "table"):
            self.table = dict(zip(self.keys.tolist(), zip(self.ranks.tolist(), self.made.tolist())))
        heap = list(zip(self.ranks[at[known]].tolist(), known.tolist(), pair[known].tolist()))
        heapq.heapify(heap)
        get, width = self.table.get, self.width
        while heap:
            _, i, key = heapq.heappop(heap)
            j = right[i]
            if sym[i] < 0 or j >= n or sym[i] * width + sym[j] != key:
                continue  # one of the two has been merged since
            sym[i], sym[j] = get(key)[1], -1
            k = right[i] = right[j]
            if k < n:
                left[k] = i
                new = sym[i] * width + sym[k]
                if (hit := get(new)) is not None:
                    heapq.heappush(heap, (hit[0], i, new))
            h = left[i]
            if h >= 0:
                new = sym[h] * width + sym[i]
                if (hit := get(new)) is not None:
                    heapq.heappush(heap, (hit[0], h, new))
        return [x for x in sym if x >= 0]

    def encode_words(self, words: list[str]) -> list[np.ndarray]:
        """Ids of each (non-empty, normalized) word: merge rounds over all words of normal length at once."""
        short = [w for w in words if len(w) <= LONG]
        if len(short) < len(words):
            ids = iter(self.encode_words(short) if short else [])
            return [next(ids) if len(w) <= LONG else np.array(self.encode_long(w), dtype=np.int64) for w in words]
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        lens = np.array([len(b) for b in raw], dtype=np.int64)
        data = np.frombuffer(b"".join(raw), dtype=np.uint8)
        sym = self.inner[data]
        ends = np.cumsum(lens) - 1
        sym[ends] = self.final[data[ends]]
        word = np.repeat(np.arange(len(words)), lens)
        done_sym, done_word = [], []
        far = np.iinfo(np.int64).max
        while len(sym):
            pair = sym[:-1] * self.width + sym[1:]
            at = np.searchsorted(self.keys, pair)
            at[at == len(self.keys)] = 0
            known = (self.keys[at] == pair) & (word[:-1] == word[1:])
            rank = np.append(np.where(known, self.ranks[at], far), far)
            start = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            size = np.diff(np.append(start, len(word)))
            low = np.repeat(np.minimum.reduceat(rank, start), size)
            live = low < far
            if not live.all():  # finished words leave the array
                done_sym.append(sym[~live])
                done_word.append(word[~live])
                sym, word, rank, low, at = sym[live], word[live], rank[live], low[live], np.append(at, 0)[live]
                if not len(sym):
                    break
            hit = rank == low
            # of touching occurrences of one pair (as in "aaa") every second one counts, from the left
            if (hit[1:] & hit[:-1]).any():
                begin = hit & ~np.r_[False, hit[:-1]]
                place = np.arange(len(hit))
                last = np.maximum.accumulate(np.where(begin, place, 0))
                hit &= (place - last) % 2 == 0
            left = np.flatnonzero(hit)
            sym = sym.copy()
            sym[left] = self.made[at[left]]
            keep = np.ones(len(sym), dtype=bool)
            keep[left + 1] = False
            sym, word = sym[keep], word[keep]
        if done_word:
            word, sym = np.concatenate(done_word), np.concatenate(done_sym)
            order = np.argsort(word, kind="stable")
            word, sym = word[order], sym[order]
        return np.split(sym, np.searchsorted(word, np.arange(1, len(words))))

    def runs(self, text: str) -> list[str]:
        """Runs between white space of a text without added tokens, normalized."""
        if text.isascii() and not SEPARATORS.search(text):
            return text.lower().split()
        return [r for r in self.gap.split(self.normalize(text)) if r]

    def pieces(self, text: str) -> list[str | int]:
        """Runs of a text in order; an added token is its id."""
        if not self.special.search(text):
            return self.runs(text)
        out, at = [], 0
        for m in self.special.finditer(text):
            out += self.runs(text[at : m.start()])
            out.append(self.added[m.group()])
            at = m.end()
        return out + self.runs(text[at:])


class Cache:
    """At most about twice ``limit`` entries: when the young half is full it becomes the old one, and what is used again comes back."""

    def __init__(self, limit: int):
        self.limit, self.young, self.old = limit, {}, {}

    def missing(self, keys: set) -> list:
        """Keys that have no entry; known ones are made young."""
        young = self.young
        if len(young) + len(keys) > self.limit:
            self.old, self.young = young, {}
            young = self.young
        out = []
        for k in keys:
            if k not in young:
                hit = self.old.get(k)
                if hit is None:
                    out.append(k)
                else:
                    young[k] = hit
        return out


class Encoder:
    """Bounded caches of words and of runs between white space: (number of ids, ids as decimal text, tokens as text)."""

    def __init__(self, bpe: WordBPE, limit: int = CACHE_WORDS):
        self.bpe, self.words, self.runs = bpe, Cache(limit), Cache(limit)

    def _words(self, needed: set[str]) -> dict:
        """Entries of words; those that the cache does not hold are encoded together."""
        new = self.words.missing(needed)
        name, known = self.bpe.tokens, self.words.young
        out = {w: known[w] for w in needed if w in known}
        for w, ids in zip(new, self.bpe.encode_words(new) if new else []):
            own = ids.tolist()
            out[w] = (len(own), " ".join(map(str, own)), " ".join([name[i] for i in own]))
            if len(w) <= CACHE_LENGTH:
                known[w] = out[w]
        return out

    def rows(self, texts: list[str]) -> Iterator[list[tuple[int, str, str]]]:
        """Of each text, the entries of its runs (a run without words has none)."""
        docs = [self.bpe.pieces(t) if t else [] for t in texts]
        used = set().union(*docs)
        new = self.runs.missing(used)
        known = self.runs.young
        cut = {r: self.bpe.word.findall(r) for r in new if isinstance(r, str)}
        words = self._words({w for ws in cut.values() for w in ws})
        long = {}
        for r in new:
            parts = [words[w] for w in cut[r]] if isinstance(r, str) else [(1, str(r), self.bpe.tokens[r])]
            entry = parts[0] if len(parts) == 1 else (sum([p[0] for p in parts]), " ".join([p[1] for p in parts]), " ".join([p[2] for p in parts]))
            (known if isinstance(r, int) or len(r) <= CACHE_LENGTH else long)[r] = entry
        get = ({**{r: known[r] for r in used if r in known}, **long} if long else known).__getitem__
        for d in docs:
            yield [e for e in map(get, d) if e[0]]


def text_chunks(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) for runs of rows of at most ``limit`` bytes, or one longer row; null counts as empty."""
    col = batch.column(batch.schema.get_field_index(column))
    size, at, texts = 0, 0, []
    for i, v in enumerate(col):
        t = v.as_py() or ""
        if texts and size + len(t) > limit:
            yield at, texts
            size, at, texts = 0, i, []
        texts.append(t)
        size += len(t)
    if texts:
        yield at, texts


_LOADED: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The tokenizer of a file, read once per worker."""
    if path not in _LOADED:
        _LOADED[path] = Encoder(WordBPE(path))
    return _LOADED[path]


def encode_digests(docs, path: str, id_col: str = "doc_id", text_col: str = "text"):
    """(id, n_tokens, ids_sha256, decoded_sha256) of every row."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        enc = encoder(path)
        for b in batches:
            ids = b.column(0)
            for at, texts in text_chunks(b, "text"):
                n, a, d = [], [], []
                for row in enc.rows(texts):
                    n.append(sum(e[0] for e in row))
                    a.append(hashlib.sha256(" ".join([e[1] for e in row]).encode()).hexdigest())
                    d.append(hashlib.sha256(" ".join([e[2] for e in row]).encode()).hexdigest())
                yield pa.RecordBatch.from_arrays([ids.slice(at, len(texts)), pa.array(n, pa.int64()), pa.array(a), pa.array(d)], ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    out = docs.selectExpr(f"`{id_col}` as id", f"`{text_col}` as text").mapInArrow(run, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("id", id_col)


def encode(docs, path: str, id_col: str = "doc_id", text_col: str = "text"):
    """(id, ids, decoded) of every row: the ids themselves and the text that they decode to."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        enc = encoder(path)
        for b in batches:
            for at, texts in text_chunks(b, "text"):
                rows = [(" ".join([e[1] for e in r]), " ".join([e[2] for e in r])) for r in enc.rows(texts)]
                ids = pa.array([list(map(int, a.split())) for a, _ in rows], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, len(texts)), ids, pa.array([d for _, d in rows])], ["id", "ids", "decoded"])

    out = docs.selectExpr(f"`{id_col}` as id", f"`{text_col}` as text").mapInArrow(run, f"id {kind}, ids array<int>, decoded string")
    return out.withColumnRenamed("id", id_col)
