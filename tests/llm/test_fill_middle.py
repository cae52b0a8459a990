import hashlib
import random
import re

import pytest
import zstandard

from homeshift.llm import fill_middle as fm

from llm_edge import EDGE

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def expected(doc_id, text):
    """The contract, on whole strings."""
    text = text or ""
    units = UNIT.findall(text)
    n = len(units)
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return n, "plain", None, None, text, text
    form = "spm" if h4 % 100 < 80 else "psm"
    out = f"<S>{suf}<P>{pre}<M>{mid}" if form == "spm" else f"<P>{pre}<S>{suf}<M>{mid}"
    return n, form, len(pre), len(mid), out, text


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def rows_of(rows):
    out = []
    for i, t in rows:
        n, form, p, m, made, text = expected(i, t)
        out.append((i, n, form, p, m, sha(made), sha(text)))
    return sorted(out, key=str)


def texts(seed, count, alphabet="ab é日😀 \n\t<PSM>"):
    rng = random.Random(seed)
    return [(i, "".join(rng.choice(alphabet) for _ in range(rng.choice([0, 1, 2, 5, 40, 400])))) for i in range(count)]


@pytest.mark.parametrize("frame_bytes", [5, 17, 1 << 16])
def test_digests_equal_the_plain_version(docs_of, monkeypatch, frame_bytes):
    monkeypatch.setattr(fm, "FRAME_BYTES", frame_bytes)
    for rows in (texts(frame_bytes, 120), texts(1, 80, "x  \x1c\xa0")):
        for i, t in rows:  # the frames' own functions, without Spark
            pack, unpack = zstandard.ZstdCompressor(), zstandard.ZstdDecompressor()
            data = t.encode()
            text = fm.Frames(*fm.compress(data, pack), unpack)
            n, form, p, m, made, _ = expected(i, t)
            got, a, b = fm.plan(i, text, fm.Rules())
            assert (text.n_units, got) == (n, form)
            out = fm.collect_frames(fm.output(text, got, a, b, fm.Rules()), pack, unpack)
            assert b"".join(out.stream(0, out.n_bytes)) == made.encode()
            assert b"".join(fm.restore(out, got, fm.Rules())) == data
            if form != "plain":
                assert fm.code_points(text.stream(0, a)) == p and fm.code_points(text.stream(a, b)) == m


def test_every_cut_over_frame_borders(monkeypatch):
    monkeypatch.setattr(fm, "FRAME_BYTES", 7)
    pack, unpack = zstandard.ZstdCompressor(), zstandard.ZstdDecompressor()
    for text in ["ab cd  éé é\n\n日本 x ", "   ", " a", "aaaaaaaaaaaaaaaaaaaaaaaa b", "a b c d e f g h"]:
        frames = fm.Frames(*fm.compress(text.encode(), pack), unpack)
        units = UNIT.findall(text)
        assert frames.n_units == len(units)
        for k in range(len(units) + 1):
            assert frames.byte_after(k) == len("".join(units[:k]).encode())


def test_edge_rows_and_outputs(docs_of):
    rows = EDGE + texts(3, 60) + [(700, "<P> in it"), (701, "w " * 100_000 + "<M"), (702, "é" * 300_000), (703, " " * 200_000)]
    docs = docs_of(rows)
    got = sorted((tuple(r) for r in fm.fill_middle_digests(docs).collect()), key=str)
    assert got == rows_of(rows)
    made = fm.transform(fm.frame_store(docs)).collect()
    assert sorted(((r["id"], r["form"], r["output"]) for r in made), key=str) == sorted(((i, *(lambda e: (e[1], e[4]))(expected(i, t))) for i, t in rows), key=str)


def test_sentinels_between_frames_are_seen(monkeypatch):
    monkeypatch.setattr(fm, "FRAME_BYTES", 5)
    pack, unpack = zstandard.ZstdCompressor(), zstandard.ZstdDecompressor()
    for at in range(1, 12):
        text = fm.Frames(*fm.compress(("x" * at + "<S>" + "y" * 9).encode(), pack), unpack)
        assert fm.holds_any(text, [b"<P>", b"<S>", b"<M>"])


def test_empty_table(docs_of):
    assert fm.fill_middle_digests(docs_of([(1, "x")]).where("false")).count() == 0
