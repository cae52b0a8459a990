import base64
import gzip
import hashlib
import random
from collections import Counter, defaultdict

import pytest

from homeshift.llm import warc

LONG = "<p>" + "x" * 300_000 + "é</p>"
PAGES = [
    (1, "http://a/", "same"), (2, "http://b/", "same"), (3, None, "same"), (4, "http://c/\r\nWARC-Type: warcinfo", "own"), (5, "http://d/", None), (6, "http://e/", ""),
    (7, "http://f/", "rep"), (7, "http://f/", "rep"), (7, "http://g/", "rep"), (None, "http://h/", "none"), (None, "http://h/", "none"),
    (8, "http://i/", "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 0\r\n\r\n\r\n\r\n"), (9, "http://j/", LONG), (10, "http://k/", LONG),
]


def pages_of(spark, rows, parts=3):
    schema = "page_id long, url string, html string, row int, id string, digest string, salt int, kind string"
    return spark.createDataFrame([(*r, 1, "x", "d", 2, "k") for r in rows], schema).repartition(parts)


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def expected(rows, min_bytes=0):
    best = defaultdict(list)
    for i, _, h in rows:
        best[h or ""].append(i)
    out = Counter()
    for h, ids in best.items():
        top = max((i for i in ids if i is not None), default=None)
        n = len(h.encode())
        if n < min_bytes:
            out.update((i, n, digest(h), "response", None) for i in ids)
            continue
        rest = list(ids)
        rest.remove(top)
        out.update([(top, n, digest(h), "response", None)] + [(i, n, digest(h), "revisit", top) for i in rest])
    return out


@pytest.mark.parametrize("min_bytes", [0, 4, 1000])
def test_round_trip(spark, min_bytes):
    got = warc.archive_round_trip(pages_of(spark, PAGES), min_bytes).collect()
    assert Counter(tuple(r) for r in got) == expected(PAGES, min_bytes)


def test_hot_payload_and_small_archives(spark, monkeypatch):
    rows = [(i, "u", "hot") for i in range(700)] + [(700 + i, "u", f"p{i % 40}") for i in range(300)]
    got = warc.archive_round_trip(pages_of(spark, rows, 7)).collect()
    assert Counter(tuple(r) for r in got) == expected(rows)


def test_payloads_and_urls_come_back(spark):
    rows = [r for r in PAGES if r[0] not in (7, None)]
    got = warc.read_archives(warc.write_archives(pages_of(spark, rows))).collect()
    assert {r["kind"] for r in got} == {"record"}
    assert {r["payload"].decode() for r in got if r["record_type"] == "response"} == {h or "" for _, _, h in rows}
    urls = {int(r["page_id"]): r["url"] for r in got}
    assert urls[3] is None and urls[4] == "http://c/%0D%0AWARC-Type: warcinfo" and urls[1] == "http://a/"


def test_empty_table(spark):
    assert warc.archive_round_trip(pages_of(spark, PAGES).where("false")).count() == 0


# ---------------------------------------------------------------- salvage

def records(n=12):
    rng = random.Random(5)
    return [warc.record(i, f"http://x/{i}", bytes(rng.randrange(256) for _ in range(200 + 50 * i)) + b"\r\n\r\nWARC/1.1\r\nno", None) for i in range(n)]


def read(data):
    ids, gaps, at = [], [], 0
    for kind, start, size, reason, rec in warc.salvage(data):
        assert start == at and size > 0  # every byte once, in order
        at = start + size
        ids.append(int(rec["page_id"])) if kind == "record" else gaps.append((start, size, reason))
    assert at == len(data)
    return ids, gaps


@pytest.mark.parametrize("pack", [warc.member, lambda r: r, lambda r: gzip.compress(r)])
def test_damage_of_every_kind_loses_only_the_damaged_record(pack):
    parts = [pack(r) for r in records()]
    whole = b"".join(parts)
    assert read(whole) == (list(range(12)), [])
    starts = [sum(map(len, parts[:i])) for i in range(13)]
    middle = (starts[5] + starts[6]) // 2
    for broken in (
        whole[:middle] + bytes([whole[middle] ^ 255]) + whole[middle + 1 :],  # a changed byte
        whole[:middle] + whole[middle + 7 :],  # bytes lost
        whole[:middle] + b"\x00" * 40 + whole[middle:],  # bytes put in
        whole[: starts[5]] + b"????" + whole[starts[5] + 4 :],  # the start of a record
    ):
        ids, gaps = read(broken)
        assert ids == [i for i in range(12) if i != 5]
        assert len(gaps) == 1 and gaps[0][0] == starts[5] and gaps[0][2]
    ids, gaps = read(whole[: starts[11] + 9])  # cut at the end
    assert ids == list(range(11)) and gaps[0][:2] == (starts[11], 9)
    ids, gaps = read(b"junk in front" + whole)
    assert ids == list(range(12)) and gaps[0][:2] == (0, 13)


def test_random_damage_never_makes_a_wrong_record():
    own = records()
    parts = [warc.member(r) for r in own]
    whole, rng = b"".join(parts), random.Random(9)
    for _ in range(60):
        data = bytearray(whole)
        for _ in range(rng.randrange(1, 5)):
            at = rng.randrange(len(data))
            data[at : at + rng.randrange(1, 30)] = bytes(rng.randrange(256) for _ in range(rng.randrange(0, 40)))
        found = [rec for kind, *_, rec in warc.salvage(bytes(data)) if kind == "record"]
        assert len(found) >= 12 - 10
        for rec in found:
            assert rec["payload"] in own[int(rec["page_id"])]
        read(bytes(data))


def test_archives_as_files(spark, tmp_path):
    """Archive files, a damaged one among them, through Spark's binaryFile source."""
    parts = [warc.member(r) for r in records()]
    (tmp_path / "good.warc.gz").write_bytes(b"".join(parts))
    bad = bytearray(b"".join(parts))
    bad[len(parts[0]) + 30] ^= 1
    (tmp_path / "bad.warc.gz").write_bytes(bytes(bad))
    (tmp_path / "empty.warc.gz").write_bytes(b"")
    got = warc.read_archives(spark.read.format("binaryFile").load(str(tmp_path)).select("path", "content"), payloads=False)
    kinds = Counter((r["path"].rsplit("/", 1)[1], r["kind"]) for r in got.collect())
    assert kinds == {("good.warc.gz", "record"): 12, ("bad.warc.gz", "record"): 11, ("bad.warc.gz", "gap"): 1}
