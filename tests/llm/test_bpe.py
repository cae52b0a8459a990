import hashlib

import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from homeshift.llm import bpe
from llm_edge import EDGE

PATH = public_tokenizers.path("word_bpe_49k.json")
TOK = Tokenizer.from_file(PATH)
OWN = bpe.Encoder(bpe.WordBPE(PATH))


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def want(text):
    ids = TOK.encode(text or "", add_special_tokens=False).ids
    return len(ids), " ".join(map(str, ids)), TOK.decode(ids, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60) | st.text("aAhnt's \n,.!9½Σσǅİé́日<|endoftext>", max_size=60))
def test_any_text_equals_the_library(text):
    (row,) = OWN.rows([text])
    assert (sum(e[0] for e in row), " ".join(e[1] for e in row), " ".join(e[2] for e in row)) == want(text)


def test_small_cache_gives_the_same(spark):
    texts = [f"word{i} some other{i % 7} words" for i in range(200)]
    small = bpe.Encoder(bpe.WordBPE(PATH), limit=20)
    for lo in range(0, 200, 10):
        for t, row in zip(texts[lo:], small.rows(texts[lo : lo + 10])):
            assert " ".join(e[1] for e in row) == want(t)[1]
        assert len(small.runs.young) <= 60 and len(small.words.young) <= 60  # one chunk's words at most beyond the limit


def test_edge_rows(docs_of):
    got = sorted((str(r[0]), *r[1:]) for r in bpe.encode_digests(docs_of(EDGE), PATH).collect())
    assert got == sorted((str(i), n, sha(a), sha(d)) for i, t in EDGE for n, a, d in [want(t)])
    whole = sorted((str(r[0]), " ".join(map(str, r[1])), r[2]) for r in bpe.encode(docs_of(EDGE), PATH).collect())
    assert whole == sorted((str(i), a, d) for i, t in EDGE for _, a, d in [want(t)])


def test_empty_table(docs_of):
    assert bpe.encode_digests(docs_of([(1, "x")]).where("false"), PATH).count() == 0


def own(text):
    (row,) = OWN.rows([text])
    return sum(e[0] for e in row), " ".join(e[1] for e in row), " ".join(e[2] for e in row)


def test_every_code_point_beside_white_space_and_letters():
    """Every code point after a space (combining marks too), before one, and between letters."""
    import sys

    points = [chr(i) for i in range(sys.maxunicode + 1) if not 0xD800 <= i < 0xE000]
    for at in range(0, len(points), 4096):
        for form in ("a %s b\n", "x%sy\t")[: 2 if at < 0x40000 else 1]:  # between letters: the planes with assigned characters
            text = "".join(form % c for c in points[at : at + 4096])
            assert own(text) == want(text), hex(at)


def test_words_of_any_length():
    import random

    rng = random.Random(4)
    for n in (1, 399, 400, 401, 1000, 5000):
        for letters in ("ab", "etaoinshrdlu", "abcdefghijklmnopqrstuvwxyz", "aé日"):
            text = "".join(rng.choice(letters) for _ in range(n)) + " tail " + letters * (n // 3)
            assert own(text) == want(text)


def test_a_word_of_a_million_letters():
    import random
    import time

    rng = random.Random(1)
    text = "".join(rng.choice("acgtetaoinshrdlu") for _ in range(1_000_000))
    start = time.time()
    assert own(text) == want(text)
    assert time.time() - start < 60
    for cache in (OWN.runs, OWN.words):
        assert all(len(r) <= bpe.CACHE_LENGTH for half in (cache.young, cache.old) for r in half if isinstance(r, str))
