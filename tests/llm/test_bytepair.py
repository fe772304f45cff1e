import random
import time

import public_tokenizers
import pytest
import tiktoken

from riskfeat.llm import bytepair
from tests.llm.conftest import ODD

PATH = public_tokenizers.path(bytepair.VOCABULARY)


@pytest.fixture(scope="module")
def coder():
    return bytepair.TextCoder(PATH, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library(coder):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=coder.codec.ranks,
                             special_tokens={})


def agrees(coder, library, text):
    packed = coder.encode(text)
    assert list(memoryview(b"".join(packed)).cast("I")) == library.encode_ordinary(text), text[:80]
    assert coder.decode(packed) == text.encode()


def test_short_texts_agree_with_the_library(coder, library):
    rng = random.Random(5)
    bits = ["a", "e", "th", "er", "in", " ", "  ", "\n", "é", "ß", "中", "😀", "0", "²", "½", "Ⅷ", "\x1c", "\x85", " ",
            "'s", "'re", "_", "-", "!", "ing", "\t", "́", "ñ", "한", "‍", "\xa0", "zx", "qq", "0000", "<|endoftext|>"]
    for _ in range(4000):
        agrees(coder, library, "".join(rng.choice(bits) for _ in range(rng.randint(0, 50))))
    for _ in range(500):
        agrees(coder, library, "".join(chr(rng.choice((rng.randint(1, 0xD7FF), rng.randint(0xE000, 0x1FFFF)))) for _ in range(30)))


def test_long_pieces_agree_with_the_library(coder, library):
    rng = random.Random(6)
    for text in ("a" * 20_000, "ab" * 5_000, "=" * 5_000 + " " * 5_000 + "x", "é" * 3_000,
                 "".join(rng.choice("abcdeghinorstu") for _ in range(20_000))):
        agrees(coder, library, text)


@pytest.mark.parametrize("unit", ["=", "-", "_", " ", "é", "ab", "=-", "0"])
def test_a_megabyte_of_one_character(coder, library, unit):
    text = unit * (1_000_000 // len(unit.encode()))
    start = time.perf_counter()
    packed = coder.encode(text)
    assert time.perf_counter() - start < 20
    assert coder.decode(packed) == text.encode()
    small = unit * 3_001
    assert list(memoryview(b"".join(coder.encode(small))).cast("I")) == library.encode_ordinary(small)
    if unit == "=":
        data = text.encode()[:200_000]
        assert coder.codec._encode(data) == coder.codec.merge(data)


def test_long_merges_are_the_short_ones():
    codec, rng = bytepair.codec(PATH), random.Random(9)
    for _ in range(400):
        data = bytes(rng.choice(b"==-a\xc3\xa9 thein") for _ in range(rng.randint(1, 250)))
        assert codec._merge_long(data) == codec.merge(data)


def test_joins_that_do_not_settle_start_over(monkeypatch):
    monkeypatch.setattr(bytepair, "STEPS", 0)
    codec = bytepair.Codec(bytepair.codec(PATH).ranks)
    for text in ("=" * 777, "the thing in the inn" * 9):
        assert codec._encode(text.encode()) == codec.merge(text.encode())


@pytest.mark.parametrize("leaf", [1, 3, 16])
def test_joining_does_not_depend_on_where_texts_are_cut(leaf):
    whole = bytepair.codec(PATH)
    codec, rng = bytepair.Codec(whole.ranks, leaf), random.Random(leaf)
    for _ in range(500):
        data = bytes(rng.choice(b"aeinrst hog\xc3\xa9") for _ in range(rng.randint(2, 60)))
        cut = rng.randint(1, len(data) - 1)
        assert codec.join(codec.merge(data[:cut]), codec.merge(data[cut:])) == codec.merge(data) == codec._encode(data)


def test_documents_agree_with_the_library(spark, coder, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for r in docs.select("text").collect():
        agrees(coder, library, r["text"] or "")


def test_odd_documents_come_back(odd, nothing):
    out = bytepair.encoded(odd)
    assert "text" not in out.columns and out.columns[-2:] == ["_ids", "_n_tokens"]
    texts = out.select("doc_id", bytepair.decoded("_ids").alias("t"), "_n_tokens").collect()
    want = sorted((i is None, i or 0, (t or "").encode()) for i, t, _, _ in ODD)
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, bytes(r["t"])) for r in texts) == want
    assert all(r["_n_tokens"] == 0 for r in texts if not r["t"])
    assert bytepair.encoded(nothing).count() == 0
    digests = odd.select("doc_id", bytepair.digests().alias("d")).select("d.*").collect()
    assert len(digests) == len(ODD)


@pytest.mark.parametrize("closed_early", [False, True])
def test_a_task_leaves_nothing_remembered(closed_early):
    """Idle workers that kept their memos took an executor over its memory."""
    coder = bytepair._coder(PATH, public_tokenizers.PATTERN)

    def held():
        return sum(len(m) + len(m.old) for m in (coder.packed, coder.spelt, coder.codec._tree, coder.codec._window))

    def task():
        with bytepair._coding(PATH, public_tokenizers.PATTERN) as same:
            for _ in range(3):
                yield same.decode(same.encode("the things in the inn, zxqq"))

    running = task()
    next(running)
    assert held() > 0
    if closed_early:
        running.close()
    else:
        list(running)
    assert held() == 0
