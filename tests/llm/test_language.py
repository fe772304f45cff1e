from collections import Counter

import numpy as np

from riskfeat.llm import language
from tests.llm.conftest import ODD, frame


def plain(text):
    folded = "".join(c.lower() if c.isalpha() and len(c.lower()) == 1 else (c if c.isalpha() else " ") for c in text)
    folded = f" {' '.join(folded.split())} "
    return Counter(folded[i:i + n] for n in language.GRAMS for i in range(len(folded) - n + 1) if folded[i:i + n] != " ")


def spelt(code):
    chars = []
    while code:
        chars.append(code & (1 << 21) - 1)
        code >>= 21
    return "".join(chr(c) if c else " " for c in reversed(chars))


def test_grams_of_texts(monkeypatch):
    texts = ["A b", "Où là-bas, ça", "x", "  so  many   words 12 so ", "中文字 and 😀 text", "abc" * 50]
    for slab in (1 << 20, 7):
        monkeypatch.setattr(language, "_SLAB", slab)
        for text in texts:
            codes, counts = language.grams(text)
            got = Counter()
            for c, n in zip(codes.tolist(), counts.tolist()):
                got[spelt(c).strip()] += n
            want = Counter()
            for g, n in plain(text).items():
                want[g.strip()] += n
            assert got == want, text
    assert language.grams("12 !") is language.grams("") is language.grams(None) is None


def test_each_gram_has_its_own_code(monkeypatch):
    for slab in (1 << 20, 7):
        monkeypatch.setattr(language, "_SLAB", slab)
        for text in ("the hat, a bath", "A b", "x", "中文字 and 😀 text"):
            codes, counts = language.grams(text)
            assert {spelt(c): n for c, n in zip(codes.tolist(), counts.tolist())} == dict(plain(text)), text


def test_out_of_place_distance():
    a, b = language.top(*language.grams("aaa aab"), 5), language.top(*language.grams("zzz zzy"), 5)
    judge = language.Judge({"a": a, "z": b}, 5)
    name, score = judge.predict("aaa aab")
    assert (name, score) == ("a", 1.0)
    own = language.top(*language.grams("bbb"), 5)
    away = [sum(abs(i - p.tolist().index(g)) if g in p else 5 for i, g in enumerate(own.tolist())) for p in (a, b)]
    name, score = judge.predict("bbb")
    assert name == "az"[int(np.argmin(away))] and abs(score - (1 - min(away) / (5 * len(own)))) < 1e-12


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language.profiles(docs.where(~language.held_out()))
    rows = language.predicted(docs.where(language.held_out()), found).select("lang", "guess.lang_pred").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) > 0.97 * len(rows) > 200


def test_odd_documents(spark, odd, nothing, monkeypatch):
    found = language.profiles(odd)
    assert set(found) == {"en", "fr", "und?"}
    got = language.predicted(odd, found, name="g").select("doc_id", "text", "g.*").collect()
    assert len(got) == len(ODD)
    for r in got:
        if r["text"] is None or not any(c.isalpha() for c in r["text"]):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        else:
            assert r["lang_pred"] in found and 0 <= r["score"] <= 1
    assert language.profiles(nothing) == {}
    assert {r["lang_pred"] for r in language.predicted(odd, {}, name="g").select("g.lang_pred").collect()} == {"und"}
    assert language.predicted(nothing, found, name="g").count() == 0
    monkeypatch.setattr(language, "_HELD", 3)  # partial counts given out early add up to the same
    same = language.profiles(frame(spark, ODD))
    assert {k: v.tolist() for k, v in same.items()} == {k: v.tolist() for k, v in found.items()}
