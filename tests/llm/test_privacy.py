import hashlib
import random
import re

import pytest
from riskfeat.llm import privacy
from tests.llm.conftest import ODD, frame

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    doubled = [int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits))]
    return sum(doubled) % 10 == 0


def plain(text):
    spans = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    spans += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in CARD.finditer(text):
        digits = re.sub("[ -]", "", m.group())
        if 12 <= len(digits) <= 19 and luhn(digits):
            spans.append((m.start(), 2, m.end()))
    spans += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(re.findall("[0-9]", m.group())) <= 15]
    return sorted(spans)


def test_base_spans_are_those_of_the_patterns():
    rng, found = random.Random(4), 0
    for k in range(20_000):
        letters = "ab1240@@..-+ ()_%9é\n" if k % 3 else "4511 -+(1).25@a"
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 60)))
        want = plain(text)
        found += len(want)
        assert privacy.base_spans(text) == want, text
    assert found > 500


def test_long_runs_take_no_long():
    for text in ("a" * 200_000 + "@", "1" * 200_000, "1.1.1 " * 30_000, "@" * 200_000, "+1" + " (" * 100_000):
        assert privacy.base_spans(text) == []


def test_terms_that_give_an_entity_away_go(spark):
    rows = [(i, f"met agent zorblax today about matter {chr(97 + i)}{chr(110 - i)}q and wrote to zed@mail.org then", "en", "a")
            for i in range(5)]
    rows += [(10 + i, f"agent number {i} today about another matter and then", "en", "a") for i in range(60)]
    rows.append((90, "nobody said zorblax here", "en", "a"))
    docs = frame(spark, rows)
    found = {r["term"]: r["disclosure"] for r in privacy.term_disclosure(docs, floor=0.8).collect()}
    assert set(found) == {"met", "to", "wrote", "zorblax"}
    assert found["met"] == 1.0 and found["zorblax"] < 1.0
    got = {r["doc_id"]: r["found"] for r in privacy.sanitise(docs, floor=0.8).collect()}
    assert got[90]["spans"] == "term:12:19" and got[90]["clean_text"] == "nobody said <TERM> here"
    assert got[90]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    assert got[0]["clean_text"].startswith(" agent <TERM> today") and "<EMAIL>" in got[0]["clean_text"]
    assert got[0]["n_email"] == 1 and "email:" in got[0]["spans"]
    assert got[10]["spans"] == "" and got[10]["clean_text"] == rows[5][1]


def test_copies_are_no_evidence(spark):
    rows = [(i, "the very same note of somebody to zed@mail.org", "en", "a") for i in range(20)]
    rows += [(50 + i, f"unrelated text number {i}", "en", "a") for i in range(50)]
    assert privacy.term_disclosure(frame(spark, rows)).count() == 0


def test_many_terms_take_the_join(spark, monkeypatch):
    rows = [(i, f"met zorblax {chr(97 + i)} and zed@mail.org", "en", "a") for i in range(5)]
    rows += [(10 + i, f"and other text {i}", "en", "a") for i in range(40)] + [(99, None, None, None), (99, None, None, None)]
    docs = frame(spark, rows)
    want = sorted(map(str, privacy.sanitise(docs).collect()))
    monkeypatch.setattr(privacy, "BROADCAST_ROWS", 1)
    assert sorted(map(str, privacy.sanitise(docs).collect())) == want


def test_odd_documents(odd, nothing):
    out = privacy.sanitise(odd)
    name = "_found"  # found is taken
    got = out.select("doc_id", "text", f"{name}.*").collect()
    assert len(got) == len(ODD)
    for r in got:
        assert r["clean_text"] == r["text"] and r["n_email"] == r["n_card"] == 0
    assert privacy.cleaned(odd).columns == odd.columns
    assert privacy.sanitise(nothing).count() == privacy.cleaned(nothing).count() == 0


def test_cleaned_counts_characters_anew(spark):
    docs = frame(spark, [(1, "write to a@b.cd or 10.0.0.1 now", "en", "a"), (2, "nothing here", "en", "a")])
    got = {r["doc_id"]: r for r in privacy.cleaned(docs).collect()}
    assert got[1]["text"] == "write to <EMAIL> or <IP> now" and got[1]["n_chars"] == len(got[1]["text"])
    assert got[2]["text"] == "nothing here"


@pytest.mark.parametrize("zeros", [0, 1, 3_000, 4_100, 20_000])
def test_leading_zeros_of_any_number_are_an_address(zeros):
    pad = "0" * zeros
    for part, found in (("1", True), ("255", True), ("256", False), ("", zeros > 0), ("1000", False)):
        text = f"at {pad}{part}.{pad}2.3.4 end"
        spans = [s for s in privacy.base_spans(text) if s[1] == 1]
        assert [text[a:b] for a, _, b in spans] == ([f"{pad}{part}.{pad}2.3.4"] if found else []), (zeros, part)


def test_handles_short_names_and_scripts_without_spaces_are_terms(spark):
    telling = "@user4711 x_91 Li 李小龙 नमस्ते"
    rows = [(i, f"{telling} wrote to zed@mail.org on day {i}", "en", "a") for i in range(8)]
    rows += [(20 + i, f"somebody wrote on day {i % 8} about 李子 and 小 and {i}", "en", "a") for i in range(200)]
    got = {r["doc_id"]: r["found"]["clean_text"] for r in privacy.sanitise(frame(spark, rows)).collect()}
    assert all(got[i].split() == ["@", "wrote", "to", "<EMAIL>", "on", "day", str(i)] or
               got[i].replace("<TERM>", "").split() == ["@", "wrote", "<EMAIL>", "on", "day", str(i)] for i in range(8)), got[0]
    assert all(got[20 + i] == rows[8 + i][1] for i in range(200))


def test_terms_of_a_text_are_those_that_are_counted():
    rng = random.Random(7)
    for _ in range(3_000):
        text = "".join(rng.choice("aB1_ -.'İΣσं‍中国ไทé\n") for _ in range(rng.randint(0, 40)))
        found = list(privacy.terms(text, []))
        assert {w for _, _, w in found} == privacy._terms(text), text
        assert all(text[a:b].lower() == w for a, b, w in found)
        assert {i for i, c in enumerate(text) if c.isalnum()} <= {i for a, b, _ in found for i in range(a, b)}
