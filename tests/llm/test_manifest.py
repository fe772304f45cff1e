import random
import zlib
from collections import defaultdict
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from riskfeat.llm import manifest
from tests.llm.conftest import ODD, frame


def digest(text):
    return sha256(text.encode()).hexdigest()


def plain(rows):
    """Manifest rows of (doc_id, source, lang, n_chars, text), one tree after the other."""
    def leaf(row):
        return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))

    def tree(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            last = levels[-1]
            levels.append([digest("".join(last[i:i + 8])) for i in range(0, len(last), 8)])
        return levels

    def path(levels, at):
        for level in levels[:-1]:
            run = at // 8 * 8
            yield level[run:at], level[at + 1:run + 8]
            at //= 8

    groups = defaultdict(list)
    for row in rows:
        groups[row[2]].append(row)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[g] = tree([leaf(r) for r in groups[g]])
    top = tree([trees[g][-1][0] for g in order])
    for k, g in enumerate(order):
        for at, row in enumerate(groups[g]):
            steps = [*path(trees[g], at), *path(top, k)]
            changed = row
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0 and row[4] is not None:
                changed = (*row[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4]))
            folded = leaf(changed)
            for left, right in steps:
                folded = digest("".join([*left, folded, *right]))
            proof = digest("".join("".join([*left, *right]) for left, right in steps))
            yield row[0], leaf(row), trees[g][-1][0], top[-1][0], proof, folded, folded == top[-1][0]


def check(df):
    rows = [tuple(r) for r in df.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    got = manifest.manifest(df, tampered=manifest.lowered())
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    got = sorted((tuple(r) for r in got.collect()), key=repr)
    assert got == sorted(plain(rows), key=repr)
    return got


@pytest.mark.parametrize("n,langs", [(1, 1), (8, 1), (9, 1), (64, 1), (65, 2), (600, 70)])
def test_like_plain_trees(spark, n, langs):
    rng = random.Random(n)
    rows = [(i * 7 - 20, f"Text É {i}", f"l{rng.randrange(langs)}", rng.choice("ab")) for i in range(n)]
    got = check(frame(spark, rows))
    assert len({r[3] for r in got}) == 1
    changed = {r[0] for r in got if not r[6]}
    assert changed == {i for i, *_ in rows if zlib.crc32(str(i).encode()) % 3 == 0}


def test_odd_and_repeated_rows(spark, odd):
    check(odd)
    check(frame(spark, ODD * 9))


def test_one_row_repeated_spreads(spark):
    check(frame(spark, [(3, "Same", "en", "a")] * 700 + [(4, None, None, None)]))


def test_very_long_text(spark):
    check(frame(spark, [(3, "Ab é" * 1_000_000, "en", "a"), (6, "x", "en", None)]))


def test_no_rows(spark, nothing):
    assert manifest.manifest(nothing, tampered=manifest.lowered()).collect() == []


def test_paths_jump_past_what_is_broadcast(spark, monkeypatch):
    monkeypatch.setattr(manifest, "PATH_BYTES", 0)
    check(frame(spark, [(i, f"T{i}", "en" if i % 5 else None, "a") for i in range(700)]))


def test_untampered_rows_verify(spark):
    docs = frame(spark, [(i, f"T{i}", "en", "a") for i in range(30)])
    assert manifest.manifest(docs).where(~F.col("verified")).count() == 0
