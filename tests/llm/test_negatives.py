import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskfeat.llm import negatives

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, every=50):
    held = []
    for i, v, label in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        ints = [math.floor(256 * float(np.float32(x))) for x in v]
        held.append((i, ints, (label + 1) % 10 if i is not None and i % 7 == 0 else label))
    top, out = 2**63 - 1, []
    place = lambda r: (-r[0], r[1] is None, r[1] or 0)
    for n, (i, a, label) in enumerate(held):
        if i is None or i % every:
            continue
        scored = [(max(-top, min(top, sum(x * y for x, y in zip(a, b)))), j, m)
                  for k, (j, b, m) in enumerate(held) if k != n]
        for ps, j, _ in sorted([r for r in scored if r[2] == label], key=place)[:5]:
            fits = sorted([r for r in scored if r[2] != label and 50 * ps <= 100 * r[0] <= 95 * ps], key=place)[:3]
            out += [(i, j, k, other, ps, ns) for k, (ns, other, _) in enumerate(fits, 1)]
    return sorted(out, key=repr)


def check(spark, rows, every=50):
    got = negatives.hard_negatives(spark.createDataFrame(rows, SCHEMA), every)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    got = sorted((tuple(r) for r in got.collect()), key=repr)
    assert got == brute(rows, every)
    return got


def some(seed, n, size=16):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((6, size))
    return [(int(i), (centres[i % 6] + rng.standard_normal(size) * 0.7).tolist(), int(rng.integers(0, 4))) for i in range(n)]


@pytest.mark.parametrize("n,k,m", [(1, 1, 1), (33, 33, 33), (64, 64, 64), (100, 37, 211), (5, 300, 70), (0, 4, 3)])
def test_strassen_is_exact(n, k, m):
    rng = np.random.default_rng(n + k + m)
    for top in (300, 2**40, 2**62):
        a, b = rng.integers(-top, top, (n, k)), rng.integers(-top, top, (k, m))
        assert np.array_equal(negatives.strassen(a, b), a @ b)  # both modulo 2^64


def test_like_brute_force(spark):
    assert len(check(spark, some(1, 700))) > 50
    assert len(check(spark, some(2, 300), every=3)) > 300


def test_many_strips(spark, monkeypatch):
    monkeypatch.setattr(negatives, "TILE", 8)
    monkeypatch.setattr(negatives, "STRIP_BYTES", 8 * 8 * 16)
    monkeypatch.setattr(negatives, "STRIP_WORK", 1)
    check(spark, some(3, 220), every=3)


def test_heaps_keep_the_first_of_equals():
    rng = random.Random(4)
    heap, seen = negatives.Heaps(2, 3), [[], []]
    for t in range(40):
        n = rng.randrange(1, 5)
        rows, s = np.sort(np.array([rng.randrange(2) for _ in range(n)])), np.array([rng.randrange(4) for _ in range(n)])
        ids = np.arange(n) + 10 * t
        for r, x, i in zip(rows, s, ids):
            seen[r].append((-x, i))
        heap.push(rows, s, ids, np.ones(n, bool))
    for r in range(2):
        assert [(-s, i) for s, i in zip(heap.score[r], heap.id[r])] == sorted(seen[r])[:3]


def test_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    base = [1.0, 0.5, 0.25]
    rows = [(0, base, 1), (0, base, 1), (50, base, 1), (1, None, 1), (2, [], 1), (3, [nan, 1.0], 1), (4, [inf], 1),
            (5, [None, 1.0], 1), (6, base, None), (None, base, 1), (None, [0.9, 0.4], 2), (8, [0.9, 0.4], 2),
            (9, [0.9, 0.4], 2), (10, [0.7], 2), (11, [0.5, 0.5, 0.5, 9.0], 3), (7, [0.8, 0.3, 0.1], 0),
            (100, [], 2), (150, [-1.0, -1.0], 5), (12, [0.0, -0.0], 5)]
    assert check(spark, rows)
    df = spark.createDataFrame(rows, SCHEMA)
    clash = df.withColumns({c: F.lit(1) for c in ("node", "strip", "side", "k", "other", "score", "no_id", "rank", "windows")})
    assert sorted(map(tuple, negatives.hard_negatives(clash).collect()), key=repr) == brute(rows)


def test_scores_beyond_int64(spark):
    rows = [(0, [1e30, 1.0], 1), (50, [2e9, 0.0], 1), (1, [3e9, 0.0], 1), (2, [1e9, 5.0], 2), (3, [-1e30, 0.0], 2),
            (4, [1.5e9, 0.0], 2), (5, [1e20, 0.0], 1)]
    check(spark, rows)


def test_equal_vectors_and_a_hot_label(spark):
    rows = [(i, [1.0, 0.2], 1) for i in range(400)] + [(400 + i, [0.8, 0.1], 2) for i in range(60)]
    assert len(check(spark, rows)) > 50


def test_no_rows(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert negatives.hard_negatives(df).collect() == []
    assert check(spark, [(1, [1.0], 1), (2, [1.0], 1)]) == []
