import numpy as np
import pytest
from pyspark.sql import functions as F

from riskfeat.llm import vectors


def brute(rows):
    """vec_id -> (links, component) for distinct vec_ids."""
    sound = [(i, np.array(v, float) / np.linalg.norm(v), l) for i, v, l in rows
             if v and l is not None and None not in v and np.isfinite(np.array(v, float)).all() and np.any(np.array(v, float))]
    links = {i: [] for i, _, _ in rows}
    for k, (i, x, l) in enumerate(sound):
        for j, y, m in sound[:k]:
            if l == m and len(x) == len(y) and x @ y >= vectors.THRESHOLD:
                links[i].append(j)
                links[j].append(i)
    root = {i: i for i in links}
    for _ in root:
        for i, near in links.items():
            root[i] = min([root[i], *[root[j] for j in near]])
    return {i: (len(links[i]), root[i]) for i in links}


def clustered(seed, size, n):
    rng, rows = np.random.default_rng(seed), []
    for c in range(n):
        centre = rng.standard_normal(size)
        for _ in range(int(rng.integers(1, 25))):
            rows.append((len(rows), (centre + rng.standard_normal(size) * rng.choice([0, 0.08, 0.11])).astype(np.float32).tolist(), c % 3))
    return rows


@pytest.mark.parametrize("size,limit", [(64, 4096), (64, 3), (5, 4096), (2, 4096)])
def test_links_like_brute_force(spark, size, limit):
    rows = clustered(size, size, 20)
    want = brute(rows)
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    got = {r["vec_id"]: r for r in vectors.near_duplicates(df, limit).collect()}
    pairs = sum(n for n, _ in want.values())
    assert all(got[i]["n_links"] <= want[i][0] for i in want)
    assert sum(r["n_links"] for r in got.values()) >= 0.99 * pairs > 100
    assert sum(got[i]["component_id"] == want[i][1] for i in want) >= 0.99 * len(want)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got.values())


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(1)
    x, y = (vectors.unit(rng.standard_normal((4000, 64))) for _ in range(2))
    y = vectors.unit(x + 0.3 * y)
    turn = vectors.rotation(64, 0)
    code, factor = np.where(x @ turn > 0, 1.0, -1.0), np.abs(x @ turn).sum(axis=1) / 8
    guess = np.einsum("ij,ij->i", code, y @ turn) / (8 * factor)
    exact = np.einsum("ij,ij->i", x, y)
    spread = vectors.CONFIDENCE * np.sqrt(1 - factor ** 2) / factor / np.sqrt(63)
    assert abs((guess - exact).mean()) < 0.005
    assert (np.abs(guess - exact) <= spread).mean() > 0.999


def test_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, None, 1), (1, [], 1), (2, [0.0, 0.0], 1), (3, [nan, 1.0], 1), (4, [inf, 1.0], 1), (5, [None, 1.0], 1),
            (6, [1.0, 0.0], None), (7, [1.0, 0.0], 1), (8, [2.0, 0.0], 1), (9, [1.0, 0.0], 2), (10, [1.0, 0.0, 0.0], 1),
            (11, [-1.0, 0.0], 1), (12, [1e-30, 0.0], 1)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").withColumns(
        {c: F.lit(1) for c in ("node", "h1", "root", "n_links", "kept", "bucket")})
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in vectors.near_duplicates(df).collect()}
    assert got == brute(rows)
    assert vectors.near_duplicates(df.limit(0)).count() == 0


def test_equal_vectors_and_ids(spark):
    rows = [(5, [1.0, 2.0], 1)] * 3 + [(None, [1.0, 2.0], 1), (9, [3.0, 6.1], 1)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    got = sorted((r["vec_id"] or 0, r["n_links"], r["component_id"], r["kept"]) for r in vectors.near_duplicates(df).collect())
    assert got == [(0, 4, 5, False), (5, 4, 5, True), (5, 4, 5, True), (5, 4, 5, True), (9, 4, 5, False)]
