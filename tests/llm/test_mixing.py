from collections import Counter, defaultdict

import pytest

from riskfeat.llm import mixing
from tests.llm.conftest import ODD, frame


def shared(sizes, weights=(5, 2, 1), epochs=3):
    """Targets by resharing the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    budget, target, open_ = sum(sizes.values()), {}, set(names)
    left = budget
    while open_:
        unit = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if epochs * sizes[s] < unit * weight[s]]
        if not full:
            return target | {s: unit * weight[s] for s in open_}
        for s in full:
            target[s] = epochs * sizes[s]
            left -= target[s]
            open_.discard(s)
    return target


@pytest.mark.parametrize("sizes", [
    {"a": 10, "b": 10, "c": 10}, {"a": 1, "b": 1000, "c": 5, "d": 7, None: 3}, {"a": 0, "b": 50}, {"x": 9},
    {"a": 1, "b": 2, "c": 4000, "d": 1, "é": 100, "z": 50, "": 3}])
def test_targets_reshare_the_excess(spark, sizes):
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size bigint")
    got = {r["source"]: r["target"] for r in mixing.targets(df).collect()}
    want = shared(sizes)
    assert set(got) == set(want)
    assert all(abs(got[s] - want[s]) < 1e-6 for s in want)


@pytest.mark.parametrize("stretch", [5000, 3])
def test_sources_come_near_their_targets(spark, stretch):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sizes = mixing.document_sizes(docs)
    rows = mixing.mix(sizes, rows_a_stretch=stretch).collect()
    taken, target, longest = Counter(), {}, defaultdict(int)
    for r in rows:
        assert r["taken"] in (0, r["size"], 2 * r["size"], 3 * r["size"])
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        longest[r["source"]] = max(longest[r["source"]], r["size"])
    assert all(abs(taken[s] - target[s]) <= longest[s] for s in target)
    assert sum(taken.values()) <= sum(r["size"] for r in rows)
    again = {r["doc_id"]: r["taken"] for r in mixing.mix(sizes.repartition(3)).collect()}
    assert again == {r["doc_id"]: r["taken"] for r in rows}


def test_odd_documents(spark, odd, nothing):
    rows = mixing.mix(mixing.document_sizes(odd)).collect()
    assert len(rows) == len(ODD)
    assert all(r["taken"] == 0 for r in rows if r["size"] == 0)
    taken = sum(r["copies"] for r in rows)
    out = mixing.mixed(odd)
    assert out.columns == odd.columns
    assert out.count() == sum(r["copies"] for r in rows if r["size"]) == taken
    assert mixing.mix(mixing.document_sizes(nothing)).count() == mixing.mixed(nothing).count() == 0
    empty = frame(spark, [(1, None, "en", "a"), (2, "", "en", None)])
    assert {r["taken"] for r in mixing.mix(mixing.document_sizes(empty)).collect()} == {0}
