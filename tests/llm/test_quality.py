import math
import zlib

import numpy as np

from riskfeat.llm import quality
from tests.llm.conftest import ODD, frame


def test_learns_single_features_and_interactions():
    rng = np.random.default_rng(7)
    x = rng.uniform(-1, 1, (6000, 4))
    y = ((x[:, 0] > 0.3) | (x[:, 1] * x[:, 2] > 0)).astype(float)
    model = quality.train(x[:4000], y[:4000])
    right = ((model.score(x[4000:]) > 0.5) == y[4000:]).mean()
    assert right > 0.9
    assert {frozenset(p[:2]) for p in model.pairs} >= {frozenset((1, 2))}
    order = rng.permutation(4000)
    again = quality.train(x[:4000][order], y[:4000][order])
    assert np.array_equal(again.score(x[4000:]), model.score(x[4000:]))


def test_scores_are_sums_of_table_entries():
    rng = np.random.default_rng(8)
    x, y = rng.normal(size=(500, 3)), rng.integers(0, 2, 500).astype(float)
    model = quality.train(x, y, rounds=5, pair_rounds=3)
    for row, score in zip(x[:20], model.score(x[:20])):
        total = model.intercept + sum(t[sum(v >= e for e in edges)] for v, edges, t in zip(row, model.edges, model.tables))
        total += sum(t[sum(row[a] >= e for e in model.coarse[a]), sum(row[b] >= e for e in model.coarse[b])]
                     for a, b, t in model.pairs)
        assert abs(score - 1 / (1 + np.exp(-total))) < 1e-9


def test_without_two_labels_the_prior_decides():
    assert quality.train(np.empty((0, 3)), np.empty(0)).score(np.zeros((2, 3))).tolist() == [0.5, 0.5]
    assert (quality.train(np.zeros((9, 3)), np.ones(9)).score(np.zeros((1, 3))) > 0.9).all()


def test_held_out_rows_are_told_apart(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.scored(docs.where(quality.held_out()), quality.fit(docs, labels)).join(labels, "doc_id").select(
        "score", "quality").collect()
    right = sum((r["score"] >= quality.CUT) == (r["quality"] == 1) for r in rows)
    assert right > 0.97 * len(rows) > 300


def test_odd_documents(spark, odd, nothing):
    labels = spark.createDataFrame([(4, 1), (5, 0), (6, 0), (7, None), (None, 1), (9, 5), (777, 1)], "doc_id bigint, quality int")
    model = quality.fit(odd, labels)
    got = quality.scored(odd, model, "s").collect()
    assert len(got) == len(ODD) and all(0 <= r["s"] <= 1 for r in got)
    assert quality.accepted(odd, labels).columns == odd.columns
    none = quality.fit(nothing, labels.limit(0))
    assert quality.scored(nothing, none, "s").count() == 0
    assert {r["s"] for r in quality.scored(odd, none, "s").collect()} == {0.5}
    few = quality.fit(frame(spark, [(i, f"text {i}", "en", "a") for i in range(50)]),
                      spark.createDataFrame([(i, i % 2) for i in range(50)], "doc_id bigint, quality int"), fit_rows=10)
    assert np.isfinite(few.intercept)


def test_the_sample_is_bounded_whatever_repeats(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(quality, "train", lambda x, y: seen.append((len(x), y)))
    copies = frame(spark, [(i % 3, f"text {i % 3}", "en", "a") for i in range(900)])
    labels = spark.createDataFrame([(i % 3, i % 2) for i in range(900)], "doc_id bigint, quality int")
    quality.fit(copies, labels, fit_rows=100)
    ids = [i for i in range(3) if zlib.crc32(str(i).encode()) % 5]
    assert seen.pop()[0] == 2 * len(ids)  # each id once with either label
    many = frame(spark, [(1, f"text number {i}", "en", "a") for i in range(900)])
    quality.fit(many, labels, fit_rows=100)
    assert seen.pop()[0] == 100
    wide = spark.createDataFrame([(i, i % 2) for i in range(900)], "doc_id bigint, quality int")
    quality.fit(frame(spark, [(i, f"text {i}", "en", "a") for i in range(900)]), wide, fit_rows=100)
    assert seen.pop()[0] == 100


def plain_features(text):
    """The features of an ASCII text, counted one by one."""
    words, lines = text.split(), [x for x in text.split("\n") if x.strip()]
    n, size = len(words), len(text)
    if not n:
        return [0.0] * len(quality.FEATURES)

    def share(test):
        return sum(map(test, text)) / size

    letters = sum(map(str.isalpha, text))
    often = max(words.count(w) for w in words)
    return [
        math.log(1 + n), sum(map(len, words)) / n, share(lambda c: c in "#*$%&|<>"), letters / size, share(str.isdigit),
        sum(map(str.isupper, text)) / max(letters, 1), text.count("!") / n, text.count("|") / n,
        sum(x in lines[:i] for i, x in enumerate(lines)) / len(lines), len(set(words)) / n ** 0.8,
        math.log(1 + n / len(lines)), sum(x.rstrip()[-1] in ".!?:" for x in lines) / len(lines),
        sum(len(w) <= 3 for w in words) / n, share(lambda c: not c.isalpha() and c not in " \n"), often / n,
    ]


TEXTS = [
    "One two three.", "a bb  ccc\ndddd!\n\n  \ndddd!\na bb  ccc", "#tag | bar ! 12 Ab\nAb?", "", " \n ", "|", "x" * 5000 + " y " * 3000,
    "Is it:\nyes.\nyes. \nNO", "12345 67 $%& <b>", "\tTab\tseparated\twords.",
]


def test_features_and_spark_scores_equal_plain_counting(spark):
    for text in TEXTS:
        assert np.allclose(quality.features_of(text.encode()), plain_features(text), atol=1e-12), text[:40]
    docs = frame(spark, [(i, t, "en", "a") for i, t in enumerate(TEXTS * 20)]).repartition(7)
    labels = spark.createDataFrame([(i, int(len(t) % 2)) for i, t in enumerate(TEXTS * 20)], "doc_id bigint, quality int")
    learnt = [i for i in range(len(TEXTS) * 20) if zlib.crc32(str(i).encode()) % 5]
    x = np.array([plain_features(TEXTS[i % len(TEXTS)]) for i in learnt])
    want = quality.train(x, np.array([len(TEXTS[i % len(TEXTS)]) % 2 for i in learnt], dtype=float))
    got = {r["doc_id"]: r["s"] for r in quality.scored(docs, quality.fit(docs, labels), "s").collect()}
    for i, t in enumerate(TEXTS * 20):
        assert abs(got[i] - want.score(np.array([plain_features(t)]))[0]) < 1e-6
