import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from riskfeat.llm import simhash
from riskfeat.llm.common import components
from tests.llm.conftest import ODD, frame


def plain(text):
    """Fingerprint bit by bit."""
    words, spell = [], ""
    for ch in (text or "") + " ":
        if ch in " \t\n\x0b\x0c\r":
            if spell:
                words.append(spell)
            spell = ""
        else:
            spell += chr(ord(ch) + 32) if "A" <= ch <= "Z" else ch
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(values):
    """Least member of each value's component at 4 or fewer differing bits, by brute force."""
    x = np.array(values, dtype=np.uint64)
    near = np.bitwise_count(x[:, None] ^ x[None, :]) <= 4
    label = np.arange(len(x))
    while True:
        new = np.array([label[row].min() for row in near])
        if (new == label).all():
            return label
        label = new


def test_fingerprint_of_texts():
    rng = random.Random(1)
    for _ in range(200):
        text = "".join(rng.choice("abAB é\n\t\x0b 中") for _ in range(rng.randint(0, 80)))
        assert simhash.fingerprint(text.encode()) == plain(text)
    assert simhash.fingerprint(None) == simhash.fingerprint(b" \n") == 0
    assert simhash.fingerprint("Ä B".encode()) == plain("Ä B") != plain("ä b")


def test_every_near_pair_meets_at_an_anchor():
    rng = np.random.default_rng(2)
    x = rng.integers(0, 2**63, 400).astype(np.uint64) * 2 + rng.integers(0, 2, 400).astype(np.uint64)
    y = x.copy()
    for k in range(len(y)):
        for b in rng.choice(64, 4, replace=False):
            y[k] ^= np.uint64(1) << np.uint64(b)
    i, a, home = simhash.anchors(x)
    homes = {(k, v) for k, v, h in zip(i.tolist(), a.tolist(), home.tolist()) if h}
    assert len(homes) == 3 * len(x)
    j, b, _ = simhash.anchors(y)
    sent = set(zip(j.tolist(), b.tolist()))
    assert all(any((k, v) in sent for q, v in homes if q == k) for k in range(len(x)))
    assert len(sent) < 45 * len(y)


def test_links_connect_like_brute_force_whatever_the_tile(spark):
    rng = np.random.default_rng(3)
    values = set()
    for _ in range(60):
        v = int(rng.integers(0, 2**63)) * 2
        for _ in range(rng.integers(1, 9)):
            values.add(v)
            for b in rng.choice(64, rng.integers(1, 6), replace=False):
                v ^= 1 << int(b)
    values = sorted(values)
    want = classes(values)
    signed = np.array(values, dtype=np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(v,) for v in signed], "fp bigint")
    for limit in (4096, 1):
        got = {r["node"]: r["root"] for r in components(simhash.near_links(df, limit)).collect()}
        roots = [got.get(v, v) for v in signed]
        assert len(set(zip(want.tolist(), roots))) == len(set(want.tolist())) == len(set(roots))


def test_components_of_a_long_path(spark):
    path = [(k, k + 1) for k in range(40)] + [(100, 101), (101, 100), (7, 7)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(path, "a bigint, b bigint")).collect()}
    assert found == {**{k: 0 for k in range(41)}, 100: 100, 101: 100}


def test_odd_documents(spark, odd, nothing):
    got = simhash.near_duplicates(odd).collect()
    assert len(got) == len(ODD)
    by_text = {}
    for r in got:
        by_text.setdefault(r["doc_id"], set()).add((r["fp"], r["component_id"]))
    assert {c for _, c in by_text[1] | by_text[2] | by_text[3]} == {1}
    assert len(by_text[5]) == 1
    assert (0, 1) in by_text[None]  # no text, no id: linked to the empty ones
    assert simhash.near_duplicates(nothing).count() == 0


def test_one_of_each_group_stays(spark, odd, nothing):
    kept = simhash.first_of_group(odd)
    assert kept.columns == odd.columns
    ids = sorted((r["doc_id"] is None, r["doc_id"]) for r in kept.collect())
    assert [i for _, i in ids] == [1, 4, 5, 6, 7, 8, 9, None]
    assert simhash.first_of_group(nothing).count() == 0
    apart = frame(spark, [(None, "first of two texts that differ", "en", "a"),
                          (None, "quite another text with its own words", "en", "a"), (3, "third text, an id of its own", "en", "a")])
    assert simhash.first_of_group(apart).count() == 3


def test_copies_in_documents_are_found(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], plain(r["text"])) for r in docs.select("doc_id", "text").collect()]
    label = classes([f for _, f in rows])
    least = {}
    for (i, _), k in zip(rows, label):
        least[k] = min(least.get(k, i), i)
    got = {r["doc_id"]: (r["fp"] & (2**64 - 1), r["component_id"]) for r in simhash.near_duplicates(docs).collect()}
    assert got == {i: (f, least[k]) for (i, f), k in zip(rows, label)}
    assert docs.select(F.count("*")).first()[0] == len(got)


def test_rows_of_one_fingerprint_do_not_meet_in_one_task(spark):
    docs = frame(spark, [(i, None if i % 10 else f"text number {i} of its own words", "en", "a") for i in range(4000)])
    settings = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        found = simhash.near_duplicates(docs)
        held = [r["count"] for r in found.groupBy(F.spark_partition_id()).agg(
            F.count("*").alias("count"), F.max("component_id")).collect()]
        assert sum(held) == 4000 and max(held) <= 2 * 4000 / 16
        assert found.where("fp = 0").select("component_id").distinct().collect() == [(1,)]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
