import random

from riskfeat.llm import rules
from tests.llm.conftest import ODD, frame


def plain(text):
    text = text or ""
    words, lines, seen, copies = [], [], set(), 0
    for line in text.split("\n"):
        for ch in "\t\x0b\x0c\r":
            line = line.replace(ch, " ") if ch != "\x0b" else line.replace(ch, " ")
        words += [w for w in line.split(" ") if w]
    for line in text.split("\n"):
        if line.strip(" \t\n\x0b\x0c\r"):
            copies += line in seen
            seen.add(line)
    windows = {}
    for i in range(len(words) - 4):
        windows.setdefault(tuple(words[i:i + 5]), []).append(i)
    covered = {p for at in windows.values() if len(at) > 1 for i in at for p in range(i, i + 5)}
    return len(words), sum(map(len, words)), sum(c in rules.SYMBOLS for c in text), copies, len(covered)


def test_counts_of_texts(spark):
    rng = random.Random(9)
    texts = ["".join(rng.choice(["a ", "b ", "c ", "a b c d e f ", "#", "é", "\n", "\t", "\x0b", "😀 ", "|x| "])
                     for _ in range(rng.randint(0, 60))) for _ in range(300)]
    texts += ["x " * 3000, "same line\nsame line\n same line\n\n \nsame line", None, "a b c d e a b c d e", "1 2 3 4 5 1 2 3 4 5 6 2 3 4 5 6"]
    got = rules.counted(frame(spark, [(i, t, "en", "a") for i, t in enumerate(texts)])).collect()
    for r in got:
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == plain(
            texts[r["doc_id"]]), texts[r["doc_id"]]


def test_cut_values_keep_their_leading_bits(spark):
    rows = spark.range(0, 100_000, 37).withColumn("v", rules.cut_bits("id")).collect()
    for r in rows:
        assert r["v"] <= r["id"] and r["id"] - r["v"] <= r["id"] / 64 and r["v"].bit_length() == r["id"].bit_length()
        assert r["id"] >= 128 or r["v"] == r["id"]


def test_thresholds_follow_groups_and_fall_back(spark):
    from pyspark.sql import functions as F

    rows = [("en", "a", v) for v in range(100)] + [("en", "b", 1000 + v) for v in range(3)] + [(None, None, 5)]
    sketch = spark.createDataFrame(rows, "lang string, source string, value bigint").withColumns(
        {"rate": F.lit("symbol_rate"), "n": F.lit(1).cast("bigint")})
    got = {(r["lang"], r["source"]): r["high_symbol_rate"] for r in rules.thresholds(sketch, 50).collect()}
    own = 74 + max(60, rules.FENCE * (74 - 24))
    lang = 77 + rules.FENCE * (77 - 25)
    every = 76 + rules.FENCE * (76 - 24)
    assert got == {("en", "a"): own, ("en", "b"): lang, (None, None): every}


def test_junk_goes_and_clean_texts_stay(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    rows = rules.judged(docs).where("NOT base_failed").join(labels, "doc_id").groupBy("quality", "kept").count().collect()
    n = {(r["quality"], r["kept"]): r["count"] for r in rows}
    assert n[1, True] > 0.99 * (n[1, True] + n.get((1, False), 0))
    assert n[0, False] > 0.9 * (n[0, False] + n.get((0, True), 0))


def test_odd_documents(odd, nothing):
    got = rules.judged(odd).collect()
    assert len(got) == len(ODD)
    for r in got:
        assert r["kept"] is not None and not (r["base_failed"] and r["kept"])
        assert r["base_failed"] or r["n_words"] >= 10
    assert next(r for r in got if r["doc_id"] == 6)["n_repeat_words"] == 30_000
    assert rules.judged(nothing).count() == 0


def test_each_rate_alone_rejects_an_outlier(spark):
    rng = random.Random(5)

    def words(n, size=5):
        return ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(size)) for _ in range(n)]

    rows = [(i, "\n".join(" ".join(words(20)) for _ in range(5)), "en", "a") for i in range(300)]
    again = words(6)
    rows += [(1000, " ".join(words(100, 12)), "en", "a"),  # long words
             (1001, " ".join(w + "#" for w in words(100, 4)), "en", "a"),  # a fifth symbols
             (1002, "\n".join(line for _ in range(6) for line in (" ".join(words(20)), "Menu")), "en", "a"),  # 5 of 12 lines
             (1003, " ".join([*again, *words(60), *again, *words(8)]), "en", "a")]  # 15 % of the words
    got = {r["doc_id"]: r for r in rules.judged(frame(spark, rows)).collect()}
    assert all(r["kept"] for i, r in got.items() if i < 1000)
    for i, name in zip(range(1000, 1004), rules.RATES):
        r = got[i]
        assert not r["base_failed"] and not r["kept"], name
        beyond = {k for k, (above, factor, below, _, _) in rules.RATES.items()
                  if not r[f"low_{k}"] <= r[above] * factor // r[below] <= r[f"high_{k}"]}
        assert beyond == {name}
