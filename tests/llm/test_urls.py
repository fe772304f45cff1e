import math
from collections import Counter

from pyspark.sql import functions as F

from riskfeat.llm import urls


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3:]
    end = min([rest.index(c) for c in "/?#" if c in rest] + [len(rest)])
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
    tail = rest[end:]
    return host, tail[:min([tail.index(c) for c in "?#" if c in tail] + [len(tail)])]


def rule(host, path):
    fits = []
    for _, text in urls.RULES:
        name, rest = text.split("/", 1)
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest):
            fits.append(text)
    return max(fits, key=len, default=None)


ODD = [None, "", "no scheme", "http://", "http://NET", "http://NET/", "HTTP://A.Net/x?y#z", "x://a.example.net/en/1",
       "x://example.net/en", "x://example.net/en/", "a://b://c.net/d", "http://org/fr/?q", "http://ä.ORG/fr/é", "http://x.com?/net/",
       "http://notexample.net/en/", "http://example.com/de/\n", "http://anet/", "http://é.Ünet.com/#/net/"]


def test_hosts_paths_and_rules(spark):
    df = spark.createDataFrame(list(enumerate(ODD)), "page_id bigint, url string")
    for r in urls.judged(df).collect():
        host, path = split(ODD[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule(host, path)), ODD[r["page_id"]]
        if r["rule"]:
            assert r["verdict"] == dict((t, v) for v, t in urls.RULES)[r["rule"]]
        assert r["verdict"] in ("allow", "block")


def chance(counts, gram, k):
    if k < 0:
        return 1 / urls.ALPHABET
    lower = chance(counts, gram, k - 1)
    context = gram[len(gram) - 1 - k:-1]
    after = {g[-1]: 0 for g in counts if g[len(g) - 1 - k:-1] == context}
    for g, n in counts.items():
        if g[len(g) - 1 - k:-1] == context:
            after[g[-1]] += n
    total, kinds = sum(after.values()), sum(n > 0 for n in after.values())
    return (after.get(gram[-1], 0) + kinds * lower) / (total + kinds) if total else lower


def test_scores_are_those_of_the_two_models(spark):
    rows = [("http://a.com/1", 1, False), ("http://a.com/2", 1, False), ("http://bad.b/", 0, False), ("http://c.com", 1, True),
            ("", None, False), ("http://bad.com/é😀", None, False)]
    df = spark.createDataFrame(rows, "url string, label int, held boolean")
    grams = {u: [(urls.START * urls.ORDER + u + urls.END)[i:i + urls.ORDER + 1] for i in range(len(u) + 1)] for u, _, _ in rows}
    models = [Counter(g for u, l, h in rows if l == label and not h for g in grams[u]) for label in (1, 0)]
    got = df.select("*", F.xxhash64("url").alias("a")).drop("label", "held").join(urls.scores(df), "a").collect()
    assert len(got) == len(rows)
    for r in got:
        if "😀" in r["url"]:
            continue  # split into halves of its code point on the JVM
        want = sum(math.log(chance(models[0], g, urls.ORDER) / chance(models[1], g, urls.ORDER)) for g in grams[r["url"]])
        assert r["size"] == len(grams[r["url"]]) and abs(r["score"] / urls.SCALE - want) < 1e-4


def test_cut_separates_held_urls(spark):
    rows = [(1, True, int(s * 1e6), 1) for s in (0.5, 0.7, 1.0)] + [(0, True, int(s * 1e6), 1) for s in (-1.0, 0.1)] + [
        (1, False, -9_000_000, 1), (None, True, 0, 1)]
    df = spark.createDataFrame(rows, "label int, held boolean, score bigint, size bigint")
    assert 0.1 < urls.calibrated(df) <= 0.5
    assert urls.calibrated(df.where("label = 1")) == 0.0


def test_model_learns_more_than_the_rules_say(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    got = urls.judged(pages)
    assert got.count() == pages.count()
    rest = {(r["tld"], r["verdict"]): r["count"] for r in got.where("rule IS NULL").groupBy(
        F.element_at(F.split("host", r"\."), -1).alias("tld"), "verdict").count().collect()}
    assert any(v == "allow" for _, v in rest) and any(v == "block" for _, v in rest)


def test_repeats_clashing_columns_and_nothing(spark):
    df = spark.createDataFrame([(1, "http://a.net/"), (1, "http://a.net/"), (None, "http://q.com/"), (2, None)],
                               "page_id bigint, url string").withColumns({c: F.lit(1) for c in ("host", "rule", "a", "_a", "score", "html")})
    got = urls.judged(df).collect()
    assert len(got) == 4 and {r["verdict"] for r in got if r["rule"] is None} == {"allow"}
    assert urls.judged(df.limit(0)).count() == 0
