"""URL filter: host and path rules first, a character language-model ratio for the rest.

Rules label URLs. Over the distinct labelled URLs two variable-order Markov
models are counted, one of accepted and one of rejected URLs: the chance of a
character after up to ``ORDER`` others is interpolated with that after one
fewer (Witten-Bell), down to a uniform chance. A URL's score is the difference
of its log-likelihoods per character. The cut is calibrated on labelled URLs
that the models have not seen.

Only DataFrame operations. Longest-context grams are counted once over all
URLs; shorter ones are sums of those, so the corpus is read once for counting.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskfeat.operators.lookup import attach
from riskfeat.session import cut_lineage

#: Fixed rules: verdict, host and path up to which a URL must agree.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
ORDER = 4
ALPHABET = 256  # characters among which the last resort divides its chance
START, END = "\x02", "\x03"
SCALE = 1_000_000  # log ratios are summed as whole millionths: the order of summing does not matter
CALIBRATION = 5  # one labelled URL in so many sets the cut
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

Rules = Sequence[tuple[str, str]]


def host(url: str = "url") -> Column:
    """After the first :// up to /, ?, # or the end, A-Z in lower case; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path(url: str = "url") -> Column:
    """After the host up to ?, # or the end; empty without ://."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host_: Column, path_: Column, rules: Rules = RULES) -> Column:
    """The longest rule that fits: its host or a subdomain, and a path that starts with its path."""
    found = F.lit(None).cast("string")
    for _, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):  # the longest is asked first
        name, _, rest = text.partition("/")
        fits = ((host_ == name) | host_.endswith(f".{name}")) & path_.startswith(f"/{rest}")
        found = F.when(fits, F.lit(text)).otherwise(found)
    return found


def _verdict_of(rule: Column, rules: Rules) -> Column:
    found = F.lit(None).cast("string")
    for verdict, text in rules:
        found = F.when(rule == text, F.lit(verdict)).otherwise(found)
    return found


def grams(urls: DataFrame, order: int = ORDER) -> DataFrame:
    """A row (all columns but url, gram) for each character of each URL and its end: the gram of ``order`` + 1."""
    rest = [c for c in urls.columns if c != "url"]
    chars = F.concat(F.array_repeat(F.lit(START), order), F.array_remove(F.split("url", ""), ""), F.array(F.lit(END)))
    spelt = urls.select(*rest, chars.alias("_chars"))
    size = F.size("_chars") - order
    shifted = spelt.select(*rest, F.explode(F.arrays_zip(*[
        F.slice("_chars", k + 1, size).alias(f"c{k}") for k in range(order + 1)])).alias("_g"))
    return shifted.select(*rest, F.concat(*[F.col(f"_g.c{k}") for k in range(order + 1)]).alias("gram"))


def log_ratios(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """(gram, ratio, n): log of accepted over rejected chance in millionths, from (gram, accept, reject, n)."""
    tables = [counts.select("gram", "accept", "reject")]
    for k in range(order, 0, -1):  # sums over the first character give the next shorter context
        tables.append(tables[-1].groupBy(F.substring("gram", 2, k).alias("gram")).agg(
            F.sum("accept").alias("accept"), F.sum("reject").alias("reject")))
    known = None
    for k, table in enumerate(reversed(tables)):
        table = table.withColumn("_context", F.substring("gram", 1, k)).withColumn("_shorter", F.substring("gram", 2, k))
        contexts = table.groupBy("_context").agg(*[e for c in ("accept", "reject") for e in (
            F.sum(c).alias(f"{c}_n"), F.count(F.when(F.col(c) > 0, 1)).alias(f"{c}_kinds"))])
        table = table.join(contexts, "_context")
        if known is None:
            table = table.withColumns({f"{c}_p": F.lit(1.0 / ALPHABET) for c in ("accept", "reject")})
        else:
            table = table.join(known, "_shorter")
        chances = [F.when(F.col(f"{c}_n") > 0, (F.col(c) + F.col(f"{c}_kinds") * F.col(f"{c}_p")) / (
            F.col(f"{c}_n") + F.col(f"{c}_kinds"))).otherwise(F.col(f"{c}_p")).alias(f"{c}_p") for c in ("accept", "reject")]
        last = table.select("gram", *chances)
        known = last.withColumnRenamed("gram", "_shorter")
    return last.join(counts.select("gram", "n"), "gram").select(
        "gram", F.round((F.log("accept_p") - F.log("reject_p")) * SCALE).cast("bigint").alias("ratio"), "n")


def scores(urls: DataFrame, order: int = ORDER) -> DataFrame:
    """(a, b, label, held, *others, score, size) of distinct ``urls`` (url, label, held, *others); a and b identify the URL.

    score is the summed log ratio in millionths, size the number of summands.
    label is 1 for accepted, 0 for rejected, NULL for others; held rows and
    those without a label add nothing to the counts but are scored.
    """
    kept = ["a", "b", *[c for c in urls.columns if c != "url"]]
    keyed = urls.withColumns({"a": F.xxhash64("url"), "b": F.xxhash64(F.lit("url"), F.col("url"))})
    spelt = grams(keyed, order)
    learnt = ~F.col("held")
    counts = cut_lineage(spelt.groupBy("gram").agg(
        F.count(F.when(learnt & (F.col("label") == 1), 1)).alias("accept"),
        F.count(F.when(learnt & (F.col("label") == 0), 1)).alias("reject"), F.count("*").alias("n")))
    ratios = cut_lineage(log_ratios(counts, order))
    found = attach(spelt.select(*kept, "gram"), ratios, "gram", weight="n")
    return found.groupBy(*kept).agg(
        F.sum("ratio").alias("score"), F.count("*").alias("size"))


def calibrated(scored: DataFrame, bins_a_unit: int = 100, reach: int = 20) -> float:
    """Cut on score per character that best tells held labelled URLs apart.

    Youden's index over a histogram of ``bins_a_unit`` bins per unit within
    +-``reach``, whose size does not depend on the data; in the middle of the
    best stretch. Without held URLs of both kinds the cut is 0.
    """
    place = F.floor(F.greatest(F.least(F.col("score") / F.col("size") / SCALE, F.lit(float(reach))),
                               F.lit(-float(reach))) * bins_a_unit)
    rows = scored.where("held AND label IS NOT NULL").groupBy(place.alias("bin")).agg(
        F.count(F.when(F.col("label") == 1, 1)).alias("good"), F.count(F.when(F.col("label") == 0, 1)).alias("bad")).collect()
    good, bad = sum(r["good"] for r in rows), sum(r["bad"] for r in rows)
    if not good or not bad:
        return 0.0
    counts = {r["bin"]: (r["good"], r["bad"]) for r in rows}
    best, stretch, passed_good, passed_bad = -1.0, (0, 0), good, bad
    first = min(counts)
    for cut in range(first, max(counts) + 2):
        g, b = counts.get(cut - 1, (0, 0))
        passed_good, passed_bad = passed_good - g, passed_bad - b
        index = passed_good / good - passed_bad / bad
        if index > best + 1e-12:
            best, stretch = index, (cut, cut)
        elif abs(index - best) <= 1e-12 and cut == stretch[1] + 1:
            stretch = (stretch[0], cut)
    return sum(stretch) / 2 / bins_a_unit


def judged(pages: DataFrame, rules: Rules = RULES, order: int = ORDER) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) for every row of ``pages`` (page_id, url).

    ``rules`` is a short list kept in the plan. NULL URLs have empty host and
    path, match no rule and are judged as the empty URL. Repeated URLs are
    learnt once and judged alike, whatever their page_id. Where the rules
    accept or reject nothing to learn from, other URLs score 0 and pass. An
    empty table gives no rows; other columns are not looked at.
    """
    asked = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), host().alias("host"), path().alias("path"))
    asked = asked.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    label = F.when(_verdict_of(F.col("rule"), rules) == "allow", 1).when(F.col("rule").isNotNull(), 0)
    urls = asked.groupBy("url", label.alias("label")).agg(
        F.first(F.crc32("url") % CALIBRATION == 0).alias("held"), F.count("*").alias("pages"))
    both = urls.where("NOT held AND label IS NOT NULL").agg(F.count_distinct("label")).first()[0] == 2
    scored = cut_lineage(scores(urls, order))
    cut = calibrated(scored) if both else 0.0
    passes = (F.col("score") >= F.lit(cut * SCALE) * F.col("size")) if both else F.lit(True)
    verdicts = scored.select(F.col("a").alias("_a"), F.col("b").alias("_b"), "pages", (F.col("score") / F.col("size") / SCALE).alias("score"),
                             F.when(passes, "allow").otherwise("block").alias("_model"))
    keyed = asked.withColumns({"_a": F.xxhash64("url"), "_b": F.xxhash64(F.lit("url"), F.col("url"))})
    # NULL URLs are one key, and some pages come often: those are answered before the shuffle
    joined = attach(keyed.drop("url"), verdicts, ["_a", "_b"], weight="pages")
    return joined.select("page_id", "host", "path", "rule", F.coalesce(
        _verdict_of(F.col("rule"), rules), F.col("_model")).alias("verdict"), "score")
