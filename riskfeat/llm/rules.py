"""Quality rules with thresholds that follow each language and source.

Counts of a text give a few rates. Per (language, source) and rate a quantile
sketch - counts of values cut to seven leading bits, so sketches merge by
adding counts and a quantile is off by less than one part in 64 - gives the
quartiles of the texts that pass the base rules. A text fails where a rate lies
outside the quartiles by more than ``FENCE`` times their distance, and by more
than the rate's slack. Groups with few texts use their language's sketch, or
that of all texts: the sum of the groups' sketches.

Only DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskfeat.llm.common import WORDS, words_of
from riskfeat.operators.lookup import attach
from riskfeat.session import cut_lineage

WINDOW = 5
LEAST_WORDS = 10
MOST_REPEATED = 20  # per cent of the words
SYMBOLS = "#*$%&|<>"
FENCE = 6
SUPPORT = 200  # texts a group needs for thresholds of its own
#: rate: (numerator, factor, denominator, slack, whether low values fail too). The slacks of the repeats
#: come from clean texts (label 1) past the base rules: of their words 8.3 % repeat at the 99th percentile
#: and 15.6 % at the 99.9th, of their lines 16.6 % and a third, which is the most.
RATES = {
    "word_length": ("word_chars", 100, "n_words", 200, True),
    "symbol_rate": ("n_symbols", 1000, "word_chars", 60, False),
    "line_repeats": ("n_dup_lines", 1000, "n_lines", 340, False),
    "word_repeats": ("n_repeat_words", 1000, "n_words", 120, False),
}


def _repeated(grams: str) -> Column:
    """Words that windows seen more than once cover, from the array of window hashes."""
    placed = F.array_sort(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    equal = F.zip_with(placed, F.slice(placed, 2, F.greatest(F.size(grams) - 1, F.lit(1))), lambda a, b: F.when(
        a["g"] == b["g"], F.array(a["i"], b["i"])))
    return F.array_sort(F.array_distinct(F.flatten(F.filter(equal, lambda x: x.isNotNull()))))


def counted(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, source) of every row of ``docs`` with its word, symbol, line and repeat counts.

    NULL and empty texts have no words. The array of window hashes is built
    once a row; only texts in which a hash comes twice are looked at closer.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    words = docs.select("doc_id", "lang", "source", text.alias("text"), words_of(text).alias("words"))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(WORDS))
    starts = F.sequence(F.lit(1), F.size("words") - (WINDOW - 1))
    grams = F.when(F.size("words") >= WINDOW, F.transform(starts, lambda i: F.xxhash64(F.slice("words", i, WINDOW))))
    measured = words.select(
        "doc_id", "lang", "source", F.size("words").cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        lines.alias("_lines"), grams.alias("_grams"))
    spotted = measured.withColumn("_places", F.when(
        F.size(F.array_distinct("_grams")) < F.size("_grams"), _repeated("_grams")))
    gaps = F.zip_with("_places", F.slice("_places", 2, F.greatest(F.size("_places"), F.lit(1))), lambda a, b: F.least(
        F.coalesce(b - a, F.lit(WINDOW)), F.lit(WINDOW)))
    total = F.aggregate(gaps, F.lit(0), lambda s, x: s + x)
    return spotted.select(
        "doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", F.size("_lines").cast("bigint").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        F.coalesce(total, F.lit(0)).cast("bigint").alias("n_repeat_words"))


def rate(name: str) -> Column:
    above, factor, below, _, _ = RATES[name]
    return F.expr(f"{above} * {factor} div greatest({below}, 1)")


def cut_bits(value: str) -> Column:
    """The value with all but its seven leading bits set to zero."""
    shift = f"greatest(length(bin({value})) - 7, 0)"
    return F.expr(f"shiftleft(shiftright({value}, {shift}), {shift})")


def sketches(counts: DataFrame) -> DataFrame:
    """(lang, source, rate, value, n): the mergeable sketch of each group and rate."""
    pairs = F.array(*[F.struct(F.lit(r).alias("rate"), rate(r).cast("bigint").alias("value")) for r in RATES])
    rows = counts.select("lang", "source", F.explode(pairs).alias("p")).select(
        "lang", "source", "p.rate", F.col("p.value").alias("_v"))
    return rows.groupBy("lang", "source", "rate", cut_bits("_v").alias("value")).agg(F.count("*").alias("n"))


def _quartiles(sketch: DataFrame, by: list[str]) -> DataFrame:
    merged = sketch.groupBy(*by, "rate", "value").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*by, "rate")
    upto = group.orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marked = merged.withColumns({"_upto": F.sum("n").over(upto), "_all": F.sum("n").over(group)})
    return marked.groupBy(*by, "rate").agg(
        F.min(F.when(F.col("_upto") * 4 >= F.col("_all"), F.col("value"))).alias("q1"),
        F.min(F.when(F.col("_upto") * 4 >= F.col("_all") * 3, F.col("value"))).alias("q3"),
        F.max("_all").alias("support"))


def thresholds(sketch: DataFrame, support: int = SUPPORT) -> DataFrame:
    """One row per (lang, source) with low_ and high_ of every rate."""
    own = _quartiles(sketch, ["lang", "source"])
    of_lang = _quartiles(sketch, ["lang"]).select(
        F.col("lang").alias("_lang"), F.col("rate").alias("_rate"), F.col("q1").alias("l1"),
        F.col("q3").alias("l3"), F.col("support").alias("lang_support"))
    of_all = _quartiles(sketch, []).select(
        F.col("rate").alias("_each"), F.col("q1").alias("a1"), F.col("q3").alias("a3"))
    known = own.join(of_lang, F.col("lang").eqNullSafe(F.col("_lang")) & (F.col("rate") == F.col("_rate"))).join(
        F.broadcast(of_all), F.col("rate") == F.col("_each"))  # a row per rate

    def pick(mine: str, lang: str, all_: str) -> Column:
        return F.when(F.col("support") >= support, F.col(mine)).when(
            F.col("lang_support") >= support, F.col(lang)).otherwise(F.col(all_))

    chosen = known.select("lang", "source", "rate", pick("q1", "l1", "a1").alias("q1"),
                          pick("q3", "l3", "a3").alias("q3"))
    columns = []
    for name, (_, _, _, slack, _) in RATES.items():
        mine = F.col("rate") == name
        reach = F.greatest(F.lit(slack), (F.col("q3") - F.col("q1")) * FENCE)
        columns += [F.max(F.when(mine, F.col("q1") - reach)).alias(f"low_{name}"),
                    F.max(F.when(mine, F.col("q3") + reach)).alias(f"high_{name}")]
    return chosen.groupBy("lang", "source").agg(*columns)


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED)


def judged(docs: DataFrame, support: int = SUPPORT) -> DataFrame:
    """(doc_id, lang, source), counts, base_failed and kept for every row of ``docs``.

    NULL languages and sources are groups like others; texts without words fail
    the base rules; repeated rows are judged alike; an empty table gives no
    rows; other columns of ``docs`` are not looked at.
    """
    counts = cut_lineage(counted(docs).withColumn("base_failed", base_failed()))
    limits = cut_lineage(thresholds(sketches(counts.where("NOT base_failed")), support))
    known = attach(counts, limits, ["lang", "source"], null_safe=True)
    fine = ~F.col("base_failed")
    for name, (_, _, _, _, two_sided) in RATES.items():
        fine = fine & (rate(name) <= F.col(f"high_{name}"))
        if two_sided:
            fine = fine & (rate(name) >= F.col(f"low_{name}"))
    return known.withColumn("kept", F.coalesce(fine, F.lit(False)))


def _rates_sql() -> str:
    return " UNION ALL ".join(
        f"SELECT lang, source, '{r}' AS rate, {a} * {f} // greatest({b}, 1) AS v FROM c WHERE NOT base_failed"
        for r, (a, f, b, _, _) in RATES.items())


def _quartiles_sql(by: str) -> str:
    keys = f"{by}, " if by else ""
    return (f"SELECT {keys}rate, min(value) FILTER (upto * 4 >= whole) AS q1, min(value) FILTER (upto * 4 >= whole * 3) "
            f"AS q3, max(whole) AS support FROM (SELECT {keys}rate, value, sum(count(*)) OVER (PARTITION BY {keys}rate "
            f"ORDER BY value) AS upto, sum(count(*)) OVER (PARTITION BY {keys}rate) AS whole FROM v "
            f"GROUP BY {keys}rate, value) GROUP BY {keys}rate")


def _fence_sql(name: str) -> str:
    above, factor, below, slack, two_sided = RATES[name]
    value = f"{above} * {factor} // greatest({below}, 1)"
    limit = f"(SELECT {{}} FROM f WHERE f.lang IS NOT DISTINCT FROM c.lang AND f.source IS NOT DISTINCT FROM c.source AND rate = '{name}')"
    test = f"{value} <= " + limit.format(f"q3 + greatest({slack}, (q3 - q1) * {FENCE})")
    return f"({test}" + (f" AND {value} >= " + limit.format(f"q1 - greatest({slack}, (q3 - q1) * {FENCE})") if two_sided else "") + ")"


SQL = f"""
WITH t AS (SELECT doc_id, lang, source, coalesce(text, '') AS text,
                  regexp_extract_all(coalesce(text, ''), '{WORDS}') AS words FROM documents),
w AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM t),
g AS (SELECT doc_id, i, word || ' ' || lead(word, 1) OVER o || ' ' || lead(word, 2) OVER o || ' ' ||
             lead(word, 3) OVER o || ' ' || lead(word, 4) OVER o AS gram FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
h AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM g WHERE gram IS NOT NULL) WHERE n > 1),
p AS (SELECT doc_id, sum(least({WINDOW}, coalesce(lead_i - i, {WINDOW}))) AS n FROM (
        SELECT *, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS lead_i FROM h) GROUP BY doc_id),
l AS (SELECT doc_id, [x for x in string_split(text, chr(10)) if regexp_matches(x, '{WORDS}')] AS lines FROM t),
m AS (SELECT t.doc_id, lang, source, CAST(len(words) AS BIGINT) AS n_words,
             CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(lines) AS BIGINT) AS n_lines,
             CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(p.n, 0) AS BIGINT) AS n_repeat_words
      FROM t JOIN l USING (doc_id) LEFT JOIN p USING (doc_id)),
c AS (SELECT *, n_words < {LEAST_WORDS} OR n_repeat_words * 100 > n_words * {MOST_REPEATED} AS base_failed FROM m),
v AS (SELECT lang, source, rate, (v >> greatest(length(bin(v)) - 7, 0)) << greatest(length(bin(v)) - 7, 0) AS value
      FROM ({_rates_sql()})),
own AS ({_quartiles_sql("lang, source")}),
by_lang AS ({_quartiles_sql("lang")}),
by_all AS ({_quartiles_sql("")}),
f AS (SELECT own.lang, own.source, own.rate,
        CASE WHEN own.support >= {SUPPORT} THEN own.q1 WHEN b.support >= {SUPPORT} THEN b.q1 ELSE a.q1 END AS q1,
        CASE WHEN own.support >= {SUPPORT} THEN own.q3 WHEN b.support >= {SUPPORT} THEN b.q3 ELSE a.q3 END AS q3
      FROM own JOIN by_lang b ON own.lang IS NOT DISTINCT FROM b.lang AND own.rate = b.rate JOIN by_all a ON own.rate = a.rate)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       coalesce(NOT base_failed AND {" AND ".join(_fence_sql(r) for r in RATES)}, false) AS kept FROM c
"""
