"""Personal data: patterns find it, corpus co-occurrence finds what gives it away.

Base spans are e-mail addresses, IPv4 addresses, card numbers and phone
numbers. Each value is a protected entity. A term t discloses an entity e by
the share of e's information content that t carries,

    PMI(e; t) / IC(e) = log2(N n(e,t) / (n(e) n(t))) / log2(N / n(e)),

with counts of documents over the whole corpus. Terms that meet an entity in
at least ``MIN_TEXTS`` different texts and carry ``GENERALISE`` or more of it
are generalised, those with ``REMOVE`` or more are removed - wherever they
stand, since they point at the entity there as well.

Every token is a term, however short: letters, digits, marks and joiners in a
row. Where a script writes no spaces, all runs of up to ``GRAMS`` code points
are terms instead. The disclosed share alone decides.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructType

from riskfeat.llm.common import spare, whole_texts
from riskfeat.operators.lookup import BROADCAST_ROWS, as_small_table, collect_bounded
from riskfeat.session import cut_lineage

KINDS = ("email", "ip", "card", "phone")
MIN_TEXTS = 3
GENERALISE = 0.9
REMOVE = 0.97
_HELD = 1 << 18

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGIT = re.compile(r"[0-9]")
# possessive digits and the look-behind keep long runs of digits linear; the matches are the same
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
GRAMS = 4
_UNSPACED = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]+")
_ASCII_TERM = re.compile(r"[A-Za-z0-9_]+")
_TERM = regex.compile(r"[\p{L}\p{N}\p{M}_\u200c\u200d]+")  # the same on ASCII texts, only slower

Span = tuple[int, int, int]  # start, index of the kind, end


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at)):
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[Span]:
    """All base spans by start, then kind; leftmost and not overlapping within a kind."""
    spans = [(a, 0, b) for a, b in _emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            parts = [p.lstrip("0") for p in m.group().split(".")]
            if all(len(p) <= 3 and int(p or "0") <= 255 for p in parts):
                spans.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and _luhn(digits):
                spans.append((m.start(), 2, m.end()))
        for m in _PHONE.finditer(text):
            if 9 <= len(_DIGIT.findall(m.group())) <= 15:
                spans.append((m.start(), 3, m.end()))
    return sorted(spans)


def entity(text: str, span: Span) -> str:
    """One spelling of a value: lower case, card and phone numbers by digits alone."""
    start, kind, end = span
    value = text[start:end].lower()
    return f"{KINDS[kind]}:{value if kind < 2 else ''.join(_DIGIT.findall(value))}"


def _blanked(text: str, spans: list[Span]) -> str:
    for start, _, end in spans:
        text = f"{text[:start]}{' ' * (end - start)}{text[end:]}"
    return text


def _cut(token: str) -> Iterator[tuple[int, int]]:
    """Start and end of every term within one token."""
    at = 0
    for m in _UNSPACED.finditer(token):
        if at < m.start():
            yield at, m.start()
        for a in range(m.start(), m.end()):
            for b in range(a + 1, min(a + GRAMS, m.end()) + 1):
                yield a, b
        at = m.end()
    if at < len(token):
        yield at, len(token)


def terms(text: str, spans: list[Span]) -> Iterator[tuple[int, int, str]]:
    """Start, end and lower-case spelling of every term outside base spans."""
    rest = _blanked(text, spans) if spans else text
    if rest.isascii():
        for m in _ASCII_TERM.finditer(rest):
            yield m.start(), m.end(), m.group().lower()
        return
    for m in _TERM.finditer(rest):
        for a, b in _cut(m.group()):
            yield m.start() + a, m.start() + b, m.group()[a:b].lower()


def _joined(spans: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, kind, end in spans)


@F.arrow_udf(ArrayType(StringType()))
def _entities(text: pa.Array) -> pa.Array:
    found = []
    for v in text:
        t = v.as_py() or ""
        found.append(sorted({entity(t, s) for s in base_spans(t)}) or None)
    return pa.array(found, pa.list_(pa.string()))


def _terms(text: str | None) -> set[str]:
    t = text or ""
    spans = base_spans(t)
    rest = _blanked(t, spans) if spans else t
    if rest.isascii():
        return set(_ASCII_TERM.findall(rest.lower()))
    return {token[a:b].lower() for token in set(_TERM.findall(rest)) for a, b in _cut(token)}


@F.arrow_udf(ArrayType(StringType()))
def _distinct_terms(text: pa.Array) -> pa.Array:
    return pa.array([sorted(_terms(v.as_py())) or None for v in text], pa.list_(pa.string()))


def _term_counts(known: frozenset[str] | None) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(term, n): in how many texts of a task each term stands, of those in ``known`` if given.

    A task adds up in memory and gives out what it has when that gets large, so
    a term costs a row a task and not a row a text.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def given() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_pydict({"term": list(counts), "n": list(counts.values())}, pa.schema(
                [("term", pa.string()), ("n", pa.int64())]))
            counts.clear()
            return batch

        for batch in batches:
            for v in batch.column("text"):
                have = _terms(v.as_py())
                counts.update(have & known if known is not None else have)
                if len(counts) > _HELD:
                    yield given()
        yield given()

    return run


def term_disclosure(docs: DataFrame, min_texts: int = MIN_TEXTS, floor: float = GENERALISE) -> DataFrame:
    """(term, disclosure) of every term at or above ``floor``, by its most disclosed entity.

    Counts run over all documents. Copies count as documents but not as
    evidence: an entity, and a term with it, needs ``min_texts`` different
    texts. An entity in more than half of the documents is public.
    """
    texts = whole_texts(docs).select(F.xxhash64("text").alias("key"), "text")
    mentions = cut_lineage(texts.select("key", _entities("text").alias("found")).where(
        "found IS NOT NULL").groupBy("key", "found").agg(F.count("*").alias("copies")))
    spread = mentions.select("key", "copies", F.explode("found").alias("entity"))
    total = docs.count()
    known = spread.groupBy("entity").agg(
        F.sum("copies").alias("n_e"), F.count("*").alias("texts")).where(
        (F.col("texts") >= min_texts) & (F.col("n_e") * 2 <= total)).drop("texts")
    pairs = cut_lineage(spread.join(known, "entity"))
    wanted = pairs.select("key", "copies").distinct()
    small = as_small_table(wanted, BROADCAST_ROWS)
    few = texts.join(wanted if small is None else F.broadcast(small), "key").groupBy("key", "copies").agg(
        F.any_value("text").alias("text"))
    found = few.select("key", "copies", F.explode(_distinct_terms("text")).alias("term"))
    together = found.join(pairs.select("key", "entity", "n_e"), "key").groupBy("entity", "n_e", "term").agg(
        F.sum("copies").alias("n_et"), F.count("*").alias("texts")).where(F.col("texts") >= min_texts)
    together = cut_lineage(together.drop("texts"))

    candidates = together.select("term").distinct()
    rows = collect_bounded(candidates, BROADCAST_ROWS)
    among = frozenset(r["term"] for r in rows) if rows is not None else None
    seen = docs.select("text").mapInArrow(_term_counts(among), "term string, n bigint").groupBy("term").agg(
        F.sum("n").alias("n_t"))
    bits = F.log2(F.lit(float(total)) * F.col("n_et") / (F.col("n_e") * F.col("n_t")))
    share = bits / F.log2(F.lit(float(total)) / F.col("n_e"))
    return together.join(seen, "term").groupBy("term").agg(F.max(share).alias("disclosure")).where(
        F.col("disclosure") >= floor)


_FOUND = StructType().add("n_email", LongType()).add("n_ip", LongType()).add("n_card", LongType()).add(
    "n_phone", LongType()).add("base_sha256", StringType()).add("spans", StringType()).add(
    "n_term", LongType()).add("clean_text", StringType())
_ARROW = pa.struct([(f.name, pa.int64() if isinstance(f.dataType, LongType) else pa.string()) for f in _FOUND])


def _inspect(text: str | None, shares: dict[str, float], remove: float) -> dict:
    t = text or ""
    base = base_spans(t)
    named = [(s, KINDS[k], e) for s, k, e in base]
    revealing = [(a, "term", b, shares[w]) for a, b, w in terms(t, base) if w in shares] if shares else []
    every = sorted(named + [r[:3] for r in revealing],
                   key=lambda x: (x[0], KINDS.index(x[1]) if x[1] in KINDS else len(KINDS), x[2]))
    clean = None
    if every:
        dropped = {r[0] for r in revealing if r[3] >= remove}
        parts, at = [], 0
        for start, kind, end in every:
            if start >= at:
                parts += [t[at:start], "" if kind == "term" and start in dropped else f"<{kind.upper()}>"]
            at = max(at, end)
        clean = "".join([*parts, t[at:]])  # without spans it stays None: unchanged texts are not sent back
    return {**{f"n_{k}": sum(1 for _, i, _ in base if KINDS[i] == k) for k in KINDS},
            "base_sha256": hashlib.sha256(_joined(named).encode()).hexdigest(),
            "spans": _joined(every), "n_term": len(revealing), "clean_text": clean}


def _with_text(found: Column, text: Column) -> Column:
    return found.withField("clean_text", F.coalesce(found["clean_text"], text))


def sanitise(docs: DataFrame, remove: float = REMOVE, **thresholds: float) -> DataFrame:
    """``docs`` with one more column: a struct of counts, spans and the sanitised text.

    Its name is ``found``, with underscores in front where ``docs`` has one.
    Spans are kind:start:end in code points by start, then kind as in ``KINDS``
    with term last. In clean_text base values become <EMAIL> and the like,
    generalised terms <TERM>, removed terms nothing; overlapping spans are
    replaced once. NULL text counts as empty and stays NULL; repeated rows,
    NULL ids and other columns are kept as they are; an empty table gives none.
    """
    docs = whole_texts(docs)
    name = spare("found", docs.columns)
    revealing = cut_lineage(term_disclosure(docs.select("text"), **thresholds))
    rows = collect_bounded(revealing, BROADCAST_ROWS)
    if rows is not None:
        shares = {r["term"]: r["disclosure"] for r in rows}

        @F.arrow_udf(_FOUND)
        def inspect(text: pa.Array) -> pa.Array:
            return pa.array([_inspect(t.as_py(), shares, remove) for t in text], _ARROW)

        return docs.withColumn(name, _with_text(inspect("text"), F.col("text")))

    # too many terms for one map: each text gets those that occur in it
    key, per = spare("text_key", docs.columns), spare("per_text", docs.columns)
    pairs = docs.select(F.xxhash64("text").alias("_key"), F.explode(_distinct_terms("text")).alias("term"))
    lists = pairs.distinct().join(revealing, "term").groupBy("_key").agg(
        F.collect_list("term").alias("_terms"), F.collect_list("disclosure").alias("_shares"))

    @F.arrow_udf(_FOUND)
    def inspect_with(text: pa.Array, names: pa.Array, shares: pa.Array) -> pa.Array:
        return pa.array([_inspect(t.as_py(), dict(zip(n or (), s or ())), remove) for t, n, s in zip(
            text, names.to_pylist(), shares.to_pylist())], _ARROW)

    keyed = docs.withColumn(key, F.xxhash64("text"))
    joined = keyed.join(lists, keyed[key] == lists["_key"], "left").withColumn(
        per, _with_text(inspect_with(keyed["text"], lists["_terms"], lists["_shares"]), keyed["text"]))
    return joined.select(*[keyed[c] for c in docs.columns], F.col(per).alias(name))


def cleaned(docs: DataFrame) -> DataFrame:
    """``docs`` with sanitised texts, and n_chars counted anew where a text has changed."""
    name = spare("found", docs.columns)
    rows = sanitise(docs)
    new = F.col(f"{name}.clean_text")
    change = {"text": new}
    if "n_chars" in docs.columns:
        kept = F.col("n_chars")
        change["n_chars"] = F.when(new.eqNullSafe(F.col("text")), kept).otherwise(
            F.length(new).cast(docs.schema["n_chars"].dataType))
    return rows.withColumns(change).select(*docs.columns)
