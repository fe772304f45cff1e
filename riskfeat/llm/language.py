"""Language by rank-order profiles of character n-grams.

A language's profile is the list of its most frequent n-grams, counted over
all learnt texts. A document's most frequent n-grams are compared with each
profile: an n-gram costs the distance between its two ranks, one that the
profile lacks costs the profile's length. The nearest profile wins.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructType

from riskfeat.llm.common import whole_texts
from riskfeat.operators.lookup import collect_bounded

GRAMS = (1, 2, 3)
PROFILE = 400
HELD_OUT = (4, 2)  # crc32 of the doc_id modulo the first is the second for rows never learnt from
UNKNOWN = "und"
MAX_LANGUAGES = 4096
_SLAB = 1 << 20
_BITS = 21  # bits of a code point
_EDGE = 32  # code of a word boundary: the space, so that no n-gram with one equals a shorter n-gram
_HELD = 1 << 19


@cache
def _folded() -> np.ndarray:
    """Code point of the lower-case letter for each code point, 0 for what is no letter."""
    table = np.zeros(sys.maxunicode + 1, np.uint32)
    for c in range(sys.maxunicode + 1):
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


def grams(text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
    """(codes, counts) of the n-grams of a whole text; None where it has no letter.

    Everything but letters counts as one word boundary. Codes hold up to three
    code points of 21 bits; long texts are counted slab by slab.
    """
    if not text:
        return None
    letters = _folded()[np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)].astype(np.int64)
    keep = (letters > 0) | np.r_[True, letters[:-1] > 0]
    letters = letters[keep]
    if not letters.any():
        return None
    edge = np.zeros(1, np.int64)
    letters = np.concatenate((edge[: int(letters[0] > 0)], letters, edge[: int(letters[-1] > 0)]))
    letters[letters == 0] = _EDGE
    codes, counts = np.empty(0, np.int64), np.empty(0, np.int64)
    for start in range(0, len(letters), _SLAB):
        part = letters[start:start + _SLAB + max(GRAMS) - 1]
        found = []
        for n in GRAMS:
            stop = min(_SLAB, len(part) - n + 1)
            if stop <= 0:
                continue
            code = np.zeros(stop, np.int64)
            for k in range(n):
                code = (code << _BITS) | part[k:k + stop]
            found.append(code[code != _EDGE])  # a boundary alone says nothing
        c, m = np.unique(np.concatenate(found), return_counts=True)
        codes, back = np.unique(np.concatenate((codes, c)), return_inverse=True) if len(codes) else (c, None)
        counts = m if back is None else np.bincount(back, np.concatenate((counts, m))).astype(np.int64)
    return codes, counts


def top(codes: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """Codes of the ``size`` most frequent n-grams, ties by code."""
    if len(codes) > size:
        least = np.partition(counts, len(counts) - size)[len(counts) - size]
        codes, counts = codes[counts >= least], counts[counts >= least]
    return codes[np.lexsort((codes, -counts))][:size]


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n): what a task has counted, given out whenever it holds many n-grams."""
    held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    waiting: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

    def merged(lang: str) -> None:
        parts = waiting.pop(lang, [])
        if lang in held:
            parts.append(held.pop(lang))
        if parts:
            codes, back = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            held[lang] = codes, np.bincount(back, np.concatenate([p[1] for p in parts])).astype(np.int64)

    def given() -> Iterator[pa.RecordBatch]:
        for lang in [*held]:
            codes, counts = held.pop(lang)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang]).take(pa.array(np.zeros(len(codes), np.int32))), pa.array(codes), pa.array(counts)],
                names=["lang", "gram", "n"])

    size = 0
    for batch in batches:
        for text, lang in zip(batch.column("text"), batch.column("lang").to_pylist()):
            found = grams(text.as_py())
            if found is not None:
                waiting.setdefault(lang, []).append(found)
                size += len(found[0])
                if size > _HELD:
                    for name in [*waiting]:
                        merged(name)
                    size = 0
                    if sum(len(c) for c, _ in held.values()) > _HELD:
                        yield from given()
    for name in [*waiting]:
        merged(name)
    yield from given()


def profiles(docs: DataFrame, size: int = PROFILE) -> dict[str, np.ndarray]:
    """Top n-grams of every language among the rows of ``docs`` (text, lang).

    Rows without a language or a letter teach nothing. Counts are combined in
    the tasks and summed by Spark; the driver gets ``size`` n-grams of each
    language. More than ``MAX_LANGUAGES`` values of lang are refused: they are
    no language codes.
    """
    learnt = whole_texts(docs).where("lang IS NOT NULL AND text IS NOT NULL").select("text", "lang")
    counts = learnt.mapInArrow(_counted, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(
        F.sum("n").alias("n"))
    first = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    best = counts.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= size)
    rows = collect_bounded(best, MAX_LANGUAGES * size)
    if rows is None:
        raise ValueError(f"lang has more than {MAX_LANGUAGES} values")
    found: dict[str, list[tuple[int, int]]] = {}
    for r in rows:
        found.setdefault(r["lang"], []).append((r["rank"], r["gram"]))
    return {lang: np.array([g for _, g in sorted(found[lang])]) for lang in sorted(found)}


class Judge:
    """All profiles in one sorted table of n-grams, so a text needs one search."""

    def __init__(self, found: dict[str, np.ndarray], size: int = PROFILE) -> None:
        self.names, self.size = list(found), size
        self.codes = np.unique(np.concatenate([*found.values(), np.empty(0, np.int64)])).astype(np.int64)
        self.ranks = np.full((len(self.codes), len(found)), -1, np.int64)
        for k, own in enumerate(found.values()):
            self.ranks[np.searchsorted(self.codes, own), k] = np.arange(len(own))

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, share of the largest possible distance that it stays below)."""
        found = grams(text)
        if found is None or not self.names:
            return UNKNOWN, 0.0
        best = top(*found, self.size)
        at = np.minimum(np.searchsorted(self.codes, best), max(len(self.codes) - 1, 0))
        ranks = np.where((self.codes[at] == best)[:, None], self.ranks[at], -1)
        away = np.where(ranks < 0, self.size, np.abs(ranks - np.arange(len(best))[:, None])).sum(axis=0)
        k = int(np.argmin(away))
        return self.names[k], float(1 - away[k] / (self.size * len(best)))


def held_out(doc_id: str = "doc_id") -> F.Column:
    """Whether a row is kept from learning; NULL ids are, having no remainder."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % HELD_OUT[0] == HELD_OUT[1], F.lit(True))


_GUESS = StructType().add("lang_pred", StringType()).add("score", DoubleType())


def predicted(docs: DataFrame, found: dict[str, np.ndarray], size: int = PROFILE, name: str = "guess") -> DataFrame:
    """``docs`` with a struct column ``name`` of lang_pred and score, from the text alone.

    NULL texts and texts without a letter are ``und`` with score 0, as is
    everything where no language was learnt. Equal distances go to the first
    language by name. Rows are kept as they are; an empty table gives none.
    ``name`` must be free.
    """

    @F.arrow_udf(_GUESS)
    def run(texts: pa.Array) -> pa.Array:
        judge = Judge(found, size)
        guesses = [judge.predict(t.as_py()) for t in texts]
        return pa.StructArray.from_arrays(
            [pa.array([g[0] for g in guesses], pa.string()), pa.array([g[1] for g in guesses], pa.float64())],
            ["lang_pred", "score"])

    return whole_texts(docs).withColumn(name, run("text"))
