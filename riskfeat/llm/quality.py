"""Quality scores from a generalised additive model with pairwise interactions.

Texts become a few shape features, cut into bins at sample quantiles. Boosting
goes round the features, each time adding a shallow tree over one feature's
bins to that feature's lookup table; afterwards round the strongest pairs, with
one cut on either axis. A score is the sum of the tables' entries at the bins
of a text, so a batch is scored by array look-ups and additions.

The model is fitted on a bounded sample of labelled rows: at most ``FIT_ROWS``,
taken by a hash of doc_id. Everything else runs over all rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from riskfeat.llm.common import spare, whole_texts

FIT_ROWS = 20_000
HELD_OUT = 5  # crc32 of the doc_id modulo this is 0 for rows never learnt from
CUT = 0.3
_SLAB = 1 << 22

FEATURES = (
    "words", "word_length", "symbols", "letters", "digits", "capitals", "exclamations", "bars",
    "repeated_lines", "distinct_words", "line_words", "sentence_ends", "short_words", "other_bytes",
    "common_word",
)


def _class(chars: bytes) -> np.ndarray:
    mask = np.zeros(256, bool)
    mask[list(chars)] = True
    return mask


_SYMBOLS, _BARS = _class(b"#*$%&|<>"), _class(b"|")
_DIGITS, _CAPITALS = _class(bytes(range(48, 58))), _class(bytes(range(65, 91)))
_LETTERS = _class(bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(0xC0, 0x100)))
_LOUD, _ENDS = _class(b"!"), (b".", b"!", b"?", b":")


def features_of(text: bytes | None) -> list[float]:
    """Shape of one UTF-8 text, all zero where it has no words."""
    words = text.split() if text else []
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    raw = np.frombuffer(text, np.uint8)
    count = np.zeros(256, np.int64)
    for k in range(0, len(raw), _SLAB):
        count += np.bincount(raw[k:k + _SLAB], minlength=256)
    size = len(raw)
    lines = [x for x in text.split(b"\n") if x.strip()]
    letters, chars = int(count[_LETTERS].sum()), sum(map(len, words))
    kinds: dict[bytes, int] = {}
    for w in words:
        kinds[w] = kinds.get(w, 0) + 1
    return [
        float(np.log1p(n)), chars / n, count[_SYMBOLS].sum() / size, letters / size,
        count[_DIGITS].sum() / size, count[_CAPITALS].sum() / max(letters, 1), count[_LOUD].sum() / n,
        count[_BARS].sum() / n, 1 - len(set(lines)) / len(lines),
        len(kinds) / n ** 0.8, float(np.log1p(n / len(lines))),
        sum(x.rstrip().endswith(_ENDS) for x in lines) / len(lines),
        sum(c for w, c in kinds.items() if len(w) <= 3) / n,
        1 - (letters + count[32] + count[10]) / size, max(kinds.values()) / n,
    ]


def _matrix(texts: pa.Array) -> np.ndarray:
    values = texts.cast(pa.large_binary())
    return np.array([features_of(v.as_py()) for v in values]).reshape(-1, len(FEATURES))


# ----------------------------------------------------------------------- model


@dataclass
class Additive:
    """Lookup tables over bins; ``pairs`` holds (feature, feature, table over coarse bins)."""

    intercept: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    coarse: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray]]

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of features."""
        total = np.full(len(x), self.intercept)
        for f, (edges, table) in enumerate(zip(self.edges, self.tables)):
            total += table[np.searchsorted(edges, x[:, f], side="right")]
        cells = {f: np.searchsorted(self.coarse[f], x[:, f], side="right")
                 for f in {f for a, b, _ in self.pairs for f in (a, b)}}
        for a, b, table in self.pairs:
            total += table[cells[a], cells[b]]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _cuts(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.arange(1, bins) / bins)) if len(x) else np.empty(0)


def _gain(g: np.ndarray, h: np.ndarray, ridge: float) -> np.ndarray:
    return g * g / (h + ridge)


def _tree(g: np.ndarray, h: np.ndarray, ridge: float, depth: int) -> np.ndarray:
    """Step for every bin: a tree of ordered cuts over summed gradients and curvatures."""
    step = np.full(len(g), -g.sum() / (h.sum() + ridge))
    if depth and len(g) > 1:
        left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
        gains = _gain(left_g, left_h, ridge) + _gain(g.sum() - left_g, h.sum() - left_h, ridge)
        k = int(np.argmax(gains)) + 1
        if gains[k - 1] > _gain(g.sum(), h.sum(), ridge) + 1e-9:
            step = np.concatenate((_tree(g[:k], h[:k], ridge, depth - 1), _tree(g[k:], h[k:], ridge, depth - 1)))
    return step


def _quadrants(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[np.ndarray, float]:
    """Best cut on either axis of a grid: (step for every cell, gain over no cut)."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    tg, th = cg[-1, -1], ch[-1, -1]
    a, ah = cg[:-1, :-1], ch[:-1, :-1]
    b, bh = cg[:-1, -1:] - a, ch[:-1, -1:] - ah
    c, ch_ = cg[-1:, :-1] - a, ch[-1:, :-1] - ah
    d, dh = tg - a - b - c, th - ah - bh - ch_
    gains = sum(_gain(x, y, ridge) for x, y in ((a, ah), (b, bh), (c, ch_), (d, dh)))
    if not gains.size:
        return np.zeros_like(g), 0.0
    i, j = np.unravel_index(int(np.argmax(gains)), gains.shape)
    step = np.empty_like(g)
    for rows, columns, x, y in ((slice(0, i + 1), slice(0, j + 1), a, ah), (slice(0, i + 1), slice(j + 1, None), b, bh),
                                (slice(i + 1, None), slice(0, j + 1), c, ch_), (slice(i + 1, None), slice(j + 1, None), d, dh)):
        step[rows, columns] = -x[i, j] / (y[i, j] + ridge)
    return step, float(gains[i, j] - _gain(tg, th, ridge))


def train(
    x: np.ndarray, y: np.ndarray, bins: int = 48, coarse_bins: int = 10, rounds: int = 150, pair_rounds: int = 60,
    pairs: int = 8, rate: float = 0.15, ridge: float = 2.0, depth: int = 2,
) -> Additive:
    """Cyclic boosting of log loss; without rows every score is one half."""
    order = np.lexsort((*x.T, y))  # sums must not depend on the order rows arrive in
    x, y = x[order], y[order].astype(float)
    prior = (y.sum() + 1) / (len(y) + 2)
    intercept = float(np.log(prior / (1 - prior)))
    edges = [_cuts(x[:, f], bins) for f in range(x.shape[1])]
    coarse = [_cuts(x[:, f], coarse_bins) for f in range(x.shape[1])]
    model = Additive(intercept, edges, [np.zeros(len(e) + 1) for e in edges], coarse, [])
    if len(set(y.tolist())) < 2:
        return model
    own = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(edges)]
    total = np.full(len(y), intercept)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return p - y, p * (1 - p)

    for _ in range(rounds):
        for f, bin_ in enumerate(own):
            g, h = slopes()
            n = len(model.tables[f])
            step = rate * _tree(np.bincount(bin_, g, n), np.bincount(bin_, h, n), ridge, depth)
            model.tables[f] += step
            total += step[bin_]

    cells = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(coarse)]

    def grid(a: int, b: int, w: np.ndarray) -> np.ndarray:
        shape = len(coarse[a]) + 1, len(coarse[b]) + 1
        return np.bincount(cells[a] * shape[1] + cells[b], w, shape[0] * shape[1]).reshape(shape)

    g, h = slopes()
    ranked = sorted(combinations(range(x.shape[1]), 2), key=lambda p: -_quadrants(grid(*p, g), grid(*p, h), ridge)[1])
    model.pairs = [(a, b, np.zeros((len(coarse[a]) + 1, len(coarse[b]) + 1))) for a, b in ranked[:pairs]]
    for _ in range(pair_rounds):
        for a, b, table in model.pairs:
            g, h = slopes()
            step = rate * _quadrants(grid(a, b, g), grid(a, b, h), ridge)[0]
            table += step
            total += step[cells[a], cells[b]]
    return model


# ----------------------------------------------------------------------- Spark


def held_out(doc_id: str = "doc_id", parts: int = HELD_OUT, part: int = 0) -> F.Column:
    """Whether a row is kept from learning; NULL ids are, having no remainder."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % parts == part, F.lit(True))


@F.arrow_udf(ArrayType(DoubleType()))
def _features(texts: pa.Array) -> pa.Array:
    rows = _matrix(texts)
    return pa.ListArray.from_arrays(
        pa.array(np.arange(len(rows) + 1) * len(FEATURES), pa.int32()), pa.array(rows.ravel()))


def _drawn(doc_id: str) -> F.Column:
    """Place of an id in the draw of the sample, the same on every layout."""
    return F.pmod(F.xxhash64(doc_id), F.lit(2**30))


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Additive:
    """Model of labels.quality on the texts of ``docs``, from at most ``fit_rows`` labelled rows.

    Ids are drawn by their hash. Repeats of an (id, label) and of an (id, text)
    count once, and both what is broadcast and the features that come to the
    driver are cut at ``fit_rows``, so an id of any number of rows cannot
    exceed them. Held-out ids, NULL ids and labels other than 0 and 1 are left
    out; empty tables give a model that scores one half.
    """
    known = labels.select(F.col("doc_id").alias("_id"), F.col("quality").alias("_label")).where(
        ~held_out("_id") & F.col("_label").isin(0, 1)).distinct().orderBy(_drawn("_id"), "_id", "_label").limit(fit_rows)
    texts = whole_texts(docs).select("doc_id", "text").join(F.broadcast(known), F.col("doc_id") == F.col("_id")).select(
        "doc_id", "_label", F.xxhash64("text").alias("_text"), _features("text").alias("x")).distinct()
    rows = texts.orderBy(_drawn("doc_id"), "doc_id", "_text", "_label").limit(fit_rows).select("x", "_label").collect()
    x = np.array([r["x"] for r in rows]).reshape(-1, len(FEATURES))
    return train(x, np.array([r["_label"] for r in rows], dtype=float))


def scored(docs: DataFrame, model: Additive, name: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1 in ``name``, from the text alone.

    Empty and NULL texts have all-zero features and get a score like others;
    rows are kept as they are, an empty table gives none. ``name`` must be free.
    """

    @F.arrow_udf(DoubleType())
    def run(texts: pa.Array) -> pa.Array:
        return pa.array(model.score(_matrix(texts)))

    return whole_texts(docs).withColumn(name, run("text"))


def accepted(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """The rows of ``docs`` that score ``cut`` or more."""
    name = spare("score", docs.columns)
    return scored(docs, fit(docs, labels), name).where(F.col(name) >= cut).select(*docs.columns)
