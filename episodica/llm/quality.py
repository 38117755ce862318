"""Quality classifier: a generalised additive model with pairwise interactions.

Boosting goes round the features, each turn adding one shallow tree over the
bins of one feature (later of one pair of features) to its lookup table. A score
is the logistic of an intercept and the tables' entries, added up by bin for a
whole batch at once.

Null text counts as empty; empty texts have features and a score like others.
Repeated rows are scored each. Labels of a document that disagree, or are null,
are not learned from. Without labels of both classes the score is the share of
label 1, or 0.5 without labels. An empty table gives an empty table. Extra
columns are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from episodica.llm.common import in_small_batches

# Labelled documents that a model is fitted on, at most.
TRAIN_ROWS = 20_000
BINS, PAIR_BINS, PAIRS = 64, 12, 6
ROUNDS, PAIR_ROUNDS, RATE, LEAST = 120, 40, 0.15, 5.0
ACCEPT_AT = 0.5

FEATURES = [
    "words", "word_length", "letters", "digits", "capitals", "symbols", "lone_symbols", "ending_symbols", "stops",
    "repeats", "distinct", "line_words", "repeated_lines", "capital_words",
]

_SPACE, _LOWER, _UPPER, _DIGIT, _STOP, _SYMBOL, _OTHER = range(7)


def _classes() -> np.ndarray:
    out = np.full(256, _SYMBOL, dtype=np.uint8)
    out[128:] = _OTHER
    for c in b" \t\r\n\x0b\x0c":
        out[c] = _SPACE
    out[ord("a") : ord("z") + 1] = _LOWER
    out[ord("A") : ord("Z") + 1] = _UPPER
    out[ord("0") : ord("9") + 1] = _DIGIT
    for c in b".,;:?'\"-()":
        out[c] = _STOP
    return out


_CLASS = _classes()


def features(text: str | None) -> list[float]:
    """Features of one whole text, in the order of FEATURES."""
    text = text or ""
    words, lines = text.split(), text.split("\n")
    n = max(1, len(words))
    kinds = _CLASS[np.frombuffer(f" {text} ".encode(errors="replace"), dtype=np.uint8)]
    count = np.bincount(kinds, minlength=7)
    size = max(1, len(kinds) - 2)
    symbol, space = kinds[1:-1] == _SYMBOL, kinds == _SPACE
    ending = symbol & space[2:]
    capital = (kinds[1:] == _UPPER) & (kinds[:-1] == _UPPER)
    letters = count[_LOWER] + count[_UPPER] + count[_OTHER]
    return [
        np.log1p(len(words)),
        len(text) / n,
        letters / size,
        count[_DIGIT] / size,
        count[_UPPER] / max(1, letters),
        count[_SYMBOL] / size,
        np.count_nonzero(ending & space[:-2]) / n,
        np.count_nonzero(ending) / n,
        count[_STOP] / n,
        sum(map(eq, words, words[1:])) / n,
        np.log1p(len(set(words))) / np.log1p(n),
        np.log1p(len(words) / len(lines)),
        1 - len(set(lines)) / len(lines),
        np.count_nonzero(capital) / max(1, letters),
    ]


@dataclass
class AdditiveModel:
    """Lookup tables of single features and of pairs."""

    edges: list[np.ndarray]
    pair_edges: list[np.ndarray]
    intercept: float
    tables: np.ndarray
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def bins(self, x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(edges)], axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of features."""
        if not len(x):
            return np.zeros(0)
        b = self.bins(x, self.edges)
        z = self.intercept + self.tables[np.arange(b.shape[1]), b].sum(axis=1)
        if self.pairs:
            c = self.bins(x, self.pair_edges)
            for (i, j), t in zip(self.pairs, self.pair_tables, strict=True):
                z += t[c[:, i], c[:, j]]
        return 1 / (1 + np.exp(-z))


def _edges(x: np.ndarray, bins: int) -> list[np.ndarray]:
    cuts = np.linspace(0, 1, bins + 1)[1:-1]
    return [np.unique(np.quantile(x[:, j], cuts)) for j in range(x.shape[1])]


def _split(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Gain and place of the best cut of a row of bins; 0 if none gains."""
    a, b = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    ga, hb = g.sum() - a, h.sum() - b
    gain = np.where((b >= LEAST / 4) & (hb >= LEAST / 4), a * a / (b + 1) + ga * ga / (hb + 1), 0)
    if not len(gain):
        return 0.0, 0
    k = int(gain.argmax())
    return float(gain[k] - g.sum() ** 2 / (h.sum() + 1)), k + 1


def _tree(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """Values of a tree of at most ``depth`` levels over the bins of one feature."""
    gain, k = _split(g, h) if depth and len(g) > 1 else (0.0, 0)
    if gain <= 0 or not k:
        return np.full(len(g), g.sum() / (h.sum() + 1))
    return np.concatenate([_tree(g[:k], h[:k], depth - 1), _tree(g[k:], h[k:], depth - 1)])


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """Values and gain of a tree that cuts one feature, then each side by the other."""
    best, most = np.full(g.shape, g.sum() / (h.sum() + 1)), -np.inf
    for turned in (False, True):
        a, b = (g.T, h.T) if turned else (g, h)
        for k in range(1, a.shape[0]):
            out, total = np.empty(a.shape), 0.0
            for part in (slice(None, k), slice(k, None)):
                row, weight = a[part].sum(axis=0), b[part].sum(axis=0)
                values = _tree(row, weight, 1)
                out[part] = values
                total += float(2 * (values * row).sum() - (values**2 * (weight + 1 / len(row))).sum())
            if total > most:
                best, most = (out.T if turned else out), total
    return best, most


def fit(x: np.ndarray, y: np.ndarray) -> AdditiveModel:
    """Fit on rows of features and labels 0 or 1."""
    share = (float(y.mean()) if len(y) else 0.5)
    if not len(y) or share in (0.0, 1.0):
        p = min(max(share, 1e-6), 1 - 1e-6)
        none = [np.zeros(0)] * len(FEATURES)
        return AdditiveModel(none, none, float(np.log(p / (1 - p))), np.zeros((len(FEATURES), 1)))
    m = AdditiveModel(
        _edges(x, BINS), _edges(x, PAIR_BINS), float(np.log(share / (1 - share))), np.zeros((x.shape[1], BINS))
    )
    z = np.full(len(y), m.intercept)
    b = m.bins(x, m.edges)
    for _ in range(ROUNDS):
        for j in range(x.shape[1]):
            p = 1 / (1 + np.exp(-z))
            n = len(m.edges[j]) + 1
            step = RATE * _tree(np.bincount(b[:, j], y - p, n), np.bincount(b[:, j], p * (1 - p), n))
            m.tables[j, :n] += step
            z += step[b[:, j]]
    c = m.bins(x, m.pair_edges)

    def cells(i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-z))
        at = c[:, i] * PAIR_BINS + c[:, j]
        return tuple(
            np.bincount(at, v, PAIR_BINS * PAIR_BINS).reshape(PAIR_BINS, PAIR_BINS) for v in (y - p, p * (1 - p))
        )

    gains = {pair: _pair_tree(*cells(*pair))[1] for pair in combinations(range(x.shape[1]), 2)}
    m.pairs = sorted(gains, key=lambda pair: (-gains[pair], pair))[:PAIRS]
    m.pair_tables = [np.zeros((PAIR_BINS, PAIR_BINS)) for _ in m.pairs]
    for _ in range(PAIR_ROUNDS):
        for (i, j), t in zip(m.pairs, m.pair_tables, strict=True):
            step = RATE * _pair_tree(*cells(i, j))[0]
            t += step
            z += step[c[:, i], c[:, j]]
    return m


def _rows(batch: pa.RecordBatch) -> np.ndarray:
    return np.array([features(t.as_py()) for t in batch.column("text")]).reshape(-1, len(FEATURES))


def training_rows(docs: DataFrame, labels: DataFrame, learn: Column, rows: int = TRAIN_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of at most ``rows`` labelled documents, those of the smallest hashes."""
    label = F.col("quality").cast("double")
    known = (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.min(label).alias("label"), F.max(label).alias("other"))
        .where((F.col("label") == F.col("other")) & learn)
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = pa.array(list(_rows(batch)), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("label"), made], names=["label", "x"])

    # Bounded by ``rows`` pairs of numbers.
    joined = in_small_batches(docs).select("doc_id", "text").join(F.broadcast(known.select("doc_id", "label")), "doc_id")
    got = joined.select("label", "text").mapInArrow(run, "label double, x array<double>").toArrow()
    x = np.array(got.column("x").to_pylist(), dtype=float).reshape(-1, len(FEATURES))
    y = got.column("label").to_numpy()
    # Sums do not depend on the order in which tasks ended.
    order = np.lexsort([*x.T, y])
    return x[order], y[order]


def probability(model: AdditiveModel, text: str = "text") -> Column:
    """Score of the whole text of a column; only texts go to the workers, only numbers come back."""

    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.array([features(t) for t in texts]).reshape(-1, len(FEATURES))))

    return run(F.col(text))


def score(docs: DataFrame, model: AdditiveModel, keep: list[str], accept_at: float = ACCEPT_AT) -> DataFrame:
    """The columns ``keep`` of ``docs`` with ``score`` and ``predicted`` of the whole text."""
    scored = in_small_batches(docs).select(*[F.col(f"`{c}`") for c in keep], probability(model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= accept_at).cast("int"))
