"""Hierarchical language identification.

A first level of linear support vector machines, one per family against the
rest, predicts the language family; within it one-versus-one machines tell the
languages apart, by votes and then by summed margins. All of them read the
square roots of the shares of hashed byte bigrams and trigrams of the
lower-cased letters.

Null texts and texts without a letter are ``und`` with score 0. Repeated rows
are predicted each. Without any labelled text all are ``und``; with one label
only, all texts with a letter get it. Ties go to the first name in order. An
empty table gives an empty table. Extra columns are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from episodica.llm.common import in_small_batches

UNDETERMINED = "und"
WIDTH = 4096
# Labelled texts that a model is fitted on, about, shared out evenly between the languages.
TRAIN_ROWS = 6_000
# A code that is not listed is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "af", "sv", "da", "no", "nb", "nn", "is"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "bg", "sr", "hr", "sl", "mk"),
    "uralic": ("fi", "et", "hu"),
    "indic": ("hi", "ur", "bn", "mr", "ne", "pa", "gu"),
    "turkic": ("tr", "az", "kk", "uz", "ky"),
}
STEPS, PENALTY = 300, 1e-4

_fold = np.arange(256, dtype=np.uint8)
_fold[:128] = [c if chr(c).isalpha() else 32 for c in range(128)]


def family_of(lang: str) -> str:
    return next((f for f, members in FAMILIES.items() if lang in members), lang)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def vector(text: str) -> np.ndarray:
    """Unit vector of one whole text."""
    raw = _fold[np.frombuffer(f" {text.lower()} ".encode(errors="replace"), dtype=np.uint8)]
    # Runs of other characters count as one space.
    b = raw[np.append(True, (raw[1:] != 32) | (raw[:-1] != 32))].astype(np.uint32)
    two = b[:-1] * np.uint32(257) + b[1:]
    three = two[:-1] * np.uint32(263) + b[2:] * np.uint32(65_599)
    spread = [(x * np.uint32(2_654_435_761)) >> np.uint32(20) for x in (two, three)]
    count = sum(np.bincount(x, minlength=WIDTH) for x in spread)
    return np.sqrt(count / max(1, count.sum())).astype(np.float32)


def fit_svm(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights and intercept of a linear machine with squared hinge loss; labels are -1 and 1."""
    a = np.hstack([x, np.ones((len(x), 1), np.float32)]).astype(np.float32)
    # Both sides weigh alike.
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    # All rows have the norm sqrt(2), which bounds the curvature.
    rate = np.float32(1 / (2 * 2 * 1.0 + PENALTY))
    w = v = np.zeros(a.shape[1], np.float32)
    t = 1.0
    for _ in range(STEPS):
        slack = np.maximum(0, 1 - y * (a @ v))
        new = v - rate * (np.float32(PENALTY) * v - 2 * (a.T @ (weight * y * slack)))
        t, before = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        w, v = new, new + np.float32((before - 1) / t) * (new - w)
    return w


@dataclass
class LanguageModel:
    families: list[str]
    members: list[list[str]]
    family_weights: np.ndarray
    pairs: list[list[tuple[int, int]]]
    pair_weights: list[np.ndarray]

    def predict(self, x: np.ndarray) -> list[tuple[str, float]]:
        """Language and score of each row of vectors."""
        if not self.families:
            return [(UNDETERMINED, 0.0)] * len(x)
        a = np.hstack([x, np.ones((len(x), 1), np.float32)])
        margins = a @ self.family_weights.T
        best = margins.argmax(axis=1)
        ordered = np.sort(margins, axis=1)
        lead = ordered[:, -1] - ordered[:, -2] if len(self.families) > 1 else np.full(len(x), np.inf)
        out: list[tuple[str, float]] = [("", 0.0)] * len(x)
        for f in set(best.tolist()):
            at = np.flatnonzero(best == f)
            langs, pairs = self.members[f], self.pairs[f]
            votes, sums = np.zeros((len(at), len(langs))), np.zeros((len(at), len(langs)))
            m = a[at] @ self.pair_weights[f].T if pairs else np.zeros((len(at), 0))
            for k, (i, j) in enumerate(pairs):
                votes[:, i] += m[:, k] > 0
                votes[:, j] += m[:, k] <= 0
                sums[:, i] += m[:, k]
                sums[:, j] -= m[:, k]
            win = (votes + 0.5 * np.tanh(sums / (1 + len(langs)))).argmax(axis=1)
            for r, w, row in zip(at, win, m, strict=True):
                # Margins of the winner in its own pairs; a lost one is negative.
                own = [row[k] if i == w else -row[k] for k, (i, j) in enumerate(pairs) if w in (i, j)]
                z = 3 * min([lead[r], *(2 * v for v in own)])
                out[r] = langs[w], float(1 / (1 + np.exp(-min(z, 50.0))))
        return out


def fit(x: np.ndarray, langs: list[str]) -> LanguageModel:
    names = np.array(langs, dtype=object)
    families = sorted({family_of(v) for v in langs})
    owner = np.array([family_of(v) for v in langs], dtype=object)
    members = [sorted({v for v in langs if family_of(v) == f}) for f in families]
    side = lambda mask: np.where(mask, 1, -1).astype(np.float32)
    if len(families) > 1:
        top = np.stack([fit_svm(x, side(owner == f)) for f in families])
    else:
        top = np.zeros((len(families), WIDTH + 1), np.float32)
    pairs, weights = [], []
    for group in members:
        pairs.append(list(combinations(range(len(group)), 2)))
        rows = []
        for i, j in pairs[-1]:
            both = (names == group[i]) | (names == group[j])
            rows.append(fit_svm(x[both], side(names[both] == group[i])))
        weights.append(np.stack(rows) if rows else np.zeros((0, WIDTH + 1), np.float32))
    return LanguageModel(families, members, top, pairs, weights)


def training_rows(docs: DataFrame, learn: Column, rows: int = TRAIN_ROWS) -> tuple[np.ndarray, list[str]]:
    """Vectors and labels of about ``rows`` labelled texts, chosen by their hashes, as many of each language."""
    known = in_small_batches(docs).where(F.col("lang").isNotNull() & F.col("text").isNotNull() & learn)
    counts = dict(known.groupBy("lang").count().collect())  # one row per label
    if not counts:
        return np.zeros((0, WIDTH), np.float32), []
    each, whole = max(20, rows // len(counts)), 1 << 30
    share = F.create_map(*[F.lit(x) for k, n in sorted(counts.items()) for x in (k, int(min(1.0, each / n) * whole))])
    taken = known.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(whole)) < share[F.col("lang")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(c.to_pylist() for c in batch.columns), strict=True)
            got = [(k, vector(t).astype(np.float16).tobytes()) for k, t in rows if has_letter(t)]
            columns = [pa.array([k for k, _ in got], pa.string()), pa.array([v for _, v in got], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "x"])

    got = taken.select("lang", "text").mapInArrow(run, "lang string, x binary").toArrow()
    pairs = sorted(zip(got.column("lang").to_pylist(), got.column("x").to_pylist(), strict=True))
    x = np.frombuffer(b"".join(v for _, v in pairs), dtype=np.float16).reshape(-1, WIDTH).astype(np.float32)
    return x, [k for k, _ in pairs]


def identified(model: LanguageModel, text: str = "text") -> Column:
    """Struct of ``lang_pred`` and ``score`` for the whole text of a column.

    Only texts go to the workers, only these two come back.
    """

    @F.pandas_udf("lang_pred string, score double")
    def run(texts: pd.Series) -> pd.DataFrame:
        out: list[tuple[str, float]] = [(UNDETERMINED, 0.0)] * len(texts)
        values = texts.tolist()
        at = [i for i, t in enumerate(values) if has_letter(t)]
        for first in range(0, len(at), 512):
            rows = at[first : first + 512]
            for i, made in zip(rows, model.predict(np.stack([vector(values[i]) for i in rows])), strict=True):
                out[i] = made
        return pd.DataFrame(out, columns=["lang_pred", "score"])

    return run(F.col(text))


def predict(docs: DataFrame, model: LanguageModel, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``docs`` with ``lang_pred`` and ``score`` of the whole text."""
    told = in_small_batches(docs).select(*[F.col(f"`{c}`") for c in keep], identified(model).alias("_told"))
    return told.select(*[F.col(f"`{c}`") for c in keep], "_told.lang_pred", "_told.score")
