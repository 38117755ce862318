"""Boosted decision stumps (SAMME, two classes) on binned sparse features.

Every feature is cut once into at most ``MAX_BINS`` bins: at the midpoints
between its values where it has so few, else between quantiles of its distinct
values. A round adds up the rows' weights by bin and class; the sums give the best
stump, its error and its votes together. One task makes all rounds where it can hold
the rows. Of more rows a round is one pass: tasks bring their rows' weights up to
date and add them up. Weights are written every ``REWEIGHT`` rounds, so a pass
repeats only the rounds since then.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from episodica.operators.sparse import SCHEMA, Block, Passes, blocks, entries
from episodica.session import cut_lineage

MAX_BINS, REWEIGHT = 256, 100
# Bytes of codes, 4 for each entry, that one task holds for all rounds; more rows are read in a pass for each round.
HELD_BYTES = 128 << 20
STUMP = ["feature", "threshold", "left", "right", "alpha"]


@dataclass(frozen=True)
class WeightedStump:
    """Votes +1 or -1 by one threshold on one feature."""

    feature: int
    threshold: float
    left: int
    right: int
    alpha: float = 1.0


@dataclass
class Bins:
    """Thresholds of all features in one array; feature f has those from ``start[f]`` on, and one bin more than thresholds."""

    start: np.ndarray
    thresholds: np.ndarray

    @staticmethod
    def of(values: Sequence[np.ndarray]) -> Bins:
        """From the ascending values of each feature, zero included where a row has none."""
        cuts = [(v[:-1] + v[1:]) / 2 for v in values]
        return Bins(np.cumsum([0, *map(len, cuts)]), np.concatenate([*cuts, np.zeros(0)]))

    def offsets(self) -> np.ndarray:
        """Number of the first bin of each feature."""
        return self.start + np.arange(len(self.start))

    def code(self, feature: np.ndarray, value: np.ndarray) -> np.ndarray:
        """Number of each entry's bin, over all features."""
        out = np.empty(len(feature), np.int64)
        order = np.argsort(feature, kind="stable")
        names, first = np.unique(feature[order], return_index=True)
        for f, at in zip(names, np.split(order, first[1:]), strict=True):
            out[at] = np.searchsorted(self.thresholds[self.start[f] : self.start[f + 1]], value[at])
        return out + self.offsets()[feature]

    def zero(self) -> np.ndarray:
        """The bin of value zero of each feature."""
        every = np.arange(len(self.start) - 1)
        return self.code(every, np.zeros(len(every)))


def fit_bins(rows: DataFrame) -> Bins:
    """Bins of the vectors in column ``features``; one row for each feature comes to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, feature, value = entries(batch.column(0))
            size = max(batch.column(0).field("size").drop_null().to_pylist(), default=0)
            lengths = batch.column(0).field("values").value_lengths().to_pylist()
            size = max(size, max((n or 0 for n in lengths), default=0))
            pairs, n = np.unique(np.stack([feature, value]), axis=1, return_counts=True)
            # The last row tells the number of rows and of features.
            columns = [
                pa.array([*pairs[0].astype(int), -1, -2], pa.int32()), pa.array([*pairs[1], 0.0, float(size)], pa.float64()),
                pa.array([*n, batch.num_rows, 0], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["feature", "value", "n"])

    pairs = cut_lineage(
        rows.select("features").mapInArrow(run, "feature int, value double, n long").groupBy("feature", "value").agg(F.sum("n").alias("n"))
    )
    probs = [i / (MAX_BINS - 1) for i in range(MAX_BINS)]
    found = {
        r["feature"]: (r["n"], sorted(set(r["values"])))
        for r in pairs.groupBy("feature").agg(F.sum("n").alias("n"), F.percentile_approx("value", probs, 10_000).alias("values")).collect()
    }
    if -1 not in found:
        return Bins.of([])
    count, size = found[-1][0], int(max(found[-2][1]))
    values = []
    for f in range(size):
        n, own = found.get(f, (0, []))
        values.append(np.array(sorted({*own, 0.0}) if n < count else own))
    return Bins.of(values)


def _reweigh(block: Block, bins: Bins, zero: np.ndarray, stumps: list[tuple[WeightedStump, int, float]]) -> np.ndarray:
    """The block's weights after ``stumps``: each with the last bin left of its threshold and its factor for all rows."""
    weight, offsets = block.weight.copy(), bins.offsets()
    sign = np.where(block.label > 0, 1, -1)
    for stump, last, scale in stumps:
        f = stump.feature
        vote = np.full(len(weight), stump.left if zero[f] <= last else stump.right)
        a, b, c = np.searchsorted(block.code, [offsets[f], last + 1, offsets[f + 1]])
        vote[block.row[a:b]], vote[block.row[b:c]] = stump.left, stump.right
        weight *= np.where(vote != sign, math.exp(stump.alpha), 1.0) * scale
    return weight


def _best(sums: np.ndarray, bins: Bins, zero: np.ndarray) -> tuple[WeightedStump, int, float, float] | None:
    """The stump of the largest Gini gain, the last bin on its left, the weight it misses and the weight of all rows."""
    whole, by_bin = sums[-2:], sums[:-2].reshape(-1, 2).copy()
    offsets = bins.offsets()
    total = np.add.reduceat(by_bin, offsets[:-1], axis=0) if len(zero) else by_bin
    by_bin[zero] += whole - total
    running = np.cumsum(by_bin, axis=0)
    feature = np.repeat(np.arange(len(zero)), np.diff(bins.start))
    # A feature's last bin has no threshold to its right.
    place = np.arange(len(bins.thresholds)) + feature
    if not len(place) or whole.sum() <= 0:
        return None
    before = np.vstack([np.zeros(2), running])[offsets[feature]]
    left = running[place] - before
    right = whole - left

    def impurity(side: np.ndarray) -> np.ndarray:
        n = side.sum(axis=-1)
        return 2 * side[..., 0] * side[..., 1] / np.where(n > 0, n, 1)

    gain = (impurity(whole) - impurity(left) - impurity(right)) / whole.sum()
    best = int(np.argmax(np.round(gain, 12)))
    if gain[best] <= 1e-12:
        return None
    votes = [1 if side[1] > side[0] else -1 for side in (left[best], right[best])]
    missed = float(min(left[best]) + min(right[best]))
    return WeightedStump(int(feature[best]), float(bins.thresholds[best]), *votes), int(place[best]), missed, float(whole.sum())


def fit_boosted_stumps(train: DataFrame, rounds: int) -> list[WeightedStump]:
    """Fit up to ``rounds`` stumps on columns ``features`` and ``label``.

    Each round reweights the rows the last stump got wrong. It stops early at a
    stump without error or one no better than chance. Fewer rounds give the
    first of the same stumps.
    """
    bins = fit_bins(train)
    coded = cut_lineage(blocks(train, lambda feature, value: (bins.code(feature, value), value)))
    held = coded.agg(F.sum(F.length("code"))).first()[0] or 0
    if held <= HELD_BYTES:
        return _fit_in_task(coded, rounds, bins)
    return _fit_by_passes(coded, rounds, bins)


def _next_stump(sums: np.ndarray, bins: Bins, zero: np.ndarray) -> tuple[WeightedStump, tuple | None] | None:
    """The stump that follows from the sums of weights, and how it changes weights; None for that where it is the last one."""
    found = _best(sums, bins, zero)
    if found is None:
        return None
    stump, last, missed, whole = found
    error = missed / whole
    if error <= 1e-12:
        return stump, None
    if error >= 0.5:
        return None
    stump = WeightedStump(stump.feature, stump.threshold, stump.left, stump.right, math.log((1 - error) / error))
    # Weights keep their sum.
    return stump, (stump, last, whole / (whole + missed * (math.exp(stump.alpha) - 1)))


def _fit_in_task(coded: DataFrame, rounds: int, bins: Bins) -> list[WeightedStump]:
    """All rounds in one task that holds the rows: a round has no job of its own."""
    zero, size = bins.zero(), len(bins.thresholds) + len(bins.start) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = sorted(Block.read(batches), key=lambda b: (len(b.label), b.code.tobytes(), b.row.tobytes(), b.label.tobytes()))
        if not parts:
            return
        before = np.cumsum([0, *(len(b.label) for b in parts)])
        row = np.concatenate([b.row + n for b, n in zip(parts, before[:-1], strict=True)])
        code, label = np.concatenate([b.code for b in parts]), np.concatenate([b.label for b in parts])
        # Entries of one bin and class lie together.
        slot = 2 * code.astype(np.int64) + label[row]
        order = np.argsort(slot, kind="stable")
        slots, first = np.unique(slot[order], return_index=True)
        block = Block(label, np.concatenate([b.weight for b in parts]), row[order], code[order], np.zeros(0))
        total = np.zeros(2 * size + 2)
        for _ in range(rounds):
            if len(first):
                total[slots] = np.add.reduceat(block.weight[block.row], first)
            total[-2:] = np.bincount(block.label, block.weight, 2)
            found = _next_stump(total, bins, zero)
            if found is None:
                return
            stump, change = found
            columns = [[stump.feature], [stump.threshold], [stump.left], [stump.right], [stump.alpha]]
            kinds = [pa.int32(), pa.float64(), pa.int32(), pa.int32(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=STUMP)
            if change is None:
                return
            block.weight = _reweigh(block, bins, zero, [change])

    schema = "feature int, threshold double, left int, right int, alpha double"
    # The rows come in the order of the rounds: one task makes them all.
    return [WeightedStump(*r) for r in coded.coalesce(1).mapInArrow(run, schema).collect()]


def _fit_by_passes(coded: DataFrame, rounds: int, bins: Bins) -> list[WeightedStump]:
    """One pass over the rows a round."""
    zero, size = bins.zero(), len(bins.thresholds) + len(bins.start) - 1
    passes = Passes(coded)
    stumps: list[WeightedStump] = []
    recent: list[tuple[WeightedStump, int, float]] = []

    def add(block: Block, total: np.ndarray) -> None:
        weight = _reweigh(block, bins, zero, recent)
        total[:-2] += np.bincount(2 * block.code + block.label[block.row], weight[block.row], 2 * size)
        total[-2:] += np.bincount(block.label, weight, 2)

    def reweighted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in Block.read(batches):
            block.weight = _reweigh(block, bins, zero, recent)
            yield block.record()

    for _ in range(rounds):
        found = _next_stump(passes.vector_sum(2 * size + 2, add), bins, zero)
        if found is None:
            break
        stump, change = found
        stumps.append(stump)
        if change is None:
            break
        recent.append(change)
        if len(recent) == REWEIGHT:
            grown = cut_lineage(passes.table.mapInArrow(reweighted, SCHEMA))
            passes.close()
            passes, recent = Passes(grown), []
    passes.close()
    return stumps


def _votes(stumps: Sequence[WeightedStump]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Per feature its thresholds, ascending, and the summed votes of all its stumps between them."""
    out = {}
    for f in sorted({s.feature for s in stumps}):
        own = [s for s in stumps if s.feature == f]
        cuts = np.unique([s.threshold for s in own])
        sums = np.zeros(len(cuts) + 1)
        for s in own:
            at = int(np.searchsorted(cuts, s.threshold))
            sums[: at + 1] += s.left * s.alpha
            sums[at + 1 :] += s.right * s.alpha
        out[f] = cuts, sums
    return out


def boosted_scores(rows: DataFrame, stumps: Sequence[WeightedStump], sizes: Sequence[int], prior: float = 0.5) -> DataFrame:
    """The columns of ``rows`` but features, ``size`` and ``score``: the share-like score by the first ``size`` stumps, for each of ``sizes``.

    A row's score is that of a row of zeros, and what its own entries change;
    so the work does not grow with the stumps. ``prior`` is the score where
    there are none.
    """
    keep = [c for c in rows.columns if c != "features"]
    stages = [(n, _votes(stumps[:n]), sum(s.alpha for s in stumps[:n])) for n in sizes]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, feature, value = entries(batch.column(len(keep)))
            order = np.argsort(feature, kind="stable")
            row, feature, value = row[order], feature[order], value[order]
            for n, votes, alphas in stages:
                margin = np.zeros(batch.num_rows)
                for f, (cuts, sums) in votes.items():
                    a, b = np.searchsorted(feature, [f, f + 1])
                    at_zero = sums[np.searchsorted(cuts, 0.0)]
                    margin += at_zero
                    margin[row[a:b]] += sums[np.searchsorted(cuts, value[a:b])] - at_zero
                score = 1 / (1 + np.exp(-2 * margin / alphas)) if votes else np.full(batch.num_rows, float(prior))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[: len(keep)], pa.array(np.full(batch.num_rows, n), pa.int32()), pa.array(score)],
                    names=[*batch.schema.names[: len(keep)], "size", "score"],
                )

    schema = T.StructType([*rows.select(*keep).schema, T.StructField("size", T.IntegerType()), T.StructField("score", T.DoubleType())])
    return rows.select(*keep, "features").mapInArrow(run, schema)
