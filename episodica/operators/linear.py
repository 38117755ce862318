"""Linear classifiers whose intercept is penalised like every other coefficient.

Objectives, with labels y of +1 and -1, C on the losses, and the intercept as the
coefficient of a constant one: half the squared norm (l2) or the sum of
absolute values (l1), plus C times the sum of log(1 + exp(-y w.x)) for logistic
regression, or of max(0, 1 - y w.x) squared for the support vector machine.

All fits on one table go on together: each pass over the blocks gives loss and
gradient of every fit that still runs, and the driver moves each of them. Up to
``NEWTON_UP_TO`` features a pass gives the curvature too, for Newton steps
(with the l1 penalty, to the quadratic model's optimum by feature signs); beyond,
limited-memory BFGS takes the steps, orthant-wise where the penalty is l1. Both lead to
the same optimum; the orthant-wise search may end a per mille above it. Coefficients are scaled by their column's root mean square for the
steps, which changes the path only.
"""

from __future__ import annotations

from collections.abc import Generator, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from episodica.operators.sparse import Block, Passes, blocks, entries
from episodica.session import cut_lineage

# Steps remembered, passes at most, and the largest slope (in the scale of the first one) at the end.
MEMORY, MAX_PASSES, TOLERANCE = 12, 400, 1e-8
NEWTON_UP_TO = 512
# Pairs of entries held at once; one takes as long as so many cells of a dense row's square.
PAIRS, PAIR_COST = 1 << 17, 24


@dataclass(frozen=True)
class Objective:
    loss: str  # logistic or squared_hinge
    penalty: str  # l1 or l2
    C: float


# A search yields points and takes value, slope and curvature (if asked for) of the smooth part there.
Search = Generator[np.ndarray, tuple[float, np.ndarray, np.ndarray | None], np.ndarray]


def _losses(kind: str, margin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Loss, its slope and its curvature in the margin."""
    if kind == "logistic":
        missing = 1 / (1 + np.exp(np.clip(margin, -700, 700)))
        return np.logaddexp(0, -margin), -missing, missing * (1 - missing)
    short = np.maximum(0, 1 - margin)
    return short * short, -2 * short, 2.0 * (short > 0)


def _newton_step(x: np.ndarray, slope: np.ndarray, curve: np.ndarray, l1: np.ndarray | None) -> np.ndarray:
    """The step to the minimum of the quadratic model."""
    curve = curve + np.diag(np.full(len(x), 1e-10 * max(np.trace(curve) / len(x), 1e-12)))
    if l1 is None:
        return -np.linalg.solve(curve, slope)
    # Feature signs: the optimum for given signs is a linear system; signs change one by one until all agree.
    z, linear, sign = x.copy(), slope - curve @ x, np.sign(x)
    slack = 1e-11 * max(np.abs(linear).max(initial=0.0), l1.max(initial=0.0), 1e-12)

    def at(points: np.ndarray) -> np.ndarray:
        return points @ linear + 0.5 * ((points @ curve) * points).sum(axis=1) + np.abs(points) @ l1

    for _ in range(20 * len(x) + 100):
        g = linear + curve @ z
        if np.all(np.abs(g + l1 * sign)[sign != 0] <= slack):
            excess = np.where(sign == 0, np.abs(g) - l1, -np.inf)
            j = int(np.argmax(excess))
            if excess[j] <= slack:
                break
            sign[j] = -np.sign(g[j])
        active = np.flatnonzero(sign)
        d = np.zeros(len(x))
        d[active] = np.linalg.solve(curve[np.ix_(active, active)], -(linear + l1 * sign)[active]) - z[active]
        with np.errstate(divide="ignore", invalid="ignore"):
            crossings = np.where((z != 0) & (d != 0), -z / d, 0.0)
        steps = np.append(crossings[(crossings > 0) & (crossings < 1)], 1.0)
        points = z + steps[:, None] * d
        for i, t in enumerate(steps[:-1]):
            points[i, crossings == t] = 0.0
        best = points[int(np.argmin(at(points)))]
        if np.array_equal(best, z):
            break
        z = best
        sign = np.sign(z)
    return z - x


def newton(size: int, l1: np.ndarray | None = None) -> Search:
    """Search by Newton steps, halved until the objective falls."""
    x = np.zeros(size)
    value, slope, curve = yield x
    total = value + (l1 @ np.abs(x) if l1 is not None else 0.0)
    for _ in range(MAX_PASSES):
        d = _newton_step(x, slope, curve, l1)
        fall = slope @ d + (l1 @ (np.abs(x + d) - np.abs(x)) if l1 is not None else 0.0)
        if np.abs(d).max(initial=0.0) <= 1e-10 * (1 + np.abs(x).max(initial=0.0)) or fall >= -1e-15 * abs(total):
            break
        step = 1.0
        for _ in range(40):
            point = x + step * d
            v, g, h = yield point
            now = v + (l1 @ np.abs(point) if l1 is not None else 0.0)
            if now <= total + 1e-4 * step * fall:
                break
            step /= 2
        else:
            break
        x, slope, curve, total = point, g, h, now
    return x


def _direction(slope: np.ndarray, steps: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Two-loop recursion: the slope times the inverse curvature that the last steps show."""
    q, kept = slope.copy(), []
    for s, y in reversed(steps):
        a = (s @ q) / (s @ y)
        kept.append(a)
        q -= a * y
    if steps:
        s, y = steps[-1]
        q *= (s @ y) / (y @ y)
    for (s, y), a in zip(steps, reversed(kept), strict=True):
        q += s * (a - (y @ q) / (s @ y))
    return -q


def minimise(size: int, l1: np.ndarray | None = None) -> Search:
    """Search by limited-memory BFGS; ``l1`` has the weight of each coefficient's absolute value."""
    x = np.zeros(size)
    value, smooth, _ = yield x
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    first = None

    def whole(point: np.ndarray, v: float) -> float:
        return v + (float(l1 @ np.abs(point)) if l1 is not None else 0.0)

    def pseudo(point: np.ndarray, g: np.ndarray) -> np.ndarray:
        if l1 is None:
            return g
        at_zero = np.where(g + l1 < 0, g + l1, np.where(g - l1 > 0, g - l1, 0.0))
        return np.where(point != 0, g + l1 * np.sign(point), at_zero)

    total = whole(x, value)
    for _ in range(MAX_PASSES):
        slope = pseudo(x, smooth)
        top = np.abs(slope).max(initial=0.0)
        first = top if first is None else first
        if top <= TOLERANCE * max(first, 1e-12):
            break
        d = _direction(slope, steps)
        if l1 is not None:
            d = np.where(d * slope < 0, d, 0.0)
        if d @ slope >= 0:
            steps, d = [], -slope
        orthant = np.where(x != 0, np.sign(x), -np.sign(slope))
        step = 1.0 if steps else 1.0 / max(np.sqrt(slope @ slope), 1e-12)
        for _ in range(60):
            point = x + step * d
            if l1 is not None:
                point = np.where(point * orthant > 0, point, 0.0)
            v, g, _ = yield point
            if whole(point, v) <= total + 1e-4 * (slope @ (point - x)):
                break
            step *= 0.5
        else:
            if not steps:
                break
            steps = []
            continue
        s, y = point - x, g - smooth
        if s @ y > 1e-12 * np.sqrt((s @ s) * (y @ y)):
            steps = [*steps[1 - MEMORY :], (s, y)] if len(steps) >= MEMORY else [*steps, (s, y)]
        same = total - whole(point, v) <= 1e-15 * abs(total) and np.abs(s).max() == 0
        x, value, smooth, total = point, v, g, whole(point, v)
        if same:
            break
    return x


def curvatures(block: Block, size: int, weights: Sequence[np.ndarray]) -> Iterator[np.ndarray]:
    """For each vector of row weights the weighted sum of the rows' outer squares, a constant one as last feature.

    Rows of few entries add the products of their pairs of entries; rows of many
    are one dense matrix product.
    """
    n, rows = size + 1, len(block.label)
    # Entries come ordered by code, so a stable sort by row leaves each row's codes in order.
    row = np.append(block.row, np.arange(rows))
    order = np.argsort(row, kind="stable")
    row, code = row[order], np.append(block.code, np.full(rows, size))[order].astype(np.int64)
    value = np.append(block.value, np.ones(rows))[order]
    ends = np.cumsum(np.bincount(row, minlength=rows))
    # An entry meets itself and those after it in its row.
    met = ends[row] - np.arange(len(row))
    upto = np.cumsum(met)
    if (upto[-1] if len(upto) else 0) * PAIR_COST >= rows * n * n:
        dense = np.zeros((rows, n))
        np.add.at(dense, (row, code), value)
        for w in weights:
            yield dense.T @ (w[:, None] * dense)
        return
    halves = np.zeros((len(weights), n * n))
    cuts = np.unique(np.searchsorted(upto, np.arange(0, upto[-1] if len(upto) else 0, PAIRS)))
    for a, b in zip(cuts, [*cuts[1:], len(row)], strict=True):
        left = np.repeat(np.arange(a, b), met[a:b])
        right = left + np.arange(len(left)) - np.repeat(upto[a:b] - met[a:b] - (upto[a] - met[a]), met[a:b])
        product = value[left] * value[right]
        product[left == right] /= 2
        cell, at = code[left] * n + code[right], row[left]
        for half, w in zip(halves, weights, strict=True):
            half += np.bincount(cell, product * w[at], n * n)
    for half in halves:
        yield half.reshape(n, n) + half.reshape(n, n).T


def fit_linear(train: DataFrame, objectives: Sequence[Objective], size: int) -> list[np.ndarray]:
    """Coefficients (the intercept last) of each objective on columns ``features`` (``size`` of them) and ``label``."""
    passes = Passes(cut_lineage(blocks(train, lambda feature, value: (feature, value))))

    def squares(block: Block, total: np.ndarray) -> None:
        total[:size] += np.bincount(block.code, block.value**2, size)
        total[size] += len(block.label)

    found = passes.vector_sum(size + 1, squares)
    scale = np.where(found > 0, np.sqrt(found / max(found[-1], 1)), 1.0)
    curved = size <= NEWTON_UP_TO
    search = newton if curved else minimise
    searches = [search(size + 1, 1 / scale if o.penalty == "l1" else None) for o in objectives]
    points = {i: next(s) for i, s in enumerate(searches)}
    results: dict[int, np.ndarray] = {}
    n = size + 1
    width = 1 + n + (n * n if curved else 0)
    while points:
        asked = [(i, objectives[i].loss, p / scale) for i, p in points.items()]

        def add(block: Block, total: np.ndarray, asked=asked) -> None:
            sign, parts, weights = np.where(block.label > 0, 1.0, -1.0), total.reshape(-1, width), []
            for part, (_, loss, w) in zip(parts, asked, strict=True):
                margin = sign * (np.bincount(block.row, block.value * w[block.code], len(sign)) + w[-1])
                losses, slopes, curves = _losses(loss, margin)
                slopes = slopes * sign
                part[0] += losses.sum()
                part[1:n] += np.bincount(block.code, block.value * slopes[block.row], size)
                part[n] += slopes.sum()
                weights.append(curves)
            if curved:
                for part, square in zip(parts, curvatures(block, size, weights), strict=True):
                    part[n + 1 :] += square.ravel()

        sums = passes.vector_sum(len(asked) * width, add).reshape(len(asked), width)
        for (i, _, w), own in zip(asked, sums, strict=True):
            o = objectives[i]
            value, slope = o.C * own[0], o.C * own[1 : n + 1]
            curve = o.C * own[n + 1 :].reshape(n, n) if curved else None
            if o.penalty == "l2":
                value, slope = value + w @ w / 2, slope + w
                curve = curve + np.eye(n) if curved else None
            try:
                points[i] = searches[i].send((value, slope / scale, curve / np.outer(scale, scale) if curved else None))
            except StopIteration as end:
                results[i] = end.value / scale
                del points[i]
    passes.close()
    return [results[i] for i in range(len(objectives))]


def linear_scores(rows: DataFrame, coefficients: np.ndarray, probability: bool) -> DataFrame:
    """The columns of ``rows`` but features, and ``score``: the margin, or the probability of logistic regression."""
    keep = [c for c in rows.columns if c != "features"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, feature, value = entries(batch.column(len(keep)))
            margin = np.bincount(row, value * coefficients[feature], batch.num_rows) + coefficients[-1]
            score = 1 / (1 + np.exp(-np.clip(margin, -700, 700))) if probability else margin
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], pa.array(score)], names=[*batch.schema.names[: len(keep)], "score"]
            )

    schema = T.StructType([*rows.select(*keep).schema, T.StructField("score", T.DoubleType())])
    return rows.select(*keep, "features").mapInArrow(run, schema)
