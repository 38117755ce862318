"""Linear models and boosted stumps against plain numpy, and nested fits against cut ones."""

import math
import random

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql import types as T

from episodica.operators import boosting, linear, models, sparse
from episodica.operators.linear import Objective
from episodica.operators.models import Cell

SCHEMA = T.StructType(
    [T.StructField("person_id", T.LongType()), T.StructField("episode_id", T.LongType()),
     T.StructField("label", T.DoubleType()), T.StructField("features", VectorUDT())]
)


@pytest.fixture(scope="module")
def data(spark):
    """Dummies, counts and unscaled numbers; sparse and dense vectors; one column is always zero."""
    rng = np.random.default_rng(3)
    n = 500
    kind = rng.integers(0, 4, n)
    x = np.column_stack([*(kind == k for k in range(4)), rng.poisson(0.7, n), rng.normal(60, 15, n), rng.normal(0, 1, n), np.zeros(n)]).astype(float)
    y = (0.05 * x[:, 5] + x[:, 4] - 1.5 * x[:, 0] + rng.normal(0, 1, n) > 3.6).astype(float)
    rows = [
        (i, i, float(y[i]), Vectors.dense(v) if i % 3 == 0 else Vectors.sparse(8, [(j, v[j]) for j in np.flatnonzero(v)])) for i, v in enumerate(x)
    ]
    return x, y, spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


def value(objective, w, x, y):
    margin = np.where(y > 0, 1, -1) * (x @ w[:-1] + w[-1])
    loss = np.logaddexp(0, -margin).sum() if objective.loss == "logistic" else (np.maximum(0, 1 - margin) ** 2).sum()
    return objective.C * loss + (w @ w / 2 if objective.penalty == "l2" else np.abs(w).sum())


def plain(objective, x, y):
    """Proximal gradient steps with momentum on scaled columns, until nothing moves."""
    ones = np.column_stack([x, np.ones(len(x))])
    scale = np.maximum(np.sqrt((ones**2).mean(axis=0)), 1e-9)
    scale[scale == 1e-9] = 1
    z, sign = ones / scale, np.where(y > 0, 1, -1)
    top = objective.C * np.linalg.norm(z, 2) ** 2 * (0.25 if objective.loss == "logistic" else 2)
    step = 1 / (top + (1 / scale.min() ** 2 if objective.penalty == "l2" else 0))
    u, ahead, t = np.zeros(z.shape[1]), np.zeros(z.shape[1]), 1.0
    for _ in range(200_000):
        margin = sign * (z @ ahead)
        slopes = -1 / (1 + np.exp(margin)) if objective.loss == "logistic" else -2 * np.maximum(0, 1 - margin)
        g = objective.C * (z.T @ (slopes * sign)) + (ahead / scale**2 if objective.penalty == "l2" else 0)
        new = ahead - step * g
        if objective.penalty == "l1":
            new = np.sign(new) * np.maximum(np.abs(new) - step / scale, 0)
        if (ahead - new) @ (new - u) > 0:
            t = 1.0
        after = (1 + math.sqrt(1 + 4 * t * t)) / 2
        ahead, moved = new + (t - 1) / after * (new - u), np.abs(new - u).max()
        u, t = new, after
        if moved < 1e-14:
            break
    return u / scale


OBJECTIVES = [
    Objective("logistic", "l2", 1.0), Objective("logistic", "l1", 0.1), Objective("logistic", "l1", 10.0),
    Objective("squared_hinge", "l2", 0.01), Objective("squared_hinge", "l2", 1.0),
]


@pytest.mark.parametrize("newton", [True, False])
def test_optimum_is_that_of_plain_numpy(data, monkeypatch, newton):
    x, y, df = data
    monkeypatch.setattr(linear, "NEWTON_UP_TO", 512 if newton else 0)
    goals = OBJECTIVES if newton else [o for o in OBJECTIVES if o.C <= 1 and o != OBJECTIVES[3]]
    for objective, w in zip(goals, linear.fit_linear(df, goals, 8), strict=True):
        want = plain(objective, x, y)
        best = value(objective, want, x, y)
        assert value(objective, w, x, y) <= best * (1 + (1e-6 if newton or objective.penalty == "l2" else 1e-3))
        if newton:
            margins = {r.person_id: r.score for r in linear.linear_scores(df, w, probability=False).collect()}
            assert np.allclose([margins[i] for i in range(len(x))], x @ want[:-1] + want[-1], atol=1e-4)


def test_probability_and_pure_labels(data, spark):
    _, _, df = data
    scores = models.fit_and_score(Cell.of("LR", penalty="l2", C=1), df.withColumn("label", F.lit(1.0)), df).collect()
    assert all(0.5 < r.score <= 1 for r in scores) and len(scores) == 500
    empty = df.limit(0)
    assert models.fit_and_score(Cell.of("LR", penalty="l1", C=1), df, empty).collect() == []


def plain_stumps(x, y, rounds):
    """SAMME on all midpoints between the values of each column."""
    weight, out = np.ones(len(y)), []
    for _ in range(rounds):
        best = None
        for f in range(x.shape[1]):
            values = np.unique(x[:, f])
            for t in (values[:-1] + values[1:]) / 2:
                left, after, votes, missed = x[:, f] <= t, 0.0, [], 0.0
                for side in (left, ~left):
                    pos, neg = weight[side & (y > 0)].sum(), weight[side & (y <= 0)].sum()
                    after += 2 * pos * neg / (pos + neg)
                    votes.append(1 if pos > neg else -1)
                    missed += min(pos, neg)
                if best is None or after < best[0] - 1e-9:
                    best = (after, f, t, *votes, missed / weight.sum())
        _, f, t, a, b, error = best
        alpha = math.log((1 - error) / error)
        out.append((f, t, a, b, alpha))
        vote = np.where(x[:, f] <= t, a, b)
        wrong = vote != np.where(y > 0, 1, -1)
        weight = weight * np.where(wrong, math.exp(alpha), 1)
    return out


def test_stumps_are_those_of_plain_numpy(spark, monkeypatch):
    monkeypatch.setattr(boosting, "REWEIGHT", 4)
    rng = random.Random(5)
    x = np.array([[rng.randrange(3), rng.randrange(-4, 5), rng.random() < 0.2, rng.randrange(100)] for _ in range(400)], dtype=float)
    y = np.array([float(a + b / 2 + 2 * c + d / 50 + rng.random() > 3) for a, b, c, d in x])
    df = spark.createDataFrame([(i, i, float(y[i]), Vectors.dense(v)) for i, v in enumerate(x)], SCHEMA).repartition(3)
    got = boosting.fit_boosted_stumps(df, 10)
    want = plain_stumps(x, y, 10)
    assert [(s.feature, s.threshold, s.left, s.right) for s in got] == [w[:4] for w in want]
    assert np.allclose([s.alpha for s in got], [w[4] for w in want])
    # Scores of the first stumps are those of a shorter fit, from the sums over all votes.
    scores = {(r.person_id, r["size"]): r.score for r in boosting.boosted_scores(df, got, [3, 10]).collect()}
    for n in (3, 10):
        votes = sum(np.where(x[:, f] <= t, a, b) * alpha for f, t, a, b, alpha in want[:n])
        expected = 1 / (1 + np.exp(-2 * votes / sum(w[4] for w in want[:n])))
        assert np.allclose([scores[i, n] for i in range(len(x))], expected)


def test_many_parts_are_added_in_tasks(data, monkeypatch):
    _, y, df = data
    monkeypatch.setattr(sparse, "FEW_VECTORS", 2)
    passes = sparse.Passes(sparse.blocks(df.repartition(9), lambda f, v: (f, v)))
    total = passes.vector_sum(1, lambda block, out: out.__iadd__(block.label.sum()))
    assert total[0] == y.sum()


@pytest.mark.parametrize(
    "large, small",
    [
        (Cell.of("RF", trees=12, depth=5, min_split=2), Cell.of("RF", trees=4, depth=5, min_split=2)),
        (Cell.of("GB", trees=6, rate=0.1, subsample=0.5, depth=3), Cell.of("GB", trees=2, rate=0.1, subsample=0.5, depth=3)),
        (Cell.of("BG", trees=6, sample=0.5), Cell.of("BG", trees=2, sample=0.5)),
    ],
    ids=["RF", "GB", "BG"],
)
def test_smaller_sizes_are_the_first_trees(data, large, small):
    """The small cell's scores are those of the trees that the large one starts with."""
    _, _, df = data
    assert models.nests([large, small]) == [[large, small]]
    both = dict(models.fit_and_score_all([large, small], df, df))
    got = {r.person_id: r.score for r in both[small].collect()}
    model = models.estimator(large).fit(df)
    n = list(small.values().values())[-1]
    trees = model.trees[:n]
    votes = np.zeros(500)
    for i, tree in enumerate(trees):
        column = "prediction" if small.family == "GB" else "probability"
        for r in tree.transform(df).select("person_id", column).collect():
            votes[r.person_id] += model.treeWeights[i] * r.prediction if small.family == "GB" else r.probability[1] / n
    want = 1 / (1 + np.exp(-2 * votes)) if small.family == "GB" else votes
    assert np.allclose([got[i] for i in range(500)], want)


def test_neighbours_of_all_choices_come_from_one_search(data):
    _, _, df = data
    cells = [Cell.of("KNN", k=k, weights=w) for k in (3, 5) for w in ("uniform", "distance")]
    together = dict(models.fit_and_score_all(cells, df, df))
    for cell in cells:
        alone = {r.person_id: r.score for r in models.fit_and_score(cell, df, df).collect()}
        assert {r.person_id: pytest.approx(r.score) for r in together[cell].collect()} == alone


@pytest.mark.parametrize("cost", [0, 10**9])
def test_curvatures_from_pairs_of_entries(monkeypatch, cost):
    """Pairs, in runs that end within a row, and the dense product give the same; a row without entries, and one that names a code twice."""
    monkeypatch.setattr(linear, "PAIR_COST", cost)
    monkeypatch.setattr(linear, "PAIRS", 7)
    rng = np.random.default_rng(1)
    entries = [(i, j) for j in range(6) for i in range(40) if i != 5 and rng.random() < 0.5] + [(9, 5), (9, 5)]
    row, code = (np.array(c, np.int32) for c in zip(*entries))
    block = sparse.Block(np.ones(40), np.ones(40), row, code, rng.normal(size=len(row)))
    x = np.zeros((40, 7))
    np.add.at(x, (row, code), block.value)
    x[:, 6] = 1
    weights = [rng.random(40), np.zeros(40), np.ones(40)]
    for got, w in zip(linear.curvatures(block, 6, weights), weights, strict=True):
        assert np.allclose(got, x.T @ (w[:, None] * x), rtol=1e-12, atol=1e-12)
    empty = sparse.Block(*[np.zeros(0, t) for t in (bool, float, np.int32, np.int32, float)])
    assert all(not got.any() for got in linear.curvatures(empty, 6, [np.zeros(0)]))
