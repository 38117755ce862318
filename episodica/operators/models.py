"""Classifier families, their parameter grids, and fit-and-score."""

from __future__ import annotations

import json
import math
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from itertools import product

from pyspark import SparkContext
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassificationModel,
    GBTClassifier,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from episodica.operators.boosting import boosted_scores, fit_boosted_stumps
from episodica.operators.linear import Objective, fit_linear, linear_scores
from episodica.operators.neighbours import k_nearest, vote_shares
from episodica.operators.trees import Job, more_trees
from episodica.session import cut_lineage

# MLlib trees cannot be deeper.
MAX_DEPTH = 30
ROW_KEY = ["person_id", "episode_id"]

# The parameter grid of every family, as asked for.
FULL_GRID: dict[str, dict[str, list]] = {
    "RF": {"trees": [1, 10, 100, 1000, 10000], "depth": [10, 100, 500], "min_split": [2, 10]},
    "LR": {"penalty": ["l1", "l2"], "C": [0.001, 0.1, 1, 10]},
    "AB": {"rounds": [1, 10, 100, 1000, 10000]},
    "DT": {"depth": [1, 10, 20, 100, None], "min_split": [2, 5, 10]},
    "SVM": {"C": [0.01]},
    "KNN": {"k": [15, 25], "weights": ["uniform", "distance"]},
    "GB": {"trees": [10, 50, 100], "rate": [0.1, 0.5], "subsample": [0.1, 0.5], "depth": [5, 10]},
    "BG": {"trees": [10, 50, 100], "sample": [0.5]},
}
# The parameter by which the fit of one choice holds those of smaller ones.
SIZE = {"RF": "trees", "GB": "trees", "BG": "trees", "AB": "rounds"}
# Families whose choices are fitted together, in the same passes over the rows or side by side.
TOGETHER = ("LR", "SVM", "KNN", "GB")
# Of a forest, of a forest of deep trees and of a boosted sequence MLlib grows so many trees, tasks the others. Its counts
# for the open nodes of deep trees grow with the rows; beyond DEEP_ROWS all deep trees are grown in tasks.
SHALLOW, FIRST_TREES, FIRST_DEEP, DEEP_ROWS = 10, 100, 10, 100_000
# The chosen model.
BEST_MODEL = ("RF", {"trees": 1000, "depth": 10, "min_split": 2})


@dataclass(frozen=True)
class Cell:
    """One family with one choice of parameters, and the choices of a grid that it stands for."""

    family: str
    params: str
    requested: str

    @classmethod
    def of(cls, family: str, **params) -> Cell:
        text = json.dumps(params, sort_keys=True)
        return cls(family, text, text)

    def values(self) -> dict:
        return json.loads(self.params)


def supported(family: str, params: dict) -> dict:
    """The nearest parameters that MLlib can fit: trees of unlimited or greater depth are MAX_DEPTH deep."""
    if "depth" in params and (params["depth"] is None or params["depth"] > MAX_DEPTH):
        return params | {"depth": MAX_DEPTH}
    return params


def grid_cells(grid: dict[str, dict[str, list]] = FULL_GRID) -> list[Cell]:
    """All cells of a grid, family by family.

    Choices that lead to the same fit are one cell; ``requested`` lists them.
    """
    asked: dict[tuple[str, str], list[str]] = {}
    for family, choices in grid.items():
        for values in product(*choices.values()):
            params = dict(zip(choices, values))
            key = family, json.dumps(supported(family, params), sort_keys=True)
            asked.setdefault(key, []).append(json.dumps(params, sort_keys=True))
    return [Cell(family, params, " | ".join(texts)) for (family, params), texts in asked.items()]


def _depth(value: int) -> int:
    if value is None or value > MAX_DEPTH:
        raise ValueError(f"trees cannot be deeper than {MAX_DEPTH}: {value}; see supported()")
    return int(value)


def _leaf(min_split: int) -> int:
    # A node that needs m rows to split leaves at least m // 2 rows on average.
    return max(1, int(min_split) // 2)


def estimator(cell: Cell, seed: int = 0):
    """MLlib estimator of a tree family; None for the others.

    Where trees are deep or many, rows keep the node they are in, so that tasks do not get the trees grown so far.
    """
    p = cell.values()
    if cell.family == "RF":
        return RandomForestClassifier(
            numTrees=p["trees"], maxDepth=_depth(p["depth"]), minInstancesPerNode=_leaf(p["min_split"]),
            featureSubsetStrategy="sqrt", cacheNodeIds=True, seed=seed,
        )
    if cell.family == "DT":
        return DecisionTreeClassifier(
            impurity="gini", maxDepth=_depth(p["depth"]), minInstancesPerNode=_leaf(p["min_split"]), cacheNodeIds=True, seed=seed
        )
    if cell.family == "GB":
        return GBTClassifier(
            maxIter=p["trees"], stepSize=p["rate"], subsamplingRate=p["subsample"],
            maxDepth=_depth(p["depth"]), seed=seed,
        )
    if cell.family == "BG":
        return RandomForestClassifier(
            numTrees=p["trees"], maxDepth=MAX_DEPTH, featureSubsetStrategy="all",
            subsamplingRate=p["sample"], bootstrap=True, cacheNodeIds=True, seed=seed,
        )
    return None


def fit_trees(cell: Cell, train: DataFrame, seed: int = 0):
    """The fitted model of a tree family.

    In each pass every partition sends counts for all open nodes, and there are more of these the more rows there
    are; so the partitions are as many as tasks run at once, else the counts would grow with the square of the rows.
    """
    most = train.sparkSession.sparkContext.defaultParallelism
    # Of fewer, coalesce would still change the order where rows are cached, and with it the random draws.
    return estimator(cell, seed).fit(train.coalesce(most) if train.rdd.getNumPartitions() > most else train)


def _alike(cells: Iterable[Cell]) -> list[list[Cell]]:
    """Groups of cells that differ by their size only."""
    out: dict[tuple, list[Cell]] = {}
    for cell in cells:
        rest = {k: v for k, v in cell.values().items() if k != SIZE.get(cell.family)}
        out.setdefault((cell.family, json.dumps(rest, sort_keys=True)), []).append(cell)
    return list(out.values())


def nests(cells: Iterable[Cell]) -> list[list[Cell]]:
    """Groups of cells that are fitted together: alike but for their size, or in the same passes or side by side."""
    out: dict[tuple, list[Cell]] = {}
    for alike in _alike(cells):
        key = (alike[0].family,) if alike[0].family in TOGETHER else (alike[0].family, alike[0].params)
        out.setdefault(key, []).extend(alike)
    return list(out.values())


def first_trees(model, n: int):
    """The ensemble of the first ``n`` trees of a fitted forest or boosting sequence."""
    trees = model._java_obj.trees()
    sc = SparkContext.getOrCreate()
    jvm, gateway = sc._jvm, sc._gateway
    kinds, n = jvm.org.apache.spark.ml.classification, min(n, len(trees))
    boosted = isinstance(model, GBTClassificationModel)
    kind = jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel if boosted else kinds.DecisionTreeClassificationModel
    kept = gateway.new_array(kind, n)
    for i in range(n):
        kept[i] = trees[i]
    if boosted:
        weights = gateway.new_array(jvm.double, n)
        for i, w in enumerate(model.treeWeights[:n]):
            weights[i] = w
        return GBTClassificationModel(kinds.GBTClassificationModel(model.uid, kept, weights, model.numFeatures, 2))
    return RandomForestClassificationModel(kinds.RandomForestClassificationModel(model.uid, kept, model.numFeatures, 2))


def fit_and_score(cell: Cell, train: DataFrame, test: DataFrame, seed: int = 0) -> DataFrame:
    """Scores of the test rows: (person_id, episode_id, label, score).

    The support vector machine gives its margin, every other family a
    probability of the positive class.
    """
    return next(scores for _, scores in fit_and_score_all([cell], train, test, seed))


def fit_and_score_all(cells: Sequence[Cell], train: DataFrame, test: DataFrame, seed: int = 0) -> Iterator[tuple[Cell, DataFrame]]:
    """Each cell of one nest with its scores of the test rows; one fit serves all."""
    family = cells[0].family
    asked = test.select(*ROW_KEY, "label", "features")
    size = {c: c.values().get(SIZE.get(family)) for c in cells}
    if family == "AB":
        stumps = fit_boosted_stumps(train, max(size.values()))
        prior = 0.5 if stumps else train.agg(F.avg("label")).first()[0]
        staged = cut_lineage(boosted_scores(asked, stumps, sorted(set(size.values())), prior))
        for cell in cells:
            yield cell, staged.filter(F.col("size") == size[cell]).drop("size")
    elif family in ("LR", "SVM"):
        width = train.select(F.max(vector_size("features"))).first()[0] or 0
        goals = [_objective(c) for c in cells]
        for cell, w in zip(cells, fit_linear(train, goals, width), strict=True):
            yield cell, linear_scores(asked, w, probability=family == "LR")
    elif family == "KNN":
        yield from _neighbour_scores(cells, train, test)
    elif family == "DT":
        for cell in cells:
            yield cell, _probabilities(fit_trees(cell, train, seed), asked)
    else:
        yield from _ensemble_scores(cells, train, asked, seed)


def _probabilities(model, asked: DataFrame) -> DataFrame:
    return model.transform(asked).select(*ROW_KEY, "label", vector_to_array("probability")[1].alias("score"))


def first_size(cell: Cell, rows: int) -> int:
    """How many trees of an ensemble of any size MLlib grows, on so many training rows."""
    depth = cell.values().get("depth", MAX_DEPTH)
    if cell.family == "GB":
        return FIRST_DEEP
    return FIRST_TREES if depth <= SHALLOW else FIRST_DEEP if rows <= DEEP_ROWS else 0


def _resized(cell: Cell, trees: int) -> Cell:
    return Cell.of(cell.family, **(cell.values() | {"trees": trees}))


def further_trees(cell: Cell, first: int, sizes: Sequence[int], features: int) -> Job:
    """The trees from ``first`` on of an ensemble, as ``estimator`` would grow them."""
    p = cell.values()
    if cell.family == "GB":
        return Job(first, tuple(sizes), _depth(p["depth"]), p["subsample"], rate=p["rate"])
    if cell.family == "BG":
        return Job(first, tuple(sizes), MAX_DEPTH, p["sample"])
    return Job(first, tuple(sizes), _depth(p["depth"]), 1.0, _leaf(p["min_split"]), math.ceil(math.sqrt(features)))


def _ensemble_scores(cells: Sequence[Cell], train: DataFrame, asked: DataFrame, seed: int) -> Iterator[tuple[Cell, DataFrame]]:
    """Scores of forests and boosted sequences: the first trees are MLlib's, further ones are grown in tasks."""
    rows = train.count()
    features = train.select(F.max(vector_size("features"))).first()[0] or 0
    jobs, wanted = [], []
    learn, ask = train, asked
    for alike in _alike(cells):
        by_size = sorted(alike, key=lambda c: c.values()["trees"])
        first = min(first_size(by_size[-1], rows), by_size[-1].values()["trees"])
        model = fit_trees(_resized(by_size[-1], first), train, seed) if first else None
        for cell in by_size:
            size = cell.values()["trees"]
            if size <= first:
                yield cell, _probabilities(model if size == first else first_trees(model, size), asked)
        more = [c for c in by_size if c.values()["trees"] > first]
        if more:
            learn, ask = (_started(df, model, first, len(jobs)) for df in (learn, ask))
            jobs.append(further_trees(more[0], first, [c.values()["trees"] for c in more], features))
            wanted.append(more)
    if jobs:
        staged = cut_lineage(more_trees(jobs, learn, ask, seed)[0])
        for i, more in enumerate(wanted):
            for stage, cell in enumerate(more):
                yield cell, staged.filter((F.col("job") == i) & (F.col("stage") == stage)).select(*ROW_KEY, "label", "score")


def _started(rows: DataFrame, model, first: int, job: int) -> DataFrame:
    """``rows`` with what the first trees give them, as ``more_trees`` reads it."""
    if model is None:
        return rows
    out = "rawPrediction" if isinstance(model, GBTClassificationModel) else "probability"
    times = 1 if out == "rawPrediction" else first
    start = (vector_to_array(out)[1] * times).alias(f"_start{job}")
    return model.transform(rows).select(*rows.columns, start)


def forest(cell: Cell, train: DataFrame, test: DataFrame, seed: int = 0) -> tuple[DataFrame, Sequence[float]]:
    """Scores of the test rows and feature importances of one tree or ensemble of the given size."""
    asked = test.select(*ROW_KEY, "label", "features")
    trees = cell.values().get("trees", 1)
    first = min(first_size(cell, train.count()), trees) if cell.family in ("RF", "BG") else trees
    model = fit_trees(cell if first == trees else _resized(cell, first), train, seed) if first else None
    own = model.featureImportances.toArray() if first else 0.0
    if first == trees:
        return cut_lineage(_probabilities(model, asked)), own
    width = train.select(F.max(vector_size("features"))).first()[0] or 0
    job = further_trees(cell, first, [trees], width)
    scores, (others,) = more_trees([job], train, _started(asked, model, first, 0), seed)
    # Each tree's importances sum to one.
    total = own * first + others
    return cut_lineage(scores.select(*ROW_KEY, "label", "score")), total / max(total.sum(), 1e-300)


def vector_size(column: str):
    """Length of a vector, sparse or dense."""
    return F.size(vector_to_array(column))


def _objective(cell: Cell) -> Objective:
    p = cell.values()
    return Objective("logistic", p["penalty"], p["C"]) if cell.family == "LR" else Objective("squared_hinge", "l2", p["C"])


def _neighbour_scores(cells: Sequence[Cell], train: DataFrame, test: DataFrame) -> Iterator[tuple[Cell, DataFrame]]:
    key = F.concat_ws("|", *ROW_KEY)
    vector = vector_to_array("features")
    rows = train.select(key.alias("key"), vector.alias("vector"), F.col("label").cast("int").alias("label"))
    asks = test.select(key.alias("key"), vector.alias("vector"))
    # The nearest k are the first of the nearest of a larger k.
    near = cut_lineage(k_nearest(rows, asks, max(c.values()["k"] for c in cells)))
    keyed = test.select(*ROW_KEY, "label", key.alias("query"))
    for cell in cells:
        p = cell.values()
        shares = vote_shares(near.filter(F.col("place") <= p["k"]), p["weights"])
        positive = shares.groupBy("query").agg(F.sum(F.when(F.col("label") == 1, F.col("share")).otherwise(0.0)).alias("score"))
        yield cell, keyed.join(positive, "query").select(*ROW_KEY, "label", "score")


def importance_rows(values: Sequence[float], names: list[str], spark) -> DataFrame:
    """Feature importances of a fitted tree ensemble, by name."""
    rows = [(n, float(v)) for n, v in zip(names, values)]
    return spark.createDataFrame(rows, "feature string, importance double")
