"""Trees grown in tasks are those of MLlib where nothing is drawn; every cell of a family has its scores."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from episodica.checks import fits
from episodica.operators import boosting, models, trees
from episodica.operators.models import Cell
from episodica.plans import model_grid


@pytest.fixture(scope="module")
def sides(spark):
    rng = np.random.default_rng(3)
    x = np.round(rng.random((500, 6)) * 8) * (rng.random((500, 6)) < 0.6)
    y = (x[:, 0] + x[:, 1] * x[:, 2] / 4 - x[:, 3] + rng.normal(0, 1, 500) > 3).astype(float)
    rows = [(i, i % 7, y[i], Vectors.sparse(6, [(j, v) for j, v in enumerate(map(float, r)) if v])) for i, r in enumerate(x)]
    rows = [(i, e, float(label), v) for i, e, label, v in rows]
    df = spark.createDataFrame(rows, ["person_id", "episode_id", "label", "features"]).cache()
    return df.filter("person_id < 350"), df.filter("person_id >= 350")


def by_person(scores):
    return {r.person_id: r.score for r in scores.collect()}


@pytest.mark.parametrize("family, sizes", [("AB", 5), ("GB", 24)])
def test_family_queries_have_all_cells(family, sizes):
    name = {"AB": "model_adaboost", "GB": "model_gbt"}[family]
    assert fits.FAMILY_CELLS[name] == [c for c in models.grid_cells() if c.family == family] and len(fits.FAMILY_CELLS[name]) == sizes


def test_forest_query_has_all_sizes():
    assert {c.values()["trees"] for c in fits.FAMILY_CELLS["model_rf"]} == {1, 10, 100, 1000, 10000}
    assert {c.values()["min_split"] for c in fits.FAMILY_CELLS["model_rf"]} == {2, 10}


def test_grid_query_has_all_cells(monkeypatch):
    asked = []
    monkeypatch.setattr(fits, "scored_grid", lambda spark, sf_dir, cells: asked.extend(cells))
    fits.grid(None, None)
    assert asked == models.grid_cells()


def test_stumps_of_one_task_and_of_passes_agree(sides, monkeypatch):
    train = sides[0].repartition(5)
    held = boosting.fit_boosted_stumps(train, 12)
    monkeypatch.setattr(boosting, "HELD_BYTES", 0)
    monkeypatch.setattr(boosting, "REWEIGHT", 5)
    passed = boosting.fit_boosted_stumps(train, 12)
    assert [(s.feature, s.threshold, s.left, s.right) for s in held] == [(s.feature, s.threshold, s.left, s.right) for s in passed]
    assert np.allclose([s.alpha for s in held], [s.alpha for s in passed])


@pytest.mark.parametrize("slots, entries", [(1 << 21, 1 << 20), (8, 50)])
@pytest.mark.parametrize("depth, leaf", [(4, 1), (10, 3), (30, 1)])
def test_one_tree_is_that_of_mllib(sides, monkeypatch, depth, leaf, slots, entries):
    monkeypatch.setattr(trees, "SLOTS", slots)
    monkeypatch.setattr(trees, "TILE_ENTRIES", entries)
    train, test = sides
    model = models.fit_trees(Cell.of("DT", depth=depth, min_split=2 * leaf), train)
    bins = boosting.fit_bins(train)
    rows, tests = (
        trees._held([r.asDict() for r in trees._blocks(df.coalesce(1).withColumn("_start0", F.lit(0.0)), False, 1, bins).collect()], 1, np.uint16)[0]
        for df in sides
    )
    n, layout = len(rows.label), trees.Layout.of(bins)
    job = trees.Job(0, (1,), depth, 1.0, leaf)
    grown, gains = trees.grow(rows, layout, np.arange(n), np.zeros(n, int), np.ones(n), rows.label, job, [np.random.default_rng(0)])
    got = np.concatenate([v[0] for _, v in trees.scored(grown, tests, layout, 1)])
    want = [r.probability[1] for r in model.transform(test.coalesce(1)).collect()]
    assert np.allclose(got, want)
    assert np.allclose(gains[0] / gains.sum(), model.featureImportances.toArray())


def test_boosting_goes_on_where_mllib_ended(sides, monkeypatch):
    monkeypatch.setattr(models, "FIRST_DEEP", 2)
    cells = [Cell.of("GB", trees=n, rate=0.5, subsample=1.0, depth=3) for n in (1, 2, 4, 6)]
    got = dict(models.fit_and_score_all(cells, *sides))
    model = models.fit_trees(cells[-1], sides[0])
    for cell in cells:
        want = by_person(models._probabilities(models.first_trees(model, cell.values()["trees"]), sides[1]))
        found = by_person(got[cell])
        # Splits of equal gain are told apart by rounding, so a few test rows may go another way.
        assert found.keys() == want.keys() and np.mean([abs(found[p] - want[p]) < 1e-9 for p in want]) > 0.95


@pytest.mark.parametrize("family", ["RF", "BG"])
def test_further_trees_of_forests(sides, monkeypatch, family):
    """Sizes within MLlib's trees are MLlib's; the others start with them, in any order and number of partitions."""
    monkeypatch.setattr(models, "FIRST_TREES", 3)
    monkeypatch.setattr(models, "FIRST_DEEP", 3)
    rest = {"RF": {"depth": 5, "min_split": 2}, "BG": {"sample": 0.5}}[family]
    cells = [Cell.of(family, trees=n, **rest) for n in (2, 3, 9, 40)]
    train, test = sides
    got = {c.values()["trees"]: by_person(s) for c, s in models.fit_and_score_all(cells, train, test)}
    assert all(len(s) == 150 and all(0 <= x <= 1 for x in s.values()) for s in got.values())
    model = models.fit_trees(cells[1], train)
    first = by_person(models._probabilities(model, test))
    assert got[3] == first
    # Six more trees change a mean of three by two thirds at most.
    assert all(3 / 9 * first[p] - 1e-9 <= s <= 3 / 9 * first[p] + 6 / 9 + 1e-9 for p, s in got[9].items())
    label = {r.person_id: r.label for r in test.collect()}
    assert np.corrcoef(list(got[40].values()), [label[p] for p in got[40]])[0, 1] > 0.6
    job = trees.Job(0, (4, 9), 5, 1.0, 1, 3)
    wanted = {(r.person_id, r.stage): r.score for r in trees.more_trees([job], train, test)[0].collect()}
    spread = {(r.person_id, r.stage): r.score for r in trees.more_trees([job], train.repartition(6), test.repartition(3))[0].collect()}
    assert wanted == spread and len(wanted) == 300


def test_importances_of_all_trees_sum_to_one(sides, monkeypatch):
    monkeypatch.setattr(models, "FIRST_TREES", 3)
    scores, values = models.forest(Cell.of("RF", trees=12, depth=5, min_split=2), *sides)
    assert scores.count() == 150 and sum(values) == pytest.approx(1) and max(range(6), key=lambda i: values[i]) == 0


def test_keys_that_repeat_or_miss_keep_their_rows(sides):
    train, test = sides
    asked = test.limit(20)
    asked = asked.unionByName(asked).withColumn("episode_id", F.lit(None).cast("long"))
    scores, _ = trees.more_trees([trees.Job(0, (5,), 6, 1.0, 1, 3)], train, asked)
    assert scores.count() == 40 and scores.groupBy("person_id").agg(F.countDistinct("score").alias("n")).filter("n > 1").count() == 0


def test_deep_trees_on_many_rows_are_not_mllibs():
    deep, shallow = Cell.of("RF", trees=10, depth=30, min_split=2), Cell.of("RF", trees=1000, depth=10, min_split=2)
    assert models.first_size(deep, models.DEEP_ROWS + 1) == 0 < models.first_size(deep, 1000)
    assert models.first_size(shallow, 10**7) == models.FIRST_TREES
    assert model_grid.best_cell().values()["trees"] == 1000
