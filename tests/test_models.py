"""Model families on a planted signal, and exact neighbours, stumps and grids."""

import random
from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql import types as T

from episodica.checks import fits, tables
from episodica.operators import evaluation, models, neighbours, ranking, stump
from episodica.operators.models import Cell
from episodica.plans import model_grid
from episodica.plans.audit import audit_scores
from episodica.sources import driver_tables as D

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def planted(spark):
    rng = random.Random(1)
    rows = []
    for i in range(600):
        x = [rng.random() for _ in range(3)]
        y = float(x[0] + 0.2 * rng.random() > 0.6)
        rows.append((i, i, y, Vectors.dense(x)))
    schema = T.StructType(
        [T.StructField("person_id", T.LongType()), T.StructField("episode_id", T.LongType()),
         T.StructField("label", T.DoubleType()), T.StructField("features", VectorUDT())]
    )
    df = spark.createDataFrame(rows, schema).cache()
    return df.filter("person_id < 400"), df.filter("person_id >= 400")


CELLS = [
    Cell.of("RF", trees=10, depth=30, min_split=2),
    Cell.of("LR", penalty="l1", C=1),
    Cell.of("AB", rounds=3),
    Cell.of("DT", depth=10, min_split=10),
    Cell.of("SVM", C=0.01),
    Cell.of("KNN", k=15, weights="distance"),
    Cell.of("GB", trees=5, rate=0.1, subsample=0.5, depth=5),
    Cell.of("BG", trees=5, sample=0.5),
]


@pytest.mark.parametrize("cell", CELLS, ids=[c.family for c in CELLS])
def test_family_finds_the_signal(cell, planted):
    train, test = planted
    scores = models.fit_and_score(cell, train, test)
    rows = scores.collect()
    assert len(rows) == 200
    if cell.family != "SVM":
        assert all(0 <= r["score"] <= 1 for r in rows)
    auc = evaluation.auc_roc(ranking.score_table(scores, []), []).first()["auc_roc"]
    assert auc > 0.8


def test_grid_cells_are_fits_of_their_own():
    cells = models.grid_cells()
    # Ten choices of RF and three of DT ask for deeper trees than there are, as others do.
    assert len(cells) == 77 and sum(len(c.requested.split(" | ")) for c in cells) == 90
    assert len({(c.family, c.params) for c in cells}) == len(cells)
    fits = [
        (c.family, str(sorted((p.name, v) for p, v in e.extractParamMap().items() if not p.name.endswith("Col"))))
        for c in cells
        if (e := models.estimator(c)) is not None
    ]
    assert len(set(fits)) == len(fits)
    with pytest.raises(ValueError):
        models.estimator(Cell.of("DT", depth=31, min_split=2))


def test_boosting_without_a_split_gives_the_prior(planted):
    train, test = planted
    pure = train.withColumn("label", F.lit(1.0))
    assert {r["score"] for r in models.fit_and_score(Cell.of("AB", rounds=3), pure, test).collect()} == {1.0}


@pytest.fixture()
def small_blocks(monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 40)
    monkeypatch.setattr(neighbours, "CHUNK_ROWS", 30)


@pytest.mark.parametrize("exclude", [True, False])
def test_neighbours_match_brute_force(spark, small_blocks, exclude):
    rng = np.random.default_rng(2)
    # Half of the points crowd one place, so one cell is cut into many blocks.
    points = np.vstack([rng.normal(0, 0.01, (150, 4)), rng.normal(0, 3, (150, 4))])
    df = spark.createDataFrame([(i, p.tolist(), i % 3) for i, p in enumerate(points)], "key int, vector array<double>, label int")
    got = {}
    for r in neighbours.k_nearest(df, df, 7, exclude_self=exclude, pivots=6).collect():
        got.setdefault(r["query"], []).append((r["place"], r["key"]))
    d = np.round(np.sqrt(((points[:, None] - points) ** 2).sum(axis=2)), 6)
    if exclude:
        np.fill_diagonal(d, np.inf)
    for q in range(len(points)):
        expected = sorted(range(len(points)), key=lambda i: (d[q, i], i))[:7]
        assert [k for _, k in sorted(got[q])] == expected


def test_projection_finds_most_neighbours(spark):
    rng = np.random.default_rng(3)
    points = rng.normal(0, 1, (200, 4))
    df = spark.createDataFrame([(i, p.tolist(), i % 3) for i, p in enumerate(points)], "key int, vector array<double>, label int")
    asks = df.select(F.col("key").alias("query"), "vector")
    exact = {(r["query"], r["key"]) for r in neighbours.k_nearest(df, df, 3).collect()}
    found = {(r["query"], r["key"]) for r in neighbours.near_by_projection(df, asks, 3, 4.0, 2.0).collect()}
    assert len(found & exact) > 0.9 * len(exact)


def test_zero_distance_outvotes(spark):
    rows = [(1, 10, 0, 0.0, 1), (1, 11, 1, 0.1, 2), (1, 12, 1, 0.2, 3)]
    near = spark.createDataFrame(rows, "query int, key int, label int, distance double, place int")
    by = {w: neighbours.predicted_label(neighbours.vote_shares(near, w)).first()["predicted"] for w in ("uniform", "distance")}
    assert by == {"uniform": 1, "distance": 0}


def test_stump_matches_brute_force(spark):
    rng = random.Random(4)
    data = [([rng.randrange(4), rng.randrange(3)], 0) for _ in range(200)]
    data = [(x, int(x[1] > 1) if rng.random() < 0.9 else 1) for x, _ in data]
    labels = spark.createDataFrame([(y,) for _, y in data], "label int")
    features = spark.createDataFrame(
        [(f"f{j}", float(v), y) for x, y in data for j, v in enumerate(x) if v], "feature string, value double, label int"
    )
    best = stump.best_split(stump.split_candidates(features, labels)).first()

    def gini(ys):
        p = sum(ys) / len(ys)
        return 2 * p * (1 - p)

    options = []
    for j in range(2):
        values = sorted({x[j] for x, _ in data})
        for lo, hi in zip(values, values[1:]):
            t = (lo + hi) / 2
            left = [y for x, y in data if x[j] <= t]
            right = [y for x, y in data if x[j] > t]
            after = (len(left) * gini(left) + len(right) * gini(right)) / len(data)
            options.append((gini([y for _, y in data]) - after, f"f{j}", t, len(left), len(right)))
    gain, feature, threshold, left_n, right_n = max(options)
    assert (best["feature"], best["threshold"], best["left_n"], best["right_n"]) == (feature, threshold, left_n, right_n)
    assert best["gain"] == pytest.approx(gain)


def test_grid_resumes_and_audit_runs(spark, tmp_path, monkeypatch):
    cohort = tables.kept_cohort(spark, SF_DIR)
    study = replace(tables.STUDY, splits=tables.STUDY.splits[1:2])
    cells = [Cell.of("DT", depth=1, min_split=2), Cell.of("DT", depth=5, min_split=2)]
    source = D.component(spark, SF_DIR)
    path = str(tmp_path / "scores")
    _, scores = model_grid.score_grid(cohort, source, study, fits.SPEC, cells, path)
    grid = model_grid.evaluate_grid(scores, cohort, study).collect()
    assert sorted(r["model_type"] for r in grid) == ["DT", "DT", "baseline"]
    assert all(r["test_size"] > 0 and r["base_rate"] is not None for r in grid)

    def fail(*_):
        raise AssertionError("a finished cell was fitted again")

    assert spark.read.parquet(f"{path}-grid").count() == 3
    monkeypatch.setattr(models, "fit_and_score_all", fail)
    _, again = model_grid.score_grid(cohort, source, study, fits.SPEC, cells, path)
    # Other rows or another seed are not taken for the same scores.
    with pytest.raises(AssertionError):
        model_grid.score_grid(cohort, source, study, fits.SPEC, cells, path, seed=1)
    with pytest.raises(AssertionError):
        model_grid.score_grid(cohort.filter("episode_id % 9 > 0"), source, study, fits.SPEC, cells, path)
    assert again.count() == scores.count()
    chosen = again.filter(F.col("parameter") == cells[1].params)
    report = audit_scores(chosen, cohort, ["race", "gender"], {"race": "BUILDING", "gender": "MALE"})
    assert report["parity"].count() == report["metrics"].count() > 0


def test_scores_follow_the_ledger(spark, tmp_path, monkeypatch):
    """Runs A, B, A on one path: each returns its own scores, and the second A fits nothing."""
    cohort, source = tables.kept_cohort(spark, SF_DIR), D.component(spark, SF_DIR)
    study = replace(tables.STUDY, splits=tables.STUDY.splits[1:2])
    cells = [Cell.of("DT", depth=1, min_split=2), Cell.of("DT", depth=5, min_split=2)]
    fitted = []

    def stub(nest, train, test, seed):
        fitted.append((nest[0].params, seed))
        yield nest[0], test.select("person_id", "episode_id", "label", F.lit(float(seed) + len(nest[0].params) / 1000).alias("score"))

    monkeypatch.setattr(models, "fit_and_score_all", stub)
    path = str(tmp_path / "scores")

    def run(wanted, seed):
        _, scores = model_grid.score_grid(cohort, source, study, fits.SPEC, wanted, path, seed)
        found = {(r.parameter, int(r.score)) for r in scores.select("parameter", "score").distinct().collect()}
        shown = {r.parameter for r in model_grid.read_grid(spark, path).collect() if r.parameter is not None}
        return found, shown, scores.count()

    both = {(c.params, 0) for c in cells}
    first = run(cells, 0)
    assert first[:2] == (both, {c.params for c in cells})
    # A shrunken grid of another seed neither reads the dropped cell nor the other seed's scores.
    assert run(cells[:1], 1)[:2] == ({(cells[0].params, 1)}, {cells[0].params})
    assert len(fitted) == 3
    assert run(cells, 0) == first and len(fitted) == 3
    # The other splits add their own jobs only.
    wider = replace(study, splits=tables.STUDY.splits[1:3])
    model_grid.score_grid(cohort, source, wider, fits.SPEC, cells[:1], path, 0)
    assert len(fitted) == 5
