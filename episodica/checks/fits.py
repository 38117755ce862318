"""Queries that fit and score models."""

from __future__ import annotations

from pyspark.sql import functions as F

from episodica.checks.features import CATEGORICAL, COUNTED, NUMERIC, split_features
from episodica.checks.registry import query, rounded
from episodica.checks.tables import STUDY, cohort
from episodica.operators import models, neighbours, stump
from episodica.operators.models import Cell
from episodica.plans import model_grid
from episodica.sources import driver_tables as D

SPEC = model_grid.FeatureSpec(CATEGORICAL, NUMERIC, COUNTED)
SPLIT = STUDY.splits[1]

def cells_of(family: str, **among) -> list[Cell]:
    """Cells of the whole grid in one family whose parameters are among the given ones."""
    return [c for c in models.grid_cells() if c.family == family and all(c.values()[k] in v for k, v in among.items())]


# Cells of the whole grid by family; the README has their measured times.
FAMILY_CELLS = {
    "model_rf": cells_of("RF", depth=[10]),
    "model_rf_deep": cells_of("RF", depth=[models.MAX_DEPTH], trees=[1, 10]),
    "model_lr": cells_of("LR"),
    "model_adaboost": cells_of("AB"),
    "model_tree": cells_of("DT"),
    "model_svm": cells_of("SVM"),
    "model_gbt": cells_of("GB"),
    "model_bagging": cells_of("BG"),
    "model_knn_scores": cells_of("KNN"),
}


def register_family(name: str, cells: list[Cell]) -> None:
    @query(name)
    def run(spark, sf_dir):
        _, scores = model_grid.score_grid(cohort(spark, sf_dir), D.component(spark, sf_dir), STUDY, SPEC, cells)
        return scores


for _name, _cells in FAMILY_CELLS.items():
    register_family(_name, _cells)


KNN_SQL = """
WITH pairs AS (
  SELECT a.vec_id AS query, b.label,
         row_number() OVER (PARTITION BY a.vec_id ORDER BY
           round(list_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6), b.vec_id) AS place
  FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id),
votes AS (SELECT query, label, count(*) / CAST(15 AS DOUBLE) AS share FROM pairs WHERE place <= 15 GROUP BY query, label)
SELECT query, label AS predicted, round(share, 6) AS share FROM votes
QUALIFY row_number() OVER (PARTITION BY query ORDER BY share DESC, label) = 1"""


@query("model_knn", KNN_SQL)
def model_knn(spark, sf_dir):
    vectors = D.load(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("key"), F.col("embedding").alias("vector"), "label"
    )
    near = neighbours.k_nearest(vectors, vectors, 15, exclude_self=True)
    return rounded(neighbours.predicted_label(neighbours.vote_shares(near)), "share")


KNN_DISTANCE_SQL = """
WITH pairs AS (
  SELECT a.vec_id AS query, b.label,
         list_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS distance,
         row_number() OVER (PARTITION BY a.vec_id ORDER BY
           round(list_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6), b.vec_id) AS place
  FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id),
near AS (SELECT *, min(distance) OVER (PARTITION BY query) = 0 AS exact FROM pairs WHERE place <= 25),
votes AS (SELECT query, label, sum(CASE WHEN exact THEN CAST(distance = 0 AS INTEGER) ELSE 1 / distance END) AS vote
          FROM near GROUP BY query, label),
shares AS (SELECT query, label, vote / sum(vote) OVER (PARTITION BY query) AS share FROM votes)
SELECT query, label AS predicted, round(share, 6) AS share FROM shares
QUALIFY row_number() OVER (PARTITION BY query ORDER BY round(share, 9) DESC, label) = 1"""


@query("model_knn_distance", KNN_DISTANCE_SQL)
def model_knn_distance(spark, sf_dir):
    vectors = D.load(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("key"), F.col("embedding").alias("vector"), "label"
    )
    near = neighbours.k_nearest(vectors, vectors, 25, exclude_self=True)
    return rounded(neighbours.predicted_label(neighbours.vote_shares(near, "distance")), "share")


def stump_sql() -> str:
    gini = "2 * (({p}) / CAST({n} AS DOUBLE)) * (1 - ({p}) / CAST({n} AS DOUBLE))"
    left = gini.format(p="left_pos", n="left_n")
    right = gini.format(p="right_pos", n="right_n")
    whole = gini.format(p="all_pos", n="all_n")
    return f"""
SELECT feature, threshold, round(gain, 6) AS gain, left_n, left_pos, right_n, right_pos FROM (
  SELECT feature, threshold, left_n, left_pos, right_n, right_pos,
         {whole} - (left_n * ({left}) + right_n * ({right})) / CAST(all_n AS DOUBLE) AS gain
  FROM (
    SELECT feature, (value + next_value) / 2 AS threshold, left_n, left_pos,
           all_n - left_n AS right_n, all_pos - left_pos AS right_pos, all_n, all_pos
    FROM (
      SELECT feature, value, all_n, all_pos, LEAD(value) OVER w AS next_value,
             CAST(sum(n) OVER w AS BIGINT) AS left_n, CAST(sum(pos) OVER w AS BIGINT) AS left_pos
      FROM (
        SELECT feature, value, n, pos, all_n, all_pos FROM nonzero, whole
        UNION ALL
        SELECT feature, CAST(0 AS DOUBLE), all_n - sum(n), all_pos - sum(pos), all_n, all_pos
        FROM nonzero, whole GROUP BY feature, all_n, all_pos HAVING all_n > sum(n)
      ) WINDOW w AS (PARTITION BY feature ORDER BY value)
    ) WHERE next_value IS NOT NULL))
ORDER BY round(-gain, 9), feature, threshold LIMIT 1"""


@query(
    "stump_split",
    "SELECT * FROM (WITH filled AS (SELECT feature, value, label FROM long_features WHERE side = 'train' AND split_id = 1), "
    "nonzero AS (SELECT feature, value, count(*) AS n, sum(label) AS pos FROM filled GROUP BY feature, value), "
    "whole AS (SELECT count(*) AS all_n, CAST(sum(label) AS BIGINT) AS all_pos FROM split_rows WHERE side = 'train' AND split_id = 1) "
    + stump_sql()
    + ")",
)
def stump_split(spark, sf_dir):
    rows, features = split_features(spark, sf_dir, [SPLIT])
    train = F.col("side") == "train"
    best = stump.best_split(stump.split_candidates(features.filter(train), rows.filter(train)))
    return rounded(best, "gain")


def scored_grid(spark, sf_dir, cells):
    path, _ = model_grid.score_grid(cohort(spark, sf_dir), D.component(spark, sf_dir), STUDY, SPEC, cells)
    return model_grid.read_grid(spark, path)


@query("model_grid")
def grid(spark, sf_dir):
    return scored_grid(spark, sf_dir, models.grid_cells())


@query(
    "grid_sizes",
    """SELECT split_id, m.model_type, count(*) FILTER (side = 'train') AS train_size,
         count(*) FILTER (side = 'test') AS test_size, round(avg(label) FILTER (side = 'test'), 6) AS base_rate
       FROM split_rows, (VALUES ('DT'), ('baseline')) AS m(model_type) GROUP BY split_id, m.model_type""",
)
def grid_sizes(spark, sf_dir):
    found = scored_grid(spark, sf_dir, [Cell.of("DT", depth=1, min_split=2)])
    return rounded(found.select("split_id", "model_type", "train_size", "test_size", "base_rate"), "base_rate")


def report(spark, sf_dir):
    """The chosen model with all its trees."""
    return model_grid.best_model(cohort(spark, sf_dir), D.component(spark, sf_dir), SPLIT, SPEC)


@query("best_model")
def best_model(spark, sf_dir):
    return report(spark, sf_dir).scores


@query("feature_importance")
def feature_importance(spark, sf_dir):
    return report(spark, sf_dir).importances
