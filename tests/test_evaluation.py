"""Cut-offs, metrics and fairness on small score sets, against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from episodica.config import CUTOFFS
from episodica.operators import evaluation, fairness, ranking

SCORES = "key int, label int, score double, race string, gender string"


def frame(spark, pairs):
    return spark.createDataFrame(
        [(i, y, float(s), "A" if i % 3 else "B", "F" if i % 2 else "M") for i, (y, s) in enumerate(pairs)], SCORES
    )


def cutoff(scores, k):
    ordered = np.sort(scores)
    return ordered[int(np.rint((len(ordered) - 1) * (1 - k / 100)))]


@pytest.fixture(scope="module")
def tied():
    rng = random.Random(3)
    # A third of all rows share one score.
    return [(int(rng.random() < 0.3), 0.5 if rng.random() < 0.33 else round(rng.random(), 2)) for _ in range(700)]


def test_metrics_match_brute_force(spark, tied):
    table = ranking.score_table(frame(spark, tied), [])
    got = {r["k"]: r for r in evaluation.metrics_at(table, [], CUTOFFS).collect()}
    y, s = np.array([p[0] for p in tied]), np.array([p[1] for p in tied])
    for k in CUTOFFS:
        cut = cutoff(s, k)
        pred = s >= cut
        tp = (pred & (y == 1)).sum()
        precision, recall = tp / pred.sum(), tp / y.sum()
        assert got[k]["cutoff"] == cut
        assert got[k]["precision"] == pytest.approx(precision)
        assert got[k]["recall"] == pytest.approx(recall)
        assert got[k]["accuracy"] == pytest.approx((tp + (~pred & (y == 0)).sum()) / len(y))
        assert got[k]["actual_percent"] == pytest.approx(pred.mean())
        if tp:
            assert got[k]["f1"] == pytest.approx(2 * precision * recall / (precision + recall))


def test_auc_and_curve_match_brute_force(spark, tied):
    table = ranking.score_table(frame(spark, tied), [])
    pos = np.array([s for y, s in tied if y])
    neg = np.array([s for y, s in tied if not y])
    wins = (pos[:, None] > neg).sum() + (pos[:, None] == neg).sum() / 2
    assert evaluation.auc_roc(table, []).first()["auc_roc"] == pytest.approx(wins / (len(pos) * len(neg)))
    y, s = np.array([p[0] for p in tied]), np.array([p[1] for p in tied])
    for r in evaluation.pr_curve(table, []).collect():
        pred = s >= r["threshold"]
        assert r["population"] == pytest.approx(pred.mean())
        assert r["precision"] == pytest.approx(y[pred].mean())


def test_half_even_rank(spark):
    flagged = ranking.flag_top_share(frame(spark, [(0, 0.1), (1, 0.9)]), [], 50.0)
    assert [r["predicted"] for r in flagged.orderBy("key").collect()] == [1, 1]
    by_position = ranking.flag_top_positions(frame(spark, [(0, 0.1), (1, 0.9)]), [], 50.0)
    assert [r["predicted"] for r in by_position.orderBy("key").collect()] == [0, 1]


def test_no_positives_gives_nulls(spark):
    table = ranking.score_table(frame(spark, [(0, 0.1), (0, 0.2)]), [])
    row = evaluation.metrics_at(table, [], (50.0,)).first()
    assert row["recall"] is None and row["f1"] is None and row["precision"] == 0
    assert evaluation.auc_roc(table, []).first()["auc_roc"] is None


def test_crosstab_adds_up(spark, tied):
    flagged = ranking.flag_top_share(frame(spark, tied), [], 5.0)
    xtab = fairness.crosstab(flagged, ["race", "gender"])
    for r in xtab.groupBy("attribute").agg(F.sum(F.expr("tp + fp + tn + fn")).alias("n")).collect():
        assert r["n"] == len(tied)
    metrics = fairness.group_metrics(xtab)
    for r in fairness.disparities(metrics, {"race": "A", "gender": "M"}).collect():
        if r["value"] in ("A", "M"):
            assert r["prev_disparity"] == pytest.approx(1.0)


def test_missing_reference_and_empty_denominators(spark):
    rows = [(1, 0, 0.0, None, "M"), (2, 0, 0.0, "A", "M")]
    df = spark.createDataFrame(rows, SCORES).withColumn("predicted", F.lit(0))
    metrics = fairness.group_metrics(fairness.crosstab(df, ["race"]))
    assert {r["value"] for r in metrics.collect()} == {"A", "UNKNOWN"}
    parity = fairness.parity(fairness.disparities(metrics, {"race": "absent"})).collect()
    assert all(r["tpr"] is None and r["ref_value"] is None and r["tpr_parity"] is None for r in parity)
    assert fairness.disparities(metrics).first()["ref_value"] == "A"


def test_significance(spark):
    pairs = [(1, 0.9)] * 30 + [(0, 0.1)] * 30
    df = frame(spark, pairs).withColumn("predicted", (F.col("score") > 0.5).cast("int"))
    df = df.withColumn("race", F.when(F.col("predicted") == 1, "A").otherwise("B"))
    tested = fairness.significance(fairness.group_metrics(fairness.crosstab(df, ["race"])), {"race": "B"})
    row = tested.filter("value = 'A' AND metric = 'prev'").first()
    assert row["z"] == pytest.approx(1 / np.sqrt(0.25 * 2 / 30)) and row["significant"]
