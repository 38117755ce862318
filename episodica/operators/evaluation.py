"""Metrics of score sets, all derived from one table of distinct scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from episodica.functions.columns import ratio
from episodica.operators.ranking import cutoffs, with_group

# Column prefixes of the wide result grid, per cut-off.
GRID_METRICS = {
    "p_at": "precision",
    "a_at": "accuracy",
    "r_at": "recall",
    "f1_at": "f1",
    "perc_pop_at": "actual_percent",
}


def metrics_at(table: DataFrame, by: list[str], ks: tuple[float, ...]) -> DataFrame:
    """Precision, accuracy, recall, F1 and selected share per group and cut-off.

    A ratio without denominator is null.
    """
    at = cutoffs(table, by, ks)
    tp, selected, n, pos = (F.col(c) for c in ("true_pos", "selected", "total_n", "total_pos"))
    true_neg = n - selected - (pos - tp)
    precision, recall = ratio(tp, selected), ratio(tp, pos)
    return at.select(
        *by,
        "k",
        "cutoff",
        precision.alias("precision"),
        ratio(tp + true_neg, n).alias("accuracy"),
        recall.alias("recall"),
        ratio(2 * precision * recall, precision + recall).alias("f1"),
        ratio(selected, n).alias("actual_percent"),
    )


def auc_roc(table: DataFrame, by: list[str]) -> DataFrame:
    """Exact area under the ROC curve; tied pairs count one half."""
    negatives = F.col("total_n") - F.col("total_pos")
    tied = F.col("n") - F.col("pos")
    below = negatives - (F.col("above_n") - F.col("above_pos")) - tied
    won = F.sum(F.col("pos").cast("double") * (below + tied / F.lit(2.0)))
    keyed, keys = with_group(table, by)
    grouped = keyed.groupBy(*keys, "total_n", "total_pos").agg(won.alias("_won"))
    pairs = F.col("total_pos").cast("double") * negatives
    return grouped.select(*by, "total_n", "total_pos", ratio(F.col("_won"), pairs).alias("auc_roc"))


def pr_curve(table: DataFrame, by: list[str]) -> DataFrame:
    """Precision, recall and share of the population at or above each distinct score."""
    selected, hits = F.col("above_n") + F.col("n"), F.col("above_pos") + F.col("pos")
    return table.select(
        *by,
        F.col("score").alias("threshold"),
        ratio(hits, selected).alias("precision"),
        ratio(hits, F.col("total_pos")).alias("recall"),
        ratio(selected, F.col("total_n")).alias("population"),
    )


def base_rate(df: DataFrame, by: list[str], label: str = "label") -> DataFrame:
    """Share of positives per group."""
    return df.groupBy(*by).agg(F.count("*").alias("n"), F.avg(label).alias("base_rate"))


def results_grid(metrics: DataFrame, by: list[str], ks: tuple[float, ...]) -> DataFrame:
    """One row per group; five columns per cut-off."""
    columns = []
    for k in ks:
        suffix = f"{k:g}"
        columns += [
            F.max(F.when(F.col("k") == float(k), F.col(metric))).alias(f"{prefix}_{suffix}")
            for prefix, metric in GRID_METRICS.items()
        ]
    return metrics.groupBy(*by).agg(*columns)
