"""Group fairness of predictions: cross-tab, metrics, disparities, parity."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from episodica.functions.columns import ratio
from episodica.operators.profile import attribute_rows
from episodica.session import cut_lineage

KEYS = ["attribute", "value"]

# Numerator and denominator of each group metric.
METRICS = {
    "tpr": ("tp", "label_pos"),
    "tnr": ("tn", "label_neg"),
    "for": ("fn", "pn"),
    "fdr": ("fp", "pp"),
    "fpr": ("fp", "label_neg"),
    "fnr": ("fn", "label_pos"),
    "npv": ("tn", "pn"),
    "precision": ("tp", "pp"),
    "ppr": ("pp", "total_pp"),
    "pprev": ("pp", "group_size"),
    "prev": ("label_pos", "group_size"),
}

# Parities that hold when both of their metrics are in parity.
COMPOSITES = {
    "type1_parity": ("fdr", "fpr"),
    "type2_parity": ("for", "fnr"),
    "equalized_odds": ("fpr", "tpr"),
    "unsupervised": ("ppr", "pprev"),
}


def crosstab(df: DataFrame, attributes: list[str], predicted: str = "predicted", label: str = "label") -> DataFrame:
    """Confusion counts per attribute value, for all attributes in one pass.

    The counts are materialised: every later table of the audit starts from them.
    """
    rows = attribute_rows(df, attributes, predicted, label)
    p, y = F.col(predicted) == 1, F.col(label) == 1
    counts = rows.groupBy(*KEYS).agg(
        F.count_if(p & y).alias("tp"),
        F.count_if(p & ~y).alias("fp"),
        F.count_if(~p & ~y).alias("tn"),
        F.count_if(~p & y).alias("fn"),
        F.count_if(p).alias("pp"),
        F.count_if(~p).alias("pn"),
        F.count_if(y).alias("label_pos"),
        F.count_if(~y).alias("label_neg"),
        F.count("*").alias("group_size"),
    )
    counts = cut_lineage(counts)
    totals = counts.groupBy("attribute").agg(
        F.sum("pp").alias("total_pp"), F.sum("group_size").alias("total_entities")
    )
    return counts.join(F.broadcast(totals), "attribute")  # one row per attribute


def group_metrics(xtab: DataFrame) -> DataFrame:
    """Add the group metrics to a cross-tab."""
    return xtab.withColumns({m: ratio(F.col(num), F.col(den)) for m, (num, den) in METRICS.items()})


def _reference_rows(metrics: DataFrame, columns: list[str], references: Mapping[str, str]) -> DataFrame:
    chosen = F.lit(False)
    for attribute, value in references.items():
        chosen = chosen | ((F.col("attribute") == attribute) & (F.col("value") == value))
    return metrics.filter(chosen).select(
        "attribute", F.col("value").alias("ref_value"), *[F.col(c).alias(f"ref_{c}") for c in columns]
    )


def _largest_rows(metrics: DataFrame, columns: list[str]) -> DataFrame:
    row = F.struct((-F.col("group_size")).alias("size"), "value", *columns)
    largest = metrics.groupBy("attribute").agg(F.min(row).alias("_row"))
    return largest.select(
        "attribute",
        F.col("_row.value").alias("ref_value"),
        *[F.col(f"_row.{c}").alias(f"ref_{c}") for c in columns],
    )


def with_reference(
    metrics: DataFrame, references: Mapping[str, str] | None, columns: list[str]
) -> DataFrame:
    """Attach each attribute's reference group: the chosen one, or the largest.

    Without its reference row an attribute keeps null references.
    """
    rows = _reference_rows(metrics, columns, references) if references else _largest_rows(metrics, columns)
    return metrics.join(F.broadcast(rows), "attribute", "left")  # one row per attribute


def disparities(metrics: DataFrame, references: Mapping[str, str] | None = None) -> DataFrame:
    """Ratio of every metric to that of the reference group (largest when none is chosen)."""
    names = list(METRICS)
    joined = with_reference(metrics, references, names)
    return joined.withColumns(
        {f"{m}_disparity": ratio(F.col(m), F.col(f"ref_{m}")) for m in names}
    ).drop(*[f"ref_{m}" for m in names])


# Polynomial of the complementary error function's exponent, relative error below 1.2e-7.
ERFC = (
    -1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806,
    0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277,
)


def two_sided_p(z: str) -> Column:
    """Two-sided p-value of a standard normal statistic: erfc(|z| / sqrt(2)), null for null."""
    x = F.abs(F.col(z)) / math.sqrt(2.0)
    t = 1 / (1 + x / 2)
    exponent = F.lit(0.0)
    for c in reversed(ERFC):
        exponent = exponent * t + c
    return t * F.exp(exponent - x * x)


def significance(
    metrics: DataFrame, references: Mapping[str, str] | None = None, alpha: float = 0.05
) -> DataFrame:
    """Two-proportion test of each group metric against the reference group.

    Long form: attribute, value, metric, z, p_value, significant.
    """
    counts = sorted({c for pair in METRICS.values() for c in pair})
    joined = with_reference(metrics, references, counts)

    def z(num: str, den: str) -> Column:
        x1, n1, x2, n2 = (F.col(c).cast("double") for c in (num, den, f"ref_{num}", f"ref_{den}"))
        pooled = ratio(x1 + x2, n1 + n2)
        spread = F.sqrt(pooled * (1 - pooled) * (ratio(F.lit(1), n1) + ratio(F.lit(1), n2)))
        return ratio(ratio(x1, n1) - ratio(x2, n2), spread)

    items = [
        F.struct(F.lit(m).alias("metric"), z(num, den).alias("z")) for m, (num, den) in METRICS.items()
    ]
    return (
        joined.select(*KEYS, "ref_value", F.inline(F.array(*items)))
        .withColumn("p_value", two_sided_p("z"))
        .withColumn("significant", F.col("p_value") < alpha)
    )


def parity(disparity: DataFrame, tau: float = 0.8) -> DataFrame:
    """Whether each disparity lies within [tau, 1/tau], and the combined parities."""
    single = {
        f"{m}_parity": F.col(f"{m}_disparity").between(F.lit(tau), F.lit(1 / tau)) for m in METRICS
    }
    both = {
        name: F.col(f"{a}_parity") & F.col(f"{b}_parity") for name, (a, b) in COMPOSITES.items()
    }
    return (
        disparity.withColumns(single)
        .withColumns(both)
        .withColumn("supervised", F.col("type1_parity") & F.col("type2_parity"))
    )


def long_form(parities: DataFrame) -> DataFrame:
    """One row per attribute value and metric: value, disparity, parity, group size."""
    items = [
        F.struct(
            F.lit(m).alias("metric"),
            F.col(m).alias("metric_value"),
            F.col(f"{m}_disparity").alias("disparity"),
            F.col(f"{m}_parity").alias("parity"),
        )
        for m in METRICS
    ]
    return parities.select(*KEYS, "group_size", F.inline(F.array(*items)))
