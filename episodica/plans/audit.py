"""Fairness audit of the scores of one model."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from episodica.operators import fairness, profile, ranking
from episodica.operators.encoding import EPISODE
from episodica.session import cut_lineage


def audit_scores(
    scores: DataFrame,
    cohort: DataFrame,
    attributes: Sequence[str],
    references: Mapping[str, str],
    top_percent: float = 5.0,
    tau: float = 0.8,
    alpha: float = 0.05,
) -> dict[str, DataFrame]:
    """All audit tables by name, for the rows flagged at the top-k% cut-off.

    Scores meet the cohort's group attributes by episode key. The rows are
    passed over once; every later table is computed from the group counts.
    """
    names = list(attributes)
    groups = cohort.select(*EPISODE, *names)
    keyed = cut_lineage(scores.select(*EPISODE, "label", "score").join(groups, EPISODE))
    flagged = ranking.flag_top_share(keyed, [], top_percent)
    metrics = fairness.group_metrics(fairness.crosstab(flagged, names))
    chosen = fairness.disparities(metrics, references)
    parity = fairness.parity(chosen, tau)
    by_value = [profile.attribute_rows(keyed, [a]) for a in names]
    shares = [profile.share(rows, ["attribute", "value"]) for rows in by_value]
    return {
        "scores_by_group": profile.describe_groups(keyed, ["score"], names),
        "group_shares": reduce(DataFrame.unionByName, shares),
        "profile": profile.crosstab_counts(flagged, names, ["predicted", "label"]),
        "metrics": metrics,
        "disparity_to_reference": chosen,
        "disparity_to_largest": fairness.disparities(metrics),
        "significance": fairness.significance(metrics, references, alpha),
        "parity": parity,
        "long": fairness.long_form(parity),
    }
