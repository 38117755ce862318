"""Profile of a cohort: the tables behind an exploratory report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from episodica.operators import profile
from episodica.session import cut_lineage
from episodica.sources.tables import write_table

# The variables and groupings of the report.
VARIABLES = (
    "total_components", "felony_components", "label", "height", "weight",
    "age_at_episode", "years_in_stay", "age_at_first", "prior_episodes",
)
GROUPINGS = (("race",), ("gender",), ("race", "ethnic"), ("citizenship",))


def return_rate_by(cohort: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Episodes, returns, return rate and share of all episodes per group."""
    counts = cut_lineage(
        cohort.groupBy(*groups).agg(
            F.count("*").alias("episodes"), F.sum("label").alias("returns"), F.avg("label").alias("return_rate")
        )
    )
    total = counts.agg(F.sum("episodes")).scalar()
    return counts.withColumn("share", F.col("episodes") / total)


def explore(
    cohort: DataFrame,
    variables: Sequence[str] = VARIABLES,
    groupings: Sequence[Sequence[str]] = GROUPINGS,
) -> dict[str, DataFrame]:
    """All report tables by name; the cohort is materialised once for them."""
    rows = cut_lineage(cohort)
    names = list(variables)
    tables = {
        "nulls": profile.null_summary(rows),
        "description": profile.describe(rows, names),
        "histograms": profile.histogram(rows, names),
        "correlations": profile.correlation_wide(rows, names),
        "boxes": profile.box_stats(rows, names),
    }
    for grouping in groupings:
        tables["share_" + "_".join(grouping)] = profile.share(rows, list(grouping)).orderBy(F.desc("percent"))
    return tables


def write_report(tables: dict[str, DataFrame], folder: str) -> None:
    """Write each report table as CSV with header."""
    for name, table in tables.items():
        write_table(table, f"{folder}/{name}", "csv")
