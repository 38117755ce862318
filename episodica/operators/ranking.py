"""Exact ranks and top-k cut-offs of scores, also for many score sets at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from episodica.operators.ordering import add_position, slice_rows, sweep

ALL = "_all"


def rank_by_score(df: DataFrame, by: list[str], score: str = "score", key: str = "key") -> DataFrame:
    """Add the 0-based position in descending score order; ties follow the key."""
    keyed, keys = with_group(df, by)
    return add_position(keyed, keys, [F.col(score).desc(), F.col(key).asc()], "position").drop(ALL)


def with_group(df: DataFrame, by: list[str]) -> tuple[DataFrame, list[str]]:
    """Use one constant group where no grouping columns are given."""
    return (df, list(by)) if by else (df.withColumn(ALL, F.lit(0)), [ALL])


def score_table(df: DataFrame, by: list[str], score: str = "score", label: str = "label") -> DataFrame:
    """One row per distinct score with the rows and positives at and above it.

    Tied scores are counted before anything is ordered, so a frequent score
    costs one row. Columns: n, pos (at the score), above_n, above_pos (strictly
    above), total_n, total_pos (of the group).
    """
    return rank_counts(score_counts(df, by, score, label), by)


def score_counts(df: DataFrame, by: list[str], score: str = "score", label: str = "label") -> DataFrame:
    """Rows (n) and positives (pos) of each distinct score; tables of other rows can be appended."""
    return df.groupBy(*by, F.col(score).alias("score")).agg(
        F.count("*").alias("n"), F.sum(F.col(label).cast("long")).alias("pos")
    )


def rank_counts(counts: DataFrame, by: list[str]) -> DataFrame:
    """The score table of ``score_counts`` rows, one for each group and score."""
    counts, keys = with_group(counts, by)
    order = [F.col("score").desc()]
    sliced = slice_rows(counts, keys, order)
    totals = sliced.groupBy(*keys).agg(F.sum("n").alias("total_n"), F.sum("pos").alias("total_pos"))
    ranked = sweep(sliced, keys, order, {"above_n": F.col("n"), "above_pos": F.col("pos")})
    table = ranked.join(totals, keys)
    return table.select(
        *by, "score", "n", "pos", "above_n", "above_pos", "total_n", "total_pos"
    )


def is_cutoff(k: float) -> Column:
    """Condition on score_table rows: this score is the nearest-rank quantile 1 - k/100."""
    from_bottom = F.rint((F.col("total_n") - 1) * F.lit(1 - k / 100))
    from_top = F.col("total_n") - 1 - from_bottom
    return (F.col("above_n") <= from_top) & (from_top < F.col("above_n") + F.col("n"))


def cutoffs(table: DataFrame, by: list[str], ks: tuple[float, ...]) -> DataFrame:
    """Per group and k: the cut-off score and the rows and positives at or above it."""
    aggregates, items = [], []
    for i, k in enumerate(ks):
        chosen = F.struct(
            F.col("score").alias("cutoff"),
            (F.col("above_n") + F.col("n")).alias("selected"),
            (F.col("above_pos") + F.col("pos")).alias("true_pos"),
        )
        aggregates.append(F.max(F.when(is_cutoff(k), chosen)).alias(f"k{i}"))
        items.append(F.struct(F.lit(float(k)).alias("k"), F.col(f"k{i}").alias("at")))
    keyed, keys = with_group(table, by)
    wide = keyed.groupBy(*keys, "total_n", "total_pos").agg(*aggregates)
    return wide.select(*by, "total_n", "total_pos", F.inline(F.array(*items))).select(
        *by, "k", "total_n", "total_pos", "at.*"
    )


def flag_top_share(df: DataFrame, by: list[str], k: float, score: str = "score", label: str = "label") -> DataFrame:
    """Add ``predicted``: 1 where the score reaches the top-k% cut-off, ties included."""
    found = cutoffs(score_table(df, by, score, label), by, (k,)).select(*by, "cutoff")
    if by:
        marked = df.join(found, by)
        reached = F.col(score) >= F.col("cutoff")
    else:
        row = found.first()  # None without scores
        marked, reached = df, F.col(score) >= F.lit(row["cutoff"] if row else None).cast("double")
    return marked.withColumn("predicted", F.when(reached, 1).otherwise(0)).drop("cutoff")


def flag_top_positions(df: DataFrame, by: list[str], k: float) -> DataFrame:
    """Add ``predicted``: 1 for the first n*k/100 rows in score order, ties cut by key."""
    ranked = rank_by_score(df, by)
    if by:
        ranked = ranked.join(df.groupBy(*by).agg(F.count("*").alias("_n")), by)
        size = F.col("_n")
    else:
        size = F.lit(df.count())
    first = F.col("position") < F.floor(size * F.lit(k / 100.0))
    return ranked.withColumn("predicted", F.when(first, 1).otherwise(0)).drop("_n")


def repeated_scores(df: DataFrame, score: str = "score", key: str = "key") -> DataFrame:
    """Rows whose score already occurred on a smaller key."""
    firsts = df.groupBy(score).agg(F.min(key).alias("_first"))
    return df.join(firsts, [score]).filter(F.col(key) > F.col("_first")).drop("_first")


def ranked_list(df: DataFrame, by: list[str] = (), score: str = "score", key: str = "key") -> DataFrame:
    """Rank (from 1), probability and id in descending score order."""
    return rank_by_score(df, list(by), score, key).select(
        *by,
        (F.col("position") + 1).alias("rank"),
        F.col(score).alias("probability"),
        F.col(key).alias("id"),
    )
