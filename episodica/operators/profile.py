"""Table profiles: describe, correlation, histograms, box statistics, shares, outliers."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from episodica.functions.columns import any_of, ratio
from episodica.operators.ordering import approximate_quantiles, exact_quantiles, join_groups
from episodica.session import cut_lineage

QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
WHISKER = 1.5


def long_values(df: DataFrame, variables: list[str], by: list[str] = ()) -> DataFrame:
    """One row per non-null value: (by..., variable, value)."""
    items = [F.struct(F.lit(v).alias("variable"), F.col(v).cast("double").alias("value")) for v in variables]
    return df.select(*by, F.inline(F.array(*items))).filter(F.col("value").isNotNull())


def null_summary(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Number of missing values per column."""
    names = list(columns or df.columns)
    counts = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in names])
    items = [F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("nulls")) for c in names]
    return counts.select(F.inline(F.array(*items)))


def describe(df: DataFrame, variables: list[str], by: list[str] = (), approx: bool = False) -> DataFrame:
    """Count, mean, deviation, range and quartiles per variable, also per group.

    Quartiles are exact, or with ``approx`` observed values within 1/10,000 of the rank.
    """
    long = long_values(df, variables, by)
    keys = [*by, "variable"]
    moments = long.groupBy(*keys).agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    quantiles = approximate_quantiles if approx else exact_quantiles
    return join_groups(moments, quantiles(long, keys, "value", QUARTILES), keys)


def describe_groups(df: DataFrame, variables: list[str], attributes: list[str]) -> DataFrame:
    """``describe`` for every value of several attributes: (attribute, group_value, variable, ...).

    Rows without a value are the group UNKNOWN.
    """
    rows = attribute_rows(df, attributes, *variables).withColumnRenamed("value", "group_value")
    return describe(rows, variables, ["attribute", "group_value"])


def correlation_long(df: DataFrame, variables: list[str]) -> DataFrame:
    """Pearson correlation of every ordered pair, over rows where both are known.

    Each row contributes once per unordered pair to partial sums before the
    shuffle. A constant column gives null.
    """
    pairs = [*combinations(variables, 2), *((v, v) for v in variables)]

    def known(a: str, b: str) -> Column:
        return F.when(F.col(b).isNotNull(), F.col(a).cast("double"))

    items = [
        F.struct(
            F.lit(i).alias("pair"), known(a, b).alias("a"), known(b, a).alias("b")
        )
        for i, (a, b) in enumerate(pairs)
    ]
    moments = df.select(F.inline(F.array(*items))).groupBy("pair").agg(
        F.covar_samp("a", "b").alias("c"), F.stddev_samp("a").alias("sa"), F.stddev_samp("b").alias("sb")
    )
    names = F.array(*[F.array(F.lit(a), F.lit(b)) for a, b in pairs])
    x, y = names[F.col("pair")][0], names[F.col("pair")][1]
    r = ratio(F.col("c"), F.col("sa") * F.col("sb"))
    both = F.array_distinct(
        F.array(F.struct(x.alias("x"), y.alias("y")), F.struct(y.alias("x"), x.alias("y")))
    )
    return moments.select(F.inline(both), r.alias("r"))


def correlation_wide(df: DataFrame, variables: list[str]) -> DataFrame:
    """Correlation matrix: one row per variable, one column per variable."""
    return correlation_long(df, variables).groupBy("x").pivot("y", variables).agg(F.first("r"))


def _range(lo: Column, hi: Column) -> tuple[Column, Column]:
    # A constant column gets a range of width one around its value.
    same = lo == hi
    return F.when(same, lo - 0.5).otherwise(lo), F.when(same, hi + 0.5).otherwise(hi)


def _bin(value: Column, lo: Column, hi: Column, bins: int) -> Column:
    return F.least(F.floor((value - lo) / ((hi - lo) / bins)), F.lit(bins - 1)).cast("int")


def histogram(df: DataFrame, variables: list[str], bins: int = 10) -> DataFrame:
    """Counts in equal-width bins from minimum to maximum; the last bin is closed."""
    long = long_values(df, variables)
    extremes = long.groupBy("variable").agg(F.min("value").alias("_lo"), F.max("value").alias("_hi"))
    lo, hi = _range(F.col("_lo"), F.col("_hi"))
    # One row per profiled variable.
    bounds = F.broadcast(extremes.select("variable", lo.alias("lo"), hi.alias("hi")))
    counts = (
        long.join(bounds, "variable")
        .groupBy("variable", _bin(F.col("value"), F.col("lo"), F.col("hi"), bins).alias("bin"))
        .count()
    )
    width = (F.col("hi") - F.col("lo")) / bins
    edges = bounds.select("*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return edges.join(counts, ["variable", "bin"], "left").select(
        "variable",
        "bin",
        (F.col("lo") + width * F.col("bin")).alias("bin_lo"),
        (F.col("lo") + width * (F.col("bin") + 1)).alias("bin_hi"),
        F.coalesce("count", F.lit(0)).alias("count"),
    )


def fences(df: DataFrame, variables: list[str]) -> DataFrame:
    """Quartiles and outlier fences; one row per variable."""
    quartiles = exact_quantiles(long_values(df, variables), ["variable"], "value", QUARTILES)
    reach = WHISKER * (F.col("q75") - F.col("q25"))
    return quartiles.withColumns({"lower": F.col("q25") - reach, "upper": F.col("q75") + reach})


def box_stats(df: DataFrame, variables: list[str]) -> DataFrame:
    """Quartiles, whisker ends and number of fliers per variable."""
    limits = F.broadcast(fences(df, variables))  # one row per variable
    value = F.col("value")
    inside = value.between(F.col("lower"), F.col("upper"))
    return (
        long_values(df, variables)
        .join(limits, "variable")
        .groupBy("variable", "q25", "q50", "q75")
        .agg(
            F.min(F.when(inside, value)).alias("whisker_low"),
            F.max(F.when(inside, value)).alias("whisker_high"),
            F.count_if(~inside).alias("fliers"),
        )
    )


def iqr_outliers(df: DataFrame, variables: list[str]) -> DataFrame:
    """Rows with a value outside its variable's fences."""
    limits = {r["variable"]: r for r in fences(df, variables).collect()}  # one row per variable
    outside = [
        (F.col(v) < limits[v]["lower"]) | (F.col(v) > limits[v]["upper"]) for v in variables if v in limits
    ]
    return df.filter(any_of(outside))


def pair_density(df: DataFrame, variables: list[str], bins: int = 10) -> DataFrame:
    """Two-dimensional bin counts for every pair of variables, over complete rows."""
    complete = df.select(*[F.col(v).cast("double") for v in variables]).dropna()
    ends = complete.agg(
        *[F.min(v).alias(f"lo_{v}") for v in variables], *[F.max(v).alias(f"hi_{v}") for v in variables]
    ).first()
    if ends[f"lo_{variables[0]}"] is None:
        return complete.select(*[F.lit(None).alias(c) for c in ("x", "y", "x_bin", "y_bin", "count")]).limit(0)
    bounds = {v: _range(F.lit(ends[f"lo_{v}"]), F.lit(ends[f"hi_{v}"])) for v in variables}
    binned = complete.select(*[_bin(F.col(v), *bounds[v], bins).alias(v) for v in variables])
    pairs = [
        F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(a).alias("x_bin"), F.col(b).alias("y_bin"))
        for a, b in combinations(variables, 2)
    ]
    return binned.select(F.inline(F.array(*pairs))).groupBy("x", "y", "x_bin", "y_bin").count()


def share(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows per group and their share; groups with a null are left out of the
    table but stay in the denominator.

    The group counts are materialised, so that the rows are read once.
    """
    counts = cut_lineage(df.groupBy(*columns).agg(F.count("*").alias("count")))
    total = counts.agg(F.sum("count")).scalar()
    return counts.withColumn("percent", F.col("count") / total).dropna(subset=columns)


def attribute_rows(df: DataFrame, attributes: list[str], *others: str) -> DataFrame:
    """One row per attribute of each row; a missing value becomes its own group."""
    items = [
        F.struct(
            F.lit(a).alias("attribute"),
            F.coalesce(F.col(a).cast("string"), F.lit("UNKNOWN")).alias("value"),
        )
        for a in attributes
    ]
    return df.select(*others, F.inline(F.array(*items)))


def crosstab_counts(df: DataFrame, attributes: list[str], outcomes: list[str]) -> DataFrame:
    """Rows per attribute value and outcome value, for all attributes in one pass."""
    items = [
        F.struct(F.lit(o).alias("outcome"), F.col(o).cast("int").alias("outcome_value")) for o in outcomes
    ]
    rows = attribute_rows(df, attributes, *outcomes)
    return (
        rows.select("attribute", "value", F.inline(F.array(*items)))
        .groupBy("attribute", "value", "outcome", "outcome_value")
        .count()
    )
