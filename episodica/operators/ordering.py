"""Ordered computations (positions, running sums, next rows) that survive hot keys.

A plain window puts all rows of one key into one task. Here rows are first
range-partitioned by (key, order): every slice holds about the same number of
rows, however they spread over keys. Windows then run inside (key, slice), and
only one summary row per slice is carried over to the following slices.

The order has to be unique within a key. The sliced table is checkpointed once,
because slice numbers must not change between the branches that read them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from episodica.session import cut_lineage

SLICE = "_slice"


def slice_rows(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Number balanced, order-preserving slices of ``df`` in column ``_slice``."""
    ranged = df.repartitionByRange(*[F.col(k) for k in keys], *order)
    return cut_lineage(ranged.withColumn(SLICE, F.spark_partition_id()))


def _continued(sliced: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the keys at which some slice starts; only these can span slices.

    The first keys make one row per slice, so the broadcast is bounded by
    spark.sql.shuffle.partitions.
    """
    first = sliced.groupBy(SLICE).agg(F.min(F.struct(*keys)).alias("_first"))
    names = {k: f"_first_{k}" for k in keys}
    edges = first.select(*[F.col(f"_first.{k}").alias(n) for k, n in names.items()])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()])
    return sliced.join(F.broadcast(edges), same, "left_semi")


def _carry_over(local: DataFrame, carry: DataFrame, keys: list[str]) -> DataFrame:
    """Attach the carried row of (key, slice).

    Those are slices of keys at which a slice starts: at most two per slice.
    """
    on = {k: f"_at_{k}" for k in [*keys, SLICE]}
    renamed = carry.withColumnsRenamed(on)
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(at)) for k, at in on.items()])
    return local.join(F.broadcast(renamed), same, "left").drop(*on.values())


def sweep(
    sliced: DataFrame,
    keys: list[str],
    order: list[Column],
    running: dict[str, Column],
    following: dict[str, str] | None = None,
    found: str = "has_next",
) -> DataFrame:
    """Add running sums and values of the next row, per key and in order.

    ``running`` maps new columns to measures, summed over the earlier rows of
    the same key. ``following`` maps new columns to columns of the key's next
    row, and ``found`` tells whether there is one; the order is ascending then.
    """
    in_order = Window.partitionBy(*keys, SLICE).orderBy(*order)
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy(*keys).orderBy(SLICE)
    earlier = across.rowsBetween(Window.unboundedPreceding, -1)
    parts = {name: f"_part_{name}" for name in running}
    zero = F.lit(0)

    local = sliced.select("*", *[F.sum(m).over(before).alias(name) for name, m in running.items()])
    sums = [F.sum(m).alias(parts[name]) for name, m in running.items()]
    carried = [F.sum(part).over(earlier).alias(part) for part in parts.values()]
    if following:
        row = F.struct(*[F.col(c).alias(n) for n, c in following.items()])
        local = local.withColumn("_in", F.lead(row).over(in_order))
        key = [c.alias(f"o{i}") for i, c in enumerate(order)]
        sums.append(F.min(F.struct(*key, row.alias("row"))).alias("_head"))
        carried.append(F.lead(F.col("_head.row")).over(across).alias("_out"))

    groups = _continued(sliced, keys).groupBy(*keys, SLICE).agg(*sums)
    swept = _carry_over(local, groups.select(*keys, SLICE, *carried), keys)
    added = {n: F.coalesce(F.col(n), zero) + F.coalesce(F.col(part), zero) for n, part in parts.items()}
    if following:
        next_row = F.coalesce("_in", "_out")
        added |= {n: next_row[n] for n in following} | {found: next_row.isNotNull()}
    return swept.withColumns(added).drop("_in", "_out", *parts.values())


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    """Join rows with one row for each of their groups; a null key is a group like any other."""
    names = {k: f"_group_{k}" for k in keys}
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()])
    return rows.join(groups.withColumnsRenamed(names), same).drop(*names.values())


def add_position(df: DataFrame, keys: list[str], order: list[Column], name: str) -> DataFrame:
    """Add the 0-based position of each row within its key."""
    sliced = slice_rows(df, keys, order)
    return sweep(sliced, keys, order, {name: F.lit(1).cast("long")}).drop(SLICE)


def approximate_quantiles(df: DataFrame, keys: list[str], value: str, probs: dict[str, float]) -> DataFrame:
    """Observed values near the quantiles, from one sketch per key; no order, no second pass."""
    found = {n: F.percentile_approx(F.col(value).cast("double"), p, 10_000) for n, p in probs.items()}
    return df.filter(F.col(value).isNotNull()).groupBy(*keys).agg(*[q.alias(n) for n, q in found.items()])


def exact_quantiles(
    df: DataFrame, keys: list[str], value: str, probs: dict[str, float]
) -> DataFrame:
    """Exact quantiles with linear interpolation; one row per key, one column per probability.

    Values are counted before they are ordered, so repeated values cost one row
    and no task has to hold the values of a whole key.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    order = [F.col(value).asc()]
    sliced = slice_rows(counts, keys, order)
    totals = sliced.groupBy(*keys).agg(F.sum("_n").alias("_total"))
    ranked = join_groups(sweep(sliced, keys, order, {"_before": F.col("_n")}), totals, keys)

    def at(rank: Column) -> Column:
        here = (F.col("_before") <= rank) & (rank < F.col("_before") + F.col("_n"))
        return F.max(F.when(here, F.col(value).cast("double")))

    ends = []
    for name, p in probs.items():
        exact = (F.col("_total") - 1) * F.lit(p)
        ends += [at(F.floor(exact)).alias(f"_lo_{name}"), at(F.ceil(exact)).alias(f"_hi_{name}")]
    found = ranked.groupBy(*keys).agg(F.first("_total").alias("_total"), *ends)
    result = []
    for name, p in probs.items():
        exact = (F.col("_total") - 1) * F.lit(p)
        lo, hi = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        result.append((lo + (hi - lo) * (exact - F.floor(exact))).alias(name))
    return found.select(*keys, *result)
