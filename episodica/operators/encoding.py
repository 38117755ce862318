"""Dummies, bins, imputation, code counts and feature vectors."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from episodica.functions.columns import flag_equal
from episodica.operators.episodes import keep_episodes_of, keep_persons_of
from episodica.operators.ordering import add_position, exact_quantiles
from episodica.operators.profile import long_values
from episodica.operators.sparse import entries
from episodica.session import cut_lineage

EPISODE = ["person_id", "episode_id"]
# The column of number_codes: (index, n) of each code of the row's episode.
CODES = "_codes"


def observed_codes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct non-null (column, code) pairs."""
    items = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("code")) for c in columns]
    return df.select(F.inline(F.array(*items))).filter(F.col("code").isNotNull()).distinct()


def code_lists(codes: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """Sorted codes per column, for the wide forms, which have one expression per code.

    Columns with many codes stay long (count_block_long) or sparse (FeatureEncoder).
    """
    lists: dict[str, list[str]] = {c: [] for c in columns}
    for row in codes.toLocalIterator():
        lists[row["column"]].append(row["code"])
    return {c: sorted(v) for c, v in lists.items()}


def one_hot(df: DataFrame, codes: Mapping[str, Sequence[str]]) -> DataFrame:
    """Replace each column by one 0/1 column per listed code; null gives zeros."""
    dummies = [
        flag_equal(F.col(c).cast("string"), v).alias(f"{c}_{v}") for c, values in codes.items() for v in values
    ]
    return df.select(*[F.col(c) for c in df.columns if c not in codes], *dummies)


def value_dummy(df: DataFrame, columns: Sequence[str], value) -> DataFrame:
    """Turn columns into 1 where they equal the value, else 0."""
    return df.withColumns({c: flag_equal(F.col(c), value) for c in columns})


def undummy(df: DataFrame, columns: Sequence[str], prefix: str, name: str) -> DataFrame:
    """Turn dummy columns back into one category: the first column with the largest value.

    A row without any set dummy had no category; it gets UNKNOWN.
    """
    top = F.greatest(*[F.col(f"`{c}`") for c in columns]) if len(columns) > 1 else F.col(f"`{columns[0]}`")
    choice = F.coalesce(
        *[F.when((F.col(f"`{c}`") == top) & (top > 0), c.removeprefix(prefix)) for c in columns],
        F.lit("UNKNOWN"),
    )
    return df.withColumn(name, choice)


def equal_frequency_bins(df: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """Add bin number and edges of quantile bins; right-closed, the lowest value included."""
    names = {f"e{i}": i / bins for i in range(bins + 1)}
    row = exact_quantiles(long_values(df, [column]), ["variable"], "value", names).first()
    edges = [row[n] for n in names]
    if len(set(edges)) < len(edges):
        raise ValueError(f"bin edges of {column} are not unique: {edges}")
    above = sum((F.col(column) > F.lit(e)).cast("int") for e in edges[1:-1])
    steps = F.array(*[F.lit(e) for e in edges])
    return df.withColumn(f"{column}_bin", above).withColumns(
        {
            f"{column}_lo": F.get(steps, F.col(f"{column}_bin")),
            f"{column}_hi": F.get(steps, F.col(f"{column}_bin") + 1),
        }
    )


def fill_values(df: DataFrame, columns: Sequence[str], by: str = "median") -> dict[str, float]:
    """Value that replaces missing ones, per column: median, mode, zero, else mean.

    The mode is the smallest of the most frequent values. A column without any
    value has no fill value.
    """
    if by == "zero":
        return {c: 0.0 for c in columns}
    long = long_values(df, list(columns))
    if by == "median":
        found = exact_quantiles(long, ["variable"], "value", {"fill": 0.5})
    elif by == "mode":
        counts = long.groupBy("variable", "value").agg(F.count("*").alias("n"))
        top = F.max(F.struct("n", (-F.col("value")).alias("neg")))
        found = counts.groupBy("variable").agg((-top["neg"]).alias("fill"))
    else:
        found = long.groupBy("variable").agg(F.avg("value").alias("fill"))
    return {r["variable"]: r["fill"] for r in found.collect()}  # one row per column


def impute(df: DataFrame, fills: Mapping[str, float]) -> DataFrame:
    """Replace missing values by the fitted ones."""
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(v)) for c, v in fills.items()})


def impute_by_split(
    rows: DataFrame, columns: Sequence[str], per_side: bool = False
) -> DataFrame:
    """Fill missing numbers with medians of each split's training rows.

    ``per_side`` gives the test rows their own medians instead.
    """
    keys = ["split_id", "side"] if per_side else ["split_id"]
    fitted = rows if per_side else rows.filter(F.col("side") == "train")
    medians = exact_quantiles(long_values(fitted, list(columns), keys), [*keys, "variable"], "value", {"fill": 0.5})
    wide = medians.groupBy(*keys).agg(
        *[F.max(F.when(F.col("variable") == c, F.col("fill"))).alias(f"_fill_{c}") for c in columns]
    )
    # One row per split (and side).
    filled = rows.join(F.broadcast(wide), keys, "left")
    return filled.withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.col(f"_fill_{c}")) for c in columns}
    ).drop(*[f"_fill_{c}" for c in columns])


def count_block_long(source: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Components per episode and code: (person, episode, column, code, n)."""
    items = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("code")) for c in columns]
    return (
        source.select(*EPISODE, F.inline(F.array(*items)))
        .filter(F.col("code").isNotNull())
        .groupBy(*EPISODE, "column", "code")
        .agg(F.count("*").alias("n"))
    )


def count_block_wide(source: DataFrame, codes: Mapping[str, Sequence[str]]) -> DataFrame:
    """One row per episode, one count column per listed code; one aggregation for all columns."""
    counts = [
        F.count_if(F.col(c).cast("string") == v).alias(f"{c}_{v}") for c, values in codes.items() for v in values
    ]
    return source.groupBy(*EPISODE).agg(*counts)


def add_code_counts(cohort: DataFrame, source: DataFrame, codes: Mapping[str, Sequence[str]]) -> DataFrame:
    """Left join of all count columns at once; episodes without source rows get zeros."""
    names = [f"{c}_{v}" for c, values in codes.items() for v in values]
    block = count_block_wide(keep_persons_of(source, cohort), codes)
    return cohort.join(block, EPISODE, "left").fillna(0, subset=names)


def features_long(
    rows: DataFrame,
    categorical: Sequence[str],
    numeric: Sequence[str],
    source: DataFrame | None = None,
    counted: Sequence[str] = (),
) -> DataFrame:
    """Non-zero features as (person, episode, split_id, side, label, feature, value).

    Dummies and numeric columns come from the row itself without a shuffle;
    code counts are joined from the source.
    """
    keys = [*EPISODE, *[c for c in ("split_id", "side", "label") if c in rows.columns]]
    items = [
        F.struct(
            F.concat(F.lit(f"{c}_"), F.col(c).cast("string")).alias("feature"),
            F.lit(1.0).alias("value"),
        )
        for c in categorical
    ] + [
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in numeric
    ]
    own = rows.select(*keys, F.inline(F.array(*items))).filter(
        F.col("feature").isNotNull() & (F.coalesce(F.col("value"), F.lit(0.0)) != 0)
    )
    if source is None or not counted:
        return own
    block = count_block_long(keep_episodes_of(source, rows), counted)
    from_source = rows.select(*keys).join(block, EPISODE).select(
        *keys,
        F.concat_ws("_", "column", "code").alias("feature"),
        F.col("n").cast("double").alias("value"),
    )
    return own.unionByName(from_source)


def common_features(features: DataFrame) -> DataFrame:
    """Names that occur on both sides of each split.

    One aggregation over flags: a feature that every row has is combined in each
    task before the shuffle.
    """
    sides = features.groupBy("split_id", "feature").agg(
        *[F.max(F.col("side") == s).alias(s) for s in ("train", "test")]
    )
    return sides.filter("train and test").select("split_id", "feature")


def _codes_by_side(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    items = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("code")) for c in columns]
    none = F.array().cast("array<struct<column:string,code:string>>")
    return rows.select("side", F.inline(F.concat(none, F.array(*items)) if items else none)).filter("code is not null")


@dataclass
class FeatureEncoder:
    """Fitted mapping from cohort rows to sparse feature vectors.

    Categories and counted codes are those seen in both train and test; missing
    numbers take the median of the training rows, and zero where training has
    none. A written table gives every (column, code) its place in the vector, so
    codes whose joined names are equal stay apart. Names are kept on the driver too,
    like the coefficients of the models that are fitted on them.
    """

    categorical: Sequence[str]
    numeric: Sequence[str]
    counted: Sequence[str] = ()
    fills: dict[str, float] = field(default_factory=dict)
    codes: list[str] = field(default_factory=list)
    places: DataFrame | None = None
    numbers: np.ndarray | None = None

    @property
    def names(self) -> list[str]:
        return [*self.codes, *self.numeric]

    def fit(self, rows: DataFrame, counts: DataFrame | None = None) -> FeatureEncoder:
        """Learn codes and fill values from materialised rows with a column ``side``.

        ``counts`` holds code counts of the same episodes, as count_block_long gives them.
        """
        seen = _codes_by_side(rows, self.categorical)
        if self.counted:
            seen = seen.unionByName(rows.select(*EPISODE, "side").join(counts, EPISODE).select("side", "column", "code"))
        sides = seen.groupBy("column", "code").agg(*[F.max(F.col("side") == s).alias(s) for s in ("train", "test")])
        self.places = _placed(sides.filter("train and test"), self.categorical, self.counted)
        found = sorted((r["index"], r["column"], r["code"]) for r in self.places.toLocalIterator())
        self.codes = [f"{column}_{code}" for _, column, code in found]
        return self._fit_fills(rows)

    def fit_numbered(self, rows: DataFrame, places: DataFrame) -> FeatureEncoder:
        """The same from rows of ``number_codes`` with a column ``side``, without a join over them."""
        seen = rows.select("side", F.explode(f"{CODES}.index").alias("index"))
        sides = seen.groupBy("index").agg(*[F.max(F.col("side") == s).alias(s) for s in ("train", "test")])
        both = places.join(sides.filter("train and test").select("index"), "index")
        found = sorted((r["index"], r["column"], r["code"]) for r in both.toLocalIterator())
        self.codes = [f"{column}_{code}" for _, column, code in found]
        self.numbers = np.array([index for index, _, _ in found], np.int64)
        return self._fit_fills(rows)

    def _fit_fills(self, rows: DataFrame) -> FeatureEncoder:
        fills = fill_values(rows.filter(F.col("side") == "train"), self.numeric, "median") if self.numeric else {}
        self.fills = {c: 0.0 if fills.get(c) is None else fills[c] for c in self.numeric}
        return self

    def transform(self, rows: DataFrame, counts: DataFrame | None = None) -> DataFrame:
        """Add column ``features``: counts of the row's codes, then its numbers.

        Rows have an episode each. A row's vector holds one entry for each of
        its codes, however often it occurs and however many codes there are.
        """
        listed = _listed(_found(rows, counts, self.categorical, self.counted), self.places)
        filled = impute(rows, self.fills)
        return self._vectors(filled.join(listed, EPISODE, "left"), filled.columns)

    def transform_numbered(self, rows: DataFrame, keep: Sequence[str]) -> DataFrame:
        """``keep`` columns and ``features`` of rows of ``number_codes``: neither join nor shuffle."""
        needed = [*dict.fromkeys([*keep, *self.numeric]), CODES]
        return self._vectors(impute(rows.select(*needed), self.fills), list(keep), self.numbers)

    def _vectors(self, filled: DataFrame, keep: Sequence[str], numbered: np.ndarray | None = None) -> DataFrame:
        numbers = F.array(*[F.col(c) for c in self.numeric]).cast("array<double>") if self.numeric else F.array().cast("array<double>")
        parts = filled.select(
            *keep, F.coalesce(f"{CODES}.index", F.array().cast("array<int>")).alias("_index"),
            F.coalesce(f"{CODES}.n", F.array().cast("array<double>")).alias("_n"), numbers.alias("_numbers"),
        )
        return _with_vectors(parts, keep, len(self.codes), len(self.numeric), numbered)


def _found(rows: DataFrame, counts: DataFrame | None, categorical: Sequence[str], counted: Sequence[str]) -> DataFrame:
    """Codes of each row's episode: (person, episode, column, code, n)."""
    none = F.array().cast("array<struct<column:string,code:string,n:bigint>>")
    items = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("code"), F.lit(1).cast("long").alias("n")) for c in categorical]
    found = rows.select(*EPISODE, F.inline(F.concat(none, F.array(*items)) if items else none))
    if counted:
        found = found.unionByName(counts.filter(F.col("column").isin(list(counted))).select(*found.columns))
    return found


def _placed(codes: DataFrame, categorical: Sequence[str], counted: Sequence[str]) -> DataFrame:
    """A written table that numbers distinct (column, code) by column as listed and code."""
    order = F.array_position(F.array(*[F.lit(c) for c in [*categorical, *counted, ""]]), F.col("column"))
    keyed = codes.select(F.lit(0).alias("all"), order.alias("rank"), "column", "code")
    placed = add_position(keyed, ["all"], [F.col("rank"), F.col("code")], "index")
    return cut_lineage(placed.select("column", "code", F.col("index").cast("int").alias("index")))


def _listed(found: DataFrame, places: DataFrame) -> DataFrame:
    """One row per episode, with the numbers and counts of its codes."""
    entry = F.struct("index", F.col("n").cast("double").alias("n"))
    return found.join(places, ["column", "code"]).groupBy(*EPISODE).agg(F.sort_array(F.collect_list(entry)).alias(CODES))


def number_codes(
    rows: DataFrame, counts: DataFrame | None, categorical: Sequence[str], counted: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """``rows`` with the numbers and counts of their codes, written, and the table (column, code, index) of all codes.

    Encoders of several splits read these rows; each split's own places follow
    the same order, so that its vectors come from the numbers without a join.
    """
    found = _found(rows, counts, categorical, counted)
    places = _placed(found.filter("code is not null").select("column", "code").distinct(), categorical, counted)
    return cut_lineage(rows.join(_listed(found, places), EPISODE, "left")), places


def _with_vectors(
    rows: DataFrame, keep: Sequence[str], codes: int, numbers: int, numbered: np.ndarray | None = None
) -> DataFrame:
    """``keep`` columns and ``features``, built in Arrow batches from ``_index``, ``_n`` and ``_numbers``.

    ``numbered`` has the ``_index`` of each place, ascending; entries without a place drop out.
    """
    size = codes + numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count, own = batch.num_rows, batch.column(len(keep))
            lengths = own.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            wide = batch.column(len(keep) + 2).flatten().to_numpy(zero_copy_only=False).reshape(count, numbers)
            at_row, at_number = np.nonzero(wide)
            row, index = np.repeat(np.arange(count), lengths), own.flatten().to_numpy(zero_copy_only=False)
            value = batch.column(len(keep) + 1).flatten().to_numpy(zero_copy_only=False)
            if numbered is not None:
                place = np.searchsorted(numbered, index)
                known = np.append(numbered, -1)[place] == index
                row, index, value = row[known], place[known], value[known]
            row = np.concatenate([row, at_row])
            index, value = np.concatenate([index, codes + at_number]), np.concatenate([value, wide[at_row, at_number]])
            order = np.lexsort((index, row))
            ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(row, minlength=count))]), pa.int32())
            parts = [
                pa.array(np.zeros(count), pa.int8()), pa.array(np.full(count, size), pa.int32()),
                pa.ListArray.from_arrays(ends, pa.array(index[order], pa.int32())),
                pa.ListArray.from_arrays(ends, pa.array(value[order], pa.float64())),
            ]
            vectors = pa.StructArray.from_arrays(parts, names=["type", "size", "indices", "values"])
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], vectors], names=[*keep, "features"])

    schema = T.StructType([*rows.select(*keep).schema, T.StructField("features", VectorUDT())])
    return rows.mapInArrow(run, schema)


def vector_entries(encoded: DataFrame, names: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Non-zero entries of the vectors by feature name; the names go with the tasks, so that no entry is shuffled."""
    listed = pa.array(names, pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, feature, value = entries(batch.column(len(keys)))
            own = [c.take(pa.array(row)) for c in batch.columns[: len(keys)]]
            yield pa.RecordBatch.from_arrays([*own, listed.take(pa.array(feature)), pa.array(value)], names=[*keys, "feature", "value"])

    schema = T.StructType(
        [*encoded.select(*keys).schema, T.StructField("feature", T.StringType()), T.StructField("value", T.DoubleType())]
    )
    return encoded.select(*keys, "features").mapInArrow(run, schema)
