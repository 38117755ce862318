"""Encode, fit, score and evaluate a grid of models over time splits."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from episodica.config import Study, TimeSplit
from episodica.operators import evaluation, models, stump
from episodica.operators.encoding import EPISODE, FeatureEncoder, count_block_long, features_long, number_codes
from episodica.operators.episodes import keep_episodes_of
from episodica.operators.ranking import rank_counts, score_counts, score_table
from episodica.operators.splits import temporal_split
from episodica.session import cut_lineage, scratch_path

MODEL_KEYS = ["split_id", "model_type", "parameter"]
LEDGER = "split_id int, model_type string, parameter string, fingerprint string, name string"
SCORES = "person_id long, episode_id long, label double, score double"
KEYS_OF_SCORES = "split_id int, model_type string, parameter string, requested string"
COUNTS = "split_id int, model_type string, parameter string, requested string, score double, n long, pos long"


@dataclass(frozen=True)
class FeatureSpec:
    """Which cohort columns become features, and how."""

    categorical: Sequence[str]
    numeric: Sequence[str]
    counted: Sequence[str] = ()
    time_column: str = "release_date"

    def encoder(self) -> FeatureEncoder:
        return FeatureEncoder(self.categorical, self.numeric, self.counted)


@dataclass
class EncodedSplit:
    """Materialised feature rows of one split."""

    split: TimeSplit
    train: DataFrame
    test: DataFrame
    names: list[str]


def code_counts(cohort: DataFrame, source: DataFrame | None, spec: FeatureSpec) -> DataFrame | None:
    """Code counts of the cohort's episodes, materialised: the source is read once for all splits."""
    if not spec.counted:
        return None
    return cut_lineage(count_block_long(keep_episodes_of(source, cohort), spec.counted))


def numbered_rows(
    cohort: DataFrame, counts: DataFrame | None, splits: Sequence[TimeSplit], spec: FeatureSpec
) -> tuple[DataFrame, DataFrame]:
    """The cohort's rows on any side of the splits with their numbered codes, written once for all splits, and the codes."""
    sides = [(x, y) for s in splits for x, y in ((s.train_start, s.train_end), (s.test_start, s.test_end))]
    inside = reduce(lambda a, b: a | b, [F.col(spec.time_column).between(F.lit(x), F.lit(y)) for x, y in sides])
    rows = cohort.filter(inside)
    if counts is not None and len(splits) == 1:
        counts = keep_episodes_of(counts, rows)
    used = dict.fromkeys([*EPISODE, spec.time_column, "label", *spec.categorical, *spec.numeric])
    return number_codes(rows.select(*used), counts, spec.categorical, spec.counted)


def encode_split(rows: DataFrame, places: DataFrame, split: TimeSplit, spec: FeatureSpec) -> EncodedSplit:
    """Split ``numbered_rows`` by time, fit the encoder on the training side, encode both sides once."""
    rows = temporal_split(rows, spec.time_column, [split])
    encoder = spec.encoder().fit_numbered(rows, places)
    encoded = encoder.transform_numbered(rows.withColumn("label", F.col("label").cast("double")), ["side", *EPISODE, "label"])
    ready = cut_lineage(encoded)
    train, test = (ready.filter(F.col("side") == s).drop("side") for s in ("train", "test"))
    return EncodedSplit(split, train, test, encoder.names)


def score_grid(
    cohort: DataFrame,
    source: DataFrame | None,
    study: Study,
    spec: FeatureSpec,
    cells: Iterable[models.Cell],
    path: str | None = None,
    seed: int = 0,
) -> tuple[str, DataFrame]:
    """Fit all cells on all splits and write their scores; returns the path and the scores of these cells.

    Cells that one fit serves are fitted together. Their scores, and the counts
    of distinct scores, have folders of a name of their own; once both are written,
    rows of the ledger ``path``-done name them for each cell and a fingerprint of
    cohort, source, feature spec, splits and seed. Only folders that the ledger
    names are read, and only rows of this run's cells and fingerprint: a later run
    on the same path goes on where this one ended, and another cohort or seed
    neither overwrites nor reads these scores. The evaluation of each split, from
    its counts alone, goes to ``path``-grid, which holds that of the last run.
    """
    spark = cohort.sparkSession
    path = (path or scratch_path(spark, "scores")).rstrip("/")
    cells = list(cells)
    cohort = cut_lineage(cohort)
    counts = code_counts(cohort, source, spec)
    mark = fingerprint(cohort, counts, study, spec, seed)
    done = finished_cells(spark, f"{path}-done")
    open_splits = [s for s in study.splits if any((s.split_id, c.family, c.params, mark) not in done for c in cells)]
    numbered = numbered_rows(cohort, counts, open_splits, spec) if open_splits else None
    for split in study.splits:
        keys = [(split.split_id, c.family, c.params, mark) for c in cells]
        done = finished_cells(spark, f"{path}-done")
        missing = [c for c, key in zip(cells, keys, strict=True) if key not in done]
        encoded = encode_split(*numbered, split, spec) if missing else None
        for nest in models.nests(missing):
            _record(path, split, list(models.fit_and_score_all(nest, encoded.train, encoded.test, seed)), mark)
        own = _read(spark, path, "counts", _named(spark, path, keys), COUNTS)
        grid = evaluate_counts(own, cohort, replace(study, splits=[split]), spec.time_column)
        grid.drop("split_id").write.mode("overwrite").parquet(f"{path}-grid/split_id={split.split_id}")
    keys = [(s.split_id, c.family, c.params, mark) for s in study.splits for c in cells]
    return path, _read(spark, path, "scores", _named(spark, path, keys), f"{SCORES}, {KEYS_OF_SCORES}")


def _record(path: str, split: TimeSplit, scored: list[tuple[models.Cell, DataFrame]], mark: str) -> None:
    """Write the scores of one nest's cells and their counts under a new name, then enter the name in the ledger."""
    parts = []
    for cell, scores in scored:
        names = {"split_id": split.split_id, "model_type": cell.family, "parameter": cell.params, "requested": cell.requested}
        parts.append(scores.withColumns({k: F.lit(v) for k, v in names.items()}))
    spark, name = parts[0].sparkSession, uuid.uuid4().hex
    reduce(DataFrame.unionByName, parts).write.parquet(f"{path}/scores/{name}")
    written = spark.read.schema(f"{SCORES}, {KEYS_OF_SCORES}").parquet(f"{path}/scores/{name}")
    score_counts(written, [*MODEL_KEYS, "requested"]).write.parquet(f"{path}/counts/{name}")
    entries = [(split.split_id, cell.family, cell.params, mark, name) for cell, _ in scored]
    # One file, so all cells of the nest enter at once.
    spark.createDataFrame(entries, LEDGER).coalesce(1).write.mode("append").parquet(f"{path}-done")


def fingerprint(cohort: DataFrame, counts: DataFrame | None, study: Study, spec: FeatureSpec, seed: int) -> str:
    """Stands for all that scores depend on besides the cell and the split's number."""

    def rows(df: DataFrame) -> list:
        columns = [F.col(f"`{c}`") for c in sorted(df.columns)]
        return [df.columns, *df.agg(F.count("*"), F.sum(F.xxhash64(*columns).cast("decimal(38,0)"))).first()]

    splits = sorted(study.splits, key=lambda s: s.split_id)
    parts = [rows(cohort), rows(counts) if counts is not None else None, splits, spec, seed]
    return hashlib.sha1(repr(parts).encode()).hexdigest()


def finished_cells(spark: SparkSession, ledger: str) -> dict[tuple, str]:
    """Name of the folders of each recorded cell; one row per split and cell of the grid."""
    try:
        rows = spark.read.schema(LEDGER).parquet(ledger).collect()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return {}
        raise
    # If two runs recorded the same cell, all readers follow the same one.
    return {tuple(row)[:-1]: row["name"] for row in sorted(rows, key=lambda r: r["name"], reverse=True)}


def _named(spark: SparkSession, path: str, keys: Sequence[tuple]) -> dict[str, list[tuple]]:
    """Folders that the ledger names for ``keys``, with the keys that each holds."""
    out: dict[str, list[tuple]] = {}
    done = finished_cells(spark, f"{path}-done")
    for key in keys:
        if key in done:
            out.setdefault(done[key], []).append(key)
    return out


def _read(spark: SparkSession, path: str, part: str, named: Mapping[str, list[tuple]], schema: str) -> DataFrame:
    """Rows of the named folders that belong to the keys looked for there."""
    if not named:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).parquet(*[f"{path}/{part}/{name}" for name in sorted(named)])
    wanted = sorted({"|".join(map(str, key[:3])) for keys in named.values() for key in keys})
    return rows.filter(F.concat_ws("|", "split_id", "model_type", "parameter").isin(wanted))


def read_scores(spark: SparkSession, path: str, mark: str) -> DataFrame:
    """All scores of one fingerprint that the ledger of ``path`` names."""
    keys = [key for key in finished_cells(spark, f"{path}-done") if key[-1] == mark]
    return _read(spark, path, "scores", _named(spark, path, keys), f"{SCORES}, {KEYS_OF_SCORES}")


def read_grid(spark: SparkSession, path: str) -> DataFrame:
    """The evaluation that the last run on ``path`` wrote."""
    return spark.read.parquet(f"{path}-grid")


def evaluate_grid(scores: DataFrame, cohort: DataFrame, study: Study, time_column: str = "release_date") -> DataFrame:
    """The result grid: one row per split and model, plus one baseline row per split."""
    return evaluate_counts(score_counts(scores, [*MODEL_KEYS, "requested"]), cohort, study, time_column)


def evaluate_counts(counts: DataFrame, cohort: DataFrame, study: Study, time_column: str = "release_date") -> DataFrame:
    """The result grid from counts of distinct scores.

    All models are evaluated by one query over their distinct scores.
    """
    table = rank_counts(counts.drop("requested"), MODEL_KEYS)
    wide = evaluation.results_grid(
        evaluation.metrics_at(table, MODEL_KEYS, study.cutoffs), MODEL_KEYS, study.cutoffs
    )
    auc = evaluation.auc_roc(table, MODEL_KEYS).select(*MODEL_KEYS, F.col("auc_roc"))
    asked = counts.groupBy(*MODEL_KEYS).agg(F.min("requested").alias("requested"))
    per_model = auc.join(wide, MODEL_KEYS).join(asked, MODEL_KEYS)
    sides = temporal_split(cohort, time_column, study.splits)
    sizes = sides.groupBy("split_id").agg(
        F.count_if(F.col("side") == "train").alias("train_size"),
        F.count_if(F.col("side") == "test").alias("test_size"),
        F.avg(F.when(F.col("side") == "test", F.col("label"))).alias("base_rate"),
    )
    baseline = sizes.select("split_id", F.lit("baseline").alias("model_type"))
    all_rows = per_model.unionByName(baseline, allowMissingColumns=True)
    spark = counts.sparkSession
    calendar = spark.createDataFrame(
        [(s.split_id, s.train_start, s.train_end, s.test_start, s.test_end) for s in study.splits],
        "split_id int, train_start date, train_end date, test_start date, test_end date",
    )
    # Both sides hold one row per split.
    known = F.broadcast(calendar.join(F.broadcast(sizes), "split_id"))
    return all_rows.join(known, "split_id")


@dataclass
class BestModelReport:
    """The chosen model on one split, with what explains it."""

    scores: DataFrame
    curve: DataFrame
    importances: DataFrame
    stump: DataFrame
    features: DataFrame

    def write(self, path: str) -> None:
        """One table per part below ``path``."""
        for name, part in vars(self).items():
            part.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{name}")


def best_cell() -> models.Cell:
    family, params = models.BEST_MODEL
    return models.Cell.of(family, **params)


def best_model(
    cohort: DataFrame,
    source: DataFrame | None,
    split: TimeSplit,
    spec: FeatureSpec,
    cell: models.Cell | None = None,
    seed: int = 0,
) -> BestModelReport:
    """Scores, precision-recall curve and importances of a tree ensemble, a stump, and the list of features."""
    cell = cell or best_cell()
    cohort = cut_lineage(cohort)
    counts = code_counts(cohort, source, spec)
    encoded = encode_split(*numbered_rows(cohort, counts, [split], spec), split, spec)
    scores, importances = models.forest(cell, encoded.train, encoded.test, seed)
    spark = cohort.sparkSession
    train = temporal_split(cohort, spec.time_column, [split]).filter(F.col("side") == "train")
    long = cut_lineage(features_long(train, spec.categorical, spec.numeric, source, spec.counted))
    return BestModelReport(
        scores,
        evaluation.pr_curve(score_table(scores, []), []),
        models.importance_rows(importances, encoded.names, spark),
        stump.best_split(stump.split_candidates(long, train)),
        spark.createDataFrame(list(enumerate(encoded.names)), "position int, feature string"),
    )
