"""Queries for encoding, imputation, code counts and splits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from episodica.checks.registry import query, rounded
from episodica.checks.tables import ALL_COUNT_SQL, CODE_LISTS, STUDY, ZERO_SQL, cohort, plain_cohort
from episodica.operators import encoding, splits
from episodica.operators.evaluation import base_rate
from episodica.operators.ordering import add_position
from episodica.plans import model_grid
from episodica.session import cut_lineage
from episodica.sources import driver_tables as D

CATEGORICAL = ["gender", "race", "ethnic"]
NUMERIC = [
    "total_components", "felony_components", "prior_episodes", "age_at_episode",
    "years_in_stay", "age_at_first", "height", "weight",
]
IMPUTED = ["height", "weight"]
COUNTED = ["offense_code", "county_code"]

GENDERS = ("FEMALE", "MALE")
RACES = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE")


def dummy_sql(column: str, values) -> str:
    return ", ".join(f"CASE WHEN {column} = '{v}' THEN 1 ELSE 0 END AS \"{column}_{v}\"" for v in values)


def split_features(spark, sf_dir, chosen=STUDY.splits):
    """Cohort rows per split side and their long features."""
    rows = cut_lineage(splits.temporal_split(cohort(spark, sf_dir), "release_date", chosen))
    features = encoding.features_long(rows, CATEGORICAL, NUMERIC, D.component(spark, sf_dir), COUNTED)
    return rows, cut_lineage(features)


@query(
    "one_hot",
    f"""SELECT person_id, {dummy_sql('gender', GENDERS)}, {dummy_sql('race', RACES)},
          {dummy_sql('ethnic', REGIONS)} FROM person""",
)
def one_hot(spark, sf_dir):
    people = D.person(spark, sf_dir).select("person_id", *CATEGORICAL)
    codes = encoding.code_lists(encoding.observed_codes(people, CATEGORICAL), CATEGORICAL)
    return encoding.one_hot(people, codes)


@query(
    "value_dummy",
    """SELECT person_id, CASE WHEN race = 'MACHINERY' THEN 1 ELSE 0 END AS race,
         CASE WHEN ethnic = 'MACHINERY' THEN 1 ELSE 0 END AS ethnic FROM person""",
)
def value_dummy(spark, sf_dir):
    people = D.person(spark, sf_dir).select("person_id", "race", "ethnic")
    return encoding.value_dummy(people, ["race", "ethnic"], "MACHINERY")


EDGE_SQL = ", ".join(f"quantile_cont(age_at_episode, {i / 10}) AS e{i}" for i in range(11))


@query(
    "qcut_bins",
    f"""SELECT person_id, episode_id, CAST({' + '.join(f'(age_at_episode > e{i})::INTEGER' for i in range(1, 10))}
          AS INTEGER) AS age_at_episode_bin,
          round(list_extract([{', '.join(f'e{i}' for i in range(11))}],
            1 + {' + '.join(f'(age_at_episode > e{i})::INTEGER' for i in range(1, 10))}), 6) AS age_at_episode_lo,
          round(list_extract([{', '.join(f'e{i}' for i in range(11))}],
            2 + {' + '.join(f'(age_at_episode > e{i})::INTEGER' for i in range(1, 10))}), 6) AS age_at_episode_hi
        FROM cohort, (SELECT {EDGE_SQL} FROM cohort)""",
)
def qcut_bins(spark, sf_dir):
    kept = cut_lineage(plain_cohort(spark, sf_dir).select("person_id", "episode_id", "age_at_episode"))
    binned = encoding.equal_frequency_bins(kept, "age_at_episode", 10)
    return rounded(
        binned.select("person_id", "episode_id", "age_at_episode_bin", "age_at_episode_lo", "age_at_episode_hi"),
        "age_at_episode_lo",
        "age_at_episode_hi",
    )


def imputed(how: str):
    def run(spark, sf_dir):
        people = D.person(spark, sf_dir).select("person_id", *IMPUTED)
        return rounded(encoding.impute(people, encoding.fill_values(people, IMPUTED, how)), *IMPUTED)

    return run


def impute_sql(fill: str) -> str:
    parts = ", ".join(f"round(COALESCE({c}, {fill.format(c=c)}), 6) AS {c}" for c in IMPUTED)
    return f"SELECT person_id, {parts} FROM person"


query("impute_median", impute_sql("(SELECT quantile_cont({c}, 0.5) FROM person)"))(imputed("median"))
query("impute_mean", impute_sql("(SELECT avg({c}) FROM person)"))(imputed("mean"))
query("impute_zero", impute_sql("CAST(0 AS DOUBLE)"))(imputed("zero"))
query(
    "impute_mode",
    impute_sql(
        "(SELECT {c} FROM person WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"
    ),
)(imputed("mode"))


@query(
    "undummy",
    "SELECT person_id, race AS race_again, COALESCE(ethnic, 'UNKNOWN') AS ethnic_again FROM person",
)
def undummy(spark, sf_dir):
    people = D.person(spark, sf_dir).select("person_id", "race", "ethnic")
    codes = encoding.code_lists(encoding.observed_codes(people, ["race", "ethnic"]), ["race", "ethnic"])
    dummies = encoding.one_hot(people, codes)
    for c in ("race", "ethnic"):
        names = [n for n in dummies.columns if n.startswith(f"{c}_")]
        dummies = encoding.undummy(dummies, names, f"{c}_", f"{c}_again")
    return dummies.select("person_id", "race_again", "ethnic_again")


@query(
    "count_features",
    f"""SELECT c.person_id, c.episode_id, c.label, {ZERO_SQL} FROM cohort c LEFT JOIN
        (SELECT person_id, episode_id, {ALL_COUNT_SQL} FROM component GROUP BY person_id, episode_id) b
        ON c.person_id = b.person_id AND c.episode_id = b.episode_id""",
)
def count_features(spark, sf_dir):
    rows = cohort(spark, sf_dir).select(*encoding.EPISODE, "label")
    return encoding.add_code_counts(rows, D.component(spark, sf_dir), CODE_LISTS)


@query("feature_intersect", "SELECT split_id, feature FROM shared_features")
def feature_intersect(spark, sf_dir):
    return encoding.common_features(split_features(spark, sf_dir)[1])


@query(
    "feature_list",
    """SELECT split_id, feature, row_number() OVER (PARTITION BY split_id ORDER BY feature) - 1 AS position
       FROM shared_features""",
)
def feature_list(spark, sf_dir):
    shared = encoding.common_features(split_features(spark, sf_dir)[1])
    return add_position(shared, ["split_id"], [F.col("feature")], "position")


FILL_SQL = ", ".join(
    f"COALESCE(r.{c}, (SELECT quantile_cont({c}, 0.5) FROM split_rows t WHERE t.split_id = r.split_id "
    f"AND t.side = 'train')) AS {c}"
    for c in IMPUTED
)


@query(
    "preprocess",
    f"""SELECT f.split_id, f.side, f.feature, count(*) AS n, round(sum(f.value), 4) AS total
        FROM (SELECT split_id, side, feature, value FROM long_features WHERE feature NOT IN ('height', 'weight')
              UNION ALL
              SELECT x.split_id, x.side, u.feature, u.value
              FROM (SELECT r.split_id, r.side, {FILL_SQL} FROM split_rows r) x,
              LATERAL (VALUES ('height', x.height), ('weight', x.weight)) AS u(feature, value)) f
        JOIN shared_features s ON f.split_id = s.split_id AND f.feature = s.feature
        GROUP BY f.split_id, f.side, f.feature""",
)
def preprocess(spark, sf_dir):
    rows = cut_lineage(splits.temporal_split(cohort(spark, sf_dir), "release_date", STUDY.splits))
    filled = encoding.impute_by_split(rows, IMPUTED)
    features = cut_lineage(
        encoding.features_long(filled, CATEGORICAL, NUMERIC, D.component(spark, sf_dir), COUNTED)
    )
    # Totals first: a feature that most rows have is summed before the join.
    totals = features.groupBy("split_id", "side", "feature").agg(
        F.count("*").alias("n"), F.sum("value").alias("total")
    )
    shared = encoding.common_features(totals)
    return rounded(totals.join(shared, ["split_id", "feature"]), "total", digits=4)


@query(
    "split_calendar",
    """WITH RECURSIVE bounds AS (
         SELECT CAST(min(o_orderdate) AS DATE) AS s, CAST(max(o_orderdate) AS DATE) AS e FROM orders),
       steps(m, w, prev_end) AS (
         SELECT m, 1, s FROM bounds, (VALUES (6), (12)) AS v(m)
         UNION ALL
         SELECT m, w + 1, CAST(s + to_months(CAST(w * m AS INTEGER)) + to_months(m) - INTERVAL 1 DAY AS DATE)
         FROM steps, bounds WHERE e >= prev_end + to_months(m))
       SELECT s AS train_start, CAST(s + to_months(CAST(w * m AS INTEGER)) - INTERVAL 1 DAY AS DATE) AS train_end,
         CAST(s + to_months(CAST(w * m AS INTEGER)) AS DATE) AS test_start,
         CAST(s + to_months(CAST(w * m AS INTEGER)) + to_months(m) - INTERVAL 1 DAY AS DATE) AS test_end,
         m AS window_months
       FROM steps, bounds WHERE e >= prev_end + to_months(m)""",
)
def split_calendar(spark, sf_dir):
    ranges = D.load(spark, sf_dir, "orders").agg(
        F.min("o_orderdate").cast("date").alias("start"), F.max("o_orderdate").cast("date").alias("end")
    )
    return splits.split_calendar(ranges, [6, 12])


@query(
    "encoded_vectors",
    f"""SELECT person_id, episode_id, split_id, side, count(*) AS n_entries,
          CAST(sum(('0x' || substr(md5(feature), 1, 6))::BIGINT * CAST(floor(value * 1000 + 0.5) AS BIGINT)) AS BIGINT) AS entries
        FROM (SELECT f.person_id, f.episode_id, f.split_id, f.side, f.feature, f.value
          FROM long_features f JOIN shared_features s ON f.split_id = s.split_id AND f.feature = s.feature
          WHERE f.feature NOT IN ({', '.join(f"'{c}'" for c in NUMERIC)})
          UNION ALL
          SELECT r.person_id, r.episode_id, r.split_id, r.side, u.feature, COALESCE(u.value, m.fill)
          FROM split_rows r, LATERAL (VALUES {', '.join(f"('{c}', CAST({c} AS DOUBLE))" for c in NUMERIC)}) AS u(feature, value)
          JOIN (SELECT split_id, v.feature, quantile_cont(v.value, 0.5) AS fill FROM split_rows,
                LATERAL (VALUES {', '.join(f"('{c}', CAST({c} AS DOUBLE))" for c in NUMERIC)}) AS v(feature, value)
                WHERE side = 'train' AND v.value IS NOT NULL GROUP BY split_id, v.feature) m
            ON m.split_id = r.split_id AND m.feature = u.feature)
        WHERE value <> 0 GROUP BY person_id, episode_id, split_id, side""",
)
def encoded_vectors(spark, sf_dir):
    """The vectors that the models are fitted on: each row's number of entries, and a sum over names and values of all."""
    spec = model_grid.FeatureSpec(CATEGORICAL, NUMERIC, COUNTED)
    episodes = cut_lineage(cohort(spark, sf_dir).select(*encoding.EPISODE, spec.time_column, "label", *CATEGORICAL, *NUMERIC))
    counts = model_grid.code_counts(episodes, D.component(spark, sf_dir), spec)
    # Codes are numbered once for all splits; a split's vectors need no shuffle then.
    rows, places = model_grid.numbered_rows(episodes, counts, STUDY.splits, spec)
    keys = [*encoding.EPISODE, "split_id", "side"]
    parts = []
    for s in STUDY.splits:
        own = splits.temporal_split(rows, spec.time_column, [s])
        encoder = spec.encoder().fit_numbered(own, places)
        parts.append(encoding.vector_entries(encoder.transform_numbered(own, keys), encoder.names, keys))
    name = F.conv(F.substring(F.md5("feature"), 1, 6), 16, 10).cast("long")
    value = F.floor(F.col("value") * 1000 + 0.5)
    return reduce(DataFrame.unionByName, parts).groupBy(*keys).agg(
        F.count("*").alias("n_entries"), F.sum(name * value).alias("entries")
    )


@query(
    "random_split",
    """SELECT person_id, episode_id, label,
         CASE WHEN ('0x' || substr(md5(person_id || '|' || episode_id || '|0'), 1, 8))::BIGINT % 4 = 0
              THEN 'test' ELSE 'train' END AS side FROM cohort""",
)
def random_split(spark, sf_dir):
    return splits.random_split(cohort(spark, sf_dir), encoding.EPISODE).select(*encoding.EPISODE, "label", "side")


@query(
    "baseline_rate",
    """SELECT split_id, side, count(*) AS n, round(avg(label), 6) AS base_rate
       FROM split_rows GROUP BY split_id, side""",
)
def baseline_rate(spark, sf_dir):
    rows = splits.temporal_split(cohort(spark, sf_dir), "release_date", STUDY.splits)
    return rounded(base_rate(rows, ["split_id", "side"]), "base_rate")
