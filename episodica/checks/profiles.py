"""Queries for aggregations, profiles, history windows, ranks and set operations."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from episodica.checks.registry import query, rounded
from episodica.checks.tables import (
    EPISODE_COLUMNS,
    STUDY,
    cohort,
    plain_cohort,
    kept_cohort,
    labelled,
    merged,
    study_episodes,
)
from episodica.operators import encoding, episodes, profile, ranking
from episodica.session import cut_lineage
from episodica.sources import driver_tables as D

VARIABLES = [
    "total_components", "felony_components", "label", "height", "weight",
    "age_at_episode", "years_in_stay", "age_at_first", "prior_episodes",
]


def unpivot_sql(variables: list[str], source: str, others: str = "") -> str:
    """SQL that gives one row per non-null value of the variables."""
    values = ", ".join(f"('{v}', CAST({v} AS DOUBLE))" for v in variables)
    return (
        f"(SELECT {others} u.variable, u.value FROM {source}, LATERAL (VALUES {values}) AS u(variable, value) "
        "WHERE u.value IS NOT NULL)"
    )


DESCRIBE_SQL = """count(*) AS count, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std,
    round(min(value), 6) AS min, round(quantile_cont(value, 0.25), 6) AS q25,
    round(quantile_cont(value, 0.5), 6) AS q50, round(quantile_cont(value, 0.75), 6) AS q75,
    round(max(value), 6) AS max"""
DESCRIBED = ("mean", "std", "min", "q25", "q50", "q75", "max")


@query("collapse_episodes", f"SELECT {EPISODE_COLUMNS} FROM study_episode")
def collapse_episodes(spark, sf_dir):
    return study_episodes(spark, sf_dir)


@query(
    "episode_severity",
    """SELECT person_id, episode_id, felony_components,
         CASE WHEN felony_components > 0 THEN 'FELON' ELSE 'MISD' END AS episode_class FROM episode""",
)
def episode_severity(spark, sf_dir):
    return episodes.collapse_episodes(merged(spark, sf_dir), STUDY).select(
        "person_id", "episode_id", "felony_components", "episode_class"
    )


@query(
    "share_single",
    """SELECT race, count(*) AS count, round(count(*) / CAST((SELECT count(*) FROM cohort) AS DOUBLE), 6) AS percent
       FROM cohort WHERE race IS NOT NULL GROUP BY race""",
)
def share_single(spark, sf_dir):
    return rounded(profile.share(plain_cohort(spark, sf_dir), ["race"]), "percent")


@query(
    "share_multi",
    """SELECT race, ethnic, count(*) AS count,
         round(count(*) / CAST((SELECT count(*) FROM cohort) AS DOUBLE), 6) AS percent
       FROM cohort WHERE race IS NOT NULL AND ethnic IS NOT NULL GROUP BY race, ethnic""",
)
def share_multi(spark, sf_dir):
    return rounded(profile.share(plain_cohort(spark, sf_dir), ["race", "ethnic"]), "percent")


@query(
    "value_share",
    """SELECT race, round(count(*) / CAST((SELECT count(*) FROM scores) AS DOUBLE), 6) AS percent
       FROM scores GROUP BY race""",
)
def value_share(spark, sf_dir):
    return rounded(profile.share(D.scores(spark, sf_dir), ["race"]).select("race", "percent"), "percent")


OFFENSE_SQL = ", ".join(
    f"count(*) FILTER (offense_code = '{o}') AS offense_code_{o}"
    for o in ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
)


@query(
    "count_block_wide",
    f"SELECT person_id, episode_id, {OFFENSE_SQL} FROM component GROUP BY person_id, episode_id",
)
def count_block_wide(spark, sf_dir):
    source = D.component(spark, sf_dir)
    codes = encoding.code_lists(encoding.observed_codes(source, ["offense_code"]), ["offense_code"])
    return encoding.count_block_wide(source, codes)


@query("count_block_long", 'SELECT person_id, episode_id, "column", code, n FROM count_long')
def count_block_long(spark, sf_dir):
    return encoding.count_block_long(D.component(spark, sf_dir), ["offense_code", "county_code"])


@query("describe", f"SELECT variable, {DESCRIBE_SQL} FROM {unpivot_sql(VARIABLES, 'cohort')} GROUP BY variable")
def describe(spark, sf_dir):
    return rounded(profile.describe(kept_cohort(spark, sf_dir), VARIABLES), *DESCRIBED)


@query(
    "describe_by_group",
    " UNION ALL ".join(
        f"SELECT '{g}' AS attribute, {g} AS group_value, variable, {DESCRIBE_SQL} "
        f"FROM {unpivot_sql(VARIABLES, 'cohort', f'{g},')} GROUP BY {g}, variable"
        for g in ("gender", "race")
    ),
)
def describe_by_group(spark, sf_dir):
    found = profile.describe_groups(kept_cohort(spark, sf_dir), VARIABLES, ["gender", "race"])
    return rounded(found, *DESCRIBED)


@query(
    "describe_null_groups",
    " UNION ALL ".join(
        f"SELECT '{g}' AS attribute, coalesce({g}, 'UNKNOWN') AS group_value, variable, {DESCRIBE_SQL} "
        f"FROM {unpivot_sql(VARIABLES, 'cohort', f'{g},')} GROUP BY {g}, variable"
        for g in ("ethnic", "race")
    ),
)
def describe_null_groups(spark, sf_dir):
    """A group attribute that some rows lack."""
    found = profile.describe_groups(kept_cohort(spark, sf_dir), VARIABLES, ["ethnic", "race"])
    return rounded(found, *DESCRIBED)


@query(
    "describe_by_null_key",
    f"SELECT ethnic, variable, {DESCRIBE_SQL} FROM {unpivot_sql(VARIABLES, 'cohort', 'ethnic,')} GROUP BY ethnic, variable",
)
def describe_by_null_key(spark, sf_dir):
    """Null groups keep their key where the grouping columns are given."""
    return rounded(profile.describe(kept_cohort(spark, sf_dir), VARIABLES, ["ethnic"]), *DESCRIBED)


@query(
    "score_profile_unknown",
    f"SELECT 'race' AS attribute, coalesce(g, 'UNKNOWN') AS group_value, variable, {DESCRIBE_SQL} FROM (SELECT g, 'score' AS variable, "
    f"score AS value FROM (SELECT CASE WHEN key % 3 > 0 THEN race END AS g, score FROM scores)) GROUP BY g, variable",
)
def score_profile_unknown(spark, sf_dir):
    """Scores of persons without a known group are a group of the report."""
    scores = D.scores(spark, sf_dir).withColumn("race", F.when(F.col("key") % 3 > 0, F.col("race")))
    return rounded(profile.describe_groups(scores, ["score"], ["race"]), *DESCRIBED)


@query(
    "score_profile",
    " UNION ALL ".join(
        f"SELECT '{g}' AS attribute, {g} AS group_value, variable, {DESCRIBE_SQL} "
        f"FROM {unpivot_sql(['score'], 'scores', f'{g},')} GROUP BY {g}, variable"
        for g in ("gender", "race")
    ),
)
def score_profile(spark, sf_dir):
    """Scores by group, as the audit reports them."""
    return rounded(profile.describe_groups(D.scores(spark, sf_dir), ["score"], ["gender", "race"]), *DESCRIBED)


NULL_COLUMNS = [
    "person_id", "episode_id", "release_date", "begin_date", "total_components", "felony_components",
    "episode_class", "next_start", "prior_episodes", "label", "follow_up_days", "birth_date", "gender", "race",
    "ethnic", "height", "weight", "age_at_episode", "years_in_stay", "age_at_first",
]


@query(
    "null_summary",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS nulls FROM cohort" for c in NULL_COLUMNS
    ),
)
def null_summary(spark, sf_dir):
    return profile.null_summary(cohort(spark, sf_dir))


def corr_sql(a: str, b: str) -> str:
    x = f"CASE WHEN {b} IS NOT NULL THEN CAST({a} AS DOUBLE) END"
    y = f"CASE WHEN {a} IS NOT NULL THEN CAST({b} AS DOUBLE) END"
    return f"round(covar_samp({x}, {y}) / NULLIF(stddev_samp({x}) * stddev_samp({y}), 0), 6)"


@query(
    "correlation_long",
    " UNION ALL ".join(
        f"SELECT '{a}' AS x, '{b}' AS y, {corr_sql(a, b)} AS r FROM base" for a in VARIABLES for b in VARIABLES
    ).join(["SELECT * FROM (WITH base AS MATERIALIZED (SELECT * FROM cohort) ", ")"]),
)
def correlation_long(spark, sf_dir):
    return rounded(profile.correlation_long(cohort(spark, sf_dir), VARIABLES), "r")


@query(
    "correlation_wide",
    " UNION ALL ".join(
        f"SELECT '{a}' AS x, " + ", ".join(f"{corr_sql(a, b)} AS {b}" for b in VARIABLES) + " FROM base"
        for a in VARIABLES
    ).join(["SELECT * FROM (WITH base AS MATERIALIZED (SELECT * FROM cohort) ", ")"]),
)
def correlation_wide(spark, sf_dir):
    return rounded(profile.correlation_wide(cohort(spark, sf_dir), VARIABLES), *VARIABLES)


RANGE_SQL = f"""(SELECT variable, CASE WHEN min(value) = max(value) THEN min(value) - 0.5 ELSE min(value) END AS lo,
    CASE WHEN min(value) = max(value) THEN max(value) + 0.5 ELSE max(value) END AS hi FROM {{source}} GROUP BY variable)"""


@query(
    "histogram",
    f"""SELECT b.variable, CAST(g.bin AS INTEGER) AS bin, round(b.lo + (b.hi - b.lo) / 10 * g.bin, 6) AS bin_lo,
          round(b.lo + (b.hi - b.lo) / 10 * (g.bin + 1), 6) AS bin_hi, COALESCE(c.count, 0) AS count
        FROM {RANGE_SQL.format(source=unpivot_sql(VARIABLES, 'cohort'))} b
        CROSS JOIN range(10) AS g(bin)
        LEFT JOIN (SELECT v.variable, LEAST(floor((v.value - r.lo) / ((r.hi - r.lo) / 10)), 9) AS bin, count(*) AS count
                   FROM {unpivot_sql(VARIABLES, 'cohort')} v
                   JOIN {RANGE_SQL.format(source=unpivot_sql(VARIABLES, 'cohort'))} r ON v.variable = r.variable
                   GROUP BY ALL) c
          ON b.variable = c.variable AND g.bin = c.bin""",
)
def histogram(spark, sf_dir):
    return rounded(profile.histogram(kept_cohort(spark, sf_dir), VARIABLES), "bin_lo", "bin_hi")


BOX_VARIABLES = VARIABLES
FENCE_SQL = f"""(SELECT variable, quantile_cont(value, 0.25) AS q25, quantile_cont(value, 0.5) AS q50,
    quantile_cont(value, 0.75) AS q75 FROM {unpivot_sql(BOX_VARIABLES, 'cohort')} GROUP BY variable)"""


@query(
    "box_stats",
    f"""SELECT v.variable, round(q25, 6) AS q25, round(q50, 6) AS q50, round(q75, 6) AS q75,
          round(min(CASE WHEN value BETWEEN q25 - 1.5 * (q75 - q25) AND q75 + 1.5 * (q75 - q25) THEN value END), 6)
            AS whisker_low,
          round(max(CASE WHEN value BETWEEN q25 - 1.5 * (q75 - q25) AND q75 + 1.5 * (q75 - q25) THEN value END), 6)
            AS whisker_high,
          count(*) FILTER (value NOT BETWEEN q25 - 1.5 * (q75 - q25) AND q75 + 1.5 * (q75 - q25)) AS fliers
        FROM {unpivot_sql(BOX_VARIABLES, 'cohort')} v JOIN {FENCE_SQL} f ON v.variable = f.variable
        GROUP BY v.variable, q25, q50, q75""",
)
def box_stats(spark, sf_dir):
    return rounded(
        profile.box_stats(kept_cohort(spark, sf_dir), BOX_VARIABLES), "q25", "q50", "q75", "whisker_low", "whisker_high"
    )


PAIR_VARIABLES = ["height", "weight", "age_at_episode"]
PAIR_BIN = "CAST(LEAST(floor(({v} - lo_{v}) / ((hi_{v} - lo_{v}) / 10)), 9) AS INTEGER)"


@query(
    "pair_density",
    "SELECT * FROM (WITH base AS MATERIALIZED (SELECT height, weight, age_at_episode FROM cohort "
    "WHERE height IS NOT NULL AND weight IS NOT NULL AND age_at_episode IS NOT NULL), "
    "ends AS (SELECT "
    + ", ".join(f"min({v}) AS lo_{v}, max({v}) AS hi_{v}" for v in PAIR_VARIABLES)
    + " FROM base), binned AS (SELECT "
    + ", ".join(f"{PAIR_BIN.format(v=v)} AS {v}" for v in PAIR_VARIABLES)
    + " FROM base, ends) "
    + " UNION ALL ".join(
        f"SELECT '{a}' AS x, '{b}' AS y, {a} AS x_bin, {b} AS y_bin, count(*) AS count FROM binned GROUP BY ALL"
        for a, b in combinations(PAIR_VARIABLES, 2)
    )
    + ")",
)
def pair_density(spark, sf_dir):
    return profile.pair_density(cut_lineage(plain_cohort(spark, sf_dir).select(*PAIR_VARIABLES)), PAIR_VARIABLES)


@query(
    "crosstab_counts",
    " UNION ALL ".join(
        f"SELECT '{a}' AS attribute, {a} AS value, '{o}' AS outcome, {o} AS outcome_value, count(*) AS count "
        f"FROM flagged GROUP BY {a}, {o}"
        for a in ("race", "gender")
        for o in ("predicted", "label")
    ),
)
def crosstab_counts(spark, sf_dir):
    flagged = ranking.flag_top_share(D.scores(spark, sf_dir), [], 5.0)
    return profile.crosstab_counts(flagged, ["race", "gender"], ["predicted", "label"])


OUTLIER_VARIABLES = ["total_components", "years_in_stay"]


@query(
    "iqr_outliers",
    f"""SELECT person_id, episode_id, total_components, round(years_in_stay, 6) AS years_in_stay FROM cohort c,
          (SELECT quantile_cont(total_components, 0.25) AS a1, quantile_cont(total_components, 0.75) AS a3,
                  quantile_cont(years_in_stay, 0.25) AS b1, quantile_cont(years_in_stay, 0.75) AS b3 FROM cohort) q
        WHERE total_components < a1 - 1.5 * (a3 - a1) OR total_components > a3 + 1.5 * (a3 - a1)
           OR years_in_stay < b1 - 1.5 * (b3 - b1) OR years_in_stay > b3 + 1.5 * (b3 - b1)""",
)
def iqr_outliers(spark, sf_dir):
    kept = cut_lineage(plain_cohort(spark, sf_dir).select("person_id", "episode_id", *OUTLIER_VARIABLES))
    found = profile.iqr_outliers(kept, OUTLIER_VARIABLES)
    return rounded(found.select("person_id", "episode_id", *OUTLIER_VARIABLES), "years_in_stay")


@query("next_episode", "SELECT person_id, episode_id, release_date, next_start FROM history")
def next_episode(spark, sf_dir):
    return episodes.add_history(study_episodes(spark, sf_dir), STUDY).select(
        "person_id", "episode_id", "release_date", "next_start"
    )


@query(
    "return_label",
    "SELECT person_id, episode_id, episode_class, next_start, label, follow_up_days FROM labelled",
)
def return_label(spark, sf_dir):
    return labelled(spark, sf_dir).select(
        "person_id", "episode_id", "episode_class", "next_start", "label", "follow_up_days"
    )


@query("prior_count", "SELECT person_id, episode_id, prior_episodes FROM history")
def prior_count(spark, sf_dir):
    return labelled(spark, sf_dir).select("person_id", "episode_id", "prior_episodes")


@query(
    "score_order",
    "SELECT key, label, score, row_number() OVER (ORDER BY score DESC, key) - 1 AS position FROM scores",
)
def score_order(spark, sf_dir):
    return ranking.rank_by_score(D.scores(spark, sf_dir).select("key", "label", "score"), [])


@query(
    "topk_position",
    """SELECT race, key, score,
         CASE WHEN row_number() OVER (PARTITION BY race ORDER BY score DESC, key) - 1
                   < floor(count(*) OVER (PARTITION BY race) * CAST(0.05 AS DOUBLE)) THEN 1 ELSE 0 END AS predicted
       FROM scores""",
)
def topk_position(spark, sf_dir):
    return ranking.flag_top_positions(D.scores(spark, sf_dir), ["race"], 5.0).select(
        "race", "key", "score", "predicted"
    )


@query("topk_quantile", "SELECT key, score, label, predicted FROM flagged")
def topk_quantile(spark, sf_dir):
    return ranking.flag_top_share(D.scores(spark, sf_dir), [], 5.0).select("key", "score", "label", "predicted")


@query(
    "duplicate_scores",
    """SELECT key, score FROM (SELECT key, score, row_number() OVER (PARTITION BY score ORDER BY key) AS i FROM scores)
       WHERE i > 1""",
)
def duplicate_scores(spark, sf_dir):
    return ranking.repeated_scores(D.scores(spark, sf_dir).select("key", "score"))


@query(
    "results_union",
    """SELECT 'all' AS grouping, 'all' AS value, count(*) AS n, round(avg(label), 6) AS base_rate FROM scores
       UNION ALL SELECT 'race', race, count(*), round(avg(label), 6) FROM scores GROUP BY race
       UNION ALL SELECT 'gender', gender, count(*), round(avg(label), 6) FROM scores GROUP BY gender""",
)
def results_union(spark, sf_dir):
    scores = D.scores(spark, sf_dir)
    rate = [F.count("*").alias("n"), F.round(F.avg("label"), 6).alias("base_rate")]
    parts = [scores.agg(*rate).select(F.lit("all").alias("grouping"), F.lit("all").alias("value"), "n", "base_rate")]
    for c in ("race", "gender"):
        parts.append(
            scores.groupBy(c).agg(*rate).select(F.lit(c).alias("grouping"), F.col(c).alias("value"), "n", "base_rate")
        )
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("distinct_keys", "SELECT DISTINCT person_id FROM episode WHERE felony_components > 0")
def distinct_keys(spark, sf_dir):
    return (
        episodes.collapse_episodes(merged(spark, sf_dir), STUDY)
        .filter("felony_components > 0").select("person_id").distinct()
    )
