"""Queries for scans, sinks, columns, filters and joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from episodica.checks.registry import query, r6, rounded
from episodica.functions import columns as C
from episodica.operators import encoding, episodes, ranking, splits
from episodica.plans import cohort as plans
from episodica.session import cut_lineage, scratch_path
from episodica.sources import driver_tables as D
from episodica.sources import tables as S

STUDY = D.DRIVER_STUDY
EPISODE_COLUMNS = (
    "person_id, episode_id, release_date, begin_date, total_components, felony_components, episode_class"
)


def merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return episodes.join_components_to_stays(D.component(spark, sf_dir), D.stay(spark, sf_dir))


def study_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return episodes.begun_before(episodes.collapse_episodes(merged(spark, sf_dir), STUDY), STUDY.end)


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.labelled_episodes(D.component(spark, sf_dir), D.stay(spark, sf_dir), STUDY)


def cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.build_cohort(
        D.component(spark, sf_dir), D.stay(spark, sf_dir), D.person(spark, sf_dir), STUDY
    )


def plain_cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cohort without history, for queries that do not read it."""
    return plans.build_cohort(
        D.component(spark, sf_dir), D.stay(spark, sf_dir), D.person(spark, sf_dir), STUDY, history=False
    )


def kept_cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cohort, materialised for queries that pass over it more than once."""
    return cut_lineage(cohort(spark, sf_dir))


# Text versions of the source tables, with the defects real files have.
ID_TEXT = "CASE WHEN person_id % 50 = 0 THEN concat('T', person_id) ELSE lpad(CAST(person_id AS {text}), 9, '0') END"
DATE_TEXT = (
    "CASE WHEN component_no = 7 AND episode_id % 5 = 0 THEN '2000-02-30' "
    "WHEN component_no = 6 AND episode_id % 5 = 0 THEN '2300-01-01' ELSE CAST(begin_date AS {text}) END"
)
MONEY_TEXT = "CAST(CAST({column} AS DECIMAL(10, 2)) AS {text})"


def text_component(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.component(spark, sf_dir).select(
        F.expr(ID_TEXT.format(text="STRING")).alias("person_id"),
        F.col("episode_id").cast("string").alias("episode_id"),
        F.col("component_no").cast("string").alias("component_no"),
        "severity",
        F.expr(DATE_TEXT.format(text="STRING")).alias("begin_date"),
        "county_code",
        F.lit(None).cast("string").alias("punishment_code"),
        F.lit(None).cast("string").alias("disposition_code"),
        "offense_code",
        F.lit(None).cast("string").alias("court_code"),
        F.lit(None).cast("string").alias("penalty_code"),
    )


def write_source_csv(spark: SparkSession, df: DataFrame, columns: dict[str, str]) -> str:
    """Write a text table under the header names of the source files."""
    path = scratch_path(spark, "source.csv")
    renamed = df.select([F.col(short).alias(name) for name, short in columns.items()])
    S.write_table(renamed, path, "csv")
    return path


@query(
    "scan_typed",
    """SELECT person_id, CAST(episode_id AS VARCHAR) AS episode_id, component_no, severity,
         CASE WHEN episode_id % 5 = 0 AND component_no IN (6, 7) THEN NULL ELSE begin_date END AS begin_date,
         county_code, offense_code, is_felony
       FROM component WHERE person_id IN (SELECT person_id FROM component WHERE is_felony = 1)""",
)
def scan_typed(spark, sf_dir):
    path = write_source_csv(spark, text_component(spark, sf_dir), S.COMPONENT_COLUMNS)
    return S.drop_columns(
        S.read_components(spark, path), ["punishment_code", "disposition_code", "court_code", "penalty_code"]
    )


@query(
    "scan_stay",
    """SELECT person_id, CAST(episode_id AS VARCHAR) AS episode_id, component_no, actual_end, projected_end,
         CAST(NULL AS DATE) AS stay_begin, COALESCE(actual_end, projected_end) AS release_date,
         CASE WHEN projected_end IS NOT NULL AND actual_end IS NULL THEN 1 ELSE 0 END AS release_imputed
       FROM stay_rows""",
)
def scan_stay(spark, sf_dir):
    rows = D.stay_rows(spark, sf_dir).withColumn("stay_begin", F.lit(None).cast("date"))
    path = write_source_csv(spark, rows, S.STAY_COLUMNS)
    return S.read_stays(spark, path)


@query(
    "scan_person",
    "SELECT person_id, birth_date, gender, race, ethnic, height, weight FROM person",
)
def scan_person(spark, sf_dir):
    people = D.person(spark, sf_dir)
    absent = {c: F.lit(None).cast("string") for c in S.PERSON_COLUMNS.values() if c not in people.columns}
    text = people.withColumns(absent).withColumn("person_id", F.expr(ID_TEXT.format(text="STRING")))
    path = write_source_csv(spark, text, S.PERSON_COLUMNS)
    return S.drop_columns(S.read_persons(spark, path), list(absent))


def recoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three source files, written whole and read with one id recoded, joined."""
    people = D.person(spark, sf_dir)
    absent = {c: F.lit(None).cast("string") for c in S.PERSON_COLUMNS.values() if c not in people.columns}
    stays = D.stay(spark, sf_dir).withColumn("stay_begin", F.lit(None).cast("date"))
    code = F.expr(ID_TEXT.format(text="STRING"))
    rules = {"id_recode": {"T50": "-999"}}
    components = S.read_components(
        spark, write_source_csv(spark, text_component(spark, sf_dir), S.COMPONENT_COLUMNS), **rules
    )
    held = S.read_stays(spark, write_source_csv(spark, stays.withColumn("person_id", code), S.STAY_COLUMNS), **rules)
    persons = S.read_persons(
        spark, write_source_csv(spark, people.withColumns(absent).withColumn("person_id", code), S.PERSON_COLUMNS), **rules
    )
    return (
        components.join(held, ["person_id", "episode_id", "component_no"])
        .join(persons, "person_id")
        .select("person_id", "episode_id", "component_no", "release_date", "birth_date")
    )


@query(
    "recoded_join_whole",
    """SELECT CASE WHEN c.person_id = 50 THEN -999 ELSE c.person_id END AS person_id,
         CAST(c.episode_id AS VARCHAR) AS episode_id, c.component_no, s.release_date, p.birth_date
       FROM component c JOIN stay s ON c.person_id = s.person_id AND c.episode_id = s.episode_id
        AND c.component_no = s.component_no JOIN person p ON c.person_id = p.person_id
       WHERE c.person_id IN (SELECT person_id FROM component WHERE is_felony = 1)""",
)
def recoded_join_whole(spark, sf_dir):
    """An id recoded by the readers of all three files still meets itself, and all other ids do."""
    return recoded(spark, sf_dir)


@query("sink_roundtrip", "SELECT key, label, score, race, gender FROM scores")
def sink_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "scores")
    S.write_table(D.scores(spark, sf_dir), path, "csv", ["gender"])
    schema = "key bigint, label int, score double, race string, gender string"
    return spark.read.schema(schema).csv(path, header=True)


@query(
    "ranked_list",
    """SELECT row_number() OVER (ORDER BY score DESC, key) AS rank, score AS probability, key AS id
       FROM scores""",
)
def ranked_list(spark, sf_dir):
    return ranking.ranked_list(D.scores(spark, sf_dir))


@query(
    "project_drop",
    "SELECT person_id, episode_id, component_no, severity, begin_date, is_felony FROM component",
)
def project_drop(spark, sf_dir):
    return S.drop_columns(D.component(spark, sf_dir), ["offense_code", "county_code"])


@query(
    "flag_severity",
    """SELECT person_id, episode_id, component_no, offense_code,
         CASE WHEN offense_code = 'PROMO' THEN 1 ELSE 0 END AS is_promo,
         CASE WHEN severity = 'FELON' THEN 1 ELSE 0 END AS is_felony
       FROM component""",
)
def flag_severity(spark, sf_dir):
    return D.component(spark, sf_dir).select(
        "person_id",
        "episode_id",
        "component_no",
        "offense_code",
        C.flag_equal(F.col("offense_code"), "PROMO").alias("is_promo"),
        C.flag_equal(F.col("severity"), "FELON").alias("is_felony"),
    )


@query(
    "parse_date_lenient",
    f"""SELECT person_id, episode_id, component_no, begin_text,
          CASE WHEN TRY_CAST(begin_text AS DATE) BETWEEN DATE '1677-09-22' AND DATE '2262-04-11'
               THEN TRY_CAST(begin_text AS DATE) END AS begin_date
        FROM (SELECT person_id, episode_id, component_no, {DATE_TEXT.format(text="VARCHAR")} AS begin_text
              FROM component)""",
)
def parse_date_lenient(spark, sf_dir):
    text = F.expr(DATE_TEXT.format(text="STRING"))
    return D.component(spark, sf_dir).select(
        "person_id", "episode_id", "component_no", text.alias("begin_text")
    ).withColumn("begin_date", C.parse_date_lenient(F.col("begin_text")))


@query(
    "parse_date_strict",
    """SELECT person_id, CAST(birth_text AS DATE) AS birth_date
       FROM (SELECT person_id, CAST(birth_date AS VARCHAR) AS birth_text FROM person)""",
)
def parse_date_strict(spark, sf_dir):
    text = D.person(spark, sf_dir).select("person_id", F.col("birth_date").cast("string").alias("birth_text"))
    return text.select("person_id", C.parse_date_strict(F.col("birth_text")).alias("birth_date"))


@query(
    "recode_sentinel",
    f"""SELECT id_text, CAST(replace(CASE WHEN id_text = 'T100' THEN '-999' ELSE id_text END, 'T', '') AS BIGINT)
          AS person_id
        FROM (SELECT {ID_TEXT.format(text="VARCHAR")} AS id_text FROM person)""",
)
def recode_sentinel(spark, sf_dir):
    ids = D.person(spark, sf_dir).select(F.expr(ID_TEXT.format(text="STRING")).alias("id_text"))
    return ids.withColumn("person_id", C.person_key(F.col("id_text"), {"T100": "-999"}))


@query(
    "cast_numeric",
    f"""SELECT person_id, CAST(height_text AS DOUBLE) AS height, TRY_CAST(id_text AS BIGINT) AS plain_id
        FROM (SELECT person_id, {MONEY_TEXT.format(column="height", text="VARCHAR")} AS height_text,
                     {ID_TEXT.format(text="VARCHAR")} AS id_text FROM person)""",
)
def cast_numeric(spark, sf_dir):
    text = D.person(spark, sf_dir).select(
        "person_id",
        F.expr(MONEY_TEXT.format(column="height", text="STRING")).alias("height_text"),
        F.expr(ID_TEXT.format(text="STRING")).alias("id_text"),
    )
    return text.select(
        "person_id",
        F.col("height_text").cast("double").alias("height"),
        F.col("id_text").try_cast("bigint").alias("plain_id"),
    )


@query(
    "strip_literal",
    f"SELECT id_text, replace(id_text, 'T', '') AS digits FROM (SELECT {ID_TEXT.format(text='VARCHAR')} AS id_text FROM person)",
)
def strip_literal(spark, sf_dir):
    ids = D.person(spark, sf_dir).select(F.expr(ID_TEXT.format(text="STRING")).alias("id_text"))
    return ids.withColumn("digits", C.strip_literal(F.col("id_text"), "T"))


@query(
    "impute_end_date",
    """SELECT person_id, episode_id, component_no, actual_end, projected_end,
         COALESCE(actual_end, projected_end) AS release_date,
         CASE WHEN projected_end IS NOT NULL AND actual_end IS NULL THEN 1 ELSE 0 END AS release_imputed
       FROM stay_rows""",
)
def impute_end_date(spark, sf_dir):
    return S.add_release_date(D.stay_rows(spark, sf_dir))


@query(
    "elapsed_years",
    """SELECT person_id, episode_id,
         round((release_date - begin_date) / CAST(365 AS DOUBLE), 6) AS years_in_stay FROM episode""",
)
def elapsed_years(spark, sf_dir):
    rows = episodes.collapse_episodes(merged(spark, sf_dir), STUDY)
    years = C.years_between(F.col("release_date"), F.col("begin_date"))
    return rounded(rows.select("person_id", "episode_id", years.alias("years_in_stay")), "years_in_stay")


@query(
    "filter_window",
    """SELECT person_id, episode_id, component_no, begin_date, release_date FROM merged
       WHERE release_date > DATE '1996-01-01' AND begin_date < DATE '2001-01-01'""",
)
def filter_window(spark, sf_dir):
    rows = episodes.begun_before(episodes.released_after(merged(spark, sf_dir), STUDY.begin), STUDY.end)
    return rows.select("person_id", "episode_id", "component_no", "begin_date", "release_date")


COHORT_COLUMNS = [
    "person_id", "episode_id", "release_date", "begin_date", "total_components", "felony_components",
    "prior_episodes", "next_start", "label", "follow_up_days", "gender", "race", "ethnic", "height", "weight",
    "age_at_first", "age_at_episode", "years_in_stay",
]
AGES = ("age_at_first", "age_at_episode", "years_in_stay")


@query(
    "cohort_final",
    f"SELECT {', '.join(c for c in COHORT_COLUMNS if c not in AGES)}, {r6(*AGES)} FROM cohort",
)
def cohort_final(spark, sf_dir):
    return rounded(cohort(spark, sf_dir).select(*COHORT_COLUMNS), *AGES)


@query("temporal_split", "SELECT person_id, episode_id, release_date, label, split_id, side FROM split_rows")
def temporal_split(spark, sf_dir):
    return splits.temporal_split(cohort(spark, sf_dir), "release_date", STUDY.splits).select(
        "person_id", "episode_id", "release_date", "label", "split_id", "side"
    )


@query(
    "semi_any_felony",
    """SELECT person_id, episode_id, component_no, severity FROM component
       WHERE person_id IN (SELECT person_id FROM component WHERE is_felony = 1)""",
)
def semi_any_felony(spark, sf_dir):
    return episodes.keep_persons_with_felony(D.component(spark, sf_dir)).select(
        "person_id", "episode_id", "component_no", "severity"
    )


@query(
    "join_component_stay",
    """SELECT c.person_id, c.episode_id, c.component_no, c.severity, s.person_id AS stay_person_id,
         s.actual_end, s.projected_end
       FROM component c RIGHT JOIN stay_rows s ON c.person_id = s.person_id
        AND c.episode_id = s.episode_id AND c.component_no = s.component_no""",
)
def join_component_stay(spark, sf_dir):
    both = episodes.join_components_to_stays(D.component(spark, sf_dir), D.stay_rows(spark, sf_dir))
    return both.select(
        "person_id", "episode_id", "component_no", "severity", "stay_person_id", "actual_end", "projected_end"
    )


@query(
    "join_full_outer",
    """SELECT COALESCE(a.person_id, b.person_id) AS person_id, COALESCE(a.episode_id, b.episode_id) AS episode_id,
         a.release_date, b.felonies
       FROM (SELECT person_id, episode_id, max(COALESCE(actual_end, projected_end)) AS release_date FROM stay_rows
             WHERE actual_end IS NOT NULL GROUP BY ALL) a
       FULL JOIN (SELECT person_id, episode_id, count(*) AS felonies FROM component
                  WHERE is_felony = 1 GROUP BY ALL) b
         ON a.person_id = b.person_id AND a.episode_id = b.episode_id""",
)
def join_full_outer(spark, sf_dir):
    ended = S.add_release_date(D.stay_rows(spark, sf_dir)).filter("actual_end IS NOT NULL")
    dates = ended.groupBy(*encoding.EPISODE).agg(F.max("release_date").alias("release_date"))
    felonies = (
        D.component(spark, sf_dir).filter("is_felony = 1").groupBy(*encoding.EPISODE)
        .agg(F.count("*").alias("felonies"))
    )
    return dates.join(felonies, encoding.EPISODE, "full")


@query(
    "join_demographics",
    f"""SELECT e.*, p.birth_date, p.gender, p.race, p.ethnic, p.height, p.weight
        FROM (SELECT {EPISODE_COLUMNS} FROM study_episode) e LEFT JOIN person p ON e.person_id = p.person_id""",
)
def join_demographics(spark, sf_dir):
    return study_episodes(spark, sf_dir).join(D.person(spark, sf_dir), "person_id", "left")


@query(
    "age_first_episode",
    "SELECT person_id, episode_id, round(age_at_first, 6) AS age_at_first FROM aged",
)
def age_first_episode(spark, sf_dir):
    complete = plans.add_person_features(study_episodes(spark, sf_dir), D.person(spark, sf_dir), STUDY)
    return rounded(complete.select("person_id", "episode_id", "age_at_first"), "age_at_first")


@query(
    "semi_cohort",
    """SELECT person_id, episode_id, component_no, offense_code FROM component
       WHERE person_id IN (SELECT person_id FROM episode WHERE felony_components > 3)""",
)
def semi_cohort(spark, sf_dir):
    severe = episodes.collapse_episodes(merged(spark, sf_dir), STUDY).filter("felony_components > 3")
    return episodes.keep_persons_of(D.component(spark, sf_dir), severe).select(
        "person_id", "episode_id", "component_no", "offense_code"
    )


OFFENSES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
COUNT_SQL = ", ".join(f"count(*) FILTER (offense_code = '{o}') AS offense_code_{o}" for o in OFFENSES)
# The nations' keys.
COUNTIES = tuple(str(i) for i in range(25))
CODE_LISTS = {"offense_code": OFFENSES, "county_code": COUNTIES}
CODES = [(c, v) for c, values in CODE_LISTS.items() for v in values]
ALL_COUNT_SQL = ", ".join(f"count(*) FILTER ({c} = '{v}') AS {c}_{v}" for c, v in CODES)
ZERO_SQL = ", ".join(f"COALESCE(b.{c}_{v}, 0) AS {c}_{v}" for c, v in CODES)


@query(
    "select_by_prefix",
    f"SELECT person_id, episode_id, {COUNT_SQL} FROM component GROUP BY person_id, episode_id",
)
def select_by_prefix(spark, sf_dir):
    source, columns = D.component(spark, sf_dir), ["offense_code", "county_code"]
    codes = encoding.code_lists(encoding.observed_codes(source, columns), columns)
    return S.select_by_prefix(encoding.count_block_wide(source, codes), "offense_code_", keep=encoding.EPISODE)


@query(
    "join_count_blocks",
    f"""SELECT e.person_id, e.episode_id, {ZERO_SQL} FROM study_episode e LEFT JOIN
        (SELECT person_id, episode_id, {ALL_COUNT_SQL} FROM component GROUP BY person_id, episode_id) b
        ON e.person_id = b.person_id AND e.episode_id = b.episode_id""",
)
def join_count_blocks(spark, sf_dir):
    base = study_episodes(spark, sf_dir).select(*encoding.EPISODE)
    return encoding.add_code_counts(base, D.component(spark, sf_dir), CODE_LISTS)


@query(
    "join_scores",
    """SELECT s.key, s.score, s.label, c.label AS returned, c.race, c.gender
       FROM scores s JOIN cohort c ON s.key = c.episode_id""",
)
def join_scores(spark, sf_dir):
    known = cohort(spark, sf_dir).select(
        F.col("episode_id").alias("key"), F.col("label").alias("returned"), "race", "gender"
    )
    return D.scores(spark, sf_dir).select("key", "score", "label").join(known, "key")
