"""From CSV files to cohort, report and label: the same result as from typed tables."""

import os

from pyspark.sql import functions as F

from episodica.checks import tables as Q
from episodica.plans.cohort import build_cohort
from episodica.plans.exploration import explore, write_report
from episodica.sources import driver_tables as D
from episodica.sources import tables as S

SF_DIR = "/root/testdata/sf0.001"


def test_csv_files_give_the_same_cohort(spark, tmp_path):
    text = Q.text_component(spark, SF_DIR).withColumn("begin_date", F.lit(None).cast("string"))
    dates = D.component(spark, SF_DIR).select(
        F.col("episode_id").cast("string").alias("episode_id"), F.col("begin_date").cast("string").alias("_d")
    ).distinct()
    dated = text.join(dates, "episode_id").withColumn("begin_date", F.col("_d")).drop("_d")
    stays = D.stay(spark, SF_DIR).withColumn("stay_begin", F.lit(None).cast("date"))
    people = D.person(spark, SF_DIR)
    absent = {c: F.lit(None).cast("string") for c in S.PERSON_COLUMNS.values() if c not in people.columns}
    cohort = build_cohort(
        S.read_components(spark, Q.write_source_csv(spark, dated, S.COMPONENT_COLUMNS)),
        S.read_stays(spark, Q.write_source_csv(spark, stays, S.STAY_COLUMNS)),
        S.read_persons(spark, Q.write_source_csv(spark, people.withColumns(absent), S.PERSON_COLUMNS)),
        Q.STUDY,
    )
    # Ids are text here, so ties in the release date may be ordered differently.
    columns = ["person_id", "episode_id", "release_date", "felony_components", "race", "age_at_first"]
    got = {tuple(r) for r in cohort.select(*columns).collect()}
    typed = Q.cohort(spark, SF_DIR).withColumn("episode_id", F.col("episode_id").cast("string"))
    assert got == {tuple(r) for r in typed.select(*columns).collect()}

    report = explore(cohort)
    folder = str(tmp_path / "report")
    write_report(report, folder)
    assert set(os.listdir(folder)) == set(report)
    shares = spark.read.csv(f"{folder}/share_race", header=True, inferSchema=True)
    assert shares.agg(F.sum("count")).first()[0] == cohort.count()


def test_recoded_ids_meet_in_all_three_files(spark):
    component, stay, person = (
        spark.createDataFrame([row], ", ".join(f"{c} string" for c in columns))
        for row, columns in (
            (("T1", "a", "1", "FELON", "2000-01-02"), ("person_id", "episode_id", "component_no", "severity", "begin_date")),
            (("T1", "a", "1", "2000-05-01", None), ("person_id", "episode_id", "component_no", "actual_end", "projected_end")),
            (("T1", "1970-01-01", "MALE", "X", "Y", "70", "160"), ("person_id", "birth_date", "gender", "race", "ethnic", "height", "weight")),
        )
    )
    recode = {"T1": "-999"}
    tables = S.clean_components(component, id_recode=recode), S.clean_stays(stay, recode), S.clean_persons(person, recode)
    assert [t.first()["person_id"] for t in tables] == [-999] * 3
    assert build_cohort(*tables, Q.STUDY, history=False).count() == 1
