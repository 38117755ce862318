"""Hand-made fixtures for the rules of episodes, history, labels and ids."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from episodica.config import Study
from episodica.functions import columns as C
from episodica.operators import episodes as E
from episodica.plans.cohort import add_person_features, build_cohort
from episodica.sources import tables as S

STUDY = Study(begin=date(2007, 1, 1), end=date(2018, 1, 1), horizon_days=365)
COMPONENT = "person_id bigint, episode_id string, component_no int, severity string, begin_date date, is_felony int"
STAY = "person_id bigint, episode_id string, component_no int, release_date date"
EPISODE = (
    "person_id bigint, episode_id string, release_date date, begin_date date, "
    "total_components bigint, felony_components bigint, episode_class string"
)
NO_RETURN = date(2080, 1, 1)


def d(y, m=1, day=1):
    return date(y, m, day)


def history(spark, rows, study=STUDY):
    filled = [(p, e, r, b, 1, int(c == "FELON"), c) for p, e, r, b, c in rows]
    out = E.add_return_label(E.add_history(spark.createDataFrame(filled, EPISODE), study), study)
    return {r["episode_id"]: r for r in out.collect()}


def test_only_misdemeanors_drop_out(spark):
    rows = [(1, "a", 1, "MISD", d(2008), 0), (2, "b", 1, "MISD", d(2008), 0), (2, "c", 1, "FELON", d(2009), 1)]
    kept = E.keep_persons_with_felony(spark.createDataFrame(rows, COMPONENT)).collect()
    assert sorted(r["episode_id"] for r in kept) == ["b", "c"]


def test_right_join_keeps_stays_and_collapse_drops_them(spark):
    components = spark.createDataFrame([(1, "a", 1, "FELON", d(2008), 1), (1, "z", 1, "FELON", d(2008), 1)], COMPONENT)
    stays = spark.createDataFrame([(1, "a", 1, d(2009)), (9, "q", 1, d(2009))], STAY)
    merged = E.join_components_to_stays(components, stays)
    assert {(r["person_id"], r["stay_person_id"]) for r in merged.collect()} == {(1, 1), (None, 9)}
    assert [r["episode_id"] for r in E.collapse_episodes(merged, STUDY).collect()] == ["a"]


def test_repeated_keys_fan_out(spark):
    components = spark.createDataFrame([(1, "a", 1, "FELON", d(2008), 1)] * 2, COMPONENT)
    stays = spark.createDataFrame([(1, "a", 1, d(2009))] * 3, STAY)
    merged = E.join_components_to_stays(components, stays)
    assert merged.count() == 6
    row = E.collapse_episodes(merged, STUDY).first()
    assert (row["total_components"], row["felony_components"], row["episode_class"]) == (6, 6, "FELON")


def test_window_bounds_are_strict(spark):
    rows = [(1, "a", 1, d(2007)), (1, "b", 1, d(2007, 1, 2)), (1, "c", 1, None)]
    kept = E.released_after(spark.createDataFrame(rows, STAY), STUDY.begin).collect()
    assert [r["episode_id"] for r in kept] == ["b"]


def test_history_follows_release_order(spark):
    got = history(
        spark,
        [(1, "a", d(2012), d(2008), "FELON"), (1, "b", d(2010), d(2009), "FELON"), (2, "x", d(2010), d(2009), "FELON")],
    )
    assert got["b"]["next_start"] == d(2008) and got["b"]["prior_episodes"] == 0
    assert got["b"]["label"] == 1  # negative gap
    assert got["a"]["next_start"] == NO_RETURN and got["a"]["prior_episodes"] == 1
    assert got["x"]["next_start"] == NO_RETURN and got["x"]["label"] == 0


def test_begin_order_and_negative_gap_switch(spark):
    rows = [(1, "a", d(2012), d(2008), "FELON"), (1, "b", d(2010), d(2009), "FELON")]
    by_begin = history(spark, rows, Study(history_order="begin_date"))
    assert by_begin["a"]["next_start"] == d(2009)
    assert history(spark, rows, Study(allow_negative_gap=False))["b"]["label"] == 0


def test_ties_follow_the_episode_id(spark):
    got = history(spark, [(1, "b", d(2010), d(2008), "FELON"), (1, "a", d(2010), d(2009), "FELON")])
    assert (got["a"]["prior_episodes"], got["b"]["prior_episodes"]) == (0, 1)
    assert got["a"]["next_start"] == d(2008)


def test_horizon_is_strict(spark):
    exact = history(spark, [(1, "a", d(2010), d(2009), "FELON"), (1, "b", d(2012), d(2011), "FELON")])
    assert exact["a"]["label"] == 0  # 365 days
    closer = history(spark, [(1, "a", d(2010), d(2009), "FELON"), (1, "b", d(2012), d(2010, 12, 31), "FELON")])
    assert closer["a"]["label"] == 1  # 364 days


def test_misdemeanor_between_felonies(spark):
    got = history(
        spark,
        [(1, "a", d(2010), d(2009), "FELON"), (1, "m", d(2011), d(2010, 6), "MISD"), (1, "z", d(2013), d(2012), "FELON")],
    )
    assert got["a"]["next_start"] == d(2010, 6) and got["a"]["label"] == 1
    assert got["m"]["next_start"] == NO_RETURN
    assert got["z"]["prior_episodes"] == 2


def test_age_at_first_uses_all_episodes(spark):
    rows = [(1, "a", d(2012), d(2010), 1, 1, "FELON"), (1, "m", d(2009), d(2008), 1, 0, "MISD"), (3, "u", d(2010), d(2009), 1, 1, "FELON")]
    people = spark.createDataFrame([(1, d(1990), "MALE")], "person_id bigint, birth_date date, gender string")
    got = {r["episode_id"]: r for r in add_person_features(spark.createDataFrame(rows, EPISODE), people, STUDY).collect()}
    first = (d(2008) - d(1990)).days / 365
    assert got["a"]["age_at_first"] == pytest.approx(first) == got["m"]["age_at_first"]
    assert got["u"]["gender"] is None and got["u"]["age_at_first"] is None
    assert got["a"]["years_in_stay"] == pytest.approx(730 / 365)


def test_cohort_keeps_felonies_after_history(spark):
    components = spark.createDataFrame([(1, "a", 1, "FELON", d(2008), 1), (1, "b", 1, "MISD", d(2009), 0)], COMPONENT)
    stays = spark.createDataFrame([(1, "a", 1, d(2008, 9)), (1, "b", 1, d(2010))], STAY)
    people = spark.createDataFrame([(1, d(1990), "MALE")], "person_id bigint, birth_date date, gender string")
    rows = build_cohort(components, stays, people, STUDY).collect()
    assert [(r["episode_id"], r["label"], r["next_start"]) for r in rows] == [("a", 1, d(2009))]


def test_dates_and_ids(spark):
    text = spark.createDataFrame([("2000-02-29",), ("2000-02-30",), ("2300-01-01",), ("x",), (None,)], "t string")
    assert [r[0] for r in text.select(C.parse_date_lenient(F.col("t"))).collect()] == [d(2000, 2, 29)] + [None] * 4
    with pytest.raises(Exception):
        text.select(C.parse_date_strict(F.col("t"))).collect()
    ids = spark.createDataFrame([("T12",), ("0012",), ("T9",)], "t string")
    assert [r[0] for r in ids.select(C.person_key(F.col("t"), {"T9": "-999"})).collect()] == [12, 12, -999]


def test_release_imputation(spark):
    rows = [(None, d(2010)), (None, None), (d(2009), d(2010))]
    got = S.add_release_date(spark.createDataFrame(rows, "actual_end date, projected_end date")).collect()
    assert [(r["release_date"], r["release_imputed"]) for r in got] == [(d(2010), 1), (None, 0), (d(2009), 0)]


def test_readers(spark, tmp_path):
    assert S.read_if_present(spark, str(tmp_path / "none.csv")) is None
    (tmp_path / "y.csv").write_text("0,1\n1,0\n")
    rows = S.read_headerless(spark, str(tmp_path / "y.csv"), ["key", "label"], ["bigint", "int"]).collect()
    assert [tuple(r) for r in rows] == [(0, 1), (1, 0)]
    with pytest.raises(ValueError):
        S.drop_columns(spark.range(1), ["gone"])
    with pytest.raises(ValueError):
        S.read_text_csv(spark, str(tmp_path / "y.csv"), {"MISSING": "m"})
