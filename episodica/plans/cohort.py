"""From the three source tables to the labelled cohort."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from episodica.config import Study
from episodica.functions import columns as C
from episodica.operators import episodes as E


def window_episodes(components: DataFrame, stays: DataFrame, study: Study) -> DataFrame:
    """Episodes of the study window."""
    merged = E.join_components_to_stays(components, stays)
    return E.begun_before(E.collapse_episodes(merged, study), study.end)


def labelled_episodes(components: DataFrame, stays: DataFrame, study: Study) -> DataFrame:
    """Episodes of the study window with history and label."""
    return E.add_return_label(E.add_history(window_episodes(components, stays, study), study), study)


def add_person_features(episodes: DataFrame, persons: DataFrame, study: Study) -> DataFrame:
    """Left join of the person table plus ages and time served.

    The age at the first episode is aggregated per person before the join, so
    that episodes are shuffled by person once and AQE can split a hot person.
    """
    firsts = episodes.groupBy("person_id").agg(F.min("begin_date").alias("_first"))
    births = persons.groupBy("person_id").agg(F.max("birth_date").alias("_birth"))
    youngest = firsts.join(births, "person_id").select(
        "person_id",
        C.years_between(F.col("_first"), F.col("_birth"), study.days_per_year).alias("age_at_first"),
    )
    known = persons.join(youngest, "person_id", "left")
    return episodes.join(known, "person_id", "left").withColumns(
        {
            "age_at_episode": C.years_between(
                F.col("begin_date"), F.col("birth_date"), study.days_per_year
            ),
            "years_in_stay": C.years_between(
                F.col("release_date"), F.col("begin_date"), study.days_per_year
            ),
        }
    )


def build_cohort(
    components: DataFrame, stays: DataFrame, persons: DataFrame, study: Study, history: bool = True
) -> DataFrame:
    """Felony episodes with label, history and person features.

    History is taken over all episodes before the felony filter. Without it the
    plan has neither the ordered passes nor the columns that come from them.
    """
    found = (labelled_episodes if history else window_episodes)(components, stays, study)
    complete = add_person_features(found, persons, study)
    return complete.filter(F.col("episode_class") == study.felony)
