"""Components and stays to episodes: joins, collapse, history and label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from episodica.config import Study
from episodica.functions import columns as C
from episodica.operators.ordering import SLICE, slice_rows, sweep

KEYS = ["person_id", "episode_id", "component_no"]


def keep_persons_with_felony(components: DataFrame) -> DataFrame:
    """All rows of persons who have at least one felony row."""
    felons = components.filter("is_felony = 1").select("person_id").distinct()
    return components.join(felons, "person_id", "left_semi")


def keep_persons_of(source: DataFrame, cohort: DataFrame) -> DataFrame:
    """Rows of the source whose person occurs in the cohort."""
    return source.join(cohort.select("person_id").distinct(), "person_id", "left_semi")


def keep_episodes_of(source: DataFrame, cohort: DataFrame) -> DataFrame:
    """Rows of the source whose episode occurs in the cohort."""
    keys = ["person_id", "episode_id"]
    return source.join(cohort.select(*keys).distinct(), keys, "left_semi")


def join_components_to_stays(components: DataFrame, stays: DataFrame) -> DataFrame:
    """Right outer join on person, episode and component: every stay row is kept.

    The component's keys stay null for stays without a component.
    """
    inmate = stays.select(
        *[F.col(k).alias(f"stay_{k}") for k in KEYS],
        *[c for c in stays.columns if c not in KEYS],
    )
    same = [F.col(k) == F.col(f"stay_{k}") for k in KEYS]
    return components.join(inmate, same, "right")


def released_after(merged: DataFrame, begin) -> DataFrame:
    """Rows released strictly after the begin of the study; unknown dates drop out."""
    return merged.filter(F.col("release_date") > F.lit(begin))


def collapse_episodes(merged: DataFrame, study: Study) -> DataFrame:
    """One row per (person, episode) with its dates, component counts and class."""
    inside = released_after(merged, study.begin).filter(
        F.col("person_id").isNotNull() & F.col("episode_id").isNotNull()
    )
    felonies = F.sum(C.flag_equal(F.col("severity"), study.felony))
    return (
        inside.groupBy("person_id", "episode_id")
        .agg(
            F.max("release_date").alias("release_date"),
            F.min("begin_date").alias("begin_date"),
            F.count("component_no").alias("total_components"),
            felonies.alias("felony_components"),
        )
        .withColumn(
            "episode_class",
            F.when(F.col("felony_components") > 0, study.felony).otherwise(study.misdemeanor),
        )
    )


def begun_before(episodes: DataFrame, end) -> DataFrame:
    """Episodes begun strictly before the end of the study."""
    return episodes.filter(F.col("begin_date") < F.lit(end))


def add_history(episodes: DataFrame, study: Study) -> DataFrame:
    """Add the start of the person's next episode and the number of earlier ones.

    Both follow one order per person: ``study.history_order``, then episode id.
    A felony without a later episode, and every other episode, gets the date
    that stands for no return.
    """
    keys = ["person_id"]
    order = [study.history_order, "episode_id"]
    columns = [F.col(c) for c in order]
    sliced = slice_rows(episodes, keys, columns)
    following = sweep(
        sliced,
        keys,
        columns,
        running={"prior_episodes": F.lit(1).cast("long")},
        following={"_following": "begin_date"},
        found="_has_next",
    )
    counted = F.col("_has_next") & (F.col("episode_class") == study.felony)
    return following.withColumn(
        "next_start", F.when(counted, F.col("_following")).otherwise(F.lit(study.no_return))
    ).drop("_following", "_has_next", SLICE)


def add_return_label(episodes: DataFrame, study: Study) -> DataFrame:
    """1 where the next episode starts less than the horizon after the release.

    Overlapping episodes have a negative gap and count as a return unless
    ``allow_negative_gap`` is off. ``follow_up_days`` tells how long the person
    could be observed before the study ended.
    """
    gap = F.datediff("next_start", "release_date")
    returned = gap < study.horizon_days
    if not study.allow_negative_gap:
        returned = returned & (gap >= 0)
    return episodes.withColumns(
        {
            "label": F.when(returned, 1).otherwise(0),
            "follow_up_days": F.datediff(F.lit(study.end), "release_date"),
        }
    )
