"""Train/test splits by time and at random, and split calendars."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from episodica.config import TimeSplit


def temporal_split(df: DataFrame, time_column: str, splits: Sequence[TimeSplit]) -> DataFrame:
    """Add split_id and side ('train' or 'test') by inclusive date ranges.

    A row falls into every split side whose range contains it; rows outside
    all ranges drop out. The calendar is a short literal, so no join is needed.
    """
    sides = []
    for s in splits:
        for side, lo, hi in (
            ("train", s.train_start, s.train_end),
            ("test", s.test_start, s.test_end),
        ):
            entry = F.struct(F.lit(s.split_id).alias("split_id"), F.lit(side).alias("side"))
            inside = F.col(time_column).between(F.lit(lo), F.lit(hi))
            sides.append(F.when(inside, F.array(entry)).otherwise(F.array().cast("array<struct<split_id:int,side:string>>")))
    earliest = min(min(s.train_start, s.test_start) for s in splits)
    latest = max(max(s.train_end, s.test_end) for s in splits)
    bounded = df.filter(F.col(time_column).between(F.lit(earliest), F.lit(latest)))
    return bounded.select("*", F.inline(F.concat(*sides)))


def split_calendar(ranges: DataFrame, windows: Sequence[int], grace_days: int | None = None) -> DataFrame:
    """Expanding train/test windows for each (start, end) row and window length in months.

    Window w trains from the start up to w lengths later and tests on the
    following length. It exists while the end is not before the previous test
    end plus one length. A grace period takes (days + 1) off both ends; zero
    means none.
    """
    cut = 1 + (grace_days + 1 if grace_days else 0)
    months = F.col("window_months")
    longest = F.floor(F.months_between("end", "start") / months).cast("int") + 2
    numbered = ranges.select(
        "start", "end", F.explode(F.array(*[F.lit(int(w)) for w in windows])).alias("window_months")
    ).select("*", F.explode(F.sequence(F.lit(1), F.greatest(longest, F.lit(1)))).alias("w"))
    test_start = F.add_months("start", F.col("w") * months)
    earlier = F.add_months("start", (F.col("w") - 1) * months)
    previous_end = F.when(F.col("w") == 1, F.col("start")).otherwise(
        F.date_sub(F.add_months(earlier, months), cut)
    )
    return numbered.filter(F.col("end") >= F.add_months(previous_end, months)).select(
        F.col("start").alias("train_start"),
        F.date_sub(test_start, cut).alias("train_end"),
        test_start.alias("test_start"),
        F.date_sub(F.add_months(test_start, months), cut).alias("test_end"),
        "window_months",
    )


def random_split(df: DataFrame, key: list[str], seed: int = 0) -> DataFrame:
    """Add side: about three quarters 'train', one quarter 'test', the same on every run."""
    digest = F.md5(F.concat_ws("|", *key, F.lit(seed)))
    quarter = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % 4 == 0
    return df.withColumn("side", F.when(quarter, "test").otherwise("train"))
