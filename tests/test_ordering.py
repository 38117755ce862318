"""Ordered operators against brute force, with one key holding most rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from episodica.operators.ordering import SLICE, add_position, exact_quantiles, slice_rows, sweep


@pytest.fixture(scope="module")
def skewed():
    rng = random.Random(5)
    rows = [(0 if rng.random() < 0.6 else rng.randrange(1, 40), rng.randrange(50), i) for i in range(5000)]
    rows += [(None, 7, 9000), (None, 3, 9001)]
    return rows


@pytest.fixture(scope="module")
def sliced(spark, skewed):
    # Without coalescing, the hot key spans several slices.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    df = spark.createDataFrame(skewed, "k int, d int, id int").repartition(6)
    out = slice_rows(df, ["k"], [F.col("d"), F.col("id")])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    return out


def by_key(rows):
    groups = {}
    for k, d, i in rows:
        groups.setdefault(k, []).append((d, i))
    return {k: sorted(v) for k, v in groups.items()}


def test_hot_key_is_spread(sliced):
    slices = sliced.filter("k = 0").select(SLICE).distinct().count()
    assert slices >= 2


def test_sweep_over_slices(sliced, skewed):
    swept = sweep(
        sliced,
        ["k"],
        [F.col("d"), F.col("id")],
        {"before": F.lit(1).cast("long"), "total": F.col("d").cast("long")},
        {"next_id": "id"},
        "more",
    )
    got = {r["id"]: (r["before"], r["total"], r["next_id"], r["more"]) for r in swept.collect()}
    assert len(got) == len(skewed)
    for rows in by_key(skewed).values():
        total = 0
        for place, (d, i) in enumerate(rows):
            last = place + 1 == len(rows)
            assert got[i] == (place, total, None if last else rows[place + 1][1], not last)
            total += d


def test_position_descending(spark, skewed):
    df = spark.createDataFrame(skewed, "k int, d int, id int")
    got = {r["id"]: r["p"] for r in add_position(df, ["k"], [F.col("d").desc(), F.col("id")], "p").collect()}
    for rows in by_key(skewed).values():
        for place, (_, i) in enumerate(sorted(rows, key=lambda r: (-r[0], r[1]))):
            assert got[i] == place


def test_exact_quantiles_match_numpy(spark, skewed):
    df = spark.createDataFrame(skewed, "k int, d int, id int").filter("k IS NOT NULL")
    got = {r["k"]: r for r in exact_quantiles(df, ["k"], "d", {"a": 0.0, "b": 0.25, "c": 0.9, "z": 1.0}).collect()}
    for k, rows in by_key(r for r in skewed if r[0] is not None).items():
        values = [d for d, _ in rows]
        expected = np.quantile(values, [0.0, 0.25, 0.9, 1.0])
        assert [got[k][n] for n in "abcz"] == pytest.approx(list(expected))
