"""Encoding, imputation, counts, splits and profiles on small fixtures."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from episodica.config import TimeSplit
from episodica.operators import encoding as X
from episodica.operators import profile, splits


def test_one_hot_and_undummy(spark):
    df = spark.createDataFrame([(1, "x"), (2, None), (3, "y")], "id int, c string")
    codes = X.code_lists(X.observed_codes(df, ["c"]), ["c"])
    hot = X.one_hot(df, codes)
    assert [tuple(r) for r in hot.orderBy("id").collect()] == [(1, 1, 0), (2, 0, 0), (3, 0, 1)]
    back = X.undummy(hot, ["c_x", "c_y"], "c_", "c").orderBy("id").collect()
    assert [r["c"] for r in back] == ["x", "UNKNOWN", "y"]


@pytest.mark.parametrize("how,fill", [("median", 2.5), ("mode", 1.0), ("zero", 0.0), ("mean", 2.5)])
def test_impute(spark, how, fill):
    df = spark.createDataFrame([(v,) for v in (1.0, 1.0, 4.0, 4.0, None, None)], "v double")
    assert X.fill_values(df, ["v"], how) == {"v": fill}
    assert X.impute(df, {"v": fill}).filter(F.col("v") == fill).count() >= 2


def test_split_medians(spark):
    rows = [(0, "train", 1.0), (0, "train", 3.0), (0, "train", None), (0, "test", 9.0), (0, "test", None)]
    df = spark.createDataFrame(rows, "split_id int, side string, v double")
    filled = {r["v"] for r in X.impute_by_split(df, ["v"]).filter("side = 'test'").collect()}
    assert filled == {9.0, 2.0}
    own = {r["v"] for r in X.impute_by_split(df, ["v"], per_side=True).filter("side = 'test'").collect()}
    assert own == {9.0}


def test_bins(spark):
    df = spark.createDataFrame([(float(v),) for v in range(1, 9)] + [(None,)], "v double")
    got = {r["v"]: r["v_bin"] for r in X.equal_frequency_bins(df, "v", 4).collect()}
    assert [got[float(v)] for v in range(1, 9)] == [0, 0, 1, 1, 2, 2, 3, 3] and got[None] is None
    same = spark.createDataFrame([(1.0,)] * 5 + [(2.0,)], "v double")
    with pytest.raises(ValueError):
        X.equal_frequency_bins(same, "v", 4)


def test_code_counts_fill_zero(spark):
    source = spark.createDataFrame(
        [(1, 1, "a"), (1, 1, "a"), (1, 1, None), (2, 9, "b")], "person_id int, episode_id int, code string"
    )
    cohort = spark.createDataFrame([(1, 1), (1, 2)], "person_id int, episode_id int")
    got = X.add_code_counts(cohort, source, {"code": ["a", "b"]}).orderBy("episode_id").collect()
    assert [(r["code_a"], r["code_b"]) for r in got] == [(2, 0), (0, 0)]


def test_encoder_keeps_codes_of_both_sides(spark):
    schema = "person_id int, episode_id int, side string, c string, v double"
    rows = spark.createDataFrame(
        [(1, 1, "train", "x", 1.0), (2, 2, "train", "only", 3.0), (3, 3, "test", "x", None), (4, 4, "test", None, 5.0)],
        schema,
    )
    source = spark.createDataFrame(
        [(1, 1, "p"), (1, 1, "p"), (3, 3, "p"), (3, 3, "q")], "person_id int, episode_id int, o string"
    )
    counts = X.count_block_long(source, ["o"])
    encoder = X.FeatureEncoder(["c"], ["v"], ["o"]).fit(rows, counts)
    assert encoder.names == ["c_x", "o_p", "v"]
    got = {r["person_id"]: list(r["features"].toArray()) for r in encoder.transform(rows, counts).collect()}
    assert got == {1: [1, 2, 1], 2: [0, 0, 3], 3: [1, 1, 2], 4: [0, 0, 5]}


def test_temporal_split_is_inclusive(spark):
    split = TimeSplit(7, date(2007, 1, 1), date(2007, 12, 31), date(2009, 1, 1), date(2009, 12, 31))
    days = [date(2006, 12, 31), date(2007, 1, 1), date(2007, 12, 31), date(2008, 6, 1), date(2009, 1, 1)]
    df = spark.createDataFrame([(x,) for x in days], "t date")
    got = [(r["t"], r["side"]) for r in splits.temporal_split(df, "t", [split]).orderBy("t").collect()]
    assert got == [(days[1], "train"), (days[2], "train"), (days[4], "test")]


def calendar(spark, start, end, months, grace=None):
    ranges = spark.createDataFrame([(start, end)], "start date, end date")
    return [tuple(r)[:4] for r in splits.split_calendar(ranges, [months], grace).orderBy("test_start").collect()]


def test_calendar(spark):
    one = calendar(spark, date(2007, 1, 1), date(2009, 1, 1), 12)
    assert one[0] == (date(2007, 1, 1), date(2007, 12, 31), date(2008, 1, 1), date(2008, 12, 31))
    assert len(one) == 1
    clamp = calendar(spark, date(2011, 1, 31), date(2011, 4, 30), 1)
    assert clamp[0] == (date(2011, 1, 31), date(2011, 2, 27), date(2011, 2, 28), date(2011, 3, 27))
    grace = calendar(spark, date(2007, 1, 1), date(2008, 6, 1), 12, 10)
    assert grace[0] == (date(2007, 1, 1), date(2007, 12, 20), date(2008, 1, 1), date(2008, 12, 20))


def test_random_split_is_stable(spark):
    df = spark.range(4000)
    sides = {r["side"]: r["count"] for r in splits.random_split(df, ["id"], 1).groupBy("side").count().collect()}
    assert sides == {r["side"]: r["count"] for r in splits.random_split(df, ["id"], 1).groupBy("side").count().collect()}
    assert 900 < sides["test"] < 1100


def test_profiles_of_awkward_columns(spark):
    df = spark.createDataFrame([(1.0, 5.0, None), (2.0, 5.0, None), (None, 5.0, None)], "a double, k double, n double")
    described = {r["variable"]: r for r in profile.describe(df, ["a", "k", "n"]).collect()}
    assert set(described) == {"a", "k"} and described["a"]["q50"] == 1.5
    near = {r["variable"]: r for r in profile.describe(df, ["a", "k", "n"], approx=True).collect()}
    assert near["a"]["q50"] in (1.0, 2.0) and near["a"]["count"] == 2 and near["k"]["q75"] == 5.0
    bins = profile.histogram(df, ["k"]).filter("count > 0").collect()
    assert [(r["bin"], r["count"]) for r in bins] == [(5, 3)]
    cells = {(r["x"], r["y"]): r["r"] for r in profile.correlation_long(df, ["a", "k"]).collect()}
    assert cells["a", "a"] == pytest.approx(1.0) and cells["a", "k"] is None and cells["k", "k"] is None


def test_share_denominator_counts_nulls(spark):
    df = spark.createDataFrame([("x",), ("x",), (None,), ("y",)], "g string")
    assert {r["g"]: r["percent"] for r in profile.share(df, ["g"]).collect()} == {"x": 0.5, "y": 0.25}


def test_outliers_ignore_nulls(spark):
    df = spark.createDataFrame([(float(v), None) for v in range(9)] + [(100.0, 1.0), (None, 1.0)], "a double, b double")
    assert [r["a"] for r in profile.iqr_outliers(df, ["a", "b"]).collect()] == [100.0]


def test_encoder_without_a_limit_on_codes(spark):
    # More codes than a dense row or a literal list could hold.
    n = 600_000
    schema = "person_id long, episode_id long, side string, v double"
    rows = spark.createDataFrame([(1, 1, "train", 1.0), (2, 2, "test", None)], schema)
    people = rows.select("person_id", "episode_id")
    wide = people.crossJoin(spark.range(n)).select(
        *people.columns, F.lit("o").alias("column"), F.format_string("k%07d", "id").alias("code"), F.lit(2).alias("n")
    )
    encoder = X.FeatureEncoder([], ["v"], ["o"]).fit(rows, wide)
    assert len(encoder.codes) == n
    few = wide.filter("code in ('k0000003', 'k0599999', 'unseen')")
    vectors = [r["features"] for r in encoder.transform(rows, few).collect()]
    assert all(v.size == n + 1 and v.indices.tolist() == [3, n - 1, n] and v.values.tolist() == [2, 2, 1] for v in vectors)


def test_common_features_without_a_join(spark, capsys):
    rows = [(0, s, f) for s in ("train", "test") for f in ("all",) * 50 + (s,)]
    df = spark.createDataFrame(rows, "split_id int, side string, feature string")
    found = X.common_features(df)
    assert [tuple(r) for r in found.collect()] == [(0, "all")]
    found.explain()
    assert "Join" not in capsys.readouterr().out


def test_encoder_with_frequent_codes_and_colliding_names(spark):
    """One row has a code 100,000 times; a_b with code c and a with code b_c have one name and two places."""
    schema = "person_id int, episode_id int, side string, a string, a_b string"
    rows = spark.createDataFrame([(1, 1, "train", "b_c", "c"), (2, 2, "test", "b_c", "c"), (3, 3, "test", "b_c", None)], schema)
    counts = spark.createDataFrame(
        [(1, 1, "o", "k", 100_000), (2, 2, "o", "k", 1), (2, 2, "other", "k", 7)],
        "person_id int, episode_id int, column string, code string, n long",
    )
    encoder = X.FeatureEncoder(["a", "a_b"], [], ["o"]).fit(rows, counts)
    assert encoder.names == ["a_b_c", "a_b_c", "o_k"]
    encoded = encoder.transform(rows, counts)
    assert {r.person_id: r.features.toArray().tolist() for r in encoded.collect()} == {1: [1, 1, 100_000], 2: [1, 1, 1], 3: [1, 0, 0]}
    entries = X.vector_entries(encoded, encoder.names, ["person_id"]).collect()
    assert sorted((r.person_id, r.feature, r.value) for r in entries if r.person_id == 3) == [(3, "a_b_c", 1.0)]


def test_null_groups_are_described(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, 5.0), (None, 7.0)], "g string, v double")
    got = {r["g"]: (r["count"], r["mean"], r["q50"]) for r in profile.describe(df, ["v"], ["g"]).collect()}
    assert got == {"a": (2, 2.0, 2.0), None: (2, 6.0, 6.0)}
    named = {(r["attribute"], r["group_value"]): r["q50"] for r in profile.describe_groups(df, ["v"], ["g"]).collect()}
    assert named == {("g", "a"): 2.0, ("g", "UNKNOWN"): 6.0}


def test_codes_are_numbered_once_for_all_splits(spark, capsys):
    """The vectors of each split are those that its own codes give, and need neither join nor shuffle."""
    keys = "person_id int, episode_id int"
    people = spark.createDataFrame(
        [(1, 1, "x", 1.0, "b"), (2, 2, "x", None, "b"), (2, 3, None, 4.0, "a"), (3, 4, "y", 5.0, "a"), (4, 5, "y", 0.0, "a")],
        f"{keys}, c string, v double, d string",
    )
    counts = spark.createDataFrame(
        [(1, 1, "o", "p", 2), (2, 2, "o", "p", 1), (2, 3, "o", "q", 9), (3, 4, "o", "r", 3), (4, 5, "o", "r", 1), (4, 5, "z", "r", 1), (9, 9, "o", "p", 5)],
        f"{keys}, column string, code string, n long",
    )
    rows, places = X.number_codes(people, counts, ["c", "d"], ["o"])
    for train, names in (("episode_id in (1, 3)", ["d_b", "o_p", "v"]), ("episode_id = 4", ["c_y", "d_a", "o_r", "v"])):
        side = F.when(F.expr(train), "train").otherwise("test").alias("side")
        if names[0] == "d_b":
            own, numbered = (t.filter("episode_id <> 5 and episode_id <> 4").select("*", side) for t in (people, rows))
            names = ["c_x", *names]
        else:
            own, numbered = (t.filter("episode_id > 2").select("*", side) for t in (people, rows))
        kept = X.keep_episodes_of(counts, own)
        plain = X.FeatureEncoder(["c", "d"], ["v"], ["o"]).fit(own.cache(), kept)
        once = X.FeatureEncoder(["c", "d"], ["v"], ["o"]).fit_numbered(numbered, places)
        assert once.names == plain.names == names and once.fills == plain.fills
        found = once.transform_numbered(numbered, ["episode_id"])
        assert {r.episode_id: r.features for r in found.collect()} == {r.episode_id: r.features for r in plain.transform(own, kept).collect()}
        capsys.readouterr()
        found.explain()
        plan = capsys.readouterr().out
        assert "Join" not in plan and "Exchange" not in plan


def test_entries_get_their_names_without_a_shuffle(spark, capsys):
    rows = spark.createDataFrame([(1, 1, "train", "x", 2.0), (2, 2, "test", "x", 0.0)], "person_id int, episode_id int, side string, c string, v double")
    encoder = X.FeatureEncoder(["c"], ["v"]).fit(rows)
    entries = X.vector_entries(encoder.transform(rows).cache(), encoder.names, ["person_id"])
    assert sorted(tuple(r) for r in entries.collect()) == [(1, "c_x", 1.0), (1, "v", 2.0), (2, "c_x", 1.0)]
    capsys.readouterr()
    entries.explain()
    plan = capsys.readouterr().out.split("InMemoryTableScan")[0]
    assert "MapInArrow" in plan and "Join" not in plan and "Exchange" not in plan
