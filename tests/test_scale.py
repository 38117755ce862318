"""Steps that have to grow with the data: few copies of rows, bounded tasks, few passes."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from episodica import session
from episodica.operators import models, neighbours
from episodica.operators.models import Cell


def test_a_query_is_sent_once_to_a_pack_of_cells():
    rng = np.random.default_rng(5)
    centers, counts = rng.normal(0, 1, (300, 16)), rng.integers(1, 100, 300)
    pack = neighbours._packed(centers, counts, 2000)
    held = np.bincount(pack, counts)
    assert held.max() <= 2000 and len(held) <= 2 * counts.sum() / 2000 + 1


def test_neighbours_of_copies_and_unusable_vectors(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 50)
    monkeypatch.setattr(neighbours, "CHUNK_ROWS", 40)
    rng = np.random.default_rng(6)
    points = np.vstack([np.full((90, 3), 2.5), rng.normal(0, 1e4, (60, 3)), rng.normal(0, 1, (60, 3))])
    rows = [(i, p.tolist(), i % 4) for i, p in enumerate(points)]
    # Each of the last rows comes twice; none of them is its own neighbour.
    rows += rows[-30:]
    odd = [(900, None, 1), (901, [1.0, None, 2.0], 1), (902, [float("nan"), 0.0, 0.0], 2), (903, [float("inf"), 0.0, 0.0], 2)]
    df = spark.createDataFrame(rows + odd, "key int, vector array<double>, label int")
    got = {}
    for r in neighbours.k_nearest(df, df.dropDuplicates(["key"]), 5, exclude_self=True, pivots=9).collect():
        got.setdefault(r["query"], []).append(r["key"])
    assert sorted(got) == list(range(len(points)))
    for q, point in enumerate(points):
        far = sorted((round(float(np.sqrt(np.square(np.array(v) - point).sum())), 6), key) for key, v, _ in rows if key != q)
        assert sorted(got[q]) == sorted(key for _, key in far[:5])


def test_shuffles_are_cut_finer_for_larger_tables(spark, tmp_path, monkeypatch):
    names = ["spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes", session.LEAST_PARTS]
    before = {n: spark.conf.get(n, None) for n in names}
    monkeypatch.setattr(session, "PARTITION_BYTES", 1000)
    (tmp_path / "small").write_bytes(b"x" * 3000)
    (tmp_path / "large").write_bytes(b"x" * 99_500)
    try:
        session.spread_by_size(spark, str(tmp_path / "small"))
        assert {n: spark.conf.get(n, None) for n in names} == before
        session.spread_by_size(spark, str(tmp_path / "large"))
        assert [spark.conf.get(n) for n in names] == ["100", str(session.READ_BYTES), "100"]
        # A smaller table read later does not undo it.
        session.spread_by_size(spark, str(tmp_path / "small"))
        assert spark.conf.get(names[0]) == "100" and spark.range(500).groupBy("id").count().count() == 500
    finally:
        for n, value in before.items():
            spark.conf.unset(n) if value is None else spark.conf.set(n, value)


TREES = [
    Cell.of("RF", trees=4, depth=8, min_split=2), Cell.of("DT", depth=8, min_split=2), Cell.of("BG", trees=3, sample=0.5),
]


@pytest.fixture(scope="module")
def noisy(spark):
    rng = np.random.default_rng(7)
    rows = [(float(rng.random() < x[0]), Vectors.dense(x.tolist())) for x in rng.random((300, 5))]
    return spark.createDataFrame(rows, ["label", "features"])


@pytest.mark.parametrize("cell", TREES, ids=[c.family for c in TREES])
def test_deep_trees_are_not_sent_to_tasks(noisy, cell):
    estimator = models.estimator(cell)
    assert estimator.getCacheNodeIds()
    # The same trees as by walking down from the roots.
    kept = estimator.fit(noisy).toDebugString.split("\n", 1)[1]
    assert estimator.copy({estimator.cacheNodeIds: False}).fit(noisy).toDebugString.split("\n", 1)[1] == kept


def test_tree_fits_read_one_partition_a_core(spark, noisy, monkeypatch):
    read = []

    class Spy:
        def fit(self, train):
            read.append((train.rdd.getNumPartitions(), train.count()))

    monkeypatch.setattr(models, "estimator", lambda *_: Spy())
    cores = spark.sparkContext.defaultParallelism
    models.fit_trees(TREES[0], noisy.repartition(5 * cores))
    models.fit_trees(TREES[0], noisy.repartition(1))
    # All rows in both; fewer partitions stay as they are.
    assert read == [(cores, 300), (1, 300)]
