"""Nearest neighbours and the epsilon grid join against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from episodica.llm import cross_polytope, epsilon_join
from episodica.llm.queries import op6_cross_polytope, op8_epsilon_grid

SCHEMA = "vec_id long, embedding array<float>, label int, score double, block long"


def frame(spark, rows):
    plain = lambda v: v and [x if x is None else float(x) for x in v]
    return spark.createDataFrame([(i, plain(v), label, 0.5, 1) for i, v, label in rows], SCHEMA)


def fine(values):
    return values is not None and len(values) > 0 and all(v is not None and np.isfinite(v) for v in values) and any(values)


def unit(values):
    x = np.array(values, dtype=np.float32).astype(float)
    return x / np.sqrt((x * x).sum())


def nearest(rows, k=5):
    usable = [(i, unit(v)) for i, v, _ in rows if fine(v)]
    out = {}
    for q, x in usable:
        if q % 50 == 0:
            scores = sorted({(-round(float(x @ y), 12), i) for i, y in usable if i != q and len(y) == len(x)})[:k]
            out[q] = [i for _, i in scores]
    return out


def joined(rows, cosine=epsilon_join.COSINE):
    links = {i: set() for i, _, _ in rows}
    for n, (i, v, a) in enumerate(rows):
        for j, w, b in rows[:n]:
            if a is not None and a == b and fine(v) and fine(w) and len(v) == len(w) and unit(v) @ unit(w) >= cosine:
                links[i].add(j)
                links[j].add(i)
    component = {}
    for i in sorted(links):
        queue = [i]
        while queue:
            x = queue.pop()
            if x not in component:
                component[x] = i
                queue += links[x]
    return {i: (len(links[i]), component[i], component[i] == i) for i in links}


ODD = [
    (900, None, 1), (901, [], 1), (902, [0.0] * 8, 1), (903, [float("nan")] + [1.0] * 7, 1), (904, [None] + [1.0] * 7, 1),
    (950, [float("inf")] + [1.0] * 7, 1), (905, [1.0] * 8, None), (1000, [1.0] * 8, 7), (1001, [2.0] * 8, 7),
    (1002, [1.0] * 4, 7), (1003, [1.0] * 3, 7), (1004, [3.0, 1.0, 2.0], 7),
]


def clustered(n, length=8, groups=6, spread=0.05, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, length))
    rows = []
    for i in range(n):
        g = int(rng.integers(groups))
        rows.append((i, (centres[g] + spread * rng.normal(size=length)).astype(np.float32).tolist(), g % 3))
    return rows


def test_recall_on_the_table(spark):
    rows = [(r.vec_id, r.embedding, 0) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()]
    got = {}
    for r in op6_cross_polytope(spark, "/root/testdata/sf0.01").collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    want, vectors = nearest(rows), {i: unit(v) for i, v, _ in rows}
    hits = 0
    for q, ids in want.items():
        found = sorted(got[q])
        assert [r for r, _, _ in found] == [1, 2, 3, 4, 5]
        assert [(-s, i) for _, i, s in found] == sorted((-s, i) for _, i, s in found)
        assert all(np.isclose(s, vectors[q] @ vectors[i], atol=1e-12) for _, i, s in found)
        hits += len(set(ids) & {i for _, i, _ in found})
    assert set(got) == set(want) and hits / sum(map(len, want.values())) >= 0.9


def test_neighbours_with_ties_odd_vectors_and_parts(spark, monkeypatch):
    monkeypatch.setattr(cross_polytope, "BLOCK", 16)
    monkeypatch.setattr(cross_polytope, "QUERY_BLOCK", 2)
    copies = [(i, [1.0, 0, 0, 0, 0, 0, 0, 0.5], 0) for i in range(200, 260)]
    rows = clustered(200) + copies + ODD
    out = cross_polytope.search(frame(spark, rows), F.col("vec_id") % 50 == 0, probes=16)
    assert out.columns == ["query_id", "rank", "vec_id", "score"]
    got = {}
    for r in out.collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    want = nearest(rows)
    assert {q: [i for _, i in sorted(v)] for q, v in got.items()} == want
    assert want[200] == [201, 202, 203, 204, 205]


def test_repeated_rows_take_one_place(spark, monkeypatch):
    # In order of nearness to 0: 1, 1, 1, 2, 2, 3, 4, 5.
    near = [(n, [1.0, 0.01 * (j + 1)], 0) for j, n in enumerate([1, 1, 1, 2, 2, 3, 4, 5])]
    rows = [(0, [1.0, 0.0], 0), *near]
    got = cross_polytope.search(frame(spark, rows), F.col("vec_id") == 0, tables=1, probes=1).collect()
    assert [r.vec_id for r in sorted(got, key=lambda r: r["rank"])] == [1, 2, 3, 4, 5]
    monkeypatch.setattr(cross_polytope, "BLOCK", 16)
    rows = clustered(200) + ODD
    asked = lambda r: {(x.query_id, x["rank"], x.vec_id) for x in cross_polytope.search(frame(spark, r), F.col("vec_id") % 50 == 0, probes=16).collect()}
    assert asked([r for r in rows for _ in range(3)]) == asked(rows)
    # Whichever row of a query's id comes first.
    other = [(0, [0.0, 1.0], 0), (0, [1.0, 0.0], 0), (1, [1.0, 0.1], 0), (2, [0.1, 1.0], 0)]
    for r in (other, other[::-1]):
        got = cross_polytope.search(frame(spark, r), F.col("vec_id") == 0, k=1).collect()
        assert [x.vec_id for x in got] == [2]


def test_fewer_vectors_than_asked(spark):
    rows = [(0, [1.0, 0.0, 0.0], 0), (1, [-1.0, 0.0, 0.0], 0), (2, [0.0, 1.0, 0.0], 0), (2, [0.0, 1.0, 0.0], 0)]
    got = [(r["rank"], r.vec_id) for r in cross_polytope.search(frame(spark, rows), F.col("vec_id") == 0, probes=1).collect()]
    assert sorted(got) == [(1, 2), (2, 1)]
    assert cross_polytope.search(frame(spark, []), F.col("vec_id") == 0).count() == 0


def test_epsilon_join_on_the_table(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in op8_epsilon_grid(spark, "/root/testdata/sf0.001").collect()}
    assert got == joined(rows)


@pytest.mark.parametrize("block", [7, 4096])
def test_epsilon_join_with_dense_groups_and_odd_vectors(spark, monkeypatch, block):
    monkeypatch.setattr(epsilon_join, "BLOCK", block)
    rows = clustered(260, spread=0.08) + [(i, [1.0, 0, 0, 0, 0, 0, 0, 0.5], 2) for i in range(300, 330)] + ODD
    out = epsilon_join.near_duplicates(frame(spark, rows))
    assert out.columns == ["vec_id", "n_links", "component_id", "kept"]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in out.collect()}
    want = joined(rows)
    assert sum(n for n, _, _ in want.values()) > 1000
    assert got == want


def test_epsilon_join_without_rows_or_with_repeated_ones(spark):
    assert epsilon_join.near_duplicates(frame(spark, [])).count() == 0
    got = epsilon_join.near_duplicates(frame(spark, [(1, [1.0, 2.0], 0), (1, [1.0, 2.0], 0), (None, [1.0, 2.0], 0)])).collect()
    assert [(r.vec_id, r.n_links, r.component_id) for r in got] == [(1, 1, 1)] * 2


def test_rotations_keep_lengths():
    r = cross_polytope.Rotations(5)
    x = np.random.default_rng(0).normal(size=(20, 5))
    y = r.turned(x, 0)[:, : r.size]
    assert np.allclose((y @ y.T), x @ x.T)
