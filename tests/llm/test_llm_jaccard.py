"""The n-gram join against all pairs, and its edge cases."""

import random
from itertools import combinations

import numpy as np
import pytest

from episodica.llm import jaccard


def brute(rows, similarity=jaccard.SIMILARITY):
    sets = {}
    for doc_id, text in rows:
        words = (text or "").split()
        n = max(1, len(words) - 4) if words else 0
        sets[doc_id] = {tuple(words[i : i + 5]) for i in range(n)}
    links = {k: set() for k in sets}
    for a, b in combinations(sets, 2):
        union = len(sets[a] | sets[b])
        if union and len(sets[a] & sets[b]) / union >= similarity:
            links[a].add(b)
            links[b].add(a)
    component = {}
    for k in sorted(sets):
        queue = [k]
        while queue:
            x = queue.pop()
            if x not in component:
                component[x] = k
                queue += links[x]
    return {k: (min([j for j in sets if sets[j] == sets[k] and sets[k]] or [k]), len(links[k]), component[k]) for k in sets}


def run(spark, rows):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, rep int, digest string")
    out = jaccard.join(df).collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in out)
    return {r.doc_id: (r.class_id, r.n_links, r.component_id) for r in out}


def corpus(seed, groups=12, copies=8):
    rng = random.Random(seed)
    rows = []
    for _ in range(groups):
        base = [f"w{rng.randint(0, 5000)}" for _ in range(rng.randint(3, 120))]
        for _ in range(copies):
            words = list(base)
            for _ in range(rng.randint(0, 3)):
                words[rng.randrange(len(words))] = f"w{rng.randint(0, 5000)}"
            rows.append((len(rows), " ".join(words)))
    rng.shuffle(rows)
    return rows


def test_matches_all_pairs(spark):
    rows = corpus(1)
    assert run(spark, rows) == brute(rows)


def test_large_groups_are_split_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 10)
    rows = corpus(2, groups=3, copies=60)
    assert run(spark, rows) == brute(rows)


def test_edge_cases(spark):
    long = " ".join(f"t{i}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "two words"), (5, "two  words"), (6, "words two"), (7, long), (8, long + " end"), (9, long)]
    got = run(spark, rows)
    assert got == brute(rows)
    assert got[5] == (4, 1, 4) and got[8][2] == 7 and got[1] == (1, 0, 1)


def test_repeated_rows_null_ids_and_no_rows(spark):
    assert run(spark, []) == {}
    df = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (2, "z")], "doc_id long, text string")
    got = sorted((r.doc_id, r.n_links, r.component_id) for r in jaccard.join(df).collect())
    assert got == [(1, 1, 1), (1, 1, 1), (2, 0, 2)]


def test_depth_is_the_deepest_with_the_recall():
    d = jaccard.depth_for(0.999, 0.8)
    recall = lambda k: 1 - (1 - 0.8**k) ** jaccard.TREES
    assert recall(d) >= 0.999 > recall(d + 1)
    assert jaccard.depth_for(0.9, 0.8) > d
    with pytest.raises(ValueError):
        jaccard.depth_for(0.999, 0.8, trees=2)


def test_shared_counts_across_slices(monkeypatch):
    monkeypatch.setattr(jaccard, "SLICE", 7)
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 60, 40).astype(np.uint64)) for _ in range(9)]
    want = [[len(np.intersect1d(a, b)) for b in sets[:4]] for a in sets[4:]]
    assert jaccard.shared_counts(sets[4:], sets[:4]).tolist() == want
