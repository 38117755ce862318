"""The Merkle manifest against trees built in plain Python."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from episodica.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, at string, leaf int"
RESULT = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest("".join(levels[-1][i : i + 16])) for i in range(0, len(levels[-1]), 16)])
    return levels


def siblings(levels, i):
    out = []
    for level in levels[:-1]:
        start = i // 16 * 16
        out.append(("".join(level[start:i]), "".join(level[i + 1 : start + 16])))
        i //= 16
    return out


def leaf(row):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def brute(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append((row[0] is not None, row[0] or 0, leaf(row), row))
    names = sorted(groups, key=lambda k: (k is not None, (k or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda x: x[:3])
        trees[name] = tree([x[2] for x in groups[name]])
    top, out = tree([trees[name][-1][0] for name in names]), []
    for j, name in enumerate(names):
        for i, (_, _, own, row) in enumerate(groups[name]):
            path = siblings(trees[name], i) + siblings(top, j)
            folded = own
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[4] is not None:
                folded = leaf((*row[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4])))
            for left, right in path:
                folded = digest(left + folded + right)
            proof = digest("".join(left + right for left, right in path))
            out.append((row[0], own, trees[name][-1][0], top[-1][0], proof, folded, folded == top[-1][0]))
    return out


def run(spark, rows):
    df = spark.createDataFrame([(*r, "x", 3) for r in rows], SCHEMA).repartition(5)
    return merkle.manifest(df, F.crc32(F.col("doc_id").cast("string")) % 5 == 0)


def order(rows):
    return sorted(map(tuple, rows), key=str)


def test_matches_trees_in_python(spark):
    """One source holds most rows; others have 1, 16, 17 and 256 leaves, and there are more than 16 sources."""
    rng = random.Random(2)
    ids = rng.sample(range(-(10**6), 10**6), 2000) + [2**63 - 1, -(2**63)]
    sizes = {"hot": 1200, None: 17, "": 1, "één": 256, "b": 16, "a": 15} | {f"s{i}": 2 + i for i in range(20)}
    rows, at = [], 0
    for source, n in sizes.items():
        for doc_id in ids[at : at + n]:
            text = rng.choice([None, "", "Ä Text", "lower", f"Long {'xY' * rng.randint(0, 900)}"])
            rows.append((doc_id, source, rng.choice([None, "en"]), rng.choice([None, 5]), text))
        at += n
    rows += [(i, "dense", "en", i, f"Text {i}") for i in (2**63 - 1, -(2**63), *range(300))]
    assert order(run(spark, rows).select(RESULT).collect()) == order(brute(rows))


def test_null_and_repeated_ids(spark):
    """Null ids come first, equal ids follow by digest, and equal rows are leaves of their own."""
    rows = [(None, "s", None, None, None)] * 20 + [(None, "s", "en", 1, "A")]
    rows += [(7, "s", "en", 1, "A")] * 40 + [(7, "s", "en", 1, f"B{i}") for i in range(40)]
    rows += [(i, "s", "en", 1, "C") for i in range(5, 30)] + [(7, None, "en", 1, "A")] * 3
    assert order(run(spark, rows).select(RESULT).collect()) == order(brute(rows))


@pytest.mark.parametrize("n", [1, 2])
def test_few_leaves(spark, n):
    rows = [(i, "s", "en", 1, "Abc") for i in range(n)]
    assert order(run(spark, rows).select(RESULT).collect()) == order(brute(rows))


def test_tampering_is_found_where_it_changes_a_text(spark):
    rows = [(i, "s", "en", 1, "Abc" if i % 2 else "abc") for i in range(100)]
    got = {r.doc_id: r.verified for r in run(spark, rows).collect()}
    assert got == {i: not (i % 2 and zlib.crc32(str(i).encode()) % 5 == 0) for i in range(100)}


def test_coordinates_are_ranks_within_sources(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice("ab"), None, None, None) for i in rng.sample(range(10**12), 500)]
    want = {}
    for source in "ab":
        want |= {r[0]: i for i, r in enumerate(sorted(r for r in rows if r[1] == source))}
    assert {r.doc_id: r["at"] for r in run(spark, rows).collect()} == want


def test_empty_table(spark):
    assert run(spark, []).collect() == []
