"""The prefix trie against one built of prefixes in plain Python."""

import hashlib
import random
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from episodica.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, block string, node int"


def digest(turn):
    role, text = turn
    return hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()


def brute(rows, rebuild=True):
    own = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            own[conv_id].append((turn is not None, turn or 0, digest((role or "", text or "")), (role or "", text or "")))
    own = {c: [t[3] for t in sorted(turns)] for c, turns in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9 if rebuild else 0
        built[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    members, children = defaultdict(list), defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved, out = {}, {}, []
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in children[p]) or 1
        last = len(p[-1][1].encode()) if p else 0
        saved[p] = (len(members[p]) - 1) * last + sum(saved[k] for k in children[p])
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(built[c]) == len(p))
        above = min(members[p[:-1]]) if p else None
        sha = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(m), len(p), above, len(m), len(children[p]), leaves[p], saved[p], sha))
    return out


def run(spark, rows, rebuild=True):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(4)
    turns = prefix_trie.numbered(df)
    c = F.col("conv_id")
    heads = F.crc32(c.cast("string")) % 9 if rebuild else F.lit(0)
    # Python's remainder, so that the brute force has the same bases of negative ids.
    out = prefix_trie.trie(*prefix_trie.rebuilt(turns, c - F.pmod(c, F.lit(5)), heads, 8))
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert out.columns == names
    return sorted(map(tuple, out.collect()), key=str)


def test_matches_brute_force(spark):
    """Many conversations share beginnings, some of them over several blocks of columns."""
    rng = random.Random(1)
    trunk = [("user" if i % 2 else "assistant", f"turn {i} é" * (i % 3)) for i in range(60)]
    rows = []
    for c in range(-20, 120):
        turns = trunk[: rng.choice([0, 3, 8, 9, 16, 17, 33, 60])] + [("user", f"own {c} {i}") for i in range(rng.randint(0, 12))]
        rows += [(c, i, *t) for i, t in enumerate(turns)]
    assert run(spark, rows) == sorted(brute(rows), key=str)
    assert run(spark, rows, rebuild=False) == sorted(brute(rows, rebuild=False), key=str)


def test_odd_rows(spark):
    rows = [
        (1, None, None, None), (1, 0, "user", ""), (1, 0, "user", ""), (1, 0, "assistant", "b"), (1, 0, "user", "a"),
        (None, 0, "user", "dropped"), (2, 5, "user", "x"), (2, 3, "user", "y"), (3, 0, None, "x"), (4, 0, "", "x"), (11, 0, "a", "b"),
        (12, 0, "user", "é" * 100_000), (13, 0, "user", "é" * 100_000), (10, 0, "r", "12"), (10, 1, "r1", "2"),
    ]
    assert run(spark, rows) == sorted(brute(rows), key=str)
    assert run(spark, rows, rebuild=False) == sorted(brute(rows, rebuild=False), key=str)


def test_one_long_conversation_and_a_hot_end(spark, monkeypatch):
    """A conversation that holds a third of the rows, and ends in pieces longer than PIECE."""
    monkeypatch.setattr(prefix_trie, "PIECE", 7)
    rows = [(5, i, "user", f"t{i}") for i in range(400)] + [(6, i, "user", f"t{i}") for i in range(390)]
    rows += [(100 + i, 0, "user", "same") for i in range(7)] + [(200 + i, 0, "user", "other") for i in range(30)]
    assert run(spark, rows, rebuild=False) == sorted(brute(rows, rebuild=False), key=str)


def test_empty_table(spark):
    assert run(spark, []) == []
