"""Line dedup against a brute-force version, and its edge cases."""

import random

from episodica.llm import line_dedup

SCHEMA = "doc_id long, text string, removed string, gone string"


def brute(rows):
    """Lines of pairs that a smaller doc_id has, or the same text two lines before or earlier, go."""
    pairs_of = lambda lines: [tuple(lines[i : i + 2]) for i in range(len(lines) - 1)]
    first = {}
    for doc_id, text in sorted((r for r in rows if r[0] is not None and r[1] is not None), key=lambda r: r[0]):
        for pair in pairs_of(text.split("\n")):
            first.setdefault(pair, doc_id)
    out = []
    for doc_id, text in rows:
        if doc_id is not None and text is not None:
            lines, gone = text.split("\n"), set()
            pairs = pairs_of(lines)
            for i, pair in enumerate(pairs):
                if any(x.strip() for x in pair) and (first[pair] < doc_id or pairs.index(pair) <= i - 2):
                    gone |= {i, i + 1}
            text = "\n".join(x for i, x in enumerate(lines) if i not in gone)
        out.append((doc_id, text))
    return out


def run(spark, rows):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    out = line_dedup.dedup(df)
    assert out.columns == ["doc_id", "text", "gone", "removed", "removed_lines"]
    return [(r.doc_id, r.text) for r in out.collect()]


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))


def test_chunks_join_to_the_text_and_have_two_lines():
    rng = random.Random(3)
    for n in (0, 1, 2, 3, 4, 50, 400):
        text = "\n".join(rng.choice("abcdefgh") * rng.randint(0, 3) for _ in range(n))
        parts = line_dedup.chunks(text)
        assert "\n".join(parts) == text
        assert len(parts) == 1 or all(p.count("\n") >= 1 for p in parts)


def test_boundaries_resist_shifts():
    lines = [f"line {i * i % 977}" for i in range(300)]
    a, b = line_dedup.chunks("\n".join(lines)), line_dedup.chunks("\n".join(["new", "lines", "before", *lines]))
    assert len(set(a) & set(b)) >= len(a) - 2


def test_matches_brute_force(spark):
    rng = random.Random(1)
    pool = [[f"shared {p} {k}" for k in range(12)] for p in range(4)]
    rows = []
    for i in range(60):
        lines = [f"own {i} {k}" for k in range(rng.randint(0, 8))]
        at = rng.randint(0, len(lines))
        rows.append((i, "\n".join(lines[:at] + rng.choice(pool) + lines[at:])))
    got = run(spark, rows)
    assert order(got) == order(brute(rows))
    assert sum(len(t) for _, t in got) < 0.7 * sum(len(t) for _, t in rows)


def test_short_passages_in_foreign_surroundings(spark):
    """Passages of two to six lines go whole wherever they repeat, and nothing else does."""
    rng = random.Random(4)
    passages = [[f"passage {p} {k}" for k in range(2 + p % 5)] for p in range(25)]
    rows, want = [], {}
    for i in range(250):
        head, tail = ([f"own {i} {side} {k}" for k in range(rng.randint(0, 6))] for side in "ab")
        p = i % 25
        rows.append((i, "\n".join(head + passages[p] + tail)))
        want[i] = "\n".join(head + (passages[p] if i < 25 else []) + tail)
    assert dict(run(spark, rows)) == want


def test_runs_inside_texts_and_across_chunks(spark):
    rng = random.Random(5)
    rows = [(i // 2 if i % 9 == 0 else i, "\n".join(rng.choice("ab  cd") for _ in range(rng.randint(0, 40)))) for i in range(40)]
    rows += [(100 + i, "\n".join(["x"] * i)) for i in range(6)] + [(200, "p\n\n\n\nq"), (201, "p\n\n\n\nq"), (202, "\n\nq\n\n")]
    assert order(run(spark, rows)) == order(brute(rows))


def test_digests_of_several_texts_remove_nothing(spark):
    rows = [(1, "a\nb"), (2, "c\nd"), (3, "a\nb"), (4, "longer\nlines"), (5, "longer\nlines"), (6, "own\nlonger\nlines\n.")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    by_length = lambda n: lambda text: str(len(text) // n).encode()
    got = {r.doc_id: r.text for r in line_dedup.dedup(df, digest=by_length(1)).collect()}
    assert got == {**dict(rows), 5: "", 6: "own\n."}
    assert {r.doc_id: r.text for r in line_dedup.dedup(df, digest=by_length(1000)).collect()} == dict(rows)


def test_pairs_of_a_clashing_chunk_are_indexed(spark):
    """Chunks all share a digest; their pairs do not."""
    rng = random.Random(6)
    shared = [f"shared {k}" for k in range(9)]
    rows = [(i, "\n".join([f"own {i} {k}" for k in range(rng.randint(0, 5))] + shared + [f"end {i}"])) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    digest = lambda text: text.encode() if text.count("\n") == 1 else b"chunk"
    assert order([(r.doc_id, r.text) for r in line_dedup.dedup(df, digest=digest).collect()]) == order(brute(rows))


def test_edge_cases(spark):
    long = "\n".join(f"l{i}" for i in range(20_000))
    rows = [
        (1, None), (2, ""), (3, "one line"), (4, "one line"), (5, "a\nb"), (6, "a\nb"), (None, "a\nb"),
        (7, "\n\n"), (8, "\n\n"), (9, long), (10, long), (11, "c\nd"), (11, "c\nd"), (12, "x\ny\nq"),
    ]
    got = run(spark, rows)
    want = {
        1: [None], 2: [""], 3: ["one line"], 4: ["one line"], 5: ["a\nb"], 6: [""], None: ["a\nb"], 7: ["\n\n"], 8: ["\n\n"],
        9: [long], 10: [""], 11: ["c\nd", "c\nd"], 12: ["x\ny\nq"],
    }
    assert order(got) == order([(k, t) for k, texts in want.items() for t in texts])


def test_empty_table(spark):
    assert run(spark, []) == []
