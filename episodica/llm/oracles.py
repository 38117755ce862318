"""Longer SQL statements that give the rows of registered queries."""

from __future__ import annotations


def crc32(text: str) -> str:
    """DuckDB expression for the unsigned CRC-32 of a text of ASCII characters."""
    codes = f"list_transform(string_split({text}, ''), lambda c: CAST(ascii(c) AS BIGINT))"
    # Eight shifts for each byte; the reflected polynomial is 0xEDB88320.
    shifts = "list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, (x & 1) * 3988292384))"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), lambda a, b: {shifts}), 4294967295)"


def _levels(name: str, start: str, count: int) -> list[str]:
    """Statements for the levels of trees: nodes of a level, and each with its siblings and the level's size."""
    out = [f"{name}0 AS ({start})"]
    for k in range(count):
        if k:
            out.append(
                f"{name}{k} AS (SELECT key, pos // 16 AS pos, sha256(string_agg(h, '' ORDER BY pos)) AS h FROM {name}{k - 1}_of"
                f" WHERE n > 1 GROUP BY key, pos // 16)"
            )
        out.append(
            f"{name}{k}_of AS (SELECT *, count(*) OVER (PARTITION BY key) AS n,"
            f" coalesce(string_agg(h, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,"
            f" coalesce(string_agg(h, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r"
            f" FROM {name}{k} WINDOW w AS (PARTITION BY key, pos // 16 ORDER BY pos))"
        )
    return out


def _merkle(below: int = 6, above: int = 4) -> str:
    """Trees of at most 16 ** (below - 1) leaves a source, and 16 ** (above - 1) sources."""
    steps = [f"d{k}" for k in range(below)] + [f"u{k}" for k in range(above)]
    joins = [f"LEFT JOIN d{k}_of d{k} ON d{k}.key = x.key AND d{k}.pos = x.pos // {16**k}" for k in range(below)]
    joins += [f"LEFT JOIN u{k}_of u{k} ON u{k}.pos = s.pos // {16**k}" for k in range(above)]
    proof = " || ".join(f"CASE WHEN {k}.n > 1 THEN {k}.l || {k}.r ELSE '' END" for k in steps)
    fields = {
        "doc_id": "CAST(doc_id AS VARCHAR)", "source": "source", "lang": "lang", "n_chars": "CAST(n_chars AS VARCHAR)", "text": "text",
    }
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    leaf, forged = (
        "sha256(" + " || ".join(f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in parts.values()) + ")"
        for parts in (fields, fields | {"text": lower})
    )
    tampered = f"{crc32('CAST(doc_id AS VARCHAR)')} % 5 = 0"
    fold_steps, last = [], "f"
    for i, k in enumerate(steps):
        source = "found" if i == 0 else f"fold{i}"
        fold_steps.append(
            f"fold{i + 1} AS (SELECT * EXCLUDE (f), CASE WHEN {k}n > 1 THEN sha256({k}l || f || {k}r) ELSE f END AS f FROM {source})"
        )
        last = f"fold{i + 1}"
    columns = ", ".join(f"{k}.n AS {k}n, {k}.l AS {k}l, {k}.r AS {k}r" for k in steps)
    parts = [
        f"leaves AS (SELECT doc_id, coalesce('=' || source, '') AS key, {leaf} AS h,"
        f" CASE WHEN {tampered} THEN {forged} ELSE {leaf} END AS forged FROM documents)",
        "x AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, h) - 1 AS pos FROM leaves)",
        *_levels("d", "SELECT key, pos, h FROM x", below),
        "tops AS (" + " UNION ALL ".join(f"SELECT key AS src, h FROM d{k}_of WHERE n = 1" for k in range(below)) + ")",
        "s AS (SELECT *, row_number() OVER (ORDER BY src) - 1 AS pos FROM tops)",
        *_levels("u", "SELECT '' AS key, pos, h FROM s", above),
        "roots AS (" + " UNION ALL ".join(f"SELECT h FROM u{k}_of WHERE n = 1" for k in range(above)) + ")",
        f"found AS (SELECT x.doc_id, x.h AS leaf, s.h AS subroot, (SELECT h FROM roots) AS root, sha256({proof}) AS proof_sha256,"
        f" x.forged AS f, {columns} FROM x JOIN s ON s.src = x.key {' '.join(joins)})",
        *fold_steps,
    ]
    return f"WITH {', '.join(parts)} SELECT doc_id, leaf, subroot, root, proof_sha256, f AS folded_root, f = root AS verified FROM {last}"


MERKLE = _merkle()

PREFIX_TRIE = f"""
    WITH turns AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
    named AS (SELECT conv_id, turn, md5(strlen(role) || ':' || role || text) AS id, strlen(text) AS b FROM turns),
    own AS (SELECT conv_id, id, b, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, id) - 1 AS pos FROM named),
    sizes AS (SELECT conv_id, count(*) AS n, {crc32("CAST(conv_id AS VARCHAR)")} % 9 AS h FROM own GROUP BY conv_id),
    plan AS (SELECT c.*, c.conv_id - c.conv_id % 5 AS base, least(c.h, coalesce(o.n, 0)) AS shared
             FROM sizes c LEFT JOIN sizes o ON o.conv_id = c.conv_id - c.conv_id % 5),
    rebuilt AS (
        SELECT p.conv_id, o.pos, o.id, o.b FROM plan p JOIN own o ON o.conv_id = p.base AND o.pos < p.h
        UNION ALL SELECT p.conv_id, o.pos - p.h + p.shared, o.id, o.b FROM plan p JOIN own o ON o.conv_id = p.conv_id AND o.pos >= p.h),
    paths AS (
        SELECT conv_id, pos + 1 AS depth, string_agg(id, '') OVER (PARTITION BY conv_id ORDER BY pos) AS node, b FROM rebuilt
        UNION ALL SELECT conv_id, 0, '', 0 FROM plan),
    lengths AS (SELECT conv_id, max(depth) AS depth FROM paths GROUP BY conv_id),
    nodes AS (SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(b) AS saved
              FROM paths GROUP BY node, depth),
    linked AS (SELECT n.*, p.node AS parent FROM nodes n LEFT JOIN paths p ON p.conv_id = n.conv_id AND p.depth = n.depth - 1),
    children AS (SELECT parent AS node, count(*) AS n FROM linked WHERE depth > 0 GROUP BY parent),
    below AS (SELECT p.node, sum(n.saved) AS saved, count(*) FILTER (c.n IS NULL) AS leaves
              FROM nodes n JOIN paths p ON p.conv_id = n.conv_id AND p.depth <= n.depth LEFT JOIN children c ON c.node = n.node
              GROUP BY p.node),
    ends AS (SELECT p.node, string_agg(CAST(p.conv_id AS VARCHAR), ',' ORDER BY p.conv_id) AS ids
             FROM paths p JOIN lengths l ON l.conv_id = p.conv_id AND l.depth = p.depth GROUP BY p.node)
    SELECT l.conv_id, l.depth, o.conv_id AS parent_conv_id, l.n_convs, coalesce(c.n, 0) AS n_children, b.leaves AS n_leaves,
           CAST(b.saved AS BIGINT) AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
    FROM linked l JOIN below b ON b.node = l.node LEFT JOIN nodes o ON o.node = l.parent AND l.depth > 0
    LEFT JOIN children c ON c.node = l.node LEFT JOIN ends e ON e.node = l.node"""
