"""Merkle manifest of a dataset, with leaf coordinates from the ranks of doc_id bitmaps.

Every document is a leaf: the digest of its fields. Per group (source) the
leaves ascend by doc_id, and runs of ``FANOUT`` nodes become their digest until
one is left, the group's subroot; the subroots, ordered by group, become the
root likewise.

No leaf is sorted to find its place. The doc_ids of a group are a compressed
bitmap: chunks of ``CHUNK`` ids hold their non-empty 64-bit words, merged by OR
from all tasks. Popcounts before each word, and before each chunk, are its
directory; a document's coordinate is the count before its word and the
popcount of the word below its bit. Doc_ids that repeat in a group carry their
count beside the word, and only their rows are ordered, by digest.

Levels shrink by keyed slot arrays: nodes meet by (group, coordinate / FANOUT)
in an array of at most FANOUT slots, whose digest is the parent. Going back
down, every node's slot array tells its siblings, so that each leaf has its
proof: left and right siblings for each level, up to the root. A group that
holds most rows is spread over its coordinates like any other.

Null fields count as ``-``. Null doc_ids come first in their group and are
never tampered with, the null group first of all. Rows that repeat are leaves
of their own. Extra columns don't count. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from episodica.llm.common import written
from episodica.operators.ordering import add_position, slice_rows, sweep

FANOUT = 16
# Bits of a word, and of the ids of a chunk.
WORD, CHUNK = 6, 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# The chunk of null ids, before that of the smallest id.
NULL_CHUNK = -(1 << (63 - CHUNK)) - 1


def _sha(value: Column) -> Column:
    return F.sha2(value.cast("binary"), 256)


def leaf_of(fields: dict[str, Column]) -> Column:
    """Digest of the fields in order: each ``-`` if null, else its UTF-8 byte count, a colon and the value."""
    texts = [fields[f].cast("string") for f in FIELDS]
    return _sha(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]))


def lowered(text: Column) -> Column:
    """The text with A-Z lower-cased and nothing else."""
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, capitals, capitals.lower())


def leaves(docs: DataFrame, tampered: Column | None = None, tampering: Callable[[Column], Column] = lowered) -> DataFrame:
    """doc_id, group, leaf and forged (the leaf after ``tampering`` with the text where ``tampered``, else null)."""
    fields = {f: F.col(f) for f in FIELDS} | {f: F.col(f).cast("long") for f in ("doc_id", "n_chars")}
    # Null before everything, then the bytes of the source.
    group = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    forged = F.when(F.lit(False) if tampered is None else tampered, leaf_of(fields | {"text": tampering(F.col("text"))}))
    return docs.select(
        fields["doc_id"].alias("doc_id"), group.alias("group"), leaf_of(fields).alias("leaf"), forged.alias("forged"),
        F.coalesce(F.shiftright(fields["doc_id"], CHUNK), F.lit(NULL_CHUNK)).alias("chunk"),
        F.coalesce(F.shiftright(fields["doc_id"], WORD).bitwiseAND((1 << (CHUNK - WORD)) - 1), F.lit(0)).cast("int").alias("word"),
        F.coalesce(fields["doc_id"].bitwiseAND((1 << WORD) - 1), F.lit(0)).cast("int").alias("bit"),
    )


def directory(rows: DataFrame) -> DataFrame:
    """group, chunk, word, bits, before (leaves of the group below the word), repeats (bit and copies) and n (leaves of the group)."""
    ids = rows.groupBy("group", "chunk", "word", "bit").agg(F.count("*").alias("n"))
    repeats = F.collect_list(F.when(F.col("n") > 1, F.struct("bit", (F.col("n") - 1).alias("more"))))
    words = ids.groupBy("group", "chunk", "word").agg(
        F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"), F.sum("n").alias("n"), repeats.alias("repeats")
    )
    # One row for each chunk: its words in order, few enough for an array.
    containers = written(
        words.groupBy("group", "chunk").agg(
            F.sum("n").alias("n"), F.sort_array(F.collect_list(F.struct("word", "bits", "n", "repeats"))).alias("words")
        ),
        "bitmaps",
    )
    order = [F.col("chunk")]
    sliced = slice_rows(containers.select("group", "chunk", "n"), ["group"], order)
    starts = sweep(sliced, ["group"], order, {"start": F.col("n")}).select("group", "chunk", "start")
    sizes = containers.groupBy("group").agg(F.sum("n").alias("size"))
    word = F.explode(
        F.expr(
            "zip_with(words, slice(aggregate(words, array(0L), (a, w) -> concat(a, array(element_at(a, -1) + w.n))), 1, size(words)),"
            " (w, b) -> struct(w.word, w.bits, w.repeats, b as below))"
        )
    )
    found = containers.select("group", "chunk", word.alias("w")).join(starts, ["group", "chunk"]).join(sizes, "group")
    before = F.col("start") + F.col("w.below")
    return found.select("group", "chunk", "w.word", "w.bits", "w.repeats", before.alias("before"), F.col("size").alias("n"))


def ranked(rows: DataFrame) -> DataFrame:
    """``rows`` of ``leaves`` with ``at``, the coordinate in the group, and ``n``, the group's number of leaves."""
    key = ["group", "chunk", "word"]
    looked_up = rows.join(written(directory(rows), "directory"), key)
    lower = F.bit_count(F.expr("bits & ~shiftleft(-1L, bit)"))
    more = F.expr("aggregate(filter(repeats, r -> r.bit < bit), 0L, (a, r) -> a + r.more)")
    copied = F.expr("exists(repeats, r -> r.bit = bit)")
    at = (F.col("before") + lower + more).alias("at")
    found = written(looked_up.select("doc_id", "group", "leaf", "forged", "n", at, copied.alias("copied")), "ranked")
    # Rows that share their group and doc_id: the next coordinates in the order of digests.
    copies = found.where("copied").withColumn("row", F.monotonically_increasing_id())
    if copies.isEmpty():
        return found.drop("copied")
    placed = add_position(written(copies, "copies"), ["group", "at"], [F.col("leaf"), F.col("row")], "nth")
    single = found.where("not copied").drop("copied")
    return single.unionByName(placed.withColumn("at", F.col("at") + F.col("nth")).select(*single.columns))


def _blocks(nodes: DataFrame, *own: str) -> DataFrame:
    """group, at, n and the slot array of each run of FANOUT nodes, with ``own`` columns and the parent's hash."""
    slot = F.struct(F.pmod("at", F.lit(FANOUT)).cast("int").alias("slot"), "hash", *own)
    out = nodes.groupBy("group", F.floor(F.col("at") / FANOUT).alias("at")).agg(
        F.sort_array(F.collect_list(slot)).alias("slots"), F.first("n").alias("n")
    )
    return out.withColumn("hash", _sha(F.concat_ws("", "slots.hash")))


# What a node needs to fold up to the root: per level, the digests left and right of it, joined.
STEP = "array<struct<left:string,right:string>>"


def _down(blocks: DataFrame, *own: str) -> DataFrame:
    """One row for each slot of ``blocks`` with their ``path``: its own path and ``own`` columns.

    Where the block is ``alone``, its one node is the top itself and takes the block's path.
    """
    siblings = F.expr(
        "struct(array_join(transform(slice(slots, 1, i), s -> s.hash), '') as left,"
        " array_join(transform(slice(slots, i + 2, 16), s -> s.hash), '') as right)"
    )
    columns = [c for c in blocks.columns if c not in ("slots", "at", "hash")]
    each = blocks.select("*", F.posexplode("slots").alias("i", "own"))
    path = F.when(F.col("alone"), F.col("path")).otherwise(F.concat(F.array(siblings), F.col("path")))
    return each.select(
        *[c for c in columns if c not in ("path", "alone")], (F.col("at") * FANOUT + F.col("own.slot")).alias("at"), path.alias("path"),
        *[F.col(f"own.{c}").alias(c) for c in own],
    )


def _reduced(blocks: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Slot arrays of the levels above ``blocks``, and top: group, hash and depth (levels below the last node)."""
    # ``blocks`` are at depth 1, but a lone leaf is the top itself.
    tops = [blocks.where("n = 1").select("group", F.col("slots")[0]["hash"].alias("hash"), F.lit(0).alias("depth"))]
    levels, depth = [], 1
    nodes = blocks.where("n > 1").select("group", "at", "hash", F.ceil(F.col("n") / FANOUT).alias("n"))
    left = blocks.agg(F.max("n")).first()[0] or 0
    while left > 1:
        left = -(-left // FANOUT)
        tops.append(nodes.where("n = 1").select("group", "hash", F.lit(depth).alias("depth")))
        if left > 1:
            above = written(_blocks(nodes.where("n > 1")), "level")
            levels.append(above)
            nodes = above.select("group", "at", "hash", F.ceil(F.col("n") / FANOUT).alias("n"))
            depth += 1
    top = tops[0]
    for more in tops[1:]:
        top = top.unionByName(more)
    return levels, written(top, "tops")


def _paths(levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """group, at and path of the nodes at depth 1 (of the lone leaf at depth 0); ``tops`` has the paths of the tops."""
    of_tops = tops.select("group", "depth", F.lit(0).cast("long").alias("at"), "path")
    down = None
    for depth in range(len(levels), 0, -1):
        parents = of_tops.where(F.col("depth") == depth + 1).drop("depth")
        parents = parents if down is None else parents.unionByName(down)
        joined = levels[depth - 1].join(parents, ["group", "at"]).withColumn("alone", F.lit(False))
        down = written(_down(joined).select("group", "at", "path"), "paths")
    low = of_tops.where("depth <= 1").drop("depth")
    return low if down is None else low.unionByName(down)


def _fold(leaf: Column) -> Column:
    return F.aggregate("path", leaf, lambda a, s: F.sha2(F.concat(s["left"], a, s["right"]).cast("binary"), 256))


def manifest(docs: DataFrame, tampered: Column | None = None, tampering: Callable[[Column], Column] = lowered) -> DataFrame:
    """doc_id, source, at, leaf, subroot, root, path (left and right siblings of each level) and proof_sha256 of every document.

    ``folded_root`` follows the path from the leaf, tampered with where ``tampered``; ``verified`` tells whether it is the root.
    """
    rows = written(leaves(docs, tampered, tampering), "leaves")
    nodes = ranked(rows).withColumn("hash", F.col("leaf"))
    blocks = written(_blocks(nodes, "doc_id", "forged"), "blocks")
    levels, tops = _reduced(blocks)

    # The subroots are the leaves of one more tree, in the order of their groups.
    subroots = written(_ordered(tops), "ordered_subroots")
    count = subroots.count()
    leaves_above = subroots.select(F.lit("").alias("group"), "at", "hash", F.lit(count).alias("n"), F.col("group").alias("own"))
    upper = written(_blocks(leaves_above, "own"), "subroots")
    upper_levels, upper_top = _reduced(upper)
    root = F.lit(upper_top.select("hash").first()["hash"] if count else None).cast("string")
    start = upper_top.withColumn("path", F.array().cast(STEP))
    upper_paths = _paths(upper_levels, start)
    of_subroot = _down(upper.join(upper_paths, ["group", "at"]).withColumn("alone", F.col("n") == 1), "own", "hash").select(
        F.col("own").alias("group"), F.col("hash").alias("subroot"), "path"
    )
    of_subroot = written(of_subroot, "subroot_paths")

    paths = _paths(levels, tops.join(of_subroot, "group"))
    of_leaf = _down(
        blocks.join(paths, ["group", "at"]).join(of_subroot.select("group", "subroot"), "group").withColumn("alone", F.col("n") == 1),
        "doc_id", "hash", "forged",
    )
    folded = _fold(F.coalesce("forged", "hash"))
    source = F.when(F.col("group") != "", F.expr("substring(group, 2)"))
    steps = F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), "")
    out = of_leaf.select(
        "doc_id", source.alias("source"), "at", F.col("hash").alias("leaf"), "subroot", root.alias("root"), "path",
        _sha(steps).alias("proof_sha256"), folded.alias("folded_root"),
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def _ordered(tops: DataFrame) -> DataFrame:
    """Tops with their place in the order of groups."""
    one = tops.withColumn("_all", F.lit(0))
    return add_position(one, ["_all"], [F.col("group")], "at").drop("_all")
