"""Prefix trie of conversations by ROLLUP over positional turn-id columns.

A turn's id is a digest of its role and text. A conversation is cut into blocks
of ``WIDTH`` turns, one column for each place, and one ROLLUP over the block's
start and its turn columns aggregates all prefixes together; grouping_id tells
how many turns a row's prefix has. Long conversations continue in further rows
of the same columns, keyed by the node at which the block before ended: its
depth and a sum of digests over the blocks up to there. Being a sum, the key of
every block comes from running sums over slices, and all blocks of all
conversations are in the same ROLLUP, however long one is.

A second ROLLUP sums over subtrees: what a node adds is put on its smallest
member at the node's depth, so the subtree of a node holds what its members
have from its depth on.

``rebuilt`` makes conversations that share their first turns: each takes the
first h turns of another one in place of its own.

Rows without conv_id are dropped, null roles and texts are empty. Null turns
come first; rows of one turn follow each other by their digests, and repeated
rows are turns of their own. Extra columns are dropped. An empty table has no
nodes, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from episodica.llm.common import written
from episodica.operators.ordering import add_position, slice_rows, sweep

WIDTH = 8
# Ids of one node's list that are joined at once.
PIECE = 4096
TURNS = [f"t{i}" for i in range(1, WIDTH + 1)]
BYTES = [f"b{i}" for i in range(1, WIDTH + 1)]
KEY = "decimal(38,0)"


def numbered(conversations: DataFrame) -> DataFrame:
    """conv_id, at (from 0), id (digest of role and text) and bytes (of the text) of every turn, in order."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))).alias("id"),
        F.octet_length(text).cast("long").alias("bytes"), F.monotonically_increasing_id().alias("row"),
    )
    order = [F.col("turn").asc_nulls_first(), F.col("id"), F.col("row")]
    return written(add_position(written(turns, "turns"), ["conv_id"], order, "at").select("conv_id", "at", "id", "bytes"), "numbered")


def rebuilt(turns: DataFrame, base: Column, heads: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations (conv_id, total) and turns, each with the first ``heads`` turns of conversation ``base`` in place of its own.

    ``base`` and ``heads`` (at most ``most``) are expressions of conv_id. Of a
    base with fewer turns all are taken, of an absent one none.
    """
    sizes = written(turns.groupBy("conv_id").agg(F.count("*").alias("n")), "sizes")
    own = sizes.select("conv_id", "n", base.cast("long").alias("base"), heads.cast("long").alias("h"))
    bases = sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    plan = own.join(bases, "base", "left").withColumn("shared", F.least("h", F.coalesce("base_n", F.lit(0))))
    plan = written(plan.withColumn("total", F.col("shared") + F.greatest(F.col("n") - F.col("h"), F.lit(0))), "rebuilding")
    first = turns.where(F.col("at") < most).withColumnRenamed("conv_id", "base")
    taken = plan.select("conv_id", "base", "h").join(first, "base").where("at < h").select("conv_id", "at", "id", "bytes")
    kept = turns.join(plan.select("conv_id", "h", "shared"), "conv_id").where("at >= h")
    kept = kept.select("conv_id", (F.col("at") - F.col("h") + F.col("shared")).alias("at"), "id", "bytes")
    return plan.select("conv_id", "total"), written(taken.unionByName(kept), "rebuilt")


def _continued(block: Column, turns: list[Column]) -> list[Column]:
    """What a full block adds to the key of the next one."""
    digest = F.md5(F.concat(F.concat(block.cast("string"), F.lit(":")).cast("binary"), *turns))
    return [F.conv(F.substring(digest, start, 15), 16, 10).cast(KEY) for start in (1, 17)]


def _node(block: Column, keys: list[Column], turns: list[Column]) -> Column:
    """Digest that names a node: its block, the block's keys, and the turns from there on (null beyond the node)."""
    start = F.concat_ws("|", block.cast("string"), *[k.cast(KEY).cast("string") for k in keys]).cast("binary")
    return F.md5(F.concat(start, *[F.coalesce(t, F.lit(b"")) for t in turns]))


def _node_at(block: Column, keys: list[Column], turns: list[Column], length: Column) -> Column:
    """The node after ``length`` turns of a block; a full block is where the next one starts."""
    more = [(k + m).cast(KEY) for k, m in zip(keys, _continued(block, turns), strict=True)]
    return F.when(length == WIDTH, _node(block + 1, more, [])).otherwise(
        _node(block, keys, [F.when(F.lit(i) < length, t) for i, t in enumerate(turns)])
    )


def blocks(conversations: DataFrame, turns: DataFrame) -> DataFrame:
    """conv_id, total, block, k1, k2 (key of the node before) and the turn and byte columns, null beyond the end.

    Conversations without turns have one empty block.
    """
    place = (F.col("at") % WIDTH).cast("int")
    picked = [F.max(F.when(place == i, F.col(c))).alias(f"{p}{i + 1}") for c, p in (("id", "t"), ("bytes", "b")) for i in range(WIDTH)]
    cut = turns.groupBy("conv_id", F.floor(F.col("at") / WIDTH).alias("block")).agg(*picked)
    cut = conversations.join(cut, "conv_id", "left").withColumn("block", F.coalesce("block", F.lit(0).cast("long")))
    cut = written(cut, "blocks")
    zero = F.lit(0).cast(KEY)
    short = cut.where(F.col("total") <= WIDTH).withColumns({"k1": zero, "k2": zero})
    long = cut.where(F.col("total") > WIDTH)
    if long.isEmpty():
        return short
    full = F.col("total") >= (F.col("block") + 1) * WIDTH
    added = [F.when(full, m).otherwise(zero) for m in _continued(F.col("block"), [F.col(t) for t in TURNS])]
    order = [F.col("block")]
    keyed = sweep(slice_rows(long, ["conv_id"], order), ["conv_id"], order, dict(zip(("k1", "k2"), added, strict=True)))
    keyed = keyed.withColumns({k: F.col(k).cast(KEY) for k in ("k1", "k2")})
    return short.unionByName(keyed.select(*short.columns))


def _rolled(rows: DataFrame, *aggregates: Column) -> DataFrame:
    """One row for each node: block, k1, k2, the turn columns, length (turns in the block) and the aggregates.

    The empty grouping is none, and the start of a later block is the end of another one's.
    """
    start = F.struct("block", "k1", "k2").alias("start")
    # One bit for each column that is rolled up; with the start, there is one column more than turns.
    length = (F.lit(WIDTH) - F.bit_count("grouped")).cast("int")
    out = rows.withColumn("start", start).drop("block", "k1", "k2").rollup("start", *TURNS)
    out = out.agg(F.grouping_id().alias("grouped"), *aggregates).withColumn("length", length)
    last = F.get(F.array(*TURNS), F.col("length") - 1)
    real = F.when(F.col("length") == 0, F.col("start.block") == 0).otherwise(last.isNotNull())
    more = [c for c in out.columns if c not in ("start", "grouped", "length", *TURNS)]
    return out.where((F.col("length") >= 0) & real).select("start.*", *TURNS, "length", *more)


def _keys() -> tuple[Column, list[Column], list[Column]]:
    return F.col("block"), [F.col("k1"), F.col("k2")], [F.col(t) for t in TURNS]


def _nodes(rows: DataFrame) -> DataFrame:
    """node, parent, conv_id, depth, n_convs, bytes (of the last text) of every node."""
    out = _rolled(
        rows.withColumn("bytes", F.array(*BYTES)),
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.any_value("bytes").alias("bytes"),
    )
    above = _node_at(*_keys(), F.col("length") - 1)
    return out.select(
        _node_at(*_keys(), F.col("length")).alias("node"), F.when(F.col("length") > 0, above).alias("parent"), "conv_id",
        (F.col("block") * WIDTH + F.col("length")).alias("depth"), "n_convs",
        F.coalesce(F.get("bytes", F.col("length") - 1), F.lit(0)).alias("bytes"),
    )


def _subtrees(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, n_leaves and saved_tokens, summed over the subtree of every node."""
    shared = nodes.where("n_convs > 1 and depth > 0").select(
        "conv_id", F.floor((F.col("depth") - 1) / WIDTH).alias("block"), ((F.col("depth") - 1) % WIDTH).alias("i"),
        ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"),
    )
    # The nodes whose smallest member is one conversation follow each other in depth, those that are shared first.
    values = [F.sum(F.when(F.col("i") == i, F.col("saved")).otherwise(0)).alias(f"s{i}") for i in range(WIDTH)]
    by_block = written(shared.groupBy("conv_id", "block").agg(*values, F.sum("saved").alias("saved")), "saved")
    order = [F.col("block")]
    before = sweep(slice_rows(by_block, ["conv_id"], order), ["conv_id"], order, {"before": F.col("saved")})
    here = written(before.select("conv_id", "block", "before", *[f"s{i}" for i in range(WIDTH)]), "saved_before")
    of_conv = by_block.groupBy("conv_id").agg(F.sum("saved").alias("all"), F.min("block").alias("first"))
    leaves = nodes.where("n_children = 0").select("conv_id", F.lit(1).cast("long").alias("leaf"))
    of_conv = written(of_conv.join(leaves, "conv_id", "full"), "of_conversations")

    joined = rows.join(of_conv, "conv_id", "left").join(here, ["conv_id", "block"], "left")
    rest = F.when(F.col("before").isNotNull(), F.col("all") - F.col("before")).when(F.col("block") < F.col("first"), F.col("all"))
    # From the end of j turns of the block on: all less what lies before.
    names = [f"from{j}" for j in range(WIDTH + 1)]
    left = F.coalesce(rest, F.lit(0))
    for j, name in enumerate(names):
        if j > 1:
            left = left - F.coalesce(F.col(f"s{j - 2}"), F.lit(0))
        joined = joined.withColumn(name, left)
    sums = [F.sum(name).alias(name) for name in names]
    out = _rolled(joined, F.sum(F.coalesce("leaf", F.lit(0))).alias("n_leaves"), *sums)
    saved = F.get(F.array(*names), F.col("length"))
    return out.select(_node_at(*_keys(), F.col("length")).alias("node"), "n_leaves", saved.alias("saved_tokens"))


def _hashed(pieces: DataFrame) -> DataFrame:
    """node and ends_sha256 of lists in pieces: rows of one node follow each other, and only the hash's state is held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, hashlib.sha256()
        for batch in batches:
            done = []
            for name, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if name != node:
                    if node is not None:
                        done.append((node, state.hexdigest()))
                    node, state = name, hashlib.sha256(ids.encode())
                else:
                    state.update(f",{ids}".encode())
            yield _pairs(done)
        yield _pairs([(node, state.hexdigest())] if node is not None else [])

    def _pairs(done: list[tuple[str, str]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], pa.string()) for i in (0, 1)], names=["node", "ends_sha256"])

    ordered = pieces.repartition("node").sortWithinPartitions("node", "piece")
    return ordered.select("node", "ids").mapInArrow(run, "node string, ends_sha256 string")


def _ends(rows: DataFrame) -> DataFrame:
    """node and ends_sha256 of the nodes at which conversations end."""
    length = F.col("total") - F.col("block") * WIDTH
    last = rows.where((length <= WIDTH) & ((length > 0) | (F.col("total") == 0)))
    ends = written(last.select(_node_at(*_keys(), length).alias("node"), "conv_id"), "ends")
    placed = add_position(ends, ["node"], [F.col("conv_id")], "nth")
    pieces = placed.groupBy("node", F.floor(F.col("nth") / PIECE).alias("piece")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"),
        F.count("*").alias("n"),
    )
    pieces = written(pieces, "pieces")
    # A list that fills its first piece may go on in others.
    alone = pieces.where((F.col("piece") == 0) & (F.col("n") < PIECE))
    alone = alone.select("node", F.sha2(F.col("ids").cast("binary"), 256).alias("ends_sha256"))
    return alone.unionByName(_hashed(pieces.where((F.col("piece") > 0) | (F.col("n") == PIECE))))


def trie(conversations: DataFrame, turns: DataFrame) -> DataFrame:
    """One row for each node: conv_id (its smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256.

    ``conversations`` has conv_id and total (number of turns), ``turns`` has conv_id, at, id and bytes, as ``numbered`` gives them.
    """
    rows = written(blocks(conversations, turns), "keyed_blocks")
    nodes = written(_nodes(rows), "nodes")
    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    counted = nodes.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    counted = written(counted, "counted_nodes")
    parents = counted.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    ended = F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest()))
    whole = counted.join(_subtrees(rows, counted), "node").join(_ends(rows), "node", "left")
    whole = whole.join(written(parents, "parents"), "parent", "left")
    return whole.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", ended.alias("ends_sha256")
    )
