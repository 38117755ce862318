"""N-gram Jaccard join by an LSH forest of MinHash signatures, verified exactly.

Every distinct shingle set gets, for each tree of the forest, a label of
``MAX_DEPTH`` MinHash values. Labels sorted make a prefix trie, whose nodes at
depth d hold the sets that agree in d values. The join uses one depth only, the
longest at which a pair at the threshold meets in some tree with the target
recall: banding of a fixed depth, which stands in for the adaptive forest. Sets that meet are gathered into candidate
groups; within a group all pairs are verified exactly, in blocks, so that a
group of any size is spread over tasks. Blocks give link counts and spanning
trees, never the pairs.

A shingle is five words in a row; texts with fewer words are one shingle.
Documents with the same shingles are one class. Null texts, and texts without
words, are classes of their own without links. Rows that repeat a doc_id give
a row each; if such an id stands for a class, the least of its texts does. Rows
without an id are dropped. An empty table gives
an empty table. Extra columns are dropped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from episodica.llm.blocks import Forest, add_links
from episodica.llm.common import in_small_batches, written
from episodica.llm.graph import components

WORDS, SIMILARITY = 5, 0.8
TREES, MAX_DEPTH, RECALL = 24, 8, 0.999
# Shingle sets that meet in one task, at most twice as many.
BLOCK = 256
# Columns of the 0/1 matrix that a block multiplies at once.
SLICE = 8192


def depth_for(recall: float, similarity: float, trees: int = TREES, deepest: int = MAX_DEPTH) -> int:
    """The longest prefix at which pairs of that similarity meet in some tree with that recall."""
    for depth in range(deepest, 0, -1):
        if 1 - (1 - similarity**depth) ** trees >= recall:
            return depth
    raise ValueError("the forest has too few trees for this recall")


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the shingles of one whole text."""
    tokens = (text or "").split()
    if not tokens:
        return np.zeros(0, np.uint64)
    each = np.array([xxhash.xxh3_64_intdigest(t.encode(errors="replace")) for t in tokens], dtype=np.uint64)
    n = max(1, len(each) - words + 1)
    out = np.zeros(n, np.uint64)
    for k in range(min(words, len(each))):
        # An odd factor for each place: the order of the words counts.
        out = (out ^ each[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return np.unique(out)


class MinHashForest:
    """MinHash values by multiply-add hashes of 32 bits."""

    def __init__(self, trees: int, depth: int, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.trees, self.depth = trees, depth
        n = trees * depth
        self.factor = (rng.integers(1, 1 << 32, n, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
        self.shift = rng.integers(0, 1 << 32, n, dtype=np.uint64).astype(np.uint32)

    def nodes(self, hashes: np.ndarray) -> list[int]:
        """For each tree, the hash of its number and of the label's prefix."""
        low = (hashes ^ (hashes >> np.uint64(32))).astype(np.uint32)
        values = np.empty(len(self.factor), np.uint32)
        for k, (a, b) in enumerate(zip(self.factor, self.shift, strict=True)):
            mixed = low * a + b
            mixed ^= mixed >> np.uint32(15)
            values[k] = (mixed * np.uint32(0x85EBCA6B)).min()
        labels = values.reshape(self.trees, self.depth)
        return [xxhash.xxh3_64_intdigest(row.tobytes(), seed=t) - (1 << 63) for t, row in enumerate(labels)]


def signatures(docs: DataFrame, depth: int, words: int = WORDS, trees: int = TREES) -> DataFrame:
    """doc_id, digest of the shingle set (null without words) and the forest's nodes of its labels."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = MinHashForest(trees, depth)
        for batch in batches:
            digests, nodes = [], []
            for text in batch.column(1):
                s = shingles(text.as_py(), words)
                digests.append(hashlib.md5(s.tobytes()).digest() if len(s) else None)
                nodes.append(forest.nodes(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(digests, pa.binary()), pa.array(nodes, pa.list_(pa.int64()))],
                names=["doc_id", "digest", "nodes"],
            )

    narrow = in_small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null")
    return narrow.mapInArrow(run, "doc_id long, digest binary, nodes array<long>")


def shared_counts(a: list[np.ndarray], b: list[np.ndarray] | None = None) -> np.ndarray:
    """Sizes of the intersections of sorted sets, within ``a`` or between ``a`` and ``b``."""
    both = a if b is None else a + b
    flat = np.concatenate(both)
    owner = np.repeat(np.arange(len(both)), [len(s) for s in both])
    names, at, n = np.unique(flat, return_inverse=True, return_counts=True)
    keep = n[at] > 1
    # Only hashes of two sets or more have a column.
    number = np.cumsum(n > 1) - 1
    owner, at = owner[keep], number[at[keep]]
    order = np.argsort(at, kind="stable")
    owner, at = owner[order], at[order]
    rows, columns = len(a), len(b) if b is not None else len(a)
    out = np.zeros((rows, columns), np.float32)
    width = int(number[-1]) + 1 if len(number) else 0
    for first in range(0, width, SLICE):
        lo, hi = np.searchsorted(at, [first, first + SLICE])
        m = np.zeros((len(both), min(SLICE, width - first)), np.float32)
        m[owner[lo:hi], at[lo:hi] - first] = 1
        out += m[:rows] @ (m[rows:].T if b is not None else m.T)
    return out


def linked(a: list[np.ndarray], b: list[np.ndarray] | None, similarity: float) -> np.ndarray:
    """Whether sets are as similar as asked; within ``a`` each pair once."""
    common = shared_counts(a, b)
    size_a = np.array([len(s) for s in a], dtype=float)
    size_b = size_a if b is None else np.array([len(s) for s in b], dtype=float)
    # The quotient in double precision, as anyone would compute it.
    out = common.astype(float) / (size_a[:, None] + size_b[None, :] - common) >= similarity
    return np.triu(out, 1) if b is None else out


def _verify(pdf: pd.DataFrame, words: int, similarity: float) -> pd.DataFrame:
    """Links of one task: whole small groups, or two blocks of a large one."""
    pdf = pdf.sort_values(["rep", "text"], kind="stable").drop_duplicates("rep", ignore_index=True)
    ids, weights = pdf["rep"].to_numpy(), pdf["size"].to_numpy(dtype=float)
    sets = [shingles(t, words) for t in pdf["text"]]
    counts, forest = np.zeros(len(pdf)), Forest(ids)
    for _, at in sorted(pdf.groupby("component", sort=False).indices.items()):
        blocks = pdf["block"].to_numpy()[at]
        first, second = int(pdf["first"].iloc[at[0]]), int(pdf["second"].iloc[at[0]])
        if first == second:
            add_links(linked([sets[i] for i in at], None, similarity), at, at, weights, counts, forest)
        else:
            rows, columns = at[blocks == first], at[blocks == second]
            if len(rows) and len(columns):
                found = linked([sets[i] for i in rows], [sets[i] for i in columns], similarity)
                add_links(found, rows, columns, weights, counts, forest)
    some = counts > 0
    return pd.DataFrame({"rep": ids[some], "n": counts[some].astype(np.int64), "root": forest.roots()[some]})


def candidate_groups(reps: DataFrame) -> DataFrame:
    """node (a class) and component of all classes that meet another one in the forest."""
    places = reps.select("rep", F.explode("nodes").alias("node"))
    heads = written(
        places.groupBy("node").agg(F.min("rep").alias("head"), F.max("rep").alias("last")).where("head < last"), "heads"
    )
    # A class next to the same head in many trees is one edge.
    edges = places.join(heads.select("node", "head"), "node").where("rep <> head")
    return components(edges.select(F.col("rep").alias("a"), F.col("head").alias("b")))


def verified(docs: DataFrame, groups: DataFrame, classes: DataFrame, words: int, similarity: float) -> DataFrame:
    """rep, n (documents linked, copies counted) and root (smallest class of its tree) for each task's links."""
    sizes = groups.groupBy("component").agg(F.count("*").alias("members"))
    total = groups.count()
    bins = max(1, total // BLOCK)
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    sized = written(
        groups.join(sizes, "component")
        .withColumn("blocks", blocks)
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .join(classes.select(F.col("rep").alias("node"), "size"), "node")
        .select(F.col("node").alias("rep"), "component", "blocks", "block", "size"),
        "groups",
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("rep"), "text")
    placed = sized.join(texts, "rep").withColumn("partner", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    first, second = F.least("block", "partner"), F.greatest("block", "partner")
    small = F.concat(F.lit("bin"), F.pmod(F.xxhash64("component"), F.lit(bins)))
    large = F.concat_ws(":", "component", first, second)
    tasks = placed.select(
        F.when(F.col("blocks") == 1, small).otherwise(large).alias("task"),
        "rep", "component", "block", first.alias("first"), second.alias("second"), "size", "text",
    )

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        return _verify(pdf, words, similarity)

    return tasks.groupBy("task").applyInPandas(run, "rep long, n long, root long")


def join(docs: DataFrame, similarity: float = SIMILARITY, words: int = WORDS, recall: float = RECALL) -> DataFrame:
    """One row per document: doc_id, class_id, n_links, component_id and kept.

    ``class_id`` is the smallest doc_id with the same shingles, ``n_links`` the
    number of other documents (rows) as similar as asked, ``component_id`` the
    smallest doc_id that links lead to; ``kept`` marks that document.
    """
    signed = written(signatures(docs, depth_for(recall, similarity), words), "signatures")
    classes = written(
        signed.where("digest is not null").groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count("*").alias("size")),
        "classes",
    )
    members = written(signed.select("doc_id", "digest").join(classes, "digest"), "members").select("doc_id", "rep", "size")
    reps = signed.join(classes.select("digest", F.col("rep").alias("doc_id")), ["digest", "doc_id"], "left_semi")
    groups = written(candidate_groups(reps.select(F.col("doc_id").alias("rep"), "nodes")), "candidates")
    found = written(verified(docs, groups, classes, words, similarity), "links")
    counts = written(found.groupBy("rep").agg(F.sum("n").alias("n")), "counts")
    roots = written(
        components(found.select(F.col("rep").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "rep"), "roots"
    )
    joined = members.join(counts, "rep", "left").join(roots, "rep", "left")
    component = F.coalesce("component", "rep")
    with_words = joined.select(
        "doc_id",
        F.col("rep").alias("class_id"),
        (F.col("size") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
        component.alias("component_id"),
        (F.col("doc_id") == component).alias("kept"),
    )
    alone = signed.where("digest is null").select(
        "doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"),
        F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"),
    )
    return with_words.unionByName(alone)
