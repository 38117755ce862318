"""Embedding near-dedup by an epsilon grid order join.

Unit vectors of one label are sorted by their grid cells (cells as wide as the
threshold's distance) on the leading principal dimensions. The sequence is cut
into blocks; pairs of blocks whose boxes in those dimensions are further apart
than the distance are provably without links. The others are joined in tasks,
which halve both sequences recursively, skip distant parts in the same way and
compare the rest in double precision. Blocks give link counts and spanning
trees, never the pairs.

Identical vectors of a label are one class. Vectors that are null, empty, zero
or hold null or non-finite components link with nothing, nor do those without a
label; vectors of different lengths do not link. Rows without vec_id are
dropped; rows that repeat one count as vectors each and get the most links and
the smallest component of the id. Two vectors at
exactly the threshold link. An empty table gives an empty table. Extra columns
are dropped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from episodica.llm.blocks import Forest, add_links
from episodica.llm.common import written
from episodica.llm.graph import components

COSINE = 0.98
LEADING = 8
# Vectors that the principal dimensions are fitted on, about; any basis gives the same links.
SAMPLE = 4000
BLOCK, LEAF = 2048, 128
# More than rounding can move a distance by.
SLACK = 1e-6


def unit(values) -> np.ndarray | None:
    """A vector in double precision and of length one; None if it takes no part."""
    if values is None:
        return None
    x = np.array(values, dtype=float)
    norm = np.sqrt((x * x).sum())
    if not len(x) or not np.isfinite(x).all() or not np.isfinite(norm) or norm == 0:
        return None
    return x / norm


def usable(df: DataFrame) -> DataFrame:
    """The rows whose embedding can take part, but for zero vectors."""
    e = F.col("embedding")
    fine = e.isNotNull() & (F.size(e) > 0) & ~F.exists(e, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return df.where(fine)


def principal(df: DataFrame, rows: int = SAMPLE) -> dict[int, np.ndarray]:
    """Leading principal dimensions, for each length of vectors, from about ``rows`` of them."""
    n = df.count()
    if not n:
        return {}
    share = F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, rows / n))
    got = df.where(share).select("embedding").toArrow().column(0).to_pylist()
    by_length: dict[int, list[np.ndarray]] = {}
    for x in filter(lambda x: x is not None, map(unit, got)):
        by_length.setdefault(len(x), []).append(x)
    out = {}
    for length, vectors in by_length.items():
        x = np.stack(vectors)
        x -= x.mean(axis=0)
        out[length] = np.linalg.eigh(x.T @ x)[1][:, ::-1][:, :LEADING]
    return out


def placed(df: DataFrame, axes: dict[int, np.ndarray], cell: float) -> DataFrame:
    """vec_id, label, code (of the vector's bytes), length, place (leading coordinates) and their grid cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for vec_id, label, values in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                x = unit(values)
                if x is None:
                    continue
                basis = axes.get(len(x))
                y = x @ basis if basis is not None else x[:LEADING]
                y = np.pad(y, (0, LEADING - len(y)))
                code = hashlib.md5((np.array(values, dtype=float) + 0.0).tobytes()).digest()
                rows.append((vec_id, label, code, len(x), y.tolist(), np.floor(y / cell).astype(int).tolist(), values))
            columns = list(zip(*rows, strict=True)) or [()] * 7
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(columns[0], pa.int64()), pa.array(columns[1], batch.column(1).type),
                    pa.array(columns[2], pa.binary()), pa.array(columns[3], pa.int32()),
                    pa.array(columns[4], pa.list_(pa.float64())), pa.array(columns[5], pa.list_(pa.int32())),
                    pa.array(columns[6], pa.list_(pa.float64())),
                ],
                names=["vec_id", "label", "code", "length", "place", "cells", "embedding"],
            )

    label = df.schema["label"].dataType.simpleString()
    return df.mapInArrow(
        run,
        f"vec_id long, label {label}, code binary, length int, place array<double>, cells array<int>, embedding array<double>",
    )


def sequence(reps: DataFrame, total: int) -> DataFrame:
    """``reps`` in grid order, cut into blocks of one label: adds ``block``."""
    parts = max(1, total // BLOCK)
    ordered = reps.repartitionByRange(parts, "label", "length", "cells", "vec_id").sortWithinPartitions(
        "label", "length", "cells", "vec_id"
    )
    names, types = ordered.columns, ordered.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block, held, last = TaskContext.get().partitionId() << 32, 0, None
        at = [names.index("label"), names.index("length")]
        for batch in batches:
            out = []
            for key in zip(*(batch.column(i).to_pylist() for i in at), strict=True):
                if key != last or held == BLOCK:
                    block, held, last = block + 1, 0, key
                held += 1
                out.append(block)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.int64())], names=[*names, "block"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in types)
    return ordered.mapInArrow(run, f"{fields}, block long")


def near_blocks(blocks: DataFrame, distance: float) -> DataFrame:
    """first and second of all pairs of blocks that may hold links, each with itself too."""
    axis = range(LEADING)
    boxes = written(
        blocks.groupBy("label", "length", "block").agg(
            *[F.min(F.col("place")[k]).alias(f"lo{k}") for k in axis],
            *[F.max(F.col("place")[k]).alias(f"hi{k}") for k in axis],
            F.min(F.col("cells")[0]).alias("from"),
            F.max(F.col("cells")[0]).alias("to"),
        ),
        "boxes",
    )
    # A block covers its cells of the first dimension and reaches one further on either side.
    left = boxes.select("*", F.explode(F.sequence("from", "to")).alias("cell"))
    right = boxes.select(
        "label", "length", F.explode(F.sequence(F.col("from") - 1, F.col("to") + 1)).alias("cell"),
        F.col("block").alias("other"), F.col("from").alias("other_from"),
        *[F.col(f"{e}{k}").alias(f"other_{e}{k}") for e in ("lo", "hi") for k in axis],
    )
    gap = sum(
        F.pow(F.greatest(F.lit(0.0), F.col(f"lo{k}") - F.col(f"other_hi{k}"), F.col(f"other_lo{k}") - F.col(f"hi{k}")), 2)
        for k in axis
    )
    once = F.col("cell") == F.greatest("from", F.col("other_from") - 1)
    pairs = left.join(right, ["label", "length", "cell"]).where(once & (gap <= distance**2 + SLACK))
    return pairs.where("block <= other").select(F.col("block").alias("first"), F.col("other").alias("second"))


def _compare(
    x: np.ndarray, y: np.ndarray, a: np.ndarray, b: np.ndarray, same: bool, cosine: float, reach: float, found
) -> None:
    """Recursive join of two stretches of the sequence; ``found`` takes rows, columns and their links."""
    lo_a, hi_a, lo_b, hi_b = y[a].min(axis=0), y[a].max(axis=0), y[b].min(axis=0), y[b].max(axis=0)
    gap = np.maximum(0, np.maximum(lo_a - hi_b, lo_b - hi_a))
    if (gap * gap).sum() > reach:
        return
    if max(len(a), len(b)) <= LEAF:
        links = x[a] @ x[b].T >= cosine
        links = np.triu(links, 1) if same else links
        if links.any():
            found(links, a, b)
        return
    halves_a = np.array_split(a, 2) if len(a) > LEAF else [a]
    halves_b = np.array_split(b, 2) if len(b) > LEAF else [b]
    for i, left in enumerate(halves_a):
        for j, right in enumerate(halves_b):
            if not same or i <= j:
                _compare(x, y, left, right, same and i == j, cosine, reach, found)


def links(blocks: DataFrame, pairs: DataFrame, cosine: float, distance: float) -> DataFrame:
    """vec_id, n (vectors linked, copies counted) and root of each task's links."""
    sides = pairs.select("first", "second", F.explode(F.array_distinct(F.array("first", "second"))).alias("block"))
    tasks = blocks.select("block", "vec_id", "size", "place", "embedding").join(sides, "block")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["block", "vec_id"], kind="stable", ignore_index=True)
        x = np.stack(pdf["embedding"].to_numpy()).astype(float)
        x /= np.sqrt((x * x).sum(axis=1))[:, None]
        y, ids = np.stack(pdf["place"].to_numpy()), pdf["vec_id"].to_numpy()
        # The grid order within the blocks.
        order = np.lexsort([ids, *np.floor(y / distance).T[::-1], pdf["block"].to_numpy()])
        weights, counts, forest = pdf["size"].to_numpy(dtype=float), np.zeros(len(pdf)), Forest(ids)
        side = pdf["block"].to_numpy()[order]
        first, second = pdf["first"].iloc[0], pdf["second"].iloc[0]
        a, b = order[side == first], order[side == second]

        def found(linked: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> None:
            add_links(linked, rows, columns, weights, counts, forest)

        if len(a) and len(b):
            _compare(x, y, a, b, first == second, cosine, distance**2 + SLACK, found)
        some = counts > 0
        return pd.DataFrame({"vec_id": ids[some], "n": counts[some].astype(np.int64), "root": forest.roots()[some]})

    return tasks.groupBy("first", "second").applyInPandas(run, "vec_id long, n long, root long")


def near_duplicates(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id (smallest vec_id that links lead to) and kept."""
    distance = float(np.sqrt(2 - 2 * cosine))
    narrow = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").cast("array<double>").alias("embedding")
    ).where("vec_id is not null")
    fit = usable(narrow).where("label is not null")
    at = written(placed(fit, principal(fit), distance), "places")
    classes = written(
        at.groupBy("label", "code").agg(F.min("vec_id").alias("rep"), F.count("*").alias("size")), "vector_classes"
    )
    members = written(at.select("vec_id", "label", "code").join(classes, ["label", "code"]), "vector_members")
    reps = at.join(
        classes.select("label", "code", F.col("rep").alias("vec_id"), "size"), ["label", "code", "vec_id"]
    ).dropDuplicates(["label", "code", "vec_id"])
    blocks = written(sequence(reps.drop("code"), classes.count()), "blocks")
    pairs = written(near_blocks(blocks, distance), "block_pairs")
    found = written(links(blocks, pairs, cosine, distance), "vector_links")
    counts = written(found.groupBy("vec_id").agg(F.sum("n").alias("n")).withColumnRenamed("vec_id", "rep"), "vector_counts")
    roots = components(found.select(F.col("vec_id").alias("a"), F.col("root").alias("b")))
    roots = written(roots.withColumnRenamed("node", "rep"), "vector_roots")
    linked = written(
        members.join(counts, "rep", "left").join(roots, "rep", "left").select(
            F.col("vec_id").alias("id"),
            (F.col("size") - 1 + F.coalesce("n", F.lit(0))).alias("n"),
            F.coalesce("component", "rep").alias("component"),
        ).groupBy("id").agg(F.max("n").alias("n"), F.min("component").alias("component")),
        "linked",
    )
    component = F.coalesce("component", "vec_id")
    return narrow.join(linked, narrow.vec_id == linked.id, "left").select(
        "vec_id",
        F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        (F.col("vec_id") == component).alias("kept"),
    )
