"""Blocks of sparse rows, which passes over the data read as arrays, and sums of vectors over all tasks.

A block holds the rows of one Arrow batch: labels, weights, and the non-zero
entries as (row, code, value), ordered by code. A pass sends small parameters
to every task and returns one vector for each; vectors are added in the tasks
of a second step where there are many, so the driver gets a bounded number.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Vectors that the driver adds by itself.
FEW_VECTORS = 64
SCHEMA = "label binary, weight binary, row binary, code binary, value binary"


def entries(vectors: pa.StructArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """row, feature and value of the non-zero entries of a column of ML vectors, sparse or dense."""
    values = vectors.field("values")
    lengths = pc.fill_null(pc.list_value_length(values), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    feature = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    sparse = vectors.field("type").to_numpy(zero_copy_only=False) == 0
    feature[sparse[row]] = vectors.field("indices").flatten().to_numpy(zero_copy_only=False)
    value = values.flatten().to_numpy(zero_copy_only=False)
    real = value != 0
    return row[real], feature[real], value[real]


@dataclass
class Block:
    label: np.ndarray
    weight: np.ndarray
    row: np.ndarray
    code: np.ndarray
    value: np.ndarray

    def record(self) -> pa.RecordBatch:
        parts = {
            "label": self.label.astype(np.int8), "weight": self.weight.astype(np.float64), "row": self.row.astype(np.int32),
            "code": self.code.astype(np.int32), "value": self.value.astype(np.float64),
        }
        return pa.RecordBatch.from_arrays([pa.array([p.tobytes()], pa.binary()) for p in parts.values()], names=list(parts))

    @staticmethod
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
        kinds = {"label": np.int8, "weight": np.float64, "row": np.int32, "code": np.int32, "value": np.float64}
        for batch in batches:
            for i in range(batch.num_rows):
                yield Block(**{k: np.frombuffer(batch.column(k)[i].as_py(), t) for k, t in kinds.items()})


def blocks(rows: DataFrame, code: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """Blocks of ``rows`` (columns features and label, 0 or 1), with weights of one.

    ``code`` maps features and values of entries to codes and values.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, feature, value = entries(batch.column(0))
            codes, values = code(feature, value)
            order = np.argsort(codes, kind="stable")
            label = batch.column(1).to_numpy(zero_copy_only=False) > 0.5
            yield Block(label, np.ones(len(label)), row[order], codes[order], values[order]).record()

    return rows.select("features", F.col("label").cast("double")).mapInArrow(run, SCHEMA)


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        for v in batch.column(0):
            vector = np.frombuffer(v.as_py())
            total = vector if total is None else total + vector
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["vector"])


class Passes:
    """A kept table of blocks, and sums over it."""

    def __init__(self, table: DataFrame):
        self.table = table.persist()
        self.parts = self.table.rdd.getNumPartitions()

    def vector_sum(self, size: int, add: Callable[[Block, np.ndarray], None]) -> np.ndarray:
        """Sum over all blocks of what ``add`` adds to a vector of ``size``, in one pass."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(size)
            for block in Block.read(batches):
                add(block, total)
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["vector"])

        vectors = self.table.mapInArrow(run, "vector binary")
        if self.parts > FEW_VECTORS:
            vectors = vectors.repartition(math.isqrt(self.parts)).mapInArrow(_added, "vector binary")
        return sum((np.frombuffer(r["vector"]) for r in vectors.collect()), np.zeros(size))

    def close(self) -> None:
        self.table.unpersist()
