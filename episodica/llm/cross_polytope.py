"""Approximate nearest neighbours by cross-polytope hashing.

A table of the index turns unit vectors by a fast pseudo-rotation (three rounds
of random signs and a Hadamard transform) and files each under its nearest
signed axis. A query visits, in every table, the ``probes`` axes nearest to it.
Buckets are cut into parts by their counted size, their queries too, and each
pair of parts is one task, which ranks its candidates exactly and returns the
nearest ones of every query; the best of all tasks are the answer. A query that
finds fewer than asked visits all axes of one table, that is, every vector.

Vectors that are null, empty, zero or hold null or non-finite components take
no part; those of another length are no candidates. A row is never its own
candidate: candidates with the query's id are left out. Repeated rows of one
id count once, by the nearest; of a repeated query the least vector asks. Ties go to the smaller vec_id. Rows without vec_id are dropped. An
empty table gives an empty table. Extra columns are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from episodica.llm.common import written
from episodica.llm.epsilon_join import unit, usable

TABLES, PROBES, NEIGHBOURS, SEED = 8, 16, 5, 11
# Vectors, and queries, of a bucket in one task.
BLOCK, QUERY_BLOCK = 8192, 1024
# Candidates within this of the last place are ranked again.
MARGIN = 1e-9


class Rotations:
    """Pseudo-rotations of vectors of one length, padded with zeros to a power of two."""

    def __init__(self, length: int, tables: int = TABLES, seed: int = SEED):
        self.size = 1 << max(1, (length - 1).bit_length())
        self.signs = np.random.default_rng([seed, length]).choice([-1.0, 1.0], (tables, 3, self.size))

    def hadamard(self, x: np.ndarray) -> np.ndarray:
        h = 1
        while h < self.size:
            pairs = x.reshape(len(x), -1, 2, h)
            x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(x), -1)
            h *= 2
        return x / np.sqrt(self.size)

    def turned(self, x: np.ndarray, table: int) -> np.ndarray:
        """Closeness of each row to the axes: first the positive ones, then the negative."""
        y = np.pad(x, ((0, 0), (0, self.size - x.shape[1])))
        for signs in self.signs[table]:
            y = self.hadamard(y * signs)
        return np.hstack([y, -y])

    def axes(self, x: np.ndarray, table: int, probes: int) -> np.ndarray:
        """The nearest ``probes`` axes of each row, nearest first."""
        close = self.turned(x, table)
        if probes == 1:
            return close.argmax(axis=1)[:, None]
        return np.argsort(-close, axis=1, kind="stable")[:, :probes]


def hashed(df: DataFrame, tables: int, probes: int) -> DataFrame:
    """vec_id, length, embedding and buckets (table * 2^20 + axis), without vectors that take no part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rotations: dict[int, Rotations] = {}
        for batch in batches:
            ids, values = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            units = [unit(v) for v in values]
            for length in sorted({len(u) for u in units if u is not None}):
                at = [i for i, u in enumerate(units) if u is not None and len(u) == length]
                r = rotations.setdefault(length, Rotations(length, tables))
                x = np.stack([units[i] for i in at])
                buckets = np.hstack([(t << 20) + r.axes(x, t, min(probes, 2 * r.size)) for t in range(tables)])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([ids[i] for i in at], pa.int64()), pa.array([length] * len(at), pa.int32()),
                        pa.array([values[i] for i in at], pa.list_(pa.float64())),
                        pa.array(buckets.tolist(), pa.list_(pa.int64())),
                    ],
                    names=["vec_id", "length", "embedding", "buckets"],
                )

    return df.mapInArrow(run, "vec_id long, length int, embedding array<double>, buckets array<long>")


def _parts(rows: DataFrame, block: int, name: str) -> DataFrame:
    """Number of parts of every bucket; tables times axes rows for each length of vectors."""
    return rows.groupBy("length", "bucket").agg(F.ceil(F.count("*") / block).cast("int").alias(name))


def _nearest(queries: pd.DataFrame, vectors: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k nearest vectors of each query of a task, exactly."""
    ids, names = vectors["vec_id"].to_numpy(), queries["vec_id"].to_numpy()
    out: list[tuple[int, int, float]] = []
    if len(ids) and len(names):
        x, q = np.stack(vectors["embedding"].to_numpy()), np.stack(queries["embedding"].to_numpy())
        norms_x, norms_q = np.sqrt((x * x).sum(axis=1)), np.sqrt((q * q).sum(axis=1))
        close = (q @ x.T) / norms_q[:, None] / norms_x[None, :]
        close[names[:, None] == ids[None, :]] = -np.inf
        # Rows of one id count by their nearest, so that they take one place among the k.
        by_id = np.argsort(ids, kind="stable")
        starts = np.flatnonzero(np.append(True, np.diff(ids[by_id]) != 0))
        for i, row in enumerate(close):
            best = row if len(starts) == len(ids) else np.maximum.reduceat(row[by_id], starts)
            n = min(k, int((best > -np.inf).sum()))
            if not n:
                continue
            last = np.partition(best, len(best) - n)[len(best) - n]
            at = np.flatnonzero(row >= last - MARGIN)
            # Equal vectors get equal scores: products of one pair are summed by themselves.
            exact = (x[at] * q[i]).sum(axis=1) / (norms_x[at] * norms_q[i])
            seen: set[int] = set()
            for j in np.lexsort([ids[at], -exact]):
                if ids[at][j] not in seen:
                    seen.add(ids[at][j])
                    out.append((names[i], ids[at][j], exact[j]))
                if len(seen) == n:
                    break
    return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])


def _search(vectors: DataFrame, queries: DataFrame, tables: int, probes: int, k: int) -> DataFrame:
    """The k nearest of every query among the vectors that it meets in some bucket."""
    kinds = [F.col("vec_id"), F.col("length"), F.col("embedding")]
    filed = written(hashed(vectors, tables, 1), "filed")
    # Of a repeated id's rows the least vector asks, the shorter one first.
    least = F.min(F.struct(F.size("embedding").alias("length"), "embedding")).alias("least")
    queries = queries.groupBy("vec_id").agg(least).select("vec_id", F.col("least.embedding").alias("embedding"))
    asked = written(hashed(queries, tables, probes), "asked")
    filed = filed.select(*kinds, F.explode("buckets").alias("bucket"))
    asked = asked.select(*kinds, F.explode("buckets").alias("bucket"))
    # Bounded by the tables' axes.
    parts = F.broadcast(
        written(
            _parts(filed, BLOCK, "parts").join(_parts(asked, QUERY_BLOCK, "query_parts"), ["length", "bucket"]), "bucket_parts"
        )
    )
    key = ["length", "bucket", "part", "query_part"]
    own = lambda n: F.pmod(F.xxhash64("vec_id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = (
        asked.join(parts, ["length", "bucket"]).withColumn("query_part", own("query_parts")).withColumn("part", every("parts"))
    )
    right = (
        filed.join(parts, ["length", "bucket"]).withColumn("part", own("parts")).withColumn("query_part", every("query_parts"))
    )

    def run(q: pd.DataFrame, v: pd.DataFrame) -> pd.DataFrame:
        return _nearest(q, v, k)

    columns = [*key, "vec_id", "embedding"]
    pairs = left.select(*columns).groupBy(*key).cogroup(right.select(*columns).groupBy(*key))
    found = pairs.applyInPandas(run, "query_id long, vec_id long, score double")
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(vectors: DataFrame, is_query: Column, k: int = NEIGHBOURS, tables: int = TABLES, probes: int = PROBES) -> DataFrame:
    """query_id, rank, vec_id and score (cosine) of the nearest vectors of every row that ``is_query`` marks."""
    fit = usable(
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    ).where("vec_id is not null")
    queries = fit.where(is_query)
    first = written(_search(fit, queries, tables, probes, k), "nearest")
    short = written(
        queries.join(first.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id")), "vec_id", "left_anti"), "short"
    )
    order = ["query_id", "rank", "vec_id", "score"]
    if short.isEmpty():
        return first.select(order)
    # All axes of one table are every vector once.
    again = _search(fit, short, 1, 1 << 20, k)
    kept = first.join(short.select(F.col("vec_id").alias("query_id")), "query_id", "left_anti")
    return kept.select(order).unionByName(again.select(order))
