"""Exact k nearest neighbours as a pruned block join.

Training rows are assigned to the nearest of about sqrt(rows) pivots, so that
both the cells and their rows grow with the square root of the data. A query is
compared with its own cell first: the k-th distance there bounds the true one, and
the triangle inequality rules out cells that cannot hold a nearer row. Neighbouring
cells are packed into blocks of bounded size, dense ones cut into several, and the
queries of a block into chunks, so a query is sent once to a block however many
cells of it are in reach. A task compares one block with one chunk: a matrix product
finds the few rows within the bound, whose distances are then summed exactly.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.feature import BucketedRandomProjectionLSH
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from episodica.session import cut_lineage

# Upper limits; smaller data is cut finer, so that all cores have work.
BLOCK_ROWS = 60_000
CHUNK_ROWS = 60_000
TILE_ROWS = 256
SLACK = 1e-6


def _distances(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, float]:
    """Euclidean distances by one matrix product, and the most that they are off."""
    middle = b.mean(axis=0)
    a, b = a - middle, b - middle
    aa, bb = np.einsum("ij,ij->i", a, a), np.einsum("ij,ij->i", b, b)
    off = 8 * (a.shape[1] + 4) * np.finfo(float).eps * (aa.max(initial=0) + bb.max(initial=0))
    return np.sqrt(np.maximum(aa[:, None] + bb - 2 * (a @ b.T), 0)), math.sqrt(off)


def _matrix(series: pd.Series) -> np.ndarray:
    return np.array(series.tolist(), dtype="float64")


def _tiles(vectors: pd.Series) -> Iterator[np.ndarray]:
    for start in range(0, len(vectors), TILE_ROWS):
        yield _matrix(vectors.iloc[start : start + TILE_ROWS])


def _packed(centers: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """Number of each cell's pack: cells along the main axis of the centers, at most ``size`` rows together."""
    along = np.argsort((centers - centers.mean(axis=0)) @ np.linalg.svd(centers - centers.mean(axis=0), full_matrices=False)[2][0])
    pack, number, held = np.empty(len(counts), np.int64), 0, 0
    for cell in along:
        if held and held + counts[cell] > size:
            number, held = number + 1, 0
        pack[cell], held = number, held + counts[cell]
    return pack


def k_nearest(
    train: DataFrame,
    queries: DataFrame,
    k: int,
    key: str = "key",
    vector: str = "vector",
    label: str = "label",
    exclude_self: bool = False,
    pivots: int | None = None,
) -> DataFrame:
    """The k nearest training rows of every query: (query, key, label, distance, place).

    Order is distance rounded to six digits, then key. ``exclude_self`` skips the
    training rows that have the query's own key. Vectors that are null or hold null
    or non-finite components have no neighbours and are none.
    """
    usable = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = train.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("vector"), F.col(label).alias("label")).filter(usable)
    asks = queries.select(F.col(key).alias("query"), F.col(vector).cast("array<double>").alias("vector")).filter(usable)
    schema = (
        f"query {dict(asks.dtypes)['query']}, key {dict(rows.dtypes)['key']}, "
        f"label {dict(rows.dtypes)['label']}, distance double"
    )
    total = rows.count()
    if not total:
        return rows.sparkSession.createDataFrame([], f"{schema}, place int")
    wanted = pivots or max(1, math.isqrt(total))
    # About sqrt(rows) vectors reach the driver, and later one count per cell.
    chosen = rows.orderBy(F.xxhash64("key"), "key").limit(wanted).select("vector").collect()
    pivot = np.array([r["vector"] for r in chosen], dtype="float64")

    @F.pandas_udf("struct<cell:int,away:double>")
    def nearest_pivot(vectors: pd.Series) -> pd.DataFrame:
        parts = []
        for tile in _tiles(vectors):
            cell = _distances(tile, pivot)[0].argmin(axis=1)
            away = np.sqrt(np.square(tile - pivot[cell]).sum(axis=1))
            parts.append(pd.DataFrame({"cell": cell.astype("int32"), "away": away}))
        return pd.concat(parts, ignore_index=True) if parts else pd.DataFrame({"cell": [], "away": []})

    placed = cut_lineage(
        rows.withColumn("_p", nearest_pivot("vector")).select("key", "vector", "label", "_p.cell", "_p.away")
    )
    cells = {r["cell"]: (r["n"], r["radius"]) for r in placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("away").alias("radius")).collect()}
    ids = np.array(sorted(cells))
    centers = pivot[ids]
    counts = np.array([cells[c][0] for c in ids])
    radii = np.array([cells[c][1] for c in ids])
    # Rows that a query skips do not count towards its bound.
    own_rows = rows.groupBy("key").count().agg(F.max("count")).first()[0] if exclude_self else 0
    need = k + own_rows

    cores = rows.sparkSession.sparkContext.defaultParallelism
    parts = math.ceil(math.sqrt(4 * cores))
    block_rows = max(1, min(BLOCK_ROWS, math.ceil(total / parts)))
    pack = _packed(centers, counts, block_rows)

    @F.pandas_udf("struct<cell:int,bound:double>")
    def nearest_cell(vectors: pd.Series) -> pd.DataFrame:
        out = []
        for tile in _tiles(vectors):
            d, off = _distances(tile, centers)
            far = d + radii + off
            by_far = np.argsort(far, axis=1, kind="stable")
            enough = np.cumsum(counts[by_far], axis=1) >= need
            bound = np.take_along_axis(far, by_far, axis=1)[np.arange(len(d)), enough.argmax(axis=1)]
            bound = np.where(enough.any(axis=1), bound, np.inf)
            out.append(pd.DataFrame({"cell": ids[d.argmin(axis=1)].astype("int32"), "bound": bound}))
        return pd.concat(out, ignore_index=True) if out else pd.DataFrame({"cell": [], "bound": []})

    @F.pandas_udf("array<int>")
    def packs_in_reach(vectors: pd.Series, bounds: pd.Series) -> pd.Series:
        out, start = [], 0
        for tile in _tiles(vectors):
            d, off = _distances(tile, centers)
            keep = d - radii <= bounds.to_numpy()[start : start + len(d), None] + SLACK + off
            out += [np.unique(pack[row]).astype("int32").tolist() for row in keep]
            start += len(d)
        return pd.Series(out, dtype=object)

    def own(column: str, count: str):
        return F.pmod(F.xxhash64(column), F.col(count)).cast("int")

    def every(count: str):
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    def parts_of(df: DataFrame, group: str, size: int, name: str) -> DataFrame:
        return df.groupBy(group).agg(F.ceil(F.count("*") / size).cast("int").alias(name))

    packs = F.broadcast(rows.sparkSession.createDataFrame([(int(c), int(p)) for c, p in zip(ids, pack)], "cell int, pack int"))
    held = placed.join(packs, "cell")
    chunk_rows = max(1, min(CHUNK_ROWS, math.ceil(total / parts)))
    blocks = parts_of(held, "pack", block_rows, "blocks")
    # First each query meets one block of its own pack.
    asked = cut_lineage(asks.withColumn("_c", nearest_cell("vector")).select("query", "vector", "_c.cell", "_c.bound").join(packs, "cell"))
    # One row per pack that has rows and queries.
    sizes = F.broadcast(blocks.join(parts_of(asked, "pack", chunk_rows, "chunks"), "pack"))
    first = held.join(sizes, "pack").filter(own("key", "blocks") == 0)
    first = first.select("pack", "cell", "key", "vector", "label", every("chunks").alias("chunk"))
    kept = asked.select("query", "vector", "cell", "bound")
    reach = centers, radii, ids

    def bounded(asking: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        out = asking[["query", "vector", "cell", "bound"]].reset_index(drop=True)
        best = out["bound"].to_numpy().copy()
        for at, _, distance in _found_in_block(asking, block, k, exclude_self, own_rows, reach):
            # Pairs are ordered by query; the last of k is the farthest.
            full = np.arange(len(at)) - np.searchsorted(at, at) == k - 1
            best[at[full]] = np.minimum(best[at[full]], distance[full] + SLACK)
        return out.assign(bound=best)

    on = ["pack", "chunk"]
    left = asked.join(sizes, "pack").select(*asked.columns, own("query", "chunks").alias("chunk"))
    near = left.groupBy(*on).cogroup(first.groupBy(*on)).applyInPandas(bounded, kept.schema)
    sent = cut_lineage(near.select("query", "vector", "cell", "bound", F.explode(packs_in_reach("vector", "bound")).alias("pack")))

    sizes = F.broadcast(blocks.join(parts_of(sent, "pack", chunk_rows, "chunks"), "pack"))
    left = sent.join(sizes, "pack").select(*sent.columns, own("query", "chunks").alias("chunk"), every("blocks").alias("block"))
    right = held.join(sizes, "pack").select(
        "pack", "cell", "key", "vector", "label", own("key", "blocks").alias("block"), every("chunks").alias("chunk")
    )

    def nearest_in_block(asking: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame(columns=["query", "key", "label", "distance"])]
        names, keys, labels = (c.to_numpy() for c in (asking["query"], block["key"], block["label"]))
        for at, found, distance in _found_in_block(asking, block, k, exclude_self, own_rows, reach):
            out.append(pd.DataFrame({"query": names[at], "key": keys[found], "label": labels[found], "distance": distance}))
        return pd.concat(out[1:] or out, ignore_index=True)

    on = ["pack", "block", "chunk"]
    found = left.groupBy(*on).cogroup(right.groupBy(*on)).applyInPandas(nearest_in_block, schema)
    order = Window.partitionBy("query").orderBy(F.round("distance", 6), "key")
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def near_by_projection(
    train: DataFrame, queries: DataFrame, k: int, radius: float, bucket_length: float, tables: int = 8, seed: int = 0
) -> DataFrame:
    """Approximate neighbours within ``radius``, by bucketed random projections; columns as in k_nearest.

    Reads (key, vector, label) and (query, vector). A neighbour that shares no
    bucket with the query is missed; more tables and longer buckets miss fewer.
    """
    rows = train.select("key", "label", array_to_vector(F.col("vector").cast("array<double>")).alias("features"))
    asks = queries.select("query", array_to_vector(F.col("vector").cast("array<double>")).alias("features"))
    lsh = BucketedRandomProjectionLSH(
        inputCol="features", outputCol="hashes", bucketLength=bucket_length, numHashTables=tables, seed=seed
    ).fit(rows)
    near = lsh.approxSimilarityJoin(rows, asks, radius, "distance").select(
        F.col("datasetB.query").alias("query"), F.col("datasetA.key").alias("key"),
        F.col("datasetA.label").alias("label"), "distance",
    )
    order = Window.partitionBy("query").orderBy(F.round("distance", 6), "key")
    return near.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def _found_in_block(
    asking: pd.DataFrame,
    block: pd.DataFrame,
    k: int,
    exclude_self: bool,
    own_rows: int,
    reach: tuple[np.ndarray, np.ndarray, np.ndarray],
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per tile of queries: positions of queries and block rows, and distances, for the nearest k within each query's bound.

    Pairs are ordered by query, rounded distance and key. ``reach`` has centers, radii and
    numbers of all cells: rows of cells that no query of a tile reaches are passed over.
    """
    if asking.empty or block.empty:
        return
    centers, radii, ids = reach
    cells = np.searchsorted(ids, block["cell"].to_numpy())
    by_cell = np.argsort(cells, kind="stable")
    here, counts = np.unique(cells, return_counts=True)
    keys = block["key"].to_numpy()[by_cell]
    rank = np.empty(len(keys), np.int64)
    rank[np.argsort(keys, kind="stable")] = np.arange(len(keys))
    names, bounds, own = (asking[c].to_numpy() for c in ("query", "bound", "cell"))
    points, asked = _matrix(block["vector"])[by_cell], _matrix(asking["vector"])
    middle = points.mean(axis=0)
    local, moved = points - middle, asked - middle
    norms, squares = (np.einsum("ij,ij->i", m, m) for m in (local, moved))
    kind = np.float32 if max(norms.max(), squares.max()) < 1e6 else np.float64
    # The product of (a, 1) and (b, -b.b/2) is larger the nearer b is to a.
    sides = np.hstack([local, -norms[:, None] / 2]).astype(kind)
    asides = np.hstack([moved, np.ones((len(moved), 1))]).astype(kind)
    offs = 8 * (points.shape[1] + 8) * float(np.finfo(kind).eps) * (squares + norms.max())
    by_coordinate = np.ascontiguousarray(points.T)
    del points, local, moved
    kth, turn = k + own_rows, np.argsort(own, kind="stable")
    for start in range(0, len(asking), TILE_ROWS):
        at = np.sort(turn[start : start + TILE_ROWS])
        limit, square, off = np.square(bounds[at] + 2 * SLACK), squares[at], offs[at]

        def tightened(limit: np.ndarray, product: np.ndarray) -> np.ndarray:
            """The bounds that follow from the ``kth`` nearest of these rows."""
            if product.shape[1] < kth:
                return limit
            edge = np.partition(product, product.shape[1] - kth, axis=1)[:, product.shape[1] - kth].astype(np.float64)
            return np.minimum(limit, np.square(np.sqrt(np.maximum(square - 2 * edge + off, 0)) + 2 * SLACK))

        mine = np.isin(ids[here], own[at])
        if mine.any() and not mine.all():
            limit = tightened(limit, asides[at] @ sides[np.repeat(mine, counts)].T)
        d, error = _distances(asked[at], centers[here])
        near = (d - radii[here] <= np.sqrt(limit)[:, None] + SLACK + error).any(axis=0)
        if not near.any():
            continue
        rows = np.flatnonzero(np.repeat(near, counts))
        product = asides[at] @ (sides if near.all() else sides[rows]).T
        for again in (True, False):
            with np.errstate(over="ignore"):
                hits = product >= ((square - limit - off) / 2).astype(kind)[:, None]
            if not again or np.count_nonzero(hits) <= 4 * kth * len(at):
                break
            limit = tightened(limit, product)
        query, found = np.nonzero(hits)
        found = rows[found]
        if exclude_self:
            other = names[at[query]] != keys[found]
            query, found = query[other], found[other]
        # Summed coordinate by coordinate.
        exact = np.zeros(len(query))
        for x, y in zip(asked[at].T, by_coordinate):
            exact += np.square(x[query] - y[found])
        exact = np.sqrt(exact)
        rounded = np.round(exact, 6)
        order = np.lexsort((rank[found], rounded, query))
        order = order[np.isfinite(rounded[order])]
        query = query[order]
        first = np.arange(len(query)) - np.searchsorted(query, query) < k
        yield at[query[first]], by_cell[found[order[first]]], exact[order[first]]


def vote_shares(neighbours: DataFrame, weights: str = "uniform") -> DataFrame:
    """Share of the neighbours' votes per query and label.

    ``uniform`` gives every neighbour one vote, ``distance`` a vote of 1/distance;
    neighbours at distance zero then outvote all others.
    """
    if weights == "distance":
        exact = F.max(F.when(F.col("distance") == 0, 1).otherwise(0)).over(Window.partitionBy("query"))
        vote = F.when(F.col("_exact") == 1, F.when(F.col("distance") == 0, 1.0).otherwise(0.0)).otherwise(
            F.try_divide(F.lit(1.0), F.col("distance"))
        )
        voted = neighbours.withColumn("_exact", exact).withColumn("vote", vote)
    else:
        voted = neighbours.withColumn("vote", F.lit(1.0))
    votes = voted.groupBy("query", "label").agg(F.sum("vote").alias("votes"))
    total = F.sum("votes").over(Window.partitionBy("query"))
    return votes.withColumn("share", F.col("votes") / total).drop("votes")


def predicted_label(shares: DataFrame) -> DataFrame:
    """The label with the largest share; ties go to the smallest label."""
    best = F.min(F.struct((-F.round("share", 9)).alias("rank"), "label", "share"))
    return shares.groupBy("query").agg(best.alias("best")).select(
        "query", F.col("best.label").alias("predicted"), F.col("best.share").alias("share")
    )
