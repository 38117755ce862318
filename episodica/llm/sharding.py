"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Documents of one text form a group that stays together. Groups enter, the
largest first, the bin with the least room that still holds them; a balanced
tree over the rooms finds it. ``fewest`` needs as few shards of a fixed
capacity as that heuristic gives; ``assign`` asks for a number of shards and
finds the least capacity with which the heuristic needs no more, so that the
shards are as even as whole groups allow. A group larger than an even share
has a shard of its own, and the others share the rest.

No task and no driver sees all groups: cells of about ``PER_CELL`` groups, cut
by hash, are packed into bundles by the same heuristic, bundles into larger
ones, until at most a few times ``BUNDLES`` for each shard are left; these are
packed in the driver. Groups have a 64-bit hash of their text as key; texts
that collided would merely stay together.

Sizes are the text's bytes and ``OVERHEAD`` for each document. Null texts have
the size of empty ones and are in their group. Repeated rows are documents of
their own. Slots number a shard's documents in the order of doc_id, nulls
first, then of rows. An empty table gives an empty table.
"""

from __future__ import annotations

import random
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from episodica.llm.common import written
from episodica.operators.ordering import add_position

OVERHEAD = 16
# Groups that a task packs at once, bundles for each shard, and bundles that a cell makes at most from small ones.
PER_CELL, BUNDLES, PER_CELL_BUNDLES = 50_000, 128, 1024
# Steps of the search for the least capacity.
STEPS = 24


class Rooms:
    """Bins ordered by (room, bin) in a treap, a tree that random priorities keep balanced."""

    def __init__(self) -> None:
        self.root: list | None = None
        self.rng = random.Random(7)

    @classmethod
    def _split(cls, node: list | None, key: tuple[int, int]) -> tuple[list | None, list | None]:
        """The nodes below ``key``, and the others."""
        if node is None:
            return None, None
        if node[0] < key:
            node[3], rest = cls._split(node[3], key)
            return node, rest
        rest, node[2] = cls._split(node[2], key)
        return rest, node

    @classmethod
    def _join(cls, low: list | None, high: list | None) -> list | None:
        if low is None or high is None:
            return low or high
        if low[1] > high[1]:
            low[3] = cls._join(low[3], high)
            return low
        high[2] = cls._join(low, high[2])
        return high

    def put(self, room: int, number: int) -> None:
        low, high = self._split(self.root, (room, number))
        self.root = self._join(self._join(low, [(room, number), self.rng.random(), None, None]), high)

    def take_tightest(self, size: int) -> tuple[int, int] | None:
        """Take out the bin with the least room for ``size``; None if no bin has so much."""
        found, node = None, self.root
        while node is not None:
            if node[0][0] >= size:
                found, node = node[0], node[2]
            else:
                node = node[3]
        if found is not None:
            low, high = self._split(self.root, found)
            self.root = self._join(low, self._split(high, (found[0], found[1] + 1))[1])
        return found


def best_fit(sizes: Iterable[int], capacity: int, bins: int | None = None) -> list[int] | None:
    """The bin of each of ``sizes``, which descend; what is larger than a bin has one alone.

    None as soon as more than ``bins`` are needed.
    """
    rooms, out, n = Rooms(), [], 0
    for size in sizes:
        found = rooms.take_tightest(size)
        if found is None:
            found, n = (max(capacity, size), n), n + 1
            if bins is not None and n > bins:
                return None
        out.append(found[1])
        rooms.put(found[0] - size, found[1])
    return out


def level_fit(sizes: list[int], bins: int) -> list[int]:
    """The bin of each of ``sizes``, which descend, in at most ``bins`` bins of the least capacity found."""
    alone, left = 0, sum(sizes)
    while alone < len(sizes) and alone < bins - 1 and sizes[alone] * (bins - alone) >= left:
        left -= sizes[alone]
        alone += 1
    rest, n = sizes[alone:], bins - alone
    if not rest:
        return list(range(alone))
    low = max(rest[0], -(-left // n))
    # No bin that is left out can have had less room than the largest item, so this capacity is enough.
    high, best = low + rest[0], None
    while best is None:
        best, high = best_fit(rest, high, n), 2 * high
    high //= 2
    for _ in range(STEPS):
        if low >= high:
            break
        middle = (low + high) // 2
        found = best_fit(rest, middle, n)
        if found is None:
            low = middle + 1
        else:
            high, best = middle, found
    return [*range(alone), *(alone + b for b in best)]


def group_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def size_of(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long")


def _packed(items: DataFrame, cells: int, capacity: int) -> DataFrame:
    """item, size and bundle: best fit within each cell."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["size", "item"], ascending=[False, True])
        bins = best_fit(rows["size"].tolist(), capacity)
        return pd.DataFrame({"item": rows["item"], "size": rows["size"], "bundle": [(key[0] << 32) + b for b in bins]})

    cell = F.pmod(F.xxhash64("item", F.lit(cells)), F.lit(cells)).alias("cell")
    return items.select("item", "size", cell).groupBy("cell").applyInPandas(run, "item long, size long, bundle long")


def _levels(groups: DataFrame, capacity_of: int) -> Iterator[DataFrame]:
    """Tables of item, size and bundle, each of which packs the bundles of the one before; the last has few.

    ``capacity_of`` is the share of a shard that a bundle may hold.
    """
    items = groups
    while True:
        n, total = items.agg(F.count("*"), F.sum("size")).first()
        cells = max(1, -(-n // PER_CELL))
        few = max(1, (total or 0) // (cells * PER_CELL_BUNDLES))
        packed = written(_packed(items, cells, min(capacity_of, few)), "bundles")
        yield packed
        items = packed.groupBy(F.col("bundle").alias("item")).agg(F.sum("size").alias("size"))
        if cells == 1 or few >= capacity_of:
            return


def _shards_of_groups(groups: DataFrame, capacity_of: int, fit) -> DataFrame:
    """key and shard of every group; ``fit`` gives the bins of descending sizes."""
    levels = list(_levels(groups.select(F.col("key").alias("item"), "size"), capacity_of))
    # As many rows as bundles: a small multiple of the number of shards, and one for each cell.
    last = levels[-1].groupBy("bundle").agg(F.sum("size").alias("size")).orderBy(F.desc("size"), "bundle").collect()
    bins = fit([r["size"] for r in last])
    spark = groups.sparkSession
    found = spark.createDataFrame([(r["bundle"], b) for r, b in zip(last, bins, strict=True)], "bundle long, shard int")
    for level in reversed(levels):
        found = level.join(found, "bundle").select(F.col("item").alias("bundle"), "shard")
    return written(found.withColumnRenamed("bundle", "key"), "shards_of_groups")


def _with_slots(docs: DataFrame, shards: DataFrame, groups_key: Column) -> DataFrame:
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), size_of(F.col("text")).alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"), groups_key.alias("key"),
        F.monotonically_increasing_id().alias("row"),
    )
    # Row numbers have to stay the same for all who read them.
    placed = written(written(rows, "rows").join(shards, "key").drop("key"), "placed")
    slots = add_position(placed, ["shard"], [F.col("doc_id"), F.col("row")], "slot")
    return slots.select("doc_id", "size", "text_crc32", "shard", "slot")


def _groups(docs: DataFrame) -> DataFrame:
    sizes = docs.select(group_key(F.col("text")).alias("key"), size_of(F.col("text")).alias("size"))
    return written(sizes.groupBy("key").agg(F.sum("size").alias("size")), "text_groups")


def shards_for(docs: DataFrame, n_shards: int) -> DataFrame:
    """key (``group_key`` of the text) and shard of every group, in shards 0 to ``n_shards`` - 1 of near equal bytes."""
    groups = _groups(docs)
    total = groups.agg(F.sum("size")).first()[0] or 0
    return _shards_of_groups(groups, max(1, total // (n_shards * BUNDLES)), lambda sizes: level_fit(sizes, n_shards))


def fewest(docs: DataFrame, capacity: int) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot in few shards of at most ``capacity`` bytes; a larger group has one alone."""
    shards = _shards_of_groups(_groups(docs), max(1, capacity // BUNDLES), lambda sizes: best_fit(sizes, capacity))
    return _with_slots(docs, shards, group_key(F.col("text")))


def assign(docs: DataFrame, n_shards: int) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot of every document, in ``n_shards`` shards of near equal bytes."""
    return _with_slots(docs, shards_for(docs, n_shards), group_key(F.col("text")))


def write_shards(docs: DataFrame, n_shards: int, path: str) -> None:
    """Write the documents, all columns, as Parquet with one folder for each shard (``shard=0``, ...)."""
    shards = shards_for(docs, n_shards)
    name = next(c for c in ("shard", "_shard", "__shard") if c not in docs.columns)
    keyed = docs.withColumn("_key", group_key(F.col("text")))
    joined = keyed.join(shards.withColumnsRenamed({"shard": name, "key": "_group"}), F.col("_key") == F.col("_group"))
    joined.drop("_key", "_group").write.partitionBy(name).parquet(path)
