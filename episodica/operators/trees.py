"""Ensembles of many or deep trees, grown whole in tasks that hold the binned rows.

MLlib sends counts for every bin of every open node from each partition, and keeps
all trees on the driver. Here each task reads all rows, as sorted codes of their
entries (2 bytes each up to 65,536 bins), grows its share of the trees level by level,
adds up their scores of the test rows and forgets them. So neither trees nor counts
leave a task, and the driver gets importances only; a task's memory grows with the
rows, not with the trees. A tree's draws follow from its number and the rows alone.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from episodica.operators.boosting import Bins, fit_bins
from episodica.operators.sparse import entries
from episodica.session import cut_lineage

# Limits of one step's arrays: entries of rows, and bins of open nodes.
TILE_ENTRIES, SLOTS, SCORED_ROWS = 1 << 20, 1 << 21, 4096
# Shares of leaves are whole multiples of 2 ** -36, so their sums are the same in any order.
UNIT = float(1 << 36)
KEYS = ["person_id", "episode_id", "label"]
BLOCK = "test boolean, id long, hash binary, label binary, start binary, length binary, code binary, keys binary"


@dataclass(frozen=True)
class Job:
    """Trees ``first`` and on of one ensemble; scores are wanted for each of ``sizes``.

    A forest draws a bootstrap sample of ``sample`` x rows and ``some`` features a node (None: all); a boosted
    sequence has a ``rate``, and its sample is drawn without replacement.
    """

    first: int
    sizes: tuple[int, ...]
    depth: int
    sample: float
    leaf: int = 1
    some: int | None = None
    rate: float | None = None


@dataclass
class Layout:
    """Codes of all bins: feature of a code, first code of a feature, and the code of zero."""

    feature: np.ndarray
    first: np.ndarray
    zero: np.ndarray

    @staticmethod
    def of(bins: Bins) -> Layout:
        first = bins.offsets()
        return Layout(np.repeat(np.arange(len(first) - 1), np.diff(first)), first, bins.zero())


@dataclass
class Rows:
    start: np.ndarray
    code: np.ndarray
    label: np.ndarray

    def length(self, at: np.ndarray) -> np.ndarray:
        return self.start[at + 1] - self.start[at]

    def entries(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Position in ``at`` and code of each entry."""
        lengths = self.length(at)
        where = np.repeat(self.start[at] - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
        return np.repeat(np.arange(len(at)), lengths), self.code[where]

    def codes(self, at: np.ndarray, feature: np.ndarray, layout: Layout) -> np.ndarray:
        """The code of one feature of each row, by binary search in its sorted entries."""
        low, high = self.start[at], self.start[at + 1]
        end, wanted = high, layout.first[feature]
        for _ in range(int(self.length(at).max(initial=0)).bit_length()):
            middle = (low + high) >> 1
            less = (middle < high) & (self.code[np.minimum(middle, len(self.code) - 1)] < wanted)
            low, high = np.where(less, middle + 1, low), np.where(less, high, middle)
        found = self.code[np.minimum(low, len(self.code) - 1)] if len(self.code) else np.zeros(len(at), np.int64)
        return np.where((low < end) & (found < layout.first[feature + 1]) & (found >= wanted), found, layout.zero[feature])


@dataclass
class Grown:
    """Nodes of some trees, roots first; ``feature`` is -1 at leaves, the right child follows the left one."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    value: np.ndarray


def _best_splits(
    rows: Rows, layout: Layout, at: np.ndarray, node: np.ndarray, weight: np.ndarray, target: np.ndarray,
    total: np.ndarray, sums: np.ndarray, leaf: int, chosen: np.ndarray | None,
) -> tuple[np.ndarray, ...]:
    """Per node the feature (-1: none), last code on the left, gain, weight and sum on the left of the best split."""
    count, features = len(total), len(layout.zero)
    if chosen is None:
        chosen = np.broadcast_to(np.arange(features), (count, features))
    some = chosen.shape[1]
    width = (layout.first[chosen + 1] - layout.first[chosen]).ravel()
    base = np.cumsum(width) - width
    size = int(width.sum())
    every = some == features
    table = np.full(count * features, -(1 << 40), np.int64)
    table[(np.arange(count)[:, None] * features + chosen).ravel()] = base - layout.first[chosen].ravel()
    counts, added = np.zeros(size), np.zeros(size)
    step = max(1, int(TILE_ENTRIES // max(1.0, float(rows.length(at).mean()) if len(at) else 1.0)))
    for tile in range(0, len(at), step):
        pair, code = rows.entries(at[tile : tile + step])
        slot = table[(node[tile : tile + step] * features)[pair] + layout.feature[code]] + code
        if not every:
            kept = np.flatnonzero(slot >= 0)
            slot, pair = slot[kept], pair[kept]
        counts += np.bincount(slot, weight[tile : tile + step][pair], size)
        added += np.bincount(slot, target[tile : tile + step][pair], size)
    zero = base + (layout.zero[chosen] - layout.first[chosen]).ravel()
    left = []
    for by_slot, whole in ((counts, total), (added, sums)):
        by_slot[zero] += np.repeat(whole, some) - np.add.reduceat(by_slot, base)
        running = np.cumsum(by_slot)
        left.append(running - np.repeat(running[base] - by_slot[base], width))
    starts = base[::some]
    slots = np.diff(np.append(starts, size))
    right = [np.repeat(whole, slots) - part for part, whole in zip(left, (total, sums), strict=True)]
    with np.errstate(divide="ignore", invalid="ignore"):
        score = left[1] ** 2 / left[0] + right[1] ** 2 / right[0]
    score[(left[0] < leaf) | (right[0] < leaf)] = -np.inf
    top = np.maximum.reduceat(score, starts)
    hits = np.flatnonzero(score == np.repeat(top, slots))[::-1]
    best = np.empty(count, np.int64)
    # The first of equal splits is the last one written.
    best[np.repeat(np.arange(count), slots)[hits]] = hits
    gain = top - sums**2 / total
    place = np.searchsorted(base, best, side="right") - 1
    feature = chosen.ravel()[place]
    last = layout.first[feature] + best - base[place]
    feature = np.where(gain > 1e-10 * total, feature, -1)
    return feature, last, gain, left[0][best], left[1][best]


def grow(
    rows: Rows, layout: Layout, at: np.ndarray, tree: np.ndarray, weight: np.ndarray, target: np.ndarray, job: Job,
    draws: Sequence[np.random.Generator],
) -> tuple[Grown, np.ndarray]:
    """Trees, one for each of ``draws``, on pairs of a row ``at`` and its ``tree``, ascending, and their gains by feature.

    Splits have the largest fall of the target's variance, for targets 0 and 1 that of the Gini impurity. Like MLlib's,
    such trees lose splits whose leaves predict the same class.
    """
    trees, features, two_classes = len(draws), len(layout.zero), job.rate is None
    target, node, owner = weight * target, tree.astype(np.int64), np.arange(trees)
    total, sums = np.bincount(node, weight, trees), np.bincount(node, target, trees)
    nodes: list[tuple[np.ndarray, ...]] = []
    numbered = trees
    for level in range(job.depth + 1):
        count = len(total)
        feature, cut, left = np.full(count, -1), np.zeros(count, np.int64), np.zeros(count, np.int64)
        value = sums / np.maximum(total, 1)
        gain, part = np.zeros(count), np.zeros((2, count))
        divisible = total >= max(2, 2 * job.leaf)
        if two_classes:
            divisible &= (sums > 0) & (sums < total)
        if features == 0 or level == job.depth:
            divisible[:] = False
        if divisible.any():
            if not divisible.all():
                inside = divisible[node]
                at, node, weight, target = at[inside], node[inside], weight[inside], target[inside]
            open_nodes = np.flatnonzero(divisible)
            rank = np.cumsum(divisible) - 1
            some = features if job.some is None else min(job.some, features)
            # Bins of as many features as a node looks at, and a place for each feature.
            step = max(1, SLOTS // max(features, len(layout.feature) * some // features))
            order = np.argsort(node, kind="stable") if step < len(open_nodes) else slice(None)
            ordered = rank[node[order]]
            for a in range(0, len(open_nodes), step):
                own = open_nodes[a : a + step]
                pick = order if isinstance(order, slice) else order[slice(*np.searchsorted(ordered, [a, a + step]))]
                chosen = None if some == features else _chosen(owner[own], draws, features, some)
                found = _best_splits(
                    rows, layout, at[pick], rank[node[pick]] - a, weight[pick], target[pick], total[own], sums[own], job.leaf, chosen
                )
                feature[own], cut[own], gain[own], part[0, own], part[1, own] = found
        split = feature >= 0
        left[split] = numbered + 2 * np.arange(split.sum())
        nodes.append((feature, cut, left, value, gain, owner))
        if not split.any():
            break
        numbered += 2 * int(split.sum())
        goes_on = split[node]
        at, node, weight, target = at[goes_on], node[goes_on], weight[goes_on], target[goes_on]
        on_right = rows.codes(at, feature[node], layout) > cut[node]
        node = 2 * (np.cumsum(split) - 1)[node] + on_right
        owner = np.repeat(owner[split], 2)
        whole, part = np.stack([total, sums])[:, split], part[:, split]
        total, sums = np.stack([part, whole - part], axis=2).reshape(2, -1)
    ends = np.cumsum([0, *(len(n[0]) for n in nodes)])
    feature, cut, left, value, gain, owner = (np.concatenate(c) for c in zip(*nodes))
    for a, b in zip(ends[-2::-1], ends[:0:-1]) if two_classes else ():
        split = a + np.flatnonzero(feature[a:b] >= 0)
        low, high = left[split], left[split] + 1
        alike = (feature[low] < 0) & (feature[high] < 0) & ((value[low] > 0.5) == (value[high] > 0.5))
        feature[split[alike]] = -1
    importance, split = np.zeros((trees, features)), feature >= 0
    np.add.at(importance, (owner[split], feature[split]), gain[split])
    return Grown(feature, cut, left, value), importance


def _chosen(owner: np.ndarray, draws: Sequence[np.random.Generator], features: int, some: int) -> np.ndarray:
    """Features that each node may split, by the draws of its tree."""
    trees, counts = np.unique(owner, return_counts=True)
    drawn = [draws[t].random((n, features), dtype=np.float32) for t, n in zip(trees, counts, strict=True)]
    return np.sort(np.argpartition(np.concatenate(drawn), some - 1, axis=1)[:, :some], axis=1)


def scored(grown: Grown, rows: Rows, layout: Layout, trees: int) -> Iterator[tuple[slice, np.ndarray]]:
    """Values of the leaves that rows reach in each tree, by tiles of rows."""
    features = len(layout.zero)
    for a in range(0, len(rows.label), SCORED_ROWS):
        at = np.arange(a, min(a + SCORED_ROWS, len(rows.label)))
        wide = np.tile(layout.zero, (len(at), 1))
        row, code = rows.entries(at)
        wide[row, layout.feature[code]] = code
        wide = wide.ravel()
        node, place = np.repeat(np.arange(trees), len(at)), np.tile(np.arange(len(at)) * features, trees)
        moving = np.flatnonzero(grown.feature[node] >= 0)
        while len(moving):
            here = node[moving]
            on_right = wide[place[moving] + grown.feature[here]] > grown.cut[here]
            here = grown.left[here] + on_right
            node[moving] = here
            moving = moving[grown.feature[here] >= 0]
        yield slice(a, a + len(at)), grown.value[node].reshape(trees, len(at))


def _forest(job: Job, numbers: Sequence[int], train: Rows, test: Rows, layout: Layout, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums over the leaves' shares of the numbered trees that each size adds to the one before, and importances."""
    out = np.zeros((len(job.sizes), len(test.label)))
    total, count = np.zeros(len(layout.zero)), len(train.label)
    stage = np.searchsorted(job.sizes, numbers, side="right")
    batch = max(1, int(TILE_ENTRIES // max(1, len(train.code) * min(1.0, job.sample))))
    for a in range(0, len(numbers), batch):
        draws = [np.random.default_rng([seed, n]) for n in numbers[a : a + batch]]
        times = np.stack([rng.poisson(job.sample, count) for rng in draws])
        tree, at = np.nonzero(times)
        grown, importance = grow(train, layout, at, tree, times[tree, at].astype(float), train.label[at], job, draws)
        whole = importance.sum(axis=1, keepdims=True)
        total += (importance / np.where(whole > 0, whole, 1)).sum(axis=0)
        own = stage[a : a + batch]
        grown.value = np.round(grown.value * UNIT)
        for place, leaves in scored(grown, test, layout, len(draws)):
            for s in np.unique(own):
                out[s, place] += leaves[own == s].sum(axis=0)
    return out, total


def _boosted(
    job: Job, train: Rows, test: Rows, layout: Layout, start: np.ndarray, margin: np.ndarray, seed: int
) -> tuple[np.ndarray, np.ndarray]:
    """Margins of the test rows at each size, logistic loss; ``start`` and ``margin`` are those of the trees before ``first``."""
    sign, start, margin = np.where(train.label > 0.5, 1.0, -1.0), start.copy(), margin.copy()
    out, total = [], np.zeros(len(layout.zero))
    for number in range(job.first, max(job.sizes)):
        rng = np.random.default_rng([seed, number])
        at = np.flatnonzero(rng.random(len(sign)) < job.sample)
        target = sign if number == 0 else 4 * sign / (1 + np.exp(2 * sign * start))
        grown, importance = grow(train, layout, at, np.zeros(len(at), np.int64), np.ones(len(at)), target[at], job, [rng])
        total += importance[0] / max(importance.sum(), 1e-300)
        step = 1.0 if number == 0 else job.rate
        for rows, sums in ((train, start), (test, margin)):
            for place, leaves in scored(grown, rows, layout, 1):
                sums[place] += step * leaves[0]
        if number + 1 in job.sizes:
            out.append(margin.copy())
    return np.stack(out), total


def _blocks(rows: DataFrame, test: bool, starts: int, bins: Bins) -> DataFrame:
    """One row for each batch of rows: codes of their entries, ascending in each row, and what else a task needs."""
    kind = np.uint16 if bins.offsets()[-1] <= 1 << 16 else np.uint32

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, feature, value = entries(batch.column(0))
            code = bins.code(feature, value)
            order = np.lexsort((code, row))
            length = np.bincount(row, minlength=batch.num_rows).astype(np.int32)
            start = batch.column(3).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            label = batch.column(len(KEYS) + 3).to_numpy(zero_copy_only=False).astype(np.float64)
            keys = pa.RecordBatch.from_arrays(batch.columns[4:], names=KEYS)
            parts = [
                batch.column(2).to_numpy(zero_copy_only=False).astype(np.int64), (label > 0.5).astype(np.float64), start, length,
                code[order].astype(kind),
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([test]), batch.column(1).slice(0, 1), *[pa.array([p.tobytes()], pa.binary()) for p in parts],
                    pa.array([keys.serialize().to_pybytes() if test else None], pa.binary()),
                ],
                names=["test", "id", "hash", "label", "start", "length", "code", "keys"],
            )

    start = F.array(*[F.col(f"_start{i}").cast("double") for i in range(starts)]) if starts else F.array().cast("array<double>")
    asked = rows.select(
        "features", F.monotonically_increasing_id().alias("id"), F.xxhash64(*KEYS[:2]).alias("hash"), start.alias("start"), *KEYS
    )
    return asked.mapInArrow(run, BLOCK)


def _held(blocks: list[dict], starts: int, kind: type) -> tuple[Rows, np.ndarray, np.ndarray]:
    """The rows of some blocks, their starting values and hashes."""
    of = {
        name: np.concatenate([np.frombuffer(b[name], t) for b in blocks] or [np.zeros(0, t)])
        for name, t in (("hash", np.int64), ("label", np.float64), ("start", np.float64), ("length", np.int32), ("code", kind))
    }
    start = np.concatenate([[0], np.cumsum(of["length"], dtype=np.int64)])
    return Rows(start, of["code"], of["label"]), of["start"].reshape(-1, starts), of["hash"]


def _in_order(rows: Rows, start: np.ndarray, hashes: np.ndarray) -> tuple[Rows, np.ndarray]:
    """Rows in an order that follows from them alone, so that draws by place do not depend on partitions."""
    sums = np.concatenate([[0], np.cumsum(rows.code, dtype=np.int64)])
    sums = sums[rows.start[1:]] - sums[rows.start[:-1]]
    order = np.lexsort((sums, rows.length(np.arange(len(hashes))), rows.label, hashes))
    _, code = rows.entries(order)
    lengths = rows.length(order)
    return Rows(np.concatenate([[0], np.cumsum(lengths)]), code, rows.label[order]), start[order]


def more_trees(jobs: Sequence[Job], train: DataFrame, test: DataFrame, seed: int = 0) -> tuple[DataFrame, list[np.ndarray]]:
    """Scores of the test rows (KEYS, job, stage, score) at each size of each job, and each job's importances, summed over trees.

    Columns _start0 and on, one for each job, have what the trees before ``first`` give: of test rows the sum of a
    forest's shares of positives, of both sides a boosted sequence's margin; zero where a column is missing.
    """
    spark, starts = train.sparkSession, len(jobs)
    bins = fit_bins(train)
    layout = Layout.of(bins)
    kind = np.uint16 if len(layout.feature) <= 1 << 16 else np.uint32
    cores = spark.sparkContext.defaultParallelism
    units: list[tuple[int, range]] = []
    for i, job in enumerate(jobs):
        numbers = range(job.first, max(job.sizes))
        parts = 1 if job.rate is not None else min(cores, len(numbers))
        # Every part has trees of all sizes.
        units += [(i, numbers[p::parts]) for p in range(parts)]
    firsts = {units.index(next(u for u in units if u[0] == i)) for i in range(len(jobs))}
    none = {f"_start{i}": F.lit(0.0) for i in range(starts)}
    train, test = (df.withColumns({c: v for c, v in none.items() if c not in df.columns}) for df in (train, test))
    coded = _blocks(train, False, starts, bins).unionByName(_blocks(test, True, starts, bins))
    copied = cut_lineage(coded).withColumn("unit", F.explode(F.sequence(F.lit(0), F.lit(len(units) - 1))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_unit: dict[int, list[dict]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                by_unit.setdefault(row["unit"], []).append(row)
        for unit in sorted(by_unit):
            held = by_unit.pop(unit)
            learn = [b for b in held if not b["test"]]
            asked = sorted((b for b in held if b["test"]), key=lambda b: b["id"])
            which, numbers = units[unit]
            job = jobs[which]
            rows, begin = _in_order(*_held(learn, starts, kind))
            tests, margins, _ = _held(asked, starts, kind)
            sizes = [len(b["length"]) // 4 for b in asked]
            keys = [b["keys"] if unit in firsts else None for b in asked]
            ids = [b["id"] for b in asked]
            del held, learn, asked
            if job.rate is None:
                sums, importance = _forest(job, numbers, rows, tests, layout, seed)
                if unit in firsts:
                    sums[0] += np.round(margins[:, which] * UNIT)
            else:
                sums, importance = _boosted(job, rows, tests, layout, begin[:, which], margins[:, which], seed)
            at = 0
            for number, n, key in zip(ids, sizes, keys, strict=True):
                own = np.ascontiguousarray(sums[:, at : at + n])
                at += n
                yield _result(which, number, own, key)
            yield _result(which, -1, importance, None)

    found = cut_lineage(copied.repartitionById(len(units), "unit").mapInArrow(run, "job int, id long, sums binary, keys binary"))
    importances = [np.zeros(len(layout.zero)) for _ in jobs]
    for r in found.filter("id = -1").select("job", "sums").collect():
        importances[r["job"]] += np.frombuffer(r["sums"])
    return _by_row(found.filter("id >= 0"), jobs, test), importances


def _result(job: int, number: int, sums: np.ndarray, keys: bytes | None) -> pa.RecordBatch:
    parts = [pa.array([job], pa.int32()), pa.array([number], pa.int64()), pa.array([sums.tobytes()], pa.binary()), pa.array([keys], pa.binary())]
    return pa.RecordBatch.from_arrays(parts, names=["job", "id", "sums", "keys"])


def _by_row(found: DataFrame, jobs: Sequence[Job], test: DataFrame) -> DataFrame:
    """Scores by row and size from the tasks' sums over blocks."""
    whole = found.groupBy("job", "id").agg(F.collect_list("sums").alias("sums"), F.first("keys", ignorenulls=True).alias("keys"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                job = jobs[row["job"]]
                keys = pa.ipc.read_record_batch(row["keys"], key_schema)
                sums = sum(np.frombuffer(s) for s in row["sums"]).reshape(len(job.sizes), -1)
                for stage, size in enumerate(job.sizes):
                    score = sums[: stage + 1].sum(axis=0) / UNIT / size if job.rate is None else 1 / (1 + np.exp(-2 * sums[stage]))
                    own = [pa.array(np.full(keys.num_rows, n), pa.int32()) for n in (row["job"], stage)]
                    yield pa.RecordBatch.from_arrays([*keys.columns, *own, pa.array(score)], names=[*KEYS, "job", "stage", "score"])

    kept = test.select(*KEYS).schema
    key_schema = to_arrow_schema(kept)
    more = [T.StructField("job", T.IntegerType()), T.StructField("stage", T.IntegerType()), T.StructField("score", T.DoubleType())]
    return whole.mapInArrow(run, T.StructType([*kept, *more]))
