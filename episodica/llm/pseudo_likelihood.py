"""Masked pseudo-likelihood of documents by a bidirectional window network.

Every token is predicted from the ``REACH`` tokens on either side of it, itself
masked. A token is a word: the most frequent words of all documents have ids of
their own, all others share ids by hash. Inputs are summed from one table per
place in the window, one hidden layer follows, and the output is a softmax over
groups of ids times a softmax within the group. The ids grow with the root of
the number of distinct words. With the table of all word counts, a word that
shares its id adds the logarithm of its share in its class, so that every word
of the corpus has a probability of its own. A class keeps as many tokens for
unseen words as it has words seen once, shared by as many unseen words as it
has known ones; so an unseen word is never likelier than one seen once. A
document's score is the sum of its tokens' conditional log-probabilities.

All documents are learned from: word counts are summed over the corpus, every
text is coded as ids once and written, then in every round each partition of
the coded texts trains its own copy of the network on all of its tokens, in
even steps, and the copies are averaged, weighted by tokens: each leaves its task as
a few binary pieces, which are added in a tree of small groups. The frequent
words, the totals of the classes and the averaged parameters come to the driver,
as many as there are ids; the word counts stay a table, which is joined to those
words of the documents that are not among the SHARED most frequent ones.

Null and empty texts have no tokens, the sum 0 and no mean. Repeated rows are
learned from and scored each. An empty table gives an empty table. Extra
columns are dropped.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from episodica.llm.common import in_small_batches, written

REACH, GROUPS, HIDDEN = 2, 32, 16
# Ids: 0 is the padding, the frequent words follow, the last quarter are hash classes. So many at least.
IDS = GROUPS * GROUPS
# Ids for each root of the number of distinct words.
IDS_PER_ROOT = 2
ROUNDS, BATCH, RATE = 2, 8192, 0.05
# Words and counts, about 20 MB, that a task holds before it hands them on.
COUNTED = 1_000_000
# Words whose ids a worker remembers; the others are hashed again.
KNOWN = 300_000
# Words without an id of their own whose counts each worker holds, the most frequent ones; the others are joined.
SHARED = 200_000
# Tokens that are coded, held for training or scored at once, about.
STRETCH = 16_384
# Parameters in a piece of a copy, and pieces that are added at once.
PIECE, FAN = 65_536, 32
# Logits over the groups that are held at once: few enough for a core's cache and for the fast products of small matrices.
SLAB = 32_768
# Powers of two in a power of e.
TWOS = np.float32(1 / math.log(2))
# Sums of powers of two of logits within this bound neither overflow nor vanish.
SAFE = 85.0
# Bytes that a worker may keep for its next arrays instead of giving them back.
KEPT = 24 << 20


def ids_for(distinct: int) -> int:
    """Number of ids for so many distinct words: whole groups, IDS at least."""
    return max(IDS, GROUPS * math.ceil(IDS_PER_ROOT * math.sqrt(distinct) / GROUPS))


class Vocabulary(dict):
    """Word to id; words that are not frequent get the id of their hash class."""

    def __init__(self, known: Mapping[str, int] = {}, size: int = IDS):
        super().__init__(known)
        self.size, self.frequent = size, size - size // 4
        self.classes = size - 1 - self.frequent

    def __missing__(self, word: str) -> int:
        out = 1 + self.frequent + zlib.crc32(word.encode(errors="replace")) % self.classes
        if len(self) < KNOWN:
            self[word] = out
        return out

    def ids(self, text: str | None) -> np.ndarray:
        words = (text or "").split()
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


def keep_freed() -> None:
    """Let this process keep the memory of freed arrays: a step's arrays otherwise get new pages each time, a sixth of its time.

    glibc's allocator keeps as much as the largest block that was freed; this one is never touched.
    """
    np.empty(KEPT, np.uint8)


def by_value(ids: np.ndarray) -> np.ndarray:
    """Order of ids by value, equal ones as they come; short integers are sorted by their digits."""
    return np.argsort(ids.astype(np.uint16) if len(ids) and ids.max() < 1 << 16 else ids, kind="stable")


def windows(texts: Iterable[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Targets and their windows (places x tokens) for texts as ids, padded at their ends."""
    gap = np.zeros(REACH, np.int64)
    parts = [gap]
    for t in texts:
        parts += [t, gap]
    line = np.concatenate(parts)
    at = np.flatnonzero(line)
    places = [k for k in range(-REACH, REACH + 1) if k]
    return line[at], np.stack([line[at + k] for k in places])


def steps(n: int) -> list[slice]:
    """``n`` tokens in even steps of about BATCH, so that none is left with a few tokens and the work of a whole step."""
    many = max(1, round(n / BATCH))
    return [slice(n * i // many, n * (i + 1) // many) for i in range(many if n else 0)]


@dataclass
class WindowNetwork:
    """Parameters: tables of the places, bias, weights of the groups and within them."""

    tables: np.ndarray
    bias: np.ndarray
    group: np.ndarray
    group_bias: np.ndarray
    within: np.ndarray
    within_bias: np.ndarray

    @staticmethod
    def start(counts: np.ndarray, seed: int = 5) -> WindowNetwork:
        """Small random weights, and output biases at the ids' share of all tokens."""
        rng = np.random.default_rng(seed)
        small = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
        share, groups = np.log(counts + 1.0).reshape(-1, GROUPS), len(counts) // GROUPS
        group = np.log(np.exp(share).sum(axis=1))
        return WindowNetwork(
            small(2 * REACH, len(counts), HIDDEN), np.zeros(HIDDEN, np.float32), small(HIDDEN, groups), group.astype(np.float32),
            small(groups, HIDDEN, GROUPS), (share - group[:, None]).astype(np.float32),
        )

    def parts(self) -> list[np.ndarray]:
        return [self.tables, self.bias, self.group, self.group_bias, self.within, self.within_bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts()])

    def shaped(self, flat: np.ndarray) -> WindowNetwork:
        out, at = [], 0
        for p in self.parts():
            out.append(flat[at : at + p.size].reshape(p.shape).astype(np.float32))
            at += p.size
        return WindowNetwork(*out)

    def hidden(self, window: np.ndarray) -> np.ndarray:
        z = self.tables[0].take(window[0], axis=0)
        for p in range(1, len(window)):
            z += self.tables[p].take(window[p], axis=0)
        z += self.bias
        return np.tanh(z, out=z)

    @staticmethod
    def safe(weights: np.ndarray) -> bool:
        """Whether no logit leaves SAFE: hidden units lie within one, so it is at most the sum of its weights' absolute values."""
        return bool(np.abs(weights).sum(axis=-2).max() <= SAFE)

    @staticmethod
    def powers(z: np.ndarray, safe: bool) -> tuple[np.ndarray, np.ndarray | float]:
        """Two to each row of logits less its peak, in place, and the peaks; where logits are safe, all peaks count as 0."""
        peak = 0.0
        if not safe:
            peak = z.max(axis=1)
            z -= peak[:, None]
        return np.exp2(z, out=z), peak

    def joint(self) -> tuple[np.ndarray, np.ndarray]:
        """The output weights of the groups and within them, each with its bias as a last row.

        They are scaled so that logits count in powers of two, which numpy computes faster than those of e.
        """
        return (
            np.concatenate([self.group, self.group_bias[None]]) * TWOS,
            np.concatenate([self.within, self.within_bias[:, None]], axis=1) * TWOS,
        )

    def extents(self, group: np.ndarray) -> list[tuple[int, int, int]]:
        """Group and bounds of its tokens, which are sorted by group, for all groups that have any."""
        ends = np.searchsorted(group, np.arange(len(self.group_bias) + 1)).tolist()
        return [(g, a, b) for g, (a, b) in enumerate(zip(ends, ends[1:], strict=False)) if a < b]

    def slabs(self, n: int) -> list[slice]:
        """Runs of tokens that have about SLAB logits over the groups."""
        run = max(64, SLAB // len(self.group_bias))
        return [slice(i, i + run) for i in range(0, n, run)]

    def units(self, window: np.ndarray) -> np.ndarray:
        """The hidden units of each token, and a one for the bias."""
        return np.append(self.hidden(window), np.ones((window.shape[1], 1), np.float32), axis=1)

    def log_prob(self, target: np.ndarray, window: np.ndarray) -> np.ndarray:
        """Log-probability of each target given its window."""
        order = by_value(target // GROUPS)
        group, place = np.divmod(target[order], GROUPS)
        h, (outer, inner), line = self.units(window[:, order]), self.joint(), np.arange(len(target))
        own, ones = np.empty(len(target)), np.ones(max(len(self.group_bias), GROUPS), np.float32)
        safe = self.safe(outer)
        for at in self.slabs(len(target)):
            z = h[at] @ outer
            own[at] = z[line[: len(z)], group[at]]
            z, peak = self.powers(z, safe)
            own[at] -= np.log2(z @ ones[: z.shape[1]]) + peak
        z = np.empty((len(target), GROUPS), np.float32)
        for g, a, b in self.extents(group):
            np.matmul(h[a:b], inner[g], out=z[a:b])
        own += z[line, place]
        z, peak = self.powers(z, self.safe(inner))
        own -= np.log2(z @ ones[:GROUPS]) + peak
        out = np.empty(len(target))
        out[order] = own * math.log(2)
        return out

    def train(self, target: np.ndarray, window: np.ndarray, square: list[np.ndarray]) -> None:
        """One step of adaptive gradient descent; ``square`` holds the sums of squared gradients.

        A softmax's slope is its shares less one at the token's own place. The shares are never formed:
        what is summed over tokens is divided by the sums of powers first. Rows of the tables that
        no window names have the slope zero and stay.
        """
        n = len(target)
        order = by_value(target // GROUPS)
        target, window = target[order], window.take(order, axis=1)
        group, place = np.divmod(target, GROUPS)
        h, (outer, inner) = self.units(window), self.joint()
        extents = self.extents(group)
        seen, starts = [g for g, _, _ in extents], [a for _, a, _ in extents]

        # A last column of ones: a product with it also sums the powers.
        weights = np.append(self.group.T, np.ones((outer.shape[1], 1), np.float32), axis=1)
        to_outer, dh, safe = np.zeros_like(outer), np.empty((n, HIDDEN), np.float32), self.safe(outer)
        for slab in self.slabs(n):
            z, _ = self.powers(h[slab] @ outer, safe)
            back = z @ weights
            over = 1 / back[:, -1:]
            to_outer += (h[slab] * over).T @ z
            np.multiply(back[:, :-1], over, out=dh[slab])
        to_outer[:, seen] -= np.add.reduceat(h, starts, axis=0).T
        dh -= weights[:, :-1].take(group, axis=0)

        z, ones_within = np.empty((n, GROUPS), np.float32), np.ones((GROUPS, 1), np.float32)
        for g, a, b in extents:
            np.matmul(h[a:b], inner[g], out=z[a:b])
        z, _ = self.powers(z, self.safe(inner))
        z /= z @ ones_within
        z[np.arange(n), place] -= 1
        to_inner, back, turned = np.zeros_like(inner), np.empty_like(dh), np.ascontiguousarray(self.within.transpose(0, 2, 1))
        for g, a, b in extents:
            np.matmul(h[a:b].T, z[a:b], out=to_inner[g])
            np.matmul(z[a:b], turned[g], out=back[a:b])
        dh += back
        h = np.ascontiguousarray(h[:, :-1])
        dh *= 1 - h * h

        # One sum by id for each hidden unit; ``slot`` numbers the rows that are named.
        units, slot = np.ascontiguousarray(dh.T, dtype=float), np.empty(self.tables.shape[1], np.int64)
        for table, sums, ids in zip(self.tables, square[0], window, strict=True):
            rows = np.flatnonzero(np.bincount(ids, minlength=len(table)))
            slot[rows] = np.arange(len(rows))
            ids = slot.take(ids)
            slope = np.empty((len(rows), HIDDEN), np.float32)
            for k, unit in enumerate(units):
                slope[:, k] = np.bincount(ids, unit, len(rows))
            slope /= n
            own = sums.take(rows, axis=0) + slope * slope
            sums[rows] = own
            table[rows] = table.take(rows, axis=0) - RATE * slope / (np.sqrt(own) + 1e-6)
        slopes = [dh.sum(axis=0), to_outer[:-1], to_outer[-1], to_inner[:, :-1], to_inner[:, -1]]
        for value, slope, sums in zip(self.parts()[1:], slopes, square[1:], strict=True):
            slope = slope / n
            sums += slope * slope
            value -= RATE * slope / (np.sqrt(sums) + 1e-6)


def _stretches(texts: Iterable, stretch: int) -> Iterator[list]:
    """Texts as words or ids, gathered to stretches of about so many tokens."""
    held, n = [], 0
    for text in texts:
        held.append(text)
        n += len(text)
        if n >= stretch:
            yield held
            held, n = [], 0
    if held:
        yield held


def _width(words: Vocabulary) -> str:
    """Type of an id in a coded text."""
    return "<u2" if words.size <= 1 << 16 else "<u4"


def word_counts(docs: DataFrame) -> DataFrame:
    """word and n over all documents."""

    def added(held: list[pa.Table]) -> pa.Table:
        sums = pa.concat_tables(held).group_by("word", use_threads=False).aggregate([("n", "sum")])
        return sums.select(["word", "n_sum"]).rename_columns(["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        n = 0
        for batch in batches:
            # Texts split where str.split does, with empty words at their ends.
            words = pc.list_flatten(pc.utf8_split_whitespace(batch.column(0))).value_counts()
            table = pa.table([words.field(0), words.field(1)], names=["word", "n"])
            held.append(table.filter(pc.not_equal(table["word"], "")))
            n += len(held[-1])
            if n >= COUNTED:
                held = [added(held)]
                n = len(held[0])
                if n >= COUNTED // 2:
                    yield from held[0].to_batches()
                    held, n = [], 0
        if held:
            yield from added(held).to_batches()

    return in_small_batches(docs).select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def counted(docs: DataFrame) -> DataFrame:
    """word and n over all documents, written: one row for each distinct word."""
    return written(word_counts(docs), "word_counts")


@dataclass
class Coded:
    """Texts as ids, one row each as ``_coded`` gives them, with their vocabulary and the counts of its ids."""

    words: Vocabulary
    start: np.ndarray
    rows: DataFrame
    unseen: np.ndarray


def coded(docs: DataFrame, counts: DataFrame) -> Coded:
    """All texts of ``docs`` as ids, for ``fit`` and ``score``; ``counts`` is ``counted(docs)``."""
    words, start = _vocabulary(counts)
    return Coded(words, start, *_coded(docs, words, counts))


def _vocabulary(table: DataFrame) -> tuple[Vocabulary, np.ndarray]:
    """The vocabulary, and a count for each id."""
    size = ids_for(table.count())
    words = Vocabulary(size=size)
    top = table.orderBy(F.desc("n"), "word").limit(words.frequent).collect()
    words.update((r["word"], 1 + i) for i, r in enumerate(top))
    start = np.zeros(size)
    start[1 : 1 + len(top)] = [r["n"] for r in top]
    # The hash classes start at the count of the rarest frequent word.
    start[1 + words.frequent :] = top[-1]["n"] if top else 1
    return words, start


def fit(docs: DataFrame | Coded, rounds: int = ROUNDS, counts: DataFrame | None = None) -> tuple[Vocabulary, WindowNetwork]:
    """The frequent words and the network, learned from all of ``docs``; ``counts`` is ``counted(docs)``."""
    if isinstance(docs, Coded):
        words, start, rows = docs.words, docs.start, docs.rows
    else:
        words, start = _vocabulary(counted(docs) if counts is None else counts)
        rows, _ = _coded(docs, words)
    network = WindowNetwork.start(start)
    for _ in range(rounds):
        network = _round(rows, words, network)
    return words, network


def _added(pieces: pd.DataFrame) -> bytes:
    return np.sum([np.frombuffer(v) for v in pieces["value"]], axis=0).tobytes()


def summed(pieces: DataFrame) -> DataFrame:
    """``pieces`` (part, piece, value: binary doubles) with one row for each piece, their sum, added FAN at a time."""
    parts = pieces.agg(F.max("part")).first()[0] or 0

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"part": [key[0]], "piece": [key[1]], "value": [_added(rows)]})

    while parts:
        parts //= FAN
        above = pieces.withColumn("part", F.expr(f"part div {FAN}").cast("int"))
        pieces = above.groupBy("part", "piece").applyInPandas(run, PIECES)
    return pieces


PIECES = "part int, piece int, value binary"


def _round(rows: DataFrame, words: Vocabulary, network: WindowNetwork) -> WindowNetwork:
    width, begin = _width(words), network.flat()
    size = len(begin)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_freed()
        own, n = network.shaped(begin.copy()), 0
        square = [np.zeros_like(p) for p in own.parts()]
        texts = (np.frombuffer(ids.as_buffer(), width).astype(np.int64) for batch in batches for ids in batch.column(0))
        for held in _stretches(texts, STRETCH):
            target, window = windows(held)
            order = np.random.default_rng(len(target)).permutation(len(target))
            for step in steps(len(target)):
                at = order[step]
                own.train(target[at], window.take(at, axis=1), square)
            n += len(target)
        if n:
            flat = np.append(own.flat().astype(float) * n, n)
            part, firsts = TaskContext.get().partitionId(), range(0, size + 1, PIECE)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part] * len(firsts), pa.int32()), pa.array(range(len(firsts)), pa.int32()),
                    pa.array([flat[i : i + PIECE].tobytes() for i in firsts], pa.binary()),
                ],
                names=["part", "piece", "value"],
            )

    pieces = written(rows.select("ids").mapInArrow(run, PIECES), "copies")
    sums = summed(pieces).orderBy("piece").select("value").collect()
    if not sums:
        return network
    total = np.frombuffer(b"".join(r["value"] for r in sums))
    return network.shaped(total[:-1] / total[-1])


def _classes(words: Vocabulary, counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Logarithms for every class: of all its tokens, unseen ones included, and of the count that stands for an unseen word."""
    rare = F.broadcast(counts.sparkSession.createDataFrame([(w,) for w, i in words.items() if i <= words.frequent], "word string"))
    # One row for each class.
    rows = (
        counts.join(rare, "word", "left_anti")
        .groupBy((F.crc32("word") % words.classes).cast("int").alias("class"))
        .agg(F.sum("n"), F.count("*"), F.count_if(F.col("n") == 1))
        .collect()
    )
    n, distinct, once = np.zeros((3, words.classes))
    for c, *values in rows:
        n[c], distinct[c], once[c] = values
    return np.log(n + once + 1), np.log((once + 1) / (distinct + 1))


def _rates(words: Vocabulary, counts: DataFrame) -> dict[str, float]:
    """Logarithm of the count of the SHARED most frequent words without an id of their own."""
    top = counts.orderBy(F.desc("n"), "word").limit(words.frequent + SHARED).toArrow()
    logs = np.log(top.column("n").to_numpy()).tolist()
    return {w: x for w, x in zip(top.column("word").to_pylist(), logs, strict=True) if words.get(w, words.size) > words.frequent}


CODED = "row long, doc_id long, n_tokens long, ids binary, shared double, rare array<string>, times array<long>"


def _coded(docs: DataFrame, words: Vocabulary, counts: DataFrame | None = None) -> tuple[DataFrame, np.ndarray]:
    """Every text as ids, written. Rows have numbers of their own: those that repeat are learned from and scored each.

    With ``counts`` also the sum of the logarithms of its words' shares in their classes, as far as each worker
    holds their counts, and the other words with their times, for which that sum has only the classes' part; and
    the classes' logarithms of the count that stands for an unseen word.
    """
    known, size, width, rates = dict(words), words.size, _width(words), {}
    id_of, weight, unseen = np.arange(size), np.zeros(size), np.zeros(words.classes)
    if counts is not None:
        total, unseen = _classes(words, counts)
        rates = _rates(words, counts)
        mates = np.fromiter(map(Vocabulary(known, size).__getitem__, rates), np.int64, len(rates))
        weight[1 + words.frequent :] = -total
        weight = np.append(weight, np.fromiter(rates.values(), float, len(rates)) + weight[mates])
        id_of = np.append(id_of, mates)
    # Words whose counts are held have codes from ``size`` on.
    known.update(zip(rates, range(size, size + len(rates)), strict=True))
    joined = counts is not None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(known, size)
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            sizes, ids, shared, rare, times = [], [], [], [], []
            for held in _stretches(((text.as_py() or "").split() for text in batch.column("text")), STRETCH):
                ends = np.cumsum([0] + [len(t) for t in held])
                flat = list(chain.from_iterable(held))
                codes = np.fromiter(map(vocabulary.__getitem__, flat), np.int64, len(flat))
                narrow = id_of.take(codes).astype(width)
                owner = np.repeat(np.arange(len(held)), np.diff(ends))
                shared += np.bincount(owner, weight.take(codes), minlength=len(held)).tolist()
                sizes += np.diff(ends).tolist()
                others = np.flatnonzero((codes > vocabulary.frequent) & (codes < size)) if joined else np.zeros(0, np.int64)
                bounds = np.searchsorted(others, ends).tolist()
                others, ends = others.tolist(), ends.tolist()
                for i in range(len(held)):
                    left = Counter([flat[k] for k in others[bounds[i] : bounds[i + 1]]])
                    rare.append(list(left))
                    times.append(list(left.values()))
                    ids.append(narrow[ends[i] : ends[i + 1]].tobytes())
            columns = [
                pa.array(range(row, row + len(ids)), pa.int64()), batch.column("doc_id"),
                pa.array(sizes, pa.int64()), pa.array(ids, pa.binary()), pa.array(shared, pa.float64()),
                pa.array(rare, pa.list_(pa.string())), pa.array(times, pa.list_(pa.int64())),
            ]
            row += len(ids)
            yield pa.RecordBatch.from_arrays(columns, names=["row", "doc_id", "n_tokens", "ids", "shared", "rare", "times"])

    id_column = F.col("doc_id").cast("long") if "doc_id" in docs.columns else F.lit(None).cast("long")
    narrow = in_small_batches(docs).select(id_column.alias("doc_id"), "text")
    return written(narrow.mapInArrow(run, CODED), "coded"), unseen


def score(docs: DataFrame | Coded, words: Vocabulary, network: WindowNetwork, counts: DataFrame | None = None) -> DataFrame:
    """doc_id, n_tokens, log_prob (sum over tokens) and mean_log_prob of every whole text.

    With ``counts`` (see ``counted``) the probability is that of the word;
    without, that of its id, where words of one class are not told apart.
    """
    rows, unseen = (docs.rows, docs.unseen) if isinstance(docs, Coded) else _coded(docs, words, counts)
    width = _width(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_freed()
        for batch in batches:
            sums: list[float] = []
            texts = (np.frombuffer(ids.as_buffer(), width).astype(np.int64) for ids in batch.column("ids"))
            for held in _stretches(texts, STRETCH):
                target, window = windows(held)
                each = np.concatenate(
                    [np.zeros(0)]
                    + [network.log_prob(target[i : i + STRETCH], window[:, i : i + STRETCH]) for i in range(0, len(target), STRETCH)]
                )
                owner = np.repeat(np.arange(len(held)), [len(t) for t in held])
                sums += np.bincount(owner, each, minlength=len(held)).tolist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), batch.column("n_tokens"), pa.array(sums, pa.float64()), batch.column("shared")],
                names=["row", "doc_id", "n_tokens", "log_prob", "shared"],
            )

    narrow = in_small_batches(rows).select("row", "doc_id", "n_tokens", "ids", "shared")
    out = narrow.mapInArrow(run, "row long, doc_id long, n_tokens long, log_prob double, shared double")
    if counts is not None:
        each = rows.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x"))
        each = each.select("row", F.col("x.rare").alias("word"), F.col("x.times").alias("times"))
        of_unseen = F.array(*map(F.lit, unseen.tolist()))
        of_class = F.get(of_unseen, (F.crc32("word") % words.classes).cast("int"))
        shares = (
            each.join(counts, "word", "left")
            .groupBy("row")
            .agg(F.sum(F.col("times") * F.coalesce(F.log("n"), of_class)).alias("shares"))
        )
        out = out.join(shares, "row", "left")
        out = out.withColumn("log_prob", F.col("log_prob") + F.col("shared") + F.coalesce("shares", F.lit(0.0)))
    mean = F.when(F.col("n_tokens") > 0, F.col("log_prob") / F.col("n_tokens"))
    return out.select("doc_id", "n_tokens", "log_prob", mean.alias("mean_log_prob"))
