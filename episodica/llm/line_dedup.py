"""Line dedup by content-defined chunks of lines.

Each line has a hash. A rolling hash over ``WINDOW`` line hashes chooses the
boundaries: a chunk ends after a line whose rolling hash is less than its
predecessor's and not more than its successor's. So a boundary depends on the
lines around it alone, not on their place, and two boundaries are two lines
apart at least.

What goes: two adjacent lines repeat if a document with a smaller doc_id has
them too, or the same text two lines before or earlier. All lines of such pairs
go, that is, maximal runs of repeated lines. Each line that goes stays at an
earlier place.

How it is found: chunks of two lines or more are grouped by the digest of their
bytes; of a chunk that repeats, all pairs but those of its first occurrence
repeat and need no index. The other pairs, also those across boundaries, are
indexed one by one, which extends repeated chunks to maximal runs and finds runs
that share no chunk. One pass over the texts gives all digests; the texts move
once, to meet what repeats in them. There the bytes of repeated chunks and pairs
are compared: a digest of several texts removes nothing, and the pairs of such a
chunk are indexed again.

Null texts stay null, empty texts empty. Documents of one line, and those
without a doc_id, stay as they are. Pairs of white space alone do not repeat.
Rows that share a doc_id count as the same document: what only they share stays
in each. An empty table gives an empty table. Extra columns are kept; columns
named as the results are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from episodica.llm.common import in_small_batches, written

WINDOW, FACTOR, LEAST_LINES = 2, 31, 2
# Digests that are spread over tasks by a broadcast, at most.
HOT = 1000


def chunks(text: str) -> list[str]:
    """The chunks of one text; joined by line feeds they are the text."""
    lines = text.split("\n")
    n = len(lines)
    if n < 2 * LEAST_LINES:
        return [text]
    h = np.array([int(hashlib.md5(x.encode(errors="replace")).hexdigest()[:8], 16) for x in lines], dtype=np.int64)
    roll = h.copy()
    for k in range(1, WINDOW):
        roll[k:] += FACTOR**k * h[:-k]
    inner = (roll[1:-1] < roll[:-2]) & (roll[1:-1] <= roll[2:])
    ends = [int(i) + 2 for i in np.flatnonzero(inner) if i + 2 <= n - LEAST_LINES]
    return ["\n".join(lines[a:b]) for a, b in zip([0, *ends], [*ends, n], strict=True)]


def _shared(chunk: str) -> bool:
    """Whether a chunk may be removed where it repeats."""
    return "\n" in chunk and not chunk.isspace()


def _repeatable(pair: str) -> bool:
    return not pair.isspace()


def md5(text: str) -> bytes:
    return hashlib.md5(text.encode(errors="replace")).digest()


Digest = Callable[[str], bytes]
KEYS = "doc_id long, version long, whole boolean, chunk int, line int, size int, again boolean, key binary"


def _keys_of(text: str, digest: Digest) -> list[tuple]:
    """Of the chunks and of all pairs: whole, chunk, first line, lines, again and digest.

    ``chunk`` is null for a pair across a boundary; ``again`` says that the text has the chunk
    before, or the pair two lines before or earlier.
    """
    rows: list[tuple] = []
    lines, own, seen, at = text.split("\n"), {}, set(), 0
    for no, chunk in enumerate(chunks(text)):
        n = chunk.count("\n") + 1
        own.update(dict.fromkeys(range(at, at + n - 1), no))
        if _shared(chunk):
            key = digest(chunk)
            rows.append((True, no, at, n, key in seen, key))
            seen.add(key)
        at += n
    first: dict[bytes, int] = {}
    for i, two in enumerate(zip(lines, lines[1:], strict=False)):
        pair = "\n".join(two)
        if _repeatable(pair):
            key = digest(pair)
            rows.append((False, own.get(i), i, 2, first.setdefault(key, i) + 2 <= i, key))
    return rows


def line_keys(docs: DataFrame, digest: Digest) -> DataFrame:
    """Digests of all chunks and pairs, with the hash of the text as version."""
    names = [c.split()[0] for c in KEYS.split(", ")]
    types = [pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 250) for i in range(0, batch.num_rows, 250)):
                each = zip(*(c.to_pylist() for c in part.columns), strict=True)
                rows = [(doc_id, version, *row) for doc_id, version, text in each for row in _keys_of(text, digest)]
                columns = list(zip(*rows, strict=True)) or [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    texts = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("version"), F.col("text")
    )
    return texts.mapInArrow(run, KEYS)


def _places(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` whose digest occurs twice or more; ``goes``: not the first one.

    Digests of more than a share 1 / HOT of these rows, fewer than HOT, are broadcast, so that no task gets all their
    rows. The others are sorted and merged at every size: their number grows with the rows.
    """
    counted = rows.groupBy("key").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    classes = written(counted, name)
    hot = F.col("n") * HOT > F.lit(classes.agg(F.sum("n")).first()[0] or 0)
    often = F.broadcast(classes.where(hot).select("key", F.col("first").alias("hot_first")))
    split = rows.join(often, "key", "left")
    rare = classes.where(~hot).select("key", "first").hint("merge")
    places = split.where("hot_first is null").drop("hot_first").join(rare, "key")
    places = places.unionByName(split.where("hot_first is not null").withColumnRenamed("hot_first", "first"))
    return places.withColumn("goes", F.col("again") | (F.col("doc_id") > F.col("first")))


def line_lists(keys: DataFrame) -> DataFrame:
    """doc_id, version and ``found``: line, size, key and goes of repeated chunks, and of repeated pairs outside those that go."""
    whole = written(_places(keys.where("whole"), "chunk_classes"), "chunk_places")
    gone = whole.where("goes").select("doc_id", "version", "chunk").hint("merge")
    # Pairs across boundaries have no chunk and stay.
    rest = written(keys.where("not whole").join(gone, ["doc_id", "version", "chunk"], "left_anti"), "pairs")
    columns = ["doc_id", "version", F.struct("line", "size", "key", "goes").alias("entry")]
    places = whole.select(columns).unionByName(_places(rest, "pair_classes").select(columns))
    # At most two entries for each of the document's lines.
    return places.groupBy("doc_id", "version").agg(F.collect_set("entry").alias("found"))


def _key_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest and text of every entry, once in a batch."""
    for batch in batches:
        rows = {}
        for text, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            lines = text.split("\n")
            for x in found:
                rows[x["key"], "\n".join(lines[x["line"] : x["line"] + x["size"]])] = None
        keys, texts = zip(*rows, strict=True) if rows else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(texts, pa.string())], names=["key", "text"])


def clashes(texts: DataFrame) -> DataFrame:
    """``key`` of each digest that stands for several texts; ``texts`` has text and found."""
    each = texts.where("found is not null").select("text", "found").mapInArrow(_key_texts, "key binary, text string").distinct()
    return each.groupBy("key").count().where("count > 1").select("key")


def _gone_lines(lines: list[str], found: list[dict]) -> list[int]:
    """Numbers of the lines of all repeated pairs, those inside chunks too."""
    pairs = {i for x in found for i in range(x["line"], x["line"] + x["size"] - 1)}
    repeated = {i for i in pairs if _repeatable("\n".join(lines[i : i + 2]))}
    return sorted(repeated | {i + 1 for i in repeated})


def dedup(docs: DataFrame, digest: Digest = md5) -> DataFrame:
    """``docs`` with ``text`` without repeated lines, ``removed`` (numbers of its lines, from 0) and ``removed_lines``."""
    docs = in_small_batches(docs)
    keep = [c for c in docs.columns if c not in ("removed", "removed_lines")]
    at, n_keep = keep.index("text"), len(keep)
    named = docs.select(*[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(keep)])
    keys = written(line_keys(docs, digest), "line_keys")
    while True:
        lists = written(line_lists(keys), "line_lists")
        key = (F.col(f"_{keep.index('doc_id')}").cast("long") == lists.doc_id) & (F.xxhash64(F.col(f"_{at}")) == lists.version)
        joined = written(named.join(lists.hint("merge"), key, "left").select(*named.columns, "found"), "lined")
        several = written(clashes(joined.select(F.col(f"_{at}").alias("text"), "found")), "clashes")
        if several.isEmpty():
            break
        # Each turn takes out digests that stand for several texts, so that this ends.
        keys = written(keys.join(several, "key", "left_anti"), "line_keys")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, removed = [], []
            for text, found in zip(batch.column(at).to_pylist(), batch.column(n_keep).to_pylist(), strict=True):
                out: list[int] = []
                if found:
                    lines = text.split("\n")
                    out = _gone_lines(lines, found)
                    listed = set(out)
                    text = "\n".join(x for i, x in enumerate(lines) if i not in listed)
                texts.append(text)
                removed.append(out)
            columns = list(batch.columns)[:n_keep]
            columns[at] = pa.array(texts, columns[at].type)
            columns += [pa.array(removed, pa.list_(pa.int32())), pa.array([len(x) for x in removed], pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:n_keep], "removed", "lines"])

    schema = T.StructType(
        [T.StructField(f"_{i}", docs.schema[c].dataType) for i, c in enumerate(keep)]
        + [T.StructField("removed", T.ArrayType(T.IntegerType())), T.StructField("lines", T.IntegerType())]
    )
    going = F.transform(F.filter("found", lambda x: x["goes"]), lambda x: F.struct(x["line"], x["size"]))
    out = joined.select(*named.columns, going.alias("found")).mapInArrow(run, schema)
    return out.select(
        *[F.col(f"_{i}").alias(c) for i, c in enumerate(keep)],
        F.col("removed").alias("removed"), F.col("lines").alias("removed_lines"),
    )
