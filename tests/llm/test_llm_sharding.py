"""Best-fit-decreasing sharding against plain list scans."""

import random
import zlib
from collections import defaultdict

import pytest

from episodica.llm import sharding

SCHEMA = "doc_id long, text string, shard string, key int"


def plain_best_fit(sizes, capacity):
    """The first bin of the least room that holds each size."""
    rooms, out = [], []
    for size in sizes:
        fits = [(room, i) for i, room in enumerate(rooms) if room >= size]
        if fits:
            room, i = min(fits)
        else:
            room, i = max(capacity, size), len(rooms)
            rooms.append(room)
        rooms[i] = room - size
        out.append(i)
    return out


@pytest.mark.parametrize("seed", range(6))
def test_tree_finds_the_tightest_bin(seed):
    rng = random.Random(seed)
    sizes = sorted((rng.choice([rng.randint(0, 30), rng.randint(1, 400)]) for _ in range(400)), reverse=True)
    assert sharding.best_fit(sizes, 300) == plain_best_fit(sizes, 300)


def test_best_fit_gives_up_beyond_its_bins():
    assert sharding.best_fit([5, 5, 5], 5, 2) is None
    assert sharding.best_fit([5, 5, 5], 5, 3) == [0, 1, 2]


@pytest.mark.parametrize("seed", range(4))
def test_level_fit_is_even(seed):
    rng = random.Random(seed)
    sizes = sorted((rng.randint(1, 1000) for _ in range(3000)), reverse=True)
    bins = sharding.level_fit(sizes, 40)
    loads = [0] * 40
    for size, b in zip(sizes, bins, strict=True):
        loads[b] += size
    assert max(loads) <= 1.001 * sum(sizes) / 40
    # A group above the even share is alone, and the rest is even.
    bins = sharding.level_fit([sum(sizes), *sizes], 40)
    assert bins.count(bins[0]) == 1 and len(set(bins)) == 40


def test_few_items_have_bins_of_their_own():
    assert sharding.level_fit([9, 5, 1], 40) == [0, 1, 2]
    assert sharding.level_fit([], 40) == []


def documents(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(6)


def check(out, rows, shards):
    """Every row is there with its size, groups are whole, and slots have no gap."""
    want = sorted((d is not None, d or 0, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in rows)
    assert sorted((r.doc_id is not None, r.doc_id or 0, r["size"], r.text_crc32) for r in out) == want
    slots, places = defaultdict(list), defaultdict(set)
    for r in out:
        slots[r.shard].append(r.slot)
        places[r.text_crc32].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in places.values())
    assert set(slots) <= set(range(shards))
    loads = defaultdict(int)
    for r in out:
        loads[r.shard] += r["size"]
    return loads


def test_even_shards_with_a_hot_group(spark):
    """A text that a third of the rows share goes to one shard; the other shards are near equal."""
    rng = random.Random(3)
    rows = [(i, f"{i} " + "w" * rng.randint(0, 3000)) for i in range(2000)]
    rows += [(10_000 + i, "x" * 1500) for i in range(1000)]
    out = sharding.assign(documents(spark, rows), 40).collect()
    loads = check(out, rows, 40)
    rest = sorted(loads.values())[:-1]
    assert len(loads) == 40 and max(loads.values()) == 1000 * 1516
    assert max(rest) < 1.01 * min(rest)


def test_several_levels_of_bundles(spark, monkeypatch):
    monkeypatch.setattr(sharding, "PER_CELL", 50)
    monkeypatch.setattr(sharding, "PER_CELL_BUNDLES", 8)
    monkeypatch.setattr(sharding, "BUNDLES", 32)
    rng = random.Random(5)
    rows = [(i, f"{i} " + "w" * rng.randint(0, 300)) for i in range(3000)]
    loads = check(sharding.assign(documents(spark, rows), 10).collect(), rows, 10)
    assert len(loads) == 10 and max(loads.values()) < 1.1 * min(loads.values())


def test_odd_rows(spark):
    """Null texts are in the group of empty ones; repeated rows and null ids are documents of their own."""
    rows = [(1, None), (2, ""), (3, ""), (3, ""), (None, "a"), (None, "a"), (4, "é" * 200_000), (5, "b"), (5, "c")]
    check(sharding.assign(documents(spark, rows), 40).collect(), rows, 40)


def test_fixed_capacity(spark):
    rng = random.Random(8)
    rows = [(i, f"{i} " + "w" * rng.randint(0, 900)) for i in range(1500)] + [(9000, "big" * 20_000)]
    out = sharding.fewest(documents(spark, rows), 20_000).collect()
    loads = sorted(check(out, rows, 10**6).values())
    assert loads[-1] == 60_016 and loads[-2] <= 20_000
    assert len(loads) <= 2 + sum(loads[:-1]) / 20_000 * 1.05


def test_written_shards_hold_all_columns(spark, tmp_path):
    rows = [(i, f"text {i % 50}") for i in range(300)]
    sharding.write_shards(documents(spark, rows), 7, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert set(back.columns) == {"doc_id", "text", "shard", "key", "_shard"}
    assert sorted((r.doc_id, r.text) for r in back.collect()) == sorted(rows)
    assert back.groupBy("text").agg({"_shard": "min"}).count() == 50


def test_empty_table(spark):
    assert sharding.assign(documents(spark, []), 40).collect() == []
