"""Shards against a plain version, and the law that a new shard only takes rows."""

import math
import struct
import zlib

import pytest
import xxhash
from pyspark.sql import functions as F

from sentloom.llm import sharding


def chain(*parts):
    seed = 42
    for p in parts:
        if p is None:
            continue
        data = p.encode() if isinstance(p, str) else struct.pack("<q" if isinstance(p, Long) else "<i", p)
        seed = xxhash.xxh64_intdigest(data, seed)
    return seed


class Long(int):
    pass


def unit(h):
    return ((h >> 12) + 0.5) / 2**52


def plain_shard(key, weights):
    """Level by level: the region with the least clock below it, then the rack, then the shard."""
    key = None if key is None else Long(key)
    clocks = {
        (i % 4, i // 4 % 4, i // 16): -math.log(unit(chain(key, "clock", i % 4, i // 4 % 4, i // 16))) / w for i, w in enumerate(weights) if w
    }
    path = ()
    for level in range(3):
        inside = {p: t for p, t in clocks.items() if p[:level] == path}
        nodes = {p[:level + 1] for p in inside}
        path = min(nodes, key=lambda node: min(t for p, t in inside.items() if p[:level + 1] == node))
    return path[0] + 4 * path[1] + 16 * path[2]


def test_shards_of_the_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = sharding.shard_documents(docs).collect()
    assert len(rows) == len(texts)
    slots = {}
    for r in rows:
        blob = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(blob) + 8, zlib.crc32(blob), "key")
        assert r["shard"] == plain_shard(r["doc_id"], [1.0] * 24)
        assert r["grown_shard"] == plain_shard(r["doc_id"], [1.0] * 25)
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(docs.columns) <= set(rows[0].asDict())


@pytest.mark.parametrize("n", [1, 2, 7, 16, 24, 40, 63])
def test_a_new_shard_only_takes(spark, n):
    keys = spark.range(20_000)
    both = keys.select(
        sharding.weighted_shard(F.col("id"), [1.0] * n).alias("a"), sharding.weighted_shard(F.col("id"), [1.0] * (n + 1)).alias("b"))
    moved = both.where("a <> b")
    assert moved.where(f"b <> {n}").count() == 0
    assert abs(moved.count() / 20_000 - 1 / (n + 1)) < 0.03


def test_weights(spark):
    weights = [1.0, 0.5, 0.0, 0.25, 1.0]
    raised = [1.0, 0.75, 0.0, 0.25, 1.0]
    keys = spark.range(40_000).select(
        sharding.weighted_shard(F.col("id"), weights).alias("a"), sharding.weighted_shard(F.col("id"), raised).alias("b"))
    share = {r["a"]: r["count"] / 40_000 for r in keys.groupBy("a").count().collect()}
    assert share.keys() == {0, 1, 3, 4}
    for i, w in enumerate(weights):
        assert abs(share.get(i, 0) - w / sum(weights)) < 0.02
    assert keys.where("a <> b and b <> 1").count() == 0
    for bad in ([0.0], [2.0], [-1.0, 1.0], [1.0] * 65):
        with pytest.raises(ValueError):
            sharding.weighted_shard(F.col("id"), bad)


def test_small_weights_and_the_sums_of_subtrees(spark):
    """Every level is drawn by the weights below, however small; a raised weight moves keys into its own path only."""
    weights = [0.01 * (1 + i % 5) for i in range(40)]
    raised = [w * (3 if i == 22 else 1) for i, w in enumerate(weights)]
    keys = spark.range(60_000).select(
        sharding.weighted_shard(F.col("id"), weights).alias("a"), sharding.weighted_shard(F.col("id"), raised).alias("b"))
    rows = [tuple(r) for r in keys.collect()]
    assert all(b == 22 for a, b in rows if a != b) and any(a != b for a, b in rows)
    for size in (4, 16):  # regions, then racks
        for node in range(size):
            share = sum(w for i, w in enumerate(weights) if i % size == node) / sum(weights)
            assert abs(sum(a % size == node for a, _ in rows) / len(rows) - share) < 0.01
    assert [a for a, _ in rows[:300]] == [plain_shard(i, weights) for i in range(300)]


def test_odd_rows(spark):
    rows = [(1, "a", 1), (1, "a", 1), (None, None, 2), (None, "b", 3), (2, "", 4), (3, "ü" * 100_000, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard int")
    got = sharding.shard_documents(docs).collect()
    assert len(got) == 6
    by_shard = {}
    for r in got:
        by_shard.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    assert len({r["shard"] for r in got if r["doc_id"] is None}) == 1
    none = next(r for r in got if r["text"] is None)
    assert (none["size"], none["text_crc32"]) == (8, None)
    assert next(r for r in got if r["doc_id"] == 3)["size"] == 200_008
    assert sharding.shard_documents(docs.limit(0)).collect() == []


def test_slots_of_one_shard_use_many_parts(spark):
    rows = spark.range(10_000).select("id", F.lit(0).alias("s"))
    out = sharding.with_slots(rows, "s", ["id"], "slot", blocks=16)
    assert sorted(r["slot"] for r in out.collect()) == list(range(10_000))
