"""SimHash classes against all pairs, and the ways that only large inputs take."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from sentloom.llm import simhash
from sentloom.llm.components import components

SCHEMA = "doc_id long, text string, lang string, fp string, label string"


def plain_fingerprint(text, size=4):
    lower = "".join(c.lower() if c.isascii() else c for c in text or "")
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", lower) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_classes(values, distance=4):
    """Root of every value under links of at most ``distance`` bits."""
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    values = sorted(root)
    for i, a in enumerate(values):
        for b in values[i + 1:]:
            if (a ^ b).bit_count() <= distance:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {v: find(v) for v in values}


def plain_result(rows):
    fps = [(r[0], plain_fingerprint(r[1])) for r in rows]
    roots = plain_classes({f for _, f in fps})
    least = {}
    for doc, f in fps:
        if doc is not None:
            least[roots[f]] = min(doc, least.get(roots[f], doc))
    return sorted(((d, f"{f:016x}", least.get(roots[f])) for d, f in fps), key=str)


def test_classes_of_the_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = sorted((tuple(r) for r in simhash.simhash_classes(docs).collect()), key=str)
    assert got == plain_result([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_odd_rows(spark):
    body = "one two three four five six seven eight nine ten " * 30
    rows = [
        (5, body, None, "x", None), (4, body.upper(), "en", "y", "z"), (4, body.upper(), "en", "y", "z"), (9, "", None, None, None),
        (8, None, None, None, None), (7, " \t\n", None, None, None), (None, body, None, None, None), (None, "quite alone here", None, None, None),
        (1, "two words", None, None, None), (2, "Two\x0bWORDS", None, None, None), (3, "ÄÖ äö", None, None, None), (6, "w " * 200_000, None, None, None),
    ]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = sorted((tuple(r) for r in simhash.simhash_classes(docs).collect()), key=str)
    assert got == plain_result(rows)
    assert simhash.simhash_classes(docs.limit(0)).collect() == []
    kept = simhash.drop_near_copies(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    # The copies of 4, and the empty texts, leave one row each; the lone text without an id stays.
    assert sorted(ids, key=str) == sorted([4, 7, None, 1, 3, 6], key=str)
    assert simhash.drop_near_copies(docs.limit(0)).collect() == []


def clustered(seed, groups, each, flips):
    rng = random.Random(seed)
    out = set()
    for _ in range(groups):
        centre = rng.getrandbits(64)
        for _ in range(each):
            v = centre
            for b in rng.sample(range(64), rng.randint(0, flips)):
                v ^= 1 << b
            out.add(v)
    return [v - (1 << 64) if v >> 63 else v for v in out]


@pytest.mark.parametrize("direct", [8192, 3])
def test_links_connect_what_all_pairs_connect(spark, direct):
    """Also where block values are crowded and pairs are never compared."""
    values = clustered(1, 12, 40, 3)
    edges = simhash.near_links(spark.createDataFrame([(v,) for v in values], "fp long"), direct=direct)
    got = {r["node"]: r["label"] for r in components(edges).collect()}
    for r in edges.collect():
        assert ((r["a"] ^ r["b"]) & (2**64 - 1)).bit_count() <= 4
    want = plain_classes({v & (2**64 - 1) for v in values})
    pairs = {}
    for v in values:
        pairs.setdefault(want[v & (2**64 - 1)], set()).add(got.get(v, v))
    assert all(len(s) == 1 for s in pairs.values())
    assert len({next(iter(s)) for s in pairs.values()}) == len(pairs)


@pytest.mark.parametrize("blocks", [5, 6, 7])
def test_every_close_pair_shares_a_block_value(blocks):
    rng, masks = random.Random(2), simhash.block_masks(64, blocks, 4)
    for _ in range(500):
        diff = sum(1 << b for b in rng.sample(range(64), 4))
        assert any(diff & m == 0 for m in masks)


def test_forest_is_small():
    values = np.array(sorted(v & (2**64 - 1) for v in clustered(3, 1, 400, 2)), np.uint64).view(np.int64)
    assert len(simhash._forest(values, 4)) == len(values) - 1


def test_components(spark):
    rng = random.Random(4)
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(0, i) for i in range(1, 50)]
    other = [(rng.randint(200, 300), rng.randint(200, 300)) for _ in range(60)]
    edges = [*chain, *star, *other, (7, 7), (500, 500)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    assert got == {v: find(v) for v in list(root)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_fingerprints_travel_alone(spark, sf):
    """The texts are not shuffled: no exchange carries the text column."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    plan = docs.select("doc_id", simhash.fingerprint_column(F.col("text")))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
