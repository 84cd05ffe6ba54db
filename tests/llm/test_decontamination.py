"""Contained items against a search through everything."""

import random
import re
import time

import pyarrow as pa
import pytest

from sentloom.llm import decontamination


def plain(docs, items, shingle=5, threshold=0.8):
    lower = lambda t: "".join(c.lower() if c.isascii() else c for c in t or "")
    split = lambda t: [w for w in re.split(r"[\x20\x09-\x0D]+", lower(t)) if w]
    out = []
    for item_id, text in items:
        words = split(text)
        size = min(shingle, len(words))
        own = {tuple(words[i:i + size]) for i in range(len(words) - size + 1)} if words else set()
        for doc_id, body in docs:
            body = split(body)
            have = len(own & {tuple(body[i:i + size]) for i in range(len(body) - size + 1)}) if size else 0
            if own and have >= threshold * len(own):
                out.append((doc_id, item_id, len(own), have))
    return sorted(out, key=str)


def found(docs, items, **kw):
    return sorted((tuple(r)[:4] for r in decontamination.find_items(docs, items, **kw).collect()), key=str)


@pytest.fixture
def tables(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdef", k=rng.randint(1, 3)))
    items = [(i, " ".join(word() for _ in range(rng.choice([1, 2, 3, 5, 8, 20, 40])))) for i in range(60)]
    docs = []
    for d in range(120):
        words = [word() for _ in range(rng.randint(0, 200))]
        if d % 2:
            passage = rng.choice(items)[1].split()
            for _ in range(rng.randint(0, 3)):  # some lose too much, some just enough
                passage[rng.randrange(len(passage))] = "zzz"
            at = rng.randint(0, len(words))
            words[at:at] = passage
        docs.append((d, rng.choice([" ", "\n", " \t "]).join(words).upper() if d % 3 else " ".join(words)))
    docs += [(None, items[3][1]), (500, None), (501, ""), (502, items[4][1]), (502, items[4][1])]
    items += [(None, items[7][1]), (90, None), (91, " \n"), (3, items[3][1])]
    return docs, items


def test_all_pairs(spark, tables):
    docs, items = tables
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame(items, "item_id long, text string")
    want = plain(docs, items)
    assert len(want) > 100
    assert found(d, i) == want
    for threshold in (0.5, 1.0):
        assert found(d, i, threshold=threshold) == plain(docs, items, threshold=threshold)


def test_items_come_in_blocks(spark, tables, monkeypatch):
    docs, items = tables
    monkeypatch.setattr(decontamination, "BLOCK_ITEMS", 7)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame(items, "item_id long, text string")
    assert found(d, i) == plain(docs, items)
    kept = decontamination.drop_contaminated(d, i)
    bad = {(r[0]) for r in plain(docs, items)}
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted((r[0] for r in docs if r[0] not in bad), key=str)


def test_long_text_and_other_columns(spark):
    item = "the quick brown fox jumps over the lazy dog again"
    docs = spark.createDataFrame([(1, "x " * 300_000 + item + " y" * 1000, 3), (2, "x " * 50, 4)], "doc_id long, text string, item_id int")
    items = spark.createDataFrame([(7, item, "a")], "item_id long, text string, doc_id string")
    assert found(docs, items) == [(1, 7, 6, 6)]
    assert decontamination.drop_contaminated(docs, items).collect() == [(2, "x " * 50, 4)]


def test_empty_tables(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    assert found(docs.limit(0), items) == []
    assert found(docs, items.limit(0)) == []
    assert decontamination.drop_contaminated(docs, items.limit(0)).count() == docs.count()


def test_nothing_is_shuffled(spark, sf):
    out = decontamination.find_items(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet"))
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


def test_a_long_text_with_many_items_takes_seconds():
    rng = random.Random(2)
    words = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(50_000)]
    items = [(i, " ".join(rng.choices(words, k=40))) for i in range(200)]
    text = " ".join(" ".join(rng.choices(words, k=1800)) + " " + t for _, t in items)
    block, start = decontamination.Items(items, 5, 0.8), time.monotonic()
    found = sorted(block.contained(pa.array([text])))
    assert [f[1] for f in found] == list(range(200)) and all(f[2] == f[3] for f in found)
    assert time.monotonic() - start < 30
