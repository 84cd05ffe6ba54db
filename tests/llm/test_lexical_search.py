"""Ranked search against scoring every document, whatever the signatures let through."""

import math
import random
import re
from collections import Counter

import pytest

from sentloom.llm import lexical_search as ls

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def terms(text):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def brute(docs, items, k):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    sizes = [sum(c.values()) for _, c in counts]
    n, total = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        found = []
        for (doc, c), size in zip(counts, sizes):
            m = 10 + 90 * size * n // max(1, total)
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if t in c
            )
            if score > 0:
                found.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, f[3], -f[0]) for rank, f in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=str)


def corpus(rng, n):
    words = [f"w{i}" for i in range(60)] + ["É", "naïve", "日本", "x9", "The"]
    weights = [1 / (i + 1) for i in range(len(words))]
    return [(i, rng.choice([" ", "-", "\n", "'s "]).join(rng.choices(words, weights, k=rng.choice([0, 1, 5, 20, 80, 400])))) for i in range(n)]


def run(spark, docs, items, k):
    out = ls.search(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), k)
    assert out.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    return sorted((tuple(r) for r in out.collect()), key=str)


@pytest.mark.parametrize("bits, seeds, sent", [(10, 40, 200_000), (1, 3, 0)])
def test_against_scoring_all(spark, monkeypatch, bits, seeds, sent):
    """Signatures of one bit an entry bound loosely; the answer is the same."""
    monkeypatch.setattr(ls, "BITS", bits)
    monkeypatch.setattr(ls, "SEEDS", seeds)
    monkeypatch.setattr(ls, "SENT_CANDIDATES", sent)
    monkeypatch.setattr(ls, "QUERIES", 7)
    monkeypatch.setattr(ls, "SLICE", 4000)
    rng = random.Random(bits)
    docs = corpus(rng, 250)
    docs += [(None, docs[7][1]), (None, None), (1000, None), (1001, "..."), *docs[20:24], (1002, docs[20][1])]
    items = [(i, " ".join(docs[rng.randrange(250)][1].split()[:rng.choice([0, 2, 12])])) for i in range(15)]
    items += [(50, None), (51, "unheardof"), (0, items[0][1])]
    assert run(spark, docs, items, 4) == brute(docs, items, 4)


def test_bounds_are_never_too_low(spark):
    rng = random.Random(3)
    docs = corpus(rng, 120)
    distinct = [sorted(set(terms(t))) for _, t in docs[:9]]
    encoded = [[t.encode() for t in own] for own in distinct]
    df = spark.createDataFrame(docs, DOCS)
    n, total, held = ls.corpus_statistics(df, {t for own in encoded for t in own})
    assert n == sum(bool(terms(t)) for _, t in docs) and total == sum(len(terms(t)) for _, t in docs)
    weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * c + 1))) for t, c in held.items()}
    queries = ls.Queries(list(range(9)), encoded, weight, n, total)
    seen = 0
    for ids, bound in ls.upper_bounds(iter(ls.index_documents(df).toArrow().to_batches()), queries):
        for column, doc in enumerate(ids):
            own = ls.terms_of(docs[doc][1])
            for q in range(9):
                assert bound[q, column] >= queries.score(q, Counter(own), int(queries.length_term(len(own))))
            seen += 1
    assert seen == n


def test_empty_tables(spark):
    assert run(spark, [], [(1, "a")], 3) == []
    assert run(spark, [(1, "a")], [], 3) == []
    assert run(spark, [(1, None), (2, "")], [(1, "a")], 3) == []


def test_other_columns_and_long_texts(spark):
    long = "needle " + "hay " * 300_000
    docs = spark.createDataFrame([(1, long, 1, {"a": 1}), (2, "needle", 2, None)], DOCS + ", query int, Score map<string,int>")
    got = ls.search(docs, spark.createDataFrame([(5, "needle in", "x")], ITEMS + ", rank string")).collect()
    assert [(r["rank"], r["doc_id"]) for r in got] == [(1, 2), (2, 1)]
