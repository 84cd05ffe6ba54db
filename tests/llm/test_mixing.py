"""Weights, quotas and passes of the mixture; its rows are compared with SQL in test_queries."""

import math

import pytest

from sentloom.llm import mixing


def corpus(spark, sizes, words=20):
    rows = [(f"{s}-{i}", s, "w " * (words + i % 7)) for s, n in sizes.items() for i in range(n)]
    return spark.createDataFrame([(i, s, t) for i, (_, s, t) in enumerate(rows)], "doc_id long, source string, text string")


def totals(rows):
    out = {}
    for r in rows:
        out[r["source"]] = out.get(r["source"], 0) + r["n_tokens"]
    return out


def test_entropy_target(spark):
    docs = corpus(spark, {"hot": 900, "a": 60, "b": 30, "c": 10})
    rows = mixing.mix_sources(docs, entropy=0.8, max_repeat=100.0).collect()
    weights = {r["source"]: r["weight"] for r in rows}
    assert sum(weights.values()) == pytest.approx(1, abs=1e-6)
    h = -sum(w * math.log(w) for w in weights.values())
    assert h == pytest.approx(0.8 * math.log(4), abs=1e-4)
    have = totals(rows)
    budget = sum(len(r["text"].split()) for r in docs.collect())
    for s, w in weights.items():
        assert w * budget - 30 <= have[s] <= w * budget + 1


def test_repetition_limit_wins(spark):
    docs = corpus(spark, {"hot": 900, "a": 60, "b": 30, "c": 10})
    rows = mixing.mix_sources(docs, entropy=1.0, max_repeat=2.0).collect()
    size = totals([{"source": r["source"], "n_tokens": len(r["text"].split())} for r in docs.collect()])
    assert max(n / size[s] for s, n in totals(rows).items()) <= 2.0 + 1e-6
    uses = {}
    for r in rows:
        uses.setdefault(r["doc_id"], []).append(r["epoch"])
    assert all(sorted(e) == list(range(len(e))) for e in uses.values())
    assert max(len(e) for e in uses.values()) == 2


def test_shares_as_they_are(spark):
    docs = corpus(spark, {"a": 50, "b": 50})
    rows = mixing.mix_sources(docs, entropy=0.5).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(100))


def test_blocks_hold_the_weights(spark):
    docs = corpus(spark, {"a": 3000, "b": 1000}, words=5)
    rows = mixing.mix_sources(docs, entropy=0.5, blocks=4).collect()
    for block in range(4):
        have = totals([r for r in rows if r["block"] == block])
        assert have["a"] / sum(have.values()) == pytest.approx(0.75, abs=0.05)


def test_odd_rows(spark):
    rows = [(1, None, "a b"), (2, None, "c d e"), (None, "x", "f"), (None, "x", "g"), (3, "x", None), (4, "x", ""), (4, "x", ""),
            (5, "silent", " "), (6, "=", "h i j k"), (7, "x", "l " * 50_000)]
    docs = spark.createDataFrame([(*r, 9, "q") for r in rows], "doc_id long, source string, text string, epoch int, weight string")
    got = mixing.mix_sources(docs, entropy=0.0).collect()
    # Natural shares and a budget of all words: each document of a source with words once.
    assert sorted((str(r["doc_id"]) for r in got)) == sorted(str(r[0]) for r in rows if r[1] != "silent")
    assert {r["source"] for r in got} == {None, "x", "="}
    assert mixing.mix_sources(docs.limit(0)).collect() == []
    assert mixing.mix_sources(docs.where("doc_id = 5")).collect() == []


def test_small_budget_cuts_inside_a_prefix(spark, monkeypatch):
    """The running sum stops at the same document however few rows a prefix holds."""
    docs = corpus(spark, {"a": 400}, words=3)
    keys = sorted((r["k"], len(r["text"].split())) for r in docs.select("text", mixing.shuffle_key(7, docs["doc_id"]).alias("k")).collect())
    for budget in (0, 1, 17, 200, 777):
        n = total = 0
        for _, t in keys:
            if total + t > budget:
                break
            n, total = n + 1, total + t
        for levels in (1, 2, 3):
            monkeypatch.setattr(mixing, "LEVELS", levels)
            assert mixing.mix_sources(docs, budget=budget).count() == n


def test_main_path_is_native(spark, sf):
    plan = mixing.mix_sources(spark.read.parquet(f"{sf}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
