"""Segments against their definition, and held-out accuracy."""

import math
import random
from collections import Counter
from itertools import accumulate

from pyspark.sql import functions as F

from sentloom.llm import toxicity


def plain_segments(scores):
    """Greedy definition: the best segment, then the same left and right of it."""
    best, total, sums = None, 0.0, [0.0]
    for s in scores:
        total += s
        sums.append(total)
    for a in range(len(scores)):
        for b in range(a + 1, len(scores) + 1):
            s = sums[b] - sums[a]
            if s > 1e-9 and (best is None or s > best[2] + 1e-9 or (abs(s - best[2]) <= 1e-9 and b - a < best[1] - best[0])):
                best = (a, b, s)
    if best is None:
        return []
    a, b, s = best
    left, right = plain_segments(scores[:a]), plain_segments(scores[b:])
    return [*left, best, *((x + b, y + b, z) for x, y, z in right)]


def test_segments():
    rng = random.Random(6)
    for _ in range(300):
        n = rng.randint(1, 25)
        at = sorted(rng.sample(range(n), rng.randint(0, n)))
        # Tokens without a known piece, and known ones of either sign.
        scores = [rng.choice([-0.5, -0.5, -0.1, -2.7]) - rng.random() / 100 for _ in range(n)]
        for i in at:
            scores[i] = rng.choice([0.31, 0.77, 1.13, 2.0191, 3.3]) + rng.random() / 100
        after = list(accumulate(scores))
        got, want = toxicity.segments(at, [after[i] - scores[i] for i in at], [after[i] for i in at]), plain_segments(scores)
        assert [x[:2] for x in got] == [x[:2] for x in want]
        assert all(abs(g[2] - w[2]) < 1e-9 for g, w in zip(got, want))


def test_many_hits_are_linear():
    n = 400_000
    before = [-0.1 * i for i in range(n)]
    assert len(toxicity.segments(list(range(0, 2 * n, 2)), before, [b + 0.4 for b in before])) == n


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.toxicity(docs, labels).where("held_out").join(labels, "doc_id").select("score", "predicted", "toxic").collect()
    assert len(rows) > 500
    right = sum(r["predicted"] == r["toxic"] for r in rows) / len(rows)
    positive, negative = ([r["score"] for r in rows if r["toxic"] == t] for t in (1, 0))
    auc = sum((p > n) + 0.5 * (p == n) for p in positive for n in negative) / len(positive) / len(negative)
    assert right > 0.97 and auc > 0.93  # one label in twenty contradicts its text


def corpus(spark):
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(300)]
    bad = ["vile", "rotten", "wretchedness"]
    rows, labels = [], []
    for i in range(600):
        text = rng.choices(words, k=60)
        if i % 6 == 0:
            for w in rng.choices(bad, k=4):
                text.insert(rng.randrange(60), w.upper() + "!")
        rows.append((i, " ".join(text), "en"))
        labels.append((i, 1, int(i % 6 == 0)))
    return rows, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), words


def test_new_texts_and_odd_rows(spark):
    rows, labels, words = corpus(spark)
    more = [(10_001, "you vile, rotten thing of wretchedness", None), (10_002, " ".join(words[:50]), None), (10_003, "", None), (10_004, None, None),
            (None, "vile rotten vile", None), (None, "vile rotten vile", None), (10_005, " ".join(words) * 300 + " vile rotten vile wretchedness", None)]
    docs = spark.createDataFrame(rows + more, "doc_id long, text string, score string")
    got = toxicity.toxicity(docs, labels).collect()
    assert len(got) == len(rows) + len(more)
    by = {r["doc_id"]: r for r in got}
    assert [by[i]["predicted"] for i in (10_001, 10_002, 10_003, 10_004)] == [1, 0, 0, 0]
    assert all(0 <= r["score"] <= 1 for r in got)
    assert [r["predicted"] for r in got if r["doc_id"] is None] == [1, 1]
    assert by[10_005]["passages"][-1]["end"] == by[10_005]["n_tokens"]
    assert sum(r["held_out"] for r in got) > 50
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(map(str, (r["doc_id"] for r in kept.collect()))) == sorted(str(r["doc_id"]) for r in got if not r["predicted"])


def test_labels_decide_only_through_training_rows(spark):
    """Labels of held-out ids, and what columns beside the text say, change nothing."""
    rows, labels, _ = corpus(spark)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    flipped = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one = toxicity.toxicity(docs, labels).select("doc_id", "score").orderBy("doc_id").collect()
    assert one == toxicity.toxicity(docs.withColumn("lang", F.lit("q")), flipped).select("doc_id", "score").orderBy("doc_id").collect()


def test_nothing_to_learn(spark):
    rows, labels, _ = corpus(spark)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = toxicity.toxicity(docs, labels.limit(0)).collect()
    assert len(got) == 600 and not any(r["predicted"] for r in got)
    assert toxicity.toxicity(docs.limit(0), labels).collect() == []
    one_kind = toxicity.toxicity(docs, labels.where("toxic = 0")).collect()
    assert not any(r["predicted"] for r in one_kind)


def test_log_odds_against_a_plain_computation(spark, monkeypatch):
    """Pieces of both signs: counted by text, with the prior and the significance as defined."""
    monkeypatch.setattr(toxicity, "MIN_Z", 1.5)
    rng = random.Random(4)
    common, bad, good = ["".join(rng.choices("abcdef", k=rng.randint(2, 9))) for _ in range(40)], ["vileness", "vilest", "grim"], ["kindness", "kindly", "calm"]
    rows = []
    for i in range(160):
        toxic = int(i % 4 == 0)
        rows.append((" ".join(rng.choices(common, k=12) + rng.choices(bad if toxic else good, k=rng.randint(0, 3))) + ".", toxic))
    t, c = Counter(), Counter()
    totals = [0, 0]
    for text, toxic in rows:
        words = {toxicity.normal_word(w.encode()) for w in text.split()}
        # A word counts once for each spelling it has in a text; here all have one.
        totals[toxic] += len({w for w in text.split()})
        for spelled in set(text.split()):
            w = toxicity.normal_word(spelled.encode())
            assert w in words
            for piece in ["=" + w, *(w[:n] for n in toxicity.PREFIXES if len(w) > n)]:
                (t if toxic else c)[piece] += 1
    nt, nc = totals[1], totals[0]
    want = {}
    for piece in t.keys() | c.keys():
        prior = toxicity.PRIOR * (t[piece] + c[piece]) / (nt + nc)
        odds = lambda y, n: math.log((y + prior) / (n + toxicity.PRIOR - y - prior))  # noqa: B023, E731
        score, both = odds(t[piece], nt) - odds(c[piece], nc), t[piece] + c[piece]
        surprise = sum(y * math.log(y * (nt + nc) / (both * n)) for y, n in ((t[piece], nt), (c[piece], nc)) if y)
        enough = t[piece] >= 3 if score > 0 else c[piece] >= 3
        if enough and score and math.sqrt(max(0.0, 2 * surprise)) >= 1.5:
            want[piece] = score
    got = {r["piece"]: r["score"] for r in toxicity.log_odds(toxicity.token_counts(spark.createDataFrame(rows, "text string, toxic int"))).collect()}
    assert got.keys() == want.keys() and all(abs(got[p] - want[p]) < 1e-9 for p in want)
    assert any(s > 0 for s in want.values()) and any(s < 0 for s in want.values())


def test_a_clean_word_splits_a_segment(spark):
    pieces = {"=foul": 2.0, "=nice": -3.0}
    rows = spark.createDataFrame([("foul foul x foul",), ("foul foul nice foul",), ("nice nice",)], "text string")
    got = [[(p["start"], p["end"], p["score"]) for p in r["s"]["passages"]] for r in rows.select(toxicity.passages_of(F.col("text"), pieces, spark).alias("s")).collect()]
    assert got == [[(0, 4, 5.5)], [(0, 2, 4.0), (3, 4, 2.0)], []]


def test_words_are_counted_in_small_parts(spark, monkeypatch):
    """Texts of many parts, and one longer than a part, count as in one piece."""
    assert toxicity.PART_BYTES <= 2 << 20
    texts = [("a b a c. ", 1), ("B, d", 0), (None, 1), ("", 0), ("a " * 50 + "e", 0), ("c a", 1)] * 3
    df = spark.createDataFrame(texts, "text string, toxic int")
    whole = sorted(tuple(r) for r in toxicity.token_counts(df).collect())
    monkeypatch.setattr(toxicity, "PART_BYTES", 8)
    assert sorted(tuple(r) for r in toxicity.token_counts(df).collect()) == whole
    assert whole == [("a", 6, 3), ("b", 3, 3), ("c", 6, 0), ("d", 0, 3), ("e", 0, 3)]
