"""Held-out ranking, and co-training against a plain version on the same features."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sentloom.llm import quality_cotraining as q
from sentloom.llm.common import Scratch


def auc(rows):
    good, bad = ([r["score"] for r in rows if r["quality"] == k] for k in (1, 0))
    return sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / len(good) / len(bad)


def test_held_out_ranking(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    rows = q.quality_scores(docs, labels)
    assert rows.count() == docs.count()
    held = rows.where("held_out").join(labels, "doc_id").collect()
    assert auc(held) > 0.98 and sum(r["predicted"] == r["quality"] for r in held) / len(held) > 0.95


def plain_fit(x, y):
    """Ridge logistic regression by small steps of plain Newton from several halvings, all rows at once."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w, pull = np.zeros(x.shape[1]), np.full(x.shape[1], q.RIDGE)
    pull[-1] = 1e-3
    loss = lambda w: np.logaddexp(0, x @ w).sum() - y @ (x @ w) + 0.5 * (pull * w * w).sum()
    for _ in range(60):
        p = 1 / (1 + np.exp(-x @ w))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(pull), x.T @ (y - p) - pull * w)
        size = 1.0
        while size > 1e-9 and loss(w + size * step) > loss(w):
            size /= 2
        w = w + size * step
    return w


def plain_co_training(views, quality, bucket):
    """Rounds on arrays of all rows, each row's pseudo-label kept in a table."""
    fit, free = (quality >= 0) & (bucket > 1), quality < 0
    share = quality[fit].mean()
    given = [np.where(fit, quality, -1), np.where(fit, quality, -1)]
    weights = [plain_fit(views[v][given[v] >= 0], given[v][given[v] >= 0].astype(float)) for v in (0, 1)]
    width = 2 * q.EDGE / q.BINS
    for _ in range(q.ROUNDS):
        news = []
        for teacher, pupil in ((0, 1), (1, 0)):
            logit = views[teacher] @ weights[teacher][:-1] + weights[teacher][-1]
            for label, sure, part in ((1, logit, share), (0, -logit, 1 - share)):
                rows = np.flatnonzero(free & (given[pupil] < 0))
                level = np.clip(((sure[rows] + q.EDGE) / width).astype(int), 0, q.BINS - 1)
                chosen = []
                for one in sorted(set(level.tolist()), reverse=True):
                    own = rows[level == one]
                    if one * width - q.EDGE < np.log(q.CONFIDENT / (1 - q.CONFIDENT)) or (chosen and len(chosen) + len(own) > q.TAUGHT * free.sum() * part):
                        break
                    chosen += own.tolist()
                news.append((pupil, chosen, label))
        if not any(rows for _, rows, _ in news):
            break
        for pupil, rows, label in news:
            given[pupil][rows] = label
        weights = [plain_fit(views[v][given[v] >= 0], given[v][given[v] >= 0].astype(float)) for v in (0, 1)]
    return weights, given


@pytest.mark.parametrize("block, tasks", [(4096, 3), (16, 40)])
def test_all_unlabelled_rows_teach_as_in_a_plain_version(spark, monkeypatch, block, tasks):
    monkeypatch.setattr(q, "BLOCK_ROWS", block)
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    known = labels.where(q.bucket_of_five(F.col("doc_id")) > 0).where("doc_id % 4 = 0").select("doc_id", "quality")
    blocks = Scratch(spark).write(q._feature_blocks(docs.repartition(tasks), known), "test-features")
    rows = blocks.collect()
    views = [np.vstack([np.frombuffer(r[c], "<f4").reshape(-1, n) for r in rows]).astype(float) for c, n in zip("tm", q.SIZES)]
    quality, bucket = (np.concatenate([np.frombuffer(r[c], "<i4") for r in rows]) for c in ("quality", "bucket"))
    assert len(quality) == docs.where(q.bucket_of_five(F.col("doc_id")) > 0).count()
    want, given = plain_co_training(views, quality, bucket)
    # Most rows have no label, and many of them are taught.
    assert (quality < 0).mean() > 0.8 and all(((g >= 0) & (quality < 0)).sum() > 100 for g in given)
    got = q.co_train(blocks)
    for a, b in zip(got.weights, want):
        assert np.allclose(a, b, atol=2e-3)


def test_views_teach_each_other():
    """With few labels, pseudo-labels from the other view lift the weaker one."""
    rng = np.random.default_rng(2)

    def rows(n):
        y = rng.integers(0, 2, n)
        return [np.hstack([(y * 2 - 1)[:, None] * s + rng.normal(size=(n, 1)), rng.normal(size=(n, 30))]) for s in (2.5, 1.5)], y

    (labelled, y), (pool, _), (test, truth) = rows(40), rows(4000), rows(4000)
    views, quality = [np.vstack(p) for p in zip(labelled, pool)], np.concatenate([y, np.full(4000, -1)])
    taught, _ = plain_co_training(views, quality, np.full(4040, 2))
    alone = plain_fit(labelled[1], y.astype(float))
    right = lambda w: ((test[1] @ w[:-1] + w[-1] > 0) == truth).mean()
    assert right(taught[1]) > right(alone) + 0.02


def test_teaching_edges():
    counts = np.zeros(q.BINS)
    assert q.teaching_edge(counts, 10) == np.inf
    counts[[q.BINS - 1, q.BINS - 2, q.BINS - 5, 0]] = [4, 5, 3, 1000]
    edge = lambda i: i * 2 * q.EDGE / q.BINS - q.EDGE
    assert q.teaching_edge(counts, 10) == edge(q.BINS - 2)
    assert q.teaching_edge(counts, 1) == edge(q.BINS - 1)  # the surest bin is taken whole
    assert q.teaching_edge(counts, 10_000) == edge(q.BINS - 5)  # nothing that is not confident


def test_odd_rows(spark):
    rows = [(1, "some text here.", "en", "s", 5, 0), (1, "some text here.", "en", "s", 5, 0), (None, None, None, None, None, 1), (2, "", None, None, -4, 2), (3, "a" * 300_000, "x", "y", 9, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, quality int")
    labels = spark.createDataFrame([(1, 1, 0), (7, 5, 0)], "doc_id long, quality int, toxic int")
    for table in (labels, labels.limit(0)):
        got = q.quality_scores(docs, table).collect()
        assert len(got) == 5 and all(0 <= r["score"] <= 1 for r in got)
        assert len({r["score"] for r in got}) == 1
    assert q.quality_scores(docs.limit(0), labels).collect() == []


def test_held_out_labels_change_nothing(spark):
    sf = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.withColumn("quality", F.when(q.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (q.quality_scores(docs, x).orderBy("doc_id").collect() for x in (labels, flipped))
    assert all(abs(x["score"] - y["score"]) < 1e-9 for x, y in zip(a, b))
