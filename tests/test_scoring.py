import math

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from registry import queries
from sentloom.operators import scoring, stats
from sentloom.plans import views

NUMBERS = "one two three four five six seven eight nine ten".split()


def pairs(spark, n):
    """Pairs whose target copies the numbers and length of the source."""
    rows = [
        (i, f"{NUMBERS[i % 10]} {i} " + "word " * (i % 13) + ".", f"{NUMBERS[i % 10].upper()} {i} " + "Wort " * (i % 13) + ".")
        for i in range(1, n + 1)
    ]
    return spark.createDataFrame(rows, "line_no bigint, src string, tgt string")


@pytest.fixture(scope="module")
def wordfreq(spark):
    return spark.createDataFrame([("wort", 100), (".", 50)], "word string, count bigint")


@pytest.mark.parametrize("max_rows", [1000, 0])
def test_features(spark, wordfreq, max_rows):
    df = spark.createDataFrame(
        [(1, "A 12 x, y.", "a 12 Wort wort."), (2, "abc", "de"), (3, "5 6", "5 7 8")],
        "line_no bigint, src string, tgt string",
    )
    rows = {r.line_no: r for r in scoring.pair_features(df, wordfreq, "de", max_rows=max_rows).collect()}
    assert (rows[1].src_tokens, rows[1].tgt_tokens) == (4, 4)
    assert rows[1].copied_share == 0.5 and rows[1].punct_agreement == 0.5 and rows[1].digit_agreement == 1.0
    # The target's words as the list has them: a, 12, wort, wort, and the period.
    assert rows[1].tgt_log_freq == pytest.approx((2 * math.log(100) + math.log(50)) / 5)
    assert rows[2].length_ratio == pytest.approx(2 / 3) and rows[2].digit_agreement == 1.0
    assert rows[3].digit_agreement == pytest.approx(1 / 4)


@pytest.mark.parametrize("n", [1, 2, 3, 300])
def test_negatives_pair_every_source_with_another_target(spark, n):
    got = scoring.make_negatives(pairs(spark, n).repartition(3), seed=4, block_digits=1).collect()
    if n == 1:
        assert got == []
        return
    assert sorted(r.line_no for r in got) == list(range(1, n + 1))
    assert sorted(r.tgt_line_no for r in got) == list(range(1, n + 1))
    assert all(r.line_no != r.tgt_line_no for r in got)


def test_a_negative_never_has_the_same_target(spark):
    df = spark.createDataFrame([(i, f"s{i}", "same" if i % 2 else f"t{i}") for i in range(40)], "line_no bigint, src string, tgt string")
    own = {r.line_no: r.tgt for r in df.collect()}
    got = scoring.make_negatives(df).collect()
    assert got and all(r.tgt != own[r.line_no] and r.tgt == own[r.tgt_line_no] for r in got)


def test_texts_of_negatives_come_by_join(spark):
    """Windows and the table of blocks hold ids only."""
    plan = scoring.make_negatives(pairs(spark, 10))._jdf.queryExecution().executedPlan().toString()
    assert all("tgt" not in line.replace("tgt_line_no", "") for line in plan.splitlines() if "Window" in line or "BroadcastExchange" in line)


def test_classifier_separates_translations_from_shuffled_pairs(spark, wordfreq):
    df = pairs(spark, 400)
    train, dev = df.filter("line_no % 4 <> 0"), df.filter("line_no % 4 = 0")
    model = scoring.fit_pair_classifier(train, dev, wordfreq, "de")
    assert all(math.isfinite(w) for w in model.weights().values())
    assert model.dev["auc"] > 0.9 and model.dev["accuracy"] > 0.8
    good = dev.withColumn("label", F.lit(1.0))
    bad = scoring.make_negatives(dev).select("line_no", "src", "tgt").withColumn("label", F.lit(0.0))
    both = good.unionByName(bad)
    scored = scoring.score_pairs(both, model)
    low, high = scored.agg(F.min("score"), F.max("score")).first()
    assert 0 <= low <= high <= 1
    auc = BinaryClassificationEvaluator(rawPredictionCol="score", metricName="areaUnderROC").evaluate(scored)
    assert auc == pytest.approx(model.dev["auc"], abs=1e-9)
    # The scores follow from the weights alone.
    w = model.weights()
    total = sum((F.col(f) * w[f] for f in scoring.FEATURES), F.lit(w["intercept"]))
    plain = scoring.pair_features(both, wordfreq, "de").select("line_no", "label", (1 / (1 + F.exp(-total))).alias("plain"))
    gap = scored.join(plain, ["line_no", "label"]).agg(F.max(F.abs(F.col("score") - F.col("plain")))).first()[0]
    assert gap < 1e-9


def test_clean_synthetic_keeps_origins(spark):
    df = spark.createDataFrame([(1, "abcd", "abcd", "x"), (2, "abcd", "a", "x")], "line_no bigint, src string, tgt string, src_origin string")
    got = scoring.clean_synthetic(df, scoring.length_ratio_scorer, 0.3).collect()
    assert [(r.line_no, r.src_origin, r.score) for r in got] == [(1, "x", 1.0)]
    assert scoring.clean_synthetic(df, scoring.length_ratio_scorer, 0.1).count() == 2


@pytest.mark.parametrize("featured", [False, True])
def test_negatives_have_the_features_of_their_texts(spark, wordfreq, featured):
    df = pairs(spark, 30).unionByName(spark.createDataFrame([(31, "a b", "Wort. wort, x"), (32, "1", "..")], "line_no bigint, src string, tgt string"))
    given = scoring.pair_features(df, wordfreq, "de") if featured else df
    got = {r.line_no: r for r in scoring.pair_examples(given, wordfreq, "de", 3, featured=featured).collect()}
    negatives = scoring.make_negatives(df, 3).select((F.col("line_no") * 2 + 1).alias("line_no"), "src", "tgt")
    both = df.withColumn("line_no", F.col("line_no") * 2).unionByName(negatives)
    expected = scoring.pair_features(both, wordfreq, "de").collect()
    assert len(got) == len(expected) > 60
    for row in expected:
        assert got[row.line_no].label == 1 - row.line_no % 2
        assert all(got[row.line_no][f] == pytest.approx(row[f], abs=1e-12) for f in scoring.FEATURES)


def test_the_query_takes_every_pair_apart_once(spark, tmp_path, monkeypatch):
    rows = [(i, r.tgt if i % 2 else r.src, "de" if i % 2 else "en", "s", 1) for r in pairs(spark, 80).collect() for i in (2 * r.line_no, 2 * r.line_no + 1)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    seen = []

    def counted(module, name):
        f = getattr(module, name)
        monkeypatch.setattr(module, name, lambda *a, **b: (seen.append(name), f(*a, **b))[1])

    counted(views, "clean_pairs")
    counted(scoring, "lookup_array")
    scores = {r.line_no: r.score for r in queries.score_pairs(spark, str(tmp_path)).collect()}
    assert sorted(seen) == ["clean_pairs", "lookup_array"]
    monkeypatch.undo()
    # As of pairs that bring no features.
    clean = views.clean_pairs(spark, str(tmp_path))
    words = stats.word_frequencies(views.documents(spark, str(tmp_path), "de"), "de")
    model = scoring.fit_pair_classifier(clean.filter("line_no % 5 <> 0"), clean.filter("line_no % 5 = 0"), words, "de", queries.SEED)
    plain = {r.line_no: r.score for r in scoring.score_pairs(clean, model).collect()}
    assert len(scores) == 80 and scores == pytest.approx(plain, abs=1e-6)
