"""Held-out accuracy, and what a prediction may depend on."""

import numpy as np
from pyspark.sql import functions as F

from sentloom.llm import language_id


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = language_id.identify_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == docs.count() and len(held) > 100
    assert sum(r["lang_pred"] == r["lang"] for r in held) / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_inputs_of_a_prediction(spark):
    """Held-out languages, sources and numbers change no prediction; odd texts are und."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang", "source", F.lit("x").alias("score"))
    odd = spark.createDataFrame(
        [(900_001, None, "en", "s", "x"), (900_002, "", "de", "s", "x"), (900_003, "123 !? \n", "fr", None, "x"), (None, "the and of", None, "s", "x"), (None, "the and of", None, "s", "x")],
        docs.schema)
    docs = docs.union(odd)
    one = language_id.identify_languages(docs).orderBy("doc_id").collect()
    by = {r["doc_id"]: r for r in one}
    assert [by[i]["lang_pred"] for i in (900_001, 900_002, 900_003)] == ["und"] * 3
    assert len([r for r in one if r["doc_id"] is None and not r["held_out"]]) == 2
    spoilt = docs.withColumn("lang", F.when(language_id.held_out(F.col("doc_id")), F.lit("zz")).otherwise(F.col("lang"))).withColumn("source", F.lit(None))
    assert language_id.identify_languages(spoilt).orderBy("doc_id").collect() == one


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "the and", None), (2, None, "en")], "doc_id long, text string, lang string")
    assert [r["lang_pred"] for r in language_id.identify_languages(docs).collect()] == ["und", "und"]
    assert language_id.identify_languages(docs.limit(0)).collect() == []


def test_long_text_in_chunks(monkeypatch):
    """Counts of a long text are those of one piece."""
    text = "Die Straße läuft über den Platz, 12 mal. " * 50
    whole = language_id.Grams().counts(text)
    for size in (2, 3, 7, 100):
        monkeypatch.setattr(language_id, "CHUNK", size)
        assert (language_id.Grams().counts(text) == whole).all()


def test_elastic_net_gives_zeros():
    z = np.array([-0.5, 0.0, language_id.L1, 3.0])
    w = language_id._leader(z, np.ones(4))
    assert (w != 0).tolist() == [True, False, False, True] and w[0] > 0 > w[3]


def test_temperature():
    rng = np.random.default_rng(1)
    logits = rng.normal(size=(4000, 3))
    p = language_id._softmax(logits)
    truth = np.array([rng.choice(3, p=q) for q in p])
    assert abs(language_id._temperature(logits * 4, truth) / 4 - 1) < 0.15
