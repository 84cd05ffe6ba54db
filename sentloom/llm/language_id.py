"""Language of a text: sparse multinomial logistic regression on TF-IDF character n-grams.

Trained with follow-the-regularised-leader (proximal, elastic net) and calibrated by temperature.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentloom.llm.common import Scratch, bucket_of_five, held_out

# Hash buckets of the n-grams of 1 to 3 characters.
BUCKETS, ORDERS = 1 << 15, 3
# Documents the classifier is fitted on, and those its temperature is fitted on, at most
# about so many of each language; every other figure is taken over all rows.
FIT_PER_LANGUAGE, CALIBRATE_PER_LANGUAGE = 1500, 500
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.002, 0.002
# Parts the fit runs on side by side; their states are averaged after each round.
PARTS, ROUNDS = 4, 3
CHUNK = 1 << 20
UNDETERMINED = "und"


class Grams:
    """Counts of hashed character n-grams; anything but letters counts as a space."""

    def __init__(self):
        points = np.arange(0x110000)
        self.letters = np.fromiter((chr(p).isalpha() for p in points), bool, len(points))
        self.codes = np.where(self.letters, points + 1, 1).astype(np.uint64)

    def counts(self, text: str) -> np.ndarray | None:
        """Counts by bucket of the whole text; None if it has no letter."""
        points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
        if not self.letters[points].any():
            return None
        total = np.zeros(BUCKETS, np.int64)
        for at in range(0, len(points), CHUNK):
            # The last characters of the chunk before start the grams that reach into this one.
            lead = min(at, ORDERS - 1)
            codes, h = self.codes[points[at - lead:at + CHUNK]], None
            for order in range(1, ORDERS + 1):
                n = len(codes) - order + 1
                if n <= 0:
                    break
                h = codes[:n] if h is None else h[:n] * np.uint64(0x100000001B3) ^ codes[order - 1:]
                new = max(0, lead - order + 1)
                mixed = (h[new:] + np.uint64(order)) * np.uint64(0x9E3779B97F4A7C15)
                total += np.bincount((mixed >> np.uint64(49)).astype(np.int64), minlength=BUCKETS)
        return total


@dataclass
class Model:
    """Languages, inverse document frequencies, weights (languages x buckets), bias, temperature."""

    langs: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0

    def features(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return _features(counts, self.idf)

    def logits(self, counts: np.ndarray) -> np.ndarray:
        at, x = _features(counts, self.idf)
        return self.weights[:, at] @ x + self.bias


def _features(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets that occur and their TF-IDF values, of length 1 together."""
    at = np.flatnonzero(counts)
    x = np.log1p(counts[at]) * idf[at]
    return at, x / np.sqrt((x * x).sum())


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _leader(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The weights that FTRL-proximal derives from its state; small sums give exact zeros."""
    return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def document_frequencies(texts: DataFrame) -> np.ndarray:
    """In how many texts each bucket occurs, and after these the number of texts with a letter."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, total = Grams(), np.zeros(BUCKETS + 1, np.int64)
        for batch in batches:
            for text in batch.column(0):
                counts = grams.counts(text.as_py())
                if counts is not None:
                    total[:BUCKETS] += counts > 0
                    total[BUCKETS] += 1
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BUCKETS + 1)), pa.array(total)], ["at", "n"])

    rows = texts.select("text").mapInArrow(count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(BUCKETS + 1, np.int64)
    for row in rows:
        out[row["at"]] = row["n"]
    return out


def _bounded(rows: DataFrame, per_language: int, salt: str) -> DataFrame:
    """About ``per_language`` rows of each language, chosen by a hash of id and text."""
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return rows
    share = F.lit(None).cast("double")
    for lang, n in sizes.items():
        share = F.when(F.col("lang") == lang, min(1.0, per_language / n)).otherwise(share)
    draw = F.pmod(F.xxhash64(F.lit(salt), "doc_id", F.xxhash64("text")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return rows.where(draw < share)


def _fit_round(sample: DataFrame, langs: list[str], idf: np.ndarray, z: np.ndarray, n: np.ndarray):
    """One pass of FTRL over each part of the sample from the same state; the mean state."""
    shared = sample.sparkSession.sparkContext.broadcast((z, n))

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        state_z, state_n = (a.copy() for a in shared.value)
        grams, order = Grams(), {lang: i for i, lang in enumerate(langs)}
        for lang, text in group.sort_values("draw")[["lang", "text"]].itertuples(index=False):
            counts = grams.counts(text)
            if counts is None:
                continue
            at, x = _features(counts, idf)
            at, x = np.append(at, BUCKETS), np.append(x, 1.0)  # the last column is the bias
            zs, ns = state_z[:, at], state_n[:, at]
            w = _leader(zs, ns)
            p = _softmax(w @ x)
            p[order[lang]] -= 1
            g = p[:, None] * x
            state_z[:, at] = zs + g - (np.sqrt(ns + g * g) - np.sqrt(ns)) / ALPHA * w
            state_n[:, at] = ns + g * g
        return pd.DataFrame({"z": [state_z.tobytes()], "n": [state_n.tobytes()]})

    states = sample.groupBy("part").applyInPandas(fit, "z binary, n binary").collect()
    back = lambda name: np.mean([np.frombuffer(r[name]).reshape(z.shape) for r in states], axis=0)
    return (back("z"), back("n")) if states else (z, n)


def _temperature(logits: np.ndarray, truth: np.ndarray) -> float:
    """The temperature with the least negative log-likelihood, by golden-section search."""

    def loss(log_t: float) -> float:
        p = _softmax(logits / np.exp(log_t))
        return -np.log(np.maximum(p[np.arange(len(truth)), truth], 1e-300)).mean()

    low, high, ratio = np.log(0.01), np.log(100.0), (np.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def fit_language_model(rows: DataFrame) -> Model:
    """Fit on (doc_id, text, lang, bucket); buckets 2 to 4 train, bucket 1 sets the temperature.

    Rows without text, language or bucket, and bucket 0, must be filtered out before.
    Document frequencies are taken over all rows; ``FIT_PER_LANGUAGE`` and
    ``CALIBRATE_PER_LANGUAGE`` bound the rows of the two fits.
    """
    scratch = Scratch(rows.sparkSession)
    sample = scratch.write(
        _bounded(rows.where("bucket > 1"), FIT_PER_LANGUAGE, "fit").select(
            "lang", "text", F.xxhash64("doc_id", "text").alias("draw")
        ).withColumn("part", F.pmod("draw", F.lit(PARTS))), "language-fit",
    )
    langs = sorted(r["lang"] for r in sample.select("lang").distinct().collect())
    if not langs:
        return Model([], np.zeros(BUCKETS), np.zeros((0, BUCKETS)), np.zeros(0))
    seen = document_frequencies(rows)
    idf = np.log((1 + seen[-1]) / (1 + seen[:-1])) + 1
    z = np.zeros((len(langs), BUCKETS + 1))
    n = np.zeros_like(z)
    for _ in range(ROUNDS):
        z, n = _fit_round(sample, langs, idf, z, n)
    w = _leader(z, n)
    model = Model(langs, idf, w[:, :-1], w[:, -1])

    known = _bounded(rows.where((F.col("bucket") == 1) & F.col("lang").isin(langs)), CALIBRATE_PER_LANGUAGE, "calibrate")

    def logits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams()
        for batch in batches:
            rows = [(lang.as_py(), grams.counts(text.as_py())) for lang, text in zip(batch.column(0), batch.column(1))]
            rows = [(langs.index(lang), model.logits(c).tolist()) for lang, c in rows if c is not None]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.list_(pa.float64()))], ["lang", "z"])

    found = known.select("lang", "text").mapInArrow(logits, "lang int, z array<double>").collect()
    if found:
        model.temperature = _temperature(np.array([r["z"] for r in found]), np.array([r["lang"] for r in found]))
    return model


def predicted_language(text: Column, model: Model, spark) -> Column:
    """struct(lang, score) of a text column."""
    shared = spark.sparkContext.broadcast((model.langs, model.idf, model.weights, model.bias, model.temperature))

    @F.arrow_udf("lang string, score double")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        langs, idf, weights, bias, temperature = shared.value
        grams = Grams()
        for texts in batches:
            names, scores = [], []
            for text in texts:
                counts = grams.counts(text.as_py()) if text.is_valid and langs else None
                if counts is None:
                    names.append(UNDETERMINED)
                    scores.append(0.0)
                    continue
                at, x = _features(counts, idf)
                p = _softmax((weights[:, at] @ x + bias) / temperature)
                best = int(p.argmax())
                names.append(langs[best])
                scores.append(float(p[best]))
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang", "score"])

    return predict(text)


def identify_languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score (calibrated probability) of every whole text.

    Learnt from text and lang of the rows whose bucket (crc32 of the id modulo 5) is not
    0 and whose text, lang and id are not NULL. ``und`` with score 0 for texts that are
    NULL or have no letter, and for all texts if there is nothing to learn from. A NULL
    id is not held out, and repeated rows stay. Equal probabilities take the first
    language by name.
    """
    rows = docs.select("doc_id", "text", "lang", bucket_of_five(F.col("doc_id")).alias("bucket"))
    model = fit_language_model(rows.where("bucket > 0 and text is not null and lang is not null"))
    guess = predicted_language(F.col("text"), model, docs.sparkSession)
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), guess.alias("_p")).select(
        "doc_id", "held_out", F.col("_p.lang").alias("lang_pred"), F.col("_p.score").alias("score"),
    )
