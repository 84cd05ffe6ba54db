"""Toxic passages as maximum-scoring segments of token log-odds, calibrated by extreme values."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentloom.llm.common import Scratch, bucket_of_five, held_out, slices, split_words

# Words' first letters that stand for words too rare to be known as a whole.
PREFIXES = (4, 5, 6, 7, 8)
# Weight of the Dirichlet prior in tokens; a piece needs this significance (in standard
# deviations) and so many texts of the class it speaks for.
PRIOR, MIN_Z, MIN_TEXTS = 500.0, 5.0, 3
# Labelled documents that the model is fitted on, at most about so many.
LABELLED = 500_000
# Pieces are sent to every executor. They come from at most ``LABELLED`` documents; more than so many are an error.
SENT_PIECES = 5_000_000
# What a token without a known piece takes from a segment, and the least score of a segment.
DRIFT, MIN_SEGMENT = 0.5, 1.0
# Width of the bins of the calibrated statistic, and its largest value.
BIN, TOP = 0.25, 60.0
MEMO = 200_000
# Bytes of text whose words a Python worker takes apart at a time; a longer text is taken whole.
PART_BYTES = 2 << 20


def normal_word(word: bytes) -> str:
    """Lower case, without the marks around it."""
    text = word.decode("utf-8", "replace").lower()
    start, end = 0, len(text)
    while start < end and not text[start].isalnum():
        start += 1
    while end > start and not text[end - 1].isalnum():
        end -= 1
    return text[start:end]


class Normal(dict):
    """Remembered normal forms (or what ``value`` makes of them)."""

    def __init__(self, value=None):
        super().__init__()
        self.value = value

    def __missing__(self, word: bytes):
        if len(self) > MEMO:
            self.clear()
        out = normal_word(word)
        out = self[word] = self.value(out) if self.value else out
        return out


def token_counts(rows: DataFrame) -> DataFrame:
    """word, toxic, clean: how many toxic and other texts of (text, toxic) have each normal word.

    A text counts once, so one that repeats a word says no more about it than another.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        normal = Normal()
        for batch in batches:
            for part in slices(batch, 0, PART_BYTES):
                flat, counts = split_words(part.column(0))
                if not len(flat):
                    continue
                toxic = np.repeat(part.column(1).to_numpy(zero_copy_only=False) == 1, counts)
                coded = flat.dictionary_encode()
                n = len(coded.dictionary)
                own = np.repeat(np.arange(len(counts)), counts) * n + coded.indices.to_numpy(zero_copy_only=False)
                own, first = np.unique(own, return_index=True)
                at, toxic = own % n, toxic[first]
                bad, all_of = np.bincount(at[toxic], minlength=n), np.bincount(at, minlength=n)
                words = [normal[w] for w in coded.dictionary.to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(bad), pa.array(all_of - bad)], ["word", "toxic", "clean"])
        # The worker lives on and may stand idle beside others.
        pa.default_memory_pool().release_unused()

    found = rows.select("text", "toxic").mapInArrow(count, "word string, toxic long, clean long")
    return found.where("word <> ''").groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def log_odds(words: DataFrame) -> DataFrame:
    """piece, score, z: significant pieces of words (``=word`` or the first letters), toxic and clean ones, by log-odds.

    The informative Dirichlet prior has each piece at its share of all tokens, with the
    weight of ``PRIOR`` tokens in either class. ``z`` is the root of the likelihood-ratio
    statistic of the two counts, which also holds where a piece is in no clean text.
    """
    pieces = F.array(F.concat(F.lit("="), "word"), *[F.when(F.length("word") > n, F.substring("word", 1, n)) for n in PREFIXES])
    nt, nc = (F.lit(x or 0) for x in words.agg(F.sum("toxic"), F.sum("clean")).first())
    rows = (
        words.select(F.explode(pieces).alias("piece"), "toxic", "clean").where("piece is not null")
        .groupBy("piece").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c")).where(F.greatest("t", "c") >= MIN_TEXTS)
    )
    prior = PRIOR * (F.col("t") + F.col("c")) / (nt + nc)

    def odds(y: Column, n: Column) -> Column:
        return F.ln((y + prior) / (n + PRIOR - y - prior))

    score = odds(F.col("t"), nt) - odds(F.col("c"), nc)
    both = F.col("t") + F.col("c")

    def surprise(y: Column, n: Column) -> Column:
        return F.when(y > 0, y * F.ln(y * (nt + nc) / (both * n))).otherwise(F.lit(0.0))

    z = F.sqrt(F.greatest(2 * (surprise(F.col("t"), nt) + surprise(F.col("c"), nc)), F.lit(0.0)))
    return rows.select("piece", score.alias("score"), z.alias("z"), "t", "c").where(
        (F.col("z") >= MIN_Z) & (((F.col("score") > 0) & (F.col("t") >= MIN_TEXTS)) | ((F.col("score") < 0) & (F.col("c") >= MIN_TEXTS)))
    )


def segments(at: list[int], before: list[float], after: list[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, last + 1, score) of a row of tokens, in linear time.

    ``at`` are the places of tokens with a score above 0, ``before`` and ``after`` the sums
    of all scores up to each of them, without it and with it; tokens between them only
    lower the sum. Candidates are kept with their two sums. A new one looks for
    the last candidate that starts lower; if that ends lower too, the two and all between
    become one, and it looks again (Ruzzo and Tompa, 1999). Each candidate remembers the
    last one that starts lower, so no candidate is passed twice.
    """
    found: list[tuple[int, int, float, float, int]] = []  # first, end, sum before, sum after, lower
    for first, low, total in zip(at, before, after):
        end, j = first + 1, len(found) - 1
        while True:
            while j >= 0 and found[j][2] >= low:
                j = found[j][4]
            if j < 0 or found[j][3] >= total:
                break
            first, low, lower = found[j][0], found[j][2], found[j][4]
            del found[j:]
            j = lower
        found.append((first, end, low, total, j))
    return [(a, b, high - low) for a, b, low, high, _ in found]


def passages_of(text: Column, pieces: dict[str, float], spark) -> Column:
    """struct(n_tokens, passages): the toxic passages (first token, last + 1, score) of a text column."""
    shared = spark.sparkContext.broadcast(pieces)

    @F.arrow_udf("n_tokens long, passages array<struct<start:int,end:int,score:double>>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = shared.value

        def score(word: str) -> float:
            found = known.get("=" + word)
            for n in reversed(PREFIXES):
                if found is None and len(word) > n:
                    found = known.get(word[:n])
            return found or 0.0

        scores = Normal(score)
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
        for texts in batches:
            numbers, passages = [], []
            for part in slices(pa.RecordBatch.from_arrays([texts], ["t"]), 0, PART_BYTES):
                flat, counts = split_words(part.column(0))
                coded = flat.dictionary_encode()
                table = np.fromiter((scores[w] for w in coded.dictionary.to_pylist()), float, len(coded.dictionary))
                # A token without a known piece is slightly clean; known ones have their own log-odds, above or below 0.
                table[table == 0] = -DRIFT
                value = table[coded.indices.to_numpy(zero_copy_only=False)] if len(table) else np.empty(0)
                hits, ends = np.flatnonzero(value > 0), np.cumsum(counts)
                owner = np.searchsorted(ends, hits, side="right")
                numbers += counts.tolist()
                for row, (lo, hi) in enumerate(zip(np.searchsorted(owner, np.arange(len(counts))), np.searchsorted(owner, np.arange(len(counts)), side="right"))):
                    made = []
                    if hi > lo:
                        own = value[ends[row] - counts[row]:ends[row]]
                        at, after = hits[lo:hi] - (ends[row] - counts[row]), np.cumsum(own)
                        made = segments(at.tolist(), (after[at] - own[at]).tolist(), after[at].tolist())
                    passages.append([{"start": a, "end": b, "score": s} for a, b, s in made if s >= MIN_SEGMENT])
            yield pa.StructArray.from_arrays([pa.array(numbers, pa.int64()), pa.array(passages, kind)], ["n_tokens", "passages"])
        pa.default_memory_pool().release_unused()

    return run(text)


@dataclass
class Calibration:
    """Extreme-value law of clean texts (decay, density) and the logistic curve over its statistic."""

    decay: float = 1.0
    density: float = 1.0
    slope: float = 0.0
    offset: float = -20.0

    def statistic(self) -> Column:
        """Minus the log of the number of passages this strong that a clean text of this length has by chance.

        Several passages count as one whose chances add up. 0 without a passage.
        """
        top = F.array_max(F.transform("passages", lambda p: p["score"]))
        rest = F.aggregate("passages", F.lit(0.0), lambda a, p: a + F.exp(self.decay * (p["score"] - top)))
        chance = self.decay * top + F.ln(rest) - F.ln(self.density * F.col("n_tokens"))
        return F.when(F.size("passages") > 0, F.least(F.greatest(chance, F.lit(0.0)), F.lit(TOP))).otherwise(F.lit(0.0))

    def score(self) -> Column:
        return 1 / (1 + F.exp(-(self.slope * self.statistic() + self.offset)))


def calibrate(scanned: DataFrame) -> Calibration:
    """Fit on (n_tokens, passages, toxic): decay and density by likelihood, then the logistic curve.

    Under the extreme-value law a clean text of n tokens has no passage above s with
    probability exp(-K n exp(-L s)). For each L the best K is known, so one aggregation
    tries all L. The curve is fitted to counts by bin of the statistic.
    """
    decays = [round(0.05 * 1.12**i, 4) for i in range(40)]
    clean = scanned.where("toxic = 0 and n_tokens > 0").select(
        "n_tokens", F.array_max(F.transform("passages", lambda p: p["score"])).alias("s"))
    none = clean.where("s is null").agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0]
    sums = (
        clean.where("s is not null").withColumn("l", F.explode(F.array(*[F.lit(x) for x in decays]))).groupBy("l")
        .agg(F.count("*").alias("m"), F.sum("s").alias("s"), F.sum(F.col("n_tokens") * F.exp(-F.col("l") * F.col("s"))).alias("d"))
        .collect()
    )
    if sums:
        likelihood = lambda r: r["m"] * math.log(r["m"] / (r["d"] + none)) + r["m"] * math.log(r["l"]) - r["l"] * r["s"]
        best = max(sums, key=lambda r: (likelihood(r), -r["l"]))
        out = Calibration(best["l"], best["m"] / (best["d"] + none))
    else:
        out = Calibration(1.0, 0.5 / max(none, 1))
    bins = scanned.select(F.round(out.statistic() / BIN).alias("x"), "toxic").groupBy("x").agg(
        F.sum(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("t"), F.count("*").alias("n")).collect()
    if bins:
        x = np.array([r["x"] * BIN for r in bins])
        out.slope, out.offset = _logistic(x, np.array([r["t"] for r in bins], float), np.array([r["n"] for r in bins], float))
    return out


def _logistic(x: np.ndarray, t: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """Slope (not below 0) and offset by Newton steps, with a weak pull to 0 and 0."""
    w, design = np.zeros(2), np.stack([x / 10, np.ones_like(x)], axis=1)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        grad = design.T @ (t - n * p) - 1e-3 * w
        hess = (design * (n * p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        w += step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-9:
            break
    return (w[0] / 10, w[1]) if w[0] > 0 else (0.0, math.log((t.sum() + 0.5) / (n.sum() - t.sum() + 0.5)))


def _labels(labels: DataFrame) -> DataFrame:
    """0 or 1 for each labelled id that may be learnt from, 1 if its rows disagree; about ``LABELLED`` ids at most.

    They are chosen by a hash of the id.
    """
    known = labels.where(bucket_of_five(F.col("doc_id")) > 0).where("toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    draw = F.pmod(F.xxhash64(F.lit("toxic"), "doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return known.where(draw < min(1.0, LABELLED / max(1, known.count())))


def fit_toxicity(docs: DataFrame, labels: DataFrame) -> tuple[dict[str, float], Calibration]:
    """Scores of the significant pieces and the calibration, from labelled rows that are not held out.

    ``LABELLED`` bounds their number, so the labels go to the texts and no text is
    shuffled. The labelled texts are written out once and read twice: to count words,
    and to scan them for passages.
    """
    scratch, spark = Scratch(docs.sparkSession), docs.sparkSession
    rows = docs.where(bucket_of_five(F.col("doc_id")) > 0).select("doc_id", "text")
    learn = scratch.write(rows.join(F.broadcast(_labels(labels)), "doc_id").select("text", "toxic"), "toxic-labelled")
    words = scratch.write(token_counts(learn), "toxic-words")
    found = scratch.write(log_odds(words).select("piece", "score"), "toxic-pieces")
    if found.count() > SENT_PIECES:
        raise ValueError(f"more than {SENT_PIECES} significant pieces: ask for more significance")
    table = found.toArrow()
    pieces = dict(zip(table["piece"].to_pylist(), table["score"].to_pylist()))
    scanned = scratch.write(
        learn.select(passages_of(F.col("text"), pieces, spark).alias("s"), "toxic").select("s.*", "toxic"), "toxic-passages"
    )
    law = calibrate(scanned)
    for written in (learn, words, found, scanned):
        scratch.drop(written)
    return pieces, law


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, n_tokens and passages of every whole text.

    Learnt from labels.toxic (0 or 1; other values are ignored) of the ids whose bucket
    (crc32 of the id modulo 5) is not 0; a score uses the text only. A text without a
    toxic passage, also one that is NULL or empty, has the score of the curve at 0: the
    share of toxic labels among texts like it. With no labels at all every score is
    near 0. Rows with a NULL id are scored and not held out; repeated rows stay. Columns
    of ``docs`` other than doc_id and text are not read.
    """
    pieces, law = fit_toxicity(docs, labels)
    scanned = docs.select("doc_id", passages_of(F.col("text"), pieces, docs.sparkSession).alias("_s")).select("doc_id", "_s.*")
    score = law.score().alias("score")
    return scanned.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score, "n_tokens", "passages").select(
        "doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_tokens", "passages",
    )


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents whose score is below one half, with all their columns."""
    pieces, law = fit_toxicity(docs, labels)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    scanned = docs.select(row, passages_of(F.col("text"), pieces, docs.sparkSession).alias("_s")).select("_row", "_s.*")
    return scanned.where(law.score() < 0.5).select("_row.*")
