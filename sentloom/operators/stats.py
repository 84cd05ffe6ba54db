"""Counts over corpora and pair tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentloom.functions.text import SEPARATOR_RUN
from sentloom.operators.tokenization import PLAIN_WORD, tokens

THRESHOLDS = tuple(t / 10 for t in range(10))


def corpus_counts(df: DataFrame, by: Sequence[str] = ("corpus",)) -> DataFrame:
    """Rows per corpus (or split, language ...)."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"))


def word_frequencies(
    df: DataFrame,
    lang: str,
    min_count: int = 2,
    as_written: bool = False,
    col: str = "text",
) -> DataFrame:
    """Lowercased word counts without rare words: (word, count).

    Tokenisation never looks across whitespace, so the whitespace-separated strings are
    counted first (map-side, before any shuffle) and only the distinct ones are
    tokenised: the rules run on the vocabulary, not on the corpus, and a word that
    makes up a third of a corpus costs one row per task. ``as_written`` keeps the
    literal rule of the batch pipeline instead of ``min_count``: a line "count word"
    is dropped when it holds the digit 1 anywhere.
    """
    raw = (
        df.select(F.explode(F.split(F.lower(col), SEPARATOR_RUN)).alias("_raw"))
        .filter(F.col("_raw") != "")
        .groupBy("_raw").agg(F.count(F.lit(1)).alias("_n"))
    )
    found = F.when(F.col("_raw").rlike(PLAIN_WORD), F.array("_raw")).otherwise(tokens("_raw", lang))
    counts = (
        raw.select(F.explode(found).alias("word"), "_n")
        .groupBy("word").agg(F.sum("_n").alias("count"))
    )
    if as_written:
        return counts.filter(~F.col("word").contains("1") & ~F.col("count").cast("string").contains("1"))
    return counts.filter(F.col("count") >= min_count)


def order_by_frequency(counts: DataFrame) -> DataFrame:
    """Most frequent first; equal counts by word, byte-wise descending."""
    return counts.orderBy(F.desc("count"), F.desc("word"))


def threshold_sweep(
    df: DataFrame,
    thresholds: Sequence[float] = THRESHOLDS,
    by: Sequence[str] = (),
) -> DataFrame:
    """Pairs with ``score > t`` for every threshold, in one pass: (by..., threshold, n_pairs).

    One partial aggregate per task holds all thresholds; only the totals are
    shuffled, and the unpivot runs on the aggregated rows.
    """
    ok = F.col("score").isNotNull() & ~F.isnan("score")
    totals = [
        F.coalesce(F.sum(F.when(ok & (F.col("score") > F.lit(float(t))), 1)), F.lit(0)).cast("bigint").alias(f"_t{i}")
        for i, t in enumerate(thresholds)
    ]
    wide = df.groupBy(*by).agg(*totals) if by else df.agg(*totals)
    cells = F.array(*[
        F.struct(F.lit(float(t)).alias("threshold"), F.col(f"_t{i}").alias("n_pairs"))
        for i, t in enumerate(thresholds)
    ])
    return wide.select(*by, F.inline(cells))


def vocab_coverage(
    df: DataFrame,
    vocab: DataFrame,
    by: Sequence[str] = ("split",),
    col: str = "tokens",
) -> DataFrame:
    """Token totals and out-of-vocabulary share per split.

    Tokens are counted per (split, token) before the join, so the join sees each
    token once per split and a frequent token is no hot key.
    """
    counted = (
        df.select(*by, F.explode(col).alias("token"))
        .groupBy(*by, "token").agg(F.count(F.lit(1)).alias("_n"))
    )
    known = vocab.select("token", F.lit(True).alias("_known"))
    return (
        counted.join(known, "token", "left")
        .groupBy(*by).agg(
            F.sum("_n").cast("bigint").alias("n_tokens"),
            F.coalesce(F.sum(F.when(F.col("_known").isNull(), F.col("_n"))), F.lit(0)).cast("bigint").alias("n_oov"),
        )
        .withColumn("oov_rate", F.col("n_oov") / F.col("n_tokens"))
    )
