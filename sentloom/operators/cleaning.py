"""Row-wise projections and filters on corpora and pairs (streaming-safe)."""

from __future__ import annotations

import unicodedata
from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentloom.functions import text as tx


def strip_lines(df: DataFrame, col: str = "text") -> DataFrame:
    """Strip whitespace and drop lines that are empty after it."""
    return df.withColumn(col, tx.strip(col)).filter(F.col(col) != "")


def drop_empty_pairs(df: DataFrame, strip: bool = True) -> DataFrame:
    """Drop pairs with an empty side; with ``strip`` blank sides count as empty and sides are stripped."""
    if strip:
        df = df.withColumns({"src": tx.strip("src"), "tgt": tx.strip("tgt")})
    return df.filter((F.col("src") != "") & (F.col("tgt") != ""))


def filter_by_score(df: DataFrame, threshold: float) -> DataFrame:
    """Pairs with ``score > threshold``; NULL and NaN scores never pass."""
    return df.filter((F.col("score") > F.lit(float(threshold))) & ~F.isnan("score"))


def max_pieces(df: DataFrame, limit: int = 100, col: str = "pieces") -> DataFrame:
    """Rows with at most ``limit`` pieces."""
    return df.filter(F.size(col) <= limit)


def _in_range(col: str, min_len: int | None, max_len: int | None) -> Column:
    ok = F.lit(True)
    if min_len is not None:
        ok = ok & (F.size(col) >= min_len)
    if max_len is not None:
        ok = ok & (F.size(col) <= max_len)
    return ok


def length_filter(
    df: DataFrame,
    min_len: int | None = None,
    max_len: int | None = None,
    cols: Sequence[str] = ("src_pieces", "tgt_pieces"),
) -> DataFrame:
    """Keep a row only if every side is non-empty and within the length limits."""
    for col in cols:
        df = df.filter((F.size(col) > 0) & _in_range(col, min_len, max_len))
    return df


def encode_stats(
    df: DataFrame,
    min_len: int | None = None,
    max_len: int | None = None,
    cols: Sequence[str] = ("src_pieces", "tgt_pieces"),
) -> DataFrame:
    """One row: lines read, empty sides, sides outside the length limits, rows kept."""
    empty = [F.size(c) <= 0 for c in cols]
    short_or_long = [(F.size(c) > 0) & ~_in_range(c, min_len, max_len) for c in cols]
    bad = F.lit(False)
    for e, s in zip(empty, short_or_long):
        bad = bad | e | s

    def total(flags: list[Column]) -> Column:
        hits = F.lit(0)
        for flag in flags:
            hits = hits + F.when(flag, 1).otherwise(0)
        return F.coalesce(F.sum(hits), F.lit(0)).cast("bigint")

    return df.agg(
        F.count(F.lit(1)).alias("num_lines"),
        total(empty).alias("num_empty"),
        total(short_or_long).alias("num_filtered"),
        total([~bad]).alias("num_kept"),
    )


def parse_hypotheses(df: DataFrame, field: str = "last", col: str = "line") -> DataFrame:
    """Hypotheses of a decoder log: (sent_id, score, text).

    Only ``H-<id>`` lines are hypotheses. ``field="last"`` takes the text after the
    last tab, ``"third"`` the third field; they differ when the text holds a tab.
    """
    if field not in ("last", "third"):
        raise ValueError(f"field must be 'last' or 'third', not {field!r}")
    parts = F.split(F.substring(F.col(col), 3, 2147483647), "\t")
    return (
        df.filter(F.col(col).startswith("H-"))
        .select(parts.alias("_f"))
        .select(
            F.get("_f", F.lit(0)).try_cast("bigint").alias("sent_id"),
            F.get("_f", F.lit(1)).try_cast("double").alias("score"),
            (F.get("_f", F.size("_f") - 1) if field == "last" else F.get("_f", F.lit(2))).alias("text"),
        )
    )


def parse_report(df: DataFrame, col: str = "line") -> DataFrame:
    """Metric value of each report line: its third space-separated field."""
    return df.withColumn("value", F.get(F.split(col, " "), F.lit(2)).try_cast("double"))


def lower_text(df: DataFrame, col: str = "text") -> DataFrame:
    """Lowercase, full Unicode."""
    return df.withColumn(col, F.lower(col))


def normalize_text(df: DataFrame, form: str = "NFKC", col: str = "text") -> DataFrame:
    """Bring a text column to a Unicode normal form (NFC, NFKC, NFD or NFKD), in Arrow batches."""
    if form not in ("NFC", "NFKC", "NFD", "NFKD"):
        raise ValueError(f"unknown normal form {form!r}")

    @F.arrow_udf("string")
    def normal(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else unicodedata.normalize(form, t) for t in texts.to_pylist()], pa.string())

    return df.withColumn(col, normal(F.col(col)))


def with_placeholder(df: DataFrame, col: str = "tgt") -> DataFrame:
    """A placeholder target side for monolingual text: the line number as a string."""
    return df.withColumn(col, F.col("line_no").cast("string"))


def add_lang_tags(
    df: DataFrame,
    src_tag: str,
    tgt_tag: str,
    src_col: str = "src_pieces",
    tgt_col: str = "tgt_pieces",
) -> DataFrame:
    """Put the source and target language tags in front of the piece sequences."""
    return df.withColumns({
        src_col: F.concat(F.array(F.lit(src_tag)), F.col(src_col)),
        tgt_col: F.concat(F.array(F.lit(tgt_tag)), F.col(tgt_col)),
    })


def decode_pieces(df: DataFrame, col: str = "pieces", out: str = "text") -> DataFrame:
    """Pieces to text."""
    return df.withColumn(out, tx.join_pieces(col))


def remove_subwords(df: DataFrame, col: str = "text") -> DataFrame:
    """Remove subword markup from model output."""
    return df.withColumn(col, tx.remove_subwords(col))


def assign_splits(df: DataFrame, splits: Mapping[str, str]) -> DataFrame:
    """Rows of the named corpora with their role (train, valid, test); other corpora are left out.

    The mapping comes from a configuration, so it is a literal in the plan: the
    corpus filter reaches the scan and no join is needed.
    """
    role = F.create_map(*[F.lit(x) for item in splits.items() for x in item])
    return df.filter(F.col("corpus").isin(*splits)).withColumn("split", role[F.col("corpus")])
