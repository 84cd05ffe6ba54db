"""Joins by line number and by sentence id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pair_by_line(src: DataFrame, tgt: DataFrame, how: str = "pad") -> DataFrame:
    """Pair two line tables (line_no, text, ...) by number.

    ``pad`` keeps every line and fills the missing side with "" (as when two files
    are pasted); ``truncate`` stops at the shorter side. Line numbers are unique per
    side, so the equi-join has no hot key. Other columns of ``src`` are kept.
    """
    if how not in ("pad", "truncate"):
        raise ValueError(f"how must be 'pad' or 'truncate', not {how!r}")
    extra = [c for c in src.columns if c not in ("line_no", "text")]
    left = src.select("line_no", *extra, F.col("text").alias("src"))
    right = tgt.select("line_no", F.col("text").alias("tgt"))
    joined = left.join(right, "line_no", "full_outer" if how == "pad" else "inner")
    if how == "truncate":
        return joined.select("line_no", *extra, "src", "tgt")
    return joined.select(
        "line_no", *extra,
        F.coalesce("src", F.lit("")).alias("src"), F.coalesce("tgt", F.lit("")).alias("tgt"),
    )


def side(df: DataFrame, name: str) -> DataFrame:
    """One side (``src`` or ``tgt``) of a pair table as a line table."""
    return df.select("line_no", F.col(name).alias("text"))


def attach_hypotheses(src: DataFrame, hyps: DataFrame) -> DataFrame:
    """Source rows with their hypotheses, by sentence id (rows without one are left out)."""
    return src.join(hyps, "sent_id")


def missing_hypotheses(src: DataFrame, hyps: DataFrame) -> DataFrame:
    """One row: how many source rows have no hypothesis."""
    return (
        src.select("sent_id").join(hyps.select("sent_id"), "sent_id", "left_anti")
        .agg(F.count(F.lit(1)).alias("missing"))
    )


def missing_corpora(config: DataFrame, df: DataFrame) -> DataFrame:
    """Corpus names of ``config`` (column corpus) that have no row in ``df``."""
    return config.join(df.select("corpus").distinct(), "corpus", "left_anti")
