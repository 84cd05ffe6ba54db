"""Concatenation, augmentation and the student mixtures."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentloom.operators.cleaning import drop_empty_pairs

# Origins of (language 1, language 2) in the two kinds of synthetic pairs.
ORIGINS = {"so": ("synthetic", "original"), "os": ("original", "synthetic")}
# Which kinds a student gets besides the parallel pairs.
MIXTURES = {
    ("back", "1n"): ("so",),
    ("back", "n1"): ("os",),
    ("forward", "1n"): ("os",),
    ("forward", "n1"): ("so",),
    ("all", "1n"): ("so", "os"),
    ("all", "n1"): ("so", "os"),
}


def last_lines(dfs: Sequence[DataFrame]) -> list[int]:
    """The last line number of each corpus, 0 if it has none: one job that reads only line numbers."""
    numbers = [df.select(F.lit(i).alias("_nth"), F.col("line_no").cast("bigint").alias("line_no")) for i, df in enumerate(dfs)]
    if not numbers:
        return []
    found = reduce(DataFrame.unionByName, numbers).groupBy("_nth").agg(F.max("line_no").alias("last")).collect()
    last = {r["_nth"]: r["last"] for r in found}
    return [last.get(i) or 0 for i in range(len(dfs))]


def concat_corpora(dfs: Sequence[DataFrame], last: Sequence[int] | None = None) -> DataFrame:
    """Concatenate numbered corpora in the listed order; duplicates stay.

    A corpus starts after the last line of the ones before it. Only the last lines of all
    but the last corpus are needed (``last``, looked up by :func:`last_lines` if not
    given); they stand in the plan as constants, so no row is moved or written.
    """
    dfs = list(dfs)
    if last is None:
        last = last_lines(dfs[:-1])
    offset, parts = 0, []
    for i, df in enumerate(dfs):
        parts.append(df.select(*dfs[0].columns).withColumn("line_no", F.col("line_no") + F.lit(offset).cast("bigint")))
        offset += last[i] if i < len(dfs) - 1 else 0
    return reduce(DataFrame.unionByName, parts)


def augment(parallel: DataFrame, synthetic: DataFrame, last: int | None = None) -> DataFrame:
    """Parallel pairs plus (synthetic source, original target) pairs, without empty sides.

    Columns: line_no, src, tgt, src_origin, tgt_origin. The synthetic pairs come
    after the ``last`` parallel line, which is looked up if not given.
    """
    real = parallel.select(
        "line_no", "src", "tgt", F.lit("original").alias("src_origin"), F.lit("original").alias("tgt_origin")
    )
    made = synthetic.select(
        "line_no", "src", "tgt", F.lit("synthetic").alias("src_origin"), F.lit("original").alias("tgt_origin")
    )
    return drop_empty_pairs(concat_corpora([real, made], None if last is None else [last]))


def mixture(parallel: DataFrame, synthetic: DataFrame, flavour: str, direction: str) -> DataFrame:
    """Training pairs of a student: (line_no, l1, l2, l1_origin, l2_origin).

    ``parallel`` has (line_no, l1, l2); ``synthetic`` has all five columns. The parallel
    pairs come first. The six students need three different datasets (``back`` 1n is
    ``forward`` n1, and so on); runs that differ only by their training seed share one.
    """
    cols = ["line_no", "l1", "l2", "l1_origin", "l2_origin"]
    real = parallel.withColumns({"l1_origin": F.lit("original"), "l2_origin": F.lit("original")})
    parts = [
        synthetic.filter((F.col("l1_origin") == ORIGINS[p][0]) & (F.col("l2_origin") == ORIGINS[p][1]))
        for p in MIXTURES[flavour, direction]
    ]
    return concat_corpora([df.select(*cols) for df in [real, *parts]])


def joint_text(df: DataFrame, src: str = "src", tgt: str = "tgt") -> DataFrame:
    """Both sides of the pairs as one text column (input of subword training)."""
    return df.select(F.explode(F.array(src, tgt)).alias("text"))
