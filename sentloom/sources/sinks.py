"""Writing corpora, word lists, datasets and results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentloom import schema
from sentloom.functions import text as tx
from sentloom.operators.ledger import best_run
from sentloom.operators.stats import order_by_frequency
from sentloom.sources.staging import path_exists


def write_sides(df: DataFrame, path: str, src_name: str = "src", tgt_name: str = "tgt") -> tuple[str, str]:
    """Write the two sides of a pair table as line files in the same order, by line number.

    One job writes both: every task sorts its range of line numbers and writes a file for
    each side, so the sides belong together whatever is retried. Tabs and line breaks
    inside a side become spaces, so that line n of one side belongs to line n of the
    other. Returns the two folders.
    """
    sides = F.array(*[
        F.struct(F.lit(name).alias("side"), tx.one_line(col).alias("value")) for col, name in (("src", src_name), ("tgt", tgt_name))
    ])
    rows = df.select("line_no", F.inline(sides)).repartitionByRange("line_no").sortWithinPartitions("side", "line_no")
    rows.select("side", "value").write.mode("overwrite").partitionBy("side").text(path)
    out = (f"{path}/side={src_name}", f"{path}/side={tgt_name}")
    for folder in out:
        if not path_exists(df.sparkSession, folder):  # no pairs, no files
            rows.select("value").limit(0).write.text(folder)
    return out


def write_lines(df: DataFrame, path: str, col: str = "text") -> str:
    """Write a line table as text files in line order."""
    ordered = df.select("line_no", col).repartitionByRange("line_no").sortWithinPartitions("line_no")
    ordered.select(tx.one_line(col).alias("value")).write.mode("overwrite").text(path)
    return path


def write_scored(df: DataFrame, path: str) -> str:
    """Write scored pairs as ``src <tab> tgt <tab> score`` lines."""
    line = F.concat_ws("\t", tx.one_line("src"), tx.one_line("tgt"), F.col("score").cast("string"))
    df.select(line.alias("value")).write.mode("overwrite").text(path)
    return path


def write_wordfreq(counts: DataFrame, path: str) -> str:
    """Write (word, count) as gzipped ``count word`` lines, most frequent first."""
    line = F.concat_ws(" ", F.col("count").cast("string"), F.col("word"))
    order_by_frequency(counts).select(line.alias("value")).write.mode("overwrite").option(
        "compression", "gzip"
    ).text(path)
    return path


def write_result(ledger: DataFrame, path: str) -> str:
    """Write the best run of every direction as JSON lines."""
    best_run(ledger).coalesce(1).write.mode("overwrite").json(path)
    return path


def write_synthetic(df: DataFrame, path: str) -> str:
    """Write synthetic corpora as Parquet, one folder per pair of origins (pruned on read)."""
    df.write.mode("overwrite").partitionBy("l1_origin", "l2_origin").parquet(path)
    return path


def read_synthetic(spark: SparkSession, path: str) -> DataFrame:
    """Synthetic corpora as written; no pairs leave no files, so the columns are not read from them."""
    return spark.read.schema(schema.SYNTHETIC).parquet(path)


def write_splits(df: DataFrame, path: str) -> str:
    """Write a corpus with roles as Parquet, one folder per split (pruned on read).

    No rows leave no files: read such a folder with the schema of ``df``.
    """
    df.write.mode("overwrite").partitionBy("split").parquet(path)
    return path
