"""Reading line corpora, parallel corpora, scored pairs and word lists from text files."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from sentloom.functions import text as tx
from sentloom.operators.lookup import broadcast_checked
from sentloom.operators.pairing import missing_corpora, pair_by_line
from sentloom.sources.staging import path_exists, stage

def read_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Lines of text files with a stable 1-based number: (line_no, text, path).

    The files follow each other as listed; those of one entry (a glob or a folder) in
    path order. How files are cut into blocks follows the cores at hand at that moment,
    so the lines are written once, with the block they came from; a count of the lines
    per block (one row per block) gives the blocks' offsets, and a line's number is its
    place in its block plus that. The text is neither shuffled nor sorted, and no
    setting of the session is touched.
    """
    listed = [paths] if isinstance(paths, str) else list(paths)
    if not listed:
        raise ValueError("no paths given")
    raw = reduce(DataFrame.unionAll, [
        spark.read.option("lineSep", "\n").text(path).select(
            F.lit(i).alias("_nth"), "value",
            F.col("_metadata.file_path").alias("_path"),
            F.col("_metadata.file_block_start").alias("_start"),
        )
        for i, path in enumerate(listed)
    ])
    rows = stage(raw.withColumn("_seq", F.monotonically_increasing_id()), "lines")
    blocks = rows.groupBy("_nth", "_path", "_start").agg(
        F.min("_seq").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    # Offsets of files within the list, then of blocks within their file: no window sees all blocks.
    by_file = blocks.groupBy("_nth", "_path").agg(F.sum("_rows").alias("_rows"))
    files = W.orderBy("_nth", "_path").rowsBetween(W.unboundedPreceding, -1)
    in_file = W.partitionBy("_nth", "_path").orderBy("_start").rowsBetween(W.unboundedPreceding, -1)
    before = by_file.select("_nth", "_path", F.coalesce(F.sum("_rows").over(files), F.lit(0)).alias("_files"))
    offsets = broadcast_checked(
        blocks.withColumn("_blocks", F.coalesce(F.sum("_rows").over(in_file), F.lit(0)))
        .join(before, ["_nth", "_path"])
        .select("_nth", "_path", "_start", (F.col("_files") + F.col("_blocks") - F.col("_first") + 1).alias("_shift")),
        "blocks",
    )
    return rows.join(offsets, ["_nth", "_path", "_start"]).select(
        (F.col("_seq") + F.col("_shift")).alias("line_no"), F.col("value").alias("text"), F.col("_path").alias("path")
    )


def read_corpus(spark: SparkSession, paths: str | Sequence[str], corpus: str, lang: str) -> DataFrame:
    """A named monolingual corpus in the corpus schema; tabs and carriage returns become spaces."""
    return read_lines(spark, paths).select(
        F.lit(corpus).alias("corpus"), F.lit(lang).alias("lang"), "line_no", tx.one_line("text").alias("text")
    )


def corpus_paths(spark: SparkSession, root: str, names: Sequence[str], lang: str) -> list[str]:
    """Paths ``<root>/<name>.<lang>`` of the named corpora, in the order given; missing ones are an error."""
    paths = [f"{root.rstrip('/')}/{name}.{lang}" for name in names]
    found = [(name,) for name, path in zip(names, paths) if path_exists(spark, path)]
    config = spark.createDataFrame([(name,) for name in names], "corpus string")
    missing = sorted(r["corpus"] for r in missing_corpora(config, spark.createDataFrame(found, "corpus string")).collect())
    if missing:
        raise ValueError(f"no corpus in {lang} for: {', '.join(missing)}")
    return paths


def read_corpora(spark: SparkSession, root: str, names: Sequence[str], lang: str) -> DataFrame:
    """Named corpora of a language, one after another in the order given: (corpus, lang, line_no, text)."""
    paths = corpus_paths(spark, root, names, lang)
    name = F.regexp_extract("path", rf"([^/]+)\.{lang}(/[^/]*)?$", 1)
    return read_lines(spark, paths).select(
        name.alias("corpus"), F.lit(lang).alias("lang"), "line_no", tx.one_line("text").alias("text")
    )


def read_parallel(
    spark: SparkSession,
    src_paths: str | Sequence[str],
    tgt_paths: str | Sequence[str],
    corpus: str,
    src_lang: str,
    tgt_lang: str,
    how: str = "pad",
) -> DataFrame:
    """A named parallel corpus: two line corpora paired by line number.

    Lists of paths are taken in the order given on either side.
    """
    flat = tx.one_line("text").alias("text")
    paired = pair_by_line(
        read_lines(spark, src_paths).select("line_no", flat),
        read_lines(spark, tgt_paths).select("line_no", flat),
        how,
    )
    return paired.select(
        F.lit(corpus).alias("corpus"), "line_no",
        F.lit(src_lang).alias("src_lang"), F.lit(tgt_lang).alias("tgt_lang"), "src", "tgt",
    )


def read_scored(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Scored pairs from ``src <tab> tgt <tab> score`` lines; a score that is no number becomes NULL.

    Fields are taken as they are: quotes and backslashes have no meaning.
    """
    lines = spark.read.option("lineSep", "\n").text(paths if isinstance(paths, str) else list(paths))
    fields = lines.select(F.split("value", "\t").alias("f"))
    return fields.select(
        F.get("f", F.lit(0)).alias("src"),
        F.get("f", F.lit(1)).alias("tgt"),
        F.get("f", F.lit(2)).try_cast("double").alias("score"),
    )


def read_wordfreq(spark: SparkSession, path: str) -> DataFrame:
    """A word-frequency list written by ``write_wordfreq``."""
    lines = spark.read.option("lineSep", "\n").text(path)
    fields = lines.select(F.split(F.ltrim("value"), " ", 2).alias("f"))
    return fields.select(
        F.get("f", F.lit(1)).alias("word"), F.get("f", F.lit(0)).try_cast("bigint").alias("count")
    )
