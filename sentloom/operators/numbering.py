"""Explicit row numbers without a global window.

Rows have no order on Spark, so every table that is matched by line number gets
the number once, as a column. A window without partitions (or with one partition
per language) would send a whole corpus to one task; these functions count per
block of rows, sum over the few blocks, and add the two numbers.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from sentloom.operators.lookup import broadcast_checked
from sentloom.sources.staging import stage

# Ranges of document ids that are summed on their own, at most.
MAX_RANGES = 1024


def number_rows(
    df: DataFrame,
    order_by: Sequence[Column],
    name: str = "line_no",
    start: int = 1,
    by: Sequence[str] = (),
) -> DataFrame:
    """Number rows ``start, start+1, ...`` in the order of ``order_by`` (per group of ``by``; NULL is a group).

    The rows are range-partitioned on (by, order), so a group of any size spreads
    over partitions as long as the order columns are unique. The ranges are sampled
    anew whenever a plan is run again, so the sorted rows are written once and the
    numbers are taken from the written table.
    """
    keys = [F.col(c) for c in by]
    ranged = (
        df.repartitionByRange(*keys, *order_by)
        .sortWithinPartitions(*keys, *order_by)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_seq", F.monotonically_increasing_id())
    )
    staged = stage(ranged, "numbered")
    blocks = staged.groupBy(*by, "_part").agg(
        F.min("_seq").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    earlier = W.partitionBy(*by).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    names = {c: f"_of_{c}" for c in [*by, "_part"]}
    offsets = blocks.select(
        *[F.col(c).alias(new) for c, new in names.items()],
        (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
    )
    if not by:
        # One row per range partition of the write: bounded by the shuffle partitions.
        offsets = broadcast_checked(offsets, "offsets")
    match = reduce(and_, [F.col(c).eqNullSafe(F.col(new)) for c, new in names.items()])
    return staged.join(offsets, match).select(
        *df.columns, (F.col("_seq") + F.col("_shift") + F.lit(start)).cast("bigint").alias(name)
    )


def _ranges(ids: DataFrame, doc_id: Column) -> Column:
    """A number for each id that rises with it and is about equally often, a NULL id first.

    The borders are approximate percentiles of the ids, so sparse ids make no
    difference; they stand in the plan as constants, so an id keeps its number whenever
    it is computed again. An id is compared with every 32nd border, then with those
    between.
    """
    parts = min(MAX_RANGES, int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    number = F.col("doc_id").cast("double")
    found = ids.agg(F.percentile_approx(number, [i / parts for i in range(1, parts)] or [0.5], 100 * parts)).first()[0]
    borders = sorted(set(found or [0.0]))
    chunks = [borders[i:i + 32] for i in range(0, len(borders), 32)]
    x = F.coalesce(doc_id.cast("double"), F.lit(float("-inf")))

    def below(values: Column) -> Column:
        return F.size(F.filter(values, lambda v: v <= x))

    chunk = below(F.array(*[F.lit(c[0]) for c in chunks]))
    inside = F.element_at(F.array(*[F.array(*[F.lit(v) for v in c]) for c in chunks]), F.greatest(chunk, F.lit(1)))
    return F.when(chunk == 0, 0).otherwise((chunk - 1) * 32 + below(inside))


def _lines_before(sizes: DataFrame, part: Column) -> DataFrame:
    """Lines before each row of (_key: lang, doc_id, ..., _lines) in its language.

    The documents of a language are cut into ranges of their ids, so they spread over
    many tasks. The rows of a range are summed among themselves; the totals per language
    and range are summed once more.
    """
    ranged = sizes.withColumn("_lang", F.col("_key.lang")).withColumn("_part", part)
    earlier = W.partitionBy("_lang").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    before = ranged.groupBy("_lang", "_part").agg(F.sum("_lines").alias("_total")).select(
        F.col("_part").alias("_p"), F.col("_lang").alias("_l"), F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_before")
    )
    inside = W.partitionBy("_lang", "_part").orderBy("_key").rowsBetween(W.unboundedPreceding, -1)
    rows = ranged.withColumn("_within", F.coalesce(F.sum("_lines").over(inside), F.lit(0)))
    return rows.join(before, (F.col("_part") == F.col("_p")) & F.col("_lang").eqNullSafe(F.col("_l"))).select(
        "_key", (F.col("_before") + F.col("_within")).alias("_offset")
    )


def number_lines(docs: DataFrame, line_value: Callable[[Column], Column] | None = None) -> DataFrame:
    """Lines of documents, numbered 1.. within each language by (doc_id, position).

    ``docs`` has doc_id, lang, source, text. A NULL language is a language of its own, a
    NULL id comes first, documents with equal ids follow each other by a hash of source
    and text, and a NULL text is one NULL line. The offsets are found on ids and numbers
    of lines alone and joined back, so the text is shuffled once.

    ``line_value`` is computed from each line before the shuffle and carried as column
    ``text`` in its place; where a query needs only, say, the length of lines, the text
    itself is not moved.
    """
    lines = F.coalesce(F.split("text", "\n"), F.array(F.lit(None).cast("string")))
    # Rows that agree in all of this are copies; a struct as key also matches NULLs.
    key = F.struct("lang", "doc_id", F.xxhash64("source", "text").alias("tie")).alias("_key")
    counted = docs.select(
        key, F.coalesce(F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1, F.lit(1)).cast("bigint").alias("_n")
    )
    sizes = counted.groupBy("_key").agg(F.sum("_n").alias("_lines"))
    rows = docs.select(
        "lang", "source", "doc_id", (F.transform(lines, line_value) if line_value else lines).alias("_lines"), key
    ).withColumn("_copy", F.row_number().over(W.partitionBy("_key").orderBy("_key")) - 1)
    return (
        rows.join(_lines_before(sizes, _ranges(docs, F.col("_key.doc_id"))), "_key")
        .select(
            "lang", "source", "doc_id", (F.col("_offset") + F.col("_copy") * F.size("_lines")).alias("_offset"),
            F.posexplode("_lines").alias("_pos", "text"),
        )
        .select(
            "lang", "source", "doc_id", F.col("_pos").cast("bigint").alias("pos"), "text",
            (F.col("_offset") + F.col("_pos") + 1).alias("line_no"),
        )
    )
