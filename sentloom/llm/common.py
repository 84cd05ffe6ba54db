"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sentloom.sources.staging import delete_path, staging_path

# One word: a run of anything but the six ASCII whitespace characters.
SPACE_CLASS = r"[\x20\x09-\x0D]"


def words_of(text: Column) -> Column:
    """The words of a text, in the JVM; NULL text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_CLASS + "+"), "")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    The optimizer may copy a column expression to every place that uses it, also
    into the function of an array operation, where it would run per element. The
    variable of ``transform`` is computed once.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def bucket_of_five(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; NULL for a NULL id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def held_out(doc_id: Column) -> Column:
    """Rows that nothing is learned from: remainder 0. A NULL id is not held out."""
    return F.coalesce(bucket_of_five(doc_id) == 0, F.lit(False))


class Scratch:
    """Tables written under ``spark.checkpoint.dir`` that cut lineage, and their removal.

    Written files outlive any executor. ``drop`` removes a table that no result
    reads any more; tables a returned frame still reads stay.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def write(self, df: DataFrame, label: str) -> DataFrame:
        path = staging_path(self.spark, label)
        df.write.parquet(path)
        back = self.spark.read.schema(df.schema).parquet(path)
        back._scratch = path
        return back

    def drop(self, df: DataFrame) -> None:
        delete_path(self.spark, df._scratch)


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of a batch of texts one after another, as bytes, and each text's number of words."""
    lists = pc.ascii_split_whitespace(texts)
    counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten().cast(pa.binary())
    full = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    if not full.all():
        owner = np.repeat(np.arange(len(counts)), counts)[full]
        counts = np.bincount(owner, minlength=len(texts)).astype(np.int64)
        flat = flat.filter(pa.array(full))
    return flat, counts


def slices(batch: pa.RecordBatch, column: int, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that the texts of one part have about ``limit`` bytes; a longer text is one part."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = np.cumsum(sizes) // limit
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(sizes)]
    for start, end in zip(edges, edges[1:]):
        if end > start:
            yield batch.slice(start, end - start)
