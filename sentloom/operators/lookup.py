"""Lookups of small tables, with a size check and a way beyond it."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sentloom.sources.staging import stage

# Rows and bytes a lookup table may have to be sent to every executor.
MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 64 << 20
# A key is frequent if it makes up one in so many elements, so there are at most so many of them.
FREQUENT = 10_000


def _row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row has: those of its values as text, or as JSON where a value is nested, and 8 each."""
    def size(field: T.StructField) -> Column:
        value = F.col(f"`{field.name}`")
        nested = isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType))
        return F.coalesce(F.octet_length(F.to_json(F.struct(value)) if nested else value.cast("string")), F.lit(0)) + 8

    return reduce(lambda x, y: x + y, [size(f) for f in df.schema.fields])


def stage_measured(df: DataFrame, label: str, **figures: Column) -> tuple[DataFrame, dict]:
    """Write a table once and measure what was written: the table and the figures (aggregates)."""
    staged = stage(df, label)
    return staged, staged.agg(*[f.alias(name) for name, f in figures.items()]).first().asDict()


def broadcast_checked(
    df: DataFrame, label: str, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES
) -> DataFrame:
    """``df`` written once, with a broadcast hint if its rows and bytes are within the limits.

    For results of an aggregation that are expected to be small: they are computed
    once, measured on the written table, and joined without shuffling the large side. Beyond
    a limit the join is left to the optimizer.
    """
    staged, seen = stage_measured(df, label, rows=F.count(F.lit(1)), size=F.sum(_row_bytes(df)))
    return F.broadcast(staged) if seen["rows"] <= max_rows and (seen["size"] or 0) <= max_bytes else staged


@dataclass
class Lookup:
    """A table to look up in, written and measured once, for any number of columns and frames.

    ``shared`` has its entries if they are few enough to be sent out, and their type.
    """

    entries: DataFrame
    value_type: str
    shared: tuple[Broadcast, pa.DataType] | None


def prepare_lookup(
    table: DataFrame, value_type: str, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES
) -> Lookup:
    """Prepare a table (columns key, value); a key with more than one entry is an error, a NULL key is ignored."""
    grouped = (
        table.select(F.col("key").cast("string").alias("key"), F.col("value").cast(value_type).alias("value"))
        .filter("key is not null")
        .groupBy("key").agg(F.max("value").alias("value"), F.count(F.lit(1)).alias("n"))
    )
    entries, seen = stage_measured(grouped, "lookup", rows=F.count(F.lit(1)), most=F.max("n"), size=F.sum(_row_bytes(grouped)))
    if (seen["most"] or 0) > 1:
        raise ValueError("a lookup key has more than one entry")
    entries = entries.select("key", "value")
    few = seen["rows"] <= max_rows and (seen["size"] or 0) <= max_bytes
    return Lookup(entries, value_type, _shared(entries) if few else None)


def lookup_array(
    df: DataFrame,
    col: str,
    out: str,
    table: DataFrame | Lookup,
    default,
    value_type: str,
    max_rows: int = MAX_BROADCAST_ROWS,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Replace every element of an array column by its value in ``table`` (columns key, value).

    NULL elements, and elements without an entry or with a NULL value, get ``default``;
    a NULL array stays NULL; order and repeats are kept. Entries with a NULL key are
    ignored, and a key with more than one entry is an error. The result is the same
    whether the table is sent to every executor (within ``max_rows`` and ``max_bytes``)
    or joined with the rows (beyond). A table that is used several times is prepared once,
    by :func:`prepare_lookup`.
    """
    known = table if isinstance(table, Lookup) else prepare_lookup(table, value_type, max_rows, max_bytes)
    if known.shared:
        return _replaced(df, col, out, known.shared, default, value_type)
    return _lookup_joined(df, col, out, known.entries, default, value_type)


def _shared(known: DataFrame) -> tuple[Broadcast, pa.DataType]:
    """The entries of a table within the limits, sent out, and the type of their values."""
    head = known.toArrow()
    entries = {k: v for k, v in zip(head["key"].to_pylist(), head["value"].to_pylist()) if v is not None}
    return known.sparkSession.sparkContext.broadcast(entries), head.schema.field("value").type


def _replaced(
    df: DataFrame, col: str, out: str, known: tuple[Broadcast, pa.DataType], default, value_type: str, found: str | None = None
) -> DataFrame:
    """Replace elements by ``known``, entries that were sent out, and by the entries that stand in column ``found``."""
    shared, kind = known

    def replaced(arrays: pa.Array, more: pa.StructArray | None) -> pa.Array:
        # Only the distinct elements of a batch are looked up, one by one where no entry of the batch has them.
        encoded = pc.fill_null(arrays.flatten(), "").dictionary_encode()
        get, keys = shared.value.get, encoded.dictionary
        if more is None:
            values = pa.array([get(k, default) for k in keys.to_pylist()], kind)
        else:
            # A key has one value wherever it stands, so the entries of a batch can be put together.
            at = pc.index_in(keys, value_set=more.field("key"))
            rest = iter([get(k, default) for k in keys.filter(at.is_null()).to_pylist()])
            others = pa.array([next(rest) if gap else None for gap in at.is_null().to_pylist()], kind)
            values = pc.if_else(at.is_null(), others, more.field("value").take(at))
        taken = values.take(encoded.indices)
        if arrays.flatten().null_count:
            taken = pc.if_else(arrays.flatten().is_null(), pa.scalar(default, kind), taken)
        return pa.ListArray.from_arrays(pa.array(_offsets(arrays), pa.int32()), taken, mask=arrays.is_null())

    @F.arrow_udf(f"array<{value_type}>")
    def one(arrays: pa.Array) -> pa.Array:
        return replaced(arrays, None)

    @F.arrow_udf(f"array<{value_type}>")
    def two(arrays: pa.Array, entries: pa.Array) -> pa.Array:
        return replaced(arrays, entries.flatten())

    elements = F.col(col).cast("array<string>")
    return df.withColumn(out, two(elements, F.col(found)) if found else one(elements))


def _offsets(arrays: pa.Array) -> list[int]:
    """Offsets from 0 into the flattened values; NULL arrays are empty there."""
    offsets, at = [0], 0
    for n in arrays.value_lengths().to_pylist():
        at += n or 0
        offsets.append(at)
    return offsets


def _lookup_joined(
    df: DataFrame, col: str, out: str, entries: DataFrame, default, value_type: str
) -> DataFrame:
    """Look up in a table of any size.

    Rows get a number of their own and are written once. Frequent keys, at most
    ``FREQUENT`` of them, are looked up as a small table and leave the elements before any
    is shuffled; the other keys of a row, each once, are joined with the entries, and what
    was found comes back to the row by its number. No key of that join is in more than one
    of ``FREQUENT`` elements.
    """
    rows = stage(df.withColumn("_row", F.monotonically_increasing_id()), "lookup-rows")
    elements = rows.select("_row", F.explode(F.array_distinct(F.col(col).cast("array<string>"))).alias("key")).filter("key is not null")
    counts = stage(elements.groupBy("key").agg(F.count(F.lit(1)).alias("n")), "lookup-keys")
    total = counts.agg(F.sum("n")).first()[0] or 0
    frequent = counts.filter(F.col("n") * FREQUENT > total).select("key")
    known = entries.join(F.broadcast(frequent), "key")
    rare = counts.filter(F.col("n") * FREQUENT <= total).select("key").join(entries, "key").filter("value is not null")
    found = (
        elements.join(F.broadcast(frequent), "key", "left_anti").join(rare, "key")
        .groupBy("_row").agg(F.collect_list(F.struct("key", "value")).alias("_found"))
    )
    empty = F.array().cast(found.schema["_found"].dataType)
    joined = rows.join(found, "_row", "left").withColumn("_found", F.coalesce("_found", empty))
    return _replaced(joined, col, out, _shared(known), default, value_type, "_found").drop("_row", "_found")
