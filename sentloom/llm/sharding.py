"""Shards by a weighted hash tree: region, rack and shard draws, and gapless slots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Places of the tree: regions, racks of a region, shards of a rack.
TREE = (4, 4, 4)
# Parts of a shard that are numbered side by side.
BLOCKS = 1024


def _unit(h: Column) -> Column:
    """A hash as a number above 0 and below 1."""
    return (F.shiftrightunsigned(h, 12).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def weighted_shard(key: Column, weights: Sequence[float], tree: tuple[int, int, int] = TREE) -> Column:
    """The shard of a key, from 0 to ``len(weights) - 1``; weights are from 0 to 1 and not all 0.

    Shard i sits at region i mod R, rack (i / R) mod K and the next place there. A key has
    an exponential clock at each shard, by a hash of the key and the path, whose rate is the
    shard's weight; the clock of a rack or region is the least one below it, so its rate is
    the sum of the weights there. The key descends to the region, the rack and the
    shard with the least clock: a draw by weight at each level. Raising one weight (or
    adding a shard, which raises it from 0) makes the clocks of its own path earlier and no
    others: keys move into that subtree, and there into that shard. Lowering it moves only
    its own keys.
    """
    regions, racks, places = tree
    if len(weights) > regions * racks * places:
        raise ValueError(f"{len(weights)} shards need a larger tree than {tree}")
    if not any(weights) or min(weights) < 0 or max(weights) > 1:
        raise ValueError("weights are from 0 to 1 and not all 0")
    below: dict[int, dict[int, list[Column]]] = {}
    for i, weight in enumerate(weights):
        if weight > 0:
            region, rack, place = i % regions, i // regions % racks, i // (regions * racks)
            clock = -F.ln(_unit(F.xxhash64(key, F.lit("clock"), F.lit(region), F.lit(rack), F.lit(place)))) / F.lit(float(weight))
            below.setdefault(region, {}).setdefault(rack, []).append(F.struct(clock.alias("t"), F.lit(i).alias("i")))

    def first(nodes: list[Column]) -> Column:
        return F.array_min(F.array(*nodes))

    return first([first([first(shards) for shards in in_region.values()]) for in_region in below.values()])["i"]


def with_slots(rows: DataFrame, shard: str, order: list[str], out: str, blocks: int = BLOCKS) -> DataFrame:
    """Number the rows of each shard from 0 without a gap, whatever the shard's size.

    Rows are spread over ``blocks`` parts of their shard by a hash of the ``order``
    columns, numbered inside their part, and moved up by the sizes of the parts before.
    Only counts of parts meet in one place: at most ``blocks`` for a shard. Rows that
    agree in all ``order`` columns may swap their numbers.
    """
    part = f"_{out}_part"
    spread = rows.withColumn(part, F.pmod(F.xxhash64(*order), F.lit(blocks)).cast("int"))
    sizes = spread.groupBy(shard, part).agg(F.count("*").alias("_n"))
    before = Window.partitionBy(shard).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(shard, part, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy(shard, part).orderBy(*order))
    # One row for each part of a shard: shards are a number the caller gives, parts are ``blocks``.
    return (
        spread.withColumn("_inside", inside).join(F.broadcast(offsets), [shard, part])
        .withColumn(out, F.col("_before") + F.col("_inside") - 1).drop(part, "_before", "_inside")
    )


def shard_documents(docs: DataFrame, shards: int = 24, weights: Sequence[float] | None = None, keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with size, text_crc32, law, shard, slot and grown_shard.

    The law is ``key``: doc_id and the weights of the shards (equal by default) decide,
    and ``grown_shard`` is the shard with one more of weight 1. A NULL id is one key. A
    NULL text has size 8 and no crc32. Equal texts go where their ids go. Repeated rows
    get a slot each. Columns that have one of these names, in any case, are replaced, but doc_id
    and text. An empty table gives no rows.
    """
    weights = list(weights or [1.0] * shards)
    added = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in added]
    blob, key = F.col("text").cast("binary"), F.col("doc_id")
    # The row goes along as one column, so its names meet no others.
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_row"), key.alias("_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(blob).alias("text_crc32"), F.lit("key").alias("law"),
        weighted_shard(key, weights).alias("shard"), weighted_shard(key, [*weights, 1.0]).alias("grown_shard"),
    )
    return with_slots(rows, "shard", ["_id", "text_crc32", "size"], "slot").select(
        *[F.col("_row").getField(c).alias(c) for c in kept], "size", "text_crc32", "law", "shard", F.col("slot").cast("long"), "grown_shard",
    )
