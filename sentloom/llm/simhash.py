"""Near copies by SimHash: fingerprints, pigeonhole blocks, exact Hamming distance, components."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentloom.llm.common import Scratch
from sentloom.llm.components import components

SEED = 42
# Shingles hashed at a time, so that a very long text needs no more memory than this.
CHUNK = 1 << 16
# Fingerprints of one block value that are compared with each other directly.
DIRECT = 8192


def fingerprint(text: bytes, size: int) -> int:
    """SimHash of the ``size``-word shingles of a UTF-8 text, A-Z taken as a-z.

    ``bytes.split`` and ``bytes.lower`` know just the ASCII whitespace and letters.
    """
    words = text.lower().split()
    if not words:
        return 0
    body = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - size + 1)
    starts, ends = starts[:n], ends[min(size, len(words)) - 1:]
    set_bits, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, n, CHUNK):
        spans = zip(starts[at:at + CHUNK].tolist(), ends[at:at + CHUNK].tolist())
        hashes = np.array([digest(body[s:e], SEED) for s, e in spans], ">u8")
        set_bits += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits((2 * set_bits > n).astype(np.uint8))
    return int(bits.view(">i8")[0])


def fingerprint_column(text: Column, size: int = 4) -> Column:
    """The fingerprint of a text column as a signed 64-bit number; NULL text counts as empty."""

    @F.arrow_udf("bigint")
    def fingerprints(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint(t, size) if t else 0 for t in texts.to_pylist()], pa.int64())

    return fingerprints(text.cast("binary"))


def block_masks(bits: int, blocks: int, distance: int) -> list[int]:
    """Masks of all choices of ``blocks - distance`` blocks out of ``blocks``.

    Fingerprints that differ in at most ``distance`` bits differ in at most so many
    blocks, so they agree on all bits of at least one mask.
    """
    edges = [round(i * bits / blocks) for i in range(blocks + 1)]
    parts = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    return [sum(chosen) for chosen in combinations(parts, blocks - distance)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _forest(values: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Edges that connect the same values as all pairs within ``distance`` bits.

    A breadth-first search: every value is compared once with those not yet reached,
    so at most one edge is made for each value, however many pairs are close.
    """
    left, edges = values.view(np.uint64), []
    while len(left) > 1:
        wave, left = left[:1], left[1:]
        while len(wave) and len(left):
            nearest, reached = np.zeros(len(left), bool), []
            for at in wave:
                near = (np.bitwise_count(left ^ at) <= distance) & ~nearest
                if near.any():
                    found = left[near]
                    reached.append(found)
                    edges += [(int(v), int(at)) for v in found]
                    nearest |= near
            left = left[~nearest]
            wave = np.concatenate(reached) if reached else left[:0]
    return edges


def _links(distance: int):
    """Read block values in order and connect the fingerprints of each; ``DIRECT`` bounds one value's rows."""

    def edges_of(starts, ends, fp):
        made = [e for s, t in zip(starts.tolist(), ends.tolist()) for e in _forest(fp[s:t], distance)]
        pairs = np.array(made, np.uint64).reshape(-1, 2).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)]
        for batch in batches:
            held = [np.concatenate((h, batch.column(i).to_numpy())) for i, h in enumerate(held)]
            table, prefix, fp = held
            if not len(fp):
                continue
            starts = np.concatenate(([0], np.flatnonzero((table[1:] != table[:-1]) | (prefix[1:] != prefix[:-1])) + 1))
            done = starts[1:] - starts[:-1] > 1
            if done.any():
                yield edges_of(starts[:-1][done], starts[1:][done], fp)
            held = [h[starts[-1]:].copy() for h in held]  # the last value may go on in the next batch
        if len(held[2]) > 1:
            yield edges_of(np.array([0]), np.array([len(held[2])]), held[2])

    return run


def _crowded_links(fingerprints: DataFrame, distance: int) -> DataFrame:
    """Links of block values with very many fingerprints, without comparing pairs.

    Two values are within ``distance`` bits just if some third value is within half of
    it of both, rounded up on one side. So every fingerprint is written under all its
    neighbours within that radius (2,081 for 4 bits), and is linked to the smallest
    fingerprint under each (minima are combined before the shuffle). For an odd distance
    the smallest is taken among those within the smaller radius, so no edge is longer
    than ``distance``.
    """
    small, large = distance // 2, distance - distance // 2
    flips = [sum(1 << b for b in bits) for r in range(large + 1) for bits in combinations(range(64), r)]
    near = fingerprints.select("fp", F.explode(F.array(*[F.lit(_signed(x)) for x in flips])).alias("flip")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("via"), (F.bit_count("flip") <= small).alias("inner"),
    )
    least = near.where("inner").groupBy("via").agg(F.min("fp").alias("b"))
    return near.join(least, "via").where("fp <> b").select(F.col("fp").alias("a"), "b").distinct()


def near_links(fingerprints: DataFrame, distance: int = 4, blocks: int = 7, direct: int = DIRECT) -> DataFrame:
    """Edges (a, b) that connect all distinct ``fp`` values with at most ``distance`` differing bits.

    Every fingerprint is written once for each choice of blocks (35 for 7 blocks and 4
    bits), keyed by the bits of those blocks, and compared with those of the same key
    only. The edges have the same components as all close pairs, and there are fewer of
    them than block rows. Keys with over ``direct`` fingerprints are linked through
    shared neighbours instead, which is linear in their number.
    """
    masks = block_masks(64, blocks, distance)
    scratch = Scratch(fingerprints.sparkSession)
    fps = fingerprints.select("fp").distinct()
    keys = F.array(*[F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("k"))
                     for i, m in enumerate(masks)])
    rows = fps.select("fp", F.inline(keys)).select(F.col("t").cast("int"), "k", "fp")
    sizes = scratch.write(rows.groupBy("t", "k").count().where(F.col("count") > direct), "crowded")
    crowded = sizes.count()
    if crowded:
        calm = rows.join(sizes, ["t", "k"], "left_anti")
        hot = rows.join(sizes, ["t", "k"], "left_semi").select("fp").distinct()
    else:
        calm = rows
    ordered = calm.repartition("t", "k").sortWithinPartitions("t", "k").select("t", "k", "fp")
    found = ordered.mapInArrow(_links(distance), "a long, b long")
    return found.union(_crowded_links(hot, distance)) if crowded else found


def near_copies(
    docs: DataFrame, shingle: int = 4, distance: int = 4, blocks: int = 7, direct: int = DIRECT,
) -> tuple[DataFrame, DataFrame]:
    """The fingerprint of every document, and the class of every fingerprint.

    The first table has doc_id, th (a hash of the text) and fp of each document, the
    second each distinct fp and its class: the smallest fingerprint linked to it over any
    number of steps. Both are written out; only fingerprints, not the texts, are shuffled.
    """
    scratch = Scratch(docs.sparkSession)
    own = scratch.write(
        docs.select("doc_id", F.xxhash64("text").alias("th"), fingerprint_column(F.col("text"), shingle).alias("fp")),
        "fingerprints",
    )
    labels = components(near_links(own, distance, blocks, direct)).withColumnRenamed("node", "fp")
    best = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")
    each = own.groupBy("fp").agg(F.min(best).alias("best"))
    classes = each.join(labels, "fp", "left").select("fp", "best", F.coalesce("label", "fp").alias("class"))
    return own, scratch.write(classes, "classes")


def simhash_classes(docs: DataFrame, shingle: int = 4, distance: int = 4, blocks: int = 7) -> DataFrame:
    """doc_id, fingerprint (16 lower-case hex digits) and component_id of every document.

    component_id is the smallest doc_id of the documents reachable over links of at most
    ``distance`` differing bits, the document itself included. Texts without a word
    (NULL, empty, blank) have fingerprint zero and are linked like any other. Rows
    with a NULL doc_id are kept; their class has the smallest id among the others, or
    NULL if there is none. Repeated rows stay repeated. An empty table gives no rows;
    columns other than doc_id and text are not read.
    """
    own, classes = near_copies(docs, shingle, distance, blocks)
    smallest = classes.groupBy("class").agg(F.min("best.doc_id").alias("component_id"))
    # By fingerprint, on written tables: copies of one text are a skewed join, which can be split.
    known = Scratch(docs.sparkSession).write(classes.join(smallest, "class").select("fp", "component_id"), "components")
    return own.join(known, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id",
    )


def drop_near_copies(docs: DataFrame, shingle: int = 4, distance: int = 4, blocks: int = 7) -> DataFrame:
    """One document of each class of :func:`near_copies`, with all its columns.

    It is the one with the smallest doc_id (NULL last), then the smallest text hash; of
    rows that agree in both, the smallest over all columns (of their JSON, where a column
    has maps, which have no order). Only identifiers decide; the texts move once, to meet them.
    """
    _, classes = near_copies(docs, shingle, distance, blocks)
    kept = classes.groupBy("class").agg(F.min("best").alias("best")).select(F.col("best.none").alias("_none"), F.coalesce("best.doc_id", F.lit(0)).alias("_id"), F.col("best.th").alias("_th"))
    keys = ["_none", "_id", "_th"]
    keyed = docs.select(
        F.col("doc_id").isNull().alias("_none"), F.coalesce("doc_id", F.lit(0)).alias("_id"),
        F.xxhash64("text").alias("_th"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
    )
    ordered = "map<" not in docs.schema.simpleString()
    one = F.min("_row") if ordered else F.min_by("_row", F.to_json("_row"))
    return keyed.join(kept, keys, "left_semi").groupBy(*keys).agg(one.alias("_row")).select("_row.*")
