"""Benchmark items inside documents: size-partitioned MinHash sketches, then exact containment."""

from __future__ import annotations

import math
import pickle
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentloom.llm.common import slices, split_words

# Shingle hashes kept above the number that a contained item may lack.
SPARE = 4
# Items searched for in one pass over the documents, and bytes of their texts at most.
BLOCK_ITEMS, BLOCK_BYTES = 50_000, 32 << 20
MIX = np.uint64(0x9E3779B97F4A7C15)


def item_words(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def _window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of each run of ``size`` words from the hashes of the words."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(size):
        out = (out ^ words[j:j + n]) * MIX
        out ^= out >> np.uint64(29)
    return out


def _hash_words(words) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(w, 42) for w in words), np.uint64, len(words))


@dataclass
class Partition:
    """Items with the same shingle length and about the same number of shingles."""

    size: int
    sketch: dict[int, list[int]] = field(default_factory=lambda: defaultdict(list))
    hits: dict[int, int] = field(default_factory=dict)
    keys: np.ndarray | None = None


class Items:
    """Sketches of a block of items, in partitions by size.

    An item's sketch is its smallest shingle hashes (bottom-k MinHash). A document that
    contains the share ``threshold`` of an item's n shingles lacks at most
    floor((1 - threshold) * n) of them, so it has all but so many of the sketch. k is
    that number, taken at the partition's largest n, plus ``SPARE``: a candidate has at
    least one sketch hash and no contained item is missed.
    """

    def __init__(self, items: list[tuple[int, str | None]], shingle: int, threshold: float):
        self.threshold, self.shingles, self.hashes, parts = threshold, {}, {}, {}
        self.ids = [i for i, _ in items]
        for at, (_, text) in enumerate(items):
            words = item_words(text)
            if not words:
                continue
            size = min(shingle, len(words))
            own = {b" ".join(words[i:i + size]) for i in range(len(words) - size + 1)}
            self.shingles[at] = (size, own)
            hashes = self.hashes[at] = np.unique(_window_hashes(_hash_words(words), size))
            top = 1 << (len(own) - 1).bit_length()
            part = parts.setdefault((size, top), Partition(size))
            kept = hashes[: self._lack(top) + SPARE]
            part.hits[at] = max(1, len(kept) - self._lack(len(own)))
            for h in kept.tolist():
                part.sketch[h].append(at)
        self.parts = list(parts.values())
        for part in self.parts:
            part.keys = np.array(sorted(part.sketch), np.uint64)
        self.sizes = sorted({p.size for p in self.parts})

    def _lack(self, n: int) -> int:
        return math.floor((1 - self.threshold) * n + 1e-9)

    def candidates(self, hashes: dict[int, np.ndarray]) -> list[int]:
        """Items whose sketch is hit often enough by a document's distinct window hashes."""
        out = []
        for part in self.parts:
            count: dict[int, int] = defaultdict(int)
            for h in hashes[part.size].tolist():
                for at in part.sketch.get(h, ()):
                    count[at] += 1
            out += [at for at, n in count.items() if n >= part.hits[at]]
        return out

    def verified(self, candidates: list[int], words: pa.Array, hashes: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(item, its shingles, how many of them the document has); no hash is trusted.

        The document's windows are gone through once for each shingle length: those whose
        hash is one of a candidate's are put together and compared as they are.
        """
        by_size: dict[int, list[int]] = defaultdict(list)
        for at in candidates:
            by_size[self.shingles[at][0]].append(at)
        for size, items in by_size.items():
            wanted = np.unique(np.concatenate([self.hashes[at] for at in items]))
            places = np.flatnonzero(np.isin(_window_hashes(hashes, size), wanted))
            texts = {b" ".join(words[i:i + size].to_pylist()).lower() for i in places.tolist()}
            for at in items:
                own = self.shingles[at][1]
                yield at, len(own), len(own & texts)

    def contained(self, texts: pa.Array) -> Iterator[tuple[int, int, int, int]]:
        """(row, item, shingles of the item, shingles found) of all items that the texts contain."""
        flat, counts = split_words(texts)
        if not len(flat) or not self.parts:
            return
        coded = flat.dictionary_encode()
        hashes = _hash_words([w.lower() for w in coded.dictionary.to_pylist()])[coded.indices.to_numpy(zero_copy_only=False)]
        ends = np.cumsum(counts)
        found: dict[int, dict[int, np.ndarray]] = defaultdict(lambda: {s: np.empty(0, np.uint64) for s in self.sizes})
        for size in self.sizes:
            windows = _window_hashes(hashes, size)
            keys = np.unique(np.concatenate([p.keys for p in self.parts if p.size == size]))
            at = np.searchsorted(keys, windows)
            hit = np.flatnonzero(keys[np.minimum(at, len(keys) - 1)] == windows)
            rows = np.searchsorted(ends, hit, side="right")
            inside = hit + size <= ends[rows]  # windows that run into the next text don't count
            hit, rows = hit[inside], rows[inside]
            for row in np.unique(rows).tolist():
                found[row][size] = np.unique(windows[hit[rows == row]])
        for row in sorted(found):
            candidates = self.candidates(found[row])
            if candidates:
                start, n = int(ends[row] - counts[row]), int(counts[row])
                for at, n_own, have in self.verified(candidates, flat.slice(start, n), hashes[start:start + n]):
                    if have >= self.threshold * n_own:
                        yield row, at, n_own, have


def item_blocks(items: DataFrame, shingle: int, threshold: float) -> Iterator[Items]:
    """The items, in blocks of bounded size; each is searched for in all documents."""
    block, size = [], 0
    for row in items.select("item_id", "text").toLocalIterator():
        block.append((row["item_id"], row["text"]))
        size += len(row["text"] or "")
        if len(block) >= BLOCK_ITEMS or size >= BLOCK_BYTES:
            yield Items(block, shingle, threshold)
            block, size = [], 0
    if block:
        yield Items(block, shingle, threshold)


def find_items(docs: DataFrame, items: DataFrame, shingle: int = 5, threshold: float = 0.8) -> DataFrame:
    """doc_id, item_id, item_shingles, found_shingles, containment of all items inside documents.

    A shingle is ``shingle`` words (A-Z taken as a-z, any ASCII whitespace between them);
    an item with fewer words is one shingle, looked for at its own length. A pair is
    returned if the document has at least ``threshold`` of the item's distinct shingles.
    Items without a word are in no document, NULL texts have no words. Repeated
    documents or items give a row each, NULL ids are returned as they are, and an empty
    table on either side gives no rows.

    The documents are read once for each block of items (``BLOCK_ITEMS``) and never shuffled.
    """
    out = None
    sc = docs.sparkSession.sparkContext
    for block in item_blocks(items, shingle, threshold):
        shared = sc.broadcast(cloudpickle.dumps(block))

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            known = pickle.loads(shared.value)
            for batch in batches:
                for part in slices(batch, 1):
                    hits = list(known.contained(part.column(1)))
                    if hits:
                        ids = part.column(0).take(pa.array([h[0] for h in hits]))
                        yield pa.RecordBatch.from_arrays([
                            ids, pa.array([known.ids[h[1]] for h in hits], pa.int64()),
                            pa.array([h[2] for h in hits], pa.int64()), pa.array([h[3] for h in hits], pa.int64()),
                        ], ["doc_id", "item_id", "item_shingles", "found_shingles"])

        rows = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
            search, "doc_id long, item_id long, item_shingles long, found_shingles long"
        )
        out = rows if out is None else out.unionAll(rows)
    if out is None:
        out = docs.sparkSession.createDataFrame([], "doc_id long, item_id long, item_shingles long, found_shingles long")
    return out.withColumn("containment", F.col("found_shingles") / F.col("item_shingles"))


def contains_item(text: Column, block: Items, spark) -> Column:
    """Whether a text contains any item of the block."""
    shared = spark.sparkContext.broadcast(cloudpickle.dumps(block))

    @F.arrow_udf("boolean")
    def contaminated(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = pickle.loads(shared.value)
        for texts in batches:
            flags, start = np.zeros(len(texts), bool), 0
            for part in slices(pa.RecordBatch.from_arrays([texts], ["t"]), 0):
                for row, *_ in known.contained(part.column(0)):
                    flags[start + row] = True
                start += len(part)
            yield pa.array(flags)

    return contaminated(text)


def drop_contaminated(docs: DataFrame, items: DataFrame, shingle: int = 5, threshold: float = 0.8) -> DataFrame:
    """The documents that contain no item (see :func:`find_items`), with all their columns."""
    for block in item_blocks(items, shingle, threshold):
        docs = docs.where(~contains_item(F.col("text"), block, docs.sparkSession))
    return docs
