"""Ranked lexical search: bit-sliced Bloom signatures bound every document's score, and exact scoring decides.

Each document has a Bloom signature of its terms and of how often they come: an entry
(term, j) says that the term comes ``2 ** j`` times or more. The signatures of some
hundred documents of like size are stored together, turned over: one bitmap over the documents
for each bit of the signature. The bitmaps of a term's bits, put together with AND,
hold every document with that entry, and some without. So a weighted sum of such
bitmaps over the terms of a query is never less than a document's score. Whatever may
still reach the score of the k-th best document known so far is scored exactly.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sentloom.llm.common import Scratch, slices, split_words

# Bits of a signature for each entry, and bits set by one.
BITS, HASHES = 10, 4
# Entries of a term: comes 1, 2, 4, 8 times or more. A document's most frequent term bounds the rest.
LEVELS = 4
# Signature sizes grow by this factor, so few bits are spare.
GROWTH = 1.5
# Queries answered together, and the bytes of their texts.
QUERIES, QUERY_BYTES = 500, 1 << 20
# Documents scored first, for each query, to know what the others have to reach.
SEEDS = 40
# Candidates (query and document) up to which they are sent to the documents.
SENT_CANDIDATES = 200_000
# Bytes of text indexed together.
SLICE = 8 << 20

# A-Z become small, what is no part of a term a space; bytes over 127 belong to letters of other alphabets.
FOLD = np.full(256, 0x20, np.uint8)
FOLD[0x80:] = np.arange(0x80, 0x100)
for low, high in ((0x30, 0x39), (0x61, 0x7A)):
    FOLD[low:high + 1] = np.arange(low, high + 1)
FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)
FOLD_BYTES = FOLD.tobytes()

INDEX = "doc_ids array<long>, n array<long>, most array<long>, bits long, slices binary"


def terms_of(text: str | None) -> list[bytes]:
    """The terms of one text, in order."""
    return (text or "").encode().translate(FOLD_BYTES).split()


def _folded(texts: pa.Array) -> pa.Array:
    """All texts of a batch with only their terms left, between spaces."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return texts
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    flat = FOLD[np.frombuffer(data, np.uint8)[ends[0]:ends[-1]]] if data is not None else np.zeros(0, np.uint8)
    return pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(ends - ends[0]), pa.py_buffer(flat))


def _hashes(terms: list[bytes], seed: int) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(t, seed) for t in terms], np.uint64)


def _places(first: np.ndarray, step: np.ndarray, level: np.ndarray | int, bits: int) -> np.ndarray:
    """The bits of entries (term, level): one row of HASHES for each."""
    at = (np.asarray(level, np.uint64) * np.uint64(HASHES))[..., None] + np.arange(HASHES, dtype=np.uint64)
    with np.errstate(over="ignore"):
        return ((first[..., None] + at * step[..., None]) % np.uint64(bits)).astype(np.int64)


def _signature_bits(entries: np.ndarray) -> np.ndarray:
    """The size of a signature: the next step of a geometric series, in whole bytes."""
    power = np.ceil(np.log(np.maximum(entries, 8) * BITS / 64) / math.log(GROWTH))
    return (np.ceil(8 * GROWTH ** power) * 8).astype(np.int64)


def index_documents(docs: DataFrame) -> DataFrame:
    """Bit-sliced signatures of whole texts, every document in one of the rows: some hundred documents of like size each.

    ``slices`` holds ``bits`` bitmaps, each with one bit per document. Documents without a
    term are left out: they cannot match.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, SLICE):
                flat, counts = split_words(_folded(part.column(1)))
                if not len(flat):
                    continue
                coded = flat.dictionary_encode()
                terms = coded.dictionary.to_pylist()
                first, step = _hashes(terms, 1), _hashes(terms, 2) | np.uint64(1)
                keys = np.repeat(np.arange(len(counts)), counts) * len(terms) + coded.indices.to_numpy()
                keys, tf = np.unique(keys, return_counts=True)
                doc, term = keys // len(terms), keys % len(terms)
                most = np.zeros(len(counts), np.int64)
                np.maximum.at(most, doc, tf)
                held = [np.flatnonzero(tf >= 1 << j) for j in range(LEVELS)]
                level = np.repeat(np.arange(LEVELS), [len(h) for h in held])
                held = np.concatenate(held)
                doc, term = doc[held], term[held]
                size = _signature_bits(np.bincount(doc, minlength=len(counts)))
                ids = part.column(0)
                for bits in np.unique(size[counts > 0]).tolist():
                    rows = np.flatnonzero((size == bits) & (counts > 0))
                    mine = np.flatnonzero(size[doc] == bits)
                    places = _places(first[term[mine]], step[term[mine]], level[mine], bits)
                    table = np.zeros((bits, len(rows)), np.uint8)
                    table[places, np.searchsorted(rows, doc[mine])[:, None]] = 1
                    yield pa.RecordBatch.from_arrays([
                        pa.array([ids.take(pa.array(rows)).to_pylist()], pa.list_(pa.int64())),
                        pa.array([counts[rows]], pa.list_(pa.int64())), pa.array([most[rows]], pa.list_(pa.int64())),
                        pa.array([bits], pa.int64()), pa.array([np.packbits(table, axis=1).tobytes()], pa.binary()),
                    ], ["doc_ids", "n", "most", "bits", "slices"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(build, INDEX)


def corpus_statistics(docs: DataFrame, terms: set[bytes]) -> tuple[int, int, dict[bytes, int]]:
    """Documents with a term, all their terms, and how many documents hold each of ``terms``; over all rows."""
    shared = docs.sparkSession.sparkContext.broadcast(sorted(terms))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = pa.array(shared.value, pa.binary())
        with_terms, total, df = 0, 0, np.zeros(len(wanted), np.int64)
        for batch in batches:
            for part in slices(batch, 0, SLICE):
                flat, counts = split_words(_folded(part.column(0)))
                with_terms, total = with_terms + int((counts > 0).sum()), total + int(counts.sum())
                at = pc.index_in(flat, wanted)
                hit = np.flatnonzero(at.is_valid().to_numpy(zero_copy_only=False))
                keys = np.repeat(np.arange(len(counts)), counts)[hit] * max(1, len(wanted)) + at.take(pa.array(hit)).to_numpy()
                df += np.bincount(np.unique(keys) % max(1, len(wanted)), minlength=len(wanted))
        names, values = [b"N", b"L", *(b"=" + t for t in shared.value)], [with_terms, total, *df.tolist()]
        keep = [i for i, v in enumerate(values) if v]
        yield pa.RecordBatch.from_arrays([pa.array([names[i] for i in keep], pa.binary()), pa.array([values[i] for i in keep], pa.int64())], ["name", "n"])

    sums = docs.select(F.col("text").cast("string")).mapInArrow(count, "name binary, n long").groupBy("name").agg(F.sum("n").alias("n"))
    found = {bytes(r["name"]): r["n"] for r in sums.collect()}
    return found.get(b"N", 0), found.get(b"L", 0), {t: found.get(b"=" + t, 0) for t in terms}


def saturation(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term that comes ``tf`` times counts, in millionths, given the document's length term."""
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


@dataclass
class Queries:
    """Terms and weights of the queries answered together, and the corpus numbers that scores need."""

    ids: list[int]
    terms: list[list[bytes]]
    weight: dict[bytes, int]
    documents: int
    total: int

    def length_term(self, n: np.ndarray) -> np.ndarray:
        return 10 + 90 * n * self.documents // max(1, self.total)

    def score(self, query: int, counts: Counter, m: int) -> int:
        return sum(
            self.weight[t] * (1_000_000_000 * counts[t] // (1000 * counts[t] + 8 * m)) for t in self.terms[query] if t in counts
        )


def upper_bounds(batches: Iterator[pa.RecordBatch], queries: Queries) -> Iterator[tuple[list, np.ndarray]]:
    """For each row of the index: its documents, and a bound on the score of each query (row) in each (column)."""
    terms = sorted(queries.weight)
    at = {t: i for i, t in enumerate(terms)}
    first, step = _hashes(terms, 1), _hashes(terms, 2) | np.uint64(1)
    picks = [np.array([at[t] for t in own], np.int64) for own in queries.terms]
    # Sums of weights stay far below 2 ** 53.
    weights = [np.array([queries.weight[t] for t in own], np.float64) for own in queries.terms]
    for batch in batches:
        for row in range(batch.num_rows):
            ids, n, most, bits, blob = (batch.column(i)[row] for i in range(5))
            n, most, bits = np.array(n.as_py(), np.int64), np.array(most.as_py(), np.int64), bits.as_py()
            table = np.frombuffer(blob.as_buffer(), np.uint8).reshape(bits, -1)
            m = queries.length_term(n)
            bound = np.zeros((len(picks), len(n)), np.int64)
            present, before = None, np.zeros(len(n), np.int64)
            for level in range(LEVELS):
                places = _places(first, step, level, bits)
                maps = table[places[:, 0]]
                for i in range(1, HASHES):
                    maps &= table[places[:, i]]
                # Whoever comes often enough also comes once.
                present = maps if present is None else present & maps
                if not present.any():
                    break
                # A term without the next entry comes so often at most.
                top = most if level == LEVELS - 1 else np.minimum(most, (2 << level) - 1)
                upto = np.maximum(saturation(top, m), before)
                for i, (own, w) in enumerate(zip(picks, weights)):
                    if len(own):
                        held = np.unpackbits(present[own], axis=1, count=len(n))
                        bound[i] += (w @ held).astype(np.int64) * (upto - before)
                before = upto
            yield ids.as_py(), bound


def _order(doc_id: int | None) -> tuple[bool, int]:
    """Equal scores stand in the order of their ids, NULL last."""
    return doc_id is None, doc_id or 0


def _first_look(index: DataFrame, queries: Queries) -> DataFrame:
    """The documents with the highest bounds of each query: (query, doc_id, bound), SEEDS of them."""
    shared = index.sparkSession.sparkContext.broadcast(queries)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps: list[list[tuple]] = [[] for _ in shared.value.ids]
        for ids, bound in upper_bounds(batches, shared.value):
            for heap, row in zip(heaps, bound):
                for i in np.argsort(-row, kind="stable")[:SEEDS].tolist():
                    if row[i] <= 0:
                        break
                    entry = (int(row[i]), -i if ids[i] is None else -ids[i], ids[i] is None, ids[i])
                    if len(heap) < SEEDS:
                        heapq.heappush(heap, entry)
                    elif entry[:3] > heap[0][:3]:
                        heapq.heapreplace(heap, entry)
                    else:
                        break
        rows = [(q, e[3], e[0]) for q, heap in enumerate(heaps) for e in heap]
        yield pa.RecordBatch.from_pydict({
            "query": pa.array([r[0] for r in rows], pa.int32()), "doc_id": pa.array([r[1] for r in rows], pa.int64()),
            "bound": pa.array([r[2] for r in rows], pa.int64()),
        })

    # A task returns SEEDS rows of each query at most.
    some = index.mapInArrow(best, "query int, doc_id long, bound long")
    order = Window.partitionBy("query").orderBy(F.desc("bound"), F.asc_nulls_last("doc_id"))
    return some.withColumn("_nth", F.row_number().over(order)).where(F.col("_nth") <= SEEDS).select("query", "doc_id")


def _reaching(index: DataFrame, queries: Queries, least: list[int]) -> DataFrame:
    """All (query, doc_id) whose bound is at least the query's in ``least``."""
    shared = index.sparkSession.sparkContext.broadcast((queries, np.array(least, np.int64)))

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, least = shared.value
        for ids, bound in upper_bounds(batches, queries):
            q, i = np.nonzero(bound >= least[:, None])
            yield pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), pa.array(ids, pa.int64()).take(pa.array(i))], ["query", "doc_id"])

    return index.mapInArrow(reach, "query int, doc_id long")


def _scored(docs: DataFrame, wanted: DataFrame, queries: Queries, k: int) -> DataFrame:
    """Exact scores over 0 of the wanted (query, doc_id), the k best of each query in a task: (query, doc_id, score)."""
    shared = docs.sparkSession.sparkContext.broadcast(queries)
    # Rows of one id are one entry here; every row with the id is scored.
    lists = wanted.groupBy(F.struct("doc_id").alias("_key")).agg(F.collect_set("query").alias("_queries"))
    if wanted.count() <= SENT_CANDIDATES:
        lists = F.broadcast(lists)
    rows = docs.select(F.struct(F.col("doc_id").cast("long").alias("doc_id")).alias("_key"), F.col("text").cast("string").alias("text"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = shared.value
        heaps: list[list[tuple]] = [[] for _ in queries.ids]
        for batch in batches:
            for row in range(batch.num_rows):
                doc_id, text, own = (batch.column(i)[row].as_py() for i in range(3))
                terms = terms_of(text)
                counts, m = Counter(terms), int(queries.length_term(np.int64(len(terms))))
                for q in own:
                    value = queries.score(q, counts, m)
                    if value > 0:
                        missing, number = _order(doc_id)
                        entry = (value, not missing, -number, row, doc_id)
                        if len(heaps[q]) < k:
                            heapq.heappush(heaps[q], entry)
                        elif entry[:3] > heaps[q][0][:3]:
                            heapq.heapreplace(heaps[q], entry)
        found = [(q, e[4], e[0]) for q, heap in enumerate(heaps) for e in heap]
        yield pa.RecordBatch.from_arrays([
            pa.array([f[0] for f in found], pa.int32()), pa.array([f[1] for f in found], pa.int64()), pa.array([f[2] for f in found], pa.int64()),
        ], ["query", "doc_id", "score"])

    joined = rows.join(lists, "_key").select("_key.doc_id", "text", "_queries")
    return joined.mapInArrow(score, "query int, doc_id long, score long")


def _top(scored: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _blocks(items: DataFrame) -> Iterator[list[tuple[int, str | None]]]:
    """The queries, a bounded number and bounded bytes at a time."""
    block, size = [], 0
    for row in items.select(F.col("item_id").cast("long"), F.col("text").cast("string")).toLocalIterator():
        own = len(row[1] or "")
        if block and (len(block) >= QUERIES or size + own > QUERY_BYTES):
            yield block
            block, size = [], 0
        block.append((row[0], row[1]))
        size += own
    if block:
        yield block


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` best documents of each item: item_id, rank, doc_id, score.

    All documents are ranked; the result is that of scoring every one of them. Queries are
    answered in blocks of bounded size against the written index. A first look takes, for
    each query, the documents with the highest bounds and scores them; the k-th best of
    those scores is what a document has to reach, and all that may reach it are scored.

    NULL and empty texts have no terms: such a document is never found, such an item finds
    nothing. Equal scores stand in the order of doc_id, NULL last; repeated rows of
    ``docs`` are found each, repeated items answered each. Empty tables give no rows. Only
    doc_id (or item_id) and text are read, whatever else the columns are called.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    index = scratch.write(index_documents(docs), "signatures")
    results = []
    for block in _blocks(items):
        distinct = [sorted(set(terms_of(text))) for _, text in block]
        documents, total, df = corpus_statistics(docs, {t for own in distinct for t in own})
        weight = {t: math.floor(1000 * math.log((2 * documents + 2) / (2 * n + 1))) for t, n in df.items() if n}
        queries = Queries([i for i, _ in block], [[t for t in own if t in weight] for own in distinct], weight, documents, total)
        seeds = scratch.write(_first_look(index, queries), "seeds")
        known: dict[int, list[int]] = {}
        for row in _top(_scored(docs, seeds, queries, k), k).select("query", "score").collect():
            known.setdefault(row["query"], []).append(row["score"])
        # With fewer than k, any document with a score over 0 is among the best.
        least = [min(known[q]) if len(known.get(q, [])) >= k else 1 for q in range(len(block))]
        candidates = scratch.write(_reaching(index, queries, least), "candidates")
        best = _top(_scored(docs, candidates, queries, k), k)
        names = spark.createDataFrame(list(enumerate(queries.ids)), "query int, item_id long")
        results.append(scratch.write(best.join(F.broadcast(names), "query").select("item_id", "rank", "doc_id", "score"), "found"))
        scratch.drop(seeds)
        scratch.drop(candidates)
    scratch.drop(index)
    if not results:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out
