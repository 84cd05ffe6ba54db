"""Byte-pair vocabularies: learning them with Spark jobs and applying them.

The distinct words stay in the partitions, as blocks of symbol numbers. Learning goes
on in phases. A phase looks at the leading pairs, all of them with a count of at least
some least one. Whatever is merged while the highest count stays there is made of
neighbours in one of these pairs: each place where two symbols are merged was a place
between two neighbours when the phase began, and as a symbol is made in one way only
in a phase, all places of a pair had the same two neighbours, so these had no lower
count. So the runs of symbols that are neighbours in leading pairs, with how often
each run occurs, tell every merge of the phase. The driver gets the distinct runs, a
bounded number of symbols, and merges one pair at a time in them; the tasks then replay
the merges in their words.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator, Sequence
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sentloom.functions import text as tx
from sentloom.operators import pair_merging
from sentloom.sources.staging import delete_path, stage, staging_path

# Control symbols of a subword vocabulary, in id order.
CONTROL_SYMBOLS = ["<unk>", "<s>", "</s>"]
DEFAULT_VOCAB_SIZE = 10_000
# Stands for characters that the vocabulary leaves out.
LEFT_OUT = "\ufffd"
# Leading pairs of a phase, at first and at most.
LEADING, MOST_LEADING = 64, 20_000
# Symbols of distinct runs that the driver takes in a phase (about 60 bytes of its memory each).
RUN_SYMBOLS = 1_500_000
# Symbols of a block of words.
BLOCK_SYMBOLS = 1_000_000
# Words whose pieces a Python worker remembers.
CACHE_WORDS = 100_000
# Words of lines that are put together at a time, if a line has not more.
PART_WORDS = 100_000
# Texts that an outside encoder is given at a time.
TEXTS = 2_000


def marked_words(c: Column | str) -> Column:
    """Whitespace-separated words, each with the word mark in front."""
    return F.transform(tx.words(c), lambda w: F.concat(F.lit(tx.WORD_MARK), w))


def _numbers(symbols: list[str]) -> np.ndarray:
    """The symbol of each code point, 0 for none."""
    numbers = np.zeros(0x110000, np.int32)
    for i, symbol in enumerate(symbols):
        if i:
            numbers[ord(symbol)] = i
    return numbers


def _blocks(words: DataFrame, symbols: list[str], other: int) -> DataFrame:
    """Words (w, n) as blocks of many: their symbols with a 0 before and after each, and their counts."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = _numbers(symbols)
        parts, weights, size = [], [], 0

        def block() -> pa.RecordBatch:
            sym = np.concatenate([*parts, np.zeros(1, np.int32)])
            return _block(sym, np.concatenate(weights))

        for batch in batches:
            for at in range(0, batch.num_rows, 50_000):
                own = batch.slice(at, 50_000)
                lengths = pc.utf8_length(own.column(0)).to_numpy().astype(np.int64)
                codes = np.frombuffer("".join(own.column(0).to_pylist()).encode("utf-32-le"), np.uint32)
                sym = np.zeros(len(codes) + len(lengths), np.int32)
                known = numbers[codes]
                sym[np.arange(len(codes)) + np.repeat(np.arange(1, len(lengths) + 1), lengths)] = np.where(known == 0, other, known)
                parts.append(sym)
                weights.append(own.column(1).to_numpy())
                size += len(sym)
                if size >= BLOCK_SYMBOLS:
                    yield block()
                    parts, weights, size = [], [], 0
        if parts:
            yield block()

    return words.mapInArrow(build, "sym binary, n binary")


def _block(sym: np.ndarray, weights: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([sym.astype("<i4").tobytes()], pa.binary()), pa.array([weights.astype("<i8").tobytes()], pa.binary())], ["sym", "n"]
    )


def _arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for batch in batches:
        for row in range(batch.num_rows):
            yield np.frombuffer(batch.column(0)[row].as_buffer(), "<i4"), np.frombuffer(batch.column(1)[row].as_buffer(), "<i8")


def _pair_counts(blocks: DataFrame, symbols: list[str], max_piece: int | None) -> DataFrame:
    """How often each pair that may be merged occurs: (pair, n), the numbers of both symbols in one."""
    lengths = np.array([len(s) for s in symbols])
    barred = np.array([s == LEFT_OUT for s in symbols])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for sym, weights in _arrays(batches):
            keys = pair_merging.pair_keys(sym, np.arange(1, len(sym)))
            keys, n = pair_merging.summed(keys, weights[np.cumsum(sym[1:] == 0) - (sym[1:] == 0)])
            a, b = keys >> 32, keys & 0xFFFFFFFF
            keep = ~(barred[a] | barred[b])
            if max_piece is not None:
                keep &= lengths[a] + lengths[b] <= max_piece
            yield pa.RecordBatch.from_arrays([pa.array(keys[keep]), pa.array(n[keep])], ["pair", "n"])

    return blocks.mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def _runs(blocks: DataFrame, pairs: np.ndarray) -> DataFrame:
    """Distinct runs of symbols that are neighbours in one of ``pairs``, and how often they occur: (run, n)."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for sym, weights in _arrays(batches):
            for rows, n in pair_merging.runs_of(sym, weights, pairs):
                offsets = np.arange(len(rows) + 1, dtype=np.int32) * (4 * rows.shape[1])
                column = pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(rows.astype("<i4").tobytes())])
                yield pa.RecordBatch.from_arrays([column, pa.array(n)], ["run", "n"])

    return blocks.mapInArrow(find, "run binary, n long").groupBy("run").agg(F.sum("n").alias("n"))


def _replayed(blocks: DataFrame, merges: list[tuple[int, int, int]]) -> DataFrame:
    def replay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for sym, weights in _arrays(batches):
            yield _block(pair_merging.replay(sym, merges), weights)

    return blocks.mapInArrow(replay, "sym binary, n binary")


class _Written:
    """Tables of the phases: each is written once, and goes when the next one is there."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def write(self, df: DataFrame, label: str) -> DataFrame:
        path = staging_path(self.spark, label)
        df.write.parquet(path)
        self.drop(label)
        self.paths[label] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, label: str) -> None:
        if label in self.paths:
            delete_path(self.spark, self.paths.pop(label))


def _leading(keys: np.ndarray, n: np.ndarray, wanted: int) -> tuple[np.ndarray, int]:
    """All pairs with the count of the ``wanted``-th one or more, and that count.

    ``keys`` are the first ``MOST_LEADING + 1`` pairs by count. If they end among equal
    counts, these are left out; no pair is left if all are equal.
    """
    least = int(n[min(wanted, len(n)) - 1])
    if len(n) > MOST_LEADING and n[-1] == least:
        higher = n[n > least]
        least = int(higher.min()) if len(higher) else least + 1
    return np.sort(keys[n >= least]), least


def learn_bpe(
    df: DataFrame,
    vocab_size: int = DEFAULT_VOCAB_SIZE,
    col: str = "text",
    coverage: float = 1.0,
    max_piece: int | None = None,
) -> tuple[list[tuple[str, str]], DataFrame]:
    """Learn byte-pair merges from a text column: (merges in order, vocabulary).

    The pair with the highest count is merged next; ties go to the shorter, then to
    the smaller merged symbol. The corpus is counted to its distinct words, which stay in
    the partitions; the result is that of merging one pair at a time. Only the leading
    pairs, at most ``RUN_SYMBOLS`` symbols of distinct runs and the characters come to the
    driver, whatever the number of words. A phase takes as many leading pairs as fit. The
    tables of a phase are written to the staging folder, and dropped when the next is there.

    The vocabulary (piece, piece_id) lists control symbols, merged pieces in order,
    then characters by count. ``vocab_size`` must leave room for all characters. With a
    ``coverage`` below 1 the rarest characters beyond that share of the text are left out:
    no piece has them and no pair goes over them. ``max_piece`` bounds the length of merged
    pieces, the word mark included.
    """
    spark = df.sparkSession
    written = _Written(spark)
    # Each distinct word gets its mark once.
    counts = df.select(F.explode(tx.words(col)).alias("w")).groupBy("w").agg(F.count(F.lit(1)).cast("long").alias("n"))
    words = written.write(counts.select(F.concat(F.lit(tx.WORD_MARK), "w").alias("w"), "n"), "words")
    # Code points in use: at most 1.1 million exist.
    found = words.select(F.explode(tx.chars(F.col("w"))).alias("c"), "n").groupBy("c").agg(F.sum("n").alias("n"))
    by_count = [(r["c"], r["n"]) for r in found.orderBy(F.desc("n"), F.asc("c")).collect()]
    chars = _covered(by_count, coverage)
    wanted = vocab_size - len(CONTROL_SYMBOLS) - len(chars)
    if wanted < 0:
        raise ValueError(f"a vocabulary of {vocab_size} has no room for {len(chars)} characters and the control symbols")
    symbols = ["", *chars]
    if LEFT_OUT not in symbols:
        symbols.append(LEFT_OUT)
    numbers = {s: i for i, s in enumerate(symbols)}
    # All other characters are one mark; pairs with it are never merged.
    blocks = written.write(_blocks(words, list(symbols), numbers[LEFT_OUT]), "blocks")
    written.drop("words")

    def name(pair: tuple[int, int]) -> tuple | None:
        a, b = symbols[pair[0]], symbols[pair[1]]
        if LEFT_OUT in (a, b) or (max_piece is not None and len(a) + len(b) > max_piece):
            return None
        return len(a) + len(b), a + b, len(a)

    def number(pair: tuple[int, int]) -> tuple[int, bool]:
        made = symbols[pair[0]] + symbols[pair[1]]
        fresh = made not in numbers
        if fresh:
            numbers[made] = len(symbols)
            symbols.append(made)
        return numbers[made], fresh

    merges: list[tuple[str, str]] = []
    several = LEADING
    while len(merges) < wanted:
        counts = _pair_counts(blocks, list(symbols), max_piece)
        top = counts.orderBy(F.desc("n")).limit(MOST_LEADING + 1).toArrow()
        if not len(top):
            break
        keys, n = (top[c].to_numpy() for c in ("pair", "n"))
        several = min(several, MOST_LEADING, 2 * (wanted - len(merges)) + 16)
        while True:
            pairs, least = _leading(keys, n, several)
            runs = written.write(_runs(blocks, pairs), "runs")
            size = (runs.agg(F.sum(F.octet_length("run"))).first()[0] or 0) // 4
            if size <= RUN_SYMBOLS:
                break
            if several == 1:  # the runs of the most frequent pairs alone are too many
                pairs = pairs[:0]
                break
            several = max(1, min(several, len(pairs)) // 4)
        if len(pairs):
            learned = _learn_runs(runs.toArrow(), wanted - len(merges), least, name, number)
        else:
            # Too much of one count to look at: of these pairs, those that do not touch each other are merged.
            learned = [(a, b, number((a, b))[0]) for a, b in _first_of_equals(counts, symbols, int(n[0]), set(numbers))[:wanted - len(merges)]]
        merges += [(symbols[a], symbols[b]) for a, b, _ in learned]
        if size < RUN_SYMBOLS // 3:
            several *= 2 if size > RUN_SYMBOLS // 12 else 4
        if len(merges) < wanted:
            blocks = written.write(_replayed(blocks, learned), "blocks")
    for label in ("runs", "blocks"):
        written.drop(label)
    return merges, _vocabulary(spark, merges, chars)


def _learn_runs(
    runs: pa.Table, wanted: int, least: int, name: Callable[[tuple[int, int]], tuple | None], number: Callable[[tuple[int, int]], tuple[int, bool]],
) -> list[tuple[int, int, int]]:
    """The merges that the distinct runs (run, n) tell, down to a count of ``least``."""
    lengths = pc.binary_length(runs["run"]).to_numpy().astype(np.int64) // 4
    flat = np.frombuffer(b"".join(runs["run"].to_pylist()), "<i4")
    sym = np.zeros(len(flat) + len(lengths) + 1, np.int32)
    sym[np.arange(len(flat)) + np.repeat(np.arange(1, len(lengths) + 1), lengths)] = flat
    return pair_merging.learn(sym, runs["n"].to_numpy(), wanted, least, name, number)


def _first_of_equals(counts: DataFrame, symbols: list[str], n: int, known: set[str]) -> list[tuple[int, int]]:
    """The first pairs with the count ``n`` that can be merged at once with the result of one at a time."""
    # One row for each symbol: the size of the vocabulary bounds them.
    names = F.broadcast(counts.sparkSession.createDataFrame(list(enumerate(symbols)), "id int, s string"))
    a, b = names.select(F.col("id").alias("ia"), F.col("s").alias("a")), names.select(F.col("id").alias("ib"), F.col("s").alias("b"))
    equal = counts.where(F.col("n") == n).select(
        F.shiftright("pair", 32).cast("int").alias("ia"), F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("ib")
    ).join(F.broadcast(a), "ia").join(F.broadcast(b), "ib")
    merged = F.concat("a", "b")
    rows = equal.orderBy(F.length(merged), merged, F.length("a")).limit(MOST_LEADING).collect()
    number = {(r["a"], r["b"]): (r["ia"], r["ib"]) for r in rows}
    return [number[p] for p in independent_prefix(list(number), known)]


def independent_prefix(ranked: list[tuple[str, str]], known: set[str]) -> list[tuple[str, str]]:
    """The leading pairs that can be merged at once with the result of one at a time.

    Two pairs overlap in a word only if one ends with the symbol the other starts
    with, so merging one leaves the count of the other unchanged when that is not so.
    A pair that a merge creates, say (ab, y), occurs at most as often as (b, y) did
    before; (b, y) starts with the end of (a, b), so it is not among the leading
    pairs taken here, and ranks below them (a longer symbol loses a tie). Only when a
    merge makes a symbol that exists already can counts add up: that ends the list.
    """
    taken: list[tuple[str, str]] = []
    firsts: set[str] = set()
    lasts: set[str] = set()
    made: set[str] = set()
    for a, b in ranked:
        if a in lasts or b in firsts:
            break
        taken.append((a, b))
        if a + b in known or a + b in made or a == b:
            break
        firsts.add(a)
        lasts.add(b)
        made.add(a + b)
    return taken


def _covered(by_count: list[tuple[str, int]], coverage: float) -> list[str]:
    """The most frequent characters that make up the share ``coverage`` of the text."""
    if coverage >= 1:
        return [c for c, _ in by_count]
    goal, total, kept = coverage * sum(n for _, n in by_count), 0, []
    for c, n in by_count:
        if total >= goal:
            break
        kept.append(c)
        total += n
    return kept


def _vocabulary(spark: SparkSession, merges: list[tuple[str, str]], chars: list[str]) -> DataFrame:
    pieces = list(dict.fromkeys([*CONTROL_SYMBOLS, *[a + b for a, b in merges], *chars]))
    return spark.createDataFrame(list(zip(pieces, range(len(pieces)))), "piece string, piece_id bigint")


def segment(word: str, ranks: dict[tuple[str, str], int]) -> list[str]:
    """Pieces of one word: merge the earliest learned pair first, left to right.

    Symbols are linked to their neighbours and a heap holds the pairs that may be merged
    next, so a word of n characters takes n log n steps. A pair of the same rank further
    right comes later; one that a merge made takes its turn by rank.
    """
    syms: list[str | None] = list(word)
    heap = [(ranks[p], i) for i, p in enumerate(pairwise(syms)) if p in ranks]
    if not heap:
        return list(word)
    heapq.heapify(heap)
    after, before = list(range(1, len(syms) + 1)), list(range(-1, len(syms) - 1))
    end = len(syms)
    while heap:
        # All of the lowest rank, from the left, before anything they make: as one pass over the word does.
        rank, turn, made = heap[0][0], [], []
        while heap and heap[0][0] == rank:
            turn.append(heapq.heappop(heap)[1])
        for i in turn:
            j = after[i]
            if syms[i] is None or j == end or ranks.get((syms[i], syms[j])) != rank:
                continue
            syms[i] += syms[j]
            syms[j] = None
            after[i] = after[j]
            if after[i] < end:
                before[after[i]] = i
            made.append(i)
        for i in made:
            for left in (before[i], i):
                if left >= 0 and after[left] < end:
                    found = ranks.get((syms[left], syms[after[left]]))
                    if found is not None:
                        heapq.heappush(heap, (found, left))
    return [s for s in syms if s is not None]


def encode_words(load: Callable[[], Callable[[str], list[str]]], names: Sequence[str] = ()):
    """A function of an array of words to the pieces of all of them.

    ``load`` returns the function from a word to its pieces and runs once per task. Lines
    are cut into their distinct words, some lines at a time; each word is segmented once (and
    remembered by the task), and the arrays are put together from those. With ``names`` it is a
    function of as many arrays, to a struct: the columns share a worker and what it remembers.
    """

    def encoder() -> Callable[[pa.Array], pa.Array]:
        # Words share the strings of their pieces.
        cut, cache, shared = load(), {}, {}

        def encoded(lines: pa.Array) -> pa.Array:
            distinct = lines.flatten().dictionary_encode()
            own = distinct.dictionary.to_pylist()
            if len(cache) > CACHE_WORDS:
                # What is in use stays, so frequent words are cut once.
                kept = {w: cache[w] for w in own if w in cache}
                cache.clear()
                shared.clear()
                cache.update((w, tuple(shared.setdefault(p, p) for p in pieces)) for w, pieces in kept.items())
            cache.update((w, tuple(shared.setdefault(p, p) for p in cut(w))) for w in own if w not in cache)
            pieces = pa.array([cache[w] for w in own], pa.list_(pa.string())).take(distinct.indices)
            # Where each word's pieces start, then where each line's do.
            starts = np.concatenate(([0], np.cumsum(pieces.value_lengths().to_numpy(zero_copy_only=False))))
            words = np.concatenate(([0], np.cumsum(lines.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))))
            offsets = pa.array(starts[words].astype(np.int32))
            return pa.ListArray.from_arrays(offsets, pieces.flatten(), mask=lines.is_null())

        return lambda lines: pa.concat_arrays([encoded(part) for part in line_parts(lines, PART_WORDS)])

    @F.arrow_udf("array<string>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        whole = encoder()
        for lines in batches:
            yield whole(lines)

    @F.arrow_udf(", ".join(f"`{n}` array<string>" for n in names) or "array<string>")
    def encode_all(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        whole = encoder()
        for columns in batches:
            yield pa.StructArray.from_arrays([whole(lines) for lines in columns], list(names))

    return encode_all if names else encode


def line_parts(lines: pa.Array, most: int) -> Iterator[pa.Array]:
    """An array of lists in slices of at most ``most`` elements, a longer list alone; an empty array is one slice."""
    ends = np.cumsum(lines.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    at = 0
    while True:
        before = int(ends[at - 1]) if at else 0
        end = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
        yield lines.slice(at, end - at)
        at = end
        if at >= len(lines):
            return


def apply_bpe(
    df: DataFrame, merges: list[tuple[str, str]], col: str | Sequence[str] = "text", out: str | Sequence[str] = "pieces"
) -> DataFrame:
    """Encode text to pieces with learned merges (an array column, or one for each of several).

    Rows are not shuffled: the merge list is bounded by the vocabulary size and goes
    to the executors.
    """
    ranks = df.sparkSession.sparkContext.broadcast({m: i for i, m in enumerate(merges)})

    def load() -> Callable[[str], list[str]]:
        return lambda word: segment(word, ranks.value)

    if isinstance(col, str):
        return df.withColumn(out, encode_words(load)(marked_words(col)))
    both = df.withColumn("__encoded", encode_words(load, out)(*[marked_words(c) for c in col]))
    return both.withColumns({name: F.col(f"__encoded.`{name}`") for name in out}).drop("__encoded")


def encode_pieces(
    df: DataFrame, load: Callable[[], Callable[[list[str]], list[list[str]]]], col: str = "text", out: str = "pieces"
) -> DataFrame:
    """Encode text to pieces with any subword model.

    ``load`` returns the encoder (list of texts -> list of their pieces) and runs once per
    task, so a model is read once and used for all batches, for example
    ``lambda: SentencePieceProcessor(model_proto=model_bytes).EncodeAsPieces``. It is
    given distinct texts, ``TEXTS`` at a time; a NULL text has NULL pieces.
    """

    @F.arrow_udf("array<string>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = load()
        for batch in batches:
            distinct = batch.dictionary_encode()
            texts = distinct.dictionary.to_pylist()
            parts = [pa.array([], pa.list_(pa.string()))]
            for at in range(0, len(texts), TEXTS):
                own = texts[at:at + TEXTS]
                pieces = list(model(own))
                if len(pieces) != len(own):
                    raise ValueError(f"the encoder returned {len(pieces)} results for {len(own)} texts")
                parts.append(pa.array([p if isinstance(p, list) else list(p) for p in pieces], pa.list_(pa.string())))
            yield pa.concat_arrays(parts).take(distinct.indices)

    return df.withColumn(out, encode(F.col(col)))
