"""Lexical evidence for sentence pairs: word translation probabilities learned from the pairs themselves.

Expectation maximisation (the first of the well-known alignment models, in which every
target word is made by one source word or by none) as aggregations over the words that
occur together. Probabilities that become too small are left out, so the tables stay sparse.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import partial, reduce
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sentloom.functions import text as tx
from sentloom.operators import word_pairs
from sentloom.operators.numbering import number_rows
from sentloom.sources.staging import delete_path, free_shuffles, stage, staging_path

# The word that stands for no source word.
NO_WORD = ""
# Words of a side that are looked at together; longer pairs are cut into parts.
PART_WORDS = 100
# Words that occur together in a slice, and so many at least where cores would be idle otherwise.
SLICE_PAIRS, LEAST_PAIRS = 8_000_000, 1_000_000
# Pieces are large, so that some make a row group, which is read into memory as a whole.
FEW_ROWS = {"parquet.block.size": 1 << 20, "parquet.block.size.row.check.min": 1, "parquet.page.size.row.check.min": 1, "parquet.enable.dictionary": "false"}
# After the first round the slices are looked at in so many batches.
BATCHES = 4
SUMS = "code int, total double"
ROUNDS, LEAST = 5, 1e-4
LEXICAL = ["lexical_tgt", "lexical_src"]


def aligned_words(pairs: DataFrame, part_words: int = PART_WORDS) -> tuple[DataFrame, DataFrame]:
    """Lowercased words of both sides with counts: (line_no, part, s, ns) and (line_no, part, t, nt).

    A pair in which a side has more than ``part_words`` words is cut into so many parts that
    none has more; a word's part is that of its relative place, so all words count and
    a part is met by the part of the other side that it should belong to.
    """
    rows = pairs.select("line_no", tx.words(F.lower("src")).alias("_s"), tx.words(F.lower("tgt")).alias("_t")).withColumn(
        "_k", F.ceil(F.greatest(F.size("_s"), F.size("_t"), F.lit(1)) / part_words)
    )

    def side(words: str, name: str, count: str) -> DataFrame:
        place = F.floor(F.col("pos") * F.col("_k") / F.col("_n")).cast("int").alias("part")
        return (
            rows.select("line_no", "_k", F.size(words).alias("_n"), F.posexplode(words).alias("pos", name))
            .groupBy("line_no", place, name).agg(F.count(F.lit(1)).alias(count))
        )

    return side("_s", "s", "ns"), side("_t", "t", "nt")


def together(pairs: DataFrame, part_words: int = PART_WORDS) -> DataFrame:
    """Words that occur in the same part of a pair: (line_no, part, s, ns, t, nt), no source word included.

    At most ``part_words + 1`` times ``part_words`` rows for a part.
    """
    src, tgt = aligned_words(pairs, part_words)
    none = tgt.select("line_no", "part").distinct().select("line_no", "part", F.lit(NO_WORD).alias("s"), F.lit(1).cast("bigint").alias("ns"))
    return src.unionByName(none).join(tgt, ["line_no", "part"])


def _written(df: DataFrame, label: str, **options) -> tuple[DataFrame, str]:
    """``df`` written once, and the folder, to be deleted when it is done with."""
    path = staging_path(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def _parts(pairs: DataFrame, part_words: int, no_word: bool) -> tuple[DataFrame, str]:
    """The parts of the pairs that have target words, in chunks of lines written once: (i, line_no, size, s_words, t_words, met, data).

    ``size`` is how many words the target of a line has, ``met`` how many words occur
    together. With ``no_word`` a part has the word that stands for none as well.
    """
    lines = pairs.filter("line_no is not null").select("line_no", F.lower("src").alias("src"), F.lower("tgt").alias("tgt"))
    schema = T.StructType([
        T.StructField("line_no", T.ArrayType(pairs.schema["line_no"].dataType)), T.StructField("size", T.ArrayType(T.LongType())),
        *(T.StructField(c, T.ArrayType(T.StringType())) for c in ("s_words", "t_words")),
        T.StructField("met", T.LongType()), T.StructField("data", T.BinaryType()),
    ])
    cut = partial(word_pairs.cut, part_words=part_words, no_word=NO_WORD if no_word else None)
    chunks = lines.repartition("line_no").sortWithinPartitions("line_no").mapInArrow(cut, schema)
    return _written(chunks.select(F.monotonically_increasing_id().alias("i"), *schema.names), "parts")


def _slices(parts: DataFrame) -> int:
    """Slices of the target words, each of which is a task's: more for more words that occur together, and for the cores there are."""
    met = parts.agg(F.sum("met")).first()[0] or 0
    return max(1, -(-met // SLICE_PAIRS), min(BATCHES * parts.sparkSession.sparkContext.defaultParallelism, met // LEAST_PAIRS))


def _book(words: DataFrame) -> DataFrame:
    """Numbers from 0 of the words there are: (word, code), written once."""
    numbers = number_rows(words.distinct(), [F.col("word")], "code", 0)
    return stage(numbers.select("word", F.col("code").cast("int").alias("code")), "book")


def _coded(parts: DataFrame, s_book: DataFrame, t_book: DataFrame) -> tuple[DataFrame, str]:
    """The parts as pieces with the numbers of words in books, without words that have none, written once."""
    coded = parts.select("i", "data")
    for words, book, name in (("s_words", s_book, "s_codes"), ("t_words", t_book, "t_codes")):
        code = F.struct("pos", F.coalesce("code", F.lit(-1)).alias("code"))
        each = parts.select("i", F.posexplode(words).alias("pos", "word")).join(book, "word", "left").groupBy("i").agg(F.collect_list(code).alias("_c"))
        each = each.select("i", F.transform(F.sort_array("_c"), lambda x: x["code"]).alias(name))
        coded = coded.join(each, "i", "left").withColumn(name, F.coalesce(name, F.array().cast("array<int>")))
    # Each slice reads all of them, so they are not compressed.
    return _written(coded.mapInArrow(word_pairs.numbered, word_pairs.PIECE), "pieces", **FEW_ROWS, compression="none")


def _totals(sums: DataFrame) -> DataFrame:
    """Sums (code, total) of many tasks as pieces of the sums of all, written once."""
    whole = sums.groupBy("code").agg(F.sum("total").alias("total"))
    return stage(whole.mapInArrow(word_pairs.packed_sums, word_pairs.PIECE), "totals")


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """Inside, few pieces are sent to a task's worker at a time, as they are large."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "4m")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _nothing(batches):
    yield from ()


def _by_slice(spark: SparkSession, slices: list[tuple[list[DataFrame], Callable]], schema) -> DataFrame:
    """For each slice its frames in one task of its own, with the function that takes them in."""
    frames = [reduce(DataFrame.union, own).coalesce(1).mapInArrow(fn, schema) for own, fn in slices]
    # Frames that all have one partition are united to one; this one has two, and no rows.
    frames.append(spark.range(0, 2, 1, 2).mapInArrow(_nothing, schema))
    while len(frames) > 1:
        frames = [reduce(DataFrame.union, frames[k:k + 2]) for k in range(0, len(frames), 2)]
    return frames[0]


@dataclass(eq=False)
class _Table:
    """Probabilities as pieces of slices of target words, written in a folder for each slice.

    ``s_book`` and ``t_book`` number the words. With ``whole``, the sums of source words, the
    pieces have what is expected, and probabilities below ``least`` are left out.
    """

    path: str
    n: int
    s_book: DataFrame
    t_book: DataFrame
    n_s: int
    whole: DataFrame | None = None
    least: float | None = None

    def __post_init__(self):
        spark = self.s_book.sparkSession
        self.pieces = spark.read.schema("i bigint, data binary, kind string, k int").parquet(self.path)
        self.counts = {(r["k"], r["kind"]): r["count"] for r in self.pieces.groupBy("k", "kind").count().collect()}
        if any(kind == "sums" for _, kind in self.counts):
            own = self.pieces.filter("kind = 'sums'").select("kind", "i", "data")
            self.whole = _totals(own.mapInArrow(word_pairs.unpacked_sums, SUMS))
            delete_path(spark, f"{self.path}/kind=sums")
        self.sums = 0 if self.whole is None else self.whole.count()

    def sent(self, k: int) -> tuple[list[DataFrame], int]:
        """What a task of slice ``k`` is sent with, and how many pieces that is."""
        own = self.pieces.filter((F.col("k") == k) & (F.col("kind") == "table")).select("kind", "i", "data")
        return [own, *([] if self.whole is None else [self.whole])], self.counts.get((k, "table"), 0) + self.sums

    def drop(self, slices: Iterable[int]) -> None:
        for k in slices:
            delete_path(self.s_book.sparkSession, f"{self.path}/kind=table/k={k}")

    def rows(self) -> DataFrame:
        """The table as (s, t, p), read from its pieces whenever it is used."""
        books = [
            stage(book.mapInArrow(partial(word_pairs.packed_words, kind=kind), word_pairs.PIECE), kind)
            for book, kind in ((self.s_book, "s_words"), (self.t_book, "t_words"))
        ]
        slices = [
            ([*self.sent(k)[0], *books], partial(word_pairs.unpacked_table, k=k, n=self.n, n_s=self.n_s, least=self.least)) for k in range(self.n)
        ]
        return _by_slice(self.s_book.sparkSession, slices, "s string, t string, p double")


# The pieces of tables that were learned, by the frames that read them.
_LEARNED: WeakKeyDictionary[DataFrame, _Table] = WeakKeyDictionary()


def _write_slices(pieces: DataFrame, path: str) -> None:
    with _small_batches(pieces.sparkSession):
        pieces.withColumn("k", F.col("i").cast("int")).write.options(**FEW_ROWS, compression="zstd").partitionBy("kind", "k").mode("append").parquet(path)


def _as_table(table: DataFrame, n: int) -> _Table:
    """A table of rows (s, t, p) as pieces of ``n`` slices; of a word pair that is there twice the larger probability."""
    rows = table.select("s", "t", F.col("p").cast("double").alias("p")).filter(F.col("s") != NO_WORD).dropna(subset=["t", "p"])
    books = {c: _book(rows.select(F.col(c).alias("word"))) for c in ("s", "t")}
    for c, book in books.items():
        rows = rows.join(book.select(F.col("word").alias(c), F.col("code").alias(f"_{c}")), c)
    rows = rows.groupBy(F.col("_t").alias("t"), F.col("_s").alias("s")).agg(F.max("p").alias("p")).withColumn("_k", F.col("t") % n)
    ordered = rows.repartition("_k").sortWithinPartitions("_k", "t", "s").select("t", "s", "p")
    path = staging_path(table.sparkSession, "translations")
    _write_slices(ordered.mapInArrow(partial(word_pairs.packed_table, n=n), word_pairs.PIECE), path)
    free_shuffles(table.sparkSession)
    return _Table(path, n, books["s"], books["t"], books["s"].count())


def translation_probabilities(
    pairs: DataFrame, rounds: int = ROUNDS, least: float = LEAST, part_words: int = PART_WORDS
) -> DataFrame:
    """How likely a source word becomes a target word: (s, t, p), learned from pairs (line_no, src, tgt).

    ``s`` may be no word (``""``). All begin equally likely; after each round,
    probabilities below ``least`` are left out. Pairs with an empty target teach nothing.

    The words that occur together are many times the text, so they are never written nor
    shuffled: the task of a slice of target words reads the parts of all pairs and the
    probabilities of its words, and shares each of its words of a part out among the part's
    source words. What is then expected is written, with its sums by source word, by which
    it is divided when it is read.
    """
    spark = pairs.sparkSession
    parts, folder = _parts(pairs, part_words, True)
    free_shuffles(spark)
    n, books = _slices(parts), [_book(parts.select(F.explode(c).alias("word"))) for c in ("s_words", "t_words")]
    (pieces, text), n_s, table = _coded(parts, *books), books[0].count(), None
    delete_path(spark, folder)
    free_shuffles(spark)
    whole = _totals(pieces.mapInArrow(word_pairs.first_sums, SUMS))
    sums = whole.count()
    for _ in range(rounds):
        path, size = staging_path(spark, "translations"), -(-n // BATCHES) if table else n
        for first in range(0, n, size):
            batch, slices = range(first, min(first + size, n)), []
            for k in batch:
                own, sent = table.sent(k) if table else ([whole], sums)
                slices.append(([*own, pieces], partial(word_pairs.learn, k=k, n=n, n_s=n_s, sent=sent, least=least, first=table is None)))
            _write_slices(_by_slice(spark, slices, word_pairs.PIECE), path)
            if table:
                table.drop(batch)
        table = _Table(path, n, *books, n_s, whole, least)
        free_shuffles(spark)
    delete_path(spark, text)
    rows = table.rows()
    _LEARNED[rows] = table
    return rows


def log_likelihood(pairs: DataFrame, table: DataFrame, part_words: int = PART_WORDS) -> float:
    """Sum over target words of the logarithm of their probability; words that no source word makes are left out."""
    words = together(pairs, part_words)
    sizes = words.select("line_no", "part", "s", "ns").distinct().groupBy("line_no", "part").agg(F.sum("ns").alias("_size"))
    each = words.join(table, ["s", "t"]).groupBy("line_no", "part", "t", "nt").agg(F.sum(F.col("ns") * F.col("p")).alias("norm"))
    return each.join(sizes, ["line_no", "part"]).agg(F.sum(F.col("nt") * F.log(F.col("norm") / F.col("_size")))).first()[0] or 0.0


def _covered(pairs: DataFrame, table: DataFrame, out: str, part_words: int) -> DataFrame:
    """For each pair the mean, over target words, of the best probability that a word of the source makes it."""
    spark, (parts, folder) = pairs.sparkSession, _parts(pairs, part_words, False)
    free_shuffles(spark)
    least, lines = _slices(parts), stage(parts.select("i", "line_no", "size"), "lines")
    known = _LEARNED.get(table) or _as_table(table, least)
    n, (pieces, text), slices = known.n * -(-least // known.n), _coded(parts, known.s_book, known.t_book), []
    delete_path(spark, folder)
    free_shuffles(spark)
    for k in range(n):
        own, sent = known.sent(k % known.n)
        slices.append(([*own, pieces], partial(word_pairs.cover, k=k, n=n, n_s=known.n_s, sent=sent, of=known.n, least=known.least)))
    with _small_batches(spark):
        best = stage(_by_slice(spark, slices, word_pairs.PIECE), "covered").select("i", "data")
    delete_path(spark, text)
    schema = T.StructType([pairs.schema["line_no"], T.StructField(out, T.DoubleType())])
    rows = lines.unionByName(best, allowMissingColumns=True)
    return rows.groupBy("i").applyInArrow(lambda chunk: word_pairs.divided(chunk, out), schema)


def lexical_features(pairs: DataFrame, forward: DataFrame, backward: DataFrame, part_words: int = PART_WORDS) -> DataFrame:
    """Add ``lexical_tgt`` and ``lexical_src``: how well the words of either side are explained by the other's.

    ``forward`` has the probabilities from source to target words, ``backward`` from target
    to source words. A pair with an empty side has 0. ``line_no`` is unique.
    """
    turned = pairs.select("line_no", F.col("tgt").alias("src"), F.col("src").alias("tgt"))
    one = _covered(pairs.select("line_no", "src", "tgt"), forward, LEXICAL[0], part_words)
    two = _covered(turned, backward, LEXICAL[1], part_words)
    return pairs.join(one, "line_no", "left").join(two, "line_no", "left").fillna(0.0, LEXICAL)
