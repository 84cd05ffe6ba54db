"""Dictionaries: dense ids by frequency, encoding, decoding and remapping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentloom.functions import text as tx
from sentloom.operators.lookup import MAX_BROADCAST_ROWS, Lookup, lookup_array, prepare_lookup
from sentloom.operators.numbering import number_rows

# Special symbols of a dictionary, in id order.
SPECIAL_SYMBOLS = ["<s>", "<pad>", "</s>", "<unk>"]
UNK_ID = SPECIAL_SYMBOLS.index("<unk>")
# Fixed value: how an unknown reference token is written among ids.
UNK_MARK = "<<unk>>"
# Fixed value: name of the symbols that pad a dictionary, numbered from 0000.
PADDING_FORMAT = "madeupword%04d"


def token_counts(df: DataFrame, col: str = "pieces") -> DataFrame:
    """Tokens of an array column with their counts (counted map-side first)."""
    return (
        df.select(F.explode(col).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("count"))
    )


def assign_ids(counts: DataFrame, start: int = 0) -> DataFrame:
    """Dense ids by (count descending, token), without a global window."""
    return number_rows(counts, [F.desc("count"), F.asc("token")], name="token_id", start=start)


def build_dictionary(
    df: DataFrame,
    lang_tags: Sequence[str] = (),
    pad_to: int = 8,
    col: str = "pieces",
) -> DataFrame:
    """Dictionary of the pieces of a corpus: (token, count, token_id).

    Ids start after the special symbols. Each language adds a symbol ``__xx__`` with
    count 1 (or 1 more, if the corpus has it). Padding symbols with count 0 follow:
    enough to make the size plus the language symbols and one more a multiple of
    ``pad_to``, and then the size itself.
    """
    spark = df.sparkSession
    counts = token_counts(df, col).filter(~F.col("token").isin(SPECIAL_SYMBOLS))
    if lang_tags:
        tags = spark.createDataFrame([(t,) for t in lang_tags], "tag string")
        symbols = tags.select(tx.lang_symbol("tag").alias("token"), F.lit(1).cast("bigint").alias("count"))
        counts = counts.unionByName(symbols).groupBy("token").agg(F.sum("count").alias("count"))
    words = assign_ids(counts, start=len(SPECIAL_SYMBOLS)).select("token", "count", "token_id")
    if pad_to <= 1:
        return words
    extra = len(lang_tags) + 1
    size = F.count(F.lit(1)) + len(SPECIAL_SYMBOLS)
    padding = (
        words.agg(size.alias("_size"))
        .withColumn("_n", F.pmod(-(F.col("_size") + extra), F.lit(pad_to)) + extra % pad_to)
        .filter("_n > 0")
        .select("_size", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_n") - 1)).alias("_i"))
        .select(
            F.format_string(PADDING_FORMAT, F.col("_i")).alias("token"),
            F.lit(0).cast("bigint").alias("count"),
            (F.col("_size") + F.col("_i")).alias("token_id"),
        )
    )
    return words.unionByName(padding)


def joined_dictionary(df: DataFrame, src: str = "src_pieces", tgt: str = "tgt_pieces", **kw) -> DataFrame:
    """One dictionary over both sides of the pairs."""
    return build_dictionary(df.select(F.explode(F.array(src, tgt)).alias("pieces")), **kw)


def vocabulary_lookup(vocab: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> Lookup:
    """A vocabulary (token, token_id) made ready for any number of calls of :func:`ids_from_vocab`."""
    return prepare_lookup(vocab.select(F.col("token").alias("key"), F.col("token_id").alias("value")), "bigint", max_rows)


def ids_from_vocab(
    df: DataFrame,
    vocab: DataFrame | Lookup,
    col: str = "pieces",
    out: str = "ids",
    unk_id: int = UNK_ID,
    eos_id: int | None = None,
    max_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Tokens to ids; unknown tokens get ``unk_id``, ``eos_id`` is appended if given."""
    known = vocab if isinstance(vocab, Lookup) else vocabulary_lookup(vocab, max_rows)
    encoded = lookup_array(df, col, out, known, unk_id, "bigint")
    if eos_id is not None:
        encoded = encoded.withColumn(out, F.array_append(out, F.lit(eos_id).cast("bigint")))
    return encoded


def encode_ids(df: DataFrame, vocab: DataFrame | Lookup, col: str = "pieces", out: str = "id_text", **kw) -> DataFrame:
    """Pieces to space-joined ids."""
    encoded = ids_from_vocab(df, vocab, col, "_ids", **kw)
    return encoded.withColumn(out, F.array_join(F.col("_ids").cast("array<string>"), " ")).drop("_ids")


def decode_ids(
    df: DataFrame,
    vocab: DataFrame,
    col: str = "id_text",
    out: str = "text",
    max_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Space-joined ids to text; ``<<unk>>`` stands for id 0, ids without a token for ``<unk>``."""
    table = vocab.select(F.col("token_id").alias("key"), F.col("token").alias("value"))
    ids = F.transform(tx.words(col), lambda t: F.when(t == UNK_MARK, F.lit("0")).otherwise(t))
    pieces = lookup_array(
        df.withColumn("_ids", ids), "_ids", "_pieces", table, "<unk>", "string", max_rows
    )
    return pieces.withColumn(out, tx.join_pieces("_pieces")).drop("_ids", "_pieces")


def map_vocabulary(tgt_vocab: DataFrame, src_vocab: DataFrame, unk_id: int = UNK_ID) -> DataFrame:
    """For every token of a vocabulary its id in another one, unknown tokens at ``unk_id``."""
    known = src_vocab.select("token", F.col("token_id").alias("src_id"))
    return tgt_vocab.select("token", "token_id").join(known, "token", "left").select(
        "token", "token_id", F.coalesce("src_id", F.lit(unk_id)).cast("bigint").alias("src_id")
    )


def trim_embeddings(
    emb: DataFrame, mapping: DataFrame, unk_id: int = UNK_ID, missing: str = "error"
) -> DataFrame:
    """Embedding rows of a new vocabulary: (token_id, src_id, embedding), one for each row of ``mapping``.

    A ``src_id`` without a vector is an error; with ``missing="unk"`` it takes the
    vector of the unknown id (and keeps its ``src_id``). There must be a vector for the
    unknown id if any row needs it.

    Many tokens may share the unknown id, which would be a hot join key; its one
    row is broadcast, and all other ids occur once per token.
    """
    if missing not in ("error", "unk"):
        raise ValueError(f"missing must be 'error' or 'unk', not {missing!r}")
    emb = emb.select(F.col("token_id").alias("src_id"), "embedding")
    # dropDuplicates keeps the broadcast side at one row whatever the input holds.
    unk = F.broadcast(
        emb.filter(F.col("src_id") == unk_id).dropDuplicates(["src_id"])
        .select(F.lit(1).alias("_one"), F.col("embedding").alias("_unk"))
    )
    unknown = mapping.filter(F.col("src_id").eqNullSafe(F.lit(unk_id))).withColumn("_vector", F.lit(None).cast(emb.schema["embedding"].dataType))
    known = (
        mapping.filter(~F.col("src_id").eqNullSafe(F.lit(unk_id))).join(emb, "src_id", "left")
        .withColumnRenamed("embedding", "_vector")
    )
    rows = known.unionByName(unknown).withColumn("_one", F.lit(1)).join(unk, "_one", "left")
    no_vector = F.raise_error(F.concat(F.lit("no embedding for id "), F.coalesce(F.col("src_id").cast("string"), F.lit("NULL"))))
    takes_unk = F.lit(True) if missing == "unk" else F.col("src_id") == unk_id
    vector = F.coalesce("_vector", F.when(takes_unk, F.col("_unk")), no_vector.cast(emb.schema["embedding"].dataType))
    return rows.select("token_id", "src_id", vector.alias("embedding"))
