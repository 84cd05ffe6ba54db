"""Corpus views over plain tables (documents, conversations, benchmark, events).

They give the operators input in the shapes they take: numbered
lines, aligned pairs, scored pairs, decoder logs, hypotheses, run ledgers and
vocabularies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentloom.functions import text as tx
from sentloom.operators.numbering import number_lines, number_rows
from sentloom.operators.pairing import pair_by_line

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
CONVERSATIONS = "conv_id bigint, turn bigint, role string, text string"
BENCHMARK = "item_id bigint, text string"
EVENTS = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"
EMBEDDINGS = "vec_id bigint, embedding array<float>, label int"


def table(spark: SparkSession, sf_dir: str, name: str, schema: str | None = None) -> DataFrame:
    """A Parquet table of the data folder; with a schema the read needs no footer job."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str, *langs: str) -> DataFrame:
    """The documents (of some languages)."""
    docs = table(spark, sf_dir, "documents", DOCUMENTS)
    return docs.filter(F.col("lang").isin(*langs)) if langs else docs


def lines(spark: SparkSession, sf_dir: str, *langs: str, line_value=None) -> DataFrame:
    """Numbered lines of the documents (of some languages)."""
    return number_lines(documents(spark, sf_dir, *langs), line_value)


def corpus(spark: SparkSession, sf_dir: str, *langs: str) -> DataFrame:
    """The lines in the corpus schema: a document source is a corpus."""
    return lines(spark, sf_dir, *langs).select(F.col("source").alias("corpus"), "lang", "line_no", "text")


def pairs(spark: SparkSession, sf_dir: str, src_lang: str = "en", tgt_lang: str = "de") -> DataFrame:
    """Lines of two languages aligned by number, the short side padded with ""."""
    src = lines(spark, sf_dir, src_lang).select("line_no", F.col("source").alias("corpus"), "text")
    tgt = lines(spark, sf_dir, tgt_lang).select("line_no", "text")
    return pair_by_line(src, tgt, "pad").select(
        "line_no", "corpus", F.lit(src_lang).alias("src_lang"), F.lit(tgt_lang).alias("tgt_lang"), "src", "tgt"
    )


def clean_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs with both sides non-empty.

    A pair with an empty side cannot pass, so the inner join by number is enough
    and the longer corpus is not padded first.
    """
    src = lines(spark, sf_dir, "en").select("line_no", F.col("source").alias("corpus"), "text")
    tgt = lines(spark, sf_dir, "de").select("line_no", "text")
    return pair_by_line(src.filter("text <> ''"), tgt.filter("text <> ''"), "truncate")


def scored_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean pairs with the length-ratio score."""
    return clean_pairs(spark, sf_dir).withColumn("score", F.round(tx.length_ratio("src", "tgt"), 4))


def pair_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scores of :func:`scored_pairs` alone: (line_no, corpus, score).

    The score needs the length of a line, so only lengths are shuffled and joined.
    """
    src = lines(spark, sf_dir, "en", line_value=F.length).select("line_no", F.col("source").alias("corpus"), "text")
    tgt = lines(spark, sf_dir, "de", line_value=F.length).select("line_no", "text")
    paired = pair_by_line(src.filter("text > 0"), tgt.filter("text > 0"), "truncate")
    ratio = F.least("src", "tgt").cast("double") / F.greatest("src", "tgt")
    return paired.select("line_no", "corpus", F.round(ratio, 4).alias("score"))


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-to-one pairs from conversations: a user turn and the assistant turn after it."""
    conv = table(spark, sf_dir, "conversations", CONVERSATIONS)
    user = conv.filter("role = 'user'").select("conv_id", "turn", F.col("text").alias("src"))
    reply = conv.filter("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("tgt")
    )
    return user.join(reply, ["conv_id", "turn"]).select(
        (F.col("conv_id") * 100 + F.col("turn")).alias("sent_id"), "src", "tgt"
    )


def decoder_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The turns as the five kinds of lines a decoder writes."""
    flat = turns(spark, sf_dir).select(
        F.col("sent_id").cast("string").alias("id"),
        F.replace("src", F.lit("\n"), F.lit(" ")).alias("src"),
        F.replace("tgt", F.lit("\n"), F.lit(" ")).alias("tgt"),
    )
    return flat.select(F.explode(F.array(
        F.concat(F.lit("S-"), "id", F.lit("\t"), "src"),
        F.concat(F.lit("T-"), "id", F.lit("\t"), "tgt"),
        F.concat(F.lit("H-"), "id", F.lit("\t-0.5\t"), "tgt"),
        F.concat(F.lit("D-"), "id", F.lit("\t-0.5\t"), "tgt"),
        F.concat(F.lit("P-"), "id", F.lit("\t-0.5 -0.1")),
    )).alias("line"))


def hyp_ref(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark texts as references; the hypothesis lacks every fifth word."""
    words = F.split("text", " ")
    kept = F.filter(words, lambda _, i: i % 5 != 4)
    return table(spark, sf_dir, "benchmark", BENCHMARK).select(
        "item_id", F.col("text").alias("ref"), F.array_join(kept, " ").alias("hyp")
    )


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run metrics with many ties: five experiments, eight iterations, two directions."""
    return (
        table(spark, sf_dir, "events", EVENTS)
        .groupBy(
            (F.col("user_id") % 5).alias("experiment"),
            (F.floor(F.col("event_id") / 2) % 8 + 1).alias("iteration"),
            F.when(F.col("event_id") % 2 == 0, "1n").otherwise("n1").alias("direction"),
        )
        .agg(F.round(F.avg("value"), 0).alias("metric"))
    )


def token_counts(spark: SparkSession, sf_dir: str, lang: str) -> DataFrame:
    """Lowercased space-separated tokens of a language with their counts.

    The counts need the words of each line only, so documents are not numbered.
    """
    docs = documents(spark, sf_dir, lang)
    return (
        docs.select(F.explode(F.split(F.lower("text"), "[ \n]")).alias("token"))
        .groupBy("token").agg(F.count(F.lit(1)).alias("count"))
    )


def vocab(spark: SparkSession, sf_dir: str, lang: str) -> DataFrame:
    """Token ids from 0 by (count descending, token)."""
    return number_rows(
        token_counts(spark, sf_dir, lang), [F.desc("count"), F.asc("token")], name="token_id", start=0
    )


def corpora(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean pairs labelled as parallel or as one of the two synthetic kinds."""
    return clean_pairs(spark, sf_dir).select(
        "line_no", "src", "tgt",
        F.when(F.col("line_no") % 3 == 0, "parallel")
        .when(F.col("line_no") % 3 == 1, "l1_syn_l2_orig").otherwise("l1_orig_l2_syn").alias("part"),
    )
