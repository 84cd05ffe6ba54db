"""Queries over the given tables, one or more per operator."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable
from functools import reduce
from itertools import chain, islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentloom.functions import text as tx
from sentloom.operators import (
    cleaning,
    ledger,
    lexical,
    metrics,
    mixtures,
    pairing,
    sampling,
    scored_pieces,
    scoring,
    stats,
    subword,
    synthesis,
    tokenization,
    vocabulary,
)
from sentloom.plans import classifier as classifier_plan
from sentloom.plans import experiment, student, views
from sentloom.sources import corpus, sinks
from sentloom.sources.staging import materialize_once, stage, staging_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SEED = 7


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def side_lines(spark, sf, lang):
    return views.lines(spark, sf, lang).select("line_no", "text")


def joined(col):
    """Arrays compare as text."""
    return F.array_join(F.col(col).cast("array<string>"), " ").alias(col)


# --- sources and sinks: tables go out as files and come back -----------------

@query
def read_corpus(spark, sf):
    folder = sinks.write_lines(side_lines(spark, sf, "en"), staging_path(spark, "en"))
    return corpus.read_corpus(spark, folder, "documents", "en")


@query
def read_parallel(spark, sf):
    en = sinks.write_lines(side_lines(spark, sf, "en"), staging_path(spark, "en"))
    de = sinks.write_lines(side_lines(spark, sf, "de"), staging_path(spark, "de"))
    return corpus.read_parallel(spark, en, de, "documents", "en", "de")


@query
def read_parallel_listed(spark, sf):
    # Several corpora a side, whose names sort differently on the two sides: the listed order counts.
    root = staging_path(spark, "listed")
    names = {"en": ("z", "m", "a"), "de": ("b", "y", "k")}
    for lang, own in names.items():
        lines = side_lines(spark, sf, lang)
        for third, name in enumerate(own):
            sinks.write_lines(lines.filter(F.col("line_no") % 3 == third), f"{root}/{name}.{lang}")
    src, tgt = (corpus.corpus_paths(spark, root, own, lang) for lang, own in names.items())
    return corpus.read_parallel(spark, src, tgt, "listed", "en", "de")


@query
def read_corpora(spark, sf):
    root = staging_path(spark, "named")
    for lang in ("de", "fr", "en"):
        sinks.write_lines(side_lines(spark, sf, lang), f"{root}/{lang}_lines.txt")
    return corpus.read_corpora(spark, root, ["fr_lines", "de_lines", "en_lines"], "txt").select("corpus", "line_no", "text")


@query
def assign_splits(spark, sf):
    roles = {"src0": "test", "src1": "valid", "src2": "train", "src3": "train", "src4": "train"}
    return cleaning.assign_splits(views.corpus(spark, sf), roles).select("split", "corpus", "lang", "line_no")


@query
def write_splits(spark, sf):
    roles = {"src0": "test", "src1": "valid", "src2": "train", "src3": "train", "src4": "train"}
    path = staging_path(spark, "splits")
    sinks.write_splits(cleaning.assign_splits(views.corpus(spark, sf), roles), path)
    return spark.read.parquet(path).select("split", "corpus", "lang", "line_no", "text")


@query
def read_corpus_glob(spark, sf):
    root = staging_path(spark, "langs")
    for lang in ("de", "en", "es", "fr"):
        sinks.write_lines(side_lines(spark, sf, lang), f"{root}/{lang}")
    return corpus.read_lines(spark, f"{root}/*").select("line_no", tx.one_line("text").alias("text"))


@query
def read_scored(spark, sf):
    path = sinks.write_scored(views.scored_pairs(spark, sf), staging_path(spark, "scored"))
    return corpus.read_scored(spark, path)


@query
def write_sides(spark, sf):
    src, tgt = sinks.write_sides(views.clean_pairs(spark, sf), staging_path(spark, "sides"))
    return corpus.read_parallel(spark, src, tgt, "sides", "en", "de").select("line_no", "src", "tgt")


@query
def write_wordfreq(spark, sf):
    counts = stats.word_frequencies(views.documents(spark, sf, "de"), "de")
    return corpus.read_wordfreq(spark, sinks.write_wordfreq(counts, staging_path(spark, "wordfreq")))


@query
def materialize_once_per_stage(spark, sf):
    path = staging_path(spark, "stage")
    materialize_once(spark, lambda: stats.corpus_counts(views.corpus(spark, sf)), path)
    # The stage is complete, so the second call reads it instead of doubling the counts.
    return materialize_once(spark, lambda: stats.corpus_counts(views.corpus(spark, sf).unionAll(views.corpus(spark, sf))), path)


@query
def write_result(spark, sf):
    path = sinks.write_result(views.ledger(spark, sf), staging_path(spark, "result"))
    return spark.read.schema("experiment bigint, iteration bigint, direction string, metric double").json(path)


@query
def write_synthetic(spark, sf):
    path = sinks.write_synthetic(synthetic_parts(views.corpora(spark, sf)), staging_path(spark, "synthetic"))
    return sinks.read_synthetic(spark, path).select("line_no", "l1", "l2", "l1_origin", "l2_origin")


# --- projections and filters -------------------------------------------------

@query
def number_lines(spark, sf):
    return views.lines(spark, sf)


@query
def drop_empty_pairs(spark, sf):
    return cleaning.drop_empty_pairs(views.pairs(spark, sf)).select("line_no", "corpus", "src", "tgt")


@query
def drop_empty_pairs_unchanged(spark, sf):
    return cleaning.drop_empty_pairs(views.pairs(spark, sf), strip=False).select("line_no", "corpus", "src", "tgt")


@query
def side_src(spark, sf):
    return pairing.side(views.pairs(spark, sf), "src")


@query
def side_tgt(spark, sf):
    return pairing.side(views.pairs(spark, sf), "tgt")


@query
def filter_by_score(spark, sf):
    return cleaning.filter_by_score(views.pair_scores(spark, sf), 0.5)


@query
def max_pieces(spark, sf):
    pieces = views.lines(spark, sf).withColumn("pieces", tx.words("text"))
    return cleaning.max_pieces(pieces, 100).select("lang", "line_no", F.size("pieces").alias("n_pieces"))


@query
def strip_lines(spark, sf):
    padded = views.lines(spark, sf).withColumn("text", F.concat(F.lit(" \t "), "text", F.lit("　 \r")))
    return cleaning.strip_lines(padded).select("lang", "line_no", "text")


def both_pieces(spark, sf):
    return views.pairs(spark, sf).withColumns({"src_pieces": tx.words("src"), "tgt_pieces": tx.words("tgt")})


@query
def length_filter(spark, sf):
    kept = cleaning.length_filter(both_pieces(spark, sf), min_len=5, max_len=80)
    return kept.select("line_no", joined("src_pieces"), joined("tgt_pieces"))


@query
def encode_stats(spark, sf):
    return cleaning.encode_stats(both_pieces(spark, sf), min_len=5, max_len=80)


@query
def parse_hypotheses(spark, sf):
    return cleaning.parse_hypotheses(views.decoder_log(spark, sf))


@query
def parse_hypotheses_third(spark, sf):
    # A tab inside the text: the third field ends there, the last one starts there.
    log = views.decoder_log(spark, sf).withColumn("line", F.regexp_replace("line", "^(.*) ", "$1\t"))
    third = cleaning.parse_hypotheses(log, field="third").withColumnRenamed("text", "third")
    last = cleaning.parse_hypotheses(log).select("sent_id", F.col("text").alias("last"))
    return third.join(last, "sent_id")


@query
def lower_text(spark, sf):
    return cleaning.lower_text(views.lines(spark, sf)).select("lang", "line_no", "text")


@query
def normalize_text(spark, sf):
    # Half of the lines with their marks taken apart, half as they are.
    apart = cleaning.normalize_text(views.lines(spark, sf).filter("line_no % 2 = 0"), "NFD")
    both = apart.unionByName(views.lines(spark, sf).filter("line_no % 2 = 1"))
    return cleaning.normalize_text(both, "NFC").select("lang", "line_no", "text")


def _tokenize(lang):
    def run(spark, sf):
        df = tokenization.tokenize(views.lines(spark, sf, lang), lang)
        return df.select("line_no", joined("tokens"))

    run.__name__ = f"tokenize_{lang}"
    return query(run)


for _lang in ("de", "en", "es", "fr"):
    _tokenize(_lang)


def _threes():
    return lambda texts: [re.findall("[^ ]{1,3}", t) for t in texts]


@query
def encode_pieces(spark, sf):
    encoded = subword.encode_pieces(views.lines(spark, sf), _threes)
    return encoded.select("lang", "line_no", joined("pieces"))


def lower_tokens(spark, sf, lang):
    return views.lines(spark, sf, lang).withColumn("pieces", F.split(F.lower("text"), " "))


@query
def encode_ids(spark, sf):
    encoded = vocabulary.encode_ids(lower_tokens(spark, sf, "de"), views.vocab(spark, sf, "en"), unk_id=3)
    return encoded.select("line_no", "id_text")


@query
def decode_pieces(spark, sf):
    pieces = views.lines(spark, sf).withColumn("pieces", F.split(F.concat(F.lit("▁"), F.replace("text", F.lit(" "), F.lit(" ▁"))), " "))
    return cleaning.decode_pieces(pieces).select("lang", "line_no", "text")


@query
def decode_ids(spark, sf):
    en = views.vocab(spark, sf, "en")
    encoded = vocabulary.encode_ids(lower_tokens(spark, sf, "de"), en, unk_id=-1).select(
        "line_no", F.replace("id_text", F.lit("-1"), F.lit("<<unk>>")).alias("id_text")
    )
    return vocabulary.decode_ids(encoded, en).select("line_no", "text")


@query
def remove_subwords(spark, sf):
    marked = F.concat(F.lit("▁"), F.replace(F.replace("tgt", F.lit(" "), F.lit(" ▁")), F.lit("e"), F.lit(" e")))
    return cleaning.remove_subwords(views.turns(spark, sf).select("sent_id", marked.alias("text")))


@query
def lang_codes(spark, sf):
    tagged = views.table(spark, sf, "documents", views.DOCUMENTS).select(
        "doc_id", F.concat("lang", F.lit("_"), F.upper("lang")).alias("tag")
    )
    return tagged.select("doc_id", tx.lang_code("tag").alias("code"), tx.lang_symbol("tag").alias("symbol"))


@query
def score_label(spark, sf):
    label = F.lpad(F.floor(F.col("score") * 10).cast("string"), 2, "0")
    return (
        views.scored_pairs(spark, sf).select("line_no", label.alias("label"))
        .withColumn("threshold", tx.score_label("label"))
    )


@query
def with_placeholder(spark, sf):
    return cleaning.with_placeholder(views.lines(spark, sf)).select("lang", "line_no", "tgt")


@query
def add_lang_tags(spark, sf):
    tagged = cleaning.add_lang_tags(both_pieces(spark, sf), "en_XX", "de_DE")
    return tagged.select("line_no", joined("src_pieces"), joined("tgt_pieces"))


@query
def parse_report(spark, sf):
    lines = views.ledger(spark, sf).select(
        "experiment", "iteration", "direction",
        F.concat(F.lit("BLEU = "), F.col("metric").cast("string"), F.lit(" (BP = 1.000)")).alias("line"),
    )
    return cleaning.parse_report(lines).drop("line")


# --- joins -------------------------------------------------------------------

@query
def pair_by_line_pad(spark, sf):
    return views.pairs(spark, sf)


@query
def pair_by_line_truncate(spark, sf):
    return pairing.pair_by_line(side_lines(spark, sf, "en"), side_lines(spark, sf, "de"), "truncate")


def some_hypotheses(spark, sf):
    """Hypotheses of the log for every source but those whose id ends in 4."""
    hyps = cleaning.parse_hypotheses(views.decoder_log(spark, sf)).select("sent_id", F.col("text").alias("hyp"))
    return hyps.filter("sent_id % 10 <> 4")


@query
def attach_hypotheses(spark, sf):
    return pairing.attach_hypotheses(views.turns(spark, sf).select("sent_id", "src"), some_hypotheses(spark, sf))


@query
def missing_hypotheses(spark, sf):
    return pairing.missing_hypotheses(views.turns(spark, sf), some_hypotheses(spark, sf))


@query
def map_vocabulary(spark, sf):
    return vocabulary.map_vocabulary(views.vocab(spark, sf, "de"), views.vocab(spark, sf, "en"), unk_id=0)


@query
def trim_embeddings(spark, sf):
    emb = views.table(spark, sf, "embeddings", views.EMBEDDINGS).select(F.col("vec_id").alias("token_id"), "embedding")
    # The model's vocabulary is as long as the table has vectors; the new one is all German tokens.
    n = emb.agg(F.max("token_id")).first()[0]
    model_vocab = views.vocab(spark, sf, "de").filter(F.col("token_id") <= n)
    mapping = vocabulary.map_vocabulary(views.vocab(spark, sf, "de"), model_vocab, unk_id=0)
    trimmed = vocabulary.trim_embeddings(mapping=mapping, emb=emb, unk_id=0)
    millionths = F.transform("embedding", lambda x: F.round(x.cast("double") * 1_000_000).cast("bigint").cast("string"))
    return trimmed.select("token_id", "src_id", F.array_join(millionths, " ").alias("millionths"))


@query
def ids_from_vocab(spark, sf):
    encoded = vocabulary.ids_from_vocab(lower_tokens(spark, sf, "de"), views.vocab(spark, sf, "de"), eos_id=2)
    return encoded.select("line_no", joined("ids"))


@query
def ids_from_vocab_shuffled(spark, sf):
    # The way taken by vocabularies too large to send to every executor.
    encoded = vocabulary.ids_from_vocab(
        lower_tokens(spark, sf, "de"), views.vocab(spark, sf, "en"), unk_id=3, max_rows=0
    )
    return encoded.select("line_no", joined("ids"))


@query
def ids_from_vocab_all(spark, sf):
    # All languages, whose line numbers repeat each other, through the joined way.
    lines = views.lines(spark, sf).withColumn("pieces", F.split(F.lower("text"), " "))
    encoded = vocabulary.ids_from_vocab(lines, views.vocab(spark, sf, "en"), unk_id=3, max_rows=0)
    return encoded.select("lang", "line_no", joined("ids"))


@query
def missing_corpora(spark, sf):
    config = spark.createDataFrame([("src1",), ("src2",), ("src99",), ("dev",)], "corpus string")
    return pairing.missing_corpora(config, views.corpus(spark, sf))


# --- aggregations ------------------------------------------------------------

@query
def threshold_sweep_by_corpus(spark, sf):
    return stats.threshold_sweep(views.pair_scores(spark, sf), by=["corpus"])


@query
def threshold_sweep(spark, sf):
    return stats.threshold_sweep(views.pair_scores(spark, sf))


@query
def word_frequencies(spark, sf):
    return stats.word_frequencies(views.documents(spark, sf, "en"), "en")


@query
def word_frequencies_as_written(spark, sf):
    return stats.word_frequencies(views.documents(spark, sf, "de"), "de", as_written=True)


@query
def build_dictionary(spark, sf):
    docs = views.documents(spark, sf, "en")
    return vocabulary.build_dictionary(docs.withColumn("pieces", F.split(F.lower("text"), "[ \n]")), ["en_XX", "de_DE"])


@query
def joined_dictionary(spark, sf):
    return vocabulary.joined_dictionary(both_pieces(spark, sf), pad_to=1)


@query
def corpus_counts(spark, sf):
    return stats.corpus_counts(views.corpus(spark, sf), by=["lang", "corpus"])


@query
def corpus_bleu(spark, sf):
    return metrics.corpus_bleu(views.hyp_ref(spark, sf)).select(F.round("bleu", 6).alias("bleu"))


@query
def corpus_bleu_turns(spark, sf):
    df = views.turns(spark, sf).select((F.col("sent_id") % 3).alias("part"), F.col("src").alias("hyp"), F.col("tgt").alias("ref"))
    return metrics.corpus_bleu(df, by=["part"]).select("part", F.round("bleu", 6).alias("bleu"))


@query
def corpus_chrf(spark, sf):
    return metrics.corpus_chrf(views.hyp_ref(spark, sf)).select(F.round("chrf", 6).alias("chrf"))


@query
def corpus_chrf_plus_plus(spark, sf):
    return metrics.corpus_chrf(views.hyp_ref(spark, sf), word_order=2).select(F.round("chrf", 6).alias("chrf"))


def with_threes(df):
    threes = F.lit("([^ ]{1,3})")
    return df.withColumns({
        "hyp_pieces": F.regexp_extract_all("hyp", threes), "ref_pieces": F.regexp_extract_all("ref", threes),
    })


@query
def corpus_bleu_pieces(spark, sf):
    df = with_threes(views.hyp_ref(spark, sf))
    return metrics.corpus_bleu(df, "hyp_pieces", "ref_pieces", "pieces").select(F.round("bleu", 6).alias("bleu"))


@query
def evaluate(spark, sf):
    report = metrics.evaluate(with_threes(views.hyp_ref(spark, sf)))
    return report.select("metric", F.round("value", 6).alias("value"))


@query
def vocab_coverage(spark, sf):
    docs = views.documents(spark, sf)
    tokens = docs.withColumn("tokens", F.split(F.lower("text"), "[ \n]"))
    report = stats.vocab_coverage(tokens, views.vocab(spark, sf, "en"), by=["lang"])
    return report.withColumn("oov_rate", F.round("oov_rate", 6))


# --- run ledger --------------------------------------------------------------

def baselines(spark, sf):
    runs = views.ledger(spark, sf)
    return runs.groupBy("experiment", "direction").agg(F.avg("metric").alias("baseline"))


@query
def best_run(spark, sf):
    return ledger.best_run(views.ledger(spark, sf))


@query
def accept_flags(spark, sf):
    return ledger.accept_flags(views.ledger(spark, sf))


@query
def accept_flags_baseline(spark, sf):
    return ledger.accept_flags(views.ledger(spark, sf), baselines(spark, sf))


@query
def stop_iteration(spark, sf):
    return ledger.stop_iteration(views.ledger(spark, sf))


@query
def best_threshold(spark, sf):
    sweep = views.ledger(spark, sf).withColumn("threshold", (F.col("iteration") - 1) / 10)
    return ledger.best_threshold(sweep)


@query
def assign_ids(spark, sf):
    return views.vocab(spark, sf, "en")


@query
def gate(spark, sf):
    first = views.ledger(spark, sf).filter("iteration = 1")
    return ledger.gate(first, baselines(spark, sf))


# --- orders, prefixes, samples -----------------------------------------------

@query
def order_by_id(spark, sf):
    return sampling.order_by_id(views.turns(spark, sf).select(F.col("sent_id").cast("string").alias("sent_id"), "src"))


@query
def order_by_frequency(spark, sf):
    return stats.order_by_frequency(views.token_counts(spark, sf, "fr").withColumnRenamed("token", "word"))


@query
def head_lines(spark, sf):
    return sampling.head_lines(views.lines(spark, sf), 1000).select("lang", "line_no", "text")


@query
def growing_prefix(spark, sf):
    mono = stage(side_lines(spark, sf, "en"), "mono")
    sizes = [(0, sampling.prefix_for("first")), (0, sampling.prefix_for("loop_start"))]
    sizes += [(i, sampling.prefix_for("iteration", i)) for i in range(1, 9)]
    return reduce(DataFrame.unionByName, [
        sampling.head_lines(mono, n).agg(
            F.lit(i).cast("bigint").alias("iteration"), F.count(F.lit(1)).alias("n_lines"),
            F.sum(F.length("text")).alias("n_chars"),
        )
        for i, n in sizes
    ])


@query
def cap_pairs(spark, sf):
    return sampling.cap_pairs(stage(views.clean_pairs(spark, sf), "pairs"), seed=SEED).select("line_no", "src", "tgt")


@query
def cap_pairs_as_written(spark, sf):
    return sampling.cap_pairs(stage(views.clean_pairs(spark, sf), "pairs"), as_written=True).select("line_no", "src", "tgt")


@query
def shuffle_rows(spark, sf):
    return sampling.shuffle_rows(views.clean_pairs(spark, sf), SEED).select("line_no", "src", "tgt")


@query
def permute_rows(spark, sf):
    lines = stage(views.lines(spark, sf, "en").select("line_no"), "numbers")
    return sampling.permute_rows(lines, lines.count(), SEED)


# --- mixtures ----------------------------------------------------------------

@query
def concat_corpora(spark, sf):
    # Corpora come as written tables.
    written = stage(views.lines(spark, sf).select("lang", "line_no", "text"), "lines")
    return mixtures.concat_corpora([written.filter(F.col("lang") == lang) for lang in ("fr", "en", "de", "es")])


@query
def augment(spark, sf):
    parts = stage(views.corpora(spark, sf), "corpora")
    return mixtures.augment(parts.filter("part = 'parallel'"), parts.filter("part = 'l1_syn_l2_orig'"))


def parallel_part(corpora):
    return corpora.filter("part = 'parallel'").select("line_no", F.col("src").alias("l1"), F.col("tgt").alias("l2"))


def synthetic_parts(corpora):
    so = F.col("part") == "l1_syn_l2_orig"
    return corpora.filter("part <> 'parallel'").select(
        "line_no", F.col("src").alias("l1"), F.col("tgt").alias("l2"),
        F.when(so, "synthetic").otherwise("original").alias("l1_origin"),
        F.when(so, "original").otherwise("synthetic").alias("l2_origin"),
    )


def _mixture(flavour, direction):
    def run(spark, sf):
        # Corpora are written once and read by every mixture.
        corpora = stage(views.corpora(spark, sf), "corpora")
        return mixtures.mixture(parallel_part(corpora), synthetic_parts(corpora), flavour, direction)

    run.__name__ = f"mixture_{flavour}_{direction}"
    return query(run)


for _flavour, _direction in mixtures.MIXTURES:
    _mixture(_flavour, _direction)


@query
def joint_text(spark, sf):
    return mixtures.joint_text(views.clean_pairs(spark, sf))


@query
def temperature_weights(spark, sf):
    weights = sampling.temperature_weights(views.lines(spark, sf), by="lang")
    return weights.withColumns({"p": F.round("p", 6), "rate": F.round("rate", 6)})


@query
def temperature_mix(spark, sf):
    mixed = sampling.temperature_mix(views.lines(spark, sf), by="lang", seed=SEED)
    return mixed.select("lang", "line_no", F.col("copy").cast("bigint").alias("copy"))


@query
def temperature_quotas(spark, sf):
    lines = stage(views.lines(spark, sf).select("lang", "line_no", "text"), "lines")
    mixed = sampling.temperature_quotas(lines, by="lang", seed=SEED)
    return mixed.select("lang", "line_no", F.col("copy").cast("bigint").alias("copy"))


# --- scoring, subwords, synthesis --------------------------------------------

def german_words(spark, sf):
    return stage(stats.word_frequencies(views.documents(spark, sf, "de"), "de"), "wordfreq")


FIGURES = ["length_ratio", "copied_share", "punct_agreement", "digit_agreement", "tgt_log_freq"]


@query
def pair_features(spark, sf):
    features = scoring.pair_features(views.clean_pairs(spark, sf), german_words(spark, sf), "de")
    return features.select("line_no", "src_tokens", "tgt_tokens", *[F.round(c, 6).alias(c) for c in FIGURES])


@query
def make_negatives(spark, sf):
    return scoring.make_negatives(stage(views.clean_pairs(spark, sf), "pairs"), SEED)


@query
def pair_examples(spark, sf):
    examples = scoring.pair_examples(stage(views.clean_pairs(spark, sf), "pairs"), german_words(spark, sf), "de", SEED)
    return examples.select("line_no", "label", "src_tokens", "tgt_tokens", *[F.round(c, 6).alias(c) for c in FIGURES])


def classifier(pairs, words, featured=False):
    """A classifier of written pairs; the sample, if it is less than all, is written once too."""
    sample = sampling.cap_pairs(pairs, seed=SEED)
    if sample is not pairs:
        sample = stage(sample, "sample")
    train, dev = sample.filter("line_no % 5 <> 0"), sample.filter("line_no % 5 = 0")
    return scoring.fit_pair_classifier(train, dev, words, "de", SEED, featured=featured)


@query
def replace_words(spark, sf):
    pairs = stage(views.clean_pairs(spark, sf).select("line_no", "src", "tgt"), "pairs")
    changed = scoring.replace_words(pairs, scoring.target_words(pairs), 0.3, SEED)
    return changed.select("line_no", "tgt", "n_replaced")


# Rounds and least probability of the word translation tables that SQL learns as well.
EM_ROUNDS, EM_LEAST = 2, 0.00137


def _translations(pairs):
    return lexical.translation_probabilities(pairs, EM_ROUNDS, EM_LEAST)


@query
def translation_probabilities(spark, sf):
    pairs = stage(views.clean_pairs(spark, sf).select("line_no", "src", "tgt"), "pairs")
    return _translations(pairs).filter("p > 0.0123").withColumn("p", F.round("p", 6))


@query
def lexical_features(spark, sf):
    pairs = stage(views.clean_pairs(spark, sf).select("line_no", "src", "tgt"), "pairs")
    turned = pairs.select("line_no", F.col("tgt").alias("src"), F.col("src").alias("tgt"))
    found = lexical.lexical_features(pairs, _translations(pairs), _translations(turned))
    return found.select("line_no", F.round("lexical_tgt", 6).alias("lexical_tgt"), F.round("lexical_src", 6).alias("lexical_src"))


@query
def classifier_data(spark, sf):
    root = staging_path(spark, "corpora")
    for lang in ("en", "de"):
        lines = views.corpus(spark, sf, lang)
        for name in ("src1", "src2", "src3"):
            sinks.write_lines(lines.filter(F.col("corpus") == name), f"{root}/{name}.{lang}")
    data = classifier_plan.classifier_data(spark, root, ["src3", "src1"], ["src2"], "en", "de", seed=SEED)
    return data.train.withColumn("part", F.lit("train")).unionByName(data.dev.withColumn("part", F.lit("dev")))


@query
def fit_pair_classifier(spark, sf):
    model = classifier(stage(views.clean_pairs(spark, sf), "pairs"), german_words(spark, sf))
    rows = [*model.weights().items(), *((f"dev_{k}", float(v)) for k, v in model.dev.items())]
    return spark.createDataFrame(rows, "name string, value double")


@query
def score_pairs(spark, sf):
    words = german_words(spark, sf)
    # Written once with their features: the classifier learns from them, and all of them are scored.
    pairs = stage(scoring.pair_features(views.clean_pairs(spark, sf), words, "de"), "pairs")
    return scoring.score_pairs(pairs, classifier(pairs, words, featured=True), featured=True).select("line_no", "score")


@query
def score_pairs_formula(spark, sf):
    return scoring.score_pairs(views.clean_pairs(spark, sf), scoring.length_ratio_scorer).select("line_no", "score")


@query
def clean_synthetic(spark, sf):
    cleaned = scoring.clean_synthetic(
        synthetic_parts(views.corpora(spark, sf)).withColumnsRenamed({"l1": "src", "l2": "tgt"}), scoring.length_ratio_scorer, 0.3
    )
    return cleaned.select("line_no", "l1_origin", "l2_origin", "score")


# Pieces of the small vocabularies that SQL learns as well.
SMALL_VOCABULARY = 128


def with_vocabulary(fn):
    """Two queries: with the small vocabulary, and as ``_full`` with the reference's 10,000 pieces."""

    def sized(name, size):
        def run(spark, sf):
            return fn(spark, sf, size)

        run.__name__ = name
        query(run)

    sized(fn.__name__, SMALL_VOCABULARY)
    sized(f"{fn.__name__}_full", subword.DEFAULT_VOCAB_SIZE)
    return fn


def learned_bpe(spark, sf, size):
    """Merges and vocabulary of all lines; their words are those of the documents, which need no numbers for it."""
    return subword.learn_bpe(views.documents(spark, sf), vocab_size=size)


@with_vocabulary
def learn_bpe(spark, sf, size):
    return learned_bpe(spark, sf, size)[1]


@with_vocabulary
def apply_bpe(spark, sf, size):
    merges, _ = learned_bpe(spark, sf, size)
    return subword.apply_bpe(views.lines(spark, sf), merges).select("lang", "line_no", joined("pieces"))


def _outside_model(merges, pieces):
    """A byte-pair model of another library, with learned merges."""

    def load():
        from tokenizers import Tokenizer, models

        tokenizer = Tokenizer(models.BPE({p: i for i, p in enumerate(pieces)}, merges))
        split, known, shared = re.compile(tx.WHITESPACE_RUN).split, {}, {}

        def encode(texts):
            rows = [[w for w in split(t) if w] for t in texts]
            # The model takes word by word, so each word that is not known yet goes to it once.
            if len(known) > subword.CACHE_WORDS:
                known.clear()
            new = list({w for row in rows for w in row if w not in known})
            done = tokenizer.encode([tx.WORD_MARK + w for w in new], is_pretokenized=True)
            tokens, sizes = iter([shared.setdefault(p, p) for p in done.tokens]), Counter(done.word_ids)
            known.update((w, list(islice(tokens, sizes[i]))) for i, w in enumerate(new))
            return [list(chain.from_iterable([known[w] for w in row])) for row in rows]

        return encode

    return load


@with_vocabulary
def encode_pieces_model(spark, sf, size):
    merges, vocab = learned_bpe(spark, sf, size)
    load = _outside_model(merges, [r["piece"] for r in vocab.orderBy("piece_id").collect()])
    return subword.encode_pieces(views.lines(spark, sf), load).select("lang", "line_no", joined("pieces"))


# Longer parts of words in the scored vocabulary; SQL cuts with parts of four characters at most.
SCORED_PARTS, SCORED_LENGTH = 8000, 4


@query
def scored_vocabulary(spark, sf):
    vocab = scored_pieces.scored_vocabulary(views.lines(spark, sf), SCORED_PARTS, SCORED_LENGTH)
    return vocab.withColumn("score", F.round("score", 6))


@query
def encode_scored(spark, sf):
    lines = stage(views.lines(spark, sf).select("lang", "line_no", "text"), "lines")
    # Scores to four places: sums then agree whatever the logarithm's last digit.
    vocab = scored_pieces.scored_vocabulary(lines, SCORED_PARTS, SCORED_LENGTH).withColumn("score", F.round("score", 4))
    # Some characters are left out of the vocabulary, so that lines have unknown ones.
    return scored_pieces.encode_scored(lines, vocab.filter("piece not in ('q', 'ñ')")).select("lang", "line_no", joined("pieces"))


def _reverse_words():
    return lambda texts: [" ".join(reversed(t.split(" "))) for t in texts]


@query
def translate(spark, sf):
    flat = views.turns(spark, sf).select("sent_id", tx.one_line("src").alias("text"))
    return synthesis.translate(flat, _reverse_words).select("sent_id", "hyp")


@query
def translate_batched(spark, sf):
    flat = views.turns(spark, sf).select("sent_id", tx.one_line("src").alias("text"))
    done = synthesis.translate_batched(flat, _reverse_words, F.size(tx.words("text")), lanes=8, key="sent_id")
    return done.select("sent_id", "hyp", "lane", "batch")


@query
def batch_sizes(spark, sf):
    """Lines of documents in batches of 400 tokens, longest line 120: some are over it."""
    lines = views.lines(spark, sf, "en").filter("text <> ''").select("line_no", "text")
    words = F.size(tx.words("text"))
    done = synthesis.translate_batched(lines, _reverse_words, words, max_tokens=400, max_positions=120, lanes=64, key="line_no")
    size = F.greatest(words, F.lit(1))
    return done.groupBy("lane", "batch").agg(
        F.count(F.lit(1)).alias("n_rows"), F.max(size).cast("bigint").alias("longest"), F.sum(size).cast("bigint").alias("n_tokens"),
        F.count("hyp").alias("n_translated"),
    )


def with_words(df):
    return df.withColumn("pieces", tx.words("text"))


@query
def synthesize(spark, sf):
    return synthesis.synthesize(side_lines(spark, sf, "en"), _reverse_words, with_words)


@query
def synthesize_prefix(spark, sf):
    return synthesis.synthesize(side_lines(spark, sf, "en"), _reverse_words, with_words, lines=2000, piece_limit=100)


# --- loops -------------------------------------------------------------------

def _mean_length(direction, stage_name, data, start_model):
    """A stand-in trainer: the metric is the mean length of the source sides it saw."""
    return f"{stage_name}-{direction}", data.agg(F.avg(F.length("src"))).first()[0]


def _shortened_words():
    """A stand-in model: turned around, and of long lines only some of the words."""

    def translate(texts):
        words = [t.split(" ") for t in texts]
        return [" ".join(reversed(w[:max(1, len(w) * (len(w) % 10 + 1) // 10)])) for w in words]

    return translate


@query
def search_threshold(spark, sf):
    scored = stage(
        views.corpora(spark, sf).filter("part <> 'parallel'")
        .select("line_no", "part", F.col("src").alias("l1"), F.col("tgt").alias("l2"),
                scoring.length_ratio_scorer(None).alias("score")), "scored")
    by_direction = {
        "1n": scored.filter("part = 'l1_syn_l2_orig'"), "n1": scored.filter("part = 'l1_orig_l2_syn'"),
    }
    parallel = stage(parallel_part(views.corpora(spark, sf)), "parallel")
    tried, best = experiment.search_threshold(parallel, by_direction, lambda d, t, data: data.count())
    rows = [(d, t, int(m), t == best[d]) for d, t, m in tried]
    return spark.createDataFrame(rows, "direction string, threshold double, n_pairs bigint, best boolean")


@query
def iterate(spark, sf):
    mono = {"l1": stage(side_lines(spark, sf, "en"), "mono"), "l2": stage(side_lines(spark, sf, "de"), "mono")}
    callbacks = experiment.Callbacks(
        train=_mean_length, baseline=lambda direction: 0.0, translator=lambda ref: _shortened_words,
        encode=with_words, scorer=scoring.length_ratio_scorer,
    )
    run = experiment.Refinement(
        spark, "documents", staging_path(spark, "experiment"), stage(parallel_part(views.corpora(spark, sf)), "parallel"),
        mono, callbacks,
    )
    outcome = run.run()
    return outcome.ledger.select("stage", "iteration", "direction", "threshold", "metric")


@with_vocabulary
def prepare_student(spark, sf, size):
    corpora = stage(views.corpora(spark, sf), "corpora")
    pairs = stage(student.student_pairs(parallel_part(corpora), synthetic_parts(corpora), "all", "1n"), "student")
    splits = {"train": pairs.filter("line_no % 10 < 8"), "valid": pairs.filter("line_no % 10 = 8"), "test": pairs.filter("line_no % 10 = 9")}
    data = student.prepare_student(splits, vocab_size=size)
    return reduce(DataFrame.unionByName, [
        rows.select(F.lit(name).alias("split"), "line_no", joined("src_ids"), joined("tgt_ids"))
        for name, rows in data.datasets.items()
    ])


@with_vocabulary
def student_coverage(spark, sf, size):
    corpora = stage(views.corpora(spark, sf), "corpora")
    pairs = stage(student.student_pairs(parallel_part(corpora), synthetic_parts(corpora), "all", "1n"), "student")
    # A training split so small that the others have characters it lacks.
    splits = {"train": pairs.filter("line_no % 50 = 0"), "test": pairs.filter("line_no % 50 > 0")}
    coverage = student.prepare_student(splits, vocab_size=size).coverage
    return coverage.withColumn("oov_rate", F.round("oov_rate", 6))


def _encode_threes(df, col, out):
    return df.withColumn(out, F.regexp_extract_all(col, F.lit("([^ ]{1,3})")))


@query
def report(spark, sf):
    refs = views.turns(spark, sf).select("sent_id", tx.one_line("tgt").alias("ref"))
    # Some sentences are missing from the log, and every third hypothesis lost its first word.
    number = F.try_to_number(F.regexp_extract("line", "^H-([0-9]+)", 1), F.lit("999999999999")).cast("bigint")
    shorter = F.regexp_replace("line", "^(H-[0-9]+\t[^\t]*\t)[^ ]* ", "$1")
    log = views.decoder_log(spark, sf).withColumn("_id", number).filter("_id is null or _id % 10 <> 4").select(
        F.when(F.col("_id") % 3 == 0, shorter).otherwise(F.col("line")).alias("line")
    )
    return student.report(log, refs, _encode_threes).select("metric", F.round("value", 6).alias("value"))
