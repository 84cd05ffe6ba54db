"""Pair features, negative examples, a classifier on Spark ML, scores and cleaning."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from sentloom.functions import text as tx
from sentloom.functions.hashing import sample_key
from sentloom.operators.cleaning import filter_by_score
from sentloom.operators.lexical import LEXICAL, lexical_features
from sentloom.operators.lookup import MAX_BROADCAST_ROWS, Lookup, broadcast_checked, lookup_array, prepare_lookup
from sentloom.operators.numbering import number_rows
from sentloom.operators.tokenization import tokens_of_words
from sentloom.sources.staging import stage

FEATURES = [
    "length_ratio", "src_tokens", "tgt_tokens", "copied_share",
    "punct_agreement", "digit_agreement", "tgt_log_freq",
]
# Fixed value: marks compared between the sides.
PUNCTUATION = "[.,;:!?()]"
# Leading hex digits that place a row in a shuffle block (16 ** 4 blocks).
BLOCK_DIGITS = 4


def _overlap(a: Column, b: Column) -> Column:
    """Shared over all distinct elements of two arrays; 1 where both are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / union)


def _agreement(a: Column, b: Column) -> Column:
    """Smaller over larger count; 1 where both are 0."""
    return F.when(F.greatest(a, b) == 0, F.lit(1.0)).otherwise(F.least(a, b) / F.greatest(a, b))


def word_lookup(wordfreq: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> Lookup:
    """A frequency list (word, count), prepared once for any number of frames whose features need it."""
    return prepare_lookup(wordfreq.select(F.col("word").alias("key"), F.col("count").alias("value")), "bigint", max_rows)


def _words(df: DataFrame) -> DataFrame:
    """Add the lowercased words of both sides, ``_s`` and ``_t``."""
    return df.withColumns({"_s": tx.words(F.lower("src")), "_t": tx.words(F.lower("tgt"))})


def _text_columns() -> dict[str, Column]:
    digits = F.lit(r"(\d+)")
    return {
        "length_ratio": tx.length_ratio("src", "tgt"),
        "src_tokens": F.size("_s"),
        "tgt_tokens": F.size("_t"),
        "copied_share": F.coalesce(
            F.try_divide(F.size(F.array_intersect("_s", "_t")), F.size(F.array_distinct("_s"))), F.lit(0.0)
        ),
        "punct_agreement": _agreement(
            F.regexp_count("src", F.lit(PUNCTUATION)), F.regexp_count("tgt", F.lit(PUNCTUATION))
        ),
        "digit_agreement": _overlap(F.regexp_extract_all("src", digits), F.regexp_extract_all("tgt", digits)),
    }


def text_features(df: DataFrame) -> DataFrame:
    """Add the feature columns that need the texts of a pair (src, tgt) only: all but ``tgt_log_freq``."""
    return _words(df).withColumns(_text_columns()).drop("_s", "_t")


def pair_features(
    df: DataFrame, wordfreq: DataFrame | Lookup, tgt_lang: str, max_rows: int = MAX_BROADCAST_ROWS
) -> DataFrame:
    """Add the feature columns of a pair (src, tgt).

    ``wordfreq`` (word, count) is the frequency list of the target language, made by
    :func:`~sentloom.operators.stats.word_frequencies`, or what :func:`word_lookup` made of it; the
    target is cut into words by the tokeniser that made the list, and words outside it count as 1.
    Token counts and copied words are those of the whitespace-separated strings.
    """
    known = wordfreq if isinstance(wordfreq, Lookup) else word_lookup(wordfreq, max_rows)
    rows = _words(df).withColumns({**_text_columns(), "_w": tokens_of_words("_t", tgt_lang)}).drop("_s", "_t")
    rows = lookup_array(rows, "_w", "_n", known, 1, "bigint")
    log_sum = F.aggregate("_n", F.lit(0.0), lambda acc, n: acc + F.log(n.cast("double")))
    return rows.withColumn("tgt_log_freq", F.coalesce(F.try_divide(log_sum, F.size("_n")), F.lit(0.0))).drop("_w", "_n")


def make_negatives(
    df: DataFrame, seed: int = 1, block_digits: int = BLOCK_DIGITS, of_target: Sequence[str] = ()
) -> DataFrame:
    """Negative examples: every source with the target of another row.

    Rows stand in the order of their seeded key, and each takes the target of the
    next one (the last takes the first). Within a block of keys the next row comes
    from a window; the row after a block is the first of the next block, from a table
    of one row per block. Only ids are put in order; the texts are joined to them
    afterwards, by number. A row whose own target has the same text gives none, nor does a
    single row. Columns ``of_target`` go along with the target.
    """
    keyed = df.select("line_no", sample_key("line_no", seed).alias("_key")).withColumn(
        "_block", F.substring("_key", 1, block_digits)
    )
    in_block = W.partitionBy("_block").orderBy("_key")
    # One id per block: at most 16 ** block_digits.
    firsts = keyed.groupBy("_block").agg(F.min_by("line_no", "_key").alias("_first"))
    ring = W.orderBy("_block").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    following = firsts.select(
        "_block",
        F.coalesce(F.lead("_first").over(W.orderBy("_block")), F.first("_first").over(ring)).alias("_after"),
    )
    ids = (
        keyed.withColumn("_next", F.lead("line_no").over(in_block))
        .join(broadcast_checked(following, "blocks"), "_block")
        .select("line_no", F.coalesce("_next", "_after").alias("tgt_line_no"))
        .filter("tgt_line_no <> line_no")
    )
    sources = df.select("line_no", "src", F.xxhash64("tgt").alias("_own"))
    targets = df.select(F.col("line_no").alias("tgt_line_no"), "tgt", *of_target)
    return (
        ids.join(sources, "line_no").join(targets, "tgt_line_no")
        .filter(F.col("_own") != F.xxhash64("tgt")).select("line_no", "src", "tgt", "tgt_line_no", *of_target)
    )


def word_bands(words: DataFrame) -> DataFrame:
    """Words (word, count) by frequency: (word, rank, first, size), the band of each by its rank from 0.

    Bands double in size: ranks 0 and 1, 2 to 5, 6 to 13 and so on; a last band of one word
    belongs to the one before.
    """
    ranked = number_rows(words.select("word", "count"), [F.desc("count"), F.asc("word")], name="rank", start=0)
    last = ranked.agg(F.max("rank")).first()[0] or 0
    # The first rank of the n-th band is 2 ** n - 2.
    starts = [(1 << n) - 2 for n in range(1, 64) if (1 << n) - 2 <= last]
    if len(starts) > 1 and starts[-1] == last:
        starts.pop()
    first = reduce(lambda acc, start: F.when(F.col("rank") >= start, F.lit(start)).otherwise(acc), starts, F.lit(0)).cast("bigint")
    following = dict(zip(starts, [*starts[1:], last + 1]))
    size = reduce(lambda acc, start: F.when(F.col("first") == start, F.lit(following[start] - start)).otherwise(acc), starts, F.lit(1)).cast("bigint")
    return ranked.select("word", "rank", first.alias("first")).withColumn("size", size)


def replace_words(df: DataFrame, words: DataFrame, share: float = 0.5, seed: int = 1) -> DataFrame:
    """Negative examples that differ in some words: (line_no, src, tgt, n_replaced).

    Of the n whitespace-separated words of a target, those with the smallest seeded keys
    of (line_no, place) are replaced, ``share`` times n rounded up. Each becomes another word of
    about its frequency: one of its band in :func:`word_bands` of ``words`` (word, count), also drawn by
    key. A word that is not listed is treated as the rarest one. With a single listed
    word, that is what all become. Pairs without target words give none. ``line_no`` is unique.
    """
    bands = stage(word_bands(words), "word-bands")
    rarest = bands.orderBy(F.desc("rank")).first()
    if rarest is None:
        raise ValueError("no words to replace others by")
    cut = stage(df.select("line_no", "src", tx.words("tgt").alias("_w")).filter(F.size("_w") > 0), "word-places")
    keyed = F.transform("_w", lambda w, i: F.struct(
        sample_key(F.concat_ws(":", F.col("line_no").cast("string"), i.cast("string")), seed).alias("key"), i.alias("pos"), w.alias("word")
    ))
    chosen = F.slice(F.array_sort(keyed), 1, F.greatest(F.lit(1), F.ceil(F.size("_w") * F.lit(share))).cast("int"))
    places = cut.select("line_no", F.inline(chosen))
    own = broadcast_checked(bands.withColumnRenamed("word", "_word"), "bands")
    ranked = places.join(own, F.col("word") == F.col("_word"), "left").select(
        "line_no", "pos", "key", *[F.coalesce(c, F.lit(rarest[c])).alias(c) for c in ("rank", "first", "size")]
    )
    draw = F.conv(F.substring("key", 9, 8), 16, 10).cast("bigint")
    turn = F.when(F.col("size") > 1, F.lit(1) + draw % F.greatest(F.col("size") - 1, F.lit(1))).otherwise(F.lit(0))
    target = F.col("first") + (F.col("rank") - F.col("first") + turn) % F.col("size")
    by_rank = broadcast_checked(bands.select(F.col("rank").alias("_target"), F.col("word").alias("_new")), "bands")
    news = ranked.withColumn("_target", target).join(by_rank, "_target").groupBy("line_no").agg(
        F.map_from_entries(F.collect_list(F.struct("pos", "_new"))).alias("_news"), F.count(F.lit(1)).alias("n_replaced")
    )
    changed = F.transform("_w", lambda w, i: F.coalesce(F.try_element_at("_news", i), w))
    return cut.join(news, "line_no").select("line_no", "src", F.array_join(changed, " ").alias("tgt"), "n_replaced")


def pair_examples(
    df: DataFrame, wordfreq: DataFrame | Lookup, tgt_lang: str, seed: int = 1, replaced: float | None = None,
    lexical: tuple[DataFrame, DataFrame] | None = None, featured: bool = False,
) -> DataFrame:
    """What the classifier sees: features and label (1.0 for the pairs, 0.0 for negatives made of them).

    With ``replaced``, every pair also gives a negative in which that share of the target's
    words is replaced. With ``lexical``, word translation tables of both directions, the
    features of :func:`~sentloom.operators.lexical.lexical_features` are added. Ids stay
    unique over all kinds: 4 * line_no for pairs, one and two more for negatives with
    ``replaced``, else even for pairs and odd for negatives. With ``featured``, the pairs
    already have the columns of :func:`pair_features`. What the words of a target give is found
    once, and goes along with the target into the negative that takes it.
    """
    kinds = 2 if replaced is None else 4
    columns = ["line_no", "src", "tgt", *FEATURES]
    if not featured:
        df = stage(pair_features(df.select("line_no", "src", "tgt"), wordfreq, tgt_lang), "pair-features")
    moved = text_features(make_negatives(df, seed, of_target=["tgt_log_freq"]))
    parts = [df.select(*columns).withColumn("label", F.lit(1.0)), moved.select(*columns).withColumn("label", F.lit(0.0))]
    if replaced is not None:
        changed = pair_features(replace_words(df, target_words(df), replaced, seed), wordfreq, tgt_lang)
        parts.append(changed.select(*columns).withColumn("label", F.lit(0.0)))
    examples = reduce(DataFrame.unionByName, [part.withColumn("line_no", F.col("line_no") * kinds + i) for i, part in enumerate(parts)])
    if lexical is None:
        return examples.select("line_no", *FEATURES, "label")
    return lexical_features(stage(examples, "examples"), *lexical).select("line_no", *FEATURES, *LEXICAL, "label")


def target_words(df: DataFrame) -> DataFrame:
    """Whitespace-separated words of the targets with their counts: (word, count)."""
    return df.select(F.explode(tx.words("tgt")).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("count"))


@dataclass(frozen=True)
class PairClassifier:
    """A fitted model, the language and word list its features need, and its figures on the development pairs."""

    model: PipelineModel
    wordfreq: DataFrame
    tgt_lang: str
    dev: dict[str, float]
    # Word translation tables of both directions, if its features include the lexical ones.
    lexical: tuple[DataFrame, DataFrame] | None = None

    def features(self) -> list[str]:
        return FEATURES if self.lexical is None else [*FEATURES, *LEXICAL]

    def weights(self) -> dict[str, float]:
        last = self.model.stages[-1]
        return {**dict(zip(self.features(), map(float, last.coefficients))), "intercept": float(last.intercept)}


def fit_pair_classifier(
    train: DataFrame, dev: DataFrame, wordfreq: DataFrame, tgt_lang: str,
    seed: int = 1, max_iter: int = 50, regs: Sequence[float] = (0.001, 0.01, 0.1),
    replaced: float | None = None, lexical: tuple[DataFrame, DataFrame] | None = None, featured: bool = False,
) -> PairClassifier:
    """Train a classifier that tells translations from shuffled pairs.

    ``train`` and ``dev`` hold (capped, non-empty) pairs; as many negative pairs are
    made from each. Logistic regression on the features of :func:`pair_features`, with
    the regularisation that ranks the development pairs best (the first of equals).
    ``replaced``, ``lexical`` and ``featured`` are those of :func:`pair_examples`.
    """
    known = wordfreq if featured and replaced is None else word_lookup(wordfreq)
    # Written once: the optimizer of the classifier passes over it many times.
    features, held = (
        stage(pair_examples(df, known, tgt_lang, seed, replaced, lexical, featured), "features") for df in (train, dev)
    )
    names = FEATURES if lexical is None else [*FEATURES, *LEXICAL]
    rank = BinaryClassificationEvaluator(metricName="areaUnderROC")
    best = None
    for reg in regs:
        pipeline = Pipeline(stages=[
            VectorAssembler(inputCols=names, outputCol="features"),
            LogisticRegression(maxIter=max_iter, regParam=reg),
        ])
        model = pipeline.fit(features)
        judged = model.transform(held)
        right = judged.agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]
        figures = {"auc": rank.evaluate(judged), "accuracy": float("nan") if right is None else right, "reg": reg}
        if best is None or figures["auc"] > best[1]["auc"]:
            best = model, figures
    return PairClassifier(best[0], wordfreq, tgt_lang, best[1], lexical)


def score_pairs(df: DataFrame, model: PairClassifier | Callable[[DataFrame], Column], featured: bool = False) -> DataFrame:
    """Append a score in [0, 1]: the probability of a fitted classifier, or any column of a function.

    With ``featured``, the pairs already have the columns of :func:`pair_features`, found with the
    classifier's word list.
    """
    if not isinstance(model, PairClassifier):
        return df.withColumn("score", model(df))
    rows = df if featured else pair_features(df, model.wordfreq, model.tgt_lang)
    scored = model.model.transform(rows if model.lexical is None else lexical_features(rows, *model.lexical))
    return scored.withColumn("score", vector_to_array("probability")[1]).select(*df.columns, "score")


def length_ratio_scorer(df: DataFrame) -> Column:
    """A scorer without training: the length ratio of the sides, to four places."""
    return F.round(tx.length_ratio("src", "tgt"), 4)


def clean_synthetic(
    df: DataFrame,
    model: PairClassifier | Callable[[DataFrame], Column],
    threshold: float,
) -> DataFrame:
    """Score synthetic pairs and keep those above the threshold; origin columns stay."""
    return filter_by_score(score_pairs(df, model), threshold)
