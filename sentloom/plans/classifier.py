"""From named corpora to a pair classifier: assemble, clean, cap, list words, train against development pairs."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentloom.operators.cleaning import drop_empty_pairs
from sentloom.operators.lexical import translation_probabilities
from sentloom.operators.sampling import cap_pairs
from sentloom.operators.scoring import PairClassifier, fit_pair_classifier
from sentloom.operators.stats import word_frequencies
from sentloom.sources.corpus import corpus_paths, read_corpora, read_parallel
from sentloom.sources.staging import stage

# Pairs the classifier is trained on at most (the documented bound of its sample).
MAX_PAIRS = 600_000


@dataclass(frozen=True)
class ClassifierData:
    """Capped training pairs, development pairs, and the word list of the target language."""

    train: DataFrame
    dev: DataFrame
    wordfreq: DataFrame


def classifier_data(
    spark: SparkSession, root: str, train: Sequence[str], dev: Sequence[str], src_lang: str, tgt_lang: str,
    max_pairs: int = MAX_PAIRS, seed: int = 1, words: Sequence[str] = (),
) -> ClassifierData:
    """Read the named corpora under ``root`` in the order given and prepare them.

    Pairs with an empty side go, in the development corpora too. The word list counts the
    monolingual corpora ``words`` of the target language; without any, the target side of
    all training pairs, also of those above the cap.
    """

    def pairs(names: Sequence[str]) -> DataFrame:
        sides = (corpus_paths(spark, root, names, lang) for lang in (src_lang, tgt_lang))
        clean = drop_empty_pairs(read_parallel(spark, *sides, "+".join(names), src_lang, tgt_lang))
        return stage(clean.select("line_no", "src", "tgt"), "classifier-pairs")

    everything = pairs(train)
    listed = read_corpora(spark, root, words, tgt_lang).select("text") if words else everything.select(F.col("tgt").alias("text"))
    wordfreq = stage(word_frequencies(listed, tgt_lang), "wordfreq")
    return ClassifierData(cap_pairs(everything, max_pairs, seed), pairs(dev), wordfreq)


def train_classifier(
    data: ClassifierData, tgt_lang: str, seed: int = 1, lexical_rounds: int = 0, replaced: float | None = None
) -> PairClassifier:
    """The classifier of :func:`~sentloom.operators.scoring.fit_pair_classifier` on prepared corpora.

    With ``lexical_rounds``, word translation tables of both directions are learned from the
    training pairs in so many rounds, and give two more features. With ``replaced``, pairs
    with so large a share of the target's words replaced are negatives as well.
    """
    lexical = None
    if lexical_rounds:
        turned = data.train.select("line_no", F.col("tgt").alias("src"), F.col("src").alias("tgt"))
        lexical = tuple(translation_probabilities(pairs, lexical_rounds) for pairs in (data.train, turned))
    return fit_pair_classifier(data.train, data.dev, data.wordfreq, tgt_lang, seed, replaced=replaced, lexical=lexical)
