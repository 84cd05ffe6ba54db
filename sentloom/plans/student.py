"""Data of a student model: mixture, subword vocabulary, encoded dataset, report."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentloom.operators.cleaning import drop_empty_pairs, parse_hypotheses
from sentloom.operators.metrics import evaluate
from sentloom.operators.mixtures import joint_text, mixture
from sentloom.operators.stats import vocab_coverage
from sentloom.operators.subword import DEFAULT_VOCAB_SIZE, apply_bpe, learn_bpe
from sentloom.operators.vocabulary import ids_from_vocab, joined_dictionary, vocabulary_lookup
from sentloom.sources.staging import stage


@dataclass(frozen=True)
class StudentData:
    """Merges, vocabulary and dictionary learned from ``train``; the datasets and coverage of every split."""

    merges: list[tuple[str, str]]
    vocabulary: DataFrame
    dictionary: DataFrame
    datasets: dict[str, DataFrame]
    coverage: DataFrame


def student_pairs(parallel: DataFrame, synthetic: DataFrame, flavour: str, direction: str) -> DataFrame:
    """Training pairs of a student as (line_no, src, tgt), empty sides dropped per pair before any encoding."""
    src, tgt = ("l1", "l2") if direction == "1n" else ("l2", "l1")
    mixed = mixture(parallel, synthetic, flavour, direction)
    return drop_empty_pairs(mixed.select("line_no", F.col(src).alias("src"), F.col(tgt).alias("tgt")))


def encode_pairs(pairs: DataFrame, merges: list[tuple[str, str]]) -> DataFrame:
    """Pairs with the pieces of both sides."""
    return apply_bpe(pairs, merges, ["src", "tgt"], ["src_pieces", "tgt_pieces"])


def prepare_student(splits: Mapping[str, DataFrame], vocab_size: int = DEFAULT_VOCAB_SIZE) -> StudentData:
    """Learn one vocabulary over both sides of ``train``, and encode every split with it.

    ``splits`` maps ``train`` and any others (``valid``, ``test``) to (line_no, src, tgt).
    The merges and the dictionary come from ``train`` alone and are stored once; pieces
    of other splits that it does not know become the unknown id. A dataset adds src_ids
    and tgt_ids and is what a trainer reads (as Parquet); ``coverage`` has the pieces of
    each split and side and how many of them are unknown.
    """
    merges, vocabulary = learn_bpe(joint_text(splits["train"]), vocab_size)
    encoded = {name: stage(encode_pairs(pairs, merges), f"student-{name}") for name, pairs in splits.items()}
    dictionary = stage(joined_dictionary(encoded["train"]), "dictionary")
    known = vocabulary_lookup(dictionary)
    datasets, sides = {}, []
    for name, rows in encoded.items():
        ids = ids_from_vocab(rows, known, "src_pieces", "src_ids")
        ids = ids_from_vocab(ids, known, "tgt_pieces", "tgt_ids")
        datasets[name] = ids.select("line_no", "src_ids", "tgt_ids")
        sides += [
            rows.select(F.lit(name).alias("split"), F.lit(side).alias("side"), F.col(f"{side}_pieces").alias("tokens"))
            for side in ("src", "tgt")
        ]
    coverage = vocab_coverage(reduce(DataFrame.unionByName, sides), dictionary, by=["split", "side"])
    return StudentData(merges, vocabulary, dictionary, datasets, coverage)


def report(log: DataFrame, refs: DataFrame, encode: Callable[[DataFrame, str, str], DataFrame]) -> DataFrame:
    """BLEU, chrF and subword BLEU of a decoder log (line) against references (sent_id, ref).

    All references count: one without a hypothesis, or with a malformed id in the log,
    has an empty one, and the row ``missing`` says how many there are. ``encode(df, col,
    out)`` adds the pieces of a column, for example by :func:`apply_bpe`.
    """
    hyps = parse_hypotheses(log, field="third").select("sent_id", F.col("text").alias("hyp"))
    rows = stage(refs.join(hyps, "sent_id", "left"), "report")
    missing = rows.agg(F.lit("missing").alias("metric"), F.sum(F.col("hyp").isNull().cast("int")).cast("double").alias("value"))
    scored = encode(encode(rows.fillna("", ["hyp"]), "hyp", "hyp_pieces"), "ref", "ref_pieces")
    return evaluate(scored).select("metric", "value").unionByName(missing)
