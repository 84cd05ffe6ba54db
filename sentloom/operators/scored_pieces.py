"""Pieces of a scored vocabulary: of all ways to cut a word, the one with the highest sum of scores.

The pieces stand in a trie. From every place of a word that some cut reaches, the trie
is walked along the word, and each piece met there is an edge of a lattice; the best way
to a place is kept, so a word of n characters takes n steps of at most the longest
piece. A distinct word is cut once in a task.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentloom.functions import text as tx
from sentloom.operators.subword import encode_words, marked_words
from sentloom.sources.staging import stage

# Scores are compared as whole millionths, so sums are exact in any order.
SCALE = 1_000_000
# How much less than the least piece a character counts that no piece has.
UNKNOWN_PENALTY = 10.0
# Pieces that are sent to the tasks, at most.
MOST_PIECES = 1_000_000


def cutter(scores: Mapping[str, float]) -> Callable[[str], list[str]]:
    """The function from a word to its pieces.

    A character without a piece of its own is a piece that counts ``UNKNOWN_PENALTY`` less than the
    least one. Of cuts with equal sums the one with fewer pieces is taken, then the one whose
    last piece is longer, then the last but one, and so on.
    """
    millionths = {piece: round(score * SCALE) for piece, score in scores.items() if piece}
    unknown = min(millionths.values(), default=0) - round(UNKNOWN_PENALTY * SCALE)
    trie: dict = {}
    for piece, score in millionths.items():
        node = trie
        for c in piece:
            node = node.setdefault(c, {})
        node[""] = score

    def cut(word: str) -> list[str]:
        n = len(word)
        # Of each place: the best sum, the pieces up to it (negative) and the length of the last.
        best: list[tuple[int, int, int] | None] = [None] * (n + 1)
        best[0] = (0, 0, 0)
        for start in range(n):
            total, pieces, _ = best[start]
            node, end = trie, start
            alone = word[start] not in trie or "" not in trie[word[start]]
            if alone:
                way = (total + unknown, pieces - 1, 1)
                if best[start + 1] is None or way > best[start + 1]:
                    best[start + 1] = way
            while end < n and (node := node.get(word[end])) is not None:
                end += 1
                score = node.get("")
                if score is not None:
                    way = (total + score, pieces - 1, end - start)
                    if best[end] is None or way > best[end]:
                        best[end] = way
        out, end = [], n
        while end:
            size = best[end][2]
            out.append(word[end - size:end])
            end -= size
        return out[::-1]

    return cut


def piece_scores(vocabulary: DataFrame) -> dict[str, float]:
    """(piece, score) rows as a mapping: the highest score of a piece; NULLs are left out.

    More than ``MOST_PIECES`` rows, or a score that is no finite number, are an error.
    """
    rows = vocabulary.select(F.col("piece").cast("string"), F.col("score").cast("double"))
    rows = rows.filter("piece is not null and score is not null").groupBy("piece").agg(F.max("score").alias("score"))
    found = {r["piece"]: r["score"] for r in rows.limit(MOST_PIECES + 1).collect()}
    if len(found) > MOST_PIECES:
        raise ValueError(f"a vocabulary of more than {MOST_PIECES} pieces")
    if not all(abs(s) < float("inf") for s in found.values()):
        raise ValueError("a score that is no finite number")
    return found


def encode_scored(df: DataFrame, vocabulary: DataFrame, col: str = "text", out: str = "pieces") -> DataFrame:
    """Encode text to the pieces of a vocabulary with scores (piece, score), an array column.

    Words are cut one by one, with the word mark in front. A NULL text has NULL pieces, an
    empty one none. Rows are not shuffled; the vocabulary, at most ``MOST_PIECES`` rows, goes to
    the tasks.
    """
    shared = df.sparkSession.sparkContext.broadcast(piece_scores(vocabulary))
    return df.withColumn(out, encode_words(lambda: cutter(shared.value))(marked_words(col)))


def scored_vocabulary(df: DataFrame, size: int, max_piece: int = 8, col: str = "text") -> DataFrame:
    """A vocabulary from word counts: (piece, n, score).

    All characters, and the ``size`` most frequent longer parts of words (the word mark
    included, up to ``max_piece`` characters; ties to the smaller). The score is the
    logarithm of a piece's share of the occurrences of all pieces.
    """
    words = df.select(F.explode(marked_words(col)).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    places = F.sequence(F.lit(1), F.length("w"))
    parts = F.flatten(F.transform(places, lambda i: F.transform(
        F.sequence(F.lit(1), F.least(F.lit(max_piece), F.length("w") - i + 1)), lambda size: F.substring(F.col("w"), i, size)
    )))
    counts = words.select(F.explode(parts).alias("piece"), "n").groupBy("piece").agg(F.sum("n").alias("n"))
    longer = counts.filter(F.length("piece") > 1).orderBy(F.desc("n"), F.asc("piece")).limit(size)
    # As many rows as the vocabulary has pieces, counted once.
    chosen = stage(counts.filter(F.length("piece") == 1).unionByName(longer), "pieces")
    total = chosen.agg(F.sum("n")).first()[0] or 1
    return chosen.select("piece", "n", F.ln(F.col("n") / F.lit(float(total))).alias("score"))
