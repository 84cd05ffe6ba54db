"""Pieces of a scored vocabulary against all ways to cut a word."""

import math
import random
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sentloom.operators import cleaning, scored_pieces
from sentloom.operators.scored_pieces import SCALE, UNKNOWN_PENALTY, cutter


def all_cuts(word):
    if not word:
        yield []
    for size in range(1, len(word) + 1):
        for rest in all_cuts(word[size:]):
            yield [word[:size], *rest]


def brute(word, scores):
    """The best of all cuts: highest sum, fewest pieces, then the longer last pieces."""
    whole = {p: round(s * SCALE) for p, s in scores.items() if p}
    unknown = min(whole.values(), default=0) - round(UNKNOWN_PENALTY * SCALE)
    value = lambda p: whole.get(p, unknown if len(p) == 1 else None)
    cuts = [c for c in all_cuts(word) if all(value(p) is not None for p in c)]
    return max(cuts, key=lambda c: (sum(map(value, c)), -len(c), [len(p) for p in c[::-1]]))


@settings(max_examples=400, deadline=None)
@given(
    word=st.text("abcü", max_size=9),
    scores=st.dictionaries(st.text("abc", min_size=1, max_size=4), st.sampled_from([-1.0, -2.0, -3.0, -0.5, -4.5]), max_size=12),
)
def test_the_best_of_all_cuts(word, scores):
    assert cutter(scores)(word) == brute(word, scores)


def test_unknown_characters_and_an_empty_vocabulary():
    assert cutter({"a": -1.0, "aa": -1.5, "": -1.0})("aaxa\U0001f600") == ["aa", "x", "a", "\U0001f600"]
    assert cutter({})("ab") == ["a", "b"] and cutter({"a": -1.0})("") == []


def test_a_million_characters_take_seconds():
    rng = random.Random(1)
    scores = {"".join(rng.choices("abcd", k=rng.randrange(1, 9))): -rng.random() * 9 for _ in range(5000)} | dict.fromkeys("abcd", -9.0)
    word, start = "".join(rng.choices("abcd", k=1_000_000)), time.monotonic()
    assert "".join(cutter(scores)(word)) == word and time.monotonic() - start < 90


def test_rows(spark):
    vocab = spark.createDataFrame([("▁a", -1.0), ("b", -2.0), ("b", -5.0), ("▁", -4.0), ("a", -3.0), (None, 1.0), ("x", None)], "piece string, score double")
    df = spark.createDataFrame([(1, "ab  ba"), (2, ""), (3, None), (4, "a\tq")], "id int, text string")
    got = {r.id: r.pieces for r in scored_pieces.encode_scored(df, vocab).collect()}
    assert got == {1: ["▁a", "b", "▁", "b", "a"], 2: [], 3: None, 4: ["▁a", "▁", "q"]}
    back = cleaning.decode_pieces(scored_pieces.encode_scored(df.filter("id = 4").withColumnRenamed("text", "raw"), vocab, "raw"))
    assert back.first().text == "a q"
    with pytest.raises(ValueError, match="finite"):
        scored_pieces.piece_scores(spark.createDataFrame([("a", float("nan"))], "piece string, score double"))


def test_vocabulary_from_counts(spark):
    df = spark.createDataFrame([("ab ab b",), (None,)], "text string")
    got = {r.piece: (r.n, r.score) for r in scored_pieces.scored_vocabulary(df, 3, 3).collect()}
    # Of the longer parts, the most frequent; of equals the smaller.
    assert {p: n for p, (n, _) in got.items()} == {"▁": 3, "a": 2, "b": 3, "ab": 2, "▁a": 2, "▁ab": 2}
    assert all(math.isclose(s, math.log(n / 14)) for n, s in got.values())
