import math
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sentloom.functions import ngrams
from sentloom.operators import metrics


def frame(spark, rows):
    return spark.createDataFrame(rows, "hyp string, ref string")


def bleu(spark, rows, **kw):
    return metrics.corpus_bleu(frame(spark, rows), **kw).first().bleu


def plain_bleu(rows):
    """The definition, for texts without punctuation."""
    match, total, zeros, hyp_len, ref_len = [0] * 4, [0] * 4, 0, 0, 0
    for hyp, ref in rows:
        h, r = hyp.split(), ref.split()
        hyp_len, ref_len = hyp_len + len(h), ref_len + len(r)
        for n in range(1, 5):
            hg = Counter(tuple(h[i:i + n]) for i in range(len(h) - n + 1))
            rg = Counter(tuple(r[i:i + n]) for i in range(len(r) - n + 1))
            match[n - 1] += sum((hg & rg).values())
            total[n - 1] += sum(hg.values())
    if not any(match) or not all(total):
        return 0.0
    logs = 0.0
    for m, t in zip(match, total):
        if m == 0:
            zeros += 1
            m = 1 / 2 ** zeros
        logs += math.log(m / t)
    bp = 1.0 if hyp_len >= ref_len else math.exp(1 - ref_len / hyp_len)
    return 100 * bp * math.exp(logs / 4)


CASES = [
    [("the cat sat on the mat", "the cat sat on the mat")],
    [("the the the the the the the", "the cat is on the mat")],
    [("a b c d e f", "a b x d e f"), ("q r s t", "q r s t u v")],
    [("a b c", "a b c d e")],
    [("", "a b c d")],
    [("w x y z", "a b c d")],
    [("a b a b a b a b", "b a b a b a"), ("", "")],
]


@pytest.mark.parametrize("rows", CASES)
def test_bleu_is_its_definition(spark, rows):
    assert bleu(spark, rows) == pytest.approx(plain_bleu(rows), abs=1e-9)


def test_bleu_of_itself_is_100_and_13a_splits(spark):
    assert bleu(spark, [("It's 1,000.50 (sic) &quot;ok&quot; - yes.", "It's 1,000.50 (sic) \"ok\" - yes.")]) == pytest.approx(100)
    # Without splitting the final period there are only three tokens and no 4-gram.
    assert bleu(spark, [("one two three.", "one two three.")]) == pytest.approx(100)
    assert bleu(spark, [("one two three.", "one two three.")], tokenize="none") == 0.0


def test_bleu_by_group(spark):
    df = spark.createDataFrame([("a b c d", "a b c d", 1), ("a b c d", "e f g h", 2)], "hyp string, ref string, part int")
    assert {r.part: r.bleu for r in metrics.corpus_bleu(df, by=["part"]).collect()} == {1: pytest.approx(100), 2: 0.0}


def plain_chrf(rows, order=6, beta=2):
    stats = [[0, 0, 0] for _ in range(order)]
    for hyp, ref in rows:
        h, r = "".join(hyp.split()), "".join(ref.split())
        for n in range(1, order + 1):
            hg = Counter(h[i:i + n] for i in range(len(h) - n + 1))
            rg = Counter(r[i:i + n] for i in range(len(r) - n + 1))
            stats[n - 1][0] += sum(hg.values()) if rg else 0
            stats[n - 1][1] += sum(rg.values())
            stats[n - 1][2] += sum((hg & rg).values())
    used = [(m / h, m / r) for h, r, m in stats if h and r]
    if not used:
        return 0.0
    p, q = (sum(x) / len(used) for x in zip(*used))
    return 100 * (1 + beta ** 2) * p * q / (beta ** 2 * p + q) if p + q else 0.0


@pytest.mark.parametrize("rows", CASES + [[("ä ö ü, ß!", "ä o ü ß")], [("abc", "xyz")]])
def test_chrf_is_its_definition(spark, rows):
    got = metrics.corpus_chrf(frame(spark, rows)).first().chrf
    assert got == pytest.approx(plain_chrf(rows), abs=1e-9)


def test_chrf_plus_plus_differs_by_words(spark):
    rows = frame(spark, [("cat the sat.", "the cat sat.")])
    plain, words = metrics.corpus_chrf(rows).first().chrf, metrics.corpus_chrf(rows, word_order=2).first().chrf
    assert words != plain
    same = frame(spark, [("(the) cat sat.", "(the) cat sat.")])
    assert metrics.corpus_chrf(same, word_order=2).first().chrf == pytest.approx(100)


def test_evaluate_reports_three_metrics(spark):
    df = spark.createDataFrame(
        [("a b c d e", "a b c d e", ["a", "b", "c", "d"], ["a", "b", "c", "d"])],
        "hyp string, ref string, hyp_pieces array<string>, ref_pieces array<string>",
    )
    got = {r.metric: r.value for r in metrics.evaluate(df).collect()}
    assert set(got) == {"BLEU", "chrF", "spBLEU"}
    assert all(v == pytest.approx(100) for v in got.values())


def test_empty_input(spark):
    assert metrics.corpus_bleu(frame(spark, [])).first().bleu == 0.0
    assert metrics.corpus_chrf(frame(spark, [])).first().chrf == 0.0


TOKENS = st.lists(st.lists(st.sampled_from(["a", "b", "c", "", "aa"]), max_size=9), min_size=1, max_size=6)
TEXTS = st.lists(st.text("abé🙂", max_size=12), min_size=1, max_size=6)


@settings(max_examples=150, deadline=None)
@given(hyps=st.one_of(TOKENS, TEXTS), seed=st.integers(0, 5), top=st.integers(1, 6))
def test_matches_of_all_rows_at_once_equal_those_of_each(hyps, seed, top):
    refs = hyps[seed % len(hyps):] + hyps[:seed % len(hyps)]
    got = ngrams.count_matches(hyps, refs, top)
    for row, (h, r) in enumerate(zip(hyps, refs)):
        for n in range(1, top + 1):
            hg, rg = (Counter(tuple(s[i:i + n]) for i in range(len(s) - n + 1)) for s in (h, r))
            assert got[row, n - 1] == sum((hg & rg).values())


def test_parts_of_a_batch(spark, monkeypatch):
    rows = [(f"a b c {i}", f"a b {i} c") for i in range(40)] + [(None, "x"), ("", "")]
    whole = metrics.corpus_bleu(frame(spark, rows)).first()
    monkeypatch.setattr(ngrams, "PART_UNITS", 7)
    assert metrics.corpus_bleu(frame(spark, rows)).first() == whole
