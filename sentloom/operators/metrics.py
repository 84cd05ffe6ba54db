"""Corpus metrics: BLEU, chrF and BLEU over subword pieces.

Every metric is a sum of a few integers per row followed by one scalar formula, so a
report is one pass: the n-grams are counted within the row (never shuffled), the sums
are partial aggregates, and the formula runs on one row per report.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentloom.functions import ngrams
from sentloom.functions import text as tx
from sentloom.functions.ngrams import match_counts

BLEU_ORDER = 4


class _Metric:
    """A row's counts (array columns), the integers to sum over them, the formula over the sums."""

    def __init__(self, name: str, counts: dict[str, Column], sums: dict[str, str], value: Column):
        self.name, self.counts, self.sums, self.value = name, counts, sums, value


def _total(length: str, n: int) -> str:
    return f"greatest({length} - {n - 1}, 0)"


def _bleu(name: str, hyp: str, ref: str, tokenize: str) -> _Metric:
    if tokenize not in ("13a", "pieces", "none"):
        raise ValueError(f"unknown tokenisation {tokenize!r}")
    sides = [tx.spaced_13a(c) if tokenize == "13a" else F.col(c) for c in (hyp, ref)]
    c, orders = f"_{name}", range(1, BLEU_ORDER + 1)
    sums = {f"{c}_hyp_len": f"{c}[0]", f"{c}_ref_len": f"{c}[1]"}
    for n in orders:
        sums[f"{c}_m{n}"] = f"{c}[{n + 1}]"
        sums[f"{c}_t{n}"] = _total(f"{c}[0]", n)
    return _Metric(name, {c: match_counts(*sides, BLEU_ORDER, ngrams.tokens)}, sums, bleu_score(
        [f"{c}_m{n}" for n in orders], [f"{c}_t{n}" for n in orders], f"{c}_hyp_len", f"{c}_ref_len"
    ))


def _chrf(name: str, hyp: str, ref: str, char_order: int, word_order: int, beta: float) -> _Metric:
    counts, sums, orders = {}, {}, []
    for kind, top, units in (("c", char_order, ngrams.chars), ("w", word_order, ngrams.chrf_words)):
        if top == 0:
            continue
        c = f"_{name}_{kind}"
        counts[c] = match_counts(hyp, ref, top, units)
        for n in range(1, top + 1):
            key = f"{c}{n}"
            orders.append(key)
            sums[f"{key}_m"] = f"{c}[{n + 1}]"
            # A segment whose reference is too short for the order does not count.
            sums[f"{key}_h"] = f"if({c}[1] >= {n}, {_total(f'{c}[0]', n)}, 0)"
            sums[f"{key}_r"] = _total(f"{c}[1]", n)
    return _Metric(name, counts, sums, chrf_score(orders, beta))


def bleu_score(matches: list[str], totals: list[str], hyp_len: str, ref_len: str) -> Column:
    """BLEU of summed counts, exponential smoothing: the k-th order without a match counts as 1 / 2^k.

    An order without any n-gram, or no match at all, gives 0.
    """
    logs = []
    for i, (m, t) in enumerate(zip(matches, totals)):
        zeros = " + ".join(f"int({x} = 0)" for x in matches[: i + 1])
        logs.append(f"ln(if({m} > 0, double({m}), pow(0.5D, {zeros})) / {t})")
    score = f"exp(({' + '.join(logs)}) / {len(matches)})"
    penalty = f"if({hyp_len} >= {ref_len}, 1D, exp(1D - {ref_len} / {hyp_len}))"
    return F.expr(
        f"CASE WHEN greatest({', '.join(matches)}) > 0 AND least({', '.join(totals)}) > 0 "
        f"THEN 100D * {penalty} * {score} ELSE 0D END"
    )


def chrf_score(orders: list[str], beta: float) -> Column:
    """F-score of precision and recall, averaged over the orders that both sides have.

    ``orders`` are prefixes of the summed columns ``_m`` (matches), ``_h`` and ``_r`` (n-grams).
    """
    def average(side: str) -> str:
        terms = [f"if({k}_h > 0 AND {k}_r > 0, {k}_m / {k}_{side}, 0D)" for k in orders]
        present = [f"int({k}_h > 0 AND {k}_r > 0)" for k in orders]
        return f"try_divide({' + '.join(terms)}, {' + '.join(present)})"

    factor = float(beta) ** 2
    return F.expr(
        f"transform(array(struct({average('h')} AS p, {average('r')} AS q)), "
        f"x -> coalesce(100D * try_divide({1 + factor}D * x.p * x.q, {factor}D * x.p + x.q), 0D))[0]"
    )


def _report(df: DataFrame, metrics: list[_Metric], by: list[str]) -> DataFrame:
    counts, sums = {}, {}
    for m in metrics:
        counts.update(m.counts)
        sums.update(m.sums)
    rows = df.select(*by, *[c.alias(k) for k, c in counts.items()])
    totals = [F.expr(f"coalesce(sum({expr}), 0) AS {k}") for k, expr in sums.items()]
    report = rows.groupBy(*by).agg(*totals) if by else rows.agg(*totals)
    return report.select(*by, *[m.value.alias(m.name) for m in metrics])


def corpus_bleu(
    df: DataFrame, hyp: str = "hyp", ref: str = "ref", tokenize: str = "13a", by: list[str] | None = None
) -> DataFrame:
    """Corpus BLEU (one row, column ``bleu``; one row per group with ``by``).

    ``tokenize="pieces"`` takes arrays of subword pieces and gives subword BLEU.
    """
    return _report(df, [_bleu("bleu", hyp, ref, tokenize)], by or [])


def corpus_chrf(
    df: DataFrame,
    hyp: str = "hyp",
    ref: str = "ref",
    char_order: int = 6,
    word_order: int = 0,
    beta: float = 2,
    by: list[str] | None = None,
) -> DataFrame:
    """Corpus chrF (one row, column ``chrf``); ``word_order=2`` gives chrF++."""
    return _report(df, [_chrf("chrf", hyp, ref, char_order, word_order, beta)], by or [])


def evaluate(
    df: DataFrame,
    hyp: str = "hyp",
    ref: str = "ref",
    hyp_pieces: str = "hyp_pieces",
    ref_pieces: str = "ref_pieces",
    by: list[str] | None = None,
    word_order: int = 0,
) -> DataFrame:
    """BLEU, chrF and subword BLEU in one aggregation: (by..., metric, value)."""
    by = by or []
    names = {"bleu": "BLEU", "chrf": "chrF", "spbleu": "spBLEU"}
    wide = _report(df, [
        _bleu("bleu", hyp, ref, "13a"),
        _chrf("chrf", hyp, ref, 6, word_order, 2),
        _bleu("spbleu", hyp_pieces, ref_pieces, "pieces"),
    ], by)
    cells = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(c).alias("value")) for c, n in names.items()])
    return wide.select(*by, F.inline(cells))
