"""Secrets in texts: fixed rules, and character Markov models of random strings and identifiers."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base rules.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS, HEX = re.compile(r"AKIA[A-Z0-9]{12,}"), re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "markov")
MIN_VALUE = 8
# Strings the models judge: so long at least, and in these characters.
MIN_CANDIDATE = 16
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % MIN_CANDIDATE)
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
# Pseudo-counts of a character and of what follows one, and the log-likelihood ratio a
# secret needs for each character.
SMOOTHING, BACKOFF, MIN_RATIO = 0.5, 2.0, 1.0
# A quick look for texts that may match at all; it may say yes too often, never no.
MAYBE_ASSIGN = r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]"
MAYBE_ACCESS, MAYBE_HEX = "AKIA", "[0-9a-f]{32}"
# Code points of a text looked at together.
CHUNK = 1 << 20
CODES = np.full(128, -1, np.int64)
CODES[[ord(c) for c in ALPHABET]] = np.arange(len(ALPHABET))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base rules, each kind leftmost and non-overlapping, in order."""
    spans = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_VALUE]
    # A run that is too short has no part that is long enough, so the length may stand in the pattern.
    spans += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    spans += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def _codes(string: str) -> np.ndarray:
    return CODES[np.frombuffer(string.encode("ascii"), np.uint8)]


def _maybe(texts: pa.Array) -> np.ndarray:
    """Which texts may have a base match."""
    text = pc.fill_null(texts, "")
    found = pc.or_(pc.or_(pc.match_substring_regex(text, MAYBE_ASSIGN), pc.match_substring(text, MAYBE_ACCESS)), pc.match_substring_regex(text, MAYBE_HEX))
    return found.to_numpy(zero_copy_only=False)


def pair_counts(docs: DataFrame) -> np.ndarray:
    """Counts of neighbouring characters in labelled samples: [0] random strings, [1] identifiers.

    The base rules label: the values they find are random strings, every other string of
    identifier characters in any text is ordinary. All rows count; each task adds up
    its own two tables of 67 x 67.
    """
    size = len(ALPHABET)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, size * size), np.int64)
        for batch in batches:
            column = batch.column(0)
            for text, maybe in zip(column, _maybe(column)):
                text = text.as_py()
                if not text:
                    continue
                if maybe:
                    rest, at = [], 0
                    for start, end, kind in base_spans(text):
                        value = text[start:end]
                        if kind == "assign":
                            value = ASSIGN.match(value)[2].replace(".", "-")
                        c = _codes(value)
                        total[0] += np.bincount(c[:-1] * size + c[1:], minlength=size * size)
                        if end > at:
                            rest.append(text[at:start])
                            at = end
                    text = " ".join([*rest, text[at:]])
                points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
                for at in range(0, len(points), CHUNK):
                    part = points[at:at + CHUNK + 1]
                    codes = np.where(part < 128, CODES[np.minimum(part, 127)], -1)
                    both = (codes[:-1] >= 0) & (codes[1:] >= 0)
                    total[1] += np.bincount(codes[:-1][both] * size + codes[1:][both], minlength=size * size)
        at = np.arange(2 * size * size)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.ravel())], ["at", "n"])

    rows = docs.select("text").mapInArrow(count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(2 * size * size)
    for row in rows:
        out[row["at"]] = row["n"]
    return out.reshape(2, size, size)


def log_ratios(counts: np.ndarray) -> np.ndarray:
    """Log-likelihood ratio of each next character, random against ordinary.

    Both chains fall back on how often a character comes at all, so a pair that ordinary
    text never has is as unlikely there as its second character is rare. Random strings
    are half a uniform draw, since few alphabets of secrets are among the samples.
    """
    n = len(ALPHABET)
    alone = (counts.sum(axis=1) + SMOOTHING) / (counts.sum(axis=(1, 2)) + n * SMOOTHING)[:, None]
    rows = counts.sum(axis=2, keepdims=True)
    p = (counts + BACKOFF * alone[:, None, :]) / (rows + BACKOFF)
    return np.log(0.5 * p[0] + 0.5 / n) - np.log(p[1])


def free_parts(text: str, taken: list[tuple[int, int, str]]) -> Iterator[tuple[int, int]]:
    """Candidates, without what base spans cover of them: each part that is still long enough, in order.

    Candidates and base spans are both in order, so either is gone through once.
    """
    covered: list[list[int]] = []
    for start, end, _ in taken:
        if covered and start <= covered[-1][1]:
            covered[-1][1] = max(covered[-1][1], end)
        else:
            covered.append([start, end])
    at = 0
    for m in CANDIDATE.finditer(text):
        start, end = m.span()
        while at < len(covered) and covered[at][1] <= start:
            at += 1
        here = at
        while here < len(covered) and covered[here][0] < end:
            if covered[here][0] - start >= MIN_CANDIDATE:
                yield start, covered[here][0]
            start = covered[here][1]
            here += 1
        if end - start >= MIN_CANDIDATE:
            yield start, end


def markov_spans(text: str, ratios: np.ndarray, taken: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Parts of candidates outside the base spans whose mean log-likelihood ratio says random."""
    found = []
    for start, end in free_parts(text, taken):
        c = _codes(text[start:end])
        if ratios[c[:-1], c[1:]].mean() >= MIN_RATIO:
            found.append((start, end, "markov"))
    return found


def _joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def secret_spans(text: Column, ratios: np.ndarray) -> Column:
    """struct(n_assign, n_access, n_hex, base_sha256, spans) of a text column."""
    nothing = (0, 0, 0, hashlib.sha256(b"").hexdigest())
    kinds = [pa.int64()] * 3 + [pa.string()] * 2
    names = ["n_assign", "n_access", "n_hex", "base_sha256", "spans"]

    @F.arrow_udf("n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
    def spans(texts: pa.Array) -> pa.Array:
        rows = []
        for text, maybe in zip(texts, _maybe(texts)):
            text = text.as_py() or ""
            base = base_spans(text) if maybe else []
            more = markov_spans(text, ratios, base)
            found = [s[2] for s in base]
            head = (*(found.count(k) for k in KINDS[:3]), hashlib.sha256(_joined(base).encode()).hexdigest()) if base else nothing
            rows.append((*head, _joined(sorted(base + more, key=lambda s: (s[0], KINDS.index(s[2]))))))
        return pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [[]] * 5, kinds)], names)

    return spans(text)


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans of every whole text.

    Spans are kind:start:end in code points, the end exclusive, in order of start, then
    kind; base_sha256 digests the base spans alone. The Markov models add spans of kind
    ``markov`` that overlap no base span: of a run that a base span covers in part, the parts
    that are left are judged. A NULL text is empty and has no span (the
    digest is that of the empty string). Repeated rows and NULL ids stay; columns other
    than doc_id and text are not read; an empty table gives no rows.
    """
    ratios = log_ratios(pair_counts(docs))
    return docs.select("doc_id", secret_spans(F.col("text"), ratios).alias("_s")).select("doc_id", "_s.*")
