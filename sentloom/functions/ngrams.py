"""Lengths and clipped n-gram matches of a row.

The match count is ``sum over grams of min(count in hyp, count in ref)``, a multiset
intersection. Spark's built-ins only have the set version, and exploding the grams would
shuffle or spill many times the text. So the rows of a batch are laid end to end as
arrays of unit numbers, every gram gets a number of its own (from that of the gram one
shorter and its last unit, so nothing is hashed), and the counts of all rows are compared
at once. Rows are not shuffled, and about ``PART_UNITS`` units are held at a time.
"""

from __future__ import annotations

import string
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

Units = Sequence[str] | str
# Units counted at a time; a longer row is counted on its own.
PART_UNITS = 1 << 20


def chars(text: str | None) -> str:
    """Characters without whitespace."""
    return "".join((text or "").split())


def tokens(value: Sequence[str] | str | None) -> Sequence[str]:
    """Whitespace-separated tokens of a text; an array of tokens as it is."""
    return value.split() if isinstance(value, str) else value or []


def chrf_words(text: str | None) -> list[str]:
    """Words for chrF++: one punctuation mark leaves the end of a word, else its start."""
    words: list[str] = []
    for w in (text or "").split():
        if len(w) > 1 and w[-1] in string.punctuation:
            words += [w[:-1], w[-1]]
        elif len(w) > 1 and w[0] in string.punctuation:
            words += [w[0], w[1:]]
        else:
            words.append(w)
    return words


def numbered_units(sides: Sequence[Units]) -> tuple[np.ndarray, np.ndarray]:
    """A number for each unit of all sequences laid end to end, and the length of each sequence."""
    lengths = np.fromiter(map(len, sides), np.int64, len(sides))
    if all(isinstance(s, str) for s in sides):
        return np.frombuffer("".join(sides).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64), lengths
    flat = pa.array([u for s in sides for u in s], pa.string()).dictionary_encode()
    return flat.indices.to_numpy(zero_copy_only=False).astype(np.int64), lengths


def count_matches(hyps: Sequence[Units], refs: Sequence[Units], top: int) -> np.ndarray:
    """Matches of the n-grams of order 1..top of each pair of token lists (or of the characters of two strings)."""
    rows = len(hyps)
    codes, lengths = numbered_units([*hyps, *refs])
    # Row numbers go on from the hypotheses to the references.
    owner = np.repeat(np.arange(2 * rows), lengths)
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(codes))  # units from here to the end of the row
    out, gram, at = np.zeros((rows, top), np.int64), np.zeros(len(codes), np.int64), np.arange(len(codes))
    for n in range(1, top + 1):
        at = at[left[at] >= n]
        if not len(at):
            break
        # A gram is the gram before its last unit, and that unit.
        _, own = np.unique(codes[at + n - 1], return_inverse=True)
        _, gram[at] = np.unique(gram[at] * (own.max() + 1) + own, return_inverse=True)
        width = gram[at].max() + 1
        hyp = owner[at] < rows
        keys, counts = zip(*(
            np.unique((owner[at[side]] % rows) * width + gram[at[side]], return_counts=True) for side in (hyp, ~hyp)
        ))
        both, i, j = np.intersect1d(*keys, assume_unique=True, return_indices=True)
        out[:, n - 1] = np.bincount(both // width, np.minimum(counts[0][i], counts[1][j]), rows)
    return out


def match_counts(hyp: Column | str, ref: Column | str, top: int, units: Callable[[object], Units]) -> Column:
    """Array column ``[units in hyp, units in ref, matches of order 1, ..., matches of order top]``."""

    @F.arrow_udf("array<bigint>")
    def run(hyps: pa.Array, refs: pa.Array) -> pa.Array:
        done, part, size = [], [], 0

        def count() -> None:
            h, r = zip(*part)
            done.append(np.column_stack([[*map(len, h)], [*map(len, r)], count_matches(h, r, top)]))

        for pair in zip(hyps, refs):
            part.append(tuple(units(side.as_py()) for side in pair))
            size += len(part[-1][0]) + len(part[-1][1])
            if size >= PART_UNITS:
                count()
                part, size = [], 0
        if part:
            count()
        flat = np.concatenate(done).ravel() if done else np.empty(0, np.int64)
        return pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, top + 2), pa.int32()), pa.array(flat, pa.int64()))

    return run(hyp, ref)
