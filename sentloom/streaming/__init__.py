"""Row-wise operators, usable on a streaming DataFrame as they are.

Inputs are finite corpora, so nothing here is streaming-only. These operators hold
no action, shuffle or state: a stream of new lines or pairs can be cleaned and
scored with the same functions before it is appended to a corpus.
"""

from sentloom.operators.cleaning import (
    add_lang_tags,
    decode_pieces,
    drop_empty_pairs,
    filter_by_score,
    length_filter,
    lower_text,
    max_pieces,
    parse_hypotheses,
    remove_subwords,
    strip_lines,
)
from sentloom.operators.scoring import length_ratio_scorer, score_pairs
from sentloom.operators.tokenization import tokenize

__all__ = [
    "add_lang_tags", "decode_pieces", "drop_empty_pairs", "filter_by_score", "length_filter",
    "length_ratio_scorer", "lower_text", "max_pieces", "parse_hypotheses", "remove_subwords",
    "score_pairs", "strip_lines", "tokenize",
]
