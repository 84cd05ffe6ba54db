"""Column functions over text: no actions, no Python workers, safe on streams."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as whitespace when a line is stripped
# or split (the Unicode whitespace set used by Python's str.strip and str.split).
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same characters above the space, as ranges of a pattern class.
_WIDE = r"\x85\xa0" + "\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WHITESPACE_RUN = rf"[\t-\r\x1c-\x20{_WIDE}]+"
# Whitespace and control characters.
SEPARATOR_RUN = rf"[\x00-\x20{_WIDE}]+"

# Fixed value: the mark that subword models put in front of a word.
WORD_MARK = "▁"

# 13a tokenisation (the mteval-v13a rules used for BLEU).
ENTITIES_13A = [("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")]
RULES_13A = [
    (r"([\{-\~\[-\` -\&\(-\+\:-\@\/])", " $1 "),
    (r"([^0-9])([\.,])", "$1 $2 "),
    (r"([\.,])([^0-9])", " $1 $2"),
    (r"([0-9])(-)", "$1 $2 "),
]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Remove leading and trailing whitespace, Unicode-aware (``trim`` alone only takes spaces)."""
    return F.btrim(_col(c), F.lit(WHITESPACE))


def one_line(c: Column | str) -> Column:
    """Make text safe for a line file or a TSV field: tabs and line breaks become spaces."""
    return F.translate(_col(c), "\t\n\r", "   ")


def words(c: Column | str) -> Column:
    """Split on runs of whitespace; an empty or blank text has no words."""
    return F.array_remove(F.split(_col(c), WHITESPACE_RUN), "")


def chars(c: Column | str) -> Column:
    """The code points of a text as an array; empty text gives an empty array."""
    return F.array_remove(F.split(_col(c), ""), "")


def spaced_13a(c: Column | str) -> Column:
    """A segment with its tokens under the 13a rules separated by whitespace."""
    t = F.replace(F.coalesce(_col(c), F.lit("")), F.lit("<skipped>"), F.lit(""))
    t = F.replace(t, F.lit("-\n"), F.lit(""))
    t = F.replace(t, F.lit("\n"), F.lit(" "))
    for entity, char in ENTITIES_13A:
        t = F.replace(t, F.lit(entity), F.lit(char))
    t = F.concat(F.lit(" "), t, F.lit(" "))
    for pattern, replacement in RULES_13A:
        t = F.regexp_replace(t, pattern, replacement)
    return t


def lang_code(c: Column | str) -> Column:
    """``en_XX`` -> ``en``."""
    return F.split_part(_col(c), F.lit("_"), F.lit(1))


def lang_symbol(c: Column | str) -> Column:
    """``en_XX`` -> ``__en_XX__``, the form a language takes in a dictionary."""
    return F.concat(F.lit("__"), _col(c), F.lit("__"))


def score_label(c: Column | str) -> Column:
    """Threshold label to number: the first digit is the whole part, ``"07"`` -> 0.7."""
    c = _col(c)
    return F.concat(F.substring(c, 1, 1), F.lit("."), F.substring(c, 2, 2)).try_cast("double")


def join_pieces(c: Column | str) -> Column:
    """Pieces (array) to text: join, turn word marks into spaces, drop the first space."""
    joined = F.replace(F.array_join(_col(c), ""), F.lit(WORD_MARK), F.lit(" "))
    return F.regexp_replace(joined, "^ ", "")


def remove_subwords(c: Column | str) -> Column:
    """Remove subword markup from space-joined model output."""
    merged = F.replace(_col(c), F.lit(" "), F.lit(""))
    return strip(F.replace(merged, F.lit(WORD_MARK), F.lit(" ")))


def length_ratio(a: Column | str, b: Column | str) -> Column:
    """Shorter over longer text length, in [0, 1]; NULL where both are empty."""
    la, lb = F.length(_col(a)), F.length(_col(b))
    return F.try_divide(F.least(la, lb).cast("double"), F.greatest(la, lb).cast("double"))
