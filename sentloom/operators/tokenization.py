"""Moses-style word tokenisation as a chain of built-in expressions.

The rules follow the published Moses conventions (symbols stand alone, commas stay
inside numbers, apostrophes split by language, a final period leaves its word
unless the word is an abbreviation). The output is Moses-*style*: it is not claimed
to be byte-identical to any particular tool.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentloom.functions import text as tx

# Words whose final period belongs to them, per language.
ABBREVIATIONS: dict[str, list[str]] = {
    "en": ["Mr", "Mrs", "Ms", "Dr", "Prof", "Sr", "Jr", "St", "vs", "etc", "e.g", "i.e", "No", "Inc", "Ltd"],
    "de": ["Dr", "Prof", "Hr", "Fr", "Nr", "Str", "bzw", "usw", "z.B", "d.h", "u.a", "ca", "evtl", "ggf"],
    "fr": ["M", "MM", "Mme", "Mlle", "Dr", "etc", "av", "apr", "env", "cf"],
    "es": ["Sr", "Sra", "Srta", "Dr", "Dra", "Ud", "Uds", "etc", "Av", "pág"],
}
# Languages whose apostrophe closes the first word (l' eau).
APOSTROPHE_LEFT = ("fr", "it", "ga", "ca")

_L = r"\p{L}\p{M}"
_LN = r"\p{L}\p{M}\p{N}"
# Words that no rule changes, each a token as it is.
PLAIN_WORD = rf"^[{_LN}`\-]+\z"


def separation_rules(lang: str, abbreviations: Sequence[str] | None = None) -> list[tuple[str, str]]:
    """The (pattern, replacement) chain for a language; ``$1`` names a group.

    It expects a text with a space at both ends and leaves tokens separated by spaces.
    Two spaces between words give each word its own borders, so no rule sees the word
    before or after: the tokens of a text are the tokens of its words, one after another.
    """
    known = ABBREVIATIONS.get(lang, []) if abbreviations is None else list(abbreviations)
    rules = [
        (tx.SEPARATOR_RUN, "  "),
        (rf"([^{_LN}\s.'`,\-])", " $1 "),
        # Runs of dots are one token.
        (r"(\.\.+)", " $1 "),
        # A comma stays only between two digits.
        (r"([^\p{N}]),", "$1 , "),
        (r",([^\p{N}])", " , $1"),
    ]
    if lang == "en" or lang in APOSTROPHE_LEFT:
        rules += [
            (rf"([^{_L}])'([^{_L}])", "$1 ' $2"),
            (rf"([^{_L}])'([{_L}])", "$1 ' $2"),
            (rf"([{_L}])'([^{_L}])", "$1 ' $2"),
            (rf"([{_L}])'([{_L}])", "$1 '$2" if lang == "en" else "$1' $2"),
        ]
    else:
        rules.append((r"'", " ' "))
    # A word-final period is a token of its own, unless the word is an abbreviation or
    # dotted itself (U.S.); the control character stands for the periods that stay.
    rules.append((r"\s+", "  "))
    if known:
        rules.append((r" (" + "|".join(a.replace(".", r"\.") for a in known) + r")\. ", " $1\x01 "))
    rules += [
        (rf" ((?:[{_L}]\.)+[{_L}])\. ", " $1\x01 "),
        (r"([^ .])\. ", "$1 . "),
        (r"\x01", "."),
    ]
    return rules


def tokens(c: Column | str, lang: str, abbreviations: Sequence[str] | None = None) -> Column:
    """Tokens of a text as an array."""
    c = F.col(c) if isinstance(c, str) else c
    spaced = F.concat(F.lit(" "), c, F.lit(" "))
    for pattern, replacement in separation_rules(lang, abbreviations):
        spaced = F.regexp_replace(spaced, pattern, replacement)
    return tx.words(spaced)


def tokens_of_words(c: Column | str, lang: str) -> Column:
    """Tokens of an array of words without whitespace, in no order: those of the words joined by spaces.

    Plain words are tokens as they are; only the others go through the rules.
    """
    c = F.col(c) if isinstance(c, str) else c
    others = F.filter(c, lambda w: ~w.rlike(PLAIN_WORD))
    return F.concat(F.filter(c, lambda w: w.rlike(PLAIN_WORD)), tokens(F.array_join(others, " "), lang))


def tokenize(df: DataFrame, lang: str, col: str = "text", out: str = "tokens") -> DataFrame:
    """Add the word tokens of ``col`` as an array column."""
    return df.withColumn(out, tokens(col, lang))
