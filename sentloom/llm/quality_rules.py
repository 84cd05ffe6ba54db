"""Line-first cleaning: rules on lines, then documents that lose too much of their text are rejected."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentloom.llm.common import SPACE_CLASS, let, words_of

WINDOW = 5
MIN_WORDS, MAX_REPEATED_PERCENT = 10, 20
SYMBOLS = "[#*$%&|<>]"
# Line rules. A line fails with more than so many symbols or doubled marks
# for each word, with so few words and no sentence mark, or as a known notice.
MAX_SYMBOLS, MAX_SHOUTS, SHORT_LINE = 0.3, 0.3, 5
SENTENCE_MARK = r"[.!?…:;。！？]"
SEPARATORS = ("|", "»", "«", "•", "·", "→", ">", "/", "::", "--")
BOILERPLATE = (
    r"(?i)\b(all rights reserved|cookie (policy|settings)|accept (all )?cookies|terms of (use|service)|privacy policy"
    r"|licensed under the|subscribe to our newsletter|sign (in|up) to|javascript is (disabled|required)|lorem ipsum"
    r"|alle rechte vorbehalten|tous droits réservés|todos los derechos reservados)\b|©"
)
# Share of the words that failing lines may take with them.
MAX_LOST = 0.5


def repeated_words(words: Column) -> Column:
    """How many words are in a run of five words that the text has twice or more.

    Runs are compared by 64-bit hash. Texts whose runs are all different, nearly all
    texts, are recognised by counting; the others sort (hash, place), so a long text
    of repeats costs n log n.
    """

    def hashes(w: Column) -> Column:
        run = lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(WINDOW)])
        return F.transform(F.sequence(F.lit(0), F.size(w) - WINDOW), run)

    def covered(places: Column) -> Column:
        """Words under the runs at sorted ``places``: each adds up to five, less what the next one covers."""
        gaps = F.zip_with(places, F.slice(places, 2, F.greatest(F.size(places) - 1, F.lit(0))), lambda a, b: F.coalesce(F.least(b - a, F.lit(WINDOW)), F.lit(WINDOW)))
        return F.when(F.size(places) == 0, F.lit(0)).otherwise(F.aggregate(gaps, F.lit(0), lambda s, g: s + g))

    def twice(h: Column) -> Column:
        placed = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def marked(s: Column) -> Column:
            n = F.size(s)
            before = F.concat(F.array(F.lit(None).cast("bigint")), F.transform(F.slice(s, 1, n - 1), lambda x: x["h"]))
            after = F.concat(F.transform(F.slice(s, 2, n - 1), lambda x: x["h"]), F.array(F.lit(None).cast("bigint")))
            near = F.zip_with(F.zip_with(s, before, lambda x, b: F.struct(x.alias("x"), b.alias("b"))), after, lambda y, a: F.struct(y["x"]["i"].alias("i"), (F.coalesce(y["x"]["h"] == y["b"], F.lit(False)) | F.coalesce(y["x"]["h"] == a, F.lit(False))).alias("twice")))
            return F.sort_array(F.transform(F.filter(near, lambda y: y["twice"]), lambda y: y["i"]))

        return let(let(placed, marked), covered)

    def counted(h: Column) -> Column:
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(twice(h))

    return let(words, lambda w: F.when(F.size(w) <= WINDOW, F.lit(0)).otherwise(let(hashes(w), counted)))


def line_fails(line: Column) -> Column:
    """Whether a line breaks the punctuation, navigation or boilerplate rule."""
    words = words_of(line)
    n = F.greatest(F.size(words), F.lit(1))
    symbols = F.regexp_count(line, F.lit(SYMBOLS))
    shouts = F.regexp_count(line, F.lit(r"[!?]{2,}"))
    separators = F.size(F.filter(words, lambda w: w.isin(*SEPARATORS)))
    return (
        (symbols > MAX_SYMBOLS * n) | (shouts > MAX_SHOUTS * n)
        | ((n < SHORT_LINE) & ~line.rlike(SENTENCE_MARK)) | (separators > MAX_SYMBOLS * n)
        | line.rlike(BOILERPLATE)
    )


def quality_rules(docs: DataFrame, max_lost: float = MAX_LOST) -> DataFrame:
    """doc_id, counts of each whole text, base_failed, n_clean_words, cleaned text and kept.

    Counts: n_words; word_chars, code points in words; n_symbols, characters of
    ``#*$%&|<>``; n_dup_lines, lines with a word that equal an earlier one;
    n_repeat_words, see :func:`repeated_words`. base_failed: under 10 words, or over 20
    percent of them repeated. The line rules then remove lines, and a document is kept
    that is not base_failed and loses at most ``max_lost`` of its words. ``cleaned`` has
    the lines left (those without a word stay).

    A NULL text counts as empty: no words, not kept. Rows are judged one by one, so
    repeated rows and NULL ids give as many rows; columns other than doc_id and text are
    not read.
    """
    text = F.coalesce("text", F.lit(""))
    has_word = lambda x: x.rlike(f"[^{SPACE_CLASS[1:-1]}]")
    rows = docs.select("doc_id", text.alias("_text"))
    full_lines = F.filter(F.split("_text", "\n", -1), has_word)
    counts = let(words_of(F.col("_text")), lambda w: F.struct(
        F.size(w).alias("n_words"), F.length(F.array_join(w, "")).alias("word_chars"), repeated_words(w).alias("n_repeat_words"),
    ))
    left = F.filter(F.split("_text", "\n", -1), lambda x: ~has_word(x) | ~line_fails(x))
    rows = rows.select(
        "doc_id", counts.alias("_c"),
        F.regexp_count("_text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        let(full_lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        F.array_join(left, "\n").alias("cleaned"),
    )
    n, repeated = F.col("_c.n_words").cast("long"), F.col("_c.n_repeat_words").cast("long")
    clean_words = F.size(words_of(F.col("cleaned"))).cast("long")
    return rows.select(
        "doc_id", n.alias("n_words"), F.col("_c.word_chars").cast("long").alias("word_chars"), "n_symbols", "n_dup_lines",
        repeated.alias("n_repeat_words"), ((n < MIN_WORDS) | (100 * repeated > MAX_REPEATED_PERCENT * n)).alias("base_failed"),
        clean_words.alias("n_clean_words"), "cleaned",
    ).withColumn("kept", ~F.col("base_failed") & (F.col("n_clean_words") >= (1 - max_lost) * F.col("n_words")))
