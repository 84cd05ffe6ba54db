"""Token lists written by hand: what the rules are to do, whatever their patterns look like."""

import pytest
from pyspark.sql import functions as F

from sentloom.functions import text as tx
from sentloom.operators.tokenization import tokens, tokens_of_words

MOSES = [
    ("en", "Hello, world!", "Hello , world !"),
    ("en", "It's 3,000.50 dollars, isn't it?", "It 's 3,000.50 dollars , isn 't it ?"),
    ("en", "Mr. Smith met Dr. Who.", "Mr. Smith met Dr. Who ."),
    ("en", "The U.S. and wait... (maybe)", "The U.S. and wait ... ( maybe )"),
    ("en", "a  b\tc\u00a0d", "a b c d"),
    ("en", "the dogs' bowls", "the dogs ' bowls"),
    ("de", "Hr. Müller, z.B. am 3. Mai.", "Hr. Müller , z.B. am 3 . Mai ."),
    ("de", "Das ist's: »gut«", "Das ist ' s : » gut «"),
    ("fr", "L'eau, l'été; c'est M. Dupont.", "L' eau , l' été ; c' est M. Dupont ."),
    ("es", "¿Cómo está la Sra. Ruiz? 50%", "¿ Cómo está la Sra. Ruiz ? 50 %"),
    ("en", "", ""),
    ("en", " . ", "."),
]
MTEVAL = [
    ("Hello, world! 1,000.5 -x 3-4", "Hello , world ! 1,000.5 -x 3 - 4"),
    ("&quot;A&amp;B&quot; &lt;c&gt;", '" A & B " < c >'),
    ("end.", "end ."),
    ("hyphen-\nated a\nb", "hyphenated a b"),
    ("x.y 1.2 a,b", "x . y 1.2 a , b"),
]


@pytest.mark.parametrize("lang,text,want", MOSES)
def test_moses_style(spark, lang, text, want):
    assert spark.createDataFrame([(text,)], "t string").select(tokens("t", lang)).first()[0] == want.split()


def test_13a(spark):
    df = spark.createDataFrame([(t,) for t, _ in MTEVAL], "t string")
    got = [r[0] for r in df.select(tx.words(tx.spaced_13a(F.col("t")))).collect()]
    assert got == [w.split() for _, w in MTEVAL]


@pytest.mark.parametrize("lang", ["de", "en", "fr"])
def test_tokens_of_words_are_those_of_the_text(spark, lang):
    texts = [text for _, text, _ in MOSES] + ["Ärzte, 3-4 `x` naïve 中文 ͏a\u0301 x\x01y a,,5 1,5 ,, z.B. usw. U.S. l'été' -", "\x00", "𝒳 😀a 😀"]
    df = spark.createDataFrame([(t,) for t in [*texts, None]], "t string").select("t", tx.words("t").alias("w"))
    rows = df.select("t", F.array_sort(tokens("t", lang)).alias("a"), F.array_sort(tokens_of_words("w", lang)).alias("b")).collect()
    assert len(rows) == len(texts) + 1 and all(r.a == r.b for r in rows)
