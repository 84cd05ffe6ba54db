from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from sentloom.operators import stats
from sentloom.operators.tokenization import tokens


def texts(spark, rows):
    return spark.createDataFrame([(r,) for r in rows], "text string")


def test_tokenisation_rules(spark):
    cases = {
        ("en", "Mr. Smith's dog, e.g. Rex, ran 1,000 miles..."): "Mr. Smith 's dog , e.g. Rex , ran 1,000 miles ...",
        ("en", "He left the U.S. (in 2001)."): "He left the U.S. ( in 2001 ) .",
        ("fr", "L'eau, c'est tout."): "L' eau , c' est tout .",
        ("de", "Das ist z.B. gut!"): "Das ist z.B. gut !",
        ("en", "  \t "): "",
        ("en", "a b　c"): "a b c",
    }
    for (lang, text), want in cases.items():
        got = texts(spark, [text]).select(tokens("text", lang)).first()[0]
        assert " ".join(got) == want, (lang, text, got)


def test_tokens_of_a_text_are_the_tokens_of_its_words(spark):
    rows = ["1' '2 ' 'a, ,b ,, x.y. z...", "a' 'b, '' Mr. Mrs. e.g.", "don't, 'quoted' - dash-ed"]
    for lang in ("en", "fr", "de"):
        whole = [r[0] for r in texts(spark, rows).select(tokens("text", lang)).collect()]
        for row, got in zip(rows, whole):
            by_word = [r[0] for r in texts(spark, row.split()).select(tokens("text", lang)).collect()]
            assert got == [t for ts in by_word for t in ts]


def test_word_frequencies(spark):
    df = texts(spark, ["One one, two", "ONE two three", "x1 x1", " ".join(["ten"] * 10), "é É"])
    got = {r.word: r["count"] for r in stats.word_frequencies(df, "en").collect()}
    assert got == {"one": 3, "two": 2, "x1": 2, "ten": 10, "é": 2}
    literal = {r.word: r["count"] for r in stats.word_frequencies(df, "en", as_written=True).collect()}
    # The literal rule drops every line with the digit 1, also counts like 10 and words like x1.
    assert literal == {"one": 3, "two": 2, "é": 2}
    ordered = stats.order_by_frequency(stats.word_frequencies(df, "en")).collect()
    assert [r.word for r in ordered] == ["ten", "one", "é", "x1", "two"]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(scores=st.lists(st.one_of(st.none(), st.floats(0, 1), st.just(float("nan"))), max_size=20))
def test_sweep_equals_ten_filters(spark, scores):
    df = spark.createDataFrame([(s,) for s in scores], "score double")
    got = {r.threshold: r.n_pairs for r in stats.threshold_sweep(df).collect()}
    assert got == {t: sum(s is not None and s > t for s in scores) for t in stats.THRESHOLDS}
    counts = [got[t] for t in stats.THRESHOLDS]
    assert counts == sorted(counts, reverse=True)


def test_vocab_coverage(spark):
    df = spark.createDataFrame([("a", ["x", "y", "x"]), ("b", ["z"]), ("a", ["q"])], "split string, tokens array<string>")
    vocab = spark.createDataFrame([("x",), ("z",)], "token string")
    got = {r.split: (r.n_tokens, r.n_oov, r.oov_rate) for r in stats.vocab_coverage(df, vocab).collect()}
    assert got == {"a": (4, 2, 0.5), "b": (1, 0, 0.0)}


def test_corpus_counts(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",)], "corpus string")
    assert {r.corpus: r.n_rows for r in stats.corpus_counts(df).collect()} == Counter("aab")
