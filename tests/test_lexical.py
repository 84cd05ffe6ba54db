"""Word translation probabilities against plain expectation maximisation, and what they tell a classifier."""

import math
import random
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sentloom.functions import text as tx
from sentloom.operators import lexical, scoring, word_pairs
from sentloom.operators.stats import word_frequencies
from sentloom.sources.staging import path_exists

PAIRS = "line_no bigint, src string, tgt string"


def plain(pairs, rounds, least):
    p = None
    for _ in range(rounds):
        c = defaultdict(float)
        for _, src, tgt in pairs:
            s, t = Counter([*src.lower().split()]), Counter(tgt.lower().split())
            s[""] += 1
            for w, n in t.items():
                share = {v: m * (1.0 if p is None else p.get((v, w), 0.0)) for v, m in s.items()}
                norm = sum(share.values())
                for v, x in share.items():
                    if x:
                        c[v, w] += n * x / norm
        whole = defaultdict(float)
        for (v, _), x in c.items():
            whole[v] += x
        p = {k: x / whole[k[0]] for k, x in c.items() if x / whole[k[0]] >= least}
    return p


def word(side, n):
    """Without digits, which another feature compares."""
    return side + "".join("abcdefghij"[int(d)] for d in str(n))


def translated(n, seed, vocabulary=60):
    """Sentences whose target has a word for each word of the source, in another order."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        words = [rng.randrange(vocabulary) for _ in range(rng.randrange(3, 9))]
        out.append((i, " ".join(word("s", w) for w in words), " ".join(word("t", w) for w in rng.sample(words, len(words)))))
    return out


def test_two_rounds_by_hand(spark):
    rows = [(1, "the house", "das Haus"), (2, "the book", "das Buch"), (3, "a book a book", "ein Buch"), (4, "", "leer"), (5, "x", "")]
    for rounds in (1, 3):
        got = {(r.s, r.t): r.p for r in lexical.translation_probabilities(spark.createDataFrame(rows, PAIRS), rounds, 0.01).collect()}
        want = plain(rows, rounds, 0.01)
        assert got.keys() == want.keys() and all(math.isclose(got[k], want[k]) for k in want)


def test_words_that_occur_together_are_looked_at_in_slices_and_never_written(spark, monkeypatch):
    """Many slices give what one does; old code wrote all words that occur together."""
    monkeypatch.setattr(lexical, "SLICE_PAIRS", 40)
    monkeypatch.setattr(lexical, "together", None)
    slices, found = lexical._slices, []
    monkeypatch.setattr(lexical, "_slices", lambda parts: found.append(slices(parts)) or found[-1])
    rows = [*translated(12, 7, 15), (100, "", "leer"), (101, "x", ""), (102, "x", None), (103, None, "t")]
    df = spark.createDataFrame([*rows, (None, "a", "b")], PAIRS)
    table = lexical.translation_probabilities(df, 2, 0.05)
    got, want = {(r.s, r.t): r.p for r in table.collect()}, plain([r for r in rows if None not in r] + [(103, "", "t")], 2, 0.05)
    assert got.keys() == want.keys() and all(math.isclose(got[k], want[k]) for k in want)
    features = {r.line_no: r.lexical_tgt for r in lexical.lexical_features(df.filter("line_no is not null"), table, table).collect()}
    for line_no, src, tgt in rows:
        words = (tgt or "").lower().split()
        best = [max((got.get((s, t), 0.0) for s in (src or "").lower().split()), default=0.0) for t in words]
        assert math.isclose(features[line_no], sum(best) / len(best) if best else 0.0)
    assert min(found) > 1


@pytest.mark.parametrize("held", [5, 10**6])
def test_a_slice_makes_a_bounded_number_of_words_that_occur_together(monkeypatch, held):
    """Arrays alone, without Spark: few words held, in a block and in a piece give what plain code gives."""
    for name, value in (("HELD_WORDS", held), ("BLOCK", 7), ("ENTRIES", 10), ("PIECE_WORDS", 4)):
        monkeypatch.setattr(word_pairs, name, value)
    rows, n, least = [*translated(12, 7, 15), *((50 + i, "sa sb", "ta") for i in range(9)), (98, "", "leer"), (99, "x", "")], 3, 0.0437
    batch = pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows)], ["line_no", "src", "tgt"])
    chunks = list(word_pairs.cut(iter([batch.slice(k, 5) for k in range(0, len(rows), 5)]), 100, "", chunk_words=12))
    assert len(chunks) > 1
    books = {c: sorted({w for x in chunks for w in x.column(c)[0].as_py()}) for c in ("s_words", "t_words")}
    codes = {c: {w: k for k, w in enumerate(book)} for c, book in books.items()}
    pieces = [
        piece for i, x in enumerate(chunks) for piece in word_pairs.numbered(iter([pa.RecordBatch.from_arrays([
            pa.array([i]), *(pa.array([[codes[c][w] for w in x.column(c)[0].as_py()]], pa.list_(pa.int32())) for c in books), x.column("data"),
        ], ["i", "s_codes", "t_codes", "data"])]))
    ]

    def whole(sums):
        totals = Counter()
        for x in sums:
            for code, total in zip(x.column("code").to_pylist(), x.column("total").to_pylist()):
                totals[code] += total
        codes = sorted(totals)
        return list(word_pairs.packed_sums(iter([pa.RecordBatch.from_arrays([pa.array(codes, pa.int32()), pa.array([totals[c] for c in codes])], ["code", "total"])])))

    n_s, table = len(books["s_words"]), {k: [] for k in range(n)}
    sums = whole(word_pairs.first_sums(iter(pieces)))
    for first in (True, False):
        out = {k: list(word_pairs.learn(iter([*sums, *table[k], *pieces]), k, n, n_s, len(sums) + len(table[k]), least, first)) for k in range(n)}
        table = {k: [x for x in own if x.column("kind")[0].as_py() == "table"] for k, own in out.items()}
        if not first:
            sums = whole(word_pairs.unpacked_sums(x for own in out.values() for x in own if x.column("kind")[0].as_py() == "sums"))
    words = [
        next(word_pairs.packed_words(iter([pa.RecordBatch.from_arrays([pa.array(book), pa.array(range(len(book)))], ["word", "code"])]), c))
        for c, book in books.items()
    ]
    got = {}
    for k in range(n):
        for x in word_pairs.unpacked_table(iter([*table[k], *words, *sums]), k, n, n_s, least):
            got |= {(s, t): p for s, t, p in zip(*(x.column(c).to_pylist() for c in "stp"))}
    want = plain(rows, 2, least)
    assert got.keys() == want.keys() and all(math.isclose(got[k], want[k]) for k in want)
    with pytest.raises(ValueError, match="missing"):
        list(word_pairs.learn(iter(pieces), 0, n, n_s, 1, least, True))


def test_arrow_splits_at_the_same_whitespace():
    text = pa.array(["a" + "".join(f"{c}x" for c in tx.WHITESPACE) + "  b ", " ", "", None])
    assert word_pairs._words(text).to_pylist() == [["a", *"x" * len(tx.WHITESPACE), "b"], [], [], []]
    others = [chr(c) for c in range(1, 0x3100) if chr(c) not in tx.WHITESPACE]
    assert word_pairs._words(pa.array([f"a{c}b" for c in others])).value_lengths().unique().to_pylist() == [1]


def test_lines_of_one_number_are_one_and_rows_say_what_pieces_say(spark, monkeypatch):
    rows = [(1, "a b", "x"), (1, "c", "y x"), (2, "a", "x"), (None, "a", "z")]
    df = spark.createDataFrame(rows, PAIRS)
    table = lexical.translation_probabilities(df, 2, 0.01)
    got, want = {(r.s, r.t): r.p for r in table.collect()}, plain([(1, "a b c", "x y x"), (2, "a", "x")], 2, 0.01)
    assert got.keys() == want.keys() and all(math.isclose(got[k], want[k]) for k in want)
    some = spark.createDataFrame([(7, "a q", "x y unknown"), (8, "q", "x")], PAIRS)
    by_rows = spark.createDataFrame([*((s, t, p) for (s, t), p in got.items()), ("a", "x", 0.0), ("a", None, 1.0)], "s string, t string, p double")
    found = lexical.lexical_features(some, by_rows, by_rows).orderBy("line_no").collect()
    # A table that was learned is not made anew from its rows.
    monkeypatch.setattr(lexical, "_as_table", None)
    assert lexical.lexical_features(some, table, table).orderBy("line_no").collect() == found
    assert math.isclose(found[0].lexical_tgt, (got["a", "x"] + got["a", "y"]) / 3) and found[1].lexical_tgt == 0.0


def test_text_and_sums_are_deleted_when_they_are_done_with(spark, monkeypatch):
    """Of three rounds the last table stays, and of a text nothing but what is returned."""
    made, path = [], lexical.staging_path
    monkeypatch.setattr(lexical, "staging_path", lambda spark, label: made.append((label, path(spark, label))) or made[-1][1])
    df = spark.createDataFrame(translated(12, 7, 15), PAIRS)
    table = lexical.translation_probabilities(df, 3, 0.01)
    assert lexical.lexical_features(df, table, table).count() == 12
    assert Counter(label for label, _ in made) == {"parts": 3, "pieces": 3, "translations": 3}
    assert not any(path_exists(spark, p) for label, p in made if label != "translations")
    tables = [p for label, p in made if label == "translations"]
    assert not any(path_exists(spark, f"{p}/kind=sums") for p in tables)
    assert [path_exists(spark, f"{p}/kind=table/k=0") for p in tables] == [False, False, True]


def test_likelihood_rises_and_words_find_their_translations(spark):
    rows = translated(150, 1)
    df = spark.createDataFrame(rows, PAIRS)
    tables = [lexical.translation_probabilities(df, n, 1e-6) for n in (1, 2, 4)]
    found = [lexical.log_likelihood(df, t) for t in tables]
    assert found[0] < found[1] < found[2]
    best = {}
    for r in tables[2].filter("s <> ''").collect():
        best[r.s] = max(best.get(r.s, (0, "")), (r.p, r.t))
    assert sum(t == "t" + s[1:] for s, (_, t) in best.items()) > 0.9 * len(best)


def test_long_pairs_are_looked_at_in_parts_and_no_word_is_lost(spark):
    rows = [(1, " ".join(f"a{i % 7}" for i in range(950)), " ".join(f"b{i % 5}" for i in range(430))), (2, "a1 a2", "b1")]
    src, tgt = lexical.aligned_words(spark.createDataFrame(rows, PAIRS))
    for side, count, sizes in ((src, "ns", {1: 950, 2: 2}), (tgt, "nt", {1: 430, 2: 1})):
        assert {r["line_no"]: r["n"] for r in side.groupBy("line_no").agg(F.sum(count).alias("n")).collect()} == sizes
        assert side.groupBy("line_no", "part").agg(F.sum(count).alias("n")).agg(F.max("n")).first()[0] <= 100
    assert src.filter("line_no = 1").select("part").distinct().count() == 10


def test_features_and_the_ranking_of_development_pairs(spark):
    """Negatives with some words replaced look like translations to all features but the lexical ones."""
    train, dev = (spark.createDataFrame(translated(n, seed), PAIRS) for n, seed in ((200, 2), (80, 3)))
    words = word_frequencies(train.select(F.col("tgt").alias("text")), "de")
    turned = train.select("line_no", F.col("tgt").alias("src"), F.col("src").alias("tgt"))
    tables = tuple(lexical.translation_probabilities(d, 4) for d in (train, turned))
    plain_model = scoring.fit_pair_classifier(train, dev, words, "de", regs=(0.01,), replaced=0.5)
    with_words = scoring.fit_pair_classifier(train, dev, words, "de", regs=(0.01,), replaced=0.5, lexical=tables)
    assert with_words.dev["auc"] > plain_model.dev["auc"] + 0.1 and with_words.dev["auc"] > 0.9
    assert set(with_words.weights()) == {*scoring.FEATURES, *lexical.LEXICAL, "intercept"}
    scored = scoring.score_pairs(dev, with_words).collect()
    assert len(scored) == 80 and all(0 <= r["score"] <= 1 for r in scored)
    odd = spark.createDataFrame([(1, "", ""), (2, None, word("t", 1)), (3, f"{word('s', 1)} {word('s', 2)}", f"{word('t', 2)} {word('t', 1)}")], PAIRS)
    got = {r["line_no"]: (r["lexical_tgt"], r["lexical_src"]) for r in lexical.lexical_features(odd, *tables).collect()}
    assert got[1] == got[2] == (0.0, 0.0) and min(got[3]) > 0.3


@pytest.mark.parametrize("share", [0.01, 0.3, 1.0])
def test_replaced_words(spark, share):
    rows = [*translated(60, 5, 40), (100, "x", ""), (101, "x", None), (102, "x", "unlisted")]
    df = spark.createDataFrame(rows, PAIRS)
    words = scoring.target_words(df.filter("line_no < 100"))
    bands = {r["word"]: r for r in scoring.word_bands(words).collect()}
    total = len(bands)
    assert sorted(b["rank"] for b in bands.values()) == list(range(total))
    assert all(b["first"] <= b["rank"] < b["first"] + b["size"] and b["size"] > 1 for b in bands.values())
    got = {r["line_no"]: r for r in scoring.replace_words(df, words, share, 7).collect()}
    assert set(got) == {r[0] for r in rows} - {100, 101}
    for line_no, src, tgt in rows:
        if line_no in got and line_no < 100:
            old, new = tgt.split(" "), got[line_no]["tgt"].split(" ")
            changed = [(a, b) for a, b in zip(old, new) if a != b]
            assert len(old) == len(new) and len(changed) == got[line_no]["n_replaced"] == max(1, math.ceil(len(old) * share))
            assert all(bands[a]["first"] == bands[b]["first"] for a, b in changed) and got[line_no]["src"] == src
    assert got[102]["tgt"] in bands
    again = {r["line_no"]: r["tgt"] for r in scoring.replace_words(df.repartition(5), words, share, 7).collect()}
    assert again == {k: r["tgt"] for k, r in got.items()}
