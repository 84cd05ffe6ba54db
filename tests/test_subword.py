import io
import time
from collections import Counter
from pathlib import Path

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from sentloom.operators import cleaning, subword
from sentloom.operators.numbering import number_lines
from sentloom.sources.staging import staging_root

SETTINGS = dict(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def texts(spark, rows):
    return spark.createDataFrame([(r,) for r in rows], "text string")


def plain_bpe(rows, n_merges, without="", longest=99):
    """One merge at a time: the most frequent pair; ties to the shorter, then smaller, merged symbol."""
    words = Counter("▁" + w for r in rows for w in r.split())
    segs = {w: list(w) for w in words}
    merges = []
    while len(merges) < n_merges:
        counts = Counter()
        for w, n in words.items():
            for pair in zip(segs[w], segs[w][1:]):
                if not set(without) & set("".join(pair)) and len("".join(pair)) <= longest:
                    counts[pair] += n
        if not counts:
            break
        a, b = min(counts, key=lambda p: (-counts[p], len(p[0] + p[1]), (p[0] + p[1]).encode(), len(p[0])))
        merges.append((a, b))
        for w, seg in segs.items():
            out, i = [], 0
            while i < len(seg):
                if seg[i:i + 2] == [a, b]:
                    out.append(a + b)
                    i += 2
                else:
                    out.append(seg[i])
                    i += 1
            segs[w] = out
    return merges, segs


CORPORA = [
    ["low lower lowest", "new newer newest wide wider widest", "low low new"],
    ["aaaa aaa aa a", "abab abab baba", "aabb"],
    ["banana bandana ananas", "nana na an", "banana cabana abc bca cab"],
]


@pytest.mark.parametrize("rows", CORPORA)
@pytest.mark.parametrize("leading, most, symbols", [(64, 20_000, 1_500_000), (1, 2, 8), (4, 3, 1)])
def test_merges_equal_one_at_a_time(spark, rows, leading, most, symbols, monkeypatch):
    """In one phase, and in many: few leading pairs, equal counts beyond them, hardly any room for runs."""
    for name, value in (("LEADING", leading), ("MOST_LEADING", most), ("RUN_SYMBOLS", symbols), ("BLOCK_SYMBOLS", 16)):
        monkeypatch.setattr(subword, name, value)
    chars = {c for r in rows for w in r.split() for c in "▁" + w}
    merges, vocab = subword.learn_bpe(texts(spark, rows), len(chars) + 3 + 12)
    assert merges == plain_bpe(rows, 12)[0]
    pieces = [r.piece for r in vocab.orderBy("piece_id").collect()]
    assert pieces[:3] == ["<unk>", "<s>", "</s>"]
    assert set(pieces[3:]) == chars | {a + b for a, b in merges}


@settings(**SETTINGS)
@given(rows=st.lists(st.text("abc ", min_size=1, max_size=14), min_size=1, max_size=6))
def test_batched_merges_equal_one_at_a_time_on_any_text(spark, rows):
    chars = {c for r in rows for w in r.split() for c in "▁" + w}
    merges, _ = subword.learn_bpe(texts(spark, rows), len(chars) + 3 + 10)
    assert merges == plain_bpe(rows, 10)[0]


def test_a_thousand_merges_in_phases(spark, sf, monkeypatch):
    """Words of all languages; runs of at most 3,000 symbols come to the driver, so there are many phases."""
    rows = [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()][:60]
    rows = [" ".join(r.split()[:60]) for r in rows]
    chars = {c for r in rows for w in r.split() for c in "▁" + w}
    monkeypatch.setattr(subword, "RUN_SYMBOLS", 3000)
    taken = []
    real = subword._learn_runs
    monkeypatch.setattr(subword, "_learn_runs", lambda runs, *a: taken.append(sum(len(r) // 4 for r in runs["run"].to_pylist())) or real(runs, *a))
    merges, _ = subword.learn_bpe(texts(spark, rows), len(chars) + 3 + 1000)
    assert len(merges) == 1000 and merges == plain_bpe(rows, 1000)[0]
    assert len(taken) > 3 and max(taken) <= 3000


def test_no_table_of_a_phase_is_left(spark):
    staged = lambda: {p.name for p in (Path(staging_root(spark).removeprefix("file:")) / "sentloom").glob("*")}
    before = staged()
    subword.learn_bpe(texts(spark, CORPORA[0]), 30)
    assert staged() == before


def one_pass_at_a_time(word, ranks):
    """Of all pairs in the word the earliest learned, everywhere from the left; again."""
    syms = list(word)
    while True:
        known = [p for p in zip(syms, syms[1:]) if p in ranks]
        if not known:
            return syms
        a, b = min(known, key=ranks.get)
        out, i = [], 0
        while i < len(syms):
            both = syms[i:i + 2] == [a, b]
            out.append(a + b if both else syms[i])
            i += 1 + both
        syms = out


@settings(max_examples=300, deadline=None)
@given(word=st.text("abc", max_size=30), picks=st.lists(st.tuples(st.integers(0, 99), st.integers(0, 99)), max_size=25), turn=st.randoms())
def test_segments_equal_one_pass_at_a_time(word, picks, turn):
    pool, pairs = list("abc"), []
    for i, j in picks:
        pair = (pool[i % len(pool)], pool[j % len(pool)])
        if pair not in pairs:
            pairs.append(pair)
            pool.append("".join(pair))
    turn.shuffle(pairs)
    ranks = {p: i for i, p in enumerate(pairs)}
    assert subword.segment(word, ranks) == one_pass_at_a_time(word, ranks)


def test_a_million_letters_take_seconds():
    merges, _ = plain_bpe([" ".join(a + b + c for a in "abcd" for b in "abcd" for c in "abcd")], 60)
    word = "▁" + "abcddcba" * 125_000
    start = time.monotonic()
    assert "".join(subword.segment(word, {m: i for i, m in enumerate(merges)})) == word
    assert time.monotonic() - start < 60


def test_encoding_replays_the_merges_and_decodes_to_the_text(spark):
    rows = CORPORA[0]
    merges, segs = plain_bpe(rows, 9)
    df = texts(spark, [*rows, "  unseen   words é ", "", None])
    encoded = subword.apply_bpe(df, merges).collect()
    for r in encoded[:3]:
        assert r.pieces == [p for w in r.text.split() for p in segs["▁" + w]]
    assert encoded[4].pieces == [] and encoded[5].pieces is None
    decoded = cleaning.decode_pieces(subword.apply_bpe(df.filter("text is not null"), merges)).collect()
    back = subword.apply_bpe(df.filter("text is not null"), merges, out="p").collect()
    for d, b in zip(decoded, back):
        assert "".join(b.p).replace("▁", " ").strip() == d.text


def test_rare_characters_and_long_pieces_are_left_out(spark):
    rows = ["abab abab ab xab abx", "ab ab abq aab"]
    merges, vocab = subword.learn_bpe(texts(spark, rows), 3 + 3 + 4, coverage=0.9, max_piece=4)
    pieces = {r.piece for r in vocab.collect()}
    assert {"a", "b", "▁"} <= pieces and not any(set("xq\ufffd") & set(p) for p in pieces - {"<unk>"})
    assert merges == plain_bpe(rows, 4, "xq", 4)[0]
    assert all(len(a + b) <= 4 for a, b in merges)


def test_a_vocabulary_below_the_alphabet_is_an_error(spark):
    with pytest.raises(ValueError, match="no room for"):
        subword.learn_bpe(texts(spark, CORPORA[0]), 8)


def test_encode_with_an_outside_model(spark):
    spm = pytest.importorskip("sentencepiece")
    model = io.BytesIO()
    spm.SentencePieceTrainer.train(
        sentence_iterator=iter(CORPORA[0] * 20), model_writer=model, vocab_size=30, model_type="bpe", minloglevel=2
    )
    proto = model.getvalue()

    def load():
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_proto=proto).EncodeAsPieces

    df = subword.encode_pieces(texts(spark, [*CORPORA[0], None]), load)
    rows = df.collect()
    assert rows[-1].pieces is None
    decoded = cleaning.decode_pieces(df.filter("text is not null").withColumnRenamed("text", "raw")).collect()
    assert [r.text for r in decoded] == [r.raw for r in decoded]


def test_lines_are_encoded_some_at_a_time(spark, monkeypatch):
    """Whatever a batch holds, a worker looks at a bounded number of words and of texts."""
    import pyarrow as pa

    lists = pa.array([[1, 2], None, [], [3] * 9, [4], [5, 6], []])
    assert [part.to_pylist() for part in subword.line_parts(lists, 3)] == [[[1, 2], None, []], [[3] * 9], [[4], [5, 6], []]]
    assert [part.to_pylist() for part in subword.line_parts(lists.slice(4), 1)] == [[[4]], [[5, 6]], [[]]]
    assert [len(part) for part in subword.line_parts(lists[:0], 3)] == [0]

    monkeypatch.setattr(subword, "TEXTS", 3)
    monkeypatch.setattr(subword, "PART_WORDS", 2)
    monkeypatch.setattr(subword, "CACHE_WORDS", 2)

    def load():
        def model(texts):
            assert len(texts) <= 3
            return [t.split(" ") for t in texts]
        return model

    rows = [(i, None if i % 5 == 4 else "" if i % 5 == 3 else f"ab{i} abab ab{i % 3}", f"b{i} ab") for i in range(40)]
    df = spark.createDataFrame(rows, "id int, text string, tgt string").coalesce(1)
    for r in subword.encode_pieces(df, load).collect():
        assert r.pieces == (None if r.text is None else r.text.split(" "))
    merges = [("a", "b"), ("▁", "ab"), ("ab", "ab")]
    ranks = {m: i for i, m in enumerate(merges)}
    both = subword.apply_bpe(df, merges, ["text", "tgt"], ["p", "q"])
    assert both.columns == ["id", "text", "tgt", "p", "q"]
    assert both._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    for r in both.collect():
        for text, pieces in ((r.text, r.p), (r.tgt, r.q)):
            assert pieces == (None if text is None else [p for w in text.split() for p in subword.segment("▁" + w, ranks)])


def test_an_outside_model_gets_each_word_once(monkeypatch):
    import tokenizers

    from registry import queries

    seen, plain = [], tokenizers.Tokenizer

    class Counting:
        def __init__(self, model):
            self.inner = plain(model)

        def encode(self, words, is_pretokenized):
            seen.extend(words)
            return self.inner.encode(words, is_pretokenized=is_pretokenized)

    monkeypatch.setattr(tokenizers, "Tokenizer", Counting)
    encode = queries._outside_model([("a", "b")], ["<unk>", "▁", "a", "b", "ab"])()
    assert encode(["ab a", " ab  xx ab", ""]) == [["▁", "ab", "▁", "a"], ["▁", "ab", "▁", "▁", "ab"], []]
    assert encode(["ab"]) == [["▁", "ab"]] and sorted(seen) == ["▁a", "▁ab", "▁xx"]


def test_words_are_learned_from_documents_without_numbering_them(spark, sf, monkeypatch):
    """The words of a text are those of its lines, also where a text is NULL, empty or ends in line breaks."""
    from registry import queries

    rows = [(1, "de", "a\nb low\n\nlower low"), (2, "de", None), (3, None, ""), (3, "en", "\n"), (None, "en", "new low\u2028newer")]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string").withColumn("source", F.lit("s"))
    monkeypatch.setattr(queries.views, "documents", lambda *a: docs)
    want = subword.learn_bpe(number_lines(docs), vocab_size=24)
    monkeypatch.setattr(queries.views, "lines", lambda *a: pytest.fail("lines are numbered"))
    merges, vocabulary = queries.learned_bpe(spark, sf, 24)
    assert merges == want[0] and vocabulary.collect() == want[1].collect()
