import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from sentloom.operators import lookup
from sentloom.operators import vocabulary as v
from sentloom.operators.lookup import lookup_array


def pieces(spark, *rows):
    return spark.createDataFrame([(i + 1, r.split() if r is not None else None) for i, r in enumerate(rows)], "line_no bigint, pieces array<string>")


def test_dictionary_orders_counts_and_pads(spark):
    df = pieces(spark, "b a a", "c __en_XX__ <s> b")
    rows = v.build_dictionary(df, ["en_XX", "de_DE"]).orderBy("token_id").collect()
    got = [(r.token, r["count"], r.token_id) for r in rows]
    # Ties by token; a symbol the corpus has already gets one more; special symbols stay out.
    assert got[:5] == [("__en_XX__", 2, 4), ("a", 2, 5), ("b", 2, 6), ("__de_DE__", 1, 7), ("c", 1, 8)]
    # 9 symbols + 3 extra -> 4 fillers to 16; 13 symbols -> 3 more to 16.
    assert got[5:] == [(f"madeupword{i:04d}", 0, 9 + i) for i in range(7)]
    assert (len(got) + 4) % 8 == 0


@pytest.mark.parametrize("n", range(9))
def test_dictionary_size_is_a_multiple(spark, n):
    df = pieces(spark, " ".join(f"w{i}" for i in range(n)))
    rows = v.build_dictionary(df, ["aa"], pad_to=8).collect()
    assert (len(rows) + 4) % 8 == 0
    assert sorted(r.token_id for r in rows) == list(range(4, 4 + len(rows)))


@pytest.fixture
def vocab(spark):
    return spark.createDataFrame([("a", 0), ("b", 1), ("▁c", 2)], "token string, token_id bigint")


# Both ways of looking up: table sent to the executors, and table joined.
@pytest.mark.parametrize("max_rows", [1000, 0])
def test_ids_keep_order_repeats_empty_and_null_rows(spark, vocab, max_rows):
    df = pieces(spark, "a b a zzz", "", None, "b " * 50)
    rows = v.ids_from_vocab(df, vocab, unk_id=9, max_rows=max_rows).orderBy("line_no").collect()
    assert [r.ids for r in rows] == [[0, 1, 0, 9], [], None, [1] * 50]
    with_end = v.ids_from_vocab(df, vocab, unk_id=9, eos_id=2, max_rows=max_rows).orderBy("line_no").first()
    assert with_end.ids == [0, 1, 0, 9, 2]


@pytest.mark.parametrize("max_rows", [1000, 0])
def test_decode_ids(spark, vocab, max_rows):
    df = spark.createDataFrame([(1, "2 0 <<unk>> 1"), (2, "7"), (3, "")], "line_no bigint, id_text string")
    rows = v.decode_ids(df, vocab, max_rows=max_rows).orderBy("line_no").collect()
    assert [r.text for r in rows] == ["caab", "<unk>", ""]


def test_mapping_and_embeddings(spark, vocab):
    new = spark.createDataFrame([("b", 0), ("new", 1), ("a", 2), ("other", 3)], "token string, token_id bigint")
    mapping = v.map_vocabulary(new, vocab, unk_id=2)
    assert {r.token: r.src_id for r in mapping.collect()} == {"b": 1, "new": 2, "a": 0, "other": 2}
    emb = spark.createDataFrame([(i, [float(i), i / 2]) for i in range(3)], "token_id bigint, embedding array<float>")
    got = {r.token_id: r.embedding for r in v.trim_embeddings(emb, mapping, unk_id=2).collect()}
    assert got == {0: [1.0, 0.5], 1: [2.0, 1.0], 2: [0.0, 0.0], 3: [2.0, 1.0]}


def test_every_token_has_an_embedding_or_it_is_an_error(spark):
    mapping = spark.createDataFrame([(0, 1), (1, 7), (2, 0), (3, None)], "token_id bigint, src_id bigint")
    emb = spark.createDataFrame([(i, [float(i)]) for i in range(3)], "token_id bigint, embedding array<float>")
    with pytest.raises(Exception, match="no embedding for id"):
        v.trim_embeddings(emb, mapping, unk_id=0).collect()
    got = {r.token_id: r.embedding for r in v.trim_embeddings(emb, mapping, unk_id=0, missing="unk").collect()}
    assert got == {0: [1.0], 1: [0.0], 2: [0.0], 3: [0.0]}
    with pytest.raises(Exception, match="no embedding for id"):
        v.trim_embeddings(emb.filter("token_id > 0"), mapping.filter("token_id = 2"), unk_id=0, missing="unk").collect()
    with pytest.raises(ValueError):
        v.trim_embeddings(emb, mapping, missing="drop")


ELEMENTS = st.one_of(st.none(), st.sampled_from(["a", "b", "c", "d", ""]))
ROWS = st.lists(st.tuples(st.integers(1, 2), st.one_of(st.none(), st.lists(ELEMENTS, max_size=5))), max_size=6)
TABLES = st.dictionaries(st.sampled_from(["a", "b", "c", "x", ""]), st.one_of(st.none(), st.integers(0, 5)), max_size=5)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=ROWS, table=TABLES)
def test_both_ways_of_a_lookup_agree(spark, rows, table):
    """Repeated row numbers, NULL arrays and elements, NULL values: the same result below and above the limit."""
    df = spark.createDataFrame(rows, "line_no int, w array<string>")
    entries = spark.createDataFrame([*table.items(), (None, 9)], "key string, value int")
    want = sorted((n, None if w is None else [table[e] if table.get(e) is not None else -1 for e in w]) for n, w in rows) if all(
        w is not None for _, w in rows) else None
    got = [
        sorted(((r.line_no, r.w, r.v) for r in lookup_array(df, "w", "v", entries, -1, "int", **limit).collect()), key=str)
        for limit in ({}, {"max_rows": 0}, {"max_bytes": 0})
    ]
    assert got[0] == got[1] == got[2]
    assert len(got[0]) == len(rows)
    for _, w, v_ in got[0]:
        assert v_ == (None if w is None else [table[e] if e is not None and table.get(e) is not None else -1 for e in w])
    assert want is None or sorted((n, v_) for n, _, v_ in got[0]) == want


@pytest.mark.parametrize("max_rows", [1000, 0])
def test_a_key_with_two_entries_is_an_error(spark, max_rows):
    df = spark.createDataFrame([(1, ["a"])], "line_no int, w array<string>")
    twice = spark.createDataFrame([("a", 1), ("a", 1)], "key string, value int")
    with pytest.raises(ValueError, match="more than one entry"):
        lookup_array(df, "w", "v", twice, 0, "int", max_rows=max_rows)


def test_frequent_and_rare_keys_of_a_large_lookup(spark, monkeypatch):
    """Frequent keys are looked up apart; here the limit makes some of each."""
    monkeypatch.setattr(lookup, "FREQUENT", 4)
    rows = [(i % 3, ["hot", f"w{i}", "hot", None, f"w{i % 7}"]) for i in range(60)]
    df = spark.createDataFrame(rows, "line_no int, w array<string>")
    table = {"hot": -5, **{f"w{i}": i for i in range(0, 60, 2)}}
    entries = spark.createDataFrame(list(table.items()), "key string, value int")
    for r in lookup_array(df, "w", "v", entries, -1, "int", max_rows=0).collect():
        assert r.v == [table.get(e, -1) for e in r.w]


def test_frequent_keys_are_not_shuffled_with_the_rare_ones(spark, monkeypatch):
    monkeypatch.setattr(lookup, "FREQUENT", 4)
    df = spark.createDataFrame([(i, ["hot", f"w{i}"]) for i in range(20)], "line_no int, w array<string>")
    entries = spark.createDataFrame([("hot", 1), ("w3", 2)], "key string, value int")
    found = lookup_array(df, "w", "v", entries, 0, "int", max_rows=0)
    assert "LeftAnti" in found._jdf.queryExecution().optimizedPlan().toString()
    assert {r.line_no: r.v for r in found.collect()} == {i: [1, 2 if i == 3 else 0] for i in range(20)}


def test_a_prepared_vocabulary_is_written_once(spark, monkeypatch):
    written = []
    real = lookup.stage
    monkeypatch.setattr(lookup, "stage", lambda df, label: written.append(label) or real(df, label))
    vocab = spark.createDataFrame([("a", 5), ("b", 6)], "token string, token_id bigint")
    df = spark.createDataFrame([(1, ["a", "x"]), (2, ["b"]), (3, None)], "line_no int, pieces array<string>")
    for max_rows in (10, 0):
        known = v.vocabulary_lookup(vocab, max_rows)
        assert (known.shared is None) == (max_rows == 0)
        for _ in range(3):
            assert {r.line_no: r.ids for r in v.ids_from_vocab(df, known).collect()} == {1: [5, v.UNK_ID], 2: [6], 3: None}
    assert written.count("lookup") == 2
