"""Byte-pair queries with the reference's 10,000 pieces."""

import random

import pytest

from registry.queries import QUERIES
from sentloom.operators import subword
from test_subword import CORPORA, plain_bpe, texts


def pieces(df):
    return [r.piece for r in df.orderBy("piece_id").collect()]


def test_ten_thousand_pieces_start_with_those_that_sql_learns(spark, sf):
    few, full = pieces(QUERIES["learn_bpe"](spark, sf)), pieces(QUERIES["learn_bpe_full"](spark, sf))
    assert len(full) == len(set(full)) == subword.DEFAULT_VOCAB_SIZE == 10_000
    merged = [p for p in few[3:] if len(p) > 1]
    assert full[:3 + len(merged)] == few[:3 + len(merged)]


@pytest.mark.parametrize("name", ["apply_bpe", "encode_pieces_model"])
def test_long_pieces_are_used_and_give_the_text_back(spark, sf, name):
    few, full = ({(r.lang, r.line_no): r.pieces for r in QUERIES[n](spark, sf).collect()} for n in (name, f"{name}_full"))
    assert few.keys() == full.keys()
    assert all(few[k].replace(" ", "") == full[k].replace(" ", "") for k in few)
    assert sum(len(t.split(" ")) for t in full.values()) < 0.6 * sum(len(t.split(" ")) for t in few.values())


def test_student_ids_come_from_the_large_vocabulary(spark, sf):
    few, full = ({i for r in QUERIES[n](spark, sf).collect() for i in r.src_ids.split(" ")} for n in ("prepare_student", "prepare_student_full"))
    assert len(few) <= 128 < 1000 < len(full)


@pytest.mark.parametrize("max_piece", [None, 4])
def test_phases_with_long_pieces_and_rare_characters_left_out(spark, max_piece, monkeypatch):
    r = random.Random(3)
    rows = [*CORPORA[1], "a\U0001f600b \U0001f600b", *("".join(r.choice("abcd  ") for _ in range(60)) for _ in range(20))]
    chars = {c for t in rows for w in t.split() for c in "▁" + w}
    df, size = texts(spark, rows), len(chars) + 3 + 8
    one, _ = subword.learn_bpe(df, size, max_piece=max_piece, coverage=0.999)
    for name, value in (("LEADING", 2), ("RUN_SYMBOLS", 30), ("BLOCK_SYMBOLS", 64)):
        monkeypatch.setattr(subword, name, value)
    assert one and subword.learn_bpe(df, size, max_piece=max_piece, coverage=0.999)[0] == one
    if max_piece is None:
        assert subword.learn_bpe(df, size)[0] == plain_bpe(rows, 8)[0]
