"""Byte pairs over a trie against the library that the vocabulary file belongs to."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from sentloom.llm import bpe_trie, queries

ALPHABETS = [
    "ab", " a", "a \n", "the an'sre  ", "-=_ ", "\t\n ab1!", "ée🙂日本  　\x85x'", "01 9a", "<|endoftext|>", "abcdefghijklmnopqrstuvwxyz  '", "\x1c\x1d a",
]


@pytest.fixture(scope="module")
def path():
    return queries.tokenizer_path()


@pytest.fixture(scope="module")
def vocabulary(path):
    return bpe_trie.read_vocabulary(path)


def texts(seed):
    rng = random.Random(seed)
    out = ["".join(rng.choices(rng.choice(ALPHABETS), k=rng.randrange(60))) for _ in range(1500)]
    out += ["".join(chr(rng.choice([rng.randrange(0x3000), rng.randrange(0xD800), rng.randrange(0xE000, 0x110000)])) for _ in range(40)) for _ in range(500)]
    return out + ["", "<|endoftext|>" * 3 + " x", " <|endoftext|> ", "a" * 3000, " " * 500 + "a" + " " * 300, "it's I'LL we're"]


@pytest.mark.parametrize("seed, remembered", [(1, 300_000), (2, 100)])
def test_same_ids_as_the_library(vocabulary, path, monkeypatch, seed, remembered):
    monkeypatch.setattr(bpe_trie, "KNOWN_CHUNKS", remembered)
    monkeypatch.setattr(bpe_trie, "KNOWN_PAIRS", remembered)
    monkeypatch.setattr(bpe_trie, "SLICE", 5000)
    library, rows = Tokenizer.from_file(path), texts(seed)
    want = [e.ids for e in library.encode_batch(rows, add_special_tokens=False)]
    tables = vocabulary.tables
    packed = [p for out in tables.encode(iter([pa.array(rows, pa.string())])) for p in out.to_pylist()]
    assert [np.frombuffer(p, "<u4").tolist() for p in packed] == want
    decoded = [t for out in tables.decode(iter([pa.array(packed, pa.binary())])) for t in out.to_pylist()]
    assert decoded == [library.decode(ids, skip_special_tokens=False) for ids in want]


def test_ids_that_are_no_text(vocabulary, path):
    """Half characters and unknown ids decode as in the library."""
    library, rng = Tokenizer.from_file(path), random.Random(5)
    rows = [[rng.randrange(50257) for _ in range(20)] for _ in range(300)] + [[50256, 220, 99_999_999], []]
    packed = pa.array([np.array(r, "<u4").tobytes() for r in rows] + [None], pa.binary())
    out = next(vocabulary.tables.decode(iter([packed]))).to_pylist()
    assert out == [library.decode(r, skip_special_tokens=False) for r in rows] + [None]


def test_shared_prefixes_are_computed_once(vocabulary, monkeypatch):
    tables, seen = vocabulary.tables, []
    words = [w + end for w in ("interest", "interested", "interesting") for end in ("", "s", "ly")]

    class Spy(list):
        def __getitem__(self, state):
            seen.append(state)
            return super().__getitem__(state)

    monkeypatch.setattr(tables, "ending", Spy(tables.ending))
    tables.encode_words(words)
    assert len(seen) == len({w[:i] for w in words for i in range(1, len(w) + 1)})


def test_documents(spark, sf, path):
    library = Tokenizer.from_file(path)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    want = {}
    for r in docs.select("doc_id", "text").collect():
        ids = library.encode(r["text"], add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want[r["doc_id"]] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    got = queries.QUERIES["op13_bpe"](spark, sf)
    assert got.dtypes == [("doc_id", "bigint"), ("n_tokens", "bigint"), ("ids_sha256", "string"), ("decoded_sha256", "string")]
    assert {r[0]: tuple(r)[1:] for r in got.collect()} == want


def test_odd_rows(spark, path):
    rows = [(1, None, "x", 1), (1, None, "x", 1), (None, "", "y", 2), (2, "word " * 100_000, None, None), (3, "<|endoftext|>", "", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, IDS string, Decoded int")
    out = bpe_trie.encode_documents(docs, path)
    assert out.columns == ["doc_id", "text", "ids", "decoded"]
    got = sorted(((r["doc_id"], r["text"] or "", len(r["ids"]) // 4, r["decoded"]) for r in out.collect()), key=str)
    assert [(g[0], g[2]) for g in got] == sorted([(1, 0), (1, 0), (None, 0), (2, 100_001), (3, 1)], key=str)
    assert all(g[1] == g[3] for g in got)
    assert bpe_trie.encode_documents(docs.limit(0), path).collect() == []
    numbers = out.where("doc_id = 3").select(bpe_trie.unpacked(out["ids"]).alias("n")).first()["n"]
    assert numbers == [50256]


def test_other_kinds_of_files_are_refused(path):
    with pytest.raises(ValueError):
        bpe_trie.read_vocabulary(path.replace("byte_bpe_50k", "word_bpe_49k"))


def test_ids_and_texts_come_from_one_worker(spark, path):
    """A worker each for encoding and decoding held the batches and the tables twice."""
    docs = spark.createDataFrame([(1, "a b"), (2, None), (3, "")], "doc_id long, text string")
    out = bpe_trie.encode_documents(docs, path).selectExpr("doc_id", "sha2(ids, 256) i", "octet_length(ids) n", "decoded", "sha2(cast(decoded as binary), 256) d")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    assert [(r.doc_id, r.n, r.decoded) for r in out.orderBy("doc_id").collect()] == [(1, 8, "a b"), (2, 0, ""), (3, 0, "")]
