"""The Merkle manifest against a plain tree, with blocks of several sizes and odd rows."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from sentloom.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def plain(rows, changed):
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of each row, by hand."""
    leaf = lambda r: h(*map(field, r))

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([h(*out[-1][i:i + 3]) for i in range(0, len(out[-1]), 3)])
        return out

    def path(tree, pos):
        for nodes in tree[:-1]:
            start = pos // 3 * 3
            yield nodes[start:pos], nodes[pos + 1:start + 3]
            pos //= 3

    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[s] = levels([leaf(r) for r in groups[s]])
    crown = levels([trees[s][-1][0] for s in order])
    out = []
    for at, s in enumerate(order):
        for pos, r in enumerate(groups[s]):
            steps = [*path(trees[s], pos), *path(crown, at)]
            acc = leaf(changed(r) or r)
            for before, after in steps:
                acc = h(*before, acc, *after)
            proof = h(*[x for before, after in steps for x in [*before, *after]])
            out.append((r[0], leaf(r), trees[s][-1][0], crown[-1][0], proof, acc, acc == crown[-1][0]))
    return sorted(out, key=str)


def shortened(r):
    if r[0] is None or zlib.crc32(str(r[0]).encode()) % 2:
        return None
    return (*r[:4], None if r[4] is None else r[4].replace("\n", ""))


def manifest(spark, rows, schema=SCHEMA):
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    out = merkle.merkle_manifest(spark.createDataFrame(rows, schema), {"text": merkle.without_line_breaks(F.col("text"))}, even)
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in out.select(names).collect()), key=str)


@pytest.mark.parametrize("levels", [1, 2, 6])
def test_against_a_plain_tree(spark, monkeypatch, levels):
    monkeypatch.setattr(merkle, "LEVELS", levels)
    monkeypatch.setattr(merkle, "BLOCK", 3 ** levels)
    rng = random.Random(levels)
    sizes = {"big": 61, "b": 1, "": 2, None: 10, "é": 3, "z": 4, "a": 9, "B": 28}
    rows = [
        (i, s, rng.choice(["en", None]), rng.choice([None, 5]), rng.choice([None, "", "x", "a\nb\n", "ü\n🙂", "long " * 50]))
        for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))
    ]
    rng.shuffle(rows)
    assert manifest(spark, rows) == plain(rows, shortened)


def test_repeated_rows_null_ids_and_other_columns(spark):
    rows = [(1, "s", "en", 3, "a\nb")] * 5 + [(None, "s", None, None, None)] * 3 + [(1, "s", "en", 3, "other"), (2, None, "", 0, "")]
    assert manifest(spark, rows) == plain(rows, shortened)
    wide = [(*r, "g", 1, {"k": "v"}) for r in rows]
    assert manifest(spark, wide, SCHEMA + ", grp string, Salt int, d0 map<string,string>") == plain(rows, shortened)


def test_small_tables(spark):
    assert manifest(spark, []) == []
    one = [(4, "s", None, None, "x\n")]
    (doc_id, leaf, subroot, root, proof, folded, ok), = manifest(spark, one)
    assert leaf == subroot == root and proof == hashlib.sha256(b"").hexdigest()
    assert manifest(spark, one) == plain(one, shortened)
    untouched = merkle.merkle_manifest(spark.createDataFrame([(i, "s", "en", 1, "t\n") for i in range(10)], SCHEMA))
    assert all(r["verified"] for r in untouched.collect())
