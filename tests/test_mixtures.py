import pytest

from sentloom.operators import mixtures
from sentloom.plans.student import student_pairs


def lines(spark, *rows):
    return spark.createDataFrame(rows, "line_no bigint, text string")


def test_concatenation_keeps_order_and_duplicates(spark):
    parts = [lines(spark, (2, "b"), (1, "a")), lines(spark, (1, "a")), spark.createDataFrame([], "line_no bigint, text string"), lines(spark, (3, "z"), (1, "x"))]
    got = sorted((r.line_no, r.text) for r in mixtures.concat_corpora(parts).collect())
    assert got == [(1, "a"), (2, "b"), (3, "a"), (4, "x"), (6, "z")]


def test_augment_puts_synthetic_sources_after_the_parallel_pairs(spark):
    schema = "line_no bigint, src string, tgt string"
    parallel = spark.createDataFrame([(1, "a", "A"), (2, "", "B"), (3, "c", "C")], schema)
    made = spark.createDataFrame([(1, "x", "X"), (2, "y", " ")], schema)
    rows = {r.line_no: (r.src, r.tgt, r.src_origin, r.tgt_origin) for r in mixtures.augment(parallel, made).collect()}
    assert rows == {
        1: ("a", "A", "original", "original"), 3: ("c", "C", "original", "original"), 4: ("x", "X", "synthetic", "original"),
    }


# Which synthetic pairs each student reads: (l1 synthetic, l2 original), (l1 original, l2 synthetic).
TABLE = {
    ("back", "1n"): (True, False), ("back", "n1"): (False, True),
    ("forward", "1n"): (False, True), ("forward", "n1"): (True, False),
    ("all", "1n"): (True, True), ("all", "n1"): (True, True),
}


@pytest.mark.parametrize("student", TABLE)
def test_mixtures(spark, student):
    parallel = spark.createDataFrame([(1, "p1", "p2")], "line_no bigint, l1 string, l2 string")
    synthetic = spark.createDataFrame(
        [(1, "s1", "o2", "synthetic", "original"), (1, "o1", "s2", "original", "synthetic")],
        "line_no bigint, l1 string, l2 string, l1_origin string, l2_origin string",
    )
    so, os = TABLE[student]
    got = [r.l1 for r in mixtures.mixture(parallel, synthetic, *student).orderBy("line_no").collect()]
    assert got == ["p1"] + ["s1"] * so + ["o1"] * os
    pairs = student_pairs(parallel, synthetic, *student).orderBy("line_no").first()
    assert (pairs.src, pairs.tgt) == (("p1", "p2") if student[1] == "1n" else ("p2", "p1"))


def test_joint_text(spark):
    df = spark.createDataFrame([("a", "b"), ("a", "c")], "src string, tgt string")
    assert sorted(r.text for r in mixtures.joint_text(df).collect()) == ["a", "a", "b", "c"]
