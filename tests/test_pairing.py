from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from sentloom.operators import pairing

SETTINGS = dict(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def lines(spark, texts):
    return spark.createDataFrame([(i + 1, t) for i, t in enumerate(texts)], "line_no bigint, text string")


@settings(**SETTINGS)
@given(n=st.integers(0, 6), m=st.integers(0, 6))
def test_pad_is_the_longer_and_truncate_the_shorter(spark, n, m):
    src, tgt = lines(spark, [f"s{i}" for i in range(n)]), lines(spark, [f"t{i}" for i in range(m)])
    padded = pairing.pair_by_line(src, tgt, "pad").orderBy("line_no").collect()
    assert [r.line_no for r in padded] == list(range(1, max(n, m) + 1))
    assert [r.src for r in padded] == [f"s{i}" if i < n else "" for i in range(max(n, m))]
    assert [r.tgt for r in padded] == [f"t{i}" if i < m else "" for i in range(max(n, m))]
    assert pairing.pair_by_line(src, tgt, "truncate").count() == min(n, m)


def test_attach_and_missing(spark):
    src = spark.createDataFrame([(2, "b"), (10, "j"), (7, "g")], "sent_id bigint, src string")
    hyps = spark.createDataFrame([(10, "J"), (2, "B"), (99, "?")], "sent_id bigint, hyp string")
    assert {r.sent_id: r.hyp for r in pairing.attach_hypotheses(src, hyps).collect()} == {2: "B", 10: "J"}
    assert pairing.missing_hypotheses(src, hyps).first().missing == 1


def test_missing_corpora(spark):
    config = spark.createDataFrame([("a",), ("b",)], "corpus string")
    df = spark.createDataFrame([("a",), ("a",), ("c",)], "corpus string")
    assert [r.corpus for r in pairing.missing_corpora(config, df).collect()] == ["b"]
