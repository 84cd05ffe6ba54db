import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from sentloom.operators import ledger
from sentloom.sources import sinks

SCHEMA = "experiment string, iteration bigint, direction string, metric double"
SETTINGS = dict(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def runs(spark, metrics):
    """{direction: [metric of iteration 1, 2, ...]} as a ledger."""
    rows = [("e", i + 1, d, m) for d, ms in metrics.items() for i, m in enumerate(ms)]
    return spark.createDataFrame(rows, SCHEMA)


def plain_loop(metrics, base, max_iter=8):
    """The loop as it would run: flags per (direction, iteration) and the iteration it stops at."""
    best, flags = dict(base), {}
    for it in range(1, max_iter + 1):
        improved = False
        for d in ("1n", "n1"):
            flags[d, it] = metrics[d][it - 1] >= best[d]
            if flags[d, it]:
                best[d], improved = metrics[d][it - 1], True
        if not improved:
            return flags, it
    return flags, max_iter


@settings(**SETTINGS)
@given(
    a=st.lists(st.integers(0, 5).map(float), min_size=8, max_size=8),
    b=st.lists(st.integers(0, 5).map(float), min_size=8, max_size=8),
    base=st.integers(0, 4).map(float),
)
def test_flags_and_stop_follow_the_loop(spark, a, b, base):
    metrics = {"1n": a, "n1": b}
    df = runs(spark, metrics)
    baseline = spark.createDataFrame([("e", "1n", base), ("e", "n1", base)], "experiment string, direction string, baseline double")
    flags, stop = plain_loop(metrics, {"1n": base, "n1": base})
    got = {(r.direction, r.iteration): r.accepted for r in ledger.accept_flags(df, baseline).collect()}
    assert {k: got[k] for k in flags} == flags
    assert ledger.stop_iteration(df, 8, baseline).first().stop_iteration == stop


def test_a_tie_goes_to_the_later_run(spark):
    df = runs(spark, {"1n": [3.0, 5.0, 5.0, 1.0], "n1": [2.0, float("nan"), 1.0, 2.0]})
    assert {r.direction: (r.iteration, r.metric) for r in ledger.best_run(df).collect()} == {"1n": (3, 5.0), "n1": (4, 2.0)}


def test_best_threshold_takes_the_higher_on_a_tie_and_starts_at_zero(spark):
    rows = [("e", "1n", 0.0, 7.0), ("e", "1n", 0.1, 9.0), ("e", "1n", 0.5, 9.0), ("e", "1n", 0.9, 8.0), ("e", "n1", 0.3, -1.0)]
    df = spark.createDataFrame(rows, "experiment string, direction string, threshold double, metric double")
    assert {r.direction: r.threshold for r in ledger.best_threshold(df).collect()} == {"1n": 0.5, "n1": None}


def test_gate_needs_both_directions(spark):
    schema = "experiment string, direction string, baseline double"
    baseline = spark.createDataFrame([(e, d, 5.0) for e in "xyz" for d in ("1n", "n1")], schema)
    rows = [("x", 1, "1n", 5.0), ("x", 1, "n1", 6.0), ("y", 1, "1n", 4.9), ("y", 1, "n1", 6.0), ("z", 1, "1n", 9.0)]
    got = {r.experiment: r.go_on for r in ledger.gate(spark.createDataFrame(rows, SCHEMA), baseline).collect()}
    assert got == {"x": True, "y": False, "z": False}


def test_write_result(spark, tmp_path):
    path = sinks.write_result(runs(spark, {"1n": [3.0, 3.0], "n1": [2.0]}), str(tmp_path / "r"))
    found = [json.loads(line) for f in (tmp_path / "r").glob("part-*") for line in f.read_text().splitlines()]
    assert {(r["direction"], r["iteration"]) for r in found} == {("1n", 2), ("n1", 1)}
    assert path.endswith("/r")


def test_a_metric_that_is_no_number_sets_no_bar(spark):
    nan = float("nan")
    df = runs(spark, {"1n": [20.0, nan, 30.0, None, 29.0], "n1": [nan, 1.0, 1.0, nan, 0.5]})
    got = {(r.direction, r.iteration): r.accepted for r in ledger.accept_flags(df).collect()}
    assert [got["1n", i] for i in range(1, 6)] == [True, False, True, False, False]
    assert [got["n1", i] for i in range(1, 6)] == [False, True, True, False, False]
    baseline = spark.createDataFrame([("e", "1n", nan), ("e", "n1", 5.0)], "experiment string, direction string, baseline double")
    got = {(r.direction, r.iteration): r.accepted for r in ledger.accept_flags(df, baseline).collect()}
    assert got["1n", 1] and not any(got["n1", i] for i in range(1, 6))
    assert ledger.stop_iteration(df, 8).first().stop_iteration == 4
