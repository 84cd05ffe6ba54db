import dataclasses
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from sentloom.functions import text as tx
from sentloom.operators import ledger, scoring, synthesis
from sentloom.plans import classifier, experiment
from sentloom.sources import staging

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def reverse():
    return lambda texts: [" ".join(reversed(t.split(" "))) for t in texts]


def with_words(df):
    return df.withColumn("pieces", tx.words("text"))


def mono(spark, name, n):
    return spark.createDataFrame(
        [(i, f"{name} {i} " + "w " * (i % 4)) for i in range(1, n + 1)], "line_no bigint, text string"
    )


def test_translate_keeps_rows_and_checks_the_model(spark):
    df = mono(spark, "x", 20).repartition(3)
    got = synthesis.translate(df, reverse).collect()
    assert len(got) == 20 and all(r.hyp == " ".join(reversed(r.text.split(" "))) for r in got)
    with pytest.raises(Exception, match="returned 0 texts"):
        synthesis.translate(df, lambda: lambda texts: []).collect()


def test_synthesize_takes_short_non_blank_lines_of_the_prefix(spark):
    df = spark.createDataFrame([(1, "a b"), (2, "a b c d"), (3, "  "), (4, "c"), (5, "d")], "line_no bigint, text string")
    got = {r.line_no: (r.original, r.synthetic) for r in synthesis.synthesize(df, reverse, with_words, 4, 3).collect()}
    assert got == {1: ("a b", "b a"), 4: ("c", "c")}
    # Without limits the whole corpus but its blank lines.
    assert sorted(r.line_no for r in synthesis.synthesize(df, reverse, with_words).collect()) == [1, 2, 4, 5]


class Script:
    """A trainer that returns scripted metrics and remembers what it was given."""

    def __init__(self, metrics, baseline=10.0):
        self.metrics, self.base, self.seen, self.calls = metrics, baseline, {}, 0

    def train(self, direction, stage, data, start_model):
        self.calls += 1
        self.seen[stage, direction] = (data.count(), start_model)
        return f"model-{stage}-{direction}", self.metrics.get((stage, direction), 0.0)

    def callbacks(self):
        return experiment.Callbacks(
            train=self.train, baseline=lambda d: self.base, translator=lambda ref: reverse,
            encode=with_words, scorer=scoring.length_ratio_scorer,
        )


@pytest.fixture(scope="module")
def corpora(spark):
    parallel = spark.createDataFrame([(1, "a b", "c d"), (2, "e", "f")], "line_no bigint, l1 string, l2 string")
    return parallel, {"l1": mono(spark, "one", 30), "l2": mono(spark, "two", 30)}


def refine(spark, corpora, script, workdir, **kw):
    run = experiment.Refinement(spark, "test", str(workdir), *corpora, script.callbacks(), unit=5)
    return run.run(thresholds=(0.0, 0.5), **kw)


def test_stops_before_the_loop_if_one_direction_does_not_improve(spark, corpora, tmp_path):
    script = Script({("first", "1n"): 10.0, ("first", "n1"): 9.9})
    out = refine(spark, corpora, script, tmp_path)
    assert out.synthetic is None and out.stopped_at is None
    assert script.calls == 2
    assert out.best == {"1n": 10.0, "n1": 10.0} and out.model == {"1n": "model-first-1n", "n1": None}


def test_accepts_ties_rejects_and_stops(spark, corpora, tmp_path):
    script = Script({
        ("first", "1n"): 11.0, ("first", "n1"): 12.0,
        # 1n: the tie goes to the higher threshold; n1: the best threshold does not beat the first model.
        ("score_0.0", "1n"): 13.0, ("score_0.5", "1n"): 13.0, ("score_0.0", "n1"): 8.0, ("score_0.5", "n1"): 7.0,
        ("it_1", "1n"): 13.0, ("it_1", "n1"): 11.9,  # a tie is accepted, the other rejected
        ("it_2", "1n"): 12.9, ("it_2", "n1"): 11.0,  # neither: stop
    })
    out = refine(spark, corpora, script, tmp_path)
    assert out.threshold == {"1n": 0.5, "n1": 0.0}
    assert out.best == {"1n": 13.0, "n1": 12.0}
    assert out.model == {"1n": "model-it_1-1n", "n1": "model-first-n1"}
    assert out.stopped_at == 2
    # The first stage sees the parallel pairs; iterations add 10 lines (loop start), then 15 (iteration 1).
    assert script.seen["first", "1n"] == (2, None)
    assert script.seen["it_1", "1n"] == (12, "model-score_0.5-1n")
    assert script.seen["it_1", "n1"] == (17, "model-first-n1")
    assert script.seen["it_2", "1n"] == (12, "model-it_1-1n")
    kinds = {(r.l1_origin, r.l2_origin): r.n for r in out.synthetic.groupBy("l1_origin", "l2_origin").agg(F.count("*").alias("n")).collect()}
    assert kinds == {("synthetic", "original"): 10, ("original", "synthetic"): 15}
    # The ledger leads to the same decisions.
    loop = out.ledger.filter("stage like 'it_%'")
    baseline = spark.createDataFrame([("test", "1n", 13.0), ("test", "n1", 12.0)], "experiment string, direction string, baseline double")
    assert ledger.stop_iteration(loop, 8, baseline).first().stop_iteration == 2
    # A second run finds every stage: nothing is trained again, the outcome is the same.
    again = Script({})
    same = refine(spark, corpora, again, tmp_path)
    assert again.calls == 0
    assert (same.best, same.model, same.threshold, same.stopped_at) == (out.best, out.model, out.threshold, 2)


def test_changed_settings_and_inputs_make_the_stages_after_them_anew(spark, corpora, tmp_path):
    parallel, mono_tables = corpora
    metrics = {(s, d): 20.0 for s in ("first", "score_0.0", "score_0.5", "score_0.9", "it_1") for d in ("1n", "n1")}

    def run(script, parallel=parallel, mono_tables=mono_tables, thresholds=(0.0,), version=""):
        callbacks = dataclasses.replace(script.callbacks(), version=version)
        return experiment.Refinement(spark, "test", str(tmp_path), parallel, mono_tables, callbacks).run(thresholds, max_iter=1)

    first = Script(metrics)
    run(first)
    assert set(first.seen) == {(s, d) for s in ("first", "score_0.0", "it_1") for d in ("1n", "n1")}
    again = Script({})
    assert run(again).best == {"1n": 20.0, "n1": 20.0} and again.calls == 0
    # Another threshold: another search and other iterations, the same first stage and translations.
    other = Script(metrics)
    out = run(other, thresholds=(0.9,))
    assert set(other.seen) == {(s, d) for s in ("score_0.9", "it_1") for d in ("1n", "n1")}
    assert out.threshold == {"1n": 0.9, "n1": 0.9}
    assert {r["threshold"] for r in out.ledger.filter("stage = 'it_1'").collect()} == {0.9}
    # Another corpus in language 1: it is translated anew and trains n1, and what builds on that.
    changed = Script(metrics)
    run(changed, mono_tables={**mono_tables, "l1": mono(spark, "other", 30)})
    assert ("first", "1n") not in changed.seen and ("score_0.0", "1n") not in changed.seen
    assert {("score_0.0", "n1"), ("it_1", "n1")} <= set(changed.seen)
    # Another parallel corpus or other callbacks: everything.
    for kw in ({"parallel": parallel.filter("line_no = 1")}, {"version": "2"}):
        everything = Script(metrics)
        run(everything, **kw)
        assert set(everything.seen) == set(first.seen)
    # The first settings again: all there.
    back = Script({})
    run(back)
    assert back.calls == 0


def test_a_stage_without_its_manifest_is_built_again(spark, tmp_path):
    built = []
    build = lambda: built.append(1) or spark.range(3)
    for _ in range(2):
        assert staging.materialize_named(spark, build, str(tmp_path), {"a": 1}).count() == 3
    assert len(built) == 1
    (tmp_path / staging.manifest_key({"a": 1}) / "_manifest.json").unlink()
    assert staging.materialize_named(spark, build, str(tmp_path), {"a": 1}).count() == 3 and len(built) == 2
    assert staging.materialize_named(spark, build, str(tmp_path), {"a": 2}).count() == 3 and len(built) == 3


def test_the_key_of_a_table_is_its_contents(spark):
    rows = [(1, "a", None), (2, None, 1.5), (2, None, 1.5), (3, "", float("nan"))]
    kind = "id bigint, text string, x double"
    key = staging.content_key(spark.createDataFrame(rows, kind))
    assert key == staging.content_key(spark.createDataFrame(rows[::-1], kind).repartition(3))
    for other in (rows[:-1], [*rows, rows[1]], [*rows[:3], (3, None, float("nan"))], [(1, "b", None), *rows[1:]]):
        assert key != staging.content_key(spark.createDataFrame(other, kind))
    assert key != staging.content_key(spark.createDataFrame(rows, kind).withColumnRenamed("x", "y"))
    assert staging.content_key(spark.createDataFrame([], kind)) != staging.content_key(spark.createDataFrame([], "id bigint"))


def test_a_sweep_that_nothing_passes(spark, corpora, tmp_path):
    metrics = {(s, d): 20.0 for s in ("first", "score_1.0", "it_1") for d in ("1n", "n1")}
    run = experiment.Refinement(spark, "test", str(tmp_path), *corpora, Script(metrics).callbacks())
    out = run.run(thresholds=(1.0,), max_iter=1)
    assert out.synthetic.columns == ["line_no", "l1", "l2", "l1_origin", "l2_origin"] and out.synthetic.collect() == []
    assert out.stopped_at == 1


def test_synthetic_pairs_are_written_when_the_last_iteration_still_improved(spark, corpora, tmp_path):
    metrics = {(s, d): 20.0 for s in ("first", "score_0.0", "score_0.5", "it_1") for d in ("1n", "n1")}
    out = refine(spark, corpora, Script(metrics), tmp_path, max_iter=1)
    assert out.stopped_at == 1 and out.synthetic.count() == 30


def test_the_whole_corpus_is_the_default_and_a_metric_that_is_no_number_never_wins(spark, corpora, tmp_path):
    nan = float("nan")
    script = Script({("first", "1n"): 20.0, ("first", "n1"): 20.0, ("score_0.0", "1n"): nan, ("score_0.5", "1n"): 21.0,
                     ("it_1", "1n"): nan, ("it_1", "n1"): nan})
    run = experiment.Refinement(spark, "test", str(tmp_path), *corpora, script.callbacks())
    out = run.run(thresholds=(0.0, 0.5))
    assert out.best == {"1n": 21.0, "n1": 20.0} and out.stopped_at == 1
    assert script.seen["it_1", "1n"][0] == 32  # two parallel pairs and all thirty lines


def test_run_experiment_from_files(spark, tmp_path):
    """Named corpora in, a trained scorer, and the ledger out."""
    def write(name, lines):
        (tmp_path / name).write_text("".join(f"{x}\n" for x in lines))

    numbers = "one two three four five six seven eight nine ten".split()
    text = lambda lang, i: f"{numbers[i % 10]} {i} " + f"{lang} " * (i % 9) + "."
    for name, ids in (("train", range(120)), ("more", range(120, 200)), ("dev", range(200, 260)), ("mono", range(300, 320))):
        for lang in ("en", "de"):
            write(f"{name}.{lang}", [text(lang, i) if i % 50 else "" for i in ids])
    script = Script({("first", "1n"): 20.0, ("first", "n1"): 20.0})
    config = experiment.Config(
        "files", str(tmp_path), str(tmp_path / "work"), ("en", "de"), ["more", "train"], {"en": ["mono"], "de": ["mono"]},
        ["train", "more"], ["dev"], thresholds=(0.0,), max_iter=1,
    )
    callbacks = experiment.Callbacks(script.train, lambda d: 10.0, lambda ref: reverse, with_words)
    out = experiment.run_experiment(spark, config, callbacks)
    assert out.best == {"1n": 20.0, "n1": 20.0} and out.stopped_at == 1
    assert script.seen["first", "1n"][0] == 200
    data = classifier.classifier_data(spark, str(tmp_path), ["train", "more"], ["dev"], "en", "de", max_pairs=50)
    assert data.train.count() == 50 and data.dev.count() == 58
    with pytest.raises(ValueError, match="no corpus in en for: gone"):
        classifier.classifier_data(spark, str(tmp_path), ["gone"], ["dev"], "en", "de")
