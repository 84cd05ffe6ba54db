"""The two-direction refinement: first fine-tune, threshold search, iterations.

Training, decoding and scoring models belong to the user and come in as callbacks.
Everything around them is DataFrames; what must survive a restart is written by
stage and found again on the next run. Directions are ``1n`` (language 1 to 2) and
``n1``. Synthetic pairs come in two kinds: ``so`` (language 1 synthetic, language 2
original) trains ``1n``, ``os`` trains ``n1``.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sentloom import schema
from sentloom.operators.cleaning import filter_by_score
from sentloom.operators.ledger import best_threshold
from sentloom.operators.mixtures import ORIGINS, augment, last_lines
from sentloom.operators.sampling import prefix_for
from sentloom.operators.scoring import PairClassifier, score_pairs
from sentloom.operators.stats import THRESHOLDS
from sentloom.operators.synthesis import Translator, synthesize
from sentloom.plans.classifier import classifier_data, train_classifier
from sentloom.sources.corpus import corpus_paths, read_corpora, read_parallel
from sentloom.sources.sinks import read_synthetic, write_result, write_synthetic
from sentloom.sources.staging import content_key, manifest_key, materialize_named, stage, staging_path

DIRECTIONS = ("1n", "n1")
MAX_ITERATIONS = 8
KIND_FOR_TRAINING = {"1n": "so", "n1": "os"}
KIND_FROM_MODEL = {"1n": "os", "n1": "so"}


@dataclass(frozen=True)
class Callbacks:
    """What the user plugs in.

    ``train(direction, stage, pairs, start_model)`` trains on (src, tgt) pairs and
    returns (model_ref, validation metric); ``baseline(direction)`` is the metric of
    the untuned model; ``translator(model_ref)`` returns the loader that
    :func:`~sentloom.operators.synthesis.translate` wants; ``encode`` adds ``pieces``;
    ``scorer`` is a fitted pair classifier or a function from frame to score column;
    :func:`run_experiment` trains one where it is None. ``version`` names all of them: stages
    made by other callbacks are not used again. The scorer is also told by its weights,
    or by its function's name.
    """

    train: Callable[[str, str, DataFrame, str | None], tuple[str, float]]
    baseline: Callable[[str], float]
    translator: Callable[[str], Callable[[], Translator]]
    encode: Callable[[DataFrame], DataFrame]
    scorer: PairClassifier | Callable[[DataFrame], Column] | None = None
    version: str = ""

    def key(self) -> dict:
        """What of the callbacks a stage depends on."""
        if isinstance(self.scorer, PairClassifier):
            tables = [content_key(table) for table in (self.scorer.wordfreq, *(self.scorer.lexical or ()))]
            scorer = {"weights": self.scorer.weights(), "tables": tables, "lang": self.scorer.tgt_lang}
        else:
            scorer = f"{getattr(self.scorer, '__module__', '')}.{getattr(self.scorer, '__qualname__', type(self.scorer).__name__)}"
        return {"scorer": scorer, "version": self.version}


@dataclass
class State:
    """Best so far per direction, and where the synthetic pairs of each kind are."""

    best: dict[str, float] = field(default_factory=dict)
    model: dict[str, str | None] = field(default_factory=dict)
    threshold: dict[str, float] = field(default_factory=dict)
    synthetic: dict[str, DataFrame] = field(default_factory=dict)
    # The keys of the stages the synthetic pairs and the models come from.
    made_by: dict[str, str] = field(default_factory=dict)
    runs: list[tuple] = field(default_factory=list)


@dataclass
class Outcome:
    ledger: DataFrame
    best: dict[str, float]
    model: dict[str, str | None]
    threshold: dict[str, float]
    synthetic: DataFrame | None
    stopped_at: int | None


def as_training(pairs: DataFrame, direction: str) -> DataFrame:
    """(l1, l2) pairs turned to the source and target of a direction."""
    src, tgt = ("l1", "l2") if direction == "1n" else ("l2", "l1")
    return pairs.select("line_no", F.col(src).alias("src"), F.col(tgt).alias("tgt"))


def score_bands(scored: DataFrame, thresholds: Sequence[float], path: str | None = None) -> DataFrame:
    """Scored pairs written once, in a folder for each number of thresholds that the score is above (``band``).

    The pairs above the i-th lowest threshold (from 0) are those with ``band > i``: whole
    folders. Scores that are no numbers are in band 0.
    """
    above = [F.when((F.col("score") > F.lit(float(t))) & ~F.isnan("score"), 1).otherwise(0) for t in sorted(set(thresholds))]
    banded = scored.withColumn("band", reduce(lambda a, b: a + b, above, F.lit(0)))
    path = path or staging_path(scored.sparkSession, "bands")
    banded.write.mode("overwrite").partitionBy("band").parquet(path)
    # The folder of no pairs has no file that would tell its columns.
    fields = [f for f in banded.schema.fields if f.name != "band"]
    return scored.sparkSession.read.schema(T.StructType([*fields, T.StructField("band", T.IntegerType())])).parquet(path)


def search_threshold(
    parallel: DataFrame,
    scored: Mapping[str, DataFrame],
    train_and_score: Callable[[str, float, DataFrame], float],
    thresholds: Sequence[float] = THRESHOLDS,
) -> tuple[list[tuple[str, float, float]], dict[str, float]]:
    """Try every threshold in both directions: (tried runs, best threshold per direction).

    ``scored[direction]`` has the scored synthetic pairs (line_no, l1, l2, score) that
    train the direction. They are written once, by :func:`score_bands`; the pairs of a
    threshold are some of its folders, and follow the parallel pairs by a constant offset.
    """
    levels = sorted(set(thresholds))
    bands = {d: score_bands(scored[d].select("line_no", "l1", "l2", "score"), levels) for d in DIRECTIONS}
    last = last_lines([parallel])[0]
    tried = []
    for t in thresholds:
        for direction in DIRECTIONS:
            kept = as_training(bands[direction].filter(F.col("band") > levels.index(t)), direction)
            data = augment(as_training(parallel, direction), kept, last)
            tried.append((direction, float(t), float(train_and_score(direction, t, data))))
    spark = parallel.sparkSession
    sweep = spark.createDataFrame(tried, "direction string, threshold double, metric double")
    best = {r["direction"]: r["threshold"] for r in best_threshold(sweep, ["direction"]).collect()}
    return tried, best


class Refinement:
    """One experiment over a parallel corpus and two monolingual ones.

    ``parallel`` has (line_no, l1, l2); ``mono`` maps ``l1`` and ``l2`` to (line_no, text).
    Every stage translates the whole monolingual corpora; with a ``unit`` (a million, say)
    it takes the growing prefixes of :func:`~sentloom.operators.sampling.prefix_for`, and
    with a ``piece_limit`` it leaves out longer lines. What a stage made is found again
    under ``workdir`` by its manifest: its settings, the contents of the corpora, the
    callbacks' key and the stages it builds on. So a changed corpus, threshold or scorer
    makes the stages after it anew, and no others.
    """

    def __init__(
        self,
        spark: SparkSession,
        name: str,
        workdir: str,
        parallel: DataFrame,
        mono: Mapping[str, DataFrame],
        callbacks: Callbacks,
        unit: int | None = None,
        piece_limit: int | None = None,
    ):
        self.spark, self.name, self.workdir = spark, name, workdir.rstrip("/")
        self.parallel, self.mono, self.cb = parallel, mono, callbacks
        self.keys = {"parallel": content_key(parallel), **{side: content_key(df) for side, df in mono.items()}, "callbacks": callbacks.key()}
        self.last = last_lines([parallel])[0]
        self.unit, self.piece_limit = unit, piece_limit
        self.state = State(model={d: None for d in DIRECTIONS})

    # -- one step each ------------------------------------------------------

    def _train(self, direction: str, stage: str, data: DataFrame, iteration: int = 0,
               threshold: float | None = None, made_by: str | None = None) -> tuple[str, float]:
        """Train and validate, or take the recorded result of an earlier run.

        ``made_by`` is the key of the stage the synthetic pairs come from; with the
        threshold it tells the data, and the start model is told by its own stage.
        """
        manifest = {
            "run": stage, "experiment": self.name, "direction": direction, "iteration": iteration, "threshold": threshold,
            "parallel": self.keys["parallel"], "synthetic": made_by, "version": self.cb.version, "start": self.state.made_by.get(f"model-{direction}"),
        }

        def run() -> DataFrame:
            model, metric = self.cb.train(direction, stage, data, self.state.model[direction])
            row = (self.name, stage, iteration, direction, threshold, float(metric), model)
            return self.spark.createDataFrame([row], schema.LEDGER)

        # One row per run.
        row = materialize_named(self.spark, run, f"{self.workdir}/runs/{stage}-{direction}", manifest).first()
        self.state.runs.append(tuple(row[c] for c in schema.LEDGER.names))
        self.state.made_by[f"{stage}-{direction}"] = manifest_key(manifest)
        return row["model_ref"], row["metric"]

    def _translate(self, direction: str, stage: str, lines: int | None) -> DataFrame:
        """Translate a prefix with the best model of a direction and score the pairs: (line_no, l1, l2, score)."""
        source = "l1" if direction == "1n" else "l2"
        target = "l2" if direction == "1n" else "l1"
        manifest = {
            "translated": stage, "direction": direction, "model": self.state.made_by.get(f"model-{direction}"), "lines": lines,
            "piece_limit": self.piece_limit, "mono": self.keys[source], "callbacks": self.keys["callbacks"],
        }

        def run() -> DataFrame:
            made = synthesize(
                self.mono[source], self.cb.translator(self.state.model[direction]), self.cb.encode,
                lines, self.piece_limit,
            )
            pairs = made.select(
                "line_no", F.col("original").alias(source), F.col("synthetic").alias(target)
            ).select("line_no", F.col("l1").alias("src"), F.col("l2").alias("tgt"))
            return score_pairs(pairs, self.cb.scorer).select(
                "line_no", F.col("src").alias("l1"), F.col("tgt").alias("l2"), "score"
            )

        self.state.made_by[KIND_FROM_MODEL[direction]] = manifest_key(manifest)
        return materialize_named(self.spark, run, f"{self.workdir}/translated/{stage}-{direction}", manifest)

    def _accept(self, direction: str, stage: str, model: str, metric: float) -> bool:
        """A run that is at least as good as the best becomes the best; a metric that is no number never does."""
        ok = not math.isnan(metric) and metric >= self.state.best[direction]
        if ok:
            self.state.best[direction], self.state.model[direction] = metric, model
            self.state.made_by[f"model-{direction}"] = self.state.made_by[f"{stage}-{direction}"]
        return ok

    # -- stages -------------------------------------------------------------

    def first_fine_tune(self) -> bool:
        """Tune on the parallel pairs alone; go on only if both directions improved."""
        improved = []
        for direction in DIRECTIONS:
            model, metric = self._train(direction, "first", as_training(self.parallel, direction))
            baseline = float(self.cb.baseline(direction))
            self.state.best[direction] = float("-inf") if math.isnan(baseline) else baseline
            ok = self._accept(direction, "first", model, metric)
            if ok:
                kind = KIND_FROM_MODEL[direction]
                self.state.synthetic[kind] = self._translate(direction, "first", prefix_for("first", unit=self.unit))
            improved.append(ok)
        return all(improved)

    def find_thresholds(self, thresholds: Sequence[float] = THRESHOLDS) -> None:
        """Choose the score threshold of each direction, keeping its model if it is the best."""
        models: dict[tuple[str, float], str] = {}

        def run(direction: str, t: float, data: DataFrame) -> float:
            models[direction, t], metric = self._train(
                direction, f"score_{t}", data, threshold=float(t), made_by=self.state.made_by[KIND_FOR_TRAINING[direction]]
            )
            return metric

        scored = {d: self.state.synthetic[KIND_FOR_TRAINING[d]] for d in DIRECTIONS}
        tried, best = search_threshold(self.parallel, scored, run, thresholds)
        metrics = {(d, t): m for d, t, m in tried}
        for d in DIRECTIONS:
            # A direction in which no run reached 0 keeps every pair.
            t = best.get(d) if best.get(d) is not None else float("-inf")
            self.state.threshold[d] = t
            if (d, t) in metrics:
                self._accept(d, f"score_{t}", models[d, t], metrics[d, t])
        # Every pair that trains a model is filtered, also when its kind is not renewed later.
        self.state.synthetic = {
            KIND_FOR_TRAINING[d]: self._clean(scored[d], d) for d in DIRECTIONS
        }

    def _clean(self, scored: DataFrame, direction: str) -> DataFrame:
        return filter_by_score(scored, self.state.threshold[direction])

    def _renew(self, direction: str, stage: str, lines: int | None) -> None:
        """Synthetic pairs of a better model, filtered for the direction they train."""
        kind = KIND_FROM_MODEL[direction]
        other = "n1" if direction == "1n" else "1n"
        self.state.synthetic[kind] = self._clean(self._translate(direction, stage, lines), other)

    def iterate(self, max_iter: int = MAX_ITERATIONS) -> int:
        """Train both directions in turn until neither improves; returns the last iteration."""
        self._renew("n1", "loop", prefix_for("loop_start", unit=self.unit))
        for it in range(1, max_iter + 1):
            improved = False
            for direction in DIRECTIONS:
                kind = KIND_FOR_TRAINING[direction]
                kept = as_training(self.state.synthetic[kind], direction)
                data = augment(as_training(self.parallel, direction), kept, self.last)
                model, metric = self._train(
                    direction, f"it_{it}", data, iteration=it, threshold=self.state.threshold[direction], made_by=self.state.made_by[kind]
                )
                if self._accept(direction, f"it_{it}", model, metric):
                    improved = True
                    self._renew(direction, f"it_{it}", prefix_for("iteration", it, self.unit))
            if not improved:
                return it
        return max_iter

    # -- all of it ----------------------------------------------------------

    def ledger(self) -> DataFrame:
        return self.spark.createDataFrame(self.state.runs, schema.LEDGER)

    def synthetic(self) -> DataFrame:
        """Both kinds of synthetic pairs: (line_no, l1, l2, l1_origin, l2_origin)."""
        return reduce(DataFrame.unionByName, [
            df.select(
                "line_no", "l1", "l2",
                F.lit(ORIGINS[kind][0]).alias("l1_origin"), F.lit(ORIGINS[kind][1]).alias("l2_origin"),
            )
            for kind, df in self.state.synthetic.items()
        ])

    def run(self, thresholds: Sequence[float] = THRESHOLDS, max_iter: int = MAX_ITERATIONS) -> Outcome:
        stopped, synthetic = None, None
        if self.first_fine_tune():
            self.find_thresholds(thresholds)
            stopped = self.iterate(max_iter)
            path = write_synthetic(self.synthetic(), f"{self.workdir}/synthetic_corpora")
            synthetic = read_synthetic(self.spark, path)
        ledger = self.ledger()
        write_result(ledger, f"{self.workdir}/result")
        s = self.state
        return Outcome(ledger, dict(s.best), dict(s.model), dict(s.threshold), synthetic, stopped)


@dataclass(frozen=True)
class Config:
    """Named corpora ``<root>/<name>.<language>`` and the settings of one experiment.

    ``classifier_train`` and ``classifier_dev`` name the corpora of the pair classifier;
    they are needed if the callbacks bring no scorer. ``classifier_words`` names the corpora
    of language 2 that its word list counts, ``lexical_rounds`` the rounds in which it
    learns word translations.
    """

    name: str
    root: str
    workdir: str
    langs: tuple[str, str]
    parallel: Sequence[str]
    mono: Mapping[str, Sequence[str]]
    classifier_train: Sequence[str] = ()
    classifier_dev: Sequence[str] = ()
    classifier_words: Sequence[str] = ()
    lexical_rounds: int = 0
    thresholds: Sequence[float] = THRESHOLDS
    max_iter: int = MAX_ITERATIONS
    unit: int | None = None
    piece_limit: int | None = None


def run_experiment(spark: SparkSession, config: Config, callbacks: Callbacks) -> Outcome:
    """Read the corpora of a configuration, train the pair classifier if need be, and refine both directions."""
    l1, l2 = config.langs
    paths = [corpus_paths(spark, config.root, config.parallel, lang) for lang in config.langs]
    both = read_parallel(spark, *paths, "parallel", l1, l2)
    parallel = stage(both.select("line_no", F.col("src").alias("l1"), F.col("tgt").alias("l2")), "parallel")
    mono = {
        side: stage(read_corpora(spark, config.root, config.mono[lang], lang).select("line_no", "text"), "mono")
        for side, lang in (("l1", l1), ("l2", l2))
    }
    if callbacks.scorer is None:
        data = classifier_data(spark, config.root, config.classifier_train, config.classifier_dev, l1, l2, words=config.classifier_words)
        callbacks = replace(callbacks, scorer=train_classifier(data, l2, lexical_rounds=config.lexical_rounds))
    run = Refinement(spark, config.name, config.workdir, parallel, mono, callbacks, config.unit, config.piece_limit)
    return run.run(config.thresholds, config.max_iter)
