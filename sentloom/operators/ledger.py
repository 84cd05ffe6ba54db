"""Decisions over the run ledger (experiment, direction, iteration, metric, ...).

A ledger has a handful of rows per experiment and direction, so windows are
partitioned by those two and never see a corpus.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

GROUP = ("experiment", "direction")


def _number(metric: Column) -> Column:
    """NULL for NaN, which would be larger than any number."""
    return F.when(~F.isnan(metric.cast("double")), metric)


def best_run(ledger: DataFrame, by: Sequence[str] = GROUP) -> DataFrame:
    """The run with the best metric per direction; a tie goes to the later iteration."""
    rest = [c for c in ledger.columns if c not in (*by, "metric", "iteration")]
    best = F.max(F.struct("metric", "iteration", *rest)).alias("_best")
    scored = ledger.filter(F.col("metric").isNotNull() & ~F.isnan("metric"))
    return scored.groupBy(*by).agg(best).select(*by, "_best.*").select(*ledger.columns)


def accept_flags(ledger: DataFrame, baseline: DataFrame | None = None, by: Sequence[str] = GROUP) -> DataFrame:
    """Add ``accepted``: the metric is at least the best of all earlier runs.

    ``baseline`` (by..., baseline) is the metric to reach before the first run;
    without one the first run of a direction is accepted. A metric that is NULL or NaN
    is never accepted and sets no bar, nor does such a baseline.
    """
    earlier = W.partitionBy(*by).orderBy("iteration").rowsBetween(W.unboundedPreceding, -1)
    number = _number(F.col("metric"))
    best = F.max(number).over(earlier)
    df = ledger
    if baseline is not None:
        df = df.join(baseline.select(*by, F.col("baseline").alias("_baseline")), list(by), "left")
        best = F.greatest(best, _number(F.col("_baseline")))
    return (
        df.withColumn("_bar", best)
        .withColumn("accepted", F.coalesce(number >= F.col("_bar"), F.col("_bar").isNull() & number.isNotNull()))
        .select(*ledger.columns, "accepted")
    )


def stop_iteration(
    ledger: DataFrame, max_iter: int = 8, baseline: DataFrame | None = None
) -> DataFrame:
    """Per experiment the first iteration in which neither direction was accepted, else ``max_iter``."""
    flags = accept_flags(ledger, baseline).filter(F.col("iteration") <= max_iter)
    rounds = flags.groupBy("experiment", "iteration").agg(F.bool_or("accepted").alias("_any"))
    stop = F.min(F.when(~F.col("_any"), F.col("iteration")))
    return rounds.groupBy("experiment").agg(
        F.coalesce(stop, F.lit(max_iter)).cast("bigint").alias("stop_iteration")
    )


def best_threshold(sweep: DataFrame, by: Sequence[str] = GROUP) -> DataFrame:
    """The threshold with the best metric per direction; a tie goes to the higher threshold.

    The running best starts at 0.0, so a metric below it never wins.
    """
    at_least_zero = F.when((F.col("metric") >= 0.0) & ~F.isnan("metric"), F.struct("metric", "threshold"))
    return (
        sweep.groupBy(*by).agg(F.max(at_least_zero).alias("_best"))
        .select(*by, F.col("_best.threshold").alias("threshold"), F.col("_best.metric").alias("metric"))
    )


def gate(ledger: DataFrame, baseline: DataFrame) -> DataFrame:
    """Per experiment: did the first fine-tune of every direction reach its baseline?

    ``ledger`` holds the runs of the first stage, one per direction.
    """
    flags = accept_flags(ledger, baseline)
    return flags.groupBy("experiment").agg(
        (F.bool_and("accepted") & (F.count(F.lit(1)) >= 2)).alias("go_on")
    )
