"""Mixing sources by temperature: weights from token shares, realised as seeded block permutations."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sentloom.llm.common import Scratch, words_of

# Steps of the exponent: it is k / STEPS for a whole k.
STEPS = 1 << 20
# Exponents tried at once; each trial narrows the interval by so much.
FAN = 64
# Fan-out of a level when the end of a budget is searched, and the number of levels.
SPLIT_DIGITS, LEVELS = 3, 2
# Sources up to which the table of cuts goes to every executor.
BROADCAST_SOURCES = 50_000


def shuffle_key(seed: int, doc_id: Column) -> Column:
    """32 hex digits that put the documents of a source in order."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))).cast("binary"))


def _tilted(totals: DataFrame, ks: list[int]) -> DataFrame:
    """Entropy and largest weight by share of the exponents k / STEPS."""
    tried = totals.withColumn("k", F.explode(F.array(*[F.lit(k) for k in ks])))
    power = tried.withColumn("w", F.pow(F.col("share"), F.col("k") / F.lit(float(STEPS))))
    # -sum(q ln q) with q = w / W is ln W - sum(w ln w) / W.
    return power.groupBy("k").agg(
        (F.ln(F.sum("w")) - F.sum(F.col("w") * F.ln("w")) / F.sum("w")).alias("entropy"),
        (F.max(F.col("w") / F.col("share")) / F.sum("w")).alias("stretch"),
    )


def _bisect(totals: DataFrame, holds: Callable[[Column, Column], Column], rising: bool) -> int:
    """The last k where ``holds`` is true (``rising`` false: the first), of 0 to STEPS.

    ``holds`` is monotone in k. Each job tries ``FAN`` points of the interval at once
    and only their truth comes back.
    """
    low, high = 0, STEPS
    while high - low > 0:
        width = high - low
        ks = sorted({low + (width * i) // FAN for i in range(FAN + 1)})
        true = {r["k"] for r in _tilted(totals, ks).select("k", holds(F.col("entropy"), F.col("stretch")).alias("ok")).where("ok").collect()}
        if rising:  # true up to some k
            low = max([k for k in ks if k in true], default=low)
            high = min([k for k in ks if k > low], default=low)
            high = high - 1 if high > low else low
        else:  # true from some k on
            high = min([k for k in ks if k in true], default=high)
            low = max([k for k in ks if k < high], default=high)
            low = low + 1 if low < high else high
    return low


def mixing_weights(totals: DataFrame, budget: int, entropy: float, max_repeat: float) -> DataFrame:
    """Add ``weight`` and the token ``quota`` of each source to (skey, tokens, share), all tokens over 0.

    The exponent is the largest at which the entropy of the weights is ``entropy`` times
    that of equal weights, or a larger one if some source would else be repeated more
    than ``max_repeat`` times; 1 (the shares as they are) at most.
    """
    n, total = totals.agg(F.count("*"), F.sum("tokens")).first()
    k = STEPS
    if n:
        goal = entropy * math.log(n)
        k = max(
            _bisect(totals, lambda h, _: h >= goal - 1e-12, rising=True),
            _bisect(totals, lambda _, s: s * (budget / total) <= max_repeat + 1e-12, rising=False),
        )
    power = F.pow(F.col("share"), F.lit(k / STEPS))
    summed = totals.agg(F.sum(power)).first()[0] or 1.0
    weight = power / F.lit(summed)
    return totals.select("*", weight.alias("weight"), F.floor(weight * F.lit(float(budget)) + 0.5).cast("long").alias("quota"))


def _cuts(keys: DataFrame, quotas: DataFrame, small) -> DataFrame:
    """Up to which key (``cut``) the last, partial pass over each source goes.

    Documents are taken in the order of their keys while the running sum of their tokens
    stays within ``rest``. Sums of key prefixes narrow the place level by level, so rows
    are only ever put in order below one prefix: 1 in 4096 ** LEVELS of a source.
    """
    state = quotas.where("rest > 0").select("skey", "rest", F.lit("").alias("prefix"))

    def inside():
        return keys.join(small(state), "skey").where(F.startswith("key", "prefix"))

    for level in range(1, LEVELS + 1):
        sums = inside().groupBy("skey", "rest", F.substring("key", 1, SPLIT_DIGITS * level).alias("part")).agg(F.sum("tokens").alias("tokens"))
        sums = sums.withColumn("upto", F.sum("tokens").over(Window.partitionBy("skey").orderBy("part")))
        # A pass that is partial does not fit as a whole, so one part is the first that doesn't.
        state = (
            sums.where("upto > rest").groupBy("skey", "rest")
            .agg(F.min(F.struct("part", (F.col("upto") - F.col("tokens")).alias("before"))).alias("first"))
            .select("skey", (F.col("rest") - F.col("first.before")).alias("rest"), F.col("first.part").alias("prefix"))
        )
        state = Scratch(keys.sparkSession).write(state, "cuts")
    upto = F.sum("tokens").over(Window.partitionBy("skey").orderBy("key"))
    # Below the prefix all fits; inside it, keys up to the last that fits.
    return inside().withColumn("upto", upto).groupBy("skey").agg(
        F.coalesce(F.max(F.when(F.col("upto") <= F.col("rest"), F.col("key"))), F.max("prefix")).alias("cut")
    )


def mix_sources(
    docs: DataFrame, budget: int | None = None, entropy: float = 0.95, max_repeat: float = 4.0,
    blocks: int = 64, seed: int = 7,
) -> DataFrame:
    """The documents of the mixture, one row for each time one is used, and how it is used.

    Added columns: ``n_tokens`` (words), ``weight`` of the source, ``epoch`` (which pass
    over the source, from 0), ``block`` and ``mix_key``. Reading by block, then mix_key,
    gives the mixture: every block holds the sources in proportion to their weights, in
    an order that differs from pass to pass. ``budget`` is in words; by default as many
    as ``docs`` has. A source is used in whole passes and one partial pass that stays
    within its quota. See :func:`mixing_weights` for the weights.

    Documents without a source form one source. A text without a word has 0 tokens: it is
    used in every whole pass over its source; a source with no words at all has no share
    and no rows. Documents with equal ids are used together; a NULL id is one id. An
    empty table gives no rows. Columns of ``docs`` that have one of the added names, in any case, are replaced.
    """
    added = ("n_tokens", "weight", "epoch", "block", "mix_key")
    skey = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))
    key, tokens = shuffle_key(seed, F.col("doc_id")), F.size(words_of(F.col("text"))).cast("long")
    scratch = Scratch(docs.sparkSession)
    keys = scratch.write(docs.select(skey.alias("skey"), key.alias("key"), tokens.alias("tokens")), "mix-keys")
    sums = scratch.write(keys.groupBy("skey").agg(F.sum("tokens").alias("tokens")).where("tokens > 0"), "mix-sources")
    n, total = sums.agg(F.count("*"), F.sum("tokens")).first()
    totals = sums.withColumn("share", F.col("tokens") / F.lit(float(total or 1)))
    budget = (total or 0) if budget is None else budget

    def small(table: DataFrame) -> DataFrame:
        return F.broadcast(table) if n <= BROADCAST_SOURCES else table

    quotas = mixing_weights(totals, budget, entropy, max_repeat).withColumn("whole", F.floor(F.col("quota") / F.col("tokens")))
    quotas = scratch.write(quotas.withColumn("rest", F.col("quota") - F.col("whole") * F.col("tokens")), "mix-quotas")
    plan = scratch.write(
        quotas.join(_cuts(keys, quotas, small), "skey", "left").select(
            F.col("skey").alias("_skey"), F.col("weight").alias("_weight"), F.col("whole").alias("_whole"), F.col("cut").alias("_cut"),
            (F.col("quota") / F.col("tokens")).alias("_passes"),
        ), "mix-plan",
    )
    # The row goes along as one column, so its names meet no others.
    kept = [c for c in docs.columns if c.lower() not in added]
    own = F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_row")
    part = F.conv(F.substring("_key", 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))
    place = F.floor((F.col("epoch") + part) / F.col("_passes") * blocks)
    return (
        docs.select(own, F.col("doc_id").alias("_id"), tokens.alias("n_tokens"), skey.alias("_skey"), key.alias("_key"))
        .join(small(plan), "_skey")
        .withColumn("_times", (F.col("_whole") + F.when(F.col("_key") <= F.col("_cut"), 1).otherwise(0)).cast("int"))
        .where("_times > 0")
        .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("_times") - 1)))
        .select(
            *[F.col("_row").getField(c).alias(c) for c in kept], "n_tokens", F.round("_weight", 9).alias("weight"), "epoch",
            F.least(place, F.lit(blocks - 1)).cast("int").alias("block"),
            F.md5(F.concat_ws(":", F.lit(seed), "epoch", F.coalesce(F.col("_id").cast("string"), F.lit("null"))).cast("binary")).alias("mix_key"),
        )
    )
