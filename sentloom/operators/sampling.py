"""Orders, prefixes and seeded samples."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from sentloom.functions.hashing import sample_fraction, sample_key
from sentloom.operators.lookup import broadcast_checked
from sentloom.sources.staging import stage

# Digits of a key looked at together when an exact cut is searched: 16 ** 3 groups at most.
BUCKET_DIGITS = 3

# Lines translated in the first stage, at the start of the loop, and
# the offset added to the iteration number inside it (in units of a million lines).
FIRST_UNITS = 1
LOOP_START_UNITS = 2
ITERATION_OFFSET = 2


def order_by_id(df: DataFrame) -> DataFrame:
    """Order by sentence id as a number (2 before 10)."""
    return df.orderBy(F.col("sent_id").cast("bigint"))


def head_lines(df: DataFrame, n: int | None) -> DataFrame:
    """The first ``n`` lines (all if None): a filter on the line number, which reaches a Parquet scan."""
    return df if n is None else df.filter(F.col("line_no") <= n)


def prefix_for(stage: str, iteration: int = 0, unit: int | None = 1_000_000) -> int | None:
    """How many monolingual lines a stage translates: ``first``, ``loop_start`` or ``iteration``.

    Without a ``unit`` every stage translates the whole corpus (None).
    """
    units = {"first": FIRST_UNITS, "loop_start": LOOP_START_UNITS, "iteration": iteration + ITERATION_OFFSET}
    if stage not in units:
        raise ValueError(f"unknown stage {stage!r}")
    return None if unit is None else units[stage] * unit


def cap_pairs(df: DataFrame, n: int = 600_000, seed: int = 1, as_written: bool = False) -> DataFrame:
    """At most ``n`` pairs, as a random sample fixed by the seed (all pairs if there are no more).

    The sample is the ``n`` smallest hash keys of line_no (NULL is a number like any
    other); of rows with one number those with the smallest hash of their contents, so only
    rows that are alike can take each other's place. Only keys are looked at: they are written once, counted by
    their leading digits, and the digits of the cut are found group by group until few
    rows share them, so nothing is sorted or collected as a whole. The result has exactly
    ``min(n, rows)`` rows. ``as_written`` takes the first n lines, which is what the
    batch pipeline really does; NULL line numbers come first.
    """
    if as_written:
        # Line numbers may have gaps after cleaning, so the cut is by rank, not by number.
        number = F.lpad(F.hex(F.col("line_no").bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")
        key = F.coalesce(F.concat(F.lit("1"), number), F.lit("0" * 17))
    else:
        key = sample_key("line_no", seed)
    return _smallest(df, F.concat(key, row_hash(df)), n)


def row_hash(df: DataFrame) -> Column:
    """16 hexadecimal digits of a row's contents, NULLs and their places included."""
    values = [F.to_json(F.struct(F.col(f"`{f.name}`"))) if isinstance(f.dataType, (T.MapType, T.VariantType)) else F.col(f"`{f.name}`") for f in df.schema.fields]
    return F.lpad(F.hex(F.xxhash64(*values, *[v.isNull() for v in values])), 16, "0")


def _smallest(df: DataFrame, key: Column, n: int) -> DataFrame:
    """Rows with the ``n`` smallest hexadecimal keys."""
    cut = _cut_key(df.select(key.alias("_key")), n)
    if cut is None:
        return df
    last, left = cut
    keyed = df.withColumn("_key", key)
    if left == 0:
        return keyed.filter(F.col("_key") < last).select(*df.columns)
    # More rows have the very key of the cut than are wanted: they repeat one another.
    edge = keyed.filter(F.col("_key") == last).limit(left)
    return keyed.filter(F.col("_key") < last).unionByName(edge).select(*df.columns)


def _cut_key(keys: DataFrame, n: int) -> tuple[str, int] | None:
    """The key of the ``n``-th row in order, and how many rows with this key are wanted; None if all are."""
    keys = stage(keys, "cap-keys")
    # All keys are equally long.
    width = keys.agg(F.max(F.length("_key"))).first()[0] or 0
    prefix, left = "", n
    for digits in range(BUCKET_DIGITS, width + BUCKET_DIGITS, BUCKET_DIGITS):
        # At most 16 ** BUCKET_DIGITS groups come back.
        inside = keys.filter(F.startswith("_key", F.lit(prefix))).groupBy(F.substring("_key", 1, min(digits, width)).alias("p"))
        for row in inside.agg(F.count(F.lit(1)).alias("n")).orderBy("p").toLocalIterator():
            if row["n"] > left:
                prefix = row["p"]
                break
            left -= row["n"]
        else:
            return None
        if left == 0 or len(prefix) < digits:
            break
    return prefix, left


def shuffle_rows(df: DataFrame, seed: int = 1, key: str = "line_no") -> DataFrame:
    """Rows in an order that depends on the seed and the ids only (a range-partitioned sort)."""
    return df.withColumn("_key", sample_key(key, seed)).orderBy("_key").drop("_key")


# Rounds of the permutation, and steps a number may need to come back below n: numbers
# that are out of range are fewer than the square root of n.
FEISTEL_ROUNDS, WALK = 8, 16


def permuted(number: Column, n: int, seed: int = 1) -> Column:
    """The place, from 0 to ``n - 1``, that a seeded permutation gives each number from 0 to ``n - 1``.

    A number is a row and a column of a table with about as many of either; in turn, one of
    the two is moved around by a hash of the other, which can be undone, so no two numbers
    meet. The table may have a few places more than ``n``: a number that lands there goes
    on until it is below. No row needs to know another, so nothing is sorted. Numbers out
    of range are an error.
    """
    columns = math.isqrt(max(0, n - 1)) + 1
    rows = -(-max(1, n) // columns)

    def moved(value: Column, i: Column) -> Column:
        text = F.concat_ws(":", F.lit(str(seed)), i.cast("string"), value.cast("string"))
        return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint")

    def turn(state: Column, i: Column) -> Column:
        row, column = state["r"], state["c"]
        return F.when(i % 2 == 0, F.struct(((row + moved(column, i)) % rows).alias("r"), column.alias("c"))).otherwise(
            F.struct(row.alias("r"), ((column + moved(row, i)) % columns).alias("c"))
        )

    def once(x: Column) -> Column:
        start = F.struct(F.floor(x / columns).cast("bigint").alias("r"), (x % columns).cast("bigint").alias("c"))
        return F.aggregate(F.sequence(F.lit(0), F.lit(FEISTEL_ROUNDS - 1)), start, turn, lambda s: s["r"] * columns + s["c"])

    inside = (number >= 0) & (number < n)
    end = F.aggregate(
        F.sequence(F.lit(1), F.lit(WALK)), F.struct(number.cast("bigint").alias("x"), F.lit(False).alias("done")),
        lambda s, _: F.when(s["done"], s).otherwise(_landed(once(s["x"]), n)),
    )
    return F.when(inside & end["done"], end["x"]).otherwise(F.raise_error(F.lit("a number that the permutation has no place for")).cast("bigint"))


def _landed(x: Column, n: int) -> Column:
    """A place and whether it is below ``n``; it is computed once."""
    return F.element_at(F.transform(F.array(x), lambda v: F.struct(v.alias("x"), (v < n).alias("done"))), 1)


def permute_rows(df: DataFrame, n: int, seed: int = 1, key: str = "line_no", out: str = "place") -> DataFrame:
    """Rows numbered 1 to ``n`` with their place, 1 to ``n``, in a seeded random order (see :func:`permuted`)."""
    return df.withColumn(out, permuted(F.col(key) - 1, n, seed) + 1)


def temperature_weights(df: DataFrame, temperature: float = 1.5, by: str = "corpus") -> DataFrame:
    """Per corpus: rows, share ``p`` proportional to ``rows ** (1 / T)`` and rows to draw per row."""
    counts = df.groupBy(by).agg(F.count(F.lit(1)).alias("n_rows"))
    everything = W.partitionBy(F.lit(1))  # one row per corpus name
    power = F.pow(F.col("n_rows").cast("double"), F.lit(1.0 / temperature))
    return (
        counts.withColumn("p", power / F.sum(power).over(everything))
        .withColumn("rate", F.col("p") * F.sum("n_rows").over(everything) / F.col("n_rows"))
    )


def temperature_mix(
    df: DataFrame, temperature: float = 1.5, by: str = "corpus", seed: int = 1, key: str = "line_no"
) -> DataFrame:
    """Draw rows so that corpus shares follow the temperature; the size stays about the same.

    A row is drawn ``floor(rate)`` times plus once more if its hash falls below the
    fraction. The weights have one row per corpus name.
    """
    rates = broadcast_checked(temperature_weights(df, temperature, by).select(by, "rate"), "rates")
    whole = F.floor("rate")
    extra = F.when(sample_fraction(key, seed) < F.col("rate") - whole, 1).otherwise(0)
    rates = rates.withColumnRenamed(by, "_by")
    drawn = df.join(rates, F.col(by).eqNullSafe(F.col("_by"))).withColumn("_copies", (whole + extra).cast("int"))
    return (
        drawn.filter(F.col("_copies") > 0)
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
        .select(*df.columns, "copy")
    )


def temperature_quotas(
    df: DataFrame, temperature: float = 1.5, by: str = "corpus", seed: int = 1, key: str = "line_no"
) -> DataFrame:
    """As :func:`temperature_mix`, with the shares met to the row.

    Of a corpus with n rows and rate r every row is drawn floor(r) times, and the
    ``round(n * (r - floor(r)))`` rows with the smallest keys once more; rows with one number go
    by their contents. The keys of the cuts are found for all corpora at once, from
    counts by leading digits; rows are only put in order below six digits, one in 16 million
    of a corpus, so nothing is sorted or collected as a whole.
    """
    weights = temperature_weights(df, temperature, by)
    whole = F.floor("rate").cast("bigint")
    quota = F.round(F.col("n_rows") * (F.col("rate") - whole)).cast("bigint")
    # A NULL name is a corpus, too: a struct matches it.
    rates = broadcast_checked(weights.select(F.struct(F.col(by).alias("name")).alias("_by"), whole.alias("_whole"), quota.alias("_left")), "quotas")
    keyed = df.select(F.struct(F.col(by).alias("name")).alias("_by"), F.concat(sample_key(key, seed), row_hash(df)).alias("_key"))
    keys = stage(keyed, "quota-keys")
    state = rates.filter("_left > 0").select("_by", F.col("_left").alias("_rest"), F.lit("").alias("_prefix"))
    for digits in (BUCKET_DIGITS, 2 * BUCKET_DIGITS):
        inside = keys.join(F.broadcast(state), "_by").filter(F.startswith("_key", "_prefix"))
        counts = inside.groupBy("_by", "_rest", F.substring("_key", 1, digits).alias("_part")).agg(F.count(F.lit(1)).alias("n"))
        # At most 16 ** BUCKET_DIGITS groups of a corpus.
        counts = counts.withColumn("upto", F.sum("n").over(W.partitionBy("_by").orderBy("_part")))
        first = counts.filter(F.col("upto") >= F.col("_rest")).groupBy("_by", "_rest").agg(
            F.min(F.struct("_part", (F.col("upto") - F.col("n")).alias("before"))).alias("f")
        )
        # One row for each corpus name, as in ``rates``.
        state = stage(first.select("_by", (F.col("_rest") - F.col("f.before")).alias("_rest"), F.col("f._part").alias("_prefix")), "quota-cuts")
    inside = keys.join(F.broadcast(state), "_by").filter(F.startswith("_key", "_prefix"))
    nth = F.row_number().over(W.partitionBy("_by").orderBy("_key"))
    last = inside.withColumn("_nth", nth).filter(F.col("_nth") == F.col("_rest")).select("_by", F.col("_key").alias("_cut"))
    plan = broadcast_checked(rates.join(last, "_by", "left").select("_by", "_whole", "_cut"), "quota-plan")
    rows = df.select(F.struct("*").alias("_row"), F.struct(F.col(by).alias("name")).alias("_by"), F.concat(sample_key(key, seed), row_hash(df)).alias("_key"))
    copies = F.col("_whole") + F.when(F.col("_key") <= F.col("_cut"), 1).otherwise(0)
    drawn = rows.join(plan, "_by").select("_row", copies.cast("int").alias("_copies")).filter("_copies > 0")
    return drawn.select("_row.*", F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias("copy"))
