import hashlib

import pytest
from pyspark.sql import functions as F

from sentloom.operators import sampling


def numbered(spark, n, parts=3):
    return spark.range(1, n + 1).select(F.col("id").alias("line_no"), F.concat(F.lit("s"), "id").alias("src")).repartition(parts)


def key(seed, i):
    return hashlib.md5(f"{seed}:{i}".encode()).hexdigest()


@pytest.mark.parametrize("n", [0, 1, 499, 500, 501, 5000])
@pytest.mark.parametrize("parts", [1, 16])
def test_cap_is_exact_and_fixed_by_the_seed(spark, n, parts):
    got = [r.line_no for r in sampling.cap_pairs(numbered(spark, n, parts), 500, seed=3).collect()]
    assert sorted(got) == sorted(sorted(range(1, n + 1), key=lambda i: key(3, i))[:500])


def test_cap_as_written_takes_the_first_lines_that_are_left(spark):
    df = numbered(spark, 3000).filter("line_no % 3 = 0")
    got = [r.line_no for r in sampling.cap_pairs(df, 500, as_written=True).collect()]
    assert sorted(got) == list(range(3, 1501, 3))
    assert sampling.cap_pairs(df, 5000, as_written=True).count() == 1000


@pytest.mark.parametrize("parts", [1, 7])
def test_shuffle_depends_on_the_seed_only(spark, parts):
    got = [r.line_no for r in sampling.shuffle_rows(numbered(spark, 300, parts), 5).collect()]
    assert got == sorted(range(1, 301), key=lambda i: key(5, i))


def test_prefix_schedule(spark):
    assert sampling.prefix_for("first") == 1_000_000
    assert sampling.prefix_for("loop_start") == 2_000_000
    assert [sampling.prefix_for("iteration", i) for i in (1, 8)] == [3_000_000, 10_000_000]
    with pytest.raises(ValueError):
        sampling.prefix_for("other")


def test_prefix_filter_reaches_the_scan(spark, tmp_path):
    numbered(spark, 100).write.parquet(str(tmp_path / "t"))
    df = sampling.head_lines(spark.read.parquet(str(tmp_path / "t")), 10)
    assert df.count() == 10
    assert "LessThanOrEqual(line_no,10)" in df._jdf.queryExecution().executedPlan().toString()


def test_ids_are_ordered_as_numbers(spark):
    df = spark.createDataFrame([("10",), ("9",), ("100",), ("2",)], "sent_id string")
    assert [r.sent_id for r in sampling.order_by_id(df).collect()] == ["2", "9", "10", "100"]


def test_temperature_mix_moves_shares_towards_even(spark):
    df = numbered(spark, 2000).withColumn("corpus", F.when(F.col("line_no") <= 1600, "big").otherwise("small"))
    weights = {r.corpus: r for r in sampling.temperature_weights(df, 1.5).collect()}
    assert sum(w.p for w in weights.values()) == pytest.approx(1)
    assert weights["big"].p / weights["small"].p == pytest.approx(4 ** (1 / 1.5))
    mixed = sampling.temperature_mix(df, 1.5, seed=2)
    counts = {r.corpus: r["count"] for r in mixed.groupBy("corpus").count().collect()}
    for name, w in weights.items():
        assert counts[name] == pytest.approx(w.p * 2000, rel=0.06)
    same = {r.corpus: r["count"] for r in sampling.temperature_mix(df, 1.0, seed=2).groupBy("corpus").count().collect()}
    assert same == {"big": 1600, "small": 400}


def test_null_numbers_and_corpora_are_kept(spark):
    rows = [(1, "x", "big"), (None, "y", "big"), (None, "z", None), (2, "u", None), (2, "v", "big")]
    df = spark.createDataFrame(rows, "line_no bigint, src string, corpus string")
    for as_written in (False, True):
        assert sampling.cap_pairs(df, 100, as_written=as_written).count() == 5
        for n in range(6):
            assert sampling.cap_pairs(df, n, as_written=as_written).count() == n
    assert {r.src for r in sampling.cap_pairs(df, 2, as_written=True).collect()} == {"y", "z"}
    assert {r.src for r in sampling.temperature_mix(df, 1.0).collect()} == {"x", "y", "z", "u", "v"}


def test_the_cut_is_searched_on_keys_alone(spark):
    """No window and no sort sees the rows."""
    plan = sampling.cap_pairs(numbered(spark, 3000), 500)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Sort" not in plan


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 97, 101, 1000])
def test_every_number_has_its_own_place(spark, n):
    got = {r["line_no"]: r["place"] for r in sampling.permute_rows(numbered(spark, n), n, seed=3).collect()}
    assert sorted(got) == sorted(got.values()) == list(range(1, n + 1))
    if n >= 97:
        assert list(got.values()) != sorted(got.values())
        other = {r["line_no"]: r["place"] for r in sampling.permute_rows(numbered(spark, n), n, seed=4).collect()}
        assert sum(got[i] == other[i] for i in got) < n / 10


def test_places_are_found_without_moving_rows_and_only_for_numbers_in_range(spark):
    df = sampling.permute_rows(spark.range(1, 51).withColumnRenamed("id", "line_no"), 50)
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString() and df.select("place").distinct().count() == 50
    with pytest.raises(Exception, match="no place for"):
        sampling.permute_rows(numbered(spark, 50), 49).collect()


def test_ties_go_by_content(spark):
    """Rows of several languages share a number, and all NULL numbers one key."""
    rows = [(i // 4 if i < 40 else None, f"l{i % 4}", f"text {i}") for i in range(60)] + [(None, None, None)] * 3
    df = spark.createDataFrame(rows, "line_no bigint, lang string, src string")
    for as_written in (False, True):
        for n in (1, 3, 18, 30, 62):
            several = [sorted(map(tuple, sampling.cap_pairs(d, n, as_written=as_written).collect()), key=str) for d in (df.coalesce(1), df.repartition(5), df.repartition(3, "src"))]
            assert several[0] == several[1] == several[2] and len(several[0]) == n
    first = sampling.cap_pairs(df, 23, as_written=True).collect()
    assert all(r["line_no"] is None for r in first)
    with_map = df.withColumn("m", F.create_map(F.lit("a"), F.col("src")))
    assert sampling.cap_pairs(with_map, 7).count() == 7


def test_quotas_are_met_to_the_row(spark):
    sizes = {"big": 1600, "small": 130, None: 40, "one": 1}
    names = [n for n, k in sizes.items() for _ in range(k)]
    df = spark.createDataFrame([(i % 900, n, i) for i, n in enumerate(names)], "line_no bigint, corpus string, x int")
    rates = {r["corpus"]: r["rate"] for r in sampling.temperature_weights(df, 1.5).collect()}
    several = []
    for d in (df.coalesce(1), df.repartition(6)):
        got = sampling.temperature_quotas(d, 1.5).collect()
        several.append(sorted((r["x"], r["copy"]) for r in got))
        for name, n in sizes.items():
            whole = int(rates[name])
            assert sum(r["corpus"] == name for r in got) == whole * n + round(n * (rates[name] - whole))
    assert several[0] == several[1]
