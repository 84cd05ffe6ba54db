"""Translation in batches of rows of like length."""

import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from sentloom.operators import synthesis

cloudpickle.register_pickle_by_value(sys.modules[__name__])
def length():
    return F.size(F.split("text", " "))



def telling():
    """A model that tells with what sizes its batch came."""
    return lambda texts: [f"{len(texts)} {max(len(t.split(' ')) for t in texts)}" for _ in texts]


def rows(spark, n=300):
    data = [(i, " ".join(["w"] * (i * 7 % 40 + 1)), {"k": str(i)}) for i in range(n)]
    return spark.createDataFrame([*data, (n, None, None), (n + 1, "w " * 99 + "w", None), (n + 2, "", None)], "id int, text string, row map<string,string>")


@pytest.mark.parametrize("lanes", [None, 5])
def test_no_batch_is_over_its_tokens_and_no_row_is_lost(spark, lanes):
    df = rows(spark)
    out = synthesis.translate_batched(df.repartition(3), telling, length(), max_tokens=100, max_positions=60, lanes=lanes, key="id")
    assert out.columns == ["id", "text", "row", "hyp", "lane", "batch"]
    got = out.collect()
    assert sorted(r["id"] for r in got) == list(range(303))
    groups = {}
    for r in got:
        if r["id"] < 300:
            assert r["row"] == {"k": str(r["id"])}
        if r["batch"] is None:
            assert r["hyp"] is None and r["id"] in (300, 301)
        else:
            groups.setdefault((r["lane"], r["batch"]), []).append(r)
    for members in groups.values():
        longest = max(len(r["text"].split(" ")) for r in members)
        assert longest * len(members) <= 100
        # The model saw exactly the rows of the batch.
        assert {r["hyp"] for r in members} == {f"{len(members)} {longest}"}
    for lane in {k[0] for k in groups}:
        numbers = sorted(k[1] for k in groups if k[0] == lane)
        assert numbers == list(range(len(numbers)))
        # Full but for the last of a lane, and ordered by length.
        sizes = [sorted(len(r["text"].split(" ")) for r in groups[lane, b]) for b in numbers]
        assert all(len(s) == 100 // s[-1] for s in sizes[:-1]) and all(a[0] >= b[-1] for a, b in zip(sizes, sizes[1:]))


def test_lanes_by_key_do_not_depend_on_partitions(spark, monkeypatch):
    df = rows(spark)
    several = [
        sorted(tuple(r) for r in synthesis.translate_batched(d, telling, length(), 100, 60, lanes=4, key="id").drop("row", "text").collect())
        for d in (df.coalesce(1), df.repartition(7))
    ]
    assert several[0] == several[1]


def test_without_lanes_nothing_is_shuffled(spark):
    out = synthesis.translate_batched(rows(spark), telling, length())
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


def test_models_and_columns_are_checked(spark):
    with pytest.raises(Exception, match="returned 0 texts"):
        synthesis.translate_batched(rows(spark), lambda: lambda texts: [], length()).collect()
    with pytest.raises(ValueError, match="Batch"):
        synthesis.translate_batched(rows(spark).withColumn("Batch", F.lit(1)), telling, length())
    assert synthesis.translate_batched(rows(spark).limit(0), telling, length()).collect() == []
