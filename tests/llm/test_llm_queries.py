"""Every query of the subpackage against its SQL, and the pipeline stage by stage."""

import pytest

import corpus_pipeline
from check_oracle import compare, duck
from sentloom.llm import queries, simhash, toxicity


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


@pytest.mark.parametrize("name", list(queries.SQL))
def test_query(spark, con, sf, name):
    ok, note = compare(spark, con, sf, name, queries.QUERIES[name], queries.SQL[name])
    assert ok, note


def test_numbers():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES if n != "pipeline") == list(range(1, 14))


def test_pipeline_stages(spark, con, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    ids = lambda df: sorted(r["doc_id"] for r in df.select("doc_id").collect())
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_copies", "decontamination", "mixing", "sharding"]
    done = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, sf)
        path = f"{spark.conf.get('spark.checkpoint.dir')}/stage-test-{name}"
        docs.write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
        done[name] = (before, docs)
        if name != "sharding":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    before, after = done["toxicity"]
    flagged = {r["doc_id"] for r in toxicity.toxicity(before, labels).where("predicted = 1").collect()}
    assert ids(after) == [i for i in ids(before) if i not in flagged]
    before, after = done["near_copies"]
    assert ids(after) == sorted({r["component_id"] for r in simhash.simhash_classes(before).collect()})
    before, after = done["decontamination"]
    before.createOrReplaceTempView("_before")
    con.register("documents_before", before.toPandas())
    leaks = {r[0] for r in con.sql(queries.SQL["op6_decontamination"].replace("FROM documents)", "FROM documents_before)")).project("doc_id").fetchall()}
    assert leaks and ids(after) == [i for i in ids(before) if i not in leaks]
    before, after = done["mixing"]
    assert set(ids(after)) <= set(ids(before))
    before, after = done["sharding"]
    assert ids(after) == ids(before)
    assert ids(corpus_pipeline.run(spark, sf)) == ids(after)


ODD = [
    (1, "a b c d e f g h. i j", "en", "s0", 20), (1, "a b c d e f g h. i j", "en", "s0", 20), (2, None, None, None, None), (None, "", "de", "s1", 0),
    (None, "x " * 30_000, None, "s1", 60_000), (3, " \n\t", "fr", None, 3), (4, "k l m n o p q r. s t", "en", "s0", 20), (5, "ü🙂", "xx", "", -1),
]


def test_every_stage_takes_odd_and_empty_tables(spark, sf):
    """NULLs anywhere, repeated rows, blank and long texts, an extra column; and no rows at all."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame(ODD, schema)
    for name, stage in corpus_pipeline.STAGES:
        none = stage(spark, docs.limit(0), sf)
        assert none.collect() == []
        out = stage(spark, docs.selectExpr("*", "1 as shard", "'y' as label"), sf)
        got = out.collect()
        if name in ("toxicity", "decontamination", "sharding"):
            assert len(got) == len(ODD)
        elif name == "near_copies":
            # The copies of 1 and the texts without words (2, 3, and one without an id) leave one row each.
            assert sorted((r["doc_id"] for r in got), key=str) == sorted([1, 2, 4, 5, None], key=str)
        else:
            assert {r["doc_id"] for r in got} <= {r[0] for r in ODD} and got
        if name != "sharding":
            assert out.columns == [*docs.columns, "shard", "label"]


CLASHING = [
    "_key", "_inside", "_before", "SHARD", "Slot", "Weight", "Epoch", "_row", "_id", "_skey", "_s", "label", "grp", "d0", "Rank", "ids", "Law", "_th", "_none", "fp", "pos", "block",
]


def test_columns_of_any_name_and_type(spark, sf):
    """Helper names in any case and a map column, in every operator over documents and every stage."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(40)
    wide = docs.selectExpr("*", *[f"{i} as `{c}`" for i, c in enumerate(CLASHING)], "map('k', source) as extra")
    ids = sorted(r["doc_id"] for r in docs.select("doc_id").collect())
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, wide, sf)
        got = out.select("doc_id", "extra").collect()
        assert got and {r["doc_id"] for r in got} <= set(ids) and all(r["extra"] for r in got), name
    wide.write.mode("overwrite").parquet(f"{spark.conf.get('spark.checkpoint.dir')}/wide/documents.parquet")
    for other in ("labels", "benchmark", "pages"):
        spark.read.parquet(f"{sf}/{other}.parquet").write.mode("overwrite").parquet(f"{spark.conf.get('spark.checkpoint.dir')}/wide/{other}.parquet")
    for name, query in queries.QUERIES.items():
        if name not in ("pipeline", "op5_warc", "op6_decontamination", "op12_lexical_search"):
            assert {r["doc_id"] for r in query(spark, f"{spark.conf.get('spark.checkpoint.dir')}/wide").select("doc_id").collect()} <= set(ids), name
