"""What the plans look like: no corpus in one task, no Python or text where it is not needed."""

from pyspark.sql import functions as F

from sentloom.operators import cleaning, pairing, stats
from sentloom.plans import experiment, views
from registry.queries import QUERIES


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_is_jvm_only_and_never_gathers_rows(spark, sf):
    text = plan(QUERIES["threshold_sweep_by_corpus"](spark, sf))
    assert "SinglePartition" not in text
    assert "Python" not in text and "Arrow" not in text
    assert "BroadcastNestedLoopJoin" not in text and "CartesianProduct" not in text


def test_filters_and_columns_reach_the_scan(spark, sf):
    text = plan(views.pair_scores(spark, sf))
    assert "EqualTo(lang,en)" in text and "EqualTo(lang,de)" in text
    assert "n_chars" not in text


def test_numbering_has_no_window_over_a_language(spark, sf):
    text = plan(views.lines(spark, sf))
    assert "SinglePartition" not in text
    # Texts are windowed by their own key only; windows by language see one row per task.
    windows = [line for line in text.splitlines() if " Window [" in line or "- Window" in line]
    assert windows
    for line in windows:
        assert "_lines" not in line.split("],")[0] or "_key" in line or "_part" in line


def test_concatenation_moves_and_writes_nothing(spark, sf):
    text = plan(QUERIES["concat_corpora"](spark, sf))
    # Four scans of the written lines, each of one language, with the offsets as constants.
    assert text.count("FileScan") == 4 and "Exchange" not in text and "Join" not in text and "documents.parquet" not in text


def test_bands_above_a_threshold_are_folders(spark, tmp_path):
    scored = spark.createDataFrame([(i, "a", "b", s) for i, s in enumerate([0.0, 0.1, 0.55, 0.9, None, float("nan"), 1.0])], "line_no bigint, l1 string, l2 string, score double")
    bands = experiment.score_bands(scored, [0.5, 0.0, 0.9], str(tmp_path / "bands"))
    assert {r["line_no"]: r["band"] for r in bands.collect()} == {0: 0, 1: 1, 2: 2, 3: 2, 4: 0, 5: 0, 6: 3}
    above = bands.filter("band > 1")
    assert "PartitionFilters: [isnotnull(band" in plan(above) and sorted(r["line_no"] for r in above.collect()) == [2, 3, 6]
    files = {r[0].split("band=")[1][0] for r in above.select(F.input_file_name()).collect()}
    assert files == {"2", "3"}


def test_pairing_is_an_equi_join_on_the_number(spark):
    src = spark.range(10).select(F.col("id").alias("line_no"), F.lit("a").alias("text"))
    text = plan(pairing.pair_by_line(src, src))
    assert "line_no" in text and "NestedLoop" not in text


def test_row_wise_operators_do_not_shuffle(spark):
    df = spark.createDataFrame([(1, "a", "b", 0.5)], "line_no bigint, src string, tgt string, score double")
    text = plan(cleaning.filter_by_score(cleaning.drop_empty_pairs(df), 0.3))
    assert "Exchange" not in text


def test_word_counts_are_combined_before_tokenising(spark, sf):
    text = plan(stats.word_frequencies(views.documents(spark, sf, "en"), "en"))
    # Two aggregations: raw words of the corpus, then tokens of the distinct words.
    assert text.count("HashAggregate") >= 4
    first_shuffle = text.rindex("Exchange")
    assert "regexp_replace" not in text[first_shuffle:]
