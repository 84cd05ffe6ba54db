from pyspark.sql import functions as F

from sentloom import streaming
from sentloom.plans import views


def test_row_wise_operators_run_on_a_stream(spark, sf, tmp_path):
    folder = str(tmp_path / "in")
    views.table(spark, sf, "conversations", views.CONVERSATIONS).repartition(3).write.parquet(folder)
    stream = spark.readStream.schema(views.CONVERSATIONS).parquet(folder)
    assert stream.isStreaming

    def clean(df):
        sided = df.select(
            F.col("conv_id").alias("line_no"), "turn", F.col("text").alias("src"),
            F.when(F.col("role") == "user", F.lit(" ")).otherwise(F.col("text")).alias("tgt"),
        )
        scored = streaming.score_pairs(streaming.drop_empty_pairs(sided), streaming.length_ratio_scorer)
        kept = streaming.filter_by_score(scored, 0.5)
        return streaming.tokenize(streaming.lower_text(kept, "src"), "en", "src")

    out = str(tmp_path / "out")
    query = (
        clean(stream).writeStream.format("parquet").option("path", out)
        .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    )
    query.awaitTermination(120)
    batch = clean(spark.read.schema(views.CONVERSATIONS).parquet(folder))
    got, want = spark.read.parquet(out), batch
    assert got.count() == want.count() > 0
    assert got.exceptAll(want).count() == 0
