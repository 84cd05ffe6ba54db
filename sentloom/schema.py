"""Schemas of tables that are written and found again."""

from pyspark.sql import types as T

# The run ledger that the refinement loop appends to.
LEDGER = T.StructType([
    T.StructField("experiment", T.StringType()),
    T.StructField("stage", T.StringType()),
    T.StructField("iteration", T.IntegerType()),
    T.StructField("direction", T.StringType()),
    T.StructField("threshold", T.DoubleType()),
    T.StructField("metric", T.DoubleType()),
    T.StructField("model_ref", T.StringType()),
])

# Synthetic corpora, in a folder for each pair of origins.
SYNTHETIC = T.StructType([
    T.StructField("line_no", T.LongType()),
    T.StructField("l1", T.StringType()),
    T.StructField("l2", T.StringType()),
    T.StructField("l1_origin", T.StringType()),
    T.StructField("l2_origin", T.StringType()),
])
