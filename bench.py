"""Time the headline queries; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [query ...]

Every query is run to its last row (a ``noop`` write): one warm-up run, then the
median of ``BENCH_RUNS`` (3) timed runs. ``control`` is a plain scan, for comparing
machines; it is not in the sum. The text tables are first written again with a
file for each core, as large tables come: a file with one row group is read by one task.
"""

from __future__ import annotations

import atexit
import json
import os
import shutil
import statistics
import sys
import tempfile
import time

from pyspark.sql import functions as F

from registry.queries import QUERIES
from sentloom.session import get_spark
from sentloom.sources.staging import staged_tables

HEADLINE = [
    "threshold_sweep_by_corpus",  # pair, clean, score, sweep
    "pair_by_line_pad",
    "number_lines",
    "word_frequencies",
    "build_dictionary",
    "ids_from_vocab",
    "vocab_coverage",
    "evaluate",
    "corpus_bleu_turns",
    "mixture_all_1n",
    "cap_pairs",
    "trim_embeddings",
    "pair_features",
    "make_negatives",
    "synthesize",
    "read_parallel",
    "concat_corpora",
    "learn_bpe_full",  # 10,000 pieces
    "apply_bpe_full",
]


def spread_tables(spark, sf_dir: str, cpus: int, root: str) -> str:
    """The tables of ``sf_dir`` with the text tables in ``cpus`` files each."""
    for name in ("documents", "conversations", "embeddings", "benchmark", "events"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").repartition(cpus).write.parquet(f"{root}/{name}.parquet")
    return root


def control(spark, sf_dir: str):
    """A plain scan that no operator changes: its time tells the machine's speed."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return docs.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("n_chars"), F.max(F.sha2("text", 256)).alias("digest"))


def main() -> None:
    sf = sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    scratch = tempfile.mkdtemp(prefix="bench-")
    atexit.register(shutil.rmtree, scratch, ignore_errors=True)
    spark = get_spark(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="8g",
        spark__checkpoint__dir=f"{scratch}/checkpoint",
    )
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = spread_tables(spark, sf_dir, int(cpus), f"{scratch}/tables")
    seconds = {}
    for name in ["control", *(sys.argv[1:] or HEADLINE)]:
        query = control if name == "control" else QUERIES[name]
        took = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            with staged_tables(spark):
                query(spark, sf_dir).write.format("noop").mode("overwrite").save()
                took.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(took[1:]), 3)
    print(json.dumps({
        "metric": "headline queries, sum of median warm run times",
        "value": round(sum(s for name, s in seconds.items() if name != "control"), 3),
        "unit": "sec",
        "control": seconds.pop("control"),
        "queries": seconds,
        "sf": sf.rstrip("/").rsplit("sf", 1)[-1],
        "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
