"""Written tables that cut lineage and survive lost executors."""

from __future__ import annotations

import atexit
import gc
import hashlib
import json
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Folders of local sessions, and the tables staged so far, by application.
_LOCAL_ROOTS: dict[str, str] = {}
_STAGED: dict[str, list[str]] = {}


def staging_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting, whose tasks all run on this machine,
    gets a folder of its own, which goes when the process ends; on a cluster such a
    folder would be lost with its machine, so that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    sc = spark.sparkContext
    if sc.master.split("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if sc.applicationId not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[sc.applicationId] = tempfile.mkdtemp(prefix="sentloom-")
        atexit.register(shutil.rmtree, _LOCAL_ROOTS[sc.applicationId], ignore_errors=True)
    return _LOCAL_ROOTS[sc.applicationId]


def staging_path(spark: SparkSession, label: str) -> str:
    """A new path under the staging folder, unique per call."""
    path = f"{staging_root(spark)}/sentloom/{label}-{uuid.uuid4().hex}"
    _STAGED.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet in the staging folder and return the written table."""
    spark = df.sparkSession
    path = staging_path(spark, label)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def staged_tables(spark: SparkSession) -> Iterator[None]:
    """Own what is staged inside: it is deleted at the end, when its results have been used or written."""
    paths = _STAGED.setdefault(spark.sparkContext.applicationId, [])
    first = len(paths)
    try:
        yield
    finally:
        for path in paths[first:]:
            delete_path(spark, path)
        del paths[first:]


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, if it is there, in the file system that owns it."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def free_shuffles(spark: SparkSession) -> None:
    """Let go of the shuffle files of frames that are done with: Spark deletes them when the driver collects its garbage."""
    gc.collect()
    spark._jvm.System.gc()


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, asked of the file system that owns it."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(hadoop_path)


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a job has finished writing ``path`` (its success marker is there)."""
    return path_exists(spark, path.rstrip("/") + "/_SUCCESS")


def materialize_once(spark: SparkSession, build, path: str) -> DataFrame:
    """Return the table at ``path``, building and writing it only if it is not complete.

    ``build`` is a DataFrame or a function without arguments that returns one; with
    a function, a finished stage costs not even planning. An unfinished write is
    replaced, never appended to.
    """
    if not is_complete(spark, path):
        df = build() if callable(build) else build
        df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def content_key(df: DataFrame) -> str:
    """A fingerprint of the rows and columns of a table, whatever their order and files.

    One pass that adds up in the tasks: the number of rows and two combinations of the
    hashes of whole rows.
    """
    row = F.xxhash64(*[F.to_json(F.struct(F.col(f"`{c}`"))) for c in df.columns], *[F.col(f"`{c}`").isNull() for c in df.columns])
    # Two sums of halves cannot overflow; with the xor, rows that are there twice still count.
    found = df.select(row.alias("h")).agg(
        F.count(F.lit(1)), F.sum(F.shiftright("h", 32)), F.sum(F.col("h").bitwiseAND(F.lit(0xFFFFFFFF))), F.bit_xor("h")
    ).first()
    return hashlib.sha256(json.dumps([df.dtypes, *found]).encode()).hexdigest()[:20]


def manifest_key(manifest: dict) -> str:
    """A short name of a manifest: the same for the same settings and inputs."""
    return hashlib.sha256(json.dumps(manifest, sort_keys=True).encode()).hexdigest()[:20]


def _read_text(spark: SparkSession, path: str) -> str | None:
    if not path_exists(spark, path):
        return None
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).open(hadoop_path)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).create(hadoop_path, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def materialize_named(spark: SparkSession, build, folder: str, manifest: dict) -> DataFrame:
    """The stage that ``manifest`` describes, built and written only if it is not there yet.

    The manifest names all that the stage depends on: its settings and the keys of its
    inputs (:func:`content_key` of a table, :func:`manifest_key` of another stage). The
    folder of the stage is named by it, so a changed setting or input is another stage, and
    stages after it, whose manifests name it, are others too. The manifest itself is
    written last and compared before the stage is used: a stage without it is unfinished
    and replaced.
    """
    path, text = f"{folder.rstrip('/')}/{manifest_key(manifest)}", json.dumps(manifest, sort_keys=True)
    if not is_complete(spark, path) or _read_text(spark, f"{path}/_manifest.json") != text:
        df = build() if callable(build) else build
        df.write.mode("overwrite").parquet(path)
        _write_text(spark, f"{path}/_manifest.json", text)
    return spark.read.parquet(path)
