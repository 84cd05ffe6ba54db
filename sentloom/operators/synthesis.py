"""Batch translation of monolingual text with a model of the user's."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sentloom.functions.hashing import sample_key
from sentloom.operators.cleaning import max_pieces
from sentloom.operators.sampling import head_lines

Translator = Callable[[list[str]], list[str]]

# Tokens of a batch of a decoder, and of its longest sentence.
MAX_TOKENS, MAX_POSITIONS = 3000, 2000


def translate(
    df: DataFrame, load: Callable[[], Translator], col: str = "text", out: str = "hyp"
) -> DataFrame:
    """Add translations of a text column, in Arrow batches.

    ``load`` returns the translator (list of texts -> list of texts) and runs once
    per task, so a model is loaded once and used for all batches. The hypothesis
    stays on the row of its source: no join by line number afterwards. Where
    hypotheses come back from an outside decoder as a log, use ``parse_hypotheses``
    and ``attach_hypotheses``.
    """

    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        translator = load()
        for batch in batches:
            texts = batch.to_pylist()
            hyps = translator(texts)
            if len(hyps) != len(texts):
                raise ValueError(f"the translator returned {len(hyps)} texts for {len(texts)}")
            yield pa.array(hyps, pa.string())

    return df.withColumn(out, run(F.col(col)))


def translate_batched(
    df: DataFrame,
    load: Callable[[], Translator],
    length: Column,
    max_tokens: int = MAX_TOKENS,
    max_positions: int = MAX_POSITIONS,
    col: str = "text",
    out: str = "hyp",
    lanes: int | None = None,
    key: str | None = None,
) -> DataFrame:
    """Add translations, made in batches of rows of like length.

    ``length`` is the number of tokens of a row. In a lane, rows are ordered from the
    longest to the shortest and each batch takes as many as fit: its longest row, times its
    rows, is at most ``max_tokens``. A lane is a partition as it comes, and nothing is
    shuffled; with ``lanes`` and a ``key`` column rows are dealt to so many lanes by a hash of the key,
    and the batches are the same on any cluster (ties in length go by the key).

    Added columns: ``out``, ``lane`` and ``batch`` (from 0 in its lane). A row longer than
    ``max_positions`` or than a whole batch is not dropped: it has no translation and no batch, and
    neither has a NULL text. An empty text counts as one token.
    """
    added = [out, "lane", "batch"]
    clash = [c for c in df.columns if c.lower() in {a.lower() for a in added}]
    if clash:
        raise ValueError(f"columns {clash} are there already")
    limit = min(max_tokens, max_positions)
    lane = F.spark_partition_id() if lanes is None else F.pmod(F.conv(F.substring(sample_key(key, 0), 1, 8), 16, 10).cast("bigint"), F.lit(lanes))
    size = F.when(F.col(col).isNotNull(), F.greatest(length, F.lit(1))).cast("bigint")
    rows = df.select(F.struct("*").alias("row"), F.col(col).cast("string").alias("text"), size.alias("size"), lane.cast("int").alias("lane"))
    order = [F.asc("lane"), F.desc_nulls_first("size")]
    if lanes is not None:
        rows, order = rows.repartition(lanes, "lane"), [*order, F.asc(f"row.`{key}`")]
    rows = rows.sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        translator = load()
        held: list[pa.RecordBatch] = []
        room, lane, number = 0, None, 0

        def closed() -> Iterator[pa.RecordBatch]:
            texts = [t for part in held for t in part.column(1).to_pylist()]
            hyps = translator(texts) if texts else []
            if len(hyps) != len(texts):
                raise ValueError(f"the translator returned {len(hyps)} texts for {len(texts)}")
            at = 0
            for part in held:
                yield result(part, hyps[at:at + len(part)], number)
                at += len(part)
            held.clear()

        def result(part: pa.RecordBatch, hyps: list[str | None], batch: int | None) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(hyps, pa.string()), part.column(3), pa.array([batch] * len(part), pa.int64())], ["row", out, "lane", "batch"]
            )

        for batch in batches:
            sizes, own = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            at = 0
            while at < len(sizes):
                if own[at] != lane:
                    yield from closed()
                    lane, room, number = own[at], 0, -1
                if sizes[at] is None or sizes[at] > limit:
                    yield result(batch.slice(at, 1), [None], None)
                    at += 1
                    continue
                if not room:
                    yield from closed()
                    room, number = max_tokens // sizes[at], number + 1
                end = at
                while end < len(sizes) and end - at < room and own[end] == lane:
                    end += 1
                held.append(batch.slice(at, end - at))
                room -= end - at
                at = end
        yield from closed()

    kind = T.StructType([
        T.StructField("row", df.schema), T.StructField(out, T.StringType()), T.StructField("lane", T.IntegerType()), T.StructField("batch", T.LongType()),
    ])
    return rows.mapInArrow(run, kind).select("row.*", out, "lane", "batch")


def synthesize(
    mono: DataFrame,
    load: Callable[[], Translator],
    encode: Callable[[DataFrame], DataFrame],
    lines: int | None = None,
    piece_limit: int | None = None,
) -> DataFrame:
    """Translate a monolingual corpus, or its first ``lines`` lines.

    ``encode`` adds the array column ``pieces``; blank lines, and with a ``piece_limit``
    longer lines than so many pieces, are left out. Result: (line_no, original, synthetic).
    """
    encoded = encode(head_lines(mono, lines)).filter(F.size("pieces") > 0)
    if piece_limit is not None:
        encoded = max_pieces(encoded, piece_limit)
    return translate(encoded.select("line_no", "text"), load).select(
        "line_no", F.col("text").alias("original"), F.col("hyp").alias("synthetic")
    )
