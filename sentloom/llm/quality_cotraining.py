"""Quality by co-training: a view of the text and a view of the page's metadata teach each other.

Both views are fitted on all labelled documents and on all pseudo-labels. Their features
are written once; a step of a fit is one pass over them, in which the tasks add up
gradients and second derivatives, so the driver sees sums of a fixed size only. A
pseudo-label follows from the teachers of the rounds so far and their thresholds, so no
document carries a state.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentloom.llm.common import Scratch, bucket_of_five, held_out, slices, split_words

# Rounds, and the share of the unlabelled documents that a view may teach the other in one
# round. A pseudo-label must have this probability.
ROUNDS, TAUGHT, CONFIDENT = 4, 0.1, 0.95
RIDGE = 1.0
# Passes of one fit at most, and the relative gain that ends it.
STEPS_OF_FIT, GAIN = 25, 1e-8
# Bins of the logits from -EDGE to EDGE in which confident rows and calibration are counted.
BINS, EDGE = 4096, 40.0
# Labels (id and class) up to which they are sent to the documents; more are joined by id.
SENT_LABELS = 1_000_000
# Rows of a block of features.
BLOCK_ROWS = 4096
# Text view: shares of the printable ASCII bytes and of others, and figures of the words.
BYTES, WORD_FIGURES = 96, 8
# Metadata view: hashed language and source, steps of the length, figures of the layout.
LANGS, SOURCES, STEPS = 16, 64, 12
META = LANGS + SOURCES + STEPS + 3


def text_features(texts: pa.Array) -> np.ndarray:
    """One row for each text: byte shares and word figures; a NULL or empty text is all zeros."""
    out = np.zeros((len(texts), BYTES + WORD_FIGURES))
    flat, counts = split_words(pc.fill_null(texts, ""))
    codes = flat.dictionary_encode().indices.to_numpy(zero_copy_only=False)
    lengths = pc.binary_length(flat).to_numpy(zero_copy_only=False)
    ends = np.cumsum(counts)
    for row, text in enumerate(texts.cast(pa.binary())):
        text = text.as_py()
        if not text:
            continue
        histogram = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
        out[row, :BYTES - 1] = histogram[32:127]
        out[row, BYTES - 1] = histogram[127:].sum()
        out[row, :BYTES] = np.sqrt(out[row, :BYTES] / len(text))
        n = int(counts[row])
        if n:
            own, size = codes[ends[row] - n:ends[row]], lengths[ends[row] - n:ends[row]]
            again = (own[1:] == own[:-1]).mean() if n > 1 else 0.0
            upper, marks = histogram[65:91].sum() / len(text), (histogram[33:48].sum() + histogram[58:65].sum()) / n
            out[row, BYTES:] = (
                np.log1p(n) / 5, size.mean() / 10, size.std() / 5, again, len(np.unique(own)) / n,
                upper * 5, min(marks, 3.0), (histogram[46] + histogram[33] + histogram[63]) / n,
            )
    return out


def meta_features(langs: pa.Array, sources: pa.Array, n_chars: pa.Array, lines: pa.Array) -> np.ndarray:
    """One row for each page: hashed language and source, its length in steps, and its layout."""
    out = np.zeros((len(langs), META))
    for row, (lang, source, n, n_lines) in enumerate(zip(langs.to_pylist(), sources.to_pylist(), n_chars.to_pylist(), lines.to_pylist())):
        out[row, zlib.crc32(repr(lang).encode()) % LANGS] = 1
        out[row, LANGS + zlib.crc32(repr(source).encode()) % SOURCES] = 1
        n, n_lines = max(n or 0, 0), n_lines or 1
        out[row, LANGS + SOURCES + min(STEPS - 1, int(np.log2(1 + n / 16)))] = 1
        out[row, -3:] = np.log1p(n) / 5, np.log1p(n_lines) / 5, np.log1p(n / n_lines) / 5
    return out


def _logits(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return x @ w[:-1] + w[-1]


@dataclass
class Views:
    """Weights of the two views, slope and offset of each one's calibration, and the prior's logit."""

    weights: list[np.ndarray] = field(default_factory=lambda: [np.zeros(BYTES + WORD_FIGURES + 1), np.zeros(META + 1)])
    curves: list[tuple[float, float]] = field(default_factory=lambda: [(1.0, 0.0), (1.0, 0.0)])
    prior: float = 0.0

    def scores(self, views: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Calibrated probability by text, by metadata, and by both as independent evidence."""
        own = [a * _logits(x, w) + b for x, w, (a, b) in zip(views, self.weights, self.curves)]
        sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -50, 50)))
        return sigmoid(own[0]), sigmoid(own[1]), sigmoid(own[0] + own[1] - self.prior)


@dataclass
class Round:
    """The teachers of a round (weights of both views), and from which logit on each one teaches either class."""

    weights: list[np.ndarray]
    good_from: list[float]
    bad_from: list[float]


def taught_labels(views: list[np.ndarray], rounds: list[Round]) -> list[np.ndarray]:
    """What unlabelled rows are for each view, as its pupil: 1, 0, or -1 where no round has taught them.

    The first round in which the other view is sure enough decides.
    """
    out = [np.full(len(views[0]), -1) for _ in (0, 1)]
    for past in rounds:
        for pupil, teacher in ((0, 1), (1, 0)):
            logit = _logits(views[teacher], past.weights[teacher])
            free = out[pupil] < 0
            out[pupil][free & (logit >= past.good_from[teacher])] = 1
            out[pupil][free & (logit <= -past.bad_from[teacher])] = 0
    return out


def _targets(views: list[np.ndarray], quality: np.ndarray, fit: np.ndarray, rounds: list[Round]) -> list[np.ndarray]:
    """For each view 1, 0 or -1 (not learnt from): labels of the rows to fit on, pseudo-labels of those without a label."""
    free = quality < 0
    taught = taught_labels([v[free] for v in views], rounds)
    out = []
    for view in (0, 1):
        target = np.where(fit, quality, -1)
        target[free] = taught[view]
        out.append(target)
    return out


def loss_sums(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Loss, gradient and second derivatives of a logistic regression, one after another, without the ridge."""
    x = np.hstack([x, np.ones((len(x), 1))])
    z = x @ w
    p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
    hessian = (x * (p * (1 - p))[:, None]).T @ x
    return np.concatenate(([np.logaddexp(0, z).sum() - y @ z], x.T @ (p - y), hessian.ravel()))


class Newton:
    """Damped Newton steps on a ridge logistic regression, given the sums at the weights to try (``w``).

    A step that makes the loss worse is halved. ``w`` is the fit when ``done``.
    """

    def __init__(self, size: int):
        self.w, self.pull, self.best, self.step, self.left, self.done = np.zeros(size), np.full(size, RIDGE), None, None, STEPS_OF_FIT, False
        self.pull[-1] = 1e-3

    def told(self, sums: np.ndarray) -> None:
        size, w = len(self.w), self.w
        loss = sums[0] + 0.5 * (self.pull * w * w).sum()
        self.left -= 1
        if self.best is not None and loss > self.best[0]:
            self.step = self.step / 2
            self.done = np.abs(self.step).max() < 1e-7
        else:
            self.done = self.best is not None and self.best[0] - loss < GAIN * (1 + abs(loss))
            self.best = loss, w
            self.step = np.linalg.solve(sums[1 + size:].reshape(size, size) + np.diag(self.pull), -(sums[1:1 + size] + self.pull * w))
        self.done = bool(self.done or not self.left)
        self.w = self.best[1] if self.done else self.best[1] + self.step


def fit_both(sums: Callable[[list[np.ndarray]], list[np.ndarray]], sizes: list[int]) -> list[np.ndarray]:
    """Fit both views with shared passes: ``sums`` gives those of either view at its weights."""
    fits = [Newton(n) for n in sizes]
    while not all(f.done for f in fits):
        for f, found in zip(fits, sums([f.w for f in fits])):
            if not f.done:
                f.told(found)
    return [f.w for f in fits]


def _bins(logits: np.ndarray) -> np.ndarray:
    return np.clip(((logits + EDGE) / (2 * EDGE) * BINS).astype(int), 0, BINS - 1)


def teaching_edge(counts: np.ndarray, quota: float) -> float:
    """From which logit on rows are taught, given how many there are by bin of how sure the teacher is.

    Whole bins, the surest first, while they stay within the quota; the first that has
    rows is always taken. Nothing below ``CONFIDENT`` is.
    """
    least = np.log(CONFIDENT / (1 - CONFIDENT))
    edges = np.arange(BINS) * (2 * EDGE / BINS) - EDGE
    total, edge = 0, np.inf
    for i in range(BINS - 1, -1, -1):
        if edges[i] < least or (total and total + counts[i] > quota):
            break
        total += counts[i]
        if counts[i]:
            edge = float(edges[i]) if i else -np.inf
    return edge


def _view_columns() -> list[Column]:
    text = F.col("text")
    return [text, F.col("lang").cast("string"), F.col("source").cast("string"), F.col("n_chars").cast("long"),
            F.coalesce(F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1, F.lit(1)).cast("long")]


def _features(columns: list[pa.Array]) -> list[np.ndarray]:
    return [text_features(columns[0]), meta_features(*columns[1:])]


SIZES = [BYTES + WORD_FIGURES, META]


def _feature_blocks(docs: DataFrame, known: DataFrame) -> DataFrame:
    """Features of all documents that are not held out, in blocks of rows: both views, quality (-1 without a label), bucket."""
    rows = docs.where(bucket_of_five(F.col("doc_id")) > 0).select(
        F.col("doc_id").alias("_id"), bucket_of_five(F.col("doc_id")).cast("int").alias("_b"), *[c.alias(f"_{i}") for i, c in enumerate(_view_columns())]
    )

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2):
                both = [v.astype("<f4") for v in _features(part.columns[2:7])]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(pa.string()), part.column(1), *[pa.array([r.tobytes() for r in v], pa.binary()) for v in both]], ["id", "bucket", "t", "m"])

    made = rows.mapInArrow(features, "id string, bucket int, t binary, m binary")
    labels = known.select(F.col("doc_id").cast("string").alias("id"), "quality")
    if known.count() <= SENT_LABELS:
        labels = F.broadcast(labels)
    joined = made.join(labels, "id", "left").select("t", "m", F.coalesce("quality", F.lit(-1)).alias("quality"), "bucket")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                views = [b"".join(part.column(i).to_pylist()) for i in (0, 1)]
                numbers = [part.column(i).to_numpy().astype("<i4").tobytes() for i in (2, 3)]
                yield pa.RecordBatch.from_arrays([pa.array([v], pa.binary()) for v in [*views, *numbers]], ["t", "m", "quality", "bucket"])

    return joined.mapInArrow(packed, "t binary, m binary, quality binary, bucket binary")


def _summed(blocks: DataFrame, add: Callable[[list[np.ndarray], np.ndarray, np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """The sum over all blocks of ``add(views, quality, bucket)``, arrays of ``size`` numbers, added up in the tasks, then in fewer."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for row in range(batch.num_rows):
                t, m, quality, bucket = (batch.column(i)[row].as_py() for i in range(4))
                views = [np.frombuffer(v, "<f4").reshape(-1, n).astype(float) for v, n in zip((t, m), SIZES)]
                total += add(views, np.frombuffer(quality, "<i4"), np.frombuffer(bucket, "<i4"))
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for sums in batch.column(0):
                total += np.frombuffer(sums.as_py())
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    rows = blocks.mapInArrow(partial, "sums binary")
    tasks = blocks.rdd.getNumPartitions()
    if tasks > 16:
        rows = rows.repartition(int(tasks ** 0.5)).mapInArrow(again, "sums binary")
    return np.sum([np.frombuffer(r["sums"]) for r in rows.collect()] or [np.zeros(size)], axis=0)


def co_train(blocks: DataFrame) -> Views:
    """Fit both views on the labels, let them label all other rows for each other, and calibrate.

    In each round a view hands the other its most confident rows of either class (in the
    proportion of the labels); a row is taught once, and both views are fitted anew on labels and all
    that they were taught. Buckets 2 to 4 give the labels to fit on, bucket 1 those to calibrate by.
    """
    shared = blocks.sparkSession.sparkContext.broadcast
    kinds = _summed(blocks, lambda views, q, b: np.array([((q == 0) & (b > 1)).sum(), ((q == 1) & (b > 1)).sum(), (q < 0).sum()], float), 3)
    bad, good, free = kinds
    out = Views(prior=float(np.log((good + (good * bad == 0) * 0.5) / (bad + (good * bad == 0) * 0.5))))
    if not good or not bad:
        # Nothing to tell apart: the share of good labels decides.
        out.curves = [(1.0, out.prior), (1.0, out.prior)]
        return out
    share = good / (good + bad)
    dims = [n + 1 for n in SIZES]
    lengths = [1 + n + n * n for n in dims]

    def fitted(rounds: list[Round]) -> list[np.ndarray]:
        def sums(tried: list[np.ndarray]) -> list[np.ndarray]:
            model = shared((tried, rounds))

            def add(views: list[np.ndarray], quality: np.ndarray, bucket: np.ndarray) -> np.ndarray:
                tried, rounds = model.value
                targets = _targets(views, quality, bucket > 1, rounds)
                return np.concatenate([loss_sums(x[y >= 0], y[y >= 0].astype(float), w) for x, y, w in zip(views, targets, tried)])

            both = _summed(blocks, add, sum(lengths))
            model.destroy()
            return [both[:lengths[0]], both[lengths[0]:]]

        return fit_both(sums, dims)

    rounds: list[Round] = []
    weights = fitted(rounds)
    for _ in range(ROUNDS):
        model = shared((weights, rounds))

        def sure(views: list[np.ndarray], quality: np.ndarray, bucket: np.ndarray) -> np.ndarray:
            """How many rows each teacher could teach, as good and as bad, by how sure it is."""
            weights, rounds = model.value  # noqa: B023
            open_views = [v[quality < 0] for v in views]
            taught = taught_labels(open_views, rounds)
            counts = []
            for teacher, pupil in ((0, 1), (1, 0)):
                logit = _logits(open_views[teacher], weights[teacher])[taught[pupil] < 0]
                counts += [np.bincount(_bins(logit), minlength=BINS), np.bincount(_bins(-logit), minlength=BINS)]
            return np.concatenate(counts).astype(float)

        counts = _summed(blocks, sure, 4 * BINS).reshape(4, BINS)
        model.destroy()
        quota = TAUGHT * free
        now = Round(weights, [teaching_edge(counts[2 * t], quota * share) for t in (0, 1)], [teaching_edge(counts[2 * t + 1], quota * (1 - share)) for t in (0, 1)])
        if not np.isfinite([*now.good_from, *now.bad_from]).any():
            break
        rounds.append(now)
        weights = fitted(rounds)
    out.weights = weights
    model = shared(weights)

    def seen(views: list[np.ndarray], quality: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """Labels of bucket 1 by bin of each view's logit: bad ones, then good ones."""
        known = (bucket == 1) & (quality >= 0)
        return np.concatenate([
            np.bincount(_bins(_logits(v[known & (quality == q)], w)), minlength=BINS) for v, w in zip(views, model.value) for q in (0, 1)
        ]).astype(float)

    seen_bins = _summed(blocks, seen, 4 * BINS).reshape(2, 2, BINS)
    if (seen_bins.sum(axis=2) > 0).all():
        out.curves = [_curve(seen_bins[view, 0], seen_bins[view, 1]) for view in (0, 1)]
    return out


def _curve(bad: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope (not below 0) and offset of a logistic curve over the middles of the bins."""
    x = ((np.arange(BINS) + 0.5) * (2 * EDGE / BINS) - EDGE) / 10
    design, n = np.stack([x, np.ones(BINS)], axis=1), bad + good
    pull, w = np.array([RIDGE, 1e-3]), np.zeros(2)

    def loss(w: np.ndarray) -> float:
        z = design @ w
        return (n * np.logaddexp(0, z)).sum() - good @ z + 0.5 * (pull * w * w).sum()

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -500, 500)))
        step = np.linalg.solve((design * (n * p * (1 - p))[:, None]).T @ design + np.diag(pull), design.T @ (good - n * p) - pull * w)
        size = 1.0
        while size > 1e-6 and loss(w + size * step) > loss(w):
            size /= 2
        w = w + size * step
        if np.abs(size * step).max() < 1e-10:
            break
    return max(0.0, w[0] / 10), w[1]


def fit_quality(docs: DataFrame, labels: DataFrame) -> Views:
    """Co-train on all documents that are not held out: labelled ones of buckets 2 to 4 and all unlabelled ones."""
    known = labels.where(bucket_of_five(F.col("doc_id")) > 0).where("quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    scratch = Scratch(docs.sparkSession)
    blocks = scratch.write(_feature_blocks(docs, known), "quality-features")
    views = co_train(blocks)
    scratch.drop(blocks)
    return views


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, text_score, meta_score, score and predicted (score >= 0.5) of every document.

    A score is the probability of labels.quality 1. Learnt from ids whose bucket (crc32
    of the id modulo 5) is not 0; labels other than 0 and 1 are ignored, and an id with
    both is 0. The text view reads the whole text, the other lang, source, n_chars and
    the number of lines; NULLs are values of their own, a NULL or empty text has all
    figures 0. Without labels of both kinds all scores are the share of good labels.
    Rows with a NULL id are scored; repeated rows stay; other columns are not read.
    """
    views = fit_quality(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast((views.weights, views.curves, views.prior))

    @F.arrow_udf("text_score double, meta_score double, score double")
    def scored(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        model = Views(*shared.value)
        for columns in batches:
            for_all = [[], [], []]
            for part in slices(pa.RecordBatch.from_arrays(list(columns), list("abcde")), 0):
                for out, s in zip(for_all, model.scores(_features(part.columns))):
                    out.append(s)
            yield pa.StructArray.from_arrays(
                [pa.array(np.concatenate(o) if o else np.empty(0)) for o in for_all], ["text_score", "meta_score", "score"])

    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), scored(*_view_columns()).alias("_s")).select(
        "doc_id", "held_out", "_s.text_score", "_s.meta_score", "_s.score", (F.col("_s.score") >= 0.5).cast("int").alias("predicted"),
    )
