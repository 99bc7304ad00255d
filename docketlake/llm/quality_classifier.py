"""A quality classifier on document statistics.

Random Fourier features approximate a Gaussian kernel over standardised statistics of a text; each partition sums its
part of the normal equations, the driver solves the ridge system (its size is the number of features, whatever the
corpus), and isotonic regression over a histogram of scores calibrates them. Labels, language, source and doc_id are
never inputs of a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketlake.llm import textvec
from docketlake.llm.common import read, small_batches, written

#: Random features, the width of the kernel over standardised statistics, the ridge penalty for each training row.
FEATURES, WIDTH, RIDGE, SEED = 256, 3.0, 1e-4, 20240501
#: Raw scores are calibrated in bins over this range.
BINS, LOW, HIGH = 2048, -0.5, 1.5
#: Sums that a task of the tree of additions gets, and those left to the driver.
FAN_IN, LAST = 16, 8
#: Standardised statistics are cut off here.
FARTHEST = 6.0

STATISTICS = (
    "log_words", "word_length", "word_spread", "capitals", "digits", "symbols", "exclamations", "bars", "punctuation",
    "newlines", "non_ascii", "distinct_words", "repeated_trigrams", "repeated_lines", "log_line_length", "breaks",
)


def _mask(chars: bytes) -> np.ndarray:
    found = np.zeros(256, bool)
    found[list(chars)] = True
    return found


_UPPER, _LETTER, _DIGIT = _mask(bytes(range(65, 91))), _mask(bytes([*range(65, 91), *range(97, 123)])), _mask(b"0123456789")
_SYMBOL, _PUNCTUATION, _HIGH = _mask(b"#*$%&|<>"), _mask(b".,;:?!'\"()-"), _mask(bytes(range(192, 256)))


def statistics(chunk: textvec.Chunk) -> np.ndarray:
    """Statistics of the texts of a chunk: a row each, a column for each of STATISTICS; an empty text has zeros."""
    n = chunk.rows
    share = lambda part, whole: part / np.maximum(whole, 1)
    starts, ends, rows = chunk.runs()
    size, words = (ends - starts).astype(float), np.bincount(rows, minlength=n)
    mean = share(np.bincount(rows, size, n), words)
    spread = np.sqrt(np.maximum(share(np.bincount(rows, size * size, n), words) - mean * mean, 0))
    hashes = chunk.hashes(starts, ends)
    distinct, _ = textvec.distinct_by_row(hashes, rows, n)
    at, grams = textvec.windows(hashes, rows, 3)
    _, repeated = textvec.distinct_by_row(grams, rows[at], n)
    from_, to, of = chunk.runs(textvec.NEWLINE)
    lines = np.bincount(of, minlength=n)
    kinds, _ = textvec.distinct_by_row(chunk.hashes(from_, to, 2), of, n)
    length, letters = np.diff(chunk.offsets), chunk.total(_LETTER)
    columns = (
        np.log1p(words), mean, spread, share(chunk.total(_UPPER), letters), share(chunk.total(_DIGIT), length), share(chunk.total(_SYMBOL), words),
        share(chunk.total(_mask(b"!")), words), share(chunk.total(_mask(b"|")), words), share(chunk.total(_PUNCTUATION), words),
        share(chunk.total(textvec.NEWLINE), words), share(chunk.total(_HIGH), length), share(distinct, words), share(repeated, words),
        share(lines - kinds, lines), np.log1p(share(length, lines)), share(chunk.total(textvec.BREAK), length),
    )
    return np.stack(columns, axis=1)


def document_statistics(docs: DataFrame) -> DataFrame:
    """``(doc_id, x)``: the statistics of each text as an array of doubles; null text is empty."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for chunk in textvec.chunks(batch.column("text")):
                x = statistics(chunk)
                lists = pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([ids.slice(chunk.lo, chunk.rows), lists], ["doc_id", "x"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, x array<double>")


@dataclass(frozen=True)
class QualityModel:
    """Standardisation, random features, ridge weights and the calibration's steps."""

    centre: np.ndarray
    scale: np.ndarray
    frequencies: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.centre) / self.scale, -FARTHEST, FARTHEST)
        return np.concatenate([np.cos(z @ self.frequencies + self.phases), np.ones((len(x), 1))], axis=1)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), self.knots, self.levels), 0.0, 1.0)


def _matrix(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), len(STATISTICS))


def isotonic(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The non-decreasing sequence nearest to ``values`` in weighted squares (pool adjacent violators)."""
    pools: list[list[float]] = []
    for value, weight in zip(values, weights, strict=True):
        pools.append([value * weight, weight, 1])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    return np.concatenate([np.full(int(n), total / weight) for total, weight, n in pools]) if pools else np.zeros(0)


def _added(parts: DataFrame, n: int, tasks: int) -> np.ndarray:
    """The sum of equally long vectors, one a row in column ``v``: a tree of additions, whose last few sums the driver adds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for v in batch.column("v").to_pylist():
                total = np.frombuffer(v) + (0 if total is None else total)
        if total is not None:
            yield pa.RecordBatch.from_pydict({"v": [total.tobytes()]})

    while tasks > LAST:
        tasks = max(LAST, -(-tasks // FAN_IN))
        parts = parts.repartition(tasks).mapInArrow(run, "v binary")
    return sum((np.frombuffer(r["v"]) for r in parts.collect()), np.zeros(n))


def fit(rows: DataFrame) -> QualityModel | None:
    """A model from ``(x, y)``; None if there is no row. What reaches the driver depends on FEATURES and BINS alone."""
    k = len(STATISTICS)
    sums = rows.agg(F.count("*"), *[f(F.get("x", F.lit(i))) for i in range(k) for f in (F.avg, F.stddev_pop)]).first()
    if not sums[0]:
        return None
    n, centre, scale = sums[0], np.array(sums[1::2], float), np.array(sums[2::2], float)
    random = np.random.default_rng(SEED)
    start = QualityModel(
        centre, np.where(scale > 1e-9, scale, 1.0), random.normal(0, 1 / WIDTH, (k, FEATURES)), random.uniform(0, 2 * np.pi, FEATURES), np.zeros(FEATURES + 1), np.array([0.0]), np.array([0.5])
    )
    size, tasks = FEATURES + 1, rows.rdd.getNumPartitions()

    def normal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right = np.zeros((size, size)), np.zeros(size)
        for batch in batches:
            z = start.features(_matrix(batch.column("x")))
            left += z.T @ z
            right += z.T @ batch.column("y").to_numpy()
        yield pa.RecordBatch.from_pydict({"v": [np.concatenate([left.ravel(), right]).tobytes()]})

    total = _added(rows.mapInArrow(normal, "v binary"), size * size + size, tasks)
    weights = np.linalg.solve(total[: size * size].reshape(size, size) + RIDGE * n * np.eye(size), total[size * size :])
    model = QualityModel(start.centre, start.scale, start.frequencies, start.phases, weights, start.knots, start.levels)

    def histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((3, BINS))
        for batch in batches:
            raw = np.clip(model.raw(_matrix(batch.column("x"))), LOW, HIGH)
            at = np.minimum(((raw - LOW) / (HIGH - LOW) * BINS).astype(int), BINS - 1)
            for row, w in zip(sums, (None, batch.column("y").to_numpy(), raw), strict=True):
                row += np.bincount(at, w, BINS)
        yield pa.RecordBatch.from_pydict({"v": [sums.tobytes()]})

    times, good, raw = _added(rows.mapInArrow(histogram, "v binary"), 3 * BINS, tasks).reshape(3, BINS)
    held = times > 0
    levels = isotonic(good[held] / times[held], times[held])
    # Each pool stands at its mean raw score; between pools the calibration is linear.
    edge = np.flatnonzero(np.diff(levels, prepend=-1.0) > 0)
    pooled = lambda v: np.add.reduceat(v[held], edge)
    knots = pooled(raw) / pooled(times)
    return QualityModel(model.centre, model.scale, model.frequencies, model.phases, weights, knots, levels[edge])


def scored(table: DataFrame, model: QualityModel | None) -> DataFrame:
    """doc_id and score for each row of statistics; 0.5 where nothing could be learnt."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("x"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.score(x) if model else np.full(len(x), 0.5))], ["doc_id", "score"])

    return table.select("doc_id", "x").mapInArrow(run, "doc_id long, score double")


def held_out(doc_id: str = "doc_id", folds: int = 3, fold: int = 1):
    """Whether crc32 of the id as text falls into the held-out fold; a null id does not."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == fold, F.lit(False))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score (probability of label 1) and predicted for each row of ``docs``.

    Learns from rows that are not held out and have a label; several labels of a document count with their mean, null
    labels not at all. Empty and null texts, and repeated rows, are scored like others; with no labelled row every
    score is 0.5. Only doc_id, text and quality are read.
    """
    table = written(document_statistics(docs), "text-statistics").select("*", held_out().alias("held_out"))
    known = labels.where("quality is not null").groupBy(F.col("doc_id").alias("_id")).agg(F.avg("quality").alias("y"))
    rows = table.where(~F.col("held_out")).join(known, F.col("doc_id") == F.col("_id")).select("x", "y")
    score = scored(table, fit(written(rows, "training-rows")))
    return score.select("doc_id", held_out().alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
