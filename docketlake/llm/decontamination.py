"""Benchmark decontamination: n-gram seeds find passages, Smith-Waterman alignment scores them.

A test item's seeds are its n-grams of words, however frequent. Every seed that a document shares with an item opens a
window of the document about the item's length, which is aligned with the item word by word; edited copies keep most of
the score. A window is left unaligned only if the words it has in common with the item, each matched, could not reach
the threshold (so phrases of everyday language cost little). No number of documents, items or windows is capped. Words
are runs of ASCII letters and digits and of any other non-ASCII characters; letters A to Z count as lower case.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from docketlake.llm import textvec
from docketlake.llm.common import read, small_batches

#: Words of a seed.
SEED_WORDS = 3
#: Alignment: a match, a mismatch and a gap; and the share of the item's best possible score from which a text counts.
MATCH, MISMATCH, GAP, THRESHOLD = 2, -1, -1, 0.5
#: Items handled, and broadcast, at a time; a larger benchmark takes several passes.
BLOCK_ITEMS = 2000
#: Places of seeds handled at a time, and words of windows, to bound memory.
PLACES, CELLS = 1 << 19, 1 << 16

BREAK = np.ones(256, bool)
BREAK[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def _words(chunk: textvec.Chunk) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, rows = chunk.runs(BREAK)
    return chunk.hashes(starts, ends, lower=True), rows


def _merged(batches: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    return tuple(np.concatenate(x) for x in zip(*batches, strict=True))


@dataclass
class Items:
    """A block of test items: their words (as places in ``known``, the different words of all), and their seeds by hash."""

    ids: list[int]
    known: np.ndarray
    words: list[np.ndarray]
    seeds: np.ndarray
    seed_of: np.ndarray
    item: np.ndarray
    at: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple[int, str | None]]) -> Items:
        words, hashes, items, starts = [], [], [], []
        for k, (_, text) in enumerate(rows):
            chunk = next(textvec.chunks(pa.array([text], pa.string())))
            found, rows_of = _words(chunk)
            words.append(found)
            at, grams = textvec.windows(found, rows_of, SEED_WORDS)
            hashes.append(grams)
            items.append(np.full(len(at), k))
            starts.append(at)
        empty = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        grams, item, at = (np.concatenate(x) for x in ((hashes, items, starts) if rows else empty))
        seeds, seed_of = np.unique(grams, return_inverse=True)
        order = np.argsort(seed_of, kind="stable")
        known = np.unique(np.concatenate(words)) if rows else np.zeros(0, np.uint64)
        return cls([i for i, _ in rows], known, [np.searchsorted(known, w) for w in words], seeds, seed_of[order], item[order], at[order])

    def found(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the hashes are seeds, and which seed each is."""
        if not len(self.seeds):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        k = np.minimum(np.searchsorted(self.seeds, grams), len(self.seeds) - 1)
        hit = np.flatnonzero(self.seeds[k] == grams)
        return hit, k[hit]

    def coded(self, hashes: np.ndarray) -> np.ndarray:
        """The place of each word in ``known``, or its length."""
        k = np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)
        return np.where(self.known[k] == hashes, k, len(self.known))


def align(item: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Smith-Waterman scores of one item against each row of ``texts`` (words as hashes, linear gaps)."""
    steps = -GAP * np.arange(texts.shape[1])
    above, best = np.zeros(texts.shape, np.int32), np.zeros(len(texts), np.int32)
    for word in item:
        diagonal = np.zeros_like(above)
        diagonal[:, 1:] = above[:, :-1]
        row = np.maximum(np.maximum(diagonal + np.where(texts == word, MATCH, MISMATCH), above + GAP), 0)
        above = np.maximum.accumulate(row + steps, axis=1) - steps
        np.maximum(best, above.max(axis=1), out=best)
    return best


def _windows(hit_at: np.ndarray, seed: np.ndarray, rows: np.ndarray, items: Items) -> tuple[np.ndarray, ...]:
    """Item, row, first word and seeds shared of each window, from the places of seeds in the texts."""
    first = np.searchsorted(items.seed_of, np.arange(len(items.seeds) + 1))
    times = first[seed + 1] - first[seed]
    pads = np.array([len(w) // 4 + 4 for w in items.words])
    longest = int(items.at.max()) + 1
    n_rows, n_starts = int(rows[-1]) + 1, len(rows) + longest + 1  # the quotients by pad are fewer
    steps = np.searchsorted(np.cumsum(times), np.arange(0, times.sum(), PLACES), side="right")
    parts = []
    for lo, hi in zip(steps, [*steps[1:], len(seed)], strict=True):
        if lo == hi:
            continue
        n, at = times[lo:hi], hit_at[lo:hi]
        # every place of the seed in every item
        pick = np.repeat(first[seed[lo:hi]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        place, item = np.repeat(at, n), items.item[pick]
        start = (place - items.at[pick]) // pads[item] + longest
        parts.append(np.unique((item * n_rows + rows[place]) * n_starts + start, return_counts=True))
    keys, counts = _merged(parts)
    keys, inverse = np.unique(keys, return_inverse=True)
    rest, start = np.divmod(keys, n_starts)
    item, row = np.divmod(rest, n_rows)
    return item, row, (start - longest - 1) * pads[item], np.bincount(inverse, counts).astype(np.int64)


def passages(chunk: textvec.Chunk, items: Items, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, item, score (share of the best possible) and seeds shared, for each row and item that reach the threshold."""
    hashes, rows = _words(chunk)
    at, grams = textvec.windows(hashes, rows, SEED_WORDS)
    hit, seed = items.found(grams)
    none = np.zeros(0, np.int64)
    if not len(hit):
        return none, none, np.zeros(0), none
    item, row, start, shared = _windows(at[hit], seed, rows, items)
    codes, ends = items.coded(hashes), np.searchsorted(rows, np.arange(chunk.rows + 1))
    best = np.zeros(len(item))
    bounds = np.searchsorted(item, np.arange(len(items.ids) + 1))
    local = np.zeros(len(items.known) + 1, np.int16 if len(items.known) < 1 << 15 else np.int64)
    for k in np.unique(item):
        names, words, own = np.unique(items.words[k], return_inverse=True, return_counts=True)
        local[:] = len(names)
        local[names] = np.arange(len(names))
        width = len(words) + 3 * (len(words) // 4 + 4)
        step = max(1, CELLS // width)
        for lo in range(bounds[k], bounds[k + 1], step):
            part = slice(lo, min(lo + step, bounds[k + 1]))
            index = start[part, None] + np.arange(width)
            outside = (index < ends[row[part]][:, None]) | (index >= ends[row[part] + 1][:, None])
            text = np.where(outside, len(names), local[codes[np.clip(index, 0, len(hashes) - 1)]])
            # matching all words in common, each as often as both have it, is the most that an alignment can score
            cells = text + (len(names) + 1) * np.arange(len(text))[:, None]
            times = np.bincount(cells.ravel(), minlength=len(text) * (len(names) + 1)).reshape(len(text), -1)[:, :-1]
            able = np.flatnonzero(np.minimum(times, own).sum(axis=1) / len(words) >= threshold)
            if len(able):
                best[lo + able] = align(words, text[able]) / (MATCH * len(words))
    # the windows of an item and a row follow each other
    first = np.flatnonzero(np.diff(item, prepend=-1) | np.diff(row, prepend=-1))
    score, seeds = np.maximum.reduceat(best, first), np.add.reduceat(shared, first)
    held = score >= threshold
    return row[first][held], item[first][held], score[held], seeds[held]


def blocks(benchmark: DataFrame) -> Iterator[Items]:
    """The benchmark in blocks of about BLOCK_ITEMS items."""
    small_batches(benchmark.sparkSession)
    tests = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
    n = max(1, -(-tests.count() // BLOCK_ITEMS))
    for k in range(n):
        block = tests.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        yield Items.of(sorted(map(tuple, block.collect()), key=lambda x: (x[0] is None, x[0] or 0, x[1] or "")))


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, item_id, score, n_seeds)`` for each document and test item whose alignment reaches ``threshold``.

    Null and empty texts hold nothing; an item of fewer words than a seed has no seed and is found nowhere; repeated
    rows give repeated pairs; empty tables give no pair. Only doc_id, text and item_id, text are read.
    """
    schema, result = "doc_id long, item_id long, score double, n_seeds long", None
    for items in blocks(benchmark):

        def run(batches: Iterator[pa.RecordBatch], items: Items = items) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = batch.column("doc_id")
                for chunk in textvec.chunks(batch.column("text")):
                    row, item, score, seeds = passages(chunk, items, threshold)
                    named = pa.array(items.ids, pa.int64()).take(pa.array(item))
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array(chunk.lo + row)), named, pa.array(score), pa.array(seeds)], ["doc_id", "item_id", "score", "n_seeds"])

        found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)
        result = found if result is None else result.unionByName(found)
    return result


def clean(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no test item."""
    schema = StructType([StructField("_row", docs.schema)])
    for items in blocks(benchmark):

        def run(batches: Iterator[pa.RecordBatch], items: Items = items) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                kept = np.ones(len(batch), bool)
                for chunk in textvec.chunks(batch.column("_text")):
                    kept[chunk.lo + passages(chunk, items, threshold)[0]] = False
                yield pa.RecordBatch.from_arrays([batch.column("_row").filter(pa.array(kept))], ["_row"])

        whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
        docs = docs.select(whole, F.col("text").alias("_text")).mapInArrow(run, schema).select("_row.*")
    return docs


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
