"""Removal of repeated passages: windows of WINDOW words that occur again, found behind a count-min prefilter.

First pass: every window is stood for by its minimiser, the least of the hashes of the SHORT-word runs inside it; equal
windows have equal minimisers, so counting these instead loses no repeated window. Each block of documents counts its
minimisers in a count-min sketch, of a fixed width for each slice of the hash space; only counters leave the block, and
the sketches of all blocks are merged by addition. A sketch never reports too little, so a window whose minimiser is not
estimated repeated occurs once. Second pass: only the other windows are grouped, by a 64-bit hash within slices
dealt by a second hash, and all but the first in order of (doc_id, place) are removed. A window that a block
holds several times leaves the block once, so that no window can fill a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketlake.llm import textvec
from docketlake.llm.blocks import block_files, load, spread
from docketlake.llm.common import WORD, read

#: Words of a window, and of the runs whose least hash stands for it.
WINDOW, SHORT = 20, 10
#: Minimisers that a slice of the hash space gets on average, and the least number of slices.
SLICE_ITEMS, LEAST_SLICES = 1 << 18, 64
#: A slice's count-min sketch has DEPTH rows of WIDTH counters (a power of two), four for each item on average.
DEPTH, WIDTH = 2, 4 * SLICE_ITEMS


class BlockWords:
    """The words of a block's documents in order of doc_id (null first), then of place."""

    def __init__(self, block: pa.Table):
        order = np.lexsort((block["place"].to_numpy(), *_id_keys(block["doc_id"])))
        self.block = block.take(pa.array(order)).combine_chunks()
        self.texts = self.block["text"].combine_chunks()
        data, at = textvec.column_bytes(self.texts)
        self.chunk = textvec.Chunk(0, len(order), data[at[0] : at[-1]], at - at[0])
        self.starts, self.ends, self.rows = self.chunk.runs()
        self.hashes = self.chunk.hashes(self.starts, self.ends)
        self.at, self.windows = textvec.windows(self.hashes, self.rows, WINDOW, 11)

    def minimisers(self) -> tuple[np.ndarray, np.ndarray]:
        """For each window, the least hash of its SHORT-word runs, and the word where the first such run begins."""
        n = len(self.hashes) - SHORT + 1
        if not len(self.at):
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        runs = textvec.joint_hash(self.hashes, np.arange(n), np.arange(n) + SHORT, 13)
        least, place = runs[self.at].copy(), self.at.copy()
        for k in range(1, WINDOW - SHORT + 1):
            other = runs[self.at + k]
            better = other < least
            least[better] = other[better]
            place[better] = (self.at + k)[better]
        return least, place


def _id_keys(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Sort keys of ids for lexsort (the last key is the first in rank): null comes first."""
    return column.fill_null(0).to_numpy(), column.is_valid().to_numpy()


def _grouped(slices: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(slices, kind="stable")
    values, first = np.unique(slices[order], return_index=True)
    for value, part in zip(values, np.split(order, first[1:]) if len(values) else [], strict=True):
        yield int(value), part


def _lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, parts)], dtype=np.int32)
    values = np.concatenate(parts) if parts else np.zeros(0, kind.to_pandas_dtype())
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values, kind))


def counters(hashes: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """The counter of each hash in each row of a sketch, numbered through the rows."""
    return np.stack([(textvec.mix(hashes + np.uint64(k + 1)) & np.uint64(width - 1)) + np.uint64(k * width) for k in range(DEPTH)]).astype(np.int64)


@dataclass(frozen=True)
class Sketch:
    """A count-min sketch that holds few of its counters: their numbers, ascending, and their values."""

    at: np.ndarray
    value: np.ndarray

    @classmethod
    def of(cls, hashes: np.ndarray, counts: np.ndarray, width: int = WIDTH) -> Sketch:
        at, inverse = np.unique(counters(hashes, width), return_inverse=True)
        return cls(at, np.bincount(inverse.ravel(), np.tile(counts, DEPTH), len(at)).astype(np.int64))


def merged(sketches: Iterable[Sketch], width: int = WIDTH) -> np.ndarray:
    """The sum of sketches, with all its counters."""
    total = np.zeros(DEPTH * width, np.int32)
    for sketch in sketches:
        total[sketch.at] += sketch.value.astype(np.int32)
    return total


def estimates(blocks: list[tuple[np.ndarray, np.ndarray]], width: int = WIDTH) -> list[np.ndarray]:
    """Count-min estimates of the hashes of each block, from the merged sketches of all blocks' (hashes, counts)."""
    total = merged((Sketch.of(h, c, width) for h, c in blocks), width)
    return [total[counters(h, width)].min(axis=0) for h, _ in blocks]


def sketches(blocks: DataFrame, slices: int, n_blocks: int) -> DataFrame:
    """``(slice, block, at, value)``: the sketch of each block's minimisers, by slice of the hash space."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, path in zip(batch.column("block").to_pylist(), batch.column("path").to_pylist(), strict=True):
                least, place = BlockWords(load(path)).minimisers()
                _, once = np.unique(place, return_index=True)
                hashes, counts = np.unique(least[once], return_counts=True)
                found = [(s, Sketch.of(hashes[p], counts[p])) for s, p in _grouped((hashes % np.uint64(slices)).astype(np.int64))]
                yield pa.RecordBatch.from_pydict(
                    {
                        "slice": pa.array([s for s, _ in found], pa.int64()),
                        "block": pa.array([number] * len(found), pa.int64()),
                        "at": _lists([x.at.astype(np.int32) for _, x in found], pa.int32()),
                        "value": _lists([x.value.astype(np.int32) for _, x in found], pa.int32()),
                    }
                )

    return spread(blocks.select("block", "path"), n_blocks).mapInArrow(count, "slice long, block long, at array<int>, value array<int>")


def repeated_words(blocks: DataFrame, slices: int, n_blocks: int) -> DataFrame:
    """``(block, first, size)``: for each block, runs of window starts to remove, as word numbers within the block."""

    def estimate(group: pa.Table) -> pa.Table:
        column = lambda name: [np.asarray(v.values) if len(v) else np.zeros(0, np.int32) for v in group[name]]
        places = column("at")
        total = merged(map(Sketch, places, column("value")))
        often = [np.packbits(total[at] > 1).tobytes() for at in places]
        return pa.table({"slice": group["slice"], "block": group["block"], "often": pa.array(often, pa.binary())})

    def group_windows(listed: pa.Table, reply: pa.Table) -> pa.Table:
        empty = pa.table({n: pa.array([], t) for n, t in (("slice", pa.int64()), ("block", pa.int64()), ("hashes", pa.list_(pa.int64())), ("ids", pa.list_(pa.int64())), ("valid", pa.list_(pa.bool_())), ("words", pa.list_(pa.int32())), ("own", pa.list_(pa.int32())))})
        if not listed.num_rows or not reply.num_rows:
            return empty
        words = BlockWords(load(listed["path"][0].as_py()))
        least, _ = words.minimisers()
        hashes, back = np.unique(least, return_inverse=True)
        often = np.zeros(len(hashes), bool)
        by_slice = dict(zip(reply["slice"].to_pylist(), reply["often"].to_pylist(), strict=True))
        for s, part in _grouped((hashes % np.uint64(slices)).astype(np.int64)):
            at, inverse = np.unique(counters(hashes[part]), return_inverse=True)
            bits = np.unpackbits(np.frombuffer(by_slice[s], np.uint8), count=len(at)).astype(bool)
            often[part] = bits[inverse.reshape(DEPTH, -1)].all(axis=0)
        candidates = np.flatnonzero(often[back])
        _, first = np.unique(words.windows[candidates], return_index=True)
        leaders = candidates[np.sort(first)]
        again = np.setdiff1d(candidates, leaders, assume_unique=True)
        # windows are dealt by a hash of their own, so that those of a very common passage part
        dealt = (textvec.joint_hash(words.hashes, words.at, words.at + WINDOW, 23) % np.uint64(slices)).astype(np.int64)
        own: dict[int, np.ndarray] = {s: again[p] for s, p in _grouped(dealt[again])}
        lead: dict[int, np.ndarray] = {s: leaders[p] for s, p in _grouped(dealt[leaders])}
        keys = list(lead)
        ids, valid = words.block["doc_id"].fill_null(0).to_numpy(), words.block["doc_id"].is_valid().to_numpy()
        doc = lambda part: words.rows[words.at[part]]
        return pa.table(
            {
                "slice": pa.array(keys, pa.int64()),
                "block": pa.array([listed["block"][0].as_py()] * len(keys), pa.int64()),
                "hashes": _lists([words.windows[lead[s]].view(np.int64) for s in keys], pa.int64()),
                "ids": _lists([ids[doc(lead[s])] for s in keys], pa.int64()),
                "valid": _lists([valid[doc(lead[s])] for s in keys], pa.bool_()),
                "words": _lists([words.at[lead[s]].astype(np.int32) for s in keys], pa.int32()),
                "own": _lists([words.at[own.get(s, np.zeros(0, np.int64))].astype(np.int32) for s in keys], pa.int32()),
            }
        )

    def judge(group: pa.Table) -> pa.Table:
        flat = lambda name: group[name].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        lengths = np.diff(np.asarray(group["hashes"].combine_chunks().offsets))
        row = np.repeat(np.arange(len(lengths)), lengths)
        block = group["block"].to_numpy()[row]
        hashes, at = flat("hashes"), flat("words")
        order = np.lexsort((at, block, flat("ids"), flat("valid"), hashes))
        later = np.zeros(len(order), bool)
        later[order[1:]] = hashes[order[1:]] == hashes[order[:-1]]
        bounds = np.cumsum([0, *lengths])
        own = [np.asarray(v.values) if len(v) else np.zeros(0, np.int32) for v in group["own"]]
        first, size = [], []
        for k in range(len(lengths)):
            part = slice(bounds[k], bounds[k + 1])
            starts = np.sort(np.concatenate([at[part][later[part]], own[k]])).astype(np.int64)
            head = np.flatnonzero(np.diff(starts, prepend=-2) != 1)
            first.append(starts[head].astype(np.int32))
            size.append(np.diff(head, append=len(starts)).astype(np.int32))
        return pa.table({"block": group["block"], "first": _lists(first, pa.int32()), "size": _lists(size, pa.int32())})

    replies = sketches(blocks, slices, n_blocks).groupBy("slice").applyInArrow(estimate, "slice long, block long, often binary")
    windows = by_block(blocks, replies, n_blocks).applyInArrow(
        group_windows, "slice long, block long, hashes array<long>, ids array<long>, valid array<boolean>, words array<int>, own array<int>"
    )
    return windows.groupBy("slice").applyInArrow(judge, "block long, first array<int>, size array<int>")


def by_block(blocks: DataFrame, rows: DataFrame, n_blocks: int):
    """The list of blocks beside what is known of each."""
    return spread(blocks.select("block", "path"), n_blocks).groupBy("block").cogroup(spread(rows, n_blocks).groupBy("block"))


def deduplicated(docs: DataFrame, texts: bool = True) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_removed, kept_sha256 and, with ``texts``, the kept words as text.

    A word goes if a window covers it whose words also begin earlier: in a row with a smaller doc_id (null is least),
    in another row with the same doc_id that comes before, or earlier in the same row. Windows are judged on the input.
    Texts shorter than a window, empty and null ones keep all words; an empty table gives no rows. Only doc_id and text
    are read.
    """
    blocks = block_files(docs.select("doc_id", "text"))
    n_blocks, size = blocks.agg(F.count("*"), F.coalesce(F.sum("n_bytes"), F.lit(0))).first()
    slices = max(LEAST_SLICES, size // 36 // SLICE_ITEMS)  # about one minimiser for 36 bytes
    runs = repeated_words(blocks, slices, n_blocks)

    def assemble(listed: pa.Table, found: pa.Table) -> pa.Table:
        words = BlockWords(load(listed["path"][0].as_py()))
        n = len(words.starts)
        edges = np.zeros(n + 1, np.int64)
        flat = lambda name: found[name].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        if found.num_rows:
            first, length = flat("first"), flat("size")
            np.add.at(edges, first, 1)
            np.add.at(edges, first + length - 1 + WINDOW, -1)
        gone = np.cumsum(edges[:-1]) > 0
        bounds = np.searchsorted(words.rows, np.arange(words.chunk.rows + 1))
        removed = np.concatenate([[0], np.cumsum(gone)])[bounds]
        raw = words.chunk.data.tobytes()
        digests, kept = [], []
        for k in range(words.chunk.rows):
            own = raw[words.chunk.offsets[k] : words.chunk.offsets[k + 1]].split()
            if removed[k + 1] > removed[k]:
                own = [own[i] for i in np.flatnonzero(~gone[bounds[k] : bounds[k + 1]])]
            text = b" ".join(own)
            digests.append(hashlib.sha256(text).hexdigest())
            if texts:
                kept.append(text.decode("utf-8"))
        out = {"doc_id": words.block["doc_id"], "n_words": np.diff(bounds), "n_removed": np.diff(removed), "kept_sha256": digests}
        return pa.table(out | ({"kept_text": pa.array(kept, pa.string())} if texts else {}))

    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + (", kept_text string" if texts else "")
    return by_block(blocks, runs, n_blocks).applyInArrow(assemble, schema)


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicated(read(spark, sf_dir, "documents"), texts=False)


ORACLE = rf"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws FROM documents
), win AS (
    SELECT doc_id, i, array_to_string(ws[i:i + {WINDOW - 1}], ' ') AS k FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - {WINDOW - 2})) AS i FROM d)
), again AS (
    SELECT doc_id, i FROM win QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, i) > 1
), gone AS (
    SELECT doc_id, list(DISTINCT j) AS js FROM (SELECT doc_id, unnest(range(i, i + {WINDOW})) AS j FROM again) GROUP BY doc_id
), words AS (
    SELECT doc_id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS j FROM d
), kept AS (
    SELECT words.doc_id, string_agg(w, ' ' ORDER BY j) AS text, count(*) AS n FROM words LEFT JOIN gone ON words.doc_id = gone.doc_id
    WHERE gone.js IS NULL OR NOT list_contains(gone.js, j) GROUP BY words.doc_id
)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(kept.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id
"""
