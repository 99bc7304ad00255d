"""Token ids in binary shards, bit-packed at a fixed width.

A shard holds, in this order: the magic bytes; blocks of BLOCK_IDS ids, each id in the least number of bits that the
vocabulary needs, lowest bit first; the byte offset of every block; the doc_ids with a flag for null, and the start of
every document within the shard; and a tail with the counts. So a document is found by its start, its blocks by their
offsets, and a block unpacks in a few numpy operations. Numbers are little-endian.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docketlake.llm.common import read, scratch, small_batches, written
from docketlake.llm.textvec import column_bytes

MAGIC = b"DLTOKEN1"
BLOCK_IDS = 8192
TAIL = np.dtype([("bits", "<u4"), ("block_ids", "<u4"), ("n_docs", "<u8"), ("n_ids", "<u8"), ("n_blocks", "<u8"), ("index_at", "<u8")])
END_ID = 2
#: Bytes of words and ids that a worker keeps, with WORD_COST for each word, in two halves: a full one becomes the old
#: one, whose words come back when they are met again, and so frequent words stay.
CACHED_BYTES, WORD_COST = 350 << 20, 150
#: Ids that a task reads back, in whole shards.
READ_IDS = 1 << 22
#: Words not met before that are encoded at a time.
JOINED_WORDS = 1 << 16
#: Bytes of text of a shard, and the number of shards beyond which they grow instead.
SHARD_BYTES, MOST_SHARDS = 4 << 20, 50_000


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids, each in ``bits`` bits, lowest bit first, filled up to a whole byte at the end. A wider id is an error."""
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"id {int(ids.max())} has more than {bits} bits")
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    digits = (ids.astype(np.uint64)[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(digits.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(data: bytes | memoryview, n: int, bits: int) -> np.ndarray:
    """The ``n`` ids of a packed block, as 32-bit numbers."""
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", n).astype("<u4")
    digits = np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little")[: n * bits].reshape(n, bits)
    return (digits.astype(np.uint64) << np.arange(bits, dtype=np.uint64)).sum(axis=1).astype("<u4")


class ShardWriter:
    """Writes a shard in one pass, holding one block and the index of documents; ``close`` makes it visible."""

    def __init__(self, uri: str, bits: int, attempt: str):
        self.files, self.path = fs.FileSystem.from_uri(uri)
        self.bits, self.temporary = bits, f"{self.path}.{attempt}.tmp"
        self.files.create_dir(os.path.dirname(self.path), recursive=True)
        self.out = self.files.open_output_stream(self.temporary)
        self.out.write(MAGIC)
        self.at, self.waiting, self.held, self.n_ids = len(MAGIC), [], 0, 0
        self.blocks, self.doc_ids, self.nulls, self.starts = array("Q", [self.at]), array("q"), array("B"), array("Q", [0])

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.doc_ids.append(0 if doc_id is None else doc_id)
        self.nulls.append(doc_id is None)
        self.n_ids += len(ids)
        self.starts.append(self.n_ids)
        self.waiting.append(ids)
        self.held += len(ids)
        if self.held >= 16 * BLOCK_IDS:
            self._flush(self.held // BLOCK_IDS * BLOCK_IDS)

    def _flush(self, n: int) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.zeros(0, "<u4")
        for lo in range(0, n, BLOCK_IDS):
            block = pack(ids[lo : min(n, lo + BLOCK_IDS)], self.bits)
            self.out.write(block)
            self.at += len(block)
            self.blocks.append(self.at)
        self.waiting, self.held = [ids[n:]], len(ids) - n

    def close(self) -> None:
        self._flush(self.held)
        index_at = self.at
        for values, kind in ((self.blocks, "<u8"), (self.doc_ids, "<i8"), (self.nulls, "<u1"), (self.starts, "<u8")):
            self.out.write(np.asarray(values, kind).tobytes())
        self.out.write(np.array([(self.bits, BLOCK_IDS, len(self.doc_ids), self.n_ids, len(self.blocks) - 1, index_at)], TAIL).tobytes())
        self.out.close()
        self.files.move(self.temporary, self.path)


@dataclass
class Shard:
    """A written shard, opened for random access."""

    file: pa.NativeFile
    bits: int
    block_ids: int
    n_ids: int
    blocks: np.ndarray
    doc_ids: np.ndarray
    nulls: np.ndarray
    starts: np.ndarray

    @classmethod
    def open(cls, uri: str) -> Shard:
        files, path = fs.FileSystem.from_uri(uri)
        file = files.open_input_file(path)
        size = file.size()
        if file.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError(f"{uri} is no token shard")
        tail = np.frombuffer(file.read_at(TAIL.itemsize, size - TAIL.itemsize), TAIL)[0]
        at, found = int(tail["index_at"]), []
        for kind, n in (("<u8", tail["n_blocks"] + 1), ("<i8", tail["n_docs"]), ("<u1", tail["n_docs"]), ("<u8", tail["n_docs"] + 1)):
            found.append(np.frombuffer(file.read_at(int(n) * np.dtype(kind).itemsize, at), kind))
            at += found[-1].nbytes
        return cls(file, int(tail["bits"]), int(tail["block_ids"]), int(tail["n_ids"]), *found)

    def ids(self, start: int, end: int) -> np.ndarray:
        """The ids from ``start`` to ``end`` of the shard; only the blocks that hold them are read."""
        if start >= end:
            return np.zeros(0, "<u4")
        first, last = start // self.block_ids, -(-end // self.block_ids)
        data = self.file.read_at(int(self.blocks[last] - self.blocks[first]), int(self.blocks[first]))
        base = self.blocks[first]
        parts = [
            unpack(memoryview(data)[int(self.blocks[b] - base) : int(self.blocks[b + 1] - base)], min(self.block_ids, self.n_ids - b * self.block_ids), self.bits)
            for b in range(first, last)
        ]
        return np.concatenate(parts)[start - first * self.block_ids : end - first * self.block_ids]

    def document(self, k: int) -> np.ndarray:
        return self.ids(int(self.starts[k]), int(self.starts[k + 1]))


class WordTokenizer:
    """A tokenizer whose pieces never cross white space: each distinct word is encoded once by the library and kept."""

    loaded: dict[str, WordTokenizer] = {}

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.known, self.old, self.held = Tokenizer.from_file(path), {}, {}, 0
        self.bits = max(1, (self.tokenizer.get_vocab_size() - 1).bit_length())

    @classmethod
    def of(cls, path: str) -> WordTokenizer:
        if path not in cls.loaded:
            cls.loaded[path] = cls(path)
        return cls.loaded[path]

    def encode(self, text: bytes) -> np.ndarray:
        words = text.split()  # of bytes: at space and U+0009 to U+000D, as elsewhere here
        if new := list(set(words).difference(self.known)):
            if self.held > CACHED_BYTES // 2:
                self.old, self.known, self.held, new = self.known, {}, 0, list(set(words))
            unseen = []
            for w in new:
                if w in self.old:
                    self.known[w] = self.old[w]
                else:
                    unseen.append(w)
            for lo in range(0, len(unseen), JOINED_WORDS):
                self._learn(unseen[lo : lo + JOINED_WORDS])
            self.held += sum(len(w) + len(self.known[w]) + WORD_COST for w in new)
        return np.frombuffer(b"".join(map(self.known.__getitem__, words)), "<u4")

    def _learn(self, words: list[bytes]) -> None:
        """Encode words as one text, cheaper than each alone, and part its ids where the next word's characters start."""
        spelled = [w.decode("utf-8") for w in words]
        found = self.tokenizer.encode(" ".join(spelled), add_special_tokens=False)
        ids = np.array(found.ids, "<u4").tobytes()
        begins = np.fromiter((begin for begin, _ in found.offsets), np.int64, len(found))
        following = np.cumsum(np.fromiter(map(len, spelled), np.int64, len(spelled)) + 1)
        lo = 0
        for w, hi in zip(words, (4 * np.searchsorted(begins, following)).tolist(), strict=True):
            self.known[w] = ids[lo:hi]
            lo = hi


def write_shards(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Encode ``docs`` and write a shard for each range of doc_id, ids ascending (null first).

    Returns the manifest: ``shard`` (ascending with doc_id), ``path``, ``n_docs``, ``n_ids``. A task that runs again
    writes the same file again under its final name, only when complete. Null text is empty and gives the end id alone;
    repeated rows are written as often as they come; an empty table gives no shard; an ``end_id`` that the vocabulary's
    bits cannot hold is an error.
    """
    small_batches(docs.sparkSession)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, min(MOST_SHARDS, -(-size // SHARD_BYTES)))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, words, writer = TaskContext.get(), WordTokenizer.of(tokenizer), None
        end = np.array([end_id], "<u4")
        path = f"{folder}/shard-{task.partitionId():07d}.tok"
        for batch in batches:
            data, at = column_bytes(batch.column("text"))
            raw = memoryview(data)
            for k, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                writer = writer or ShardWriter(path, words.bits, str(task.taskAttemptId()))
                writer.add(doc_id, np.concatenate([words.encode(bytes(raw[at[k] : at[k + 1]])), end]))
        if writer:
            writer.close()
            yield pa.RecordBatch.from_pydict({"shard": [task.partitionId()], "path": [path], "n_docs": [len(writer.doc_ids)], "n_ids": [writer.n_ids]})

    ranged = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange(shards, "doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    return written(ranged.mapInArrow(write, "shard long, path string, n_docs long, n_ids long"), "token-manifest")


def read_shards(manifest: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start over all shards, n_tokens and the checksum of its ids."""
    starts = F.coalesce(F.sum("n_ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shards, ids = manifest.agg(F.count("*"), F.sum("n_ids")).first()
    n = max(1, min(shards, -(-(ids or 0) // READ_IDS)))

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist(), strict=True):
                shard = Shard.open(path)
                lo, docs = 0, len(shard.doc_ids)
                while lo < docs:  # some blocks at a time; a longer document comes whole
                    hi = max(lo + 1, int(np.searchsorted(shard.starts, shard.starts[lo] + np.uint64(64 * BLOCK_IDS), side="right")) - 1)
                    raw, at = memoryview(shard.ids(int(shard.starts[lo]), int(shard.starts[hi])).tobytes()), (shard.starts[lo : hi + 1] - shard.starts[lo]).astype(np.int64) * 4
                    sums = [zlib.crc32(raw[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(shard.doc_ids[lo:hi], pa.int64(), mask=shard.nulls[lo:hi].astype(bool)),
                            pa.array(shard.starts[lo:hi].astype(np.int64) + base),
                            pa.array((at[1:] - at[:-1]) // 4),
                            pa.array(sums, pa.int64()),
                        ],
                        ["doc_id", "start", "n_tokens", "ids_crc32"],
                    )
                    lo = hi

    return manifest.select("path", starts.cast("long").alias("base")).repartition(n).mapInArrow(load, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op6_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return read_shards(write_shards(read(spark, sf_dir, "documents"), scratch(spark, "tokens"), public_tokenizers.path("word_bpe_49k.json")))
