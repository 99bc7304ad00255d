"""Language-model scores: a subword lattice under unigram piece weights.

The pieces come from an existing public vocabulary, whose scores give the first weights. Every way to split a word into
pieces counts: a forward recursion in log space adds them up to the word's marginal probability, and a document's is
the product over its words and its end. Expectation-maximisation fits the weights to the word counts of the whole
training part. Pieces begin with the word-start mark or stand inside a word, so the lattice of a text falls apart into
those of its words, and each distinct word of a slice of the vocabulary is scored once. A single byte is always a piece
(byte fallback), so that no word lacks a split.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docketlake.llm import textvec
from docketlake.llm.blocks import block_files, load, spread
from docketlake.llm.common import read, written

#: Bound of a piece's bytes: none, so the lattice reaches as far as the vocabulary's longest piece.
LONGEST = math.inf
#: Rounds of expectation-maximisation, and the pseudo-count of each piece.
ROUNDS, SMOOTH = 3, 0.01
#: Words scored together hold at most about this many bytes.
CELLS = 1 << 18
#: Words of a block's text that a slice of the vocabulary gets on average.
SLICE_WORDS, LEAST_SLICES = 1 << 16, 64
#: The additive constant of the base model.
BASE_ADD = 0.1
MARK = b" "


@dataclass
class Pieces:
    """Pieces as bytes (the word-start mark is a space), by length and hash, with their log weights."""

    pieces: list[bytes]
    log_weight: np.ndarray
    log_end: float

    def __post_init__(self) -> None:
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for n in sorted({len(p) for p in self.pieces}):
            index = np.array([i for i, p in enumerate(self.pieces) if len(p) == n])
            data = np.frombuffer(b"".join(self.pieces[i] for i in index), np.uint8).reshape(-1, n)
            hashes = np.zeros(len(index), np.uint64)
            for k in range(n):
                hashes = _extended(hashes, data[:, k])
            order = np.argsort(hashes)
            self.by_length[n] = hashes[order], index[order]

    @classmethod
    def load(cls, path: str) -> Pieces:
        """The vocabulary of a sentencepiece model. Scores that are ranks (0, -1, ...) weigh as 1 / (10 + rank)."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        weight: dict[bytes, float] = {bytes([b]): 1e-7 for b in range(256)}
        scores = [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        ranked = any(s < -100 for _, s in scores)
        for piece, score in scores:
            data = piece.encode("utf-8").replace("▁".encode(), MARK).lower()  # A to Z, as the texts
            if 0 < len(data) <= LONGEST and MARK not in data[1:]:
                weight[data] = weight.get(data, 0.0) + (1 / (10 - score) if ranked else math.exp(score))
        total = sum(weight.values())
        return cls(list(weight), np.log(np.array(list(weight.values())) / total * 0.999), math.log(0.001))

    def weighed(self, counts: np.ndarray, ends: float) -> Pieces:
        total = counts.sum() + SMOOTH * len(counts) + ends + 1
        return Pieces(self.pieces, np.log((counts + SMOOTH) / total), math.log((ends + 1) / total))


def _extended(hashes: np.ndarray, data: np.ndarray) -> np.ndarray:
    return hashes * np.uint64(0x9E3779B97F4A7C15) + _BYTE[data]


_BYTE = textvec.mix(np.arange(1, 257, dtype=np.uint64))


class Lattice:
    """The lattices of equally long words: which piece, with what log weight, spans each stretch of each word."""

    def __init__(self, data: np.ndarray, pieces: Pieces):
        self.n, self.spans, hashes = data.shape[1], {}, np.zeros(data.shape, np.uint64)
        for length in range(1, min(self.n, max(pieces.by_length)) + 1):
            hashes = _extended(hashes[:, : self.n - length + 1], data[:, length - 1 :])
            if length in pieces.by_length:
                keys, index = pieces.by_length[length]
                at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
                held = keys[at] == hashes
                piece = index[at]
                self.spans[length] = piece, np.where(held, pieces.log_weight[piece], -np.inf)

    def forward(self) -> np.ndarray:
        """Log weight of all splits of the first j bytes, for each j."""
        alpha = np.full((len(self.spans[1][0]), self.n + 1), -np.inf)
        alpha[:, 0] = 0
        for j in range(1, self.n + 1):
            for length, (_, weight) in self.spans.items():
                if length <= j:
                    np.logaddexp(alpha[:, j], alpha[:, j - length] + weight[:, j - length], out=alpha[:, j])
        return alpha

    def expected(self, times: np.ndarray, size: int) -> np.ndarray:
        """Expected uses of each piece, when word k occurs times[k] times."""
        alpha = self.forward()
        beta = np.full(alpha.shape, -np.inf)
        beta[:, self.n] = 0
        for j in range(self.n - 1, -1, -1):
            for length, (_, weight) in self.spans.items():
                if j + length <= self.n:
                    np.logaddexp(beta[:, j], beta[:, j + length] + weight[:, j], out=beta[:, j])
        total = np.zeros(size)
        for length, (piece, weight) in self.spans.items():
            share = np.exp(alpha[:, : self.n - length + 1] + weight + beta[:, length:] - alpha[:, self.n :]) * times[:, None]
            total += np.bincount(piece.ravel(), share.ravel(), size)
        return total


def _by_length(words: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Indexes of words of one length, and their bytes behind the word-start mark, some at a time."""
    words = words.cast(pa.large_binary())
    at = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1] if len(words) else np.zeros(1, np.int64)
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)
    lengths = np.diff(at)
    order = np.argsort(lengths, kind="stable")
    values, first = np.unique(lengths[order], return_index=True)
    for n, group in zip(values, np.split(order, first[1:]) if len(order) else [], strict=True):
        step = max(1, CELLS // (int(n) + 1))
        for lo in range(0, len(group), step):
            part = group[lo : lo + step]
            cells = np.empty((len(part), n + 1), np.uint8)
            cells[:, 0] = MARK[0]
            cells[:, 1:] = data[at[part][:, None] + np.arange(n)]
            yield part, cells


def log_probabilities(words: pa.Array, pieces: Pieces) -> np.ndarray:
    """Natural log of the marginal probability of each word."""
    out = np.zeros(len(words))
    for part, cells in _by_length(words):
        out[part] = Lattice(cells, pieces).forward()[:, -1]
    return out


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 10 == 0, F.lit(False))


class BlockTokens:
    """The words of a block in lower case as a dictionary, and which word stands where."""

    def __init__(self, block: pa.Table):
        self.block = block
        data, at = textvec.column_bytes(block["text"].combine_chunks())
        self.chunk = textvec.Chunk(0, block.num_rows, data[at[0] : at[-1]], at - at[0])
        starts, ends, self.rows = self.chunk.runs()
        kept = textvec.LOWER[self.chunk.data[~textvec.BREAK[self.chunk.data]]]
        offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(kept.tobytes())])
        coded = words.dictionary_encode()
        self.index, self.words = coded.indices.to_numpy(), coded.dictionary.cast(pa.binary())
        n = len(self.words)
        at = np.frombuffer(self.words.buffers()[1], np.int32)[: n + 1].astype(np.int64) if n else np.zeros(1, np.int64)
        data = np.frombuffer(self.words.buffers()[2] or b"", np.uint8)
        self.hashes = textvec.run_hash(textvec._value(3)[data], at[:-1], at[1:]) if n else np.zeros(0, np.uint64)

    def slices(self, n: int) -> Iterator[tuple[int, np.ndarray]]:
        """For each slice of the vocabulary, the numbers of the block's words in it, ascending."""
        of = (self.hashes % np.uint64(n)).astype(np.int64)
        order = np.argsort(of, kind="stable")
        values, first = np.unique(of[order], return_index=True)
        for value, part in zip(values, np.split(order, first[1:]) if len(order) else [], strict=True):
            yield int(value), part


def _list_column(parts: list[pa.Array], kind: pa.DataType) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, parts)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.concat_arrays(parts) if parts else pa.array([], kind))


def _words_of(table: pa.Table) -> pa.Array:
    return table["words"].combine_chunks().flatten().cast(pa.binary())


def scored(docs: DataFrame, vocabulary: str, rounds: int = ROUNDS) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score.

    Rows whose id is not held out are learnt from (a null id is not held out; repeated rows count as often as they
    come). A null or empty text has its end as only token. With nothing to learn from, the base model spreads evenly
    over the one unseen token and the lattice keeps the vocabulary's weights; an empty table gives no rows. Only doc_id
    and text are read. Word counts of the whole training part are gathered, without cutting rare words.
    """
    rows = docs.select("doc_id", "text").withColumn("held", is_held_out(F.col("doc_id").cast("long")))
    blocks = block_files(rows)
    train_docs = rows.where(~F.col("held")).count()
    n_blocks, size = blocks.agg(F.count("*"), F.coalesce(F.sum("n_bytes"), F.lit(0))).first()
    slices = max(LEAST_SLICES, size // 32 // SLICE_WORDS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, path in zip(batch.column("block").to_pylist(), batch.column("path").to_pylist(), strict=True):
                tokens = BlockTokens(load(path))
                learnt = ~tokens.block["held"].to_numpy()[tokens.rows]
                counts = np.bincount(tokens.index[learnt], minlength=len(tokens.words))
                parts = list(tokens.slices(slices))
                yield pa.RecordBatch.from_pydict(
                    {
                        "slice": pa.array([s for s, _ in parts], pa.int64()),
                        "block": pa.array([number] * len(parts), pa.int64()),
                        "words": _list_column([tokens.words.take(pa.array(p)) for _, p in parts], pa.binary()),
                        "counts": _list_column([pa.array(counts[p], pa.int64()) for _, p in parts], pa.int64()),
                    }
                )

    def add(group: pa.Table) -> pa.Table:
        coded = _words_of(group).dictionary_encode()
        total = np.bincount(coded.indices.to_numpy(), group["counts"].combine_chunks().flatten().to_numpy(), len(coded.dictionary)).astype(np.int64)
        held = np.flatnonzero(total)
        return pa.table(
            {
                "slice": pa.array([group["slice"][0].as_py()], pa.int64()),
                "words": _list_column([coded.dictionary.take(pa.array(held))], pa.binary()),
                "counts": _list_column([pa.array(total[held])], pa.int64()),
            }
        )

    listed = spread(blocks.select("block", "path"), n_blocks)
    asked = written(listed.mapInArrow(count, "slice long, block long, words array<binary>, counts array<long>"), "block-words")
    known = written(asked.groupBy("slice").applyInArrow(add, "slice long, words array<binary>, counts array<long>"), "word-counts")
    n_words, n_distinct = known.agg(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x)), F.sum(F.size("words"))).first()
    train_tokens, distinct = int(n_words or 0) + train_docs, int(n_distinct or 0) + (train_docs > 0)
    pieces = fitted(known, Pieces.load(vocabulary), train_docs, rounds)
    floor = math.log10(train_tokens + BASE_ADD * (distinct + 1))

    def answer(group: pa.Table, counted: pa.Table) -> pa.Table:
        words = _words_of(group)
        coded = words.dictionary_encode()
        index = coded.indices.to_numpy()
        times = np.zeros(len(coded.dictionary), np.int64)
        if counted.num_rows:
            at = pc.index_in(coded.dictionary, _words_of(counted)).to_numpy(zero_copy_only=False)
            found = ~np.isnan(at) if at.dtype.kind == "f" else np.ones(len(at), bool)
            times[found] = counted["counts"].combine_chunks().flatten().to_numpy()[at[found].astype(np.int64)]
        log = log_probabilities(coded.dictionary, pieces) / math.log(10)
        offsets = group["words"].combine_chunks().offsets
        offsets = pa.array(np.asarray(offsets) - np.asarray(offsets)[0], pa.int32())
        return pa.table(
            {
                "slice": group["slice"],
                "block": group["block"],
                "counts": pa.ListArray.from_arrays(offsets, pa.array(times[index])),
                "logs": pa.ListArray.from_arrays(offsets, pa.array(log[index])),
            }
        )

    answers = asked.select("slice", "block", "words").groupBy("slice").cogroup(known.groupBy("slice")).applyInArrow(answer, "slice long, block long, counts array<long>, logs array<double>")
    log_end = pieces.log_end / math.log(10)
    base_end = math.log10(train_docs + BASE_ADD) - floor

    def score(listed: pa.Table, reply: pa.Table) -> pa.Table:
        block = load(listed["path"][0].as_py())
        tokens = BlockTokens(block)
        n = block.num_rows
        times, logs = np.zeros(len(tokens.words), np.int64), np.zeros(len(tokens.words))
        replies = {s: k for k, s in enumerate(reply["slice"].to_pylist())}
        for s, part in tokens.slices(slices):
            times[part] = np.asarray(reply["counts"][replies[s]].values)
            logs[part] = np.asarray(reply["logs"][replies[s]].values)
        words = np.bincount(tokens.rows, minlength=n)
        base = np.log10(times + BASE_ADD) - floor
        sums = lambda v: np.bincount(tokens.rows, v[tokens.index], n)
        return pa.table(
            {
                "doc_id": block["doc_id"],
                "held_out": block["held"],
                "n_tokens": words + 1,
                "n_known": sums((times > 0).astype(float)).astype(np.int64) + (train_docs > 0),
                "train_tokens": np.full(n, train_tokens),
                "base_score": sums(base) + base_end,
                "score": sums(logs) + log_end,
            }
        )

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return listed.groupBy("block").cogroup(spread(answers, n_blocks).groupBy("block")).applyInArrow(score, schema)


def fitted(known: DataFrame, pieces: Pieces, train_docs: int, rounds: int) -> Pieces:
    """Expectation-maximisation over all counted words; each round brings one number a piece to the driver."""
    for _ in range(rounds if train_docs else 0):

        def expect(batches: Iterator[pa.RecordBatch], pieces: Pieces = pieces) -> Iterator[pa.RecordBatch]:
            total = np.zeros(len(pieces.pieces))
            for batch in batches:
                words, counts = batch.column("words").flatten().cast(pa.binary()), batch.column("counts").flatten().to_numpy()
                for part, cells in _by_length(words):
                    total += Lattice(cells, pieces).expected(counts[part].astype(float), len(total))
            yield pa.RecordBatch.from_pydict({"v": [total.tobytes()]})

        def add(batches: Iterator[pa.RecordBatch], size: int = len(pieces.pieces)) -> Iterator[pa.RecordBatch]:
            total = np.zeros(size)
            for batch in batches:
                for v in batch.column("v").to_pylist():
                    total += np.frombuffer(v)
            yield pa.RecordBatch.from_pydict({"v": [total.tobytes()]})

        parts = known.select("words", "counts").mapInArrow(expect, "v binary").repartition(4).mapInArrow(add, "v binary").collect()
        pieces = pieces.weighed(sum((np.frombuffer(r["v"]) for r in parts), np.zeros(len(pieces.pieces))), train_docs)
    return pieces


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return scored(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
