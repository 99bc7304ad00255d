"""Documents in blocks of bounded bytes, each a file of the shared folder.

What the corpus knows about a block's windows or words comes back keyed by block and meets the texts where the file is
opened, so that texts are never shuffled. A block closes at about BLOCK_BYTES; one longer text stands alone with what
came with it in an Arrow batch. Rows are told apart by place, so that null or repeated doc_ids do no harm.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketlake.llm.common import scratch, small_batches, written

#: Bytes of text at which a block closes.
BLOCK_BYTES = 8 << 20
#: Tasks that handle blocks, at most; each takes several where there are more blocks.
MOST_TASKS = 50_000


def block_files(docs: DataFrame) -> DataFrame:
    """Write the rows of ``docs`` (doc_id, text and others) in blocks: ``(block, path, n_rows, n_bytes)``.

    The files hold the columns of ``docs`` and ``place``, a number of the row; null text is empty. A file's name holds
    its attempt, and only files of tasks that ended well are in the result.
    """
    spark, folder = docs.sparkSession, scratch(docs.sparkSession, "blocks")
    small_batches(spark)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        files, root = fs.FileSystem.from_uri(folder)
        files.create_dir(root, recursive=True)
        first, held, size, n_blocks, n_rows = task.partitionId() << 33, [], 0, 0, 0

        def close() -> pa.RecordBatch:
            block = first + n_blocks
            table = pa.Table.from_batches(held)
            name = f"{block}-{task.taskAttemptId()}.arrow"
            with files.open_output_stream(f"{root}/{name}") as out, pa.ipc.new_file(out, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
                writer.write_table(table)
            return pa.RecordBatch.from_pydict({"block": [block], "path": [f"{folder}/{name}"], "n_rows": [table.num_rows], "n_bytes": [size]})

        for batch in batches:
            if not len(batch):
                continue
            place = pa.array(range(first + n_rows, first + n_rows + len(batch)), pa.int64())
            held.append(pa.RecordBatch.from_arrays([*batch.columns, place], [*batch.schema.names, "place"]))
            n_rows, size = n_rows + len(batch), size + (pc.sum(pc.binary_length(batch.column("text"))).as_py() or 0)
            if size >= BLOCK_BYTES:
                yield close()
                held, size, n_blocks = [], 0, n_blocks + 1
        if held:
            yield close()

    rows = docs.withColumn("doc_id", F.col("doc_id").cast("long")).withColumn("text", F.coalesce(F.col("text"), F.lit("")))
    return written(rows.mapInArrow(write, "block long, path string, n_rows long, n_bytes long"), "block-list")


def load(path: str) -> pa.Table:
    """The rows of a block."""
    files, name = fs.FileSystem.from_uri(path)
    with files.open_input_file(name) as file:
        return pa.ipc.open_file(file).read_all().combine_chunks()


def spread(rows: DataFrame, n_blocks: int) -> DataFrame:
    """``rows`` partitioned by block; as their sizes say little about the work, adaptive execution shall not merge them."""
    return rows.repartition(max(8, min(2 * n_blocks, MOST_TASKS)), "block")
