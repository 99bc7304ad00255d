"""What the operators share: the folder that all executors see, tables written there, and Arrow batch sizes."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Separators of words: space and U+0009 to U+000D. A word is a run of anything else.
WORD = r"[^\x20\x09-\x0D]+"
WORD_BREAK = r"[\x20\x09-\x0D]+"

#: A table of at most this many rows, each of bounded width, may be broadcast.
BROADCAST_ROWS = 20_000


#: Folders of applications whose session names none.
OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; where it is unset, a local session (tests) gets a new one that it keeps.

    On a cluster an unset folder is an error: executors would write to disks of their own.
    A path without a scheme is one of the default file system, for Python readers as for Spark.
    """
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or OWN.get(context.applicationId)
    if not found:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = OWN[context.applicationId] = f"file://{tempfile.mkdtemp(prefix='docketlake-')}"
        context.setCheckpointDir(found)
    if "://" not in found:
        default = context._jsc.hadoopConfiguration().get("fs.defaultFS") or "file:///"
        found = ("file://" if default.startswith("file:") else default.rstrip("/")) + found.removeprefix("file:")
    return found.rstrip("/")


#: Paths in the shared folder that this driver has given out.
GIVEN: list[str] = []


def scratch(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other call gets."""
    GIVEN.append(f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}")
    return GIVEN[-1]


def discard(spark: SparkSession) -> None:
    """Delete everything under the paths given out so far. Call it when the results are stored: they read from there."""
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    while GIVEN:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(GIVEN.pop())
        path.getFileSystem(hadoop).delete(path, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table of the shared folder: it cuts lineage and outlives executors."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = 1000, size: str = "2m") -> None:
    """Bound Arrow batches by rows and bytes, so that batches of long documents fit a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def words(text: Column) -> Column:
    """The words of a text as an array; a null text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_BREAK, -1), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, also where ``body`` uses it in lambdas over arrays."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
