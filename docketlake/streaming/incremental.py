"""Incremental ingestion (I1-I11) with Structured Streaming and batch cursors.

A persisted cursor is the stream's checkpoint, or a row (source, key, value) that only moves forward after a walk is
complete. Late records come in two ways: a trailing re-walk reads a window again and the keyed upsert makes that
harmless; a watermark instead drops what is later than its delay. Both are provided, as they differ on purpose.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from datetime import date, timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from docketlake.operators.store import VersionedTable

#: Days that a source's trailing window reads again.
REWALK_DAYS = {
    "cftc": 7, "openfda": 7, "clinicaltrials": 7, "lda": 7, "house-clerk": 7, "senate-efd": 7, "usaspending": 3,
    "edgar": 0, "edgar-bulk": 0, "finra": 0, "wikimedia": 0, "govinfo": 0, "govinfo-hearings": 0,
}


@dataclass(frozen=True)
class Cursor:
    """Where a walk stands, how far back it reads again, and whether a complete walk moves it."""

    source: str
    key: str
    value: str | None = None
    rewalk_days: int = 0

    def start(self, first: str) -> str:
        """The first day to read."""
        if self.value is None:
            return first
        return max(first, (date.fromisoformat(self.value[:10]) - timedelta(days=self.rewalk_days)).isoformat())

    def advanced(self, reached: str | None, complete: bool) -> Cursor:
        """Only forward, and only after a complete walk."""
        if not complete or reached is None or (self.value is not None and reached <= self.value):
            return self
        return Cursor(self.source, self.key, reached, self.rewalk_days)


def upsert_cursors(table: VersionedTable, cursors: DataFrame) -> None:
    """Keep the greatest value of each (source, key)."""
    table.upsert(cursors.select("source", "key", "value"), ["source", "key"], ["value"])


def due(df: DataFrame, at: str, cursor: Cursor, first: str) -> DataFrame:
    """Records from the cursor on, its trailing window included."""
    return df.where(F.col(at).cast("date") >= F.lit(cursor.start(first)).cast("date"))


def file_stream(spark: SparkSession, folder: str, schema, files_per_batch: int = 50, form: str = "parquet", pattern: str = "*") -> DataFrame:
    """New files of a landing folder as a stream; the checkpoint remembers which were read."""
    return spark.readStream.format(form).schema(schema).option("maxFilesPerTrigger", files_per_batch).option("pathGlobFilter", pattern).load(folder)


def upsert_stream(stream: DataFrame, table: VersionedTable, keys: list[str], sequence: list[str], checkpoint: str):
    """Merge each batch into a stored table; a batch that runs twice changes nothing the second time (I4)."""

    def merge(batch: DataFrame, _: int) -> None:
        table.upsert(batch, keys, sequence)

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def without_repeats(stream: DataFrame, keys: list[str], at: str, delay: str = "7 days") -> DataFrame:
    """Drop repeats of a key within the watermark's delay."""
    return stream.withWatermark(at, delay).dropDuplicatesWithinWatermark(keys)


def daily_counts(stream: DataFrame, at: str, keys: list[str], delay: str = "7 days") -> DataFrame:
    """Records by day of ``at``."""
    return stream.withWatermark(at, delay).groupBy(F.window(at, "1 day").alias("w"), *keys).agg(F.count("*").alias("n"))


def check_drift(df: DataFrame, ok, act: Callable[[DataFrame], None], at_least: int = 20) -> dict:
    """Run ``act`` while counting; fail if many records were tried and none was good (I8). No second pass is made."""
    seen = Observation(f"drift-{uuid.uuid4().hex}")
    act(df.observe(seen, F.count(F.lit(1)).alias("attempted"), F.count_if(ok).alias("succeeded")))
    found = seen.get
    if found["attempted"] >= at_least and found["succeeded"] == 0:
        raise ValueError(f"none of {found['attempted']} records could be read: the source's format may have changed")
    return found


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path in the folder of spark.checkpoint.dir; a local session without one gets a temporary folder, a cluster an error."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        shared = f"file://{tempfile.mkdtemp(prefix='docketlake-')}"
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def replayed(spark: SparkSession, path: str, late_days: int = 10) -> DataFrame:
    """The events table as a finished stream in three batches, repeats dropped within the watermark (batch result).

    The first batch holds all but the first ``late_days`` days; the second repeats it, as a trailing walk does; the third
    holds those first days, which are later than the watermark allows and are dropped with it (I3).
    """
    base = shared_folder(spark, "stream")
    events = spark.read.parquet(path).withColumn("ts", F.col("ts").cast("timestamp")).select("event_id", "user_id", "event_type", "ts", "value")
    first = events.agg(F.min("ts").alias("_first")).withColumn("_from", F.col("_first") + F.expr(f"INTERVAL {late_days} DAYS"))
    marked = events.join(F.broadcast(first), F.lit(True)).withColumn("_late", F.col("ts") < F.col("_from")).drop("_first", "_from")
    for k, late in enumerate((False, False, True)):
        marked.where(F.col("_late") == F.lit(late)).drop("_late").coalesce(1).write.parquet(f"{base}/landing/{k}")
    stream = file_stream(spark, f"{base}/landing/*", events.schema, files_per_batch=1)
    once = without_repeats(stream, ["event_id"], "ts")
    query = once.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(events.schema).parquet(f"{base}/out")


@dataclass
class Backfill:
    """A resumable walk backwards in chunks of days (I5), as a plain state machine that tests can step through."""

    since: date
    until: date
    chunk_days: int = 30
    budget: int | None = None
    retries: int = 3
    done_until: date | None = None
    stopped: str | None = None
    log: list[tuple[date, date, str]] = field(default_factory=list)

    def chunks(self) -> Iterator[tuple[date, date]]:
        start = self.since if self.done_until is None else self.done_until + timedelta(days=1)
        while start <= self.until:
            end = min(self.until, start + timedelta(days=self.chunk_days - 1))
            yield start, end
            start = end + timedelta(days=1)

    def run(self, walk: Callable[[date, date], int], out_of_time: Callable[[], bool] = lambda: False) -> Backfill:
        """Walk chunk after chunk. A chunk that fails is tried again; then, or at a limit, the walk stops and can resume."""
        spent = 0
        for start, end in self.chunks():
            if out_of_time():
                self.stopped = "deadline"
            elif self.budget is not None and spent >= self.budget:
                self.stopped = "limit"
            if self.stopped:
                return self
            for attempt in range(self.retries):
                try:
                    spent += walk(start, end)
                    break
                except OSError as error:
                    self.log.append((start, end, str(error)))
                    if attempt == self.retries - 1:
                        self.stopped = "upstream"
                        return self
            self.done_until = end
        return self


def bisected(since: date, until: date, total: Callable[[date, date], int], ceiling: int) -> list[tuple[date, date]]:
    """Ranges of days whose totals stay within a ceiling; a single day is never split."""
    if since == until or total(since, until) <= ceiling:
        return [(since, until)]
    middle = since + (until - since) // 2
    return [*bisected(since, middle, total, ceiling), *bisected(middle + timedelta(days=1), until, total, ceiling)]
