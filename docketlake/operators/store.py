"""The store: keyed upserts, scans by ingestion day, shards, snapshots and manifests (S1-S14, SC1-SC11, J8-J10).

A stored table is a folder of numbered versions, each written whole; the highest that is complete is the current one.
There is no pointer that could be lost: a reader never sees half a table, no path is overwritten while it is read, and a
crash at any moment leaves the version before. A table has one writer at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence

import pandas as pd
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docketlake.operators.filters import order

SNAPSHOT_ROWS = 200_000
#: Complete versions of a table that are kept, so that a reader may end what it began.
VERSIONS = 3


# --- relational parts


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], sequence: Sequence[str]) -> DataFrame:
    """Old and new rows, the last by ``sequence`` winning for each key; new rows beat old ones of equal sequence.

    One aggregate by key with partial combination: a key that many rows share is reduced before the shuffle.
    """
    columns = old.columns
    rows = old.withColumn("_new", F.lit(0)).unionByName(new.select(columns).withColumn("_new", F.lit(1)))
    rank = F.struct(*sequence, "_new", F.xxhash64(*columns))
    best = rows.groupBy(*keys).agg(F.max_by(F.struct(*[c for c in columns if c not in keys]), rank).alias("_row"))
    return best.select(*keys, "_row.*").select(columns)


def fill_missing(rows: DataFrame, known: DataFrame, key: str, value: str) -> DataFrame:
    """Set a null value from a table of known ones, never changing a value that is there; ``filled`` tells where.

    Of several known values of a key the least counts. Spark broadcasts the known side if it proves small.
    """
    least = known.groupBy(key).agg(F.min(value).alias("_known"))
    joined = rows.join(least, key, "left")
    return joined.withColumn("filled", F.col(value).isNull() & F.col("_known").isNotNull()).withColumn(value, F.coalesce(value, "_known")).drop("_known")


def existing_ids(ids: DataFrame, stored: DataFrame, key: str = "id") -> DataFrame:
    """The ids that are stored (SC8)."""
    return ids.join(stored.select(key), key, "left_semi")


def new_ids(ids: DataFrame, stored: DataFrame, key: str = "id") -> DataFrame:
    """The ids that are not stored."""
    return ids.join(stored.select(key), key, "left_anti")


def ingested_on(df: DataFrame, at: str, day: str) -> DataFrame:
    """Rows of an ingestion day, by a half-open range that a scan can prune with (SC3, SC4)."""
    start = F.lit(day).cast("date")
    return df.where((F.col(at) >= start) & (F.col(at) < F.date_add(start, 1)))


def ingestion_days(df: DataFrame, at: str) -> DataFrame:
    """Distinct ingestion days, ascending (SC5)."""
    return df.select(F.col(at).cast("date").alias("day")).where("day is not null").distinct().orderBy("day")


def unresolved(df: DataFrame, key: str, value: str, limit: int | None = None) -> DataFrame:
    """Distinct keys whose value is missing, ascending (SC11)."""
    found = df.where(F.col(value).isNull() & F.col(key).isNotNull()).select(key).distinct().orderBy(key)
    return found if limit is None else found.limit(limit)


def latest_runs(runs: DataFrame, key: str = "source", at: str = "started_at") -> DataFrame:
    """The latest run of each source (SC10)."""
    return runs.groupBy(key).agg(F.max_by(F.struct(*[c for c in runs.columns if c != key]), at).alias("_r")).select(key, "_r.*")


def counts(tables: dict[str, DataFrame]) -> dict[str, int]:
    """Rows of each table (SC6)."""
    return {name: df.count() for name, df in tables.items()}


def shard_of(event: Column) -> Column:
    return F.coalesce(F.year(event).cast("string"), F.lit("undated"))


def shard_counts(df: DataFrame, event: Column) -> DataFrame:
    """Rows by event year."""
    return df.groupBy(shard_of(event).alias("shard")).agg(F.count("*").alias("n"))


# --- versions on disk


def _files(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small text file of any store that Spark reads; None if it is not there."""
    files, jvm = _files(spark, path)
    at = jvm.org.apache.hadoop.fs.Path(path)
    if not files.exists(at):
        return None
    stream = files.open(at)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file beside its place and move it there."""
    files, jvm = _files(spark, path)
    at, beside = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    stream = files.create(beside)
    stream.write(bytearray(text.encode("utf-8")))
    stream.close()
    renaming = jvm.org.apache.hadoop.fs.Options.Rename
    over = spark.sparkContext._gateway.new_array(renaming, 1)
    over[0] = renaming.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), files.getConf())
    context.rename(files.makeQualified(beside), files.makeQualified(at), over)


def write_files(rows: DataFrame, folder: str) -> int:
    """Write a file for each row (name, text) into a folder, on executors, and return their number.

    A file is written beside its place, under a name that Spark's readers pass over, and moved there, so a task that runs
    again leaves the same files. A null text is an empty file (which Spark's readers pass over too), a null name an error.
    """
    spark = rows.sparkSession
    files, jvm = _files(spark, folder)
    at = files.makeQualified(jvm.org.apache.hadoop.fs.Path(folder))
    files.mkdirs(at)
    uri = at.toString()

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = fs.FileSystem.from_uri(uri)
        attempt = TaskContext.get().taskAttemptId()
        for frame in frames:
            for name, text in zip(frame["name"], frame["text"], strict=True):
                if name is None:
                    raise ValueError("a file without a name")
                beside = f"{root}/_{name}.{attempt}"
                with store.open_output_stream(beside) as out:
                    out.write((text or "").encode("utf-8"))
                store.move(beside, f"{root}/{name}")
            yield pd.DataFrame({"n": [len(frame)]})

    dealt = rows.select("name", "text").repartition(spark.sparkContext.defaultParallelism, "name")  # a number, so that few bytes are not dealt to one task
    return dealt.mapInPandas(write, "n long").agg(F.sum("n")).first()[0] or 0


def children(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder; none if it is not there."""
    files, jvm = _files(spark, path)
    root = jvm.org.apache.hadoop.fs.Path(path)
    return sorted(x.getPath().getName() for x in files.listStatus(root)) if files.exists(root) else []


class VersionedTable:
    """A table kept as numbered versions, of which the highest complete one is current."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def versions(self) -> list[tuple[int, str, bool]]:
        """(number, folder name, whether complete) of each version, ascending."""
        files, jvm = _files(self.spark, self.path)
        numbered = [(int(n.split("-")[1]), n) for n in children(self.spark, self.path) if n.startswith("v-")]
        return sorted((k, n, files.exists(jvm.org.apache.hadoop.fs.Path(f"{self.path}/{n}/_SUCCESS"))) for k, n in numbered)

    def read(self) -> DataFrame | None:
        """The current version; None if no version was ever completed."""
        complete = [n for _, n, whole in self.versions() if whole]
        return self.spark.read.parquet(f"{self.path}/{complete[-1]}") if complete else None

    def replace(self, df: DataFrame) -> None:
        """The whole table anew (S2); versions older than the last few go."""
        before = self.versions()
        number = before[-1][0] + 1 if before else 1
        df.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(f"{self.path}/v-{number:08d}-{uuid.uuid4().hex}")
        complete = [k for k, _, whole in self.versions() if whole]
        oldest = complete[-VERSIONS] if len(complete) >= VERSIONS else 0
        files, jvm = _files(self.spark, self.path)
        for k, name, _ in before:
            if k < oldest:
                files.delete(jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}"), True)

    def upsert(self, new: DataFrame, keys: Sequence[str], sequence: Sequence[str]) -> None:
        """Merge rows by key; applying the same rows twice leaves the table as after once (I4)."""
        old = self.read()
        self.replace(upsert(new.limit(0) if old is None else old, new, keys, sequence))


# --- dumps


def write_deltas(df: DataFrame, path: str, at: str = "retrieved_at", since: str | None = None) -> None:
    """JSON by ingestion day (S4); with ``since``, only days from then on are written, replacing those of the same day."""
    dated = df.withColumn("ingest_day", F.col(at).cast("date"))
    recent = dated if since is None else dated.where(F.col("ingest_day") >= F.lit(since).cast("date"))
    recent.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("ingest_day").json(path)


def latest_delta(df: DataFrame, at: str = "retrieved_at") -> DataFrame:
    """Rows of the newest ingestion day."""
    newest = df.agg(F.max(F.col(at).cast("date")).alias("_newest"))
    return df.join(F.broadcast(newest), F.col(at).cast("date") == F.col("_newest")).drop("_newest")


def write_shards(df: DataFrame, path: str, event: Column, key: str = "id", form: str = "json") -> None:
    """A snapshot in shards by event year, rows in order of id.

    Years differ in size, so rows are dealt by year and id hash, as many parts a year as the session's shuffle has;
    adaptive execution joins small ones.
    """
    sharded = df.withColumn("event_year", shard_of(event)).hint("rebalance", F.col("event_year"))
    writer = sharded.sortWithinPartitions("event_year", key).write.mode("overwrite").partitionBy("event_year")
    (writer.option("compression", "gzip") if form == "json" else writer).format(form).save(path)


def write_snapshot(df: DataFrame, path: str, event: Column, key: str = "id", most: int = SNAPSHOT_ROWS) -> bool:
    """One file in order of (year, id) if the table has at most ``most`` rows (S7); returns whether it was written."""
    if len(df.select(key).limit(most + 1).agg(F.count("*").alias("n")).where(F.col("n") <= most).collect()) == 0:
        return False
    df.orderBy(shard_of(event), key).coalesce(1).write.mode("overwrite").option("compression", "gzip").json(path)
    return True


def read_dump(spark: SparkSession, paths: Sequence[str], schema: str, key: str = "id") -> DataFrame:
    """Rows of dump files; for an id in several files the later file by name wins.

    A line is an object or an array of objects, so single-line arrays and JSON lines both read.
    """
    rows = spark.read.schema(schema).json(list(paths)).withColumn("_file", F.input_file_name())
    columns = [c for c in rows.columns if c not in (key, "_file")]
    return rows.groupBy(key).agg(F.max_by(F.struct(*columns), "_file").alias("_r")).select(key, "_r.*")


def archive_index(files: DataFrame) -> DataFrame:
    """The best file of each dataset and year: explicit before inferred, then larger, then later."""
    best = F.max_by(F.struct("path", "explicit", "bytes", "updated_at"), F.struct("explicit", "bytes", "updated_at", "path"))
    return files.groupBy("dataset", "year").agg(best.alias("_f")).select("dataset", "year", "_f.*")


def manifest(freshness: DataFrame, shards: dict[str, DataFrame], cursors: DataFrame, generated_at: str) -> str:
    """The manifest of a dump (S8): a few rows a dataset, so the driver writes it."""
    datasets = {r["dataset"]: {k: (v.isoformat() if hasattr(v, "isoformat") else v) for k, v in r.asDict().items()} for r in freshness.collect()}
    for name, df in shards.items():
        datasets.setdefault(name, {"dataset": name})["shards"] = {r["shard"]: r["n"] for r in df.orderBy("shard").collect()}
    marks = [r.asDict() for r in cursors.orderBy(*order("source", "key")).collect()]
    return json.dumps({"generatedAt": generated_at, "datasets": datasets, "watermarks": marks}, default=str, sort_keys=True)


def with_citation(df: DataFrame) -> DataFrame:
    return df.withColumn("citation", F.col("provenance.source_url"))


def seats_at(df: DataFrame, keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    """The first row of each group (T4)."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order(*by)))).where("_n = 1").drop("_n")
