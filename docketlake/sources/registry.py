"""From landed files to the store: which reader serves which dataset, and the commands that walk the landing folder.

Files land by other means, as ``<landing>/<source>/<YYYY-MM-DD>/...``, the day being that of the walk that brought them.
``sync`` reads each source's days from its cursor on, its trailing window again (late records, I3), upserts the good rows
and moves the cursor if all days were read; every run is logged. ``backfill`` walks a range of days in chunks that can
resume. Both may run twice without changing the store.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketlake.operators import aggregates, store
from docketlake.sources import delimited, documents, feeds
from docketlake.streaming.incremental import REWALK_DAYS, Backfill, Cursor, upsert_cursors

RUNS = "source string, day string, started_at string, rows long, rejected long, unreadable long, ok boolean, error string"
#: Records from which a walk without a single good one is taken for a changed format (I8).
DRIFT = 20


@dataclass(frozen=True)
class Source:
    """A reader of a day's folder: (spark, folder, retrieved_at) to (good, rejected rows[, unreadable documents])."""

    name: str
    dataset: str
    read: Callable[[SparkSession, str, str], tuple[DataFrame, ...]]
    provenance: str

    @property
    def rewalk_days(self) -> int:
        return REWALK_DAYS.get(self.provenance, 0)


def _contributions(spark: SparkSession, folder: str, at: str) -> tuple[DataFrame, ...]:
    committees, people = (delimited.master_names(spark, f"{folder}/{n}*.txt") for n in ("cm", "cn"))
    return delimited.contributions(spark, f"{folder}/itpas2*.txt", _cycle(at), at, committees, people)


def _cycle(at: str) -> int:
    year = int(at[:4])
    return year + year % 2


SOURCES: dict[str, Source] = {
    s.name: s
    for s in (
        Source("short-volume", "short-volume", lambda spark, f, at: delimited.short_volume(spark, f"{f}/*", "CNMS", at), "finra"),
        Source("insider-quarter", "insider-transactions", delimited.insider_quarter, "edgar-bulk"),
        Source("ownership-forms", "insider-transactions", lambda spark, f, at: documents.ownership_forms(spark, f"{f}/*", at), "edgar"),
        Source("holdings-reports", "thirteenf-holdings", lambda spark, f, at: documents.holdings_reports(spark, f"{f}/*", at), "edgar"),
        Source("contracts", "gov-contracts", lambda spark, f, at: feeds.awards(spark, f"{f}/*", at), "usaspending"),
        Source("grants", "gov-grants", lambda spark, f, at: feeds.awards(spark, f"{f}/*", at, "gov-grants"), "usaspending"),
        Source("lobbying", "lobbying-filings", lambda spark, f, at: feeds.lobbying(spark, f"{f}/*", at), "lda"),
        Source("patents", "patents", delimited.patents, "patentsview"),
        Source("studies", "clinical-trials", lambda spark, f, at: feeds.studies(spark, f"{f}/*", at), "clinicaltrials"),
        Source("drug-applications", "fda-approvals", lambda spark, f, at: feeds.drug_applications(spark, f"{f}/*", at), "openfda"),
        Source("positioning", "cot-reports", lambda spark, f, at: feeds.positioning(spark, f"{f}/*", at), "cftc"),
        Source("bills", "bills", lambda spark, f, at: documents.bills(spark, f"{f}/*", at), "govinfo"),
        Source("hearings", "congress-hearings", lambda spark, f, at: documents.hearings(spark, f"{f}/*", at), "govinfo-hearings"),
        Source("candidates", "fec-candidates", lambda spark, f, at: delimited.candidates(spark, f"{f}/*", _cycle(at), at), "fec"),
        Source("contributions", "fec-contributions", _contributions, "fec"),
        Source("fed", "fed-communications", lambda spark, f, at: feeds.fed_items(spark, f"{f}/*", at), "federalreserve"),
    )
}


class Lake:
    """A store of datasets beside the cursors and the log of runs, fed from a landing folder."""

    def __init__(self, spark: SparkSession, folder: str, landing: str):
        self.spark, self.folder, self.landing = spark, folder.rstrip("/"), landing.rstrip("/")

    def table(self, name: str) -> store.VersionedTable:
        return store.VersionedTable(self.spark, f"{self.folder}/{name}")

    def days(self, source: str) -> list[str]:
        """The days that a source has landed, ascending."""
        found = store.children(self.spark, f"{self.landing}/{source}")
        return sorted(n for n in found if re.fullmatch(r"\d{4}-\d{2}-\d{2}", n))

    def cursor(self, source: Source, key: str = "day") -> Cursor:
        known = self.table("_cursors").read()
        row = None if known is None else known.where((F.col("source") == source.name) & (F.col("key") == key)).first()
        return Cursor(source.name, key, row.value if row else None, source.rewalk_days)

    def _keep(self, cursor: Cursor) -> None:
        if cursor.value is not None:
            upsert_cursors(self.table("_cursors"), self.spark.createDataFrame([(cursor.source, cursor.key, cursor.value)], "source string, key string, value string"))

    def read_day(self, source: Source, day: str) -> int:
        """Upsert one day's good rows; the number of rows. The run is logged, also if it fails."""
        began, error, counts = datetime.now(timezone.utc).isoformat(), None, [0, 0, 0]
        try:
            good, rejected, *unreadable = source.read(self.spark, f"{self.landing}/{source.name}/{day}", f"{day} 00:00:00")
            counts = [good.count(), rejected.count(), unreadable[0].count() if unreadable else 0]
            if counts[0] == 0 and sum(counts) >= DRIFT:
                raise ValueError(f"none of {sum(counts)} records could be read: the source's format may have changed")
            if counts[0]:
                self.table(source.dataset).upsert(good, ["id"], ["provenance.retrieved_at"])
        except Exception as failure:
            error = str(failure)[:500]
            raise
        finally:
            run = self.spark.createDataFrame([(source.name, day, began, *counts, error is None, error)], RUNS)
            self.table("_runs").upsert(run, ["source", "day", "started_at"], ["started_at"])
        return counts[0]

    def sync(self, names: list[str] | None = None) -> dict[str, str | None]:
        """Walk the sources (all, unless named): the error of each, None if it went well. One source's failure stops no other."""
        found: dict[str, str | None] = {}
        for source in (SOURCES[n] for n in names or SOURCES):
            cursor, reached, found[source.name] = self.cursor(source), None, None
            days = [d for d in self.days(source.name) if d >= cursor.start("0001-01-01")]
            try:
                for reached in days:
                    self.read_day(source, reached)
            except Exception as failure:  # noqa: BLE001
                found[source.name] = str(failure)[:500]
            self._keep(cursor.advanced(reached, found[source.name] is None))
        return found

    def backfill(self, name: str, since: str, until: str, chunk_days: int = 30, budget: int | None = None) -> Backfill:
        """Walk landed days of a range in chunks; a walk that stopped goes on after its last whole chunk."""
        source = SOURCES[name]
        cursor = self.cursor(source, f"backfill:{since}:{until}")
        done = date.fromisoformat(cursor.value) if cursor.value else None
        walk = Backfill(date.fromisoformat(since), date.fromisoformat(until), chunk_days, budget, done_until=done)
        landed = self.days(name)
        walk.run(lambda a, b: sum(self.read_day(source, d) for d in landed if a.isoformat() <= d <= b.isoformat()))
        if walk.done_until is not None:
            self._keep(cursor.advanced(walk.done_until.isoformat(), True))
        return walk

    def canary(self) -> DataFrame:
        """Of each source's latest run: whether it went well, and the share of its records that could be read."""
        runs = self.table("_runs").read()
        latest = store.latest_runs(self.spark.createDataFrame([], RUNS) if runs is None else runs)
        tried = F.col("rows") + F.col("rejected") + F.col("unreadable")
        return latest.withColumn("rate", F.when(tried > 0, F.round(F.col("rows") / tried, 6))).select("source", "day", "ok", "rate", "rows", "error").orderBy("source")

    def resolve(self, dataset: str, key: str, value: str, known: DataFrame) -> int:
        """Fill a missing value of a stored dataset from (key, value) rows, never changing one that is there."""
        rows = self.table(dataset).read()
        if rows is None:
            return 0
        filled = store.fill_missing(rows, known, key, value)
        fresh = filled.where("filled").drop("filled").select(rows.columns)
        n = fresh.count()
        if n:
            self.table(dataset).upsert(fresh, ["id"], ["provenance.retrieved_at"])
        return n

    def rollup(self) -> DataFrame:
        """Rows and success by source over all logged runs."""
        runs = self.table("_runs").read()
        return aggregates.run_rollup((self.spark.createDataFrame([], RUNS) if runs is None else runs).select("source", "rows", "ok"), ["source"])


def checked(names: list[str]) -> list[str]:
    unknown = sorted(set(names) - set(SOURCES))
    if unknown:
        raise ValueError(f"no source is named {', '.join(unknown)}")
    return names

