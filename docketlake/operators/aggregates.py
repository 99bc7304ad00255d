"""Aggregations (A1-A24): plain grouped aggregates with partial combination; ties are settled by the keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketlake.functions import scalars as S
from docketlake.operators.filters import order, top_groups

STATUSES = ("green", "amber", "red")


def _exact(c: Column) -> Column:
    """A sum that does not depend on the order of rows: decimals inside, a double outside."""
    return F.sum(c.cast("decimal(18,2)")).cast("double")


def activity(df: DataFrame, keys: Sequence[str], date: str, name: str, count: str = "rows", limit: int | None = 50) -> DataFrame:
    """Rows and last date by group, busiest first (A1)."""
    return top_groups(df, keys, [F.count("*").alias(count), F.max(date).alias("last_date")], [f"-{count}", name], limit)


def code_breakdown(df: DataFrame, code: str, shares: str, price: str) -> DataFrame:
    """Rows, shares (null sums count 0) and value (null if nothing could be multiplied) by code (A2)."""
    value = _exact(F.col(shares) * F.col(price)).alias("value")
    return df.where(F.col(code).isNotNull()).groupBy(F.col(code).alias("code")).agg(F.count("*").alias("n"), F.coalesce(_exact(F.col(shares)), F.lit(0.0)).alias("shares"), value)


def open_market(df: DataFrame, code: str, shares: str, buy: str = "P", sell: str = "S") -> DataFrame:
    """Shares bought, sold and net (A3)."""
    side = lambda v: F.coalesce(_exact(F.when(F.col(code) == v, F.col(shares)).otherwise(0)), F.lit(0.0))
    return df.agg(side(buy).alias("bought"), side(sell).alias("sold")).withColumn("net", F.col("bought") - F.col("sold"))


def periods(df: DataFrame, period: str) -> DataFrame:
    """The latest period and the one before it, in a single pass over distinct periods."""
    distinct = df.where(F.col(period).isNotNull()).select(F.col(period).alias("_p")).distinct()
    two = distinct.orderBy(F.col("_p").desc()).limit(2)
    return two.agg(F.max("_p").alias("latest"), F.when(F.count("*") > 1, F.min("_p")).alias("prior"))


def award_totals(df: DataFrame, date: str, amount: str, granularity: str = "quarter", limit: int = 40) -> DataFrame:
    """Awards and their sum by year or quarter, latest first; a null amount counts 0."""
    if granularity not in ("year", "quarter"):
        raise ValueError("granularity is year or quarter")
    period = F.year(date).cast("string") if granularity == "year" else S.year_quarter(F.col(date))
    sums = df.groupBy(period.alias("period")).agg(F.count("*").alias("awards"), _exact(F.coalesce(F.col(amount), F.lit(0))).alias("total_amount"))
    return sums.orderBy(*order("-period")).limit(limit)


def trade_stats(df: DataFrame, side: str, date: str, buy: str = "buy", sell: str = "sell") -> DataFrame:
    """Total, buys, sells, first and last date."""
    is_side = lambda v: F.count_if(F.col(side) == v)
    return df.agg(F.count("*").alias("total"), is_side(buy).alias("buys"), is_side(sell).alias("sells"), F.min(date).alias("first_date"), F.max(date).alias("last_date"))


def freshness(tables: dict[str, tuple[DataFrame, str, float]], now: str) -> DataFrame:
    """Rows, last date, age in hours and staleness of each (table, date column, window in hours); empty is stale."""

    def one(name: str, df: DataFrame, date: str, window: float) -> DataFrame:
        found = df.agg(F.count("*").alias("row_count"), F.max(F.col(date).cast("timestamp")).alias("last_at"))
        hours = (F.unix_micros(F.lit(now).cast("timestamp")) - F.unix_micros("last_at")) / F.lit(3.6e9)
        stale = F.coalesce(hours > window, F.lit(True))
        return found.select(F.lit(name).alias("dataset"), "row_count", "last_at", F.round(hours, 1).alias("age_hours"), F.lit(float(window)).alias("window_hours"), stale.alias("stale"))

    return reduce(DataFrame.unionByName, [one(name, *spec) for name, spec in tables.items()])


def first_by_sequence(df: DataFrame, key: str, sequence: str, value: str, where: Column | None = None, count: str = "n") -> DataFrame:
    """All rows counted, and the value at the least sequence among the rows ``where`` holds; a null sequence is last."""
    held = F.col(value).isNotNull() if where is None else where
    at = F.coalesce(F.col(sequence).cast("long"), F.lit(2**62))
    return df.groupBy(key).agg(F.count("*").alias(count), F.min(F.when(held, F.struct(at.alias("at"), F.col(value).alias("value")))).alias("_f")).withColumn("first", F.col("_f.value")).drop("_f")


def success_rate(df: DataFrame, ok: Column, least: float = 0.99) -> DataFrame:
    """Attempted, succeeded, rate and whether it reaches ``least``; nothing attempted passes."""
    counts = df.agg(F.count("*").alias("attempted"), F.count_if(ok).alias("succeeded"))
    rate = F.when(F.col("attempted") > 0, F.col("succeeded") / F.col("attempted"))
    return counts.withColumn("rate", rate).withColumn("passed", F.coalesce(rate >= least, F.lit(True)))


def canary_status(checks: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Checks (ok, hard) to a status: a hard failure is red, any other amber, none green."""
    level = F.when(F.col("ok"), 0).when(F.col("hard"), 2).otherwise(1)
    return checks.groupBy(*keys).agg(F.element_at(F.array(*map(F.lit, STATUSES)), F.coalesce(F.max(level), F.lit(0)) + 1).alias("status"))


def worst_status(df: DataFrame, keys: Sequence[str], status: str = "status") -> DataFrame:
    """The worst status of each group; unknown ones count as the best."""
    names = F.array(*map(F.lit, STATUSES))
    level = F.greatest(F.array_position(names, F.col(status)), F.lit(1))
    return df.groupBy(*keys).agg(F.element_at(names, F.max(level).cast("int")).alias(status))


def run_rollup(runs: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Sums over runs (A22): rows added up, ``ok`` if all were, ``partly_ok`` if any was."""
    return runs.groupBy(*keys).agg(F.sum("rows").alias("rows"), F.coalesce(F.bool_and("ok"), F.lit(True)).alias("ok"), F.coalesce(F.bool_or("ok"), F.lit(False)).alias("partly_ok"))


def name_index(names: DataFrame) -> DataFrame:
    """Normalised name to its sorted tickers, without names of several companies (A15). Input: (cik, ticker, name)."""
    keyed = names.select(S.entity_name(F.col("name")).alias("name"), "cik", "ticker").where("name != ''")
    grouped = keyed.groupBy("name").agg(F.count_distinct("cik").alias("companies"), F.array_sort(F.collect_set("ticker")).alias("tickers"))
    return grouped.where("companies = 1").drop("companies")


def band(c: Column, bounds: Sequence[tuple[str, float]], rest: str) -> Column:
    """The first band whose upper bound lies above the value."""
    return F.coalesce(*[F.when(c < top, F.lit(name)) for name, top in bounds], F.lit(rest))
