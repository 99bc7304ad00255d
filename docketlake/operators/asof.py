"""Forward as-of lookup with a bounded search (J1), event returns (A10) and the equal-weight backtest.

Each event is spread over the few days that the search allows and meets the prices by plain equality on
(ticker, day): no range join, no unbounded window for a busy ticker, and filters on either side stay pushable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEARCH_DAYS = 7
DISCLAIMER = "Historical facts computed from supplied prices; not advice, and no claim about any later price."


def daily_prices(points: DataFrame) -> DataFrame:
    """One price a ticker and day: the first by ``seq`` (place in the file) wins. Tickers compare in upper case."""
    seq = F.col("seq") if "seq" in points.columns else F.lit(0)
    keyed = points.select(F.upper("ticker").alias("ticker"), F.col("date").cast("date").alias("date"), F.col("close").cast("double").alias("close"), seq.alias("seq"))
    return keyed.groupBy("ticker", "date").agg(F.min_by("close", "seq").alias("close"))


def _spread(events: DataFrame, legs: dict[str, Column], days: int) -> DataFrame:
    """A row for each event, leg and day of its search."""
    wanted = F.array(*[F.struct(F.lit(name).alias("leg"), day.alias("from_")) for name, day in legs.items()])
    rows = events.select("event_key", F.upper("ticker").alias("ticker"), F.explode(wanted).alias("w"))
    return rows.select("event_key", "ticker", "w.leg", F.explode(F.sequence(F.col("w.from_"), F.date_add("w.from_", days))).alias("date"))


def lookup(events: DataFrame, prices: DataFrame, legs: dict[str, Column], search_days: int = SEARCH_DAYS) -> DataFrame:
    """For each event and leg the earliest price on the leg's day or up to ``search_days`` after.

    ``events`` has a unique ``event_key``, ``ticker`` and the columns of the legs' days; ``prices`` is (ticker, date,
    close) with one row a day. Adds ``known`` (some price of the ticker exists) and, by leg, a struct (date, close) or
    null. Every event gives exactly one row; an event without a ticker or day finds nothing.
    """
    near = prices.join(events.select(F.upper("ticker").alias("ticker")).distinct(), "ticker", "left_semi")
    hits = _spread(events, legs, max(0, search_days)).join(near, ["ticker", "date"])
    first = hits.groupBy("event_key").agg(*[F.min(F.when(F.col("leg") == name, F.struct("date", "close"))).alias(name) for name in legs])
    tickers = near.select(F.col("ticker").alias("_ticker")).distinct().withColumn("known", F.lit(True))
    marked = events.join(tickers, F.upper(events["ticker"]) == F.col("_ticker"), "left").drop("_ticker")
    return marked.withColumn("known", F.coalesce("known", F.lit(False))).join(first, "event_key", "left")


def _reason(what: str, leg: str, day: Column, search_days: int) -> Column:
    ticker = F.concat(F.lit("'"), F.coalesce(F.upper("ticker"), F.lit("")), F.lit("'"))
    tail = f" or within {search_days} day(s) after" if search_days > 0 else ""
    missing = F.concat(F.lit("no price for "), ticker, F.lit(" on "), F.coalesce(day.cast("string"), F.lit("no day")), F.lit(tail))
    unknown = F.concat(F.lit("no prices supplied for ticker "), ticker)
    return F.concat(F.lit(f"{what} price unavailable: "), F.when(F.col("known"), missing).otherwise(unknown))


def event_returns(events: DataFrame, prices: DataFrame, window_days: int, search_days: int = SEARCH_DAYS, names: tuple[str, str] = ("base", "later")) -> DataFrame:
    """One row an event: status (ok or skipped), reason, the two prices and ``change_pct``.

    The second lookup counts only if the first one hits. A first price of zero gives no change (D14): the row is
    skipped with that reason. ``forward_filled`` tells that a leg's price is of a later day.
    """
    first, second = names
    day = F.col("event_date").cast("date")
    legs = {first: day, second: F.date_add(day, window_days)}
    found = lookup(events, daily_prices(prices), legs, search_days)
    zero = F.col(f"{first}.close") == 0
    reason = (
        F.when(F.col(first).isNull(), _reason(first, first, legs[first], search_days))
        .when(F.col(second).isNull(), _reason(second, second, legs[second], search_days))
        .when(zero, F.lit(f"{first} price is zero"))
    )
    change = (F.col(f"{second}.close") - F.col(f"{first}.close")) / F.when(~zero, F.col(f"{first}.close"))
    out = found.withColumn("reason", reason).withColumn("status", F.when(F.col("reason").isNull(), "ok").otherwise("skipped"))
    for name in names:
        out = out.withColumn(f"{name}_filled", F.when(F.col(name).isNotNull(), F.col(f"{name}.date") != legs[name]))
    return out.withColumn("change_pct", F.when(F.col("status") == "ok", change)).drop("known")


def return_summary(rows: DataFrame) -> DataFrame:
    """Events, ok, skipped, mean and exact median of the changes; null where no event was priced (A10)."""
    ok = F.col("status") == "ok"
    return rows.agg(
        F.count("*").alias("events_total"),
        F.count_if(ok).alias("events_ok"),
        F.count_if(~ok).alias("events_skipped"),
        F.avg("change_pct").alias("mean_change_pct"),
        F.median("change_pct").alias("median_change_pct"),
    )


def backtest(events: DataFrame, prices: DataFrame, window_days: int, search_days: int = SEARCH_DAYS) -> DataFrame:
    """Event returns with the legs called entry and exit."""
    return event_returns(events, prices, window_days, search_days, ("entry", "exit"))


def backtest_summary(rows: DataFrame) -> DataFrame:
    """As return_summary, with the share of gains, the best and the worst change."""
    ok = F.col("status") == "ok"
    return rows.agg(
        F.count("*").alias("events"),
        F.count_if(ok).alias("priced"),
        F.count_if(~ok).alias("skipped"),
        F.avg("change_pct").alias("mean_change_pct"),
        F.median("change_pct").alias("median_change_pct"),
        F.avg(F.when(ok, F.when(F.col("change_pct") > 0, 1.0).otherwise(0.0).cast("double"))).alias("win_rate"),
        F.max("change_pct").alias("best_change_pct"),
        F.min("change_pct").alias("worst_change_pct"),
    )
