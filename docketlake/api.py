"""The query surface: one function for each public tool, over a catalog of stored datasets (Q1-Q18 and the composed ones).

A function returns a lazy DataFrame, or several by name. ``None`` leaves a filter out; limits are clamped.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketlake.functions import scalars as S
from docketlake.operators import aggregates, asof, joins
from docketlake.operators import filters as P
from docketlake.operators.store import with_citation
from docketlake.schema import DATASETS

# Transaction codes of ownership forms and their meaning, from the forms' instructions.
CODES = {
    "P": "Open market or private purchase of securities",
    "S": "Open market or private sale of securities",
    "V": "Transaction voluntarily reported earlier than required",
    "A": "Grant, award, or other acquisition",
    "D": "Sale (or disposition) back to the issuer",
    "F": "Payment of exercise price or tax liability by delivering or withholding securities",
    "I": "Discretionary transaction, which is an order to the broker to execute the transaction at the best possible price",
    "M": "Exercise or conversion of derivative security",
    "C": "Conversion of derivative security",
    "E": "Expiration of short derivative position",
    "H": "Expiration (or cancellation) of long derivative position with value received",
    "O": "Exercise of out-of-the-money derivative security",
    "X": "Exercise of in-the-money or at-the-money derivative security",
    "G": "Bona fide gift",
    "L": "Small acquisition",
    "W": "Acquisition or disposition by will or the laws of descent and distribution",
    "Z": "Deposit into or withdrawal from voting trust",
    "J": "Other acquisition or disposition (described in footnotes)",
    "K": "Transaction in equity swap or similar instrument",
    "U": "Disposition pursuant to a tender of shares in a change of control transaction",
}
WINDOW_DAYS = 90


def checked_date(value: str | None) -> str | None:
    if value is not None and not re.fullmatch(r"\d{4}-\d{2}-\d{2}", value):
        raise ValueError(f"'{value}' is not a date of the form YYYY-MM-DD")
    return value


class Trackers:
    """The tools over ``tables``, a DataFrame for each dataset (absent ones are empty)."""

    def __init__(self, spark: SparkSession, tables: dict[str, DataFrame]):
        self.spark, self.tables = spark, tables

    @classmethod
    def at(cls, spark: SparkSession, folder: str) -> Trackers:
        """Datasets stored as versioned tables below a folder."""
        from docketlake.operators.store import VersionedTable

        found = {name: VersionedTable(spark, f"{folder}/{name}").read() for name in DATASETS}
        return cls(spark, {n: df for n, df in found.items() if df is not None})

    def table(self, name: str) -> DataFrame:
        return self.tables[name] if name in self.tables else DATASETS[name].empty(self.spark)

    def _listing(self, name: str, parts, limit=None) -> DataFrame:
        by = DATASETS[name].order
        return with_citation(P.listing(self.table(name), parts, by if "id" in by else (*by, "id"), limit))  # the id settles ties

    @staticmethod
    def _range(column: str, since, until=None):
        return P.between(column, checked_date(since), checked_date(until))

    # --- members, insiders, managers

    def congress_trades(self, ticker=None, member=None, chamber=None, since=None, until=None, side=None, needs_review=None, limit=None):
        parts = [P.equals("ticker", ticker, "upper"), P.contains("member_name", member), P.equals("chamber", chamber), P.equals("side", side), P.equals("provenance.needs_review", needs_review)]
        return self._listing("congress-trades", [*parts, self._range("transacted_at", since, until)], limit)

    def congress_members(self, q=None, limit=None):
        rows = P.where(self.table("congress-trades"), P.contains("member_name", q))
        return aggregates.activity(rows, ["member_name", "bioguide_id", "chamber", "party", "state"], "transacted_at", "member_name", "trades", P.clamp(limit))

    def insider_trades(self, ticker=None, insider=None, codes=None, since=None, until=None, min_value=None, is_derivative=None, limit=None):
        parts = [P.equals("ticker", ticker, "upper"), P.contains("insider_name", insider), P.one_of("code", codes), P.product_at_least("shares", "price_per_share", min_value), P.equals("is_derivative", is_derivative)]
        return self._listing("insider-transactions", [*parts, self._range("transacted_at", since, until)], limit)

    def legend(self, rows: DataFrame) -> DataFrame:
        """The codes in use with their meaning."""
        known = self.spark.createDataFrame(list(CODES.items()), "code string, description string")
        used = rows.select("code").where("code is not null").distinct()
        return used.join(F.broadcast(known), "code", "left").withColumn("description", F.coalesce("description", F.lit("See SEC form instructions")))

    def insider_summary(self, ticker, today, window_days=WINDOW_DAYS):
        since = F.date_sub(F.lit(checked_date(today)).cast("date"), window_days)
        rows = self.table("insider-transactions").where((F.col("ticker") == ticker.upper()) & (F.col("transacted_at") >= since))
        common = rows.where(~F.col("is_derivative"))
        value = F.sum((F.col("shares") * F.col("price_per_share")).cast("decimal(18,2)")).cast("double").alias("total_value")
        notable = P.top_groups(rows, ["insider_name", "insider_title"], [F.count("*").alias("n"), value], ["-total_value"], 10)
        return {"codes": aggregates.code_breakdown(common, "code", "shares", "price_per_share"), "open_market": aggregates.open_market(common, "code", "shares"), "notable": notable, "legend": self.legend(rows)}

    def thirteenf_holders(self, ticker=None, cusip=None, period_end=None, limit=None):
        if ticker is None and cusip is None:
            raise ValueError("a ticker or a cusip is needed")
        rows = P.where(self.table("thirteenf-holdings"), P.equals("ticker", ticker, "upper"), P.equals("cusip", cusip)).withColumn("source_url", F.col("provenance.source_url"))
        found = joins.period_change(rows, ["manager_cik", "put_call"], ["manager_name", "source_url"], "period_end", "shares", "value_usd", checked_date(period_end))
        return found.orderBy(*P.order("-value_usd", "manager_cik", "put_call", "source_url")).limit(P.clamp(limit))

    def thirteenf_manager(self, manager_cik=None, q=None, period_end=None, limit=None):
        rows = P.where(self.table("thirteenf-holdings"), P.equals("manager_cik", manager_cik), P.equals("period_end", period_end))
        return with_citation(joins.manager_holdings(rows, q or "", ["manager_cik", "manager_name"], "period_end", ["-value_usd", "id"], limit))

    # --- awards, lobbying, markets

    def _awards(self, name, ticker, recipient, agency, since, min_amount, limit):
        parts = [P.has("recipient_tickers", ticker), P.contains("recipient_name", recipient), P.contains("agency", agency), P.at_least("amount_usd", min_amount)]
        return self._listing(name, [*parts, self._range("action_date", since)], limit)

    def gov_contracts(self, ticker=None, recipient=None, agency=None, since=None, min_amount=None, limit=None):
        return self._awards("gov-contracts", ticker, recipient, agency, since, min_amount, limit)

    def gov_grants(self, ticker=None, recipient=None, agency=None, since=None, min_amount=None, limit=None):
        return self._awards("gov-grants", ticker, recipient, agency, since, min_amount, limit)

    def gov_contract_totals(self, ticker=None, recipient=None, granularity="quarter", since=None, dataset="gov-contracts", limit=None):
        if ticker is None and recipient is None:
            raise ValueError("a ticker or a recipient is needed")
        rows = P.where(self.table(dataset), P.has("recipient_tickers", ticker), P.contains("recipient_name", recipient), self._range("action_date", since))
        return aggregates.award_totals(rows, "action_date", "amount_usd", granularity, P.clamp(limit or 40))

    def lobbying(self, ticker=None, client=None, registrant=None, since_year=None, limit=None):
        parts = [P.has("client_tickers", ticker), P.contains("client_name", client), P.contains("registrant_name", registrant), P.at_least("filing_year", since_year)]
        return self._listing("lobbying-filings", parts, limit)

    def lobbying_on_bill(self, bill_type, bill_number, limit=None):
        return self._listing("lobbying-filings", [P.has("bill_references", f"{bill_type}{int(bill_number)}", "lower")], limit)

    def short_volume(self, ticker, since=None, until=None):
        rows = P.where(self.table("short-volume"), P.equals("ticker", ticker, "upper"), self._range("date", since, until))
        return with_citation(rows.orderBy(*P.order("date", "id")))  # the one listing without a limit

    def patents(self, ticker=None, assignee=None, since=None, until=None, cpc_class=None, limit=None):
        parts = [P.has("assignee_tickers", ticker), P.contains("assignee_name", assignee), P.equals("cpc_class", cpc_class, "upper")]
        return self._listing("patents", [*parts, self._range("grant_date", since, until)], limit)

    def clinical_trials(self, ticker=None, sponsor=None, status=None, phase=None, condition=None, since=None, limit=None):
        parts = [P.has("sponsor_tickers", ticker), P.contains("sponsor_name", sponsor), P.equals("overall_status", status, "upper"), P.equals("phase", phase, "upper"), P.any_contains("conditions", condition)]
        return self._listing("clinical-trials", [*parts, self._range("last_updated", since)], limit)

    def fda_approvals(self, ticker=None, sponsor=None, status=None, since=None, limit=None):
        parts = [P.has("sponsor_tickers", ticker), P.contains("sponsor_name", sponsor), P.equals("submission_status", status)]
        return self._listing("fda-approvals", [*parts, self._range("status_date", since)], limit)

    def cot(self, market=None, contract_code=None, since=None, until=None, limit=None):
        return self._listing("cot-reports", [P.contains("market_name", market), P.equals("contract_code", contract_code), self._range("report_date", since, until)], limit)

    def wiki_pageviews(self, ticker=None, article=None, since=None, until=None, limit=None):
        return self._listing("wiki-pageviews", [P.has("tickers", ticker), P.contains("article", article), self._range("day", since, until)], limit)

    # --- legislature and central bank

    def bills(self, q=None, congress=None, bill_type=None, bill_number=None, sponsor=None, policy_area=None, since=None, limit=None):
        parts = [P.contains("title", q), P.equals("congress", congress), P.equals("bill_type", bill_type, "lower"), P.equals("bill_number", bill_number), P.equals("sponsor_bioguide_id", sponsor), P.contains("policy_area", policy_area)]
        found = self._listing("bills", [*parts, self._range("latest_action_date", since)], limit)
        return {"bills": found, "lobbying": joins.bill_lobbying(found, self.table("lobbying-filings"))}

    def congress_hearings(self, q=None, congress=None, chamber=None, committee=None, since=None, until=None, limit=None):
        parts = [P.any_of(P.contains("title", q), P.any_contains("witnesses", q)), P.equals("congress", congress), P.equals("chamber", chamber), P.any_contains("committees", committee, "name")]
        return self._listing("congress-hearings", [*parts, self._range("held_date", since, until)], limit)

    def fed_communications(self, q=None, type=None, speaker=None, since=None, until=None, limit=None):
        return self._listing("fed-communications", [P.contains("title", q), P.equals("type", type), P.contains("speaker", speaker), self._range("date", since, until)], limit)

    def campaign_finance(self, candidate_id=None, q=None, cycle=None, office=None, state=None, limit=None):
        parts = [P.equals("candidate_id", candidate_id, "upper"), P.contains("name", q), P.equals("cycle", cycle), P.equals("office", office, "upper"), P.equals("state", state, "upper")]
        found = self._listing("fec-candidates", parts, limit)
        own = joins.candidate_contributions(found, P.where(self.table("fec-contributions"), P.equals("cycle", cycle)))
        return {"candidates": found, "contributions": with_citation(P.listing(own, [], DATASETS["fec-contributions"].order, limit))}

    def fec_contributions(self, candidate_id=None, committee_id=None, committee=None, cycle=None, since=None, limit=None):
        parts = [P.equals("candidate_id", candidate_id, "upper"), P.equals("committee_id", committee_id, "upper"), P.contains("committee_name", committee), P.equals("cycle", cycle)]
        return self._listing("fec-contributions", [*parts, self._range("date", since)], limit)

    def committee_assignments(self, bioguide_id=None, member=None, committee=None, chamber=None, limit=None):
        parts = [P.equals("bioguide_id", bioguide_id), P.contains("member_name", member), P.any_of(P.contains("committee_name", committee), P.contains("committee_thomas_id", committee)), P.equals("chamber", chamber)]
        return self._listing("committee-assignments", parts, limit)

    def committees(self, q):
        """The best matching committee's roster with each member's trades."""
        seats = P.where(self.table("committee-assignments"), P.any_of(P.contains("committee_name", q), P.contains("committee_thomas_id", q)))
        best = P.top_groups(seats, ["committee_thomas_id"], [F.count("*").alias("_n")], ["-_n"], 1).select("committee_thomas_id")
        own = self.table("committee-assignments").join(F.broadcast(best), "committee_thomas_id", "left_semi")  # one row
        subs = own.groupBy("bioguide_id").agg(F.array_sort(F.collect_set("subcommittee_name")).alias("subcommittees"))
        found = joins.roster(own, self.table("congress-trades"), ["committee_thomas_id", "committee_name", "bioguide_id", "member_name"], "bioguide_id", F.min("rank").alias("rank"), F.max("title").alias("title"), "transacted_at")
        return found.join(subs, "bioguide_id", "left").orderBy(*P.order("-trades", "member_name"))

    def member_profile(self, q):
        """Identity, committees, trade statistics, top tickers and latest trades of the best match."""
        trades, seats = self.table("congress-trades"), self.table("committee-assignments")
        traded = self.congress_members(q, 1).select(F.lit(0).alias("_at"), "member_name", "bioguide_id", "chamber", "party", "state")
        seated = P.where(seats, P.contains("member_name", q)).orderBy("member_name", "bioguide_id").limit(1)
        seated = seated.select(F.lit(1).alias("_at"), "member_name", "bioguide_id", "chamber", F.lit(None).cast("string").alias("party"), F.lit(None).cast("string").alias("state"))
        member = traded.unionByName(seated).orderBy("_at").limit(1).drop("_at")
        who = F.broadcast(member.select(F.lower("member_name").alias("_m"), F.col("bioguide_id").alias("_b")))  # one row
        own = trades.join(who, F.contains(F.lower("member_name"), F.col("_m"))).drop("_m", "_b")
        sitting = seats.join(who, F.when(F.col("_b").isNotNull(), F.col("bioguide_id") == F.col("_b")).otherwise(F.contains(F.lower("member_name"), F.col("_m")))).drop("_m", "_b")
        return {
            "member": member,
            "committees": joins.fold_committees(sitting),
            "stats": aggregates.trade_stats(own, "side", "transacted_at"),
            "top_tickers": P.top_groups(own.where("ticker is not null"), ["ticker"], [F.count("*").alias("trades")], ["-trades"], 10),
            "recent": with_citation(own.orderBy(*P.order("-transacted_at", "id")).limit(10)),
        }

    # --- across datasets

    def _ticker_counts(self) -> DataFrame:
        return joins.ticker_counts({n: (self.table(n), F.expr(d.tickers)) for n, d in DATASETS.items() if d.tickers})

    def search(self, q, issuers: DataFrame, limit=10):
        """Tickers, members, managers and insiders that match, with their rows by dataset (A9). ``issuers``: (ticker, name)."""
        found = P.where(issuers, P.any_of(P.contains("ticker", q), P.contains("name", q))).groupBy("ticker", "name").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "ticker", "name").limit(limit)
        tickers = found.join(self._ticker_counts(), "ticker", "left").select(F.lit("ticker").alias("kind"), "name", F.col("ticker").alias("key"), "dataset", "rows")

        def kind(name: str, dataset: str, column: str, key: str) -> DataFrame:
            groups = P.top_groups(P.where(self.table(dataset), P.contains(column, q)), [column, key] if key != column else [column], [F.count("*").alias("rows")], ["-rows"], limit)
            return groups.select(F.lit(name).alias("kind"), F.col(column).alias("name"), F.col(key).alias("key"), F.lit(dataset).alias("dataset"), "rows")

        members = kind("member", "congress-trades", "member_name", "bioguide_id")
        managers, insiders = kind("manager", "thirteenf-holdings", "manager_name", "manager_cik"), kind("insider", "insider-transactions", "insider_name", "insider_name")
        return tickers.unionByName(members).unionByName(managers).unionByName(insiders)

    def freshness(self, now):
        return aggregates.freshness({n: (self.table(n).select(F.col("provenance.retrieved_at").alias("at")), "at", d.fresh_hours) for n, d in DATASETS.items()}, now)

    # --- analytics

    def trade_events(self, **filters) -> DataFrame:
        """Trades as events of their filing day (P13); all matching rows, not a page of them."""
        rows = self.congress_trades(**filters) if "limit" in filters else P.where(self.table("congress-trades"), P.equals("ticker", filters.get("ticker"), "upper"), P.contains("member_name", filters.get("member")))
        label = F.concat_ws(" ", "member_name", "side", "ticker")
        return rows.where("ticker is not null and ticker != ''").select(F.col("id").alias("event_key"), "ticker", F.col("filed_at").alias("event_date"), label.alias("label"))

    def insider_events(self, ticker=None) -> DataFrame:
        rows = P.where(self.table("insider-transactions"), P.equals("ticker", ticker, "upper")).where("ticker is not null and ticker != ''")
        label = F.concat_ws(" ", "insider_name", F.coalesce("code", F.lit("holding")))
        return rows.select(F.col("id").alias("event_key"), "ticker", F.col("filed_at").alias("event_date"), label.alias("label"))

    def analyze(self, events: DataFrame, prices: DataFrame, window_days: int, search_days: int = asof.SEARCH_DAYS):
        rows = asof.event_returns(events, prices, window_days, search_days)
        return {"rows": rows, "summary": asof.return_summary(rows), "disclaimer": asof.DISCLAIMER}

    def backtest(self, events: DataFrame, prices: DataFrame, window_days: int, search_days: int = asof.SEARCH_DAYS):
        rows = asof.backtest(events, prices, window_days, search_days)
        return {"rows": rows, "summary": asof.backtest_summary(rows), "disclaimer": asof.DISCLAIMER}

    def titles(self, dataset: str, limit=None) -> DataFrame:
        from docketlake.operators.feeds import titles

        return self._listing(dataset, [], limit).select("id", S.shortened(titles()[dataset], 400).alias("title"), "citation")


TOOLS: dict[str, Callable] = {
    name: getattr(Trackers, name)
    for name in (
        "congress_trades", "congress_members", "insider_trades", "insider_summary", "thirteenf_holders", "thirteenf_manager", "gov_contracts", "lobbying", "short_volume", "gov_grants", "member_profile", "committees",
        "patents", "clinical_trials", "fda_approvals", "cot", "wiki_pageviews", "bills", "congress_hearings", "fed_communications", "campaign_finance", "gov_contract_totals", "search", "freshness",
    )
}
