"""Queries of the listing tools (Q1-Q18): each dataset is made of the orders by one rule, in Spark and in SQL alike.

The n-th column of a dataset takes its value from the order key modulo 2, 3, 5 or 7, in turn; so the keys that leave 1
for all of them pass any filter for "1", others pass some filters only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketlake import schema
from docketlake.api import Trackers
from docketlake.plans.catalogue import ORACLES, QUERIES, table

_MODULI = (2, 3, 5, 7)
#: Columns whose filters fold to lower case, or that take certain values.
_LOWER = {"bill_type"}


def _value(name: str, kind: str, n: int, duck: bool) -> str:
    """The n-th column of a dataset as an expression over orders."""
    m = _MODULI[n % 4]
    word = f"concat('{name if name in _LOWER else name.upper()} ', o_orderkey % {m})"
    listed = lambda *x: ("[{}]" if duck else "array({})").format(", ".join(x))
    if kind == "as":
        return listed(word.replace(name.upper(), name) if name == "bill_references" else word, "'OTHER'")
    if kind == "b":
        return "o_orderkey % 2 = 1"
    if kind == "d":
        return "CAST(o_orderdate AS DATE)"
    if kind in ("i", "l", "f"):
        return f"CAST(o_orderkey % {m} AS {({'i': 'INT', 'l': 'BIGINT', 'f': 'DOUBLE'})[kind]})"
    if kind.startswith("array<struct"):
        return listed(f"{{'name': {word}, 'authority_id': 'x'}}" if duck else f"named_struct('name', {word}, 'authority_id', 'x')")
    return word


def made(spark: SparkSession, d: str, dataset: str) -> DataFrame:
    """A dataset made of the orders."""
    columns = [f"{_value(c, t.rstrip('?'), n, False)} AS {c}" for n, (c, t) in enumerate(schema.DATASETS[dataset]._pairs())]
    review = (F.col("o_orderkey") % 11 == 0).alias("_review")
    rows = table(spark, d, "orders").select(F.lpad(F.col("o_orderkey").cast("string"), 9, "0").alias("id"), F.expr("concat('https://e.com/', o_orderkey)").alias("_url"), review, *[F.expr(c) for c in columns])
    proof = schema.provenance("made", F.col("_url"), F.lit("2026-01-01"), "made@1", 1.0, F.col("_review"))
    return schema.conformed(rows.withColumn("provenance", proof), dataset)


def made_sql(dataset: str) -> str:
    columns = ", ".join(f"{_value(c, t.rstrip('?'), n, True)} AS {c}" for n, (c, t) in enumerate(schema.DATASETS[dataset]._pairs()))
    return f"SELECT lpad(CAST(o_orderkey AS VARCHAR), 9, '0') AS id, concat('https://e.com/', o_orderkey) AS citation, o_orderkey % 11 = 0 AS needs_review, {columns} FROM orders"


def _listing(name: str, tool: str, dataset: str, filters: dict, where: str, part: str | None = None) -> None:
    def query(spark: SparkSession, d: str) -> DataFrame:
        tools = Trackers(spark, {dataset: made(spark, d, dataset)})
        found = getattr(tools, tool)(**filters)
        return (found[part] if part else found).select("id", "citation", shown)

    shown = schema.DATASETS[dataset]._pairs()[0][0]
    kind = schema.DATASETS[dataset]._pairs()[0][1]
    if kind == "d":
        query_ = lambda spark, d: query(spark, d).withColumn(shown, F.col(shown).cast("string"))
        text = f"CAST({shown} AS VARCHAR) AS {shown}"
    else:
        query_, text = query, shown
    order = ", ".join(f"{c.lstrip('-')} {'DESC' if c.startswith('-') else 'ASC'}" for c in schema.DATASETS[dataset].order)
    limit = "" if tool == "short_volume" else f" LIMIT {min(filters.get('limit', 50), 500)}"
    QUERIES[name] = query_
    ORACLES[name] = f"SELECT id, citation, {text} FROM ({made_sql(dataset)}) WHERE {where} ORDER BY {'date, id' if tool == 'short_volume' else order}{limit}"


_RANGE = {"since": "1993-01-01", "until": "1997-12-31"}
_IN = "{} BETWEEN DATE '1993-01-01' AND DATE '1997-12-31'"
_like = lambda c, x: f"lower({c}) LIKE '%{x}%'"
_listing(
    "q_congress_trades", "congress_trades", "congress-trades", {"ticker": "ticker 1", "member": "name 1", "chamber": "CHAMBER 1", "side": "SIDE 1", "needs_review": False, "limit": 20, **_RANGE},
    f"ticker = 'TICKER 1' AND {_like('member_name', 'name 1')} AND chamber = 'CHAMBER 1' AND side = 'SIDE 1' AND NOT needs_review AND {_IN.format('transacted_at')}",
)
_listing(
    "q_insider_trades", "insider_trades", "insider-transactions", {"ticker": "Ticker 1", "insider": "NAME 1", "codes": ["code 1", "CODE 0"], "min_value": 1, "is_derivative": True, "limit": 90, **_RANGE},
    f"ticker = 'TICKER 1' AND {_like('insider_name', 'name 1')} AND code IN ('CODE 1', 'CODE 0') AND shares * price_per_share >= 1 AND is_derivative AND {_IN.format('transacted_at')}",
)
for _name in ("contracts", "grants"):
    _listing(
        f"q_gov_{_name}", f"gov_{_name}", f"gov-{_name}", {"ticker": "recipient_tickers 1", "recipient": "name 1", "agency": "AGENCY", "since": "1994-06-01", "min_amount": 1, "limit": 30},
        f"list_contains(recipient_tickers, 'RECIPIENT_TICKERS 1') AND {_like('recipient_name', 'name 1')} AND {_like('agency', 'agency')} AND action_date >= DATE '1994-06-01' AND amount_usd >= 1",
    )
_listing("q_lobbying", "lobbying", "lobbying-filings", {"ticker": "client_tickers 1", "client": "name 1", "registrant": "1", "since_year": 1}, f"list_contains(client_tickers, 'CLIENT_TICKERS 1') AND {_like('client_name', 'name 1')} AND {_like('registrant_name', '1')} AND filing_year >= 1")
_listing("q_lobbying_on_bill", "lobbying_on_bill", "lobbying-filings", {"bill_type": "bill_references ", "bill_number": 1, "limit": 500}, "list_contains(bill_references, 'bill_references 1')")
_listing("q_short_volume_of", "short_volume", "short-volume", {"ticker": "ticker 1", **_RANGE}, f"ticker = 'TICKER 1' AND {_IN.format('date')}")
_listing("q_committee_assignments", "committee_assignments", "committee-assignments", {"bioguide_id": "BIOGUIDE_ID 1", "member": "name 1", "committee": "thomas_id 1", "chamber": "CHAMBER 1"}, f"bioguide_id = 'BIOGUIDE_ID 1' AND {_like('member_name', 'name 1')} AND ({_like('committee_name', 'thomas_id 1')} OR {_like('committee_thomas_id', 'thomas_id 1')}) AND chamber = 'CHAMBER 1'")
_listing("q_patents", "patents", "patents", {"ticker": "assignee_tickers 1", "assignee": "name 1", "cpc_class": "cpc_class 1", **_RANGE}, f"list_contains(assignee_tickers, 'ASSIGNEE_TICKERS 1') AND {_like('assignee_name', 'name 1')} AND cpc_class = 'CPC_CLASS 1' AND {_IN.format('grant_date')}")
_listing("q_clinical_trials", "clinical_trials", "clinical-trials", {"ticker": "sponsor_tickers 1", "sponsor": "name 1", "status": "overall_status 1", "phase": "phase 1", "condition": "itions 1", "since": "1994-01-01"}, f"list_contains(sponsor_tickers, 'SPONSOR_TICKERS 1') AND {_like('sponsor_name', 'name 1')} AND overall_status = 'OVERALL_STATUS 1' AND phase = 'PHASE 1' AND conditions[1] = 'CONDITIONS 1' AND last_updated >= DATE '1994-01-01'")
_listing("q_fda_approvals", "fda_approvals", "fda-approvals", {"ticker": "sponsor_tickers 1", "sponsor": "name 1", "status": "SUBMISSION_STATUS 1", "since": "1994-01-01"}, f"list_contains(sponsor_tickers, 'SPONSOR_TICKERS 1') AND {_like('sponsor_name', 'name 1')} AND submission_status = 'SUBMISSION_STATUS 1' AND status_date >= DATE '1994-01-01'")
_listing("q_cot", "cot", "cot-reports", {"market": "market_name 1", "contract_code": "CONTRACT_CODE 1", "limit": 5000, "since": "1995-01-01", "until": "1996-03-31"}, "lower(market_name) LIKE '%market_name 1%' AND contract_code = 'CONTRACT_CODE 1' AND report_date BETWEEN DATE '1995-01-01' AND DATE '1996-03-31'")
_listing("q_wiki_pageviews", "wiki_pageviews", "wiki-pageviews", {"ticker": "tickers 1", "article": "article 1", "limit": 500, "since": "1997-01-01", "until": "1997-06-30"}, f"list_contains(tickers, 'TICKERS 1') AND {_like('article', 'article 1')} AND day BETWEEN DATE '1997-01-01' AND DATE '1997-06-30'")
_listing("q_bills", "bills", "bills", {"q": "title 1", "congress": 1, "bill_type": "BILL_TYPE 1", "bill_number": 1, "sponsor": "SPONSOR_BIOGUIDE_ID 1", "policy_area": "area 1", "since": "1994-01-01"}, f"{_like('title', 'title 1')} AND congress = 1 AND bill_type = 'bill_type 1' AND bill_number = 1 AND sponsor_bioguide_id = 'SPONSOR_BIOGUIDE_ID 1' AND {_like('policy_area', 'area 1')} AND latest_action_date >= DATE '1994-01-01'", "bills")
_listing("q_congress_hearings", "congress_hearings", "congress-hearings", {"q": "nesses 1", "congress": 1, "chamber": "CHAMBER 1", "committee": "committees 1", **_RANGE}, f"({_like('title', 'nesses 1')} OR lower(witnesses[1]) LIKE '%nesses 1%') AND congress = 1 AND chamber = 'CHAMBER 1' AND {_like('committees[1].name', 'committees 1')} AND {_IN.format('held_date')}")
_listing("q_fed_communications", "fed_communications", "fed-communications", {"q": "title 1", "type": "TYPE 1", "speaker": "aker 1", **_RANGE}, f"{_like('title', 'title 1')} AND type = 'TYPE 1' AND {_like('speaker', 'aker 1')} AND {_IN.format('date')}")
_listing("q_campaign_finance", "campaign_finance", "fec-candidates", {"candidate_id": "candidate_id 1", "q": "name 1", "cycle": 1, "office": "office 1", "state": "state 1"}, f"candidate_id = 'CANDIDATE_ID 1' AND {_like('name', 'name 1')} AND cycle = 1 AND office = 'OFFICE 1' AND state = 'STATE 1'", "candidates")
_listing("q_fec_contributions", "fec_contributions", "fec-contributions", {"candidate_id": "candidate_id 1", "committee_id": "committee_id 1", "committee": "name 1", "cycle": 1, "since": "1994-01-01"}, f"candidate_id = 'CANDIDATE_ID 1' AND committee_id = 'COMMITTEE_ID 1' AND {_like('committee_name', 'name 1')} AND cycle = 1 AND date >= DATE '1994-01-01'")


def _contributions_of_one(spark: SparkSession, d: str) -> DataFrame:
    tools = Trackers(spark, {"fec-candidates": made(spark, d, "fec-candidates"), "fec-contributions": made(spark, d, "fec-contributions")})
    return tools.campaign_finance(candidate_id="candidate_id 1", cycle=1, limit=70)["contributions"].select("id", "candidate_id")


QUERIES["q_campaign_contributions"] = _contributions_of_one
ORACLES["q_campaign_contributions"] = f"SELECT id, candidate_id FROM ({made_sql('fec-contributions')}) WHERE candidate_id = 'CANDIDATE_ID 1' AND cycle = 1 ORDER BY date DESC, id LIMIT 70"


def _titles(spark: SparkSession, d: str) -> DataFrame:
    """The titles (F24) of the rows that a listing of each dataset shows first."""
    tables = {name: made(spark, d, name) for name in _TITLES}
    parts = [Trackers(spark, tables).titles(name, 500).select(F.lit(name).alias("dataset"), "id", "title") for name in _TITLES]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found


#: Titles in SQL over the made rows, in which no optional part is missing. Of the datasets whose order has no ties.
_TITLES = {
    "congress-trades": "member_name || ' (' || chamber || ') ' || side || ': ' || ticker || ' — ' || amount_text",
    "gov-contracts": "recipient_name || ' — $' || CAST(amount_usd AS BIGINT) || ' from ' || agency || ' (' || action_date || ')'",
    "gov-grants": "recipient_name || ' — $' || CAST(amount_usd AS BIGINT) || ' grant from ' || agency || ' (' || action_date || ')'",
    "lobbying-filings": "client_name || ' via ' || registrant_name || ' (' || filing_year || ' ' || filing_period || ') — $' || CAST(amount_usd AS BIGINT)",
    "committee-assignments": "member_name || ' — ' || committee_name || ' / ' || subcommittee_name || ' (' || title || ')'",
    "patents": "assignee_name || ': ' || title || ' (' || patent_id || ', ' || grant_date || ')'",
    "clinical-trials": "sponsor_name || ' — ' || overall_status || ' ' || phase || ': ' || title",
    "fda-approvals": "sponsor_name || ' ' || application_number || ' ' || submission_type || ' ' || submission_number || ': ' || submission_status || ' (' || status_date || ')'",
    "bills": "upper(bill_type) || ' ' || bill_number || ' (' || congress || 'th) — action ' || latest_action_date || ': ' || title",
    "congress-hearings": "chamber || ' hearing ' || held_date || ' — ' || committees[1].name || ': ' || title",
    "fed-communications": "type || ' ' || date || ' — ' || speaker || ': ' || title",
}
QUERIES["q_titles"] = _titles
_ordered = lambda name: ", ".join(f"{c.lstrip('-')} {'DESC' if c.startswith('-') else 'ASC'}" for c in schema.DATASETS[name].order)
ORACLES["q_titles"] = " UNION ALL ".join(f"(SELECT '{name}' AS dataset, id, {sql} AS title FROM ({made_sql(name)}) ORDER BY {_ordered(name)} LIMIT 500)" for name, sql in _TITLES.items())
