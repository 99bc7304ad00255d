"""The eighteen datasets: columns, natural key, event date, freshness, default order and validation.

Columns are flat and typed by hand, nothing is inferred; a question mark marks a column that may be null. Every dataset
also has ``id`` and ``provenance``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SCHEMA_VERSION = 2
PROVENANCE = "struct<source:string,source_url:string,retrieved_at:timestamp,parser:string,confidence:double,needs_review:boolean>"
CONFIDENCES = (1.0, 0.9, 0.7)
_SHORT = {"s": "string", "d": "date", "f": "double", "i": "int", "l": "bigint", "b": "boolean", "as": "array<string>"}
_AWARD = "award_id s? award_type s? agency s sub_agency s? recipient_name s recipient_uei s? recipient_tickers as amount_usd f? action_date d description s? naics_code s? naics_description s?"


@dataclass(frozen=True)
class Dataset:
    """A dataset: ``columns`` as "name type" pairs, the parts of its key, its event date and so on."""

    name: str
    columns: str
    key: tuple[str, ...]
    event: str
    fresh_hours: float
    order: tuple[str, ...]
    tickers: str | None = None
    replaced: bool = False

    def _pairs(self) -> list[tuple[str, str]]:
        words = self.columns.split()
        return list(zip(words[::2], words[1::2], strict=True))

    @property
    def ddl(self) -> str:
        body = [f"{n} {_SHORT.get(t.rstrip('?'), t.rstrip('?'))}" for n, t in self._pairs()]
        return ", ".join(["id string", *body, f"provenance {PROVENANCE}"])

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.ddl)

    @property
    def required(self) -> list[str]:
        return ["id", "provenance", *[n for n, t in self._pairs() if not t.endswith("?")]]

    def identified(self, df: DataFrame) -> DataFrame:
        """Rows with their natural key in ``id``; a null part leaves the key out of the text, colon and all."""
        return df.withColumn("id", F.concat_ws(":", *[F.col(k).cast("string") for k in self.key]))

    def event_date(self) -> Column:
        return F.expr(self.event)

    def empty(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([], self.schema)


#: Values that a column may take, by dataset and column.
ENUMS: dict[str, dict[str, tuple[str, ...]]] = {
    "congress-trades": {"chamber": ("senate", "house"), "side": ("buy", "sell", "exchange"), "owner": ("self", "spouse", "joint", "dependent"), "asset_type": ("stock", "option", "bond", "fund", "crypto", "other")},
    "insider-transactions": {"form_type": ("3", "4", "5", "3/A", "4/A", "5/A"), "acquired_disposed": ("A", "D"), "ownership": ("direct", "indirect")},
    "thirteenf-holdings": {"share_type": ("SH", "PRN"), "put_call": ("put", "call")},
    "fec-candidates": {"office": ("H", "S", "P")},
    "fed-communications": {"type": ("minutes", "statement", "pressRelease", "speech", "testimony")},
}

DATASETS: dict[str, Dataset] = {
    d.name: d
    for d in (
        Dataset(
            "congress-trades",
            "chamber s doc_id s row_index i member_name s bioguide_id s? party s? state s? filed_at d transacted_at d ticker s? asset_description s asset_type s side s amount_min f amount_max f? amount_text s owner s?",
            ("chamber", "doc_id", "row_index"), "transacted_at", 72, ("-transacted_at", "id"), "array(ticker)",
        ),
        Dataset(
            "insider-transactions",
            "accession_number s form_type s ticker s? issuer_cik s issuer_name s insider_name s insider_cik s insider_title s? is_director b is_officer b is_ten_pct_owner b transacted_at d? filed_at d code s? acquired_disposed s? "
            "security_title s shares f? price_per_share f? shares_owned_after f? ownership s is_derivative b",
            ("accession_number", "table_index"), "coalesce(transacted_at, filed_at)", 72, ("-transacted_at", "id"), "array(ticker)",
        ),
        Dataset(
            "thirteenf-holdings",
            "accession_number s manager_cik s manager_name s period_end d filed_at d cusip s ticker s? issuer_name s share_type s? shares f value_usd f put_call s?",
            ("accession_number", "row_index"), "period_end", 1080, ("-value_usd", "id"), "array(ticker)",
        ),
        Dataset("gov-contracts", _AWARD, ("id",), "action_date", 96, ("-action_date", "id"), "recipient_tickers"),
        Dataset("gov-grants", _AWARD, ("id",), "action_date", 96, ("-action_date", "id"), "recipient_tickers"),
        Dataset(
            "lobbying-filings",
            "filing_uuid s registrant_name s client_name s client_tickers as amount_usd f? filing_year i filing_period s filing_type s? issues as bill_references as",
            ("filing_uuid",), "make_date(filing_year, 1, 1)", 2880, ("-filing_year", "id"), "client_tickers",
        ),
        Dataset("short-volume", "date d ticker s market s short_volume f short_exempt_volume f total_volume f short_ratio f?", ("date", "ticker", "market"), "date", 96, ("date", "id"), "array(ticker)"),
        Dataset(
            "committee-assignments",
            "bioguide_id s member_name s chamber s committee_thomas_id s committee_name s committee_type s subcommittee_thomas_id s? subcommittee_name s? rank i? title s?",
            ("bioguide_id", "committee_thomas_id", "subcommittee_key"), "cast(provenance.retrieved_at as date)", 1080, ("committee_thomas_id", "id"), replaced=True,
        ),
        Dataset("patents", "patent_id s title s grant_date d assignee_name s? assignee_tickers as assignee_count l kind s? cpc_class s?", ("patent_id",), "grant_date", 2880, ("-grant_date", "id"), "assignee_tickers"),
        Dataset(
            "clinical-trials",
            "nct_id s title s sponsor_name s sponsor_tickers as phase s? overall_status s study_type s? conditions as start_date s? primary_completion_date s? last_updated d",
            ("nct_id",), "last_updated", 96, ("-last_updated", "id"), "sponsor_tickers",
        ),
        Dataset(
            "fda-approvals",
            "application_number s sponsor_name s sponsor_tickers as brand_name s? submission_type s submission_number s submission_status s? status_date d",
            ("application_number", "submission_type", "submission_number"), "status_date", 288, ("-status_date", "id"), "sponsor_tickers",
        ),
        Dataset(
            "cot-reports",
            "report_date d contract_code s market_name s open_interest f commercial_long f commercial_short f non_commercial_long f non_commercial_short f non_reportable_long f non_reportable_short f",
            ("report_date", "contract_code"), "report_date", 240, ("-report_date", "contract_code"),
        ),
        Dataset("wiki-pageviews", "project s article s day d views l tickers as", ("project", "article", "day"), "day", 96, ("-day", "article"), "tickers"),
        Dataset(
            "bills",
            "congress i bill_type s bill_number i title s introduced_date d latest_action_date d? latest_action_text s? sponsor_bioguide_id s? sponsor_name s? policy_area s? cosponsor_count i",
            ("bill_key",), "coalesce(latest_action_date, introduced_date)", 240, ("-latest_action_date", "id"),
        ),
        Dataset(
            "fec-candidates",
            "candidate_id s cycle i name s party s? office s state s? district s? incumbent_challenger s? total_receipts f? total_disbursements f? cash_on_hand f? coverage_end_date d?",
            ("candidate_id", "cycle"), "coalesce(coverage_end_date, make_date(cycle, 1, 1))", 1080, ("-cycle", "-total_receipts", "id"),
        ),
        Dataset(
            "fec-contributions",
            "committee_id s committee_name s? candidate_id s candidate_name s? amount_usd f date d? transaction_type s cycle i",
            ("id",), "coalesce(date, make_date(cycle, 1, 1))", 1080, ("-date", "id"),
        ),
        Dataset(
            "congress-hearings",
            "package_id s title s chamber s? doc_class s? congress i session i? held_date d citation s? committees array<struct<name:string,authority_id:string>> witnesses as member_bioguide_ids as detail_url s html_url s? pdf_url s?",
            ("package_id",), "held_date", 720, ("-held_date", "id"),
        ),
        Dataset("fed-communications", "type s date d title s speaker s? venue s? url s video_url s? note s?", ("id",), "date", 96, ("-date", "id")),
    )
}


def provenance(source: str, url: Column, retrieved_at: Column, parser: str, confidence: float = 1.0, needs_review: Column | None = None) -> Column:
    return F.struct(
        F.lit(source).alias("source"),
        url.alias("source_url"),
        retrieved_at.cast("timestamp").alias("retrieved_at"),
        F.lit(parser).alias("parser"),
        F.lit(confidence).alias("confidence"),
        (F.lit(False) if needs_review is None else needs_review).alias("needs_review"),
    )


def conformed(df: DataFrame, name: str) -> DataFrame:
    """The columns of a dataset in their order and types; a missing column is null."""
    schema = DATASETS[name].schema
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])


def validate(df: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and the others with ``reasons``: required columns that are null, values outside an enumeration."""
    dataset = DATASETS[name]
    checks = [(F.col(c).isNull(), f"{c} is missing") for c in dataset.required]
    checks += [(~F.col(c).isin(*values), f"{c} is not one of {', '.join(values)}") for c, values in ENUMS.get(name, {}).items()]
    checks.append((~F.col("provenance.confidence").isin(*CONFIDENCES), "confidence is not one of the known values"))
    reasons = F.array_compact(F.array(*[F.when(F.coalesce(bad, F.lit(False)), F.lit(reason)) for bad, reason in checks]))
    marked = df.withColumn("reasons", reasons)
    return marked.where(F.size("reasons") == 0).drop("reasons"), marked.where(F.size("reasons") > 0)


def split(df: DataFrame, name: str, build: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """``build`` the dataset's columns from raw rows, then validate: what every reader returns."""
    return validate(conformed(build(df), name), name)


def all_rows(tables: dict[str, DataFrame]) -> DataFrame:
    """(dataset, id, event_date, retrieved_at) over all given datasets."""
    parts = [df.select(F.lit(n).alias("dataset"), "id", DATASETS[n].event_date().alias("event_date"), F.col("provenance.retrieved_at").alias("retrieved_at")) for n, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)
