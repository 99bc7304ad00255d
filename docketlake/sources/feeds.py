"""Readers of JSON pages: awards, lobbying filings, studies, drug applications, positioning, pageviews, central-bank
items (R8, R9, R12-R15, R20). Schemas are declared; each reader returns (good rows, rejected rows with reasons)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docketlake import schema
from docketlake.functions import scalars as S

# The counts of a positioning row, by column of the dataset.
COUNT_FIELDS = {
    "open_interest": "open_interest_all", "commercial_long": "comm_positions_long_all", "commercial_short": "comm_positions_short_all",
    "non_commercial_long": "noncomm_positions_long_all", "non_commercial_short": "noncomm_positions_short_all",
    "non_reportable_long": "nonrept_positions_long_all", "non_reportable_short": "nonrept_positions_short_all",
}

AWARDS = """results array<struct<generated_internal_id:string,`Award ID`:string,`Contract Award Type`:string,`Awarding Agency`:string,`Awarding Sub Agency`:string,`Recipient Name`:string,
`Recipient UEI`:string,`Award Amount`:double,`Base Obligation Date`:string,`Start Date`:string,Description:string,`NAICS Code`:string,`NAICS Description`:string>>"""
FILINGS = """results array<struct<filing_uuid:string,filing_year:int,filing_period:string,filing_type:string,income:string,expenses:string,dt_posted:string,filing_document_url:string,
registrant:struct<name:string>,client:struct<name:string>,lobbying_activities:array<struct<general_issue_code:string,description:string>>>>"""
STUDIES = """studies array<struct<protocolSection:struct<identificationModule:struct<nctId:string,briefTitle:string>,statusModule:struct<overallStatus:string,startDateStruct:struct<date:string>,
primaryCompletionDateStruct:struct<date:string>,lastUpdatePostDateStruct:struct<date:string>>,sponsorCollaboratorsModule:struct<leadSponsor:struct<name:string>>,designModule:struct<phases:array<string>,studyType:string>,
conditionsModule:struct<conditions:array<string>>>>>"""
APPLICATIONS = """results array<struct<application_number:string,sponsor_name:string,openfda:struct<brand_name:array<string>>,
submissions:array<struct<submission_type:string,submission_number:string,submission_status:string,submission_status_date:string>>>>"""
POSITIONS = "report_date_as_yyyy_mm_dd:string,cftc_contract_market_code:string,market_and_exchange_names:string," + ",".join(f"{c}:string" for c in COUNT_FIELDS.values())
VIEWS = "items array<struct<project:string,article:string,timestamp:string,views:string>>"
ITEMS = "d:string,t:string,pt:string,l:string,s:string,lo:string,v:string,a:string"


def pages(spark: SparkSession, path: str, ddl: str, field: str | None = None) -> DataFrame:
    """Objects of JSON files; with ``field``, the elements of that array.

    A file without ``field`` is an array of objects; a byte order mark does no harm.
    """
    if field is None:
        texts = spark.read.option("wholetext", "true").text(path).select(F.col("_metadata.file_path").alias("file"), F.regexp_replace("value", "^\\x{FEFF}", "").alias("value"))
        return texts.select("file", F.explode(F.from_json("value", f"array<struct<{ddl}>>")).alias("r")).select("file", "r.*")
    df = spark.read.schema(ddl.replace("\n", "")).option("multiLine", "true").json(path)
    return df.select(F.col("_metadata.file_path").alias("file"), F.explode(field).alias("r")).select("file", "r.*")


def no_tickers() -> Column:
    return F.array().cast("array<string>")


def with_tickers(df: DataFrame, name: str, tickers: str, resolved: DataFrame | None) -> DataFrame:
    """Add the tickers of a company name from a resolved table (name, tickers); unknown names have none."""
    if resolved is None:
        return df.withColumn(tickers, no_tickers())
    known = resolved.select(F.col("name").alias("_name"), F.col("tickers").alias(tickers))
    return df.join(known, F.col(name) == F.col("_name"), "left").drop("_name").withColumn(tickers, F.coalesce(tickers, no_tickers()))


def _proven(df: DataFrame, source: str, parser: str, retrieved_at: str, url: Column | None = None) -> DataFrame:
    return df.withColumn("provenance", schema.provenance(source, F.col("file") if url is None else url, F.lit(retrieved_at), parser))


def awards(spark: SparkSession, path: str, retrieved_at: str, dataset: str = "gov-contracts", resolved: DataFrame | None = None):
    """Contract or grant awards (R8): the signing date, or else the start date; null amounts stay null."""

    def build(rows: DataFrame) -> DataFrame:
        day = lambda c: F.when(F.col(c).rlike(r"^\d{4}-\d{2}-\d{2}$"), S.iso_date(F.col(c)))
        flat = rows.select(
            "file", F.col("generated_internal_id").alias("id"), F.col("Award ID").alias("award_id"), F.col("Contract Award Type").alias("award_type"), S.blank_to_null(F.col("Awarding Agency")).alias("agency"),
            F.col("Awarding Sub Agency").alias("sub_agency"), S.blank_to_null(F.col("Recipient Name")).alias("recipient_name"), S.blank_to_null(F.col("Recipient UEI")).alias("recipient_uei"),
            F.col("Award Amount").alias("amount_usd"), F.coalesce(day("Base Obligation Date"), day("Start Date")).alias("action_date"), F.col("Description").alias("description"),
            F.col("NAICS Code").alias("naics_code"), F.col("NAICS Description").alias("naics_description"),
        )
        return _proven(with_tickers(flat, "recipient_name", "recipient_tickers", resolved), "usaspending", "usaspending@1", retrieved_at)

    return schema.split(pages(spark, path, AWARDS, "results"), dataset, build)


def lobbying(spark: SparkSession, path: str, retrieved_at: str, resolved: DataFrame | None = None):
    """Lobbying filings (R9): income, or else expenses; issue codes once, in order; bills cited in the descriptions."""

    def build(rows: DataFrame) -> DataFrame:
        acts = F.coalesce("lobbying_activities", F.array().cast("array<struct<general_issue_code:string,description:string>>"))
        codes = F.array_distinct(F.array_compact(F.transform(acts, lambda x: S.blank_to_null(x["general_issue_code"]))))
        texts = F.array_join(F.array_compact(F.transform(acts, lambda x: S.blank_to_null(x["description"]))), " ")
        flat = rows.select(
            "file", F.col("filing_uuid").alias("id"), "filing_uuid", S.blank_to_null(F.col("registrant.name")).alias("registrant_name"), S.blank_to_null(F.col("client.name")).alias("client_name"),
            F.coalesce(S.parse_number(F.col("income")), S.parse_number(F.col("expenses"))).alias("amount_usd"), "filing_year", "filing_period", "filing_type",
            codes.alias("issues"), S.bill_references(texts).alias("bill_references"), S.blank_to_null(F.col("filing_document_url")).alias("_url"),
        )
        return _proven(with_tickers(flat, "client_name", "client_tickers", resolved), "lda", "lda@1", retrieved_at, F.coalesce("_url", "file"))

    return schema.split(pages(spark, path, FILINGS, "results"), "lobbying-filings", build)


def studies(spark: SparkSession, path: str, retrieved_at: str, resolved: DataFrame | None = None):
    """Clinical studies (R12): phases joined by slashes; partial dates stay as they are."""

    def build(rows: DataFrame) -> DataFrame:
        p = lambda c: F.col(f"protocolSection.{c}")
        nct = F.trim(p("identificationModule.nctId"))
        flat = rows.select(
            "file", F.when(nct.rlike(r"^NCT\d+$"), nct).alias("nct_id"), S.blank_to_null(p("identificationModule.briefTitle")).alias("title"),
            S.blank_to_null(p("sponsorCollaboratorsModule.leadSponsor.name")).alias("sponsor_name"),
            F.when(F.size(p("designModule.phases")) > 0, F.array_join(p("designModule.phases"), "/")).alias("phase"), S.blank_to_null(p("statusModule.overallStatus")).alias("overall_status"),
            p("designModule.studyType").alias("study_type"), F.coalesce(p("conditionsModule.conditions"), no_tickers()).alias("conditions"),
            S.partial_date(p("statusModule.startDateStruct.date")).alias("start_date"), S.partial_date(p("statusModule.primaryCompletionDateStruct.date")).alias("primary_completion_date"),
            S.iso_date(p("statusModule.lastUpdatePostDateStruct.date")).alias("last_updated"),
        )
        return _proven(with_tickers(flat, "sponsor_name", "sponsor_tickers", resolved).withColumn("id", F.col("nct_id")), "clinicaltrials", "clinicaltrials@1", retrieved_at)

    return schema.split(pages(spark, path, STUDIES, "studies"), "clinical-trials", build)


def drug_applications(spark: SparkSession, path: str, retrieved_at: str, since: str | None = None, until: str | None = None, resolved: DataFrame | None = None):
    """A row for each submission of an application (R13); those dated outside the range are left out, undated ones rejected."""

    def build(rows: DataFrame) -> DataFrame:
        subs = rows.select("file", "application_number", "sponsor_name", F.get("openfda.brand_name", F.lit(0)).alias("brand_name"), F.explode("submissions").alias("s"))
        flat = subs.select(
            "file", "application_number", S.blank_to_null(F.col("sponsor_name")).alias("sponsor_name"), "brand_name", S.blank_to_null(F.col("s.submission_type")).alias("submission_type"),
            S.blank_to_null(F.col("s.submission_number")).alias("submission_number"), S.blank_to_null(F.col("s.submission_status")).alias("submission_status"),
            S.compact_date(F.col("s.submission_status_date")).alias("status_date"),
        )
        if since is not None:
            flat = flat.where(F.col("status_date").isNull() | (F.col("status_date") >= since))
        if until is not None:
            flat = flat.where(F.col("status_date").isNull() | (F.col("status_date") <= until))
        return _proven(schema.DATASETS["fda-approvals"].identified(with_tickers(flat, "sponsor_name", "sponsor_tickers", resolved)), "openfda", "openfda@1", retrieved_at)

    return schema.split(pages(spark, path, APPLICATIONS, "results"), "fda-approvals", build)


def positioning(spark: SparkSession, path: str, retrieved_at: str):
    """Futures positioning (R14): one count that is no number of 0 or more rejects the row."""

    def build(rows: DataFrame) -> DataFrame:
        count = lambda c: F.when(S.parse_number(F.col(c), ",") >= 0, S.parse_number(F.col(c), ","))
        flat = rows.select(
            "file", S.iso_date(F.col("report_date_as_yyyy_mm_dd")).alias("report_date"), S.blank_to_null(F.col("cftc_contract_market_code")).alias("contract_code"),
            S.blank_to_null(F.col("market_and_exchange_names")).alias("market_name"), *[count(c).alias(n) for n, c in COUNT_FIELDS.items()],
        )
        return _proven(schema.DATASETS["cot-reports"].identified(flat), "cftc", "cftc@1", retrieved_at)

    return schema.split(pages(spark, path, POSITIONS), "cot-reports", build)


def pageviews(spark: SparkSession, path: str, retrieved_at: str, articles: DataFrame):
    """Daily pageviews (R15) of the articles asked for, ``articles`` being (project, article, tickers).

    Timestamps are ten digits that end in 00 and name a real day; an item of another article is rejected.
    """

    def build(rows: DataFrame) -> DataFrame:
        stamp = F.col("timestamp")
        flat = rows.select(
            "file", F.col("project").alias("_p"), F.col("article").alias("_a"), F.when(stamp.rlike(r"^\d{8}00$"), S.compact_date(F.substring(stamp, 1, 8))).alias("day"),
            F.when(F.trim("views").rlike(r"^\d+$"), F.trim("views").try_cast("bigint")).alias("views"),
        )
        joined = flat.join(articles, (F.col("_p") == F.col("project")) & (F.col("_a") == F.col("article")), "left")
        return _proven(schema.DATASETS["wiki-pageviews"].identified(joined), "wikimedia", "wikimedia@1", retrieved_at)

    return schema.split(pages(spark, path, VIEWS, "items"), "wiki-pageviews", build)


def fed_items(spark: SparkSession, path: str, retrieved_at: str, kind: str | None = None, base: str = "https://www.federalreserve.gov"):
    """Central-bank items (R20). Without ``kind`` (the press feed) only monetary-policy items count, typed by title."""

    def build(rows: DataFrame) -> DataFrame:
        title = F.coalesce("t", F.lit(""))
        by_title = F.when(title.startswith("Minutes of the Federal Open Market Committee"), "minutes").when(F.contains(title, F.lit("FOMC statement")), "statement").otherwise("pressRelease")
        wanted = rows if kind else rows.where(F.col("pt") == "Monetary Policy")
        absolute = lambda c: F.when(F.trim(c).rlike("(?i)^https?://"), F.trim(c)).otherwise(F.concat(F.lit(base), F.regexp_replace(F.trim(c), "^/?", "/")))
        text = lambda c: S.blank_to_null(F.col(c))
        flat = wanted.select(
            "file", S.link_id(F.col("l")).alias("id"), (F.lit(kind) if kind else by_title).alias("type"), S.slash_date(F.col("d")).alias("date"), text("t").alias("title"), text("s").alias("speaker"),
            text("lo").alias("venue"), absolute(text("l")).alias("url"), F.when(text("v").isNotNull(), absolute(F.col("v"))).alias("video_url"), text("a").alias("note"),
        )
        return _proven(flat, "federalreserve", "federalreserve@1", retrieved_at)

    return schema.split(pages(spark, path, ITEMS), "fed-communications", build)
