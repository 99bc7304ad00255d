"""Feeds: newest items, items by entity, titles and RSS documents."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docketlake.functions import scalars as S

FEED_ITEMS, ENTITIES, WINDOW_DAYS = 100, 200, 30
#: Entity keys become file names; others are counted and left out.
SAFE_KEY = r"^[A-Z0-9.-]+$"


def newest(df: DataFrame, at: str, key: str, n: int = FEED_ITEMS) -> DataFrame:
    """The newest rows; of equal times, the larger key first."""
    return df.orderBy(F.col(at).desc_nulls_last(), F.col(key).desc_nulls_last()).limit(n)


def entity_items(df: DataFrame, entity: str, at: str, key: str, per_entity: int = FEED_ITEMS, entities: int = ENTITIES) -> DataFrame:
    """The newest rows of the busiest entities, with their place ``rn`` from 1.

    The busiest entities are few by definition; rows of others are dropped before anything is sorted, and a row number
    bound lets Spark keep only the first rows of each partition before the shuffle.
    """
    busiest = df.where(F.col(entity).isNotNull()).groupBy(entity).agg(F.count("*").alias("_n")).orderBy(F.col("_n").desc(), F.col(entity)).limit(entities)
    kept = df.join(F.broadcast(busiest.select(entity)), entity, "left_semi")
    place = F.row_number().over(Window.partitionBy(entity).orderBy(F.col(at).desc_nulls_last(), F.col(key).desc_nulls_last()))
    return kept.withColumn("rn", place).where(F.col("rn") <= per_entity)


def safe_entities(df: DataFrame, tickers: Column, at: str, now: str, days: int = WINDOW_DAYS) -> tuple[DataFrame, DataFrame]:
    """Rows by safe entity key, ingested within the window (both ends included), and the number of unsafe keys."""
    recent = F.col(at).cast("date").between(F.date_sub(F.lit(now).cast("date"), days), F.lit(now).cast("date"))
    rows = df.where(recent).withColumn("entity", F.explode(tickers))
    safe = F.coalesce(F.col("entity").rlike(SAFE_KEY), F.lit(False))
    return rows.where(safe), rows.agg(F.count_if(~safe).alias("rejected"))


def latest_name(df: DataFrame, key: str, name: str, at: str, order: str) -> DataFrame:
    """The spelling of a name at its latest time; of equal times the first by ``order``."""
    place = F.row_number().over(Window.partitionBy(key).orderBy(F.col(at).desc_nulls_last(), F.col(order)))
    return df.withColumn("_place", place).where("_place = 1").select(key, name)  # Spark keeps one row a key before the shuffle


def titled(*parts: Column | str) -> Column:
    """Parts in a row; a null part is an optional fragment that is left out."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else F.coalesce(p, F.lit("")) for p in parts])


def _money(c: str) -> Column:
    return F.concat(F.lit("$"), S.plain_number(F.col(c)))


def _maybe(before: str, c: Column, after: str = "") -> Column:
    return F.concat(F.lit(before), c, F.lit(after))


def titles() -> dict[str, Column]:
    """The title of a row of each dataset, over the flat columns of the registry."""
    c, text = F.col, lambda name: F.col(name).cast("string")
    awards = lambda word: titled(c("recipient_name"), _maybe(" — ", _money("amount_usd")), f"{word} from ", c("agency"), " (", text("action_date"), ")")
    short = S.shortened(c("title"))
    percent = F.concat(F.lit(" ("), F.format_string("%.1f", c("short_ratio") * 100), F.lit("%)"))
    return {
        "congress-trades": titled(c("member_name"), " (", c("chamber"), ") ", c("side"), ": ", F.coalesce("ticker", "asset_description"), " — ", c("amount_text")),
        "insider-transactions": titled(
            c("insider_name"), " (", F.coalesce("ticker", "issuer_name"), ") ", F.coalesce("code", F.lit("holding")), _maybe(": ", S.plain_number(c("shares")), " shares"), _maybe(" @ ", _money("price_per_share"))
        ),
        "thirteenf-holdings": titled(c("manager_name"), ": ", S.plain_number(c("shares")), " ", F.coalesce("ticker", "issuer_name"), " (", text("period_end"), _maybe(", ", c("put_call")), ")"),
        "gov-contracts": awards(""),
        "gov-grants": awards(" grant"),
        "lobbying-filings": titled(c("client_name"), " via ", c("registrant_name"), " (", text("filing_year"), " ", c("filing_period"), ")", _maybe(" — ", _money("amount_usd"))),
        "short-volume": titled(c("ticker"), " ", text("date"), ": ", S.plain_number(c("short_volume")), "/", S.plain_number(c("total_volume")), " short", F.when(c("short_ratio").isNotNull(), percent)),
        "committee-assignments": titled(c("member_name"), " — ", c("committee_name"), _maybe(" / ", c("subcommittee_name")), _maybe(" (", c("title"), ")")),
        "patents": titled(F.coalesce("assignee_name", F.lit("Unassigned")), ": ", c("title"), " (", c("patent_id"), ", ", text("grant_date"), ")"),
        "clinical-trials": titled(c("sponsor_name"), " — ", c("overall_status"), _maybe(" ", c("phase")), ": ", c("title")),
        "fda-approvals": titled(c("sponsor_name"), " ", c("application_number"), " ", c("submission_type"), " ", c("submission_number"), _maybe(": ", c("submission_status")), " (", text("status_date"), ")"),
        "cot-reports": titled(c("market_name"), " — COT ", text("report_date")),
        "wiki-pageviews": titled(c("article"), " (", F.when(F.size("tickers") > 0, F.array_join("tickers", ", ")).otherwise(c("project")), "): ", text("views"), " views on ", text("day")),
        "bills": titled(F.upper("bill_type"), " ", text("bill_number"), " (", text("congress"), "th)", _maybe(" — action ", text("latest_action_date")), ": ", short),
        "fec-candidates": titled(c("name"), " (", F.coalesce("party", F.lit("?")), ", ", c("office"), _maybe("-", c("state")), ") ", text("cycle"), _maybe(": ", _money("total_receipts"), " receipts")),
        "fec-contributions": titled(F.coalesce("committee_name", "committee_id"), " → ", F.coalesce("candidate_name", "candidate_id"), ": ", _money("amount_usd"), _maybe(" (", text("date"), ")")),
        "congress-hearings": titled(F.coalesce("chamber", "doc_class", F.lit("joint")), " hearing ", text("held_date"), _maybe(" — ", F.get("committees", F.lit(0))["name"]), ": ", short),
        "fed-communications": titled(c("type"), " ", text("date"), _maybe(" — ", c("speaker")), ": ", short),
    }


def feed_items(df: DataFrame, dataset: str, n: int = FEED_ITEMS) -> DataFrame:
    """The newest rows as RSS items: text of one <item> each, in order."""
    guid = F.concat(F.lit(f"{dataset}:"), F.col("id"))
    item = F.concat(
        F.lit("<item><title>"), S.xml_escape(titles()[dataset]), F.lit("</title><link>"), S.xml_escape(F.col("provenance.source_url")),
        F.lit('</link><guid isPermaLink="false">'), S.xml_escape(guid), F.lit("</guid><pubDate>"), S.rfc822(F.col("provenance.retrieved_at")), F.lit("</pubDate></item>"),
    )
    rows = df.withColumn("_at", F.col("provenance.retrieved_at"))
    return newest(rows, "_at", "id", n).select(item.alias("item"))


def feed_document(items: Iterable[str], title: str, description: str, built: str) -> str:
    """An RSS 2.0 document around at most a hundred items (the driver renders a feed, never a dataset)."""
    head = f"<title>{title}</title><description>{description}</description><lastBuildDate>{built}</lastBuildDate>"
    return "\n".join(['<?xml version="1.0" encoding="UTF-8"?>', '<rss version="2.0"><channel>', head, *items, "</channel></rss>", ""])
