"""Queries of the readers (R1-R20, F25) and the stored forms (S1-S14): raw files are rendered from the driver tables into
the shared folder, read as a landed source would be, and held against SQL over the tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docketlake import schema
from docketlake.functions import scalars as S
from docketlake.operators import feeds as rss
from docketlake.operators import store
from docketlake.plans.catalogue import day, registered, table
from docketlake.sources import delimited, documents, feeds
from docketlake.streaming.incremental import shared_folder

AT = "2026-01-10 12:00:00"
#: Objects of a page, as public interfaces answer.
PAGE = 400


def text_files(df: DataFrame, line: Column, name: str) -> str:
    path = shared_folder(df.sparkSession, name)
    df.select(line.alias("value")).write.text(path)
    return path


def separated(n: int, **at: Column) -> Column:
    """A line of ``n`` fields between bars; ``c3=...`` is the fourth."""
    return F.concat_ws("|", *[F.coalesce(at[f"c{k}"].cast("string"), F.lit("")) if f"c{k}" in at else F.lit("") for k in range(n)])


def json_pages(df: DataFrame, key: str, item: Column, name: str, field: str | None) -> str:
    """Objects in pages, a file each: in the array ``field``, or as the array itself."""
    path = shared_folder(df.sparkSession, name)
    pages = df.select((F.col(key) / PAGE).cast("long").alias("page"), item.alias("item")).groupBy("page").agg(F.collect_list("item").alias("items"))
    text = F.to_json("items") if field is None else F.to_json(F.struct(F.col("items").alias(field)))
    pages.select("page", text.alias("value")).repartition("page").write.partitionBy("page").text(path)
    return f"{path}/*"


def xml_files(df: DataFrame, key: str, text: Column, name: str) -> str:
    """A document for each row, a file each."""
    path = shared_folder(df.sparkSession, name)
    df.select(F.col(key).alias("part"), F.regexp_replace(text, "\n", " ").alias("value")).repartition("part").write.partitionBy("part").text(path)
    return f"{path}/*/*"


# --- delimited text


@registered("""SELECT strftime(o_orderdate, '%Y-%m-%d') || ':S' || o_custkey || ':CNMS' AS id, CAST(o_orderkey % 1000 AS DOUBLE) AS short_volume, CAST(o_orderkey % 3 AS DOUBLE) * 1000 AS total_volume,
    CASE WHEN o_orderkey % 3 > 0 THEN round((o_orderkey % 1000) / ((o_orderkey % 3) * 1000.0), 6) END AS short_ratio FROM orders""")
def q_read_short_volume(spark, d):
    k = F.col("o_orderkey")
    line = separated(6, c0=F.date_format("o_orderdate", "yyyyMMdd"), c1=F.concat(F.lit("s"), "o_custkey"), c2=k % 1000, c3=F.lit(0), c4=k % 3 * 1000, c5=F.lit("Q"))
    good, _ = delimited.short_volume(spark, text_files(table(spark, d, "orders"), line, "short-volume"), "CNMS", AT)
    return good.select("id", "short_volume", "total_volume", "short_ratio")


@registered("""SELECT CAST(o_custkey AS VARCHAR) AS cik, CASE o_orderkey % 3 WHEN 0 THEN '4' WHEN 1 THEN '13F-HR' ELSE '8-K' END AS form_type, strftime(o_orderdate, '%Y-%m-%d') AS date_filed, 'e/' || o_orderkey || '.txt' AS path,
    o_orderkey % 3 = 0 AS ownership, o_orderkey % 3 = 1 AS holdings FROM orders""")
def q_read_filing_index(spark, d):
    k = F.col("o_orderkey")
    form = F.when(k % 3 == 0, "4").when(k % 3 == 1, "13F-HR").otherwise("8-K")
    line = separated(5, c0=F.col("o_custkey"), c1=F.lit("Acme"), c2=form, c3=F.date_format("o_orderdate", "yyyyMMdd"), c4=F.concat(F.lit("e/"), k.cast("string"), F.lit(".txt")))
    found = delimited.filing_index(spark, text_files(table(spark, d, "orders"), line, "filing-index"))
    return found.select("cik", "form_type", day("date_filed").alias("date_filed"), "path", delimited.is_ownership_form(F.col("form_type")).alias("ownership"), delimited.is_holdings_form(F.col("form_type")).alias("holdings"))


@registered("""SELECT CASE c_custkey % 3 WHEN 0 THEN 'H' WHEN 1 THEN 'S' ELSE 'P' END || c_custkey || ':2026' AS id, c_name AS name, CASE c_custkey % 3 WHEN 0 THEN 'H' WHEN 1 THEN 'S' ELSE 'P' END AS office,
    CAST(c_acctbal AS DOUBLE) AS total_receipts, '2026-03-' || lpad(CAST(c_custkey % 28 + 1 AS VARCHAR), 2, '0') AS coverage_end_date FROM customer""")
def q_read_candidates(spark, d):
    k = F.col("c_custkey")
    office = F.when(k % 3 == 0, "H").when(k % 3 == 1, "S").otherwise("P")
    line = separated(30, c0=F.concat(office, k.cast("string")), c1=F.col("c_name"), c5=F.col("c_acctbal"), c27=F.concat(F.lit("03/"), F.lpad((k % 28 + 1).cast("string"), 2, "0"), F.lit("/2026")))
    good, _ = delimited.candidates(spark, text_files(table(spark, d, "customer"), line, "candidates"), 2026, AT)
    return good.select("id", "name", "office", "total_receipts", day("coverage_end_date").alias("coverage_end_date"))


@registered("""SELECT CAST(o_orderkey AS VARCHAR) AS id, s_name AS committee_name, c_name AS candidate_name, -CAST(o_totalprice AS DOUBLE) AS amount_usd, CASE WHEN o_orderkey % 7 > 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS date
    FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN supplier ON s_suppkey = o_orderkey % 50""")
def q_read_contributions(spark, d):
    k = F.col("o_orderkey")
    date = F.when(k % 7 > 0, F.date_format("o_orderdate", "MMddyyyy")).otherwise("13321999")
    line = separated(22, c0=F.concat(F.lit("C"), (k % 50).cast("string")), c5=F.lit("24K"), c13=date, c14=-F.col("o_totalprice"), c16=F.concat(F.lit("H"), "o_custkey"), c21=k)
    names = lambda t, first, key, name: delimited.master_names(spark, text_files(table(spark, d, t), separated(3, c0=F.concat(F.lit(first), key), c1=F.col(name)), t))
    committees, people = names("supplier", "C", "s_suppkey", "s_name"), names("customer", "H", "c_custkey", "c_name")
    good, _ = delimited.contributions(spark, text_files(table(spark, d, "orders"), line, "contributions"), 2026, AT, committees, people)
    return good.select("id", "committee_name", "candidate_name", "amount_usd", day("date").alias("date"))


@registered("SELECT 'T' || o_custkey AS ticker, strftime(o_orderdate, '%Y-%m-%d') AS date, CAST(o_totalprice AS DOUBLE) AS close FROM orders WHERE o_orderkey % 9 > 0")
def q_read_prices(spark, d):
    path = shared_folder(spark, "prices")
    ticker = F.when(F.col("o_orderkey") % 9 > 0, F.concat(F.lit("t"), "o_custkey")).otherwise("")
    rows = table(spark, d, "orders").select(day("o_orderdate").alias("date"), ticker.alias("ticker"), F.col("o_totalprice").cast("string").alias("close"))
    rows.write.option("header", True).option("emptyValue", "").csv(path)
    return delimited.prices(spark, path)[0].select("ticker", day("date").alias("date"), "close")


# --- JSON pages


@registered("""SELECT CAST(o_orderkey AS VARCHAR) AS id, o_clerk AS agency, c_name AS recipient_name, CAST(o_totalprice AS DOUBLE) AS amount_usd, strftime(o_orderdate, '%Y-%m-%d') AS action_date, 'T' || o_custkey AS tickers
    FROM orders JOIN customer ON o_custkey = c_custkey""".replace("o_clerk", "o_orderpriority"))
def q_read_awards(spark, d):
    rows = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    signed = F.when(F.col("o_orderkey") % 2 == 0, day("o_orderdate")).otherwise("unknown")
    item = F.struct(
        F.col("o_orderkey").cast("string").alias("generated_internal_id"), F.col("o_orderpriority").alias("Awarding Agency"), F.col("c_name").alias("Recipient Name"), F.col("o_totalprice").cast("double").alias("Award Amount"),
        signed.alias("Base Obligation Date"), day("o_orderdate").alias("Start Date"),
    )
    known = table(spark, d, "customer").select(F.col("c_name").alias("name"), F.array(F.concat(F.lit("T"), "c_custkey")).alias("tickers"))
    good, _ = feeds.awards(spark, json_pages(rows, "o_orderkey", item, "awards", "results"), AT, resolved=known)
    return good.select("id", "agency", "recipient_name", "amount_usd", day("action_date").alias("action_date"), F.array_join("recipient_tickers", ",").alias("tickers"))


@registered("""SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_totalprice AS DOUBLE) AS amount_usd, 'TAX,DEF' AS issues, 'hr' || (o_orderkey % 1000 + 1) || ',s7' AS bills, CAST(year(o_orderdate) AS INT) AS filing_year FROM orders""")
def q_read_lobbying(spark, d):
    k = F.col("o_orderkey")
    act = lambda code, text: F.struct(F.lit(code).alias("general_issue_code"), text.alias("description"))
    acts = F.array(act("TAX", F.concat(F.lit("On H.R. "), (k % 1000 + 1).cast("string"), F.lit(" and"))), act("TAX", F.lit("S. 7")), act("DEF", F.lit(" ")))
    price = F.col("o_totalprice").cast("string")
    item = F.struct(
        k.cast("string").alias("filing_uuid"), F.year("o_orderdate").alias("filing_year"), F.lit("Q1").alias("filing_period"), F.when(k % 2 == 0, price).alias("income"), price.alias("expenses"),
        F.struct(F.lit("R").alias("name")).alias("registrant"), F.struct(F.lit("C").alias("name")).alias("client"), acts.alias("lobbying_activities"),
    )
    good, _ = feeds.lobbying(spark, json_pages(table(spark, d, "orders"), "o_orderkey", item, "lobbying", "results"), AT)
    return good.select("id", "amount_usd", F.array_join("issues", ",").alias("issues"), F.array_join("bill_references", ",").alias("bills"), "filing_year")


@registered("""SELECT 'NCT' || p_partkey AS id, p_name AS title, CASE WHEN p_partkey % 2 = 0 THEN 'PHASE1/PHASE2' END AS phase, p_brand AS overall_status, '2025-0' || (p_partkey % 9 + 1) AS start_date, p_type AS conditions FROM part""")
def q_read_studies(spark, d):
    k = F.col("p_partkey")
    dated = lambda x: F.struct(x.alias("date"))
    item = F.struct(
        F.struct(
            F.struct(F.concat(F.lit("NCT"), k.cast("string")).alias("nctId"), F.col("p_name").alias("briefTitle")).alias("identificationModule"),
            F.struct(F.col("p_brand").alias("overallStatus"), dated(F.concat(F.lit("2025-0"), (k % 9 + 1).cast("string"))).alias("startDateStruct"), dated(F.lit("2026-01-05")).alias("lastUpdatePostDateStruct")).alias("statusModule"),
            F.struct(F.struct(F.lit("Sponsor").alias("name")).alias("leadSponsor")).alias("sponsorCollaboratorsModule"),
            F.struct(F.when(k % 2 == 0, F.array(F.lit("PHASE1"), F.lit("PHASE2"))).otherwise(F.array().cast("array<string>")).alias("phases")).alias("designModule"),
            F.struct(F.array("p_type").alias("conditions")).alias("conditionsModule"),
        ).alias("protocolSection")
    )
    good, _ = feeds.studies(spark, json_pages(table(spark, d, "part"), "p_partkey", item, "studies", "studies"), AT)
    return good.select("id", "title", "phase", "overall_status", "start_date", F.array_join("conditions", ",").alias("conditions"))


@registered("""SELECT 'A' || o_orderkey || ':' || t || ':1' AS id, o_orderpriority AS sponsor_name, strftime(o_orderdate, '%Y-%m-%d') AS status_date FROM orders, (VALUES ('ORIG'), ('SUPPL')) x(t) WHERE o_orderdate >= DATE '1995-01-01'""")
def q_read_drug_applications(spark, d):
    sub = lambda t: F.struct(F.lit(t).alias("submission_type"), F.lit("1").alias("submission_number"), F.lit("AP").alias("submission_status"), F.date_format("o_orderdate", "yyyyMMdd").alias("submission_status_date"))
    item = F.struct(F.concat(F.lit("A"), "o_orderkey").alias("application_number"), F.col("o_orderpriority").alias("sponsor_name"), F.array(sub("ORIG"), sub("SUPPL")).alias("submissions"))
    good, _ = feeds.drug_applications(spark, json_pages(table(spark, d, "orders"), "o_orderkey", item, "drugs", "results"), AT, since="1995-01-01")
    return good.select("id", "sponsor_name", day("status_date").alias("status_date"))


@registered("""SELECT strftime(o_orderdate, '%Y-%m-%d') || ':' || o_orderkey AS id, o_orderpriority AS market_name, CAST(o_custkey * 1000 AS DOUBLE) AS open_interest, CAST(o_orderkey AS DOUBLE) AS commercial_long FROM orders WHERE o_orderkey % 5 > 0""")
def q_read_positioning(spark, d):
    grouped = F.format_number(F.col("o_custkey") * 1000, 0)
    counts = {"open_interest": grouped, "commercial_long": F.col("o_orderkey").cast("string"), "commercial_short": F.when(F.col("o_orderkey") % 5 == 0, "-1").otherwise("1")}
    item = F.struct(
        F.concat(day("o_orderdate"), F.lit("T00:00:00.000")).alias("report_date_as_yyyy_mm_dd"), F.col("o_orderkey").cast("string").alias("cftc_contract_market_code"), F.col("o_orderpriority").alias("market_and_exchange_names"),
        *[counts.get(n, F.lit("0")).alias(c) for n, c in feeds.COUNT_FIELDS.items()],
    )
    good, _ = feeds.positioning(spark, json_pages(table(spark, d, "orders"), "o_orderkey", item, "positioning", None), AT)
    return good.select("id", "market_name", "open_interest", "commercial_long")


@registered("""SELECT 'en:' || c_name || ':' || strftime(o_orderdate, '%Y-%m-%d') AS id, CAST(o_orderkey AS BIGINT) AS views, 'T' || c_custkey AS tickers FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_custkey % 2 = 0""")
def q_read_pageviews(spark, d):
    rows = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    item = F.struct(F.lit("en").alias("project"), F.col("c_name").alias("article"), F.date_format("o_orderdate", "yyyyMMdd00").alias("timestamp"), F.col("o_orderkey").cast("string").alias("views"))
    asked = table(spark, d, "customer").where("c_custkey % 2 = 0").select(F.lit("en").alias("project"), F.col("c_name").alias("article"), F.array(F.concat(F.lit("T"), "c_custkey")).alias("tickers"))
    good, _ = feeds.pageviews(spark, json_pages(rows, "o_orderkey", item, "pageviews", "items"), AT, asked)
    return good.select("id", "views", F.array_join("tickers", ",").alias("tickers"))


@registered("""SELECT 'monetary' || o_orderkey AS id, CASE o_orderkey % 3 WHEN 0 THEN 'minutes' WHEN 1 THEN 'statement' ELSE 'pressRelease' END AS type, strftime(o_orderdate, '%Y-%m-%d') AS date, 'https://www.federalreserve.gov/newsevents/monetary' || o_orderkey || '.htm' AS url
    FROM orders WHERE o_orderkey % 2 = 0""")
def q_read_fed_items(spark, d):
    k = F.col("o_orderkey")
    title = F.when(k % 3 == 0, "Minutes of the Federal Open Market Committee, x").when(k % 3 == 1, "An FOMC statement").otherwise("Other")
    item = F.struct(F.date_format("o_orderdate", "M/d/yyyy").alias("d"), title.alias("t"), F.when(k % 2 == 0, "Monetary Policy").otherwise("Other").alias("pt"), F.concat(F.lit("/newsevents/monetary"), k.cast("string"), F.lit(".htm")).alias("l"))
    good, _ = feeds.fed_items(spark, json_pages(table(spark, d, "orders"), "o_orderkey", item, "fed", None), AT)
    return good.select("id", "type", day("date").alias("date"), "url")


# --- documents


@registered("SELECT 'senate:S' || s_suppkey || ':' || i AS id, 'buy' AS side, CASE i WHEN 0 THEN 'stock' ELSE 'bond' END AS asset_type, CAST(CASE i WHEN 0 THEN 1001 ELSE 0 END AS DOUBLE) AS amount_min, i = 1 AS needs_review, CAST(0.9 AS DOUBLE) AS confidence, s_name AS member_name FROM supplier, (VALUES (0), (1)) x(i)")
def q_read_senate_reports(spark, d):
    head = "".join(f"<th>{h}</th>" for h in ("#", "Transaction Date", "Owner", "Ticker", "Asset Name", "Asset Type", "Type", "Amount"))
    row = lambda *cells: "<tr>" + "".join(f"<td>{c}</td>" for c in cells) + "</tr>"
    page = f"<table><tr>{head}</tr>" + row("1", "01/05/2026", "Spouse", "ACM", "Acme", "Stock", "Purchase", "$1,001 - $15,000") + row("2", "01/06/2026", "Self", "--", "Bond of 2030", "Corporate Bond", "Purchase", "Unknown") + "</table>"
    path = shared_folder(spark, "senate")
    makers = table(spark, d, "supplier").select("s_suppkey", "s_name")
    store.write_files(makers.select(F.concat(F.lit("S"), "s_suppkey", F.lit(".html")).alias("name"), F.lit(page).alias("text")), path)  # the readers take a file for each report
    filings = makers.select(F.concat(F.lit("S"), "s_suppkey").alias("doc_id"), F.col("s_name").alias("member_name"), F.lit("B").alias("bioguide_id"), F.lit("X").alias("party"), F.lit("NY").alias("state"), F.lit("2026-01-09").cast("date").alias("filed_at"))
    good, _, _ = documents.senate_reports(spark, path, filings, AT)
    return good.select("id", "side", "asset_type", "amount_min", F.col("provenance.needs_review").alias("needs_review"), F.col("provenance.confidence").alias("confidence"), "member_name")


@registered("SELECT 'https://e.com/' || p_partkey AS url, '2026-01-05' AS lastmod FROM part")
def q_read_sitemap(spark, d):
    entry = F.concat(F.lit("<url><loc>https://e.com/"), F.col("p_partkey").cast("string"), F.lit("</loc><lastmod>2026-01-05</lastmod></url>"))
    pages = table(spark, d, "part").groupBy((F.col("p_partkey") / PAGE).cast("long").alias("page")).agg(F.concat_ws("", F.collect_list(entry)).alias("body"))
    text = F.concat(F.lit('<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'), F.col("body"), F.lit("</urlset>"))
    found = documents.sitemap(spark, xml_files(pages, "page", text, "sitemap"))[0]
    return found.select("url", F.substring(F.col("lastmod").cast("string"), 1, 10).alias("lastmod"))


# --- scalar functions


@registered("""SELECT o_orderkey, 'AC' || chr(CAST(65 + o_orderkey % 26 AS INT)) AS ticker, CASE o_orderkey % 4 WHEN 0 THEN 'stock' WHEN 1 THEN 'bond' WHEN 2 THEN 'fund' ELSE 'stock' END AS house_kind,
    CASE o_orderkey % 3 WHEN 0 THEN 'buy' WHEN 1 THEN 'sell' ELSE 'exchange' END AS house_side, CASE o_orderkey % 3 WHEN 0 THEN 'buy' WHEN 1 THEN 'sell' ELSE 'exchange' END AS senate_side,
    CASE o_orderkey % 3 WHEN 0 THEN 'spouse' WHEN 1 THEN 'joint' ELSE 'dependent' END AS owner, CASE o_orderkey % 3 WHEN 0 THEN 'option' WHEN 1 THEN 'fund' ELSE 'other' END AS senate_kind,
    lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS cik, CAST(o_totalprice AS DOUBLE) AS number, o_orderkey % 2 = 0 AS flag, 'a &amp; b &lt;' || o_orderkey || '&gt; &quot;' AS xml,
    strftime(o_orderdate, '%a, %d %b %Y') || ' 00:00:00 GMT' AS rfc, CASE WHEN extract(isodow FROM o_orderdate) >= 6 THEN true ELSE false END AS weekend FROM orders""")
def q_scalar_parsers(spark, d):
    k = F.col("o_orderkey")
    pick = lambda *x: F.element_at(F.array(*map(F.lit, x)), (k % len(x) + 1).cast("int"))
    symbol = F.concat(F.lit("AC"), F.char(65 + k % 26))
    asset = F.concat(F.lit("Acme (12) ("), symbol, F.lit(") "), pick("[ST]", "municipal", "[MF]", "[ZZ]"))
    return table(spark, d, "orders").select(
        "o_orderkey", S.asset_ticker(asset).alias("ticker"), S.house_asset_type(asset, S.asset_ticker(asset)).alias("house_kind"), S.house_side(pick("P", "S (partial)", "e")).alias("house_side"),
        S.senate_side(pick("Purchase", "Sale (Full)", "Exchange")).alias("senate_side"), S.senate_owner(pick("Spouse", "Joint", "Child")).alias("owner"), S.senate_asset_type(pick("Stock Option", "An ETF", "Farm")).alias("senate_kind"),
        S.pad_cik(F.concat(F.lit(" 0"), "o_custkey")).alias("cik"), S.parse_number(F.concat(F.lit(" $"), F.col("o_totalprice").cast("string"))).alias("number"), S.parse_flag(pick("Yes", "no")).alias("flag"),
        S.xml_escape(F.concat(F.lit("a & b <"), k.cast("string"), F.lit('> "'))).alias("xml"), S.rfc822(F.col("o_orderdate").cast("date").cast("timestamp")).alias("rfc"), S.is_weekend(F.col("o_orderdate").cast("date")).alias("weekend"),
    )


# --- stored forms


def _dated(spark: SparkSession, d: str) -> DataFrame:
    """Orders as rows of a dataset: id, event date, and the order's day as that of retrieval."""
    return table(spark, d, "orders").select(F.lpad(F.col("o_orderkey").cast("string"), 9, "0").alias("id"), F.col("o_orderdate").cast("date").alias("event"), F.col("o_orderdate").cast("timestamp").alias("retrieved_at"), F.col("o_totalprice").cast("double").alias("price"))


@registered("SELECT CAST(year(o_orderdate) AS VARCHAR) AS event_year, form, count(*) AS n, round(sum(o_totalprice), 0) AS price FROM orders, (VALUES ('json'), ('parquet')) f(form) GROUP BY 1, 2")
def q_shards_read_back(spark, d):
    def one(form: str) -> DataFrame:
        path = shared_folder(spark, "shards")
        store.write_shards(_dated(spark, d), path, F.col("event"), form=form)
        found = spark.read.schema("id string, event date, retrieved_at timestamp, price double, event_year string").format(form).load(path)
        return found.groupBy("event_year").agg(F.count("*").alias("n"), F.round(F.sum("price"), 0).alias("price")).withColumn("form", F.lit(form))

    return one("json").unionByName(one("parquet"))


@registered("SELECT strftime(o_orderdate, '%Y-%m-%d') AS ingest_day, count(*) AS n FROM orders GROUP BY 1")
def q_deltas_read_back(spark, d):
    path, rows = shared_folder(spark, "deltas"), _dated(spark, d)
    for since in (None, "1997-01-01"):  # the second run replaces its days
        store.write_deltas(rows, path, since=since)
    found = spark.read.schema("id string, ingest_day date").json(path)
    return found.groupBy(day("ingest_day").alias("ingest_day")).agg(F.count("*").alias("n"))


@registered("SELECT lpad(CAST(o_orderkey AS VARCHAR), 9, '0') AS id FROM orders WHERE CAST(o_orderdate AS DATE) = (SELECT max(CAST(o_orderdate AS DATE)) FROM orders)")
def q_latest_delta(spark, d):
    return store.latest_delta(_dated(spark, d)).select("id")


@registered("SELECT lpad(CAST(o_orderkey AS VARCHAR), 9, '0') AS id, CASE WHEN o_orderkey % 2 = 0 THEN 2 ELSE 1 END * CAST(o_totalprice AS DOUBLE) AS price FROM orders")
def q_dump_import(spark, d):
    path, rows = shared_folder(spark, "dump"), _dated(spark, d).select("id", "price")
    rows.write.json(f"{path}/2024")
    rows.where(F.col("id").cast("long") % 2 == 0).withColumn("price", F.col("price") * 2).write.json(f"{path}/2025")
    return store.read_dump(spark, [f"{path}/2024", f"{path}/2025"], "id string, price double")


@registered("SELECT lpad(CAST(o_orderkey AS VARCHAR), 9, '0') AS id, CAST(o_totalprice AS DOUBLE) + CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END AS price FROM orders")
def q_versioned_upsert(spark, d):
    kept, rows = store.VersionedTable(spark, shared_folder(spark, "table")), _dated(spark, d).select("id", "price", F.lit(1).alias("at"))
    fresh = rows.where(F.col("id").cast("long") % 3 == 0).select("id", (F.col("price") + 1).alias("price"), F.lit(2).alias("at"))
    for batch in (rows, fresh, fresh, rows.limit(0)):  # a batch that comes twice, and an empty one, change nothing
        kept.upsert(batch, ["id"], ["at"])
    return kept.read().select("id", "price")


@registered("""SELECT '<item><title>M — COT ' || strftime(o_orderdate, '%Y-%m-%d') || '</title><link>https://e.com/' || o_orderkey || '</link><guid isPermaLink="false">cot-reports:' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') || '</guid><pubDate>'
    || strftime(o_orderdate, '%a, %d %b %Y') || ' 00:00:00 GMT</pubDate></item>' AS item FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 100""")
def q_rss_items(spark, d):
    rows = table(spark, d, "orders").select(F.lpad(F.col("o_orderkey").cast("string"), 9, "0").alias("id"), F.col("o_orderdate").cast("date").alias("report_date"), F.lit("M").alias("market_name"), F.col("o_orderdate").cast("timestamp").alias("_at"), F.concat(F.lit("https://e.com/"), "o_orderkey").alias("_url"))
    proof = schema.provenance("made", F.col("_url"), F.col("_at"), "made@1").alias("provenance")
    return rss.feed_items(schema.conformed(rows.select("*", proof), "cot-reports"), "cot-reports")


@registered("SELECT 'orders' AS dataset, count(*) AS n FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem")
def q_store_counts(spark, d):
    found = store.counts({n: table(spark, d, n) for n in ("orders", "lineitem")})
    return reduce(DataFrame.unionByName, [spark.range(1).select(F.lit(n).alias("dataset"), F.lit(k).cast("long").alias("n")) for n, k in found.items()])
