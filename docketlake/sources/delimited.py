"""Readers of delimited text: short volume, filing index, insider quarter sets, patents, campaign finance, prices
(R1, R2, R5, R11, R18, R19, F25). A line that cannot be used is kept with a reason, never guessed and never fatal."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docketlake import schema
from docketlake.functions import scalars as S
from docketlake.operators import joins

OWNERSHIP_FORMS = ("3", "4", "5", "3/A", "4/A", "5/A")
HOLDINGS_FORMS = ("13F-HR", "13F-HR/A")

# Positions of the columns used in the headerless campaign-finance files.
CANDIDATE_AT = {
    "candidate_id": 0, "name": 1, "incumbent_challenger": 2, "party": 4, "total_receipts": 5, "total_disbursements": 7, "cash_on_hand": 10,
    "state": 18, "district": 19, "coverage_end_date": 27,
}
CONTRIBUTION_AT = {"committee_id": 0, "transaction_type": 5, "date": 13, "amount_usd": 14, "candidate_id": 16, "id": 21}


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.regexp_replace("value", "\r$", "").alias("line"), F.col("_metadata.file_path").alias("file"))


def _fields(sep: str = r"\|") -> Column:
    return F.split("line", sep, -1)


def short_volume(spark: SparkSession, path: str, market: str, retrieved_at: str) -> tuple[DataFrame, DataFrame]:
    """Daily short-sale volume (R1): lines whose first field has eight digits count; volumes are numbers of 0 or more."""

    def build(lines: DataFrame) -> DataFrame:
        f = _fields()
        volume = lambda k: F.when(F.get(f, F.lit(k)).try_cast("double") >= 0, F.get(f, F.lit(k)).try_cast("double"))
        rows = lines.where(F.get(f, F.lit(0)).rlike(r"^\s*\d{8}$")).select(
            S.compact_date(F.get(f, F.lit(0))).alias("date"),
            F.upper(S.blank_to_null(F.get(f, F.lit(1)))).alias("ticker"),
            F.lit(market).alias("market"),
            volume(2).alias("short_volume"),
            volume(3).alias("short_exempt_volume"),
            volume(4).alias("total_volume"),
            schema.provenance("finra", F.col("file"), F.lit(retrieved_at), "finra-shortvol@1").alias("provenance"),
        )
        return schema.DATASETS["short-volume"].identified(rows).withColumn("short_ratio", S.short_ratio(F.col("short_volume"), F.col("total_volume")))

    return schema.split(_lines(spark, path), "short-volume", build)


def filing_index(spark: SparkSession, path: str) -> DataFrame:
    """Entries of a daily filing index (R2): five fields and a numeric CIK; the preamble falls away."""
    f = _fields()
    at = lambda k: F.trim(F.get(f, F.lit(k)))
    entries = _lines(spark, path).where((F.size(f) == 5) & at(0).rlike(r"^\d+$"))
    dated = F.coalesce(S.compact_date(at(3)), S.iso_date(at(3)))
    return entries.select(at(0).alias("cik"), at(1).alias("company_name"), at(2).alias("form_type"), dated.alias("date_filed"), at(4).alias("path"))


def is_ownership_form(c: Column) -> Column:
    return c.isin(*OWNERSHIP_FORMS)


def is_holdings_form(c: Column) -> Column:
    return c.isin(*HOLDINGS_FORMS)


def tsv(spark: SparkSession, path: str, quoted: bool) -> DataFrame:
    """A tab-separated file with header, all columns strings in lower case; quoted fields may hold tabs and newlines."""
    reader = spark.read.option("header", "true").option("sep", "\t").option("mode", "PERMISSIVE")
    reader = reader.option("quote", '"').option("escape", '"').option("multiLine", "true") if quoted else reader.option("quote", "\x00")
    df = reader.csv(path)
    return df.toDF(*[c.lower() for c in df.columns])


def insider_quarter(spark: SparkSession, folder: str, retrieved_at: str) -> tuple[DataFrame, DataFrame]:
    """Insider transactions of a quarterly set of six tables (R5, J6). The first owner is the first in the file: by the
    start of its split, then by its row there."""
    raw = {n: tsv(spark, f"{folder}/{n.upper()}.tsv", False) for n in ("submission", "reportingowner", "nonderiv_trans", "nonderiv_holding", "deriv_trans", "deriv_holding")}
    sub = raw["submission"]
    submissions = sub.select(
        F.col("accession_number").alias("accession"), F.trim("document_type").alias("form_type"), F.upper(S.blank_to_null(F.col("issuertradingsymbol"))).alias("ticker"),
        S.pad_cik(F.col("issuercik")).alias("issuer_cik"), F.col("issuername").alias("issuer_name"), S.any_date(F.col("filing_date")).alias("filed_at"),
    )
    relation = lambda word: F.coalesce(F.contains(F.lower("rptowner_relationship"), F.lit(word)), F.lit(False))
    owners = raw["reportingowner"].select(
        F.col("accession_number").alias("accession"), F.struct("_metadata.file_block_start", F.monotonically_increasing_id().alias("row")).alias("owner_seq"), F.col("rptownername").alias("name"), S.pad_cik(F.col("rptownercik")).alias("cik"),
        S.blank_to_null(F.col("rptowner_title")).alias("title"), relation("director").alias("director"), relation("officer").alias("officer"), relation("tenpercent").alias("ten_pct"),
    )

    def entries(name: str, derivative: bool, kind: str) -> DataFrame:
        df = raw[name]
        prefix = "deriv" if derivative else "nonderiv"
        sk = f"{prefix}_{'trans' if kind == 'transaction' else 'holding'}_sk"
        get = lambda c, f=lambda x: x, t="string": (f(F.col(c)) if c in df.columns and kind == "transaction" else F.lit(None)).cast(t)
        return df.select(
            F.col("accession_number").alias("accession"), F.lit(derivative).alias("derivative"), F.lit(kind).alias("kind"), F.col(sk).try_cast("bigint").alias("sk"),
            S.blank_to_null(F.col("security_title")).alias("security_title"), get("trans_date", S.any_date, "date").alias("transacted_at"), get("trans_code").alias("code"),
            get("trans_acquired_disp_cd").alias("acquired_disposed"), get("trans_shares", S.parse_number, "double").alias("shares"), get("trans_pricepershare", S.parse_number, "double").alias("price_per_share"),
            S.parse_number(F.col("shrs_ownd_folwng_trans")).alias("shares_owned_after"), F.col("direct_indirect_ownership").alias("direct_indirect"),
        )

    parts = [entries("nonderiv_trans", False, "transaction"), entries("nonderiv_holding", False, "holding"), entries("deriv_trans", True, "transaction"), entries("deriv_holding", True, "holding")]
    together = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])

    def build(rows: DataFrame) -> DataFrame:
        joined = joins.insider_rows(rows, submissions, owners)
        return joined.select(
            "id", F.col("accession").alias("accession_number"), "form_type", "ticker", "issuer_cik", "issuer_name", F.col("owner.name").alias("insider_name"), F.col("owner.cik").alias("insider_cik"),
            F.col("owner.title").alias("insider_title"), F.col("owner.director").alias("is_director"), F.col("owner.officer").alias("is_officer"), F.col("owner.ten_pct").alias("is_ten_pct_owner"),
            "transacted_at", "filed_at", "code", F.when(F.col("acquired_disposed").isin("A", "D"), F.col("acquired_disposed")).alias("acquired_disposed"),
            F.coalesce("security_title", F.lit("Unknown security")).alias("security_title"), "shares", "price_per_share", "shares_owned_after",
            F.when(F.col("direct_indirect") == "I", "indirect").otherwise("direct").alias("ownership"), F.col("derivative").alias("is_derivative"),
            schema.provenance("edgar-bulk", F.col("accession"), F.lit(retrieved_at), "edgar-bulk@1", 1.0, F.col("needs_review")).alias("provenance"),
        )

    return schema.split(together, "insider-transactions", build)


def patents(spark: SparkSession, folder: str, retrieved_at: str, tickers: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Patents from three quoted tables (R11, J5); withdrawn ones are left out. ``tickers``: (name, tickers) of organisations."""
    main, org, cpc = (tsv(spark, f"{folder}/{n}.tsv", True) for n in ("g_patent", "g_assignee_disambiguated", "g_cpc_current"))
    assignees = org.select("patent_id", F.col("assignee_sequence").try_cast("int").alias("assignee_sequence"), S.blank_to_null(F.col("disambig_assignee_organization")).alias("organization"))
    classes = cpc.select("patent_id", F.col("cpc_sequence").try_cast("int").alias("cpc_sequence"), F.col("cpc_class"))

    def build(rows: DataFrame) -> DataFrame:
        kept = rows.where(F.coalesce(F.trim("withdrawn"), F.lit("0")) != "1").select(
            S.blank_to_null(F.col("patent_id")).alias("patent_id"), S.blank_to_null(F.col("patent_title")).alias("title"), S.iso_date(F.col("patent_date")).alias("grant_date"), S.blank_to_null(F.col("wipo_kind")).alias("kind")
        )
        joined = joins.patents_joined(kept, assignees, classes)
        known = joined.withColumn("assignee_tickers", F.array().cast("array<string>"))
        if tickers is not None:
            known = joined.join(tickers.select(F.col("name").alias("assignee_name"), F.col("tickers").alias("assignee_tickers")), "assignee_name", "left")
            known = known.withColumn("assignee_tickers", F.coalesce("assignee_tickers", F.array().cast("array<string>")))
        proven = schema.provenance("patentsview", F.concat(F.lit("patent:"), "patent_id"), F.lit(retrieved_at), "patentsview@1")
        return schema.DATASETS["patents"].identified(known.withColumn("provenance", proven))

    return schema.split(main, "patents", build)


def _positions(lines: DataFrame, at: dict[str, int]) -> DataFrame:
    f = _fields()
    return lines.where(F.length("line") > 0).select("file", *[S.blank_to_null(F.get(f, F.lit(k))).alias(n) for n, k in at.items()])


def candidates(spark: SparkSession, path: str, cycle: int, retrieved_at: str) -> tuple[DataFrame, DataFrame]:
    """Campaign totals by candidate (R18): the office is the first letter of the id; a bad number is null."""

    def build(lines: DataFrame) -> DataFrame:
        rows = _positions(lines, CANDIDATE_AT).withColumn("cycle", F.lit(cycle)).withColumn("office", F.when(F.col("candidate_id").rlike("^[HSP]"), F.substring("candidate_id", 1, 1)))
        for c in ("total_receipts", "total_disbursements", "cash_on_hand"):
            rows = rows.withColumn(c, F.col(c).try_cast("double"))
        rows = rows.withColumn("coverage_end_date", S.slash_date(F.col("coverage_end_date"))).withColumn("provenance", schema.provenance("fec", F.col("file"), F.lit(retrieved_at), "fec@1"))
        return schema.DATASETS["fec-candidates"].identified(rows)

    return schema.split(_lines(spark, path), "fec-candidates", build)


def master_names(spark: SparkSession, path: str) -> DataFrame:
    """(id, name) of a master file; of repeated ids the last line by file and place wins."""
    rows = _positions(_lines(spark, path).withColumn("_at", F.monotonically_increasing_id()), {"id": 0, "name": 1})
    numbered = rows.withColumn("_at", F.monotonically_increasing_id()).where("id is not null and name is not null")
    return numbered.groupBy("id").agg(F.max_by("name", "_at").alias("name"))


def contributions(spark: SparkSession, path: str, cycle: int, retrieved_at: str, committees: DataFrame, candidate_names: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Committee contributions (R19): amounts keep their sign, a bad date is null, names come from the master files."""

    def build(lines: DataFrame) -> DataFrame:
        rows = _positions(lines, CONTRIBUTION_AT).withColumn("cycle", F.lit(cycle)).withColumn("amount_usd", F.col("amount_usd").try_cast("double")).withColumn("date", S.month_first_date(F.col("date")))
        named = rows.join(committees.select(F.col("id").alias("committee_id"), F.col("name").alias("committee_name")), "committee_id", "left")
        named = named.join(candidate_names.select(F.col("id").alias("candidate_id"), F.col("name").alias("candidate_name")), "candidate_id", "left")
        return named.withColumn("provenance", schema.provenance("fec", F.col("file"), F.lit(retrieved_at), "fec@1"))

    return schema.split(_lines(spark, path), "fec-contributions", build)


def prices(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Price points (ticker, date, close, seq) and warnings (line, raw, reason) of date,ticker,close files.

    A file is read as a whole to number its lines; a file without the header is an error. A close of zero is accepted
    (D14), and dates must exist.
    """

    def parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for name, content in zip(frame["path"], frame["content"], strict=True):
                lines = bytes(content).decode("utf-8-sig").replace("\r\n", "\n").replace("\r", "\n").split("\n")
                head = next((k for k, x in enumerate(lines) if x.strip()), len(lines))
                if head == len(lines) or [x.strip().lower() for x in lines[head].split(",")] != ["date", "ticker", "close"]:
                    raise ValueError(f"{name}: the first line must be date,ticker,close")
                rows += [(name, k + 1, x) for k, x in enumerate(lines) if k > head and x.strip()]
            yield pd.DataFrame(rows, columns=["file", "line", "raw"])

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    lines = files.mapInPandas(parse, "file string, line long, raw string")
    f = F.split("raw", ",", -1)
    at = lambda k: F.trim(F.get(f, F.lit(k)))
    day = F.when(at(0).rlike(r"^\d{4}-\d{2}-\d{2}$"), S.iso_date(at(0)))
    reason = (
        F.when(F.size(f) != 3, F.concat(F.lit("expected 3 comma-separated fields, got "), F.size(f).cast("string")))
        .when(day.isNull(), F.concat(F.lit("'"), at(0), F.lit("' is not a valid date (YYYY-MM-DD)")))
        .when(at(1) == "", "ticker is empty")
        .when(~at(2).rlike(r"^\d+(\.\d+)?$"), F.concat(F.lit("'"), at(2), F.lit("' is not a number")))
    )
    marked = lines.withColumn("reason", reason)
    good = marked.where("reason is null").select(F.upper(at(1)).alias("ticker"), day.alias("date"), at(2).cast("double").alias("close"), F.struct("file", "line").alias("seq"))
    return good, marked.where("reason is not null").select("file", "line", "raw", "reason")
