from __future__ import annotations

import datetime as dt
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from docketlake import schema
from docketlake.api import TOOLS, Trackers
from docketlake.operators import feeds as rss
from docketlake.sources import delimited, documents, feeds
from docketlake.streaming import incremental

AT = "2026-08-20 12:00:00"


def put(folder, name, text):
    path = folder / name
    path.write_bytes(text if isinstance(text, bytes) else text.encode("utf-8"))
    return f"file://{path}"


def test_registry(spark):
    assert len(schema.DATASETS) == 18 and len(TOOLS) == 24
    for d in schema.DATASETS.values():
        assert d.empty(spark).select(d.event_date()).count() == 0
    assert set(rss.titles()) == set(schema.DATASETS)


def test_short_volume(spark, tmp_path):
    text = "Date|Symbol|ShortVolume|ShortExemptVolume|TotalVolume|Market\r\n20260105|abc|10|0|40|Q\r\n20260105|ZZZ|0|0|0|Q\r\n20260105|BAD|x|0|1|Q\r\n3\r\n"
    good, bad = delimited.short_volume(spark, put(tmp_path, "f.txt", text), "CNMS", AT)
    found = {r.ticker: (r.id, r.short_ratio) for r in good.collect()}
    assert found == {"ABC": ("2026-01-05:ABC:CNMS", 0.25), "ZZZ": ("2026-01-05:ZZZ:CNMS", None)}
    assert [r.reasons for r in bad.collect()] == [["short_volume is missing"]]


def test_filing_index(spark, tmp_path):
    text = "Description: index\n \nCIK|Company Name|Form Type|Date Filed|Filename\n-----\n123|Acme Inc|4|20260105|a/b.txt\n45|B|13F-HR|2026-01-06|c.txt\nx|y|z|w|v\n"
    df = delimited.filing_index(spark, put(tmp_path, "i.idx", text))
    assert [(r.cik, str(r.date_filed)) for r in df.orderBy("cik").collect()] == [("123", "2026-01-05"), ("45", "2026-01-06")]
    assert [r.cik for r in df.where(delimited.is_ownership_form(F.col("form_type"))).collect()] == ["123"]
    assert [r.cik for r in df.where(delimited.is_holdings_form(F.col("form_type"))).collect()] == ["45"]


def test_insider_quarter(spark, tmp_path):
    files = {
        "SUBMISSION": "ACCESSION_NUMBER\tFILING_DATE\tDOCUMENT_TYPE\tISSUERCIK\tISSUERNAME\tISSUERTRADINGSYMBOL\nA1\t05-JAN-2026\t4\t99\tAcme\tacm\n",
        "REPORTINGOWNER": "ACCESSION_NUMBER\tRPTOWNERCIK\tRPTOWNERNAME\tRPTOWNER_RELATIONSHIP\tRPTOWNER_TITLE\nA1\t7\tDoe Jane\tDirector,Officer\tCEO\nA1\t8\tRoe\tTenPercentOwner\t\n",
        "NONDERIV_TRANS": "ACCESSION_NUMBER\tNONDERIV_TRANS_SK\tSECURITY_TITLE\tTRANS_DATE\tTRANS_CODE\tTRANS_SHARES\tTRANS_PRICEPERSHARE\tTRANS_ACQUIRED_DISP_CD\tSHRS_OWND_FOLWNG_TRANS\tDIRECT_INDIRECT_OWNERSHIP\nA1\t20\tCommon\t02-JAN-2026\tP\t1,000\t2.5\tA\t5000\tD\nA1\t10\t\"Common\t01-JAN-2026\tS\t5\t\tD\t1\tI\nZZ\t1\tCommon\t01-JAN-2026\tS\t5\t1\tD\t1\tD\n",
        "NONDERIV_HOLDING": "ACCESSION_NUMBER\tNONDERIV_HOLDING_SK\tSECURITY_TITLE\tSHRS_OWND_FOLWNG_TRANS\tDIRECT_INDIRECT_OWNERSHIP\nA1\t1\tCommon\t44\tD\n",
        "DERIV_TRANS": "ACCESSION_NUMBER\tDERIV_TRANS_SK\tSECURITY_TITLE\tTRANS_DATE\tTRANS_CODE\tTRANS_SHARES\tTRANS_PRICEPERSHARE\tTRANS_ACQUIRED_DISP_CD\tSHRS_OWND_FOLWNG_TRANS\tDIRECT_INDIRECT_OWNERSHIP\n",
        "DERIV_HOLDING": "ACCESSION_NUMBER\tDERIV_HOLDING_SK\tSECURITY_TITLE\tSHRS_OWND_FOLWNG_TRANS\tDIRECT_INDIRECT_OWNERSHIP\n",
    }
    for name, text in files.items():
        put(tmp_path, f"{name}.tsv", text)
    good, bad = delimited.insider_quarter(spark, f"file://{tmp_path}", AT)
    found = {r.id: r for r in good.collect()}
    assert set(found) == {"A1:nd:0", "A1:nd:1", "A1:nd:2"} and bad.count() == 0
    assert found["A1:nd:0"].code == "S" and found["A1:nd:1"].shares == 1000 and found["A1:nd:2"].code is None
    assert found["A1:nd:0"].security_title == '"Common' and found["A1:nd:0"].ownership == "indirect"
    assert found["A1:nd:0"].insider_name == "Doe Jane" and found["A1:nd:0"].provenance.needs_review and found["A1:nd:0"].is_officer and not found["A1:nd:0"].is_ten_pct_owner


def test_patents(spark, tmp_path):
    put(tmp_path, "g_patent.tsv", '"patent_id"\t"patent_date"\t"patent_title"\t"wipo_kind"\t"withdrawn"\n"1"\t"2026-01-06"\t"A ""quoted""\ttitle\nin two lines"\t"B2"\t"0"\n"2"\t"2026-01-06"\t"Gone"\t""\t"1"\n"3"\t"2026-01-06"\t"Bare"\t""\t"0"\n')
    put(tmp_path, "g_assignee_disambiguated.tsv", '"patent_id"\t"assignee_sequence"\t"disambig_assignee_organization"\n"1"\t"0"\t""\n"1"\t"2"\t"Late Co"\n"1"\t"1"\t"Early Co"\n')
    put(tmp_path, "g_cpc_current.tsv", '"patent_id"\t"cpc_sequence"\t"cpc_class"\n"1"\t"0"\t""\n"1"\t"1"\t"h04"\n')
    good, bad = delimited.patents(spark, f"file://{tmp_path}", AT, spark.createDataFrame([("Early Co", ["ERL"])], "name string, tickers array<string>"))
    found = {r.id: r for r in good.collect()}
    assert set(found) == {"1", "3"} and bad.count() == 0
    assert (found["1"].assignee_name, found["1"].assignee_count, found["1"].cpc_class, found["1"].assignee_tickers) == ("Early Co", 3, "H04", ["ERL"])
    assert found["1"].title == 'A "quoted"\ttitle\nin two lines' and found["3"].assignee_count == 0


def test_campaign_finance(spark, tmp_path):
    line = lambda n, **at: "|".join(at.get(f"c{i}", "") for i in range(n))
    totals = put(tmp_path, "weball.txt", "\n".join([line(30, c0="H1AB", c1="DOE, J", c4="DEM", c5="10.5", c7="x", c27="03/31/2026"), line(30, c0="X9", c1="NO")]))
    good, bad = delimited.candidates(spark, totals, 2026, AT)
    r = good.first()
    assert (r.id, r.office, r.total_receipts, r.total_disbursements, str(r.coverage_end_date)) == ("H1AB:2026", "H", 10.5, None, "2026-03-31")
    assert [b.reasons for b in bad.collect()] == [["office is missing"]]
    gifts = put(tmp_path, "itpas2.txt", "\n".join([line(22, c0="C1", c5="24K", c13="01052026", c14="-250", c16="H1AB", c21="77"), line(22, c0="C9", c5="24K", c13="", c14="5", c16="S2", c21="78"), line(22, c0="C1", c14="9")]))
    names = delimited.master_names(spark, put(tmp_path, "cm.txt", "C1|OLD|x\nC1|NEW|x\n|nobody\n"))
    good, bad = delimited.contributions(spark, gifts, 2026, AT, names, spark.createDataFrame([("H1AB", "DOE")], "id string, name string"))
    found = {r.id: (r.committee_name, r.candidate_name, r.amount_usd, r.date) for r in good.collect()}
    assert found == {"77": ("NEW", "DOE", -250.0, dt.date(2026, 1, 5)), "78": (None, None, 5.0, None)} and bad.count() == 1


def test_prices(spark, tmp_path):
    path = put(tmp_path, "p.csv", "\n Date , ticker,CLOSE\n2026-01-05,acm,41.90\n2026-02-30,ACM,1\n2026-01-06,,1\n2026-01-06,ACM,-1\n2026-01-06,ACM,0\na,b\n")
    good, warnings = delimited.prices(spark, path)
    assert [(r.ticker, str(r.date), r.close) for r in good.orderBy("date").collect()] == [("ACM", "2026-01-05", 41.9), ("ACM", "2026-01-06", 0.0)]
    assert [(w.line, w.reason) for w in warnings.orderBy("line").collect()] == [
        (4, "'2026-02-30' is not a valid date (YYYY-MM-DD)"), (5, "ticker is empty"), (6, "'-1' is not a number"), (8, "expected 3 comma-separated fields, got 2"),
    ]
    with pytest.raises(Exception, match="the first line must be"):
        delimited.prices(spark, put(tmp_path, "q.csv", "a,b,c\n"))[0].collect()


def test_json_feeds(spark, tmp_path):
    award = {"generated_internal_id": "G1", "Awarding Agency": "DOD", "Recipient Name": "Acme", "Award Amount": None, "Base Obligation Date": "bad", "Start Date": "2026-01-05"}
    path = put(tmp_path, "a.json", json.dumps({"results": [award, award | {"generated_internal_id": "G2", "Recipient Name": " "}]}))
    good, bad = feeds.awards(spark, path, AT, resolved=spark.createDataFrame([("Acme", ["ACM"])], "name string, tickers array<string>"))
    assert [(r.id, str(r.action_date), r.amount_usd, r.recipient_tickers) for r in good.collect()] == [("G1", "2026-01-05", None, ["ACM"])] and bad.first().reasons == ["recipient_name is missing"]

    acts = [{"general_issue_code": "TAX", "description": "H.R. 5 and"}, {"general_issue_code": "TAX", "description": "S. 7"}, {"general_issue_code": None, "description": " "}]
    filing = {"filing_uuid": "U", "filing_year": 2026, "filing_period": "Q1", "income": None, "expenses": "0.00", "registrant": {"name": "R"}, "client": {"name": "C"}, "lobbying_activities": acts}
    r = feeds.lobbying(spark, put(tmp_path, "l.json", json.dumps({"results": [filing]})), AT)[0].first()
    assert (r.amount_usd, r.issues, r.bill_references) == (0.0, ["TAX"], ["hr5", "s7"])

    study = {"protocolSection": {"identificationModule": {"nctId": "NCT1", "briefTitle": "T"}, "statusModule": {"overallStatus": "OPEN", "startDateStruct": {"date": "2026-01"}, "lastUpdatePostDateStruct": {"date": "2026-01-05"}}, "sponsorCollaboratorsModule": {"leadSponsor": {"name": "S"}}, "designModule": {"phases": ["P1", "P2"]}}}
    r = feeds.studies(spark, put(tmp_path, "s.json", json.dumps({"studies": [study]})), AT)[0].first()
    assert (r.phase, r.start_date, r.conditions) == ("P1/P2", "2026-01", [])

    subs = [{"submission_type": "ORIG", "submission_number": "1", "submission_status_date": d} for d in ("20260105", "20250105", "2026")]
    drug = {"application_number": "NDA1", "sponsor_name": "S", "openfda": {"brand_name": ["B", "C"]}, "submissions": subs}
    good, bad = feeds.drug_applications(spark, put(tmp_path, "d.json", json.dumps({"results": [drug]})), AT, since="2026-01-01")
    assert [(r.id, r.brand_name) for r in good.collect()] == [("NDA1:ORIG:1", "B")] and bad.count() == 1

    cot = {"report_date_as_yyyy_mm_dd": "2026-01-06T00:00", "cftc_contract_market_code": "1", "market_and_exchange_names": "M"} | {c: "1,000" for c in feeds.COUNT_FIELDS.values()}
    good, bad = feeds.positioning(spark, put(tmp_path, "c.json", json.dumps([cot, cot | {"open_interest_all": "-"}])), AT)
    assert good.first().open_interest == 1000 and bad.count() == 1

    views = [{"project": "en", "article": "A", "timestamp": t, "views": v} for t, v in (("2026010500", 5), ("2026013200", 5), ("2026010501", 5), ("2026010600", "x"))] + [{"project": "en", "article": "B", "timestamp": "2026010500", "views": 1}]
    articles = spark.createDataFrame([("en", "A", ["T"])], "project string, article string, tickers array<string>")
    good, bad = feeds.pageviews(spark, put(tmp_path, "w.json", json.dumps({"items": views})), AT, articles)
    assert [(r.id, r.views) for r in good.collect()] == [("en:A:2026-01-05", 5)] and bad.count() == 4

    items = [{"d": "8/5/2026 2:00 PM", "t": "FOMC statement", "pt": "Monetary Policy", "l": "/newsevents/pressreleases/x.htm"}, {"d": "8/5/2026", "t": "Else", "pt": "Other", "l": "/y"}, {"d": "?", "t": "T", "pt": "Monetary Policy", "l": "/z"}]
    good, bad = feeds.fed_items(spark, put(tmp_path, "f.json", "﻿" + json.dumps(items)), AT)
    r = good.first()
    assert (good.count(), r.id, r.type, str(r.date), r.url) == (1, "pressreleases/x", "statement", "2026-08-05", "https://www.federalreserve.gov/newsevents/pressreleases/x.htm") and bad.count() == 1


FORM = """<SEC-HEADER>
ACCESSION NUMBER: 0001-26-1
FILED AS OF DATE: 20260106
COMPANY CONFORMED NAME: Big Fund
CENTRAL INDEX KEY: 0000000042
CONFORMED PERIOD OF REPORT: {period}
</SEC-HEADER>
<XML>
{xml}
</XML>
"""


def test_ownership_form(spark, tmp_path):
    owner = "<reportingOwner><reportingOwnerId><rptOwnerCik>7</rptOwnerCik><rptOwnerName>Doe</rptOwnerName></reportingOwnerId><reportingOwnerRelationship><isDirector>1</isDirector></reportingOwnerRelationship></reportingOwner>"
    deal = "<nonDerivativeTransaction><securityTitle><value>Common</value></securityTitle><transactionDate><value>2026-01-05-05:00</value></transactionDate><transactionCoding><transactionCode>P</transactionCode></transactionCoding><transactionAmounts><transactionShares><value>1,000</value></transactionShares><transactionAcquiredDisposedCode><value>A</value></transactionAcquiredDisposedCode></transactionAmounts></nonDerivativeTransaction>"
    held = "<derivativeHolding><ownershipNature><directOrIndirectOwnership><value>I</value></directOrIndirectOwnership></ownershipNature></derivativeHolding>"
    xml = f"<ownershipDocument><documentType>4</documentType><issuer><issuerCik>9</issuerCik><issuerName>Acme</issuerName><issuerTradingSymbol>none</issuerTradingSymbol></issuer>{owner}{owner}<nonDerivativeTable>{deal}</nonDerivativeTable><derivativeTable>{held}</derivativeTable></ownershipDocument>"
    put(tmp_path, "a.txt", FORM.format(period="20251231", xml=xml))
    put(tmp_path, "b.txt", "no form at all")
    good, bad, errors = documents.ownership_forms(spark, f"file://{tmp_path}/*.txt", AT)
    found = {r.id: r for r in good.collect()}
    assert set(found) == {"0001-26-1:nd:0", "0001-26-1:d:0"} and bad.count() == 0 and errors.count() == 1
    r = found["0001-26-1:nd:0"]
    assert (r.ticker, r.issuer_cik, r.shares, str(r.transacted_at), str(r.filed_at), r.is_director, r.provenance.needs_review) == (None, "0000000009", 1000.0, "2026-01-05", "2026-01-06", True, True)
    assert found["0001-26-1:d:0"].security_title == "Unknown security" and found["0001-26-1:d:0"].ownership == "indirect"


def test_holdings_report(spark, tmp_path):
    row = "<infoTable><nameOfIssuer>Acme</nameOfIssuer><cusip>C1</cusip><value>5</value><shrsOrPrnAmt><sshPrnamt>10</sshPrnamt><sshPrnamtType>sh</sshPrnamtType></shrsOrPrnAmt><putCall>Put</putCall></infoTable>"
    table = f'<informationTable xmlns="urn:x">{row}</informationTable>'
    for name, period in (("old", "20220930"), ("new", "20230331")):
        put(tmp_path, f"{name}.txt", FORM.format(period=period, xml=table).replace("0001-26-1", name))
    put(tmp_path, "bad.txt", FORM.format(period="20230331", xml=table.replace("<cusip>C1</cusip>", "")))
    good, _, errors = documents.holdings_reports(spark, f"file://{tmp_path}/*.txt", AT)
    assert {r.id: (r.value_usd, r.share_type, r.put_call) for r in good.collect()} == {"old:0": (5000.0, "SH", "put"), "new:0": (5.0, "SH", "put")} and errors.count() == 1


def test_trade_reports(spark, tmp_path):
    cells = lambda tag, *values: "<tr>" + "".join(f"<{tag}>{v}</{tag}>" for v in values) + "</tr>"
    head = cells("th", "#", "Transaction Date", "Owner", "Ticker", "Asset Name", "Asset Type", "Type", "Amount")
    body = cells("td", "1", "01/05/2026", "Spouse", "acm", "Acme <b>Inc</b>", "Stock", "Sale (Full)", "$1,001 - $15,000") + cells("td", "2", "01/06/2026", "--", "--", "Note", "Corporate Bond", "Purchase", "Unknown")
    (tmp_path / "s").mkdir()
    put(tmp_path / "s", "D1.html", f"<table><tr><td>x</td></tr></table><table><thead>{head}</thead><tbody>{body}</tbody></table>")
    filings = spark.createDataFrame([("D1", "Doe", None, None, None, dt.date(2026, 1, 9))], "doc_id string, member_name string, bioguide_id string, party string, state string, filed_at date")
    good, bad, errors = documents.senate_reports(spark, f"file://{tmp_path}/s/*", filings, AT)
    found = {r.id: (r.ticker, r.side, r.asset_type, r.owner, r.amount_min, r.amount_max, r.provenance.needs_review) for r in good.collect()}
    assert found == {"senate:D1:0": ("ACM", "sell", "stock", "spouse", 1001.0, 15000.0, False), "senate:D1:1": (None, "buy", "bond", None, 0.0, None, True)} and bad.count() == errors.count() == 0

    at = lambda y, *words: [{"text": t, "x": x, "y": y, "page": 1} for t, x in words]
    items = at(700, ("ID", 10), ("Owner", 50), ("Asset", 100), ("Transaction", 200), ("Date", 260), ("Notification", 310), ("Amount", 380))
    items += at(680, ("SP", 50), ("Acme Corp", 100), ("S (partial)", 200), ("01/05/2026", 260), ("$1,001 -", 380)) + at(668, ("(ACM) [ST]", 99), ("$15,000", 380)) + at(650, ("Filing Status: New", 100))
    items += at(640, ("QQ", 50), ("Fund", 100), ("X", 200), ("01/06/2026", 260), ("Over $5", 380))
    (tmp_path / "h").mkdir()
    put(tmp_path / "h", "D1.json", json.dumps(items))
    good, bad, _ = documents.house_reports(spark, f"file://{tmp_path}/h/*", filings, AT)
    r = good.first()
    assert (r.id, r.asset_description, r.ticker, r.asset_type, r.side, r.amount_max, r.owner) == ("house:D1:0", "Acme Corp (ACM) [ST]", "ACM", "stock", "sell", 15000.0, "spouse")
    assert bad.first().reasons == ["side is missing"]


def test_line_clustering_is_anchored():
    item = lambda y: {"page": 1, "x": 0, "y": y, "text": str(y)}
    assert [[i["y"] for i in line] for line in documents.text_lines([item(10), item(8), item(6)])] == [[10, 8], [6]]


def test_committees():
    seats = documents.committee_seats(
        [{"thomas_id": "SSAS", "name": "Armed", "type": "senate", "subcommittees": [{"thomas_id": "14", "name": "Sea"}]}, {"thomas_id": "JSEC", "name": "Joint", "type": "joint"}],
        {"SSAS": [{"name": "A", "bioguide": "A1", "rank": 1, "title": "Chair"}], "SSAS14": [{"name": "A", "bioguide": "A1"}], "SSAS99": [{"name": "A", "bioguide": "A1"}], "JSEC": [{"name": "B", "bioguide": "B1"}], "XXXX": [{"name": "C", "bioguide": "C1"}]},
    )
    assert [(s["subcommittee_key"], s["subcommittee_name"], s["chamber"]) for s in seats] == [(None, None, "senate"), ("14", "Sea", "senate"), ("99", None, "senate"), (None, None, None)]


def test_bills_and_hearings(spark, tmp_path):
    bill = "<billStatus><bill><number>12</number><type>HR</type><congress>119</congress><introducedDate>2026-01-05</introducedDate><titles><item><title>Other</title></item></titles><title>Real</title><cosponsors><item/><item/></cosponsors><sponsors><item><bioguideId>A1</bioguideId><fullName>Ann</fullName></item></sponsors></bill></billStatus>"
    put(tmp_path, "BILLSTATUS-119hr12.xml", bill)
    put(tmp_path, "BILLSTATUS-119hr13.xml", bill)
    good, _, errors = documents.bills(spark, f"file://{tmp_path}/BILL*", AT)
    r = good.first()
    assert (r.id, r.title, r.cosponsor_count, r.sponsor_bioguide_id, r.latest_action_date) == ("119-hr-12", "Real", 2, "A1", None) and errors.count() == 1
    mods = '<mods xmlns="urn:m"><titleInfo><title>On things</title></titleInfo><originInfo><dateIssued>2026-02-01</dateIssued></originInfo><extension><accessId>CHRG-119hhrg1</accessId><chamber>JOINT</chamber><congCommittee authorityId="x"><name type="authority-short">Short</name><name type="authority-standard">Long</name></congCommittee><congMember bioGuideId="A1"/><congMember bioGuideId="A1"/><witness>W. Itness</witness></extension><relatedItem><titleInfo><title>Part</title></titleInfo><extension><heldDate>2020-01-01</heldDate></extension></relatedItem></mods>'
    put(tmp_path, "CHRG-119hhrg1-mods.xml", mods)
    r = documents.hearings(spark, f"file://{tmp_path}/CHRG*", AT)[0].first()
    assert (r.id, r.chamber, str(r.held_date), r.congress, [c.name for c in r.committees], r.witnesses, r.member_bioguide_ids) == ("CHRG-119hhrg1", None, "2026-02-01", 119, ["Long"], ["W. Itness"], ["A1"])


def test_archives(spark, rows, tmp_path):
    with zipfile.ZipFile(tmp_path / "z.zip", "w") as z:
        z.writestr("dir/data.txt", "a|1\r\nb|2\n")
        z.writestr("other.csv", "x")
    assert rows(documents.zip_members(spark, f"file://{tmp_path}/z.zip", r"data\.txt").select("line_no", "line")) == [(0, "a|1"), (1, "b|2")]
    put(tmp_path, "map.xml", '<urlset xmlns="u"><url><loc>https://e/1</loc><lastmod>2026-01-05</lastmod></url></urlset>')
    assert documents.sitemap(spark, f"file://{tmp_path}/map.xml")[0].first().url == "https://e/1"


def test_tools(spark):
    proven = (("s", "http://x", dt.datetime(2026, 1, 1), "p", 1.0, False),)
    trade = lambda i, member, ticker, side, day: (f"t{i}", "house", "D", i, member, "A1", "D", "CA", dt.date(2026, 1, 9), day, ticker, "Asset", "stock", side, 1.0, None, "Over $1", None, *proven)
    trades = [trade(1, "Ann Bell", "ACM", "buy", dt.date(2026, 1, 2)), trade(2, "Ann Bell", "ACM", "sell", dt.date(2026, 1, 3)), trade(3, "Cy Dee", None, "buy", dt.date(2026, 1, 4))]
    seats = [("s1", "A1", "Ann Bell", "house", "HSAG", "Agriculture", "house", None, None, 1, "Chair", *proven), ("s2", "A1", "Ann Bell", "house", "HSAG", "Agriculture", "house", "01", "Corn", 2, None, *proven)]
    tables = {"congress-trades": spark.createDataFrame(trades, schema.DATASETS["congress-trades"].schema), "committee-assignments": spark.createDataFrame(seats, schema.DATASETS["committee-assignments"].schema)}
    t = Trackers(spark, tables)
    assert [r.id for r in t.congress_trades(ticker="acm").collect()] == ["t2", "t1"]
    assert t.congress_trades(limit=1).first().citation == "http://x"
    roster = t.committees("agri").first()
    assert (roster.trades, roster.subcommittees, roster.title) == (3, ["Corn"], "Chair")
    profile = t.member_profile("bell")
    assert profile["member"].first().bioguide_id == "A1" and profile["stats"].first().buys == 1 and profile["committees"].first().title == "Chair"
    found = t.search("acm", spark.createDataFrame([("ACM", "Acme")], "ticker string, name string")).collect()
    assert [(r.kind, r.dataset, r.rows) for r in found] == [("ticker", "congress-trades", 2)]
    assert {r.dataset: r.stale for r in t.freshness("2026-01-02 00:00:00").collect()}["congress-trades"] is False
    assert t.insider_summary("ACM", "2026-01-05")["open_market"].first().net == 0
    assert [r.title for r in t.titles("congress-trades", 1).collect()] == ["Cy Dee (house) buy: Asset — Over $1"]
    assert t.trade_events().count() == 2
    with pytest.raises(ValueError, match="not a date"):
        t.patents(since="soon")
    for name in ("insider_trades", "gov_contracts", "gov_grants", "lobbying", "patents", "clinical_trials", "fda_approvals", "cot", "wiki_pageviews", "congress_hearings", "fed_communications", "fec_contributions"):
        assert getattr(t, name)().count() == 0


def test_cursor_and_backfill():
    cursor = incremental.Cursor("cftc", "last", "2026-01-10", 7)
    assert cursor.start("2020-01-01") == "2026-01-03" and cursor.advanced("2026-01-09", True) == cursor
    assert cursor.advanced("2026-02-01", False) == cursor and cursor.advanced("2026-02-01", True).value == "2026-02-01"
    walked: list = []

    def walk(a, b):
        walked.append((a, b))
        if len(walked) == 2:
            raise OSError("upstream")
        return 10

    job = incremental.Backfill(dt.date(2026, 1, 1), dt.date(2026, 3, 15), budget=15).run(walk)
    assert job.stopped == "limit" and job.done_until == dt.date(2026, 3, 1) and len(walked) == 3 and len(job.log) == 1
    total = lambda a, b: (b - a).days + 1
    parts = incremental.bisected(dt.date(2026, 1, 1), dt.date(2026, 1, 10), total, 3)
    assert sum(total(*p) for p in parts) == 10 and max(total(*p) for p in parts) <= 3


def test_stream_upsert_and_drift(spark, rows, tmp_path):
    from docketlake.operators.store import VersionedTable

    df = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 1)], "id int, v string, seq int")
    df.write.parquet(f"{tmp_path}/in")
    table = VersionedTable(spark, f"file://{tmp_path}/t")
    for _ in range(2):
        incremental.upsert_stream(incremental.file_stream(spark, f"{tmp_path}/in", df.schema, pattern="*.parquet"), table, ["id"], ["seq"], f"{tmp_path}/ck").awaitTermination()
    assert rows(table.read()) == [(1, "b", 2), (2, "c", 1)]
    assert incremental.check_drift(df, F.col("v") == "a", lambda d: d.collect())["succeeded"] == 1
    with pytest.raises(ValueError, match="none of 3"):
        incremental.check_drift(df, F.lit(False), lambda d: d.collect(), at_least=3)


def test_senate_reports_with_an_unknown_side_are_unreadable(spark, tmp_path):
    head = "".join(f"<th>{h}</th>" for h in ("#", "Transaction Date", "Owner", "Ticker", "Asset Name", "Asset Type", "Type", "Amount"))
    row = lambda side: f"<tr><td>1</td><td>01/05/2026</td><td>Self</td><td>ACM</td><td>Acme</td><td>Stock</td><td>{side}</td><td>$1,001 - $15,000</td></tr>"
    for name, side in (("D1", "Purchase"), ("D2", "Received")):
        put(tmp_path, f"{name}.html", f"<table><tr>{head}</tr>{row('Sale (Full)')}{row(side)}</table>")
    filings = spark.createDataFrame([(d, "Doe", "B1", "X", "NY", dt.date(2026, 1, 9)) for d in ("D1", "D2")], "doc_id string, member_name string, bioguide_id string, party string, state string, filed_at date")
    good, bad, errors = documents.senate_reports(spark, f"file://{tmp_path}/*", filings, AT)
    assert {(r.id, r.side, r.provenance.confidence) for r in good.collect()} == {("senate:D1:0", "sell", 0.9), ("senate:D1:1", "buy", 0.9)}
    assert bad.count() == 0 and "is no side" in errors.first().error
