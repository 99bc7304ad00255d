from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from docketlake.functions import scalars as S
from docketlake.operators import aggregates, asof, feeds, filters, joins, resolve, store


def test_clamp():
    assert [filters.clamp(x) for x in (None, 0, float("nan"), -3, 1.9, 50, 9999)] == [50, 50, 50, 1, 1, 50, 500]


def test_predicates(spark, rows):
    df = spark.createDataFrame([(1, "Ann_B", ["X", "XY"], 5.0), (2, "annab", [], None), (3, None, None, 1.0)], "id int, name string, tags array<string>, v double")
    ids = lambda *parts: [r[0] for r in rows(filters.where(df, *parts).select("id"))]
    assert ids(filters.contains("name", "ANN")) == [1, 2]
    assert ids(filters.contains("name", "n_b")) == [1, 2] and ids(filters.contains("name", "a_b")) == []  # a live wildcard
    assert ids(filters.has("tags", "x")) == [1]
    assert ids(filters.any_contains("tags", "y")) == [1]
    assert ids(filters.at_least("v", 2)) == [1]
    assert ids(None, filters.equals("id", None)) == [1, 2, 3]
    assert ids(filters.any_of(filters.equals("id", 1), filters.equals("id", 3))) == [1, 3]
    assert [r.id for r in filters.listing(df, [], ["-v", "id"], 2).collect()] == [1, 3]


@pytest.fixture
def market(spark):
    prices = spark.createDataFrame(
        [("acme", "2026-01-05", 10.0, 1), ("ACME", "2026-01-05", 99.0, 2), ("ACME", "2026-01-12", 12.0, 3), ("ZERO", "2026-01-05", 0.0, 4), ("ZERO", "2026-01-12", 1.0, 5), ("FLAT", "2026-01-05", 4.0, 6), ("FLAT", "2026-01-14", 4.0, 7)],
        "ticker string, date string, close double, seq int",
    )
    events = [("hit", "ACME", "2026-01-05"), ("gap", "acme", "2026-01-03"), ("late", "ACME", "2026-01-13"), ("none", "NOPE", "2026-01-05"), ("zero", "ZERO", "2026-01-05"), ("flat", "FLAT", "2026-01-05"), ("null", None, "2026-01-05")]
    return spark.createDataFrame(events, "event_key string, ticker string, event_date string").withColumn("event_date", F.to_date("event_date")), prices


def test_backtest_one_row_an_event(market):
    found = {r.event_key: r for r in asof.backtest(*market, window_days=7).collect()}
    assert len(found) == 7
    assert found["hit"].status == "ok" and found["hit"].change_pct == pytest.approx(0.2) and not found["hit"].entry_filled
    assert found["gap"].entry["date"] == dt.date(2026, 1, 5) and found["gap"].entry_filled
    assert found["late"].reason == "entry price unavailable: no price for 'ACME' on 2026-01-13 or within 7 day(s) after"
    assert found["none"].reason == "entry price unavailable: no prices supplied for ticker 'NOPE'"
    assert found["zero"].reason == "entry price is zero" and found["zero"].change_pct is None
    assert found["flat"].change_pct == 0 and found["null"].status == "skipped"
    exact = {r.event_key: r for r in asof.backtest(*market, window_days=7, search_days=0).collect()}
    assert exact["hit"].status == "ok" and exact["flat"].reason == "exit price unavailable: no price for 'FLAT' on 2026-01-12"


def test_summaries(market):
    s = asof.backtest_summary(asof.backtest(*market, window_days=7)).first()
    assert (s.events, s.priced, s.skipped) == (7, 3, 4)
    assert s.win_rate == pytest.approx(2 / 3) and s.worst_change_pct == 0 and s.median_change_pct == pytest.approx(0.2)
    nothing = asof.return_summary(asof.event_returns(market[0].limit(0), market[1], 7)).first()
    assert nothing.events_total == 0 and nothing.mean_change_pct is None


def test_period_change_is_null_safe(spark):
    df = spark.createDataFrame(
        [("m1", None, "A", "2026-03-31", 5.0, 50.0), ("m1", None, "A", "2025-12-31", 2.0, 20.0), ("m1", "put", "A", "2026-03-31", 1.0, 9.0), ("m2", None, "B", "2026-03-31", 7.0, 70.0)],
        "manager string, put_call string, name string, period string, shares double, value double",
    ).withColumn("period", F.to_date("period"))
    found = {(r.manager, r.put_call): (r.shares_prior, r.shares_change) for r in joins.period_change(df, ["manager", "put_call"], ["name"], "period", "shares", "value").collect()}
    assert found == {("m1", None): (2.0, 3.0), ("m1", "put"): (None, None), ("m2", None): (None, None)}
    assert joins.period_change(df.limit(0), ["manager", "put_call"], ["name"], "period", "shares", "value").count() == 0


def test_upsert(spark, rows):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "id int, v string, seq int")
    new = spark.createDataFrame([(2, "c", 2), (2, "d", 3), (3, "e", 1), (1, "z", 1)], "id int, v string, seq int")
    once = store.upsert(old, new, ["id"], ["seq"])
    assert rows(once) == [(1, "z", 1), (2, "d", 3), (3, "e", 1)]
    assert rows(store.upsert(once, new, ["id"], ["seq"])) == rows(once)


def test_versioned_table(spark, rows, tmp_path):
    table = store.VersionedTable(spark, f"file://{tmp_path}/t")
    assert table.read() is None
    df = spark.createDataFrame([(1, "a", 1)], "id int, v string, seq int")
    for _ in range(2):
        table.upsert(df, ["id"], ["seq"])
        assert rows(table.read()) == [(1, "a", 1)]


def test_dump_round_trip(spark, rows, tmp_path):
    df = spark.createDataFrame([(f"k{i}", dt.date(2025 + i % 2, 1, 1 + i % 20), float(i)) for i in range(60)], "id string, day date, v double")
    store.write_shards(df, f"{tmp_path}/s", F.col("day"))
    assert sorted(p.name for p in (tmp_path / "s").iterdir() if p.is_dir()) == ["event_year=2025", "event_year=2026"]
    assert rows(store.read_dump(spark, [f"{tmp_path}/s/*"], "id string, day date, v double").select("id", "day", "v")) == rows(df)
    assert store.write_snapshot(df, f"{tmp_path}/c", F.col("day"), most=60) and not store.write_snapshot(df, f"{tmp_path}/d", F.col("day"), most=59)


def test_fill_and_first_by_sequence(spark, rows):
    df = spark.createDataFrame([("a", None), ("b", "B"), ("c", None)], "k string, v string")
    known = spark.createDataFrame([("a", "x"), ("a", "w"), ("b", "y")], "k string, v string")
    assert rows(store.fill_missing(df, known, "k", "v").select("k", "v", "filled")) == [("a", "w", True), ("b", "B", False), ("c", None, False)]
    seq = spark.createDataFrame([("p", 2, "two"), ("p", None, "none"), ("p", 1, None), ("q", None, "only")], "k string, s int, v string")
    assert rows(aggregates.first_by_sequence(seq, "k", "s", "v")) == [("p", 3, "two"), ("q", 1, "only")]


def test_feeds(spark):
    df = spark.createDataFrame([(i, "e" + str(i % 3), dt.datetime(2026, 1, 1 + i // 4)) for i in range(12)], "id int, entity string, at timestamp")
    assert [r.id for r in feeds.newest(df, "at", "id", 3).collect()] == [11, 10, 9]
    assert sorted((r.entity, r.rn) for r in feeds.entity_items(df, "entity", "at", "id", 2, 2).collect()) == [("e0", 1), ("e0", 2), ("e1", 1), ("e1", 2)]
    names = spark.createDataFrame([("k", "old", 1, 1), ("k", "first", 2, 2), ("k", "second", 2, 3)], "k string, name string, at int, seq int")
    assert feeds.latest_name(names, "k", "name", "at", "seq").first().name == "first"


def test_resolution(spark, rows):
    entries = spark.createDataFrame([(1, ["Lockheed Martin Corp"], ["LMT"]), (2, ["Apple Inc"], ["AAPL"]), (3, ["Big Sky"], ["BIG"]), (4, ["Big Sky Labs"], ["LAB"])], "entry int, names array<string>, tickers array<string>")
    names = spark.createDataFrame([("LOCKHEED MARTIN AERONAUTICS CO",), ("Apple Valley Schools",), ("Apple, Inc.",), ("Lockheed Martini Bar",), ("Big Sky Labs West",), ("Solo LLC",), (None,)], "name string")
    issuers = spark.createDataFrame([("1", "SOLO", "Solo Inc"), ("2", "TWO", "Two Co"), ("3", "TOO", "Two Corp")], "cik string, ticker string, name string")
    found = dict(rows(resolve.resolve_entities(names, entries, registrants=issuers)))
    assert found == {"LOCKHEED MARTIN AERONAUTICS CO": ["LMT"], "Apple Valley Schools": [], "Apple, Inc.": ["AAPL"], "Lockheed Martini Bar": [], "Big Sky Labs West": [], "Solo LLC": ["SOLO"]}
    with pytest.raises(ValueError, match="several entries"):
        resolve.curated_index(entries.unionByName(entries.withColumn("entry", F.col("entry") + 10)))


def test_member_matching(spark, rows):
    members = spark.createDataFrame(
        [("C1", "James", "Comer", "house"), ("W1", "Sheldon", "Whitehouse", "senate"), ("R1", "Lucia", "Ramirez-Ortega", "house"), ("S1", "Adam", "Smith", "house"), ("S2", "Jason", "Smith", "house")],
        "bioguide_id string, first_name string, last_name string, chamber string",
    )
    filed = [("Hon. James R. Comer Jr.", "house"), ("Whitehouse, Sheldon", "senate"), ("Whitehouse, Sheldon", "house"), ("Ramirez Ortega, Lucia", "house"), ("Smith", "house"), ("Smith, Jas", "house"), ("Jr.", "house")]
    found = {(a, b): c for a, b, c in rows(resolve.match_members(spark.createDataFrame(filed, "name string, chamber string"), members))}
    assert [found[k] for k in filed] == ["C1", "W1", None, "R1", None, "S2", None]


def test_scalars(spark):
    def one(c, value, kind="string"):
        return spark.createDataFrame([(value,)], f"v {kind}").select(c(F.col("v")).alias("r")).first().r

    ranges = {"$1,001 - $15,000": (1001, 15000), "Over $50,000,000": (5e7, None), "None (or less than $1,001)": (0, 1000), "$5 +": (5, None), "$1 — $2": (1, 2), "": None, "$9 - $3": None, "soon": None, None: None}
    for text, expected in ranges.items():
        found = one(S.amount_range, text)
        assert (None if found is None else tuple(found)) == expected, text
    names = {"APPLE INC /CA/": "APPLE", "Acme & Co., Inc.": "ACME AND", "INC": "INC", "Alphabet Inc. Class A": "ALPHABET", "A.B. (Holdings) LLC": "A B HOLDINGS"}
    assert {n: one(S.entity_name, n) for n in names} == names
    assert one(S.bill_references, "H.R. 12, HR 12; S.J.Res.5 and SConRes 7; hr 4, HR5, S 123456") == ["hr12", "sjres5", "sconres7"]
    assert one(S.asset_ticker, "Fund (123) (BRK.B) (12)") == "BRK.B" and one(S.asset_ticker, "none") is None
    assert one(S.any_date, "31-DEC-2025") == dt.date(2025, 12, 31) and one(S.any_date, "20260230") is None and one(S.any_date, "2026-01-02T00:00") == dt.date(2026, 1, 2)
    assert one(S.slash_date, "8/5/2026 2:00:00 PM") == dt.date(2026, 8, 5) and one(S.month_first_date, "13012026") is None
    assert one(S.link_id, "https://www.federalreserve.gov/newsevents/speech/cook20260805a.htm") == "speech/cook20260805a" and one(S.link_id, "") is None
    assert one(S.pad_cik, "00320193") == "0000320193" and one(S.parse_number, "$1,234.5") == 1234.5 and one(S.parse_number, "N/A") is None
    assert [one(S.house_side, x) for x in ("S (partial)", "P", "E", "x")] == ["sell", "buy", "exchange", None]
    assert one(lambda c: S.house_asset_type(c, S.asset_ticker(c)), "Acme Call Options [ST]") == "stock" and one(lambda c: S.house_asset_type(c, S.asset_ticker(c)), "US Treasury") == "bond"
    assert one(S.plain_number, 5000.0, "double") == "5000" and one(S.plain_number, 2.5, "double") == "2.5"
    assert S.quarters(dt.date(2025, 11, 3), dt.date(2026, 4, 1)) == [(2025, 4), (2026, 1), (2026, 2)]
    assert S.congress_of(dt.date(2026, 1, 1)) == 119 and S.election_cycle(dt.date(2025, 5, 1)) == 2026


def test_status_and_rollups(spark, rows):
    checks = spark.createDataFrame([("a", True, True), ("a", False, False), ("b", False, True), ("c", True, False)], "k string, ok boolean, hard boolean")
    assert rows(aggregates.canary_status(checks, ["k"])) == [("a", "amber"), ("b", "red"), ("c", "green")]
    assert aggregates.success_rate(checks, F.col("ok"), 0.5).first().passed
    runs = spark.createDataFrame([("s", 3, True), ("s", 4, False)], "source string, rows int, ok boolean")
    assert rows(aggregates.run_rollup(runs, ["source"])) == [("s", 7, False, True)]


def test_a_table_survives_a_crash_at_any_moment(spark, tmp_path):
    table = store.VersionedTable(spark, f"file://{tmp_path}/t")
    assert table.read() is None
    for k in range(5):
        table.upsert(spark.range(k, k + 2).select(F.col("id").cast("string"), F.lit(k).alias("at")), ["id"], ["at"])
    assert table.read().count() == 6 and len(table.versions()) <= store.VERSIONS + 1
    spark.range(1).write.parquet(f"file://{tmp_path}/t/v-00000099-broken")  # a version that was never completed
    (tmp_path / "t" / "v-00000099-broken" / "_SUCCESS").unlink()
    assert table.read().count() == 6
    table.upsert(spark.range(7, 8).select(F.col("id").cast("string"), F.lit(9).alias("at")), ["id"], ["at"])
    assert table.read().count() == 7


def test_small_files_are_replaced_in_one_step(spark, tmp_path):
    for text in ("one", "two"):
        store.write_text(spark, f"file://{tmp_path}/feed.xml", text)
        assert store.read_text(spark, f"file://{tmp_path}/feed.xml") == text
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["feed.xml"]


def test_a_period_without_rows_has_no_positions(spark):
    rows = [("m", "n", None, "2025-06-30", 5.0, 6.0), ("m", "n", None, "2025-12-31", 7.0, 8.0)]
    df = spark.createDataFrame(rows, "manager string, name string, put_call string, period string, shares double, value double").withColumn("period", F.col("period").cast("date"))
    at = lambda day: [(str(r.period_end), r.shares, r.shares_prior) for r in joins.period_change(df, ["manager", "put_call"], ["name"], "period", "shares", "value", day).collect()]
    assert at("2025-09-30") == [] and at("2025-12-31") == [("2025-12-31", 7.0, 5.0)] and at("2025-06-30") == [("2025-06-30", 5.0, None)] and at(None) == at("2025-12-31")


def test_latest_name_takes_ids_that_are_text(spark):
    df = spark.createDataFrame([("k", "late b", 2, "house:b"), ("k", "late a", 2, "house:a"), ("k", "old", 1, "house:0"), ("l", None, 5, "x")], "k string, name string, at int, id string")
    assert {r.k: r.name for r in feeds.latest_name(df, "k", "name", "at", "id").collect()} == {"k": "late a", "l": None}


def test_contributions_are_limited_after_the_candidate_is_chosen(spark):
    from docketlake import schema
    from docketlake.api import Trackers

    proof = schema.provenance("fec", F.lit("u"), F.lit("2026-01-01"), "p").alias("provenance")
    many = spark.range(700).select(F.col("id").cast("string"), F.lit("C").alias("committee_id"), F.when(F.col("id") == 0, "H1").otherwise("H2").alias("candidate_id"), F.expr("date_add(date'2024-01-01', cast(id as int))").alias("date"), F.lit("24K").alias("transaction_type"), F.lit(2024).alias("cycle"), proof)
    people = spark.createDataFrame([("H1:2024", "H1", "Ann"), ("H2:2024", "H2", "Bob")], "id string, candidate_id string, name string").select("*", F.lit(2024).alias("cycle"), proof)
    tools = Trackers(spark, {"fec-candidates": schema.conformed(people, "fec-candidates"), "fec-contributions": schema.conformed(many, "fec-contributions")})
    assert [r.id for r in tools.campaign_finance(q="ann", cycle=2024)["contributions"].collect()] == ["0"]
    assert tools.campaign_finance(q="bob")["contributions"].count() == 50 and tools.campaign_finance()["contributions"].count() == 0


def test_entity_names_and_sides(spark):
    names = {"Alphabet Inc. CL A": "ALPHABET", "Alphabet Inc-Class C": "ALPHABET", "ACME CORP /DE/": "ACME", "Co": "CO", "INC CO": "INC", "AT&T, Inc.": "AT AND T", "Co Acme Co": "CO ACME", "O'Neil (Holdings) Co., Ltd.": "O NEIL HOLDINGS", "": "", None: None}
    df = spark.createDataFrame([(k,) for k in names], "n string")
    assert {r.n: r.x for r in df.select("n", S.entity_name(F.col("n")).alias("x")).collect()} == names
    sides = {"P": "buy", "s (partial)": "sell", " E ": "exchange", "S(Partial)": "sell", "X": None, "PS": None, None: None}
    df = spark.createDataFrame([(k,) for k in sides], "n string")
    assert {r.n: r.x for r in df.select("n", S.house_side(F.col("n")).alias("x")).collect()} == sides
    kinds = {"Corporate Bond": "bond", "Stock Option": "option", "Cryptocurrency": "crypto", "Mutual Fund": "fund", "Common Stock": "stock", "Farm": "other", None: "other"}
    df = spark.createDataFrame([(k,) for k in kinds], "n string")
    assert {r.n: r.x for r in df.select("n", S.senate_asset_type(F.col("n")).alias("x")).collect()} == kinds


def test_files_of_rows(spark, tmp_path):
    files = spark.range(300).selectExpr("concat('D', id, '.html') AS name", "IF(id = 7, NULL, concat('é ', id)) AS text")
    folder = f"file://{tmp_path}/reports"
    assert store.write_files(files.limit(0), folder) == 0 and spark.read.format("binaryFile").load(folder).count() == 0
    assert store.write_files(files, folder) == store.write_files(files, folder) == 300  # again, the same files
    found = {p.name: p.read_text(encoding="utf-8") for p in (tmp_path / "reports").iterdir()}
    assert found == {f"D{i}.html": "" if i == 7 else f"é {i}" for i in range(300)}
    with pytest.raises(Exception, match="a file without a name"):
        store.write_files(spark.sql("SELECT CAST(NULL AS STRING) AS name, 'x' AS text"), folder)
