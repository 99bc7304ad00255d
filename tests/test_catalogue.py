from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from docketlake.api import Trackers
from docketlake.plans import catalogue, listings
from tests.oracle import connect, same

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query_matches_its_sql(spark, con, name):
    df = catalogue.QUERIES[name](spark, SF)
    if name in catalogue.ORACLES:
        same(df, con, catalogue.ORACLES[name])
    else:
        assert df.count() > 0


def test_gaps_are_filled_for_every_user(spark):
    folder = "/root/testdata/sf0.01"
    con = connect(folder)
    [(users,)] = con.sql("SELECT count(DISTINCT user_id) FROM events").fetchall()
    found = [q(spark, folder) for name, q in catalogue.QUERIES.items() if name.startswith("q_series_gap_fill")]
    assert users > 40 and max(df.count() for df in found) == 10 * users
    same(catalogue.QUERIES["q_series_gap_fill_all"](spark, folder), con, catalogue.ORACLES["q_series_gap_fill_all"])


def test_entry_gives_the_flagship_query(spark):
    assert entry.entry(spark).count() == 1


@pytest.mark.parametrize("name", ["q_backtest_rows", "q_13f_holders_delta", "q_committee_roster", "q_min_by_sequence"])
def test_no_nested_loops(spark, name):
    plan = catalogue.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_filters_reach_the_scan(spark):
    plan = catalogue.QUERIES["q_insider_min_value"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in plan and "In(l_returnflag" in plan and "l_tax" not in plan


def test_reports_are_written_on_executors(spark, con, monkeypatch):
    def once_a_report(*_):
        raise AssertionError("the driver writes a report")

    monkeypatch.setattr(catalogue.store, "write_text", once_a_report)
    name = "q_read_senate_reports"
    same(catalogue.QUERIES[name](spark, SF), con, catalogue.ORACLES[name])


def test_an_hour_is_measured_in_fractions_of_seconds(spark, tmp_path):
    times = ["00:00:00.100000", "00:59:59.100000", "00:59:59.100001", "00:59:59.900000"]  # 3599 s after the first, and a little more
    rows = ", ".join(f"({n}, TIMESTAMP '2024-01-01 {t}', {user})" for user, of in enumerate((times, times[:2], [times[0], times[2]], [times[0], times[3]])) for n, t in enumerate(of))
    duckdb.sql(f"COPY (SELECT * FROM (VALUES {rows}, (9, NULL, 1), (10, NULL, 1), (11, NULL, NULL)) x(event_id, ts, user_id)) TO '{tmp_path}/events.parquet'")
    found = catalogue.QUERIES["q_rolling_grants"](spark, str(tmp_path))
    assert {r.user_id: r.most_in_an_hour for r in found.collect()} == {0: 3, 1: 2, 2: 1, 3: 1, None: 1}
    same(found, connect(str(tmp_path)), catalogue.ORACLES["q_rolling_grants"])


@pytest.mark.parametrize("tool, dataset", [("cot", "cot-reports"), ("wiki_pageviews", "wiki-pageviews")])
def test_ids_settle_ties_of_a_listing(spark, tool, dataset):
    same_keys = listings.made(spark, SF, dataset).where("id % 105 = 1").withColumns({"report_date" if tool == "cot" else "day": F.lit("1996-01-01").cast("date")})
    ids = sorted(r.id for r in same_keys.select("id").collect())
    for rows in (same_keys.orderBy("id"), same_keys.orderBy(F.desc("id"))):  # however the rows lie
        found = getattr(Trackers(spark, {dataset: rows.repartitionByRange(4, F.rand(7))}), tool)(limit=5)
        assert len(ids) > 10 and [r.id for r in found.collect()] == ids[:5]


def test_pageviews_beyond_the_limit_are_the_first_by_id(spark):
    folder, name = "/root/testdata/sf0.1", "q_wiki_pageviews"  # 1937 rows pass; at smaller sizes the limit cuts none
    settled = catalogue.ORACLES[name].replace(" LIMIT 500", ", id LIMIT 500")
    found = [tuple(r) for r in catalogue.QUERIES[name](spark, folder).collect()]
    assert len(found) == 500 and found == connect(folder).sql(settled).fetchall()


def test_reports_beyond_the_limit_are_the_first_by_id(spark):
    folder, name = "/root/testdata/sf0.1", "q_cot"  # 1880 rows pass; at smaller sizes the limit cuts none
    settled = catalogue.ORACLES[name].replace(" LIMIT 500", ", id LIMIT 500")
    found = [tuple(r) for r in catalogue.QUERIES[name](spark, folder).collect()]
    assert len(found) == 500 and found == connect(folder).sql(settled).fetchall()
