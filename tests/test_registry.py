"""Landed files to the store: two days of three sources, walked twice."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from docketlake.sources import registry


def land(folder, source: str, day: str, name: str, text: str) -> None:
    at = folder / "landing" / source / day
    at.mkdir(parents=True, exist_ok=True)
    (at / name).write_text(text)


def award(key: str, amount: float) -> str:
    return json.dumps({"results": [{"generated_internal_id": key, "Awarding Agency": "DOD", "Recipient Name": "Acme", "Award Amount": amount, "Start Date": "2026-01-05"}]})


@pytest.fixture
def lake(spark, tmp_path):
    land(tmp_path, "short-volume", "2026-01-05", "a.txt", "20260105|ABC|10|0|40|Q\n20260105|XYZ|x|0|1|Q\n")
    land(tmp_path, "short-volume", "2026-01-06", "a.txt", "20260106|ABC|20|0|40|Q\n")
    land(tmp_path, "contracts", "2026-01-05", "p1.json", award("G1", 5.0))
    land(tmp_path, "contracts", "2026-01-06", "p1.json", award("G1", 7.0))
    land(tmp_path, "contracts", "2026-01-06", "p2.json", award("G2", 1.0))
    gift = lambda key, who: "|".join({0: "C1", 5: "24K", 13: "01052026", 14: "250", 16: who, 21: key}.get(k, "") for k in range(22))
    for day, key in (("2026-01-05", "1"), ("2026-01-06", "2")):
        land(tmp_path, "contributions", day, "itpas2.txt", gift(key, "H1") + "\n")
        land(tmp_path, "contributions", day, "cm.txt", "C1|PAC|x\n")
        land(tmp_path, "contributions", day, "cn.txt", "H1|DOE|x\n")
    return registry.Lake(spark, f"file://{tmp_path}/store", f"file://{tmp_path}/landing")


def stored(lake):
    rows = lambda name, *cols: sorted(map(tuple, lake.table(name).read().select(*cols).collect()))
    return rows("short-volume", "id"), rows("gov-contracts", "id", "amount_usd"), rows("fec-contributions", "id", "committee_name", "candidate_name"), rows("_cursors", "source", "value")


def test_sync_twice(lake, tmp_path):
    names = ["short-volume", "contracts", "contributions"]
    assert lake.sync(names) == dict.fromkeys(names)
    found = stored(lake)
    assert found[0] == [("2026-01-05:ABC:CNMS",), ("2026-01-06:ABC:CNMS",)] and found[1] == [("G1", 7.0), ("G2", 1.0)]
    assert found[2] == [("1", "PAC", "DOE"), ("2", "PAC", "DOE")] and found[3] == [(n, "2026-01-06") for n in sorted(names)]
    runs = lake.table("_runs").read()
    assert runs.count() == 6 and runs.agg(F.sum("rejected")).first()[0] == 1
    assert lake.sync(names) == dict.fromkeys(names) and stored(lake) == found
    land(tmp_path, "contracts", "2026-01-04", "late.json", award("G3", 2.0))  # within the trailing window
    lake.sync(["contracts"])
    assert ("G3", 2.0) in stored(lake)[1] and stored(lake)[3] == found[3]


def test_a_source_that_fails_stops_no_other_and_keeps_its_cursor(lake, tmp_path):
    lake.sync(["short-volume"])
    land(tmp_path, "short-volume", "2026-01-07", "a.txt", "\n".join(f"20260107|S{k}|x|0|1|Q" for k in range(30)))
    found = lake.sync(["short-volume", "contracts"])
    assert "format may have changed" in found["short-volume"] and found["contracts"] is None
    assert dict(stored_cursors(lake)) == {"short-volume": "2026-01-06", "contracts": "2026-01-06"}
    canary = {r.source: (r.ok, r.rate) for r in lake.canary().collect()}
    assert canary["short-volume"] == (False, 0.0) and canary["contracts"] == (True, 1.0)
    assert {r.source: r.ok for r in lake.rollup().collect()} == {"short-volume": False, "contracts": True}


def stored_cursors(lake):
    return [(r.source, r.value) for r in lake.table("_cursors").read().where("key = 'day'").collect()]


def test_backfill_resumes(lake):
    first = lake.backfill("contracts", "2026-01-01", "2026-01-10", chunk_days=5, budget=1)
    assert str(first.done_until) == "2026-01-05" and first.stopped == "limit" and lake.table("gov-contracts").read().count() == 1
    second = lake.backfill("contracts", "2026-01-01", "2026-01-10", chunk_days=5)
    assert str(second.done_until) == "2026-01-10" and second.stopped is None and lake.table("gov-contracts").read().count() == 2


def test_resolve_fills_what_is_missing(lake, spark):
    lake.sync(["contracts"])
    known = spark.createDataFrame([("Acme", "ENTITY1")], "recipient_name string, recipient_uei string")
    assert lake.resolve("gov-contracts", "recipient_name", "recipient_uei", known) == 2 and lake.resolve("gov-contracts", "recipient_name", "recipient_uei", known) == 0
    assert {r.recipient_uei for r in lake.table("gov-contracts").read().collect()} == {"ENTITY1"}


def test_unknown_sources_are_refused():
    with pytest.raises(ValueError, match="nobody"):
        registry.checked(["contracts", "nobody"])
