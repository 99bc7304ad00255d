"""The shared folder."""

from __future__ import annotations

from pathlib import Path

import pytest

from docketlake.llm import common


def test_written_tables_live_in_the_shared_folder_until_discarded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(common, "GIVEN", [])
    monkeypatch.setattr(common, "shared_dir", lambda _: f"file://{tmp_path}/shared")
    table = common.written(spark.range(5).toDF("x"), "numbers")
    assert table.count() == 5 and [p.name.split("-")[0] for p in Path(f"{tmp_path}/shared").iterdir() if p.is_dir()] == ["numbers"]
    common.discard(spark)
    assert [p for p in Path(f"{tmp_path}/shared").iterdir() if p.is_dir()] == []


class Unset:
    """A session that names no folder."""

    def __init__(self, spark):
        self.sparkContext, self.conf = spark.sparkContext, self

    def get(self, _, default):
        return default


def test_an_unset_folder_is_made_once(spark):
    found = common.shared_dir(Unset(spark))
    assert found == common.shared_dir(Unset(spark)) and found.startswith("file:///")


def test_a_path_without_scheme_is_qualified(spark):
    named = Unset(spark)
    named.get = lambda *_: "/tmp/some/folder/"
    assert common.shared_dir(named) == "file:///tmp/some/folder"


def test_an_unset_folder_is_an_error_on_a_cluster():
    class Cluster(Unset):
        def __init__(self):
            self.sparkContext, self.conf, self.master, self.applicationId = self, self, "spark://host:7077", "app"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.shared_dir(Cluster())
