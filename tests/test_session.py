from __future__ import annotations

import os

import pytest

from brambling import session


def test_spilled_tables_can_be_discarded(spark):
    table, path = session.spill(spark.range(5))
    assert table.count() == 5
    session.discard(spark, path)
    assert not os.path.exists(path.removeprefix("file:"))


def test_a_readable_folder_passes_the_check(spark, tmp_path):
    session._check_shared(spark, str(tmp_path))
    assert not [f for f in os.listdir(tmp_path) if not f.startswith(".")]


def test_an_unreadable_folder_does_not(spark, tmp_path, monkeypatch):
    class Reader:
        def text(self, path):
            return spark.createDataFrame([], "value string")

    monkeypatch.setattr(type(spark), "read", property(lambda self: Reader()))
    with pytest.raises(RuntimeError, match="executors cannot read"):
        session._check_shared(spark, str(tmp_path))


def test_which_masters_are_one_machine():
    assert session._one_machine("local[8]") and session._one_machine("local")
    assert not session._one_machine("local-cluster[2,1,1024]") and not session._one_machine("yarn")
