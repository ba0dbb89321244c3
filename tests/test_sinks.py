"""Sinks: view, create-table-as (whole or not at all)."""

import os

import pytest
from pyspark.sql import functions as F

from mktlens.plans import paid, spend
from mktlens.sources.sinks import ctas_sink, view_sink
from mktlens.sources.tables import Tables
from tests.conftest import SF_SMALL, rows


def test_view_sink(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    out = view_sink(df, "mktlens_test_view")
    assert rows(out) == [(1, "a"), (2, "b")]
    assert rows(spark.sql("select v from mktlens_test_view where k = 2")) == [("b",)]


def test_ctas_sink_fails_when_target_exists(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "k int")
    path = str(tmp_path / "t")
    assert rows(ctas_sink(df, path)) == [(1,)]
    with pytest.raises(FileExistsError):
        ctas_sink(df, path)
    assert os.listdir(tmp_path) == ["t"]


def test_ctas_sink_leaves_nothing_behind_when_the_write_fails(spark, tmp_path):
    bad = spark.range(10).select(F.expr("cast(concat('x', id) as int)").alias("k"))
    with pytest.raises(Exception):
        ctas_sink(bad, str(tmp_path / "t"))
    assert os.listdir(tmp_path) == []


def test_ctas_sink_never_replaces_a_table_made_meanwhile(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([(1,)], "k int")
    path = tmp_path / "t"
    write = type(df.write).parquet

    def slow_write(self, to, *a, **k):
        write(self, to, *a, **k)
        path.mkdir()
        (path / "theirs").write_text("x")

    monkeypatch.setattr(type(df.write), "parquet", slow_write)
    with pytest.raises(Exception):
        ctas_sink(df, str(path))
    assert os.listdir(tmp_path) == ["t"] and os.listdir(path) == ["theirs"]


def test_ctas_sink_partitions(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, p string")
    assert rows(ctas_sink(df, str(tmp_path / "t"), ["p"]).select("k", "p")) == [(1, "a"), (2, "b")]
    assert {"p=a", "p=b"} <= set(os.listdir(tmp_path / "t"))


@pytest.mark.parametrize("plan", [spend.spend_attribution_plan, paid.paid_ad_attribution])
def test_plans_as_tables(spark, tmp_path, plan):
    made = plan(Tables(spark, SF_SMALL))
    kept = ctas_sink(made, str(tmp_path / "t"))
    assert kept.columns == made.columns and kept.exceptAll(made).count() == 0 and made.exceptAll(kept).count() == 0
