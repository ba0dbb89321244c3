"""Top-k: the cut of the leading column changes no row and keeps few."""

import random

import pytest
from pyspark.sql import functions as F

from mktlens.operators.topk import _cut, top_k
from tests.conftest import rows


@pytest.fixture(scope="module")
def frame(spark):
    rnd = random.Random(5)
    data = [(rnd.choice([None, rnd.randint(0, 500), 3]), rnd.random(), i) for i in range(3000)]
    return spark.createDataFrame(data, "a int, b double, id int"), data


def order():
    return [F.col("a").asc_nulls_last(), "b", "id"]


@pytest.mark.parametrize("k", [0, 1, 10, 800, 1500, 2900, 5000])
def test_equals_sorting(frame, k):
    df, data = frame
    want = sorted(data, key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2]))[:k]
    for lead in (None, "a"):
        got = [tuple(r) for r in top_k(df, order(), k, lead).collect()]
        assert got == want


def test_cut_keeps_rows_in_proportion_to_k(spark):
    df = spark.range(200_000).select((F.col("id") * 7919 % 200_000).alias("a"))
    for k in (10, 300, 9_000):
        kept = df.where(F.col("a") <= _cut(df, "a", k)).count()
        assert k <= kept <= 3 * k + 100


def test_dates_empty_tables_and_all_null(spark):
    df = spark.createDataFrame([("2024-01-02",), ("2024-01-01",), (None,)], "d string").select(F.to_date("d").alias("d"))
    assert [str(r.d) for r in top_k(df, [F.col("d").asc_nulls_last()], 3, "d").collect()] == ["2024-01-01", "2024-01-02", "None"]
    assert rows(top_k(df.limit(0), ["d"], 3, "d")) == []
    assert top_k(df.where("d is null"), [F.col("d").asc_nulls_last()], 3, "d").count() == 1
