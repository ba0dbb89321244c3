import datetime as dt

from pyspark.sql import functions as F

from mktlens.functions.scalars import (days_between, earlier_of, left_chars, month_boundaries, ratio,
                                       regexp_delete, regexp_nth, strip_spaces)
from tests.conftest import rows


def test_month_boundaries(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 31), dt.date(2024, 2, 1)),
                                (dt.date(2024, 1, 31), dt.date(2023, 12, 31))], "e date, d date")
    assert rows(df.select(month_boundaries("e", "d").alias("m")), "m") == [(-1,), (1,)]


def test_days_count_midnights(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 23), dt.datetime(2024, 1, 2, 1))], "a timestamp_ntz, b timestamp_ntz")
    assert df.select(days_between("a", "b").alias("d")).first()["d"] == 1


def test_earlier_of_null_rules(spark):
    df = spark.createDataFrame([(1, 10, 8), (2, 8, 10), (3, 8, None), (4, None, 8)], "i int, a int, b int")
    out = rows(df.select("i", earlier_of("a", "b").alias("x")))
    assert out == [(1, 8), (2, 8), (3, 8), (4, None)]


def test_regexp_nth_and_delete(spark):
    df = spark.createDataFrame([("@ann @companynameuk @bob.",)], "c string")
    pat = "@([a-zA-Z0-9_.]+)"
    r = df.select(*[regexp_nth("c", pat, i).alias(f"m{i}") for i in (1, 2, 3, 4)]).first()
    assert (r.m1, r.m2, r.m3, r.m4) == ("@ann", "@companynameuk", "@bob.", None)
    assert df.select(regexp_delete(F.lit("@a@b"), "@").alias("x")).first().x == "ab"


def test_left_strip_ratio(spark):
    df = spark.createDataFrame([("2023-12-05 10:00:00", "Ann Lee", 3, 0)], "s string, n string, a int, b int")
    r = df.select(left_chars("s", 7).alias("l"), strip_spaces("n").alias("n"), ratio("a", "b").alias("r")).first()
    assert (r.l, r.n, r.r) == ("2023-12", "AnnLee", None)
