"""Skew-tolerant sequencing equals the plain windows, including a hot key."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from mktlens.operators import windows
from mktlens.operators.joins import interval_join
from mktlens.operators.windows import lag_by_sequence, min_by_key, row_number_by
from tests.conftest import rows


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(3)
    base = dt.datetime(2024, 1, 1)
    data = []
    for i in range(3000):
        k = 0 if i % 3 == 0 else rnd.randint(1, 50)          # key 0 holds a third of the rows
        ts = None if i % 97 == 0 else base + dt.timedelta(minutes=rnd.randint(0, 60 * 24 * 20))
        data.append((k, ts, i))
    data.append((None, base, 10_000))
    data.append((None, base, 10_001))
    return spark.createDataFrame(data, "k int, ts timestamp_ntz, id int")


def test_row_number_by_matches_window(spark, skewed):
    plain = row_number_by(skewed, ["k"], ["ts", "id"], "rn")
    for bucket in (F.date_trunc("hour", "ts"), F.to_date("ts")):
        fast = row_number_by(skewed, ["k"], ["ts", "id"], "rn", bucket=bucket)
        assert rows(fast, "id", "rn") == rows(plain, "id", "rn")


def test_lag_and_min_match_window(spark, skewed, monkeypatch):
    numbered = row_number_by(skewed, ["k"], ["ts", "id"], "rn")
    monkeypatch.setattr(windows, "SLICE", 64)    # several slices of the hot key
    safe = lag_by_sequence(numbered, ["k"], "rn", {"prev_id": "id"})
    plain = numbered.withColumn("prev_id", F.lag("id").over(Window.partitionBy("k").orderBy("rn")))
    assert rows(safe, "id", "prev_id") == rows(plain, "id", "prev_id")
    a = min_by_key(skewed, ["k"], "ts", "first")
    b = skewed.withColumn("first", F.when(F.col("k").isNotNull(), F.min("ts").over(Window.partitionBy("k"))))
    assert rows(a, "id", "first") == rows(b, "id", "first")


def test_interval_left_join_without_key_keeps_bag(spark):
    T = dt.datetime
    left = spark.createDataFrame([
        (1, T(2024, 1, 1), T(2024, 1, 3)), (1, T(2024, 1, 1), T(2024, 1, 3)),   # duplicate rows
        (1, T(2024, 2, 1), T(2024, 2, 2)), (2, None, T(2024, 1, 3)),
    ], "k int, lo timestamp_ntz, hi timestamp_ntz")
    right = spark.createDataFrame([(1, T(2024, 1, 2), "a"), (1, T(2024, 1, 2, 5), "b")], "k int, t timestamp_ntz, v string")
    fast = interval_join(left, right, "k", "lo", "hi", "t", how="left", bucket_seconds=3600)
    slow = interval_join(left, right, "k", "lo", "hi", "t", how="left")
    assert rows(fast, "k", "lo", "v") == rows(slow, "k", "lo", "v")
    assert len(rows(fast)) == 6


def test_hot_key_is_split_after_min_by_key(spark):
    """A customer with most of the rows: the join's task with that customer is
    split, and the aggregation after it begins in each part."""
    old = {k: spark.conf.get(k, None) for k in (
        "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.shuffle.partitions",
        "spark.sql.adaptive.coalescePartitions.enabled")}
    for k, v in zip(old, ("-1", "64k", "64k", "32", "false")):
        spark.conf.set(k, v)
    try:
        df = spark.range(60_000, numPartitions=20).selectExpr("if(id % 3 < 2, 0, id) as c", "id as d", "sha2(string(id), 256) as pad")
        joined = min_by_key(df, ["c"], "d", "first")
        tasks = [r[1] for r in joined.groupBy(F.spark_partition_id()).agg(F.count("first"), F.max("pad")).collect()]
        assert sum(tasks) == 60_000 and max(tasks) < 12_000
        total = joined.groupBy("c").agg(F.sum("d").alias("s"), F.min("first").alias("f"))
        assert total.count() == 20_001 and total.where("c = 0").first()["f"] == 0
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
