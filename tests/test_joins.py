import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from mktlens.operators.joins import LINEAR_WIDTHS, bucketed_pairs, constant_row_join, interval_aggregate, interval_join, name_keys, null_aware_anti_join, text_keys, wildcard_join
from tests.conftest import rows, wildcard_join_nested

T = dt.datetime


@pytest.mark.parametrize("bucket", [None, 3600, 86400, (3600, 86400), (600, 3600, 86400)])
def test_interval_join_bounds(spark, bucket):
    left = spark.createDataFrame([
        (1, 1, T(2024, 1, 1), T(2024, 1, 3)),
        (2, 1, None, T(2024, 1, 3)),
        (3, 2, T(2024, 1, 1), T(2024, 1, 2)),
    ], "o int, k int, lo timestamp_ntz, hi timestamp_ntz")
    right = spark.createDataFrame([
        (1, T(2024, 1, 1), "at lower"), (1, T(2024, 1, 3), "at upper"), (1, T(2024, 1, 4), "outside"),
        (2, T(2024, 1, 1, 12), "a"), (2, T(2024, 1, 1, 13), "b"),
    ], "k int, t timestamp_ntz, what string")
    out = rows(interval_join(left, right, "k", "lo", "hi", "t", how="left", bucket_seconds=bucket), "o", "what")
    assert out == [(1, "at lower"), (1, "at upper"), (2, None), (3, "a"), (3, "b")]


def test_null_aware_anti_join(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "x int")
    plain = spark.createDataFrame([(2,)], "y int")
    with_null = spark.createDataFrame([(2,), (None,)], "y int")
    empty = spark.createDataFrame([], "y int")
    assert rows(null_aware_anti_join(left, plain, "x", "y")) == [(1,)]
    assert rows(null_aware_anti_join(left, with_null, "x", "y")) == []
    assert rows(null_aware_anti_join(left, empty, "x", "y")) == [(None,), (1,), (2,)]


def test_null_aware_anti_join_reads_the_subquery_once(spark, tmp_path):
    spark.range(100).selectExpr("id % 7 as y").write.parquet(str(tmp_path / "sub"))
    left = spark.range(10).selectExpr("id as x")
    out = null_aware_anti_join(left, spark.read.parquet(str(tmp_path / "sub")), "x", "y")
    assert rows(out) == [(7,), (8,), (9,)]
    plan = spark._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "formatted")
    final = "".join(re.findall("Final Plan ==(.*?)== Initial Plan", plan, re.S))
    assert final.count("Scan parquet") == 1 and final.count("ReusedExchange") == 1 and "NestedLoop" not in final


def test_constant_row_join_keeps_left_on_empty(spark):
    left = spark.createDataFrame([(1,), (2,)], "x int")
    empty = spark.createDataFrame([], "e string")
    assert rows(constant_row_join(left, empty)) == [(1, None), (2, None)]
    two = spark.createDataFrame([("a",), ("b",)], "e string")
    assert rows(constant_row_join(left, two)) == [(1, "a"), (1, "b"), (2, "a"), (2, "b")]


@pytest.mark.parametrize("repeat", [False, True])
def test_wildcard_join_exact_when_hashes_collide(spark, monkeypatch, repeat):
    texts = spark.createDataFrame([("red widget one",), ("a red widget",), ("blue",), ("blue",)], "t string")
    names = spark.createDataFrame([("red widget",), ("red widget",), ("blue",), ("a red w",)], "n string")
    expected = rows(wildcard_join_nested(texts, names, "t", "n"))
    monkeypatch.setattr(F, "xxhash64", lambda *c: F.lit(1).cast("bigint"))
    assert rows(wildcard_join(texts, names, "t", "n", texts_repeat=repeat)) == expected


def _random_frames(spark, seed):
    rnd = random.Random(seed)
    alphabet = "ab_ c%"
    texts = [("".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 30))),) for _ in range(80)] + [(None,)]
    names = [(i, "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 9)))) for i in range(40)] + [(99, None)]
    return (spark.createDataFrame(texts, "text string"),
            spark.createDataFrame(names, "nid int, name string"))


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("wildcards", [False, True])
@pytest.mark.parametrize("repeat", [False, True])
def test_wildcard_join_equals_nested_loop(spark, how, wildcards, repeat):
    texts, names = _random_frames(spark, len(how) * 10 + wildcards)
    fast = wildcard_join(texts.union(texts.limit(5)), names, "text", "name", how=how, q=3, wildcards=wildcards, texts_repeat=repeat)
    texts = texts.union(texts.limit(5))
    slow = wildcard_join_nested(texts, names, "text", "name", how=how, wildcards=wildcards)
    assert rows(fast, "text", "nid") == rows(slow, "text", "nid")


def test_wildcard_metacharacters(spark):
    texts = spark.createDataFrame([("axbxc",)], "text string")
    names = spark.createDataFrame([("a_b_c",)], "name string")
    assert wildcard_join(texts, names, "text", "name", how="inner").count() == 0
    assert wildcard_join(texts, names, "text", "name", how="inner", wildcards=True).count() == 1


def test_no_cartesian_or_python_in_plans(spark):
    texts, names = _random_frames(spark, 7)
    plan = wildcard_join(texts, names, "text", "name")._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_wildcard_join_plans_without_running_a_job(spark):
    """Nothing is read while the plan is built, however many names there are."""
    texts, names = _random_frames(spark, 3)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "wildcard join")
    try:
        wildcard_join(texts, names, "text", "name", wildcards=True)
        assert len(tracker.getJobIdsForGroup("planning")) == 0
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_name_is_looked_up_by_its_rarest_key(spark):
    """A word that all texts hold costs no candidates when the name has a rarer one."""
    texts = spark.createDataFrame([(f"x the usual words number{i} and more",) for i in range(300)], "text string")
    names = spark.createDataFrame([("the usual words number7 and",), ("the unusual words number8 and",)], "name string")
    keyed, needs = name_keys(names, "name", 4, False)
    held = text_keys(texts, "text", needs, keyed, 4)
    found = {r["__n"]: r["n"] for r in keyed.join(held, "__key").groupBy("__n", "__key").agg(F.count("__h").alias("n"))
             .groupBy("__n").agg(F.min("n").alias("n")).collect()}
    assert found["the usual words number7 and"] == 1
    assert rows(wildcard_join(texts, names, "text", "name", how="inner")) == [("x the usual words number7 and more", "the usual words number7 and")]


def test_a_word_of_all_texts_is_dealt_out_in_slices(spark):
    texts = spark.range(2000).select(F.concat(F.lit("buyer "), F.col("id").cast("string"), F.lit(" ltd")).alias("text"))
    names = spark.range(50).select(F.concat(F.lit("r "), F.col("id").cast("string"), F.lit(" l")).alias("name"))
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        for k, v in zip(old, ("-1", "false")):
            spark.conf.set(k, v)
        keyed, needs = name_keys(names, "name", 4, False)
        held = text_keys(texts, "text", needs, keyed, 4)
        semi = [line for line in held._jdf.queryExecution().executedPlan().toString().split("\n") if "LeftSemi" in line]
        assert len(semi) == 1 and re.search(r"Join \[__key#\d+L?, __slice#\d+L?\]", semi[0]), semi
        assert {r["__slice"] for r in held.collect()} == set(range(16))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_interval_buckets_ignore_daylight_saving(spark):
    """Wall-clock timestamps in a spring-forward gap must still meet their
    windows whatever the session time zone."""
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        left = spark.createDataFrame([(1, T(2024, 3, 10, 2, 30), T(2024, 3, 10, 3, 10))],
                                     "k int, lo timestamp_ntz, hi timestamp_ntz")
        right = spark.createDataFrame([(1, T(2024, 3, 10, 3, 0))], "k int, t timestamp_ntz")
        for bucket in (600, 3600):
            out = interval_join(left, right, "k", "lo", "hi", "t", how="inner", bucket_seconds=bucket)
            assert out.count() == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_multilevel_buckets_equal_plain(spark):
    """Windows from minutes to years, several bucket widths: same pairs as
    the plain range join."""
    rnd = random.Random(11)
    base = T(2020, 1, 1)
    left = [(rnd.randint(0, 3), i, base + dt.timedelta(minutes=rnd.randint(0, 10 ** 6)))
            for i in range(200)]
    left = [(k, i, lo, lo + dt.timedelta(minutes=rnd.choice([5, 600, 10 ** 4, 10 ** 6]))) for k, i, lo in left]
    right = [(rnd.randint(0, 3), base + dt.timedelta(minutes=rnd.randint(0, 2 * 10 ** 6)), j) for j in range(2000)]
    lf = spark.createDataFrame(left, "k int, i int, lo timestamp_ntz, hi timestamp_ntz")
    rf = spark.createDataFrame(right, "k int, t timestamp_ntz, j int")
    plain = interval_join(lf, rf, "k", "lo", "hi", "t", how="inner")
    for widths in [(3600,), (3600, 86400, 86400 * 32)]:
        fast = interval_join(lf, rf, "k", "lo", "hi", "t", how="inner", bucket_seconds=widths, max_span=8)
        assert rows(fast, "i", "j") == rows(plain, "i", "j")


@pytest.mark.parametrize("seed", ["a", "b", "c"])
def test_wildcard_join_unicode_equals_nested_loop(spark, seed):
    """Words of several scripts, combining marks and punctuation: the word
    gate and the word/gram blocking stay exact."""
    rnd = random.Random(seed)
    alphabet = ["a", "é", "é", "ß", "Ж", "ж", "中", "文", "1", " ", "-", ".", "_", "İ", "\U0001F600"]
    def word(n):
        return "".join(rnd.choice(alphabet) for _ in range(n))
    texts = [(word(rnd.randint(0, 40)),) for _ in range(80)]
    names = [(i, word(rnd.randint(1, 10))) for i in range(50)]
    # names copied out of texts, so that matches exist
    names += [(100 + i, t[0][a:a + rnd.randint(1, 12)]) for i, t in enumerate(texts[:30])
              for a in [rnd.randint(0, max(0, len(t[0]) - 1))]]
    tf = spark.createDataFrame(texts, "text string")
    nf = spark.createDataFrame(names, "nid int, name string")
    fast = wildcard_join(tf, nf, "text", "name", how="left", q=3)
    slow = wildcard_join_nested(tf, nf, "text", "name", how="left")
    assert rows(fast, "text", "nid") == rows(slow, "text", "nid")


def test_hot_key_in_one_day_meets_linear_candidates(spark):
    """A third of all rows belongs to one customer and falls into one day of
    touching windows: candidates grow with the rows, not with their square."""
    def candidates(n):
        step = dt.timedelta(seconds=86_000 // n)
        day = T(2024, 1, 1)
        left = [(0, i, day + i * step, day + (i + 1) * step) for i in range(n)]
        left += [(1 + i, i, day, day + dt.timedelta(days=40)) for i in range(2 * n)]
        right = [(0, day + i * step + dt.timedelta(seconds=3)) for i in range(n)]
        right += [(1 + i, day + dt.timedelta(hours=i % 2000)) for i in range(2 * n)]
        lf = spark.createDataFrame(left, "k int, i int, lo timestamp_ntz, hi timestamp_ntz")
        rf = spark.createDataFrame(right, "k int, t timestamp_ntz")
        pairs = bucketed_pairs(lf, rf, ["k"], "lo", "hi", "t", LINEAR_WIDTHS, 32, lf.columns).count()
        joined = interval_join(lf, rf, "k", "lo", "hi", "t", how="inner", bucket_seconds=LINEAR_WIDTHS)
        assert joined.where("k = 0").count() == n
        return pairs
    small, large = candidates(200), candidates(1600)
    assert small <= 12 * 200 and large <= 12 * 1600


def _intervals(spark, n=1200):
    """Windows and points where key 0 holds a third of both; NULLs, empty windows, years and seconds."""
    rnd = random.Random(16)
    base = dt.datetime(2024, 1, 1)
    def at(seconds):
        return base + dt.timedelta(seconds=seconds)
    left = [(None if i % 50 == 0 else 0 if i % 3 == 0 else rnd.randint(1, 20), i,
             None if i % 41 == 0 else at(s := rnd.randint(0, 10**7)), at(s + rnd.choice([-5, 0, 1, 3600, 10**5, 10**8])) if i % 41 else at(5))
            for i in range(n)]
    right = [(None if i % 60 == 0 else 0 if i % 3 == 0 else rnd.randint(1, 25),
              None if i % 43 == 0 else at(rnd.randint(0, 10**7)), rnd.randint(0, 9)) for i in range(n)]
    # each window's ends are points as well: both bounds are inclusive
    right += [(k, t, 1) for k, _, lo, hi in left[:200] for t in (lo, hi)]
    return left, right


def test_interval_aggregate_equals_brute_force(spark):
    left, right = _intervals(spark)
    l = spark.createDataFrame(left, "k int, id int, lo timestamp_ntz, hi timestamp_ntz")
    r = spark.createDataFrame(right, "k int, t timestamp_ntz, v int")
    aggs = [F.count("v").alias("n"), F.sum("v").alias("s"), F.max("t").alias("last")]
    want = []
    for k, i, lo, hi in left:
        m = [(t, v) for rk, t, v in right if k is not None and rk == k and t is not None and lo is not None and lo <= t <= hi]
        want.append((i, len(m), sum(v for _, v in m) if m else None, max(t for t, _ in m) if m else None))
    for widths in (LINEAR_WIDTHS, 3600 * 24 * 30):
        assert rows(interval_aggregate(l, r, "k", "lo", "hi", "t", aggs, widths), "id", "n", "s", "last") == sorted(want, key=lambda x: x[0])
    assert rows(interval_aggregate(l, r.limit(0), ["k"], "lo", "hi", "t", aggs), "n", "s") == [(0, None)] * len(left)
    assert interval_aggregate(l.limit(0), r, "k", "lo", "hi", "t", aggs).count() == 0


def test_interval_aggregate_evaluates_the_windows_once(spark):
    left, right = _intervals(spark, 60)
    l = spark.createDataFrame(left, "k int, id int, lo timestamp_ntz, hi timestamp_ntz").groupBy("k", "id", "lo").agg(F.max("hi").alias("hi"))
    r = spark.createDataFrame(right, "k int, t timestamp_ntz, v int")
    plan = interval_aggregate(l, r, "k", "lo", "hi", "t", [F.count("v").alias("n")])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ExistingRDD") + plan.count("LocalTableScan") == 2      # windows once, points once
    assert "LeftOuter" not in plan and "LeftAnti" not in plan and "NestedLoop" not in plan
