"""First occurrences come from one stream over sorted ranges, hot lines included."""

import random

from pyspark.sql import functions as F

from mktlens.llm.line_dedup import first_occurrences, line_hashes, op8_line_dedup


def _docs(spark):
    rnd = random.Random(8)
    pool = [f"line number {i} that is long enough" for i in range(40)]
    data = [(i, "\n".join(["A LINE that a third of all documents hold"] * (i % 3 == 0) + rnd.choices(pool, k=rnd.randint(0, 6)) + ["short"]))
            for i in range(400)]
    data += [(7, data[7][1]), (8, "another text of one document\n" + pool[0]), (500, None), (None, pool[1]), (501, "")]
    return spark.createDataFrame(data, "doc_id long, text string").repartition(6), data


def test_first_occurrences_equal_brute_force(spark):
    docs, data = _docs(spark)
    lines = line_hashes(docs)
    want = {(doc, line.strip().lower()) for doc, text in data if doc is not None
            for line in (text or "").split("\n") if len(line) >= 20}
    hashes = lines.sparkSession.createDataFrame([(d, k) for d, k in want], "doc_id long, key string") \
        .select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("second"), "key").alias("h2"), "doc_id")
    got = [tuple(r) for r in first_occurrences(lines).collect()]
    assert len(got) == len(want) and set(got) == {tuple(r) for r in hashes.collect()}


def test_the_stream_needs_no_exchange_but_the_ranges(spark):
    docs, _ = _docs(spark)
    plan = first_occurrences(line_hashes(docs))._jdf.queryExecution().executedPlan().toString()
    above = plan[:plan.index("Exchange rangepartitioning")]
    assert "Window" in above and "Exchange" not in above and above.count("Sort [") == 1


def test_dropped_lines_equal_brute_force(spark):
    docs, data = _docs(spark)
    holders = {}
    for doc, text in data:
        if doc is not None:
            for line in (text or "").split("\n"):
                if len(line) >= 20:
                    holders.setdefault(line.lower(), set()).add(doc)
    want = sorted((-1 if doc is None else doc, len((text or "").split("\n")),
                   sum(doc is not None and len(line) >= 20 and len(holders[line.lower()]) >= 3 and doc != max(holders[line.lower()])
                       for line in (text or "").split("\n"))) for doc, text in data)
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_lines, r.n_dropped) for r in op8_line_dedup(docs).collect())
    assert got == want
