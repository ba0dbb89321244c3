"""Merkle manifest against a plain recursion over lists."""

import hashlib
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from mktlens.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, rank long, digest string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])


def climb(nodes, fan):
    """(root, for every leaf its steps (before, after))."""
    steps, place = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i:i + fan] for i in range(0, len(nodes), fan)]
        for k, p in enumerate(place):
            run, d = runs[p // fan], p % fan
            steps[k].append(("".join(run[:d]), "".join(run[d + 1:])))
            place[k] = p // fan
        nodes = [h(*r) for r in runs]
    return nodes[0], steps


def expected(rows, fan):
    by = {}
    for r in rows:
        by.setdefault(r[2], []).append(r)
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    own = {}
    for lang in langs:
        by[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r[0], r[3], r[2], r[4], r[1])))
        own[lang] = climb([leaf(r[0], r[3], r[2], r[4], r[1]) for r in by[lang]], fan)
    root, over = climb([own[lang][0] for lang in langs], fan)
    out = []
    for k, lang in enumerate(langs):
        for r, low in zip(by[lang], own[lang][1]):
            steps = low + over[k]
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[4] is not None
            node = leaf(r[0], r[3], r[2], r[4] + tampered if r[4] is not None else None, r[1])
            for b, a in steps:
                node = h(b, node, a)
            out.append((r[0], leaf(r[0], r[3], r[2], r[4], r[1]), own[lang][0], root, h(*[b + a for b, a in steps]), node, node == root))
    return out


def rows(n):
    langs = ["en", "en", "en", None, "é", "z", "Z"]
    return [(i if i % 31 else None, ("x" * (i % 5) + "é") if i % 11 else None, langs[i % 7] if i < n - 1 else "lone",
             f"s{i % 3}" if i % 13 else None, i if i % 4 else None) for i in range(n)]


@pytest.mark.parametrize("fan, levels, n", [(2, 3, 120), (2, 12, 33), (3, 2, 75)])
def test_equals_recursion(spark, fan, levels, n):
    data = rows(n)
    docs = spark.createDataFrame([(*r, "clash", -1, "clash") for r in data], SCHEMA)
    shown = merkle.proofs(*merkle.manifest(docs, fan, levels, rows_per_part=16))
    out = shown.select("doc_id", F.col("reached").alias("leaf"), "subroot", "root",
                       F.sha2(F.array_join(F.transform(F.arrays_zip("before", "after"), lambda s: F.concat(s["before"], s["after"])), ""), 256).alias("p"),
                       merkle.folded(F.coalesce("tampered", "reached"), F.col("before"), F.col("after")).alias("f"))
    got = [(*r, r.f == r.root) for r in out.collect()]
    assert sorted(got, key=repr) == sorted(expected(data, fan), key=repr)


def test_every_untampered_leaf_verifies_and_every_tampered_one_fails(spark):
    docs = spark.createDataFrame([(*r, "", 0, "") for r in rows(60)], SCHEMA)
    for r in merkle.op11_merkle_manifest(docs).collect():
        touched = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 0 and r.doc_id % 4 != 0
        assert r.verified != touched


def test_repeated_rows_are_leaves_of_their_own(spark):
    data = [(5, "a", "en", "s", 1)] * 20 + [(None, None, None, None, None)] * 9
    docs = spark.createDataFrame([(*r, "", 0, "") for r in data], SCHEMA)
    shown = merkle.proofs(*merkle.manifest(docs, 2, 2, rows_per_part=4))
    got = shown.select("doc_id", "reached", "subroot", "root").collect()
    assert sorted([tuple(r) for r in got], key=repr) == sorted([e[:4] for e in expected(data, 2)], key=repr)


def test_one_row_and_no_rows(spark):
    one = spark.createDataFrame([(1, "a" * 3_000_000, "en", "s", 1, "", 0, "")], SCHEMA)
    r, = merkle.op11_merkle_manifest(one).collect()
    assert r.leaf == r.subroot == r.root == r.folded_root and r.verified and r.proof_sha256 == h()
    assert merkle.op11_merkle_manifest(one.limit(0)).count() == 0


def test_records_are_addressed_by_their_content(spark):
    docs = spark.createDataFrame([(*r, "", 0, "") for r in rows(90)], SCHEMA)
    tree, _ = merkle.manifest(docs, 2, 3, rows_per_part=32)
    for bundle in tree.bundles:
        for r in bundle.collect():
            assert all(x.digest == h(*x.children) for x in r.records) and r.address in {x.digest for x in r.records}


def test_sql_agrees_on_nulls(spark):
    data = rows(40)
    docs = spark.createDataFrame([(*r, "", 0, "") for r in data], SCHEMA)
    documents = docs.select("doc_id", "text", "lang", "source", "n_chars").toPandas().astype(
        {"doc_id": "Int64", "n_chars": "Int64"})  # noqa: F841  read by DuckDB
    con = duckdb.connect()
    con.register("documents", documents)
    cur = con.execute(merkle.OP11_SQL)
    cols = [c[0] for c in cur.description]
    want = sorted(cur.fetchall(), key=repr)
    got = sorted([tuple(r) for r in merkle.op11_merkle_manifest(docs).select(*cols).collect()], key=repr)
    assert got == want
