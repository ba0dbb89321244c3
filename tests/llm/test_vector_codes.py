"""Product codes against plain loops over Python integers."""

import hashlib
import math

import numpy as np
import pytest

from mktlens.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<double>, label int, code string, slice int"


def cut(v, parts):
    return [tuple(v[s]) for s in vc.cuts(len(v), parts)]


def nearest(x, book):
    return min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(book))


def expected(rows, parts=4, entries=256, rounds=4):
    kept = [(i, [math.floor(x) * 1024 if abs(x) >= 2.0**60 else math.floor(x * 1024) for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    books, out = {}, []
    for n in {len(v) for _, v, _ in kept}:
        own = [(i, v) for i, v, _ in kept if len(v) == n]
        first = {}
        for i, v in own:
            if i is not None:
                first[i] = min(first.get(i, v), v)
        start = [first[i] for i in sorted(first)[:entries]] or [[0] * n]
        for p in range(parts):
            book = [cut(v, parts)[p] for v in start]
            for _ in range(rounds):
                groups = {}
                for _, v in own:
                    groups.setdefault(nearest(cut(v, parts)[p], book)[1], []).append(cut(v, parts)[p])
                book = [tuple(sum(c) // len(groups[e]) for c in zip(*groups[e])) if e in groups else book[e] for e in range(len(book))]
            books[n, p] = book
    for i, v, label in kept:
        best = [nearest(x, books[len(v), p]) for p, x in enumerate(cut(v, parts))]
        text = ",".join(str(c) for p in range(parts) for e in books[len(v), p] for c in e)
        out.append([i, "".join(f"{e:02x}" for _, e in best), min(sum(d for d, _ in best), vc.MOST), label, hashlib.sha256(text.encode()).hexdigest()])
    total = {}
    for r in out:
        total[r[3]] = min(total.get(r[3], 0) + r[2], vc.MOST)
    return sorted([(r[0], r[1], r[2], total[r[3]], r[4]) for r in out], key=repr)


def run(spark, rows):
    df = spark.createDataFrame([(i, v, label, "clash", 3) for i, v, label in rows], SCHEMA)
    return sorted([tuple(r) for r in vc.op13_vector_codes(df).select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()], key=repr)


def vectors(n, dims, seed=1, spread=0.05):
    rng = np.random.default_rng(seed)
    return [[float(x) for x in rng.normal(0, spread, dims).round(2)] for _ in range(n)]


def test_equals_loops(spark):
    rows = [(i, v, (0, 1, None)[i % 3]) for i, v in enumerate(vectors(420, 8))]
    assert run(spark, rows) == expected(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, v, i % 2) for i, v in enumerate(vectors(40, 8))]
    rows += [(100, None, 0), (101, [0.1, None] + [0.0] * 6, 0), (102, [nan] * 8, 0), (103, [inf] + [0.0] * 7, 1),
             (None, vectors(1, 8, 9)[0], 0), (3, rows[3][1], 1), (3, vectors(1, 8, 7)[0], None), (200, [], 5), (201, [0.5], 5),
             (202, [-0.3, 0.7, 1.1, -2.2, 0.01], None), (203, [-0.0] * 8, 0), (204, [0.0] * 8, 0)]
    assert run(spark, rows) == expected(rows)


def test_very_large_components(spark):
    rows = [(i, [x * 10.0 ** (3 * i) for x in v], 0) for i, v in enumerate(vectors(12, 4, spread=1))]
    assert run(spark, rows) == expected(rows)


def test_ties_copies_and_no_rows(spark):
    rows = [(i, [0.5, 0.5, 0.25, 0.25], 1) for i in range(50)] + [(60, [0.0] * 4, 1)]
    assert run(spark, rows) == expected(rows)
    assert run(spark, []) == []


@pytest.mark.parametrize("width", [1, 3, 512])
def test_trie_walk_equals_all_pairs(width):
    rng = np.random.default_rng(3)
    parts, _ = vc.distinct_rows(rng.integers(-3, 4, (700, 5)).astype(float))
    book = rng.integers(-4, 5, (37, 5))
    entry, distance = vc.nearest(vc.integers(parts), book, width)
    full = ((parts[:, None, :].astype(np.int64) - book[None]) ** 2).sum(2)
    assert (entry == full.argmin(1)).all() and (distance == full.min(1)).all()
