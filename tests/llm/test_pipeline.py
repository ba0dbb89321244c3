"""The corpus pipeline, stage by stage, against brute force on a small table."""

import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LETTER = re.compile(r"[^\W\d_]")
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def shared_lines_dropped(docs):
    """{doc_id: text} after every frequent line is left to its last holder."""
    key = lambda line: lower(line.strip(" \t\n\v\f\r"))
    holders = {}
    for i, text in docs.items():
        for line in (text or "").split("\n"):
            if len(key(line)) >= 20:
                holders.setdefault(key(line), set()).add(i)
    gone = {k: max(h) for k, h in holders.items() if len(h) >= 3}
    out = {}
    for i, text in docs.items():
        lines = (text or "").split("\n")
        kept = [x for x in lines if gone.get(key(x), i) == i]
        out[i] = text if len(kept) == len(lines) else "\n".join(kept)
    return out


def smallest_of_each_class(docs):
    sets, holders = {}, {}
    for i, text in docs.items():
        w = WORD.findall(lower(text or ""))
        sets[i] = {tuple(w[j:j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
        for s in sets[i]:
            holders.setdefault(s, []).append(i)
    root = {i: i for i in docs}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in docs:
        for j, common in Counter(j for s in sets[i] for j in holders[s] if j > i).items():
            if 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i for i in docs if find(i) == i}


def targets(sizes):
    """{source: words}: 150 % of all words by weight, none above twice its size."""
    weight = dict(zip(sorted(sizes, key=lambda s: (s is None, s or "")), [5, 2, 1] * len(sizes)))
    left, out = 1.5 * sum(sizes.values()), {}
    while True:
        free = [s for s in sizes if s not in out]
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 2 * sizes[s]]
        if not over:
            return {**out, **share}
        for s in over:
            out[s] = 2 * sizes[s]
            left -= out[s]


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    """The table, the output of each stage reread from Parquet, and its folder."""
    folder = tmp_path_factory.mktemp("pipeline")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(*COLUMNS)
    edge = [(900_001, None, "en", "s", 0), (900_002, "", None, None, 0), (900_003, "12 34 -", "en", "s", 7),
            (900_004, "two words", None, None, 9)]
    docs.union(spark.createDataFrame(edge, docs.schema)).write.parquet(f"{folder}/documents.parquet")
    tables = [spark.read.parquet(f"{folder}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, tables[-1], str(folder)).write.parquet(f"{folder}/out_{name}")
        tables.append(spark.read.parquet(f"{folder}/out_{name}"))
    return tables, str(folder)


def test_stages_keep_the_columns(staged):
    tables, _ = staged
    assert all(t.columns == COLUMNS for t in tables[:-1])


def test_filtering_stages_equal_brute_force(staged):
    start, known, lines, single = ({r.doc_id: r.text for r in t.collect()} for t in staged[0][:4])
    assert known == {i: t for i, t in start.items() if t and LETTER.search(t)}
    assert lines == shared_lines_dropped(known)
    assert single == {i: lines[i] for i in smallest_of_each_class(lines)}


def test_missing_languages_are_predicted(spark, staged):
    start, known = ({r.doc_id: r for r in t.collect()} for t in staged[0][:2])
    assert all(r.lang == (start[i].lang or r.lang) and r.lang for i, r in known.items())
    assert start[900_004].lang is None and known[900_004].lang in {r.lang for r in start.values()}
    # labels taken away come back
    own = {i: r.lang for i, r in start.items() if r.lang and r.text and len(r.text) > 200}
    gone = [i for i in sorted(own) if i % 5 == 0]
    docs = staged[0][0].withColumn("lang", F.when(~F.col("doc_id").isin(gone), F.col("lang")))
    found = {r.doc_id: r.lang for r in corpus_pipeline.known_language(spark, docs, staged[1]).collect()}
    assert len(gone) > 5 and np.mean([found[i] == own[i] for i in gone]) > 0.9
    plan = corpus_pipeline.known_language(spark, docs, staged[1])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_mixture_meets_the_targets(staged):
    before, after = staged[0][3].collect(), staged[0][4].collect()
    size = lambda r: len(WORD.findall(r.text or ""))
    own = {r.doc_id: WORD.findall(r.text or "") for r in before}
    sizes, taken, drawn = Counter(), Counter(), Counter()
    for r in before:
        sizes[r.source] += size(r)
    for r in after:
        taken[r.source] += size(r)
        drawn[r.doc_id] += size(r)
        assert WORD.findall(r.text) == own[r.doc_id][:size(r)]
    assert all(n <= 2 * len(own[i]) for i, n in drawn.items())
    for source, words in targets({s: n for s, n in sizes.items()}).items():
        assert abs(taken[source] - words) <= 3


def test_packing_holds_every_token_of_the_mixture(staged):
    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {}
    for r in staged[0][4].collect():
        ids.setdefault(r.doc_id, []).append(np.array([*exact.encode(r.text, add_special_tokens=False).ids, 0], "<u4"))
    packed, rows = Counter(), {}
    for p in staged[0][5].collect():
        packed[p.doc_id] += p.length
        assert any(zlib.crc32(x[p.start:p.start + p.length].tobytes()) == p.ids_crc32 for x in ids[p.doc_id])
        rows.setdefault(p.sequence_id, []).append((p.offset, p.length))
    assert packed == {i: sum(map(len, copies)) for i, copies in ids.items()}
    for pieces in rows.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 1024


def test_run_applies_all_stages(spark, staged):
    tables, folder = staged
    total = lambda df: sorted((r.doc_id, r.doc_tokens, r.length) for r in df.collect())
    per_doc = lambda rows: {(i, n): sum(x[2] for x in rows if x[:2] == (i, n)) for i, n, _ in rows}
    assert per_doc(total(corpus_pipeline.run(spark, folder))) == per_doc(total(tables[-1]))
