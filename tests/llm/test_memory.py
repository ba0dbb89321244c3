"""What the Python workers of an executor hold during a task and after it."""

import re
import tracemalloc
from pathlib import Path

import pyarrow as pa
import pytest

from mktlens.llm import jaccard_join, langid
from mktlens.llm.common import giving_back
from mktlens.llm.wordhash import slices, words_of


def own_mb() -> float:
    return sum(map(int, re.findall(r"\nPss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text()))) / 1024


def test_hashing_a_batch_holds_little_at_once():
    texts = pa.array([f"word{i} of a text of seven words " * 100 for i in range(2000)])
    tracemalloc.start()
    try:
        rows = [(first, len(words_of(data, bounds, fold=True).hash)) for first, data, bounds in slices(texts)]
        _, peak = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert sum(n for _, n in rows) == 2000 * 700
    assert peak < 100e6  # 139 MB with slices of 4 MB


@pytest.mark.skipif(not Path("/proc/self/smaps_rollup").exists(), reason="memory can't be read here")
def test_a_finished_task_gives_its_memory_back():
    pins = []

    def run(batches):
        for n in batches:
            held = [bytes(1000) for _ in range(n)]
            pins.append(bytes(1000))  # lies behind them, so that the heap doesn't shrink by itself
            yield len(held)

    before = own_mb()
    assert list(giving_back(run)([100_000])) == [100_000]
    assert own_mb() - before < 30


def test_operators_before_a_stage_without_python_give_back(spark, monkeypatch):
    wrapped = []
    docs = spark.createDataFrame([(1, "a b c", "en", 5)], "doc_id long, text string, lang string, version long")
    for module in (jaccard_join, langid):
        monkeypatch.setattr(module, "giving_back", lambda run, f=giving_back: wrapped.append(run.__name__) or f(run))
    jaccard_join.features(docs, 5, 16)
    langid.with_language(docs, {"labels": [], "dims": 16384})
    assert wrapped == ["run", "predict"]
