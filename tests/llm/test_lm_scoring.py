"""Language-model scores against counts in dictionaries, and the tries on their own."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from mktlens.llm import elias_fano as ef
from mktlens.llm import lm_scoring as lm

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, block long, learn boolean, trie long"
SMALL = dict(block_bytes=2_000, grams_per_trie=300, words_per_range=100)


def tokens(text):
    folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(folded) + ["\n"]


def out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


class Model:
    """Interpolated absolute discounting over add-one unigrams."""

    def __init__(self, rows):
        self.uni, self.bi, self.tri = Counter(), Counter(), Counter()
        for i, t in rows:
            if i is not None and not out(i):
                s = ["", "", *tokens(t)]
                for k in range(2, len(s)):
                    self.uni[s[k]] += 1
                    self.bi[s[k - 1], s[k]] += 1
                    self.tri[s[k - 2], s[k - 1], s[k]] += 1
        self.n, self.v = sum(self.uni.values()), len(self.uni)
        self.after, self.kinds = Counter(), Counter()
        for gram, c in [*self.bi.items(), *self.tri.items()]:
            self.after[gram[:-1]] += c
            self.kinds[gram[:-1]] += 1

    def p(self, *gram):
        if len(gram) == 1:
            return (self.uni[gram[0]] + 1) / (self.n + self.v + 1)
        total, shorter = self.after[gram[:-1]], self.p(*gram[1:])
        if not total:
            return shorter
        c = (self.bi if len(gram) == 2 else self.tri)[gram]
        return max(c - lm.DISCOUNT, 0) / total + lm.DISCOUNT * self.kinds[gram[:-1]] / total * shorter


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(2)
    vocabulary, share = [f"w{i}" for i in range(200)], 1 / np.arange(1, 201)
    texts = [" ".join(rng.choice(vocabulary, n, p=share / share.sum())) for n in rng.integers(1, 60, 150)]
    # one passage that very many texts hold, capitals, nulls, empty texts, a text without spaces, repeats of an id
    data = [(i, t + (" The SAME passage again and again" if i % 3 else "")) for i, t in enumerate(texts)]
    return data + [(900, None), (901, ""), (902, " \n\t"), (None, texts[0]), (5, texts[9]), (5, texts[9]), (903, "é" * 5000), (904, "q " * 9000)]


def frame(spark, data):
    return spark.createDataFrame([(i, t, "en", 7, True, 8) for i, t in data], SCHEMA)


@pytest.mark.parametrize("sizes", [SMALL, {}])
def test_scores_equal_counts(spark, rows, sizes):
    model = Model(rows)
    want = []
    for i, t in rows:
        w = tokens(t)
        s = ["", "", *w]
        want.append((i, out(i), len(w), sum(model.uni[x] > 0 for x in w), model.n, sum(math.log10(model.p(x)) for x in w),
                     sum(math.log10(model.p(*s[k - 2:k + 1])) for k in range(2, len(s)))))
    got = [tuple(r) for r in lm.score(frame(spark, rows), **sizes).collect()]
    order = lambda r: (r[0] is None, r[0] or 0, r[2], round(r[6], 1))
    assert len(got) == len(want)
    for g, w in zip(sorted(got, key=order), sorted(want, key=order)):
        assert g[:5] == w[:5] and g[5] == pytest.approx(w[5], abs=1e-6)
        # a token's score is a sum of three codes at most, each off by half a step
        assert abs(g[6] - w[6]) <= 1.5 * w[2] / lm.STEP + 1e-6


def test_size_of_blocks_and_tries_changes_no_score(spark, rows):
    a, b = ({(r.doc_id, r.n_tokens): r.score for r in lm.score(frame(spark, rows), **s).collect()} for s in (SMALL, {}))
    assert a == b


def test_nothing_to_learn_from_and_no_rows(spark):
    r, = lm.score(frame(spark, [(None, "a b c")])).collect()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) == (4, 0, 0, 0.0, 0.0)
    assert lm.score(frame(spark, [])).count() == 0


def test_held_out_texts_are_likelier_than_under_the_base(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = lm.op12_lm_scoring(docs).where("held_out").agg({"score": "sum", "base_score": "sum"}).first()
    assert held["sum(score)"] > held["sum(base_score)"]


def test_stored_tries_can_be_mapped(spark, rows, tmp_path):
    for k, r in enumerate(lm.tries(frame(spark, rows), **SMALL).collect()):
        path = tmp_path / str(k)
        path.write_bytes(r["data"])
        trie = lm.Trie(ef.mapped(str(path)))
        one = trie.ids.at(np.arange(trie.ids.size)).astype(np.int64)
        # every context word is found, with no word of id 0 after it
        assert (trie.codes(one, np.full(len(one), 1 << 40), np.zeros(len(one), np.int64), np.zeros(len(one), np.uint16)) == trie.left).all()


@pytest.mark.parametrize("n, top", [(0, 1), (1, 1), (5, 3), (70_000, 90_000), (70_000, 1 << 50)])
def test_sequences(n, top):
    values = np.sort(np.random.default_rng(n).integers(0, top, n)).astype(np.uint64)
    s = ef.Sequence(ef.read(ef.write(ef.as_sequence(values))))
    assert (s.at(np.arange(n)) == values).all()
    asked = np.sort(np.random.default_rng(1).integers(0, top + 5, 1000)).astype(np.uint64)
    assert (s.successor(asked) == np.searchsorted(values, asked)).all()


def test_children_are_found_in_their_own_context_only():
    parent, ids = np.array([0, 0, 2, 2, 2]), np.array([3, 9, 0, 3, 4])
    level = ef.Level("x", ef.read(ef.write(ef.Level.arrays("x", 4, parent, ids))))
    asked = [(p, i) for p in range(4) for i in range(12)]
    found = level.find(np.array([p for p, _ in asked]), np.array([i for _, i in asked]))
    have = {(p, i): k for k, (p, i) in enumerate(zip(parent, ids))}
    assert list(found) == [have.get(x, -1) for x in asked]
