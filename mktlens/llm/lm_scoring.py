"""Language-model scoring with n-gram tries of Elias-Fano sequences.

Method: a trigram model with interpolated absolute discounting over add-one unigrams.  Its
n-grams stand in tries (see ``elias_fano``): contexts are paths from the last word backwards,
each with pointers to its successors; successors' ids ascend relative to their context and
are found by successor search; log probabilities and the weights left to shorter contexts are
quantised to ``STEP`` parts of a decade.  A token's score is the code of the longest known
n-gram plus the weights of the contexts passed on the way down to it, so that a text's score
is a sum of whole numbers and doesn't depend on the order of summation.

Scale: texts are cut into blocks, stored once as word numbers (a block's own) with its sorted
word hashes.  Words get dense ids by hash ranges, and their counts go back to the blocks.  Each
block sends its distinct trigrams, with the training count, to a trie by the word before the
token; the trie is built there, queried for all that was sent, and the codes go back to the
block in the same order.  The words before a token that have more than a trie's share of all
tokens (told by the exact counts) are spread over several tries by the word before them, each
with the word's own successors.  A frequent passage sends a trigram once a block.  The number
of tries and of hash ranges grows with the tokens.  Only their counts reach the driver.

Defined cases: a NULL or empty text is the end token alone; a row without a doc_id is scored,
not held out and not learnt from; rows repeated with a doc_id are texts of their own; without
training texts every score is 0; a word is told by 64 bits of its hash; an empty table gives
an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mktlens.llm.common import stored
from mktlens.llm.elias_fano import Level, Sequence, as_sequence, read, write
from mktlens.llm.wordhash import U, mix, slices, words_of

STEP = 4096
DISCOUNT = 0.75
# Hashes of the two tokens that aren't words.
START, END = U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def squeeze(x: np.ndarray) -> bytes:
    """An array, its bytes by significance, compressed."""
    planes = np.ascontiguousarray(x).view(np.uint8).reshape(-1, x.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def loosen(blob: bytes, kind: type) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, -1).T).reshape(-1).view(kind)


def runs(x: np.ndarray) -> np.ndarray:
    """Where runs of equal values start."""
    return np.nonzero(np.append(True, x[1:] != x[:-1]))[0] if len(x) else np.zeros(0, np.int64)


# --- blocks of texts ----------------------------------------------------------
BLOCKS = "block long, doc_ids binary, named binary, learn binary, lengths binary, vocabulary binary, words binary, n_words long, n_tokens long"


def blocks(docs: DataFrame, block_bytes: int = 8_000_000) -> DataFrame:
    """A row per block of whole texts: documents, tokens of each, word hashes by frequency, word numbers (from 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            learn = batch.column("learn").to_numpy(zero_copy_only=False)
            named = batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
            doc_ids = batch.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False)
            for row, data, bounds in slices(batch.column("text"), block_bytes):
                n = len(bounds) - 1
                w = words_of(data, bounds, fold=True)
                # the end token follows a text's last word
                lengths = w.counts() + 1
                ends = np.cumsum(lengths) - 1
                hashes = np.full(int(lengths.sum()), END, U)
                inner = np.ones(len(hashes), bool)
                inner[ends] = False
                hashes[inner] = w.hash
                distinct, number, times = np.unique(hashes, return_inverse=True, return_counts=True)
                # frequent words have small numbers, which take less room
                often = np.argsort(-times, kind="stable")
                vocabulary, place = distinct[often], np.empty(len(often), np.int64)
                place[often] = np.arange(len(often))
                number = place[number]
                yield pa.RecordBatch.from_arrays([
                    pa.array([block]),
                    *[pa.array([squeeze(x)]) for x in (doc_ids[row:row + n], named[row:row + n].astype(np.uint8), learn[row:row + n].astype(np.uint8),
                                                       lengths, vocabulary, (number + 1).astype(np.uint32))],
                    pa.array([len(vocabulary)]), pa.array([len(hashes)])],
                    names=["block", "doc_ids", "named", "learn", "lengths", "vocabulary", "words", "n_words", "n_tokens"])
                block += 1

    learn = F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), learn.alias("learn"), F.col("text").alias("text")).mapInArrow(run, BLOCKS)


@dataclass
class Block:
    """A stored block, opened."""

    learn: np.ndarray
    lengths: np.ndarray
    vocabulary: np.ndarray
    words: np.ndarray

    @staticmethod
    def of(row) -> Block:
        return Block(loosen(row["learn"], np.uint8).astype(bool), loosen(row["lengths"], np.int64),
                     loosen(row["vocabulary"], U), loosen(row["words"], np.uint32))

    def per_token(self, x: np.ndarray) -> np.ndarray:
        return np.repeat(x, self.lengths)

    def grams(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (word before, the one before that, word), ascending, and which of them each token is; 0 is the start."""
        w = self.words.astype(np.int64)
        first = np.cumsum(self.lengths) - self.lengths
        one, two = np.append(0, w[:-1]), np.append([0, 0], w[:-2])[:len(w)]
        one[first] = 0
        two[first] = 0
        two[(first + 1)[self.lengths > 1]] = 0
        return distinct_grams(one, two, w, len(self.vocabulary) + 1)

    def names(self) -> np.ndarray:
        """The hash of each word number."""
        return np.append(START, self.vocabulary)


def distinct_grams(one: np.ndarray, two: np.ndarray, w: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    bits = max(1, size.bit_length())
    if 3 * bits <= 63:
        key, back = np.unique((one << 2 * bits) | (two << bits) | w, return_inverse=True)
        ones = (1 << bits) - 1
        return key >> 2 * bits, (key >> bits) & ones, key & ones, back
    order = np.lexsort((w, two, one))
    a, b, c = one[order], two[order], w[order]
    new = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (c[1:] != c[:-1]))[:len(a)]
    back = np.empty(len(a), np.int64)
    back[order] = np.cumsum(new) - 1
    return a[new], b[new], c[new], back


@dataclass
class Deal:
    """Which trie a gram belongs to: by the hash of the word before the token, and for the hot ones of these (their
    hashes ascend) by the word before that too, over ``share`` tries from ``first`` on."""

    tries: int
    hot: np.ndarray
    first: np.ndarray
    share: np.ndarray

    def __call__(self, names: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        spread = mix(names)
        out = (spread % U(self.tries)).astype(np.int64)[one]
        if len(self.hot):
            at = np.minimum(np.searchsorted(self.hot, names), len(self.hot) - 1)[one]
            is_hot = np.isin(names, self.hot)[one]
            out[is_hot] = self.first[at[is_hot]] + (spread[two[is_hot]] >> U(20)).astype(np.int64) % self.share[at[is_hot]]
        return out


def frequency(times: np.ndarray) -> np.ndarray:
    """The number of binary digits of each count."""
    return np.frexp(times.astype(np.float64))[1].astype(np.int64)


# --- words: dense ids and counts ----------------------------------------------
def word_counts(stored_blocks: DataFrame, bits: int) -> DataFrame:
    """Per (block, range): how often each of the block's words in that hash range is in training texts, and its rank among
    the range's words of like frequency; and for block -1 the range's totals."""

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for _, row in frame.iterrows():
                b = Block.of(row)
                times = np.bincount(b.words[b.per_token(b.learn)].astype(np.int64) - 1, minlength=len(b.vocabulary))
                order = np.argsort(b.vocabulary)
                hashes, times = b.vocabulary[order], times[order]
                part = (hashes >> U(64 - bits)).astype(np.int64)
                edge = np.append(runs(part), len(part))
                yield pd.DataFrame({"part": part[edge[:-1]], "block": row["block"],
                                    "hashes": [squeeze(np.diff(hashes[i:j], prepend=U(0))) for i, j in zip(edge, edge[1:], strict=False)],
                                    "times": [squeeze(times[i:j]) for i, j in zip(edge, edge[1:], strict=False)]})

    def count(frame: pd.DataFrame) -> pd.DataFrame:
        hashes = [np.cumsum(loosen(h, U)) for h in frame["hashes"]]
        distinct, back = np.unique(np.concatenate(hashes), return_inverse=True)
        total = np.zeros(len(distinct), np.int64)
        np.add.at(total, back, np.concatenate([loosen(t, np.int64) for t in frame["times"]]))
        cuts = np.cumsum([len(h) for h in hashes])[:-1]
        part = int(frame["part"].iloc[0])
        most = np.argsort(-total, kind="stable")
        kind = frequency(total)[most]
        sizes = np.bincount(kind, minlength=64)
        # the rank of each word among those of its frequency
        rank = np.empty(len(most), np.int64)
        rank[most] = np.arange(len(most)) - (np.cumsum(sizes[::-1])[::-1] - sizes)[kind]
        told = pd.DataFrame({"block": [-1], "part": [part], "times": [squeeze(total[most[:256]])], "ranks": [squeeze(distinct[most[:256]])],
                             "sizes": [sizes], "tokens": [int(total.sum())]})
        own = pd.DataFrame({"block": frame["block"].to_numpy(), "part": part, "times": [squeeze(total[x]) for x in np.split(back, cuts)],
                            "ranks": [squeeze(rank[x]) for x in np.split(back, cuts)], "sizes": None, "tokens": 0})
        return pd.concat([own, told], ignore_index=True)

    sent = stored_blocks.select("block", "learn", "lengths", "vocabulary", "words").mapInPandas(
        send, "part long, block long, hashes binary, times binary")
    return sent.groupBy("part").applyInPandas(
        count, "block long, part long, times binary, ranks binary, sizes array<long>, tokens long")


@dataclass
class Corpus:
    """What the driver knows: training tokens, known words, the deal of the tries, and the ids below those of each
    (hash range, frequency): frequent words have small ids."""

    tokens: int
    known: int
    below: dict[int, np.ndarray]
    deal: Deal

    def base(self, times: np.ndarray) -> np.ndarray:
        return np.log10((times + 1.0) / (self.tokens + self.known + 1.0))


def code_of(log10: np.ndarray) -> np.ndarray:
    return np.minimum(np.rint(-log10 * STEP), 65535).astype(np.uint16)


def value_of(code: np.ndarray) -> np.ndarray:
    return 10.0 ** (-code.astype(np.float64) / STEP)


# --- tries --------------------------------------------------------------------
def build_trie(one: np.ndarray, two: np.ndarray, w: np.ndarray, times: np.ndarray, unigram: np.ndarray,
               hot: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None = None) -> bytes:
    """The trie of trained grams (ascending by one, two, w; ``times`` above 0; ``unigram`` the code of w).  ``hot`` has
    the successors (one, w, times, unigram) of words whose grams are spread over several tries."""
    order = np.lexsort((w, one))
    a, b, n, u = one[order], w[order], times[order], unigram[order]
    at = np.nonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])))[0] if len(a) else np.zeros(0, np.int64)
    a, b, u, n = a[at], b[at], u[at], np.add.reduceat(n, at) if len(at) else n[:0]
    if hot is not None and len(hot[0]):
        # the others keep the counts of their own grams
        own = ~np.isin(a, hot[0])
        a, b, n, u = (np.concatenate([x[own], y]) for x, y in zip((a, b, n, u), hot, strict=True))
        order = np.lexsort((b, a))
        a, b, n, u = a[order], b[order], n[order], u[order]
    ids, place = np.unique(a, return_inverse=True)
    total, kinds = np.bincount(place, weights=n, minlength=len(ids)), np.bincount(place, minlength=len(ids))
    left = DISCOUNT * kinds / np.maximum(total, 1)
    second = (n - DISCOUNT) / total[place] + left[place] * value_of(u) if len(a) else np.zeros(0)

    first = runs_of(one, two)
    context_one, context_two = one[first], two[first]
    context = np.cumsum(np.bincount(first, minlength=len(one))[:len(one)]) - 1 if len(one) else np.zeros(0, np.int64)
    total3, kinds3 = np.bincount(context, weights=times, minlength=len(first)), np.bincount(context, minlength=len(first))
    left3 = DISCOUNT * kinds3 / np.maximum(total3, 1)
    # the bigram under each trigram: both ascend by (word before, word) once sorted
    pair = _find_pairs(a, b, one, w)
    third = (times - DISCOUNT) / total3[context] + left3[context] * second[pair] if len(one) else np.zeros(0)
    arrays = {f"ids.{k}": v for k, v in as_sequence(ids.astype(U)).items()}
    arrays |= {"left": code_of(np.log10(left)) if len(left) else np.zeros(0, np.uint16)}
    logs = lambda x: code_of(np.log10(x)) if len(x) else np.zeros(0, np.uint16)
    arrays |= Level.arrays("second", len(ids), place, b, code=logs(second))
    arrays |= Level.arrays("context", len(ids), np.searchsorted(ids, context_one), context_two, left=logs(left3))
    arrays |= Level.arrays("third", len(first), context, w, code=logs(third))
    return write(arrays)


def runs_of(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.nonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])))[0] if len(a) else np.zeros(0, np.int64)


def _find_pairs(a: np.ndarray, b: np.ndarray, one: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Where (one, w) stands among the ascending distinct pairs (a, b)."""
    ids, place = np.unique(a, return_inverse=True)
    words, number = np.unique(b, return_inverse=True)
    key = place.astype(np.int64) * (len(words) + 1) + number
    asked = np.searchsorted(ids, one) * (len(words) + 1) + np.searchsorted(words, w)
    return np.searchsorted(key, asked)


class Trie:
    def __init__(self, arrays: dict[str, np.ndarray]):
        self.ids = Sequence({k[4:]: v for k, v in arrays.items() if k.startswith("ids.")})
        self.left = arrays["left"]
        self.second, self.context, self.third = (Level(name, arrays) for name in ("second", "context", "third"))

    def codes(self, one: np.ndarray, two: np.ndarray, w: np.ndarray, unigram: np.ndarray) -> np.ndarray:
        """The score, in steps below 0, of every gram (ascending by one, two, w)."""
        at = runs(one)
        seen = self.ids.successor(one[at].astype(U))
        known = np.zeros(len(at), bool)
        inside = seen < self.ids.size
        known[inside] = self.ids.at(seen[inside]) == one[at][inside].astype(U)
        word = np.repeat(np.where(known, seen, -1), np.diff(np.append(at, len(one))))
        at = runs_of(one, two)
        context = np.repeat(self.context.find(word[at], two[at]), np.diff(np.append(at, len(one))))
        out = np.zeros(len(one), np.int64)
        third = self.third.find(context, w)
        hit = third >= 0
        out[hit] = self.third.data["code"][third[hit]]
        rest = np.nonzero(~hit)[0]
        passed = context[rest] >= 0
        out[rest[passed]] += self.context.data["left"][context[rest[passed]]]
        # shorter contexts: ascending by (word before, word)
        rest = rest[np.lexsort((w[rest], one[rest]))]
        second = self.second.find(word[rest], w[rest])
        hit = second >= 0
        out[rest[hit]] += self.second.data["code"][second[hit]]
        rest = rest[~hit]
        passed = word[rest] >= 0
        out[rest[passed]] += self.left[word[rest[passed]]]
        out[rest] += unigram[rest]
        return out


# --- the distributed steps ------------------------------------------------------
SENT = "trie long, block long, kind int, grams binary, sizes array<int>"


def _pack(*columns: np.ndarray) -> tuple[bytes, list[int]]:
    blobs = [squeeze(c) for c in columns]
    return b"".join(blobs), [len(b) for b in blobs]


def _unpack(blob: bytes, sizes, kinds) -> list[np.ndarray]:
    edge = np.concatenate([[0], np.cumsum(sizes)])
    return [loosen(blob[a:b], kind) for a, b, kind in zip(edge, edge[1:], kinds, strict=False)]


GRAM_KINDS = (np.int64, np.int64, np.int64, np.uint16, np.int64)
# What a row sent is: a block's documents, its grams, or successors of a hot word.
DOCUMENTS, GRAMS, SUCCESSORS = range(3)


def _words_known(b: Block, frame: pd.DataFrame, corpus: Corpus) -> tuple[np.ndarray, np.ndarray]:
    """(training count, id) of a block's words, from the answers of all hash ranges."""
    frame = frame.sort_values("part")
    told = [loosen(t, np.int64) for t in frame["times"]]
    ids = np.concatenate([loosen(r, np.int64) + corpus.below[int(p)][frequency(t)] + 1
                          for r, p, t in zip(frame["ranks"], frame["part"], told, strict=True)])
    order = np.argsort(b.vocabulary)
    back = np.empty(len(order), np.int64)
    back[order] = np.arange(len(order))
    return np.concatenate(told)[back], ids[back]


def send_grams(stored_blocks: DataFrame, counts: DataFrame, corpus: Corpus) -> DataFrame:
    """A block's distinct grams by trie; and, for a trie of its own below 0, its documents with their base scores."""

    def send(key, block: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        row, b = block.iloc[0], Block.of(block.iloc[0])
        times, ids = _words_known(b, known, corpus)
        base, number = corpus.base(times), b.words.astype(np.int64) - 1
        doc = np.repeat(np.arange(len(b.lengths)), b.lengths)
        per_doc = lambda x: np.bincount(doc, weights=x[number], minlength=len(b.lengths))
        told, sizes = _pack(per_doc(base), per_doc((times > 0).astype(float)).astype(np.int64), b.lengths)
        one, two, w, back = b.grams()
        learnt = np.bincount(back, weights=b.per_token(b.learn), minlength=len(one)).astype(np.int64)
        trie = corpus.deal(b.names(), one, two)
        order = np.argsort(trie, kind="stable")
        gid, unigram = np.append(0, ids), np.append(np.uint16(0), code_of(base))
        one, two, w, learnt, trie = gid[one][order], gid[two][order], w[order], learnt[order], trie[order]
        edge = np.append(runs(trie), len(trie))
        packed = [_pack(one[i:j], two[i:j], gid[w[i:j]], unigram[w[i:j]], learnt[i:j])
                  for i, j in zip(edge, edge[1:], strict=False)]
        return pd.DataFrame({"trie": [-1 - key[0], *trie[edge[:-1]]], "block": key[0], "kind": [DOCUMENTS] + [GRAMS] * len(packed),
                             "grams": [told, *[p for p, _ in packed]], "sizes": [sizes, *[s for _, s in packed]]})

    own = counts.where(F.col("block") >= 0).select("block", "part", "times", "ranks")
    return stored_blocks.groupBy("block").cogroup(own.groupBy("block")).applyInPandas(send, SENT)


def hot_successors(stored_blocks: DataFrame, counts: DataFrame, corpus: Corpus, slices_of_words: int = 64) -> DataFrame:
    """The successors of each hot word, for every trie that it is spread over."""
    deal = corpus.deal

    def partial(key, block: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        b = Block.of(block.iloc[0])
        times, ids = _words_known(b, known, corpus)
        names, unigram = b.names(), np.append(np.uint16(0), code_of(corpus.base(times)))
        one, _, w, back = b.grams()
        learnt = np.bincount(back, weights=b.per_token(b.learn), minlength=len(one)).astype(np.int64)
        mine = (learnt > 0) & np.isin(names, deal.hot)[one]
        one, w, learnt = one[mine], w[mine], learnt[mine]
        gid, out = np.append(0, ids), []
        slot = (mix(names[w]) >> U(30)).astype(np.int64) % slices_of_words
        order = np.lexsort((w, slot, one))
        one, w, learnt, slot = one[order], w[order], learnt[order], slot[order]
        pair = runs_of(one, w)
        if len(pair):
            learnt = np.add.reduceat(learnt, pair)
            one, w, slot = one[pair], w[pair], slot[pair]
        edge = np.append(runs_of(one, slot), len(one))
        for i, j in zip(edge, edge[1:], strict=False):
            blob, sizes = _pack(np.full(j - i, gid[one[i]]), np.zeros(j - i, np.int64), gid[w[i:j]], unigram[w[i:j]], learnt[i:j])
            out.append((int(names[one[i]].astype(np.int64)), int(slot[i]), blob, sizes))
        return pd.DataFrame(out, columns=["word", "slot", "grams", "sizes"])

    def merge(key, frame: pd.DataFrame) -> pd.DataFrame:
        parts = [_unpack(g, s, GRAM_KINDS) for g, s in zip(frame["grams"], frame["sizes"], strict=True)]
        one, _, w, unigram, times = (np.concatenate(x) for x in zip(*parts, strict=True))
        ids, at, back = np.unique(w, return_index=True, return_inverse=True)
        total = np.bincount(back, weights=times, minlength=len(ids)).astype(np.int64)
        blob, sizes = _pack(one[at], np.zeros(len(ids), np.int64), ids, unigram[at], total)
        at = int(np.searchsorted(deal.hot, np.int64(key[0]).astype(U)))
        first, n = int(deal.first[at]), int(deal.share[at])
        return pd.DataFrame({"trie": np.arange(first, first + n), "block": -1, "kind": SUCCESSORS, "grams": [blob] * n, "sizes": [sizes] * n})

    own = counts.where(F.col("block") >= 0).select("block", "part", "times", "ranks")
    found = stored_blocks.groupBy("block").cogroup(own.groupBy("block")).applyInPandas(
        partial, "word long, slot int, grams binary, sizes array<int>")
    return found.groupBy("word", "slot").applyInPandas(merge, SENT)


def _gathered(frame: pd.DataFrame) -> tuple[list[np.ndarray], np.ndarray, list[np.ndarray]]:
    """All grams sent to a trie: (columns of the distinct ones, which of them each sent one is, hot successors)."""
    parts = [_unpack(g, s, GRAM_KINDS) for g, s in zip(frame["grams"], frame["sizes"], strict=True)]
    empty = [np.zeros(0, kind) for kind in GRAM_KINDS]
    sent = [p for p, kind in zip(parts, frame["kind"], strict=True) if kind == GRAMS]
    hot = [p for p, kind in zip(parts, frame["kind"], strict=True) if kind == SUCCESSORS]
    one, two, w, unigram, times = (np.concatenate(x) for x in zip(empty, *sent, strict=True))
    words, number = np.unique(one, return_inverse=True)
    bits = max(1, int(max(two.max(initial=0), w.max(initial=0))).bit_length())
    if len(words).bit_length() + 2 * bits <= 63:
        key = (number << 2 * bits) | (two << bits) | w
        _, at, back = np.unique(key, return_index=True, return_inverse=True)
    else:
        order = np.lexsort((w, two, one))
        new = np.append(True, (np.diff(one[order]) != 0) | (np.diff(two[order]) != 0) | (np.diff(w[order]) != 0))[:len(one)]
        at, back = order[new], np.empty(len(one), np.int64)
        back[order] = np.cumsum(new) - 1
    total = np.bincount(back, weights=times, minlength=len(at)).astype(np.int64)
    successors = [np.concatenate(x) for x in zip(empty, *hot, strict=True)]
    return [one[at], two[at], w[at], unigram[at], total], back, [successors[0], successors[2], successors[4].astype(np.int64), successors[3]]


def _trie_of(grams: list[np.ndarray], hot: list[np.ndarray]) -> bytes:
    one, two, w, unigram, times = (x[grams[4] > 0] for x in grams)
    return build_trie(one, two, w, times, unigram, hot)


ANSWERS = "block long, trie long, codes binary, sizes array<int>"


def answer(frame: pd.DataFrame) -> pd.DataFrame:
    """Builds a trie and tells the codes of all grams sent to it, block by block; documents pass."""
    if frame["kind"].iloc[0] == DOCUMENTS:
        return frame[["block", "trie", "grams", "sizes"]].rename(columns={"grams": "codes"})
    own = frame[frame["kind"] == GRAMS]
    if not len(own):
        return pd.DataFrame(columns=["block", "trie", "codes", "sizes"], dtype=object)
    grams, back, hot = _gathered(frame)
    codes = Trie(read(_trie_of(grams, hot))).codes(*grams[:4])[back].astype(np.uint32)
    count = [len(loosen(g[:s[0]], np.int64)) for g, s in zip(own["grams"], own["sizes"], strict=True)]
    blobs = [squeeze(c) for c in np.split(codes, np.cumsum(count)[:-1])]
    return pd.DataFrame({"block": own["block"].to_numpy(), "trie": own["trie"].to_numpy(), "codes": blobs, "sizes": [[len(b)] for b in blobs]})


def _steps(b: Block, deal: Deal, answers: pd.DataFrame) -> np.ndarray:
    """The sum of the codes of each document's tokens, from the answers in the order of the tries."""
    one, two, _, back = b.grams()
    gram = np.empty(len(one), np.int64)
    # within a trie, codes stand in the order of the grams
    gram[np.argsort(deal(b.names(), one, two), kind="stable")] = np.concatenate([loosen(c, np.uint32) for c in answers["codes"]])
    total, ends = np.concatenate([[0], np.cumsum(gram[back])]), np.cumsum(b.lengths)
    return total[ends] - total[ends - b.lengths]


def corpus_of(stored_blocks: DataFrame, grams_per_trie: int, words_per_range: int) -> tuple[DataFrame, Corpus]:
    """(counts and ids of the blocks' words, totals of the corpus)."""
    size = stored_blocks.agg(F.sum("n_words"), F.sum("n_tokens")).first()
    bits = max(1, ((size[0] or 0) // words_per_range).bit_length())
    counts = stored(word_counts(stored_blocks, bits))
    told = counts.where(F.col("block") == -1).select("part", "times", "ranks", "sizes", "tokens").orderBy("part").toPandas()
    tokens, tries = int(told["tokens"].sum()), max(1, -(-(size[1] or 0) // grams_per_trie))
    sizes = np.stack([np.asarray(x) for x in told["sizes"]]) if len(told) else np.zeros((0, 64), np.int64)
    # ids count from the most frequent words of the first range on
    in_order = sizes[:, ::-1].T.ravel()
    start = (np.cumsum(in_order) - in_order).reshape(64, -1).T[:, ::-1]
    below = {int(p): s for p, s in zip(told["part"], start, strict=True)}
    often: dict[int, int] = {}
    for _, r in told.iterrows():
        often |= {int(h): int(n) for h, n in zip(loosen(r["ranks"], U), loosen(r["times"], np.int64), strict=True) if n * tries > tokens}
    if int(END) in often:  # as many texts start as end
        often[int(START)] = often.pop(int(END))
    hot = sorted(often) if tries > 1 else []
    share = np.array([1 + often[h] * tries // tokens for h in hot], np.int64)
    deal = Deal(tries, np.array(hot, U), tries + np.cumsum(share) - share, share)
    return counts, Corpus(tokens, int(sizes[:, 1:].sum()), below, deal)


def _sent(docs: DataFrame, block_bytes: int, grams_per_trie: int, words_per_range: int) -> tuple[DataFrame, Corpus, DataFrame]:
    """(stored blocks, totals, what is sent to the tries)."""
    texts = stored(blocks(docs, block_bytes))
    counts, corpus = corpus_of(texts, grams_per_trie, words_per_range)
    sent = send_grams(texts, counts, corpus)
    return texts, corpus, sent.union(hot_successors(texts, counts, corpus)) if len(corpus.deal.hot) else sent


def tries(docs: DataFrame, block_bytes: int = 8_000_000, grams_per_trie: int = 1_000_000, words_per_range: int = 1_000_000) -> DataFrame:
    """(trie, data): the model trained on ``docs``, a buffer per trie that ``elias_fano`` reads or maps."""

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        if not (frame["kind"] == GRAMS).any():
            return pd.DataFrame(columns=["trie", "data"], dtype=object)
        grams, _, hot = _gathered(frame)
        return pd.DataFrame({"trie": frame["trie"].iloc[:1], "data": [_trie_of(grams, hot)]})

    _, _, sent = _sent(docs, block_bytes, grams_per_trie, words_per_range)
    return sent.where(F.col("kind") != DOCUMENTS).groupBy("trie").applyInPandas(build, "trie long, data binary")


def score(docs: DataFrame, block_bytes: int = 8_000_000, grams_per_trie: int = 1_000_000, words_per_range: int = 1_000_000) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every text."""
    texts, corpus, sent = _sent(docs, block_bytes, grams_per_trie, words_per_range)
    deal = corpus.deal

    def documents(block: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        row, b = block.iloc[0], Block.of(block.iloc[0])
        told = told.sort_values("trie")
        base, known, tokens = _unpack(told["codes"].iloc[0], told["sizes"].iloc[0], (np.float64, np.int64, np.int64))
        ids = pd.Series(loosen(row["doc_ids"], np.int64), dtype="Int64").where(loosen(row["named"], np.uint8).astype(bool))
        return pd.DataFrame({"doc_id": ids, "n_tokens": tokens, "n_known": known, "base_score": base, "steps": _steps(b, deal, told.iloc[1:])})

    answers = sent.groupBy("trie").applyInPandas(answer, ANSWERS)
    out = texts.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(
        documents, "doc_id long, n_tokens long, n_known long, base_score double, steps long")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known",
                      F.lit(corpus.tokens).cast("long").alias("train_tokens"), "base_score",
                      (-F.col("steps") / F.lit(float(STEP))).alias("score"))


def op12_lm_scoring(docs: DataFrame) -> DataFrame:
    return score(docs)
