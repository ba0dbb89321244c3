"""Substring deduplication across and within documents.

Method: relative Lempel-Ziv parsing against indexed reference blocks.  Every
batch of documents is a reference block; an index over all of them knows, for
each ``length``-word sequence, where it starts first.  A document is parsed
into factors: maximal runs of positions that copy consecutive positions of one
earlier place.  Factors of at least ``length`` words become duplicate spans.
Because every position of a document that can start such a sequence is looked
up, also those across the boundary of two factors, the spans are exact.

How the index stays small: each sequence is represented by its smallest 4-word
hash (a minimiser), about one word in nine.  Only sequences whose minimiser
occurs twice can be repeated; these alone are looked up by a 96-bit hash.

Scale: hashes travel packed by bucket of the minimiser, and a batch ships one
occurrence of each (the other ones are decided inside the batch), so a passage
held by a third of all documents sends one row per batch, not per document.
The number of buckets grows with the table.  Texts are shuffled compressed.

Defined cases: a NULL text has no words; rows with a NULL doc_id neither lose
words nor serve as an earlier place; doc_id names a document, so rows repeated
with it are the same place; an empty table gives an empty result; extra columns
pass through ``drop_spans``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mktlens.llm.common import stored
from mktlens.llm.wordhash import U, Words, mix, slices, words_of

GRAM = 4
TOP = U((1 << 64) - 1)


def _sliding(a: np.ndarray, width: int, f: np.ufunc) -> np.ndarray:
    """f over a[i:i + width] for every i, by doubling."""
    done, out = 1, a
    while done < width:
        step = min(done, width - done)
        out = f(out[:-step], out[step:])
        done += step
    return out


def minimisers(w: Words, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts of the sequences of ``length`` words, the minimiser of each,
    word positions that are the minimiser of a sequence)."""
    none = np.zeros(0, np.int64)
    n, span = len(w.hash), length - GRAM + 1
    if n < length:
        return none, np.zeros(0, U), none
    at = np.nonzero(w.doc[:n - length + 1] == w.doc[length - 1:])[0]
    grams = np.full(n, TOP, U)
    g_at, g = w.windows(GRAM)
    grams[g_at] = g
    low = _sliding(grams, span, np.minimum)[at]
    covered = np.zeros(n + 2 * span, U)
    covered[at + span - 1] = low
    reach = _sliding(covered, span, np.maximum)[:n]
    return at, low, np.nonzero((reach == grams) & (grams != TOP))[0]


def pack_texts(docs: DataFrame) -> DataFrame:
    """(doc_id, packed): texts compressed for a shuffle; a NULL stays NULL."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                b = batch.slice(at, 500)
                packed = [c.compress(str(t).encode()) if t.is_valid else None for t in b.column("text")]
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(packed, pa.binary())], names=["doc_id", "packed"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")).mapInArrow(run, "doc_id long, packed binary")


def _unpacked(batch: pa.RecordBatch, limit: int = 4_000_000) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Like ``slices`` for a column of packed texts."""
    d = zstandard.ZstdDecompressor()
    texts: list[bytes] = []
    first = size = 0
    for i, packed in enumerate(batch.column("packed")):
        texts.append(d.decompress(packed.as_py()) if packed.is_valid else b"")
        size += len(texts[-1])
        if size > limit or i == batch.num_rows - 1:
            yield first, np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
            texts, first, size = [], i + 1, 0


def _squeeze(*columns: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b"".join(c.tobytes() for c in columns))


def _by_bucket(bucket: np.ndarray) -> list[np.ndarray]:
    order = np.argsort(bucket, kind="stable")
    return np.split(order, np.nonzero(np.diff(bucket[order]))[0] + 1) if len(order) else []


def repeated_minimisers(docs: DataFrame, length: int, buckets: int) -> DataFrame:
    """(doc_id, mins): the minimisers of each document that occur twice or more."""

    def found(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hash, doc_id) of a batch's minimisers by hash, and how often each hash occurs."""
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
        h, doc = [np.zeros(0, U)], [np.zeros(0, np.int64)]
        for first, data, bounds in slices(batch.column("text")):
            w = words_of(data, bounds)
            _, low, at = minimisers(w, length)
            grams_at, grams = w.windows(GRAM)
            h.append(grams[np.searchsorted(grams_at, at)])
            doc.append(ids[first + w.doc[at]])
        h, doc = np.concatenate(h), np.concatenate(doc)
        order = np.lexsort((doc, h))
        h, doc = h[order], doc[order]
        start = np.nonzero(np.append(True, h[1:] != h[:-1]))[0] if len(h) else np.zeros(0, np.int64)
        return h, doc, np.repeat(np.diff(np.append(start, len(h))), np.diff(np.append(start, len(h))))

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, doc, times = found(batch)
            first = np.append(True, h[1:] != h[:-1]) if len(h) else np.zeros(0, bool)
            h, doc, more = h[first], doc[first], times[first] > 1
            groups = [g[np.argsort(doc[g], kind="stable")] for g in _by_bucket((h % U(buckets)).astype(np.int64))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(h[g[0]] % U(buckets)) for g in groups], pa.int32()), pa.array([len(g) for g in groups], pa.int32()),
                 pa.array([_squeeze(h[g], np.diff(doc[g], prepend=0), more[g]) for g in groups], pa.binary())], names=["bucket", "n", "blob"])

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, doc, times = found(batch)
            keep = times > 1
            keep[1:] &= (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
            h, doc = h[keep], doc[keep]
            for at in range(0, len(h), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(doc[at:at + 50_000]), pa.array(h[at:at + 50_000].view(np.int64))], names=["doc_id", "h"])

    def meet(key, frame: pd.DataFrame) -> pd.DataFrame:
        d = zstandard.ZstdDecompressor()
        h, doc, more = [], [], []
        for n, blob in zip(frame["n"], frame["blob"], strict=True):
            raw = d.decompress(blob)
            h.append(np.frombuffer(raw, U, n))
            doc.append(np.cumsum(np.frombuffer(raw, np.int64, n, 8 * n)))
            more.append(np.frombuffer(raw, bool, n, 16 * n))
        h, doc, more = np.concatenate(h), np.concatenate(doc), np.concatenate(more)
        _, back, times = np.unique(h, return_inverse=True, return_counts=True)
        keep = (times[back] > 1) & ~more  # a batch that has more of it has said so itself
        return pd.DataFrame({"doc_id": doc[keep], "h": h[keep].view(np.int64)})

    met = docs.mapInArrow(heads, "bucket int, n int, blob binary").groupBy("bucket").applyInPandas(meet, "doc_id long, h long")
    return met.union(docs.mapInArrow(others, "doc_id long, h long")).groupBy("doc_id").agg(F.collect_list("h").alias("mins"))


FACTORS = "doc_id long, start long, n long, ref_doc long, ref_start long"


def factors(docs: DataFrame, length: int = 20, docs_per_bucket: int = 4096) -> DataFrame:
    """(doc_id, start, n, ref_doc, ref_start): the n sequences of ``length``
    words that start at word ``start`` and on also start, one by one, at the
    earlier place (ref_doc, ref_start) and on."""
    own = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    buckets = max(16, -(-own.count() // docs_per_bucket))
    parsed = pack_texts(own).join(repeated_minimisers(own, length, buckets), "doc_id")

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            cols: list[list[np.ndarray]] = [[], [], [], [], []]
            for first, data, bounds in _unpacked(batch):
                w = words_of(data, bounds)
                at, low, _ = minimisers(w, length)
                mins = batch.column("mins").slice(first, len(bounds) - 1)
                spread = U(0x9E3779B97F4A7C15)
                listed = mix(mins.flatten().to_numpy(zero_copy_only=False).view(U)
                             + np.repeat(np.arange(len(mins)), mins.value_lengths().to_numpy(zero_copy_only=False)).astype(U) * spread)
                hit = np.isin(mix(low + w.doc[at].astype(U) * spread), listed)
                w_at, h1 = w.windows(length)
                _, h2 = w.windows(length, salt=1)
                at, low, h1, h2 = at[hit], low[hit], h1[hit], (h2[hit] >> U(32)).astype(np.uint32)
                for c, x in zip(cols, (h1, h2, ids[first + w.doc[at]], (at - w.first()[w.doc[at]]).astype(np.int32), (low % U(buckets)).astype(np.int64)), strict=True):
                    c.append(x)
            if not cols[0]:
                continue
            h1, h2, doc, start, bucket = map(np.concatenate, cols)
            order = np.lexsort((start, doc, h2, h1))
            h1, h2, doc, start, bucket = (x[order] for x in (h1, h2, doc, start, bucket))
            same = np.append(False, (h1[1:] == h1[:-1]) & (h2[1:] == h2[:-1])) if len(h1) else np.zeros(0, bool)
            lead = np.maximum.accumulate(np.where(same, 0, np.arange(len(h1)))) if len(h1) else np.zeros(0, np.int64)
            local = same & ((doc != doc[lead]) | (start != start[lead]))
            blobs = {}
            for g in _by_bucket(bucket):
                ship = g[~same[g]]
                ship = ship[np.lexsort((start[ship], doc[ship]))]
                mark = g[local[g]]
                mark = mark[np.lexsort((start[mark], doc[mark]))]
                blobs[int(bucket[g[0]])] = (
                    len(ship), _squeeze(h1[ship], h2[ship], np.diff(doc[ship], prepend=0), np.diff(start[ship], prepend=np.int32(0))),
                    len(mark), _squeeze(*(np.diff(x, prepend=x.dtype.type(0)) for x in (doc[mark], start[mark], doc[lead[mark]], start[lead[mark]]))))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(blobs), pa.int32()), *[pa.array([b[i] for b in blobs.values()], t) for i, t in enumerate((pa.int32(), pa.binary(), pa.int32(), pa.binary()))]],
                names=["bucket", "n", "blob", "m", "marks"])

    def meet(key, frame: pd.DataFrame) -> pd.DataFrame:
        d = zstandard.ZstdDecompressor()
        ship, mark = [], []
        for n, blob, m, marks in zip(frame["n"], frame["blob"], frame["m"], frame["marks"], strict=True):
            raw = d.decompress(blob)
            ship.append((np.frombuffer(raw, U, n), np.frombuffer(raw, np.uint32, n, 8 * n), np.cumsum(np.frombuffer(raw, np.int64, n, 12 * n)),
                         np.cumsum(np.frombuffer(raw, np.int32, n, 20 * n), dtype=np.int64)))
            raw = d.decompress(marks)
            mark.append(tuple(np.cumsum(np.frombuffer(raw, t, m, o * m), dtype=np.int64)
                              for t, o in ((np.int64, 0), (np.int32, 8), (np.int64, 12), (np.int32, 20))))
        h1, h2, doc, start = map(np.concatenate, zip(*ship, strict=True))
        order = np.lexsort((start, doc, h2, h1))
        h1, h2, doc, start = h1[order], h2[order], doc[order], start[order]
        same = np.append(False, (h1[1:] == h1[:-1]) & (h2[1:] == h2[:-1])) if len(h1) else np.zeros(0, bool)
        lead = np.maximum.accumulate(np.where(same, 0, np.arange(len(h1)))) if len(h1) else np.zeros(0, np.int64)
        again = same & ((doc != doc[lead]) | (start != start[lead]))
        mark.append((doc[again], start[again], doc[lead[again]], start[lead[again]]))
        doc, start, ref_doc, ref_start = map(np.concatenate, zip(*mark, strict=True))
        order = np.lexsort((ref_start, ref_doc, start, doc))
        doc, start, ref_doc, ref_start = doc[order], start[order], ref_doc[order], ref_start[order]
        # consecutive positions that copy consecutive positions of one place are one factor
        new = np.ones(len(doc), bool)
        new[1:] = ~((doc[1:] == doc[:-1]) & (start[1:] == start[:-1] + 1) & (ref_doc[1:] == ref_doc[:-1]) & (ref_start[1:] == ref_start[:-1] + 1))
        at = np.nonzero(new)[0]
        return pd.DataFrame({"doc_id": doc[at], "start": start[at], "n": np.diff(np.append(at, len(doc))),
                             "ref_doc": ref_doc[at], "ref_start": ref_start[at]})

    return parsed.mapInArrow(look, "bucket int, n int, blob binary, m int, marks binary").groupBy("bucket").applyInPandas(meet, FACTORS)


def drop_spans(docs: DataFrame, length: int = 20, **kwargs) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): per row of ``docs``, its words
    outside every duplicate span, joined by one blank."""
    spans = stored(factors(docs, length, **kwargs)).groupBy(F.col("doc_id").alias("_id")).agg(
        F.collect_list("start").alias("starts"), F.collect_list("n").alias("ns"))
    packed = pack_texts(docs)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, bounds in _unpacked(batch):
                m = len(bounds) - 1
                w = words_of(data, bounds)
                edge = np.zeros(len(w.hash) + 1, np.int64)
                starts, ns = (batch.column(c).slice(first, m) for c in ("starts", "ns"))
                count = starts.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                begin = starts.flatten().to_numpy(zero_copy_only=False) + np.repeat(w.first(), count)
                np.add.at(edge, begin, 1)
                np.add.at(edge, begin + ns.flatten().to_numpy(zero_copy_only=False) + length - 1, -1)
                keep = np.cumsum(edge[:-1]) == 0
                n_words = w.counts()
                kept_words = np.bincount(w.doc[keep], minlength=m)
                size = (w.ends - w.starts)[keep] + 1  # with a blank behind each word
                place = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
                at = np.repeat(w.starts[keep], size) + place
                out = np.append(data, np.uint8(32))[at]
                out[np.cumsum(size) - 1] = 32
                ends = np.cumsum(np.bincount(w.doc[keep], weights=size, minlength=m)).astype(np.int64)
                begins = np.concatenate([[0], ends[:-1]])
                texts = [out[b:max(b, e - 1)].tobytes().decode() for b, e in zip(begins, ends, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, m), pa.array(n_words.astype(np.int64)), pa.array((n_words - kept_words).astype(np.int64)), pa.array(texts, pa.string())],
                    names=["doc_id", "n_words", "n_removed", "kept"])

    joined = packed.join(spans, packed["doc_id"] == spans["_id"], "left").select("doc_id", "packed", "starts", "ns")
    return joined.mapInArrow(cut, "doc_id long, n_words long, n_removed long, kept string")


def op6_substring_dedup(docs: DataFrame) -> DataFrame:
    return drop_spans(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP6_SQL = r"""
WITH lists AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), words AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM lists
), starts AS (
  SELECT doc_id, unnest(range(1, len(w) - 18)) AS pos, w FROM lists WHERE len(w) >= 20
), windows AS (
  SELECT doc_id, pos, array_to_string(w[pos:pos + 19], ' ') AS sequence FROM starts
), repeated AS (
  SELECT doc_id, pos FROM (
    SELECT doc_id, pos, row_number() OVER (PARTITION BY sequence ORDER BY doc_id, pos) AS nth FROM windows)
  WHERE nth > 1
), judged AS (
  SELECT words.doc_id, words.pos, word, max(repeated.pos) OVER (
           PARTITION BY words.doc_id ORDER BY words.pos ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) IS NOT NULL AS gone
  FROM words LEFT JOIN repeated ON repeated.doc_id = words.doc_id AND repeated.pos = words.pos
), kept AS (
  SELECT doc_id, count(*) FILTER (WHERE gone) AS n_removed,
         string_agg(word, ' ' ORDER BY pos) FILTER (WHERE NOT gone) AS left_over
  FROM judged GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(left_over, '')) AS kept_sha256
FROM lists LEFT JOIN kept USING (doc_id)
"""
