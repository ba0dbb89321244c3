"""Quality rules with cross-document line frequency.

Method: lines are normalised (white space stripped at both ends, A-Z
lower-cased) and hashed; the distinct documents of each (host, line) are
counted; lines held by more than ``limit`` documents of a host are removed, and a
document that this leaves with too few of its words is rejected.  The host is
the ``source`` column.  The limit is a number of documents, the same for a host
of any size.

Scale: one pass over the text gives a document's base counts and, per distinct
line, a hash and its words; lines are counted with map-side partial
aggregation, and joined back by (host, line) with a slice of the document id,
so that one line of a hot host is spread over ``SLICES`` keys.

Defined cases: a NULL text has no words and fails the base rules; a NULL
source is a host of its own; rows repeated with the same doc_id count once for
a line; a NULL doc_id counts for no line; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mktlens.llm.common import checkpointed
from mktlens.llm.wordhash import U, line_hashes, mix, slices, words_of

SLICES = 32
# The symbols that are counted.
SYMBOLS = "#*$%&|<>"
_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[[ord(c) for c in SYMBOLS]] = True

COUNTS = ("doc_id long, host string, row long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
          "n_repeat_words long, lines array<struct<line: long, words: long>>")


def _per_row(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def _measure(data: np.ndarray, bounds: np.ndarray):
    """Base counts of each row, and its distinct normalised lines with words."""
    n = len(bounds) - 1
    w = words_of(data, bounds)
    n_words = w.counts()
    chars = _per_row(((data & 0xC0) != 0x80) & ~np.isin(data, [32, 9, 10, 11, 12, 13]), bounds)
    symbols = _per_row(_IS_SYMBOL[data], bounds)

    repeat = np.zeros(n, np.int64)
    at, h = w.windows(3)
    if len(at):
        key = mix(h + w.doc[at].astype(U) * U(0x9E3779B97F4A7C15))
        _, back, times = np.unique(key, return_inverse=True, return_counts=True)
        twice = at[times[back] > 1]
        hit = np.zeros(len(w.hash), bool)
        for i in range(3):
            hit[twice + i] = True
        repeat = np.bincount(w.doc[hit], minlength=n)

    # lines: between row bounds and line feeds; only those with a word matter
    feeds = np.nonzero(data == 10)[0]
    start = np.sort(np.concatenate([bounds[:-1], feeds + 1]), kind="stable")
    stop = np.sort(np.concatenate([bounds[1:], feeds]), kind="stable")
    row = np.searchsorted(bounds, start, side="right") - 1
    first = np.searchsorted(w.starts, start)
    last = np.searchsorted(w.starts, stop)
    own = (last > first) & (start < stop)
    start, stop, row, first, last = start[own], stop[own], row[own], first[own], last[own]
    exact = line_hashes(data, start, stop)
    spread = row.astype(U) * U(0x9E3779B97F4A7C15)
    kept = np.unique(mix(exact + spread), return_index=True)[1]
    dup = np.bincount(row, minlength=n) - np.bincount(row[kept], minlength=n)

    folded = np.where((data >= 0x41) & (data <= 0x5A), data | 0x20, data).astype(np.uint8)
    norm = line_hashes(folded, w.starts[first], w.ends[last - 1]) if len(first) else np.zeros(0, U)
    distinct, back = np.unique(mix(norm + spread), return_inverse=True)
    words = np.bincount(back, weights=last - first, minlength=len(distinct)).astype(np.int64)
    lead = np.zeros(len(distinct), np.int64)
    lead[back] = np.arange(len(back))
    order = np.argsort(row[lead], kind="stable") if len(lead) else lead
    offsets = np.concatenate([[0], np.cumsum(np.bincount(row[lead[order]], minlength=n))])
    lines = pa.ListArray.from_arrays(
        pa.array(offsets, pa.int32()),
        pa.StructArray.from_arrays([pa.array(norm[lead[order]].view(np.int64)), pa.array(words[order])], ["line", "words"]))
    return n_words, chars, symbols, dup, repeat, lines


def measure(docs: DataFrame) -> DataFrame:
    """Per row: the base counts and ``lines``, its distinct line hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, bounds in slices(batch.column("text")):
                n = len(bounds) - 1
                n_words, chars, symbols, dup, repeat, lines = _measure(data, bounds)
                whole = lambda x: pa.array(np.asarray(x), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(row, n), batch.column("host").slice(row, n), batch.column("row").slice(row, n),
                     whole(n_words), whole(chars), whole(symbols), whole(dup), whole(repeat), lines],
                    names=["doc_id", "host", "row", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lines"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("host"),
                       F.xxhash64("doc_id", "source", "text").alias("row"), F.col("text").alias("text")).mapInArrow(run, COUNTS)


def judge(docs: DataFrame, limit: int = 20, min_left: float = 0.5,
          min_words: int = 50, max_repeat_percent: int = 50) -> DataFrame:
    """Base counts, n_removed_words (in lines above the limit),
    base_failed and kept, a row per input row."""
    counts = checkpointed(measure(docs))
    host = F.coalesce(F.concat(F.lit("1"), F.col("host")), F.lit("0"))
    lines = counts.where(F.col("doc_id").isNotNull()).select(
        host.alias("key"), "doc_id", "row", F.explode("lines").alias("l")).select("key", "doc_id", "row", "l.line", "l.words")
    frequent = (
        lines.groupBy("key", "line").agg(F.count_distinct("doc_id").alias("holders"))
        .where(F.col("holders") > limit)
        .select("key", "line", F.explode(F.sequence(F.lit(0), F.lit(SLICES - 1))).alias("slice"))
    )
    removed = (
        lines.withColumn("slice", F.pmod(F.xxhash64("doc_id"), F.lit(SLICES)).cast("int"))
        .join(frequent, ["key", "line", "slice"])
        .groupBy("row", "doc_id", "line").agg(F.first("words").alias("words"))
        .groupBy(F.col("row").alias("_row"), F.col("doc_id").alias("_id")).agg(F.sum("words").alias("gone"))
    )
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    gone = F.coalesce("gone", F.lit(0))
    return counts.join(removed, (F.col("row") == F.col("_row")) & (F.col("doc_id") == F.col("_id")), "left").select(
        "doc_id", F.col("host").alias("source"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        gone.alias("n_removed_words"), failed.alias("base_failed"),
        (~failed & (F.col("n_words") - gone >= F.lit(min_left) * F.col("n_words"))).alias("kept"))


def op5_quality_rules(docs: DataFrame) -> DataFrame:
    return judge(docs).drop("source")


OP5_SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
words AS (
  SELECT doc_id, source, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d
), three AS (
  SELECT doc_id, i, (w[i], w[i + 1], w[i + 2]) AS k
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 2)) AS i FROM words)
), again AS (
  SELECT doc_id, i FROM three QUALIFY count(*) OVER (PARTITION BY doc_id, k) > 1
), repeated AS (
  SELECT doc_id, count(DISTINCT i + s) AS n FROM again, (VALUES (0), (1), (2)) v(s) GROUP BY doc_id
), lines AS (
  SELECT doc_id, source, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n
  FROM (SELECT doc_id, source, unnest(string_split(t, chr(10))) AS line FROM d)
), own AS (SELECT * FROM lines WHERE n > 0),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM own GROUP BY doc_id),
keyed AS (
  SELECT doc_id, coalesce('1' || source, '0') AS host, n,
         translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM own
), common AS (
  SELECT host, k FROM keyed GROUP BY 1, 2 HAVING count(DISTINCT doc_id) > 20
), removed AS (
  SELECT doc_id, sum(n) AS n FROM keyed JOIN common USING (host, k) GROUP BY doc_id
), base AS (
  SELECT words.doc_id, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, coalesce(dup.n, 0) AS n_dup_lines,
         coalesce(repeated.n, 0) AS n_repeat_words, coalesce(removed.n, 0)::BIGINT AS n_removed_words
  FROM words LEFT JOIN dup USING (doc_id) LEFT JOIN repeated USING (doc_id) LEFT JOIN removed USING (doc_id)
)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND n_words - n_removed_words >= 0.5 * n_words AS kept
FROM base
"""
