"""Line deduplication across documents (native DataFrame functions only).

Method: hashes of lines are range-partitioned on (hash, document) and sorted by
(hash, document, position) in each range, so that even a line held by a third
of all documents is spread over many ranges.  A window streams over the sorted
range and lets through a line's first occurrence in each document; these are
counted per hash within the range, and the counts of a hash that straddles
ranges are merged.  The result is one compressed keep bitmap per document that
loses lines (the runs of lines it keeps), not text.

Defined cases: a NULL text is one empty line; a NULL doc_id never counts and
never loses lines; rows repeated with the same doc_id count as one document;
ties cannot occur, because the last holder is the largest doc_id; an empty
table gives empty results.  Input columns other than doc_id and text are
ignored by ``keep_bitmaps`` and passed through by ``drop_lines``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mktlens.llm.common import WHITE, checkpointed, lower_ascii, unused

# Each frequent line's verdict is repeated for this many slices of its documents.
SLICES = 32


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _version(text: Column) -> Column:
    """Tells apart rows that share a doc_id but not a text."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def line_hashes(docs: DataFrame, min_chars: int = 20) -> DataFrame:
    """(h1, h2, doc_id, pos, version, n_lines) of every line long enough to
    count; h1 and h2 are two independent 64-bit hashes of the line's key."""
    d = docs.where(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").alias("doc_id"),
        _version(F.col("text")).alias("version"),
        F.transform(_lines(lower_ascii(F.col("text"))), lambda x: F.btrim(x, F.lit(WHITE))).alias("keys"),
    )
    return (
        d.select("doc_id", "version", F.size("keys").alias("n_lines"), F.posexplode("keys").alias("pos", "key"))
        .where(F.length("key") >= min_chars)
        .select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("second"), "key").alias("h2"),
                "doc_id", "pos", "version", "n_lines")
    )


def first_occurrences(lines: DataFrame) -> DataFrame:
    """(h1, h2, doc_id) of each line's first occurrence in each document, in one
    stream over sorted ranges: the window asks for rows clustered by (h1, h2,
    doc_id) and sorted by position, which the ranges already are."""
    ranges = lines.select("h1", "h2", "doc_id", "pos").repartitionByRange("h1", "h2", "doc_id")
    seen = Window.partitionBy("h1", "h2", "doc_id").orderBy("pos")
    return (ranges.sortWithinPartitions("h1", "h2", "doc_id", "pos")
            .withColumn("nth", F.row_number().over(seen)).where(F.col("nth") == 1)
            .select("h1", "h2", "doc_id"))


def keep_bitmaps(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """One row per document that loses lines: doc_id, version, n_lines,
    n_dropped and ``keep``, the runs (start, length) of lines it keeps."""
    lines = checkpointed(line_hashes(docs, min_chars))
    frequent = (
        first_occurrences(lines).groupBy("h1", "h2")
        .agg(F.count(F.lit(1)).alias("holders"), F.max("doc_id").alias("last"))
        .where(F.col("holders") >= min_docs)
        .select("h1", "h2", "last", F.explode(F.sequence(F.lit(0), F.lit(SLICES - 1))).alias("slice"))
    )
    dropped = (
        lines.withColumn("slice", F.pmod(F.xxhash64("doc_id"), F.lit(SLICES)).cast("int"))
        .join(frequent, ["h1", "h2", "slice"])
        .where(F.col("doc_id") < F.col("last"))
        .groupBy("doc_id", "version")
        .agg(F.first("n_lines").alias("n_lines"), F.sort_array(F.collect_set("pos")).alias("gone"))
    )
    first = F.filter("gone", lambda x, i: (i == 0) | (F.get("gone", i - 1) != x - 1))
    last = F.filter("gone", lambda x, i: (i == F.size("gone") - 1) | (F.get("gone", i + 1) != x + 1))
    edges = dropped.select("doc_id", "version", "n_lines", F.size("gone").alias("n_dropped"),
                           F.concat(first, F.array("n_lines")).alias("stops"),
                           F.concat(F.array(F.lit(-1)), last).alias("starts"))
    runs = F.transform("starts", lambda s, i: F.struct((s + 1).alias("start"), (F.get("stops", i) - s - 1).alias("length")))
    return edges.select("doc_id", "version", "n_lines", "n_dropped",
                        F.filter(runs, lambda r: r["length"] > 0).alias("keep"))


def drop_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, counts: bool = True) -> DataFrame:
    """``docs`` with the lines outside each keep bitmap removed from ``text``,
    and with ``counts`` also ``_n_lines`` (before) and ``_n_dropped``, in place
    of columns that have these names."""
    id_, version, gone, keep = unused(docs, "_id", "_version", "_gone", "_keep")
    marks = keep_bitmaps(docs, min_chars, min_docs).select(
        F.col("doc_id").alias(id_), F.col("version").alias(version),
        F.col("n_dropped").alias(gone), F.col("keep").alias(keep))
    joined = docs.join(marks, (F.col("doc_id") == F.col(id_)) & (_version(F.col("text")) == F.col(version)), "left")
    lines = _lines(F.col("text"))
    kept = F.array_join(F.flatten(F.transform(keep, lambda r: F.slice(lines, r["start"] + 1, r["length"]))), "\n")
    extra = {
        "_n_lines": F.size(lines).cast("long"),
        "_n_dropped": F.coalesce(gone, F.lit(0)).cast("long"),
    } if counts else {}
    return joined.select(
        *[F.when(F.col(keep).isNull(), F.col("text")).otherwise(kept).alias("text") if c == "text" else F.col(f"`{c}`")
          for c in docs.columns if c.lower() not in extra],
        *[value.alias(name) for name, value in extra.items()],
    )


def op8_line_dedup(docs: DataFrame) -> DataFrame:
    out = drop_lines(docs.select("doc_id", "text"))
    return out.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"),
                      F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


OP8_SQL = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines
), common AS (
  SELECT k, max(doc_id) AS holder FROM keyed WHERE length(k) >= 20
  GROUP BY k HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT keyed.*, coalesce(doc_id <> holder, false) AS gone FROM keyed LEFT JOIN common USING (k)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
