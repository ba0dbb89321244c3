"""Window operators."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def sequence_number(partition: Sequence[str], order: Sequence[str | Column]) -> Column:
    """``row_number() over (partition by ... order by ...)``; callers pass a
    unique tie-breaker last so the numbering is deterministic."""
    return F.row_number().over(Window.partitionBy(*partition).orderBy(*order))


def moving_average(value: str, partition: Sequence[str], order: Sequence[str | Column],
                   rows: int = 3, scale: int | None = None) -> Column:
    """Average over the current and ``rows - 1`` preceding rows (a ROWS
    frame: missing periods are not filled)."""
    w = Window.partitionBy(*partition).orderBy(*order).rowsBetween(-(rows - 1), 0)
    avg = F.avg(F.col(value)).over(w)
    return F.round(avg, scale) if scale is not None else F.round(avg)


def lag_when(value: str, cond: Column, partition: Sequence[str],
             order: Sequence[str | Column]) -> Column:
    """``case when cond then lag(value) over w end``."""
    w = Window.partitionBy(*partition).orderBy(*order)
    return F.when(cond, F.lag(F.col(value), 1).over(w))


# ---------------------------------------------------------------------------
# Sequence operators that survive a hot key.
#
# A window partitioned by customer sends all of one customer's rows to one
# task; if one customer holds a third of the data, that task sorts a third of
# the data.  The operators below give the same results without a per-key
# partition:
#
# * ``row_number_by``: number rows within (key, ordered bucket) and add the
#   count of the key's rows in earlier buckets (one row per key and bucket).
# * ``lag_by_sequence``: a window over (key, slice of the sequence); the last
#   row of a slice is sent to the next one as well.
# * ``min_by_key``: an aggregate (partial aggregation map-side) joined back.
# ---------------------------------------------------------------------------
SLICE = 1024   # consecutive sequence numbers of a key that meet in one window


def _join_back(df: DataFrame, side: DataFrame, keys: Sequence[str], side_keys: Sequence[str],
               how: str, extra_cond=None) -> DataFrame:
    """Join ``side`` (whose columns all have unique ``__`` names) to ``df``
    on null-safe key equality, by column name only (no self-join ambiguity)."""
    cond = [F.col(k).eqNullSafe(F.col(sk)) for k, sk in zip(keys, side_keys)]
    if extra_cond is not None:
        cond.append(extra_cond)
    j = df.join(side, cond, how)
    return j.drop(*side_keys)


def row_number_by(df: DataFrame, partition: Sequence[str], order: Sequence[str], out: str,
                  bucket: Column | None = None) -> DataFrame:
    """Add ``out = row_number() over (partition by .. order by ..)``.  Order
    columns are ascending (NULLs first, Spark's default) and end with a
    unique tie-breaker.

    ``bucket`` splits a key's rows into ordered slices: it must be a function
    of the row that never decreases along ``order`` (e.g. the day or hour of
    the leading timestamp; NULL sorts first as it does in ``order``).  Rows
    are numbered within (key, bucket) and shifted by the number of the key's
    rows in earlier buckets (a small table: one row per key and bucket), so a
    key with a third of all rows is spread over its buckets.  Everything is a
    pure function of the rows, so a recomputed task gives the same numbers.
    Without ``bucket`` this is the plain window (one key, one task)."""
    if bucket is None:
        return df.withColumn(out, F.row_number().over(Window.partitionBy(*partition).orderBy(*order)))
    b = df.withColumn("__b", bucket)
    local = b.withColumn("__lrn", F.row_number().over(Window.partitionBy(*partition, "__b").orderBy(*order)))
    before = Window.partitionBy(*partition).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    side_keys = [f"__k_{c}" for c in partition]
    offsets = (b.groupBy(*partition, "__b").agg(F.count(F.lit(1)).alias("__cnt"))
               .select(*[F.col(c).alias(k) for c, k in zip(partition, side_keys)],
                       F.col("__b").alias("__k_b"),
                       F.coalesce(F.sum("__cnt").over(before), F.lit(0)).alias("__off")))
    j = _join_back(local, offsets, partition, side_keys, "inner", F.col("__b").eqNullSafe(F.col("__k_b")))
    return j.select(*df.columns, (F.col("__off") + F.col("__lrn")).cast("int").alias(out))


def lag_by_sequence(df: DataFrame, partition: Sequence[str], seq: str, cols: dict[str, str]) -> DataFrame:
    """Add ``alias = lag(col) over (partition by .. order by seq)`` for each
    ``alias: col`` of ``cols``; ``seq`` numbers a partition's rows without
    gaps.  A window sees SLICE consecutive rows of a key and the row before
    them, so a hot key is spread and nothing is joined."""
    own, last = F.floor(F.col(seq) / SLICE), F.col(seq) % SLICE == SLICE - 1
    once = F.array(F.struct(own.alias("slice"), F.lit(False).alias("copy")))
    twice = F.array(F.struct(own.alias("slice"), F.lit(False).alias("copy")),
                    F.struct((own + 1).alias("slice"), F.lit(True).alias("copy")))
    sent = df.withColumn("__s", F.explode(F.when(last, twice).otherwise(once)))
    sent = sent.select(*df.columns, F.col("__s.slice").alias("__slice"), F.col("__s.copy").alias("__copy"))
    w = Window.partitionBy(*partition, "__slice").orderBy(seq)
    follows = F.lag(seq).over(w) == F.col(seq) - 1
    out = sent.select("*", *[F.when(follows, F.lag(c).over(w)).alias(alias) for alias, c in cols.items()])
    return out.where(~F.col("__copy")).drop("__slice", "__copy")


def min_by_key(df: DataFrame, key: Sequence[str], col: str, out: str) -> DataFrame:
    """Add ``out = min(col)`` of the rows with the same ``key``, as ``left join
    (select key, min(col) .. group by key) using (key)`` does: a row with a
    NULL key gets NULL.  The join has the key's hash as one more column: a later
    aggregation by the key can't take over its partitioning, so that a task
    with a hot key may be split (each part then aggregates its own rows first)."""
    least = df.groupBy(*key).agg(F.min(col).alias(out))
    least = least.select(F.xxhash64(*key).alias("__hash"), *[F.col(k).alias(f"__k_{k}") for k in key], out)
    same = [F.xxhash64(*key) == F.col("__hash"), *[F.col(k) == F.col(f"__k_{k}") for k in key]]
    return df.join(least, same, "left").select(*df.columns, out)
