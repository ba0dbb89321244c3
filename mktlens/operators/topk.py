"""Top-k rows by an ordering (``select top k ... order by``)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Groups that each keep their own best k rows, level by level.
FAN_IN = (4096, 64)
# Candidate cuts of the leading column, each at twice the share of the one before.
SHARES = tuple(2.0 ** -i for i in range(32, -1, -1))


def _cut(df: DataFrame, lead: str, k: int) -> Column:
    """The smallest of the candidate cuts at or below which ``lead`` has ``k``
    rows, as a scalar; NULL if none has.  The candidates are quantiles from a
    merged sketch; which of them is enough is decided by exact counts."""
    cuts = df.agg(F.percentile_approx(F.col(lead), list(SHARES), 10_000).alias("c")).scalar()
    candidates = [F.get(cuts, F.lit(i)) for i in range(len(SHARES))]
    counted = df.agg(F.array(*[F.struct(F.count_if(F.col(lead) <= c).alias("rows"), F.max(c).alias("cut")) for c in candidates]).alias("t"))
    enough = F.filter("t", lambda x: x["rows"] >= k)
    return counted.select(F.get(enough, F.lit(0))["cut"]).scalar()


def top_k(df: DataFrame, order: Sequence[str | Column], k: int, lead: str | None = None) -> DataFrame:
    """First ``k`` rows by ``order``.  Callers end ``order`` with a unique key
    so ties cannot change the result.

    ``lead`` names a numeric, date or timestamp column that ``order`` begins
    with, ascending and NULLs last: rows beyond a cut that ``k`` rows reach are
    filtered at the scan, so what is shuffled follows ``k`` (and the ties at the
    cut), not the table.  The rest is merged in levels: rows are spread by their
    hash over ``FAN_IN`` groups whose best ``k`` survive, so no task receives
    ``k`` rows from every scan task."""
    kept = df
    if lead is not None:
        cut = _cut(df, lead, k)
        kept = df.where(cut.isNull() | (F.col(lead) <= cut))
    for groups in FAN_IN:
        group = F.pmod(F.xxhash64(*df.columns), F.lit(groups))
        kept = (kept.withColumn("__g", group)
                .withColumn("__rank", F.row_number().over(Window.partitionBy("__g").orderBy(*order)))
                .where(F.col("__rank") <= k).drop("__g", "__rank"))
    return kept.orderBy(*order).limit(k)
