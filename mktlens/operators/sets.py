"""Set operators: bag union of name variants and unpivot of numbered slots."""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """``a union all b union all c`` (bag semantics, columns by name)."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def unpivot_slots(df: DataFrame, keep: Sequence[str], slots: Sequence[str] | str,
                  value: str, position: str | None = None) -> DataFrame:
    """One row per non-NULL slot: the ``union all`` over the slots as a single
    scan (``posexplode``).  ``slots`` lists the slot columns, or names one
    array column that holds them.  ``position`` (1-based) is kept when named."""
    arr = F.col(slots) if isinstance(slots, str) else F.array(*[F.col(s) for s in slots])
    out = df.select(*keep, F.posexplode(arr).alias("__pos", value)).where(F.col(value).isNotNull())
    if position:
        return out.withColumn(position, F.col("__pos") + 1).drop("__pos")
    return out.drop("__pos")
