"""Aggregate helpers with warehouse semantics Spark lacks as one call."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_nonnull_rows(cols: Sequence[str]) -> Column:
    """``count(t.*)``: rows whose listed columns are all non-NULL."""
    cond = None
    for c in cols:
        cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
    return F.count_if(cond)


def duplicate_keys(df: DataFrame, keys: Sequence[str], counted: str,
                   distinct: bool = False, op: str = ">", threshold: int = 1,
                   alias: str = "n") -> DataFrame:
    """``select keys, count([distinct] counted) from df group by keys having
    count(...) <op> threshold`` - key uniqueness tests."""
    agg = F.count_distinct(F.col(counted)) if distinct else F.count(F.col(counted))
    out = df.groupBy(*keys).agg(agg.alias(alias))
    cmp = {">": F.col(alias) > threshold, "=": F.col(alias) == threshold,
           ">=": F.col(alias) >= threshold}[op]
    return out.where(cmp)
