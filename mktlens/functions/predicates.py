"""Predicates: case-folded wildcard tests and first-match bucketing."""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from mktlens.functions.scalars import col_of

__all__ = ["like_ci", "like_any", "bucket_first_match", "not_like_prefix", "all_of", "any_of"]


def like_ci(c, pattern: str) -> Column:
    """``lower(c) like pattern``.  A pure ``%p%`` pattern becomes ``contains``
    (no regex, no LIKE state machine); anything else stays LIKE."""
    low = F.lower(col_of(c))
    body = pattern[1:-1] if len(pattern) >= 2 and pattern[0] == pattern[-1] == "%" else None
    if body is not None and "%" not in body and "_" not in body and "\\" not in body:
        return low.contains(body)
    return low.like(pattern)


def any_of(preds: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, preds)


def all_of(preds: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, preds)


def like_any(c, patterns: Sequence[str]) -> Column:
    return any_of(like_ci(c, p) for p in patterns)


def bucket_first_match(c, table: Sequence[tuple[Sequence[str], str]]) -> Column:
    """CASE over ``(patterns, label)`` rows: the first row with a matching
    pattern wins, no match gives NULL."""
    expr = None
    for patterns, label in table:
        cond = like_any(c, patterns)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(None).cast("string"))


def not_like_prefix(c, prefix: str) -> Column:
    """``c not like 'prefix%'`` with SQL NULL semantics (NULL in, NULL out)."""
    return ~col_of(c).startswith(prefix)
