"""Joins the attribution plans need beyond plain equi joins.

* ``interval_join``        - equi key plus ``t between lo and hi`` (left or
  inner).  Optionally time-bucketed (several widths) so a customer with a
  huge history is split over many (key, level, bucket) join keys instead of
  one hash bucket that pairs every order with every feature.
* ``interval_aggregate``   - each interval with aggregates over the rows in it;
  the intervals are evaluated once and none is lost.
* ``wildcard_join``        - ``lower(text) like '%' || lower(name) || '%'``
  without a nested loop: each name is looked up by that of its interior words
  or grams which fewest texts hold, and the candidates are checked with
  ``contains`` (or LIKE when wildcards are wanted).
* ``null_aware_anti_join`` - ``x not in (select y ...)`` with SQL's NULL rules:
  a hash anti join and a scalar summary over one evaluation of the subquery.
* ``constant_row_join``    - left join without a condition to a small lookup.
* ``unmatched_rows``       - rows of a left join whose right side is NULL.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _keys(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def _epoch_seconds(df: DataFrame, name: str) -> Column:
    """Seconds since 1970-01-01 as a monotone function of the column's own
    values: instants via ``unix_seconds``; wall-clock timestamps and dates
    from their fields, so no session time zone (and no daylight-saving gap)
    can reorder them."""
    kind = df.schema[name].dataType.simpleString()
    c = F.col(name)
    if kind == "timestamp":
        return F.unix_seconds(c)
    days = F.datediff(F.to_date(c), F.lit("1970-01-01").cast("date")).cast("bigint") * 86400
    if kind == "date":
        return days
    return days + F.hour(c) * 3600 + F.minute(c) * 60 + F.floor(F.second(c))


# Bucket widths in seconds, each 32 times the one before.  A window takes the
# finest width at which it spans fewer than 32 buckets, so it is never much
# shorter than its buckets: windows of one key that do not overlap meet, per
# width, about three candidates per right row, however many rows fall in one day.
LINEAR_WIDTHS = tuple(32 ** i for i in range(6))


def interval_join(left: DataFrame, right: DataFrame, keys: str | Sequence[str],
                  lo: str, hi: str, t: str, how: str = "left",
                  bucket_seconds: int | Sequence[int] | None = None,
                  left_id: str | Sequence[str] | None = None, max_span: int = 32) -> DataFrame:
    """Join ``right`` rows whose ``t`` lies in ``[left.lo, left.hi]`` for the
    same ``keys``.  Key columns come out once (USING form).  NULL bounds match
    nothing, as ``between`` does.

    With ``bucket_seconds`` each left row is exploded over the time buckets
    its interval spans and each right row goes to the bucket of ``t``; the
    equi join then runs on ``keys + bucket``.  Every pair is produced once
    (a right row has one bucket).  Work is linear in
    ``sum(interval length) / bucket + rows`` instead of quadratic per key.
    ``bucket_seconds`` may list several widths (finest first): each left row
    then uses the finest width at which it spans fewer than ``max_span``
    buckets, so long intervals cost ``length / coarse width`` rows, and each
    right row is keyed once per width.
    For a left join, ``left_id`` (columns unique in ``left``) lets the
    matches be joined back by key; without it unmatched rows are found by a
    null-safe anti join on all left columns.
    """
    keys = _keys(keys)
    if how not in ("left", "inner"):
        raise ValueError("interval_join supports how='left' or 'inner'")
    in_range = F.col(t).between(F.col(lo), F.col(hi))
    if bucket_seconds is None:
        cond = [F.col(f"__l.{k}") == F.col(f"__r.{k}") for k in keys]
        joined = left.alias("__l").join(right.alias("__r"), cond + [
            F.col(f"__r.{t}").between(F.col(f"__l.{lo}"), F.col(f"__l.{hi}"))], how)
        return joined.select(*[F.col(f"__l.{k}").alias(k) for k in keys],
                             *[F.col(f"__l.{c}") for c in left.columns if c not in keys],
                             *[F.col(f"__r.{c}") for c in right.columns if c not in keys])

    right_cols = [c for c in right.columns if c not in keys]
    if how == "left" and left_id:
        ids = [left_id] if isinstance(left_id, str) else list(left_id)
        carried = list(dict.fromkeys([*keys, *ids, lo, hi]))
    else:
        carried = left.columns
    matches = bucketed_pairs(left, right, keys, lo, hi, t, bucket_seconds, max_span, carried).where(in_range)
    cols = [*keys, *[c for c in left.columns if c not in keys], *right_cols]
    if how == "inner":
        return matches.select(*cols)
    if left_id:
        # left join back on the caller's unique key: no generated ids, so a
        # recomputed task attaches matches to the same rows
        side = matches.select(*[F.col(c).alias(f"__i_{c}") for c in ids], *right_cols)
        cond = [F.col(c).eqNullSafe(F.col(f"__i_{c}")) for c in ids]
        return left.join(side, cond, "left").drop(*[f"__i_{c}" for c in ids]).select(*cols)
    # no key: matched rows, plus left rows none of whose copies matched
    # (identical rows share their matches, so a null-safe anti join on all
    # left columns is exact under bag semantics)
    matched = matches.select(*[F.col(c).alias(f"__m_{c}") for c in left.columns]).distinct()
    cond = [F.col(c).eqNullSafe(F.col(f"__m_{c}")) for c in left.columns]
    unmatched = left.join(matched, cond, "left_anti")
    for c in right_cols:
        unmatched = unmatched.withColumn(c, F.lit(None).cast(right.schema[c].dataType))
    return matches.select(*cols).unionByName(unmatched.select(*cols))


def _time_buckets(left: DataFrame, lo: str, hi: str, levels: Sequence[int], max_span: int) -> tuple[Column, Column]:
    """(level, buckets) of an interval: the finest width at which it spans at
    most ``max_span`` buckets (else the coarsest), so short windows stay precise
    and a window of years does not explode into thousands of rows; and the
    numbers of the buckets, NULL for an interval that holds nothing."""
    lo_s, hi_s = _epoch_seconds(left, lo), _epoch_seconds(left, hi)
    level = F.lit(len(levels) - 1)
    for i in reversed(range(len(levels) - 1)):
        w = levels[i]
        level = F.when(F.floor(hi_s / w) - F.floor(lo_s / w) < max_span, F.lit(i)).otherwise(level)
    width = F.element_at(F.array(*[F.lit(w) for w in levels]), level + 1)
    first, last = F.floor(lo_s / width), F.floor(hi_s / width)
    return level, F.when(first <= last, F.sequence(first, last))


def _bucketed_points(right: DataFrame, t: str, levels: Sequence[int]) -> DataFrame:
    """``right`` once per level, with ``__lvl`` and the bucket ``__b`` of ``t``."""
    t_s = _epoch_seconds(right, t)
    keyed = right.withColumn("__lb", F.explode(F.array(*[
        F.struct(F.lit(i).alias("__lvl"), F.floor(t_s / w).alias("__b")) for i, w in enumerate(levels)])))
    return keyed.select("*", "__lb.__lvl", "__lb.__b").drop("__lb")


def _widths(bucket_seconds: int | Sequence[int]) -> list[int]:
    return [bucket_seconds] if isinstance(bucket_seconds, int) else sorted(bucket_seconds)


def bucketed_pairs(left: DataFrame, right: DataFrame, keys: Sequence[str], lo: str, hi: str, t: str,
                   bucket_seconds: int | Sequence[int], max_span: int, carried: Sequence[str]) -> DataFrame:
    """Candidates of ``interval_join`` (before the range check): the pairs
    that share a key and a time bucket; every true pair is one of them, once."""
    levels = _widths(bucket_seconds)
    level, buckets = _time_buckets(left, lo, hi, levels, max_span)
    spans = left.select(*carried, level.alias("__lvl"), F.explode(buckets).alias("__b"))
    # a right row has one bucket per level and a left row uses one level, so
    # every (left, right) pair meets exactly once
    return spans.join(_bucketed_points(right, t, levels), [*keys, "__lvl", "__b"], "inner").drop("__lvl", "__b")


# Rows of NULLs that stand for "no right row" in ``interval_aggregate``: each
# left row meets one of them, chosen by its hash, so none is a hot key.
MARKS = 4096


def interval_aggregate(left: DataFrame, right: DataFrame, keys: str | Sequence[str], lo: str, hi: str, t: str,
                       aggs: Sequence[Column], bucket_seconds: int | Sequence[int] = LINEAR_WIDTHS,
                       max_span: int = 32) -> DataFrame:
    """Every row of ``left`` with aggregates over the ``right`` rows of the same
    ``keys`` whose ``t`` lies in ``[lo, hi]``.

    ``left`` is evaluated once: each of its rows also meets one row of NULLs, so
    a row without any match passes through the same inner join (either side of
    which AQE may split) and nothing is joined back.  The aggregates therefore
    see one row of NULLs besides the matches and must skip it, as ``count(x)``,
    ``count_if``, ``sum`` and ``max`` do and ``count(*)`` does not.  NULL keys
    and bounds match nothing.  Rows of ``left`` must differ from one another;
    apart from ``keys`` the two sides share no column name."""
    keys = _keys(keys)
    levels = _widths(bucket_seconds)
    level, buckets = _time_buckets(left, lo, hi, levels, max_span)
    none = F.array().cast("array<bigint>")
    spans = left.select("*", level.alias("__l"), F.explode(F.concat(
        F.array(F.lit(None).cast("bigint")), F.coalesce(buckets, none))).alias("__n"))
    mark = F.col("__n").isNull()
    join_keys = [f"__k{i}" for i in range(len(keys))]
    spans = spans.select(
        *left.columns, *[F.when(~mark, F.col(k)).alias(j) for k, j in zip(keys, join_keys)],
        F.when(mark, -1).otherwise(F.col("__l")).alias("__lvl"),
        F.when(mark, F.pmod(F.xxhash64(*left.columns), F.lit(MARKS))).otherwise(F.col("__n")).alias("__b"))

    points = _bucketed_points(right, t, levels).withColumn("__mark", F.lit(False))
    for k in keys:
        points = points.where(F.col(k).isNotNull())
    marks = left.sparkSession.range(MARKS).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema],
        F.lit(-1).alias("__lvl"), F.col("id").alias("__b"), F.lit(True).alias("__mark"))
    points = points.unionByName(marks)
    points = points.select(*[F.col(k).alias(f"__r{i}") for i, k in enumerate(keys)],
                           *[c for c in points.columns if c not in keys]).withColumnsRenamed({"__lvl": "__rl", "__b": "__rb"})
    same = [F.col(j).eqNullSafe(F.col(f"__r{i}")) for i, j in enumerate(join_keys)]
    met = spans.join(points, [*same, F.col("__lvl") == F.col("__rl"), F.col("__b") == F.col("__rb")])
    return met.where(F.col("__mark") | F.col(t).between(F.col(lo), F.col(hi))).groupBy(*left.columns).agg(*aggs)


def _metachar(c: Column) -> Column:
    return c.contains("_") | c.contains("%")


def _like_pattern(n: Column) -> Column:
    """``'%' || n || '%'`` with backslashes doubled: the warehouse's LIKE has
    no escape character, Spark's defaults to backslash."""
    return F.concat(F.lit("%"), F.replace(n, F.lit("\\"), F.lit("\\\\")), F.lit("%"))


TOKEN_SEPARATOR = "[^\\p{L}\\p{N}]+"
# A key of very many texts is spread over this many slices of them (a power of two).
KEY_SLICES = 16


def _match(t: Column, n: Column, wildcards: bool) -> Column:
    if wildcards:
        return F.like(t, _like_pattern(n))
    return t.contains(n)


def _interior_words(n: Column, wildcards: bool) -> Column:
    """The words of a (lower-cased) name that have a separator on both sides
    inside it.  Wherever the name occurs in a text, each of them is a whole
    word of the text split the same way.  None when the name has no such word
    or (in wildcard mode) contains ``_``/``%``, which could stand for letters."""
    none = F.array().cast("array<string>")
    parts = F.split(n, TOKEN_SEPARATOR, -1)
    inner = F.when(F.size(parts) >= 3, F.slice(parts, 2, F.size(parts) - 2)).otherwise(none)
    return F.when(_metachar(n), none).otherwise(inner) if wildcards else inner


def _overlapping(x: Column, g: int) -> Column:
    """Every g-gram of a text in one regex pass (a zero-width lookahead that
    captures g characters), no lambda per position."""
    return F.regexp_extract_all(x, F.lit(f"(?s)(?=(.{{{g}}}))"), F.lit(1)) if g else F.array(F.lit(""))


def name_keys(right: DataFrame, name: str, q: int, wildcards: bool) -> tuple[DataFrame, DataFrame]:
    """(keys, needs) of the distinct lower-cased names.

    ``keys`` (n, key, n_keys): what every text with the name must hold - the
    name's interior words or, of a name without any, the overlapping grams of
    ``q`` characters (of fewer if it is shorter; in wildcard mode those of its
    longest literal run).  ``needs``, one row: whether texts have to tell their
    words, and the lengths of the grams they have to tell."""
    n, seed = F.col("__n"), F.col("__n")
    if wildcards:
        longest = F.element_at(F.array_sort(F.split(n, "[_%]"), lambda a, b: F.length(b) - F.length(a)), 1)
        seed = F.when(_metachar(n), longest).otherwise(n)
    names = (right.where(F.col(name).isNotNull()).select(F.lower(F.col(name)).alias("__n")).distinct()
             .select("__n", _interior_words(n, wildcards).alias("__words"), seed.alias("__seed"))
             .withColumn("__g", F.least(F.length("__seed"), F.lit(q))))
    grams = F.transform(F.sequence(F.lit(1), F.length("__seed") - F.col("__g") + 1),
                        lambda i: F.substr(F.col("__seed"), i, F.col("__g")))
    worded = F.size("__words") > 0
    keys = F.array_distinct(F.transform(F.when(worded, F.col("__words")).otherwise(grams), lambda k: F.xxhash64(k)))
    needs = names.agg(F.coalesce(F.bool_or(worded), F.lit(False)).alias("__want_words"),
                      F.collect_set(F.when(~worded, F.col("__g"))).alias("__want_grams"))
    keyed = names.select("__n", keys.alias("__keys"))
    return keyed.select("__n", F.explode("__keys").alias("__key"), F.size("__keys").alias("__n_keys")), needs


def _slices() -> Column:
    """A row for each slice of the texts."""
    return F.explode(F.array(*[F.lit(i).cast("bigint") for i in range(KEY_SLICES)])).alias("__slice")


def text_keys(texts: DataFrame, text: str, needs: DataFrame, wanted: DataFrame, q: int) -> DataFrame:
    """Distinct (h, slice, key): the words and grams of each text (h is the hash
    of the lower-cased text, slice its last bits) that are keys of some name.

    A word may be in every text, and be no name's key: the names' keys meet the
    texts' by key and slice, so that no task gets all texts that hold a word."""
    none = F.array().cast("array<string>")
    lt = F.lower(F.col(text))
    told = constant_row_join(texts.where(F.col(text).isNotNull()).select(lt.alias("__t")), needs)
    words = F.when(F.col("__want_words"), F.split("__t", TOKEN_SEPARATOR, -1)).otherwise(none)
    grams = [F.when(F.array_contains("__want_grams", F.lit(g)), _overlapping(F.col("__t"), g)).otherwise(none) for g in range(q + 1)]
    held = told.select(F.xxhash64("__t").alias("__h"), F.explode(F.array_distinct(F.concat(words, *grams))).alias("__k"))
    # never NULL, so that both uses of the texts' keys plan one exchange
    held = held.select("__h", F.col("__h").bitwiseAND(F.lit(KEY_SLICES - 1)).alias("__slice"), F.xxhash64("__k").alias("__key"))
    # dealt out here, so that Spark sees how many they are before it broadcasts them
    sliced = wanted.select("__key").distinct().select("__key", _slices()).repartition("__key", "__slice")
    return held.join(sliced, ["__key", "__slice"], "left_semi").distinct()


def wildcard_join(left: DataFrame, right: DataFrame, text: str, name: str, how: str = "left",
                  q: int = 4, wildcards: bool = False, texts_repeat: bool = False) -> DataFrame:
    """``left join right on lower(left.text) like '%' || lower(right.name) || '%'``.

    Default (``wildcards=False``) treats the name literally (``contains``); the
    warehouse's LIKE would let ``_`` and ``%`` inside names act as wildcards,
    which ``wildcards=True`` reproduces (no escape character).

    One lazy plan for any number of names, without a nested loop and without a
    read by the driver.  Texts tell which of the names' words and grams they
    hold (``text_keys``); the number of texts that hold each is counted; a name
    is looked up by its key that fewest texts hold, and not at all if one of
    its keys is in no text.  Texts that hold the key are candidates; the pair
    itself is checked where the candidates meet the rows of ``left``, so hashes
    need not be unique for an exact result.  A frequent word, a name's key or
    not, is spread over ``KEY_SLICES`` slices of its texts.  Rows of ``left`` are moved once at
    most, and not at all when the candidates are few enough to be broadcast;
    keys are distinct per text, so repeated texts share their candidates.

    ``texts_repeat`` matches the distinct texts and joins the rows back: worth
    it for short texts that many rows share.  Exact for every name, short and
    empty ones included; a NULL text or name matches nothing.
    """
    if how not in ("left", "inner"):
        raise ValueError("wildcard_join supports how='left' or 'inner'")
    if texts_repeat:
        own = left.select(F.col(text).alias("__text")).where(F.col("__text").isNotNull()).distinct()
        found = wildcard_join(own, right, "__text", name, "inner", q, wildcards)
        return left.join(found, F.col(text) == F.col("__text"), how).drop("__text")
    keyed, needs = name_keys(right, name, q, wildcards)
    held = text_keys(left, text, needs, keyed, q)
    rarity = held.groupBy("__key").agg(F.count(F.lit(1)).alias("__texts"))
    rarest = (keyed.join(rarity, "__key").groupBy("__n")
              .agg(F.count(F.lit(1)).alias("__found"), F.first("__n_keys").alias("__n_keys"),
                   F.min(F.struct("__texts", "__key")).alias("__best"))
              .where(F.col("__found") == F.col("__n_keys"))
              .select("__n", F.col("__best.__key").alias("__key"), _slices()))
    candidates = held.join(rarest, ["__key", "__slice"]).select("__h", "__n")
    named = right.withColumn("__name", F.lower(F.col(name)))
    found = candidates.join(named, F.col("__n") == F.col("__name")).drop("__n").withColumnRenamed("__h", "__of")
    own = left.withColumn("__h", F.xxhash64(F.lower(F.col(text))))
    pairs = own.join(found, (F.col("__h") == F.col("__of")) & _match(F.lower(F.col(text)), F.col("__name"), wildcards), how)
    return pairs.drop("__h", "__of", "__name")


def null_aware_anti_join(left: DataFrame, right: DataFrame, left_key: str,
                         right_key: str | None = None) -> DataFrame:
    """``left where left_key not in (select right_key from right)``.

    SQL rules: an empty subquery keeps every row (NULL keys too); a NULL in
    the subquery keeps no row; otherwise NULL keys are dropped.  The subquery
    is evaluated once, as its distinct keys: a hash anti join uses them, and so
    does the one-row summary, a scalar that the filter names once (each naming
    would plan it again): 0 - no keys, 1 - keys, 2 - NULL among them.  Keys travel
    in a struct, which is never NULL itself: a filter on NULL keys would give the
    two uses different plans.
    """
    rk = right_key or left_key
    keys = right.select(F.struct(F.col(rk).alias("k")).alias("__k")).distinct()
    told = keys.agg(F.when(F.count_if(F.col("__k.k").isNull()) > 0, 2).when(F.count(F.lit(1)) > 0, 1).otherwise(0).alias("held")).scalar()
    kept = left.withColumn("__l", F.struct(F.col(left_key).alias("k"))).join(keys, F.col("__l") == F.col("__k"), "left_anti").drop("__l")
    return kept.where(F.get(F.array(F.lit(True), F.col(left_key).isNotNull(), F.lit(False)), told))


def constant_row_join(left: DataFrame, rows: DataFrame) -> DataFrame:
    """Left join without condition to a lookup, as a rule one row (a filtered
    lookup or a global aggregate).  Left rows are kept when it is empty, and
    come once per row when it has several."""
    return left.join(rows, F.lit(True), "left")


def unmatched_rows(joined: DataFrame, right_marker: str) -> DataFrame:
    """Rows of a left join whose right side found nothing."""
    return joined.where(F.col(right_marker).isNull())
