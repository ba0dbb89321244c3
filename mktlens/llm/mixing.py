"""Mixing sources to target weights (native DataFrame functions only).

Method: a multivariate-hypergeometric splitting tree.  Every source is laid
out as blocks of whole documents in hash order; its target gives an exact
quota of blocks (whole passes first, then permuted blocks, the last one
trimmed to the word).  Starting from all quotas, each node of a binary tree
over the output shards draws how many blocks of every source go left, by
conditional hypergeometric draws; the leaves then hold the quota of each
(shard, source), take disjoint ranges of the permuted blocks, and every shard
orders its documents locally by a hash.

Cost: one thin row per document (no text) is shuffled by (source, hash
bucket), so a source that holds a third of all rows is spread over 4,096
buckets; cumulative sums run within a bucket and over bucket totals.  The tree
handles one array of quotas per node, one entry per source.

Defined cases: a NULL or wordless text has size 0 and is never taken; a NULL
source is a source of its own, last; rows repeated with the same doc_id,
source and text are drawn alike; all draws are hashes of the seed, so reruns
agree; an empty table gives an empty result.  Extra columns pass through
``mix_documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mktlens.llm.common import WORD, checkpointed, unused

BUCKET_BITS = 12
SHARD_WORDS = 1 << 24   # words of the mixture a shard takes at most, about 100 MB of text
BLOCK_WORDS = 1 << 22   # words of a block at most, but for one longer document


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _source_key(source: Column) -> Column:
    return F.when(source.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), source))


def _version(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _unit(expr_seed: int, *cols) -> Column:
    """A uniform double in [0, 1) from a hash."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(expr_seed), *cols), 11).cast("double") / F.lit(float(1 << 53))


def document_sizes(docs: DataFrame, seed: int) -> DataFrame:
    """Distinct (key, source, doc_id, version) rows with their size, how often
    the row is repeated, and their start on the source's axis of words."""
    h = F.xxhash64(F.lit(seed), F.col("doc_id"), _version(F.col("text")))
    thin = docs.select(
        _source_key(F.col("source")).alias("key"), F.col("source").alias("source"), F.col("doc_id").alias("doc_id"),
        _version(F.col("text")).alias("version"), h.alias("h"),
        F.shiftrightunsigned(h, 64 - BUCKET_BITS).cast("int").alias("bucket"),
        word_count(F.col("text")).alias("size"),
    )
    units = checkpointed(
        thin.repartition("key", "bucket")
        .groupBy("key", "bucket", "h", "source", "doc_id", "version", "size").agg(F.count(F.lit(1)).alias("copies"))
    )
    totals = units.groupBy("key", "bucket").agg(F.sum(F.col("size") * F.col("copies")).alias("words"))
    before = totals.select("key", "bucket", (
        F.sum("words").over(Window.partitionBy("key").orderBy("bucket")) - F.col("words")).alias("base"))
    width = F.col("size") * F.col("copies")
    in_bucket = Window.partitionBy("key", "bucket").orderBy("h", "doc_id", "version").rowsBetween(Window.unboundedPreceding, 0)
    return (
        units.withColumn("inside", F.sum(width).over(in_bucket) - width)
        .join(before, ["key", "bucket"])
        .withColumn("begin", F.col("base") + F.col("inside"))
        .drop("base", "inside")
    )


def source_targets(units: DataFrame, ratio: float, weights: tuple, cap: float) -> DataFrame:
    """(key, source_size, target) per source: weights dealt in code point order,
    and the excess over ``cap`` times a source's size reshared by weight."""
    sums = units.groupBy("key").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"),
                                    F.first("source").alias("source"))
    w = F.array(*[F.lit(float(x)) for x in weights])
    order = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sums.withColumn("rank", F.row_number().over(order)).withColumn(
        "weight", F.get(w, (F.col("rank") - 1) % F.lit(len(weights))))
    limit = F.col("source_size") * F.lit(float(cap))
    fill = Window.orderBy(F.col("limit") / F.col("weight"), "rank")
    level = (
        ranked.withColumn("limit", limit)
        .withColumn("full_before", F.sum("limit").over(fill) - F.col("limit"))
        .withColumn("weight_left", F.sum("weight").over(fill.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("total", F.sum("source_size").over(Window.partitionBy()))
        .withColumn("level", (F.col("total") * F.lit(float(ratio)) - F.col("full_before")) / F.col("weight_left"))
        # the level at which the first source stays under its limit is the largest of those that do
        .withColumn("share", F.max(F.when(F.col("level") < F.col("limit") / F.col("weight"), F.col("level"))).over(Window.partitionBy()))
    )
    return level.select("key", "rank", "source_size",
                        F.coalesce(F.least("limit", F.col("share") * F.col("weight")), F.col("limit")).alias("target"))


def _walk(n: str, k: str, m: str, u: str) -> str:
    """SQL for a hypergeometric draw: of ``n`` blocks, ``k`` marked, ``m`` taken;
    inverts the distribution at ``u``, term by term outwards from the mode."""
    up = f"CAST(({k} - j) * ({m} - j) AS DOUBLE) / ((j + 1) * ({n} - {k} - {m} + j + 1))"
    down = f"CAST(j * ({n} - {k} - {m} + j) AS DOUBLE) / (({k} - j + 1) * ({m} - j + 1))"
    return f"""
      aggregate(array(struct(greatest(0L, {m} + {k} - {n}) AS lo, least({m}, {k}) AS hi,
                             CAST(floor(CAST(({m} + 1) * ({k} + 1) AS DOUBLE) / ({n} + 2)) AS BIGINT) AS mode)), 0L, (z, p) ->
        aggregate(array(struct(
          if(p.hi > p.mode, sequence(p.mode, p.hi - 1), CAST(array() AS ARRAY<BIGINT>)) AS ups,
          if(p.mode > p.lo, sequence(p.mode, p.lo + 1, -1L), CAST(array() AS ARRAY<BIGINT>)) AS downs)), 0L, (z2, q) ->
          aggregate(array({u} * (1D
              + aggregate(q.ups, struct(1D AS w, 0D AS t), (r, j) -> struct(r.w * ({up}) AS w, r.t + r.w * ({up}) AS t), r -> r.t)
              + aggregate(q.downs, struct(1D AS w, 0D AS t), (r, j) -> struct(r.w * ({down}) AS w, r.t + r.w * ({down}) AS t), r -> r.t)) - 1D),
            0L, (z3, rest) -> if(rest < 0, p.mode,
              aggregate(q.downs,
                aggregate(q.ups, struct(1D AS w, rest AS x, p.mode AS v),
                  (r, j) -> if(r.x < 0, r, struct(r.w * ({up}) AS w, r.x - r.w * ({up}) AS x, j + 1 AS v)),
                  r -> struct(1D AS w, r.x AS x, if(r.x < 0, r.v, p.mode) AS v)),
                (r, j) -> if(r.x < 0, r, struct(r.w * ({down}) AS w, r.x - r.w * ({down}) AS x, j - 1 AS v)),
                r -> r.v)))))"""


def split_quotas(quotas: DataFrame, levels: int, seed: int) -> DataFrame:
    """(rank, quota) per source -> (shard, rank, blocks) for 2**levels shards."""
    nodes = quotas.groupBy().agg(F.sort_array(F.collect_list(F.struct("rank", "quota"))).alias("q")).select(
        F.lit(0).alias("node"), F.col("q.rank").alias("ranks"), F.col("q.quota").alias("counts"))
    total = "aggregate(counts, 0L, (s, x) -> s + x)"
    for level in range(levels):
        u = f"CAST(shiftrightunsigned(xxhash64({seed}, {level}, node, size(s.out)), 11) AS DOUBLE) / {float(1 << 53)}D"
        draw = _walk("s.n", "x", "s.m", "s.u")
        left = nodes.withColumn("total", F.expr(total)).withColumn("left", F.expr(f"""
          aggregate(counts, struct(total AS n, total - total div 2 AS m, CAST(array() AS ARRAY<BIGINT>) AS out),
            (s, x) -> aggregate(array(struct(s.n AS n, s.m AS m, {u} AS u)), s, (o, s) ->
              aggregate(array({draw}), o, (o2, d) -> struct(o2.n - x AS n, o2.m - d AS m, concat(o2.out, array(d)) AS out))),
            s -> s.out)"""))
        nodes = left.select("ranks", F.explode(F.expr(
            "array(struct(node * 2 AS node, left AS counts),"
            " struct(node * 2 + 1 AS node, zip_with(counts, left, (a, b) -> a - b) AS counts))")).alias("c")).select(
            F.col("c.node").alias("node"), "ranks", F.col("c.counts").alias("counts"))
        if level % 8 == 7:
            nodes = nodes.repartition("node")
    return nodes.select(F.col("node").alias("shard"), F.explode(F.arrays_zip("ranks", "counts")).alias("x")).select(
        "shard", F.col("x.ranks").alias("rank"), F.col("x.counts").alias("blocks"))


def mixing_plan(docs: DataFrame, ratio: float = 1.5, weights: tuple = (5, 2, 1), cap: float = 2.0,
                blocks: int = 256, shard_levels: int | None = None, seed: int = 7) -> DataFrame:
    """One row per distinct document row: doc_id, version, key, size,
    source_size, target, and ``draws``, an array of (pass, shard, words): what
    each shard takes from the start of the text.  There are 2**shard_levels
    shards, by default as many as keep one within SHARD_WORDS, 16 at least."""
    units = document_sizes(docs, seed)
    targets = checkpointed(source_targets(units, ratio, weights, cap))
    if shard_levels is None:
        taken = targets.agg(F.sum("target")).first()[0] or 0
        shard_levels = max(4, (int(taken) // SHARD_WORDS).bit_length())
    span = F.least(F.lit(BLOCK_WORDS), F.greatest(F.lit(1), F.ceil(F.col("source_size") / F.lit(float(blocks))))).cast("long")
    # a row per bucket, so that a source's documents stay where their buckets are
    spread = targets.withColumn("bucket", F.explode(F.sequence(F.lit(0), F.lit((1 << BUCKET_BITS) - 1))))
    placed = units.join(spread, ["key", "bucket"]).drop("bucket").withColumn("block", F.floor(F.col("begin") / span).cast("long"))
    block = placed.where(F.col("size") > 0).groupBy("key", "rank", "block").agg(
        F.sum(F.col("size") * F.col("copies")).alias("words"), F.min("begin").alias("first"), F.first("target").alias("target"))
    # whole passes over the permuted blocks, until the target is reached
    passes = int(-(-cap // 1))
    offered = block.select("*", F.explode(F.sequence(F.lit(0), F.lit(passes - 1))).alias("pass"))
    order = Window.partitionBy("key").orderBy("pass", F.xxhash64(F.lit(seed), "pass", "key", "block"), "block")
    drawn = (
        offered.withColumn("cum", F.sum("words").over(order) - F.col("words"))
        .withColumn("entry", F.row_number().over(order) - 1)
        .withColumn("take", F.least("words", F.round("target").cast("long") - F.col("cum")))
        .where(F.col("take") > 0)
    )
    drawn = checkpointed(drawn.select("key", "rank", "block", "first", "pass", "entry", "take"))
    leaves = split_quotas(drawn.groupBy("rank").agg(F.count(F.lit(1)).alias("quota")), shard_levels, seed)
    upto = F.sum("blocks").over(Window.partitionBy("rank").orderBy("shard"))
    ranges = leaves.withColumn("upto", upto).where(F.col("blocks") > 0).select(
        "rank", "shard", F.explode(F.sequence(F.col("upto") - F.col("blocks"), F.col("upto") - 1)).alias("entry"))
    dealt = (
        drawn.join(ranges, ["rank", "entry"])
        .groupBy("key", "block")
        .agg(F.first("first").alias("first"), F.sort_array(F.collect_list(F.struct("pass", "shard", "take"))).alias("dealt"))
    )
    words = lambda d: F.greatest(F.lit(0), F.least(
        F.col("size"), F.floor((d["take"] - (F.col("begin") - F.col("first"))) / F.col("copies")).cast("long")))
    draws = F.filter(
        F.transform(F.when(F.col("size") > 0, F.col("dealt")),
                    lambda d: F.struct(d["pass"].alias("pass"), d["shard"].alias("shard"), words(d).alias("words"))),
        lambda d: d["words"] > 0)
    return placed.join(dealt, ["key", "block"], "left").select(
        "doc_id", "version", "key", "copies", "size", "source_size", "target",
        F.coalesce(draws, F.expr("CAST(array() AS ARRAY<STRUCT<pass: INT, shard: INT, words: BIGINT>>)")).alias("draws"))


def mix_documents(docs: DataFrame, seed: int = 7, **kwargs) -> DataFrame:
    """The mixture: one row per draw, with the columns of ``docs`` (and n_chars
    brought up to date where present), partitioned by shard and shuffled
    within it.  A trimmed document keeps its first words, joined by blanks."""
    id_, version, key, size, draw, shard, place = unused(
        docs, "_id", "_version", "_key", "_size", "_draw", "_shard", "_place")
    plan = mixing_plan(docs, seed=seed, **kwargs).select(
        F.col("doc_id").alias(id_), F.col("version").alias(version), F.col("key").alias(key),
        F.col("size").alias(size), F.explode("draws").alias(draw))
    j = docs.join(plan, F.col("doc_id").eqNullSafe(F.col(id_)) & (_version(F.col("text")) == F.col(version))
                  & (_source_key(F.col("source")) == F.col(key)))
    words = F.col(draw)["words"]
    text = F.when(words >= F.col(size), F.col("text")).otherwise(
        F.array_join(F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), F.lit(1), words.cast("int")), " "))
    j = j.withColumn("text", text)
    if "n_chars" in docs.columns:
        j = j.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    order = F.xxhash64(F.lit(seed), F.col(draw)["pass"], F.col(id_), F.col(version))
    return j.withColumn(shard, F.col(draw)["shard"]).withColumn(place, order).repartition(shard).sortWithinPartitions(
        shard, place).select(*[F.col(f"`{c}`") for c in docs.columns])


def op7_mixing(docs: DataFrame) -> DataFrame:
    plan = mixing_plan(docs.select("doc_id", "text", "source"))
    return plan.select(
        "doc_id", "size", "source_size", "target",
        F.aggregate("draws", F.lit(0).cast("long"), lambda s, d: s + d["words"]).alias("taken"),
        F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("_n"),
    ).drop("_n")
