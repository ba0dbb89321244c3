"""Merkle manifest of a dataset, with a membership proof for every row.

Method: content-addressed DAG descent.  Rows are leaves; per language, runs of
``fan`` consecutive nodes become their hash until one is left (the subroot), and
the subroots likewise give the root.  Every inner node is a record of its digest
and its children's digests.  Records are kept in bundles: the subtree of ``levels``
levels under one node, addressed by that node's digest.  A request descends from
the root: the digits of its rank pick a child in every record, the children not
picked are collected, and the segments of the path are reversed into leaf order.

Scale: requests of one subtree share the descent above it, so a level of bundles
costs one request per bundle below and only the last one touches every leaf.
Leaves are ranked in range partitions of about ``rows_per_part`` rows plus the
counts of the partitions before, so that a language with most rows is spread;
a group holds ``fan ** levels`` nodes at most.  Only counts reach the driver.

Defined cases: a NULL doc_id sorts first in its language and is hashed as ``-``;
rows that share a doc_id (or have none) are leaves of their own, ordered by their
digest; the proofs of equal rows stand in no defined order among these; a
language's only row is its subroot, and the only language's subroot is the root;
an empty table has no rows and no root; extra columns take no part.
"""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField

from mktlens.llm.common import stored

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPER_MODULUS = 7
TOP = "top"
STEPS = "before array<string>, after array<string>"


def _ddl(fields: list[StructField]) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)


def encoded(value: Column) -> Column:
    """A field as hashed: ``-``, or its length in bytes, a colon and itself."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(**changed: Column) -> Column:
    return F.sha2(F.concat(*[encoded(changed.get(c, F.col(c))) for c in FIELDS]), 256)


def tampered_leaf() -> Column:
    """The leaf of a row whose n_chars has been raised by one, where the row is one of those tampered with."""
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPER_MODULUS == 0
    return F.when(chosen & F.col("n_chars").isNotNull(), leaf_digest(n_chars=F.col("n_chars").cast("decimal(20,0)") + 1))


def ranked(rows: DataFrame, order: list[str], rows_per_part: int) -> DataFrame:
    """``rows`` with ``rank``, the 0-based place within ``key`` by ``order``, and ``n``, the rows of the key."""
    rows = stored(rows)
    parts = max(1, -(-rows.count() // rows_per_part))
    placed = stored(rows.repartitionByRange(parts, "key", *order).withColumn("part", F.spark_partition_id()))
    whole = Window.partitionBy("key")
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("key", "part").agg(F.count(F.lit(1)).alias("rows")).select(
        "key", "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"), F.sum("rows").over(whole).alias("n"))
    within = F.row_number().over(Window.partitionBy("key", "part").orderBy(*order)) - 1
    return placed.withColumn("within", within).join(offsets, ["key", "part"]).select(
        *rows.columns, (F.col("offset") + F.col("within")).alias("rank"), "n")


def height(n: int, fan: int) -> int:
    """Levels above ``n`` leaves until one node remains."""
    levels = 0
    while n > 1:
        n, levels = -(-n // fan), levels + 1
    return levels


def depth(n: int, fan: int, below: int, levels: int) -> int:
    """Levels of a tree of ``n`` leaves that lie in the segment above its first ``below`` levels."""
    return min(levels, max(0, height(n, fan) - below))


def subtree(digests: list[str], fan: int, levels: int) -> tuple[str, dict[str, list[str]]]:
    """(root, records) of ``levels`` levels over ``digests``; a lone node is hashed too."""
    records = {}
    for _ in range(levels):
        runs = [digests[i:i + fan] for i in range(0, len(digests), fan)]
        digests = [sha256("".join(r).encode()).hexdigest() for r in runs]
        records.update(zip(digests, runs, strict=True))
    return digests[0], records


def descend(root: str, records: dict[str, list[str]], place: int, fan: int, levels: int) -> tuple[str, list[str], list[str]]:
    """Follows the ``levels`` digits of ``place`` from ``root``: the digest reached and, leaf first, what stands
    before and after each chosen child."""
    before, after = [], []
    for level in reversed(range(levels)):
        children, digit = records[root], place // fan ** level % fan
        before.append("".join(children[:digit]))
        after.append("".join(children[digit + 1:]))
        root = children[digit]
    return root, before[::-1], after[::-1]


@dataclass
class Tree:
    """``nodes[s]`` has the nodes (key, rank, n, digest) under segment s, ``bundles[s]`` its records (address,
    records) by the digest they descend from; the last of ``nodes`` is one node per key.  ``leaves`` are the ranked rows."""

    leaves: DataFrame
    nodes: list[DataFrame]
    bundles: list[DataFrame]
    fan: int
    levels: int


def grow(rows: DataFrame, order: list[str], fan: int = 2, levels: int = 12, rows_per_part: int = 200_000) -> Tree:
    """The trees over ``rows`` (key, digest, ...), one per key, leaves in ``order``."""
    leaves = stored(ranked(rows, order, rows_per_part))
    top = leaves.agg(F.max("n")).first()[0] or 0
    segments = -(-height(top, fan) // levels)
    nodes, bundles = [leaves.select("key", "rank", "n", "digest")], []
    for s in range(segments):

        def build(frame: pd.DataFrame, *, below: int = s * levels) -> pd.DataFrame:
            frame = frame.sort_values("rank")
            root, records = subtree(list(frame["digest"]), fan, depth(int(frame["n"].iloc[0]), fan, below, levels))
            return pd.DataFrame({"key": frame["key"].iloc[:1], "rank": int(frame["rank"].iloc[0]) // fan ** levels,
                                 "n": frame["n"].iloc[:1], "digest": root,
                                 "records": [[{"digest": d, "children": c} for d, c in records.items()]]})

        key_type = leaves.schema["key"].dataType.simpleString()
        block = F.floor(F.col("rank") / fan ** levels)
        built = stored(nodes[-1].groupBy("key", block).applyInPandas(
            build, f"key {key_type}, rank long, n long, digest string, records array<struct<digest: string, children: array<string>>>"))
        # equal subtrees are one bundle: its address is its content
        bundles.append(built.where(F.size("records") > 0).groupBy(F.col("digest").alias("address")).agg(F.first("records").alias("records")))
        nodes.append(built.select("key", "rank", "n", "digest"))
    return Tree(leaves, nodes, bundles, fan, levels)


def prove(tree: Tree, requests: DataFrame, starts: DataFrame) -> DataFrame:
    """``requests`` (key, rank, n, ...) with ``reached``, the digest that the descent ends at, and ``before`` and
    ``after``, the digests beside the path, leaf first.  ``starts`` (key, digest, before, after, ...) tells where each
    key's descent starts, the path above, and what else its requests are given; a request may be any leaf of its key,
    asked for any number of times."""
    fan, levels = tree.fan, tree.levels
    given = [f for f in starts.schema.fields if f.name not in ("key", "digest", "before", "after")]
    shared = ["before", "after", *[f.name for f in given]]
    above = starts.select("key", F.lit(0).cast("long").alias("rank"), "digest", *shared)
    for s in reversed(range(len(tree.bundles))):
        wanted = requests if s == 0 else requests.select(
            "key", F.floor(F.col("rank") / fan ** (levels * s)).alias("rank"), "n").distinct()
        own = wanted.schema.fields

        def answer(asked: pd.DataFrame, bundle: pd.DataFrame, *, below: int = s * levels, own: tuple = tuple(f.name for f in own)) -> pd.DataFrame:
            start = bundle.iloc[0]
            held = start["records"] if start["records"] is not None else []
            records = {r["digest"]: list(r["children"]) for r in held}
            found = [descend(start["address"], records, int(r) % fan ** levels, fan, depth(int(n), fan, below, levels))
                     for r, n in zip(asked["rank"], asked["n"], strict=True)]
            out = asked[list(own)].copy()
            out["reached"] = [d for d, _, _ in found]
            out["before"] = [b + list(start["before"]) for _, b, _ in found]
            out["after"] = [a + list(start["after"]) for _, _, a in found]
            for f in given:
                out[f.name] = start[f.name]
            return out

        schema = f"{_ddl(own)}, reached string, {STEPS}" + (f", {_ddl(given)}" if given else "")
        located = above.select("key", F.col("rank").alias("block"), F.col("digest").alias("address"), *shared).join(tree.bundles[s], "address", "left")
        asked = wanted.withColumn("block", F.floor(F.col("rank") / fan ** levels))
        out = asked.groupBy("key", "block").cogroup(located.groupBy("key", "block")).applyInPandas(answer, schema)
        if not s:
            return out
        above = stored(out.select("key", "rank", F.col("reached").alias("digest"), *shared))
    return requests.join(starts.withColumnRenamed("digest", "reached"), "key")


def folded(leaf: Column, before: Column, after: Column) -> Column:
    """The root recomputed from a leaf and the digests beside its path."""
    steps = F.arrays_zip(before.alias("before"), after.alias("after"))
    return F.aggregate(steps, leaf, lambda acc, s: F.sha2(F.concat(s["before"], acc, s["after"]), 256))


def manifest(docs: DataFrame, fan: int = 2, levels: int = 12, rows_per_part: int = 200_000) -> tuple[Tree, Tree]:
    """(trees by language, tree over their subroots); the leaves carry doc_id and the tampered leaf."""
    # NULL first, then bytewise: the key sorts as the languages do
    key = F.coalesce(F.concat(F.lit("1"), F.col("lang").cast("string")), F.lit("0"))
    rows = docs.select(key.alias("key"), "doc_id", leaf_digest().alias("digest"), tampered_leaf().alias("tampered"))
    by_lang = grow(rows, ["doc_id", "digest"], fan, levels, rows_per_part)
    subroots = by_lang.nodes[-1].select(F.lit(TOP).alias("key"), F.col("key").alias("name"), "digest")
    return by_lang, grow(subroots, ["name"], fan, levels, rows_per_part)


def proofs(by_lang: Tree, over: Tree) -> DataFrame:
    """Every leaf with subroot, root, the digest reached by the descent, and its path (before, after)."""
    none = F.array().cast("array<string>")
    top = over.nodes[-1].select("key", "digest", none.alias("before"), none.alias("after"), F.col("digest").alias("root"))
    subroots = stored(prove(over, over.leaves.select("key", "rank", "n", "name"), top))
    starts = subroots.select(F.col("name").alias("key"), F.col("reached").alias("digest"), "before", "after",
                             F.col("reached").alias("subroot"), "root")
    return prove(by_lang, by_lang.leaves.select("key", "rank", "n", "doc_id", "tampered"), starts)


def op11_merkle_manifest(docs: DataFrame) -> DataFrame:
    shown = proofs(*manifest(docs))
    siblings = F.transform(F.arrays_zip("before", "after"), lambda s: F.concat(s["before"], s["after"]))
    return shown.select(
        "doc_id", F.col("reached").alias("leaf"), "subroot", "root", F.sha2(F.array_join(siblings, ""), 256).alias("proof_sha256"),
        folded(F.coalesce("tampered", "reached"), F.col("before"), F.col("after")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


# CRC-32 of the decimal digits, a bit at a time: its reversed polynomial is 3988292384.
_LEAF_SQL = """concat(CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(doc_id::VARCHAR) || ':' || doc_id END,
    CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END,
    CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END,
    CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(({n})::VARCHAR) || ':' || ({n}) END,
    CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END)"""

OP11_SQL = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, coalesce('1' || lang, '0') AS key, sha256({_LEAF_SQL.format(n="n_chars")}) AS leaf,
         sha256({_LEAF_SQL.format(n="n_chars + 1")}) AS raised,
         xor(4294967295::BIGINT, list_reduce(
           list_concat([4294967295::BIGINT], flatten(list_transform(string_split(doc_id::VARCHAR, ''),
             lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
           lambda a, x: xor(xor(a, x) >> 1, (xor(a, x) & 1) * 3988292384))) AS crc
  FROM documents
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY key) AS n
  FROM leaves
), low AS (
  SELECT key, 0 AS level, place, n, leaf AS digest FROM ranked
  UNION ALL
  SELECT key, level + 1, place // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY place)) FROM low
  WHERE n > 1 GROUP BY key, level, place // 2, n
), subroots AS (
  SELECT key, digest, row_number() OVER (ORDER BY key) - 1 AS place, count(*) OVER () AS n FROM low WHERE n = 1
), high AS (
  SELECT 0 AS level, place, n, digest FROM subroots
  UNION ALL
  SELECT level + 1, place // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY place)) FROM high
  WHERE n > 1 GROUP BY level, place // 2, n
), steps AS (
  SELECT r.key, r.place, s.level, CASE WHEN (r.place >> s.level) & 1 = 1 THEN l.digest || '|' ELSE '|' || coalesce(l.digest, '') END AS step
  FROM ranked r JOIN (SELECT DISTINCT key, level FROM low WHERE n > 1) s USING (key)
  LEFT JOIN low l ON l.key = r.key AND l.level = s.level AND l.place = xor(r.place >> s.level, 1)
), over_steps AS (
  SELECT r.key, s.level, CASE WHEN (r.place >> s.level) & 1 = 1 THEN l.digest || '|' ELSE '|' || coalesce(l.digest, '') END AS step
  FROM subroots r CROSS JOIN (SELECT DISTINCT level FROM high WHERE n > 1) s
  LEFT JOIN high l ON l.level = s.level AND l.place = xor(r.place >> s.level, 1)
), low_path AS (SELECT key, place, list(step ORDER BY level) AS path FROM steps GROUP BY key, place),
high_path AS (SELECT key, list(step ORDER BY level) AS path FROM over_steps GROUP BY key),
shown AS (
  SELECT r.doc_id, r.leaf, s.digest AS subroot, (SELECT digest FROM high WHERE n = 1) AS root,
         list_concat(coalesce(l.path, []), coalesce(h.path, [])) AS path,
         CASE WHEN r.doc_id IS NOT NULL AND r.crc % 7 = 0 THEN coalesce(r.raised, r.leaf) ELSE r.leaf END AS shown_leaf
  FROM ranked r JOIN subroots s USING (key) LEFT JOIN low_path l ON l.key = r.key AND l.place = r.place
  LEFT JOIN high_path h ON h.key = r.key
), checked AS (
  SELECT *, list_reduce(list_concat([shown_leaf], path),
                        lambda a, x: sha256(split_part(x, '|', 1) || a || split_part(x, '|', 2))) AS folded_root
  FROM shown
)
SELECT doc_id, leaf, subroot, root, sha256(replace(array_to_string(path, ''), '|', '')) AS proof_sha256,
       folded_root, folded_root = root AS verified
FROM checked
"""
