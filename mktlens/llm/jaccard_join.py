"""Similarity join on word shingles (Jaccard), with classes of linked documents.

Method: adaptive multi-match prefixes.  A document's shingles are ordered from
rare to frequent; its l-prefix is its first n - ceil(t*n) + l shingles, and two
documents with Jaccard t or more share at least l shingles of their l-prefixes
for every l.  Each document takes the l that costs least by the estimated
lengths of its shingles' posting lists: a longer prefix reads more postings,
but asks for more shared shingles before a pair is verified.  A pair becomes a
candidate only with as many shared prefix shingles as the smaller of its two l.

Before verification the count must also reach what the pair's sizes ask for,
given how many shingles each document has beyond its prefix.

Exact at every size: the frequency estimate (a hashed count table of bounded
size over all shingles of all documents) only sets the order, never the result.

Scale:
* Equal shingle sets are one node.  Postings travel packed, 23 bytes each; a
  shingle that occurs twice within one batch leaves it only once, so the list
  of a very frequent shingle is bounded by the number of batches, not documents.
* Large groups of near copies aren't compared pairwise.  Two rounds compare the
  members of each posting list with one hub and merge what links; afterwards
  only pairs that still lie in different classes are formed and verified, which
  loses no link between classes.  A pair is formed at the first token it shares,
  as good as once, and only if enough open tokens lie ahead of both ends there.
* Texts are shuffled once, compressed, to keep those of nodes with a candidate.

Defined cases: a NULL or wordless text has an empty set and links with nothing;
rows with a NULL doc_id are returned with NULL component_id and link with
nothing; rows repeated with the same doc_id share its links; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mktlens.llm.common import checkpointed, giving_back, stored
from mktlens.llm.components import components
from mktlens.llm.wordhash import U, Words, mix, multipliers, segment_sums, slices, words_of

MAX_MATCH = 12
VERIFY_COST = 8.0
SKETCH_SLICES = 16
LOOK_BACK = 4   # tokens a posting carries to tell that a pair has met before; never decides a result


def shingles(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct k-word shingles of each row, by row and hash."""
    at, h = w.windows(k)
    row = w.doc[at]
    n_words = w.counts()
    short = np.nonzero((n_words > 0) & (n_words < k))[0]
    if len(short):
        first = np.concatenate([[0], np.cumsum(n_words)])[:-1]
        place = np.arange(len(w.hash)) - first[w.doc]
        own = np.isin(w.doc, short)
        starts = np.cumsum(n_words[short]) - n_words[short]
        whole = segment_sums(w.hash[own] * multipliers(k)[place[own]], starts)
        row = np.concatenate([row, short])
        h = np.concatenate([h, mix(whole + n_words[short].astype(U) * U(0x9E3779B97F4A7C15))])
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    return row[new], h[new]


def _nodes(row: np.ndarray, h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(set size, 64-bit identity of the set) of each row."""
    size = np.bincount(row, minlength=n)
    total = np.zeros(n, U)
    full = size > 0
    total[full] = segment_sums(mix(h ^ U(0xA0761D6478BD642F)), (np.cumsum(size) - size)[full])
    return size, mix(total + size.astype(U)).view(np.int64)


def features(docs: DataFrame, k: int, bits: int) -> DataFrame:
    """A row (doc_id, node, n) per document, and per task the counts of hashed
    shingles in SKETCH_SLICES rows (slice, counts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << bits, np.uint32)
        for batch in batches:
            for first, data, bounds in slices(batch.column("text")):
                row, h = shingles(words_of(data, bounds, fold=True), k)
                size, node = _nodes(row, h, len(bounds) - 1)
                at, times = np.unique(h >> U(64 - bits), return_counts=True)
                counts[at] += times.astype(np.uint32)
                m = len(size)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, m), batch.column("version").slice(first, m), pa.array(node), pa.array(size),
                     pa.nulls(m, pa.int32()), pa.nulls(m, pa.binary())],
                    names=["doc_id", "version", "node", "n", "slice", "counts"])
        c = zstandard.ZstdCompressor(level=1)
        parts = [c.compress(x.tobytes()) for x in np.split(counts, SKETCH_SLICES)] if counts.any() else []
        m = len(parts)
        yield pa.RecordBatch.from_arrays(
            [*[pa.nulls(m, pa.int64())] * 4, pa.array(range(m), pa.int32()), pa.array(parts, pa.binary())],
            names=["doc_id", "version", "node", "n", "slice", "counts"])

    return docs.mapInArrow(giving_back(run), "doc_id long, version long, node long, n long, slice int, counts binary")


def frequency_table(feature_rows: DataFrame, bits: int) -> np.ndarray:
    """Estimated documents beyond the usual of each hashed shingle; 2**bits
    entries at most, whatever the corpus."""

    def add(key, rows: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros((1 << bits) // SKETCH_SLICES, np.uint64)
        for x in rows["counts"]:
            total += np.frombuffer(zstandard.ZstdDecompressor().decompress(x), np.uint32)
        return pd.DataFrame({"slice": [key[0]], "counts": [total.astype(np.float32).tobytes()]})

    partial = feature_rows.where(F.col("slice").isNotNull()).select("slice", "counts")
    summed = partial.groupBy("slice").applyInPandas(add, "slice int, counts binary").collect()
    table = np.zeros(1 << bits, np.float32)
    part = (1 << bits) // SKETCH_SLICES
    for r in summed:
        table[r["slice"] * part:(r["slice"] + 1) * part] = np.frombuffer(r["counts"], np.float32)
    usual = float(np.median(table))
    # beyond three times the usual, in powers of two, so that noise does not disturb the order
    return np.ceil(np.log2(np.maximum(1, table / (3 * usual + 1)))).astype(np.uint8)


def _prefixes(row, h, size, rank_class, bits, percent):
    """Shingles in each row's adaptive prefix as (row, hash), and per row its l
    and how frequent its shingles are on average (in 1/256 classes)."""
    cls = rank_class[(h >> U(64 - bits)).astype(np.int64)]
    order = np.lexsort((h, cls, row))
    row, h, cls = row[order], h[order], cls[order]
    first = np.cumsum(size) - size
    rank = np.arange(len(h)) - first[row]
    need = (percent * size + 99) // 100
    load = np.concatenate([[0.0], np.cumsum(np.exp2(cls.astype(np.float64)) - 0.98)])
    best, ell = None, np.ones(len(size), np.int64)
    for m in range(1, MAX_MATCH + 1):
        length = np.minimum(size - need + m, size)
        cost = (load[first + length] - load[first]) * (1 + VERIFY_COST / m)
        cost = np.where(need >= m, cost, np.inf)
        if best is None:
            best = cost
        else:
            better = cost < best
            ell[better], best = m, np.where(better, cost, best)
    own = rank < (size - need + ell)[row]
    usual = np.bincount(row, weights=cls, minlength=len(size)) * 256 // np.maximum(size, 1)
    return row[own], h[own], ell, usual.astype(np.uint16)


POSTING = np.dtype([("token", "<u8"), ("node", "<i8"), ("n", "<i4"), ("ell", "u1"), ("usual", "<u2")])


def postings(docs: DataFrame, rank_class: np.ndarray, k: int, bits: int, percent: int, buckets: int) -> DataFrame:
    """(token, node, n, ell) of the prefix shingles that two nodes or more share."""
    shared = docs.sparkSession.sparkContext.broadcast(rank_class)

    def sorted_postings(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        """Distinct postings of a batch by token, and which is a token's first."""
        parts = []
        for _, data, bounds in slices(batch.column("text")):
            row, h = shingles(words_of(data, bounds, fold=True), k)
            size, node = _nodes(row, h, len(bounds) - 1)
            row, h, ell, usual = _prefixes(row, h, size, shared.value, bits, percent)
            p = np.zeros(len(h), POSTING)
            p["token"], p["node"], p["n"], p["ell"], p["usual"] = h, node[row], size[row], ell[row], usual[row]
            parts.append(p)
        p = np.concatenate(parts) if parts else np.zeros(0, POSTING)
        p = p[np.lexsort((p["node"], p["token"]))]
        new = np.ones(len(p), bool)
        new[1:] = (p["token"][1:] != p["token"][:-1]) | (p["node"][1:] != p["node"][:-1])
        p = p[new]
        head = np.ones(len(p), bool)
        head[1:] = p["token"][1:] != p["token"][:-1]
        return p, head

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One posting per token and batch, packed by bucket, with a bit that
        says whether the batch has more of the token."""
        for batch in batches:
            p, head = sorted_postings(batch)
            at = np.nonzero(head)[0]
            more = np.diff(np.append(at, len(p))) > 1
            p = p[at]
            bucket = (p["token"] % U(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            groups = np.split(order, np.nonzero(np.diff(bucket[order]))[0] + 1) if len(order) else []
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(bucket[g[0]]) for g in groups], pa.int32()), pa.array([p[g].tobytes() for g in groups], pa.binary()),
                 pa.array([np.packbits(more[g]).tobytes() for g in groups], pa.binary())], names=["bucket", "blob", "more"])

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The rest: known to be shared without a look at other batches."""
        for batch in batches:
            p, head = sorted_postings(batch)
            p = p[~head]
            for at in range(0, len(p), 50_000):
                q = p[at:at + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.ascontiguousarray(c)) for c in (q["token"].astype(np.int64), q["node"], q["n"], q["ell"].astype(np.int32), q["usual"].astype(np.int32))],
                    names=POSTING.names)

    def meet(key, frame: pd.DataFrame) -> pd.DataFrame:
        p = np.concatenate([np.frombuffer(b, POSTING) for b in frame["blob"]])
        again = np.concatenate([np.unpackbits(np.frombuffer(a, np.uint8), count=len(b) // POSTING.itemsize)
                                for a, b in zip(frame["more"], frame["blob"], strict=True)]).astype(bool)
        order = np.lexsort((p["node"], p["token"]))
        p, again = p[order], again[order]
        _, start, back = np.unique(p["token"], return_index=True, return_inverse=True)
        low, high = p["node"][start], np.maximum.reduceat(p["node"], start)
        keep = ((low != high) | (np.bitwise_or.reduceat(again, start)))[back]
        p = p[keep]
        return pd.DataFrame({"token": p["token"].astype(np.int64), "node": p["node"], "n": p["n"], "ell": p["ell"].astype(np.int32),
                             "usual": p["usual"].astype(np.int32)})

    cols = "token long, node long, n int, ell int, usual int"
    met = docs.mapInArrow(giving_back(heads), "bucket int, blob binary, more binary").groupBy("bucket").applyInPandas(meet, cols)
    return stored(met.union(docs.mapInArrow(giving_back(others), cols)))


def texts_of(docs: DataFrame, nodes: DataFrame, thin: DataFrame) -> DataFrame:
    """(node, packed text) for the given nodes, from the smallest doc_id of each
    and, of its texts, one that has this set."""
    ids = thin.join(nodes, "node").groupBy("node").agg(F.min(F.struct("doc_id", "version")).alias("x")).select("node", "x.doc_id", "x.version")

    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                b = batch.slice(at, 500)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), b.column("version"), pa.array([c.compress(str(t).encode()) for t in b.column("text")], pa.binary())],
                    names=["doc_id", "version", "packed"])

    packed = docs.where(F.col("text").isNotNull()).mapInArrow(giving_back(squeeze), "doc_id long, version long, packed binary")
    # a set has one (doc_id, version): repeated rows go where the join has brought them, without a shuffle
    return packed.join(ids, ["doc_id", "version"]).dropDuplicates(["doc_id", "version"]).select("node", "packed")


def same_document(thin: DataFrame) -> DataFrame:
    """Links (a, b) between the sets of rows that share a doc_id."""
    several = thin.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("most")).where("a < most")
    return thin.join(several, "doc_id").where(F.col("node") != F.col("a")).select("a", F.col("node").alias("b")).distinct()


def verify(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets reach the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = zstandard.ZstdDecompressor()

        def shingle_set(packed: bytes) -> np.ndarray:
            data = np.frombuffer(d.decompress(packed), np.uint8)
            return shingles(words_of(data, np.array([0, len(data)]), fold=True), k)[1]

        last, own = None, None
        for batch in batches:
            good = []
            for i, (a, left, right) in enumerate(zip(batch.column("a").to_pylist(), batch.column("left"), batch.column("right"), strict=True)):
                if a != last:
                    last, own = a, shingle_set(left.as_py())
                other = shingle_set(right.as_py())
                both = len(np.intersect1d(own, other, assume_unique=True))
                if 100 * both >= percent * (len(own) + len(other) - both):
                    good.append(i)
            yield pa.RecordBatch.from_arrays([batch.column("a").take(pa.array(good, pa.int64())), batch.column("b").take(pa.array(good, pa.int64()))], names=["a", "b"])

    both = (
        pairs.join(texts.select(F.col("node").alias("b"), F.col("packed").alias("right")), "b")
        .join(texts.select(F.col("node").alias("a"), F.col("packed").alias("left")), "a")
    )
    return both.select("a", "b", "left", "right").mapInArrow(giving_back(run), "a long, b long")


def _may_link(percent: int, a: tuple[str, str], b: tuple[str, str]):
    """Whether a pair with ``shared`` prefix shingles can reach the similarity:
    beyond the prefix that ends first, a document has only ceil(t*n) - l more."""
    n_a, n_b = F.col(a[0]), F.col(b[0])
    beyond = [F.ceil(F.col(n) * percent / F.lit(100)) - F.col(ell) for n, ell in (a, b)]
    return (F.col("shared") >= F.least(a[1], b[1])) & (
        (100 + percent) * (F.col("shared") + F.greatest(*beyond)) >= percent * (n_a + n_b))


def jaccard_classes(docs: DataFrame, k: int = 5, percent: int = 80, counters_per_doc: int = 8, max_bits: int = 26,
                    docs_per_bucket: int = 4096) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (the
    smallest doc_id reachable by links).  The frequency table has
    ``counters_per_doc`` entries per document, 2**max_bits (64 MB) at most."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("version"), F.col("text").alias("text"))
    bits = min(max_bits, max(16, (d.count() * counters_per_doc).bit_length()))
    feature_rows = stored(features(d, k, bits))
    thin = feature_rows.where(F.col("slice").isNull()).select("doc_id", "version", "node", "n")
    known = thin.where(F.col("doc_id").isNotNull() & (F.col("n") > 0))
    buckets = max(16, -(-thin.count() // docs_per_bucket))
    posted = postings(d.where(F.col("doc_id").isNotNull()), frequency_table(feature_rows, bits), k, bits, percent, buckets)
    texts = stored(texts_of(d, posted.select("node").distinct(), known))

    near = lambda p: (F.col(f"{p}n") * percent <= F.col("n") * 100) & (F.col("n") * percent <= F.col(f"{p}n") * 100)
    links, label = checkpointed(same_document(known)), None
    # first the document whose shingles are the most frequent (of near copies, the
    # one least changed), then one by hash
    for order in (F.col("usual"), F.xxhash64("node")):
        hubs = posted.groupBy("token").agg(
            F.max(F.struct(order.alias("o"), F.col("node").alias("hub"), F.col("n").alias("hub_n"), F.col("ell").alias("hub_ell"))).alias("x"))
        star = posted.join(hubs.select("token", "x.hub", "x.hub_n", "x.hub_ell"), "token").where(
            (F.col("hub") != F.col("node")) & near("hub_")).groupBy(F.col("hub").alias("a"), F.col("node").alias("b")).agg(
            F.count(F.lit(1)).alias("shared"), F.first(F.least("ell", "hub_ell")).alias("ell")).where("shared >= ell").select("a", "b")
        if label is not None:
            star = _between(star, label)
        found = checkpointed(verify(star, texts, k, percent))
        links = links.union(found)
        label = components(links)
    # whatever still lies in two classes: all of it, by the multi-match rule
    posted_in = posted.join(label, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    open_tokens = posted_in.groupBy("token").agg(
        F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("size")).where("lo < hi").select("token", "size")
    beyond = F.ceil(F.col("n") * percent / F.lit(100)) - F.col("ell")
    # a node's open tokens (at most one document's prefix) from the shortest list
    # to the longest; ``ahead`` counts those from here on, ``before`` holds the last few
    of_node = Window.partitionBy("node")
    in_order = of_node.orderBy("size", "token")
    rest = stored(posted_in.join(open_tokens, "token").select(
        "token", "node", "n", "ell", "comp", beyond.alias("beyond"),
        (F.count(F.lit(1)).over(of_node) - F.row_number().over(in_order) + 1).alias("ahead"),
        F.collect_list("token").over(in_order.rowsBetween(-LOOK_BACK, -1)).alias("before")))
    other = rest.select("token", *[F.col(c).alias(f"o_{c}") for c in ("node", "n", "ell", "comp", "beyond", "ahead", "before")])
    # at the first token that a pair shares, neither end shares one before it, and
    # the pair shares no more than either end still has ahead
    ahead = F.least("ahead", "o_ahead")
    enough = (ahead >= F.least("ell", "o_ell")) & (
        (100 + percent) * (ahead + F.greatest("beyond", "o_beyond")) >= percent * (F.col("n") + F.col("o_n")))
    pairs = (
        rest.join(other, "token").where((F.col("comp") < F.col("o_comp")) & near("o_") & enough & ~F.arrays_overlap("before", "o_before"))
        .groupBy(F.col("node").alias("a"), F.col("o_node").alias("b")).agg(*[F.first(c).alias(c) for c in ("n", "ell", "o_n", "o_ell")])
    )
    tokens = rest.groupBy("node").agg(F.collect_list("token").alias("tokens"))
    shared = F.size(F.array_intersect("tokens", "o_tokens"))
    cross = (
        pairs.join(tokens.withColumnRenamed("node", "a"), "a")
        .join(tokens.select(F.col("node").alias("b"), F.col("tokens").alias("o_tokens")), "b").withColumn("shared", shared)
        .where(_may_link(percent, ("n", "ell"), ("o_n", "o_ell"))).select("a", "b")
    )
    label = components(links.union(checkpointed(verify(cross, texts, k, percent))))

    smallest = known.groupBy("node").agg(F.min("doc_id").alias("doc")).join(label, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    roots = smallest.groupBy("comp").agg(F.min("doc").alias("component_id"))
    by_node = smallest.join(roots, "comp").select("node", "component_id")
    linked = thin.join(by_node, "node", "left")
    return linked.select("doc_id", F.col("n").alias("n_shingles"),
                         F.when(F.col("n") > 0, F.when(F.col("doc_id").isNotNull(), F.col("component_id"))).otherwise(F.col("doc_id")).alias("component_id"))


def _between(pairs: DataFrame, label: DataFrame) -> DataFrame:
    """The pairs whose ends have different labels (a node without one is its own)."""
    la = label.select(F.col("node").alias("a"), F.col("comp").alias("ca"))
    lb = label.select(F.col("node").alias("b"), F.col("comp").alias("cb"))
    return pairs.join(la, "a", "left").join(lb, "b", "left").where(
        F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")


def keep_one(docs: DataFrame, **kwargs) -> DataFrame:
    """``docs`` with one document of each class: the row(s) whose doc_id is its
    class id.  Rows with a NULL doc_id are kept."""
    gone = jaccard_classes(docs, **kwargs).where(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def op4_jaccard_join(docs: DataFrame) -> DataFrame:
    return jaccard_classes(docs)


OP4_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), placed AS (
  SELECT doc_id, len(w) AS n_words, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM words
), elements AS (
  SELECT DISTINCT doc_id, e FROM (
    SELECT doc_id, n_words, pos, string_agg(word, ' ') OVER (
             PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS e
    FROM placed)
  WHERE pos <= greatest(n_words - 4, 1)
), sizes AS (
  SELECT doc_id, count(e) AS n FROM words LEFT JOIN elements USING (doc_id) GROUP BY doc_id
), links AS (
  SELECT c.x, c.y FROM (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS both
    FROM elements a JOIN elements b ON a.e = b.e AND a.doc_id <> b.doc_id GROUP BY 1, 2) c
  JOIN sizes p ON p.doc_id = c.x JOIN sizes q ON q.doc_id = c.y
  WHERE 100 * c.both >= 80 * (p.n + q.n - c.both)
), reached(root, doc_id) AS (
  SELECT doc_id, doc_id FROM sizes
  UNION
  SELECT r.root, l.y FROM reached r JOIN links l ON l.x = r.doc_id WHERE l.y > r.root
), classes AS (
  SELECT doc_id, min(root) AS component_id FROM reached GROUP BY doc_id
)
SELECT doc_id, n AS n_shingles, component_id FROM sizes JOIN classes USING (doc_id)
"""
