"""Vector compression by product codes, with a trie over the distinct parts.

Method: lexicographic trie over distinct parts.  Vectors become integers and are
cut into parts; equal parts are one leaf with a weight.  The sorted distinct parts
of a task form a trie, a level per dimension.  A depth-first traversal carries, for
each node, the vector of its squared distances to all codebook entries so far; a
child adds one dimension to its parent's vector, so parts with a common prefix share
that work.  At a leaf the smallest distance tells its entry, and its weight is added
to the entry's count and component sums.  Siblings are walked in blocks of ``WIDTH``,
so that the vectors held are bounded by the depth, not by the number of parts.

Scale: the distinct parts are stored once, sorted over range partitions, so that a
task's parts share long prefixes; a round reads them and sums within each task, then
in two levels; only the codebooks (``entries`` entries a part) reach the driver.  The
codes of the vectors are a map over the rows with the final codebooks.  Errors are
summed per label with partial sums, and joined back by label and a slice of the id.

Arithmetic is in integers and exact: of 64 bits where all components are below 2^26
in size, unbounded beyond; errors above 2^63 - 1 are given as that.

Defined cases: rows with a vector that is NULL or holds NULL or non-finite components
(or such of 1e300 and more) are dropped.  Vectors of one length share codebooks; each
length has its own, begun by its own smallest ids.  A length that the parts don't
divide makes its first parts one longer; an empty vector has empty parts and no error.
A vector whose vec_id is NULL is coded, but begins no entry; rows repeated with a vec_id
are vectors of their own, and the smallest of them by components begins the entry.
With fewer ids than entries the codebook is shorter (without any id: one zero entry).
Ties go to the lower index; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mktlens.llm.common import stored

WIDTH = 512
SCALE = 1024
SMALL = 1 << 26
MOST = (1 << 63) - 1
SLICES = 32
MERGERS = 64

Codebooks = dict[tuple[int, int], np.ndarray]


def integers(scaled: np.ndarray) -> np.ndarray:
    """Whole doubles as 64-bit integers where all are small, as unbounded ones else."""
    if not scaled.size or np.abs(scaled).max() < SMALL:
        return scaled.astype(np.int64)
    return np.array([int(x) for x in scaled.ravel()], object).reshape(scaled.shape)


def cuts(length: int, parts: int) -> list[slice]:
    """The parts of a vector of that length."""
    size, more = divmod(length, parts)
    at = [i * size + min(i, more) for i in range(parts + 1)]
    return [slice(a, b) for a, b in zip(at, at[1:], strict=False)]


def distinct_rows(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct rows in lexicographic order, which of them each row is)."""
    if not rows.shape[1]:
        return rows[:1], np.zeros(len(rows), np.int64)
    order = np.lexsort(rows.T[::-1])
    new = np.ones(len(rows), bool)
    new[1:] = (rows[order][1:] != rows[order][:-1]).any(1)
    back = np.empty(len(rows), np.int64)
    back[order] = np.cumsum(new) - 1
    return rows[order[new]], back


def nearest(parts: np.ndarray, codebook: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) of each of the sorted distinct ``parts``: their trie, walked depth first."""
    dims = parts.shape[1]
    kind = object if object in (parts.dtype, codebook.dtype) else np.int64
    parts, entries = parts.astype(kind), codebook.T.astype(kind)
    # the dimension at which a part leaves the path of the one before it
    parting = np.zeros(len(parts), np.int64)
    if dims and len(parts) > 1:
        parting[1:] = (parts[1:] != parts[:-1]).argmax(1)
    entry, distance = np.zeros(len(parts), np.int64), np.zeros(len(parts), kind)
    # on the stack: neighbouring nodes of one depth, each the parts from `first` to before `last`, and their parents' distances
    stack = [(0, np.array([0]), np.array([len(parts)]), np.zeros((1, len(codebook)), kind), np.array([0]))] if len(parts) else []
    while stack:
        depth, first, last, above, parent = stack.pop()
        so_far = above[parent]
        if depth:
            gap = parts[first, depth - 1][:, None] - entries[depth - 1][None, :]
            so_far = so_far + gap * gap
        if depth == dims:
            entry[first] = so_far.argmin(1)
            distance[first] = so_far[np.arange(len(first)), entry[first]]
            continue
        inside = np.arange(first[0], last[-1])
        child = inside[parting[inside] <= depth]
        end = np.append(child[1:], last[-1])
        parent = np.searchsorted(first, child, side="right") - 1
        for at in reversed(range(0, len(child), width)):
            own = slice(at, at + width)
            stack.append((depth + 1, child[own], end[own], so_far, parent[own]))
    return entry, distance


def kept_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, vec) of the vectors that are coded."""
    v = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("vec"))
    return v.where(F.col("vec").isNotNull() & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < 1e300)))


def _by_length(vecs: pd.Series) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, positions in the batch, their scaled components) for every length."""
    lengths = vecs.map(len).to_numpy(np.int64)
    for length in np.unique(lengths):
        at = np.nonzero(lengths == length)[0]
        flat = np.concatenate(vecs.iloc[at].to_list()) if length else np.zeros(0)
        yield int(length), at, np.floor(flat.reshape(len(at), length) * SCALE) + 0.0


def distinct_parts(kept: DataFrame, parts: int, rows_per_part: int = 100_000) -> DataFrame:
    """(length, part, x, weight), stored in lexicographic order over range partitions."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for length, _, x in _by_length(b["vec"]) if len(b) else ():
                for k, own in enumerate(cuts(length, parts)):
                    rows, back = distinct_rows(x[:, own])
                    yield pd.DataFrame({"length": length, "part": k, "x": list(rows), "weight": np.bincount(back)})

    found = stored(kept.select("vec").mapInPandas(cut, "length int, part int, x array<double>, weight long")
                   .groupBy("length", "part", "x").agg(F.sum("weight").alias("weight")))
    tasks = max(1, -(-found.count() // rows_per_part))
    return stored(found.repartitionByRange(tasks, "length", "part", "x").sortWithinPartitions("length", "part", "x"))


def first_codebooks(kept: DataFrame, parts: int, entries: int) -> Codebooks:
    """By (length, part): that part of the smallest ids' vectors."""
    sized = kept.withColumn("length", F.size("vec"))
    ids = sized.where(F.col("vec_id").isNotNull()).select("length", "vec_id").distinct()
    rank = F.expr("row_number() OVER (PARTITION BY length ORDER BY vec_id)")
    smallest = ids.withColumn("rank", rank).where(F.col("rank") <= entries).drop("rank")
    began = sized.join(smallest, ["length", "vec_id"]).groupBy("length", "vec_id").agg(F.min("vec").alias("vec"))
    rows = began.orderBy("length", "vec_id").toPandas()
    out = {(r["length"], k): np.zeros((1, own.stop - own.start), np.int64)
           for r in sized.select("length").distinct().collect() for k, own in enumerate(cuts(r["length"], parts))}
    for length, _, x in _by_length(rows["vec"]) if len(rows) else ():
        for k, own in enumerate(cuts(length, parts)):
            out[length, k] = integers(x[:, own])
    return out


def _told(counts: np.ndarray, sums: np.ndarray) -> str:
    return json.dumps([counts.tolist(), sums.tolist()])


def _added(told: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    counts, sums = 0, 0
    for t in told:
        c, s = json.loads(t)
        counts, sums = counts + np.array(c, object), sums + np.array(s, object).reshape(len(c), -1)
    return counts, sums


SUMS = "length int, part int, told string"


def weighted_sums(distinct: DataFrame, codebooks: Codebooks) -> DataFrame:
    """(length, part, told): how many parts each entry has, and the sums of their components."""
    shared = distinct.sparkSession.sparkContext.broadcast(codebooks)

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        for b in batches:
            for key, own in b.groupby(["length", "part"]):
                codebook, weight = shared.value[key], own["weight"].to_numpy()
                x = integers(np.stack(own["x"].to_list()))
                entry, _ = nearest(x, codebook)
                counts = np.zeros(len(codebook), object)
                np.add.at(counts, entry, weight.astype(object))
                # components below 2^26 and weights below 2^36 can't leave 64 bits
                exact = x if x.dtype == np.int64 and weight.sum() < 1 << 36 else x.astype(object)
                sums = np.zeros(codebook.shape, exact.dtype)
                np.add.at(sums, entry, exact * weight[:, None].astype(exact.dtype))
                c, s = total.get(key, (0, 0))
                total[key] = (c + counts, s + sums.astype(object))
        if total:
            slot = TaskContext.get().partitionId() % MERGERS
            yield pd.DataFrame([(*key, slot, _told(c, s)) for key, (c, s) in total.items()], columns=["length", "part", "slot", "told"])

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"length": frame["length"].iloc[:1], "part": frame["part"].iloc[:1], "told": _told(*_added(frame["told"]))})

    found = distinct.mapInPandas(walk, "length int, part int, slot int, told string")
    return found.groupBy("length", "part", "slot").applyInPandas(add, SUMS).groupBy("length", "part").applyInPandas(add, SUMS)


def train(vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4) -> Codebooks:
    """The codebooks of every (length, part) after ``rounds`` rounds."""
    kept = kept_vectors(vectors)
    codebooks, distinct = first_codebooks(kept, parts, entries), distinct_parts(kept, parts)
    for _ in range(rounds):
        for r in weighted_sums(distinct, codebooks).collect():
            counts, sums = _added(pd.Series([r["told"]]))
            old = codebooks[r["length"], r["part"]].astype(object)
            new = np.array([s // c if c else o for c, s, o in zip(counts, sums, old, strict=True)], object).reshape(old.shape)
            codebooks[r["length"], r["part"]] = new.astype(np.int64) if not new.size or abs(new).max() < SMALL else new
    return codebooks


def codebook_digest(codebooks: Codebooks, length: int) -> str:
    """sha256 of the components of a length's entries, in decimal, by part, entry and position."""
    own = [codebooks[key] for key in sorted(codebooks) if key[0] == length]
    return sha256(",".join(str(int(x)) for c in own for x in c.ravel()).encode()).hexdigest()


def encode(vectors: DataFrame, codebooks: Codebooks, parts: int = 4) -> DataFrame:
    """(vec_id, label, codes, error, codebooks_sha256) of every kept vector."""
    digests = {length: codebook_digest(codebooks, length) for length, _ in codebooks}
    shared = vectors.sparkSession.sparkContext.broadcast((codebooks, digests))
    kept = kept_vectors(vectors)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codebooks, digests = shared.value
        for b in batches:
            for length, at, x in _by_length(b["vec"]) if len(b) else ():
                codes, error = np.zeros((len(at), parts), np.int64), np.zeros(len(at), object)
                for k, own in enumerate(cuts(length, parts)):
                    rows, back = distinct_rows(x[:, own])
                    entry, distance = nearest(integers(rows), codebooks[length, k])
                    codes[:, k] = entry[back]
                    error += distance.astype(object)[back]
                yield pd.DataFrame({"vec_id": b["vec_id"].iloc[at].to_numpy(), "label": b["label"].iloc[at].to_numpy(), "codes": list(codes),
                                    "error": [min(int(e), MOST) for e in error], "codebooks_sha256": digests[length]})

    id_type, label_type = (kept.schema[c].dataType.simpleString() for c in ("vec_id", "label"))
    return kept.mapInPandas(run, f"vec_id {id_type}, label {label_type}, codes array<int>, error long, codebooks_sha256 string")


def op13_vector_codes(vectors: DataFrame) -> DataFrame:
    coded = stored(encode(vectors, train(vectors)))
    slices = F.explode(F.sequence(F.lit(0), F.lit(SLICES - 1)))
    totals = coded.groupBy("label").agg(F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(MOST)).cast("long").alias("label_error"))
    totals = totals.select(F.col("label").alias("of"), "label_error", slices.alias("slice"))
    sliced = coded.withColumn("slice", F.pmod(F.xxhash64("vec_id"), F.lit(SLICES)).cast("int"))
    code = F.array_join(F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")), "")
    return sliced.join(totals.withColumnRenamed("slice", "own"), F.col("label").eqNullSafe(F.col("of")) & (F.col("slice") == F.col("own"))).select(
        "vec_id", code.alias("code"), "error", "label_error", "codebooks_sha256")


def _sql(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """The rounds in SQL, for vectors of one length and components whose squares sum to below 2^53."""
    square = "list_inner_product(x, x) - 2 * list_inner_product(x, y) + list_inner_product(y, y)"
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""near{r} AS (SELECT v, p, min({{'d': {square}, 'e': e}}) AS b FROM parts JOIN book{r} USING (p) GROUP BY v, p)""")
        if r < rounds:
            steps.append(f"""mean{r} AS (
  SELECT p, e, list(m ORDER BY i) AS y FROM (
    SELECT p, b.e AS e, i, floor(sum(x[i]) / count(*)) AS m
    FROM near{r} JOIN parts USING (v, p), unnest(generate_series(1, len(x))) AS u(i) GROUP BY ALL)
  GROUP BY p, e
), book{r + 1} AS (SELECT p, e, coalesce(mean{r}.y, book{r}.y) AS y FROM book{r} LEFT JOIN mean{r} USING (p, e))""")
    return f"""
WITH kept AS (
  SELECT row_number() OVER () AS v, vec_id, label, list_transform(embedding, lambda x: floor(x::DOUBLE * {SCALE})) AS vec
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS (
  SELECT v, vec_id, p, vec[p * len(vec) // {parts} + 1:(p + 1) * len(vec) // {parts}] AS x
  FROM kept, unnest(generate_series(0, {parts - 1})) AS u(p)
), book0 AS (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x AS y FROM parts
  WHERE vec_id IN (SELECT DISTINCT vec_id FROM kept ORDER BY vec_id LIMIT {entries})
), {", ".join(steps)},
coded AS (
  SELECT v, string_agg(lpad(lower(to_hex(b.e)), 2, '0'), '' ORDER BY p) AS code, sum(b.d)::BIGINT AS error FROM near{rounds} GROUP BY v
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(list_transform(y, lambda c: c::BIGINT::VARCHAR), ','), ',' ORDER BY p, e)) FROM book{rounds}) AS codebooks_sha256
FROM coded JOIN kept USING (v)
"""


OP13_SQL = _sql()
