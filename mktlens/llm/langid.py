"""Language identification with string kernels.

Method: a text is the set of its character 1- to 3-grams (blended spectrum,
presence only), hashed into ``dims`` bits.  The kernel of two texts is the size
of the intersection over the geometric mean of the sizes.  A Nyström map on a
few hundred landmark texts and one-versus-rest kernel ridge regression give one
weight per landmark and language, so a batch is scored by two matrix products.

Fitting learns every label that occurs.  It uses a sample bounded per label:
about ``per_language`` texts, fewer (``LEAST`` at least) with more than
``full_languages`` labels, chosen by a hash of the doc_id, and always the first
text by that hash.  Every label has a landmark; landmarks and sample grow with
the number of labels.  Only bit sets (``dims`` / 8 bytes each) reach the driver.
Prediction covers every whole text, is a map over the rows, and shuffles nothing.

Defined cases: a NULL text, or one without a letter, is ``und`` with score 0,
and so is every text if there is nothing to learn from; rows with a NULL
doc_id are predicted but never learnt from, and not held out; rows repeated
with a doc_id and label are one text of the sample; ties go to the first label
by code point; extra columns pass through ``with_language``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from mktlens.llm.common import giving_back, unused

from mktlens.llm.wordhash import U

LETTER = regex.compile(r"\p{L}")
GRAMS = 3
UNKNOWN = "und"
SHARPNESS = 4.0
# Sampled texts of a label, however many labels there are.
LEAST = 16


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def presence(text: str, dims: int) -> np.ndarray:
    """Which hashed 1- to 3-grams of code points the lower-cased text holds."""
    code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(U)
    out = np.zeros(dims, bool)
    shift = U(64 - (dims - 1).bit_length())
    h = np.zeros(len(code), U)
    for n in range(min(GRAMS, len(code))):
        h = h[:len(code) - n] * U(0x9E3779B97F4A7C15) + code[n:] + U(1)
        out[((h * U(0xD6E8FEB86659FD93)) >> shift).astype(np.int64)] = True
    return out


def kernel(x: np.ndarray, landmarks: np.ndarray) -> np.ndarray:
    """Normalised intersections of presence rows with the landmarks."""
    sizes = np.sqrt(np.maximum(x.sum(1, dtype=np.float32), 1))[:, None] * np.sqrt(np.maximum(landmarks.sum(1, dtype=np.float32), 1))[None, :]
    return (x.astype(np.float32) @ landmarks.T) / sizes


def _kernel_of_bits(bits: np.ndarray, landmarks: np.ndarray, dims: int, rows: int = 512) -> np.ndarray:
    """The kernel of packed presence rows, a slice of them unpacked at a time."""
    return np.concatenate([kernel(np.unpackbits(bits[i:i + rows], axis=1, count=dims), landmarks) for i in range(0, len(bits), rows)])


def fit(docs: DataFrame, dims: int = 16384, per_language: int = 400, full_languages: int = 64, n_landmarks: int = 256,
        ridge: float = 1e-2, seed: int = 3) -> dict:
    """The model: landmark bits, weights per landmark and label, labels."""
    place = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id"), 11).cast("double") / F.lit(float(1 << 53))
    known = docs.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.select("doc_id", "lang", place.alias("place"), "text")
    counts = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first")).collect()
    model = {"labels": sorted(r["lang"] for r in counts), "dims": dims}
    if not counts:
        return model
    per_label = min(per_language, max(LEAST, per_language * full_languages // len(counts)))
    # places are multiples of 2^-53: below the next one is the first text of a label, if nothing else
    below = F.map_from_arrays(F.array(*[F.lit(r["lang"]) for r in counts]),
                              F.array(*[F.lit(max(min(1.0, per_label / r["n"]), r["first"] + 2.0**-53)) for r in counts]))

    def bits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "lang": b["lang"], "place": b["place"],
                                "bits": [np.packbits(presence(t, dims)).tobytes() for t in b["text"]]})

    sample = (
        known.where(F.col("place") < F.element_at(below, F.col("lang")))
        .select("doc_id", "lang", "place", "text").mapInPandas(giving_back(bits), "doc_id long, lang string, place double, bits binary").toPandas()
        .sort_values(["place", "doc_id", "lang", "bits"]).drop_duplicates(["doc_id", "lang"], ignore_index=True)
    )
    lang = pd.Index(model["labels"]).get_indexer(sample["lang"])
    x = np.stack([np.frombuffer(b, np.uint8) for b in sample["bits"]])
    each = max(-(-n_landmarks // len(counts)), min(-(-n_landmarks // full_languages), 4 * n_landmarks // len(counts)), 1)
    order = np.argsort(lang, kind="stable")
    rank = np.arange(len(lang)) - np.searchsorted(lang[order], lang[order])
    landmarks = np.unpackbits(x[np.sort(order[rank < each])], axis=1, count=dims).astype(np.float32)
    value, vector = np.linalg.eigh(kernel(landmarks, landmarks).astype(np.float64))
    inverse_root = vector / np.sqrt(np.maximum(value, 1e-4))
    z = np.hstack([_kernel_of_bits(x, landmarks, dims) @ inverse_root, np.ones((len(x), 1))])
    size = np.bincount(lang, minlength=len(counts))
    weighted = (len(x) / len(counts) / size[lang])[:, None] * z
    # targets are 1 for a text's own label and -1 for the others
    own = np.add.reduceat(weighted[order], np.searchsorted(lang[order], np.arange(len(counts))), axis=0).T
    target = 2 * own - weighted.sum(0)[:, None]
    b = np.linalg.solve(z.T @ weighted + ridge * len(x) * np.diag([1.0] * (z.shape[1] - 1) + [1e-6]), target)
    model |= {"landmarks": np.packbits(landmarks.astype(bool), axis=1), "weights": (inverse_root @ b[:-1]).astype(np.float32), "bias": b[-1].astype(np.float32)}
    return model


RESULT = StructType([StructField("lang_pred", StringType()), StructField("score", DoubleType())])


def with_language(docs: DataFrame, model: dict, batch_rows: int = 128,
                  names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` with the label and its score, from ``text`` alone, as columns
    ``names``, in place of columns that have these names."""
    (result,) = unused(docs, "_language")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = shared.value
        labels = np.array(m["labels"], object)
        landmarks = np.unpackbits(m["landmarks"], axis=1, count=m["dims"]).astype(np.float32) if len(labels) else None
        for texts in batches:
            pred = np.full(len(texts), UNKNOWN, object)
            score = np.zeros(len(texts))
            rows = [i for i, t in enumerate(texts) if isinstance(t, str) and LETTER.search(t)] if len(labels) else []
            for at in range(0, len(rows), batch_rows):
                own = rows[at:at + batch_rows]
                f = kernel(np.stack([presence(texts.iat[i], m["dims"]) for i in own]), landmarks) @ m["weights"] + m["bias"]
                p = np.exp(SHARPNESS * (f - f.max(1, keepdims=True)).astype(np.float64))
                p /= p.sum(1, keepdims=True)
                pred[own], score[own] = labels[p.argmax(1)], p.max(1)
            yield pd.DataFrame({"lang_pred": pred, "score": score})

    # marked so that a filter on its result doesn't make Spark evaluate it twice
    apply = F.pandas_udf(giving_back(predict), RESULT, F.PandasUDFType.SCALAR_ITER).asNondeterministic()
    out = docs.withColumn(result, apply("text"))
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in [n.lower() for n in names]]
    return out.select(*kept, F.col(result)["lang_pred"].alias(names[0]), F.col(result)["score"].alias(names[1]))


def keep_known(docs: DataFrame, model: dict) -> DataFrame:
    """``docs`` without the rows whose text is NULL or has no letter.  The predicted
    label is written into ``lang`` where that is NULL; other labels stay, and so
    do all where there is nothing to learn from."""
    if not model["labels"]:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    label, score = unused(docs, "lang_pred", "score")
    known = with_language(docs, model, names=(label, score)).where(F.col(label) != UNKNOWN)
    return known.select(*[F.coalesce("lang", label).alias(c) if c == "lang" else F.col(f"`{c}`") for c in docs.columns])


def op2_language_id(docs: DataFrame) -> DataFrame:
    model = fit(docs)
    return with_language(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
