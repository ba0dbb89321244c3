"""Packing documents into fixed-length token sequences.

Method: first-fit decreasing with a tournament tree of bin capacities, run
independently in randomised groups of documents.  A document's ids (and the
closing id 0) are cut into full sequences and one rest; the rests of a group
are placed first-fit decreasing.  Bins that this leaves with a gap are closed
by cutting the pieces of the emptiest of them, so that a group ends with one
open bin at most.

Scale: the text is read once and never shuffled; ids travel as 16-bit
integers, a row per piece, to one group per ``group_docs`` documents, whose
number grows with the table, so a task's memory does not.  Group and order
depend only on doc_id and ids, so a recomputed task repeats its result.

Ids are those of the tokenizer file read by ``tokenizers``.  A text without
the strings of its special tokens is encoded by ``tiktoken`` from the same
vocabulary as ranks, which gives the same ids several times faster (tested).

Defined cases: a NULL text is empty and packs as the one closing id; a NULL
doc_id is packed like any other; repeated rows are packed once per row; ties
in length go by doc_id and start; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import base64
import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

END_ID = 0
PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, padded_length long, ids binary"


def default_files() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


@functools.lru_cache(maxsize=2)
def _encoder(json_file: str, ranks_file: str):
    """A function from a text to its list of ids."""
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(json_file)
    special = [t.content for t in exact.get_added_tokens_decoder().values()]
    with open(ranks_file, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    fast = tiktoken.Encoding("pieces", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> list[int]:
        if any(s in text for s in special):
            return exact.encode(text, add_special_tokens=False).ids
        return fast.encode_ordinary(text)

    return encode


def first_fit_decreasing(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins of indices of ``sizes``: largest first, each into the first bin with
    room, found by descending a tournament tree whose nodes hold the largest
    free capacity below them."""
    leaves = 1
    while leaves < max(1, len(sizes)):
        leaves *= 2
    free = [capacity] * (2 * leaves)
    bins: list[list[int]] = []
    for item in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        node = 1
        while node < leaves:
            node *= 2
            node += free[node] < sizes[item]
        if node - leaves == len(bins):
            bins.append([])
        bins[node - leaves].append(item)
        free[node] -= sizes[item]
        while node > 1:
            node //= 2
            free[node] = max(free[2 * node], free[2 * node + 1])
    return bins


def _close_gaps(bins: list[list[tuple]], capacity: int, slack: int) -> list[list[tuple]]:
    """Pieces are (row, start, length).  Fills open bins by cutting pieces of
    the emptiest ones; at most one bin stays open."""
    fill = [sum(p[2] for p in b) for b in bins]
    full = [b for b, n in zip(bins, fill, strict=True) if capacity - n <= slack or n & (n - 1) == 0]
    rest = sorted((b for b, n in zip(bins, fill, strict=True) if capacity - n > slack and n & (n - 1)),
                  key=lambda b: -sum(p[2] for p in b))
    while len(rest) > 1:
        gap = capacity - sum(p[2] for p in rest[0])
        while gap and len(rest) > 1:
            row, start, length = rest[-1].pop()
            cut = min(gap, length)
            rest[0].append((row, start, cut))
            if cut < length:
                rest[-1].append((row, start + cut, length - cut))
            if not rest[-1]:
                rest.pop()
            gap -= cut
        if not gap:
            full.append(rest.pop(0))
    return full + rest


def pack(docs: DataFrame, max_tokens: int = 1024, group_docs: int = 2048, slack: int = 8,
         files: tuple[str, str] | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id,
    offset, padded_length and ids (little-endian unsigned 32-bit)."""
    files = files or default_files()
    groups = max(1, -(-docs.count() // group_docs))

    def tokenise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = _encoder(*files)
        for batch in batches:
            out: list[tuple] = []
            held = 0
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids = np.array([*encode(text or ""), END_ID], "<u4")
                doc_id = None if pd.isna(doc_id) else int(doc_id)
                group = zlib.crc32(f"{doc_id}:{zlib.crc32(ids.tobytes())}".encode()) % groups
                narrow = ids.astype("<u2") if ids.max() < 1 << 16 else ids
                for start in range(0, len(ids), max_tokens):
                    part = narrow[start:start + max_tokens]
                    out.append((group, doc_id, start, len(part), len(ids), part.tobytes()))
                held += len(ids)
                if held > 2_000_000:
                    yield frame(out)
                    out, held = [], 0
            if out:
                yield frame(out)

    def frame(rows: list[tuple]) -> pd.DataFrame:
        f = pd.DataFrame(rows, columns=["grp", "doc_id", "start", "length", "doc_tokens", "ids"])
        f["doc_id"] = f["doc_id"].astype("Int64")
        return f

    def place(key, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "start", "ids"], kind="stable").reset_index(drop=True)
        sizes = rows["length"].tolist()
        whole = [i for i, n in enumerate(sizes) if n == max_tokens]
        part = [i for i, n in enumerate(sizes) if n < max_tokens]
        bins = [[(part[k], 0, sizes[part[k]]) for k in b] for b in first_fit_decreasing([sizes[i] for i in part], max_tokens)]
        bins = [[(i, 0, max_tokens)] for i in whole] + _close_gaps(bins, max_tokens, slack)
        ids = [np.frombuffer(b, "<u2" if len(b) == 2 * n else "<u4").astype("<u4") for b, n in zip(rows["ids"], sizes, strict=True)]
        out = []
        for k, pieces in enumerate(bins):
            used = sum(p[2] for p in pieces)
            padded = used if used & (used - 1) == 0 else max_tokens
            offset = 0
            for i, start, length in pieces:
                out.append((i, start, length, key[0] * (1 << 32) + k, offset, padded, ids[i][start:start + length].tobytes()))
                offset += length
        f = pd.DataFrame(out, columns=["i", "cut", "length", "sequence_id", "offset", "padded_length", "ids"])
        f["doc_id"] = rows["doc_id"].astype("Int64").to_numpy()[f["i"]]
        f["doc_id"] = f["doc_id"].astype("Int64")
        f["start"] = rows["start"].to_numpy()[f["i"]] + f["cut"]
        f["doc_tokens"] = rows["doc_tokens"].to_numpy()[f["i"]]
        return f[["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "padded_length", "ids"]]

    cut = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")).mapInPandas(
        tokenise, "grp long, doc_id long, start long, length long, doc_tokens long, ids binary")
    return cut.groupBy("grp").applyInPandas(place, PIECES)


def op3_packing(docs: DataFrame) -> DataFrame:
    return pack(docs).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                             "sequence_id", "offset", "padded_length")
