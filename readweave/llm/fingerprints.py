"""Document fingerprints: one-permutation MinHash with optimal densification and packed low-order bits.

Every word shingle is hashed once; the hash's top bits choose a bin and each bin keeps its least hash. An
empty bin borrows from the first filled bin of its own random order of all bins, the same order for all
documents, which is a uniform choice among filled bins. The lowest bits of each bin are packed.
Two random bins agree in b bits with probability 2^-b; the likeness takes that out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readweave.llm import text as T
from readweave.session import shuffle_partitions

SHINGLE_WORDS = 5
BINS = 256
BITS = 4
FULL = np.uint64(0xFFFFFFFFFFFFFFFF)

#: Row i: the order in which an empty bin i tries the others.
_ORDER = np.random.default_rng(20170801).permuted(np.tile(np.arange(BINS), (BINS, 1)), axis=1)


def shingle_hashes(column: pa.Array, words: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of all texts, and first-offsets by text."""
    data, offsets = T.buffers(column)
    data = T.LOWER[data]
    starts, ends, first = T.word_spans(data, offsets)
    each = T.xxh64(data, starts, ends)
    begin, last, at = T.shingle_spans(first, words)
    with np.errstate(over="ignore"):
        h = each[begin] if len(begin) else each[:0]
        for k in range(1, words):
            inside = begin + k <= last
            step = (T.rotl(h, 21) ^ each[np.minimum(begin + k, last)]) * T.P1
            h = np.where(inside, step, h)
        return T.mix(h + T.P5), at


def one_permutation(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Packed fingerprints (texts x BINS*BITS/8 bytes) and whether each text has words at all."""
    h, at = shingle_hashes(column)
    n = len(at) - 1
    least = np.full(n * BINS, FULL)
    shift = np.uint64(64 - BINS.bit_length() + 1)
    where = np.repeat(np.arange(n) * BINS, np.diff(at)) + (h >> shift).astype(np.int64)
    np.minimum.at(least, where, h)
    least = least.reshape(n, BINS)
    filled = least != FULL
    some = filled.any(axis=1)
    row, col = np.nonzero(~filled & some[:, None])
    for attempt in range(BINS):
        if not len(row):
            break
        source = _ORDER[col, attempt]
        got = filled[row, source]
        least[row[got], col[got]] = least[row[got], source[got]]
        row, col = row[~got], col[~got]
    low = (least & np.uint64((1 << BITS) - 1)).astype(np.uint8)
    low[~some] = 0
    bits = np.unpackbits(low[:, :, None], axis=2, bitorder="little")[:, :, :BITS].reshape(n, BINS * BITS)
    return np.packbits(bits, axis=1, bitorder="little"), some


def likeness(a: np.ndarray, b: np.ndarray, some_a: np.ndarray, some_b: np.ndarray) -> np.ndarray:
    """Estimated Jaccard likeness of packed fingerprints, row by row, corrected for chance agreement of bits.

    Two texts without words are alike (1); one without and one with words are not (0).
    """
    differ = np.unpackbits(a ^ b, axis=1, bitorder="little").reshape(len(a), BINS, BITS).any(axis=2)
    chance = 2.0**-BITS
    found = ((1 - differ.mean(axis=1)) - chance) / (1 - chance)
    return np.where(some_a & some_b, np.clip(found, 0, 1), (some_a == some_b).astype(float))


def fingerprint(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint): hex fingerprint of every whole text; all zeros for a text without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in T.blocks(batches):
            packed, _ = one_permutation(part.column("text"))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([x.tobytes().hex() for x in packed], pa.string())], ["doc_id", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, fingerprint string")


def _dealt_in_order(docs: DataFrame) -> DataFrame:
    """docs as (bucket, copy, doc_id, text), whole buckets to a task, each in descending doc_id.

    Buckets are ranges of doc_id. Each bucket ends with a copy (copy = 1) of the first row of the next
    lower one, the lowest with one of the first row of all. The driver learns one id for each bucket.
    """
    n = shuffle_partitions(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    at = sorted(set(docs.approxQuantile("doc_id", [k / n for k in range(1, n)], 1 / (8 * n))) if n > 1 else [])
    bounds = np.array(at, np.float64)

    @F.pandas_udf("int")
    def bucket(ids: pd.Series) -> pd.Series:
        return pd.Series(np.where(ids.isna(), 0, np.searchsorted(bounds, ids.fillna(-np.inf).to_numpy(np.float64)))).astype("int32")

    tops = {r[0]: r[1] for r in docs.groupBy(bucket("doc_id").alias("b")).agg(F.max("doc_id")).collect()}
    held = sorted(tops)
    #: id of a bucket's first row -> the buckets that end with a copy of it
    wanted: dict = {}
    for k, b in enumerate(held):
        wanted.setdefault(tops[b], []).append(held[(k + 1) % len(held)])
    nulls = wanted.pop(None, [])

    @F.pandas_udf("array<int>")
    def places(ids: pd.Series) -> pd.Series:
        own = np.where(ids.isna(), 0, np.searchsorted(bounds, ids.fillna(-np.inf).to_numpy(np.float64)))
        keys = ids.astype("Int64")
        return pd.Series([[-1 - int(b), *(nulls if x is pd.NA else wanted.get(x, []))] for b, x in zip(own, keys, strict=True)])

    return (
        docs.withColumn("place", F.explode(places("doc_id")))
        .select(F.when(F.col("place") < 0, -1 - F.col("place")).otherwise(F.col("place")).alias("bucket"), (F.col("place") >= 0).cast("int").alias("copy"), "doc_id", "text")
        .repartition(n, "bucket")
        .sortWithinPartitions("bucket", "copy", F.col("doc_id").desc_nulls_last(), F.col("text").asc_nulls_first())
    )


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every whole text and of its edited text, and the likeness of neighbours.

    The edited text has the last floor(n/2) code points replaced by the first as many (or all) of the next
    document in descending doc_id; after the last comes the first. Rows with equal ids follow each other by
    text, rows without an id come last; a null text is empty; a single row is its own next.
    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.
    """
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def ready(ids: list, texts: list[str]) -> pa.RecordBatch:
        """All rows but the last, which is only the next of the one before."""
        packed, some = one_permutation(pa.array(texts, pa.large_string()))
        edits = [t[: len(t) - len(t) // 2] + after[: len(t) // 2] for t, after in zip(texts, texts[1:], strict=False)]
        changed, left = one_permutation(pa.array(edits, pa.large_string()))
        own, has = packed[:-1], some[:-1]
        columns = [
            pa.array(ids[:-1], pa.int64()),
            pa.array([len(t) for t in texts[:-1]], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edits], pa.string()),
            pa.array([x.tobytes().hex() for x in own], pa.string()),
            pa.array([x.tobytes().hex() for x in changed], pa.string()),
            pa.array(likeness(own, changed, has, left)),
            pa.array(likeness(own, packed[1:], has, some[1:])),
        ]
        return pa.RecordBatch.from_arrays(columns, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, size, at, over = [], [], 0, None, False
        for part in T.blocks(batches):
            for b, copy, i, t in zip(*(part.column(c).to_pylist() for c in ("bucket", "copy", "doc_id", "text")), strict=True):
                if b != at:
                    ids, texts, size, at, over = [], [], 0, b, False
                if over:
                    continue
                over = bool(copy)
                ids.append(i)
                texts.append(t or "")
                size += len(texts[-1])
                if over or size > T.BLOCK_BYTES:
                    if len(ids) > 1:
                        yield ready(ids, texts)
                    ids, texts, size = ids[-1:], texts[-1:], len(texts[-1])

    return _dealt_in_order(docs).mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
