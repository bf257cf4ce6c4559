"""Quality classifier: nearest-neighbour voting over labelled latent-semantic vectors.

Terms are pairs of neighbouring characters, with letters in lower case, capitals, digits and letters
beyond ASCII folded into classes. Their weighted counts are projected on the leading singular
directions of a bounded sample of labelled documents. The sample's vectors and labels are broadcast
(SAMPLE x DIMENSIONS floats, whatever the corpus). Every document's cosine with every labelled vector
is computed, block by block; its nearest ones vote with their similarity as weight.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readweave.llm import text as T

#: Bound on the labelled rows the classifier is fitted on: half of each label, those of least hash.
SAMPLE = 2048
DIMENSIONS = 48
NEIGHBOURS = 25
POWER = 4

#: 64 classes of bytes.
CLASSES = 64
FOLD = np.zeros(256, np.int64)
FOLD[0x61:0x7B] = np.arange(1, 27)
FOLD[0x41:0x5B] = 27
FOLD[0x30:0x3A] = 28
for _k, _c in enumerate(b" \n\t.,;:!?-_/\\|*#$%&@+='\"()<>[]{}~^`"):
    FOLD[_c] = 29 + min(_k, CLASSES - 33)
FOLD[0x80:0xC0] = CLASSES - 3
FOLD[0xC0:0xE0] = CLASSES - 2
FOLD[0xE0:] = CLASSES - 1
TERMS = CLASSES * CLASSES
#: Shares of a text that stand beside the terms, each spread over SHARE_BINS slots with this weight.
SHARES = 5
SHARE_BINS = 12
SHARE_WEIGHT = 0.6

LINED = np.ones(256, dtype=bool)
LINED[[0x0A, 0x0D]] = False
NAMED = np.zeros(256, dtype=bool)
NAMED[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def _distinct(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Number of distinct hashes of each text."""
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.lexsort((hashes, doc))
    h, d = hashes[order], doc[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    return np.bincount(d[new], minlength=len(first) - 1)


def shares(column: pa.Array) -> np.ndarray:
    """texts x SHARES, each 0 to 1: distinct words, words like the one before, distinct lines, words that
    are only marks, words that end in a mark. All 0 for a text without words."""
    data, offsets = T.buffers(column)
    starts, ends, first = T.word_spans(data, offsets)
    n = np.maximum(np.diff(first), 1)
    h = T.xxh64(data, starts, ends)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    count = lambda some: np.bincount(doc[some], minlength=len(n))
    same = np.zeros(len(h), dtype=bool)
    same[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    named = np.concatenate([[0], np.cumsum(NAMED[data])])
    marks = named[ends] == named[starts]
    tailed = ~NAMED[data[ends - 1]] & ~marks if len(ends) else marks
    a, b, line = T.word_spans(data, offsets, LINED)
    lines = _distinct(T.xxh64(data, a, b), line) / np.maximum(np.diff(line), 1)
    return np.stack([_distinct(h, first) / n, count(same) / n, lines, count(marks) / n, count(tailed) / n], axis=1)


def term_counts(column: pa.Array) -> np.ndarray:
    """texts x TERMS counts of neighbouring classes (float32)."""
    data, offsets = T.buffers(column)
    n = len(offsets) - 1
    out = np.zeros((n, TERMS), np.float32)
    if len(data) > 1:
        c = FOLD[data]
        pairs = c[:-1] * CLASSES + c[1:]
        for k in range(n):
            a, b = offsets[k], offsets[k + 1] - 1
            if b > a:
                out[k] = np.bincount(pairs[a:b], minlength=TERMS)
    return out


def weighted(counts: np.ndarray, beside: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Unit vectors of weighted terms, and beside them the shares, spread over slots; zero for no terms."""
    x = np.log1p(counts) * weights
    length = np.linalg.norm(x, axis=1, keepdims=True)
    at = np.abs(beside[:, :, None] * (SHARE_BINS - 1) - np.arange(SHARE_BINS))
    slots = np.maximum(1 - at, 0).reshape(len(x), SHARES * SHARE_BINS).astype(np.float32) * SHARE_WEIGHT * (length > 0)
    return np.concatenate([x / np.where(length > 0, length, 1), slots], axis=1)


@dataclass
class Model:
    weights: np.ndarray  # TERMS: inverse document frequency
    basis: np.ndarray  # terms and share slots x DIMENSIONS
    vectors: np.ndarray  # labelled x DIMENSIONS, unit length
    labels: np.ndarray  # 0 or 1
    prior: float

    def project(self, counts: np.ndarray, beside: np.ndarray) -> np.ndarray:
        x = weighted(counts, beside, self.weights) @ self.basis
        length = np.linalg.norm(x, axis=1, keepdims=True)
        return x / np.where(length > 0, length, 1)

    def score(self, column: pa.Array) -> np.ndarray:
        """Share of label 1 in the similarity-weighted votes; the prior where nothing is similar."""
        out = []
        for a in range(0, len(column), 512):
            x = self.project(term_counts(column.slice(a, 512)), shares(column.slice(a, 512)))
            if not len(self.vectors):
                out.append(np.full(len(x), self.prior))
                continue
            near = x @ self.vectors.T
            k = min(NEIGHBOURS, near.shape[1])
            top = np.argpartition(-near, k - 1, axis=1)[:, :k]
            weight = np.maximum(np.take_along_axis(near, top, 1), 0).astype(np.float64) ** POWER
            total = weight.sum(axis=1)
            out.append(np.where(total > 0, (weight * self.labels[top]).sum(axis=1) / np.where(total > 0, total, 1), self.prior))
        return np.clip(np.concatenate(out), 0, 1) if out else np.zeros(0)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on at most sample labelled documents. labels: (doc_id, quality); a document's repeated labels are averaged.

    Labels that are null or whose document is missing do not count. Without any label every score is 0.5.
    """
    marked = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.avg("quality") >= 0.5).cast("int").alias("quality"))
    known = marked.join(docs.select(F.col("doc_id").cast("long").alias("doc_id")), "doc_id", "left_semi")
    totals = {r[0]: r[1] for r in known.groupBy("quality").count().collect()}
    order = [F.xxhash64("doc_id"), "doc_id"]
    chosen = known.where("quality = 0").orderBy(*order).limit(sample // 2).unionAll(known.where("quality = 1").orderBy(*order).limit(sample - sample // 2))
    ids = {r.doc_id: r.quality for r in chosen.collect()}  # at most `sample` rows
    return _fitted(docs, ids, totals)


def _fitted(docs: DataFrame, ids: dict[int, int], totals: dict[int, int]) -> Model:
    wanted = pa.array(sorted(ids), pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        for batch in batches:
            part = batch.filter(pc.is_in(batch.column("doc_id"), wanted))
            for p in T.blocks([part]):
                counts = term_counts(p.column("text"))
                cells = [np.flatnonzero(c) for c in counts]
                term = pa.array([x.astype(np.int16).tobytes() for x in cells], pa.binary())
                n = pa.array([c[x].astype(np.float32).tobytes() for c, x in zip(counts, cells, strict=True)], pa.binary())
                beside = pa.array([x.astype(np.float64).tobytes() for x in shares(p.column("text"))], pa.binary())
                yield pa.RecordBatch.from_arrays([p.column("doc_id"), term, n, beside], ["doc_id", "term", "n", "beside"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, term binary, n binary, beside binary")
    once = {r.doc_id: r for r in rows.groupBy("doc_id").agg(F.min(F.struct("term", "n", "beside")).alias("x")).select("doc_id", "x.*").collect()}
    counts, beside, y = np.zeros((len(once), TERMS), np.float32), np.zeros((len(once), SHARES)), np.zeros(len(once))
    for k, i in enumerate(sorted(once)):
        counts[k, np.frombuffer(once[i].term, np.int16)] = np.frombuffer(once[i].n, np.float32)
        beside[k] = np.frombuffer(once[i].beside, np.float64)
        y[k] = ids[i]
    everything = sum(totals.values())
    prior = totals.get(1, 0) / everything if everything else 0.5
    weights = np.log((1 + len(y)) / (1 + (counts > 0).sum(axis=0))).astype(np.float32) + 1
    x = weighted(counts, beside, weights)
    value, left = np.linalg.eigh((x @ x.T).astype(np.float64)) if len(y) else (np.zeros(0), np.zeros((0, 0)))
    top = np.argsort(-value)[:DIMENSIONS]
    top = top[value[top] > 1e-6]
    basis = (x.T @ left[:, top] / np.sqrt(value[top])).astype(np.float32) if len(top) else np.zeros((TERMS + SHARES * SHARE_BINS, 1), np.float32)
    model = Model(weights, basis, np.zeros((0, basis.shape[1]), np.float32), y, prior)
    model.vectors = model.project(counts, beside).astype(np.float32)
    del once, counts, x, left
    T.release()  # the driver goes on without what the fit took
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) for every row of docs; doc_id, lang, source and labels are no inputs. Null text: empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in T.blocks(batches):
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(model.score(part.column("text")))], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, score double")


def keep_good(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The rows of docs whose score is at least `least`, in one pass, with all their columns.

    A row is judged by its text alone: a null text is an empty one and is judged like any other, equal texts share their fate, repeated rows and
    ids stay as often as they are there, and a score of exactly `least` stays. No column but text is looked at,
    whatever the others are called; no rows give no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in T.blocks(batches):
            yield part.filter(pa.array(model.score(part.column("text")) >= least))

    return docs.mapInArrow(run, docs.schema)
