"""SimHash near-duplicates: fingerprints, links within a Hamming distance by pigeonring filtering, components.

A fingerprint's 64 bits are cut into four segments on a ring. If two fingerprints differ in at most 3 bits,
then some segment begins a chain whose cumulative differences after 1, 2, 3 and 4 consecutive segments are
at most 0, 1, 2 and 3, the proportional share of the budget (3/4 a segment, rounded down). So for each of
the four possible first segments, fingerprints are dealt out by that segment, sorted by it and the next
one, and looked up with that next one as it is and with each of its 16 bits flipped. What is found
passes the third link of the chain and then the full Hamming check. Nothing is capped: equal
fingerprints are one class from the start, and crowded runs are solved without listing their pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readweave.llm import jaccard
from readweave.llm import text as T
from readweave.operators.graph import connected_components
from readweave.session import materialize, shuffle_partitions

SHINGLE_WORDS = 3
DISTANCE = 3
SEED = 42
#: Pairs that are expanded at once, and the size of two runs' product beyond which masks are enumerated.
CHUNK_PAIRS = 1 << 21


def _majority(hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Fingerprint (uint64) of each row of hashes at[i]:at[i+1]: bits set in over half of them; zero for none."""
    total = np.diff(at)
    ones = np.zeros((len(total), 64), np.int64)
    owner = np.repeat(np.arange(len(total)), total)
    for a in range(0, len(hashes), 1 << 17):
        part, own = hashes[a : a + (1 << 17)], owner[a : a + (1 << 17)]
        bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        heads = np.concatenate([[0], np.flatnonzero(np.diff(own)) + 1])
        ones[own[heads]] += np.add.reduceat(bits, heads, axis=0, dtype=np.int32)
    most = (2 * ones > total[:, None]).astype(np.uint8)
    return np.packbits(most, axis=1, bitorder="little").view("<u8").reshape(-1).astype(np.uint64)


def simhash(column: pa.Array, words: int = SHINGLE_WORDS) -> np.ndarray:
    """Fingerprints (uint64) of the texts; zero where a text has no words."""
    data, offsets = T.buffers(column)
    data = T.LOWER[data]
    starts, ends, first = T.word_spans(data, offsets)
    flat, starts, ends = T.joined(data, starts, ends)
    begin, last, at = T.shingle_spans(first, words)
    return _majority(T.xxh64(flat, starts[begin], ends[last], SEED) if len(begin) else np.zeros(0, np.uint64), at)


def fingerprint(docs: DataFrame) -> DataFrame:
    """(doc_id, fp long): the SimHash of every whole text. Reads doc_id and text only; a null text is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in T.blocks(batches):
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(simhash(part.column("text")).view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, fp long")


class Union:
    """Vectorised union-find: every row knows the smallest row it hangs together with."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.root[a], self.root[b]
            differ = a != b
            a, b = a[differ], b[differ]
            if not len(a):
                return
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = self.root[self.root]
                if np.array_equal(up, self.root):
                    break
                self.root = up


def _masks(bits: int, weight: int) -> np.ndarray:
    """All masks of at most weight of the given low bits, lightest first."""
    return np.array([sum(1 << b for b in c) for w in range(weight + 1) for c in combinations(range(bits), w)], np.uint64)


def _crowded(union: Union, low: np.ndarray, a0: int, a1: int, b0: int, b1: int, left: int) -> None:
    """Link rows a0:a1 with rows b0:b1 of two sorted runs whose low 32 bits differ in at most left bits.

    Looks up every row under every mask, so it costs rows times masks and lists no pairs.
    """
    if a1 - a0 > b1 - b0:
        a0, a1, b0, b1 = b0, b1, a0, a1
    own, other, rows = low[a0:a1], low[b0:b1], np.arange(a0, a1)
    for mask in _masks(32, left):
        at = np.minimum(np.searchsorted(other, own ^ mask), len(other) - 1)
        hit = other[at] == own ^ mask
        if hit.any():
            union.link(rows[hit], at[hit] + b0)


def link_rows(values: np.ndarray) -> np.ndarray:
    """For sorted distinct fingerprints rotated so that the chain's first segment is on top: each one's root."""
    union, n = Union(len(values)), len(values)
    key, low = values >> np.uint64(32), values & np.uint64(0xFFFFFFFF)
    rows = np.arange(n)
    for flip in (None, *range(16)):
        if flip is None:
            lo, hi, own = rows + 1, np.searchsorted(key, key, "right"), rows
            left = DISTANCE
        else:
            own = np.flatnonzero((key >> np.uint64(flip)) & np.uint64(1) == 0)  # each pair once
            want = key[own] | np.uint64(1 << flip)
            lo, hi = np.searchsorted(key, want), np.searchsorted(key, want, "right")
            left = DISTANCE - 1
        some = hi > lo
        own, lo, hi = own[some], lo[some], hi[some]
        if not len(own):
            continue
        # rows of one run ask for the same run; a crowded pair of runs is solved by masks
        heads = np.concatenate([[0], np.flatnonzero(np.diff(key[own])) + 1])
        tails = np.concatenate([heads[1:], [len(own)]])
        size = np.add.reduceat(hi - lo, heads)
        big = size > CHUNK_PAIRS
        for a, b in zip(heads[big], tails[big], strict=True):
            if flip is None:
                _crowded(union, low, int(own[a]), int(hi[a]), int(own[a]), int(hi[a]), left)
            else:
                _crowded(union, low, int(own[a]), int(own[b - 1]) + 1, int(lo[a]), int(hi[a]), left)
        small = np.repeat(~big, tails - heads)
        own, lo, width = own[small], lo[small], (hi - lo)[small]
        done = np.cumsum(width)
        first = 0
        while first < len(own):
            base = done[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(done, base + CHUNK_PAIRS, "right")))
            w = width[first:last]
            a = np.repeat(own[first:last], w)
            b = np.arange(w.sum()) + np.repeat(lo[first:last] - (done[first:last] - w - base), w)
            differ = values[a] ^ values[b]
            third = np.bitwise_count(differ >> np.uint64(16)) <= 2  # the chain's third link
            a, b, differ = a[third], b[third], differ[third]
            near = np.bitwise_count(differ) <= DISTANCE
            union.link(a[near], b[near])
            first = last
    return union.root


def links(classes: DataFrame) -> DataFrame:
    """(src, dst): for classes (fp, rep), one per distinct fingerprint, links of reps that span every linked group.

    Every link within the distance lies inside the groups that these links span, and each of these links
    joins fingerprints that hang together through links within the distance.
    """
    n = shuffle_partitions(classes.sparkSession)
    dealt = (
        classes.where("rep is not null")
        .select("rep", F.expr("posexplode(array(shiftrightunsigned(fp, 48), shiftrightunsigned(fp, 32) & 65535, shiftrightunsigned(fp, 16) & 65535, fp & 65535)) as (turn, seg)"), "fp")
        .repartition(n, "turn", "seg")
        .select("turn", "fp", "rep")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some = [b for b in batches if b.num_rows]
        if not some:
            return
        held = pa.Table.from_batches(some)
        turn = held.column("turn").to_numpy()
        fp, rep = held.column("fp").to_numpy().view(np.uint64), held.column("rep").combine_chunks()
        for t in range(4):
            own = turn == t
            values, reps = fp[own], rep.filter(pa.array(own))
            if len(values) < 2:
                continue
            values = T.rotl(values, 16 * t) if t else values
            order = np.argsort(values)
            values, reps = values[order], reps.take(pa.array(order))
            root = link_rows(values)
            moved = np.flatnonzero(root != np.arange(len(root)))
            yield pa.RecordBatch.from_arrays([reps.take(pa.array(moved)), reps.take(pa.array(root[moved]))], ["src", "dst"])

    kind = classes.schema["rep"].dataType.simpleString()
    return dealt.mapInArrow(run, f"src {kind}, dst {kind}")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fp long, component_id): one row for each row of docs, with the group its text belongs to.

    Texts whose fingerprints differ in at most 3 bits are linked; component_id is the smallest doc_id that
    can be reached. Texts without words have fingerprint zero and link like others. Repeated rows and ids
    stay; a row without an id gets the group of its fingerprint (null if no row of that has an id). Other
    columns of docs are not looked at; no rows give no rows.
    """
    prints = materialize(fingerprint(docs), "simhash")
    classes = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-classes")
    found = connected_components(links(classes))
    named = classes.join(found, classes.rep == found.node, "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def likely_pairs(docs: DataFrame) -> DataFrame:
    """(x, y): keys of five-word shingle sets whose fingerprints are equal, or hang together within the distance."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in T.blocks(batches):
            hashes, at = jaccard.shingle_sets(part.column("text"))
            columns = [jaccard.keys(jaccard.names(hashes, at)), _majority(hashes, at).view(np.int64)]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["key", "fp"]).filter(pa.array(np.diff(at) > 0))

    prints = materialize(docs.select(F.col("text").cast("string")).mapInArrow(run, "key long, fp long").distinct(), "set-prints")
    classes = materialize(prints.groupBy("fp").agg(F.min("key").alias("rep")), "print-classes")
    equal = prints.join(classes, "fp").where("key <> rep").select(F.col("rep").alias("x"), F.col("key").alias("y"))
    return equal.unionAll(links(classes).toDF("x", "y"))


def keep_one_similar(docs: DataFrame) -> DataFrame:
    """docs with one row of each group of texts that five-word shingle similarity of 0.8 or more links.

    Groups are the components of all pairs of Jaccard similarity 0.8 or more, none left out. SimHash with pigeonring
    chains finds the nearest pairs; fingerprints of the other similar pairs differ in ten bits on average and some in over
    twenty, which no budget of bits tells from chance, so the exact join of jaccard.py finds those. Every pair is verified by its
    shingles. The row with the least doc_id stays, of the same doc_id the one with the least digest of its text, rows
    without an id behind all others; texts without words (null, empty) are one group. Rows of the same id and
    text are one, the least by its other columns; rows that share an id but not the text are rows of their own. Columns
    stay as they are, whatever their names; an empty table stays empty.
    """
    key = "_key"
    while key in docs.columns:
        key += "_"
    digest = F.unhex(F.md5(F.concat_ws("\0", F.coalesce(F.col("`doc_id`").cast("string"), F.lit("-")), F.coalesce(F.col("`text`").cast("string"), F.lit("")))))
    named = docs.withColumn(key, digest)
    texts = named.select(F.col(key).alias("k"), F.col("`doc_id`").alias("doc_id"), F.col("`text`").alias("text"))
    rows, found = jaccard.similar_sets(texts, ["k", "doc_id"], likely_pairs(texts))
    rows = rows.select("k", "doc_id", "set_id")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "k"))
    classes = materialize(rows.groupBy("set_id").agg(least.alias("w")), "classes")
    groups = classes.join(found, classes.set_id == found.node, "left").groupBy(F.coalesce("component", "set_id").alias("c")).agg(F.min("w").alias("w"))
    winners = groups.select(F.col("w.k").alias(key))
    losers = materialize(rows.select(F.col("k").alias(key)).distinct().join(winners, key, "left_anti"), "losers")
    repeated = materialize(rows.groupBy("k").count().where("count > 1").select(F.col("k").alias(key)), "repeated")
    # a bounded filter tells which rows may go or be repeated; the texts of all others are not shuffled
    sent = docs.sparkSession.sparkContext.broadcast(jaccard.filter_of(losers.unionAll(repeated).select(F.xxhash64(key).alias("h"))))
    placed = named.withColumn(key + "at", F.pmod(F.xxhash64(key), F.lit(jaccard.FILTER_BITS)))

    def part(marked: bool) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in T.blocks(batches):
                at = batch.column(key + "at").to_numpy()
                yield batch.filter(pa.array(((sent.value[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0) == marked))

        return placed.mapInArrow(run, placed.schema)

    columns = [F.col(f"`{c}`") for c in docs.columns]
    kept = part(True).join(losers, key, "left_anti")
    once = kept.join(repeated, key, "left_anti").select(columns)
    again = kept.join(repeated, key, "left_semi").groupBy(key).agg(F.min(F.struct(*columns)).alias(key + "row"))
    return part(False).select(columns).unionByName(once).unionByName(again.select(f"`{key}row`.*"))
