"""Periodic runs of words: Karp-Miller-Rosenberg names of power-of-two windows, common extensions by descending levels.

Level 0 names each word of a text, level j + 1 names each window of 2^(j+1) words by the pair of names of its halves, so
two windows of one text are equal exactly if their names are. How far two places agree, forwards or backwards, is read by
going down the levels. A run of period q and at least four periods holds, for some multiple i of 3 q, both the words i
and i + q; so only these grid places are extended. Nothing is hashed and no suffixes are sorted. All texts of a block are
treated at once, none sees another's words: a text's names are its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readweave.llm import text as T

#: A run has at least REPEATS periods and LEAST words.
REPEATS = 4
LEAST = 6
#: Grid places that one numpy step extends.
STEP = 1 << 20


def word_names(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A number for each word, the same for the same bytes."""
    flat, at, to = T.joined(data, starts, ends)
    offsets = np.append(at, len(flat))
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(flat)])
    return words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _numbered(key: np.ndarray) -> np.ndarray:
    """Names 0, 1, ... of equal keys, and -1 for keys that occur once."""
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    new = np.ones(len(key), dtype=bool)
    new[1:] = ordered[1:] != ordered[:-1]
    single = new & np.append(new[1:], True)
    out = np.empty(len(key), np.int64)
    out[order] = np.where(single, -1, np.cumsum(new) - 1)
    return out


class Names:
    """Names of all windows that occur twice in their text; levels stop where none does.

    words: names of the words of all texts, text i having first[i]:first[i+1]. A window that occurs once in its text
    has no name: it equals none but itself.
    """

    def __init__(self, words: np.ndarray, first: np.ndarray):
        n = len(words)
        self.owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        name = _numbered(self.owner * (int(words.max()) + 1 if n else 1) + words)
        width, at = 1, np.flatnonzero(name >= 0)
        last = first[1:][self.owner] if n else first[:0]
        while len(at):
            full = np.full(n, -1, np.int32)
            full[at] = name[at] if width == 1 else name
            self.levels.append(full)
            at = at[at + 2 * width <= last[at]]
            left, right = full[at].astype(np.int64), full[at + width].astype(np.int64)
            some = right >= 0
            at, left, right = at[some], left[some], right[some]
            name = _numbered(left * (int(full.max()) + 1) + right)
            at, name = at[name >= 0], name[name >= 0]
            width *= 2

    def forward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from a on agree with those from b on."""
        return self._extend(a, b, 1)

    def backward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words before a agree with those before b."""
        return self._extend(a, b, -1)

    def _extend(self, a: np.ndarray, b: np.ndarray, way: int) -> np.ndarray:
        out = np.zeros(len(a), np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            names, width = self.levels[level], 1 << level
            # the top level may hold many times, lower ones at most once
            live = np.arange(len(a))
            while len(live):
                x, y = (a[live] + out[live], b[live] + out[live]) if way > 0 else (a[live] - out[live] - width, b[live] - out[live] - width)
                inside = (np.minimum(x, y) >= 0) & (np.maximum(x, y) < len(names))
                live, x, y = live[inside], x[inside], y[inside]
                same = (names[x] == names[y]) & (names[x] >= 0)
                live = live[same]
                out[live] += width
                if level < len(self.levels) - 1:
                    break
        return out


def _grid(first: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, period): multiples of 3 q for every period q that can have a run, of all texts in a row."""
    n = np.diff(first)
    most = n // REPEATS
    owner = np.repeat(np.arange(len(n)), most)
    period = np.arange(len(owner)) - np.repeat(np.cumsum(most) - most, most) + 1
    stride = (REPEATS - 1) * period
    count = (n[owner] - period - 1) // stride + 1
    done = np.cumsum(count)
    lo = 0
    while lo < len(owner):
        base = done[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(done, base + STEP, "right")))
        own = np.repeat(np.arange(lo, hi), count[lo:hi])
        k = np.arange(len(own)) - np.repeat(done[lo:hi] - count[lo:hi] - base, count[lo:hi])
        yield first[owner[own]] + k * stride[own], period[own]
        lo = hi


def find_runs(words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, length, period) of all runs, by text, start, period; start counts from the text's first word."""
    names, found = Names(words, first), [np.zeros((0, 3), np.int64)]
    if names.levels:
        word = names.levels[0]
        for i, q in _grid(first):
            same = (word[i] == word[i + q]) & (word[i] >= 0)
            i, q = i[same], q[same]
            ahead = names.forward(i, i + q)
            behind = names.backward(i, i + q)
            length = ahead + behind + q
            ok = length >= np.maximum(LEAST, REPEATS * q)
            found.append(np.stack([i - behind, length, q], axis=1)[ok])
    runs = np.concatenate(found)
    # one stretch may be found with multiples of its smallest period
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    new = np.ones(len(runs), dtype=bool)
    new[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    start, length, period = runs[new].T
    order = np.lexsort((period, start))
    start, length, period = start[order], length[order], period[order]
    text = names.owner[start] if len(start) else start
    return text, start - first[text], length, period


def _block(column: pa.Array) -> dict[str, pa.Array]:
    """Runs and the collapsed text of each text of a block."""
    data, offsets = T.buffers(column)
    starts, ends, first = T.word_spans(data, offsets)
    words = word_names(data, starts, ends)
    text, start, length, period = find_runs(words, first)
    # words after a run's first period go
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, first[text] + start + period, 1)
    np.add.at(cover, first[text] + start + length, -1)
    keep = np.cumsum(cover)[:-1] == 0
    flat, at, to = T.joined(data, starts[keep], ends[keep])
    own = np.searchsorted(np.flatnonzero(keep), first)
    # each text's words lie in a row with a space after each; the last space is not its own
    begin = np.append(at, len(flat))[own]
    collapsed = pa.array([flat[a : max(a, b - 1)].tobytes().decode() for a, b in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True)], pa.string())
    edge = np.searchsorted(text, np.arange(len(first)))
    held = pa.StructArray.from_arrays([pa.array(start), pa.array(length), pa.array(period)], ["start", "length", "period"])
    runs = pa.ListArray.from_arrays(pa.array(edge.astype(np.int32)), held)
    return {"n_words": pa.array(np.diff(first)), "runs": runs, "collapsed": collapsed}


RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def periodic_runs(docs: DataFrame, passed: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(passed columns, n_words, runs, collapsed): every run of words of each whole text, and the text without the repeats.

    A run is a stretch with smallest period q (words q apart are the same), of at least max(6, 4 q) words, that no
    neighbouring word extends. runs holds (start, length, period) by start, then period; collapsed holds the words, one
    space between, that no run contains after its first q words. A null or empty text has no words, no runs and ''
    for collapsed. Repeated rows and ids stay as they are; columns that are not passed are not looked at; no rows give
    no rows. Texts need no shuffle; a text of any length is treated whole, with memory in proportion to its length.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in T.blocks(batches):
            made = _block(part.column("text"))
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in passed), *made.values()], [*passed, *made])

    kept = docs.select(*passed, F.col("text").cast("string"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema if f.name in passed)
    return kept.mapInArrow(run, f"{fields}, n_words bigint, runs {RUNS}, collapsed string")


def planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text): whole texts of words, a tenth of them made periodic from some word on.

    For h = crc32(doc_id as text) with h % 10 = 0 and n words, word i from a = g % n on becomes word a + (i - a) % p, where
    g = floor(h / 10) and p = 1 + floor((n - a) / (3 + g % 8)). A row without an id is as one of id ''.
    """
    words = F.expr(r"regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+', 0)")
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    chosen = F.col("h") % 10 == 0
    g, n = F.floor(F.col("h") / 10), F.size("w")
    held = docs.select("doc_id", F.col("text").cast("string"), h.alias("h")).withColumn("w", F.when(chosen, words)).withColumn("a", F.when(F.size("w") > 0, g % n))
    period = 1 + F.floor((n - F.col("a")) / (3 + g % 8))
    turned = F.expr("array_join(transform(w, (x, i) -> if(i < a, x, w[cast(a + (i - a) % p as int)])), ' ')")
    return held.withColumn("p", period).select("doc_id", F.when(F.col("a").isNotNull(), turned).otherwise(F.col("text")).alias("text"))


def digest(found: DataFrame) -> DataFrame:
    """One row a document: counts, the run of greatest exponent, digests of all runs and of the collapsed text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs = batch.column("runs")
            edge = runs.offsets.to_numpy().astype(np.int64)
            start, length, period = (runs.values.field(k).to_numpy() for k in range(3))
            own = np.repeat(np.arange(batch.num_rows), np.diff(edge))
            at = np.arange(edge[0], edge[-1])
            start, length, period = start[at], length[at], period[at]
            # lengths stay far below 2^26, so different exponents differ as floats, and equal ones do not
            order = np.lexsort((period, start, -(length / np.maximum(period, 1)), own))
            best = np.full(batch.num_rows, -1)
            heads = np.flatnonzero(np.diff(own[order], prepend=-1))
            best[own[order][heads]] = order[heads]
            none = best < 0
            pick = lambda x: pa.array(x[np.maximum(best, 0)] if len(x) else np.zeros(len(best), np.int64), pa.int64(), mask=none)
            lines = pc.binary_join_element_wise(*(pa.array(x).cast(pa.string()) for x in (start, length, period)), ",").to_pylist() if len(start) else []
            edge = edge - edge[0]
            sums = [hashlib.sha256("".join(x + "\n" for x in lines[a:b]).encode()).hexdigest() for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)]
            texts = [hashlib.sha256(x.encode()).hexdigest() for x in batch.column("collapsed").to_pylist()]
            columns = [batch.column("doc_id"), pa.array(np.diff(edge)), pick(start), pick(length), pick(period), pick(1000 * length // np.maximum(period, 1)), pa.array(sums, pa.string()), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"])

    kind = found.schema["doc_id"].dataType.simpleString()
    return found.select("doc_id", "runs", "collapsed").mapInArrow(run, f"doc_id {kind}, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, collapsed_sha256 string")
