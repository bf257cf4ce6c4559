"""Benchmark decontamination: a prefix-filtered set join of item windows with documents.

Each benchmark item is cut into windows of a fixed number of consecutive words (a shorter item is one
window). A window must be contained whole, so of its words ordered by rarity the necessary prefix is one:
its rarest word by the counts over all documents. Documents are joined on those rarest words only; the
place of the word in the window fixes where the window would begin (positional bound), which must leave
room for all of it inside the document (length bound). What remains is compared word by word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from readweave.llm import text as T
from readweave.session import materialize

WINDOW = 10
#: Item bytes that one broadcast index may be made of; a larger benchmark is joined in several blocks.
BLOCK_OF_ITEMS = 8 << 20
SPANS = ArrayType(StructType().add("start", "integer").add("end", "integer").add("item_id", "string"))


def words_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes and starts, ends, first-offsets of the words of all texts."""
    data, offsets = T.buffers(column)
    data = T.LOWER[data]
    return data, *T.word_spans(data, offsets, T.ALNUM)


class Filter:
    """Membership of many hashes in a sorted set, by a bit table first."""

    BITS = 20

    def __init__(self, values: np.ndarray):
        self.values = np.unique(values)
        self.table = np.zeros(1 << self.BITS, dtype=bool)
        self.table[(self.values & np.uint64((1 << self.BITS) - 1)).astype(np.int64)] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of hashes that are members, and which."""
        at = np.flatnonzero(self.table[(hashes & np.uint64((1 << self.BITS) - 1)).astype(np.int64)])
        if not len(at) or not len(self.values):
            return at[:0], at[:0]
        which = np.minimum(np.searchsorted(self.values, hashes[at]), len(self.values) - 1)
        ok = self.values[which] == hashes[at]
        return at[ok], which[ok]


class Index:
    """Windows of a block of items, to be found by their rarest word."""

    def __init__(self, ids: list[str], texts: list, window: int):
        data, starts, ends, first = words_of(pa.array(texts, pa.string()))
        hashes = T.xxh64(data, starts, ends)
        flat, new_starts, new_ends = T.joined(data, starts, ends)
        begin, last, at = T.shingle_spans(first, window)
        self.ids = ids
        self.item = np.repeat(np.arange(len(ids)), np.diff(at))
        self.length = last - begin + 1
        width = int(self.length.max()) if len(begin) else 0
        self.words = np.zeros((len(begin), width), np.uint64)
        for j in range(width):
            inside = j < self.length
            self.words[inside, j] = hashes[begin[inside] + j]
        self.exact = [flat[a:b].tobytes() for a, b in zip(new_starts[begin], new_ends[last], strict=True)]
        self.vocabulary = np.unique(hashes)

    def order(self, counts: dict[int, int]) -> None:
        """Choose every window's rarest word; ties go to the smaller hash, then to the first place."""
        n = np.array([counts.get(int(w), 0) for w in self.vocabulary.view(np.int64)], np.int64)
        if not len(self.words):
            self.rare = Filter(np.zeros(0, np.uint64))
            self.first = np.zeros(1, np.int64)
            return
        rank = np.empty(len(n), np.int64)
        rank[np.lexsort((self.vocabulary, n))] = np.arange(len(n))
        place = rank[np.minimum(np.searchsorted(self.vocabulary, self.words), len(n) - 1)]
        place[np.arange(self.words.shape[1]) >= self.length[:, None]] = len(n)
        self.offset = place.argmin(axis=1)
        chosen = self.words[np.arange(len(self.words)), self.offset]
        self.rare = Filter(chosen)
        which = np.searchsorted(self.rare.values, chosen)
        self.by_word = np.argsort(which, kind="stable")
        self.first = np.searchsorted(which[self.by_word], np.arange(len(self.rare.values) + 1))

    def occurrences(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, first word within all texts, window) of every window that occurs."""
        hashes = T.xxh64(data, starts, ends)
        at, which = self.rare.find(hashes)
        count = self.first[which + 1] - self.first[which]
        window = self.by_word[np.arange(count.sum()) + np.repeat(self.first[which] - (np.cumsum(count) - count), count)] if len(at) else at
        begin = np.repeat(at, count) - self.offset[window] if len(at) else at
        doc = np.searchsorted(first, np.repeat(at, count), "right") - 1
        if not len(begin):
            return begin, begin, begin
        ok = (begin >= first[doc]) & (begin + self.length[window] <= first[doc + 1])
        doc, begin, window = doc[ok], begin[ok], window[ok]
        for j in range(self.words.shape[1]):
            short = j >= self.length[window]
            same = short | (hashes[np.minimum(begin + j, len(hashes) - 1)] == self.words[window, j])
            doc, begin, window = doc[same], begin[same], window[same]
        ok = np.array([b" ".join(data[starts[b + j] : ends[b + j]].tobytes() for j in range(self.length[w])) == self.exact[w] for b, w in zip(begin, window, strict=True)], bool)
        return (doc[ok], begin[ok], window[ok]) if len(ok) else (doc, begin, window)


def _counts(docs: DataFrame, vocabulary: np.ndarray) -> dict[int, int]:
    """Occurrences of the vocabulary's hashes over all documents, summed by task before the shuffle."""
    known = Filter(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(known.values), np.int64)
        for part in T.blocks(batches):
            data, starts, ends, _ = words_of(part.column("text"))
            total += np.bincount(known.find(T.xxh64(data, starts, ends))[1], minlength=len(total))
        yield pa.RecordBatch.from_arrays([pa.array(known.values.view(np.int64)), pa.array(total)], ["word", "n"])

    found = docs.select(F.col("text").cast("string")).mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {r[0]: r[1] for r in found.collect()}  # at most one row for each benchmark word of the block


def _item_blocks(benchmark: DataFrame) -> Iterator[tuple[list[str], list[str]]]:
    """Items in blocks of a bounded size, each text whole."""
    ids, texts, size = [], [], 0
    chosen = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    for row in chosen.toLocalIterator():
        ids.append(row.item_id)
        texts.append(row.text)
        size += len(row.text)
        if size > BLOCK_OF_ITEMS:
            yield ids, texts
            ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def _merged(doc: np.ndarray, begin: np.ndarray, end: np.ndarray, item: np.ndarray) -> tuple[np.ndarray, ...]:
    """Ranges that touch or overlap, of one text and item, as one."""
    order = np.lexsort((begin, item, doc))
    doc, begin, end, item = doc[order], begin[order], end[order], item[order]
    if not len(doc):
        return doc, begin, end, item
    new = np.ones(len(doc), dtype=bool)
    # windows of one item are equally long, so ends ascend with begins
    new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (begin[1:] > end[:-1])
    heads = np.flatnonzero(new)
    tails = np.concatenate([heads[1:], [len(doc)]]) - 1
    return doc[heads], begin[heads], end[tails], item[heads]


def find_passages(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text", passed: list[str] | None = None) -> DataFrame:
    """docs (or its columns in passed) and two columns: n_words, and spans, the word ranges (end exclusive) where benchmark windows occur.

    Words are runs of ASCII digits and letters (A-Z lower-cased) and of all that is beyond ASCII. spans has
    one entry for each maximal range of touching windows of an item; an item_id that is null counts as "".
    Repeated items count by their ids. A null text has no words; a document of no words no spans; an
    empty benchmark finds nothing. Columns of docs stay (those named n_words or spans are replaced);
    rows stay as they are, each on its own.
    """
    kept = [c for c in docs.columns if c not in ("n_words", "spans")]
    held = docs.select(*dict.fromkeys([*kept, text]))
    fields = {f.name: f for f in held.schema}
    shown = [c for c in (passed or kept) if c in fields]
    schema = StructType([fields[c] for c in dict.fromkeys([*shown, text])]).add("n_words", "long").add("spans", SPANS)
    last = StructType([fields[c] for c in shown]).add("n_words", "long").add("spans", SPANS)
    indexes = (Index(ids, texts, window) for ids, texts in _item_blocks(benchmark))
    index, out = next(indexes, Index([], [], window)), held
    while True:
        index.order(_counts(docs.select(F.col(text).alias("text")), index.vocabulary))
        after = next(indexes, None)
        out = out.mapInArrow(_scan(index, text, (schema if after else last).names), schema if after else last)
        if not after:
            return out
        out, index = materialize(out, "passages"), after


def _scan(index: Index, text: str, names: list[str]):
    """Adds what the index finds to the spans that batches bring along, if any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in T.blocks(batches, text):
            data, starts, ends, first = words_of(part.column(text))
            doc, begin, window = index.occurrences(data, starts, ends, first)
            doc, begin, end, item = _merged(doc, begin, begin + (index.length[window] if len(window) else 0), index.item[window] if len(window) else window)
            has = "spans" in part.schema.names
            found = [list(x or ()) for x in part.column("spans").to_pylist()] if has else [[] for _ in range(part.num_rows)]
            for d, b, e, i in zip(doc.tolist(), (begin - first[doc]).tolist(), (end - first[doc]).tolist(), item.tolist(), strict=True):
                found[d].append({"start": b, "end": e, "item_id": index.ids[i]})
            columns = {c: part.column(c) for c in part.schema.names}
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("item_id", pa.string())]))
            columns |= {"n_words": pa.array(np.diff(first)), "spans": pa.array(found, kind)}
            yield pa.RecordBatch.from_arrays([columns[c] for c in names], names)

    return run


def digest(found: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) from what find_passages gives."""
    # ranges in order of start; a word counts once however many ranges cover it
    covered = F.expr("""aggregate(array_sort(spans, (a, b) -> a.start - b.start), named_struct('n', 0L, 'upto', 0),
        (acc, s) -> named_struct('n', acc.n + greatest(s.end - greatest(s.start, acc.upto), 0), 'upto', greatest(acc.upto, s.end)), acc -> acc.n)""")
    items = F.array_sort(F.array_distinct(F.col("spans.item_id")))
    return found.select(
        "doc_id", "n_words", covered.alias("n_hit"), F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """docs without the documents in which a benchmark window occurs; all columns stay as they are, whatever their names.

    Rows with a null or empty text stay, repeated rows each; an empty benchmark drops nothing, an empty table stays empty.
    """
    named = [f"_column{k}" for k in range(len(docs.columns))]
    found = find_passages(docs.toDF(*named), benchmark, window, named[docs.columns.index("text")])
    return found.where(F.size("spans") == 0).select(*named).toDF(*docs.columns)
