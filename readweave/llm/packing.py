"""Best-fit packing of tokenised documents into sequences of a fixed capacity by the sum-of-squares rule.

Tokens: white space is never inside a pre-token and normalising works on each word by itself, so a text's
ids are those of its words in a row. Distinct units of a block of texts are encoded once and the
texts' ids are looked up.

Packing: documents are dealt evenly to shards of a bounded number of pieces. A shard takes its pieces
from long to short and puts each into the open sequence for which the sum of squared counts of open
sequences by residual gap becomes smallest; a new one is opened when none has room. Sequences that
stay well open are packed anew across shards, level by level, until one shard holds them all or a level leaves
over nine tenths of the pieces that it was given; after that each shard keeps its part-filled sequences.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readweave.llm import text as T
from readweave.session import materialize

CAPACITY = 2048
END_ID = 0
#: Pieces that one task packs, and the share of the capacity over which a gap counts as well open.
SHARD_PIECES = 16384
OPEN_SHARE = 0.02

LETTER, DIGIT, MARK, GLUE = 1, 2, 3, 4
#: What a byte is: 0 white space, a letter, a digit, a mark, or glue, which keeps its word whole.
KIND = np.full(256, GLUE, np.uint8)
KIND[0x21:0x7F] = MARK
KIND[[0x20, *range(0x09, 0x0E)]] = 0
KIND[0x30:0x3A] = DIGIT
KIND[0x41:0x5B] = KIND[0x61:0x7B] = LETTER
KIND[0x27] = GLUE
KIND[0xC3:0xCA] = LETTER  # with one byte after each: U+00C0 to U+024F


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@lru_cache(4)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


#: Units whose ids a worker remembers between blocks: the first so many that it met.
REMEMBERED = 250_000
_memory: dict[str, dict[str, bytes]] = {}


def _ids(parts: list[str], path: str) -> list[bytes]:
    """Ids of each part as native 32-bit numbers."""
    known = _memory.setdefault(path, {})
    out = [known.get(x) for x in parts]
    missing = [k for k, x in enumerate(out) if x is None]
    for k, e in zip(missing, tokenizer(path).encode_batch_fast([parts[k] for k in missing], add_special_tokens=False), strict=True):
        out[k] = array("I", e.ids).tobytes()
        if len(known) < REMEMBERED:
            known[parts[k]] = out[k]
    return out


def units(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Parts of all texts that can be encoded by themselves, and first-offsets by text.

    A word of plain letters, digits and marks falls into runs of each; a word with anything else stays whole.
    """
    if not len(data):
        return pa.array([], pa.large_string()), np.zeros(len(offsets), np.int64)
    kind = KIND[data]
    lead = (data >= 0xC3) & (data <= 0xC9)
    trail = np.zeros(len(data), dtype=bool)
    trail[1:] = lead[:-1]
    kind[trail] = LETTER
    signs = np.flatnonzero(trail & ((data == 0x97) | (data == 0xB7)))
    signs = signs[data[signs - 1] == 0xC3]  # the multiplication and division signs
    # U+0130, which becomes two code points in lower case
    signs = np.concatenate([signs, np.flatnonzero(trail[1:] & (data[1:] == 0xB0) & (data[:-1] == 0xC4)) + 1])
    kind[signs] = kind[signs - 1] = GLUE
    kind[:-1][(data[:-1] == 0x3C) & (data[1:] == 0x7C)] = GLUE  # special tokens begin so
    starts, ends, _ = T.word_spans(data, offsets)
    glued = np.zeros(len(data) + 1, np.int32)
    np.cumsum(kind == GLUE, out=glued[1:])
    whole = glued[ends] > glued[starts]
    inside = kind > 0
    cut = np.zeros(len(data), dtype=bool)
    cut[1:] = kind[1:] != kind[:-1]
    edge = np.zeros(len(data) + 1, np.int8)
    edge[starts[whole]] += 1  # starts are distinct, and so are ends
    edge[ends[whole]] -= 1
    cut &= ~np.cumsum(edge[:-1], dtype=np.int8).astype(bool)
    cut[starts] = True
    begins = np.flatnonzero(cut & inside)
    packed = np.zeros(len(data) + 1, np.int32)
    np.cumsum(inside, out=packed[1:])
    return T.strings(T.LOWER[data[inside]], np.concatenate([packed[begins], packed[-1:]])), np.searchsorted(begins, offsets)


def encode(column: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids (uint32) of all texts, an end id after each, and first-offsets by text."""
    data, offsets = T.buffers(column)
    parts, first = units(data, offsets)
    coded = parts.dictionary_encode()
    codes = coded.indices.to_numpy().astype(np.int64)
    ids = _ids(coded.dictionary.to_pylist(), path)
    size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
    flat = np.frombuffer(b"".join(ids), np.uint32)
    begin = np.cumsum(size) - size
    count = size[codes]
    done = np.concatenate([[0], np.cumsum(count)])
    at = done[first]
    n = len(first) - 1
    out = np.full(int(done[-1]) + n, END_ID, np.uint32)
    mine = np.ones(len(out), dtype=bool)
    mine[at[1:] + np.arange(n)] = False
    out[mine] = flat[np.arange(done[-1]) + np.repeat(begin[codes] - done[:-1], count)]
    return out, at + np.arange(n + 1)


def cut(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): every document's ids in pieces of at most capacity."""
    path = path or default_tokenizer()
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in T.gathered(batches, limit=4 << 20):
            ids, at = encode(part.column("text"), path)
            total = np.diff(at)
            pieces = -(-total // capacity)
            doc = np.repeat(np.arange(len(total)), pieces)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = piece * capacity
            length = np.minimum(total[doc] - start, capacity)
            raw = memoryview(ids.astype("<u4")).cast("B")
            begin = at[doc] + start
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(begin.tolist(), (begin + length).tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([part.column("doc_id").take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(crc, pa.int64())], names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def place(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequence and offset of each piece and the gap of each sequence, by the sum-of-squares rule."""
    counts = np.zeros(capacity + 1, np.int64)  # open sequences by gap
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    n = 0
    for k in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[k])
        gap = capacity
        if size < capacity:
            # change of the sum for each gap that has room: one sequence fewer there, one more at what is left
            change = 2 * (counts[: capacity - size] - counts[size:capacity]) + 2
            change[0] = 1 - 2 * counts[size]
            change[counts[size:capacity] == 0] = np.iinfo(np.int64).max
            best = int(change.argmin())
            if counts[size + best]:
                gap = size + best
        if gap == capacity:
            own, n = n, n + 1
        else:
            own = waiting[gap].pop()
            counts[gap] -= 1
        sequence[k], offset[k] = own, capacity - gap
        if gap > size:
            waiting[gap - size].append(own)
            counts[gap - size] += 1
    gaps = np.zeros(n, np.int64)
    for g, held in enumerate(waiting):
        gaps[held] = g
    return sequence, offset, gaps


def pack(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """One row for every piece of every row of docs: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Only documents of more than capacity ids are cut, each piece full but the last. A null or empty text is
    the end id alone. Repeated rows are packed each; ids may be null. sequence_id has no meaning but
    identity; offsets in a sequence run from 0 without gaps. Only doc_id and text are read; no rows
    give no rows.
    """
    pieces = materialize(cut(docs, capacity, path), "pieces")
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    full = pieces.where(F.col("length") == capacity).withColumn("sequence_id", -1 - F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))
    done, rest, level, before = full.select(columns), pieces.where(F.col("length") < capacity), 0, None
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long, open boolean"
    while True:
        n = rest.count()
        shards = max(1, -(-n // SHARD_PIECES))
        last = shards == 1 or (before is not None and n > before * 9 // 10)
        packed = rest.withColumn("shard", F.monotonically_increasing_id() % shards).groupBy("shard").applyInArrow(_shard(level, capacity), schema)
        if last:
            return done.unionByName(packed.select(columns))
        packed = materialize(packed, "packed")
        done = done.unionByName(packed.where("not open").select(columns))
        rest, level, before = packed.where("open").select(columns[:5]), level + 1, n


def _shard(level: int, capacity: int):
    def run(key: tuple, held: pa.Table) -> pa.Table:
        sequence, offset, gaps = place(held.column("length").to_numpy(), capacity)
        name = sequence + (level << 56) + (key[0].as_py() << 20)
        keep = held.select(["doc_id", "piece", "start", "length", "ids_crc32"])
        for c, values in (("sequence_id", name), ("offset", offset), ("open", gaps[sequence] > OPEN_SHARE * capacity)):
            keep = keep.append_column(c, pa.array(values))
        return keep

    return run
