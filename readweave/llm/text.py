"""Vectorised text primitives: numpy over the byte buffers of Arrow string columns.

Texts are handled whole, as UTF-8 bytes. A null text counts as an empty one everywhere.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: A-Z to a-z, other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of words that white space (0x20, 0x09-0x0D) parts.
SPACED = np.ones(256, dtype=bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False
#: Bytes of words made of digits, letters and all that is beyond ASCII.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

#: Text bytes that one numpy step takes at once (or one text, if that is longer).
BLOCK_BYTES = 4 << 20

U = np.uint64
P1, P2, P3, P4, P5 = (U(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def plain(column: pa.Array) -> pa.Array:
    """The column without nulls."""
    return pc.fill_null(column, "") if column.null_count else column


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in a row and the offsets (int64, one more than texts) at which each begins."""
    column = plain(column)
    if pa.types.is_large_string(column.type):
        kind = np.int64
    else:
        kind = np.int32
        if not pa.types.is_string(column.type):
            column = column.cast(pa.string())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    held = column.buffers()[2]
    data = np.frombuffer(held, np.uint8)[offsets[0] : offsets[-1]] if held is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """An Arrow string column over bytes and offsets."""
    return pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data)))


def blocks(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most limit bytes of text each, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        at = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64))
        first = 0
        while first < len(at):
            done = at[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(at, done + limit, "right")))
            yield batch.slice(first, last - first)
            first = last
    release()


def gathered(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """The batches joined or sliced to about limit bytes of text each, for work that gains from more texts at once."""
    held, size = [], 0
    for part in blocks(batches, column, limit):
        n = int(pc.sum(pc.binary_length(part.column(column))).as_py() or 0)
        if held and size + n > limit:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
        held.append(part)
        size += n
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
    release()


def release() -> None:
    """Give freed memory back to the system, so that a worker between tasks holds little."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def pack(values: np.ndarray) -> bytes:
    """An array's bytes, equal places together, compressed."""
    raw = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T.tobytes() if len(values) else b""
    return len(raw).to_bytes(8, "little") + (pa.compress(raw, "zstd", asbytes=True) if raw else b"")


def unpack(held: bytes, kind: type) -> np.ndarray:
    size, width = int.from_bytes(held[:8], "little"), np.dtype(kind).itemsize
    if not size:
        return np.zeros(0, kind)
    raw = np.frombuffer(pa.decompress(held[8:], decompressed_size=size, codec="zstd"), np.uint8)
    return np.ascontiguousarray(raw.reshape(width, -1).T).view(kind).reshape(-1)


def word_spans(data: np.ndarray, offsets: np.ndarray, member: np.ndarray = SPACED) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of the words of all texts; first[i]:first[i+1] are those of text i."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = member[data]
    cut = np.zeros(n + 1, dtype=bool)
    cut[offsets] = True
    before = np.empty(n, dtype=bool)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | cut[:n]))
    after = np.empty(n, dtype=bool)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words with one space after each: bytes, new starts, new ends."""
    lengths = ends - starts
    to = np.concatenate([[0], np.cumsum(lengths + 1)])
    out = np.full(int(to[-1]), 0x20, np.uint8)
    if len(starts):
        inside = np.ones(len(out), dtype=bool)
        inside[to[1:] - 1] = False
        keep = np.zeros(len(data) + 1, np.int8)
        keep[starts] += 1  # starts are distinct, and so are ends
        keep[ends] -= 1
        out[inside] = data[np.cumsum(keep[:-1], dtype=np.int8).astype(bool)]
    return out, to[:-1], to[1:] - 1


def rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << U(r)) | (x >> U(64 - r))


def mix(h: np.ndarray) -> np.ndarray:
    """The final mixing of XXH64."""
    h = (h ^ (h >> U(33))) * P2
    h = (h ^ (h >> U(29))) * P3
    return h ^ (h >> U(32))


def _same_length(at8, at4, data, pos, length: int, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        if length >= 32:
            s = U(seed)
            v = [np.full(len(pos), s + P1 + P2), np.full(len(pos), s + P2), np.full(len(pos), s), np.full(len(pos), s - P1)]
            for _ in range(length // 32):
                for k in range(4):
                    v[k] = rotl(v[k] + at8[pos] * P2, 31) * P1
                    pos = pos + 8
            h = rotl(v[0], 1) + rotl(v[1], 7) + rotl(v[2], 12) + rotl(v[3], 18)
            for k in range(4):
                h = (h ^ (rotl(v[k] * P2, 31) * P1)) * P1 + P4
        else:
            h = np.full(len(pos), U(seed) + P5)
        h = h + U(length)
        rest = length % 32
        while rest >= 8:
            h = rotl(h ^ (rotl(at8[pos] * P2, 31) * P1), 27) * P1 + P4
            pos, rest = pos + 8, rest - 8
        if rest >= 4:
            h = rotl(h ^ (at4[pos].astype(U) * P1), 23) * P2 + P3
            pos, rest = pos + 4, rest - 4
        for _ in range(rest):
            h = rotl(h ^ (data[pos].astype(U) * P5), 11) * P1
            pos = pos + 1
        return mix(h)


def xxh64(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 42) -> np.ndarray:
    """XXH64 of data[starts[i]:ends[i]] for every i, spans of one length at a time."""
    out = np.empty(len(starts), U)
    if not len(starts):
        return out
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    at8 = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
    at4 = np.ndarray((len(padded) - 3,), "<u4", padded, strides=(1,))
    lengths = ends - starts
    order = np.argsort(lengths.astype(np.uint16) if lengths.max() < 1 << 16 else lengths, kind="stable")
    ordered = lengths[order]
    edges = np.flatnonzero(np.diff(ordered)) + 1
    for a, b in zip([0, *edges], [*edges, len(order)], strict=True):
        own = order[a:b]
        out[own] = _same_length(at8, at4, padded, starts[own], int(ordered[a]), seed)
    return out


def code_points(data: np.ndarray) -> np.ndarray:
    """For each byte offset (one more than bytes) the number of code points that begin before it."""
    out = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=out[1:])
    return out


def shingle_spans(first: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last word of every shingle of all texts, and the shingles' own first-offsets by text.

    A text of fewer words, but not none, has one shingle of all its words.
    """
    n = np.diff(first)
    count = np.where(n >= words, n - words + 1, np.minimum(n, 1))
    at = np.concatenate([[0], np.cumsum(count)])
    begin = np.arange(at[-1]) + np.repeat(first[:-1] - at[:-1], count)
    last = np.minimum(begin + words, np.repeat(first[1:], count)) - 1
    return begin, last, at
