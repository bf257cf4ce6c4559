"""Token counts of the best unigram segmentation, by dynamic programming on a trie of distinct pre-tokens.

The distinct pre-tokens of a block of texts form a trie. Its nodes are solved level by level: the best
forward score of a node is the best over all pieces that end there of the ancestor's forward score plus
the piece's log-probability, computed once however many pre-tokens share the prefix. The nodes of one
level are solved together in numpy. Each terminal stores its count of pieces, and a text's count
is the sum over its pre-tokens.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readweave.llm import text as T

#: A byte that no piece covers costs this much more than the least likely piece.
BYTE_PENALTY = 10.0
MARK = "▁"  # a pre-token begins with it, as the vocabulary's pieces that begin a word do
#: Bytes from which a pre-token is solved by itself, and bytes of one that are looked up at once.
LONG = 256
LONG_STEP = 1 << 15
BASE = np.uint64(0x9E3779B97F4A7C15) | np.uint64(1)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _hash(piece: bytes) -> int:
    h = 0
    for b in piece:
        h = (h * int(BASE) + b + 1) & 0xFFFFFFFFFFFFFFFF
    return h


class Pieces:
    """A vocabulary with log-probabilities, looked up by hash of the bytes."""

    def __init__(self, scores: dict[bytes, float]):
        self.longest = max(map(len, scores), default=1)
        hashes = np.array([_hash(p) for p in scores], np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.scores = hashes[order], np.array(list(scores.values()))[order]
        if (self.hashes[1:] == self.hashes[:-1]).any():
            raise ValueError("two pieces have one hash")
        self.unknown = float(self.scores.min(initial=0.0)) - BYTE_PENALTY
        self.table = np.zeros(1 << 18, dtype=bool)
        self.table[(self.hashes >> np.uint64(46)).astype(np.int64)] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of hashes that are pieces, and their scores."""
        at = np.flatnonzero(self.table[(hashes >> np.uint64(46)).astype(np.int64)])
        which = np.minimum(np.searchsorted(self.hashes, hashes[at]), len(self.hashes) - 1)
        ok = self.hashes[which] == hashes[at]
        return at[ok], self.scores[which[ok]]


@lru_cache(2)
def zipf_pieces(path: str) -> Pieces:
    """The pieces of a public vocabulary with log-probabilities by Zipf's law of their rank in it."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    kept = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    norm = np.log(np.sum(1 / np.arange(2.7, len(kept) + 2.7)))
    return Pieces({model.id_to_piece(i).encode(): float(-np.log(k + 2.7) - norm) for k, i in enumerate(kept)})


def count_pieces(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, pieces: Pieces) -> np.ndarray:
    """Pieces in the best segmentation of each of the distinct byte strings; of equally good ones the fewest.

    The strings are the trie's terminals. A level's nodes are the distinct prefixes of that length.
    """
    mark = np.frombuffer(MARK.encode(), np.uint8)
    n = len(starts)
    out = np.zeros(n, np.int64)
    if not n:
        return out
    lengths = ends - starts + len(mark)
    deepest = int(lengths.max())
    # level 0 is the root; of each level: hash from the root, forward score, count of pieces
    node = np.zeros(n, np.int64)  # of each string, its node on the present level
    live = np.arange(n)
    powers = np.ones(pieces.longest + 1, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(1, len(powers)):
            powers[k] = powers[k - 1] * BASE
        levels = [(np.zeros(1, np.uint64), np.zeros(1), np.zeros(1, np.int64), np.zeros(1, np.int64))]
        for depth in range(1, deepest + 1):
            live = live[lengths[live] >= depth]
            byte = np.full(len(live), mark[depth - 1], np.uint8) if depth <= len(mark) else data[starts[live] + depth - 1 - len(mark)]
            edge, inverse = np.unique(node[live] * 256 + byte, return_inverse=True)
            parent, byte = edge // 256, (edge % 256).astype(np.uint64)
            node[live] = inverse
            root = levels[-1][0][parent] * BASE + byte + np.uint64(1)
            best = levels[-1][1][parent] + pieces.unknown
            count = levels[-1][2][parent] + 1
            up = parent
            for m in range(1, min(depth, pieces.longest) + 1):
                before, score, number, above = levels[-m]
                at, gain = pieces.find(root - before[up] * powers[m])
                if len(at):
                    total, c = score[up[at]] + gain, number[up[at]] + 1
                    better = (total > best[at]) | ((total == best[at]) & (c < count[at]))
                    best[at[better]], count[at[better]] = total[better], c[better]
                up = above[up]
            done = lengths[live] == depth
            out[live[done]] = count[node[live[done]]]
            levels.append((root, best, count, parent))
            if len(levels) > pieces.longest + 1:
                levels.pop(0)
    return out


def count_long(data: np.ndarray, pieces: Pieces) -> int:
    """What count_pieces gives for one string alone, in time by its length and memory by LONG_STEP bytes.

    All pieces that lie anywhere in a stretch are looked up at once by differences of hashes; the scores then run
    along the string over these pieces only.
    """
    data = np.concatenate([np.frombuffer(MARK.encode(), np.uint8), data])
    n, longest = len(data), pieces.longest
    score, count = [0.0] + [-np.inf] * n, [0] * (n + 1)
    with np.errstate(over="ignore"):
        for a in range(0, n, LONG_STEP):
            b = min(a + LONG_STEP, n)
            own = data[max(a - longest, 0) : b]
            shift = b - len(own)
            power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(own), BASE)]), dtype=np.uint64)
            back = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(own), np.uint64(pow(int(BASE), -1, 1 << 64)))]), dtype=np.uint64)
            root = np.concatenate([[np.uint64(0)], np.cumsum((own.astype(np.uint64) + np.uint64(1)) * back[1:], dtype=np.uint64)]) * power
            begins, ends, gains = [np.arange(a, b)], [np.arange(a, b) + 1], [np.full(b - a, pieces.unknown)]
            for m in range(1, min(longest, len(own)) + 1):
                at, gain = pieces.find(root[m:] - root[:-m] * power[m])
                inside = at + shift + m > a
                begins.append(at[inside] + shift)
                ends.append(at[inside] + shift + m)
                gains.append(gain[inside])
            begin, end, gain = (np.concatenate(x) for x in (begins, ends, gains))
            order = np.argsort(end, kind="stable")
            for i, j, g in zip(begin[order].tolist(), end[order].tolist(), gain[order].tolist(), strict=True):
                total = score[i] + g
                if total > score[j] or (total == score[j] and count[i] + 1 < count[j]):
                    score[j], count[j] = total, count[i] + 1
    return count[n]


def count_all(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, pieces: Pieces) -> np.ndarray:
    """count_pieces, with strings longer than LONG bytes, which share few prefixes, solved by themselves."""
    out, long = np.zeros(len(starts), np.int64), ends - starts > LONG
    out[~long] = count_pieces(data, starts[~long], ends[~long], pieces)
    out[long] = [count_long(data[a:b], pieces) for a, b in zip(starts[long].tolist(), ends[long].tolist(), strict=True)]
    return out


def count_tokens(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_words, n_tokens) for every row of docs, over the whole text.

    Pre-tokens are runs without white space, each with the word mark before it. A null or empty text has
    none and no tokens. Log-probabilities are not trained: they follow Zipf's law of a piece's rank in the vocabulary.
    Repeated rows stay. Only doc_id and text are read.
    """
    path = path or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in T.gathered(batches, limit=8 << 20):
            data, offsets = T.buffers(part.column("text"))
            starts, ends, first = T.word_spans(data, offsets)
            flat, a, b = T.joined(data, starts, ends)
            coded = T.strings(flat, np.concatenate([a, [len(flat)]])).dictionary_encode()  # each with a space at its end
            kept, at = T.buffers(coded.dictionary)
            counts = count_all(kept, at[:-1], at[1:] - 1, zipf_pieces(path))
            total = np.concatenate([[0], np.cumsum(counts[coded.indices.to_numpy()])])
            n = total[first[1:]] - total[first[:-1]]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(np.diff(first)), pa.array(n)], ["doc_id", "n_words", "n_tokens"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, n_words long, n_tokens long")
