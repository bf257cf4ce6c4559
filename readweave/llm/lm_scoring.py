"""Language-model scoring: a causal self-attention model over subword ids, and the corpus's lexicon beside it.

Words are cut into subwords by a public byte-level vocabulary, one word at a time, so a text's subwords
stand for its words in a row and nothing else. The attention model (attention.py) gives every subword's
chance. A word's chance is a mixture of two distributions over words: the attention model's, which is the product
over the word's subwords and its end, and the lexicon's, the word's share of all training tokens. The
lexicon holds every distinct word of the corpus; its weight is the one, of SHARES, under which the training texts
are likeliest when each token is left out of its own count.

Texts are cut up once, into blocks whose distinct words and subwords are stored. Counts cover all training
texts: blocks hand over one entry for each distinct word, packed by bucket, buckets add them up, and each
block gets back the counts of its own words. The attention model is trained by local steps of every task over all of
its own training texts, each text in one of the rounds, averaged after each round.
"""

from __future__ import annotations

import base64
import re
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readweave.llm import attention as A
from readweave.llm import text as T
from readweave.llm.text import pack, unpack
from readweave.session import materialize, shuffle_partitions

BLOCK_TEXT = 8 << 20
#: Each training text is trained on in one of so many rounds.
ROUNDS = 2
END = 50256
IDS = 50257
#: Weights of the lexicon to choose from.
SHARES = np.array([0.0, 0.02, 0.05, 0.1, 0.2, 0.3, 0.5])
#: Blocks that add to a bucket of words each time, so that a bucket's size stays bounded as blocks grow in number.
BUCKET_BLOCKS = 8
#: Parameters that are added up in one task.
ADDED = 32
#: Characters of a word that are cut up at once.
LONG_WORD = 512
#: Separators that Python, though not the vocabulary's pattern, takes for white space or the other way round.
_PARTED = re.compile("[\x1c-\x1f\x85]")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@lru_cache(2)
def _encoder(path: str):
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as held:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, held)}
    return tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache(2)
def opening_ids(path: str) -> np.ndarray:
    """Which ids open a word: those whose bytes begin with a space."""
    out = np.zeros(IDS, dtype=bool)
    with open(path, "rb") as held:
        for piece, rank in map(bytes.split, held):
            out[int(rank)] = base64.b64decode(piece).startswith(b" ")
    return out


def subwords(words: list[str], path: str) -> tuple[np.ndarray, np.ndarray]:
    """Subword ids of all words in a row, a space before each, and how many each word has.

    The vocabulary's pattern never joins what a space parts, so plain words are encoded in one go and told apart
    by the ids that open a word. Words that hold other white space, or are very long, are encoded by themselves,
    long ones LONG_WORD characters at a time.
    """
    encoder, size = _encoder(path), np.zeros(len(words), np.int64)
    plain = np.fromiter((len(w) <= LONG_WORD and (w.isascii() or len(w.split()) == 1) and not _PARTED.search(w) for w in words), bool, len(words))
    ids = encoder.encode_to_numpy("".join(" " + w for w, ok in zip(words, plain, strict=True) if ok)).astype(np.uint16)
    begin = np.flatnonzero(opening_ids(path)[ids])
    if len(begin) != plain.sum():
        raise ValueError("the vocabulary's pattern does not part words at spaces")
    size[plain] = np.diff(np.append(begin, len(ids)))
    if plain.all():
        return ids, size
    parts = np.split(ids, begin[1:]) if len(begin) else []
    out: list = [None] * len(words)
    for k, part in zip(np.flatnonzero(plain).tolist(), parts, strict=True):
        out[k] = part
    for k in np.flatnonzero(~plain).tolist():
        w = " " + words[k]
        out[k] = np.array([i for a in range(0, len(w), LONG_WORD) for i in encoder.encode_ordinary(w[a : a + LONG_WORD])], np.uint16)
        size[k] = len(out[k])
    return np.concatenate(out), size


BLOCK = "block long, doc_id array<long>, held binary, first binary, codes binary, words binary, sizes binary, train binary, subs binary, sub_sizes binary, sub_counts binary, train_tokens long"


def blocks_of(docs: DataFrame, path: str) -> DataFrame:
    """Blocks of texts (doc_id, text, held): codes of their words, the distinct words, these words' subwords."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 24
        for k, part in enumerate(T.gathered(batches, limit=BLOCK_TEXT)):
            data, offsets = T.buffers(part.column("text"))
            starts, ends, first = T.word_spans(data, offsets)
            flat, a, _ = T.joined(T.LOWER[data], starts, ends)
            coded = T.strings(flat, np.concatenate([a, [len(flat)]])).dictionary_encode()
            codes = coded.indices.to_numpy()
            # frequent words first, so that most codes are small
            often = np.argsort(-np.bincount(codes, minlength=len(coded.dictionary)), kind="stable")
            rank = np.empty(len(often), np.int32)
            rank[often] = np.arange(len(often))
            codes, dictionary = rank[codes], coded.dictionary.take(pa.array(often))
            held = np.asarray(part.column("held"))
            learnt = np.repeat(~held, np.diff(first))
            train = np.bincount(codes[learnt], minlength=len(dictionary)).astype(np.int32)
            kept, at = T.buffers(dictionary)
            flat_subs, size = subwords([w[:-1] for w in dictionary.to_pylist()], path)
            counts = np.bincount(flat_subs, np.repeat(train, size), IDS).astype(np.int64)
            counts[END] += int((~held).sum())
            row = {
                "block": base + k, "doc_id": part.column("doc_id").to_pylist(), "held": pack(held.astype(np.uint8)), "first": pack(first.astype(np.int32)), "codes": pack(codes),
                "words": pack(kept), "sizes": pack(np.diff(at).astype(np.int32)), "train": pack(train), "subs": pack(flat_subs), "sub_sizes": pack(size.astype(np.int32)), "sub_counts": pack(counts.astype(np.int32)),
                "train_tokens": int(train.sum() + (~held).sum()),
            }
            yield pa.RecordBatch.from_pylist([row], schema=_schema)

    _schema = pa.schema([("block", pa.int64()), ("doc_id", pa.list_(pa.int64()))] + [(c, pa.binary()) for c in ("held", "first", "codes", "words", "sizes", "train", "subs", "sub_sizes", "sub_counts")] + [("train_tokens", pa.int64())])
    return docs.mapInArrow(run, BLOCK)


class Block:
    """A block's texts as slots of subwords, an end after each."""

    def __init__(self, row: dict, slot: np.ndarray):
        self.row = row
        self.held = unpack(row["held"], np.uint8).astype(bool)
        self.first = unpack(row["first"], np.int32).astype(np.int64)
        self.codes = unpack(row["codes"], np.int32)
        self.size = unpack(row["sub_sizes"], np.int32).astype(np.int64)
        self.ids = unpack(row["subs"], np.uint16)
        self.slots = slot[self.ids].astype(np.int32)
        self.end_slot = int(slot[END])

    def sequence(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Slots of the texts docs in that order, first-offsets by text, where words and ends begin, and their codes (an end's is -1)."""
        n, words = len(docs), self.first[docs + 1] - self.first[docs]
        at = np.concatenate([[0], np.cumsum(words)])
        codes = self.codes[np.arange(at[-1]) + np.repeat(self.first[docs] - at[:-1], words)]
        begin, count = np.cumsum(self.size) - self.size, self.size[codes]
        done = np.concatenate([[0], np.cumsum(count)])
        first = done[at] + np.arange(n + 1)
        slots = np.full(int(first[-1]), self.end_slot, np.int32)
        mine = np.ones(len(slots), dtype=bool)
        mine[first[1:] - 1] = False
        slots[mine] = self.slots[np.arange(done[-1]) + np.repeat(begin[codes] - done[:-1], count)]
        named = np.full(len(codes) + n, -1)
        word = np.ones(len(named), dtype=bool)
        word[at[1:] + np.arange(n)] = False
        named[word] = codes
        starts = np.empty(len(named), np.int64)
        starts[word] = done[:-1] + np.repeat(np.arange(n), words)
        starts[~word] = first[1:] - 1
        return slots, first, starts, named

    def chunks(self, docs: np.ndarray, words: int = 200_000) -> Iterator[np.ndarray]:
        """docs in runs of about so many words."""
        total = np.cumsum(self.first[docs + 1] - self.first[docs] + 1)
        yield from (x for x in np.split(docs, np.searchsorted(total, np.arange(words, total[-1], words)) if len(docs) else []) if len(x))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.slice(k, 1).to_pylist()[0]
    T.release()


def _bigrams(blocks: DataFrame, slot: np.ndarray) -> np.ndarray:
    """SLOTS x SLOTS counts of neighbouring slots in all training texts; an end stands before each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = np.zeros(A.SLOTS**2, np.int64)
        for row in _rows(batches):
            block = Block(row, slot)
            for docs in block.chunks(np.flatnonzero(~block.held)):
                s, first, _, _ = block.sequence(docs)
                one = np.concatenate([[0], s[:-1]]).astype(np.int64)
                one[first[:-1]] = block.end_slot
                pairs += np.bincount(one * A.SLOTS + s, minlength=A.SLOTS**2)
        some = np.flatnonzero(pairs)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(pairs[some])], ["pair", "n"])

    out = np.zeros(A.SLOTS**2, np.int64)
    found = blocks.select("held", "first", "codes", "subs", "sub_sizes").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    for batch in found.toArrow().to_batches():  # SLOTS^2 rows at most
        out[batch.column("pair").to_numpy()] = batch.column("n").to_numpy()
    return out.reshape(A.SLOTS, A.SLOTS)


NEEDED = ("block", "held", "first", "codes", "subs", "sub_sizes")


def _with_counts(blocks: DataFrame, words: DataFrame) -> DataFrame:
    """Blocks with the whole corpus's counts of their words. known: distinct training words of the buckets whose first row is this block's."""
    texts = blocks.select("doc_id", *NEEDED)
    schema = pa.schema([("block", pa.int64()), ("doc_id", pa.list_(pa.int64())), *((c, pa.binary()) for c in (*NEEDED[1:], "counts")), ("known", pa.int64())])

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0] | {"known": 0}
        c = np.zeros(unpack(row["sub_sizes"], np.int32).size, np.int64)
        for r in right.to_pylist():
            c[unpack(r["at"], np.int32)] = unpack(r["counts"], np.int64)
            row["known"] += r["known"]
        return pa.Table.from_pylist([row | {"counts": pack(c)}], schema=schema)

    kinds = ", ".join(f"{c} binary" for c in (*NEEDED[1:], "counts"))
    return texts.groupBy("block").cogroup(words.groupBy("block")).applyInArrow(run, f"block long, doc_id array<long>, {kinds}, known long")


_built: dict[str, tuple] = {}


def _model(token: str, sent) -> tuple:
    """The model of a broadcast, its tables built once in each worker."""
    if token not in _built:
        _built.clear()
        slot, openers, bigrams, inside, n, ends = sent.value
        used = np.bincount(slot, minlength=A.SLOTS) > 0
        _built[token] = (slot, A.Tables(bigrams, used, openers), inside, n, ends)
    return _built[token]


def _learnt(held: np.ndarray, block: int, turn: int) -> np.ndarray:
    """The training texts of a block that a round trains on: all of them, each in one of the rounds."""
    docs = np.flatnonzero(~held)
    return docs[(docs + block) % ROUNDS == turn]


class Lexicon:
    """For words of a block: what their subwords cost inside shared slots, and their share of the training tokens."""

    def __init__(self, block: Block, inside: np.ndarray, n: int, ends: int):
        begin = np.concatenate([[0], np.cumsum(inside[block.ids])])
        last = np.cumsum(block.size)
        self.cost = np.append(begin[last] - begin[last - block.size], inside[END])  # the end's is last, at -1
        self.counts = np.append(unpack(block.row["counts"], np.int64), ends)
        self.n = n

    def mixed(self, attended: np.ndarray, codes: np.ndarray, shares: list[float], left_out: int = 0) -> list[np.ndarray]:
        """Natural log-probability of each word under each share; left_out: as if so many of its own occurrences had not been counted."""
        a = attended + self.cost[codes]
        told, by_model = np.maximum(self.counts[codes] - left_out, 0) / max(self.n - left_out, 1), np.exp(a)
        out = []
        for x in shares:
            both = (1 - x) * by_model + x * told
            log = np.log(np.maximum(both, 1e-300))
            # a word too long for a float
            out.append(log if both.min(initial=1) > 1e-300 else np.where(both > 1e-300, log, a + np.log1p(-x)))
        return out


def _trained(texts: DataFrame, token: str, sent) -> tuple[dict[str, np.ndarray], float]:
    """Parameters after one pass over all training texts, averaged after each of its rounds, and the lexicon's weight."""
    p = A.initial()
    shapes = {k: v.shape for k, v in p.items()}

    def flat(q: dict[str, np.ndarray]) -> np.ndarray:
        return np.concatenate([q[k].reshape(-1) for k in A.PARAMETERS])

    def full(x: np.ndarray) -> dict[str, np.ndarray]:
        out, at = {}, 0
        for k in A.PARAMETERS:
            n = int(np.prod(shapes[k]))
            out[k] = x[at : at + n].reshape(shapes[k]).astype(np.float32)
            at += n
        return out

    def add(held: pa.Table) -> pa.Table:
        sums = [sum(np.frombuffer(x, np.float64) for x in held.column(c).to_pylist()).tobytes() for c in ("sums", "told")]
        return pa.table({"part": pa.array([held.column("part")[0].as_py()]), **{c: pa.array([x], pa.binary()) for c, x in zip(("sums", "told"), sums, strict=True)}, "steps": pa.array([sum(held.column("steps").to_pylist())])})

    told = np.zeros(len(SHARES))
    for turn in range(ROUNDS):
        now = flat(p)

        def run(batches: Iterator[pa.RecordBatch], now=now, turn=turn) -> Iterator[pa.RecordBatch]:
            slot, tables, inside, n, ends = _model(token, sent)
            own, state, likely = full(now), {}, np.zeros(len(SHARES))
            for row in _rows(batches):
                block = Block(row, slot)
                lexicon = Lexicon(block, inside, n, ends)
                for some in block.chunks(_learnt(block.held, row["block"], turn)):
                    slots, first, starts, codes = block.sequence(some)
                    own, logs, opens = A.train(own, tables, slots, first, turn, block.end_slot, state)
                    if turn == ROUNDS - 1:
                        attended = A.words(logs, opens, starts, first)
                        likely += [x.sum() for x in lexicon.mixed(attended, codes, SHARES.tolist(), 1)]
            if state:
                yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()]), pa.array([(flat(own).astype(np.float64) * state["step"]).tobytes()], pa.binary()), pa.array([likely.tobytes()], pa.binary()), pa.array([state["step"]])], ["part", "sums", "told", "steps"])

        kind = "part long, sums binary, told binary, steps long"
        got = texts.select(*NEEDED, "counts").mapInArrow(run, kind)
        for _ in range(3):  # each level adds ADDED rows at a time, so that ADDED^3 tasks leave one row
            got = got.withColumn("part", F.floor(F.col("part") / ADDED).cast("long")).groupBy("part").applyInArrow(add, kind)
        rows = got.collect()  # one for each ADDED^3 tasks
        steps = sum(r.steps for r in rows)
        if steps:
            p = full(sum(np.frombuffer(r.sums, np.float64) for r in rows) / steps)
            told = sum(np.frombuffer(r.told, np.float64) for r in rows)
    return p, float(SHARES[int(np.argmax(told))])


def _word_counts(blocks: DataFrame, n_blocks: int) -> DataFrame:
    """(block, at, counts, known): for words of a block their counts over all training texts, packed by bucket.

    known: how many distinct training words the bucket has, on one of its rows.
    """
    n = max(shuffle_partitions(blocks.sparkSession), n_blocks // BUCKET_BLOCKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            words, size, train = unpack(row["words"], np.uint8), unpack(row["sizes"], np.int32).astype(np.int64), unpack(row["train"], np.int32)
            if not len(size):
                continue
            end = np.cumsum(size)
            bucket = (T.xxh64(words, end - size, end) % np.uint64(n)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            edge = np.searchsorted(bucket[order], np.arange(n + 1))
            some = np.flatnonzero(np.diff(edge))
            begin = np.cumsum(size[order]) - size[order]
            moved = words[np.arange(len(words)) + np.repeat((end - size)[order] - begin, size[order])]
            cuts = np.concatenate([begin, [len(words)]])
            parts = [(edge[b], edge[b + 1]) for b in some]
            yield pa.RecordBatch.from_arrays(
                [pa.array(some), pa.array([row["block"]] * len(some)), *(pa.array(x, pa.binary()) for x in ([pack(order[a:b].astype(np.int32)) for a, b in parts], [pack(moved[cuts[a] : cuts[b]]) for a, b in parts], [pack(size[order[a:b]].astype(np.int32)) for a, b in parts], [pack(train[order[a:b]]) for a, b in parts]))],
                ["bucket", "block", "at", "words", "sizes", "train"],
            )

    def add(held: pa.Table) -> pa.Table:
        sizes = [unpack(x, np.int32) for x in held.column("sizes").to_pylist()]
        words = np.concatenate([unpack(x, np.uint8) for x in held.column("words").to_pylist()])
        ends = np.concatenate([[0], np.cumsum(np.concatenate(sizes).astype(np.int64))])
        codes = T.strings(words, ends).dictionary_encode().indices.to_numpy()
        total = np.bincount(codes, np.concatenate([unpack(x, np.int32) for x in held.column("train").to_pylist()])).astype(np.int64)
        mine = np.split(total[codes], np.cumsum([len(x) for x in sizes])[:-1])
        known = np.zeros(len(sizes), np.int64)
        known[0] = (total > 0).sum()
        return pa.table({"block": held.column("block"), "at": held.column("at"), "counts": pa.array([pack(x) for x in mine], pa.binary()), "known": pa.array(known)})

    return blocks.select("block", "words", "sizes", "train").mapInArrow(run, "bucket long, block long, at binary, words binary, sizes binary, train binary").groupBy("bucket").applyInArrow(add, "block long, at binary, counts binary, known long")


def score(docs: DataFrame, held_out: Column, path: str | None = None) -> DataFrame:
    """Scores of every whole text by a model that learns from the rows where held_out is not true.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score; words are A-Z lower-cased
    runs without white space, and an end follows each text. base_score is the add-one unigram
    log10-probability of the tokens, score the model's of the same. A null or empty text is its end
    alone. Repeated rows are scored each; ids may be null; other columns are not looked at; no rows give none.
    Without any training row every count is 0 and the model is the untrained one.
    """
    path = path or default_vocabulary()
    spark = docs.sparkSession
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.coalesce(held_out, F.lit(False)).alias("held"))
    blocks = materialize(blocks_of(chosen, path), "lm-blocks")

    def sub_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(IDS, np.int64)
        for row in _rows(batches):
            total += unpack(row["sub_counts"], np.int32)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["id", "n"])

    counts = np.zeros(IDS, np.int64)
    for r in blocks.select("sub_counts").mapInArrow(sub_counts, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():
        counts[r.id] = r.n  # one row for each id of the vocabulary at most
    slot, openers = A.slots_of(counts, opening_ids(path), END)
    inside = np.log((counts + 1) / np.bincount(slot, counts + 1.0, A.SLOTS)[slot])

    sums = blocks.agg(F.sum("train_tokens"), F.count("block")).first()
    n, ends = sums[0] or 0, int(counts[END])
    texts = materialize(_with_counts(blocks, _word_counts(blocks, sums[1])), "lm-counted")
    v = int(texts.agg(F.sum("known")).first()[0] or 0) + (ends > 0)
    sent = spark.sparkContext.broadcast((slot, openers, _bigrams(blocks, slot), inside, n, ends))
    token = uuid.uuid4().hex
    p, share = _trained(texts, token, sent)
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot, tables, inside, _, _ = _model(token, sent)
        kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        for row in _rows(batches):
            block = Block(row, slot)
            lexicon = Lexicon(block, inside, n, ends)
            c = lexicon.counts[:-1]
            size = np.diff(block.first)
            doc = np.repeat(np.arange(len(size)), size)
            base = np.bincount(doc, np.log10((c + 1) / (n + v + 1))[block.codes], len(size)) + np.log10((ends + 1) / (n + v + 1))
            known = np.bincount(doc, (c > 0)[block.codes], len(size)).astype(np.int64) + (ends > 0)
            own = np.zeros(len(size))
            for docs in block.chunks(np.arange(len(size))):
                slots, first, starts, codes = block.sequence(docs)
                attended = A.words(*A.score(p, tables, slots, first, block.end_slot), starts, first)
                own[docs] = np.bincount(np.searchsorted(first, starts, "right") - 1, lexicon.mixed(attended, codes, [share])[0], len(docs)) / np.log(10)
            columns = [row["doc_id"], block.held, size + 1, known, np.full(len(size), n), base, own]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], names)

    return texts.mapInArrow(finish, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
