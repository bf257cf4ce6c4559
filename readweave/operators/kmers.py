"""k-mers: places, canonical counts, order-statistic cutoffs, scores, window means, masked intervals.

k-mers travel as numbers of two bits a base, in which order and equality are those of the words. They are made
from whole batches of reads at once in numpy; counts are added up for each batch before the shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from readweave.functions import sequence as S
from readweave.session import materialize, shuffle_partitions

#: Bases that one numpy step takes at once (or one read, if that is longer and not cut into pieces).
STEP = 1 << 17
#: k-mers of a piece of a read: batches, which hold so many rows, are of a size that neither the input nor a read's length changes.
PIECE = 512
#: k-mers of a bucket of sharing_reads, on average.
BUCKET = 1 << 20
#: k-mers of a task that are packed together; of a chunk of reads whose words are looked up together; of a part that are counted
#: together, on average.
HELD, CHUNK, PART = 1 << 21, 1 << 20, 1 << 22
#: Mixes words of any number of bits one to one, and its inverse.
MIX = 0x9E3779B97F4A7C15
UNMIX = pow(MIX, -1, 1 << 64)
#: The share of distinct k-mers at which each cutoff is read.
SHARES = {"low": 0.90, "extend": 0.99, "threshold": 0.995, "high": 0.998}
SPAN = 5
#: Distinct words over the lowest cutoff that are sent to every task (16 bytes each); with more, the most frequent ones are.
SENT = 1 << 22
#: Numbers of 64 bits in the filter that marks the words which are not sent; a power of two.
FILTER = 1 << 22

_EITHER = np.full(256, 4, np.uint8)
_UPPER = np.full(256, 4, np.uint8)
for _k, _b in enumerate(b"ACGT"):
    _EITHER[_b] = _EITHER[_b + 32] = _UPPER[_b] = _k


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = column.cast(pa.large_binary()) if pa.types.is_binary(column.type) else pc.fill_null(column, "").cast(pa.large_string())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    held = column.buffers()[2]
    return (np.frombuffer(held, np.uint8)[at[0] : at[-1]] if held is not None else np.zeros(0, np.uint8)), at - at[0]


def _sums(values: np.ndarray, k: int, forward: bool) -> np.ndarray:
    """Codes of all stretches of k values, by doubling; the first value is the highest place, or the lowest."""
    out, done, power, width = None, 0, values.astype(np.int64), 1
    rest = k
    while rest:
        if rest & 1:
            if out is None:
                out = power
            else:
                n = len(power) - done
                if n <= 0:
                    return np.zeros(0, np.int64)
                out = (out[:n] << (2 * width)) | power[done : done + n] if forward else out[:n] | (power[done : done + n] << (2 * done))
            done += width
        rest >>= 1
        if rest:
            if len(power) <= width:
                return np.zeros(0, np.int64)
            low = power[width:]
            power = (power[:-width] << (2 * width)) | low if forward else power[:-width] | (low << (2 * width))
            width *= 2
    return out


def codes(column: pa.Array, k: int, upper: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(read, place, code, code of the reverse complement) of every k-mer of a column of reads, k at most 31.

    Windows with anything but A, C, G, T are left out; upper counts lower case like upper, else it is left out too.
    """
    if not 1 <= k <= 31:
        raise ValueError("k has to be 1 to 31")
    data, at = bytes_of(column)
    base = (_EITHER if upper else _UPPER)[data]
    code, back = _sums(base & 3, k, True), _sums(3 - (base & 3), k, False)
    odd = np.concatenate([[0], np.cumsum(base == 4)])
    size = np.maximum(np.diff(at) - k + 1, 0)
    read = np.repeat(np.arange(len(size)), size)
    place = np.arange(len(read)) - np.repeat(np.cumsum(size) - size, size)
    begin = at[read] + place
    plain = odd[begin + k] == odd[begin]
    if not plain.all():
        read, place, begin = read[plain], place[plain], begin[plain]
    return read, place, code[begin], back[begin]


def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            total = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column("seq")), 0), np.int64))
            first = 0
            while first < len(total):
                done = total[first - 1] if first else 0
                last = max(first + 1, int(np.searchsorted(total, done + STEP, "right")))
                yield batch.slice(first, last - first)
                first = last


def dealt(reads: DataFrame, k: int, keep: list[str]) -> DataFrame:
    """Reads of k bases or more by id over all partitions: few input splits would hold up the work otherwise."""
    long = reads.where(F.length("seq") >= k).select(*dict.fromkeys([*keep, "seq"]))
    return long.repartition(shuffle_partitions(reads.sparkSession), "read_id") if "read_id" in keep else long.repartition(shuffle_partitions(reads.sparkSession))


def pieces(k: int) -> Column:
    """A read's bytes in pieces of PIECE k-mers, each of which is in one piece; for posexplode."""
    last = F.expr(f"cast((octet_length(seq) - {k}) div {PIECE} as int)")
    return F.transform(F.sequence(F.lit(0), last), lambda j: F.substring(F.col("seq").cast("binary"), j * PIECE + 1, F.lit(PIECE + k - 1)))


def places(reads: DataFrame, k: int, keep: list[str] | None = None, upper: bool = True, canonical: bool = False, turned: bool = False) -> DataFrame:
    """(*keep, i, code): every k-mer of every read, i from 0; canonical takes the lesser of it and its complement, turned adds
    that of the complement as back."""
    keep = keep or ["read_id"]
    spread = dealt(reads, k, keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps(batches):
            read, place, code, back = codes(part.column("seq"), k, upper)
            at = pa.array(read)
            columns = [pa.array(place), pa.array(np.minimum(code, back) if canonical else code), *([pa.array(back)] if turned else [])]
            yield pa.RecordBatch.from_arrays([*(part.column(c).take(at) for c in keep), *columns], schema.names)

    schema = StructType([spread.schema[c] for c in keep]).add("i", "long").add("code", "long")
    schema = schema.add("back", "long") if turned else schema
    return spread.mapInArrow(run, schema)


def _least_ahead(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each value and the width - 1 after it, by doubling."""
    out, done = values, 1
    while 2 * done <= width:
        out, done = np.minimum(out[:-done], out[done:]), 2 * done
    return np.minimum(out[: len(out) - (width - done)], out[width - done :]) if done < width else out


def word_stretches(column: pa.Array, k: int, buckets: int) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(read, bucket, text): the k-mers of a column of reads dealt by their least inner word, as stretches of text.

    Neighbouring k-mers mostly share that word, so a stretch holds many of them in a few bases more than one. Stretches of a
    read that go to one bucket are one text, with N between them; equal k-mers go to one bucket, whatever their reads.
    """
    inner = min(k, 11)
    read, place, _, _ = codes(column, k)
    data, at = bytes_of(column)
    if not len(read):
        return read, read, pa.array([], pa.large_string())
    h = (_sums(_EITHER[data] & 3, inner, True).astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    least = _least_ahead(h ^ (h >> np.uint64(32)), k - inner + 1)
    begin = at[read] + place
    bucket = ((least[begin] * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], (read[1:] != read[:-1]) | (place[1:] != place[:-1] + 1) | (bucket[1:] != bucket[:-1])]))
    n = np.diff(np.append(first, len(read)))
    order = np.lexsort((bucket[first], read[first]))
    first, n = first[order], n[order]
    size = n + k  # the stretch and an N
    ends = np.cumsum(size)
    text = data[np.minimum(np.repeat(begin[first] - (ends - size), size) + np.arange(ends[-1]), len(data) - 1)]
    text[ends - 1] = ord("N")
    own = np.flatnonzero(np.concatenate([[True], (read[first][1:] != read[first][:-1]) | (bucket[first][1:] != bucket[first][:-1])]))
    offsets = np.append((ends - size)[own], ends[-1])
    return read[first[own]], bucket[first[own]], pa.Array.from_buffers(pa.large_string(), len(own), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(text)])


def sharing_reads(reads: DataFrame, k: int, least: int, most: int) -> DataFrame:
    """(src, dst), src > dst: reads(read_id, seq) that share a k-mer which least to most reads have; case does not count.

    Stretches of reads are shuffled, not k-mers; those of a bucket, a million or so, are counted in arrays.
    """
    reads = reads.select("read_id", "seq")
    bases = reads.agg(F.sum(F.length("seq"))).first()[0] or 0
    buckets = max(shuffle_partitions(reads.sparkSession), -(-bases // BUCKET))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps(batches):
            read, bucket, text = word_stretches(part.column("seq"), k, buckets)
            yield pa.RecordBatch.from_arrays([pa.array(bucket), part.column("read_id").take(pa.array(read)), text.cast(pa.string())], ["bucket", "read_id", "seq"])

    def pair(table: pa.Table) -> pa.Table:
        names = pc.unique(table.column("read_id")).sort()  # nulls last, as reads that count but have no name
        rank = pc.index_in(table.column("read_id"), value_set=names).to_numpy()
        named = len(names) - names.null_count
        row, _, code, _ = codes(table.column("seq").combine_chunks(), k)
        owner = rank[row].astype(np.int32)
        order = np.lexsort((owner, code))
        code, owner = code[order], owner[order]
        once = np.concatenate([[True], (code[1:] != code[:-1]) | (owner[1:] != owner[:-1])]) if len(code) else np.zeros(0, dtype=bool)
        code, owner = code[once], owner[once]
        heads = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]])) if len(code) else np.zeros(0, np.int64)
        n = np.diff(np.append(heads, len(code)))
        some = (n >= least) & (n <= most)
        heads, n = heads[some], n[some]
        found = [np.zeros(0, np.int64)]
        for i in range(1, most):
            own = heads[n > i]
            for j in range(i):
                high, low = owner[own + i].astype(np.int64), owner[own + j].astype(np.int64)
                found.append(np.unique((high * len(names) + low)[high < named]))
        both = np.unique(np.concatenate(found))
        return pa.table([names.take(pa.array(both // len(names))), names.take(pa.array(both % len(names)))], ["src", "dst"])

    kind = reads.schema["read_id"].dataType.simpleString()
    cuts = reads.where(F.length("seq") >= k).mapInArrow(cut, f"bucket long, read_id {kind}, seq string")
    return cuts.groupBy("bucket").applyInArrow(pair, f"src {kind}, dst {kind}").distinct()


def mixed(code: np.ndarray, k: int) -> np.ndarray:
    """Words as other numbers of as many bits (uint64), one to one, whose upper bits are spread evenly."""
    return code.view(np.uint64) * np.uint64(MIX) & np.uint64((1 << 2 * k) - 1)


def _unmixed(words: np.ndarray, k: int) -> np.ndarray:
    return (words * np.uint64(UNMIX) & np.uint64((1 << 2 * k) - 1)).view(np.int64)


def _packed(values: np.ndarray) -> bytes:
    """Numbers (uint64) in as few bytes each as the greatest takes, equal places together."""
    width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    return bytes([width]) + np.ascontiguousarray(values, "<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def _unpacked(held: bytes) -> np.ndarray:
    raw = np.frombuffer(held, np.uint8, offset=1).reshape(held[0], -1)
    out = np.zeros((raw.shape[1], 8), np.uint8)
    out[:, : held[0]] = raw.T
    return out.view("<u8").reshape(-1)


def _part_bits(reads: DataFrame, k: int) -> int:
    """Into how many parts words are dealt, as a power of two: a part is of some millions of k-mers whatever the input."""
    bases = reads.agg(F.sum(F.length("seq"))).first()[0] or 0
    return min(2 * k, max(8 * shuffle_partitions(reads.sparkSession), -(-bases // PART)).bit_length())


def _by_part(words: np.ndarray, n: np.ndarray, shift: int) -> tuple[list[int], list[bytes], list[bytes]]:
    """(part, words, n): ascending mixed words packed by part as what each is over the one before, and their numbers."""
    part = words >> np.uint64(shift)
    edge = np.flatnonzero(np.concatenate([np.ones(min(1, len(part)), bool), part[1:] != part[:-1]]))
    apart = np.diff(words, prepend=np.uint64(0))
    apart[edge] = words[edge] - (part[edge] << np.uint64(shift))
    ends = [*edge.tolist(), len(words)]
    return part[edge].tolist(), [_packed(apart[a:b]) for a, b in zip(ends, ends[1:])], [_packed(n[a:b]) for a, b in zip(ends, ends[1:])]  # noqa: B905


def _merged(part: int, table: pa.Table, shift: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
    """(words, cnt, rank, sizes): a part's distinct words and their counts over all rows, which of them each row's are, and how many a row has."""
    rows = [np.cumsum(_unpacked(x), dtype=np.uint64) for x in table.column("words").to_pylist()]
    words = np.concatenate(rows) + np.uint64(part << shift)
    n = np.concatenate([_unpacked(x) for x in table.column("n").to_pylist()])
    order = np.argsort(words)
    words = words[order]
    new = np.concatenate([[True], words[1:] != words[:-1]])
    rank = np.empty(len(words), np.int64)
    rank[order] = np.cumsum(new) - 1
    heads = np.flatnonzero(new)
    return words[heads], np.add.reduceat(n[order], heads).astype(np.int64), rank, [len(x) for x in rows]


def _letters(code: np.ndarray, k: int) -> pa.Array:
    """Words in letters."""
    out = np.empty((len(code), k), np.uint8)
    for j in range(k):
        out[:, j] = np.frombuffer(b"ACGT", np.uint8)[(code >> (2 * (k - 1 - j))) & 3]
    return pa.Array.from_buffers(pa.large_string(), len(code), [None, pa.py_buffer(np.arange(len(code) + 1, dtype=np.int64) * k), pa.py_buffer(out)]).cast(pa.string())


def in_letters(words: DataFrame, k: int) -> DataFrame:
    """words(code, ...) with kmer in place of code."""
    kinds = dict(words.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([_letters(batch.column("code").to_numpy(), k), *(batch.column(c) for c in kinds if c != "code")], ["kmer", *(c for c in kinds if c != "code")])

    return words.mapInArrow(run, ", ".join(["kmer string", *(f"{c} {t}" for c, t in kinds.items() if c != "code")]))


def _words_by_part(reads: DataFrame, k: int, shift: int, canonical: bool) -> DataFrame:
    """(part, words, n): k-mers of a task, mixed, packed by part and counted; canonical ones in either case, or those of upper case as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def rows() -> pa.RecordBatch:
            words, n = np.unique(np.concatenate(held), return_counts=True)
            part, words, n = _by_part(words, n.astype(np.uint64), shift)
            return pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array(words, pa.binary()), pa.array(n, pa.binary())], ["part", "words", "n"])

        for step in steps(batches):
            _, _, code, back = codes(step.column("seq"), k, canonical)
            held += [mixed(np.minimum(code, back), k), mixed(code[code == back], k)] if canonical else [mixed(code, k)]
            size += len(code)
            if size >= HELD:
                yield rows()
                held, size = [], 0
        if size:
            yield rows()

    cut = reads.where(F.length("seq") >= k).select("read_id", F.posexplode(pieces(k)).alias("piece", "seq"))
    spread = cut.repartition(shuffle_partitions(reads.sparkSession), "read_id", "piece").select("seq")
    return spread.mapInArrow(run, "part long, words binary, n binary")


def _counted(reads: DataFrame, k: int, letters: bool) -> DataFrame:
    """code_counts, or canonical_counts with letters: words are packed by task and part before they are shuffled."""
    shift = 2 * k - _part_bits(reads, k)

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        words, cnt, _, _ = _merged(key[0].as_py(), table, shift)
        code = _unmixed(words, k)
        return pa.table([_letters(code, k) if letters else pa.array(code), pa.array(cnt)], ["kmer" if letters else "code", "cnt"])

    return _words_by_part(reads, k, shift, True).groupBy("part").applyInArrow(merge, "kmer string, cnt long" if letters else "code long, cnt long")


def rare_bits(reads: DataFrame, k: int, most: Callable[[DataFrame], int]) -> np.ndarray:
    """A bit for each word of k bases, in the order of mixed: those that reads have, in upper case, and at most so often as most says of
    a histogram(n, m) of the words' counts."""
    shift = 2 * k - min(_part_bits(reads, k), max(0, 2 * k - 3))

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        part = key[0].as_py()
        words, n, _, _ = _merged(part, table, shift)
        return pa.table([pa.array([part]), pa.array([_packed(np.diff(words - np.uint64(part << shift), prepend=np.uint64(0)))], pa.binary()), pa.array([_packed(n.astype(np.uint64))], pa.binary())], ["part", "words", "n"])

    def histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for held in batch.column("n").to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in np.unique(_unpacked(held), return_counts=True)], ["n", "m"])

    parts = materialize(_words_by_part(reads, k, shift, False).groupBy("part").applyInArrow(merge, "part long, words binary, n binary"), "word-counts")
    limit = most(parts.mapInArrow(histogram, "n long, m long").groupBy("n").agg(F.sum("m").alias("m")))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, words, n in zip(*(batch.column(c).to_pylist() for c in ("part", "words", "n")), strict=True):
                bits = np.zeros(1 << shift, dtype=bool)
                bits[np.cumsum(_unpacked(words), dtype=np.uint64)[_unpacked(n) <= limit].astype(np.int64)] = True
                yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())], ["part", "bits"])

    size = -(-(1 << shift) // 8)
    out = np.zeros(size << (2 * k - shift), np.uint8)
    marked = parts.mapInArrow(mark, "part long, bits binary").toArrow()  # a bit for each word there may be
    for part, bits in zip(marked.column("part").to_pylist(), marked.column("bits").to_pylist(), strict=True):
        out[part * size : (part + 1) * size] = np.frombuffer(bits, np.uint8)
    return out


def code_counts(reads: DataFrame, k: int) -> DataFrame:
    """(code, cnt): canonical k-mers over all reads; one that is its own reverse complement counts twice."""
    return _counted(reads, k, False)


def canonical_counts(reads: DataFrame, k: int) -> DataFrame:
    """(kmer, cnt) as code_counts, in letters."""
    return _counted(reads, k, True)


def cutoffs(counts: DataFrame) -> DataFrame:
    """One row: n_kmers and the counts at the given shares of distinct k-mers, as exact order statistics."""
    return _shares(counts.groupBy("cnt").agg(F.count(F.lit(1)).alias("n")))


def _shares(histogram: DataFrame) -> DataFrame:
    """cutoffs of a histogram(cnt, n)."""
    # as many rows as there are different counts; the window sees only those
    running = histogram.withColumn("upto", F.sum("n").over(Window.orderBy("cnt")))
    total = histogram.agg(F.sum("n").alias("u"))
    picks = [F.min(F.when(F.col("upto") > F.floor(F.lit(p) * F.col("u")), F.col("cnt"))).alias(name) for name, p in SHARES.items()]
    return running.crossJoin(F.broadcast(total)).agg(F.coalesce(F.max("u"), F.lit(0)).cast("long").alias("n_kmers"), *picks)


def score(cnt: Column, low: int, high: int) -> Column:
    return F.when(cnt > high, high).when(cnt <= low, F.floor(F.lit(low) / 2)).otherwise(cnt).cast("int")


def scored(counts: DataFrame, cuts: dict) -> DataFrame:
    return counts.withColumn("score", score(F.col("cnt"), cuts["low"], cuts["high"]))


def _summed(read: np.ndarray, word: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The rows in order of read and word, those of the same read and word added up."""
    order = np.lexsort((word, read))
    read, word, n = read[order], word[order], n[order]
    if not len(read):
        return read, word, n
    heads = np.flatnonzero(np.concatenate([[True], (read[1:] != read[:-1]) | (word[1:] != word[:-1])]))
    return read[heads], word[heads], np.add.reduceat(n, heads)


def _most(column: pa.Array, k: int) -> np.ndarray:
    """How often the commonest canonical k-mer of each read occurs in it, 0 without any."""
    read, _, code, back = codes(column, k)
    read, _, n = _summed(read, np.minimum(code, back), 1 + (code == back))
    most = np.zeros(len(column), np.int64)
    np.maximum.at(most, read, n)
    return most


def repeats_within(reads: DataFrame, k: int) -> DataFrame:
    """(read_id, most): how often a read's commonest canonical k-mer occurs in it. Needs no shuffle of k-mers.

    A read comes in pieces, one after the other; what is held of it between steps is its distinct words and their counts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # read 0 is the one that the steps before have begun
        name, word, n = pa.array([None], pa.string()), np.zeros(0, np.int64), np.zeros(0, np.int64)

        def rows(names: pa.Array, read: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            most = np.zeros(len(names), np.int64)
            np.maximum.at(most, read, n)
            some = np.flatnonzero(most)
            return pa.RecordBatch.from_arrays([names.take(pa.array(some)), pa.array(most[some])], ["read_id", "most"])

        for part in steps(batches):
            first = part.column("piece").to_numpy() == 0
            own = np.cumsum(first)
            row, _, code, back = codes(part.column("seq"), k)
            names = pa.concat_arrays([name, part.column("read_id").filter(pa.array(first))])
            read, word, n = _summed(np.concatenate([np.zeros(len(word), np.int64), own[row]]), np.concatenate([word, np.minimum(code, back)]), np.concatenate([n, 1 + (code == back)]))
            last = own[-1]
            begun = read == last
            if last:
                yield rows(names.slice(0, last), read[~begun], n[~begun])
            name, word, n = names.slice(last), word[begun], n[begun]
        yield rows(name, np.zeros(len(n), np.int64), n)

    cut = dealt(reads, k, ["read_id"]).select(F.col("read_id").cast("string"), F.posexplode(pieces(k)).alias("piece", "seq"))
    return cut.mapInArrow(run, "read_id string, most long")


def window_means(reads: DataFrame, scores: DataFrame, k: int, span: int = SPAN) -> DataFrame:
    """(read_id, j, mean): integer means of span k-mer scores; the last full window of a read is not made.

    scores(code, score) of canonical k-mers.
    """
    each = places(reads, k, canonical=True).join(scores.select("code", "score"), "code")
    w = Window.partitionBy("read_id").orderBy("i")
    ahead = each.select("read_id", F.col("i").alias("j"), F.sum("score").over(w.rowsBetween(0, span - 1)).alias("sum"), F.count("score").over(w.rowsBetween(0, span)).alias("n"))
    return ahead.where(F.col("n") > span).select("read_id", "j", F.expr(f"sum div {span}").alias("mean"))


def mask_intervals(means: DataFrame, k: int, extend: int, threshold: int, span: int = SPAN) -> DataFrame:
    """(read_id, start, end): bases to mask. A window over threshold masks itself; if all means since the last
    such window are over extend, the bases from there on too."""
    w = Window.partitionBy("read_id").orderBy("j")
    hit = F.col("mean") > threshold
    marked = means.withColumn("hit", hit).withColumn("island", F.coalesce(F.sum(F.col("hit").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    # an island is a hit and the windows before it since the last one
    islands = marked.groupBy("read_id", "island").agg(
        F.min("j").alias("first"), F.max(F.when(F.col("hit"), F.col("j"))).alias("at"), F.min(F.when(~F.col("hit"), F.col("mean"))).alias("between")
    )
    start = F.when(F.col("between").isNull() | (F.col("between") > extend), F.col("first")).otherwise(F.col("at"))
    return islands.where("at is not null").select("read_id", start.cast("long").alias("start"), (F.col("at") + (k + span - 1)).cast("long").alias("end"))


def _marks(code: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """For each word the one of size numbers of the filter that it belongs to, and three bits of it."""
    one = np.uint64(1)
    h = code.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    g = (h ^ (h >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    bits = [one << ((g >> np.uint64(shift)) & np.uint64(63)) for shift in (58, 52, 46)]
    return ((h >> np.uint64(32)) & np.uint64(size - 1)).astype(np.int64), bits[0] | bits[1] | bits[2]


class Scores:
    """Scores of words as sorted arrays: only words over the lowest cutoff are held, others score alike.

    Words over the cutoff that are not held are marked in filters, which mark some others too: marks has a filter and
    the most that its words score, in rising order, so that a window's mean has an upper bound before its words are looked up.
    """

    def __init__(self, keys: np.ndarray, cnt: np.ndarray, cuts: dict, marks: list[tuple[np.ndarray, int]] | None = None):
        order = np.argsort(keys)
        self.keys, self.values = keys[order], np.minimum(cnt, cuts["high"])[order]
        self.rest, self.cuts = cuts["low"] // 2, cuts
        self.marks = marks or []

    def words(self, column: pa.Array, k: int) -> tuple[np.ndarray, ...]:
        """(read, place, word, score, most): words of most over score may be over the cutoff and are not held; they score most at most."""
        read, place, code, back = codes(column, k)
        least = np.minimum(code, back)
        score, held = np.full(len(code), self.rest, np.int64), np.zeros(len(code), dtype=bool)
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, least), len(self.keys) - 1)
            held = self.keys[at] == least
            score[held] = self.values[at[held]]
        most, loose = score.copy(), np.flatnonzero(~held)
        for marks, bound in self.marks:
            number, bits = _marks(least[loose], len(marks))
            most[loose[marks[number] & bits == bits]] = bound
        return read, place, least, score, np.maximum(most, score)

    def asked(self, column: pa.Array, k: int, span: int = SPAN, every: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(read, place, word) of the open words that decide what is masked, or every open word.

        Those are words of windows that may be over the threshold or not, and of windows before such a one that may be over the extension
        cutoff or not, unless a window among these is not over it, whatever its words score.
        """
        read, place, least, score, most = self.words(column, k)
        some = most > score
        if not every:
            at, low = _means(read, score, span)
            _, high = _means(read, most, span)
            may = high > self.cuts["threshold"]
            first = np.flatnonzero(np.concatenate([[True], (read[at][1:] != read[at][:-1]) | may[:-1]])) if len(at) else np.zeros(0, np.int64)
            stretch = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(at))))
            settled = np.ones(len(first), dtype=bool)
            if len(first):
                # a stretch that no window over the threshold ends is not masked; one with a low window is not masked up to its end
                settled = ~may[np.append(first[1:], len(at)) - 1] | np.logical_or.reduceat(high <= self.cuts["extend"], first)
            unclear = np.where(may, low <= self.cuts["threshold"], (low <= self.cuts["extend"]) & (high > self.cuts["extend"]) & ~settled[stretch])
            edge = np.zeros(len(read) + 1, np.int64)
            np.add.at(edge, at[unclear], 1)
            np.add.at(edge, at[unclear] + span + 1, -1)  # with the word that follows the window
            some &= np.cumsum(edge)[:-1] > 0
        return read[some], place[some], least[some]

    def means(self, column: pa.Array, k: int, span: int = SPAN, told: pa.Array | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(read, j, mean) as window_means gives them, for a column of reads; told: (i, score) of open words of each read."""
        read, place, _, score, _ = self.words(column, k)
        if told is not None:
            told = pc.fill_null(told, pa.scalar([], told.type))
            flat = told.flatten()
            of = np.repeat(np.arange(len(told)), np.asarray(pc.list_value_length(told), np.int64))
            wide = int(place.max(initial=0)) + 1
            score[np.searchsorted(read * wide + place, of * wide + np.asarray(flat.field("i")))] = np.asarray(flat.field("score"))
        at, mean = _means(read, score, span)
        return read[at], place[at], mean

    def spans(self, column: pa.Array, k: int, span: int = SPAN, told: pa.Array | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(read, start, end) as mask_intervals gives them."""
        return _spans(*self.means(column, k, span, told), self.cuts, k, span)


def _spans(read: np.ndarray, j: np.ndarray, mean: np.ndarray, cuts: dict, k: int, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(read, start, end) as mask_intervals gives them, of means (read, j, mean) in order."""
    if not len(read):
        return read, j, j
    hit = mean > cuts["threshold"]
    first = np.flatnonzero(np.concatenate([[True], (read[1:] != read[:-1]) | hit[:-1]]))
    last = np.append(first[1:], len(read)) - 1
    none = np.iinfo(np.int64).max
    between = np.minimum.reduceat(np.where(hit, none, mean), first)
    first, last, between = (x[hit[last]] for x in (first, last, between))
    return read[last], np.where(between > cuts["extend"], j[first], j[last]), j[last] + (k + span - 1)


def _means(read: np.ndarray, score: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """The windows that a further word of their read follows, by their first word, and their integer means."""
    total = np.concatenate([[0], np.cumsum(score)])
    at = np.flatnonzero(read[:-span] == read[span:])
    return at, (total[at + span] - total[at]) // span


def _sent(counts: DataFrame, cuts: dict):
    """The scores as a broadcast, or None if they are too many."""
    over = counts.where(F.col("cnt") > cuts["low"])
    if over.limit(SENT + 1).count() > SENT:
        return None
    held = over.select("code", "cnt").toArrow()  # SENT rows at most
    return counts.sparkSession.sparkContext.broadcast(Scores(held.column("code").to_numpy(), held.column("cnt").to_numpy(), cuts))


def _sent_in_part(counts: DataFrame, cuts: dict):
    """(broadcast, rest): the scores of the most frequent words and a filter of the others over the cutoff, rest(code, score)."""
    over = counts.where(F.col("cnt") > cuts["low"])
    histogram = over.groupBy("cnt").agg(F.count(F.lit(1)).alias("n"))
    # as many rows as there are different counts; the window sees only those
    running = histogram.withColumn("upto", F.sum("n").over(Window.orderBy(F.desc("cnt"))))
    least = running.where(F.col("upto") <= SENT).agg(F.min("cnt")).first()[0]
    most = running.agg(F.max("cnt")).first()[0] if least is None else least - 1
    rest = over.where(F.col("cnt") <= most)
    held = over.where(F.col("cnt") > most).select("code", "cnt").toArrow()  # SENT rows at most

    size = FILTER

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number, bits = _marks(batch.column("code").to_numpy(), size)
            yield pa.RecordBatch.from_arrays([pa.array(number), pa.array(bits.view(np.int64))], ["number", "bits"])

    # words up to the extension cutoff, to the threshold and over it have filters of their own: few are in the last two
    marks, low = [], cuts["low"]
    for high in sorted({*(c for c in (cuts["extend"], cuts["threshold"]) if low < c < most), most}):
        own = rest.where(F.col("cnt").between(low + 1, high)).select("code").mapInArrow(mark, "number long, bits long")
        marked = own.groupBy("number").agg(F.bit_or("bits").alias("bits")).toArrow()  # FILTER rows at most
        filter_ = np.zeros(size, np.uint64)
        filter_[marked.column("number").to_numpy()] = marked.column("bits").to_numpy().view(np.uint64)
        marks.append((filter_, min(high, cuts["high"])))
        low = high
    sent = Scores(held.column("code").to_numpy(), held.column("cnt").to_numpy(), cuts, marks)
    return counts.sparkSession.sparkContext.broadcast(sent), rest.select("code", F.least("cnt", F.lit(cuts["high"])).cast("long").alias("score"))


def _with_scores(reads: DataFrame, counts: DataFrame, cuts: dict, k: int, keep: list[str], every: bool = False) -> tuple:
    """(broadcast, reads): what is sent, and reads of k bases or more, dealt, with what they were told if not all could be sent.

    Where the words over the lowest cutoff are too many to send, the most frequent ones are sent, with filters of the
    others. Only words that a filter marks and that decide something (or every one of them) are joined to their
    scores; none of them is frequent, and what they score comes back to the reads, which stay where they are.
    """
    sent, spread = _sent(counts, cuts), dealt(reads, k, ["read_id", *keep])
    if sent is not None:
        return sent, spread
    sent, rest = _sent_in_part(counts, cuts)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps(batches):
            read, place, word = sent.value.asked(part.column("seq"), k, every=every)
            yield pa.RecordBatch.from_arrays([part.column("read_id").take(pa.array(read)), pa.array(place), pa.array(word)], ["read_id", "i", "code"])

    asked = dealt(reads, k, ["read_id"]).mapInArrow(ask, "read_id string, i long, code long")
    told = asked.join(rest, "code").groupBy("read_id").agg(F.collect_list(F.struct("i", "score")).alias("told"))
    return sent, spread.join(told, "read_id", "left")


def _told(part: pa.RecordBatch) -> pa.Array | None:
    return part.column("told") if "told" in part.schema.names else None


def means(reads: DataFrame, counts: DataFrame, cuts: dict, k: int) -> DataFrame:
    """window_means of counted words, from whole reads; see _with_scores."""
    sent, spread = _with_scores(reads, counts, cuts, k, [], every=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps(batches):
            read, j, mean = sent.value.means(part.column("seq"), k, told=_told(part))
            yield pa.RecordBatch.from_arrays([part.column("read_id").take(pa.array(read)), pa.array(j), pa.array(mean)], ["read_id", "j", "mean"])

    return spread.mapInArrow(run, "read_id string, j long, mean long")


def intervals(reads: DataFrame, counts: DataFrame, cuts: dict, k: int) -> DataFrame:
    """mask_intervals of counted words, from whole reads; see _with_scores."""
    sent, spread = _with_scores(reads, counts, cuts, k, [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps(batches):
            read, start, end = sent.value.spans(part.column("seq"), k, told=_told(part))
            yield pa.RecordBatch.from_arrays([part.column("read_id").take(pa.array(read)), pa.array(start), pa.array(end)], ["read_id", "start", "end"])

    return spread.mapInArrow(run, "read_id string, start long, end long")


def lowered(column: pa.Array, read: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """Upper-case reads with the letters of spans in lower case, all in one pass whatever the number of spans."""
    data, at = bytes_of(column)
    data = np.where((data >= 97) & (data <= 122), data - np.uint8(32), data)
    edge = np.zeros(len(data) + 1, np.int64)
    np.add.at(edge, np.minimum(at[read] + start, at[read + 1]), 1)
    np.add.at(edge, np.minimum(at[read] + end, at[read + 1]), -1)
    low = (np.cumsum(edge)[:-1] > 0) & (data >= 65) & (data <= 90)
    text = np.where(low, data + np.uint8(32), data)
    return pa.Array.from_buffers(pa.large_string(), len(column), [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(text)]).cast(pa.string())


def masked(reads: DataFrame, counts: DataFrame, cuts: dict, k: int) -> DataFrame:
    """reads with masked bases in lower case.

    Reads shorter than k, and those in which a k-mer occurs at least cuts['extend'] times, are masked whole.
    """
    names = reads.columns
    others = [c for c in names if c not in ("read_id", "seq")]
    sent, spread = _with_scores(reads, counts, cuts, k, others)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps(batches):
            column = part.column("seq")
            read, start, end = sent.value.spans(column, k, told=_told(part))
            whole = np.flatnonzero(_most(column, k) >= sent.value.cuts["extend"])
            length = np.asarray(pc.binary_length(column), np.int64)
            seq = lowered(column, np.append(read, whole), np.append(start, np.zeros(len(whole), np.int64)), np.append(end, length[whole]))
            yield pa.RecordBatch.from_arrays([seq if c == "seq" else part.column(c) for c in names], names)

    short = reads.where(F.coalesce(F.length("seq") < k, F.lit(True))).withColumn("seq", F.lower("seq"))
    return spread.mapInArrow(run, reads.schema).unionByName(short)


def in_place(reads: DataFrame, k: int) -> tuple[DataFrame, DataFrame, dict]:
    """(reads, told, cuts): reads of k bases or more in chunks, the counts of each chunk's words over all reads, and their cutoffs.

    A chunk's distinct words go to their parts, where they are counted, and the counts come back to the chunk in the words'
    order, packed both ways: neither words nor counts are rows, and none is sent to all tasks, however many there are.
    """
    bits = _part_bits(reads, k)
    shift = 2 * k - bits
    chunks = max(4 * shuffle_partitions(reads.sparkSession), (PART << bits) // CHUNK)
    # by text too: reads without a name would be one chunk
    spread = reads.where(F.length("seq") >= k).withColumn("chunk", F.pmod(F.xxhash64("read_id", "seq"), F.lit(chunks)))

    def ask(key: tuple, table: pa.Table) -> pa.Table:
        _, _, code, back = codes(table.column("seq").combine_chunks(), k)
        words, n = np.unique(np.concatenate([mixed(np.minimum(code, back), k), mixed(code[code == back], k)]), return_counts=True)
        part, words, n = _by_part(words, n.astype(np.uint64), shift)
        return pa.table([pa.array(part, pa.int64()), pa.array([key[0].as_py()] * len(part), pa.int64()), pa.array(words, pa.binary()), pa.array(n, pa.binary())], ["part", "chunk", "words", "n"])

    def tell(key: tuple, table: pa.Table) -> pa.Table:
        _, cnt, rank, sizes = _merged(key[0].as_py(), table, shift)
        ends = np.cumsum([0, *sizes]).tolist()
        held = [_packed(cnt[rank[a:b]].astype(np.uint64)) for a, b in zip(ends, ends[1:])]  # noqa: B905
        each, n = np.unique(cnt, return_counts=True)
        rows, more = pa.nulls(len(held), pa.int64()), pa.nulls(len(each), pa.int64())
        return pa.table({
            "chunk": pa.concat_arrays([table.column("chunk").combine_chunks(), more]), "part": pa.concat_arrays([table.column("part").combine_chunks(), more]),
            "told": pa.array([*held, *[None] * len(each)], pa.binary()), "cnt": pa.concat_arrays([rows, pa.array(each)]), "n": pa.concat_arrays([rows, pa.array(n)]),
        })

    asked = spread.select("chunk", "seq").groupBy("chunk").applyInArrow(ask, "part long, chunk long, words binary, n binary")
    told = materialize(asked.groupBy("part").applyInArrow(tell, "chunk long, part long, told binary, cnt long, n long"), "told")
    histogram = told.where("cnt is not null").groupBy("cnt").agg(F.sum("n").alias("n"))
    return spread, told.where("told is not null").select("chunk", "part", "told"), _shares(histogram).first().asDict()


def _chunks(spread: DataFrame, told: DataFrame, k: int, keep: list[str], work: Callable, schema: str | StructType) -> DataFrame:
    """What work(reads, read, place, word, cnt, twice) makes of each chunk: which of its distinct words its k-mers are, the words'
    counts, and whether they are their own reverse complements."""

    def run(held: pa.Table, answers: pa.Table) -> pa.Table:
        read, place, code, back = codes(held.column("seq").combine_chunks(), k)
        words, first, word = np.unique(mixed(np.minimum(code, back), k), return_index=True, return_inverse=True)
        rows = sorted(zip(answers.column("part").to_pylist(), answers.column("told").to_pylist(), strict=True))
        cnt = np.concatenate([np.zeros(0, np.uint64), *(_unpacked(x) for _, x in rows)]).astype(np.int64)
        return work(held, read, place, word, cnt, (code == back)[first])

    reads = spread.select("chunk", *dict.fromkeys(["seq", *keep]))
    return reads.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(run, schema)


def _score_of(cnt: np.ndarray, cuts: dict) -> np.ndarray:
    """score of counts."""
    return np.where(cnt > cuts["high"], cuts["high"], np.where(cnt <= cuts["low"], cuts["low"] // 2, cnt)) if len(cnt) else cnt


def means_in_place(spread: DataFrame, told: DataFrame, cuts: dict, k: int, span: int = SPAN) -> DataFrame:
    """window_means of what in_place gives."""

    def work(held: pa.Table, read: np.ndarray, place: np.ndarray, word: np.ndarray, cnt: np.ndarray, _: np.ndarray) -> pa.Table:
        at, mean = _means(read, _score_of(cnt, cuts)[word], span)
        return pa.table([held.column("read_id").combine_chunks().take(pa.array(read[at])), pa.array(place[at]), pa.array(mean)], ["read_id", "j", "mean"])

    return _chunks(spread, told, k, ["read_id"], work, "read_id string, j long, mean long")


def _spans_of(read: np.ndarray, place: np.ndarray, word: np.ndarray, cnt: np.ndarray, cuts: dict, k: int, span: int) -> tuple[np.ndarray, ...]:
    at, mean = _means(read, _score_of(cnt, cuts)[word], span)
    return _spans(read[at], place[at], mean, cuts, k, span)


def intervals_in_place(spread: DataFrame, told: DataFrame, cuts: dict, k: int, span: int = SPAN) -> DataFrame:
    """mask_intervals of what in_place gives."""

    def work(held: pa.Table, read: np.ndarray, place: np.ndarray, word: np.ndarray, cnt: np.ndarray, _: np.ndarray) -> pa.Table:
        read, start, end = _spans_of(read, place, word, cnt, cuts, k, span)
        return pa.table([held.column("read_id").combine_chunks().take(pa.array(read)), pa.array(start), pa.array(end)], ["read_id", "start", "end"])

    return _chunks(spread, told, k, ["read_id"], work, "read_id string, start long, end long")


def masked_in_place(reads: DataFrame, spread: DataFrame, told: DataFrame, cuts: dict, k: int, span: int = SPAN) -> DataFrame:
    """masked of reads and what in_place gives for them."""
    names = reads.columns

    def work(held: pa.Table, read: np.ndarray, place: np.ndarray, word: np.ndarray, cnt: np.ndarray, twice: np.ndarray) -> pa.Table:
        column = held.column("seq").combine_chunks()
        own, start, end = _spans_of(read, place, word, cnt, cuts, k, span)
        # no word is more frequent in a read than in all
        often = cnt[word] >= cuts["extend"] if len(word) else np.zeros(0, dtype=bool)
        each, n = np.unique(read[often] * len(cnt) + word[often], return_counts=True)
        whole = np.unique(each[n * (1 + twice[each % max(1, len(cnt))]) >= cuts["extend"]] // max(1, len(cnt)))
        length = np.asarray(pc.binary_length(column), np.int64)
        seq = lowered(column, np.append(own, whole), np.append(start, np.zeros(len(whole), np.int64)), np.append(end, length[whole]))
        return pa.table([seq if c == "seq" else held.column(c) for c in names], names)

    short = reads.where(F.coalesce(F.length("seq") < k, F.lit(True))).withColumn("seq", F.lower("seq"))
    return _chunks(spread, told, k, names, work, reads.schema).unionByName(short)
