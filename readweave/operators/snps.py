"""Differences: the 454 search by gap alternation, and the rules that a reported difference has to pass."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readweave.functions import sequence as S
from readweave.session import shuffle_partitions

LEAST_GAPS = 2
LEAST_COVER = 4


@dataclass
class Column:
    """A column as sets of reads, each an integer with a bit for every read."""

    consensus: str
    call: str  # the first sign that is a base, * for none
    gaps: int
    bases: int

    @classmethod
    def of(cls, consensus: str, reads: dict[str, str], bit: dict[str, int]) -> Column:
        gaps = sum(1 << bit[r] for r, sign in reads.items() if sign == "*")
        every = sum(1 << bit[r] for r in reads)
        return cls(consensus, next((sign for sign in reads.values() if sign not in "*N"), "*"), gaps, every & ~gaps)

    @property
    def covered(self) -> bool:
        return self.gaps.bit_count() >= LEAST_GAPS and (self.gaps | self.bases).bit_count() >= LEAST_COVER

    @property
    def starts(self) -> bool:
        return self.covered and self.bases.bit_count() >= LEAST_GAPS and self.call != "*"


def _candidates(columns: list[Column], start: int) -> Iterator[int]:
    """Last columns of the stretches of equal calls after start, while each is of one column and of a new base.

    start's own stretch goes on only over columns that the consensus leaves out. A longer stretch of a new base is
    the last candidate.
    """
    met = set()
    for call, stretch in groupby(range(start, len(columns)), key=lambda k: columns[k].call):
        held = list(stretch)
        if call in met:
            return
        if held[0] == start:
            if any(columns[k].consensus != "*" for k in held[1:]):
                return
        elif len(held) > 1:
            yield held[-1]
            return
        elif call != "*" and columns[held[0]].consensus != "N":
            yield held[0]
        else:
            continue
        met.add(call)


def alternations(columns: list[dict]) -> list[list[int]]:
    """Candidate differences of one contig as lists of column numbers, the starting column first.

    columns, in order: {"consensus": sign, "reads": {read: sign}} with * for a gap. An assembler that puts
    alternative bases into neighbouring columns leaves gaps in turn. A column qualifies as a start with enough
    gaps, bases and reads. Of the candidates after it one fits if it is covered, some of the start's reads that had only
    gaps have a base in it, and none that had a base has another one; the first that does not fit ends the search. Those
    with enough bases make up the difference. Its columns but the first are left out of the consensus from then on.
    """
    bit = {r: k for k, r in enumerate(dict.fromkeys(r for c in columns for r in c["reads"]))}
    held = [Column.of(c["consensus"], c["reads"], bit) for c in columns]
    found, free = [], 0
    for start, own in enumerate(held[:-1]):
        if start < free or not own.starts:
            continue
        took, without, having = [start], own.gaps, own.bases
        for k in _candidates(held, start):
            here = held[k].bases & (own.gaps | own.bases)
            if not held[k].covered or here & having or not here & without:
                break
            without, having = without & ~here, having | here
            if held[k].bases.bit_count() >= LEAST_GAPS:
                took.append(k)
        if len(took) > 1:
            found.append(took)
            free = took[-1] + 1
            for k in took:
                held[k].consensus = columns[k]["consensus"] = "*" if k > start else own.call
    return found


def gap_snps(seen: DataFrame, consensus: DataFrame) -> DataFrame:
    """(contig_id, site, columns, call): differences by gap alternation; site is the place of the first column in the
    sequence without gaps, call the sign that the consensus has there from then on. seen: observations with read_id; consensus(contig_id, pos, base)."""
    called = consensus.select("contig_id", "pos", F.col("base").alias("consensus"))
    rows = seen.select("contig_id", "pos", "base", "read_id").join(called, ["contig_id", "pos"])
    # contigs come in a row, many to a batch: a group for each would cost more than its search
    keys = ["contig_id", "pos", "read_id", "base", "consensus"]
    dealt = rows.select(keys).repartition(shuffle_partitions(seen.sparkSession), "contig_id").sortWithinPartitions(keys)

    def search(contig: object, held: list[tuple]) -> Iterator[tuple]:
        columns, places = [], []
        for pos, own in groupby(held, key=lambda r: r[1]):
            seen_here = list(own)
            places.append(pos)
            columns.append({"consensus": seen_here[0][4], "reads": {r[2]: r[3] for r in seen_here}})
        found = alternations(columns)
        at, mapping = -1, []
        for c in columns:
            at += c["consensus"] != "*"
            mapping.append(max(at, 0))
        for f in found:
            yield contig, mapping[f[0]], [int(places[k]) for k in f], columns[f[0]]["consensus"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, kind = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            kind = batch.schema.field("contig_id").type
            left += zip(*(column.to_pylist() for column in batch.columns), strict=True)
            whole = [(contig, list(own)) for contig, own in groupby(left, key=lambda r: r[0])]
            left = whole.pop()[1]  # it may go on
            yield made([row for contig, own in whole for row in search(contig, own)], kind)
        if left:
            yield made(list(search(left[0][0], left)), kind)

    def made(found: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
        kinds = [kind, pa.int32(), pa.list_(pa.int32()), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array([row[k] for row in found], t) for k, t in enumerate(kinds)], ["contig_id", "site", "columns", "call"])

    return dealt.mapInArrow(run, f"contig_id {dict(seen.dtypes)['contig_id']}, site int, columns array<int>, call string")


def rewritten(consensus: DataFrame, found: DataFrame) -> DataFrame:
    """The consensus (contig_id, pos, base, quality) with gap_snps' calls in their first columns, and gaps in their others."""
    changed = found.select("contig_id", F.posexplode("columns").alias("i", "pos"), "call").select("contig_id", "pos", F.when(F.col("i") == 0, F.col("call")).otherwise("*").alias("now"))
    joined = consensus.join(changed, ["contig_id", "pos"], "left")
    return joined.select("contig_id", "pos", F.coalesce("now", "base").alias("base"), "quality")


def pooled_units(seen: DataFrame, found: DataFrame) -> DataFrame:
    """(contig_id, site, individual, base, n, quals): what each individual's reads have in any column of a difference."""
    here = found.select("contig_id", "site", F.explode("columns").alias("pos")).join(seen, ["contig_id", "pos"]).where(F.col("base").isin("A", "C", "G", "T"))
    return here.groupBy("contig_id", "site", "individual", "base").agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list("quality")).alias("quals"))


@dataclass(frozen=True)
class Rules:
    most_reads: int = 2**31 - 1
    most_diffs: int = 1
    min_side: int = 50
    min_score: int = 20
    most_units: int = 2
    most_depth: int = 2**31 - 1
    homopolymer: int = 5
    window: int = 13
    two_names: bool = False


def accepted(blocks: DataFrame, units: DataFrame, rules: Rules) -> DataFrame:
    """blocks with good: the positions of differences that pass all rules, ascending; null-free, only blocks with any.

    blocks(cluster, n_contigs, numreads, length, seq); units(cluster, pos, individual, base, quals) in long form,
    one row for each printed name:base. A block falls with more than one contig, too many reads, no or
    too many differences. A difference is good at least min_side from either end, with at most most_units
    units, at most most_depth reads of at least min_score, exactly two bases with such reads and none with
    just one, no homopolymer in the window, and names of two individuals if asked for.
    """
    adequate = F.size(F.filter("quals", lambda q: q >= rules.min_score))
    by_base = units.withColumn("ok", adequate).groupBy("cluster", "pos", "base").agg(F.sum("ok").alias("ok"), F.count(F.lit(1)).alias("units"), F.collect_set("individual").alias("names"))
    diffs = by_base.groupBy("cluster", "pos").agg(
        F.sum("units").alias("units"), F.sum("ok").alias("depth"), F.count_if(F.col("ok") > 0).alias("alleles"), F.count_if(F.col("ok") == 1).alias("single"),
        F.size(F.array_distinct(F.flatten(F.collect_list("names")))).alias("names"),
    )
    fit = blocks.where((F.col("n_contigs") == 1) & (F.col("numreads") <= rules.most_reads))
    numbered = diffs.groupBy("cluster").agg(F.count(F.lit(1)).alias("n_diffs")).where(F.col("n_diffs") <= rules.most_diffs)
    joined = fit.join(numbered, "cluster").join(diffs, "cluster")
    passes = (
        (F.col("pos") >= rules.min_side) & (F.col("pos") <= F.col("length") - rules.min_side) & (F.col("units") <= rules.most_units)
        & (F.col("depth") <= rules.most_depth) & (F.col("alleles") == 2) & (F.col("single") == 0)
        & ~S.has_homopolymer(F.col("seq"), F.col("pos"), rules.homopolymer, rules.window)
    )
    if rules.two_names:
        passes = passes & (F.col("names") >= 2)
    chosen = joined.where(passes).groupBy("cluster").agg(F.array_sort(F.collect_list("pos")).alias("good"))
    return fit.join(chosen, "cluster")
