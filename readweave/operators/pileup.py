"""Pileups: placed reads to allele observations, column counts, differences, profiles by individual, consensus."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from readweave.functions import sequence as S

CLASSES = ["A", "C", "G", "T"]


def star_placement(blocks: DataFrame, chosen: DataFrame, seeds: DataFrame) -> DataFrame:
    """Placement of members on their cluster's seed: (contig_id, read_id, complement, offset).

    chosen(cluster): clusters to lay out; blocks as the overlap join gives them; seeds(cluster) are placed at 0.
    The best block of a pair counts.
    """
    one = blocks.select(F.col("name2").alias("contig_id"), F.col("name1").alias("read_id"), (F.col("strand2") == "-").alias("complement"), F.when(F.col("strand2") == "-", F.col("len2") - F.col("s2") - F.col("o2")).otherwise(F.col("s2")).alias("at"), "s1", "o1", "len1", "score")
    # on the minus strand the seed was turned; turn the pair so that the seed is as it is
    one = one.select("contig_id", "read_id", "complement", (F.col("at") - F.when(F.col("complement"), F.col("len1") - F.col("s1") - F.col("o1")).otherwise(F.col("s1"))).alias("offset"), "score")
    two = blocks.select(F.col("name1").alias("contig_id"), F.col("name2").alias("read_id"), (F.col("strand2") == "-").alias("complement"), (F.col("s1") - F.col("s2")).alias("offset"), "score")
    best = one.unionByName(two).groupBy("contig_id", "read_id").agg(F.max_by(F.struct("complement", "offset"), F.struct("score", "offset")).alias("b"))
    names = chosen.select(F.col("cluster").alias("contig_id"))
    own = seeds.join(chosen, "cluster", "left_semi").select(F.col("cluster").alias("contig_id"), F.col("cluster").alias("read_id"), F.lit(False).alias("complement"), F.lit(0).alias("offset"))
    return own.unionByName(best.join(names, "contig_id", "left_semi").select("contig_id", "read_id", "b.complement", "b.offset"))


def observations(placement: DataFrame, reads: DataFrame) -> DataFrame:
    """(contig_id, pos, base, quality, read_id, individual) of placed reads; positions before 0 are skipped.

    placement(contig_id, read_id, complement, offset [, begin, end]); reads(read_id, seq, qual, individual).
    Reversed reads are reverse-complemented and their qualities turned. begin and end, where given, are the clear
    range in the read as it lies.
    """
    joined = placement.join(reads.select("read_id", "seq", "qual", "individual"), "read_id")
    lying = joined.select(
        "contig_id", "read_id", "individual", "offset", *(c for c in ("begin", "end") if c in placement.columns),
        F.when(F.col("complement"), S.reverse_complement(F.upper("seq"))).otherwise(F.upper("seq")).alias("seq"),
        F.when(F.col("complement"), F.reverse("qual")).otherwise(F.col("qual")).alias("qual"),
    )
    if "begin" in placement.columns:
        lying = lying.withColumn("seq", F.expr("substring(seq, begin + 1, end - begin)")).withColumn("qual", F.expr("slice(qual, begin + 1, greatest(end - begin, 0))"))
    each = lying.select("contig_id", "read_id", "individual", "offset", F.posexplode(F.arrays_zip(F.split("seq", "").alias("base"), F.col("qual").alias("quality"))).alias("i", "o"))
    return each.select("contig_id", (F.col("offset") + F.col("i")).cast("int").alias("pos"), S.base_class(F.col("o.base")).alias("base"), F.col("o.quality").cast("int").alias("quality"), "read_id", "individual").where("pos >= 0")


def column_counts(seen: DataFrame) -> DataFrame:
    """(contig_id, pos, a, c, g, t, other)."""
    counted = [F.count_if(F.col("base") == b).alias(b.lower()) for b in CLASSES]
    return seen.groupBy("contig_id", "pos").agg(*counted, F.count_if(~F.col("base").isin(*CLASSES)).alias("other"))


def interesting(columns: DataFrame) -> DataFrame:
    """Columns with at least two bases seen twice or more and fewer than two other signs."""
    twice = sum((F.col(b.lower()) >= 2).cast("int") for b in CLASSES)
    return columns.where((twice >= 2) & (F.col("other") < 2))


def profiles(seen: DataFrame, positions: DataFrame | None, least: int = 2, partitions: int | None = None) -> DataFrame:
    """(contig_id, pos, individual, base, n, quals) at positions, or at all if None; bases seen at least `least` times by individual.

    With partitions, observations meet in so many tasks by contig before their qualities are gathered."""
    here = seen if positions is None else seen.join(positions.select("contig_id", "pos").distinct(), ["contig_id", "pos"], "left_semi")
    here = here.where(F.col("base").isin(*CLASSES)).select("contig_id", "pos", "individual", "base", "quality")
    here = here if partitions is None else here.repartition(partitions, "contig_id", "pos")
    units = here.groupBy("contig_id", "pos", "individual", "base").agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list("quality")).alias("quals"))
    return units.where(F.col("n") >= least)


def consensus(seen: DataFrame) -> DataFrame:
    """(contig_id, pos, base, quality): the commonest sign of each column (ties: higher summed quality, then
    the letter), and the summed quality of its support less that of the rest, at least 0."""
    votes = seen.where(F.col("base") != "N").groupBy("contig_id", "pos", "base").agg(F.count(F.lit(1)).alias("n"), F.sum("quality").alias("q"))
    total = votes.groupBy("contig_id", "pos").agg(F.max_by(F.struct("base", "q"), F.struct("n", "q", F.lit(255) - F.ascii("base"))).alias("best"), F.sum("q").alias("all"))
    return total.select("contig_id", "pos", "best.base", F.greatest(F.lit(0), F.least(F.lit(97), 2 * F.col("best.q") - F.col("all"))).cast("int").alias("quality"))


def ungapped(columns: DataFrame) -> DataFrame:
    """consensus columns with at: the place in the sequence without gaps; a gap has that of the base before."""
    w = Window.partitionBy("contig_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    return columns.withColumn("at", F.greatest(F.sum((F.col("base") != "*").cast("int")).over(w) - 1, F.lit(0)).cast("int"))


def contigs(columns: DataFrame, limit: int = 20) -> DataFrame:
    """(contig_id, seq, length): consensus without gaps, bases of quality at most limit in lower case."""
    letter = S.low_quality_case(F.col("base"), F.col("quality"), limit)
    kept = columns.where("base <> '*'").groupBy("contig_id").agg(F.array_sort(F.collect_list(F.struct("pos", letter.alias("c")))).alias("cs"))
    return kept.select("contig_id", F.array_join(F.transform("cs", lambda x: x["c"]), "").alias("seq"), F.size("cs").alias("length"))


def gap_columns(seen: DataFrame, gaps: int = 2, cover: int = 4) -> DataFrame:
    """(contig_id, pos, n_gaps, n_bases): columns with enough gaps, bases and reads to begin a 454 difference."""
    counted = seen.groupBy("contig_id", "pos").agg(F.count_if(F.col("base") == "*").alias("n_gaps"), F.count_if(F.col("base") != "*").alias("n_bases"))
    return counted.where((F.col("n_gaps") >= gaps) & (F.col("n_gaps") + F.col("n_bases") >= cover) & (F.col("n_bases") >= gaps))


def singletons(members: DataFrame, placement: DataFrame) -> DataFrame:
    """Members of clusters that no contig holds."""
    return members.join(placement.select(F.col("contig_id").alias("cluster"), "read_id").distinct(), ["cluster", "read_id"], "left_anti")


def alignment_lines(placement: DataFrame, reads: DataFrame) -> DataFrame:
    """(contig_id, read_id, line): each placed read at its offset."""
    joined = placement.join(reads.select("read_id", "seq"), "read_id")
    lying = F.when(F.col("complement"), S.reverse_complement("seq")).otherwise(F.col("seq"))
    line = F.when(F.col("offset") >= 0, F.concat(F.expr("repeat(' ', offset)"), lying)).otherwise(F.expr("substring(lying, 1 - offset)"))
    return joined.withColumn("lying", lying).select("contig_id", "read_id", line.alias("line"))
