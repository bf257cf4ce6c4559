"""Operators on reads(run_id, read_id, seq, ord [, individual]): clones, totals, filters, qualities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from readweave.functions import sequence as S


def drop_clones(reads: DataFrame) -> DataFrame:
    """The first read (by ord, then read_id) of each exact sequence within a run; case counts.

    Two-step: the least (ord, read_id) of each sequence by hash aggregation on a digest, then a semi join, so
    a sequence that fills a run does not gather in one task.
    """
    keyed = reads.withColumn("digest", F.sha2("seq", 256))
    first = keyed.groupBy("run_id", "digest").agg(F.min(F.struct("ord", "read_id")).alias("first"))
    first = first.select("run_id", F.col("first.ord").alias("ord"), F.col("first.read_id").alias("read_id"))
    return reads.join(first, ["run_id", "ord", "read_id"], "left_semi")


def totals(reads: DataFrame) -> DataFrame:
    """One row: n_reads, total_bases."""
    return reads.agg(F.count(F.lit(1)).alias("n_reads"), F.coalesce(F.sum(F.length("seq")), F.lit(0)).cast("long").alias("total_bases"))


def run_totals(runs: DataFrame, count_first_run: bool = False) -> DataFrame:
    """runs(run_id, run_seq, bases_added, bases_used) with running totals; the first run does not count by default."""
    w = Window.orderBy("run_seq").rowsBetween(Window.unboundedPreceding, 0)
    counts = F.lit(True) if count_first_run else F.col("run_seq") > F.min("run_seq").over(Window.orderBy("run_seq").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    out = runs.withColumn("counts", counts)
    for c in ("bases_added", "bases_used"):
        out = out.withColumn(f"total_{c}", F.sum(F.when(F.col("counts"), F.col(c)).otherwise(0)).over(w))
    return out.drop("counts")


def repair_masks(seq, least: int = 40):
    """Upper-cases masked stretches of fewer than least bases."""
    parts = F.regexp_extract_all(seq, F.lit("([a-z]+|[^a-z]+)"), 1)
    return F.array_join(F.transform(parts, lambda p: F.when(F.length(p) < least, F.upper(p)).otherwise(p)), "")


def split_repeats(masked: DataFrame, min_length: int = 100) -> DataFrame:
    """Masked reads with verdict: kept, repeat (too little is unmasked) or short; short masks are undone first."""
    fixed = masked.withColumn("seq", repair_masks(F.col("seq")))
    verdict = F.when(F.length("seq") < min_length, "short").when(S.unmasked_length("seq") < min_length, "repeat").otherwise("kept")
    return fixed.withColumn("verdict", verdict)


def with_qualities(reads: DataFrame, quals: DataFrame, bias: int = 0) -> DataFrame:
    """reads joined with quals(read_id, qual array<int>), each value raised by bias; lengths must agree."""
    joined = reads.join(quals, "read_id")
    checked = F.when(F.size("qual") == F.length("seq"), F.transform("qual", lambda q: q + bias)).otherwise(
        F.raise_error(F.concat(F.lit("qualities do not fit read "), F.col("read_id")))
    )
    return joined.withColumn("qual", checked)


def quality_offset(reads: DataFrame, first: int = 100) -> int:
    """64 or 33 from the least character in the first reads(qual_ascii, ord); other characters are an error."""
    low = reads.orderBy("ord").limit(first).select(F.array_min(F.transform(F.split("qual_ascii", ""), lambda c: F.ascii(c))).alias("low")).agg(F.min("low")).first()[0]
    if low is None or low < 33:
        raise ValueError(f"no quality offset fits character {low}")
    return 64 if low >= 64 else 33


def remove_run(reads: DataFrame, run_id: str) -> DataFrame:
    return reads.where(F.col("run_id") != run_id)


def observed(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, Observation]:
    """df with counters that are filled as it runs: rows, and any other aggregates. Read them with .get."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *(m.alias(k) for k, m in metrics.items())), seen
