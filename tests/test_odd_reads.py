"""Queries of reads on documents without a text, without a letter, and without an id."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from readweave.operators import kmers
from readweave.plans import registry
from readweave.sources import text as sources


@pytest.fixture
def odd(spark, tmp_path):
    docs = [(1, "Ab c"), (2, ""), (3, None), (4, "12 中"), (5, "xyz")]
    spark.createDataFrame([(i, "en", "src1", t) for i, t in docs], "doc_id long, lang string, source string, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def test_fastq_of_reads_without_a_base(spark, odd):
    got = {r.read_id: (r.seq, r.qual_ascii) for r in registry.QUERIES["fastq_source"](spark, odd).collect()}
    assert got == {"doc_1": ("ACG", "BJR"), "doc_2": ("", ""), "doc_3": (None, None), "doc_4": ("", ""), "doc_5": ("TAC", "^BJ")}


def test_lines_are_numbered_without_a_shuffle_of_lines(spark, tmp_path):
    (tmp_path / "x").write_text("a\nb\n")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as where the lines are many
    try:
        plan = sources.numbered_lines(spark, str(tmp_path / "x"))._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_reads_are_counted_in_pieces_of_a_bounded_size(spark, monkeypatch):
    """Rows that go to Python are pieces, not reads (F16, F17, F18, F23); a read may begin in one batch and end in another."""
    rng, k = np.random.default_rng(3), 5
    sizes = [0, 4, 5, 6, 40, 41, 44, 45, 300, 12, 7, 1000]
    rows = [(f"r{i}", "".join(rng.choice(list("ACGTacgtN"), n, p=[0.23, 0.23, 0.23, 0.23, 0.015, 0.015, 0.015, 0.015, 0.02]))) for i, n in enumerate(sizes)] + [("same", "A" * 333), ("wide", "ACGTA中ACGTACGTA"), ("none", None)]
    reads = spark.createDataFrame(rows, "read_id string, seq string")
    turn = str.maketrans("ACGT", "TGCA")
    each = {}
    for name, seq in rows:
        words = [w for w in ((seq or "").upper()[i : i + k] for i in range(len(seq or "") - k + 1)) if set(w) <= set("ACGT")]
        each[name] = Counter(w for word in words for back in [word.translate(turn)[::-1]] for w in [min(word, back)] * (1 + (word == back)))
    monkeypatch.setattr(kmers, "PIECE", 8)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        assert reads.where("length(seq) >= 5").select(F.explode(kmers.pieces(k)).alias("p")).agg(F.max(F.octet_length("p"))).first()[0] == 8 + k - 1
        assert {r.kmer: r.cnt for r in kmers.canonical_counts(reads, k).collect()} == sum(each.values(), Counter())
        assert {r.read_id: r.most for r in kmers.repeats_within(reads, k).collect()} == {name: max(c.values()) for name, c in each.items() if c}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
