"""Words that reads share, found without a row for each word: stretches by bucket, hits by blocks of the new reads."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from readweave.operators import graph, kmers, overlap


def made(rng, n, longest=300):
    genome = "".join(rng.choice("ACGT") for _ in range(4000))
    out = []
    for _ in range(n):
        at = rng.randrange(len(genome))
        seq = genome[at : at + rng.randint(0, longest)]
        seq = "".join("N" if rng.random() < 0.005 else x for x in seq)
        out.append(seq if rng.random() < 0.5 else seq[::-1].translate(str.maketrans("ACGT", "TGCA")))
    return out


def test_stretches_hold_each_word_of_a_read_once_and_equal_words_meet():
    seqs = [*made(random.Random(1), 60), None, "", "ACGT" * 20, "A" * 31, "A" * 30]
    for k in (31, 13, 11, 5):
        read, bucket, text = kmers.word_stretches(pa.array(seqs), k, 7)
        row, _, code, _ = kmers.codes(text, k)
        own, _, whole, _ = kmers.codes(pa.array(seqs), k)
        assert sorted(zip(read[row].tolist(), code.tolist(), strict=True)) == sorted(zip(own.tolist(), whole.tolist(), strict=True))
        met = {}
        for c, b in zip(code.tolist(), bucket[row].tolist(), strict=True):
            met.setdefault(c, set()).add(b)
        assert all(len(x) == 1 for x in met.values())


@pytest.mark.parametrize("bucket", [300, 1 << 20])
def test_reads_that_share_rare_words(spark, monkeypatch, bucket):
    monkeypatch.setattr(kmers, "BUCKET", bucket)
    reads = [(f"r{i}", s) for i, s in enumerate(made(random.Random(2), 80))] + [("r0", "ACGT" * 30), (None, "ACGT" * 30), ("x", "ACGT" * 30), ("y", None)]
    by = {}
    for name, seq in reads:
        for i in range(len(seq or "") - 30):
            if "N" not in seq[i : i + 31]:
                by.setdefault(seq[i : i + 31], set()).add(name)
    want = {(a, b) for own in by.values() if 2 <= len(own) <= 5 for a in own for b in own if a and b and a > b}
    got = [(r.src, r.dst) for r in kmers.sharing_reads(spark.createDataFrame(reads, "read_id string, seq string"), 31, 2, 5).collect()]
    assert len(got) == len(want) > 20 and set(got) == want


@pytest.mark.parametrize("k,share,size", [(13, 0.9, 1500), (13, None, 1 << 20), (15, 0.9, 1500), (13, 0.9, 1 << 20)])
def test_hits_by_blocks_are_those_of_the_join(spark, monkeypatch, k, share, size):
    monkeypatch.setattr(overlap, "PASS", size)
    rng = random.Random(3)
    reads = [(f"r{i}", rng.choice([1, 2, 3, None]), s if i % 9 else s.lower()) for i, s in enumerate(made(rng, 90))]
    df = spark.createDataFrame(reads, "read_id string, run_seq long, seq string")
    new, old = df.where("run_seq > 1"), df.where("run_seq < 3 or run_seq is null")
    hits = overlap.seed_hits(new, old, k, share).distinct()
    want = hits.groupBy("name1", "name2", "strand").agg(F.count_distinct("diagonal").alias("n_diagonals"), F.count(F.lit(1)).alias("n_hits"))
    assert sorted(overlap.seed_pairs(new, old, k, share).collect()) == sorted(want.collect()) != []
    runs = overlap.exact_runs(hits, k).where("length >= 20")
    assert sorted(overlap.long_runs(new, old, k, share, 20).select(runs.columns).collect()) == sorted(runs.collect()) != []


def test_a_clique_cover_looks_at_neighbours_only(spark):
    # a star of 30,000 leaves: going through all begun cliques for each node took 450 million tests
    edges = spark.range(1, 30_001).select(F.lit(0).cast("long").alias("src"), F.col("id").alias("dst"))
    got = graph.greedy_cliques(graph.connected_components(edges), edges, over=1).collect()
    assert sorted(r.node for r in got) == [0, 1] and {r.clique for r in got} == {0}
