"""Runs and blocks found by longer words than those that hits are made of."""

import random

import pytest
from pyspark.sql import functions as F

from readweave.operators import overlap
from readweave.profiles import GENOME_454, TRANSCRIPT_454


def reads(spark):
    """Pieces of a genome with repeats, turned, changed, with N and masked stretches; some without a name, a run or a text."""
    rng = random.Random(7)
    unit = "".join(rng.choice("ACGT") for _ in range(70))
    genome = "".join(rng.choice("ACGT") for _ in range(3000)) + unit * 4 + "".join(rng.choice("ACGT") for _ in range(500)) + unit
    out = []
    for i in range(110):
        at = rng.randrange(len(genome))
        seq = [rng.choice("ACGTN") if rng.random() < 0.01 else x for x in genome[at : at + rng.randint(0, 400)]]
        if i % 5 == 0 and len(seq) > 60:
            a = rng.randrange(len(seq) - 40)
            seq[a : a + 40] = [x.lower() for x in seq[a : a + 40]]
        seq = "".join(seq)
        out.append((f"r{i}", rng.choice([1, 2, 3, None]), seq if rng.random() < 0.5 else seq[::-1].translate(str.maketrans("ACGTacgt", "TGCAtgca"))))
    out += [("none", 2, None), ("empty", 1, ""), ("edge", 3, genome[100:140]), ("rim", 1, genome[60:140]), ("less", 1, genome[101:140])]
    df = spark.createDataFrame(out, "read_id string, run_seq long, seq string").repartition(3)
    return df.where("run_seq > 1"), df.where("run_seq < 3 or run_seq is null")


@pytest.mark.parametrize("share,least,size", [(0.9, 40, 8 << 20), (None, 40, 200), (0.7, 14, 8 << 20), (None, 55, 200)])
def test_runs_by_longer_words_are_those_of_hits(spark, monkeypatch, share, least, size):
    new, old = reads(spark)
    hits = overlap.seed_hits(new, old, 13, share)
    runs = overlap.exact_runs(hits, 13).where(F.col("length") >= least)
    monkeypatch.setattr(overlap, "PASS", size)
    monkeypatch.setattr(overlap.Words, "hits", None)  # no hit of words alone is made (F2, F3, F9)
    assert sorted(overlap.long_runs(new, old, 13, share, least).select(runs.columns).collect()) == sorted(runs.collect()) != []


@pytest.mark.parametrize("profile", [TRANSCRIPT_454, GENOME_454])
def test_blocks_by_longer_words_are_those_of_hits(spark, monkeypatch, profile):
    new, old = reads(spark)
    what = lambda df: sorted(map(tuple, df.collect()))
    got = what(overlap.overlap_blocks(new, old, profile))
    monkeypatch.setattr(overlap, "LongWords", lambda held, k, step, usable, least: overlap.Words(held, k, step, usable))
    assert got == what(overlap.overlap_blocks(new, old, profile)) and len(got) > 50


def test_pairs_of_many_parts_are_extended_together(spark, monkeypatch):
    """A call for each part's few pairs took most of the time of blocks (F2, F3); batches change no block."""
    import pyarrow as pa

    from readweave.operators import gapped

    new, old = reads(spark)
    works = []
    monkeypatch.setattr(overlap, "met", lambda *a: works.append(a[6]))
    overlap.overlap_blocks(new, old, TRANSCRIPT_454)
    words = overlap.LongWords(new.where("seq is not null").select("read_id", "run_seq", "seq").toArrow(), 13, 26, None, 40)
    parts = [pa.record_batch(old.where("run_seq is not null and seq is not null").select("read_id", "run_seq", "seq").toArrow().combine_chunks().to_batches()[0])]
    parts = [parts[0].slice(k, 3) for k in range(0, parts[0].num_rows, 3)]
    calls, plain = [], gapped.blocks_of
    monkeypatch.setattr(gapped, "blocks_of", lambda pairs, runs, s: calls.append(len(pairs)) or plain(pairs, runs, s))
    got = []
    for pairs, texts in ((1024, 16 << 20), (2, 16 << 20), (1024, 500)):
        monkeypatch.setattr(overlap, "PAIRS", pairs)
        monkeypatch.setattr(overlap, "TEXTS", texts)
        calls.clear()
        found = ((p, h) for p in parts for h in words.hits(p, True) if len(h[0]))
        got.append((sorted(str(r) for b in works[0](words, found) for r in b.to_pylist()), len(calls)))
    assert got[0][0] == got[1][0] == got[2][0] and len(got[0][0]) > 20 and got[0][1] == 1 and min(got[1][1], got[2][1]) > 5
