"""Words that are packed by part and counted there: counts, means, spans and masks of reads of any kind."""

import random

import pytest

from readweave.operators import kmers


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def made():
    rng = random.Random(5)
    motif = "".join(rng.choice("ACGT") for _ in range(50))
    out = [(f"r{i}", "".join(rng.choices("ACGTacgtN", [9, 9, 9, 9, 1, 1, 1, 1, 1], k=rng.randrange(120))) + (motif + "N" * (i % 2) + motif if i % 3 else "")) for i in range(70)]
    return [*out, ("same", "A" * 90), ("pairs", "ACGT" * 30), ("none", None), ("", ""), (None, motif), (None, "ACGTTGCA" * 9)]


@pytest.mark.parametrize("k", [6, 7, 13])
def test_reads_are_scored_in_chunks_without_a_row_for_each_word(spark, monkeypatch, k):
    """As by the broadcast scores, in as many parts and chunks as there may be; neither words nor counts are joined or sent (F5, F7, F8, F11)."""
    reads = spark.createDataFrame(made(), "read_id string, seq string").repartition(3)
    counts = kmers.code_counts(reads, k).cache()
    found = []
    for part, chunk in ((1 << 22, 1 << 20), (200, 10)):
        monkeypatch.setattr(kmers, "PART", part)
        monkeypatch.setattr(kmers, "CHUNK", chunk)
        spread, told, cuts = kmers.in_place(reads, k)
        assert cuts == kmers.cutoffs(counts).first().asDict()
        for cuts in (cuts, {"low": 2, "extend": 3, "threshold": 5, "high": 30}):
            got = [kmers.means_in_place(spread, told, cuts, k), kmers.intervals_in_place(spread, told, cuts, k), kmers.masked_in_place(reads, spread, told, cuts, k)]
            want = [kmers.means(reads, counts, cuts, k), kmers.intervals(reads, counts, cuts, k), kmers.masked(reads, counts, cuts, k)]
            assert [rows(x) for x in got] == [rows(x) for x in want]
            assert not any(x in df._jdf.queryExecution().executedPlan().toString() for df in got for x in ("Join", "Broadcast"))
        found.append([len(rows(x)) for x in got])
    assert found[0] == found[1] and min(found[0]) > 20


def test_words_are_shuffled_in_packed_rows(spark, monkeypatch):
    """No row for each word of a task (F10, F12), and a count of more than a byte."""
    reads = spark.createDataFrame([*made(), *((f"m{i}", "ACGTT" * 40) for i in range(40))], "read_id string, seq string")
    plain = {}
    turn = str.maketrans("ACGT", "TGCA")
    for _, seq in reads.collect():
        for w in ((seq or "").upper()[i : i + 7] for i in range(len(seq or "") - 6)):
            if set(w) <= set("ACGT"):
                own = min(w, w.translate(turn)[::-1])
                plain[own] = plain.get(own, 0) + 1
    for held in (1 << 21, 100):
        monkeypatch.setattr(kmers, "HELD", held)
        got = kmers.canonical_counts(reads, 7)
        assert {r.kmer: r.cnt for r in got.collect()} == plain and max(plain.values()) > 1000
        assert "HashAggregate" not in got._jdf.queryExecution().executedPlan().toString()
    codes = kmers.scored(kmers.code_counts(reads, 7), {"low": 2, "high": 300})
    assert {r.kmer: (r.cnt, r.score) for r in kmers.in_letters(codes, 7).collect()} == {w: (n, 300 if n > 300 else 1 if n <= 2 else n) for w, n in plain.items()}
