"""Contracts of the operators on hand-computed inputs."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from readweave.functions import sequence as S
from readweave.operators import clusters as C
from readweave.operators import culling, graph, kmers, overlap, pileup, snps
from readweave.operators import reads as R
from readweave.profiles import TRANSCRIPT_454

READ = "run_id string, read_id string, seq string, ord long"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_clones_keep_the_first_read_of_a_run(spark):
    df = spark.createDataFrame([("r", "b", "ACGT", 1), ("r", "a", "ACGT", 2), ("r", "c", "acgt", 3), ("q", "d", "ACGT", 4)], READ)
    assert [r.read_id for r in R.drop_clones(df).orderBy("ord").collect()] == ["b", "c", "d"]
    assert rows(R.drop_clones(R.drop_clones(df))) == rows(R.drop_clones(df))


def test_sequence_functions(spark):
    lit = F.lit
    assert one(spark, S.reverse_complement(lit("ACGTNRacgt"))) == "acgtYNACGT"
    assert one(spark, S.kmer_code(lit("ACGT"))) == 27
    assert one(spark, S.kmer_decode(lit(27), 4)) == "ACGT"
    assert [one(spark, S.encode_base(lit(c))) for c in "ACgTN"] == [0, 1, 2, 3, -1]
    assert one(spark, S.compress_homopolymers(lit("AACCCGTT"))) == "ACGT"
    assert one(spark, S.wrap(lit("A" * 120))) == "A" * 60 + "\n" + "A" * 60
    assert one(spark, S.wrap(lit("A-" * 61))) == "A" * 60 + "\nA"
    assert one(spark, S.phred_encode(S.phred_decode(lit("!I~"), 33))) == "!I~"
    assert one(spark, S.key_int(lit("x length=12  numreads=7"), "numreads")) == 7
    assert one(spark, S.accession(lit("ABC.1_2"))) == "ABC"
    assert one(spark, S.joined_name(lit("a b  c"))) == "a:b:c"
    assert one(spark, S.without_n(lit("ANGN"))) == "AAGA"
    assert [one(spark, S.base_class(lit(c))) for c in "aT*-nR"] == ["A", "T", "*", "*", "N", "N"]


@pytest.mark.parametrize("coverage,most", [(0.01, 3), (0.1, 5), (0.5, 7), (1, 8), (2, 11), (5, 17), (10, 26), (19, 39), (20, 41)])
def test_max_hits(coverage, most):
    assert S.max_hits(int(coverage * 1000), 1000) == most


def test_max_hits_without_bound():
    assert S.max_hits(1, 1, unlimited=True) == 2**31 - 101


def test_palindromic_kmer_counts_twice(spark):
    df = spark.createDataFrame([("r", "a", "ACGT", 1)], READ)
    assert rows(kmers.canonical_counts(df, 4)) == [("ACGT", 2)]


@pytest.mark.parametrize("k", [1, 5, 13, 16, 31])
def test_kmers_of_long_and_short_reads(spark, monkeypatch, k):
    monkeypatch.setattr(kmers, "STEP", 500)
    rng = random.Random(k)
    reads = [("r", f"x{n}", "".join(rng.choice("ACGTacgtN" if n % 2 else "ACGT") for _ in range(n * 37 % 400)), n) for n in range(40)] + [("r", "empty", "", 99), ("r", "none", None, 100)]
    df = spark.createDataFrame(reads, READ)
    code = lambda w: sum("ACGT".index(c) << 2 * (len(w) - 1 - i) for i, c in enumerate(w))
    rc = lambda w: w[::-1].translate(str.maketrans("ACGT", "TGCA"))
    want, least = [], []
    for _, name, seq, _ in reads:
        for i in range(len(seq or "") - k + 1):
            w = seq[i : i + k]
            if not set(w) - set("ACGT"):
                want.append((name, i, code(w)))
            if not set(w.upper()) - set("ACGT"):
                least.append((name, i, min(code(w.upper()), code(rc(w.upper())))))
    assert rows(kmers.places(df, k, upper=False)) == sorted(want, key=str)
    assert rows(kmers.places(df, k, canonical=True)) == sorted(least, key=str)


def test_cutoffs_are_exact_order_statistics(spark):
    df = spark.createDataFrame([(str(i), i) for i in range(1, 1001)], "kmer string, cnt long")
    assert tuple(kmers.cutoffs(df).first()) == (1000, 901, 991, 996, 999)
    assert kmers.cutoffs(df.limit(0)).first().n_kmers == 0


def test_scores(spark):
    df = spark.createDataFrame([("a", 3), ("b", 9), ("c", 50)], "kmer string, cnt long")
    assert rows(kmers.scored(df, {"low": 5, "high": 20}).select("kmer", "score")) == [("a", 2), ("b", 9), ("c", 20)]


def masked_model(seq, scores, k, extend, threshold, span=5):
    means = [sum(scores[j : j + span]) // span for j in range(len(seq) - k - span + 1)]
    out, last = list(seq), 0
    for j, m in enumerate(means):
        if m > threshold:
            for x in range(j, j + k + span - 1):
                out[x] = out[x].lower()
            if all(y > extend for y in means[last:j]):
                for x in range(last, j):
                    out[x] = out[x].lower()
            last = j + 1
    return "".join(out)


def test_masking_equals_the_sequential_model(spark):
    rng = random.Random(5)
    k, reads = 4, [("r", f"x{i}", "".join(rng.choice("ACGT") for _ in range(40)), i) for i in range(25)] + [("r", "short", "ACG", 99)]
    df = spark.createDataFrame(reads, READ)
    counts = {r.kmer: r.cnt for r in kmers.canonical_counts(df, k).collect()}
    cuts = {"low": 1, "extend": 6, "threshold": 7, "high": 30, "n_kmers": len(counts)}
    rc = lambda w: w[::-1].translate(str.maketrans("ACGT", "TGCA"))
    score = lambda w: (lambda c: 30 if c > 30 else 0 if c <= 1 else c)(counts[min(w, rc(w))])
    got = {r.read_id: r.seq for r in kmers.masked(df, kmers.code_counts(df, k), cuts, k).collect()}
    whole = {r.read_id for r in kmers.repeats_within(df, k).where("most >= 6").collect()}
    for _, name, seq, _ in reads:
        want = seq.lower() if len(seq) < k or name in whole else masked_model(seq, [score(seq[i : i + k]) for i in range(len(seq) - k + 1)], k, 6, 7)
        assert got[name] == want, name
    assert any(c.islower() for s in got.values() for c in s)


def test_update_filter(spark):
    cases = {"kept": "A" * 60 + "c" * 39 + "G" * 20, "repeat": "A" * 99 + "c" * 40, "short": "A" * 99, "edge": "A" * 100 + "c" * 40}
    df = spark.createDataFrame([("r", k, v, 1) for k, v in cases.items()], READ)
    got = {r.read_id: (r.verdict, r.seq) for r in R.split_repeats(df).collect()}
    assert got == {"kept": ("kept", ("A" * 60 + "c" * 39 + "G" * 20).upper()), "repeat": ("repeat", cases["repeat"]), "short": ("short", cases["short"]), "edge": ("kept", cases["edge"])}


@pytest.mark.parametrize("low,offset", [("!", 33), ("?", 33), ("@", 64)])
def test_quality_offset(spark, low, offset):
    df = spark.createDataFrame([("zz" + low, 1)], "qual_ascii string, ord long")
    assert R.quality_offset(df) == offset


def test_quality_offset_fails_below(spark):
    with pytest.raises(ValueError):
        R.quality_offset(spark.createDataFrame([(" a", 1)], "qual_ascii string, ord long"))


def test_run_totals_leave_the_first_run_out(spark):
    df = spark.createDataFrame([("a", 1, 10, 5), ("b", 2, 20, 6), ("c", 3, 30, 7)], "run_id string, run_seq long, bases_added long, bases_used long")
    assert [r.total_bases_added for r in R.run_totals(df).orderBy("run_seq").collect()] == [0, 20, 50]
    assert [r.total_bases_used for r in R.run_totals(df, True).orderBy("run_seq").collect()] == [5, 11, 18]


def test_qualities_must_fit(spark):
    df = spark.createDataFrame([("r", "a", "ACG", 1)], READ)
    good = spark.createDataFrame([("a", [1, 2, 3])], "read_id string, qual array<int>")
    assert R.with_qualities(df, good, 1).first().qual == [2, 3, 4]
    with pytest.raises(Exception, match="do not fit"):
        R.with_qualities(df, spark.createDataFrame([("a", [1])], "read_id string, qual array<int>")).collect()


def test_overlap_finds_planted_overlaps_on_both_strands(spark):
    rng = random.Random(9)
    genome = "".join(rng.choice("ACGT") for _ in range(600))
    rc = genome[::-1].translate(str.maketrans("ACGT", "TGCA"))
    late = genome[100:300]
    late = late[:90] + ("A" if late[90] != "A" else "C") + late[91:]
    new = spark.createDataFrame([("n", 2, late)], "read_id string, run_seq long, seq string")
    old = spark.createDataFrame([("fwd", 1, genome[:250]), ("rev", 1, rc[350:550]), ("far", 1, genome[400:]), ("newer", 3, genome[:250])], "read_id string, run_seq long, seq string")
    got = {r.name2: r for r in overlap.overlap_blocks(new, old, TRANSCRIPT_454).collect()}
    assert set(got) == {"fwd", "rev"}
    assert (got["fwd"].s1, got["fwd"].o1, got["fwd"].s2, got["fwd"].strand2) == (0, 150, 100, "+")
    assert got["rev"].strand2 == "-" and got["rev"].o1 >= 149


def test_masked_words_seed_nothing(spark):
    new = spark.createDataFrame([("n", 2, "acgtacgtaacc" * 5)], "read_id string, run_seq long, seq string")
    old = spark.createDataFrame([("o", 1, "ACGTACGTAACC" * 5)], "read_id string, run_seq long, seq string")
    assert overlap.seed_hits(new, old, 13).count() == 0


def block(name1, name2, aln1, aln2, s1=0, s2=0, n=101):
    return (name1, s1, n, aln1, name2, s2, n, aln2)


BLOCKS = "name1 string, s1 int, o1 int, aln1 string, name2 string, s2 int, o2 int, aln2 string"


def test_cluster_update(spark):
    one_, two = "A" * 50 + "C" + "A" * 50, "A" * 50 + "G" + "A" * 50
    made = spark.createDataFrame([block("n", "o", one_, two), block("n", "p", one_, two, n=100)], BLOCKS)
    names = spark.createDataFrame([(x, "i") for x in "nop"], "read_id string, individual string")
    views = C.sides(made, names, 100)
    assert rows(views.select("cluster", "read_id")) == [("n", "o"), ("o", "n")]
    assert rows(C.block_diffs(views)) == [("n", 50, "C", "G", 1), ("o", 50, "G", "C", 1)]


def test_repeats_collapse_and_stay(spark):
    base = C.templates(spark.createDataFrame([("s", "ACGT", "i", 1), ("t", "ACGT", "i", 2)], "read_id string, seq string, individual string, ord long"))
    views = spark.createDataFrame([("s", f"m{k}", "i", "A", "C", k, 1) for k in range(4)] + [("t", "m0", "i", "AAAA", "CCCC", 100, 4)], "cluster string, read_id string, individual string, ref string, tgt string, start int, n int")
    state = C.updated(base, views, 4)
    assert rows(state.clusters.select("cluster", "is_repeat")) == [("s", True), ("t", False)]
    assert rows(state.members.select("cluster", "read_id")) == [("s", "s"), ("t", "m0"), ("t", "t")]
    assert state.diffs.count() == 4
    again = C.updated(state, views.limit(0), 100)
    assert rows(again.clusters.select("cluster", "is_repeat")) == [("s", True), ("t", False)]


def test_good_clusters(spark):
    members = [(c, f"{c}{k}", "x" if k < 2 else "y") for c in "abcdef" for k in range(4)] + [("g", "g0", "x"), ("g", "g1", "x"), ("g", "g2", "y")]
    diffs = [("a", 10, "A", "C", 2), ("b", 10, "A", "C", 2), ("b", 49, "A", "C", 2), ("c", 10, "A", "C", 2), ("c", 50, "A", "C", 1), ("d", 1, "A", "C", 2), ("d", 50, "A", "G", 2), ("d", 100, "A", "T", 2), ("e", 5, "A", "-", 3), ("f", 5, "A", "C", 1), ("g", 10, "A", "C", 2)]
    got = C.good(spark.createDataFrame(members, "cluster string, read_id string, individual string"), spark.createDataFrame(diffs, "cluster string, position int, reference string, target string, reads long"), 2)
    assert rows(got) == [("a",), ("c",)]


def test_components_equal_union_find(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(1000 + k, 1001 + k) for k in range(40)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    got = dict(graph.connected_components(spark.createDataFrame(edges, "src long, dst long")).collect())
    assert got == {x: find(x) for x in got} and set(got) == {x for e in edges if e[0] != e[1] for x in e}
    assert graph.connected_components(spark.createDataFrame([(1, 1), (None, 2)], "src long, dst long")).count() == 0


def test_graph_helpers(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "a"), ("b", "c"), ("c", "d")], "src string, dst string")
    assert rows(graph.canonical_edges(edges)) == [("b", "a"), ("c", "b"), ("d", "c")]
    assert rows(graph.condemn(edges, spark.createDataFrame([("b",)], "id string"))) == [("c", "d")]
    assert rows(graph.over_degree(edges, 1)) == [("b", 2), ("c", 2)]
    assert rows(graph.edge_exists(spark.createDataFrame([("c", "b"), ("a", "d")], "src string, dst string"), edges)) == [("c", "b")]


def test_cliques_over_four_nodes_only(spark):
    full = [(f"a{i}", f"a{j}") for i in range(5) for j in range(i)] + [(f"b{i}", f"b{j}") for i in range(4) for j in range(i)]
    edges = spark.createDataFrame(full, "src string, dst string")
    got = graph.greedy_cliques(graph.connected_components(edges), edges)
    assert rows(got.select("node")) == [(f"a{i}",) for i in range(5)]


def test_disjoint_equals_the_sequential_model(spark):
    rng = random.Random(4)
    held = [(c, [f"m{rng.randrange(25)}" for _ in range(rng.randrange(3, 7))]) for c in range(20)]
    held = [(c, list(dict.fromkeys(m))) for c, m in held]
    seen, want = set(), []
    for c, m in held:
        clear = True
        for x in m:
            if x in seen:
                clear = False
                break
            seen.add(x)
        if clear and len(m) >= 4:
            want.append((c,))
    df = spark.createDataFrame([(c, c, x, k) for c, m in held for k, x in enumerate(m)], "cluster long, ord long, member string, place int")
    assert rows(culling.disjoint(df)) == sorted(want, key=str)


def test_pileup_columns(spark):
    def col(pos, bases):
        return [(1, pos, b, 30, f"r{pos}{k}", "i" if k % 2 else "j") for k, b in enumerate(bases)]

    seen = spark.createDataFrame(col(1, "AACC") + col(2, "AAAC") + col(3, "AACCNN") + col(4, "AACCN"), "contig_id int, pos int, base string, quality int, read_id string, individual string")
    hot = pileup.interesting(pileup.column_counts(seen))
    assert rows(hot.select("pos")) == [(1,), (4,)]
    assert rows(pileup.profiles(seen, hot, 1).where("pos = 1").select("individual", "base", "n")) == [("i", "A", 1), ("i", "C", 1), ("j", "A", 1), ("j", "C", 1)]


def test_observations_skip_and_turn(spark):
    placement = spark.createDataFrame([("c", "f", False, -1), ("c", "r", True, 2)], "contig_id string, read_id string, complement boolean, offset int")
    reads = spark.createDataFrame([("f", "ACG", [1, 2, 3], "i"), ("r", "AAC", [4, 5, 6], "j")], "read_id string, seq string, qual array<int>, individual string")
    assert rows(pileup.observations(placement, reads).select("pos", "base", "quality", "read_id")) == [(0, "C", 2, "f"), (1, "G", 3, "f"), (2, "G", 6, "r"), (3, "T", 5, "r"), (4, "T", 4, "r")]


def test_gap_alternation():
    reads = ["r1", "r2", "r3", "r4"]
    column = lambda signs, consensus: {"consensus": consensus, "reads": dict(zip(reads, signs, strict=True))}
    plain = lambda b: column(b * 4, b)
    found = snps.alternations([plain("G"), column("AA**", "A"), column("**CC", "*"), plain("T"), plain("A")])
    assert found == [[1, 2]]
    assert snps.alternations([plain("G"), column("AA**", "A"), column("CC**", "*"), plain("T")]) == []
    assert snps.alternations([plain("G"), column("AAA*", "A"), column("***C", "*"), plain("T")]) == []


def test_all_ways_of_masking_agree(spark, monkeypatch):
    """All scores sent to the tasks, some of them, or none, with full and tiny filters, give the same means and spans."""
    rng = random.Random(8)
    motif = "".join(rng.choice("ACGT") for _ in range(40))
    made = [(f"r{k}", "".join(rng.choice("ACGT") for _ in range(rng.randrange(0, 90))) + (motif + "N" * (k % 2) + motif if k % 3 else "") + "".join(rng.choice("ACGTN") for _ in range(rng.randrange(0, 60)))) for k in range(60)]
    reads = spark.createDataFrame(made, "read_id string, seq string").repartition(3)
    counts = kmers.code_counts(reads, 7).cache()
    cuts = {"low": 2, "extend": 3, "threshold": 5, "high": 30}
    found = []
    for most, size in ((1 << 22, 1 << 22), (0, 1 << 22), (20, 1 << 10), (0, 4)):
        monkeypatch.setattr(kmers, "SENT", most)
        monkeypatch.setattr(kmers, "FILTER", size)
        found.append((rows(kmers.means(reads, counts, cuts, 7)), rows(kmers.intervals(reads, counts, cuts, 7)), rows(kmers.masked(reads, counts, cuts, 7))))
    assert all(f == found[0] for f in found) and len(found[0][1]) > 5
    by_join = kmers.mask_intervals(kmers.window_means(reads, kmers.scored(counts, cuts), 7), 7, cuts["extend"], cuts["threshold"])
    assert rows(by_join) == found[0][1]


def test_words_are_asked_for_only_where_a_window_may_be_masked(spark, monkeypatch):
    """Words are looked up for reads whose windows may be over the threshold only, and reads are dealt once."""
    rng = random.Random(3)
    motif = "".join(rng.choice("ACGT") for _ in range(60))
    made = [(f"r{k:03d}", "".join(rng.choice("ACGT") for _ in range(150)) + (motif if k < 20 else "")) for k in range(200)]
    reads = spark.createDataFrame(made, "read_id string, seq string")
    counts = spark.createDataFrame(kmers.code_counts(reads, 13).collect(), "code long, cnt long")
    cuts = {"low": 1, "extend": 3, "threshold": 5, "high": 30}
    monkeypatch.setattr(kmers, "SENT", 0)
    sent, rest = kmers._sent_in_part(counts, cuts)
    batch = reads.select("seq").toArrow().column(0).combine_chunks()
    read, place, word = sent.value.asked(batch, 13)
    assert set(range(20)) <= set(read.tolist()) and len(set(read.tolist())) < 80 and rest.count() >= 48
    assert {int(w) for w in word} >= {r.code for r in counts.where("cnt >= 20").collect()}
    plan = kmers.intervals(reads, counts, cuts, 13)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") == 2 and plan.count("ENSURE_REQUIREMENTS") == 3 and len(rows(kmers.intervals(reads, counts, cuts, 13))) > 0


def plain_alternations(columns):
    """The same by strings and sets: stretches from a pattern, and each prefix of the candidates judged afresh."""
    columns, found, free = [dict(c) for c in columns], [], 0
    for s in range(len(columns) - 1):
        calls = "".join(next((x for x in c["reads"].values() if x not in "*N"), "*") for c in columns)
        signs = [c["reads"] for c in columns]
        covered = [len(x) >= 4 and list(x.values()).count("*") >= 2 for x in signs]
        bases = [{r for r, x in own.items() if x != "*"} for own in signs]
        if s < free or not covered[s] or len(bases[s]) < 2 or calls[s] == "*":
            continue
        own = re.match(r"(.)\1*", calls[s:]).end()
        candidates, met = [], calls[s]
        if all(columns[k]["consensus"] == "*" for k in range(s + 1, s + own)):
            for m in re.finditer(r"(.)\1*", calls[s + own :]):
                k, long = s + own + m.end() - 1, len(m[0]) > 1
                if m[1] in met:
                    break
                if long or (m[1] != "*" and columns[k]["consensus"] != "N"):
                    candidates.append(k)
                    met += m[1]
                if long:
                    break
        ok = []
        for k in candidates:
            before = bases[s].union(*(bases[j] for j in ok)) & set(signs[s])
            here = bases[k] & set(signs[s])
            if not covered[k] or not here or here & before or not here - before:
                break
            ok.append(k)
        took = [s] + [k for k in ok if len(bases[k]) >= 2]
        if len(took) > 1:
            found.append(took)
            free = took[-1] + 1
            for k in took:
                columns[k]["consensus"] = "*" if k > s else calls[s]
    return found


def test_gap_alternation_equals_the_plain_model():
    rng = random.Random(5)
    hits = 0
    for _ in range(20000):
        reads = [f"r{k}" for k in range(rng.randrange(3, 8))]
        columns = []
        for _ in range(rng.randrange(2, 9)):
            letter = rng.choice("ACGT")
            own = {r: rng.choice([letter, letter, "*", "*", rng.choice("ACGT*N")]) for r in reads if rng.random() < 0.95} or {"r0": letter}
            columns.append({"consensus": rng.choice(["*", "*", letter, letter, "N"]), "reads": own})
        want = plain_alternations(columns)
        assert snps.alternations(columns) == want
        hits += bool(want)
    assert hits > 500


def test_snp_rules(spark):
    seq = "ACGT" * 30 + "CAAAAAG" + "ACGT" * 30
    names = ["low", "side", "far", "over", "homo", "single", "three"]
    blocks = spark.createDataFrame([(n, 1, 10, len(seq), seq) for n in names] + [("multi", 2, 10, len(seq), seq)], "cluster string, n_contigs int, numreads int, length int, seq string")
    two = lambda c, p, a=(30, 30), b=(30, 30): [(c, p, "i", "A", list(a)), (c, p, "j", "C", list(b))]
    n = len(seq)
    units = two("low", 49) + two("side", 50) + two("far", n - 50) + two("over", n - 49) + two("homo", 122) + two("single", 60, b=(30, 2)) + two("three", 60) + [("three", 60, "k", "G", [30, 30])] + two("multi", 60)
    df = spark.createDataFrame(units, "cluster string, pos int, individual string, base string, quals array<int>")
    assert rows(snps.accepted(blocks, df, snps.Rules()).select("cluster", "good")) == [("far", [n - 50]), ("side", [50])]
    assert snps.accepted(blocks, df.where("individual = 'i'"), snps.Rules(two_names=True)).count() == 0


def test_many_spans_are_lowered_in_one_pass_and_masking_joins_no_texts(spark):
    import time

    import pyarrow as pa

    text = pa.array(["AcGTN" * 80_000, None, "", "ACGT"])
    spans = np.arange(0, 400_000, 4)
    began = time.time()
    got = kmers.lowered(text, np.append(np.zeros(len(spans), np.int64), [3]), np.append(spans, [2]), np.append(spans + 2, [9])).to_pylist()
    assert time.time() - began < 5  # 100,000 copies of 400,000 bases took much longer
    upper = "ACGTN" * 80_000
    assert got[0] == "".join(x.lower() if i % 4 < 2 else x for i, x in enumerate(upper)) and got[1:] == ["", "", "ACgt"]
    assert kmers.lowered(text.slice(2), np.array([1]), np.array([1]), np.array([3])).to_pylist() == ["", "AcgT"]
    reads = spark.createDataFrame([("a", "ACGTTGCAAC" * 9), ("b", "ACG"), ("c", None)], "read_id string, seq string")
    cuts = {"low": 1, "extend": 3, "threshold": 5, "high": 30}
    made = kmers.masked(reads, kmers.code_counts(reads, 7), cuts, 7)
    assert "Join" not in made._jdf.queryExecution().executedPlan().toString()
    assert rows(made.select("read_id", "seq")) == [("a", ("ACGTTGCAAC" * 9).lower()), ("b", "acg"), ("c", None)]


def test_words_that_decide_nothing_are_not_asked_for():
    """A low window before a masked one settles what lies between; words up to a cutoff bound their windows."""
    import pyarrow as pa

    rng = random.Random(5)
    text = pa.array(["".join(rng.choice("ACGT") for _ in range(600))])
    read, place, code, back = kmers.codes(text, 13)
    least = np.minimum(code, back)
    cuts = {"low": 2, "extend": 10, "threshold": 20, "high": 100}
    marks = []
    for own, bound in ((least, 10), (least[:0], 20), (least[300:310], 100)):
        filter_ = np.zeros(1 << 16, np.uint64)
        np.bitwise_or.at(filter_, *kmers._marks(own, 1 << 16))
        marks.append((filter_, bound))
    asked = kmers.Scores(least[:0], least[:0], cuts, marks).asked(text, 13)[1]
    assert {int(x) for x in asked} >= set(range(296, 314)) and len(asked) < 40


def test_edges_shrink_to_a_forest_in_each_task(spark):
    """A dense graph's edges become fewer than the nodes of a task, whatever the batches, and connect what they did."""
    rng = random.Random(8)
    pairs = [(f"n{a % 40}", f"n{(a + 20 * rng.randrange(40)) % 400}") for a in range(9000)] + [("x", "x"), (None, "y"), ("y", "z")]
    edges = spark.createDataFrame(pairs, "src string, dst string").coalesce(1)

    def groups(links):
        labels = {n: n for p in pairs for n in p if n}
        while any(labels[a] != labels[b] for a, b in links):
            for a, b in links:
                labels[a] = labels[b] = min(labels[a], labels[b])
        return labels

    want = groups([p for p in pairs if None not in p])
    old = graph.FOREST_EDGES
    for graph.FOREST_EDGES in (old, 1000):
        found = [tuple(r) for r in graph._forest(edges).collect()]
        assert len(found) < len(want)
        assert groups(found) == want
    graph.FOREST_EDGES = old
    assert {r.node: r.component for r in graph.connected_components(edges).collect()} == {n: c for n, c in want.items() if n != "x"}
