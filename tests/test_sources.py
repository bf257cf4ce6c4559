"""Readers and writers on small files; round trips."""

import random

import pytest

from readweave.sources import sff, text


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_fasta(spark, tmp_path):
    (tmp_path / "a.fa").write_text(">r1 first read\nACGT\nac-1gt\n>r2\n\n>r3 x\nNNN\n")
    got = text.read_fasta(spark, str(tmp_path), glob="*.fa")
    assert rows(got.select("read_id", "seq", "run_file")) == [("r1", "ACGTacgt", "a.fa"), ("r2", "", "a.fa"), ("r3", "NNN", "a.fa")]
    assert rows(text.read_fasta(spark, str(tmp_path), True).select("read_id"))[0] == ("r1 first read",)
    (tmp_path / "b").write_text(">r1 c.1A>G note\r\nACGT\r\n>r2>x\nTT\n")
    assert rows(text.read_fasta(spark, str(tmp_path / "b")).select("read_id", "header", "seq")) == [("r1", "r1 c.1A>G note", "ACGT"), ("r2>x", "r2>x", "TT")]
    (tmp_path / "c").write_text(">r1 a>b\n1 2\n>r2\n3\n")
    assert rows(text.read_quality_text(spark, str(tmp_path / "c"))) == [("r1", [1, 2]), ("r2", [3])]


def test_fasta_round_trip(spark, tmp_path):
    reads = spark.createDataFrame([(f"r{k}", "ACGTTGCA" * (k + 1)) for k in range(20)], "read_id string, seq string")
    text.write_fasta(reads, str(tmp_path / "out"))
    assert rows(text.read_fasta(spark, str(tmp_path / "out")).select("read_id", "seq")) == rows(reads)


def test_qualities(spark, tmp_path):
    (tmp_path / "q").write_text(">a x\n1 2 3\n4\n>b\n\n")
    assert rows(text.read_quality_text(spark, str(tmp_path / "q"))) == [("a", [1, 2, 3, 4]), ("b", [])]


def test_fastq_over_many_splits(spark, tmp_path):
    rng = random.Random(1)
    made = []
    for k in range(400):
        n = rng.randrange(1, 30)
        made.append((f"r{k} {k} x", "".join(rng.choice("ACGTN.") for _ in range(n)), "".join(chr(rng.randrange(33, 74)) for _ in range(n))))
    (tmp_path / "x.fastq").write_text("".join(f"@{a}\n{b}\n+\n{c}\n" for a, b, c in made))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        got = text.read_fastq(spark, str(tmp_path / "x.fastq"))
        assert [tuple(r)[:3] for r in got.orderBy("ord").collect()] == [(a.replace(" ", ":"), b, c) for a, b, c in made]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_broken_fastq_fails(spark, tmp_path):
    (tmp_path / "x.fastq").write_text("@a\nACGT\n+\nIII\n")
    with pytest.raises(Exception, match="broken FASTQ"):
        text.read_fastq(spark, str(tmp_path / "x.fastq")).collect()


def test_cluster_text_round_trip(spark, tmp_path):
    kind = "cluster string, seq string, is_repeat boolean, members array<struct<read_id:string,individual:string>>, diffs array<struct<position:int,reference:string,target:string,reads:int>>"
    made = spark.createDataFrame([("c1", "ACGT", False, [("r1", "i"), ("r2", "j")], [(3, "A", "C", 2)]), ("c2", "TTT", True, [("c2", "i")], [])], kind)
    text.write_clusters(made, str(tmp_path / "c"))
    assert rows(text.read_clusters(spark, str(tmp_path / "c"))) == rows(made)
    assert rows(text.read_names(made)) == [("c2",), ("r1",), ("r2",)]


def test_maf_round_trip(spark, tmp_path):
    kind = "score int, name1 string, s1 int, o1 int, strand1 string, len1 int, aln1 string, name2 string, s2 int, o2 int, strand2 string, len2 int, aln2 string"
    made = spark.createDataFrame([(7, "a", 0, 4, "+", 9, "AC-GT", "b", 2, 5, "-", 8, "ACTGT"), (8, "a", 1, 1, "+", 9, "A", "c", 0, 1, "+", 3, "A")], kind)
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "x.maf").write_text("##maf version=1\n" + "".join(r.value + "\n" for r in text.maf_text(made).collect()))
    assert rows(text.read_maf(spark, str(tmp_path / "m"))) == rows(made)


def test_ace_and_afg(spark, tmp_path):
    (tmp_path / "x.ace").write_text("AS 1 2\n\nCO contig1 5 2 1 U\nAC*GT\n\nBQ\n20 30 40 50\n\nAF r1.1 U 1\nAF r2_x C 2\nBS 1 5 r1\n\nRD r1.1 5 0 0\nAC*GT\n\nQA 1 5 1 5\nDS x\n\nRD r2_x 4 0 0\nC*GT\n\nQA 1 4 2 4\nDS y\n")
    got = text.read_ace(spark, str(tmp_path / "x.ace"))
    assert rows(got.select("contig_id", "consensus", "read_id", "complement", "offset", "gapped", "begin", "end")) == [("contig1", "AC*GT", "r1", False, 0, "AC*GT", 0, 5), ("contig1", "AC*GT", "r2", True, 1, "C*GT", 1, 4)]
    assert got.first().base_quality == [20, 30, 40, 50]
    (tmp_path / "x.afg").write_text("{RED\niid:1\neid:r1 x\n}\n{RED\niid:2\neid:r2\n}\n{CTG\niid:1\neid:c1\nseq:\nACGT\n.\n{TLE\nsrc:1\noff:0\nclr:0,4\n}\n{TLE\nsrc:2\noff:-1\nclr:5,1\n}\n}\n")
    assert rows(text.read_afg(spark, str(tmp_path / "x.afg"))) == [("c1", "r1", False, 0, 0, 4), ("c1", "r2", True, -1, 1, 5)]


def test_report_round_trip(spark, tmp_path):
    kind = "cluster string, contig string, length int, numreads int, seq string, snps array<struct<pos:int,units:array<struct<individual:string,base:string,n:int,quals:array<int>>>>>"
    made = spark.createDataFrame([("Cluster_1", "contig1", 70, 4, "ACGTACGTAC" * 7, [(13, [("w", "C", 2, [28, 24]), ("w", "G", 2, [27, 27])])])], kind)
    (tmp_path / "r").write_text("".join(r.value + "\n" for r in text.report_text(made).collect()))
    got = text.read_report(spark, str(tmp_path / "r")).first()
    assert got.cluster == "Cluster_1" and tuple(got.contigs[0]) == ("contig1", 70, 4, "ACGTACGTAC" * 7)
    assert [(s.pos, [tuple(u) for u in s.units]) for s in got.snps] == [(13, [("w", "C", 2, [28, 24]), ("w", "G", 2, [27, 27])])]
    assert "[T]" in text.report_text(made, brackets=True).first().value.replace("\n", "")


def test_status_and_splitter(spark, tmp_path):
    (tmp_path / "s").write_text("kind: 454\nbinaries: /b\ngenome: 10\nruns: 1\nadded: 5\nused: 4\nx.sff\twatson\n")
    scalars, runs = text.read_status(spark, str(tmp_path / "s"))
    assert scalars["genome_size"] == "10" and rows(runs) == [("x.sff", "watson", 0)]
    many = spark.createDataFrame([(f"f{k}.sff", f"p{k % 3}", k) for k in range(500)], "run_file string, individual string, run_seq long").repartition(5)
    text.write_status(spark, scalars, many, str(tmp_path / "t"))
    again, listed = text.read_status(spark, str(tmp_path / "t"))
    assert again == scalars and rows(listed) == rows(many)
    (tmp_path / "d").write_text("a\nb\n-----\nc\n")
    assert [[r.line for r in x.orderBy("number").collect()] for x in text.split_at_dashes(spark, str(tmp_path / "d"))] == [["a", "b"], ["c"]]


def flow_reads(n, flows):
    rng = random.Random(n)
    return [{"read_id": f"read{k:03d}", "num_bases": 3 + k % 5, "clip_qual_left": 2, "clip_qual_right": 0, "clip_adapter_left": 0, "clip_adapter_right": 3, "flowgram": [rng.randrange(65536) for _ in range(flows)], "flow_index": [1] * (3 + k % 5), "bases": "ACGTACGT"[: 3 + k % 5], "quality": [40] * (3 + k % 5)} for k in range(n)]


def test_flowgram_round_trip(spark, tmp_path):
    made = flow_reads(30, 400)
    (tmp_path / "a.sff").write_bytes(sff.file_bytes(made, "TACG" * 100, "TCAG"))
    got = sorted((r.asDict() for r in sff.read_sff(spark, str(tmp_path / "a.sff")).drop("file").collect()), key=lambda r: r["read_id"])
    assert got == made
    head = sff.read_headers(spark, str(tmp_path / "a.sff")).first()
    assert (head.num_reads, head.num_flows_per_read, head.key_sequence) == (30, 400, "TCAG")
    sff.check_headers(sff.read_headers(spark, str(tmp_path / "a.sff")))
    wanted = spark.createDataFrame([("read003",), ("none",)], "read_id string")
    assert [r.read_id for r in sff.read_sff(spark, str(tmp_path / "a.sff"), wanted).collect()] == ["read003"]
    assert rows(sff.trimmed(sff.read_sff(spark, str(tmp_path / "a.sff"), wanted))) == [("read003", "CG", [40, 40])]


def test_flowgram_files_must_agree(spark, tmp_path):
    (tmp_path / "a.sff").write_bytes(sff.file_bytes(flow_reads(1, 12), "TACG" * 3, "TCAG"))
    with pytest.raises(ValueError, match="chemistry"):
        sff.check_headers(sff.read_headers(spark, str(tmp_path / "a.sff")))
    (tmp_path / "b.sff").write_bytes(b"nonsense" * 20)
    with pytest.raises(Exception, match="flowgram"):
        sff.read_sff(spark, str(tmp_path / "b.sff")).collect()


def test_flowgram_sink_and_index(spark, tmp_path):
    (tmp_path / "a.sff").write_bytes(sff.file_bytes(flow_reads(10, 400), "TACG" * 100, "TCAG"))
    reads = sff.read_sff(spark, str(tmp_path / "a.sff"))
    sff.write_sff(reads.drop("file").coalesce(1), str(tmp_path / "out"), "TACG" * 100)
    content = bytes(spark.read.parquet(str(tmp_path / "out")).first().content)
    assert sorted(r["read_id"] for r in sff.parse_reads(content)) == [f"read{k:03d}" for k in range(10)]
    spark.sql("drop table if exists read_index_test")
    sff.write_index(reads.select("read_id", "bases"), "read_index_test", 4)
    try:
        names = spark.createDataFrame([("read004",)], "read_id string")
        assert [r.read_id for r in sff.lookup(spark, "read_index_test", names).collect()] == ["read004"]
    finally:
        spark.sql("drop table read_index_test")
