"""Readers and writers of the text formats: FASTA, FASTQ, quality text, clusters, alignments, reports, status.

Readers split files on record marks inside Spark (lineSep), so a file's records are read in parallel where the
format allows, and headers, lines and fields are taken apart by column functions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from readweave.functions import sequence as S


def _records(spark: SparkSession, path: str, mark: str, glob: str | None = None) -> DataFrame:
    """(value, run_file): the stretches of text between marks."""
    reader = spark.read.option("lineSep", mark)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.text(path).select("value", F.element_at(F.split(F.input_file_name(), "/"), -1).alias("run_file"), F.monotonically_increasing_id().alias("ord"))


def _marked(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Records that begin with > at the beginning of a line, without it; a > inside a line is part of it."""
    record = _records(spark, path, "\n>", glob).withColumn("value", F.regexp_replace("value", r"^\s*>", ""))
    return record.where(F.trim("value") != "")


def read_fasta(spark: SparkSession, path: str, whole_header: bool = False, glob: str | None = None) -> DataFrame:
    """(read_id, header, seq, run_file, ord) of > records; other than IUPAC letters are dropped from sequences.

    read_id is the header's first token, or all of it with whole_header. glob picks files of a folder.
    """
    record = _marked(spark, path, glob)
    header = F.regexp_extract("value", r"^([^\r\n]*)", 1)
    seq = S.only_iupac(F.regexp_replace("value", r"^[^\r\n]*", ""))
    return record.select((header if whole_header else S.first_token(header)).alias("read_id"), header.alias("header"), seq.alias("seq"), "run_file", "ord")


def write_fasta(reads: DataFrame, path: str, width: int = 60) -> None:
    """> records wrapped at width without gaps."""
    reads.select(F.concat(F.lit(">"), "read_id", F.lit("\n"), S.wrap(F.col("seq"), width)).alias("value")).write.text(path)


def read_quality_text(spark: SparkSession, path: str) -> DataFrame:
    """(read_id, qual array<int>) of > records of space-separated numbers."""
    record = _marked(spark, path)
    numbers = F.trim(F.regexp_replace(F.regexp_replace("value", r"^[^\r\n]*", ""), r"\s+", " "))
    qual = F.when(numbers == "", F.expr("cast(array() as array<int>)")).otherwise(F.split(numbers, " ").cast("array<int>"))
    return record.select(S.first_token(F.col("value")).alias("read_id"), qual.alias("qual"))


def write_quality_text(reads: DataFrame, path: str) -> None:
    reads.select(F.concat(F.lit(">"), "read_id", F.lit("\n"), F.array_join(F.col("qual").cast("array<string>"), " ")).alias("value")).write.text(path)


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, number, value): lines with their number in the file, from 0, however the file is split.

    Lines are numbered inside each split; splits learn from the sizes of those before them, one small row each, which are sent
    to the lines: a shuffle by split would gather each split's lines in one task.
    """
    at = F.monotonically_increasing_id()
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), at.alias("id"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = lines.groupBy("file", "block").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    sizes = sizes.select("file", "block", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    return lines.join(F.broadcast(sizes), ["file", "block"]).select("file", (F.col("offset") + F.col("id") - F.col("first")).alias("number"), "value")


def read_fastq(spark: SparkSession, path: str) -> DataFrame:
    """(read_id, seq, qual_ascii, file, ord) of strict four-line records; a broken record fails the query.

    Names of several tokens are joined with colons; sequences are upper-cased.
    """
    line = lambda k: F.max(F.when(F.col("number") % 4 == k, F.regexp_replace("value", r"\r$", ""))).alias(f"l{k}")
    rows = numbered_lines(spark, path).groupBy("file", F.floor(F.col("number") / 4).alias("ord")).agg(*map(line, range(4)))
    ok = F.col("l0").startswith("@") & F.col("l1").rlike("^[acgtnACGTN.]*$") & F.col("l2").startswith("+") & (F.length("l1") == F.length("l3"))
    seq = F.when(ok, F.upper("l1")).otherwise(F.raise_error(F.concat(F.lit("broken FASTQ record "), F.col("ord").cast("string"))))
    return rows.select(S.joined_name(F.expr("substring(l0, 2)")).alias("read_id"), seq.alias("seq"), F.col("l3").alias("qual_ascii"), "file", "ord")


def write_fastq(reads: DataFrame, path: str, offset: int = 33) -> None:
    """Four-line records. The format has no null: reads without a name, sequence or qualities are left out, since a blank line would
    break the records after it."""
    held = reads.dropna(subset=["read_id", "seq", "qual"])
    held.select(F.concat(F.lit("@"), "read_id", F.lit("\n"), "seq", F.lit("\n+\n"), S.phred_encode(F.col("qual"), offset)).alias("value")).write.text(path)


def read_clusters(spark: SparkSession, path: str) -> DataFrame:
    """(cluster, seq, is_repeat, members, diffs) of cluster text: a > line, the sequence (after ?? for a repeat),
    read and individual by tab, then lines of a space and position, reference, target, reads; a blank line."""
    lines = F.filter(F.split("value", r"\r?\n"), lambda x: F.trim(x) != "")
    rows = spark.read.option("lineSep", "\n\n").text(path).select(lines.alias("l")).where(F.size("l") >= 2)
    rest = F.slice("l", 3, F.greatest(F.size("l") - 2, F.lit(0)))
    members = F.transform(F.filter(rest, lambda x: ~x.startswith(" ")), lambda x: F.struct(F.split(x, "\t")[0].alias("read_id"), F.get(F.split(x, "\t"), F.lit(1)).alias("individual")))
    part = lambda x, k: F.get(F.split(F.trim(x), r"\s+"), F.lit(k))
    diffs = F.transform(
        F.filter(rest, lambda x: x.startswith(" ")),
        lambda x: F.struct(part(x, 0).cast("int").alias("position"), part(x, 1).alias("reference"), part(x, 2).alias("target"), part(x, 3).cast("int").alias("reads")),
    )
    seq = F.col("l")[1]
    return rows.select(F.regexp_replace(F.col("l")[0], "^>", "").alias("cluster"), F.regexp_replace(seq, r"^\?\?", "").alias("seq"), seq.startswith("??").alias("is_repeat"), members.alias("members"), diffs.alias("diffs"))


def cluster_text(clusters: DataFrame) -> DataFrame:
    """(value): one text record for each cluster; a repeat keeps its seed only and no differences."""
    seq = F.when(F.col("is_repeat"), F.concat(F.lit("??"), "seq")).otherwise(F.col("seq"))
    members = F.when(F.col("is_repeat"), F.slice("members", 1, 1)).otherwise(F.col("members"))
    member_lines = F.transform(members, lambda m: F.concat(m["read_id"], F.lit("\t"), m["individual"]))
    diff_lines = F.transform("diffs", lambda d: F.concat_ws(" ", F.lit(""), d["position"].cast("string"), d["reference"], d["target"], d["reads"].cast("string")))
    shown = F.when(F.col("is_repeat"), F.expr("cast(array() as array<string>)")).otherwise(diff_lines)
    return clusters.select(F.concat(F.array_join(F.concat(F.array(F.concat(F.lit(">"), "cluster"), seq), member_lines, shown), "\n"), F.lit("\n")).alias("value"))


def write_clusters(clusters: DataFrame, path: str) -> None:
    cluster_text(clusters).write.text(path)


def read_names(clusters: DataFrame) -> DataFrame:
    """(read_id): distinct names of members that an assembly needs."""
    return clusters.select(F.explode("members").alias("m")).select(F.col("m.read_id").alias("read_id")).distinct()


def read_maf(spark: SparkSession, path: str) -> DataFrame:
    """Alignment blocks of MAF text: (score, name1, s1, o1, strand1, len1, aln1, name2, ..., aln2)."""
    lines = F.filter(F.split("value", r"\r?\n"), lambda x: x.startswith("s "))
    rows = spark.read.option("lineSep", "\na ").text(path).select(S.key_int(F.col("value"), "score").alias("score"), lines.alias("l")).where(F.size("l") == 2)
    out = ["score"]
    for side in (1, 2):
        f = F.split(F.col("l")[side - 1], r"\s+")
        out += [f[1].alias(f"name{side}"), f[2].cast("int").alias(f"s{side}"), f[3].cast("int").alias(f"o{side}"), f[4].alias(f"strand{side}"), f[5].cast("int").alias(f"len{side}"), f[6].alias(f"aln{side}")]
    return rows.select(*out)


def maf_text(blocks: DataFrame) -> DataFrame:
    side = lambda k: F.concat_ws(" ", F.lit("s"), f"name{k}", F.col(f"s{k}").cast("string"), F.col(f"o{k}").cast("string"), f"strand{k}", F.col(f"len{k}").cast("string"), f"aln{k}")
    return blocks.select(F.concat(F.lit("\na score="), F.col("score").cast("string"), F.lit("\n"), side(1), F.lit("\n"), side(2)).alias("value"))


def read_ace(spark: SparkSession, path: str) -> DataFrame:
    """(contig_id, consensus, base_quality, read_id, complement, offset, gapped, begin, end) of ACE text.

    offset is 0-based; gaps are *; begin and end bound the aligned clear range in the read as it lies, end
    exclusive. Accessions are cut at the first dot or underscore.
    """
    contig = spark.read.option("lineSep", "\nCO ").text(path).where(~F.col("value").startswith("AS ") & (F.trim("value") != ""))
    body = contig.select(S.first_token(F.col("value")).alias("contig_id"), F.split("value", r"(?:^|\n)(?=BQ|AF |BS |RD |QA |DS )").alias("parts"))
    consensus = F.regexp_replace(F.regexp_replace(F.col("parts")[0], r"^[^\n]*\n", ""), r"\s", "")
    bq = F.get(F.filter("parts", lambda p: p.startswith("BQ")), F.lit(0))
    af = F.transform(F.filter("parts", lambda p: p.startswith("AF ")), lambda p: F.split(F.trim(p), r"\s+"))
    rd = F.filter("parts", lambda p: p.startswith("RD "))
    qa = F.filter("parts", lambda p: p.startswith("QA "))
    each = body.select("contig_id", consensus.alias("consensus"), F.split(F.trim(F.regexp_replace(bq, r"BQ\s*|\s+", " ")), r"\s+").cast("array<int>").alias("base_quality"), F.posexplode(F.arrays_zip(af.alias("af"), rd.alias("rd"), qa.alias("qa"))).alias("k", "x"))
    name = F.col("x.af")[1]
    q = F.split(F.trim(F.col("x.qa")), r"\s+")
    gapped = F.regexp_replace(F.regexp_replace(F.col("x.rd"), r"^[^\n]*\n", ""), r"\s", "")
    return each.select(
        "contig_id", "consensus", "base_quality", S.accession(name).alias("read_id"), (F.col("x.af")[2] == "C").alias("complement"),
        (F.col("x.af")[3].cast("int") - 1).alias("offset"), gapped.alias("gapped"), (q[3].cast("int") - 1).alias("begin"), q[4].cast("int").alias("end"),
    )


def read_afg(spark: SparkSession, path: str) -> DataFrame:
    """(contig_id, read_id, complement, offset, begin, end) of AMOS text: tiles of contigs with their reads' names.

    begin > end in a clear range means a reversed read. A read number that occurs twice drops the file's contigs.
    """
    blocks = spark.read.option("lineSep", "\n}\n").text(path).select("value", F.input_file_name().alias("file"))
    field = lambda c, k: F.regexp_extract(c, rf"(?m)^{k}:\s*(.*)$", 1)
    reads = blocks.where(F.col("value").rlike(r"^\s*\{RED")).select("file", field(F.col("value"), "iid").alias("iid"), S.first_token(field(F.col("value"), "eid")).alias("read_id"))
    once = reads.groupBy("file", "iid").agg(F.count(F.lit(1)).alias("n"), F.min("read_id").alias("read_id"))
    broken = once.where("n > 1").select("file").distinct()
    # tiles are nested blocks, so a contig's block ends with its first tile and later tiles follow as blocks
    numbered = blocks.withColumn("o", F.monotonically_increasing_id())
    w = Window.partitionBy("file").orderBy("o").rowsBetween(Window.unboundedPreceding, 0)
    marked = numbered.withColumn("contig_id", F.last(F.when(F.col("value").rlike(r"^\s*\{CTG"), field(F.col("value"), "eid")), True).over(w))
    tiles = marked.where(F.col("value").contains("{TLE")).select(
        "file", "contig_id", field(F.col("value"), "src").alias("iid"), field(F.col("value"), "off").cast("int").alias("offset"), F.split(field(F.col("value"), "clr"), ",").cast("array<int>").alias("clr")
    )
    joined = tiles.join(once.where("n = 1"), ["file", "iid"]).join(broken, "file", "left_anti")
    a, b = F.col("clr")[0], F.col("clr")[1]
    return joined.select("contig_id", "read_id", (b < a).alias("complement"), "offset", F.least(a, b).alias("begin"), F.greatest(a, b).alias("end"))


def read_status_table(spark: SparkSession, path: str) -> DataFrame:
    """(accession, status) of a tab-separated read-status table with a header line."""
    return spark.read.option("sep", "\t").csv(path).where(F.col("_c0") != "Accno").select(S.accession(F.col("_c0")).alias("accession"), F.col("_c1").alias("status"))


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """(cluster, contigs, snps) of blank-line separated report blocks.

    contigs: name, length, numreads, seq; snps: pos and units (individual, base, n, quals).
    """
    lines = F.filter(F.split("value", r"\r?\n"), lambda x: F.trim(x) != "")
    rows = spark.read.option("lineSep", "\n\n").text(path).select(lines.alias("l")).where(F.size("l") >= 1)
    heads = F.filter(F.sequence(F.lit(1), F.size("l") - 1), lambda k: F.col("l")[k].startswith(">"))
    snp_lines = F.filter("l", lambda x: x.rlike(r"^\d+\s+\d+\s"))
    body = F.filter("l", lambda x: ~x.startswith(">") & ~x.rlike(r"^\d+\s+\d+\s"))
    unit = lambda u: F.struct(
        F.regexp_extract(u, r"^(.*):([ACGT])=", 1).alias("individual"),
        F.regexp_extract(u, r":([ACGT])=", 1).alias("base"),
        F.regexp_extract(u, r"=(\d+)", 1).cast("int").alias("n"),
        F.split(F.regexp_extract(u, r"\(([^)]*)\)", 1), ",").cast("array<int>").alias("quals"),
    )
    snps = F.transform(snp_lines, lambda x: F.struct(F.split(x, r"\s+")[0].cast("int").alias("pos"), F.transform(F.filter(F.split(x, r"\s+"), lambda u: u.contains("=")), unit).alias("units")))
    contigs = F.transform(heads, lambda k: F.struct(S.first_token(F.col("l")[k]).alias("name"), S.key_int(F.col("l")[k], "length").alias("length"), S.key_int(F.col("l")[k], "numreads").alias("numreads"), F.array_join(body, "").alias("seq")))
    return rows.where(F.size("l") > 1).select(S.first_token(F.col("l")[0]).alias("cluster"), contigs.alias("contigs"), snps.alias("snps"))


def report_text(blocks: DataFrame, brackets: bool = False) -> DataFrame:
    """(value): report blocks of blocks(cluster, contig, length, numreads, seq, snps)."""
    unit = lambda u: F.concat(u["individual"], F.lit(":"), u["base"], F.lit("="), u["n"].cast("string"), F.lit("("), F.array_join(u["quals"].cast("array<string>"), ","), F.lit(")"))
    line = F.transform("snps", lambda s: F.concat_ws("\t", s["pos"].cast("string"), (s["pos"] + 1).cast("string"), F.array_join(F.transform(s["units"], unit), " ")))
    seq = F.col("seq")
    if brackets:
        seq = F.array_join(F.transform(F.split("seq", ""), lambda c, i: F.when(F.exists("snps", lambda s: s["pos"] == i), F.concat(F.lit("["), c, F.lit("]"))).otherwise(c)), "")
    head = F.concat(F.lit(">"), "contig", F.lit("  length="), F.col("length").cast("string"), F.lit("  numreads="), F.col("numreads").cast("string"))
    return blocks.select(F.concat(F.array_join(F.concat(F.array(F.concat(F.lit(">"), "cluster"), head, S.wrap(seq)), line), "\n"), F.lit("\n")).alias("value"))


#: Values of a status file, a line each.
STATUS = ("kind", "binaries", "genome_size", "runs", "bases_added", "bases_used")


def read_status(spark: SparkSession, path: str) -> tuple[dict[str, str], DataFrame]:
    """Scalars and runs(run_file, individual, run_seq) of a project status file: six lines of values, then runs."""
    lines = numbered_lines(spark, path)
    head = [r.value for r in lines.where(F.col("number") < len(STATUS)).orderBy("number").collect()]
    scalars = dict(zip(STATUS, (x.split(":", 1)[-1].strip() for x in head), strict=False))
    field = F.split("value", "\t")
    runs = lines.where((F.col("number") >= len(STATUS)) & F.col("value").contains("\t"))
    return scalars, runs.select(field[0].alias("run_file"), field[1].alias("individual"), (F.col("number") - len(STATUS)).cast("long").alias("run_seq"))


def write_status(spark: SparkSession, scalars: dict[str, object], runs: DataFrame, path: str) -> None:
    """A project status file as read_status reads it: six lines of values, then a line for each run in order of run_seq."""
    head = spark.createDataFrame([(k - len(STATUS), f"{name}: {scalars.get(name, '')}") for k, name in enumerate(STATUS)], "number long, value string")
    body = runs.select(F.col("run_seq").alias("number"), F.concat_ws("\t", "run_file", "individual").alias("value"))
    # one row for each run of a project, written in order into one file
    head.unionByName(body).coalesce(1).sortWithinPartitions("number").select("value").write.text(path)


def split_at_dashes(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(file, number, line) before and after the first line of dashes of each file; without one all are before."""
    lines = numbered_lines(spark, path)
    cut = lines.where(F.col("value").rlike(r"^-{5,}\s*$")).groupBy("file").agg(F.min("number").alias("cut"))
    marked = lines.join(cut, "file", "left").select("file", "number", F.col("value").alias("line"), "cut")
    return marked.where("cut is null or number < cut").drop("cut"), marked.where("number > cut").drop("cut")
