"""Command line: create, add, call, assemble, clusters, status, compact, remove."""

from __future__ import annotations

import argparse
import re

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from readweave.functions import sequence as S
from readweave.operators.reads import quality_offset
from readweave.plans.project import Project
from readweave.profiles import PROFILES
from readweave.sources import sff, sff_files, text


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="readweave", description=__doc__)
    verbs = parser.add_subparsers(dest="verb", required=True)
    for verb, more in (("create", ["profile"]), ("add", ["file", "individual"]), ("call", ["out"]), ("assemble", ["out"]), ("clusters", ["out"]), ("status", ["out"]), ("compact", []), ("remove", ["run"])):
        p = verbs.add_parser(verb)
        p.add_argument("project")
        for name in more:
            p.add_argument(name, **({"choices": sorted(PROFILES)} if name == "profile" else {}))
        if verb == "create":
            p.add_argument("--genome-size", type=int, default=3_000_000_000)
        if verb in ("call", "assemble"):
            p.add_argument("--mode", choices=["default", "strict", "short"], default="default")
        if verb == "call":
            p.add_argument("--report", help="also write the blocks as text to this folder")
            p.add_argument("--brackets", action="store_true", help="mark differences in the text's sequences")
    a = parser.parse_args(argv)
    spark = SparkSession.builder.appName("readweave").getOrCreate()
    if a.verb == "create":
        Project.create(spark, a.project, PROFILES[a.profile], a.genome_size)
        return
    project = Project(spark, a.project)
    if a.verb == "add":
        name = re.sub(r"\.(sff|fastq|fq)(\.gz)?$", "", a.file.rstrip("/").rsplit("/", 1)[-1])
        if a.file.endswith(".sff"):
            sff.check_headers(sff_files.headers(spark, a.file))
            run = sff.trimmed(sff_files.read_sff(spark, a.file)).withColumn("ord", F.monotonically_increasing_id())
        else:
            held = text.read_fastq(spark, a.file)
            run = held.select("read_id", "seq", S.phred_decode("qual_ascii", quality_offset(held)).alias("qual"), "ord")
        project.add(run, name, a.individual)
    elif a.verb == "remove":
        project.remove(a.run)
    elif a.verb == "compact":
        project.compact()
    elif a.verb == "status":
        project.status(a.out)
    elif a.verb == "clusters":
        project.cluster_text(a.out)
    elif a.verb == "assemble":
        contigs, lines, singletons = project.assemble(a.mode)
        contigs.write.parquet(f"{a.out}/contigs")
        lines.write.parquet(f"{a.out}/alignments")
        singletons.write.parquet(f"{a.out}/singletons")
    else:
        project.call_snps(a.mode).write.parquet(a.out)
        if a.report:
            project.report(spark.read.parquet(a.out), a.report, a.brackets)


if __name__ == "__main__":
    main()
