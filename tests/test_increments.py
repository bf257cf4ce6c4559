"""Runs added as further parts: the same state as a whole update, bytes that follow the run, changes at once, outputs."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from readweave import cli, profiles
from readweave.operators import clusters as C
from readweave.plans.project import Project
from readweave.profiles import Profile
from readweave.sources import text

SMALL = Profile("454-transcript", False, 0, 13, 26, 40, 0.96, None, 60, True, 20, False, 0)
READS = "read_id string, seq string, qual array<int>, ord long"
VIEW = "cluster string, read_id string, individual string, ref string, tgt string, start int, n int"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_increments_equal_whole_updates(spark):
    rng = random.Random(5)
    names = [f"r{k}" for k in range(12)]
    state = C.templates(spark.createDataFrame([(n, "ACGT", "x", k) for k, n in enumerate(names)], "read_id string, seq string, individual string, ord long"))
    whole = log = state
    for turn, most in enumerate((6, 6, 4, 7)):
        made = []
        for _ in range(14):
            ref = "".join(rng.choices("ACGT", k=12))
            tgt = "".join(b if rng.random() < 0.8 else rng.choice("ACGT-N") for b in ref)
            made.append((rng.choice(names[: 6 + turn]), rng.choice(names), "x", ref, tgt, rng.randrange(3), 12))
        views = spark.createDataFrame(made, VIEW)
        whole = C.updated(whole, views, most)
        more = C.increment(log, views, most, every=True)
        gone = log.clusters.where("is_repeat").select("cluster").union(more.clusters).distinct()
        members = log.members.unionByName(more.members)
        log = C.State(
            log.clusters.withColumn("is_repeat", F.lit(False)).join(gone.withColumn("gone", F.lit(True)), "cluster", "left").select("cluster", "seq", F.coalesce("gone", F.lit(False)).alias("is_repeat"), "ord"),
            members.where("cluster <> read_id").join(gone, "cluster", "left_anti").unionByName(members.where("cluster = read_id")),
            log.diffs.unionByName(more.diffs).join(gone, "cluster", "left_anti").groupBy("cluster", "position", "reference", "target").agg(F.sum("reads").alias("reads")),
        )
        held = [[spark.createDataFrame(x.collect(), x.schema) for x in (s.clusters, s.members, s.diffs)] for s in (whole, log)]
        whole, log = (C.State(*x) for x in held)
        assert rows(whole.clusters) == rows(log.clusters) and rows(whole.members) == rows(log.members) and rows(whole.diffs) == rows(log.diffs)
    assert 0 < whole.clusters.where("is_repeat").count() < len(names)


@pytest.fixture
def small_profile():
    kept = profiles.PROFILES[SMALL.name]
    profiles.PROFILES[SMALL.name] = SMALL
    yield
    profiles.PROFILES[SMALL.name] = kept


def size(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


def test_project_grows_by_parts(spark, small_profile, tmp_path):
    rng = random.Random(1)
    base = "".join(rng.choices("ACGT", k=6000))

    def run(name, starts, n=120):
        return spark.createDataFrame([(f"{name}_{a}", base[a : a + n], [30] * n, k) for k, a in enumerate(starts)], READS)

    path = str(tmp_path / "p")
    project = Project.create(spark, path, SMALL, genome_size=6000, count_first_run=True)
    project.add(run("a", range(0, 5800, 10)), "a", "ann")
    first = size(path)
    project.add(run("b", [100, 2000]), "b", "bob")
    grown = size(path) - first
    assert grown < first / 2
    assert project.table("clusters").count() == 582 and project.table("reads").count() == 582
    assert {r.read_id for r in project.table("members").where("cluster = 'b_100'").collect()} == {"b_100", *(f"a_{a}" for a in range(50, 160, 10))}
    before = {t: rows(project.table(t)) for t in ("runs", "reads", "clusters", "members", "diffs", "blocks")}
    project.compact()
    assert {t: rows(project.table(t)) for t in before} == before
    # of two changes in one turn the first by name counts, and the other is told
    lines = project._lines()
    rival = f"{lines[-1][0] + 1:09d} snapshot-0 " + json.dumps(lines[-1][2])
    spark.createDataFrame([(rival,)], "value string").coalesce(1).write.mode("append").text(f"{path}/snapshots")
    seen = iter([lines])
    whole = project._lines
    project._lines = lambda: next(seen, None) or whole()
    with pytest.raises(RuntimeError, match="same time"):
        project._save({})
    assert whole()[-1][1] == "snapshot-0"


def test_outputs_and_verbs(spark, small_profile, tmp_path):
    rng = random.Random(9)
    base = "".join(rng.choices("ACGT", k=500))
    project = Project.create(spark, str(tmp_path / "p"), SMALL, genome_size=500)
    for name, person, starts in (("a", "ann", [100, 110]), ("b", "bob", [105, 120, 112])):
        made = [(f"{name}_{k}", base[k : k + 120], [30] * 120, n) for n, k in enumerate(starts)]
        project.add(spark.createDataFrame(made, READS), name, person)
    out = tmp_path / "out"
    for verb in ("clusters", "status", "assemble"):
        cli.main([verb, str(tmp_path / "p"), f"{out}/{verb}"])
    held = {r.cluster: r for r in text.read_clusters(spark, f"{out}/clusters").collect()}
    assert set(held) == {"a_100", "a_110", "b_105", "b_120", "b_112"} and held["a_100"].members[0].read_id == "a_100"
    assert {m.read_id for m in held["b_105"].members} == {"b_105", "a_100", "a_110"}
    scalars, runs = text.read_status(spark, f"{out}/status")
    assert scalars["runs"] == "2" and scalars["kind"] == SMALL.name and rows(runs.select("run_file", "individual")) == [("a", "ann"), ("b", "bob")]
    assert spark.read.parquet(f"{out}/assemble/contigs").columns == ["contig_id", "seq", "length"]
    cli.main(["call", str(tmp_path / "p"), f"{out}/call", "--report", f"{out}/report", "--brackets"])
    assert spark.read.parquet(f"{out}/call").count() == 0
    block = spark.createDataFrame([("c", 8, 4, "ACGTACGT", [3], [(3, [("ann", "T", 2, [30, 30])])])], "cluster string, length int, numreads long, seq string, good array<int>, snps array<struct<pos:int,units:array<struct<individual:string,base:string,n:int,quals:array<int>>>>>")
    project.report(block, f"{out}/text", brackets=True)
    assert "ACG[T]ACGT" in "".join(r.value for r in spark.read.text(f"{out}/text").collect())
