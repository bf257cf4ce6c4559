"""A simulated genome with planted differences goes through a whole project."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from readweave import profiles
from readweave.operators.snps import Rules
from readweave.plans.project import Project
from readweave.profiles import Profile
from readweave.streaming.incremental import Gathered, add_runs, finish_runs, gather_runs

SMALL = Profile("454-transcript", False, 0, 13, 26, 40, 0.96, None, 60, True, 20, False, 0)
READS = "read_id string, seq string, qual array<int>, ord long"


def genome(n, seed=1):
    rng = random.Random(seed)
    return "".join(rng.choice("ACGT") for _ in range(n))


def run_of(spark, text, name, starts, size=120):
    made = [(f"{name}_{a}", text[a : a + size], [30] * size, k) for k, a in enumerate(starts)]
    return spark.createDataFrame(made, READS)


def planted(base, at):
    other = {"A": "C", "C": "A", "G": "T", "T": "G"}[base[at]]
    return base[:at] + other + base[at + 1 :]


@pytest.fixture(scope="module", autouse=True)
def small_profile():
    kept = profiles.PROFILES[SMALL.name]
    profiles.PROFILES[SMALL.name] = SMALL
    yield
    profiles.PROFILES[SMALL.name] = kept


@pytest.fixture(scope="module")
def made(spark, small_profile, tmp_path_factory):
    """A project of two individuals with two runs each, its genome and the other allele's."""
    base = genome(800)
    other = planted(base, 400)
    project = Project.create(spark, str(tmp_path_factory.mktemp("made") / "p"), SMALL, genome_size=800)
    project.add(run_of(spark, base, "a1", [340, 350, 100]), "a1", "ann")
    project.add(run_of(spark, base, "a2", [345, 360, 600]), "a2", "ann")
    project.add(run_of(spark, other, "b1", [342, 355]), "b1", "bob")
    project.add(run_of(spark, other, "b2", [348, 338]), "b2", "bob")
    return project, base, other


def test_planted_difference_is_found(made):
    project, base, other = made
    assert project.totals()["bases_added"] == 120 * 7
    members = project.table("members").where("cluster = 'a1_340'").select("read_id").collect()
    assert {r.read_id for r in members} == {"a1_340", "a2_345", "a2_360", "b1_342", "b1_355", "b2_348", "b2_338"}
    found = project.call_snps(rules=Rules(min_side=20, two_names=True)).collect()
    assert len(found) == 1
    row = found[0]
    start = base.find(row.seq.upper()[:30]) if base.find(row.seq.upper()[:30]) >= 0 else other.find(row.seq.upper()[:30])
    assert [start + p for p in row.good] == [400]
    assert {(u.individual, u.base) for s in row.snps for u in s.units} == {("ann", base[400]), ("bob", other[400])}


def test_removing_a_run(made):
    project, _, _ = made
    project.remove("b2")
    assert {r.run_id for r in project.table("runs").collect()} == {"a1", "a2", "b1"}
    assert project.table("members").where("read_id like 'b2%'").count() == 0
    assert project.table("clusters").where("cluster like 'b2%'").count() == 0


def test_runs_from_a_stream(spark, tmp_path):
    base = genome(400)
    project = Project.create(spark, str(tmp_path / "p"), SMALL, genome_size=400)
    kind = "run_id string, individual string, " + READS
    for k, (name, person) in enumerate((("r1", "ann"), ("r2", "bob"))):
        run_of(spark, base, name, [10 + k, 200]).select(F.lit(name).alias("run_id"), F.lit(person).alias("individual"), "read_id", "seq", "qual", "ord").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(kind).parquet(str(tmp_path / "in"))
    add_runs(stream, project, str(tmp_path / "ck")).awaitTermination()
    assert {r.run_id for r in project.table("runs").collect()} == {"r1", "r2"}
    add_runs(stream, project, str(tmp_path / "ck2")).awaitTermination()
    assert project.table("runs").count() == 2
    assert project.table("members").where("cluster = 'r1_10'").count() == 2
    with pytest.raises(ValueError, match="already"):
        project.add(run_of(spark, base, "r1", [10]), "r1", "ann")
    run_of(spark, base, "late", [30]).select(F.lit("r1").alias("run_id"), F.lit("ann").alias("individual"), "read_id", "seq", "qual", "ord").write.mode("append").parquet(str(tmp_path / "in"))
    with pytest.raises(Exception, match="came after"):
        add_runs(stream, project, str(tmp_path / "ck2")).awaitTermination()


def test_runs_in_several_batches(spark, tmp_path):
    """A run in three batches is added once the watermark is past it, as if it had come whole; restarts, repeats and late rows."""
    base = genome(600)
    kind = "run_id string, individual string, " + READS + ", at timestamp"
    delay = timedelta(minutes=10)

    def come(name, person, starts, minute):
        day = datetime(2024, 5, 1)
        rows = run_of(spark, base, name, starts).select(F.lit(name).alias("run_id"), F.lit(person).alias("individual"), "read_id", "seq", "qual", "ord", F.lit(day + timedelta(minutes=minute)).alias("at"))
        rows.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(kind).parquet(str(tmp_path / "in"))
        # each call is a restart of the same query
        gather_runs(stream, project, str(tmp_path / "ck"), delay).awaitTermination()
        return {r.run_id for r in project.table("runs").collect()}

    project = Project.create(spark, str(tmp_path / "p"), SMALL, genome_size=600)
    assert come("r 1/x", "ann", [10], 0) == set()
    assert come("r2", "bob", [15], 3) == set()
    assert come("r 1/x", "ann", [200], 5) == set()
    assert come("r 1/x", "ann", [30], 2) == set()  # out of order, within the delay
    assert come("r2", "bob", [40], 15) == set()
    assert come("r3", "ann", [300], 16) == {"r 1/x"}
    assert {r.read_id for r in project.table("reads").collect()} == {"r 1/x_10", "r 1/x_200", "r 1/x_30"}
    assert finish_runs(project, str(tmp_path / "ck")) == ["r2", "r3"]
    assert finish_runs(project, str(tmp_path / "ck")) == []
    whole = Project.create(spark, str(tmp_path / "w"), SMALL, genome_size=600)
    for name, person, starts in (("r 1/x", "ann", [10, 200, 30]), ("r2", "bob", [15, 40]), ("r3", "ann", [300])):
        whole.add(run_of(spark, base, name, starts), name, person)
    for table in ("members", "diffs", "blocks"):
        assert sorted(map(str, whole.table(table).collect())) == sorted(map(str, project.table(table).collect()))
    # a batch that comes again is written over itself and changes nothing
    gathered = Gathered(project, f"{tmp_path}/ck/gathered", delay)
    gathered.keep(run_of(spark, base, "r3", [300]).selectExpr("'r3' run_id", "'ann' individual", "*", "timestamp'2024-05-01 00:16:00' at"), 5)
    assert gathered.fold() == [] and project.table("runs").count() == 3
    with pytest.raises(Exception, match="came after"):
        come("r2", "bob", [50], 17)
    with pytest.raises(Exception, match="came after"):
        come("r4", "bob", [55], 18)
    assert project.table("reads").count() == 6
    other = Gathered(project, f"{tmp_path}/other", delay)
    other.keep(run_of(spark, base, "r9", [1]).selectExpr("'r9' run_id", "'ann' individual", "*", "cast(null as timestamp) at").union(run_of(spark, base, "r9", [2]).selectExpr("'r9'", "'bob'", "*", "cast(null as timestamp)")), 0)
    with pytest.raises(ValueError, match="more than one"):
        other.fold()
