"""A project: runs added one by one, cluster state kept as logs, differences called from it.

State lives in a folder of Parquet tables. A table is a log of parts; a snapshot lists each table's parts, a line of
text. Adding a run writes the run's own rows and what its blocks add to clusters, so the bytes written follow the
run, not the project; removing one, or compact(), writes the tables anew. A line counts only once it is written, so a
failed step leaves the state before it; of two changes made at once one is kept and the other is told.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from readweave.functions import sequence as S
from readweave.operators import clusters as C
from readweave.operators import culling, kmers, layout, overlap, pileup, reads, snps
from readweave.operators.graph import components_of, greedy_cliques, short_components
from readweave.profiles import GENOME_454, PROFILES, Profile
from readweave.session import materialize
from readweave.sources import text

TABLES = {
    "runs": "run_id string, individual string, run_seq long, bases_added long, bases_used long, digest string",
    "reads": "run_id string, read_id string, individual string, seq string, qual array<int>, ord long, run_seq long",
    "repeats": "run_id string, read_id string, seq string",
    "clusters": "cluster string, seq string, is_repeat boolean, ord long",
    "members": "cluster string, read_id string, individual string",
    "diffs": "cluster string, position int, reference string, target string, reads long",
    "blocks": overlap.BLOCK,
    "collapsed": "cluster string",
}


def digest_of_reads() -> Column:
    """A number that tells sets of reads(read_id, seq) apart, whatever their order."""
    return F.sum(F.xxhash64("read_id", "seq").cast("decimal(38,0)")).cast("string")


class Project:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        values = json.loads("".join(r.value for r in spark.read.text(f"{path}/project").collect()))
        self.profile: Profile = PROFILES[values["profile"]]
        self.genome_size: int = values["genome_size"]
        self.count_first_run: bool = values["count_first_run"]

    @staticmethod
    def create(spark: SparkSession, path: str, profile: Profile = GENOME_454, genome_size: int = 3_000_000_000, count_first_run: bool = False) -> Project:
        values = {"profile": profile.name, "genome_size": genome_size, "count_first_run": count_first_run}
        spark.createDataFrame([(json.dumps(values),)], "value string").coalesce(1).write.text(f"{path}/project")
        made = Project(spark, path)
        made._save({name: spark.createDataFrame([], schema) for name, schema in TABLES.items()})
        return made

    def _lines(self) -> list[tuple[int, str, dict]]:
        """(turn, name, state) of all snapshots that count: of several lines of one turn the first by name."""
        held: dict[int, tuple[str, dict]] = {}
        for r in self.spark.read.text(f"{self.path}/snapshots").collect():  # a line a change
            turn, name, state = r.value.split(" ", 2)
            if int(turn) not in held or name < held[int(turn)][0]:
                held[int(turn)] = (name, json.loads(state))
        return sorted((turn, *x) for turn, x in held.items())

    def _log(self, name: str) -> DataFrame:
        parts = [f"{self.path}/{p}" for p in self._lines()[-1][2]["parts"][name]]
        return self.spark.read.schema(TABLES[name]).parquet(*parts)

    def table(self, name: str) -> DataFrame:
        """A table as it stands: members and differences of collapsed clusters are left out but for their seeds."""
        if name not in ("clusters", "members", "diffs"):
            return self._log(name)
        gone = self._log("collapsed").distinct()
        if name == "clusters":
            flagged = self._log("clusters").drop("is_repeat").join(gone.withColumn("is_repeat", F.lit(True)), "cluster", "left")
            return flagged.select("cluster", "seq", F.coalesce("is_repeat", F.lit(False)).alias("is_repeat"), "ord")
        log = self._log(name)
        if name == "members":
            own = log.where("cluster = read_id")
            return log.where("cluster <> read_id").join(gone, "cluster", "left_anti").unionByName(own).select("cluster", "read_id", "individual")
        return log.join(gone, "cluster", "left_anti").groupBy("cluster", "position", "reference", "target").agg(F.sum("reads").alias("reads"))

    def _save(self, tables: dict[str, DataFrame], add: bool = False, most: int | None = None) -> None:
        """A new snapshot: the tables given in place of those before, or as further parts of them."""
        try:
            lines = self._lines()
        except Exception as problem:
            if "PATH_NOT_FOUND" not in str(problem):
                raise
            lines = []
        turn = lines[-1][0] + 1 if lines else 0
        name = f"snapshot-{turn:06d}-{uuid.uuid4().hex[:8]}"
        before = lines[-1][2]["parts"] if lines else {}
        for table, frame in tables.items():
            frame.write.parquet(f"{self.path}/{name}/{table}")
        parts = {t: [*(before.get(t, []) if add or t not in tables else []), *([f"{name}/{t}"] if t in tables else [])] for t in TABLES}
        line = f"{turn:09d} {name} {json.dumps({'parts': parts, 'most': most})}"
        self.spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("append").text(f"{self.path}/snapshots")
        if self._lines()[-1][1] != name:
            raise RuntimeError("the project was changed by another at the same time; this change was not kept")

    def compact(self) -> None:
        """Write every table anew as one part."""
        tables = {t: self.table(t) for t in TABLES}
        collapsed = tables.pop("collapsed").distinct()
        self._save(tables | {"collapsed": collapsed}, most=self._lines()[-1][2]["most"])

    def totals(self) -> dict[str, int]:
        last = reads.run_totals(self.table("runs"), self.count_first_run).orderBy(F.desc("run_seq")).first()
        return {"bases_added": last.total_bases_added, "bases_used": last.total_bases_used} if last else {"bases_added": 0, "bases_used": 0}

    def prepared(self, run: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(reads to keep, repeats) of a run(run_id, read_id, seq, qual, ord, ...): clones go, repeats are masked and split off."""
        once = reads.drop_clones(run)
        if not self.profile.mask:
            return once, once.limit(0)
        total = reads.totals(once).first().total_bases
        k = S.kmer_size(total)
        counts = kmers.code_counts(once, k)
        cuts = kmers.cutoffs(counts).first().asDict()
        if not cuts["n_kmers"]:
            return once.where(F.length("seq") >= self.profile.min_length), once.limit(0)
        split = reads.split_repeats(kmers.masked(once, counts, cuts, k), self.profile.min_length)
        kept = split.where("verdict = 'kept'").drop("verdict").withColumn("qual", F.transform("qual", lambda q: q + self.profile.quality_bias))
        return kept, split.where("verdict = 'repeat'").drop("verdict")

    def add(self, run: DataFrame, run_id: str, individual: str) -> None:
        """Add a run of reads(read_id, seq, qual, ord): overlaps with all older runs update the clusters."""
        runs = self.table("runs")
        if runs.where(F.col("run_id") == run_id).count():
            raise ValueError(f"run {run_id} is in the project already")
        number = (runs.agg(F.max("run_seq")).first()[0] or 0) + 1
        named = run.select(F.lit(run_id).alias("run_id"), "read_id", F.lit(individual).alias("individual"), "seq", "qual", F.col("ord").cast("long").alias("ord"), F.lit(number).cast("long").alias("run_seq"))
        named = materialize(named, "run")
        kept, repeats = self.prepared(named)
        # written once: every table below is made from the kept reads and the blocks
        kept = materialize(kept.select([c.split(" ")[0] for c in TABLES["reads"].split(", ")]), "kept")
        added, used = reads.totals(named).first().total_bases, reads.totals(kept).first().total_bases
        digest = named.agg(digest_of_reads()).first()[0]
        runs = runs.unionByName(self.spark.createDataFrame([(run_id, individual, number, added, used, digest)], TABLES["runs"]))
        every = self.table("reads").unionByName(kept)
        fresh = C.templates(kept)
        state = C.State(*(self.table(t).unionByName(f) for t, f in (("clusters", fresh.clusters), ("members", fresh.members), ("diffs", fresh.diffs))))
        blocks = materialize(overlap.overlap_blocks(kept, self.table("reads"), self.profile), "blocks")
        counted = reads.run_totals(runs, self.count_first_run).orderBy(F.desc("run_seq")).first().total_bases_added
        most, before = S.max_hits(counted, self.genome_size, not self.profile.capped), self._lines()[-1][2]["most"]
        more = C.increment(state, C.sides(blocks, every, self.profile.overlap), most, every=before is not None and most < before)
        self._save({
            "runs": runs.where(F.col("run_seq") == number), "reads": kept, "repeats": repeats.select("run_id", "read_id", "seq"), "blocks": blocks,
            "clusters": fresh.clusters, "members": fresh.members.unionByName(more.members), "diffs": more.diffs, "collapsed": more.clusters,
        }, add=True, most=most)

    def remove(self, run_id: str) -> None:
        """Take a run out: its reads, the clusters they seed, their memberships; differences they brought stay."""
        gone = self.table("reads").where(F.col("run_id") == run_id).select("read_id")
        names = gone.select(F.col("read_id").alias("cluster"))
        blocks = self.table("blocks").join(gone.withColumnRenamed("read_id", "name1"), "name1", "left_anti").join(gone.withColumnRenamed("read_id", "name2"), "name2", "left_anti")
        self._save({
            "runs": self.table("runs").where(F.col("run_id") != run_id), "reads": reads.remove_run(self.table("reads"), run_id), "repeats": reads.remove_run(self.table("repeats"), run_id),
            "clusters": self.table("clusters").join(names, "cluster", "left_anti"), "members": self.table("members").join(names, "cluster", "left_anti").join(gone, "read_id", "left_anti").select("cluster", "read_id", "individual"),
            "diffs": self.table("diffs").join(names, "cluster", "left_anti"), "blocks": blocks.select(self.table("blocks").columns),
            "collapsed": self.table("collapsed").join(names, "cluster", "left_anti").distinct(),
        }, most=self._lines()[-1][2]["most"])

    def report(self, found: DataFrame, path: str, brackets: bool = False) -> None:
        """The blocks of call_snps as report text; brackets mark the differences in the sequence."""
        text.report_text(found.withColumn("contig", F.col("cluster")), brackets).write.text(path)

    def status(self, path: str) -> None:
        """The project's values and runs as a status file."""
        runs, totals = self.table("runs"), self.totals()
        values = {"kind": self.profile.name, "binaries": "-", "genome_size": self.genome_size, "runs": runs.count()} | totals
        text.write_status(self.spark, values, runs.select(F.col("run_id").alias("run_file"), "individual", "run_seq"), path)

    def cluster_text(self, path: str) -> None:
        """All clusters with their members and differences as cluster text."""
        members = self.table("members").groupBy("cluster").agg(F.sort_array(F.collect_list(F.struct((F.col("read_id") != F.col("cluster")).alias("later"), "read_id", "individual"))).alias("ms"))
        diffs = self.table("diffs").groupBy("cluster").agg(F.sort_array(F.collect_list(F.struct("position", "reference", "target", "reads"))).alias("diffs"))
        none = F.expr("cast(array() as array<struct<position:int,reference:string,target:string,reads:bigint>>)")
        joined = self.table("clusters").join(members, "cluster").join(diffs, "cluster", "left").withColumn("diffs", F.coalesce("diffs", none))
        text.write_clusters(joined.select("cluster", "seq", "is_repeat", F.transform("ms", lambda m: F.struct(m["read_id"].alias("read_id"), m["individual"].alias("individual"))).alias("members"), "diffs"), path)

    def assemble(self, mode: str = "default") -> tuple[DataFrame, DataFrame, DataFrame]:
        """(contigs, alignment lines, singletons) of the selected clusters, without a search for differences."""
        selected = materialize(self.selected(mode), "selected")
        placement, seen = self.observations(selected)
        seen = materialize(seen, "observations")
        lying = seen.groupBy("contig_id", "read_id").agg(F.min("pos").alias("offset"), F.array_sort(F.collect_list(F.struct("pos", "base"))).alias("cs"))
        lines = lying.select("contig_id", "read_id", F.concat(F.expr("repeat(' ', offset)"), F.array_join(F.transform("cs", lambda x: x["base"]), "")).alias("line"))
        return pileup.contigs(pileup.consensus(seen)), lines, pileup.singletons(selected, placement)

    def selected(self, mode: str = "default") -> DataFrame:
        """(cluster, read_id): the reads of each cluster to assemble. mode: default (disjoint), strict (cliques), short."""
        people = self.table("runs").select("individual").distinct().count()
        members, state = self.table("members"), self.table("clusters")
        chosen = C.good(members.join(state.where("not is_repeat"), "cluster", "left_semi"), self.table("diffs"), people)
        if self.profile.fishing:
            own = members.join(chosen, "cluster", "left_semi").select("cluster", F.col("read_id").alias("member"))
            found = culling.fished(own, state.where("is_repeat").select(F.col("cluster").alias("id")))
            held = found.select(F.col("component").alias("cluster"), F.col("node").alias("read_id"))
        else:
            repeats = self.table("repeats").select("read_id", "seq", F.lit(0).cast("long").alias("run_seq"))
            seeds = state.join(chosen, "cluster", "left_semi").select(F.col("cluster").alias("read_id"), "seq", F.lit(1).cast("long").alias("run_seq"))
            left = C.without_repeats(chosen, overlap.overlap_blocks(seeds, repeats, self.profile))
            held = members.join(left, "cluster", "left_semi").select("cluster", "read_id")
        if mode == "default":
            order = held.join(state.select("cluster", "ord"), "cluster", "left").select("cluster", F.coalesce("ord", F.lit(0)).alias("ord"), F.col("read_id").alias("member"), F.when(F.col("read_id") == F.col("cluster"), 0).otherwise(1).alias("place"))
            return held.join(culling.disjoint(order), "cluster", "left_semi")
        edges = held.where("cluster <> read_id").select(F.col("cluster").alias("src"), F.col("read_id").alias("dst"))
        nodes = held.select(F.col("cluster").alias("id")).unionByName(held.select(F.col("read_id").alias("id")))
        labels = components_of(nodes, edges)
        if mode == "short":
            return short_components(labels).select(F.col("component").alias("cluster"), F.col("node").alias("read_id"))
        return greedy_cliques(labels, edges).select(F.col("clique").alias("cluster"), F.col("node").alias("read_id"))

    def observations(self, selected: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(placement, observations) of the selected reads, laid out along each cluster's seed: with gaps, a base a column,
        where differences are searched by gap alternation, else by offsets."""
        chosen = selected.select("cluster").distinct()
        wanted = selected.select(F.col("cluster").alias("contig_id"), "read_id")
        if not self.profile.gaps:
            placement = pileup.star_placement(self.table("blocks"), chosen, self.table("clusters"))
            placement = placement.join(wanted, ["contig_id", "read_id"], "left_semi")
            return placement, pileup.observations(placement, self.table("reads"))
        seeds = chosen.join(wanted.where("contig_id = read_id").select(F.col("contig_id").alias("cluster")), "cluster", "left_semi")
        aligned = layout.best_alignments(self.table("blocks"), chosen).join(wanted, ["contig_id", "read_id"], "left_semi")
        placement = aligned.select("contig_id", "read_id").unionByName(seeds.select(F.col("cluster").alias("contig_id"), F.col("cluster").alias("read_id")))
        return placement, layout.observations(aligned, seeds, self.table("reads"), one_base=True)

    def call_snps(self, mode: str = "default", rules: snps.Rules | None = None) -> DataFrame:
        """(cluster, length, numreads, seq, good, snps): clusters with accepted differences, and their profiles.

        Differences are columns of two bases, or, for the 454 profiles, alternations of gaps.
        """
        people = self.table("runs").select("individual").distinct().count()
        rules = rules or snps.Rules(min_side=self.profile.min_side, two_names=people > 1)
        placement, seen = self.observations(materialize(self.selected(mode), "selected"))
        seen = materialize(seen, "observations")
        columns = pileup.consensus(seen)
        if self.profile.gaps:
            found = materialize(snps.gap_snps(seen, columns), "alternations")
            columns = snps.rewritten(columns, found)
            units = snps.pooled_units(seen, found).select(F.col("contig_id").alias("cluster"), F.col("site").alias("pos"), "individual", "base", "n", "quals")
        else:
            places = pileup.ungapped(columns).select("contig_id", "pos", "at")
            profiles = pileup.profiles(seen, pileup.interesting(pileup.column_counts(seen)))
            units = profiles.join(places, ["contig_id", "pos"]).select(F.col("contig_id").alias("cluster"), F.col("at").alias("pos"), "individual", "base", "n", "quals")
        numbers = placement.groupBy("contig_id").agg(F.count(F.lit(1)).alias("numreads"))
        blocks = pileup.contigs(columns).join(numbers, "contig_id").select(F.col("contig_id").alias("cluster"), F.lit(1).alias("n_contigs"), "numreads", "length", "seq")
        found = snps.accepted(blocks, units, rules)
        listed = units.groupBy("cluster", "pos").agg(F.array_sort(F.collect_list(F.struct("individual", "base", "n", "quals"))).alias("units"))
        per = listed.groupBy("cluster").agg(F.array_sort(F.collect_list(F.struct("pos", "units"))).alias("snps"))
        return found.join(per, "cluster").select("cluster", "length", "numreads", "seq", "good", "snps")
