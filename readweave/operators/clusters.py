"""Read clusters: templates, update from overlap blocks, repeat collapse, selection, repeat removal.

State is kept in normal form: clusters(cluster, seq, is_repeat, ord), members(cluster, read_id, individual) and
diffs(cluster, position, reference, target, reads). Everything is set-valued, so the order of blocks and runs
does not matter.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from readweave.session import materialize, partitions_for

#: Fixed value: differences over which a cluster collapses.
MOST_DIFFS = 15
#: Views of a cluster over which its differences are added up in many tasks before they meet in one.
CROWD = 1 << 20


@dataclass
class State:
    clusters: DataFrame
    members: DataFrame
    diffs: DataFrame


def templates(reads: DataFrame) -> State:
    """A cluster for each read, with itself as the only member."""
    spark = reads.sparkSession
    clusters = reads.select(F.col("read_id").alias("cluster"), "seq", F.lit(False).alias("is_repeat"), "ord")
    members = reads.select(F.col("read_id").alias("cluster"), "read_id", "individual")
    diffs = spark.createDataFrame([], "cluster string, position int, reference string, target string, reads long")
    return State(clusters, members, diffs)


def both_sides(blocks: DataFrame, least: int) -> DataFrame:
    """Both views of each block over least: (cluster, read_id, ref, tgt, start, n)."""
    kept = blocks.where((F.col("o1") > least) & (F.col("o2") > least))
    one = kept.select(F.col("name2").alias("cluster"), F.col("name1").alias("read_id"), F.col("aln2").alias("ref"), F.col("aln1").alias("tgt"), F.col("s2").alias("start"), F.col("o2").alias("n"))
    two = kept.select(F.col("name1").alias("cluster"), F.col("name2").alias("read_id"), F.col("aln1").alias("ref"), F.col("aln2").alias("tgt"), F.col("s1").alias("start"), F.col("o1").alias("n"))
    return one.unionByName(two)


def sides(blocks: DataFrame, individuals: DataFrame, least: int) -> DataFrame:
    """both_sides with the reads' individuals."""
    return both_sides(blocks, least).join(individuals.select("read_id", "individual"), "read_id")


def block_diffs(views: DataFrame, crowd: int | None = None) -> DataFrame:
    """(cluster, position, reference, target, reads): columns that differ, both unmasked and neither N; gaps count.

    position is the start plus the alignment column; each block counts once. A view makes many rows that hardly ever
    repeat within a task, so with crowd, which goes over the views once more, they are shuffled by cluster, not those rows. Only in
    clusters of over crowd views, of which there are few, are the rows added up before the shuffle.
    """
    if crowd is None:
        return _summed(views)
    views = views.select("cluster", "start", "n", "ref", "tgt")
    counts = views.groupBy("cluster").agg(F.count(F.lit(1)).alias("views"))
    total, most = counts.agg(F.sum("views"), F.max("views")).first()
    n = partitions_for(views.sparkSession, total or 0)
    if (most or 0) <= crowd:
        return _summed(views.repartition(n, "cluster"))
    crowded = F.broadcast(counts.where(F.col("views") > crowd).select("cluster"))
    # no cluster is in both parts
    return _summed(views.join(crowded, "cluster", "left_anti").repartition(n, "cluster")).unionByName(_summed(views.join(crowded, "cluster", "left_semi")))


def _summed(views: DataFrame) -> DataFrame:
    masked = lambda c: c.rlike("[a-z]")
    pairs = F.zip_with(F.split(F.expr("substring(ref, 1, n)"), ""), F.split(F.expr("substring(tgt, 1, n)"), ""), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    numbered = F.transform(pairs, lambda x, i: F.struct(i.alias("i"), x["a"].alias("a"), x["b"].alias("b")))
    # only columns that differ become rows: a few in a hundred of an alignment
    apart = F.filter(numbered, lambda x: (x["a"] != x["b"]) & (x["a"] != "N") & (x["b"] != "N") & (x["a"] != "") & (x["b"] != "") & ~masked(x["a"]) & ~masked(x["b"]))
    each = views.select("cluster", "start", F.explode(apart).alias("c"))
    named = each.select("cluster", (F.col("start") + F.col("c.i")).alias("position"), F.col("c.a").alias("reference"), F.col("c.b").alias("target"))
    return named.groupBy("cluster", "position", "reference", "target").agg(F.count(F.lit(1)).alias("reads"))


def updated(state: State, views: DataFrame, max_hits: int) -> State:
    """State after the views of new blocks. A cluster of more than max_hits members or MOST_DIFFS differences
    collapses to its seed, for good.

    Differences are looked for only where members, which are fewer, have not settled that a cluster collapses. Members, differences and
    names of collapsed clusters are written, since the state goes over each several times.
    """
    members = materialize(state.members.unionByName(views.select("cluster", "read_id", "individual")).distinct(), "members")
    many = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > max_hits).select("cluster")
    settled = materialize(state.clusters.where("is_repeat").select("cluster").unionByName(many).distinct(), "settled")
    live = materialize(views.select("cluster", "start", "n", "ref", "tgt").join(settled, "cluster", "left_anti"), "live-views")
    held = state.diffs.join(settled, "cluster", "left_anti").unionByName(block_diffs(live, CROWD))
    diffs = materialize(held.groupBy("cluster", "position", "reference", "target").agg(F.sum("reads").alias("reads")), "diffs")
    apart = diffs.groupBy("cluster").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > MOST_DIFFS).select("cluster")
    flagged = materialize(settled.unionByName(apart).distinct(), "collapsed").withColumn("flagged", F.lit(True))
    clusters = state.clusters.join(flagged, "cluster", "left").withColumn("is_repeat", F.coalesce("flagged", F.lit(False))).drop("flagged").select(state.clusters.columns)
    names = flagged.select("cluster")
    kept = members.join(names, "cluster", "left_anti").unionByName(members.where("cluster = read_id").join(names, "cluster", "left_semi"))
    return State(clusters, kept, diffs.join(names, "cluster", "left_anti"))


def increment(state: State, views: DataFrame, max_hits: int, every: bool = False) -> State:
    """What the views of new blocks add to a state: new members, new difference counts, and as clusters those that collapse now.

    Only clusters that the views touch are looked at, unless every says that all have to be measured by max_hits again. A
    state with these rows beside its own, members and differences of collapsed clusters but their seeds left out, is what updated() gives.
    """
    gone = state.clusters.where("is_repeat").select("cluster")
    live = views.join(gone, "cluster", "left_anti")
    touched = live.select("cluster").distinct()
    near = (lambda df: df.join(gone, "cluster", "left_anti")) if every else (lambda df: df.join(touched, "cluster", "left_semi"))
    held, known = near(state.members), near(state.diffs)
    fresh = live.select("cluster", "read_id", "individual").distinct().join(held, ["cluster", "read_id"], "left_anti")
    diffs = block_diffs(live)
    many = held.select("cluster").unionAll(fresh.select("cluster")).groupBy("cluster").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > max_hits)
    keys = ["cluster", "position", "reference", "target"]
    apart = known.select(keys).unionByName(diffs.select(keys)).distinct().groupBy("cluster").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > MOST_DIFFS)
    return State(many.select("cluster").union(apart.select("cluster")).distinct(), fresh, diffs)


def good(members: DataFrame, diffs: DataFrame, individuals: int) -> DataFrame:
    """(cluster): one or two substitutions at least 40 apart, at least 4 members, a difference other than a gap
    seen in more than one read, and, with several individuals, two of them with two reads each."""
    w = Window.partitionBy("cluster").orderBy("position")
    is_sub = (F.col("reference").rlike("^[A-Z]$")) & F.col("target").rlike("^[A-Z]$") & (F.col("reference") != "N") & (F.col("target") != "N")
    marked = diffs.withColumn("sub", is_sub)
    subs = marked.where("sub").withColumn("apart", F.col("position") - F.lag("position").over(w))
    first = subs.groupBy("cluster").agg(F.count(F.lit(1)).alias("subs"), F.min("apart").alias("apart")).where("subs between 1 and 2 and coalesce(apart, 40) >= 40")
    backed = diffs.where("reads > 1 and reference <> '-' and target <> '-'").select("cluster").distinct()
    by_person = members.groupBy("cluster", "individual").agg(F.count(F.lit(1)).alias("n"))
    sized = by_person.groupBy("cluster").agg(F.sum("n").alias("n"), F.sum((F.col("n") >= 2).cast("int")).alias("twice")).where("n >= 4")
    if individuals > 1:
        sized = sized.where("twice >= 2")
    return first.select("cluster").join(backed, "cluster", "left_semi").join(sized, "cluster", "left_semi")


def without_repeats(clusters: DataFrame, hits: DataFrame, least: int = 100) -> DataFrame:
    """Clusters whose seed no block over least aligns to a repeat read; hits: blocks with name1 = seed."""
    named = hits.where((F.col("o1") > least) & (F.col("o2") > least)).select(F.col("name1").alias("cluster")).distinct()
    return clusters.join(named, "cluster", "left_anti")
