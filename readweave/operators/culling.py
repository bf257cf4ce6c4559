"""Choosing clusters that share no reads: greedy disjoint selection, and fishing by connected components."""

from __future__ import annotations

from functools import reduce
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readweave.operators.graph import components_of, condemn
from readweave.session import materialize

LEAST_MEMBERS = 4
#: Rows that one task walks by itself.
LOCAL_ROWS = 200_000
#: Fixed value: the sequence line of clusters that are made from components.
PLACEHOLDER = "ACGT"


def disjoint(members: DataFrame, least: int = LEAST_MEMBERS, local: int = LOCAL_ROWS) -> DataFrame:
    """(cluster): clusters picked in order of ord, none of whose members a cluster before has touched.

    members(cluster, ord, member, place): a cluster's members are walked by place up to the first that is
    already touched; those walked stay touched, also when the cluster is rejected or has fewer than least members.

    Works in rounds over the whole table. A cluster that comes first among the undecided ones for each member that it can
    still reach decides, so all such clusters do at once; what they touch cuts the walks of the others short. Once no more than
    local rows are left, which is a fixed bound, one task walks them in order.
    """
    kind = dict(members.dtypes)["cluster"]
    rows = materialize(_first_places(members), "walks")
    picked = []
    while rows.count() > local:
        first = rows.groupBy("member").agg(F.min(F.struct("ord", "cluster")).alias("first"))
        ready = rows.join(first, "member").groupBy("ord", "cluster").agg(F.every(F.col("first") == F.struct("ord", "cluster")).alias("ready"))
        ready = materialize(ready.where("ready").select("cluster"), "walks-decided")
        taken = rows.join(ready, "cluster", "left_semi")
        picked.append(taken.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.max("cut").alias("cut")).where((F.col("n") >= least) & ~F.col("cut")).select("cluster"))
        rest = rows.join(ready, "cluster", "left_anti")
        stops = rest.join(taken.select("member").distinct(), "member", "left_semi").groupBy("cluster").agg(F.min(F.struct("place", "member")).alias("stop"))
        rows = materialize(_cut_short(rest, stops), "walks")

    def pick(group: pa.Table) -> pa.Table:
        walks = sorted(zip(*(group.column(c).to_pylist() for c in ("ord", "cluster", "place", "member", "cut")), strict=True))
        touched, chosen = set(), []
        for (_, name), own in groupby(walks, key=lambda r: r[:2]):
            steps = list(own)
            clear = not steps[0][4]
            for _, _, _, m, _ in steps:
                if m in touched:
                    clear = False
                    break
                touched.add(m)
            if clear and len(steps) >= least:
                chosen.append(name)
        return pa.table({"cluster": pa.array(chosen, group.schema.field("cluster").type)})

    last = rows.groupBy(F.lit(0).alias("all")).applyInArrow(pick, f"cluster {kind}")
    return reduce(DataFrame.unionAll, picked, last)


def _first_places(members: DataFrame) -> DataFrame:
    """(ord, cluster, place, member, cut): each member at its first place; a member that comes again ends the walk there."""
    places = members.groupBy("ord", "cluster", "member").agg(F.sort_array(F.collect_list("place")).alias("places"))
    rows = places.select("ord", "cluster", F.col("places")[0].alias("place"), "member", F.lit(False).alias("cut"))
    again = places.where(F.size("places") > 1).groupBy("cluster").agg(F.min(F.struct(F.get("places", F.lit(1)).alias("place"), "member")).alias("stop"))
    return _cut_short(rows, again)


def _cut_short(rows: DataFrame, stops: DataFrame) -> DataFrame:
    """rows without those from their cluster's stop(place, member) on; such clusters are cut."""
    joined = rows.join(stops, "cluster", "left").where(F.col("stop").isNull() | (F.struct("place", "member") < F.col("stop")))
    return joined.select("ord", "cluster", "place", "member", (F.col("cut") | F.col("stop").isNotNull()).alias("cut"))


def fished(members: DataFrame, repeats: DataFrame, least: int = LEAST_MEMBERS) -> DataFrame:
    """(component, node): components of at least `least` nodes of the seed-to-member graph, after all edges of
    repeat nodes(id) are gone. members(cluster, member)."""
    edges = members.where("cluster <> member").select(F.col("cluster").alias("src"), F.col("member").alias("dst"))
    nodes = members.select(F.col("cluster").alias("id")).unionByName(members.select(F.col("member").alias("id")))
    labels = components_of(nodes, condemn(edges, repeats))
    sized = labels.groupBy("component").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least).select("component")
    return labels.join(sized, "component", "left_semi").select("component", "node")
