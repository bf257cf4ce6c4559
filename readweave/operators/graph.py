"""Graph operators: connected components, star graphs, degree limits, size filters, greedy cliques."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegralType, StringType

from readweave.session import materialize

#: Edges of a component that one task covers by itself, in arrays of some tens of bytes an edge.
LOCAL_EDGES = 5_000_000
#: Edges of a task that are shrunk to a forest together, in arrays of some tens of bytes an edge.
FOREST_EDGES = 1 << 20
#: Edges of components that one call covers together, on average: most components have a few edges only.
BUCKET_EDGES = 100_000


def canonical_edges(edges: DataFrame) -> DataFrame:
    """Undirected edges once each, as (u, v) with u > v; self loops and null ends go."""
    return (
        edges.select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v"), (F.col("src") != F.col("dst")).alias("ok"))
        .where("ok")
        .select("u", "v")
        .distinct()
    )


def _lowest(u: np.ndarray, v: np.ndarray, n: int) -> np.ndarray:
    """Of each of n nodes the least that the edges (u, v) reach."""
    root = np.arange(n)
    while len(u):
        a, b = root[u], root[v]
        apart = a != b
        u, v, a, b = u[apart], v[apart], a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(up := root[root], root):
            root = up
    return root


def _forest(edges: DataFrame) -> DataFrame:
    """Edges (src, dst) that connect what edges connects, fewer than a task's nodes: all of a node's others lead to its group's least."""

    def shrunk(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        names = pc.unique(pa.chunked_array([*table.column("src").chunks, *table.column("dst").chunks]))
        names = names.take(pc.array_sort_indices(names))
        u, v = (pc.index_in(table.column(c), value_set=names).to_numpy().astype(np.int64) for c in ("src", "dst"))
        root = _lowest(u, v, len(names))
        moved = np.flatnonzero(root != np.arange(len(root)))
        return pa.RecordBatch.from_arrays([names.take(pa.array(moved)), names.take(pa.array(root[moved]))], ["src", "dst"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= FOREST_EDGES:
                held = [shrunk(held)]
                size = held[0].num_rows
                if 2 * size > FOREST_EDGES:
                    yield held[0]
                    held, size = [], 0
        if size:
            yield shrunk(held)

    return edges.where("src is not null and dst is not null").select("src", "dst").mapInArrow(run, edges.select("src", "dst").schema)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(low.select("u", F.col("m").alias("v")))


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node that has an edge; component is the smallest reachable node.

    edges: (src, dst) of any orderable type; nulls and self loops are ignored, repeats are harmless, no
    edges give no rows. Each task first shrinks its edges to a forest, which connects the same nodes, so that of a dense graph no more
    than its nodes a task are shuffled. Then alternates the large-star and small-star steps, which shrink every component to a
    star in a logarithmic number of rounds. Each round is two aggregations and two equi-joins whose hot
    keys adaptive execution can split; a written table cuts the lineage; only a row count and a
    checksum reach the driver.
    """
    kinds = [edges.schema[c].dataType for c in ("src", "dst")]
    if kinds[0] == kinds[1] and isinstance(kinds[0], (StringType, BinaryType, IntegralType)):
        edges = _forest(edges)
    current = materialize(canonical_edges(edges), "components")
    seen = None
    while True:
        state = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == seen or not state[0]:
            break
        seen = tuple(state)
        current = materialize(_small_star(_large_star(current).distinct()).distinct(), "components")
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots)


def components_of(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, component) for every distinct non-null id of vertices; isolated ones are their own component."""
    found = connected_components(edges)
    return (
        vertices.select(F.col("id").alias("node"))
        .where("node is not null")
        .distinct()
        .join(found, "node", "left")
        .select("node", F.coalesce("component", "node").alias("component"))
    )


def star_edges(clusters: DataFrame) -> DataFrame:
    """Seed-to-member edges of clusters(cluster, is_repeat, members) that are not repeats."""
    return (
        clusters.where("not is_repeat")
        .select(F.col("cluster").alias("src"), F.explode("members").alias("m"))
        .select("src", F.col("m.read_id").alias("dst"))
        .where("src <> dst")
    )


def edge_exists(pairs: DataFrame, edges: DataFrame) -> DataFrame:
    """The pairs (src, dst) that are an edge in either direction."""
    known = canonical_edges(edges)
    return (
        pairs.select("src", "dst", F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v"))
        .join(known, ["u", "v"], "left_semi")
        .select("src", "dst")
    )


def condemn(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges without those that touch one of nodes(id)."""
    src, dst = nodes.select(F.col("id").alias("src")).distinct(), nodes.select(F.col("id").alias("dst")).distinct()
    return edges.join(src, "src", "left_anti").join(dst, "dst", "left_anti").select("src", "dst")


def over_degree(edges: DataFrame, limit: int) -> DataFrame:
    """Nodes (id, degree) with more than limit distinct neighbours."""
    known = canonical_edges(edges)
    ends = known.select(F.col("u").alias("id")).unionAll(known.select(F.col("v").alias("id")))
    return ends.groupBy("id").agg(F.count(F.lit(1)).alias("degree")).where(F.col("degree") > limit)


def component_sizes(labels: DataFrame) -> DataFrame:
    return labels.groupBy("component").agg(F.count(F.lit(1)).alias("n_nodes"))


def short_components(labels: DataFrame, least: int = 4, most: int = 6) -> DataFrame:
    """(component, node) of components of least to most nodes."""
    sized = component_sizes(labels).where(F.col("n_nodes").between(least, most)).select("component")
    return labels.join(sized, "component", "left_semi").select("component", "node")


def greedy_cliques(labels: DataFrame, edges: DataFrame, least_component: int = 4, over: int = 4, local: int = LOCAL_EDGES, bucket: int = BUCKET_EDGES) -> DataFrame:
    """(component, clique, node): cliques of more than `over` nodes from a greedy cover of each component.

    Nodes are taken in order of id; each joins the first clique with all of whose nodes it has an edge, or
    begins one. Components of fewer than least_component nodes are left out. A component of at most local edges is one
    task's work, with others of its bucket, since nodes of different components have no edge and never join; larger ones are
    covered in rounds over the whole table, see _cliques_in_rounds.
    """
    sized = component_sizes(labels).where(F.col("n_nodes") >= least_component).select("component")
    keep = labels.join(sized, "component", "left_semi")
    known = materialize(canonical_edges(edges).join(keep.select(F.col("node").alias("u"), F.col("component").alias("own")), "u"), "clique-edges")
    buckets = -(-known.count() // bucket) or 1
    large = materialize(known.groupBy("own").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > local).select(F.col("own").alias("component")), "large-components")
    node_type = dict(labels.dtypes)["node"]

    def cover(key: tuple, nodes: pa.Table, links: pa.Table) -> pa.Table:
        held = nodes.column("node").combine_chunks()
        names = pc.unique(held).sort()
        owners = nodes.column("component").take(pc.index_in(names, value_set=held))  # a node is in one component
        ends = [pc.index_in(links.column(c), value_set=names).to_numpy().astype(np.int32) for c in ("u", "v")]
        late, early = np.maximum(*ends), np.minimum(*ends)
        early, at = early[np.argsort(late, kind="stable")], np.searchsorted(np.sort(late), np.arange(len(names) + 1))
        place, size, begun = np.zeros(len(names), np.int64), np.zeros(len(names), np.int64), np.zeros(len(names), np.int64)
        count = 0
        for n in range(len(names)):
            if at[n] == at[n + 1]:  # no neighbour before it
                place[n], begun[count], size[count] = count, n, 1
                count += 1
                continue
            # only groups of neighbours can fit; one fits if as many of its nodes are neighbours as it has
            group, shared = np.unique(place[early[at[n] : at[n + 1]]], return_counts=True)
            fits = group[shared == size[group]]
            if len(fits):
                place[n] = fits[0]
            else:
                place[n], begun[count] = count, n
                count += 1
            size[place[n]] += 1
        kept = np.flatnonzero(size[place] > over)
        columns = [owners.take(pa.array(kept)), names.take(pa.array(begun[place[kept]])), names.take(pa.array(kept))]
        return pa.table(columns, ["component", "clique", "node"])

    small = (
        keep.join(large, "component", "left_anti")
        .groupBy(F.pmod(F.xxhash64("component"), F.lit(buckets)).alias("bucket"))
        .cogroup(known.join(large, F.col("own") == F.col("component"), "left_anti").groupBy(F.pmod(F.xxhash64("own"), F.lit(buckets)).alias("bucket")))
        .applyInArrow(cover, f"component {node_type}, clique {node_type}, node {node_type}")
    )
    if not large.head(1):
        return small
    nodes = keep.join(large, "component", "left_semi")
    found = _cliques_in_rounds(nodes.select("node"), known.join(large, F.col("own") == F.col("component"), "left_semi").select("u", "v"))
    big = found.groupBy("clique").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > over).select("clique")
    return small.unionByName(found.join(big, "clique", "left_semi").join(nodes, "node").select("component", "clique", "node"))


def _cliques_in_rounds(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, clique): the greedy cover of nodes(node) with edges(u, v), a clique named by its first node.

    What a node joins depends on the nodes before it that are at most two edges away: its neighbours, and those that may join
    their cliques. So in each round all undecided nodes that come first among the undecided ones within two edges decide at
    once. A decided node's clique fits if the node has an edge to as many of its members as it has; the one
    that began first is taken.
    """
    both = materialize(edges.select(F.col("u").alias("a"), F.col("v").alias("b")).unionAll(edges.select("v", "u")), "clique-links")
    left = materialize(nodes.distinct(), "clique-left")
    kind = dict(nodes.dtypes)["node"]
    done = materialize(left.where("false").select("node", F.lit(None).cast(kind).alias("clique")), "cliques")
    while left.head(1):
        reach = both.select(F.col("a").alias("x"), F.col("b").alias("node")).join(left, "node").unionByName(left.select(F.col("node").alias("x"), "node"))
        one = materialize(reach.groupBy("x").agg(F.min("node").alias("low")), "clique-reach")
        further = both.join(one, both.b == one.x).select(F.col("a").alias("node"), "low").unionAll(one.select(F.col("x").alias("node"), "low"))
        ready = materialize(further.groupBy("node").agg(F.min("low").alias("low")).where("low = node").select("node").join(left, "node", "left_semi"), "clique-ready")
        sizes = done.groupBy("clique").agg(F.count(F.lit(1)).alias("size"))
        shared = both.join(ready, both.a == ready.node).select("a", "b").join(done, F.col("b") == done.node).groupBy("a", "clique").agg(F.count(F.lit(1)).alias("shared"))
        fits = shared.join(sizes, "clique").where("shared = size").groupBy("a").agg(F.min("clique").alias("clique"))
        joined = ready.join(fits, ready.node == fits.a, "left").select("node", F.coalesce("clique", "node").alias("clique"))
        done = materialize(done.unionByName(joined), "cliques")
        left = materialize(left.join(ready, "node", "left_anti"), "clique-left")
    return done
