"""Greedy selections in parallel rounds against the sequential models, and a graph of reads with real cliques."""

import random

from readweave.operators import culling, graph
from readweave.plans import registry
from readweave.plans import views as V


def walked(held, least=4):
    seen, out = set(), []
    for c, m in held:
        clear = True
        for x in m:
            if x in seen:
                clear = False
                break
            seen.add(x)
        if clear and len(m) >= least:
            out.append(c)
    return out


def covered(nodes, near, over):
    groups = []
    for n in sorted(nodes):
        for g in groups:
            if all(x in near[n] for x in g):
                g.append(n)
                break
        else:
            groups.append([n])
    return {tuple(g) for g in groups if len(g) > over}


def test_disjoint_in_rounds(spark):
    """One giant component; clusters that list a member twice, ties of places, walks cut short in several rounds."""
    rng = random.Random(8)
    held = [(c, [f"m{rng.randrange(400)}" for _ in range(rng.randrange(1, 9))]) for c in range(90)]
    df = spark.createDataFrame([(f"c{c:03d}", c // 2, x, k) for c, m in held for k, x in enumerate(m)], "cluster string, ord long, member string, place int")
    want = [f"c{c:03d}" for c in walked(held)]
    assert 5 < len(want) < 60, len(want)
    for local in (0, 40, 10**6):
        assert sorted(r.cluster for r in culling.disjoint(df, local=local).collect()) == want
    assert culling.disjoint(df.where("false"), local=0).count() == 0


def test_cliques_in_rounds(spark):
    rng = random.Random(3)
    edges = {(i, j) for k in range(0, 60, 6) for i in range(k, k + 7) for j in range(k, i)} | {(rng.randrange(61), rng.randrange(61)) for _ in range(60)}
    edges = {(max(e), min(e)) for e in edges if e[0] != e[1]}
    near = {n: set() for e in edges for n in e}
    for u, v in edges:
        near[u].add(v)
        near[v].add(u)
    df = spark.createDataFrame(sorted(edges), "src long, dst long")
    labels = graph.connected_components(df)
    assert labels.select("component").distinct().count() == 1
    want = covered(near, near, 4)
    assert len(want) > 5
    for local in (0, 10**6):
        got = {}
        for r in graph.greedy_cliques(labels, df, local=local).collect():
            got.setdefault(r.clique, []).append(r.node)
        assert {tuple(sorted(g)) for g in got.values()} == want and all(k == min(g) for k, g in got.items())


def test_rare_word_graph_has_cliques_and_chains(spark):
    sf = "/root/testdata/sf0.001"
    edges = [(r.src, r.dst) for r in V.rare_edges(spark, sf).collect()]
    reads = {r.read_id: r.seq for r in V.reads(spark, sf).collect()}
    by = {}
    for name, seq in reads.items():
        for word in {seq[i : i + 31] for i in range(len(seq) - 30)}:
            by.setdefault(word, []).append(name)
    want = {(max(a, b), min(a, b)) for ids in by.values() if 2 <= len(ids) <= 5 for a in ids for b in ids if a != b}
    assert set(edges) == want and len(edges) == len(want)
    near = {n: set() for e in want for n in e}
    for u, v in want:
        near[u].add(v)
        near[v].add(u)
    assert any(len(x) > 1 and not all(b in near[a] for a in x for b in x if a != b) for x in near.values())  # no mere star or clique
    label = {n: n for n in near}
    while (new := {n: min([label[n], *(label[m] for m in near[n])]) for n in near}) != label:
        label = new
    size = {}
    for n in label.values():
        size[n] = size.get(n, 0) + 1
    got = {}
    for r in registry.QUERIES["rare_cliques"](spark, sf).collect():
        got.setdefault(r.clique, []).append(r.node)
    assert {tuple(sorted(g)) for g in got.values()} == covered([n for n in near if size[label[n]] >= 4], near, 4)


def test_condemned_edges_go(spark):
    sf = "/root/testdata/sf0.001"
    left = registry.QUERIES["condemned_edges"](spark, sf).count()
    assert 0 < left < V.edges(spark, sf).count()
