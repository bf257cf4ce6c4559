"""Components covered together, and profiles dealt by contig."""

import random

from readweave.operators import graph, pileup


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_components_of_a_bucket_are_covered_as_if_alone(spark):
    rng = random.Random(3)
    made = [(f"{c}-{a}", f"{c}-{b}") for c in range(12) for a in range(7) for b in range(a) if rng.random() < 0.7 or a == b + 1]
    edges = spark.createDataFrame(made, "src string, dst string")
    labels = graph.connected_components(edges)
    alone = rows(graph.greedy_cliques(labels, edges, 3, 1, bucket=1))
    assert alone and rows(graph.greedy_cliques(labels, edges, 3, 1, bucket=10**6)) == alone


def test_profiles_at_all_positions_need_no_join(spark):
    seen = spark.createDataFrame([(k % 3, k % 2, "ab"[k % 2], "ACGTN"[k % 5 % 2 * 4], k) for k in range(40)], "contig_id long, pos int, individual string, base string, quality int")
    every = pileup.profiles(seen, None, partitions=3)
    assert rows(every) == rows(pileup.profiles(seen, seen))
    assert "Join" not in every._jdf.queryExecution().executedPlan().toString()
