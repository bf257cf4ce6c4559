"""Differences and state of clusters, however their views are dealt."""

import random

from readweave.operators import clusters as C
from readweave.operators import snps
from readweave.plans import registry


def _views(spark):
    made = [("c1", f"r{k}", "x", "ACGT", "ACCT" if k % 2 else "TCGT", k % 3, 4) for k in range(40)] + [("c2", "r1", "x", "AC-T", "ACGT", 0, 4), ("c2", "r2", "x", "AANT", "ACGA", 5, 3)]
    return spark.createDataFrame(made, "cluster string, read_id string, individual string, ref string, tgt string, start int, n int")


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_crowded_clusters_are_added_up_before_the_shuffle(spark):
    views = _views(spark)
    assert rows(C.block_diffs(views, 10)) == rows(C.block_diffs(views, 1000)) == rows(C.block_diffs(views))
    assert ("c2", 2, "-", "G", 1) in rows(C.block_diffs(views, 10))


def test_views_are_shuffled_not_their_differences(spark):
    plan = C.block_diffs(_views(spark), C.CROWD)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.index("Generate") < plan.index("Exchange")


def test_differences_of_settled_clusters_are_not_looked_for(spark):
    views = _views(spark)
    fresh = C.templates(spark.createDataFrame([(c, "", "x", 0) for c in ("c1", "c2")], "read_id string, seq string, individual string, ord long"))
    state = C.updated(fresh, views, 5)
    assert rows(state.clusters.select("cluster", "is_repeat")) == [("c1", True), ("c2", False)]
    assert rows(state.members.select("cluster", "read_id")) == [("c1", "c1"), ("c2", "c2"), ("c2", "r1"), ("c2", "r2")]
    assert rows(state.diffs) == [("c2", 2, "-", "G", 1), ("c2", 6, "A", "C", 1)]


def test_members_meet_before_they_are_told_apart(spark):
    plan = registry.QUERIES["cluster_members"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.rindex("HashAggregate") < plan.index("Exchange")


def test_contigs_are_searched_in_a_row_not_a_group_each(spark):
    """Contigs that begin in one batch and end in another give what a search of each gives (F24)."""
    rng = random.Random(11)
    seen = {(c, p, f"r{rng.randrange(9)}"): rng.choice("AC***") for c in range(40) for p in range(1 + c % 9) for _ in range(7)}
    rows = [(c, p, b, r) for (c, p, r), b in seen.items()]
    columns = {}
    for c, p, b, r in sorted(rows):
        columns.setdefault(c, {}).setdefault(p, {})[r] = b
    sign = {(c, p): rng.choice("AC*") for c in columns for p in columns[c]}
    want = []
    for c, held in columns.items():
        search = [{"consensus": sign[c, p], "reads": dict(sorted(held[p].items()))} for p in sorted(held)]
        found = snps.alternations(search)
        want += [(c, max(sum(x["consensus"] != "*" for x in search[: f[0] + 1]) - 1, 0), [sorted(held)[k] for k in f], search[f[0]]["consensus"]) for f in found]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        got = snps.gap_snps(spark.createDataFrame(rows, "contig_id long, pos int, base string, read_id string"), spark.createDataFrame([(*at, b) for at, b in sign.items()], "contig_id long, pos int, base string"))
        assert sorted(tuple(r) for r in got.collect()) == sorted(want) and len(want) > 5
        assert "FlatMapGroups" not in got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
