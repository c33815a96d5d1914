from collections import Counter
import re

import pytest
from pyspark.sql import functions as F

import brute
from edgeweave.operators.edges import link_counts
from edgeweave.plans import pagerank as pr
from edgeweave.session import cut_lineage
from edgeweave.sources import generate


def as_dict(df):
    return {r["id"]: r["rank"] for r in df.collect()}


@pytest.mark.parametrize("strategy", ["auto", "broadcast"])
@pytest.mark.parametrize(
    "pairs",
    [brute.random_graph(3), [(1, 2), (2, 3), (4, 2)], [(1, 2), (1, 2), (1, 3), (3, 1)], brute.hub_graph()],
    ids=["random", "dangling", "copies", "hubs"],
)
def test_ranks(edges, pairs, strategy):
    ranks, log = pr.pagerank_with_mass(edges(pairs), 4, strategy=strategy, floor=3)
    want, masses = brute.pagerank(pairs, 4)
    got = as_dict(ranks)
    assert got == pytest.approx(want, abs=1e-14)
    assert sum(got.values()) == pytest.approx(1.0)
    assert [r["mass"] for r in log.orderBy("iteration").collect()] == pytest.approx(masses)


def test_broadcast_bound_falls_back(edges):
    pairs = brute.random_graph(4)
    ranks = pr.pagerank(edges(pairs), 2, strategy="broadcast", max_broadcast_rows=5)
    assert as_dict(ranks) == pytest.approx(brute.pagerank(pairs, 2)[0])


def test_sink(edges):
    ranks, log = pr.pagerank_with_mass(edges([(1, 0)]), 3, sink_id=0)
    assert as_dict(ranks) == pytest.approx({1: 1.0})
    assert [r["mass"] for r in log.collect()] == pytest.approx([1.0] * 3)
    pairs = [(1, 2), (2, 0), (3, 0), (3, 1), (3, 4)]
    ranks, log = pr.pagerank_with_mass(edges(pairs), 5, sink_id=0)
    want, masses = brute.pagerank(pairs, 5, sink=0)
    assert as_dict(ranks) == pytest.approx(want)
    assert [r["mass"] for r in log.orderBy("iteration").collect()] == pytest.approx(masses)


# Dangling mass and ranks of three chains of three nodes.
CHAINS_OF_3 = {
    1: (0.333333333333, (0.048148148148, 0.142592592593, 0.142592592593)),
    2: (0.427777777778, (0.057067901235, 0.097993827160, 0.178271604938)),
    3: (0.534814814815, (0.067176954733, 0.115684670782, 0.150471707819)),
    10: (0.473991883075, (0.061432566735, 0.113733063434, 0.158167703164)),
}


@pytest.mark.parametrize("iterations", CHAINS_OF_3)
def test_chain_values(spark, iterations):
    ranks, log = pr.chain_pagerank(spark, 3, iterations)
    mass, positions = CHAINS_OF_3[iterations]
    got = as_dict(ranks)
    assert sorted(got) == list(range(1, 10))
    assert [got[i] for i in (1, 2, 3)] == pytest.approx(positions, abs=1e-11)
    assert [got[i] for i in (7, 8, 9)] == pytest.approx(positions, abs=1e-11)
    assert log.filter(F.col("iteration") == iterations).first()["mass"] == pytest.approx(mass, abs=1e-11)


def test_chain_equals_whole_graph(spark):
    whole = pr.pagerank(generate.chains_with_sink(spark, 4), 3, sink_id=0)
    copied, _ = pr.chain_pagerank(spark, 4, 3)
    assert as_dict(whole) == pytest.approx(as_dict(copied))


def test_chain_of_100(spark):
    ranks, log = pr.chain_pagerank(spark, 100, 10)
    got = as_dict(ranks)
    assert len(got) == 10_000
    assert got[1] == pytest.approx(1.588812573561e-05, abs=1e-16)
    assert got[2] == pytest.approx(2.939122052334e-05, abs=1e-16)
    assert got[11] == got[100] == pytest.approx(1.047006992967e-04, abs=1e-15)
    assert log.filter("iteration = 10").first()["mass"] == pytest.approx(0.010448538066, abs=1e-12)


# The records after one step over three chains of three nodes.
STEP_RECORDS = [
    "1,U,0.0,2-",
    "2,U,0.1111111111111111,3-",
    "3,U,0.1111111111111111,0-",
    "4,U,0.0,5-",
    "5,U,0.1111111111111111,6-",
    "6,U,0.1111111111111111,0-",
    "7,U,0.0,8-",
    "8,U,0.1111111111111111,9-",
    "9,U,0.1111111111111111,0-",
]


def test_step_records(spark):
    records = pr.step_records(generate.chains_with_sink(spark, 3), sink_id=0)
    assert sorted(r["value"] for r in pr.record_text(records).collect()) == STEP_RECORDS


def test_step_records_in_blocks(edges):
    """A node's successors come in rows of ``width``, each with the contribution of the node."""
    pairs = brute.hub_graph() + [(7, 8)]
    rows = pr.step_records(edges(pairs), floor=3, width=16).collect()
    nodes = {x for p in pairs for x in p}
    out = Counter(a for a, _ in pairs)
    for v in nodes:
        got = sum(1 / len(nodes) / out[a] for a, b in pairs if b == v)
        mine = [r for r in rows if r["node"] == v]
        assert all(r["contribution"] == pytest.approx(got) for r in mine)
        assert sorted(x for r in mine for x in r["adjacency"] or []) == sorted({b for a, b in pairs if a == v})
        assert len(mine) == max(1, -(-len({b for a, b in pairs if a == v}) // 16))


def test_chain_heads(spark):
    heads = pr.nodes_without_in_links(generate.chains_with_sink(spark, 5), sink_id=0)
    assert sorted(r["id"] for r in heads.collect()) == [1, 6, 11, 16, 21]


def test_initial_ranks(edges):
    df = edges([(1, 2), (1, 2), (3, 0)])
    assert as_dict(pr.initial_ranks(df, sink_id=0)) == pytest.approx({1: 1 / 3, 2: 1 / 3, 3: 1 / 3})
    assert as_dict(pr.initial_ranks(df, sink_id=0, per="edge")) == pytest.approx({1: 1 / 3, 2: 1 / 3, 3: 1 / 3})


def test_results_outlive_the_links(spark, edges):
    """Nothing lazy in the ranks or the mass log reads the dropped link table."""
    pairs = [(1, 2), (2, 3), (4, 2)]
    ranks, log = pr.pagerank_with_mass(edges(pairs), 2)
    spark.catalog.clearCache()
    want, masses = brute.pagerank(pairs, 2)
    assert as_dict(ranks) == pytest.approx(want)
    assert [r["mass"] for r in log.orderBy("iteration").collect()] == pytest.approx(masses)


def test_top_ranked(edges):
    ranks = edges([(1, 2)]).sparkSession.createDataFrame([(1, 0.2), (2, 0.5), (3, 0.2)], "id long, rank double")
    assert [r["id"] for r in pr.top_ranked(ranks, 2).collect()] == [2, 1]


def test_links_stay_where_they_are(edges):
    """An iteration shuffles ranks and contributions; the persisted links are read in place."""
    links = cut_lineage(link_counts(edges(brute.hub_graph())))
    nodes = pr.node_layout(pr.node_table(links, floor=3)).persist()
    layout = pr.link_layout(links, nodes).persist()
    layout.count()
    state = nodes.withColumn("rank", F.lit(0.5))
    sums = pr._contributions(state, layout, small=False)
    plan = sums._jdf.queryExecution().executedPlan().toString()
    # the cached links feed the join without an exchange or a sort; the sum is combined in the same stage
    in_place = (
        r"HashAggregate\(keys=\[dst#\d+L\], functions=\[partial_sum.*\n\s*\+- Project.*\n"
        r"\s*\+- SortMergeJoin \[src#\d+L, cell#\d+L\].*\n[\s:]*- Filter.*\n[\s:]*\+- InMemoryTableScan \[src#"
    )
    assert re.search(in_place, plan), plan
    nodes.unpersist()
    layout.unpersist()
