"""Intersections, membership filters, and the layouts that let a plan read or move less."""

from collections import Counter
import os
import time

import pytest
from pyspark.sql import functions as F

import brute
from edgeweave.operators import edges as ed, intersections as ix, layout as lo, triangles as tr
from edgeweave.plans import pagerank as pr
from edgeweave.session import CLEANUP, fresh_path, scratch, shared_dir, written_table
from edgeweave.sources import readers, writers
from test_graph import BUDGET, FLOOR, GRAPHS, TOGETHER, plan_of, plain, weighted

DENSE = [*brute.random_graph(5, nodes=40, edges=900), *GRAPHS["hubs"]]


@pytest.mark.parametrize("width", [2, 4, 128])
@pytest.mark.parametrize("pairs", [TOGETHER, DENSE])
def test_intersections(edges, pairs, width):
    df = edges(pairs)
    assert weighted(ix.intersected_triangles(df, floor=FLOOR, width=width)) == brute.triangles(pairs)
    assert plain(ix.intersected_canonical(df, FLOOR, width)) == Counter(brute.canonical(pairs))


def test_intersection_kinds(edges):
    df = edges(TOGETHER)
    semi = ix.intersected_triangles(df, "semi", FLOOR, width=4)
    assert weighted(semi) == brute.semi_triangles(TOGETHER)
    assert plain(ix.intersected_triangles(df, "distinct", FLOOR)) == Counter(set(brute.triangles(TOGETHER)))
    assert ix.intersected_triangles(edges([])).collect() == []


def test_blocks_are_bounded_and_no_wedges_are_listed(edges):
    """A block has few members, and links meet blocks, not paths: far fewer rows than two-hop paths."""
    ranked, _ = tr.ranked_links(edges(DENSE), FLOOR)
    oriented = ix._oriented(ranked, 8)
    blocks = ix.neighbour_blocks(oriented).cache()
    assert blocks.filter("bits > 0").count() > 0
    assert blocks.agg(F.max(F.greatest(F.size("succ"), F.size("pred")))).first()[0] <= 16
    met = ix._meetings(oriented, blocks).count()
    links = len({p for p in DENSE if p[0] != p[1]})
    widest = 2 ** blocks.agg(F.max("bits")).first()[0]
    assert met <= links * widest
    ranked, rows = tr.ranked_links(edges(DENSE), FLOOR)
    assert ix._meetings(ix._oriented(ranked, 128), ix.neighbour_blocks(ix._oriented(ranked, 128))).count() <= links
    assert tr._wedges(ranked, rows, "auto").count() > 2 * links


def test_a_large_set_does_not_cut_the_small_one_that_a_link_meets(edges):
    """Customers have many predecessors and one successor; only the set that closes the cycle counts."""
    served = [(s, c) for s in range(30) for c in range(100, 160)]
    pairs = [*served, *((c, 1000) for c in range(100, 160)), *((1000, s) for s in range(30))]
    ranked, _ = tr.ranked_links(edges(pairs), FLOOR)
    oriented = ix._oriented(ranked, 4)
    blocks = ix.neighbour_blocks(oriented)
    assert blocks.agg(F.max("bits")).first()[0] > 2
    assert ix._meetings(oriented, blocks).count() <= len(pairs)
    assert plain(ix.intersected_canonical(edges(pairs), FLOOR, 4)) == Counter(brute.canonical(pairs))


def test_written_tables_leave_no_shuffle_files(spark):
    def files():
        return sum(n.startswith("shuffle_") and n.endswith(".data") for _, _, names in os.walk(spark.conf.get("spark.local.dir")) for n in names)

    before, deadline = files(), time.time() + 20
    with scratch(spark):
        table, _ = written_table(spark.range(1000).groupBy(F.col("id") % 7).count(), "sevenths")
        while files() > before and time.time() < deadline:  # they go in the background
            time.sleep(0.2)
        assert files() <= before
        assert table.count() == 7
    assert spark.conf.get(CLEANUP) == "false"


@pytest.mark.parametrize("bits", [64, 1 << 16])
def test_filtered_triangles(edges, bits):
    df = edges(TOGETHER)
    assert weighted(tr.triangles(df, floor=FLOOR, budget=BUDGET, filter_bits=bits)) == brute.triangles(TOGETHER)
    assert plain(tr.triangles_canonical(df, floor=FLOOR, filter_bits=bits)) == Counter(brute.canonical(TOGETHER))


def test_filter_is_bounded_and_shuffles_fewer_paths(edges):
    pairs = brute.random_graph(9, nodes=60, edges=600)
    ranked, rows = tr.ranked_links(edges(pairs), FLOOR)
    assert tr.pair_filter(ranked, 256).count() <= 4
    wedges = tr._wedges(ranked, rows, "auto")
    left = tr.possible_pairs(wedges, "w", "u", tr.pair_filter(ranked, 1 << 16), 1 << 16)
    closed = tr.closed_walks(ranked, rows).count()
    assert closed <= left.count() < wedges.count() / 2


def scan_files(df):
    """Files that the scans of a frame's plan have read, after it has run."""
    df.collect()
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
        elif "QueryStage" in node.nodeName():
            todo.append(node.plan())
        else:
            if node.nodeName().startswith("Scan") and node.metrics().contains("numFiles"):
                found.append(node.metrics().apply("numFiles").value())
            children = node.children()
            todo += [children.apply(i) for i in range(children.size())]
    return sum(found)


def test_a_cap_skips_files(spark, edges):
    pairs = brute.random_graph(3, nodes=500, edges=4000) + [(7, 499)] * 300 + [(None, 3), (3, None)]
    path = fresh_path(spark, "by-top")
    lo.write_by_top(edges(pairs), path, ranges=16)
    every = lo.read_capped(spark, path, 10**6)
    assert Counter(map(tuple, every.collect())) == Counter(p for p in pairs if None not in p)
    capped = lo.read_capped(spark, path, 100)
    assert Counter(map(tuple, capped.collect())) == Counter(p for p in pairs if None not in p and max(p) <= 100)
    assert 0 < scan_files(lo.read_capped(spark, path, 100)) < scan_files(lo.read_capped(spark, path, 10**6)) / 4
    cap = edges(pairs).agg(F.expr("max(dst) div 5")).scalar()
    assert scan_files(lo.read_capped(spark, path, cap)) < scan_files(lo.read_capped(spark, path, 10**6)) / 4
    empty = fresh_path(spark, "by-top")
    lo.write_by_top(edges([(None, 1)]), empty)
    assert lo.read_capped(spark, empty, 5).collect() == []


SINK = 900  # without out-links, as a sink is
GRAPH = [*brute.random_graph(4, nodes=30, edges=120), (3, 900), (4, 900), (4, 901), *GRAPHS["hubs"]]


def ranks_of(df):
    return {r.id: r.rank for r in df.collect()}


def test_bucketed_links_are_not_exchanged(spark, edges):
    table = lo.bucketed_table(ed.link_counts(edges(GRAPH)).withColumn("cell", F.col("dst") % 2), "src", "cell")
    try:
        laid, other = spark.table(table), spark.range(50).select(F.col("id").alias("src"), (F.col("id") % 2).alias("cell"))
        joined = laid.join(other.hint("merge"), ["src", "cell"])
        joined.collect()
        plan = plan_of(joined).split("== Initial Plan")[0]
        assert plan.count("Exchange hashpartitioning") <= 1 and "Bucketed: true" in plan
        spark.catalog.clearCache()
        assert joined.count() == sum(1 for a, b in set(GRAPH) if a < 50 and a % 2 == b % 2)
    finally:
        lo.drop_bucketed(spark, table)
    assert table not in [t.name for t in spark.catalog.listTables()]


def test_bucketed_ranks(edges):
    for sink in (None, SINK):
        want, _ = brute.pagerank(GRAPH, 4, sink=sink)
        got = ranks_of(pr.pagerank(edges(GRAPH), 4, sink_id=sink, floor=FLOOR, layout="bucketed"))
        assert got == pytest.approx(want, abs=1e-12)


@pytest.mark.parametrize("every", [1, 2, 5])
@pytest.mark.parametrize("sink", [None, SINK])
def test_steps_between_writes(edges, every, sink):
    want, masses = brute.pagerank(GRAPH, 7, sink=sink)
    ranks, log = pr.pagerank_with_mass(edges(GRAPH), 7, sink_id=sink, floor=FLOOR, every=every)
    assert ranks_of(ranks) == pytest.approx(want, abs=1e-12)
    assert [r.mass for r in log.orderBy("iteration").collect()] == pytest.approx(masses, abs=1e-12)


def test_steps_before_are_removed(spark, edges, monkeypatch):
    folder, most = shared_dir(spark).removeprefix("file:"), []
    steps = lambda: [f for f in os.listdir(folder) if f.startswith("step-")]
    with scratch(spark):
        before = len(steps())
        written = pr._written_step

        def watched(*args, **sums):
            out = written(*args, **sums)
            most.append(len(steps()) - before)
            return out

        monkeypatch.setattr(pr, "_written_step", watched)
        ranks = pr.pagerank(edges(GRAPH), 6)
        assert len(steps()) - before == 1 and max(most) == 2 and len(most) == 7
        assert sum(ranks_of(ranks).values()) == pytest.approx(1)
        most.clear()
        pr.pagerank(edges(GRAPH), 6, every=3)
        assert len(most) == 3


def test_plan_between_writes_is_linear(edges):
    """Twice the steps have twice the joins."""
    links = ed.link_counts(edges(GRAPH))
    nodes = pr.node_table(links).checkpoint()
    own = nodes.selectExpr("id as src", "0L as cell", "id as dst", "0L as n")
    laid = pr._in_cells(links, nodes).unionByName(own).checkpoint()
    start = nodes.withColumn("rank", F.lit(0.5))
    joins = [pr._several_steps(start, laid, n)._jdf.queryExecution().optimizedPlan().toString().count("Join ") for n in (2, 4)]
    assert joins == [2, 4]


def test_exact_ranks_do_not_depend_on_the_partitions(spark, edges):
    want, _ = brute.pagerank(GRAPH, 5)
    found = []
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in (1, 3, 8):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            found.append(ranks_of(pr.pagerank(edges(GRAPH).repartition(n + 1), 5, floor=FLOOR, exact=True)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    assert found[0] == found[1] == found[2]
    assert found[0] == pytest.approx(want, abs=1e-12)


def test_rank_options(edges):
    for options in ({"every": 0}, {"layout": "other"}, {"every": 2, "exact": True}, {"every": 2, "strategy": "broadcast"}):
        with pytest.raises(ValueError):
            pr.pagerank(edges(GRAPHS["cycle"]), 2, **options)


def test_iterations_are_partitions(spark):
    root = fresh_path(spark, "iterations")
    for i in (1, 2, 2, 3):
        writers.write_iteration(spark.createDataFrame([(7, i / 10), (8, 0.5)], "id long, rank double"), root, i)
    second = readers.read_iteration(spark, root, 2)
    assert {tuple(r) for r in second.collect()} == {(7, 0.2), (8, 0.5)}
    assert "PartitionFilters: [isnotnull(iteration" in plan_of(second)
    assert scan_files(second) <= 2 < scan_files(spark.read.parquet(root))


def test_counting_while_writing_saves_the_job(spark, edges):
    """A broadcast strategy starts no job to count what it ships."""
    from edgeweave.session import counted_table

    table, _, rows = counted_table(ed.link_counts(edges(GRAPH)), "links")
    assert rows == len(set(GRAPH)) == table.count()
    assert counted_table(ed.link_counts(edges([])), "links")[2] == 0


def test_counting_while_writing_is_no_job(spark, edges):
    """What is written and counted takes one job less than what is written and then counted."""
    from edgeweave.session import counted_table, written_table

    def jobs(name, action):
        spark.sparkContext.setJobGroup(name, name)
        try:
            action()
        finally:
            spark.sparkContext.setJobGroup("other", "other")
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))

    links = ed.link_counts(edges(GRAPH))
    apart = jobs("apart", lambda: written_table(links, "links")[0].count())
    assert jobs("together", lambda: counted_table(links, "links")) < apart
