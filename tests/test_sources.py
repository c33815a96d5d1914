from collections import Counter
import uuid

import pytest
from pyspark.sql import functions as F

from edgeweave.operators import layout
from edgeweave.operators.edges import cap_edges, link_counts
from edgeweave.operators.paths import hub_nodes
from edgeweave.plans import pagerank as pr
from edgeweave.session import fresh_path, shared_dir
from edgeweave.sources import generate, readers, writers
from edgeweave.sources.derived import (
    part_sequence_edges,
    successor_edges,
    supplier_customer_edges,
    table,
    trade_edges,
)

SF = "/root/testdata/sf0.001"


def bag(df):
    return Counter((r["src"], r["dst"]) for r in df.collect())


@pytest.fixture
def text(spark):
    def write(*lines):
        path = fresh_path(spark, "lines")
        spark.createDataFrame([(x,) for x in lines], "value string").write.text(path)
        return path

    return write


MALFORMED = ("1,2", "x,y", "3", "")


def test_permissive_readers_drop_malformed_lines(spark, text):
    path = text(*MALFORMED)
    for read in (readers.read_edges_csv, readers.read_edges_text, readers.read_edges_tokens):
        assert bag(read(spark, path)) == Counter({(1, 2): 1})


def test_failfast_readers_raise(spark, text):
    path = text(*MALFORMED)
    for read in (readers.read_edges_csv, readers.read_edges_text, readers.read_edges_tokens):
        with pytest.raises(Exception):
            read(spark, path, mode="FAILFAST").collect()
    with pytest.raises(ValueError):
        readers.read_edges_csv(spark, path, mode="other")


@pytest.mark.parametrize("line", ["x,5", "7", "1,2,3", "5,x"])
def test_failfast_raises_whatever_is_read(spark, text, line):
    """Both columns, one of them, or none: no plan prunes the check."""
    path = text("1,5", line)
    for read in (readers.read_edges_csv, readers.read_edges_text, readers.read_edges_tokens):
        df = read(spark, path, mode="FAILFAST")
        for use in (df, df.select("src"), df.select("dst"), df.groupBy("dst").count(), df.agg(F.count(F.lit(1)))):
            with pytest.raises(Exception):
                use.collect()
        assert bag(read(spark, path)) == Counter([(1, 5)])
        assert read(spark, path).count() == 1 and read(spark, path).select("dst").count() == 1


def test_text_takes_exactly_two_fields(spark, text):
    assert bag(readers.read_edges_text(spark, text("1,2", "1,2,3", "4,5,", " 6,7"))) == Counter([(1, 2), (4, 5), (6, 7)])


def test_tokens(spark, text):
    assert bag(readers.read_edges_tokens(spark, text(" 1,2\t3,4  5,6 ", "1,2"))) == Counter([(1, 2), (3, 4), (5, 6), (1, 2)])


@pytest.mark.parametrize("whole", [False, True])
def test_regex(spark, text, whole):
    path = text("a 1,2; 3,40 b", "none", "1,2,3,4")
    assert bag(readers.read_edges_regex(spark, path, whole)) == Counter([(1, 2), (3, 40), (1, 2), (3, 4)])


def test_cap_reaches_the_scan(spark, text):
    plan = cap_edges(readers.read_edges_csv(spark, text("1,2")), 10)._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(src,10)" in plan and "LessThanOrEqual(dst,10)" in plan


def test_derivation_reads_three_columns(spark):
    plan = part_sequence_edges(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_linenumber:int>" in plan
    assert "CartesianProduct" not in plan and "Python" not in plan


def test_derivation_runs_no_job_when_defined(spark):
    """The derivation is lazy; only reading the tables' schemas may ask Spark for something."""
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("define", "define", False)
    try:
        table(spark, SF, "lineitem")
        schemas = len(tracker.getJobIdsForGroup("define"))
        edges = part_sequence_edges(spark, SF)
        assert len(tracker.getJobIdsForGroup("define")) <= 2 * schemas
        assert edges.columns == ["src", "dst"]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_sinks_round_trip(spark, edges):
    df = edges([(1, 2), (1, 2), (30, 4)])
    for sep in (",", "\t"):
        path = fresh_path(spark, "sink")
        writers.write_csv(df, path, sep)
        assert bag(readers.read_edges_csv(spark, path, sep)) == bag(df)
    path = fresh_path(spark, "sink")
    writers.write_tuples(df, path)
    assert sorted(r["value"] for r in spark.read.text(path).collect()) == ["(1,2)", "(1,2)", "(30,4)"]
    path = fresh_path(spark, "sink")
    writers.write_parquet(df, path)
    assert bag(spark.read.parquet(path)) == bag(df)


def test_ranks_by_iteration(spark):
    ranks, mass = pr.chain_pagerank(spark, 3, 2)
    root = fresh_path(spark, "ranks")
    path = writers.write_ranks(ranks, mass, root, 2, files=1)
    assert path == f"{root}/Iteration2"
    assert spark.read.text(path).count() == 9
    (line,) = spark.read.text(f"{path}/Dummy").collect()
    assert line["value"].startswith("(0,0.42777")


def test_generators(spark):
    open_links = {(i + c * 4, i + 1 + c * 4) for c in range(4) for i in range(1, 4)}
    assert bag(generate.chains_open(spark, 4)) == Counter(open_links)
    closed = open_links | {(4 + c * 4, 0) for c in range(4)}
    assert bag(generate.chains_with_sink(spark, 4)) == Counter(closed)
    assert bag(generate.one_chain(spark, 3)) == Counter([(1, 2), (2, 3), (3, 0)])
    assert generate.chains_open(spark, 1).count() == 0


def test_copy_chains_beyond_one_block(spark):
    ranks = spark.createDataFrame([(1, 0.5)], "id long, rank double")
    ids = [r["id"] for r in generate.copy_chains(ranks, 5000).collect()]
    assert sorted(ids) == [1 + c * 5000 for c in range(5000)]


def successors(rows):
    out = Counter()
    groups = {}
    for g, p, i in rows:
        groups.setdefault(g, []).append((p, i))
    for members in groups.values():
        members.sort()
        out.update((a[1], b[1]) for a, b in zip(members, members[1:]))
    return out


@pytest.mark.parametrize("shape", ["spread", "one_position", "copies"])
def test_heavy_group_is_split_and_whole(spark, shape):
    hot = {
        "spread": [(1, i % 50, (i * 37) % 101) for i in range(600)],
        "one_position": [(1, 1, (i * 37) % 211) for i in range(600)],
        "copies": [(1, 3, 9)] * 5000 + [(1, 1, 4), (1, 5, 4)],
    }[shape]
    rows = hot + [(2 + i // 4, i % 4, i % 13) for i in range(400)]
    df = spark.createDataFrame(rows, "grp long, pos int, id long")
    assert bag(successor_edges(df, floor=100)) == successors(rows) == bag(successor_edges(df, floor=10**9))


def test_no_rows_no_edges(spark):
    assert successor_edges(spark.createDataFrame([], "grp long, pos int, id long")).count() == 0


def test_derived_shapes(spark):
    assert part_sequence_edges(spark, SF).count() == 4527
    served = supplier_customer_edges(spark, SF)
    assert served.count() == 1444
    assert served.filter((F.col("src") % 2 != 0) | (F.col("dst") % 2 != 1)).count() == 0
    assert bag(supplier_customer_edges(spark, SF, floor=2)) == bag(served)


def test_trade_graph_has_hubs_and_cycles(spark):
    sf = "/root/testdata/sf0.01"
    links = link_counts(trade_edges(spark, sf))
    assert hub_nodes(links, floor=300).count() > 0
    kinds = {(r[0], r[1]) for r in links.select(F.col("src") % 3, F.col("dst") % 3).distinct().collect()}
    assert kinds == {(0, 1), (1, 2), (2, 0)}


def test_layouts(edges):
    df = edges([(i, i % 5) for i in range(40)])
    by_modulo = layout.modulo_layout(df, 5, "dst").select("dst", F.spark_partition_id().alias("p"))
    assert all(r["dst"] == r["p"] for r in by_modulo.collect())


def test_observed_counts_while_writing(spark, edges):
    watched, seen = layout.observed(edges([(1, 2), (2, 3)]), f"w{uuid.uuid4().hex}", F.count(F.lit(1)).alias("rows"))
    writers.write_csv(watched, fresh_path(spark, "watched"))
    assert seen.get["rows"] == 2


def test_shared_dir_is_the_configured_one(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_scratch_leaves_nothing(spark, edges):
    """What an operator writes is gone after the result is written and the helper is closed."""
    import os

    from edgeweave.operators.triangles import triangles
    from edgeweave.session import fresh_path, scratch

    out = fresh_path(spark, "result")
    before = set(os.listdir(shared_dir(spark)))
    with scratch(spark):
        triangles(edges([(1, 2), (2, 3), (3, 1)])).write.parquet(out)
        assert set(os.listdir(shared_dir(spark))) - before - {os.path.basename(out)}
    after = {x for x in os.listdir(shared_dir(spark)) if not x.count("-") == 4}  # without Spark's checkpoint folder
    assert after - before == {os.path.basename(out)}
    assert spark.read.parquet(out).count() == 3


def test_local_folders_are_refused_on_a_cluster(spark):
    from types import SimpleNamespace

    from edgeweave import session

    cluster = SimpleNamespace(master="spark://host:7077")
    for folder in ("file:///tmp/x", "/tmp/x", "x"):
        with pytest.raises(ValueError):
            session._refuse_local(cluster, folder)
    session._refuse_local(cluster, "hdfs://host/x")
    session._refuse_local(SimpleNamespace(master="local-cluster[3,2,1024]"), "file:///tmp/x")
