"""The shared folder on a cluster: a path without a remote scheme may be a mount, so a trial decides."""

import os

import pytest

from compare import connect, spark_bag, sql_bag
from edgeweave import oracles, registry, session

QUERIES = [
    "adjacency_list",
    "adjacency_set",
    "adjacency_trade",
    "cap_profile",
    "edges_cap_by_files",
    "extract_edges_regex",
    "left_join_default",
    "pagerank",
    "pagerank_broadcast",
    "pagerank_bucketed",
    "pagerank_dangling",
    "pagerank_dangling_mass",
    "pagerank_every_five",
    "pagerank_exact",
    "pagerank_iter1",
    "pagerank_sink",
    "pagerank_step_record",
    "pagerank_trade",
    "ranks_partition",
    "ranks_roundtrip",
    "scan_edges_csv",
    "scan_edges_text",
    "scan_edges_tokens",
    "sink_roundtrip_csv",
]

# Tables and checkpoints of these have to lie in the warehouse where executors have temporary folders of their own.
IN_WAREHOUSE = [
    "adjacency_set",
    "adjacency_trade",
    "cap_profile",
    "edges_cap_by_files",
    "extract_edges_regex",
    "left_join_default",
    "pagerank",
    "pagerank_broadcast",
    "pagerank_bucketed",
    "pagerank_dangling",
    "pagerank_dangling_mass",
    "pagerank_every_five",
    "pagerank_exact",
    "pagerank_iter1",
    "pagerank_sink",
    "pagerank_step_record",
    "pagerank_trade",
    "ranks_partition",
    "ranks_roundtrip",
    "scan_edges_csv",
    "scan_edges_text",
    "scan_edges_tokens",
]


@pytest.fixture
def cluster(spark, monkeypatch):
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    monkeypatch.setattr(session, "_tried", set())
    return spark


@pytest.fixture(scope="module")
def tables(tmp_path_factory):
    """Lines of some orders over few parts, so that every cap leaves paths and cycles, and who sold and bought them."""
    folder = tmp_path_factory.mktemp("tables")
    con = connect(folder)
    part = "if(i // 4 % 5 = 0, i % 4 % 3, i * 7919 % 1009 % 16) + 1"  # every fifth order has parts 1, 2, 3, 1
    lines = f"select i // 4 as l_orderkey, (i % 4 + 1)::int as l_linenumber, {part} as l_partkey, i % 7 + 1 as l_suppkey"
    rows = {
        "lineitem": f"{lines} from range(400) t(i)",
        "orders": "select i as o_orderkey, i % 11 + 1 as o_custkey from range(100) t(i)",
        "customer": "select i + 1 as c_custkey, (i % 2)::int as c_nationkey from range(11) t(i)",
        "supplier": "select i + 1 as s_suppkey, (i % 2)::int as s_nationkey from range(7) t(i)",
        "nation": "select i::int as n_nationkey from range(2) t(i)",
    }
    for name, sql in rows.items():
        con.execute(f"copy ({sql}) to '{folder}/{name}.parquet' (format parquet)")
    return str(folder)


@pytest.mark.parametrize("name", QUERIES)
def test_query_runs_with_a_mounted_folder(cluster, tables, name):
    got_columns, got = spark_bag(registry.queries()[name](cluster, tables))
    want_columns, want = sql_bag(connect(tables), oracles.oracle_sql()[name])
    assert got_columns == want_columns
    assert sum(got.values()) > 0
    assert got == want


def test_trial_once_and_nothing_left(cluster):
    folder = cluster.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    assert session.shared_dir(cluster) == folder
    assert not [x for x in set(os.listdir(folder)) - before if x.startswith("trial-")]
    assert session._tried == {(cluster.sparkContext.applicationId, folder)}


def test_folder_that_cannot_be_written_is_refused(cluster):
    with pytest.raises(ValueError, match="may be local"):
        session._refuse_unshared(cluster, "file:///proc/nowhere")


def test_folder_that_loses_rows_is_refused(cluster, tmp_path, monkeypatch):
    """As when executors on other machines write their parts where the driver does not see them."""
    monkeypatch.setattr(session, "TRIAL_TASKS", 3)
    whole = type(cluster).range
    monkeypatch.setattr(type(cluster), "range", lambda self, *bounds: whole(self, *bounds).filter("id <> 1"))
    with pytest.raises(ValueError, match="may be local"):
        session._refuse_unshared(cluster, str(tmp_path))
    assert not session._tried


def test_cluster_without_a_folder_uses_the_warehouse(cluster, tmp_path, monkeypatch):
    chosen = []
    conf = {"spark.sql.warehouse.dir": str(tmp_path)}
    context = cluster.sparkContext
    monkeypatch.setattr(type(cluster.conf), "get", lambda self, key, default=None: conf.get(key, default))
    monkeypatch.setattr(type(context), "getCheckpointDir", lambda self: chosen[-1] if chosen else None)
    monkeypatch.setattr(type(context), "setCheckpointDir", lambda self, folder: chosen.append(folder))
    found = session.shared_dir(cluster)
    assert [found] == chosen
    assert found.startswith(f"{tmp_path}/edgeweave-")


@pytest.fixture
def local_cluster(cluster, monkeypatch, tmp_path):
    """Executors beside the driver, each with a temporary folder of its own, and no checkpoint folder named."""
    context, chosen = cluster.sparkContext, []
    real, set_folder, get = context.getCheckpointDir(), context.setCheckpointDir, type(cluster.conf).get
    named = {"spark.checkpoint.dir": None, "spark.sql.warehouse.dir": str(tmp_path)}
    monkeypatch.setattr(context, "master", "local-cluster[3,2,3000]")
    monkeypatch.setattr(type(cluster.conf), "get", lambda self, key, *rest: named[key] if key in named else get(self, key, *rest))
    monkeypatch.setattr(type(context), "getCheckpointDir", lambda self: chosen[-1] if chosen else None)
    monkeypatch.setattr(type(context), "setCheckpointDir", lambda self, folder: (chosen.append(folder), set_folder(folder)))
    yield cluster
    set_folder(real or cluster.conf._jconf.get("spark.checkpoint.dir"))


@pytest.mark.parametrize("master, inside", [("local", True), ("local[*]", True), ("local[4]", True), ("local-cluster[3,2,3000]", False), ("yarn", False)])
def test_only_a_local_master_runs_tasks_in_the_driver(cluster, monkeypatch, master, inside):
    monkeypatch.setattr(cluster.sparkContext, "master", master)
    assert session._one_process(cluster.sparkContext) is inside


def test_local_cluster_keeps_tables_and_checkpoints_in_the_warehouse(local_cluster, tmp_path):
    rows = local_cluster.range(0, 20, 1, 4)
    kept, path = session.written_table(rows, "kept")
    cut = session.cut_lineage(rows)
    (folder,) = tmp_path.iterdir()
    assert path.startswith(f"{folder}/kept-")
    assert any(x.startswith("rdd-") for _, inside, _ in os.walk(folder) for x in inside)
    assert kept.count() == cut.count() == 20


@pytest.mark.parametrize("name", IN_WAREHOUSE)
def test_query_on_a_local_cluster_without_a_folder(local_cluster, tables, tmp_path, name):
    got_columns, got = spark_bag(registry.queries()[name](local_cluster, tables))
    want_columns, want = sql_bag(connect(tables), oracles.oracle_sql()[name])
    assert list(tmp_path.iterdir())
    assert got_columns == want_columns
    assert sum(got.values()) > 0
    assert got == want
