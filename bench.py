"""Time the headline queries; prints one JSON line.

``python bench.py --skew`` times counts and ranks on skewed graphs made in Spark instead: a power-law graph
of BENCH_EDGES edges (default 5 million), and line items of BENCH_SF_DIR with a third on one order.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from edgeweave.operators.paths import two_paths_count  # noqa: E402
from edgeweave.operators.triangles import triangle_count  # noqa: E402
from edgeweave.plans.pagerank import pagerank  # noqa: E402
from edgeweave.registry import queries  # noqa: E402
from edgeweave.session import local_session, scratch  # noqa: E402
from edgeweave.sources.derived import successor_edges  # noqa: E402

HEADLINE = [
    "follower_count",
    "two_path_cardinality",
    "two_paths_count",
    "two_paths_shuffle",
    "two_paths_merge",
    "two_paths_broadcast",
    "triangles",
    "triangles_broadcast",
    "triangles_canonical",
    "triangle_count",
    "cap_profile",
    "adjacency_list",
    "scan_edges_csv",
    "pagerank",
    "pagerank_broadcast",
    "pagerank_dangling",
    "pagerank_trade",
    "triangle_count_trade",
]


def skew(spark, sf_dir: str) -> dict[str, float]:
    """Seconds of counting and ranking where a few nodes, or one order, hold a large part of the rows."""
    rows = int(os.environ.get("BENCH_EDGES", "5000000"))
    node = lambda seed: F.floor(F.pow(F.rand(seed), F.lit(3.0)) * (rows // 25)).cast("long")
    power_law = spark.range(rows).select(node(1).alias("src"), node(2).alias("dst"))
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    order = F.when(F.col("l_partkey") % 3 == 0, F.lit(1)).otherwise(F.col("l_orderkey"))
    hot = items.select(order.alias("grp"), F.col("l_linenumber").alias("pos"), F.col("l_partkey").alias("id"))
    builds = {
        "two_paths_count": lambda: two_paths_count(power_law),
        "triangle_count": lambda: triangle_count(power_law, wide=True),
        "pagerank_3": lambda: pagerank(power_law, 3),
        "successors_hot_order": lambda: successor_edges(hot),
    }
    times: dict[str, float] = {}
    for name, build in builds.items():
        start = time.perf_counter()
        with scratch(spark):
            build().write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    return times


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    shared = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark = local_session(cpus, "bench", **{"spark.checkpoint.dir": shared, "spark.local.dir": shared})
    if "--skew" in sys.argv:
        times = skew(spark, sf_dir)
        spark.stop()
        print(json.dumps({"metric": "skewed graphs, total wall time", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times}))
        return
    known = queries()
    wanted = os.environ.get("BENCH_QUERIES")
    names = wanted.split(",") if wanted else HEADLINE
    for name in ("follower_count", "two_paths_count", "triangles"):  # warm-up
        known[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        start = time.perf_counter()
        with scratch(spark):
            known[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
