"""Follower counts, degrees, two-hop path sizes and adjacency."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from edgeweave.functions.skew import HEAVY_FLOOR, heavy_keys
from edgeweave.operators.edges import cap_edges, edges_beyond_cap, link_counts
from edgeweave.session import cut_lineage

BLOCK_WIDTH = 65_536


def _followed(edges: DataFrame, modulus: int) -> DataFrame:
    ids = edges.select(F.col("dst").alias("id"))
    return ids.filter(F.col("id") % modulus == 0) if modulus != 1 else ids.filter(F.col("id").isNotNull())


def follower_count(edges: DataFrame, modulus: int = 100) -> DataFrame:
    """Followers per id, for ids divisible by ``modulus`` (1 for all)."""
    return _followed(edges, modulus).groupBy("id").agg(F.count(F.lit(1)).alias("followers"))


def follower_count_aggregate(edges: DataFrame, modulus: int = 100) -> DataFrame:
    """The same from zero by a conditional count."""
    return _followed(edges, modulus).groupBy("id").agg(F.count_if(F.col("id").isNotNull()).alias("followers"))


def follower_count_fold(edges: DataFrame, modulus: int = 100) -> DataFrame:
    """The same by folding ones into zero."""
    ones = F.coalesce(F.sum(F.lit(1).cast("long")), F.lit(0).cast("long"))
    return _followed(edges, modulus).groupBy("id").agg(ones.alias("followers"))


def follower_count_grouped(edges: DataFrame, modulus: int = 100) -> DataFrame:
    """The same by grouping the followers first: copies per link, then the sum over the group.

    Building a list per id would hold a popular id in one task, so the group stays rows.
    """
    wanted = edges.filter(F.col("dst") % modulus == 0) if modulus != 1 else edges
    return link_counts(wanted).groupBy(F.col("dst").alias("id")).agg(F.sum("n").alias("followers"))


def follower_count_reduce(edges: DataFrame, modulus: int = 100) -> DataFrame:
    """The same as a sum of pairs ``(id, 1)``."""
    pairs = _followed(edges, modulus).withColumn("one", F.lit(1).cast("long"))
    return pairs.groupBy("id").agg(F.sum("one").alias("followers"))


def degrees(edges: DataFrame) -> DataFrame:
    """In-degree ``m`` and out-degree ``n`` of every node, in one pass and one combined shuffle."""
    return link_degrees(edges.select("src", "dst", F.lit(1).cast("long").alias("n")))


def link_degrees(links: DataFrame) -> DataFrame:
    """The degrees from counted links, for plans that have these at hand."""
    n, zero = F.col("n"), F.lit(0).cast("long")
    ends = links.select(
        F.explode(
            F.array(
                F.struct(F.col("src").alias("node"), zero.alias("m"), n.alias("n")),
                F.struct(F.col("dst").alias("node"), n.alias("m"), zero.alias("n")),
            )
        ).alias("end")
    ).select("end.*")
    ends = ends.filter(F.col("node").isNotNull())
    return ends.groupBy("node").agg(F.sum("m").alias("m"), F.sum("n").alias("n"))


def out_degree(edges: DataFrame) -> DataFrame:
    return edges.groupBy(F.col("src").alias("node")).agg(F.count(F.lit(1)).alias("out_degree"))


def product_type(wide: bool) -> str:
    """Type of a degree that is to be multiplied: the product of two has up to 38 digits if wide."""
    return "decimal(19,0)" if wide else "long"


def two_path_cardinality(edges: DataFrame, cap: int | Column | None = None, wide: bool = False) -> DataFrame:
    """Two-hop paths through each node, ``m * n``, without listing them; X-Y-X paths count.

    A product beyond 63 bits raises; ``wide`` switches to a 38-digit decimal.
    """
    kept = edges if cap is None else cap_edges(edges, cap)
    kind = product_type(wide)
    both = degrees(kept).filter((F.col("m") != 0) & (F.col("n") != 0))
    return both.withColumn("paths", F.col("m").cast(kind) * F.col("n").cast(kind))


def two_path_total(edges: DataFrame, cap: int | Column | None = None, wide: bool = False) -> DataFrame:
    total = F.sum("paths")
    return two_path_cardinality(edges, cap, wide).agg(total.alias("total"))


def two_path_running_total(edges: DataFrame, wide: bool = False) -> DataFrame:
    """Running sum of the two-hop paths in node order.

    One ordered window would hold all nodes in one task. The nodes are range partitioned instead
    (the checkpoint fixes the ranges), each range gets its own window, and the totals of the
    ranges before it, one row per partition, come in by a broadcast of that bounded size.
    """
    sizes = two_path_cardinality(edges, wide=wide).select("node", "paths")
    ranged = cut_lineage(sizes.repartitionByRange("node").withColumn("cell", F.spark_partition_id()))
    before = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("cell").agg(F.sum("paths").alias("paths"))
    offsets = totals.select("cell", F.coalesce(F.sum("paths").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("cell").orderBy("node").rowsBetween(Window.unboundedPreceding, 0)
    return ranged.join(F.broadcast(offsets), "cell").select(
        "node", "paths", (F.sum("paths").over(inside) + F.col("offset")).alias("running")
    )


def edges_beyond_cap_by_src(edges: DataFrame, cap: int | Column) -> DataFrame:
    return edges_beyond_cap(edges, cap).groupBy("src").agg(F.count(F.lit(1)).alias("n"))


def edges_beyond_cap_total(edges: DataFrame, cap: int | Column) -> DataFrame:
    return edges_beyond_cap(edges, cap).agg(F.count(F.lit(1)).alias("n"))


def heavy_sources(links: DataFrame, floor: int = HEAVY_FLOOR) -> DataFrame:
    """Sources with heavy distinct out-degree, ``(src, rows, parts)``."""
    return heavy_keys(links, "src", floor, F.count_if(F.col("n") > 0))


def _blocks(links: DataFrame, width: int) -> DataFrame:
    """Links with the block of each: the position among its source's successors, in order, div ``width``.

    The rule is the same for every node, so a node's rows depend on its own links only. The links
    are range partitioned by ``(src, dst)``, which spreads a hub over many ranges (the checkpoint
    fixes them); positions count inside a range, and sources that reach over a range's edge (at most
    one more than there are ranges) get the counts of the ranges before by a broadcast of that size.
    """
    ranged = cut_lineage(links.repartitionByRange("src", "dst").withColumn("cell", F.spark_partition_id()))
    inside = Window.partitionBy("src", "cell").orderBy("dst")
    sizes = ranged.groupBy("src", "cell").agg(F.count(F.lit(1)).alias("rows"))
    before = Window.partitionBy("src").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("src", "cell", F.sum("rows").over(before).alias("offset")).filter(F.col("offset") > 0)
    placed = ranged.withColumn("place", F.row_number().over(inside) - 1)
    placed = placed.join(F.broadcast(offsets), ["src", "cell"], "left")
    block = F.expr(f"(place + coalesce(offset, 0L)) div {width}")
    return placed.select(F.col("src").alias("node"), block.alias("block"), "dst", "n")


def adjacency_list(edges: DataFrame, width: int = BLOCK_WIDTH) -> DataFrame:
    """Successors of each node in order, repeated edges as ``copies`` beside them.

    One row per node and ``width`` successors.
    """
    return link_lists(link_counts(edges), width)


def link_lists(links: DataFrame, width: int = BLOCK_WIDTH) -> DataFrame:
    """``adjacency_list`` from counted links."""
    pairs = F.array_sort(F.collect_list(F.struct("dst", "n")))
    grouped = _blocks(links, width).groupBy("node", "block").agg(pairs.alias("pairs"))
    return grouped.select("node", "block", F.col("pairs.dst").alias("neighbours"), F.col("pairs.n").alias("copies"))


def adjacency_set(edges: DataFrame, width: int = BLOCK_WIDTH) -> DataFrame:
    """Distinct successors of each node in order, in the same blocks."""
    return link_blocks(link_counts(edges), width)


def link_blocks(links: DataFrame, width: int = BLOCK_WIDTH) -> DataFrame:
    """``adjacency_set`` from counted links."""
    nodes = F.array_sort(F.collect_list("dst"))
    return _blocks(links, width).groupBy("node", "block").agg(nodes.alias("neighbours"))


def top_two_path_nodes(edges: DataFrame, k: int = 20) -> DataFrame:
    """The k nodes with most two-hop paths."""
    sizes = two_path_cardinality(edges).select(F.col("node").alias("id"), F.col("paths").alias("value"))
    return sizes.orderBy(F.desc("value"), "id").limit(k)
