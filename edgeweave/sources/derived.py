"""Edge tables derived from the supplied relational tables (none of them is a graph)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from edgeweave.functions.skew import HEAVY_FLOOR, heavy_keys, join_unique, repeat_rows


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _whole(df: DataFrame, *columns: str) -> DataFrame:
    """Rows without nulls, said so that joins need not add the same filters again."""
    for c in columns or df.columns:
        df = df.filter(F.col(c).isNotNull())
    return df


def successor_edges(rows: DataFrame, floor: int = HEAVY_FLOOR) -> DataFrame:
    """Edges from each ``id`` to the next one of its ``grp``, in the order ``(pos, id)``.

    Groups of ordinary size take one window over one shuffle. A heavy group would put a window on
    one task, so it goes through ``_split_successors``. Both are branches of one lazy plan; the list
    of heavy groups is an aggregate in it, broadcast within the bound of ``functions.skew``.
    """
    heavy = F.broadcast(heavy_keys(rows, "grp", floor).select("grp"))
    usual = _window_successors(rows.join(heavy, "grp", "left_anti"))
    return usual.unionByName(_split_successors(rows.join(heavy, "grp", "left_semi")))


def _window_successors(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("grp").orderBy("pos", "id")
    return (
        rows.select("grp", "pos", "id", F.lead("id").over(order).alias("dst"))
        .filter(F.col("dst").isNotNull())
        .select(F.col("id").alias("src"), "dst")
    )


def _split_successors(rows: DataFrame) -> DataFrame:
    """The same edges for groups too large for one task, each row passing through once.

    Equal rows fold into counts. The distinct rows are range partitioned by ``(grp, pos, id)``, so
    one group spans many ranges (cells). A window per group and cell finds the successors inside.
    Each row then goes on as its finished edges, spread by a hash, and the first and last row of a
    cell also as an end; the ends of a group, two per cell, meet in a second window, which links
    the last row of a cell to the first one of the next.
    """
    counted = rows.groupBy("grp", "pos", "id").agg(F.count(F.lit(1)).alias("n"))
    ranged = counted.repartitionByRange("grp", "pos", "id").withColumn("cell", F.spark_partition_id())
    inside = Window.partitionBy("grp", "cell").orderBy("pos", "id")
    found = ranged.select(
        "grp", "cell", "pos", "id", "n", F.lead("id").over(inside).alias("dst"), F.row_number().over(inside).alias("place")
    )

    def item(holds: Column, end: int, dst: Column, n: Column) -> Column:
        return F.when(holds, F.struct(F.lit(end).alias("end"), dst.alias("dst"), n.cast("long").alias("n")))

    one, none = F.lit(1), F.lit(None).cast("long")
    items = F.array(
        item(F.col("dst").isNotNull(), 0, F.col("dst"), one),
        item(F.col("n") > 1, 0, F.col("id"), F.col("n") - 1),
        item(F.col("place") == 1, 1, none, one),
        item(F.col("dst").isNull(), 2, none, one),
    )
    each = found.select("grp", "cell", "pos", F.col("id").alias("src"), F.explode(F.array_compact(items)).alias("item"))
    each = each.select("grp", "cell", "src", "pos", "item.*")
    apart = F.when(F.col("end") == 0, F.xxhash64("cell", "pos", "src")).otherwise(0)
    across = Window.partitionBy("grp", apart).orderBy("cell", "end")
    stitched = F.when(F.col("end") == 2, F.lead("src").over(across)).otherwise(F.col("dst"))
    linked = each.select("src", stitched.alias("dst"), "n", "end").filter("end <> 1").drop("end")
    return repeat_rows(linked.filter(F.col("dst").isNotNull()), "n", spread=True)


def part_sequence_edges(spark: SparkSession, sf_dir: str, floor: int = HEAVY_FLOOR) -> DataFrame:
    """Part -> part bought next in the same order: a multigraph with self-loops."""
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("grp"), F.col("l_linenumber").alias("pos"), F.col("l_partkey").alias("id")
    )
    return successor_edges(_whole(rows, "id", "grp"), floor)


def supplier_customer_edges(spark: SparkSession, sf_dir: str, floor: int = HEAVY_FLOOR) -> DataFrame:
    """Supplier -> customer served, each pair once; every customer is without out-links.

    Suppliers get even ids and customers odd ones, so the two sets never meet at any scale.
    """
    lines = _whole(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey"))
    orders = _whole(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"))
    served = join_unique(lines.distinct(), orders, "l_orderkey", ["l_suppkey"], floor)
    return served.select(
        (F.col("l_suppkey") * 2).alias("src"), (F.col("o_custkey") * 2 + 1).alias("dst")
    ).distinct()


def trade_edges(spark: SparkSession, sf_dir: str, floor: int = HEAVY_FLOOR) -> DataFrame:
    """Supplier -> customer served, customer -> nation, nation -> its suppliers: cycles through hubs.

    Ids are three times the table's id, plus 1 for customers and 2 for nations.
    """
    served = supplier_customer_edges(spark, sf_dir, floor)
    served = served.select(F.expr("src div 2 * 3").alias("src"), F.expr("(dst - 1) div 2 * 3 + 1").alias("dst"))

    def homes(name: str, key: str, nation: str, from_nation: bool) -> DataFrame:
        rows = _whole(table(spark, sf_dir, name).select(key, nation))
        there = F.expr(f"{key} * 3 + {0 if from_nation else 1}")
        home = F.expr(f"cast({nation} as long) * 3 + 2")
        src, dst = (home, there) if from_nation else (there, home)
        return rows.select(src.alias("src"), dst.alias("dst"))

    customers = homes("customer", "c_custkey", "c_nationkey", False)
    return served.unionByName(customers).unionByName(homes("supplier", "s_suppkey", "s_nationkey", True))
