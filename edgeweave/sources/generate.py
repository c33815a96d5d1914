"""Chain graphs: k chains of k nodes, node i of chain c has the id ``i + c * k``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from edgeweave.functions.skew import PIECE


def chains_open(spark: SparkSession, k: int) -> DataFrame:
    """The k - 1 links inside each of the k chains."""
    width = max(k - 1, 1)
    src = F.expr(f"id % {width} + 1 + (id div {width}) * {k}")
    return spark.range(k * (k - 1)).select(src.alias("src"), (src + 1).alias("dst"))


def chains_with_sink(spark: SparkSession, k: int) -> DataFrame:
    """All k chains, the last node of each linked to the sink 0: k * k links."""
    src = F.col("id")
    return spark.range(1, k * k + 1).select(
        src.alias("src"), F.when(src % k == 0, F.lit(0)).otherwise(src + 1).alias("dst")
    )


def one_chain(spark: SparkSession, k: int) -> DataFrame:
    """The first chain alone, closed by the sink 0."""
    src = F.col("id")
    return spark.range(1, k + 1).select(src.alias("src"), F.when(src == k, F.lit(0)).otherwise(src + 1).alias("dst"))


def copy_chains(ranks: DataFrame, k: int) -> DataFrame:
    """Repeat the ranks ``(id, rank)`` of one chain for all k chains.

    A narrow step: k is unrolled in blocks, so no array has more than ``PIECE`` items.
    """
    block = F.explode(F.sequence(F.lit(0).cast("long"), F.lit((k - 1) // PIECE).cast("long")))
    inner = F.explode(
        F.sequence(F.col("block") * PIECE, F.least(F.lit(k - 1).cast("long"), F.col("block") * PIECE + PIECE - 1))
    )
    out = ranks.withColumn("block", block).withColumn("chain", inner)
    return out.select((F.col("id") + F.col("chain") * k).alias("id"), "rank")
