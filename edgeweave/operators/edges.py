"""Edge-level operators on ``(src, dst)``; all are narrow except ``link_counts`` and the ordering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F



def as_column(value: int | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("long")


def cap_edges(edges: DataFrame, cap: int | Column) -> DataFrame:
    """Edges with both ends at most ``cap``; a literal cap is pushed to the scan."""
    return edges.filter((F.col("src") <= as_column(cap)) & (F.col("dst") <= as_column(cap)))


def edges_beyond_cap(edges: DataFrame, cap: int | Column) -> DataFrame:
    """The edges ``cap_edges`` leaves out."""
    return edges.filter((F.col("src") > as_column(cap)) | (F.col("dst") > as_column(cap)))


def reverse_edges(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))


def distinct_edges(edges: DataFrame) -> DataFrame:
    return edges.select("src", "dst").distinct()


def edge_endpoints(edges: DataFrame) -> DataFrame:
    """Each edge twice: tag O under its source and tag I under its target."""
    return edges.select(
        F.explode(
            F.array(
                F.struct(F.col("src").alias("node"), F.lit("O").alias("tag")),
                F.struct(F.col("dst").alias("node"), F.lit("I").alias("tag")),
            )
        ).alias("end"),
        "src",
        "dst",
    ).select("end.node", "end.tag", "src", "dst")


def link_counts(edges: DataFrame) -> DataFrame:
    """Distinct edges with their number of copies ``n``, combined before the shuffle.

    A group of copies, however large, is one row from here on. Null ends are dropped here so that
    every use of the result has the same filters and shares one exchange.
    """
    return (
        edges.filter(F.col("src").isNotNull() & F.col("dst").isNotNull())
        .groupBy("src", "dst")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def in_links_sorted(edges: DataFrame) -> DataFrame:
    """Reverse links in ``(dst, src)`` order with their copies.

    Ranges run over both columns, so a node with very many in-links spans several of them.
    """
    return link_counts(edges).select("dst", "src", F.col("n").alias("copies")).orderBy("dst", "src")
