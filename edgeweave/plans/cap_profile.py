"""What an id cap keeps and costs, for several caps in one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from edgeweave.functions.skew import HEAVY_FLOOR
from edgeweave.operators.edges import as_column
from edgeweave.operators.paths import PAIRS, round_trips
from edgeweave.operators.triangles import _product, closed_walks, ranked_links


def cap_profile(
    edges: DataFrame, caps: list[int | Column], floor: int = HEAVY_FLOOR, wide: bool = False, budget: int = PAIRS
) -> DataFrame:
    """``(cap, kept, beyond, two_paths, triangle_rows)`` per cap.

    Every edge, return trip and cycle gets the level of the first cap that admits its largest id;
    a cap then holds what has its level or a lower one. So the graph is searched once, not once
    per cap, and two-hop paths are counted (walks less returns) instead of listed. A count beyond 63
    bits raises; ``wide`` gives decimals for paths and triangles.
    """
    k = len(caps)
    ordered = F.sort_array(F.array(*[as_column(c) for c in caps]))
    number = "decimal(38,0)" if wide else "long"

    def level(largest: Column) -> Column:
        return sum((F.when(as_column(cap) < largest, 1).otherwise(0) for cap in caps), F.lit(0))

    links, count = ranked_links(edges, floor)
    measures = ("edges", "walks", "returns", "rows")

    def at(df: DataFrame, when: Column, **values: Column) -> DataFrame:
        kinds = {m: "long" if m == "edges" else number for m in measures}
        return df.select(when.alias("level"), *[values.get(m, F.lit(0)).cast(kinds[m]).alias(m) for m in measures])

    proper = (F.col("v") != F.col("u")) & (F.col("w") != F.col("u"))
    rows = _product(["n_vw", "n_wu", "n_uv"], wide) * F.when(proper, 3).otherwise(2)
    trips = at(round_trips(links), level(F.greatest("src", "dst")), returns=_product(["n", "back"], wide))
    cycles = at(closed_walks(links, count, budget=budget), level(F.greatest("v", "w", "u")), rows=rows)
    hops = at(_hops(links, level, k, wide), F.col("level"), edges=F.col("edges"), walks=F.col("walks"))

    together = trips.unionByName(cycles).unionByName(hops)
    sums = together.groupBy("level").agg(*[F.sum(m).alias(m) for m in measures])
    # at most k + 1 levels from here on
    up_to = Window.orderBy("level").rowsBetween(Window.unboundedPreceding, 0)
    every = Window.orderBy("level").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    running = sums.select(
        "level",
        F.sum("edges").over(up_to).alias("kept"),
        (F.sum("edges").over(every) - F.sum("edges").over(up_to)).alias("beyond"),
        (F.col("walks") - F.sum("returns").over(up_to)).cast(number).alias("two_paths"),
        F.sum("rows").over(up_to).cast(number).alias("triangle_rows"),
    )
    cap = F.element_at(ordered, F.col("level") + 1)
    return running.filter(F.col("level") < k).select(cap.alias("cap"), "kept", "beyond", "two_paths", "triangle_rows")


def _hops(links: DataFrame, level, k: int, wide: bool) -> DataFrame:
    """Per level the edges that belong to it, and in-degree times out-degree summed up to it.

    One read of the links and one aggregate per node, with a column per level and measure.
    """
    n, zero = F.col("n"), F.lit(0).cast("long")
    ends = links.select(
        level(F.greatest(F.col("src"), F.col("dst"))).alias("level"),
        F.explode(
            F.array(
                F.struct(F.col("src").alias("node"), zero.alias("ins"), n.alias("outs")),
                F.struct(F.col("dst").alias("node"), n.alias("ins"), zero.alias("outs")),
            )
        ).alias("end"),
    ).select("level", "end.*")

    def counted(when: Column, what: str, name: str) -> Column:
        return F.sum(F.when(when, F.col(what)).otherwise(0)).alias(name)

    per_node = ends.groupBy("node").agg(
        *[counted(F.col("level") <= i, "ins", f"m{i}") for i in range(k)],
        *[counted(F.col("level") <= i, "outs", f"n{i}") for i in range(k)],
        *[counted(F.col("level") == i, "outs", f"e{i}") for i in range(k + 1)],
    )
    totals = per_node.agg(
        *[F.sum(_product([f"m{i}", f"n{i}"], wide)).alias(f"w{i}") for i in range(k)],
        *[F.sum(f"e{i}").alias(f"e{i}") for i in range(k + 1)],
    )

    def measured(i: int) -> Column:
        walks = F.coalesce(F.col(f"w{i}") if i < k else zero, zero).cast("decimal(38,0)" if wide else "long")
        return F.struct(F.coalesce(f"e{i}", zero).alias("edges"), walks.alias("walks"))

    per_level = F.array(*[measured(i) for i in range(k + 1)])
    return totals.select(F.posexplode(per_level).alias("level", "both")).select("level", "both.*")
