"""Two-hop paths a -> b -> c with a != c."""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, functions as F

from edgeweave.functions.skew import (
    BROADCAST_ROWS,
    HEAVY_FLOOR,
    cell_of,
    every_cell,
    heavy_line,
    repeat_rows,
)
from edgeweave.operators.degrees import link_degrees, link_lists, product_type
from edgeweave.operators.edges import link_counts
from edgeweave.session import counted_table

STRATEGIES = ("auto", "merge", "shuffle_hash", "broadcast", "adjacency", "salted")
PAIRS = 1_000_000  # pairs of a way in and a way out that one cell may hold
FEW_COPIES = 16  # a row with more is repeated in pieces that are shuffled apart


def node_degrees(links: DataFrame) -> DataFrame:
    """Distinct in- and out-links per node, ``(node, ins, outs)``.

    The copy count is read although it is always positive: with the same columns this use of
    ``links`` shares the exchange of the others.
    """
    one = F.when(F.col("n") > 0, 1).cast("long")
    zero = F.lit(0).cast("long")
    ends = links.select(
        F.explode(
            F.array(
                F.struct(F.col("src").alias("node"), zero.alias("ins"), one.alias("outs")),
                F.struct(F.col("dst").alias("node"), one.alias("ins"), zero.alias("outs")),
            )
        ).alias("end")
    ).select("end.*")
    ends = ends.filter(F.col("node").isNotNull())  # joins add it anyway, but not to every use
    return ends.groupBy("node").agg(F.sum("ins").alias("ins"), F.sum("outs").alias("outs"))


def degree_line(sizes: DataFrame, floor: int) -> Column:
    """Degree from which a node is a hub."""
    both_ends = sizes.agg(F.coalesce(F.sum(F.col("ins") + F.col("outs")), F.lit(0))).scalar()
    return heavy_line(both_ends / 2, floor)


def parts_of(rows: Column, line: Column) -> Column:
    return F.greatest(F.ceil(rows / line), F.lit(1).cast("long"))


def hub_nodes(links: DataFrame, floor: int = HEAVY_FLOOR) -> DataFrame:
    """Nodes heavy by distinct degree, ``(node, parts)``.

    At most ``sqrt(2 * links)`` rows, so it may be broadcast.
    """
    sizes = node_degrees(links)
    line = degree_line(sizes, floor)
    degree = F.col("ins") + F.col("outs")
    return sizes.filter(degree >= line).select("node", parts_of(degree, line).alias("parts"))


def _first_hops(links: DataFrame) -> DataFrame:
    return links.select(F.col("src").alias("a"), F.col("dst").alias("b"), F.col("n").alias("n1"))


def _second_hops(links: DataFrame) -> DataFrame:
    return links.select(F.col("src").alias("b"), F.col("dst").alias("c"), F.col("n").alias("n2"))


def grid_of(sizes: DataFrame, key: str, budget: int) -> DataFrame:
    """Cells of the nodes that centre more than ``budget`` pairs: ``(key, in_parts, out_parts)``.

    ``sizes`` has ``(key, ins, outs)``. A node with i ways in and o ways out gets a grid whose cells
    hold about ``budget`` pairs whatever the size of the graph: with the side ``sqrt(budget)`` it has
    ``i * min(o, side) / budget`` rows and ``o * min(i, side) / budget`` columns. The repeated rows of
    both sides stay below ``2 / side`` per pair.
    """
    side = F.lit(max(1, isqrt(budget))).cast("long")
    limit = F.lit(budget).cast("long")
    ins, outs = F.col("ins"), F.col("outs")
    parts = lambda n, other: F.greatest(F.ceil(n * F.least(other, side) / limit), F.lit(1)).cast("long")
    crowded = sizes.filter(ins.cast("double") * outs > budget)
    return crowded.select(key, parts(ins, outs).alias("in_parts"), parts(outs, ins).alias("out_parts"))


def grid_join(first: DataFrame, second: DataFrame, key: str, grid: DataFrame | None, spread: tuple[str, str], salts: int = 1, hint: str | None = None) -> DataFrame:
    """Join ways in (``first``) to ways out (``second``) of ``key``, crowded nodes spread over a grid of cells.

    A way in picks a row of the grid by a hash of ``spread[0]`` and goes to all its columns, a way out
    picks a column and goes to all its rows, so each pair meets in exactly one cell. ``grid`` comes in
    by an ordinary join: it may be long, so Spark broadcasts it only when it finds it small, and
    splits the rows of a hub otherwise; None stands for no crowded node. ``salts`` is the least number of
    cells per side of every key.
    """
    if grid is None and salts == 1:
        return first.join(second.hint(hint) if hint else second, key)
    if grid is None:
        count = F.lit(salts).cast("long")
        left = first.withColumns({"gx": cell_of(count, F.col(spread[0])), "gy": every_cell(count)})
        right = second.withColumns({"gx": every_cell(count), "gy": cell_of(count, F.col(spread[1]))})
        return left.join(right.hint(hint) if hint else right, [key, "gx", "gy"]).drop("gx", "gy")
    ins, outs = (F.greatest(F.coalesce(c, F.lit(1).cast("long")), F.lit(salts).cast("long")) for c in ("in_parts", "out_parts"))
    left = first.join(grid, key, "left").withColumns({"gx": cell_of(ins, F.col(spread[0])), "gy": every_cell(outs)})
    right = second.join(grid, key, "left").withColumns({"gx": every_cell(ins), "gy": cell_of(outs, F.col(spread[1]))})
    right = right.drop("in_parts", "out_parts")
    return left.drop("in_parts", "out_parts").join(right.hint(hint) if hint else right, [key, "gx", "gy"]).drop("gx", "gy")


def _grid_join(links: DataFrame, rows: int, hint: str | None, budget: int, salts: int) -> DataFrame:
    """First hops joined to second hops on the middle node; with r links no node centres more than r * r / 4 pairs."""
    grid = None
    if rows * rows > 4 * budget:
        sizes = node_degrees(links).withColumnRenamed("node", "b")
        grid, _, nodes = counted_table(grid_of(sizes, "b", budget), "grid")
        grid = None if not nodes else F.broadcast(grid) if nodes <= BROADCAST_ROWS else grid
    return grid_join(_first_hops(links), _second_hops(links), "b", grid, ("a", "c"), salts, hint)


def _broadcast_join(links: DataFrame) -> DataFrame:
    return _first_hops(links).join(F.broadcast(_second_hops(links)), "b")


def _adjacency_join(links: DataFrame) -> DataFrame:
    lists = link_lists(links).select(F.col("node").alias("b"), F.arrays_zip("neighbours", "copies").alias("pairs"))
    hops = _first_hops(links).join(F.broadcast(lists), "b").select("a", "b", "n1", F.explode("pairs").alias("hop"))
    return hops.select("a", "b", "n1", F.col("hop.neighbours").alias("c"), F.col("hop.copies").alias("n2"))


def two_paths(
    edges: DataFrame,
    strategy: str = "auto",
    distinct: bool = False,
    budget: int = PAIRS,
    salts: int = 16,
    max_broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """All two-hop paths as ``(a, b, c, copies)``; ``distinct`` ignores repeated edges.

    Repeated edges multiply into ``copies``, so they never multiply the rows moved; use
    ``path_rows`` for one row per path and ``two_path_counts`` where a count per start will do.
    ``budget`` is the number of pairs a cell may hold; it does not change the rows. ``merge`` and
    ``shuffle_hash`` name the join, ``salted`` deals every key into ``salts`` buckets per side at least,
    ``broadcast`` and ``adjacency`` ship the edges as rows or as successor lists, if they are counted to
    be at most ``max_broadcast_rows``; else, and for ``auto``, the grid join runs with the join Spark picks.
    """
    _check(strategy)
    shipped = {"broadcast": _broadcast_join, "adjacency": _adjacency_join}
    links, _, rows = counted_table(link_counts(edges), "links")
    if strategy in shipped and rows <= max_broadcast_rows:
        pairs = shipped[strategy](links)
    else:
        hint = strategy if strategy in ("merge", "shuffle_hash") else None
        pairs = _grid_join(links, rows, hint, budget, salts if strategy == "salted" else 1)
    open_pairs = pairs.filter(F.col("a") != F.col("c"))
    if distinct:
        return open_pairs.select("a", "b", "c")
    return open_pairs.select("a", "b", "c", (F.col("n1") * F.col("n2")).alias("copies"))


def _check(strategy: str) -> None:
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}")


def _onward(links: DataFrame, as_list: bool) -> DataFrame:
    """Ways on from each node, ``(b, onward)``, from its links or from its successor list."""
    if as_list:
        size = F.aggregate("copies", F.lit(0).cast("long"), lambda total, n: total + n)
        lists = link_lists(links).select(F.col("node").alias("b"), size.alias("size"))
        return lists.groupBy("b").agg(F.sum("size").alias("onward"))
    return links.groupBy(F.col("src").alias("b")).agg(F.sum("n").alias("onward"))


def two_path_counts(
    edges: DataFrame,
    strategy: str = "auto",
    distinct: bool = False,
    salts: int = 16,
    max_broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Two-hop paths per start node, ``(a, paths)``, for starts that have any; linear in the edges.

    Every link is joined to the number of ways on from its target by the chosen strategy (see
    ``two_paths``), and the trips that return to their start are taken off. ``salted`` deals the links of
    every target into ``salts`` buckets and repeats the target's number once per bucket.
    """
    _check(strategy)
    links = link_counts(edges)
    if distinct:
        links = links.withColumn("n", F.when(F.col("n") > 0, 1).cast("long"))
    onward = _onward(links, strategy == "adjacency")
    hops, on = _first_hops(links), ["b"]
    if strategy in ("broadcast", "adjacency"):
        onward, _, rows = counted_table(onward, "onward")
        onward = F.broadcast(onward) if rows <= max_broadcast_rows else onward
    elif strategy == "salted":
        count, on = F.lit(salts).cast("long"), ["b", "salt"]
        hops, onward = hops.withColumn("salt", cell_of(count, F.col("a"))), onward.withColumn("salt", every_cell(count))
    elif strategy != "auto":
        onward = onward.hint(strategy)
    walks = hops.join(onward, on).select("a", (F.col("n1") * F.col("onward")).alias("paths"))
    returns = round_trips(links).select(F.col("src").alias("a"), (-F.col("n") * F.col("back")).alias("paths"))
    return walks.unionByName(returns).groupBy("a").agg(F.sum("paths").alias("paths")).filter("paths > 0")


def path_rows(paths: DataFrame, spread: bool = True) -> DataFrame:
    """One row per path or triangle instead of a copy count.

    A row with few copies is repeated where it stands, so the listing itself is not shuffled; with ``spread`` the
    others become pieces, which are dealt out. Both read the same exchanges, and a piece stands for more
    than ``FEW_COPIES`` rows, but for the last one of its row.
    """
    if not spread:
        return repeat_rows(paths, "copies")
    few = F.col("copies") <= FEW_COPIES
    usual = repeat_rows(paths.filter(few), "copies")
    return usual.unionByName(repeat_rows(paths.filter(~few), "copies", spread=True))


def round_trips(links: DataFrame) -> DataFrame:
    """Links with the copies ``back`` of their opposite link, a loop being its own opposite."""
    there = links.select("src", "dst", "n")
    back = links.select(F.col("dst").alias("src"), F.col("src").alias("dst"), F.col("n").alias("back"))
    return there.join(back, ["src", "dst"])


def two_paths_count(edges: DataFrame, wide: bool = False) -> DataFrame:
    """Number of two-hop paths with a != c, by counting instead of listing.

    All walks of two edges (the sum of m * n) less those that return to their start. The work
    grows with the edges, not with the paths, and both parts read one exchange of counted links.
    """
    links, zero = link_counts(edges), F.lit(0)

    def products(df: DataFrame, one: str, other: str) -> DataFrame:
        kind = product_type(wide)
        return df.agg(F.coalesce(F.sum(F.col(one).cast(kind) * F.col(other).cast(kind)), zero).alias("total"))

    returns = products(round_trips(links), "n", "back").scalar()
    return products(link_degrees(links), "m", "n").select((F.col("total") - returns).alias("n"))
