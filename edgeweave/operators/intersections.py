"""Directed three-cycles by intersecting neighbour sets, link by link, without listing two-hop paths.

Nodes are ordered by degree, then id. The sets of a node hold its successors and its predecessors above it
in that order, at most ``2 * sqrt(E)`` of them however large the hub. In a cycle over three nodes one
is lowest and one in the middle, and the link between these two finds the third by one intersection:

* lowest -> middle: the successors above the middle that are predecessors above the lowest;
* middle -> lowest: the predecessors above the middle that are successors above the lowest.

**Blocks.** A set is cut into blocks by a hash of its members, a power of two of them, so that a block has
about ``width / 2`` members; successors and predecessors of a node are two sets, each with its own number of blocks. The block of a small set meets every block of a large one whose
number ends in its own bits; a link so becomes as many rows as the larger of its two sets has blocks. A row
carries one block to the other, both of bounded size. Links of a hub are spread over cells,
which each get a copy of the hub's few blocks.

Walks through a loop have two nodes only and come from links that run both ways.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from edgeweave.functions.skew import HEAVY_FLOOR, cell_of, every_cell
from edgeweave.operators.triangles import ascending, canonical, ranked_links, rotated
from edgeweave.session import written_table

WIDTH = 128


def _oriented(ranked: DataFrame, width: int) -> DataFrame:
    """``(node, other, n, out, parts, other_parts, own_bits, far_bits)``: every link but loops, from its lower end.

    ``out`` tells the direction, ``parts`` are the cells of either end as a hub. ``own_bits`` say how many blocks
    the set that the link belongs to has, successors or predecessors, and ``far_bits`` the other set of ``node``.
    """
    up = ascending()
    low = lambda name: F.when(up, F.col(f"src{name}")).otherwise(F.col(f"dst{name}"))
    high = lambda name: F.when(up, F.col(f"dst{name}")).otherwise(F.col(f"src{name}"))
    links = ranked.filter("src <> dst").select(
        low("").alias("node"), high("").alias("other"), "n", up.alias("out"), low("_parts").alias("parts"), high("_parts").alias("other_parts")
    )
    own = Window.partitionBy("node")
    out = F.col("out")
    bits = lambda size: F.greatest(F.ceil(F.log2(size * 2 / width)), F.lit(0)).cast("int")
    links = links.withColumns({"outs": F.count_if(out).over(own), "ins": F.count_if(~out).over(own)})
    pick = lambda if_out, if_in: F.when(out, F.col(if_out)).otherwise(F.col(if_in))
    links = links.withColumns({"own_bits": bits(pick("outs", "ins")), "far_bits": F.when(pick("ins", "outs") > 0, bits(pick("ins", "outs")))})
    return links.drop("outs", "ins")


def neighbour_blocks(oriented: DataFrame) -> DataFrame:
    """``(node, out, block, bits, parts, succ, pred, ns)``: members above the node in order of id, and their copies.

    ``out`` tells blocks of successors from those of predecessors; the column of the others is empty.
    """
    blocked = oriented.withColumn("block", F.expr("xxhash64(other) & (shiftleft(1L, own_bits) - 1)"))
    found = blocked.groupBy("node", "out", "block").agg(
        F.first("own_bits").alias("bits"),
        F.first("parts").alias("parts"),
        F.array_sort(F.collect_list(F.struct(F.col("other").alias("id"), "n"))).alias("members"),
    )
    ids, none = F.col("members.id"), F.array().cast("array<long>")
    succ, pred = F.when(F.col("out"), ids).otherwise(none), F.when(F.col("out"), none).otherwise(ids)
    return found.select("node", "out", "block", "bits", "parts", succ.alias("succ"), pred.alias("pred"), F.col("members.n").alias("ns"))


def _meetings(oriented: DataFrame, blocks: DataFrame) -> DataFrame:
    """Each link with one block of either end's set: ``(node, other, n, out, near, near_n, far, far_n)``, near the middle node's.

    A link to the middle meets the middle's successors with the node's predecessors, a link from it the others. Its
    node may have none of these; then nothing can meet, and the link stays behind.
    """
    ids = F.when(F.col("out"), F.col("succ")).otherwise(F.col("pred"))
    middle = blocks.select(
        F.col("node").alias("other"), "out", F.col("block").alias("near_block"), F.col("bits").alias("near_bits"),
        ids.alias("near"), F.col("ns").alias("near_n"), every_cell(F.col("parts")).alias("cell"),
    )
    links = oriented.filter(F.col("far_bits").isNotNull())
    links = links.select("node", "other", "n", "out", "far_bits", cell_of(F.col("other_parts"), F.col("node")).alias("cell"))
    met = links.join(middle, ["other", "out", "cell"])
    # the lower end's blocks whose number agrees with the middle's block in the bits that both have
    first = "(near_block & (shiftleft(1L, least(far_bits, near_bits)) - 1))"
    step = "shiftleft(1L, least(far_bits, near_bits))"
    numbers = f"explode(sequence({first}, {first} + (shiftleft(1L, greatest(far_bits - near_bits, 0)) - 1) * {step}, {step}))"
    placed = met.select("node", "other", "n", "out", "near", "near_n", F.expr(numbers).alias("block"))
    lowest = blocks.select("node", (~F.col("out")).alias("out"), "block", ids.alias("far"), F.col("ns").alias("far_n"))
    return placed.join(lowest, ["node", "out", "block"]).drop("block")


def _intersected(meetings: DataFrame) -> DataFrame:
    """Cycles over three nodes, from the members that both blocks have."""
    common = F.array_intersect("near", "far")
    found = meetings.withColumn("common", common).filter(F.size("common") > 0)
    copies = lambda block, x: F.get(F.col(f"{block}_n"), F.array_position(F.col(block), x).cast("int") - 1)
    thirds = F.transform("common", lambda x: F.struct(x.alias("third"), copies("near", x).alias("near_n"), copies("far", x).alias("far_n")))
    rows = found.select("node", "other", "n", "out", F.inline(thirds))
    out = F.col("out")
    pick = lambda if_out, if_in, name: F.when(out, F.col(if_out)).otherwise(F.col(if_in)).alias(name)
    return rows.select(
        F.col("node").alias("v"),
        pick("other", "third", "w"),
        pick("third", "other", "u"),
        pick("n", "far_n", "n_vw"),
        F.col("near_n").alias("n_wu"),
        pick("far_n", "n", "n_uv"),
    )


def _through_loops(ranked: DataFrame) -> DataFrame:
    """Walks of three edges over two nodes: there, back, and a loop at either end."""
    up = ranked.filter(ascending()).select(F.col("src").alias("v"), F.col("dst").alias("x"), F.col("n").alias("there"))
    down = ranked.filter(~ascending() & (F.col("src") != F.col("dst")))
    down = down.select(F.col("dst").alias("v"), F.col("src").alias("x"), F.col("n").alias("back"))
    both = up.join(down, ["v", "x"])
    loops = ranked.filter("src = dst").select(F.col("src").alias("at"), F.col("n").alias("loop"))
    low = both.join(loops, F.col("v") == F.col("at"))
    low = low.select("v", F.col("x").alias("w"), F.col("v").alias("u"), F.col("there").alias("n_vw"), F.col("back").alias("n_wu"), F.col("loop").alias("n_uv"))
    high = both.join(loops, F.col("x") == F.col("at"))
    high = high.select("v", F.col("x").alias("w"), F.col("x").alias("u"), F.col("there").alias("n_vw"), F.col("loop").alias("n_wu"), F.col("back").alias("n_uv"))
    return low.unionByName(high)


def intersected_walks(ranked: DataFrame, width: int = WIDTH) -> DataFrame:
    """The rows of ``closed_walks``, found by intersections: ``(v, w, u, n_vw, n_wu, n_uv)``.

    The oriented links and the blocks are tables in the shared folder, as the links meet the blocks twice.
    """
    oriented, _ = written_table(_oriented(ranked, width), "oriented-links")
    blocks, _ = written_table(neighbour_blocks(oriented), "neighbour-blocks")
    return _intersected(_meetings(oriented, blocks)).unionByName(_through_loops(ranked))


def intersected_triangles(
    edges: DataFrame, kind: str = "multi", floor: int = HEAVY_FLOOR, wide: bool = False, width: int = WIDTH
) -> DataFrame:
    """The rows of ``triangles`` by intersections; ``width`` sizes the blocks and does not change the rows."""
    ranked, _ = ranked_links(edges, floor)
    return rotated(intersected_walks(ranked, width), ranked, kind, wide)


def intersected_canonical(edges: DataFrame, floor: int = HEAVY_FLOOR, width: int = WIDTH) -> DataFrame:
    """The rows of ``triangles_canonical`` by intersections."""
    ranked, _ = ranked_links(edges, floor)
    return canonical(intersected_walks(ranked, width))
