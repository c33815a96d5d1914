"""PageRank with teleport and redistribution of dangling mass.

Per iteration, with teleport probability alpha, N nodes and dangling mass D::

    c(v)  = sum over links u -> v of r(u) * copies(u, v) / outdeg(u)
    r'(v) = (1 - alpha) * (c(v) + D / N) + alpha / N

D is the rank of nodes without out-links plus what flows into the optional sink node, which is
no node of its own. The ranks sum to 1 throughout.

Plan: the links are laid out by source once, in memory or as a bucketed table. An iteration moves
the ranks to the links (one row per node) and the combined contributions to their targets; the
links themselves never move again. Links of a hub are spread over cells, see
``functions.skew``. The ranks of an iteration are written to the shared folder, which is also when their
dangling mass is summed (it is observed, so no job of its own reads them again), and the ones before
are removed.

**Several steps a write.** With ``every`` = c only each c-th iteration is written. The steps between stay one
linear plan: P being the step without teleport, c steps from r need only the vectors ``P^j r`` and ``P^j 1``,
which travel side by side, and the masses follow from their sums when they are written. Each node has a
link to itself of weight 0 that carries what it holds to the next step, so no step is read twice.

**Equal bits.** Floating sums depend on the order in which tasks finish. With ``exact`` contributions are
added as whole multiples of 2 ** -90, in two longs, which gives the same ranks in every run and partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from edgeweave.functions.skew import BROADCAST_ROWS, HEAVY_FLOOR, cell_of, every_cell, heavy_line, join_in_cells
from edgeweave.operators.degrees import BLOCK_WIDTH, heavy_sources, link_blocks
from edgeweave.operators.edges import link_counts
from edgeweave.operators.layout import bucketed_table, drop_bucketed
from edgeweave.session import counted_table, cut_lineage, drop_table, written_table
from edgeweave.sources.generate import copy_chains, one_chain

# Probability of a random jump, and the flag and separators of a step record.
TELEPORT = 0.15
RECORD_FLAG = "U"
FIELD_END, NODE_END = ",", "-"


def node_table(links: DataFrame, sink_id: int | None = None, floor: int = HEAVY_FLOOR) -> DataFrame:
    """Nodes ``(id, outw, leak, parts)``.

    ``outw`` counts out-links with copies, ``leak`` is the fraction of a node's rank that becomes
    dangling mass, ``parts`` the number of cells its out-links are spread over.
    """
    zero, n = F.lit(0).cast("long"), F.col("n")
    to_sink = F.lit(False) if sink_id is None else F.col("dst") == sink_id
    ends = links.select(
        F.explode(
            F.array(
                F.struct(
                    F.col("src").alias("id"),
                    n.alias("outw"),
                    F.when(to_sink, n).otherwise(zero).alias("sinkw"),
                    F.lit(1).cast("long").alias("links"),
                ),
                F.struct(F.col("dst").alias("id"), zero.alias("outw"), zero.alias("sinkw"), zero.alias("links")),
            )
        ).alias("end")
    ).select("end.*")
    sums = ends.groupBy("id").agg(*[F.sum(c).alias(c) for c in ("outw", "sinkw", "links")])
    line = heavy_line(links.agg(F.count_if(n > 0)).scalar(), floor)
    nodes = sums if sink_id is None else sums.filter(F.col("id") != sink_id)
    leak = F.when(F.col("outw") == 0, 1.0).otherwise(F.col("sinkw") / F.col("outw"))
    parts = F.when(F.col("links") >= line, F.ceil(F.col("links") / line)).otherwise(1).cast("long")
    return nodes.select("id", "outw", leak.alias("leak"), parts.alias("parts"))


def initial_ranks(edges: DataFrame, sink_id: int | None = None, per: str = "node") -> DataFrame:
    """``(id, rank)`` with rank 1 / number of nodes, or 1 / number of edges for ``per='edge'``."""
    links = link_counts(edges)
    nodes = node_table(links, sink_id).select("id")
    if per == "edge":
        total = edges.agg(F.count(F.lit(1))).scalar()
    else:
        total = nodes.agg(F.count(F.lit(1))).scalar()
    return nodes.select("id", (F.lit(1.0) / total).alias("rank"))


def node_layout(nodes: DataFrame) -> DataFrame:
    """The node table by id, sorted, for joins that move only the other side."""
    partitions = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return nodes.repartition(partitions, "id").sortWithinPartitions("id")


def _in_cells(links: DataFrame, nodes: DataFrame) -> DataFrame:
    """Links with their cell; the broadcast holds hubs only, at most ``sqrt(2 * links)`` rows."""
    hubs = F.broadcast(nodes.filter(F.col("parts") > 1).select(F.col("id").alias("src"), "parts"))
    cell = cell_of(F.coalesce("parts", F.lit(1).cast("long")), F.col("dst")).alias("cell")
    return links.join(hubs, "src", "left").select("src", cell, "dst", "n")


def link_layout(links: DataFrame, nodes: DataFrame) -> DataFrame:
    """The links by source and cell, sorted: shuffled once, joined in place by every iteration."""
    return _by_cell(_in_cells(links, nodes))


def _by_cell(links: DataFrame) -> DataFrame:
    partitions = int(links.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return links.repartition(partitions, "src", "cell").sortWithinPartitions("src", "cell")


def _fixed_sum(x: Column) -> tuple[Column, Column]:
    """Sums of ``x`` in multiples of 2 ** -60 and, for the rest, 2 ** -90."""
    whole = x * F.lit(2.0**60)
    return F.sum(F.floor(whole)), F.sum(F.floor((whole - F.floor(whole)) * F.lit(2.0**30)))


def _float_of(high: Column, low: Column) -> Column:
    return (high.cast("double") + low.cast("double") / F.lit(2.0**30)) / F.lit(2.0**60)


def _summed(x: Column, exact: bool) -> Column:
    return _float_of(*_fixed_sum(x)) if exact else F.sum(x)


def _contributions(state: DataFrame, layout: DataFrame, small: bool, exact: bool = False) -> DataFrame:
    """``(dst, c)`` from ranks and links; the sum is combined before it is shuffled."""
    share = state.filter(F.col("outw") > 0)
    per_copy = (F.col("rank") / F.col("outw")).alias("share")
    if small:
        moved = share.select(F.col("id").alias("src"), per_copy).join(F.broadcast(layout), "src")
    else:
        copies = share.select(F.col("id").alias("src"), per_copy, every_cell(F.col("parts")).alias("cell"))
        moved = layout.join(copies.hint("merge"), ["src", "cell"])
    return moved.groupBy("dst").agg(_summed(F.col("share") * F.col("n"), exact).alias("c"))


def _next_rank(contribution: Column, mass: float, n_nodes: int, alpha: float) -> Column:
    return (1 - alpha) * (contribution + F.lit(mass) / F.lit(float(n_nodes))) + F.lit(alpha / n_nodes)


def _written_step(state: DataFrame, **sums: Column) -> tuple[DataFrame, str, dict[str, float]]:
    """The ranks of a step as a table, and sums over it that are taken while it is written."""
    watch = Observation("step")
    table, path = written_table(state.observe(watch, *[s.alias(name) for name, s in sums.items()]), "step")
    return table, path, {name: value or 0.0 for name, value in watch.get.items()}


def _several_steps(state: DataFrame, layout: DataFrame, steps: int) -> DataFrame:
    """``(id, outw, leak, parts, x0.., y0..)``: ``P^j`` of the ranks and of ones, for j up to ``steps``."""
    state = state.withColumns({"x0": F.col("rank"), "y0": F.lit(1.0)}).drop("rank")
    for j in range(steps):
        held = [c for c in state.columns if c != "id"]
        copies = state.select(F.col("id").alias("src"), *held, every_cell(F.col("parts")).alias("cell"))
        own = F.col("n") == 0
        sent = {f"{v}{j + 1}": F.when(~own, F.col(f"{v}{j}") / F.col("outw") * F.col("n")).otherwise(0.0) for v in "xy"}
        rows = layout.join(copies.hint("merge"), ["src", "cell"]).select(
            F.col("dst").alias("id"), *[c.alias(name) for name, c in sent.items()], *[F.when(own, F.col(c)).alias(c) for c in held]
        )
        state = rows.groupBy("id").agg(*[F.max(c).alias(c) for c in held], *[F.sum(c).alias(c) for c in sent])
    return state


def _unrolled(sums: dict[str, float], steps: int, n_nodes: int, alpha: float, chain_copies: int) -> tuple[list[float], Column]:
    """The masses that ``steps`` steps read, and the rank after them, from the sums of ``leak * x_j`` and ``leak * y_j``."""
    keep, masses, added = 1 - alpha, [], []  # added: what every node gets in a step by jumps
    for j in range(steps):
        mass = keep**j * sums[f"x{j}"] + sum(keep ** (j - 1 - i) * added[i] * sums[f"y{j - 1 - i}"] for i in range(j))
        masses.append(mass * chain_copies)
        added.append(keep * masses[j] / n_nodes + alpha / n_nodes)
    rank = F.lit(keep**steps) * F.col(f"x{steps}")
    for i in range(steps):
        rank = rank + F.lit(keep ** (steps - 1 - i) * added[i]) * F.col(f"y{steps - 1 - i}")
    return masses, rank


def pagerank_with_mass(
    edges: DataFrame,
    iterations: int = 10,
    alpha: float = TELEPORT,
    sink_id: int | None = None,
    strategy: str = "auto",
    chain_copies: int = 1,
    floor: int = HEAVY_FLOOR,
    max_broadcast_rows: int = BROADCAST_ROWS,
    every: int = 1,
    layout: str = "memory",
    exact: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Ranks ``(id, rank)`` after ``iterations`` and the mass log ``(iteration, mass)``.

    ``strategy='broadcast'`` ships the links to the ranks if they are counted to be at most
    ``max_broadcast_rows``. With ``chain_copies = k`` the edges stand for k equal components. ``every`` is the
    number of iterations between two writes. ``layout='bucketed'`` keeps nodes and links as sorted,
    bucketed tables instead of in the executors' memory: they are joined without an exchange, too, and
    no executor's loss brings their shuffle back. ``exact`` makes the ranks equal in every run.
    """
    if iterations < 1 or every < 1:
        raise ValueError("iterations and every must be at least 1")
    if strategy not in ("auto", "broadcast"):
        raise ValueError("strategy must be 'auto' or 'broadcast'")
    if layout not in ("memory", "bucketed"):
        raise ValueError("layout must be 'memory' or 'bucketed'")
    if every > 1 and (exact or strategy == "broadcast"):
        raise ValueError("several steps between two writes need the merge join and floating sums")
    spark = edges.sparkSession
    links, links_path, n_links = counted_table(link_counts(edges), "links")
    kept, nodes_path, n_nodes = counted_table(node_table(links, sink_id, floor), "nodes")
    n_nodes *= chain_copies
    inside = links if sink_id is None else links.filter(F.col("dst") != sink_id)
    small = strategy == "broadcast" and n_links <= max_broadcast_rows
    tables: list[str] = []

    def placed(df: DataFrame, *keys: str) -> DataFrame:
        if layout == "memory":
            return df.persist()
        tables.append(name := bucketed_table(df, *keys))
        return spark.table(name)

    nodes = placed(node_layout(kept), "id")
    if small:
        laid = inside
    elif every == 1:
        laid = placed(link_layout(inside, kept), "src", "cell")
    else:
        zero = F.lit(0).cast("long")
        own = kept.select(F.col("id").alias("src"), zero.alias("cell"), F.col("id").alias("dst"), zero.alias("n"))
        laid = placed(_by_cell(_in_cells(inside, kept).unionByName(own)), "src", "cell")

    start = F.lit(1.0 / max(n_nodes, 1))
    leaked = _summed(F.col("rank") * F.col("leak"), exact)
    masses: list[float] = []
    try:
        state, path, sums = _written_step(kept.withColumn("rank", start), mass=leaked)
        while len(masses) < iterations:
            steps, before = min(every, iterations - len(masses)), path
            if every == 1:
                masses.append(sums["mass"] * chain_copies)
                found = _contributions(state, laid, small, exact).withColumnRenamed("dst", "id")
                new = _next_rank(F.coalesce("c", F.lit(0.0)), masses[-1], n_nodes, alpha)
                moved = nodes.join(found.hint("merge"), "id", "left")
                state, path, sums = _written_step(moved.select("id", "outw", "leak", "parts", new.alias("rank")), mass=leaked)
            else:
                vectors = {f"{v}{j}": F.sum(F.col(f"{v}{j}") * F.col("leak")) for v in "xy" for j in range(steps)}
                table, path, sums = _written_step(_several_steps(state, laid, steps), **vectors)
                read, rank = _unrolled(sums, steps, n_nodes, alpha, chain_copies)
                masses += read
                state = table.select("id", "outw", "leak", "parts", rank.alias("rank"))
            drop_table(spark, before)
    finally:
        for df in (nodes, laid) if layout == "memory" else ():
            df.unpersist()
        for name in tables:
            drop_bucketed(spark, name)
        drop_table(spark, links_path)  # the ranks are a table of their own
        drop_table(spark, nodes_path)
    log = spark.createDataFrame([(i, m) for i, m in enumerate(masses, 1)], "iteration int, mass double")
    return state.select("id", "rank"), log


def pagerank(edges: DataFrame, iterations: int = 10, **options) -> DataFrame:
    """Ranks ``(id, rank)``; see ``pagerank_with_mass``."""
    return pagerank_with_mass(edges, iterations, **options)[0]


def dangling_mass(edges: DataFrame, iterations: int = 10, **options) -> DataFrame:
    """Dangling mass read by each iteration, ``(iteration, mass)``."""
    return pagerank_with_mass(edges, iterations, **options)[1]


def chain_pagerank(
    spark: SparkSession, k: int, iterations: int = 10, **options
) -> tuple[DataFrame, DataFrame]:
    """PageRank of k equal chains of k nodes: run on one chain, copied to all at the end."""
    ranks, log = pagerank_with_mass(one_chain(spark, k), iterations, sink_id=0, chain_copies=k, **options)
    return copy_chains(ranks, k), log


def _first_step(links: DataFrame, sink_id: int | None, floor: int) -> DataFrame:
    """``(id, outw, contribution)`` of the first step from uniform ranks."""
    nodes = cut_lineage(node_table(links, sink_id, floor))
    start = F.lit(1.0) / nodes.agg(F.count(F.lit(1))).scalar()
    sums = _contributions(nodes.withColumn("rank", start), _in_cells(links, nodes), small=False)
    joined = nodes.join(sums.withColumnRenamed("dst", "id"), "id", "left")
    return joined.select("id", "outw", F.coalesce("c", F.lit(0.0)).alias("contribution"))


def first_contributions(edges: DataFrame, sink_id: int | None = None, floor: int = HEAVY_FLOOR) -> DataFrame:
    """``(id, contribution)`` of the first step; 0.0 for nodes without in-links."""
    links, _ = written_table(link_counts(edges), "links")
    return _first_step(links, sink_id, floor).select("id", "contribution")


def nodes_without_in_links(edges: DataFrame, sink_id: int | None = None) -> DataFrame:
    """Nodes that no link leads to, such as the first of a chain."""
    links = edges.select("src", "dst").filter(F.col("src").isNotNull() & F.col("dst").isNotNull())
    nodes = links.select(F.col("src").alias("id")).distinct()
    if sink_id is not None:
        nodes = nodes.filter(F.col("id") != sink_id)
    return nodes.join(links.select(F.col("dst").alias("id")).distinct(), "id", "left_anti")


def step_records(
    edges: DataFrame, sink_id: int | None = None, floor: int = HEAVY_FLOOR, width: int = BLOCK_WIDTH
) -> DataFrame:
    """One PageRank step with the out-links carried along: ``(node, contribution, block, adjacency)``."""
    links, _ = written_table(link_counts(edges), "links")
    step = _first_step(links, sink_id, floor).withColumnRenamed("id", "node")
    lists = link_blocks(links, width).withColumnRenamed("neighbours", "adjacency")
    hubs = heavy_sources(links, floor).withColumnRenamed("src", "node")
    linked = join_in_cells(lists, step.select("node", "contribution"), "node", ["block"], hubs)
    without = step.filter(F.col("outw") == 0).select(
        "node", "contribution", F.lit(0).cast("long").alias("block"), F.lit(None).cast("array<long>").alias("adjacency")
    )
    return linked.select("node", "contribution", "block", "adjacency").unionByName(without)


def record_text(records: DataFrame) -> DataFrame:
    """Step records as ``node,U,contribution,a-b-`` lines."""
    tail = F.concat_ws("", F.transform("adjacency", lambda x: F.concat(x.cast("string"), F.lit(NODE_END))))
    fields = [F.col("node").cast("string"), F.lit(RECORD_FLAG), F.col("contribution").cast("string"), tail]
    return records.select(F.concat_ws(FIELD_END, *fields).alias("value"))


def top_ranked(ranks: DataFrame, k: int = 20) -> DataFrame:
    """The k highest ranks as ``(id, value)``."""
    return ranks.select("id", F.col("rank").alias("value")).orderBy(F.desc("value"), "id").limit(k)
