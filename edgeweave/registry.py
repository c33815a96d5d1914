"""The named queries: each takes ``(spark, sf_dir)`` and reads whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from edgeweave.operators import degrees as dg, edges as ed, intersections as ix, layout as lo, paths as pa, triangles as tr
from edgeweave.plans import pagerank as pr
from edgeweave.plans.cap_profile import cap_profile
from edgeweave.session import fresh_path
from edgeweave.sources import readers, writers
from edgeweave.sources.derived import part_sequence_edges, supplier_customer_edges, table, trade_edges

DIGITS = 12
WIDTH = 16  # successors in a row of the adjacency queries, small enough to split ordinary nodes
TRADE_FLOOR, TRADE_PAIRS = 300, 10_000  # sizes of cells on the trade graph; they do not change rows
BITS = 1 << 22  # of the membership filter, which does not change rows either

Query = Callable[[SparkSession, str], DataFrame]


def _on_parts(operator: Callable[..., DataFrame], **options) -> Query:
    return lambda spark, sf_dir: operator(part_sequence_edges(spark, sf_dir), **options)


def _on_trade(operator: Callable[..., DataFrame], **options) -> Query:
    return lambda spark, sf_dir: operator(trade_edges(spark, sf_dir), **options)


def _cap(spark: SparkSession, sf_dir: str, quarters: int = 2) -> Column:
    """An id cap that grows with the tables: so many quarters of the largest part id."""
    top = table(spark, sf_dir, "lineitem").agg(F.expr(f"max(l_partkey) * {quarters} div 4").alias("cap"))
    return top.scalar()


def _on_capped(operator: Callable[..., DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(part_sequence_edges(spark, sf_dir), _cap(spark, sf_dir))


def _listed(strategy: str) -> Query:
    """Two-hop paths one by one, each join by name, among the ids up to a quarter of the largest."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        few = ed.cap_edges(part_sequence_edges(spark, sf_dir), _cap(spark, sf_dir, 1))
        return pa.two_paths(few, strategy)

    return query


def _rounded(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.round(column, DIGITS))


def _ranks(derive: Query, iterations: int, **options) -> Query:
    return lambda spark, sf_dir: _rounded(pr.pagerank(derive(spark, sf_dir), iterations, **options), "rank")


# Round trips: the derived edges are written below the shared folder and read back.


def _text_lines(spark: SparkSession, sf_dir: str, line: Column) -> str:
    path = fresh_path(spark, "edges-text")
    part_sequence_edges(spark, sf_dir).select(line.alias("value")).write.text(path)
    return path


def _csv_lines(spark: SparkSession, sf_dir: str, sep: str = ",") -> str:
    path = fresh_path(spark, "edges-csv")
    writers.write_csv(part_sequence_edges(spark, sf_dir), path, sep)
    return path


def _pair(first: str, second: str) -> Column:
    return F.concat(F.col(first).cast("string"), F.lit(","), F.col(second).cast("string"))


def _scan_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.read_edges_text(spark, _text_lines(spark, sf_dir, _pair("src", "dst")))


def _scan_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.read_edges_csv(spark, _csv_lines(spark, sf_dir))


def _scan_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tokens per line: the edge and its reverse."""
    line = F.concat(F.lit(" "), _pair("src", "dst"), F.lit("  "), _pair("dst", "src"))
    return readers.read_edges_tokens(spark, _text_lines(spark, sf_dir, line))


def _extract_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two matches per line amid other text: the edge and its reverse."""
    line = F.concat(F.lit("edge "), _pair("src", "dst"), F.lit("; back ("), _pair("dst", "src"), F.lit(") end"))
    return readers.read_edges_regex(spark, _text_lines(spark, sf_dir, line))


def _roundtrip_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "edges-tuples")
    writers.write_tuples(part_sequence_edges(spark, sf_dir), path)
    return readers.read_edges_regex(spark, path)


def _roundtrip_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "edges-parquet")
    writers.write_parquet(_scan_csv(spark, sf_dir), path)
    return spark.read.parquet(path)


def _roundtrip_tab(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.read_edges_csv(spark, _csv_lines(spark, sf_dir, "\t"), sep="\t")


def _capped_scan(operator: Callable[..., DataFrame], **options) -> Query:
    """The whole path of a program: edge file, id cap, operator."""
    return lambda spark, sf_dir: operator(ed.cap_edges(_scan_csv(spark, sf_dir), _cap(spark, sf_dir)), **options)


def _ranks_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranks and mass of the second iteration, written as text and read back."""
    ranks, mass = pr.pagerank_with_mass(supplier_customer_edges(spark, sf_dir), 2)
    path = writers.write_ranks(ranks, mass, fresh_path(spark, "ranks"), 2)
    return _rounded(readers.read_ranks(spark, path), "rank")


def _cap_by_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The capped edges from a store that skips the files beyond the cap."""
    path = fresh_path(spark, "edges-by-top")
    lo.write_by_top(part_sequence_edges(spark, sf_dir), path)
    return lo.read_capped(spark, path, _cap(spark, sf_dir))


def _iteration_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two iterations in one partitioned table, the second read back."""
    path = fresh_path(spark, "iterations")
    for i in (1, 2):
        writers.write_iteration(pr.pagerank(supplier_customer_edges(spark, sf_dir), i), path, i)
    return _rounded(readers.read_iteration(spark, path, 2), "rank")


def _cap_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    caps = [_cap(spark, sf_dir, quarters) for quarters in (1, 2, 3, 4)]
    return cap_profile(part_sequence_edges(spark, sf_dir), caps)


def _joined(df: DataFrame, *columns: str) -> DataFrame:
    """Array columns as ``a-b-c`` text."""
    return df.withColumns({c: F.array_join(F.transform(c, lambda x: x.cast("string")), "-") for c in columns})


def _step_record(edges: DataFrame) -> DataFrame:
    return _joined(_rounded(pr.step_records(edges, width=WIDTH), "contribution"), "adjacency")


def queries() -> dict[str, Query]:
    parts, served, trade = part_sequence_edges, supplier_customer_edges, trade_edges
    every_id = {"modulus": 1}
    return {
        "scan_edges_text": _scan_text,
        "scan_edges_csv": _scan_csv,
        "scan_edges_tokens": _scan_tokens,
        "extract_edges_regex": _extract_regex,
        "sink_roundtrip_text": _roundtrip_text,
        "sink_roundtrip_csv": _roundtrip_csv,
        "sink_roundtrip_tab": _roundtrip_tab,
        "edges_cap": _on_capped(ed.cap_edges),
        "edges_cap_by_files": _cap_by_files,
        "edges_beyond_cap": _on_capped(ed.edges_beyond_cap),
        "reverse_edges": _on_parts(ed.reverse_edges),
        "edges_distinct": _on_parts(ed.distinct_edges),
        "edge_endpoints": _on_parts(ed.edge_endpoints),
        "follower_count": _on_parts(dg.follower_count, **every_id),
        "follower_count_modulus": _on_parts(dg.follower_count, modulus=100),
        "follower_count_aggregate": _on_parts(dg.follower_count_aggregate, **every_id),
        "follower_count_fold": _on_parts(dg.follower_count_fold, **every_id),
        "follower_count_grouped": _on_parts(dg.follower_count_grouped, **every_id),
        "follower_count_reduce": _on_parts(dg.follower_count_reduce, **every_id),
        "out_degree": _on_parts(dg.out_degree),
        "adjacency_list": _on_parts(lambda e: _joined(dg.adjacency_list(e, WIDTH), "neighbours", "copies")),
        "adjacency_set": _on_parts(lambda e: _joined(dg.adjacency_set(e, WIDTH), "neighbours")),
        "adjacency_trade": _on_trade(lambda e: _joined(dg.adjacency_set(e, WIDTH), "neighbours")),
        "in_links_sorted": _on_parts(ed.in_links_sorted),
        "two_path_cardinality": _on_parts(dg.two_path_cardinality),
        "two_path_cardinality_cap": _on_capped(dg.two_path_cardinality),
        "two_path_total": _on_parts(dg.two_path_total),
        "two_path_running_total": _on_parts(dg.two_path_running_total),
        "edges_beyond_cap_by_src": _on_capped(dg.edges_beyond_cap_by_src),
        "edges_beyond_cap_total": _on_capped(dg.edges_beyond_cap_total),
        "two_paths_shuffle": _on_parts(pa.two_path_counts, strategy="shuffle_hash"),
        "two_paths_merge": _on_parts(pa.two_path_counts, strategy="merge"),
        "two_paths_broadcast": _on_parts(pa.two_path_counts, strategy="broadcast"),
        "two_paths_adjacency": _on_parts(pa.two_path_counts, strategy="adjacency"),
        "two_paths_salted": _on_parts(pa.two_path_counts, strategy="salted"),
        "two_paths_distinct": _on_parts(pa.two_path_counts, distinct=True),
        "two_paths_trade": _on_trade(pa.two_path_counts, strategy="salted"),
        "two_paths_rows": _on_parts(lambda e: pa.path_rows(pa.two_paths(e))),
        "two_paths_count": _on_parts(pa.two_paths_count),
        "two_paths_list_auto": _listed("auto"),
        "two_paths_list_shuffle": _listed("shuffle_hash"),
        "two_paths_list_merge": _listed("merge"),
        "two_paths_list_broadcast": _listed("broadcast"),
        "two_paths_list_adjacency": _listed("adjacency"),
        "two_paths_list_salted": _listed("salted"),
        "triangles": _on_parts(tr.triangles),
        "triangles_merge": _on_parts(tr.triangles, strategy="merge"),
        "triangles_shuffle": _on_parts(tr.triangles, strategy="shuffle_hash"),
        "triangles_broadcast": _on_parts(tr.triangles, strategy="broadcast"),
        "triangles_distinct": _on_parts(tr.triangles, kind="distinct"),
        "triangles_semi": _on_parts(tr.triangles, kind="semi", strategy="broadcast"),
        "triangles_rows": _on_parts(lambda e: pa.path_rows(tr.triangles(e))),
        "triangle_count": _on_parts(tr.triangle_count),
        "triangle_count_distinct": _on_parts(tr.triangle_count, kind="distinct"),
        "triangle_count_semi": _on_parts(tr.triangle_count, kind="semi", strategy="broadcast"),
        "triangles_canonical": _on_parts(tr.triangles_canonical),
        "triangles_capped": _capped_scan(tr.triangles),
        "triangle_count_capped": _capped_scan(tr.triangle_count),
        "triangles_intersect": _on_parts(ix.intersected_triangles),
        "triangles_intersect_trade": _on_trade(ix.intersected_canonical, floor=TRADE_FLOOR, width=WIDTH),
        "triangles_filtered": _on_parts(tr.triangles, filter_bits=BITS),
        "triangles_filtered_trade": _on_trade(tr.triangles_canonical, floor=TRADE_FLOOR, budget=TRADE_PAIRS, filter_bits=BITS),
        "triangles_trade": _on_trade(tr.triangles_canonical, floor=TRADE_FLOOR, budget=TRADE_PAIRS),
        "triangle_count_trade": _on_trade(tr.triangle_count, floor=TRADE_FLOOR, budget=TRADE_PAIRS),
        "cap_profile": _cap_profile,
        "left_join_default": lambda spark, d: _rounded(pr.first_contributions(served(spark, d)), "contribution"),
        "initial_ranks": lambda spark, d: _rounded(pr.initial_ranks(served(spark, d)), "rank"),
        "pagerank_iter1": _ranks(parts, 1),
        "pagerank": _ranks(parts, 10),
        "pagerank_broadcast": _ranks(parts, 10, strategy="broadcast"),
        "pagerank_dangling": _ranks(served, 10),
        "pagerank_dangling_mass": lambda spark, d: _rounded(pr.dangling_mass(served(spark, d), 10), "mass"),
        "pagerank_sink": _ranks(parts, 10, sink_id=0),
        "pagerank_trade": _ranks(trade, 10, floor=TRADE_FLOOR),
        "pagerank_bucketed": _ranks(parts, 10, layout="bucketed"),
        "pagerank_every_five": _ranks(served, 10, every=5),
        "pagerank_exact": lambda spark, d: pr.pagerank(parts(spark, d), 10, exact=True),
        "ranks_roundtrip": _ranks_roundtrip,
        "ranks_partition": _iteration_partition,
        "nodes_without_in_links": lambda spark, d: pr.nodes_without_in_links(served(spark, d)),
        "pagerank_step_record": _on_parts(_step_record),
        "top_ranked": lambda spark, d: pr.top_ranked(_ranks(parts, 10)(spark, d)),
        "top_two_path_nodes": _on_parts(dg.top_two_path_nodes),
    }
