"""The same queries as plain SQL for an independent engine."""

from __future__ import annotations

PARTS = """
e as materialized (
  select src, dst from (
    select l_partkey as src,
           lead(l_partkey) over (partition by l_orderkey order by l_linenumber, l_partkey) as dst
    from lineitem) where dst is not null),
l as materialized (select src, dst, count(*) as n from e group by src, dst)"""

SERVED = """
e as materialized (
  select distinct 2 * l_suppkey as src, 2 * o_custkey + 1 as dst
  from lineitem join orders on l_orderkey = o_orderkey),
l as materialized (select src, dst, count(*) as n from e group by src, dst)"""

TRADE = """
e as materialized (
  select 3 * l_suppkey as src, 3 * o_custkey + 1 as dst from lineitem join orders on l_orderkey = o_orderkey group by all
  union all select 3 * c_custkey + 1, 3 * c_nationkey::bigint + 2 from customer
  union all select 3 * s_nationkey::bigint + 2, 3 * s_suppkey from supplier),
l as materialized (select src, dst, count(*) as n from e group by src, dst)"""

QUARTER = "(select max(l_partkey) // 4 from lineitem)"
CAP = "(select max(l_partkey) // 2 from lineitem)"


def _parts(select: str) -> str:
    return f"with {PARTS}\n{select}"


def _sum(x: str, exact: bool) -> str:
    """A floating sum, or one in multiples of 2 ** -60 and, for the rest, 2 ** -90."""
    if not exact:
        return f"sum({x})"
    one, two = "1152921504606846976.0::double", "1073741824.0::double"
    whole = f"({x} * {one})"
    high, low = f"sum(floor({whole})::hugeint)", f"sum(floor(({whole} - floor({whole})) * {two})::hugeint)"
    return f"({high}::double + {low}::double / {two}) / {one}"


def _rank_steps(iterations: int, graph: str, copies: str = "1", exact: bool = False) -> str:
    """CTEs r0..rT and d1..dT over links ``l`` and nodes ``v``; ``l`` has no sink, ``v`` its leak."""
    out = [
        f"{graph},\nsize_n as materialized (select count(*) * {copies} as n from v)",
        "r0 as materialized (select id, 1.0::double / (select n from size_n) as rank from v)",
    ]
    for t in range(1, iterations + 1):
        out.append(
            f"d{t} as materialized (select coalesce({_sum('rank * leak', exact)}, 0) * {copies} as mass from r{t - 1} join v using (id))"
        )
        out.append(
            f"c{t} as materialized (select l.dst as id, {_sum('r.rank / v.outw * l.n', exact)} as c"
            f" from l join r{t - 1} r on r.id = l.src join v on v.id = l.src group by l.dst)"
        )
        out.append(
            f"r{t} as materialized (select v.id, 0.85::double * (coalesce(c.c, 0) + (select mass from d{t}) / (select n from size_n))"
            f" + 0.15::double / (select n from size_n) as rank from v left join c{t} c on c.id = v.id)"
        )
    return ",\n".join(out)


NODES = """
v as materialized (
  select id, sum(o) as outw, case when sum(o) = 0 then 1.0::double else 0.0::double end as leak
  from (select src as id, n as o from l union all select dst, 0 from l) group by id)"""

# node 0 as sink: no node, what flows into it leaks
SINK_NODES = """
v as materialized (
  select id, sum(o) as outw, case when sum(o) = 0 then 1.0::double else sum(s) / sum(o) end as leak
  from (select src as id, n as o, case when dst = 0 then n else 0 end as s from all_l union all select dst, 0, 0 from all_l)
  where id <> 0 group by id)"""


def _ranked(iterations: int, edges: str = PARTS) -> str:
    return "with " + _rank_steps(iterations, f"{edges},{NODES}")


COUNTS = """
select a, cast(sum(paths) as bigint) as paths from (
  select x.src as a, x.n * o.n as paths from {l} x join (select src, sum(n) as n from {l} group by src) o on o.src = x.dst
  union all select x.src, -x.n * y.n from {l} x join {l} y on y.src = x.dst and y.dst = x.src)
group by a having sum(paths) > 0"""

PATHS = "select x.src as a, x.dst as b, y.dst as c, x.n * y.n as copies from l x join l y on y.src = x.dst where x.src <> y.dst"

CYCLES = (
    "select x.src as a, x.dst as b, y.dst as c, x.n * y.n * z.n as copies, x.n as first"
    " from l x join l y on y.src = x.dst join l z on z.src = y.dst and z.dst = x.src"
)

SEMI = (
    "select e.src as a, e.dst as b, y.dst as c from e join l y on y.src = e.dst"
    " where exists (select 1 from l z where z.src = y.dst and z.dst = e.src)"
)


def _followers(where: str = "") -> str:
    return _parts(f"select dst as id, count(*) as followers from e {where} group by dst")


def _sizes(edges: str) -> str:
    return (
        f"select node, m, n, m * n as paths from (select dst as node, count(*) as m from {edges} group by dst)"
        f" join (select src as node, count(*) as n from {edges} group by src) using (node)"
    )


def _profile() -> str:
    rows = []
    for q in (1, 2, 3, 4):
        k = f"(src <= (select max(l_partkey) * {q} // 4 from lineitem) and dst <= (select max(l_partkey) * {q} // 4 from lineitem))"
        rows.append(
            f"select (select max(l_partkey) * {q} // 4 from lineitem) as cap,"
            f" (select count(*) from e where {k}) as kept,"
            f" (select count(*) from e where not {k}) as beyond,"
            f" (select cast(sum(x.n * y.n) as bigint) from (select * from l where {k}) x join (select * from l where {k}) y"
            f" on y.src = x.dst where x.src <> y.dst) as two_paths,"
            f" (select cast(sum(x.n * y.n * z.n) as bigint) from (select * from l where {k}) x join (select * from l where {k}) y"
            f" on y.src = x.dst join (select * from l where {k}) z on z.src = y.dst and z.dst = x.src"
            f" where x.src <> y.dst) as triangle_rows"
        )
    return _parts("\nunion all\n".join(rows))


def _blocks(columns: str) -> str:
    """Adjacency rows of 16 successors each, in the order of their ids."""
    return (
        "select node, block, " + columns + " from (select src as node, dst, n,"
        " (row_number() over (partition by src order by dst) - 1) // 16 as block from l) group by node, block"
    )


def _count(rows: str) -> str:
    return _parts(
        f"select cast(coalesce(sum(copies), 0) as bigint) as rows, cast(coalesce(sum(copies), 0) as bigint) // 3 as triangles from ({rows})"
    )


def oracle_sql() -> dict[str, str]:
    edges = _parts("select src, dst from e")
    both_ways = _parts("select src, dst from e union all select dst, src from e")
    open_cycles = f"select a, b, c, copies from ({CYCLES}) where a <> c"
    semi = f"select a, b, c, count(*) as copies from ({SEMI}) group by a, b, c"
    capped = f"(select src, dst from e where src <= {CAP} and dst <= {CAP})"
    beyond = f"(select src, dst from e where src > {CAP} or dst > {CAP})"
    ranks10 = _ranked(10) + "\nselect id, round(rank, 12) as rank from r10"
    sink = PARTS.replace("l as mat", "all_l as mat") + ",\nl as materialized (select * from all_l where dst <> 0)," + SINK_NODES
    sink10 = "with " + _rank_steps(10, sink) + "\nselect id, round(rank, 12) as rank from r10"
    small = f"(select * from l where src <= {QUARTER} and dst <= {QUARTER})"
    quarter = PATHS.replace("from l x join l y", f"from {small} x join {small} y")
    few = f"(select src, dst, n from l where src <= {CAP} and dst <= {CAP})"
    few_cycles = f"select a, b, c, copies from ({CYCLES.replace('l x', few + ' x').replace('l y', few + ' y').replace('l z', few + ' z')}) where a <> c"
    canonical = f"select a, b, c from ({CYCLES}) where a < b and a < c and b <> c"
    counts = COUNTS.format(l="l")
    masses = "\nunion all\n".join(f"select {t} as iteration, round(mass, 12) as mass from d{t}" for t in range(1, 11))
    step = _ranked(1) + (
        "\nselect v.id as node, round(coalesce(c.c, 0), 12) as contribution, coalesce(block, 0) as block, adjacency"
        " from v left join c1 c on c.id = v.id left join ("
        + _blocks("string_agg(dst, '-' order by dst) as adjacency")
        + ") s on s.node = v.id"
    )
    return {
        "scan_edges_text": edges,
        "scan_edges_csv": edges,
        "scan_edges_tokens": both_ways,
        "extract_edges_regex": both_ways,
        "sink_roundtrip_text": edges,
        "sink_roundtrip_csv": edges,
        "sink_roundtrip_tab": edges,
        "edges_cap": _parts(f"select src, dst from {capped}"),
        "edges_cap_by_files": _parts(f"select src, dst from {capped}"),
        "edges_beyond_cap": _parts(f"select src, dst from {beyond}"),
        "reverse_edges": _parts("select dst as src, src as dst from e"),
        "edges_distinct": _parts("select distinct src, dst from e"),
        "edge_endpoints": _parts(
            "select src as node, 'O' as tag, src, dst from e union all select dst, 'I', src, dst from e"
        ),
        "follower_count": _followers(),
        "follower_count_modulus": _followers("where dst % 100 = 0"),
        "follower_count_aggregate": _followers(),
        "follower_count_fold": _followers(),
        "follower_count_grouped": _followers(),
        "follower_count_reduce": _followers(),
        "out_degree": _parts("select src as node, count(*) as out_degree from e group by src"),
        "adjacency_list": _parts(
            _blocks("string_agg(dst, '-' order by dst) as neighbours, string_agg(n, '-' order by dst) as copies")
        ),
        "adjacency_set": _parts(_blocks("string_agg(dst, '-' order by dst) as neighbours")),
        "adjacency_trade": f"with {TRADE}\n" + _blocks("string_agg(dst, '-' order by dst) as neighbours"),
        "in_links_sorted": _parts("select dst, src, n as copies from l order by dst, src"),
        "two_path_cardinality": _parts(_sizes("e")),
        "two_path_cardinality_cap": _parts(_sizes(capped)),
        "two_path_total": _parts(f"select cast(sum(paths) as bigint) as total from ({_sizes('e')})"),
        "two_path_running_total": _parts(
            f"select node, paths, cast(sum(paths) over (order by node) as bigint) as running from ({_sizes('e')})"
        ),
        "edges_beyond_cap_by_src": _parts(f"select src, count(*) as n from {beyond} group by src"),
        "edges_beyond_cap_total": _parts(f"select count(*) as n from {beyond}"),
        "two_paths_shuffle": _parts(counts),
        "two_paths_merge": _parts(counts),
        "two_paths_broadcast": _parts(counts),
        "two_paths_adjacency": _parts(counts),
        "two_paths_salted": _parts(counts),
        "two_paths_distinct": _parts(COUNTS.format(l="(select src, dst, 1 as n from l)")),
        "two_paths_trade": f"with {TRADE}\n{counts}",
        "two_paths_rows": _parts(
            "select x.src as a, x.dst as b, y.dst as c from e x join e y on y.src = x.dst where x.src <> y.dst"
        ),
        **{f"two_paths_list_{s}": _parts(quarter) for s in ("auto", "shuffle", "merge", "broadcast", "adjacency", "salted")},
        "two_paths_count": _parts(f"select cast(sum(copies) as bigint) as n from ({PATHS})"),
        "triangles": _parts(open_cycles),
        "triangles_merge": _parts(open_cycles),
        "triangles_shuffle": _parts(open_cycles),
        "triangles_broadcast": _parts(open_cycles),
        "triangles_distinct": _parts(f"select a, b, c from ({open_cycles})"),
        "triangles_semi": _parts(semi),
        "triangles_rows": _parts(
            "select x.src as a, x.dst as b, y.dst as c from e x join e y on y.src = x.dst"
            " join e z on z.src = y.dst and z.dst = x.src where x.src <> y.dst"
        ),
        "triangle_count": _count(open_cycles),
        "triangle_count_distinct": _count(f"select 1 as copies from ({open_cycles})"),
        "triangle_count_semi": _count(semi),
        "triangles_canonical": _parts(canonical),
        "triangles_capped": _parts(few_cycles),
        "triangle_count_capped": _count(few_cycles),
        "triangles_intersect": _parts(open_cycles),
        "triangles_intersect_trade": f"with {TRADE}\n{canonical}",
        "triangles_filtered": _parts(open_cycles),
        "triangles_filtered_trade": f"with {TRADE}\n{canonical}",
        "triangles_trade": f"with {TRADE}\n{canonical}",
        "triangle_count_trade": _count(open_cycles).replace(PARTS, TRADE),
        "cap_profile": _profile(),
        "left_join_default": _ranked(1, SERVED)
        + "\nselect v.id, round(coalesce(c.c, 0), 12) as contribution from v left join c1 c on c.id = v.id",
        "initial_ranks": f"with {SERVED},{NODES}\nselect id, round(1.0::double / (select count(*) from v), 12) as rank from v",
        "pagerank_iter1": _ranked(1) + "\nselect id, round(rank, 12) as rank from r1",
        "pagerank": ranks10,
        "pagerank_broadcast": ranks10,
        "pagerank_dangling": _ranked(10, SERVED) + "\nselect id, round(rank, 12) as rank from r10",
        "pagerank_dangling_mass": _ranked(10, SERVED) + "\n" + masses,
        "pagerank_sink": sink10,
        "pagerank_trade": _ranked(10, TRADE) + "\nselect id, round(rank, 12) as rank from r10",
        "pagerank_bucketed": ranks10,
        "pagerank_every_five": _ranked(10, SERVED) + "\nselect id, round(rank, 12) as rank from r10",
        "pagerank_exact": "with " + _rank_steps(10, f"{PARTS},{NODES}", exact=True) + "\nselect id, rank from r10",
        "ranks_partition": _ranked(2, SERVED) + "\nselect id, round(rank, 12) as rank from r2",
        "ranks_roundtrip": _ranked(2, SERVED)
        + "\nselect id, round(rank, 12) as rank from r2 union all select 0, round(mass, 12) from d2",
        "nodes_without_in_links": f"with {SERVED}\nselect distinct src as id from e where src not in (select dst from e)",
        "pagerank_step_record": step,
        "top_ranked": ranks10.replace(
            "select id, round(rank, 12) as rank from r10",
            "select id, round(rank, 12) as value from r10 order by value desc, id limit 20",
        ),
        "top_two_path_nodes": _parts(
            f"select node as id, paths as value from ({_sizes('e')}) order by value desc, id limit 20"
        ),
    }
