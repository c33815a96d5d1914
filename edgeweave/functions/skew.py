"""Skew handling by heavy keys and cells.

A key is heavy when it holds at least ``line = max(floor, sqrt(2 * N))`` of N rows. Since all
keys together hold N rows (2N for the endpoints of N edges), at most ``2N / line <= sqrt(2N)``
keys can be heavy: about 1.4 million for a trillion rows, two or three columns each. That is the
proven bound behind every broadcast of a heavy-key table in this package.

A heavy key is spread over ``parts = ceil(rows / line)`` cells. The large side of a join puts each
row into one cell, the other side repeats its rows once per cell, and both shuffle on
``(key, cell)``. Every other key has the single cell 0, so it is neither repeated nor re-joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

HEAVY_FLOOR = 1000
BROADCAST_ROWS = 2_000_000
PIECE = 4096


def heavy_line(total: Column, floor: int) -> Column:
    """Row count from which a key is heavy, given the total row count as a column."""
    return F.greatest(F.lit(float(floor)), F.sqrt(2.0 * total))


def heavy_keys(df: DataFrame, key: str, floor: int = HEAVY_FLOOR, rows: Column | None = None) -> DataFrame:
    """Heavy values of ``key`` as ``(key, rows, parts)``; sizes come from one combined aggregate.

    ``rows`` may replace the plain row count by an equal aggregate over a column that the other
    uses of ``df`` read: with the same columns they share one exchange.
    """
    sizes = df.groupBy(key).agg((F.count(F.lit(1)) if rows is None else rows).alias("rows"))
    line = heavy_line(sizes.agg(F.coalesce(F.sum("rows"), F.lit(0))).scalar(), floor)
    return sizes.filter(F.col("rows") >= line).withColumn("parts", F.ceil(F.col("rows") / line))


def cell_of(parts: Column, *spread_on: Column) -> Column:
    """The cell a row falls into, from a content hash, so a retried task repeats the choice."""
    return F.pmod(F.xxhash64(*spread_on), parts)


def every_cell(parts: Column) -> Column:
    """One output row per cell."""
    return F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))


def join_in_cells(
    rows: DataFrame, lookup: DataFrame, key: str, spread_on: list[str], heavy: DataFrame
) -> DataFrame:
    """Inner join of ``rows`` to ``lookup``, whose ``key`` is unique, with heavy keys split into cells.

    ``heavy`` holds ``(key, parts)`` for at least all heavy keys of ``rows`` and is broadcast.
    """
    parts = F.broadcast(heavy.select(key, "parts"))
    one = F.coalesce(F.col("parts"), F.lit(1).cast("long"))
    left = rows.join(parts, key, "left").withColumn("cell", cell_of(one, *map(F.col, spread_on)))
    right = lookup.join(parts, key, "left").withColumn("cell", every_cell(one))
    return left.drop("parts").join(right.drop("parts"), [key, "cell"]).drop("cell")


def join_unique(
    rows: DataFrame, lookup: DataFrame, key: str, spread_on: list[str], floor: int = HEAVY_FLOOR
) -> DataFrame:
    """``join_in_cells`` with the heavy keys found from ``rows``."""
    return join_in_cells(rows, lookup, key, spread_on, heavy_keys(rows, key, floor))


def repeat_rows(df: DataFrame, copies: str, spread: bool = False) -> DataFrame:
    """Turn a copy count into that many rows.

    The count is unrolled in three steps, so no array has more than ``PIECE`` items below
    ``PIECE ** 3`` copies. With ``spread`` the pieces are shuffled before the last step, which
    divides one row with very many copies among the tasks.
    """
    rest = [c for c in df.columns if c != copies]
    n, square = F.col(copies), PIECE * PIECE

    def pieces(count: Column, size: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.floor((count - 1) / F.lit(size))))

    def share(count: Column, index: str, size: int) -> Column:
        return F.least(F.lit(size).cast("long"), count - F.col(index) * size)

    out = df.filter(n > 0).withColumn("outer_piece", pieces(n, square))
    out = out.withColumn(copies, share(n, "outer_piece", square)).withColumn("piece", pieces(n, PIECE))
    out = out.withColumn(copies, share(n, "piece", PIECE))
    if spread:
        out = out.repartition(*rest, "outer_piece", "piece")
    return out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), n))).select(*rest)
