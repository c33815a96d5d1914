"""Edge and rank writers. Any path a Hadoop file system accepts will do."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Folder of an iteration's ranks, and the folder of its dangling mass below that.
ITERATION_FOLDER = "Iteration"
MASS_FOLDER = "Dummy"


def write_csv(df: DataFrame, path: str, sep: str = ",", mode: str = "error") -> None:
    """Plain separated text without header: ``a,b``, or tab separated with ``sep='\\t'``."""
    df.write.mode(mode).csv(path, sep=sep)


def tuple_text(df: DataFrame) -> DataFrame:
    """Rows as ``(a,b,...)`` text lines."""
    joined = F.concat_ws(",", *[F.col(c).cast("string") for c in df.columns])
    return df.select(F.concat(F.lit("("), joined, F.lit(")")).alias("value"))


def write_tuples(df: DataFrame, path: str, mode: str = "error") -> None:
    """Text sink with one ``(a,b,...)`` line per row."""
    tuple_text(df).write.mode(mode).text(path)


def write_parquet(df: DataFrame, path: str, mode: str = "error") -> None:
    """Columnar sink, the one to read back from."""
    df.write.mode(mode).parquet(path)


def write_iteration(ranks: DataFrame, root: str, iteration: int) -> None:
    """Ranks as a partition ``iteration=<n>`` of one columnar table; a repeated write replaces that partition only."""
    rows = ranks.select("id", "rank", F.lit(iteration).alias("iteration"))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("iteration").parquet(root)


def iteration_path(root: str, iteration: int) -> str:
    return f"{root.rstrip('/')}/{ITERATION_FOLDER}{iteration}"


def write_ranks(ranks: DataFrame, mass: DataFrame, root: str, iteration: int, files: int | None = None) -> str:
    """Ranks into ``<root>/Iteration<n>`` and the dangling mass as one ``(0,mass)`` line below it.

    ``mass`` has the columns ``iteration, mass``; only the row of ``iteration`` is written.
    """
    path = iteration_path(root, iteration)
    out = ranks.select("id", "rank")
    write_tuples(out.coalesce(files) if files else out, path)
    last = mass.filter(F.col("iteration") == iteration).select(F.lit(0).cast("long").alias("id"), "mass")
    tuple_text(last).coalesce(1).write.text(f"{path}/{MASS_FOLDER}")
    return path
