"""Edge readers. All return ``(src: long, dst: long)`` without nulls."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

EDGE = T.StructType([T.StructField("src", T.LongType()), T.StructField("dst", T.LongType())])

# Fixed value: a pair of ids anywhere in a line.
EDGE_PATTERN = r"(\d+),(\d+)"

MODES = ("PERMISSIVE", "FAILFAST")
BROKEN = "_broken"


def _check(mode: str) -> bool:
    if mode.upper() not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    return mode.upper() == "FAILFAST"


def _only_whole(df: DataFrame, whole: Column, raw: Column, failfast: bool) -> DataFrame:
    """Rows where ``whole`` holds; in FAILFAST any other row raises.

    The error sits in a filter, which no plan can prune, whichever columns it reads.
    """
    if not failfast:
        return df.filter(whole)
    error = F.raise_error(F.concat(F.lit("malformed edge: "), F.coalesce(raw, F.lit("")))).cast("boolean")
    return df.filter(F.when(whole, F.lit(True)).otherwise(error))


def _edges_from(df: DataFrame, src: Column, dst: Column, raw: Column, failfast: bool) -> DataFrame:
    out = df.select(src.try_cast("long").alias("src"), dst.try_cast("long").alias("dst"), raw.alias("raw"))
    whole = F.col("src").isNotNull() & F.col("dst").isNotNull()
    return _only_whole(out, whole, F.col("raw"), failfast).select("src", "dst")


def read_edges_csv(spark: SparkSession, path: str, sep: str = ",", mode: str = "PERMISSIVE") -> DataFrame:
    """Separated edge files with the fixed schema; malformed rows are dropped, or raise in FAILFAST.

    A row is malformed if it has a missing, an extra or a non-integer field.
    """
    failfast = _check(mode)
    schema = T.StructType([*EDGE.fields, T.StructField(BROKEN, T.StringType())])
    df = spark.read.schema(schema).csv(path, sep=sep, mode="PERMISSIVE", columnNameOfCorruptRecord=BROKEN)
    whole = F.col(BROKEN).isNull() & F.col("src").isNotNull() & F.col("dst").isNotNull()
    return _only_whole(df, whole, F.col(BROKEN), failfast).select("src", "dst")


def read_edges_text(spark: SparkSession, path: str, mode: str = "PERMISSIVE") -> DataFrame:
    """One ``a,b`` per line; a line counts only if it has exactly two fields (closing commas ignored)."""
    failfast = _check(mode)
    parts = F.split(F.rtrim(F.col("value"), F.lit(",")), ",")
    pair = F.when(F.size(parts) == 2, parts)
    return _edges_from(spark.read.text(path), pair.getItem(0), pair.getItem(1), F.col("value"), failfast)


def read_edges_tokens(spark: SparkSession, path: str, mode: str = "PERMISSIVE") -> DataFrame:
    """Any number of ``a,b`` tokens per line, separated by white space."""
    failfast = _check(mode)
    tokens = spark.read.text(path).select(F.explode(F.split(F.trim("value"), r"\s+")).alias("token"))
    tokens = tokens.filter(F.col("token") != "")
    parts = F.split("token", ",")
    pair = F.when(F.size(parts) == 2, parts)
    return _edges_from(tokens, pair.getItem(0), pair.getItem(1), F.col("token"), failfast)


def read_edges_regex(spark: SparkSession, path: str, whole_files: bool = False) -> DataFrame:
    """Every ``digits,digits`` match in loosely formatted text.

    Lines are the unit of work, so one large file is split among tasks; ``whole_files`` reads a
    file per row and suits folders of many small files.
    """
    text = spark.read.text(path, wholetext=whole_files)
    found = text.select(
        F.explode(
            F.arrays_zip(
                F.regexp_extract_all("value", F.lit(EDGE_PATTERN), 1).alias("a"),
                F.regexp_extract_all("value", F.lit(EDGE_PATTERN), 2).alias("b"),
            )
        ).alias("hit")
    )
    return _edges_from(found, F.col("hit.a"), F.col("hit.b"), F.col("hit.a"), failfast=False)


def read_ranks(spark: SparkSession, path: str) -> DataFrame:
    """``(id, rank)`` of one iteration's folder, its ``(0,mass)`` line among them."""
    text = spark.read.option("recursiveFileLookup", "true").text(path)
    fields = F.split(F.regexp_extract("value", r"\((.*)\)", 1), ",")
    return text.select(fields.getItem(0).cast("long").alias("id"), fields.getItem(1).cast("double").alias("rank"))


def read_iteration(spark: SparkSession, root: str, iteration: int | Column) -> DataFrame:
    """``(id, rank)`` of one iteration of ``write_iteration``; no other iteration's files are read."""
    table = spark.read.schema("id long, rank double, iteration int").parquet(root)
    return table.filter(F.col("iteration") == iteration).select("id", "rank")
