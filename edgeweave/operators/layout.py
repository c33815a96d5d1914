"""Physical layouts: by modulo, in buckets, in id ranges, in iterations."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from edgeweave.operators.edges import as_column
from edgeweave.session import drop_table, fresh_path

RANGES = 64


def modulo_layout(df: DataFrame, partitions: int, key: str) -> DataFrame:
    """Partition number = key modulo ``partitions``."""
    return df.repartitionById(partitions, F.pmod(F.col(key), F.lit(partitions)).cast("int"))


def observed(df: DataFrame, name: str, *metrics: Column) -> tuple[DataFrame, Observation]:
    """Count while writing: the metrics fill when the returned frame is consumed."""
    watch = Observation(name)
    return df.observe(watch, *metrics), watch


def bucketed_table(df: DataFrame, *keys: str) -> str:
    """Name of a table in the session's catalog, bucketed and sorted by ``keys``, one file a bucket.

    Its files lie in the shared folder. There are as many buckets as shuffle partitions, so a join or an
    aggregate on ``keys`` needs no exchange of the table. ``df`` may be partitioned by ``keys`` already.
    """
    spark = df.sparkSession
    buckets, path = int(spark.conf.get("spark.sql.shuffle.partitions")), fresh_path(spark, "buckets")
    name = f"edgeweave_{uuid.uuid4().hex}"
    dealt = df.repartition(buckets, *keys)
    dealt.write.format("parquet").option("path", path).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    return name


def drop_bucketed(spark: SparkSession, name: str) -> None:
    """Remove a table that ``bucketed_table`` made, with its files."""
    path = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").first()["data_type"]
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    drop_table(spark, path)


def write_by_top(edges: DataFrame, path: str, ranges: int = RANGES) -> None:
    """Edges in at most ``ranges`` folders by their larger end, for ``read_capped``.

    A folder is named by ``from_id``, the least larger end it may hold; the bounds are quantiles, so folders are
    of similar size unless a single id is larger than one. Files are ranges of ``(from_id, src, dst)``, so a
    folder of any size is written by many tasks. Edges with a null end have no larger end that a cap could
    admit and are left out.
    """
    top = F.greatest("src", "dst")
    whole = edges.filter(F.col("src").isNotNull() & F.col("dst").isNotNull())
    bounds = whole.select(top.alias("top")).approxQuantile("top", [i / ranges for i in range(1, ranges)], 0.1 / ranges)
    lows = sorted({int(b) for b in bounds})
    from_id = F.coalesce(*[F.when(top >= low, F.lit(low)) for low in reversed(lows)], F.lit(-(1 << 63))) if lows else F.lit(0)
    ranged = whole.withColumn("from_id", from_id.cast("long")).repartitionByRange("from_id", "src", "dst")
    ranged.write.partitionBy("from_id").parquet(path)


def read_capped(spark: SparkSession, path: str, cap: int | Column) -> DataFrame:
    """Edges of ``write_by_top`` with both ends at most ``cap``; folders beyond the cap are not opened."""
    stored = spark.read.schema("src long, dst long, from_id long").parquet(path)
    cap = as_column(cap)
    return stored.filter((F.col("from_id") <= cap) & (F.col("src") <= cap) & (F.col("dst") <= cap)).select("src", "dst")
