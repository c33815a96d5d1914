"""Where intermediate files go, and a session for local tests and benches."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
import tempfile
import uuid

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

TRIAL_TASKS = 1000  # at most, in the trial of a folder
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_made: dict[str, list[str]] = {}  # application id -> paths under the shared folder
_tried: set[tuple[str, str]] = set()  # (application id, folder) whose trial came back whole


def _one_process(sc) -> bool:
    """Whether tasks run inside the driver; the executors of ``local-cluster`` are processes with temporary folders of their own."""
    return sc.master == "local" or sc.master.startswith("local[")


def _refuse_local(sc, folder: str) -> None:
    """A folder of one machine is no shared folder on a cluster."""
    if not sc.master.startswith("local") and (folder.startswith(("file:", "/")) or "://" not in folder):
        raise ValueError(f"{folder} may be local to each machine; name a folder on a shared file system with its scheme")


def _refuse_unshared(spark: SparkSession, folder: str) -> None:
    """Refuse a folder that may be local to each machine, unless a table written there comes back whole.

    The name decides nothing: a path may be a mount that all machines have, or lie on the default file system.
    So rows are written by tasks on all cores and read back, once an application. Without a shared folder the
    driver misses the files of executors on other machines, and they miss its own.
    """
    sc = spark.sparkContext
    if (sc.applicationId, folder) in _tried:
        return
    try:
        _refuse_local(sc, folder)
    except ValueError as refused:
        path, tasks = f"{folder.rstrip('/')}/trial-{uuid.uuid4().hex}", min(2 * sc.defaultParallelism, TRIAL_TASKS)
        try:
            try:
                spark.range(0, tasks, 1, tasks).write.parquet(path)
                rows = spark.read.schema("id long").parquet(path).count()
            finally:
                drop_table(spark, path)
        except (PySparkException, Py4JError) as failed:
            raise refused from failed
        if rows != tasks:
            raise
    _tried.add((sc.applicationId, folder))


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, else the context's checkpoint folder.

    Without either, a local session gets a fresh temporary folder and a cluster one in the warehouse, which
    holds the tables that executors write. On a cluster, a folder that may be local is tried first.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if configured:
        _refuse_unshared(spark, configured)
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    if sc.getCheckpointDir() is None:
        if _one_process(sc):
            sc.setCheckpointDir(tempfile.mkdtemp(prefix="edgeweave-"))
        else:
            sc.setCheckpointDir(f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/edgeweave-{uuid.uuid4().hex}")
    _refuse_unshared(spark, sc.getCheckpointDir())
    return sc.getCheckpointDir()


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other run uses; ``release`` removes what is there."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def release(spark: SparkSession, kept: int = 0) -> None:
    """Remove the tables and files made so far, but for the first ``kept``; results must not need them any more."""
    made = _made.get(spark.sparkContext.applicationId, [])
    for path in made[kept:]:
        drop_table(spark, path)
    del made[kept:]


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Everything that is written to the shared folder inside is removed at the end.

    ``with scratch(spark): triangles(edges).write.parquet(out)`` leaves nothing but ``out``.
    """
    before = len(_made.get(spark.sparkContext.applicationId, []))
    try:
        yield
    finally:
        release(spark, before)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder; survives the loss of any executor."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries inside go when they end, not when the driver happens to collect its garbage."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before) if before is not None else spark.conf.unset(CLEANUP)


def written_table(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The same for link tables: columnar files in the shared folder, a fraction of a checkpoint's size.

    The shuffle files of ``df`` are removed as soon as it is written.
    """
    path = fresh_path(df.sparkSession, name)
    with _shuffles_removed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def counted_table(df: DataFrame, name: str) -> tuple[DataFrame, str, int]:
    """``written_table`` and its number of rows, observed while it is written: no job of its own counts them."""
    watch = Observation(name)
    table, path = written_table(df.observe(watch, F.count(F.lit(1)).alias("rows")), name)
    return table, path, watch.get["rows"]


def drop_table(spark: SparkSession, path: str) -> None:
    """Remove a table that ``written_table`` made."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def local_session(cores: int | str = 8, name: str = "edgeweave", **conf: str) -> SparkSession:
    """Session for tests and ``bench.py``; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.coalescePartitions.enabled", "false")  # few partitions already
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
