"""Session helpers: settings the operators rely on, and the one shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: str = "*", name: str = "cohortloom", memory: str = "8g", **extra) -> SparkSession:
    """A session for tests and the benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors reach, as the session names it; local runs get a scratch folder of their own."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(named)
        return named
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut(df: DataFrame, drop_shuffles: bool = False) -> DataFrame:
    """Write the table to the shared folder and go on from there: ends the lineage, is computed once, survives lost executors,
    and gives the planner the true size. With `drop_shuffles` the write's shuffle files go as soon as it is done."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "cut")
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true" if drop_shuffles else before)
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    done = spark.read.schema(df.schema).parquet(path)
    done.cut_path = path
    if _spent:
        _spent[-1].append(done)
    return done


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_spent: list[list[DataFrame]] = []


@contextmanager
def spent(*, keep: list[DataFrame]):
    """Deletes the tables that were cut inside of the block when it ends, but for those that were put into `keep`: what is returned may read no others."""
    _spent.append([])
    try:
        yield
    finally:
        made = _spent.pop()
        kept = {t.cut_path for t in keep}
        for t in made:
            if t.cut_path not in kept:
                uncut(t)


def _files(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def uncut(df: DataFrame | None) -> None:
    """Delete a cut table that nothing reads any more: rounds keep their last table only."""
    path = getattr(df, "cut_path", None)
    if path:
        fs, where = _files(df.sparkSession, path)
        fs.delete(where, True)


#: Largest files, compressed, that are sent to every executor.
LIST_BYTES = 64 << 20


def sent_whole(done: DataFrame, limit: int = LIST_BYTES) -> DataFrame:
    """A cut table with a broadcast hint if its files are small enough, else as it is."""
    fs, where = _files(done.sparkSession, done.cut_path)
    return F.broadcast(done) if fs.getContentSummary(where).getLength() <= limit else done


#: Largest Arrow batch that goes to a Python task: the executor and its workers hold a batch several times over, one for each core.
BATCH_BYTES = 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Long texts go to the session's Python tasks in batches bounded by bytes; a single longer text is a batch of its own."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def key_list(df: DataFrame, limit: int = LIST_BYTES) -> DataFrame:
    """A list of keys for a semi or anti join against a huge table: computed once, measured, and broadcast only below the limit.

    Other joins carry no hint. The planner broadcasts tables whose size it knows; adaptive execution measures derived tables at
    run time, broadcasts the small ones and splits hot keys of the rest.
    """
    return sent_whole(cut(df), limit)
