"""Shared folders and session checks."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


# Settings for a large cluster; start partition counts high and let adaptive
# execution merge them, rather than tune a count for each job.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.session.timeZone": "UTC",
    # no TCP between a task and its Python worker: short passes of a fit take half the time
    "spark.python.unix.domain.socket.enabled": "true",
}


def build(app: str = "weakspot", **conf: str) -> SparkSession:
    """A session with the settings above; ``conf`` overrides them."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**CLUSTER_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it.

    A local session without the setting gets a temporary folder; a cluster
    without it is a configuration error, since a machine-local folder would
    be lost with its machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    named = tempfile.mkdtemp(prefix="weakspot-")
    spark.conf.set("spark.checkpoint.dir", named)
    return named


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under this application's part of the shared folder."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def _scratch_root(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/weakspot/{spark.sparkContext.applicationId}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application wrote to its scratch folder. Results
    that still read from there must have been stored elsewhere."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def ensure_checkpoints(spark: SparkSession) -> None:
    """Give fits that cut their lineage a reliable checkpoint folder."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(spark))


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the file system it is on."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(at).toString()


def written_once(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write a table to the shared folder and read it back; ``by`` is a
    column of few values that later reads filter on.

    Used where a result feeds several later jobs: the files survive lost
    executors and the source is not computed again.
    """
    path = scratch_path(df.sparkSession, name)
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    kept = df.sparkSession.read.schema(df.schema).parquet(path).select(df.columns)
    kept.scratch = path
    return kept


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that nothing refers to any
    more; it learns of them when the driver collects its garbage."""
    spark.sparkContext._jvm.System.gc()


def drop_scratch(df: DataFrame) -> None:
    """Delete a table that ``written_once`` returned and no later plan reads."""
    spark = df.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df.scratch)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
