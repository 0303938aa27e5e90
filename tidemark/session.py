"""Session settings, the shared scratch folder and tables landed in it."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Where set, small inputs are read in this many tasks; see tables.table().
INPUT_TASKS_CONF = "spark.tidemark.inputTasks"


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, skew-join splitting and UTC.

    A stage starts with many partitions and adaptive execution merges them, so
    one setting serves all sizes; it never splits a partition that is too large.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8192",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Reads ``spark.checkpoint.dir``. Only a local-mode session without that
    setting gets a folder of its own, and keeps it for its lifetime.
    """
    configured = spark.conf.get(CHECKPOINT_CONF, "") or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder shared by the cluster")
    own = tempfile.mkdtemp(prefix="tidemark-")
    spark.sparkContext.setCheckpointDir(own)
    return own


def run_dir(spark: SparkSession) -> str:
    """The one folder of all tables that this application lands."""
    return f"{shared_dir(spark)}/tidemark-{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the run's folder that nothing has written to yet."""
    return f"{run_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cleanup(spark: SparkSession) -> None:
    """Delete all tables that this application has landed.

    For the end of a job, when its results are written; DataFrames that still
    read a landed table are void afterwards.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(run_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def land(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and continue from the written table.

    This cuts the lineage (a lost executor re-reads files instead of re-running
    the job) and gives later joins the real size of the data: Spark broadcasts
    the table only while its files stay below ``autoBroadcastJoinThreshold``
    and otherwise runs a sort-merge join with adaptive skew splitting. The
    table stays until :func:`cleanup`.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def local_table(spark: SparkSession, rows, names) -> DataFrame:
    """A small table of configured values, with a size that Catalyst knows.

    An Arrow table becomes a local relation, unlike a Python list, whose size
    is unknown to the optimizer. A long one is not broadcast.
    """
    columns = list(zip(*rows)) or [()] * len(names)
    return spark.createDataFrame(pa.table({n: pa.array(c) for n, c in zip(names, columns)}))
