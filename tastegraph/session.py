"""Session defaults and durable cut points."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None, **conf) -> SparkSession:
    """A session with the settings the library is tuned for.

    On a cluster leave ``master`` out and let spark-submit set it, together with
    ``spark.checkpoint.dir`` (a folder every executor can reach) and a shuffle partition
    count that keeps partitions at 100-200 MB.
    """
    builder = (
        SparkSession.builder.appName("tastegraph")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder for checkpoints and intermediate tables, as named by ``spark.checkpoint.dir``.

    Only a local session may go without that setting; it gets a folder of its own.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="tastegraph-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder as Parquet and go on from there.

    There is no lineage left, lost executors lose nothing, and readers load only the columns they need.
    """
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/durable-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
