"""Session set-up, table access and lineage cuts."""

from __future__ import annotations

import os
import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


#: Temporary folders of local sessions, by application.
_LOCAL: dict[str, str] = {}


def get_session(app: str = "pricelode", **conf: str) -> SparkSession:
    """A local session for tests and the bench; on a cluster the caller's session is used as it is."""
    builder = SparkSession.builder.appName(app)
    defaults = {
        "spark.master": f"local[{os.environ.get('BENCH_CPUS', '8')}]",
        "spark.driver.memory": "12g",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    for key, value in (defaults | conf).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The Parquet table `name` under `root` (a file or a folder of part files)."""
    return spark.read.parquet(f"{root}/{name}.parquet")


def _hadoop(spark: SparkSession, path: str) -> tuple:
    """The Hadoop path and its file system."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def shared_folder(spark: SparkSession) -> str:
    """This application's folder for lineage cuts, in the cluster's spark.checkpoint.dir; it is removed when the application ends.

    Only a local session may leave that setting out (as in tests) and gets a temporary folder: elsewhere executors could
    not read what others wrote to a folder of their own machine, so that raises.
    """
    context = spark.sparkContext
    set_before = context._jsc.sc().getCheckpointDir()
    root = spark.conf.get("spark.checkpoint.dir", None) or (set_before.get() if set_before.isDefined() else None)
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = _LOCAL.get(context.applicationId) or _LOCAL.setdefault(context.applicationId, tempfile.mkdtemp(prefix="pricelode-"))
    folder = f"{root.rstrip('/')}/pricelode-{context.applicationId}"
    target, system = _hadoop(spark, folder)
    if not system.exists(target):
        system.mkdirs(target)
        system.deleteOnExit(target)
    return folder


def checkpointed(frame: DataFrame) -> DataFrame:
    """`frame` written as a table to the shared folder, so that later stages survive the loss of executors without computing
    it again, and read only the columns they need. Order and partitioning are not kept."""
    path = f"{shared_folder(frame.sparkSession)}/{uuid4().hex}"
    frame.write.option("compression", "zstd").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Removes all tables that `checkpointed` has written; call it when the results made from them have been stored."""
    target, system = _hadoop(spark, shared_folder(spark))
    system.delete(target, True)
