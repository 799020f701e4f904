"""Session defaults and the shared working folder."""

from __future__ import annotations

import re
import tempfile
import uuid
import warnings

from pyspark.sql import SparkSession

# Settings the library is tuned for; ``configured`` gives them to any builder.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Model training shuffles arrays of statistics, not SQL rows; Kryo packs those faster.
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    # Do not look up the Python call site of every column expression: it doubles plan-building time.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


_removed_at_end: set[str] = set()


def configured(builder: SparkSession.Builder, **extra: str) -> SparkSession.Builder:
    """A builder with the library's defaults, for a cluster as well; ``extra`` and later settings win."""
    return builder.config(map={**DEFAULTS, **extra})


def local_session(cores: int | str = "*", **extra: str) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster the session comes from spark-submit."""
    settings = {
        "spark.sql.shuffle.partitions": "8" if cores == "*" else str(cores),
        "spark.driver.memory": "12g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **extra,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName("martkit")
    spark = configured(builder, **settings).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, also used by ``DataFrame.checkpoint``.

    It is the one the session names in ``spark.checkpoint.dir``. Where that is unset, only a session whose driver
    and executors are one process gets a temporary folder of this machine, and says so.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[[^\[\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="martkit-")
        warnings.warn(f"spark.checkpoint.dir is unset; this local session works in {folder}", stacklevel=3)
        spark.conf.set("spark.checkpoint.dir", folder)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def run_folder(spark: SparkSession) -> str:
    """This application's own folder below the shared one. It is removed when the driver ends in an orderly way.

    Results are lazy and may read from it until then.
    """
    context = spark.sparkContext
    folder = f"{shared_folder(spark)}/martkit/{context.applicationId}"
    if folder not in _removed_at_end:
        _removed_at_end.add(folder)
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        system = path.getFileSystem(context._jsc.hadoopConfiguration())
        system.mkdirs(path)  # only what is there can be marked
        system.deleteOnExit(path)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the run's folder."""
    return f"{run_folder(spark)}/{name}-{uuid.uuid4().hex}"
