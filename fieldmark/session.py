"""Session settings, and storing a result between steps."""

from __future__ import annotations

import atexit
import contextlib
import os
import tempfile
import uuid

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot key even where that costs one more exchange downstream
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.ui.enabled": "false",
}


def session(app: str = "fieldmark", local_cpus: int | None = None, **extra: str) -> SparkSession:
    """A session with this package's settings.

    ``local_cpus`` is for tests and the bench; leave it out on a cluster, where
    master, memory and shuffle partitions come from the submit command.
    """
    builder = SparkSession.builder.appName(app)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    if local_cpus:
        builder = (
            builder.master(f"local[{local_cpus}]")
            .config("spark.sql.shuffle.partitions", str(local_cpus))
            .config("spark.driver.memory", os.environ.get("FIELDMARK_DRIVER_MEMORY", "12g"))
            .config("spark.ui.showConsoleProgress", "false")
        )
    for key, value in extra.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Where results are stored between steps: the folder the cluster names for checkpoints."""
    context = spark.sparkContext
    shared = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="fieldmark-"))
    return context.getCheckpointDir()


_FOLDERS: set[str] = set()


def _stored_steps(spark: SparkSession) -> str:
    """This application's folder for stored steps, removed when its driver ends."""
    context = spark.sparkContext
    folder = f"{shared_folder(spark).rstrip('/')}/settled-{context.applicationId}"
    if folder not in _FOLDERS:
        _FOLDERS.add(folder)
        path, conf = context._jvm.org.apache.hadoop.fs.Path(folder), context._jsc.hadoopConfiguration()

        def remove() -> None:
            with contextlib.suppress(Py4JError, OSError):  # the JVM may have gone before
                path.getFileSystem(conf).delete(path, True)

        atexit.register(remove)
    return folder


def scratch(spark: SparkSession) -> str:
    """A new folder among the stored steps, for what a job writes and reads back; it goes when its driver ends."""
    return f"{_stored_steps(spark)}/{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` once as a table in the shared checkpoint folder and read it from there.

    For a result that several branches of a plan read and that is dear to
    compute.  The table outlives its executors, later steps read only the columns
    they need, and its size on disk tells Spark how to join it.  The tables of an
    application are removed when its driver ends.
    """
    spark = df.sparkSession
    untyped = {f.name: F.col(f"`{f.name}`").cast("string") for f in df.schema.fields if f.dataType == T.NullType()}
    stored = df.withColumns(untyped) if untyped else df
    path = scratch(spark)
    stored.write.parquet(path)
    return spark.read.schema(stored.schema).parquet(path)
