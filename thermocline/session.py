"""Session settings and durable intermediate tables."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Rows of one ordered key that a single task sorts at a time (see operators/ordered.py).
RUN_ROWS_CONF = "spark.thermocline.runRows"
RUN_ROWS_DEFAULT = 100_000


def build_session(master: str | None = None, app: str = "thermocline", **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def run_rows(spark: SparkSession) -> int:
    return int(spark.conf.get(RUN_ROWS_CONF, str(RUN_ROWS_DEFAULT)))


_local_dir: str | None = None
_written: list[str] = []


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by the cluster. On a local master without one (tests), a private folder; elsewhere an error."""
    global _local_dir
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if _local_dir is None:
        _local_dir = tempfile.mkdtemp(prefix="thermocline-")
    return _local_dir


def materialise(df: DataFrame) -> DataFrame:
    """Write `df` to a Parquet table in the checkpoint folder and read it back.

    The table survives the loss of executors, cuts the lineage and keeps column pruning
    for whoever reads it next. `drop_materialised` removes it, at the end of the process at the latest.
    """
    spark = df.sparkSession
    path = table_path(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table_path(spark: SparkSession) -> str:
    """A new path for a table of this run in the checkpoint folder."""
    path = f"{checkpoint_dir(spark)}/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    if not _written:
        atexit.register(drop_materialised, spark)
    _written.append(path)
    return path


def drop_materialised(spark: SparkSession) -> None:
    """Remove the tables this process has written; frames that read them can't be used any more."""
    jvm = getattr(spark.sparkContext, "_jvm", None)
    if jvm is None or spark.sparkContext._jsc is None:
        return  # the session has ended
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    while _written:
        path = jvm.org.apache.hadoop.fs.Path(_written.pop())
        path.getFileSystem(conf).delete(path, True)
