"""Session settings and the one place where lineage is cut."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app: str = "crownframe", **conf) -> SparkSession:
    """A session with the settings the operators are written for.

    On a cluster leave `master` to spark-submit and pass the shuffle width there.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder for written intermediate tables: the cluster's `spark.checkpoint.dir`.

    A temporary folder is chosen only for a local master, where driver and tasks share one disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/crownframe/{app}/{label}-{uuid.uuid4().hex}"


def cut(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write `df` to the shared folder and read it back.

    Cuts the lineage so a lost executor costs one stage, and gives Catalyst real file sizes, so a
    side is broadcast only when it is known to be small.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._cut_path = path
    return out


def on_file(df: DataFrame, now: bool = False) -> bool:
    """Whether the table comes from files of `cut`; `now` says that it does, row by row, so that it need not be written again."""
    if now:
        df._on_file = True
    return hasattr(df, "_cut_path") or hasattr(df, "_on_file")


def release(*tables: DataFrame) -> None:
    """Delete the files of tables made by `cut` that no later step reads; others are left alone."""
    for df in tables:
        path = getattr(df, "_cut_path", None)
        if path:
            spark = df.sparkSession
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
