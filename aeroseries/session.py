"""Session helpers.

On a cluster the session comes from the platform; these helpers only fill in
settings that are unset, so a cluster's own choices (checkpoint folder,
shuffle partitions) always win.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "aeroseries", extra: dict | None = None) -> SparkSession:
    """Return the active session untouched, or build one with the engine's
    defaults.

    ``master`` defaults to ``local[*]`` and is only used when no session is
    active.  ``spark.sql.shuffle.partitions`` defaults to twice the local cores;
    on a cluster set it from the data size (about 128-256 MB per partition).
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        # A platform-provided session keeps its own settings.
        ensure_checkpoint_dir(active)
        return active
    builder = SparkSession.builder.appName(app_name)
    builder = builder.master(master or "local[*]")
    conf = dict(DEFAULT_CONF)
    cores = os.cpu_count() or 8
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or 2 * cores)
    conf.setdefault("spark.driver.memory", "8g")
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder named in ``spark.checkpoint.dir``.

    The cluster's setting is read from the session and used as is.  Only a
    ``local`` master without that setting (tests) gets a fresh scratch folder;
    elsewhere driver and executors share no local folder, so it is an error.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    current = sc._jsc.sc().getCheckpointDir()
    if not configured and current.isDefined():
        return current.get()
    if not configured:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the driver and all executors")
        configured = tempfile.mkdtemp(prefix="aeroseries-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", configured)
    if not current.isDefined():
        sc.setCheckpointDir(configured)
    return configured


def cut_lineage(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it again.

    Used before iterative work (model search loops): a lost executor is
    recovered from the files instead of replaying the whole plan, and later
    scans still prune columns and push filters down.
    """
    return scratch_table(df, name)[0]


def scratch_table(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written in the shared folder and read again, and its path."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def drop_tables(spark: SparkSession, *paths: str) -> None:
    """Delete written tables that nothing reads any more."""
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
