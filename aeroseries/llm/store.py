"""Intermediate tables in the folder that the driver and all executors share.

A written table cuts the lineage: a lost executor costs the tasks that ran on
it, never the steps before.  The folder is the one named in
``spark.checkpoint.dir``; only a session on a ``local`` master without that
setting (tests) gets a folder of its own.
"""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from aeroseries.llm.kernels import ship_by_value

ship_by_value(__name__)


def shared_dir(spark: SparkSession) -> str:
    """The shared scratch folder; an error where a cluster names none."""
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    known = getattr(sc, "_aeroseries_llm_dir", None)
    if known is None:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        known = sc._aeroseries_llm_dir = "file://" + tempfile.mkdtemp(prefix="aeroseries-llm-", dir="/tmp")
    return known


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"


def write_table(df: DataFrame, name: str, codec: str | None = None) -> tuple[DataFrame, str]:
    """Write ``df`` as Parquet in the shared folder; the table read again, and its path."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path), path


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete intermediate tables that no returned DataFrame reads."""
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of steps that have ended.

    It does so when the driver's garbage is collected, which may be hours off
    where the driver has little to do; a chain of written tables would hold the
    shuffles of all its steps until then.
    """
    gc.collect()
    spark._jvm.System.gc()
