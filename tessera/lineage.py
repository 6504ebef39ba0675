"""Cutting lineage through the folder that all executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_WRITTEN: list[tuple[SparkSession, str]] = []


def checkpoint_root(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Where the setting is absent: a temporary folder if all runs on this machine, else
    a folder in the warehouse, which a cluster shares; never a machine's own folder on a cluster."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        local = sc.master.startswith("local") and not sc.master.startswith("local-cluster")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tessera-checkpoints-") if local else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints")
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet to the shared folder and read back: lineage ends there, and lost executors lose nothing. The
    table is deleted when the driver's process ends."""
    spark = df.sparkSession
    path = f"{checkpoint_root(spark).rstrip('/')}/tessera-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _WRITTEN.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def clear_written(spark: SparkSession | None = None) -> None:
    """Deletes the tables that cut_lineage() wrote; results that still read them end with it."""
    for owner, path in list(_WRITTEN):
        if spark is not None and owner is not spark:
            continue
        _WRITTEN.remove((owner, path))
        try:
            jvm = owner.sparkContext._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(owner.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # noqa: BLE001  the session may be gone at exit
            pass


atexit.register(clear_written)
