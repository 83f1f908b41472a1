"""Session settings and shared storage used by the eager operators."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CONFIGURED = {
    # Source time stamps carry no zone; every epoch value below is UTC.
    "spark.sql.session.timeZone": "UTC",
    # Repeated object keys are valid JSON text.
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Set the SQL options the operators rely on (runtime options only)."""
    for key, value in CONFIGURED.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    ``spark.checkpoint.dir`` comes first. A session in one process may do without
    it and uses its warehouse folder; on a cluster, ``local-cluster`` included, a
    missing setting is an error, because executors might not see the files.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    made = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/changefeed-{uuid.uuid4().hex}"
    spark.sparkContext.setCheckpointDir(made)
    gone_at_exit(spark, made)
    return made


def gone_at_exit(spark: SparkSession, path: str) -> None:
    """Have the storage remove ``path`` when this session's process ends."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in a folder; none if it is missing."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [f.getPath().getName() for f in system.listStatus(where)] if system.exists(where) else []


def settle(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into reliable storage and go on from there."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def compute_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column that later filters must not recompute.

    A filter on a plain column is pushed below it and carries a copy of its
    expression along for every mention; it cannot pass a generator.
    """
    return df.withColumn(name, F.explode(F.array(value)))
